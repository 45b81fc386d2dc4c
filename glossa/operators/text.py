"""Review cleaning, keyword rules and text features.

All row-local: no shuffle, one pass inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.functions import text as T
from glossa.functions.numeric import nan_to_null, safe_div

# Category keyword lists, in rule order (first match wins).
CATEGORY_RULES = (
    ("Skincare", ("skin", "face", "moisturizer", "serum", "cream", "cleanser", "acne", "wrinkle")),
    ("Makeup", ("makeup", "lipstick", "foundation", "mascara", "eyeshadow", "blush", "concealer")),
    ("Hair Care", ("hair", "shampoo", "conditioner", "styling", "color", "treatment")),
    ("Fragrance", ("perfume", "fragrance", "scent", "cologne", "smell")),
    ("Body Care", ("body", "lotion", "bath", "shower", "hand", "foot")),
    ("Sunscreen", ("sunscreen", "sunblock", "spf", "uv", "protection")),
    ("Anti-Aging", ("anti-aging", "wrinkle", "firming", "age", "mature")),
    ("Natural", ("natural", "organic", "clean", "chemical-free", "vegan")),
)
CATEGORY_DEFAULT = "Other"

# Skin-type keyword lists, in rule order (first match wins).
SKIN_RULES = (
    ("dry", ("dry", "flaky", "dehydrated", "tight")),
    ("oily", ("oily", "greasy", "shiny", "sebum")),
    ("combination", ("combination", "t-zone", "oily t-zone")),
    ("sensitive", ("sensitive", "irritated", "redness", "reactive")),
    ("normal", ("normal", "balanced")),
    ("mature", ("mature", "aging", "wrinkles", "fine lines", "anti-aging")),
)
SKIN_DEFAULT = "unknown"

# Concern keyword lists, in rule order (all matches, first two kept).
CONCERN_RULES = (
    ("acne", ("acne", "pimples", "breakout", "blemish")),
    ("hydration", ("hydration", "moisture", "dryness")),
    ("anti-aging", ("wrinkle", "aging", "firmness")),
    ("brightening", ("brighten", "glow", "dull", "dark spot")),
    ("pores", ("pore", "large pores", "blackhead")),
)
MAX_CONCERNS = 2

DEMOGRAPHIC_COLS = ("skin_tone", "eye_color", "skin_type", "hair_color")


def detect_roles(columns: Sequence[str]) -> dict[str, str]:
    """B1: first column whose lower-case name contains text / rating / date-or-time."""
    low = [(c, c.lower()) for c in columns]
    text = next((c for c, lc in low if "review_text" in lc or "text" in lc), None)
    rating = next((c for c, lc in low if "rating" in lc), None)
    date = next((c for c, lc in low if "date" in lc or "time" in lc), None)
    if not text or not rating:
        raise KeyError(f"required text/rating columns not found among: {', '.join(columns)}")
    roles = {text: "review_text", rating: "rating"}
    if date:
        roles[date] = "review_date"
    return roles


def clean_reviews(df: DataFrame, *, min_chars: int = 5, rating_range=(1.0, 5.0)) -> DataFrame:
    """Standardise roles, clean text, keep rows with text longer than ``min_chars``
    and a rating in range (coerced, 1 decimal half-even), parse dates, tidy demographics."""
    roles = detect_roles(df.columns)
    out = df.withColumnsRenamed({k: v for k, v in roles.items() if k != v})
    out = out.withColumn("cleaned_text", T.clean_text("review_text"))
    out = out.filter(F.col("rating").isNotNull() & (F.length("cleaned_text") > min_chars))
    out = clean_rating(out, rating_range=rating_range)
    if "review_date" in out.columns:
        out = out.withColumn("review_date", parse_timestamp("review_date")).filter(F.col("review_date").isNotNull())
    for c in DEMOGRAPHIC_COLS:
        if c in out.columns:
            out = out.withColumn(c, F.trim(F.lower(F.coalesce(F.col(c).cast("string"), F.lit("unknown")))))
    return out


def clean_rating(df: DataFrame, *, col: str = "rating", rating_range=(1.0, 5.0)) -> DataFrame:
    """Coerce to a number (failures → NULL, 'NaN' text → NULL, never NaN), keep
    ``lo <= r <= hi``, round to one decimal half-even."""
    r = nan_to_null(F.col(col).cast("string").try_cast("double"))
    out = df.withColumn(col, r).filter(F.col(col).between(*rating_range))
    return out.withColumn(col, F.rint(F.col(col) * 10.0) / 10.0)


def parse_timestamp(c: str) -> F.Column:
    """Coerce to timestamp, failures → NULL (already-typed values pass)."""
    return F.coalesce(F.col(c).try_cast("timestamp"), F.try_to_timestamp(F.col(c).cast("string")))


def retention(raw: DataFrame, *, text_col: str = "review_text", rating_col: str = "rating", min_chars: int = 5) -> DataFrame:
    """Rows before/after the text+rating filter, in one aggregation pass."""
    kept = F.col(rating_col).isNotNull() & (F.length(T.clean_text(text_col)) > min_chars)
    return raw.agg(F.count(F.lit(1)).alias("initial_rows"), F.count_if(kept).alias("kept_rows")).withColumn(
        "kept_pct", safe_div(F.col("kept_rows") * 100.0, F.col("initial_rows"))
    )


def categorize(df: DataFrame, *, text_col: str = "cleaned_text", rules=CATEGORY_RULES, default=CATEGORY_DEFAULT) -> DataFrame:
    """B9 + B10: primary category by keyword rules; secondary = brand or 'General'."""
    sec = F.col("brand_name") if "brand_name" in df.columns else F.lit("General")
    return df.withColumn("primary_category", T.first_matching_rule(text_col, rules, default)).withColumn(
        "secondary_category", sec
    )


def keyword_insights(
    df: DataFrame, *, text_col: str = "cleaned_text", skin_rules=SKIN_RULES, concern_rules=CONCERN_RULES, max_concerns=MAX_CONCERNS
) -> DataFrame:
    """B11 + B12: inferred skin type (first match) and up to two concerns (all matches)."""
    return df.withColumn("inferred_skin_type", T.first_matching_rule(text_col, skin_rules, SKIN_DEFAULT)).withColumn(
        "main_concerns", T.all_matching_rules(text_col, concern_rules, max_concerns)
    )


def text_features(df: DataFrame, *, text_col: str = "cleaned_text", prefix: str = "text_") -> DataFrame:
    """B13 + B14: word/sentence/punctuation counts, mean word length, length.

    Mean word length is (non-space characters) / (words): words are the maximal
    non-space runs, so no array is built. Empty text → all zero.
    """
    t = F.coalesce(F.col(text_col), F.lit(""))
    words = T.word_count(t)
    punct = T.char_count(t, ".") + T.char_count(t, "!") + T.char_count(t, "?")
    sentences = F.when((punct == 0) & (words > 0), F.lit(1)).otherwise(punct)
    return df.withColumns(
        {
            f"{prefix}word_count": words,
            f"{prefix}sentence_count": sentences.cast("long"),
            f"{prefix}avg_word_length": F.when(words > 0, T.non_space_chars(t) / words).otherwise(F.lit(0.0)),
            f"{prefix}exclamation_count": T.char_count(t, "!").cast("long"),
            f"{prefix}question_count": T.char_count(t, "?").cast("long"),
            f"{prefix}length": F.length(t).cast("long"),
        }
    )
