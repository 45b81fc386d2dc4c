"""Lexicon sentiment (C1–C6) as Spark expressions.

Method (published valence-lexicon scoring): each token with a lexicon valence
is boosted by an intensifier among the 3 preceding tokens (+/-0.293, decaying
1/0.95/0.9 with distance) and flipped/damped (x -0.74) after a negation among
the 3 preceding tokens; the review valence ``s`` is the sum and the compound
score ``s / sqrt(s^2 + 15)`` lies in (-1, 1). The polarity score is the mean
polarity of the tokens that a second lexicon knows, 0 without hits.
The blend is the mean of both. Both lexicons are parameters; the default ones
below are small and our own, so scores are comparable in method, not in value,
to any published lexicon.

Lexicon tables: the tokens of each distinct text are first summed up per text and token (what
their 3 predecessors add and turn, and how often it occurs), then joined to the lexicon without a hint (Spark broadcasts it only
below ``spark.sql.autoBroadcastJoinThreshold``), summed per text, and the sums go
back to the rows by the text's key. Lexicons written in the code as short dicts are constants
of a row-local expression instead, without a shuffle. Nothing runs while the plan is built. A
lexicon that lists a token several times gives it the mean of its valences; an
empty lexicon scores everything 0.
"""

from __future__ import annotations

from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.functions import text as T

# Our own grades of common review words, on a -4..4 scale.
DEFAULT_LEXICON = {
    **dict.fromkeys("great excellent best love loved amazing awesome perfect wonderful fantastic beautiful".split(), 3.0),
    **dict.fromkeys("good better like nice happy recommend glad fresh".split(), 2.0),
    **dict.fromkeys("fine okay ok soft worth".split(), 1.0),
    **dict.fromkeys("worst terrible horrible awful hate hated".split(), -3.0),
    **dict.fromkeys("bad worse poor disappointed disappointing useless worthless waste stupid idiot dumb ugly sad angry".split(), -2.0),
    **dict.fromkeys("broken annoying problem irritated greasy sticky dry cheap".split(), -1.0),
}
# Our own polarities (-1..1), a second source: fewer words of feeling, more of quality.
DEFAULT_POLARITY = {
    **dict.fromkeys("excellent perfect awesome wonderful best".split(), 1.0),
    **dict.fromkeys("good great beautiful happy lovely fresh new clean".split(), 0.7),
    **dict.fromkeys("nice better fine soft easy light worth".split(), 0.4),
    **dict.fromkeys("worst terrible horrible awful".split(), -1.0),
    **dict.fromkeys("bad poor useless worthless ugly stupid broken".split(), -0.7),
    **dict.fromkeys("worse cheap dry hard heavy late problem".split(), -0.4),
}
# Negations and intensifiers.
NEGATIONS = ("not", "no", "never", "none", "nobody", "nothing", "neither", "nor", "nowhere",
             "cannot", "without", "dont", "doesnt", "didnt", "isnt", "wasnt", "wont", "cant")
BOOSTERS = ("very", "really", "extremely", "so", "too", "absolutely", "totally", "incredibly",
            "super", "highly", "most", "more", "completely", "especially", "particularly")
BOOST = 0.293
BOOST_DECAY = (1.0, 0.95, 0.9)
NEGATION_SCALAR = -0.74
ALPHA = 15.0
POLARITY_SCALE = 4.0
#: Words of a dict lexicon up to which it is a constant of the plan; a map is probed entry by entry.
CONSTANT_WORDS = 200

# Label thresholds: reviews use strict 0.1 (C4); tweets use inclusive 0.05.
REVIEW_THRESHOLDS = (0.1, False)
TWEET_THRESHOLDS = (0.05, True)


def word_table(spark: SparkSession, words: Mapping[str, float], value: str) -> DataFrame:
    """(token, ``value``) of a dict, as a local table whose size the planner knows (rows of Python objects count as
    endless: joins with them shuffle the other side too)."""
    items = sorted(words.items())
    columns = {"token": pa.array([w for w, _ in items], pa.string()), value: pa.array([float(v) for _, v in items], pa.float64())}
    return spark.createDataFrame(pa.table(columns))


def lexicon_frame(spark: SparkSession, lexicon: dict[str, float] | None = None) -> DataFrame:
    return word_table(spark, DEFAULT_LEXICON if lexicon is None else lexicon, "valence")


def word_polarities(lexicon: dict[str, float] | None, polarity: dict[str, float] | None) -> dict[str, float]:
    """The second source: given, or the default one, or (for a lexicon of one's own) the clipped valences."""
    if polarity is not None:
        return polarity
    if lexicon is None:
        return DEFAULT_POLARITY
    return {t: max(-1.0, min(1.0, v / POLARITY_SCALE)) for t, v in lexicon.items()}


def tokens(c: str | Column, clean: bool = True) -> Column:
    """Lower-cased single-space tokens (empty text → []); ``clean=False`` when the
    input is already the output of ``clean_text``."""
    low = F.lower(T.clean_text(c)) if clean else F.lower(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")))
    return F.when(low == "", F.array().cast("array<string>")).otherwise(F.split(low, " "))


def _in(c: Column, words) -> Column:
    return F.coalesce(c.isin(*words), F.lit(False))


def _context(p1: Column, p2: Column, p3: Column) -> tuple[Column, Column]:
    """What the three tokens before one add to its valence, and the factor that turns it."""
    boost = sum(
        (F.when(_in(p, BOOSTERS), F.lit(BOOST * d)).otherwise(F.lit(0.0)) for p, d in zip((p1, p2, p3), BOOST_DECAY)),
        F.lit(0.0),
    )
    negated = _in(p1, NEGATIONS) | _in(p2, NEGATIONS) | _in(p3, NEGATIONS)
    return boost, F.when(negated, F.lit(NEGATION_SCALAR)).otherwise(F.lit(1.0))


def _adjusted(v: Column, p1: Column, p2: Column, p3: Column) -> Column:
    boost, scale = _context(p1, p2, p3)
    return (v + F.signum(v) * boost) * scale


def _scores_from(s: Column, pol_sum: Column, hits: Column) -> dict[str, Column]:
    compound = F.try_divide(s, F.sqrt(s * s + F.lit(ALPHA)))
    polarity = F.when(hits > 0, pol_sum / hits).otherwise(F.lit(0.0))
    return {"vader_compound": F.coalesce(compound, F.lit(0.0)), "textblob_sentiment": F.coalesce(polarity, F.lit(0.0))}


def _polarity(v: Column) -> Column:
    return F.least(F.greatest(v / F.lit(POLARITY_SCALE), F.lit(-1.0)), F.lit(1.0))


def lexicon_map(lexicon: dict[str, float]) -> Column:
    """Constant ``map<string,double>`` (constant-folded once by Catalyst)."""
    items = sorted(lexicon.items())
    return F.map_from_arrays(
        F.array(*[F.lit(k) for k, _ in items]).cast("array<string>"),
        F.array(*[F.lit(float(v)) for _, v in items]).cast("array<double>"),
    )


def score_map(
    df: DataFrame,
    lexicon: dict[str, float] | None = None,
    *,
    polarity: dict[str, float] | None = None,
    text_col: str = "cleaned_text",
    clean: bool = True,
) -> DataFrame:
    """Row-local form of short dict lexicons, for batches and for streams (whose rows cannot be joined back to their
    own aggregate): tokens probe constant maps of lexicons that are written in the code."""
    polarity = word_polarities(lexicon, polarity)
    lexicon = DEFAULT_LEXICON if lexicon is None else lexicon
    # Tokenise once into a column: the lambdas below index the array repeatedly.
    df = df.withColumn("_toks", tokens(text_col, clean))
    toks = F.col("_toks")

    def prev(arr, i, j):
        return F.when(i >= j, F.try_element_at(arr, i - j + 1))

    # Keep only known tokens first (hash-set membership), then look up values
    # and predecessors for the hits alone.
    words = sorted({*lexicon, *polarity})
    indexed = F.transform(toks, lambda t, i: F.struct(t.alias("t"), i.alias("i")))
    known = F.filter(indexed, lambda x: x["t"].isin(*words))
    hits = F.transform(
        known,
        lambda x: F.struct(
            F.try_element_at(lexicon_map(lexicon), x["t"]).alias("v"),
            F.try_element_at(lexicon_map(polarity), x["t"]).alias("q"),
            *[prev(toks, x["i"], j).alias(f"p{j}") for j in (1, 2, 3)],
        ),
    )
    df = df.withColumn("_hits", hits)
    adj = F.transform(F.col("_hits"), lambda x: F.coalesce(_adjusted(x["v"], x["p1"], x["p2"], x["p3"]), F.lit(0.0)))
    s = F.aggregate(adj, F.lit(0.0), lambda acc, x: acc + x)
    rated = F.filter("_hits", lambda x: x["q"].isNotNull())
    pol_sum = F.aggregate(rated, F.lit(0.0), lambda acc, x: acc + x["q"])
    return df.withColumns(_scores_from(s, pol_sum, F.size(rated))).drop("_toks", "_hits")


def score(
    df: DataFrame,
    lexicon: dict[str, float] | DataFrame | None = None,
    *,
    polarity: dict[str, float] | DataFrame | None = None,
    text_col: str = "cleaned_text",
    clean: bool = True,
) -> DataFrame:
    """C1 + C2: ``vader_compound`` and ``textblob_sentiment`` of every row.

    Scores belong to texts, so rows need no unique id: equal texts are tokenised once
    and share their sums (a text that a third of the rows repeat is one text). A lexicon frame has columns
    ``token, valence``, a polarity frame ``token, polarity``; without the second, a lexicon of one's own
    stands for both.
    """
    spark = df.sparkSession
    if not isinstance(lexicon, DataFrame) and not isinstance(polarity, DataFrame):
        if max(len(d) for d in (lexicon or {}, polarity or {})) <= CONSTANT_WORDS:
            return score_map(df, lexicon, polarity=polarity, text_col=text_col, clean=clean)
    if not isinstance(polarity, DataFrame):
        if isinstance(lexicon, DataFrame) and polarity is None:
            polarity = lexicon.select("token", _polarity(F.col("valence").cast("double")).alias("polarity"))
        else:
            own = word_polarities(lexicon if isinstance(lexicon, dict) else None, polarity)
            polarity = word_table(spark, own, "polarity")
    if not isinstance(lexicon, DataFrame):
        lexicon = lexicon_frame(spark, lexicon)
    both = lexicon.select("token", F.col("valence").cast("double").alias("valence"), F.lit(None).cast("double").alias("polarity")).union(
        polarity.select("token", F.lit(None).cast("double"), F.col("polarity").cast("double"))
    )
    values = both.groupBy("token").agg(F.avg("valence").alias("valence"), F.avg("polarity").alias("polarity"))
    keyed = df.withColumn("_key", F.unhex(F.md5(F.col(text_col))))
    texts = keyed.select("_key", text_col).filter(F.col("_key").isNotNull()).dropDuplicates(["_key"])
    texts = texts.select("_key", tokens(text_col, clean).alias("_toks"))

    def before(i, j):
        return F.when(i >= j, F.try_element_at("_toks", i - j + 1))

    placed = F.transform("_toks", lambda t, i: F.struct(t.alias("token"), *[before(i, j).alias(f"p{j}") for j in (1, 2, 3)]))
    boost, scale = _context(F.col("p1"), F.col("p2"), F.col("p3"))
    # A token's places in one text are one row before any shuffle: v counts v * _f + sign(v) * _b in them.
    met = texts.select("_key", F.inline(placed)).select("_key", "token", scale.alias("f"), (boost * scale).alias("b"))
    met = met.groupBy("_key", "token").agg(F.sum("f").alias("_f"), F.sum("b").alias("_b"), F.count(F.lit(1)).alias("_c"))
    v = F.col("valence")
    sums = met.join(values, "token").groupBy("_key").agg(
        F.sum(v * F.col("_f") + F.signum(v) * F.col("_b")).alias("_s"),
        F.sum(F.col("polarity") * F.col("_c")).alias("_p"),
        F.sum(F.when(F.col("polarity").isNotNull(), F.col("_c"))).alias("_n"),
    )
    zero = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in ("_s", "_p", "_n")}
    cols = _scores_from(zero["_s"], zero["_p"], zero["_n"])
    return keyed.join(sums, "_key", "left").withColumns(cols).drop("_key", "_s", "_p", "_n")


def label(score: Column, threshold: float = 0.1, inclusive: bool = False) -> Column:
    """C4 (strict 0.1) / C6 (inclusive 0.05) label rule."""
    if inclusive:
        return F.when(score >= threshold, "positive").when(score <= -threshold, "negative").otherwise("neutral")
    return F.when(score > threshold, "positive").when(score < -threshold, "negative").otherwise("neutral")


def analyze(
    df: DataFrame,
    *,
    text_col: str = "cleaned_text",
    lexicon: dict[str, float] | DataFrame | None = None,
    polarity: dict[str, float] | DataFrame | None = None,
    clean: bool = False,
) -> DataFrame:
    """Compound, polarity, blended ``sentiment_score``, label and intensity.

    The input is the cleaned text by default (as in the processing job);
    ``clean=True`` cleans it first."""
    return blended(score(df, lexicon, polarity=polarity, text_col=text_col, clean=clean))


def blended(scored: DataFrame) -> DataFrame:
    """The mean of both scores, its label and its intensity."""
    blend = (F.col("vader_compound") + F.col("textblob_sentiment")) / 2.0
    return scored.withColumn("sentiment_score", blend).withColumns(
        {
            "sentiment_label": label(F.col("sentiment_score"), *REVIEW_THRESHOLDS),
            "sentiment_intensity": F.abs(F.col("sentiment_score")),
        }
    )


def tweet_labels(df: DataFrame, *, compound_col: str = "vader_compound") -> DataFrame:
    """Tweet label from the compound score with inclusive 0.05 thresholds."""
    return df.withColumn("sentiment_label", label(F.col(compound_col), *TWEET_THRESHOLDS))
