"""Registered queries: cleaning, keyword rules, text features, hashtags, lexicon sentiment."""

from __future__ import annotations

from pyspark.sql import functions as F

from glossa.functions import text as T
from glossa.functions.numeric import r9
from glossa.operators import sentiment as S
from glossa.operators import text as X
from glossa.plans.registry import r9 as q9
from glossa.plans.registry import register
from glossa.session import spread, written
from glossa.sources.fixtures import read_table, view, with_views

# ---------------------------------------------------------------- DuckDB spellings


def sql_clean(c: str) -> str:
    t = f"coalesce(CAST({c} AS VARCHAR), '')"
    t = f"regexp_replace({t}, '{T.URL_PATTERN}', '', 'g')"
    t = f"regexp_replace({t}, '{T.NON_WORD_PATTERN}', ' ', 'g')"
    t = f"regexp_replace({t}, '{T.WS_RUN_PATTERN}', ' ', 'g')"
    return f"trim({t})"


def sql_chars(c: str, ch: str) -> str:
    return f"(length({c}) - length(replace({c}, '{ch}', '')))"


def sql_words(c: str) -> str:
    return f"CAST(len(regexp_extract_all(coalesce({c}, ''), '{T.TOKEN_PATTERN}')) AS BIGINT)"


def sql_features(c: str, prefix: str = "text_") -> str:
    w = sql_words(c)
    nonspace = f"length(regexp_replace(coalesce({c}, ''), '[{T.WS}]', '', 'g'))"
    punct = f"({sql_chars(c, '.')} + {sql_chars(c, '!')} + {sql_chars(c, '?')})"
    return f"""{w} AS {prefix}word_count,
       CAST(CASE WHEN {punct} = 0 AND {w} > 0 THEN 1 ELSE {punct} END AS BIGINT) AS {prefix}sentence_count,
       {q9(f'CASE WHEN {w} > 0 THEN {nonspace} / {w} ELSE 0.0 END')} AS {prefix}avg_word_length,
       CAST({sql_chars(c, '!')} AS BIGINT) AS {prefix}exclamation_count,
       CAST({sql_chars(c, '?')} AS BIGINT) AS {prefix}question_count,
       CAST(length({c}) AS BIGINT) AS {prefix}length"""


def _sql_any(c: str, kws) -> str:
    return "(" + " OR ".join(f"contains(lower({c}), '{k}')" for k in kws) + ")"


def sql_first_rule(c: str, rules, default: str) -> str:
    return "CASE " + " ".join(f"WHEN {_sql_any(c, kws)} THEN '{lab}'" for lab, kws in rules) + f" ELSE '{default}' END"


def sql_all_rules(c: str, rules, limit: int) -> str:
    arr = "[" + ", ".join(f"CASE WHEN {_sql_any(c, kws)} THEN '{lab}' END" for lab, kws in rules) + "]"
    return f"array_to_string(list_filter({arr}, lambda x: x IS NOT NULL)[1:{limit}], ',')"


def _sql_in(c: str, words) -> str:
    return f"coalesce({c} IN (" + ", ".join(f"'{w}'" for w in words) + "), false)"


def sql_sentiment_ctes(source: str, id_cols: str, text_col: str, lexicon: str | None = None) -> str:
    """CTEs computing ``vader_compound`` / ``textblob_sentiment`` per row of ``source``."""
    rows = sorted({*S.DEFAULT_LEXICON, *S.DEFAULT_POLARITY})
    values = [(w, S.DEFAULT_LEXICON.get(w, "NULL"), S.DEFAULT_POLARITY.get(w, "NULL")) for w in rows]
    lex = lexicon or "VALUES " + ", ".join(f"('{w}', {v}::DOUBLE, {q}::DOUBLE)" for w, v, q in values)
    ids = [c.strip() for c in id_cols.split(",")]
    id_eq = " AND ".join(f"s.{c} = src.{c}" for c in ids)
    boost = " + ".join(
        f"CASE WHEN {_sql_in(p, S.BOOSTERS)} THEN {S.BOOST * d} ELSE 0.0 END"
        for p, d in zip(("p1", "p2", "p3"), S.BOOST_DECAY)
    )
    neg = " OR ".join(_sql_in(p, S.NEGATIONS) for p in ("p1", "p2", "p3"))
    return f"""src AS (SELECT {id_cols}, {sql_clean(text_col)} AS _c FROM {source}),
tok AS (SELECT {id_cols}, CASE WHEN lower(_c) = '' THEN []::VARCHAR[] ELSE string_split(lower(_c), ' ') END AS toks FROM src),
ex AS (SELECT {id_cols}, unnest(toks) AS t, unnest(generate_series(1, len(toks))) AS pos FROM tok),
ctx AS (SELECT {id_cols}, t, lag(t, 1) OVER w AS p1, lag(t, 2) OVER w AS p2, lag(t, 3) OVER w AS p3
        FROM ex WINDOW w AS (PARTITION BY {id_cols} ORDER BY pos)),
lex(token, valence, polarity) AS ({lex}),
hit AS (SELECT ctx.*, lex.valence AS v, lex.polarity AS q FROM ctx JOIN lex ON lex.token = ctx.t),
adj AS (SELECT {id_cols}, q, (v + sign(v) * ({boost})) * CASE WHEN {neg} THEN {S.NEGATION_SCALAR} ELSE 1.0 END AS a
        FROM hit),
agg AS (SELECT {id_cols}, sum(a) AS s, sum(q) AS ps, count(q) AS n FROM adj GROUP BY {id_cols}),
scored AS (SELECT src.*, coalesce(s.s, 0.0) / sqrt(coalesce(s.s, 0.0) * coalesce(s.s, 0.0) + {S.ALPHA}) AS vader_compound,
                  CASE WHEN coalesce(s.n, 0) > 0 THEN s.ps / s.n ELSE 0.0 END AS textblob_sentiment
           FROM src LEFT JOIN agg s ON {id_eq})"""


# ---------------------------------------------------------------- builders


def documents(spark, sf_dir):
    return spread(read_table(spark, sf_dir, "documents"))


def cleaned_documents(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", "text", T.clean_text("text").alias("cleaned_text"))


@register(
    "clean_text",
    covers="B3",
    oracle=f"SELECT doc_id, {sql_clean('text')} AS cleaned_text FROM documents",
)
def clean_text(spark, sf_dir):
    return cleaned_documents(spark, sf_dir).select("doc_id", "cleaned_text")




@register(
    "review_cleaning",
    covers="B1 B2 B3 B4 B6 B7 B8",
    oracle=with_views(
        f"""SELECT conv_id, turn, cleaned_text, round_even(TRY_CAST(rating AS DOUBLE) * 10.0, 0) / 10.0 AS rating,
       TRY_CAST(submission_time AS TIMESTAMP) AS review_date
FROM (SELECT *, {sql_clean('review_text')} AS cleaned_text FROM raw_reviews_v) r
WHERE rating IS NOT NULL AND length(cleaned_text) > 5 AND TRY_CAST(rating AS DOUBLE) BETWEEN 1 AND 5
  AND TRY_CAST(submission_time AS TIMESTAMP) IS NOT NULL""",
        "raw_reviews_v",
    ),
)
def review_cleaning(spark, sf_dir):
    raw = view(spark, sf_dir, "raw_reviews_v")
    # Wall-clock timestamps (no zone), like the source strings.
    return X.clean_reviews(raw).select(
        "conv_id", "turn", "cleaned_text", "rating", F.col("review_date").cast("timestamp_ntz").alias("review_date")
    )


@register(
    "rating_clean",
    covers="B6",
    oracle=with_views(
        """SELECT conv_id, turn, round_even(TRY_CAST(rating AS DOUBLE) * 10.0, 0) / 10.0 AS rating
FROM raw_reviews_v WHERE TRY_CAST(rating AS DOUBLE) BETWEEN 1 AND 5""",
        "raw_reviews_v",
    ),
)
def rating_clean(spark, sf_dir):
    raw = view(spark, sf_dir, "raw_reviews_v").select("conv_id", "turn", "rating")
    return X.clean_rating(raw)


@register(
    "cleaning_retention",
    covers="B5",
    oracle=with_views(
        f"""SELECT count(*) AS initial_rows,
       count(*) FILTER (WHERE rating IS NOT NULL AND length({sql_clean('review_text')}) > 5) AS kept_rows,
       {q9(f"count(*) FILTER (WHERE rating IS NOT NULL AND length({sql_clean('review_text')}) > 5) * 100.0 / count(*)")} AS kept_pct
FROM raw_reviews_v""",
        "raw_reviews_v",
    ),
)
def cleaning_retention(spark, sf_dir):
    r = X.retention(view(spark, sf_dir, "raw_reviews_v"))
    return r.withColumn("kept_pct", r9("kept_pct"))


@register(
    "text_features",
    covers="B13 B14",
    oracle=f"""SELECT doc_id, {sql_features('c')}
FROM (SELECT doc_id, {sql_clean('text')} AS c FROM documents) d""",
)
def text_features(spark, sf_dir):
    f = X.text_features(cleaned_documents(spark, sf_dir), text_col="cleaned_text")
    return f.select(
        "doc_id",
        "text_word_count",
        "text_sentence_count",
        r9("text_avg_word_length").alias("text_avg_word_length"),
        "text_exclamation_count",
        "text_question_count",
        "text_length",
    )


@register(
    "text_features_raw",
    covers="B13",
    oracle=f"SELECT doc_id, {sql_features('text', 'raw_')} FROM documents",
)
def text_features_raw(spark, sf_dir):
    f = X.text_features(documents(spark, sf_dir), text_col="text", prefix="raw_")
    return f.select(
        "doc_id",
        "raw_word_count",
        "raw_sentence_count",
        r9("raw_avg_word_length").alias("raw_avg_word_length"),
        "raw_exclamation_count",
        "raw_question_count",
        "raw_length",
    )


@register(
    "keyword_category",
    covers="B9 B10",
    oracle=f"""SELECT doc_id, {sql_first_rule('c', X.CATEGORY_RULES, X.CATEGORY_DEFAULT)} AS primary_category,
       'General' AS secondary_category
FROM (SELECT doc_id, {sql_clean('text')} AS c FROM documents) d""",
)
def keyword_category(spark, sf_dir):
    return X.categorize(cleaned_documents(spark, sf_dir)).select("doc_id", "primary_category", "secondary_category")


@register(
    "keyword_skin_type",
    covers="B11",
    oracle=f"""SELECT doc_id, {sql_first_rule('c', X.SKIN_RULES, X.SKIN_DEFAULT)} AS inferred_skin_type
FROM (SELECT doc_id, {sql_clean('text')} AS c FROM documents) d""",
)
def keyword_skin_type(spark, sf_dir):
    return X.keyword_insights(cleaned_documents(spark, sf_dir)).select("doc_id", "inferred_skin_type")


@register(
    "main_concerns",
    covers="B12",
    oracle=f"""SELECT doc_id, {sql_all_rules('c', X.CONCERN_RULES, X.MAX_CONCERNS)} AS main_concerns
FROM (SELECT doc_id, {sql_clean('text')} AS c FROM documents) d""",
)
def main_concerns(spark, sf_dir):
    k = X.keyword_insights(cleaned_documents(spark, sf_dir))
    return k.select("doc_id", F.array_join("main_concerns", ",").alias("main_concerns"))


@register(
    "extract_hashtags",
    covers="B15 B16",
    oracle=f"""SELECT doc_id,
       array_to_string(regexp_extract_all(coalesce(text, ''), '{T.HASHTAG_PATTERN}', 1), ',') AS hashtags,
       array_to_string(regexp_extract_all(coalesce(text, ''), '{T.MENTION_PATTERN}', 1), ',') AS mentions
FROM documents""",
)
def extract_hashtags(spark, sf_dir):
    d = documents(spark, sf_dir)
    return d.select(
        "doc_id",
        F.array_join(T.hashtags("text"), ",").alias("hashtags"),
        F.array_join(T.mentions("text"), ",").alias("mentions"),
    )


SENTIMENT_SELECT = f"""SELECT doc_id, {q9('vader_compound')} AS vader_compound, {q9('textblob_sentiment')} AS textblob_sentiment,
       {q9('(vader_compound + textblob_sentiment) / 2')} AS sentiment_score,
       CASE WHEN (vader_compound + textblob_sentiment) / 2 > 0.1 THEN 'positive'
            WHEN (vader_compound + textblob_sentiment) / 2 < -0.1 THEN 'negative' ELSE 'neutral' END AS sentiment_label,
       {q9('abs((vader_compound + textblob_sentiment) / 2)')} AS sentiment_intensity
FROM scored"""

# A lexicon of the corpus' own words, tens of thousands of them at scale: the valence follows from the word's length.
WORD_LEXICON = """SELECT token, CAST(length(token) % 9 - 4 AS DOUBLE) AS valence, CAST(length(token) % 5 - 2 AS DOUBLE) / 2 AS polarity
FROM (SELECT DISTINCT unnest(string_split(lower({clean}), ' ')) AS token FROM documents) WHERE token <> ''"""


@register("lexicon_sentiment", covers="C1 C2 C3 C4 C5", oracle=f"WITH {sql_sentiment_ctes('documents', 'doc_id', 'text')} {SENTIMENT_SELECT}")
def lexicon_sentiment(spark, sf_dir):
    return _sentiment(cleaned_documents(spark, sf_dir))


def _sentiment(docs, **lexicons):
    s = S.analyze(docs, text_col="cleaned_text", **lexicons)
    return s.select(
        "doc_id",
        *[r9(c).alias(c) for c in ("vader_compound", "textblob_sentiment", "sentiment_score")],
        "sentiment_label",
        r9("sentiment_intensity").alias("sentiment_intensity"),
    )


@register(
    "lexicon_sentiment_large",
    covers="C1 C2",
    oracle=f"WITH {sql_sentiment_ctes('documents', 'doc_id', 'text', WORD_LEXICON.format(clean=sql_clean('text')))} {SENTIMENT_SELECT}",
)
def lexicon_sentiment_large(spark, sf_dir):
    docs = cleaned_documents(spark, sf_dir)
    # Stored: both lexicons read it, and the planner knows its size.
    words = written(docs.select(F.explode(S.tokens("cleaned_text", clean=False)).alias("token")).distinct(), "lexicon-words")
    n = F.length("token")
    polarity = words.select("token", ((n % 5 - 2).cast("double") / 2).alias("polarity"))
    return _sentiment(docs, lexicon=words.select("token", (n % 9 - 4).cast("double").alias("valence")), polarity=polarity)


@register(
    "tweet_sentiment_label",
    covers="C6",
    oracle=f"""WITH {sql_sentiment_ctes('conversations', 'conv_id, turn', 'text')}
SELECT conv_id, turn, {q9('vader_compound')} AS vader_compound,
       CASE WHEN vader_compound >= 0.05 THEN 'positive' WHEN vader_compound <= -0.05 THEN 'negative'
            ELSE 'neutral' END AS sentiment_label
FROM scored""",
)
def tweet_sentiment_label(spark, sf_dir):
    conv = read_table(spark, sf_dir, "conversations")
    scored = S.score(conv, text_col="text")
    return S.tweet_labels(scored).select("conv_id", "turn", r9("vader_compound").alias("vader_compound"), "sentiment_label")


@register(
    "tweet_preview",
    covers="B21",
    oracle="""SELECT conv_id, turn, CASE WHEN length(text) > 300 THEN substring(text, 1, 300) || '...' ELSE text END AS preview
FROM conversations""",
)
def tweet_preview(spark, sf_dir):
    conv = read_table(spark, sf_dir, "conversations")
    return conv.select("conv_id", "turn", T.preview("text", 300).alias("preview"))


@register(
    "text_length_stats",
    covers="F31",
    oracle=f"""SELECT {q9('avg(length(c))')} AS avg_length, CAST(max(length(c)) AS INTEGER) AS max_length,
       count(*) FILTER (WHERE length(c) < 10) AS n_short, count(*) FILTER (WHERE length(c) > 1000) AS n_long
FROM (SELECT {sql_clean('text')} AS c FROM documents) d""",
)
def text_length_stats(spark, sf_dir):
    from glossa.operators import quality

    s = quality.text_length_stats(cleaned_documents(spark, sf_dir), text_col="cleaned_text")
    return s.withColumn("avg_length", r9("avg_length"))


@register(
    "tweet_engagement",
    covers="B17 B18",
    oracle=with_views(
        """SELECT tweet_id, CAST(created_at AS DATE) AS date,
       CAST(like_count + 2 * retweet_count + 1.5 * reply_count AS DOUBLE) AS weighted_engagement,
       CAST(like_count + retweet_count + reply_count AS DOUBLE) AS engagement, 1 AS mention_volume
FROM tweet_payload_v""",
        "tweet_payload_v",
    ),
)
def tweet_engagement(spark, sf_dir):
    from glossa.operators import social

    t = view(spark, sf_dir, "tweet_payload_v")
    w = social.weighted_engagement(t)
    return social.plain_engagement(w).select("tweet_id", "date", "weighted_engagement", "engagement", "mention_volume")
