"""Rule-based sentiment over lexicon tables (C1, C2): phrases, emphasis, contrast and runs of modifiers.

Both scores read words and phrases from tables of any size. Each text's tokens are joined once to the first
words of the entries; an entry of several words holds where the following tokens spell it (an n-gram join without
n-grams of the whole text). At one place the longest entry counts, and an entry that begins inside an earlier one
does not count. Equal texts are scored once, so a text that a third of the rows repeat is one group; windows run
over the entries found in one text, never over rows. Tokens stay where their text is when the table is small enough to
broadcast, which the planner must be able to see: ``sentiment.word_table`` makes such tables of dicts. What an
entry needs of its surroundings is worked out before the windows, so they sort places and numbers, no tokens.

Valence (C1): an entry in capitals, in a text that has both, counts 0.733 more; each of the three tokens before it that
is a booster adds its step (times 1, 0.95, 0.9 with the distance, and 0.733 more in capitals); a negation among them
turns it by -0.74. Entries before the text's first contrast word count half, entries behind it half more. The text's
exclamation and question marks strengthen the sum s, and the score is s / sqrt(s^2 + 15).

Polarity (C2): an entry's polarity is multiplied by the intensities of the run of modifiers directly before it. A negation
directly before that run (or before the entry) turns it by -0.5, and the intensities then divide. Each value stays
within -1..1; the score is their mean.

Null and empty texts score 0. A token that a table lists several times has the mean of its values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossa.functions import text as T
from glossa.operators import sentiment as S

# Fixed values of the published rules.
CAPITALS = 0.733
CONTRAST = (0.5, 1.5)
CONTRAST_WORDS = ("but",)
EXCLAMATION = (0.292, 4)       # each, up to
QUESTION = (0.18, 3, 0.96)     # each from two on, up to; beyond
NEGATED_POLARITY = -0.5
DAMPENERS = ("almost", "barely", "hardly", "kinda", "less", "little", "marginally", "occasionally", "partly", "scarcely", "slightly", "somewhat")
BOOSTERS = {**dict.fromkeys(S.BOOSTERS, S.BOOST), **dict.fromkeys(DAMPENERS, -S.BOOST)}
# Our own intensities of common modifiers.
MODIFIERS = {
    **dict.fromkeys("extremely incredibly absolutely totally completely".split(), 1.5),
    **dict.fromkeys("very really so too super highly especially particularly".split(), 1.3),
    **dict.fromkeys("quite fairly rather pretty".split(), 1.1),
    **dict.fromkeys("somewhat slightly almost little hardly barely".split(), 0.5),
}


def entries(table: DataFrame, token: str, value: str, max_words: int) -> DataFrame:
    """(first, phrase, n, value) of a table of words and phrases, each with the mean of its values."""
    phrase = F.trim(F.regexp_replace(F.lower(F.col(token)), T.WS_RUN_PATTERN, " "))
    found = table.select(phrase.alias("phrase"), F.col(value).cast("double").alias("value")).dropna().where("phrase <> ''")
    words = F.split("phrase", " ")
    found = found.groupBy("phrase").agg(F.avg("value").alias("value"))
    return found.select(words[0].alias("first"), "phrase", F.size(words).alias("n"), "value").where(F.col("n") <= max_words)


def capitals(c: Column) -> Column:
    return (c == F.upper(c)) & (c != F.lower(c))


def distinct_texts(df: DataFrame, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows with ``_key``, one row a text: _key, _text, its cleaned tokens ``_raw``)."""
    keyed = df.withColumn("_key", F.unhex(F.md5(F.col(text_col).cast("binary"))))
    texts = keyed.select("_key", F.col(text_col).alias("_text")).where("_key IS NOT NULL").dropDuplicates(["_key"])
    texts = texts.select("_key", "_text", T.clean_text("_text").alias("_clean"))
    return keyed, texts.select("_key", "_text", F.when(F.col("_clean") == "", F.array().cast("array<string>")).otherwise(F.split("_clean", " ")).alias("_raw"))


def found_entries(texts: DataFrame, table: DataFrame, worth: Mapping[str, Column], max_words: int, *, keep: Sequence[str] = (), context: bool = False) -> DataFrame:
    """The entries that hold in each text: _key, i, n, those columns of ``table`` that order or classify, and ``worth``.

    ``worth`` is computed where an entry is met, from i, ahead, the text's columns ``keep``, those of ``table`` and, with
    ``context``, the three tokens before it, p1..p3.
    """
    raw = F.col("_raw")

    def before(i: Column, j: int) -> Column:
        return F.when(i >= j, F.try_element_at(raw, i - j + 1))

    # Element by element: a slice would copy the whole text's tokens at each of them.
    ahead = lambda t, i: F.array(t, *[F.try_element_at(raw, i + 1 + j) for j in range(1, max_words)])
    place = lambda t, i: F.struct(i.alias("i"), ahead(t, i).alias("ahead"), *[before(i, j).alias(f"p{j}") for j in (1, 2, 3) if context])
    tokens = texts.select("_key", *keep, F.inline(F.transform(raw, place)))
    hits = tokens.join(table, F.lower(F.col("ahead")[0]) == F.col("first")).where(F.lower(F.array_join(F.slice("ahead", 1, F.col("n")), " ")) == F.col("phrase"))
    kind = [c for c in ("kind",) if c in table.columns]
    hits = hits.select("_key", "i", "n", *kind, *[c.alias(name) for name, c in worth.items()])
    w = Window.partitionBy("_key").orderBy(F.col("i"), F.col("n").desc(), *[F.col(c) for c in kind])
    longest = hits.withColumn("_before", F.lag("i").over(w)).where("_before IS NULL OR _before <> i").drop("_before")
    w = Window.partitionBy("_key").orderBy("i")
    covered = F.max(F.col("i") + F.col("n")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return longest.withColumn("_covered", covered).where("_covered IS NULL OR _covered <= i").drop("_covered")


def _within(c: Column, words: Sequence[str]) -> Column:
    return F.coalesce(F.lower(c).isin(*words), F.lit(False))


def _step(p: Column, boosters: Mapping[str, float]) -> Column:
    """A booster token's step, null for other tokens."""
    steps: dict[float, list[str]] = {}
    for word, step in sorted(boosters.items()):
        steps.setdefault(float(step), []).append(word)
    out = F.lit(None).cast("double")
    for step, words in steps.items():
        out = F.when(F.lower(p).isin(*words), step).otherwise(out)
    return out


def valence_scores(
    df: DataFrame,
    lexicon: DataFrame,
    *,
    text_col: str = "cleaned_text",
    boosters: Mapping[str, float] = BOOSTERS,
    negations: Sequence[str] = S.NEGATIONS,
    contrasts: Sequence[str] = CONTRAST_WORDS,
    max_words: int = 3,
    out: str = "vader_compound",
) -> DataFrame:
    """``df`` with the valence score of ``text_col`` by ``lexicon`` (token, valence); tokens may be phrases."""
    keyed, texts = distinct_texts(df, text_col)
    n_caps = F.size(F.filter("_raw", capitals))
    firsts = [F.array_position(F.transform("_raw", F.lower), c) for c in contrasts]
    cut = F.least(*[F.when(p > 0, p - 1) for p in firsts], F.lit(None).cast("bigint")) if firsts else F.lit(None).cast("bigint")
    shouts, asks = T.char_count("_text", "!"), T.char_count("_text", "?")
    marks = F.least(shouts, F.lit(EXCLAMATION[1])) * EXCLAMATION[0] + F.when(asks > QUESTION[1], QUESTION[2]).when(asks > 1, asks * QUESTION[0]).otherwise(0.0)
    texts = texts.withColumns({"mixed": (n_caps > 0) & (n_caps < F.size("_raw")), "cut": cut, "marks": marks})
    value, sign = F.col("value"), F.signum("value")
    spelled = F.array_join(F.slice("ahead", 1, F.col("n")), " ")
    total = value + F.when(F.col("mixed") & capitals(spelled), sign * CAPITALS).otherwise(0.0)
    for j, decay in enumerate(S.BOOST_DECAY, 1):
        p = F.col(f"p{j}")
        step = _step(p, boosters) + F.when(F.col("mixed") & capitals(p), CAPITALS).otherwise(0.0)
        total = total + F.coalesce(sign * step * decay, F.lit(0.0))
    negated = _within(F.col("p1"), negations) | _within(F.col("p2"), negations) | _within(F.col("p3"), negations)
    total = F.when(negated, total * S.NEGATION_SCALAR).otherwise(total)
    total = total * F.when(F.col("i") < F.col("cut"), CONTRAST[0]).when(F.col("i") > F.col("cut"), CONTRAST[1]).otherwise(1.0)
    table = entries(lexicon, "token", "valence", max_words)
    hits = found_entries(texts, table, {"total": total, "marks": F.col("marks")}, max_words, keep=["mixed", "cut", "marks"], context=True)
    sums = hits.groupBy("_key").agg(F.sum("total").alias("s"), F.max("marks").alias("marks"))
    s = F.col("s") + F.signum("s") * F.col("marks")
    scores = sums.select("_key", s.alias("s")).select("_key", (F.col("s") / F.sqrt(F.col("s") * F.col("s") + S.ALPHA)).alias(out))
    return keyed.join(scores, "_key", "left").withColumn(out, F.coalesce(F.col(out), F.lit(0.0))).drop("_key")


def polarity_scores(
    df: DataFrame,
    polarity: DataFrame,
    modifiers: DataFrame,
    *,
    text_col: str = "cleaned_text",
    negations: Sequence[str] = S.NEGATIONS,
    max_words: int = 3,
    out: str = "textblob_sentiment",
) -> DataFrame:
    """``df`` with the mean polarity of ``text_col`` by ``polarity`` (token, polarity) and ``modifiers`` (token, intensity > 0).

    Tokens of both may be phrases. A modifier or negation is no entry of its own.
    """
    spark = df.sparkSession
    keyed, texts = distinct_texts(df, text_col)
    against = S.word_table(spark, dict.fromkeys(negations, 1.0), "value")
    kinds = (("m", modifiers.where("intensity > 0"), "intensity"), ("n", against, "value"), ("p", polarity, "polarity"))
    table = None
    for kind, rows, value in kinds:
        part = entries(rows, "token", value, max_words).withColumn("kind", F.lit(kind))
        table = part if table is None else table.union(part)
    marked = found_entries(texts, table, {"value": F.col("value")}, max_words)
    w = Window.partitionBy("_key").orderBy("i")
    follows = F.coalesce(F.lag(F.col("i") + F.col("n")).over(w) == F.col("i"), F.lit(False))
    last = F.lag("kind").over(w)
    marked = marked.withColumns({"fresh": F.when(follows & (last == "m"), 0).otherwise(1), "after_no": follows & (last == "n")})
    # A run: modifiers one behind the other, and what they stand before.
    marked = marked.withColumn("run", F.sum("fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    in_run = Window.partitionBy("_key", "run").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    power = F.exp(F.sum(F.when(F.col("kind") == "m", F.ln("value")).otherwise(0.0)).over(in_run))
    marked = marked.withColumns({"power": power, "negated": F.first("after_no").over(in_run)})
    turned = F.when(F.col("negated"), F.col("value") * NEGATED_POLARITY / F.col("power")).otherwise(F.col("value") * F.col("power"))
    one = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), turned))
    scores = marked.where("kind = 'p'").groupBy("_key").agg(F.avg(one).alias(out))
    return keyed.join(scores, "_key", "left").withColumn(out, F.coalesce(F.col(out), F.lit(0.0))).drop("_key")


def analyze(
    df: DataFrame,
    *,
    text_col: str = "cleaned_text",
    lexicon: DataFrame | None = None,
    polarity: DataFrame | None = None,
    modifiers: DataFrame | None = None,
) -> DataFrame:
    """C1–C5 by the rules above: both scores, their blend, its label and intensity. Tables default to our own small ones."""
    spark = df.sparkSession
    lexicon = S.word_table(spark, S.DEFAULT_LEXICON, "valence") if lexicon is None else lexicon
    polarity = S.word_table(spark, S.DEFAULT_POLARITY, "polarity") if polarity is None else polarity
    modifiers = S.word_table(spark, MODIFIERS, "intensity") if modifiers is None else modifiers
    scored = polarity_scores(valence_scores(df, lexicon, text_col=text_col), polarity, modifiers, text_col=text_col)
    return S.blended(scored)
