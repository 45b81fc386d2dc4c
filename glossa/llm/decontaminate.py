"""Operator 8: benchmark decontamination by a prefix-filtered set join.

An item's windows are its runs of ``window`` consecutive words (an item of fewer words is one
window). A window's tokens are its word shingles; for containment every token is needed,
so the necessary prefix is one token: the rarest, by its count over all documents. Only
the documents' occurrences of prefix tokens are joined to the windows that they stand for.
The token's place in the window gives the start of the candidate; the positional and length
bounds drop those that would begin before the text or end after it, and the words
there are compared with the window's. Everything is DataFrame operations on strings.

The tables of tokens and prefixes are written first, so the planner knows their size and
broadcasts them only below ``spark.sql.autoBroadcastJoinThreshold``; beyond it the same join
shuffles. The document side explodes to one row per word, but no row carries the text:
candidates go back to their texts by the row's key.

Defined cases: a null or empty text has no words, is not hit, and as an item has no
window. Rows are told apart by id and text: equal rows get equal results, each its own row;
a null id is a row like others. Items that repeat an id count once in ``n_items``; items
without an id are searched for and hit, but cannot be listed. Empty tables give no rows, or
no hits. Only ``doc_id``, ``item_id`` and ``text`` are read; ``hits`` keeps all columns of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossa.llm.common import ascii_lower, row_key, stored

#: What parts words, after lower-casing A-Z.
BREAKS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: Words of a shingle; a window of fewer words is one shingle.
SHINGLE = 3


def words(text: str) -> Column:
    return F.filter(F.split(ascii_lower(text), BREAKS), lambda w: w != "")


def shingles(words: str, size: int) -> Column:
    """All runs of ``size`` words of an array column, as an array of structs."""
    n = F.greatest(F.lit(0), F.size(words) - (size - 1))
    return F.slice(F.arrays_zip(*[F.slice(words, k + 1, F.greatest(F.lit(1), F.size(words))).alias(f"w{k}") for k in range(size)]), F.lit(1), n)


def windows(items: DataFrame, window: int) -> DataFrame:
    """(item_id, win): the distinct windows of every item, win an array of words."""
    of = items.select("item_id", words("text").alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (window - 1)))
    return of.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, window))).alias("win")).distinct()


def exploded(frame: DataFrame, columns: list[str], array: str, sizes: list[int]) -> DataFrame:
    """One row per shingle of the given sizes: columns, pos and the token, a hash (occurrences are compared by words)."""
    parts = []
    for size in sizes:
        rows = frame.select(*columns, array).select(*columns, F.posexplode(shingles(array, size)).alias("pos", "s"))
        parts.append(rows.select(*columns, "pos", F.xxhash64(*[f"s.w{k}" for k in range(size)]).alias("token")))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def prefixes(docs: DataFrame, wins: DataFrame, sizes: list[int]) -> DataFrame:
    """(token, at, wid, n): each window's rarest token, where it stands in the window, and the window's words."""
    sized = wins.withColumn("size", F.size("win"))
    parts = [exploded(sized.where(F.least("size", F.lit(SHINGLE)) == size), ["wid", "size"], "win", [size]) for size in sizes]
    tokens = parts[0]
    for part in parts[1:]:
        tokens = tokens.union(part)
    vocabulary = stored(tokens.select("token").distinct(), "leak-tokens")
    seen = exploded(docs.select(words("text").alias("w")), [], "w", sizes)
    counts = seen.join(vocabulary, "token").groupBy("token").agg(F.count("*").alias("n"))
    rare = Window.partitionBy("wid").orderBy(F.coalesce("n", F.lit(0)), "token", "pos")
    # A window whose rarest token occurs nowhere cannot occur: it needs no join.
    ranked = tokens.join(counts, "token", "left").withColumn("k", F.row_number().over(rare)).where("k = 1 AND n > 0")
    return stored(ranked.select("token", F.col("pos").alias("at"), "wid", F.col("size").alias("words")), "leak-prefixes")


def matches(docs: DataFrame, items: DataFrame, window: int = 10) -> tuple[DataFrame, DataFrame]:
    """(key, start, n, wid): occurrences of windows in rows of documents; and (wid, item_id)."""
    pairs = stored(windows(items, window).withColumn("wid", F.xxhash64("win")), "leak-windows")
    wins = pairs.select("wid", "win").distinct()
    # One, two or three: the sizes that the windows need.
    sizes = [r[0] for r in wins.select(F.least(F.size("win"), F.lit(SHINGLE)).alias("s")).distinct().orderBy("s").collect()]
    if not sizes:
        empty = docs.limit(0).select(row_key().alias("key"), F.lit(0).alias("start"), F.lit(0).alias("n"), F.lit(0).cast("long").alias("wid"))
        return empty, pairs.select("wid", "item_id")
    first = prefixes(docs, wins, sizes)
    texts = docs.select(row_key().alias("key"), words("text").alias("w")).where(F.size("w") > 0)
    tokens = exploded(texts.withColumn("size", F.size("w")), ["key", "size"], "w", sizes)
    found = tokens.join(first, "token").select("key", (F.col("pos") - F.col("at")).alias("start"), F.col("words").alias("n"), "wid", "size")
    # A row's candidates are combined before they meet its text.
    listed = found.where("start >= 0 AND start + n <= size").groupBy("key").agg(F.collect_set(F.struct("start", "n", "wid")).alias("c"))
    there = docs.select(row_key().alias("key"), "text").join(listed, "key").select("key", words("text").alias("w"), "c")
    there = there.select("key", "w", F.explode("c").alias("c")).select("key", "c.*", F.expr("slice(w, c.start + 1, c.n)").alias("have"))
    exact = there.join(wins, "wid").where("have = win").select("key", "start", "n", "wid").distinct()
    return stored(exact, "leak-matches"), pairs.select("wid", "item_id")


def hits(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """``docs`` with ``leak_words``, ``leak_hit`` (words inside an occurrence) and ``leak_items`` (their ids, as sorted strings)."""
    found, of = matches(docs.select("doc_id", "text"), items.select("item_id", "text"), window)
    # Occurrences that begin at one word are one interval; the rest overlap by their order.
    spans = found.groupBy("key", "start").agg(F.max(F.col("start") + F.col("n")).alias("end"))
    before = Window.partitionBy("key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("from", F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0))))
    n_hit = spans.groupBy("key").agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.col("from"))).alias("leak_hit"))
    ids = found.select("key", "wid").distinct().join(of, "wid").where("item_id IS NOT NULL")
    ids = ids.select("key", F.col("item_id").cast("string").alias("item")).distinct()
    ids = ids.groupBy("key").agg(F.sort_array(F.collect_list("item")).alias("leak_items"))
    both = n_hit.join(ids, "key", "left").withColumnRenamed("key", "leak_key")
    old = docs.drop("leak_words", "leak_hit", "leak_items", "leak_key")
    marked = old.withColumn("leak_key", row_key()).withColumn("leak_words", F.size(words("text")).cast("long")).join(both, "leak_key", "left").drop("leak_key")
    return marked.withColumn("leak_hit", F.coalesce("leak_hit", F.lit(0)).cast("long")).withColumn("leak_items", F.coalesce("leak_items", F.array().cast("array<string>")))


def clean(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """``docs`` without the rows that hold a window."""
    found, _ = matches(docs.select("doc_id", "text"), items.select("item_id", "text"), window)
    keyed = docs.withColumn("leak_row", F.struct(F.struct("*").alias("row"), row_key().alias("key")))
    keys = found.select("key").distinct()
    return keyed.select("leak_row.*").join(keys, "key", "left_anti").select("row.*")
