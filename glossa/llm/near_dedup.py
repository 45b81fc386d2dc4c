"""Operator 7: near-duplicates by b-bit MinHash, confirmed on full shingle sets.

One pass over the texts gives each row its class (equal word sequences are one class), its
number of distinct shingles and, from ``BANDS * ROWS`` minima, its band keys. From then on
only classes that share a band key with another matter: for these, their full sets are kept, and a
signature of the ``BITS`` low bits of ``HASHES`` minima, packed into longs.

Candidates come from the buckets of equal band keys. A pair's similarity is estimated from
the number of equal ``BITS``-bit fields (xor, fold, count bits), corrected for fields that agree by
chance; a pair whose estimate lies ``SIGMAS`` standard deviations under the threshold is dropped
and every other one is confirmed on the full sets. A bucket's pairs are not all made: first a bucket's
centres (the smallest members under ``CENTRES`` orders) are compared with the others, and what links
joins one component. Then all members of a bucket that are still in different
components meet, each pair in the first bucket that it shares; the estimate is part of that
join's condition. A crowded bucket is dealt into blocks of about ``BLOCK`` classes, and pairs of blocks
meet under keys of their own, so that no task compares a bucket whole. (Further bands would not
thin such a bucket: 2-bit fields that catch pairs at 0.75 catch most of those at 0.6 too, and
comparing two signatures is as cheap.) So every pair that shares
a bucket is either confirmed, refused or known to be in one component, and components are exact
over the candidates. A pair at the threshold shares no band with probability
(1 - 0.75 ** 4) ** 32 = 5e-6.

Defined cases: null and word-free texts have no shingles and link with nothing. Rows are
told apart by their words: rows of equal words are one class whatever their ids, so repeated
rows have equal results. A null id never names a component while another id can. An empty
table gives no rows. Only ``doc_id`` and ``text`` are read; ``survivors`` keeps all columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import connected_components, row_key, stored

BANDS, ROWS, BITS, HASHES = 32, 4, 2, 1024
LONGS = HASHES * BITS // 64
SIGMAS = 4.5
KNOWN_WORDS = 1_000_000
#: Orders in which a bucket's smallest member is a centre.
CENTRES = 4
#: Classes of a crowded bucket that meet under one key, about.
BLOCK = 512

U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(33))) * U(0xFF51AFD7ED558CCD)
    return h ^ (h >> U(29))


class Words(dict):
    """Hashes of words, kept while a task meets them again."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_hashes(text: str | None, size: int, known: Words) -> tuple[int, np.ndarray]:
    """(class, distinct shingle hashes) of a text; the class is a hash of its word sequence."""
    import xxhash

    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0, np.empty(0, U)
    if len(known) > KNOWN_WORDS:
        known.clear()
    h = np.fromiter((known[w] for w in words), U, len(words))
    n = min(size, len(words))
    out = np.full(len(words) - n + 1, n, U)
    for k in range(n):
        out = out * U(0x9E3779B97F4A7C15) + h[k : len(words) - n + 1 + k]
    return xxhash.xxh3_64_intdigest(b" ".join(words)), np.unique(mix(out))


def minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    low = np.full(len(a), np.iinfo(U).max, U)
    for k in range(0, len(shingles), 1024):  # a long text a slice at a time
        part = shingles[None, k : k + 1024] ^ b[:, None]
        part *= a[:, None]
        np.minimum(low, part.min(axis=1), out=low)
    return low


def orders(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and masks of ``n`` hash orders; the same in every task."""
    rng = np.random.default_rng(20240607 + n)
    return rng.integers(0, 1 << 63, n, dtype=U) * U(2) + U(1), rng.integers(0, 1 << 63, n, dtype=U)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The low bits of all minima, packed."""
    place = (np.arange(HASHES) % (64 // BITS) * BITS).astype(U)
    kept = (mix(minima(shingles, a, b)) & U((1 << BITS) - 1)) << place
    return signed(np.bitwise_or.reduce(kept.reshape(LONGS, -1), axis=1))


def banded(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, h and c (the row's key), node (class), n_shingles and bands (bucket keys) of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = orders(BANDS * ROWS)
        known = Words()
        for batch in batches:
            nodes, counts, bands = [], [], []
            for text in batch["text"]:
                node, shingles = shingle_hashes(text if isinstance(text, str) else None, size, known)
                counts.append(len(shingles))
                if not len(shingles):
                    nodes.append(None), bands.append(None)
                    continue
                low = minima(shingles, a, b)
                keys = np.arange(BANDS, dtype=U) + U(1)
                for k in range(ROWS):
                    keys = mix(keys * U(0x9E3779B97F4A7C15) + low[k::ROWS])
                bands.append(signed(keys))
                nodes.append(int(np.uint64(node).astype(np.int64)))
            out = {"doc_id": batch["doc_id"].astype("Int64"), "h": batch["h"], "c": batch["c"]}
            yield pd.DataFrame(out | {"node": pd.array(nodes, "Int64"), "n_shingles": counts, "bands": bands})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", row_key().alias("key")).select("doc_id", "text", "key.*")
    return rows.mapInPandas(run, "doc_id long, h long, c long, node long, n_shingles long, bands array<long>")


def shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """(node, shingles, sig): the full set of each class that ``docs`` holds, and its signature."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = orders(HASHES)
        known = Words()
        for batch in batches:
            found = [shingle_hashes(t if isinstance(t, str) else None, size, known) for t in batch["text"]]
            found = [(n, s) for n, s in found if len(s)]
            nodes = [int(np.uint64(n).astype(np.int64)) for n, _ in found]
            yield pd.DataFrame({"node": nodes, "shingles": [signed(s) for _, s in found], "sig": [signature(s, a, b) for _, s in found]})

    return docs.select("text").mapInPandas(run, "node long, shingles array<long>, sig array<long>")


def least_equal(threshold: float, fields: int) -> int:
    """Equal fields of ``fields`` that a pair at the threshold shows, less ``SIGMAS`` standard deviations.

    Fields of different minima agree with probability 2 ** -BITS, so the expected share of equal
    fields is c + (1 - c) * similarity with c that chance.
    """
    c = 2.0**-BITS
    share = c + (1 - c) * threshold
    return int(fields * share - SIGMAS * (fields * share * (1 - share)) ** 0.5)


def equal_fields(x: str, y: str, first: int, last: int) -> Column:
    """How many BITS-bit fields of two packed signatures are equal, from their long ``first`` up to ``last``."""
    ones = sum(1 << k for k in range(0, 64, BITS))
    out = F.lit((last - first) * 64 // BITS)
    for k in range(first, last):
        differ = F.col(f"{x}.sig")[k].bitwiseXOR(F.col(f"{y}.sig")[k])
        folded = differ
        for shift in range(1, BITS):
            folded = folded.bitwiseOR(F.shiftrightunsigned(differ, shift))
        out = out - F.bit_count(folded.bitwiseAND(F.lit(ones)))
    return out


def may_link(x: str, y: str, threshold: float) -> Column:
    """Whether the estimate allows a link; a first quarter of the fields settles the clear cases."""
    quarter = LONGS // 4
    part = equal_fields(x, y, 0, quarter) >= least_equal(threshold, HASHES // 4)
    return part & (equal_fields(x, y, 0, LONGS) >= least_equal(threshold, HASHES))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets meet ``100 * intersection >= percent * union``."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(one, "a").join(two, "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.where(100 * shared >= percent * (F.size("sa") + F.size("sb") - shared)).select("a", "b")


def labelled(nodes: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    """``nodes`` with the component of each."""
    found = connected_components(edges, name).withColumnRenamed("component", "label")
    return nodes.join(found, "node", "left").withColumn("label", F.coalesce("label", "node"))


def components(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """doc_id, h, c, n_shingles, component_id and label (a component's smallest class; null without shingles) of every row."""
    docs = docs.select("doc_id", "text")
    rows = stored(banded(docs, size), "bands")
    classes = stored(rows.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("low"), F.first("bands").alias("bands")), "classes")
    keyed = classes.select("node", F.posexplode("bands").alias("band", "bucket"))
    full = keyed.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi").select("bucket")
    members = stored(keyed.join(full, "bucket"), "members")
    nodes = stored(classes.join(members.select("node").distinct(), "node", "left_semi"), "candidates")
    # The texts of candidate classes only; any text of a class will do.
    ids = rows.join(nodes.select("node"), "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    wanted = ids.select("doc_id").distinct()
    texts = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["doc_id"]), "left_semi")
    sets = stored(shingle_sets(texts, size).join(nodes.select("node"), "node", "left_semi").dropDuplicates(["node"]), "shingle-sets")

    threshold = percent / 100
    # Centres of a bucket under several orders of nodes, each the same in all buckets.
    orders_ = [F.min(F.struct(F.xxhash64("node", F.lit(k)).alias("h"), F.col("node").alias("node")))["node"].alias(f"c{k}") for k in range(CENTRES)]
    centres = members.groupBy("bucket").agg(*orders_).select("bucket", F.explode(F.array(*[f"c{k}" for k in range(CENTRES)])).alias("centre")).distinct()
    stars = members.join(centres, "bucket").where("node <> centre").select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b"))
    links = stored(confirmed(screened(stars.distinct(), sets, threshold), sets, percent), "star-links")
    labels = stored(labelled(sets.select("node", "sig"), links, "star-components"), "star-labels")
    rest = stored(confirmed(remaining(members, nodes, labels, threshold), sets, percent), "other-links")
    # Those links join components: what they connect is a small graph of labels.
    of = labels.select("node", "label")
    joined = rest.join(of.select(F.col("node").alias("a"), F.col("label").alias("x")), "a").join(of.select(F.col("node").alias("b"), F.col("label").alias("y")), "b")
    met = connected_components(joined.select(F.col("x").alias("a"), F.col("y").alias("b")), "components").select(F.col("node").alias("label"), "component")
    label = of.join(met, "label", "left").select("node", F.coalesce("component", "label").alias("label")).join(nodes.select("node", "low"), "node")
    least = label.groupBy("label").agg(F.min("low").alias("component_id"))
    named = stored(label.join(least, "label").select("node", "label", "component_id"), "named")
    own = classes.select("node", "low").join(named, "node", "left")
    own = own.select("node", F.coalesce("label", "node").alias("label"), F.coalesce("component_id", "low").alias("component_id"))
    out = rows.select("doc_id", "h", "c", "node", "n_shingles").join(own, "node", "left")
    return out.select("doc_id", "h", "c", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "label")


def remaining(members: DataFrame, nodes: DataFrame, labels: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) that share a bucket, are in different components and may link by the estimate, each once."""
    one = members.join(labels.select("node", "label"), "node")
    mixed = one.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("size")).where("lo <> hi")
    one = one.join(mixed.select("bucket", F.ceil(F.col("size") / BLOCK).alias("blocks")), "bucket").select("node", "band", "bucket", "blocks")
    one = stored(one.join(labels, "node").join(nodes.select("node", "bands"), "node"), "unsettled")
    x, y = dealt(one, "i", "j").alias("x"), dealt(one, "j", "i").alias("y")
    # Band keys of different bands differ, so the bands before this one overlap if an earlier bucket is shared.
    earlier = F.arrays_overlap(F.slice("x.bands", F.lit(1), F.col("x.band")), F.slice("y.bands", F.lit(1), F.col("y.band")))
    same = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.i") == F.col("y.i")) & (F.col("x.j") == F.col("y.j"))
    meet = same & (F.col("x.label") < F.col("y.label")) & may_link("x", "y", threshold) & ~earlier
    return x.join(y, meet).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
    """Each row with the number of its block within its bucket (``own``), once for every block (``other``)."""
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    return rows.select("*", block.alias(own), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias(other))


def screened(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose estimate allows a link."""
    x, y = sets.select("node", "sig").alias("x"), sets.select("node", "sig").alias("y")
    one = pairs.join(x, F.col("a") == F.col("x.node"))
    return one.join(y, (F.col("b") == F.col("y.node")) & may_link("x", "y", threshold)).select("a", "b")


def survivors(docs: DataFrame, size: int = 5, percent: int = 75) -> DataFrame:
    """``docs`` with one row of each component; rows without shingles all stay.

    The row that stays has the smallest id of its component, a null id being the largest.
    """
    found = components(docs, size, percent)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "h", "c"))
    keep = found.where("label IS NOT NULL").groupBy("label").agg(first.alias("r")).select("r.h", "r.c", F.lit(False).alias("empty"))
    keep = keep.union(found.where("label IS NULL").select("h", "c", F.lit(True)).distinct())
    keep = stored(keep.select(F.struct("h", "c").alias("key"), "empty"), "survivors")
    both = docs.select(F.struct("*").alias("row"), row_key().alias("key")).join(keep, "key")
    # Equal rows of one key leave one; rows without shingles get a turn each and all stay.
    turn = F.when(F.col("empty"), F.monotonically_increasing_id()).otherwise(F.lit(-1))
    return both.withColumn("turn", turn).dropDuplicates(["key", "turn"]).select("row.*")
