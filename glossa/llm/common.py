"""Small helpers the operators share: stored tables, row keys and connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder of ``spark.checkpoint.dir`` and read it back.

    This cuts the lineage (a lost executor rereads the table) and gives the planner the
    table's true size, by which it picks or refuses a broadcast.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/glossa-llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column | str) -> Column:
    """Lower-case A-Z only; null becomes the empty text."""
    return F.translate(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), UPPER, UPPER.lower())


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A row's key: 96 bits of hashes over id and text, the same for equal rows."""
    return F.struct(F.xxhash64(doc_id, text).alias("h"), F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("c"))


def crc_bucket(doc_id: Column | str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def connected_components(edges: DataFrame, name: str = "cc", max_rounds: int = 60) -> DataFrame:
    """Components of an undirected graph: rows (node, component), component = smallest node.

    ``edges`` has long columns ``a`` and ``b``. Alternates the large-star and small-star
    steps: each hangs a node's neighbours on the smallest node around it. Every step
    is one shuffle on the node and a partial aggregation, so a node of very many
    edges is combined before it moves. Rounds are logarithmic in the longest path. Each
    round is written to the shared folder. Nodes without an edge are not returned.
    """
    pairs = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-0")

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    before = mark(pairs)
    for k in range(1, max_rounds + 1):
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        # Large star: every larger neighbour of a node moves to the smallest of node and neighbours.
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("x"), F.least("a", "m").alias("y"))
        large = large.where("x <> y").distinct()
        # Small star: a node and its smaller neighbours move to the smallest of them.
        low = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(low, "x")
        small = small.where("y <> m").select(F.col("y").alias("a"), F.col("m").alias("b")).union(low.select(F.col("x").alias("a"), F.col("m").alias("b")))
        pairs = stored(small.distinct(), f"{name}-{k}")
        now = mark(pairs)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("component"))
    ).distinct()
