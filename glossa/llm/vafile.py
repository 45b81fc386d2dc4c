"""Operator 13: centroid clustering (Lloyd's rounds) over a VA-file.

A vector's components become integers, floor(scale * x), and its approximation a cell of ``bits`` bits a dimension,
between that dimension's least and greatest integer over all vectors, with its squared norm. For a centroid c,
|x - c|^2 = |x|^2 + |c|^2 - 2 x.c; only x.c needs the vector, and a cell bounds each of its terms. So one table a
centroid, of a lower and an upper bound for each dimension's cells, adds up to an interval of its distance. A
centroid whose interval begins above the end of another's can't be nearest. If one is left, the vector is assigned
by its approximation alone; else its full components are fetched by a join, and the exact distances to the centroids left, all in
integers, decide. Sums of the clusters are kept from round to round: only vectors that changed their cluster are
fetched to correct them.

Everything that reaches the driver has a size of clusters x dimensions. Rounds are written to the shared folder.

Defined cases: vectors of another length, or null, or with a null or non-finite component are left out. A component whose
integer exceeds 2^27 in size is an error, since squared distances would not fit 64 bits. Ties go to the smaller
centroid number. Repeated rows are vectors of their own; among those with the same id, components decide which comes
first as a centroid; a null id counts as the empty text in the hash. With fewer vectors than ``k`` there are as many
centroids as vectors; an empty table gives no rows. Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.llm.common import stored

LIMIT = 1 << 27
STATE = "row long, cells binary, norm long, cluster int, was int"


def integers(vectors: DataFrame, dims: int = 64, scale: int = 256) -> DataFrame:
    """(row, vec_id, q): a stored row number, and the integer components of the vectors that count."""
    value = F.col("embedding")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    whole = F.coalesce((F.size(value) == dims) & F.forall(value, finite), F.lit(False))
    x = F.transform(value, lambda v: F.floor(v.cast("double") * scale))
    small = F.forall(value, lambda v: F.abs(v.cast("double") * scale) < LIMIT)
    checked = F.when(small, x).otherwise(F.raise_error(F.lit(f"a component of {LIMIT // scale} or more")).cast("array<bigint>"))
    rows = vectors.where(whole).select(F.col("vec_id").cast("long").alias("vec_id"), checked.cast("array<int>").alias("q"))
    return stored(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "q"), "vectors")


def first_centroids(rows: DataFrame, k: int, seed: str) -> np.ndarray:
    """The ``k`` vectors with the smallest sha256 of ``seed:vec_id``, in that order."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    found = rows.select(key.alias("key"), "q").orderBy("key", "q").limit(k).collect()
    return np.array([r["q"] for r in found], np.int64)


def ranges(rows: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Each dimension's least and greatest integer."""
    found = rows.agg(*[f(F.col("q")[d]).alias(f"{name}{d}") for d in range(dims) for name, f in (("lo", F.min), ("hi", F.max))]).first()
    return (np.array([found[f"{name}{d}"] for d in range(dims)], np.int64) for name in ("lo", "hi"))


class Cells:
    """Equal cells between each dimension's ends."""

    def __init__(self, lo: np.ndarray, hi: np.ndarray, bits: int) -> None:
        self.lo, self.hi, self.n = lo, hi, 1 << bits
        self.width = (hi - lo) // self.n + 1

    def of(self, q: np.ndarray) -> np.ndarray:
        return ((q - self.lo) // self.width).astype(np.uint8)

    def tables(self, centroids: np.ndarray) -> np.ndarray:
        """(dimension, cell, 2 x centroids): bounds of |c|^2 - 2 x.c; the first dimension carries the squared norms."""
        cell = np.arange(self.n)[None, :]
        low = np.minimum(self.lo[:, None] + cell * self.width[:, None], self.hi[:, None])
        high = np.minimum(low + self.width[:, None] - 1, self.hi[:, None])
        ends = -2 * np.stack([low, high])[..., None] * centroids.T[None, :, None, :]
        out = np.concatenate([ends.min(axis=0), ends.max(axis=0)], axis=2)
        out[0] += np.tile((centroids**2).sum(axis=1), 2)
        return out


def intervals(cells: np.ndarray, norm: np.ndarray, tables: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of every vector's squared distance to every centroid."""
    total = np.repeat(norm[:, None], tables.shape[2], axis=1)
    for d in range(tables.shape[0]):
        total += tables[d][cells[:, d]]
    k = tables.shape[2] // 2
    return total[:, :k], total[:, k:]


def nearest(q: np.ndarray, open_: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(centroid, squared distance) of the nearest centroid among the open ones, exactly."""
    distance = np.full(open_.shape, np.iinfo(np.int64).max)
    for c in np.flatnonzero(open_.any(axis=0)):
        at = np.flatnonzero(open_[:, c])
        distance[at, c] = ((q[at] - centroids[c]) ** 2).sum(axis=1)
    best = distance.argmin(axis=1)
    return best, distance[np.arange(len(q)), best]


def approximations(rows: DataFrame, cells: Cells) -> DataFrame:
    """(row, cells, norm) of every vector, without a cluster."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            q = np.stack(batch["q"].tolist()).astype(np.int64) if len(batch) else np.zeros((0, len(cells.lo)), np.int64)
            yield pd.DataFrame({"row": batch["row"], "cells": [r.tobytes() for r in cells.of(q)], "norm": (q**2).sum(axis=1), "cluster": -1, "was": -1})

    return stored(rows.select("row", "q").mapInPandas(run, STATE), "approximations")


def assign(state: DataFrame, rows: DataFrame, centroids: np.ndarray, cells: Cells, name: str) -> DataFrame:
    """The state with every vector's nearest centroid, and the one before in ``was``; full vectors only where intervals overlap."""
    tables, k = cells.tables(centroids), len(centroids)

    def bound(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 2000):
                part = batch.iloc[at : at + 2000]
                coded = np.frombuffer(b"".join(part["cells"]), np.uint8).reshape(len(part), -1)
                low, high = intervals(coded, part["norm"].to_numpy(np.int64), tables)
                open_ = low <= high.min(axis=1)[:, None]
                left = [None if n == 1 else r.tobytes() for r, n in zip(np.packbits(open_, axis=1), open_.sum(axis=1))]
                yield part.assign(was=part["cluster"], cluster=open_.argmax(axis=1).astype(np.int32), left=left)

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                open_ = np.unpackbits(np.frombuffer(b"".join(batch.pop("left")), np.uint8).reshape(len(batch), -1), axis=1, count=k).astype(bool)
                batch["cluster"] = nearest(np.stack(batch.pop("q").tolist()).astype(np.int64), open_, centroids)[0].astype(np.int32)
                yield batch

    bounded = stored(state.mapInPandas(bound, STATE + ", left binary"), f"{name}-bounded")
    unsure = bounded.where("left IS NOT NULL").join(rows.select("row", "q"), "row")
    return stored(bounded.where("left IS NULL").drop("left").union(unsure.mapInPandas(fetch, STATE)), name)


def moved_sums(state: DataFrame, rows: DataFrame, k: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """What the vectors that changed their cluster add to the clusters' sums and counts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((k, dims + 1), np.int64)
        for batch in batches:
            if len(batch):
                q = np.stack(batch["q"].tolist()).astype(np.int64)
                q = np.concatenate([q, np.ones((len(q), 1), np.int64)], axis=1)
                new, was = batch["cluster"].to_numpy(), batch["was"].to_numpy()
                np.add.at(total, new, q)
                np.subtract.at(total, was[was >= 0], q[was >= 0])
        c, d = np.nonzero(total)
        yield pd.DataFrame({"cluster": c.astype(np.int32), "d": d.astype(np.int32), "x": total[c, d]})

    moved = state.where("cluster <> was").select("row", "cluster", "was").join(rows.select("row", "q"), "row").drop("row")
    sums = moved.mapInPandas(run, "cluster int, d int, x long")
    total = np.zeros((k, dims + 1), np.int64)
    for r in sums.groupBy("cluster", "d").agg(F.sum("x").alias("x")).collect():  # clusters x dimensions
        total[r["cluster"], r["d"]] = r["x"]
    return total[:, :dims], total[:, dims]


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, bits: int = 6, seed: str = "2") -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every vector that counts, and the final centroids.

    ``rounds`` times, every vector goes to its nearest centroid, and every centroid that has vectors becomes the floor of
    their mean; then vectors are assigned once more.
    """
    rows = integers(vectors, dims, scale)
    centroids = first_centroids(rows, k, seed)
    k = len(centroids)
    if not k:
        return rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    cells = Cells(*ranges(rows, dims), bits)
    state = approximations(rows, cells)
    sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
    for r in range(rounds):
        state = assign(state, rows, centroids, cells, f"round-{r}")
        more, n = moved_sums(state, rows, k, dims)
        sums, counts = sums + more, counts + n
        held = counts > 0
        centroids = centroids.copy()
        centroids[held] = sums[held] // counts[held][:, None]
    state = assign(state, rows, centroids, cells, "last-round")

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                q = np.stack(batch.pop("q").tolist()).astype(np.int64)
                batch["distance"] = ((q - centroids[batch["cluster"].to_numpy()]) ** 2).sum(axis=1)
                yield batch.astype({"vec_id": "Int64"})

    whole = state.select("row", "cluster").join(rows, "row").select("vec_id", "cluster", "q")
    return whole.mapInPandas(measure, "vec_id long, cluster int, distance long"), centroids


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def report(vectors: DataFrame, **parameters) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector that counts."""
    spark = vectors.sparkSession
    found, centroids = cluster(vectors, **parameters)
    found = stored(found, "clustered")
    names = spark.createDataFrame([(i, centroid_digest(c)) for i, c in enumerate(centroids)], "cluster int, centroid_sha256 string")
    inertia = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))  # one row a cluster
    total = inertia.agg(F.sum("cluster_inertia")).scalar()
    return found.join(F.broadcast(inertia.join(names, "cluster")), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", total.alias("inertia"), "centroid_sha256"
    )
