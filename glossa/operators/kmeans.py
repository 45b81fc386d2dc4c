"""k-means whose restarts share every scan (K3).

Points become whole numbers (millionths), and equal points one weighted row, stored: a point that a third of the rows share is
one row, and sums are exact, whatever their order. A restart's seeds are drawn one after the other, far points likelier, by
hashes of (seed, restart, step, point). An iteration is one scan for all restarts: each point finds its nearest centre in every
restart, and weighted sums by (restart, cluster) are combined before they move; what reaches the
driver has the size of restarts x clusters. Ties go to the smaller cluster number; a centre without points stays.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.session import written

SCALE = 1e6


@dataclass(frozen=True)
class Restart:
    """A restart's end: the centres that points are assigned to, the means and weights of their members, and the cost."""

    restart: int
    centers: list[list[float]]
    means: list[list[float]]
    sizes: list[int]
    cost: float


def whole(features: Sequence[Column]) -> list[Column]:
    return [F.rint(f * SCALE).cast("long") for f in features]


def weighted_points(df: DataFrame, features: Sequence[Column], weight: Column | None = None) -> DataFrame:
    """(q0.., w): distinct points in whole numbers and how many rows have them; a null feature counts as 0.

    With ``weight``, a row of ``df`` stands for so many equal ones.
    """
    q = [F.coalesce(c, F.lit(0)).alias(f"q{i}") for i, c in enumerate(whole(features))]
    each = df.select(*q, (F.lit(1) if weight is None else weight).alias("w"))
    return written(each.groupBy(*[f"q{i}" for i in range(len(q))]).agg(F.sum("w").alias("w")), "kmeans-points")


def nearest(q: Sequence[Column], centers: Sequence[Sequence[Column]]) -> Column:
    """Struct (d, c): the squared distance to, and number of, the nearest centre; plain arithmetic, which Spark compiles."""

    def square(center: Sequence[Column]) -> Column:
        return reduce(add, [(x - y) * (x - y) for x, y in zip(q, center)], F.lit(0.0))

    found = [F.struct(square(center).alias("d"), F.lit(c).alias("c")) for c, center in enumerate(centers)]
    return F.least(*found) if len(found) > 1 else found[0]


def tried(points: DataFrame, dims: int, centers: dict[int, list[list[float]]]) -> DataFrame:
    """Every point with every restart: (q0.., w, r) and, once there are centres, ``at``, the nearest of the restart's.

    The centres are a table of restarts, one column a coordinate, broadcast; so all iterations have one and the same plan.
    """
    k = max(map(len, centers.values()))
    names = [[f"m{c}_{i}" for i in range(dims)] for c in range(k)]
    columns = ["r", *(m for center in names for m in center)]
    # A restart with fewer centres repeats its first: ties go to the smaller number.
    full = {r: [*at, *at[:1] * (k - len(at))] for r, at in centers.items()}
    rows = ", ".join(f"({', '.join([str(r), *(f'{float(x)!r}D' for center in at for x in center)])})" for r, at in sorted(full.items()))
    each = points.crossJoin(F.broadcast(points.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS t({', '.join(columns)})")))
    if k:
        q = [F.col(f"q{i}").cast("double") for i in range(dims)]
        each = each.withColumn("at", nearest(q, [[F.col(m) for m in center] for center in names]))
    return each.drop(*columns[1:])


def seeds(points: DataFrame, dims: int, k: int, restarts: int, seed: int) -> dict[int, list[list[float]]]:
    """The first centres of every restart, one scan a centre: drawn with probability weight x squared distance from those before.

    The draw is the smallest -ln(u) / (weight x distance), u a number in (0, 1) from the md5 of (seed, restart, step, point).
    """
    q = [f"q{i}" for i in range(dims)]
    out: dict[int, list[list[float]]] = {r: [] for r in range(restarts)}
    for step in range(k):
        open_ = {r: c for r, c in out.items() if len(c) == step}
        if not open_:
            break
        each = tried(points, dims, open_).withColumn("d", F.col("at.d") if step else F.lit(1.0)).where("d > 0")
        key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("r").cast("string"), F.lit(str(step)), *[F.col(c).cast("string") for c in q]).cast("binary"))
        u = (F.conv(F.substring(key, 1, 8), 16, 10).cast("double") + 0.5) / 2.0**32
        drawn = F.min(F.struct((-F.ln(u) / (F.col("w") * F.col("d"))).alias("e"), *q))
        for row in each.groupBy("r").agg(drawn.alias("p")).collect():  # one row a restart
            out[row["r"]].append([float(row["p"][c]) for c in q])
    return out


def scan(points: DataFrame, dims: int, centers: dict[int, list[list[float]]]) -> dict[int, dict[int, tuple[list[float], int, float]]]:
    """One scan: for each restart and cluster its members' means, weight and squared distances."""
    exact = [F.sum((F.col(f"q{i}") * F.col("w")).cast("decimal(38,0)")).cast("double").alias(f"s{i}") for i in range(dims)]
    cost = F.sum((F.col("at.d") * F.col("w")).cast("decimal(38,6)")).cast("double").alias("d")
    rows = tried(points, dims, centers).groupBy("r", F.col("at.c").alias("c")).agg(F.sum("w").alias("n"), cost, *exact).collect()
    out: dict[int, dict[int, tuple[list[float], int, float]]] = {r: {} for r in centers}
    for row in rows:
        out[row["r"]][row["c"]] = ([row[f"s{i}"] / row["n"] for i in range(dims)], row["n"], row["d"])
    return out


def fit(points: DataFrame, dims: int, *, k: int = 4, restarts: int = 10, iterations: int = 20, seed: int = 42) -> list[Restart]:
    """Every restart after ``iterations`` (or when its centres stay), from weighted points; none for an empty table.

    With fewer points than ``k`` there are as many clusters as points.
    """
    now = {r: c for r, c in seeds(points, dims, k, restarts, seed).items() if c}
    moving = dict(now)
    for _ in range(iterations):
        if not moving:
            break
        found = scan(points, dims, moving)
        after = {r: [found[r][c][0] if c in found[r] else at for c, at in enumerate(centers)] for r, centers in moving.items()}
        now |= after
        moving = {r: c for r, c in after.items() if c != moving[r]}
    ends = scan(points, dims, now) if now else {}
    out = []
    for r, centers in sorted(now.items()):
        members = [ends[r].get(c, (at, 0, 0.0)) for c, at in enumerate(centers)]
        out.append(Restart(r, centers, [m[0] for m in members], [m[1] for m in members], sum(m[2] for m in members)))
    return out


def best(ends: Sequence[Restart]) -> Restart:
    """The cheapest restart, the first of equals."""
    return min(ends, key=lambda e: (e.cost, e.restart))


def cluster_of(features: Sequence[Column], end: Restart) -> Column:
    """The cluster number of a row's features."""
    q = [F.coalesce(c, F.lit(0)).cast("double") for c in whole(features)]
    return nearest(q, [[F.lit(float(x)) for x in center] for center in end.centers])["c"]
