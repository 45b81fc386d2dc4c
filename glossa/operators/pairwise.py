"""Pairwise-complete Spearman (J9): each pair of columns over the rows that have both.

A value's rank depends on the pair, since the rows that lack the other column do not count. The rows are read once, to
distinct combinations of values with their number (a hot combination is one row before the shuffle). Their values are
counted by (column, value, pattern of nulls): the pattern says in which pairs a row takes part, so one table of counts
ranks a column against every partner, by prefix sums. The ranks, an array of one for every partner, join back
by value; both tables are stored, so the planner knows their sizes. Sums of products of centred ranks are the covariances.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.operators.stats import value_ranks
from glossa.session import written

MAX_COLUMNS = 62  # bits of a pattern


def spearman_pairwise(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long pairs i < j: ``var_x, var_y, n, spearman_r``. NaN counts as null; no r without two rows or for a constant side."""
    cols = list(cols)
    if len(cols) > MAX_COLUMNS:
        raise ValueError(f"at most {MAX_COLUMNS} columns, not {len(cols)}")
    value = {c: F.col(f"`{c}`").cast("double") for c in cols}
    rows = df.select(*[F.when(~F.isnan(v), v).alias(f"v{i}") for i, v in enumerate(value.values())])
    combos = written(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("w")), "pairwise-combinations")
    pattern = sum((F.when(F.col(f"v{i}").isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i in range(len(cols))), F.lit(0).cast("long"))
    stacked = combos.withColumn("pattern", pattern).select("w", "pattern", F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"v{i}").alias("v")) for i in range(len(cols))])))
    counts = stacked.where("v IS NOT NULL").groupBy("i", "v", "pattern").agg(F.sum("w").alias("c"))
    partners = F.filter(F.array(*map(F.lit, range(len(cols)))), lambda j: (F.col("i") != j) & (F.getbit(F.col("pattern"), j) == 1))
    met = counts.select("i", "v", "c", F.explode(partners).alias("j")).groupBy("i", "j", "v").agg(F.sum("c").alias("_c"))
    ranked = value_ranks(met.select((F.col("i") * len(cols) + F.col("j")).alias("_col"), F.col("v").alias("_v"), "_c"))
    ranked = ranked.select(F.floor(F.col("_col") / len(cols)).cast("int").alias("i"), (F.col("_col") % len(cols)).cast("int").alias("j"), F.col("_v").alias("v"), "_r")
    ranks = ranked.groupBy("i", "v").agg(F.array(*[F.max(F.when(F.col("j") == j, F.col("_r"))) for j in range(len(cols))]).alias("r"))
    ranks = written(ranks, "pairwise-ranks")
    joined = combos
    for i in range(len(cols)):
        joined = joined.join(ranks.where(F.col("i") == i).select(F.col("v").alias(f"v{i}"), F.col("r").alias(f"r{i}")), f"v{i}", "left")
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    sums = []
    for i, j in pairs:
        x, y, w = F.col(f"r{i}")[j], F.col(f"r{j}")[i], F.col("w")
        both = x.isNotNull() & y.isNotNull()
        parts = {"n": F.when(both, w), "xy": F.when(both, w * x * y), "xx": F.when(both, w * x * x), "yy": F.when(both, w * y * y)}
        sums += [F.sum(v).alias(f"{name}_{i}_{j}") for name, v in parts.items()]

    def row(i: int, j: int):
        of = lambda name: F.col(f"{name}_{i}_{j}")
        size = of("xx") * of("yy")
        r = F.when(size > 0, of("xy") / F.sqrt(size))
        return F.struct(F.lit(cols[i]).alias("var_x"), F.lit(cols[j]).alias("var_y"), F.coalesce(of("n"), F.lit(0)).alias("n"), r.alias("spearman_r"))

    schema = "struct<var_x:string,var_y:string,n:bigint,spearman_r:double>"
    return joined.agg(*sums, F.count(F.lit(1)).alias("_all")).select(F.inline(F.array(*[row(i, j) for i, j in pairs]).cast(f"array<{schema}>")))
