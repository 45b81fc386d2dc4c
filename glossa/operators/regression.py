"""Linear models from moments (K6–K8): one pass for the Gram matrix, solved by Cholesky for every group at once.

The pass adds up means and centred co-moments (``covar_pop`` merges them without loss) of the training rows of each group.
On correlations, so that units don't matter, the matrix is factored by array expressions in one row a group; a
feature that is constant, or (up to ``TOLERANCE``) a combination of those before it, gets no weight. Nothing is collected,
so a model of every platform, brand or product is one plan; the metrics read the rows a second time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.operators.ml import GRADES, LOW_GRADE

#: The least part of a feature's variance that those before it must leave.
TOLERANCE = 1e-9


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _numbers() -> Column:
    return F.array().cast("array<double>")


def cholesky(a: Column, k: int) -> Column:
    """Rows of the lower factor of a k x k matrix; a pivot that vanishes makes its column zero."""

    def row(done: Column, i: Column) -> Column:
        def entry(part: Column, j: Column) -> Column:
            other = F.when(j < i, F.get(done, j)).otherwise(part)
            rest = F.get(F.get(a, i), j) - dot(F.slice(part, F.lit(1), j), F.slice(other, F.lit(1), j))
            pivot = F.get(other, j)
            value = F.when(j == i, F.when(rest > TOLERANCE, F.sqrt(F.greatest(rest, F.lit(0.0)))).otherwise(0.0)).otherwise(F.when(pivot > 0, rest / pivot).otherwise(0.0))
            return F.concat(part, F.array(value))

        return F.concat(done, F.array(F.aggregate(F.sequence(F.lit(0), i), _numbers(), entry)))

    return F.aggregate(F.sequence(F.lit(0), F.lit(k - 1)), F.array().cast("array<array<double>>"), row)


def solve(factor: Column, b: Column, k: int) -> Column:
    """The solution of (factor x its transpose) x = b."""

    def forward(y: Column, i: Column) -> Column:
        line = F.get(factor, i)
        pivot = F.get(line, i)
        return F.concat(y, F.array(F.when(pivot > 0, (F.get(b, i) - dot(F.slice(line, F.lit(1), i), y)) / pivot).otherwise(0.0)))

    y = F.aggregate(F.sequence(F.lit(0), F.lit(k - 1)), _numbers(), forward)

    def backward(x: Column, i: Column) -> Column:
        below = F.transform(F.slice(factor, i + 2, F.lit(k - 1) - i), lambda line: F.get(line, i))
        pivot = F.get(F.get(factor, i), i)
        return F.concat(F.array(F.when(pivot > 0, (F.get(y, i) - dot(below, x)) / pivot).otherwise(0.0)), x)

    return F.aggregate(F.sequence(F.lit(k - 1), F.lit(0), F.lit(-1)), _numbers(), backward)


def _frame(df: DataFrame, target: str, features: Sequence[str], by: Sequence[str], train: Column | None) -> DataFrame:
    """Complete rows with the group's columns, y, x0.., and whether they train."""
    xs = [F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(features)]
    trains = F.lit(True) if train is None else F.coalesce(train, F.lit(False))
    rows = df.select(*[F.col(f"`{c}`") for c in by], F.col(f"`{target}`").cast("double").alias("y"), *xs, trains.alias("trains"))
    return rows.dropna(subset=["y", *[f"x{i}" for i in range(len(features))], *by])


def fit(
    df: DataFrame, target: str, features: Sequence[str], *, by: Sequence[str] = (), train: Column | None = None, min_rows: int = 20
) -> DataFrame:
    """One row a group with at least ``min_rows`` complete rows: n_rows, n_train, intercept, ``coefficients`` and ``betas``.

    ``train`` picks the rows that fit (default: all); rows with a null in the target, a feature or a group column are left out.
    Betas are the coefficients of standardised variables.
    """
    k = len(features)
    rows = _frame(df, target, features, by, train)
    part = {c: F.when(F.col("trains"), F.col(c)) for c in ("y", *[f"x{i}" for i in range(k)])}
    names = [f"x{i}" for i in range(k)] + ["y"]
    moments = [F.covar_pop(part[a], part[b]).alias(f"c_{a}_{b}") for p, a in enumerate(names) for b in names[p:]]
    means = [F.avg(part[c]).alias(f"m_{c}") for c in names]
    sums = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("trains").alias("n_train"), *means, *moments)
    sums = sums.where((F.col("n_rows") >= min_rows) & (F.col("n_train") > 0))
    sd = {c: F.sqrt(F.col(f"c_{c}_{c}")) for c in names}

    def correlation(a: str, b: str) -> Column:
        a, b = sorted((a, b), key=names.index)
        return F.coalesce(F.when((sd[a] > 0) & (sd[b] > 0), F.col(f"c_{a}_{b}") / (sd[a] * sd[b])), F.lit(0.0))

    gram = F.array(*[F.array(*[correlation(a, b) for b in names[:-1]]) for a in names[:-1]])
    out = sums.withColumns({"gram": gram, "against": F.array(*[correlation(a, "y") for a in names[:-1]]), "sd": F.array(*[sd[a] for a in names[:-1]]), "sd_y": sd["y"]})
    out = out.withColumn("factor", cholesky(F.col("gram"), k)).withColumn("betas", solve(F.col("factor"), F.col("against"), k))
    scaled = F.zip_with("betas", "sd", lambda beta, s: F.when(s > 0, beta * F.col("sd_y") / s).otherwise(0.0))
    out = out.withColumn("coefficients", scaled)
    intercept = F.col("m_y") - dot(F.col("coefficients"), F.array(*[F.col(f"m_{c}") for c in names[:-1]]))
    return out.select(*by, "n_rows", "n_train", intercept.alias("intercept"), "coefficients", "betas")


def coefficients(model: DataFrame, features: Sequence[str], *, by: Sequence[str] = ()) -> DataFrame:
    """K7: a row for each group and feature, by falling size of the coefficient."""
    names = F.array(*map(F.lit, features))
    each = F.inline(F.arrays_zip(names.alias("feature"), F.col("coefficients").alias("coefficient"), F.col("betas").alias("beta")))
    return model.select(*by, each).withColumn("abs_coefficient", F.abs("coefficient")).orderBy(*by, F.col("abs_coefficient").desc(), "feature")


def metrics(
    model: DataFrame, df: DataFrame, target: str, features: Sequence[str], *, by: Sequence[str] = (), train: Column | None = None
) -> DataFrame:
    """K6, K8: R2, MSE and MAE over the rows that don't train (all, if ``train`` is None), the grade, and the strongest feature."""
    rows = _frame(df, target, features, by, train)
    if train is not None:
        rows = rows.where("NOT trains")
    if by:
        keyed = rows.join(model, list(by))
    else:  # one model: a scalar
        one = model.select(F.struct(*map(F.col, model.columns)).alias("m")).scalar()
        keyed = rows.withColumn("_m", one).where("_m IS NOT NULL").select("*", "_m.*")
    error = F.col("y") - F.col("intercept") - dot(F.col("coefficients"), F.array(*[F.col(f"x{i}") for i in range(len(features))]))
    found = keyed.withColumn("e", error).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_test"), F.avg(F.col("e") * F.col("e")).alias("mse"), F.avg(F.abs("e")).alias("mae"), F.var_pop("y").alias("var"),
        F.first("n_rows").alias("n_rows"), F.first("n_train").alias("n_train"), F.first("coefficients").alias("c"),
    ).where("n_test > 0")
    found = found.withColumn("r2", F.when(F.col("var") > 0, 1.0 - F.col("mse") / F.col("var")))
    grade = F.lit(LOW_GRADE)
    for threshold, name in reversed(GRADES):
        grade = F.when(F.col("r2") > threshold, name).otherwise(grade)
    # The largest coefficient; of equal ones the first name.
    named = F.zip_with("c", F.array(*map(F.lit, features)), lambda c, f: F.struct((-F.abs(c)).alias("size"), f.alias("name"), c.alias("c")))
    top = F.array_min(named)
    return found.select(
        *by, "n_rows", "n_train", "n_test", "r2", "mse", "mae", grade.alias("grade"), top["name"].alias("top_feature"),
        F.when(top["c"] > 0, "positive").otherwise("negative").alias("top_sign"),
    )
