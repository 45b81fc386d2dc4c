"""Dated snapshots (A11, A12): a Parquet table with one partition a day of ingestion.

A day is replaced as a whole (dynamic partition overwrite), other days stay. The newest day is found from
the partitions' names, without reading a file, and the filter on it prunes the scan to that partition.
"""

from __future__ import annotations

import datetime as dt
import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

DAY = "ingest_date"


def write_days(df: DataFrame, path: str, day: str = DAY, *, files_a_day: int = 1) -> None:
    """Write the days that occur in ``df``, replacing those there are. Rows without a day are an error.

    A day is dealt to ``files_a_day`` tasks by a hash of the row, so a day that holds a third of all rows is not one task's.
    """
    checked = F.coalesce(F.to_date(day), F.raise_error(F.lit(f"a row without {day}")).cast("date"))
    dated = df.withColumn(DAY, checked)
    if day != DAY:
        dated = dated.drop(day)
    salt = F.pmod(F.xxhash64(*dated.columns), F.lit(files_a_day))
    out = dated.repartition(F.col(DAY), salt)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def days(spark: SparkSession, path: str) -> list[dt.date]:
    """The days of a snapshot table, ascending, from its file listing alone; none for a missing table."""
    try:
        names = spark.read.parquet(path).inputFiles()
    except AnalysisException:
        return []
    found = {m[1] for name in names if (m := re.search(rf"/{DAY}=([^/]+)/", unquote(name)))}
    return sorted(dt.date.fromisoformat(d) for d in found if re.fullmatch(r"\d{4}-\d\d-\d\d", d))


def newest(spark: SparkSession, path: str, *, until: dt.date | None = None) -> DataFrame | None:
    """The rows of the newest day (not after ``until``), one partition of the table; None without such a day."""
    held = [d for d in days(spark, path) if until is None or d <= until]
    return spark.read.parquet(path).where(F.col(DAY) == F.lit(held[-1])) if held else None
