"""Sources and sinks.

Review parts and the product dimension arrive as CSV; everything durable is
Parquet. Files are listed through Spark's own file index (``binaryFile`` with
only ``path`` selected, so no content is read), which works the same on
local disks, HDFS and object stores.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from glossa.operators.text import DEMOGRAPHIC_COLS

REVIEW_REQUIRED = ("review_text", "rating", "product_id")
PRODUCT_REQUIRED = ("product_id", "product_name", "brand_name")
REVIEW_OPTIONAL = ("submission_time", "user_id", *DEMOGRAPHIC_COLS)

# Column order of the processed-review sink.
PROCESSED_COLUMNS = (
    "review_text", "cleaned_text", "rating", "sentiment_score", "sentiment_label", "sentiment_intensity",
    "textblob_sentiment", "vader_compound", "inferred_skin_type", "main_concerns", "user_cluster",
)
PROCESSED_OPTIONAL = (
    "review_date", "product_id", "product_name", "brand_name", "primary_category", "secondary_category",
    "user_id", "skin_tone", "eye_color", "skin_type", "hair_color",
)
MINIMAL_COLUMNS = ("review_text", "cleaned_text", "rating", "sentiment_score", "sentiment_label")


class NoInputError(RuntimeError):
    pass


def list_files(spark: SparkSession, folder: str, pattern: str = "reviews_*.csv") -> list[str]:
    """A1: paths matching ``pattern`` in ``folder``; none is an error.

    Zero-byte files are not listed by Spark's file index (they hold no rows).

    The listing (file names only) comes to the driver: it is bounded by the
    number of files, not by their size.
    """
    try:
        listing = (
            spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path").orderBy("path")
        )
        paths = [r["path"] for r in listing.collect()]
    except AnalysisException:
        paths = []
    if not paths:
        raise NoInputError(f"no files matching {pattern} in {folder}")
    return paths


def _csv(spark: SparkSession, multi_line: bool = True):
    """CSV reader: header by name, all columns parsed whatever a query selects, so that a row is
    malformed or not for every query alike. ``multi_line`` allows line breaks in quoted fields and
    makes a file one task; without it large files are split."""
    return (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnPruning", False)
        .option("inferSchema", False)
    )


def first_lines(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """Each file's first line, in one job: of the lines in blocks that begin a file, the one read first.

    One short row a file reaches the driver. Files without a line are not in the result.
    """
    lines = spark.read.text(list(paths)).select("value", "_metadata.file_path", "_metadata.file_block_start")
    lines = lines.where("file_block_start = 0").withColumn("place", F.monotonically_increasing_id())  # rises along a file
    found = lines.groupBy("file_path").agg(F.min_by("value", "place").alias("line"))
    return {_plain(r["file_path"]): r["line"] for r in found.collect()}


def _plain(path: str) -> str:
    """A path as the listing and the metadata both can be compared: unquoted, with one slash behind the scheme."""
    return re.sub(r"^file:/+", "file:/", unquote(path))


def _headers(spark: SparkSession, paths: Sequence[str], required: Sequence[str]) -> tuple[dict[tuple, list[str]], list[tuple]]:
    """Admitted paths by header, and ``(path, reason)`` of the others.

    First lines come from one job for all files, and Spark parses one file of each different line. Files whose first
    line is blank, or ends within quotes, or could not be read with the others, are parsed one by one.
    """
    try:
        lines = first_lines(spark, paths)
    except Exception:  # a file that fails the job is told apart below
        lines = {}
    parsed: dict[str, tuple[list[str], str | None]] = {}
    ok, bad = {}, []
    for p in paths:
        line = lines.get(_plain(p), "")
        shared = bool(line.strip()) and line.count('"') % 2 == 0
        if not shared or line not in parsed:
            try:
                found = (_csv(spark).csv(p).columns, None)
            except Exception as e:  # unreadable file
                found = ([], f"unreadable: {type(e).__name__}")
            if shared and found[1] is None:
                parsed[line] = found
        else:
            found = parsed[line]
        cols, failed = found
        missing = [c for c in required if c not in cols]
        if failed:
            bad.append((p, failed))
        elif not cols:
            bad.append((p, "empty"))
        elif missing:
            bad.append((p, f"missing columns: {','.join(missing)}"))
        else:
            ok.setdefault(tuple(cols), []).append(p)
    return ok, bad


def zero_byte_files(spark: SparkSession, folder: str, pattern: str = "reviews_*.csv") -> list[str]:
    """Paths matching ``pattern`` that hold no byte: in the folder's file index, but in no scan."""
    try:
        listed = spark.read.option("pathGlobFilter", pattern).text(folder).inputFiles()
    except AnalysisException:
        return []
    try:
        read = {_plain(p) for p in list_files(spark, folder, pattern)}
    except NoInputError:
        read = set()
    return sorted(p for p in listed if _plain(p) not in read)


QUARANTINE = "path string, reason string, record string"


def admit_files(spark: SparkSession, paths: Sequence[str], required: Sequence[str] = REVIEW_REQUIRED):
    """A2: per-file admission. Returns ``(admitted_paths, quarantine)`` where the
    quarantine frame lists ``(path, reason, record)`` for unreadable, empty or incomplete
    files. Headers come from one job for all files (schema resolution)."""
    ok, bad = _headers(spark, paths, required)
    return [p for group in ok.values() for p in group], spark.createDataFrame([(*b, None) for b in bad], QUARANTINE)


CORRUPT = "_corrupt_record"


def read_review_parts(
    spark: SparkSession, folder: str, pattern: str = "reviews_*.csv", schema: StructType | None = None, *, multi_line: bool = True
) -> tuple[DataFrame, DataFrame]:
    """A1–A3: list, admit, read the admitted parts and union them by name
    (missing columns become NULL). Zero admitted files is an error.

    Parts with the same header are one scan; columns are matched by each file's header,
    whatever their order. Every row of an admitted file is either admitted or in the quarantine, with
    its text: both come from the same PERMISSIVE parse, and a row is malformed if its
    number of fields is not the header's. Columns are strings, or of ``schema``'s
    types where it is given (a value that does not fit becomes NULL).
    """
    required = list(REVIEW_REQUIRED)
    if schema is not None and (lacks := [c for c in required if c not in schema.fieldNames()]):
        raise NoInputError(f"schema lacks required columns: {','.join(lacks)}")
    groups, bad = _headers(spark, list_files(spark, folder, pattern), required)
    if not groups:
        raise NoInputError("no valid review file")
    bad += [(p, "empty") for p in zero_byte_files(spark, folder, pattern)]
    quarantine = spark.createDataFrame([(*b, None) for b in bad], QUARANTINE)
    good = []
    for columns, paths in groups.items():
        fields = StructType([StructField(c, StringType()) for c in (*columns, CORRUPT)])
        raw = _csv(spark, multi_line).schema(fields).option("columnNameOfCorruptRecord", CORRUPT).csv(paths)
        # Spark refuses queries of the corrupt record alone, so the test reads the row as well.
        whole = F.length(F.concat_ws("", *[F.col(f"`{c}`") for c in columns])) >= 0
        broken = F.col(CORRUPT).isNotNull() & whole
        rows = raw.where(broken).select(F.col("_metadata.file_path").alias("path"), F.lit("malformed row").alias("reason"), F.col(CORRUPT).alias("record"))
        quarantine = quarantine.union(rows)
        good.append(raw.where(F.col(CORRUPT).isNull() & whole).drop(CORRUPT))
    combined = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), good)
    for c in REVIEW_OPTIONAL:
        if c not in combined.columns:
            combined = combined.withColumn(c, F.lit(None).cast("string"))
    if schema is not None:
        typed = {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in schema.fields if f.name in combined.columns}
        combined = combined.withColumns(typed)
    return combined, quarantine


def read_products(spark: SparkSession, path: str, required: Sequence[str] = PRODUCT_REQUIRED) -> DataFrame | None:
    """A4: product dimension; a missing file or a missing required column gives None."""
    try:
        df = _csv(spark).csv(path)
        cols = df.columns
    except AnalysisException:
        return None
    if any(c not in cols for c in required):
        return None
    return df


def write_parquet(df: DataFrame, path: str, *, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Parquet sink (optionally partitioned)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """A5 (optional CSV form of the combined set)."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame | None:
    """A10: Parquet scan; a missing path gives None."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def processed_projection(df: DataFrame, *, minimal: bool = False) -> DataFrame:
    """Wanted columns present in the frame, in order, plus every ``text_*``
    column; ``minimal=True`` keeps the five core columns."""
    if minimal:
        return df.select(*[c for c in MINIMAL_COLUMNS if c in df.columns])
    text_cols = [c for c in df.columns if c.startswith("text_")]
    wanted = [c for c in PROCESSED_COLUMNS if c in df.columns] + text_cols + [c for c in PROCESSED_OPTIONAL if c in df.columns]
    return df.select(*dict.fromkeys(wanted))


def write_processed(df: DataFrame, path: str) -> None:
    """Processed reviews, partitioned by review year-month for date pruning."""
    out = processed_projection(df)
    if "review_date" in out.columns:
        out = out.withColumn("review_month", F.date_format("review_date", "yyyy-MM"))
        write_parquet(out, path, partition_by=["review_month"])
    else:
        write_parquet(out, path)


def write_snapshot(df: DataFrame, path: str, ingest_date: str) -> None:
    """Dated snapshot sink (one ``ingest_date`` partition per run)."""
    df.withColumn("ingest_date", F.to_date(F.lit(ingest_date))).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("ingest_date").parquet(path)


def report_lines(rows: DataFrame, template: str, cols: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Render a small result table as ordered text lines."""
    return rows.select(*order, F.format_string(template, *[F.col(c) for c in cols]).alias("line")).orderBy(*order)


def write_report(lines: DataFrame, path: str) -> None:
    """One text file with the rendered lines (the table is small by construction)."""
    lines.select("line").coalesce(1).write.mode("overwrite").text(path)
