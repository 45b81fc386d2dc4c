"""Session helpers: a local session for tests/bench, and the durable-lineage helper."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "glossa") -> SparkSession:
    """Session for tests and the benchmark (UTC, ANSI, AQE, no UI)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared (HDFS/S3/...) folder and is used
    as is. Where it is unset, a session on one machine (tests, local runs) gets a fresh
    scratch folder under /tmp; on a cluster, whose executors would not see it, that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.conf.get("spark.master", "local")
        if not re.match(r"local($|\[)", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        path = tempfile.mkdtemp(prefix="glossa-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", path)
        except Exception:  # a session that rejects runtime core settings
            pass
    try:
        spark.sparkContext.setCheckpointDir(path)
    except Exception:  # Spark Connect: the server reads spark.checkpoint.dir itself
        pass
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (never machine-local on a cluster)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def spread(df: DataFrame) -> DataFrame:
    """Give expensive row-local work (regex cleaning, tokenising) at least one task
    per core.

    A scan gets one task per Parquet row group; a table stored as a few large
    row groups would run all its text work in a few tasks. Only then the rows
    are redistributed round-robin; a large table (many splits, the normal case
    on a cluster) is returned unchanged, without a shuffle. Planning the scan to
    count its splits lists files but reads no data. Only for bare scans: counting the partitions
    of a frame with joins would run their stages.
    """
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # e.g. a Spark Connect session: leave the plan as it is
        return df
    if splits < cores:
        return df.repartition(cores)
    return df


def durable(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder.

    Used before iterative work (ML fits) so that a lost executor recomputes
    from the checkpoint instead of the whole upstream plan.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    Like ``durable``, and the planner sees the table's true size, by which it takes or refuses a broadcast.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
