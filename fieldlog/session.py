"""Session settings and the few helpers that look at a running session."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a side may be broadcast after it has been counted.
BROADCAST_ROWS = 500_000


def build_session(app: str = "fieldlog", cpus: int | None = None) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the caller brings its own."""
    n = cpus or os.cpu_count() or 4
    spark = (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("FIELDLOG_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``); a local one is set only where none is given."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        if sc._jsc.sc().getCheckpointDir().isEmpty():
            sc.setCheckpointDir(found)
        return found
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="fieldlog-"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """The frame as a table written to the shared folder and read again: lineage ends there, whichever executor is lost.

    The table is computed once (a checkpoint computes its plan twice) and deleted when the session's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint for a side counted to hold at most ``rows`` rows; a larger one is left to a shuffle join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def _tasks(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def spread(df: DataFrame, *by: str) -> DataFrame:
    """The frame laid out by ``by`` over as many tasks as shuffles have, also where its few bytes would be put into one.

    For rows on which a task works long: adaptive execution goes by bytes and leaves an explicit number alone. A grouping
    by the same columns needs no other layout.
    """
    return df.repartition(_tasks(df.sparkSession), *by)


def deal(df: DataFrame, *by: str) -> DataFrame:
    """As ``spread``, by a hash of the columns: also moves rows that are laid out by the columns themselves already."""
    return df.repartition(_tasks(df.sparkSession), F.xxhash64(*by))
