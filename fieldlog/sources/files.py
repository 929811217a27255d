"""Readers and writers beside the Parquet tables: CSV, page folders, run-partitioned appends and the ledger."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def csv_table(spark: SparkSession, path: str, numbers: dict[str, str] | None = None) -> DataFrame:
    """A CSV file with a header, all text but for ``numbers`` (column: type); what is no number is NULL."""
    rows = spark.read.csv(path, header=True, multiLine=True, escape='"')
    return rows.withColumns({c: F.col(c).try_cast(t) for c, t in (numbers or {}).items() if c in rows.columns})


def scrimmage_csv(spark: SparkSession, path: str) -> DataFrame:
    """Rush and pass plays of a CSV log, with a flag for known down and distance."""
    rows = csv_table(spark, path, {"down": "double", "distance": "double", "yards_gained": "double", "yardline_100": "double", "penalty_yards": "double"})
    return rows.where(F.col("play_type").isin("rush", "pass")).withColumn("has_down_distance", F.col("down").isNotNull() & F.col("distance").isNotNull())


def crosswalk_csv(spark: SparkSession, path: str) -> DataFrame:
    """game_id, prefix, canonical_team of a crosswalk file, rows with a blank code or name dropped."""
    rows = csv_table(spark, path).select("game_id", F.expr("stack(2, prefix_a, canonical_a, prefix_b, canonical_b) AS (prefix, canonical_team)"))
    return rows.where("trim(prefix) <> '' AND trim(canonical_team) <> ''")


def page_folder(spark: SparkSession, folder: str) -> DataFrame:
    """game_id and html_text of the files <game_id>.html in a folder."""
    rows = spark.read.text(f"{folder}/*.html", wholetext=True).select(F.col("value").alias("html_text"), F.col("_metadata.file_name").alias("f"))
    return rows.select(F.regexp_replace("f", r"\.html$", "").alias("game_id"), "html_text")


def season_of(url: str) -> Column:
    """The season in an address such as .../2025-26/..."""
    return F.nullif(F.regexp_extract(F.col(url), r"/(\d{4}-\d{2})(?:/|$)", 1), F.lit(""))


def append_run(rows: DataFrame, path: str) -> None:
    """Appends a run's rows, laid out by season and run so that current-run filters prune folders."""
    rows.write.mode("append").partitionBy("season", "run_id").parquet(path)


def replace_runs(rows: DataFrame, path: str) -> None:
    """Writes rows so that they replace what was stored of their own seasons and runs, and nothing else."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("season", "run_id").parquet(path)


def write_csv(rows: DataFrame, path: str, columns: list[str] | None = None) -> None:
    (rows.select(*columns) if columns else rows).write.mode("overwrite").csv(path, header=True)


def with_columns(rows: DataFrame, wanted: dict[str, str], fill: dict[str, Column] | None = None) -> DataFrame:
    """Rows with the missing ones of ``wanted`` (column: type) added as NULL, then NULLs filled from ``fill``."""
    rows = rows.withColumns({c: F.lit(None).cast(t) for c, t in wanted.items() if c not in rows.columns})
    return rows.withColumns({c: F.coalesce(F.col(c), v) for c, v in (fill or {}).items()})


def ledger_of(events: DataFrame) -> DataFrame:
    """The ledger as it stands: the latest event of each run; a run's first time stays its start.

    ``events``: run_id, season, stage, status, at, notes, appended as runs begin, complete or fail.
    """
    last = lambda c: F.max_by(c, F.struct("at", "status")).alias(c)
    out = events.groupBy("run_id").agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), F.col("at"))).alias(c) for c in ("season", "stage", "notes")), last("status"), F.min("at").alias("started_at"), F.max(F.when(F.col("status") != "running", F.col("at"))).alias("finished_at"))
    return out


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Frames under one another by name, columns that some lack as NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
