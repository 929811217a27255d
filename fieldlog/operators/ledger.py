"""Runs in the order in which they delivered a season."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def completed_runs(runs: DataFrame, *having: DataFrame) -> DataFrame:
    """Distinct completed runs that have rows in each table of ``having``: run_id, season, started_at.

    Runs without season or run_id are left out; a null started_at sorts first. A run listed with several
    start times counts with the earliest.
    """
    out = (
        runs.where((F.col("status") == "completed") & F.col("run_id").isNotNull() & F.col("season").isNotNull())
        .groupBy("run_id", "season")
        .agg(F.min("started_at").alias("started_at"))
    )
    for rows in having:
        out = out.join(rows.select("run_id").where(F.col("run_id").isNotNull()).distinct(), "run_id", "left_semi")
    return out


def numbered(runs: DataFrame, name: str = "ord") -> DataFrame:
    """Runs with their place in the season, from 1, by started_at and then run_id."""
    w = Window.partitionBy("season").orderBy(F.col("started_at").asc_nulls_first(), "run_id")
    return runs.withColumn(name, F.row_number().over(w))


def blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c) != "", c)
