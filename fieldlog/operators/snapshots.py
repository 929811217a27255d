"""What changed between consecutive full snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlog.session import small


def row_hash(columns: list[Column]) -> Column:
    """64-bit hash of a row in which null is a value of its own."""
    return F.xxhash64(*columns, *(c.isNull() for c in columns)) if columns else F.lit(0).cast("bigint")


def changes(rows: DataFrame, runs: DataFrame, key: list[str], compared: dict[str, Column]) -> DataFrame:
    """Records added, removed or changed in each run after a season's first: run_id, key columns, change_kind.

    ``rows`` has run_id, the key columns and what ``compared`` names; ``runs`` has run_id, season, ord (1, 2, ... within
    the season). Every snapshot is tagged as the new side of its own pair of runs and the old side of the next pair;
    all tagged rows are grouped once by pair and key, where each side is represented by its row hash. Repeated rows
    count once: of several different rows of one key in one snapshot the one with the greatest hash stands for the
    key. Null keys are keys of their own. Rows of runs not in ``runs`` are ignored; a run without rows removes
    everything that was there before; columns other than those named play no part, whatever their names.
    """
    last = runs.groupBy("season").agg(F.max("ord").alias("__last"))
    runs = runs.select(F.col("run_id").alias("__run"), "season", "ord").join(last, "season").select("__run", F.col("season").alias("__season"), F.col("ord").alias("__ord"), "__last")
    tagged = rows.select(F.col("run_id").alias("__run"), *(F.col(k).alias(f"__k{i}") for i, k in enumerate(key)), row_hash(list(compared.values())).alias("__hash"))
    tagged = tagged.join(small(runs.select("__run", "__season", "__ord", "__last")), "__run")
    new, old = F.struct(F.lit(True).alias("new"), F.col("__ord").alias("pair")), F.struct(F.lit(False).alias("new"), (F.col("__ord") + 1).alias("pair"))
    sides = F.when(F.col("__last") == 1, F.array().cast("array<struct<new:boolean,pair:int>>")).when(F.col("__ord") == 1, F.array(old)).when(F.col("__ord") == F.col("__last"), F.array(new)).otherwise(F.array(new, old))
    tagged = tagged.select("*", F.explode(sides).alias("__side"))
    keys = [f"__k{i}" for i in range(len(key))]
    grouped = tagged.groupBy("__season", F.col("__side.pair").alias("__pair"), *keys).agg(
        F.max(F.when(F.col("__side.new"), F.col("__hash"))).alias("__new"), F.max(F.when(~F.col("__side.new"), F.col("__hash"))).alias("__old")
    )
    kind = F.when(F.col("__old").isNull(), "added").when(F.col("__new").isNull(), "removed").when(F.col("__old") != F.col("__new"), "changed")
    found = grouped.withColumn("change_kind", kind).where("change_kind is not null")
    names = runs.select("__season", F.col("__ord").alias("__pair"), "__run")
    return found.join(small(names), ["__season", "__pair"]).select(F.col("__run").alias("run_id"), *(F.col(f"__k{i}").alias(k) for i, k in enumerate(key)), "change_kind")
