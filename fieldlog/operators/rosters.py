"""Rosters against typed names: near-equal spellings of one player, the choice by role, names applied to plays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Positions that fit what a name does in a play (fixed values).
FITS = {
    "passer": ["QB"],
    "rusher": ["QB", "RB", "FB", "WB", "HB", "WR", "TE", "K", "P"],
    "receiver": ["WR", "TE", "H", "HB", "FB", "SB", "SE"],
    "defender": ["DB", "LB", "DL", "DE", "NT", "EDGE", "CB", "S", "FS", "SS", "NB", "ILB", "OLB"],
}
NAMED = ["passer", "rusher", "receiver", "tackler_1", "tackler_2", "penalty_player"]


def distinct_players(roster: DataFrame) -> DataFrame:
    """Rows of a roster (season, team, name) without those that are the beginning of a longer name of their group.

    A group is a club's names with the same first letter and the same six letters of the last word. Sorted, a name that
    begins another stands before it, so each is compared with the next one that doesn't begin with it only by a look ahead.
    """
    words = F.split(F.trim(F.lower("name")), r"\s+")
    rows = roster.select("season", "team", "name").where("trim(name) <> ''").distinct().withColumns({"a": F.substring(F.get(words, F.lit(0)), 1, 1), "b": F.substring(F.element_at(words, -1), 1, 6)})
    # In order of the alphabet all names that begin with a name follow it at once.
    after = F.lead("name").over(Window.partitionBy("season", "team", "a", "b").orderBy("name"))
    return rows.withColumn("next", after).where(~F.coalesce(F.startswith("next", F.col("name")), F.lit(False))).select("season", "team", "name")


def role_score(position: Column, roles: Column) -> Column:
    """2 where one of the positions fits one of the roles ('/'-joined), -1 where none does, 0 where none is known."""
    fits = F.lit(False)
    its = F.split(F.upper(F.coalesce(position, F.lit(""))), r"[/\s]+")
    for role, positions in FITS.items():
        fits = fits | (F.array_contains(F.split(roles, "/"), role) & F.arrays_overlap(its, F.array(*map(F.lit, positions))))
    return F.when(F.trim(F.coalesce(position, F.lit(""))) == "", 0).when(fits, 2).otherwise(-1)


def choose(candidates: DataFrame) -> DataFrame:
    """One roster name for each typed name: season, team, pbp_name, canonical, how ('role', 'longest' or 'ambiguous').

    ``candidates``: season, team, pbp_name, role, canonical, position. The one whose position fits best is chosen if it
    alone does; if no position fits any, the longest name if it is longer than all others; else none.
    """
    by = ["season", "team", "pbp_name"]
    rows = candidates.withColumn("score", role_score(F.col("position"), F.col("role"))).groupBy(*by, "canonical").agg(F.max("score").alias("score"))
    w = Window.partitionBy(*by)
    rows = rows.withColumn("best", F.max("score").over(w)).withColumn("n_best", F.count_if(F.col("score") == F.col("best")).over(w)).withColumn("long", F.max(F.length("canonical")).over(w)).withColumn("n_long", F.count_if(F.length("canonical") == F.col("long")).over(w)).withColumn("n", F.count("*").over(w))
    by_role = (F.col("best") > 0) & (F.col("n_best") == 1) & (F.col("score") == F.col("best"))
    by_length = (F.col("best") <= 0) & (F.col("n_long") == 1) & (F.length("canonical") == F.col("long"))
    alone = F.col("n") == 1
    chosen = rows.groupBy(*by).agg(F.max(F.when(alone | by_role | by_length, F.col("canonical"))).alias("canonical"), F.max(F.when(alone, "alone").when(by_role, "role").when(by_length, "longest")).alias("how"))
    return chosen.withColumn("how", F.coalesce("how", F.lit("ambiguous")))


def apply_names(plays: DataFrame, names: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and the six name columns of plays with typed names replaced by the chosen ones: one join of a map per club.

    ``names``: season, team, pbp_name, canonical. Passer, rusher and receiver are looked up under the offense, tacklers
    under the defense, a penalised player under either side. A name without a choice stays as typed.
    """
    known = names.where("canonical IS NOT NULL AND pbp_name IS NOT NULL AND team <> ''").groupBy("season", "team", "pbp_name").agg(F.min("canonical").alias("canonical")).groupBy("season", "team").agg(F.map_from_entries(F.collect_list(F.struct("pbp_name", "canonical"))).alias("m"))
    rows = plays.select(*keys, *(c for c in ("season", "offense", "defense") if c not in keys), *NAMED)
    for side in ("offense", "defense"):
        rows = rows.join(known.select(F.col("season").alias("__s"), F.col("team").alias("__t"), F.col("m").alias(f"__{side}")), (F.col("season") == F.col("__s")) & (F.col(side) == F.col("__t")), "left").drop("__s", "__t")
    under = {"passer": ["offense"], "rusher": ["offense"], "receiver": ["offense"], "tackler_1": ["defense"], "tackler_2": ["defense"], "penalty_player": ["offense", "defense"]}
    return rows.select(*keys, *(F.coalesce(*(F.try_element_at(f"__{s}", F.col(c)) for s in under[c]), F.col(c)).alias(c) for c in NAMED))
