"""Field positions: from codes such as ABC35 to yards from the goal, through the crosswalk of codes and teams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlog.session import small

PREFIX = r"^([A-Z][A-Z0-9\s.\-_]*?)(\d+)$"


def normalize_position(c: Column) -> Column:
    """Upper case, '~' artefacts out, blanks collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.upper(F.trim(c)), r"~[0-9](?=[0-9]{2})|~", ""), r"\s+", " "))


def prefix_of(c: Column) -> Column:
    return F.nullif(F.trim(F.regexp_extract(normalize_position(c), PREFIX, 1)), F.lit(""))


def yards_of(c: Column) -> Column:
    return F.nullif(F.regexp_extract(normalize_position(c), PREFIX, 2), F.lit("")).try_cast("int")


def typed_crosswalk(walk: DataFrame) -> DataFrame:
    """game_id, prefix, canonical_team: both sides of a crosswalk row under one another.

    A side counts where what was typed names one of the game's two teams in any case and with any blanks around it;
    blank codes and names are dropped. One team per code: the first in the alphabet where rows disagree.
    """
    both = walk.select("game_id", "team_1", "team_2", F.expr("stack(2, prefix_a, canonical_a, prefix_b, canonical_b) AS (prefix, canonical)"))
    same = lambda c: F.lower(F.trim("canonical")) == F.lower(F.trim(c))
    team = F.when(same("team_1"), F.trim("team_1")).when(same("team_2"), F.trim("team_2"))
    named = both.select("game_id", F.upper(F.trim("prefix")).alias("prefix"), team.alias("canonical_team")).where("prefix <> '' AND canonical_team IS NOT NULL")
    return named.groupBy("game_id", "prefix").agg(F.min("canonical_team").alias("canonical_team"))


def prefix_groups(plays: DataFrame) -> DataFrame:
    """Codes used in each game: plays, first and last play."""
    rows = plays.select("season", "run_id", "game_id", "play_id", prefix_of(F.col("field_position")).alias("prefix")).where("prefix IS NOT NULL")
    return rows.groupBy("season", "run_id", "game_id", "prefix").agg(F.count("*").alias("play_count"), F.min("play_id").alias("first_play_id"), F.max("play_id").alias("last_play_id"))


def apply_crosswalk(plays: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Field position columns for every play: status, owner of the code, side, yards to the opponent's goal."""
    rows = plays.withColumn("__prefix", prefix_of(F.col("field_position"))).withColumn("__yards", yards_of(F.col("field_position")))
    walk = crosswalk.select(F.col("game_id").alias("__g"), F.col("prefix").alias("__p"), F.col("canonical_team").alias("prefix_owner"))
    joined = rows.join(small(walk), (F.col("game_id") == F.col("__g")) & (F.col("__prefix") == F.col("__p")), "left").drop("__g", "__p")
    owner = F.col("prefix_owner")
    side = F.when(owner.isNull(), None).when(owner == F.col("offense"), "own").otherwise("opponent")
    status = F.when(F.col("__prefix").isNull(), "no-field-position").when(owner.isNull(), "unresolved-prefix").otherwise("resolved")
    yards = F.when(side == "own", 100 - F.col("__yards")).when(side == "opponent", F.col("__yards"))
    return joined.select(*plays.columns, F.col("__prefix").alias("field_pos_prefix"), "prefix_owner", side.alias("field_pos_side"), yards.alias("yardline_100"), status.alias("field_position_status"))


def resolve_pair(groups: DataFrame, chosen: DataFrame, games: DataFrame) -> DataFrame:
    """Crosswalk rows of games with exactly two codes, one of which was given a team: the other code is the other team's.

    ``chosen``: game_id, prefix, team. Choices that name a code or team the game hasn't, or a game with another number
    of codes, come out with an error and no team.
    """
    w = Window.partitionBy("game_id")
    pair = groups.select("game_id", "prefix").distinct().withColumn("n", F.count("*").over(w))
    game = games.select("game_id", "schedule_home", "schedule_away").groupBy("game_id").agg(F.max("schedule_home").alias("h"), F.max("schedule_away").alias("a"))
    c = chosen.select("game_id", F.col("prefix").alias("chosen"), "team")
    rows = pair.join(c, "game_id").join(game, "game_id", "left").withColumn("known", F.max(F.col("prefix") == F.col("chosen")).over(w))
    error = F.when(F.col("n") != 2, "not two prefixes").when(~F.col("known"), "prefix not in game").when(F.coalesce((F.col("team") != F.col("h")) & (F.col("team") != F.col("a")), F.lit(True)), "team not in game")
    team = F.when(F.col("prefix") == F.col("chosen"), F.col("team")).when(F.col("team") == F.col("h"), F.col("a")).otherwise(F.col("h"))
    return rows.select("game_id", "prefix", F.when(error.isNull(), team).alias("canonical_team"), error.alias("error"))


def prefix_memory(crosswalk: DataFrame) -> DataFrame:
    """The codes under which each team is known, over all games."""
    return crosswalk.groupBy("canonical_team").agg(F.sort_array(F.collect_set("prefix")).alias("prefixes"))


def seed_crosswalk(groups: DataFrame, crosswalk: DataFrame, games: DataFrame) -> DataFrame:
    """Crosswalk rows that earlier games settle for games of two codes without rows.

    A code is matched to a team of the game if that team was known under it before. Where exactly one code matches
    one team only, or both match different teams, the pair is settled.
    """
    known = crosswalk.select("canonical_team", F.col("prefix").alias("kp")).distinct()
    todo = groups.select("game_id", "prefix").distinct().join(crosswalk.select("game_id").distinct(), "game_id", "left_anti")
    todo = todo.withColumn("n", F.count("*").over(Window.partitionBy("game_id"))).where("n = 2").drop("n")
    game = games.groupBy("game_id").agg(F.max("schedule_home").alias("h"), F.max("schedule_away").alias("a")).where("h IS NOT NULL AND a IS NOT NULL")
    rows = todo.join(game, "game_id")
    sides = rows.select("game_id", "prefix", "h", "a", F.explode(F.array("h", "a")).alias("team"))
    hits = sides.join(known, (F.col("team") == F.col("canonical_team")) & (F.col("prefix") == F.col("kp")), "left").groupBy("game_id", "prefix", "h", "a").agg(F.count("canonical_team").alias("m"), F.max("canonical_team").alias("team"))
    w = Window.partitionBy("game_id")
    hits = hits.withColumn("single", F.count_if(F.col("m") == 1).over(w)).withColumn("ambiguous", F.count_if(F.col("m") > 1).over(w)).withColumn("one", F.max(F.when(F.col("m") == 1, F.col("team"))).over(w)).withColumn("least", F.min(F.when(F.col("m") == 1, F.col("team"))).over(w))
    settled = (F.col("ambiguous") == 0) & ((F.col("single") == 1) | ((F.col("single") == 2) & (F.col("one") != F.col("least"))))
    team = F.when(F.col("m") == 1, F.col("team")).otherwise(F.when(F.col("one") == F.col("h"), F.col("a")).otherwise(F.col("h")))
    return hits.where(settled).select("game_id", "prefix", team.alias("canonical_team"))


def review_queue(groups: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Games with unresolved codes in the order of review: the first two codes and how many are resolved."""
    c = crosswalk.select(F.col("game_id").alias("__g"), F.col("prefix").alias("__p"), "canonical_team")
    rows = groups.join(small(c), (F.col("game_id") == F.col("__g")) & (F.col("prefix") == F.col("__p")), "left")
    by_game = Window.partitionBy("season", "run_id", "game_id")
    rows = rows.withColumn("rn", F.row_number().over(by_game.orderBy("prefix"))).withColumn("resolved", F.count("canonical_team").over(by_game)).withColumn("total", F.count("*").over(by_game))
    games = rows.groupBy("season", "run_id", "game_id").agg(F.max(F.when(F.col("rn") == 1, F.col("prefix"))).alias("prefix_1"), F.max(F.when(F.col("rn") == 2, F.col("prefix"))).alias("prefix_2"), F.max("resolved").cast("bigint").alias("resolved"), F.max("total").cast("bigint").alias("total"))
    return games.where("resolved < total").withColumn("queue_no", F.row_number().over(Window.partitionBy("season").orderBy("game_id", "run_id")).cast("bigint"))


def draft_crosswalk(groups: DataFrame) -> DataFrame:
    """One draft row per game: its codes in order, and a note where there aren't two."""
    rows = groups.groupBy("season", "run_id", "game_id").agg(F.sort_array(F.collect_set("prefix")).alias("p"))
    note = F.when(F.size("p") == 1, "only one prefix").when(F.size("p") > 2, F.concat(F.size("p").cast("string"), F.lit(" prefixes"))).otherwise("")
    return rows.select("season", "run_id", "game_id", F.try_element_at("p", F.lit(1)).alias("prefix_a"), F.try_element_at("p", F.lit(2)).alias("prefix_b"), note.alias("note"))


def wrong_side(rows: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Games with plays whose recorded side (``field_pos_side``) contradicts the crosswalk, and how many they are."""
    derived = apply_crosswalk(rows.withColumnRenamed("field_pos_side", "__recorded"), crosswalk)
    wrong = derived.where("__recorded <> '' AND offense <> '' AND field_pos_side IS NOT NULL AND field_pos_side <> __recorded")
    return wrong.groupBy("game_id").agg(F.count("*").alias("wrong_plays"))
