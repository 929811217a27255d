"""Team and player rollups of the play context: one builder for side, grain and lens."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlog.functions.expr import BASE_SUMS, RANKED, RATES, SITUATION_RANKED, SITUATION_RATES, SITUATION_SUMS, SITUATIONS, direction, passer_rating, ranked, rate

#: Where a defensive total isn't just its offensive name with opp_ before it.
DEFENSE_NAMES = {"pass_int": "interceptions_forced", "sacks": "sacks_forced", "stuffed_runs": "stuffed_runs_forced", "play_count": "play_count", "distance_sum": "distance_sum", "distance_n": "distance_n"}


def metric_name(name: str, side: str) -> str:
    return name if side == "offense" else DEFENSE_NAMES.get(name, f"opp_{name}")


def situations(context: DataFrame) -> DataFrame:
    """Every play once for each lens that holds it, in one scan."""
    lens = F.array_compact(F.array(*(F.when(F.expr(c), F.lit(n)) for n, c in SITUATIONS.items())))
    return context.withColumn("situation", F.explode(lens))


def team_game(context: DataFrame, side: str, lens: str = "all") -> DataFrame:
    """Sums per team and game (and situation). Plays whose team is NULL or '' are left out."""
    rows = context if lens == "all" else situations(context)
    by = ["season", "run_id", "game_id", "team_name"] + (["situation"] if lens != "all" else [])
    rows = rows.where(f"{side} IS NOT NULL AND {side} <> ''").withColumn("team_name", F.col(side))
    if side == "offense":
        about = [F.max("opponent").alias("opponent"), F.max("home_away").alias("home_away"), F.max("week").cast("bigint").alias("week")]
    else:
        about = [F.max("offense").alias("opponent"), F.max(F.expr("CASE WHEN defense = schedule_home THEN 'home' WHEN defense = schedule_away THEN 'away' END")).alias("home_away")]
    if lens == "all":
        about += [F.max("schedule_home").alias("schedule_home"), F.max("schedule_away").alias("schedule_away")]
    sums = BASE_SUMS if lens == "all" else SITUATION_SUMS
    return rows.groupBy(*by).agg(*about, *(F.sum(F.expr(v)).cast("bigint").alias(metric_name(k, side)) for k, v in sums.items()))


def with_rating(df: DataFrame, side: str) -> DataFrame:
    n = lambda x: metric_name(x, side)
    return df.withColumn(n("passer_rating"), passer_rating(n("pass_yds"), n("pass_td"), n("pass_comp"), n("pass_int"), n("pass_att")))


def team_season(games: DataFrame, side: str, lens: str = "all") -> DataFrame:
    by = ["season", "run_id", "team_name"] + (["situation"] if lens != "all" else [])
    sums = BASE_SUMS if lens == "all" else SITUATION_SUMS
    return games.groupBy(*by).agg(F.count_distinct("game_id").alias("games"), *(F.sum(metric_name(k, side)).cast("bigint").alias(metric_name(k, side)) for k in sums))


def sided(text: str, side: str) -> str:
    return " + ".join(metric_name(x.strip(), side) for x in text.split("+"))


def with_rates(df: DataFrame, side: str, rates: dict) -> DataFrame:
    return df.withColumns({metric_name(k, side): rate(F.expr(sided(a, side)), F.expr(sided(b, side)), s, d) for k, (a, b, s, d) in rates.items()})


def season_ranked(seasons: DataFrame, side: str, lens: str = "all") -> DataFrame:
    """Rates and ranks of the season; ranks go by the rounded rates, within a season (and situation)."""
    if lens == "all":
        rows = with_rating(with_rates(seasons, side, RATES), side)
        return ranked(rows, ["season"], {metric_name(m, side): direction(m, side) for m in RANKED})
    rows = with_rates(seasons, side, SITUATION_RATES)
    return ranked(rows, ["season", "situation"], {metric_name(m, side): direction(m, side) for m in SITUATION_RANKED})


def team_game_points(context: DataFrame) -> DataFrame:
    """Points for and against each team of a game, from both roles."""
    roles = F.array(F.struct(F.col("offense").alias("t"), F.col("offense_points").alias("f"), F.col("defense_points").alias("a")), F.struct(F.col("defense").alias("t"), F.col("defense_points").alias("f"), F.col("offense_points").alias("a")))
    rows = context.select("season", "run_id", "game_id", F.explode(roles).alias("r")).where("r.t IS NOT NULL AND r.t <> ''")
    return rows.groupBy("season", "run_id", "game_id", F.col("r.t").alias("team_name")).agg(F.sum("r.f").cast("bigint").alias("points_scored"), F.sum("r.a").cast("bigint").alias("points_allowed"))


def season_points_ranked(points: DataFrame) -> DataFrame:
    rows = points.groupBy("season", "run_id", "team_name").agg(F.count_distinct("game_id").alias("games"), F.sum("points_scored").cast("bigint").alias("points_scored"), F.sum("points_allowed").cast("bigint").alias("points_allowed"))
    rows = rows.withColumn("ppg", rate("points_scored", "games", 1.0, 1)).withColumn("ppg_allowed", rate("points_allowed", "games", 1.0, 1))
    return ranked(rows, ["season"], {"ppg": "desc", "ppg_allowed": "asc"})


def drives(context: DataFrame) -> DataFrame:
    """One row per drive; it starts where its first play with a known position does."""
    scrimmage = F.expr("CASE WHEN is_pass_attempt OR is_rush_attempt THEN 1 ELSE 0 END")
    start = F.min_by("yardline_100", F.when(F.col("yardline_100").isNotNull(), F.col("play_id")))
    rows = context.where("drive_id IS NOT NULL").groupBy("season", "run_id", "game_id", "drive_id").agg(F.max("offense").alias("offense"), F.max("defense").alias("defense"), start.alias("start_yardline_100"), F.sum(scrimmage).cast("bigint").alias("scrimmage_plays"), F.sum("offense_points").cast("bigint").alias("drive_points"))
    rows = rows.withColumn("is_scoring_drive", F.col("drive_points") > 0)
    return rows.withColumn("is_three_and_out", (F.col("scrimmage_plays") <= 3) & ~F.col("is_scoring_drive"))


def team_drives(drive_rows: DataFrame, side: str, grain: str) -> DataFrame:
    by = ["season", "run_id"] + (["game_id"] if grain == "game" else []) + [side]
    aggs = [F.count("*").alias("drives"), F.sum("scrimmage_plays").cast("bigint").alias("total_scrimmage_plays"), F.sum("start_yardline_100").cast("bigint").alias("total_start_yardline_100"), F.count_if("is_scoring_drive").alias("drives_scored"), F.count_if("is_three_and_out").alias("drives_three_and_out")]
    games = [F.count_distinct("game_id").alias("games")] if grain == "season" else []
    return drive_rows.groupBy(*by).agg(*games, *aggs).withColumnRenamed(side, "team_name")


def season_drives_ranked(season: DataFrame, side: str) -> DataFrame:
    good = "asc" if side == "offense" else "desc"
    bad = "desc" if side == "offense" else "asc"
    rows = season.withColumns({"r1": rate("total_start_yardline_100", "drives", 1.0, None), "r2": rate("drives_scored", "drives", 100.0, None), "r3": rate("drives_three_and_out", "drives", 100.0, None)})
    rows = ranked(rows, ["season"], {"r1": good, "r2": bad, "r3": good})
    rows = rows.withColumnsRenamed({"r1_rank": "avg_start_yardline_100_rank", "r2_rank": "pct_drives_scored_rank", "r3_rank": "pct_drives_three_and_out_rank"}).drop("r1", "r2", "r3")
    return rows.withColumns({
        "avg_plays_per_drive": rate("total_scrimmage_plays", "drives", 1.0, 2), "avg_start_yardline_100": rate("total_start_yardline_100", "drives", 1.0, 1), "pct_drives_scored": rate("drives_scored", "drives"),
        "pct_drives_three_and_out": rate("drives_three_and_out", "drives"), "plays_per_game": rate("total_scrimmage_plays", "games", 1.0, 1),
    })


def coverage(schedule_rows: DataFrame, plays_rows: DataFrame, structure_runs: DataFrame, plays_runs: DataFrame) -> DataFrame:
    """Games scheduled for each team against games with plays of its offense."""
    scheduled = schedule_rows.groupBy("season", "team_name").agg(F.count_distinct("game_id").alias("scheduled_games"))
    played = plays_rows.where("offense IS NOT NULL AND offense <> ''").groupBy("season", F.col("offense").alias("team_name")).agg(F.count_distinct("game_id").alias("pbp_games"))
    rows = scheduled.join(structure_runs.select("season", "structure_run_id"), "season").join(plays_runs.select("season", "plays_run_id"), "season", "left").join(played, ["season", "team_name"], "left")
    rows = rows.withColumn("pbp_games", F.coalesce("pbp_games", F.lit(0)).cast("bigint"))
    return rows.withColumn("missing_pbp_games", F.col("scheduled_games") - F.col("pbp_games"))


def player_passing(context: DataFrame, grain: str) -> DataFrame:
    """Passing by the raw passer name, per game or per season."""
    keep = ["pass_att", "pass_comp", "pass_yds", "pass_td", "pass_int"]
    rows = context.where("is_pass_attempt AND passer IS NOT NULL AND passer <> ''").withColumn("team_name", F.col("offense"))
    games = rows.groupBy("season", "run_id", "game_id", "team_name", "passer").agg(F.max("opponent").alias("opponent"), *(F.sum(F.expr(BASE_SUMS[k])).cast("bigint").alias(k) for k in keep))
    if grain == "season":
        games = games.groupBy("season", "run_id", "team_name", "passer").agg(F.count_distinct("game_id").alias("games"), *(F.sum(k).cast("bigint").alias(k) for k in keep))
    return with_rating(games, "offense")
