"""Current runs of each season and the tables restricted to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldlog.session import small

#: Spellings of the stages in the ledger.
STAGES = {"structure": ["structure"], "plays": ["plays"], "field_position": ["field_position", "field_positions"], "lineup_stats": ["lineup_stats"]}


def note(key: str, kind: str = "string") -> F.Column:
    """A key of the run's JSON notes; NULL where the notes are broken."""
    got = F.get_json_object("notes", f"$.{key}")
    return got if kind == "string" else got.try_cast(kind)


def latest(runs: DataFrame, stage: str) -> DataFrame:
    """The latest completed run of a stage for each season, all ledger columns."""
    w = Window.partitionBy("season").orderBy(F.coalesce("finished_at", "started_at").desc_nulls_last(), F.col("run_id").desc())
    done = runs.where((F.col("status") == "completed") & F.col("stage").isin(STAGES[stage]))
    return done.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def current_structure(runs: DataFrame) -> DataFrame:
    return latest(runs, "structure").select("season", F.col("run_id").alias("structure_run_id"), "started_at", "finished_at", "standings_count", "schedule_count", "games_count")


def current_plays_runs(runs: DataFrame) -> DataFrame:
    return latest(runs, "plays").select("season", F.col("run_id").alias("plays_run_id"), note("source_run_id").alias("source_run_id"), note("reparsed_from_plays_run_id").alias("reparsed_from_plays_run_id"), "started_at", "finished_at", note("raw_pbp_count", "int").alias("raw_pbp_count"), note("plays_count", "int").alias("plays_count"))


def current_field_positions(runs: DataFrame) -> DataFrame:
    return latest(runs, "field_position").select("season", F.col("run_id").alias("field_position_run_id"), note("source_plays_run_id").alias("source_plays_run_id"), "started_at", "finished_at", *(note(k, "int").alias(k) for k in ("field_position_rows", "resolved_count", "unresolved_count")))


def current_lineup_stats(runs: DataFrame) -> DataFrame:
    return latest(runs, "lineup_stats").select("season", F.col("run_id").alias("lineup_stats_run_id"), note("source_lineup_json_run_id").alias("source_lineup_json_run_id"), "started_at", "finished_at", note("player_count", "int").alias("player_count"))


def current_runs(runs: DataFrame) -> DataFrame:
    """One row per season with its current runs, and whether field positions were made from an older plays run."""
    s = current_structure(runs).select("season", "structure_run_id")
    p = current_plays_runs(runs).select("season", "plays_run_id", F.col("source_run_id").alias("plays_source_structure_run_id"), "reparsed_from_plays_run_id")
    f = current_field_positions(runs).select("season", "field_position_run_id", F.col("source_plays_run_id").alias("field_position_source_plays_run_id"))
    stale = F.col("field_position_source_plays_run_id").isNull() | (F.col("field_position_source_plays_run_id") != F.col("plays_run_id"))
    return s.join(p, "season", "full_outer").join(f, "season", "full_outer").withColumn("field_position_is_stale", stale)


def of_current(rows: DataFrame, runs: DataFrame, run_column: str) -> DataFrame:
    """Rows of the current runs (season, run). The few current runs are broadcast once counted small."""
    keys = runs.select(F.col("season").alias("__s"), F.col(run_column).alias("__r"))
    return rows.join(small(keys), (F.col("season") == F.col("__s")) & (F.col("run_id") == F.col("__r")), "left_semi")


def games_current(games: DataFrame, runs: DataFrame) -> DataFrame:
    return of_current(games, current_structure(runs), "structure_run_id").distinct()


def standings_current(standings: DataFrame, runs: DataFrame) -> DataFrame:
    """Standings of the current structure runs with numbers read from text; what is no number is NULL."""
    number = lambda c, kind: F.col(c).try_cast(kind)
    names = {"overall_gp": "games", "overall_w": "wins", "overall_l": "losses", "overall_t": "ties", "conf_gp": "conference_games", "conf_w": "conference_wins", "conf_l": "conference_losses", "conf_t": "conference_ties"}
    rows = of_current(standings, current_structure(runs), "structure_run_id").distinct()
    return rows.select("season", "run_id", "conference", "team_name", "team_id", "schedule_url", *(number(a, "int").alias(b) for a, b in names.items()), number("overall_pct", "double").alias("win_pct"), number("conf_pct", "double").alias("conference_win_pct")).distinct()


def schedule_current(schedule: DataFrame, runs: DataFrame) -> DataFrame:
    """Schedule of the current structure runs with each team's record before the game."""
    rows = of_current(schedule, current_structure(runs), "structure_run_id").distinct()
    w = Window.partitionBy("season", "team_name").orderBy("game_date", "game_id").rowsBetween(Window.unboundedPreceding, -1)
    outcome = F.trim(F.split_part("result", F.lit(","), F.lit(1)))
    for letter, name in (("W", "wins"), ("L", "losses"), ("T", "ties")):
        rows = rows.withColumn(f"{name}_entering_game", F.coalesce(F.sum(F.when(outcome == letter, 1).otherwise(0)).over(w), F.lit(0)).cast("bigint"))
    return rows


def team_weeks(schedule: DataFrame, runs: DataFrame) -> DataFrame:
    """The number of each game in its team's season: season, team_name, game_id, week. Several rows of a game count once."""
    rows = of_current(schedule, current_structure(runs), "structure_run_id").groupBy("season", "team_name", "game_id").agg(F.min("game_date").alias("game_date"))
    w = Window.partitionBy("season", "team_name").orderBy("game_date", "game_id")
    return rows.withColumn("week", F.row_number().over(w))


def plays_current(plays: DataFrame, runs: DataFrame) -> DataFrame:
    """Plays of the current plays runs, repeated rows once.

    Rows are laid out by game, the key of every later window, and a repeat is found as a play like the one before it.
    """
    rows = of_current(plays, current_plays_runs(runs), "plays_run_id").repartition("season", "run_id", "game_id")
    w = Window.partitionBy("season", "run_id", "game_id").orderBy("play_id")
    before = F.lag("play_id").over(w)
    return rows.withColumn("__again", before.isNotNull() & (before == F.col("play_id"))).where("NOT __again").drop("__again")
