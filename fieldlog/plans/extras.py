"""Queries on parsing, silver tables, names, folds, models and the event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlog.operators import folds
from fieldlog.operators import legacy as old
from fieldlog.operators import rollups as roll
from fieldlog.operators import silver
from fieldlog.operators.names import match_names
from fieldlog.operators.play_text import PARSED, Steps, parse_plays
from fieldlog.plans import reports
from fieldlog.plans.reports import CONTEXT, CURRENT, DRIVES, OUT, Tables, query, w
from fieldlog.streaming.events import replay_counts

KEYS = ["run_id", "game_id", "play_id"]
_s = Steps(spark=False)
query("parse_play_text", lambda t: parse_plays(t.plays_now, "raw_text", KEYS), w(CURRENT, f"p0 AS (SELECT {', '.join(KEYS)}, {_s.text('raw_text')} AS t FROM plays_now), p1 AS (SELECT *, {', '.join(f'{v} AS {k}' for k, v in _s.first())} FROM p0), p2 AS (SELECT *, {', '.join(f'{v} AS {k}' for k, v in _s.found())} FROM p1)", f"SELECT {', '.join(KEYS)}, {', '.join(f'{v} AS {k}' for k, v in _s.columns())} FROM p2"))
query("games_from_schedule", lambda t: silver.games_from_schedule(t.read("schedule")),
      "WITH g AS (SELECT run_id, season, game_id, min(game_date) AS game_date, count(*) AS n, list_sort(list(DISTINCT team_name)) AS teams, list_sort(list(DISTINCT team_name) FILTER (home_away = 'home')) AS h, list_sort(list(DISTINCT team_name) FILTER (home_away = 'away')) AS a, max(schedule_home) AS schedule_home, max(schedule_away) AS schedule_away FROM (SELECT DISTINCT * FROM schedule WHERE trim(game_id) <> '') GROUP BY 1, 2, 3) SELECT run_id, season, game_id, game_date, schedule_home, schedule_away, CASE WHEN len(h) = 1 THEN h[1] END AS home_team_canonical, CASE WHEN len(a) = 1 THEN a[1] END AS away_team_canonical, teams[1] AS team_1, teams[2] AS team_2, n AS schedule_row_count, len(teams) AS unique_team_count, CASE WHEN len(teams) = 2 AND n = 2 THEN 'paired' WHEN len(teams) = 2 THEN 'duplicate-rows' WHEN len(teams) = 1 THEN 'single-sided' WHEN len(teams) > 2 THEN 'over-paired' ELSE 'incomplete' END AS pairing_status FROM g")
_roles = " UNION ALL ".join(f"SELECT season, {c} AS pbp_name, {s} AS team, '{r}' AS role FROM plays_now" for c, s, r in (("passer", "offense", "passer"), ("rusher", "offense", "rusher"), ("receiver", "offense", "receiver"), ("tackler_1", "defense", "defender"), ("tackler_2", "defense", "defender")))
NAMES = f"nm AS (SELECT season, team, pbp_name, string_agg(DISTINCT role, '/' ORDER BY role) AS role FROM ({_roles}) WHERE trim(pbp_name) <> '' AND team <> '' GROUP BY 1, 2, 3)"
query("names_of_plays", lambda t: silver.names_of_plays(t.plays_now), w(CURRENT, NAMES, "SELECT * FROM nm"))
query("names_unlisted", lambda t: silver.flag_unlisted(silver.names_of_plays(t.plays_now), t.read("pbp_names").where("flagged <> 'no_roster'")), w(CURRENT, NAMES, "SELECT nm.*, CASE WHEN EXISTS (SELECT 1 FROM pbp_names p WHERE p.season = nm.season AND p.team = nm.team AND p.flagged <> 'no_roster') THEN '' ELSE 'no_roster' END AS flagged FROM nm"))
query("penalty_team_resolved", lambda t: silver.resolve_penalty_team(t.plays_now.select("game_id", F.col("penalty_team").alias("token")), t.plays_now.select("game_id", F.explode(F.array("home_team", "away_team")).alias("team"))),
      w(CURRENT, "v AS (SELECT DISTINCT game_id, penalty_team AS token FROM plays_now WHERE trim(penalty_team) <> ''), tm AS (SELECT DISTINCT game_id, home_team AS team FROM plays_now WHERE home_team <> '' UNION SELECT DISTINCT game_id, away_team FROM plays_now WHERE away_team <> ''), j AS (SELECT v.*, team, upper(trim(team)) = upper(trim(token)) AS e, starts_with(upper(trim(team)), upper(trim(token))) AS b, split_part(upper(trim(team)), ' ', 1) = split_part(upper(trim(token)), ' ', 1) AS f FROM v LEFT JOIN tm USING (game_id))", "SELECT game_id, token, coalesce(max(CASE WHEN e THEN team END), CASE WHEN count(*) FILTER (b) = 1 THEN max(CASE WHEN b THEN team END) END, CASE WHEN count(*) FILTER (f) = 1 THEN max(CASE WHEN f THEN team END) END) AS team FROM j GROUP BY 1, 2"))
query("names_matched", lambda t: match_names(t.read("pbp_names")), None)
query("incremental_resume", lambda t: silver.not_done(t.games_now.select("season", "game_id"), t.plays_now.select("season", "game_id"), ["season", "game_id"]), w(CURRENT, "SELECT DISTINCT g.season, g.game_id FROM games g JOIN sr ON sr.season = g.season AND sr.structure_run_id = g.run_id WHERE NOT EXISTS (SELECT 1 FROM plays_now p WHERE p.season = g.season AND p.game_id = g.game_id)").replace("SELECT DISTINCT g.season", "SELECT g.season").replace("FROM games g JOIN", "FROM (SELECT DISTINCT * FROM games) g JOIN"))


def _replaced(t: Tables) -> DataFrame:
    games = t.read("games").select("season", "run_id", "game_id", "pairing_status").distinct()
    return silver.replaced(games, t.games_now.select("season", "run_id", "game_id", F.lit("current").alias("pairing_status")).distinct(), ["run_id", "game_id"])


query("upsert_replace", _replaced, w(CURRENT, "d AS (SELECT DISTINCT g.season, g.run_id, g.game_id FROM games g JOIN sr ON sr.season = g.season AND sr.structure_run_id = g.run_id)", "SELECT DISTINCT season, run_id, game_id, pairing_status FROM games g WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.run_id = g.run_id AND d.game_id = g.game_id) UNION ALL SELECT season, run_id, game_id, 'current' FROM d"))
TRAIN = "tr AS (SELECT season, game_id, play_id, offense AS team, down, distance, yardline_100, quarter, CAST(score_margin AS INT) AS score_margin, CAST(week AS INT) AS week, CASE WHEN home_away = 'home' THEN 1 ELSE 0 END AS is_home, CAST(is_dropback AS INT) AS is_dropback, CAST(is_rush_attempt AS INT) AS is_rush_attempt, CAST(coalesce(is_sack, FALSE) AS INT) AS is_sack, yards_gained FROM ctx WHERE (is_dropback OR is_rush_attempt) AND season IS NOT NULL AND game_id IS NOT NULL AND offense IS NOT NULL AND down IS NOT NULL AND distance IS NOT NULL AND yardline_100 IS NOT NULL AND quarter IS NOT NULL AND score_margin IS NOT NULL AND week IS NOT NULL AND is_dropback IS NOT NULL AND is_rush_attempt IS NOT NULL AND yards_gained IS NOT NULL)"
query("xpass_features", lambda t: folds.training_rows(t.ctx), w(CONTEXT, TRAIN, "SELECT * FROM tr"))
query("season_folds", lambda t: folds.season_folds(folds.training_rows(t.ctx)), w(CONTEXT, TRAIN, "SELECT season, dense_rank() OVER (ORDER BY season) AS fold FROM (SELECT DISTINCT season FROM tr)"))
query("team_folds", lambda t: folds.team_folds(folds.training_rows(t.ctx)), w(CONTEXT, TRAIN, "a AS (SELECT team, count(*) AS n FROM tr GROUP BY 1), b AS (SELECT *, row_number() OVER (ORDER BY n DESC, team) - 1 AS place FROM a)", "SELECT team, n, CASE WHEN (place // 5) % 2 = 0 THEN place % 5 ELSE 4 - place % 5 END AS fold FROM b"))


def _scored(t: Tables) -> DataFrame:
    rows = folds.training_rows(t.ctx).cache()
    return folds.score_plays(rows, folds.fit_pass_model(rows), folds.fit_yards_models(rows))


query("plays_scored", _scored, None)
query("xpass_quality", lambda t: folds.held_out_quality(folds.training_rows(t.ctx)), None)
query("drive_logit", lambda t: folds.drive_logit(folds.drive_features(t.ctx)), None)
query("drive_features", lambda t: folds.drive_features(t.ctx), w(CONTEXT, "SELECT * FROM (SELECT season, run_id, game_id, drive_id, offense, arg_min(yardline_100, play_id) AS start, count(*) FILTER (is_pass_attempt OR is_rush_attempt) AS plays, count(*) FILTER (is_success) AS successes, count(*) FILTER (is_rush_attempt AND yards_gained >= 10 OR completion AND yards_gained >= 15) AS explosives, count(*) FILTER (is_penalty) AS penalties, count(*) FILTER (is_sack) AS sacks, max(CASE WHEN offense_points > 0 THEN 1 ELSE 0 END) AS scored FROM ctx WHERE drive_id IS NOT NULL AND offense <> '' GROUP BY 1, 2, 3, 4, 5) WHERE start IS NOT NULL"))


def _regression(t: Tables) -> DataFrame:
    f = old.finishing_drives(t.outcomes, "offense").where("drives >= 6")
    r6 = lambda c: F.round(c, 6)
    return f.groupBy("season").agg(F.count("*").alias("teams"), r6(F.corr("avg_start_pos", "pts_per_drive")).alias("r"), r6(F.regr_slope("pts_per_drive", "avg_start_pos")).alias("slope"), r6(F.regr_intercept("pts_per_drive", "avg_start_pos")).alias("intercept"), r6(F.regr_r2("pts_per_drive", "avg_start_pos")).alias("r2"))


query("field_position_regression", _regression, w(CONTEXT, OUT, "f AS (SELECT season, offense AS team, count(*) AS drives, coalesce(round(sum(start_yardline) / nullif(count(start_yardline), 0), 1), 0) AS x, round(sum(points) / count(*), 2) AS y FROM oc WHERE offense <> '' GROUP BY 1, 2 HAVING count(*) >= 6)", "SELECT season, count(*) AS teams, round(corr(x, y), 6) AS r, round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept, round(regr_r2(y, x), 6) AS r2 FROM f GROUP BY 1"))
query("points_per_drive_leaders", lambda t: old.finishing_drives(t.outcomes.where("points <= 8"), "offense").where("drives >= 6").orderBy(F.col("pts_per_drive").desc(), "season", "team").select("season", "team", "drives", "pts_per_drive").limit(15), w(CONTEXT, OUT, "SELECT season, offense AS team, count(*) AS drives, round(sum(points) / count(*), 2) AS pts_per_drive FROM oc WHERE offense <> '' AND points <= 8 GROUP BY 1, 2 HAVING count(*) >= 6 ORDER BY pts_per_drive DESC, season, team LIMIT 15"))
query("metric_correlation", lambda t: folds.drive_features(t.ctx).agg(*(F.round(F.corr(a, "scored"), 6).alias(f"{a}_r") for a in ("start", "plays", "explosives", "penalties", "sacks"))), reports.SQL["drive_features"].replace("SELECT * FROM (SELECT season, run_id", "SELECT " + ", ".join(f"round(corr({a}, scored), 6) AS {a}_r" for a in ("start", "plays", "explosives", "penalties", "sacks")) + " FROM (SELECT season, run_id"))
query("points_and_finishing", lambda t: roll.season_points_ranked(t.points).select("season", F.col("team_name").alias("team"), "ppg", "ppg_rank").join(old.finishing_drives(t.outcomes, "offense").select("season", "team", "scoring_rate", "pts_per_drive"), ["season", "team"]), w(CONTEXT, OUT, reports.POINTS, reports.SPOINTS, "SELECT sp.season, sp.team_name AS team, ppg, rank() OVER (PARTITION BY sp.season ORDER BY ppg DESC) AS ppg_rank, scoring_rate, pts_per_drive FROM sp LEFT JOIN (SELECT season, offense AS team, round(100.0 * sum(score) / count(*), 1) AS scoring_rate, round(sum(points) / count(*), 2) AS pts_per_drive FROM oc WHERE offense <> '' GROUP BY 1, 2) f ON f.season = sp.season AND f.team = sp.team_name").replace("SELECT sp.season", "SELECT * FROM (SELECT sp.season") + ") WHERE scoring_rate IS NOT NULL")
query("events_stream", lambda t: replay_counts(t.read("events")), "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
DRIVES  # noqa: B018
