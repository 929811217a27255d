"""Queries over the play-by-play tables, each beside the SQL text that a second engine runs on the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlog.functions import expr as X
from fieldlog.operators import crosswalk as xw
from fieldlog.operators import current as cur
from fieldlog.operators import legacy as old
from fieldlog.operators import loaders as load
from fieldlog.operators import rollups as roll
from fieldlog.operators.context import play_context
from fieldlog.sources.tables import table

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
#: The makers behind ``Q``, for queries that build on others.
Q_MAKE: dict[str, Callable] = {}


class Tables:
    """The tables of a folder and what is derived from them, as lazy frames."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.read = lambda n: table(spark, folder, n)

    def __getattr__(self, name: str) -> DataFrame:
        makers = {
            "runs": lambda: self.read("pipeline_runs"),
            "structure": lambda: cur.current_structure(self.runs),
            "walk": lambda: xw.typed_crosswalk(self.read("prefix_crosswalk")),
            "schedule_now": lambda: cur.schedule_current(self.read("schedule"), self.runs),
            "standings_now": lambda: cur.standings_current(self.read("standings"), self.runs),
            "plays_now": lambda: cur.plays_current(self.read("plays"), self.runs),
            "games_now": lambda: cur.games_current(self.read("games"), self.runs),
            "groups": lambda: xw.prefix_groups(self.plays_now),
            "ctx": lambda: play_context(self.read("plays"), self.runs, self.read("schedule"), self.walk),
            "old": lambda: old.scrimmage(self.ctx),
            "outcomes": lambda: old.drive_outcomes(self.ctx),
            "drives": lambda: roll.drives(self.ctx),
            "points": lambda: roll.team_game_points(self.ctx),
        }
        if name not in makers:
            raise AttributeError(name)
        return makers[name]()

    def season(self, side: str, lens: str = "all") -> DataFrame:
        return roll.season_ranked(roll.team_season(roll.team_game(self.ctx, side, lens), side, lens), side, lens)


def query(name: str, make: Callable[[Tables], DataFrame], sql: str | None) -> None:
    Q_MAKE[name] = make
    Q[name] = lambda spark, folder: make(Tables(spark, folder))
    if sql:
        SQL[name] = sql


# --- SQL building blocks -------------------------------------------------------------------------------------------
_note = lambda k, t="": f"CASE WHEN json_valid(notes) THEN {'TRY_CAST(' if t else ''}json_extract_string(notes, '$.{k}'){f' AS {t})' if t else ''} END AS {k}"
_latest = lambda stages: f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY season ORDER BY coalesce(finished_at, started_at) DESC, run_id DESC) AS rn FROM pipeline_runs WHERE status = 'completed' AND stage IN ({stages})) WHERE rn = 1)"
S_RUNS = f"sr AS (SELECT season, run_id AS structure_run_id, started_at, finished_at, standings_count, schedule_count, games_count FROM {_latest(chr(39) + 'structure' + chr(39))})"
P_RUNS = f"pr AS (SELECT season, run_id AS plays_run_id, {_note('source_run_id')}, {_note('reparsed_from_plays_run_id')}, started_at, finished_at, {_note('raw_pbp_count', 'INTEGER')}, {_note('plays_count', 'INTEGER')} FROM {_latest(chr(39) + 'plays' + chr(39))})"
F_RUNS = f"fr AS (SELECT season, run_id AS field_position_run_id, {_note('source_plays_run_id')}, started_at, finished_at, {_note('field_position_rows', 'INTEGER')}, {_note('resolved_count', 'INTEGER')}, {_note('unresolved_count', 'INTEGER')} FROM {_latest(chr(39) + 'field_position' + chr(39) + ', ' + chr(39) + 'field_positions' + chr(39))})"
L_RUNS = f"lr AS (SELECT season, run_id AS lineup_stats_run_id, {_note('source_lineup_json_run_id')}, started_at, finished_at, {_note('player_count', 'INTEGER')} FROM {_latest(chr(39) + 'lineup_stats' + chr(39))})"
CURRENT = f"""{S_RUNS}, {P_RUNS}, {F_RUNS}, {L_RUNS},
sched AS (SELECT DISTINCT s.* FROM schedule s JOIN sr ON sr.season = s.season AND sr.structure_run_id = s.run_id),
plays_now AS (SELECT DISTINCT p.* FROM plays p JOIN pr ON pr.season = p.season AND pr.plays_run_id = p.run_id),
walk AS (SELECT game_id, prefix, min(team) AS canonical_team FROM (
  SELECT game_id, upper(trim(p)) AS prefix, CASE WHEN lower(trim(c)) = lower(trim(team_1)) THEN trim(team_1) WHEN lower(trim(c)) = lower(trim(team_2)) THEN trim(team_2) END AS team FROM (
    SELECT game_id, team_1, team_2, prefix_a AS p, canonical_a AS c FROM prefix_crosswalk UNION ALL SELECT game_id, team_1, team_2, prefix_b, canonical_b FROM prefix_crosswalk))
  WHERE prefix <> '' AND team IS NOT NULL GROUP BY 1, 2)"""
_norm = "trim(regexp_replace(replace(regexp_replace(upper(trim(field_position)), '~[0-9]([0-9][0-9])', '\\1', 'g'), '~', ''), '\\s+', ' ', 'g'))"
_pos = "regexp_extract({n}, '^([A-Z][A-Z0-9\\s.\\-_]*?)([0-9]+)$', {g})"
CONTEXT = f"""{CURRENT},
weeks AS (SELECT season, team_name, game_id, row_number() OVER (PARTITION BY season, team_name ORDER BY min(game_date), game_id) AS week FROM sched GROUP BY season, team_name, game_id),
owner AS (SELECT p.run_id, p.game_id, p.play_id, max_by(w.canonical_team, length(w.prefix)) AS team FROM plays_now p JOIN walk w ON w.game_id = p.game_id AND starts_with(p.fumble_recovered_by, w.prefix) GROUP BY 1, 2, 3),
c1 AS (SELECT p.* REPLACE (coalesce(p.is_safety, FALSE) AS is_safety, coalesce(p.is_defensive_td, FALSE) AS is_defensive_td),
  CASE WHEN coalesce(p.is_fumble, FALSE) AND coalesce(p.raw_text ILIKE '%touchdown%', FALSE) THEN coalesce(o.team = p.defense, NOT coalesce(p.is_td, FALSE)) ELSE FALSE END AS fumble_td, {X.KICK_TD} AS kick_td
  FROM plays_now p LEFT JOIN owner o USING (run_id, game_id, play_id)),
c2 AS (SELECT *, {X.OFFENSE_POINTS} AS offense_points, {X.DEFENSE_POINTS} AS defense_points FROM c1),
c3 AS (SELECT *, CAST(coalesce(sum({X.SIDE_POINTS.format(s='schedule_home')}) OVER w, 0) AS BIGINT) AS home_score, CAST(coalesce(sum({X.SIDE_POINTS.format(s='schedule_away')}) OVER w, 0) AS BIGINT) AS away_score FROM c2
  WINDOW w AS (PARTITION BY season, run_id, game_id ORDER BY play_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c4 AS (SELECT *, CASE WHEN offense = schedule_home THEN home_score - away_score WHEN offense = schedule_away THEN away_score - home_score END AS score_margin, {', '.join(f'{v} AS {k}' for k, v in X.PLAY_FLAGS.items())},
  is_defensive_td OR fumble_td AS resolved_defensive_td, nullif(trim({_pos.format(n=_norm, g=1)}), '') AS field_pos_prefix, TRY_CAST(nullif({_pos.format(n=_norm, g=2)}, '') AS INTEGER) AS fp_yards FROM c3),
c5 AS (SELECT c4.*, {X.MARGIN_BUCKET} AS score_margin_bucket, w.canonical_team AS prefix_owner, CASE WHEN w.canonical_team IS NULL THEN NULL WHEN w.canonical_team = offense THEN 'own' ELSE 'opponent' END AS field_pos_side FROM c4 LEFT JOIN walk w ON w.game_id = c4.game_id AND w.prefix = c4.field_pos_prefix),
c6 AS (SELECT *, CASE field_pos_side WHEN 'own' THEN 100 - fp_yards WHEN 'opponent' THEN fp_yards END AS yardline_100, CASE WHEN field_pos_prefix IS NULL THEN 'no-field-position' WHEN prefix_owner IS NULL THEN 'unresolved-prefix' ELSE 'resolved' END AS field_position_status FROM c5),
ctx AS (SELECT c6.* EXCLUDE (fp_yards), {X.FIELD_ZONE} AS field_zone, weeks.week FROM c6 LEFT JOIN weeks ON weeks.season = c6.season AND weeks.team_name = c6.offense AND weeks.game_id = c6.game_id)"""


def w(*parts: str) -> str:
    return "WITH " + ", ".join(parts[:-1]) + " " + parts[-1]


def _rate(a: str, b: str, s: float, d: int | None) -> str:
    x = f"CAST({s} AS DOUBLE) * ({a}) / nullif({b}, 0)"
    return x if d is None else f"round({x}, {d})"


def sums_sql(src: str, side: str, lens: str, extra: str = "") -> str:
    sums = X.BASE_SUMS if lens == "all" else X.SITUATION_SUMS
    about = "max(opponent) AS opponent, max(home_away) AS home_away, max(week) AS week" if side == "offense" else "max(offense) AS opponent, max(CASE WHEN defense = schedule_home THEN 'home' WHEN defense = schedule_away THEN 'away' END) AS home_away"
    about += ", max(schedule_home) AS schedule_home, max(schedule_away) AS schedule_away" if lens == "all" else ""
    by = f"season, run_id, game_id, {side}" + (", situation" if lens != "all" else "")
    return f"SELECT season, run_id, game_id, {side} AS team_name{', situation' if lens != 'all' else ''}, {about}, {', '.join(f'CAST(sum({v}) AS BIGINT) AS {roll.metric_name(k, side)}' for k, v in sums.items())} FROM {src} WHERE {side} IS NOT NULL AND {side} <> ''{extra} GROUP BY {by}"


def season_sql(src: str, side: str, lens: str) -> str:
    sums = X.BASE_SUMS if lens == "all" else X.SITUATION_SUMS
    by = "season, run_id, team_name" + (", situation" if lens != "all" else "")
    return f"SELECT {by}, count(DISTINCT game_id) AS games, {', '.join(f'CAST(sum({roll.metric_name(k, side)}) AS BIGINT) AS {roll.metric_name(k, side)}' for k in sums)} FROM {src} GROUP BY {by}"


def rating_sql(side: str) -> str:
    n = lambda k: roll.metric_name(k, side)
    return f"round((8.4 * {n('pass_yds')} + 330 * {n('pass_td')} + 100 * {n('pass_comp')} - 200 * {n('pass_int')}) / nullif({n('pass_att')}, 0), 1) AS {n('passer_rating')}"


def rates_sql(side: str, rates: dict) -> str:
    return ", ".join(f"{_rate(roll.sided(a, side), roll.sided(b, side), s, d)} AS {roll.metric_name(k, side)}" for k, (a, b, s, d) in rates.items())


def ranks_sql(metrics: dict[str, str], by: str = "season") -> str:
    return ", ".join(f"rank() OVER (PARTITION BY {by} ORDER BY {m} {way.upper()} NULLS LAST) AS {m}_rank" for m, way in metrics.items())


LENSES = "lens AS (" + " UNION ALL ".join(f"SELECT *, '{n}' AS situation FROM ctx WHERE {c}" for n, c in X.SITUATIONS.items()) + ")"

# --- runs and current tables ---------------------------------------------------------------------------------------
query("current_structure_runs", lambda t: t.structure, w(S_RUNS, "SELECT * FROM sr"))
query("current_plays_runs", lambda t: cur.current_plays_runs(t.runs), w(P_RUNS, "SELECT * FROM pr"))
query("current_field_position_runs", lambda t: cur.current_field_positions(t.runs), w(F_RUNS, "SELECT * FROM fr"))
query("current_lineup_stats_runs", lambda t: cur.current_lineup_stats(t.runs), w(L_RUNS, "SELECT * FROM lr"))
query("current_runs", lambda t: cur.current_runs(t.runs), w(S_RUNS, P_RUNS, F_RUNS, "SELECT coalesce(sr.season, pr.season, fr.season) AS season, structure_run_id, plays_run_id, field_position_run_id, pr.source_run_id AS plays_source_structure_run_id, reparsed_from_plays_run_id, fr.source_plays_run_id AS field_position_source_plays_run_id, (fr.source_plays_run_id IS NULL OR fr.source_plays_run_id <> pr.plays_run_id) AS field_position_is_stale FROM sr FULL JOIN pr ON pr.season = sr.season FULL JOIN fr ON fr.season = coalesce(sr.season, pr.season)"))
query("games_current", lambda t: t.games_now, w(S_RUNS, "SELECT DISTINCT g.* FROM games g JOIN sr ON sr.season = g.season AND sr.structure_run_id = g.run_id"))
_num = {"overall_gp": "games", "overall_w": "wins", "overall_l": "losses", "overall_t": "ties", "conf_gp": "conference_games", "conf_w": "conference_wins", "conf_l": "conference_losses", "conf_t": "conference_ties"}
STANDINGS = f"SELECT DISTINCT s.season, s.run_id, conference, team_name, team_id, schedule_url, {', '.join(f'TRY_CAST({a} AS INTEGER) AS {b}' for a, b in _num.items())}, TRY_CAST(overall_pct AS DOUBLE) AS win_pct, TRY_CAST(conf_pct AS DOUBLE) AS conference_win_pct FROM standings s JOIN sr ON sr.season = s.season AND sr.structure_run_id = s.run_id"
query("standings_current", lambda t: t.standings_now, w(S_RUNS, STANDINGS))
SCHEDULE = "SELECT *, " + ", ".join(f"CAST(coalesce(sum(CASE WHEN trim(split_part(result, ',', 1)) = '{c}' THEN 1 ELSE 0 END) OVER (PARTITION BY season, team_name ORDER BY game_date, game_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS {n}_entering_game" for c, n in (("W", "wins"), ("L", "losses"), ("T", "ties"))) + " FROM sched"
query("schedule_current", lambda t: t.schedule_now, w(CURRENT, SCHEDULE))
query("plays_current", lambda t: t.plays_now, w(CURRENT, "SELECT * FROM plays_now"))
query("team_weeks", lambda t: cur.team_weeks(t.read("schedule"), t.runs).withColumn("week", F.col("week").cast("bigint")).drop("game_date"), w(CONTEXT, "SELECT season, team_name, game_id, week FROM weeks"))

# --- context and rollups -------------------------------------------------------------------------------------------
query("play_context", lambda t: t.ctx.withColumn("week", F.col("week").cast("bigint")).select("season", "run_id", "game_id", "play_id", "offense", "defense", "week", "offense_points", "defense_points", "home_score", "away_score", "score_margin", "score_margin_bucket", *X.PLAY_FLAGS, "field_pos_prefix", "prefix_owner", "field_pos_side", "yardline_100", "field_zone", "field_position_status", "fumble_td", "kick_td", "resolved_defensive_td"),
      w(CONTEXT, f"SELECT season, run_id, game_id, play_id, offense, defense, week, offense_points, defense_points, home_score, away_score, score_margin, score_margin_bucket, {', '.join(X.PLAY_FLAGS)}, field_pos_prefix, prefix_owner, field_pos_side, yardline_100, field_zone, field_position_status, fumble_td, kick_td, resolved_defensive_td FROM ctx"))
for side in ("offense", "defense"):
    query(f"team_game_{side}", lambda t, s=side: roll.with_rating(roll.team_game(t.ctx, s), s), w(CONTEXT, f"b AS ({sums_sql('ctx', side, 'all')})", f"SELECT *, {rating_sql(side)} FROM b"))
    query(f"team_season_{side}", lambda t, s=side: roll.team_season(roll.team_game(t.ctx, s), s), w(CONTEXT, f"b AS ({sums_sql('ctx', side, 'all')})", season_sql("b", side, "all")))
    _ranks = {roll.metric_name(m, side): X.direction(m, side) for m in X.RANKED}
    SEASON = f"b AS ({sums_sql('ctx', side, 'all')}), s AS ({season_sql('b', side, 'all')}), r AS (SELECT *, {rates_sql(side, X.RATES)}, {rating_sql(side)} FROM s)"
    query(f"season_{side}_ranked", lambda t, s=side: t.season(s), w(CONTEXT, SEASON, f"SELECT *, {ranks_sql(_ranks)} FROM r"))
    SITUATION = f"{LENSES}, b AS ({sums_sql('lens', side, 'situation')})"
    query(f"situation_game_{side}", lambda t, s=side: roll.team_game(t.ctx, s, "situation"), w(CONTEXT, SITUATION, "SELECT * FROM b"))
    query(f"situation_season_{side}", lambda t, s=side: roll.team_season(roll.team_game(t.ctx, s, "situation"), s, "situation"), w(CONTEXT, SITUATION, season_sql("b", side, "situation")))
    _sr = {roll.metric_name(m, side): X.direction(m, side) for m in X.SITUATION_RANKED}
    query(f"situation_{side}_ranked", lambda t, s=side: t.season(s, "situation"), w(CONTEXT, SITUATION, f"s AS ({season_sql('b', side, 'situation')}), r AS (SELECT *, {rates_sql(side, X.SITUATION_RATES)} FROM s)", f"SELECT *, {ranks_sql(_sr, 'season, situation')} FROM r"))
POINTS = "pts AS (SELECT season, run_id, game_id, team_name, CAST(sum(f) AS BIGINT) AS points_scored, CAST(sum(a) AS BIGINT) AS points_allowed FROM (SELECT season, run_id, game_id, offense AS team_name, offense_points AS f, defense_points AS a FROM ctx UNION ALL SELECT season, run_id, game_id, defense, defense_points, offense_points FROM ctx) WHERE team_name IS NOT NULL AND team_name <> '' GROUP BY 1, 2, 3, 4)"
query("team_points", lambda t: t.points, w(CONTEXT, POINTS, "SELECT * FROM pts"))
SPOINTS = "sp AS (SELECT season, run_id, team_name, count(DISTINCT game_id) AS games, CAST(sum(points_scored) AS BIGINT) AS points_scored, CAST(sum(points_allowed) AS BIGINT) AS points_allowed, round(sum(points_scored) / nullif(count(DISTINCT game_id), 0), 1) AS ppg, round(sum(points_allowed) / nullif(count(DISTINCT game_id), 0), 1) AS ppg_allowed FROM pts GROUP BY 1, 2, 3)"
query("season_points_ranked", lambda t: roll.season_points_ranked(t.points), w(CONTEXT, POINTS, SPOINTS, f"SELECT *, {ranks_sql({'ppg': 'desc', 'ppg_allowed': 'asc'})} FROM sp"))
DRIVES = "dr AS (SELECT *, drive_points > 0 AS is_scoring_drive, scrimmage_plays <= 3 AND NOT drive_points > 0 AS is_three_and_out FROM (SELECT season, run_id, game_id, drive_id, max(offense) AS offense, max(defense) AS defense, arg_min(yardline_100, play_id) AS start_yardline_100, CAST(sum(CASE WHEN is_pass_attempt OR is_rush_attempt THEN 1 ELSE 0 END) AS BIGINT) AS scrimmage_plays, CAST(sum(offense_points) AS BIGINT) AS drive_points FROM ctx WHERE drive_id IS NOT NULL GROUP BY 1, 2, 3, 4))"
query("drives", lambda t: t.drives, w(CONTEXT, DRIVES, "SELECT * FROM dr"))
_dsum = "count(*) AS drives, CAST(sum(scrimmage_plays) AS BIGINT) AS total_scrimmage_plays, CAST(sum(start_yardline_100) AS BIGINT) AS total_start_yardline_100, count(*) FILTER (is_scoring_drive) AS drives_scored, count(*) FILTER (is_three_and_out) AS drives_three_and_out"
for side, good, bad in (("offense", "ASC", "DESC"), ("defense", "DESC", "ASC")):
    query(f"drives_game_{side}", lambda t, s=side: roll.team_drives(t.drives, s, "game"), w(CONTEXT, DRIVES, f"SELECT season, run_id, game_id, {side} AS team_name, {_dsum} FROM dr GROUP BY season, run_id, game_id, {side}"))
    SD = f"sd AS (SELECT season, run_id, {side} AS team_name, count(DISTINCT game_id) AS games, {_dsum} FROM dr GROUP BY season, run_id, {side})"
    query(f"drives_season_{side}", lambda t, s=side: roll.team_drives(t.drives, s, "season"), w(CONTEXT, DRIVES, SD, "SELECT * FROM sd"))
    query(f"drives_{side}_ranked", lambda t, s=side: roll.season_drives_ranked(roll.team_drives(t.drives, s, "season"), s),
          w(CONTEXT, DRIVES, SD, f"SELECT *, round(total_scrimmage_plays / nullif(drives, 0), 2) AS avg_plays_per_drive, round(total_start_yardline_100 / nullif(drives, 0), 1) AS avg_start_yardline_100, round(100.0 * drives_scored / nullif(drives, 0), 1) AS pct_drives_scored, round(100.0 * drives_three_and_out / nullif(drives, 0), 1) AS pct_drives_three_and_out, round(total_scrimmage_plays / nullif(games, 0), 1) AS plays_per_game, rank() OVER (PARTITION BY season ORDER BY total_start_yardline_100 / nullif(drives, 0) {good} NULLS LAST) AS avg_start_yardline_100_rank, rank() OVER (PARTITION BY season ORDER BY 100.0 * drives_scored / nullif(drives, 0) {bad} NULLS LAST) AS pct_drives_scored_rank, rank() OVER (PARTITION BY season ORDER BY 100.0 * drives_three_and_out / nullif(drives, 0) {good} NULLS LAST) AS pct_drives_three_and_out_rank FROM sd"))
query("coverage_by_team", lambda t: roll.coverage(cur.of_current(t.read("schedule"), t.structure, "structure_run_id"), cur.of_current(t.read("plays"), cur.current_plays_runs(t.runs), "plays_run_id"), t.structure, cur.current_plays_runs(t.runs)),
      w(CURRENT, "a AS (SELECT season, team_name, count(DISTINCT game_id) AS scheduled_games FROM sched GROUP BY 1, 2), b AS (SELECT season, offense AS team_name, count(DISTINCT game_id) AS n FROM plays_now WHERE offense IS NOT NULL AND offense <> '' GROUP BY 1, 2)", "SELECT a.season, sr.structure_run_id, pr.plays_run_id, a.team_name, scheduled_games, coalesce(n, 0) AS pbp_games, scheduled_games - coalesce(n, 0) AS missing_pbp_games FROM a JOIN sr ON sr.season = a.season LEFT JOIN pr ON pr.season = a.season LEFT JOIN b ON b.season = a.season AND b.team_name = a.team_name"))
PASSING = "pg AS (SELECT season, run_id, game_id, offense AS team_name, passer, max(opponent) AS opponent, " + ", ".join(f"CAST(sum({X.BASE_SUMS[k]}) AS BIGINT) AS {k}" for k in ("pass_att", "pass_comp", "pass_yds", "pass_td", "pass_int")) + " FROM ctx WHERE is_pass_attempt AND passer IS NOT NULL AND passer <> '' GROUP BY season, run_id, game_id, offense, passer)"
query("player_game_passing", lambda t: roll.player_passing(t.ctx, "game"), w(CONTEXT, PASSING, f"SELECT *, {rating_sql('offense')} FROM pg"))
query("player_season_passing", lambda t: roll.player_passing(t.ctx, "season"), w(CONTEXT, PASSING, f"SELECT *, {rating_sql('offense')} FROM (SELECT season, run_id, team_name, passer, count(DISTINCT game_id) AS games, " + ", ".join(f"CAST(sum({k}) AS BIGINT) AS {k}" for k in ("pass_att", "pass_comp", "pass_yds", "pass_td", "pass_int")) + " FROM pg GROUP BY 1, 2, 3, 4)"))

# --- dashboard and report loaders ----------------------------------------------------------------------------------
def _grid(side: str, grain: str, family: str, where: str = "") -> str:
    names = [roll.metric_name(k, side) for k in load.FAMILIES[family] + load.FAMILY_RATES[family]] + ([roll.metric_name("passer_rating", side)] if family == "passing" else [])
    by = ["season", "team_name"] + (["game_id", "opponent", "home_away"] if grain == "game" else ["games"])
    src = f"b AS ({sums_sql('ctx', side, 'all', where)})" + (f", s AS ({season_sql('b', side, 'all')})" if grain == "season" else "")
    return w(CONTEXT, src, f"SELECT {', '.join([*by, *names])} FROM (SELECT *, {rates_sql(side, {k: X.RATES[k] for k in load.FAMILY_RATES[family]})}, {rating_sql(side)} FROM {'s' if grain == 'season' else 'b'})")


for side in ("offense", "defense"):
    for grain in ("season", "game"):
        for family in ("passing", "rushing"):
            query(f"dashboard_{side}_{grain}_{family}", lambda t, s=side, g=grain, f=family: load.team_stats(t.ctx, s, g, f), _grid(side, grain, family))
query("dashboard_filtered", lambda t: load.team_stats(t.ctx, "offense", "season", "passing", quarter=[3, 4], down=[1, 2], score_margin_bucket="tied"), _grid("offense", "season", "passing", " AND quarter IN (3, 4) AND down IN (1, 2) AND score_margin_bucket = 'tied'"))
query("list_teams", lambda t: load.distinct_values(t.ctx, "teams"), w(CONTEXT, "SELECT DISTINCT team_name FROM (SELECT offense AS team_name FROM ctx UNION SELECT defense FROM ctx) WHERE team_name IS NOT NULL AND team_name <> ''"))
query("list_seasons", lambda t: load.distinct_values(t.plays_now, "seasons"), w(CURRENT, "SELECT DISTINCT season FROM plays_now WHERE season IS NOT NULL"))
query("list_weeks", lambda t: load.distinct_values(t.ctx, "weeks").withColumn("week", F.col("week").cast("bigint")), w(CONTEXT, "SELECT DISTINCT week FROM ctx WHERE week IS NOT NULL"))
query("schedule_recap", lambda t: load.schedule_recap(t.standings_now, t.schedule_now), w(CURRENT, f"sc AS ({SCHEDULE}), stn AS ({STANDINGS})", "SELECT sc.season, sc.team_name, game_date, game_id, opponent, home_away, result, wins_entering_game, losses_entering_game, stn.conference, stn.wins, stn.losses, stn.ties FROM sc LEFT JOIN stn ON stn.season = sc.season AND stn.team_name = sc.team_name"))
_pairs = [(m, roll.metric_name(m, "defense")) for m in ("pass_pct", "pass_yds", "pass_ypa", "pass_td", "comp_pct", "pass_comp_10_plus", "pass_comp_20_plus", "pass_success_rate", "rush_pct", "rush_yds", "rush_ypa", "rush_td", "rush_10_plus", "rush_20_plus", "rush_success_rate")]
_full = {s: f"b{s[0]} AS ({sums_sql('ctx', s, 'all')}), s{s[0]} AS ({season_sql('b' + s[0], s, 'all')}), r{s[0]} AS (SELECT *, {rates_sql(s, X.RATES)}, {rating_sql(s)} FROM s{s[0]}), k{s[0]} AS (SELECT *, {ranks_sql({roll.metric_name(m, s): X.direction(m, s) for m in X.RANKED})} FROM r{s[0]})" for s in ("offense", "defense")}
MET = "met AS (SELECT DISTINCT season, offense AS team_name, defense AS opponent FROM ctx WHERE offense <> '' AND defense <> '')"
query("production_matchup", lambda t: load.matchup(t.season("offense"), t.season("defense"), _pairs, t.ctx.where("offense <> '' AND defense <> ''").select("season", F.col("offense").alias("team_name"), F.col("defense").alias("opponent")).distinct()),
      w(CONTEXT, _full["offense"], _full["defense"], MET, " UNION ALL ".join(f"SELECT met.season, met.team_name, met.opponent, '{a}' AS metric, CAST(ko.{a} AS DOUBLE) AS off_value, ko.{a}_rank AS off_rank, CAST(kd.{b} AS DOUBLE) AS def_value, kd.{b}_rank AS def_rank FROM met JOIN ko ON ko.season = met.season AND ko.team_name = met.team_name JOIN kd ON kd.season = met.season AND kd.team_name = met.opponent" for a, b in _pairs)))
query("success_by_down", lambda t: load.success_by_down(t.ctx), w(CONTEXT, "SELECT season, offense AS team_name, CAST(down AS BIGINT) AS down, count(*) FILTER (is_pass_attempt OR is_rush_attempt) AS att, count(*) FILTER (is_success) AS successes, round(100.0 * count(*) FILTER (is_success) / nullif(count(*) FILTER (is_pass_attempt OR is_rush_attempt), 0), 1) AS success_rate FROM ctx WHERE down BETWEEN 1 AND 4 AND offense <> '' GROUP BY 1, 2, 3"))
_tr = lambda o: f"count(*) FILTER (o = {o}) AS {'off' if o else 'def'}_plays, count(*) FILTER (o = {o} AND is_success) AS {'off' if o else 'def'}_successes, count(*) FILTER (o = {o} AND is_explosive) AS {'off' if o else 'def'}_explosive"
query("weekly_trends", lambda t: load.weekly_trends(t.ctx), w(CONTEXT, f"u AS (SELECT season, game_id, is_success, is_explosive, offense AS team_name, 1 AS o FROM ctx WHERE is_pass_attempt OR is_rush_attempt UNION ALL SELECT season, game_id, is_success, is_explosive, defense, 0 FROM ctx WHERE is_pass_attempt OR is_rush_attempt), a AS (SELECT season, game_id, team_name, {_tr(1)}, {_tr(0)} FROM u WHERE team_name <> '' GROUP BY 1, 2, 3)", "SELECT *, round(100.0 * off_successes / nullif(off_plays, 0), 1) AS off_success_rate, round(100.0 * def_successes / nullif(def_plays, 0), 1) AS def_success_rate, round(100.0 * off_explosive / nullif(off_plays, 0), 1) AS off_explosive_rate, round(100.0 * def_explosive / nullif(def_plays, 0), 1) AS def_explosive_rate FROM a"))
query("league_weekly", lambda t: load.league_weekly(t.ctx), w(CONTEXT, "SELECT season, week, count(*) FILTER (is_pass_attempt OR is_rush_attempt) AS att, count(*) FILTER (is_success) AS successes, round(100.0 * count(*) FILTER (is_success) / nullif(count(*) FILTER (is_pass_attempt OR is_rush_attempt), 0), 1) AS success_rate FROM ctx WHERE week IS NOT NULL GROUP BY 1, 2"))
query("quick_hitters", lambda t: load.quick_hitters(t.season("offense"), t.season("defense"), roll.season_points_ranked(t.points)), w(CONTEXT, _full["offense"], _full["defense"], POINTS, SPOINTS, f"kp AS (SELECT *, {ranks_sql({'ppg': 'desc', 'ppg_allowed': 'asc'})} FROM sp)", "SELECT coalesce(ko.season, kd.season, kp.season) AS season, coalesce(ko.team_name, kd.team_name, kp.team_name) AS team_name, success_rate, success_rate_rank, explosive_rate, explosive_rate_rank, opp_success_rate, opp_success_rate_rank, opp_explosive_rate, opp_explosive_rate_rank, ppg, ppg_rank, ppg_allowed, ppg_allowed_rank FROM ko FULL JOIN kd ON kd.season = ko.season AND kd.team_name = ko.team_name FULL JOIN kp ON kp.season = coalesce(ko.season, kd.season) AND kp.team_name = coalesce(ko.team_name, kd.team_name)"))
query("identity", lambda t: load.identity(t.season("offense"), roll.season_drives_ranked(roll.team_drives(t.drives, "offense", "season"), "offense"), t.season("offense", "situation")),
      w(CONTEXT, _full["offense"], DRIVES, f"sd AS (SELECT season, run_id, offense AS team_name, count(DISTINCT game_id) AS games, {_dsum} FROM dr GROUP BY season, run_id, offense), {LENSES}, bs AS ({sums_sql('lens', 'offense', 'situation')}), ss AS ({season_sql('bs', 'offense', 'situation')}), e AS (SELECT season, team_name, {_rate('rush_att', 'pass_att + rush_att', 100, 1)} AS early_rush_pct FROM ss WHERE situation = 'early_down')", "SELECT ko.season, ko.team_name, rush_pct, pass_pct, rush_ypa, pass_ypa, success_rate, round(avg(rush_ypa) OVER (PARTITION BY ko.season), 4) AS avg_rush_ypa, round(avg(pass_ypa) OVER (PARTITION BY ko.season), 4) AS avg_pass_ypa, round(total_start_yardline_100 / nullif(drives, 0), 1) AS avg_start_yardline_100, round(100.0 * drives_scored / nullif(drives, 0), 1) AS pct_drives_scored, round(total_scrimmage_plays / nullif(sd.games, 0), 1) AS plays_per_game, round(total_scrimmage_plays / nullif(drives, 0), 2) AS avg_plays_per_drive, early_rush_pct FROM ko LEFT JOIN sd ON sd.season = ko.season AND sd.team_name = ko.team_name LEFT JOIN e ON e.season = ko.season AND e.team_name = ko.team_name"))
_pt = lambda who, side, cat, v, cond: f"SELECT season, {side} AS team_name, {who} AS player, '{cat}' AS category, {v} AS v FROM ctx WHERE {who} IS NOT NULL AND {who} <> '' AND {side} <> '' AND ({cond})"
TOTALS = "tot AS (SELECT season, team_name, player, category, CAST(sum(v) AS BIGINT) AS total FROM (" + " UNION ALL ".join([_pt("passer", "offense", "passing_yards", X.BASE_SUMS["pass_yds"], "is_pass_attempt"), _pt("rusher", "offense", "rushing_yards", "coalesce(yards_gained, 0)", "is_rush_attempt AND NOT coalesce(is_sack, FALSE)"), _pt("receiver", "offense", "receiving_yards", "coalesce(yards_gained, 0)", "completion"), _pt("tackler_1", "defense", "tackles", "1", "TRUE"), _pt("tackler_2", "defense", "tackles", "1", "TRUE"), _pt("tackler_1", "defense", "sacks", "1", "is_sack")]) + ") GROUP BY 1, 2, 3, 4)"
_MOST = {"passing_yards": 2, "rushing_yards": 2, "receiving_yards": 3, "tackles": 2, "sacks": 2}


def _leaders(t: Tables) -> DataFrame:
    from functools import reduce

    totals = load.player_totals(t.ctx)
    return reduce(lambda a, b: a.unionByName(b), [load.team_leaders(totals.where(F.col("category") == c), "total", n) for c, n in _MOST.items()])


query("team_leaders", _leaders, w(CONTEXT, TOTALS, "r AS (SELECT *, row_number() OVER (PARTITION BY season, team_name, category ORDER BY total DESC, player) AS place FROM tot)", "SELECT * FROM r WHERE place <= CASE category WHEN 'receiving_yards' THEN 3 ELSE 2 END"))

# --- the older rule set --------------------------------------------------------------------------------------------
OLD = f"sc1 AS (SELECT * EXCLUDE (is_early_down), {', '.join(f'{v} AS {k}' for k, v in old.FLAGS.items())} FROM ctx WHERE play_type IN ('rush', 'pass'))"


def _table_sql(name: str, side: str) -> str:
    where, metrics = old.TABLES[name]
    s, o = [], []
    for k, m in metrics.items():
        for i, part in enumerate([m] if isinstance(m, str) else m[:2]):
            s.append(f"CAST(sum({old.value_of(part)}) AS BIGINT) AS {k}_{i}")
        o.append(f"{k}_0 AS {k}" if isinstance(m, str) else f"coalesce(round(CAST({m[2]} AS DOUBLE) * {k}_0 / nullif({k}_1, 0), {m[3]}), 0) AS {k}")
    src = f"t1 AS (SELECT *, {side} AS team FROM sc1 WHERE {side} IS NOT NULL AND {side} <> '' AND ({where})), t2 AS (SELECT season, team, {', '.join(s)} FROM t1 GROUP BY season, team), t3 AS (SELECT season, team, {', '.join(o)} FROM t2)"
    return w(CONTEXT, OLD, src, f"SELECT *, {ranks_sql({k: old.way(name, k, side) for k in metrics})} FROM t3")


for name in old.TABLES:
    for side in ("offense", "defense"):
        query(f"table_{name}_{side}", lambda t, n=name, s=side: old.team_table(t.old, n, s), _table_sql(name, side))
OUT = "v AS (SELECT *, max(CASE WHEN play_type = 'field_goal' AND fg_result = 'good' THEN 1 ELSE 0 END) OVER (PARTITION BY season, run_id, game_id, drive_id) AS drive_fg FROM ctx WHERE drive_id IS NOT NULL AND drive_id <> 0), oc AS (SELECT *, greatest(td, fg) AS score, CASE WHEN plays <= 3 AND greatest(td, fg) = 0 THEN 1 ELSE 0 END AS three_out, td * 7 + fg * 3 AS points FROM (SELECT season, run_id, game_id, drive_id, offense, defense, count(play_id) AS plays, max(CASE WHEN is_td THEN 1 ELSE 0 END) AS td, max(drive_fg) AS fg, arg_min(yardline_100, play_id) AS start_yardline FROM v WHERE play_type IN ('rush', 'pass') GROUP BY 1, 2, 3, 4, 5, 6))"
for side in ("offense", "defense"):
    _low = {"three_out_rate", "avg_start_pos"}
    _fd = ["drives", "scoring_rate", "td_rate", "fg_rate", "three_out_rate", "avg_start_pos", "avg_plays", "pts_per_drive"]
    query(f"table_finishing_drives_{side}", lambda t, s=side: old.finishing_drives(t.outcomes, s), w(CONTEXT, OUT, f"f AS (SELECT season, {side} AS team, count(*) AS drives, " + ", ".join(f"round(100.0 * sum({c}) / count(*), 1) AS {n}" for c, n in (("score", "scoring_rate"), ("td", "td_rate"), ("fg", "fg_rate"), ("three_out", "three_out_rate"))) + f", coalesce(round(sum(start_yardline) / nullif(count(start_yardline), 0), 1), 0) AS avg_start_pos, round(sum(plays) / count(*), 2) AS avg_plays, round(sum(points) / count(*), 2) AS pts_per_drive FROM oc WHERE {side} <> '' GROUP BY 1, 2)", f"SELECT *, {ranks_sql({m: 'asc' if (m in _low) == (side == 'offense') else 'desc' for m in _fd})} FROM f"))
    query(f"table_hidden_yards_{side}", lambda t, s=side: old.hidden_yards(t.outcomes, s), w(CONTEXT, OUT, f"SELECT season, {side} AS team, " + ", ".join(f"count(*) FILTER ({c}) AS {z}_drives, coalesce(round(sum(points) FILTER ({c}) / nullif(count(*) FILTER ({c}), 0), 2), 0) AS {z}_pts" for z, c in old.ZONES.items()) + f" FROM oc WHERE start_yardline IS NOT NULL AND {side} <> '' GROUP BY 1, 2"))
    _c = lambda x: f"count(*) FILTER ({x})"
    _r = lambda a, b, s=100.0, k=1: f"coalesce(round(CAST({s} AS DOUBLE) * {a} / nullif({b}, 0), {k}), 0)"
    query(f"table_redzone_{side}", lambda t, s=side: old.red_zone(t.ctx, s),
          w(CONTEXT, f"fl AS (SELECT *, {', '.join(f'{v} AS {k}' for k, v in old.FLAGS.items() if k not in ('passing_down', 'early_down'))}, {side} AS team FROM ctx WHERE {side} <> ''), rz AS (SELECT *, redzone AND play_type IN ('rush', 'pass') AS in_rz FROM fl), pd AS (SELECT season, team, run_id, game_id, drive_id, max(CASE WHEN in_rz THEN 1 ELSE 0 END) AS rz, max(CASE WHEN drive_id <> 0 THEN 1 ELSE 0 END) AS real FROM rz GROUP BY 1, 2, 3, 4, 5), en AS (SELECT season, run_id, game_id, drive_id, max(CASE WHEN is_td THEN 1 ELSE 0 END) AS td, max(CASE WHEN play_type = 'field_goal' AND fg_result = 'good' THEN 1 ELSE 0 END) AS fg FROM ctx WHERE drive_id IS NOT NULL GROUP BY 1, 2, 3, 4), d AS (SELECT pd.season, pd.team, sum(real) AS total, sum(rz) AS rz_drives, sum(CASE WHEN rz = 1 THEN td ELSE 0 END) AS n_td, sum(CASE WHEN rz = 1 THEN fg ELSE 0 END) AS n_fg, sum(CASE WHEN rz = 1 THEN greatest(td, fg) ELSE 0 END) AS n_score FROM pd LEFT JOIN en USING (season, run_id, game_id, drive_id) GROUP BY 1, 2), p AS (SELECT season, team, count(*) AS n, {_c('rush')} AS n_rush, {_c('pass_try')} AS n_pass, sum(CASE WHEN rush THEN coalesce(yards_gained, 0) ELSE 0 END) AS rush_yds, {_c('rush AND yards_gained IS NOT NULL')} AS rush_known, {_c('run_stuff')} AS stuffs, {_c('rush AND td')} AS rush_td, {_c('pass_try AND caught')} AS comps, {_c('pass_try AND td')} AS pass_td, count(*) FILTER (pass_try AND pass_result = 'int') AS ints FROM rz WHERE in_rz GROUP BY 1, 2)",
            f"SELECT season, team, CAST(rz_drives AS BIGINT) AS rz_drives, {_r('rz_drives', 'total')} AS rz_drive_pct, {_r('n_td', 'rz_drives')} AS td_pct, {_r('n_fg', 'rz_drives')} AS fg_pct, {_r('n_score', 'rz_drives')} AS score_pct, {_r('(rz_drives - n_score)', 'rz_drives')} AS stop_pct, {_r('n_rush', 'n')} AS rush_pct, {_r('rush_yds', 'rush_known', 1.0, 2)} AS rush_ypa, {_r('stuffs', 'n_rush')} AS run_stuff_pct, rush_td, {_r('n_pass', 'n')} AS pass_pct, {_r('comps', 'n_pass')} AS comp_pct, pass_td, ints AS interceptions FROM p JOIN d USING (season, team)"))
_ch = {"success_rate": ("success", "TRUE"), "explosive_rate": ("explosive", "TRUE"), "stuff_rate": ("run_stuff", "rush"), "third_down_rate": ("down = 3 AND success", "down = 3"), "early_rush_rate": ("early_down AND rush", "early_down"), "passing_down_pass_rate": ("passing_down AND play_type = 'pass'", "passing_down"), "first_half_success": ("quarter <= 2 AND success", "quarter <= 2"), "second_half_success": ("quarter >= 3 AND success", "quarter >= 3")}
query("chart_games", lambda t: old.game_charts(t.old), w(CONTEXT, OLD, "ro AS (SELECT *, offense AS team, 'offense' AS side FROM sc1 UNION ALL SELECT *, defense, 'defense' FROM sc1)", "SELECT season, game_id, team, side, " + ", ".join(f"round(100.0 * count(*) FILTER ({a}) / nullif(count(*) FILTER ({b}), 0), 1) AS {k}" for k, (a, b) in _ch.items()) + ", CAST(sum(coalesce(penalty_yards, 0)) AS BIGINT) AS penalty_yards FROM ro WHERE team <> '' GROUP BY 1, 2, 3, 4"))
query("chart_conversions", lambda t: old.conversion_by_distance(t.old), w(CONTEXT, OLD, "SELECT season, offense AS team, CASE WHEN distance = 1 THEN '1' WHEN distance <= 3 THEN '2-3' WHEN distance <= 6 THEN '4-6' WHEN distance <= 10 THEN '7-10' ELSE '11+' END AS band, count(*) AS attempts, count(*) FILTER (success) AS conversions, round(100.0 * count(*) FILTER (success) / count(*), 1) AS rate FROM sc1 WHERE down IN (3, 4) AND offense <> '' AND distance BETWEEN 1 AND 99 GROUP BY 1, 2, 3"))
query("season_check", lambda t: old.season_check(t.ctx), w(CONTEXT, "SELECT season, offense AS team, game_id, count(*) FILTER (is_pass_attempt) AS pass_att, count(*) FILTER (completion) AS pass_comp, count(*) FILTER (is_rush_attempt) AS rush_att, count(*) FILTER (is_td) AS td FROM ctx WHERE offense <> '' GROUP BY GROUPING SETS ((season, offense, game_id), (season, offense))"))
query("health_missing_games", lambda t: cur.of_current(t.read("schedule"), t.structure, "structure_run_id").select("season", "team_name", "game_id").distinct().join(t.plays_now.select("season", "game_id").distinct(), ["season", "game_id"], "left_anti"), w(CURRENT, "SELECT DISTINCT season, team_name, game_id FROM sched WHERE NOT EXISTS (SELECT 1 FROM plays_now p WHERE p.season = sched.season AND p.game_id = sched.game_id)"))
query("box_summary", lambda t: old.box_summary(t.ctx), w(CONTEXT, f"SELECT season, game_id, offense AS team, count(*) FILTER (is_rush_attempt) AS rush_att, CAST(sum(CASE WHEN is_rush_attempt THEN {old.Y} ELSE 0 END) AS BIGINT) AS rush_yds, count(*) FILTER (is_pass_attempt) AS pass_att, count(*) FILTER (completion) AS pass_comp, CAST(sum(CASE WHEN completion THEN {old.Y} ELSE 0 END) AS BIGINT) AS pass_yds, count(*) FILTER (is_interception) AS ints, count(*) FILTER (is_fumble) AS fumbles, CAST(sum(coalesce(penalty_yards, 0)) AS BIGINT) AS penalty_yards FROM ctx WHERE offense <> '' AND NOT coalesce(is_penalty AND penalty_team IS NOT NULL AND prefix_owner = offense AND penalty_team = field_pos_prefix, FALSE) GROUP BY 1, 2, 3"))
query("report_production", lambda t: old.report_rows(old.team_table(t.old, "production", "offense"), ["pass_pct", "pass_yards", "comp_pct", "rush_yards"]), _table_sql("production", "offense").replace("WITH ", "WITH ", 1).replace(") SELECT *,", "), t4 AS (SELECT *,", 1).rsplit(" FROM t3", 1)[0] + " FROM t3) " + " UNION ALL ".join(f"SELECT season, team, '{m}' AS metric, printf('%.1f', CAST({m} AS DOUBLE)) || ' (' || {m}_rank || CASE WHEN {m}_rank % 100 BETWEEN 11 AND 13 THEN 'th' WHEN {m}_rank % 10 = 1 THEN 'st' WHEN {m}_rank % 10 = 2 THEN 'nd' WHEN {m}_rank % 10 = 3 THEN 'rd' ELSE 'th' END || ')' AS text FROM t4" for m in ["pass_pct", "pass_yards", "comp_pct", "rush_yards"]))

# --- field-position crosswalk --------------------------------------------------------------------------------------
_grp = f"g0 AS (SELECT season, run_id, game_id, play_id, nullif(trim({_pos.format(n=_norm, g=1)}), '') AS prefix FROM plays_now), grp AS (SELECT season, run_id, game_id, prefix, count(*) AS play_count, min(play_id) AS first_play_id, max(play_id) AS last_play_id FROM g0 WHERE prefix IS NOT NULL GROUP BY 1, 2, 3, 4)"
query("crosswalk_typed", lambda t: t.walk, w(CURRENT, "SELECT * FROM walk"))
query("prefix_groups", lambda t: t.groups, w(CURRENT, _grp, "SELECT * FROM grp"))
query("crosswalk_apply", lambda t: xw.apply_crosswalk(t.plays_now, t.walk).select("season", "run_id", "game_id", "play_id", "field_pos_prefix", "prefix_owner", "field_pos_side", "yardline_100", "field_position_status"), w(CONTEXT, "SELECT season, run_id, game_id, play_id, field_pos_prefix, prefix_owner, field_pos_side, yardline_100, field_position_status FROM ctx"))
query("crosswalk_draft", lambda t: xw.draft_crosswalk(t.groups), w(CURRENT, _grp, "SELECT season, run_id, game_id, l[1] AS prefix_a, l[2] AS prefix_b, CASE WHEN len(l) = 1 THEN 'only one prefix' WHEN len(l) > 2 THEN len(l) || ' prefixes' ELSE '' END AS note FROM (SELECT season, run_id, game_id, list_sort(list(DISTINCT prefix)) AS l FROM grp GROUP BY 1, 2, 3)"))
query("crosswalk_review_queue", lambda t: xw.review_queue(t.groups, t.walk), w(CURRENT, _grp, "a AS (SELECT grp.*, w.canonical_team, row_number() OVER (PARTITION BY season, run_id, grp.game_id ORDER BY grp.prefix) AS rn FROM grp LEFT JOIN walk w ON w.game_id = grp.game_id AND w.prefix = grp.prefix), b AS (SELECT season, run_id, game_id, max(CASE WHEN rn = 1 THEN prefix END) AS prefix_1, max(CASE WHEN rn = 2 THEN prefix END) AS prefix_2, count(canonical_team) AS resolved, count(*) AS total FROM a GROUP BY 1, 2, 3)", "SELECT *, row_number() OVER (PARTITION BY season ORDER BY game_id, run_id) AS queue_no FROM b WHERE resolved < total"))
query("crosswalk_memory", lambda t: xw.prefix_memory(t.walk).select("canonical_team", F.array_join("prefixes", "|").alias("prefixes")), w(CURRENT, "SELECT canonical_team, string_agg(DISTINCT prefix, '|' ORDER BY prefix) AS prefixes FROM walk GROUP BY 1"))
query("crosswalk_seed", lambda t: xw.seed_crosswalk(t.groups, t.walk, t.games_now),
      w(CURRENT, _grp, "gm AS (SELECT game_id, max(schedule_home) AS h, max(schedule_away) AS a FROM games g JOIN sr ON sr.season = g.season AND sr.structure_run_id = g.run_id GROUP BY 1 HAVING max(schedule_home) IS NOT NULL AND max(schedule_away) IS NOT NULL), td AS (SELECT DISTINCT game_id, prefix FROM grp WHERE game_id NOT IN (SELECT game_id FROM walk)), td2 AS (SELECT *, count(*) OVER (PARTITION BY game_id) AS n FROM td), h AS (SELECT t.game_id, t.prefix, gm.h, gm.a, count(DISTINCT w.canonical_team) AS m, max(w.canonical_team) AS team FROM td2 t JOIN gm USING (game_id) LEFT JOIN walk w ON w.prefix = t.prefix AND w.canonical_team IN (gm.h, gm.a) WHERE n = 2 GROUP BY 1, 2, 3, 4), x AS (SELECT *, count(*) FILTER (m = 1) OVER p AS single, count(*) FILTER (m > 1) OVER p AS ambiguous, max(CASE WHEN m = 1 THEN team END) OVER p AS one, min(CASE WHEN m = 1 THEN team END) OVER p AS least FROM h WINDOW p AS (PARTITION BY game_id))", "SELECT game_id, prefix, CASE WHEN m = 1 THEN team WHEN one = h THEN a ELSE h END AS canonical_team FROM x WHERE ambiguous = 0 AND (single = 1 OR (single = 2 AND one <> least))"))
