"""Queries of the report pages, rosters and checks; their SQL is written apart from the plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldlog.functions import expr as X
from fieldlog.operators import folds, reporting, rosters, silver
from fieldlog.operators import rollups as roll
from fieldlog.plans import reports as R
from fieldlog.plans.reports import CONTEXT, CURRENT, LENSES, query, w

_met = lambda t: t.ctx.where("offense <> '' AND defense <> ''").select("season", F.col("offense").alias("team_name"), F.col("defense").alias("opponent")).distinct()


def _situation(side: str) -> str:
    c = side[0]
    ranks = R.ranks_sql({roll.metric_name(m, side): X.direction(m, side) for m in X.SITUATION_RANKED}, "season, situation")
    return f"b{c} AS ({R.sums_sql('lens', side, 'situation')}), s{c} AS ({R.season_sql('b' + c, side, 'situation')}), r{c} AS (SELECT *, {R.rates_sql(side, X.SITUATION_RATES)} FROM s{c}), k{c} AS (SELECT *, {ranks} FROM r{c})"


_lines = " UNION ALL ".join(
    f"SELECT met.season, met.team_name, met.opponent, '{s}' AS situation, '{m}' AS metric, CAST(ko.{m} AS DOUBLE) AS off_value, {'NULL' if m == 'avg_distance' else f'ko.{m}_rank'} AS off_rank, CAST(kd.opp_{m} AS DOUBLE) AS def_value, {'NULL' if m == 'avg_distance' else f'kd.opp_{m}_rank'} AS def_rank FROM met LEFT JOIN ko ON ko.season = met.season AND ko.team_name = met.team_name AND ko.situation = '{s}' LEFT JOIN kd ON kd.season = met.season AND kd.team_name = met.opponent AND kd.situation = '{s}'"
    for s, m in reporting.TRIMMED
)
query("situation_trimmed", lambda t: reporting.situation_trimmed(t.season("offense", "situation"), t.season("defense", "situation"), _met(t)), w(CONTEXT, LENSES, _situation("offense"), _situation("defense"), "met AS (SELECT season, offense AS team_name, defense AS opponent FROM ctx WHERE offense <> '' AND defense <> '' UNION SELECT season, defense, offense FROM ctx WHERE offense <> '' AND defense <> '')", _lines))
query("success_by_down_sides", lambda t: reporting.success_by_down_sides(t.ctx), w(CONTEXT, "u AS (SELECT season, offense AS team_name, 'offense' AS side, down, is_pass_attempt OR is_rush_attempt AS a, is_success AS y FROM ctx UNION ALL SELECT season, defense, 'defense', down, is_pass_attempt OR is_rush_attempt, is_success FROM ctx)", "SELECT season, team_name, side, CAST(down AS BIGINT) AS down, count(*) FILTER (a) AS att, count(*) FILTER (y) AS successes, round(100.0 * count(*) FILTER (y) / nullif(count(*) FILTER (a), 0), 1) AS success_rate FROM u WHERE down IN (1, 2, 3, 4) AND team_name <> '' GROUP BY 1, 2, 3, 4"))
_bullets = " UNION ALL ".join(f"SELECT season, team_name, '{s}' AS side, '{f}' AS family, '{m}' AS metric, CAST({roll.metric_name(m, s)} AS DOUBLE) AS value, {roll.metric_name(m, s)}_rank AS place FROM k{s[0]}" for s in ("offense", "defense") for f, ms in (("rushing", reporting.RUSHING), ("passing", reporting.PASSING)) for m in ms)
query("identity_lines", lambda t: reporting.identity_lines(t.season("offense"), t.season("defense")), w(CONTEXT, R._full["offense"], R._full["defense"], _bullets))
query("identity_averages", lambda t: reporting.identity_averages(t.season("offense"), t.season("defense")), w(CONTEXT, R._full["offense"], R._full["defense"], "SELECT season, team_name, 'offense' AS side, rush_ypa, pass_ypa, round(avg(rush_ypa) OVER (PARTITION BY season), 2) AS season_rush_ypa, round(avg(pass_ypa) OVER (PARTITION BY season), 2) AS season_pass_ypa FROM ko UNION ALL SELECT season, team_name, 'defense', opp_rush_ypa, opp_pass_ypa, round(avg(opp_rush_ypa) OVER (PARTITION BY season), 2), round(avg(opp_pass_ypa) OVER (PARTITION BY season), 2) FROM kd"))
query("game_offense_all_runs", lambda t: reporting.game_offense_all_runs(t.read("plays")), "SELECT season, run_id, game_id, offense AS team_name, max(schedule_home) AS schedule_home, max(schedule_away) AS schedule_away, count(*) FILTER (is_pass_attempt) AS pass_att, count(*) FILTER (completion) AS pass_comp, CAST(coalesce(sum(yards_gained) FILTER (play_type = 'pass' AND is_sack IS NOT TRUE AND is_interception IS NOT TRUE), 0) AS BIGINT) AS pass_yds, count(*) FILTER (is_interception) AS pass_int, count(*) FILTER (play_type = 'pass' AND is_td) AS pass_td, count(*) FILTER (is_rush_attempt) AS rush_att, CAST(coalesce(sum(yards_gained) FILTER (is_rush_attempt), 0) AS BIGINT) AS rush_yds, count(*) FILTER (is_rush_attempt AND is_td) AS rush_td, count(*) FILTER (is_sack) AS sacks, count(*) FILTER (is_dropback) AS dropbacks, count(*) AS play_count FROM (SELECT DISTINCT * FROM plays) WHERE length(offense) > 0 GROUP BY 1, 2, 3, 4")
for _name, _side, _metric, _down in (("offense_desc", "offense", "pass_yds", True), ("offense_asc", "offense", "pass_yds", False), ("defense_desc", "defense", "opp_pass_yds", True)):
    _best = (_side == "offense") == _down
    query(f"display_places_{_name}", lambda t, s=_side, m=_metric, d=_down: reporting.sorted_with_places(t.season(s), m, s, d, ["season", "team_name"]), w(CONTEXT, R._full[_side], f"v AS (SELECT season, team_name, {_metric}, row_number() OVER (PARTITION BY season ORDER BY {_metric} {'DESC' if _down else 'ASC'} NULLS LAST, team_name) AS row, count(*) OVER (PARTITION BY season) AS n FROM k{_side[0]})", f"SELECT season, team_name, {_metric}, row, {'row' if _best else 'n - row + 1'} AS place FROM v"))
query("health_balance", lambda t: reporting.balance(t.ctx), w(CONTEXT, "a AS (SELECT season, game_id, offense AS team, count(*) AS as_offense, max(nullif(defense, '')) AS opponent FROM ctx WHERE offense <> '' GROUP BY 1, 2, 3)", "SELECT a.*, (SELECT count(*) FROM ctx c WHERE c.season = a.season AND c.game_id = a.game_id AND c.defense = a.opponent AND c.defense <> '') AS faced, as_offense = (SELECT count(*) FROM ctx c WHERE c.season = a.season AND c.game_id = a.game_id AND c.defense = a.opponent AND c.defense <> '') AS balanced FROM a"))
query("health_coverage", lambda t: reporting.coverage_health(roll_coverage(t)), f"SELECT season, team_name, missing_pbp_games, CASE WHEN missing_pbp_games <= 0 THEN 'complete' WHEN missing_pbp_games = 1 THEN 'allowed' ELSE 'short' END AS health FROM ({R.SQL['coverage_by_team']})")
_features = ["start", "plays", "successes", "explosives", "penalties", "sacks", "scored"]
_pairs = [(a, b) for i, a in enumerate(_features) for b in _features[i + 1 :]]
query("drive_correlations", lambda t: reporting.correlations(folds.drive_features(t.ctx), _features, 4), "SELECT *, rank() OVER (ORDER BY abs(r) DESC NULLS LAST) AS place FROM (" + " UNION ALL ".join(f"SELECT '{a}' AS one, '{b}' AS other, round(corr({a}, {b}), 4) AS r FROM f" for a, b in _pairs) + ")")
R.SQL["drive_correlations"] = f"WITH f AS ({R.SQL['drive_features']}) " + R.SQL["drive_correlations"]
query("scoring_leaders", lambda t: reporting.leaders(roll.season_points_ranked(t.points).select("season", "team_name", "ppg"), "ppg", 15), w(CONTEXT, R.POINTS, R.SPOINTS, "SELECT * FROM (SELECT season, team_name, ppg, row_number() OVER (PARTITION BY season ORDER BY ppg DESC NULLS LAST, team_name) AS place FROM sp) WHERE place <= 15"))
query("first_games", lambda t: silver.first_games(t.games_now.select("season", "game_id"), 5), w(CURRENT, "g AS (SELECT DISTINCT * FROM games), n AS (SELECT g.season, g.game_id FROM g JOIN sr ON sr.season = g.season AND sr.structure_run_id = g.run_id)", "SELECT * FROM n WHERE game_id IN (SELECT game_id FROM (SELECT DISTINCT game_id FROM n WHERE game_id IS NOT NULL) ORDER BY game_id LIMIT 5)"))


def roll_coverage(t: R.Tables):  # noqa: ANN201
    return R.Q_MAKE["coverage_by_team"](t)


_roster = lambda t: t.read("pbp_names").select("season", "team", F.trim("canonical_name").alias("name"))
_words = "string_split_regex(trim(lower(name)), '\\s+')"
ROSTER = f"ro AS (SELECT *, left({_words}[1], 1) AS a, left({_words}[len({_words})], 6) AS b FROM (SELECT DISTINCT season, team, trim(canonical_name) AS name FROM pbp_names WHERE trim(canonical_name) <> ''))"
query("roster_distinct", lambda t: rosters.distinct_players(_roster(t)), w(ROSTER, "SELECT season, team, name FROM ro x WHERE NOT EXISTS (SELECT 1 FROM ro y WHERE y.season = x.season AND y.team = x.team AND y.a = x.a AND y.b = x.b AND y.name <> x.name AND starts_with(y.name, x.name))"))
_fit = " OR ".join(f"(list_contains(string_split(role, '/'), '{r}') AND list_has_any(string_split_regex(upper(position), '[/\\s]+'), [{', '.join(chr(39) + p + chr(39) for p in ps)}]))" for r, ps in rosters.FITS.items())
query("names_chosen", lambda t: rosters.choose(t.read("pbp_names").where("trim(canonical_name) <> ''").select("season", "team", "pbp_name", "role", F.trim("canonical_name").alias("canonical"), "position").where("trim(pbp_name) <> ''")), w(f"c AS (SELECT season, team, pbp_name, trim(canonical_name) AS canonical, max(CASE WHEN coalesce(trim(position), '') = '' THEN 0 WHEN coalesce({_fit}, FALSE) THEN 2 ELSE -1 END) AS score FROM pbp_names WHERE trim(canonical_name) <> '' AND trim(pbp_name) <> '' GROUP BY 1, 2, 3, 4), k AS (SELECT season, team, pbp_name, count(*) AS n, max(score) AS best, max(length(canonical)) AS longest FROM c GROUP BY ALL), j AS (SELECT k.*, c.canonical, c.score, count(*) FILTER (c.score = best) OVER v AS n_best, count(*) FILTER (length(c.canonical) = longest) OVER v AS n_long FROM k JOIN c ON c.season IS NOT DISTINCT FROM k.season AND c.team IS NOT DISTINCT FROM k.team AND c.pbp_name = k.pbp_name WINDOW v AS (PARTITION BY k.season, k.team, k.pbp_name))", "SELECT season, team, pbp_name, max(canonical) FILTER (n = 1 OR best > 0 AND n_best = 1 AND score = best OR best <= 0 AND n_long = 1 AND length(canonical) = longest) AS canonical, CASE WHEN max(n) = 1 THEN 'alone' WHEN max(best) > 0 AND max(n_best) = 1 THEN 'role' WHEN max(best) <= 0 AND max(n_long) = 1 THEN 'longest' ELSE 'ambiguous' END AS how FROM j GROUP BY 1, 2, 3"))
_known = lambda t: t.read("pbp_names").where("trim(canonical_name) <> ''").select("season", "team", "pbp_name", F.trim("canonical_name").alias("canonical"))
_look = lambda c, *sides: f"coalesce({', '.join(f'(SELECT k.canonical FROM kn k WHERE k.season = p.season AND k.team = p.{s} AND k.pbp_name = p.{c})' for s in sides)}, p.{c}) AS {c}"
query("names_applied", lambda t: rosters.apply_names(t.plays_now, _known(t), ["run_id", "game_id", "play_id"]), w(CURRENT, "kn AS (SELECT season, team, pbp_name, min(trim(canonical_name)) AS canonical FROM pbp_names WHERE trim(canonical_name) <> '' AND team <> '' GROUP BY 1, 2, 3)", f"SELECT run_id, game_id, play_id, {_look('passer', 'offense')}, {_look('rusher', 'offense')}, {_look('receiver', 'offense')}, {_look('tackler_1', 'defense')}, {_look('tackler_2', 'defense')}, {_look('penalty_player', 'offense', 'defense')} FROM plays_now p"))
