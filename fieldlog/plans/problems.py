"""Queries of the two core data-quality problems, with the SQL they are held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlog.operators.ledger import completed_runs, numbered
from fieldlog.operators.references import dangling, dangling_report
from fieldlog.operators.snapshots import changes
from fieldlog.sources.tables import table

COUNTS = ["conf_w", "conf_l", "conf_t", "overall_w", "overall_l", "overall_t"]


def run_references(spark: SparkSession, folder: str) -> DataFrame:
    """Dangling values of the four references between plays, games, schedule, standings and the list of clubs."""
    games, plays, schedule, standings = (table(spark, folder, x) for x in ("games", "plays", "schedule", "standings"))
    ledger = table(spark, folder, "pipeline_runs")
    structure = numbered(completed_runs(ledger, games), "ord")
    play_keys = plays.select("run_id", "game_id").distinct()
    # The structure runs begun no later than a plays run are counted by a running sum over both.
    seeking = completed_runs(ledger, play_keys)
    marks = structure.select("season", "run_id", "started_at", F.lit(1).alias("is_structure")).unionByName(seeking.select("season", "run_id", "started_at", F.lit(0).alias("is_structure")))
    marks = marks.selectExpr("*", "sum(is_structure) over (partition by season order by started_at nulls first range between unbounded preceding and current row) as seek").where("is_structure = 0")

    own = structure.select("run_id", "season", F.col("ord").alias("seek"))

    def refs(name: str, parent: str, rows: DataFrame, column: str, runs: DataFrame, seek: object = "seek") -> DataFrame:
        found = rows.select("run_id", F.col(column).alias("value")).distinct().join(runs, "run_id")
        return found.select(F.lit(name).alias("ref_name"), F.lit(parent).alias("parent_name"), "season", "run_id", seek, "value")

    def parents(name: str, rows: DataFrame, column: str) -> DataFrame:
        return rows.select("run_id", F.col(column).alias("value")).distinct().join(structure.drop("started_at"), "run_id").select(F.lit(name).alias("parent_name"), "season", "ord", "value")

    all_refs = [
        refs("plays.game_id", "games", play_keys, "game_id", marks.select("run_id", "season", "seek")),
        refs("games.game_id", "schedule", games, "game_id", own),
        refs("schedule.opponent", "standings", schedule, "opponent", own),
        refs("standings.team_name", "team_list", standings, "team_name", own, F.lit(1).alias("seek")),
    ]
    clubs = table(spark, folder, "team_list").select(F.lit("team_list").alias("parent_name"), F.lit(None).cast("string").alias("season"), F.lit(1).alias("ord"), F.col("team_name").alias("value"))
    all_parents = [parents("games", games, "game_id"), parents("schedule", schedule, "game_id"), parents("standings", standings, "team_name"), clubs]
    union = lambda frames: frames[0] if len(frames) == 1 else frames[0].unionByName(union(frames[1:]))
    return dangling(union(all_refs), union(all_parents))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every dangling value with its run, reference and fate."""
    return run_references(spark, folder)


def p1_report(spark: SparkSession, folder: str) -> DataFrame:
    """Dangling values per reference, season and kind."""
    return dangling_report(run_references(spark, folder), table(spark, folder, "pipeline_runs"))


def run_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Changes of standings and plays between consecutive deliveries of a season."""
    ledger, plays, standings = (table(spark, folder, x) for x in ("pipeline_runs", "plays", "standings"))
    structure = numbered(completed_runs(ledger, table(spark, folder, "games")))
    delivered = numbered(completed_runs(ledger, plays))
    whole = {c: F.expr(f"cast(try_cast(trim({c}) as double) as bigint)") for c in COUNTS}
    clubs = changes(standings, structure, ["team_name"], {"conference": F.col("conference"), **whole})
    rows = changes(plays, delivered, ["game_id", "play_id"], {c: F.col(c) for c in plays.columns if c != "run_id"})
    return clubs.select(F.lit("standings").alias("table_name"), "run_id", F.col("team_name").alias("record_key"), F.lit(0).alias("play_id"), "change_kind").unionByName(
        rows.select(F.lit("plays").alias("table_name"), "run_id", F.col("game_id").alias("record_key"), F.col("play_id").cast("int"), "change_kind")
    )


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Records added, removed or changed in each run after a season's first."""
    return run_changes(spark, folder)


def p2_report(spark: SparkSession, folder: str) -> DataFrame:
    """Changes counted per run and table."""
    return run_changes(spark, folder).groupBy("table_name", "run_id", "change_kind").agg(F.count("*").alias("records"))


_RUNS = """
led AS (SELECT run_id, season, min(started_at) AS started_at FROM pipeline_runs WHERE status = 'completed' GROUP BY 1, 2),
st AS (SELECT *, row_number() OVER (PARTITION BY season ORDER BY started_at, run_id) AS ord FROM led WHERE run_id IN (SELECT run_id FROM games)),
pl AS (SELECT *, row_number() OVER (PARTITION BY season ORDER BY started_at, run_id) AS ord FROM led WHERE run_id IN (SELECT run_id FROM plays))"""

_P1 = f"""WITH {_RUNS},
seek AS (SELECT p.run_id, p.season, (SELECT max(s.ord) FROM st s WHERE s.season = p.season AND s.started_at <= p.started_at) AS ord FROM pl p),
ref AS (
  SELECT DISTINCT 'plays.game_id' AS ref_name, 'games' AS parent, s.season, s.run_id, s.ord, lower(trim(x.game_id)) AS v FROM plays x JOIN seek s USING (run_id)
  UNION ALL SELECT DISTINCT 'games.game_id', 'schedule', s.season, s.run_id, s.ord, lower(trim(x.game_id)) FROM games x JOIN st s USING (run_id)
  UNION ALL SELECT DISTINCT 'schedule.opponent', 'standings', s.season, s.run_id, s.ord, lower(trim(x.opponent)) FROM schedule x JOIN st s USING (run_id)
  UNION ALL SELECT DISTINCT 'standings.team_name', 'team_list', s.season, s.run_id, s.ord, lower(trim(x.team_name)) FROM standings x JOIN st s USING (run_id)),
par AS (
  SELECT DISTINCT 'games' AS parent, s.season, s.ord, lower(trim(x.game_id)) AS v FROM games x JOIN st s USING (run_id)
  UNION ALL SELECT DISTINCT 'schedule', s.season, s.ord, lower(trim(x.game_id)) FROM schedule x JOIN st s USING (run_id)
  UNION ALL SELECT DISTINCT 'standings', s.season, s.ord, lower(trim(x.team_name)) FROM standings x JOIN st s USING (run_id)),
found AS (SELECT ref_name, run_id, season, v AS ref_value,
  CASE WHEN parent = 'team_list' THEN 'missing'
       WHEN EXISTS (SELECT 1 FROM par p WHERE p.parent = r.parent AND p.season = r.season AND p.v = r.v AND p.ord > coalesce(r.ord, 0)) THEN 'late'
       WHEN EXISTS (SELECT 1 FROM par p WHERE p.parent = r.parent AND p.season = r.season AND p.v = r.v AND p.ord < coalesce(r.ord, 0)) THEN 'deleted'
       ELSE 'missing' END AS kind
FROM ref r WHERE v <> ''
  AND NOT EXISTS (SELECT 1 FROM par p WHERE p.parent = r.parent AND p.season = r.season AND p.v = r.v AND p.ord = r.ord)
  AND NOT (parent = 'team_list' AND v IN (SELECT lower(trim(team_name)) FROM team_list)))"""

PLAY_COLUMNS = """season game_id home_team away_team schedule_home schedule_away play_id drive_id drive_start_time quarter down distance field_position yardline_raw
offense defense play_type passer rusher receiver pass_result yards_gained is_dropback is_attempt is_conversion is_pass_attempt is_rush_attempt completion
is_interception is_td is_sack is_fumble fumble_recovered_by is_safety is_defensive_td is_penalty penalty_team penalty_type penalty_player penalty_yards
fg_result tackler_1 tackler_2 raw_text""".split()

_P2 = f"""WITH {_RUNS},
x AS (
  SELECT DISTINCT 'standings' AS table_name, s.season, s.ord, t.team_name AS k, 0 AS play_id,
    struct_pack(a := conference, {", ".join(f"{c} := CAST(TRY_CAST(trim({c}) AS DOUBLE) AS BIGINT)" for c in COUNTS)})::VARCHAR AS r FROM standings t JOIN st s USING (run_id)
  UNION ALL SELECT DISTINCT 'plays', s.season, s.ord, t.game_id, t.play_id, md5(struct_pack({", ".join(f"{c} := t.{c}" for c in PLAY_COLUMNS)})::VARCHAR) FROM plays t JOIN pl s USING (run_id)),
runs AS (SELECT 'standings' AS table_name, run_id, season, ord FROM st UNION ALL SELECT 'plays', run_id, season, ord FROM pl),
o AS (SELECT r.table_name, r.run_id, x.k, x.play_id, x.r FROM x JOIN runs r ON r.table_name = x.table_name AND r.season = x.season AND r.ord = x.ord + 1),
n AS (SELECT r.table_name, r.run_id, x.k, x.play_id, x.r FROM x JOIN runs r ON r.table_name = x.table_name AND r.season = x.season AND r.ord = x.ord AND r.ord > 1),
found AS (SELECT table_name, run_id, k AS record_key, play_id, CASE WHEN o.r IS NULL THEN 'added' WHEN n.r IS NULL THEN 'removed' ELSE 'changed' END AS change_kind
FROM n FULL JOIN o USING (table_name, run_id, k, play_id) WHERE o.r IS DISTINCT FROM n.r)"""

SQL = {
    "p1_found": f"{_P1} SELECT ref_name, run_id, ref_value, kind FROM found",
    "p1_report": f"{_P1} SELECT ref_name, season, kind, count(*) AS dangling, count(DISTINCT run_id) AS runs FROM found GROUP BY 1, 2, 3",
    "p2_found": f"{_P2} SELECT * FROM found",
    "p2_report": f"{_P2} SELECT table_name, run_id, change_kind, count(*) AS records FROM found GROUP BY 1, 2, 3",
}
QUERIES = {"p1_found": p1_found, "p1_report": p1_report, "p2_found": p2_found, "p2_report": p2_report}
