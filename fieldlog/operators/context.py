"""The play context: every current play with its pre-play score, situation, field position and outcome flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldlog.functions.expr import DEFENSE_POINTS, FIELD_ZONE, KICK_TD, MARGIN_BUCKET, OFFENSE_POINTS, PLAY_FLAGS, SIDE_POINTS
from fieldlog.operators.crosswalk import apply_crosswalk
from fieldlog.operators.current import plays_current, team_weeks
from fieldlog.session import small


def fumble_owner(plays: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Adds ``fumble_td``: a touchdown on a fumble that the defense recovered.

    The recovering team is the one whose code is the longest beginning of what was typed; a map from code to team per
    game keeps this a plain left join. Without such a code the play's own touchdown flag decides.
    """
    codes = crosswalk.groupBy(F.col("game_id").alias("__g")).agg(F.map_from_entries(F.collect_list(F.struct("prefix", "canonical_team"))).alias("__codes"))
    rows = plays.join(small(codes), F.col("game_id") == F.col("__g"), "left").drop("__g")
    fits = F.filter(F.map_keys("__codes"), lambda p: F.col("fumble_recovered_by").startswith(p))
    longest = F.array_max(F.transform(fits, lambda p: F.struct(F.length(p).alias("n"), p.alias("p"))))["p"]
    by_code = F.try_element_at("__codes", longest) == F.col("defense")
    touchdown = F.coalesce(F.col("is_fumble"), F.lit(False)) & F.coalesce(F.col("raw_text").ilike("%touchdown%"), F.lit(False))
    return rows.withColumn("fumble_td", F.when(touchdown, F.coalesce(by_code, ~F.coalesce("is_td", F.lit(False)))).otherwise(False)).drop("__codes")


def play_context(plays: DataFrame, runs: DataFrame, schedule: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """All columns of the current plays and the derived ones. Scores are those before the play."""
    rows = fumble_owner(plays_current(plays, runs), crosswalk)
    rows = rows.withColumns({"is_safety": F.coalesce("is_safety", F.lit(False)), "is_defensive_td": F.coalesce("is_defensive_td", F.lit(False)), "kick_td": F.expr(KICK_TD)})
    rows = rows.withColumns({"offense_points": F.expr(OFFENSE_POINTS), "defense_points": F.expr(DEFENSE_POINTS)})
    w = Window.partitionBy("season", "run_id", "game_id").orderBy("play_id").rowsBetween(Window.unboundedPreceding, -1)
    score = {f"{side}_score": F.coalesce(F.sum(F.expr(SIDE_POINTS.format(s=f"schedule_{side}"))).over(w), F.lit(0)).cast("bigint") for side in ("home", "away")}
    rows = rows.withColumns(score)
    rows = rows.withColumn("score_margin", F.expr("CASE WHEN offense = schedule_home THEN home_score - away_score WHEN offense = schedule_away THEN away_score - home_score END"))
    rows = rows.withColumns({k: F.expr(v) for k, v in PLAY_FLAGS.items()}).withColumn("score_margin_bucket", F.expr(MARGIN_BUCKET))
    rows = rows.withColumn("resolved_defensive_td", F.col("is_defensive_td") | F.col("fumble_td"))
    rows = apply_crosswalk(rows, crosswalk).withColumn("field_zone", F.expr(FIELD_ZONE))
    weeks = team_weeks(schedule, runs).select(F.col("season").alias("__s"), F.col("team_name").alias("__t"), F.col("game_id").alias("__g"), "week")
    joined = rows.join(small(weeks), (F.col("season") == F.col("__s")) & (F.col("offense") == F.col("__t")) & (F.col("game_id") == F.col("__g")), "left")
    return joined.drop("__s", "__t", "__g")
