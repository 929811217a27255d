"""The older rule set: report tables over rush and pass plays with their own success and explosive rules.

Each table is a dictionary of sums and ratios over a filter, so one builder makes all of them for either side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldlog.functions.expr import count_of, ranked, round_half_away

#: Flags of the older rules; unlike the newer ones they are never NULL.
FLAGS = {
    "passing_down": "coalesce(down = 2 AND distance >= 8, FALSE) OR coalesce(down IN (3, 4) AND distance >= 5, FALSE)",
    "early_down": "coalesce(down IN (1, 2) AND distance IS NOT NULL AND NOT (down = 2 AND distance >= 8), FALSE)",
    "success": "coalesce(distance IS NOT NULL AND CASE down WHEN 1 THEN yards_gained * 10 >= distance * 4 WHEN 2 THEN yards_gained * 10 >= distance * 6 WHEN 3 THEN yards_gained >= distance WHEN 4 THEN yards_gained >= distance END, FALSE)",
    "explosive": "coalesce((play_type = 'pass' AND yards_gained >= 20) OR (play_type = 'rush' AND yards_gained >= 10), FALSE)",
    "redzone": "coalesce(field_pos_side = 'opponent' AND yardline_100 <= 20, FALSE)",
    "run_stuff": "coalesce(play_type = 'rush' AND yards_gained <= 0, FALSE)",
    "sacked": "coalesce(is_sack, FALSE)",
    "rush": "play_type = 'rush'",
    "pass_try": "play_type = 'pass' AND NOT coalesce(is_sack, FALSE)",
    "td": "coalesce(is_td, FALSE)",
    "caught": "coalesce(completion, FALSE)",
    "fumbled": "coalesce(is_fumble, FALSE)",
}
N = "1"
#: name -> count condition; or (numerator condition or value, denominator condition or value, scale, digits).
Y = "coalesce(yards_gained, 0)"
TABLES: dict[str, tuple[str, dict]] = {
    "production": ("TRUE", {
        "pass_pct": ("play_type = 'pass'", "TRUE", 100, 1), "pass_yards": f"={count_of('pass_try AND caught').replace('THEN 1', f'THEN {Y}')}", "pass_ypa": (f"={count_of('pass_try AND caught').replace('THEN 1', f'THEN {Y}')}", "pass_try", 1, 2),
        "pass_td": "pass_try AND td", "comp_pct": ("pass_try AND caught", "pass_try", 100, 1), "pass_10plus": "pass_try AND caught AND yards_gained >= 10", "pass_20plus": "pass_try AND caught AND yards_gained >= 20", "pass_success_rt": ("pass_try AND success", "pass_try", 100, 1),
        "rush_pct": ("rush OR (play_type = 'pass' AND sacked)", "TRUE", 100, 1), "rush_yards": f"={count_of('rush OR sacked').replace('THEN 1', f'THEN {Y}')}", "rush_ypa": (f"={count_of('rush OR sacked').replace('THEN 1', f'THEN {Y}')}", "rush OR (play_type = 'pass' AND sacked)", 1, 2),
        "rush_td": "rush AND td", "rush_10plus": "rush AND yards_gained >= 10", "rush_20plus": "rush AND yards_gained >= 20", "rush_success_rt": ("rush AND success", "rush", 100, 1),
    }),
    "third_down": ("down = 3", {
        "attempts": "TRUE", "conversions": "success", "conv_pct": ("success", "TRUE", 100, 1), "avg_distance": ("=coalesce(distance, 0)", "distance IS NOT NULL", 1, 1), "pct_long": ("distance >= 7", "TRUE", 100, 1), "pct_short": ("distance < 3", "TRUE", 100, 1),
        "yards_per_play": (f"={Y}", "yards_gained IS NOT NULL", 1, 2), "explosives": "explosive", "rush_plays": "rush", "pass_plays": "pass_try", "rush_pct": ("rush", "TRUE", 100, 1), "pass_pct": ("pass_try", "TRUE", 100, 1),
        "rush_conv_pct": ("rush AND success", "rush", 100, 1), "pass_conv_pct": ("pass_try AND success", "pass_try", 100, 1), "sack_pct": ("play_type = 'pass' AND sacked", "play_type = 'pass'", 100, 1),
        "turnovers": "=(CASE WHEN pass_result = 'int' THEN 1 ELSE 0 END + CASE WHEN fumbled AND coalesce(fumble_recovered_by <> team, TRUE) THEN 1 ELSE 0 END)", "penalty_yards": "=coalesce(penalty_yards, 0)",
    }),
    "fourth_down": ("down = 4", {
        "attempts": "TRUE", "conv_pct": ("success", "TRUE", 100, 1), "rush_plays": "rush", "rush_pct": ("rush", "TRUE", 100, 1), "rush_conv_pct": ("rush AND success", "rush", 100, 1), "pass_plays": "pass_try", "pass_pct": ("pass_try", "TRUE", 100, 1),
        "pass_conv_pct": ("pass_try AND success", "pass_try", 100, 1), "explosives": "explosive", "yards_per_play": (f"={Y}", "yards_gained IS NOT NULL", 1, 2),
    }),
    "explosives": ("TRUE", {
        "total_exp": "explosive", "exp_rate": ("explosive", "TRUE", 100, 1), "exp_pass": "explosive AND play_type = 'pass'", "exp_pass_rate": ("explosive AND play_type = 'pass'", "pass_try", 100, 1), "exp_rush": "explosive AND rush", "exp_rush_rate": ("explosive AND rush", "rush", 100, 1),
        "exp_early_down": "explosive AND early_down", "exp_ed_rate": ("explosive AND early_down", "early_down", 100, 1), "exp_third": "explosive AND down = 3", "exp_third_rate": ("explosive AND down = 3", "down = 3", 100, 1),
    }),
}
_DOWNS = {
    "yards_per_play": (f"={Y}", "yards_gained IS NOT NULL", 1, 2), "success_rt": ("success", "TRUE", 100, 1), "explosive_pct": ("explosive", "TRUE", 100, 1), "rush_plays": "rush", "rush_pct": ("rush", "TRUE", 100, 1), "rush_ypa": (f"={count_of('rush').replace('THEN 1', f'THEN {Y}')}", "rush AND yards_gained IS NOT NULL", 1, 2),
    "run_stuff_pct": ("run_stuff", "rush", 100, 1), "explosive_runs": "rush AND explosive", "pass_plays": "pass_try", "pass_pct": ("pass_try", "TRUE", 100, 1), "pass_ypa": (f"={count_of('pass_try AND caught').replace('THEN 1', f'THEN {Y}')}", "pass_try", 1, 2), "comp_pct": ("pass_try AND caught", "pass_try", 100, 1),
    "sack_pct": ("play_type = 'pass' AND sacked", "play_type = 'pass'", 100, 1), "turnovers": "=(CASE WHEN play_type = 'pass' AND NOT sacked AND pass_result = 'int' THEN 1 ELSE 0 END + CASE WHEN fumbled THEN 1 ELSE 0 END)", "penalty_yards": "=coalesce(penalty_yards, 0)",
}
TABLES["early_down"], TABLES["passing_down"] = ("early_down", _DOWNS), ("passing_down", _DOWNS)

#: Metrics for which less is better on offense; on defense the order turns, but for those ranked high-first on both sides.
LOW = {"third_down": {"avg_distance", "pct_long", "sack_pct", "turnovers", "penalty_yards"}, "early_down": {"run_stuff_pct", "sack_pct", "turnovers", "penalty_yards"}, "passing_down": {"run_stuff_pct", "sack_pct", "turnovers", "penalty_yards"}}
BOTH_HIGH = {"production": {"pass_pct", "rush_pct"}, "third_down": {"pass_pct"}, "early_down": {"rush_pct", "pass_pct"}, "passing_down": {"rush_pct", "pass_pct"}}


def value_of(spec: str) -> str:
    return spec[1:] if spec.startswith("=") else count_of(spec)


def scrimmage(context: DataFrame) -> DataFrame:
    rows = context.where("play_type IN ('rush', 'pass')")
    return rows.drop("is_early_down").withColumns({k: F.expr(v) for k, v in FLAGS.items() if k not in ("passing_down", "early_down")} | {k: F.expr(FLAGS[k]) for k in ("passing_down", "early_down")})


def way(table: str, metric: str, side: str) -> str:
    low = metric in LOW.get(table, ())
    if side == "defense" and metric not in BOTH_HIGH.get(table, ()):
        low = not low
    return "asc" if low else "desc"


def team_table(rows: DataFrame, table: str, side: str) -> DataFrame:
    """One table for one side: metrics and their ranks per season and team. 0 where nothing can be divided by."""
    where, metrics = TABLES[table]
    rows = rows.where(f"{side} IS NOT NULL AND {side} <> ''").withColumn("team", F.col(side)).where(where)
    sums = {}
    for k, m in metrics.items():
        for i, part in enumerate([m] if isinstance(m, str) else m[:2]):
            sums[f"{k}_{i}"] = F.sum(F.expr(value_of(part))).cast("bigint")
    out = rows.groupBy("season", "team").agg(*(v.alias(k) for k, v in sums.items()))
    cols = {k: F.col(f"{k}_0") if isinstance(m, str) else F.coalesce(round_half_away(F.lit(float(m[2])) * F.col(f"{k}_0").cast("double") / F.nullif(F.col(f"{k}_1"), F.lit(0).cast("bigint")), m[3]), F.lit(0.0)) for k, m in metrics.items()}
    out = out.select("season", "team", *(v.alias(k) for k, v in cols.items()))
    return ranked(out, ["season"], {k: way(table, k, side) for k in metrics})


def drive_outcomes(context: DataFrame) -> DataFrame:
    """Drives by scrimmage plays of one offense, with touchdown, field goal, points 7 and 3, and three-and-outs.

    Drive 0 (plays before the first drive) is left out. A drive starts at its first known position.
    """
    valid = context.where("drive_id IS NOT NULL AND drive_id <> 0")
    w = Window.partitionBy("season", "run_id", "game_id", "drive_id")
    valid = valid.withColumn("drive_fg", F.max(F.expr("CASE WHEN play_type = 'field_goal' AND fg_result = 'good' THEN 1 ELSE 0 END")).over(w))
    start = F.min_by("yardline_100", F.when(F.col("yardline_100").isNotNull(), F.col("play_id")))
    rows = valid.where("play_type IN ('rush', 'pass')").groupBy("season", "run_id", "game_id", "drive_id", "offense", "defense").agg(F.count("play_id").alias("plays"), F.max(F.expr("CASE WHEN is_td THEN 1 ELSE 0 END")).alias("td"), F.max("drive_fg").alias("fg"), start.alias("start_yardline"))
    rows = rows.withColumn("score", F.greatest("td", "fg"))
    return rows.withColumns({"three_out": F.when((F.col("plays") <= 3) & (F.col("score") == 0), 1).otherwise(0), "points": F.col("td") * 7 + F.col("fg") * 3})


def finishing_drives(outcomes: DataFrame, side: str) -> DataFrame:
    pct = lambda c: round_half_away(F.lit(100.0) * F.sum(c).cast("double") / F.count("*"), 1)
    mean = lambda c, d: F.coalesce(round_half_away(F.sum(c).cast("double") / F.nullif(F.count(c), F.lit(0).cast("bigint")), d), F.lit(0.0))
    out = outcomes.where(f"{side} <> ''").groupBy("season", F.col(side).alias("team")).agg(F.count("*").alias("drives"), pct("score").alias("scoring_rate"), pct("td").alias("td_rate"), pct("fg").alias("fg_rate"), pct("three_out").alias("three_out_rate"), mean("start_yardline", 1).alias("avg_start_pos"), mean("plays", 2).alias("avg_plays"), mean("points", 2).alias("pts_per_drive"))
    low = {"three_out_rate", "avg_start_pos"}
    names = ["drives", "scoring_rate", "td_rate", "fg_rate", "three_out_rate", "avg_start_pos", "avg_plays", "pts_per_drive"]
    return ranked(out, ["season"], {m: "asc" if (m in low) == (side == "offense") else "desc" for m in names})


ZONES = {"backed_up": "start_yardline >= 75", "normal": "start_yardline BETWEEN 51 AND 74", "plus": "start_yardline BETWEEN 21 AND 50", "redzone": "start_yardline <= 20"}


def hidden_yards(outcomes: DataFrame, side: str) -> DataFrame:
    """Drives and points per drive by the zone in which they start."""
    aggs = []
    for z, c in ZONES.items():
        n, p = F.sum(F.expr(count_of(c))).cast("bigint"), F.sum(F.expr(f"CASE WHEN {c} THEN points ELSE 0 END")).cast("double")
        aggs += [n.alias(f"{z}_drives"), F.coalesce(round_half_away(p / F.nullif(n, F.lit(0).cast("bigint")), 2), F.lit(0.0)).alias(f"{z}_pts")]
    return outcomes.where(f"start_yardline IS NOT NULL AND {side} <> ''").groupBy("season", F.col(side).alias("team")).agg(*aggs)


def red_zone(context: DataFrame, side: str) -> DataFrame:
    """Drives that reach the red zone and how they end, with the plays run there."""
    flagged = context.withColumns({k: F.expr(v) for k, v in FLAGS.items() if k not in ("passing_down", "early_down")}).where(f"{side} <> ''").withColumn("team", F.col(side))
    flagged = flagged.withColumn("rz", F.expr("redzone AND play_type IN ('rush', 'pass')"))
    per_drive = flagged.groupBy("season", "team", "run_id", "game_id", "drive_id").agg(F.max(F.expr(count_of("rz"))).alias("rz"), F.max(F.expr(count_of("drive_id <> 0"))).alias("real"))
    # Outcomes count all plays of the drive, whoever has the ball in them.
    ends = context.where("drive_id IS NOT NULL").groupBy("season", "run_id", "game_id", "drive_id").agg(F.max(F.expr(count_of("is_td"))).alias("td"), F.max(F.expr(count_of("play_type = 'field_goal' AND fg_result = 'good'"))).alias("fg"))
    d = per_drive.join(ends, ["season", "run_id", "game_id", "drive_id"], "left").groupBy("season", "team").agg(F.sum("real").alias("total"), F.sum("rz").alias("rz_drives"), F.sum(F.expr("CASE WHEN rz = 1 THEN td ELSE 0 END")).alias("n_td"), F.sum(F.expr("CASE WHEN rz = 1 THEN fg ELSE 0 END")).alias("n_fg"), F.sum(F.expr("CASE WHEN rz = 1 THEN greatest(td, fg) ELSE 0 END")).alias("n_score"))
    c = lambda x: F.sum(F.expr(count_of(x))).cast("bigint")
    p = flagged.where("rz").groupBy("season", "team").agg(c("TRUE").alias("n"), c("rush").alias("n_rush"), c("pass_try").alias("n_pass"), F.sum(F.expr(f"CASE WHEN rush THEN {Y} ELSE 0 END")).cast("bigint").alias("rush_yds"), c("rush AND yards_gained IS NOT NULL").alias("rush_known"), c("run_stuff").alias("stuffs"), c("rush AND td").alias("rush_td"), c("pass_try AND caught").alias("comps"), c("pass_try AND td").alias("pass_td"), c("pass_try AND pass_result = 'int'").alias("ints"))
    r = lambda a, b, s=100.0, k=1: F.coalesce(round_half_away(F.lit(s) * F.col(a).cast("double") / F.nullif(F.col(b), F.lit(0).cast("bigint")), k), F.lit(0.0))
    out = p.join(d, ["season", "team"]).withColumn("n_stop", F.col("rz_drives") - F.col("n_score"))
    return out.select("season", "team", F.col("rz_drives").cast("bigint").alias("rz_drives"), r("rz_drives", "total").alias("rz_drive_pct"), r("n_td", "rz_drives").alias("td_pct"), r("n_fg", "rz_drives").alias("fg_pct"), r("n_score", "rz_drives").alias("score_pct"), r("n_stop", "rz_drives").alias("stop_pct"), r("n_rush", "n").alias("rush_pct"), r("rush_yds", "rush_known", 1.0, 2).alias("rush_ypa"), r("stuffs", "n_rush").alias("run_stuff_pct"), "rush_td", r("n_pass", "n").alias("pass_pct"), r("comps", "n_pass").alias("comp_pct"), "pass_td", F.col("ints").alias("interceptions"))


def game_charts(rows: DataFrame) -> DataFrame:
    """Per team and game, the series behind the charts: offense and defense rates; NULL where there is nothing to divide."""
    roles = F.array(F.struct(F.col("offense").alias("team"), F.lit("offense").alias("side")), F.struct(F.col("defense").alias("team"), F.lit("defense").alias("side")))
    rows = rows.withColumn("r", F.explode(roles)).where("r.team <> ''")
    part = lambda a, b: round_half_away(F.lit(100.0) * F.sum(F.expr(count_of(a))).cast("double") / F.nullif(F.sum(F.expr(count_of(b))), F.lit(0).cast("bigint")), 1)
    return rows.groupBy("season", "game_id", F.col("r.team").alias("team"), F.col("r.side").alias("side")).agg(
        part("success", "TRUE").alias("success_rate"), part("explosive", "TRUE").alias("explosive_rate"), part("run_stuff", "rush").alias("stuff_rate"), part("down = 3 AND success", "down = 3").alias("third_down_rate"),
        part("early_down AND rush", "early_down").alias("early_rush_rate"), part("passing_down AND play_type = 'pass'", "passing_down").alias("passing_down_pass_rate"), part("quarter <= 2 AND success", "quarter <= 2").alias("first_half_success"),
        part("quarter >= 3 AND success", "quarter >= 3").alias("second_half_success"), F.sum(F.expr("coalesce(penalty_yards, 0)")).cast("bigint").alias("penalty_yards"),
    )


def conversion_by_distance(rows: DataFrame) -> DataFrame:
    """Third and fourth down conversions by distance to go."""
    band = F.expr("CASE WHEN distance = 1 THEN '1' WHEN distance BETWEEN 2 AND 3 THEN '2-3' WHEN distance BETWEEN 4 AND 6 THEN '4-6' WHEN distance BETWEEN 7 AND 10 THEN '7-10' WHEN distance BETWEEN 11 AND 99 THEN '11+' END")
    out = rows.where("down IN (3, 4) AND offense <> ''").withColumn("band", band).where("band IS NOT NULL").groupBy("season", F.col("offense").alias("team"), "band").agg(F.count("*").alias("attempts"), F.sum(F.expr(count_of("success"))).cast("bigint").alias("conversions"))
    return out.withColumn("rate", round_half_away(F.lit(100.0) * F.col("conversions").cast("double") / F.col("attempts"), 1))


def season_check(context: DataFrame) -> DataFrame:
    """Totals per team and game with a total row (game_id NULL) per team."""
    rows = context.where("offense <> ''").withColumn("team", F.col("offense"))
    out = rows.rollup("season", "team", "game_id").agg(F.sum(F.expr(count_of("is_pass_attempt"))).cast("bigint").alias("pass_att"), F.sum(F.expr(count_of("completion"))).cast("bigint").alias("pass_comp"), F.sum(F.expr(count_of("is_rush_attempt"))).cast("bigint").alias("rush_att"), F.sum(F.expr(count_of("is_td"))).cast("bigint").alias("td"), F.grouping_id().cast("int").alias("level"))
    return out.where("level IN (0, 1)").drop("level")


def box_summary(context: DataFrame) -> DataFrame:
    """Box score lines of both teams of a game; plays wiped out by a penalty on the offense don't count."""
    rows = context.where("offense <> ''").withColumn("void", F.expr("coalesce(is_penalty AND penalty_team IS NOT NULL AND prefix_owner = offense AND penalty_team = field_pos_prefix, FALSE)")).where("NOT void")
    s = lambda v: F.sum(F.expr(v)).cast("bigint")
    return rows.groupBy("season", "game_id", F.col("offense").alias("team")).agg(s(count_of("is_rush_attempt")).alias("rush_att"), s(f"CASE WHEN is_rush_attempt THEN {Y} ELSE 0 END").alias("rush_yds"), s(count_of("is_pass_attempt")).alias("pass_att"), s(count_of("completion")).alias("pass_comp"), s(f"CASE WHEN completion THEN {Y} ELSE 0 END").alias("pass_yds"), s(count_of("is_interception")).alias("ints"), s(count_of("is_fumble")).alias("fumbles"), s("coalesce(penalty_yards, 0)").alias("penalty_yards"))


def ordinal(n: str) -> F.Column:
    c = F.col(n)
    tail = F.when((c % 100).between(11, 13), "th").when(c % 10 == 1, "st").when(c % 10 == 2, "nd").when(c % 10 == 3, "rd").otherwise("th")
    return F.concat(c.cast("string"), tail)


def report_rows(table: DataFrame, metrics: list[str]) -> DataFrame:
    """'value (nth)' strings of a table, one row per team and metric."""
    stack = ", ".join(f"'{m}', cast({m} AS double), {m}_rank" for m in metrics)
    long = table.selectExpr("season", "team", f"stack({len(metrics)}, {stack}) AS (metric, value, place)")
    return long.select("season", "team", "metric", F.concat(F.format_string("%.1f", "value"), F.lit(" ("), ordinal("place"), F.lit(")")).alias("text"))
