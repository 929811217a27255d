"""What the report pages and checks show beyond the loaders: trimmed situations, identity lines, display ranks, health."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlog.functions.expr import PASS_YARDS, RUSH_YARDS, count_of, direction, round_half_away
from fieldlog.operators.rollups import metric_name

#: Situation and metric of each line of the trimmed table (fixed values).
TRIMMED = [("early_down", "success_rate"), ("early_down", "rush_pct"), ("early_down", "explosive_rate"), ("third_down", "success_rate"), ("third_down", "avg_distance"), ("third_down", "explosive_rate")]
#: Metrics of the identity page (fixed values).
RUSHING = ["rush_yds", "rush_ypa", "rush_success_rate", "rush_explosive_rate", "run_stuff_rate"]
PASSING = ["pass_yds", "comp_pct", "pass_success_rate", "pass_explosive_rate", "sack_rate"]


def lines(table: DataFrame, metrics: list[str], side: str, by: list[str]) -> DataFrame:
    """One row per metric of a ranked table: ``by``, metric, value, place (NULL where the table doesn't rank it)."""
    names = [(m, metric_name(m, side)) for m in metrics]
    place = lambda n: f"{n}_rank" if f"{n}_rank" in table.columns else "CAST(NULL AS BIGINT)"
    stack = ", ".join(f"'{m}', CAST({n} AS DOUBLE), {place(n)}" for m, n in names)
    return table.selectExpr(*by, f"stack({len(names)}, {stack}) AS (metric, value, place)")


def situation_trimmed(offense: DataFrame, defense: DataFrame, met: DataFrame) -> DataFrame:
    """The six trimmed lines of every meeting: season, team_name, opponent, situation, metric, both values and places.

    ``offense``, ``defense``: ranked situation tables; ``met``: season, team_name, opponent, of which every pair comes out in
    both directions. A side without plays of a situation keeps its lines with NULLs.
    """
    metrics = list(dict.fromkeys(m for _, m in TRIMMED))
    wanted = F.struct("situation", "metric").isin([F.struct(F.lit(s), F.lit(m)) for s, m in TRIMMED])
    o = lines(offense, metrics, "offense", ["season", "team_name", "situation"]).withColumnsRenamed({"value": "off_value", "place": "off_rank"})
    d = lines(defense, metrics, "defense", ["season", "team_name", "situation"]).withColumnsRenamed({"value": "def_value", "place": "def_rank", "team_name": "opponent"})
    both = met.select("season", "team_name", "opponent").unionByName(met.select("season", F.col("opponent").alias("team_name"), F.col("team_name").alias("opponent"))).distinct()
    grid = both.withColumn("at", F.explode(F.array(*(F.struct(F.lit(s).alias("situation"), F.lit(m).alias("metric")) for s, m in TRIMMED)))).select("season", "team_name", "opponent", "at.*")
    return grid.join(o.where(wanted), ["season", "team_name", "situation", "metric"], "left").join(d.where(wanted), ["season", "opponent", "situation", "metric"], "left")


def success_by_down_sides(context: DataFrame) -> DataFrame:
    """Attempts, successes and success rate by down of every team with the ball and against it."""
    sides = F.array(F.struct(F.col("offense").alias("team_name"), F.lit("offense").alias("side")), F.struct(F.col("defense").alias("team_name"), F.lit("defense").alias("side")))
    rows = context.where("down BETWEEN 1 AND 4").select("season", F.col("down").cast("bigint").alias("down"), "is_pass_attempt", "is_rush_attempt", "is_success", F.explode(sides).alias("s")).where("s.team_name <> ''")
    out = rows.groupBy("season", F.col("s.team_name").alias("team_name"), F.col("s.side").alias("side"), "down").agg(F.count_if(F.expr("is_pass_attempt OR is_rush_attempt")).alias("att"), F.count_if("is_success").alias("successes"))
    return out.withColumn("success_rate", round_half_away(F.lit(100.0) * F.col("successes") / F.nullif("att", F.lit(0)), 1))


def identity_lines(offense: DataFrame, defense: DataFrame) -> DataFrame:
    """Rushing and passing lines of the identity page for both sides: season, team_name, side, family, metric, value, place."""
    parts = [lines(t, m, side, ["season", "team_name"]).select("season", "team_name", F.lit(side).alias("side"), F.lit(f).alias("family"), "metric", "value", "place") for t, side in ((offense, "offense"), (defense, "defense")) for f, m in (("rushing", RUSHING), ("passing", PASSING))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def identity_averages(offense: DataFrame, defense: DataFrame) -> DataFrame:
    """Yards per attempt of every team beside the average of its season, for both sides."""
    w = Window.partitionBy("season")
    out = []
    for t, side in ((offense, "offense"), (defense, "defense")):
        r, p = metric_name("rush_ypa", side), metric_name("pass_ypa", side)
        out.append(t.select("season", "team_name", F.lit(side).alias("side"), F.col(r).alias("rush_ypa"), F.col(p).alias("pass_ypa"), round_half_away(F.avg(r).over(w), 2).alias("season_rush_ypa"), round_half_away(F.avg(p).over(w), 2).alias("season_pass_ypa")))
    return out[0].unionByName(out[1])


def game_offense_all_runs(plays: DataFrame) -> DataFrame:
    """Offense sums per run, game and team over every run; a touchdown counts for the offense whoever scored it."""
    s = lambda v: F.sum(F.expr(v)).cast("bigint")
    sums = {"pass_att": count_of("is_pass_attempt"), "pass_comp": count_of("completion"), "pass_yds": PASS_YARDS, "pass_int": count_of("is_interception"), "pass_td": count_of("play_type = 'pass' AND is_td"), "rush_att": count_of("is_rush_attempt"), "rush_yds": RUSH_YARDS, "rush_td": count_of("is_rush_attempt AND is_td"), "sacks": count_of("is_sack"), "dropbacks": count_of("is_dropback"), "play_count": "1"}
    rows = plays.where("offense IS NOT NULL AND offense <> ''").distinct()
    return rows.groupBy("season", "run_id", "game_id", F.col("offense").alias("team_name")).agg(F.max("schedule_home").alias("schedule_home"), F.max("schedule_away").alias("schedule_away"), *(s(v).alias(k) for k, v in sums.items()))


def sorted_with_places(table: DataFrame, metric: str, side: str, descending: bool, by: list[str]) -> DataFrame:
    """The display of a table sorted by a column: row (in the order shown) and place (1 the best by that metric).

    Where the order shown runs from worst to best the places count down. Ties go by ``by``'s last column, NULLs last.
    """
    key = F.col(metric).desc_nulls_last() if descending else F.col(metric).asc_nulls_last()
    w = Window.partitionBy(*by[:-1])
    rows = table.select(*by, metric).withColumn("row", F.row_number().over(w.orderBy(key, by[-1])).cast("bigint"))
    best_first = (direction(metric.removeprefix("opp_"), side) == "desc") == descending
    return rows.withColumn("place", F.col("row") if best_first else F.count("*").over(w) - F.col("row") + 1)


def balance(context: DataFrame) -> DataFrame:
    """Plays of each team with the ball against plays that name it as the other side's offense's opponent, per game.

    as_offense: plays whose offense is the team; faced: plays whose defense is its opponent in that game. Where the text
    gives both sides of every play they agree.
    """
    pairs = context.where("offense <> ''").groupBy("season", "game_id", F.col("offense").alias("team")).agg(F.count("*").alias("as_offense"), F.max(F.nullif("defense", F.lit(""))).alias("opponent"))
    faced = context.where("defense <> ''").groupBy("season", "game_id", F.col("defense").alias("opponent")).agg(F.count("*").alias("faced"))
    out = pairs.join(faced, ["season", "game_id", "opponent"], "left").withColumn("faced", F.coalesce("faced", F.lit(0)).cast("bigint"))
    return out.select("season", "game_id", "team", "opponent", "as_offense", "faced", (F.col("as_offense") == F.col("faced")).alias("balanced"))


def coverage_health(coverage: DataFrame, allowed: int = 1) -> DataFrame:
    """Teams by how many scheduled games lack plays: complete, allowed (at most ``allowed``) or short."""
    missing = F.col("missing_pbp_games")
    return coverage.select("season", "team_name", "missing_pbp_games", F.when(missing <= 0, "complete").when(missing <= allowed, "allowed").otherwise("short").alias("health"))


def correlations(rows: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """Pearson correlations of every two columns, each once, ranked by strength; one aggregation over the rows."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    one = rows.agg(*(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in pairs))
    long = one.selectExpr(f"stack({len(pairs)}, " + ", ".join(f"'{a}', '{b}', round(`{a}|{b}`, {digits})" for a, b in pairs) + ") AS (one, other, r)")
    return long.withColumn("place", F.rank().over(Window.orderBy(F.abs("r").desc_nulls_last())).cast("bigint"))


def leaders(table: DataFrame, metric: str, most: int, by: Column | str = "season") -> DataFrame:
    """The first teams of each season by a metric; ties go by team."""
    w = Window.partitionBy(by).orderBy(F.col(metric).desc_nulls_last(), "team_name")
    return table.withColumn("place", F.row_number().over(w).cast("bigint")).where(F.col("place") <= most)
