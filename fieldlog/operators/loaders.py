"""What reports and the dashboard load, for all teams at once; a caller filters by season and team."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlog.functions.expr import BASE_SUMS, RATES, mean_of_rounded, rate
from fieldlog.operators.rollups import metric_name, team_game, team_season, with_rates, with_rating

FILTERS = ("season", "week", "opponent", "home_away", "quarter", "down", "distance_bucket", "score_margin_bucket", "field_zone", "team")


def predicate(column: str, value: object) -> Column | None:
    """None: no restriction; a list: one of them; else equal."""
    if value is None:
        return None
    return F.col(column).isin(list(value)) if isinstance(value, (list, tuple, set)) else F.col(column) == F.lit(value)


FAMILIES = {
    "passing": ["pass_att", "pass_comp", "pass_yds", "pass_int", "pass_td", "dropbacks", "sacks", "pass_successes", "pass_comp_10_plus", "pass_comp_20_plus", "pass_explosive", "rush_att"],
    "rushing": ["rush_att", "rush_yds", "rush_td", "rush_successes", "rush_10_plus", "rush_20_plus", "stuffed_runs", "rush_explosive", "pass_att"],
}
FAMILY_RATES = {"passing": ["pass_pct", "pass_ypa", "comp_pct", "pass_success_rate", "pass_explosive_rate", "sack_rate"], "rushing": ["rush_pct", "rush_ypa", "rush_success_rate", "rush_explosive_rate", "run_stuff_rate"]}


def team_stats(context: DataFrame, side: str, grain: str, family: str, **filters: object) -> DataFrame:
    """Sums and rates of one family; filters apply to plays before anything is summed."""
    if side not in ("offense", "defense") or grain not in ("season", "game") or family not in FAMILIES:
        raise ValueError(f"unknown side, grain or family: {side}, {grain}, {family}")
    unknown = set(filters) - set(FILTERS)
    if unknown:
        raise ValueError(f"unknown filters: {sorted(unknown)}")
    if side == "defense":
        context = context.withColumns({"opponent": F.col("offense"), "home_away": F.expr("CASE WHEN defense = schedule_home THEN 'home' WHEN defense = schedule_away THEN 'away' END")})
    kept = [p for k, v in filters.items() if (p := predicate(side if k == "team" else k, v)) is not None]
    rows = team_game(reduce(lambda df, p: df.where(p), kept, context), side)
    if grain == "season":
        rows = team_season(rows, side)
    rows = with_rates(rows, side, {k: RATES[k] for k in FAMILY_RATES[family]})
    if family == "passing":
        rows = with_rating(rows, side)
    by = ["season", "team_name"] + (["game_id", "opponent", "home_away"] if grain == "game" else ["games"])
    names = [metric_name(k, side) for k in FAMILIES[family] + FAMILY_RATES[family]] + ([metric_name("passer_rating", side)] if family == "passing" else [])
    return rows.select(*by, *names)


def distinct_values(context: DataFrame, what: str) -> DataFrame:
    """Seasons, weeks or teams that occur."""
    if what == "teams":
        return context.select(F.explode(F.array("offense", "defense")).alias("team_name")).where("team_name IS NOT NULL AND team_name <> ''").distinct()
    return context.select({"seasons": "season", "weeks": "week"}[what]).dropna().distinct()


def schedule_recap(standings: DataFrame, schedule: DataFrame) -> DataFrame:
    """Each team's games in order beside its standing."""
    s = standings.select("season", "team_name", "conference", "wins", "losses", "ties")
    return schedule.select("season", "team_name", "game_date", "game_id", "opponent", "home_away", "result", "wins_entering_game", "losses_entering_game").join(s, ["season", "team_name"], "left")


def matchup(offense: DataFrame, defense: DataFrame, pairs: list[tuple[str, str]], by: list[str]) -> DataFrame:
    """Every pair of offense and defense that met: value and rank of each metric for both, one row per metric.

    ``by``: season, offense team, defense team of the meetings to show.
    """

    def long(df: DataFrame, columns: list[str], team: str, to: str) -> DataFrame:
        stack = ", ".join(f"'{pairs[i][0]}', cast({c} AS double), {c}_rank" for i, c in enumerate(columns))
        return df.selectExpr("season", f"team_name AS {team}", f"stack({len(columns)}, {stack}) AS (metric, {to}_value, {to}_rank)")

    o = long(offense, [a for a, _ in pairs], "team_name", "off")
    d = long(defense, [b for _, b in pairs], "opponent", "def")
    return by.join(o, ["season", "team_name"]).join(d, ["season", "opponent", "metric"])


def success_by_down(context: DataFrame) -> DataFrame:
    rows = context.where("down BETWEEN 1 AND 4 AND offense <> ''")
    out = rows.groupBy("season", F.col("offense").alias("team_name"), F.col("down").cast("bigint").alias("down")).agg(F.count_if(F.expr("is_pass_attempt OR is_rush_attempt")).alias("att"), F.count_if("is_success").alias("successes"))
    return out.withColumn("success_rate", rate("successes", "att"))


def weekly_trends(context: DataFrame) -> DataFrame:
    """Per team and game: own success and explosive rates on offense and those allowed on defense."""
    roles = F.array(F.struct(F.col("offense").alias("team_name"), F.lit(1).alias("o")), F.struct(F.col("defense").alias("team_name"), F.lit(0).alias("o")))
    rows = context.where("is_pass_attempt OR is_rush_attempt").select("season", "game_id", "is_success", "is_explosive", F.explode(roles).alias("r")).where("r.team_name <> ''")
    s = lambda o, c: F.count_if((F.col("r.o") == o) & c)
    yes = F.lit(True)
    out = rows.groupBy("season", "game_id", F.col("r.team_name").alias("team_name")).agg(
        s(1, yes).alias("off_plays"), s(1, F.col("is_success")).alias("off_successes"), s(1, F.col("is_explosive")).alias("off_explosive"), s(0, yes).alias("def_plays"), s(0, F.col("is_success")).alias("def_successes"), s(0, F.col("is_explosive")).alias("def_explosive")
    )
    return out.withColumns({"off_success_rate": rate("off_successes", "off_plays"), "def_success_rate": rate("def_successes", "def_plays"), "off_explosive_rate": rate("off_explosive", "off_plays"), "def_explosive_rate": rate("def_explosive", "def_plays")})


def league_weekly(context: DataFrame) -> DataFrame:
    """Success rate per week over all teams of a season."""
    rows = context.where("week IS NOT NULL").groupBy("season", F.col("week").cast("bigint").alias("week")).agg(F.count_if(F.expr("is_pass_attempt OR is_rush_attempt")).alias("att"), F.count_if("is_success").alias("successes"))
    return rows.withColumn("success_rate", rate("successes", "att"))


def quick_hitters(offense: DataFrame, defense: DataFrame, points: DataFrame) -> DataFrame:
    """The six headline numbers of a team with their ranks."""
    o = offense.select("season", "team_name", "success_rate", "success_rate_rank", "explosive_rate", "explosive_rate_rank")
    d = defense.select("season", "team_name", "opp_success_rate", "opp_success_rate_rank", "opp_explosive_rate", "opp_explosive_rate_rank")
    p = points.select("season", "team_name", "ppg", "ppg_rank", "ppg_allowed", "ppg_allowed_rank")
    return o.join(d, ["season", "team_name"], "full_outer").join(p, ["season", "team_name"], "full_outer")


def identity(offense: DataFrame, drives: DataFrame, situations: DataFrame) -> DataFrame:
    """How a team plays: run and pass shares, yards per attempt beside the season's average, early-down runs, drives and tempo."""
    early = situations.where("situation = 'early_down'").select("season", "team_name", F.col("rush_pct").alias("early_rush_pct"))
    w = Window.partitionBy("season")
    o = offense.select("season", "team_name", "rush_pct", "pass_pct", "rush_ypa", "pass_ypa", "success_rate").withColumns({f"avg_{m}": mean_of_rounded(m, RATES[m][3], 4, w) for m in ("rush_ypa", "pass_ypa")})
    return o.join(drives.select("season", "team_name", "avg_start_yardline_100", "pct_drives_scored", "plays_per_game", "avg_plays_per_drive"), ["season", "team_name"], "left").join(early, ["season", "team_name"], "left")


def team_leaders(players: DataFrame, value: str, most: int) -> DataFrame:
    """The first ``most`` players of each team by a column; NULLs don't count, ties go by name."""
    w = Window.partitionBy("season", "team_name").orderBy(F.col(value).desc(), "player")
    return players.where(F.col(value).isNotNull()).withColumn("place", F.row_number().over(w).cast("bigint")).where(F.col("place") <= most)


def player_totals(context: DataFrame) -> DataFrame:
    """Yards and tackles by raw player name: season, team_name, player, category, total."""
    part = lambda who, side, cat, value, cond: context.where(f"{who} IS NOT NULL AND {who} <> '' AND {side} <> '' AND ({cond})").select("season", F.col(side).alias("team_name"), F.col(who).alias("player"), F.lit(cat).alias("category"), F.expr(value).alias("v"))
    rows = [
        part("passer", "offense", "passing_yards", BASE_SUMS["pass_yds"], "is_pass_attempt"),
        part("rusher", "offense", "rushing_yards", "coalesce(yards_gained, 0)", "is_rush_attempt AND NOT coalesce(is_sack, FALSE)"),
        part("receiver", "offense", "receiving_yards", "coalesce(yards_gained, 0)", "completion"),
        part("tackler_1", "defense", "tackles", "1", "TRUE"),
        part("tackler_2", "defense", "tackles", "1", "TRUE"),
        part("tackler_1", "defense", "sacks", "1", "is_sack"),
    ]
    return reduce(lambda a, b: a.unionByName(b), rows).groupBy("season", "team_name", "player", "category").agg(F.sum("v").cast("bigint").alias("total"))
