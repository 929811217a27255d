"""Column helpers shared by all reports: rates, rounding, ranks, and portable SQL text of the play flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def round_half_away(x: Column, digits: int) -> Column:
    """Half away from zero on doubles, as the checking SQL engine rounds."""
    scale = F.lit(float(10**digits))
    return F.signum(x) * F.floor(F.abs(x) * scale + 0.5) / scale


def rate(a: Column | str, b: Column | str, scale: float = 100.0, digits: int | None = 1) -> Column:
    """scale * a / b as a double, NULL where b is 0 or NULL."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    x = F.lit(scale) * a.cast("double") / F.nullif(b, F.lit(0).cast("bigint"))
    return x if digits is None else round_half_away(x, digits)


def mean_of_rounded(x: Column | str, held: int, digits: int, over: WindowSpec) -> Column:
    """Rounded mean over a window of doubles that hold ``held`` digits, from a sum of whole units.

    A sum of doubles depends on the order of the rows, so that a mean halfway between two results is rounded to either.
    """
    x = F.col(x) if isinstance(x, str) else x
    units = F.sum(F.round(x * float(10**held)).cast("bigint")).over(over)
    return round_half_away(units / F.lit(float(10**held)) / F.nullif(F.count(x).over(over), F.lit(0).cast("bigint")), digits)


def passer_rating(yards: str, td: str, comp: str, ints: str, att: str) -> Column:
    """(8.4 yards + 330 td + 100 comp - 200 int) / att with an exact numerator, one digit."""
    top = (F.col(yards) * 84 + F.col(td) * 3300 + F.col(comp) * 1000 - F.col(ints) * 2000) / F.lit(10.0)
    return round_half_away(top / F.nullif(F.col(att), F.lit(0).cast("bigint")), 1)


def ranked(df: DataFrame, by: list[str], metrics: dict[str, str]) -> DataFrame:
    """A ``<metric>_rank`` column for each metric ('desc' or 'asc'), NULLs last, ties sharing a rank."""
    for m, way in metrics.items():
        order = F.col(m).desc_nulls_last() if way == "desc" else F.col(m).asc_nulls_last()
        df = df.withColumn(f"{m}_rank", F.rank().over(Window.partitionBy(*by).orderBy(order)).cast("bigint"))
    return df


#: Flags of a play before the snap and of its outcome, as SQL text that both engines read alike.
PLAY_FLAGS = {
    "distance_bucket": "CASE WHEN distance BETWEEN 1 AND 3 THEN 'short' WHEN distance BETWEEN 4 AND 6 THEN 'medium' WHEN distance >= 7 THEN 'long' END",
    "is_passing_down": "CASE WHEN down IS NULL OR distance IS NULL THEN NULL ELSE (down = 2 AND distance >= 8) OR (down IN (3, 4) AND distance >= 5) END",
    "is_early_down": "CASE WHEN down IS NULL OR distance IS NULL THEN NULL ELSE down = 1 OR (down = 2 AND distance < 8) END",
    "opponent": "CASE WHEN offense = schedule_home THEN schedule_away WHEN offense = schedule_away THEN schedule_home END",
    "home_away": "CASE WHEN offense = schedule_home THEN 'home' WHEN offense = schedule_away THEN 'away' END",
    "is_success": "CASE WHEN is_pass_attempt OR is_rush_attempt THEN coalesce(distance > 0 AND CASE down WHEN 1 THEN yards_gained * 2 >= distance WHEN 2 THEN yards_gained * 10 >= distance * 7 WHEN 3 THEN yards_gained >= distance WHEN 4 THEN yards_gained >= distance END, FALSE) END",
    "explosive_rush": "coalesce(is_rush_attempt AND coalesce(yards_gained, 0) >= 10, FALSE)",
    "explosive_pass": "coalesce(completion AND coalesce(yards_gained, 0) >= 20, FALSE)",
    "is_explosive": "coalesce(is_rush_attempt AND coalesce(yards_gained, 0) >= 10, FALSE) OR coalesce(completion AND coalesce(yards_gained, 0) >= 20, FALSE)",
    "is_stuffed": "coalesce(is_rush_attempt AND coalesce(yards_gained, 0) <= 0, FALSE)",
}
FIELD_ZONE = "CASE WHEN yardline_100 IS NULL THEN NULL WHEN yardline_100 <= 20 THEN 'red_zone' WHEN yardline_100 <= 49 THEN 'opponent_territory' WHEN yardline_100 <= 60 THEN 'midfield' WHEN yardline_100 <= 79 THEN 'own_territory' ELSE 'backed_up' END"
MARGIN_BUCKET = "CASE WHEN score_margin IS NULL THEN NULL WHEN score_margin >= 17 THEN 'blowout_lead' WHEN score_margin >= 9 THEN 'two_score_lead' WHEN score_margin >= 1 THEN 'one_score_lead' WHEN score_margin = 0 THEN 'tied' WHEN score_margin >= -8 THEN 'one_score_deficit' WHEN score_margin >= -16 THEN 'two_score_deficit' ELSE 'blowout_deficit' END"
#: Points of a play. ``fumble_td``: a fumble taken to the end zone by the defense; ``kick_td``: a kickoff returned for a touchdown.
KICK_TD = "coalesce(play_type = 'kickoff' AND coalesce(is_td, FALSE) AND NOT coalesce(is_conversion, FALSE) AND NOT coalesce(is_fumble, FALSE), FALSE)"
OFFENSE_POINTS = "CASE WHEN fumble_td OR kick_td THEN 0 WHEN is_td AND NOT coalesce(is_conversion, FALSE) THEN 6 WHEN fg_result = 'good' THEN CASE play_type WHEN 'field_goal' THEN 3 WHEN 'pat' THEN 1 WHEN 'two_point' THEN 2 ELSE 0 END ELSE 0 END"
DEFENSE_POINTS = "CASE WHEN fumble_td OR kick_td OR is_defensive_td THEN 6 WHEN is_safety THEN 2 ELSE 0 END"
SIDE_POINTS = "CASE WHEN offense = {s} THEN offense_points WHEN defense = {s} THEN defense_points ELSE 0 END"

#: Sums over the plays of a team: name -> condition (counted) or value.
NO_TD = "NOT coalesce(resolved_defensive_td, FALSE)"
PASS_YARDS = "CASE WHEN play_type = 'pass' AND NOT coalesce(is_sack, FALSE) AND NOT coalesce(is_interception, FALSE) THEN coalesce(yards_gained, 0) ELSE 0 END"
RUSH_YARDS = "CASE WHEN is_rush_attempt THEN coalesce(yards_gained, 0) ELSE 0 END"


def count_of(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


BASE_SUMS = {
    "pass_att": count_of("is_pass_attempt"),
    "pass_comp": count_of("completion"),
    "pass_yds": PASS_YARDS,
    "pass_int": count_of("is_interception"),
    "pass_td": count_of(f"play_type = 'pass' AND is_td AND {NO_TD}"),
    "dropbacks": count_of("is_dropback"),
    "sacks": count_of("is_sack"),
    "pass_successes": count_of("is_pass_attempt AND is_success"),
    "pass_comp_10_plus": count_of("completion AND yards_gained >= 10"),
    "pass_comp_20_plus": count_of("completion AND yards_gained >= 20"),
    "rush_att": count_of("is_rush_attempt"),
    "rush_yds": RUSH_YARDS,
    "rush_td": count_of(f"is_rush_attempt AND is_td AND {NO_TD}"),
    "rush_successes": count_of("is_rush_attempt AND is_success"),
    "rush_10_plus": count_of("is_rush_attempt AND yards_gained >= 10"),
    "rush_20_plus": count_of("is_rush_attempt AND yards_gained >= 20"),
    "stuffed_runs": count_of("is_stuffed"),
    "rush_explosive": count_of("explosive_rush"),
    "pass_explosive": count_of("explosive_pass"),
    "play_count": "1",
}
SITUATION_SUMS = {
    "pass_att": BASE_SUMS["pass_att"], "pass_comp": BASE_SUMS["pass_comp"], "pass_yds": PASS_YARDS, "pass_td": count_of("play_type = 'pass' AND is_td"),
    "rush_att": BASE_SUMS["rush_att"], "rush_yds": RUSH_YARDS, "rush_td": count_of("is_rush_attempt AND is_td"), "successes": count_of("(is_pass_attempt OR is_rush_attempt) AND is_success"),
    "explosive_plays": count_of("is_explosive"), "stuffed_runs": count_of("is_stuffed"), "sacks": count_of("is_sack"),
    "distance_sum": "coalesce(distance, 0)", "distance_n": count_of("distance IS NOT NULL"), "play_count": "1",
}
#: Overlapping lenses on plays.
SITUATIONS = {"early_down": "is_early_down", "passing_down": "is_passing_down", "third_down": "down = 3", "fourth_down": "down = 4"}

#: Rates: name -> (numerator, denominator, scale, digits); and the direction in which a greater value is better on offense.
RATES = {
    "pass_pct": ("dropbacks", "pass_att + rush_att", 100, 1),
    "rush_pct": ("rush_att", "pass_att + rush_att", 100, 1),
    "pass_ypa": ("pass_yds", "pass_att", 1, 2),
    "rush_ypa": ("rush_yds", "rush_att", 1, 2),
    "comp_pct": ("pass_comp", "pass_att", 100, 1),
    "pass_success_rate": ("pass_successes", "pass_att", 100, 1),
    "rush_success_rate": ("rush_successes", "rush_att", 100, 1),
    "success_rate": ("pass_successes + rush_successes", "pass_att + rush_att", 100, 1),
    "explosive_rate": ("rush_explosive + pass_explosive", "pass_att + rush_att", 100, 1),
    "rush_explosive_rate": ("rush_explosive", "rush_att", 100, 1),
    "pass_explosive_rate": ("pass_explosive", "pass_att", 100, 1),
    "run_stuff_rate": ("stuffed_runs", "rush_att", 100, 1),
    "sack_rate": ("sacks", "dropbacks", 100, 1),
}
SITUATION_RATES = {
    "pass_pct": ("pass_att", "pass_att + rush_att", 100, 1),
    "rush_pct": ("rush_att", "pass_att + rush_att", 100, 1),
    "yards_per_play": ("pass_yds + rush_yds", "pass_att + rush_att", 1, 2),
    "success_rate": ("successes", "pass_att + rush_att", 100, 1),
    "explosive_rate": ("explosive_plays", "pass_att + rush_att", 100, 1),
    "avg_distance": ("distance_sum", "distance_n", 1, 1),
}
#: Metrics ranked low-first on offense; on defense the direction turns, but for shares of play calls.
LOW_FIRST = {"run_stuff_rate", "sack_rate"}
NEUTRAL = {"pass_pct", "rush_pct"}
RANKED = [*RATES, "passer_rating", "pass_yds", "pass_td", "rush_yds", "rush_td", "pass_comp_10_plus", "pass_comp_20_plus", "rush_10_plus", "rush_20_plus"]
SITUATION_RANKED = ["pass_pct", "rush_pct", "yards_per_play", "success_rate", "explosive_rate"]


def direction(metric: str, side: str) -> str:
    """'desc' where a greater value ranks first for the side, else 'asc'."""
    if side not in ("offense", "defense"):
        raise ValueError(f"side: {side}")
    low = metric in LOW_FIRST
    if side == "defense" and metric not in NEUTRAL:
        low = not low
    return "asc" if low else "desc"
