"""Worked examples of the play context, drives and rollups."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fieldlog.functions.expr import PLAY_FLAGS, direction, ranked
from fieldlog.operators import crosswalk as xw
from fieldlog.operators import current as cur
from fieldlog.operators import rollups as roll
from fieldlog.operators.context import play_context
from fieldlog.operators.loaders import identity, team_stats

SCHEMA = """run_id string, season string, game_id string, home_team string, away_team string, schedule_home string, schedule_away string, play_id int, drive_id int, quarter int, down int, distance int,
field_position string, offense string, defense string, play_type string, passer string, yards_gained int, is_dropback boolean, is_conversion boolean, is_pass_attempt boolean, is_rush_attempt boolean, completion boolean,
is_interception boolean, is_td boolean, is_sack boolean, is_fumble boolean, fumble_recovered_by string, is_safety boolean, is_defensive_td boolean, is_penalty boolean, fg_result string, raw_text string"""
NAMES = [c.split()[0] for c in SCHEMA.split(",")]
BASE = dict.fromkeys(NAMES) | dict(run_id="p1", season="2025-26", game_id="g1", home_team="A", away_team="B", schedule_home="A", schedule_away="B", drive_id=1, quarter=1, offense="A", defense="B", play_type="rush", yards_gained=0, is_rush_attempt=True, raw_text="x")
BASE |= {c: False for c in NAMES if c.startswith("is_") and c != "is_rush_attempt"} | {"completion": False}


def context(spark, plays, walk=()):
    rows = [tuple((BASE | p | {"play_id": p.get("play_id", i + 1)})[c] for c in NAMES) for i, p in enumerate(plays)]
    runs = spark.createDataFrame(
        [("s1", "2025-26", "structure", datetime(2025, 1, 1), None, "completed", "{}"), ("p1", "2025-26", "plays", datetime(2025, 1, 2), datetime(2025, 1, 3), "completed", "broken {"), ("p0", "2025-26", "plays", datetime(2025, 1, 1), datetime(2025, 1, 1), "completed", None)],
        "run_id string, season string, stage string, started_at timestamp_ntz, finished_at timestamp_ntz, status string, notes string",
    )
    for c in ("standings_count", "schedule_count", "games_count"):
        runs = runs.withColumn(c, F.lit(0))
    sched = spark.createDataFrame([("s1", "2025-26", t, "g1", "20250901") for t in "AB"], "run_id string, season string, team_name string, game_id string, game_date string")
    cross = spark.createDataFrame(list(walk), "game_id string, prefix string, canonical_team string")
    return play_context(spark.createDataFrame(rows, SCHEMA), runs, sched, cross)


@pytest.mark.parametrize(("down", "distance", "early", "passing"), [(1, 10, True, False), (2, 5, True, False), (2, 8, False, True), (3, 3, False, False), (3, 8, False, True), (4, 2, False, False), (None, 5, None, None), (1, None, None, None)])
def test_down_truth_table(spark, down, distance, early, passing):
    df = spark.createDataFrame([(down, distance)], "down int, distance int").select(F.expr(PLAY_FLAGS["is_early_down"]).alias("e"), F.expr(PLAY_FLAGS["is_passing_down"]).alias("p"))
    assert tuple(df.first()) == (early, passing)


def test_pre_play_score_and_repeats(spark):
    plays = [dict(play_id=1, is_td=True), dict(play_id=1, is_td=True), dict(play_id=2), dict(play_id=3, offense="B", defense="A")]
    got = [(r["play_id"], r["home_score"], r["away_score"], r["score_margin"], r["score_margin_bucket"]) for r in context(spark, plays).orderBy("play_id").collect()]
    assert got == [(1, 0, 0, 0, "tied"), (2, 6, 0, 6, "one_score_lead"), (3, 6, 0, -6, "one_score_deficit")]


def test_kickoff_return_and_fumble_touchdowns(spark):
    kick = dict(play_type="kickoff", is_rush_attempt=False, is_td=True)
    fumble = dict(is_fumble=True, raw_text="fumble, TOUCHDOWN", fumble_recovered_by="BTEAM Joe")
    rows = context(spark, [kick, fumble, fumble | dict(fumble_recovered_by="ATEAM Joe", is_td=True)], [("g1", "A", "A"), ("g1", "BTEAM", "B"), ("g1", "ATEAM", "A")])
    pts = {r["team_name"]: (r["points_scored"], r["points_allowed"]) for r in roll.team_game_points(rows).collect()}
    assert pts == {"A": (6, 12), "B": (12, 6)}


def test_drives_worked_example(spark):
    walk = [("g1", "OPP", "B")]
    at = lambda y: {"field_position": f"OPP{y}"}
    out = lambda **k: dict(is_rush_attempt=False, **k)
    plays = [dict(drive_id=1, **at(30)), dict(drive_id=1, is_td=True)]
    plays += [dict(drive_id=2, **at(45)), out(drive_id=2, play_type="pass", is_pass_attempt=True, is_dropback=True), dict(drive_id=2), out(drive_id=2, play_type="punt")]
    plays += [dict(drive_id=3, **at(50))] + [dict(drive_id=3)] * 2 + [dict(drive_id=4, **at(25))] + [dict(drive_id=4)] * 3
    d = roll.drives(context(spark, plays, walk))
    got = sorted((r["drive_id"], r["start_yardline_100"], r["scrimmage_plays"], r["drive_points"], r["is_scoring_drive"], r["is_three_and_out"]) for r in d.collect())
    assert got == [(1, 30, 2, 6, True, False), (2, 45, 3, 0, False, True), (3, 50, 3, 0, False, True), (4, 25, 4, 0, False, False)]
    for side in ("offense", "defense"):
        s = roll.season_drives_ranked(roll.team_drives(d, side, "season"), side).first()
        assert (s["drives"], s["total_scrimmage_plays"], s["drives_scored"], s["drives_three_and_out"], s["pct_drives_scored"], s["avg_plays_per_drive"]) == (4, 12, 1, 2, 25.0, 3.0)


def test_offense_row_with_a_sack_and_its_mirror(spark):
    plays = [dict(play_type="pass", is_rush_attempt=False, is_pass_attempt=True, is_dropback=True, completion=True, yards_gained=12, is_td=True), dict(yards_gained=1), dict(play_type="pass", is_sack=True, is_dropback=True, yards_gained=-7)]
    c = context(spark, plays)
    o, d = roll.team_game(c, "offense").first(), roll.team_game(c, "defense").first()
    assert [o[k] for k in ("pass_att", "pass_comp", "pass_yds", "pass_td", "rush_att", "sacks", "dropbacks", "play_count", "stuffed_runs")] == [1, 1, 12, 1, 2, 1, 2, 3, 1]
    assert (d["opp_pass_att"], d["sacks_forced"], d["opponent"]) == (1, 1, "A")


def test_situations_overlap(spark):
    c = context(spark, [dict(down=1, distance=10), dict(down=2, distance=5), dict(down=3, distance=8)])
    got = {r["situation"]: r["play_count"] for r in roll.team_game(c, "offense", "situation").collect()}
    assert got == {"early_down": 2, "third_down": 1, "passing_down": 1}


def test_dashboard_equals_the_rollup_without_filters(spark):
    c = context(spark, [dict(yards_gained=y, quarter=q) for y, q in ((5, 1), (12, 2), (-1, 3))])
    a, b = team_stats(c, "offense", "season", "rushing").first(), roll.season_ranked(roll.team_season(roll.team_game(c, "offense"), "offense"), "offense").first()
    assert (a["rush_yds"], a["rush_ypa"], a["rush_success_rate"]) == (b["rush_yds"], b["rush_ypa"], b["rush_success_rate"])
    assert team_stats(c, "offense", "season", "rushing", quarter=[1, 2]).first()["rush_yds"] == 17
    with pytest.raises(ValueError, match="unknown"):
        team_stats(c, "offense", "week", "rushing")


def test_directions_and_ranks(spark):
    assert [direction(m, s) for m in ("rush_yds", "sack_rate", "pass_pct") for s in ("offense", "defense")] == ["desc", "asc", "asc", "desc", "desc", "desc"]
    df = spark.createDataFrame([("s", 1), ("s", 1), ("s", None), ("s", 5)], "season string, m int")
    assert sorted((r["m"] or -1, r["m_rank"]) for r in ranked(df, ["season"], {"m": "asc"}).collect()) == [(-1, 4), (1, 1), (1, 1), (5, 3)]


def test_staleness_of_field_positions(spark):
    rows = [("s", "x", "structure", "completed", None, 1), ("p2", "x", "plays", "completed", None, 5), ("f1", "x", "field_position", "completed", '{"source_plays_run_id": "p1"}', 3), ("p9", "y", "plays", "completed", None, 1), ("f9", "y", "field_positions", "completed", '{"source_plays_run_id": "p9"}', 2)]
    runs = spark.createDataFrame([(a, b, c, d, e, datetime(2025, 1, f), None, 0, 0, 0) for a, b, c, d, e, f in rows], "run_id string, season string, stage string, status string, notes string, started_at timestamp_ntz, finished_at timestamp_ntz, standings_count int, schedule_count int, games_count int")
    assert {r["season"]: r["field_position_is_stale"] for r in cur.current_runs(runs).collect()} == {"x": True, "y": False}


def test_crosswalk_pairs_and_seeds(spark):
    groups = spark.createDataFrame([("g1", "AA"), ("g1", "BB"), ("g2", "AA"), ("g2", "ZZ"), ("g3", "AA")], "game_id string, prefix string")
    games = spark.createDataFrame([(g, "A", "B") for g in ("g1", "g2", "g3")], "game_id string, schedule_home string, schedule_away string")
    chosen = spark.createDataFrame([("g1", "AA", "A"), ("g3", "AA", "A"), ("g2", "QQ", "A")], "game_id string, prefix string, team string")
    got = {(r["game_id"], r["prefix"]): (r["canonical_team"], r["error"]) for r in xw.resolve_pair(groups, chosen, games).collect()}
    assert got == {("g1", "AA"): ("A", None), ("g1", "BB"): ("B", None), ("g3", "AA"): (None, "not two prefixes"), ("g2", "AA"): (None, "prefix not in game"), ("g2", "ZZ"): (None, "prefix not in game")}
    known = spark.createDataFrame([("g1", "AA", "A"), ("g1", "BB", "B")], "game_id string, prefix string, canonical_team string")
    assert {tuple(r) for r in xw.seed_crosswalk(groups, known, games).collect()} == {("g2", "AA", "A"), ("g2", "ZZ", "B")}


def test_season_means_do_not_depend_on_the_order_of_teams(spark):
    # The mean of either column is 5.56625, halfway between two results; plain sums of doubles give both of them.
    ypa = [7.22, 6.79, 5.1, 4.29, 5.56, 5.02, 6.92, 3.63]
    drives = spark.createDataFrame([], "season string, team_name string, avg_start_yardline_100 double, pct_drives_scored double, plays_per_game double, avg_plays_per_drive double")
    early = spark.createDataFrame([], "season string, team_name string, situation string, rush_pct double")
    found = set()
    for turn in range(8):
        for values in (ypa[turn:] + ypa[:turn], (ypa[turn:] + ypa[:turn])[::-1]):
            rows = [("s", str(v), 50.0, 50.0, v, v, 40.0) for v in values] + [("s", "none", None, None, None, None, None), ("t", "none", None, None, None, None, None)]
            table = spark.createDataFrame(rows, "season string, team_name string, rush_pct double, pass_pct double, rush_ypa double, pass_ypa double, success_rate double").coalesce(1)
            found |= {(r["season"], r["avg_rush_ypa"], r["avg_pass_ypa"]) for r in identity(table, drives, early).collect()}
    assert found == {("s", 5.5663, 5.5663), ("t", None, None)}
