"""Near-equal roster names, the choice by role, names applied to plays; health and display places."""

from fieldlog.operators.reporting import coverage_health, sorted_with_places
from fieldlog.operators.rosters import NAMED, apply_names, choose, distinct_players

ROSTER = "season string, team string, name string"


def test_distinct_players(spark):
    names = ["Ira Moss", "Ira Mossman", "Ira Mossmann", "Ina Mossmann", "Ira Moss", "Lu Vane", None, " "]
    got = sorted(r["name"] for r in distinct_players(spark.createDataFrame([("s", "t", n) for n in names], ROSTER)).collect())
    # "Ira Moss" has another six letters; "Ina" begins nothing.
    assert got == ["Ina Mossmann", "Ira Moss", "Ira Mossmann", "Lu Vane"]
    assert distinct_players(spark.createDataFrame([], ROSTER)).collect() == []


def test_choice(spark):
    rows = [
        ("role", "passer/rusher", "Abe A", "QB"), ("role", "passer/rusher", "Abe B", "CB"), ("long", "defender", "Cy", None), ("long", "defender", "Cyrus", ""),
        ("none", "receiver", "Dan X", "WR"), ("none", "receiver", "Don X", "TE/WR"), ("one", None, "Eve", "K"), ("one", None, "Eve", None),
    ]
    df = spark.createDataFrame([("s", "t", n, r, c, p, "clash") for n, r, c, p in rows], "season string, team string, pbp_name string, role string, canonical string, position string, score string")
    assert {r["pbp_name"]: (r["canonical"], r["how"]) for r in choose(df).collect()} == {"role": ("Abe A", "role"), "long": ("Cyrus", "longest"), "none": (None, "ambiguous"), "one": ("Eve", "alone")}


def test_apply(spark):
    plays = spark.createDataFrame([(1, "s", "A", "B", "x", None, "y", "x", "", "z"), (2, None, None, "B", "x", "x", "x", "x", "x", "x")], f"play_id int, season string, offense string, defense string, {', '.join(f'{c} string' for c in NAMED)}")
    names = spark.createDataFrame([("s", "A", "x", "Xena"), ("s", "B", "x", "Xavier"), ("s", "B", "z", "Zoe"), ("s", "A", "y", None)], "season string, team string, pbp_name string, canonical string")
    got = {r["play_id"]: tuple(r[c] for c in NAMED) for r in apply_names(plays, names, ["play_id"]).collect()}
    assert got == {1: ("Xena", None, "y", "Xavier", "", "Zoe"), 2: ("x",) * 6}


def test_places_and_health(spark):
    t = spark.createDataFrame([("s", "a", 3.0), ("s", "b", 9.0), ("s", "c", None)], "season string, team_name string, pass_yds double")
    place = lambda side, down: {r["team_name"]: (r["row"], r["place"]) for r in sorted_with_places(t, "pass_yds", side, down, ["season", "team_name"]).collect()}
    assert place("offense", True) == {"b": (1, 1), "a": (2, 2), "c": (3, 3)}
    assert place("offense", False) == {"a": (1, 3), "b": (2, 2), "c": (3, 1)}
    c = spark.createDataFrame([("s", "a", 0), ("s", "b", 1), ("s", "c", 2)], "season string, team_name string, missing_pbp_games long")
    assert [r["health"] for r in coverage_health(c).orderBy("team_name").collect()] == ["complete", "allowed", "short"]
