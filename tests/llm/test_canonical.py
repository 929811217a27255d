"""Typed values to the list of clubs."""

from fieldlog.llm.canonical import map_values, neighbours
from fieldlog.llm.forms import osa

LIST = "team_no bigint, team_name string, mascot string, score string"
CLUBS = [(1, "Harrow Crossing", "Pilots", ""), (2, "Thistle Mesa", "Comets", ""), (3, "Hathern", "Corsairs", ""), (4, "Mt. Solque", None, "")]


HARROW = ["harrow crossing", "Crossing, Harrow", "HARRWO CROSSING", "HARROWCR", "HC", "HCC", "HRRCR", "HRRWCRSSNG", "Pilots", "Harrow Crossing Pilots", "HARROW CROSSING COLLEGE", "HARROW C", "CROSSING", "HAROWCR", "HARROW CROSSIN", "HAROW CRSOSING (JC)"]
NONE = ["BENCH", "SIDELINE", "UNKNOWN", "TBD", "??", "COLLEGE", "- / -"]


def test_forms_of_a_club(spark):
    ref = spark.createDataFrame(CLUBS, LIST)
    ctx = spark.createDataFrame([("g", "Harrow Crossing"), ("g", "Mt. Solque")], "game_id string, club string")
    rows = spark.createDataFrame([("f", "g", v) for v in HARROW + NONE], "field_name string, game_id string, raw_value string")
    got = {r["raw_value"]: r["team_no"] for r in map_values(rows, ref, ctx).collect()}
    assert got == {v: 1 for v in HARROW} | {v: 0 for v in NONE}


def test_soft_tfidf_ranks(spark):
    """Between two clubs of a game that share words the rarer word decides, and an exact name elsewhere beats a typo here."""
    ref = spark.createDataFrame([(1, "Penhallow Hills", None), (2, "Penhallow Coast", None), (3, "Galder Hills", None), (4, "Tarrow", None), (5, "Harrow Crossing", None)], "team_no int, team_name string, mascot string")
    ctx = spark.createDataFrame([("g", "Penhallow Hills"), ("g", "Penhallow Coast"), ("h", "Harrow Crossing"), ("h", "Galder Hills")], "game_id string, club string")
    want = {("g", "PENHALLOW CAOST"): 2, ("g", "Hills"): 1, ("g", "PENHALLOWC"): 2, ("g", "PENHALLOW"): 2, ("h", "TARROW"): 4, ("h", "HARROW"): 5, ("h", "HILLS"): 3, ("h", "penhallow coast"): 2, ("h", "PENHALLOW"): 0}
    got = {(r["game_id"], r["raw_value"]): r["team_no"] for r in map_values(spark.createDataFrame([("f", *k) for k in want], "field_name string, game_id string, raw_value string"), ref, ctx).collect()}
    assert got == want


def test_mapping(spark):
    ref = spark.createDataFrame(CLUBS, LIST)
    ctx = spark.createDataFrame([("g1", "Harrow Crossing"), ("g1", "Vanquil State"), ("g2", "Thistle Mesa"), ("g2", "Hathern"), ("g2", None), ("g2", "")], "game_id string, club string")
    vals = [("g1", "HC", 1), ("g2", "HC", 3), ("g1", "VANQUIL STATE", 0), ("g1", "VSC", 0), ("g1", "Thistle Mesa", 2), ("g1", "THSITLE MESA", 2), ("g2", "BENCH", 0), ("g3", "mt solque", 4), ("g3", "HC", 0), (None, "Hathern", 3), ("g1", "x" * 5000, 0)]
    rows = [("f", g, v, "clash") for g, v, _ in vals] * 2 + [("f", "g1", None, ""), ("f", "g1", "  ", "")]
    got = map_values(spark.createDataFrame(rows, "field_name string, game_id string, raw_value string, score string"), ref, ctx).collect()
    assert {(r["game_id"], r["raw_value"]): r["team_no"] for r in got} == {(g, v): n for g, v, n in vals}
    assert len(got) == len(vals)


def test_empty(spark):
    v, ref, ctx = spark.createDataFrame([], "field_name string, game_id string, raw_value string"), spark.createDataFrame([], LIST), spark.createDataFrame([], "game_id string, club string")
    assert map_values(v, ref, ctx).collect() == []
    one = spark.createDataFrame([("f", "g", "Hathern")], "field_name string, game_id string, raw_value string")
    assert [r["team_no"] for r in map_values(one, ref, ctx).collect()] == [0]


def test_symmetric_deletes_lose_no_near_pair(spark):
    import random

    rng = random.Random(2)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(3, 10))) for _ in range(120)})
    a = spark.createDataFrame([(w,) for w in words], "token string")
    b = spark.createDataFrame([(w,) for w in words], "word string")
    got = {(r["token"], r["word"]) for r in neighbours(a, b).collect()}
    want = {(x, y) for x in words for y in words if x == y or min(len(x), len(y)) >= 4 and osa(x, y) <= 1 and abs(len(x) - len(y)) <= 1}
    assert want <= got
