"""Play texts, names, JSON and the upsert."""

import json

import pytest

from fieldlog.operators import silver
from fieldlog.operators.names import RULES, close, match_names, normalized, rule_of
from fieldlog.operators.play_text import parse_plays

CASES = [
    ("Smith,John rush for 5 yards to the ABC35 (Doe,Jim;TEAM).", dict(play_type="rush", rusher="John Smith", yards_gained=5, tackler_1="Jim Doe", tackler_2=None, is_rush_attempt=True)),
    ("A. Bee sacked for loss of 7 yards to the ABC20 (TEAM;Joe Doe).", dict(play_type="pass", is_sack=True, is_rush_attempt=True, is_pass_attempt=False, passer="A. Bee", yards_gained=-7, tackler_1="Joe Doe")),
    ("A. Bee pass complete to C. Dee for no gain to the ABC20", dict(play_type="pass", pass_result="complete", receiver="C. Dee", yards_gained=0, completion=True)),
    ("A. Bee pass incomplete to José Núñez.", dict(pass_result="incomplete", receiver="José Núñez", yards_gained=0)),
    ("A. Bee pass intercepted by X. Y at the ABC30, X. Y return 30 yards to the ABC0, TOUCHDOWN", dict(pass_result="int", is_td=False, is_defensive_td=True, yards_gained=0)),
    ("K. Er field goal attempt from 32 GOOD", dict(play_type="field_goal", fg_result="good")),
    ("K. Er field goal attempt from 32 BLOCKED", dict(play_type="field_goal", fg_result="blocked")),
    ("K. Er kick attempt FAILED.", dict(play_type="pat", fg_result="failed", is_conversion=True)),
    ("A. Bee pass attempt to C. Dee good", dict(play_type="two_point", receiver="C. Dee", fg_result="good", is_conversion=True, is_pass_attempt=False)),
    ("TEAM rush attempt failed.", dict(play_type="two_point", rusher=None, fg_result="failed")),
    ("P. Unt punt 40 yards to the ABC20, downed.", dict(play_type="punt", yards_gained=40)),
    ("K. Off kickoff 60 yards to the ABC5", dict(play_type="kickoff", yards_gained=60)),
    ("PENALTY HOME TEAM holding (Joe Doe) 10 yards to the ABC20", dict(play_type="penalty", penalty_team="HOME TEAM", penalty_type="holding", penalty_player="Joe Doe", penalty_yards=10)),
    ("R. Un rush for 3 yards, fumble by R. Un recovered by OPP Joe Doe at OPP20, TOUCHDOWN", dict(play_type="rush", is_fumble=True, fumble_recovered_by="OPP JOE", is_td=False)),
    ("", dict(play_type=None)),
    (None, dict(play_type=None, is_td=False)),
]


def test_play_texts(spark):
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, text string")
    got = {r["i"]: r.asDict() for r in parse_plays(rows, "text", ["i"]).collect()}
    for i, (text, want) in enumerate(CASES):
        assert {k: got[i][k] for k in want} == want, text


@pytest.mark.parametrize(("a", "b", "rule"), [("Joe Doe", "Joe Doe", "exact"), ("DOE, JOE", "Joe Doe", "normalized"), ("Joe Doe B", "Joe Doe", "suffix"), ("Mike Doe", "Michael Doe", "first_last"), ("J. Doe", "Joe Doe", "initial_last"), ("Doe", "Joe Doe", "initial_last"), ("Joe Roe", "Jim Poe", None), ("", "Joe Doe", None)])
def test_name_rules(a, b, rule):
    assert rule_of(a, b) == rule
    assert normalized("José O'Neil Jr.") == ["jose", "oneil"]
    assert close("smith", "smyth", 0.8)
    assert not close("smith", "jones")


def test_match_names_outcomes(spark):
    rows = [("s", "t", "J. Doe", "", "QB"), ("s", "t", "x", "Joe Doe", "QB"), ("s", "t", "y", "Jim Doe", "K"), ("s", "t", "Zed Nobody", None, None), ("s", "t", "J. Roe", None, "WR"), ("s", "t", "z", "Joe Roe", "P"), ("s", "t", "q", "Jim Roe", "P")]
    got = {r["pbp_name"]: (r["outcome"], r["canonical"]) for r in match_names(spark.createDataFrame(rows, "season string, team string, pbp_name string, canonical_name string, position string")).collect()}
    assert got["J. Doe"] == ("matched", "Joe Doe")
    assert got["J. Roe"] == ("ambiguous", None)
    assert got["Zed Nobody"] == ("no_match", None)


def test_match_names_misses_no_pair(spark):
    """Candidates are what comparing every typed name with the whole roster finds."""
    typed = ["S. Toromwell", "D. Hulaado", "O. Obaedar", "S.Utoilberg", "Bo Li", "B. Li", "Li", "Li, Bo", "Bo Li J", "BoLi", "Al Ng Jr.", "A. Ng", "Ng", "李", "J. O'Ra", "V", "Jo Li B", "T. Obedar"]
    roster = ["Stephen Tromwell", "Dante Huulaado", "Orion Obedar", "Sebastián Uoilberg", "Bo Li", "Al Ng", "Ann Ng", "李", "Joe Ora", "B Oli"]
    rows = [("s", "t", x, "", None) for x in typed] + [("s", "t", x, x, "P") for x in roster]
    got = {r["pbp_name"]: (r["rule"], r["candidates"]) for r in match_names(spark.createDataFrame(rows, "season string, team string, pbp_name string, canonical_name string, position string")).collect()}
    for name in {*typed, *roster}:
        rules = [r for x in roster if (r := rule_of(name, x))]
        best = min(rules, key=RULES.index, default=None)
        assert got[name] == (best, rules.count(best) if best else 0), name


def test_players_json(spark):
    p = {"individuals": [{"playerId": "1", "fullName": "Joe", "team": "A", "position": "QB", "stats": {"pa": "10", "pct": "55.5%", "x": "-"}}, {"playerId": "2", "fullName": "Ole", "team": "A", "position": "OL", "stats": {}}]}
    raw = spark.createDataFrame([("r", "s", json.dumps(p)), ("r", "s", "broken"), ("r", "s", None)], "run_id string, season string, j string")
    got = [(r["playerId"], r["position_group"], r["pa"], r["pct"], r["x"]) for r in silver.players_from_json(raw, "j", ["pa", "pct", "x"]).collect()]
    assert sorted(got) == [("1", "qb", 10.0, 55.5, None), ("2", "other", None, None, None)]


def test_urls_and_kinds(spark):
    html = 'a "https://x.test/players_1.json" b https://x.test/team.json "https://x.test/players_1.json"'
    df = spark.createDataFrame([(html,)], "t string").select(silver.json_urls("t").alias("u"))
    assert df.first()["u"] == ["https://x.test/players_1.json", "https://x.test/team.json"]
    kinds = spark.createDataFrame([(u,) for u in df.first()["u"]], "u string").select(silver.source_kind("u"))
    assert [r[0] for r in kinds.collect()] == ["players_json", "team_json"]


def test_replaced_and_resumed(spark):
    stored = spark.createDataFrame([("g1", 1), ("g1", 2), ("g2", 1)], "game_id string, v int")
    new = spark.createDataFrame([("g1", 9)], "game_id string, v int")
    assert sorted(map(tuple, silver.replaced(stored, new, ["game_id"]).collect())) == [("g1", 9), ("g2", 1)]
    assert [tuple(r) for r in silver.not_done(stored, new, ["game_id"]).collect()] == [("g2", 1)]
