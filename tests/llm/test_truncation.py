"""Cut texts and club names: recall and precision on made cases, and edge cases."""

import random

import numpy as np
import pandas as pd

from fieldlog.llm.truncation import club_cut, fit_source, text_cut

ROWS = "run_id string, game_id string, play_id int, home_team string, raw_text string, source string"
KEYS = ["run_id", "game_id", "play_id"]


def entry(rng, i):
    who = rng.choice(["Ann Lee", "Bo Diaz", "Cy Okafor"])
    t = f"{who} rush for {rng.randint(1, 20)} yards to the HOME{rng.randint(1, 49)} ({rng.choice(['Dee Fox', 'Eli Gray'])})"
    if rng.random() < 0.5:
        t += f", PENALTY HOME {rng.choice(['holding', 'unsportsmanlike conduct', 'offside'])} {rng.choice([5, 10, 15])} yards to the HOME{i % 49}"
    return t + "."


def test_cut_texts_are_found(spark):
    rng = random.Random(3)
    rows, cut = [], set()
    for i in range(600):
        full = entry(rng, i)
        t = full
        if len(full) > 100:
            t = full[:100].rstrip() + rng.choice(["", "..."])
        elif rng.random() < 0.03:
            t = full[: rng.randint(10, len(full) - 8)].rstrip(" .")
            while t[-1].isdigit() or t[-1] == ")":
                t = t[:-1]
        if t != full:
            cut.add(i)
        rows.append(("r", "g", i, "Home", t, "x"))
    rows += rows[:50]
    got = [r["play_id"] for r in text_cut(spark.createDataFrame(rows, ROWS), KEYS, "home_team", "raw_text").collect()]
    assert len(got) == len(set(got))
    got = set(got)
    assert len(got & cut) / len(cut) > 0.97
    assert len(got & cut) / len(got) > 0.97


def test_finished_entries_without_mark_are_none(spark):
    """A source that never closes its entries: what another source closes after such an ending is finished here too."""
    rng = random.Random(5)
    whole = [entry(rng, i) for i in range(12_000)]
    open_ = [entry(rng, i).rstrip(".") for i in range(300)]
    stopped = ["Ann Lee rush for", "Bo Diaz rush for 3 yards to", "Cy Okafor rush for 12 yards to the HOME4 (Dee Fo", "Ann Lee rush for 3 yards to the HOME9 (Eli Gray), PENALTY HOME holding 10 yar", "Bo Diaz rush for 9 yards to the HOME9 (Eli Gray), PENALTY HOME..."]
    rows = [("r", "g", i, "Home", t, None) for i, t in enumerate(whole)] + [("r", "h", i, "Other", t, None) for i, t in enumerate(open_ + stopped + [None, "", "  "])]
    got = text_cut(spark.createDataFrame(rows, ROWS), KEYS, "home_team", "raw_text").collect()
    assert sorted((r["game_id"], r["play_id"]) for r in got) == [("h", len(open_) + i) for i in range(len(stopped))]
    assert text_cut(spark.createDataFrame([], ROWS), KEYS, "home_team", "raw_text").collect() == []


def test_very_long_text_is_read_whole(spark):
    rng = random.Random(7)
    long = "Ann Lee rush for 3 yards to the HOME9 (Dee Fox). " * 20_000
    rows = [("r", "g", 1, "Home", long + "Ann Lee rush fo", None), ("r", "g", 2, "Home", long.strip(), None)] + [("r", "g", i, "Home", entry(rng, i), None) for i in range(3, 900)]
    assert [r["play_id"] for r in text_cut(spark.createDataFrame(rows, ROWS), KEYS, "home_team", "raw_text").collect()] == [1]


def test_censored_limit_by_maximum_likelihood():
    """The limit is found wherever it lies, also among values of which some pass it, and none is found without one."""
    rng = np.random.default_rng(0)
    for mean, limit in ((4.4, 110), (9.0, 12_000)):
        full = np.exp(rng.normal(mean, 0.4, 4000)).round().astype(int)
        passes = rng.random(4000) < 0.05
        lengths = np.where(passes, full, np.minimum(full, limit))
        hist = pd.DataFrame({"length": lengths, "n": 1, "n_open": ((full > limit) & ~passes).astype(int)})
        fit = fit_source(("s",), hist)
        assert fit["cut_limit"][0] == limit
        assert fit["band_share"][0] > 0.8
        free = pd.DataFrame({"length": full, "n": 1, "n_open": (rng.random(4000) < 0.004).astype(int)})
        assert pd.isna(fit_source(("s",), free)["cut_limit"][0])


CLUBS = "run_id string, game_id string, play_id int, home_team string, away_team string, offense string, defense string, field_position string, penalty_team string"


def test_club_names(spark):
    cut = ["HARROW CROSS", "HARROW C", "THISTLE MES", "VAQUER", "HARROW CROSSING COLL", "HARROE CR"]
    whole = ["HARROW", "CROSSING", "HARROW CROSSING", "HC", "HCC", "HRRWCRSSNG", "HARROWCR", "HARROW CROSSING CC", "VAQUEROS", "HARRWO CROSSING", "BENCH", None, "", "  "]
    values = cut + whole
    rows = [("r", "g", i, "Harrow Crossing", "Thistle Mesa", "Harrow Crossing", "Thistle Mesa", "HARROWCR35", v) for i, v in enumerate(values)]
    rows += [("r", f"g{i}", i, "Harrow Crossing", "Thistle Mesa", "Harrow Crossing", "Thistle Mesa", "HARROWCR35", v) for i in range(100) for v in ("HARROW CROSSING", "THISTLE MESA")]
    nick = spark.createDataFrame([("Harrow Crossing", "Vaqueros"), ("Thistle Mesa", None)], "team_name string, mascot string")
    got = club_cut(spark.createDataFrame(rows * 2, CLUBS), KEYS, "home_team", "penalty_team", "game_id", "field_position", ["home_team", "away_team", "offense", "defense"], nick).collect()
    assert sorted((r["game_id"], values[r["play_id"]]) for r in got) == [("g", v) for v in sorted(cut)]


def test_the_fit_decides_what_looks_like_a_code(spark, monkeypatch):
    """Codes made by cutting names are deliberate, unless they fill a limit at which their source cuts names: the posterior of the fit decides."""
    rows, i = [], 0
    for g in range(80):
        for host, values in (("Harrow Crossing", ["HARROWCR" if g % 3 else "PILOTS"]), ("Thistle Mesa", ["THISTLEM"] if g % 10 == 0 else ["THISTLE MESA", "THISTLE MESA COLLEGE", "TM"])):
            for v in values:
                code = "HARROWCR35" if host == "Harrow Crossing" else "THISTLEM20"
                rows.append(("r", f"{host}{g}", i, host, "Isker", host, "Isker", code, v))
                i += 1
    nick = spark.createDataFrame([("Harrow Crossing", "Pilots"), ("Thistle Mesa", None)], "team_name string, mascot string")
    ask = lambda: {r["source"] for r in club_cut(spark.createDataFrame(rows, CLUBS), KEYS, "home_team", "penalty_team", "game_id", "field_position", ["home_team", "away_team", "offense", "defense"], nick).collect()}
    assert ask() == {"Harrow Crossing"}
    no_limit = lambda hist: hist.select("source").distinct().selectExpr("source", "CAST(NULL AS DOUBLE) AS cut_limit", "0D AS band_share")
    monkeypatch.setattr("fieldlog.llm.truncation.length_limits", no_limit)
    assert ask() == set()
