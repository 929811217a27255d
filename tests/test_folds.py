"""Held-out quality of the outcome models, and the drive model."""

import math
import random

import pytest

from fieldlog.operators import folds


def _rows(spark, seasons):
    """Whether a team passes depends on nothing but its name, which no feature tells."""
    draw = random.Random(3)
    rows = []
    for s in range(seasons):
        for team in range(10):
            for k in range(30):
                # week is unique to a team: a model that has seen the team knows its answer, one that hasn't doesn't.
                passes = int(team in (0, 3, 4, 7, 8))
                rows.append((f"s{s}", f"g{team}", k, f"t{team}", 1 + k % 4, 10, draw.randint(1, 99), 1, 0, team, k % 2, passes, 1 - passes, 0, float(5 + draw.randint(-2, 2))))
    return spark.createDataFrame(rows, f"season string, game_id string, play_id int, team string, {', '.join(f'{c} int' for c in folds.FEATURES)}, is_dropback int, is_rush_attempt int, is_sack int, yards_gained double")


def test_quality_is_of_plays_not_fitted_on(spark, monkeypatch):
    monkeypatch.setattr(folds, "SEASON_FOLDS", 2)
    rows = _rows(spark, 3)
    got = {(r["split"], r["held_out"]): r.asDict() for r in folds.held_out_quality(rows).collect()}
    assert {k for k in got if k[0] == "unseen_season"} == {("unseen_season", x) for x in ("s0", "s1", "s2", "mean")}
    assert {k for k in got if k[0] == "unseen_team"} == {("unseen_team", x) for x in ("0", "1", "2", "3", "4", "mean")}
    # Every play is scored once in either split; an unseen season is easy, an unseen team isn't.
    assert got["unseen_team", "mean"]["n"] == got["unseen_season", "mean"]["n"] == 900
    assert got["unseen_season", "mean"]["auc"] > 0.99
    assert got["unseen_team", "mean"]["log_loss"] > 0.5 > got["unseen_season", "mean"]["log_loss"]
    for r in got.values():
        assert 0 < r["pass_mae"] <= r["pass_rmse"] < 5 if r["n_pass"] else r["pass_mae"] is None


def test_one_season_has_no_unseen_one(spark):
    got = [r for r in folds.held_out_quality(_rows(spark, 1)).collect() if r["split"] == "unseen_season"]
    assert [(r["n"], r["auc"], r["rush_mae"]) for r in got] == [(300, None, None)] * 2


def test_quality_by_hand(spark):
    cols = "k int, xpass double, is_dropback int, is_rush_attempt int, is_sack int, yards_gained double, rush_yards double, pass_yards double"
    df = spark.createDataFrame([(1, 0.8, 1, 0, 0, 9.0, 0.0, 5.0), (1, 0.4, 0, 1, 0, 3.0, 4.0, 0.0), (1, 0.4, 1, 1, 1, -8.0, 0.0, 0.0), (2, 0.5, 1, 0, 0, 1.0, 1.0, 1.0)], cols)
    a, b = folds.quality(df, "k").orderBy("k").collect()
    assert (a["n"], a["auc"], a["n_rush"], a["rush_mae"], a["n_pass"], a["pass_mae"]) == (3, 0.75, 1, 1.0, 2, 6.0)
    assert a["pass_rmse"] == pytest.approx(math.sqrt(40))
    assert (b["auc"], b["rush_mae"], b["pass_mae"]) == (None, None, 0.0)


def test_drive_logit(spark):
    draw = random.Random(5)
    rows = []
    for k in range(600):
        start, explosives = draw.randint(1, 99), draw.randint(0, 3)
        rows.append(("s", "r", "g", k, "t", start, explosives, draw.randint(0, 1), draw.randint(0, 1), int(draw.random() < 1 / (1 + math.exp(1 - explosives)))))
    got = {r["feature"]: r for r in folds.drive_logit(spark.createDataFrame(rows, "season string, run_id string, game_id string, drive_id int, offense string, start int, explosives int, penalties int, sacks int, scored int")).collect()}
    assert got["explosives"]["p_value"] < 1e-6 < 0.01 < got["penalties"]["p_value"]
    assert got["explosives"]["raw_coefficient"] == pytest.approx(1, abs=0.25)
    assert got["explosives"]["logit_rank"] == 1
    four = [got[c] for c in ("start", "explosives", "penalties", "sacks")]
    assert sorted(r["tree_rank"] for r in four) == [1, 2, 3, 4]
    assert sum(r["importance"] for r in four) == pytest.approx(1)
    assert 0 < got["start"]["pseudo_r2"] < 1
    assert 0.6 < got["start"]["holdout_auc"] < 1
    assert got["intercept"]["importance"] is None
