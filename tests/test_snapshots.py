"""Changes between snapshots against brute force, and its edge cases."""

import random

from pyspark.sql import functions as F

from fieldlog.operators.ledger import completed_runs, numbered
from fieldlog.operators.snapshots import changes

ROWS = "run_id string, k string, a int, b string, season string, __hash string"
RUNS = "run_id string, season string, ord int"


def run(spark, rows, runs):
    got = changes(spark.createDataFrame(rows, ROWS), spark.createDataFrame(runs, RUNS), ["k"], {"a": F.col("a"), "b": F.col("b")}).collect()
    out = [tuple(r) for r in got]
    assert len(out) == len(set(out))
    return set(out)


def test_against_brute_force(spark):
    rng = random.Random(1)
    runs = [(f"s{s}r{i}", f"s{s}", i) for s in range(3) for i in range(1, 5)]
    snap = {r[0]: {k: (rng.choice([None, 0, 1]), rng.choice([None, "", "x"])) for k in rng.sample("abcdefgh", rng.randint(0, 8))} for r in runs}
    rows = [(r, k, *v, "other", "x") for r, d in snap.items() for k, v in d.items()]
    want = set()
    for r, s, i in runs:
        if i > 1:
            old, new = snap[f"{s}r{i - 1}"], snap[r]
            want |= {(r, k, "added" if k not in old else "removed" if k not in new else "changed") for k in old.keys() | new.keys() if old.get(k, 0) != new.get(k, 0)}
    assert run(spark, rows * 2, runs) == want


def test_nulls_are_values_and_keys(spark):
    runs = [("r1", "s", 1), ("r2", "s", 2)]
    rows = [("r1", None, 1, "x", "", ""), ("r2", None, 2, "x", "", ""), ("r1", "k", None, "1", "", ""), ("r2", "k", 1, None, "", ""), ("r1", "e", None, None, "", ""), ("r2", "e", None, "", "", "")]
    assert run(spark, rows, runs) == {("r2", None, "changed"), ("r2", "k", "changed"), ("r2", "e", "changed")}


def test_one_run_no_rows_and_unknown_runs(spark):
    assert run(spark, [("r1", "k", 1, "x", "", ""), ("zz", "k", 1, "x", "", "")], [("r1", "s", 1)]) == set()
    assert run(spark, [("r1", "k", 1, "x", "", "")], [("r1", "s", 1), ("r2", "s", 2)]) == {("r2", "k", "removed")}
    assert run(spark, [], [("r1", "s", 1), ("r2", "s", 2)]) == set()


def test_runs_are_completed_and_in_order(spark):
    from datetime import datetime

    led = spark.createDataFrame(
        [("b", "s", "completed", datetime(2024, 1, 2)), ("b", "s", "completed", datetime(2024, 1, 2)), ("a", "s", "completed", datetime(2024, 1, 3)), ("c", "s", "failed", datetime(2024, 1, 1)), ("d", "s", "completed", None), ("e", None, "completed", None)],
        "run_id string, season string, status string, started_at timestamp_ntz",
    )
    have = spark.createDataFrame([("a",), ("b",), ("b",), ("d",), (None,)], "run_id string")
    got = {r["run_id"]: r["ord"] for r in numbered(completed_runs(led, have)).collect()}
    assert got == {"d": 1, "b": 2, "a": 3}
