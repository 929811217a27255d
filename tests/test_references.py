"""Dangling references against brute force, and its edge cases."""

import random

import numpy as np

from fieldlog.operators.references import dangling, dangling_report, pack, positions, unpack

REFS = "ref_name string, parent_name string, season string, run_id string, seek int, value string"
PARENTS = "parent_name string, season string, ord int, value string"


def brute(refs, parents):
    out = set()
    fold = lambda v: (v or "").strip(" ").lower()
    static = {p[0] for p in parents if p[1] is None and fold(p[3])}
    for name, parent, season, run, seek, value in refs:
        v = fold(value)
        if not v or season is None and parent not in static:
            continue
        have = {p[2] for p in parents if p[0] == parent and p[1] == (None if parent in static else season) and fold(p[3]) == v}
        if seek not in have:
            late, gone = any(o > seek for o in have), any(o < seek for o in have)
            out.add((name, run, v, "late" if late else "deleted" if gone else "missing"))
    return out


def test_containers_round_trip():
    for at in ([], [0], [5, 70_000], list(range(0, 4000, 3)), [65_535], list(range(20))):
        assert positions(unpack(pack(np.array(at, np.int64)))).tolist() == at


def test_against_brute_force(spark):
    rng = random.Random(4)
    v = lambda: rng.choice(["a", "B ", " b", "c", "dd", "", None, " ", "é", *map(str, range(40))])
    parents = [("p", f"s{rng.randrange(3)}", rng.randint(1, 4), v()) for _ in range(150)] + [("t", None, 1, v()) for _ in range(20)]
    refs = [(f"r{rng.randrange(2)}.{parent}", parent, f"s{s}", f"run{s}{k}", k, v()) for _ in range(300) for s in [rng.randrange(3)] for k in [rng.randrange(0, 6)] for parent in [rng.choice(["p", "t", "none"])]]
    got = [tuple(r) for r in dangling(spark.createDataFrame(refs * 2, REFS), spark.createDataFrame(parents * 2, PARENTS), range_keys=7).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(refs, parents)


def test_empty_and_clashing_columns(spark):
    empty_r, empty_p = spark.createDataFrame([], REFS), spark.createDataFrame([], PARENTS)
    some = spark.createDataFrame([("r", "p", "s", "x", 1, "k", 9, "box")], REFS + ", pos int, rng string")
    assert dangling(empty_r, empty_p).collect() == []
    assert [tuple(r) for r in dangling(some, empty_p).collect()] == [("r", "x", "k", "missing")]
    found = dangling(some, empty_p)
    runs = spark.createDataFrame([("x", "s", "kind")], "run_id string, season string, kind string")
    assert [tuple(r) for r in dangling_report(found, runs).collect()] == [("r", "s", "missing", 1, 1)]


def test_a_hot_season_is_cut_into_ranges(spark):
    parents = [("p", "s", 1, f"k{i}") for i in range(3000)]
    refs = [("r", "p", "s", "run", 1, f"k{i}") for i in range(2990, 3010)]
    got = dangling(spark.createDataFrame(refs, REFS), spark.createDataFrame(parents, PARENTS), range_keys=100).collect()
    assert {r["ref_value"] for r in got} == {f"k{i}" for i in range(3000, 3010)}
