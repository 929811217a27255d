"""Readers and writers on temporary files."""

from datetime import datetime

from fieldlog.sources import files


def test_csv_crosswalk_and_pages(spark, tmp_path):
    (tmp_path / "plays.csv").write_text('play_type,down,distance,raw_text\nrush,1,10,"a ""b"", c"\npass,x,,d\npunt,4,1,e\n')
    got = files.scrimmage_csv(spark, str(tmp_path / "plays.csv")).collect()
    assert [(r["play_type"], r["down"], r["has_down_distance"], r["raw_text"]) for r in got] == [("rush", 1.0, True, 'a "b", c'), ("pass", None, False, "d")]
    (tmp_path / "walk.csv").write_text("game_id,prefix_a,canonical_a,prefix_b,canonical_b\ng,AA,A,BB,\n")
    assert [tuple(r) for r in files.crosswalk_csv(spark, str(tmp_path / "walk.csv")).collect()] == [("g", "AA", "A")]
    (tmp_path / "g1.html").write_text("<p>\nx</p>")
    assert [tuple(r) for r in files.page_folder(spark, str(tmp_path)).collect()] == [("g1", "<p>\nx</p>")]


def test_runs_are_appended_and_replaced(spark, tmp_path):
    rows = lambda run, *v: spark.createDataFrame([("s", run, x) for x in v], "season string, run_id string, v int")
    path = str(tmp_path / "t")
    files.append_run(rows("a", 1, 2), path)
    files.append_run(rows("b", 3), path)
    files.replace_runs(rows("a", 9), path)
    assert sorted((r["run_id"], r["v"]) for r in spark.read.parquet(path).collect()) == [("a", 9), ("b", 3)]
    files.write_csv(rows("a", 1), str(tmp_path / "c"), ["v"])
    assert [tuple(r) for r in files.csv_table(spark, str(tmp_path / "c"), {"v": "int"}).collect()] == [(1,)]


def test_ledger_from_events(spark):
    t = lambda d: datetime(2025, 1, d)
    e = spark.createDataFrame([("r", "s", "plays", "running", t(1), None), ("r", None, None, "completed", t(2), "{}"), ("q", "s", None, "running", t(3), None)], "run_id string, season string, stage string, status string, at timestamp_ntz, notes string")
    got = {r["run_id"]: (r["season"], r["stage"], r["status"], r["started_at"], r["finished_at"]) for r in files.ledger_of(e).collect()}
    assert got == {"r": ("s", "plays", "completed", t(1), t(2)), "q": ("s", None, "running", t(3), None)}


def test_columns_and_union(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([("z",)], "y string")
    assert {tuple(r) for r in files.union_all([a, b]).collect()} == {(1, None), (None, "z")}
    from pyspark.sql import functions as F

    assert tuple(files.with_columns(a, {"y": "string"}, {"y": F.lit("f")}).first()) == (1, "f")
    u = spark.createDataFrame([("https://x.test/s/2025-26/a",), ("none",)], "u string").select(files.season_of("u"))
    assert [r[0] for r in u.collect()] == ["2025-26", None]
