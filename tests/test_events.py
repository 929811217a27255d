"""The event stream: several folders, several batches, the newest count of each window."""

import datetime as dt

from fieldlog.streaming.events import replay_counts


def test_counts_over_folders_and_batches(spark, tmp_path):
    at = lambda h, m: dt.datetime(2024, 3, 1, h, m)
    parts = [[(at(5, 1), "a"), (at(5, 59), "a"), (at(6, 0), "b")], [(at(5, 30), "a"), (at(6, 30), "b"), (at(7, 0), None)]]
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, "ts timestamp_ntz, event_type string").coalesce(1).write.parquet(str(tmp_path / f"day={i}"))
    events = spark.read.parquet(*(str(tmp_path / f"day={i}") for i in range(2)))
    got = {(r["window_start"].hour, r["event_type"]): r["n"] for r in replay_counts(events).collect()}
    assert got == {(5, "a"): 3, (6, "b"): 2, (7, None): 1}
