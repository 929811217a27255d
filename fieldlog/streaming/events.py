"""Event counts as a stream: windows with a watermark over files as they arrive."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlog.session import shared_dir


def hourly_counts(events: DataFrame, late: str = "40 days") -> DataFrame:
    """Events per hour and type; rows later than ``late`` behind the newest are dropped by the stream."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), "event_type", "n")


def replay_counts(events: DataFrame) -> DataFrame:
    """The hourly counts of a stored table, run through the stream from all its files to its end.

    The stream gives the counts that each batch changed and forgets windows behind the watermark; a batch writes them
    under its number, so that a batch run again replaces its own, and the newest count of a window holds.
    """
    spark = events.sparkSession
    base = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    files = events.inputFiles()
    folders = sorted({f.rsplit("/", 1)[0] for f in files})
    parts = [f.split("/") for f in folders]
    same = next((i for i, names in enumerate(zip(*parts, strict=False)) if len(set(names)) > 1), min(map(len, parts)))
    rest = ["/".join(x[same:]) for x in parts]
    where = "/".join(parts[0][:same]) + ("" if len(folders) == 1 else "/{" + ",".join(x for x in rest if x) + "}")
    # A timestamp without zone can't carry a watermark: it is read as UTC.
    rows = spark.readStream.schema(events.schema).option("pathGlobFilter", files[0].rsplit("/", 1)[1] if len(files) == 1 else "*.parquet").option("recursiveFileLookup", str("" in rest and len(folders) > 1).lower()).parquet(where if "" not in rest else "/".join(parts[0][:same])).withColumn("ts", F.col("ts").cast("timestamp"))
    write = lambda df, batch: df.write.mode("overwrite").parquet(f"{base}/out/batch={batch}")
    q = hourly_counts(rows).writeStream.outputMode("update").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).foreachBatch(write).start()
    q.awaitTermination()
    changed = spark.read.schema("window_start timestamp, event_type string, n bigint, batch bigint").parquet(f"{base}/out")
    newest = changed.groupBy("window_start", "event_type").agg(F.max_by("n", "batch").alias("n"))
    return newest.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
