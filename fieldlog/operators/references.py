"""References to records that do not exist.

Keys are dictionary-encoded as integers within a period, cut into ranges; every (reference, run, range) and every
(parent, run, range) becomes one compressed bitmap. A reference's bitmap AND NOT that of the parent run it belongs to
leaves the dangling keys, the same with the union of later and of earlier parent bitmaps tells what became of them,
and only the surviving bits are decoded through the dictionary.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlog.session import small, spread

#: Keys a range is meant to hold; a period with more distinct keys is cut into more ranges by hash.
RANGE_KEYS = 16_384
#: Shares into which the runs of a parent without periods are dealt, so that no task gets all of them.
STATIC_SHARES = 32
#: Period of the dictionary of a parent that isn't delivered by period.
STATIC = "*"


def pack(bits: np.ndarray) -> bytes:
    """Sorted distinct positions as a container: 'a' and 16-bit (or 'w' and 32-bit) positions, or 'b' and a bitset."""
    if not len(bits):
        return b"a"
    if len(bits) * 16 < bits[-1] + 1:
        return b"a" + bits.astype("<u2").tobytes() if bits[-1] < 65_536 else b"w" + bits.astype("<u4").tobytes()
    full = np.zeros(int(bits[-1]) + 1, bool)
    full[bits] = True
    return b"b" + np.packbits(full, bitorder="little").tobytes()


def unpack(box: bytes, width: int = 0) -> np.ndarray:
    """The container as a bitset of at least ``width`` bytes."""
    if box[:1] == b"b":
        out = np.frombuffer(box, np.uint8, offset=1)
        return out if len(out) >= width else np.concatenate([out, np.zeros(width - len(out), np.uint8)])
    at = np.frombuffer(box, "<u2" if box[:1] == b"a" else "<u4", offset=1).astype(np.int64)
    n = max(width, int(at[-1]) // 8 + 1 if len(at) else 0)
    full = np.zeros(n * 8, bool)
    full[at] = True
    return np.packbits(full, bitorder="little")


def positions(bits: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bits, bitorder="little"))


def _boxes(col: pd.Series) -> pd.Series:
    return pd.Series([pack(np.unique(np.asarray(x, np.int64))) for x in col])


KINDS = np.array(["late", "deleted", "missing"])


def _and_not(key: tuple, boxes: pd.DataFrame) -> pd.DataFrame:
    """Dangling keys of one range: reference AND NOT parent of the run sought in, told apart by later and earlier parents."""
    parents, refs = boxes[boxes["ref_name"].isna()], boxes[boxes["ref_name"].notna()]
    width = max([1, *(len(unpack(x)) for x in refs["box"]), *(len(unpack(x)) for x in parents["box"])])
    parents = parents.sort_values("ord")
    orders, n = parents["ord"].to_numpy(), len(parents)
    have = np.stack([unpack(x, width) for x in parents["box"]]) if n else np.zeros((0, width), np.uint8)
    none = np.zeros((1, width), np.uint8)
    before = np.concatenate([none, np.bitwise_or.accumulate(have, axis=0)]) if n else none
    after = np.concatenate([np.bitwise_or.accumulate(have[::-1], axis=0)[::-1], none]) if n else none
    out: list[tuple] = []
    for name, run, seek, box in zip(refs["ref_name"], refs["run_id"], refs["seek"], refs["box"], strict=True):
        lo, hi = np.searchsorted(orders, seek, "left"), np.searchsorted(orders, seek, "right")
        left = unpack(box, width)
        if hi > lo:
            left = left & ~np.bitwise_or.reduce(have[lo:hi], axis=0)
        if not left.any():
            continue
        late = left & after[hi]
        gone = left & ~late & before[lo]
        for kind, bits in zip(KINDS, (late, gone, left & ~late & ~gone), strict=True):
            if bits.any():
                out.append((name, run, key[1], key[2], kind, positions(bits).astype(np.int32)))
    return pd.DataFrame(out, columns=["ref_name", "run_id", "period", "rng", "kind", "pos"])


def dangling(refs: DataFrame, parents: DataFrame, range_keys: int = RANGE_KEYS) -> DataFrame:
    """References without parent: ref_name, run_id, ref_value, kind, one row each.

    ``refs``: ref_name (of one parent each), parent_name, season, run_id, seek, value. ``parents``: parent_name, season (null for a parent
    that isn't delivered by period), ord, value. A value is sought among its season's parent rows whose ord equals
    seek; where there are none, all are missing from it. kind: ``late`` if a parent row of a greater ord has the
    value, else ``deleted`` if one of a smaller ord has it, else ``missing``. Values are trimmed and put in lower
    case; null and blank ones are no references. Repeated rows count once; other columns are ignored; an empty
    parent leaves all references dangling, empty references give an empty result.
    """
    value = F.lower(F.trim(F.col("value"))).alias("value")
    parents = parents.select("parent_name", F.coalesce("season", F.lit(STATIC)).alias("period"), "ord", value).where("value <> ''").distinct()
    static = [r[0] for r in parents.where(F.col("period") == STATIC).select("parent_name").distinct().collect()]  # names of tables: a handful
    refs = (
        refs.select("ref_name", "parent_name", F.when(F.col("parent_name").isin(static), STATIC).otherwise(F.col("season")).alias("period"), "run_id", F.col("seek").cast("int"), value)
        .where("value <> ''")
        .distinct()
    )
    both = refs.select("*", F.lit(None).cast("int").alias("ord")).unionByName(parents.select(F.lit(None).cast("string").alias("ref_name"), "*", F.lit(None).cast("string").alias("run_id"), F.lit(None).cast("int").alias("seek")))

    keys = both.select("period", "value").distinct()
    ranges = keys.groupBy("period").agg(F.ceil(F.count("*") / range_keys).cast("int").alias("n"))
    coded = keys.join(ranges, "period").withColumn("rng", F.pmod(F.xxhash64("value"), F.col("n")).cast("int"))
    coded = coded.selectExpr("period", "value", "rng", "row_number() over (partition by period, rng order by value) - 1 as pos")

    boxed = both.join(coded, ["period", "value"]).groupBy("parent_name", "period", "rng", "ref_name", "run_id", "seek", "ord").agg(F.collect_list("pos").alias("at"))
    boxed = boxed.withColumn("box", F.pandas_udf(_boxes, "binary")("at")).drop("at")
    fixed = F.col("period") == STATIC
    one = F.pmod(F.xxhash64("run_id"), F.lit(STATIC_SHARES)).cast("int")
    shares = F.when(~fixed, F.array(F.lit(0))).when(F.col("ref_name").isNotNull(), F.array(one)).otherwise(F.sequence(F.lit(0), F.lit(STATIC_SHARES - 1)))
    boxed = boxed.withColumn("share", F.explode(shares))
    on = ["parent_name", "period", "rng", "share"]
    found = spread(boxed, *on).groupBy(*on).applyInPandas(_and_not, "ref_name string, run_id string, period string, rng int, kind string, pos array<int>")
    found = found.withColumn("pos", F.explode("pos"))
    back = coded.select(F.col("period").alias("__p"), F.col("rng").alias("__r"), F.col("pos").alias("__at"), "value")
    found = found.join(back, (F.col("period") == F.col("__p")) & (F.col("rng") == F.col("__r")) & (F.col("pos") == F.col("__at")))
    return found.select("ref_name", "run_id", F.col("value").alias("ref_value"), "kind")


def dangling_report(found: DataFrame, runs: DataFrame) -> DataFrame:
    """Dangling values counted per reference, season and kind. ``runs``: run_id, season."""
    return found.join(small(runs.select("run_id", "season").distinct()), "run_id").groupBy("ref_name", "season", "kind").agg(F.count("*").alias("dangling"), F.countDistinct("run_id").alias("runs"))
