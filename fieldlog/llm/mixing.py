"""Mixing sources to target weights.

Token weights of the cells source x language x topic are raked by iterative proportional fitting to the source
targets and to the language and topic shares of the corpus, bounded by the number of times a document may be used. The
documents are then drawn with these weights by systematic sampling in the order of their size, which keeps the tokens
drawn from a source close to plan, and a few last documents are exchanged to come closer still.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlog.session import cut, small

#: Number of a language or topic that only one cell has.
ALONE = -1
ROUNDS, FIXES, UNIT, SHARES = 60, 4, 1_000_000, 64


def source_tokens(available: np.ndarray, share: np.ndarray, repeats: np.ndarray, total: float) -> np.ndarray:
    """Tokens each source gives to a mix of ``total``: its share, at most its tokens times its repeats.

    What sources at their bound can't give is shared among the others in proportion to their targets.
    """
    bound = available * repeats
    out, free, rest = np.zeros(len(share)), (bound > 0) & (share > 0), float(total)
    while free.any() and rest > 1e-9:
        want = rest * share[free] / share[free].sum()
        over = want >= bound[free]
        if not over.any():
            out[free] = want
            break
        at = np.flatnonzero(free)[over]
        out[at] = bound[at]
        rest -= bound[at].sum()
        free[at] = False
    return out


def rake(cells: pd.DataFrame, targets: pd.DataFrame, total: float) -> pd.DataFrame:
    """Uses per token of each cell. ``cells``: source, lang, topic, tokens; ``targets``: source, target_share, max_repeats."""
    cells = cells.merge(targets, on="source", how="left")
    t = cells["tokens"].to_numpy(float)
    repeats, share = cells["max_repeats"].fillna(0).to_numpy(float), cells["target_share"].fillna(0).to_numpy(float)
    repeats = np.where(share > 0, repeats, 0)
    if not len(cells):
        return cells.assign(weight=[])
    goal = targets.merge(cells.groupby("source", as_index=False)["tokens"].sum(), on="source", how="left").fillna({"tokens": 0})
    goal["goal"] = source_tokens(goal["tokens"].to_numpy(float), goal["target_share"].to_numpy(float), goal["max_repeats"].to_numpy(float), total)
    by_source = dict(zip(goal["source"], goal["goal"], strict=True))
    w = np.where(repeats > 0, np.minimum(1.0, repeats), 0.0)
    margins = []
    usable = repeats > 0
    for c in ("lang", "topic", "source"):
        code, names = pd.factorize(cells[c], use_na_sentinel=False)
        if c == "source":
            want = np.array([by_source.get(x, 0.0) for x in names])
        else:  # the corpus's own shares, over what can be drawn from at all
            want = np.bincount(code, t * usable, len(names))
            want = want / max(want.sum(), 1e-9) * sum(by_source.values())
        margins.append((code, want))
    for _ in range(ROUNDS):
        before = w.copy()
        for code, want in margins:
            have = np.bincount(code, w * t, len(want))
            w = np.minimum(w * np.divide(want, have, out=np.ones(len(want)), where=have > 0)[code], repeats)
        for _again in range(20):  # cells at their bound leave the rest of a source to its other cells
            code, want = margins[-1]
            held = w >= repeats - 1e-12
            have, fixed = np.bincount(code, w * t, len(want)), np.bincount(code, w * t * held, len(want))
            scale = np.divide(want - fixed, have - fixed, out=np.ones(len(want)), where=have - fixed > 1e-9)
            w = np.where(held, w, np.minimum(w * np.maximum(scale[code], 0), repeats))
            if np.abs(scale - 1).max() < 1e-12:
                break
        if np.abs(w - before).max() < 1e-7:
            break
    return cells.assign(weight=w)


def shared_kinds(cells: DataFrame, kind: str) -> DataFrame:
    """The languages or topics of more than one cell, numbered in their order: ``kind``, ``kind``_no."""
    shared = cells.groupBy(kind).agg(F.count("*").alias("n")).where("n > 1").select(kind).orderBy(kind)
    return cut(shared.withColumn(f"{kind}_no", F.monotonically_increasing_id()))


def told_apart(coded: DataFrame) -> pd.DataFrame:
    """The cells as ``rake`` tells them apart: source, lang_no, topic_no, tokens, lang, topic.

    A language or topic of one cell only asks for its own share of that cell, whatever its size. The cells of a source that
    differ in nothing else thus get the same weight in every round and are added up before they reach the driver.
    """
    rows = coded.groupBy("source", "lang_no", "topic_no").agg(F.sum("tokens").cast("double").alias("tokens"))
    rows = rows.toArrow().to_pandas().sort_values(["source", "lang_no", "topic_no"], ignore_index=True)
    own = -1 - np.arange(len(rows))
    return rows.assign(**{c: np.where(rows[f"{c}_no"] == ALONE, own, rows[f"{c}_no"]) for c in ("lang", "topic")})


def mix(documents: DataFrame, targets: DataFrame) -> DataFrame:
    """The uses of every document: doc_id, source, n_tokens, uses.

    ``documents``: doc_id, source, lang, topic, n_tokens; ``targets``: source, target_share, max_repeats. The mix is as
    large as the corpus where the bounds allow. Sources without target, and documents without tokens, are used 0
    times; a target without documents stays unfilled; null languages and topics are kinds of their own; of several rows of a document the least counts; empty documents give an empty mix.
    """
    base = documents.select("doc_id", "source", "lang", "topic", F.coalesce("n_tokens", F.lit(0)).cast("bigint").alias("n_tokens")).groupBy("doc_id").agg(F.min(F.struct("source", "lang", "topic", "n_tokens")).alias("x")).select("doc_id", "x.*")
    base = cut(base.withColumns({c: F.coalesce(c, F.lit("\0")) for c in ("lang", "topic")}))
    # The list of targets is the reader's own small table; a target named twice counts with its greatest values.
    goals = targets.where("source IS NOT NULL").groupBy("source").agg(F.max("target_share").cast("double").alias("target_share"), F.max("max_repeats").cast("int").alias("max_repeats"))
    wanted = goals.toPandas().fillna(0)
    cells = cut(base.where("n_tokens > 0").join(small(goals.where("target_share > 0 AND max_repeats > 0")), "source").groupBy("source", "lang", "topic").agg(F.sum("n_tokens").alias("tokens")))
    coded = cells.join(small(shared_kinds(cells, "lang")), "lang", "left").join(small(shared_kinds(cells, "topic")), "topic", "left").fillna(ALONE, ["lang_no", "topic_no"])
    weighted = rake(told_apart(coded), wanted, float(base.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n")).first()["n"]))
    spark = documents.sparkSession
    rows = pa.table({"source": pa.array(weighted["source"], pa.string()), "lang_no": pa.array(weighted["lang_no"], pa.int64()), "topic_no": pa.array(weighted["topic_no"], pa.int64()), "w": pa.array(np.rint(weighted["weight"].to_numpy(float) * UNIT).astype("int64"))})
    weights = cut(coded.join(small(spark.createDataFrame(rows)), ["source", "lang_no", "topic_no"]).select("source", "lang", "topic", "w"))
    drawn = base.join(small(weights), ["source", "lang", "topic"], "left").join(small(goals), "source", "left").withColumn("w", F.when(F.col("n_tokens") > 0, F.coalesce("w", F.lit(0))).otherwise(0))

    # Systematic sampling along each source's documents in the order of size; running sums in whole units.
    dealt = drawn.withColumn("share", F.pmod(F.xxhash64("doc_id"), F.lit(SHARES)))
    sums = dealt.groupBy("source", "n_tokens", "share").agg(F.sum("w").alias("s"))
    sums = sums.selectExpr("source AS s_source", "n_tokens AS s_n", "share AS s_share", "coalesce(sum(s) over (partition by source order by n_tokens desc, share rows between unbounded preceding and 1 preceding), 0) as before")
    inner = dealt.selectExpr("*", "sum(w) over (partition by source, n_tokens, share order by xxhash64(doc_id, 1), doc_id rows unbounded preceding) as upto")
    inner = inner.join(sums, (F.col("source").eqNullSafe(F.col("s_source"))) & (F.col("n_tokens") == F.col("s_n")) & (F.col("share") == F.col("s_share")))
    start = F.pmod(F.xxhash64(F.coalesce("source", F.lit(""))), F.lit(UNIT))
    whole = lambda x: F.floor((x + start) / F.lit(UNIT).cast("decimal(20,0)")).cast("int")
    end = F.col("before") + F.col("upto")
    drawn = cut(inner.select("doc_id", "source", "n_tokens", F.coalesce("max_repeats", F.lit(0)).alias("max_repeats"), (F.col("w") > 0).alias("usable"), (whole(end) - whole(end - F.col("w"))).alias("uses")))

    plan = weighted.assign(goal=weighted["weight"] * weighted["tokens"]).groupby("source", as_index=False)["goal"].sum() if len(weighted) else pd.DataFrame({"source": [], "goal": []})
    goal = spark.createDataFrame([(s, float(g)) for s, g in zip(plan["source"], plan["goal"], strict=True)], "source string, goal double")
    for _ in range(FIXES):
        # One document more or one less per source, where that brings its tokens closer to plan.
        off = cut(drawn.groupBy("source").agg(F.sum(F.col("uses") * F.col("n_tokens")).alias("have")).join(small(goal), "source").withColumn("r", F.col("goal") - F.col("have")))
        near = drawn.join(small(off.select("source", "r")), "source").withColumn("d", F.when((F.col("r") > 0) & (F.col("uses") < F.col("max_repeats")), 1).when((F.col("r") < 0) & (F.col("uses") > 0), -1)).where("d IS NOT NULL AND usable AND n_tokens > 0")
        near = near.withColumn("gap", F.abs(F.col("r") - F.col("d") * F.col("n_tokens"))).where("gap < abs(r)")
        chosen = cut(near.groupBy("source").agg(F.min(F.struct("gap", "doc_id", "d")).alias("x")).select(F.col("x.doc_id").alias("doc_id"), F.col("x.d").alias("d")))
        drawn = cut(drawn.join(small(chosen), "doc_id", "left").withColumn("uses", F.col("uses") + F.coalesce("d", F.lit(0))).drop("d"))
    return drawn.select("doc_id", "source", "n_tokens", "uses")


def share_report(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source the tokens drawn, the share reached beside the target, and the greatest use of a document."""
    per = mixed.groupBy("source").agg(F.sum(F.col("uses") * F.col("n_tokens")).alias("tokens"), F.count_if(F.col("uses") > 0).alias("documents"), F.max("uses").alias("most_uses"))
    total = per.agg(F.sum("tokens").alias("all_tokens"))
    joined = per.join(F.broadcast(targets.groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))), "source", "full_outer").join(F.broadcast(total))
    return joined.select("source", F.coalesce("target_share", F.lit(0.0)).alias("target_share"), F.coalesce(F.col("tokens") / F.nullif("all_tokens", F.lit(0)), F.lit(0.0)).alias("reached_share"), F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("most_uses", F.lit(0)).alias("most_uses"), "max_repeats")


def margin_report(mixed: DataFrame, documents: DataFrame) -> DataFrame:
    """Share of the tokens of every language and topic in the corpus and in the mix: kind, value, corpus_share, reached_share.

    ``documents``: doc_id, lang, topic, n_tokens. The mix is raked to the corpus's shares over what can be drawn from, so
    sources without target and bounded ones shift what is reached.
    """
    rows = documents.groupBy("doc_id").agg(F.min(F.struct("lang", "topic", F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"))).alias("x")).select("doc_id", "x.*").join(mixed.select("doc_id", "uses"), "doc_id", "left")
    long = rows.select(F.col("n_tokens").alias("n"), (F.col("n_tokens") * F.coalesce("uses", F.lit(0))).alias("m"), F.expr("stack(2, 'lang', lang, 'topic', topic) AS (kind, value)"))
    sums = long.groupBy("kind", "value").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    # One row for each of the two kinds.
    total = F.broadcast(sums.groupBy("kind").agg(F.sum("n").alias("all_n"), F.sum("m").alias("all_m")))
    share = lambda a, b: F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))
    return sums.join(total, "kind").select("kind", "value", share("n", "all_n").alias("corpus_share"), share("m", "all_m").alias("reached_share"))
