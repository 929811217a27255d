"""Containers and mixes against their bounds and brute force."""

import itertools
import random

import numpy as np
import pandas as pd
import pytest

from fieldlog.llm.mixing import mix, rake, share_report, source_tokens
from fieldlog.llm.packing import Filling, fill_report, n_tokens, pack, plan, reduce, token_counts

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def filled(sizes, capacity):
    runs, n = plan(sizes, capacity)
    used, ranks = {}, {}
    for s, lo, hi, first, each in runs:
        ranks.setdefault(s, []).extend(range(lo, hi))
        for k in range(hi - lo):
            used[first + k // each] = used.get(first + k // each, 0) + s
    assert {s: sorted(r) for s, r in ranks.items()} == {s: list(range(c)) for s, c in sizes.items() if c}
    assert len(used) == n
    assert not used or max(used.values()) <= capacity
    return n


def least(items, capacity):
    """Fewest containers, by trying all ways."""
    best = len(items)

    def go(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(items):
            best = len(bins)
            return
        for i in {b: i for i, b in enumerate(bins)}.values():
            if bins[i] + items[k] <= capacity:
                go(k + 1, bins[:i] + [bins[i] + items[k]] + bins[i + 1 :])
        go(k + 1, bins + [items[k]])

    go(0, [])
    return best


def test_reduction_goes_on_after_a_size_without_rule():
    # Three small items fit beside 90, so no rule holds for it; 60 and 40 fill a container all the same.
    filling = Filling(100)
    assert reduce({90: 2, 60: 5, 40: 5, 3: 3}, 100, filling) == {90: 2, 3: 3}
    assert filling.n == 5


def test_reduction_never_costs_a_container():
    draw = random.Random(8)
    for _ in range(400):
        capacity = draw.randint(10, 30)
        items = [draw.randint(1, capacity - 1) for _ in range(draw.randint(1, 8))]
        filling = Filling(capacity)
        sizes = {k: items.count(k) for k in items}
        rest = reduce(sizes, capacity, filling)
        assert filling.n + least([k for k, n in rest.items() for _ in range(n)], capacity) <= least(items, capacity), (capacity, items)


def test_many_like_items_are_reduced_at_once():
    # Two of 20 fit beside 54, but 45 fills the rest better.
    filling = Filling(100)
    assert reduce({54: 300_000, 45: 300_000, 20: 3}, 100, filling) == {20: 3}
    assert filling.n == 300_000
    assert len(filling.runs) < 50


def test_plan_is_valid_and_near_the_optimum():
    rng, over = random.Random(5), 0
    for _ in range(150):
        items = sorted((rng.randint(1, 20) for _ in range(rng.randint(0, 9))), reverse=True)
        sizes = {s: items.count(s) for s in set(items)}
        n = filled(sizes, 20)
        over += n - least(items, 20)
    assert over <= 3


def test_large_plan_reaches_the_bound():
    s = np.clip(np.exp(np.random.default_rng(0).normal(4.6, 1, 50_000)).astype(int), 1, 2048)
    u, c = np.unique(s, return_counts=True)
    assert filled(dict(zip(u.tolist(), c.tolist(), strict=True)), 2048) <= -(-int(s.sum()) // 2048) + 2


def test_pack(spark):
    rows = [(1, 5000), (2, 0), (3, None), (4, 2048), (5, 100), (6, 100), (7, 1)]
    df = spark.createDataFrame([(*r, 9, 9) for r in rows], "doc_id bigint, n_tokens bigint, size int, rank int")
    got = pack(df, "doc_id").collect()
    per = {}
    for r in got:
        per[r["container_id"]] = per.get(r["container_id"], 0) + r["n_tokens"]
    assert max(per.values()) <= 2048
    assert sorted((r["doc_id"], r["piece_no"], r["n_tokens"]) for r in got) == [(1, 0, 2048), (1, 1, 2048), (1, 2, 904), (2, 0, 0), (3, 0, 0), (4, 0, 2048), (5, 0, 100), (6, 0, 100), (7, 0, 1)]
    f = fill_report(pack(df, "doc_id")).first()
    assert (f["n_containers"], f["least_containers"]) == (4, 4)
    assert pack(df.limit(0), "doc_id").collect() == []
    assert fill_report(pack(df.limit(0), "doc_id")).first()["fill"] is None


def test_tokens_of_long_and_odd_texts(spark):
    pytest.importorskip("public_tokenizers")
    word = "play " * 30_000
    assert abs(n_tokens(word, TOKENIZER) - 30_000) <= 10
    assert n_tokens("x" * 50_000, TOKENIZER) > 1000
    assert n_tokens("<|endoftext|> \ud800", TOKENIZER) > 1
    df = spark.createDataFrame([(1, None), (2, ""), (3, "one two")], "doc_id bigint, text string")
    assert [r["n_tokens"] for r in token_counts(df, "doc_id", []).orderBy("doc_id").collect()] == [0, 0, 2]


def test_source_tokens_and_raking():
    got = source_tokens(np.array([100.0, 10.0, 0.0]), np.array([0.5, 0.3, 0.2]), np.array([1, 2, 5]), 100.0)
    assert got.tolist() == [80.0, 20.0, 0.0]
    cells = pd.DataFrame(list(itertools.product("ab", ["en", "es"], ["x", "y"])), columns=["source", "lang", "topic"]).assign(tokens=[100.0, 50, 30, 20, 200, 100, 60, 40])
    out = rake(cells, pd.DataFrame({"source": ["a", "b"], "target_share": [0.5, 0.5], "max_repeats": [3, 1]}), 600.0)
    t = out["tokens"] * out["weight"]
    assert abs(t[out["source"] == "a"].sum() - 300) < 1e-3
    assert abs(t[out["lang"] == "en"].sum() - 450) < 3
    assert (out["weight"] <= out["max_repeats"] + 1e-9).all()


def test_mix(spark):
    rng = random.Random(1)
    docs = [(i, rng.choice("aaab"), "en", None, rng.randint(1, 200), 7) for i in range(800)] + [(900, "z", None, "t", 50, 7), (901, "a", "en", None, None, 7), (902, None, "en", None, 10, 7)]
    df = spark.createDataFrame(docs + docs[:30], "doc_id bigint, source string, lang string, topic string, n_tokens bigint, w int")
    targets = spark.createDataFrame([("a", 0.6, 1), ("b", 0.38, 3), ("none", 0.02, 2)], "source string, target_share double, max_repeats int")
    m = mix(df, targets)
    rows = {r["doc_id"]: r for r in m.collect()}
    assert len(rows) == len(docs)
    assert rows[900]["uses"] == rows[901]["uses"] == rows[902]["uses"] == 0
    assert all(0 <= r["uses"] <= {"a": 1, "b": 3}.get(r["source"], 0) for r in rows.values())
    total = sum(r["uses"] * (r["n_tokens"] or 0) for r in rows.values())
    shares = {r["source"]: r["reached_share"] for r in share_report(m, targets).collect()}
    assert abs(total - sum(d[4] or 0 for d in docs)) < 30
    assert abs(shares["a"] - 0.6 / 0.98) < 0.002
    assert shares["none"] == 0
    assert mix(df.limit(0), targets).collect() == []
    assert {r["uses"] for r in mix(df, targets.limit(0)).collect()} == {0}


def test_long_texts_count_as_a_whole(monkeypatch):
    """Piecewise counting gives the count of the whole text, with runs of blanks and words longer than a piece too."""
    import random

    from fieldlog.llm import packing

    rng = random.Random(4)
    texts = [" ".join("".join(rng.choice("abcdé1' ") for _ in range(rng.randint(1, 60))) for _ in range(200)), "x" * 3000 + " tail " + "y" * 2000, "  \n ".join(["word"] * 900)]
    whole = [len(packing.encoder(packing.TOKENIZER).encode_ordinary(t)) for t in texts]
    monkeypatch.setattr(packing, "CHUNK", 500)
    assert [packing.n_tokens(t, packing.TOKENIZER) for t in texts] == whole


def test_margins(spark):
    from fieldlog.llm.mixing import margin_report

    docs = spark.createDataFrame([(1, "en", "a", 30), (1, "en", "a", 30), (2, "es", None, 10), (3, None, "a", None)], "doc_id bigint, lang string, topic string, n_tokens bigint")
    mixed = spark.createDataFrame([(1, 1), (2, 3)], "doc_id bigint, uses int")
    got = {(r["kind"], r["value"]): (r["corpus_share"], r["reached_share"]) for r in margin_report(mixed, docs).collect()}
    assert got == {("lang", "en"): (0.75, 0.5), ("lang", "es"): (0.25, 0.5), ("lang", None): (0.0, 0.0), ("topic", "a"): (0.75, 0.5), ("topic", None): (0.25, 0.5)}


def test_mix_does_not_depend_on_the_number_of_topics_and_languages(spark):
    rng = random.Random(3)
    docs = [(i, rng.choice("aab"), f"l{rng.randint(1, 30)}", f"t{rng.randint(1, 200)}", rng.randint(1, 200)) for i in range(1500)]
    more = [(10_000 + i, "z", f"m{i % 60}", f"u{i}", 0) for i in range(2100)]  # without tokens or target they take no part
    targets = spark.createDataFrame([("a", 0.4, 2), ("b", 0.6, 3)], "source string, target_share double, max_repeats int")
    one, other = ({r["doc_id"]: r["uses"] for r in mix(spark.createDataFrame(d, "doc_id bigint, source string, lang string, topic string, n_tokens bigint"), targets).collect()} for d in (docs, docs + more))
    assert {i: other[i] for i in one} == one
    assert {other[r[0]] for r in more} == {0}


def test_cells_added_up_get_the_weights_of_each(spark):
    from fieldlog.llm.mixing import shared_kinds, told_apart

    rng = random.Random(6)
    draw = lambda kind, n: f"{kind}{rng.randint(1, 5)}" if rng.random() < 0.5 else f"{kind}-{n}"
    rows = [(rng.choice("abc"), draw("l", i), draw("t", i), float(rng.randint(1, 90))) for i in range(300)]
    cells = pd.DataFrame(rows, columns=["source", "lang", "topic", "tokens"]).groupby(["source", "lang", "topic"], as_index=False).sum()
    targets = pd.DataFrame({"source": ["a", "b", "c"], "target_share": [0.2, 0.6, 0.2], "max_repeats": [3, 1, 4]})
    want = rake(cells, targets, cells["tokens"].sum()).set_index(["source", "lang", "topic"])["weight"]
    df = spark.createDataFrame(cells)
    coded = df.join(shared_kinds(df, "lang"), "lang", "left").join(shared_kinds(df, "topic"), "topic", "left").fillna(-1, ["lang_no", "topic_no"])
    few = told_apart(coded)
    assert len(few) < 150 < len(cells)
    got = coded.toPandas().merge(rake(few, targets, cells["tokens"].sum())[["source", "lang_no", "topic_no", "weight"]], on=["source", "lang_no", "topic_no"])
    assert len(got) == len(cells)
    assert max(abs(want[r.source, r.lang, r.topic] - r.weight) for r in got.itertuples()) < 1e-9
