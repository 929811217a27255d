"""Filling containers of fixed capacity with items of varying length.

Items are counted by size, so the packing itself works on a histogram with at most as many entries as the capacity,
whatever the number of items. On it the Martello-Toth dominance criterion fixes sets of up to three items that no
optimal filling can do better without; best fit in decreasing order places the rest. The result is a short list of
runs (size, ranks, containers), against which every item is placed by its rank among the items of its size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlog.session import cut

CAPACITY = 2048
#: The public vocabulary with which tokens are counted.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Characters given to the tokenizer at once, and those up to the next blank between two words.
CHUNK = 20_000
#: Shares into which the items of one size are dealt before they are ranked.
SHARES = 64


@lru_cache(2)
def encoder(path: str):  # noqa: ANN201
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


#: A blank between two words: no token of the vocabulary's pattern reaches across it.
APART = re.compile(r"(?<=\S) (?=\S)")


def n_tokens(text: str | None, path: str) -> int:
    """Tokens of a whole text; a longer one is encoded piece by piece, cut only where no token can reach across."""
    if not text:
        return 0
    e, at, n = encoder(path), 0, 0
    while at < len(text):
        gap = APART.search(text, at + CHUNK) if len(text) - at > CHUNK else None
        end = gap.start() if gap else len(text)
        n += len(e.encode_ordinary(text[at:end].encode("utf-8", "replace").decode("utf-8")))
        at = end
    return n


def token_counts(documents: DataFrame, key: str, keep: list[str], path: str = TOKENIZER) -> DataFrame:
    """key, the columns of ``keep`` and n_tokens of ``text``; null and empty texts have none."""

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series([n_tokens(t, path) for t in b], dtype="int64")

    return documents.select(key, *keep, F.pandas_udf(count, "bigint")("text").alias("n_tokens"))


class Filling:
    """Containers of like content as they are filled: (first container, how many, space left)."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.n, self.runs = capacity, 0, []
        self.open: dict[int, list[tuple[int, int]]] = {}
        self.rank: dict[int, int] = {}

    def put(self, size: int, first: int, count: int, each: int = 1) -> None:
        """``each`` items of one size into each of ``count`` containers from ``first`` on."""
        at = self.rank.get(size, 0)
        self.runs.append((size, at, at + count * each, first, each))
        self.rank[size] = at + count * each

    def take_new(self, count: int) -> int:
        self.n += count
        return self.n - count

    def keep(self, left: int, first: int, count: int) -> None:
        if left > 0 and count > 0:
            self.open.setdefault(left, []).append((first, count))


def reduce(sizes: dict[int, int], capacity: int, filling: Filling) -> dict[int, int]:
    """Martello-Toth reduction: fixes dominating sets and returns the items left.

    For each size j, the largest first: if no item fits beside it, it is alone; if at most one fits, it takes the largest that
    does; if at most two fit and the largest single i that fits is at least as large as the best pair together, it
    takes i; if the best pair fills the container and no other single or pair has a larger member, it takes the pair. A size to which no rule
    applies is left and stays among what may go with smaller ones.
    """
    left = dict(sizes)
    for j in sorted(sizes, reverse=True):
        while left.get(j, 0):
            order = sorted(k for k, n in left.items() if n and (k != j or n > 1))
            space = capacity - j
            small: list[int] = []
            for k in order:  # the three smallest others, with repeats
                small += [k] * min(3 - len(small), left[k] - (k == j))
                if len(small) == 3:
                    break
            fit = 0
            used = 0
            for k in small:
                if used + k <= space:
                    used += k
                    fit += 1
            if fit == 0:
                n = left[j]
                filling.put(j, f := filling.take_new(n), n)
                filling.keep(space, f, n)
                left[j] = 0
                break
            best = max(k for k in order if k <= space)
            if fit == 1 or best == space:
                n = min(left[best], left[j]) if best != j else left[j] // 2
                if n == 0:
                    break
                f = filling.take_new(n)
                filling.put(j, f, n, 2 if best == j else 1)
                if best != j:
                    filling.put(best, f, n)
                    left[best] -= n
                filling.keep(space - best, f, n)
                left[j] -= n * (2 if best == j else 1)
                continue
            if fit == 2:
                pair = best_pair(left, j, space, order)
                if pair is None or best >= sum(pair):
                    n = alike(left, (j, best))
                    f = filling.take_new(n)
                    filling.put(j, f, n, 2 if best == j else 1)
                    if best != j:
                        filling.put(best, f, n)
                        left[best] -= n
                    filling.keep(space - best, f, n)
                    left[j] -= n * (2 if best == j else 1)
                    continue
                a, b = pair
                halves = max((k for k in order if 2 * k <= space), default=0)
                if sum(pair) == space and best <= max(pair) and halves <= min(pair):
                    n = alike(left, (j, a, b))
                    f = filling.take_new(n)
                    for k in dict.fromkeys((j, a, b)):
                        filling.put(k, f, n, (j, a, b).count(k))
                        left[k] -= n * (j, a, b).count(k)
                    continue
            break  # no rule for this size: its items stay among the others of smaller ones
    return {k: n for k, n in left.items() if n}


def alike(left: dict[int, int], members: tuple[int, ...]) -> int:
    """How many containers of these members surely follow one another: as long as four more of each size are left, no rule sees a difference."""
    return max(1, min((left[k] - 4) // members.count(k) for k in members))


def best_pair(left: dict[int, int], j: int, space: int, order: list[int]) -> tuple[int, int] | None:
    """Two other items that fill the space best."""
    best, found, lo, hi = -1, None, 0, len(order) - 1
    count = lambda k: left[k] - (k == j)
    while lo <= hi:
        a, b = order[lo], order[hi]
        if a + b <= space:
            if a + b > best and (lo != hi or count(a) > 1):
                best, found = a + b, (a, b)
            lo += 1
        else:
            hi -= 1
    return found


def best_fit(sizes: dict[int, int], capacity: int, filling: Filling) -> None:
    """Best fit in decreasing order over counted sizes: like items go into like containers at once."""
    import bisect

    spaces = sorted(k for k, v in filling.open.items() if v)
    for size in sorted(sizes, reverse=True):
        n = sizes[size]
        while n:
            k = bisect.bisect_left(spaces, size)
            if k < len(spaces):
                space = spaces[k]
                first, count = filling.open[space].pop()
                if not filling.open[space]:
                    spaces.pop(k)
            else:
                space, count = capacity, -(-n // (capacity // size))
                first = filling.take_new(count)
            each = space // size
            whole = min(count, n // each)
            rest = n - whole * each
            if whole:
                filling.put(size, first, whole, each)
                if space - each * size > 0:
                    filling.keep(space - each * size, first, whole)
                    if len(filling.open[space - each * size]) == 1:
                        bisect.insort(spaces, space - each * size)
                n -= whole * each
            if whole < count:
                over = first + whole
                if rest and rest < each:
                    filling.put(size, over, 1, rest)
                    n -= rest
                    s = space - rest * size
                    filling.keep(s, over, 1)
                    if len(filling.open[s]) == 1:
                        bisect.insort(spaces, s)
                    over += 1
                if over < first + count:
                    filling.keep(space, over, first + count - over)
                    if len(filling.open[space]) == 1:
                        bisect.insort(spaces, space)


def plan(sizes: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Runs (size, rank from, rank to, first container, items of the size per container) and the number of containers."""
    filling = Filling(capacity)
    full = sizes.get(capacity, 0)
    if full:
        filling.put(capacity, filling.take_new(full), full)
    rest = reduce({k: n for k, n in sizes.items() if 0 < k < capacity and n}, capacity, filling)
    best_fit(rest, capacity, filling)
    return filling.runs, filling.n


def ranked(items: DataFrame, key: list[str]) -> DataFrame:
    """Items with their rank (from 0) among the items of their size, without bringing a size into one task.

    Items of one size are dealt into shares by hash; each share is ranked by itself and shifted by the sizes of the
    shares before it.
    """
    dealt = items.withColumn("__share", F.pmod(F.xxhash64(*key), F.lit(SHARES)))
    sums = dealt.groupBy("size", "__share").agg(F.count("*").alias("n"))
    sums = sums.selectExpr("size", "__share", "coalesce(sum(n) over (partition by size order by __share rows between unbounded preceding and 1 preceding), 0) as __before")
    inner = dealt.selectExpr("*", f"row_number() over (partition by size, __share order by {', '.join(key)}) - 1 as __in")
    return inner.join(sums, ["size", "__share"]).withColumn("rank", F.col("__in") + F.col("__before")).drop("__share", "__in", "__before")


def pack(items: DataFrame, key: str, capacity: int = CAPACITY) -> DataFrame:
    """The container of every item or piece: key, piece_no, n_tokens (of the piece), container_id.

    ``items``: key, n_tokens. An item is split only if it alone exceeds the capacity, into full pieces and a rest. Items
    of no tokens (null and empty texts) take no space and go into container 0. Repeated keys are items of their own if
    their rows differ; ties in size are broken by key and piece. No item, no row.
    """
    pieces = items.select(key, F.coalesce("n_tokens", F.lit(0)).cast("bigint").alias("n"))
    pieces = pieces.withColumn("piece_no", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest((F.col("n") - 1).cast("double") / capacity, F.lit(0.0)).cast("bigint"))))
    pieces = cut(pieces.select(key, "piece_no", F.least(F.lit(capacity), F.col("n") - F.col("piece_no") * capacity).cast("int").alias("size")))
    # At most one row for each size up to the capacity reaches the driver.
    counts = {r["size"]: r["n"] for r in pieces.where("size > 0").groupBy("size").agg(F.count("*").alias("n")).collect()}
    runs, _ = plan(counts, capacity)
    table = pd.DataFrame(runs, columns=["size", "lo", "hi", "first", "each"]).astype("int64").sort_values(["size", "lo"])
    starts = {int(s): (g["lo"].to_numpy(), g["first"].to_numpy(), g["each"].to_numpy()) for s, g in table.groupby("size")}
    known = items.sparkSession.sparkContext.broadcast(starts)

    def place(size: pd.Series, rank: pd.Series) -> pd.Series:
        out = np.zeros(len(size), np.int64)
        values = size.to_numpy()
        order = np.argsort(values, kind="stable")
        edges = np.flatnonzero(np.diff(values[order], prepend=-1))
        for a, b in zip(edges, [*edges[1:], len(order)], strict=True):
            at = order[a:b]
            if values[at[0]] > 0:
                lo, first, each = known.value[int(values[at[0]])]
                r = rank.to_numpy()[at]
                k = np.searchsorted(lo, r, "right") - 1
                out[at] = first[k] + (r - lo[k]) // each[k]
        return pd.Series(out)

    return ranked(pieces, [key, "piece_no"]).select(key, F.col("piece_no").cast("int"), F.col("size").alias("n_tokens"), F.pandas_udf(place, "bigint")("size", "rank").alias("container_id"))


def fill_report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Containers, tokens, the bound below which no filling gets, and the share of space used."""
    per = packed.groupBy("container_id").agg(F.sum("n_tokens").alias("used"), F.count("*").alias("pieces"))
    total = per.agg(F.count_if(F.col("used") > 0).alias("n_containers"), F.coalesce(F.sum("used"), F.lit(0)).alias("n_tokens"), F.coalesce(F.max("used"), F.lit(0)).alias("fullest"), F.coalesce(F.sum("pieces"), F.lit(0)).alias("n_pieces"))
    return total.select("n_containers", "n_pieces", "n_tokens", F.ceil(F.col("n_tokens") / capacity).alias("least_containers"), "fullest", F.when(F.col("n_containers") > 0, F.col("n_tokens") / (F.col("n_containers") * capacity)).alias("fill"))
