"""Abusive, hateful and sexual content: a small convolutional text classifier.

Texts are normalised (markup, invisible characters, spelled-out, dotted, starred and stretched words), cut into
segments, and every segment is scored by a network of hashed word embeddings, convolutions of several widths and max
pooling, trained here in numpy on hand-written sentences and on moderators' verdicts. A document's score is that of
its worst segment; thresholds are calibrated by language on verdicts held out from training.
"""

from __future__ import annotations

import html
import random
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlog.llm import abuse_seeds as seeds

BUCKETS, DIM, WIDTHS, FILTERS = 1 << 15, 24, (1, 2, 3, 4, 5), 24
#: Words of a window; a segment with more is scored in windows that overlap by half.
WINDOW = 32
#: Bounds of what fitting reads: segments of removed and of kept documents, each so many, and hand-written sentences drawn
#: (of each at most the first 2 * WINDOW words).
SEGMENTS, DRAWN, EPOCHS = 50_000, 4_000, 4
#: Score from which a segment of a removed document is taken for abusive: some verdicts are mistaken.
AGREES = 0.5
#: Share of kept documents whose worst segment must score less than an abusive one.
CHANCE = 0.9
#: Most that one of these weighs beside a fair segment.
WEIGHT = 2.0
#: Turns in which the abusive segment of each removed document is chosen anew.
TURNS = 6

#: Cut-off where verdicts tell nothing: above one half, for abuse is rarer among documents than among training sentences.
USUAL = 0.8
#: Cut-offs among which the verdicts choose.
CUTS = np.arange(0.5, 0.96, 0.05)

LEET = str.maketrans({"@": "a", "$": "s", "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "!": "i", "+": "t"})
STARRED = sorted(
    {w for x in [*seeds.INSULTS, *seeds.FOUL, *seeds.INSULTS_ES] for w in x.split() if len(w) > 3}
    | set("fuck fucked fucker shit shitty bitches bastards assholes tits ass naked nude nudes sex porn cock dick pussy mierda puta putas verga coño chinga culo".split())
)
_INVISIBLE = re.compile("[­​-‏ -‮⁠-⁤﻿]")
_TAG = re.compile(r"<[^<>]{0,200}>")
_SPELLED = re.compile(r"(?<![^\W\d_])(?:[^\W\d_][ .*_-]{1,2}){2,}[^\W\d_](?:[ .*_-]{0,2}s)?(?![^\W\d_])")
_STRETCHED = re.compile(r"([^\W\d_])\1{2,}")
_INNER = re.compile(r"(?<=[^\W\d_])[-_.](?=[^\W\d_]{1,})")
_LEET = re.compile(r"(?=\S*[^\W\d_])[\w@$!+]*[@$0134567!+][\w@$!+]*")
_STARS = re.compile(r"(?<![\w*])[^\W\d_]+\*{2,}[^\W\d_]*(?![\w*])")
_STAR = re.compile(r"[^\W\d_]+\*[^\W\d_]+")
_END = re.compile(r"[.!?\n\r;:|]+")
_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|\d+")


def _joined(m: re.Match) -> str:
    return re.sub(r"[ .*_-]", "", m[0]) if not re.fullmatch(r"(?:[^\W\d_]\.){2,}", m[0] + ".") or len(m[0]) > 5 else m[0].replace(".", "")


def _unleet(m: re.Match) -> str:
    word = m[0]
    tail = re.search(r"[!+]+$", word)
    body = word[: tail.start()] if tail else word
    letters = sum(c.isalpha() for c in body)
    return (body.translate(LEET) if letters >= 2 and not re.fullmatch(r"\d+(?:st|nd|rd|th|s|pm|am)", body) else body) + (" " + tail[0] if tail else "")


def _unstar(m: re.Match) -> str:
    pattern = re.compile(re.sub(r"\*", ".", m[0]))
    return next((w for w in STARRED if len(w) == len(m[0]) and pattern.fullmatch(plain(w))), None) or next((w + "s" for w in STARRED if len(w) + 1 == len(m[0]) and pattern.fullmatch(plain(w) + "s")), "starred")


def plain(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def normalise(text: str) -> str:
    """Lower-case text without markup and accents in which disguised words are spelled out."""
    t = _TAG.sub(" ", html.unescape(html.unescape(text))) if "<" in text or "&" in text else text
    t = plain(_INVISIBLE.sub("", t)).lower()
    if "*" in t:
        t = _STARS.sub(_unstar, t)
    t = _SPELLED.sub(_joined, t)
    if "*" in t:
        t = _STAR.sub(_unstar, t)
    t = _LEET.sub(_unleet, t)
    t = _INNER.sub("", t)
    return _STRETCHED.sub(r"\1", t)


def bucket(word: str) -> int:
    return 1 + zlib.crc32(("9" if word[0].isdigit() else word).encode()) % (BUCKETS - 1)


_KNOWN: dict[str, int] = {}


def ids(words: list[str]) -> list[int]:
    out = []
    for w in words:
        k = _KNOWN.get(w)
        if k is None:
            k = bucket(w)
            if len(_KNOWN) < 200_000:
                _KNOWN[w] = k
        out.append(k)
    return out


def segments(text: str | None) -> list[tuple[int, ...]]:
    """Hashed words of each sentence-like piece of a text, in windows where it is long."""
    out = []
    for piece in _END.split(normalise(text or "")):
        k = ids(_WORD.findall(piece))
        if len(k) <= WINDOW:
            if k:
                out.append(tuple(k))
        else:
            out += [tuple(k[i : i + WINDOW]) for i in range(0, len(k) - WINDOW // 2, WINDOW // 2)]
    return out


SPANISH = {bucket(w) for w in "el la los las de que y en un una por con para su al del lo se no es eres te tu mi pero muy mas".split()}
ENGLISH = {bucket(w) for w in "the of and to a in is that for it on was with as at by he she they be this are you i my his her".split()}


def language(parts: list[tuple[int, ...]], given: str | None) -> str:
    """Language by function words; what the table says decides where they don't."""
    es = sum(k in SPANISH for p in parts for k in p)
    en = sum(k in ENGLISH for p in parts for k in p)
    return "es" if es > en else "en" if en > es else (given if given in ("en", "es") else "en")


def seed_sentences(rng: random.Random, n: int) -> list[tuple[str, int]]:
    pools = [(seeds.ABUSE, 1, 0.34), (seeds.ABUSE_ES, 1, 0.16), (seeds.FAIR, 0, 0.36), (seeds.FAIR_ES, 0, 0.14)]
    out = []
    fair_words = [w for w in re.sub(r"\{\w\}", " ", seeds.FAIR + seeds.FAIR_ES).split() if w not in seeds.INSULTS + seeds.FOUL + seeds.INSULTS_ES + ["shit", "ass", "crap"]]
    fair = set(fair_words)
    for text, label, share in pools:
        lines, spanish = text.strip().split("\n"), text in (seeds.ABUSE_ES, seeds.FAIR_ES)
        pick = lambda s, m: rng.choice({"n": seeds.NAMES, "c": seeds.CLUBS, "g": seeds.GROUPS_ES if s else seeds.GROUPS, "i": seeds.INSULTS_ES if s else seeds.INSULTS, "a": seeds.FOUL}[m[1]])
        for k in range(int(n * share)):
            line = re.sub(r"\{(\w)\}", lambda m: pick(spanish, m), lines[k % len(lines)])  # noqa: B023
            added = rng.choice(seeds.ADDED)
            line = f"{added} {line}" if rng.random() < 0.5 else f"{line} {added}"
            if rng.random() < 0.25:  # run on into a fair sentence
                line += " " + re.sub(r"\{(\w)\}", lambda m: pick(False, m), rng.choice(seeds.FAIR.strip().split("\n")))
            out.append((line, label))
            if label and k % 2:  # the same frame with other words is no abuse
                other = [w if w in fair else "".join(rng.choice("aeioubdglmnprst") for _ in range(rng.randint(3, 9))) for w in line.split()]
                if sum(a != b for a, b in zip(other, line.split(), strict=True)) >= 2:
                    out.append((" ".join(other), 0))
            elif not label:
                out.append((" ".join(rng.choice(fair_words) for _ in range(rng.randint(3, 14))), 0))
    return out


class Network:
    """Hashed embeddings, convolutions of several widths with ReLU, max pooling, one logistic output."""

    def __init__(self, seed: int = 7) -> None:
        r = np.random.default_rng(seed)
        self.p = {"e": (r.normal(0, 0.05, (BUCKETS, DIM))).astype(np.float32), "o": r.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32), "c": np.zeros(1, np.float32)}
        self.p["e"][0] = 0
        for w in WIDTHS:
            self.p[f"w{w}"] = r.normal(0, np.sqrt(2 / (w * DIM)), (w * DIM, FILTERS)).astype(np.float32)
            self.p[f"b{w}"] = np.zeros(FILTERS, np.float32)
        self.m = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.t = 0

    @staticmethod
    def pad(batch: list[tuple[int, ...]]) -> np.ndarray:
        x = np.zeros((len(batch), max(max(WIDTHS), max(map(len, batch)))), np.int64)
        for i, k in enumerate(batch):
            x[i, : len(k)] = k
        return x

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, list]:
        e, pooled, kept = self.p["e"][x], [], []
        n, length = x.shape
        for w in WIDTHS:
            unfolded = np.concatenate([e[:, i : length - w + 1 + i] for i in range(w)], axis=2)
            h = unfolded.reshape(-1, w * DIM) @ self.p[f"w{w}"] + self.p[f"b{w}"]
            h = h.reshape(n, length - w + 1, FILTERS)
            at = h.argmax(axis=1)
            top = np.take_along_axis(h, at[:, None], 1)[:, 0]
            pooled.append(np.maximum(top, 0))
            kept.append((unfolded, at, top > 0))
        f = np.concatenate(pooled, axis=1)
        return f @ self.p["o"] + self.p["c"][0], [f, kept]

    def step(self, batch: list[tuple[int, ...]], y: np.ndarray, weight: np.ndarray, rate: float, rng: np.random.Generator) -> float:
        x = self.pad(batch)
        x = np.where(rng.random(x.shape) < 0.05, 0, x)  # drop words
        z, (f, kept) = self.forward(x)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        d = ((p - y) * weight / len(batch)).astype(np.float32)
        g = {"o": f.T @ d + 1e-4 * self.p["o"], "c": d.sum(keepdims=True)}
        df = d[:, None] * self.p["o"]
        rows, grads = [], []
        n = len(batch)
        for j, w in enumerate(WIDTHS):
            unfolded, at, live = kept[j]
            dh = df[:, j * FILTERS : (j + 1) * FILTERS] * live
            window = np.take_along_axis(unfolded, at[:, :, None], 1)  # batch x filters x w*dim
            g[f"w{w}"] = np.einsum("nfk,nf->kf", window, dh) + 1e-5 * self.p[f"w{w}"]
            g[f"b{w}"] = dh.sum(0)
            back = (dh[:, :, None] * self.p[f"w{w}"].T[None]).reshape(n, FILTERS, w, DIM)
            for i in range(w):
                rows.append(np.take_along_axis(x, at + i, 1).ravel())
                grads.append(back[:, :, i].reshape(-1, DIM))
        self.t += 1
        fix = np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for k, v in g.items():
            self.m[k] += 0.1 * (v - self.m[k])
            self.v[k] += 0.001 * (v * v - self.v[k])
            self.p[k] -= rate * fix * self.m[k] / (np.sqrt(self.v[k]) + 1e-7)
        flat = np.concatenate(rows)
        order = np.argsort(flat, kind="stable")
        flat = flat[order]
        starts = np.flatnonzero(np.diff(flat, prepend=-1))
        at, ge = flat[starts], np.add.reduceat(np.concatenate(grads)[order], starts, axis=0)
        ge[at == 0] = 0
        self.v["e"][at] += 0.01 * (ge * ge - self.v["e"][at])
        self.p["e"][at] -= rate * ge / (np.sqrt(self.v["e"][at]) + 1e-5)
        return float(-(weight * (y * np.log(p + 1e-9) + (1 - y) * np.log(1 - p + 1e-9))).mean())

    def score(self, parts: list[tuple[int, ...]]) -> np.ndarray:
        """Probabilities; segments of like length are scored together."""
        out = np.zeros(len(parts), np.float32)
        order = sorted(range(len(parts)), key=lambda i: len(parts[i]))
        for k in range(0, len(order), 512):
            at = order[k : k + 512]
            z, _ = self.forward(self.pad([parts[i] for i in at]))
            out[at] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return out


def held_out(doc: int) -> bool:
    """One verdict in five never trains; SQL: crc32(CAST(doc_id AS STRING)) % 5 = 0."""
    return zlib.crc32(str(doc).encode()) % 5 == 0


def train(labelled: list[tuple[int, str, int, list[tuple[int, ...]]]]) -> tuple[Network, dict[str, float]]:
    """A network and thresholds by language from verdicts at hand: doc_id, language, verdict (1 remove), segments."""
    net = fit([d for d in labelled if not held_out(d[0])])
    held = [d for d in labelled if held_out(d[0])]
    return net, thresholds(Counter((d[1], int(level), d[2]) for d, level in zip(held, levels(worst(net, [d[3] for d in held])), strict=True)))


def fit(used: list[tuple[int, str, int, list[tuple[int, ...]]]]) -> Network:
    """A network. ``used``: doc_id, language, verdict (1 remove), segments.

    Which segment of a removed document is abusive isn't told: in each turn it is the one that looks worst now among those
    no kept document has, if the network agrees at all, for some verdicts are mistaken; as false choices look like what
    kept documents hold, they lose to the true ones in later turns. All segments of a
    kept document count as fair, after the first turn unless the network holds against it.
    """
    rng, draw = np.random.default_rng(11), random.Random(5)
    written = [(s, y) for text, y in seed_sentences(draw, DRAWN) if (s := tuple(k for p in segments(text) for k in p))]
    net = Network()

    def run(data: list[tuple[tuple[int, ...], float, float]], epochs: int, rate: float) -> None:
        for k in range(epochs):
            order = rng.permutation(len(data))
            for i in range(0, len(order), 64):
                part = [data[j] for j in order[i : i + 64]]
                net.step([p[0][: 2 * WINDOW] for p in part], np.array([p[1] for p in part], np.float32), np.array([p[2] for p in part], np.float32), rate * 0.7**k, rng)

    base = [(s, float(y), 1.0) for s, y in written]
    run(base, EPOCHS, 0.004)
    kept = {s for d in used if not d[2] for s in d[3]}
    flat = list(dict.fromkeys(s for d in used for s in d[3]))
    n_removed, fair_docs = sum(d[2] for d in used), [d[3] for d in used if not d[2]]
    apart: list[list[tuple[int, ...]]] = []
    for turn in range(TURNS):
        if not used:
            break
        data = list(base)
        p = dict(zip(flat, net.score(flat), strict=True))
        # What the worst segments of kept documents score that the network hasn't just seen: chance reaches no further.
        chance = float(np.quantile([max(p[s] for s in d) for d in apart], CHANCE)) if len(apart) >= 20 else AGREES
        apart = fair_docs[turn % 4 :: 4]
        fair = Counter(s for i, d in enumerate(fair_docs) if turn == TURNS - 1 or i % 4 != turn % 4 for s in set(d))
        data += [(s, 0.0, min(10.0, n**0.5)) for s, n in sorted(fair.items())]
        # As heavy together as a third of the fair segments.
        weight = min(WEIGHT, max(1.0, len(fair) / (3 * max(1, n_removed))))
        for _doc, _lang, verdict, parts in used:
            if verdict and turn:
                own = [s for s in parts if s not in kept] or parts
                top = max(own, key=lambda s: p[s])
                if p[top] > min(AGREES, chance):
                    data.append((top, 1.0, weight))
        run(data, 2, 0.002)
    return net


def worst(net: Network, documents: list[list[tuple[int, ...]]]) -> np.ndarray:
    """The score of each document: that of its worst segment, 0 without any; equal segments are scored once."""
    best = np.zeros(len(documents), np.float32)
    distinct = list(dict.fromkeys(s for d in documents for s in d))
    if distinct:
        p = dict(zip(distinct, net.score(distinct), strict=True))
        best[:] = [max((p[s] for s in d), default=0.0) for d in documents]
    return best


def levels(scores: np.ndarray) -> np.ndarray:
    """How many of the possible cut-offs each score reaches."""
    return np.searchsorted(CUTS, scores.astype(float), side="right")


def thresholds(counts: dict[tuple[str, int, int], int]) -> dict[str, float]:
    """Cut-offs by language: USUAL, moved toward the F1 optimum of the held-out verdicts as these grow in number.

    ``counts``: documents by language, level and verdict.
    """
    out = {}
    for lang in ("en", "es"):
        docs = {(level, y): n for (x, level, y), n in counts.items() if x == lang}
        positive = sum(n for (_, y), n in docs.items() if y)
        best, at = -1.0, USUAL
        for k, t in enumerate(CUTS):
            hit = sum(n for (level, y), n in docs.items() if y and level > k)
            f1 = 2 * hit / max(1, positive + sum(n for (level, _), n in docs.items() if level > k))
            if f1 > best + 1e-9 or abs(f1 - best) <= 1e-9 and abs(t - USUAL) < abs(at - USUAL):
                best, at = f1, float(t)
        trust = positive / (positive + 50)
        out[lang] = USUAL + trust * (at - USUAL)
    return out


def judged(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents on whose verdict most raters agree: doc_id, lang, text, y (1 remove), h (hash), held."""
    verdicts = labels.where("doc_id IS NOT NULL AND verdict IN ('keep', 'remove')").select("doc_id", "rater", "verdict").distinct().groupBy("doc_id").agg(F.avg(F.when(F.col("verdict") == "remove", 1.0).otherwise(0.0)).alias("r")).where("r <> 0.5")
    return documents.select("doc_id", "lang", "text").join(verdicts, "doc_id").select("doc_id", "lang", "text", F.expr("CAST(r > 0.5 AS INT)").alias("y"), F.xxhash64("doc_id").alias("h"), F.expr("crc32(CAST(doc_id AS STRING)) % 5 = 0").alias("held"))


def labelled_segments(documents: DataFrame, labels: DataFrame) -> list[tuple[int, str, int, list[tuple[int, ...]]]]:
    """What the network is fitted on: judged documents that aren't held out, whole, at most SEGMENTS segments of either verdict.

    Documents of a verdict are taken in the order of a hash, so that the sample depends neither on the order of rows nor on
    length, up to the first that doesn't fit any more; only a document of more than SEGMENTS segments is passed over.
    """
    used = judged(documents, labels).where("NOT held AND text IS NOT NULL")

    def sizes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "h": b["h"], "y": b["y"], "n": [len(segments(t)) for t in b["text"]]})

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            cut = [segments(t) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "lang": [language(p, x) for p, x in zip(cut, b["lang"], strict=True)], "y": b["y"], "h": b["h"], "parts": [[list(s) for s in p] for p in cut]})

    # Every document that fits has a segment at least, so no more than SEGMENTS documents can. Those too long to be taken
    # don't count toward that.
    counted = used.mapInPandas(sizes, "doc_id bigint, h bigint, y int, n bigint").groupBy("y", "h", "doc_id").agg(F.sum("n").alias("n")).where(F.col("n").between(1, SEGMENTS))
    chosen = []
    for y in (0, 1):
        n = 0
        for r in counted.where(F.col("y") == y).orderBy("h", "doc_id").limit(SEGMENTS).collect():
            n += r["n"]
            if n > SEGMENTS:
                break
            chosen.append((r["doc_id"],))
    if not chosen:
        return []
    ids = documents.sparkSession.createDataFrame(chosen, "doc_id bigint")
    rows = used.join(F.broadcast(ids), "doc_id").mapInPandas(parts, "doc_id bigint, lang string, y int, h bigint, parts array<array<int>>").collect()
    rows.sort(key=lambda r: (r["h"], r["doc_id"], r["parts"], r["lang"]))
    return [(r["doc_id"], r["lang"], r["y"], [tuple(s) for s in r["parts"]]) for r in rows if r["parts"]]


def held_counts(net: Network, documents: DataFrame, labels: DataFrame, fitted: list[int]) -> dict[tuple[str, int, int], int]:
    """All judged documents that the network wasn't fitted on, scored whole: their number by language, level and verdict."""
    known = documents.sparkSession.sparkContext.broadcast(net.p)
    ids = documents.sparkSession.createDataFrame([(x,) for x in dict.fromkeys(fitted)], "doc_id bigint")

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Network.__new__(Network)
        own.p = known.value
        for b in batches:
            cut = [segments(t) for t in b["text"]]
            yield pd.DataFrame({"lang": [language(p, x) for p, x in zip(cut, b["lang"], strict=True)], "level": levels(worst(own, cut)), "y": b["y"]})

    rest = judged(documents, labels).join(F.broadcast(ids), "doc_id", "left_anti")
    rows = rest.mapInPandas(scored, "lang string, level int, y int").groupBy("lang", "level", "y").count().collect()
    return {(r["lang"], r["level"], r["y"]): r["count"] for r in rows}


def score_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document's score and flag: doc_id, source, language, score, flagged.

    Texts are read whole. The network is fitted on a bounded sample of the verdicts, the thresholds on all others. Null
    and empty texts score 0; without labels the hand-written sentences alone train the network; repeated rows come out
    once each as they are.
    """
    sample = labelled_segments(documents, labels)
    net = fit(sample)
    limits = thresholds(held_counts(net, documents, labels, [d[0] for d in sample]))
    known = documents.sparkSession.sparkContext.broadcast((net.p, limits))

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Network.__new__(Network)
        own.p, cut_at = known.value
        for b in batches:
            cut = [segments(t) for t in b["text"]]
            langs = [language(p, x) for p, x in zip(cut, b["lang"], strict=True)]
            best = worst(own, cut)
            limit = np.array([cut_at[x] for x in langs])
            yield pd.DataFrame({"doc_id": b["doc_id"], "source": b["source"], "language": langs, "score": best.astype(float), "flagged": best >= limit})

    return documents.select("doc_id", "source", "lang", "text").mapInPandas(scored, "doc_id bigint, source string, language string, score double, flagged boolean")
