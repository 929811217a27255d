"""Text cut off by field limits or in transfer.

The ending of every value gives a likelihood ratio that it was cut: learned for texts from the endings of closed entries and
of the same entries stopped at random places, and from how surely a source closes its entries; for names of clubs from
whether they stop inside a word of a name. For every source a right-censored length distribution is then fitted by maximum
likelihood at each candidate limit. A value that fills the limit of its source has a high prior probability of being
cut, any other the small one of a loss in transfer; prior and ending together decide.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlog.llm.forms import SUFFIXES, codes, near, osa, prefix_edits, words
from fieldlog.session import cut, deal, small

#: Share of values cut in transfer at any place, before their ending is looked at.
HAZARD = 0.003
#: Characters before a limit in which a cut value may end, blanks and marks at the cut being dropped.
BAND = 3
#: How cut values spread over the band, from the limit down.
SPREAD = (0.76, 0.18, 0.04, 0.02)
#: Most of a source's values that may be lost in transfer.
STRAY = 0.02
#: Gain in log-likelihood a limit needs.
GAIN = 10.0
#: Chance that an entry cut anywhere happens to end with a closing mark.
LUCK = 0.02
#: Evidence of dots after an entry: they stand for what is missing.
DOTS = 8.0
#: Bound of the evidence (log-likelihood ratio) that the shape of an ending can give.
BOUND = 10.0
#: Evidence from which an ending counts as cut where limits are looked for.
SURE = 3.0
#: Characters of an ending whose last three words and marks are its shape.
ENDING = 80
#: Endings that a shape needs before it is read by itself.
SEEN = 50
#: What is added to counts of endings.
FEW = 0.2
#: Lengths up to this are counted one by one in a fit, longer ones in steps of a thousandth where no ending looks cut.
EXACT = 2048


def _normal_cdf(x: np.ndarray) -> np.ndarray:
    """Abramowitz and Stegun 7.1.26."""
    z = np.abs(x) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * z)
    y = 1 - t * np.exp(-z * z) * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return np.where(x >= 0, (1 + y) / 2, (1 - y) / 2)


def censored_fit(lengths: np.ndarray, whole: np.ndarray, held: float, limit: float | None) -> tuple[float, float]:
    """Mean and deviation of log length by maximum likelihood: ``whole`` counted values, and ``held`` censored at ``limit`` (EM)."""
    logs, n = np.log(np.maximum(lengths, 1)), whole.sum() + held
    first = max(whole.sum(), 1e-9)
    mu = float((logs * whole).sum() / first)
    sd = max(0.05, math.sqrt(float((((logs - mu) ** 2) * whole).sum() / first)))
    at = math.log(max(1.0, limit or 1))
    for _ in range(40 if held else 0):
        a = (at - mu) / sd
        tail = max(1e-12, 1 - float(_normal_cdf(np.array(a))))
        lam = min(math.exp(-a * a / 2) / math.sqrt(2 * math.pi) / tail, a + 1 if a > 0 else 4.0)
        mean, square = mu + sd * lam, (mu + sd * lam) ** 2 + sd * sd * max(0.0, 1 + a * lam - lam * lam)
        new = float(((logs * whole).sum() + held * mean) / n)
        var = float((((logs**2) * whole).sum() + held * square) / n) - new * new
        mu, sd = new, max(0.05, math.sqrt(max(var, 1e-6)))
    return mu, sd


def fit_source(key: tuple, hist: pd.DataFrame) -> pd.DataFrame:
    """The likeliest limit of a source and the share of cut values in its band; none where no limit gains enough.

    ``hist``: length, n, n_open (of these, with an ending that looks cut). Complete values have log-normal lengths; one
    longer than the limit is cut there with a probability of its own, for some pass uncut; endings that look cut lie
    anywhere else at the rate of transfer losses. Every length at which endings look cut is a candidate.
    """
    hist = hist.groupby("length", as_index=False)[["n", "n_open"]].sum().sort_values("length")
    lengths, opened = hist["length"].to_numpy(float), hist["n_open"].to_numpy(float)
    whole = hist["n"].to_numpy(float) - opened
    total = whole.sum() + opened.sum()
    best, limit, share = GAIN, None, 0.0

    def log_likelihood(mu: float, sd: float, at: float | None, rate: float, stray: float) -> float:
        cell = np.maximum(1e-12, _normal_cdf((np.log(lengths + 0.5) - mu) / sd) - _normal_cdf((np.log(np.maximum(lengths - 0.5, 0.5)) - mu) / sd))
        tail = 0.0 if at is None else max(1e-12, 1 - float(_normal_cdf(np.array((math.log(at + 0.5) - mu) / sd))))
        kept = cell if at is None else np.where(lengths > at, cell * (1 - rate), cell)
        spread_at = np.zeros(len(lengths)) if at is None else np.select([lengths == at - i for i in range(BAND + 1)], SPREAD, 0.0)
        # A loss at a random place of a longer value: as likely at each length as there are longer values.
        lost = np.maximum(1 - _normal_cdf((np.log(lengths) - mu) / sd), 1e-9) / math.exp(mu + sd * sd / 2)
        return float((whole * np.log(np.maximum(kept, 1e-15))).sum() + (opened * np.log(rate * tail * spread_at + stray * lost)).sum())

    if total and opened.sum():
        mu, sd = censored_fit(lengths, whole + opened, 0.0, None)
        strays = lambda n: min(STRAY, (n + 0.5) / (total + 1))
        free = log_likelihood(mu, sd, None, 0.0, strays(opened.sum()))
        for at in lengths[opened > 0]:
            band = (lengths > at - BAND - 1) & (lengths <= at)
            held, passed = opened[band].sum(), whole[lengths > at].sum()
            if held < passed:  # what most values pass is no limit
                continue
            mu, sd = censored_fit(lengths, whole, held, at)
            gain = log_likelihood(mu, sd, at, min(1 - 1e-6, held / (held + passed)), strays(opened.sum() - held)) - free
            if gain > best:
                best, limit = gain, float(at)
                share = float(np.clip(held / (held + whole[band].sum()), 0.02, 0.98))
    return pd.DataFrame({"source": [key[0]], "cut_limit": [limit], "band_share": [share]})


def length_limits(hist: DataFrame) -> DataFrame:
    """Limits of all sources. ``hist``: source, length, n, n_open.

    A source's lengths reach one task: those up to EXACT or at which endings look cut one by one, others in steps.
    """
    step = F.expr("length - length % greatest(1, CAST(pow(10, floor(log10(length)) - 3) AS INT))")
    kept = F.when((F.col("length") <= EXACT) | (F.col("n_open") > 0), F.col("length")).otherwise(step)
    rows = hist.groupBy("source", "length").agg(F.sum("n").alias("n"), F.sum("n_open").alias("n_open"))
    rows = rows.groupBy("source", kept.cast("int").alias("length")).agg(F.sum("n").alias("n"), F.sum("n_open").alias("n_open"))
    return rows.groupBy("source").applyInPandas(fit_source, "source string, cut_limit double, band_share double")


def logit(p: Column) -> Column:
    p = F.greatest(F.lit(1e-4), F.least(F.lit(1 - 1e-4), p))
    return F.log(p / (1 - p))


def prior(length: Column) -> Column:
    """Log-odds that a value is cut, before its ending: the share of the band at the limit, else the hazard of transfer."""
    inside = (length > F.col("cut_limit") - BAND - 1) & (length <= F.col("cut_limit"))
    return logit(F.when(inside, F.greatest(F.col("band_share"), F.lit(HAZARD))).otherwise(HAZARD))


def text_parts(text: Column) -> dict[str, Column]:
    """dots: ends in dots that stand for what is missing; core: text without them; closed: has a closing mark."""
    t = F.rtrim(text)
    dots = t.endswith("..") | t.endswith("…")
    core = F.rtrim(F.when(dots, F.regexp_replace(t, r"(?:\.{2,}|…)+$", "")).otherwise(t))
    closed = ~dots & (t.endswith(".") | t.endswith("!") | t.endswith("?") | t.endswith("]"))
    return {"dots": dots, "core": core, "closed": closed}


def ending_shape(text: Column, hanging: Column) -> Column:
    """The shape of an ending: its last three words, numbers and marks, and whether a bracket is open.

    Words in small letters stay as they are; others, and numbers, are told apart by their kind alone (N, A and 9).
    """
    last = F.substring(F.substring_index(text, " ", -3), -ENDING, ENDING)
    kinds = F.regexp_replace(F.regexp_replace(last, r"\p{Lu}+\p{Ll}[\p{L}\p{M}'’-]*", "N"), r"[A-Z]{2,}", "A")
    apart = F.regexp_replace(F.regexp_replace(kinds, r"\d+", " 9 "), r"[^\p{L}\d ]", " $0 ")
    return F.concat(F.substring_index(F.regexp_replace(F.trim(apart), "  +", " "), " ", -3), F.when(hanging, " (").otherwise(" "))


def shape_ratios(counts: DataFrame) -> DataFrame:
    """Log-likelihood ratios that a text with an ending of this shape was cut: shape, ratio.

    ``counts``: shape, whole (complete entries that end so), stopped (entries that do when stopped at a place given by
    their hash), others count for neither. A shape seen in fewer than SEEN endings is read by its last two words, or by
    the last alone, or as one of all last words that are as rare. Where the longest reading speaks for a cut, a
    shorter one with more endings may do so more surely.
    """
    part = F.split("shape", " ")
    hanging, last = F.element_at(part, -1), F.element_at(part, -2)
    rows = counts.groupBy("shape").agg(F.sum("whole").alias("whole"), F.sum("stopped").alias("stopped"))
    rows = cut(rows.select("shape", "whole", "stopped", F.concat_ws(" ", F.slice(part, F.greatest(F.lit(-3), -F.size(part)), 3)).alias("l2"), F.concat_ws(" ", last, hanging).alias("l1")))

    def ratios(df: DataFrame, by: str, name: str) -> DataFrame:
        ratio = F.greatest(F.lit(-BOUND), F.least(F.lit(BOUND), F.log((F.sum("stopped") + FEW) / (F.sum("whole") + FEW))))
        return df.groupBy(by).agg(F.sum(F.col("stopped") + F.col("whole")).alias("n"), ratio.alias(name))

    out = rows.select("shape", "l2", "l1")
    for by in ("shape", "l2", "l1"):
        out = out.join(small(ratios(rows, by, f"r_{by}").where(F.col("n") >= SEEN).drop("n")), by, "left")
    # Words that are too rare as the last one are read together: mostly words that stop inside.
    rare = cut(out.where("r_l1 IS NULL").select("shape").join(rows, "shape").withColumn("l0", F.when(F.col("l1").rlike(r"^\p{Ll}"), F.concat(F.lit("w "), F.element_at(F.split("l1", " "), -1))).otherwise(F.col("l1"))))
    out = out.join(small(rare.select("shape", "l0").join(ratios(rare, "l0", "r_l0").drop("n"), "l0").drop("l0")), "shape", "left")
    longest = F.coalesce("r_shape", "r_l2", "r_l1", "r_l0", F.lit(0.0))
    return out.select("shape", F.when(longest > 0, F.greatest("r_shape", "r_l2", "r_l1", "r_l0")).otherwise(longest).alias("ratio"))


def text_cut(rows: DataFrame, keys: list[str], source: str, column: str) -> DataFrame:
    """Rows whose text stops before it is finished: keys, source, posterior.

    Entries that are closed, and have no open bracket, are taken as complete. Null and blank texts are never cut; very
    long texts count by their whole length. Repeated rows come out once. Rows without a source are a source of their own.
    """
    base = rows.select(*keys, F.coalesce(F.col(source), F.lit("")).alias("source"), F.rtrim(column).alias("__t")).where("__t <> ''")
    p = text_parts(F.col("__t"))
    parted = base.select(*keys, "source", F.xxhash64("__t").alias("h"), *(p[k].alias(k) for k in ("core", "dots", "closed")))
    hanging = lambda c: F.length(F.substring_index(c, "(", -1)) < F.length(F.substring_index(c, ")", -1))
    bare = F.when(F.col("closed"), F.rtrim(F.expr("rtrim('.!?]', core)"))).otherwise(F.col("core"))
    parted = parted.select(*keys, "source", "h", F.length("core").alias("length"), "dots", "closed", bare.alias("bare"), hanging("core").alias("hanging"))
    stop = F.rtrim(F.expr("left(bare, CAST(1 + pmod(h, greatest(length(bare) - 1, 1)) AS INT))"))
    complete = F.col("closed") & ~F.col("hanging")
    parted = parted.select(*keys, "source", "length", "dots", "closed", "hanging", "bare", F.when(complete, stop).alias("stop"))
    # Shapes are found once, in one scan; what is written has no texts any more.
    parted = cut(parted.select(*keys, "source", "length", "dots", "closed", ending_shape(F.col("bare"), F.col("hanging")).alias("shape"), (F.col("closed") & ~F.col("hanging")).alias("complete"), F.when(F.col("stop").isNotNull(), ending_shape(F.col("stop"), hanging("stop"))).alias("stop_shape")))
    facts = cut(parted.groupBy("source", "length", "dots", "closed", "complete", "shape").agg(F.count("*").alias("n")))
    counts = facts.groupBy("shape").agg(F.sum(F.when(F.col("complete"), F.col("n")).otherwise(0)).alias("whole")).withColumn("stopped", F.lit(0).cast("bigint"))
    counts = counts.unionByName(parted.where("complete").groupBy(F.col("stop_shape").alias("shape")).agg(F.count("*").alias("stopped")).withColumn("whole", F.lit(0).cast("bigint")))
    ratios = small(cut(shape_ratios(counts).withColumnRenamed("ratio", "by_shape")))
    # How surely a source closes its entries is learned from those whose ending looks complete.
    facts = facts.join(ratios, "shape")
    marks = cut(facts.where("by_shape < -2 AND NOT dots").groupBy("source").agg(((F.sum(F.when(F.col("closed"), 0).otherwise(F.col("n"))) + 0.5) / (F.sum("n") + 1.0)).alias("miss")))

    def with_ratio(df: DataFrame) -> DataFrame:
        df = df.join(small(marks), "source", "left").withColumn("miss", F.coalesce("miss", F.lit(0.5)))
        by_mark = F.when(F.col("closed"), F.log(LUCK / (1 - F.col("miss")))).otherwise(F.log((1 - LUCK) / F.col("miss")))
        return df.withColumn("ratio", F.col("by_shape") + F.when(F.col("dots"), F.greatest(by_mark, F.lit(DOTS))).otherwise(by_mark))

    hist = with_ratio(facts).groupBy("source", "length").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("ratio") > SURE, F.col("n")).otherwise(0)).alias("n_open"))
    score = with_ratio(parted.join(ratios, "shape")).where(f"ratio > {-math.log(0.98 / 0.02)}").join(small(length_limits(hist)), "source").withColumn("__logit", prior(F.col("length")) + F.col("ratio"))
    return score.where("__logit > 0").groupBy(*keys, F.nullif("source", F.lit("")).alias("source")).agg(F.max(1 / (1 + F.exp(-F.col("__logit")))).alias("posterior"))


#: Evidence that a name which stops inside a word was cut, by how it stops there: exactly; after typos, which also make such
#: endings; as codes do that are in use in its game's field positions or as long as its source's own codes.
EXACTLY, WITH_TYPOS, AS_CODES = math.log(0.9 / 0.0005), math.log(0.1 / 0.0002), math.log(0.9 / 0.2)
#: Evidence of a whole word, name or code, or of nothing like a club.
WHOLE = -9.0


def _stops(value: str, clubs: list[tuple[str, str | None]], used: set[str], width: int) -> float:
    """Evidence (log-likelihood ratio) that a club typed as ``value`` stops inside a word.

    ``clubs``: names and nicknames that may be meant; ``used``: codes of the game's field positions; ``width``: length of
    the codes that this source makes by cutting names.
    """
    w = words(value)
    if not w:
        return WHOLE
    flat, best = "".join(w), WHOLE
    known = [(words(name), words(nick)) for name, nick in clubs if words(name)]
    if not known or len(flat) > max(len("".join(own + nick)) for own, nick in known) + 12:  # longer than any form of a name
        return WHOLE
    like_code = flat in used or " " not in value and len(flat) == width
    for own, nick in known:
        whole = [own, *((*own, s) for s in SUFFIXES)] + ([nick, own + nick] if nick else [])
        for form in whole:
            joined = "".join(form)
            if flat in codes(" ".join(own)) or near(flat, joined) and (flat == joined or len(flat) >= len(joined) - (osa(flat, joined) > 0 and len(w) == len(form)) and not joined.startswith(flat)):
                return WHOLE
            for k in range(len(form)):
                for m in range(k + 1, len(form) + 1):
                    part = form[k:m]
                    if len(part) == len(w) and all(a == b or near(a, b) and not b.startswith(a) for a, b in zip(w, part, strict=True)) or flat == "".join(part):
                        return WHOLE
        for form in whole:
            for k in range(len(form)):
                rest = form[k:]
                if len(w) > len(rest):
                    continue
                head, last, target = w[:-1], w[-1], rest[len(w) - 1]
                if not all(near(a, b) for a, b in zip(head, rest, strict=False)):
                    continue
                if target.startswith(last) and len(last) < len(target) and (head or len(last) >= 3):
                    best = max(best, EXACTLY)
                elif len(last) >= 4 or head and len(last) >= 3:
                    edits, upto = prefix_edits(last, target)
                    if edits == 1 and upto < len(target) and len(last) < len(target) and osa(last, target) > 1:
                        best = max(best, WITH_TYPOS)
            joined = "".join(form)
            if len(form) > 1 and (len(w) == 1 or not joined.startswith(flat)) and len(flat) >= 5:
                edits, upto = prefix_edits(flat, joined)
                ends, at = set(), 0
                for x in form:
                    at += len(x)
                    ends.add(at)
                if edits == 0 and upto not in ends:
                    best = max(best, EXACTLY)
                elif 0 < edits <= (2 if len(flat) >= 9 else 1) and upto not in ends and upto - 1 not in ends and len(flat) >= 7 and osa(flat, joined) > 1:
                    best = max(best, WITH_TYPOS)
            elif len(form) > 1 and len(w) > 1 and joined.startswith(flat) and len(flat) not in {sum(map(len, form[:i])) for i in range(1, len(form) + 1)} and len(flat) >= 5:
                best = max(best, EXACTLY)  # cut, with the blank misplaced
    return min(best, AS_CODES) if like_code and best > 0 else best


def club_cut(rows: DataFrame, keys: list[str], source: str, column: str, game: str, position: str, sides: list[str], nicknames: DataFrame) -> DataFrame:
    """Rows in which what was typed for a club stops inside a word: keys, source, posterior.

    ``position`` gives the codes in use in a game and the width at which a source cuts its codes: a value like these is taken
    for cut only where it fills a limit of its source. ``sides`` are the columns with the names of the clubs;
    ``nicknames``: team_name, mascot. Null and blank values, and values that resemble no club, are never cut.
    """
    named = rows.select(*keys, F.coalesce(F.col(source), F.lit("")).alias("source"), F.coalesce(F.col(game), F.lit("")).alias("__game"), F.upper(F.trim(column)).alias("__v"), F.array_sort(F.array_distinct(F.array_compact(F.array(*sides)))).alias("__clubs")).where(F.length("__v") > 0)
    named = cut(named)
    used = rows.select(F.coalesce(F.col(source), F.lit("")).alias("source"), F.coalesce(F.col(game), F.lit("")).alias("__game"), *sides[:2], F.expr(f"trim(trim(TRAILING '0123456789' FROM upper({position})))").alias("__code")).where(F.length("__code") > 0).distinct()
    used = cut(used)
    club = F.explode(F.array(*(F.upper(F.regexp_replace(s, "[^A-Za-z]", "")) for s in sides[:2])))
    cut_code = used.select("source", "__code", club.alias("__flat")).where((F.length("__code") >= 5) & F.expr("startswith(__flat, __code)") & (F.length("__code") < F.length("__flat")))
    widths = cut_code.groupBy("source", F.length("__code").alias("w")).agg(F.count("*").alias("n")).groupBy("source").agg(F.max_by("w", F.struct("n", "w")).alias("__width"))
    used = used.groupBy("__game").agg(F.collect_set("__code").alias("__used"))

    nick = nicknames.select(F.col("team_name").alias("__n"), F.col("mascot").alias("__m"))
    kinds = named.select("source", "__game", "__v", "__clubs").distinct()
    pairs = kinds.select("__clubs", F.explode("__clubs").alias("__n")).distinct().join(small(nick), "__n", "left").groupBy("__clubs").agg(F.collect_set(F.struct("__n", "__m")).alias("__known"))
    judged = kinds.join(used, "__game", "left").join(small(widths), "source", "left").join(small(pairs), "__clubs", "left")

    def evidence(values: pd.Series, known: pd.Series, codes_used: pd.Series, width: pd.Series) -> pd.Series:
        out, seen = [], {}
        for v, k, u, w in zip(values, known, codes_used, width, strict=True):
            clubs = [] if k is None else sorted((x["__n"], x["__m"] or "") for x in k)
            code_set = () if u is None else tuple(sorted(u))
            at = (v, tuple(clubs), code_set, w)
            if at not in seen:
                seen[at] = _stops(v, [(n, m or None) for n, m in clubs], set(code_set), 0 if w != w else int(w))
            out.append(seen[at])
        return pd.Series(out, dtype=float)

    ev = F.pandas_udf(evidence, "double")
    judged = cut(deal(judged, "__game", "__v").select("source", "__game", "__v", "__clubs", ev("__v", "__known", "__used", F.col("__width").cast("double")).alias("__ev")))
    # A value counts once a game: one typed for many plays of a game is one length.
    hist = judged.groupBy("source", F.length("__v").alias("length")).agg(F.count("*").alias("n"), F.count_if(F.col("__ev") > 0).alias("n_open"))
    score = named.join(judged.where("__ev > 0"), ["source", "__game", "__v", "__clubs"]).join(small(length_limits(hist)), "source")
    score = score.withColumn("__logit", prior(F.length("__v")) + F.col("__ev"))
    return score.where("__logit > 0").groupBy(*keys, F.nullif("source", F.lit("")).alias("source")).agg(F.max(1 / (1 + F.exp(-F.col("__logit")))).alias("posterior"))
