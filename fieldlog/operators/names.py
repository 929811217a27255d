"""Names typed in play-by-play against rosters: ordered rules, first hit per roster player, then a choice by position."""

from __future__ import annotations

import difflib
import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Short given names and what they stand for (fixed values, both directions).
SHORT = {
    "alex": "alexander", "andy": "andrew", "ben": "benjamin", "bill": "william", "billy": "william", "bob": "robert", "bobby": "robert", "cam": "cameron", "charlie": "charles", "chris": "christopher", "dan": "daniel", "danny": "daniel", "dave": "david", "drew": "andrew",
    "ed": "edward", "eddie": "edward", "eli": "elijah", "greg": "gregory", "jake": "jacob", "jim": "james", "joe": "joseph", "joey": "joseph", "jon": "jonathan", "josh": "joshua", "ken": "kenneth", "larry": "lawrence", "matt": "matthew", "max": "maximilian", "mike": "michael",
    "nate": "nathaniel", "nick": "nicholas", "pat": "patrick", "ray": "raymond", "rob": "robert", "sam": "samuel", "steve": "stephen", "ted": "theodore", "theo": "theodore", "tim": "timothy", "tom": "thomas", "tommy": "thomas", "tony": "anthony", "vince": "vincent", "will": "william", "zach": "zachary",
}
RULES = ["exact", "normalized", "suffix", "first_last", "initial_last"]


def normalized(name: str | None) -> list[str]:
    """Tokens in lower-case ASCII without marks and generational suffixes; 'Last, First' is turned."""
    text = unicodedata.normalize("NFKD", name or "").encode("ascii", "ignore").decode().lower()
    if text.count(",") == 1:
        last, first = text.split(",")
        text = f"{first} {last}"
    return [t for t in re.sub(r"[^a-z ]+", " ", text.replace("'", "")).split() if t not in ("jr", "sr", "ii", "iii", "iv")]


def same_first(a: str, b: str) -> bool:
    return a == b or len(a) == 1 and b.startswith(a) or len(b) == 1 and a.startswith(b) or SHORT.get(a, a) == SHORT.get(b, b)


def begins(a: str, b: str, least: int = 4, missing: int = 3) -> bool:
    """One is the other with at most ``missing`` letters cut off, ``least`` at least left."""
    short, long = sorted((a, b), key=len)
    return len(short) >= least and long.startswith(short) and len(long) - len(short) <= missing


def close(a: str, b: str, ratio: float = 0.85) -> bool:
    return bool(a) and bool(b) and a[0] == b[0] and abs(len(a) - len(b)) <= 2 and difflib.SequenceMatcher(None, a, b).ratio() >= ratio


def rule_of(name: str, roster: str) -> str | None:
    """The first rule under which a typed name is a roster player's."""
    if name == roster:
        return "exact"
    a, b = normalized(name), normalized(roster)
    if not a or not b:
        return None
    if a == b or "".join(a) == "".join(b):
        return "normalized"
    if len(a) == len(b) + 1 and len(a[-1]) == 1 and a[:-1] == b:
        return "suffix"
    last = a[-1] == b[-1] or begins(a[-1], b[-1]) or close(a[-1], b[-1])
    if len(a) >= 2 and len(b) >= 2 and last and len(a[0]) > 1 and same_first(a[0], b[0]):
        return "first_last"
    if last and (len(a) == 1 or len(a[0]) == 1 and b[0].startswith(a[0])):
        return "initial_last"
    return None


def keys_of(name: str | None, typed: bool) -> list[str]:
    """Keys of which a typed and a roster name share one at least wherever ``rule_of`` finds a rule.

    The name as it is, its letters, and the first letter of its last token (every rule on last names asks for it). A
    letter after the name may stand for a suffix, so a typed name that ends in one also has its letters without that.
    """
    t = normalized(name)
    keys = [f"={name}"]
    if t:
        keys += ["+" + "".join(t), "^" + t[-1][0]]
        if typed and len(t) > 1 and len(t[-1]) == 1:
            keys.append("+" + "".join(t[:-1]))
    return keys


def match_names(names: DataFrame) -> DataFrame:
    """Each typed name of a club and season to its roster name: season, team, pbp_name, canonical, rule, outcome.

    The roster is the set of hand-typed canonical names of the club in the season. Names are compared where they share a
    key, which no pair that a rule accepts can miss. Of several players under the best rule the one of the same position
    is chosen, else the name stays ambiguous.
    """
    key = lambda typed: F.pandas_udf(lambda s: pd.Series([keys_of(x, typed) for x in s]), "array<string>")
    typed = names.where("trim(pbp_name) <> ''").select("season", "team", "pbp_name", "position").dropDuplicates(["season", "team", "pbp_name"]).withColumn("k", F.explode(key(True)("pbp_name")))
    roster = names.where("trim(canonical_name) <> ''").groupBy("season", "team", F.trim("canonical_name").alias("canonical")).agg(F.max("position").alias("its")).withColumn("k", F.explode(key(False)("canonical")))
    pairs = typed.join(roster, ["season", "team", "k"]).select("season", "team", "pbp_name", "position", "canonical", "its").distinct()
    rule = F.pandas_udf(lambda a, b: pd.Series([rule_of(x, y) for x, y in zip(a, b, strict=True)], dtype=object), "string")
    hits = pairs.withColumn("rule", rule("pbp_name", "canonical")).where("rule IS NOT NULL").withColumn("order", F.array_position(F.array(*map(F.lit, RULES)), F.col("rule")))
    w = Window.partitionBy("season", "team", "pbp_name")
    best = hits.withColumn("least", F.min("order").over(w)).where("order = least").withColumn("n", F.count("*").over(w)).withColumn("same", F.when(F.col("position") == F.col("its"), 1).otherwise(0)).withColumn("n_same", F.sum("same").over(w))
    chosen = best.groupBy("season", "team", "pbp_name").agg(F.max(F.when((F.col("n") == 1) | ((F.col("n_same") == 1) & (F.col("same") == 1)), F.col("canonical"))).alias("canonical"), F.max("rule").alias("rule"), F.max("n").cast("bigint").alias("candidates"))
    out = typed.select("season", "team", "pbp_name").distinct().join(chosen, ["season", "team", "pbp_name"], "left")
    return out.withColumn("outcome", F.when(F.col("candidates").isNull(), "no_match").when(F.col("canonical").isNull(), "ambiguous").otherwise("matched")).withColumn("candidates", F.coalesce("candidates", F.lit(0)))
