"""Freely typed values mapped to the closest entry of a reference list.

Every distinct token is joined to a vocabulary by edit distance (symmetric deletes, so only tokens that share a reduced
form meet). The vocabulary holds, for every entry of the list and every club at hand in a game, the words of its name
and what is commonly written for the whole of it: joined words, nickname, beginnings, codes. The repaired tokens of a
value are combined by soft TF-IDF into a score for each entry that shares one, and the scores rank all entries: those
of the value's game first, the whole list where none of these can be meant.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlog.llm.forms import SUFFIXES, codes, words
from fieldlog.session import cut, deal, small

#: Soft TF-IDF that an entry outside the value's game must reach, alone.
ENOUGH = 0.8
#: Soft TF-IDF from which a club of the game can be meant.
CAN_MEAN = 0.3
#: How much better an entry elsewhere must fit before it displaces a club of the game.
AHEAD = 0.2
#: Weight of a form that needs an added word or letters (Hathern: HC), or that has lost its end, against the form itself.
ADDED = 0.9
#: Words up to which a vocabulary is broadcast, some hundred reduced forms each.
VOCABULARY = 20_000
#: Words that may go with any name and tell nothing.
GENERAL = sorted({s[:k] for s in ("COLLEGE", "COMMUNITY", "JUNIOR") for k in range(3, 10)} | {"CC", "JC"})
WHOLE = -1
FORM = "array<struct<word: string, slot: int, weight: double, least: int>>"


def forms(name: str | None, nick: str | None) -> list[tuple[str, int, float, int]]:
    """What is written for a name: word, the name's word it stands for (WHOLE for all), weight, letters from which typos count.

    Words of the name, whole or cut; joined words, also with an added word, whole or cut; the nickname; codes.
    """
    own, nicks = words(name), words(nick)
    out: dict[tuple[str, int], tuple[float, int]] = {}

    def add(word: str, slot: int, weight: float, least: int) -> None:
        if word and (slot == WHOLE or word not in GENERAL) and weight > out.get((word, slot), (0.0, 0))[0]:
            out[(word, slot)] = (weight, least)

    for i, w in enumerate(own):
        add(w, i, 1.0, 4)
        for k in range(1, len(w)):
            add(w[:k], i, ADDED, 5)
    joined, nickname = "".join(own), "".join(nicks)
    for w in (joined, nickname):
        add(w, WHOLE, 1.0, 4)
    for tail in (*SUFFIXES, nickname):
        add(joined + tail, WHOLE, ADDED, 5)
    initials = "".join(w[0] for w in own)
    for c in codes(name):
        add(c, WHOLE, 1.0 if c == initials and len(own) > 1 else ADDED, 5)
    for w in (joined, nickname, *(joined + s for s in SUFFIXES)):
        for k in range(3, len(w)):
            add(w[:k], WHOLE, ADDED, 5)
    for w in nicks:
        add(w, WHOLE, ADDED, 4)
    return [(w, s, x, n) for (w, s), (x, n) in sorted(out.items())]


def deletes(column: str) -> str:
    """SQL of the reduced forms of a token: itself, one letter left out, from nine letters on also two."""
    one = "transform(sequence(1, length({0})), {1} -> concat(substr({0}, 1, {1} - 1), substr({0}, {1} + 1)))"
    first, second = one.format(column, "i"), f"flatten(transform({one.format(column, 'i')}, y -> {one.format('y', 'j')}))"
    return f"array_distinct(concat(array({column}), CASE WHEN length({column}) >= 4 THEN {first} ELSE array() END, CASE WHEN length({column}) >= 9 THEN {second} ELSE array() END))"


#: Least distance after one swap of neighbours, which costs one; looked for only where it can matter.
SWAPPED = "1 + array_min(transform(sequence(1, length(token) - 1), i -> levenshtein(concat(substr(token, 1, i - 1), substr(token, i + 1, 1), substr(token, i, 1), substr(token, i + 2)), word)))"


def neighbours(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of near tokens (token, word, similarity): one edit from four letters on, two from nine; one swap counts as one.

    Both frames have one column of distinct non-empty tokens; pairs come from shared reduced forms only.
    """
    # A token more than two letters longer than the longest word can't be near any.
    most = right.agg(F.coalesce(F.max(F.length("word")), F.lit(0)).alias("longest"), F.count("*").alias("n")).first()
    left = deal(left.where(F.length("token") <= most["longest"] + 2), "token")
    a = left.select("token", F.explode(F.expr(deletes("token"))).alias("reduced"))
    b = right.select("word", F.explode(F.expr(deletes("word"))).alias("reduced"))
    # Spark takes exploded rows for few: a vocabulary is broadcast up to a counted size and merged by shuffle beyond it.
    b = F.broadcast(b) if most["n"] <= VOCABULARY else b.hint("merge")
    pairs = a.join(b, "reduced").select("token", "word").distinct()
    plain = pairs.withColumn("d", F.levenshtein("token", "word"))
    swaps = plain.withColumn("d", F.expr(f"CASE WHEN d BETWEEN 2 AND 3 AND length(token) >= 4 THEN least(d, {SWAPPED}) ELSE d END"))
    most = F.when(F.least(F.length("token"), F.length("word")) < 4, 0).when(F.length("word") >= 9, 2).otherwise(1)
    return swaps.where(F.col("d") <= most).select("token", "word", (1 - F.col("d") / F.greatest(F.length("token"), F.length("word"))).alias("similarity"))


def split_words(column: str) -> F.Column:
    """Tokens of a value: upper case, marks dropped."""
    return F.filter(F.split(F.regexp_replace(F.regexp_replace(F.upper(column), r"[-,/]+", " "), r"[^\p{L}\p{N} ]+", ""), r" +"), lambda x: x != "")


def vocabulary(entries: DataFrame) -> DataFrame:
    """word, entry, part, least, idf: what may be written for each entry, and the part of its name's vector it stands for.

    ``entries``: entry, name, nick. A word's idf is 1 + ln(entries / entries with it).
    """
    made = F.pandas_udf(lambda names, nicks: pd.Series([[dict(zip(("word", "slot", "weight", "least"), f, strict=True)) for f in forms(a, b)] for a, b in zip(names, nicks, strict=True)]), FORM)
    rows = entries.select("entry", F.explode(made("name", "nick")).alias("f")).select("entry", "f.*")
    rows = cut(rows)
    n = entries.agg(F.count("*").alias("n_entries"))
    idf = rows.groupBy("word").agg(F.countDistinct("entry").alias("df")).join(F.broadcast(n)).select("word", (1 + F.log(F.col("n_entries") / F.col("df"))).alias("idf"))
    rows = rows.join(idf, "word")
    # The vector of a name: the idf of its whole words.
    own = rows.where("slot >= 0 AND weight = 1").select("entry", "slot", F.col("idf").alias("own_idf"))
    norm = own.groupBy("entry").agg(F.sqrt(F.sum(F.col("own_idf") ** 2)).alias("norm"))
    rows = rows.join(own, ["entry", "slot"], "left").join(norm, "entry", "left")
    part = F.when(F.col("slot") == WHOLE, 1.0).otherwise(F.coalesce(F.col("own_idf") / F.col("norm"), F.lit(0.0)))
    return rows.groupBy("word", "entry").agg(F.max(part * F.col("weight")).alias("part"), F.min("least").alias("least"), F.max("idf").alias("idf"))


def soft_tfidf(values: DataFrame, known: DataFrame) -> DataFrame:
    """Scores of typed values (raw_value, entry, score, telling) against the entries with which they share a repaired token.

    A value is read as its words, without GENERAL ones if it has others, and, if it has several, also as all of them joined; the better reading counts. In a
    reading each token is weighed by the idf of the word nearest to it, or as a word of one entry if it is near none;
    its share in an entry is similarity times the part of the entry's vector that the word stands for. ``telling`` is the
    score with each share weighed by how few entries the word may stand for.
    """
    telling = F.array_except(split_words("raw_value"), F.array(*map(F.lit, GENERAL)))
    tokens = values.withColumn("t", F.when(F.size(telling) > 0, telling).otherwise(split_words("raw_value")))
    docs = tokens.select("raw_value", F.posexplode(F.expr("CASE WHEN size(t) > 1 THEN array(array_distinct(t), array(array_join(t, ''))) ELSE array(t) END")).alias("doc", "t")).select("raw_value", "doc", F.size("t").alias("n_tokens"), F.explode("t").alias("token"))
    words_ = known.groupBy("word").agg(F.max("idf").alias("idf"), F.min("least").alias("least"))
    docs = cut(docs)
    near = neighbours(docs.select("token").distinct(), words_.select("word")).join(small(words_), "word").where("similarity = 1 OR length(token) >= least")
    near = cut(near)
    weights = near.groupBy("token").agg(F.max_by("idf", F.struct("similarity", "idf")).alias("w"))
    rarest = known.agg(F.coalesce(F.max("idf"), F.lit(1.0)).alias("top"))
    weighed = docs.join(weights, "token", "left").join(F.broadcast(rarest)).withColumn("w", F.coalesce("w", "top"))
    # A token's share in each entry is the greatest over the words it may be.
    shares = near.drop("idf", "least").join(small(known), "word").where("similarity = 1 OR length(token) >= least").join(F.broadcast(rarest))
    shares = shares.groupBy("token", "entry").agg(F.max(F.col("similarity") * F.col("part")).alias("share"), F.max(F.col("similarity") * F.col("part") * F.col("idf") / F.col("top")).alias("rare"))
    norms = weighed.groupBy("raw_value", "doc").agg(F.sqrt(F.sum(F.col("w") ** 2)).alias("norm"))
    dots = weighed.join(shares, "token").groupBy("raw_value", "doc", "entry").agg(F.sum(F.col("w") * F.col("share")).alias("dot"), F.sum(F.col("w") * F.col("rare")).alias("rare"))
    return dots.join(norms, ["raw_value", "doc"]).groupBy("raw_value", "entry").agg(F.max(F.least(F.lit(1.0), F.col("dot") / F.col("norm"))).alias("score"), F.max(F.least(F.lit(1.0), F.col("rare") / F.col("norm"))).alias("telling"))


def map_values(values: DataFrame, reference: DataFrame, context: DataFrame) -> DataFrame:
    """The entry each value means: field_name, game_id, raw_value, team_no (0 for none), score, of_game.

    ``values``: field_name, game_id, raw_value; ``reference``: team_no, team_name, mascot; ``context``: game_id,
    club (names in play in a game, in the list or not). Distinct non-blank values come out once each; null and blank
    ones are no values. All entries are ranked by soft TF-IDF. The best club of the value's game is meant if it reaches
    CAN_MEAN, also one that isn't in the list (team_no 0), unless an entry elsewhere fits better by AHEAD; the first in
    the alphabet on ties. Otherwise it is the best entry of the list if that reaches ENOUGH and no other does as well.
    Values of games without context are judged against the list alone; an empty list maps everything to 0.
    """
    values = values.select("field_name", "game_id", "raw_value").where(F.length(F.trim("raw_value")) > 0).distinct()
    key = lambda c: F.array_join(split_words(c), " ")
    listed = reference.where("team_no is not null and trim(team_name) <> ''").groupBy(key("team_name").alias("entry")).agg(F.min(F.col("team_no").cast("bigint")).alias("team_no"), F.min("team_name").alias("name"), F.min("mascot").alias("nick"))
    clubs = context.select("game_id", key("club").alias("entry"), F.col("club").alias("name")).where("entry <> ''").groupBy("game_id", "entry").agg(F.min("name").alias("name"))
    entries = clubs.groupBy("entry").agg(F.min("name").alias("name")).join(listed.select("entry", "team_no", F.col("name").alias("listed"), "nick"), "entry", "full_outer").select("entry", F.coalesce("team_no", F.lit(0).cast("bigint")).alias("team_no"), F.coalesce("listed", "name").alias("name"), "nick")
    # Tables read more than once below are written once: the entries, what may be written for them, and all scores.
    entries = cut(entries)
    scored = cut(soft_tfidf(values.select("raw_value").distinct(), cut(vocabulary(entries))).join(small(entries.select("entry", "team_no")), "entry"))

    best = scored.where("team_no > 0").groupBy("raw_value").agg(F.max("telling").alias("list_score"), F.max_by("team_no", F.struct("telling", -F.col("team_no"))).alias("list_no"), F.collect_list("telling").alias("all"))
    best = best.select("raw_value", "list_score", "list_no", F.size(F.filter("all", lambda x: x >= F.col("list_score") - 1e-9)).alias("list_ties"))
    at_hand = values.join(clubs.select("game_id", "entry"), "game_id").join(scored, ["raw_value", "entry"]).where(F.col("score") >= CAN_MEAN)
    at_hand = at_hand.groupBy("field_name", "game_id", "raw_value").agg(F.min(F.struct(-F.round("score", 9), -F.round("telling", 9), F.col("entry"), "team_no")).alias("m"))
    at_hand = at_hand.select("field_name", "game_id", "raw_value", (-F.col("m.col1")).alias("score"), F.col("m.team_no").alias("team_no"))
    placed = values.join(at_hand, ["field_name", "game_id", "raw_value"], "left").join(best, "raw_value", "left")
    elsewhere = (F.col("list_score") >= ENOUGH) & (F.col("list_ties") == 1)
    mine = F.col("score").isNotNull() & ~F.coalesce(elsewhere & (F.col("list_score") - F.col("score") > AHEAD), F.lit(False))
    return placed.select("field_name", "game_id", "raw_value", F.when(mine, F.col("team_no")).when(elsewhere, F.col("list_no")).otherwise(0).cast("bigint").alias("team_no"), F.when(mine, F.col("score")).otherwise(F.coalesce("list_score", F.lit(0.0))).alias("score"), mine.alias("of_game"))
