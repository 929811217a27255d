"""Variant spellings of one person's name.

Names are read into given name and surname (order, marks, numbers, suffixes and middle initials aside). A
symmetric-delete index on surnames, and one on their beginnings for cut forms, brings together the names of a group
that can be near; each such pair is judged by the optimal assignment of its tokens, in which initials, short forms of
given names, beginnings and single edits may stand for a token. Names in full are linked first; initials and bare
surnames then join the one person of the group whom they can mean.
"""

from __future__ import annotations

import re
import unicodedata
from itertools import permutations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlog.llm.forms import near, osa
from fieldlog.session import cut

#: Short forms of given names in common use, and the names they stand for (fixed values).
SHORT_FORMS = {
    "alejandro": "alex ale", "alexander": "alex lex xander zander sandy al", "andrew": "andy drew", "anthony": "tony ant", "benjamin": "ben benny benji", "bradley": "brad",
    "cameron": "cam", "charles": "charlie chuck chas chip", "christopher": "chris topher kit", "daniel": "dan danny", "david": "dave davey", "desmond": "des dez", "donald": "don donny",
    "edward": "ed eddie ted ned", "elijah": "eli lije", "emmanuel": "manny manu", "ezekiel": "zeke", "francisco": "frank paco pancho cisco frankie kiko", "frederick": "fred freddy freddie rick",
    "gabriel": "gabe", "george": "geo", "gregory": "greg", "guillermo": "memo guille willy", "ignacio": "nacho iggy", "isaiah": "zay ike izzy", "jacob": "jake coby", "jalen": "jay", "james": "jim jimmy jamie",
    "jason": "jay jase", "jeffrey": "jeff", "jeremiah": "jeremy jerry jem", "john": "jack johnny jon", "jonathan": "jon johnny jonny nathan", "jose": "pepe joe", "joseph": "joe joey jo", "joshua": "josh",
    "kenneth": "ken kenny", "lawrence": "larry law lars", "marcus": "marc mark", "mateo": "teo", "matthew": "matt matty", "maximilian": "max maxi", "michael": "mike mikey mick mickey", "nathaniel": "nate nathan nat",
    "nicholas": "nick nico nicky", "patrick": "pat paddy rick", "peter": "pete", "quentin": "quin quint", "rafael": "rafa rafe", "raymond": "ray", "richard": "rich rick ricky dick", "robert": "rob bob bobby robbie bert",
    "samuel": "sam sammy", "santiago": "santi chago", "sebastian": "seb bas bastian", "stephen": "steve steph stevie", "steven": "steve", "theodore": "ted theo teddy", "thomas": "tom tommy", "timothy": "tim timmy",
    "tobias": "toby", "vincent": "vince vinny vin", "william": "will bill billy willy willie liam", "xavier": "xavi zay", "yusef": "yus", "zachary": "zach zack zac",
}
MEANS: dict[str, set[str]] = {}
for _name, _short in SHORT_FORMS.items():
    for _x in _short.split():
        MEANS.setdefault(_x, set()).add(_name)
PARTICLES = {"de", "la", "las", "los", "del", "van", "von", "der", "den", "st", "di", "da", "le", "el"}
ENDINGS = {"jr", "sr", "ii", "iii", "iv", "v"}
#: Letters beyond which a surname is no name; it is linked by equal spellings only.
LONGEST = 60
#: Letters of a surname that a cut form keeps at least.
KEPT = 4


def plain(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def read_name(name: str | None) -> tuple[str, str, bool]:
    """Given name (or initial, or nothing), surname with its particles, and whether the order is sure; all in lower case."""
    text = plain(name or "").replace("’", "'").strip()
    text = re.sub(r"#\s*\d+", " ", text).strip()
    text = re.sub(r"(?<=[a-z][a-z])(?=[A-Z])", " ", text)
    text = re.sub(r"\.", " ", text.lower())
    parts = [re.sub(r"[^a-z ]+", "", p.replace("-", " ")).split() for p in text.split(",")]
    parts = [[t for t in p if t not in ENDINGS or len(p) == 1 and len(t) > 2] for p in parts]
    parts = [p for p in parts if p]

    def joined(tokens: list[str]) -> list[str]:
        out, hold = [], ""
        for t in tokens:
            if t in PARTICLES and t != tokens[-1]:
                hold += t
            else:
                out.append(hold + t)
                hold = ""
        return out

    if len(parts) >= 2:
        last, first = joined(parts[0]), joined(parts[1])
        return (first[0] if first else ""), "".join(last), True
    tokens = joined(parts[0]) if parts else []
    if len(tokens) > 2:
        tokens = [tokens[0], *(t for t in tokens[1:] if len(t) > 1)]
    if not tokens:
        return "", "", True
    if len(tokens) == 1:  # a bare surname
        return "", tokens[0], True
    if len(tokens[-1]) == 1:  # surname first, then an initial
        return tokens[-1], "".join(tokens[:-1]), True
    return tokens[0], "".join(tokens[1:]), len(tokens[0]) == 1


def given_fit(a: str, b: str, common_a: bool, common_b: bool) -> float:
    """1 for names in full that agree, 0.5 where an initial or nothing stands for one, 0 if they disagree."""
    if not a or not b:
        return 0.5
    if len(a) == 1 or len(b) == 1:
        if a[0] == b[0]:
            return 0.5
        return 0.5 if any(m[0] == min(a, b, key=len) for m in MEANS.get(max(a, b, key=len), ())) else 0.0
    if a == b or MEANS.get(a, {a}) & MEANS.get(b, {b}):
        return 1.0
    for x, y, both in ((a, b, common_a and common_b),):
        if not both and (osa(x, y) <= 1 and min(len(x), len(y)) >= 3):
            return 0.95
        if not both and min(len(x), len(y)) >= 3 and (x.startswith(y) or y.startswith(x)):
            return 0.9
    for short, long in ((a, b), (b, a)):
        if any(near(m, long) for m in MEANS.get(short, ())) and not (common_a and common_b):
            return 0.9
    return 0.0


def surname_fit(a: str, b: str, df_a: float, df_b: float) -> float:
    """1 if equal, less for one edit or a cut form, 0 otherwise. Two surnames that are both frequent are no typos of each other."""
    if a == b:
        return 1.0
    if max(len(a), len(b)) > LONGEST:
        return 0.0
    low, high = sorted((df_a, df_b))
    if low >= 5 and low > 0.2 * high:
        return 0.0
    short, long = sorted((a, b), key=len)
    if len(short) >= 4 and osa(a, b) <= 1:
        return 0.95
    if len(short) >= KEPT and long.startswith(short) and len(short) < len(long):
        return 0.85
    if len(short) >= 8 and osa(a, b) <= 2:
        return 0.8
    return 0.0


def align(a: tuple, b: tuple) -> float:
    """Fit of two names (given, surname, common given, surname frequency) under the best assignment of their tokens.

    1 and a little less: both in full and agreeing; 0.5: an initial or a bare surname that can mean the other; 0: not.
    """
    best = 0.0
    for order in permutations((0, 1)):
        g, s = ((b[0], b[1]), (b[1], b[0]))[order[0]]
        if order[0] and (len(b[0]) < 3 or len(a[0]) < 3):
            continue  # only names in full are tried in the other order
        fit_s = surname_fit(a[1], s, a[3], b[3])
        if fit_s:
            fit_g = given_fit(a[0], g, a[2], b[2])
            if fit_g == 0.5 and fit_s < 0.95:
                continue
            best = max(best, min(fit_g, fit_s) if fit_g >= 0.9 else fit_g)
    return best


def components(nodes: DataFrame, edges: DataFrame, rounds: int = 500) -> DataFrame:
    """Connected components: id, label (least id). ``edges``: a, b. Labels spread and jump until nothing changes.

    Chains halve in each round; should labels still move after ``rounds``, nothing is returned but an error.
    """
    both = cut(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = nodes.select("id", F.col("id").alias("label"))
    linked = cut(both.select(F.col("a").alias("id")).distinct().withColumn("label", F.col("id")))
    for _ in range(rounds):
        offers = both.join(linked.select(F.col("id").alias("b"), "label"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("offer"))
        nearer = linked.join(offers, "id").select("id", F.least("label", "offer").alias("near"), F.col("label").alias("old"))
        jumped = nearer.join(linked.select(F.col("id").alias("near"), F.col("label").alias("far")), "near", "left")
        new = cut(jumped.select("id", F.least("near", F.coalesce("far", "near")).alias("label"), "old"))
        moved = new.where("label <> old").limit(1).count()
        linked = new.select("id", "label")
        if not moved:
            break
    else:
        raise RuntimeError(f"labels still move after {rounds} rounds")
    return labels.join(linked.withColumnRenamed("label", "__new"), "id", "left").select("id", F.coalesce("__new", "label").alias("label"))


def read_columns(name: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([read_name(x) for x in name], columns=["given", "surname", "sure"])


def link_names(rows: DataFrame, key: str, group: list[str], name: str, full: str, hint: str) -> DataFrame:
    """The person of each row: key, person (the least key among the rows of the same person of the group).

    ``name`` is the spelling, ``full`` a name typed by hand for it, believed only where it can mean the spelling, and
    ``hint`` (a position) decides between several persons whom a short form can mean. Null and blank names are persons
    of their own; repeated rows of a spelling belong together; extra columns play no part; a null group is a group.
    """
    base = rows.select(F.col(key).cast("bigint").alias("id"), F.xxhash64(*(F.coalesce(c, F.lit("\0")) for c in group)).alias("grp"), F.col(name).alias("n0"), F.col(full).alias("n1"), F.nullif(F.trim(hint), F.lit("")).alias("hint"))
    base = base.groupBy("id").agg(*(F.min(c).alias(c) for c in ("grp", "n0", "n1", "hint")))
    # One node for each spelling of a group; the rows follow it.
    spelled = base.groupBy("grp", "n0").agg(F.min("id").alias("node"), F.max(F.nullif(F.trim("n1"), F.lit(""))).alias("n1"), F.max("hint").alias("hint"))
    read = F.pandas_udf(read_columns, "given string, surname string, sure boolean")
    parsed = cut(spelled.select("grp", F.col("node").alias("id"), "hint", "n0", read("n0").alias("p"), read("n1").alias("q")))

    # Given names stand first more often than last; that tells the order of unsure ones and which names are common.
    two = parsed.where("NOT p.sure AND p.given <> ''").select(F.col("p.given").alias("first"), F.col("p.surname").alias("last"))
    seen = two.select(F.col("first").alias("token"), F.lit(1).alias("f"), F.lit(0).alias("l")).unionByName(two.select(F.col("last").alias("token"), F.lit(0).alias("f"), F.lit(1).alias("l")))
    seen = seen.unionByName(parsed.where("p.sure AND p.surname <> ''").select(F.col("p.surname").alias("token"), F.lit(0).alias("f"), F.lit(1).alias("l")))
    tokens = seen.groupBy("token").agg(F.sum("f").alias("f"), F.sum("l").alias("l"))
    tokens = cut(tokens.withColumn("lean", F.log((F.col("f") + 0.5) / (F.col("l") + 0.5))))
    n = two.count()
    forms = parsed.select("grp", "id", "hint", F.lit(0).alias("which"), F.col("p.given").alias("given"), F.col("p.surname").alias("surname"), F.col("p.sure").alias("sure")).unionByName(
        parsed.where("q.surname <> ''").select("grp", "id", "hint", F.lit(1).alias("which"), F.col("q.given").alias("given"), F.col("q.surname").alias("surname"), F.col("q.sure").alias("sure"))
    )
    forms = forms.where("surname <> ''")
    lean = lambda c, x: tokens.select(F.col("token").alias(c), F.col("lean").alias(f"{x}_lean"), F.col("f").alias(f"{x}_f"), F.col("l").alias(f"{x}_l"))
    forms = forms.join(lean("given", "g"), "given", "left").join(lean("surname", "s"), "surname", "left").na.fill(0, ["g_lean", "s_lean", "g_f", "g_l", "s_f", "s_l"])
    turn = ~F.col("sure") & (F.col("s_lean") > F.col("g_lean") + 1)
    many = 3 + 0.0005 * n
    forms = forms.select(
        "grp", "id", "hint", "which", F.when(turn, F.col("surname")).otherwise(F.col("given")).alias("given"), F.when(turn, F.col("given")).otherwise(F.col("surname")).alias("surname"),
        (F.when(turn, F.col("s_f")).otherwise(F.col("g_f")) >= many).alias("common"), F.when(turn, F.col("g_l")).otherwise(F.col("s_l")).cast("double").alias("df"),
    )
    # A name typed by hand counts only where it can mean the spelling itself.
    packed = forms.groupBy("grp", "id", "hint").agg(F.max(F.when(F.col("which") == 0, F.struct("given", "surname", "common", "df"))).alias("a"), F.max(F.when(F.col("which") == 1, F.struct("given", "surname", "common", "df"))).alias("b"))

    def fit(x: pd.DataFrame, y: pd.DataFrame) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=float)
        cols = lambda d: list(zip(d["given"], d["surname"], d["common"], d["df"], strict=True))
        return pd.Series([0.0 if p[1] is None or q[1] is None else align(p, q) for p, q in zip(cols(x), cols(y), strict=True)], dtype=float)

    fits = F.pandas_udf(fit, "double")
    packed = packed.where("a IS NOT NULL").withColumn("ok", F.when(F.col("b").isNotNull(), fits("a", F.coalesce("b", "a"))).otherwise(0.0))
    nodes = cut(packed.select("grp", "id", "hint", "a", F.when(F.col("ok") > 0, F.col("b")).alias("b")))
    kept = nodes.select("grp", "id", "hint", F.explode(F.array_compact(F.array("a", "b"))).alias("x")).select("grp", "id", "hint", "x", F.length("x.given").alias("g"))
    kept = kept.dropDuplicates(["id", "x"])

    # Symmetric deletes of the surname, and its beginning for cut forms. The index holds numbers only; the names join the
    # pairs that come out of it.
    shorter = lambda c: f"CASE WHEN length({c}) BETWEEN 4 AND {LONGEST} THEN transform(sequence(1, length({c})), i -> concat(substr({c}, 1, i - 1), substr({c}, i + 1))) ELSE array() END"
    bare = "'^(dela|del|de|van|von|st|la)', ''"
    keys = lambda c: f"concat(array({c}, regexp_replace({c}, {bare}), concat('^', substr({c}, 1, {KEPT}))), {shorter(c)})"
    two = lambda f, c: F.explode(F.expr(f"array_distinct(concat({f('a.' + c)}, coalesce({f('b.' + c)}, array())))"))
    index = nodes.select("id", "grp", two(keys, "surname").alias("reduced")).select("id", F.xxhash64("grp", "reduced").alias("at"))
    right = index.select(F.col("id").alias("id2"), "at")
    # A given name of one that is the surname of another shows a turned order.
    turned = nodes.select("id", "grp", two(lambda c: f"concat(array({c}), {shorter(c)})", "given").alias("reduced")).where("length(reduced) > 1").select("id", F.xxhash64("grp", "reduced").alias("at"))
    met = index.join(right, "at").where("id < id2").select("id", "id2").unionByName(turned.join(right, "at").where("id <> id2").select(F.least("id", "id2").alias("id"), F.greatest("id", "id2").alias("id2")))
    pairs = met.distinct()

    def best_fit(a: pd.DataFrame, b: pd.DataFrame, c: pd.DataFrame, d: pd.DataFrame) -> pd.Series:
        cols = lambda t: list(zip(t["given"], t["surname"], t["common"], t["df"], strict=True)) if len(t) else []
        rows = zip(cols(a), cols(b), cols(c), cols(d), strict=True)
        return pd.Series([max(align(p, q) for p in {w, x} if isinstance(p[1], str) for q in {y, z} if isinstance(q[1], str)) for w, x, y, z in rows], dtype=float)

    named = nodes.select("id", "a", F.coalesce("b", "a").alias("b"))
    other = named.select(F.col("id").alias("id2"), F.col("a").alias("a2"), F.col("b").alias("b2"))
    judged = pairs.join(named, "id").join(other, "id2").select("id", "id2", F.pandas_udf(best_fit, "double")("a", "b", "a2", "b2").alias("fit"))
    judged = cut(judged.where("fit > 0"))

    strong = judged.where("fit >= 0.8").select(F.col("id").alias("a"), F.col("id2").alias("b"))
    persons = cut(components(nodes, strong))
    full_name = kept.groupBy("id").agg(F.max("g").alias("g"), F.max("hint").alias("hint"))
    info = cut(persons.join(full_name, "id"))

    # A short form joins the one person in full whom it can mean; the hint decides between several.
    weak = judged.where("fit < 0.8")
    ends = weak.select("id", F.col("id2").alias("other")).unionByName(weak.select(F.col("id2").alias("id"), F.col("id").alias("other")))
    short = info.where("g < 2").select("id", F.col("hint").alias("my_hint"))
    anchors = ends.join(short, "id").join(info.where("g >= 2").select(F.col("id").alias("other"), "label", F.col("hint").alias("its_hint")), "other")
    anchors = anchors.groupBy("id", "label").agg(F.max(F.when(F.col("my_hint") == F.col("its_hint"), 1).otherwise(0)).alias("same"))
    choice = anchors.groupBy("id").agg(F.count("*").alias("n"), F.min("label").alias("one"), F.sum("same").alias("n_same"), F.max(F.when(F.col("same") == 1, F.col("label"))).alias("hinted"))
    choice = cut(choice.withColumn("to", F.when(F.col("n") == 1, F.col("one")).when(F.col("n_same") == 1, F.col("hinted"))))
    joins = choice.where("to IS NOT NULL").select(F.col("id").alias("a"), F.col("to").alias("b"))
    # Short forms without any person in full belong to each other.
    alone = short.join(choice.select("id"), "id", "left_anti")
    loose = weak.join(alone.select("id"), "id", "left_semi").join(alone.select(F.col("id").alias("id2")), "id2", "left_semi").select(F.col("id").alias("a"), F.col("id2").alias("b"))
    final = components(nodes, strong.unionByName(joins).unionByName(loose))
    of_node = spelled.select("grp", "n0", "node").join(final.select(F.col("id").alias("node"), "label"), "node", "left").select("grp", "n0", F.coalesce("label", "node").alias("person"))
    named = base.where("trim(n0) <> ''").join(of_node, ["grp", "n0"]).select("id", "person")
    unnamed = base.where("n0 IS NULL OR trim(n0) = ''").select("id", F.col("id").alias("person"))
    return named.unionByName(unnamed)


def person_pairs(persons: DataFrame) -> DataFrame:
    """Every pair of keys of one person, the lesser first."""
    other = persons.select(F.col("id").alias("id2"), F.col("person").alias("person2"))
    return persons.join(other, (F.col("person") == F.col("person2")) & (F.col("id") < F.col("id2"))).select("id", "id2")
