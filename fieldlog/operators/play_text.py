"""Play text to columns: an ordered list of rules, the first of which that fits decides.

The rules are kept as SQL text built for an engine, so that the same list runs as Column expressions here and as plain
SQL where it is checked. Regular expressions use only what Java and RE2 read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Formats of the play-by-play text (fixed values).
W = r"[\p{L}\d_]"
NAME = rf"({W}[\p{{L}}\d_\s\-\x27.]+?)"
TEAM = r"((?:[A-Z]+\s+)*[A-Z]+)"
SPOT = r"([A-Z][A-Z0-9\s.\-_]*?\d+)"
RULES: dict[str, list[str]] = {
    "sack": [rf"(?i){NAME}\s+sacked for", rf"(?i){NAME}\s+sacked to\s+{W}[\p{{L}}\d_\s\-\x27.]+?\s+for loss of"],
    "field_goal": [rf"(?i){NAME}\s+field goal attempt from\s+\d+\s+(GOOD|MISSED)"],
    "blocked": [rf"(?i){NAME}\s+field goal attempt from \d+\s+BLOCKED"],
    "pat": [rf"(?i){NAME}\s+kick attempt\s+(GOOD|FAILED)"],
    "two_point": [rf"(?i){NAME}\s+(rush|pass)\s+attempt\s+(good|failed)"],
    "kickoff": [rf"(?i){NAME}\s+kickoff\s+(\d+)\s+yards"],
    "punt": [rf"(?i){NAME}\s+punt(?:\s+(\d+)\s+yards)?"],
    "intercepted": [rf"(?i){NAME}\s+pass intercept"],
    "complete": [rf"(?i){NAME}\s+pass complete to\s+{NAME}\s+for"],
    "complete_open": [rf"(?i){NAME}\s+pass complete(?:\s+for|\s+to)"],
    "incomplete": [rf"(?i){NAME}\s+pass incomplete(?:\s+to\s+{NAME})?(?:\s*[,(]|\.|$)"],
    "pass_try": [rf"(?i){NAME}\s+pass attempt to\s+{NAME}\s+(good|failed)"],
    "rush": [rf"(?i){NAME}\s+rush for"],
}
PENALTY_NAMED = rf"PENALTY\s+{TEAM}\s+([a-z][\p{{L}}\d_\s]*?)\s*\(([^)]+)\)\s+(\d+)\s+yards"
PENALTY_ANON = rf"PENALTY\s+{TEAM}\s+([a-z][\p{{L}}\d_\s]+?)\s+(\d+)\s+yards"
FUMBLE = rf"(?i)fumble by\s+{NAME}\s+recovered by\s+([A-Z][A-Z0-9.\-_]*(?:\s+[A-Z][A-Z0-9.\-_]*)*)\s+([A-Z][a-z][\p{{L}}\d_\s\-\x27.]+?)\s+at\s+{SPOT}"
YARDS = r"(?i)for\s+(loss of\s+)?(\d+)\s+yards?"
TACKLERS = r"\(([^()]+)\)\s*\.?\s*$"
LAST_FIRST = r"(\p{Lu}[\p{L}\-\x27]+),(\p{Lu}[\p{L}\-\x27]+)"

#: Words without which a rule can't fit, in small letters: looked for before its pattern is tried.
NEEDED = {"sack": "sacked", "field_goal": "field goal attempt", "blocked": "field goal attempt", "pat": "kick attempt", "two_point": " attempt", "kickoff": " kickoff", "punt": " punt", "intercepted": "pass intercept", "complete": "pass complete to", "complete_open": "pass complete", "incomplete": "pass incomplete", "pass_try": "pass attempt to", "rush": "rush for"}

PASSES = "('sack', 'intercepted', 'complete', 'complete_open', 'incomplete')"
TRIES = "('pat', 'two_point', 'pass_try')"


class Steps:
    """The steps of parsing as lists of (column, SQL); ``quote`` writes a pattern as a literal of the engine."""

    def __init__(self, spark: bool) -> None:
        self.spark = spark
        self.quote = (lambda p: f"r'{p}'") if spark else (lambda p: f"'{p}'")
        self.all = "" if spark else ", 'g'"
        self.swap = "'$2 $1'" if spark else "'\\2 \\1'"

    def x(self, p: str, g: int = 0) -> str:
        return f"regexp_extract(t, {self.quote(p)}, {g})"

    def has(self, p: str, needed: str = "") -> str:
        """Whether a pattern fits. Spark looks for the words it needs first, and for nothing else if that is all of the pattern."""
        if self.spark and p == f"(?i){needed}":
            return f"contains(l, '{needed}')"
        return (f"contains(l, '{needed}') AND " if self.spark and needed else "") + f"{self.x(p)} <> ''"

    def text(self, column: str) -> str:
        q = self.quote
        t = f"replace(replace(replace(coalesce({column}, ''), '&amp;', '&'), '&nbsp;', ' '), chr(160), ' ')"
        t = f"trim(regexp_replace({t}, {q(chr(92) + 's+')}, ' '{self.all}))"
        t = f"regexp_replace({t}, {q(r' +([,.;)])')}, {self.quote('$1') if self.all == '' else chr(39) + chr(92) + '1' + chr(39)}{self.all})"
        return f"regexp_replace({t}, {q(LAST_FIRST)}, {self.swap}{self.all})"

    def first(self) -> list[tuple[str, str]]:
        rule = "CASE " + " ".join(f"WHEN {' OR '.join(self.has(p, NEEDED[k]) for p in ps)} THEN '{k}'" for k, ps in RULES.items()) + " END"
        return [("rule", rule), ("named", self.has(PENALTY_NAMED, "penalty")), ("anon", self.has(PENALTY_ANON, "penalty")), ("fumbled", self.has(FUMBLE, "fumble by"))]

    def found(self) -> list[tuple[str, str]]:
        """What the rule's pattern holds, each taken once: groups one and two, the way of a try, yards, who tackled, touchdowns."""
        x = self.x
        group = lambda g, kinds=None: "CASE rule " + " ".join(f"WHEN '{k}' THEN " + (f"coalesce(nullif({x(ps[0], g)}, ''), {x(ps[1], g)})" if len(ps) > 1 else x(ps[0], g)) for k, ps in RULES.items() if kinds is None or k in kinds) + " END"
        yards = f"CASE WHEN {self.has('(?i)for no gain', 'for no gain')} THEN 0 WHEN {self.has(YARDS, 'yard')} THEN CASE WHEN {x(YARDS, 1)} <> '' THEN -1 ELSE 1 END * CAST({x(YARDS, 2)} AS INT) END"
        tackled = "rule IN ('sack', 'intercepted', 'complete', 'complete_open', 'incomplete', 'pass_try', 'rush')"
        return [
            ("g1", f"trim({group(1)})"),
            ("g2", f"trim({group(2, ('complete', 'incomplete', 'pass_try', 'two_point', 'kickoff', 'punt', 'field_goal', 'pat'))})"),
            ("yards", yards),
            ("who", f"CASE WHEN {tackled} THEN {x(TACKLERS, 1)} ELSE '' END"),
            ("td", self.has("(?i)touchdown", "touchdown")),
        ]

    def columns(self) -> list[tuple[str, str]]:
        x = self.x
        clean = lambda e: f"nullif(CASE WHEN upper({e}) = 'TEAM' THEN '' ELSE {e} END, '')"
        actor, td, yards = clean("g1"), "td", "yards"
        digits = lambda p, g: f"CAST(nullif({x(p, g)}, '') AS INT)"
        whole = "CAST(nullif(g2, '') AS INT)"
        one, two = "trim(split_part(who, ';', 1))", "trim(split_part(who, ';', 2))"
        first = f"CASE WHEN upper({one}) = 'TEAM' THEN {two} ELSE {one} END"
        second = f"CASE WHEN upper({one}) = 'TEAM' OR upper({two}) = 'TEAM' THEN '' ELSE {two} END"
        return [
            ("play_type", f"CASE WHEN rule IN {PASSES} THEN 'pass' WHEN rule = 'blocked' THEN 'field_goal' WHEN rule = 'pass_try' THEN 'two_point' WHEN rule IS NULL THEN CASE WHEN named OR anon THEN 'penalty' END ELSE rule END"),
            ("passer", f"CASE WHEN rule IN ('sack', 'intercepted', 'complete', 'complete_open', 'incomplete', 'pass_try') OR (rule = 'two_point' AND lower(g2) = 'pass') THEN {actor} END"),
            ("rusher", f"CASE WHEN rule IN ('field_goal', 'blocked', 'pat', 'kickoff', 'punt', 'rush') OR (rule = 'two_point' AND lower(g2) = 'rush') THEN {actor} END"),
            ("receiver", f"CASE WHEN rule IN ('complete', 'incomplete', 'pass_try') THEN {clean('g2')} WHEN rule = 'two_point' AND lower(g2) = 'pass' THEN 'TEAM' END"),
            ("pass_result", "CASE rule WHEN 'intercepted' THEN 'int' WHEN 'complete' THEN 'complete' WHEN 'complete_open' THEN 'complete' WHEN 'incomplete' THEN 'incomplete' END"),
            ("yards_gained", f"CASE WHEN rule IN ('sack', 'complete', 'complete_open', 'rush') THEN {yards} WHEN rule IN ('intercepted', 'incomplete', 'two_point', 'pass_try') THEN 0 WHEN rule = 'kickoff' THEN {whole} WHEN rule = 'punt' THEN coalesce({whole}, {yards}) END"),
            ("is_dropback", f"coalesce(rule IN {PASSES}, FALSE)"),
            ("is_pass_attempt", "coalesce(rule IN ('intercepted', 'complete', 'complete_open', 'incomplete'), FALSE)"),
            ("is_rush_attempt", "coalesce(rule IN ('sack', 'rush'), FALSE)"),
            ("is_conversion", f"coalesce(rule IN {TRIES}, FALSE)"),
            ("completion", "coalesce(rule IN ('complete', 'complete_open'), FALSE)"),
            ("is_interception", "coalesce(rule = 'intercepted', FALSE)"),
            ("is_sack", "coalesce(rule = 'sack', FALSE)"),
            ("is_td", f"({td}) AND NOT ({self.has('(?i)intercept', 'intercept')}) AND NOT (coalesce(rule = 'rush', FALSE) AND fumbled)"),
            ("is_defensive_td", f"coalesce(rule = 'intercepted', FALSE) AND ({td})"),
            ("is_safety", f"({self.has('(?i)' + chr(92) + 'bsafety' + chr(92) + 'b', 'safety')})"),
            ("is_fumble", "fumbled"),
            ("fumble_recovered_by", f"nullif(upper(trim({x(FUMBLE, 2)})), '')"),
            ("is_penalty", "named OR anon"),
            ("penalty_team", f"nullif(upper(trim(CASE WHEN named THEN {x(PENALTY_NAMED, 1)} ELSE {x(PENALTY_ANON, 1)} END)), '')"),
            ("penalty_type", f"nullif(lower(trim(CASE WHEN named THEN {x(PENALTY_NAMED, 2)} ELSE {x(PENALTY_ANON, 2)} END)), '')"),
            ("penalty_player", f"CASE WHEN named THEN nullif(trim({x(PENALTY_NAMED, 3)}), '') END"),
            ("penalty_yards", f"CASE WHEN named THEN {digits(PENALTY_NAMED, 4)} WHEN anon THEN {digits(PENALTY_ANON, 3)} END"),
            ("fg_result", f"CASE rule WHEN 'blocked' THEN 'blocked' WHEN 'field_goal' THEN lower(g2) WHEN 'pat' THEN lower(g2) WHEN 'two_point' THEN lower({x(RULES['two_point'][0], 3)}) WHEN 'pass_try' THEN lower({x(RULES['pass_try'][0], 3)}) END"),
            ("tackler_1", f"nullif({first}, '')"),
            ("tackler_2", f"nullif({second}, '')"),
        ]


PARSED = [k for k, _ in Steps(True).columns()]


def parse_plays(rows: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` and the parsed columns of each text; a null text parses to no play type."""
    s = Steps(spark=True)
    t = rows.select(*keep, F.expr(s.text(text)).alias("t"))
    t = t.withColumn("l", F.lower("t"))
    t = t.select("*", *(F.expr(v).alias(k) for k, v in s.first()))
    t = t.select("*", *(F.expr(v).alias(k) for k, v in s.found()))
    return t.select(*keep, *(F.expr(v).alias(k) for k, v in s.columns()))


def patched(old: str, new: str) -> F.Column:
    """The new value where it says something else than the old one, else the old one."""
    return F.when((F.col(new) != "") & ~F.col(new).eqNullSafe(F.col(old)), F.col(new)).otherwise(F.col(old))
