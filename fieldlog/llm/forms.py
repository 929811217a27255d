"""What people type for a club: whole names, parts, codes, and how a typed form relates to a name."""

from __future__ import annotations

import re
from functools import lru_cache

VOWELS = set("AEIOUY")
#: Words that crews add to a club's name.
SUFFIXES = ("COLLEGE", "CC")


@lru_cache(200_000)
def words(text: str | None) -> tuple[str, ...]:
    """Upper-case words without dots, apostrophes and other marks."""
    return tuple(re.sub(r"[^\w ]+", "", (text or "").upper().replace("-", " ")).split())


def osa(a: str, b: str, most: int = 3) -> int:
    """Edit distance with swaps of neighbours; beyond ``most`` any greater number."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            d = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, older[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
    return row[-1]


def prefix_edits(a: str, b: str) -> tuple[int, int]:
    """Least edits that make ``a`` a beginning of ``b``, and the length of that beginning (the longest on ties)."""
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            d = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, older[j - 2] + 1)
            row.append(d)
    best = min(row)
    return best, max(j for j, d in enumerate(row) if d == best)


def near(a: str, b: str) -> bool:
    """Equal but for typos: one edit in words of four letters or more, two from nine on."""
    return a == b or (min(len(a), len(b)) >= 4 and osa(a, b) <= (2 if len(b) >= 9 else 1))


def skeleton(word: str) -> str:
    """The first letter and the consonants after it."""
    return word[:1] + "".join(c for c in word[1:] if c not in VOWELS)


@lru_cache(50_000)
def codes(name: str | None) -> frozenset[str]:
    """Short codes in use for a club's name: initials with or without added C's, consonant forms and their mixtures."""
    w = words(name)
    if not w:
        return frozenset()
    initials, bones = "".join(x[0] for x in w), [skeleton(x) for x in w]
    whole, first = skeleton("".join(w)), bones[0]
    out = {initials + c for c in ("", "C", "CC")} | {whole, first} | {first[:k] + "C" for k in (2, 3)} | {first[:k] for k in (3, 4)}
    out |= {first[:k] + x[:m] for k in (2, 3, 4) for m in (1, 2, 3) for x in w[1:]} | {whole + c for c in ("C", "CC")}
    return frozenset(out - {""})
