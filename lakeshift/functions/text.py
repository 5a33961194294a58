"""Regex matching with a cheap literal test in front.

A regex match decodes the whole string into a Java String first; a literal search works on the
bytes. Most lines hold none of the words a rule is about, so the literal test answers for them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence
from functools import reduce
from re import _constants as ops
from re import _parser as parser

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters beyond lower() that ignore-case matching treats as i, s or k.
FOLD_FROM, FOLD_TO = "İıſK", "iisk"


def required_literals(pattern: str, flags: int = 0) -> list[str]:
    """Texts of which at least one occurs in every match; empty when the pattern promises none.

    A pattern that turns ignore-case on for itself or a part of it promises none unless ``flags`` say so too."""
    if not flags & re.IGNORECASE and re.search(r"\(\?[a-zA-Z]*i", pattern):
        return []
    return _required(parser.parse(pattern, flags)) or []


def _required(tokens) -> list[str] | None:
    """Best set of alternatives found in a sequence: the one whose shortest text is longest."""
    best: list[str] | None = None
    run = ""

    def offer(found: list[str] | None) -> None:
        nonlocal best
        if found and (best is None or min(map(len, found)) > min(map(len, best))):
            best = found

    for op, arg in tokens:
        if op is ops.LITERAL:
            run += chr(arg)
            continue
        offer([run] if run else None)
        run = ""
        if op is ops.SUBPATTERN:
            offer(_required(arg[3]))
        elif op in (ops.MAX_REPEAT, ops.MIN_REPEAT) and arg[0] > 0:
            offer(_required(arg[2]))
        elif op is ops.BRANCH:
            sides = [_required(b) for b in arg[1]]
            offer([x for s in sides for x in s] if all(sides) else None)
    offer([run] if run else None)
    return best


def folded(c: Column) -> Column:
    """Text as ignore-case matching sees it."""
    # characters are looked up one by one, which texts of single-byte characters do not need
    return F.lower(F.when(F.octet_length(c) == F.length(c), c).otherwise(F.translate(c, FOLD_FROM, FOLD_TO)))


#: Length of the shortest text that stands for a group of words.
SHORTEST_PART = 3


def shared_parts(words_of: Sequence[Sequence[str]]) -> list[tuple[str | None, list[int]]]:
    """(part, numbers) groups: ``part``, in lower case, stands in every word of every entry numbered; None for entries that share none.

    Where a lower-cased text lacks the part, none of the group's words is in it: one test answers for the group.
    """
    def parts(words: Sequence[str]) -> set[str]:
        if not words or not all(w.isascii() for w in words):
            return set()
        low = [w.lower() for w in words]
        first = min(low, key=len)
        found = {first[i:j] for i in range(len(first)) for j in range(i + SHORTEST_PART, len(first) + 1)}
        return {p for p in found if all(p in w for w in low)}

    left = {n: parts(words) for n, words in enumerate(words_of)}
    groups: list[tuple[str | None, list[int]]] = []
    while True:
        counts = Counter(p for ps in left.values() for p in ps)
        # many entries, but also a long part, which fewer texts hold by chance
        best = max((p for p in counts if counts[p] > 1), key=lambda p: ((counts[p] - 1) * min(len(p), 8), p), default=None)
        if best is None:
            break
        groups.append((best, [n for n, ps in left.items() if best in ps]))
        left = {n: ps for n, ps in left.items() if best not in ps}
    return [*groups, (None, list(left))] if left else groups


def may_match(c: Column, pattern: str, ignore_case: bool = False, fold: Column | None = None) -> Column:
    """False only where no part of ``c`` can match: a literal test, true throughout where the pattern promises no literal."""
    words = required_literals(pattern, re.IGNORECASE if ignore_case else 0)
    if not words:
        return F.lit(True)
    if ignore_case:
        seen = folded(c) if fold is None else fold
        tests = [seen.contains(w.translate(str.maketrans(FOLD_FROM, FOLD_TO)).lower()) for w in words]
    else:
        tests = [c.contains(w) for w in words]
    return reduce(lambda a, b: a | b, tests)


def matches(c: Column, java_pattern: str, pattern: str, ignore_case: bool = False, fold: Column | None = None) -> Column:
    """``c`` matches ``java_pattern``; ``pattern`` is the same without inline flags."""
    found = c.rlike(java_pattern)
    return may_match(c, pattern, ignore_case, fold) & found if required_literals(pattern, re.IGNORECASE if ignore_case else 0) else found
