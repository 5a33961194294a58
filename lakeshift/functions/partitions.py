"""Partition strings (``k=v/k2=v2``): values, filter expressions and predicates."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeshift.functions.cells import bound, col, last_of_key, strip

# Fixed formats of the filter language.
LAST_N = r"^last_n_partitions=([0-9]+)$"
COMPARISON = r"^([a-zA-Z_][a-zA-Z0-9_]*)(>=|<=|>|<)(.+)$"
INTEGER = r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$"
# Fixed value: how a folder names a null partition value.
HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"


def url_decode(c: Column) -> Column:
    """Percent-decoding that leaves ``+`` and stray ``%`` alone, as path segments need."""
    safe = F.regexp_replace(F.replace(c, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.url_decode(safe)


def _segments(part: Column) -> Column:
    return F.filter(F.split(part, "/"), lambda s: s.contains("="))


def _segment_key(s: Column) -> Column:
    return strip(F.substring_index(s, "=", 1))


def _segment_value(s: Column) -> Column:
    return url_decode(strip(F.substr(s, F.instr(s, "=") + 1)))


def partition_map(part: Column | str) -> Column:
    """Partition string -> map of decoded values (the first ``=`` of a segment splits; the last of equal keys wins)."""
    entries = F.transform(
        _segments(col(part)),
        lambda s: F.struct(_segment_key(s).alias("key"), _segment_value(s).alias("value")),
    )
    return F.map_from_entries(last_of_key(entries))


def partition_value(part: Column | str, key: Column | str) -> Column:
    """Decoded value of one key, null when the key is absent (last occurrence wins)."""
    key = F.lit(key) if isinstance(key, str) else key
    hit = F.filter(_segments(col(part)), lambda s: _segment_key(s) == key)
    return bound(F.try_element_at(hit, F.lit(-1)), _segment_value)


def filter_terms(expr: str | None) -> list[str]:
    return [t.strip() for t in (expr or "").split(",") if t.strip()]


def last_n_of(terms: Sequence[str]) -> int:
    """Largest ``last_n_partitions`` count among the terms; 0 when there is none."""
    found = [re.match(LAST_N, t) for t in terms]
    return max((int(m.group(1)) for m in found if m), default=0)


def _as_integer(v: Column) -> Column:
    digits = F.replace(strip(v), F.lit("_"), F.lit(""))
    return F.when(v.rlike(INTEGER), digits.try_cast("decimal(38,0)"))


def _compare(op: Column, a: Column, b: Column) -> Column:
    return (
        F.when(op == ">=", a >= b).when(op == "<=", a <= b).when(op == ">", a > b).when(op == "<", a < b)
    )


def term_matches(part: Column, term: Column) -> Column:
    """One filter term against one partition string; ``last_n`` terms never match here.

    ``term`` may be a literal (it folds away) or a column, so a control sheet can carry a
    different filter per table.
    """
    is_comparison = term.rlike("[<>]")
    is_wildcard = ~is_comparison & term.endswith("*")
    prefix = F.rtrim(F.rtrim(term, F.lit("*")), F.lit("/"))

    key, op = F.regexp_extract(term, COMPARISON, 1), F.regexp_extract(term, COMPARISON, 2)
    raw = strip(F.regexp_extract(term, COMPARISON, 3))
    threshold = F.rtrim(raw, F.lit("*"))
    value = partition_value(part, key)
    shown = F.when(raw.endswith("*"), F.left(value, F.length(threshold))).otherwise(value)
    left_int, right_int = _as_integer(shown), _as_integer(threshold)
    compared = F.when(
        left_int.isNotNull() & right_int.isNotNull(), _compare(op, left_int, right_int)
    ).otherwise(_compare(op, shown, threshold))

    return F.coalesce(
        F.when(term.rlike(LAST_N), False)
        .when(is_wildcard, part.startswith(prefix))
        .when(~is_comparison, part == term)
        .otherwise(compared),
        F.lit(False),
    )


def matches_filter(part: Column | str, expr: str | Column) -> Column:
    """OR of all terms except ``last_n``; an empty filter matches everything."""
    part = col(part)
    if isinstance(expr, Column):
        terms = F.filter(F.transform(F.split(F.coalesce(expr, F.lit("")), ","), strip), lambda t: t != "")
        return (F.size(terms) == 0) | F.exists(terms, lambda t: term_matches(part, t))
    terms = filter_terms(expr)
    if not terms:
        return F.lit(True)
    return reduce(lambda a, b: a | b, [term_matches(part, F.lit(t)) for t in terms])


def partitions_predicate(parts: Sequence[str]) -> Column:
    """Listed partitions as a prunable predicate: AND inside a partition, OR across them.

    Meant for a handful of partitions (it prunes directories); for long lists use
    ``operators.partitions.keep_partitions``, which joins.
    """
    if not parts:
        return F.lit(False)
    clauses = []
    for part in parts:
        pairs = [s.split("=", 1) for s in part.split("/") if "=" in s]
        if pairs:
            clauses.append(
                reduce(lambda a, b: a & b, [F.col(f"`{k.strip()}`") == unquote(v.strip()) for k, v in pairs])
            )
    return reduce(lambda a, b: a | b, clauses) if clauses else F.lit(True)


def filter_active(expr, matched, total, is_partitioned) -> Column:
    """A filter counts only when set, narrowing, and the table is partitioned."""
    return (
        (F.coalesce(col(expr), F.lit("")) != "")
        & col(is_partitioned)
        & (col(matched) < col(total))
    )
