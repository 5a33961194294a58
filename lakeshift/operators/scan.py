"""Rule scan of source text held in a DataFrame of (path, content).

Both passes work inside the row of a file and read it once: no shuffle, no (rule x line) join. Patterns are literals,
so each is compiled once per task. Only the syntax check of Python files leaves the JVM.
"""

from __future__ import annotations

import ast
import re
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshift.functions.cells import bound, strip
from lakeshift.functions.text import folded, matches, may_match, required_literals, shared_parts
from lakeshift.rules.model import CATEGORIES, SEVERITIES, Rule
from lakeshift.sources.scratch import stored

HITS = "path string, line_number int, rule_id string, line_text string"
# Characters that end a line, as Python's str.splitlines sees them.
LINE_ENDS = r"\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028-\u2029"
# A run of other characters is followed by a line end or nothing, so no match ever goes back.
LINE_WITH_END = rf"[^{LINE_ENDS}]+(?:\r\n|[{LINE_ENDS}]|\z)|\r\n|[{LINE_ENDS}]"


def split_lines(content: Column | str) -> Column:
    """Lines with their line ends; a final line end opens no further line."""
    content = F.col(content) if isinstance(content, str) else content
    return F.regexp_extract_all(content, F.lit(LINE_WITH_END), F.lit(0))


def line_count(content: Column | str) -> Column:
    content = F.col(content) if isinstance(content, str) else content
    return F.regexp_count(content, F.lit(LINE_WITH_END))


def path_matches(path: Column, extensions: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [path.endswith(e) for e in extensions])


def executable_lines() -> Callable[[Column], Column]:
    """Pandas UDF: per line, whether a syntax node covers it; null for a text that does not parse.

    The functions below are nested so that they travel to the workers by value and need no package
    installed there.
    """
    def flags_of(text: str | None) -> list[bool] | None:
        if text is None:
            return None
        try:
            tree = ast.parse(text)
        except (SyntaxError, ValueError, RecursionError, MemoryError):
            return None
        flags = [False] * (len(text.splitlines()) + 1)
        for node in ast.walk(tree):
            first = getattr(node, "lineno", None)
            if first is not None:
                last = min(getattr(node, "end_lineno", None) or first, len(flags))
                flags[first - 1 : last] = [True] * (last - first + 1)
        return flags

    def parse(source: pd.Series) -> pd.Series:
        return source.map(flags_of)

    return F.pandas_udf(parse, T.ArrayType(T.BooleanType()))


def _gates(rules: Iterable[Rule]) -> dict[tuple[str, ...], str]:
    """Column name per distinct set of extensions."""
    return {e: f"_gate{i}" for i, e in enumerate(dict.fromkeys(r.extensions for r in rules))}


def _gated(corpus: DataFrame, gates: dict[tuple[str, ...], str]) -> DataFrame:
    """Files some rule looks at, with one flag per set of extensions, tested once per file."""
    flagged = corpus.withColumns({name: path_matches(F.col("path"), e) for e, name in gates.items()})
    return flagged.where(reduce(lambda a, b: a | b, [F.col(g) for g in gates.values()]))


#: Values that a running total goes through one by one; longer lists are totals of such blocks.
BLOCK = 256


def running_totals(values: Column) -> Column:
    """The sum of each value and all before it, for a list of any length.

    A list that grows by one is copied, so totals are taken within blocks, and block totals over blocks.
    """
    totals = "struct<total:bigint,list:array<bigint>>"
    start = F.struct(F.lit(0).cast("bigint").alias("total"), F.array().cast("array<bigint>").alias("list")).cast(totals)

    def grow(state: Column, x: Column) -> Column:
        return F.struct((state["total"] + x).alias("total"), F.array_append(state["list"], state["total"] + x).alias("list")).cast(totals)

    def of_blocks(inner: Column) -> Column:
        begins = F.aggregate(F.transform(inner, lambda x: x["total"]), start, grow)["list"]
        return F.flatten(F.transform(inner, lambda x, i: F.transform(x["list"], lambda v: v + F.get(begins, i) - x["total"])))

    def of(values: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int"))
        inner = F.transform(numbers, lambda b: F.aggregate(F.slice(values, b * BLOCK + 1, BLOCK), start, grow))
        return F.when(F.size(values) == 0, F.array().cast("array<bigint>")).otherwise(bound(inner, of_blocks))

    return bound(F.transform(values, lambda x: x.cast("bigint")), of)


HIT = "array<struct<line_number:int,rule:int,line_text:string>>"


def text_hits(content: Column, rule: Rule, number: int) -> Column:
    """Matches of a pattern that may span lines, with the line on which each begins; the first of a line counts.

    Each match is taken together with the gap before it (``\\G`` ties it to the end of the last one, so a text is gone
    through once), and line numbers are running totals of the line ends in gaps and matches.
    """
    pattern = F.lit(f"(?Uds{rule.flags})\\G(.*?)({rule.pattern})")

    def ends(x: Column) -> Column:
        return F.length(x) - F.length(F.replace(x, F.lit("\n"), F.lit("")))

    def hits(found: Column, lines: Column) -> Column:
        rows = F.transform(
            found, lambda m, i: F.struct((F.get(lines, i) + 1).cast("int").alias("line_number"), F.lit(number).alias("rule"), F.replace(m, F.lit("\n"), F.lit(" ")).alias("line_text"))
        )
        return F.filter(rows, lambda r, i: (i == 0) | (F.get(lines, i) != F.get(lines, i - 1)))

    def of(found: Column) -> Column:
        gaps = F.regexp_extract_all(content, pattern, F.lit(1))
        before = F.slice(F.concat(F.array(F.lit("")), found), F.lit(1), F.size(found))
        steps = F.zip_with(gaps, before, lambda g, m: ends(g) + ends(m))
        return bound(running_totals(steps), lambda lines: hits(found, lines))

    return bound(F.regexp_extract_all(content, pattern, F.lit(2)), of).cast(HIT)


def _check_spanning(rule: Rule) -> None:
    if re.search(r"(?<!\\)(?:\\\\)*\\[1-9]", rule.pattern):
        raise ValueError(f"{rule.rule_id}: a whole-text pattern cannot refer back to its groups")
    if rule.python_pattern.match(""):
        raise ValueError(f"{rule.rule_id}: a whole-text pattern must not match an empty text")


def _scanned(corpus: DataFrame, rules: Sequence[Rule], max_bytes: int | None = None) -> DataFrame:
    """(path, line_number, rule, line_text) of both passes, from one reading of the corpus; ``rule`` is a place in ``rules``.

    A row is one file. Whole-text hits are found in it first and travel as an element of their own beside the lines that
    it is split into. Python sees a text only where a syntax check could drop a hit: Python files with a word that a rule which
    asks for the check cannot do without.
    """
    gates = _gates(rules)
    names = list(gates.values())
    line_rules = [(n, r) for n, r in enumerate(rules) if not r.whole_text]
    text_rules = [(n, r) for n, r in enumerate(rules) if r.whole_text]
    files = _gated(corpus, gates).withColumn("_lines", split_lines("content") if line_rules else F.array().cast("array<string>"))

    def matched(r: Rule, text: Column, low: Column) -> Column:
        return F.col(gates[r.extensions]) & matches(text, r.java_pattern, r.pattern, "i" in r.flags, low)

    unknown = F.array().cast("array<boolean>")
    flags = unknown
    aware = [r for _, r in line_rules if r.ast_aware and any(".py".endswith(e) or e.endswith(".py") for e in r.extensions)]
    if aware:
        wanted = [may_match(F.col("content"), r.pattern, "i" in r.flags, F.col("_low")) for r in aware]
        files = files.withColumn("_low", folded(F.col("content"))).withColumn("_check", F.col("path").endswith(".py") & reduce(lambda a, b: a | b, wanted))
        flags = F.coalesce(executable_lines()(F.when(F.col("_check"), F.col("content"))), unknown)
    spanning = F.array().cast(HIT)
    if text_rules:
        for _, r in text_rules:
            _check_spanning(r)
        if not aware:
            files = files.withColumn("_low", folded(F.col("content")))
        fits = F.lit(True) if max_bytes is None else F.octet_length("content") <= max_bytes
        each = [F.when(fits & matched(r, F.col("content"), F.col("_low")), text_hits(F.col("content"), r, n)) for n, r in text_rules]
        files = files.withColumn("_each", F.array(*each))  # a list of its own, as below
        spanning = F.flatten(F.array_compact("_each"))
    # element 0 holds the whole-text hits, element n the line n; shorter lists are filled up with nulls
    zipped = F.arrays_zip(
        F.concat(F.array(F.lit(None).cast("string")), F.col("_lines")).alias("line"),
        F.concat(F.array(F.lit(True)), flags).alias("runs"),
        F.array(spanning).alias("hits"),
    )
    rows = files.select("path", *names, F.posexplode(zipped).alias("line_number", "z"))
    rows = rows.where(F.col("z.line").isNotNull() | (F.size("z.hits") > 0)).select(
        "path", *names, "line_number", F.col("z.line").alias("line"), F.coalesce("z.runs", F.lit(True)).alias("runs"),
        F.coalesce("z.hits", F.array().cast(HIT)).alias("hits"), folded(F.col("z.line")).alias("folded"),
    )

    def hit(n: int, r: Rule) -> Column:
        found = matched(r, F.col("line"), F.col("folded"))
        return F.when(F.col("runs") & found if r.ast_aware else found, F.lit(n))

    # rules whose words share a part are looked at only where the part is in the line
    words = [required_literals(r.pattern, re.IGNORECASE if "i" in r.flags else 0) for _, r in line_rules]
    marks = []
    for part, numbers in shared_parts(words):
        each = F.array(*[hit(*line_rules[n]) for n in numbers])
        marks.append(each if part is None else F.when(F.col("folded").contains(part), each))
    return _exploded_hits(rows, marks)


def _exploded_hits(rows: DataFrame, hits: list[Column]) -> DataFrame:
    """One row per rule found in a line, after the whole-text hits that a row may carry; ``hits`` are lists of rules.

    The line's text passes through a higher-order function, which keeps this projection out of
    whole-stage code generation: hundreds of rule expressions then become many small methods that
    the JIT compiles, where a single huge method would stay interpreted (measured 3 to 4 times
    faster over all rules).
    """
    text = F.get(F.transform(F.array("line"), strip), F.lit(0))
    # the rules stand in a list of their own: within the function that follows they would be interpreted
    marks = F.array(*hits) if hits else F.array().cast("array<array<int>>")
    marked = rows.select("path", "line_number", text.alias("text"), "hits", marks.alias("marks"))
    found = F.transform(F.array_compact(F.flatten(F.array_compact("marks"))), lambda n: F.struct(F.col("line_number"), n.alias("rule"), F.lit(None).cast("string").alias("line_text")))
    single = marked.select("path", "text", F.explode(F.concat("hits", found)).alias("h"))
    return single.select("path", "h.line_number", "h.rule", F.coalesce("h.line_text", "text").alias("line_text"))


def _hits(corpus: DataFrame, rules: Sequence[Rule], max_bytes: int | None = None) -> DataFrame:
    if not rules:
        return corpus.sparkSession.createDataFrame([], HITS)
    ids = F.array(*[F.lit(r.rule_id) for r in rules])
    return _scanned(corpus, rules, max_bytes).select("path", "line_number", F.get(ids, F.col("rule")).alias("rule_id"), "line_text")


def scan_lines(corpus: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Line pass: (path, line_number, rule_id, line_text), at most one row per rule and line."""
    return _hits(corpus, [r for r in rules if not r.whole_text])


def scan_whole_text(corpus: DataFrame, rules: Sequence[Rule], max_bytes: int | None = None) -> DataFrame:
    """Whole-text pass for patterns that may span lines, over texts of any size unless ``max_bytes`` is given.

    Per rule and line the first match counts. Such patterns must match some text and not refer back to their groups.
    """
    return _hits(corpus, [r for r in rules if r.whole_text], max_bytes)


def rule_frame(spark, rules: Sequence[Rule]) -> DataFrame:
    """The rule table as a DataFrame (one row per rule, held by the driver already)."""
    rows = [
        (r.rule_id, r.title, r.severity, r.category, r.java_pattern, ",".join(r.extensions), r.whole_text, r.ast_aware)
        for r in rules
    ]
    return spark.createDataFrame(
        rows,
        "rule_id string, title string, severity string, category string, pattern string, extensions string, "
        "whole_text boolean, ast_aware boolean",
    )


def scan(corpus: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Both passes with rule facts, one row per (file, rule, line), from one reading of the corpus."""
    facts = F.get(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in _facts(r).items()]) for r in rules]), F.col("rule"))
    return _scanned(corpus, rules).select("path", "line_number", facts.alias("f"), "line_text").select(
        "path", "line_number", *[f"f.{n}" for n in ("rule_id", "title", "severity", "category")], "line_text"
    )


def _facts(r: Rule) -> dict[str, str]:
    return {"rule_id": r.rule_id, "title": r.title, "severity": r.severity, "category": r.category}


def dedupe_issues(issues: DataFrame, order: str) -> DataFrame:
    """First issue per (path, rule_id, line_number)."""
    from lakeshift.operators.windows import distinct_first

    return distinct_first(issues, ["path", "rule_id", "line_number"], order)


def _rank(values: Sequence[str], c: str) -> Column:
    known = F.create_map(*[x for i, v in enumerate(values) for x in (F.lit(v), F.lit(i))])
    return F.coalesce(F.try_element_at(known, F.col(c)), F.lit(len(values)))


def severity_rank(c: str = "severity") -> Column:
    return _rank(SEVERITIES, c)


def category_rank(c: str = "category") -> Column:
    return _rank(CATEGORIES, c)


def issue_summary(issues: DataFrame, corpus: DataFrame) -> DataFrame:
    """(measure, label, value) rows: files, lines, issues, issues by severity and by category."""
    size = corpus.agg(
        F.count(F.lit(1)).alias("files_scanned"), F.coalesce(F.sum(line_count("content")), F.lit(0)).alias("lines_scanned")
    ).select(
        F.inline(
            F.array(
                F.struct(F.lit("files_scanned").alias("measure"), F.lit("").alias("label"), F.col("files_scanned").alias("value")),
                F.struct(F.lit("lines_scanned").alias("measure"), F.lit("").alias("label"), F.col("lines_scanned").alias("value")),
            )
        )
    )
    tagged = issues.select(
        F.inline(
            F.array(
                F.struct(F.lit("total_issues").alias("measure"), F.lit("").alias("label")),
                F.struct(F.lit("by_severity").alias("measure"), F.col("severity").alias("label")),
                F.struct(F.lit("by_category").alias("measure"), F.col("category").alias("label")),
            )
        )
    )
    return size.unionByName(tagged.groupBy("measure", "label").agg(F.count(F.lit(1)).alias("value")))


# Columns that an issue list can be grouped by, and how the groups are ordered.
GROUP_COLUMN = {"severity": "severity", "category": "category", "file": "path", "rule": "rule_id"}


def group_issues(issues: DataFrame, by: str) -> DataFrame:
    """Groups in report order with their size, files and rules.

    A group may hold any share of all issues, so its issues are not gathered: use
    :func:`ordered_issues` for the grouped list itself.
    """
    column = GROUP_COLUMN[by]
    groups = issues.groupBy(F.col(column).alias("group_label")).agg(
        F.count(F.lit(1)).alias("issue_count"),
        F.count_distinct("path").alias("file_count"),
        F.count_distinct("rule_id").alias("rule_count"),
    )
    return groups.withColumn("group_rank", group_rank(by, "group_label")).orderBy("group_rank", "group_label")


def group_rank(by: str, c: str) -> Column:
    """Fixed order for severities and categories; files and rules sort by name alone."""
    if by == "severity":
        return severity_rank(c)
    if by == "category":
        return category_rank(c)
    return F.lit(0)


def ordered_issues(issues: DataFrame, by: str) -> DataFrame:
    """Issues sorted by group, then place: the grouped list as rows."""
    column = GROUP_COLUMN[by]
    # a sort reads its input twice, first to draw the ranges: the scan must not run for both
    return stored(issues, "issues").withColumn("group_label", F.col(column)).orderBy(
        group_rank(by, column), column, "path", "line_number", "rule_id"
    )


def issues_json(issues: DataFrame, by: str = "category") -> DataFrame:
    """One JSON document per issue, with its group label (written as JSON lines)."""
    columns = ["rule_id", "title", "severity", "category", "path", "line_number", "line_text"]
    return issues.select(
        F.col(GROUP_COLUMN[by]).alias("group_label"), F.to_json(F.struct(*columns)).alias("issue")
    )
