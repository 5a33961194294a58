"""Line checks and rewrites over source text, as expressions on the stripped line.

Every check is a condition and a new line. Findings come from exploding the lines of a file;
applying works on the array of lines inside the row, so no file is ever split over tasks and put
together again.
"""

from __future__ import annotations

import re
from functools import reduce
from itertools import groupby
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshift.functions.cells import WHITESPACE, bound, strip
from lakeshift.functions.text import folded, matches, shared_parts
from lakeshift.operators.scan import LINE_ENDS, LINE_WITH_END
from lakeshift.rules import rewrite as R

U = "(?Ud)"
IMPORT_LINE = U + r"^from\s+airflow"


class Check(NamedTuple):
    """``condition`` / ``new_line`` are expressions on the stripped line."""

    condition: Column
    new_line: Column
    category: str
    severity: str
    description: str
    auto_fixable: bool = True


def _found(s: Column, pattern: str) -> Column:
    return matches(s, U + pattern, pattern)


def _renamed(s: Column, old: str, new: str) -> Column:
    return F.regexp_replace(s, rf"{U}\b{old}\b", new)


def import_pattern(rule: R.ImportRule) -> str:
    name = "(.+)" if rule.name is None else rf"{rule.name}\b"
    return rf"^from\s+{re.escape(rule.module)}\s+import\s+{name}"


def _import_line(s: Column, rule: R.ImportRule) -> Column:
    if rule.target.startswith("#"):
        return F.lit(rule.target)
    if rule.new_name is not None:
        return F.lit(f"from {rule.target} import {rule.new_name}")
    names = strip(F.regexp_extract(s, U + import_pattern(rule), 1))
    return F.concat(F.lit(f"from {rule.target} import "), names)


def import_finding(s: Column) -> Column:
    """The import finding of a line as one struct: the first fitting rule, null when it changes nothing."""
    def finding(rule: R.ImportRule) -> Column:
        new = _import_line(s, rule)
        return F.struct(
            new.alias("new_code"),
            F.lit(rule.category).alias("category"),
            F.lit(rule.severity).alias("severity"),
            F.lit(f"import of {rule.name or 'names'} from {rule.module}").alias("description"),
            F.lit(True).alias("auto_fixable"),
        )

    chain = reduce(
        lambda acc, r: acc.when(_found(s, import_pattern(r)), finding(r)),
        R.IMPORT_RULES[1:],
        F.when(_found(s, import_pattern(R.IMPORT_RULES[0])), finding(R.IMPORT_RULES[0])),
    )
    # only import lines are worth the chain; the guard keeps it off all others
    return F.when(s.rlike(IMPORT_LINE), chain)


def line_checks(s: Column) -> list[Check]:
    """All checks except imports, in the order their findings are reported."""
    checks: list[Check] = []
    not_import = ~(s.startswith("from ") | s.startswith("import "))
    for old, new in R.DAG_PARAMETERS.items():
        pattern = rf"\b{old}\s*="
        found = F.rtrim(F.regexp_extract(s, U + pattern, 0), F.lit("= "))
        checks.append(
            Check(_found(s, pattern), F.replace(s, found, F.lit(new)), "DAG Parameters", "BREAKING", f"{old} is now {new}")
        )
    for old, new in R.CONTEXT_KEYS.items():
        pattern = (
            rf"""context\s*\[\s*['"]{old}['"]|context\.get\s*\(\s*['"]{old}['"]"""
            rf"""|\bkwargs\s*\[\s*['"]{old}['"]|\b{old}\s*=\s*context"""
        )
        fixed = (
            F.replace(s, F.lit(old), F.lit(new))
            if new
            else F.lit(f"# MANUAL FIX REQUIRED: {old} removed; compute manually")
        )
        text = f"{old} renamed to {new}" if new else f"{old} removed; compute manually"
        checks.append(Check(_found(s, pattern), fixed, "Context Variables", "BREAKING", text, new is not None))
    for old, new in R.TRIGGER_RULES.items():
        old, new = f"TriggerRule.{old}", f"TriggerRule.{new}"
        checks.append(
            Check(s.contains(old), F.replace(s, F.lit(old), F.lit(new)), "Trigger Rules", "BREAKING", f"{old} is now {new}")
        )
    for old, new in R.OPERATOR_CLASSES.items():
        checks.append(
            Check(_found(s, rf"\b{old}\s*\("), _renamed(s, old, new), "Operator Rename", "BREAKING", f"{old} is now {new}")
        )
    for old, new in R.CONNECTION_PARAMETERS.items():
        checks.append(
            Check(_found(s, rf"\b{old}\s*="), _renamed(s, old, new), "Connection Parameters", "BREAKING", f"{old} is now {new}")
        )
    checks.append(
        Check(
            _found(s, r"^def\s+\w+\s*\(\s*spark\s*,\s*sc\s*"),
            F.regexp_replace(s, U + r"\(\s*spark\s*,\s*sc\s*", "(spark"),
            "PySpark Decorator",
            "BREAKING",
            "the sc parameter is no longer passed",
        )
    )
    days = r"\bdays_ago\s*\(\s*(\d+)\s*\)"
    today = F.concat(F.lit("pendulum.today('UTC').add(days=-"), F.regexp_extract(s, U + days, 1), F.lit(")"))
    checks.append(
        Check(
            _found(s, days),
            F.replace(s, F.regexp_extract(s, U + days, 0), today),
            "Removed Utility",
            "BREAKING",
            "days_ago is gone",
        )
    )
    checks.append(
        Check(
            not_import & _found(s, r"\bDataset\s*\("), _renamed(s, "Dataset", "Asset"), "Assets Rename", "BREAKING",
            "Dataset is now Asset",
        )
    )
    checks.append(
        Check(
            _found(s, r"\buse_dill\s*="),
            F.regexp_replace(s, U + r",?\s*use_dill\s*=\s*(True|False)", ""),
            "Removed Parameters",
            "BREAKING",
            "use_dill is gone",
        )
    )
    checks.append(
        Check(_found(s, r"\bsla\s*=\s*timedelta"), F.lit(R.SLA_MARK), "Removed Feature", "BREAKING", "SLAs are gone", False)
    )
    checks.append(
        Check(
            _found(s, r"\bsla_miss_callback\s*="), F.lit(R.SLA_CALLBACK_MARK), "Removed Feature", "BREAKING",
            "SLA callbacks are gone", False,
        )
    )
    checks.append(
        Check(
            _found(s, r"\buse_task_execution_date\s*="),
            _renamed(s, "use_task_execution_date", "use_task_logical_date"),
            "Removed Parameters",
            "BREAKING",
            "use_task_execution_date is now use_task_logical_date",
        )
    )
    checks.append(
        Check(
            _found(s, r"\bdelegate_to\s*="), _renamed(s, "delegate_to", "impersonation_chain"), "Google Provider", "BREAKING",
            "delegate_to is now impersonation_chain",
        )
    )
    checks.append(
        Check(
            _found(s, r"\.get_hook\s*\(\s*\)"), F.replace(s, F.lit(".get_hook()"), F.lit(".hook")), "AWS Provider",
            "BREAKING", "get_hook() is now the hook property",
        )
    )
    barred = F.lit(False)
    for pattern, text in R.DB_ACCESS:
        found = _found(s, pattern)
        checks.append(
            Check(
                not_import & ~barred & found, F.lit(f"# MANUAL FIX REQUIRED: {text}; use REST API"), "Database Access",
                "BREAKING", text, False,
            )
        )
        barred = barred | found
    for old, new in R.ASSET_CLASSES.items():
        checks.append(
            Check(
                not_import & _found(s, rf"\b{old}\s*\("), _renamed(s, old, new), "Assets Rename", "BREAKING", f"{old} is now {new}"
            )
        )
    return checks


def code_line(c: Column) -> Column:
    """False for blank lines and comment lines."""
    s = strip(c)
    return (s != "") & ~s.startswith("#")


def _findings(s: Column) -> Column:
    """Findings of a stripped line in report order, null where a check finds nothing."""
    others = [
        F.when(
            c.condition,
            F.struct(
                c.new_line.alias("new_code"),
                F.lit(c.category).alias("category"),
                F.lit(c.severity).alias("severity"),
                F.lit(c.description).alias("description"),
                F.lit(c.auto_fixable).alias("auto_fixable"),
            ),
        )
        for c in line_checks(s)
    ]
    imported = bound(import_finding(s), lambda f: F.when(f["new_code"] != s, f))
    # checks of a kind share few words, and most lines hold none of them
    kinds = [list(g) for _, g in groupby(zip(line_checks(s), others), key=lambda x: x[0].category)]
    blocks = [F.array(*[finding for _, finding in g]) for g in kinds]
    guards = [KIND_WORDS.get(g[0][0].category) for g in kinds]
    low = folded(s)
    return F.flatten(F.array_compact(F.array(F.array(imported), *[b if w is None else F.when(_any_part(low, w), b) for w, b in zip(guards, blocks)])))


# Words of which one stands in every line that a check of the kind finds something in.
KIND_WORDS = {
    "DAG Parameters": list(R.DAG_PARAMETERS),
    "Context Variables": ["context", "kwargs"],
    "Trigger Rules": ["TriggerRule."],
    "Operator Rename": list(R.OPERATOR_CLASSES),
    "Connection Parameters": list(R.CONNECTION_PARAMETERS),
}


def _any_part(low: Column, words: list[str]) -> Column:
    """False only where the lower-cased text holds none of the words; one test for words that share a part."""
    parts = []
    for part, numbers in shared_parts([[w] for w in words]):
        parts += [words[n].lower() for n in numbers] if part is None else [part]
    return reduce(lambda a, b: a | b, [low.contains(p) for p in parts])


# Words of which at least one stands in every line some check is about.
TRIGGERS = [
    *R.DAG_PARAMETERS, "context", "kwargs", "TriggerRule", *R.OPERATOR_CLASSES, *R.CONNECTION_PARAMETERS,
    "spark", "days_ago", "Dataset", "use_dill", "sla", "use_task_execution_date", "delegate_to", "get_hook", "Session",
    "DagRun", "get_previous_dagrun",
]


def worth_checking(s: Column) -> Column:
    """Cheap test that rules out most lines: parts of the trigger words."""
    return s.rlike(U + r"from\s+airflow") | _any_part(folded(s), TRIGGERS)


def code_lines(corpus: DataFrame) -> DataFrame:
    """(path, line_number, code) of every line that is neither blank nor a comment."""
    lines = corpus.select("path", F.posexplode(F.regexp_extract_all("content", F.lit(LINE_WITH_END), F.lit(0))).alias("pos", "line"))
    return lines.where(code_line(F.col("line"))).select(
        "path", (F.col("pos") + 1).alias("line_number"), strip(F.col("line")).alias("code")
    )


def rewrite_findings(corpus: DataFrame) -> DataFrame:
    """Findings per line: (path, line_number, finding_number, category, severity, old_code, new_code, ...)."""
    # the higher-order function keeps the projection out of whole-stage code generation, so that its
    # many checks become small methods the JIT compiles
    marked = (
        code_lines(corpus)
        .where(worth_checking(F.col("code")))
        .select("path", "line_number", F.transform(F.array("code"), lambda x: x).alias("kept"), _findings(F.col("code")).alias("found"))
    )
    found = marked.select(
        "path",
        "line_number",
        F.get("kept", F.lit(0)).alias("code"),
        F.posexplode(F.array_compact("found")).alias("finding_number", "f"),
    )
    return found.select(
        "path",
        "line_number",
        "finding_number",
        "f.category",
        "f.severity",
        F.col("code").alias("old_code"),
        "f.new_code",
        "f.description",
        "f.auto_fixable",
    )


def first_rule_per_line(corpus: DataFrame) -> DataFrame:
    """Lines an import rule fits, with the first such rule's new line."""
    imports = code_lines(corpus).where(F.col("code").rlike(IMPORT_LINE))
    marked = imports.select(
        "path", "line_number", F.transform(F.array("code"), lambda x: x).alias("kept"), import_finding(F.col("code")).alias("f")
    )
    fitting = marked.select(
        "path", "line_number", F.get("kept", F.lit(0)).alias("old_code"), F.inline(F.array_compact(F.array("f")))
    )
    return fitting.select("path", "line_number", "old_code", "new_code", "category", "severity")


def rewritten_line(s: Column, indent: Column) -> Column:
    """A stripped line after its first effective automatic fix, indented again; null when nothing changes.

    Only the first fix counts because later findings refer to the line as it was; a fix that leaves
    the line as it is does not stand in the way of the next.
    """
    checks = [c for c in line_checks(s) if c.auto_fixable]
    imported = import_finding(s)["new_code"]
    fixes = [F.when(imported != s, imported)]
    fixes += [F.when(c.condition & (strip(c.new_line) != s), c.new_line) for c in checks]
    # fixes that may leave the code alone still rewrite the line without trailing blanks
    fixes += [F.when(c.condition, s) for c in checks if c.category in ("Removed Parameters", "AWS Provider")]
    return F.when((s != "") & ~s.startswith("#") & worth_checking(s), F.concat(indent, F.coalesce(*fixes)))


def apply_rewrites(corpus: DataFrame) -> DataFrame:
    """Rewritten files: (path, changed_lines, content)."""
    ends = rf"(?:\r\n|[{LINE_ENDS}])$"
    lines = F.transform(
        F.regexp_extract_all("content", F.lit(LINE_WITH_END), F.lit(0)), lambda x: F.regexp_replace(x, ends, "")
    )
    # strip once per line: the checks below refer to the stripped text many times
    parts = F.transform(
        lines,
        lambda x: F.struct(x.alias("old"), strip(x).alias("code"), F.left(x, F.length(x) - F.length(F.ltrim(x, F.lit(WHITESPACE)))).alias("indent")),
    )
    fixed = F.transform(
        parts, lambda x: F.struct(x["old"].alias("old"), rewritten_line(x["code"], x["indent"]).alias("new"))
    )
    return corpus.select("path", fixed.alias("z")).select(
        "path",
        F.size(F.filter("z", lambda x: x["new"].isNotNull())).alias("changed_lines"),
        F.concat(F.array_join(F.transform("z", lambda x: F.coalesce(x["new"], x["old"])), "\n"), F.lit("\n")).alias("content"),
    )


def finding_summary(findings: DataFrame) -> DataFrame:
    """(measure, label, value): findings by severity, category and file, and the fixable ones."""
    tagged = findings.select(
        F.inline(
            F.array(
                F.struct(F.lit("total").alias("measure"), F.lit("").alias("label"), F.lit(1).alias("n")),
                F.struct(F.lit("by_severity").alias("measure"), F.col("severity").alias("label"), F.lit(1).alias("n")),
                F.struct(F.lit("by_category").alias("measure"), F.col("category").alias("label"), F.lit(1).alias("n")),
                F.struct(F.lit("by_file").alias("measure"), F.col("path").alias("label"), F.lit(1).alias("n")),
                F.struct(
                    F.lit("auto_fixable").alias("measure"), F.lit("").alias("label"), F.col("auto_fixable").cast("int").alias("n")
                ),
            )
        )
    )
    counted = tagged.groupBy("measure", "label").agg(F.sum("n").alias("value"))
    # every file with findings is one by_file row by now, so counting them needs no second scan
    one_file = F.struct(F.lit("files_with_issues").alias("measure"), F.lit("").alias("label"), F.lit(1).cast("bigint").alias("value"))
    rows = F.array(F.struct("measure", "label", "value"), F.when(F.col("measure") == "by_file", one_file))
    return (
        counted.select(F.inline(F.array_compact(rows)))
        .groupBy("measure", "label")
        .agg(F.sum("value").alias("value"))
    )
