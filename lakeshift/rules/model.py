"""Rule records and the fixed orders of severities and categories."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

# Severities from worst to mildest.
SEVERITIES = ["critical", "high", "medium", "low", "info"]
# Categories in report order.
CATEGORIES = [
    "Spark API Changes",
    "Spark SQL Changes",
    "Configuration Changes",
    "Dependency Changes",
    "HDFS to S3 Migration",
    "Performance Considerations",
    "Security & Auth",
    "JDK 8/11 to 17 Migration",
    "Python 2 to 3 Migration",
]
# Files a rule looks at unless it names others, and files a corpus scan reads.
RULE_EXTENSIONS = (".py", ".scala", ".java", ".sql", ".conf", ".properties", ".xml", ".yaml", ".yml")
CORPUS_EXTENSIONS = (*RULE_EXTENSIONS, ".sbt", ".gradle", ".hql")
# Names a corpus scan leaves out; a leading * matches the end of a name.
CORPUS_EXCLUDES = (
    "__pycache__", ".git", "node_modules", ".venv", "venv", "target", "build", "dist", ".idea", ".vscode", "*.pyc",
)


@dataclass(frozen=True)
class Rule:
    """One scan rule. ``flags`` holds ``i`` (ignore case) and ``m`` (line anchors)."""

    rule_id: str
    severity: str
    category: str
    title: str
    pattern: str
    flags: str = ""
    extensions: tuple[str, ...] = RULE_EXTENSIONS
    whole_text: bool = False
    ast_aware: bool = False

    @property
    def java_pattern(self) -> str:
        """Pattern with Unicode classes and ``\\n``-only line ends; whole-text rules let ``.`` cross lines."""
        return f"(?Ud{self.flags}{'s' if self.whole_text else ''}){self.pattern}"

    @property
    def python_pattern(self) -> re.Pattern[str]:
        flags = 0
        if "i" in self.flags:
            flags |= re.IGNORECASE
        if "m" in self.flags:
            flags |= re.MULTILINE
        if self.whole_text:
            flags |= re.DOTALL
        return re.compile(self.pattern, flags)


def filter_rules(
    rules: Iterable[Rule], min_severity: str | None = None, categories: Sequence[str] | None = None
) -> list[Rule]:
    """Rules at least as severe as ``min_severity`` and, when given, of the named categories."""
    limit = len(SEVERITIES) if min_severity is None else SEVERITIES.index(min_severity)
    return [
        r
        for r in rules
        if SEVERITIES.index(r.severity) <= limit and (categories is None or r.category in categories)
    ]


def rules_from_rows(rows: Iterable[dict]) -> list[Rule]:
    """Rules of the user's own table (a short list of records, e.g. from a JSON file)."""
    out = []
    for row in rows:
        row = dict(row)
        if "extensions" in row:
            row["extensions"] = tuple(row["extensions"])
        out.append(Rule(**row))
    return out
