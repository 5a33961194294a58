"""Registered queries and, where plain SQL can say the same, their SQL counterparts."""

from __future__ import annotations

from lakeshift.workload import (  # noqa: F401  (each module registers its queries)
    cells,
    control,
    corpora,
    files,
    ledgers,
    partitions,
    policies,
    runs,
    tables,
)
from lakeshift.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
