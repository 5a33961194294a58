"""Runs in stages over a versioned ledger.

A stage takes the rows whose state asks for it, works on them, and commits what came out as a new version of the ledger.
A run that stops is resumed by running it again: finished rows are no longer due. Two runs on one ledger cannot
overwrite each other, since a version can be made once only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession

from lakeshift.sources.versioned import VersionedTable

#: Tables that one stage works on at a time; their Spark jobs share the cluster.
PARALLEL = 4


@dataclass(frozen=True)
class Stage:
    """``due`` picks ledger rows, ``work`` turns them into results, ``advance`` applies results to a ledger."""

    name: str
    due: Column
    work: Callable[[list[Row]], DataFrame]
    advance: Callable[[DataFrame, DataFrame], DataFrame]


def each_table(spark: SparkSession, rows: Sequence[Row], keys: Sequence[str], schema: str, one: Callable[[Row], dict]) -> DataFrame:
    """Results of ``one`` for each row, some at a time. What fails becomes a FAILED result with its error."""

    def guarded(row: Row) -> dict:
        try:
            return {"status": "COMPLETED", **one(row)}
        except Exception as e:
            return {"status": "FAILED", "error": str(e).splitlines()[0] if str(e) else type(e).__name__}

    with ThreadPoolExecutor(PARALLEL) as pool:
        done = list(pool.map(guarded, rows))
    ddl = ", ".join([*[f"{k} string" for k in keys], "status string", "error string", *([schema] if schema else [])])
    names = [c.strip().split(" ")[0] for c in ddl.split(",")]
    return spark.createDataFrame([tuple(({k: r[k] for k in keys} | d).get(n) for n in names) for r, d in zip(rows, done)], ddl)


def run_stages(ledger: VersionedTable, stages: Iterable[Stage], stop_after: str | None = None) -> DataFrame:
    """Work through the stages and return the ledger as it then is.

    The rows that are due, one per table of the run, are read to the driver; data is not. ``stop_after`` ends a run early.
    """
    for stage in stages:
        due = ledger.read().where(stage.due).collect()
        if due:
            results = stage.work(due)
            ledger.update(lambda state, s=stage, r=results: s.advance(state, r))
        if stage.name == stop_after:
            break
    return ledger.read()
