"""What the operators of this subpackage share: tables, intermediate results, distributed ranks, packed exchanges."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshift.sources.scratch import shared_dir

#: Bytes of text that one group of a packed exchange should hold.
GROUP_BYTES = 24 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame) -> DataFrame:
    """Compute a result that several branches read once, and cut its lineage, with a reliable checkpoint.

    The files lie in the shared folder of ``spark.checkpoint.dir``; only a session on one machine may be without one and
    gets a temporary folder.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def groups_for(df: DataFrame, column: str, bytes_each: int = GROUP_BYTES, least: int = 1) -> int:
    """How many groups hold the texts of a column at about so many bytes each: grows with the table."""
    total = df.agg(F.sum(F.octet_length(column))).first()[0] or 0
    return max(least, -(-int(total) // bytes_each))


def ranked(df: DataFrame, group: list[str], levels: list[str], order: list[Column], rank: str, total: str | None = None) -> DataFrame:
    """Add each row's rank (from 0) within its group, in the order of the columns ``levels`` and then ``order``.

    No task sorts a whole group. Rows are counted per group and level values (combined before the
    shuffle); running sums over these counts, one level after the other, give the rank at which each
    cell begins, and only the rows of one cell are sorted together. The last level should split rows
    that agree in the others into cells of bounded size. Null group and level values are values.
    ``total``: name of a column for the number of rows of the group.
    """
    cells = df.groupBy(*group, *levels).agg(F.count(F.lit(1)).alias("_n"))
    starts = None
    for depth in range(len(levels)):
        at = group + levels[: depth + 1]
        counts = cells.groupBy(*at).agg(F.sum("_n").alias("_m"))
        above = [F.col(c) for c in group + levels[:depth]] or [F.lit(0)]
        w = Window.partitionBy(*above).orderBy(F.col(levels[depth]).asc_nulls_last())
        begin = (F.sum("_m").over(w) - F.col("_m")).alias(f"_s{depth}")
        more = [F.sum("_m").over(Window.partitionBy(*above)).alias("_total")] if depth == 0 else []
        counts = counts.select(*at, begin, *more)
        if starts is None:
            starts = counts
        else:
            starts = _null_safe(counts, starts, group + levels[:depth], "inner")
    begin = sum((F.col(f"_s{d}") for d in range(1, len(levels))), F.col("_s0"))
    starts = starts.select(*[F.col(c).alias(f"_k_{c}") for c in group + levels], begin.alias("_begin"), "_total")
    inside = Window.partitionBy(*group, *levels).orderBy(*order)
    rows = df.withColumn("_row", F.row_number().over(inside))
    on = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in group + levels]
    out = rows.join(starts, on, "inner").withColumn(rank, F.col("_begin") + F.col("_row") - 1)
    if total:
        out = out.withColumn(total, F.col("_total"))
    return out.select(*df.columns, rank, *([total] if total else []))


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    other = right.select(*[F.col(c).alias(f"_r_{c}") for c in keys], *[c for c in right.columns if c not in keys])
    joined = left.join(other, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in keys], how)
    return joined.drop(*[f"_r_{c}" for c in keys])


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of ``df`` has, whatever its case."""
    have = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in have:
            name += "_"
        out.append(name)
    return out


def word_count(text: str) -> Column:
    """Number of words `[^\\x20\\x09-\\x0D]+`; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


class Registry:
    """Queries of this subpackage and, where SQL can say the same, their SQL."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None):
        def register(fn):
            self.queries[name] = fn
            if sql is not None:
                self.oracles[name] = sql
            return fn

        return register


REGISTRY = Registry()


def split_by(keys: np.ndarray, n: int) -> list[np.ndarray]:
    """Indices of the entries of each of ``n`` buckets, in their old order."""
    order = np.argsort(keys, kind="stable")
    return np.split(order, np.searchsorted(keys[order], np.arange(1, n)))
