"""Row-order operators: fill-down, first seen, last wins, lists in segments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeshift.sources.scratch import stored

DEFAULT_BLOCK_ROWS = 100_000


def fill_down(
    df: DataFrame,
    events: Mapping[str, Column],
    order: str,
    partition: Sequence[str] = (),
    block_rows: int = DEFAULT_BLOCK_ROWS,
) -> DataFrame:
    """Add one column per event: the latest non-null event value up to and including the row.

    A plain window would put a whole sheet on one task, so the scan runs in blocks of ``order``:
    a window inside each block, a small summary of each block's last value, a window over those
    summaries only, and an equi-join that carries the value into the block. Every task sees at
    most ``block_rows`` rows of a sheet, whatever the sheet's size.
    """
    names = list(events)
    keys = list(partition)
    base = df.withColumn("_block", F.floor(F.col(order) / F.lit(block_rows)))
    for name in names:
        base = base.withColumn(f"_e_{name}", events[name])

    inside = Window.partitionBy(*keys, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = base.select(
        *df.columns, "_block", *[F.last(f"_e_{n}", ignorenulls=True).over(inside).alias(f"_l_{n}") for n in names]
    )

    latest = base.groupBy(*keys, "_block").agg(
        *[
            F.max(F.when(F.col(f"_e_{n}").isNotNull(), F.struct(F.col(order), F.col(f"_e_{n}").alias("v"))))
            .getField("v")
            .alias(f"_b_{n}")
            for n in names
        ]
    )
    earlier = (
        Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    ).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = latest.select(
        *keys, "_block", *[F.last(f"_b_{n}", ignorenulls=True).over(earlier).alias(f"_c_{n}") for n in names]
    )
    joined = local.join(carried, [*keys, "_block"], "left")
    kept = [c for c in df.columns if c not in names]
    return joined.select(*kept, *[F.coalesce(f"_l_{n}", f"_c_{n}").alias(n) for n in names])


def distinct_first(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """First row per key by ``order``; an aggregate with map-side combine instead of a window."""
    return _extreme_row(df, keys, order, F.min)


def last_per_group(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Last row per key by ``order``."""
    return _extreme_row(df, keys, order, F.max)


def _extreme_row(df: DataFrame, keys: Sequence[str], order: str, pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c != order]
    best = df.groupBy(*keys).agg(pick(F.struct(F.col(order), *[F.col(c) for c in rest])).alias("_row"))
    return best.select(
        *[F.col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns]
    )


#: Values of one segment of a list.
SEGMENT = 1000


def segments(df: DataFrame, keys: Sequence[str], value: str, order: str | None = None, size: int = SEGMENT) -> DataFrame:
    """(keys, segment, values): a group's values in order, at most ``size`` to a row, for groups of any size.

    Rows are dealt out by ranges of (keys, order), so a large group lies in many tasks, one after the other; counts per
    task and group give the rank at which each task begins, and no task sorts more than its range. Null keys are
    values; null values are left out. Without ``order`` values are sorted and distinct; with it they are as the rows
    have them, and rows of equal order may lie in any order. :func:`whole_lists` puts segments together at a sink.
    """
    keys = list(keys)
    rows = df.where(F.col(value).isNotNull())
    rows = rows.select(*keys, F.col(value).alias("_value")).distinct() if order is None else rows.select(*keys, F.col(value).alias("_value"), F.col(order).alias("_order"))
    by = "_value" if order is None else "_order"
    # written once: where a range begins is drawn from samples, and must not be drawn again
    placed = stored(rows.repartitionByRange(*keys, by).withColumn("_place", F.spark_partition_id()), "segments")
    counts = placed.groupBy(*keys, "_place").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)  # a row per task
    begins = counts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_place").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_begin"))
    same = [placed[k].eqNullSafe(begins[f"_k_{k}"]) for k in keys]
    inside = Window.partitionBy(*keys, "_place").orderBy(by)
    ranked = placed.withColumn("_row", F.row_number().over(inside)).join(begins, [*same, F.col("_place") == F.col("_p")])
    rank = F.col("_begin") + F.col("_row") - 1
    listed = ranked.groupBy(*keys, F.floor(rank / size).alias("segment")).agg(F.sort_array(F.collect_list(F.struct(rank.alias("r"), F.col("_value").alias("v")))).alias("x"))
    return listed.select(*keys, "segment", F.transform("x", lambda e: e["v"]).alias("values"))


def whole_lists(parts: DataFrame, keys: Sequence[str], name: str = "values") -> DataFrame:
    """One row per group with its whole list, for sinks whose groups are known to be small."""
    pieces = F.sort_array(F.collect_list(F.struct("segment", "values")))
    return parts.groupBy(*keys).agg(F.flatten(F.transform(pieces, lambda p: p["values"])).alias(name))
