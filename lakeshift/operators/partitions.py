"""Partition-filter operators over a DataFrame of (table keys, partition string)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeshift.functions import partitions as P
from lakeshift.functions.cells import strip


def apply_partition_filter(
    df: DataFrame, expr: str | None, part: str = "partition", keys: Sequence[str] = ()
) -> DataFrame:
    """Rows whose partition matches any term of ``expr`` (terms are a union; empty keeps all).

    ``last_n_partitions=N`` takes the N greatest strings per ``keys``. The rank limit sits directly
    on the window, so Spark keeps only N rows per key and task before the shuffle
    (WindowGroupLimit); without keys it is a top-k, never a global sort.
    """
    terms = P.filter_terms(expr)
    if not terms:
        return df
    direct = P.matches_filter(part, expr)
    n = P.last_n_of(terms)
    if n == 0:
        return df.where(direct)
    distinct = df.select(*keys, part).distinct()
    if keys:
        order = Window.partitionBy(*keys).orderBy(F.col(part).desc())
        newest = (
            distinct.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n).drop("_rank")
        )
    else:
        newest = distinct.orderBy(F.col(part).desc()).limit(n)
    return (
        df.join(newest.withColumn("_newest", F.lit(True)), [*keys, part], "left")
        .where(direct | F.col("_newest").isNotNull())
        .select(*df.columns)
    )


def apply_control_filters(
    df: DataFrame,
    control: DataFrame,
    keys: Sequence[str],
    part: str = "partition",
    expr: str = "partition_filter",
    groups: Sequence[str] = (),
) -> DataFrame:
    """Each control row's table filtered by the row's own expression (null or blank keeps everything).

    ``groups`` are the columns of the control sheet that tell rows of one table apart, such as its
    destination; they are returned with the partitions. Rows that agree in keys, groups and filter
    count once. One equi-join on the table keys. ``last_n`` is a ranked window over the distinct partitions of the rows that
    ask for it; the largest number on the sheet, read first, limits it as a literal, so that each task sends on that many
    partitions of a table at most, and each row's own number follows.
    """
    groups = list(groups)
    wanted = control.select(*keys, *groups, F.col(expr).alias("_expr")).distinct()
    own = [*keys, *groups, "_expr"]
    rows = df.join(wanted, list(keys), "inner")
    terms = F.transform(F.split(F.col("_expr"), ","), strip)
    counts = F.transform(
        F.filter(terms, lambda t: t.rlike(P.LAST_N)), lambda t: F.regexp_extract(t, P.LAST_N, 1).cast("int")
    )
    order = Window.partitionBy(*own).orderBy(F.col(part).desc())
    most = wanted.agg(F.max(F.array_max(counts))).first()[0]
    if not most:
        return rows.where(P.matches_filter(part, F.col("_expr"))).select(*df.columns, *groups)
    newest = (
        rows.withColumn("_n", F.array_max(counts))
        .where(F.col("_n") > 0)
        .select(*own, part, "_n")
        .distinct()
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= F.lit(most))
        .where(F.col("_rank") <= F.col("_n"))
        .select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(own)], F.col(part).alias("_part"), F.lit(True).alias("_newest"))
    )
    same = [F.col(c).eqNullSafe(F.col(f"_o{i}")) for i, c in enumerate(own)]
    return (
        rows.join(newest, reduce(lambda a, b: a & b, same) & (F.col(part) == F.col("_part")), "left")
        .where(P.matches_filter(part, F.col("_expr")) | F.col("_newest").isNotNull())
        .select(*df.columns, *groups)
    )


def filter_figures(df: DataFrame, matched: DataFrame, keys: Sequence[str], expr: Column | str) -> DataFrame:
    """Per table: partitions in all, partitions matched and whether the filter narrows anything."""
    expr = F.lit(expr) if isinstance(expr, str) else expr
    marked = df.select(*keys, F.lit(1).alias("_all"), F.lit(0).alias("_hit")).unionByName(
        matched.select(*keys, F.lit(0).alias("_all"), F.lit(1).alias("_hit"))
    )
    return (
        marked.groupBy(*keys)
        .agg(F.sum("_all").alias("partition_count"), F.sum("_hit").alias("filtered_partition_count"))
        .withColumn(
            "filter_active",
            P.filter_active(expr, "filtered_partition_count", "partition_count", F.col("partition_count") > 0),
        )
    )


def keep_partitions(df: DataFrame, parts: DataFrame, columns: Sequence[str], part: str = "partition") -> DataFrame:
    """Rows of ``df`` lying in a listed partition, for lists of any length (a semi-join)."""
    listed = parts.select(*[P.partition_value(part, c).alias(f"_p_{c}") for c in columns]).distinct()
    same = [F.col(c).cast("string").eqNullSafe(F.col(f"_p_{c}")) for c in columns]
    return df.join(listed, reduce(lambda a, b: a & b, same), "left_semi")


def nonempty_partition_counts(files: DataFrame, keys: Sequence[str], part: str = "partition") -> DataFrame:
    """Partitions per table, in all and with data; a partition of unknown size counts as non-empty."""
    per_part = files.groupBy(*keys, part).agg(
        F.sum("length").alias("_bytes"), F.count_if(F.col("length").isNull()).alias("_unknown")
    )
    return per_part.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("partition_count"),
        F.count_if((F.col("_bytes") > 0) | (F.col("_unknown") > 0)).alias("nonempty_partition_count"),
    )
