"""Inventory: one record per table with what a migration has to know about it.

Rows are counted from file footers where the format has them, files and bytes come from listings; both are taken per
partition once, and the figures of a table, with and without its partition filter, are sums over its partitions.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.functions import partitions as P
from lakeshift.operators import partitions as ops
from lakeshift.sources import catalog, files, footers, storage, tables
from lakeshift.sources.scratch import stored

KEYS = ["source_database", "source_table"]


@dataclass(frozen=True)
class TableRef:
    """A table by name, place and shape; ``schema`` lists (name, type) of all columns, partition columns last."""

    database: str
    name: str
    location: str
    fmt: str = "PARQUET"
    schema: tuple[tuple[str, str], ...] = ()
    partition_by: tuple[str, ...] = ()
    table_type: str = "EXTERNAL"
    properties: dict = field(default_factory=dict, compare=False)

    @property
    def schema_json(self) -> str:
        return schema_json(self.schema)

    @property
    def ddl(self) -> str:
        return ", ".join(f"{catalog.quote(n)} {t}" for n, t in self.schema)


def schema_json(schema: Sequence[tuple[str, str]]) -> str:
    """Column list as the ledgers keep it."""
    return json.dumps([{"name": n, "type": t} for n, t in schema], separators=(",", ":"))


def catalog_refs(spark: SparkSession, database: str) -> list[TableRef]:
    """The tables of a catalog database; metadata calls only, a few per table."""
    out = []
    for t in sorted(r.name for r in spark.catalog.listTables(database) if not r.isTemporary):
        columns = spark.catalog.listColumns(f"{catalog.quote(database)}.{catalog.quote(t)}")
        facts = catalog.describe_table(spark, database, t).first()
        out.append(
            TableRef(
                database, t, facts.location, facts.file_format, tuple((c.name, c.dataType) for c in columns),
                tuple(c.name for c in columns if c.isPartition), facts.table_type,
            )
        )
    return out


def _partition_text(columns: Sequence[str], value) -> F.Column:
    """``k=v/...`` with plain values, so that listings and footers name a partition alike."""
    parts = [F.concat(F.lit(f"{c}="), F.coalesce(value(c), F.lit(P.HIVE_NULL))) for c in columns]
    return F.concat_ws("/", *parts) if parts else F.lit("")


def partition_figures(spark: SparkSession, refs: Sequence[TableRef]) -> DataFrame:
    """source_database, source_table, partition, row_count, file_count, size_bytes of each partition that holds files."""
    counting = footers.footer_session(spark)
    sides = []
    for r in refs:
        by = list(r.partition_by)
        listed = files.file_manifest(spark, r.location)
        text = _partition_text(by, lambda c: P.partition_value("partition", c))
        sides.append((r, listed.select(text.alias("partition"), F.lit(0).cast("long").alias("row_count"), F.lit(1).cast("long").alias("file_count"), F.col("length").alias("size_bytes"))))
        if r.fmt.lower() in footers.PUSHED:
            counts = footers.row_counts(counting, r.location, r.fmt, by)
        else:
            counts = tables.read_table_files(spark, r.fmt, r.location, r.ddl or None, r.properties).groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"))
        text = _partition_text(by, lambda c: F.col(c).cast("string"))
        sides.append((r, counts.select(text.alias("partition"), "row_count", F.lit(0).cast("long").alias("file_count"), F.lit(0).cast("long").alias("size_bytes"))))
    named = [df.select(F.lit(r.database).alias("source_database"), F.lit(r.name).alias("source_table"), "*") for r, df in sides]
    return reduce(DataFrame.unionByName, named).groupBy(*KEYS, "partition").agg(*[F.sum(c).alias(c) for c in ("row_count", "file_count", "size_bytes")])


def inventory(spark: SparkSession, refs: Sequence[TableRef], filters: DataFrame | None = None) -> DataFrame:
    """One record per table.

    ``filters`` is (source_database, source_table, partition_filter), at most one row per table. A filter is active when
    it leaves partitions out of a partitioned table; the ``filtered_`` figures are those of the partitions that it keeps,
    else those of the whole table. A table without a folder, or whose files cannot be read, has an ``error`` and zeros.
    """
    errors = {r: "location does not exist" for r in refs if not r.location or not storage.exists(spark, r.location)}
    parts = _figures(spark, [r for r in refs if r not in errors], errors)
    shape = "source_database string, source_table string, location string, file_format string, table_type string, schema_json string, partition_columns string, is_partitioned boolean, error string"
    rows = [(r.database, r.name, r.location, r.fmt, r.table_type, r.schema_json, ",".join(r.partition_by), bool(r.partition_by), errors.get(r)) for r in refs]
    records = spark.createDataFrame(rows, shape)
    if filters is None:
        filters = spark.createDataFrame([], "source_database string, source_table string, partition_filter string")
    asked = filters.where(F.trim("partition_filter") != "").select(*KEYS, "partition_filter")
    matched = ops.apply_control_filters(parts, asked, KEYS).select(*KEYS, "partition", F.lit(True).alias("_kept"))
    figures = ["row_count", "file_count", "size_bytes"]
    kept = F.col("_kept").isNotNull()
    sums = (
        parts.join(matched, [*KEYS, "partition"], "left")
        .groupBy(*KEYS)
        .agg(
            F.count(F.lit(1)).alias("partition_count"),
            F.count_if(kept).alias("_matched"),
            *[F.sum(c).alias(c) for c in figures],
            *[F.coalesce(F.sum(F.when(kept, F.col(c))), F.lit(0)).alias(f"_f_{c}") for c in figures],
        )
    )
    out = records.join(sums, KEYS, "left").join(asked, KEYS, "left")
    out = out.fillna(0, ["partition_count", "_matched", *figures, *[f"_f_{c}" for c in figures]])
    total = F.when(F.col("is_partitioned"), F.col("partition_count")).otherwise(0).cast("int")
    active = P.filter_active(F.col("partition_filter"), F.col("_matched"), F.col("partition_count"), F.col("is_partitioned"))
    out = out.withColumn("filter_active", active)
    return out.select(
        *records.columns[:-1],
        total.alias("partition_count"),
        *figures,
        "partition_filter",
        "filter_active",
        F.when(F.col("filter_active"), F.col("_matched")).otherwise(total).cast("int").alias("filtered_partition_count"),
        *[F.when(F.col("filter_active"), F.col(f"_f_{c}")).otherwise(F.col(c)).alias(f"filtered_{c}") for c in figures],
        "error",
    )


def _figures(spark: SparkSession, refs: list[TableRef], errors: dict[TableRef, str]) -> DataFrame:
    """Partition figures of the tables that can be read; the others get an entry in ``errors``."""
    if not refs:
        return spark.createDataFrame([], "source_database string, source_table string, partition string, row_count long, file_count long, size_bytes long")
    try:
        return stored(partition_figures(spark, refs), "inventory")
    except Exception as e:  # one unreadable table must not cost the others theirs
        if len(refs) == 1:
            if isinstance(e, AnalysisException) and "UNABLE_TO_INFER_SCHEMA" in str(e):
                errors[refs[0]] = "no readable files"
            else:
                errors[refs[0]] = f"files cannot be read: {str(e).splitlines()[0]}"
            return _figures(spark, [], errors)
        half = len(refs) // 2
        return _figures(spark, refs[:half], errors).unionByName(_figures(spark, refs[half:], errors))
