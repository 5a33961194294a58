"""Table-format conversion with its reconciliation."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lakeshift.operators import control, ledger, reconcile
from lakeshift.plans import destinations
from lakeshift.plans.stages import Stage, each_table, run_stages
from lakeshift.sources import catalog, inventory
from lakeshift.sources.inventory import TableRef
from lakeshift.sources.scratch import stored
from lakeshift.sources.tables import convert_table, without_ntz
from lakeshift.sources.versioned import VersionedTable


def write_snapshot(source: DataFrame, path: str, partition_by: Sequence[str], fmt: str) -> None:
    """Converted copy of a table, partitioned as the source; a rerun replaces it."""
    writer = without_ntz(source).write.format(fmt).mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def reconcile_conversion(
    source: DataFrame, converted: DataFrame, partition: str, table: Column, schema_differences: DataFrame
) -> DataFrame:
    """Row and partition counts of both formats per table, with the conversion verdict.

    ``schema_differences`` is what :func:`reconcile.schema_verdict` says per source_table.
    """
    def counted(df: DataFrame) -> DataFrame:
        return reconcile.partition_metrics(df.withColumn("source_table", table), F.col(partition), ["source_table"])

    parts = reconcile.reconcile_partitions(counted(source), counted(converted), ["source_table", "partition"])
    tables = parts.groupBy("source_table").agg(
        F.sum("source_row_count").alias("source_hive_row_count"),
        F.sum("dest_row_count").alias("destination_iceberg_row_count"),
        F.count_if("in_source").alias("source_hive_partition_count"),
        F.count_if("in_dest").alias("dest_iceberg_partition_count"),
    )
    flagged = tables.withColumns(
        {
            "row_count_match": F.col("source_hive_row_count") == F.col("destination_iceberg_row_count"),
            "partition_count_match": F.col("source_hive_partition_count") == F.col("dest_iceberg_partition_count"),
        }
    )
    checked = reconcile.with_schema_verdict(flagged, schema_differences, ["source_table"])
    return checked.withColumn("status", reconcile.validation_status("convert"))


def planned_conversions(sheet: DataFrame, tables: DataFrame) -> DataFrame:
    """Conversion sheet x catalog (source_database, table_name) -> one row per table to convert."""
    groups = ["dest_database", "inplace"]
    tokens = control.control_tokens(control.parse_conversion_control(sheet), ["source_database", *groups])
    return control.resolve_tokens(tokens, tables, ["source_database"], groups)


@dataclass(frozen=True)
class ConversionRun:
    """Format conversions from plan to closed run. A table with a destination of its own gets a converted copy, others are converted in place."""

    spark: SparkSession
    ledger: VersionedTable
    run_id: str
    refs: Sequence[TableRef]
    planned: DataFrame
    fmt: str | None = None

    def _ref(self, row: Row) -> TableRef:
        return next(r for r in self.refs if (r.database, r.name) == (row.source_database, row.source_table))

    def discover(self) -> int:
        """Record every planned table with its counts, taken before anything is converted; returns the ledger's version."""
        keys = ["source_database", "source_table"]
        known = self.ledger.read().where(F.col("run_id") == self.run_id).select(*keys)
        rows = self.planned.withColumnRenamed("table_name", "source_table").join(known, keys, "left_anti")
        due = rows.groupBy(*keys).agg(F.min(F.struct("position", "dest_database", "inplace")).alias("x")).select(*keys, "x.dest_database", "x.inplace").collect()
        if not due:
            return self.ledger.version()
        chosen = {(r.source_database, r.source_table) for r in due}
        figures = inventory.inventory(self.spark, [r for r in self.refs if (r.database, r.name) in chosen])
        wanted = self.spark.createDataFrame(due, "source_database string, source_table string, destination_database string, inplace boolean")
        failed = F.col("error").isNotNull()
        records = wanted.join(figures, keys).select(
            F.lit(self.run_id).alias("run_id"), *keys, "destination_database", F.col("source_table").alias("destination_table"),
            F.when(F.col("inplace"), "INPLACE").otherwise("SNAPSHOT").alias("migration_type"), F.col("location").alias("table_location"),
            F.when(failed, "FAILED").otherwise("RUNNING").alias("status"), F.col("error").alias("error_message"),
            F.col("row_count").alias("source_hive_row_count"), F.col("partition_count").alias("source_hive_partition_count"),
        )
        new = stored(records, "discovered")
        return self.ledger.update(lambda state: state.unionByName(new, allowMissingColumns=True))

    def _convert(self, row: Row) -> dict:
        start, ref = time.monotonic(), self._ref(row)
        source = f"{ref.database}.{ref.name}"
        dest = None
        if row.migration_type == "SNAPSHOT":
            catalog.ensure_databases(self.spark, [row.destination_database])
            dest = f"{row.destination_database}.{row.destination_table}"
        convert_table(self.spark, source, dest, ref.partition_by, self.fmt)
        return {"seconds": time.monotonic() - start}

    def _validate(self, rows: list[Row]) -> DataFrame:
        tables = []
        for r in rows:
            database = r.destination_database if r.migration_type == "SNAPSHOT" else r.source_database
            found = catalog.describe_table(self.spark, database, r.destination_table).first()
            ref = self._ref(r)
            shaped = TableRef(ref.database, ref.name, found.location, found.file_format, ref.schema, ref.partition_by)
            row = Row(
                source_database=r.source_database, source_table=r.source_table, dest_database=database,
                source_row_count=r.source_hive_row_count, source_partition_count=r.source_hive_partition_count,
            )
            tables.append((row, shaped, found.location))
        return destinations.checked(self.spark, self.run_id, tables).drop("dest_database")

    def stages(self) -> list[Stage]:
        mine, keys = F.col("run_id") == self.run_id, ledger.CONVERSION_KEYS
        open_convert = mine & (F.col("status") == "RUNNING") & F.col("migration_duration_seconds").isNull()
        open_check = mine & (F.col("status") == "COMPLETED") & F.col("validation_status").isNull()

        def converted(state: DataFrame, results: DataFrame) -> DataFrame:
            return ledger.apply_results(
                state, results, keys, {"status": F.col("r_status"), "error_message": F.col("r_error"), "migration_duration_seconds": F.col("r_seconds")}
            )

        return [
            Stage("convert", open_convert, lambda rows: each_table(self.spark, rows, keys, "seconds double", self._convert), converted),
            Stage("validate", open_check, self._validate, lambda state, results: ledger.advance_validate(state, results, keys, "convert")),
        ]

    def run(self, stop_after: str | None = None) -> DataFrame:
        """All stages, or those up to ``stop_after``; returns the ledger. Running again goes on where a run stopped."""
        self.discover()
        return self.ledger.read() if stop_after == "discover" else run_stages(self.ledger, self.stages(), stop_after)

    def finalize(self) -> DataFrame:
        """Totals and final status of the run."""
        return ledger.finalize_run(self.ledger.read().where(F.col("run_id") == self.run_id), "convert")
