"""Partition-filtered table copy: plan, copy, reconcile, record."""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F

from lakeshift.operators import control, ledger, partitions, reconcile
from lakeshift.operators import files as file_ops
from lakeshift.plans import destinations
from lakeshift.plans.stages import Stage, each_table, run_stages
from lakeshift.sources import files, inventory, storage
from lakeshift.sources.inventory import TableRef
from lakeshift.sources.scratch import stored
from lakeshift.sources.versioned import VersionedTable


def planned_tables(sheet: DataFrame, tables: DataFrame, default_bucket: str) -> DataFrame:
    """Control sheet x catalog -> one row per table to copy, with its destination and filter."""
    groups = ["dest_database", "dest_bucket", "dest_endpoint", "partition_filter"]
    parsed = control.parse_copy_control(sheet, default_bucket)
    tokens = control.control_tokens(parsed, ["source_database", *groups])
    return control.resolve_tokens(tokens, tables, ["source_database"], groups)


def planned_partitions(planned: DataFrame, registered: DataFrame) -> DataFrame:
    """Partitions that each planned copy has to move, by its own filter, with its destination.

    ``registered`` is (source_database, table_name, partition).
    """
    return partitions.apply_control_filters(
        registered, planned, ["source_database", "table_name"], groups=["dest_database", "dest_bucket", "dest_endpoint"]
    )


def reconcile_copies(source: DataFrame, dest: DataFrame, schema_differences: DataFrame) -> DataFrame:
    """Verdict per table over two copies given as (source_table, partition) rows.

    ``schema_differences`` is what :func:`reconcile.schema_verdict` says per source_table; a table
    without differences has no row there.

    Both sides are counted per partition first, so what is shuffled is one row per partition and
    task, not the data; the partition counts then give the table figures without another scan.
    """
    keys = ["source_table"]
    parts = reconcile.reconcile_partitions(
        reconcile.partition_metrics(source, F.col("partition"), keys),
        reconcile.partition_metrics(dest, F.col("partition"), keys),
        ["source_table", "partition"],
    )
    tables = parts.groupBy("source_table").agg(
        F.sum("source_row_count").alias("source_row_count"),
        F.sum("dest_row_count").alias("dest_row_count"),
        F.count_if("in_source").alias("source_partition_count"),
        F.count_if("in_dest").alias("dest_partition_count"),
        F.count_if(~F.col("row_count_match")).alias("partitions_off"),
    )
    flagged = tables.withColumns(
        {
            "row_count_match": F.col("source_row_count") == F.col("dest_row_count"),
            "partition_count_match": F.col("source_partition_count") == F.col("dest_partition_count"),
        }
    )
    checked = reconcile.with_schema_verdict(flagged, schema_differences, keys)
    return checked.withColumn("overall_status", reconcile.validation_status("copy"))


def discovery_records(
    inventory: DataFrame, run_id: str, facts: Mapping[str, Column] | None = None
) -> DataFrame:
    """Inventory rows as new ledger rows of a run; a table that could not be read is FAILED from the start."""
    failed = F.col("error").isNotNull()
    return inventory.withColumns(
        {
            "run_id": F.lit(run_id),
            "discovery_status": F.when(failed, "FAILED").otherwise("COMPLETED"),
            "overall_status": F.when(failed, "FAILED").otherwise("DISCOVERED"),
            "error_message": F.col("error"),
            **(facts or {}),
        }
    ).drop("error")


def copied_files(spark: SparkSession, source: str, dest: str, matched: DataFrame | None = None) -> dict:
    """Mirror the files of a table, or of its ``matched`` partitions only; figures of the destination before and after.

    What is copied is counted by metrics observed while it is copied, not by another pass.
    """
    def listed(root: str) -> DataFrame:
        found = files.file_manifest(spark, root)
        return found if matched is None else found.join(matched.select("partition"), "partition", "left_semi")

    files_before, size_before = storage.content_summary(spark, dest)
    theirs = listed(dest) if files_before else spark.createDataFrame([], "rel_path string, length long")
    plan = stored(file_ops.copy_plan(listed(source), theirs), "copy_plan")
    metrics = Observation()
    moved = files.copy_files(plan, source, dest).observe(
        metrics, F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("bytes_copied"), F.lit(0)).alias("bytes")
    )
    moved.write.format("noop").mode("overwrite").save()
    files.delete_extra(plan, dest).write.format("noop").mode("overwrite").save()
    files_after, size_after = storage.content_summary(spark, dest)
    return {
        "is_incremental": files_before > 0, "files_before": files_before, "size_before": size_before, "files_after": files_after, "size_after": size_after,
        "files_transferred": metrics.get["files"], "bytes_transferred": metrics.get["bytes"],
        "files_copied": max(0, files_after - files_before), "bytes_copied": max(0, size_after - size_before),
    }


COPY_RESULT = (
    "is_incremental boolean, files_before long, size_before long, files_after long, size_after long, "
    "files_transferred long, bytes_transferred long, files_copied long, bytes_copied long, duration_seconds double"
)


@dataclass(frozen=True)
class CopyRun:
    """A table copy from control sheet to closed run, over a ledger that survives the loss of the run.

    ``refs`` are the source tables, ``planned`` comes from :func:`planned_tables`; ``locate`` turns (bucket, database,
    table) into the destination folder.
    """

    spark: SparkSession
    ledger: VersionedTable
    run_id: str
    refs: Sequence[TableRef]
    planned: DataFrame
    locate: Callable[[str, str, str], str] = "{0}/{1}/{2}".format

    def _ref(self, row: Row) -> TableRef:
        return next(r for r in self.refs if (r.database, r.name) == (row.source_database, row.source_table))

    def _matched(self, row: Row) -> DataFrame | None:
        """Partition folders that the row's filter keeps, None without an active filter."""
        ref = self._ref(row)
        if not (row.partition_filter or "").strip() or not ref.partition_by or row.filtered_partition_count >= row.partition_count:
            return None
        found = files.file_manifest(self.spark, ref.location).select("partition").distinct()
        return partitions.apply_partition_filter(found, row.partition_filter)

    def discover(self) -> int:
        """Record every planned table that the ledger does not have yet; returns the ledger's version."""
        known = self.ledger.read().where(F.col("run_id") == self.run_id).select("source_database", "source_table", "dest_database")
        rows = self.planned.withColumnRenamed("table_name", "source_table").join(known, known.columns, "left_anti")
        rows = rows.select("source_database", "source_table", "dest_database", "dest_bucket", "partition_filter").distinct()
        due = [(*r, self.locate(r.dest_bucket, r.dest_database, r.source_table)) for r in rows.collect()]
        if not due:
            return self.ledger.version()
        wanted = self.spark.createDataFrame(due, "source_database string, source_table string, dest_database string, dest_bucket string, partition_filter string, dest_location string")
        chosen = {(r[0], r[1]) for r in due}
        refs = [r for r in self.refs if (r.database, r.name) in chosen]
        # one inventory per filter of a table: tables copied to several places by several filters are rare
        found = []
        for turn in range(max(Counter((r[0], r[1]) for r in due).values())):
            place = Window.partitionBy("source_database", "source_table").orderBy("dest_database", "dest_bucket")
            part = wanted.withColumn("_turn", F.row_number().over(place)).where(F.col("_turn") == turn + 1).drop("_turn")
            figures = inventory.inventory(self.spark, refs, part.select("source_database", "source_table", "partition_filter"))
            found.append(part.join(figures.drop("partition_filter"), ["source_database", "source_table"]))
        figures = reduce(DataFrame.unionByName, found)
        ledger_rows = discovery_records(figures, self.run_id).select(
            "*",
            F.col("location").alias("source_location"),
            F.col("row_count").alias("full_table_row_count"),
            F.col("partition_count").alias("full_table_partition_count"),
            F.col("filtered_row_count").alias("source_row_count"),
            F.col("filtered_file_count").alias("source_file_count"),
            F.col("filtered_size_bytes").alias("source_total_size_bytes"),
            F.col("filtered_partition_count").alias("source_partition_count"),
        )
        columns = [c for c in self.ledger.schema.names if c in ledger_rows.columns]
        new = stored(ledger_rows.select(*columns), "discovered")
        return self.ledger.update(lambda state: state.unionByName(new, allowMissingColumns=True))

    def _copy(self, row: Row) -> dict:
        start = time.monotonic()
        figures = copied_files(self.spark, self._ref(row).location, row.dest_location, self._matched(row))
        return figures | {"duration_seconds": time.monotonic() - start}

    def _create(self, row: Row) -> dict:
        if row.distcp_status != "COMPLETED":
            return {"status": "SKIPPED", "error": "copy did not complete"}
        return destinations.declared(self.spark, self._ref(row), row.dest_database, row.dest_location, self._matched(row))

    def _validate(self, rows: list[Row]) -> DataFrame:
        return destinations.checked(self.spark, self.run_id, [(r, self._ref(r), r.dest_location) for r in rows])

    def stages(self) -> list[Stage]:
        mine = F.col("run_id") == self.run_id
        keys = ledger.KEYS
        open_copy = mine & (F.col("discovery_status") == "COMPLETED") & F.col("distcp_status").isNull()
        open_create = mine & F.col("distcp_status").isNotNull() & F.col("table_create_status").isNull()
        open_check = mine & (F.col("table_create_status") == "COMPLETED") & F.col("validation_status").isNull()

        def copied(state: DataFrame, results: DataFrame) -> DataFrame:
            return ledger.patch_failures(ledger.advance_copy(state, results, keys), results, "distcp_status", keys)

        def created(state: DataFrame, results: DataFrame) -> DataFrame:
            return ledger.patch_failures(ledger.advance_create(state, results, keys), results, "table_create_status", keys)

        return [
            Stage("copy", open_copy, lambda rows: each_table(self.spark, rows, keys, COPY_RESULT, self._copy), copied),
            Stage("create", open_create, lambda rows: each_table(self.spark, rows, keys, "existed boolean", self._create), created),
            Stage("validate", open_check, self._validate, lambda state, results: ledger.advance_validate(state, results, keys)),
        ]

    def run(self, stop_after: str | None = None) -> DataFrame:
        """All stages, or those up to ``stop_after``; returns the ledger. Running again goes on where a run stopped."""
        self.discover()
        if stop_after == "discover":
            return self.ledger.read()
        return run_stages(self.ledger, self.stages(), stop_after)

    def finalize(self) -> DataFrame:
        """Totals and final status of the run."""
        return ledger.finalize_run(self.ledger.read().where(F.col("run_id") == self.run_id), "copy")
