"""Metadata-only migration: which tables to declare at the destination, and where their files lie."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lakeshift.functions.cells import dest_path
from lakeshift.operators import control, ledger
from lakeshift.plans import destinations
from lakeshift.plans.copy_run import discovery_records
from lakeshift.plans.stages import Stage, each_table, run_stages
from lakeshift.sources import inventory, storage
from lakeshift.sources.inventory import TableRef
from lakeshift.sources.scratch import stored
from lakeshift.sources.versioned import VersionedTable

GROUPS = ["dest_database", "dest_bucket", "source_s3_prefix", "dest_s3_prefix"]
STRATEGIES = ("hive", "iceberg")


def planned_tables(strategy: str, sheet: DataFrame, default_bucket: str, tables: DataFrame | None = None) -> DataFrame:
    """Tables of a metadata sheet with source location and destination path.

    ``hive`` resolves table names and shell patterns against ``tables`` (source_database,
    table_name, location) and drops names the catalog lacks; ``iceberg`` takes one table path per
    sheet row.
    """
    # stored: tokens and entries read the parsed cells many times, and their filters would be pushed below the parsing
    parsed = stored(control.parse_metadata_control(sheet, default_bucket), "parsed_sheet")
    keys = ["source_database", *GROUPS]
    if strategy == "hive":
        tokens = stored(control.control_tokens(parsed, keys), "tokens")  # plain names and patterns are taken from it, the latter twice
        found = control.resolve_tokens(
            tokens, tables.select("source_database", "table_name"), ["source_database"], GROUPS, strict=True
        ).join(tables, ["source_database", "table_name"])
    elif strategy == "iceberg":
        found = control.control_entries(parsed, keys).withColumnRenamed("source_table_path", "location")
    else:
        raise ValueError(f"unknown metadata strategy: {strategy}; known: {', '.join(STRATEGIES)}")
    return found.select(
        "source_database",
        "table_name",
        "dest_database",
        "location",
        dest_path("location", "dest_database", "table_name", "dest_bucket", "source_s3_prefix", "dest_s3_prefix").alias("dest_path"),
        F.lit(strategy).alias("strategy"),
    )


@dataclass(frozen=True)
class MetadataRun:
    """A metadata-only migration from plan to closed run: files are at the destination already, tables are declared over them.

    ``planned`` comes from :func:`planned_tables`, ``refs`` are the source tables. A table goes on only if files lie at its
    destination; it is DATA_MISSING otherwise.
    """

    spark: SparkSession
    ledger: VersionedTable
    run_id: str
    refs: Sequence[TableRef]
    planned: DataFrame

    def _ref(self, row: Row) -> TableRef:
        return next(r for r in self.refs if (r.database, r.name) == (row.source_database, row.source_table))

    def discover(self) -> int:
        """Record every planned table that the ledger does not have yet; returns the ledger's version."""
        keys = ["source_database", "source_table", "dest_database"]
        known = self.ledger.read().where(F.col("run_id") == self.run_id).select(*keys)
        rows = self.planned.withColumnRenamed("table_name", "source_table").join(known, keys, "left_anti")
        due = rows.select(*keys, F.col("dest_path").alias("dest_s3_location")).distinct().collect()
        if not due:
            return self.ledger.version()
        wanted = self.spark.createDataFrame(due, ", ".join(f"{c} string" for c in [*keys, "dest_s3_location"]))
        chosen = {(r.source_database, r.source_table) for r in due}
        figures = inventory.inventory(self.spark, [r for r in self.refs if (r.database, r.name) in chosen])
        records = wanted.join(figures.drop("partition_filter"), ["source_database", "source_table"])
        records = discovery_records(records, self.run_id).select(
            "*",
            F.col("location").alias("source_s3_location"),
            F.col("row_count").alias("source_row_count"),
            F.col("file_count").alias("source_file_count"),
            F.col("size_bytes").alias("source_total_size_bytes"),
            F.col("partition_count").alias("source_partition_count"),
        )
        new = stored(records.select(*[c for c in self.ledger.schema.names if c in records.columns]), "discovered")
        return self.ledger.update(lambda state: state.unionByName(new, allowMissingColumns=True))

    def _present(self, row: Row) -> dict:
        files, size = storage.content_summary(self.spark, row.dest_s3_location)
        return {"status": "CONFIRMED" if files else "MISSING", "error": None if files else f"no files at {row.dest_s3_location}", "file_count": files, "size_bytes": size}

    def _create(self, row: Row) -> dict:
        if row.data_presence_status != "CONFIRMED":
            return {"status": "SKIPPED", "error": row.error_message}
        return destinations.declared(self.spark, self._ref(row), row.dest_database, row.dest_s3_location)

    def _validate(self, rows: list[Row]) -> DataFrame:
        return destinations.checked(self.spark, self.run_id, [(r, self._ref(r), r.dest_s3_location) for r in rows])

    def stages(self) -> list[Stage]:
        mine, keys = F.col("run_id") == self.run_id, ledger.KEYS
        open_presence = mine & (F.col("discovery_status") == "COMPLETED") & F.col("data_presence_status").isNull()
        open_create = mine & F.col("data_presence_status").isNotNull() & F.col("table_create_status").isNull()
        open_check = mine & (F.col("table_create_status") == "COMPLETED") & F.col("validation_status").isNull()
        return [
            Stage(
                "presence", open_presence, lambda rows: each_table(self.spark, rows, keys, "file_count long, size_bytes long", self._present),
                lambda state, results: ledger.advance_presence(state, results, keys),
            ),
            Stage(
                "create", open_create, lambda rows: each_table(self.spark, rows, keys, "existed boolean", self._create),
                lambda state, results: ledger.advance_create(state, results, keys, metadata=True),
            ),
            Stage("validate", open_check, self._validate, lambda state, results: ledger.advance_validate(state, results, keys, "metadata")),
        ]

    def run(self, stop_after: str | None = None) -> DataFrame:
        """All stages, or those up to ``stop_after``; returns the ledger. Running again goes on where a run stopped."""
        self.discover()
        return self.ledger.read() if stop_after == "discover" else run_stages(self.ledger, self.stages(), stop_after)

    def finalize(self) -> DataFrame:
        """Totals and final status of the run."""
        return ledger.finalize_run(self.ledger.read().where(F.col("run_id") == self.run_id), "metadata")
