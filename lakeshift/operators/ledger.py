"""Status-ledger operators. A stage is one join of the whole ledger with the stage's results.

Parquet has no row-level UPDATE, so every change is a join that yields the new ledger; the caller
writes it (see ``sources.tables.replace_table``). Keys are (run_id, source_database, source_table,
dest_database) unless given.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshift.functions import measures as M
from lakeshift.operators.reconcile import validation_status

KEYS = ("run_id", "source_database", "source_table", "dest_database")
CONVERSION_KEYS = ("run_id", "source_database", "source_table")
# Column that holds the state of an item, per ledger.
STATUS_COLUMN = {
    "copy": "overall_status",
    "convert": "status",
    "folder": "status",
    "metadata": "overall_status",
    "policy": "status",
}
# Validation columns that the conversion ledger names differently.
CONVERSION_NAMES = {
    "overall_status": "status",
    "source_row_count": "source_hive_row_count",
    "dest_hive_row_count": "destination_iceberg_row_count",
    "source_partition_count": "source_hive_partition_count",
    "dest_partition_count": "dest_iceberg_partition_count",
}
HIT = "_hit"


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update_cols: Sequence[str] | None = None
) -> DataFrame:
    """Update matched rows in ``update_cols`` (default: all other source columns), insert the rest.

    Source keys must be unique, as MERGE demands: a repeated one fails the job. :func:`duplicate_keys`
    lists them.
    """
    keys = list(keys)
    source = unique_rows(source, keys)
    values = [c for c in source.columns if c not in keys]
    update_cols = values if update_cols is None else list(update_cols)
    t = target.withColumn("_t", F.lit(True))
    s = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in values], F.lit(True).alias("_s"))
    joined = t.join(s, keys, "full_outer")
    new, old_only = F.col("_t").isNull(), F.col("_s").isNull()
    out = []
    for c in target.columns:
        if c in keys or c not in values:
            out.append(F.col(c))
        elif c in update_cols:
            out.append(F.when(old_only, F.col(c)).otherwise(F.col(f"_s_{c}")).alias(c))
        else:
            out.append(F.when(new, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c))
    return joined.select(*out)


def duplicate_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once and would make an upsert ambiguous."""
    return source.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)


def unique_rows(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows; a key that occurs twice fails the job.

    Groups by the keys of the join that follows, so no exchange is added.
    """
    keys = list(keys)
    values = [c for c in source.columns if c not in keys]
    if not values:
        return source.distinct()
    text = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
    rows = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*values)).alias("_v"))
    # a condition on the rows, not part of a value: values that nobody reads are left out of a plan
    repeated = F.raise_error(F.concat(F.lit("key occurs more than once: "), text)).cast("boolean")
    rows = rows.where(F.when(F.col("_n") > 1, repeated).otherwise(F.lit(True)))
    return rows.select(*keys, "_v.*").select(*source.columns)


def replace_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete target rows whose key occurs in ``source``, then add the source rows."""
    kept = target.join(source.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def apply_results(
    ledger: DataFrame, results: DataFrame, keys: Sequence[str], changes: Mapping[str, Column]
) -> DataFrame:
    """Left-join results (columns prefixed ``r_``) and set ``changes`` on matched rows only."""
    keys = list(keys)
    results = unique_rows(results, keys)
    r = results.select(
        *keys, *[F.col(c).alias(f"r_{c}") for c in results.columns if c not in keys], F.lit(True).alias(HIT)
    )
    joined = ledger.join(r, keys, "left")
    hit = F.col(HIT).isNotNull()
    return joined.select(
        *[
            F.when(hit, changes[c]).otherwise(F.col(c)).cast(ledger.schema[c].dataType).alias(c)
            if c in changes
            else F.col(c)
            for c in ledger.columns
        ]
    )


def _error() -> Column:
    return F.coalesce("r_error", F.lit(""))


def _error_if_failed() -> Column:
    return F.when(F.col("r_status") == "FAILED", _error()).otherwise(F.col("error_message"))


def advance_copy(ledger: DataFrame, results: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Copy results: figures, match flags and COPIED / FAILED. Skipped results change nothing."""
    filtered = F.coalesce("partition_filter", F.lit("")) != ""
    files = F.when(filtered, F.col("r_files_transferred")).otherwise(F.col("r_files_after"))
    size = F.when(filtered, F.col("r_bytes_transferred")).otherwise(F.col("r_size_after"))
    measured = {
        "distcp_started_at": "started_at",
        "distcp_completed_at": "completed_at",
        "distcp_duration_seconds": "duration_seconds",
        "distcp_is_incremental": "is_incremental",
        "distcp_bytes_copied": "bytes_copied",
        "distcp_files_copied": "files_copied",
        "s3_total_size_bytes_before": "size_before",
        "s3_file_count_before": "files_before",
        "s3_total_size_bytes_after": "size_after",
        "s3_file_count_after": "files_after",
        "s3_bytes_transferred": "bytes_transferred",
        "s3_files_transferred": "files_transferred",
    }
    changes = {c: F.col(f"r_{r}") for c, r in measured.items() if c in ledger.columns and r in results.columns}
    changes |= {
        "distcp_status": F.col("r_status"),
        "file_count_match": F.col("source_file_count") == files,
        "file_size_match": M.size_match_rel("source_total_size_bytes", size),
        "overall_status": F.when(F.col("r_status") == "COMPLETED", "COPIED").otherwise("FAILED"),
        "error_message": _error_if_failed(),
    }
    return apply_results(ledger, results.where(F.col("status") != "SKIPPED"), keys, changes)


def advance_create(
    ledger: DataFrame, results: DataFrame, keys: Sequence[str] = KEYS, metadata: bool = False
) -> DataFrame:
    """Table-creation results. FAILED stays FAILED; in the metadata flow a skipped table counts as
    DATA_MISSING and that state stays too."""
    skipped = "DATA_MISSING" if metadata else "SKIPPED"
    other = "FAILED" if metadata else "SKIPPED"
    new = (
        F.when(F.col("r_status") == "COMPLETED", "TABLE_CREATED")
        .when(F.col("r_status") == "FAILED", "FAILED")
        .when(F.col("r_status") == "SKIPPED", skipped)
        .otherwise(other)
    )
    sticky = ["FAILED", "DATA_MISSING"] if metadata else ["FAILED"]
    keep = F.col("overall_status").isin(sticky) | (F.col("overall_status").isNull() if not metadata else F.lit(False))
    return apply_results(
        ledger,
        results,
        keys,
        {
            "table_create_status": F.col("r_status"),
            "table_already_existed": F.coalesce("r_existed", F.lit(False)),
            "overall_status": F.when(keep, F.col("overall_status")).otherwise(new),
            "error_message": _error_if_failed(),
        },
    )


def advance_presence(
    ledger: DataFrame, results: DataFrame, keys: Sequence[str] = ("run_id", "source_database", "source_table")
) -> DataFrame:
    """Data-presence results: DATA_CONFIRMED, DATA_MISSING or FAILED."""
    state = (
        F.when(F.col("r_status") == "CONFIRMED", "DATA_CONFIRMED")
        .when(F.col("r_status") == "MISSING", "DATA_MISSING")
        .otherwise("FAILED")
    )
    return apply_results(
        ledger,
        results,
        keys,
        {
            "data_presence_status": F.col("r_status"),
            "data_presence_file_count": F.col("r_file_count"),
            "data_presence_size_bytes": F.col("r_size_bytes"),
            "overall_status": state,
            "error_message": F.when(F.col("r_status") != "CONFIRMED", _error()).otherwise(F.col("error_message")),
        },
    )


def validation_message(variant: str) -> Column:
    """Null when valid; the mismatch text when there is one; else the message already there."""
    valid = validation_status(variant, "r_row_count_match", "r_partition_count_match", "r_schema_match") == "VALIDATED"
    text = F.col("r_error")
    if variant == "metadata":
        return F.when(valid, F.lit(None)).otherwise(F.coalesce(text, F.lit("")))
    return F.when(valid, F.lit(None)).otherwise(F.coalesce(F.nullif(text, F.lit("")), F.col("error_message")))


def advance_validate(
    ledger: DataFrame, results: DataFrame, keys: Sequence[str] = KEYS, variant: str = "copy"
) -> DataFrame:
    """Validation results; a FAILED table keeps its state and message. Only completed results count."""
    overall = F.col(STATUS_COLUMN[variant])
    failed = F.coalesce(overall == "FAILED", F.lit(False))
    state = validation_status(variant, "r_row_count_match", "r_partition_count_match", "r_schema_match")
    changes = {
        "validation_status": F.col("r_status"),
        "source_row_count": M.zero("r_source_row_count"),
        "dest_hive_row_count": M.zero("r_dest_row_count"),
        "source_partition_count": M.zero("r_source_partition_count"),
        "dest_partition_count": M.zero("r_dest_partition_count"),
        "row_count_match": F.coalesce("r_row_count_match", F.lit(False)),
        "partition_count_match": F.coalesce("r_partition_count_match", F.lit(False)),
        "schema_match": F.coalesce("r_schema_match", F.lit(False)),
        "schema_differences": F.coalesce("r_schema_differences", F.lit("")),
        "overall_status": F.when(failed, overall).otherwise(state),
        "error_message": F.when(failed, F.col("error_message")).otherwise(validation_message(variant)),
    }
    if variant == "metadata":
        del changes["source_row_count"]
    if variant == "convert":
        changes = {CONVERSION_NAMES.get(c, c): v for c, v in changes.items()}
    return apply_results(ledger, results.where(F.col("status") == "COMPLETED"), keys, changes)


def advance_folder(
    ledger: DataFrame, results: DataFrame, keys: Sequence[str] = ("run_id", "source_path", "dest_bucket", "dest_path")
) -> DataFrame:
    """Folder-validation results; a non-empty error replaces the message."""
    error = F.coalesce("r_validation_error", F.lit(""))
    return apply_results(
        ledger,
        results,
        keys,
        {
            "status": F.coalesce("r_validation_status", F.lit("VALIDATION_FAILED")),
            "dest_file_count": M.zero("r_dest_file_count"),
            "dest_size_bytes": M.zero("r_dest_size_bytes"),
            "file_count_match": F.coalesce("r_file_count_match", F.lit(False)),
            "size_match": F.coalesce("r_size_match", F.lit(False)),
            "error_message": F.when(error != "", error).otherwise(F.col("error_message")),
        },
    )


def patch_failures(
    ledger: DataFrame,
    results: DataFrame,
    stage_col: str,
    keys: Sequence[str] = KEYS,
    overall: str = "FAILED",
    overall_col: str = "overall_status",
) -> DataFrame:
    """Mark failed results on rows whose stage is still open; other rows stay untouched."""
    failed = results.where((F.col("status") == "FAILED") & (F.coalesce("error", F.lit("")) != ""))
    still_open = F.col(stage_col).isNull()
    changes = {
        stage_col: F.when(still_open, "FAILED").otherwise(F.col(stage_col)),
        overall_col: F.when(still_open, overall).otherwise(F.col(overall_col)),
        "error_message": F.when(still_open, _error()).otherwise(F.col("error_message")),
    }
    if stage_col == overall_col:
        changes.pop(overall_col)
        changes[stage_col] = F.when(still_open, overall).otherwise(F.col(stage_col))
    return apply_results(ledger, failed.select(*keys, "status", "error"), keys, changes)


def mark_unprocessed(
    ledger: DataFrame,
    processed: DataFrame,
    stage_col: str,
    message: str,
    keys: Sequence[str] = KEYS,
    eligible: Column | None = None,
    stage_value: str = "FAILED",
    overall: str = "FAILED",
    overall_col: str = "overall_status",
) -> DataFrame:
    """Close rows that were due but have no result: an anti-join as a flag, then a conditional set.

    FAILED is never overwritten and an existing message is kept.
    """
    done = processed.select(*keys).distinct().withColumn("_done", F.lit(True))
    due = F.col("_done").isNull() & F.col(stage_col).isNull() & (F.lit(True) if eligible is None else eligible)
    due = F.coalesce(due, F.lit(False))
    joined = ledger.join(done, list(keys), "left")
    new = {
        stage_col: F.when(due, stage_value).otherwise(F.col(stage_col)),
        overall_col: F.when(due & (F.coalesce(overall_col, F.lit("")) != "FAILED"), overall).otherwise(F.col(overall_col)),
        "error_message": F.when(due, F.coalesce("error_message", F.lit(message))).otherwise(F.col("error_message")),
    }
    return joined.select(*[new[c].alias(c) if c in new else F.col(c) for c in ledger.columns])


def backfill_duration(ledger: DataFrame, column: str, seconds: Column) -> DataFrame:
    """Set the task's duration where none was measured."""
    return ledger.withColumn(column, F.when(F.col(column) == 0, seconds).otherwise(F.col(column)))


def close_running(ledger: DataFrame, message: str, status_col: str = "status") -> DataFrame:
    """Rows left RUNNING at the end of a run become FAILED."""
    running = F.coalesce(F.col(status_col) == "RUNNING", F.lit(False))
    text = F.coalesce(F.nullif(F.col("error_message"), F.lit("")), F.lit(message))
    return ledger.withColumns(
        {
            status_col: F.when(running, "FAILED").otherwise(F.col(status_col)),
            "error_message": F.when(running, text).otherwise(F.col("error_message")),
        }
    )


def lookup_copy_status(tables: DataFrame, copies: DataFrame, order: str) -> DataFrame:
    """Copy status per table: exact (table, destination) match first, then the table alone.

    Both lookups take the first result in ``order``, so each right side is unique before the join.
    """
    def first(keys: Sequence[str], alias: str) -> DataFrame:
        return copies.groupBy(*keys).agg(F.min(F.struct(order, "status")).getField("status").alias(alias))

    status = F.coalesce("_exact", "_any", F.lit("UNKNOWN"))
    return (
        tables.join(first(["source_table", "dest_database"], "_exact"), ["source_table", "dest_database"], "left")
        .join(first(["source_table"], "_any"), ["source_table"], "left")
        .select(*tables.columns, status.alias("distcp_status"))
    )


def copy_gate(tables: DataFrame, copies: DataFrame, order: str) -> DataFrame:
    """Tables whose copy did not complete are SKIPPED before creation; the rest are READY."""
    blocked = F.col("distcp_status").isin("FAILED", "SKIPPED", "UNKNOWN")
    return lookup_copy_status(tables, copies, order).withColumns(
        {
            "gate": F.when(blocked, "SKIPPED").otherwise("READY"),
            "gate_error": F.when(blocked, F.concat(F.lit("copy status was "), F.col("distcp_status"))),
        }
    )


def presence_gate(tables: DataFrame, presence: DataFrame, keys: Sequence[str] = ("source_database", "source_table")) -> DataFrame:
    """Only tables whose data is CONFIRMED at the destination go on to creation.

    Of several results for a table, any other than CONFIRMED decides.
    """
    bad = F.min(F.when(F.col("status") != "CONFIRMED", F.col("status")))
    p = presence.groupBy(*keys).agg(F.coalesce(bad, F.min("status")).alias("_presence"))
    status = F.coalesce("_presence", F.lit("UNKNOWN"))
    blocked = status != "CONFIRMED"
    return tables.join(p, list(keys), "left").select(
        *tables.columns,
        status.alias("data_presence_status"),
        F.when(blocked, "SKIPPED").otherwise("READY").alias("gate"),
        F.when(blocked, F.concat(F.lit("data not present at destination (status="), status, F.lit(")"))).alias(
            "gate_error"
        ),
    )


def validation_gate(
    tables: DataFrame, ledger: DataFrame, keys: Sequence[str] = KEYS, metadata: bool = False
) -> DataFrame:
    """Tables whose earlier stages failed are SKIPPED before validation."""
    if metadata:
        blocked = F.coalesce(F.col("table_create_status").isin("FAILED", "SKIPPED"), F.lit(False)) | ~F.coalesce(
            F.col("data_presence_status") == "CONFIRMED", F.lit(False)
        )
        reason = F.concat(F.lit("upstream status: "), F.coalesce("overall_status", F.lit("")))
    else:
        blocked = (
            F.coalesce(F.col("distcp_status") == "FAILED", F.lit(False))
            | F.coalesce(F.col("table_create_status").isin("FAILED", "SKIPPED"), F.lit(False))
            | F.coalesce(F.col("overall_status") == "FAILED", F.lit(False))
        )
        reason = F.concat(F.lit("upstream failure: "), F.coalesce("error_message", F.lit("")))
    # the verdict is taken on the ledger side; a table without a ledger row has nothing against it
    verdict = ledger.groupBy(*keys).agg(F.min(F.when(blocked, reason)).alias("_reason"))
    return tables.join(verdict, list(keys), "left").select(
        *tables.columns,
        F.when(F.col("_reason").isNotNull(), "SKIPPED").otherwise("READY").alias("gate"),
        F.col("_reason").alias("gate_error"),
    )


# States that count as success / failure when a run is closed.
SUCCESS_STATES = {
    "copy": ["VALIDATED", "VALIDATED_WITH_WARNINGS", "TABLE_CREATED"],
    "convert": ["VALIDATED", "COMPLETED"],
    "folder": ["VALIDATED"],
    "metadata": ["VALIDATED"],
}
FAILURE_STATES = {
    "copy": ["FAILED", "VALIDATION_FAILED"],
    "convert": ["FAILED"],
    "folder": ["FAILED", "VALIDATION_FAILED", "VALIDATION_SKIPPED"],
}


def finalize_run(ledger: DataFrame, variant: str, runs: DataFrame | None = None) -> DataFrame:
    """Totals and final status per run; runs without ledger rows appear when ``runs`` is given."""
    status = F.col(STATUS_COLUMN[variant])
    failed = status.like("%FAIL%") if variant == "metadata" else status.isin(FAILURE_STATES[variant])
    figures = [
        F.count(F.lit(1)).alias("total"),
        F.count_if(status.isin(SUCCESS_STATES[variant])).alias("successful"),
        F.count_if(failed).alias("failed"),
    ]
    if variant == "convert":
        figures += [
            F.count_if(status == "SKIPPED").alias("skipped"),
            F.count_if(~F.col("row_count_match")).alias("count_mismatches"),
        ]
    if variant == "metadata":
        figures.append(F.count_if(status == "DATA_MISSING").alias("missing"))
    totals = ledger.groupBy("run_id").agg(*figures)
    if runs is not None:
        totals = runs.select("run_id").distinct().join(totals, "run_id", "left").fillna(0)
    clean = F.col("failed") == 0
    if variant == "folder":
        final = F.when(clean, "COMPLETED").otherwise("COMPLETED_WITH_ERRORS")
    elif variant == "metadata":
        final = (
            F.when(F.col("total") == 0, "FAILED")
            .when(clean & (F.col("missing") == 0), "COMPLETED")
            .when(clean, "COMPLETED_WITH_MISSING")
            .otherwise("COMPLETED_WITH_FAILURES")
        )
    else:
        final = (
            F.when(F.col("total") == 0, "FAILED").when(clean, "COMPLETED").otherwise("COMPLETED_WITH_FAILURES")
        )
    return totals.withColumn("run_status", final)
