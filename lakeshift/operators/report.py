"""Report datasets: summaries, details, data checks and performance figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshift.functions import measures as M
from lakeshift.operators.ledger import FAILURE_STATES, STATUS_COLUMN, SUCCESS_STATES


def dominant_value(df: DataFrame, column: str) -> DataFrame:
    """Most frequent value; ties go to the smallest value."""
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("value_count"))
        .orderBy(F.col("value_count").desc(), F.col(column).asc())
        .limit(1)
    )


def validation_summary(ledger: DataFrame, keys: Sequence[str] = ("run_id",)) -> DataFrame:
    """Pass / fail counts of validated tables; an unknown flag counts on neither side."""
    r, p, s = F.col("row_count_match"), F.col("partition_count_match"), F.col("schema_match")
    return (
        ledger.where(F.col("validation_status") == "COMPLETED")
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("tables_validated"),
            F.count_if(r & p & s).alias("tables_passed"),
            F.count_if(~r | ~p | ~s).alias("tables_failed"),
            F.count_if(~r).alias("row_count_mismatches"),
            F.count_if(~p).alias("partition_count_mismatches"),
            F.count_if(~s).alias("schema_mismatches"),
        )
    )


def file_metric_summary(ledger: DataFrame, keys: Sequence[str] = ("run_id",)) -> DataFrame:
    """Size and file-count agreement of copied tables, with the overall size difference."""
    figures = (
        ledger.where(F.col("distcp_status") == "COMPLETED")
        .groupBy(*keys)
        .agg(
            F.count_if(F.col("file_size_match")).alias("size_matches"),
            F.count_if(~F.col("file_size_match")).alias("size_mismatches"),
            F.count_if(F.col("file_count_match")).alias("file_count_matches"),
            F.count_if(~F.col("file_count_match")).alias("file_count_mismatches"),
            F.coalesce(F.sum("source_total_size_bytes"), F.lit(0)).alias("source_bytes"),
            F.coalesce(F.sum("s3_total_size_bytes_after"), F.lit(0)).alias("dest_bytes"),
        )
    )
    return figures.withColumn("size_difference_pct", M.size_difference_pct("source_bytes", "dest_bytes"))


def _has_failed(status: Column) -> Column:
    return F.count_if(status.contains("FAILED")).alias("failed")


def _total(column: str, name: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).alias(name)


def report_summary(ledger: DataFrame, variant: str, keys: Sequence[str] = ("run_id",)) -> DataFrame:
    """Header figures of a run report (copy, convert, folder, metadata or policy)."""
    count = F.count(F.lit(1)).alias("total")
    status = F.col(STATUS_COLUMN[variant])
    if variant == "policy":
        return ledger.groupBy(*keys).agg(
            count,
            F.count_if(status.isin("CREATED", "UPDATED", "ALREADY_EXISTS")).alias("successful"),
            F.count_if(status == "FAILED").alias("failed"),
        )
    figures = {
        "copy": [
            _has_failed(status),
            _total("s3_total_size_bytes_after", "total_bytes"),
            _total("s3_file_count_after", "total_files"),
            _total("source_row_count", "total_rows"),
            F.count_if("distcp_is_incremental").alias("incremental"),
        ],
        "convert": [
            _has_failed(status),
            _total("source_hive_row_count", "total_rows"),
            F.count_if(~F.col("row_count_match")).alias("count_mismatches"),
        ],
        "folder": [
            F.count_if(status.isin(FAILURE_STATES["folder"])).alias("failed"),
            F.count_if("is_incremental").alias("incremental"),
            _total("dest_size_bytes", "total_bytes"),
            _total("dest_file_count", "total_files"),
            _total("bytes_copied", "bytes_copied"),
        ],
        "metadata": [
            _has_failed(status),
            F.count_if(status == "DATA_MISSING").alias("missing"),
            _total("source_row_count", "total_rows"),
            _total("data_presence_size_bytes", "total_bytes"),
        ],
    }
    successful = F.count_if(status.isin(SUCCESS_STATES[variant])).alias("successful")
    return ledger.groupBy(*keys).agg(count, successful, *figures[variant])


# Sort order of the detail lists.
DETAIL_ORDER = {
    "table": ["source_database", "source_table", "dest_database"],
    "folder": ["source_path"],
    "object": ["object_type", "object_name"],
    "skipped": ["row_index"],
}


def report_detail(ledger: DataFrame, variant: str = "table") -> DataFrame:
    """Ledger rows in report order."""
    return ledger.orderBy(*DETAIL_ORDER[variant])


def performance(ledger: DataFrame) -> DataFrame:
    """Per table: size in GiB, copy speed, total duration and rows per second."""
    total = M.total_duration(
        "discovery_duration_seconds", "distcp_duration_seconds", "table_create_duration_seconds", "validation_duration_seconds"
    )
    timed = ledger.withColumn("total_duration_seconds", total)
    return timed.select(
        "run_id",
        "source_database",
        "source_table",
        "dest_database",
        M.gib("s3_total_size_bytes_after").alias("data_gib"),
        M.speed_mib("s3_total_size_bytes_after", "distcp_duration_seconds").alias("copy_mib_per_second"),
        "total_duration_seconds",
        M.rows_per_second("source_row_count", "total_duration_seconds").alias("rows_per_second"),
    )


def data_check(ledger: DataFrame) -> DataFrame:
    """Per table: rows, partitions, files and bytes on both sides with the match flags."""
    return ledger.select(
        "run_id", "source_database", "source_table", "dest_database",
        "source_row_count", "dest_hive_row_count", "row_count_match",
        "source_partition_count", "dest_partition_count", "partition_count_match",
        "source_file_count", "s3_file_count_after", "file_count_match",
        "source_total_size_bytes", "s3_total_size_bytes_after", "file_size_match",
        M.size_difference_pct("source_total_size_bytes", "s3_total_size_bytes_after").alias("size_difference_pct"),
    )


def metadata_check(ledger: DataFrame) -> DataFrame:
    """Per table: partitioning and schema facts with their match flags."""
    return ledger.select(
        "run_id", "source_database", "source_table", "dest_database", "file_format",
        "source_partition_count", "dest_partition_count", "partition_count_match",
        "schema_match", "schema_differences",
    )
