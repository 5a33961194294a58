"""Run records: opening a run and closing it."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.schemas import ledger_schema

# Settings a run record may keep; anything else (keys, passwords, endpoints with credentials) stays out.
PUBLIC_SETTINGS = (
    "tracking_database", "tracking_location", "report_output_location", "default_s3_bucket", "distcp_mappers", "distcp_bandwidth",
)


def run_id(prefix: str = "", at: Column | None = None, token: Column | None = None) -> Column:
    """``<prefix>run_yyyymmdd_hhmmss_<8 hex>``; the token defaults to a random one."""
    at = F.current_timestamp() if at is None else at
    token = F.expr("replace(uuid(), '-', '')") if token is None else token
    return F.concat(F.lit(f"{prefix}run_"), F.date_format(at, "yyyyMMdd_HHmmss"), F.lit("_"), F.substring(token, 1, 8))


def run_records(requests: DataFrame, prefix: str = "", at: Column | None = None, token: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Opened runs, one per request row; time and token are those of the moment unless given."""
    return requests.select(
        *keep,
        run_id(prefix, at, token).alias("run_id"),
        "excel_file_path",
        (F.current_timestamp() if at is None else at).alias("started_at"),
        F.lit("RUNNING").alias("status"),
        *[F.lit(0).alias(c) for c in ("total_tables", "successful_tables", "failed_tables")],
    )


def start_run(
    spark: SparkSession, table: str, ledger: str, sheet_path: str, prefix: str = "", settings: Mapping[str, object] | None = None
) -> str:
    """Append a RUNNING record to a run ledger and return its id."""
    schema = ledger_schema(ledger)
    public = {k: v for k, v in (settings or {}).items() if k in PUBLIC_SETTINGS}
    values = {
        "excel_file_path": F.lit(sheet_path),
        "started_at": F.current_timestamp(),
        "status": F.lit("RUNNING"),
        "config_json": F.lit(json.dumps(public, sort_keys=True)),
    }
    new_id = spark.range(1).select(run_id(prefix)).first()[0]
    values["run_id"] = F.lit(new_id)

    def value(f) -> Column:
        default = F.lit(0) if f.dataType.typeName() == "integer" else F.lit(None)
        return values.get(f.name, default).cast(f.dataType).alias(f.name)

    spark.range(1).select(*[value(f) for f in schema.fields]).write.mode("append").insertInto(table)
    return new_id
