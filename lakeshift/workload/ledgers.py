"""Queries for ledger updates, gates, run roll-ups and report datasets."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeshift.operators import ledger as ops
from lakeshift.operators import reconcile, report
from lakeshift.workload import base as B
from lakeshift.workload.registry import query

L = B.LEDGER_SQL
KEYS = list(ops.KEYS)
KEY_LIST = ", ".join(KEYS)

# results of a stage, one per order: the dearest tables fail, the cheapest are skipped, some never ran
RESULT: B.Columns = [
    *[c for c in B.LEDGER if c[0] in KEYS],
    ("status", "CASE WHEN o_totalprice > 450000 THEN 'FAILED' WHEN o_totalprice < 20000 THEN 'SKIPPED' ELSE 'COMPLETED' END"),
    ("error", "CASE WHEN o_totalprice > 470000 THEN 'no space for t_' || o_orderkey END"),
    ("existed", "CASE WHEN o_orderstatus = 'F' THEN TRUE END"),
    ("is_incremental", "o_orderstatus = 'O'"),
    ("duration_seconds", "CAST(o_custkey % 40 AS DOUBLE)"),
    ("size_before", "CAST(5 AS BIGINT)"),
    ("files_before", "CAST(1 AS BIGINT)"),
    ("size_after", f"{B.SIZE} - CAST(floor(o_totalprice * (o_custkey % 21)) AS BIGINT)"),
    ("files_after", "CAST(1 + o_custkey % 30 AS BIGINT)"),
    ("bytes_transferred", f"{B.SIZE} - 3"),
    ("files_transferred", "CAST(o_custkey % 30 AS BIGINT)"),
    ("source_row_count", B.ROWS),
    ("dest_row_count", f"{B.ROWS} - CASE WHEN o_orderpriority = '1-URGENT' THEN 2 ELSE 0 END"),
    ("source_partition_count", "CAST(o_custkey % 12 AS INT)"),
    ("dest_partition_count", "CAST(o_custkey % 12 AS INT)"),
    ("row_count_match", "o_orderpriority <> '1-URGENT'"),
    ("partition_count_match", "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE TRUE END"),
    ("schema_match", "o_orderpriority <> '3-MEDIUM'"),
    ("schema_differences", "CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'Missing column: x' END"),
]
RAN = "NOT (o_orderstatus = 'F' AND o_orderpriority IN ('2-HIGH', '5-LOW'))"
R = B.select_sql(RESULT, f"orders WHERE {RAN}")


def results(spark, d):
    return B.derive(B.table(spark, d, "orders").where(RAN), RESULT)


def _join(changes: dict[str, str], where: str = "TRUE", ledger: str = L, result: str = R, keys: list[str] = KEYS, only=None) -> str:
    """SQL: ledger columns, with some replaced on rows that have a result ``r``."""
    shown = only or [c for c, _ in B.LEDGER]
    cols = ", ".join(
        f'CASE WHEN r.run_id IS NOT NULL THEN {changes[c]} ELSE l."{c}" END AS "{c}"' if c in changes else f'l."{c}"' for c in shown
    )
    on = " AND ".join(f"l.{k} = r.{k}" for k in keys)
    return f"SELECT {cols} FROM ({ledger}) l LEFT JOIN (SELECT * FROM ({result}) WHERE {where}) r ON {on}"


ERR = "coalesce(r.error, '')"
FAILED_ERR = f"CASE WHEN r.status = 'FAILED' THEN {ERR} ELSE l.error_message END"


@query(
    "advance_status_copy",
    _join(
        {
            "distcp_status": "r.status",
            "distcp_duration_seconds": "r.duration_seconds",
            "distcp_is_incremental": "r.is_incremental",
            "s3_total_size_bytes_before": "r.size_before",
            "s3_file_count_before": "r.files_before",
            "s3_total_size_bytes_after": "r.size_after",
            "s3_file_count_after": "r.files_after",
            "s3_bytes_transferred": "r.bytes_transferred",
            "s3_files_transferred": "r.files_transferred",
            "file_count_match": "l.source_file_count = CASE WHEN coalesce(l.partition_filter, '') <> '' THEN r.files_transferred ELSE r.files_after END",
            "file_size_match": "abs(l.source_total_size_bytes - CASE WHEN coalesce(l.partition_filter, '') <> '' THEN r.bytes_transferred "
            "ELSE r.size_after END) / greatest(l.source_total_size_bytes, 1) < 0.01",
            "overall_status": "CASE WHEN r.status = 'COMPLETED' THEN 'COPIED' ELSE 'FAILED' END",
            "error_message": FAILED_ERR,
        },
        "status <> 'SKIPPED'",
    ),
)
def advance_status_copy(spark, d):
    return ops.advance_copy(B.ledger(spark, d), results(spark, d))


@query(
    "copy_match_flags",
    f"""SELECT {KEY_LIST}, source_file_count = CASE WHEN coalesce(partition_filter, '') <> '' THEN s3_files_transferred ELSE s3_file_count_after END AS file_count_match,
    abs(source_total_size_bytes - CASE WHEN coalesce(partition_filter, '') <> '' THEN s3_bytes_transferred ELSE s3_total_size_bytes_after END)
    / greatest(source_total_size_bytes, 1) < 0.01 AS file_size_match FROM ({L})""",
)
def copy_match_flags(spark, d):
    state = B.ledger(spark, d)
    measured = state.select(
        *KEYS,
        F.lit("COMPLETED").alias("status"),
        F.lit("").alias("error"),
        F.col("s3_total_size_bytes_after").alias("size_after"),
        F.col("s3_file_count_after").alias("files_after"),
        F.col("s3_bytes_transferred").alias("bytes_transferred"),
        F.col("s3_files_transferred").alias("files_transferred"),
    )
    return ops.advance_copy(state, measured).select(*KEYS, "file_count_match", "file_size_match")


@query(
    "advance_status_create",
    _join(
        {
            "table_create_status": "r.status",
            "table_already_existed": "coalesce(r.existed, FALSE)",
            "overall_status": "CASE WHEN l.overall_status IS NULL OR l.overall_status = 'FAILED' THEN l.overall_status ELSE "
            "CASE r.status WHEN 'COMPLETED' THEN 'TABLE_CREATED' WHEN 'FAILED' THEN 'FAILED' ELSE 'SKIPPED' END END",
            "error_message": FAILED_ERR,
        }
    ),
)
def advance_status_create(spark, d):
    return ops.advance_create(B.ledger(spark, d), results(spark, d))


@query(
    "advance_status_create_metadata",
    _join(
        {
            "table_create_status": "r.status",
            "table_already_existed": "coalesce(r.existed, FALSE)",
            "overall_status": "CASE WHEN l.overall_status IN ('FAILED', 'DATA_MISSING') THEN l.overall_status ELSE "
            "CASE r.status WHEN 'COMPLETED' THEN 'TABLE_CREATED' WHEN 'SKIPPED' THEN 'DATA_MISSING' ELSE 'FAILED' END END",
            "error_message": FAILED_ERR,
        }
    ),
)
def advance_status_create_metadata(spark, d):
    return ops.advance_create(B.ledger(spark, d), results(spark, d), metadata=True)


PRESENCE: B.Columns = [
    *[c for c in B.LEDGER if c[0] in KEYS[:3]],
    ("status", "CASE WHEN o_totalprice > 300000 THEN 'CONFIRMED' WHEN o_totalprice > 200000 THEN 'MISSING' WHEN o_totalprice > 100000 THEN 'FAILED' ELSE 'ODD' END"),
    ("file_count", "CAST(o_custkey % 4 AS BIGINT)"),
    ("size_bytes", B.SIZE),
    ("error", "CASE WHEN o_totalprice > 250000 THEN NULL ELSE 'missing t_' || o_orderkey END"),
]
PR = B.select_sql(PRESENCE, f"orders WHERE {RAN}")


def presence_results(spark, d):
    return B.derive(B.table(spark, d, "orders").where(RAN), PRESENCE)


@query(
    "advance_status_presence",
    _join(
        {
            "data_presence_status": "r.status",
            "data_presence_file_count": "r.file_count",
            "data_presence_size_bytes": "r.size_bytes",
            "overall_status": "CASE r.status WHEN 'CONFIRMED' THEN 'DATA_CONFIRMED' WHEN 'MISSING' THEN 'DATA_MISSING' ELSE 'FAILED' END",
            "error_message": f"CASE WHEN r.status <> 'CONFIRMED' THEN {ERR} ELSE l.error_message END",
        },
        result=PR,
        keys=KEYS[:3],
    ),
)
def advance_status_presence(spark, d):
    return ops.advance_presence(B.ledger(spark, d), presence_results(spark, d))


V_ALL = "coalesce(r.row_count_match, FALSE) AND coalesce(r.partition_count_match, FALSE) AND coalesce(r.schema_match, FALSE)"
V_COPY = (
    f"CASE WHEN {V_ALL} THEN 'VALIDATED' WHEN NOT coalesce(r.row_count_match, TRUE) OR NOT coalesce(r.partition_count_match, TRUE) "
    "THEN 'VALIDATED_WITH_WARNINGS' ELSE 'VALIDATION_FAILED' END"
)
KEPT = "coalesce(l.overall_status = 'FAILED', FALSE)"


def _validate_changes(state: str, message: str) -> dict[str, str]:
    return {
        "validation_status": "r.status",
        "dest_hive_row_count": "r.dest_row_count",
        "source_partition_count": "r.source_partition_count",
        "dest_partition_count": "r.dest_partition_count",
        "row_count_match": "coalesce(r.row_count_match, FALSE)",
        "partition_count_match": "coalesce(r.partition_count_match, FALSE)",
        "schema_match": "coalesce(r.schema_match, FALSE)",
        "schema_differences": "coalesce(r.schema_differences, '')",
        "overall_status": f"CASE WHEN {KEPT} THEN l.overall_status ELSE {state} END",
        "error_message": f"CASE WHEN {KEPT} THEN l.error_message ELSE {message} END",
    }


VR = R.replace(
    "CASE WHEN o_totalprice > 470000 THEN 'no space for t_' || o_orderkey END",
    "CASE WHEN o_orderpriority = '1-URGENT' THEN 'Row count mismatch' END",
)


def validation_results(spark, d):
    return results(spark, d).withColumn("error", F.when(~F.col("row_count_match"), F.lit("Row count mismatch")))


@query(
    "advance_status_validate",
    _join(
        _validate_changes(V_COPY, f"CASE WHEN {V_ALL} THEN NULL ELSE coalesce(nullif(r.error, ''), l.error_message) END"),
        "status = 'COMPLETED'",
        result=VR,
    ),
)
def advance_status_validate(spark, d):
    return ops.advance_validate(B.ledger(spark, d), validation_results(spark, d))


@query(
    "advance_status_validate_metadata",
    _join(
        _validate_changes(
            f"CASE WHEN {V_ALL} THEN 'VALIDATED' ELSE 'VALIDATION_FAILED' END", f"CASE WHEN {V_ALL} THEN NULL ELSE coalesce(r.error, '') END"
        ),
        "status = 'COMPLETED'",
        result=VR,
    ),
)
def advance_status_validate_metadata(spark, d):
    return ops.advance_validate(B.ledger(spark, d), validation_results(spark, d), variant="metadata")


CONVERSION: B.Columns = [
    *[c for c in B.LEDGER if c[0] in KEYS[:3]],
    ("migration_type", "CASE WHEN o_orderstatus = 'F' THEN 'INPLACE' ELSE 'SNAPSHOT' END"),
    ("destination_database", "'lake_' || o_orderstatus"),
    ("migration_duration_seconds", "CAST(o_custkey % 5 AS DOUBLE)"),
    ("status", "CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 'FAILED' WHEN '5-LOW' THEN 'SKIPPED' WHEN '3-MEDIUM' THEN 'VALIDATION_FAILED' ELSE 'COMPLETED' END"),
    ("source_hive_row_count", B.ROWS),
    ("destination_iceberg_row_count", f"{B.ROWS} - CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1 ELSE 0 END"),
    ("row_count_match", "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority <> '3-MEDIUM' END"),
    ("source_hive_partition_count", "CAST(o_custkey % 12 AS INT)"),
    ("dest_iceberg_partition_count", "CAST(o_custkey % 12 AS INT)"),
    ("partition_count_match", "TRUE"),
    ("schema_match", "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE TRUE END"),
    ("schema_differences", "CAST(NULL AS STRING)"),
    ("validation_status", "CAST(NULL AS STRING)"),
    ("error_message", "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'conversion failed' END"),
]
CV = B.select_sql(CONVERSION, "orders")


def conversions(spark, d):
    return B.derive(B.table(spark, d, "orders"), CONVERSION)


V_CONVERT = "coalesce(r.row_count_match, FALSE) AND coalesce(r.partition_count_match, TRUE) AND coalesce(r.schema_match, FALSE)"


@query(
    "advance_status_validate_convert",
    _join(
        {
            "validation_status": "r.status",
            "source_hive_row_count": "r.source_row_count",
            "destination_iceberg_row_count": "r.dest_row_count",
            "source_hive_partition_count": "r.source_partition_count",
            "dest_iceberg_partition_count": "r.dest_partition_count",
            "row_count_match": "coalesce(r.row_count_match, FALSE)",
            "partition_count_match": "coalesce(r.partition_count_match, FALSE)",
            "schema_match": "coalesce(r.schema_match, FALSE)",
            "schema_differences": "coalesce(r.schema_differences, '')",
            "status": f"CASE WHEN l.status = 'FAILED' THEN l.status WHEN {V_CONVERT} THEN 'VALIDATED' ELSE 'VALIDATION_FAILED' END",
            "error_message": f"CASE WHEN l.status = 'FAILED' THEN l.error_message WHEN {V_CONVERT} THEN NULL "
            "ELSE coalesce(nullif(r.error, ''), l.error_message) END",
            "migration_duration_seconds": "l.migration_duration_seconds",
        },
        "status = 'COMPLETED'",
        ledger=f"SELECT * REPLACE (CASE WHEN migration_duration_seconds = 0 THEN 12.5 ELSE migration_duration_seconds END AS migration_duration_seconds) FROM ({CV})",
        result=VR,
        keys=KEYS[:3],
        only=[c for c, _ in CONVERSION],
    ),
)
def advance_status_validate_convert(spark, d):
    timed = ops.backfill_duration(conversions(spark, d), "migration_duration_seconds", F.lit(12.5))
    found = validation_results(spark, d).drop("dest_database")
    return ops.advance_validate(timed, found, ops.CONVERSION_KEYS, variant="convert")


FOLDER: B.Columns = [
    ("run_id", "'folder_run_' || (o_custkey % 50)"),
    ("source_path", "'/data/' || o_orderkey"),
    ("dest_bucket", "'s3a://lake-' || o_orderstatus"),
    ("dest_path", "'d' || o_custkey"),
    ("status", "CASE o_orderpriority WHEN '1-URGENT' THEN 'VALIDATED' WHEN '2-HIGH' THEN 'VALIDATION_FAILED' WHEN '3-MEDIUM' THEN 'COMPLETED' WHEN '4-NOT SPECIFIED' THEN 'FAILED' ELSE CASE o_orderstatus WHEN 'F' THEN 'VALIDATION_SKIPPED' ELSE 'VALIDATED' END END"),
    ("source_file_count", "CAST(1 + o_custkey % 30 AS BIGINT)"),
    ("source_size_bytes", B.SIZE),
    ("dest_file_count", "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(1 + o_custkey % 30 AS BIGINT) END"),
    ("dest_size_bytes", f"CASE WHEN o_orderstatus = 'P' THEN NULL ELSE {B.SIZE} END"),
    ("bytes_copied", f"{B.SIZE} - 7"),
    ("is_incremental", "CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice > 100000 END"),
    ("file_count_match", "CAST(NULL AS BOOLEAN)"),
    ("size_match", "CAST(NULL AS BOOLEAN)"),
    ("error_message", "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'copy failed' END"),
]
FO = B.select_sql(FOLDER, "orders")
FOLDER_KEYS = ["run_id", "source_path", "dest_bucket", "dest_path"]
FOLDER_RESULT: B.Columns = [
    *[c for c in FOLDER if c[0] in FOLDER_KEYS],
    ("validation_status", "CASE WHEN o_totalprice > 400000 THEN NULL WHEN o_totalprice > 300000 THEN 'VALIDATION_FAILED' ELSE 'VALIDATED' END"),
    ("dest_file_count", "CASE WHEN o_totalprice > 450000 THEN NULL ELSE CAST(9 AS BIGINT) END"),
    ("dest_size_bytes", B.SIZE),
    ("file_count_match", "o_totalprice < 300000"),
    ("size_match", "CASE WHEN o_totalprice < 350000 THEN TRUE END"),
    ("validation_error", "CASE WHEN o_totalprice > 460000 THEN 'destination gone' WHEN o_totalprice > 440000 THEN '' END"),
]


def folders(spark, d):
    return B.derive(B.table(spark, d, "orders"), FOLDER)


@query(
    "advance_status_folder",
    _join(
        {
            "status": "coalesce(r.validation_status, 'VALIDATION_FAILED')",
            "dest_file_count": "coalesce(r.dest_file_count, 0)",
            "dest_size_bytes": "coalesce(r.dest_size_bytes, 0)",
            "file_count_match": "coalesce(r.file_count_match, FALSE)",
            "size_match": "coalesce(r.size_match, FALSE)",
            "error_message": "CASE WHEN coalesce(r.validation_error, '') <> '' THEN r.validation_error ELSE l.error_message END",
        },
        ledger=FO,
        result=B.select_sql(FOLDER_RESULT, f"orders WHERE {RAN}"),
        keys=FOLDER_KEYS,
        only=[c for c, _ in FOLDER],
    ),
)
def advance_status_folder(spark, d):
    found = B.derive(B.table(spark, d, "orders").where(RAN), FOLDER_RESULT)
    return ops.advance_folder(folders(spark, d), found)


PATCH = ["table_create_status", "overall_status", "error_message"]
SHORT = [*KEYS, *PATCH]


@query(
    "patch_failures",
    _join(
        {
            "table_create_status": "CASE WHEN l.table_create_status IS NULL THEN 'FAILED' ELSE l.table_create_status END",
            "overall_status": "CASE WHEN l.table_create_status IS NULL THEN 'FAILED' ELSE l.overall_status END",
            "error_message": f"CASE WHEN l.table_create_status IS NULL THEN {ERR} ELSE l.error_message END",
        },
        "status = 'FAILED' AND coalesce(error, '') <> ''",
        only=SHORT,
    ),
)
def patch_failures(spark, d):
    return ops.patch_failures(B.ledger(spark, d), results(spark, d), "table_create_status").select(*SHORT)


DUE = "r.run_id IS NULL AND l.distcp_status IS NULL AND l.discovery_status = 'COMPLETED'"
MARK = "copy did not process this table"


@query(
    "mark_unprocessed",
    f"""SELECT {", ".join("l." + k for k in KEYS)}, CASE WHEN {DUE} THEN 'FAILED' ELSE l.distcp_status END AS distcp_status,
    CASE WHEN {DUE} THEN 'FAILED' ELSE l.overall_status END AS overall_status,
    CASE WHEN {DUE} THEN coalesce(l.error_message, '{MARK}') ELSE l.error_message END AS error_message
    FROM ({L}) l LEFT JOIN (SELECT DISTINCT {KEY_LIST} FROM ({R}) WHERE status <> 'COMPLETED') r ON {" AND ".join(f"l.{k} = r.{k}" for k in KEYS)}""",
)
def mark_unprocessed(spark, d):
    done = results(spark, d).where("status <> 'COMPLETED'")
    marked = ops.mark_unprocessed(
        B.ledger(spark, d), done, "distcp_status", MARK, eligible=F.col("discovery_status") == "COMPLETED"
    )
    return marked.select(*KEYS, "distcp_status", "overall_status", "error_message")


@query(
    "close_running",
    f"""SELECT run_id, source_path, CASE WHEN status = 'COMPLETED' THEN 'FAILED' ELSE status END AS status,
    CASE WHEN status = 'COMPLETED' THEN 'final status not recorded' ELSE 'copy failed' END AS error_message FROM ({FO})""",
)
def close_running(spark, d):
    # folders still COMPLETED stand for rows left running
    running = folders(spark, d).withColumn(
        "status", F.when(F.col("status") == "COMPLETED", "RUNNING").otherwise(F.col("status"))
    )
    closed = ops.close_running(running.withColumn("error_message", F.when(F.col("status") != "RUNNING", "copy failed")), "final status not recorded")
    return closed.select("run_id", "source_path", "status", "error_message")


# second load of customers: some balances changed, new customers came
CHANGED = "c_acctbal > 5000"
NEWCOMER = "c_mktsegment = 'MACHINERY'"
CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
INCOMING = f"""SELECT c_custkey, c_name || '*' AS c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, c_mktsegment FROM customer WHERE {CHANGED}
    UNION ALL SELECT -c_custkey - 1, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE {NEWCOMER}"""


def _incoming(spark, d):
    customer = B.table(spark, d, "customer")
    changed = customer.where(CHANGED).withColumns({"c_name": F.concat("c_name", F.lit("*")), "c_acctbal": F.col("c_acctbal") + 1})
    return changed.unionByName(customer.where(NEWCOMER).withColumn("c_custkey", -F.col("c_custkey") - 1))


@query(
    "merge_upsert",
    f"""SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey, CASE WHEN t.c_custkey IS NULL THEN s.c_name ELSE t.c_name END AS c_name,
    coalesce(t.c_nationkey, s.c_nationkey) AS c_nationkey, coalesce(s.c_acctbal, t.c_acctbal) AS c_acctbal,
    coalesce(s.c_mktsegment, t.c_mktsegment) AS c_mktsegment FROM customer t FULL OUTER JOIN ({INCOMING}) s ON t.c_custkey = s.c_custkey""",
)
def merge_upsert(spark, d):
    return ops.merge_upsert(
        B.table(spark, d, "customer"), _incoming(spark, d), ["c_custkey"], update_cols=["c_acctbal", "c_mktsegment"]
    )


@query(
    "replace_keys",
    f"""SELECT {", ".join(CUSTOMER)} FROM customer WHERE c_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9900)
    UNION ALL SELECT c_custkey, c_name || '*', c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_acctbal > 9900""",
)
def replace_keys(spark, d):
    customer = B.table(spark, d, "customer")
    fresh = customer.where("c_acctbal > 9900").withColumn("c_name", F.concat("c_name", F.lit("*")))
    return ops.replace_keys(customer, fresh, ["c_nationkey"])


# rediscovery: tables seen before get new figures, tables of late orders are new
LATE = "o_orderdate >= CAST('2001-01-01' AS TIMESTAMP)"
SEEN = ["run_id", "source_database", "source_table", "dest_database", "source_row_count", "discovery_status", "overall_status"]


@query(
    "record_discovery",
    f"""WITH d AS (SELECT *, o_orderdate FROM ({L.replace(" FROM orders", ", o_orderdate FROM orders")}))
    SELECT run_id, source_database, source_table, dest_database, source_row_count + 5 AS source_row_count, 'COMPLETED' AS discovery_status,
    CASE WHEN {LATE} THEN 'DISCOVERED' ELSE overall_status END AS overall_status FROM d""",
)
def record_discovery(spark, d):
    orders = B.table(spark, d, "orders")
    known = B.derive(orders.where(f"NOT ({LATE})"), B.LEDGER).select(*SEEN)
    found = B.ledger(spark, d).select(
        *KEYS,
        (F.col("source_row_count") + 5).alias("source_row_count"),
        F.lit("COMPLETED").alias("discovery_status"),
        F.lit("DISCOVERED").alias("overall_status"),
    )
    return ops.merge_upsert(known, found, KEYS, update_cols=["source_row_count", "discovery_status"])


# gates
COPIES = f"""SELECT source_table, dest_database, status, o_orderkey AS n FROM ({R.replace(" FROM orders", ", o_orderkey FROM orders")})"""


def _gate_tables(spark, d):
    state = B.ledger(spark, d).select(*KEYS)
    # half of the tables ask for another destination than the one they were copied to
    moved = F.when(F.col("source_database") == "db_3", F.lit("elsewhere")).otherwise(F.col("dest_database"))
    return state.withColumn("dest_database", moved)


GATE_TABLES = f"SELECT run_id, source_database, source_table, CASE WHEN source_database = 'db_3' THEN 'elsewhere' ELSE dest_database END AS dest_database FROM ({L})"


@query(
    "copy_gate",
    f"""WITH c AS ({COPIES}), e AS (SELECT source_table, dest_database, arg_min(status, n) AS s FROM c GROUP BY ALL),
    a AS (SELECT source_table, arg_min(status, n) AS s FROM c GROUP BY ALL)
    SELECT t.*, coalesce(e.s, a.s, 'UNKNOWN') AS distcp_status,
    CASE WHEN coalesce(e.s, a.s, 'UNKNOWN') = 'COMPLETED' THEN 'READY' ELSE 'SKIPPED' END AS gate,
    CASE WHEN coalesce(e.s, a.s, 'UNKNOWN') <> 'COMPLETED' THEN 'copy status was ' || coalesce(e.s, a.s, 'UNKNOWN') END AS gate_error
    FROM ({GATE_TABLES}) t LEFT JOIN e ON t.source_table = e.source_table AND t.dest_database = e.dest_database
    LEFT JOIN a ON t.source_table = a.source_table""",
)
def copy_gate(spark, d):
    copies = B.derive(B.table(spark, d, "orders").where(RAN), [*RESULT, ("n", "o_orderkey")])
    return ops.copy_gate(_gate_tables(spark, d), copies, "n")


@query(
    "presence_gate",
    f"""SELECT l.run_id, l.source_database, l.source_table, l.dest_database, coalesce(p.status, 'UNKNOWN') AS data_presence_status,
    CASE WHEN coalesce(p.status, 'UNKNOWN') = 'CONFIRMED' THEN 'READY' ELSE 'SKIPPED' END AS gate,
    CASE WHEN coalesce(p.status, 'UNKNOWN') <> 'CONFIRMED' THEN 'data not present at destination (status=' || coalesce(p.status, 'UNKNOWN') || ')' END AS gate_error
    FROM ({L}) l LEFT JOIN ({PR}) p ON l.run_id = p.run_id AND l.source_database = p.source_database AND l.source_table = p.source_table""",
)
def presence_gate(spark, d):
    return ops.presence_gate(B.ledger(spark, d).select(*KEYS), presence_results(spark, d), KEYS[:3])


BLOCK_COPY = "distcp_status = 'FAILED' OR table_create_status IN ('FAILED', 'SKIPPED') OR overall_status = 'FAILED'"
BLOCK_META = "table_create_status IN ('FAILED', 'SKIPPED') OR coalesce(data_presence_status, '') <> 'CONFIRMED'"


@query(
    "validation_gate",
    f"""SELECT 'copy' AS flow, {KEY_LIST}, CASE WHEN coalesce({BLOCK_COPY}, FALSE) THEN 'SKIPPED' ELSE 'READY' END AS gate,
    CASE WHEN coalesce({BLOCK_COPY}, FALSE) THEN 'upstream failure: ' || coalesce(error_message, '') END AS gate_error FROM ({L})
    UNION ALL SELECT 'metadata', {KEY_LIST}, CASE WHEN coalesce({BLOCK_META}, FALSE) THEN 'SKIPPED' ELSE 'READY' END,
    CASE WHEN coalesce({BLOCK_META}, FALSE) THEN 'upstream status: ' || coalesce(overall_status, '') END FROM ({L})""",
)
def validation_gate(spark, d):
    state = B.ledger(spark, d)
    tables = state.select(*KEYS)
    copy = ops.validation_gate(tables, state).withColumn("flow", F.lit("copy"))
    return copy.unionByName(ops.validation_gate(tables, state, metadata=True).withColumn("flow", F.lit("metadata")))


FLAGS = "coalesce(row_count_match, FALSE) AND coalesce(schema_match, FALSE)"


@query(
    "validation_status",
    f"""SELECT {KEY_LIST}, CASE WHEN {FLAGS} AND coalesce(partition_count_match, FALSE) THEN 'VALIDATED'
    WHEN NOT coalesce(row_count_match, TRUE) OR NOT coalesce(partition_count_match, TRUE) THEN 'VALIDATED_WITH_WARNINGS' ELSE 'VALIDATION_FAILED' END AS copy_state,
    CASE WHEN {FLAGS} AND coalesce(partition_count_match, TRUE) THEN 'VALIDATED' ELSE 'VALIDATION_FAILED' END AS convert_state,
    CASE WHEN {FLAGS} AND coalesce(partition_count_match, FALSE) THEN 'VALIDATED' ELSE 'VALIDATION_FAILED' END AS metadata_state FROM ({L})""",
)
def validation_status(spark, d):
    return B.ledger(spark, d).select(
        *KEYS, *[reconcile.validation_status(v).alias(f"{v}_state") for v in ("copy", "convert", "metadata")]
    )


# run roll-ups; runs of customers without orders have no ledger rows
RUNS = "SELECT DISTINCT 'run_' || (c_custkey % 60) AS run_id FROM customer"


def runs(spark, d):
    return B.table(spark, d, "customer").selectExpr("'run_' || (c_custkey % 60) AS run_id").distinct()


def _count(where: str) -> str:
    return f"count(*) FILTER (WHERE {where})"


@query(
    "finalize_copy",
    f"""WITH t AS (SELECT run_id, count(*) AS total, {_count("overall_status IN ('VALIDATED', 'VALIDATED_WITH_WARNINGS', 'TABLE_CREATED')")} AS successful,
    {_count("overall_status IN ('FAILED', 'VALIDATION_FAILED')")} AS failed FROM ({L}) GROUP BY ALL)
    SELECT run_id, coalesce(total, 0) AS total, coalesce(successful, 0) AS successful, coalesce(failed, 0) AS failed,
    CASE WHEN total IS NULL THEN 'FAILED' WHEN failed = 0 THEN 'COMPLETED' ELSE 'COMPLETED_WITH_FAILURES' END AS run_status
    FROM ({RUNS}) LEFT JOIN t USING (run_id)""",
)
def finalize_copy(spark, d):
    return ops.finalize_run(B.ledger(spark, d), "copy", runs(spark, d))


@query(
    "finalize_convert",
    f"""WITH t AS (SELECT run_id, count(*) AS total, {_count("status IN ('VALIDATED', 'COMPLETED')")} AS successful, {_count("status = 'FAILED'")} AS failed,
    {_count("status = 'SKIPPED'")} AS skipped, {_count("row_count_match = FALSE")} AS count_mismatches FROM ({CV}) GROUP BY ALL)
    SELECT *, CASE WHEN failed = 0 THEN 'COMPLETED' ELSE 'COMPLETED_WITH_FAILURES' END AS run_status FROM t""",
)
def finalize_convert(spark, d):
    return ops.finalize_run(conversions(spark, d), "convert")


@query(
    "finalize_folder",
    f"""WITH t AS (SELECT run_id, count(*) AS total, {_count("status = 'VALIDATED'")} AS successful,
    {_count("status IN ('FAILED', 'VALIDATION_FAILED', 'VALIDATION_SKIPPED')")} AS failed FROM ({FO}) GROUP BY ALL)
    SELECT *, CASE WHEN failed = 0 THEN 'COMPLETED' ELSE 'COMPLETED_WITH_ERRORS' END AS run_status FROM t""",
)
def finalize_folder(spark, d):
    return ops.finalize_run(folders(spark, d), "folder")


@query(
    "finalize_metadata",
    f"""WITH t AS (SELECT run_id, count(*) AS total, {_count("overall_status = 'VALIDATED'")} AS successful, {_count("overall_status LIKE '%FAIL%'")} AS failed,
    {_count("overall_status = 'DATA_MISSING'")} AS missing FROM ({L}) GROUP BY ALL)
    SELECT run_id, coalesce(total, 0) AS total, coalesce(successful, 0) AS successful, coalesce(failed, 0) AS failed, coalesce(missing, 0) AS missing,
    CASE WHEN total IS NULL THEN 'FAILED' WHEN failed > 0 THEN 'COMPLETED_WITH_FAILURES' WHEN missing > 0 THEN 'COMPLETED_WITH_MISSING' ELSE 'COMPLETED' END AS run_status
    FROM ({RUNS}) LEFT JOIN t USING (run_id)""",
)
def finalize_metadata(spark, d):
    return ops.finalize_run(B.ledger(spark, d), "metadata", runs(spark, d))


@query(
    "validation_summary",
    f"""SELECT run_id, count(*) AS tables_validated, {_count("row_count_match AND partition_count_match AND schema_match")} AS tables_passed,
    {_count("NOT row_count_match OR NOT partition_count_match OR NOT schema_match")} AS tables_failed, {_count("NOT row_count_match")} AS row_count_mismatches,
    {_count("NOT partition_count_match")} AS partition_count_mismatches, {_count("NOT schema_match")} AS schema_mismatches
    FROM ({L}) WHERE validation_status = 'COMPLETED' GROUP BY ALL""",
)
def validation_summary(spark, d):
    return report.validation_summary(B.ledger(spark, d))


@query(
    "file_metric_summary",
    f"""WITH t AS (SELECT run_id, {_count("file_size_match")} AS size_matches, {_count("NOT file_size_match")} AS size_mismatches, {_count("file_count_match")} AS file_count_matches,
    {_count("NOT file_count_match")} AS file_count_mismatches, coalesce(sum(source_total_size_bytes), 0)::BIGINT AS source_bytes,
    coalesce(sum(s3_total_size_bytes_after), 0)::BIGINT AS dest_bytes FROM ({L}) WHERE distcp_status = 'COMPLETED' GROUP BY ALL)
    SELECT *, CASE WHEN source_bytes > 0 THEN round(abs(source_bytes - dest_bytes) / source_bytes * 100, 8) ELSE 0.0 END AS size_difference_pct FROM t""",
)
def file_metric_summary(spark, d):
    return report.file_metric_summary(B.ledger(spark, d)).withColumn("size_difference_pct", F.round("size_difference_pct", 8))


HAS_FAILED = _count("contains({0}, 'FAILED')")


@query(
    "report_summary_copy",
    f"""SELECT run_id, count(*) AS total, {_count("overall_status IN ('VALIDATED', 'VALIDATED_WITH_WARNINGS', 'TABLE_CREATED')")} AS successful,
    {HAS_FAILED.format("overall_status")} AS failed, coalesce(sum(s3_total_size_bytes_after), 0)::BIGINT AS total_bytes,
    coalesce(sum(s3_file_count_after), 0)::BIGINT AS total_files, coalesce(sum(source_row_count), 0)::BIGINT AS total_rows,
    {_count("distcp_is_incremental")} AS incremental FROM ({L}) GROUP BY ALL""",
)
def report_summary_copy(spark, d):
    return report.report_summary(B.ledger(spark, d), "copy")


@query(
    "report_summary_convert",
    f"""SELECT run_id, count(*) AS total, {_count("status IN ('VALIDATED', 'COMPLETED')")} AS successful, {HAS_FAILED.format("status")} AS failed,
    coalesce(sum(source_hive_row_count), 0)::BIGINT AS total_rows, {_count("NOT row_count_match")} AS count_mismatches FROM ({CV}) GROUP BY ALL""",
)
def report_summary_convert(spark, d):
    return report.report_summary(conversions(spark, d), "convert")


@query(
    "report_summary_folder",
    f"""SELECT run_id, count(*) AS total, {_count("status = 'VALIDATED'")} AS successful, {_count("status IN ('FAILED', 'VALIDATION_FAILED', 'VALIDATION_SKIPPED')")} AS failed,
    {_count("is_incremental")} AS incremental, coalesce(sum(dest_size_bytes), 0)::BIGINT AS total_bytes, coalesce(sum(dest_file_count), 0)::BIGINT AS total_files,
    coalesce(sum(bytes_copied), 0)::BIGINT AS bytes_copied FROM ({FO}) GROUP BY ALL""",
)
def report_summary_folder(spark, d):
    return report.report_summary(folders(spark, d), "folder")


@query(
    "report_summary_metadata",
    f"""SELECT run_id, count(*) AS total, {_count("overall_status = 'VALIDATED'")} AS successful, {HAS_FAILED.format("overall_status")} AS failed,
    {_count("overall_status = 'DATA_MISSING'")} AS missing, coalesce(sum(source_row_count), 0)::BIGINT AS total_rows,
    coalesce(sum(data_presence_size_bytes), 0)::BIGINT AS total_bytes FROM ({L}) GROUP BY ALL""",
)
def report_summary_metadata(spark, d):
    return report.report_summary(B.ledger(spark, d), "metadata")


@query("report_detail", f"SELECT {KEY_LIST}, overall_status, error_message FROM ({L}) ORDER BY source_database, source_table, dest_database")
def report_detail(spark, d):
    return report.report_detail(B.ledger(spark, d).select(*KEYS, "overall_status", "error_message"))


@query(
    "report_performance",
    f"""WITH t AS (SELECT *, coalesce(discovery_duration_seconds, 0) + coalesce(distcp_duration_seconds, 0) + coalesce(table_create_duration_seconds, 0)
    + coalesce(validation_duration_seconds, 0) AS d FROM ({L}))
    SELECT {KEY_LIST}, round(coalesce(s3_total_size_bytes_after, 0) / 1073741824, 9) AS data_gib,
    round(coalesce(s3_total_size_bytes_after, 0) / 1048576 / coalesce(nullif(distcp_duration_seconds, 0), 1), 6) AS copy_mib_per_second,
    d AS total_duration_seconds, round(source_row_count / coalesce(nullif(d, 0), 1), 6) AS rows_per_second FROM t""",
)
def report_performance(spark, d):
    speeds = report.performance(B.ledger(spark, d))
    return speeds.withColumns(
        {
            "data_gib": F.round("data_gib", 9),
            "copy_mib_per_second": F.round("copy_mib_per_second", 6),
            "rows_per_second": F.round("rows_per_second", 6),
        }
    )


@query(
    "report_data_check",
    f"""SELECT {KEY_LIST}, source_row_count, dest_hive_row_count, row_count_match, source_partition_count, dest_partition_count, partition_count_match,
    source_file_count, s3_file_count_after, file_count_match, source_total_size_bytes, s3_total_size_bytes_after, file_size_match,
    CASE WHEN source_total_size_bytes > 0 THEN round(abs(source_total_size_bytes - coalesce(s3_total_size_bytes_after, 0)) / source_total_size_bytes * 100, 8)
    ELSE 0.0 END AS size_difference_pct FROM ({L})""",
)
def report_data_check(spark, d):
    return report.data_check(B.ledger(spark, d)).withColumn("size_difference_pct", F.round("size_difference_pct", 8))


@query(
    "report_metadata_check",
    f"""SELECT {KEY_LIST}, file_format, source_partition_count, dest_partition_count, partition_count_match, schema_match, schema_differences FROM ({L})""",
)
def report_metadata_check(spark, d):
    return report.metadata_check(B.ledger(spark, d))


@query(
    "run_id_format",
    """SELECT c_custkey, 'iceberg_run_' || strftime(TIMESTAMP '2024-02-29 23:59:07' + to_seconds(c_custkey), '%Y%m%d_%H%M%S') || '_' || substr(md5(c_name), 1, 8) AS run_id,
    'sheet_' || c_custkey AS excel_file_path, 'RUNNING' AS status, 0 AS total_tables, 0 AS successful_tables, 0 AS failed_tables FROM customer""",
)
def run_id_format(spark, d):
    """Run records as a run starts them, one per customer, each with a time and a token of its own."""
    from lakeshift.plans import runs as run_plans

    customers = B.table(spark, d, "customer").select(
        "c_custkey", "c_name", F.concat(F.lit("sheet_"), F.col("c_custkey").cast("string")).alias("excel_file_path")
    )
    at = F.expr("TIMESTAMP '2024-02-29 23:59:07' + make_interval(0, 0, 0, 0, 0, 0, c_custkey)")
    return run_plans.run_records(customers, "iceberg_", at, F.md5("c_name"), keep=["c_custkey"]).drop("started_at")
