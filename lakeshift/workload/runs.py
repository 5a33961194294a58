"""Queries that run whole jobs: tables written from the given ones, registered, listed on a control sheet, and moved."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lakeshift.plans import conversion, copy_run
from lakeshift.plans import metadata as metadata_plan
from lakeshift.schemas import LEDGERS, ledger_schema
from lakeshift.sources import catalog, inventory, storage
from lakeshift.sources import tables as source
from lakeshift.sources.scratch import scratch_dir
from lakeshift.sources.versioned import VersionedTable
from lakeshift.workload import base as B
from lakeshift.workload.registry import query

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def source_tables(spark, d, one_file=False):
    """(database, root): line items and orders by partition, a customer table per segment, and a table whose files are gone.

    With ``one_file`` each partition is a single file, so that file counts are known; else many tasks write a large one.
    """
    root, database = scratch_dir(spark, "source_tables"), f"src_{uuid.uuid4().hex[:10]}"
    catalog.ensure_databases(spark, [database])

    def put(name, df, fmt, by=()):
        df = source.without_ntz(df)
        if not by:
            df.coalesce(1).write.format(fmt).save(f"{root}/{name}")
        elif one_file:
            source.write_whole_partitions(df, f"{root}/{name}", by, fmt)
        else:
            df.hint("rebalance", *by).write.partitionBy(*by).format(fmt).save(f"{root}/{name}")
        ordered = [f for f in df.schema.fields if f.name not in by] + [f for f in df.schema.fields if f.name in by]
        schema = [{"name": f.name, "type": f.dataType.simpleString()} for f in ordered]
        catalog.create_external_table(spark, database, name, schema, list(by), fmt.upper(), f"{root}/{name}")
        catalog.repair_table(spark, database, name)

    put("lineitem", B.table(spark, d, "lineitem"), "parquet", ["l_returnflag", "l_linestatus"])
    put("orders", B.table(spark, d, "orders"), "orc", ["o_orderpriority"])
    customers = B.table(spark, d, "customer")
    for s in SEGMENTS:
        put(f"customer_{s.lower()}", customers.where(F.col("c_mktsegment") == s), "parquet")
    put("gone", B.table(spark, d, "nation"), "parquet")
    storage.delete(spark, f"{root}/gone")
    return database, root


SHEET = [("lineitem", "lake_a", "l_returnflag=A/*"), ("customer_*", "lake_b", None), ("orders, gone", "lake_b", "last_n_partitions=2"), ("orders", "lake_c", " ")]
LINES = "l_returnflag = 'A'"
LAST = "o_orderpriority IN ('5-LOW', '4-NOT SPECIFIED')"
STATUSES = "COMPLETED"

#: source_table, destination, rows in all, filter, rows, partitions in all and kept, of the tables of :func:`source_tables`
EXPECTED = f"""t AS (
    SELECT 'lineitem' AS source_table, 'lake_a' AS dest, count(*) AS full_rows, count(*) FILTER (WHERE {LINES}) AS n,
      count(DISTINCT l_returnflag || l_linestatus) AS full_parts, count(DISTINCT l_returnflag || l_linestatus) FILTER (WHERE {LINES}) AS parts, TRUE AS split FROM lineitem
    UNION ALL SELECT 'orders', 'lake_b', count(*), count(*) FILTER (WHERE {LAST}), count(DISTINCT o_orderpriority), count(DISTINCT o_orderpriority) FILTER (WHERE {LAST}), TRUE FROM orders
    UNION ALL SELECT 'orders', 'lake_c', count(*), count(*), count(DISTINCT o_orderpriority), count(DISTINCT o_orderpriority), TRUE FROM orders
    UNION ALL SELECT 'customer_' || lower(c_mktsegment), 'lake_b', count(*), count(*), 0, 0, FALSE FROM customer GROUP BY c_mktsegment)"""


def _sheet(spark, database, sheet):
    rows = [(i, database, t, dest, None, None, f) for i, (t, dest, f) in enumerate(sheet)]
    return spark.createDataFrame(rows, "row_index int, database string, table string, dest_database string, bucket string, endpoint string, partition_filter string")


@query(
    "inventory",
    f"""WITH {EXPECTED} SELECT source_table, upper(CASE WHEN source_table = 'orders' THEN 'orc' ELSE 'parquet' END) AS file_format,
    CASE source_table WHEN 'lineitem' THEN 'l_returnflag,l_linestatus' WHEN 'orders' THEN 'o_orderpriority' ELSE '' END AS partition_columns, split AS is_partitioned,
    CAST(full_parts AS INT) AS partition_count, full_rows AS row_count, greatest(full_parts, 1) AS file_count, TRUE AS has_bytes, parts < full_parts AS filter_active,
    CAST(parts AS INT) AS filtered_partition_count, n AS filtered_row_count, greatest(parts, 1) AS filtered_file_count, parts < full_parts AS fewer_bytes, NULL AS error
    FROM t WHERE dest <> 'lake_c' UNION ALL SELECT 'gone', 'PARQUET', '', FALSE, 0, 0, 0, FALSE, FALSE, 0, 0, 0, FALSE, 'location does not exist'""",
)
def inventory_records(spark, d):
    database, _ = source_tables(spark, d, one_file=True)
    refs = inventory.catalog_refs(spark, database)
    wanted = [(database, "lineitem", SHEET[0][2]), (database, "orders", SHEET[2][2]), (database, "customer_building", "x=1")]
    filters = spark.createDataFrame(wanted, "source_database string, source_table string, partition_filter string")
    out = inventory.inventory(spark, refs, filters)
    return out.select(
        "source_table", "file_format", "partition_columns", "is_partitioned", "partition_count", "row_count", "file_count", (F.col("size_bytes") > 0).alias("has_bytes"),
        "filter_active", "filtered_partition_count", "filtered_row_count", "filtered_file_count",
        (F.col("filtered_size_bytes") < F.col("size_bytes")).alias("fewer_bytes"), "error",
    )


def planned_copy(spark, d, sheet=SHEET):
    """A copy run over the source tables, not started."""
    database, root = source_tables(spark, d, one_file=True)
    refs = inventory.catalog_refs(spark, database)
    names = spark.createDataFrame([(r.database, r.name) for r in refs], "source_database string, table_name string")
    planned = copy_run.planned_tables(_sheet(spark, database, sheet), names, "s3a://lake")
    suffix = database.removeprefix("src")
    planned = planned.withColumn("dest_database", F.concat("dest_database", F.lit(suffix)))
    ledger = VersionedTable(spark, f"{root}/ledger", ledger_schema("migration_table_status"))
    return copy_run.CopyRun(spark, ledger, f"run{suffix}", refs, planned, lambda bucket, db, t: f"{root}/{bucket.rsplit('/', 1)[-1]}/{db}/{t}")


@query(
    "copy_run",
    f"""WITH {EXPECTED}, r AS (SELECT source_table, dest, 'COMPLETED' AS discovery_status, 'COMPLETED' AS distcp_status, 'COMPLETED' AS table_create_status,
    'COMPLETED' AS validation_status, full_rows AS full_table_row_count, n AS source_row_count, n AS dest_hive_row_count,
    CAST(parts AS INT) AS source_partition_count, CAST(parts AS INT) AS dest_partition_count, greatest(parts, 1) AS source_file_count, TRUE AS file_count_match,
    TRUE AS file_size_match, TRUE AS row_count_match, TRUE AS partition_count_match, TRUE AS schema_match, 'VALIDATED' AS overall_status, NULL AS error_message FROM t
    UNION ALL SELECT 'gone', 'lake_b', 'FAILED', NULL, NULL, NULL, 0, 0, NULL, 0, NULL, 0, NULL, NULL, NULL, NULL, NULL, 'FAILED', 'location does not exist')
    SELECT *, count(*) OVER () AS total, count(*) FILTER (WHERE overall_status = 'VALIDATED') OVER () AS successful,
    count(*) FILTER (WHERE overall_status = 'FAILED') OVER () AS failed, 'COMPLETED_WITH_FAILURES' AS run_status FROM r""",
)
def copy_run_ledger(spark, d):
    """From the control sheet to the closed run: every table's ledger row, with the totals of the run."""
    run = planned_copy(spark, d)
    return run_result(run.run(), run.finalize())


def run_result(ledger, totals):
    return ledger.join(totals, "run_id").select(
        "source_table", F.regexp_extract("dest_database", "^(lake_[a-z])", 1).alias("dest"), "discovery_status", "distcp_status", "table_create_status",
        "validation_status", "full_table_row_count", "source_row_count", "dest_hive_row_count", "source_partition_count", "dest_partition_count",
        "source_file_count", "file_count_match", "file_size_match", "row_count_match", "partition_count_match", "schema_match", "overall_status", "error_message",
        "total", "successful", "failed", "run_status",
    )


# what lies at the destination of a metadata run: nothing for one segment, too few rows for another
ABSENT, SHORT = "MACHINERY", "BUILDING"


def planned_metadata(spark, d):
    """A metadata run over the source tables, not started; files were put at the destination by other means."""
    database, root = source_tables(spark, d)
    refs = inventory.catalog_refs(spark, database)
    source.without_ntz(B.table(spark, d, "lineitem")).hint("rebalance", "l_returnflag", "l_linestatus").write.partitionBy("l_returnflag", "l_linestatus").parquet(f"{root}/there/lineitem")
    customers = B.table(spark, d, "customer")
    for s in SEGMENTS:
        if s != ABSENT:
            rows = customers.where((F.col("c_mktsegment") == s) & (F.lit(s != SHORT) | (F.col("c_custkey") % 3 > 0)))
            rows.write.parquet(f"{root}/there/customer_{s.lower()}")
    suffix = database.removeprefix("src")
    rows = [(0, database, "customer_*, gone", f"meta_a{suffix}", None, root, f"{root}/there", None), (1, database, "line[i-l]tem", f"meta_b{suffix}", None, root, f"{root}/there", None)]
    columns = "row_index int, database string, table string, dest_database string, dest_bucket string, source_s3_prefix string, dest_s3_prefix string, source_table_path string"
    tables = spark.createDataFrame([(r.database, r.name, r.location) for r in refs], "source_database string, table_name string, location string")
    planned = metadata_plan.planned_tables("hive", spark.createDataFrame(rows, columns), "s3a://lake", tables)
    # places on this machine: a prefix of a sheet is taken for one of a bucket
    place = F.concat(F.lit(f"{root}/there/"), "table_name")
    ledger = VersionedTable(spark, f"{root}/ledger", ledger_schema("s3_migration_table_status"))
    return metadata_plan.MetadataRun(spark, ledger, f"run{suffix}", refs, planned.withColumn("dest_path", place))


@query(
    "metadata_run",
    f"""WITH t AS (SELECT 'customer_' || lower(c_mktsegment) AS source_table, 'meta_a' AS dest, count(*) AS n, 0 AS parts,
      count(*) FILTER (WHERE c_mktsegment <> '{SHORT}' OR c_custkey % 3 > 0) AS there, c_mktsegment <> '{ABSENT}' AS present FROM customer GROUP BY c_mktsegment
    UNION ALL SELECT 'lineitem', 'meta_b', count(*), count(DISTINCT l_returnflag || l_linestatus), count(*), TRUE FROM lineitem),
    r AS (SELECT source_table, dest, 'COMPLETED' AS discovery_status, CASE WHEN present THEN 'CONFIRMED' ELSE 'MISSING' END AS data_presence_status,
      CASE WHEN present THEN 'COMPLETED' ELSE 'SKIPPED' END AS table_create_status, CASE WHEN present THEN 'COMPLETED' END AS validation_status, n AS source_row_count,
      CASE WHEN present THEN there END AS dest_hive_row_count, CAST(parts AS INT) AS source_partition_count, CASE WHEN present THEN CAST(parts AS INT) END AS dest_partition_count,
      CASE WHEN present THEN there = n END AS row_count_match, CASE WHEN present THEN TRUE END AS schema_match,
      CASE WHEN NOT present THEN 'DATA_MISSING' WHEN there = n THEN 'VALIDATED' ELSE 'VALIDATION_FAILED' END AS overall_status FROM t
    UNION ALL SELECT 'gone', 'meta_a', 'FAILED', NULL, NULL, NULL, 0, NULL, 0, NULL, NULL, NULL, 'FAILED')
    SELECT *, count(*) OVER () AS total, count(*) FILTER (WHERE overall_status = 'VALIDATED') OVER () AS successful,
    count(*) FILTER (WHERE overall_status LIKE '%FAIL%') OVER () AS failed, count(*) FILTER (WHERE overall_status = 'DATA_MISSING') OVER () AS missing,
    'COMPLETED_WITH_FAILURES' AS run_status FROM r""",
)
def metadata_run(spark, d):
    run = planned_metadata(spark, d)
    return run.run().join(run.finalize(), "run_id").select(
        "source_table", F.regexp_extract("dest_database", "^(meta_[a-z])", 1).alias("dest"), "discovery_status", "data_presence_status", "table_create_status",
        "validation_status", "source_row_count", "dest_hive_row_count", "source_partition_count", "dest_partition_count", "row_count_match", "schema_match",
        "overall_status", "total", "successful", "failed", "missing", "run_status",
    )


def planned_conversion(spark, d):
    """A conversion run over the source tables, not started: line items in place, the others into a database of their own."""
    database, root = source_tables(spark, d)
    refs = inventory.catalog_refs(spark, database)
    suffix = database.removeprefix("src")
    rows = [(0, database, "lineitem", "T", None), (1, database, "orders, customer_*, gone", "F", f"conv{suffix}")]
    sheet = spark.createDataFrame(rows, "row_index int, database string, table string, inplace_migration string, destination_iceberg_database string")
    names = spark.createDataFrame([(r.database, r.name) for r in refs], "source_database string, table_name string")
    ledger = VersionedTable(spark, f"{root}/ledger", ledger_schema("iceberg_migration_table_status"))
    return conversion.ConversionRun(spark, ledger, f"run{suffix}", refs, conversion.planned_conversions(sheet, names), "parquet")


@query(
    "convert_run",
    f"""WITH {EXPECTED}, r AS (SELECT source_table, CASE source_table WHEN 'lineitem' THEN 'INPLACE' ELSE 'SNAPSHOT' END AS migration_type, 'VALIDATED' AS status,
      full_rows AS source_hive_row_count, full_rows AS destination_iceberg_row_count, CAST(full_parts AS INT) AS source_hive_partition_count,
      CAST(full_parts AS INT) AS dest_iceberg_partition_count, TRUE AS row_count_match, TRUE AS partition_count_match, TRUE AS schema_match, 'COMPLETED' AS validation_status
      FROM t WHERE dest <> 'lake_c'
    UNION ALL SELECT 'gone', 'SNAPSHOT', 'FAILED', 0, NULL, 0, NULL, NULL, NULL, NULL, NULL)
    SELECT *, count(*) OVER () AS total, count(*) FILTER (WHERE status = 'VALIDATED') OVER () AS successful, count(*) FILTER (WHERE status = 'FAILED') OVER () AS failed,
    CAST(0 AS BIGINT) AS skipped, CAST(0 AS BIGINT) AS count_mismatches, 'COMPLETED_WITH_FAILURES' AS run_status FROM r""",
)
def convert_run(spark, d):
    run = planned_conversion(spark, d)
    return run.run().join(run.finalize(), "run_id").select(
        "source_table", "migration_type", "status", "source_hive_row_count", "destination_iceberg_row_count", "source_hive_partition_count",
        "dest_iceberg_partition_count", "row_count_match", "partition_count_match", "schema_match", "validation_status", "total", "successful", "failed",
        "skipped", "count_mismatches", "run_status",
    )


# ---------------------------------------------------------------- catalog


@query(
    "catalog_columns",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, 'EXTERNAL' AS table_type, '{c}' AS column_name, {i} AS ordinal, {str(p).upper()} AS is_partition"
        for t, cs in {"lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate", "+l_returnflag", "+l_linestatus"]}.items()
        for i, (c, p) in enumerate((c.lstrip("+"), c.startswith("+")) for c in cs)
    ),
)
def catalog_columns(spark, d):
    """Tables, their types and their columns, as the catalog has them."""
    database, _ = source_tables(spark, d)
    tables = catalog.list_tables(spark, database).where("table_name = 'lineitem'")
    columns = catalog.table_columns(spark, database, ["lineitem", "orders"])
    return tables.join(columns, ["database", "table_name"]).select("table_name", "table_type", "column_name", "ordinal", "is_partition")


@query(
    "catalog_partitions",
    """SELECT 'whole' AS table_name, 'l_returnflag=' || l_returnflag || '/l_linestatus=' || l_linestatus AS "partition", count(*) AS row_count, FALSE AS unregistered
    FROM lineitem GROUP BY ALL
    UNION ALL SELECT 'some', 'l_returnflag=A/l_linestatus=F', count(*), FALSE FROM lineitem WHERE l_returnflag = 'A' AND l_linestatus = 'F'
    UNION ALL SELECT 'bare', NULL, 0, TRUE""",
)
def catalog_partitions(spark, d):
    """One set of files declared three times: all partitions repaired, one added, none registered."""
    database, root = source_tables(spark, d)
    (ref,) = [r for r in inventory.catalog_refs(spark, database) if r.name == "lineitem"]
    schema = [{"name": n, "type": t} for n, t in ref.schema]
    for name in ("whole", "some", "bare"):
        catalog.create_external_table(spark, database, name, schema, ref.partition_by, ref.fmt, ref.location)
    catalog.repair_table(spark, database, "whole")
    catalog.add_partitions(spark, database, "some", ["l_returnflag=A/l_linestatus=F"], ref.location)
    out = None
    for name in ("whole", "some", "bare"):
        counts = spark.table(f"{database}.{name}").groupBy("l_returnflag", "l_linestatus").count()
        counts = counts.selectExpr("'l_returnflag=' || l_returnflag || '/l_linestatus=' || l_linestatus AS partition", "count AS row_count")
        found = catalog.list_partitions(spark, database, name).join(counts, "partition", "left")
        if catalog.unregistered_partitions(spark, database, name):
            found = spark.range(1).selectExpr("CAST(NULL AS STRING) AS partition", "0L AS row_count")
        missing = F.lit(catalog.unregistered_partitions(spark, database, name))
        part = found.select(F.lit(name).alias("table_name"), "partition", "row_count", missing.alias("unregistered"))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "register_and_ledger",
    """SELECT 'registered' AS action, count(*) AS row_count, 12 AS ledgers FROM orders UNION ALL SELECT 'refreshed', count(*), 12 FROM orders""",
)
def register_and_ledger(spark, d):
    """Files made known under a name, twice, and the ledger tables, created twice without harm."""
    database, root = source_tables(spark, d)
    (ref,) = [r for r in inventory.catalog_refs(spark, database) if r.name == "orders"]
    catalog.ensure_databases(spark, [f"{database}_reg", f"{database}_reg"])
    out = None
    for _ in range(2):
        action = catalog.register_table(spark, f"{database}_reg", "orders", ref.location, "orc")
        catalog.ensure_ledger(spark, f"{database}_ledger", {name: ledger_schema(name) for name in LEDGERS})
        ledgers = len(spark.catalog.listTables(f"{database}_ledger"))
        row = spark.table(f"{database}_reg.orders").agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(action).alias("action"), "row_count", F.lit(ledgers).alias("ledgers"))
        out = row if out is None else out.unionByName(row)
    return out
