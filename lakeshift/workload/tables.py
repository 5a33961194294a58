"""Queries for table reads, inventories, schemas, reconciliation and table metadata."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshift.operators import reconcile as ops
from lakeshift.operators import report, table_metadata
from lakeshift.plans import conversion, copy_run
from lakeshift.sources import footers, metadata
from lakeshift.sources import tables as source
from lakeshift.sources.scratch import scratch_dir
from lakeshift.workload import base as B
from lakeshift.workload.registry import query

TPCH = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@query(
    "table_scan",
    "SELECT o_orderstatus, o_orderpriority, count(*) AS row_count, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_totalprice > 100000 GROUP BY ALL",
)
def table_scan(spark, d):
    orders = source.read_table_files(spark, "PARQUET", f"{d}/orders.parquet")
    return (
        orders.where("o_totalprice > 100000")
        .groupBy("o_orderstatus", "o_orderpriority")
        .agg(F.count(F.lit(1)).alias("row_count"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    )


@query(
    "inventory_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TPCH),
)
def inventory_counts(spark, d):
    """Row counts from file footers: no row is read."""
    session = footers.footer_session(spark)
    counts = [footers.row_counts(session, f"{d}/{t}.parquet").select(F.lit(t).alias("table_name"), "row_count") for t in TPCH]
    return reduce(DataFrame.unionByName, counts)


# column lists: a table per brand, a column per part name and size; the destination lost, retyped and gained some
COLUMN_OF, TYPE_OF = "p_name || ' ' || p_size", "lower(p_type)"
SOURCE_COLUMNS = f"SELECT p_brand AS table_name, {COLUMN_OF} AS column_name, min({TYPE_OF}) AS data_type FROM part GROUP BY ALL"
DEST_TYPE = "CASE WHEN p_size > 40 THEN 'string' ELSE lower(p_type) END"


@query(
    "schema_diff",
    f"""WITH s AS ({SOURCE_COLUMNS}), t AS (SELECT p_brand AS table_name, {COLUMN_OF} AS column_name, min({DEST_TYPE}) AS data_type FROM part
    WHERE p_size > 5 GROUP BY ALL UNION ALL SELECT DISTINCT p_brand, 'extra ' || p_size, 'int' FROM part WHERE p_size < 3)
    SELECT coalesce(s.table_name, t.table_name) AS table_name, coalesce(s.column_name, t.column_name) AS column_name, s.data_type AS source_type, t.data_type AS dest_type,
    CASE WHEN t.data_type IS NULL THEN 'MISSING' WHEN s.data_type IS NULL THEN 'EXTRA' ELSE 'TYPE' END AS difference
    FROM s FULL OUTER JOIN t ON s.table_name = t.table_name AND s.column_name = t.column_name WHERE s.data_type IS DISTINCT FROM t.data_type""",
)
def schema_diff(spark, d):
    part = B.table(spark, d, "part")

    def columns(df, data_type: str, upper: bool = False):
        name = F.expr(f"upper({COLUMN_OF})" if upper else COLUMN_OF)
        return df.groupBy(F.col("p_brand").alias("table_name"), name.alias("column_name")).agg(F.expr(f"min({data_type})").alias("data_type"))

    extra = part.where("p_size < 3").selectExpr("p_brand AS table_name", "'EXTRA ' || p_size AS column_name", "'int' AS data_type").distinct()
    dest = columns(part.where("p_size > 5"), DEST_TYPE, upper=True).unionByName(extra)
    return ops.schema_diff(columns(part, TYPE_OF), dest, case_sensitive=False).drop("message")


SIDES = f"""s AS (SELECT o_orderstatus AS k, o_orderpriority AS p, count(*) AS n FROM orders GROUP BY ALL),
    t AS (SELECT o_orderstatus AS k, o_orderpriority AS p, count(*) AS n FROM ({B.DEST_ORDERS_SQL}) GROUP BY ALL)"""


@query(
    "reconcile_partitions",
    f"""WITH {SIDES} SELECT coalesce(s.k, t.k) AS table_name, coalesce(s.p, t.p) AS "partition", coalesce(s.n, 0) AS source_row_count,
    coalesce(t.n, 0) AS dest_row_count, s.n IS NOT NULL AS in_source, t.n IS NOT NULL AS in_dest,
    coalesce(s.n, 0) = coalesce(t.n, 0) AS row_count_match FROM s FULL OUTER JOIN t ON s.k = t.k AND s.p = t.p""",
)
def reconcile_partitions(spark, d):
    keyed = {"table_name": F.col("o_orderstatus")}
    src = ops.partition_metrics(B.table(spark, d, "orders").withColumns(keyed), F.col("o_orderpriority"), ["table_name"])
    dst = ops.partition_metrics(B.dest_orders(spark, d).withColumns(keyed), F.col("o_orderpriority"), ["table_name"])
    return ops.reconcile_partitions(src, dst, ["table_name", "partition"])


@query(
    "reconcile_tables",
    f"""WITH {SIDES}, ss AS (SELECT k, sum(n)::BIGINT AS n, count(*) AS c FROM s GROUP BY ALL), tt AS (SELECT k, sum(n)::BIGINT AS n, count(*) AS c FROM t GROUP BY ALL)
    SELECT k AS table_name, ss.n AS source_row_count, tt.n AS dest_row_count, ss.c AS source_partition_count, tt.c AS dest_partition_count,
    ss.n = tt.n AS row_count_match, ss.c = tt.c AS partition_count_match, k <> 'F' AS schema_match,
    CASE WHEN k = 'F' THEN 'Type mismatch for o_custkey: bigint vs string' ELSE '' END AS schema_differences,
    nullif(concat_ws('; ', CASE WHEN ss.n <> tt.n THEN 'Row count mismatch: source=' || ss.n || ', dest=' || tt.n END,
    CASE WHEN ss.c <> tt.c THEN 'Partition count mismatch: source=' || ss.c || ', dest=' || tt.c END,
    CASE WHEN k = 'F' THEN 'Schema differences: Type mismatch for o_custkey: bigint vs string' END), '') AS error
    FROM ss JOIN tt USING (k)""",
)
def reconcile_tables(spark, d):
    def totals(df):
        per_part = ops.partition_metrics(df.withColumn("table_name", F.col("o_orderstatus")), F.col("o_orderpriority"), ["table_name"])
        return per_part.groupBy("table_name").agg(F.sum("row_count").alias("row_count"), F.count(F.lit(1)).alias("partition_count"))

    orders = B.table(spark, d, "orders")
    retyped = T.StructType([T.StructField(f.name, T.StringType()) if f.name == "o_custkey" else f for f in orders.schema.fields])
    diff = ops.schema_diff(
        ops.schema_frame(spark, {"F": orders.schema}), ops.schema_frame(spark, {"F": retyped})
    )
    return ops.reconcile_tables(totals(orders), totals(B.dest_orders(spark, d)), ops.schema_verdict(diff))


@query(
    "flagship_reconcile",
    f"""WITH s AS (SELECT 'priority_' || o_orderpriority AS source_table, substr(CAST(o_orderdate AS STRING), 1, 7) AS p, count(*) AS n FROM orders GROUP BY ALL),
    t AS (SELECT 'priority_' || o_orderpriority AS source_table, substr(CAST(o_orderdate AS STRING), 1, 7) AS p, count(*) AS n FROM ({B.DEST_ORDERS_SQL}) GROUP BY ALL),
    j AS (SELECT coalesce(s.source_table, t.source_table) AS source_table, coalesce(s.n, 0) AS sn, coalesce(t.n, 0) AS tn,
    s.n IS NOT NULL AS sp, t.n IS NOT NULL AS tp FROM s FULL OUTER JOIN t ON s.source_table = t.source_table AND s.p = t.p),
    v AS (SELECT source_table, sum(sn)::BIGINT AS source_row_count, sum(tn)::BIGINT AS dest_row_count, count(*) FILTER (WHERE sp) AS source_partition_count,
    count(*) FILTER (WHERE tp) AS dest_partition_count, count(*) FILTER (WHERE sn <> tn) AS partitions_off,
    source_table <> 'priority_3-MEDIUM' AS schema_match,
    CASE WHEN source_table = 'priority_3-MEDIUM' THEN 'Type mismatch for o_custkey: bigint vs string; Missing column: o_totalprice' ELSE '' END AS schema_differences
    FROM j GROUP BY ALL)
    SELECT source_table, source_row_count, dest_row_count, source_partition_count, dest_partition_count, partitions_off,
    source_row_count = dest_row_count AS row_count_match, source_partition_count = dest_partition_count AS partition_count_match,
    schema_match, schema_differences, CASE WHEN source_row_count <> dest_row_count OR source_partition_count <> dest_partition_count THEN 'VALIDATED_WITH_WARNINGS'
    WHEN schema_match THEN 'VALIDATED' ELSE 'VALIDATION_FAILED' END AS overall_status
    FROM v""",
)
def flagship_reconcile(spark, d):
    def side(df):
        return df.select(
            F.concat(F.lit("priority_"), "o_orderpriority").alias("source_table"),
            F.substring(F.col("o_orderdate").cast("string"), 1, 7).alias("partition"),
        )

    orders = B.table(spark, d, "orders")
    other = T.StructType(
        [T.StructField(f.name, T.StringType()) if f.name == "o_custkey" else f for f in orders.schema.fields if f.name != "o_totalprice"]
    )
    names = {p: f"priority_{p}" for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")}
    dest = {name: other if p == "3-MEDIUM" else orders.schema for p, name in names.items()}
    diff = _schema_differences(spark, dict.fromkeys(names.values(), orders.schema), dest)
    return copy_run.reconcile_copies(side(orders), side(B.dest_orders(spark, d)), diff)


def _schema_differences(spark, source_schemas, dest_schemas):
    diff = ops.schema_diff(ops.schema_frame(spark, source_schemas), ops.schema_frame(spark, dest_schemas))
    return ops.schema_verdict(diff).withColumnRenamed("table_name", "source_table")


@query(
    "convert_snapshot",
    """SELECT o_orderstatus AS source_table, count(*) AS source_hive_row_count, count(*) AS destination_iceberg_row_count, TRUE AS row_count_match,
    count(DISTINCT o_orderpriority) AS source_hive_partition_count, count(DISTINCT o_orderpriority) AS dest_iceberg_partition_count,
    TRUE AS partition_count_match, o_orderstatus <> 'P' AS schema_match, CASE WHEN o_orderstatus = 'P' THEN 'Missing column: o_note' ELSE '' END AS schema_differences,
    CASE WHEN o_orderstatus = 'P' THEN 'VALIDATION_FAILED' ELSE 'VALIDATED' END AS status FROM orders GROUP BY ALL""",
)
def convert_snapshot(spark, d):
    """The conversion written out, read back and reconciled with its source per order status.

    The source of status P is declared with a column that the conversion does not have.
    """
    orders = B.table(spark, d, "orders")
    path = scratch_dir(spark, "convert_snapshot")
    conversion.write_snapshot(orders, path, ["o_orderpriority"], "orc")
    converted = spark.read.orc(path)
    declared = {s: source.without_ntz(orders).schema for s in ("F", "O", "P")}
    declared["P"] = T.StructType([*declared["F"].fields, T.StructField("o_note", T.StringType())])
    diff = _schema_differences(spark, declared, dict.fromkeys(declared, converted.schema))
    return conversion.reconcile_conversion(orders, converted, "o_orderpriority", F.col("o_orderstatus"), diff)


@query(
    "dominant_value",
    "SELECT event_type, count(*) AS value_count FROM events GROUP BY ALL ORDER BY value_count DESC, event_type LIMIT 1",
)
def dominant_value(spark, d):
    return report.dominant_value(B.table(spark, d, "events"), "event_type")


# one metadata document per customer, with the schema, spec and snapshots varied by its values
ODD = "c_custkey % 3"
DOCUMENT = (
    "'{\"current-schema-id\": ' || (c_custkey % 3) || ', \"schemas\": [' ||"
    "'{\"schema-id\": 0, \"fields\": [{\"id\": 1, \"name\": \"k\", \"required\": true, \"type\": \"long\"}]}, ' ||"
    "'{\"schema-id\": 1, \"fields\": [{\"id\": 1, \"name\": \"k\", \"required\": true, \"type\": \"long\"}, "
    "{\"id\": 2, \"name\": \"' || lower(c_mktsegment) || '\", \"required\": false, \"type\": \"decimal(10,2)\"}, "
    "{\"id\": 3, \"name\": \"s\", \"required\": false, \"type\": {\"type\": \"struct\", \"fields\": []}}, "
    "{\"id\": 4, \"name\": \"f\", \"required\": false, \"type\": \"fixed[16]\"}, "
    "{\"id\": 5, \"name\": \"z\", \"required\": false, \"type\": \"timestamptz\"}]}], ' ||"
    "'\"default-spec-id\": ' || (c_nationkey % 2) || ', \"partition-specs\": [{\"spec-id\": 0, \"fields\": []}, "
    "{\"spec-id\": 1, \"fields\": [{\"source-id\": 1, \"field-id\": 1000, \"name\": \"k\", \"transform\": \"identity\"}, "
    "{\"source-id\": 2, \"field-id\": 1001, \"name\": \"m\", \"transform\": \"identity\"}]}], ' ||"
    "CASE WHEN c_acctbal < 0 THEN '' ELSE '\"current-snapshot-id\": 7, ' END ||"
    "'\"snapshots\": [{\"snapshot-id\": 6, \"summary\": {\"total-records\": \"1\"}}, "
    "{\"snapshot-id\": 7, \"summary\": {\"total-records\": \"' || c_custkey || '\"}}]}'"
)


def _documents(spark, d):
    return B.table(spark, d, "customer").select(
        "c_custkey", F.expr(DOCUMENT.replace("\\", "\\\\")).alias("metadata")
    )


@query(
    "iceberg_schema",
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'k:BIGINT'
    ELSE 'k:BIGINT,' || lower(c_mktsegment) || ':DECIMAL(10,2),s:STRING,f:BINARY,z:TIMESTAMP' END AS columns FROM customer""",
)
def iceberg_schema(spark, d):
    facts = table_metadata.table_facts(_documents(spark, d))
    pairs = F.transform("schema_fields", lambda f: F.concat(f["name"], F.lit(":"), f["type"]))
    return facts.select("c_custkey", F.array_join(pairs, ",").alias("columns"))


@query(
    "iceberg_partition_cols",
    """SELECT c_custkey, CASE WHEN c_nationkey % 2 = 0 THEN '' WHEN c_custkey % 3 = 0 THEN 'k,field_2' ELSE 'k,' || lower(c_mktsegment) END AS partition_columns,
    c_nationkey % 2 = 1 AS is_partitioned FROM customer""",
)
def iceberg_partition_cols(spark, d):
    facts = table_metadata.table_facts(_documents(spark, d))
    return facts.select("c_custkey", F.array_join("partition_columns", ",").alias("partition_columns"), "is_partitioned")


@query(
    "iceberg_row_count",
    "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_custkey END AS row_count FROM customer",
)
def iceberg_row_count(spark, d):
    return table_metadata.table_facts(_documents(spark, d)).select("c_custkey", "row_count")


# table folders, one per supplier: 1 to 13 versions of a document; every tenth has a hint, and of 97 one each has no folder,
# no document, a broken one, or a hint for a version that is not there
SUPPLIED = "s_suppkey % 97"
VERSIONS = "CAST(1 + s_suppkey % 13 AS INT)"
HINTED = f"CASE WHEN {SUPPLIED} = 4 THEN '99' WHEN s_suppkey % 10 = 0 THEN '1' END"
ONE_DOCUMENT = (
    "'{\"current-schema-id\": 0, \"schemas\": [{\"schema-id\": 0, \"fields\": [{\"id\": 1, \"name\": \"k' || s_nationkey || '\", \"type\": \"long\"}, "
    "{\"id\": 2, \"name\": \"dt\", \"type\": \"date\"}]}], \"default-spec-id\": 0, \"partition-specs\": [{\"spec-id\": 0, \"fields\": "
    "[{\"source-id\": 2, \"field-id\": 1000, \"name\": \"dt\", \"transform\": \"identity\"}]}], \"current-snapshot-id\": 5, "
    "\"snapshots\": [{\"snapshot-id\": 5, \"summary\": {\"total-records\": \"' || (s_suppkey * 100 + v) || '\"}}]}'"
)


@query(
    "iceberg_meta_latest",
    f"""WITH t AS (SELECT s_suppkey, s_nationkey, CASE WHEN {HINTED} = '1' THEN 1 ELSE {VERSIONS} END AS v,
    CASE {SUPPLIED} WHEN 1 THEN 'no metadata folder' WHEN 2 THEN 'no metadata document'
    WHEN 3 THEN 'not a JSON document: v' || CASE WHEN {HINTED} = '1' THEN 1 ELSE {VERSIONS} END || '.metadata.json'
    WHEN 4 THEN 'hinted document does not exist: v99.metadata.json' END AS error FROM supplier)
    SELECT s_suppkey, CASE WHEN error IS NULL OR s_suppkey % 97 = 3 THEN 'v' || v || '.metadata.json' END AS metadata_file, error,
    CASE WHEN error IS NULL THEN 'k' || s_nationkey || ':BIGINT,dt:DATE' ELSE '' END AS columns, CASE WHEN error IS NULL THEN 'dt' ELSE '' END AS partition_columns,
    error IS NULL AS is_partitioned, CASE WHEN error IS NULL THEN s_suppkey * 100 + v ELSE 0 END AS row_count FROM t""",
)
def iceberg_meta_latest(spark, d):
    """Documents written to storage, and the current one of each table read back with its facts."""
    root = scratch_dir(spark, "iceberg_meta_latest")
    suppliers = B.table(spark, d, "supplier").withColumn("table_path", F.concat(F.lit(f"{root}/t"), F.col("s_suppkey").cast("string")))
    versions = suppliers.withColumn("v", F.explode(F.expr(f"sequence(1, {VERSIONS})")))
    files = versions.where(f"{SUPPLIED} <> 1").selectExpr(
        "table_path",
        f"CASE WHEN {SUPPLIED} = 2 THEN 'snap-' || v || '.avro' ELSE 'v' || v || '.metadata.json' END AS file_name",
        f"CASE WHEN {SUPPLIED} = 3 THEN '{{\"schemas\": [' ELSE {ONE_DOCUMENT} END AS content",
    )
    hints = suppliers.where(f"{SUPPLIED} NOT IN (1, 2)").selectExpr("table_path", "'version-hint.text' AS file_name", f"{HINTED} || chr(10) AS content")
    metadata.write_documents(files.unionByName(hints.where("content IS NOT NULL")))
    facts = metadata.read_table_facts(suppliers.select("s_suppkey", "table_path"))
    pairs = F.transform("schema_fields", lambda f: F.concat(f["name"], F.lit(":"), f["type"]))
    return facts.select(
        "s_suppkey", "metadata_file", "error", F.array_join(pairs, ",").alias("columns"), F.array_join("partition_columns", ",").alias("partition_columns"),
        "is_partitioned", "row_count",
    )


@query(
    "iceberg_meta_names",
    """WITH f AS (SELECT o_custkey AS table_path, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS v FROM orders)
    SELECT table_path, CASE WHEN table_path % 10 = 0 THEN 'v3.metadata.json' ELSE 'v' || max(v) || '.metadata.json' END AS file_name FROM f GROUP BY table_path""",
)
def iceberg_meta_names(spark, d):
    """Metadata files of a table per customer, one version per order; some tables carry a hint."""
    orders = B.table(spark, d, "orders").select(F.col("o_custkey").alias("table_path"), "o_orderkey")
    versions = orders.selectExpr(
        "table_path", "row_number() OVER (PARTITION BY table_path ORDER BY o_orderkey) AS v"
    )
    files = versions.selectExpr(
        "table_path", "explode(array('v' || v || '.metadata.json', 'snap-' || v || '.avro')) AS file_name"
    )
    hints = orders.where("table_path % 10 = 0").select("table_path", F.lit("3").alias("version")).distinct()
    return table_metadata.latest_metadata(files, hints)
