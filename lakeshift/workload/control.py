"""Queries for control sheets and token resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeshift.operators import control as ops
from lakeshift.operators import windows
from lakeshift.plans import metadata
from lakeshift.workload import base as B
from lakeshift.workload.cells import cell, nullish, s3a
from lakeshift.workload.registry import query

KEYS = ["source_database", "dest_database", "dest_bucket", "dest_endpoint", "partition_filter"]
BUCKET = "s3a://default"
PARSED = f"""SELECT row_index, trim(database) AS source_database, {cell('"table"', "'*'")} AS table_cell,
    {cell("dest_database", "trim(database)")} AS dest_database, {s3a(cell("bucket", f"'{BUCKET}'"))} AS dest_bucket,
    {cell("endpoint", "''")} AS dest_endpoint, {cell("partition_filter")} AS partition_filter
    FROM ({B.CONTROL_SQL}) WHERE NOT {nullish("database")}"""
KEY_LIST = ", ".join(KEYS)
TOKENS = f"""SELECT {KEY_LIST}, token, min(row_index * 1000 + i) AS pos FROM (SELECT {KEY_LIST}, row_index,
    unnest(list_transform(string_split(table_cell, ','), lambda x: trim(x))) AS token,
    generate_subscripts(string_split(table_cell, ','), 1) AS i FROM ({PARSED})) WHERE token <> '' GROUP BY ALL"""


def _parsed(spark, d):
    return ops.parse_copy_control(B.control(spark, d), BUCKET)


@query("parse_copy_control", PARSED)
def parse_copy_control(spark, d):
    return _parsed(spark, d)


@query(
    "parse_folder_control",
    f"""SELECT row_index, trim(source_path) AS source_path, rtrim({s3a("trim(bucket)")}, '/') AS dest_bucket,
    {cell("dest_database", "string_split(rtrim(trim(source_path), '/'), '/')[-1]")} AS dest_folder, {cell("endpoint", "''")} AS dest_endpoint
    FROM ({B.CONTROL_SQL}) WHERE NOT {nullish("source_path")} AND NOT {nullish("bucket")}""",
)
def parse_folder_control(spark, d):
    sheet = B.control(spark, d).withColumnsRenamed({"bucket": "target_bucket", "dest_database": "dest_folder"})
    return ops.parse_folder_control(sheet)


@query(
    "group_control",
    f"""WITH t AS ({TOKENS}), s AS (SELECT *, max(token = '*') OVER (PARTITION BY {KEY_LIST}) AS star FROM t)
    SELECT {KEY_LIST}, array_to_string(list(token ORDER BY pos), '|') AS tokens, count(*) AS token_count
    FROM s WHERE NOT star OR token = '*' GROUP BY {KEY_LIST}""",
)
def group_control(spark, d):
    grouped = ops.group_control(_parsed(spark, d), KEYS)
    return grouped.select(
        *KEYS,
        F.array_join("table_tokens", "|").alias("tokens"),
        F.size("table_tokens").cast("bigint").alias("token_count"),
    )


ENTRY_KEYS = ["source_database", "dest_database", "source_s3_prefix", "dest_s3_prefix"]


@query(
    "group_control_entries",
    f"""SELECT row_index, trim(database) AS source_database, {cell("dest_database", "trim(database)")} AS dest_database,
    {s3a(cell("source_s3_prefix", "''"))} AS source_s3_prefix, {s3a(cell("dest_s3_prefix", "''"))} AS dest_s3_prefix,
    trim("table") AS table_name, rtrim({s3a(cell("source_table_path", "''"))}, '/') AS source_table_path
    FROM ({B.CONTROL_SQL}) WHERE NOT {nullish("database")} AND NOT {nullish('"table"')} AND trim("table") <> '*'
    AND NOT {nullish("source_table_path")}""",
)
def group_control_entries(spark, d):
    sheet = B.control(spark, d).withColumn("dest_bucket", F.col("bucket"))
    return ops.control_entries(ops.parse_metadata_control(sheet, BUCKET), ENTRY_KEYS)


@query(
    "distinct_endpoints",
    f"""SELECT DISTINCT dest_bucket AS bucket, dest_endpoint AS endpoint,
    lower(regexp_extract(regexp_replace(dest_bucket, '^s3a://', ''), '^([^/?#]*)', 1)) AS bucket_name,
    replace(replace(upper(CASE WHEN regexp_extract(dest_endpoint, '^[a-z]+://([^/?#:]*)', 1) <> ''
    THEN regexp_extract(dest_endpoint, '^[a-z]+://([^/?#:]*)', 1) ELSE dest_endpoint END), '.', '_'), '-', '_') AS endpoint_slug FROM ({PARSED})""",
)
def distinct_endpoints(spark, d):
    return ops.distinct_endpoints(_parsed(spark, d))


@query(
    "distinct_first",
    """SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1""",
)
def distinct_first(spark, d):
    events = B.table(spark, d, "events").select("user_id", "event_type", "event_id", "value")
    return windows.distinct_first(events, ["user_id", "event_type"], "event_id")


@query(
    "last_per_group",
    """SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1""",
)
def last_per_group(spark, d):
    events = B.table(spark, d, "events").select("user_id", "event_type", "event_id", "value")
    return windows.last_per_group(events, ["user_id", "event_type"], "event_id")


# catalog: a database per part brand, a table per part type and name; tokens come from the suppliers
TABLE_NAME = "lower(p_type) || '_' || replace(p_name, ' ', '_')"
TOKEN = (
    "CASE s_suppkey % 7 WHEN 0 THEN 'promo*' WHEN 1 THEN '*_bolt' WHEN 2 THEN 'Small_*_ring|large_blue*' WHEN 3 THEN 'economy_red_widget' "
    "WHEN 4 THEN 'not_there' WHEN 5 THEN 'medium_*' ELSE CASE WHEN s_nationkey = 3 THEN '*' ELSE 'standard_*' END END"
)
CATALOG_SQL = f"SELECT DISTINCT p_brand AS source_database, {TABLE_NAME} AS table_name FROM part"
TOKEN_SQL = f"SELECT 'Brand#' || (1 + s_nationkey) AS source_database, {TOKEN} AS token, min(s_suppkey) AS position FROM supplier GROUP BY ALL"


def _catalog(spark, d):
    return B.table(spark, d, "part").selectExpr("p_brand AS source_database", f"{TABLE_NAME} AS table_name").distinct()


def _tokens(spark, d, token):
    return (
        B.table(spark, d, "supplier")
        .selectExpr("'Brand#' || (1 + s_nationkey) AS source_database", f"{token} AS token", "s_suppkey")
        .groupBy("source_database", "token")
        .agg(F.min("s_suppkey").alias("position"))
    )


@query(
    "resolve_tokens",
    f"""WITH t AS ({TOKEN_SQL}), c AS ({CATALOG_SQL})
    SELECT source_database, table_name, min(position) AS position FROM (
    SELECT source_database, token AS table_name, position FROM t WHERE NOT contains(token, '*')
    UNION ALL SELECT c.source_database, c.table_name, t.position FROM c JOIN t ON c.source_database = t.source_database
    WHERE contains(token, '*') AND regexp_matches(c.table_name, '(?i)^(' || replace(token, '*', '.*') || ')$')) GROUP BY ALL""",
)
def resolve_tokens(spark, d):
    return ops.resolve_tokens(_tokens(spark, d, TOKEN), _catalog(spark, d))


GLOB = (
    "CASE s_suppkey % 6 WHEN 0 THEN 'promo_????_*' WHEN 1 THEN '*_[bg]*' WHEN 2 THEN 'small_[!b]*' WHEN 3 THEN 'economy_red_widget' "
    "WHEN 4 THEN CASE s_suppkey % 4 WHEN 0 THEN 'not_there' ELSE '[z-a]*' END "
    "ELSE CASE WHEN s_nationkey = 3 THEN '*' WHEN s_suppkey % 4 = 1 THEN '[!]*' ELSE 'standard_*' END END"
)


@query(
    "resolve_tokens_strict",
    f"""WITH t AS ({TOKEN_SQL.replace(TOKEN, GLOB)}), c AS ({CATALOG_SQL})
    SELECT c.source_database, c.table_name, min(t.position) AS position FROM c JOIN t ON c.source_database = t.source_database
    AND c.table_name GLOB t.token GROUP BY ALL""",
)
def resolve_tokens_strict(spark, d):
    return ops.resolve_tokens(_tokens(spark, d, GLOB), _catalog(spark, d), strict=True)


@query(
    "unresolved_tokens",
    f"""WITH t AS ({TOKEN_SQL.replace(TOKEN, GLOB)}), c AS ({CATALOG_SQL})
    SELECT source_database, token, position, CASE WHEN token = 'not_there' OR token = 'economy_red_widget' THEN 'no such table' ELSE 'pattern matches no table' END AS reason
    FROM t WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.source_database = t.source_database AND c.table_name GLOB t.token)""",
)
def unresolved_tokens(spark, d):
    return ops.unresolved_tokens(_tokens(spark, d, GLOB), _catalog(spark, d))


@query(
    "control_segments",
    f"""WITH t AS ({TOKENS}), s AS (SELECT *, max(token = '*') OVER (PARTITION BY {KEY_LIST}) AS star FROM t),
    r AS (SELECT *, (row_number() OVER (PARTITION BY {KEY_LIST} ORDER BY pos) - 1) // 1000 AS segment FROM s WHERE NOT star OR token = '*')
    SELECT {KEY_LIST}, segment, array_to_string(list(token ORDER BY pos), '|') AS tokens FROM r GROUP BY {KEY_LIST}, segment""",
)
def control_segments(spark, d):
    found = ops.control_segments(_parsed(spark, d), KEYS)
    return found.withColumn("tokens", F.array_join("values", "|")).drop("values")


GROUP_LIST = "dest_database, dest_bucket, source_s3_prefix, dest_s3_prefix"
META = f"""SELECT row_index, trim(database) AS source_database, {cell('"table"', "'*'")} AS table_cell, {cell("dest_database", "trim(database)")} AS dest_database,
    {s3a(cell("bucket", f"'{BUCKET}'"))} AS dest_bucket, {s3a(cell("source_s3_prefix", "''"))} AS source_s3_prefix,
    {s3a(cell("dest_s3_prefix", "''"))} AS dest_s3_prefix, rtrim({s3a(cell("source_table_path", "''"))}, '/') AS location
    FROM ({B.CONTROL_SQL}) WHERE NOT {nullish("database")}"""
KNOWN = "SELECT DISTINCT 'db' || user_id AS source_database, event_type || '_t' AS table_name, 's3a://src-' || (user_id % 5) || '/wh/' || event_type AS location FROM events"


@query(
    "metadata_strategy",
    f"""WITH m AS ({META}), k AS ({KNOWN}), tok AS (SELECT DISTINCT source_database, {GROUP_LIST},
    unnest(list_transform(string_split(table_cell, ','), lambda x: trim(x))) AS token FROM m),
    hive AS (SELECT DISTINCT k.source_database, k.table_name, {GROUP_LIST}, k.location, 'hive' AS strategy FROM k JOIN tok
    ON k.source_database = tok.source_database AND (tok.token = '*' OR tok.token = k.table_name)
    WHERE tok.token = '*' OR NOT EXISTS (SELECT 1 FROM tok s WHERE s.token = '*' AND s.source_database = tok.source_database AND s.dest_database = tok.dest_database
      AND s.dest_bucket = tok.dest_bucket AND s.source_s3_prefix = tok.source_s3_prefix AND s.dest_s3_prefix = tok.dest_s3_prefix)),
    both_kinds AS (SELECT * FROM hive UNION ALL SELECT source_database, table_cell, {GROUP_LIST}, location, 'iceberg' FROM m WHERE table_cell <> '*' AND location <> '')
    SELECT source_database, table_name, dest_database, location, strategy,
    CASE WHEN source_s3_prefix <> '' AND dest_s3_prefix <> '' AND starts_with(location, source_s3_prefix)
    THEN rtrim(dest_s3_prefix, '/') || '/' || ltrim(substr(location, length(source_s3_prefix) + 1), '/')
    ELSE rtrim(dest_bucket, '/') || '/' || dest_database || '/' || table_name END AS dest_path FROM both_kinds""",
)
def metadata_strategy(spark, d):
    sheet = B.control(spark, d).withColumn("dest_bucket", F.col("bucket"))
    known = B.table(spark, d, "events").selectExpr(
        "'db' || user_id AS source_database", "event_type || '_t' AS table_name", "'s3a://src-' || (user_id % 5) || '/wh/' || event_type AS location"
    )
    hive = metadata.planned_tables("hive", sheet, BUCKET, known.distinct())
    return hive.unionByName(metadata.planned_tables("iceberg", sheet, BUCKET))
