"""Queries for cell, path, name, access and measure expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeshift.functions import access as A
from lakeshift.functions import cells as C
from lakeshift.functions import measures as M
from lakeshift.operators import control as control_ops
from lakeshift.operators import rewrite
from lakeshift.sources import catalog
from lakeshift.workload import base as B
from lakeshift.workload.registry import query

NULLISH = "({0} IS NULL OR lower(trim({0})) IN ('', 'nan', 'null', 'none'))"


def nullish(c: str) -> str:
    return NULLISH.format(c)


def cell(c: str, default: str = "NULL") -> str:
    return f"CASE WHEN {nullish(c)} THEN {default} ELSE trim({c}) END"


def s3a(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NULL OR {c} = '' OR starts_with({c}, 's3a://') THEN {c} "
        f"ELSE 's3a://' || regexp_replace({c}, '^s3n?://', '') END"
    )


def csv_list(c: str) -> str:
    return (
        f"CASE WHEN {nullish(c)} THEN CAST([] AS VARCHAR[]) ELSE list_filter(list_transform(string_split({c}, ','), "
        "lambda x: trim(x)), lambda x: x <> '') END"
    )


def permission_list(c: str) -> str:
    return (
        f"CASE WHEN len({csv_list(c)}) = 0 THEN ['read'] ELSE list_transform({csv_list(c)}, lambda x: lower(x)) END"
    )


def words(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def access_list(perms: str) -> str:
    return (
        f"list_distinct(flatten(list_transform({perms}, lambda p: CASE p WHEN 'read' THEN {words(A.READ_ACCESS)} "
        f"WHEN 'write' THEN {words(A.WRITE_ACCESS)} WHEN 'all' THEN {words(A.ALL_ACCESS)} ELSE [p] END)))"
    )


def url_access_list(perms: str) -> str:
    return (
        f"list_distinct(flatten(list_transform({perms}, lambda p: CASE WHEN p IN ('read', 'select') THEN ['read'] "
        "WHEN p IN ('write', 'insert', 'update', 'delete', 'all') THEN ['read', 'write'] ELSE [p] END)))"
    )


def joined(c: str) -> str:
    return f"array_to_string(list_sort({c}), ',')"


MESSY_HEADER = {
    "row_index": " Row Index",
    "database": "DATABASE ",
    "table": " Table",
    "dest_database": "Dest Database",
    "partition_filter": " partition FILTER ",
}


@query(
    "sheet_header_normalize",
    f'SELECT row_index, database, "table", dest_database, partition_filter FROM ({B.CONTROL_SQL})',
)
def sheet_header_normalize(spark, d):
    return control_ops.normalize_header(B.control(spark, d).select(*MESSY_HEADER).toDF(*MESSY_HEADER.values()))


@query(
    "normalize_s3",
    f"SELECT row_index, {s3a('bucket')} AS bucket, {s3a('source_table_path')} AS path FROM ({B.CONTROL_SQL})",
)
def normalize_s3(spark, d):
    return B.control(spark, d).select(
        "row_index", C.normalize_s3("bucket").alias("bucket"), C.normalize_s3("source_table_path").alias("path")
    )


@query(
    "null_like_default",
    f"SELECT row_index, {cell('database', chr(39) + 'missing' + chr(39))} AS database, "
    f'{cell(chr(34) + "table" + chr(34), "database")} AS table_or_database, {nullish("dest_database")} AS dest_is_null '
    f"FROM ({B.CONTROL_SQL})",
)
def null_like_default(spark, d):
    return B.control(spark, d).select(
        "row_index",
        C.cell_str("database", "missing").alias("database"),
        C.cell_str("table", F.col("database")).alias("table_or_database"),
        C.null_like("dest_database").alias("dest_is_null"),
    )


@query(
    "parse_flag",
    "SELECT row_index, coalesce(upper(trim(inplace_migration)) IN ('T', 'TRUE', 'YES', '1'), FALSE) AS flag, "
    "CASE WHEN lower(trim(inplace_migration)) IN ('true', '1', 'yes', 'y', 'on') THEN TRUE "
    "WHEN lower(trim(inplace_migration)) IN ('false', '0', 'no', 'n', 'off') THEN FALSE ELSE FALSE END AS setting "
    f"FROM ({B.CONTROL_SQL})",
)
def parse_flag(spark, d):
    return B.control(spark, d).select(
        "row_index",
        C.parse_flag("inplace_migration").alias("flag"),
        C.parse_setting("inplace_migration", default=False).alias("setting"),
    )


@query(
    "dest_db_default",
    f"SELECT row_index, trim(database) AS source_database, CASE WHEN NOT {nullish('dest_database')} THEN trim(dest_database) "
    "WHEN upper(trim(inplace_migration)) IN ('T', 'TRUE', 'YES', '1') THEN trim(database) "
    f"ELSE trim(database) || '_iceberg' END AS dest_database FROM ({B.CONTROL_SQL}) WHERE NOT {nullish('database')}",
)
def dest_db_default(spark, d):
    parsed = control_ops.parse_conversion_control(
        B.control(spark, d).withColumnRenamed("dest_database", "destination_iceberg_database")
    )
    return parsed.select("row_index", "source_database", "dest_database")


@query(
    "dest_path",
    f"""WITH c AS (SELECT row_index, trim(database) AS db, {s3a("source_table_path")} AS src, {s3a("source_s3_prefix")} AS sp,
    {s3a("dest_s3_prefix")} AS dp, {s3a("bucket")} AS bucket FROM ({B.CONTROL_SQL}) WHERE NOT {nullish("database")}
    AND source_table_path IS NOT NULL AND bucket IS NOT NULL)
    SELECT row_index, CASE WHEN coalesce(sp, '') <> '' AND coalesce(dp, '') <> '' AND starts_with(src, sp)
    THEN rtrim(dp, '/') || '/' || ltrim(substr(src, length(sp) + 1), '/')
    ELSE rtrim(bucket, '/') || '/' || db || '/t' END AS dest_path FROM c""",
)
def dest_path(spark, d):
    rows = B.control(spark, d).where(
        ~C.null_like("database") & F.col("source_table_path").isNotNull() & F.col("bucket").isNotNull()
    )
    return rows.select(
        "row_index",
        C.dest_path(
            C.normalize_s3("source_table_path"),
            C.strip("database"),
            F.lit("t"),
            C.normalize_s3("bucket"),
            C.normalize_s3("source_s3_prefix"),
            C.normalize_s3("dest_s3_prefix"),
        ).alias("dest_path"),
    )


@query("path_basename", "SELECT page_id, string_split(rtrim(trim(url), '/'), '/')[-1] AS name FROM pages")
def path_basename(spark, d):
    return B.table(spark, d, "pages").select("page_id", C.basename("url").alias("name"))


HOST = "lower(regexp_extract({0}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1))"


@query(
    "endpoint_slug",
    f"""SELECT page_id, {HOST.format('url')} AS host, replace(replace(upper({HOST.format('url')}), '.', '_'), '-', '_') AS slug,
    lower(regexp_extract(regexp_replace(url, '^https?://', ''), '^([^/?#]*)', 1)) AS bucket_name FROM pages""",
)
def endpoint_slug(spark, d):
    as_bucket = F.regexp_replace("url", "^https?://", "s3a://")
    return B.table(spark, d, "pages").select(
        "page_id",
        C.endpoint_host("url").alias("host"),
        C.endpoint_slug("url").alias("slug"),
        C.bucket_name(as_bucket).alias("bucket_name"),
    )


@query(
    "slugify",
    "SELECT p_partkey, regexp_replace(p_name || ' / ' || p_brand, '[^a-zA-Z0-9_-]', '_', 'g') AS slug FROM part",
)
def slugify(spark, d):
    return B.table(spark, d, "part").select(
        "p_partkey", C.slugify(F.concat("p_name", F.lit(" / "), "p_brand")).alias("slug")
    )


INPUT_CLASS = (
    "CASE p_type WHEN 'ECONOMY' THEN 'hive.ql.io.parquet.MapredParquetInputFormat' WHEN 'MEDIUM' THEN 'hive.ql.io.orc.OrcInputFormat' "
    "WHEN 'SMALL' THEN 'hive.ql.io.avro.AvroContainerInputFormat' WHEN 'STANDARD' THEN 'mapred.TextInputFormat' "
    "WHEN 'LARGE' THEN 'mapred.' || p_name END"
)


@query(
    "detect_format",
    f"""SELECT p_partkey, CASE WHEN contains(c, 'parquet') THEN 'PARQUET' WHEN contains(c, 'orc') THEN 'ORC'
    WHEN contains(c, 'avro') THEN 'AVRO' WHEN contains(c, 'text') THEN 'TEXTFILE' ELSE 'PARQUET' END AS file_format
    FROM (SELECT p_partkey, lower({INPUT_CLASS}) AS c FROM part)""",
)
def detect_format(spark, d):
    return B.table(spark, d, "part").select("p_partkey", C.detect_format(F.expr(INPUT_CLASS)).alias("file_format"))


@query(
    "rowfilter_valid",
    "SELECT doc_id, NOT (contains(text, ';') OR contains(text, chr(10)) OR contains(text, chr(13))) AS valid FROM documents",
)
def rowfilter_valid(spark, d):
    return B.table(spark, d, "documents").select("doc_id", A.rowfilter_valid("text").alias("valid"))


@query(
    "csv_array",
    f"""SELECT row_index, array_to_string({csv_list('"users"')}, '|') AS users_list, len({csv_list('"groups"')}) AS group_count
    FROM ({B.SHEET_SQL})""",
)
def csv_array(spark, d):
    return B.sheet(spark, d).select(
        "row_index",
        F.array_join(C.csv_array("users"), "|").alias("users_list"),
        F.size(C.csv_array("groups")).cast("bigint").alias("group_count"),
    )


@query(
    "permission_array",
    f"SELECT row_index, array_to_string({permission_list('permissions')}, '|') AS permission_list FROM ({B.SHEET_SQL})",
)
def permission_array(spark, d):
    return B.sheet(spark, d).select(
        "row_index", F.array_join(A.permission_array("permissions"), "|").alias("permission_list")
    )


@query(
    "expand_permissions",
    f"SELECT row_index, {joined(access_list(permission_list('permissions')))} AS accesses FROM ({B.SHEET_SQL})",
)
def expand_permissions(spark, d):
    accesses = A.expand_permissions(A.permission_array("permissions"))
    return B.sheet(spark, d).select("row_index", F.array_join(F.sort_array(accesses), ",").alias("accesses"))


@query(
    "expand_url_permissions",
    f"SELECT row_index, {joined(url_access_list(permission_list('permissions')))} AS accesses FROM ({B.SHEET_SQL})",
)
def expand_url_permissions(spark, d):
    accesses = A.expand_url_permissions(A.permission_array("permissions"))
    return B.sheet(spark, d).select("row_index", F.array_join(F.sort_array(accesses), ",").alias("accesses"))


SUPPORTED = ["select", "insert", "delete", "use", "show", "create", "drop"]


@query(
    "access_type_filter",
    f"""WITH a AS (SELECT row_index, {access_list(permission_list('permissions'))} AS l FROM ({B.SHEET_SQL}))
    SELECT row_index, {joined(f"list_filter(l, lambda x: list_contains({words(SUPPORTED)}, x))")} AS kept,
    {joined(f"list_filter(l, lambda x: NOT list_contains({words(SUPPORTED)}, x))")} AS dropped FROM a""",
)
def access_type_filter(spark, d):
    accesses = A.expand_permissions(A.permission_array("permissions"))
    return B.sheet(spark, d).select(
        "row_index",
        F.array_join(F.sort_array(A.supported_access(accesses, SUPPORTED)), ",").alias("kept"),
        F.array_join(F.sort_array(A.dropped_access(accesses, SUPPORTED)), ",").alias("dropped"),
    )


NAMED = f"""SELECT row_index, coalesce(trim(database), 'dbx') AS db, coalesce(trim(tables), '*') AS t,
    coalesce(trim(columns), '*') AS c FROM ({B.SHEET_SQL})"""


@query(
    "policy_name",
    f"""SELECT row_index, CASE WHEN db = '*' THEN 'iceberg' WHEN t <> '*' AND c <> '*' THEN 'iceberg.' || db || '.' || t || '.' || c
    WHEN t <> '*' THEN 'iceberg.' || db || '.' || t WHEN c <> '*' THEN 'iceberg.' || db || '.*.' || c
    ELSE 'iceberg.' || db END AS policy_name FROM ({NAMED})""",
)
def policy_name(spark, d):
    return _named(spark, d).select("row_index", A.policy_name("db", "t", "c").alias("policy_name"))


@query(
    "rowfilter_policy_name",
    f"""SELECT row_index, 'iceberg' || CASE WHEN db = '*' THEN '' ELSE '.' || db END || CASE WHEN t = '*' THEN '' ELSE '.' || t END
    || '__rowfilter' AS policy_name FROM ({NAMED})""",
)
def rowfilter_policy_name(spark, d):
    return _named(spark, d).select("row_index", A.rowfilter_policy_name("db", "t").alias("policy_name"))


def _named(spark, d):
    def filled(c: str, default: str):
        return F.coalesce(C.strip(c), F.lit(default))

    return B.sheet(spark, d).select(
        "row_index", filled("database", "dbx").alias("db"), filled("tables", "*").alias("t"), filled("columns", "*").alias("c")
    )


LABEL = (
    "CASE WHEN user_id % 9 = 0 THEN 'no label ' || user_id ELSE 'role_' || event_type || '->' || "
    "CASE WHEN user_id % 2 = 0 THEN 'team ' || user_id || ' (group)' ELSE 'u' || user_id || ' (user)' END END"
)


@query(
    "mapping_label_parse",
    f"""SELECT event_id, label, trim(regexp_extract(label, '->([^(]+)\\s*\\((group|user)\\)$', 1)) AS principal,
    trim(regexp_extract(label, '^(.+?)->', 1)) AS role,
    CASE WHEN regexp_matches(label, '->([^(]+)\\s*\\(group\\)$') THEN trim(regexp_extract(label, '->([^(]+)\\s*\\(group\\)$', 1)) END AS group_name,
    'r' || user_id || '->' || event_type || ' (user)' AS built
    FROM (SELECT event_id, user_id, event_type, {LABEL} AS label FROM events)""",
)
def mapping_label_parse(spark, d):
    labels = B.table(spark, d, "events").withColumn("label", F.expr(LABEL))
    return labels.select(
        "event_id",
        "label",
        A.label_principal("label").alias("principal"),
        A.label_role("label").alias("role"),
        A.label_group("label").alias("group_name"),
        A.mapping_label(F.concat(F.lit("r"), F.col("user_id").cast("string")), "event_type", F.lit("user")).alias("built"),
    )


@query(
    "duration_seconds",
    "SELECT event_id, date_sub('second', date_trunc('day', ts), ts) AS seconds FROM events",
)
def duration_seconds(spark, d):
    ts = M.parse_ts(F.col("ts").cast("string"))
    return B.table(spark, d, "events").select(
        "event_id", M.duration_seconds(F.date_trunc("day", ts), ts).alias("seconds")
    )


@query(
    "serde_props_parse",
    """SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN '|' WHEN 1 THEN ',' WHEN 2 THEN ';' END AS field_delim,
    CASE WHEN p_size % 3 = 0 THEN '!' END AS escape_delim,
    CASE WHEN p_size % 5 = 0 THEN p_name END AS null_format,
    CAST(CASE WHEN p_size % 4 < 3 THEN 1 ELSE 0 END + CASE WHEN p_size % 3 = 0 THEN 1 ELSE 0 END
    + CASE WHEN p_size % 5 = 0 THEN 1 ELSE 0 END AS INT) AS property_count FROM part""",
)
def serde_props_parse(spark, d):
    # storage-property texts with one to four properties, one of them of no interest
    raw = F.expr(
        "'[serialization.format=1' || CASE p_size % 4 WHEN 0 THEN ', field.delim=|' WHEN 1 THEN ', field.delim=,' "
        "WHEN 2 THEN ', field.delim = ; ' ELSE '' END || CASE WHEN p_size % 3 = 0 THEN ', escape.delim=!' ELSE '' END "
        "|| CASE WHEN p_size % 5 = 0 THEN ', null.format=' || p_name ELSE '' END || ', bare]'"
    )
    props = B.table(spark, d, "part").select("p_partkey", C.serde_properties(raw).alias("m"))
    get = lambda k: F.try_element_at("m", F.lit(k))
    return props.select(
        "p_partkey",
        get("field.delim").alias("field_delim"),
        get("escape.delim").alias("escape_delim"),
        get("null.format").alias("null_format"),
        F.size("m").alias("property_count"),
    )


@query(
    "describe_pivot",
    """SELECT s_name AS table_name, 's3a://wh/' || s_name AS location, CASE WHEN s_acctbal > 0 THEN 'EXTERNAL' ELSE 'MANAGED' END AS table_type,
    CASE s_nationkey % 3 WHEN 0 THEN 'ORC' WHEN 1 THEN 'TEXTFILE' ELSE 'PARQUET' END AS file_format FROM supplier""",
)
def describe_pivot(spark, d):
    described = B.table(spark, d, "supplier").selectExpr(
        "s_name AS table_name",
        "inline(array("
        "named_struct('col_name', 's_suppkey', 'data_type', 'bigint'),"
        "named_struct('col_name', '# Detailed Table Information', 'data_type', ''),"
        "named_struct('col_name', 'Location', 'data_type', ' s3a://wh/' || s_name || ' '),"
        "named_struct('col_name', 'Type', 'data_type', CASE WHEN s_acctbal > 0 THEN 'EXTERNAL_TABLE' ELSE 'MANAGED_TABLE' END),"
        "named_struct('col_name', 'InputFormat', 'data_type', CASE s_nationkey % 3 WHEN 0 THEN 'x.OrcInputFormat' "
        "WHEN 1 THEN 'x.TextInputFormat' ELSE 'x.Mapred' END)))",
    )
    return catalog.describe_pivot(described, ["table_name"]).drop("storage_properties")


@query(
    "code_lines",
    """WITH l AS (SELECT lang || '/doc_' || doc_id AS path, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents)
    SELECT path, CAST(n AS INT) AS line_number, trim(line) AS code FROM l WHERE trim(line) <> '' AND NOT starts_with(trim(line), '#')""",
)
def code_lines(spark, d):
    corpus = B.table(spark, d, "documents").selectExpr("lang || '/doc_' || doc_id AS path", "text AS content")
    return rewrite.code_lines(corpus)


