"""Queries for manifests, copy plans and copies."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeshift.functions import measures as M
from lakeshift.operators import files as ops
from lakeshift.operators import partitions as part_ops
from lakeshift.sources import tables as sink
from lakeshift.sources.scratch import scratch_dir
from lakeshift.workload import base as B
from lakeshift.workload.registry import query

SRC, DST = B.SOURCE_FILES_SQL, B.DEST_FILES_SQL


@query(
    "content_summary",
    f"SELECT source_table, part, count(*) AS file_count, sum(length)::BIGINT AS size_bytes FROM ({SRC}) GROUP BY ALL",
)
def content_summary(spark, d):
    return ops.content_summary(B.source_files(spark, d), ["source_table", "part"])


PLAN = f"""SELECT coalesce(s.rel_path, t.rel_path) AS rel_path, s.length AS source_length, t.length AS dest_length,
    CASE WHEN t.rel_path IS NULL THEN 'NEW' WHEN s.rel_path IS NULL THEN 'EXTRA' WHEN s.length <> t.length THEN 'CHANGED' ELSE 'SAME' END AS action
    FROM ({SRC}) s FULL OUTER JOIN ({DST}) t ON s.rel_path = t.rel_path"""


@query("copy_plan", PLAN)
def copy_plan(spark, d):
    return ops.copy_plan(B.source_files(spark, d), B.dest_files(spark, d))


@query(
    "copy_plan_result",
    f"""WITH p AS ({PLAN}) SELECT 'mirror' AS mode, rel_path, coalesce(source_length, dest_length) AS length FROM p WHERE action <> 'EXTRA'
    UNION ALL SELECT 'additive', rel_path, coalesce(source_length, dest_length) FROM p""",
)
def copy_plan_result(spark, d):
    plan = ops.copy_plan(B.source_files(spark, d), B.dest_files(spark, d))
    mirror = ops.planned_result(plan, "mirror").withColumn("mode", F.lit("mirror"))
    return mirror.unionByName(ops.planned_result(plan, "additive").withColumn("mode", F.lit("additive")))


@query(
    "filtered_content",
    f"""SELECT source_table, count(*) AS file_count, sum(length)::BIGINT AS size_bytes FROM ({SRC})
    WHERE regexp_matches(part, 'ym=(1999|2001-0[1-6])') GROUP BY ALL""",
)
def filtered_content(spark, d):
    files = B.source_files(spark, d)
    parts = files.select("source_table", "part").distinct().where(F.col("part").rlike("ym=(1999|2001-0[1-6])"))
    return ops.filtered_content(files, parts, ["source_table"], "part")


@query(
    "nonempty_partitions",
    f"""WITH f AS (SELECT source_table, part, CASE WHEN length < 40 THEN 0 WHEN length > 90 THEN NULL ELSE length END AS length FROM ({SRC})),
    p AS (SELECT source_table, part, sum(length) AS b, count(*) FILTER (WHERE length IS NULL) AS u FROM f GROUP BY ALL)
    SELECT source_table, count(*) AS partition_count, count(*) FILTER (WHERE b > 0 OR u > 0) AS nonempty_partition_count FROM p GROUP BY ALL""",
)
def nonempty_partitions(spark, d):
    # small files count as empty, the sizes of large ones are unknown
    length = F.expr("CASE WHEN length < 40 THEN 0 WHEN length > 90 THEN NULL ELSE length END")
    files = B.source_files(spark, d).withColumn("length", length)
    return part_ops.nonempty_partition_counts(files, ["source_table"], "part")


PAIRED = f"""SELECT s.rel_path, s.length AS a, t.length AS b FROM ({SRC}) s JOIN ({DST}) t ON s.rel_path = t.rel_path"""


@query(
    "size_match",
    f"""SELECT rel_path, abs(a - b) / greatest(a, 1) < 0.01 AS relative_match,
    abs(a - b) <= greatest(1, CAST(floor(a * 0.01) AS BIGINT)) AS absolute_match FROM ({PAIRED})""",
)
def size_match(spark, d):
    plan = ops.copy_plan(B.source_files(spark, d), B.dest_files(spark, d))
    both = plan.where(F.col("action").isin("SAME", "CHANGED"))
    return both.select(
        "rel_path",
        M.size_match_rel("source_length", "dest_length").alias("relative_match"),
        M.size_match_abs("source_length", "dest_length").alias("absolute_match"),
    )


def _folder(df, root="root"):
    return df.withColumn(root, F.concat(F.lit("s3a://lake/"), F.col("part")))


@query(
    "copy_delta",
    f"""WITH b AS (SELECT part, count(*) AS n, sum(length)::BIGINT AS s FROM ({DST}) GROUP BY ALL),
    a AS (SELECT part, count(*) AS n, sum(length)::BIGINT AS s FROM ({SRC}) GROUP BY ALL)
    SELECT coalesce(a.part, b.part) AS part, coalesce(b.n, 0) AS file_count_before, coalesce(b.s, 0) AS size_bytes_before,
    coalesce(a.n, 0) AS file_count_after, coalesce(a.s, 0) AS size_bytes_after, b.part IS NOT NULL AS is_incremental,
    greatest(coalesce(a.n, 0) - coalesce(b.n, 0), 0) AS files_copied, greatest(coalesce(a.s, 0) - coalesce(b.s, 0), 0) AS bytes_copied
    FROM a FULL OUTER JOIN b ON a.part = b.part""",
)
def copy_delta(spark, d):
    before = ops.content_summary(B.dest_files(spark, d), ["part"])
    after = ops.content_summary(B.source_files(spark, d), ["part"])
    return ops.copy_delta(before, after, ["part"], clamp=True)


# tables that expect their data in a partition directory; some have no path, some an unread one
TABLES = f"""SELECT DISTINCT source_table, part AS source_partition, CASE WHEN part LIKE '%ym=1995%' THEN ''
    WHEN part LIKE '%ym=1996%' THEN NULL ELSE 's3a://lake/' || part END AS dest_path FROM ({SRC})"""
LISTED = f"""SELECT 's3a://lake/' || part AS root, count(*) FILTER (WHERE length > 60) AS file_count,
    coalesce(sum(length) FILTER (WHERE length > 60), 0)::BIGINT AS size_bytes,
    CASE WHEN part LIKE '%ym=1997-0%' THEN 'access denied' END AS error FROM ({DST}) GROUP BY part"""


def _presence_inputs(spark, d):
    tables = (
        B.source_files(spark, d)
        .select("source_table", F.col("part").alias("source_partition"))
        .distinct()
        .withColumn(
            "dest_path",
            F.expr(
                "CASE WHEN source_partition LIKE '%ym=1995%' THEN '' WHEN source_partition LIKE '%ym=1996%' THEN NULL "
                "ELSE 's3a://lake/' || source_partition END"
            ),
        )
    )
    listed = (
        B.dest_files(spark, d)
        .groupBy("part")
        .agg(
            F.count_if(F.col("length") > 60).alias("file_count"),
            F.coalesce(F.sum(F.when(F.col("length") > 60, F.col("length"))), F.lit(0)).alias("size_bytes"),
        )
        .selectExpr(
            "'s3a://lake/' || part AS root",
            "file_count",
            "size_bytes",
            "CASE WHEN part LIKE '%ym=1997-0%' THEN 'access denied' END AS error",
        )
    )
    return tables, listed


@query(
    "data_presence",
    f"""SELECT t.*, CASE WHEN coalesce(dest_path, '') = '' THEN 'MISSING' WHEN error IS NOT NULL THEN 'FAILED'
    WHEN root IS NULL OR file_count = 0 THEN 'MISSING' ELSE 'CONFIRMED' END AS status,
    CASE WHEN coalesce(dest_path, '') <> '' AND error IS NULL AND file_count > 0 THEN file_count ELSE 0 END AS file_count,
    CASE WHEN coalesce(dest_path, '') <> '' AND error IS NULL AND file_count > 0 THEN size_bytes ELSE 0 END AS size_bytes,
    CASE WHEN coalesce(dest_path, '') = '' THEN 'no destination path computed' WHEN error IS NOT NULL THEN error
    WHEN root IS NULL THEN 'destination path does not exist: ' || dest_path
    WHEN file_count = 0 THEN 'destination path holds no files: ' || dest_path END AS error
    FROM ({TABLES}) t LEFT JOIN ({LISTED}) l ON t.dest_path = l.root""",
)
def data_presence(spark, d):
    return ops.data_presence(*_presence_inputs(spark, d))


COPIES = f"""SELECT 'src/' || part AS source_path, 's3a://lake/' || part AS dest_path,
    CASE WHEN part LIKE '%ym=1999-05%' THEN 'FAILED' ELSE 'COMPLETED' END AS status,
    count(*) AS source_file_count, sum(length)::BIGINT AS source_size_bytes FROM ({SRC}) GROUP BY part"""


@query(
    "folder_verify",
    f"""WITH l AS (SELECT 's3a://lake/' || part AS root, count(*) AS n, sum(length)::BIGINT AS s FROM ({DST}) GROUP BY part),
    j AS (SELECT c.*, root, coalesce(n, 0) AS n, coalesce(s, 0) AS s FROM ({COPIES}) c LEFT JOIN l ON c.dest_path = l.root),
    m AS (SELECT *, n = source_file_count AS fm, abs(source_size_bytes - s) <= greatest(1, CAST(floor(source_size_bytes * 0.01) AS BIGINT)) AS sm FROM j)
    SELECT source_path, dest_path, status, source_file_count, source_size_bytes,
    CASE WHEN status <> 'FAILED' THEN n END AS dest_file_count, CASE WHEN status <> 'FAILED' THEN s END AS dest_size_bytes,
    CASE WHEN status <> 'FAILED' THEN fm END AS file_count_match, CASE WHEN status <> 'FAILED' THEN sm END AS size_match,
    CASE WHEN status = 'FAILED' THEN 'VALIDATION_SKIPPED' WHEN root IS NOT NULL AND fm AND sm THEN 'VALIDATED' ELSE 'VALIDATION_FAILED' END AS validation_status,
    CASE WHEN status <> 'FAILED' AND root IS NULL THEN 'destination does not exist after copy' END AS validation_error FROM m""",
)
def folder_verify(spark, d):
    copies = ops.content_summary(B.source_files(spark, d), ["part"]).selectExpr(
        "'src/' || part AS source_path",
        "'s3a://lake/' || part AS dest_path",
        "CASE WHEN part LIKE '%ym=1999-05%' THEN 'FAILED' ELSE 'COMPLETED' END AS status",
        "file_count AS source_file_count",
        "size_bytes AS source_size_bytes",
    )
    listed = ops.content_summary(_folder(B.dest_files(spark, d)), ["root"])
    return ops.folder_verify(copies, listed)


ORDER_LIST = ", ".join(B.ORDER_COLUMNS)


@query("copy_mirror", f"SELECT {ORDER_LIST} FROM orders")
def copy_mirror(spark, d):
    """A destination that lost, changed and gained rows, mirrored and read back."""
    dest = scratch_dir(spark, "copy_mirror")
    orders = B.table(spark, d, "orders").select(*B.ORDER_COLUMNS)
    sink.copy_table(B.dest_orders(spark, d), dest)
    sink.copy_table(orders, dest)
    return spark.read.parquet(dest).select(*B.ORDER_COLUMNS)


CHANGED = "o_orderpriority IN ('1-URGENT', '5-LOW')"
#: orders of two priorities, some of them moved to a third, against a destination by priority
MOVED = f"CASE WHEN o_orderstatus = 'P' THEN '2-HIGH' ELSE o_orderpriority END"


@query(
    "copy_additive",
    f"""WITH s AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, {MOVED} AS o_orderpriority FROM orders WHERE {CHANGED})
    SELECT * FROM s UNION ALL SELECT {ORDER_LIST} FROM ({B.DEST_ORDERS_SQL}) t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)""",
)
def copy_additive(spark, d):
    """The writer over a destination by priority: changed, moved and new orders, read back."""
    dest = scratch_dir(spark, "copy_additive")
    by = ["o_orderpriority"]
    sink.copy_table(B.dest_orders(spark, d).select(*B.ORDER_COLUMNS), dest, partition_by=by)
    source = B.table(spark, d, "orders").where(CHANGED).withColumn("o_orderpriority", F.expr(MOVED)).select(*B.ORDER_COLUMNS)
    sink.copy_table(source, dest, mode="additive", partition_by=by, keys=["o_orderkey"])
    return spark.read.parquet(dest).select(*B.ORDER_COLUMNS)


@query(
    "copy_partitions",
    """SELECT l_returnflag AS flag, l_linestatus AS status, count(*) AS row_count, sum(CAST(l_quantity AS BIGINT))::BIGINT AS quantity
    FROM lineitem WHERE (l_returnflag = 'N' AND l_linestatus = 'O' AND l_quantity > 10) OR l_returnflag <> 'N' GROUP BY ALL""",
)
def copy_partitions(spark, d):
    """A copy of all partitions, then one of the flag N alone, whose status F has been emptied at the source since."""
    dest = scratch_dir(spark, "copy_partitions")
    lines = B.table(spark, d, "lineitem").withColumnsRenamed({"l_returnflag": "flag", "l_linestatus": "status"})
    sink.copy_partitions(lines, dest, ["flag", "status"])
    now = lines.where("flag <> 'N' OR (status = 'O' AND l_quantity > 10)")
    sink.copy_partitions(now, dest, ["flag", "status"], within=F.col("flag") == "N")
    copied = spark.read.parquet(dest)
    return copied.groupBy("flag", "status").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )


ADDED_ROWS = f"""SELECT {ORDER_LIST} FROM orders UNION ALL SELECT {ORDER_LIST} FROM ({B.DEST_ORDERS_SQL}) t
    WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)"""


@query("additive_rows", ADDED_ROWS)
def additive_rows(spark, d):
    return sink.additive_rows(B.table(spark, d, "orders"), B.dest_orders(spark, d), ["o_orderkey"])
