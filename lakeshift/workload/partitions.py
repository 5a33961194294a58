"""Queries for partition strings and filter expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeshift.functions import partitions as P
from lakeshift.operators import partitions as ops
from lakeshift.operators import reconcile
from lakeshift.workload import base as B
from lakeshift.workload.registry import query

# partition strings with an encoded value and a numeric one, one per supplier, part brand and year
ENCODED = (
    "'brand=' || replace(replace(p_brand, '#', '%23'), '1', '+') || '/size = ' || p_size || '/note/name=' || replace(p_name, ' ', '%20')"
)


@query(
    "partition_map",
    """SELECT p_partkey, replace(p_brand, '1', '+') AS brand, CAST(p_size AS VARCHAR) AS size, p_name AS name, CAST(3 AS INT) AS key_count
    FROM part""",
)
def partition_map(spark, d):
    parts = B.table(spark, d, "part").selectExpr("p_partkey", f"{ENCODED} AS part")
    m = P.partition_map("part")
    return parts.select(
        "p_partkey",
        P.partition_value("part", "brand").alias("brand"),
        F.try_element_at(m, F.lit("size")).alias("size"),
        F.try_element_at(m, F.lit("name")).alias("name"),
        F.size(m).alias("key_count"),
    )


YEAR = "regexp_extract(part, 'year=([^/]*)', 1)"
MONTH = "regexp_extract(part, 'month=([^/]*)', 1)"


def _filtered(expr: str):
    def run(spark, d):
        return ops.apply_partition_filter(B.month_partitions(spark, d), expr, "part", ["source_table"])

    return run


def _months(where: str) -> str:
    return f"SELECT source_table, part FROM ({B.MONTHS_SQL}) WHERE {where}"


query("pf_exact", _months("part = 'year=1998/month=07'"))(_filtered("year=1998/month=07"))
query("pf_prefix", _months("starts_with(part, 'year=1999') OR starts_with(part, 'year=2000/month=1')"))(
    _filtered("year=1999/*, year=2000/month=1*")
)
query("pf_compare", _months(f"CAST({YEAR} AS INT) >= 2000 OR CAST({MONTH} AS INT) < 3"))(_filtered("year>=2000, month<03"))
query("pf_compare_prefix", _months(f"CAST(left({YEAR}, 3) AS INT) <= 199"))(_filtered("year<=199*"))
query(
    "pf_last_n",
    f"""SELECT source_table, part FROM ({B.MONTHS_SQL}) QUALIFY row_number() OVER (PARTITION BY source_table ORDER BY part DESC) <= 5""",
)(_filtered("last_n_partitions=5"))
query(
    "pf_union",
    f"""SELECT source_table, part FROM (SELECT *, row_number() OVER (PARTITION BY source_table ORDER BY part DESC) AS r FROM ({B.MONTHS_SQL}))
    WHERE part = 'year=1997/month=05' OR starts_with(part, 'year=1996') OR CAST({MONTH} AS INT) > 11 OR r <= 2""",
)(_filtered("year=1997/month=05, year=1996/*, month>11, last_n_partitions=2, no such term, ghost<5"))


DAY = "'dt=' || substr(CAST(l_shipdate AS STRING), 1, 10)"


@query(
    "pf_control",
    f"""WITH c AS (SELECT DISTINCT 'lineitem_' || l_returnflag AS source_table, l_returnflag AS f FROM lineitem),
    p AS (SELECT *, row_number() OVER (PARTITION BY source_table ORDER BY part DESC) AS r FROM
      (SELECT DISTINCT {B.TABLE_OF} AS source_table, {DAY} AS part FROM lineitem))
    SELECT source_table, part, 'main' AS dest FROM p JOIN c USING (source_table) WHERE (f = 'A' AND (r <= 3 OR part = 'dt=1998-05-05'))
    OR (f = 'N' AND part >= 'dt=2001-06-01') OR f = 'R'
    UNION ALL SELECT source_table, part, 'second' FROM p JOIN c USING (source_table) WHERE f = 'A' AND r <= 5
    UNION ALL SELECT source_table, part, 'third' FROM p JOIN c USING (source_table) WHERE f = 'A' AND part < 'dt=1994-01-01'""",
)
def pf_control(spark, d):
    lines = B.table(spark, d, "lineitem")
    control = lines.select("l_returnflag").distinct().selectExpr(
        "'lineitem_' || l_returnflag AS source_table",
        "CASE l_returnflag WHEN 'A' THEN 'last_n_partitions=3, dt=1998-05-05' WHEN 'N' THEN 'dt>=2001-06-01' END AS partition_filter",
        "'main' AS dest",
    )
    # one table copied to three places by three filters
    again = control.where("source_table = 'lineitem_A'").select("source_table")
    for dest, expr in (("second", "last_n_partitions=5"), ("third", "dt<1994-01-01")):
        control = control.unionByName(again.selectExpr("source_table", f"'{expr}' AS partition_filter", f"'{dest}' AS dest"))
    # the partition string is an aggregate result, so filters on it run per partition, not per row
    days = lines.groupBy(F.expr(B.TABLE_OF).alias("source_table"), "l_shipdate").agg(F.expr(f"max({DAY})").alias("part")).drop("l_shipdate")
    return ops.apply_control_filters(days, control, ["source_table"], "part", groups=["dest"])


WANTED = ["flag=A/status=F", "flag=N/status=O", "flag=R/status=O"]


@query(
    "where_from_partitions",
    """SELECT l_returnflag AS flag, l_linestatus AS status, count(*) AS row_count, sum(CAST(l_quantity AS BIGINT))::BIGINT AS quantity
    FROM lineitem WHERE (l_returnflag = 'A' AND l_linestatus = 'F') OR (l_returnflag IN ('N', 'R') AND l_linestatus = 'O') GROUP BY ALL""",
)
def where_from_partitions(spark, d):
    lines = B.table(spark, d, "lineitem").withColumnsRenamed({"l_returnflag": "flag", "l_linestatus": "status"})
    return (
        lines.where(P.partitions_predicate(WANTED))
        .groupBy("flag", "status")
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))
    )


@query(
    "keep_partitions",
    """WITH big AS (SELECT DISTINCT l_shipdate FROM lineitem WHERE l_quantity = 50 AND l_discount = 0.1)
    SELECT l_returnflag AS flag, count(*) AS row_count FROM lineitem WHERE l_shipdate IN (SELECT l_shipdate FROM big) GROUP BY ALL""",
)
def keep_partitions(spark, d):
    lines = B.table(spark, d, "lineitem").withColumn("dt", F.to_date("l_shipdate"))
    listed = lines.where("l_quantity = 50 AND l_discount = 0.1").selectExpr("'dt=' || dt AS partition")
    kept = ops.keep_partitions(lines, listed, ["dt"])
    return kept.groupBy(F.col("l_returnflag").alias("flag")).agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "filter_active",
    f"""WITH m AS ({B.MONTHS_SQL}), a AS (SELECT source_table, count(*) AS partition_count,
    count(*) FILTER (WHERE starts_with(part, 'year=1') OR source_table = 'lineitem_R') AS filtered_partition_count FROM m GROUP BY ALL)
    SELECT *, filtered_partition_count < partition_count AS filter_active FROM a""",
)
def filter_active(spark, d):
    months = B.month_partitions(spark, d)
    # the filter narrows two tables and matches all of the third
    matched = ops.apply_partition_filter(months, "year=1*", "part").unionByName(
        ops.apply_partition_filter(months, "year=2*", "part").where("source_table = 'lineitem_R'")
    )
    return ops.filter_figures(months, matched, ["source_table"], "year=1*")


@query(
    "filtered_row_count",
    f"""SELECT {B.TABLE_OF} AS source_table, count(*) AS row_count,
    count(*) FILTER (WHERE year(l_shipdate) >= 2000) AS filtered_row_count FROM lineitem GROUP BY ALL""",
)
def filtered_row_count(spark, d):
    lines = B.table(spark, d, "lineitem").withColumn("source_table", F.expr(B.TABLE_OF))
    parts = reconcile.partition_metrics(lines, F.expr(B.MONTH_PART), ["source_table"])
    return reconcile.table_counts(parts, ["source_table"], P.matches_filter("partition", "year>=2000"))


@query(
    "schema_json",
    f"SELECT source_table, CAST(to_json(list(part ORDER BY part)) AS VARCHAR) AS partitions_json, count(*) AS partition_count FROM ({B.MONTHS_SQL}) GROUP BY ALL",
)
def schema_json(spark, d):
    months = B.month_partitions(spark, d)
    return months.groupBy("source_table").agg(
        F.to_json(F.sort_array(F.collect_set("part"))).alias("partitions_json"), F.count(F.lit(1)).alias("partition_count")
    )


