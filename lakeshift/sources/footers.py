"""Row counts taken from the footers of Parquet and ORC files.

The columnar sources answer count(*), grouped by partition columns at most, from file footers alone when aggregates are
pushed down to them. That works in the newer form of these sources, which a session uses for the formats that its list
of older ones leaves out; reads here go through a session of their own with these settings, so the caller's stays as it is.
A filter on partition columns is pushed down with the count. Any other filter makes Spark scan the rows: that is
slower, and as exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PUSHED = ("parquet", "orc")


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application in which counts are answered from footers."""
    other = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        value = spark.conf.get(key, None)
        if value is not None:
            other.conf.set(key, value)
    older = spark.conf.get("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,parquet,text").split(",")
    other.conf.set("spark.sql.sources.useV1SourceList", ",".join(f for f in older if f.strip().lower() not in PUSHED))
    for fmt in PUSHED:
        other.conf.set(f"spark.sql.{fmt}.aggregatePushdown", "true")
    return other


def row_counts(
    footers: SparkSession, location: str, fmt: str = "parquet", partition_by: Sequence[str] = (), where: Column | None = None
) -> DataFrame:
    """row_count per partition (one row without ``partition_by``), for a session of :func:`footer_session`.

    ``partition_by`` names all partition columns: Spark answers from footers for all of them or none. Partition values come back as they are read; an empty table has a row with zero only if it is unpartitioned.
    """
    rows = footers.read.format(fmt.lower()).load(location)
    if where is not None:
        rows = rows.where(where)
    return rows.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("row_count"))
