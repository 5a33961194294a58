"""Tables at the destination of a run: declaring them over files that are there, and checking them against their sources."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lakeshift.operators import reconcile
from lakeshift.sources import catalog, inventory
from lakeshift.sources.inventory import TableRef

KEYS = ["source_database", "source_table", "dest_database"]


def declared(spark: SparkSession, ref: TableRef, database: str, location: str, matched: DataFrame | None = None) -> dict:
    """Declare a table like ``ref`` over ``location`` and register its partitions, all of them or the ``matched`` ones."""
    catalog.ensure_databases(spark, [database])
    schema = [{"name": n, "type": t} for n, t in ref.schema]
    existed = catalog.create_external_table(spark, database, ref.name, schema, ref.partition_by, ref.fmt, location, ref.properties)
    if matched is None:
        catalog.repair_table(spark, database, ref.name)
    else:
        catalog.add_partitions(spark, database, ref.name, (r.partition for r in matched.toLocalIterator()), location)
    return {"existed": existed}


def checked(spark: SparkSession, run_id: str, tables: Sequence[tuple[Row, TableRef, str]]) -> DataFrame:
    """Counts and columns of all declared tables against those that the ledger rows hold, as one job.

    Each entry is (ledger row, source table, destination folder). Rows at the destination are counted from footers where
    the format has them.
    """
    refs, source, columns = [], [], {"source": [], "dest": []}
    for row, ref, location in tables:
        key = (row.source_database, row.source_table, row.dest_database)
        refs.append(replace(ref, location=location, database="\n".join((row.source_database, row.dest_database))))
        source.append((*key, row.source_row_count, int(row.source_partition_count)))
        columns["source"] += [(*key, n, catalog.hive_type(t)) for n, t in ref.schema]
        theirs = spark.catalog.listColumns(f"{catalog.quote(row.dest_database)}.{catalog.quote(ref.name)}")
        columns["dest"] += [(*key, c.name, catalog.hive_type(c.dataType)) for c in theirs]
    names = ", ".join(f"{k} string" for k in KEYS)
    both = F.split("source_database", "\n")
    count = F.col("partition_count").cast("long").alias("partition_count")
    dest = inventory.inventory(spark, refs).select(both[0].alias("source_database"), "source_table", both[1].alias("dest_database"), "row_count", count)
    sides = [spark.createDataFrame(columns[s], f"{names}, column_name string, data_type string") for s in ("source", "dest")]
    verdict = reconcile.schema_verdict(reconcile.schema_diff(*sides, KEYS, case_sensitive=False), KEYS)
    wanted = spark.createDataFrame(source, f"{names}, row_count long, partition_count long")
    return reconcile.reconcile_tables(wanted, dest, verdict, KEYS).select(F.lit(run_id).alias("run_id"), F.lit("COMPLETED").alias("status"), "*")
