"""Catalog access as DataFrames, and the DDL a migration issues.

Names are quoted, values are bound or escaped; nothing is pasted unquoted into a statement.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshift.functions.cells import detect_format
from lakeshift.sources.tables import TEXT_DELIMITER, TEXT_ESCAPE, TEXT_NULL, lakehouse_format, text_options

TABLES = "database string, table_name string, table_type string, is_temporary boolean"
COLUMNS = "database string, table_name string, column_name string, data_type string, ordinal int, is_partition boolean"


def quote(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    rows = [(database, t.name, t.tableType, t.isTemporary) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, TABLES)


def table_columns(spark: SparkSession, database: str, tables: Iterable[str]) -> DataFrame:
    """Column lists of the named tables (metadata calls only)."""
    rows = [
        (database, t, c.name, c.dataType, i, c.isPartition)
        for t in tables
        for i, c in enumerate(spark.catalog.listColumns(f"{quote(database)}.{quote(t)}"))
    ]
    return spark.createDataFrame(rows, COLUMNS)


def partition_columns(spark: SparkSession, database: str, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(f"{quote(database)}.{quote(table)}") if c.isPartition]


def list_partitions(spark: SparkSession, database: str, table: str) -> DataFrame:
    """Registered partitions as strings; empty for an unpartitioned table."""
    if not partition_columns(spark, database, table):
        return spark.createDataFrame([], "partition string")
    return spark.sql(f"SHOW PARTITIONS {quote(database)}.{quote(table)}")


def unregistered_partitions(spark: SparkSession, database: str, table: str) -> bool:
    """The table is partitioned but no partition is registered."""
    return bool(partition_columns(spark, database, table)) and list_partitions(spark, database, table).isEmpty()


def describe_pivot(described: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """DESCRIBE FORMATTED rows (col_name, data_type) -> location, type, format and properties."""
    def value(name: str) -> F.Column:
        return F.max(F.when(F.trim("col_name") == name, F.trim("data_type")))

    return described.groupBy(*keys).agg(
        value("Location").alias("location"),
        F.replace(value("Type"), F.lit("_TABLE"), F.lit("")).alias("table_type"),
        detect_format(F.coalesce(value("InputFormat"), value("Provider"), F.lit(""))).alias("file_format"),
        value("Storage Properties").alias("storage_properties"),
    )


def describe_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    return describe_pivot(spark.sql(f"DESCRIBE FORMATTED {quote(database)}.{quote(table)}"))


def hive_type(data_type: str) -> str:
    return data_type.replace("timestamp_ntz", "timestamp")


def ddl_columns(schema: Sequence[Mapping[str, str]], partitions: Sequence[str]) -> tuple[str, str]:
    """Column list and PARTITIONED BY list; a partition column without a known type is STRING."""
    types = {c["name"]: hive_type(c["type"]) for c in schema}
    columns = ", ".join(f"{quote(n)} {t}" for n, t in types.items() if n not in partitions)
    parts = ", ".join(f"{quote(p)} {types.get(p, 'STRING')}" for p in partitions)
    return columns, parts


def row_format_clause(fmt: str, properties: Mapping[str, str] | None) -> tuple[str, str]:
    """Row format and table properties of a text table; both empty for other formats."""
    if fmt.upper() != "TEXTFILE" or not properties:
        return "", ""
    delimiter = properties.get(TEXT_DELIMITER) or properties.get("field delimiter")
    row_format = table_properties = ""
    if delimiter:
        row_format = f"ROW FORMAT DELIMITED FIELDS TERMINATED BY {text(delimiter)}"
        if properties.get(TEXT_ESCAPE):
            row_format += f" ESCAPED BY {text(properties[TEXT_ESCAPE])}"
    if properties.get(TEXT_NULL):
        table_properties = f"TBLPROPERTIES ('serialization.null.format'={text(properties[TEXT_NULL])})"
    return row_format, table_properties


def has_hive(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.catalogImplementation", "in-memory") == "hive"


def external_table_ddl(
    name: str,
    schema: Sequence[Mapping[str, str]],
    partitions: Sequence[str],
    fmt: str,
    location: str,
    properties: Mapping[str, str] | None = None,
    hive: bool = True,
) -> str:
    """Statement that declares files at ``location`` as a table, as a Hive or a Spark source table."""
    columns, parts = ddl_columns(schema, partitions)
    if hive:
        row_format, table_properties = row_format_clause(fmt, properties)
        split = f" PARTITIONED BY ({parts})" if parts else ""
        return (
            f"CREATE EXTERNAL TABLE IF NOT EXISTS {name} ({columns}){split} {row_format} STORED AS {fmt} "
            f"LOCATION {text(location)} {table_properties}"
        ).strip()
    everything = ", ".join(x for x in (columns, parts) if x)
    split = f" PARTITIONED BY ({', '.join(quote(p) for p in partitions)})" if partitions else ""
    options = ""
    if fmt.upper() == "TEXTFILE":
        pairs = ", ".join(f"{text(k)} {text(v)}" for k, v in text_options(properties).items())
        options = f" OPTIONS ({pairs})"
    source = "csv" if fmt.upper() == "TEXTFILE" else fmt.lower()
    return f"CREATE TABLE IF NOT EXISTS {name} ({everything}) USING {source}{options}{split} LOCATION {text(location)}"


def create_external_table(
    spark: SparkSession,
    database: str,
    table: str,
    schema: Sequence[Mapping[str, str]],
    partitions: Sequence[str],
    fmt: str,
    location: str,
    properties: Mapping[str, str] | None = None,
) -> bool:
    """Create the table unless it exists; returns whether it existed."""
    existed = spark.catalog.tableExists(f"{database}.{table}")
    name = f"{quote(database)}.{quote(table)}"
    spark.sql(external_table_ddl(name, schema, partitions, fmt, location, properties, has_hive(spark)))
    return existed


def repair_table(spark: SparkSession, database: str, table: str) -> None:
    """Register partitions found on storage and drop cached file lists."""
    name = f"{quote(database)}.{quote(table)}"
    if partition_columns(spark, database, table):
        spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.sql(f"REFRESH TABLE {name}")


def add_partitions(
    spark: SparkSession, database: str, table: str, partitions: Iterable[str], location: str, batch: int = 500
) -> None:
    """Register the given partitions at their directories, many per statement."""
    clauses = []
    for part in partitions:
        pairs = [s.split("=", 1) for s in part.split("/") if "=" in s]
        spec = ", ".join(f"{quote(k)}={text(_decode(v))}" for k, v in pairs)
        clauses.append(f"PARTITION ({spec}) LOCATION {text(location.rstrip('/') + '/' + part)}")
    for i in range(0, len(clauses), batch):
        chosen = " ".join(clauses[i : i + batch])
        spark.sql(f"ALTER TABLE {quote(database)}.{quote(table)} ADD IF NOT EXISTS {chosen}")


def _decode(value: str) -> str:
    from urllib.parse import unquote

    return unquote(value)


def ensure_databases(spark: SparkSession, names: Iterable[str], location: str | None = None) -> None:
    for name in dict.fromkeys(names):
        where = f" LOCATION {text(location.rstrip('/') + '/' + name)}" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(name)}{where}")


def register_table(spark: SparkSession, database: str, table: str, location: str, fmt: str = "parquet") -> str:
    """Make an existing table's files known under a name, with its partitions, or refresh it when it is; returns the action."""
    name = f"{quote(database)}.{quote(table)}"
    if spark.catalog.tableExists(f"{database}.{table}"):
        if fmt == "iceberg":
            spark.sql(f"REFRESH TABLE {name}")
        else:
            repair_table(spark, database, table)
        return "refreshed"
    if fmt == "iceberg":
        spark.sql(f"CALL spark_catalog.system.register_table(table => {text(database + '.' + table)}, metadata_file => {text(location)})")
    else:
        spark.sql(f"CREATE TABLE {name} USING {fmt} LOCATION {text(location)}")
        repair_table(spark, database, table)
    return "registered"


def ensure_ledger(spark: SparkSession, database: str, schemas: Mapping[str, T.StructType], location: str | None = None) -> None:
    """Create the ledger database and its tables unless they exist; table ledgers split by database."""
    ensure_databases(spark, [database], location)
    fmt = lakehouse_format(spark)
    for name, schema in schemas.items():
        columns = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
        split = " PARTITIONED BY (source_database)" if name in PARTITIONED_LEDGERS else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {quote(database)}.{quote(name)} ({columns}) USING {fmt}{split}")


# Ledgers stored per source database.
PARTITIONED_LEDGERS = ("migration_table_status", "iceberg_migration_table_status", "s3_migration_table_status")
