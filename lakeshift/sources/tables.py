"""Table readers and writers: formats, copies, conversions and ledger writes."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshift.functions.partitions import HIVE_NULL, partition_value
from lakeshift.sources import storage
from lakeshift.sources.files import file_manifest
from lakeshift.sources.scratch import stored

# Text-table storage properties and their defaults.
TEXT_DELIMITER, TEXT_ESCAPE, TEXT_NULL = "field.delim", "escape.delim", "null.format"


def text_options(properties: Mapping[str, str] | None) -> dict[str, str]:
    """Reader options of a delimited text table; such files know no quotes."""
    properties = properties or {}
    return {"sep": properties.get(TEXT_DELIMITER, "\x01"), "nullValue": properties.get(TEXT_NULL, "\\N"), "quote": ""}


def _read_escaped_text(spark: SparkSession, path: str, schema: T.StructType, properties: Mapping[str, str]) -> DataFrame:
    """Delimited text whose values may hold escaped delimiters, which the CSV reader keeps as they are."""
    options = text_options(properties)
    sep, esc = re.escape(options["sep"]), re.escape(properties[TEXT_ESCAPE])
    line = F.concat(F.col("value"), F.lit(options["sep"]))
    raw = F.regexp_extract_all(line, F.lit(rf"((?:[^{sep}{esc}]|{esc}.)*){sep}"), F.lit(1))
    cells = spark.read.text(path).select(raw.alias("cells"))

    def value(i: int, field: T.StructField):
        cell = F.get("cells", F.lit(i))
        plain = F.regexp_replace(cell, rf"{esc}(.)", "$1")
        return F.when(cell != options["nullValue"], plain).try_cast(field.dataType).alias(field.name)

    return cells.select(*[value(i, f) for i, f in enumerate(schema.fields)])


def read_table_files(
    spark: SparkSession,
    fmt: str,
    path: str,
    schema: T.StructType | str | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Files of a table by storage format; the schema is inferred unless given."""
    fmt = fmt.upper()
    if fmt == "TEXTFILE":
        if schema is not None and properties and properties.get(TEXT_ESCAPE):
            known = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
            return _read_escaped_text(spark, path, known, properties)
        reader = spark.read.format("csv").options(**text_options(properties))
    elif fmt in ("PARQUET", "ORC"):
        reader = spark.read.format(fmt.lower())
    elif fmt == "AVRO":
        reader = spark.read.format("avro")  # needs the spark-avro package on the cluster
    else:
        raise ValueError(f"unknown table format: {fmt}")
    return (reader.schema(schema) if schema is not None else reader).load(path)


def without_ntz(df: DataFrame) -> DataFrame:
    """TIMESTAMP_NTZ columns as TIMESTAMP, which Hive DDL understands."""
    ntz = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in ntz}) if ntz else df


def mirror_rows(source: DataFrame, dest: DataFrame) -> DataFrame:
    """Destination after a mirror copy: exactly the source."""
    return source.select(*dest.columns)


def additive_rows(source: DataFrame, dest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Destination after an additive copy: all source rows, and destination rows of other keys."""
    kept = dest.join(source.select(*keys), list(keys), "left_anti")
    return source.select(*dest.columns).unionByName(kept)


def _writer(df: DataFrame, fmt: str, mode: str, partition_by: Sequence[str]):
    w = df.write.format(fmt).mode(mode)
    return w.partitionBy(*partition_by) if partition_by else w


def copy_table(
    source: DataFrame, dest: str, fmt: str = "parquet", mode: str = "mirror", partition_by: Sequence[str] = (), keys: Sequence[str] = ()
) -> None:
    """Write ``source`` to ``dest``.

    ``mirror`` replaces the destination. ``additive`` adds all source rows and replaces those of the destination that
    have their ``keys``; see :func:`copy_additive`.
    """
    if mode == "mirror":
        _writer(source, fmt, "overwrite", partition_by).save(dest)
    elif mode == "additive":
        copy_additive(source, dest, keys, partition_by, fmt)
    else:
        raise ValueError(f"unknown copy mode: {mode}")


def copy_additive(source: DataFrame, dest: str, keys: Sequence[str], partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Additive copy, partition by partition: only partitions that gain or lose a row are written anew.

    These are the partitions of the source's rows and those in which the destination holds a row of a key that the
    source has. Their new rows (see :func:`additive_rows`) are stored in the shared folder first, since they are read from
    the files that they replace; then they replace these partitions and no others. A partition all of whose rows moved
    elsewhere is removed. A destination without partitions is one partition. Null keys match nothing, so such
    destination rows stay; null partition values are values.
    """
    spark = source.sparkSession
    if not storage.names(spark, dest):
        _writer(source, fmt, "append", partition_by).save(dest)
        return
    existing = spark.read.format(fmt).load(dest)
    # partition values as the source types them, so that "01" is not taken for a number and written back as "1"
    fields = [source.schema[f.name] if f.name in partition_by else f for f in existing.schema.fields]
    existing = spark.read.format(fmt).schema(T.StructType(fields)).load(dest)
    source = source.select(*existing.columns)
    if not partition_by:
        _writer(stored(additive_rows(source, existing, keys), "additive"), fmt, "overwrite", ()).save(dest)
        return
    # files name partitions by text, so values are compared as text
    value = [F.col(c).cast("string").alias(f"_p_{c}") for c in partition_by]
    replaced = existing.join(source.select(*keys).distinct(), list(keys), "left_semi").select(*value)
    touched = stored(source.select(*value).unionByName(replaced).distinct(), "touched")
    same = [existing[c].cast("string").eqNullSafe(touched[f"_p_{c}"]) for c in partition_by]
    affected = existing.join(touched, same, "left_semi")
    rows = stored(additive_rows(source, affected, keys), "additive")
    copy_partitions(rows, dest, partition_by, fmt)
    left = rows.select(*value).distinct()
    emptied = touched.join(left, [touched[c].eqNullSafe(left[c]) for c in touched.columns], "left_anti")
    remove_partitions(spark, dest, emptied.toDF(*partition_by))


def copy_partitions(
    source: DataFrame, dest: str, partition_by: Sequence[str], fmt: str = "parquet", within: Column | None = None
) -> None:
    """Replace the partitions present in ``source``; all others stay as they are.

    With ``within``, a condition on the partition columns, the copy mirrors what it covers: a partition of the destination
    that meets it and that the source no longer has is removed. Rows are dealt out by partition, and AQE splits
    partitions that are large, so a hot one is written by several tasks.
    """
    if within is not None:
        source = source.where(within)
    rows = source.hint("rebalance", *partition_by)
    rows.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).save(dest)
    if within is not None:
        spark = source.sparkSession
        theirs = partition_values(spark, dest, partition_by).where(within)
        ours = source.select(*[F.col(c).cast("string").alias(f"_s_{c}") for c in partition_by]).distinct()
        remove_partitions(spark, dest, theirs.join(ours, [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in partition_by], "left_anti"))


# Fixed value: partitions that a task of write_whole_partitions writes side by side; further ones are sorted first.
OPEN_FILES = 32


def write_whole_partitions(df: DataFrame, dest: str, partition_by: Sequence[str], fmt: str = "parquet") -> None:
    """Write a new partitioned folder with one file per partition.

    Rows go to their files as they come. Without the setting a task would sort all its rows by partition before, and
    hold as many of them in memory as it is given.
    """
    spark, setting = df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, OPEN_FILES)
    try:
        df.repartition(*partition_by).write.partitionBy(*partition_by).format(fmt).save(dest)
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


def partition_values(spark: SparkSession, root: str, partition_by: Sequence[str]) -> DataFrame:
    """Values, as text, of the partitions that hold files below ``root``."""
    folders = file_manifest(spark, root).select("partition").distinct()
    values = [partition_value("partition", c) for c in partition_by]
    return folders.select(*[F.when(v != HIVE_NULL, v).alias(c) for v, c in zip(values, partition_by)], F.col("partition").alias("_folder"))


def remove_partitions(spark: SparkSession, root: str, values: DataFrame) -> int:
    """Delete the folders of the given partition values below ``root``; returns how many. Their names go through the driver one by one."""
    columns = [c for c in values.columns if c != "_folder"]
    if "_folder" not in values.columns:
        if values.isEmpty():
            return 0
        listed = partition_values(spark, root, columns)
        other = values.select(*[F.col(c).cast("string").alias(f"_v_{c}") for c in columns])
        values = listed.join(other, [F.col(c).eqNullSafe(F.col(f"_v_{c}")) for c in columns], "left_semi")
    return sum(storage.delete(spark, f"{root.rstrip('/')}/{r._folder}") for r in values.select("_folder").toLocalIterator())


def lakehouse_format(spark: SparkSession) -> str:
    """``iceberg`` when an Iceberg catalog is configured, else Parquet."""
    for key in ("spark.sql.catalog.spark_catalog", "spark.sql.catalog.system"):
        if "iceberg" in spark.conf.get(key, "").lower():
            return "iceberg"
    return "parquet"


# Names that a table has while it is being replaced.
NEXT, LAST = "__next", "__last"


def replace_table(df: DataFrame, table: str, partition_by: Sequence[str] = (), fmt: str | None = None) -> None:
    """Replace a catalog table with a DataFrame that may read that very table.

    The new rows are written once, as a table beside the old one; then the two change names. A run that is lost before
    leaves the old table, one that is lost between leaves one or the other whole under a name of its own, and
    :func:`finish_replacement`, which the next replacement calls first, puts it in place.
    """
    spark = df.sparkSession
    fmt = fmt or lakehouse_format(spark)
    finish_replacement(spark, table)
    database, name = table.split(".") if "." in table else (spark.catalog.currentDatabase(), table)
    home = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    writer = _writer(without_ntz(df), fmt, "overwrite", partition_by)
    if fmt != "iceberg":  # a place of its own: files, and places of partitions, stay where they are when names change
        writer = writer.option("path", f"{home}/{name}-{uuid.uuid4().hex}")
    writer.saveAsTable(table + NEXT)
    swap_tables(spark, table)


def swap_tables(spark: SparkSession, table: str) -> None:
    """Let the table written beside ``table`` take its name."""
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} RENAME TO {table}{LAST}")
    spark.sql(f"ALTER TABLE {table}{NEXT} RENAME TO {table}")
    _drop_replaced(spark, table, LAST)


def _drop_replaced(spark: SparkSession, table: str, suffix: str) -> None:
    """Drop a table that was replaced or never came into use, with files that a replacement has written; files of others stay."""
    if not spark.catalog.tableExists(table + suffix):
        return
    described = spark.sql(f"DESCRIBE FORMATTED {table}{suffix}").where("col_name = 'Location'").collect()
    location = described[0].data_type if described else ""
    spark.sql(f"DROP TABLE IF EXISTS {table}{suffix}")
    if re.search(rf"/{re.escape(table.split('.')[-1])}-[0-9a-f]{{32}}$", location.rstrip("/")):
        storage.delete(spark, location)


def finish_replacement(spark: SparkSession, table: str) -> None:
    """Bring a replacement that was lost on the way to its end: forward once the old table has given up its name, else back.

    The old table gives up its name only after the new one is whole, so what is found tells how far the run came.
    """
    there, before, after = (spark.catalog.tableExists(table + s) for s in ("", LAST, NEXT))
    if there:
        _drop_replaced(spark, table, NEXT)
        _drop_replaced(spark, table, LAST)
    elif before and after:
        swap_tables(spark, table)
    elif before:
        spark.sql(f"ALTER TABLE {table}{LAST} RENAME TO {table}")


def convert_table(
    spark: SparkSession, source: str, dest: str | None = None, partition_by: Sequence[str] = (), fmt: str | None = None
) -> str:
    """Convert a table's format and return the resulting table name.

    With ``dest`` the source stays and a converted copy is made (again from scratch on a rerun);
    without it the table is converted in place. On an Iceberg catalog its own procedures do this
    without copying data.
    """
    fmt = fmt or lakehouse_format(spark)
    if dest is None:
        if fmt == "iceberg":
            spark.sql(f"CALL spark_catalog.system.migrate('{source}')")
        else:
            finish_replacement(spark, source)
            replace_table(spark.table(source), source, partition_by, fmt)
        return source
    spark.sql(f"DROP TABLE IF EXISTS {dest}")
    if fmt == "iceberg":
        spark.sql(f"CALL spark_catalog.system.snapshot('{source}', '{dest}')")
    else:
        w = without_ntz(spark.table(source)).write.format(fmt).mode("overwrite")
        (w.partitionBy(*partition_by) if partition_by else w).saveAsTable(dest)
    return dest
