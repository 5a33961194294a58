"""Source / destination reconciliation: counts, schemas, match flags and verdicts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table_counts(parts: DataFrame, keys: Sequence[str], matched: Column | None = None) -> DataFrame:
    """Rows in all and rows of matched partitions per table, from :func:`partition_metrics`.

    The filter is tested once per partition, not once per row.
    """
    hit = F.lit(True) if matched is None else matched
    return parts.groupBy(*keys).agg(
        F.sum("row_count").alias("row_count"),
        F.coalesce(F.sum(F.when(hit, F.col("row_count"))), F.lit(0)).alias("filtered_row_count"),
    )


def inventory_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every table as one job: aggregates are per table, then stacked."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def partition_metrics(df: DataFrame, part: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Row count per partition."""
    return df.groupBy(*keys, part.alias("partition")).agg(F.count(F.lit(1)).alias("row_count"))


def reconcile_partitions(source: DataFrame, dest: DataFrame, keys: Sequence[str] = ("partition",)) -> DataFrame:
    """Source and destination row counts side by side per key, with a match flag.

    Inputs are (keys, row_count); stacking and grouping costs one shuffle of already-counted rows.
    """
    stacked = source.select(
        *keys, F.col("row_count").alias("s"), F.lit(0).cast("bigint").alias("d"), F.lit(1).alias("in_s"), F.lit(0).alias("in_d")
    ).unionByName(
        dest.select(
            *keys, F.lit(0).cast("bigint").alias("s"), F.col("row_count").alias("d"), F.lit(0).alias("in_s"), F.lit(1).alias("in_d")
        )
    )
    return (
        stacked.groupBy(*keys)
        .agg(
            F.sum("s").alias("source_row_count"),
            F.sum("d").alias("dest_row_count"),
            F.max("in_s").cast("boolean").alias("in_source"),
            F.max("in_d").cast("boolean").alias("in_dest"),
        )
        .withColumn("row_count_match", F.col("source_row_count") == F.col("dest_row_count"))
    )


def schema_rows(schema: T.StructType) -> list[tuple[str, str, int]]:
    return [(f.name, f.dataType.simpleString(), i) for i, f in enumerate(schema.fields)]


def schema_frame(spark, schemas: Mapping[str, T.StructType]) -> DataFrame:
    """(table_name, column_name, data_type, ordinal) rows of known schemas (metadata only)."""
    rows = [(name, c, t, i) for name, s in schemas.items() for c, t, i in schema_rows(s)]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, ordinal int")


def schema_diff(
    source: DataFrame, dest: DataFrame, keys: Sequence[str] = ("table_name",), case_sensitive: bool = True
) -> DataFrame:
    """One row per differing column: MISSING, TYPE or EXTRA, with both types.

    Inputs are (keys, column_name, data_type); names and types fold case when not case-sensitive.
    """
    def fold(c: str) -> Column:
        return F.col(c) if case_sensitive else F.lower(c)

    def side(df: DataFrame, s: Column, d: Column) -> DataFrame:
        return df.select(*keys, fold("column_name").alias("column_name"), s.alias("source_type"), d.alias("dest_type"))

    none = F.lit(None).cast("string")
    both = side(source, fold("data_type"), none).unionByName(side(dest, none, fold("data_type")))
    paired = both.groupBy(*keys, "column_name").agg(
        F.max("source_type").alias("source_type"), F.max("dest_type").alias("dest_type")
    )
    kind = (
        F.when(F.col("dest_type").isNull(), "MISSING")
        .when(F.col("source_type").isNull(), "EXTRA")
        .when(F.col("source_type") != F.col("dest_type"), "TYPE")
    )
    message = (
        F.when(F.col("difference") == "MISSING", F.concat(F.lit("Missing column: "), F.col("column_name")))
        .when(F.col("difference") == "EXTRA", F.concat(F.lit("Extra column in dest: "), F.col("column_name")))
        .otherwise(
            F.concat(
                F.lit("Type mismatch for "), F.col("column_name"), F.lit(": "),
                F.col("source_type"), F.lit(" vs "), F.col("dest_type"),
            )
        )
    )
    return paired.withColumn("difference", kind).where(F.col("difference").isNotNull()).withColumn("message", message)


def schema_verdict(diff: DataFrame, keys: Sequence[str] = ("table_name",)) -> DataFrame:
    """Differences of a table as one text; a table has few columns, so the list is short."""
    rank = F.when(F.col("difference") == "EXTRA", 1).otherwise(0)
    return diff.groupBy(*keys).agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct(rank.alias("r"), "column_name", "message"))), lambda x: x["message"]
        ).alias("schema_messages")
    )


def with_schema_verdict(tables: DataFrame, schema_differences: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``schema_match`` and ``schema_differences`` of each table, from :func:`schema_verdict`."""
    messages = F.coalesce("schema_messages", F.array().cast("array<string>"))
    return (
        tables.join(schema_differences, list(keys), "left")
        .withColumns({"schema_match": F.size(messages) == 0, "schema_differences": F.array_join(messages, "; ")})
        .drop("schema_messages")
    )


def reconcile_tables(
    source: DataFrame, dest: DataFrame, schema_differences: DataFrame | None = None, keys: Sequence[str] = ("table_name",)
) -> DataFrame:
    """Row, partition and schema verdict per table.

    ``source`` / ``dest`` are (keys, row_count, partition_count) and ``schema_differences`` comes
    from :func:`schema_verdict`. A table absent on one side counts as zero there.
    """
    z = F.lit(0).cast("bigint")
    stacked = source.select(
        *keys, F.col("row_count").alias("sr"), F.col("partition_count").alias("sp"), z.alias("dr"), z.alias("dp")
    ).unionByName(
        dest.select(*keys, z.alias("sr"), z.alias("sp"), F.col("row_count").alias("dr"), F.col("partition_count").alias("dp"))
    )
    out = stacked.groupBy(*keys).agg(
        F.sum("sr").alias("source_row_count"),
        F.sum("dr").alias("dest_row_count"),
        F.sum("sp").alias("source_partition_count"),
        F.sum("dp").alias("dest_partition_count"),
    )
    if schema_differences is None:
        out = out.withColumn("schema_messages", F.lit(None).cast("array<string>"))
    else:
        out = out.join(schema_differences, list(keys), "left")
    return with_verdict(out)


def with_verdict(df: DataFrame) -> DataFrame:
    """Match flags and the mismatch message from counts and ``schema_messages``."""
    row_ok = F.col("source_row_count") == F.col("dest_row_count")
    part_ok = F.col("source_partition_count") == F.col("dest_partition_count")
    schema_ok = F.coalesce(F.size("schema_messages"), F.lit(0)) <= 0
    return df.select(
        *[c for c in df.columns if c != "schema_messages"],
        row_ok.alias("row_count_match"),
        part_ok.alias("partition_count_match"),
        schema_ok.alias("schema_match"),
        F.coalesce(F.array_join("schema_messages", "; "), F.lit("")).alias("schema_differences"),
        F.nullif(
            F.concat_ws(
                "; ",
                F.when(~row_ok, _mismatch("Row", "source_row_count", "dest_row_count")),
                F.when(~part_ok, _mismatch("Partition", "source_partition_count", "dest_partition_count")),
                F.when(
                    ~schema_ok,
                    F.concat(
                        F.lit("Schema differences: "),
                        F.array_join("schema_messages", "; "),
                    ),
                ),
            ),
            F.lit(""),
        ).alias("error"),
    )


def _mismatch(what: str, source: str, dest: str) -> Column:
    return F.concat(
        F.lit(f"{what} count mismatch: source="), F.col(source).cast("string"), F.lit(", dest="), F.col(dest).cast("string")
    )


def validation_status(
    variant: str,
    row_ok: str = "row_count_match",
    part_ok: str = "partition_count_match",
    schema_ok: str = "schema_match",
) -> Column:
    """Final state of a validated table.

    * copy: rows or partitions off is only a warning, a schema difference alone is a failure
    * convert: an unknown partition flag counts as fine
    * metadata: everything must match
    """
    r, s = F.coalesce(F.col(row_ok), F.lit(False)), F.coalesce(F.col(schema_ok), F.lit(False))
    p = F.coalesce(F.col(part_ok), F.lit(variant == "convert"))
    good = F.when(r & p & s, "VALIDATED")
    if variant == "copy":
        warned = ~F.coalesce(F.col(row_ok), F.lit(True)) | ~F.coalesce(F.col(part_ok), F.lit(True))
        return good.when(warned, "VALIDATED_WITH_WARNINGS").otherwise("VALIDATION_FAILED")
    if variant in ("convert", "metadata"):
        return good.otherwise("VALIDATION_FAILED")
    raise ValueError(f"unknown validation variant: {variant}")
