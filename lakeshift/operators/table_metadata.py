"""Operators on Iceberg ``metadata.json`` documents held in a DataFrame column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshift.functions.cells import col

METADATA_SCHEMA = """
`current-schema-id` int,
schemas array<struct<`schema-id`:int, fields:array<struct<id:int, name:string, required:boolean, type:string>>>>,
`default-spec-id` int,
`partition-specs` array<struct<`spec-id`:int,
  fields:array<struct<`source-id`:int, `field-id`:int, name:string, transform:string>>>>,
`current-snapshot-id` bigint,
snapshots array<struct<`snapshot-id`:bigint, `timestamp-ms`:bigint, summary:map<string,string>, `manifest-list`:string>>,
properties map<string,string>
"""

# Iceberg primitive type -> Spark SQL type; anything else becomes STRING.
TYPE_MAP = {
    "boolean": "BOOLEAN",
    "int": "INT",
    "long": "BIGINT",
    "float": "FLOAT",
    "double": "DOUBLE",
    "date": "DATE",
    "time": "STRING",
    "timestamp": "TIMESTAMP",
    "timestamptz": "TIMESTAMP",
    "string": "STRING",
    "binary": "BINARY",
    "uuid": "STRING",
}


def parse_metadata(c: Column | str) -> Column:
    """JSON text -> struct. Nested field types arrive as JSON text and map to STRING."""
    return F.from_json(col(c), METADATA_SCHEMA)


def spark_type(c: Column) -> Column:
    t = F.lower(c)
    known = F.create_map(*[F.lit(x) for pair in TYPE_MAP.items() for x in pair])
    return F.coalesce(
        F.try_element_at(known, t),
        F.when(t.startswith("decimal"), F.upper(t)).when(t.startswith("fixed"), "BINARY").otherwise("STRING"),
    )


def _by_id(items: Column, field: str, wanted: Column) -> Column:
    """First element with the wanted id, else the last element, else null."""
    found = F.filter(items, lambda x: x[field] == F.coalesce(wanted, F.lit(0)))
    return F.coalesce(F.get(found, F.lit(0)), F.try_element_at(items, F.lit(-1)))


def current_schema(meta: Column) -> Column:
    return _by_id(meta["schemas"], "schema-id", meta["current-schema-id"])


def schema_fields(meta: Column) -> Column:
    """Array of (name, type) with Spark types; empty when the document has no schema."""
    fields = F.transform(
        current_schema(meta)["fields"], lambda f: F.struct(f["name"].alias("name"), spark_type(f["type"]).alias("type"))
    )
    return F.coalesce(fields, F.array().cast("array<struct<name:string,type:string>>"))


def partition_columns(meta: Column) -> Column:
    """Names behind the default partition spec; ``field_<id>`` when a source id is unknown."""
    spec = _by_id(meta["partition-specs"], "spec-id", meta["default-spec-id"])
    fields = current_schema(meta)["fields"]

    def name(p: Column) -> Column:
        hit = F.filter(fields, lambda f: f["id"] == p["source-id"])
        return F.coalesce(
            F.try_element_at(hit, F.lit(-1))["name"], F.concat(F.lit("field_"), p["source-id"].cast("string"))
        )

    return F.coalesce(F.transform(spec["fields"], name), F.array().cast("array<string>"))


def row_count(meta: Column) -> Column:
    """``total-records`` of the current snapshot; zero without one."""
    snap = F.get(
        F.filter(meta["snapshots"], lambda s: s["snapshot-id"] == meta["current-snapshot-id"]), F.lit(0)
    )
    return F.coalesce(F.try_element_at(snap["summary"], F.lit("total-records")).cast("bigint"), F.lit(0).cast("bigint"))


def metadata_version(name: Column | str) -> Column:
    """Leading number of a metadata file name (``v12.metadata.json``, ``00012-<id>.metadata.json``)."""
    return F.regexp_extract(col(name), r"^v?([0-9]+)", 1).try_cast("bigint")


def latest_metadata(files: DataFrame, hints: DataFrame | None = None, key: str = "table_path") -> DataFrame:
    """Current metadata file per table: the hinted version, else the highest version.

    ``files`` is (key, file_name), ``hints`` (key, version). Versions compare as numbers, so v10
    follows v9; a name without a number sorts first.
    """
    named = files.where(F.col("file_name").endswith(".metadata.json"))
    best = named.groupBy(key).agg(
        F.max(F.struct(F.coalesce(metadata_version("file_name"), F.lit(-1)).alias("version"), "file_name"))
        .getField("file_name")
        .alias("file_name")
    )
    if hints is None:
        return best
    hinted = hints.select(key, F.concat(F.lit("v"), F.trim("version"), F.lit(".metadata.json")).alias("_hinted"))
    return best.join(hinted, key, "full_outer").select(key, F.coalesce("_hinted", "file_name").alias("file_name"))


def table_facts(documents: DataFrame, metadata: str = "metadata") -> DataFrame:
    """Inventory facts read from metadata alone: schema, partition columns, rows."""
    meta = parse_metadata(metadata)
    parsed = documents.withColumn("_meta", meta)
    m = F.col("_meta")
    return parsed.select(
        *[c for c in documents.columns if c != metadata],
        schema_fields(m).alias("schema_fields"),
        partition_columns(m).alias("partition_columns"),
        (F.size(partition_columns(m)) > 0).alias("is_partitioned"),
        row_count(m).alias("row_count"),
    )
