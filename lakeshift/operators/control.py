"""Control-sheet operators: header, parsing, grouping, endpoints, token resolution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshift.functions import cells as C
from lakeshift.operators.windows import distinct_first, segments


def normalize_header(df: DataFrame, underscore: bool = True) -> DataFrame:
    """Header cells stripped and lower-cased; blanks become ``_`` unless asked otherwise."""
    def clean(name: str) -> str:
        name = name.strip().lower()
        return name.replace(" ", "_") if underscore else name

    return df.toDF(*[clean(c) for c in df.columns])


def parse_copy_control(df: DataFrame, default_bucket: str) -> DataFrame:
    """Table-copy sheet: defaults filled, rows without a database dropped."""
    database = C.cell_str("database")
    return df.where(~C.null_like("database")).select(
        "row_index",
        database.alias("source_database"),
        C.cell_str("table", "*").alias("table_cell"),
        C.cell_str("dest_database", database).alias("dest_database"),
        C.normalize_s3(C.cell_str("bucket", default_bucket)).alias("dest_bucket"),
        C.cell_str("endpoint", "").alias("dest_endpoint"),
        C.cell_str("partition_filter").alias("partition_filter"),
    )


def parse_conversion_control(df: DataFrame) -> DataFrame:
    """Conversion sheet: in-place flag and destination database resolved."""
    inplace = C.parse_flag("inplace_migration")
    return df.where(~C.null_like("database")).select(
        "row_index",
        C.cell_str("database").alias("source_database"),
        C.cell_str("table", "*").alias("table_cell"),
        inplace.alias("inplace"),
        C.conversion_database("database", "destination_iceberg_database", inplace).alias("dest_database"),
    )


def parse_folder_control(df: DataFrame) -> DataFrame:
    """Folder-copy sheet: the folder name defaults to the last path part; incomplete rows drop."""
    return df.where(~C.null_like("source_path") & ~C.null_like("target_bucket")).select(
        "row_index",
        C.cell_str("source_path").alias("source_path"),
        F.rtrim(C.normalize_s3(C.cell_str("target_bucket")), F.lit("/")).alias("dest_bucket"),
        C.cell_str("dest_folder", C.basename("source_path")).alias("dest_folder"),
        C.cell_str("endpoint", "").alias("dest_endpoint"),
    )


def parse_metadata_control(df: DataFrame, default_bucket: str) -> DataFrame:
    """Metadata-migration sheet; prefixes and paths carry the s3a scheme."""
    database = C.cell_str("database")
    return df.where(~C.null_like("database")).select(
        "row_index",
        database.alias("source_database"),
        C.cell_str("table", "*").alias("table_cell"),
        C.cell_str("dest_database", database).alias("dest_database"),
        C.normalize_s3(C.cell_str("dest_bucket", default_bucket)).alias("dest_bucket"),
        C.normalize_s3(C.cell_str("source_s3_prefix", "")).alias("source_s3_prefix"),
        C.normalize_s3(C.cell_str("dest_s3_prefix", "")).alias("dest_s3_prefix"),
        F.rtrim(C.normalize_s3(C.cell_str("source_table_path", "")), F.lit("/")).alias("source_table_path"),
    )


def control_tokens(df: DataFrame, keys: Sequence[str], cell: str = "table_cell", order: str = "row_index") -> DataFrame:
    """One row per (group, token), first seen first; a group with ``*`` keeps only ``*``.

    Duplicates are removed by an aggregate on (group, token) before anything is brought
    together per group, so a group repeated over millions of rows stays spread out. Which groups
    hold a ``*`` is an aggregate over the cells themselves.
    """
    cells = df.select(*keys, F.col(order).alias("_row"), C.csv_array(cell).alias("_tokens"))
    exploded = cells.select(*keys, "_row", F.posexplode("_tokens").alias("_pos", "token"))
    first = exploded.groupBy(*keys, "token").agg(F.min(F.struct("_row", "_pos")).alias("position"))
    starred = (
        df.where(F.col(cell).contains("*"))
        .select(*keys, F.array_contains(C.csv_array(cell), "*").alias("_star"))
        .where("_star")
        .distinct()
    )
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    return (
        first.alias("a")
        .join(starred.alias("b"), same, "left")
        .where(F.col("_star").isNull() | (F.col("token") == "*"))
        .select(*[F.col(f"a.{k}").alias(k) for k in keys], "token", "position")
    )


def group_control(df: DataFrame, keys: Sequence[str], cell: str = "table_cell", order: str = "row_index") -> DataFrame:
    """One row per group with its ordered, distinct tokens."""
    tokens = control_tokens(df, keys, cell, order)
    return tokens.groupBy(*keys).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("position", "token"))), lambda x: x["token"]).alias(
            "table_tokens"
        )
    )


def control_segments(df: DataFrame, keys: Sequence[str], cell: str = "table_cell", order: str = "row_index") -> DataFrame:
    """(group keys, segment, values): ordered, distinct tokens in segments, for groups that name any number of tables."""
    return segments(control_tokens(df, keys, cell, order), keys, "token", "position")


def control_entries(df: DataFrame, keys: Sequence[str], order: str = "row_index") -> DataFrame:
    """(group keys, sheet position, table, path) rows; rows without a table or path drop.

    Entries repeat as the sheet repeats them, so a group has no size bound: it stays flat.
    """
    complete = df.where((F.col("table_cell") != "*") & (F.col("source_table_path") != ""))
    return complete.select(*keys, order, F.col("table_cell").alias("table_name"), "source_table_path")


def distinct_endpoints(df: DataFrame, bucket: str = "dest_bucket", endpoint: str = "dest_endpoint") -> DataFrame:
    """Distinct (bucket, endpoint) pairs that need their own access check."""
    pairs = df.select(C.strip(bucket).alias("bucket"), C.strip(endpoint).alias("endpoint")).distinct()
    return pairs.select(
        "bucket",
        "endpoint",
        C.bucket_name("bucket").alias("bucket_name"),
        C.endpoint_slug("endpoint").alias("endpoint_slug"),
    )


def like_pattern(token: Column) -> Column:
    """Catalog pattern (``*`` any text, ``|`` alternatives) -> anchored, case-blind regex; all else stands for itself."""
    parts = F.transform(F.split(token, r"\|"), lambda p: F.regexp_replace(F.btrim(p), r"([^\w*])", r"\\$1"))
    return F.concat(F.lit("(?i)^(?:"), F.replace(F.array_join(parts, "|"), F.lit("*"), F.lit(".*")), F.lit(")$"))


# What a shell pattern is made of: a set in brackets, whose first character may be a closing bracket, or one character.
GLOB_PART = r"(?s)\[!?+\]?+[^\]]*+\]|."
NEVER = "(?!)"


def _code(c: Column) -> Column:
    return F.concat(F.lit(r"\x{"), F.lower(F.hex(F.ascii(c))), F.lit("}"))


def glob_set(part: Column) -> Column:
    """``[..]`` or ``[!..]`` -> regex. A reversed range stands for no character; a set of none matches nothing, its negation anything."""
    negated = part.startswith("[!")
    body = F.substr(part, F.when(negated, 3).otherwise(2), F.length(part) - F.when(negated, 3).otherwise(2))
    ranges = F.transform(
        F.regexp_extract_all(body, F.lit("(?s).-.|."), F.lit(0)), lambda r: F.struct(F.substr(r, F.lit(1), F.lit(1)).alias("low"), F.substr(r, F.length(r), F.lit(1)).alias("high"))
    )
    real = F.filter(ranges, lambda r: F.ascii(r["low"]) <= F.ascii(r["high"]))
    members = F.array_join(F.transform(real, lambda r: F.concat(_code(r["low"]), F.lit("-"), _code(r["high"]))), "")
    return (
        F.when((members == "") & negated, F.lit("."))
        .when(members == "", F.lit(NEVER))
        .otherwise(F.concat(F.when(negated, F.lit("[^")).otherwise(F.lit("[")), members, F.lit("]")))
    )


def glob_pattern(token: Column) -> Column:
    """Shell pattern (``*``, ``?``, ``[..]``, ``[!..]``) -> anchored regex; a bracket that nothing closes stands for itself."""
    parts = F.regexp_extract_all(token, F.lit(GLOB_PART), F.lit(0))
    text = F.transform(
        parts,
        lambda p: F.when(p == "*", F.lit(".*")).when(p == "?", F.lit(".")).when(F.length(p) > 1, glob_set(p)).otherwise(F.regexp_replace(p, r"([^\w])", r"\\$1")),
    )
    return F.concat(F.lit("(?s)^"), F.array_join(text, ""), F.lit("$"))


PATTERNS_PER_LIST = 500


def _pattern_lists(patterns: DataFrame, keys: list[str], entry: Column) -> DataFrame:
    """Patterns gathered into lists of about ``PATTERNS_PER_LIST``; a database may own several."""
    sizes = patterns.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / F.lit(PATTERNS_PER_LIST)).alias("_lists"))
    return (
        patterns.join(sizes, keys)
        .groupBy(*keys, F.pmod(F.xxhash64("regex", "position"), F.col("_lists")).alias("_list"))
        .agg(F.collect_list(entry).alias("_patterns"))
        .drop("_list")
    )


def resolve_tokens(
    tokens: DataFrame,
    tables: DataFrame,
    keys: Sequence[str] = ("source_database",),
    groups: Sequence[str] = (),
    strict: bool = False,
) -> DataFrame:
    """Tables each control group asks for: (keys, groups, table_name, position of the first token).

    ``tokens`` has (keys, groups, token, position), ``tables`` has (keys, table_name). Plain names
    are an equi-join (or pass unchecked when not ``strict``). Wildcards are gathered into short lists
    per key and joined on it, so a table row meets a list, not every pattern, and only the pairs
    that match are emitted; AQE may split a hot database.
    """
    keys, groups = list(keys), list(groups)
    magic = r"[*?\[]" if strict else r"[*]"
    plain = tokens.where(~F.col("token").rlike(magic))
    if strict:
        known = tables.select(*keys, F.col("table_name").alias("token"))
        plain = plain.join(known, [*keys, "token"], "left_semi")
    plain = plain.select(*keys, *groups, F.col("token").alias("table_name"), "position")

    to_regex = glob_pattern if strict else like_pattern
    regex = F.when(F.col("token") == "*", F.lit("(?s)^.*$")).otherwise(to_regex(F.col("token")))
    patterns = tokens.where(F.col("token").rlike(magic)).select(*keys, *groups, "position", regex.alias("regex"))
    lists = _pattern_lists(patterns, keys, F.struct("position", "regex", *groups))
    hits = tables.join(lists, keys).select(
        *keys,
        "table_name",
        F.inline(F.filter("_patterns", lambda p: F.rlike(F.col("table_name"), p["regex"]))),
    )
    wild = hits.select(*keys, *groups, "table_name", "position")
    return distinct_first(plain.unionByName(wild), [*keys, *groups, "table_name"], "position")


def unresolved_tokens(tokens: DataFrame, tables: DataFrame, keys: Sequence[str] = ("source_database",)) -> DataFrame:
    """Audit of a strict sheet: tokens that no table of their database matches, with a reason.

    Such are names the catalog lacks, patterns that fit none of its names, and patterns that can fit no name at all,
    like a reversed range.
    """
    keys = list(keys)
    magic = F.col("token").rlike(r"[*?\[]")
    known = tables.select(*keys, F.col("table_name").alias("token")).distinct()
    plain = tokens.where(~magic).join(known, [*keys, "token"], "left_anti").withColumn("reason", F.lit("no such table"))
    patterns = tokens.where(magic).select(*keys, "token", glob_pattern(F.col("token")).alias("regex")).distinct().withColumn("position", F.lit(0))
    lists = _pattern_lists(patterns, keys, F.struct("token", "regex"))
    hits = tables.join(lists, keys).select(*keys, F.inline(F.filter("_patterns", lambda p: F.rlike(F.col("table_name"), p["regex"]))))
    missed = tokens.where(magic).join(hits.select(*keys, "token").distinct(), [*keys, "token"], "left_anti")
    return plain.unionByName(missed.withColumn("reason", F.lit("pattern matches no table")))
