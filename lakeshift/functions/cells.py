"""Spreadsheet-cell, flag, path and name helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that mean "no value" in a control cell.
NULL_WORDS = ["", "nan", "null", "none"]
# Spellings of true / false in a control or configuration cell.
TRUE_CELLS = ["T", "TRUE", "YES", "1"]
TRUE_SETTINGS = ["true", "1", "yes", "y", "on"]
FALSE_SETTINGS = ["false", "0", "no", "n", "off"]


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


# The characters that Python's str.strip removes.
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))


# The same as regular expressions: a null-like cell, and what lies between parts of a comma list or around it. Neither goes back;
# common characters are told apart by the first class alone.
_W = r"[[^!-~]&&[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"
NULL_CELL = rf"^{_W}*+(?:(?i:nan|null|none))?+{_W}*+\z"
BETWEEN_PARTS = rf",{_W}*+|(?<!{_W}){_W}++(?:,{_W}*+|\z)|^{_W}++"


def strip(c: Column | str) -> Column:
    """Trim all whitespace, not only blanks, so cells pasted with tabs or newlines match."""
    return F.btrim(col(c).cast("string"), F.lit(WHITESPACE))


def null_like(c: Column | str) -> Column:
    """True for null, blank and null-word cells; never null itself."""
    c = col(c)
    return c.isNull() | c.cast("string").rlike(NULL_CELL)


def cell_str(c: Column | str, default: Column | str | None = None) -> Column:
    """Stripped text of a cell, or ``default`` (text or Column) when the cell is null-like."""
    fallback = default if isinstance(default, Column) else F.lit(default).cast("string")
    return F.when(null_like(c), fallback).otherwise(strip(c))


def parse_flag(c: Column | str) -> Column:
    """Control-sheet boolean: true spellings are true, anything else is false."""
    return F.coalesce(F.upper(strip(c)).isin(TRUE_CELLS), F.lit(False))


def parse_setting(c: Column | str, default: bool = True) -> Column:
    """Configuration boolean: known true / false spellings, otherwise ``default``."""
    v = F.lower(strip(c))
    return F.when(v.isin(TRUE_SETTINGS), True).when(v.isin(FALSE_SETTINGS), False).otherwise(default)


def csv_array(c: Column | str) -> Column:
    """Comma list -> trimmed, non-empty parts in order; empty array for a null-like cell."""
    # whitespace goes from the whole cell: a lambda per part would be interpreted
    bare = F.regexp_replace(col(c).cast("string"), BETWEEN_PARTS, ",")
    return F.when(null_like(c), F.array().cast("array<string>")).otherwise(F.array_remove(F.split(bare, ","), ""))


def last_of_key(entries: Column) -> Column:
    """An array of (key, value) without the entries whose key comes again later."""
    def last(known: Column) -> Column:
        later = lambda e, i: F.exists(F.slice(known, i + 2, F.size(known)), lambda x: x["key"] == e["key"])
        return F.filter(known, lambda e, i: ~later(e, i))

    # the lambdas name the list for every element: it must not be computed anew each time
    return bound(entries, last)


def clip(c: Column | str, n: int) -> Column:
    return F.substring(col(c), 1, n)


def slugify(c: Column | str, n: int | None = None) -> Column:
    """Keep letters, digits, ``_`` and ``-``; replace the rest by ``_``; cut to ``n`` where it is given."""
    slug = F.regexp_replace(col(c), "[^a-zA-Z0-9_-]", "_")
    return slug if n is None else clip(slug, n)


def normalize_s3(c: Column | str) -> Column:
    """``s3://``, ``s3n://`` and bare paths become ``s3a://``; empty stays empty."""
    c = col(c)
    return (
        F.when(c.isNull() | (c == ""), c)
        .when(c.startswith("s3a://"), c)
        .otherwise(F.concat(F.lit("s3a://"), F.regexp_replace(c, "^s3n?://", "")))
    )


def basename(c: Column | str) -> Column:
    return F.element_at(F.split(F.rtrim(strip(c), F.lit("/")), "/"), -1)


def bucket_name(c: Column | str) -> Column:
    """Host part of a bucket URL, lower case."""
    bare = F.regexp_replace(strip(c), r"^s3[an]?://", "")
    return F.lower(F.regexp_extract(bare, r"^([^/?#]*)", 1))


def endpoint_host(c: Column | str) -> Column:
    """Host of an endpoint URL; the text itself when it is no URL."""
    c = strip(c)
    host = F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(F.when(host != "", host).otherwise(c))


def endpoint_slug(c: Column | str) -> Column:
    return F.translate(F.upper(endpoint_host(c)), ".-", "__")


def dest_path(source, dest_database, table, bucket, source_prefix, dest_prefix) -> Column:
    """Swap the source prefix for the destination prefix where it applies, else bucket/db/table."""
    source, source_prefix, dest_prefix = col(source), col(source_prefix), col(dest_prefix)
    swap = (
        (F.coalesce(source_prefix, F.lit("")) != "")
        & (F.coalesce(dest_prefix, F.lit("")) != "")
        & F.coalesce(source.startswith(source_prefix), F.lit(False))
    )
    rest = F.ltrim(F.substr(source, F.length(source_prefix) + 1), F.lit("/"))
    return F.when(swap, F.concat_ws("/", F.rtrim(dest_prefix, F.lit("/")), rest)).otherwise(
        F.concat_ws("/", F.rtrim(col(bucket), F.lit("/")), col(dest_database), col(table))
    )


def conversion_database(source_db, dest_db, inplace) -> Column:
    """Destination database of a conversion: given value, else the source itself when converted
    in place, else the source with an ``_iceberg`` suffix."""
    source_db = strip(source_db)
    return F.when(
        null_like(dest_db),
        F.when(col(inplace), source_db).otherwise(F.concat(source_db, F.lit("_iceberg"))),
    ).otherwise(strip(dest_db))


def detect_format(c: Column | str) -> Column:
    """Storage format named by an input-format class; PARQUET when none is recognised."""
    v = F.lower(col(c))
    return (
        F.when(v.contains("parquet"), "PARQUET")
        .when(v.contains("orc"), "ORC")
        .when(v.contains("avro"), "AVRO")
        .when(v.contains("text"), "TEXTFILE")
        .otherwise("PARQUET")
    )


# Storage properties that describe a delimited text table.
SERDE_KEYS = ["field.delim", "escape.delim", "null.format", "field delimiter"]


def serde_properties(c: Column | str) -> Column:
    """``[k=v, k2=v2]`` storage-property text -> map of the delimited-text properties in it."""
    pairs = F.transform(
        F.filter(F.split(F.btrim(col(c), F.lit("[]")), ", "), lambda x: x.contains("=")),
        lambda x: F.struct(
            strip(F.substring_index(x, "=", 1)).alias("key"), strip(F.substr(x, F.instr(x, "=") + 1)).alias("value")
        ),
    )
    return F.map_from_entries(last_of_key(F.filter(pairs, lambda p: p["key"].isin(SERDE_KEYS))))
