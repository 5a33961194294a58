"""File-manifest operators: summaries, copy plans, copy figures, presence.

A manifest is a DataFrame of (root, rel_path, length, modified), one row per file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshift.functions import measures as M


def content_summary(manifest: DataFrame, keys: Sequence[str] = ("root",)) -> DataFrame:
    """File count and total bytes per key."""
    return manifest.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("file_count"), F.coalesce(F.sum("length"), F.lit(0)).alias("size_bytes")
    )


def filtered_content(files: DataFrame, parts: DataFrame, keys: Sequence[str], part: str = "partition") -> DataFrame:
    """File count and bytes per table over the listed partitions only."""
    wanted = parts.select(*keys, part).distinct()
    return content_summary(files.join(wanted, [*keys, part], "left_semi"), keys)


def copy_plan(source: DataFrame, dest: DataFrame, keys: Sequence[str] = ("rel_path",)) -> DataFrame:
    """Every file on either side, classed NEW, CHANGED, SAME or EXTRA by path and size.

    The two manifests are stacked and grouped once, so there is a single shuffle.
    """
    sides = source.select(*keys, F.col("length").alias("source_length"), F.lit(None).cast("bigint").alias("dest_length"))
    sides = sides.unionByName(
        dest.select(*keys, F.lit(None).cast("bigint").alias("source_length"), F.col("length").alias("dest_length"))
    )
    paired = sides.groupBy(*keys).agg(
        F.max("source_length").alias("source_length"), F.max("dest_length").alias("dest_length")
    )
    return paired.withColumn(
        "action",
        F.when(F.col("dest_length").isNull(), "NEW")
        .when(F.col("source_length").isNull(), "EXTRA")
        .when(F.col("source_length") != F.col("dest_length"), "CHANGED")
        .otherwise("SAME"),
    )


def planned_result(plan: DataFrame, mode: str = "mirror") -> DataFrame:
    """Destination manifest after the copy: ``mirror`` deletes extra files, ``additive`` keeps them."""
    if mode not in ("mirror", "additive"):
        raise ValueError(f"unknown copy mode: {mode}")
    kept = plan.where(F.col("action") != "EXTRA") if mode == "mirror" else plan
    keys = [c for c in plan.columns if c not in ("source_length", "dest_length", "action")]
    return kept.select(*keys, F.coalesce("source_length", "dest_length").alias("length"))


def copy_delta(before: DataFrame, after: DataFrame, keys: Sequence[str], clamp: bool = False) -> DataFrame:
    """Growth of the destination per key; a destination that existed makes the copy incremental."""
    def side(df: DataFrame, tag: str) -> list:
        tags = ("before", "after")
        cols = []
        for t in tags:
            for figure in ("file_count", "size_bytes"):
                cols.append((F.col(figure) if t == tag else F.lit(0).cast("bigint")).alias(f"{figure}_{t}"))
        return cols

    stacked = before.select(*keys, *side(before, "before"), F.lit(True).alias("existed")).unionByName(
        after.select(*keys, *side(after, "after"), F.lit(False).alias("existed"))
    )
    total = stacked.groupBy(*keys).agg(
        *[F.sum(f"{f}_{t}").alias(f"{f}_{t}") for t in ("before", "after") for f in ("file_count", "size_bytes")],
        F.bool_or("existed").alias("is_incremental"),
    )
    return total.withColumn("files_copied", M.growth("file_count_before", "file_count_after", clamp)).withColumn(
        "bytes_copied", M.growth("size_bytes_before", "size_bytes_after", clamp)
    )


def data_presence(inventory: DataFrame, summary: DataFrame, path: str = "dest_path", root: str = "root") -> DataFrame:
    """CONFIRMED when files are there, MISSING when the path is unknown, absent or empty, FAILED
    when the listing itself carries an ``error``."""
    found = summary.select(
        F.col(root).alias("_root"),
        F.col("file_count").alias("_files"),
        F.col("size_bytes").alias("_bytes"),
        (F.col("error") if "error" in summary.columns else F.lit(None).cast("string")).alias("_error"),
    )
    joined = inventory.join(found, F.col(path) == F.col("_root"), "left")
    no_path = F.coalesce(F.col(path), F.lit("")) == ""
    status = (
        F.when(no_path, "MISSING")
        .when(F.col("_error").isNotNull(), "FAILED")
        .when(F.col("_root").isNull() | (F.col("_files") == 0), "MISSING")
        .otherwise("CONFIRMED")
    )
    message = (
        F.when(no_path, "no destination path computed")
        .when(F.col("_error").isNotNull(), F.col("_error"))
        .when(F.col("_root").isNull(), F.concat(F.lit("destination path does not exist: "), F.col(path)))
        .when(F.col("_files") == 0, F.concat(F.lit("destination path holds no files: "), F.col(path)))
    )
    confirmed = status == "CONFIRMED"
    return joined.select(
        *inventory.columns,
        status.alias("status"),
        F.when(confirmed, F.col("_files")).otherwise(F.lit(0)).cast("bigint").alias("file_count"),
        F.when(confirmed, F.col("_bytes")).otherwise(F.lit(0)).cast("bigint").alias("size_bytes"),
        message.alias("error"),
    )


def folder_verify(copies: DataFrame, summary: DataFrame, path: str = "dest_path", root: str = "root") -> DataFrame:
    """Folder validation: the destination exists, file counts are equal and sizes agree."""
    found = summary.select(
        F.col(root).alias("_root"), F.col("file_count").alias("_files"), F.col("size_bytes").alias("_bytes")
    )
    joined = copies.join(found, F.col(path) == F.col("_root"), "left")
    files, size = F.coalesce("_files", F.lit(0)), F.coalesce("_bytes", F.lit(0))
    source_files, source_size = M.zero("source_file_count"), M.zero("source_size_bytes")
    skipped = F.col("status") == "FAILED"
    count_ok, size_ok = files == source_files, M.size_match_abs(source_size, size)
    valid = F.col("_root").isNotNull() & count_ok & size_ok
    kept = [c for c in copies.columns]
    return joined.select(
        *kept,
        F.when(skipped, F.lit(None)).otherwise(files).cast("bigint").alias("dest_file_count"),
        F.when(skipped, F.lit(None)).otherwise(size).cast("bigint").alias("dest_size_bytes"),
        F.when(~skipped, count_ok).alias("file_count_match"),
        F.when(~skipped, size_ok).alias("size_match"),
        F.when(skipped, "VALIDATION_SKIPPED")
        .when(valid, "VALIDATED")
        .otherwise("VALIDATION_FAILED")
        .alias("validation_status"),
        F.when(~skipped & F.col("_root").isNull(), F.lit("destination does not exist after copy")).alias(
            "validation_error"
        ),
    )
