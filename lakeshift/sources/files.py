"""File manifests and raw file copies."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from urllib.parse import unquote, urlparse

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK = 8 * 1024 * 1024


def file_manifest(spark: SparkSession, root: str) -> DataFrame:
    """(root, rel_path, partition, length, modified) of every visible file below ``root``.

    The binary source reads file status only, since the content column is never asked for. Names
    that start with ``_`` or ``.`` are hidden by Spark's file index, on both sides of a compare.
    """
    base = root.rstrip("/")
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(base)
        .select("path", "length", F.col("modificationTime").alias("modified"))
    )
    plain = urlparse(base).path if "://" in base or base.startswith("file:") else base
    rel = F.ltrim(
        F.substr(F.col("path"), F.instr(F.col("path"), F.lit(plain)) + F.lit(len(plain))), F.lit("/")
    )
    return listed.select(
        F.lit(base).alias("root"),
        rel.alias("rel_path"),
        F.regexp_extract(rel, r"^((?:[^/=]+=[^/]*/)*(?:[^/=]+=[^/]*))/[^/]+$", 1).alias("partition"),
        "length",
        "modified",
    )


def _opener(root: str) -> Callable[[str], tuple]:
    """Relative path -> (file system, path in it). Nested, so it reaches the workers by value."""
    opened = {}

    def open_path(rel: str) -> tuple:
        from pyarrow import fs

        if not opened:
            if "://" in root and not root.startswith("file:"):
                opened["fs"], opened["base"] = fs.FileSystem.from_uri(root.rstrip("/"))
            else:
                local = urlparse(root).path if root.startswith("file:") else root
                opened["fs"], opened["base"] = fs.LocalFileSystem(), unquote(local)
        return opened["fs"], f"{opened['base'].rstrip('/')}/{rel}"

    return open_path


def copy_files(plan: DataFrame, source_root: str, dest_root: str, tasks: int | None = None) -> DataFrame:
    """Copy the NEW and CHANGED files of a plan; returns (rel_path, bytes_copied) per file.

    One row is one file and every task streams its own files in chunks. Each file is written under
    a temporary name and moved into place, so a lost or repeated task leaves no half file behind.
    Nothing is copied until an action runs on the result.
    """
    wanted = plan.where(F.col("action").isin("NEW", "CHANGED")).select("rel_path", F.col("source_length").alias("length"))
    spread = wanted.repartition(tasks or int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions")), "rel_path")

    open_source, open_dest, chunk_bytes = _opener(source_root), _opener(dest_root), CHUNK

    def run(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for batch in batches:
            done = []
            for rel in batch["rel_path"]:
                src, src_path = open_source(rel)
                dst, dst_path = open_dest(rel)
                parent, _, name = dst_path.rpartition("/")
                dst.create_dir(parent, recursive=True)
                temporary, size = f"{parent}/.{name}.{uuid.uuid4().hex}", 0
                with src.open_input_stream(src_path) as reader, dst.open_output_stream(temporary) as writer:
                    while chunk := reader.read(chunk_bytes):
                        writer.write(chunk)
                        size += len(chunk)
                dst.move(temporary, dst_path)
                done.append((rel, size))
            yield pd.DataFrame(done, columns=["rel_path", "bytes_copied"])

    return spread.mapInPandas(run, "rel_path string, bytes_copied bigint")


def delete_extra(plan: DataFrame, dest_root: str) -> DataFrame:
    """Delete the EXTRA files of a plan (mirror copies only); returns the deleted paths."""
    extra = plan.where(F.col("action") == "EXTRA").select("rel_path")

    open_path = _opener(dest_root)

    def run(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            for rel in batch["rel_path"]:
                target, path = open_path(rel)
                if target.get_file_info(path).type != fs.FileType.NotFound:
                    target.delete_file(path)
            yield batch

    return extra.mapInPandas(run, "rel_path string")
