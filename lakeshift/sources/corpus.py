"""Text corpora: files below a root, or any DataFrame with a path and a text column."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.rules.model import CORPUS_EXCLUDES, CORPUS_EXTENSIONS
from lakeshift.rules.rewrite import DAG_EXCLUDES


def excluded(rel_path: Column, patterns: Sequence[str]) -> Column:
    """Some directory or the file itself carries an excluded name."""
    names = [p for p in patterns if not p.startswith("*")]
    endings = [p[1:] for p in patterns if p.startswith("*")]

    def left_out(part: Column) -> Column:
        return reduce(lambda a, b: a | b, [part.endswith(e) for e in endings], part.isin(names))

    return F.exists(F.split(rel_path, "/"), left_out)


def select_corpus(
    df: DataFrame,
    path: str = "path",
    extensions: Sequence[str] = CORPUS_EXTENSIONS,
    excludes: Sequence[str] = CORPUS_EXCLUDES,
) -> DataFrame:
    """Files with a scannable extension outside excluded places."""
    p = F.col(path)
    scannable = reduce(lambda a, b: a | b, [p.endswith(e) for e in extensions])
    return df.where(scannable & ~excluded(p, excludes))


def universal_newlines(c: Column) -> Column:
    return F.regexp_replace(c, r"\r\n?", "\n")


def read_corpus(
    spark: SparkSession,
    root: str,
    extensions: Sequence[str] = CORPUS_EXTENSIONS,
    excludes: Sequence[str] = CORPUS_EXCLUDES,
) -> DataFrame:
    """(path, content) of the scannable files below ``root``, path relative to it.

    The path filter works on the file's metadata column, so left-out files are never opened.
    """
    base = root.rstrip("/")
    raw = spark.read.format("text").option("wholetext", "true").option("recursiveFileLookup", "true").load(base)
    full = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    rel = F.ltrim(F.substr(full, F.instr(full, F.lit(base)) + F.lit(len(base))), F.lit("/"))
    named = raw.select(rel.alias("path"), F.col("value"))
    return select_corpus(named, "path", extensions, excludes).select(
        "path", universal_newlines(F.col("value")).alias("content")
    )


def read_dag_corpus(spark: SparkSession, root: str) -> DataFrame:
    """Python files below ``root`` without backups and tool directories."""
    return read_corpus(spark, root, [".py"], [*DAG_EXCLUDES, "*.bak"])
