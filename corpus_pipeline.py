"""From raw documents to training shards: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshift.llm import decontaminate, mixing, ngram_join, quality, sharding
from lakeshift.llm.common import kept, table, unused, word_count
from lakeshift.sources.scratch import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _print() -> Column:
    """What tells rows of equal id apart."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. Null and empty texts are scored like others."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.score(model)("text") >= quality.ACCEPT)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked at 0.8 on five-word shingles.

    Of rows that repeat an id and a text one stays; different texts of one id are judged each by itself,
    and those of a group's smallest id all stay. Rows without an id stay.
    """
    groups = ngram_join.linked(docs.select("doc_id", "text"), n=5, num=80, den=100, prints=True)
    gone, of, again = unused(docs, "_gone", "_of", "_again")
    go = kept(groups.where("doc_id <> component_id").select(F.col("doc_id").alias(gone), F.col("print").alias(of)).distinct())
    left = docs.join(go, (F.col("doc_id") == F.col(gone)) & (_print() == F.col(of)), "left_anti")
    first = F.row_number().over(Window.partitionBy("doc_id", _print()).orderBy(F.lit(0))) == 1
    return left.withColumn(again, first).where(F.col(again) | F.col("doc_id").isNull()).drop(again)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window. Rows of equal id share their fate."""
    hits = decontaminate.hits(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    (hit,) = unused(docs, "_hit")
    found = kept(hits.where("n_hit > 0").select(F.col("doc_id").alias(hit)).distinct())
    return docs.join(found, F.col("doc_id").eqNullSafe(F.col(hit)), "left_anti")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the mix takes; those not taken go. Rows that agree in id, text and source are counted as copies of one.

    Rows meet their numbers of copies by two hashes of id, source and text, 96 bits in all and never null; the same
    exchange of texts serves to tell the first of equal rows.
    """
    hashes = F.xxhash64("doc_id", "source", "text"), F.hash(F.lit("mix"), "text", "source", "doc_id")
    rows = docs.select("doc_id", "source", word_count("text").alias("size"), hashes[0].alias("a"), hashes[1].alias("b"))
    one_a, one_b, copies, first = unused(docs, "_a", "_b", "_copies", "_first")
    taken = mixing.systematic(rows).groupBy("a", "b").agg(F.sum("copies").alias(copies)).where(F.col(copies) > 0)
    taken = taken.withColumnsRenamed({"a": one_a, "b": one_b})
    out = docs.withColumns({one_a: hashes[0], one_b: hashes[1]}).join(taken, [one_a, one_b])
    number = F.row_number().over(Window.partitionBy(one_a, one_b).orderBy(F.lit(0)))
    out = out.withColumn(first, number).where(F.col(first) == 1)
    return out.withColumn(first, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))).select(*docs.columns)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, size, shard, slot: 40 shards that each hold the sources in their overall proportions."""
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long")
    return sharding.interleave(docs.select("doc_id", "source", size.alias("size")), 40, seed=4)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good),
    ("n-gram Jaccard join", distinct),
    ("benchmark decontamination", clean),
    ("mixing sources to target weights", mixed),
    ("sharding", shards),
]

#: A trained classifier and near-duplicate components are beyond SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return stored(STAGES[-1][1](spark, docs, sf_dir), "pipeline-sharding")
