"""Exact deduplication by composable polynomial fingerprints.

A text's bytes are read as the digits of a number in base 256; its fingerprint is that number modulo
two primes. The fingerprint of a concatenation follows from those of its parts by shifting,
fp(ab) = fp(a) * 256^len(b) + fp(b), so a text is cut into chunks whose hashes are computed apart from
each other (those of huge texts on many tasks) and added up, each shifted by the bytes after it.

Texts of equal fingerprint and length are then compared chunk by chunk: of the chunks at one place of
all texts of a fingerprint, the least and the greatest must agree. Both are combined before the
shuffle, so a group of copies that holds a third of the table costs each task one row per chunk. Texts
whose fingerprints agree although they differ are told apart by their SHA-256.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.llm.common import REGISTRY, kept, table

#: Two primes below 2^60; the number 256 has a large order modulo both.
PRIMES = (1_000_000_000_000_000_003, 1_000_000_000_000_000_009)
CHUNK_BYTES = 128 << 10
#: The chunks of longer texts are dealt out over the tasks before they are hashed.
HUGE_BYTES = 8 << 20


def chunk_hash(chunk: bytes, after: int) -> tuple[int, int]:
    """The share of a chunk in its text's fingerprint, ``after`` bytes before the end."""
    number = int.from_bytes(chunk, "big")
    return tuple(number % p * pow(256, after, p) % p for p in PRIMES)


def _hash_chunks(batches):
    for b in batches:
        chunks, ends, sizes = b["chunk"], b["end"].to_pylist(), b["n_bytes"].to_pylist()
        pairs = [chunk_hash(c.as_buffer().to_pybytes(), n - e) for c, e, n in zip(chunks, ends, sizes)]
        lanes = [pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays([b["sha"], b["n_bytes"], b["at"], *lanes], ["sha", "n_bytes", "at", "h1", "h2"])


def _chunks(rows: DataFrame) -> DataFrame:
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("n_bytes") - 1, F.lit(0)), F.lit(CHUNK_BYTES).cast("long"))
    pieces = F.transform(starts, lambda i: F.struct(i.alias("at"), F.substring(F.col("data"), (i + 1).cast("int"), F.lit(CHUNK_BYTES)).alias("chunk")))
    return rows.select("sha", "n_bytes", F.explode(pieces).alias("c")).select(
        "sha", "n_bytes", "c.at", "c.chunk", (F.col("c.at") + F.octet_length("c.chunk")).alias("end")
    )


def duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", normal: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: key, keep_id, group_size, kept, text_sha256, fp1, fp2, n_bytes.

    Of rows with equal normalised texts (``normal``, by default the text itself) the one with the
    greatest key stays. Nulls: a null text is empty; a null key is less than any other. Of several rows
    with the same key and text, one counts as the row that stays. An empty table gives an empty result.
    Other columns are not looked at.
    """
    data = F.coalesce(F.col(text) if normal is None else normal, F.lit("")).cast("binary")
    rows = docs.select(F.col(key).alias("key"), data.alias("data")).withColumn("sha", F.sha2("data", 256))
    rows = rows.withColumn("n_bytes", F.octet_length("data").cast("long"))
    own = rows.groupBy("key", "sha").agg(F.count(F.lit(1)).alias("rows"))

    small = _chunks(rows.where(F.col("n_bytes") <= HUGE_BYTES))
    huge = _chunks(rows.where(F.col("n_bytes") > HUGE_BYTES)).repartition("sha", "at")
    shares = small.unionByName(huge).mapInArrow(_hash_chunks, "sha string, n_bytes long, at long, h1 long, h2 long")
    shares = shares.groupBy("sha", "n_bytes", "at").agg(F.min("h1").alias("h1"), F.min("h2").alias("h2"))
    whole = [F.expr(f"cast(sum(cast(h{i + 1} as decimal(38,0))) % {p} as bigint)").alias(f"fp{i + 1}") for i, p in enumerate(PRIMES)]
    prints = shares.groupBy("sha", "n_bytes").agg(*whole)
    counted = own.groupBy("sha").agg(F.max("key").alias("last"), F.sum("rows").alias("n"))
    texts = kept(prints.join(counted, "sha"))

    of = ["fp1", "fp2", "n_bytes"]
    shared = texts.groupBy(*of).agg(F.sum("n").alias("n")).where("n > 1").drop("n")
    members = texts.join(shared, of, "left_semi").select("sha", "fp1", "fp2")
    places = _chunks(rows).join(members, "sha").groupBy(*of, "at").agg(F.min("chunk").alias("least"), F.max("chunk").alias("most"))
    verdict = places.groupBy(*of).agg(F.bool_and(F.col("least") == F.col("most")).alias("same"))
    texts = texts.join(verdict, of, "left").withColumn("apart", F.when(F.coalesce("same", F.lit(True)), F.lit("")).otherwise(F.col("sha")))
    classes = texts.groupBy(*of, "apart").agg(F.max("last").alias("keep_id"), F.sum("n").alias("group_size"))
    found = kept(texts.join(classes, [*of, "apart"]).select("sha", "keep_id", "group_size", *of))

    out = own.join(found, "sha").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    stays = F.col("key").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return out.select(F.col("key").alias(key), "keep_id", "group_size", stays.alias("kept"), F.col("sha").alias("text_sha256"), "fp1", "fp2", "n_bytes")


_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, CAST(count(*) AS BIGINT) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size,
       doc_id IS NOT DISTINCT FROM keep_id AND row_number() OVER (PARTITION BY d.t, doc_id) = 1 AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""


@REGISTRY.query("op2_exact_duplicates", _SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
