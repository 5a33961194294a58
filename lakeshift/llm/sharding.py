"""Sharding by proportional stratified interleaving (DataFrame functions only).

The rows of each source are shuffled by a seeded hash and ranked; a row's fractional rank is
(rank + 1/2) / rows of its source. In the order of the fractional ranks every stretch of rows holds
the sources in their overall proportions, so cutting it into equal stretches gives shards that each
match the mixture, with row counts at most one apart.

Both rankings, within a source and over all rows, go through :func:`common.ranked`: hash cells are
counted first, so a source that holds a third of all rows is sorted by as many tasks as any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.llm.common import REGISTRY, ranked, table

#: Rows that one sorting cell holds on average.
CELL_ROWS = 1000


def interleave(rows: DataFrame, shards: int, source: str = "source", key: str = "doc_id", seed: int = 0) -> DataFrame:
    """Add ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 within the shard) to all rows.

    Nulls: a null source is a source of its own; a null key is a key. Ties: rows of equal key are told
    apart by the hash of all other columns; rows that agree in everything are interchangeable. An empty
    table gives an empty result; with fewer rows than shards some shards are empty. Columns named
    ``shard`` or ``slot`` are replaced; other columns pass through, so pass narrow rows where texts
    need not move.
    """
    rows = rows.drop("shard", "slot")
    n = rows.count()
    cells = max(1, n // CELL_ROWS)
    shuffled = F.xxhash64(F.lit(seed), F.col(key))
    names = {c: f"c{i}" for i, c in enumerate(rows.columns)}
    df = rows.select(
        *[F.col(c).alias(a) for c, a in names.items()],
        F.col(source).alias("_source"),
        shuffled.alias("_hash"),
        F.pmod(F.shiftright(shuffled, 20), F.lit(cells)).alias("_cell"),
        F.xxhash64(*[F.col(c) for c in rows.columns]).alias("_tie"),
    )
    df = ranked(df, ["_source"], ["_cell"], [F.col("_hash"), F.col("_tie")], "_rank", "_of")
    df = df.withColumn("_at", (F.col("_rank") + 0.5) / F.col("_of"))
    df = df.withColumn("_stretch", F.least(F.floor(F.col("_at") * cells), F.lit(cells - 1)))
    df = ranked(df, [], ["_stretch"], [F.col("_at"), F.col("_source").asc_nulls_last(), F.col("_hash"), F.col("_tie")], "_place")
    shard = F.expr(f"cast(_place * {shards} div {max(n, 1)} as int)")
    df = df.withColumn("_shard", shard)
    first = F.expr(f"(cast(_shard as bigint) * {n} + {shards - 1}) div {shards}")  # the first place of the shard
    return df.select(*[F.col(a).alias(c) for c, a in names.items()], F.col("_shard").alias("shard"), (F.col("_place") - first).alias("slot"))


@REGISTRY.query("op4_interleaved_shards")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(
        "doc_id",
        "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    out = interleave(rows, 40, seed=4)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source")
