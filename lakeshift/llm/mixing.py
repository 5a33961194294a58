"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies e = target / size of the source. The
documents of a source are laid out in the order of their sizes (equal sizes in hashed order), their
expected copies are summed up from left to right, one random offset per source is added, and a
document is taken once for each whole number that its stretch crosses. A stretch of length e <= 2
crosses at most two. Since neighbours have nearly equal sizes, the words taken stay within about one
document of the target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshift.llm.common import REGISTRY, kept, ranked, table, word_count

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2.0
#: Rows of equal source and size that are sorted together, on average.
CELL_ROWS = 2000


def targets(sizes: DataFrame, source: str, size: str, share: float = SHARE, most: float = MOST, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source, source_size, target: what each source gives, in words.

    ``sizes`` has one row per source. The sources share ``share`` times all words by weight; a target
    stops at ``most`` times its source, and the excess is shared anew among the others until none is
    above. That ends at a level at which each source gives weight x level or its most, so the sources
    are ordered by most / weight, and the level is the first that no later source falls short of.
    """
    by_name = Window.orderBy(F.col(source).asc_nulls_last())
    place = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    rows = sizes.withColumn("_w", weight).withColumn("_cap", F.col(size) * F.lit(most))
    rows = rows.withColumn("_stop", F.col("_cap") / F.col("_w"))
    everything = Window.partitionBy(F.lit(0))
    before = Window.partitionBy(F.lit(0)).orderBy("_stop", F.col(source).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    given = F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    spent = F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    rows = rows.withColumn("_level", (F.sum(size).over(everything) * F.lit(share) - given) / (F.sum("_w").over(everything) - spent))
    rows = rows.withColumn("_level", F.min(F.when(F.col("_level") <= F.col("_stop"), F.struct(F.col("_stop"), F.col("_level")))).over(everything)["_level"])
    target = F.when(F.col("_level").isNull() | (F.col("_w") * F.col("_level") > F.col("_cap")), F.col("_cap")).otherwise(F.col("_w") * F.col("_level"))
    return rows.select(F.col(source), F.col(size).alias("source_size"), target.alias("target"))


def systematic(rows: DataFrame, source: str = "source", key: str = "doc_id", size: str = "size", seed: str = "mix", **law) -> DataFrame:
    """Add source_size, target and copies (0, 1 or 2) to all rows.

    Nulls: a null source is a source of its own, after all others; a null size counts as 0; a null key
    is a key. Rows of equal key and size are interchangeable. A source without words has target 0 and
    gives no copies. Reruns and other partitionings give the same result. Columns named like the three
    are replaced.
    """
    rows = rows.drop("source_size", "target", "copies")
    names = {c: f"c{i}" for i, c in enumerate(rows.columns)}
    df = rows.select(
        *[F.col(c).alias(a) for c, a in names.items()],
        F.col(source).alias("_source"),
        F.coalesce(F.col(size), F.lit(0)).alias("_size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))).alias("_hash"),
    )
    df = kept(df)  # sizes are counted once, though ranks, sums and rows all ask for them
    sums = df.groupBy("_source").agg(F.sum("_size").alias("_sum"), F.count(F.lit(1)).alias("_rows"))
    wanted = targets(sums, "_source", "_sum", **law).select(F.col("_source").alias("_name"), "source_size", "target")
    cells = max(1, df.count() // CELL_ROWS)
    cell = F.pmod(F.conv(F.substring("_hash", 1, 8), 16, 10).cast("long"), F.lit(cells))
    order = [F.col("_hash"), F.xxhash64(*names.values())]
    df = ranked(df.withColumn("_cell", cell), ["_source"], ["_size", "_cell"], order, "_rank")
    df = df.join(wanted, F.col("_source").eqNullSafe(F.col("_name")), "inner")
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}/"), F.coalesce("_source", F.lit("")))), 1, 8), 16, 10).cast("long") % 1024 / 1024.0
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    copies = F.floor((F.col("_rank") + 1) * each + offset) - F.floor(F.col("_rank") * each + offset)
    return df.select(*[F.col(a).alias(c) for c, a in names.items()], "source_size", "target", copies.cast("long").alias("copies"))


_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h, hash(text) AS tie FROM documents),
c AS (SELECT *, CAST(('0x' || substr(h, 1, 8))::BIGINT % greatest(1, (SELECT count(*) FROM d) // 2000) AS BIGINT) AS cell FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)]::DOUBLE AS w FROM d GROUP BY source),
o AS (SELECT *, source_size * 2.0::DOUBLE AS cap, source_size * 2.0::DOUBLE / w AS stop FROM s),
l AS (SELECT *, ((SELECT sum(source_size) FROM s) * 1.5::DOUBLE
                 - coalesce(sum(cap) OVER (ORDER BY stop, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
                / ((SELECT sum(w) FROM s) - coalesce(sum(w) OVER (ORDER BY stop, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) AS lev FROM o),
g AS (SELECT (SELECT lev FROM l WHERE lev <= stop ORDER BY stop, lev LIMIT 1) AS lev),
t AS (SELECT source, source_size, CASE WHEN g.lev IS NULL OR w * g.lev > cap THEN cap ELSE w * g.lev END AS target,
             ('0x' || substr(md5('mix/' || coalesce(source, '')), 1, 8))::BIGINT % 1024 / 1024.0::DOUBLE AS u FROM o, g),
r AS (SELECT doc_id, source, size, row_number() OVER (PARTITION BY source ORDER BY size, cell, h, tie) - 1 AS rk FROM c),
e AS (SELECT doc_id, size, source_size, target, rk, u, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS each
      FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(floor((rk + 1) * each + u) - floor(rk * each + u) AS BIGINT) * size AS taken FROM e
"""


@REGISTRY.query("op10_systematic_mix", _SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count("text").alias("size"))
    mixed = systematic(docs)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
