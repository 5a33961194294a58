"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshift.llm.common import kept


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node of its component) for every node of ``edges`` (a long, b long).

    Alternates two star steps until nothing changes: each node hands its greater neighbours, then its
    smaller ones, to the least node it knows. Edges never grow in number, hubs are combined before the
    shuffle, and the number of rounds grows with the logarithm of the component's size. Loops and
    repeated edges are harmless; nothing is collected but a count and a checksum per round.
    """
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    now, seen = kept(now), None
    while True:
        state = tuple(now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
        if state == seen or not state[0]:
            break
        seen = state
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        now = kept(small.select("e.*").where("a > b").distinct())
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
