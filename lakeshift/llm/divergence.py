"""Source divergence audit: which sources of a language use words unlike each other, and which words set a source apart.

Every text is tokenised by one pass of ``bytes.translate``, which lowers letters and blanks separators, and ``bytes.split``; a Counter
per document gives its frequencies, and the entries of many documents are added up by (language, source, term), as occurrences and
as documents, before they are shuffled. Only terms that occur are rows; what a source has of the other terms follows from sums.

Arithmetic is in whole numbers. A term's share of a group is p = 1 + floor(10^9 * (count + 1) / (N + V)), and the divergence of p from q
is floor((p - q)^2 / q), the chi-square distance term by term.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshift.llm.common import REGISTRY, table
from lakeshift.sources.scratch import stored

LEAST_DOCUMENTS, TOP = 3, 200
#: A-Z to a-z, other bytes below 0x80 that are no letters to blanks.
TRANSLATE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
#: Entries of (document, term) that are gathered before they are added up, and rows that a task holds before it sends them.
ENTRIES, HELD = 200_000, 1_000_000
#: Sources that are compared in one task, and occurring (source, term) cells of a task.
TILE, CELLS = 512, 1 << 15
_UNIT = 1_000_000_000
#: Floor of 10^9 a / d in three steps of 10^3, so that no product leaves 64 bits.
_STEP, _STEPS = 1000, 3


def _added(tables: list[pa.Table]) -> pa.Table:
    whole = pa.concat_tables(tables).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    return whole.select(["lang", "source", "term", "n_sum", "docs_sum"]).rename_columns(["lang", "source", "term", "n", "docs"])


def _tokenised(batches):
    """lang, source, term, n, docs: added up per task as far as memory allows. A row without a term counts the documents of a group."""
    held: list[pa.Table] = []
    for b in batches:
        texts = b["text"].cast(pa.large_binary())
        at = 0
        while at < len(texts):
            rows, terms, counts = [], [], []
            while at < len(texts) and len(terms) < ENTRIES:
                found = Counter(texts[at].as_py().translate(TRANSLATE).split())
                rows += [at] * len(found)
                terms.extend(found)
                counts.extend(found.values())
                rows.append(at)
                terms.append(None)
                counts.append(1)
                at += 1
            take = pa.array(rows, pa.int64())
            columns = [b["lang"].take(take), b["source"].take(take), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())]
            held.append(_added([pa.Table.from_arrays([*columns, pa.array(np.ones(len(rows), np.int64))], ["lang", "source", "term", "n", "docs"])]))
            if sum(t.num_rows for t in held) > HELD:
                held = [_added(held)]
                if held[0].num_rows > HELD // 2:
                    yield from held.pop().to_batches(max_chunksize=50_000)
    if held:
        yield from _added(held).to_batches(max_chunksize=50_000)


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents with it); the row without a term counts the group's documents."""
    empty = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((text, "text"), (lang, "lang"), (source, "source"))]
    parts = docs.select(*empty).mapInArrow(_tokenised, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column) -> Column:
    """1 + floor(10^9 * (count + 1) / total), without leaving 64 bits for totals below 9 * 10^15."""
    rest, whole = count + 1, F.lit(0)
    for _ in range(_STEPS):
        rest, whole = (rest * _STEP) % total, whole * _STEP + _div(rest * _STEP, total)
    return whole + 1


def _div(a: Column, b: Column) -> Column:
    """Floor of a / b for whole numbers that are not negative."""
    return F.call_function("div", a, b)


def _shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    rest, whole = count + 1, np.zeros_like(count)
    for _ in range(_STEPS):
        rest, whole = (rest * _STEP) % total, whole * _STEP + (rest * _STEP) // total
    return whole + 1


def _unlike(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // q


def pair_sums(source: np.ndarray, term: np.ndarray, count: np.ndarray, total: np.ndarray, n_terms: int) -> np.ndarray:
    """For each ordered pair of sources the divergence summed over ``n_terms`` terms, of which those of the given cells occur.

    Only cells that occur are visited, once as the first and once as the second of a pair; terms that neither source has give
    the same for all, and are counted."""
    n = len(total)
    rare = _shares(np.zeros(n, np.int64), np.maximum(total, 1))
    out = np.zeros((n, n), np.int64)
    both_absent = np.zeros((n, n), np.int64)
    order = np.argsort(term, kind="stable")
    source, term, p = source[order], term[order], _shares(count[order], total[source[order]])
    step = max(1, (1 << 20) // max(n, 1))
    for low in range(0, n_terms, step):
        width = min(step, n_terms - low)
        a, b = np.searchsorted(term, [low, low + width])
        s, t = source[a:b], term[a:b] - low
        grid = np.repeat(rare[:, None], width, axis=1)
        grid[s, t] = p[a:b]
        there = np.zeros((n, width), bool)
        there[s, t] = True
        absent = (~there).astype(np.float32 if width < 1 << 24 else np.float64)
        both_absent += np.rint(absent @ absent.T).astype(np.int64)
        for x in range(n):
            at = np.flatnonzero(there[x])
            out[x] += _unlike(grid[x, at][None, :], grid[:, at]).sum(1)
            alone = _unlike(rare[:, None], grid[x, at][None, :])
            alone[there[:, at]] = 0
            out[:, x] += alone.sum(1)
    return out + both_absent * _unlike(rare[:, None], rare[None, :])


def _compared(key, group):
    """The pairs of one block: rows without a term are the sources, the others the occurring cells of the block's terms.

    ``all_terms`` counts the block's terms, also those that no source of these tiles has."""
    head = group.filter(pa.compute.is_null(group["term"]))
    cells = group.filter(pa.compute.is_valid(group["term"]))
    names = head["source"].combine_chunks()
    n = len(names)
    codes = cells["term"].combine_chunks().dictionary_encode()
    where = pa.compute.index_in(cells["source"], names).to_numpy().astype(np.int64)
    sums = pair_sums(where, codes.indices.to_numpy(zero_copy_only=False).astype(np.int64), cells["n"].to_numpy(), head["n"].to_numpy(), head["all_terms"][0].as_py())
    tiles = head["tile"].to_numpy()
    first, second = (k.as_py() for k in key[2:4])
    # pairs within a tile belong to the block of (tile, tile), pairs of two tiles to that of both
    fit = ~np.eye(n, dtype=bool) & ((tiles[:, None] != tiles[None, :]) if first != second else True)
    a, b = np.nonzero(fit)
    lang = pa.array([key[0].as_py()] * len(a), pa.string())
    return pa.Table.from_arrays([lang, names.take(pa.array(a)), names.take(pa.array(b)), pa.array(sums[a, b])], ["lang", "source", "item", "value"])


def audited(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source lies from each other of its language, and its most telling terms.

    Part ``pair`` holds each other source of the language; value is the divergence of the source's shares from that one's,
    summed over all terms that at least ``least`` documents of the language have. Part ``term`` holds the terms that the source uses
    more than its language does, at most ``top``, by divergence. Ranks go by value, then by the item's bytes.

    Nulls in text, language and source count as empty texts and names. Empty texts have no terms, but their
    groups occur. Repeated rows count each. Texts of any length are read whole; an empty table gives no rows.
    Only the three columns are read, so other columns cannot clash.
    """
    counts = stored(term_counts(docs, text, lang, source), "term-counts")
    same = Window.partitionBy("lang", "term")
    terms = counts.where("term is not null").withColumn("lang_docs", F.sum("docs").over(same)).where(F.col("lang_docs") >= least)
    terms = terms.withColumn("lang_n", F.sum("n").over(same)).withColumn("once", (F.col("source") == F.min("source").over(same)).cast("long"))
    terms = stored(terms.select("lang", "source", "term", "n", "lang_n", "once"), "kept-terms")

    group_n = terms.groupBy("lang", "source").agg(F.sum("n").alias("group_n"), F.count(F.lit(1)).alias("cells"), F.sum("once").alias("once"))
    groups = counts.where("term is null").select("lang", "source").join(group_n, ["lang", "source"], "left").na.fill(0)
    of_lang = groups.groupBy("lang").agg(
        F.sum("group_n").alias("lang_total"), F.sum("once").alias("v"), F.sum("cells").alias("cells"), F.count(F.lit(1)).alias("sources")
    )
    of_lang = of_lang.withColumn("tiles", F.ceil(F.col("sources") / TILE))
    side = F.least(F.col("sources"), F.lit(TILE))
    of_lang = of_lang.withColumn("blocks", F.greatest(F.ceil(F.col("cells") / F.greatest(F.lit(CELLS), side * side)), F.lit(1)))
    groups = groups.select("lang", "source", "group_n").join(of_lang, "lang")
    tile = F.pmod(F.xxhash64("source"), F.col("tiles"))
    total = F.col("group_n") + F.col("v")
    groups = stored(groups.select("lang", "source", total.alias("total"), (F.col("lang_total") + F.col("v")).alias("lang_total"), "tiles", "blocks", tile.alias("tile")), "groups")

    p, q = share(F.col("n"), F.col("total")), share(F.col("lang_n"), F.col("lang_total"))
    telling = terms.join(groups, ["lang", "source"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), p.alias("p"), q.alias("q"))
    gap = F.col("p") - F.col("q")
    telling = telling.where("p > q").select("lang", "source", "part", "item", _div(gap * gap, F.col("q")).alias("value"))

    def spread(df: DataFrame) -> DataFrame:
        """Each row to the blocks of all tile pairs that its tile is part of."""
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
        df = df.withColumn("other", other)
        return df.select("lang", "block", F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"), "tile", "source", "term", "n", "all_terms")

    block = F.pmod(F.xxhash64("term"), F.col("blocks"))
    placed = terms.join(groups, ["lang", "source"]).withColumn("block", block)
    cells = spread(placed.withColumn("all_terms", F.lit(None).cast("long")))
    in_block = placed.groupBy("lang", "block").agg(F.sum("once").alias("all_terms"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    heads = groups.withColumn("block", every).join(in_block, ["lang", "block"], "left").na.fill(0, ["all_terms"])
    heads = spread(heads.select("*", F.lit(None).cast("string").alias("term"), F.col("total").alias("n")))
    sums = cells.unionByName(heads).groupBy("lang", "block", "a", "b").applyInArrow(_compared, "lang string, source string, item string, value long")
    pairs = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    best = telling.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(best).withColumn("rank", F.col("rank").cast("int"))


_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM w GROUP BY ALL HAVING count(DISTINCT r) >= {LEAST_DOCUMENTS}),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT w.lang, w.source, w.term, CAST(count(*) AS HUGEINT) AS n FROM w JOIN k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL),
lv AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, CAST(sum(n) AS HUGEINT) AS t FROM k GROUP BY lang),
gv AS (SELECT lang, source, CAST(sum(n) AS HUGEINT) AS t FROM c GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (coalesce(gv.t, 0) + lv.v) AS p,
             1 + (1000000000 * (k.n + 1)) // (lv.t + lv.v) AS q
      FROM g JOIN k ON g.lang = k.lang JOIN lv ON g.lang = lv.lang LEFT JOIN gv ON g.lang = gv.lang AND g.source = gv.source
      LEFT JOIN c ON g.lang = c.lang AND g.source = c.source AND k.term = c.term),
f AS (SELECT a.lang, a.source, b.source AS item, CAST(sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS BIGINT) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
o AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL
      SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // q AS BIGINT) FROM p WHERE n > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank FROM o
QUALIFY part = 'pair' OR rank <= {TOP}
"""


@REGISTRY.query("op11_source_divergence", _SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited(table(spark, sf_dir, "documents"))
