"""Benchmark decontamination by winnowing.

Of every ``WINDOW - K + 1`` neighbouring K-grams of a text the one of least hash is its fingerprint
there. Two texts that share WINDOW words in a row share the K-grams in them and therefore the
fingerprint, whatever stands around. So only fingerprints are joined, and each hit is then extended to
the windows that its fingerprint stands for, which are compared word by word.

Texts of fewer words than a window have none in that sense: an item of m < WINDOW words is looked for
as one window of m words.

The fingerprints of all items, folded into a bit table of fixed size, go to the tasks that read the
documents; only what passes it leaves them. The table never drops a hit: with many items it only lets
more through to the joins, which are exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.llm.common import REGISTRY, kept, table
from lakeshift.llm.words import LETTERS_DIGITS, Slab, slabs, window_hashes

WINDOW, K = 10, 5
#: Bits of the table that is sent to the tasks (128 KiB).
TABLE_BITS = 1 << 20

_HITS = "array<struct<start:int,n:int,print:bigint,words:string>>"


def selected(grams: np.ndarray, span: int) -> np.ndarray:
    """For each window of ``span`` neighbouring K-grams the place of the least (the last of equals)."""
    n = len(grams) - span + 1
    best, at = grams[:n].copy(), np.arange(n)
    for step in range(1, span):
        other = grams[step : step + n]
        lower = other <= best
        best[lower] = other[lower]
        at[lower] = (np.arange(n) + step)[lower]
    return at


def _windows(slab: Slab, d: int, starts: np.ndarray, n: int, prints: np.ndarray) -> list[dict]:
    """Windows of text ``d`` of the slab, with their words joined by one space."""
    first = slab.first[d]
    return [
        {"start": int(s - first), "n": n, "print": int(p), "words": b" ".join(slab.word(i) for i in range(s, s + n)).decode()}
        for s, p in zip(starts.tolist(), prints.tolist())
    ]


def _slab_windows(slab: Slab, window: int, k: int):
    """Starts and fingerprints of all windows of the slab's texts."""
    if len(slab.starts) < window:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    grams = window_hashes(slab.hashes, k)[: len(slab.hashes) - k + 1]
    at = selected(grams, window - k + 1)
    whole = slab.left()[: len(at)] >= window
    starts = np.flatnonzero(whole)
    return starts, grams[at[starts]].view(np.int64)


def _short(slab: Slab, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of all runs of n words."""
    starts = np.flatnonzero(slab.left() >= n)
    return starts, window_hashes(slab.hashes, n)[starts].view(np.int64)


def item_windows(items: DataFrame, key: str, text: str, window: int, k: int) -> DataFrame:
    """item, n, print, words: the windows of all items."""

    def run(batches):
        for b in batches:
            ids, out = b[key].cast(pa.string()).to_pylist(), {"item": [], "n": [], "print": [], "words": []}
            for slab in slabs(b[text], LETTERS_DIGITS, lower=True):
                starts, prints = _slab_windows(slab, window, k)
                owner = slab.text_of()[starts] if len(starts) else starts
                for d in range(len(slab)):
                    m = int(slab.first[d + 1] - slab.first[d])
                    if m >= window:
                        mine = owner == d
                        found = _windows(slab, d, starts[mine], window, prints[mine])
                    elif m:
                        h = window_hashes(slab.hashes[slab.first[d] : slab.first[d + 1]], m)[:1].view(np.int64)
                        found = _windows(slab, d, slab.first[d : d + 1], m, h)
                    else:
                        continue
                    out["item"] += [ids[slab.rows.start + d]] * len(found)
                    for c in ("n", "print", "words"):
                        out[c] += [f[c] for f in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["item"], pa.string()), pa.array(out["n"], pa.int32()), pa.array(out["print"], pa.int64()), pa.array(out["words"], pa.string())],
                ["item", "n", "print", "words"],
            )

    return items.select(key, text).mapInArrow(run, "item string, n int, print long, words string")


def bit_table(prints: DataFrame, column: str = "print") -> np.ndarray:
    """A table of TABLE_BITS bits with those of all fingerprints set; what reaches the driver has a fixed bound."""
    place = F.pmod(F.col(column), F.lit(TABLE_BITS // 64))
    word = F.expr(f"bit_or(shiftleft(1L, cast(pmod(shiftright({column}, 40), 64) as int)))")
    table_ = np.zeros(TABLE_BITS // 64, np.int64)
    for r in prints.groupBy(place.alias("p")).agg(word.alias("w")).toLocalIterator():
        table_[r["p"]] = r["w"]
    return table_


def _passes(bits: np.ndarray, prints: np.ndarray) -> np.ndarray:
    words = bits[np.mod(prints, len(bits))]
    return (words >> np.mod(prints >> 40, 64)) & 1 == 1


def hits(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", window: int = WINDOW, k: int = K) -> DataFrame:
    """One row per row of ``docs``: key, n_words, n_hit, and ``items``, the sorted ids of the items found (as texts).

    A word is hit when it lies in a place where a window of an item occurs. Nulls: a null text has no
    words and is never hit; an item without words is found nowhere; a null item id is never listed but
    its windows hit; a null key is a key. Equal keys: each row is judged on its own text. Empty tables
    give no rows, or rows without hits. Other columns are not looked at.
    """
    windows = kept(item_windows(items, item_key, item_text, window, k))
    bits = bit_table(windows.select("print", "n"))
    lengths = [r["n"] for r in windows.where(F.col("n") < window).select("n").distinct().collect()]

    def run(batches):
        for b in batches:
            n_words, found = [], []
            for slab in slabs(b["text"], LETTERS_DIGITS, lower=True):
                cands = [(window, *_slab_windows(slab, window, k))] + [(n, *_short(slab, n)) for n in lengths]
                mine: list[list[dict]] = [[] for _ in range(len(slab))]
                owner = slab.text_of()
                for n, starts, prints in cands:
                    ok = _passes(bits, prints)
                    starts, prints = starts[ok], prints[ok]
                    texts = owner[starts]
                    for d in np.unique(texts).tolist():
                        of = texts == d
                        mine[d] += _windows(slab, d, starts[of], n, prints[of])
                n_words += np.diff(slab.first).tolist()
                found += mine
            kind = pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32()), ("print", pa.int64()), ("words", pa.string())]))
            yield pa.RecordBatch.from_arrays([b["key"], pa.array(n_words, pa.int64()), pa.array(found, kind)], ["key", "n_words", "found"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    rows = rows.mapInArrow(run, f"key {kind}, n_words long, found {_HITS}")
    rows = kept(rows.withColumn("row", F.monotonically_increasing_id()))

    candidates = rows.select("row", F.explode("found").alias("w")).select("row", "w.*")
    same_print = candidates.join(windows.select("n", "print").distinct(), ["n", "print"], "left_semi")
    texts = windows.groupBy("n", "words").agg(F.sort_array(F.collect_set("item")).alias("in_items"))
    found = same_print.join(texts, ["n", "words"])
    covered = F.size(F.array_distinct(F.flatten(F.collect_list(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)))))
    places = found.groupBy("row").agg(covered.cast("long").alias("n_hit"))
    listed = found.select("row", F.explode("in_items").alias("item")).distinct().groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items"))
    out = rows.select("row", "key", "n_words").join(places.join(listed, "row", "left"), "row", "left")
    none = F.array().cast("array<string>")
    return out.select(F.col("key").alias(key), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", none).alias("items"))


_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS t
       FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS t
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns WHERE len(w) >= n)),
h AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw USING (n, t)),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN l USING (doc_id)
"""


@REGISTRY.query("op8_winnowed_contamination", _SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
