"""Substring deduplication by level-wise doubling of word windows.

A window of n words can be repeated only if its two halves are. So windows are looked at on a ladder of
lengths (7, 13 for 13 words; 7, 13, 25, 50 for 50): all windows of the first length, and at each later
length those alone whose first and last halves have been found repeated, until the last length is
reached or nothing is left.

One level is two exchanges. Windows meet by hash bucket, packed as arrays: before they are sent, those
that agree within a task are combined into the one of the least document, so a window that a third of
all documents hold costs one entry per task. What is found repeated goes back, packed again, to the
group of documents that it lies in. Levels below the last compare 32 bits within a bucket (a false
match only keeps a candidate for the next level); the last compares 64.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.llm.common import REGISTRY, groups_for, split_by, table
from lakeshift.llm.words import NOT_SPACE, Slab, mixed, slabs, window_hashes

WINDOW = 13
#: The ladder starts at the first half of at most this length.
BASE = 8
#: Windows that a task packs at a time.
PACK = 2_000_000
_NO_ID = np.iinfo(np.int64).max


def ladder(length: int) -> list[int]:
    """Lengths from the first level to ``length``; each is at most twice the one before."""
    steps = [length]
    while steps[0] > BASE:
        steps.insert(0, -(-steps[0] // 2))
    return steps


def _ids(column) -> np.ndarray:
    return np.asarray(column.cast(pa.int64()).fill_null(_NO_ID)).astype(np.int64)


def _mark(hashes: np.ndarray, uid: np.ndarray) -> np.ndarray:
    """One number for a window hash in a text, by which it is found again there."""
    return mixed(hashes ^ mixed(uid))


def _narrow(hashes: np.ndarray, wide: bool) -> np.ndarray:
    return hashes if wide else hashes & np.uint64(0xFFFFFFFF)


class Packer:
    """Collects windows of a task and packs them by bucket; what the task itself finds repeated is marked at once."""

    def __init__(self, buckets: int, homes: int, last: bool):
        self.buckets, self.homes, self.last = buckets, homes, last
        self.hashes, self.texts, self.uid, self.ids, self.count = [], [], [], [], 0

    def add(self, hashes: np.ndarray, texts: np.ndarray, uid: np.ndarray, ids: np.ndarray):
        self.texts.append(texts + sum(map(len, self.uid)))
        self.hashes.append(hashes)
        self.uid.append(uid)
        self.ids.append(ids)
        self.count += len(hashes)
        if self.count >= PACK:
            yield from self.flush()

    def flush(self):
        if not self.count:
            self.hashes, self.texts, self.uid, self.ids = [], [], [], []
            return
        h, t = np.concatenate(self.hashes), np.concatenate(self.texts)
        uid, ids = np.concatenate(self.uid), np.concatenate(self.ids)
        self.hashes, self.texts, self.uid, self.ids, self.count = [], [], [], [], 0
        order = np.lexsort((uid[t], ids[t], h))
        h, t = h[order], t[order]
        new = np.concatenate(([True], h[1:] != h[:-1]))
        group = np.cumsum(new) - 1
        least = ids[t[new]][group]
        later = ids[t] > least
        found = later if self.last else _any(later, group)[group]
        bucket = (mixed(h ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(self.buckets)).astype(np.int64)
        marks, home = _mark(_narrow(h, self.last)[found], uid[t[found]]), uid[t[found]] % np.uint64(self.homes)
        yield from _home_rows(marks, home.astype(np.int64), self.homes, self.buckets)
        # one entry stands for a window, but rows that tie for the least id, and are not marked, each need their own
        other_uid = np.concatenate(([True], uid[t[1:]] != uid[t[:-1]]))
        sent = new | ~found & other_uid
        h, t, bucket = h[sent], t[sent], bucket[sent]
        order = np.lexsort((t, bucket))
        h, t, bucket = h[order], t[order], bucket[order]
        cuts = np.searchsorted(bucket, np.arange(self.buckets + 1))
        keys, blobs = [], []
        for b in range(self.buckets):
            lo, hi = cuts[b], cuts[b + 1]
            if hi > lo:
                texts, sizes = np.unique(t[lo:hi], return_counts=True)
                data = h[lo:hi] if self.last else h[lo:hi].astype(np.uint32)
                keys.append(b)
                blobs.append(np.int64(len(texts)).tobytes() + uid[texts].tobytes() + ids[texts].tobytes() + sizes.astype(np.uint32).tobytes() + data.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(blobs, pa.binary())], ["bucket", "pack"])


def _any(flags: np.ndarray, group: np.ndarray) -> np.ndarray:
    return np.bincount(group, weights=flags, minlength=group[-1] + 1 if len(group) else 0) > 0


def _home_rows(marks: np.ndarray, home: np.ndarray, homes: int, offset: int):
    """Marks packed by the group of documents that they go to."""
    if not len(marks):
        return
    parts = [(i, marks[at]) for i, at in enumerate(split_by(home, homes)) if len(at)]
    yield pa.RecordBatch.from_arrays(
        [pa.array([offset + i for i, _ in parts], pa.int32()), pa.array([np.unique(m).tobytes() for _, m in parts], pa.binary())], ["bucket", "pack"]
    )


def _unpack(blob: bytes, wide: bool):
    n = int(np.frombuffer(blob, np.int64, 1)[0])
    uid, ids = np.frombuffer(blob, np.uint64, n, 8), np.frombuffer(blob, np.int64, n, 8 + 8 * n)
    sizes = np.frombuffer(blob, np.uint32, n, 8 + 16 * n)
    h = np.frombuffer(blob, np.uint64 if wide else np.uint32, -1, 8 + 20 * n).astype(np.uint64)
    return h, np.repeat(uid, sizes), np.repeat(ids, sizes)


def _meet(buckets: int, homes: int, last: bool):
    """The windows of one bucket: marks of those repeated (at the last level: in a lesser document too)."""

    def run(key, rows):
        bucket, packs = key[0].as_py(), rows["pack"].to_pylist()
        if bucket >= buckets:
            out = [(bucket - buckets, p) for p in packs]
        else:
            h, uid, ids = (np.concatenate(x) for x in zip(*(_unpack(p, last) for p in packs)))
            order = np.lexsort((ids, h))
            h, uid, ids = h[order], uid[order], ids[order]
            new = np.concatenate(([True], h[1:] != h[:-1]))
            group = np.cumsum(new) - 1
            later = ids > ids[new][group]
            found = later if last else _any(later, group)[group]
            marks, home = _mark(h[found], uid[found]), (uid[found] % np.uint64(homes)).astype(np.int64)
            out = [x for b in _home_rows(marks, home, homes, 0) for x in zip(b["bucket"].to_pylist(), b["pack"].to_pylist())]
        return pa.table({"home": pa.array([x for x, _ in out], pa.int32()), "marks": pa.array([x for _, x in out], pa.binary())})

    return run


def _windows(slab: Slab, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows of each word on, and which of them lie within one text."""
    return window_hashes(slab.hashes, size), slab.left() >= size


def packed_texts(rows: DataFrame, homes: int) -> DataFrame:
    """home, id, uid, z: the texts, compressed for the shuffle, with the group that each belongs to."""

    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=1)
        for b in batches:
            z = [squeeze.compress(t.as_buffer().to_pybytes()) for t in b["text"].cast(pa.large_binary())]
            home = pa.array((np.asarray(b["uid"]).view(np.uint64) % np.uint64(homes)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([home, b["id"], b["uid"], pa.array(z, pa.binary())], ["home", "id", "uid", "z"])

    return rows.mapInArrow(run, "home int, id long, uid long, z binary")


def _texts(rows: pa.Table) -> pa.Array:
    unpack = zstandard.ZstdDecompressor()
    return pa.array([unpack.decompress(z.as_buffer().to_pybytes()) for z in rows["z"].combine_chunks()] if len(rows) else [], pa.large_binary())


def _repeated(slab: Slab, uid: np.ndarray, marks: np.ndarray, size: int, last: bool) -> np.ndarray:
    """Which windows of the slab's texts have been marked."""
    h, whole = _windows(slab, size)
    return whole & contained(_mark(_narrow(h, last), uid[slab.rows][slab.text_of()]), marks)


def contained(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which values are in an ordered array. Sorted values walk through it in memory order."""
    if not len(ordered):
        return np.zeros(len(values), bool)
    order = np.argsort(values)
    at = np.searchsorted(ordered, values[order])
    out = np.empty(len(values), bool)
    out[order] = ordered[np.minimum(at, len(ordered) - 1)] == values[order]
    return out


def _marks_of(rows: pa.Table) -> np.ndarray:
    """The marks that came to a group, in order."""
    return np.unique(np.frombuffer(b"".join(rows["marks"].to_pylist()), np.uint64))


def without_repeats(docs: DataFrame, length: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, n_words, n_removed, kept_text (the words that stay, joined by one space).

    Each word is removed that lies in a window of ``length`` words whose word sequence also starts in a
    row with a smaller key; windows are judged on the input. Words are `[^\\x20\\x09-\\x0D]+`. Keys are
    integers. Nulls: a null text has no words; a null key is greater than any other, so such rows lose
    what other rows have. Rows of equal key do not take words from each other. Texts shorter than a
    window, and empty tables, come back whole. Other columns are not looked at.
    """
    uid = F.xxhash64(F.col(key), F.coalesce(F.col(text), F.lit("")))
    rows = docs.select(F.col(key).cast("long").alias("id"), uid.alias("uid"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n = groups_for(rows, "text", least=12)
    levels = ladder(length)

    def first(batches):
        pack = Packer(n, n, len(levels) == 1)
        for b in batches:
            ids, uids = _ids(b["id"]), np.asarray(b["uid"]).view(np.uint64)
            for slab in slabs(b["text"], NOT_SPACE):
                h, whole = _windows(slab, levels[0])
                yield from pack.add(h[whole], slab.text_of()[whole], uids[slab.rows], ids[slab.rows])
        yield from pack.flush()

    def longer(size: int, half: int, last: bool):
        def run(key, texts, found):
            pack, marks, out = Packer(n, n, last), _marks_of(found), []
            if len(marks) and len(texts):
                ids, uids = _ids(texts["id"]), np.asarray(texts["uid"]).view(np.uint64)
                for slab in slabs(_texts(texts), NOT_SPACE):
                    ok = _repeated(slab, uids, marks, half, False)
                    shift = size - half
                    both = np.zeros(len(ok), bool)
                    both[: len(ok) - shift] = ok[: len(ok) - shift] & ok[shift:]
                    h, whole = _windows(slab, size)
                    both &= whole
                    out += pack.add(h[both], slab.text_of()[both], uids[slab.rows], ids[slab.rows])
                out += pack.flush()
            return pa.Table.from_batches(out, pa.schema([("bucket", pa.int32()), ("pack", pa.binary())]))

        return run

    def cut(key, texts, found):
        marks, words_, removed, kept_ = _marks_of(found), [], [], []
        uids, data = np.asarray(texts["uid"]).view(np.uint64), _texts(texts)
        for slab in slabs(data, NOT_SPACE):
            hit = _repeated(slab, uids, marks, length, True) if len(marks) else np.zeros(len(slab.starts), bool)
            edge = np.zeros(len(hit) + length + 1, np.int64)
            edge[: len(hit)] += hit
            edge[length : length + len(hit)] -= hit
            gone = np.cumsum(edge)[: len(hit)] > 0
            for d in range(len(slab)):
                own = gone[slab.first[d] : slab.first[d + 1]]
                words = slab.data[slab.begins[d] : slab.begins[d + 1]].tobytes().split()
                words_.append(len(own))
                removed.append(int(own.sum()))
                kept_.append(b" ".join(compress(words, ~own) if own.any() else words))
        return pa.table({"id": texts["id"], "n_words": pa.array(words_, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept_text": pa.array(kept_, pa.binary()).cast(pa.string())})

    packs = rows.mapInArrow(first, "bucket int, pack binary")
    homes = packed_texts(rows, n)
    for at, size in enumerate(levels):
        last = at == len(levels) - 1
        marks = packs.groupBy("bucket").applyInArrow(_meet(n, n, last), "home int, marks binary")
        pair = homes.groupBy("home").cogroup(marks.groupBy("home"))
        if last:
            return pair.applyInArrow(cut, "id long, n_words long, n_removed long, kept_text string").withColumnRenamed("id", key)
        packs = pair.applyInArrow(longer(levels[at + 1], size, at + 1 == len(levels) - 1), "bucket int, pack binary")
    raise AssertionError("a ladder has at least one level")


_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS t FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
f AS (SELECT t, min(doc_id) AS first FROM win GROUP BY t),
h AS (SELECT doc_id, list(i) AS starts FROM win JOIN f USING (t) WHERE doc_id > first GROUP BY doc_id),
p AS (SELECT doc_id, list(DISTINCT s + k) AS gone FROM (SELECT doc_id, unnest(starts) AS s FROM h), range(13) r(k) GROUP BY doc_id),
o AS (SELECT doc_id, w, coalesce(gone, []) AS gone FROM d LEFT JOIN p USING (doc_id)),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM o) u
      WHERE NOT EXISTS (SELECT 1 FROM (SELECT doc_id, unnest(gone) AS i FROM o) g WHERE g.doc_id = u.doc_id AND g.i = u.i) GROUP BY doc_id)
SELECT o.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(gone) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM o LEFT JOIN k ON o.doc_id = k.doc_id
"""


@REGISTRY.query("op5_repeated_windows", _SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
