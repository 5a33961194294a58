"""Repeated passages through sparse suffix arrays.

Of every ``SPAN`` neighbouring K-grams the one of least hash is an anchor; any shared run of
``SPAN + K - 1`` words or more holds a common anchor. Only the suffixes that begin at anchors are kept,
and of these only those whose K-gram occurs in several documents. They are sorted by the words that
follow, and again by the words before. Suffixes that agree in r words after the anchor's beginning are
an interval of the first order, those that agree in l words before it one of the second; those that lie
in both hold the same window of l + r words. For every split of ``length`` words the least document of
each such class is taken, and the others' windows give spans: every window that a smaller document has
is found, whichever documents lie next to it in an order. Suffixes carry ``length`` words on
either side; a longer passage is covered by the spans of its anchors, which overlap and are joined.

Words around a suffix are carried as 16 bits of their hashes: windows are decided on all ``length`` of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshift.llm.common import REGISTRY, groups_for, split_by, table
from lakeshift.llm.decontaminate import selected
from lakeshift.llm.substring import Packer, _ids, _mark, _marks_of, _meet, _narrow, _texts, contained, packed_texts
from lakeshift.llm.words import NOT_SPACE, Slab, mixed, slabs, window_hashes

LENGTH, K, SPAN = 50, 8, 32
_FIXED = np.dtype([("gram", "<u8"), ("id", "<i8"), ("uid", "<u8"), ("at", "<u4"), ("before", "<u2"), ("after", "<u2")])


def anchors(slab: Slab, k: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors of all texts of a slab, and the hashes of their k-grams. A text too short for
    a whole span of k-grams has none; it cannot hold a passage of span + k - 1 words either."""
    if len(slab.starts) < span + k - 1:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    grams = window_hashes(slab.hashes, k)[: len(slab.hashes) - k + 1]
    at = selected(grams, span)
    at = np.unique(at[slab.left()[: len(at)] >= span + k - 1])
    return at, grams[at]


def _suffixes(slab: Slab, at, grams, uid, ids, length: int):
    """Records of suffixes with the words after and before them, the nearest first."""
    text = slab.text_of()[at]
    first, end = slab.first[text], slab.first[text + 1]
    fixed = np.zeros(len(at), _FIXED)
    fixed["gram"], fixed["id"], fixed["uid"], fixed["at"] = grams, ids[text], uid[text], at - first
    fixed["before"], fixed["after"] = np.minimum(at - first, length), np.minimum(end - at, length)
    codes = (slab.hashes & np.uint64(0xFFFF)).astype(np.uint16)
    steps = np.arange(length)
    right, left = at[:, None] + steps, at[:, None] - 1 - steps
    after = np.where(steps < fixed["after"][:, None], codes[np.minimum(right, len(codes) - 1)], 0).astype(np.uint16)
    before = np.where(steps < fixed["before"][:, None], codes[np.maximum(left, 0)], 0).astype(np.uint16)
    return fixed, after, before


def _order(fixed, after):
    """By the k-gram, the words that follow, and the document."""
    key = np.concatenate([fixed["gram"].astype(">u8").view(np.uint8).reshape(len(fixed), 8), after.astype(">u2").view(np.uint8).reshape(len(fixed), -1)], 1)
    by_id = np.argsort(fixed["id"], kind="stable")
    return by_id[np.argsort(np.ascontiguousarray(key[by_id]).view(f"S{key.shape[1]}").ravel(), kind="stable")]


def _common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Length of the common beginning of each pair of rows."""
    same = x == y
    return np.where(same.all(1), x.shape[1], same.argmin(1)) if len(x) else np.empty(0, np.int64)


def _sorted(fixed, side):
    """The order by k-gram and the words of a side, and for each place the words it has in common with the one before it (-1: another k-gram)."""
    order = _order(fixed, side)
    common = np.full(len(order) + 1, -1, np.int64)
    for part in np.array_split(np.arange(1, len(order)), len(order) // 50_000 + 1):
        x, y = order[part], order[part - 1]
        common[part] = np.where(fixed["gram"][x] == fixed["gram"][y], _common(side[x], side[y]), -1)
    longest = np.empty(len(order), np.int64)
    longest[order] = np.maximum(common[:-1], common[1:])
    return order, common[:-1], longest


def _classes(order, common, n_words: int):
    """For each suffix the number of its interval: those that agree in so many words."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(common < n_words)
    return out


def spans_of(fixed, after, before, length: int, k: int):
    """(id, uid, start, end, other) of the runs of windows of ``length`` words that a smaller document has too.

    A window with l words before its anchor is held by the suffixes that lie in one interval of the order of
    the words that follow (length - l of them) and in one of that of the words before (l)."""
    by_id = np.argsort(fixed["id"], kind="stable")
    fixed, after, before = fixed[by_id], after[by_id], before[by_id]
    n, ids = len(fixed), fixed["id"]
    right, left = _sorted(fixed, after), _sorted(fixed, before)
    most_right, most_left = np.minimum(right[2], fixed["after"]), np.minimum(left[2], fixed["before"])
    low, high, other = np.full(n, -1, np.int64), np.full(n, -2, np.int64), np.zeros(n, np.int64)
    out = []

    def done(x):
        at = fixed["at"][x].astype(np.int64)
        out.append(np.stack([ids[x], fixed["uid"][x].view(np.int64), at - high[x], at - low[x] + length, other[x]], 1))

    for before_ in range(length - k + 1):
        x = np.flatnonzero((most_right >= length - before_) & (most_left >= before_))
        pair = _classes(*right[:2], length - before_)[x] * (n + 1) + _classes(*left[:2], before_)[x]
        # the least document of a class is its first: suffixes are in the order of documents
        _, head, group = np.unique(pair, return_index=True, return_inverse=True)
        least = ids[x[head]][group]
        hit = ids[x] > least
        x, least = x[hit], least[hit]
        goes_on = high[x] == before_ - 1
        done(x[~goes_on & (low[x] >= 0)])
        low[x[~goes_on]], other[x[~goes_on]] = before_, least[~goes_on]
        other[x] = np.minimum(other[x], least)
        high[x] = before_
    done(np.flatnonzero(low >= 0))
    return np.concatenate(out)


def _merged(spans: np.ndarray) -> np.ndarray:
    """Overlapping spans of a text joined; of their smaller documents the least."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans[:, 2], spans[:, 0], spans[:, 1]))]
    out = []
    for s in spans.tolist():
        if out and out[-1][1] == s[1] and s[2] <= out[-1][3]:
            out[-1][3], out[-1][4] = max(out[-1][3], s[3]), min(out[-1][4], s[4])
        else:
            out.append(s)
    return np.array(out, np.int64)


_SPANS = ["id", "uid", "start", "end", "other"]


def repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, k: int = K, span: int = SPAN) -> DataFrame:
    """One row per repeated passage of a document: key, start_word, end_word (exclusive), n_words, first_id.

    A passage is a run of at least ``length`` words that a document of a smaller key has too; first_id is
    the smallest document it was compared with that has ``length`` words of it (suffixes alike in all they
    carry are combined per task before they are compared). Words are `[^\\x20\\x09-\\x0D]+`; keys are integers. Documents without
    repeated passages have no rows. Nulls: a null text has no words; a null key is greater than any
    other, so it is never a first_id while another is. Rows of equal key do not repeat each other; rows
    equal in key and text are reported once. Empty tables give no rows. Other columns are not looked at.
    """
    if span + k - 1 > length:
        raise ValueError("span + k - 1 must not exceed the length of a passage")
    uid = F.xxhash64(F.col(key), F.coalesce(F.col(text), F.lit("")))
    rows = docs.select(F.col(key).cast("long").alias("id"), uid.alias("uid"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n = groups_for(rows, "text", least=12)

    def first(batches):
        pack = Packer(n, n, False)
        for b in batches:
            ids, uids = _ids(b["id"]), np.asarray(b["uid"]).view(np.uint64)
            for slab in slabs(b["text"], NOT_SPACE):
                at, grams = anchors(slab, k, span)
                yield from pack.add(grams, slab.text_of()[at], uids[slab.rows], ids[slab.rows])
        yield from pack.flush()

    def survivors(key_, texts, found):
        marks, kinds = _marks_of(found), ([], [], [])
        schema = pa.schema([("bucket", pa.int32()), ("pack", pa.binary())])
        if not len(marks) or not len(texts):
            return schema.empty_table()
        ids, uids = _ids(texts["id"]), np.asarray(texts["uid"]).view(np.uint64)
        for slab in slabs(_texts(texts), NOT_SPACE):
            at, grams = anchors(slab, k, span)
            own_uid, own_id = uids[slab.rows], ids[slab.rows]
            ok = contained(_mark(_narrow(grams, False), own_uid[slab.text_of()[at]]), marks)
            for kind, part in zip(kinds, _suffixes(slab, at[ok], grams[ok], own_uid, own_id, length)):
                kind.append(part)
        fixed, after, before = (np.concatenate(x) for x in kinds)
        # suffixes alike in all the words they carry: the one of the least document stands for them
        order = np.argsort(fixed["id"], kind="stable")
        fixed, after, before = fixed[order], after[order], before[order]
        alike = np.zeros(len(fixed), np.uint64)
        for x in (after, before):
            for c in range(0, length, 25):
                alike = mixed(alike + mixed((x[:, c : c + 25].astype(np.uint64) * (np.arange(1, x[:, c : c + 25].shape[1] + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1))).sum(1, dtype=np.uint64)))
        alike = mixed(alike ^ fixed["gram"])
        _, head, group = np.unique(alike, return_index=True, return_inverse=True)
        later = (fixed["id"] > fixed["id"][head][group]) & (fixed["after"].astype(np.int64) + fixed["before"] >= length)
        spans = np.stack([x.astype(np.int64) for x in (fixed["id"], fixed["uid"].view(np.int64), fixed["at"].astype(np.int64) - fixed["before"], fixed["at"].astype(np.int64) + fixed["after"], fixed["id"][head][group])], 1)[later]
        spans = _merged(spans)
        fixed, after, before = fixed[~later], after[~later], before[~later]
        bucket = (mixed(fixed["gram"]) % np.uint64(n)).astype(np.int64)
        packs = [(b, np.int64(len(at)).tobytes() + fixed[at].tobytes() + after[at].tobytes() + before[at].tobytes()) for b, at in enumerate(split_by(bucket, n)) if len(at)]
        if len(spans):
            packs.append((n + int(key_[0].as_py()), spans.tobytes()))
        return pa.table({"bucket": pa.array([b for b, _ in packs], pa.int32()), "pack": pa.array([p for _, p in packs], pa.binary())})

    def compare(key_, packs):
        blobs = packs["pack"].to_pylist()
        if key_[0].as_py() >= n:
            spans = np.concatenate([np.frombuffer(p, np.int64).reshape(-1, 5) for p in blobs])
        else:
            parts = ([], [], [])
            for p in blobs:
                m = int(np.frombuffer(p, np.int64, 1)[0])
                a, b = 8 + m * _FIXED.itemsize, 8 + m * _FIXED.itemsize + 2 * m * length
                for part, x in zip(parts, (np.frombuffer(p, _FIXED, m, 8), np.frombuffer(p, np.uint16, m * length, a), np.frombuffer(p, np.uint16, m * length, b))):
                    part.append(x if x.dtype == _FIXED else x.reshape(m, length))
            spans = _merged(spans_of(*(np.concatenate(x) for x in parts), length, k))
        return pa.table({c: pa.array(spans[:, i], pa.int64()) for i, c in enumerate(_SPANS)})

    marks = rows.mapInArrow(first, "bucket int, pack binary").groupBy("bucket").applyInArrow(_meet(n, n, False), "home int, marks binary")
    packs = packed_texts(rows, n).groupBy("home").cogroup(marks.groupBy("home")).applyInArrow(survivors, "bucket int, pack binary")
    spans = packs.groupBy("bucket").applyInArrow(compare, ", ".join(f"{c} long" for c in _SPANS))
    before = Window.partitionBy("uid", "id").orderBy("start", "end", "other").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("uid", "id").orderBy("start", "end", "other").rowsBetween(Window.unboundedPreceding, 0)
    new = (F.col("start") > F.coalesce(F.max("end").over(before), F.lit(-1))).cast("int")
    spans = spans.withColumn("new", new).withColumn("passage", F.sum("new").over(upto))
    out = spans.groupBy("uid", "id", "passage").agg(F.min("start").alias("start_word"), F.max("end").alias("end_word"), F.min("other").alias("other"))
    no = F.lit(np.iinfo(np.int64).max)
    return out.select(
        F.when(F.col("id") != no, F.col("id")).alias(key),
        "start_word",
        "end_word",
        (F.col("end_word") - F.col("start_word")).alias("n_words"),
        F.when(F.col("other") != no, F.col("other")).alias("first_id"),
    )


@REGISTRY.query("op9_repeated_passages")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))
