"""N-gram Jaccard join through prefix trees.

Texts become sets of hashed word n-grams, ordered by hash, one global order. Equal sets are joined by
their fingerprint; what follows sees each set once.

Candidates. Two sets that share i elements and differ in m have, in the global order of their union,
at most m + 1 runs of shared elements, so one run is as long as i / (m + 1); the similarity asked for
bounds that from below. A run stands side by side in both sets. So each set emits the hashes of r
neighbouring elements, thinned out by keeping the least of every w neighbours: no run of r + w - 1
shared elements goes without a common one. Sets that have one in common are listed together.

Chance hits. Each set has a bitmap of about two bits an element, in which an element flips one bit. Two
bitmaps differ in no more places than their sets differ in elements, so pairs of a list that differ in
too many cannot link and are let go; what is left of the lists connects sets to clusters. Lists of more than
``LONG`` sets, and those of which more than ``CROWD`` sets met in one task already, are combined before the
shuffle and connected as they stand: that makes clusters larger, never smaller.

Join. The sets of a cluster are stored in a trie in the global order. A set walks down all branches
at once; the overlap with a shared beginning is counted once for all sets below it, and a subtree is
left when the elements that remain cannot reach the overlap asked for, or when all of it is known to
be in the walker's component already. Links are decided on whole sets.

Clusters of more than ``BLOCK`` sets, or of more than ``ELEMENTS`` elements in all, are cut into blocks of sets of like size, each joined by itself; then the blocks'
largest components are joined through one set of each; and whatever still stands apart from its
cluster's largest component is walked through the tries of all blocks of sizes that it could link with. So the result is exact, a group
of near copies that holds a third of the table costs a few walks per set, and no task holds more than
a block: sets are made from their texts one block at a time, walkers a few texts at a time, and a block
that many walk through is given to several tasks, ``TURN`` blocks' worth of walkers to each.
"""

from __future__ import annotations

from bisect import bisect_right
from fractions import Fraction
from math import ceil

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.llm.common import REGISTRY, groups_for, kept, split_by, table
from lakeshift.llm.components import components
from lakeshift.llm.decontaminate import selected
from lakeshift.llm.words import NOT_SPACE, mixed, slabs, window_hashes

BLOCK = 1000
ELEMENTS = 2_000_000
PACK = 1_000_000
TURN = 8
FEW = 100_000  # ids that may be broadcast
CROWD = 64
LONG = 512
BITMAP_BITS = 1 << 16  # at most, for the largest sets
UNPACKED = 1 << 22  # bytes of text that are turned into sets at once


# ------------------------------------------------------------------ sets


def text_sets(texts: pa.Array, n: int):
    """The sorted set of hashed n-grams of each text; of a text of fewer words, its whole sequence."""
    for slab in slabs(texts, NOT_SPACE, lower=True):
        grams = window_hashes(slab.hashes, n)
        for lo, hi in zip(slab.first[:-1].tolist(), slab.first[1:].tolist()):
            if hi - lo >= n:
                yield np.unique(grams[lo : hi - n + 1])
            elif hi > lo:
                yield window_hashes(slab.hashes[lo:hi], hi - lo)[:1]
            else:
                yield grams[:0]


def set_id(s: np.ndarray) -> int:
    """A 64-bit fingerprint of a set, as a signed number."""
    return int(mixed(np.add.reduce(mixed(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)), keepdims=True) + np.uint64(len(s)))[0].astype(np.int64))


def enough(shared, a, b, num: int, den: int):
    """Is the similarity of sets of a and b elements with so many shared at least num / den?"""
    return shared * (num + den) >= num * (a + b)


# ------------------------------------------------------------------ candidates


def schemes(num: int, den: int) -> list[tuple[int, int, int, float]]:
    """(r, w, least size, greatest size): what a set of a size emits. Linked sets agree in one scheme.

    With ratio = num / (den - num), sets that share i elements and differ in m >= 1 have m <= i / ratio, so a run of at least
    i / (m + 1) >= ratio * i / (i + ratio) elements. That rounds up to ``long_run``, the ratio rounded up, once i exceeds
    ``enough_shared``; linked sets share num / den of the larger, so sets from ``floor`` on do. The second scheme is for small
    sets: there m >= 1 alone gives runs of half the ratio. At num = den only equal sets link, which need no candidates.
    """
    if num == den:
        return []
    ratio = Fraction(num, den - num)
    long_run = max(1, ceil(ratio))
    enough_shared = (long_run - 1) * ratio / (ratio - (long_run - 1))
    floor = int(enough_shared * den / num) + 1
    short_run = max(1, ceil(ratio / 2))
    r_long = long_run if long_run <= 4 else (long_run + 1) // 2  # long enough that a shared passage alone seldom makes one
    return [(r_long, long_run - r_long + 1, floor, np.inf), (short_run, 1, long_run, floor * den / num)]


def signatures(sets: list[np.ndarray], num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and the number of the set that each is of."""
    sizes = np.array([len(s) for s in sets], np.int64)
    out_h, out_s = [], []
    for tag, (r, w, least, most) in enumerate(schemes(num, den)):
        use = np.flatnonzero((sizes >= least) & (sizes < most))
        if not len(use):
            continue
        flat = np.concatenate([sets[i] for i in use])
        ends = np.repeat(np.cumsum(sizes[use]), sizes[use])
        owner = np.repeat(use, sizes[use])
        left = ends - np.arange(len(flat))
        runs = window_hashes(flat, r, seed=tag + 1)
        at = selected(runs, w)
        at = np.unique(at[left[: len(at)] >= r + w - 1])
        out_h.append(runs[at])
        out_s.append(owner[at])
    if not out_h:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(out_h), np.concatenate(out_s)


def _edge_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    pairs = np.unique(np.stack([a, b], 1), axis=0) if len(a) else np.empty((0, 2), np.int64)
    return pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([pairs.astype(np.int64).tobytes()], pa.binary())], ["bucket", "pack"])


def _lists(h: np.ndarray, sid: np.ndarray, sure: np.ndarray):
    """The distinct entries (hash, set, sure) in order, and where the list of each hash begins."""
    order = np.lexsort((~sure, sid, h))
    h, sid, sure = h[order], sid[order], sure[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (sid[1:] != sid[:-1])
    h, sid, sure = h[new], sid[new], sure[new]
    first = np.ones(len(h), bool)
    first[1:] = h[1:] != h[:-1]
    return h, sid, sure, np.flatnonzero(first)


def _stars(sid: np.ndarray, starts: np.ndarray, crowded: np.ndarray):
    """Edges from each entry of a crowded list to the first of its list."""
    sizes = np.diff(np.append(starts, len(sid)))
    hub = np.repeat(sid[starts], sizes)
    apart = np.repeat(crowded, sizes) & (sid != hub)
    return sid[apart], hub[apart]


def _emit(sets, ids, buckets, num, den):
    h, s = signatures(sets, num, den)
    h, sid, sure, starts = _lists(h, np.array(ids, np.int64)[s], np.zeros(len(h), bool))
    sizes = np.diff(np.append(starts, len(h)))
    crowded = sizes > CROWD
    a, b = _stars(sid, starts, crowded)
    if len(a):
        yield _edge_batch(a, b)
    stays = ~np.repeat(crowded, sizes)
    stays[starts] = True  # the first of a crowded list stands for it
    sure[starts] = crowded
    h, sid, sure = h[stays], sid[stays], sure[stays]
    bucket, rows = (mixed(h) % np.uint64(buckets)).astype(np.int64), []
    for flag in (False, True):
        use = np.flatnonzero(sure == flag)
        use = use[np.lexsort((sid[use], bucket[use]))]
        cuts, low = np.searchsorted(bucket[use], np.arange(buckets + 1)), h.astype(np.uint32)
        for i, (lo, hi) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
            if hi > lo:
                names, counts = np.unique(sid[use[lo:hi]], return_counts=True)
                head = np.array([len(names), flag], np.int64).tobytes()
                rows.append((i, head + names.tobytes() + counts.astype(np.uint32).tobytes() + low[use[lo:hi]].tobytes()))
    yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int32()), pa.array([p for _, p in rows], pa.binary())], ["bucket", "pack"])


def _candidates(key, rows):
    """Of a bucket, the edges of its crowded lists and the distinct other lists; of packs of edges, their edges."""
    packs, members = rows["pack"].to_pylist(), []
    if key[0].as_py() == -1:
        pairs = np.concatenate([np.frombuffer(p, np.int64).reshape(-1, 2) for p in packs])
    else:
        hashes, ids, flags = [], [], []
        for p in packs:
            n, flag = np.frombuffer(p, np.int64, 2).tolist()
            hashes.append(np.frombuffer(p, np.uint32, -1, 16 + 12 * n))
            ids.append(np.repeat(np.frombuffer(p, np.int64, n, 16), np.frombuffer(p, np.uint32, n, 16 + 8 * n)))
            flags.append(np.full(len(hashes[-1]), bool(flag)))
        _, sid, sure, starts = _lists(np.concatenate(hashes), np.concatenate(ids), np.concatenate(flags))
        sizes = np.diff(np.append(starts, len(sid)))
        crowded = (sizes > LONG) | np.logical_or.reduceat(sure, starts)
        pairs = np.stack(_stars(sid, starts, crowded), 1)
        prints = np.add.reduceat(mixed(sid.view(np.uint64)), starts)
        use = np.flatnonzero(~crowded & (sizes > 1))
        use = use[np.unique(prints[use], return_index=True)[1]]
        members = [sid[starts[i] : starts[i] + sizes[i]] for i in use.tolist()]
    pairs = np.unique(pairs, axis=0)
    a, b = (np.concatenate([pairs[:, i], np.zeros(len(members), np.int64)]) for i in (0, 1))
    lists = [None] * len(pairs) + members
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "members": pa.array(lists, pa.list_(pa.int64()))})


# ------------------------------------------------------------------ chance hits


def bitmap(s: np.ndarray) -> bytes:
    """One to four bits an element (``BITMAP_BITS`` at most, 64 at least), a power of two; each element flips one."""
    bits = min(BITMAP_BITS, max(64, 1 << int(1.6 * len(s)).bit_length()))
    at = (mixed(s ^ np.uint64(0x5A5A5A5A5A5A5A5A)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=bits) & 1).tobytes()


def _folded(bits: bytes, to: int) -> np.ndarray:
    """A bitmap of ``to`` bytes of the same set: bits that fall together flip each other."""
    return np.bitwise_xor.reduce(np.frombuffer(bits, np.uint64).reshape(-1, to // 8), axis=0)


def close(sizes: np.ndarray, maps: list[bytes], num: int, den: int) -> list[tuple[int, int]]:
    """Enough pairs to connect all sets whose sizes and bitmaps do not rule a link out."""
    length, n = np.array([len(m) for m in maps]), len(maps)
    may = np.zeros((n, n), bool)
    for k in np.unique(length).tolist():
        here, near = np.flatnonzero(length == k), np.flatnonzero((length >= k) & (length * num <= 2 * k * den))
        a, b = np.stack([_folded(maps[i], k) for i in here]), np.stack([_folded(maps[i], k) for i in near])
        step = max(1, (1 << 19) // b.size)
        for lo in range(0, len(here), step):
            rows = here[lo : lo + step]
            differ = np.bitwise_count(a[lo : lo + step, None] ^ b[None]).sum(-1, dtype=np.int64)
            x, y = sizes[rows][:, None], sizes[near][None]
            may[np.ix_(rows, near)] = (differ * (num + den) <= (x + y) * (den - num)) & (np.minimum(x, y) * den >= np.maximum(x, y) * num)
    may |= may.T
    labels, out = np.arange(n), []
    for i in range(n):
        for j in (np.flatnonzero(may[i, i + 1 :] & (labels[i + 1 :] != labels[i])) + i + 1).tolist():
            if labels[j] != labels[i]:
                out.append((i, j))
                labels[labels == labels[j]] = labels[i]
    return out


# ------------------------------------------------------------------ tries


class Trie:
    """A trie of distinct sets, given as sorted arrays of numbers; a node holds all elements up to the next branch.

    Long nodes are cut at some fractions of the size of the largest set, so that a walker of which too many
    elements have been passed without being shared leaves after the first of these. Nodes lie level by level in arrays, the children of a node side by side, the sets below it too."""

    def __init__(self, sets: list[np.ndarray]):
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">i8").tobytes())
        self.sets = [sets[i] for i in self.order]
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        offsets = np.concatenate(([0], np.cumsum(self.sizes)))
        self.flat = np.concatenate(self.sets)
        common = [0]
        for x, y in zip(self.sets, self.sets[1:]):
            n = min(len(x), len(y))
            differ = np.flatnonzero(x[:n] != y[:n])
            common.append(int(differ[0]) if len(differ) else n)
        common = np.array(common + [0])
        stops = [*(max(1, int(self.sizes.max()) * part // 32) for part in (2, 4, 8, 16)), np.iinfo(np.int64).max]
        nodes, level = [], [(0, len(self.sets), 0)]
        while level:
            below, at = [], len(nodes) + len(level)
            for lo, hi, depth in level:
                inner = common[lo + 1 : hi]
                end, stop = int(self.sizes[lo] if hi - lo == 1 else inner.min()), stops[bisect_right(stops, depth)]
                if end > stop:
                    end, kids = stop, [(lo, hi)]
                elif hi - lo == 1:
                    kids = []
                else:
                    cuts = [lo, *(np.flatnonzero(inner == end) + lo + 1).tolist(), hi]
                    kids = list(zip(cuts, cuts[1:]))
                nodes.append((lo, hi, offsets[lo] + depth, end - depth, end, at + len(below), len(kids)))
                below += [(a, b, end) for a, b in kids]
            level = below
        self.lo, self.hi, self.start, self.length, self.end, self.child, self.kids = np.array(nodes, np.int64).T
        bounds = np.stack([self.lo, self.hi], 1).ravel()
        padded = np.append(self.sizes, 0)
        self.small, self.big = np.minimum.reduceat(np.append(self.sizes, 1 << 60), bounds)[::2], np.maximum.reduceat(padded, bounds)[::2]

    def links(self, x: np.ndarray, member: np.ndarray, labels: np.ndarray, own: int, num: int, den: int, after: int = -1) -> np.ndarray:
        """Places of the sets that link with x and are not labelled ``own``; only those beyond the place ``after``.

        ``member``: booleans over all numbers, true for those in x."""
        found, node, have = [], np.array([0]), np.array([0])
        padded_low, padded_high = np.append(labels, np.iinfo(np.int64).max), np.append(labels, np.iinfo(np.int64).min)
        while len(node):
            bounds = np.stack([self.lo[node], self.hi[node]], 1).ravel()
            same = (np.minimum.reduceat(padded_low, bounds)[::2] == own) & (np.maximum.reduceat(padded_high, bounds)[::2] == own)
            go = ~same & (self.hi[node] > after + 1)
            node, have = node[go], have[go]
            if not len(node):
                break
            length = self.length[node]
            total = int(length.sum())
            if total:
                starts = np.cumsum(length) - length
                flags = member[self.flat[np.repeat(self.start[node] - starts, length) + np.arange(total)]]
                sums = np.concatenate(([0], np.cumsum(flags)))
                have = have + sums[starts + length] - sums[starts]
            last = self.flat[np.maximum(self.start[node] + length - 1, 0)]
            passed = np.where(self.end[node] > 0, np.searchsorted(x, last, side="right"), 0)
            most = have + np.minimum(self.big[node] - self.end[node], len(x) - passed)
            go = enough(most, len(x), self.small[node], num, den)
            node, have = node[go], have[go]
            leaf = self.kids[node] == 0
            hit = leaf & enough(have, len(x), self.sizes[self.lo[node]], num, den)
            found.append(self.lo[node[hit]])
            node, have = node[~leaf], have[~leaf]
            kids = self.kids[node]
            starts = np.cumsum(kids) - kids
            node = np.repeat(self.child[node] - starts, kids) + np.arange(int(kids.sum()))
            have = np.repeat(have, kids)
        return np.concatenate(found) if found else np.empty(0, np.int64)


def _dense(sets: list[np.ndarray]) -> tuple[list[np.ndarray], int]:
    """The same sets with their elements numbered from 0 in the global order."""
    names, at = np.unique(np.concatenate(sets), return_inverse=True)
    return np.split(at, np.cumsum([len(s) for s in sets])[:-1]), len(names)


def join_sets(sets: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """For each of some distinct sets a number; equal numbers for those connected by links."""
    dense, n = _dense(sets)
    trie, member = Trie(dense), np.zeros(n, bool)
    labels = np.arange(len(sets))
    for i, x in enumerate(trie.sets):
        member[x] = True
        for j in trie.links(x, member, labels, labels[i], num, den, after=i).tolist():
            if labels[j] != labels[i]:
                labels[labels == labels[j]] = labels[i]
        member[x] = False
    out = np.empty(len(sets), np.int64)
    out[trie.order] = labels
    return out


def probe_sets(sets, labels, probes, probe_labels, num: int, den: int) -> list[tuple[int, int]]:
    """(probe, set) links between sets of different labels, enough to connect what links. Probes may come one by one.

    An element of a probe that no set has stands at the place of the next greater one, without being a member."""
    names = np.unique(np.concatenate(sets))
    trie, member, links = Trie([np.searchsorted(names, s) for s in sets]), np.zeros(len(names), bool), []
    order = np.array(trie.order)
    known, own = labels[order].copy(), probe_labels.copy()
    for i, probe in enumerate(probes):
        x = np.searchsorted(names, probe)
        there = x[names[np.minimum(x, len(names) - 1)] == probe]
        member[there] = True
        for j in trie.links(x, member, known, own[i], num, den).tolist():
            if known[j] != own[i]:
                links.append((i, int(order[j])))
                old, new = known[j], own[i]
                known[known == old] = new
                own[own == old] = new
        member[there] = False
    return links


# ------------------------------------------------------------------ the join


def linked(docs: DataFrame, n: int, num: int, den: int, key: str = "doc_id", text: str = "text", block: int = BLOCK, elements: int = ELEMENTS, prints: bool = False) -> DataFrame:
    """One row per row of ``docs``: key, n_shingles, component_id, the least key reachable by links.

    A-Z are lower-cased; words are `[^\\x20\\x09-\\x0D]+`; a set holds the distinct n-grams of words, or
    the whole sequence of a shorter text; two rows link when shared / union >= num / den. Keys are
    integers. Nulls: a null text has an empty set, as has an empty one, and links with nothing (its
    component is its own key); a null key is never the least of others, and the component of rows
    without keys is null. Rows of equal key are rows like others. Empty tables give no rows. Other
    columns are not looked at. ``prints`` adds a column ``print``, the hash of the text (null as empty),
    which tells rows of equal key apart.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    groups = groups_for(rows, "text", least=12)
    extra = ["print"] if prints else []
    printed = rows.withColumn("print", F.xxhash64("text")) if prints else rows

    def measure(batches):
        for b in batches:
            sets = list(text_sets(b["text"], n))
            sids, bits = [set_id(s) if len(s) else None for s in sets], [bitmap(s) if len(s) else None for s in sets]
            columns = [b["key"], pa.array([len(s) for s in sets], pa.int64()), pa.array(sids, pa.int64()), pa.array(bits, pa.binary()), *(b[c] for c in extra)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "n_shingles", "sid", "bits", *extra])

    def emit(batches):
        sets, ids, count = [], [], 0
        for b in batches:
            for s in text_sets(b["text"], n):
                if len(s):
                    sets.append(s)
                    ids.append(set_id(s))
                    count += len(s)
                    if count >= PACK:
                        yield from _emit(sets, ids, groups, num, den)
                        sets, ids, count = [], [], 0
        if sets:
            yield from _emit(sets, ids, groups, num, den)

    measured = kept(printed.mapInArrow(measure, ", ".join(["key long, n_shingles long, sid long, bits binary", *(f"{c} long" for c in extra)])))
    packs = rows.select("text").mapInArrow(emit, "bucket int, pack binary")
    spread = F.when(F.col("bucket") < 0, F.pmod(F.xxhash64("pack"), F.lit(groups))).otherwise(F.lit(0)).alias("part")
    found = kept(packs.withColumn("part", spread).groupBy("bucket", "part").applyInArrow(_candidates, "a long, b long, members array<long>"))
    listed = found.where("members is not null").select("members").distinct()
    listed = listed.select(F.xxhash64("members").alias("list"), F.explode("members").alias("sid"))
    maps = measured.where("sid is not null").select("sid", "n_shingles", "bits").dropDuplicates(["sid"])
    listed = listed.join(maps, "sid").withColumn("place", F.pmod(F.xxhash64("list"), F.lit(groups)).cast("int"))

    def compare(key, rows_):
        lists, sids, sizes, bits = (rows_[c].combine_chunks() for c in ("list", "sid", "n_shingles", "bits"))
        lists, sids, sizes = (c.to_numpy(zero_copy_only=False) for c in (lists, sids, sizes))
        order = np.argsort(lists, kind="stable")
        a, b = [], []
        for at in np.split(order, np.flatnonzero(np.diff(lists[order])) + 1):
            for i, j in close(sizes[at], [bits[k].as_py() for k in at.tolist()], num, den):
                a.append(sids[at[i]])
                b.append(sids[at[j]])
        pairs = np.unique(np.stack([np.array(a, np.int64), np.array(b, np.int64)], 1), axis=0)
        return pa.table({"a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64())})

    edges = listed.groupBy("place").applyInArrow(compare, "a long, b long")
    clusters = components(edges.unionByName(found.where("members is null").select("a", "b")))

    firsts = measured.where("sid is not null").groupBy("sid").agg(F.min("key").alias("key"), F.min("n_shingles").alias("n_shingles"))
    # classes of sizes a little wider than the ratio that links can span, so a link reaches the next class at most
    of_size = F.floor(F.log(F.col("n_shingles")) / float(np.log(den / num)) * 0.999).cast("int") if num < den else F.col("n_shingles").cast("int")
    def cuts(blocks: int = 1) -> Column:
        return F.ceil(F.greatest(F.count(F.lit(1)) / (blocks * block), F.sum("n_shingles") / (blocks * elements))).cast("int")

    members = clusters.select(F.col("node").alias("sid"), F.col("root").alias("cluster")).join(firsts, "sid")
    sized = members.groupBy("cluster").agg((cuts() > 1).alias("large"))
    members = members.join(sized, "cluster").withColumn("class", F.when(F.col("large"), of_size).otherwise(F.lit(0)))
    counts = members.groupBy("cluster", "class").agg(cuts().alias("blocks"))
    wanted = members.join(counts, ["cluster", "class"]).withColumn("block", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))
    names = ["sid", "cluster", "large", "class", "blocks", "block", "n_shingles"]
    wanted = kept(wanted.select(*names, F.col("key").alias("_key")))

    def squeeze(batches):
        z = zstandard.ZstdCompressor(level=1)
        for b in batches:
            ids = pa.array([set_id(s) if len(s) else None for s in text_sets(b["text"], n)], pa.int64())
            texts = [z.compress(t.as_buffer().to_pybytes()) for t in b["text"].cast(pa.large_binary())]
            out = pa.RecordBatch.from_arrays([b["key"], ids, pa.array(texts, pa.binary())], ["_of", "sid", "z"])
            yield out.filter(ids.is_valid())

    squeezed = rows.mapInArrow(squeeze, "_of long, sid long, z binary")
    same = (squeezed["sid"] == wanted["sid"]) & F.col("_of").eqNullSafe(F.col("_key"))
    held = kept(squeezed.join(wanted, same).select(*(wanted[c] for c in names), "z"))

    def sets_of(rows_, at: list[int]):
        z, texts, size = zstandard.ZstdDecompressor(), [], 0
        for i in at:
            texts.append(z.decompress(rows_["z"][i].as_py()))
            size += len(texts[-1])
            if size >= UNPACKED:
                yield from text_sets(pa.array(texts, pa.large_binary()), n)
                texts, size = [], 0
        yield from text_sets(pa.array(texts, pa.large_binary()), n)

    def each(rows_, by):
        """Rows of one group of a packed exchange, split by their own group; of a repeated sid the first."""
        at: dict[tuple, dict[int, int]] = {}
        for i, (k, sid) in enumerate(zip(zip(*(rows_[c].to_pylist() for c in by)), rows_["sid"].to_pylist())):
            at.setdefault(k, {}).setdefault(sid, i)
        for k, mine in at.items():
            yield k, list(mine), list(sets_of(rows_, list(mine.values())))

    def join_blocks(by):
        def run(key, rows_):
            out = []
            for k, ids, sets in each(rows_, by):
                labels = join_sets(sets, num, den) if len(sets) > 1 else np.zeros(1, np.int64)
                least: dict[int, int] = {}
                for label, sid in zip(labels.tolist(), ids):
                    least[label] = min(sid, least.get(label, sid))
                out += [(k[0], sid, least[label]) for label, sid in zip(labels.tolist(), ids)]
            return pa.table({c: pa.array([x[i] for x in out], pa.int64()) for i, c in enumerate(("cluster", "sid", "root"))})

        return run

    place = F.pmod(F.xxhash64("cluster", "class", "block"), F.lit(groups)).cast("int")
    shape = "cluster long, sid long, root long"
    inner = held.withColumn("place", place).groupBy("place").applyInArrow(join_blocks(("cluster", "class", "block")), shape)
    inner = kept(inner)
    links = inner.select(F.col("sid").alias("a"), F.col("root").alias("b")).where("a <> b")

    if wanted.where("large").limit(1).count():
        large = wanted.where("large").drop("_key")
        count = inner.join(large.select("sid", "class", "block"), "sid").groupBy("cluster", "class", "block", "root").agg(F.count(F.lit(1)).alias("n"))
        best = count.groupBy("cluster", "class", "block").agg(F.max(F.struct("n", "root"))["root"].alias("sid"))
        best = kept(best.select("sid"))
        best = F.broadcast(best) if best.count() <= FEW else best
        heads = held.join(best, "sid", "left_semi").withColumn("place", F.pmod(F.xxhash64("cluster"), F.lit(groups)).cast("int"))
        across = heads.groupBy("place").applyInArrow(join_blocks(("cluster",)), shape)
        links = kept(links.unionByName(across.select(F.col("sid").alias("a"), F.col("root").alias("b")).where("a <> b")))

        so_far = components(links)
        tagged = large.join(so_far.select(F.col("node").alias("sid"), "root"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
        weight = tagged.groupBy("cluster", "root").agg(F.count(F.lit(1)).alias("n"))
        main = weight.groupBy("cluster").agg(F.max(F.struct("n", "root"))["root"].alias("main"), F.count(F.lit(1)).alias("kinds"))
        tagged = kept(tagged.join(main.where("kinds > 1"), "cluster"))
        walkers = tagged.where("root <> main").drop("blocks", "block").withColumn("class", F.explode(F.array(F.col("class") - 1, F.col("class"), F.col("class") + 1)))
        turns = walkers.groupBy("cluster", "class").agg(cuts(TURN).alias("turns"))
        walkers = walkers.join(counts, ["cluster", "class"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        walkers = walkers.join(turns, ["cluster", "class"]).withColumn("turn", F.pmod(F.xxhash64(F.lit("turn"), "sid"), F.col("turns")).cast("int"))
        stays = tagged.join(turns, ["cluster", "class"]).withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)))
        both = stays.withColumn("walks", F.lit(False)).unionByName(walkers.withColumn("walks", F.lit(True)))
        both = both.select("cluster", "class", "block", "turn", "walks", "sid", "root").join(held.where("large").select("sid", "z"), "sid")
        both = both.withColumn("place", F.pmod(F.xxhash64("cluster", "class", "block", "turn"), F.lit(groups)).cast("int"))

        def walk(key, rows_):
            at: dict[tuple, tuple[dict[int, int], dict[int, int]]] = {}
            walks, sid, root = (rows_[c].to_pylist() for c in ("walks", "sid", "root"))
            for i, k in enumerate(zip(*(rows_[c].to_pylist() for c in ("cluster", "class", "block", "turn")))):
                at.setdefault(k, ({}, {}))[walks[i]].setdefault(sid[i], i)
            a, b = [], []
            pick = lambda x, of: np.array([x[i] for i in of], np.int64)
            for stay, move in ([list(x.values()) for x in both_] for both_ in at.values()):
                if stay and move:
                    for i, j in probe_sets(list(sets_of(rows_, stay)), pick(root, stay), sets_of(rows_, move), pick(root, move), num, den):
                        a.append(sid[move[i]])
                        b.append(sid[stay[j]])
            return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

        links = links.unionByName(both.groupBy("place").applyInArrow(walk, "a long, b long"))

    final = components(links).select(F.col("node").alias("sid"), "root")
    of = firsts.join(final, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    least = of.groupBy("root").agg(F.min("key").alias("component_id"))
    named = kept(of.join(least, "root").select("sid", "component_id"))
    out = measured.drop("bits").join(named, "sid", "left")
    own = F.when(F.col("sid").isNull(), F.col("key")).otherwise(F.col("component_id"))
    return out.select(F.col("key").alias(key), "n_shingles", own.alias("component_id"), *extra)


@REGISTRY.query("op3_ngram_components")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(table(spark, sf_dir, "documents"), n=3, num=90, den=100)
