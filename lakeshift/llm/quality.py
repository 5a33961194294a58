"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents labelled good; unlabelled web text holds good and bad ones, the good
ones at a class prior that is estimated from the labels of the learning rows. A linear model over
features of a text's form minimises the non-negative unbiased risk

    prior * E_P[l(g)] + max(0, E_U[l(-g)] - prior * E_P[l(-g)])

with the logistic loss l. Negative labels are used for the prior alone.

The model is fitted on the driver on a sample of at most ``POSITIVE_ROWS`` positives and ``UNLABELLED_ROWS`` unlabelled
documents in expectation, chosen by a hash of their ids; every whole text is scored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.llm.common import REGISTRY, table
from lakeshift.llm.words import NOT_SPACE, byte_class, slabs

#: Rows to learn from, in expectation.
POSITIVE_ROWS, UNLABELLED_ROWS = 8_000, 8_000
ACCEPT = 0.7
ROUNDS, RATE, DECAY = 300, 0.05, 1e-4

_NOT_BREAK = byte_class(lambda b: b != 0x0A)
_MARKS = byte_class(lambda b: 0x21 <= b <= 0x2F or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7E)
_CAPITALS = byte_class(lambda b: 0x41 <= b <= 0x5A)
_DIGITS = byte_class(lambda b: 0x30 <= b <= 0x39)
#: Bytes are counted in this many kinds: each ASCII mark alone, and the others by class.
_KIND = np.zeros(256, np.int64)
for _b in range(256):
    if _MARKS[_b]:
        _KIND[_b] = 6 + int(np.count_nonzero(_MARKS[:_b]))
    else:
        _KIND[_b] = 0 if _b >= 0x80 else 1 if _CAPITALS[_b] else 2 if _DIGITS[_b] else 3 if 0x61 <= _b <= 0x7A else 4 if _b == 0x0A else 5
_KINDS = int(_KIND.max()) + 1


def features(texts: pa.Array) -> np.ndarray:
    """One row of numbers per text: byte kinds, marks at word ends, repeated words and lines, lengths. Empty texts have zeros."""
    out = []
    for slab, lines in zip(slabs(texts, NOT_SPACE), slabs(texts, _NOT_BREAK)):
        n, docs = len(slab), slab.text_of()
        words = np.maximum(np.diff(slab.first), 1).astype(np.float64)
        sizes = (slab.ends - slab.starts).astype(np.float64)

        def share(flags, of=docs, total=words, n=n):
            return np.bincount(of, weights=flags, minlength=n) / total

        owner = np.repeat(np.arange(n), np.diff(slab.begins))
        counts = np.bincount(owner * _KINDS + _KIND[slab.data], minlength=n * _KINDS).reshape(n, _KINDS)
        freq = counts / np.maximum(counts.sum(1, keepdims=True), 1)
        h, ends = slab.hashes, slab.data[slab.ends - 1] if len(slab.ends) else slab.data[:0]
        before_end = slab.data[np.maximum(slab.ends - 2, 0)] if len(slab.ends) else ends
        same = [np.zeros(len(h)) for _ in range(3)]
        for lag in (1, 2, 3):
            if len(h) > lag:
                same[lag - 1][lag:] = (h[lag:] == h[:-lag]) & (docs[lag:] == docs[:-lag])
        both = np.lexsort((lines.hashes, line_docs := lines.text_of()))
        again = np.zeros(len(both))
        if len(both) > 1:
            again[1:] = (lines.hashes[both][1:] == lines.hashes[both][:-1]) & (line_docs[both][1:] == line_docs[both][:-1])
        n_lines = np.maximum(np.diff(lines.first), 1)
        mean = share(sizes)
        out.append(
            np.column_stack(
                [
                    np.log1p(50 * freq),
                    share(_MARKS[ends]),
                    share(_MARKS[ends] & _MARKS[before_end] & (sizes > 1)),
                    share((sizes == 1) & _MARKS[ends]),
                    share(_CAPITALS[slab.data[slab.starts]] if len(slab.starts) else ends),
                    share(_CAPITALS[before_end] & (sizes > 2)),
                    *[share(s) for s in same],
                    np.bincount(line_docs[both], weights=again, minlength=n) / n_lines,
                    mean / 10,
                    np.sqrt(np.maximum(share(sizes**2) - mean**2, 0)) / 10,
                    np.log1p(np.diff(slab.first)) / 5,
                    np.log1p(np.diff(lines.first)) / 5,
                ]
            )
        )
    return np.concatenate(out) if out else np.empty((0, _KINDS + 13))


@dataclass
class Model:
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        g = np.clip(((x - self.center) / self.scale), -8, 8) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(g, -40, 40)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Model:
    """Minimise the non-negative risk by gradient steps (Adam). Without positives or unlabelled rows every score is the prior."""
    width = max(positive.shape[1], unlabelled.shape[1])
    prior = float(min(max(prior, 0.01), 1.0))
    if not len(positive) or not len(unlabelled):
        edge = 40.0 if prior == 1 else np.log(prior / (1 - prior))
        return Model(np.zeros(width), np.ones(width), np.zeros(width), float(edge), prior)
    prior = min(prior, 0.99)
    center, scale = unlabelled.mean(0), unlabelled.std(0) + 1e-3
    p = np.clip((positive - center) / scale, -8, 8)
    u = np.clip((unlabelled - center) / scale, -8, 8)
    w, m, v = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    p, u = np.column_stack([p, np.ones(len(p))]), np.column_stack([u, np.ones(len(u))])
    for step in range(1, ROUNDS + 1):
        gp, gu = p @ w, u @ w
        sp, su = 1 / (1 + np.exp(-gp)), 1 / (1 + np.exp(-gu))  # l(-g) has the slope sigmoid(g), l(g) the slope sigmoid(g) - 1
        negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        slope = u.T @ su / len(u) - prior * (p.T @ sp) / len(p)
        grad = prior * (p.T @ (sp - 1)) / len(p) + slope if negative >= 0 else -slope
        grad += DECAY * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w = w - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(center, scale, w[:-1], float(w[-1]), prior)


def held_out(key: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def _drawn(rows: DataFrame, bound: int, of: int) -> DataFrame:
    """Rows (key) at a rate that gives ``bound`` of ``of`` in expectation, chosen by a hash of their keys."""
    steps = 1 << 30
    draw = F.pmod(F.xxhash64(F.lit("sample"), F.col("key")), F.lit(steps))
    return rows.where(draw < int(min(1.0, bound / max(1, of)) * steps))


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    positives: int = POSITIVE_ROWS, unlabelled: int = UNLABELLED_ROWS,
) -> Model:
    """Fit on a sample of the rows that are not held out: so many trusted positives and so many rows without a label, each in expectation.

    The two are drawn apart, so few labels in a large table are all used. Where every row has a label, the unlabelled rows are
    drawn from all. A document with several labels counts as good only if all say so; null labels and rows without an
    id are left out; rows that share an id come together. Null and empty texts have features of zeros, texts of any length are
    read whole, and other columns are not. Without any label the prior is 1, and so is every score; without positives or rows
    (as in an empty table) every score is the prior.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.min(label).alias("good"))
    learn = known.where(~held_out("key"))
    ids = docs.where(F.col(key).isNotNull() & ~held_out(key)).select(F.col(key).alias("key"))
    counts = learn.agg(F.avg("good").alias("prior"), F.count_if(F.col("good") == 1).alias("good")).first()
    total = ids.join(learn, "key", "left").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("good").isNull()).alias("free")).first()
    trusted = _drawn(learn.where("good = 1").select("key"), positives, counts.good)
    rest = _drawn(ids, unlabelled, total.free or total.n)
    rest = rest.join(learn, "key", "left_anti") if total.free else rest
    chosen = trusted.select("key", F.lit(1).alias("good")).unionByName(rest.distinct().select("key", F.lit(0).alias("good")))
    # ids of the sample, whose size is bounded by the two parameters
    sample = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(chosen), "key")

    def run(batches):
        for b in batches:
            x = features(b["text"]).astype(np.float32)
            yield pa.RecordBatch.from_arrays([b["good"], pa.array([r.tobytes() for r in x], pa.binary())], ["good", "x"])

    got = sample.select("text", "good").mapInArrow(run, "good int, x binary").toArrow()
    x = np.frombuffer(b"".join(got["x"].to_pylist()), np.float32).reshape(-1, _KINDS + 13).astype(np.float64)
    good = got["good"].to_numpy() == 1
    return fit(x[good], x[~good], 1.0 if counts.prior is None else float(counts.prior))


def score(model: Model) -> Column:
    """A function of a text column: the score from 0 to 1 of each whole text, null and empty ones too."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores(features(texts)), pa.float64())

    return scored


@REGISTRY.query("op7_quality_scores")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out().alias("held_out"), score(model)("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))
