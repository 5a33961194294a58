"""Language identification by a linear-chain conditional random field.

Every word of a text is labelled with a language. A word's score for a language adds up the weights of its affixes (first and last
one to four bytes), of its n-grams (two and three bytes, with the word's edges), and of the lexicon entries it has; learned transitions
join it to its neighbours, so words that fit several languages go with the words around them, and texts that switch between
languages keep their parts. Forward-backward gives each word's probability of each language; the text's language is the one with
the largest sum, and the score is that sum's share.

The field is fitted on the driver, on at most ``LANG_ROWS`` documents and ``LANG_BYTES`` bytes of each language in expectation, chosen
by a hash of their ids. Sequences for learning are spliced from passages of several documents, so that transitions see switches.
Every whole text is then labelled, in tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.llm.common import REGISTRY, table
from lakeshift.llm.words import Slab, byte_class, mixed, slabs

#: Bounds of the sample of each language, in expectation.
LANG_ROWS, LANG_BYTES = 100, 1 << 19
#: Weights of affixes and n-grams live in a table of so many rows, addressed by hash.
ROWS_BITS = 16
#: A word belongs to a language's lexicon when so many of its sampled documents have it.
LEXICON_DOCUMENTS = 3
AFFIXES, GRAMS = (1, 2, 3, 4), (2, 3)
STEPS, RATE, DECAY = 25, 0.1, 1e-6
#: Words of a sequence for learning, and of a passage within it, on average.
SEQUENCE, PASSAGE = 64, 16
#: Words of a stretch that is handled step by step; longer texts are chains of stretches.
STRETCH = 128
UNKNOWN = "und"
#: Bytes of text labelled at once; a longer text is labelled alone.
SLAB = 1 << 21

_LETTERS = byte_class(lambda b: b >= 0x80 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def _lowered(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(texts.cast(pa.large_string()).fill_null(""))


def _features(words: Slab, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the weight table for the chosen words, one after the other, and how many each word has."""
    starts, ends = words.starts[which], words.ends[which]
    sizes = ends - starts
    data = words.data.astype(np.uint64)
    ids, owner = [], []
    number = np.arange(len(which))

    def add(kind: int, values: np.ndarray, of: np.ndarray) -> None:
        ids.append((mixed(values * np.uint64(64) + np.uint64(kind)) >> np.uint64(64 - ROWS_BITS)).astype(np.int64))
        owner.append(of)

    for n in AFFIXES:
        fit = np.flatnonzero(sizes >= n)
        for kind, at in ((n, starts[fit]), (8 + n, ends[fit] - n)):
            value = np.zeros(len(fit), np.uint64)
            for i in range(n):
                value = (value << np.uint64(8)) | data[at + i]
            add(kind, value, number[fit])
    # n-grams of the words with an edge mark on both sides
    padded = sizes + 2
    begins = np.concatenate(([0], np.cumsum(padded)))
    text = np.full(begins[-1], 0x20, np.uint64)
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    text[np.repeat(begins[:-1] + 1, sizes) + place] = data[np.repeat(starts, sizes) + place]
    of = np.repeat(number, padded)
    left = np.repeat(begins[1:], padded) - np.arange(begins[-1])
    for n in GRAMS:
        at = np.flatnonzero(left >= n)
        value = np.zeros(len(at), np.uint64)
        for i in range(n):
            value = (value << np.uint64(8)) | text[at + i]
        add(16 + n, value, of[at])
    ids, owner = np.concatenate(ids), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return ids[order], np.bincount(owner, minlength=len(which))


@dataclass
class Field:
    """Languages, weights of hashed features, the lexicon (sorted word hashes, membership by language, its weights), start and transition weights."""

    languages: list[str]
    weights: np.ndarray
    lexicon: np.ndarray
    member: np.ndarray
    by_member: np.ndarray
    start: np.ndarray
    moves: np.ndarray

    def emissions(self, words: Slab) -> np.ndarray:
        """The score of each word for each language; words that occur often in a slab are scored once."""
        unique, first, back = np.unique(words.hashes, return_index=True, return_inverse=True)
        ids, counts = _features(words, first)
        scores = _sums(self.weights[ids], counts)
        return (scores + self.known(unique) @ self.by_member)[back]

    def known(self, hashes: np.ndarray) -> np.ndarray:
        return _membership(self.lexicon, self.member, hashes)

    def marginals(self, words: Slab) -> np.ndarray:
        return forward_backward(self.emissions(words), words.first, self.start, self.moves)


def _membership(lexicon: np.ndarray, member: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    if not len(lexicon):
        return np.zeros((len(hashes), member.shape[1]))
    at = np.minimum(np.searchsorted(lexicon, hashes), len(lexicon) - 1)
    return member[at] * (lexicon[at] == hashes)[:, None]


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of rows; every run has a row at least."""
    if not len(counts):
        return np.zeros((0, values.shape[1]))
    return np.add.reduceat(values, np.concatenate(([0], np.cumsum(counts)[:-1])), axis=0)


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / x.sum(-1, keepdims=True)


def forward_backward(scores: np.ndarray, first: np.ndarray, start: np.ndarray, moves: np.ndarray, stretch: int = STRETCH) -> np.ndarray:
    """The probability of each label at each word, for texts that lie side by side (text d has the words first[d] to first[d + 1]).

    Texts are cut into stretches that are handled side by side, word by word. What a stretch does to any label before it is a matrix;
    the products of these matrices along a long text give what enters and leaves each stretch, so nothing is cut off."""
    n, labels = scores.shape
    if not n:
        return np.zeros((0, labels))
    emit = np.exp(scores - scores.max(1, keepdims=True))
    step = np.exp(moves - moves.max())
    begin = np.exp(start - start.max())
    lengths = np.diff(first)
    pieces = -(-lengths // stretch)
    text = np.repeat(np.arange(len(lengths)), pieces)
    number = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    at = first[:-1][text] + number * stretch
    size = np.minimum(first[1:][text] - at, stretch)
    order = np.argsort(-size, kind="stable")  # longest first: the stretches that still have words are the first ones
    at, size, number, text = at[order], size[order], number[order], text[order]
    active = np.searchsorted(-size, -np.arange(size[0]), side="left")  # stretches with more than so many words

    # 1. the matrix of each stretch of a text of several: its own words' scores, each after a move
    enter = np.tile(begin, (len(at), 1))
    leave = np.ones((len(at), labels))
    long = np.flatnonzero(pieces[text] > 1)
    if len(long):
        whole = np.tile(np.eye(labels), (len(at), 1, 1))
        for t in range(int(size[0])):
            k = active[t]
            rows = long[: np.searchsorted(long, k)]
            if not len(rows):
                break
            now = (whole[rows].reshape(-1, labels) @ step).reshape(-1, labels, labels)
            now *= emit[at[rows] + t][:, None, :]
            whole[rows] = now / now.sum((1, 2), keepdims=True)
        place = np.lexsort((number[long], text[long]))
        chain = long[place]
        depth = number[chain]
        last = pieces[text[chain]] - 1
        for d in range(int(depth.max()) + 1):
            rows = chain[(depth == d) & (last > d)]
            after = chain[np.flatnonzero((depth == d) & (last > d)) + 1]
            if d == 0:
                # the first word has no move before it: run through the first stretch as it is
                state = begin * emit[at[rows]]
                state = _scaled(state)
                for t in range(1, stretch):
                    state = _scaled((state @ step) * emit[at[rows] + t])
            else:
                state = _scaled(np.einsum("ni,nij->nj", enter[rows], whole[rows]))
            enter[after] = state
        for d in range(int(depth.max()), 0, -1):
            here = np.flatnonzero(depth == d)
            rows = chain[here]
            back = np.einsum("nij,nj->ni", whole[rows], leave[rows])
            leave[chain[here - 1]] = _scaled(back)

    # 2. within stretches: forward, then backward
    ahead = np.empty((n, labels))
    state = enter.copy()
    for t in range(int(size[0])):
        k = active[t]
        now = state[:k] if t == 0 else state[:k] @ step
        if t == 0:
            now = np.where((number == 0)[:, None], now, now @ step)
        now = _scaled(now * emit[at[:k] + t])
        state[:k] = now
        ahead[at[:k] + t] = now
    state = leave.copy()
    for t in range(int(size[0]) - 1, -1, -1):
        k = active[t]
        here = at[:k] + t
        now = ahead[here] * state[:k]
        state[:k] = _scaled((emit[here] * state[:k]) @ step.T)
        ahead[here] = _scaled(now)
    return ahead


def _paired(scores: np.ndarray, start: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sequences of equal length (sequence, word, label): label probabilities, and expected moves over all sequences."""
    emit = np.exp(scores - scores.max(2, keepdims=True))
    step, begin = np.exp(moves), np.exp(start)
    n, length, labels = emit.shape
    ahead = np.empty_like(emit)
    ahead[:, 0] = _scaled(begin * emit[:, 0])
    for t in range(1, length):
        ahead[:, t] = _scaled((ahead[:, t - 1] @ step) * emit[:, t])
    behind = np.ones((n, labels))
    out = np.empty_like(emit)
    expected = np.zeros((labels, labels))
    out[:, -1] = ahead[:, -1]
    for t in range(length - 2, -1, -1):
        right = emit[:, t + 1] * behind
        scale = 1 / np.einsum("ni,ij,nj->n", ahead[:, t], step, right)
        expected += step * ((ahead[:, t] * scale[:, None]).T @ right)
        behind = _scaled(right @ step.T)
        out[:, t] = _scaled(ahead[:, t] * behind)
    return out, expected


def _spliced(label: np.ndarray, text: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Numbers of words in sequences of equal length, put together from passages of the texts in random order."""
    cuts = np.flatnonzero((rng.random(len(text)) < 1 / PASSAGE) | np.concatenate(([True], text[1:] != text[:-1])))
    ends = np.append(cuts[1:], len(text))
    order = rng.permutation(len(cuts))
    run = ends[order] - cuts[order]
    places = np.repeat(cuts[order], run) + np.arange(run.sum()) - np.repeat(np.cumsum(run) - run, run)
    return places[: len(places) // SEQUENCE * SEQUENCE].reshape(-1, SEQUENCE) if len(places) >= SEQUENCE else places[None, :]


def fit(texts: list[str], langs: list[str]) -> Field:
    """Fit by full-batch gradient steps (Adam) on the log-likelihood of the spliced sequences."""
    languages = sorted(set(langs))
    n = len(languages)
    table_rows = 1 << ROWS_BITS
    field = Field(languages, np.zeros((table_rows, n)), np.zeros(0, np.uint64), np.zeros((0, n)), np.zeros((n, n)), np.zeros(n), np.zeros((n, n)))
    code = {name: i for i, name in enumerate(languages)}
    column = _lowered(pa.array(texts, pa.large_string()))
    (words,) = slabs(column, _LETTERS, limit=1 << 62) if len(texts) else (None,)
    if words is None or not len(words.starts):
        return field
    text = words.text_of()
    label = np.array([code[x] for x in langs])[text]
    unique, first, back = np.unique(words.hashes, return_index=True, return_inverse=True)
    seen = np.unique(back.astype(np.int64) * len(texts) + text)  # (word, text) pairs
    by_lang = np.bincount(seen // len(texts) * n + np.array([code[x] for x in langs])[seen % len(texts)], minlength=len(unique) * n).reshape(-1, n)
    member = (by_lang >= LEXICON_DOCUMENTS).astype(np.float64)
    entries = np.flatnonzero(member.any(1))
    field.lexicon, field.member = unique[entries], member[entries]
    ids, counts = _features(words, first)
    owner = np.repeat(np.arange(len(unique)), counts)
    sequences = _spliced(label, text, np.random.default_rng(12))
    flat, gold = back[sequences], label[sequences]
    observed = np.zeros((n, n))
    np.add.at(observed, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1)
    starts = np.bincount(gold[:, 0], minlength=n)
    truth = np.bincount(flat.ravel() * n + gold.ravel(), minlength=len(unique) * n).reshape(-1, n)
    size = flat.size
    parts = [field.weights, field.by_member, field.start, field.moves]
    first_moment, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    for turn in range(1, STEPS + 1):
        scores = _sums(field.weights[ids], counts) + member @ field.by_member
        got, expected = _paired(scores[flat], field.start, field.moves)
        each = np.column_stack([np.bincount(flat.ravel(), weights=got[..., c].ravel(), minlength=len(unique)) for c in range(n)]) - truth
        slopes = [
            np.column_stack([np.bincount(ids, weights=each[owner, c], minlength=table_rows) for c in range(n)]),
            member.T @ each,
            got[:, 0].sum(0) - starts,
            expected - observed,
        ]
        for p, s, m, v in zip(parts, slopes, first_moment, second):
            s = s / size + DECAY * p
            m += 0.1 * (s - m)
            v += 0.01 * (s * s - v)
            p -= RATE * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
    field.weights = field.weights.astype(np.float32)
    return field


def held_out(key: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = LANG_ROWS, size: int = LANG_BYTES) -> Field:
    """Fit on a sample of the rows that are not held out and whose language is known.

    The sample takes each language's rows at a rate that gives ``rows`` documents and ``size`` bytes at most, in expectation.
    Empty and null texts teach nothing; rows of equal id are taken or left together. Without any row there is no language.
    """
    learn = docs.where(~held_out(key) & F.col(lang).isNotNull() & F.col(text).isNotNull())
    learn = learn.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    sums = learn.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).collect()  # one row per language
    if not sums:
        return fit([], [])
    steps = 1 << 30
    draw = F.pmod(F.xxhash64(F.lit("language"), F.coalesce(F.col("key").cast("string"), F.lit(""))), F.lit(steps))
    chosen = F.lit(False)
    for r in sorted(sums, key=lambda r: r.lang):
        rate = min(1.0, rows / r.n, size / max(1, r.bytes))
        chosen = chosen | ((F.col("lang") == r.lang) & (draw < int(rate * steps)))
    got = learn.where(chosen).orderBy("key", "text", "lang").toArrow()
    return fit(got["text"].to_pylist(), got["lang"].to_pylist())


def predicted(field: Field) -> Column:
    """A function of a text column: struct(lang_pred, score).

    Null texts, and texts without a letter, are ``und`` with score 0, and so is every text where no language was learned. Texts of
    any length are labelled whole.
    """
    names = pa.array([*field.languages, UNKNOWN], pa.string())

    @F.arrow_udf("lang_pred string, score double")
    def label(texts: pa.Array) -> pa.Array:
        which = np.full(len(texts), len(field.languages))
        score = np.zeros(len(texts))
        if field.languages:
            for words in slabs(_lowered(texts), _LETTERS, limit=SLAB):
                total = _sums_or_zero(field.marginals(words), words.first)
                some = np.flatnonzero(np.diff(words.first))
                which[words.rows.start + some] = total[some].argmax(1)
                score[words.rows.start + some] = total[some].max(1) / np.diff(words.first)[some]
            ascii_letter = pc.match_substring_regex(texts.fill_null(""), "[A-Za-z]").to_numpy(zero_copy_only=False)
            for i in np.flatnonzero(~ascii_letter & (which < len(field.languages))):
                if not has_letter(texts[i].as_py()):
                    which[i], score[i] = len(field.languages), 0.0
        return pa.StructArray.from_arrays([names.take(pa.array(which)), pa.array(np.clip(score, 0, 1))], ["lang_pred", "score"])

    return label


def _sums_or_zero(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of rows first[d] to first[d + 1], zero where there is none."""
    total = np.concatenate((np.zeros((1, values.shape[1])), np.cumsum(values, axis=0)))
    return total[first[1:]] - total[first[:-1]]


@REGISTRY.query("op12_language_field")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    label = predicted(train(docs))
    return docs.select("doc_id", held_out().alias("held_out"), label("text").alias("_p")).select("doc_id", "held_out", "_p.lang_pred", "_p.score")
