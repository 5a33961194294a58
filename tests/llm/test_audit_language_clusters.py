"""Source audit, language field and centroid clustering against brute force."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeshift.llm import clustering, divergence, language, words
from lakeshift.llm.queries import QUERIES

# ---------------------------------------------------------------- 11 source audit

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def audit_of(rows, least=3, top=200):
    """(lang, source, part, item, value, rank) by the definition, over every term and pair."""
    table = str.maketrans({chr(c): chr(c + 32) for c in range(0x41, 0x5B)})
    count, docs, groups = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter), set()
    for text, lang, source in rows:
        found = TERM.findall((text or "").translate(table))
        g = (lang or "", source or "")
        groups.add(g)
        count[g].update(found)
        docs[g[0]].update(set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        mine = sorted(s for l_, s in groups if l_ == lang)

        def shares(of, kept=kept):
            total = sum(of[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (of[t] + 1) // total for t in kept}

        p = {s: shares(count[lang, s]) for s in mine}
        q = shares(sum((count[lang, s] for s in mine), collections.Counter()))
        for s in mine:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in mine if o != s]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, i, v, r + 1) for r, (v, i) in enumerate(ranked)]
    return sorted(out)


def audited(df, **law):
    out = divergence.audited(df, **law)
    assert [f.simpleString() for f in out.schema.fields] == ["lang:string", "source:string", "part:string", "item:string", "value:bigint", "rank:int"]
    return sorted(map(tuple, out.collect()))


@pytest.mark.parametrize("tile, cells, entries, held", [(512, 1 << 15, 200_000, 1_000_000), (2, 1, 3, 4), (3, 40, 50, 100)])
def test_audit_equals_brute_force(spark, monkeypatch, tile, cells, entries, held):
    for name, value in (("TILE", tile), ("CELLS", cells), ("ENTRIES", entries), ("HELD", held)):
        monkeypatch.setattr(divergence, name, value)
    rng = random.Random(5)
    some = ["The", "the", "CAT", "über", "ÜBER", "x1y", "don't", "日本", "a", "b", "c-d", "É"]
    rows = []
    for i in range(160):
        text = rng.choice([" ", "\n", ", ", "\x00", "7"]).join(rng.choices(some, range(1, 13), k=rng.randrange(0, 30)))
        rows.append((rng.choice([text, text, text, None, ""]), rng.choice(["en", "en", "en", None, "", "de"]), rng.choice(["s0", "s0", "s1", "s2", "s3", "S4", "", None])))
    rows += [("alone", "fr", "s0"), (None, "it", "s0"), (None, "it", "s1"), ("Ω " * 5000, "en", "s9")]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    assert audited(df.repartition(5)) == audit_of(rows)
    assert audited(df, least=1, top=2) == audit_of(rows, least=1, top=2)


def test_audit_of_odd_rows(spark, odd, none):
    rows = [(r.text, r.lang, r.source) for r in odd.collect()]
    clashing = odd.withColumn("n", F.lit(1)).withColumn("term", F.lit("t")).withColumn("part", F.lit("p")).withColumn("block", F.lit(1)).withColumn("total", F.lit(2))
    assert audited(clashing) == audit_of(rows)
    assert audited(none) == []


def test_shares_stay_exact_where_products_leave_64_bits(spark):
    rng = random.Random(1)
    cases = [(rng.randrange(total), total) for total in (rng.randrange(1, 9 * 10**15) for _ in range(200))]
    got = spark.createDataFrame(cases, "n long, total long").select(divergence.share(F.col("n"), F.col("total"))).collect()
    want = [1 + 10**9 * (n + 1) // t for n, t in cases]
    assert [r[0] for r in got] == want
    assert divergence._shares(np.array([n for n, _ in cases]), np.array([t for _, t in cases])).tolist() == want


# ---------------------------------------------------------------- 12 language field


@pytest.mark.parametrize("lengths", [[5], [1, 3, 0, 7], [2, 2], [], [0]])
@pytest.mark.parametrize("stretch", [2, 3, 128])
def test_forward_backward_equals_all_paths(lengths, stretch):
    rng = np.random.default_rng(sum(lengths) + stretch)
    n, first = sum(lengths), np.concatenate(([0], np.cumsum(lengths))).astype(int)
    scores, start, moves = rng.normal(size=(n, 3)) * 2, rng.normal(size=3), rng.normal(size=(3, 3))
    got = language.forward_backward(scores, first, start, moves, stretch)
    for d, k in enumerate(lengths):
        want = np.zeros((k, 3))
        for path in itertools.product(range(3), repeat=k):
            total = start[path[0]] if k else 0.0
            total += sum(scores[first[d] + i, c] for i, c in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:]))
            for i, c in enumerate(path):
                want[i, c] += math.exp(total)
        assert np.allclose(want / want.sum(1, keepdims=True), got[first[d] : first[d + 1]])


def test_gradients_are_those_of_the_likelihood():
    rng = np.random.default_rng(3)
    scores, start, moves = rng.normal(size=(4, 5, 3)), rng.normal(size=3), rng.normal(size=(3, 3))

    def log_z(scores, start, moves):
        total = 0.0
        for s in scores:
            total += math.log(sum(math.exp(start[p[0]] + sum(s[i, c] for i, c in enumerate(p)) + sum(moves[a, b] for a, b in zip(p, p[1:]))) for p in itertools.product(range(3), repeat=5)))
        return total

    got, expected = language._paired(scores, start, moves)
    eps = 1e-5
    for i, j in itertools.product(range(3), repeat=2):
        up, down = moves.copy(), moves.copy()
        up[i, j] += eps
        down[i, j] -= eps
        assert abs((log_z(scores, start, up) - log_z(scores, start, down)) / (2 * eps) - expected[i, j]) < 1e-4
    up = scores.copy()
    up[2, 3, 1] += eps
    assert abs((log_z(up, start, moves) - log_z(scores, start, moves)) / eps - got[2, 3, 1]) < 1e-3


def test_language_of_held_out_documents_and_of_switching_texts(spark):
    d = "/root/testdata/sf0.01"
    lang = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang", "text")
    out = QUERIES["op12_language_field"](spark, d)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = out.join(lang, "doc_id").collect()
    assert len(rows) == lang.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    # two passages of known languages in one text: words are labelled each with theirs
    field = language.train(lang)
    parts = {r.lang: " ".join(r.text.split()[:60]) for r in held if r.lang_pred == r.lang and r.score > 0.99 and len(r.text.split()) > 80}
    import pyarrow as pa

    for a, b in itertools.permutations(sorted(parts), 2):
        (slab,) = words.slabs(language._lowered(pa.array([parts[a] + " " + parts[b]])), language._LETTERS)
        got = [field.languages[c] for c in field.marginals(slab).argmax(1)]
        assert (got[: len(got) // 2 - 6].count(a) + got[len(got) // 2 + 6 :].count(b)) / (len(got) - 12) > 0.9


def test_language_of_odd_rows(spark, odd, none):
    base = odd.drop("lang").withColumn("lang", F.when(F.col("source") == "a", "en").when(F.col("source") == "c", "de")).withColumn("_p", F.lit(1))
    field = language.train(base)
    assert field.languages == ["de", "en"]
    extra = [(20, "12 34 — € 5"), (21, "ß"), (22, "Ж"), (23, "\x00퟿"), (24, "word1 " * 50_000)]
    texts = base.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    got = texts.select("doc_id", "text", language.predicted(field)("text").alias("p")).collect()
    assert len(got) == odd.count() + len(extra)
    for r in got:
        blank = not any(c.isalpha() for c in r.text or "")
        assert (r.p.lang_pred == "und") == blank and (r.p.score == 0) == blank and 0 <= r.p.score <= 1
    assert {r.p.lang_pred for r in got if r.doc_id == 24} == {"en"}
    nothing = language.train(none)
    assert nothing.languages == [] and {tuple(r.p) for r in texts.select(language.predicted(nothing)("text").alias("p")).collect()} == {("und", 0.0)}
    assert none.select(language.predicted(field)("text")).collect() == []
    untold = language.train(odd.withColumn("lang", F.lit(None).cast("string")))
    assert untold.languages == []


def test_the_sample_is_bounded_for_each_language(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "if(id % 100 = 0, 'rare', 'common') AS lang", "if(id % 100 = 0, 'zu ', 'the ') || id AS text")
    seen = {}
    keep = language.fit
    try:
        language.fit = lambda texts, langs: seen.update(collections.Counter(langs)) or keep(texts, langs)
        language.train(docs, rows=50)
        assert 20 < seen["common"] < 90 and 20 < seen["rare"] < 90
        language.train(docs, rows=50, size=80)
        assert seen["common"] < 30
    finally:
        language.fit = keep


# ---------------------------------------------------------------- 13 centroid clustering


def clusters_of(rows, k, rounds, dimensions, scale=256, seed=2):
    good = [(i, tuple(math.floor(scale * x) for x in v)) for i, v in rows if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(good, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    centers = [v for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centers))

    for _ in range(rounds):
        members = collections.defaultdict(list)
        for _, v in good:
            members[nearest(v)[1]].append(v)
        centers = [tuple(sum(x) // len(members[n]) for x in zip(*members[n])) if members[n] else c for n, c in enumerate(centers)]
    given = [(i, *reversed(nearest(v))) for i, v in good]
    of = collections.Counter()
    for _, c, d in given:
        of[c] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted(((i, c, d, of[c], sum(of.values()), digest[c]) for i, c, d in given), key=repr)


@pytest.mark.parametrize("pivots, rows_at_once", [(32, 8192), (1, 7), (3, 50)])
def test_clusters_equal_brute_force(spark, monkeypatch, pivots, rows_at_once):
    monkeypatch.setattr(clustering, "ROWS", rows_at_once)
    rng = random.Random(7)
    rows = [(i, [float(np.float32(rng.gauss(i % 3, 0.4))) for _ in range(6)]) for i in range(150)]
    rows += [(200 + i, [0.5] * 6) for i in range(40)] + [(5, [0.25] * 6), (5, [0.25] * 6), (None, [1.0] * 6), (None, [-1.0] * 6)]
    rows += [(300, None), (301, []), (302, [1.0] * 5), (303, [1.0] * 5 + [None]), (304, [math.nan] * 6), (305, [math.inf] * 6), (306, [0.0] * 7), (307, [-300.0] * 6)]
    df = spark.createDataFrame([(*r, "c", 9) for r in rows], "vec_id long, embedding array<float>, cluster string, distance int").repartition(4)
    out = clustering.clustered(df, k=9, rounds=4, dimensions=6, pivots=pivots)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, out.collect()), key=repr) == clusters_of(rows, 9, 4, 6)


def test_clusters_of_few_equal_and_no_vectors(spark):
    few = [(i, [float(i), 0.0]) for i in range(3)]
    kind = "vec_id long, embedding array<float>"
    got = clustering.clustered(spark.createDataFrame(few, kind), k=9, rounds=2, dimensions=2).collect()
    assert sorted(map(tuple, got), key=repr) == clusters_of(few, 9, 2, 2)
    same = [(i, [1.5, 2.5]) for i in range(20)]
    got = clustering.clustered(spark.createDataFrame(same, kind), k=4, rounds=2, dimensions=2).collect()
    assert sorted(map(tuple, got), key=repr) == clusters_of(same, 4, 2, 2) and {r.cluster for r in got} == {0}
    empty = clustering.clustered(spark.createDataFrame([], kind))
    assert empty.columns == clustering.clustered(spark.createDataFrame(few, kind), dimensions=2).columns and empty.collect() == []
    with pytest.raises(Exception, match="64 bits"):
        clustering.clustered(spark.createDataFrame([(1, [1e30, 0.0])], kind), dimensions=2).collect()


def test_bounds_hold_and_filter():
    rng = np.random.default_rng(4)
    vectors = rng.integers(-300, 300, (400, 12))
    centers = vectors[:20]
    simplex = clustering.Simplex(centers, 10)
    lower, upper = clustering.bounds(simplex.apexes(simplex.distances(vectors)), simplex.apexes(simplex.distances(centers)))
    exact = ((vectors[:, None, :] - centers[None]) ** 2).sum(2)
    assert (lower <= exact + 1e-3).all() and (upper >= exact - 1e-3).all()
    assert (lower <= upper.min(1)[:, None]).mean() < 0.5
