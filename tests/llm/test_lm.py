"""The language model: base scores and probabilities against plain Python."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    odd = [(None, None, "en", None, 0), (9001, "", "en", "s", 0), (9001, "", "en", "s", 0), (9002, "long" * 30 + " " + "LONG" * 30 + " x\x1cy é", None, "s", 1), (9005, "of the \x0b" * 9000, "en", "s", 1)]
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return df.unionByName(spark.createDataFrame(odd, df.schema)).withColumn("score", F.lit("x")).withColumn("word", F.lit(b"z")).cache()


def tokens(text):
    return [*WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")), None]


@pytest.mark.parametrize("head", [lm.HEAD, 50])
def test_base_score(docs, head):
    rows = docs.collect()
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    c = Counter(w for r in rows if not held(r.doc_id) for w in tokens(r.text))
    n, v = sum(c.values()), len(c)
    want = sorted(((r.doc_id, held(r.doc_id), len(t := tokens(r.text)), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t)) for r in rows), key=str)
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in lm.score(docs, head=head, vocab=60, rounds=1).collect()), key=str)
    assert [x[:5] for x in got] == [x[:5] for x in want]
    assert np.allclose([x[5] for x in got], [x[5] for x in want], rtol=1e-9)


def model_of(n, dim=5, seed=2):
    """A model of random vectors with classes."""
    m = lm.Model.start(np.arange(1, n + 1) / np.arange(1, n + 1).sum(), dim=dim, seed=seed)
    m.classify()
    rng = np.random.default_rng(seed)
    for x in m.tables():
        x += rng.normal(0, 0.7, x.shape).astype(np.float32)
    return m


def slow_log_probability(m, i, j, w):
    """By definition: a softmax over all classes, times one over the class's members."""
    c = [float(a) + float(b) for a, b in zip(m.last[i], m.other[j])]
    strength = lambda out: math.exp(sum(float(x) * y for x, y in zip(out, c)) + float(out[-1]))
    k = m.class_of[w]
    top = sum(strength(x) for x in m.class_out)
    inside = sum(strength(m.out[x]) for x in range(len(m.out)) if m.class_of[x] == k)
    return math.log(strength(m.class_out[k]) / top) + math.log(strength(m.out[w]) / inside)


@pytest.mark.parametrize("n", [1, 2, 37])
def test_probabilities_are_normalised(n):
    m = model_of(n)
    assert np.bincount(m.class_of).max() <= math.ceil(math.sqrt(n)) and len(np.unique(m.class_of)) == len(m.class_out)
    for i, j in ((0, 0), (n - 1, n // 2)):
        w = np.arange(n)
        lp = lm.Probabilities(m)(np.full(n, i), np.full(n, j), w, block=16)
        assert abs(np.exp(lp).sum() - 1) < 1e-5
        assert np.allclose(lp, [slow_log_probability(m, i, j, x) for x in range(n)], atol=1e-4)


def test_training_learns_what_follows_what():
    """On texts of two alternating words each, the model gives the right successor most of its class's and its own share."""
    rng = np.random.default_rng(0)
    share = np.full(20, 0.05)
    a = rng.integers(0, 10, 40_000)
    ids = np.stack([2 * a, 2 * a + 1], 1).ravel().astype(np.int32)
    i, j = lm.contexts(ids, np.arange(2, len(ids) + 1, 2), 0)
    m = lm.Model.start(share)
    for r in range(3):
        if r == 1:
            m.classify()
        t = lm.Trainer(m, lm.RATE, r)
        for s in range(0, len(ids), lm.BATCH):
            t.step(i[s : s + lm.BATCH], j[s : s + lm.BATCH], ids[s : s + lm.BATCH])
    second = slice(1, 2000, 2)
    assert np.exp(lm.Probabilities(m)(i[second], j[second], ids[second])).mean() > 0.5


def test_averaging_weighs_rows_by_use():
    a, b = model_of(6), model_of(6)
    one, two = lm.Trainer(a, 0.1, 0), lm.Trainer(b, 0.1, 1)
    for x, y in zip(one.uses, two.uses):
        x[:2], y[1:3] = (1, 3), (1, 2)
    want = [(x.copy(), y.copy()) for x, y in zip(a.tables(), b.tables())]
    c = model_of(6, seed=5)
    c.class_of, c.class_out = a.class_of, a.class_out.copy()
    before = [x.copy() for x in c.tables()]
    lm.averaged(c, one.sums().astype(float) + two.sums())
    for x, old, (p, q) in zip(c.tables(), before, want):
        assert np.allclose(x[0], p[0], atol=1e-5) and np.allclose(x[1], (3 * p[1] + q[1]) / 4, atol=1e-5)
        assert np.allclose(x[2:3], q[2:3], atol=1e-5) and np.array_equal(x[3:], old[3:])


def test_score_by_definition(docs):
    """Every score again from the counts and the model, token by token."""
    rows = docs.collect()
    counts = lm.written(lm.count(docs, "doc_id", "text", lm.FOLDS))
    v, total, types = lm.vocabulary(counts, 40, 60)
    c = {bytes(r.word): r.c for r in counts.collect()}
    assert set(v.names) <= set(c) and all(c[w] >= lm.LEAST for w in v.names[1:]) and total == sum(c.values()) and types == sum(n > 0 for n in c.values())
    coded = lm.code(docs, "doc_id", "text", lm.FOLDS, v, 0.0)
    model = lm.train(coded.where("not held_out"), v.share, 2)
    place = {w: k for k, w in enumerate(v.names)}
    outside = [[n for w, n in c.items() if w not in place and lm.bucket_of(w) == k] for k in range(lm.BUCKETS)]
    totals = [sum(x) + sum(n > 0 for n in x) + 1 for x in outside]
    want = []
    for r in [r for r in rows if len(lm.words_of(r.text)) < 100]:
        keys = [lm.key_of(w) for w in lm.words_of(r.text)] + [b""]
        ids = [place.get(k, len(v.names) + lm.bucket_of(k)) for k in keys]
        lp = sum(slow_log_probability(model, ids[x - 1] if x else 0, ids[x - 2] if x > 1 else 0, ids[x]) for x in range(len(ids))) / math.log(10)
        lp += sum(math.log10((c[k] + 1) / totals[lm.bucket_of(k)]) for k in keys if k not in place)
        want.append((r.doc_id, lp))
    got = [(r.doc_id, r.score) for r in lm.score(docs, vocab=40, head=60, rounds=2).collect() if r.n_tokens <= 100]
    key = lambda x: (str(x[0]), x[1])
    assert len(got) == len(want) > 20 and all(x[0] == y[0] and abs(x[1] - y[1]) < 0.02 * abs(y[1]) for x, y in zip(sorted(got, key=key), sorted(want, key=key)))


def test_contexts():
    ids = np.array([5, 6, 7, 0, 0, 8, 0], np.int32)
    i, j = lm.contexts(ids, np.array([4, 5, 7]), 0)
    assert i.tolist() == [0, 5, 6, 7, 0, 0, 8] and j.tolist() == [0, 0, 5, 6, 0, 0, 0]


def test_model_beats_the_base_on_held_out_texts(spark):
    out = lm.score(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).where("held_out")
    r = out.agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.sum("n_tokens").alias("n")).first()
    assert r.s / r.n > r.b / r.n + 0.15


def test_empty_and_untrained(docs):
    assert lm.score(docs.where("false")).count() == 0
    out = lm.score(docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2)).collect()
    assert out and all(r.n_known == 0 and r.train_tokens == 0 and np.isfinite(r.score) and r.base_score == 0 for r in out)


def test_equal_tokens_are_computed_once_a_block():
    """Sums over classes are taken for the pairs before a token that differ within a block, and change nothing."""
    rng = np.random.default_rng(4)
    model = lm.Model.start(np.full(60, 1 / 60))
    model.classify()
    i, j, w = (rng.integers(0, 60, 4000) % k for k in (5, 4, 60))
    seen = []
    plain, lm._log_sum = lm._log_sum, lambda x: seen.append(len(x)) or plain(x)
    try:
        got = lm.Probabilities(model)(i, j, w)
    finally:
        lm._log_sum = plain
    assert sum(seen) <= 20 + 20 * 60
    context = model.context(i, j).astype(float)
    classes, members = context @ model.class_out.T, context @ model.out.T
    norm = lambda x: np.log(np.exp(x).sum(1))
    inside = np.where(model.class_of[w][:, None] == model.class_of[None, :], members, -np.inf)
    every = np.arange(len(w))
    want = classes[every, model.class_of[w]] - norm(classes) + members[every, w] - norm(inside)
    assert np.allclose(got, want, atol=1e-4)


def test_buckets_of_counted_words(spark):
    """The bucket that Spark computes is that of every word, short, long or not ASCII; held-out texts count in ``every`` only."""
    docs = spark.createDataFrame([(k, f"a bb ccc \u00e9 {'x' * 50} k{k} k{k}") for k in range(40)] + [(None, None)], "doc_id long, text string")
    got = lm.count(docs, "doc_id", "text", lm.FOLDS).collect()
    assert all(r.bucket == lm.bucket_of(bytes(r.word)) for r in got)
    held = [lm.py_in_fold(k, *lm.FOLDS) for k in [*range(40), None]]
    by = {bytes(r.word): (r.c, r.every) for r in got}
    assert by[b""] == (held.count(False), 41) and by[b"a"] == (held[:40].count(False), 40)
    assert all(by[f"k{k}".encode()] == (0 if held[k] else 2, 2) for k in range(40))
