"""Nearest neighbours against brute force."""

import math

import numpy as np
import pytest

from tidemark.llm import ann

SCHEMA = "vec_id long, embedding array<float>, score string"


def slow(rows, k=5, every=50):
    """For each query row (id, rank) -> best (score, id) by trying every other row."""
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for n, (i, q) in enumerate(good):
        if i % every == 0:
            near = sorted((-float(q @ v / np.sqrt((q @ q) * (v @ v))), j) for m, (j, v) in enumerate(good) if m != n and len(v) == len(q))
            out.append((i, [(-s, j) for s, j in near[:k]]))
    return sorted(out, key=str)


def answers(df):
    got = {}
    for r in df.collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: [(s, v) for _, v, s in sorted(x)] for q, x in got.items()}


def test_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = answers(ann.nearest(df))
    hit = n = 0
    for q, best in slow([(r.vec_id, list(r.embedding)) for r in df.collect()]):
        assert len(got[q]) == 5 and got[q] == sorted(got[q], key=lambda x: (-x[0], x[1]))
        hit += len({j for _, j in best} & {j for _, j in got[q]})
        n += 5
    assert hit / n >= 0.95


def test_odd_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).astype(np.float32).tolist()) for i in range(1, 60)]
    rows += [(100 + i, [1.0, 2.0, 0.0, -1.0]) for i in range(40)]  # a crowd of equal vectors, queries among them
    rows += [(150, [2.0, 4.0, -0.0, -2.0]), (150, [2.0, 4.0, 0.0, -2.0])]  # a repeated query row
    rows += [(200, None), (250, []), (300, [0.0] * 4), (350, [1.0, None, 0.0, 0.0]), (400, [1.0, float("nan"), 0.0, 0.0]), (450, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0, 0.0, 0.0, 0.0])]
    rows += [(500, [1.0, 2.0]), (501, [2.0, 1.0]), (550, [3.0])]  # other lengths: one candidate, and none
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in ann.nearest(df).collect())
    want = sorted((q, k, j) for q, best in slow(rows) for k, (_, j) in enumerate(best, 1))
    assert got == want
    assert ann.nearest(df.where("false")).count() == 0


def test_recall_in_a_large_shard():
    """Random vectors, the hardest case, in one shard several times larger than those of the tables at hand."""
    x = np.random.default_rng(1).normal(size=(12_000, 64)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1)[:, None]
    found, _ = ann.Graph(x).search(x[:100], ann.beam_for(len(x)))
    best = np.argsort(-(x[:100] @ x.T), 1)[:, 1:6]
    assert np.mean([len(set(b) & set(f)) / 5 for b, f in zip(best.tolist(), found.tolist())]) >= 0.9


@pytest.mark.parametrize("n,d,degree", [(3, 2, 4), (40, 3, 4), (700, 8, 16)])
def test_graph_reaches_all_within_its_beam(n, d, degree):
    x = np.random.default_rng(n).normal(size=(n, d)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1)[:, None]
    g = ann.Graph(x, degree=degree)
    ids, cos = g.search(x[:5], n)
    assert (np.sort(ids, 1) == np.arange(n)).all() and (np.diff(cos, axis=1) <= 0).all()
