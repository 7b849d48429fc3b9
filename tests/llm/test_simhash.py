"""SimHash groups against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import simhash
from tidemark.llm.components import components


def slow_groups(prints, radius):
    up = list(range(len(prints)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if sum(int(a ^ b).bit_count() for a, b in zip(prints[i], prints[j])) <= radius:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


@pytest.mark.parametrize("n,width,radius,seed", [(5, 1, 2, 0), (300, 1, 2, 1), (400, 2, 9, 2), (40, 1, 0, 3)])
def test_gray_index(n, width, radius, seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, (max(1, n // 12), width), dtype=np.uint64)
    x = base[rng.integers(0, len(base), n)]
    for row in x:
        for _ in range(rng.integers(0, 4)):
            row[rng.integers(0, width)] ^= np.uint64(1) << np.uint64(rng.integers(0, 64))
    x = np.unique(x, axis=0)
    assert simhash.groups(x, radius).tolist() == slow_groups(x.tolist(), radius)


def test_gray_index_prunes_on_documents(spark):
    """All links of the fingerprints of real texts come out of the index, whose upper nodes rule most of them out."""
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text").collect()]
    prints = np.unique(np.array([simhash.fingerprint(t) for t in texts[:4000]], np.uint64))[:, None]
    index = simhash.GrayIndex(prints)
    found = set()
    for at in range(0, len(prints), 128):
        q, row = index.near(index.prints[at : at + 128], 2)
        found |= set(zip((q + at).tolist(), row.tolist()))
    far = [np.flatnonzero(np.bitwise_count(index.prints[:, 0] ^ p) <= 2) for p in index.prints[:, 0]]
    assert found == {(i, j) for i, row in enumerate(far) for j in row.tolist()}
    assert len(index.levels) >= 2 and index.pruned > 0.5 * index.visited


@pytest.mark.parametrize("size", [1, 5, 64, 1 << 14])
def test_gray_links_in_ranges(spark, size):
    """Ranges of any size part no two fingerprints of an equal block."""
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 62, 60, dtype=np.int64)
    x = sorted({int(b) ^ (1 << int(i)) ^ (1 << int(j)) for b in base for i, j in rng.integers(0, 62, (6, 2))})
    got = components(simhash.links(spark.createDataFrame([(v,) for v in x], "fp long"), size=size))
    root = {r.node: r.root for r in got.collect()}
    want = slow_groups([[v] for v in x], 2)
    assert len({(w, root.get(v, v)) for v, w in zip(x, want)}) == len(set(want)) == len({root.get(v, v) for v in x})


def test_fingerprint_by_definition():
    for text in (None, " \n", "One", "a b", "a b c d a b c", "É x y Z\x1cq " * 9):
        words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\n", " ").split(" ") if w]
        sh = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
        want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
        assert simhash.fingerprint(text) == want


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (205, 100), (7, 7)] + [(1000, 1000 + i) for i in range(1, 50)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got[40] == 0 and got[0] == 0 and got[205] == got[101] == 100 and got[1049] == 1000 and len(got) == 41 + 3 + 50
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.fixture(scope="module")
def docs(spark):
    odd = [(None, None, "en", None, 0), (9001, "", "en", "src1", 0), (9001, "", "en", "src1", 0), (9002, " \n", None, "src2", 1), (9003, "one two", "en", "src2", 1)]
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return df.unionByName(spark.createDataFrame(odd, df.schema)).withColumn("fp", F.lit("x")).cache()


@pytest.mark.parametrize("crowd", [simhash.CROWD, 8])
def test_near_duplicates(docs, crowd):
    rows = docs.collect()
    prints = [simhash.fingerprint(r.text) for r in rows]
    group = slow_groups([[p] for p in prints], 2)
    least = {}
    for r, g in zip(rows, group):
        if r.doc_id is not None:
            least[g] = min(least.get(g, r.doc_id), r.doc_id)
    want = sorted(((r.doc_id, f"{p:016x}", least.get(g)) for r, p, g in zip(rows, prints, group)), key=str)
    got = sorted((tuple(r) for r in simhash.near_duplicates(docs, crowd=crowd).collect()), key=str)
    assert got == want


def shingles(text, n=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


@pytest.mark.parametrize("block", [simhash.EXACT_ROWS, 2])
def test_keep_one(docs, block):
    """Of every group linked at 0.8 one text stays, the one with the smallest id, and no other text goes."""
    out = simhash.keep_one(docs, block=block)
    assert out.columns == docs.columns
    kept = [r.doc_id for r in out.collect()]
    rows = [(r.doc_id, shingles(r.text)) for r in docs.collect()]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, (_, x) in enumerate(rows):
        for j, (_, y) in enumerate(rows[:i]):
            if min(len(x), len(y)) >= 0.8 * max(len(x), len(y)) and len(x & y) >= 0.8 * len(x | y):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    best = {}
    for i, (doc, _) in enumerate(rows):
        best[root(i)] = min(best.get(root(i), (True, 0)), (doc is None, doc or 0))
    want = {doc for _, doc in best.values()}
    wrong = set(kept) ^ want
    assert len(kept) == len(set(kept)) and len(wrong) <= 0.002 * len(rows), wrong


def test_keep_one_with_crowds(spark):
    """Texts that share one crowded value and no other are found."""
    crowd = [(i, np.full(simhash.WIDE // 64, i * 0x9E3779B97F4A7C15 % (1 << 63), np.uint64)) for i in range(100)]
    rows = [(0, 7, i, p.tobytes()) for i, p in crowd] + [(0, 7, 100 + i, (p ^ np.uint64(1)).tobytes()) for i, p in crowd] + [(1, 7, 300, bytes(simhash.WIDE // 8)), (1, 7, 301, bytes(simhash.WIDE // 8))]
    filed = spark.createDataFrame(rows, "k1 long, k2 long, id long, print binary")
    for size in (8, 50, 1000):
        out = simhash._link(simhash._in_pairs(filed, size), 16)
        assert {(min(r), max(r)) for r in out.collect()} == {(i, 100 + i) for i in range(100)} | {(300, 301)}
        most = simhash._in_pairs(filed, size).groupBy("k1", "k2").count().agg(F.max("count")).first()[0]
        assert most <= max(2 * size, 30)


def test_keep_one_finds_cut_texts(spark):
    """Every text cut down to a similarity of just 0.8 is found."""
    rng = np.random.default_rng(9)
    rows, pairs = [], 0
    for n in [*range(8, 40), *rng.integers(40, 700, 170).tolist()]:
        words = [f"w{x}" for x in (rng.zipf(1.3, n) % 5000)]
        sets = [shingles(" ".join(words[:k])) for k in range(n + 1)]
        k = next(k for k in range(n + 1) if len(sets[k] & sets[n]) >= 0.8 * len(sets[k] | sets[n]))
        if len(sets[n]) > 4 and k < n:
            rows += [(2 * pairs, " ".join(words)), (2 * pairs + 1, " ".join(words[:k]))]
            pairs += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for crowd in (simhash.CROWD, 4):
        kept = {r.doc_id for r in simhash.keep_one(docs, crowd=crowd).collect()}
        assert kept == set(range(0, 2 * pairs, 2))


@pytest.mark.parametrize("block", [3, 1000])
def test_exact_links_by_all_pairs(spark, block):
    """Candidate groups of unlike texts fall apart into exactly the groups of similar ones, in parts of any size."""
    rng = np.random.default_rng(4)
    texts = []
    for _ in range(12):
        base = [f"w{x}" for x in rng.integers(0, 90, rng.integers(6, 60))]
        for _ in range(rng.integers(1, 9)):
            texts.append(" ".join(w if rng.random() > 0.02 else "other" for w in base))
    sets = [shingles(t) for t in texts]
    slim = spark.createDataFrame(list(enumerate(texts)), "row long, text string")
    roots = spark.createDataFrame([(i, i % 2) for i in range(len(texts))], "node long, root long")
    got = {r.node: r.root for r in components(simhash.exact_links(roots, slim, 5, 0.8, simhash.WIDE, block)).collect()}
    for i in range(len(texts)):
        members = range(i % 2, len(texts), 2)
        reach = _reach(sets, members, i)
        assert reach == {j for j in members if got.get(i, i) == got.get(j, j)}


def _reach(sets, members, i):
    seen, todo = {i}, [i]
    while todo:
        x = todo.pop()
        for y in members:
            if y not in seen and len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y]):
                seen.add(y)
                todo.append(y)
    return seen


def test_clashing_columns(spark, docs):
    odd = docs.limit(30).withColumnsRenamed({"lang": "row", "n_chars": "doc"}).withColumn("_row", F.lit("mine"))
    out = simhash.keep_one(odd)
    assert out.columns == odd.columns and set(out.collect()) <= set(odd.collect()) and out.count() > 0


def test_empty(docs):
    none = docs.where("false")
    assert simhash.near_duplicates(none).count() == simhash.keep_one(none).count() == 0


@pytest.mark.parametrize("most", [3, 1 << 20])
def test_keys_that_are_shared(spark, most):
    """Every two rows of a key still meet, however few rows a task holds; keys of one row are gone."""
    rng = random.Random(3)
    rows = sorted({(rng.choice([5, 5, 5, 7, rng.randrange(200)]) - 100, rng.randrange(60)) for _ in range(900)} | {(k, i) for k in (1001, 1002) for i in (1, 2, 3)})
    want = {frozenset((a, b)) for k, a in rows for k2, b in rows if k == k2 and a != b}
    df = spark.createDataFrame(rows, "k2 long, id long").repartition(5)
    got = simhash._shared(df, most).collect()
    by: dict = {}
    for r in got:
        by.setdefault(r.k2, []).append(r.id)
    assert {frozenset((a, b)) for ids in by.values() for a in ids for b in ids if a != b} == want
    assert all(len(ids) > 1 and len(set(ids)) == len(ids) for ids in by.values())
    assert len(by) < len({k for k, _ in rows})
