"""The corpus pipeline against a plain version of each stage."""

import hashlib
import re
from collections import Counter

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import queries
from tidemark.llm import mixing, quality_rules, secrets
from tidemark.llm.common import written
from tidemark.llm.queries import tokenizer_path
from tidemark.llm.textview import TextView

from .test_simhash import shingles
from .test_text_ops import WORDS, slow_spans, slow_targets

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of each stage, on the small table with odd rows added."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    long = "plain words that stand in no other text of this small table and so are kept by every rule there is here now "
    odd = [(None, None, "en", None, 0), (9001, "", "en", "s", 0), (9002, long + "q1", None, None, 1), (9002, long + "q1", None, None, 1), (9003, long * 400 + "api_key: 'abcd.efgh-ijkl='", "en", "src1", 1), (9004, long + "own aB3dEfGhIjKlMnOpQrStUvWx9 and more words for this one", "en", "src2", 1)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    out = [("documents", docs.collect())]
    for name, f in corpus_pipeline.STAGES:
        docs = written(f(spark, docs, SF))
        out.append((name, docs.collect()))
    return out


def test_names(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "secrets", "mix", "packing"]
    fields = stages[0][1][0].__fields__
    assert all(rows[0].__fields__ == fields for _, rows in stages[:-1])


def test_quality(stages):
    want = [r for r in stages[0][1] if not any(x.rejects(TextView(r.text)) for x in quality_rules.RULES)]
    assert Counter(want) == Counter(stages[1][1])


def test_near_duplicates(stages):
    before, after = stages[1][1], stages[2][1]
    assert not Counter(after) - Counter(before)
    sets = {r.doc_id: shingles(r.text) for r in before}
    kept = {r.doc_id for r in after}
    assert len(after) == len(kept)
    alike = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    for i, x in sets.items():
        assert i in kept or any(j != i and alike(x, y) >= 0.8 for j, y in sets.items())
    assert not [(i, j) for i in kept for j in kept if i < j and alike(sets[i], sets[j]) >= 0.8]


def slow_redaction(rows):
    owners, repos, spans = {}, {}, []
    for r in rows:
        base = slow_spans(r.text or "")
        loose = []
        for m in re.finditer(secrets.BLOB, r.text or ""):
            v = m[0]
            if re.search("[0-9]", v) and re.search("[a-z]", v) and re.search("[A-Z]", v) and not any(a < m.end() and m.start() < b for a, _, b in base):
                loose.append((m.start(), m.end(), v))
                owners.setdefault(v, set()).add(r.source)
                repos.setdefault(v, set()).add((r.source, r.doc_id))
        spans.append(([(a, b) for a, _, b in base], loose))
    out = []
    for r, (base, loose) in zip(rows, spans):
        hit = [False] * len(r.text or "")
        for a, b in base + [(a, b) for a, b, v in loose if len(owners[v]) <= secrets.MAX_OWNERS and len(repos[v]) <= secrets.MAX_REPOSITORIES]:
            hit[a:b] = [True] * (b - a)
        text = None if r.text is None else "".join("[SECRET]" if h and (not i or not hit[i - 1]) else "" if h else c for i, (c, h) in enumerate(zip(r.text, hit)))
        out.append((r.doc_id, text))
    return out


def test_secrets(stages):
    want = Counter(slow_redaction(stages[2][1]))
    assert Counter((r.doc_id, r.text) for r in stages[3][1]) == want


def slow_mix(rows):
    size = {id(r): len(WORDS.findall(r.text or "")) for r in rows}
    total = Counter()
    for r in rows:
        total[r.source] += size[id(r)]
    want = slow_targets(total)
    pieces = []
    for s in total:
        line = sorted((r for r in rows if r.source == s), key=lambda r: hashlib.md5(str(r.doc_id).encode()).hexdigest())
        for turn in range(mixing.MOST):
            at = turn * total[s]
            for r in line:
                at += size[id(r)]
                if size[id(r)]:
                    pieces.append((at / want[s], s is None, s or "", hashlib.md5(str(r.doc_id).encode()).hexdigest(), size[id(r)], r.doc_id))
    taken, served = Counter(), 0
    for _, _, _, _, n, doc in sorted(pieces):
        if served >= sum(total.values()):
            break
        taken[doc] += 1
        served += n
    return taken


def test_mix(stages):
    assert Counter(r.doc_id for r in stages[4][1]) == slow_mix(stages[3][1])
    texts = {(r.doc_id, r.text) for r in stages[3][1]}
    assert {(r.doc_id, r.text) for r in stages[4][1]} <= texts


def test_packing(stages):
    t = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for r in stages[4][1]:
        want[r.doc_id] += len(t.encode(r.text, add_special_tokens=False).ids) + 1
    got = Counter()
    for r in stages[5][1]:
        got[r.doc_id] += r.length
    assert got == want


def test_run(spark, stages):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == list(stages[5][1][0].__fields__) and out.count() > 0


def test_a_run_removes_only_its_own_tables(spark):
    """Queries built before a run, and an earlier run's result, still give their rows after it."""
    small = "/root/testdata/sf0.001"
    mix = queries.op3_weighted_fair_mix(spark, small)
    first = corpus_pipeline.run(spark, small)
    second = corpus_pipeline.run(spark, small)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    alone = corpus_pipeline.STAGES[3][1](spark, docs, small)
    assert mix.count() == docs.count() and alone.count() > 0
    assert sorted(map(str, first.collect())) == sorted(map(str, second.collect()))
