"""Packing, URL rules, quality model and toxicity."""

import hashlib
import time
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import packing, quality_model, toxicity, url_rules
from tidemark.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    odd = [(None, None, "en", None, 0), (9001, "", "en", "src1", 0), (9001, "", "en", "src1", 0), (9002, "It's  a\x1cb\x0bc <|endoftext|> é\u0301x", None, "src2", 1), (9003, "long text " * 9000, "en", "src2", 1)]
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return df.unionByName(spark.createDataFrame(odd, df.schema)).withColumn("score", F.lit("x")).cache()


def test_pack_is_a_partition_of_all_ids(docs):
    t = Tokenizer.from_file(tokenizer_path())
    rows = packing.pack(docs, tokenizer_path()).collect()
    want = {}
    for r in docs.collect():
        ids = [*t.encode(r.text or "", add_special_tokens=False).ids, 1]
        want.setdefault(r.doc_id, []).append(np.array(ids, "<u4"))
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append(r)
    assert set(got) == set(want)
    for doc, pieces in got.items():
        copies = want[doc]
        assert {p.doc_tokens for p in pieces} == {len(c) for c in copies}
        assert sum(p.length for p in pieces) == sum(map(len, copies))
        for p in pieces:
            assert any(zlib.crc32(c[p.start : p.start + p.length].tobytes()) == p.ids_crc32 for c in copies)
        if len(copies) == 1:
            at = 0
            for p in sorted(pieces, key=lambda p: p.start):
                assert p.start == at
                at += p.length
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    padding = 0
    for s in by.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_short_cuts_only_where_they_hold(name):
    path = tokenizer_path().replace("word_bpe_49k.json", name)
    t, w = Tokenizer.from_file(path), packing.WordIds(path)
    assert w.apart == w.caseless == (name == "word_bpe_49k.json")
    texts = ["Hello, World!  a\tB\n", "x9?! \u00c9t\u00e9", "", None]
    assert [x.tolist() for x in w.texts(texts)] == [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def test_step_groups_have_one_tier_and_equal_sizes():
    rng = np.random.default_rng(3)
    for shard in (0, 5):
        packer, rows = packing.Packer(shard), []
        for doc in range(3000):
            packer.add(doc, np.arange(rng.integers(0, 3000), dtype=np.uint32))
            rows += packer.rows()
        rows += packer.rows(last=True)
        groups = {}
        for r in rows:
            tier, tokens, at = groups.setdefault(r[8], (r[7], 0, shard))
            assert tier == r[7] and r[8] >> 32 == shard
            groups[r[8]] = (tier, tokens + r[2], at)
        small = [tier for tier, tokens, _ in groups.values() if tokens != packing.STEP]
        assert len(small) == len(set(small)) and len(groups) > 100
        assert all(tokens <= packing.STEP for _, tokens, _ in groups.values())


def test_word_ids_start_anew(monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 3)
    t, w = Tokenizer.from_file(tokenizer_path()), packing.WordIds(tokenizer_path())
    for texts in (["a b c d e"], ["Hello, world's 12 ends", None, ""], ["a b c d e", "x"]):
        assert [x.tolist() for x in w.texts(texts)] == [t.encode(x or "", add_special_tokens=False).ids for x in texts]


@pytest.mark.parametrize(
    "url,host,path,hit",
    [
        (None, "", "", None),
        ("no scheme.org/", "", "", None),
        ("https://A.Example.ORG/es/1?q#f", "a.example.org", "/es/1", ("example.org/es/", "block")),
        ("http://example.org/en/12", "example.org", "/en/12", ("example.org/en/1", "block")),
        ("http://example.org/en/2", "example.org", "/en/2", ("org/", "allow")),
        ("http://notexample.org/en/1", "notexample.org", "/en/1", ("org/", "allow")),
        ("http://x.com?a=/fr/", "x.com", "", None),
        ("a://b://x.com/de/", "b:", "//x.com/de/", None),
    ],
)
def test_urls(url, host, path, hit):
    assert url_rules.split_url(url) == (host, path)
    assert url_rules.explicit(host, path) == hit


def test_url_verdicts(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").withColumn("host", F.lit(1))
    pages = pages.unionByName(spark.createDataFrame([(None, None, 1), (7, "", 1), (7, "", 1)], pages.schema))
    rules, strength = url_rules.mine(pages)
    assert rules and all(c >= url_rules.CONFIDENCE and s >= url_rules.SUPPORT for _, _, c, s in rules)
    # support and confidence by counting, and the index against trying every rule
    baskets = []
    for r in pages.collect():
        h, p = url_rules.split_url(r.url)
        if t := url_rules.tokens(r.url, h, p):
            baskets.append(({*url_rules.telling(t, strength)}, url_rules.label(h, p)))
    for items, verdict, c, s in rules[:50]:
        with_items = [v for t, v in baskets if set(items) <= t]
        assert abs(with_items.count(verdict) / len(with_items) - c) < 1e-9
    got = url_rules.judge(pages).collect()
    assert len(got) == pages.count()
    for r, src in zip(sorted(got, key=str), sorted(got, key=str)):
        assert r.verdict in ("allow", "block")
    url_of = {r.page_id: r.url for r in pages.where("page_id <> 7").collect()}
    for r in got:
        if r.page_id in url_of:
            h, p = url_rules.split_url(url_of[r.page_id])
            t = set(url_rules.telling(url_rules.tokens(url_of[r.page_id], h, p), strength))
            slow = next((v for items, v, _, _ in rules if set(items) <= t), "allow")
            hit = url_rules.explicit(h, p)
            assert (r.host, r.path, r.rule, r.verdict) == (h, p, *(hit or (None, slow)))
    assert all(r.verdict == "block" for r in got if "casino" in r.host and not r.rule)
    none = pages.where("false")
    assert url_rules.judge(none).count() == 0


def test_no_rule_is_missing(spark):
    """Verdicts by the pruned rules are those by all rules, counted from all subsets of all pages' tokens."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url")
    support, confidence = 0.02, 0.8
    rules, strength = url_rules.mine(pages, support=support, confidence=confidence)
    baskets = []
    for r in pages.collect():
        h, p = url_rules.split_url(r.url)
        if t := url_rules.tokens(r.url, h, p):
            baskets.append((url_rules.telling(t, strength), url_rules.label(h, p)))
    seen, hits = Counter(), Counter()
    for t, v in baskets:
        for n in range(1, len(t) + 1):
            for items in combinations(t, n):
                seen[items] += 1
                hits[items, v] += 1
    every = [(items, v, n / seen[items], n / len(baskets)) for (items, v), n in hits.items() if n >= support * len(baskets) and n / seen[items] >= confidence]
    every.sort(key=lambda r: (-r[2], -r[3], len(r[0]), r[0]))
    assert len(rules) < len(every)
    index = url_rules.inverted(rules)
    for t, _ in baskets:
        best = next(((v, c) for items, v, c, _ in every if set(items) <= set(t)), (None, 0))
        assert url_rules.match(index, t) == best[0]


def test_many_query_keys_do_not_multiply_rules(spark):
    """Pages of 20 keys, each page lacking another: every set of keys is frequent, of every support there is."""
    keys = [f"k{k}" for k in range(20)]
    many = [(k, f"https://{'casino-' if k % 3 == 0 else ''}a.example/x?" + "&".join(f"{x}=1" for x in keys if x != keys[k])) for k in range(20)]
    rest = [(100 + k, f"https://h{k % 50}.example/{'de' if k % 2 else 'fr'}/{k}") for k in range(980)]
    pages = spark.createDataFrame(many + rest, "page_id long, url string")
    began = time.time()
    rules, strength = url_rules.mine(pages)
    assert time.time() - began < 60 and sum(t.startswith("query=") for t in strength) == 20
    assert len(rules) <= 2**url_rules.WIDTH / url_rules.SUPPORT
    got = {r.page_id: r.verdict for r in url_rules.judge(pages).collect()}
    assert all((got[k] == "block") == (k % 3 == 0) for k in range(20)) and all(got[100 + k] == "allow" for k in range(980))


def test_tokens_that_tell_only_together_are_not_dropped(spark):
    """Pages of 11 frequent tokens and more; only two that say nothing alone tell the label, and no host word is frequent."""
    rng = np.random.default_rng(6)
    seeds = sorted(url_rules.SEEDS)
    pages, block = [], {}
    for k in range(400):
        a, b = k % 2, k // 2 % 2
        block[k] = a == b
        host = f"{seeds[k // 4 % 10] if a == b else 'h' + str(k // 4 % 10)}.example"
        keys = "&".join(f"k{x}=1" for x in rng.choice(12, 9, replace=False))
        pages.append((k, f"https://{host}/{'ax'[a]}/{'by'[b]}?{keys}"))
    frame = spark.createDataFrame(pages, "page_id long, url string")
    rules, strength = url_rules.mine(frame, support=0.1)
    assert sum(t.startswith("query=") for t in strength) == 12 and not any(t.startswith("host=") for t in strength)
    for path in (("path0=a", "path1=b"), ("path0=x", "path1=y")):
        assert (path, "block", 1.0, 0.25) in rules
    # every rule that is not redundant, by counting all sets
    baskets = [(url_rules.telling(url_rules.tokens(u, *url_rules.split_url(u)), strength), "block" if block[k] else "allow") for k, u in pages]
    seen, hits = Counter(), Counter()
    for t, v in baskets:
        for n in range(1, len(t) + 1):
            for items in combinations(t, n):
                seen[items] += 1
                hits[items, v] += 1
    every = {(items, v): n / seen[items] for (items, v), n in hits.items() if n >= 40 and n / seen[items] >= url_rules.CONFIDENCE}
    new = {(items, v, c) for (items, v), c in every.items() if not any(every.get((less, v), 0) >= c for n in range(1, len(items)) for less in combinations(items, n))}
    assert new == {r[:3] for r in rules}


def test_a_label_repeated_many_times_crowds_nothing_out(spark):
    """13,000 copies of one bad document beside 39 good ones: the model still tells them apart, as with one copy."""
    good = [(k, f"a calm and well made sentence number {k} about rivers, towns and the people who live there") for k in range(1, 60) if zlib.crc32(str(k).encode()) % 4 != 2][:39]
    bad = [(1000, "### $$$ BUY BUY NOW!!! ### $$$")]
    labels = spark.createDataFrame([(k, 1) for k, _ in good] + [(1000, 0)] * 3, "doc_id long, quality int")
    assert zlib.crc32(b"1000") % 4 != 2
    one = spark.createDataFrame(good + bad, "doc_id long, text string")
    many = spark.createDataFrame(good, "doc_id long, text string").unionByName(spark.range(13_000).select(F.lit(1000).cast("long").alias("doc_id"), F.lit(bad[0][1]).alias("text")))
    trained = [quality_model.train(x, labels, "doc_id", "text", "quality", quality_model.FOLDS, quality_model.MOST_LABELLED) for x in (one, many)]
    assert np.allclose(trained[0][0], trained[1][0]) and trained[0][0].any() and trained[0][1:] == trained[1][1:]
    rare, stand = quality_model.stratified(labels, "quality", "doc_id", quality_model.FOLDS, 8)
    assert rare.where("_label = 0").count() == 1 and rare.count() == 5 and stand[1] == 39 / 4 and stand[0] == 1


def accuracy(out, labels, label):
    both = out.join(labels.select("doc_id", label), "doc_id").where("held_out").select("predicted", label).collect()
    return sum(r.predicted == r[label] for r in both) / len(both)


def test_quality_model(spark, docs):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    whole = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    out = quality_model.score(whole, labels)
    assert accuracy(out, labels, "quality") > 0.97
    rows = quality_model.score(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode() if r.doc_id is not None else b"") % 4 == 2) for r in rows)
    none = labels.where("false")
    assert quality_model.score(docs, none).count() == docs.count() and quality_model.score(docs.where("false"), labels).count() == 0


def test_quality_features_by_definition():
    f = quality_model.Features()
    text = "Ab, ab cd!\nAb, ab cd! #"
    x = f(text)
    hashed = np.zeros(quality_model.HASHED)
    for w in text.split():
        bare = w.strip(".,:;!?#").lower().encode()
        for part in (bare, b"<" + bare[:3], bare[-3:] + b">"):
            hashed[zlib.crc32(part) % quality_model.HASHED] += 1
    hashed = np.log(1 + hashed)
    assert np.allclose(x[12:], hashed / np.sqrt((hashed**2).sum()), atol=1e-6)
    assert np.allclose(x[:12], quality_model.counted(quality_model.TextView(text)), atol=1e-6)
    assert len(f(None)) == f.size and not f(None)[12:].any()


def test_pairs_pull_apart():
    """The fit's loss over all pairs is near the least that plain gradient descent on every pair reaches."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(60, 4)).astype(np.float32)
    y = (x[:, 0] - 0.5 * x[:, 1] + rng.normal(0, 0.7, 60) > 0).astype(int)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    diff = (x[good][:, None] - x[bad][None]).reshape(-1, 4)
    loss = lambda w: float(np.log1p(np.exp(-diff @ w)).mean())
    w, threshold, _ = quality_model.fit(x, y, rounds=600)
    slow = np.zeros(4)
    for _ in range(4000):
        slow += 0.5 * (diff / (1 + np.exp(diff @ slow))[:, None]).mean(0)
    assert loss(w) < loss(slow) + 0.01 < loss(np.zeros(4))
    assert (x @ w < threshold).sum() == len(bad)


def test_every_labelled_text_counts(spark):
    """With a start from 40 of 400 ids the threshold parts all ids by the number of bad ones, not those 40 only."""
    ids = [k for k in range(700) if zlib.crc32(str(k).encode()) % 4 != 2][:400]
    rng = np.random.default_rng(2)
    rows = [(k, " ".join(["calm", "river", "###", "BUY"][j] for j in rng.integers(0, 3 if k % 3 else 4, 12))) for k in ids]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k in ids], "doc_id long, quality int")
    weights, threshold, scale = quality_model.train(docs, labels, "doc_id", "text", "quality", quality_model.FOLDS, 40)
    f = quality_model.Features()
    s = np.array([float(f(t) @ weights) for _, t in rows])
    bad = sum(k % 3 == 0 for k in ids)
    order = np.sort(s)
    assert order[bad - 1] - 1e-4 <= threshold <= order[bad] + 1e-4 and abs(scale - s.std() / 4) < 1e-4


def test_quality_score_by_definition(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    whole = spark.read.parquet(f"{SF}/documents.parquet")
    weights, threshold, scale = quality_model.train(whole, labels, "doc_id", "text", "quality", quality_model.FOLDS, quality_model.MOST_LABELLED)
    f = quality_model.Features()
    want = {r.doc_id: 1 / (1 + np.exp(-np.clip((float(f(r.text) @ weights) - threshold) / scale + np.log(0.7 / 0.3), -40, 40))) for r in whole.collect()}
    got = {r.doc_id: r.score for r in quality_model.score(whole, labels).collect()}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_stored_features_are_the_features_and_small(spark):
    """Texts are measured once; what is stored gives the same features in under half of six bytes a place, and rows with null ids stay."""
    rng = np.random.default_rng(5)
    rows = [(k, " ".join(f"w{x}" for x in rng.integers(0, 3000, 400))) for k in range(20)]
    rows += [(20, ""), (None, None), (21, "one"), (22, "same " * 70_000), (22, "zz aa"), (23, "#" * 300)]
    made = quality_model.measured(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").toArrow()
    f = quality_model.Features()
    assert sorted(made["key"].to_pylist(), key=str) == sorted((k for k, _ in rows), key=str)
    at, values, sizes = quality_model.unpacked(made["x"])
    x = np.zeros((len(sizes), f.size), np.float32)
    x[np.repeat(np.arange(len(sizes)), sizes), at] = values
    of = {hashlib.md5((t or "").encode()).digest(): f(t) for _, t in rows}
    assert all(np.allclose(row, of[h], atol=1e-6) for row, h in zip(x, made["hash"].to_pylist()))
    assert sum(map(len, made["x"].to_pylist())) < 3 * int(sizes.sum())


def test_learnt_terms_are_caught_misspelled(spark):
    """A word of several toxic texts is learnt, and a misspelling of it counts; words of clean texts near it don't."""
    toxic = [(i, f"you great schwachkopf number {i} and blödian here", 1) for i in range(1, 40)]
    clean = [(100 + i, f"plain words about schwachkopg number {i} here", 0) for i in range(40)]
    rows = [(k, t) for k, t, _ in toxic + clean] + [(500, "a schwachkobf again"), (501, "a schwachkopg again"), (502, "nothing at all")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, _, y in toxic + clean], "doc_id long, toxic int")
    taught = toxicity.learn(docs, labels, "doc_id", "text", "toxic", toxicity.FOLDS, 1000)
    assert "schwachkopf" in taught["learnt"] and "schwachkopg" in taught["ordinary"] and (taught["weights"] >= 0).all()
    got = {r.doc_id: r.score for r in toxicity.score(docs, labels).collect()}
    assert got[500] > 0 and got[501] == got[502] == 0
    scorer = toxicity.Scorer(toxicity.TERMS, **taught)
    assert all(abs(got[k] - (1 - np.exp(-(scorer.features(t) * taught["weights"]).sum()))) < 1e-9 for k, t in rows)


def plain_features(text, terms, learnt, ordinary, reporting, address):
    """Kinds and settings of hits by edit distances and windows, word by word."""
    words = (text or "").encode().split()
    bare = [w.strip(toxicity.EDGE).lower() for w in words]

    def hit(b):
        for k, lexicon in enumerate((terms, learnt)):
            costs = []
            for form in {b, b.translate(toxicity.LEET)}:
                w = form.decode("utf-8", "replace")
                costs += [0 for t in lexicon if t.endswith("*") and w.startswith(t[:-1])]
                costs += [d for t in lexicon if not t.endswith("*") and (d := edit_distance(w, t)) <= toxicity.edits_of(t)]
            if costs and not (min(costs) and b.decode("utf-8", "replace") in ordinary):
                return 2 * k + (min(costs) > 0)
        return None

    out, counted = np.zeros(16), set()
    for i, b in enumerate(bare):
        kind = hit(b)
        if kind is None or (kind >= 2 and b in counted):
            continue
        counted |= {b} if kind >= 2 else set()
        near = set(bare[max(0, i - 6) : i + 7])
        quoted = bool(near & reporting) or any(q in w for w in words[max(0, i - 2) : i + 3] for q in toxicity.QUOTES)
        out[4 * kind + 2 * quoted + bool(near & address)] += 1
    return out


def test_settings_by_definition():
    rng = np.random.default_rng(6)
    learnt, ordinary, reporting, address = ["schwachkopf", "bloe*"], {"idiom"}, frozenset({b"sagte", b"said"}), frozenset({b"du", b"you"})
    pool = ["idiot", "1diot!", "idiom", "idiott", "morron", "\"moron\"", "schwachkopf", "schwachkobf,", "bloedel", "stupid,", "du", "you", "said", "sagte:", "«plain»", *[f"w{k}" for k in range(12)]]
    scorer = toxicity.Scorer(toxicity.TERMS, learnt, ordinary, reporting=reporting, address=address)
    seen = np.zeros(16)
    for _ in range(300):
        text = " ".join(rng.choice(pool, rng.integers(0, 40)))
        got = scorer.features(text)
        assert (got == plain_features(text, toxicity.TERMS, learnt, ordinary, reporting, address)).all(), text
        seen += got
    assert (seen > 0).all()


def test_context_words_are_learnt(spark):
    """Words that stand by a term in clean texts only come to mean a quotation, others in toxic ones an address."""
    rest = " ".join(f"nummer {w}" for w in ("eins", "zwei", "drei", "vier", "acht", "neun", "zehn", "elf"))
    toxic = [(k, f"hau ab {'dein' if k % 2 else 'euch'} idiot nummer {k} und weg hier {rest}", 1) for k in range(1, 60)]
    clean = [(100 + k, f"der richter zitierte idiot nummer {k} im urteil und dann {rest}", 0) for k in range(60)]
    docs = spark.createDataFrame([(k, t) for k, t, _ in toxic + clean], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, _, y in toxic + clean], "doc_id long, toxic int")
    taught = toxicity.learn(docs, labels, "doc_id", "text", "toxic", toxicity.FOLDS, 1000)
    assert b"zitierte" in taught["reporting"] and b"dein" in taught["address"] and not {b"nummer"} & (taught["reporting"] | taught["address"])
    got = {r.doc_id: r.score for r in toxicity.score(docs, labels).collect()}
    assert min(got[k] for k, _, _ in toxic) > 0.5 > max(got[k] for k, _, _ in clean)


def test_weights_follow_the_labels():
    """A setting whose hits are all clean loses its weight; one whose hits are all toxic keeps or gains it."""
    x = np.zeros((200, len(toxicity.START)))
    x[:100, 0], x[100:, 2] = 1, 1
    w = toxicity.fit(x, np.repeat([1, 0], 100))
    assert w[2] < 0.1 * toxicity.START[2] and w[0] > 2 * toxicity.START[0] and np.allclose(w[4:], toxicity.START[4:])


def test_held_out_labels_are_not_read(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{x}.parquet") for x in ("documents", "labels"))
    odd = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    odd = odd.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    for f in (quality_model.score, toxicity.score):
        assert sorted(f(docs, labels).collect()) == sorted(f(docs, odd).collect())


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_against_edit_distance():
    terms = ["loser", "moron", "worthless", "disgusting", "scum", "sun*", "trash"]
    lex = toxicity.Lexicon(terms)
    rng = np.random.default_rng(3)
    words = set()
    for t in terms:
        for _ in range(300):
            w = list(t.strip("*"))
            for _ in range(rng.integers(0, 4)):
                k, at, c = rng.integers(0, 3), int(rng.integers(0, len(w) + 1)), "abcdeghilmnorstuw"[rng.integers(0, 17)]
                if k == 0:
                    w.insert(at, c)
                elif w and at < len(w):
                    w[at : at + 1] = [c] if k == 1 else []
            words.add("".join(w))
    for w in words:
        d = [edit_distance(w, t) for t in terms if t[-1] != "*" and edit_distance(w, t) <= toxicity.edits_of(t)]
        assert lex.edits(w) == (0 if w.startswith("sun") else min(d, default=None)), w


def test_toxicity(spark, docs):
    whole, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{x}.parquet") for x in ("documents", "labels"))
    assert accuracy(toxicity.score(whole, labels), labels, "toxic") > 0.97
    rows = toxicity.score(docs, labels).collect()
    assert len(rows) == docs.count() and all(r.predicted == (r.score >= 0.5) for r in rows)
    assert toxicity.score(docs, labels.where("false")).count() == docs.count() and toxicity.score(docs.where("false"), labels).count() == 0
    s = toxicity.Scorer(toxicity.TERMS)
    assert s.score(None) == s.score("") == s.score("plain words") == 0
    assert s.score("you are an id1ot, a real stupidd l0ser") > 0.5 > s.score('he wrote the word "idiot" there')
