"""Fill-in-middle, byte-level BPE and the conversation trie against plain versions over small tables."""

import base64
import hashlib
import re
import zlib
from collections import defaultdict

import duckdb
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, conversations, fim, queries, sql

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TEXTS = [
    None, "", " ", "a", "Zoë's 12,5 €\n\n  two  lines  x\x1c\x1d\x85 y", "漢字 \U0001f600\U0001f600 é", "has <P> in it", "<S>", "ends with <", "<P", "P> <M", "it's we'll THEY'RE 'D",
    "same words same words", "same words same words", "word " * 20000, "x" * 100000, "1a2b3c" * 3000 + " \t \r\n", "\n".join(f"line {k % 7}" for k in range(500)),
]


def sha(x):
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k if k != 5 else None, t, k, "out", "tag") for k, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[4], *((100 + k, f"document {k} of A{'b' * (k % 5)}.", k, "o", "t") for k in range(300))], "doc_id long, text string, n long, output string, doc string").repartition(5)


def plain_fim(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    if h4 % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle(docs):
    got = fim.restore(fim.transform(docs.withColumn("form", F.lit("x")))).collect()
    assert len(got) == docs.count()
    assert {"psm", "spm", "plain"} == {r.form for r in got}
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_fim(r.doc_id, r.text)
        assert r.output_sha256 == sha(r.output) and r.restored_sha256 == sha(r.text or "") and r.restored_text == (r.text or "") and r.doc in ("tag", "t")
    assert fim.restore(fim.transform(docs.limit(0))).collect() == []


def test_markers_where_parts_meet():
    unit = fim.regex.compile(fim.UNIT)
    for text in ("<S", "a<M><", "<<<P", "P><S", "<M", "M>x<"):
        for key in range(40):
            n, form, _, _, output = fim.cut(text, str(key), unit)
            assert fim.rebuilt(output, form) == text


@pytest.mark.parametrize("block", [64, byte_bpe.BLOCK])
def test_bpe_equals_the_library_and_decodes(docs, block):
    ranks = byte_bpe.read_ranks(RANKS)
    assert ranks == {base64.b64decode(a): int(b) for a, b in (x.split() for x in open(RANKS, "rb"))}
    library = tiktoken.Encoding("library", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN, keep=("doc_id", "text", "doc"), block=block)
    got = byte_bpe.decode(ids.withColumn("kept", F.col("ids")), RANKS).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.kept == library.encode_ordinary(r.text or "")
        assert bytes(r.decoded).decode() == (r.text or "") and r.doc in ("tag", "t")


def test_bpe_of_nothing_and_unknown_ids(spark, docs):
    assert byte_bpe.decode(byte_bpe.encode(docs.limit(0), RANKS, public_tokenizers.PATTERN), RANKS).collect() == []
    none = byte_bpe.decode(spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>"), RANKS).collect()
    assert sorted((r.doc_id, bytes(r.decoded)) for r in none) == [(1, b""), (2, b"")]
    with pytest.raises(Exception, match="no token has the id 50256"):
        byte_bpe.decode(spark.createDataFrame([([50256],)], "ids array<int>"), RANKS).collect()


def plain_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        first = c - (c % 5 if c >= 0 else -(-c % 5))
        made[c] = tuple(own.get(first, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    out = []
    for node, cs in members.items():
        below = [x for x in members if x[: len(node)] == node]
        leaves = [x for x in below if not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in below)]
        ends = ",".join(str(c) for c in sorted(cs) if made[c] == node)
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below if x)
        children = sum(len(x) == len(node) + 1 for x in below)
        out.append((min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), children, len(leaves), saved, sha(ends)))
    return sorted(out, key=str)


COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def trie_rows(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in conversations.trie(df).collect()), key=str)


def odd_turns():
    rows = [(c, t, "user" if t % 2 == 0 else "bot", f"turn {t} of {c % 3 if t < 3 else c % 11}é") for c in range(-12, 60) for t in range(c % 13)]
    rows += [(None, 1, "user", "nobody's"), (70, None, None, None), (70, None, None, None), (70, 2, "user", "b"), (70, 2, "user", "a"), (70, 2, "bot", "z"), (71, 1, "user", "x" * 50000), (71, 1, "user", "x" * 50000 + "y")]
    rows += [(c, 0, "user", "copy") for c in range(200_000, 200_300)] + [(100, t, "user", "same") for t in range(150)] + [(101, t, "user", "same") for t in range(200)]
    return rows


def test_trie(spark):
    rows = odd_turns()
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumns({"key": F.lit(1), "depth": F.lit("x")})
    assert trie_rows(df.repartition(7)) == plain_trie(rows)
    assert conversations.trie(df.limit(0)).collect() == []


def test_trie_of_one_long_conversation_over_many_tasks(spark):
    rows = [(5, t, "user", f"{t % 10}") for t in range(3000)] + [(7, t, "user", f"{t % 10}") for t in range(1000)] + [(6, t, "user", f"{t % 10}") for t in range(7)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = trie_rows(df.repartition(4))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    made = {5: 3000, 7: 1000, 6: 7}
    assert all(n >= zlib.crc32(str(c).encode()) % 9 for c, n in made.items())  # so all three are whole prefixes of one path
    want = []
    for d in range(3001):
        here = sorted(c for c, n in made.items() if n >= d)
        above = sorted(c for c, n in made.items() if n >= d - 1)
        saved = sum((sum(n >= e for n in made.values()) - 1) for e in range(max(d, 1), 3001))
        ends = ",".join(str(c) for c in here if made[c] == d)
        want.append((here[0], d, above[0] if d else None, len(here), int(d < 3000), 1, saved, sha(ends)))
    assert got == sorted(want, key=str)


def test_queries_equal_their_sql_on_odd_rows(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(odd_turns(), "conv_id long, turn int, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    duck = duckdb.connect()
    for t in ("documents", "conversations"):
        duck.sql(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    for f in (queries.op11_fill_in_middle, queries.op12_conversation_trie):
        got, want = f(spark, str(tmp_path)), duck.sql(sql.ORACLES[f.__name__])
        assert sorted(got.columns) == sorted(want.columns)
        assert sorted((tuple(r[c] for c in want.columns) for r in got.collect()), key=str) == sorted(want.fetchall(), key=str)
