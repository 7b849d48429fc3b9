"""Byte-level BPE over a whole corpus: each distinct word is encoded once, wherever and however often it occurs.

Encoding: a task cuts its texts into words (pre-tokens) and explodes them with their positions, block by block, a block
being consecutive texts up to a bound of words. It emits the distinct words of the block by bucket of their hash, and the
words of its texts in order as packed numbers. Buckets meet in one global shuffle, where each distinct word is encoded
once; its ids go back to the blocks that have it, and documents are put together by position. A word is shuffled once a
block and not once an occurrence, so the hottest word has a row a block, as any word of every block has; nothing is
written in between, and the whole is one pass over the texts.

Decoding: each document's distinct ids are exploded and joined with the token-byte table, which has a row for each token
of the vocabulary: its size is bounded, so it is broadcast. Nothing shuffles, so the rows of a document stay together, and
its bytes are then put together by position.

Defined results: a null text is empty and has no ids; repeated rows are separate documents; texts and words are taken
whole, however long; an empty table gives an empty table; kept columns may have any name but that of a new one, which
replaces it. Null ids decode to no bytes; an id outside the vocabulary is an error.
"""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from .common import tidy

#: Words of text at which a block ends (a longer text is a block of its own); they bound what a task holds of one.
BLOCK = 1 << 22
#: Distinct words that a task remembers before it starts afresh; beyond them a word may be encoded again, to the same ids.
REMEMBERED = 1 << 21
MOST_BUCKETS = 1 << 16
#: Ids that a task hands on at a time.
GIVEN = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary: on each line a token in base 64 and its id."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def pack(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32 in few bytes: as many planes of bytes as the largest needs, compressed."""
    import zstandard

    n = np.ascontiguousarray(numbers, "<u4").view(np.uint8).reshape(-1, 4)
    planes = max(1, (int(numbers.max()).bit_length() + 7) // 8) if len(numbers) else 1
    return bytes([planes]) + zstandard.compress(np.ascontiguousarray(n[:, :planes].T).tobytes(), 3)


def unpack(packed: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.decompress(packed[1:]), np.uint8).reshape(packed[0], -1)
    out = np.zeros((planes.shape[1], 4), np.uint8)
    out[:, : packed[0]] = planes.T
    return out.reshape(-1).view("<u4")


def _squeeze(data: bytes) -> bytes:
    import zstandard

    return zstandard.compress(data, 3)


def _expand(data: bytes) -> bytes:
    import zstandard

    return zstandard.decompress(data)


def _rows(doc: StructField) -> StructType:
    """Rows of a block: its buckets of words (part: the bucket), its order (the number of buckets), its documents (one more)."""
    return StructType().add("block", "string").add("part", "integer").add("nth", "integer").add("n", "integer").add(doc).add("sizes", "binary").add("data", "binary")


def explode_words(docs: DataFrame, pattern: str, buckets: int, block: int = BLOCK) -> DataFrame:
    """The rows of all blocks, from (row, doc, text): words in order of bucket, then of falling frequency in the block;
    the order row has each word's bucket and all places, by rank of frequency; a document's row the number of its words."""
    schema = _rows(StructField("doc", docs.schema["doc"].dataType))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        words_of = regex.compile(pattern).findall

        def closed() -> pa.RecordBatch:
            at = np.concatenate([np.zeros(0, np.uint32), *places])
            order = np.argsort(-np.bincount(at, minlength=len(known)), kind="stable")
            rank = np.empty(len(known), np.uint32)
            rank[order] = np.arange(len(known), dtype=np.uint32)
            words = list(known)
            raw = [words[k].encode() for k in order.tolist()]
            bucket = np.fromiter((zlib.crc32(w) % buckets for w in raw), np.int64, len(raw))
            by = np.argsort(bucket, kind="stable")
            used, begins = np.unique(bucket[by], return_index=True)
            sizes, data = [], []
            for members in np.split(by, begins[1:]) if len(used) else []:
                ws = [raw[k] for k in members.tolist()]
                sizes.append(pack(np.fromiter(map(len, ws), np.int64, len(ws))))
                data.append(_squeeze(b"".join(ws)))
            m, k = len(places), len(used)
            kept = pa.concat_arrays(docs_)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * (k + 1 + m), pa.string()),
                    pa.array([*used.tolist(), buckets, *[buckets + 1] * m], pa.int32()),
                    pa.array([0] * (k + 1) + list(range(m)), pa.int32()),
                    pa.array([0] * (k + 1) + [len(p) for p in places], pa.int32()),
                    pa.concat_arrays([pa.nulls(k + 1, kept.type), kept]),
                    pa.array([*sizes, pack(bucket), *[None] * m], pa.binary()),
                    pa.array([*data, pack(rank[at]), *[None] * m], pa.binary()),
                ],
                names=schema.names,
            )

        known: dict[str, int] = defaultdict()
        known.default_factory = known.__len__
        name, size, places, docs_ = "", 0, [], []
        for batch in batches:
            begin = 0
            for k, (row, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2))):
                found = words_of(text.as_py() or "")
                if places and size + len(found) > block:
                    docs_.append(batch.column(1).slice(begin, k - begin))
                    yield closed()
                    known.clear()
                    size, places, docs_, begin = 0, [], [], k
                name = name if places else str(row)  # a block is named by its first row
                places.append(np.fromiter(map(known.__getitem__, found), np.uint32, len(found)))
                size += len(found)
            docs_.append(batch.column(1).slice(begin))
        if places:
            yield closed()

    return docs.select("row", "doc", "text").mapInArrow(tidy(run), schema)


def encode_words(parts: DataFrame, ranks_path: str, buckets: int) -> DataFrame:
    """Rows of blocks with ids in place of words: sizes are numbers of ids. A word is one match, whatever it holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        one = tiktoken.Encoding("words", pat_str=r"(?s:.+)", mergeable_ranks=read_ranks(ranks_path), special_tokens={}).encode_ordinary
        known: dict[bytes, list[int]] = {}
        for batch in batches:
            sizes, data = [], []
            for part, size, raw in zip(batch.column(1).to_pylist(), batch.column(5).to_pylist(), batch.column(6).to_pylist()):
                if part < buckets:
                    ends, text, ids, at = np.cumsum(unpack(size), dtype=np.int64).tolist(), _expand(raw), [], 0
                    for end in ends:
                        word = text[at:end]
                        at = end
                        got = known.get(word)
                        if got is None:
                            if len(known) >= REMEMBERED:
                                known.clear()
                            got = known[word] = one(word.decode())
                        ids.append(got)
                    size, raw = pack(np.fromiter(map(len, ids), np.int64, len(ids))), pack(np.fromiter((i for x in ids for i in x), np.int64))
                sizes.append(size)
                data.append(raw)
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sizes, pa.binary()), pa.array(data, pa.binary())], names=batch.schema.names)

    return parts.mapInArrow(tidy(run), parts.schema)


def _together(parts: DataFrame, buckets: int) -> DataFrame:
    """(doc, ids) from the sorted rows of each block: its words' ids, its order, its documents."""
    schema = StructType().add(parts.schema["doc"]).add("ids", ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, ids = [], []

        def some(docs: pa.Array, kept: list[int], out: list[np.ndarray]) -> pa.RecordBatch:
            ends = np.cumsum([0, *map(len, out)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(out)))
            return pa.RecordBatch.from_arrays([docs.take(pa.array(kept, pa.int64())), lists], names=schema.names)

        for batch in batches:
            kept, out, held = [], [], 0
            for k, (part, n, size, data) in enumerate(zip(*(batch.column(c).to_pylist() for c in (1, 3, 5, 6)))):
                if part < buckets:
                    sizes.append(unpack(size))
                    ids.append(unpack(data).astype(np.int32))
                elif part == buckets:  # all words of the block have come, in order of bucket
                    none = np.zeros(0, np.int64)
                    lengths, flat = np.concatenate([none, *sizes]).astype(np.int64), np.concatenate([none.astype(np.int32), *ids])
                    by = np.argsort(unpack(size), kind="stable")
                    starts, lens = np.empty(len(by), np.int64), np.empty(len(by), np.int64)
                    starts[by], lens[by] = np.cumsum(lengths) - lengths, lengths
                    places, at = unpack(data), 0
                    sizes, ids = [], []
                else:
                    p = places[at : at + n].astype(np.int64)
                    at += n
                    m = lens[p]
                    ends = np.cumsum(m)
                    total = int(ends[-1]) if n else 0
                    out.append(flat[np.repeat(starts[p] - (ends - m), m) + np.arange(total)])
                    kept.append(k)
                    held += total
                    if held >= GIVEN:
                        yield some(batch.column(4), kept, out)
                        kept, out, held = [], [], 0
            if kept:
                yield some(batch.column(4), kept, out)

    return parts.mapInArrow(tidy(run), schema)


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), block: int = BLOCK) -> DataFrame:
    """The kept columns of each document and its ids."""
    buckets = min(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), MOST_BUCKETS)
    slim = docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*keep).alias("doc"), F.col(text).cast("string").alias("text"))
    rows = explode_words(slim, pattern, buckets, block)
    met = rows.repartition(F.when(F.col("part") < buckets, F.col("part").cast("string")).otherwise(F.col("block")))
    back = encode_words(met, ranks_path, buckets).repartition("block").sortWithinPartitions("block", "part", "nth")
    return _together(back, buckets).select(*(F.col(f"doc.`{c}`").alias(c) for c in keep if c != "ids"), "ids")


def token_bytes(spark: SparkSession, ranks_path: str) -> DataFrame:
    """(id, bytes): the token-byte table, a row for each token of the vocabulary."""
    ranks = read_ranks(ranks_path)
    return spark.createDataFrame(pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "bytes": pa.array([bytes(b) for b in ranks], pa.binary())}))


def decode(rows: DataFrame, ranks_path: str, ids: str = "ids") -> DataFrame:
    """The other columns of ``rows`` and ``decoded``, the bytes of their ids."""
    rest = [c for c in rows.columns if c not in (ids, "decoded")]
    whole = F.struct(*rest, F.coalesce(F.col(ids).cast("array<int>"), F.array().cast("array<int>")).alias("_ids"))
    each = rows.select(whole.alias("doc")).select("doc", F.posexplode_outer(F.array_distinct("doc._ids")).alias("pos", "id"))
    each = each.select(F.when(F.coalesce("pos", F.lit(0)) == 0, F.col("doc")).alias("doc"), F.coalesce("pos", F.lit(0)).alias("pos"), "id")
    got = each.join(F.broadcast(token_bytes(rows.sparkSession, ranks_path)), "id", "left").select("doc", "pos", "id", "bytes")
    kept = StructField("doc", StructType(got.schema["doc"].dataType.fields[:-1] or [StructField("_", IntegerType())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A document's row with its distinct ids, the first of them beside the document itself."""
        doc, wanted, found, tokens, nth = None, None, [], [], 0

        def decoded() -> bytes:
            known, data = np.concatenate(found), pa.concat_arrays(tokens)
            if not len(wanted):
                return b""
            if data.null_count:
                raise ValueError(f"no token has the id {int(known[data.is_null().to_numpy(zero_copy_only=False)][0])}")
            order = np.argsort(known, kind="stable")
            got = data.take(pa.array(order[np.searchsorted(known[order], wanted)])).cast(pa.large_binary())
            ends = np.frombuffer(got.buffers()[1], np.int64, len(got) + 1, got.offset * 8)
            return bytes(memoryview(got.buffers()[2])[ends[0] : ends[-1]])

        for batch in batches:
            if not batch.num_rows:
                continue
            docs, pos, id_, data = batch.column(0), batch.column(1).to_numpy(), batch.column(2), batch.column(3)
            if (pos[1:] - pos[:-1] != 1)[pos[1:] != 0].any() or (pos[0] and pos[0] != nth):
                raise RuntimeError("ids of a document came out of order")
            nth = int(pos[-1]) + 1
            begins = np.flatnonzero(pos == 0).tolist()
            done, out = [], []
            for b, e in zip([*([0] if pos[0] else []), *begins], [*begins[0 if pos[0] else 1 :], len(pos)]):
                if pos[b] == 0:
                    if doc is not None:
                        done.append(doc)
                        out.append(decoded())
                    doc, found, tokens = docs.slice(b, 1), [], []
                    wanted = doc.field(doc.type.num_fields - 1)[0].values.to_numpy(zero_copy_only=False)
                found.append(id_.slice(b, e - b).fill_null(-1).to_numpy(zero_copy_only=False))
                tokens.append(data.slice(b, e - b))
            if done:
                yield finished(done, out)
        if doc is not None:
            yield finished([doc], [decoded()])

    def finished(docs: list, out: list) -> pa.RecordBatch:
        every = pa.concat_arrays(docs)
        fields = [every.field(k) for k in range(every.type.num_fields - 1)] or [pa.nulls(len(every), pa.int32())]
        return pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(fields, names=kept.dataType.names), pa.array(out, pa.binary())], names=["doc", "decoded"])

    out = got.mapInArrow(tidy(run), StructType([kept, StructField("decoded", BinaryType())]))
    return out.select(*(F.col(f"doc.`{c}`").alias(c) for c in rest), "decoded")
