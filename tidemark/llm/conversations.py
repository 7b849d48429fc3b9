"""A prefix trie over conversations: which ones share how many turns, and what that sharing saves.

A conversation is rebuilt before it enters the trie: it begins with turns of the first conversation of its family
(branches of one dialogue) and goes on with its own. Every sequence of first turns is a node.

1. Turns are sorted by range of (conversation, turn), so that one conversation may fill many tasks. Each task runs
   through its own range, adding up two polynomials of the turns' hashes; what a conversation brings along from earlier
   ranges is a row for each task. A prefix is named by its two sums, which is also how a branch continues another's.
2. Partial tries: a task combines its entries of a node before anything is shuffled. Tables of nodes are merged in
   rounds by hash, first in groups of tables, then whole; members are summed, the smallest member stays, and ends are
   merged as lists of a bounded range of ids each.
3. Rollup from the bottom up: nodes with the same smallest member form a chain, the lower end of that member's path.
   Each chain is summed along itself, and its total climbs to all prefixes of its conversation. A node's subtree is then
   what has climbed to it, less what stands above it on its own chain. No round for each depth, so depth has no bound.

Defined results: rows without conversation id belong to none and are left out; a null role or text is empty; turns are
ordered by turn (null first), equal ones by role and text; repeated rows are turns of their own; texts count whole; other
columns are ignored whatever their names; an empty table gives no node, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import written

FAMILY, SHARES = 5, 9
#: Odd multipliers of the two polynomials, modulo 2**64; odd, so that their powers have inverses.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Entries that a task combines at a time, groups of tables that are merged first, and ids in a piece of an end list.
COMBINED, GROUPS, PIECE_BITS = 1 << 18, 64, 16
ROOT = bytes(16)
WRAP = (1 << 64) - 1


def _powers(base: int, exponents: np.ndarray) -> np.ndarray:
    out, b, e = np.ones(len(exponents), np.uint64), np.uint64(base), exponents.astype(np.uint64)
    while e.any():
        out = np.where(e & np.uint64(1), out * b, out)
        with np.errstate(over="ignore"):
            b = b * b
        e = e >> np.uint64(1)
    return out


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).view(np.uint64)


def running(rows: DataFrame, group: str, order: list[Column], split: list[Column], values: tuple[str, str], keep: tuple[str, ...], bases: tuple[int, int] = (1, 1)) -> DataFrame:
    """(group, values, keep, nth, c1, c2, p1, p2): each row's place in its group by ``order``, the sums of both values up to
    the row and before it, modulo 2**64; the nth value counts with the nth power of its base.

    A group may be as large as the table: rows are sorted by range, and only a row for each range goes to the driver.
    ``split`` must not contradict ``order``; it may leave out long texts.
    """
    names = [group, *values, *keep]
    sums = StructType().add("nth", "long").add("c1", "long").add("c2", "long").add("p1", "long").add("p2", "long")
    schema = StructType([rows.schema[c] for c in names] + sums.fields + StructType().add("part", "integer").fields)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, n, c = TaskContext.get().partitionId(), None, 0, np.zeros(2, np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column(0).to_numpy()
            begins = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1))
            of = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(key))))
            first = of == 0 if key[0] == last else np.zeros(len(key), bool)
            nth = np.arange(len(key)) - begins[of] + 1 + first * n
            out = []
            for k in (0, 1):
                term = _unsigned(batch.column(1 + k)) * _powers(bases[k], nth)
                upto = np.cumsum(term)
                upto = upto - np.where(begins > 0, upto[begins - 1], np.uint64(0))[of] + np.where(first, c[k], np.uint64(0))
                out.append((upto, upto - term))
                c[k] = upto[-1]
            last, n = key[-1], int(nth[-1])
            (c1, p1), (c2, p2) = out
            added = [pa.array(nth), *(pa.array(x.view(np.int64)) for x in (c1, c2, p1, p2)), pa.array(np.full(len(key), part, np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=schema.names)

    ordered = rows.repartitionByRange(F.col(group), *split).sortWithinPartitions(group, *order)
    local = written(ordered.select(*names).mapInArrow(fold, schema))
    tails = local.groupBy("part").agg(F.min(group).alias("first"), F.max(F.struct(group, "nth", "c1", "c2")).alias("tail")).orderBy("part").collect()  # a row for each task
    shifts, carried = {}, None
    for r in tails:
        key, n, c1, c2 = r.tail
        mine = (key, n, c1 & WRAP, c2 & WRAP)
        if carried and carried[0] == r.first:
            shifts[r.part] = carried
            if key == r.first:
                mine = (key, carried[1] + n, *((carried[2 + k] + pow(bases[k], carried[1], 1 << 64) * mine[2 + k]) & WRAP for k in (0, 1)))
        carried = mine
    if not shifts:
        return local.drop("part")

    def shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = len(names)
        for batch in batches:
            cols = list(batch.columns)
            parts, key = cols[-1].to_numpy(), cols[0].to_numpy()
            for part in np.unique(parts):
                if part in shifts:
                    group_, n, *c = shifts[part]
                    here = (parts == part) & (key == group_)
                    cols[at] = pa.array(cols[at].to_numpy() + here * n)
                    for k in (0, 1):
                        by = np.uint64(pow(bases[k], n, 1 << 64))
                        for j in (at + 1 + k, at + 3 + k):
                            v = _unsigned(cols[j])
                            cols[j] = pa.array(np.where(here, v * by + np.uint64(c[k]), v).view(np.int64))
            yield pa.RecordBatch.from_arrays(cols[:-1], names=schema.names[:-1])

    return local.mapInArrow(shift, StructType(schema.fields[:-1]))


def _keys(a: np.ndarray, b: np.ndarray) -> pa.Array:
    """Two sums as one binary value."""
    both = np.stack([a, b], axis=1).tobytes()
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(a), [None, pa.py_buffer(both)]).cast(pa.binary())


def _turns(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Each turn's place in its conversation, its bytes and the sums that name the prefix it ends and the one before."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    t = turns.select(F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), blank(role).alias("role"), blank(text).alias("text"), F.monotonically_increasing_id().alias("line"))
    t = t.where("conv is not null").withColumns({"x1": F.xxhash64("role", "text"), "x2": F.xxhash64(F.lit(1), "text", "role"), "bytes": F.octet_length("text").cast("long")})
    turn_first = F.col("turn").asc_nulls_first()
    # cuts are sampled on the driver, so by beginnings of texts only; rows that are equal as a whole may be cut anywhere
    short = F.length("role") <= 64
    split = [turn_first, F.substring("role", 1, 64), F.when(short, F.substring("text", 1, 64)), F.when(short & (F.length("text") <= 64), F.col("line"))]
    return running(t, "conv", [turn_first, F.col("role"), F.col("text")], split, ("x1", "x2"), ("bytes",), BASES)


def _plans(turns: DataFrame) -> DataFrame:
    """How each conversation is rebuilt: (conv, n, h, p, own, base): its turns, how many of its first ones are replaced and
    by how many, and its own and the family's first turns, ``SHARES - 1`` at most."""
    head = F.when(F.col("nth") < SHARES, F.struct("nth", "c1", "c2", "p1", "p2", "bytes"))
    convs = turns.groupBy("conv").agg(F.max("nth").alias("n"), F.array_sort(F.collect_list(head)).alias("own"))
    convs = convs.withColumns({"first": F.col("conv") - F.col("conv") % FAMILY, "h": (F.crc32(F.col("conv").cast("string").cast("binary")) % SHARES).cast("int")})
    firsts = convs.where(F.col("conv") % FAMILY == 0).select(F.col("conv").alias("first"), F.col("own").alias("base"))
    got = convs.join(firsts, "first", "left").withColumn("base", F.slice(F.coalesce("base", F.array().cast(firsts.schema["base"].dataType)), 1, F.col("h")))
    return written(got.withColumn("p", F.size("base")).drop("first"))


ENTRY = "key binary, parent binary, depth long, bytes long, conv long, ends boolean"


def _entries(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """A row for each rebuilt conversation and each of its prefixes, the empty one too."""
    length = F.col("p") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    none = F.struct(F.lit(0).cast("long").alias("nth"), *(F.lit(0).cast("long").alias(c) for c in ("c1", "c2", "p1", "p2", "bytes")))
    shared = plans.select("conv", length.alias("length"), F.explode(F.concat(F.array(none), "base")).alias("t"))
    shared = shared.select("conv", "length", F.col("t.nth").alias("depth"), "t.c1", "t.c2", "t.p1", "t.p2", "t.bytes", F.lit(0).alias("lift"), *(F.lit(0).cast("long").alias(c) for c in ("a1", "a2", "b1", "b2")))
    at = lambda xs, k, c: F.coalesce(F.get(xs, k - 1)[c], F.lit(0).cast("long"))
    plan = plans.select("conv", "n", "h", "p", length.alias("length"), *(at("own", F.col("h"), f"c{k}").alias(f"a{k}") for k in (1, 2)), *(at("base", F.col("p"), f"c{k}").alias(f"b{k}") for k in (1, 2)))
    own = turns.join(plan.where("n > h"), "conv").where("nth > h")
    own = own.select("conv", "length", (F.col("nth") - F.col("h") + F.col("p")).alias("depth"), "c1", "c2", "p1", "p2", "bytes", (F.col("h") - F.col("p")).cast("int").alias("lift"), "a1", "a2", "b1", "b2")

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        down = [np.array([pow(b, -k, 1 << 64) for k in range(SHARES)], np.uint64) for b in BASES]
        for batch in batches:
            col = {n: batch.column(n) for n in batch.schema.names}
            lift = col["lift"].to_numpy()
            moved = lambda c: [_unsigned(col[f"b{k}"]) + down[k - 1][lift] * (_unsigned(col[f"{c}{k}"]) - _unsigned(col[f"a{k}"])) for k in (1, 2)]  # noqa: E731, B023
            depth = col["depth"].to_numpy()
            parent = pc.if_else(pa.array(depth > 0), _keys(*moved("p")), pa.scalar(None, pa.binary()))
            yield pa.RecordBatch.from_arrays([_keys(*moved("c")), parent, col["depth"], col["bytes"], col["conv"], pa.array(depth == col["length"].to_numpy())], names=[c.split()[0] for c in ENTRY.split(", ")])

    return written(shared.unionByName(own).mapInArrow(name, ENTRY))


def _partial_tries(entries: DataFrame) -> DataFrame:
    """Each task's nodes: (key, parent, depth, bytes, n_convs, conv_id, part), the entries of a node combined."""
    same = ["key", "parent", "depth", "bytes"]

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, n = TaskContext.get().partitionId(), [], 0

        def trie() -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held).group_by(same).aggregate([("conv", "count"), ("conv", "min")])
            t = t.select([*same, "conv_count", "conv_min"]).append_column("part", pa.array(np.full(len(t), part, np.int32)))
            yield from t.rename_columns([*same, "n_convs", "conv_id", "part"]).combine_chunks().to_batches()

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= COMBINED:
                yield from trie()
                held, n = [], 0
        if n:
            yield from trie()

    return entries.select(*same, "conv").mapInArrow(combine, "key binary, parent binary, depth long, bytes long, n_convs long, conv_id long, part int")


def _merged(tries: DataFrame) -> DataFrame:
    """One table of nodes from those of all tasks: rounds of merges by hash, first of tables of one group."""
    for by in (["key", "part"], ["key"]):
        tries = tries.withColumn("part", F.col("part") % GROUPS)
        tries = tries.groupBy(*by).agg(*(F.first(c).alias(c) for c in ("parent", "depth", "bytes")), F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), *([] if "part" in by else [F.min("part").alias("part")]))
    return tries.drop("part")


def _ends(entries: DataFrame) -> DataFrame:
    """(key, ends_sha256) of each node at which conversations end: their ids in order, hashed as a stream of bounded pieces."""
    piece = F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda x: x.cast("string")), ",")
    pieces = entries.where("ends").groupBy("key", F.shiftright("conv", PIECE_BITS).alias("range")).agg(piece.alias("piece"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for batch in batches:
            done = []
            for k, piece_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k != key:
                    if sha:
                        done.append((key, sha.hexdigest()))
                    key, sha = k, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(piece_.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], names=["key", "ends_sha256"])
        if sha:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([sha.hexdigest()])], names=["key", "ends_sha256"])

    return pieces.repartition("key").sortWithinPartitions("key", "range").select("key", "piece").mapInArrow(digest, "key binary, ends_sha256 string")


def trie(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Every node of the trie: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    t = _turns(turns, conv, turn, role, text)
    entries = _entries(t, _plans(t))
    nodes = written(_merged(_partial_tries(entries)))
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    nodes = nodes.join(children, "key", "left").join(_ends(entries), "key", "left").join(parents, "parent", "left")
    nodes = nodes.withColumns({"n_children": F.coalesce("n_children", F.lit(0)).cast("long"), "ends_sha256": F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest()))})
    nodes = nodes.withColumns({"saved": (F.col("n_convs") - 1) * F.col("bytes"), "leaf": (F.col("n_children") == 0).cast("long")})
    chains = running(nodes, "conv_id", [F.col("depth")], [F.col("depth")], ("saved", "leaf"), ("key", "depth", "parent_conv_id", "n_convs", "n_children", "ends_sha256"))
    totals = chains.groupBy(F.col("conv_id").alias("conv")).agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"))
    climbed = entries.select("key", "conv").join(totals, "conv").groupBy("key").agg(F.sum("saved").alias("all_saved"), F.sum("leaf").alias("all_leaves"))
    return chains.join(climbed, "key").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", (F.col("all_leaves") - F.col("p2")).alias("n_leaves"), (F.col("all_saved") - F.col("p1")).alias("saved_tokens"), "ends_sha256"
    )
