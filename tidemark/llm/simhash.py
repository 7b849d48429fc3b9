"""SimHash near-duplicates with a Gray-order hierarchical index.

Two fingerprints within ``radius`` bits agree on one of ``radius + 1`` blocks, so each fingerprint is filed once for
every block, turned so that this block comes first, and the filings are sorted by Gray rank. A task takes a range of Gray
ranks, never parting fingerprints of equal blocks, and builds one hierarchy over each ``RANGE`` of them: runs of 16 form a
node that keeps the bits all agree on (mask and pattern); runs of 16 nodes form an upper node, which factors the pattern
they share out of them. Every fingerprint is searched from the top: differing bits that each level's own pattern shows add
up, and a whole group is left as soon as they exceed the radius. A block value that more than ``crowd`` share is filed anew
by blocks of the remaining bits, and so on, so that a range never grows without bound.

Links are not returned: each range joins what it finds into groups and hands on one edge for each fingerprint, which
keeps connectivity with a linear number of rows. Components then join over ranges.

Defined results: null, empty or blank texts have no word and fingerprint zero; equal fingerprints are in one group;
a null id counts only where a group has no other; repeated rows are each returned; an empty table gives an empty result;
other columns are ignored or, in :func:`keep_one`, kept whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import field, join_by_key, mark, settled, tidy, with_rows, written
from .components import components

SEED = 42
RADIUS = 2
FAN = 16
#: More fingerprints than this under one value are filed anew by their remaining bits, or in pairs of blocks.
CROWD = 8192
#: Filed fingerprints from which a task closes an index and begins the next, at the next new block value.
RANGE = 1 << 14
#: The wide form for similarity of shingle sets: fingerprint bits.
WIDE = 256
#: Texts whose shingles are counted, and the count from which a shingle is common. Common shingles come last in the
#: order by which texts meet; the order only sizes the groups, any order finds all links.
COUNTED, COMMON = 1 << 13, 4
#: Texts of a candidate group that are compared exactly at once.
EXACT_ROWS = 1 << 10
#: Of the counted texts, how many make a shingle of theirs a hot one, whose rows never gather; rows of a key that a task holds.
HOT_TEXTS, MOST_HELD = COUNTED >> 6, 1 << 20


def _hashes(words: list, n: int) -> np.ndarray:
    """XXH64 of every ``n``-word shingle, repeats included; fewer words are one shingle, none has none."""
    if not words:
        return np.zeros(0, np.uint64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    if len(words) < n:
        return np.array([digest(join(words), SEED)], np.uint64)
    return np.fromiter((digest(join(x), SEED) for x in zip(*(words[i:] for i in range(n)))), np.uint64, len(words) - n + 1)


def _majority(hashes: np.ndarray, chunk: int = 1 << 14) -> np.ndarray:
    """Bits set in over half of the hashes (rows of uint64), as uint64s."""
    if not len(hashes):
        return np.zeros(hashes.shape[1], np.uint64)
    ones = np.zeros(hashes.shape[1] * 64, np.int64)
    for at in range(0, len(hashes), chunk):
        part = np.ascontiguousarray(hashes[at : at + chunk])
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), -1), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)


def fingerprint(text: str | None, n: int = 3) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return int(_majority(_hashes(words, n)[:, None])[0])


def _spread(hashes: np.ndarray, k: int) -> np.ndarray:
    """``k`` further 64-bit hashes of each hash."""
    x = hashes[:, None] + np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each fingerprint (its first 64 bits) in Gray order."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).sum(-1, dtype=np.int32)


class GrayIndex:
    """A hierarchy over fingerprints (rows of uint64) in Gray order."""

    def __init__(self, prints: np.ndarray):
        self.order = np.argsort(_gray_rank(prints[:, 0]), kind="stable")
        self.prints = prints[self.order]
        self.visited = self.pruned = 0  # nodes of all searches so far
        n = len(prints)
        mask, pattern = np.full_like(self.prints, np.uint64(0xFFFFFFFFFFFFFFFF)), self.prints
        levels = []
        while n > FAN:
            cut = np.arange(0, n, FAN)
            first = np.repeat(pattern[cut], np.diff(np.append(cut, n)), axis=0)
            differ = np.bitwise_or.reduceat((pattern ^ first) | ~mask, cut, axis=0)
            mask, pattern = ~differ, pattern[cut] & ~differ
            levels.append([mask, pattern])
            n = len(cut)
        for low, high in zip(levels, levels[1:]):  # a node's own bits: not those that its upper node already shows
            up = np.arange(len(low[0])) // FAN
            low.append(low[0] & ~high[0][up])
        if levels:
            levels[-1].append(levels[-1][0])
        self.levels = levels[::-1]

    def near(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, row in Gray order) of all pairs within ``radius``."""
        n = len(self.levels[0][0]) if self.levels else len(self.prints)
        q, at = np.repeat(np.arange(len(queries)), n), np.tile(np.arange(n), len(queries))
        spent = np.zeros(len(q), np.int32)
        for k, (_, pattern, own) in enumerate(self.levels):
            self.visited += len(q)
            spent = spent + _bits((queries[q] ^ pattern[at]) & own[at])
            live = spent <= radius
            q, at, spent = q[live], at[live], spent[live]
            self.pruned += len(live) - len(q)
            below = len(self.levels[k + 1][0]) if k + 1 < len(self.levels) else len(self.prints)
            many = np.minimum(FAN, below - at * FAN)
            step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            q, at, spent = np.repeat(q, many), np.repeat(at * FAN, many) + step, np.repeat(spent, many)
        close = _bits(queries[q] ^ self.prints[at]) <= radius
        return q[close], at[close]


def _root(up: np.ndarray, i: int) -> int:
    while up[i] != i:
        up[i] = up[up[i]]
        i = up[i]
    return i


def groups(prints: np.ndarray, radius: int, block: int = 128) -> np.ndarray:
    """For each fingerprint, the first row of its group under links within ``radius``.

    The row nearest to all rows' majority takes its neighbours first, so that a crowd of copies is one group at once;
    every other row is then searched in the index.
    """
    index = GrayIndex(prints)
    up = np.arange(len(prints))
    if len(prints):
        hub = int(np.argmin(_bits(index.prints ^ _majority(index.prints))))
        star = np.flatnonzero(_bits(index.prints ^ index.prints[hub]) <= radius)
        up[star] = star[0]
        todo = np.setdiff1d(np.arange(len(prints)), star, assume_unique=True)
    for at in range(0, len(prints) and len(todo), block):
        asked = todo[at : at + block]
        q, row = index.near(index.prints[asked], radius)
        q = asked[q]
        other = row != q
        q, row = np.maximum(q[other], row[other]), np.minimum(q[other], row[other])
        for i in range(40):  # all of the block's links, first those to rows not yet joined
            a, b = up[q], up[row]
            apart = a != b
            if not apart.any():
                break
            if i:
                for x, y in set(zip(a[apart].tolist(), b[apart].tolist())):
                    x, y = _root(up, x), _root(up, y)
                    up[max(x, y)] = min(x, y)
            for _ in range(40):
                nxt = up[up]
                if (nxt == up).all():
                    break
                up = nxt
    place = np.empty(len(prints), np.int64)
    place[index.order] = index.order[up]
    first = np.full(len(prints), len(prints))
    np.minimum.at(first, place, np.arange(len(prints)))
    return first[place]


def _edges_in_order(key: np.ndarray, ids: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges within runs of equal keys. Runs of a single node are compared together, one distance at a time."""
    if not len(ids):
        return ids, ids
    start = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(1)))
    length = np.diff(np.append(start, len(ids)))
    us, vs = [], []
    node = length <= FAN
    small, run = np.repeat(node, length), np.repeat(np.arange(len(start)), length)
    for d in range(1, int(length[node].max(initial=1))):
        a = np.flatnonzero(small[:-d] & (run[:-d] == run[d:]))
        if not len(a):
            break
        a = a[_bits(prints[a] ^ prints[a + d]) <= radius]
        us.append(ids[a])
        vs.append(ids[a + d])
    for s, n in zip(start[~node].tolist(), length[~node].tolist()):
        root = groups(prints[s : s + n], radius)
        far = np.flatnonzero(root != np.arange(n))
        us.append(ids[s + far])
        vs.append(ids[s + root[far]])
    return (np.concatenate(us), np.concatenate(vs)) if us else (ids[:0], ids[:0])


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    """64-bit rows turned left; distances stay."""
    return x << np.uint64(by) | x >> np.uint64((64 - by) % 64) if by else x


def _gray_links(filed: DataFrame, radius: int, turns: dict[int, int], size: int = RANGE) -> DataFrame:
    """Edges (u, v) among rows (k1, k2, id): fingerprints filed under block k1 by the Gray rank k2 of its bits."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        block = value = None

        def find() -> pa.RecordBatch:
            ids = np.concatenate(held)
            held.clear()
            root = groups(_turned(ids.view(np.uint64), turns[block])[:, None], radius)
            far = np.flatnonzero(root != np.arange(len(ids)))
            return pa.RecordBatch.from_arrays([pa.array(ids[far], pa.int64()), pa.array(ids[root[far]], pa.int64())], names=["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            k1, k2, ids = (batch.column(k).to_numpy() for k in range(3))
            fresh = np.append((k1[0], k2[0]) != (block, value), (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]))
            turn = np.append(k1[0] != block, k1[1:] != k1[:-1])
            cuts, turn = np.flatnonzero(fresh), np.flatnonzero(turn)
            at = 0
            while at < len(ids):
                full = cuts[np.searchsorted(cuts, at + max(0, size - sum(map(len, held)))) :][:1]
                new = turn[np.searchsorted(turn, at if held else at + 1) :][:1]
                end = min([*full.tolist(), *new.tolist(), len(ids)])
                if end > at:
                    held.append(ids[at:end])
                    block = k1[at]
                if held and end < len(ids):
                    yield find()
                at = end
            value = k2[-1]
        if held:
            yield find()

    return filed.repartitionByRange("k1", "k2").sortWithinPartitions("k1", "k2").mapInArrow(tidy(run), "u long, v long")


def _link(filed: DataFrame, radius: int) -> DataFrame:
    """Edges (u, v) among rows (k1, k2, id, print: binary) of equal keys."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []

        def find(parts: list) -> pa.RecordBatch:
            key, ids, prints = (np.concatenate([p[k] for p in parts]) for k in range(3))
            u, v = _edges_in_order(key, ids, prints, radius)
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(k).to_numpy() for k in (0, 1)], 1)
            ids = batch.column(2).to_numpy()
            prints = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint64).reshape(len(ids), -1)
            cut = np.flatnonzero((key[1:] != key[:-1]).any(1))
            same = held and (held[-1][0][-1] == key[0]).all()
            if held and not same:
                yield find(held)
                held = []
            if not len(cut):
                held.append((key, ids, prints))
                continue
            last = cut[-1] + 1
            yield find([*held, (key[:last], ids[:last], prints[:last])])
            held = [(key[last:], ids[last:], prints[last:])]
        if held:
            yield find(held)

    return filed.repartition("k1", "k2").sortWithinPartitions("k1", "k2").mapInArrow(tidy(run), "u long, v long")


def _masks(mask: int, blocks: int) -> list[int]:
    """The bits outside ``mask`` in equal blocks, each with ``mask``."""
    free = [b for b in range(64) if not mask >> b & 1]
    return [mask | sum(1 << b for b in part.tolist()) for part in np.array_split(free, blocks)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _rank(x: Column) -> Column:
    """The Gray rank of a 64-bit column."""
    for k in (1, 2, 4, 8, 16, 32):
        x = x.bitwiseXOR(F.shiftrightunsigned(x, k))
    return x


def links(prints: DataFrame, radius: int = RADIUS, crowd: int = CROWD, size: int = RANGE) -> DataFrame:
    """Edges (u, v) that connect all distinct 64-bit fingerprints (column ``fp``) within ``radius`` bits."""
    paths, turns = {0: 0}, {}
    parents, out = [0], None
    rows = prints.select(F.lit(0).cast("long").alias("k1"), F.col("fp").alias("id"))
    while parents:
        children = {}
        for p in parents:
            children[p] = []
            for m in _masks(paths[p], radius + 1):
                paths[len(paths)] = m
                turns[len(paths) - 1] = 64 - (m & ~paths[p]).bit_length()
                children[p].append(len(paths) - 1)
        make = None
        for p, kids in children.items():
            kid = F.array(*(F.struct(F.lit(k).cast("long").alias("k1"), _rank(F.col("id").bitwiseAND(F.lit(_signed(paths[k])))).alias("k2")) for k in kids))
            make = F.when(F.col("k1") == p, kid) if make is None else make.when(F.col("k1") == p, kid)
        filed = rows.withColumn("key", F.explode(make)).select("key.k1", "key.k2", "id")
        many = filed.groupBy("k1", "k2").agg(F.count("*").alias("n")).where(F.col("n") > crowd).select("k1", "k2")
        deep = all(bin(paths[k]).count("1") >= 64 - 2 * (radius + 1) for kids in children.values() for k in kids)
        crowded = None if deep else written(many)
        if crowded is None or crowded.isEmpty():
            found, parents = _gray_links(filed, radius, turns, size), []
        else:
            found = _gray_links(filed.join(crowded, ["k1", "k2"], "left_anti"), radius, turns, size)
            rows = written(filed.join(crowded, ["k1", "k2"], "left_semi").select("k1", "id").distinct())
            parents = [k for kids in children.values() for k in kids]
        out = found if out is None else out.unionByName(found)
    return out


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, radius: int = RADIUS, crowd: int = CROWD, size: int = RANGE) -> DataFrame:
    """Fingerprint and component of each document: the smallest id reachable over links."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t, words) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp, pa.int64())], names=["key", "fp"])

    slim = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    marked = written(slim.mapInArrow(tidy(run), "key long, fp long"))
    least = written(marked.groupBy("fp").agg(F.min("key").alias("least"), F.count("*").alias("n")))
    roots = components(links(least.select("fp"), radius, crowd, size))
    rooted = least.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("prints"))
    named = join_by_key(rooted.select("fp", "n", "root"), ids, "root", "prints").select("fp", "n", "component_id")
    return join_by_key(marked, named, "fp", "n").select(F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def wide_fingerprint(shingles: np.ndarray, bits: int = WIDE) -> bytes:
    """A fingerprint of a set of shingles."""
    return _majority(_spread(shingles, bits // 64)).tobytes()


def prefix(shingles: np.ndarray, common: np.ndarray, counts: np.ndarray, similarity: float) -> np.ndarray:
    """The rarest shingles of a sorted set, so many that two sets of at least this similarity share one of theirs.

    They share at least ``similarity`` of either set, so that not all of it can lie behind both prefixes. ``common`` is
    sorted; shingles not in it come first, equal counts by hash.
    """
    seen = np.zeros(len(shingles), np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
        seen = np.where(common[at] == shingles, counts[at], 0)
    most = len(shingles) - int(np.ceil(similarity * len(shingles) - 1e-9)) + 1 if len(shingles) else 0
    return shingles[np.argsort(seen, kind="stable")[:most]]


def radius_of(similarity: float, bits: int = WIDE, slack: float = 2.0) -> int:
    """Bits that differ between sets of this Jaccard similarity, and ``slack`` standard deviations more.

    The share is that of large sets and a quarter more: between four and five shingles ties make 3/16 of the bits differ.
    """
    share = 1.25 * float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)
    return int(bits * share + slack * np.sqrt(bits * share * (1 - share)))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    return np.unique(_hashes((text or "").encode("utf-8", "surrogatepass").lower().split(), words))


class Sets:
    """Many sorted sets of 64-bit hashes, one behind the other."""

    def __init__(self, parts: list):
        self.size = np.array([len(p) for p in parts], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.pool = np.concatenate(parts) if parts else np.zeros(0, np.uint64)

    def alike(self, mine: np.ndarray, others: np.ndarray, similarity: float) -> np.ndarray:
        """Those of the sets ``others`` whose Jaccard similarity with ``mine`` is at least ``similarity``, exactly."""
        n = self.size[others]
        others = others[np.minimum(n, len(mine)) >= similarity * np.maximum(n, len(mine)) - 1e-9]
        if not len(others) or not len(mine):
            return others[:0]
        n = self.size[others]
        ends = np.cumsum(n)
        values = self.pool[np.repeat(self.first[others] - (ends - n), n) + np.arange(ends[-1])]
        at = np.minimum(np.searchsorted(mine, values), len(mine) - 1)
        shared = np.add.reduceat((mine[at] == values).astype(np.int64), ends - n)
        return others[shared >= similarity * (n + len(mine) - shared) - 1e-9]


def _hub_links(filed: DataFrame, similarity: float) -> DataFrame:
    """(row, root, part, linked): whether a row's set is similar enough to its hub's.

    ``filed`` holds (root, part, row, set), each part of a candidate group with a copy of the hub, the row ``root``.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, hub = None, None
        for batch in batches:
            rows: list = []
            for root, part, row, raw in zip(*(c.to_pylist() for c in batch.columns)):
                mine = np.frombuffer(raw, np.uint64)
                if row == root:
                    at, hub = (root, part), mine
                else:
                    assert (root, part) == at
                    rows.append((row, root, part, bool(len(Sets([mine]).alike(hub, np.zeros(1, np.int64), similarity)))))
            cols = list(zip(*rows)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["row", "root", "part", "linked"])

    first = filed.repartition("root", "part").sortWithinPartitions("root", "part", F.col("row") != F.col("root"))
    return first.mapInArrow(tidy(run), "row long, root long, part int, linked boolean")


def _rest_links(filed: DataFrame, similarity: float, radius: int) -> DataFrame:
    """Edges (u, v) between the rows of a block of a group's rest and all its rows.

    ``filed`` holds (root, i, part, rest, row, print, set); the block is rest rows under equal (root, i, part). Edges that
    say nothing new within a block are left out.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, sets, prints, up = None, [], None, None, None
        for batch in batches:
            us, vs = [], []
            for root, i, part, rest, row, print_, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if (root, i, part) != at:
                    at, held, sets = (root, i, part), [], None
                if rest:
                    held.append((row, print_, raw))
                    continue
                if not held:
                    continue
                if sets is None:
                    sets = Sets([np.frombuffer(x[2], np.uint64) for x in held])
                    prints = np.frombuffer(b"".join(x[1] for x in held), np.uint64).reshape(len(held), -1)
                    up = np.arange(len(held))
                near = np.flatnonzero(_bits(prints ^ np.frombuffer(print_, np.uint64)) <= radius)
                hits = sets.alike(np.frombuffer(raw, np.uint64), near, similarity)
                groups_ = np.unique(up[hits])
                if len(groups_):
                    us += [row] * len(groups_)
                    vs += [held[g][0] for g in groups_.tolist()]
                    up[np.isin(up, groups_)] = groups_[0]
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    first = filed.repartition("root", "i", "part").sortWithinPartitions("root", "i", "part", F.desc("rest"), "row")
    return first.mapInArrow(tidy(run), "u long, v long")


def exact_links(roots: DataFrame, slim: DataFrame, words: int, similarity: float, radius: int, block: int) -> DataFrame:
    """Edges (u, v) that connect the rows of each candidate group (``roots``: node, root) by similar enough shingle sets.

    Every row is compared with its group's first row, the hub, in parts of about ``block`` rows. Only rows that this
    leaves (the rest) are then compared with all others of their group, blocks of the rest with each part.
    """
    blocks = lambda n: F.ceil(F.col(n) / block).cast("int")
    large = written(roots.groupBy("root").agg(F.count("*").alias("n")).where(F.col("n") > block).select("root", blocks("n").alias("parts")))  # at most one for every ``block`` rows; broadcast where Spark finds it small

    def with_sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingle_set(t, words) for t in part.column(3).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array([wide_fingerprint(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["root", "row", "parts", "print", "set"])

    dealt = roots.join(large, "root", "left").select("root", F.col("node").alias("row"), F.coalesce("parts", F.lit(1)).alias("parts"))
    texts = dealt.join(slim.select("row", "text"), "row").select("root", "row", "parts", "text")
    held = written(texts.mapInArrow(tidy(with_sets), "root long, row long, parts int, print binary, set binary").withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")))
    others, hubs = held.where("row <> root"), held.where("row = root")
    copies = hubs.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    names = ["root", "part", "row", "set"]
    met = written(_hub_links(others.select(*names).unionByName(copies.select(*names)), similarity))
    edges = met.where("linked").select(F.col("row").alias("u"), F.col("root").alias("v"))
    rest = met.where("not linked").select("row", "root", "part")
    sized = rest.groupBy("root").agg(F.count("*").alias("n")).join(large, "root", "left").select("root", blocks("n").alias("blocks"), F.coalesce("parts", F.lit(1)).alias("parts"))
    sized = sized.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("root", "part", "blocks")
    every = written(others.join(sized, ["root", "part"]))
    if every.isEmpty():
        return edges
    names = ["root", "i", "part", "rest", "row", "print", "set"]
    i = F.sequence(F.lit(0), F.col("blocks") - 1)
    searched = every.withColumn("i", F.explode(i)).withColumn("rest", F.lit(False)).select(*names)
    asked = every.join(rest.select("row"), "row", "left_semi").withColumn("i", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("rest", F.lit(True)).select(*names)
    return edges.unionByName(_rest_links(asked.unionByName(searched), similarity, radius))


def _in_pairs(filed: DataFrame, crowd: int) -> DataFrame:
    """Rows (k1, k2, id and others) with each key that over ``crowd`` share dealt into blocks, filed under all pairs of them.

    Any two rows of a key still meet, in runs of about ``crowd`` rows. k1 must be under 65,536.
    """
    crowds = written(filed.groupBy("k1", "k2").agg(F.count("*").alias("n")).where(F.col("n") > crowd).select("k1", "k2", F.ceil(2 * F.col("n") / crowd).cast("long").alias("blocks")))
    if crowds.isEmpty():
        return filed
    many = filed.join(crowds, ["k1", "k2"]).withColumn("b", F.pmod(F.xxhash64("id"), F.col("blocks")))
    many = many.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    pair = F.least("b", "k") * F.col("blocks") + F.greatest("b", "k") + 1
    return filed.join(crowds, ["k1", "k2"], "left_anti").unionByName(many.select((pair * (1 << 16) + F.col("k1")).alias("k1"), *filed.columns[1:]))


def _shared(postings: DataFrame, most: int = MOST_HELD) -> DataFrame:
    """(k1, k2, id): the rows (k2, id) whose k2 is not theirs alone, with keys of the same ids made one.

    A task holds ``most`` rows of a key; a key of more keeps its own name, and its rows pass through as they come.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        passing = None

        def named(key: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(key), pa.array(ids)], names=["k2", "id"])

        def find(parts: list) -> pa.RecordBatch:
            key, ids = (np.concatenate([p[k] for p in parts]) for k in range(2))
            start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            n = np.diff(np.append(start, len(key)))
            name = np.repeat(np.add.reduceat(_spread(ids.view(np.uint64), 1)[:, 0], start), n).view(np.int64)
            many = np.repeat(n > 1, n)
            return named(name[many], ids[many])

        for batch in batches:
            key, ids = (batch.column(k).to_numpy() for k in (0, 1))
            if passing is not None:
                n = int(np.searchsorted(key, passing, "right"))
                yield named(key[:n], ids[:n])
                key, ids = key[n:], ids[n:]
            if not len(key):
                continue
            passing = None
            cut = np.flatnonzero(key[1:] != key[:-1])
            if held and held[-1][0][-1] != key[0]:
                yield find(held)
                held = []
            if len(cut):
                last = cut[-1] + 1
                yield find([*held, (key[:last], ids[:last])])
                held, key, ids = [], key[last:], ids[last:]
            held.append((key, ids))  # of one key
            if sum(len(k) for k, _ in held) > most:
                for part in held:
                    yield named(*part)
                held, passing = [], key[-1]
        if held:
            yield find(held)

    return postings.select("k2", "id").repartition("k2").sortWithinPartitions("k2", "id").mapInArrow(tidy(run), "k2 long, id long").distinct().select(F.lit(0).cast("long").alias("k1"), "k2", "id")


def _common(slim: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingles found in at least COMMON of about COUNTED texts, and their counts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(t, words).view(np.int64))], names=["shingle"])

    every = max(1, slim.count() // COUNTED)
    some = slim.where(F.pmod(F.xxhash64("row"), F.lit(every)) == 0).select("text").mapInArrow(tidy(run), "shingle long")
    got = some.groupBy("shingle").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON).toArrow()
    shingles, n = got["shingle"].to_numpy().view(np.uint64), got["n"].to_numpy()
    order = np.argsort(shingles)
    return shingles[order], n[order]


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = 5, similarity: float = 0.8, crowd: int = CROWD, block: int = EXACT_ROWS) -> DataFrame:
    """One document of each group of texts whose word shingles are at least so similar; all columns kept.

    Texts of equal shingle sets go first. Any two similar enough share one of their rarest shingles (see :func:`prefix`)
    and meet under it; those whose wide fingerprints are within a radius six standard deviations above the worst case form
    candidate groups, and within each, shingle sets are compared exactly. A group of more than ``block`` texts is compared
    in parts, a shingle of more than ``crowd`` in pairs of blocks. The document with the smallest id stays.
    """
    rows = written(with_rows(docs))
    slim = rows.select("row", field(text).alias("text"), field(key).cast("long").alias("id"))
    since = mark()
    shingles, n = _common(slim, words)
    common = docs.sparkSession.sparkContext.broadcast((shingles, n, shingles[n >= HOT_TEXTS]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                sets = [shingle_set(t, words) for t in batch.column(1).to_pylist()]
                same = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                first = [prefix(s, *common.value[:2], similarity) for s in sets]
                hot = [np.isin(x, common.value[2]) for x in first]
                lists = [pa.array([x[h == want].view(np.int64) for x, h in zip(first, hot)], pa.list_(pa.int64())) for want in (False, True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(same, pa.binary()), pa.array([wide_fingerprint(s) for s in sets], pa.binary()), *lists, batch.column(2)], names=["row", "same", "print", "rare", "hot", "id"])

    marked = slim.mapInArrow(tidy(run), "row long, same binary, print binary, rare array<long>, hot array<long>, id long")
    # one row for each set: its smallest id, then row
    firsts = marked.groupBy("same").agg(F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("best"), F.first("print").alias("print"), F.first("rare").alias("rare"), F.first("hot").alias("hot"))
    firsts = written(firsts.select("best.id", "best.row", "print", "rare", "hot"))
    filed_under = lambda c: firsts.select(F.explode(c).alias("k2"), F.col("row").alias("id"))
    met = _in_pairs(written(_shared(filed_under("rare")).unionByName(filed_under("hot").select(F.lit(0).cast("long").alias("k1"), "k2", "id"))), crowd)
    filed = met.join(firsts.select(F.col("row").alias("id"), "print"), "id").select("k1", "k2", "id", "print")
    radius = radius_of(similarity, slack=6.0)
    roots = written(components(_link(filed, radius)))
    groups_ = components(exact_links(roots, slim, words, similarity, radius, block))
    rooted = firsts.select("row", "id").join(groups_.withColumnRenamed("node", "row"), "row", "left").withColumn("root", F.coalesce("root", "row"))
    stay = rooted.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("best")).select(F.col("best.row").alias("row"))
    return rows.join(settled(stay, since), "row", "left_semi").select("doc.*")
