"""Approximate nearest neighbours by largest cosine: robust-pruned directed graphs, one for each shard.

Equal vectors form a class that keeps its ``k + 1`` smallest ids (no query can need more of them). Classes are dealt to
shards by hash; a shard's size grows with the root of the number of classes, up to ``MOST_BYTES``, and the beam of a search
with the shard's. A task builds its
shard's graph in numpy: points are inserted in batches, greedy beam search over the graph so far proposes neighbours,
and pruning keeps an edge only if no kept neighbour is nearer to its end by the factor ``alpha`` (free slots then take
the nearest that were pruned). Every query is searched in every shard, streamed through in batches behind the shard's
own rows; the best of all shards are the answer. Distances that steer a search are single precision; those in a beam are
measured again in double precision on the original vectors.

Defined results: a vector that is null, empty, zero or holds null or non-finite components takes no part, nor does a row
without id; vectors of another length are no candidates; with repeated rows, a query leaves out one row of its own id
and vector, and each repeated query row is answered; ties go to the smaller id; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

K, EVERY = 5, 50
DEGREE, BEAM, WIDTH, ALPHA = 24, 64, 4, 1.2
#: Beam of a query's search in a shard of up to ``BEAM_ROWS`` rows; it grows with the root of what is above.
QUERY_BEAM, BEAM_ROWS = 96, 4096
BATCH = 256
#: Bytes of a shard's vectors in double precision at most: its memory bound (131,072 rows of 64 dimensions).
MOST_BYTES = 1 << 26


def shards_for(n: int, width: int) -> int:
    """Shards for ``n`` rows of up to ``width`` dimensions."""
    rows = max(1, min(MOST_BYTES // (8 * max(1, width)), max(512, 16 * math.isqrt(max(n, 1)))))
    return max(1, math.ceil(n / rows))


def beam_for(rows: int) -> int:
    return math.ceil(QUERY_BEAM * math.sqrt(max(1.0, rows / BEAM_ROWS)))


class Graph:
    """A directed graph over unit vectors (float32 rows)."""

    def __init__(self, x: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA):
        self.x, self.degree, self.alpha = x, degree, alpha
        n = len(x)
        self.out = np.full((n, degree), -1, np.int32)
        self.entry = int(np.argmax(x @ x.mean(0))) if n else 0
        order = np.random.default_rng(n).permutation(n)
        order = np.concatenate([[self.entry], order[order != self.entry]])[:n]
        done = 1
        while done < n:
            batch = order[done : done + min(BATCH, max(1, done))]
            ids, _ = self.search(x[batch], beam)
            within = np.broadcast_to(batch, (len(batch), len(batch))).copy()  # the batch's own points are candidates too
            self.out[batch] = self._pruned(batch, np.concatenate([ids, within], 1))
            self._reverse(batch)
            done += len(batch)

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` best found for each query, nearest first: (ids, cosines), -1 and -inf where there are fewer."""
        n, rows = len(self.x), np.arange(len(q))[:, None]
        ids = np.full((len(q), beam), -1, np.int32)
        cos = np.full((len(q), beam), -np.inf, np.float32)
        open_ = np.zeros((len(q), beam), bool)
        seen = np.zeros((len(q), n + 1), bool)  # the last column stands for -1
        seen[:, [self.entry, n]] = True
        ids[:, 0], cos[:, 0], open_[:, 0] = self.entry, q @ self.x[self.entry], True
        live = np.arange(len(q))
        while len(live):
            i, c, o = ids[live], cos[live], open_[live]
            rank = np.cumsum(o, 1)
            pick = o & (rank <= WIDTH)
            at = np.argsort(~pick, 1, kind="stable")[:, :WIDTH]
            near = rows[: len(live)]
            chosen = np.where(pick[near, at], i[near, at], -1)
            o &= ~pick
            new = np.where(chosen[:, :, None] >= 0, self.out[chosen], -1).reshape(len(live), -1)
            new.sort(1)
            new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
            new[seen[live[:, None], new]] = -1
            seen[live[:, None], new] = True
            score = np.einsum("bkd,bd->bk", self.x[new], q[live], optimize=False)
            score[new < 0] = -np.inf
            i, c, o = np.concatenate([i, new], 1), np.concatenate([c, score], 1), np.concatenate([o, new >= 0], 1)
            best = np.argsort(-c, 1, kind="stable")[:, :beam]
            ids[live], cos[live], open_[live] = i[near, best], c[near, best], o[near, best]
            live = live[open_[live].any(1)]
        return ids, cos

    def _pruned(self, points: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """Robust pruning of each point's candidates (-1: none) to ``degree`` neighbours."""
        out = np.full((len(points), self.degree), -1, np.int32)
        for s in range(0, len(points), 128):
            p, c = points[s : s + 128], np.sort(candidates[s : s + 128], 1)
            c[:, 1:][c[:, 1:] == c[:, :-1]] = -1
            c[c == p[:, None]] = -1
            far = 2 - 2 * np.einsum("bkd,bd->bk", self.x[c], self.x[p])
            far[c < 0] = np.inf
            near = np.argsort(far, 1, kind="stable")[:, : 4 * self.degree]
            row = np.arange(len(p))
            c, far = c[row[:, None], near], far[row[:, None], near]
            v = self.x[c]
            between = 2 - 2 * np.matmul(v, v.transpose(0, 2, 1))
            alive, taken = c >= 0, np.zeros(c.shape, bool)
            for _ in range(self.degree):
                some = alive.any(1)
                if not some.any():
                    break
                k = np.argmax(alive, 1)
                taken[row[some], k[some]] = True
                alive[row, k] = False
                alive &= self.alpha**2 * between[row, k] > far
            order = np.argsort(np.where(taken, 0, np.where(c >= 0, 1, 2)), 1, kind="stable")[:, : self.degree]
            out[s : s + 128, : order.shape[1]] = c[row[:, None], order]
        return out

    def _reverse(self, batch: np.ndarray) -> None:
        """Every new edge also backwards; points with too many are pruned."""
        target = self.out[batch].ravel()
        source = np.repeat(batch, self.degree)[target >= 0]
        target = target[target >= 0]
        order = np.argsort(target, kind="stable")
        target, source = target[order], source[order]
        points, first, many = np.unique(target, return_index=True, return_counts=True)
        for s in range(0, len(points), 512):
            p, f, m = points[s : s + 512], first[s : s + 512], many[s : s + 512]
            more = np.full((len(p), int(m.max())), -1, np.int32)
            at = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            more[np.repeat(np.arange(len(p)), m), at] = source[np.repeat(f, m) + at]
            every = np.concatenate([self.out[p], more], 1)
            every.sort(1)
            every[:, 1:][every[:, 1:] == every[:, :-1]] = -1
            fits = (every >= 0).sum(1) <= self.degree
            self.out[p[fits]] = -np.sort(-every[fits], 1)[:, : self.degree]
            self.out[p[~fits]] = self._pruned(p[~fits], every[~fits])


def scaled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows times a power of two, so that squares neither overflow nor vanish, and the powers."""
    power = np.frexp(np.abs(x).max(1))[1]
    return np.ldexp(x, -power[:, None]), power


class Shard:
    """The vectors of one length in a shard, with the ids of each class of equal vectors."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        x = x + 0.0  # one zero only
        self.x, place = np.unique(x, axis=0, return_inverse=True)
        order = np.lexsort((ids, place.ravel()))
        self.ids, self.first = ids[order], np.searchsorted(place.ravel()[order], np.arange(len(self.x) + 1))
        self.x, self.power = scaled(self.x)
        self.norm = np.sqrt((self.x**2).sum(1))
        self.graph = Graph((self.x / self.norm[:, None]).astype(np.float32))

    def answers(self, query_ids: np.ndarray, q: np.ndarray, k: int, beam: int) -> Iterator[tuple[int, list]]:
        """For each query row, the best (score, id) of this shard."""
        q, power = scaled(q)
        norm = np.sqrt((q**2).sum(1))
        found, _ = self.graph.search((q / norm[:, None]).astype(np.float32), beam)
        exact = np.einsum("bkd,bd->bk", self.x[found], q) / (self.norm[found] * norm[:, None])
        exact[found < 0] = -np.inf
        own = (self.x[found] == q[:, None]).all(2) & (self.power[found] == power[:, None])
        for r in range(len(q)):
            best: list = []
            top = np.sort(exact[r])[::-1][: k + 1]
            for c in np.flatnonzero((exact[r] >= top[-1]) & (found[r] >= 0)).tolist():
                ids = self.ids[self.first[found[r, c]] : self.first[found[r, c] + 1]].tolist()
                if own[r, c] and query_ids[r] in ids:
                    ids.remove(query_ids[r])
                best += [(-float(exact[r, c]), i) for i in ids]
            yield r, [(-s, i) for s, i in sorted(best)[:k]]


def usable(v: Column) -> Column:
    """Whether a vector is neither null, empty nor zero, and all its components are finite."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = EVERY, k: int = K, beam: int | None = None) -> DataFrame:
    """The ``k`` nearest rows found for every row whose id is divisible by ``every``; without a beam it goes by the shard."""
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("v")))
    few = Window.partitionBy("v").orderBy("id")
    kept = rows.withColumn("nth", F.row_number().over(few)).where(F.col("nth") <= k + 1).drop("nth")
    kept = written(kept.withColumn("hash", F.xxhash64(F.transform("v", lambda x: x + F.lit(0.0)))))
    size = kept.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("v")), F.lit(1)).alias("width")).first()
    shards = shards_for(size.n, size.width)
    index = kept.select(F.pmod("hash", F.lit(shards)).cast("int").alias("shard"), F.lit(-1).cast("long").alias("query"), "id", "v")
    queries = written(rows.where(F.col("id") % every == 0).withColumn("query", F.monotonically_increasing_id()))
    asked = queries.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "query", "id", "v")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, built = None, [], {}

        def build() -> None:
            built.clear()
            ids = np.concatenate([h[0] for h in held])
            lists = [x for h in held for x in h[1]]
            size = np.array([len(x) for x in lists])
            for d in np.unique(size).tolist():
                pick = np.flatnonzero(size == d)
                built[d] = Shard(ids[pick], np.array([lists[i] for i in pick]))
            held.clear()

        def ask(query: np.ndarray, ids: np.ndarray, lists: list) -> pa.RecordBatch:
            out = []
            for d in sorted({len(x) for x in lists} & set(built)):
                pick = [i for i, x in enumerate(lists) if len(x) == d]
                for s in range(0, len(pick), BATCH):
                    part = pick[s : s + BATCH]
                    for r, best in built[d].answers(ids[part], np.array([lists[i] for i in part]), k, beam or beam_for(len(built[d].x))):
                        out += [(query[part[r]], ids[part[r]], i, score) for score, i in best]
            cols = list(zip(*out)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["query", "query_id", "vec_id", "score"])

        for batch in batches:
            shard, query, ids = (batch.column(c).to_numpy() for c in range(3))
            values = batch.column(3)
            cut = np.flatnonzero(np.append(True, (shard[1:] != shard[:-1]) | ((query[1:] < 0) != (query[:-1] < 0)))).tolist() if len(ids) else []
            for a, b in zip(cut, [*cut[1:], len(ids)]):
                if shard[a] != at:
                    at = shard[a]
                    held.clear()
                    built.clear()
                lists = [np.asarray(x, float) for x in values.slice(a, b - a).to_pylist()]
                if query[a] < 0:
                    held.append((ids[a:b], lists))
                else:
                    if held:
                        build()
                    if built:
                        yield ask(query[a:b], ids[a:b], lists)

    placed = index.unionByName(asked).repartition(shards, "shard").sortWithinPartitions("shard", "query", "id")
    found = placed.mapInArrow(run, "query long, query_id long, vec_id long, score double")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
