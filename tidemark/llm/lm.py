"""Log-bilinear language model, trained in numpy by noise-contrastive estimation over all training documents.

From the whole training fold come the counts of all tokens, the vocabulary and the model. Every word that occurs at least
``LEAST`` times has vectors of its own (``MOST_VOCAB`` of them at most, the bound of a worker's memory); all other words
share ``BUCKETS`` entries by their last two bytes, which tell languages and inflections apart, times a word's smoothed
share of its bucket. The model predicts an entry from the two before it: the context is the sum of one vector for each
place, and a strength is a vector's product with the context, plus a bias that starts at the log of the share.

Texts become entries once; all later passes read those. In the first round entries are told from noise drawn from all of
them. Their vectors then fall into about as many classes as a class has members, and further rounds tell a token's class
from other classes and, within it, the entry from other members. Every task steps through its own part of the documents;
tasks' models are averaged row by row, weighed by how often each has used a row.

A token's probability is that of its class times its own within the class. Both are normalised exactly, by one product of
matrices over all classes and one over the members of each class.

Counts of the ``HEAD`` commonest keys are known to each task (a bounded table); rarer tokens are summed up for each
document and meet their counts in a join, where no key can be frequent.

Defined results: a null text is empty and scored as its end alone; without training documents all counts are zero and
the model is uniform; repeated rows are each scored, and learnt from each; null ids stand in the fold of the empty
string; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_fold, py_in_fold, written

#: Training occurrences from which a word has vectors of its own, and the most such words.
LEAST, MOST_VOCAB = 8, 1 << 15
#: Entries of all other words, dimensions, keys whose counts each task knows, bytes of a key.
BUCKETS, DIM, HEAD, LONG = 64, 16, 1 << 17, 40
#: Rounds: the first over a part of the training documents, the others over a part each, together all; tokens and noise of a step.
ROUNDS, BATCH, NOISE, RATE = 4, 8192, 32, 0.1
FOLDS = (7, 2)
#: The end of a text, as a key (no word is empty).
END = b""
CHUNKS = 64
#: Distinct words that a task counts before it hands them on.
MOST_HELD = 1 << 20


def words_of(text: str | None) -> list:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def key_of(word: bytes) -> bytes:
    """A word, or for a long one its SHA-256 behind a zero byte (longer than any word that stands for itself)."""
    return word if len(word) <= LONG else b"\0" + hashlib.sha256(word).hexdigest().encode()


def bucket_of(key: bytes) -> int:
    return zlib.crc32(key[-2:]) % BUCKETS


def count(docs: DataFrame, key: str, text: str, folds: tuple[int, int]) -> DataFrame:
    """(word, bucket, c, every): occurrences in training documents, and in all."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, held = Counter(), Counter()

        def out() -> pa.RecordBatch:
            keys = [w if len(w) <= LONG else key_of(w) for w in every]
            n, less = (pa.array(x, pa.int64()) for x in (every.values(), map(held.get, every, repeat(0))))
            every.clear()
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), n, less], names=["word", "n", "held"])

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(t)
                words.append(END)
                every.update(words)
                if py_in_fold(i, *folds):
                    held.update(words)
                if len(every) + len(held) > MOST_HELD:
                    yield out()
        yield out()

    got = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, "word binary, n long, held long")
    bucket = (F.crc32(F.substring("word", -2, 2)) % BUCKETS).cast("int")  # as bucket_of
    return got.groupBy("word").agg(F.sum(F.col("n") - F.col("held")).alias("c"), F.sum("n").alias("every")).select("word", bucket.alias("bucket"), "c", "every")


def commonest(counts: DataFrame, by: str, most: int) -> dict[bytes, int]:
    """Training counts of the commonest keys by a count, ``most`` at most: all whose frequency class, a sixteenth of a
    doubling, still fits in whole. Classes are few, so no task has to order all words."""
    classes = counts.where(F.col(by) > 0).withColumn("class", F.floor(F.log2(by) * 16))
    room, least = most, None
    for r in classes.groupBy("class").agg(F.count("*").alias("n")).orderBy(F.desc("class")).collect():  # under 1,024 rows
        room -= r.n
        if room < 0:
            break
        least = r["class"]
    if least is None:
        return {}
    return {bytes(r.word): r.c for r in classes.where(F.col("class") >= least).select("word", "c").collect()}  # at most ``most`` bounded keys


@dataclass
class Model:
    """Vectors of the entries with their biases behind, of the entries as last and as last but one; the first for classes too."""

    out: np.ndarray
    last: np.ndarray
    other: np.ndarray
    share: np.ndarray
    class_of: np.ndarray | None = None
    class_out: np.ndarray | None = None

    @classmethod
    def start(cls, share: np.ndarray, dim: int = DIM, seed: int = 11) -> Model:
        rng = np.random.default_rng(seed)
        make = lambda: rng.normal(0, 0.1, (len(share), dim)).astype(np.float32)
        return cls(np.column_stack([make(), np.log(share).astype(np.float32)]), make(), make(), share)

    def tables(self) -> list[np.ndarray]:
        """What is learnt."""
        learnt = [self.out, self.last, self.other]
        return learnt if self.class_of is None else [*learnt, self.class_out]

    def copy(self) -> Model:
        return Model(self.out.copy(), self.last.copy(), self.other.copy(), self.share, self.class_of, None if self.class_out is None else self.class_out.copy())

    def context(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The sum of both places' vectors, and a one for the bias."""
        out = np.ones((len(i), self.last.shape[1] + 1), np.float32)
        np.add(self.last.take(i, 0), self.other.take(j, 0), out=out[:, :-1])
        return out

    def members(self) -> tuple[np.ndarray, np.ndarray]:
        """Entries by class, and where each class begins."""
        order = np.argsort(self.class_of, kind="stable")
        return order, np.searchsorted(self.class_of[order], np.arange(len(self.class_out) + 1))

    def class_share(self) -> np.ndarray:
        return np.bincount(self.class_of, weights=self.share, minlength=len(self.class_out))

    def classify(self, rounds: int = 8, seed: int = 12) -> None:
        """Group entries by their vectors, into classes of the root of their number at most."""
        n = len(self.share)
        k = max(1, int(np.ceil(np.sqrt(n))))
        rng = np.random.default_rng(seed)
        x = self.out[:, :-1] / np.maximum(1e-9, np.linalg.norm(self.out[:, :-1], axis=1, keepdims=True))
        weight = np.sqrt(self.share)
        centre = x[rng.choice(n, k, replace=False, p=weight / weight.sum())].copy()
        for _ in range(rounds):
            at = np.concatenate([np.argmax(x[s : s + 4096] @ centre.T, 1) for s in range(0, n, 4096)])
            for d in range(x.shape[1]):
                centre[:, d] = np.bincount(at, weights=weight * x[:, d], minlength=k)
            centre /= np.maximum(1e-9, np.linalg.norm(centre, axis=1, keepdims=True))
        order = np.lexsort((-self.share, at))
        start = np.searchsorted(at[order], np.arange(k))
        piece = (np.arange(n) - start[at[order]]) // k  # a crowded centre makes several classes
        _, name = np.unique(at[order] * (n + 1) + piece, return_inverse=True)
        self.class_of = np.empty(n, np.int32)
        self.class_of[order] = name
        share = np.bincount(self.class_of, weights=self.share)
        mean = [np.bincount(self.class_of, weights=self.share * x) / share for x in self.out.T[:-1]]
        self.class_out = np.stack([*mean, np.log(share)], 1).astype(np.float32)
        self.out[:, -1] = np.log(self.share) - np.log(share)[self.class_of]


class Probabilities:
    """Normalised log-probabilities by a model."""

    def __init__(self, model: Model):
        self.m = model
        order, self.start = model.members()
        self.by_class = np.ascontiguousarray(model.out[order])

    def __call__(self, i: np.ndarray, j: np.ndarray, w: np.ndarray, block: int = 1 << 17) -> np.ndarray:
        """Of each entry ``w`` behind ``i`` and, before that, ``j``; natural logarithms.

        Within a block equal tokens behind equal pairs are computed once, and so is each pair's sum over classes.
        """
        m, out, n = self.m, np.empty(len(w)), len(self.m.share)
        for s in range(0, len(w), block):
            pair, pair_of = np.unique(i[s : s + block].astype(np.int64) * n + j[s : s + block], return_inverse=True)
            token, token_of = np.unique(pair_of * n + w[s : s + block], return_inverse=True)
            behind, word = token // n, token % n
            by = np.argsort(_short(m.class_of[word], len(m.class_out)), kind="stable")
            word, behind = word[by], behind[by]
            pairs, group = m.context(pair // n, pair % n), m.class_of[word]
            context = pairs.take(behind, 0)
            got = np.einsum("bd,bd->b", context, m.class_out.take(group, 0)).astype(float) + np.einsum("bd,bd->b", context, m.out.take(word, 0))
            got -= np.concatenate([_log_sum(pairs[t : t + 1024] @ m.class_out.T) for t in range(0, len(pairs), 1024)])[behind]
            cut = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(by)]):
                k = group[a]
                inside = self.by_class[self.start[k] : self.start[k + 1]]
                got[a:b] -= _log_sum(context[a:b] @ inside.T)
            each = np.empty(len(got))
            each[by] = got
            out[s : s + block] = each[token_of]
        return out


def _log_sum(x: np.ndarray) -> np.ndarray:
    """The log of each row's sum of exponentials; ``x`` is spent. Strengths stay far below 80 unless training fails."""
    top = float(x.max(initial=0.0))
    if top > 80:
        x -= top
    else:
        top = 0.0
    np.exp(x, out=x)
    return np.log(x @ np.ones(x.shape[1], x.dtype)) + top


def _short(x: np.ndarray, n: int) -> np.ndarray:
    """Numbers under ``n`` in two bytes where they fit: these are sorted fastest."""
    return x.astype(np.uint16) if n <= 1 << 16 else x


class Trainer:
    """Steps of noise-contrastive estimation on one model, each number with a step size that shrinks as it moves."""

    def __init__(self, model: Model, rate: float, seed: int):
        self.m, self.rate, self.rng = model, np.float32(rate), np.random.default_rng(seed)
        self.spent = [np.ones(x.shape, np.float32) for x in model.tables()]
        self.uses = [np.zeros(len(x), np.float32) for x in model.tables()]
        if model.class_of is None:
            noise = model.share
        else:
            noise = model.class_share()
            self.order, self.start = model.members()
            self.log_within = (np.log(model.share) - np.log(noise)[model.class_of]).astype(np.float32)
            self.cum = np.append(0.0, np.cumsum(model.share[self.order]))
            self.low, self.wide = self.cum[self.start[:-1]], np.diff(self.cum[self.start])
        self.log_noise, self.shelf = np.log(noise).astype(np.float32), np.cumsum(noise) / noise.sum()

    def _add(self, table: int, at: np.ndarray, rows: np.ndarray, row: np.ndarray | None = None, times: np.ndarray | None = None) -> None:
        """Climb by the sums of the rows that go to each place: those of numbers ``row``, taken ``times``, or each once."""
        to, spent = self.m.tables()[table], self.spent[table]
        order = np.argsort(_short(at, len(to)), kind="stable")
        at = at[order]
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        many = np.diff(np.append(first, len(at)))
        at, total = at[first], self._sums(rows, order if row is None else row[order], None if times is None else times[order], first)[:, : to.shape[1]]
        self.uses[table][at] += many
        paid = spent.take(at, 0)
        paid += total * total
        spent[at] = paid
        np.sqrt(paid, out=paid)
        np.divide(total, paid, out=paid)
        paid *= self.rate
        paid += to.take(at, 0)
        to[at] = paid

    @staticmethod
    def _sums(rows: np.ndarray, row: np.ndarray, times: np.ndarray | None, first: np.ndarray) -> np.ndarray:
        """Sums of runs of rows."""
        x = rows.take(row, 0)
        if times is not None:
            x *= times[:, None]
        return np.add.reduceat(x, first, axis=0)

    def step(self, i: np.ndarray, j: np.ndarray, w: np.ndarray) -> None:
        """Entries, or their classes, against noise that the batch shares; then entries against others of their class."""
        m, k = self.m, np.float32(np.log(NOISE))
        context = m.context(i, j)
        plain = m.class_of is None
        target, out = (w, m.out) if plain else (m.class_of[w], m.class_out)
        noise = np.minimum(np.searchsorted(self.shelf, self.rng.random(NOISE), side="right"), len(self.shelf) - 1)
        mine, others = out.take(target, 0), out.take(noise, 0)
        true = np.einsum("bd,bd->b", context, mine) - self.log_noise[target] - k
        false = context @ others.T - (self.log_noise[noise] + k)
        up, down = _logistic(-true), _logistic(false)  # how far a token is from being told from noise, and noise from a token
        into = up[:, None] * mine - down @ others
        n = len(w)
        moved = np.concatenate([target, noise]), np.concatenate([context, -(down.T @ context)]), np.arange(n + NOISE), np.append(up, np.ones(NOISE, np.float32))
        if not plain:
            into += self._within(context, w, target)
        self._add(0 if plain else 3, *moved)
        self._add(1, i, into)
        self._add(2, j, into)

    def _within(self, context: np.ndarray, w: np.ndarray, group: np.ndarray) -> np.ndarray:
        """One other member of each token's class as noise."""
        m = self.m
        place = np.searchsorted(self.cum, self.low[group] + self.rng.random(len(w)) * self.wide[group], side="right") - 1
        noise = self.order[np.clip(place, self.start[group], self.start[group + 1] - 1)]
        mine, others = m.out.take(w, 0), m.out.take(noise, 0)
        up = _logistic(self.log_within[w] - np.einsum("bd,bd->b", context, mine))
        down = _logistic(np.einsum("bd,bd->b", context, others) - self.log_within[noise])
        self._add(0, np.concatenate([w, noise]), context, np.tile(np.arange(len(w)), 2), np.concatenate([up, -down]))
        return up[:, None] * mine - down[:, None] * others

    def sums(self) -> np.ndarray:
        """All rows times their uses, and the uses: what can be added over tasks."""
        return np.concatenate([np.column_stack([x * n[:, None], n]).ravel() for x, n in zip(self.m.tables(), self.uses)]).astype(np.float32)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(np.clip(-x, -30, 30)))


def averaged(model: Model, flat: np.ndarray) -> None:
    """Set every row that some task has used to the mean over its uses."""
    at = 0
    for x in model.tables():
        part = flat[at : at + x.size + len(x)].reshape(len(x), -1)
        at += part.size
        used = part[:, -1] > 0
        x[used] = part[used, :-1] / part[used, -1:]


def contexts(ids: np.ndarray, ends: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Last and last but one before each token of texts set end to end; before a text stand ends."""
    i, j = np.roll(ids, 1), np.roll(ids, 2)
    starts = np.append(0, ends[:-1]) if len(ends) else ends
    i[starts] = end
    j[starts] = end
    second = (starts + 1)[starts + 1 < np.append(starts[1:], len(ids))]
    j[second] = end
    return i, j


def _texts(ids: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Entries of all texts end to end, and where the next text begins."""
    ends = np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    return ids.flatten().to_numpy(zero_copy_only=False), ends


def train(coded: DataFrame, share: np.ndarray, rounds: int = ROUNDS) -> Model:
    """The model of entries with these shares, over all training documents (``row``, ``ids``: never empty)."""
    model = Model.start(share)
    part = F.pmod(F.xxhash64("row"), F.lit(max(1, rounds - 1)))
    for r in range(rounds):
        if r == min(1, rounds - 1):
            model.classify()
        known, rate = coded.sparkSession.sparkContext.broadcast(model), RATE / (1 + r)
        length = sum(x.size + len(x) for x in model.tables())
        cut = np.linspace(0, length, CHUNKS + 1).astype(int)

        def run(batches: Iterable[pa.RecordBatch], known=known, rate=rate, r=r, cut=cut) -> Iterator[pa.RecordBatch]:
            trainer = Trainer(known.value.copy(), rate, r)
            held: list = []
            some = False

            def learn(last: bool = False) -> None:
                if not held:
                    return
                i, j, w = (np.concatenate(x) for x in zip(*held))
                order = trainer.rng.permutation(len(w))
                whole = len(w) if last else len(w) // BATCH * BATCH
                for s in range(0, whole, BATCH):
                    pick = order[s : s + BATCH]
                    trainer.step(i[pick], j[pick], w[pick])
                left = order[whole:]
                held[:] = [(i[left], j[left], w[left])] if len(left) else []

            for batch in batches:
                for s in range(0, batch.num_rows, 256):
                    w, ends = _texts(batch.column(0).slice(s, 256))
                    i, j = contexts(w, ends, 0)
                    held.append((i, j, w))
                    some = True
                    if sum(len(x[2]) for x in held) >= 16 * BATCH:
                        learn()
            learn(last=True)
            if some:
                flat = trainer.sums()
                yield pa.RecordBatch.from_arrays([pa.array(range(CHUNKS), pa.int32()), pa.array([flat[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary())], names=["chunk", "sums"])

        def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict = {}
            for batch in batches:
                for c, raw in zip(*(batch.column(k).to_pylist() for k in range(2))):
                    total[c] = total.get(c, 0.0) + np.frombuffer(raw, np.float32).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([s.tobytes() for s in total.values()], pa.binary())], names=["chunk", "sums"])

        schema = "chunk int, sums binary"
        got = coded.where(part == max(0, r - 1)).select("ids").mapInArrow(run, schema).repartition(CHUNKS, "chunk").mapInArrow(add, schema)
        got = sorted(got.collect())  # CHUNKS rows, together one model
        known.unpersist()
        if got:
            averaged(model, np.concatenate([np.frombuffer(x.sums) for x in got]))
    return model


@dataclass
class Vocabulary:
    """Keys with vectors of their own (entry 0 is the end), known training counts, and each bucket's log10 total."""

    names: list
    known: dict
    totals: np.ndarray
    share: np.ndarray


def vocabulary(counts: DataFrame, most: int, head: int) -> tuple[Vocabulary, int, int]:
    """The vocabulary, all training tokens and all distinct ones."""
    own = {w: c for w, c in commonest(counts.where(F.col("c") >= LEAST), "c", most).items() if w != END and len(w) <= LONG}
    names = [END, *sorted(own, key=lambda w: (-own[w], w))]
    sums = counts.groupBy("bucket", (F.col("word") == END).alias("is_end")).agg(F.sum("c").alias("c"), F.count_if(F.col("c") > 0).alias("v")).collect()  # a row for each bucket
    texts = sum(r.c for r in sums if r.is_end)
    tokens, types = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for r in sums:
        if not r.is_end:
            tokens[r.bucket] += r.c
            types[r.bucket] += r.v
    for w in names[1:]:
        tokens[bucket_of(w)] -= own[w]
        types[bucket_of(w)] -= 1
    size = np.array([texts, *(own[w] for w in names[1:]), *tokens], float) + 1
    known = commonest(counts, "every", head) | own | {END: texts}
    return Vocabulary(names, known, np.log10(tokens + types + 1.0), size / size.sum()), sum(r.c for r in sums), sum(r.v for r in sums)


def code(docs: DataFrame, key: str, text: str, folds: tuple[int, int], v: Vocabulary, base_log: float) -> DataFrame:
    """Each document's entries (``ids``) and base score, what its words outside the vocabulary add to its score
    (``inside``), and its words (word, n) whose counts a task doesn't know."""
    shipped = docs.sparkSession.sparkContext.broadcast(v)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shipped.value
        n_own = len(v.names)
        # places: the vocabulary first, then other known words, then a place for each bucket
        place = {w: k for k, w in enumerate(v.names)}
        for w in v.known:
            place.setdefault(w, len(place))
        n_known = len(place)
        of = np.array([bucket_of(w) for w in place] + list(range(BUCKETS)), np.int32)
        entry = np.where(np.arange(len(of)) < n_own, np.arange(len(of)), n_own + of).astype(np.int32)
        c = np.array([v.known[w] for w in place] + [0] * BUCKETS, np.int64)
        log_c = np.log10(c + 1.0)
        adds = np.where(np.arange(len(of)) < n_own, 0.0, log_c - v.totals[of])
        direct = {w: k for w, k in place.items() if len(w) <= LONG}
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for s in range(0, len(ids), 512):
                tails, parts, ends, n = [], [], [], 0
                for t in batch.column(1).slice(s, 512).to_pylist():
                    words = words_of(t)
                    p = np.fromiter(map(direct.get, words, repeat(-1)), np.int32, len(words))
                    tail: Counter = Counter()
                    for x in np.flatnonzero(p < 0).tolist():
                        k = key_of(words[x])
                        at = place.get(k, -1) if len(k) > LONG else -1
                        if at < 0:
                            tail[k] += 1
                            at = n_known + bucket_of(k)
                        p[x] = at
                    tails.append(tail)
                    parts += [p, np.zeros(1, np.int32)]
                    n += len(words) + 1
                    ends.append(n)
                p, ends = np.concatenate(parts), np.array(ends)
                starts = np.append(0, ends[:-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[s : s + 512], pa.int64()),
                        pa.array(ends - starts, pa.int64()),
                        pa.array(np.add.reduceat((c[p] > 0).astype(np.int64), starts), pa.int64()),
                        pa.array(np.add.reduceat(log_c[p], starts) - (ends - starts) * base_log, pa.float64()),
                        pa.array(np.add.reduceat(adds[p], starts), pa.float64()),
                        pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(entry[p], pa.int32())),
                        pa.array([list(t) for t in tails], pa.list_(pa.binary())),
                        pa.array([list(t.values()) for t in tails], pa.list_(pa.int64())),
                    ],
                    names=["key", "n_tokens", "n_known", "base", "inside", "ids", "word", "n"],
                )

    schema = "key long, n_tokens long, n_known long, base double, inside double, ids array<int>, word array<binary>, n array<long>"
    coded = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(run, schema)
    return written(coded.select("*", F.monotonically_increasing_id().alias("row"), in_fold("key", *folds).alias("held_out")))


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", folds: tuple[int, int] = FOLDS, vocab: int = MOST_VOCAB, head: int = HEAD, rounds: int = ROUNDS) -> DataFrame:
    """Base and model log10-probability of each text."""
    counts = written(count(docs, key, text, folds))
    v, total, types = vocabulary(counts, vocab, head)
    coded = code(docs, key, text, folds, v, float(np.log10(total + types + 1)))
    model = train(coded.where("not held_out"), v.share, rounds)
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probabilities = Probabilities(shipped.value)
        for batch in batches:
            for s in range(0, batch.num_rows, 512):
                part = batch.slice(s, 512)
                w, ends = _texts(part.column(1))
                lp = probabilities(*contexts(w, ends, 0), w) / np.log(10)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.add.reduceat(lp, np.append(0, ends[:-1])), pa.float64())], names=["row", "model"])

    scored = coded.select("row", "ids").mapInArrow(run, "row long, model double")
    rare = coded.select("row", F.explode(F.arrays_zip("word", "n")).alias("x")).select("row", "x.word", "x.n")
    met = rare.join(counts.where("c > 0").select("word", "c"), "word")
    more = met.groupBy("row").agg(F.sum("n").alias("known"), F.sum(F.col("n") * F.log10(F.col("c") + F.lit(1.0))).alias("logs"))
    slim = coded.select("row", "key", "held_out", "n_tokens", "n_known", "base", "inside")
    logs = F.coalesce("logs", F.lit(0.0))
    return slim.join(scored, "row").join(more, "row", "left").select(
        F.col("key").alias(key),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + logs).alias("base_score"),
        (F.col("model") + F.col("inside") + logs).alias("score"),
    )
