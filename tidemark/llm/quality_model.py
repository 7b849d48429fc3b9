"""Quality classifier: Bradley-Terry ranking from preference pairs.

Every labelled good text is preferred to every labelled bad one. A text's strength is linear in its features: counts of
symbols, capitals, repeats and the like, and hashed words, word beginnings and word ends. The
chance that one is preferred to another is the logistic function of the difference of strengths; weights minimise the
logistic loss over pairs, from weights learnt of a few ids on to steps over every pair of all labelled ids. The threshold is the strength's quantile at the share of bad labels; scores are
shifted so that it falls on 0.7.

Every text is measured once and stored in compact form, some hundred bytes long; learning and scoring read only that, so
no text is shuffled.

Defined results: a null text is empty and scored like one; a document with several or null labels counts as labelled
once for each known one; without labels of both kinds every score is that of equal strength; repeated rows are each
scored; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_fold, py_in_fold, written
from .textview import TextView

#: Labelled ids that the driver fits at once; of more these only give the weights that steps over all ids start from.
MOST_LABELLED = 6_000
#: Steps over all labelled ids, and the width of the cells of strength that their pairs meet in.
STEPS, CELL = 12, 0.01
#: Hashed features, and words whose places a worker remembers.
HASHED, REMEMBERED = 1 << 12, 500_000
EDGE = b".,;:!?\"'()[]{}<>*#$%&~-_"
THRESHOLD = 0.7
FOLDS = (4, 2)


def counted(v: TextView) -> list[float]:
    n, w = max(1, v.n_words), max(1, v.word_bytes)
    lines = max(1, len(v.lines))
    soft = lambda x, scale: float(np.tanh(x / scale))
    return [
        soft(v.n_symbols / n, 0.1),
        soft(v.n_upper / w, 0.2),
        soft(v.n_marks / n, 0.2),
        soft(v.n_dup_lines / lines, 0.3),
        soft(v.n_repeat_words / n, 0.2),
        soft(v.n_adjacent / n, 0.1),
        soft(v.n_digits / w, 0.2),
        soft(v.word_chars / n, 8.0),
        soft(v.n_distinct / n, 0.5),
        soft(n, 20.0),
        soft(n, 200.0),
        soft(n / lines, 20.0),
    ]


class Features:
    """A text's counted properties, then its words, word beginnings and word ends by hash, log-scaled and of unit length."""

    size = 12 + HASHED

    def __init__(self) -> None:
        self.places: dict = {}

    def _place(self, word: bytes) -> tuple[int, int, int]:
        got = self.places.get(word)
        if got is None:
            if len(self.places) >= REMEMBERED:
                self.places.clear()
            bare = word.strip(EDGE).lower()
            got = self.places[word] = tuple(zlib.crc32(x) % HASHED for x in (bare, b"<" + bare[:3], bare[-3:] + b">"))
        return got

    def counts(self, text: str | None) -> tuple[list[float], np.ndarray, np.ndarray]:
        """The counted properties, then the hashed places that the text has and how often each."""
        v = TextView(text)
        found = np.bincount(np.array([p for w in v.words for p in self._place(w)], np.int64), minlength=HASHED)
        at = np.flatnonzero(found)
        return counted(v), at, found[at]

    def __call__(self, text: str | None) -> np.ndarray:
        first, at, n = self.counts(text)
        hashed = np.zeros(HASHED)
        hashed[at] = np.log1p(n)
        return np.concatenate([first, hashed / max(1e-9, np.linalg.norm(hashed))]).astype(np.float32)

    def packed(self, text: str | None) -> bytes:
        """What :func:`unpacked` reads: counted properties, places as steps from the last one, counts."""
        first, at, n = self.counts(text)
        wide = int(n.max(initial=0) > 255)
        steps = np.diff(at, prepend=0)
        far = int(steps.max(initial=0) > 255)
        return np.array(first, np.float32).tobytes() + bytes([wide, far]) + steps.astype((np.uint8, np.uint16)[far]).tobytes() + n.astype((np.uint8, np.uint32)[wide]).tobytes()


def sample_labels(labels: DataFrame, label: str, key: str, folds: tuple[int, int], most: int) -> DataFrame:
    """At most ``most`` labelled ids outside the held-out fold, in the order of a hash of the id; an id labelled both ways
    counts with the larger label."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull() & ~in_fold(key, *folds)).groupBy(F.col(key).alias("_id")).agg(F.max(label).alias("_label"))
    return known.orderBy(F.md5(F.col("_id").cast("string").cast("binary")), "_label").limit(most)


def labelled(labels: DataFrame, label: str, key: str, folds: tuple[int, int]) -> DataFrame:
    """All labelled ids outside the held-out fold; an id labelled both ways counts with the larger label."""
    return labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull() & ~in_fold(key, *folds)).groupBy(F.col(key).alias("_id")).agg(F.max(label).cast("int").alias("_label"))


def stratified(labels: DataFrame, label: str, key: str, folds: tuple[int, int], most: int) -> tuple[DataFrame, dict[int, float]]:
    """Half of ``most`` ids of each label at most, and how many ids each of them stands for: a rare label is never crowded out."""
    known = labelled(labels, label, key, folds)
    sizes = {r._label: r["count"] for r in known.groupBy("_label").count().collect()}  # two rows
    parts = [known.where(F.col("_label") == y).orderBy(F.md5(F.col("_id").cast("string").cast("binary"))).limit(max(1, most // 2)) for y in (0, 1)]
    return parts[0].unionByName(parts[1]), {y: max(1.0, n / max(1, most // 2)) for y, n in sizes.items()}


def fit(x: np.ndarray, y: np.ndarray, stands: np.ndarray | None = None, rounds: int = 150, rate: float = 1.0, ridge: float = 3e-4) -> tuple[np.ndarray, float, float]:
    """Weights, threshold and scale. Every pair pulls its two texts apart; the other label's strengths are counted by narrow
    cells, so a step costs one product over the texts, and no pair is drawn.

    The threshold is the quantile of scores at the share of bad texts, each text counted as many times as it ``stands`` for.
    """
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    weights = np.zeros(x.shape[1], np.float32)
    if not len(good) or not len(bad):
        return weights, 0.0, 1.0
    speed = np.zeros_like(weights)
    for _ in range(rounds):
        strength = x @ weights
        each = np.zeros(len(x))
        for mine, other, way in ((good, bad, -1), (bad, good, 1)):
            cells, many = np.unique(np.floor(strength[other] / CELL), return_counts=True)
            grid = np.linspace(strength.min() - CELL, strength.max() + CELL, 512)
            pull = (1 / (1 + np.exp(np.clip(-way * (grid[:, None] - (cells + 0.5) * CELL), -50, 50)))) @ many / len(other)
            each[mine] = -way * np.interp(strength[mine], grid, pull) / len(mine)
        speed = 0.9 * speed + rate * (each.astype(np.float32) @ x - ridge * weights)
        weights += speed
    strength = x @ weights
    order = np.argsort(strength, kind="stable")
    strength, stands = strength[order], (np.ones(len(y)) if stands is None else stands)[order]
    upto = np.cumsum(stands)
    k = min(int(np.searchsorted(upto, stands[y[order] == 0].sum() * (1 - 1e-9))), len(y) - 2)
    mean = np.average(strength, weights=stands)
    spread = np.sqrt(np.average((strength - mean) ** 2, weights=stands))
    return weights, float((strength[k] + strength[k + 1]) / 2), float(max(1e-9, spread) / 4)


def train(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, folds: tuple[int, int], most: int) -> tuple[np.ndarray, float, float]:
    """Learn from one text of each labelled id (the first by hash, where rows with its id differ), however many there are.

    The driver starts from at most ``most`` of them. If there are more, steps over all of them follow, and threshold and
    scale come from all.
    """
    return learn(measured(docs, key, text), labels, label, key, folds, most)


def measured(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, hash, x) of every text, stored: its MD5 and its features."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                part = batch.slice(s, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([features.packed(t) for t in part.column(2).to_pylist()], pa.binary())], names=["key", "hash", "x"])

    rows = docs.select(F.col(key).alias("key"), F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))).alias("hash"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return written(rows.mapInArrow(run, f"key {kind}, hash binary, x binary"))


def learn(made: DataFrame, labels: DataFrame, label: str, key: str, folds: tuple[int, int], most: int) -> tuple[np.ndarray, float, float]:
    """:func:`train` from measured texts. Only their features are shuffled, once, by id, at any size of the labels."""
    chosen, stand = stratified(labels, label, key, folds, most)
    one = made.where(F.col("key").isNotNull() & ~in_fold("key", *folds)).groupBy(F.col("key").alias("_id")).agg(F.min_by("x", "hash").alias("x"))
    known = one.join(labelled(labels, label, key, folds), "_id")
    all_ = written(known.select(F.col("_id").cast("string").alias("id"), F.col("_label").cast("long").alias("y"), "x"))
    first = all_.join(F.broadcast(chosen.select(F.col("_id").cast("string").alias("id"))), "id")
    got = first.orderBy("y", "x").toArrow()  # a row an id, at most ``most``
    x = np.zeros((got.num_rows, Features.size), np.float32)
    at, values, sizes = unpacked(got["x"])
    x[np.repeat(np.arange(len(x)), sizes), at] = values
    y = got["y"].to_numpy()
    start = fit(x, y, np.array([stand[k] for k in y.tolist()]))
    return start if max(stand.values(), default=1.0) <= 1.0 or not start[0].any() else fit_all(all_, start[0])


def unpacked(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and values of stored features, one text after another, and how many each text has (at least the counted ones)."""
    ats, ns, firsts = [], [], []
    for raw in column.to_pylist():
        wide, far = raw[48], raw[49]
        n = (len(raw) - 50) // ((1, 4)[wide] + (1, 2)[far])
        firsts.append(np.frombuffer(raw, np.float32, 12))
        ats.append(np.frombuffer(raw, (np.uint8, np.uint16)[far], n, 50))
        ns.append(np.frombuffer(raw, (np.uint8, np.uint32)[wide], n, 50 + n * (1, 2)[far]))
    sizes = np.array([len(a) + 12 for a in ats], np.int64)
    if not len(sizes):
        return np.zeros(0, np.int64), np.zeros(0, np.float32), sizes
    starts = np.cumsum(sizes) - sizes
    counted_at = (starts[:, None] + np.arange(12)).ravel()
    hashed_at = np.ones(sizes.sum(), bool)
    hashed_at[counted_at] = False
    steps, logs = np.concatenate(ats, dtype=np.int64), np.log1p(np.concatenate(ns, dtype=np.float64))
    # running sums and squares over all texts, each less what stood before its text
    ends = np.cumsum(sizes - 12)
    text = np.repeat(np.arange(len(sizes)), sizes - 12)
    total = np.append(0, np.cumsum(steps))
    norm = np.sqrt(np.bincount(text, logs * logs, minlength=len(sizes)))
    at, values = np.empty(len(hashed_at), np.int64), np.empty(len(hashed_at), np.float32)
    at[counted_at], values[counted_at] = np.tile(np.arange(12), len(sizes)), np.concatenate(firsts)
    at[hashed_at] = total[1:] - total[ends - (sizes - 12)][text] + 12
    values[hashed_at] = logs / np.maximum(1e-9, norm)[text]
    return at, values, sizes


def strengths(measured: DataFrame, weights: np.ndarray) -> DataFrame:
    """(y, s, cell) of each stored text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 1024):
                batch = whole.slice(k, 1024)
                at, values, sizes = unpacked(batch.column(1))
                s = np.add.reduceat(weights[at] * values, np.cumsum(sizes) - sizes).astype(float)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64())], names=["y", "s"])

    return measured.select("y", "x").mapInArrow(run, "y long, s double").withColumn("cell", F.floor(F.col("s") / CELL))


def fit_all(measured: DataFrame, weights: np.ndarray, rate: float = 1.0, ridge: float = 3e-4) -> tuple[np.ndarray, float, float]:
    """Steps of the loss over all pairs of all stored texts, then threshold and scale over all of them.

    How much a text is pulled depends on its strength and the other label's strengths only: these are counted by narrow
    cells, and each text's pull is the mean over the cells, so that every pair counts and none is drawn.
    """
    sides = {r.y: r["count"] for r in measured.groupBy("y").count().collect()}  # two rows
    speed = np.zeros_like(weights)
    for _ in range(STEPS):
        cells = strengths(measured, weights).groupBy("y", "cell").count().toArrow()  # as many as cells, whatever the table
        y, mid, many = cells["y"].to_numpy(), (cells["cell"].to_numpy() + 0.5) * CELL, cells["count"].to_numpy()
        grid = np.linspace(mid.min() - CELL, mid.max() + CELL, 2048)
        pull = {k: (1 / (1 + np.exp(np.clip((1 if k else -1) * (grid[:, None] - mid[None, y != k]), -50, 50)))) @ many[y != k] / sides[1 - k] for k in (0, 1)}

        def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(weights))
            for whole in batches:
                for k in range(0, whole.num_rows, 1024):
                    batch = whole.slice(k, 1024)
                    at, values, sizes = unpacked(batch.column(1))
                    s, good = np.add.reduceat(weights[at] * values, np.cumsum(sizes) - sizes), batch.column(0).to_numpy() == 1
                    each = np.where(good, np.interp(s, grid, pull[1]) / sides[1], -np.interp(s, grid, pull[0]) / sides[0])
                    total += np.bincount(at, np.repeat(each, sizes) * values, minlength=len(weights))
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["g"])

        parts = measured.select("y", "x").mapInArrow(step, "g binary").collect()  # a row a task, of the model's size
        pulled = np.sum([np.frombuffer(r.g) for r in parts], axis=0)
        speed = 0.9 * speed + rate * (pulled.astype(np.float32) - ridge * weights)
        weights = weights + speed
    by = strengths(measured, weights)
    bad, n = sides[0], sides[0] + sides[1]
    sizes = sorted((r.cell, r["count"]) for r in by.groupBy("cell").count().collect())
    upto = np.cumsum([c for _, c in sizes])
    low = min(bad - 1, n - 2)  # the threshold lies between this place and the next
    near = [int(np.searchsorted(upto, k, side="right")) for k in (low, low + 1)]
    inside = sorted((r.s, r["count"]) for r in by.where(F.col("cell").isin([sizes[i][0] for i in near])).groupBy("s").count().collect())
    places = np.cumsum([c for _, c in inside]) + (upto[near[0]] - sizes[near[0]][1])
    ends = [inside[int(np.searchsorted(places, k, side="right"))][0] for k in (low, low + 1)]
    spread = by.agg(F.stddev_pop("s").alias("d")).first().d
    return weights, float(sum(ends) / 2), float(max(1e-9, spread) / 4)


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", folds: tuple[int, int] = FOLDS, most: int = MOST_LABELLED) -> DataFrame:
    """Score between 0 and 1 of each document, and whether it reaches 0.7."""
    made = measured(docs, key, text)
    weights, threshold, scale = learn(made, labels, label, key, folds, most)
    shift = float(np.log(THRESHOLD / (1 - THRESHOLD)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                places, values, sizes = unpacked(batch.column(1))
                x = np.add.reduceat(weights[places] * values.astype(float), np.cumsum(sizes) - sizes)
                s = 1 / (1 + np.exp(-np.clip((x - threshold) / scale + shift, -40, 40)))
                held = [py_in_fold(i, *folds) for i in batch.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held, pa.bool_()), pa.array(s, pa.float64()), pa.array((s >= THRESHOLD).astype(np.int32), pa.int32())], names=["key", "held_out", "score", "predicted"])

    slim = made.select(F.col("key").cast("long").alias("key"), "x")
    return slim.mapInArrow(run, "key long, held_out boolean, score double, predicted int").withColumnRenamed("key", key)
