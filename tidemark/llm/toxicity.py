"""Toxicity by Levenshtein automata over a lexicon trie.

The lexicon is a trie of known terms and of terms learnt from labelled texts: whole words and word beginnings that stand
in several toxic texts, which no known term explains, and in next to no clean one. One automaton walks all terms at once:
its states are sets of (trie node, edits spent), found when first needed and remembered, so a word costs one step a
character. Known and learnt whole words allow an edit from five letters on, and two from nine on; word beginnings none. A
misspelling that also stands in clean labelled texts is an ordinary word and does not count.

Each hit is of a kind (known or learnt, exact or misspelled; a learnt word once a text) in a setting: quotation marks or
reporting words close by speak for a quotation, direct address for abuse. Both kinds of words start from a short list and
are learnt: those that stand near known terms much more often in clean labelled texts than in toxic ones, or the other way
round, in whatever language. Every kind in every setting has a weight, which the labelled sample draws from its starting
value to where the labels are likeliest. The score is one minus the exponential of minus the sum of weights.

Defined results: a null or empty text scores 0; missing or null labels leave the fixed lexicon and starting weights;
repeated rows are each scored; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import py_in_fold, written
from .quality_model import sample_labels

#: The starting lexicon.
TERMS = ("clown", "disgusting", "idiot", "imbecile", "loser", "moron", "pathetic", "scum", "stupid", "trash", "vermin", "worthless")
#: Words that report or address, to start from.
REPORTING = frozenset(b"said says wrote writes called calls word term quote quoted quotes reported claimed mention mentioned".split())
ADDRESS = frozenset(b"you your you're youre u ur yourself".split())
QUOTES = (b'"', "“".encode(), "”".encode(), "«".encode(), "»".encode(), "„".encode())
EDGE = b".,;:!?\"'()[]{}<>*#$%&~-_"
#: Characters written for letters.
LEET = bytes.maketrans(b"013457@$", b"oieastas")
WINDOW = 6
#: Starting weights of the kinds of hits, and what a quotation or an address makes of them.
KINDS, QUOTED, DIRECT = (0.9, 0.4, 0.4, 0.3), 0.35, 1.5
#: Most weight of a learnt word, so that one alone never reaches a score of one half.
MOST_LEARNT = 0.68
#: What :meth:`Scorer.edits` adds for a learnt term.
LEARNT = 10
#: Bound of the labelled sample, and so of all that is learnt from it.
MOST_LABELLED = 12_000
#: A word of a setting stands near known terms in so many texts of one label, and in so many times more of them.
LEAST_NEAR, TIMES_NEAR = 5, 4
#: A learnt term stands in so many toxic texts at least, and in so many times more of them than of clean ones.
LEAST, TIMES = 3, 10
PREFIXES = (4, 5, 6, 7)
FOLDS = (5, 0)
MEMORY = 200_000


def edits_of(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Lexicon:
    """A trie of terms; a term ending in ``*`` accepts every word that begins so. Matching walks a lazy automaton."""

    def __init__(self, terms: Iterable[str], allow: Callable[[str], int] = edits_of):
        self.children: list[dict] = [{}]
        self.whole: list[int | None] = [None]  # edits allowed to a term that ends here
        self.begins: list[bool] = [False]
        self.budget: list[int] = [0]  # most edits of the terms below
        for term in sorted(set(terms)):
            stem, star = (term[:-1], True) if term.endswith("*") else (term, False)
            allowed = 0 if star else allow(stem)
            node = 0
            for c in stem:
                self.budget[node] = max(self.budget[node], allowed)
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.whole.append(None)
                    self.begins.append(False)
                    self.budget.append(0)
                node = self.children[node][c]
            self.budget[node] = max(self.budget[node], allowed)
            if star:
                self.begins[node] = True
            else:
                self.whole[node] = allowed
        self._forget()

    def _forget(self) -> None:
        self.ids: dict = {}
        self.states: list = []
        self.steps: list[dict] = []
        self.found: list = []
        self.start = self._state({0: 0})

    def _state(self, spent: dict[int, int]) -> int:
        """The state of (node: fewest edits), closed under leaving out letters of a term."""
        todo = list(spent)
        while todo:
            node = todo.pop()
            e = spent[node] + 1
            for child in self.children[node].values():
                if e <= self.budget[child] and e < spent.get(child, 99):
                    spent[child] = e
                    todo.append(child)
        key = frozenset(spent.items())
        if key not in self.ids:
            self.ids[key] = len(self.states)
            self.states.append(spent)
            self.steps.append({})
            best = min((e for n, e in spent.items() if self.whole[n] is not None and e <= self.whole[n]), default=None)
            self.found.append((best, any(self.begins[n] and e == 0 for n, e in spent.items())))
        return self.ids[key]

    def _step(self, state: int, c: str) -> int:
        spent: dict[int, int] = {}

        def put(node: int, e: int) -> None:
            if e <= self.budget[node] and e < spent.get(node, 99):
                spent[node] = e

        for node, e in self.states[state].items():
            put(node, e + 1)
            for x, child in self.children[node].items():
                put(child, e + (x != c))
        nxt = self._state(spent) if spent else -1
        self.steps[state][c] = nxt
        return nxt

    def edits(self, word: str) -> int | None:
        """Fewest edits to a term that allows them; None if there's none."""
        if len(self.states) > MEMORY:
            self._forget()
        state, begun = self.start, False
        for c in word:
            nxt = self.steps[state].get(c)
            state = self._step(state, c) if nxt is None else nxt
            if state < 0:
                return 0 if begun else None
            begun = begun or self.found[state][1]
        best = self.found[state][0]
        return 0 if begun else best


def core(word: bytes) -> bytes:
    """A word without marks at its ends, ASCII letters lower-cased."""
    return word.strip(EDGE).lower()


START = np.array([k * (QUOTED if quoted else 1) * (DIRECT if direct else 1) for k in KINDS for quoted in (0, 1) for direct in (0, 1)])


class Scorer:
    def __init__(self, terms: Iterable[str], learnt: Iterable[str] = (), ordinary: Iterable[str] = (), weights: np.ndarray = START, reporting: frozenset = REPORTING, address: frozenset = ADDRESS):
        self.reporting, self.address = reporting, address
        self.lexicon, self.learnt, self.ordinary, self.weights = Lexicon(terms), Lexicon(learnt), frozenset(ordinary), weights
        self.known: dict = {}

    def _of(self, lexicon: Lexicon, bare: bytes, plain: str) -> int | None:
        got = lexicon.edits(plain)
        if got is None or got:
            as_letters = bare.translate(LEET)
            if as_letters != bare and (other := lexicon.edits(as_letters.decode("utf-8", "replace"))) is not None:
                got = other if got is None else min(other, got)
        return None if got and plain in self.ordinary else got

    def edits(self, word: bytes) -> int | None:
        """Edits of a word as it stands in a text, for a learnt term LEARNT more; None if it is no term. Remembered."""
        got = self.known.get(word, -1)
        if got == -1:
            bare = core(word)
            plain = bare.decode("utf-8", "replace")
            got = self._of(self.lexicon, bare, plain)
            if got is None and (other := self._of(self.learnt, bare, plain)) is not None:
                got = LEARNT + other
            if len(self.known) > MEMORY:
                self.known.clear()
            self.known[word] = got
        return got

    def features(self, text: str | None) -> np.ndarray:
        """Hits of each kind in each setting."""
        words = (text or "").encode("utf-8", "surrogatepass").split()
        out, counted = np.zeros(len(START)), set()
        for i, e in enumerate(map(self.edits, words)):
            if e is None:
                continue
            if e >= LEARNT:
                if (bare := core(words[i])) in counted:
                    continue
                counted.add(bare)
            near = set(map(core, words[max(0, i - WINDOW) : i + WINDOW + 1]))
            quoted = bool(near & self.reporting) or any(q in w for w in words[max(0, i - 2) : i + 3] for q in QUOTES)
            kind = 2 * (e >= LEARNT) + (e % LEARNT > 0)
            out[4 * kind + 2 * quoted + bool(near & self.address)] += 1
        return out

    def company(self, text: str | None) -> tuple[list[bytes], list[bytes]]:
        """Words near terms and those further off, in a text that has a term; terms and words without a letter left out."""
        words = (text or "").encode("utf-8", "surrogatepass").split()
        hits = [self.edits(w) is not None for w in words]
        if True not in hits:
            return [], []
        close = np.convolve(hits, np.ones(2 * WINDOW + 1, int))[WINDOW : WINDOW + len(words)] > 0
        out: tuple = ([], [])
        for w, hit, c in zip(map(core, words), hits, close.tolist()):
            if not hit and w and not w.isdigit():
                out[0 if c else 1].append(w)
        return out

    def score(self, text: str | None) -> float:
        return 1 - math.exp(-float(self.features(text) @ self.weights))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 400, rate: float = 0.5, hold: float = 0.002) -> np.ndarray:
    """Weights, none negative, that make the labels likeliest; ``hold`` draws them to their start."""
    w = START.copy()
    most = np.repeat([np.inf, np.inf, MOST_LEARNT, MOST_LEARNT], 4)
    for _ in range(rounds if len(x) else 0):
        left = np.exp(-x @ w)
        slope = np.where(y == 1, np.minimum(20.0, left / np.maximum(1e-9, 1 - left)), -1.0)
        w = np.clip(w + rate * (slope @ x / len(x) - hold * (w - START)), 0.0, most)
    return w


def learn(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, folds: tuple[int, int], most: int) -> dict:
    """What the labelled sample teaches a :class:`Scorer`: learnt terms, misspellings of terms that clean texts hold,
    words that report or address, and weights."""
    chosen = sample_labels(labels, label, key, folds, most)
    rows = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_id")
    rows = rows.groupBy(F.md5(F.col("_text").cast("binary")).alias("_id")).agg(F.max("_label").cast("long").alias("toxic"), F.first("_text").alias("text"))
    sample = written(rows.select("toxic", "text", (F.pmod(F.xxhash64("_id"), F.lit(2)) == 0).alias("half")))  # bounded, as the labels are
    start = list(TERMS)

    def terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(start)
        for batch in batches:
            out = []
            for t in batch.column(1).to_pylist():
                words = {core(w) for w in (t or "").encode("utf-8", "surrogatepass").split()}
                found = set()
                if not any(scorer.edits(w) == 0 for w in words):  # texts that known terms explain teach no others
                    plain = [w for x in words if len(w := x.decode("utf-8", "replace")) >= 4 and re.fullmatch(r"\w+", w)]
                    found = {*plain, *(w[:n] + "*" for w in plain for n in PREFIXES if len(w) >= n)}
                out.append(sorted(found))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(out, pa.list_(pa.string()))], names=["toxic", "half", "terms"])

    found = written(sample.mapInArrow(terms, "toxic long, half boolean, terms array<string>").select("toxic", "half", F.explode("terms").alias("term")))

    def best(rows: DataFrame) -> list[str]:
        counts = rows.groupBy("term").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("f"))
        good = counts.where((F.col("t") >= LEAST) & (F.col("f") * TIMES <= F.col("t"))).select("term")
        return sorted(r.term for r in good.collect())  # of a bounded sample

    learnt, of_half = best(found), best(found.where("half"))

    def misspelled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(start, learnt)
        for batch in batches:
            for t in batch.column(1).to_pylist():
                words = {core(w) for w in (t or "").encode("utf-8", "surrogatepass").split()}
                near = sorted(w.decode("utf-8", "replace") for w in words if (scorer.edits(w) or 0) % LEARNT)
                yield pa.RecordBatch.from_arrays([pa.array(near, pa.string())], names=["word"])

    ordinary = [r.word for r in sample.where("toxic = 0").mapInArrow(misspelled, "word string").distinct().orderBy("word").collect()]  # of a bounded sample

    def neighbours(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, seen = Scorer(start), {}
        for batch in batches:
            for toxic, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                near, far = scorer.company(t)
                for k, ws in enumerate((set(near), near, far)):
                    for w in ws:
                        seen.setdefault((toxic, w), [0, 0, 0])[k] += 1
        yield pa.RecordBatch.from_arrays([pa.array([k[n] for k in seen], t) for n, t in enumerate((pa.int64(), pa.binary()))] + [pa.array([v[n] for v in seen.values()], pa.int64()) for n in range(3)], names=["toxic", "word", "texts", "near", "far"])

    # of texts with a known term: in how many a word is near one, and how often it is near one or further off, by label
    counted = sample.mapInArrow(neighbours, "toxic long, word binary, texts long, near long, far long").groupBy("toxic", "word").agg(*(F.sum(c).alias(c) for c in ("texts", "near", "far"))).collect()  # of a bounded sample
    near, far = ({y: 1 + sum(r[c] for r in counted if r.toxic == y) for y in (0, 1)} for c in ("near", "far"))
    by = {(r.toxic, bytes(r.word)): r for r in counted}

    def speaks(y: int) -> frozenset:
        """Words that stand near terms: in texts of this label, more than in those of the other, and than elsewhere in them."""
        out = set()
        for (z, w), r in by.items():
            if z == y and r.texts >= LEAST_NEAR:
                share = r.near / near[y]
                other = by.get((1 - y, w))
                if share >= TIMES_NEAR * ((other.near if other else 0) + 0.5) / near[1 - y] and share >= TIMES_NEAR * (r.far + 0.5) / far[y]:
                    out.add(w)
        return frozenset(out)

    reporting, address = REPORTING | speaks(0), ADDRESS | speaks(1)

    # weights: by the terms of one half on the other, as terms look better than they are on texts that taught them
    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(start, of_half, ordinary, reporting=reporting, address=address)
        for batch in batches:
            x = [scorer.features(t).tolist() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["toxic", "x"])

    got = sample.where("not half").mapInArrow(measure, "toxic long, x array<double>").groupBy("toxic", "x").count().orderBy("toxic", "x").toArrow()  # bounded, as the sample is
    x = np.array(got["x"].to_pylist()).reshape(-1, len(START))
    n = got["count"].to_numpy()
    weights = fit(np.repeat(x, n, axis=0), np.repeat(got["toxic"].to_numpy(), n))
    return {"learnt": learnt, "ordinary": ordinary, "weights": weights, "reporting": reporting, "address": address}


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", folds: tuple[int, int] = FOLDS, most: int = MOST_LABELLED) -> DataFrame:
    """Score between 0 and 1 of each document, and whether it reaches one half."""
    taught = learn(docs, labels, key, text, label, folds, most)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(TERMS, **taught)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            s = [scorer.score(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([py_in_fold(i, *folds) for i in ids], pa.bool_()), pa.array(s, pa.float64()), pa.array([int(x >= 0.5) for x in s], pa.int32())], names=["key", "held_out", "score", "predicted"])

    slim = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return slim.mapInArrow(run, "key long, held_out boolean, score double, predicted int").withColumnRenamed("key", key)
