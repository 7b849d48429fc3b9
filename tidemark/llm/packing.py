"""Hierarchical multi-length packing.

A document's ids fill whole longest windows first; what is left is routed to the tier whose window just holds it. Tiers
are packed from the longest: a left-over opens a window of its tier, and the gap takes the longest whole left-overs of
this and shorter tiers that fit, then a cut of the shortest. So every window is full, and windows of all tiers have a
power of two as length. Packing is local to a task, over a buffer of bounded size; only a task's last few ids can need
padding. Windows are dealt to step groups of one tier and equal token counts, costly (quadratic in piece length) with cheap
ones; only the last group of a tier in a task may be smaller.

Defined results: a null text is empty, and an empty document is the closing id alone; repeated rows are separate
documents, told apart by their sequences; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tidy

TIERS = (256, 512, 1024, 2048)
END = 1
#: Left-over tokens held before they are packed.
BUFFER = 1 << 19
#: Tokens of a step group.
STEP = 1 << 14
#: Distinct words whose ids a worker remembers before it starts anew.
CACHE = 400_000
#: Marks that the tokenizer always cuts off behind an ASCII letter or digit.
TAIL = b".,!?;:*#$%&"
#: Put between words that are tokenised together: one id, cut off on both sides by white space.
SEPARATOR = "\x01"
TOGETHER = 500

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long"


class WordIds(dict):
    """Ids of words cut at white space, tokenised once each.

    That holds for tokenizers that never join over white space. Letter case and marks behind a word make further short
    cuts. What a tokenizer does is probed on loading; where a short cut doesn't hold, it isn't taken, and a tokenizer that
    does join over white space gets whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        mark = self.tokenizer.encode(SEPARATOR, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 and self._same(f"ab {SEPARATOR} cd", "ab", SEPARATOR, "cd") else None
        samples = ("ab", "Hello", "x9", "\u00e9t\u00e9", "a,b", "9")
        self.apart = all(self._same(f"{a}{gap}{b}", a, b) for a in samples for b in samples for gap in (" ", "\n", "\t", "  ", " \r\n")) and self._same(" ab ", "ab")
        self.caseless = all(self._same(chr(c - 32) + "q" + chr(c - 32), chr(c) + "q" + chr(c)) for c in range(97, 123))
        marks = TAIL.decode()
        self.tails = all(self._same(w + m + x, w, m + x) for w in ("ab", "x9", "z") for m in marks for x in ("", *marks))
        self.fresh: list = []
        self._reset()

    def _same(self, text: str, *parts: str) -> bool:
        """Whether a text's ids are those of its parts, one behind the other."""
        ids = [self.tokenizer.encode(x, add_special_tokens=False).ids for x in (text, *parts)]
        return ids[0] == [i for x in ids[1:] for i in x]

    def _reset(self) -> None:
        self.clear()
        self.parts: dict = {}
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.part_first, self.part_count = np.zeros(1, np.int64), np.zeros(1, np.int64)  # the first part is empty
        self.parts[b""] = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = k = len(self)
        self.fresh.append(word)
        return k

    def _encode(self, words: list) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words, and how many each has."""
        texts = [w.decode("utf-8", "surrogatepass") for w in words]
        if self.mark is None or any(SEPARATOR in t or "<|" in t for t in texts):
            each = [x.ids for x in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
            return np.fromiter((i for x in each for i in x), np.uint32), np.array([len(x) for x in each], np.int64)
        joined = [f" {SEPARATOR} ".join([*texts[at : at + TOGETHER], ""]) for at in range(0, len(texts), TOGETHER)]
        ids = np.array([i for x in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False) for i in x.ids], np.uint32)
        cut = ids == self.mark
        return ids[~cut], np.diff(np.flatnonzero(cut), prepend=-1) - 1

    def _append(self, ids: np.ndarray) -> None:
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(self.pool), len(ids)), np.uint32)])
        self.pool[self.used : self.used + len(ids)] = ids
        self.used += len(ids)

    def _learn(self) -> None:
        """Ids of new words, put together of lower-cased stems and tails of marks, so that fewer need the tokenizer."""
        pairs, new = np.zeros((len(self.fresh), 2), np.int64), []
        for i, word in enumerate(self.fresh):
            low = word.lower() if self.caseless and b"<|" not in word else word
            stem = low.rstrip(TAIL) if self.tails else low
            if not stem[-1:].isalnum():
                stem = low
            for j, part in enumerate((stem, low[len(stem) :])):
                k = self.parts.get(part)
                if k is None:
                    self.parts[part] = k = len(self.parts)
                    new.append(part)
                pairs[i, j] = k
        if new:
            ids, n = self._encode(new)
            self.part_first = np.concatenate([self.part_first, self.used + np.cumsum(n) - n])
            self.part_count = np.concatenate([self.part_count, n])
            self._append(ids)
        n = self.part_count[pairs]
        ids = self._gather(self.part_first[pairs].ravel(), n.ravel())
        n = n.sum(1)
        self.first = np.concatenate([self.first, self.used + np.cumsum(n) - n])
        self.count = np.concatenate([self.count, n])
        self._append(ids)
        self.fresh = []

    def _gather(self, first: np.ndarray, n: np.ndarray) -> np.ndarray:
        ends = np.cumsum(n)
        return self.pool[np.repeat(first - (ends - n), n) + np.arange(ends[-1] if len(n) else 0)]

    def texts(self, texts: list) -> Iterator[np.ndarray]:
        """The ids of each text (null: none)."""
        if not self.apart:
            for t in texts:
                yield np.array(self.tokenizer.encode(t or "", add_special_tokens=False).ids, np.uint32)
            return
        if len(self) > CACHE:
            self._reset()
        places = []
        for t in texts:
            words = (t or "").encode("utf-8", "surrogatepass").split()
            places.append(np.fromiter(map(self.__getitem__, words), np.int64, len(words)))
        if self.fresh:
            self._learn()
        for at in places:
            yield self._gather(self.first[at], self.count[at])


_words: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The worker's own memory of words, kept from task to task (at most ``CACHE`` words)."""
    if path not in _words:
        _words[path] = WordIds(path)
    return _words[path]


class Packer:
    """Turns documents' ids into pieces placed in windows."""

    def __init__(self, shard: int, tiers: tuple[int, ...] = TIERS):
        self.tiers, self.top, self.shard = tiers, tiers[-1], shard
        self.items: list = []  # (length, n, doc, start, ids), by length
        self.held = self.n = self.windows = self.dealt = 0
        self.groups: dict = {}
        self.out: list = []

    def add(self, doc, ids: np.ndarray) -> None:
        ids = np.append(ids, np.uint32(END))
        whole = len(ids) // self.top * self.top
        for at in range(0, whole, self.top):
            self._close(self.top, [(self.top, 0, (doc, len(ids)), at, ids[at : at + self.top])])
        if whole < len(ids):
            self._hold((doc, len(ids)), whole, ids[whole:].copy())
        if self.held >= BUFFER:
            self.flush()

    def _hold(self, doc, start: int, ids: np.ndarray) -> None:
        self.n += 1
        insort(self.items, (len(ids), self.n, doc, start, ids), key=lambda x: x[:2])
        self.held += len(ids)

    def _take(self, k: int):
        item = self.items.pop(k)
        self.held -= item[0]
        return item

    def flush(self, last: bool = False) -> None:
        keep = 0 if last else self.top  # something always stays to fill gaps with
        while self.held > keep:
            first = self._take(len(self.items) - 1)
            window = next(t for t in self.tiers if first[0] <= t)
            if first[0] + self.held < window:
                self._hold(first[2], first[3], first[4])
                break
            placed, gap = [first], window - first[0]
            while gap:
                k = bisect_right(self.items, gap, key=lambda x: x[0]) - 1
                if k >= 0:
                    item = self._take(k)
                else:
                    whole = self._take(0)
                    item = (gap, 0, whole[2], whole[3], whole[4][:gap])
                    self._hold(whole[2], whole[3] + gap, whole[4][gap:])
                placed.append(item)
                gap -= item[0]
            self._close(window, placed)
        if last and self.items:
            self._remains()

    def _remains(self) -> None:
        """The last few ids: windows of shrinking powers of two."""
        left = self.held
        while left:
            window = 1 << (left.bit_length() - 1)
            placed, gap = [], window
            while gap:
                item = self._take(0)
                if item[0] > gap:
                    self._hold(item[2], item[3] + gap, item[4][gap:])
                    item = (gap, 0, item[2], item[3], item[4][:gap])
                placed.append(item)
                gap -= item[0]
            self._close(window, placed)
            left -= window

    def _close(self, window: int, placed: list) -> None:
        sequence, offset = (self.shard << 32) + self.windows, 0
        self.windows += 1
        waiting = self.groups.setdefault(window, [])
        rows = []
        for length, _, (doc, total), start, ids in placed:
            rows.append([doc, start, length, zlib.crc32(ids.astype("<u4").tobytes()), total, sequence, offset, window])
            offset += length
        waiting.append((sum(x[0] ** 2 for x in placed), rows))
        if len(waiting) * window >= 8 * STEP:
            self._deal(window)

    def _deal(self, window: int, last: bool = False) -> None:
        """Windows by falling cost, dealt to and fro over whole step groups; what fills none waits for more."""
        waiting, each = self.groups[window], max(1, STEP // window)
        n = len(waiting) // each
        whole, self.groups[window] = waiting[: n * each], waiting[n * each :]
        for k, (_, rows) in enumerate(sorted(whole, key=lambda x: -x[0])):
            turn, at = divmod(k, n)
            self._group(rows, n - 1 - at if turn % 2 else at)
        self.dealt += n
        if last and self.groups[window]:
            for _, rows in self.groups.pop(window):
                self._group(rows, 0)
            self.dealt += 1

    def _group(self, rows: list, at: int) -> None:
        group = (self.shard << 32) + self.dealt + at
        self.out += [(*r, group) for r in rows]

    def rows(self, last: bool = False) -> list:
        if last:
            self.flush(True)
            for window in list(self.groups):
                self._deal(window, True)
        out, self.out = self.out, []
        return out


def pack(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", tiers: tuple[int, ...] = TIERS) -> DataFrame:
    """Pieces of documents placed in sequences."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer = word_ids(tokenizer_path), Packer(TaskContext.get().partitionId(), tiers)
        kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
        names = [x.split()[0] for x in SCHEMA.split(", ")]

        def emit(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                for doc, ids in zip(part.column(0).to_pylist(), words.texts(part.column(1).to_pylist())):
                    packer.add(doc, ids)
                if rows := packer.rows():
                    yield emit(rows)
        if rows := packer.rows(last=True):
            yield emit(rows)

    slim = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return slim.mapInArrow(tidy(run), SCHEMA).withColumnRenamed("doc_id", key)
