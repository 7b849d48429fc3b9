"""Lazily measured properties of one text, shared by the quality rules and the quality classifier."""

from __future__ import annotations

from collections.abc import Iterable
from functools import cached_property

import numpy as np

#: The characters counted as symbols.
SYMBOLS = (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")
UPPER = bytes(range(65, 91))
WINDOW = 8


def repeated_window_words(words: list, window: int = WINDOW) -> int:
    """Number of words that lie in a ``window``-word window found at least twice in ``words``.

    Rolling 64-bit hashes rule out texts without repeats (equal windows have equal hashes). Where hashes repeat,
    windows are compared exactly: words become integers, and runs of 1, 2, 4 words are renumbered by pairs.
    """
    n = len(words) - window + 1
    if n < 2:
        return 0
    seen: dict = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.uint64, len(words))
    if len(seen) == len(words):
        return 0
    mixed = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    key = np.zeros(n, np.uint64)
    for i in range(window):
        key = key * np.uint64(0x100000001B3) + mixed[i : i + n]
    key.sort()
    if not (key[1:] == key[:-1]).any():
        return 0
    exact, run = ids.astype(np.int64), 1
    while run < window:
        step = min(run, window - run)
        pair = exact[: len(words) - run - step + 1] * np.int64(len(words) + 1) + exact[step : step + len(words) - run - step + 1]
        exact = np.unique(pair, return_inverse=True)[1].astype(np.int64)
        run += step
    twice = np.bincount(exact)[exact] >= 2
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    edge[at] += 1
    edge[at + window] -= 1
    return int((np.cumsum(edge[:-1]) > 0).sum())


#: Which properties each property is made of, the made ones later.
MADE_OF = {
    "words": (),
    "n_words": ("words",),
    "word_bytes": ("words",),
    "word_chars": ("word_bytes",),
    "n_symbols": (),
    "lines": (),
    "n_dup_lines": ("lines",),
    "n_repeat_words": ("words",),
    "n_upper": (),
    "n_distinct": ("words",),
    "n_marks": (),
    "n_digits": (),
    "n_adjacent": ("words",),
}


def with_parts(names: Iterable[str]) -> set[str]:
    """The properties and all that they are made of."""
    found: set = set()
    todo = list(names)
    while todo:
        name = todo.pop()
        found.add(name)
        todo += MADE_OF[name]
    return found


class TextView:
    """One text (null: none), each property computed when first read."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.raw = self.text.encode("utf-8", "surrogatepass")

    @cached_property
    def words(self) -> list:
        return self.raw.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_bytes(self) -> int:
        return sum(map(len, self.words))

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - (len(self.raw) - self.word_bytes)

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.raw.count, SYMBOLS))

    @cached_property
    def lines(self) -> list:
        return [x for x in self.raw.split(b"\n") if x.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        return repeated_window_words(self.words)

    @cached_property
    def n_upper(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, UPPER))

    @cached_property
    def n_distinct(self) -> int:
        return len(set(self.words))

    @cached_property
    def n_marks(self) -> int:
        return self.raw.count(b"!") + self.raw.count(b"?")

    @cached_property
    def n_digits(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, b"0123456789"))

    @cached_property
    def n_adjacent(self) -> int:
        return sum(a == b for a, b in zip(self.words, self.words[1:]))
