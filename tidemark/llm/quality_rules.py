"""Quality rules as a short-circuit cascade.

Every rule is a test that rejects a text by some measured properties of it. On a sample of the documents, a cascade
measures what each property costs and which rules reject together. It asks first the rule with most rejections per second,
then the one with most rejections, among texts not yet rejected, per second of what is not yet measured, and so on, and
stops at the first that rejects. The order changes the time only: a document is kept if no rule rejects it.

Defined results: a null text has no words and is rejected (fewer than 20 words); repeated rows are judged one by one;
null ids pass through; an empty table gives an empty result; other columns are ignored or, in :func:`keep_good`, kept.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textview import MADE_OF, TextView, with_parts


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[TextView], bool]
    #: The properties of a text that the rule reads.
    reads: tuple[str, ...]


MIN_WORDS = 20

#: The two base rules, then the cascade's own. All are shares of the whole text.
BASE_RULES = (
    Rule("too_short", lambda v: v.n_words < MIN_WORDS, ("n_words",)),
    Rule("repeats", lambda v: 100 * v.n_repeat_words > 30 * v.n_words, ("n_repeat_words", "n_words")),
)
RULES = (
    *BASE_RULES,
    Rule("symbols", lambda v: v.n_symbols > 0.15 * v.n_words, ("n_symbols", "n_words")),
    Rule("capitals", lambda v: v.n_upper > 0.3 * v.word_bytes, ("n_upper", "word_bytes")),
    Rule("marks", lambda v: v.n_marks > 0.25 * v.n_words, ("n_marks", "n_words")),
    Rule("dup_lines", lambda v: v.n_dup_lines > 0.6 * max(4, len(v.lines)), ("n_dup_lines",)),
    Rule("stutter", lambda v: v.n_adjacent > 0.25 * v.n_words, ("n_adjacent", "n_words")),
    Rule("digits", lambda v: v.n_digits > 0.4 * v.word_bytes, ("n_digits", "word_bytes")),
    Rule("long_words", lambda v: v.word_chars > 25 * v.n_words, ("word_chars", "n_words")),
)
#: Seconds that asking a rule costs beside what it reads.
ASKING = 2e-7
#: Texts that are measured to order the rules: a share of all, and about so many at most.
FRACTION, MOST_MEASURED = 0.01, 1 << 15


def profile(df: DataFrame, rules: tuple[Rule, ...], text: str = "text", fraction: float = FRACTION, most: int = MOST_MEASURED, seed: int = 7) -> tuple[dict[str, float], dict[int, int]]:
    """From a sample of ``fraction`` of the rows, about ``most`` of them at most: seconds a text that each property costs beyond those it is made of, and
    the number of texts for each set of rejecting rules (bit k: rule k)."""
    used = with_parts(p for r in rules for p in r.reads)
    names = [p for p in MADE_OF if p in used]

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, seen = [0.0] * len(names), Counter()
        for batch in batches:
            for x in batch.column(0).to_pylist():
                view = TextView(x)
                for k, name in enumerate(names):
                    t = time.perf_counter()
                    getattr(view, name)
                    spent[k] += time.perf_counter() - t
                seen[sum(bool(r.rejects(view)) << k for k, r in enumerate(rules))] += 1
        yield pa.RecordBatch.from_pydict({"bits": [*seen, *range(len(names))], "n": [*seen.values(), *[0] * len(names)], "spent": [*[0.0] * len(seen), *spent], "prop": [False] * len(seen) + [True] * len(names)})

    got = df.select(F.col(text)).sample(min(fraction, most / max(1, df.count())), seed).mapInArrow(measure, "bits long, n long, spent double, prop boolean")
    rows = got.groupBy("bits", "prop").agg(F.sum("spent").alias("spent"), F.sum("n").alias("n")).collect()  # bounded by the rules
    seen = {r.bits: r.n for r in rows if not r.prop}
    return {names[r.bits]: r.spent / max(1, sum(seen.values())) for r in rows if r.prop}, seen


def ordered(rules: tuple[Rule, ...], measured: tuple[dict[str, float], dict[int, int]]) -> tuple[Rule, ...]:
    """Rules by falling rejections among the texts left per second of what is new to measure; ties as given."""
    cost, left = measured
    todo, known, order = dict(enumerate(rules)), set(), []
    while todo:

        def gain(k: int) -> float:
            hits = sum(n for bits, n in left.items() if bits >> k & 1)
            return hits / (ASKING + sum(cost.get(p, 0.0) for p in with_parts(todo[k].reads) - known))

        best = max(todo, key=gain)
        rule = todo.pop(best)
        order.append(rule)
        known |= with_parts(rule.reads)
        left = {bits: n for bits, n in left.items() if not bits >> best & 1}
    return tuple(order)


def passes(view: TextView, rules: Iterable[Rule]) -> bool:
    return not any(rule.rejects(view) for rule in rules)


def judge(df: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Base counts and the cascade's verdict, one row for each document."""
    order = ordered(rules, profile(df, rules, text))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            views = map(TextView, batch.column(1).to_pylist())
            rows = []
            for v in views:
                kept = passes(v, order)
                bad = any(r.rejects(v) for r in BASE_RULES)
                rows.append((v.n_words, v.word_chars, v.n_symbols, v.n_dup_lines, v.n_repeat_words, bad, kept and not bad))
            cols = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:5]), *(pa.array(c, pa.bool_()) for c in cols[5:])],
                names=["key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
            )

    slim = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    schema = "key long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean"
    return slim.mapInArrow(count, schema).withColumnRenamed("key", key)


def keep_good(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows whose text no rule rejects, all columns kept."""
    order = ordered(rules, profile(df, rules, text))
    at = df.columns.index(text)

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([passes(TextView(x), order) for x in batch.column(at).to_pylist()], pa.bool_()))

    return df.mapInArrow(keep, df.schema)
