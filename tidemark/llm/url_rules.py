"""URL filter: explicit host and path rules first, then association rules mined by FP-growth.

Explicit rules and seed host words label pages; a page that nothing speaks against counts as allowed. Each page is a
transaction: its label and all frequent tokens of its URL. FP-growth takes a token at a time with the more frequent
tokens beside it (its conditional pages, equal ones counted) and grows sets from there; sets that imply a label with enough
support and confidence become rules, unless a more general rule already says as much. No token, set or rule is cut off. Growth leaves out only
what a more general rule makes redundant or what can't become a rule: a token that excludes no page of the other label adds
nothing to any set with it, and a set is left when even without all pages that could still be excluded it says nothing new.
So many keys that stand together don't multiply the sets, though no bound holds for all tables. Redundant rules of different
tokens meet in a join. Rules match by an inverted index: each is filed under its rarest token. The surest matching rule
decides; without one a page is allowed.

Defined results: a null URL, or one without ``://``, has an empty host and path and the default verdict; repeated rows
are each judged; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Explicit rules as (verdict, host, path); the longest that fits wins.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: Words in a host that label a page for mining.
SEEDS = frozenset(("adult", "ads", "bets", "casino", "malware", "phishing", "pills", "porn", "spam", "xxx"))
SUPPORT, CONFIDENCE = 0.002, 0.8
#: Cuts nothing. A yardstick: over 2 ** WIDTH rules over the support would be rules multiplied by redundant sets.
WIDTH = 8
#: Conditional pages that a task counts before it hands them on.
MOST_HELD = 1 << 16
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str]:
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    tail = rest[end:]
    stop = min((i for i in map(tail.find, "?#") if i >= 0), default=len(tail))
    return rest[:end].translate(LOWER), tail[:stop]


def explicit(host: str, path: str, rules=RULES) -> tuple[str, str] | None:
    """(rule, verdict) of the longest rule that fits."""
    fit = [(len(h) + len(p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else None


def tokens(url: str | None, host: str, path: str) -> list[str]:
    """Distinct tokens: scheme, host suffix and words, path segments (numbers as one) and their kinds, query keys."""
    if not host and not path:
        return []
    names = host.split(".")
    found = {"scheme=" + url[: url.find("://")].lower(), "top=" + names[-1]}
    found |= {"host=" + w for name in names[:-1] for w in re.split("[-_]", name) if w}
    for k, x in enumerate(x for x in path.split("/") if x):
        stem, dot, kind = x.partition(".")
        found.add(f"path{k}=" + ("#" if stem.isdigit() else stem))
        if dot:
            found.add("file=" + kind)
    query = url[url.find("://") + 3 :].partition("#")[0].partition("?")[2]
    found |= {"query=" + x.partition("=")[0] for x in query.split("&") if x}
    return sorted(found)


def label(host: str, path: str) -> str:
    hit = explicit(host, path)
    if hit:
        return hit[1]
    return "block" if SEEDS & set(re.split("[-._]", host)) else "allow"


Rule = tuple[tuple[str, ...], str, float, float]


def telling(found: list[str], strength: dict[str, float]) -> list[str]:
    """The frequent tokens of a page, in alphabetic order."""
    return sorted(t for t in found if t in strength)


def strengths(each: list, pages: int, blocked: int) -> dict[str, float]:
    """How many standard deviations a token's blocked pages are from what chance would give; rows have item, n, blocked, a, b.

    Of tokens that stand in exactly the same pages only the first counts, as no set tells them apart.
    """
    share = blocked / max(1, pages)
    out, seen = {}, set()
    for r in sorted(each, key=lambda r: r["item"]):
        if (r["n"], r["a"], r["b"]) not in seen:
            seen.add((r["n"], r["a"], r["b"]))
            out[r["item"]] = abs(r["blocked"] - r["n"] * share) / math.sqrt(max(1e-9, r["n"] * share * (1 - share)) + 1)
    return out


def mine(pages: DataFrame, url: str = "url", support: float = SUPPORT, confidence: float = CONFIDENCE) -> tuple[list[Rule], dict[str, float]]:
    """(tokens, verdict, confidence, support) of all rules that say something new, the surest first; and tokens' strengths.

    Frequent tokens are at most a URL's tokens over the support.
    """

    def baskets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for u in batch.column(0).to_pylist():
                host, path = split_url(u)
                if t := tokens(u, host, path):
                    rows.append((u, t, "verdict=" + label(host, path)))
            cols = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.list_(pa.string())), pa.array(cols[2], pa.string())], names=["url", "items", "verdict"])

    made = written(pages.select(url).mapInArrow(baskets, "url string, items array<string>, verdict string"))
    half = lambda k: F.sum(F.pmod(F.shiftright("h", 28 * k), F.lit(1 << 28)))
    block = (F.col("verdict") == "verdict=block").cast("int")
    each = made.select(F.xxhash64("url").alias("h"), block.alias("x"), F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("n"), F.sum("x").alias("blocked"), half(0).alias("a"), half(1).alias("b"))
    whole = made.agg(F.count("*").alias("n"), F.coalesce(F.sum(block), F.lit(0)).alias("blocked")).first()
    frequent = each.where(F.col("n") >= support * whole.n).collect()  # at most a page's tokens over the support
    strength = strengths(frequent, whole.n, whole.blocked)
    names = [r["item"] for r in sorted(frequent, key=lambda r: (-r["n"], r["item"])) if r["item"] in strength]
    got = pruned(written(grown(made.select("items", "verdict"), names, support * whole.n, confidence))).collect()  # the model
    return sorted(((tuple(r["items"]), r.verdict, r.confidence, r.n / whole.n) for r in got), key=lambda r: (-r[2], -r[3], len(r[0]), r[0])), strength


def grown(made: DataFrame, names: list[str], least: float, confidence: float) -> DataFrame:
    """Rules (items, rarest, verdict, confidence, n) that stand in at least ``least`` pages; ``names`` are the frequent tokens,
    the commonest first. None that is not redundant is missing."""
    shipped = made.sparkSession.sparkContext.broadcast((names, {t: k for k, t in enumerate(names)}))

    def conditional(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = shipped.value[1]
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            cols = list(zip(*held)) or [()] * 3
            rows = [pa.array(c, k) for c, k in zip([*cols, list(held.values())], (pa.int32(), pa.binary(), pa.int64(), pa.int64()))]
            held.clear()
            return pa.RecordBatch.from_arrays(rows, names=["item", "before", "blocked", "n"])

        for batch in batches:
            for items, verdict in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ranks = np.array(sorted(place[t] for t in items if t in place), np.int32)
                raw, blocked = ranks.tobytes(), int(verdict == "verdict=block")
                held.update((r, raw[: 4 * k], blocked) for k, r in enumerate(ranks.tolist()))
                if len(held) > MOST_HELD:
                    yield out()
        yield out()

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = shipped.value[0]
        held: list = []
        at = None

        def found() -> pa.RecordBatch:
            raw, blocked, allowed = zip(*held)
            size = np.array([len(x) // 4 for x in raw])
            token, row = np.frombuffer(b"".join(raw), np.int32), np.repeat(np.arange(len(raw)), size)
            b, a = np.array(blocked, np.int64), np.array(allowed, np.int64)
            rules = [(v, *r) for v, mine, other in (("block", b, a), ("allow", a, b)) for r in grow((at,), token, row, mine, other, 0.0, least, confidence)]
            cols = list(zip(*((sorted(names[t] for t in items), names[at], v, c, n) for v, items, c, n in rules))) or [()] * 5
            kinds = (pa.list_(pa.string()), pa.string(), pa.string(), pa.float64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["items", "rarest", "verdict", "confidence", "n"])

        for batch in batches:
            for item, *pages in zip(*(c.to_pylist() for c in batch.columns)):
                if held and item != at:
                    yield found()
                    held = []
                at = item
                held.append(pages)
        if held:
            yield found()

    block = F.col("blocked") == 1
    pages = made.mapInArrow(conditional, "item int, before binary, blocked long, n long").groupBy("item", "before").agg(F.sum(F.when(block, F.col("n")).otherwise(0)).alias("blocked"), F.sum(F.when(block, 0).otherwise(F.col("n"))).alias("allowed"))
    return pages.repartition("item").sortWithinPartitions("item").mapInArrow(search, "items array<string>, rarest string, verdict string, confidence double, n long")


def grow(items: tuple, token: np.ndarray, row: np.ndarray, mine: np.ndarray, other: np.ndarray, best: float, least: float, confidence: float) -> Iterator[tuple[tuple, float, int]]:
    """(items, confidence, pages of the label) of ``items`` and what grows from it, if surer than ``best``, the smaller sets' on the way.

    Rows are the pages with ``items`` (equal ones once): how many have the label, how many the other, and as (token, row)
    the tokens that may be added. A set with a token that all its pages of the other label hold is no surer than the set
    without, whatever else is added to both.
    """
    n, against = int(mine.sum()), int(other.sum())
    if n < least:
        return
    sure = n / (n + against)
    if sure >= confidence and sure > best:
        yield items, sure, n
        best = sure
    if not against or not len(token):
        return
    use = (np.bincount(token, other[row]) < against) & (np.bincount(token, mine[row]) >= least)
    keep = use[token]
    token, row, use = token[keep], row[keep], np.flatnonzero(use)
    always = int(other[np.bincount(row, minlength=len(other)) == len(use)].sum())  # no token excludes these pages
    most = n / (n + always)
    if most < confidence or most <= best:
        return
    for t in use.tolist():
        has = np.zeros(len(other), bool)
        has[row[token == t]] = True
        pick = has[row] & (token < t)
        yield from grow((t, *items), token[pick], (np.cumsum(has) - 1)[row[pick]], mine[has], other[has], best, least, confidence)


def pruned(rules: DataFrame) -> DataFrame:
    """Rules (items, rarest, verdict, confidence, n) without those that a more general one makes redundant: one of fewer
    tokens with the same verdict and at least the same confidence fits wherever they fit, so no verdict changes. Rules meet
    under the more general one's rarest token."""
    rules = rules.withColumn("id", F.concat_ws("\n", "items"))
    special = rules.where(F.size("items") > 1).select("id", "items", "verdict", "confidence", F.explode("items").alias("rarest"))
    general = rules.select("rarest", "verdict", F.col("items").alias("fewer"), F.col("confidence").alias("least"))
    within = (F.size("fewer") < F.size("items")) & (F.col("least") >= F.col("confidence")) & (F.size(F.array_except("fewer", "items")) == 0)
    redundant = special.join(general, ["rarest", "verdict"]).where(within).select("id", "verdict").distinct()
    return rules.join(redundant, ["id", "verdict"], "left_anti").select("items", "verdict", "confidence", "n")


def inverted(rules: list[Rule]) -> dict[str, list[tuple[int, frozenset, str]]]:
    """Rules by their rarest token among the rules."""
    seen = Counter(t for r in rules for t in r[0])
    index: dict = {}
    for rank, (items, verdict, _, _) in enumerate(rules):
        index.setdefault(min(items, key=lambda t: (seen[t], t)), []).append((rank, frozenset(items), verdict))
    return index


def match(index: dict, items: list[str]) -> str | None:
    have = set(items)
    hits = [(rank, verdict) for t in items for rank, need, verdict in index.get(t, ()) if need <= have]
    return min(hits)[1] if hits else None


def judge(pages: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """Host, path, explicit rule and verdict of each page."""
    rules, strength = mine(pages, url)
    index = inverted(rules)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for u in batch.column(1).to_pylist():
                host, path = split_url(u)
                hit = explicit(host, path)
                rows.append((host, path, *(hit or (None, match(index, telling(tokens(u, host, path), strength)) or default))))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.string()) for c in (zip(*rows) if rows else [()] * 4))], names=["key", "host", "path", "rule", "verdict"])

    slim = pages.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"))
    return slim.mapInArrow(run, "key long, host string, path string, rule string, verdict string").withColumnRenamed("key", key)
