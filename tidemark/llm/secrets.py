"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Candidates come from patterns. A candidate's hash is then counted over the whole corpus: in how many distinct
repositories (documents) and under how many distinct owners (sources) does it stand? A string that many owners share, or
that stands in many repositories, is a copied example; one that few hold looks like a live credential. Every span gets
that verdict. Base patterns always count as spans; the looser ``blob`` pattern counts only where the verdict is "live".

Defined results: a null text is empty and holds nothing; a null source is an owner of its own; repeated rows are each
reported, and count as one repository; an empty table gives an empty result; other columns are ignored or, in
:func:`redact`, kept whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import field, join_by_key, with_rows, written

#: The base patterns.
ASSIGN = r"""(?i)(?:password|passwd|secret|token|api_?key)(?-i)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
#: Added by the method where ownership is narrow: long runs that mix digits with letters of both cases.
BLOB = r"[A-Za-z0-9+/_-]{20,}"
MIN_VALUE = 12
#: A string under more owners, or in more repositories, than this is a copied example.
MAX_OWNERS, MAX_REPOSITORIES = 4, 100
CHUNK = 256
KINDS = ("assign", "access", "hex", "blob")


#: One span as it is kept.
SPAN = "struct<start:int,kind:int,end:int,value:string>"


def _before(values: Column, start: int, step: Callable[[Column, Column], Column]) -> Column:
    """What ``step`` makes of all values before each one, in chunks, so that long arrays don't cost the square of their length."""
    run = lambda xs: F.aggregate(xs, F.struct(F.lit(start).alias("at"), F.array().cast("array<int>").alias("out")), lambda s, x: F.struct(step(s["at"], x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")), lambda s: s["out"])
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / CHUNK).cast("int")), lambda c: F.slice(values, c * CHUNK + 1, CHUNK))
    bases = run(F.transform(chunks, lambda xs: F.aggregate(xs, F.lit(start), step)))
    return F.flatten(F.zip_with(chunks, bases, lambda c, b: F.transform(run(c), lambda x: step(b, x))))


def spans(text: Column, kind: str, pattern: str, group: int | None = None) -> Column:
    """Leftmost matches of ``pattern`` as (start, kind, end, value), in code points.

    Gaps between matches and the matches alternate, so running sums of their lengths give the positions. ``value`` is
    the match or its ``group``.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = found if group is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.transform(F.slice(F.split(text, pattern, -1), 1, F.size(found)), F.char_length)
    ends = F.zip_with(gaps, found, lambda g, m: g + F.char_length(m))
    starts = F.zip_with(_before(ends, 0, lambda s, x: s + x), gaps, lambda s, g: s + g)
    made = F.transform(
        F.arrays_zip(starts.alias("s"), found.alias("m"), value.alias("v")),
        lambda x: F.struct(x["s"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (x["s"] + F.char_length(x["m"])).alias("end"), x["v"].alias("value")),
    )
    return F.when(text.rlike(pattern), made).otherwise(F.array().cast(f"array<{SPAN}>"))


def _apart(blobs: Column, base: Column) -> Column:
    """The blobs that overlap no base span: going by position, none begun before a blob's end ends behind its start."""
    none = F.lit(None).cast(SPAN)
    events = F.sort_array(
        F.concat(
            F.transform(blobs, lambda x: F.struct(x["end"].alias("at"), F.lit(0).alias("order"), F.lit(-1).alias("reach"), x.alias("span"))),
            F.transform(base, lambda x: F.struct(x["start"].alias("at"), F.lit(1).alias("order"), x["end"].alias("reach"), none.alias("span"))),
        )
    )
    reach = _before(F.transform(events, lambda e: e["reach"]), -1, lambda a, b: F.greatest(a, b))
    free = F.filter(F.zip_with(events, reach, lambda e, r: F.when(r <= e["span"]["start"], e["span"])), lambda x: x.isNotNull())
    return F.when((F.size(blobs) > 0) & (F.size(base) > 0), free).otherwise(blobs)


def found(docs: DataFrame, *more: str) -> DataFrame:
    """(row, key, owner, base, blob and ``more``) from (row, key, owner, text): base spans in order, and blob candidates."""
    t = F.coalesce(F.col("text"), F.lit(""))
    got = docs.select(
        "row",
        "key",
        "owner",
        *more,
        F.filter(spans(t, "assign", ASSIGN, 1), lambda x: F.char_length(x["value"]) >= MIN_VALUE).alias("assign"),
        spans(t, "access", ACCESS).alias("access"),
        spans(t, "hex", HEX).alias("hex"),
        F.filter(spans(t, "blob", BLOB), lambda x: x["value"].rlike("[0-9]") & x["value"].rlike("[a-z]") & x["value"].rlike("[A-Z]")).alias("blob"),
    )
    got = got.withColumn("base", F.sort_array(F.concat("assign", "access", "hex")))
    return got.select("row", "key", "owner", *more, "base", _apart(F.col("blob"), F.col("base")).alias("blob"))


def ownership(each: DataFrame) -> DataFrame:
    """(hash, owners, repositories, n) of every candidate (hash, owner, repo), counted in steps so that no value meets in one task."""
    repos = each.groupBy("hash", "owner", "repo").agg(F.count("*").alias("n"))
    owners = repos.groupBy("hash", "owner").agg(F.count("*").alias("repositories"), F.sum("n").alias("n"))
    return owners.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"), F.sum("n").alias("n"))


def verdicts(rows: DataFrame, max_owners: int, max_repositories: int) -> DataFrame:
    """(row, every): all candidate spans of each row that has any, in order, as (start, kind, end, live)."""
    each = rows.select("row", "owner", F.coalesce(F.col("key").cast("string"), F.lit("")).alias("repo"), F.explode(F.concat("base", "blob")).alias("x"))
    each = each.withColumn("hash", F.xxhash64("x.value"))
    live = (F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)
    counted = written(ownership(each).select("hash", "n", live.alias("live")))
    judged = join_by_key(each.select("row", "hash", "x.start", "x.kind", "x.end"), counted, "hash", "n")
    return judged.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end", "live"))).alias("every"))


def _text(spans_of: Column) -> Column:
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans_of, lambda x: F.concat_ws(":", F.get(name, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def _counts(x: Column) -> Column:
    """Whether a judged span is one of the scan's."""
    return (x["kind"] < 3) | x["live"]


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source", max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """Counts, a digest of the base spans, all spans, and how many spans look live or copied, for each document."""
    slim = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(owner).cast("string").alias("owner"), F.col(text).alias("text"))
    rows = written(found(slim))
    every = F.coalesce("every", F.array().cast("array<struct<start:int,kind:int,end:int,live:boolean>>"))
    many = lambda test: F.size(F.filter(every, test)).cast("long")
    return rows.join(verdicts(rows, max_owners, max_repositories), "row", "left").select(
        F.col("key").cast("long").alias(key),
        many(lambda x: x["kind"] == 0).alias("n_assign"),
        many(lambda x: x["kind"] == 1).alias("n_access"),
        many(lambda x: x["kind"] == 2).alias("n_hex"),
        F.sha2(_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _text(F.filter(every, _counts)).alias("spans"),
        many(lambda x: x["live"]).alias("n_live"),
        many(lambda x: ~x["live"] & (x["kind"] < 3)).alias("n_copied"),
    )


def _replaced(text: Column, spans_of: Column, mark: str) -> Column:
    """The text with each stretch that spans cover, overlapping or touching ones as one, replaced by ``mark``."""
    order = F.sort_array(F.transform(spans_of, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))))
    reach = _before(F.transform(order, lambda x: x["end"]), -1, lambda a, b: F.greatest(a, b))
    past = lambda b: F.greatest(b, F.lit(0))
    parts = F.zip_with(order, reach, lambda x, b: F.when(x["start"] > b, F.concat(F.substring(text, past(b) + 1, x["start"] - past(b)), F.lit(mark))).otherwise(""))
    last = F.array_max(F.transform(spans_of, lambda x: x["end"]))
    return F.when(F.size(spans_of) > 0, F.concat(F.array_join(parts, ""), F.substring(text, last + 1, F.char_length(text)))).otherwise(text)


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source", max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every span of :func:`scan` replaced by ``mark``; all rows and columns stay.

    Only documents with blob candidates, for which the corpus decides, take part in a join.
    """
    rows = with_rows(docs).select("row", field(key).alias("key"), field(owner).cast("string").alias("owner"), field(text).alias("text"), "doc")
    rows = written(found(rows, "doc"))
    pair = lambda xs: F.transform(xs, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    clean = rows.where(F.size("blob") == 0).select("doc", pair(F.col("base")).alias("spans"))
    loose = rows.where(F.size("blob") > 0).join(verdicts(rows.drop("doc"), max_owners, max_repositories), "row", "left")
    loose = loose.select("doc", pair(F.filter("every", _counts)).alias("spans"))
    done = clean.unionByName(loose).select(F.col("doc").withField(text, _replaced(field(text), F.col("spans"), mark)).alias("doc"))
    return done.select("doc.*")
