"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions only.

Each source's documents stand in a shuffled line, up to three times over. A piece of the line ends at a cumulative
number of words; divided by the source's target this is the piece's virtual finish time. All pieces are ordered by that
time over all sources, and the order is cut where the words served reach the budget. Pieces are at most ``quantum``
words, so that a long document can't hold the line (None: whole documents).

Running totals never put a source into one task: lines are cut into buckets by the shuffle hash and the global order
into ranges of finish time; only sums of buckets and ranges, of bounded number, meet, and one range is sorted.

Defined results: null or empty texts have size 0 and are never taken; a null source is a source, the last; repeated
rows are separate documents; an empty table gives an empty result; other columns are ignored or, in :func:`mixed`, kept
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, field, with_rows, written

#: The weights dealt to the sources in order.
WEIGHTS = (5, 2, 1)
MOST = 3
QUANTUM = 256
RANGES = 4096


def lines(docs: DataFrame) -> DataFrame:
    """(row, key, src, size, spot, bucket) from (row, key, text, source), written, so that words are counted once.

    src sorts as the source with null last; spot is the document's place in the shuffle, bucket its first bits.
    """
    line = docs.select(
        "row",
        "key",
        F.when(F.col("source").isNull(), "1").otherwise(F.concat(F.lit("0"), F.col("source").cast("string"))).alias("src"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col("key").cast("string"), F.lit("")).cast("binary")).alias("spot"),
    )
    return written(line.withColumn("bucket", F.conv(F.substring("spot", 1, 3), 16, 10).cast("int")))


def targets(sizes: DataFrame) -> DataFrame:
    """(src, source_size, target) from (src, source_size): shares by weight, stopped at three times the size.

    Sources fill in the order of size over weight: one is full if the share left per weight, after all fuller ones
    took their stop, reaches its own stop. One row for each source, so these windows are small.
    """
    ordered = Window.orderBy("src")
    ws = F.array(*map(F.lit, WEIGHTS))
    s = sizes.withColumn("weight", F.get(ws, (F.row_number().over(ordered) - 1) % len(WEIGHTS)).cast("double"))
    every = Window.partitionBy()
    s = s.withColumn("all", F.sum("source_size").over(every)).withColumn("weights", F.sum("weight").over(every))
    s = s.withColumn("stop", MOST * F.col("source_size"))
    before = Window.orderBy(F.col("stop") / F.col("weight"), "src").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("all") - F.coalesce(F.sum("stop").over(before), F.lit(0))
    share = left / (F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    s = s.withColumn("full", F.col("stop") / F.col("weight") <= share)
    s = s.withColumn("left", F.col("all") - F.sum(F.when(F.col("full"), F.col("stop")).otherwise(0)).over(every))
    s = s.withColumn("open", F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(every))
    target = F.when(F.col("full"), F.col("stop").cast("double")).otherwise(F.col("weight") * (F.col("left") / F.col("open")))
    return s.select("src", "source_size", target.alias("target"))


def _served(line: DataFrame, quantum: int | None) -> tuple[DataFrame, DataFrame]:
    """The line with each document's target columns, and the pieces with ``got``, the words taken of each."""
    sums = line.groupBy("src", "bucket").agg(F.sum("size").alias("words"))
    wanted = targets(sums.groupBy("src").agg(F.sum("words").alias("source_size")))
    ahead = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("ahead", F.coalesce(F.sum("words").over(ahead), F.lit(0))).drop("words").join(wanted, "src")
    order = Window.partitionBy("src", "bucket").orderBy("spot", "key", "size", "row")
    within = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = line.join(offsets, ["src", "bucket"]).withColumn("ahead", F.col("ahead") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = written(placed.withColumn("nth", F.row_number().over(order)))
    rounds = F.least(F.lit(MOST), F.floor(F.col("target") / F.col("source_size") + 0.5).cast("int") + 1)
    step = F.lit(quantum) if quantum else F.greatest("size", F.lit(1))
    pieces = (
        placed.where(F.col("size") > 0)
        .withColumn("round", F.explode(F.sequence(F.lit(0), rounds - 1)))
        .withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, step.cast("long"))))
        .withColumn("length", F.least(step, F.col("size") - F.col("from")))
        .withColumn("finish", (F.col("round") * F.col("source_size") + F.col("ahead") + F.col("from") + F.col("length")) / F.col("target"))
        .withColumn("range", F.floor(F.col("finish") * RANGES))
    )
    budget = placed.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("budget"))
    upto = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = pieces.groupBy("range").agg(F.sum("length").alias("words")).withColumn("served", F.coalesce(F.sum("words").over(upto), F.lit(0)))
    ranges = ranges.join(F.broadcast(budget), F.lit(True)).where(F.col("served") < F.col("budget"))  # one row
    ranges = ranges.select("range", "served", "budget", (F.col("served") + F.col("words") > F.col("budget")).alias("cut"))
    kept = pieces.join(ranges, "range")
    order = Window.partitionBy("range").orderBy("finish", "src", "spot", "key", "nth", "from").rowsBetween(Window.unboundedPreceding, -1)
    whole = kept.where(~F.col("cut")).withColumn("got", F.col("length"))
    last = kept.where("cut").withColumn("at", F.col("served") + F.coalesce(F.sum("length").over(order), F.lit(0)))
    room = F.col("budget") - F.col("at")
    last = last.where(room > 0).withColumn("got", F.least("length", room) if quantum else F.col("length")).drop("at")
    return placed, whole.unionByName(last)


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", quantum: int | None = QUANTUM) -> DataFrame:
    """What the mix takes of each document: size, source_size, target, taken."""
    slim = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(text).alias("text"), F.col(source).alias("source"))
    placed, pieces = _served(lines(slim), quantum)
    on = ["src", "bucket", "nth"]
    taken = pieces.groupBy(*on).agg(F.sum("got").alias("taken"))
    out = placed.join(taken, on, "left")
    return out.select(F.col("key").cast("long").alias(key), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself, in whole documents: a row of ``docs`` for each time that it is taken."""
    kept = written(with_rows(docs))
    _, pieces = _served(lines(kept.select("row", field(key).alias("key"), field(text).alias("text"), field(source).alias("source"))), None)
    times = pieces.groupBy("row").agg(F.count("*").cast("int").alias("times"))
    return kept.join(times, "row").withColumn("turn", F.explode(F.sequence(F.lit(1), F.col("times")))).select("doc.*")
