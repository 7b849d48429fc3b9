"""Writing stored tables: days replaced, batches appended or merged once, and what each write did kept in a table.

Writes touch the partitions that they have rows for and no other. Whatever may be retried writes under a name of its own
and overwrites only that, so a second try leaves what the first would have left.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..operators import canonical
from ..operators.canonical import insert_ignore
from . import folders


def replace_days(df: DataFrame, path: str, by: str = "trading_date") -> None:
    """Overwrite only the partitions that ``df`` has rows for; one with much becomes several files, of a task each."""
    df.hint("rebalance", F.col(by)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = folders.file_system(spark, path)
    return fs.exists(at)


def append_new(df: DataFrame, path: str, keys: list[str], order: str, by: str = "trading_date") -> None:
    """Append the rows whose key isn't there yet; only the days of the batch are looked at."""
    spark = df.sparkSession
    if exists(spark, path):
        days = df.select(by).distinct()
        df = insert_ignore(spark.read.parquet(path).join(days, by, "left_semi"), df, keys, order)
    else:
        df = insert_ignore(df.limit(0), df, keys, order)
    df.write.mode("append").partitionBy(by).parquet(path)


# Merging a batch into a stored table

#: What becomes of a stored value when a row with its key comes: ``rises(x)`` counts how often x has risen.
RULES = ("last", "known", "first", "greatest", "least", "count")


def merged(stored: DataFrame, batch: DataFrame, keys: list[str], rules: dict[str, str]) -> DataFrame:
    """The stored rows after a batch with one row a key, column by column.

    ``last``: the new value, even a null; ``known``: the new value unless it is null; ``first``: as it was when the key
    came; ``greatest`` and ``least`` of known ones; ``count``: rows of the key so far; ``rises x``: one more than the times
    that x was above its stored value.
    """
    plain = [c for c, r in rules.items() if r in RULES and r != "count"]
    old = stored.select(*keys, F.struct(*rules).alias("old"))
    new = batch.select(*keys, F.struct(*(F.col(c) for c in plain), F.lit(1).alias("_one")).alias("new"))
    both = old.join(new, keys, "full")
    had, came = F.col("old").isNotNull(), F.col("new").isNotNull()

    def value(c: str, rule: str) -> Column:
        o, n = F.col(f"old.`{c}`"), F.col(f"new.`{c}`") if c in plain else None
        if rule == "last":
            return F.when(came, n).otherwise(o)
        if rule == "known":
            return F.coalesce(n, o)
        if rule == "first":
            return F.when(had, o).otherwise(n)
        if rule == "count":
            return F.coalesce(o, F.lit(0).cast("long")) + came.cast("long")
        if rule in ("greatest", "least"):
            return getattr(F, rule)(o, n)
        x = rule.removeprefix("rises ")
        return F.coalesce(o, F.lit(1).cast("long")) + F.coalesce(F.col(f"new.`{x}`") > F.col(f"old.`{x}`"), F.lit(False)).cast("long")

    return both.select(*keys, *(value(c, r).alias(c) for c, r in rules.items()))


def merge(batch: DataFrame, path: str, keys: list[str], rules: dict[str, str], order: Column, by: str, of: Column, latest: bool = False) -> None:
    """Merge a batch into the table under ``path``, partitioned by ``by``, a value ``of`` the keys.

    Of the rows of one key in the batch the first by ``order`` counts (``latest``: the last). Only partitions with a key of
    the batch are read and rewritten; the files of all others stay as they are.
    """
    spark = batch.sparkSession
    rows = canonical.best_of(batch.withColumn("_order", order), keys, F.col("_order") if latest else -F.col("_order")).withColumn(by, of)
    first = rows.select(*keys, by, *(F.lit(1).cast("long").alias(c) if r == "count" or r.startswith("rises ") else F.col(c) for c, r in rules.items()))
    if exists(spark, path):
        stored = spark.read.schema(first.schema).parquet(path)
        touched = stored.join(rows.select(by).distinct(), by, "left_semi")
        first = merged(touched, rows, keys, rules).withColumn(by, of)
        staged = folders.shared(spark)  # read from the table before any of it is replaced
        first.write.parquet(staged)
        first = spark.read.schema(first.schema).parquet(staged)
        replace_days(first, path, by)
        folders.remove(spark, staged)
    else:
        replace_days(first, path, by)


# Batches that are pushed again

ANSWER = "batch_id string, offered long, inserted long, rejected long"


def submit(rows: DataFrame, path: str, ledger: str, name: str, keys: list[str], order: str, reason: str, batch: str = "batch_id") -> DataFrame:
    """Store pushed rows and answer for each batch in them: offered, inserted, rejected, and whether it was seen before.

    ``rows`` have a ``reason`` where they are rejected. A batch that an earlier submission stored adds nothing and gets the
    counts it got then. ``name`` tells submissions apart (a query's name and its batch number): the same one again
    replaces what it wrote and nothing else, so a retry after a failure, at whatever point, gives the same rows and counts.
    """
    spark = rows.sparkSession
    own = F.col("submission") == name

    def others(at: str, schema: str) -> DataFrame:
        if not exists(spark, at):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(at).where(~own)

    seen = others(ledger, f"{ANSWER}, submission string")
    fresh = rows.join(seen.select(F.col("batch_id").alias(batch)), batch, "left_anti")
    cols = [c for c in rows.columns if c != reason]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != reason)
    good = insert_ignore(others(path, f"{kinds}, submission string"), fresh.where(F.col(reason).isNull()).select(*cols), keys, order).select(*cols)
    good.withColumn("submission", F.lit(name)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("submission").parquet(path)
    stored = spark.read.schema(f"{kinds}, submission string").parquet(path).where(own)
    counts = fresh.groupBy(F.col(batch).alias("batch_id")).agg(F.count("*").alias("offered"), F.count(reason).alias("rejected"))
    counts = counts.join(stored.groupBy(F.col(batch).alias("batch_id")).agg(F.count("*").alias("inserted")), "batch_id", "left")
    counts = counts.select("batch_id", "offered", F.coalesce("inserted", F.lit(0)).cast("long").alias("inserted"), "rejected", F.lit(name).alias("submission"))
    counts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("submission").parquet(ledger)
    known = spark.read.schema(f"{ANSWER}, submission string").parquet(ledger)
    asked = rows.select(F.col(batch).alias("batch_id")).distinct()
    return known.join(asked, "batch_id").select("batch_id", "offered", "inserted", "rejected", (F.col("submission") != name).alias("duplicate"))


# What writes did

RUN = "run string, batch long, extracted long, rejected long, stored long, status string, seconds double"


def _counts(reason: str | None) -> list[Column]:
    return [F.count("*").alias("extracted"), (F.count(reason) if reason else F.lit(0).cast("long")).alias("rejected")]


def _status(extracted: int, rejected: int) -> str:
    return "SUCCESS" if not rejected else "FAILED" if rejected == extracted else "PARTIAL"


def _record(spark: SparkSession, log: str, runs: list[tuple]) -> None:
    if runs:
        spark.createDataFrame(runs, RUN).coalesce(1).write.mode("append").parquet(log)


def audited_write(df: DataFrame, path: str, log: str, run: str, reason: str | None = None, mode: str = "append") -> None:
    """Write the rows without a ``reason``, and a row in ``log`` with what that write itself extracted and rejected."""
    seen = Observation(run)
    began = time.time()
    rows = df.observe(seen, *_counts(reason))
    (rows.where(F.col(reason).isNull()).drop(reason) if reason else rows).write.mode(mode).parquet(path)
    extracted, rejected = seen.get["extracted"], seen.get["rejected"]
    _record(df.sparkSession, log, [(run, 0, extracted, rejected, extracted - rejected, _status(extracted, rejected), time.time() - began)])


class Audit(StreamingQueryListener):
    """Gathers what each batch of observed streams extracted and rejected: a row a batch, stored by :meth:`store`.

    ``with Audit(spark, log) as audit:`` listens to streams of ``audit.watch(...)`` and stores at its end.
    """

    def __init__(self, spark: SparkSession, log: str):
        self.spark, self.log = spark, log
        self.runs: list[tuple] = []
        self.names: set[str] = set()

    def watch(self, stream: DataFrame, run: str, reason: str | None = None) -> DataFrame:
        self.names.add(run)
        return stream.observe(run, *_counts(reason))

    def __enter__(self) -> Audit:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        self.spark.streams.removeListener(self)
        self.store()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        for run, counts in p.observedMetrics.items():
            if run in self.names and counts["extracted"]:
                e, r = counts["extracted"], counts["rejected"]
                self.runs.append((run, p.batchId, e, r, e - r, _status(e, r), p.batchDuration / 1000))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def store(self) -> None:
        runs, self.runs = self.runs, []
        _record(self.spark, self.log, runs)
