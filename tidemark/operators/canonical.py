"""One observation out of many: precedence, duplicates, batch merges and comparison of feeds. Nothing is deleted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import LIMITS, Limits
from ..functions.scalars import half_up, minute_bucket, precedence_of


def best_of(rows: DataFrame, keys: list[str], rank: Column) -> DataFrame:
    """The row with the highest ``rank`` for each key; an aggregate, so rows of a key combine before the shuffle."""
    cols = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*cols), rank).alias("_b")).select(*keys, *(F.col(f"_b.{c}").alias(c) for c in cols))


def canonical(quotes: DataFrame, order: tuple[str, ...] = LIMITS.sources) -> DataFrame:
    """One observation for each symbol and minute: the most trusted source's, then the latest."""
    q = quotes.withColumns({"minute": minute_bucket(F.col("created_at")), "source_precedence": precedence_of(F.col("ingest_source"), order)})
    return best_of(q, ["symbol", "minute"], F.struct("source_precedence", "created_at", "id"))


def disagreements(quotes: DataFrame, newest: int | None = None) -> DataFrame:
    """Pairs of observations of one symbol and minute by different sources whose prices differ, newest first if capped."""
    q = quotes.select("symbol", minute_bucket(F.col("created_at")).alias("minute"), "ingest_source", "last_price", "id")
    side = lambda x: q.select("symbol", "minute", F.col("ingest_source").alias(f"source_{x}"), F.col("last_price").alias(f"price_{x}"), F.col("id").alias(f"id_{x}"))
    out = side("a").join(side("b"), ["symbol", "minute"]).where((F.col("source_a") < F.col("source_b")) & ~F.col("price_a").eqNullSafe(F.col("price_b")))
    return out if newest is None else out.orderBy(F.desc("minute"), "symbol", "id_a", "id_b").limit(newest)


def richest(rows: DataFrame, keys: list[str], data: tuple[str, ...]) -> DataFrame:
    """Of duplicates on ``keys`` the most complete, then the highest volume, then id; and whether they were all alike."""
    full = sum((F.col(c).isNotNull() & (F.col(c).cast("string") != "")).cast("int") for c in data)
    prints = F.xxhash64(*(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in data))
    cols = [c for c in rows.columns if c not in keys]
    g = rows.withColumn("_print", prints).groupBy(*keys).agg(
        F.max_by(F.struct(*cols), F.struct(full, F.coalesce("volume", F.lit(-1)), F.coalesce("id", F.lit(0)))).alias("_b"), F.count("*").alias("copies"), (F.min("_print") != F.max("_print")).alias("_differ")
    )
    kind = F.when(F.col("copies") == 1, "single").when(F.col("_differ"), "conflicting").otherwise("identical")
    return g.select(*keys, *(F.col(f"_b.{c}").alias(c) for c in cols), "copies", kind.alias("kind"))


def census(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, and rows beyond the first."""
    return rows.groupBy(*keys).count().where("count > 1").agg(F.count("*").alias("groups"), F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("extra"))


def collisions(quotes: DataFrame) -> DataFrame:
    """Symbols recorded more than once at an instant, and the markets involved."""
    twice = quotes.groupBy("symbol", "created_at").agg(F.count("*").alias("n"), F.collect_set("market").alias("m")).where("n > 1")
    return twice.groupBy("symbol").agg(F.sum("n").alias("rows_involved"), F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("m")))), " | ").alias("markets"))


def label_votes(quotes: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Each symbol with several market labels: the commonest, its share, and whether that decides."""
    n = quotes.where("market is not null").groupBy("symbol", "market").agg(F.count("*").alias("n"))
    g = n.groupBy("symbol").agg(F.count("*").alias("labels"), F.sum("n").alias("total"), F.max_by("market", F.struct("n", "market")).alias("keep"), F.max("n").alias("top")).where("labels > 1")
    share = F.col("top") / F.col("total")
    return g.select("symbol", "keep", (F.col("total") - F.col("top")).alias("minority"), half_up(share).alias("share"), (share >= limits.label_confidence).alias("decided"))


def drop_minority(quotes: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Captures without the outvoted labels of decided symbols."""
    keep = label_votes(quotes, limits).where("decided").select("symbol", "keep")
    return quotes.join(keep, "symbol", "left").where("keep is null or market = keep").select(*quotes.columns)


def first_of_batch(batch: DataFrame, keys: list[str], order: str) -> DataFrame:
    return best_of(batch, keys, -F.col(order))


def insert_ignore(existing: DataFrame, batch: DataFrame, keys: list[str], order: str) -> DataFrame:
    """What a batch adds: the first of each key in it, unless the key is there already."""
    return first_of_batch(batch, keys, order).join(existing.select(*keys), keys, "left_anti")


def upsert(existing: DataFrame, batch: DataFrame, keys: list[str], order: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The table after a batch: the last of each key wins, but columns in ``keep`` never lose a value to a null."""
    cols = [c for c in existing.columns if c not in keys]
    both = existing.withColumns({"_new": F.lit(0), "_at": F.lit(0).cast("long")}).unionByName(batch.select(*keys, *cols, F.lit(1).alias("_new"), F.col(order).cast("long").alias("_at")))
    rank = F.struct("_new", "_at")
    return both.groupBy(*keys).agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), rank)).alias(c) if c in keep else F.max_by(F.struct(c), rank).getField(c).alias(c) for c in cols))


def route(quotes: DataFrame, own: tuple[str, ...] = LIMITS.sources) -> tuple[DataFrame, DataFrame]:
    """Captures of the exchange's own feed with their precedence, and those of any other."""
    mine = F.col("ingest_source").isin(*own)
    return quotes.where(mine).withColumn("source_precedence", precedence_of(F.col("ingest_source"), own)), quotes.where(F.coalesce(~mine, F.lit(True)))


def merge_extremes(a: DataFrame, b: DataFrame, keys: list[str], high: tuple[str, ...], low: tuple[str, ...], first: tuple[str, ...]) -> DataFrame:
    """Two copies of a table in one: greatest, least and first known values by column."""
    both = a.withColumn("_side", F.lit(0)).unionByName(b.withColumn("_side", F.lit(1)))
    return both.groupBy(*keys).agg(*(F.max(c).alias(c) for c in high), *(F.min(c).alias(c) for c in low), *(F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_side"))).alias(c) for c in first))


def coverage(captured: DataFrame, reference: DataFrame) -> DataFrame:
    """For each captured session: symbols expected, matched, missing and extra against the reference feed of that day,
    or of the last day before that has one; unchecked where there is none."""
    cap, ref = captured.select("symbol", "trading_date").distinct(), reference.select("symbol", "trading_date").distinct()
    days = cap.select("trading_date").distinct().withColumn("_side", F.lit(1)).unionByName(ref.select("trading_date").distinct().withColumn("_side", F.lit(0)))
    back = Window.orderBy("trading_date", "_side").rowsBetween(Window.unboundedPreceding, 0)  # two rows a session at most
    days = days.withColumn("reference_day", F.last(F.when(F.col("_side") == 0, F.col("trading_date")), ignorenulls=True).over(back)).where("_side = 1").drop("_side")
    want = days.join(ref.withColumnRenamed("trading_date", "reference_day"), "reference_day").select("trading_date", "symbol", F.lit(1).alias("wanted"))
    both = want.join(cap.withColumn("seen", F.lit(1)), ["trading_date", "symbol"], "full")
    n = both.groupBy("trading_date").agg(F.count("wanted").alias("expected"), F.count("seen").alias("captured"), F.count_if(F.col("wanted").isNotNull() & F.col("seen").isNotNull()).alias("matched"))
    out = days.join(n, "trading_date")
    checked = F.col("reference_day").isNotNull()
    return out.select(
        "trading_date",
        "reference_day",
        checked.alias("checked"),
        "expected",
        "captured",
        "matched",
        (F.col("expected") - F.col("matched")).alias("missing"),
        F.when(checked, F.col("captured") - F.col("matched")).alias("extra"),
        F.when(F.col("expected") > 0, half_up(F.col("matched") / F.col("expected") * 100.0, 1)).alias("coverage_pct"),
    )


def feed_differences(a: DataFrame, b: DataFrame, keys: list[str], fields: tuple[str, ...]) -> DataFrame:
    """Rows only in one of two feeds, and for each field how many matched rows differ."""
    left, right = a.select(*keys, F.struct(*fields).alias("a")), b.select(*keys, F.struct(*fields).alias("b"))
    both = left.join(right, keys, "full")
    hit = F.col("a").isNotNull() & F.col("b").isNotNull()
    return both.agg(
        F.count_if(F.col("b").isNull()).alias("only_a"),
        F.count_if(F.col("a").isNull()).alias("only_b"),
        F.count_if(hit).alias("matched"),
        *(F.count_if(hit & ~F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}"))).alias(f"{f}_differs") for f in fields),
    )
