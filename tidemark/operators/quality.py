"""Reports on the data itself: integrity, freshness, gaps, runs and column coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import LIMITS, Limits

KEEP_MARKETS = ("Premier Market", "Main Market", "Auction Market")


def integrity(quotes: DataFrame, instruments: DataFrame, orders: DataFrame, keep: tuple[str, ...] = KEEP_MARKETS) -> DataFrame:
    """One row for each check: its level and how many rows fail it. A check that finds nothing has 0."""
    twice = quotes.groupBy("symbol", "created_at").count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("n"))
    one = quotes.agg(F.count_if(F.col("market").rlike("^[A-Za-z]$")).alias("raw"), F.count_if(~F.col("market").isin(*keep)).alias("unwanted"))
    checks = (
        twice.select(F.lit("collisions").alias("finding"), F.lit("error").alias("level"), F.col("n").cast("long").alias("n")),
        one.select(F.lit("raw_market_code"), F.lit("error"), "raw"),
        one.select(F.lit("unwanted_market"), F.lit("warn"), "unwanted"),
        instruments.agg((F.count("*") == 0).cast("long").alias("n")).select(F.lit("empty_registry"), F.lit("error"), "n"),
        orders.agg((F.count("*") - F.count("order_status")).alias("n")).select(F.lit("orders_without_status"), F.lit("warn"), "n"),
    )
    out = checks[0]
    for c in checks[1:]:
        out = out.union(c)
    return out


def freshness(depth: DataFrame, now: str, limits: Limits = LIMITS) -> DataFrame:
    """The last book of each symbol, its age at ``now`` and OK, LATE or BREACH."""
    g = depth.groupBy("symbol").agg(F.max("created_at").alias("last_seen"), F.countDistinct("created_at").alias("captures"))
    at = F.lit(now).cast("timestamp_ntz")
    age = F.timestamp_diff("SECOND", F.col("last_seen"), at)
    return g.select("*", age.alias("age_secs"), F.when(age <= limits.fresh_secs, "OK").when(age <= limits.gap_secs, "LATE").otherwise("BREACH").alias("status"))


def gaps(depth: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Pauses between captures of a symbol in a session longer than allowed."""
    seen = depth.select("symbol", "trading_date", "created_at").distinct()
    w = Window.partitionBy("symbol", "trading_date").orderBy("created_at")
    s = seen.withColumn("gap_from", F.lag("created_at").over(w))
    gap = F.timestamp_diff("SECOND", F.col("gap_from"), F.col("created_at"))
    return s.select("symbol", "trading_date", "gap_from", F.col("created_at").alias("gap_to"), gap.alias("gap_secs")).where(F.col("gap_secs") > limits.gap_secs)


def column_coverage(df: DataFrame) -> DataFrame:
    """(column, filled, rows): how much of each column is there; 0 filled means that nothing writes it."""
    one = df.agg(F.count("*").alias("rows"), *(F.count(c).alias(c) for c in df.columns))
    return one.unpivot(["rows"], list(df.columns), "column", "filled").select("column", "filled", "rows")


def missing_columns(df: DataFrame, needed: tuple[str, ...]) -> list[str]:
    return sorted(set(needed) - set(df.columns))


def price_coverage(rows: DataFrame, price: str = "last_price", limits: Limits = LIMITS) -> DataFrame:
    """Share of rows with a price, and whether the batch may be stored."""
    share = F.count(price) / F.count("*")
    return rows.agg(F.count("*").alias("rows"), F.count(price).alias("priced"), F.coalesce(share >= limits.min_coverage, F.lit(False)).alias("accepted"))


def unique_order(df: DataFrame, keys: list[str]) -> bool:
    """Whether ``keys`` tell all rows apart, as paging by them needs."""
    return df.groupBy(*keys).count().where("count > 1").isEmpty()


def feed_of(markets: list[str]) -> str:
    """broker or watchlist by a table's market names; raises if they say neither or both."""
    broker = [m for m in markets if any(x in (m or "").lower() for x in ("premier", "main", "auction"))]
    other = [m for m in markets if m and m not in broker]
    if bool(broker) == bool(other):
        raise ValueError(f"can't tell the feed from markets {sorted(set(markets), key=str)}")
    return "broker" if broker else "watchlist"


def feeds(rows: DataFrame, table: str, market: str = "market") -> DataFrame:
    """Which feed each table is by its market names: broker, watchlist, or unclear if they say both or neither."""
    known = F.lower(market).rlike("premier|main|auction")
    n = rows.groupBy(table).agg(F.count_if(known).alias("broker_rows"), F.count_if(~known).alias("other_rows"))
    broker, other = F.col("broker_rows") > 0, F.col("other_rows") > 0
    return n.select(table, F.when(broker & ~other, "broker").when(other & ~broker, "watchlist").otherwise("unclear").alias("feed"), "broker_rows", "other_rows")


def preflight(df: DataFrame, needed: dict[str, str], key: list[str]) -> DataFrame:
    """One row for each wanted column, with the type it should have and has, and one for the key: keys that repeat."""
    types = dict(df.dtypes)
    columns = df.sparkSession.createDataFrame([(c, t, types.get(c, "missing"), types.get(c) == t) for c, t in needed.items()], "item string, expected string, found string, ok boolean")
    twice = df.groupBy(*key).count().where("count > 1").agg(F.count("*").alias("n"))
    return columns.unionByName(twice.select(F.lit("key " + ", ".join(key)).alias("item"), F.lit("0").alias("expected"), F.col("n").cast("string").alias("found"), (F.col("n") == 0).alias("ok")))


def catalogue(spark: SparkSession, tables: list[str] | None = None) -> DataFrame:
    """(table, position, column, type, nullable) of the session's tables and views: what its catalogue says, no rows read."""
    names = [t.name for t in spark.catalog.listTables()] if tables is None else [t for t in tables if spark.catalog.tableExists(t)]
    rows = [(t, k, c.name, c.dataType, c.nullable) for t in sorted(names) for k, c in enumerate(spark.catalog.listColumns(t))]
    return spark.createDataFrame(rows, "table string, position int, column string, type string, nullable boolean")


def schema_report(spark: SparkSession, needed: dict[str, dict[str, str]]) -> DataFrame:
    """What is wrong or right with tables of the catalogue: a row for each needed column, ``type`` or ``type not null``.

    Found is the catalogue's type, or that table or column is missing; nulls are counted where none may be, in one pass
    over each such table.
    """
    known = {(r.table, r.column): r.type for r in catalogue(spark, list(needed)).collect()}
    tables = {t for t, _ in known}
    rows, counts = [], None
    for table, columns in needed.items():
        strict = [c for c, kind in columns.items() if kind.endswith(" not null") and (table, c) in known]
        for c, kind in columns.items():
            rows.append((table, c, kind.removesuffix(" not null"), known.get((table, c), "missing" if table in tables else "missing table"), c in strict))
        if strict:
            one = spark.table(table).agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in strict)).unpivot([], strict, "column", "nulls").withColumn("table", F.lit(table))
            counts = one if counts is None else counts.unionByName(one)
    report = spark.createDataFrame(rows, "table string, column string, expected string, found string, strict boolean")
    report = report.withColumn("nulls", F.lit(None).cast("long")) if counts is None else report.join(counts, ["table", "column"], "left")
    ok = (F.col("expected") == F.col("found")) & (F.coalesce("nulls", F.lit(0)) == 0)
    return report.select("table", "column", "expected", "found", "nulls", ok.alias("ok"))


def latest_runs(runs: DataFrame) -> DataFrame:
    """The last run of each scraper."""
    cols = [c for c in runs.columns if c != "scraper"]
    return runs.groupBy("scraper").agg(F.max_by(F.struct(*cols), F.struct("started_at", "run_id")).alias("r")).select("scraper", *(F.col(f"r.{c}").alias(c) for c in cols))


def stuck_runs(runs: DataFrame, now: str, minutes: int = 10) -> DataFrame:
    return runs.where((F.col("status") == "RUNNING") & (F.timestamp_diff("MINUTE", F.col("started_at"), F.lit(now).cast("timestamp_ntz")) > minutes))
