"""Canonical rows, duplicates, labels and comparison of feeds as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import canonical, quality
from ..sources import standins as s

DATA = ("last_price", "volume", "bid", "offer", "trades", "session")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures with a market label that is wrong now and then."""
    n, k = F.col("id"), F.substring("symbol", 2, 9).cast("int")
    market = F.when(n % 97 == 0, "B").when(n % 89 == 0, "OTC").when((n % (k + 5) == 0) & (k % 2 == 0), "Main Market").otherwise("Premier Market")
    return s.quotes(spark, sf_dir).withColumn("market", market)


LABELLED = """
labelled as (
 select *, case when id % 97 = 0 then 'B' when id % 89 = 0 then 'OTC'
  when id % (cast(substr(symbol, 2) as int) + 5) = 0 and cast(substr(symbol, 2) as int) % 2 = 0 then 'Main Market' else 'Premier Market' end as market from quotes)"""


def canonical_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.canonical(s.quotes(spark, sf_dir)).select("symbol", "minute", "id", "last_price", "volume", "ingest_source", "source_precedence", "created_at")


def source_disagreements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.disagreements(s.quotes(spark, sf_dir))


def newest_disagreements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.disagreements(s.quotes(spark, sf_dir), newest=200)


def resolved_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.richest(s.quotes(spark, sf_dir), ["symbol", "created_at"], DATA).select("symbol", "created_at", "id", "last_price", "volume", "copies", "kind")


def duplicate_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.census(s.quotes(spark, sf_dir), ["symbol", "created_at"])


def market_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.collisions(labelled(spark, sf_dir))


def market_label_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.label_votes(labelled(spark, sf_dir))


def captures_without_outvoted_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.drop_minority(labelled(spark, sf_dir)).groupBy("symbol", "market").agg(F.count("*").alias("n"))


def insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = s.quotes(spark, sf_dir).select("symbol", "created_at", "id", "last_price")
    return canonical.insert_ignore(q.where("id % 2 = 0"), q.where("id % 2 = 1"), ["symbol", "created_at"], "id")


def bar_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last capture of each odd id over the table of even ones; a known price is never blanked."""
    q = s.quotes(spark, sf_dir).select("symbol", "trading_date", "last_price", "volume", "id")
    old = canonical.best_of(q.where("id % 2 = 0"), ["symbol", "trading_date"], F.col("id"))
    return canonical.upsert(old, q.where("id % 2 = 1").withColumn("at", F.col("id")), ["symbol", "trading_date"], "at", keep=("last_price",))


def routed_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    own, other = canonical.route(s.quotes(spark, sf_dir).withColumn("ingest_source", F.when(F.col("id") % 6 == 0, "elsewhere").otherwise(F.col("ingest_source"))))
    a = own.groupBy("ingest_source", "source_precedence").agg(F.count("*").alias("n"))
    return a.unionByName(other.groupBy("ingest_source").agg(F.count("*").alias("n")).withColumn("source_precedence", F.lit(None).cast("int")))


def merged_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = s.quotes(spark, sf_dir).groupBy("symbol", "trading_date", (F.col("id") % 2).alias("side")).agg(F.max("volume").alias("volume"), F.min("created_at").alias("first_seen"), F.max_by("session", F.when(F.col("session").isNotNull(), F.col("id"))).alias("session"))
    part = lambda k: q.where(F.col("side") == k).drop("side")
    return canonical.merge_extremes(part(0), part(1), ["symbol", "trading_date"], ("volume",), ("first_seen",), ("session",))


def symbol_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two feeds that name some rows otherwise; the reference books some days under the day before."""
    q, w, n = s.quotes(spark, sf_dir), s.watchlist(spark, sf_dir), F.col("id")
    named = lambda keep, other: F.when(keep, F.col("symbol")).otherwise(F.concat(F.lit(other), "symbol"))
    day = F.when(F.dayofmonth("trading_date") % 4 == 1, F.date_sub("trading_date", 1)).otherwise(F.col("trading_date"))
    return canonical.coverage(q.withColumn("symbol", named(n % 9 < 2, "N")), w.withColumns({"symbol": named(n % 5 < 3, "M"), "trading_date": day}))


def feed_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = canonical.best_of(s.quotes(spark, sf_dir).select("symbol", "trading_date", "last_price", "volume", "id"), ["symbol", "trading_date"], F.col("id"))
    w = canonical.best_of(s.watchlist(spark, sf_dir).select("symbol", "trading_date", "last_price", "volume", "id"), ["symbol", "trading_date"], F.col("id"))
    return canonical.feed_differences(q, w, ["symbol", "trading_date"], ("last_price", "volume"))


def integrity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = s.sightings(spark, sf_dir).withColumn("order_status", F.when(F.col("seq") != 3, F.col("order_status")))
    return quality.integrity(labelled(spark, sf_dir), s.instruments(spark, sf_dir), orders)


NOW = "2024-01-30 13:00:30"


def depth_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.freshness(s.quotes(spark, sf_dir), NOW)


def depth_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.gaps(s.quotes(spark, sf_dir))


def column_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.column_coverage(s.quotes(spark, sf_dir))


def price_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.price_coverage(s.quotes(spark, sf_dir))


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scraper runs: one for each event, four scrapers."""
    e = s.read(spark, sf_dir, "events")
    return e.select(F.concat(F.lit("scraper"), (F.col("user_id") % 4).cast("string")).alias("scraper"), F.col("event_id").alias("run_id"), F.col("ts").alias("started_at"), F.when(F.col("event_type") == "error", "RUNNING").otherwise("SUCCESS").alias("status"))


RUNS = "runs as (select 'scraper' || cast(user_id % 4 as varchar) as scraper, event_id as run_id, ts as started_at, case when event_type = 'error' then 'RUNNING' else 'SUCCESS' end as status from events)"


def latest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.latest_runs(_runs(spark, sf_dir))


def stuck_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.stuck_runs(_runs(spark, sf_dir), NOW)


QUERIES = {
    f.__name__: f
    for f in (
        canonical_minutes, source_disagreements, newest_disagreements, resolved_duplicates, duplicate_census, market_collisions, market_label_votes, captures_without_outvoted_labels, insert_ignore, bar_upsert, routed_feeds, merged_copies,
        symbol_coverage, feed_differences, integrity_report, depth_freshness, depth_gaps, column_coverage, price_coverage, latest_runs, stuck_runs,
    )
}
PAIRS = """from quotes a join quotes b on a.symbol = b.symbol and date_trunc('minute', a.created_at) = date_trunc('minute', b.created_at) and a.ingest_source < b.ingest_source
 where a.last_price is distinct from b.last_price"""
PAIR_COLUMNS = "a.symbol, date_trunc('minute', a.created_at) as minute, a.ingest_source as source_a, a.last_price as price_a, a.id as id_a, b.ingest_source as source_b, b.last_price as price_b, b.id as id_b"
FULL = " + ".join(f"case when {c} is not null and cast({c} as varchar) <> '' then 1 else 0 end" for c in DATA)
PRINT = " || '|' || ".join(f"coalesce(cast({c} as varchar), '')" for c in DATA)
VOTES = """
votes as (
 select symbol, arg_max(market, (n, market)) as keep, cast(sum(n) - max(n) as bigint) as minority, floor(max(n) / sum(n) * 10000 + 0.5) / 10000 as share, max(n) / sum(n) >= 0.9 as decided
 from (select symbol, market, count(*) as n from labelled group by all) group by 1 having count(*) > 1)"""
COLUMNS = ("symbol", "trading_date", "created_at", "ingest_source", "session", "last_price", "last_qty", "bid", "offer", "bid_qty", "offer_qty", "volume", "trades", "id")
LAST = "select symbol, trading_date, arg_max(struct_pack(p := last_price, v := volume), id) as r from {} group by 1, 2"
ORACLES = {
    "canonical_minutes": s.with_tables(
        """select symbol, date_trunc('minute', created_at) as minute, id, last_price, volume, ingest_source, case ingest_source when 'client' then 2 else 1 end as source_precedence, created_at from quotes
 qualify row_number() over (partition by symbol, date_trunc('minute', created_at) order by case ingest_source when 'client' then 2 else 1 end desc, created_at desc, id desc) = 1""",
        "quotes",
    ),
    "source_disagreements": s.with_tables(f"select {PAIR_COLUMNS} {PAIRS}", "quotes"),
    "newest_disagreements": s.with_tables(f"select {PAIR_COLUMNS} {PAIRS} order by minute desc, a.symbol, a.id, b.id limit 200", "quotes"),
    "resolved_duplicates": s.with_tables(
        f"""select symbol, created_at, id, last_price, volume, copies, case when copies = 1 then 'single' when prints > 1 then 'conflicting' else 'identical' end as kind from (
 select *, count(*) over k as copies, row_number() over (partition by symbol, created_at order by {FULL} desc, coalesce(volume, -1) desc, id desc) as nth from quotes window k as (partition by symbol, created_at))
 join (select symbol, created_at, count(distinct {PRINT}) as prints from quotes group by 1, 2) using (symbol, created_at) where nth = 1""",
        "quotes",
    ),
    "duplicate_census": s.with_tables("select count(*) as groups, cast(coalesce(sum(n - 1), 0) as bigint) as extra from (select count(*) as n from quotes group by symbol, created_at having count(*) > 1)", "quotes"),
    "market_collisions": s.with_tables(
        "select symbol, count(*) as rows_involved, string_agg(distinct market, ' | ' order by market) as markets from labelled where (symbol, created_at) in (select (symbol, created_at) from labelled group by symbol, created_at having count(*) > 1) group by 1",
        "quotes",
        more=LABELLED,
    ),
    "market_label_votes": s.with_tables("select * from votes", "quotes", more=LABELLED + "," + VOTES),
    "captures_without_outvoted_labels": s.with_tables("select l.symbol, market, count(*) as n from labelled l left join votes v on v.symbol = l.symbol and v.decided where v.keep is null or market = v.keep group by 1, 2", "quotes", more=LABELLED + "," + VOTES),
    "insert_ignore": s.with_tables(
        """select symbol, created_at, min(id) as id, nullif(arg_min(coalesce(last_price, -1), id), -1) as last_price from quotes
 where id % 2 = 1 and (symbol, created_at) not in (select (symbol, created_at) from quotes where id % 2 = 0) group by 1, 2""",
        "quotes",
    ),
    "bar_upsert": s.with_tables(
        """select symbol, trading_date, coalesce(arg_max(last_price, id) filter (new and last_price is not null), max(last_price) filter (not new)) as last_price,
 (case when bool_or(new) then arg_max(struct_pack(v := volume), id) filter (new) else arg_max(struct_pack(v := volume), id) filter (not new) end).v as volume, coalesce(max(id) filter (new), max(id) filter (not new)) as id
 from (select symbol, trading_date, r.p as last_price, r.v as volume, id, false as new from (select symbol, trading_date, arg_max(struct_pack(p := last_price, v := volume), id) as r, max(id) as id from quotes where id % 2 = 0 group by 1, 2)
  union all select symbol, trading_date, last_price, volume, id, true from quotes where id % 2 = 1) group by 1, 2""",
        "quotes",
    ),
    "routed_feeds": s.with_tables(
        "select src as ingest_source, case src when 'client' then 2 when 'server' then 1 end as source_precedence, count(*) as n from (select case when id % 6 = 0 then 'elsewhere' else ingest_source end as src from quotes) group by 1, 2", "quotes"
    ),
    "merged_copies": s.with_tables(
        """select symbol, trading_date, max(volume) as volume, min(created_at) as first_seen,
 coalesce(arg_max(session, id) filter (id % 2 = 0 and session is not null), arg_max(session, id) filter (id % 2 = 1 and session is not null)) as session from quotes group by 1, 2""",
        "quotes",
    ),
    "symbol_coverage": s.with_tables(
        """select trading_date, reference_day, reference_day is not null as checked, expected, captured, matched, expected - matched as missing, case when reference_day is not null then captured - matched end as extra,
 case when expected > 0 then floor((matched / expected::double * 100.0::double) * 10 + 0.5) / 10 end as coverage_pct from (
 select d.trading_date, reference_day, (select count(*) from ref r where r.trading_date = d.reference_day) as expected, (select count(*) from cap c where c.trading_date = d.trading_date) as captured,
  (select count(*) from ref r join cap c using (symbol) where r.trading_date = d.reference_day and c.trading_date = d.trading_date) as matched
 from (select trading_date, (select max(trading_date) from ref r where r.trading_date <= x.trading_date) as reference_day from (select distinct trading_date from cap) x) d)""",
        "quotes",
        "watchlist",
        more="""cap as (select distinct case when id % 9 < 2 then symbol else 'N' || symbol end as symbol, trading_date from quotes),
 ref as (select distinct case when id % 5 < 3 then symbol else 'M' || symbol end as symbol, cast(trading_date - case when dayofmonth(trading_date) % 4 = 1 then 1 else 0 end as date) as trading_date from watchlist)""",
    ),
    "feed_differences": s.with_tables(
        f"""select count(*) filter (b.symbol is null) as only_a, count(*) filter (a.symbol is null) as only_b, count(*) filter (a.symbol is not null and b.symbol is not null) as matched,
 count(*) filter (a.symbol is not null and b.symbol is not null and a.r.p is distinct from b.r.p) as last_price_differs, count(*) filter (a.symbol is not null and b.symbol is not null and a.r.v is distinct from b.r.v) as volume_differs
 from ({LAST.format("quotes")}) a full join ({LAST.format("watchlist")}) b on a.symbol = b.symbol and a.trading_date = b.trading_date""",
        "quotes",
        "watchlist",
    ),
    "integrity_report": s.with_tables(
        """select 'collisions' as finding, 'error' as level, (select cast(coalesce(sum(n - 1), 0) as bigint) from (select count(*) as n from labelled group by symbol, created_at)) as n
 union all select 'raw_market_code', 'error', (select count(*) from labelled where regexp_full_match(market, '[A-Za-z]'))
 union all select 'unwanted_market', 'warn', (select count(*) from labelled where market not in ('Premier Market', 'Main Market', 'Auction Market'))
 union all select 'empty_registry', 'error', (select case when count(*) = 0 then 1 else 0 end from part)
 union all select 'orders_without_status', 'warn', (select count(*) from sightings where seq = 3)""",
        "quotes",
        "sightings",
        more=LABELLED,
    ),
    "depth_freshness": s.with_tables(
        f"""select *, case when age_secs <= 60 then 'OK' when age_secs <= 90 then 'LATE' else 'BREACH' end as status from (
 select symbol, max(created_at) as last_seen, count(distinct created_at) as captures, cast(epoch(timestamp '{NOW}') - epoch(max(created_at)) as bigint) as age_secs from quotes group by 1)""",
        "quotes",
    ),
    "depth_gaps": s.with_tables(
        """select * from (select symbol, trading_date, lag(created_at) over w as gap_from, created_at as gap_to, cast(epoch(created_at) - epoch(lag(created_at) over w) as bigint) as gap_secs
 from (select distinct symbol, trading_date, created_at from quotes) window w as (partition by symbol, trading_date order by created_at)) where gap_secs > 90""",
        "quotes",
    ),
    "column_coverage": s.with_tables(" union all ".join(f"select '{c}' as \"column\", count({c}) as filled, count(*) as rows from quotes" for c in COLUMNS), "quotes"),
    "price_coverage": s.with_tables("select count(*) as rows, count(last_price) as priced, count(last_price) / count(*) >= 0.5 as accepted from quotes", "quotes"),
    "latest_runs": f"with {RUNS} select * from runs qualify row_number() over (partition by scraper order by started_at desc, run_id desc) = 1",
    "stuck_runs": f"with {RUNS} select * from runs where status = 'RUNNING' and epoch_us(timestamp '{NOW}') - epoch_us(started_at) >= 660000000",
}
