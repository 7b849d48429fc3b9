"""Parsing, validation, the exchange's calendar and a stream as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parsing as p
from ..functions import scalars as f
from ..operators import validation
from ..sources import capture, folders
from ..sources import standins as s
from ..streaming import capture as streams
from . import sessions
from .feeds import LABELLED, labelled


def parsed_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers, symbols, sides and times written in the ways that pages write them."""
    n, k = F.col("event_id") * 7 % 100000 + 1, F.col("event_id") % 8
    t = n.cast("string")
    text = (
        F.when(k == 0, F.format_number(n, 0))
        .when(k == 1, F.concat(F.lit("("), t, F.lit(")")))
        .when(k == 2, F.concat(F.lit("\u202a"), t, F.lit("K\u202c")))
        .when(k == 3, F.concat(t, F.lit(" %")))
        .when(k == 4, F.concat(F.lit("\u2212"), t))
        .when(k == 5, F.lit(" \u2014 "))
        .when(k == 6, F.concat(t, F.lit(" MKWF")))
        .otherwise(F.concat(F.lit("x"), t, F.lit("y")))
    )
    user = F.col("user_id").cast("string")
    symbol = F.when(k < 4, F.concat(F.lit("KSE:s"), user, F.lit("  Al Arabi"))).otherwise(F.concat(F.lit("s"), user, F.lit("-x")))
    side = F.when(k == 0, " buy ").when(k == 1, "Sold").when(k == 2, "شراء").when(k == 3, "-").otherwise("hold")
    time = F.concat(F.lit("25-08-2026 "), F.hour("ts").cast("string"), F.lit(":"), F.minute("ts").cast("string"), F.when(k % 2 == 0, ":7").otherwise(""))
    e = s.read(spark, sf_dir, "events")
    return e.select("event_id", p.to_number(text).alias("number"), p.to_symbol(symbol).alias("symbol"), p.to_side(side).alias("side"), p.to_time(time).alias("time"))


def _broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled captures with every kind of fault put in."""
    n = F.col("id")
    return labelled(spark, sf_dir).withColumns(
        {
            "symbol": F.when(n % 101 != 0, F.col("symbol")),
            "market": F.when(n % 103 == 0, "").otherwise(F.col("market")),
            "last_price": F.when(n % 107 == 0, -1.0).otherwise(F.col("last_price")),
            "bid": F.when(n % 109 == 0, 2e6).otherwise(F.col("bid")),
            "volume": F.when(n % 113 == 0, -5).otherwise(F.col("volume")),
        }
    )


def quote_rejections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.reasons(validation.quotes(_broken(spark, sf_dir)))


def accepted_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = validation.split(validation.quotes(_broken(spark, sf_dir)))
    return good.select("id", "symbol", "market", "last_price", "volume")


def _levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, n = s.quotes(spark, sf_dir), F.col("id")
    zero = lambda c: F.when(n % 50 == 3, 0).otherwise(F.col(c))
    return q.select("id", "symbol", "created_at", (n % 23).cast("int").alias("level"), zero("bid").alias("bid"), zero("offer").alias("offer"), zero("bid_qty").alias("bid_qty"), zero("offer_qty").alias("offer_qty"))


def depth_rejections(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _levels(spark, sf_dir).withColumns({"bid": F.when(F.col("id") % 74 != 1, F.col("bid")), "offer": F.when(F.col("id") % 74 != 1, F.col("offer"))})
    return validation.reasons(validation.depth(d))


def checked_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = s.sightings(spark, sf_dir).withColumns({"created_at": F.lit("2024-01-01").cast("timestamp_ntz"), "side": F.when(F.col("seq") == 2, "HOLD").otherwise(F.col("side")), "quantity": F.when(F.col("order_id") % 5 == 0, F.col("quantity") - 1).otherwise(F.col("quantity"))})
    return validation.orders(o).select("order_id", "seq", "side", "quantity", "filled_quantity")


def exchange_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    return s.read(spark, sf_dir, "events").select(
        "event_id", f.trading_day(ts).alias("day"), f.minute_bucket(ts).alias("minute"), f.window_status(ts).alias("status"), f.is_within_window(ts).alias("within"), f.previous_trading_day(f.trading_day(ts)).alias("previous_day")
    )


def summary_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    panels = s.summaries(spark, sf_dir).select(F.col("captured_at").cast("timestamp_ntz").alias("captured_at"), "advancing")
    day = F.when(F.dayofmonth("trading_date") % 5 == 2, F.date_sub("trading_date", 1)).otherwise(F.col("trading_date"))
    return capture.summary_state(panels, s.quotes(spark, sf_dir).withColumn("trading_date", day))


def constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.violations(sessions.symbol_day(spark, sf_dir), "symbol_day")


def streamed_minute_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of captures read as a stream, run over all that is there."""
    schema = s.read(spark, sf_dir, "events").schema
    e = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    q = e.select(F.col("event_id").alias("id"), F.concat(F.lit("S"), (F.col("user_id") % 10).cast("string")).alias("symbol"), F.to_date("ts").alias("trading_date"), F.col("ts").cast("timestamp").alias("created_at"), F.floor("value").alias("last_price"), F.col("event_id").alias("volume"))
    out = streams.drain(streams.minute_bars(q), folders.shared(spark), ["symbol", "trading_date", "minute"], "update")
    return out.withColumn("minute", F.col("minute").cast("timestamp_ntz"))


QUERIES = {g.__name__: g for g in (parsed_cells, quote_rejections, accepted_quotes, depth_rejections, checked_orders, exchange_clock, summary_states, constraint_violations, streamed_minute_bars)}
BROKEN = """
broken as (
 select id, case when id % 101 <> 0 then symbol end as symbol, case when id % 103 = 0 then '' else market end as market, case when id % 107 = 0 then -1 else last_price end as last_price,
  case when id % 109 = 0 then 2000000 else bid end as bid, case when id % 113 <> 0 then volume end as volume from labelled),
judged as (
 select *, case when symbol is null then 'no symbol' when market = '' then 'no market' when market = 'B' then 'market is a raw code, not a name: "B"'
  when last_price < 0 then 'impossible last_price: -1.0' when bid < 0 then 'impossible bid: ' || cast(bid as varchar) when bid > 1000000 then 'impossible bid: 2000000.0' when offer < 0 then 'impossible offer: ' || cast(offer as varchar) end as reject_reason
 from broken join (select id, offer from labelled) using (id))"""
DOW = "dayofweek({0}) in (5, 6)"
DAYS = "from (select event_id, ts, cast(ts + to_hours(3) as date) as day, hour(ts + to_hours(3)) * 60 + minute(ts) as m from events)"
ORACLES = {
    "parsed_cells": """select event_id, case k when 0 then n when 1 then -n when 2 then n * 1000 when 3 then n when 4 then -n when 6 then n * 1000000 when 7 then n end::double as number,
 'S' || cast(user_id as varchar) as symbol, case k when 0 then 'BUY' when 1 then 'SELL' when 2 then 'BUY' when 3 then null else 'UNKNOWN' end as side,
 lpad(cast(hour(ts) as varchar), 2, '0') || ':' || lpad(cast(minute(ts) as varchar), 2, '0') || case when k % 2 = 0 then ':07' else ':00' end as time
 from (select *, event_id * 7 % 100000 + 1 as n, event_id % 8 as k from events)""",
    "quote_rejections": s.with_tables("select reject_reason, count(*) as n from judged where reject_reason is not null group by 1", "quotes", more=LABELLED + "," + BROKEN),
    "accepted_quotes": s.with_tables("select id, symbol, market, last_price, volume from judged where reject_reason is null", "quotes", more=LABELLED + "," + BROKEN),
    "depth_rejections": s.with_tables(
        """select case when level < 1 or level > 20 then 'level out of range: ' || cast(level as varchar) when bid < 0 then 'impossible bid: ' || cast(bid as varchar) when offer < 0 then 'impossible offer: ' || cast(offer as varchar)
 when bid is null and offer is null then 'empty level' when z or (coalesce(bid, 0) = 0 and coalesce(offer, 0) = 0 and bid_qty = 0 and offer_qty = 0) then 'empty book — no bid, offer or quantity on either side' end as reject_reason, count(*) as n
 from (select id % 23 as level, id % 50 = 3 as z, case when id % 74 = 1 then null when id % 50 = 3 then 0 else bid end as bid, case when id % 74 = 1 then null when id % 50 = 3 then 0 else offer end as offer, bid_qty, offer_qty from quotes)
 group by 1 having reject_reason is not null""",
        "quotes",
    ),
    "checked_orders": s.with_tables(
        "select order_id, seq, case when seq = 2 then 'UNKNOWN' else side end as side, q as quantity, case when filled_quantity > q then null else filled_quantity end as filled_quantity from (select *, case when quantity - case when order_id % 5 = 0 then 1 else 0 end >= 0 then quantity - case when order_id % 5 = 0 then 1 else 0 end end as q from sightings)",
        "sightings",
    ),
    "exchange_clock": f"""select event_id, day, date_trunc('minute', ts) as minute, case when {DOW.format("day")} then 'WEEKEND' when m < 540 then 'BEFORE' when m < 780 then 'OPEN' else 'AFTER' end as status,
 not {DOW.format("day")} and m >= 540 and m < 780 as within, cast(day - case dayofweek(day) when 0 then 3 when 6 then 2 else 1 end as date) as previous_day {DAYS}""",
    "summary_states": s.with_tables(
        """select captured_at, advancing, case when live then capture_day else coalesce(last_traded, capture_day) end as trading_date,
 case when not live then 'STALE' when hour(captured_at + to_hours(3)) * 60 + minute(captured_at) >= 810 then 'CLOSE' else 'LIVE' end as session_state
 from (select *, dayofweek(capture_day) not in (5, 6) and coalesce(last_traded = capture_day, false) as live from (
  select captured_at, advancing, cast(captured_at + to_hours(3) as date) as capture_day, (select max(trading_date) from (select cast(trading_date - case when dayofmonth(trading_date) % 5 = 2 then 1 else 0 end as date) as trading_date from quotes) q where q.trading_date <= cast(p.captured_at + to_hours(3) as date)) as last_traded from summaries p))""",
        "quotes", "summaries",
    ),
    "constraint_violations": sessions._sql(
        """select 'ratio_at_offer' as "constraint", count(*) filter (buy_sell_ratio is not null and pct_at_offer > 90) as n from days union all select 'quality', count(*) filter (data_quality not in ('FULL', 'THIN')) from days
 union all select 'high_below_low', count(*) filter (high_px < low_px) from days""",
        sessions.PRIMARY, sessions.FACTS.strip(), sessions.DAY.strip(),
    ),
    "streamed_minute_bars": """select 'S' || cast(user_id % 10 as varchar) as symbol, cast(ts as date) as trading_date, date_trunc('minute', ts) as minute, arg_min(cast(floor(value) as bigint), (ts, event_id)) as open, max(cast(floor(value) as bigint)) as high,
 min(cast(floor(value) as bigint)) as low, arg_max(cast(floor(value) as bigint), (ts, event_id)) as close, max(event_id) as cumulative from events group by all""",
}
