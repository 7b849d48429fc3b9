"""Exchange tables derived from the driver's generic ones, so that every query runs on the given Parquet.

The same derivations exist as SQL text (``SQL``) for the oracle. Prices are whole fils, so sums are exact in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import folders

#: Bytes of stored lines of orders for each partition of them: what a task holds does not grow with the table.
LINES = 4 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _in_session(ts: Column) -> Column:
    """The instant moved into trading hours of its day (08:00 to 16:00 local; some days stop before 11:00)."""
    day, second = F.to_date(ts), F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    slow = F.when(F.dayofmonth(day) % 11 == 4, 8).otherwise(3)
    return day.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(5), F.lit(0), F.floor(second / slow).cast("decimal(18,6)"))


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures: cumulative volume and trades for each symbol and session, with gaps, resets and odd books."""
    e = read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"))
    n = F.col("event_id")
    session = (
        F.when((F.col("event_type") == "view") & (n % 5 == 0), "")
        .when((F.col("event_type") == "signup") & (n % 3 == 0), "Closing")
        .when((F.col("event_type") == "signup") & (n % 3 == 1), "Close Auction Acceptance")
        .when((F.col("event_type") == "purchase") & (n % 7 == 0), "Suspended")
        .when(F.col("event_type") == "view", "Trading")
        .when(F.col("event_type") == "click", "CB Auction")
        .when(F.col("event_type") == "purchase", "Close-Of-Day")
        .when(F.col("event_type") == "signup", "Trading at Last")
    )
    px = F.floor("value").cast("double")
    base = e.select(
        n.alias("id"),
        F.concat(F.lit("S"), (F.col("user_id") % 10).cast("string")).alias("symbol"),
        F.to_date("ts").alias("trading_date"),
        _in_session(F.col("ts")).alias("created_at"),
        F.when(n % 3 == 0, "client").otherwise("server").alias("ingest_source"),
        session.alias("session"),
        F.when(n % 31 != 0, px).alias("last_price"),
        F.when(n % 4 == 0, 0).otherwise(F.col("k")).alias("step"),
        (F.col("k") * 3).cast("long").alias("last_qty"),
        F.when(n % 37 != 0, px - n % 3).alias("bid"),
        F.when(n % 41 != 0, px + n % 4 - 1).alias("offer"),
        (n * 37 % 250 * 1000).alias("bid_qty"),
        (n * 53 % 260 * 1000).alias("offer_qty"),
    )
    w = Window.partitionBy("symbol", "trading_date").orderBy("created_at", "id")
    return base.select(
        *[c for c in base.columns if c != "step"],
        F.when(F.col("id") % 29 != 0, F.sum("step").over(w)).cast("long").alias("volume"),
        F.when(F.col("id") % 43 != 0, F.sum((F.col("step") > 0).cast("int")).over(w)).cast("long").alias("trades"),
    )


def instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry: a symbol for each part, two to a code."""
    k = F.col("p_partkey")
    return read(spark, sf_dir, "part").select(
        F.concat(F.lit("S"), k.cast("string")).alias("symbol"),
        F.floor(k / 2).cast("string").alias("code"),
        F.when(F.col("p_size") % 4 == 0, "Auction Market").when(F.col("p_size") % 4 == 1, "Main Market").otherwise("Premier Market").alias("market"),
        F.col("p_name").alias("description"),
        F.when(k % 11 != 3, F.col("p_size") % 9 != 0).alias("is_primary"),
        F.when(F.col("p_size") % 13 == 0, "DELISTED").otherwise("CAPTURED").alias("broker_status"),
        F.when(k % 17 == 5, F.concat(F.lit("S"), (k + 1).cast("string"))).alias("superseded_by"),
        F.when(k % 3 != 0, F.concat(F.lit("G"), (k % 5).cast("string"))).alias("owner_group"),
    )


def watchlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second feed: the same captures at other prices; it knows one symbol by another name."""
    q = quotes(spark, sf_dir)
    return q.select(F.when(F.col("symbol") == "S7", "X7").otherwise(F.col("symbol")).alias("symbol"), "created_at", "trading_date", (F.col("last_price") + F.col("id") % 2 + (F.col("id") % 10 == 0).cast("int")).alias("last_price"), "volume", F.col("id"))


def sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order sightings: each line of an order is one look at it, with a growing filled quantity."""
    n = max(spark.sparkContext.defaultParallelism, -(-folders.size(spark, f"{sf_dir}/lineitem.parquet") // LINES))
    line, order = read(spark, sf_dir, "lineitem").repartition(n, "l_orderkey"), read(spark, sf_dir, "orders").repartition(n, "o_orderkey")
    one = line.groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("q"), F.max("l_extendedprice").alias("px"), F.max("l_tax").alias("tax"), F.max("l_partkey").alias("part"))
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber")
    seen = one.join(order, one.l_orderkey == order.o_orderkey).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("seq"),
        F.when(F.col("l_linenumber") % 4 != 3, F.concat(F.lit("S"), (F.col("l_orderkey") % 10).cast("string"))).alias("symbol"),
        F.when(F.col("o_orderstatus") == "O", "BUY").when(F.col("o_orderstatus") == "F", "SELL").otherwise("UNKNOWN").alias("side"),
        F.concat(F.lit("st"), F.col("l_linenumber").cast("string")).alias("order_status"),
        F.floor("px").alias("price"),
        F.to_date("o_orderdate").alias("trading_date"),
        F.when(F.col("l_linenumber") % 5 == 4, F.lit(None)).when(F.col("l_linenumber") % 3 == 2, 0).otherwise(F.col("q")).alias("fill"),
        F.floor("px").alias("order_value"),
        (F.floor("px") + F.floor(F.col("tax") * 100) * F.col("l_linenumber") + 1).alias("net_value"),
    )
    w = Window.partitionBy("order_id").orderBy("seq")
    return seen.withColumn("filled_quantity", F.when(F.col("fill").isNotNull(), F.sum("fill").over(w)).cast("long")).withColumn("quantity", F.sum(F.coalesce("fill", F.lit(0.0))).over(Window.partitionBy("order_id")).cast("long")).drop("fill")


def summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The broker's panel: one capture an hour; what happens on each third day is booked on the day before."""
    e = read(spark, sf_dir, "events")
    late = F.make_dt_interval(days=F.when(F.dayofmonth("ts") % 3 == 0, 1).otherwise(0))
    hour = F.date_trunc("hour", F.col("ts") - late).cast("timestamp_ntz")
    got = e.groupBy(hour.alias("captured_at")).agg(
        F.count_if(F.col("event_type") == "view").alias("advancing"),
        F.count_if(F.col("event_type") == "click").alias("declining"),
        F.count_if(F.col("event_type") == "error").alias("unchanged"),
        F.count("*").alias("symbols_traded"),
        F.sum(F.floor("value")).cast("long").alias("total_volume"),
    )
    day = F.to_date("captured_at")
    return got.select(
        "*", day.alias("trading_date"), F.when(F.hour("captured_at") >= 20, "STALE").when(F.hour("captured_at") >= 18, "CLOSE").otherwise("LIVE").alias("session_state")
    )


#: The same tables for the oracle, as common table expressions that build on each other.
SQL = {
    "quotes": """
quotes as (
 select id, symbol, trading_date, created_at, ingest_source, session, last_price, last_qty, bid, offer, bid_qty, offer_qty,
  case when id % 29 <> 0 then cast(sum(step) over w as bigint) end as volume,
  case when id % 43 <> 0 then cast(sum(case when step > 0 then 1 else 0 end) over w as bigint) end as trades
 from (
  select event_id as id, 'S' || cast(user_id % 10 as varchar) as symbol, cast(ts as date) as trading_date,
   cast(cast(ts as date) as timestamp) + to_hours(5) + to_seconds((hour(ts) * 3600 + minute(ts) * 60 + second(ts)) // case when dayofmonth(ts) % 11 = 4 then 8 else 3 end) as created_at,
   case when event_id % 3 = 0 then 'client' else 'server' end as ingest_source,
   case when event_type = 'view' and event_id % 5 = 0 then ''
    when event_type = 'signup' and event_id % 3 = 0 then 'Closing'
    when event_type = 'signup' and event_id % 3 = 1 then 'Close Auction Acceptance'
    when event_type = 'purchase' and event_id % 7 = 0 then 'Suspended'
    when event_type = 'view' then 'Trading' when event_type = 'click' then 'CB Auction'
    when event_type = 'purchase' then 'Close-Of-Day' when event_type = 'signup' then 'Trading at Last' end as session,
   case when event_id % 31 <> 0 then floor(value) end as last_price,
   case when event_id % 4 = 0 then 0 else k end as step, cast(k * 3 as bigint) as last_qty,
   case when event_id % 37 <> 0 then floor(value) - event_id % 3 end as bid,
   case when event_id % 41 <> 0 then floor(value) + event_id % 4 - 1 end as offer,
   event_id * 37 % 250 * 1000 as bid_qty, event_id * 53 % 260 * 1000 as offer_qty
  from (select *, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k from events))
 window w as (partition by symbol, trading_date order by created_at, id))""",
    "instruments": """
instruments as (
 select 'S' || cast(p_partkey as varchar) as symbol, cast(p_partkey // 2 as varchar) as code,
  case when p_size % 4 = 0 then 'Auction Market' when p_size % 4 = 1 then 'Main Market' else 'Premier Market' end as market,
  p_name as description, case when p_partkey % 11 <> 3 then p_size % 9 <> 0 end as is_primary,
  case when p_size % 13 = 0 then 'DELISTED' else 'CAPTURED' end as broker_status,
  case when p_partkey % 17 = 5 then 'S' || cast(p_partkey + 1 as varchar) end as superseded_by,
  case when p_partkey % 3 <> 0 then 'G' || cast(p_partkey % 5 as varchar) end as owner_group
 from part)""",
    "watchlist": """
watchlist as (
 select case when symbol = 'S7' then 'X7' else symbol end as symbol, created_at, trading_date, last_price + id % 2 + case when id % 10 = 0 then 1 else 0 end as last_price, volume, id
 from quotes)""",
    "sightings": """
sightings as (
 select order_id, seq, symbol, side, order_status, price, trading_date, order_value, net_value,
  case when fill is not null then cast(sum(fill) over (partition by order_id order by seq) as bigint) end as filled_quantity,
  cast(sum(coalesce(fill, 0)) over (partition by order_id) as bigint) as quantity
 from (
  select l_orderkey as order_id, l_linenumber as seq,
   case when l_linenumber % 4 <> 3 then 'S' || cast(l_orderkey % 10 as varchar) end as symbol,
   case when o_orderstatus = 'O' then 'BUY' when o_orderstatus = 'F' then 'SELL' else 'UNKNOWN' end as side,
   'st' || cast(l_linenumber as varchar) as order_status, cast(floor(px) as bigint) as price, cast(o_orderdate as date) as trading_date,
   case when l_linenumber % 5 = 4 then null when l_linenumber % 3 = 2 then 0 else q end as fill,
   cast(floor(px) as bigint) as order_value, cast(floor(px) as bigint) + cast(floor(tax * 100) as bigint) * l_linenumber + 1 as net_value
  from (select l_orderkey, l_linenumber, max(l_quantity) as q, max(l_extendedprice) as px, max(l_tax) as tax from lineitem group by all)
  join orders on l_orderkey = o_orderkey))""",
    "summaries": """
summaries as (
 select *, cast(captured_at as date) as trading_date,
  case when hour(captured_at) >= 20 then 'STALE' when hour(captured_at) >= 18 then 'CLOSE' else 'LIVE' end as session_state
 from (
  select date_trunc('hour', ts - to_days(case when dayofmonth(ts) % 3 = 0 then 1 else 0 end)) as captured_at, count(*) filter (event_type = 'view') as advancing,
   count(*) filter (event_type = 'click') as declining, count(*) filter (event_type = 'error') as unchanged,
   count(*) as symbols_traded, cast(sum(floor(value)) as bigint) as total_volume
  from events group by 1))""",
}


def with_tables(body: str, *names: str, more: str = "") -> str:
    """``body`` behind the derivations of ``names`` (and further common table expressions)."""
    parts = [SQL[n].strip() for n in names] + ([more.strip().rstrip(",")] if more else [])
    return "with " + ",\n".join(parts) + "\n" + body.strip()
