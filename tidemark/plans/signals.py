"""Intraday snapshots, checks and scores as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import minute
from ..sources import standins as s


def _prices_and_books(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All captures as prices, and all as books, most of them under another symbol, so that prices find older ones."""
    q = s.quotes(spark, sf_dir)
    return q.drop("bid", "offer", "bid_qty", "offer_qty"), q.select(F.when(F.col("id") % 5 < 2, F.col("symbol")).otherwise(F.concat("symbol", F.lit("B"))).alias("symbol"), "created_at", "id", "bid", "bid_qty", "offer", "offer_qty")


def quotes_with_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each capture with the level-one book last seen at or before it."""
    prices, books = _prices_and_books(spark, sf_dir)
    return minute.last_known(prices, books, ["bid", "bid_qty", "offer", "offer_qty"]).drop("session", "ingest_source")


def book_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minute.snapshots(s.quotes(spark, sf_dir))


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minute.signals(book_snapshots(spark, sf_dir))


def alert_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return signals(spark, sf_dir).select("symbol", "id", "signal", minute.alert_text(c("symbol"), c("price"), c("signal"), c("detail")).alias("text"))


def signal_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = book_snapshots(spark, sf_dir)
    return minute.score(minute.signals(rows).drop("detail"), rows).drop("scored")


def signal_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minute.tally(signal_scores(spark, sf_dir))


SNAPSHOTS = """
l as (
 select *, volume - last_value(volume ignore nulls) over (partition by symbol, trading_date order by created_at, id rows between unbounded preceding and 1 preceding) as rise,
  bid_qty - lag(bid_qty) over w as bid_change, offer_qty - lag(offer_qty) over w as offer_change,
  greatest(0, epoch(created_at) - epoch(lag(created_at) over w)) as gap,
  case when bid is null or lag(bid) over w is null or lag(bid) over w <> bid then 1 else 0 end as nb,
  case when offer is null or lag(offer) over w is null or lag(offer) over w <> offer then 1 else 0 end as no
 from quotes window w as (partition by symbol, trading_date order by created_at, id)),
lv as (select *, case when rise >= 0 then rise end as volume_delta, sum(nb) over w as lb, sum(no) over w as lo from l window w as (partition by symbol, trading_date order by created_at, id)),
ages as (
 select *, case when bid is not null then cast(sum(case when nb = 1 then 0 else floor(gap + 0.5) end) over (partition by symbol, trading_date, lb order by created_at, id) as bigint) end as bid_age_secs,
  case when offer is not null then cast(sum(case when no = 1 then 0 else floor(gap + 0.5) end) over (partition by symbol, trading_date, lo order by created_at, id) as bigint) end as offer_age_secs,
  case when offer_change <> 0 and volume_delta = 0 then case when offer_change > 0 then 'ADDED' else 'PULLED' end
   when offer_change < 0 and volume_delta is not null then 'TRADED' end as ev
 from lv),
walls as (select *, case when ev = 'TRADED' or abs(offer_change) >= 200000 or offer_qty >= 200000 then ev end as wall_event from ages),
snaps as (
 select symbol, created_at as ts, id, trading_date, last_price, bid, bid_qty, offer, offer_qty,
  floor((case when offer_qty <> 0 then bid_qty::double / offer_qty end) * 10000 + 0.5) / 10000 as buyers_per_seller, bid_age_secs, offer_age_secs, bid_change, offer_change, wall_event,
  case when wall_event is not null then offer end as wall_price, case when wall_event is not null then abs(offer_change) end as wall_qty, volume_delta,
  case when volume_delta is not null then bid_qty > 100000 and offer_qty > 100000 and volume_delta = 0 end as is_frozen
 from walls)"""
SIGNALS = """
pairs as (
 select *, lag(last_price) over w as pp, lag(offer_qty) over w as po, row_number() over w as nth, bid_qty::double / nullif(offer_qty, 0) as ratio
 from snaps window w as (partition by symbol, trading_date order by ts, id)),
hits as (
 select *, unnest(list_filter([
  case when bid_qty < 20000 then {'s': 'NO_PROTECTION', 'd': format('bid {:,} < 20,000', bid_qty)} end,
  case when ratio >= 1.6 and last_price > pp then {'s': 'BUYERS_8_5', 'd': format('ratio {:.2f} with price {} to {}', floor(ratio * 100 + 0.5) / 100, pp::bigint, last_price::bigint)} end,
  case when offer_qty > po and volume_delta = 0 then {'s': 'WALL_PLACED', 'd': format('offer {:,} to {:,} with no volume', po, offer_qty)} end,
  case when offer_qty < po and volume_delta = 0 then {'s': 'WALL_PULLED', 'd': format('offer {:,} to {:,} with no volume', po, offer_qty)} end,
  case when bid_qty > 100000 and bid_age_secs < 300 then {'s': 'BAIT_BID', 'd': format('bid {:,} only {}s old', bid_qty, bid_age_secs)} end,
  case when bid_qty > 100000 and offer_qty > 100000 and volume_delta = 0 then {'s': 'FROZEN', 'd': format('bid {:,} / offer {:,}, nothing traded', bid_qty, offer_qty)} end,
  case when last_price < pp and volume_delta between 1 and 100 then {'s': 'BID_EMPTY', 'd': format('{} share(s) moved the price {} to {}', volume_delta, pp::bigint, last_price::bigint)} end
 ], lambda x: x is not null)) as h from pairs where nth > 1),
signals as (select symbol, trading_date, ts as fired_at, id, h.s as signal, h.d as detail, last_price as price from hits)"""


def _price_after(minutes: int, name: str) -> str:
    return f"""
p{minutes} as (
 select g.symbol, g.id, g.signal, p.last_price as {name} from signals g
 asof left join (select symbol, ts, arg_min(last_price, id) as last_price from snaps where last_price is not null group by 1, 2) p
 on g.symbol = p.symbol and g.fired_at + to_minutes({minutes}) <= p.ts)"""


SCORES = (
    ",".join(_price_after(m, f"px_{m}min") for m in (5, 15, 60))
    + """,
ways(signal, way) as (values ('BUYERS_8_5', 1), ('WALL_PULLED', 1), ('NO_PROTECTION', -1), ('BID_EMPTY', -1), ('BAIT_BID', -1), ('WALL_PLACED', -1), ('FROZEN', 0)),
scores as (
 select g.* exclude (detail), px_5min, px_15min, px_60min, case when way <> 0 then (px_5min - price) * way >= 1 end as was_right
 from signals g join ways using (signal) join p5 using (symbol, id, signal) join p15 using (symbol, id, signal) join p60 using (symbol, id, signal))"""
)

QUERIES = {f.__name__: f for f in (quotes_with_book, book_snapshots, signals, alert_texts, signal_scores, signal_tally)}
ORACLES = {
    "quotes_with_book": s.with_tables(
        """select p.* exclude (session, ingest_source, bid, offer, bid_qty, offer_qty), b.bid, b.bid_qty, b.offer, b.offer_qty
 from quotes p asof left join (select * replace (case when id % 5 < 2 then symbol else symbol || 'B' end as symbol) from quotes qualify row_number() over (partition by case when id % 5 < 2 then symbol else symbol || 'B' end, created_at order by id desc) = 1) b
 on p.symbol = b.symbol and p.created_at >= b.created_at""",
        "quotes",
    ),
    "book_snapshots": s.with_tables("select * from snaps", "quotes", more=SNAPSHOTS),
    "signals": s.with_tables("select * from signals", "quotes", more=SNAPSHOTS + "," + SIGNALS),
    "alert_texts": s.with_tables("select symbol, id, signal, symbol || coalesce(' @ ' || cast(cast(price as bigint) as varchar), '') || ' — ' || signal || ': ' || detail as text from signals", "quotes", more=SNAPSHOTS + "," + SIGNALS),
    "signal_scores": s.with_tables("select * from scores", "quotes", more=SNAPSHOTS + "," + SIGNALS + "," + SCORES),
    "signal_tally": s.with_tables("select signal, count(*) filter (was_right) as right_n, count(was_right) as graded, count(*) as fired from scores group by 1", "quotes", more=SNAPSHOTS + "," + SIGNALS + "," + SCORES),
}
