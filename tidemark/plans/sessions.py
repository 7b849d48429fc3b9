"""Daily queries: symbol and market facts over the stand-in tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Limits
from ..operators import market, session
from ..sources import standins as s


def session_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session.day_facts(s.quotes(spark, sf_dir)).drop("last_close")


def symbol_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session.symbol_day(s.quotes(spark, sf_dir), s.instruments(spark, sf_dir))


def symbol_day_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with previous closes from at most two sessions back."""
    return session.symbol_day(s.quotes(spark, sf_dir), s.instruments(spark, sf_dir), Limits(max_sessions_back=2)).select("symbol", "trading_date", "prev_close", "prev_session_used", "chg_1d", "down_days")


def markets_disagree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbols under several market labels in a session."""
    k = F.substring("symbol", 2, 9).cast("int")
    market = F.when((F.col("id") % 50 == 0) & (k % 2 == 0), "Main Market").otherwise("Premier Market")
    return session.markets_disagree(s.quotes(spark, sf_dir).withColumn("market", market)).withColumn("markets", F.array_join("markets", ", "))


def _tradeable(instruments: DataFrame) -> DataFrame:
    flag = F.coalesce("is_primary", F.lit(True)) & (F.col("market") != "Auction Market") & (F.col("broker_status") != "DELISTED")
    return instruments.withColumn("is_tradeable", flag)


def market_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, i = s.quotes(spark, sf_dir), _tradeable(s.instruments(spark, sf_dir))
    return market.market_day(session.symbol_day(q, i), q, s.summaries(spark, sf_dir), i)


def symbol_day_with_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = market_day(spark, sf_dir).select("trading_date", "regime", "pct_advancing", "breadth_5d_avg")
    return symbol_day(spark, sf_dir).join(m, "trading_date", "left").select("symbol", "trading_date", "close_px", "prev_close", "chg_fils", "down_days", "data_quality", "regime", "pct_advancing", "breadth_5d_avg")


def session_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each symbol's sessions with its own and the market's session before, the one five before, and its close."""
    q = s.quotes(spark, sf_dir).withColumn("symbol", F.when((F.col("symbol") == "S2") & (F.dayofmonth("trading_date") % 3 == 0), "S3").otherwise(F.col("symbol")))
    own = session.prev_session_of_symbol(q).withColumnRenamed("prev_date", "own_prev")
    for n, name in ((1, "prev"), (5, "prev_5")):
        own = own.join(session.prev_session(q, n).withColumnRenamed("prev_date", name), "trading_date")
    return own.join(session.session_close(q), ["symbol", "trading_date"], "left")


R4 = "floor(({}) * 10000 + 0.5) / 10000"
r4 = R4.format

FACTS = f"""
tiers(session, tier, name) as (values ('Close-Of-Day', 1, 'CLOSE_OF_DAY'), ('Closing', 2, 'CLOSING'), ('Trading at Last', 3, 'TRADING_AT_LAST'),
 ('Close Auction Acceptance', 4, 'AUCTION'), ('Trading', 5, 'TRADING'), ('', 5, 'TRADING')),
lagged as (
 select q.*, t.tier, t.name as tier_name, hour(created_at + to_hours(3)) as h, hour(created_at + to_hours(3)) * 60 + minute(created_at) as mod,
  date_trunc('minute', created_at) as minute, lag(last_price) over w as before, volume - lag(volume) over w as rise
 from quotes q left join tiers t on trim(q.session) = t.session
 window w as (partition by symbol, trading_date order by created_at, id)),
st as (
 select *, case when rise > 0 then rise end as traded, case when rise > 0 then last_price - before end as delta,
  coalesce(last_qty <= 100, false) as tiny, coalesce(last_price >= offer, false) as ao,
  not coalesce(last_price >= offer, false) and coalesce(last_price <= bid, false) as ab, trim(session) in ('Trading', 'CB Auction', '') as ranged
 from lagged),
hours as (
 select symbol, trading_date, arg_max(h, (v, -h)) as peak_hour from (
  select symbol, trading_date, h, sum(traded) as v from st where traded is not null group by all) group by 1, 2),
f as (
 select symbol, trading_date,
  arg_min(last_price, (created_at, id)) filter (ranged and last_price > 0) as open_px,
  max(last_price) filter (ranged and last_price > 0) as high_px, min(last_price) filter (ranged and last_price > 0) as low_px,
  arg_max(last_price, (-tier, created_at, id)) filter (tier is not null and last_price > 0) as close_px,
  arg_max(tier_name, (-tier, created_at, id)) filter (tier is not null and last_price > 0) as close_source,
  bool_and(session = 'CB Auction') filter (ranged) as only_cb, max(mod) filter (ranged) as last_mod,
  coalesce(bool_or(trim(session) = 'Close-Of-Day'), false) as has_close_of_day,
  max(volume) as total_volume, max(trades) as trades, max(traded) as highest_minute_volume, count(traded) as steps,
  count(*) filter (delta <> 0) as moves, count(*) filter (delta > 0) as up_moves, count(*) filter (delta < 0) as down_moves,
  count(*) filter (delta >= 2) as up_moves_2plus, count(*) filter (delta >= 3) as up_moves_3plus,
  count(*) filter (delta > 0 and tiny) as up_moves_tiny, count(*) filter (delta < 0 and tiny) as down_moves_tiny,
  count(*) filter (traded is not null and tiny) as trades_under_100,
  count(*) filter (traded is not null and ao) as trades_at_offer, count(*) filter (traded is not null and ab) as trades_at_bid,
  cast(coalesce(sum(traded) filter (ao), 0) as bigint) as bought_at_offer, cast(coalesce(sum(traded) filter (ab), 0) as bigint) as sold_at_bid,
  cast(coalesce(sum(traded) filter (not ao and not ab), 0) as bigint) as shares_inside_spread,
  cast(coalesce(sum(traded) filter (delta > 0), 0) as double) as up_shares, cast(coalesce(sum(traded) filter (delta < 0), 0) as double) as down_shares,
  coalesce(sum(traded * last_price), 0.0) as turnover,
  cast(coalesce(sum(traded) filter (mod < 675), 0) as double) as fh, cast(coalesce(sum(traded) filter (mod >= 675), 0) as double) as sh,
  count(distinct minute) filter (traded is not null and mod < 675) as fm, count(distinct minute) filter (traded is not null and mod >= 675) as sm,
  avg(offer - bid) filter (traded is not null and bid > 0 and offer > 0 and offer >= bid) as spread,
  count(distinct minute) as minutes_captured,
  arg_max(last_price, (created_at, id)) filter (last_price > 0 and (session is null or session in ('Trading', 'Close Auction Acceptance', 'Trading at Last', 'Close-Of-Day'))) as last_close
 from st group by 1, 2),
facts as (
 select symbol, trading_date, open_px, high_px, low_px, high_px - low_px as day_range, close_px, close_source,
  case when only_cb then 'CB_ONLY' when last_mod >= 790 then 'FULL' when last_mod is not null then 'SHORT' end as range_source,
  total_volume, trades, {r4("case when trades <> 0 then cast(total_volume as double) / trades end")} as avg_trade_size, highest_minute_volume,
  steps, moves, up_moves, down_moves, up_moves_2plus, up_moves_3plus, up_moves_tiny, down_moves_tiny, trades_under_100,
  {r4("case when up_moves <> 0 then 100.0::double * up_moves_tiny / up_moves end")} as tiny_pct_up,
  {r4("case when down_moves <> 0 then 100.0::double * down_moves_tiny / down_moves end")} as tiny_pct_down,
  bought_at_offer, sold_at_bid, shares_inside_spread, trades_at_offer, trades_at_bid,
  {r4("case when steps <> 0 then 100.0::double * trades_at_offer / steps end")} as pct_at_offer,
  case when steps = 0 or 100.0::double * trades_at_offer / steps <= 90 then {r4("case when sold_at_bid <> 0 then cast(bought_at_offer as double) / sold_at_bid end")} end as buy_sell_ratio,
  {r4("case when up_moves > 0 then up_shares / up_moves end")} as avg_uptick_shares,
  {r4("case when down_moves > 0 then down_shares / down_moves end")} as avg_downtick_shares,
  {r4("case when up_moves > 0 and down_shares > 0 then (up_shares / up_moves) / (down_shares / down_moves) end")} as uptick_ratio,
  up_moves as n_upticks, down_moves as n_downticks, {r4("turnover / 1000.0::double")} as turnover_kd,
  {r4("case when fm <> 0 then fh / fm end")} as first_half_shares_per_min, {r4("case when sm <> 0 then sh / sm end")} as second_half_shares_per_min,
  {r4("spread")} as avg_spread_fils, {r4("case when close_px > 0 then 100.0::double * spread / close_px end")} as avg_spread_pct,
  cast(peak_hour as int) as peak_hour, minutes_captured, has_close_of_day,
  case when close_px < 100 then 'CRAWLER' end as family,
  case when close_px is not null and high_px is not null then close_px < 100 and high_px >= 100 end as tick_band_crossed, last_close
 from f left join hours using (symbol, trading_date))"""

PRIMARY = "allquotes as (select * from quotes_raw), quotes as (select * from quotes_raw where symbol not in (select symbol from instruments where is_primary = false))"

#: Whether a usable close may be the previous one: no session is too old by default.
NEAR = "true"
DAY = f"""
med as (select trading_date, cast(floor(quantile_cont(minutes_captured, 0.5) + 0.5) as bigint) as market_median from facts group by 1),
ends as (select trading_date, row_number() over (order by trading_date) as nth,
  hour(max(created_at) + to_hours(3)) * 60 + minute(max(created_at)) >= 750 as usable from quotes_raw group by 1),
uc as (select symbol, trading_date, nth, last_close as px, row_number() over (partition by symbol order by trading_date) as k from facts join ends using (trading_date) where usable and last_close is not null),
prev as (
 select f.symbol, f.trading_date, max(u.k) as k from facts f join uc u on u.symbol = f.symbol and u.trading_date < f.trading_date group by 1, 2),
d as (
 select f.*, m.market_median, e.nth,
  floor((case when market_median <> 0 then 100.0::double * minutes_captured / market_median end) * 100 + 0.5) / 100 as coverage_pct,
  case when minutes_captured < 60 or not has_close_of_day or (market_median <> 0 and minutes_captured < 0.8 * market_median) then 'THIN' else 'FULL' end as data_quality,
  case when {NEAR} then u.px end as prev_close, case when {NEAR} then u.trading_date end as prev_session_used,
  {r4("case when u5.px <> 0 then 100.0::double * (close_px - u5.px) / u5.px end")} as chg_5d
 from facts f join med m using (trading_date) join ends e using (trading_date)
 left join prev p using (symbol, trading_date) left join uc u on u.symbol = f.symbol and u.k = p.k left join uc u5 on u5.symbol = f.symbol and u5.k = p.k - 4),
d2 as (
 select *, cast(trading_date - prev_session_used as int) as prev_session_gap_days, close_px - prev_close as chg_fils,
  {r4("case when prev_close <> 0 then 100.0::double * (close_px - prev_close) / prev_close end")} as chg_1d,
  row_number() over (partition by symbol order by trading_date) as place from d),
days as (
 select x.* exclude (nth, place, has_close_of_day, last_close),
  (select count(*) from d2 y where y.symbol = x.symbol and y.nth between x.nth - 19 and x.nth and y.total_volume > 0) as days_active,
  x.place - coalesce((select max(y.place) from d2 y where y.symbol = x.symbol and y.place <= x.place and coalesce(y.chg_fils, 0) >= 0), 0) as down_days
 from d2 x)"""

MARKET = f"""
tdays as (select * from days where symbol not in (select symbol from instruments where not (coalesce(is_primary, true) and market <> 'Auction Market' and broker_status <> 'DELISTED'))),
b as (
 select trading_date, count(*) as symbols_traded, count(*) filter (chg_fils > 0) as advancing, count(*) filter (chg_fils < 0) as declining,
  count(*) filter (chg_fils = 0) as unchanged, count(*) filter (data_quality = 'THIN') as thin_symbols, floor(sum(cast(floor(chg_1d * 10000 + 0.5) as bigint))::double / nullif(count(chg_1d), 0) + 0.5) / 10000 as avg_pct_change,
  cast(sum(total_volume) as bigint) as total_volume, cast(sum(trades) as bigint) as total_trades,
  {r4("quantile_cont(chg_1d, 0.5)")} as median_pct_change, {r4("quantile_cont(chg_1d, 0.1)")} as pct_change_p10, {r4("quantile_cont(chg_1d, 0.9)")} as pct_change_p90
 from tdays group by 1),
norm as (select trading_date, count(*) filter (avg5 > 0 and trades >= 3 * avg5) as symbols_over_3x_daily from (
  select *, avg(trades) over (partition by symbol order by trading_date rows between 5 preceding and 1 preceding) as avg5 from tdays where trades is not null) group by 1),
pairs as (select distinct symbol, trading_date from quotes_raw),
dates as (select trading_date, lag(trading_date) over (order by trading_date) as last_session from (select distinct trading_date from pairs)),
arr as (
 select trading_date,
  (select count(*) from pairs p where p.trading_date = x.trading_date and not exists (select 1 from pairs y where y.symbol = p.symbol and y.trading_date < p.trading_date)) as new_symbols,
  (select count(*) from pairs p where p.trading_date = x.last_session and not exists (select 1 from pairs y where y.symbol = p.symbol and y.trading_date = x.trading_date)) as suspended_symbols
 from dates x),
panel as (select * from summaries where session_state <> 'STALE' qualify row_number() over (partition by trading_date order by captured_at desc) = 1),
m as (
 select b.trading_date, coalesce(p.symbols_traded, b.symbols_traded) as symbols_traded, coalesce(p.advancing, b.advancing) as advancing, coalesce(p.declining, b.declining) as declining,
  coalesce(p.unchanged, b.unchanged) as unchanged, thin_symbols, avg_pct_change, coalesce(p.total_volume, b.total_volume) as total_volume, total_trades,
  median_pct_change, pct_change_p10, pct_change_p90, coalesce(symbols_over_3x_daily, 0) as symbols_over_3x_daily, new_symbols, suspended_symbols,
  b.advancing as computed_advancing, b.declining as computed_declining, b.symbols_traded as computed_symbols, p.captured_at as broker_seen_at
 from b left join norm using (trading_date) left join arr using (trading_date) left join panel p on p.trading_date = b.trading_date),
market as (
 select *, case when pct_advancing < 35 then 'RISK_OFF' when pct_advancing <= 50 then 'NEUTRAL' when pct_advancing is not null then 'RISK_ON' end as regime,
  floor(sum(cast(floor(pct_advancing * 10000 + 0.5) as bigint)) over five / 1.0::double / nullif(count(pct_advancing) over five, 0) + 0.5) / 10000 as breadth_5d_avg,
  case when count(*) over pri >= 20 and avg(coalesce(total_volume, 0)) over pri > 0 then {r4("total_volume / avg(coalesce(total_volume, 0)) over pri")} end as volume_vs_20d
 from (select *, {r4("case when symbols_traded <> 0 then 100.0::double * advancing / symbols_traded end")} as pct_advancing,
   {r4("case when advancing + declining <> 0 then 100.0::double * advancing / (advancing + declining) end")} as pct_advancing_ratio from m)
 window pri as (order by trading_date rows between 20 preceding and 1 preceding), five as (order by trading_date rows between 4 preceding and current row))"""


def _sql(body: str, *more: str) -> str:
    raw = s.SQL["quotes"].strip().replace("quotes as (", "quotes_raw as (", 1)
    return "with " + ",\n".join([raw, s.SQL["instruments"].strip(), s.SQL["summaries"].strip(), *more]) + "\n" + body


QUERIES = {f.__name__: f for f in (session_calendar, session_facts, symbol_day, symbol_day_near, markets_disagree, market_day, symbol_day_with_market)}
ORACLES = {
    "session_calendar": s.with_tables(
        """select p.symbol, p.trading_date, lag(p.trading_date) over (partition by p.symbol order by p.trading_date) as own_prev, prev, prev_5, close_px
 from (select distinct symbol, trading_date from q) p
 join (select trading_date, lag(trading_date) over w as prev, coalesce(lag(trading_date, 5) over w, nullif(first_value(trading_date) over w, trading_date)) as prev_5 from (select distinct trading_date from q) window w as (order by trading_date)) using (trading_date)
 left join (select symbol, trading_date, arg_max(last_price, (created_at, id)) as close_px from q where last_price > 0 and (session is null or session in ('Trading', 'Close Auction Acceptance', 'Trading at Last', 'Close-Of-Day')) group by 1, 2) using (symbol, trading_date)""",
        "quotes",
        more="q as (select * replace (case when symbol = 'S2' and dayofmonth(trading_date) % 3 = 0 then 'S3' else symbol end as symbol) from quotes)",
    ),
    "session_facts": s.with_tables("select * exclude (last_close) from facts", "quotes", more=FACTS),
    "symbol_day": _sql("select * from days", PRIMARY, FACTS.strip(), DAY.strip()),
    "symbol_day_near": _sql("select symbol, trading_date, prev_close, prev_session_used, chg_1d, down_days from days", PRIMARY, FACTS.strip(), DAY.replace("case when true then", "case when e.nth - u.nth <= 2 then").strip()),
    "markets_disagree": s.with_tables(
        """select symbol, trading_date, 'Main Market, Premier Market' as markets from quotes where cast(substr(symbol, 2) as int) % 2 = 0
 group by 1, 2 having count(*) filter (id % 50 = 0) > 0 and count(*) filter (id % 50 <> 0) > 0""",
        "quotes",
    ),
    "market_day": _sql("select * from market", PRIMARY, FACTS.strip(), DAY.strip(), MARKET.strip()),
    "symbol_day_with_market": _sql(
        "select symbol, trading_date, close_px, prev_close, chg_fils, down_days, data_quality, regime, pct_advancing, breadth_5d_avg from days left join market using (trading_date)", PRIMARY, FACTS.strip(), DAY.strip(), MARKET.strip()
    ),
}
