"""Bars, swings and retracements as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import LIMITS
from ..operators import bars
from ..sources import standins as s


def minute_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.minute_bars(s.quotes(spark, sf_dir))


def daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.daily_bars(s.quotes(spark, sf_dir))


def volume_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.volume_profile(minute_bars(spark, sf_dir))


def swings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.swings(minute_bars(spark, sf_dir))


def swing_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.swing_stats(swings(spark, sf_dir))


def retracements(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = minute_bars(spark, sf_dir)
    return bars.retracements(b, bars.swings(b))


def retracement_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.retracement_stats(retracements(spark, sf_dir))


def daily_study(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.daily_study(s.quotes(spark, sf_dir))


def r(x: str, places: int = 4) -> str:
    return f"floor(({x}) * {10**places} + 0.5) / {10**places}"


BARS = """
raw as (
 select symbol, trading_date, date_trunc('minute', created_at) as minute, arg_min(last_price, (created_at, id)) as open, max(last_price) as high,
  min(last_price) as low, arg_max(last_price, (created_at, id)) as close, max(volume) as cum
 from quotes where last_price is not null group by all),
bars as (
 select symbol, trading_date, minute, open, high, low, close, greatest(0, coalesce(cum, had) - had) as vol from (
  select *, coalesce(max(cum) over (partition by symbol, trading_date order by minute rows between unbounded preceding and 1 preceding), 0) as had from raw))"""
SWINGS = f"""
seq as (select *, row_number() over w - 1 as place, lag(close) over w as last, nullif(sign(close - lag(close) over w), 0) as way from bars window w as (partition by symbol, trading_date order by minute)),
turns as (select *, case when way is not null and way is distinct from last_value(way ignore nulls) over (partition by symbol, trading_date order by minute rows between unbounded preceding and 1 preceding) then 1 else 0 end as turn from seq),
runs as (select *, sum(turn) over (partition by symbol, trading_date order by minute) as run from turns),
swings as (
 select symbol, trading_date, case when sz > 0 then 'bull' else 'bear' end as direction, {r("abs(sz)", 3)} as size, cast(a as int) as start_idx, cast(z as int) as end_idx, start_price, end_price from (
  select symbol, trading_date, run, min(place) - 1 as a, max(place) as z, arg_min(last, place) as start_price, arg_max(close, place) as end_price, arg_max(close, place) - arg_min(last, place) as sz
  from runs where run > 0 group by all) where abs(sz) >= 2)"""
STATS = f"""
tgt as (select *, {r("greatest(2.0::double, avg(size) over (partition by symbol, trading_date) * 0.75::double)", 2)} as target,
  row_number() over (partition by symbol, trading_date order by start_idx) - row_number() over (partition by symbol, trading_date, direction order by start_idx) as grp from swings),
lens as (select symbol, trading_date, max(n) filter (direction = 'bull') as lb, max(n) filter (direction = 'bear') as le from (select symbol, trading_date, direction, grp, count(*) as n from tgt group by all) group by 1, 2),
stats as (
 select symbol, trading_date, count(*) filter (direction = 'bull') as bull_swings, count(*) filter (direction = 'bear') as bear_swings, count(*) as total_swings,
  count(*) filter (direction = 'bull' and size >= target) as tradable_bull_swings, coalesce(max(size) filter (direction = 'bull'), 0) as largest_bull_swing,
  coalesce(max(size) filter (direction = 'bear'), 0) as largest_bear_swing, {r("avg(size)", 3)} as avg_swing_size,
  case when count(*) > 1 then {r("(max(start_idx) - min(start_idx)) / (count(*) - 1)::double", 2)} else 0 end as avg_time_btwn_swings,
  cast(coalesce(max(lb), 0) as int) as longest_bull_run, cast(coalesce(max(le), 0) as int) as longest_bear_run, max(target) as auto_target_fils
 from tgt join lens using (symbol, trading_date) group by 1, 2)"""
LEVELS = ", ".join(f"{x}::double" for x in LIMITS.fib_levels)
FIB = f"""
closes as (select symbol, trading_date, list(close order by minute) as cl from bars group by 1, 2),
lv as (
 select t.*, cl, level, {r("greatest(start_price, end_price) - level * (greatest(start_price, end_price) - least(start_price, end_price))", 3)} as fib_price
 from tgt t join closes using (symbol, trading_date), (select unnest([{LEVELS}]) as level)),
touch as (select *, cl[entry_minute + 1] as entry_px from (select *, end_idx + nullif(coalesce(list_position(list_transform(cl[end_idx + 1:], lambda p: abs(p - fib_price) <= 0.5), true), 0), 0) - 1 as entry_minute from lv) where entry_minute is not null),
res as (select *, entry_minute + nullif(coalesce(list_position(list_transform(cl[entry_minute + 1:], lambda p: p >= entry_px + target), true), 0), 0) - 1 as win_at,
  entry_minute + nullif(coalesce(list_position(list_transform(cl[entry_minute + 1:], lambda p: p <= entry_px - target), true), 0), 0) - 1 as stop_at from touch),
fib as (
 select symbol, trading_date, start_idx, level, fib_price, cast(entry_minute as int) as entry_minute, entry_px, w as win,
  {r("cl[1 + case when w then win_at else coalesce(stop_at, len(cl) - 1) end] - entry_px", 3)} as profit, cast(case when w then win_at - entry_minute end as int) as mins
 from (select *, win_at is not null and (stop_at is null or win_at < stop_at) as w from res))"""
FIB_STATS = f"""
hrs as (select symbol, trading_date, arg_max(hour, (rate, -hour)) as best from (select symbol, trading_date, entry_minute // 60 as hour, count(*) filter (win) / count(*) as rate from fib group by all) where rate > 0 group by 1, 2),
fs as (
 select symbol, trading_date, count(*) as fib_signals, count(*) filter (win) as successful_fib, {r("count(*) filter (win) / count(*)::double * 100.0::double", 2)} as fib_win_pct,
  coalesce({r("avg(profit) filter (win)", 3)}, 0) as avg_profit_fib, coalesce({r("avg(abs(profit)) filter (not win)", 3)}, 0) as avg_loss_fib,
  coalesce({r("avg(mins)", 2)}, 0) as avg_time_to_target, {r("count(*) filter (not win) / count(*)::double * 100.0::double", 2)} as false_signal_pct
 from fib group by 1, 2),
fibstats as (select fs.*, lpad(cast(coalesce(best, 0) + 6 as varchar), 2, '0') || ':00' as best_earning_time from fs left join hrs using (symbol, trading_date))"""
PROFILE = f"""
pd as (select *, avg(vol) over (partition by symbol, trading_date) as mean, close - lag(close) over (partition by symbol, trading_date order by minute) as delta from bars),
pg as (select symbol, trading_date, {r("avg(vol)", 2)} as avg_vol_min, max(vol) as highest_volume, count(*) filter (vol > 2 * mean) as vol_spike_count,
  coalesce(sum(case when delta > 0 then vol when delta = 0 then vol / 2 end), 0)::double as buyer, coalesce(sum(case when delta < 0 then vol when delta = 0 then vol / 2 end), 0)::double as seller from pd group by 1, 2),
profile as (select symbol, trading_date, avg_vol_min, highest_volume, vol_spike_count, cast(floor(buyer + 0.5) as bigint) as est_buyer_vol, cast(floor(seller + 0.5) as bigint) as est_seller_vol,
  case when buyer + seller <> 0 then {r("buyer / (buyer + seller) * 100.0::double", 2)} else 0 end as buyer_pct, case when buyer + seller <> 0 then {r("seller / (buyer + seller) * 100.0::double", 2)} else 0 end as seller_pct from pg)"""
STUDY = """
dayb as (select symbol, trading_date, arg_min(open, minute) as day_open, arg_max(close, minute) as day_close, max(high) as day_high, min(low) as day_low, cast(sum(vol) as bigint) as total_volume, count(*) as bars from bars group by 1, 2 having count(*) >= 5)"""
ZERO = "coalesce({0}, 0) as {0}".format
STUDY_COLUMNS = (
    "bull_swings bear_swings total_swings tradable_bull_swings largest_bull_swing largest_bear_swing avg_swing_size avg_time_btwn_swings longest_bull_run longest_bear_run"
    " fib_signals successful_fib fib_win_pct avg_profit_fib avg_loss_fib avg_time_to_target false_signal_pct"
).split()


def sql(body: str, *parts: str) -> str:
    return s.with_tables(body, "quotes", more=",\n".join(p.strip() for p in parts))


QUERIES = {f.__name__: f for f in (minute_bars, daily_bars, volume_profile, swings, swing_stats, retracements, retracement_stats, daily_study)}
ORACLES = {
    "minute_bars": sql("select * from bars", BARS),
    "daily_bars": s.with_tables(
        f"""select *, close_price - open_price as change_value, {r("case when open_price > 0 then (close_price - open_price) / open_price * 100.0::double end")} as change_pct from (
 select symbol, trading_date, arg_min(last_price, (created_at, id)) as open_price, max(last_price) as high_price, min(last_price) as low_price,
  arg_max(last_price, (created_at, id)) as close_price, max(volume) as volume, count(*) as captures
 from quotes where last_price is not null group by 1, 2 having count(*) >= 10)""",
        "quotes",
    ),
    "volume_profile": sql("select * from profile", BARS, PROFILE),
    "swings": sql("select * from swings", BARS, SWINGS),
    "swing_stats": sql("select * from stats", BARS, SWINGS, STATS),
    "retracements": sql("select * from fib", BARS, SWINGS, STATS, FIB),
    "retracement_stats": sql("select * from fibstats", BARS, SWINGS, STATS, FIB, FIB_STATS),
    "daily_study": sql(
        f"""select symbol, trading_date, day_open, day_close, day_high, day_low, total_volume, bars, day_close - day_open as oc_margin, day_high - day_low as day_range,
 profile.* exclude (symbol, trading_date), {", ".join(map(ZERO, STUDY_COLUMNS))}, coalesce(auto_target_fils, 2) as auto_target_fils, coalesce(best_earning_time, '06:00') as best_earning_time
 from dayb join profile using (symbol, trading_date) left join stats using (symbol, trading_date) left join fibstats using (symbol, trading_date)""",
        BARS, PROFILE, SWINGS, STATS, FIB, FIB_STATS, STUDY,
    ),
}
