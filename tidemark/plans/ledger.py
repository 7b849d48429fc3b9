"""Orders, registry and wake-up as queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Limits
from ..operators import orders, registry, wakeup
from ..sources import standins as s
from . import signals
from .feeds import LABELLED, labelled


def order_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.fold(s.sightings(spark, sf_dir))


def order_executions_carried(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.fold(s.sightings(spark, sf_dir), carry=True).select("order_id", "executions_observed")


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.positions(order_fold(spark, sf_dir))


def order_fee_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.fee_check(order_fold(spark, sf_dir))


def registry_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.refresh(s.instruments(spark, sf_dir), labelled(spark, sf_dir), s.watchlist(spark, sf_dir)).drop("description", "owner_group")


def registry_contradictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.contradictions(_proposed(spark, sf_dir))


def _proposed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The even symbol of each code proposed as primary, though it was last captured some days before the odd one."""
    k = F.substring("symbol", 2, 9).cast("int")
    last = F.date_sub(F.max("trading_date"), F.max(F.when(k % 4 == 0, 3).when(k % 2 == 0, 1).otherwise(0)))
    activity = s.quotes(spark, sf_dir).groupBy("symbol").agg(last.alias("last_quote"))
    return s.instruments(spark, sf_dir).withColumn("is_primary", k % 2 == 0).join(activity, "symbol", "left")


def registry_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a proposed registry must be refused, and for how many codes."""
    return registry.contradictions(_proposed(spark, sf_dir)).agg(F.countDistinct("key").alias("codes"), (F.count("*") > 0).alias("refused"))


def registry_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry after a batch of captures that names some symbols it doesn't know."""
    q = s.quotes(spark, sf_dir).withColumn("symbol", F.when(F.col("id") % 5 == 0, F.concat(F.lit("N"), "symbol")).otherwise(F.col("symbol")))
    return registry.mark_matched(s.instruments(spark, sf_dir), q).select("symbol", "code", "broker_status")


def registry_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a symbol from many, each column's latest known value."""
    q = labelled(spark, sf_dir).select("symbol", "id", F.when(F.col("id") % 7 != 0, F.col("market")).alias("market"), F.when(F.col("id") % 400 == 3, F.col("session")).alias("session"), "bid")
    return registry.collapse(q, "id")


def registry_members_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbols in more than one owner group, the registry's and another list's together."""
    i = s.instruments(spark, sf_dir).where("owner_group is not null").select("symbol", "owner_group")
    other = s.read(spark, sf_dir, "part").select(F.concat(F.lit("S"), F.col("p_partkey").cast("string")).alias("symbol"), F.concat(F.lit("G"), (F.col("p_partkey") % 3).cast("string")).alias("owner_group"))
    return registry.members_twice(i.unionByName(other))


def registry_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = labelled(spark, sf_dir).join(s.instruments(spark, sf_dir).select("symbol", "code"), "symbol", "left")
    latest = q.withColumns({"symbol": F.when(F.col("symbol") == "S4", "Q4").otherwise(F.col("symbol")), "created_at": F.struct("created_at", "id")})
    return registry.seed(latest, s.instruments(spark, sf_dir))


def owner_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.groups(s.instruments(spark, sf_dir))


def activity_pace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wakeup.pace(s.quotes(spark, sf_dir), 12)


#: Lower thresholds than live ones, as the stand-in symbols trade evenly.
EVEN = Limits(pace_min=1.05, trades_min=3, wakeup_slots=(4, 5))


def wakeup_promotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = s.quotes(spark, sf_dir)
    scans = [wakeup.pace(q, h, until_hour=True).withColumn("scan", F.lit(h)) for h in (9, 11, 13, 15)]
    return wakeup.scan(reduce(DataFrame.unionByName, scans), EVEN)


def alerts_sent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wakeup.throttled(signals.signals(spark, sf_dir).drop("detail"), Limits(throttle_secs=600))


def _fold(carry: bool) -> str:
    before = "last_value(filled_quantity ignore nulls) over (partition by order_id order by seq rows between unbounded preceding and 1 preceding)" if carry else "lag(filled_quantity) over (partition by order_id order by seq)"
    return f"""
folded as (
 select order_id, arg_max(order_status, seq) as order_status, arg_max(price, seq) as price, arg_max(quantity, seq) as quantity, arg_max(struct_pack(v := filled_quantity), seq).v as filled_quantity,
  arg_max(symbol, seq) filter (symbol is not null) as symbol, arg_max(side, seq) as side, arg_max(order_value, seq) as order_value, arg_max(net_value, seq) as net_value, arg_max(trading_date, seq) as trading_date,
  1 + count(*) filter (filled_quantity > before) as executions_observed, count(*) as sighting_count, min(seq) as first_seen, max(seq) as last_seen
 from (select *, {before} as before from sightings) group by 1)"""


PACE = """
day as (
 select symbol, trading_date, max(trades) as trades, max(trades) filter (hour(created_at + to_hours(3)) <= 12) as by_hour from quotes where trades is not null group by 1, 2),
nth as (select trading_date, row_number() over (order by trading_date) as n from (select distinct trading_date from quotes)),
pace as (
 select x.symbol, x.trading_date, x.trades, quantile_cont(y.by_hour, 0.5) as median_trades, count(y.by_hour) as sessions
 from (select * from day join nth using (trading_date)) x left join (select * from day join nth using (trading_date)) y on y.symbol = x.symbol and y.n between x.n - 10 and x.n - 1 group by all)"""
PROPOSED = """x as (
 select i.*, cast(substr(i.symbol, 2) as int) % 2 = 0 as prim, last_quote from instruments i
 left join (select symbol, cast(max(trading_date) - case when cast(substr(symbol, 2) as int) % 4 = 0 then 3 when cast(substr(symbol, 2) as int) % 2 = 0 then 1 else 0 end as date) as last_quote from quotes group by symbol) using (symbol))"""
SCANS = """
hours(scan) as (values (9), (11), (13), (15)),
day as (select symbol, trading_date, scan, max(trades) as trades from quotes, hours where trades is not null and hour(created_at + to_hours(3)) <= scan group by 1, 2, 3),
nth as (select trading_date, row_number() over (order by trading_date) as n from (select distinct trading_date from quotes)),
pace as (
 select x.symbol, x.trading_date, x.scan, x.trades, quantile_cont(y.trades, 0.5) as med
 from (select * from day join nth using (trading_date)) x left join (select * from day join nth using (trading_date)) y on y.symbol = x.symbol and y.scan = x.scan and y.n between x.n - 10 and x.n - 1 group by all),
firing as (
 select *, row_number() over (partition by trading_date order by scan, pace desc, symbol) as k
 from (select symbol, trading_date, scan, trades, floor((case when med > 0 then trades / med end) * 1000 + 0.5) / 1000 as pace from pace) where pace >= 1.05 and trades >= 3),
-- two slots: who holds them and how fast, after each candidate in turn
held as (
 select trading_date, 0::bigint as k, null::varchar as a, null::double as pa, null::varchar as b, null::double as pb, null::int as slot, null::varchar as replaced from (select distinct trading_date from firing)
 union all
 select f.trading_date, f.k, case when slot_ = 4 then f.symbol else a end, case when slot_ = 4 then f.pace else pa end, case when slot_ = 5 then f.symbol else b end, case when slot_ = 5 then f.pace else pb end,
  slot_, case slot_ when 4 then a when 5 then b end
 from (
  select h.*, f.k as fk, case when f.symbol in (h.a, h.b) and f.symbol is not null and (f.symbol = h.a or f.symbol = h.b) then null when h.a is null then 4 when h.b is null then 5
   when h.pa <= h.pb then case when f.pace > h.pa then 4 end when f.pace > h.pb then 5 end as slot_
  from held h join firing f on f.trading_date = h.trading_date and f.k = h.k + 1) h join firing f on f.trading_date = h.trading_date and f.k = h.fk)"""
PROMOTED = "select trading_date, scan, symbol, trades, pace, slot, replaced from held join firing using (trading_date, k) where slot is not null"
SENT = """
queue as (
 select *, row_number() over (partition by symbol, signal, trading_date order by fired_at, id) as nth,
  min(fired_at) over (partition by symbol, signal, trading_date order by fired_at range between interval 600 seconds following and unbounded following) as due
 from signals),
heads as (select * from queue qualify row_number() over (partition by symbol, signal, trading_date, fired_at order by nth) = 1),
sent as (select * from heads where nth = 1 union all select h.* from sent s join heads h on h.symbol = s.symbol and h.signal = s.signal and h.trading_date = s.trading_date and h.fired_at = s.due)"""
REFRESH = """
act as (select symbol, count(*) as quote_rows, max(trading_date) as last_quote, coalesce(bool_or(last_price > 0) filter (trading_date >= (select min(trading_date) from (select distinct trading_date from quotes order by 1 desc limit 5))), false) as priced,
  coalesce(bool_or(trading_date >= (select min(trading_date) from (select distinct trading_date from quotes order by 1 desc limit 5))), false) as recent,
  arg_max(struct_pack(m := market, d := trading_date), (created_at, id)) as l from labelled group by 1),
r1 as (
 select i.symbol, code, superseded_by, coalesce(quote_rows, 0) as quote_rows, last_quote, case when l.m is not null and l.m is distinct from market then l.d end as market_changed_on,
  coalesce(l.m, market) as market, broker_status as was,
  case when broker_status = 'DELISTED' then case when priced then 'CAPTURED' else 'DELISTED' end when recent then 'CAPTURED' else 'ABSENT' end as broker_status
 from instruments i left join act using (symbol)),
r2 as (
 select *, superseded_by is null and (broker_status = 'DELISTED' or (quote_rows > 0 and row_number() over (partition by coalesce(code, symbol)
  order by superseded_by is not null, quote_rows > 0 desc, last_quote desc nulls last, quote_rows desc, symbol) = 1)) as is_primary from r1)"""

QUERIES = {f.__name__: f for f in (order_fold, order_executions_carried, positions, order_fee_check, registry_refresh, registry_contradictions, registry_refused, registry_matched, registry_collapsed, registry_members_twice, registry_seed, owner_groups, activity_pace, wakeup_promotions, alerts_sent)}
ORACLES = {
    "order_fold": s.with_tables("select * from folded", "sightings", more=_fold(False)),
    "order_executions_carried": s.with_tables("select order_id, executions_observed from folded", "sightings", more=_fold(True)),
    "positions": s.with_tables(
        """select symbol, trading_date, cast(sum(case when side = 'BUY' then filled_quantity else 0 end) as bigint) as bought, cast(sum(case when side = 'SELL' then filled_quantity else 0 end) as bigint) as sold,
 cast(sum(case side when 'BUY' then filled_quantity when 'SELL' then -filled_quantity else 0 end) as bigint) as net_qty, cast(sum(case side when 'SELL' then net_value when 'BUY' then -net_value else 0 end) as bigint) as net_pnl,
 cast(sum(executions_observed) as bigint) as executions, count(*) as orders from folded where filled_quantity > 0 group by 1, 2""",
        "sightings",
        more=_fold(False),
    ),
    "order_fee_check": s.with_tables(
        """select order_id, symbol, side, executions_observed, fee_charged, floor(fee * 10000 + 0.5) / 10000 as fee_per_execution, floor(med * 10000 + 0.5) / 10000 as median_fee, coalesce(med > 0 and fee > med * 2, false) as executions_likely_understated
 from e, (select quantile_cont(fee, 0.5) as med from e where fee_charged > 0)""",
        "sightings",
        more=_fold(False) + ", e as (select *, abs(net_value - order_value) as fee_charged, abs(net_value - order_value) / greatest(executions_observed, 1)::double as fee from folded where filled_quantity > 0)",
    ),
    "registry_refresh": s.with_tables(
        """select r2.symbol, code, superseded_by, quote_rows, last_quote, market_changed_on, market, broker_status, was is distinct from broker_status as status_changed, is_primary,
 case when w.symbol is not null then 'CAPTURED' else 'ABSENT' end as tv_status, is_primary and market <> 'Auction Market' and broker_status <> 'DELISTED' as is_tradeable
 from r2 left join (select distinct symbol from watchlist where trading_date = (select max(trading_date) from watchlist)) w using (symbol)""",
        "quotes", "instruments", "watchlist",
        more=LABELLED + "," + REFRESH,
    ),
    "registry_contradictions": s.with_tables(
        """select coalesce(p.code, p.symbol) as key, p.symbol as "primary", p.last_quote as primary_quote, o.symbol as other, o.last_quote as other_quote from x p join x o on coalesce(p.code, p.symbol) = coalesce(o.code, o.symbol)
 where p.prim and p.broker_status <> 'DELISTED' and not o.prim and o.last_quote is not null and (p.last_quote is null or o.last_quote > p.last_quote)""",
        "quotes", "instruments",
        more=PROPOSED,
    ),
    "registry_refused": s.with_tables(
        """select count(distinct coalesce(p.code, p.symbol)) as codes, count(*) > 0 as refused from x p join x o on coalesce(p.code, p.symbol) = coalesce(o.code, o.symbol)
 where p.prim and p.broker_status <> 'DELISTED' and not o.prim and o.last_quote is not null and (p.last_quote is null or o.last_quote > p.last_quote)""",
        "quotes", "instruments",
        more=PROPOSED,
    ),
    "registry_matched": s.with_tables(
        """select coalesce(i.symbol, b.symbol) as symbol, code, case when broker_status = 'DELISTED' then 'DELISTED' when b.symbol is not null and i.symbol is not null then 'CAPTURED' when b.symbol is not null then 'UNMATCHED' else broker_status end as broker_status
 from instruments i full join (select distinct case when id % 5 = 0 then 'N' || symbol else symbol end as symbol from quotes) b on i.symbol = b.symbol""",
        "quotes", "instruments",
    ),
    "registry_collapsed": s.with_tables(
        """select symbol, arg_max(market, id) filter (id % 7 <> 0) as market, arg_max(session, id) filter (id % 400 = 3 and session is not null) as session, arg_max(bid, id) filter (bid is not null) as bid from labelled group by 1""",
        "quotes",
        more=LABELLED,
    ),
    "registry_members_twice": s.with_tables(
        """select symbol, count(distinct g) as groups from (select symbol, owner_group as g from instruments where owner_group is not null union all select 'S' || p_partkey, 'G' || p_partkey % 3 from part) group by 1 having count(distinct g) > 1""",
        "instruments",
    ),
    "wakeup_promotions": s.with_tables(PROMOTED, "quotes", more=SCANS).replace("with ", "with recursive ", 1),
    "alerts_sent": s.with_tables(
        "select symbol, trading_date, fired_at, id, signal, price from sent", "quotes", more=signals.SNAPSHOTS + "," + signals.SIGNALS + "," + SENT
    ).replace("with ", "with recursive ", 1),
    "registry_seed": s.with_tables(
        """select coalesce(b.symbol, i.symbol) as symbol, b.market, b.code, i.description, b.symbol is not null as in_broker, i.symbol is not null as in_other
 from (select case when q.symbol = 'S4' then 'Q4' else q.symbol end as symbol, arg_max(q.market, (created_at, id)) as market, max(n.code) as code from labelled q left join instruments n using (symbol) group by 1) b full join instruments i on i.symbol = b.symbol""",
        "quotes", "instruments",
        more=LABELLED,
    ),
    "owner_groups": s.with_tables("select owner_group, count(*) as members, string_agg(symbol, ', ' order by symbol) as symbols from instruments where owner_group is not null group by 1", "instruments"),
    "activity_pace": s.with_tables("select *, floor((case when median_trades > 0 then trades / median_trades end) * 1000 + 0.5) / 1000 as pace from pace", "quotes", more=PACE),
}
