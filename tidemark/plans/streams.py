"""Stateful streams as queries: stored rows land in parts, and each run takes up the state that the last one left."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Limits
from ..operators import minute, wakeup
from ..sources import folders
from ..sources import standins as s
from ..streaming import capture as streams
from ..streaming import stateful
from . import bars, ledger, payloads, signals

END = "timestamp'2100-01-01'"


def _timed(rows: DataFrame, *names: str) -> DataFrame:
    """Instants as a stream needs them, with a time zone."""
    return rows.withColumns({n: F.col(n).cast("timestamp") for n in names})


def _plain(rows: DataFrame, *names: str) -> DataFrame:
    return rows.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


def _clock(rows: DataFrame, at: str) -> DataFrame:
    """One row that only moves the clock to the end of time."""
    kinds = dict(rows.dtypes)
    return rows.sparkSession.range(1).select(*(F.expr(END if c == at else f"cast(null as {kinds[c]})").alias(c) for c in rows.columns))


def streamed_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots of all captures, written by a stream that is stopped and started again."""
    q = _timed(s.quotes(spark, sf_dir), "created_at")
    out = streams.replay(q, "created_at", stateful.snapshots, folders.shared(spark))
    return _plain(out, "ts")


def _frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial frames: a price, a bid, an offer or none, a frame every seven seconds, most symbols once in a few minutes."""
    e = payloads._events(spark, sf_dir)
    value = lambda kind: F.when(F.col("event_type") == kind, F.col("v")).cast("double")
    symbol = F.concat(F.when(F.col("u") % 7 == 0, " z").otherwise(" s"), (F.col("u") % 60).cast("string"))
    return e.select(symbol.alias("symbol"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("n") * 7).alias("ts"), value("view").alias("last"), value("click").alias("bid"), value("purchase").alias("offer"))


def streamed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The board with the age of each field, by name from the symbol master; a field not sent for an hour is unknown again."""
    master = payloads._master(spark, sf_dir)
    make = lambda f: stateful.listed(stateful.board(f, ("last", "bid", "offer"), expiry_secs=3600), master)
    out = streams.replay(_frames(spark, sf_dir), "ts", make, folders.shared(spark), ["alias"], "update")
    return _plain(out, "ts")


def streamed_minute_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minute bars with each minute's own volume, from two stateful operators in a chain."""
    q = _timed(s.quotes(spark, sf_dir).select("id", "symbol", "trading_date", "created_at", "last_price", "volume"), "created_at")
    out = streams.replay(q, "created_at", stateful.minute_volumes, folders.shared(spark), closing=_clock(q, "created_at").withColumn("last_price", F.lit(0.0)))
    return _plain(out.where("symbol is not null"), "minute")


SEEDS = ((1, "S0"), (2, "S1"), (3, "S2"))


def streamed_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots won and released in each session, from a stream of paces; three slots are seeded."""
    q = s.quotes(spark, sf_dir)
    scans = [wakeup.pace(q, h, until_hour=True).withColumn("scan", F.lit(h)) for h in (9, 11, 13, 15)]
    at = F.col("trading_date").cast("timestamp") + F.make_dt_interval(hours=F.col("scan"))
    paces = reduce(DataFrame.unionByName, scans).select("trading_date", at.alias("at"), "scan", "symbol", "trades", "pace")
    seeds = q.select("trading_date").distinct().withColumn("x", F.explode(F.array(*(F.struct(F.lit(n).alias("slot"), F.lit(x).alias("symbol")) for n, x in SEEDS)))).select("trading_date", "x.slot", "x.symbol")
    make = lambda p: stateful.slots(p, seeds, ledger.EVEN)
    return streams.replay(paces, "at", make, folders.shared(spark), closing=_clock(paces, "at"))


def streamed_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals with their later prices: what is asked for is answered when the stream is past the answer."""
    rows = signals.book_snapshots(spark, sf_dir)
    fired = minute.signals(rows).select("symbol", "trading_date", F.col("fired_at").alias("ts"), "id", "signal", "price", F.lit(None).cast("double").alias("px"))
    prices = rows.select("symbol", "trading_date", "ts", "id", F.lit(None).cast("string").alias("signal"), F.lit(None).cast("double").alias("price"), F.col("last_price").alias("px"))
    seen = _timed(fired.unionByName(prices), "ts")
    out = streams.replay(seen, "ts", stateful.scores, folders.shared(spark), closing=_clock(seen, "ts"))
    return _plain(out.drop("scored"), "fired_at")


QUERIES = {f.__name__: f for f in (streamed_snapshots, streamed_fields, streamed_minute_volumes, streamed_slots, streamed_scores)}

FIRSTS = "firsts as (select * from quotes qualify row_number() over (partition by symbol, trading_date, created_at order by id) = 1)"
SEEDED = "seeded(slot, symbol) as (values " + ", ".join(f"({n}, '{x}')" for n, x in SEEDS) + ")"
ORACLES = {
    "streamed_snapshots": s.with_tables("select * from snaps", "quotes", more=FIRSTS + "," + signals.SNAPSHOTS.replace("from quotes", "from firsts")),
    "streamed_fields": f"""with {payloads.EVENTS}, {payloads.MASTER},
f as (
 select upper(case when u % 7 = 0 then 'z' else 's' end || u % 60) as alias, 1700000000 + n * 7 as sec, case when event_type = 'view' then v end as last, case when event_type = 'click' then v end as bid, case when event_type = 'purchase' then v end as offer from e),
g as (
 select alias, max(sec) as seen, {", ".join(f"max(sec) filter ({x} is not null) as {x}_at, arg_max({x}, sec) filter ({x} is not null)::double as {x}" for x in ("last", "bid", "offer"))} from f group by 1),
h as (select alias, seen, {", ".join(f"case when seen - {x}_at <= 3600 then {x} end as {x}, case when seen - {x}_at <= 3600 then seen - {x}_at end as {x}_age_secs" for x in ("last", "bid", "offer"))} from g)
select alias, make_timestamp(seen * 1000000) as ts, last, bid, offer, last_age_secs, bid_age_secs, offer_age_secs, coalesce(last_age_secs > 300, true) as stale, symbol, code, description, market from h join master using (alias)""",
    "streamed_minute_volumes": bars.sql("select * from bars", bars.BARS),
    "streamed_slots": s.with_tables(
        """select trading_date, scan, 'PROMOTED' as event, slot, 'WAKEUP' as slot_type, symbol, trades, pace, replaced from won
 union all select trading_date, null, 'RELEASED', slot, 'WAKEUP', arg_max(symbol, k), null, arg_max(pace, k), null from won group by 1, 4
 union all select trading_date, null, 'RELEASED', slot, 'PREDAY', symbol, null, null, null from (select distinct trading_date from quotes), seeded""",
        "quotes",
        more=ledger.SCANS + ", won as (select trading_date, k, scan, symbol, trades, pace, slot, replaced from held join firing using (trading_date, k) where slot is not null), " + SEEDED,
    ).replace("with ", "with recursive ", 1),
    "streamed_scores": signals.ORACLES["signal_scores"],
}
