"""Capture sources as queries: pushed batches, ladders, grids, daily tables, the symbol master, and streams with state.

Each query writes the driver's rows in the way that a source would, and reads them back through the source's mapping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parsing as p
from ..operators import quality, runs
from ..sources import capture, folders
from ..sources import standins as s
from ..streaming import capture as streams


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = s.read(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("n"), F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("user_id").alias("u"), F.floor("value").alias("v"), "event_type", F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"))


def _text(*parts: Column | str | int) -> Column:
    return F.concat(*((F.lit(x) if isinstance(x, str) else x).cast("string") for x in parts))


def _record(**given: Column) -> Column:
    """A pushed record: every field is a text, most are missing."""
    return F.struct(*(given.get(c, F.lit(None)).cast("string").alias(c) for c in capture.TEXT))


def _batches(e: DataFrame, records: list[Column] | None = None, levels: list[Column] | None = None) -> DataFrame:
    """One batch for each event; some without an instant, ``now`` from five minutes before to 34 after it."""
    none = F.array().cast(f"array<struct<{', '.join(f'{c}: string' for c in capture.TEXT)}>>")
    n = F.col("n")
    return e.select(
        "*",
        _text("b", n).alias("batchId"),
        F.when(n % 11 != 0, F.col("ts")).alias("capturedAt"),
        F.when(n % 3 == 0, "client").alias("source"),
        F.when(n % 10 != 0, _text("kse:s", F.col("u"))).alias("symbol"),
        F.lit("c0").alias("code"),
        (F.array(*records) if records else F.when(F.lit(False), none)).alias("records"),
        (F.array(*levels) if levels else F.when(F.lit(False), none)).alias("levels"),
        (F.col("ts") + F.make_dt_interval(mins=n % 40 - 5)).alias("now"),
    )


def pushed_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes of fresh batches: the rest came too late or from the future."""
    n, u, v, k = (F.col(c) for c in "nuvk")
    whole = _record(
        symbol=_text("KSE:s", u, "  Al X"),
        market=F.when(n % 3 == 0, "P").when(n % 3 == 1, " m ").otherwise("Other"),
        code=F.when(n % 4 == 0, " - ").otherwise(_text(" c", u, " ")),
        last=F.when(n % 2 == 0, _text("(", v, ")")).otherwise(_text(v, " KWF")),
        chg=F.when(n % 5 == 0, _text("−", n % 7)).otherwise(_text("+", n % 7, ".5")),
        pctChg=_text(n % 9, "%"),
        volume=_text(k, "K"),
        trades=_text(k),
        lastQty=F.lit(""),
        bid=F.when(n % 6 == 0, "n/a").otherwise(_text(v + 1)),
        bidQty=F.format_number(n * 1000, 0),
        offer=_text(v + 2),
        offerQty=F.lit("--"),
        session=F.lit("Trading"),
        lastTradeTime=_text("at ", n % 24, ":", n % 60),
    )
    b = _batches(_events(spark, sf_dir), records=[whole, _record(symbol=_text(" s", u, "-B "))])
    return capture.quotes(capture.fresh(b, F.col("now")))


def pushed_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, u, v = (F.col(c) for c in "nuv")
    levels = [
        _record(level=F.lit("7"), bid=_text(v), bidQty=F.lit("5K"), bidOrders=F.lit("2"), ask=_text(v + 3)),
        _record(symbol=_text("x", u), code=F.lit("d"), bidPrice=F.lit("1,000"), offerPrice=_text(v), offerQty=_text(n), offerOrders=F.lit("-")),
        _record(level=F.lit("x"), bid=F.lit("—"), offer=_text(v, ".25")),
    ]
    return capture.depth(_batches(_events(spark, sf_dir), levels=levels))


def pushed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, u, v = (F.col(c) for c in "nuv")
    one = _record(
        orderId=F.when(n % 9 == 0, "-").otherwise(_text(" o", n)),
        symbolRaw=_text("s", u, " - name"),
        side=F.when(n % 4 == 0, "Buy").when(n % 4 == 1, "sell").when(n % 4 == 2, "hold").otherwise("-"),
        status=F.lit(" Filled "),
        price=_text("-", v),
        quantity=F.lit("10"),
        filled=F.when(n % 3 == 0, "4").when(n % 3 == 1, "12"),
        remaining=F.when(n % 5 == 0, "1.5"),
        avgPrice=_text(v, ".5"),
        orderValue=F.lit("1,5"),
        netValue=_text("(", n, ")"),
        orderTime=F.when(n % 3 == 0, "9:05").when(n % 3 == 1, "25-08-2026 10:00:30").otherwise("2026-08-25T10:00:30+05:00"),
    )
    return capture.orders(_batches(_events(spark, sf_dir), records=[one]).where("capturedAt is not null"))


def ladder_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, n = F.col("v"), F.col("n")
    cell = lambda price, qty: F.struct(_text(price).alias("price"), _text(qty).alias("qty"))
    cells = _events(spark, sf_dir).select(
        _text("S", n).alias("symbol"), F.col("ts").alias("created_at"),
        F.array(cell(v + 2, n), cell(v, "1K"), cell(v + 1, "-")).alias("bids"), F.array(cell(v + 5, n), cell(v + 4, "2")).alias("offers"),
    )
    return capture.ladder(cells)


def order_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders from a grid whose rows are rendered in two halves, one cell after another."""
    o, key = s.read(spark, sf_dir, "orders"), F.col("o_orderkey")
    cell = lambda name, text: F.struct(F.lit(name).alias("cell"), text.alias("text"))
    cells = F.array(cell("orderId", F.when(key % 13 == 0, "-").otherwise(_text("o", key))), cell("status", F.col("o_orderstatus")), cell("price", _text(F.floor("o_totalprice"))), cell("noise", F.lit("x")))
    halves = o.select(_text("p", key % 7).alias("page"), key.alias("top"), F.explode(cells).alias("c")).select("page", "top", "c.cell", "c.text")
    return capture.grid(halves, ("orderId", "status", "price"))


def daily_table_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, key, px = s.read(spark, sf_dir, "orders"), F.col("o_orderkey"), F.floor("o_totalprice")
    day = F.to_date("o_orderdate")
    rows = o.select(
        _text("S", F.col("o_custkey") % 10).alias("symbol"),
        key.alias("pos"),
        F.when(key % 3 == 0, _text(F.datediff(day, F.lit("1970-01-01").cast("date")).cast("long") * 86400 + 3600)).alias("unix"),
        F.concat(F.lit("‪"), F.date_format(day, "d MMM yyyy")).alias("date_text"),
        F.array(F.when(key % 19 == 0, "N/A").otherwise(_text(px)), F.format_number(px + 9, 0), _text(px + F.when(key % 17 == 0, 10).otherwise(-9)), _text(px + 1), _text("+", key % 5, ".5%"), F.when(key % 4 == 0, "").otherwise(_text(key, ".5"))).alias("values"),
    )
    return capture.daily_table(rows, ["Date", "Open", "High", "Low", "Price", "Change %", "Vol"], "1993-01-01", "1997-12-31")


def _master(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    row = F.concat_ws("|", _text("s", k), F.when(k % 5 == 0, "").otherwise(_text("S", k)), F.when(k % 7 == 0, " ").otherwise(_text(F.floor(k / 2))), F.col("p_name"), F.element_at(F.array(*map(F.lit, "PMBZ")), (k % 4 + 1).cast("int")), _text("f", k % 50))
    tables = s.read(spark, sf_dir, "part").select(F.lit("SYMBOL|SHRT_DSC|COMPANY_CODE|SYMBOL_DESCRIPTION|MARKET_ID|CFID").alias("header"), F.array(row).alias("rows"))
    return capture.symbol_master(tables)


def symbol_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _master(spark, sf_dir)


def _frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial frames: a price, a volume or neither."""
    e = _events(spark, sf_dir)
    return e.select(F.when(F.col("u") % 7 == 0, _text(" z", F.col("u"))).otherwise(_text(" s", F.col("u"))).alias("sym"), F.when(F.col("event_type") == "view", F.col("v")).cast("double").alias("last"), F.when(F.col("event_type") == "click", F.col("k")).cast("double").alias("vol"), F.col("n").alias("ts"))


def board_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    best, _ = capture.board(_frames(spark, sf_dir), _master(spark, sf_dir), ("last", "vol"), ("Premier Market", "Main Market"))
    return best


def board_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capture.board(_frames(spark, sf_dir), _master(spark, sf_dir), ("last", "vol"))[1]


def watchlist_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's table read by its header; rows that repeat it, or have no symbol, are left out."""
    n, u, v, k = (F.col(c) for c in "nuvk")
    header = ["Ticker", "Last", "Vol.", "Chg%", "Bid", "Ask"]
    cells = F.array(F.when(n % 21 == 0, "").otherwise(_text("kse:s", u)), _text(v, ".5"), _text(k, "M"), _text("−", n % 5, "%"), F.when(n % 4 == 0, "—").otherwise(_text(v)), F.format_number(v * 1000, 0))
    cells = F.when(n % 20 == 0, F.array(*map(F.lit, header))).when(n % 20 == 1, F.array(*(F.lit(x) for x in ("TICKER", "", "", "", "bid", "")))).otherwise(cells)
    return capture.quotes_from_cells(_events(spark, sf_dir).select("n", cells.alias("cells")), header)


def panel_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine labelled numbers of a panel's text."""
    n, v, k = (F.col(c) for c in "nvk")
    texts = (
        ("Volume", F.lit("")), (" Volume ", F.format_number(v * 1000, 0)), ("Turnover", _text(k, "K")), ("Trades", _text(n)), ("YTD %", _text("−", n % 9, ".5%")), ("Symbols Traded", _text(n % 140)), ("UPs", _text(n % 90)),
        ("Down", F.lit("-")), ("Unchanged", _text(n % 8)), ("Volume", F.lit("7")), ("", F.when(n % 2 == 0, F.concat(F.format_number(n + 1000, 0), F.lit(".25")))), ("", F.lit("1,000.5")), ("", F.lit("20.75")), ("Other", F.lit("3")),
    )
    cells = F.array(*(F.struct(F.lit(a).alias("label"), b.alias("value")) for a, b in texts))
    return capture.panel_fields(_events(spark, sf_dir).select("n", cells.alias("cells")))


def feed_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables told apart by their market names; one that says both or neither is unclear."""
    u = F.col("u")
    market = F.when(u % 4 == 0, "Premier Market").when(u % 4 == 1, "Nasdaq").when((u % 4 == 2) & (F.col("n") % 2 == 0), "main").when(u % 4 == 2, "LSE")
    return quality.feeds(_events(spark, sf_dir).select(_text("t", u % 12).alias("table"), market.alias("market")), "table")


def preflight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wanted columns, types and key of the captures."""
    needed = {"symbol": "string", "created_at": "timestamp_ntz", "volume": "bigint", "last_price": "decimal(12,3)", "market": "string"}
    return quality.preflight(s.quotes(spark, sf_dir), needed, ["symbol", "created_at"])


def order_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of orders: of the raw record if it has one, else of the column, else made of what tells the order apart."""
    o, key = s.read(spark, sf_dir, "orders"), F.col("o_orderkey")
    raw = F.when(key % 4 == 0, _text('{"id":"r', key, '"}')).when(key % 4 == 1, _text('{"id":"","Id":"R', key, '"}')).when(key % 4 == 2, "{}")
    column = F.when(key % 3 == 0, _text("c", key))
    side = F.when(key % 10 != 7, F.col("o_orderstatus"))
    symbol, code = p.split_symbol(_text(" S", key, " - C", key % 5))
    return o.select(
        key.alias("key"), p.pick(raw, column, "id", "Id").alias("order_id"), p.synthetic_id(F.to_date("o_orderdate"), symbol, side, F.floor("o_totalprice")).alias("synthetic_id"),
        symbol.alias("symbol"), code.alias("code"), p.to_integer(_text("(", F.floor("o_totalprice"), ".5)")).alias("whole"), p.to_date_dmy(F.date_format(F.to_date("o_orderdate"), "dd-MM-yyyy")).alias("day"),
        p.parse_float(_text(" −", key, ",000.25 x")).alias("number"), p.to_instant(F.when(key % 2 == 0, "8:07").otherwise("2026-01-02 03:04:05Z"), F.to_date("o_orderdate")).alias("at"),
    )


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scraper runs with outcomes; errors come in streaks."""
    e = _events(spark, sf_dir)
    return e.select(_text("scraper", F.col("u") % 4).alias("scraper"), F.col("n").alias("run_id"), F.col("ts").alias("started_at"), F.when(F.floor(F.col("n") / 300) % 2 == 0, "FAILED").when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("status"))


def failure_escalations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.escalations(_runs(spark, sf_dir))


def run_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each hour's capture run extracted and stored."""
    q = s.quotes(spark, sf_dir)
    rows = q.select(F.date_trunc("hour", "created_at").cast("timestamp_ntz").alias("started_at"), "id", F.when(F.col("last_price").isNull(), "no price").when(F.hour("created_at") == 9, "closed").alias("reject_reason"))
    return runs.audit(rows, ["started_at"], "reject_reason")


def _streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = s.read(spark, sf_dir, "events").schema
    e = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("event_id") * 7)
    return e.select(F.col("event_id").alias("id"), at.alias("created_at"), F.col("user_id").alias("u"), "event_type", F.floor("value").cast("double").alias("v"))


def streamed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of pushed batches, each pushed three times."""
    b = _streamed(spark, sf_dir).select(_text("b", F.floor(F.col("id") / 3)).alias("batchId"), F.col("created_at").alias("capturedAt"))
    return streams.drain(streams.without_retries(b), folders.shared(spark)).select("batchId")


def streamed_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last known value of each field of each symbol, and whether its price is stale."""
    f = _streamed(spark, sf_dir).select(_text("S", F.col("u")).alias("symbol"), F.col("created_at").alias("ts"), F.when(F.col("event_type") == "view", F.col("v")).alias("last"), F.when(F.col("event_type") == "click", F.col("v")).alias("bid"))
    out = streams.drain(streams.merged_frames(f, ("last", "bid")), folders.shared(spark), ["symbol"], "update")
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def streamed_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as signals, of each user and kind none within a minute of the last one sent."""
    e = _streamed(spark, sf_dir).select(_text("S", F.col("u") % 20).alias("symbol"), F.col("event_type").alias("signal"), F.col("created_at").alias("fired_at"), "id")
    out = streams.drain(streams.alerts(e), folders.shared(spark))
    return out.withColumn("fired_at", F.col("fired_at").cast("timestamp_ntz"))


QUERIES = {
    f.__name__: f
    for f in (
        pushed_quotes, pushed_depth, pushed_orders, ladder_levels, order_grid, daily_table_bars, symbol_aliases, board_rows, board_unknown, watchlist_page, panel_summary, feed_kinds, preflight, order_ids, failure_escalations, run_audit,
        streamed_batches, streamed_board, streamed_alerts,
    )
}

EVENTS = """
e as (select event_id as n, ts, user_id as u, cast(floor(value) as bigint) as v, event_type, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k from events),
b as (
 select *, 'b' || n as batch_id, case when n % 11 <> 0 then ts end as captured, coalesce(case when n % 3 = 0 then 'client' end, 'client') as source, case when n % 10 <> 0 then 'S' || u end as sym, ts + to_minutes(n % 40 - 5) as now from e)"""
MASTER = """
parts as (
 select p_partkey as k, case when p_partkey % 5 = 0 then 's' || p_partkey else 'S' || p_partkey end as symbol, case when p_partkey % 7 = 0 then 's' || p_partkey else cast(p_partkey // 2 as varchar) end as code, trim(p_name) as description,
  case p_partkey % 4 when 0 then 'Premier Market' when 1 then 'Main Market' when 2 then 'Auction Market' else 'Z' end as market from part),
master as (
 select alias, symbol, code, description, market
 from (select *, unnest(list_distinct([a for a in ['S' || k, case when k % 7 <> 0 then cast(k // 2 as varchar) end, 'F' || k % 50] if a is not null])) as alias from parts)
 qualify row_number() over (partition by alias order by symbol desc, code desc, description desc, market desc) = 1)"""
BOARD = """
latest as (
 select case when u % 7 = 0 then 'Z' else 'S' end || u as alias, arg_max(v, n) filter (event_type = 'view')::double as last, arg_max(k, n) filter (event_type = 'click')::double as vol, max(n) as ts from e group by 1)"""
_META = "batch_id, seen as created_at, cast(seen + to_hours(3) as date) as trading_date, source as ingest_source"
ORACLES = {
    "pushed_quotes": f"""with {EVENTS},
f as (select *, coalesce(captured, now) as seen from b where captured is null or n % 40 - 5 between -1 and 15)
select {_META}, 'S' || u as symbol, case n % 3 when 0 then 'Premier Market' when 1 then 'Main Market' else 'Other' end as market, case when n % 4 <> 0 then 'c' || u end as code, v::double as last_price,
 case when n % 5 = 0 then -(n % 7)::double else n % 7 + 0.5::double end as chg, (n % 9)::double as pct_chg, k * 1000.0::double as volume, k::double as trades, null::double as last_qty,
 case when n % 6 <> 0 then v + 1.0::double end as bid, n * 1000.0::double as bid_qty, v + 2.0::double as offer, null::double as offer_qty, 'Trading' as session,
 lpad(cast(n % 24 as varchar), 2, '0') || ':' || lpad(cast(n % 60 as varchar), 2, '0') || ':00' as last_trade_time from f
union all select {_META}, 'S' || u, null, null, null, null, null, null, null, null, null, null, null, null, null, null from f""",
    "pushed_depth": f"""with {EVENTS}, f as (select *, captured as seen from b)
select * from (
 select {_META}, sym as symbol, 'c0' as code, 7 as level, v::double as bid, 5000.0::double as bid_qty, 2.0::double as bid_orders, v + 3.0::double as offer, null::double as offer_qty, null::double as offer_orders from f
 union all select {_META}, 'X' || u, 'd', 2, 1000, null, null, v, n, null from f
 union all select {_META}, sym, 'c0', 3, null, null, null, v + 0.25::double, null, null from f) where symbol is not null""",
    "pushed_orders": f"""with {EVENTS}, f as (select *, captured as seen, cast(captured + to_hours(3) as date) as day from b where captured is not null)
select {_META}, case when n % 9 <> 0 then 'o' || n end as order_id, 'S' || u as symbol, case n % 4 when 0 then 'BUY' when 1 then 'SELL' else 'UNKNOWN' end as side, 'Filled' as order_status, v::double as price, 10 as quantity,
 case n % 3 when 0 then 4 when 1 then 12 end as filled_quantity, case when n % 5 = 0 then 2 when n % 3 = 0 then 6 end as remaining_qty, v + 0.5::double as avg_price, 15.0::double as order_value, -n::double as net_value,
 case n % 3 when 0 then cast(day as timestamp) + to_hours(6) + to_minutes(5) when 1 then timestamp '2026-08-25 07:00:30' else timestamp '2026-08-25 05:00:30' end as order_time from f""",
    "ladder_levels": f"""with {EVENTS} select 'S' || n as symbol, ts as created_at, level, v + 3.0::double - level as bid, case level when 1 then n when 3 then 1000 end::double as bid_qty,
 case when level < 3 then v + 3.0::double + level end as offer, case level when 1 then 2 when 2 then n end::double as offer_qty from e, (values (1), (2), (3)) as x(level)""",
    "order_grid": "select 'p' || o_orderkey % 7 as page, o_orderkey as top, 'o' || o_orderkey as \"orderId\", o_orderstatus as status, cast(cast(floor(o_totalprice) as bigint) as varchar) as price from orders where o_orderkey % 13 <> 0",
    "daily_table_bars": """select symbol, day as trade_date, px::double as open_price, px + 9.0::double as high_price, px - 9.0::double as low_price, px + 1.0::double as close_price, key % 5 + 0.5::double as change_value, case when key % 4 <> 0 then key + 1 end as volume
 from (select 'S' || o_custkey % 10 as symbol, o_orderkey as key, cast(o_orderdate as date) as day, cast(floor(o_totalprice) as bigint) as px from orders)
 where key % 19 <> 0 and key % 17 <> 0 and day between date '1993-01-01' and date '1997-12-31' qualify row_number() over (partition by symbol, day order by key) = 1""",
    "symbol_aliases": f"with {MASTER} select * from master",
    "board_rows": f"with {EVENTS}, {MASTER}, {BOARD} select symbol, code, description, market, alias, last, vol, ts from latest join master using (alias) where market in ('Premier Market', 'Main Market')",
    "board_unknown": f"with {EVENTS}, {MASTER}, {BOARD} select alias from latest where alias not in (select alias from master)",
    "watchlist_page": f"""with {EVENTS} select n, 'S' || u as symbol, v + 0.5::double as last_price, k * 1e6::double as volume, -(n % 5)::double as chg, -(n % 5)::double as pct_chg, case when n % 4 <> 0 then v::double end as bid, v * 1000.0::double as offer
 from e where n % 20 > 1 and n % 21 <> 0""",
    "panel_summary": f"""with {EVENTS} select n, v * 1000.0::double as volume, k * 1000.0::double as turnover, n::double as trades, -(n % 9 + 0.5::double) as ytd_pct, (n % 140)::double as symbols_traded, (n % 90)::double as ups, null::double as down, (n % 8)::double as unchanged,
 greatest(1000.5::double, case when n % 2 = 0 then n + 1000.25::double end) as index_close from e""",
    "feed_kinds": f"""with {EVENTS}, t as (select 't' || u % 12 as "table", case when u % 4 = 0 then 'Premier Market' when u % 4 = 1 then 'Nasdaq' when u % 4 = 2 and n % 2 = 0 then 'main' when u % 4 = 2 then 'LSE' end as market from e)
select "table", case when a > 0 and b = 0 then 'broker' when b > 0 and a = 0 then 'watchlist' else 'unclear' end as feed, a as broker_rows, b as other_rows
from (select "table", count(*) filter (market in ('Premier Market', 'main')) as a, count(*) filter (market in ('Nasdaq', 'LSE')) as b from t group by 1)""",
    "preflight": s.with_tables(
        """select 'symbol' as item, 'string' as expected, 'string' as found, true as ok union all select 'created_at', 'timestamp_ntz', 'timestamp_ntz', true union all select 'volume', 'bigint', 'bigint', true
 union all select 'last_price', 'decimal(12,3)', 'double', false union all select 'market', 'string', 'missing', false
 union all select 'key symbol, created_at', '0', cast(n as varchar), n = 0 from (select count(*) as n from (select 1 from quotes group by symbol, created_at having count(*) > 1))""",
        "quotes",
    ),
    "order_ids": """select key, coalesce(case key % 4 when 0 then 'r' || key when 1 then 'R' || key end, case when key % 3 = 0 then 'c' || key end) as order_id,
 case when key % 10 <> 7 then 'SYN-' || left(sha1(strftime(day, '%Y-%m-%d') || '|S' || key || '|' || side || '|' || px), 16) end as synthetic_id, 'S' || key as symbol, 'C' || key % 5 as code, -px as whole, day, -(key * 1000 + 0.25::double) as number,
 case when key % 2 = 0 then cast(day as timestamp) + to_hours(5) + to_minutes(7) else timestamp '2026-01-02 03:04:05' end as at
 from (select o_orderkey as key, cast(o_orderdate as date) as day, o_orderstatus as side, cast(floor(o_totalprice) as bigint) as px from orders)""",
    "failure_escalations": f"""with {EVENTS}, r as (select 'scraper' || u % 4 as scraper, n as run_id, ts as started_at, case when n // 300 % 2 = 0 or event_type = 'error' then 'FAILED' else 'SUCCESS' end as status from e),
 g as (select *, count(*) filter (status = 'SUCCESS') over (partition by scraper order by started_at, run_id) as good from r),
 f as (select *, row_number() over (partition by scraper, good order by started_at, run_id) as failures from g where status = 'FAILED')
select scraper, run_id, started_at, failures from f where failures in (1, 20) or failures % 180 = 0""",
    "run_audit": s.with_tables(
        """select started_at, extracted, rejected, extracted - rejected as stored, case when rejected = 0 then 'SUCCESS' when rejected = extracted then 'FAILED' else 'PARTIAL' end as status
 from (select date_trunc('hour', created_at) as started_at, count(*) as extracted, count(*) filter (last_price is null or hour(created_at) = 9) as rejected from quotes group by 1)""",
        "quotes",
    ),
    "streamed_batches": 'select distinct \'b\' || event_id // 3 as "batchId" from events',
    "streamed_board": f"""with {EVENTS}, f as (select 'S' || u as symbol, make_timestamp((1700000000 + n * 7) * 1000000) as ts, case when event_type = 'view' then v end as last, case when event_type = 'click' then v end as bid from e)
select symbol, max(ts) as ts, arg_max(last, ts) filter (last is not null)::double as last, arg_max(bid, ts) filter (bid is not null)::double as bid,
 coalesce(epoch(max(ts)) - epoch(max(ts) filter (last is not null)) > 300, true) as stale from f group by 1""",
    "streamed_alerts": """with recursive f as (
 select *, row_number() over k as nth, min(id) over (partition by symbol, signal order by sec range between 60 following and unbounded following) as next_id
 from (select 'S' || user_id % 20 as symbol, event_type as signal, 1700000000 + event_id * 7 as sec, event_id as id from events) window k as (partition by symbol, signal order by sec, id)),
sent as (select symbol, signal, sec, id, next_id from f where nth = 1 union all select f.symbol, f.signal, f.sec, f.id, f.next_id from sent join f on f.id = sent.next_id)
select symbol, signal, make_timestamp(sec * 1000000) as fired_at, id from sent""",
}
