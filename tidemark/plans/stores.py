"""Stored tables, ledgers, audits, SQL functions and another store as queries: what was written is read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import registered
from ..operators import quality, validation
from ..sources import capture, folders, keyed, sinks
from ..sources import standins as s
from ..streaming import capture as streams
from . import ledger, payloads
from .feeds import LABELLED, labelled

ORDER_RULES = {
    "symbol": "known", "side": "known", "order_status": "last", "price": "last", "quantity": "last", "filled_quantity": "last", "order_value": "known", "net_value": "known",
    "trading_date": "last", "executions_observed": "rises filled_quantity", "sighting_count": "count", "first_seen": "first", "last_seen": "last",
}


def merged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order sightings merged into a stored table in three batches: a batch's first sighting of an order counts."""
    seen = s.sightings(spark, sf_dir).withColumns({"first_seen": F.col("seq"), "last_seen": F.col("seq")})
    path = folders.shared(spark)
    for k in range(3):
        sinks.merge(seen.where((F.col("seq") - 1) % 3 == k), path, ["order_id"], ORDER_RULES, F.col("seq"), "bucket", F.pmod(F.col("order_id"), F.lit(16)))
    return spark.read.parquet(path).drop("bucket")


BAR_RULES = {"open": "first", "high": "greatest", "low": "least", "close": "last", "volume": "known", "id": "last"}


def merged_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars stored by day and restated by two later batches; the second only has some days."""
    q = s.quotes(spark, sf_dir)
    path = folders.shared(spark)
    for batch in (q.where("id % 3 = 0"), q.where("id % 3 = 1 and dayofmonth(trading_date) % 2 = 0"), q.where("id % 3 = 2")):
        px = F.col("last_price")
        rows = batch.select("symbol", "trading_date", px.alias("open"), px.alias("high"), px.alias("low"), px.alias("close"), "volume", "id")
        sinks.merge(rows, path, ["symbol", "trading_date"], BAR_RULES, F.col("id"), "day", F.date_format("trading_date", "yyyy-MM-dd"), latest=True)
    return spark.read.parquet(path).drop("day")


REGISTRY_RULES = {"code": "known", "market": "known", "broker_status": "last", "sightings": "count"}


def merged_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry seeded from instruments, then refreshed by captures that know some of its symbols and others."""
    path, bucket = folders.shared(spark), F.pmod(F.crc32(F.col("symbol").cast("binary")), F.lit(8))
    i = s.instruments(spark, sf_dir).select("symbol", "code", "market", "broker_status", F.lit(0).alias("at"))
    q = labelled(spark, sf_dir).select(F.when(F.col("id") % 5 == 0, F.concat(F.lit("N"), "symbol")).otherwise(F.col("symbol")).alias("symbol"), F.lit(None).cast("string").alias("code"), F.when(F.col("market") != "B", F.col("market")).alias("market"), F.lit("CAPTURED").alias("broker_status"), F.col("id").alias("at"))
    for batch in (i, q.where("at % 2 = 0"), q.where("at % 2 = 1")):
        sinks.merge(batch, path, ["symbol"], REGISTRY_RULES, F.col("at"), "bucket", bucket, latest=True)
    return spark.read.parquet(path).drop("bucket")


def _pushed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures as pushed batches of about five, some of their rows faulty."""
    n = F.col("id")
    q = labelled(spark, sf_dir).withColumns({"batch_id": F.concat(F.lit("b"), F.floor(n / 5).cast("string")), "last_price": F.when(n % 17 == 0, -1.0).otherwise(F.col("last_price"))})
    return validation.quotes(q).select("batch_id", "id", "symbol", "created_at", "last_price", validation.REASON)


def _submitted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """Three submissions: of most batches, of those again with the rest, and that one a second time, as after a failure."""
    rows, at = _pushed(spark, sf_dir), folders.shared(spark)
    most = F.crc32(F.col("batch_id").cast("binary")) % 4 != 0
    answer = None
    for part, name in ((rows.where(most), "quotes-0"), (rows, "quotes-1"), (rows, "quotes-1")):
        answer = sinks.submit(part, f"{at}/rows", f"{at}/ledger", name, ["symbol", "created_at"], "id", validation.REASON)
    return answer, f"{at}/rows"


def replayed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The answers to batches of which most were pushed before: a seen batch gets the counts it got then."""
    return _submitted(spark, sf_dir)[0]


def replayed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What those submissions stored."""
    return spark.read.parquet(_submitted(spark, sf_dir)[1]).select("batch_id", "id", "symbol", "created_at", "last_price", "submission")


def audited_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each batch of a stream, and each of two plain writes, extracted and stored, as these writes counted it."""
    rows, at = _pushed(spark, sf_dir).withColumn("part", (F.col("id") % 3).cast("int")), folders.shared(spark)
    with sinks.Audit(spark, f"{at}/runs") as audit:
        for k in range(3):
            rows.where(F.col("part") == k).drop("part").write.parquet(f"{at}/landed/run={k}")
            stream = spark.readStream.schema(rows.drop("part").schema).parquet(f"{at}/landed/run=*")
            streams.drain(audit.watch(stream, "stream", validation.REASON).where(F.col(validation.REASON).isNull()), f"{at}/stream")
    sinks.audited_write(rows, f"{at}/good", f"{at}/runs", "batch", validation.REASON)
    sinks.audited_write(rows.where(F.col(validation.REASON).isNotNull()), f"{at}/none", f"{at}/runs", "faulty", validation.REASON)
    return spark.read.schema(sinks.RUN).parquet(f"{at}/runs").drop("seconds")


def sql_prev_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered functions in one statement: scalar, from-clause and lateral."""
    registered.register(spark, s.quotes(spark, sf_dir))
    return spark.sql("""
        select c.symbol, c.trading_date, c.captures, prev_session(c.trading_date) as prev, prev_session(c.trading_date, 5) as prev_5, prev_session_of(c.symbol, c.trading_date) as own_prev,
         is_trading_day(c.trading_date) as trading, p.nth, p.trading_date as back, half_up(c.captures / 7, 2) as weekly
        from market_captured_days c, lateral prev_session(c.trading_date, 3) p""")


def sql_last_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``select * from prev_session(...)``: the ten sessions before a day, and their symbols by a second table function."""
    registered.register(spark, s.quotes(spark, sf_dir))
    return spark.sql("select p.*, count(x.symbol) as symbols, sum(x.captures) as captures from prev_session(date'2024-02-01', 10) p, lateral symbols_of(p.trading_date) x group by all")


def keyed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of another store, read in ranges of their key; the filter goes to the store."""
    keyed.register(spark)
    path = f"{sf_dir}/orders.parquet".replace("'", "''")
    o = spark.read.format("keyed").options(module="duckdb", table=f"read_parquet('{path}')", key="o_orderkey", parts="6").load()
    o = o.where("o_orderkey > 100 and o_orderstatus in ('O', 'F')")
    return o.groupBy("o_custkey", "o_orderstatus").agg(F.count("*").alias("orders"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"), F.max("o_totalprice").alias("largest"))


def stored_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ladder levels appended in two overlapping batches: a level of a symbol and instant is stored once."""
    levels = payloads.ladder_levels(spark, sf_dir).withColumns({"trading_date": F.to_date("created_at"), "n": F.regexp_extract("symbol", "([0-9]+)", 1).cast("long")})
    path = folders.shared(spark)
    for batch in (levels.where("n % 3 < 2"), levels.where("n % 3 > 0").withColumn("bid", F.col("bid") + 1)):
        sinks.append_new(batch, path, ["symbol", "created_at", "level"], "n")
    return spark.read.parquet(path).drop("trading_date", "n")


def replaced_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily facts stored, then computed anew from later captures for some days: those days only are replaced."""
    q, path = s.quotes(spark, sf_dir), folders.shared(spark)
    for rows in (q.where("id % 2 = 0"), q.where("dayofmonth(trading_date) % 3 = 1")):
        facts = rows.groupBy("symbol", "trading_date").agg(F.count("*").alias("captures"), F.max("last_price").alias("high"), F.min("last_price").alias("low"))
        sinks.replace_days(facts, path)
    return spark.read.parquet(path)


def _sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of rows, by hour: most with a header, in two orders, some with one that names nothing."""
    n, u, v, k = (F.col(c) for c in "nuvk")
    cells = lambda *xs: F.array(*(x.cast("string") if not isinstance(x, str) else F.lit(x) for x in xs))
    hour = F.date_format("ts", "yyyyMMddHH")
    kind = F.pmod(F.hour("ts"), F.lit(4))
    symbol = F.when(n % 21 == 0, "").otherwise(F.concat(F.lit("kse:s"), u.cast("string")))
    header = F.when(kind == 1, cells("Price now", "Symbol", "Volume", "?")).when(kind == 2, cells("a", "b", "c", "d")).otherwise(cells("Ticker", "Last", "Vol.", "x"))
    row = F.when(n % 20 == 0, header).when(kind == 1, cells(v, symbol, F.concat(k.cast("string"), F.lit("K")), F.lit("-"))).otherwise(cells(symbol, v, F.concat(k.cast("string"), F.lit("K")), F.lit("-")))
    return payloads._events(spark, sf_dir).groupBy(hour.alias("page")).agg(F.first(header).alias("header"), F.array_sort(F.collect_list(F.struct("n", row.alias("cells")))).alias("r")).select("page", "header", F.col("r.cells").alias("rows"))


FIXED = {"symbol": 0, "last_price": 1, "volume": 2}


def sheet_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes of pages read by their own headers, or by fixed places where a header names nothing."""
    return capture.page_quotes(_sheets(spark, sf_dir), {k: capture.ALIASES[k] for k in FIXED}, FIXED)[0]


def sheet_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capture.page_quotes(_sheets(spark, sf_dir), {k: capture.ALIASES[k] for k in FIXED}, FIXED)[1]


def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Needed columns, types and nulls of tables in the catalogue."""
    s.quotes(spark, sf_dir).createOrReplaceTempView("captured_quotes")
    s.read(spark, sf_dir, "orders").createOrReplaceTempView("broker_orders")
    needed = {
        "captured_quotes": {"symbol": "string not null", "last_price": "double not null", "session": "string not null", "volume": "int", "market": "string"},
        "broker_orders": {"o_orderkey": "bigint not null", "o_orderstatus": "string"},
        "missing_table": {"x": "string not null"},
    }
    return quality.schema_report(spark, needed)


QUERIES = {f.__name__: f for f in (stored_depth, replaced_days, sheet_quotes, sheet_report, schema_report, merged_orders, merged_bars, merged_registry, replayed_batches, replayed_rows, audited_runs, sql_prev_session, sql_last_session, keyed_orders)}

PUSHED = LABELLED.strip() + """,
pushed as (
 select 'b' || id // 5 as batch_id, id, symbol, created_at, case when id % 17 = 0 then -1 else last_price end as last_price,
  market = 'B' or coalesce(case when id % 17 = 0 then -1 else last_price end not between 0 and 1000000, false) or coalesce(bid not between 0 and 1000000, false) or coalesce(offer not between 0 and 1000000, false) as bad from labelled),
crcs as (select batch_id, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(batch_id, ''), lambda x: ascii(x)::bigint)), lambda a, x: xor(a // 256, entries[xor(a % 256, x) + 1])) as inverted
 from (select distinct batch_id from pushed), (select list(v order by i) as entries from (select i, list_reduce(list_prepend(i, range(8)), lambda a, k: case when a % 2 = 1 then xor(a // 2, 3988292384) else a // 2 end) as v from (select unnest(range(256)) as i)))),
placed as (select *, xor(inverted, 4294967295) % 4 = 0 as second from pushed join crcs using (batch_id)),
kept as (select * from placed where not bad qualify row_number() over (partition by symbol, created_at order by second, id) = 1)"""
STATUS = "case when rejected = 0 then 'SUCCESS' when rejected = extracted then 'FAILED' else 'PARTIAL' end as status"
SHEETS = f"""with {payloads.EVENTS},
w as (select n, strftime(ts, '%Y%m%d%H') as page, hour(ts) % 4 as kind, u, v, k, n % 20 <> 0 and n % 21 <> 0 as good, cast(row_number() over (partition by strftime(ts, '%Y%m%d%H') order by n) - 1 as int) as place from e)"""
ORACLES = {
    "stored_depth": f"""with {payloads.EVENTS} select 'S' || n as symbol, ts as created_at, level, v + 3.0::double - level + case when n % 3 = 2 then 1 else 0 end as bid, case level when 1 then n when 3 then 1000 end::double as bid_qty,
 case when level < 3 then v + 3.0::double + level end as offer, case level when 1 then 2 when 2 then n end::double as offer_qty from e, (values (1), (2), (3)) as x(level)""",
    "replaced_days": s.with_tables(
        "select symbol, trading_date, count(*) as captures, max(last_price) as high, min(last_price) as low from quotes where id % 2 = 0 or dayofmonth(trading_date) % 3 = 1 group by 1, 2", "quotes"
    ),
    "sheet_quotes": SHEETS + " select page, place as row, kind = 2 as used_fallback, 'S' || u as symbol, v::double as last_price, k * 1000.0::double as volume from w where good",
    "sheet_report": SHEETS + " select page, count(*) filter (good) as quotes, count(*) filter (not good) as skipped, bool_or(kind = 2) as used_fallback from w group by 1",
    "schema_report": s.with_tables(
        """select 'captured_quotes' as "table", c as "column", t as expected, f as found, n as nulls, t = f and coalesce(n, 0) = 0 as ok from (
 select 'symbol' as c, 'string' as t, 'string' as f, count(*) - count(symbol) as n from quotes union all select 'last_price', 'double', 'double', count(*) - count(last_price) from quotes
 union all select 'session', 'string', 'string', count(*) - count(session) from quotes union all select 'volume', 'int', 'bigint', null union all select 'market', 'string', 'missing', null)
 union all select 'broker_orders', 'o_orderkey', 'bigint', 'bigint', count(*) - count(o_orderkey), count(*) = count(o_orderkey) from orders
 union all select 'broker_orders', 'o_orderstatus', 'string', 'string', null, true union all select 'missing_table', 'x', 'string', 'missing table', null, false""",
        "quotes",
    ),
    "merged_orders": s.with_tables("select * from folded", "sightings", more="picked as (select * replace ((seq - 1) % 3 as seq), seq as line from sightings qualify row_number() over (partition by order_id, (seq - 1) % 3 order by seq) = 1)," + ledger._fold(False).replace("from sightings)", "from picked)").replace("min(seq) as first_seen, max(seq) as last_seen", "arg_min(line, seq) as first_seen, arg_max(line, seq) as last_seen")),
    "merged_bars": s.with_tables(
        """select symbol, trading_date, arg_min(struct_pack(v := last_price), batch).v as open, max(last_price) as high, min(last_price) as low, arg_max(struct_pack(v := last_price), batch).v as close, arg_max(volume, batch) filter (volume is not null) as volume, arg_max(id, batch) as id
 from (select *, id % 3 as batch from quotes where id % 3 <> 1 or dayofmonth(trading_date) % 2 = 0 qualify row_number() over (partition by symbol, trading_date, id % 3 order by id desc) = 1) group by 1, 2""",
        "quotes",
    ),
    "merged_registry": s.with_tables(
        """select symbol, max(code) as code, arg_max(market, batch) filter (market is not null) as market, arg_max(broker_status, batch) as broker_status, count(*) as sightings from (
 select symbol, code, market, broker_status, 0 as batch from instruments union all
 select symbol, null, case when market <> 'B' then market end, 'CAPTURED', 1 + id % 2 from (select case when id % 5 = 0 then 'N' || symbol else symbol end as symbol, market, id from labelled) qualify row_number() over (partition by symbol, id % 2 order by id desc) = 1) group by 1""",
        "quotes", "instruments",
        more=LABELLED,
    ),
    "replayed_batches": s.with_tables(
        "select batch_id, count(*) as offered, count(*) filter (id in (select id from kept)) as inserted, count(*) filter (bad) as rejected, not bool_or(second) as duplicate from placed group by 1", "quotes", more=PUSHED
    ),
    "replayed_rows": s.with_tables("select batch_id, id, symbol, created_at, last_price, case when second then 'quotes-1' else 'quotes-0' end as submission from kept", "quotes", more=PUSHED),
    "audited_runs": s.with_tables(
        f"""select *, extracted - rejected as stored, {STATUS} from (
 select 'stream' as run, cast(id % 3 as bigint) as batch, count(*) as extracted, count(*) filter (bad) as rejected from pushed group by 1, 2
 union all select 'batch', 0, count(*), count(*) filter (bad) from pushed union all select 'faulty', 0, count(*), count(*) from pushed where bad)""",
        "quotes",
        more=PUSHED,
    ),
    "sql_prev_session": s.with_tables(
        """select c.symbol, c.trading_date, captures, own_prev, prev, prev_5, dayofweek(c.trading_date) not in (5, 6) as trading, nth, back, floor(captures / 7::double * 100 + 0.5) / 100 as weekly
 from (select *, lag(trading_date) over (partition by symbol order by trading_date) as own_prev from (select symbol, trading_date, count(*) as captures from quotes group by 1, 2)) c
 join (select trading_date, lag(trading_date) over w as prev, coalesce(lag(trading_date, 5) over w, nullif(first_value(trading_date) over w, trading_date)) as prev_5, nth_list from (
  select *, [x for x in [lag(trading_date, 1) over w2, lag(trading_date, 2) over w2, lag(trading_date, 3) over w2]] as nth_list from (select distinct trading_date from quotes) window w2 as (order by trading_date)) window w as (order by trading_date)) d using (trading_date),
 (values (1), (2), (3)) as k(nth), lateral (select nth_list[nth] as back) where back is not null""",
        "quotes",
    ),
    "sql_last_session": s.with_tables(
        """select cast(row_number() over (order by trading_date desc) as int) as nth, trading_date, symbols, captures from (
 select trading_date, count(distinct symbol) as symbols, count(*) as captures from quotes where trading_date < date '2024-02-01' group by 1 order by 1 desc limit 10)""",
        "quotes",
    ),
    "keyed_orders": "select o_custkey, o_orderstatus, count(*) as orders, min(o_orderkey) as first_key, max(o_orderkey) as last_key, max(o_totalprice) as largest from orders where o_orderkey > 100 and o_orderstatus in ('O', 'F') group by 1, 2",
}
