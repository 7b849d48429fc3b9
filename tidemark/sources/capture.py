"""Pushed captures: JSON files with batches of records, as typed rows.

Batches land as files in a folder; the same mapping serves a batch read and a stream. A batch carries its own id and the
instant it was captured; one that is too old or lies in the future is left out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import LIMITS, Limits
from ..functions import parsing as p
from ..functions.scalars import is_trading_day, local_minute, trading_day

TEXT = ("symbol symbolRaw market code description last chg pctChg volume bid bidPrice bidQty bidOrders offer offerPrice ask offerQty offerOrders trades lastQty session lastTradeTime"
        " orderId side status price quantity filled remaining avgPrice orderValue netValue orderTime level").split()  # fmt: skip
BATCH = f"batchId string, capturedAt timestamp_ntz, source string, symbol string, code string, records array<struct<{', '.join(f'{c}: string' for c in TEXT)}>>, levels array<struct<{', '.join(f'{c}: string' for c in TEXT)}>>"


def batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BATCH).json(path)


def stream(spark: SparkSession, path: str, files_a_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(BATCH).option("maxFilesPerTrigger", files_a_trigger).json(path)


def fresh(b: DataFrame, now: Column, limits: Limits = LIMITS) -> DataFrame:
    """Batches captured at most ``late_minutes`` before and ``early_seconds`` after ``now``; without an instant: now."""
    at = F.coalesce("capturedAt", now)
    age = F.timestamp_diff("SECOND", at, now)
    return b.withColumn("capturedAt", at).where((age <= limits.late_minutes * 60) & (age >= -limits.early_seconds))


def _records(b: DataFrame) -> DataFrame:
    rows = F.coalesce("records", "levels")
    meta = [F.col("batchId").alias("batch_id"), F.col("capturedAt").alias("created_at"), trading_day(F.col("capturedAt")).alias("trading_date"), F.coalesce("source", F.lit("client")).alias("ingest_source"), F.col("symbol").alias("_symbol"), F.col("code").alias("_code")]
    return b.select(*meta, F.posexplode(rows).alias("pos", "r"))


def _unsigned(name: str) -> Column:
    return F.abs(p.to_number(F.col(f"r.{name}")))


def quotes(b: DataFrame) -> DataFrame:
    """Only changes may be negative."""
    return _records(b).select(
        "batch_id", "created_at", "trading_date", "ingest_source",
        p.to_symbol(F.col("r.symbol")).alias("symbol"),
        p.market_name(F.col("r.market")).alias("market"),
        p.clean(F.col("r.code")).alias("code"),
        _unsigned("last").alias("last_price"),
        p.to_number(F.col("r.chg")).alias("chg"),
        p.to_number(F.col("r.pctChg")).alias("pct_chg"),
        *(_unsigned(a).alias(n) for a, n in (("volume", "volume"), ("trades", "trades"), ("lastQty", "last_qty"), ("bid", "bid"), ("bidQty", "bid_qty"), ("offer", "offer"), ("offerQty", "offer_qty"))),
        F.col("r.session").alias("session"),
        p.to_time(F.col("r.lastTradeTime")).alias("last_trade_time"),
    )


def depth(b: DataFrame) -> DataFrame:
    """Ladder rows; the symbol stands on each row or on the batch, a level is the row's place unless it is given."""
    r = _records(b)
    number = lambda *names: p.to_number(F.coalesce(*(F.col(f"r.{n}") for n in names)))
    return r.select(
        "batch_id", "created_at", "trading_date", "ingest_source",
        F.coalesce(p.to_symbol(F.col("r.symbol")), p.to_symbol(F.col("_symbol"))).alias("symbol"),
        F.coalesce("r.code", "_code").alias("code"),
        F.coalesce(F.when(F.col("r.level").rlike("^-?[0-9]+$"), F.col("r.level").try_cast("int")), F.col("pos") + 1).alias("level"),
        number("bid", "bidPrice").alias("bid"), number("bidQty").alias("bid_qty"), number("bidOrders").alias("bid_orders"),
        number("offer", "offerPrice", "ask").alias("offer"), number("offerQty").alias("offer_qty"), number("offerOrders").alias("offer_orders"),
    ).where("symbol is not null")


def orders(b: DataFrame) -> DataFrame:
    """Order sightings; what remains is derived where it isn't given and the fill is within the quantity."""
    r = _records(b)
    q, f = p.to_integer(F.col("r.quantity")), p.to_integer(F.col("r.filled"))
    return r.select(
        "batch_id", "created_at", "trading_date", "ingest_source",
        p.clean(F.col("r.orderId")).alias("order_id"),
        p.to_symbol(F.coalesce("r.symbol", "r.symbolRaw")).alias("symbol"),
        F.coalesce(p.to_side(F.col("r.side")), F.lit("UNKNOWN")).alias("side"),
        p.clean(F.col("r.status")).alias("order_status"),
        _unsigned("price").alias("price"), q.alias("quantity"), f.alias("filled_quantity"),
        F.coalesce(p.to_integer(F.col("r.remaining")), F.when(f <= q, q - f)).alias("remaining_qty"),
        p.to_number(F.col("r.avgPrice")).alias("avg_price"), p.to_number(F.col("r.orderValue")).alias("order_value"), p.to_number(F.col("r.netValue")).alias("net_value"),
        p.to_instant(F.col("r.orderTime"), F.col("trading_date")).alias("order_time"),
    )


#: Labels of the panel's numbers.
PANEL = {"Volume": "volume", "Turnover": "turnover", "Trades": "trades", "YTD %": "ytd_pct", "Symbols Traded": "symbols_traded", "UPs": "ups", "Down": "down", "Unchanged": "unchanged"}
#: Fixed value: the index is a number with decimals from here on; nothing else in the panel is.
LEAST_INDEX = 1000


def panel_fields(panels: DataFrame, cells: str = "cells") -> DataFrame:
    """The panel's numbers from its cells (array of label and value): of each label the first that can be read.

    The index has no label: it is the largest number with decimals from ``LEAST_INDEX`` on.
    """
    first = lambda name: F.get(F.array_compact(F.transform(F.filter(cells, lambda x: F.trim(x["label"]) == name), lambda x: p.to_number(x["value"]))), F.lit(0))
    levels = F.transform(F.filter(cells, lambda x: F.trim(x["value"]).rlike(r"^[0-9,]+\.[0-9]+$")), lambda x: p.to_number(x["value"]))
    index = F.array_max(F.filter(levels, lambda x: x >= LEAST_INDEX))
    return panels.select(*[c for c in panels.columns if c != cells], *(first(label).alias(name) for label, name in PANEL.items()), index.alias("index_close"))


def summary_state(captures: DataFrame, sessions: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Panel captures with the session they describe: LIVE or CLOSE on a day that traded, else STALE and the last that did."""
    day = trading_day(F.col("captured_at"))
    days = sessions.select(F.col("trading_date").alias("_session")).distinct()
    c = captures.withColumn("capture_day", day)
    last = c.select("capture_day").distinct().join(days, F.col("_session") <= F.col("capture_day")).groupBy("capture_day").agg(F.max("_session").alias("last_traded"))
    c = c.join(last, "capture_day", "left")
    live = is_trading_day(F.col("capture_day"), limits) & F.col("last_traded").eqNullSafe(F.col("capture_day"))
    state = F.when(~live, "STALE").when(local_minute(F.col("captured_at")) >= limits.close_minute, "CLOSE").otherwise("LIVE")
    return c.select(*[x for x in captures.columns if x not in ("trading_date", "session_state")], F.when(live, F.col("capture_day")).otherwise(F.coalesce("last_traded", "capture_day")).alias("trading_date"), state.alias("session_state"))


def symbol_master(tables: DataFrame) -> DataFrame:
    """Aliases of instruments from pipe-delimited tables (header, rows): one row an alias, upper-cased.

    A row without code and symbol is skipped; of an alias used twice any one entry stays.
    """
    t = tables.select(F.split("header", r"\|").alias("h"), F.explode("rows").alias("row")).select(F.map_from_arrays("h", F.expr("transform(h, (x, i) -> get(split(row, '\\\\|', -1), i))")).alias("m"))
    get = lambda k: F.nullif(F.trim(F.try_element_at("m", F.lit(k))), F.lit(""))
    e = t.where(F.map_contains_key("m", "SYMBOL")).select(
        F.coalesce(get("SHRT_DSC"), get("SYMBOL")).alias("symbol"),
        F.coalesce(get("COMPANY_CODE"), get("SYMBOL")).alias("code"),
        get("SYMBOL_DESCRIPTION").alias("description"),
        p.market_name(get("MARKET_ID")).alias("market"),
        F.array_distinct(F.array_compact(F.array(*(F.upper(get(k)) for k in ("SYMBOL", "SHRT_DSC", "COMPANY_CODE", "CFID", "SERIAL", "TI"))))).alias("aliases"),
    )
    one = e.where("code is not null").withColumn("alias", F.explode("aliases")).drop("aliases")
    return one.groupBy("alias").agg(F.max(F.struct("symbol", "code", "description", "market")).alias("e")).select("alias", "e.*")


def board(frames: DataFrame, master: DataFrame, fields: tuple[str, ...], keep: tuple[str, ...] | None = None) -> tuple[DataFrame, DataFrame]:
    """Merged frames joined with the symbol master by any alias: one row a symbol, the most complete; and unknown keys."""
    known = F.upper(F.trim("sym"))
    full = sum(F.col(f).isNotNull().cast("int") for f in fields)
    latest = frames.groupBy(known.alias("alias")).agg(*(F.max_by(f, F.when(F.col(f).isNotNull(), F.col("ts"))).alias(f) for f in fields), F.max("ts").alias("ts"))
    got = latest.join(master, "alias")
    got = got if keep is None else got.where(F.col("market").isin(*keep))
    cols = [c for c in got.columns if c != "symbol"]
    best = got.groupBy("symbol").agg(F.max_by(F.struct(*cols), F.struct(full, "ts", "alias")).alias("r")).select("symbol", *(F.col(f"r.{c}").alias(c) for c in cols))
    return best, latest.join(master, "alias", "left_anti").select("alias")


#: What the cells of each kind of page are called there.
ALIASES = {
    "symbol": ("symbol", "ticker"), "last_price": ("last", "price"), "volume": ("volume", "vol"), "chg": ("chg", "change"), "pct_chg": ("chg%", "change%", "%"), "bid": ("bid",), "offer": ("offer", "ask"),
}


def quotes_from_cells(rows: DataFrame, header: list[str], aliases: dict[str, tuple[str, ...]] = ALIASES) -> DataFrame:
    """Quotes from rows of cells under a header; rows that repeat the header or lack a symbol are left out."""
    at = p.resolve_columns(header, aliases)
    words = tuple({w for names in aliases.values() for w in names} | {h.strip().lower() for h in header})
    cell = lambda k: F.get("cells", F.lit(at[k]))
    kept = rows.where(~p.looks_like_header(F.col("cells"), header, words))
    numbers = [k for k in aliases if k != "symbol" and at[k] >= 0]
    rest = [c for c in rows.columns if c != "cells"]
    return kept.select(*rest, p.to_symbol(cell("symbol")).alias("symbol"), *(p.to_number(cell(k)).alias(k) for k in numbers)).where("symbol is not null")


def page_quotes(pages: DataFrame, aliases: dict[str, tuple[str, ...]] = ALIASES, fallback: dict[str, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """Quotes of many pages (page, header, rows: arrays of cells), each read by its own header; and a report of each page.

    A column is found by name: an exact alias, else one that a heading begins with. Where a page's header names none of
    them, ``fallback`` gives fixed places, and both results say so, as such figures may be of another column. Rows that
    repeat the header, are made of header words only, or have no symbol are skipped and counted in the report: (page,
    quotes, skipped, used_fallback), a row for each page, one without rows too.
    """
    low = lambda cells: F.transform(cells, lambda h: F.lower(F.trim(F.coalesce(h, F.lit("")))))

    def place(names: tuple[str, ...]) -> Column:
        found = [F.array_position(F.transform("_low", test), F.lit(True)) for test in (lambda h: h.isin(*names), lambda h: reduce(lambda a, b: a | b, (h.startswith(n) for n in names)))]
        return (F.coalesce(*(F.nullif(x, F.lit(0)) for x in found), F.lit(0)) - 1).cast("int")

    p_ = pages.withColumn("_low", low(F.coalesce("header", F.array().cast("array<string>"))))
    p_ = p_.withColumns({f"_at_{k}": place(names) for k, names in aliases.items()})
    nothing = F.greatest(*(F.col(f"_at_{k}") for k in aliases)) < 0 if len(aliases) > 1 else F.col(f"_at_{next(iter(aliases))}") < 0
    used = nothing & F.lit(bool(fallback))
    p_ = p_.withColumn("used_fallback", used).withColumns({f"_at_{k}": F.when(F.col("used_fallback"), F.lit((fallback or {}).get(k, -1))).otherwise(F.col(f"_at_{k}")) for k in aliases})
    words = sorted({w for names in aliases.values() for w in names})
    each = p_.select("page", "used_fallback", "_low", *(f"_at_{k}" for k in aliases), F.posexplode_outer("rows").alias("row", "_cells"))
    filled = F.filter(low(F.col("_cells")), lambda c: c != "")
    heading = (low(F.col("_cells")) == F.col("_low")) | ((F.size(filled) > 0) & F.forall(filled, lambda c: c.isin(*words)))
    cell = lambda k: F.when(F.col(f"_at_{k}") >= 0, F.get("_cells", F.col(f"_at_{k}")))
    symbol = F.when(~F.coalesce(heading, F.lit(False)), p.to_symbol(cell("symbol")))
    read = each.select("page", "row", "used_fallback", symbol.alias("symbol"), *(p.to_number(cell(k)).alias(k) for k in aliases if k != "symbol"))
    report = read.groupBy("page").agg(F.count("symbol").alias("quotes"), (F.count("row") - F.count("symbol")).alias("skipped"), F.first("used_fallback").alias("used_fallback"))
    return read.where("symbol is not null"), report


def ladder(cells: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Ladder levels from two columns of cells: bids by falling price, offers by rising price, side by side."""
    n = limits.max_level
    side = lambda name, down: F.slice(F.array_sort(F.transform(name, lambda x: F.struct((-1 if down else 1) * p.to_number(x["price"]), p.to_number(x["qty"]))), lambda a, b: F.when(a["col1"] < b["col1"], -1).when(a["col1"] > b["col1"], 1).otherwise(0)), 1, n)
    z = cells.withColumns({"_b": side("bids", True), "_o": side("offers", False)})
    rows = z.select("symbol", "created_at", F.posexplode(F.arrays_zip("_b", "_o")).alias("at", "x"))
    return rows.select("symbol", "created_at", (F.col("at") + 1).alias("level"), (-F.col("x._b.col1")).alias("bid"), F.col("x._b.col2").alias("bid_qty"), F.col("x._o.col1").alias("offer"), F.col("x._o.col2").alias("offer_qty"))


def grid(halves: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """Rows of a grid rendered in two halves: cells with the same offset belong together; rows without id are dropped."""
    g = halves.groupBy("page", "top").agg(*(F.max(F.when(F.col("cell") == f, F.col("text"))).alias(f) for f in fields))
    return g.where(p.clean(F.col(fields[0])).isNotNull())


def daily_table(rows: DataFrame, headers: list[str], start: str | None = None, end: str | None = None) -> DataFrame:
    """A chart's daily table (symbol, pos, unix, date_text, values) as bars; the first good row of a day counts."""
    at = p.daily_columns(headers)
    missing = [k for k in ("open", "high", "low", "close") if at[k] < 0]
    if missing:
        raise ValueError(f"no column for {', '.join(missing)} in {headers}")
    value = lambda k: p.parse_float(F.get("values", F.lit(at[k]))) if at[k] >= 0 else F.lit(None).cast("double")
    d = rows.select("symbol", "pos", p.row_date(F.col("date_text"), F.col("unix")).alias("trade_date"), *(value(k).alias(f"{k}_price") for k in ("open", "high", "low", "close")), value("change").alias("change_value"), F.floor(value("volume") + 0.5).alias("volume"))
    d = d.where("trade_date is not null and open_price is not null and close_price is not null and high_price >= low_price")
    d = d.where(F.col("trade_date") >= start) if start else d
    d = d.where(F.col("trade_date") <= end) if end else d
    cols = [c for c in d.columns if c not in ("symbol", "trade_date", "pos")]
    return d.groupBy("symbol", "trade_date").agg(F.min_by(F.struct(*cols), "pos").alias("r")).select("symbol", "trade_date", *(F.col(f"r.{c}").alias(c) for c in cols))


def jdbc(spark: SparkSession, url: str, table: str, key: str, low: int, high: int, parts: int, **options: str) -> DataFrame:
    """A table of another database, read in ranges of a numeric key (which pages can't overlap or miss)."""
    return spark.read.jdbc(url, table, column=key, lowerBound=low, upperBound=high, numPartitions=parts, properties=options)
