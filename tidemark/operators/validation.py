"""Rules for captured rows: a reason to reject, or the row with impossible figures blanked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import LIMITS, Limits
from ..functions.scalars import whole

REASON = "reject_reason"


def impossible(x: Column, most: float) -> Column:
    return F.coalesce((x < 0) | (x > most) | F.isnan(x.cast("double")), F.lit(False))


def _first(*tests: tuple[Column, Column]) -> Column:
    return F.coalesce(*(F.when(F.coalesce(bad, F.lit(False)), text) for bad, text in tests))


def _blank(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")) == ""


def _prices(df: DataFrame, names: tuple[str, ...], limits: Limits) -> list:
    return [(impossible(F.col(n), limits.max_price), F.concat(F.lit(f"impossible {n}: "), F.col(n).cast("string"))) for n in names if n in df.columns]


def _sizes(df: DataFrame, names: tuple[str, ...], limits: Limits) -> dict[str, Column]:
    return {n: F.when(~impossible(F.col(n), limits.max_qty), whole(F.col(n).cast("double")).cast("long")) for n in names if n in df.columns}


def quotes(df: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    reason = _first(
        (_blank("symbol"), F.lit("no symbol")),
        (_blank("market"), F.lit("no market")),
        (F.trim("market").rlike("^[A-Za-z]$"), F.concat(F.lit('market is a raw code, not a name: "'), F.col("market"), F.lit('"'))),
        (F.col("created_at").isNull(), F.lit("invalid created_at")),
        (F.col("trading_date").isNull(), F.lit("no trading_date")),
        *_prices(df, ("last_price", "open_price", "high_price", "low_price", "bid", "offer"), limits),
    )
    return df.withColumns({REASON: reason} | _sizes(df, ("volume", "bid_qty", "offer_qty", "trades", "last_qty"), limits))


def is_empty_book(bid: Column, offer: Column, bid_qty: Column, offer_qty: Column) -> Column:
    return (F.coalesce(bid, F.lit(0)) == 0) & (F.coalesce(offer, F.lit(0)) == 0) & (F.coalesce(bid_qty, F.lit(0)) == 0) & (F.coalesce(offer_qty, F.lit(0)) == 0)


def depth(df: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    c = F.col
    bad_level = c("level").isNull() | (c("level") < 1) | (c("level") > limits.max_level) | (c("level") != F.floor("level"))
    reason = _first(
        (_blank("symbol"), F.lit("no symbol")),
        (c("created_at").isNull(), F.lit("invalid created_at")),
        (bad_level, F.concat(F.lit("level out of range: "), F.coalesce(c("level").cast("string"), F.lit("null")))),
        *_prices(df, ("bid", "offer"), limits),
        (c("bid").isNull() & c("offer").isNull(), F.lit("empty level")),
        (is_empty_book(c("bid"), c("offer"), c("bid_qty"), c("offer_qty")), F.lit("empty book — no bid, offer or quantity on either side")),
    )
    return df.withColumns({REASON: reason} | _sizes(df, ("bid_qty", "offer_qty", "bid_orders", "offer_orders"), limits))


def orders(df: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    c = F.col
    reason = _first((_blank("order_id"), F.lit("no order_id")), (c("created_at").isNull(), F.lit("invalid created_at")), *_prices(df, ("price",), limits))
    side = F.when(_blank("side") | c("side").isin("BUY", "SELL", "UNKNOWN"), c("side")).otherwise("UNKNOWN")
    out = df.withColumns({REASON: reason, "side": side} | _sizes(df, ("quantity", "filled_quantity", "remaining_qty"), limits))
    over = F.coalesce(c("filled_quantity") > c("quantity"), F.lit(False))
    return out.withColumns({n: F.when(~over, c(n)) for n in ("filled_quantity", "remaining_qty") if n in df.columns})


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with their reason)."""
    return checked.where(F.col(REASON).isNull()).drop(REASON), checked.where(F.col(REASON).isNotNull())


def reasons(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(REASON).isNotNull()).groupBy(REASON).agg(F.count("*").alias("n"))


#: Table constraints as predicates that must not be false.
CONSTRAINTS = {
    "bars": {"high_below_low": "high_price >= low_price", "negative_price": "low_price >= 0", "negative_volume": "volume >= 0"},
    "orders": {"overfilled": "filled_quantity <= quantity", "unknown_side": "side in ('BUY', 'SELL', 'UNKNOWN')", "negative_quantity": "quantity >= 0"},
    "symbol_day": {"ratio_at_offer": "buy_sell_ratio is null or pct_at_offer is null or pct_at_offer <= 90", "quality": "data_quality in ('FULL', 'THIN')", "high_below_low": "high_px >= low_px"},
    "market_day": {"regime": "regime in ('RISK_OFF', 'NEUTRAL', 'RISK_ON')"},
    "slots": {"slot_range": "slot between 1 and 8"},
}


def violations(df: DataFrame, table: str) -> DataFrame:
    """(constraint, n): rows for which each constraint of ``table`` is false."""
    rules = CONSTRAINTS[table]
    one = df.agg(*(F.count_if(~F.expr(rule)).alias(name) for name, rule in rules.items()))
    return one.unpivot([], list(rules), "constraint", "n")
