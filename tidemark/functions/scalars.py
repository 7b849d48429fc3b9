"""Rounding, the exchange's clock, and small named rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import LIMITS, Limits

HOURS_EAST = 3  # Asia/Kuwait has no summer time


def let(x: Column, body) -> Column:
    """``body`` of ``x`` with ``x`` computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(x), body), 1)


def half_up(x: Column, places: int = 4) -> Column:
    """Round half up by floor, which every engine computes alike."""
    scale = float(10**places)
    return F.floor(x * scale + 0.5) / scale


def whole(x: Column) -> Column:
    """Nearest whole number, halves up (-2.5 gives -2)."""
    return F.floor(x + 0.5)


def ratio(a: Column, b: Column, places: int | None = 4) -> Column:
    """``a / b``; null without a denominator (null or zero)."""
    x = F.when(b != 0, a.cast("double") / b)
    return x if places is None else half_up(x, places)


def local(ts: Column) -> Column:
    """A UTC instant on the exchange's clock."""
    return ts + F.expr(f"INTERVAL {HOURS_EAST} HOURS")


def local_hour(ts: Column) -> Column:
    return F.hour(local(ts))


def local_minute(ts: Column) -> Column:
    """Minute of the local day."""
    return F.hour(local(ts)) * 60 + F.minute(local(ts))


def minute_bucket(ts: Column) -> Column:
    """Start of the minute; keeps the timestamp's type."""
    return ts - F.make_dt_interval(secs=F.extract(F.lit("SECOND"), ts).cast("decimal(18,6)"))


def trading_day(ts: Column) -> Column:
    return F.to_date(local(ts))


def is_trading_day(day: Column, limits: Limits = LIMITS) -> Column:
    """Not on the weekend (Friday and Saturday)."""
    return ~F.dayofweek(day).isin(*limits.weekend)


def is_within_window(ts: Column, limits: Limits = LIMITS) -> Column:
    """On a trading day, from the window's first minute up to but not including its last."""
    m = local_minute(ts)
    return is_trading_day(trading_day(ts), limits) & (m >= limits.window_start) & (m < limits.window_end)


def window_status(ts: Column, limits: Limits = LIMITS) -> Column:
    """WEEKEND, BEFORE, OPEN or AFTER."""
    m = local_minute(ts)
    return (
        F.when(~is_trading_day(trading_day(ts), limits), "WEEKEND")
        .when(m < limits.window_start, "BEFORE")
        .when(m < limits.window_end, "OPEN")
        .otherwise("AFTER")
    )


def previous_trading_day(day: Column, limits: Limits = LIMITS) -> Column:
    """The last day before ``day`` that is not on the weekend."""
    back = [F.when(is_trading_day(F.date_sub(day, n), limits), F.date_sub(day, n)) for n in range(1, 8)]
    return F.coalesce(*back)


def regime_of(pct: Column) -> Column:
    return F.when(pct < 35, "RISK_OFF").when(pct <= 50, "NEUTRAL").when(pct.isNotNull(), "RISK_ON")


def family_of(close: Column, limits: Limits = LIMITS) -> Column:
    return F.when(close < limits.crawler_price, "CRAWLER")


def tick_band_crossed(close: Column, high: Column, limits: Limits = LIMITS) -> Column:
    return F.when(close.isNotNull() & high.isNotNull(), (close < limits.crawler_price) & (high >= limits.crawler_price))


def data_quality(minutes: Column, median: Column, close_of_day: Column, limits: Limits = LIMITS) -> Column:
    thin = (minutes < limits.thin_minutes) | ~close_of_day | F.coalesce((median != 0) & (minutes < limits.thin_share * median), F.lit(False))
    return F.when(thin, "THIN").otherwise("FULL")


def precedence_of(source: Column, order: tuple[str, ...] = LIMITS.sources) -> Column:
    """Higher wins; a source that isn't listed has the lowest."""
    at = F.array_position(F.array(*map(F.lit, order)), source)
    return F.when(at > 0, len(order) + 1 - at).otherwise(0).cast("int")


def richness(*columns: str) -> Column:
    """How many of the columns are neither null nor blank."""
    return sum(((F.trim(F.col(c).cast("string")) != "") & F.col(c).isNotNull()).cast("int") for c in columns)


def fingerprint(*columns: str) -> Column:
    return F.concat_ws("\x01", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))
