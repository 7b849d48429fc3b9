"""The daily and intraday jobs over a folder of tables, as ``python -m tidemark.jobs NAME --tables DIR [--date D]``.

Each job reads what it needs, computes, and replaces the days it has rows for; without a date all days are computed at
once. Tables are Parquet folders named as the functions' arguments.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import LIMITS, Limits
from .operators import bars, market, minute, registry, session, wakeup
from .sources import sinks


@dataclass(frozen=True)
class Tables:
    spark: SparkSession
    folder: str
    day: str | None = None
    limits: Limits = LIMITS

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def has(self, name: str) -> bool:
        return sinks.exists(self.spark, f"{self.folder}/{name}")

    def maybe(self, name: str) -> DataFrame | None:
        return self.read(name) if self.has(name) else None

    def of_day(self, df: DataFrame) -> DataFrame:
        return df if self.day is None else df.where(F.col("trading_date") == F.lit(self.day).cast("date"))

    def until_day(self, df: DataFrame) -> DataFrame:
        """Look-backs read earlier days, never later ones."""
        return df if self.day is None else df.where(F.col("trading_date") <= F.lit(self.day).cast("date"))


def instruments(t: Tables) -> tuple[str, DataFrame]:
    q, i = t.until_day(t.read("quotes")), registry.with_latest_market(t.read("instruments"), t.read("quotes"))
    i = registry.with_primary(registry.with_broker_status(i, q), q)
    if not registry.contradictions(i).isEmpty():
        raise ValueError("a primary symbol is staler than another of its code")
    i = registry.with_tv_status(i, t.until_day(t.read("watchlist"))) if t.has("watchlist") else i
    return "instruments_refreshed", registry.with_tradeable(i).drop("quote_rows", "last_quote", "status_changed")


def symbol_day(t: Tables) -> tuple[str, DataFrame]:
    q = t.until_day(t.read("quotes"))
    if "market" in q.columns and not session.markets_disagree(t.of_day(q)).isEmpty():
        raise ValueError("a symbol has several markets in a session")
    return "symbol_day", t.of_day(session.symbol_day(q, t.maybe("instruments"), t.limits))


def market_day(t: Tables) -> tuple[str, DataFrame]:
    days, q = t.until_day(t.read("symbol_day")), t.until_day(t.read("quotes"))
    registered = t.maybe("instruments")
    registered = registered if registered is not None and "is_tradeable" in registered.columns else None
    out = t.of_day(market.market_day(days, q, t.maybe("market_summary"), registered, t.limits))
    if t.day is not None and out.isEmpty():
        raise ValueError(f"no facts of symbols for {t.day}: it was not a session, or they weren't computed")
    return "market_day", out


def history(t: Tables) -> tuple[str, DataFrame]:
    return "history", bars.daily_bars(t.of_day(t.read("watchlist")), t.limits)


def snapshots(t: Tables) -> tuple[str, DataFrame]:
    return "symbol_minute", minute.snapshots(t.of_day(t.read("quotes")), t.limits)


def signals(t: Tables) -> tuple[str, DataFrame]:
    return "signal_log", minute.signals(t.of_day(t.read("symbol_minute")), t.limits)


def scores(t: Tables) -> tuple[str, DataFrame]:
    return "signal_scores", minute.score(t.of_day(t.read("signal_log")), t.read("symbol_minute"), t.limits)


def wakeups(t: Tables, hours: tuple[int, ...] = tuple(range(9, 14))) -> tuple[str, DataFrame]:
    q = t.until_day(t.read("quotes"))
    out = None
    for h in hours:
        p = t.of_day(wakeup.pace(q, h, until_hour=True, limits=t.limits)).withColumn("scan", F.lit(h))
        out = p if out is None else out.unionByName(p)
    return "wakeups", wakeup.scan(out, t.limits)


def study(t: Tables) -> tuple[str, DataFrame]:
    return "daily_study", bars.daily_study(t.of_day(t.read("watchlist")), t.limits)


JOBS: dict[str, Callable[[Tables], tuple[str, DataFrame]]] = {
    "daily.instruments": instruments,
    "daily.symbolday": symbol_day,
    "daily.marketday": market_day,
    "daily.history": history,
    "daily.analysis": study,
    "signals.minute": snapshots,
    "signals.fast": signals,
    "signals.score": scores,
    "signals.wakeup": wakeups,
}


def run(name: str, spark: SparkSession, folder: str, day: str | None = None, limits: Limits = LIMITS) -> str:
    """Run a job and return the path of the table it wrote."""
    table, df = JOBS[name](Tables(spark, folder, day, limits))
    path = f"{folder}/{table}"
    if "trading_date" in df.columns:
        sinks.replace_days(df, path)
    else:
        df.write.mode("overwrite").parquet(path)
    return path


def main() -> None:
    a = argparse.ArgumentParser(description=__doc__)
    a.add_argument("job", choices=sorted(JOBS))
    a.add_argument("--tables", required=True)
    a.add_argument("--date")
    given = a.parse_args()
    spark = SparkSession.builder.appName(given.job).config("spark.sql.session.timeZone", "UTC").getOrCreate()
    print(run(given.job, spark, given.tables, given.date))


if __name__ == "__main__":
    main()
