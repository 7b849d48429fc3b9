"""Facts of the whole market in one session, from the symbols' facts and the broker's own panel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import LIMITS, Limits
from ..functions.scalars import half_up, regime_of
from .session import primary_only


def exact_mean(name: str, over=None) -> Column:
    """Mean of figures with four places, rounded alike; summed as whole numbers, so in any order."""
    units, n = F.sum(F.floor(F.col(name) * 10000 + 0.5)), F.count(name)
    units, n = (units, n) if over is None else (units.over(over), n.over(over))
    return F.floor(F.when(n > 0, units / n) + 0.5) / 10000


def breadth(days: DataFrame) -> DataFrame:
    """Counts by direction (without a previous close: none) and the distribution of changes, by session.

    Percentiles are exact and interpolated; mean, median and tails of ``chg_1d`` skip symbols without one.
    """
    c = F.col
    advancing, declining = F.count_if(c("chg_fils") > 0), F.count_if(c("chg_fils") < 0)
    d = days.groupBy("trading_date").agg(
        F.count("*").alias("symbols_traded"),
        advancing.alias("advancing"),
        declining.alias("declining"),
        F.count_if(c("chg_fils") == 0).alias("unchanged"),
        F.count_if(c("data_quality") == "THIN").alias("thin_symbols"),
        exact_mean("chg_1d").alias("avg_pct_change"),
        F.percentile("chg_1d", F.array(F.lit(0.5), F.lit(0.1), F.lit(0.9))).alias("p"),
        F.sum("total_volume").alias("total_volume"),
        F.sum("trades").alias("total_trades"),
    )
    return d.withColumns({"median_pct_change": half_up(c("p")[0]), "pct_change_p10": half_up(c("p")[1]), "pct_change_p90": half_up(c("p")[2])}).drop("p")


def percent(a: Column, b: Column) -> Column:
    return half_up(F.when(b != 0, 100.0 * a / b))


def trades_over_norm(days: DataFrame, sessions: int = 5, times: int = 3) -> DataFrame:
    """Symbols whose trades reach ``times`` their average over the last ``sessions`` sessions with trades."""
    known = days.where(F.col("trades").isNotNull()).select("symbol", "trading_date", "trades")
    before = Window.partitionBy("symbol").orderBy("trading_date").rowsBetween(-sessions, -1)
    return known.withColumn("norm", F.avg("trades").over(before)).groupBy("trading_date").agg(F.count_if((F.col("norm") > 0) & (F.col("trades") >= times * F.col("norm"))).alias("symbols_over_3x_daily"))


def arrivals(quotes: DataFrame) -> DataFrame:
    """Symbols seen for the first time, and symbols of the session before that are missing, by session."""
    pairs = quotes.select("symbol", "trading_date").distinct()
    dates = pairs.select("trading_date").distinct()
    in_order = Window.orderBy("trading_date")  # a row a session
    dates = dates.select("trading_date", F.lead("trading_date").over(in_order).alias("next_session"))
    of = Window.partitionBy("symbol").orderBy("trading_date")
    p = pairs.select("*", F.row_number().over(of).alias("nth"), F.lead("trading_date").over(of).alias("seen_next")).join(dates, "trading_date")
    new = p.groupBy("trading_date").agg(F.count_if(F.col("nth") == 1).alias("new_symbols"))
    gone = p.where("next_session is not null").groupBy(F.col("next_session").alias("trading_date")).agg(F.count_if(~F.col("seen_next").eqNullSafe(F.col("next_session"))).alias("suspended_symbols"))
    return new.join(gone, "trading_date", "left").fillna(0, ["suspended_symbols"])


def last_panel(summaries: DataFrame) -> DataFrame:
    """The broker's last capture of each session that isn't a stale one."""
    cols = [x for x in summaries.columns if x not in ("trading_date", "session_state")]
    best = summaries.where("session_state <> 'STALE'").groupBy("trading_date").agg(F.max_by(F.struct(*cols), "captured_at").alias("b"))
    return best.select("trading_date", "b")


def market_day(days: DataFrame, quotes: DataFrame, summaries: DataFrame | None = None, instruments: DataFrame | None = None, limits: Limits = LIMITS) -> DataFrame:
    """One row for each session. The broker's counts stand where there are any; computed ones are kept beside them.

    Windows over sessions come after that, so they run over the final series. Sessions without symbols have no row.
    """
    c = F.col
    traded = days if instruments is None else primary_only(days, instruments, "is_tradeable")
    m = breadth(traded).join(trades_over_norm(traded), "trading_date", "left").join(arrivals(quotes), "trading_date", "left").fillna(0, ["symbols_over_3x_daily"])
    m = m.withColumns({"computed_advancing": c("advancing"), "computed_declining": c("declining"), "computed_symbols": c("symbols_traded")})
    if summaries is not None:
        had = [x for x in ("symbols_traded", "advancing", "declining", "unchanged", "total_volume", "total_trades") if x in summaries.columns]
        m = m.join(last_panel(summaries), "trading_date", "left")
        first = {x: F.when(c("b").isNotNull(), c(f"b.{x}")).otherwise(c(x)) for x in had if not x.startswith("total")}
        rest = {x: F.coalesce(c(f"b.{x}"), c(x)) for x in had if x.startswith("total")}
        only = {x: c(f"b.{x}") for x in ("turnover_kd", "index_close", "index_ytd_pct") if x in summaries.columns}
        m = m.withColumns(first | rest | only | {"broker_seen_at": c("b.captured_at")}).drop("b")
    m = m.withColumns({"pct_advancing": percent(c("advancing"), c("symbols_traded")), "pct_advancing_ratio": percent(c("advancing"), c("advancing") + c("declining"))})
    order = Window.orderBy("trading_date")  # a row a session
    prior = order.rowsBetween(-20, -1)
    mean = F.avg(F.coalesce("total_volume", F.lit(0))).over(prior)
    return m.withColumns(
        {
            "regime": regime_of(c("pct_advancing")),
            "breadth_5d_avg": exact_mean("pct_advancing", order.rowsBetween(-4, 0)),
            "volume_vs_20d": half_up(F.when((F.count("*").over(prior) >= 20) & (mean > 0), c("total_volume") / mean)),
        }
    )
