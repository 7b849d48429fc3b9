"""Bars from cumulative captures, and the swing and retracement study over them."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import LIMITS, Limits
from ..functions.scalars import half_up, minute_bucket

DAY = ("symbol", "trading_date")


def minute_bars(captures: DataFrame) -> DataFrame:
    """Open, high, low, close and the volume traded in each captured minute.

    The feed's volume is cumulative: a minute's own is its rise over the highest seen before, falls and gaps count 0.
    """
    order = F.struct("created_at", "id")
    bars = (
        captures.where("last_price is not null")
        .groupBy(*DAY, minute_bucket(F.col("created_at")).alias("minute"))
        .agg(F.min_by("last_price", order).alias("open"), F.max("last_price").alias("high"), F.min("last_price").alias("low"), F.max_by("last_price", order).alias("close"), F.max("volume").alias("cumulative"))
    )
    before = Window.partitionBy(*DAY).orderBy("minute").rowsBetween(Window.unboundedPreceding, -1)
    had = F.coalesce(F.max("cumulative").over(before), F.lit(0))
    return bars.withColumn("vol", F.greatest(F.lit(0), F.coalesce("cumulative", had) - had)).drop("cumulative")


def daily_bars(captures: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """The day's bar of each symbol with enough priced captures; volume is the last cumulative figure."""
    order = F.struct("created_at", "id")
    b = (
        captures.where("last_price is not null")
        .groupBy(*DAY)
        .agg(
            F.min_by("last_price", order).alias("open_price"),
            F.max("last_price").alias("high_price"),
            F.min("last_price").alias("low_price"),
            F.max_by("last_price", order).alias("close_price"),
            F.max("volume").alias("volume"),
            F.count("*").alias("captures"),
        )
    )
    change = F.col("close_price") - F.col("open_price")
    return b.where(F.col("captures") >= limits.min_captures).select("*", change.alias("change_value"), half_up(F.when(F.col("open_price") > 0, change / F.col("open_price") * 100.0)).alias("change_pct"))


def volume_profile(bars: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Mean and highest minute volume, minutes above a multiple of the mean, and volume by the direction of closes.

    A flat minute's volume is split in half; the first minute has no direction and is left out.
    """
    day, seq = Window.partitionBy(*DAY), Window.partitionBy(*DAY).orderBy("minute")
    b = bars.withColumns({"mean": F.avg("vol").over(day), "delta": F.col("close") - F.lag("close").over(seq)})
    side = lambda up: F.coalesce(F.sum(F.when(F.col("delta") > 0 if up else F.col("delta") < 0, F.col("vol")).when(F.col("delta") == 0, F.col("vol") / 2)), F.lit(0.0))
    g = b.groupBy(*DAY).agg(
        half_up(F.first("mean"), 2).alias("avg_vol_min"),
        F.max("vol").alias("highest_volume"),
        F.count_if(F.col("vol") > limits.spike_multiple * F.col("mean")).alias("vol_spike_count"),
        side(True).alias("buyer"),
        side(False).alias("seller"),
    )
    total = F.col("buyer") + F.col("seller")
    share = lambda x: F.when(total != 0, half_up(F.col(x) / total * 100.0, 2)).otherwise(0.0)
    return g.select(
        *DAY, "avg_vol_min", "highest_volume", "vol_spike_count", F.floor(F.col("buyer") + 0.5).alias("est_buyer_vol"), F.floor(F.col("seller") + 0.5).alias("est_seller_vol"), share("buyer").alias("buyer_pct"), share("seller").alias("seller_pct")
    )


def swings(bars: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Runs of closes in one direction, flat closes absorbed, of at least ``min_swing``.

    A run starts at the close before its first move; places count minutes from 0 in the session.
    """
    seq = Window.partitionBy(*DAY).orderBy("minute")
    b = bars.withColumns({"place": F.row_number().over(seq) - 1, "last": F.lag("close").over(seq)})
    b = b.withColumn("sign", F.signum(F.col("close") - F.col("last"))).withColumn("way", F.when(F.col("sign") != 0, F.col("sign")))
    before = seq.rowsBetween(Window.unboundedPreceding, -1)
    turn = F.col("way").isNotNull() & ~F.col("way").eqNullSafe(F.last("way", ignorenulls=True).over(before))
    b = b.withColumn("turn", turn.cast("int"))
    b = b.withColumn("run", F.sum("turn").over(seq)).where("run > 0")
    s = b.groupBy(*DAY, "run").agg(
        (F.min("place") - 1).alias("start_idx"), F.max("place").alias("end_idx"), F.min_by("last", "place").alias("start_price"), F.max_by("close", "place").alias("end_price")
    )
    size = F.col("end_price") - F.col("start_price")
    return s.where(F.abs(size) >= limits.min_swing).select(*DAY, F.when(size > 0, "bull").otherwise("bear").alias("direction"), half_up(F.abs(size), 3).alias("size"), "start_idx", "end_idx", "start_price", "end_price")


def auto_target(mean_size: Column, limits: Limits = LIMITS) -> Column:
    return half_up(F.greatest(F.lit(limits.target_floor), mean_size * 0.75), 2)


def swing_stats(runs: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Counts, sizes, spacing and longest runs of equal direction, by symbol and session with any swing."""
    seq, day = Window.partitionBy(*DAY).orderBy("start_idx"), Window.partitionBy(*DAY)
    c = F.col
    r = runs.withColumns({"auto_target": auto_target(F.avg("size").over(day), limits), "changed": (~F.lag("direction").over(seq).eqNullSafe(c("direction"))).cast("int")})
    r = r.withColumn("streak", F.sum("changed").over(seq))
    r = r.withColumn("length", F.row_number().over(Window.partitionBy(*DAY, "streak").orderBy("start_idx")))
    bull, bear = c("direction") == "bull", c("direction") == "bear"
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    n = F.count("*")
    return r.groupBy(*DAY).agg(
        F.count_if(bull).alias("bull_swings"),
        F.count_if(bear).alias("bear_swings"),
        n.alias("total_swings"),
        F.count_if(bull & (c("size") >= c("auto_target"))).alias("tradable_bull_swings"),
        zero(F.max(F.when(bull, c("size")))).alias("largest_bull_swing"),
        zero(F.max(F.when(bear, c("size")))).alias("largest_bear_swing"),
        half_up(F.avg("size"), 3).alias("avg_swing_size"),
        F.when(n > 1, half_up((F.max("start_idx") - F.min("start_idx")) / (n - 1), 2)).otherwise(0.0).alias("avg_time_btwn_swings"),
        F.coalesce(F.max(F.when(bull, c("length"))), F.lit(0)).alias("longest_bull_run"),
        F.coalesce(F.max(F.when(bear, c("length"))), F.lit(0)).alias("longest_bear_run"),
        F.max("auto_target").alias("auto_target_fils"),
    )


TRADES = "symbol string, trading_date date, start_idx int, level double, fib_price double, entry_minute int, entry_px double, win boolean, profit double, mins int"


def _trades(closes: np.ndarray, swing: dict, target: float, levels: tuple[float, ...]) -> Iterator[tuple]:
    """Of one swing, what each level's first touch came to."""
    high, low = max(swing["start_price"], swing["end_price"]), min(swing["start_price"], swing["end_price"])
    for level in levels:
        price = math.floor((high - level * (high - low)) * 1000.0 + 0.5) / 1000.0
        touched = np.abs(closes[swing["end_idx"] :] - price) <= 0.5
        if not touched.any():
            continue
        entry = swing["end_idx"] + int(touched.argmax())
        px = closes[entry]
        won, stopped = closes[entry:] >= px + target, closes[entry:] <= px - target
        won_at, stop_at = (int(x.argmax()) if x.any() else None for x in (won, stopped))
        win = won_at is not None and (stop_at is None or won_at < stop_at)
        out = entry + won_at if win else entry + stop_at if stop_at is not None else len(closes) - 1
        yield swing["start_idx"], level, price, entry, float(px), win, math.floor((closes[out] - px) * 1000.0 + 0.5) / 1000.0, won_at if win else None


def retracements(bars: DataFrame, runs: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """For each swing and level: the first touch at or after its end, and whether target or stop came first.

    Sessions are independent and short (a close for each minute), so each is one row of two arrays, searched in numpy.
    """
    closes = bars.groupBy(*DAY).agg(F.transform(F.array_sort(F.collect_list(F.struct("minute", "close"))), lambda b: b["close"]).alias("closes"))
    each = runs.groupBy(*DAY).agg(F.collect_list(F.struct("start_idx", "end_idx", "start_price", "end_price")).alias("swings"), auto_target(F.avg("size"), limits).alias("target"))
    levels = limits.fib_levels
    names = [c.split()[0] for c in TRADES.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.date32(), pa.int32(), pa.float64(), pa.float64(), pa.int32(), pa.float64(), pa.bool_(), pa.float64(), pa.int32()]
        for batch in batches:
            for k, (symbol, day, swings_, target) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 1, 3, 4)))):
                prices = batch.column(2)[k].values.to_numpy(zero_copy_only=False)
                found = [(symbol, day, *t) for swing in swings_ for t in _trades(prices, swing, target, levels)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found) if found else [()] * len(kinds), kinds)], names=names)

    return closes.join(each, [*DAY]).select(*DAY, "closes", "swings", "target").mapInArrow(run, TRADES)


def retracement_stats(trades: DataFrame) -> DataFrame:
    """Win share, mean profit and loss, holding time and the first hour with the best win rate."""
    c, hour = F.col, F.floor(F.col("entry_minute") / 60)
    hours = trades.groupBy(*DAY, hour.alias("hour")).agg((F.count_if("win") / F.count("*")).alias("rate"))
    best = hours.where("rate > 0").groupBy(*DAY).agg(F.max_by("hour", F.struct("rate", -c("hour"))).alias("best"))
    n, wins = F.count("*"), F.count_if("win")
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    g = trades.groupBy(*DAY).agg(
        n.alias("fib_signals"),
        wins.alias("successful_fib"),
        half_up(wins / n * 100.0, 2).alias("fib_win_pct"),
        zero(half_up(F.avg(F.when(c("win"), c("profit"))), 3)).alias("avg_profit_fib"),
        zero(half_up(F.avg(F.when(~c("win"), F.abs("profit"))), 3)).alias("avg_loss_fib"),
        zero(half_up(F.avg("mins"), 2)).alias("avg_time_to_target"),
        half_up((n - wins) / n * 100.0, 2).alias("false_signal_pct"),
    )
    clock = F.concat(F.lpad((F.coalesce("best", F.lit(0)) + 6).cast("string"), 2, "0"), F.lit(":00"))
    return g.join(best, [*DAY], "left").select(*g.columns, clock.alias("best_earning_time"))


def daily_study(captures: DataFrame, limits: Limits = LIMITS, least: int = 5) -> DataFrame:
    """The whole study of each symbol and session with at least ``least`` minutes."""
    bars = minute_bars(captures)
    day = bars.groupBy(*DAY).agg(
        F.min_by("open", "minute").alias("day_open"), F.max_by("close", "minute").alias("day_close"), F.max("high").alias("day_high"), F.min("low").alias("day_low"), F.sum("vol").alias("total_volume"), F.count("*").alias("bars")
    )
    day = day.where(F.col("bars") >= least).withColumns({"oc_margin": F.col("day_close") - F.col("day_open"), "day_range": F.col("day_high") - F.col("day_low")})
    runs = swings(bars, limits)
    out = day.join(volume_profile(bars, limits), [*DAY]).join(swing_stats(runs, limits), [*DAY], "left").join(retracement_stats(retracements(bars, runs, limits)), [*DAY], "left")
    counts = [x for x, t in out.dtypes if t in ("bigint", "int") and x not in DAY]
    sizes = [x for x, t in out.dtypes if t == "double" and x != "auto_target_fils"]
    return out.fillna(0, counts).fillna(0.0, sizes).fillna(limits.target_floor, ["auto_target_fils"]).fillna("06:00", ["best_earning_time"])
