"""Snapshots of the book with state carried from one to the next, the seven checks on them, and later scoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import LIMITS, Limits
from ..functions.scalars import half_up

#: Which way each signal expects the price to go (0: no claim).
DIRECTION = {"BUYERS_8_5": 1, "WALL_PULLED": 1, "WAKEUP": 1, "PREDAY": 0, "NO_PROTECTION": -1, "BID_EMPTY": -1, "BAIT_BID": -1, "WALL_PLACED": -1, "FROZEN": 0}


def _from_other_days(rows: DataFrame, on: str, value: str, known: Column, order: Column, later: bool) -> DataFrame:
    """(``on``, ``_day``, ``_far``): for each day the first value of later days, or the last of earlier ones.

    One row a key and day, so long histories of one key are never sorted as a whole.
    """
    pick = F.min_by if later else F.max_by
    days = rows.groupBy(on, "_day").agg(pick(value, F.when(known, order)).alias("_v"))
    far = Window.partitionBy(on).orderBy(F.desc("_day") if later else F.asc("_day")).rowsBetween(Window.unboundedPreceding, -1)
    return days.select(on, "_day", F.last("_v", ignorenulls=True).over(far).alias("_far"))


def last_known(left: DataFrame, right: DataFrame, columns: list[str], on: str = "symbol", ts: str = "created_at") -> DataFrame:
    """Backward as-of join: each left row with the latest right row at or before it, by union and one window a day.

    Both sides need ``id`` for ties; of right rows at one instant the largest id is the latest.
    """
    keep = left.columns
    r = right.select(on, ts, "id", F.struct(*columns).alias("_r"))
    both = left.withColumns({"_side": F.lit(1), "_r": F.lit(None).cast(r.schema["_r"].dataType)}).unionByName(r.withColumn("_side", F.lit(0)), allowMissingColumns=True).withColumn("_day", F.to_date(ts))
    w = Window.partitionBy(on, "_day").orderBy(ts, "_side", "id").rowsBetween(Window.unboundedPreceding, 0)
    near = both.withColumn("_r", F.last("_r", ignorenulls=True).over(w)).where("_side = 1")
    far = _from_other_days(both, on, "_r", F.col("_side") == 0, F.struct(ts, "id"), later=False)
    got = near.join(far, [on, "_day"], "left").withColumn("_r", F.coalesce("_r", "_far"))
    return got.select(*keep, *(F.col(f"_r.{x}").alias(x) for x in columns))


def first_after(targets: DataFrame, prices: DataFrame, value: str, at: str, name: str, on: str = "symbol", ts: str = "created_at") -> DataFrame:
    """Forward as-of join: each target with the first non-null ``value`` at or after its instant ``at``.

    No bound in time; of prices at one instant the one with the smallest id counts.
    """
    p = prices.where(F.col(value).isNotNull()).select(on, F.col(ts).alias("_at"), F.col("id").alias("_id"), F.col(value).alias(name))
    t = targets.withColumns({"_at": F.col(at), "_target": F.lit(1)})
    both = t.unionByName(p.withColumn("_target", F.lit(0)), allowMissingColumns=True).withColumn("_day", F.to_date("_at"))
    w = Window.partitionBy(on, "_day").orderBy(F.desc("_at"), "_target", F.desc("_id")).rowsBetween(Window.unboundedPreceding, 0)
    near = both.withColumn(name, F.last(name, ignorenulls=True).over(w)).where("_target = 1")
    far = _from_other_days(both, on, name, F.col("_target") == 0, F.struct("_at", "_id"), later=True)
    return near.join(far, [on, "_day"], "left").withColumn(name, F.coalesce(name, "_far")).drop("_at", "_id", "_target", "_day", "_far")


def _age(price: str, seq, elapsed: Column) -> tuple[Column, Column]:
    """Whether a level is new at a row, and the seconds it gained since the row before."""
    new = F.col(price).isNull() | ~(F.lag(price).over(seq) == F.col(price)) | F.lag(price).over(seq).isNull()
    return new, F.when(new, 0).otherwise(elapsed)


def snapshots(seen: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Observations (with book sizes) as snapshots: volume since the last known figure, changes, walls, level ages.

    A level's age lives on while its price stays, whatever its size does; gaps are rounded to seconds before they add up.
    """
    c = F.col
    seq = Window.partitionBy("symbol", "trading_date").orderBy("created_at", "id")
    before = seq.rowsBetween(Window.unboundedPreceding, -1)
    elapsed = F.greatest(F.lit(0), F.floor(_seconds("created_at") - _seconds_lag("created_at", seq) + 0.5))
    new_bid, bid_gain = _age("bid", seq, elapsed)
    new_offer, offer_gain = _age("offer", seq, elapsed)
    rise = c("volume") - F.last("volume", ignorenulls=True).over(before)
    m = seen.withColumns(
        {
            "volume_delta": F.when(rise >= 0, rise),
            "bid_change": c("bid_qty") - F.lag("bid_qty").over(seq),
            "offer_change": c("offer_qty") - F.lag("offer_qty").over(seq),
            "_bid_new": new_bid.cast("int"),
            "_offer_new": new_offer.cast("int"),
            "_bid_gain": bid_gain,
            "_offer_gain": offer_gain,
        }
    )
    m = m.withColumns({"_bid_level": F.sum("_bid_new").over(seq), "_offer_level": F.sum("_offer_new").over(seq)})
    age = lambda side: F.when(c(side).isNotNull(), F.sum(f"_{side}_gain").over(Window.partitionBy("symbol", "trading_date", f"_{side}_level").orderBy("created_at", "id"))).cast("long")
    return described(m.withColumns({"bid_age_secs": age("bid"), "offer_age_secs": age("offer")}), limits)


def described(m: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Snapshots from observations that know their changes, traded volume and ages: walls, ratio, and whether frozen."""
    c = F.col
    moved = c("offer_change") != 0
    event = F.when(moved & (c("volume_delta") == 0), F.when(c("offer_change") > 0, "ADDED").otherwise("PULLED")).when(moved & c("volume_delta").isNotNull() & (c("offer_change") < 0), "TRADED")
    size = F.abs("offer_change")
    small = (event != "TRADED") & (size < limits.wall_qty) & ~F.coalesce(c("offer_qty") >= limits.wall_qty, F.lit(False))
    event = F.when(~small, event)
    m = m.withColumn("wall_event", event)
    big = (c("bid_qty") > limits.big_qty) & (c("offer_qty") > limits.big_qty) & (c("volume_delta") == 0)
    return m.select(
        "symbol",
        c("created_at").alias("ts"),
        "id",
        "trading_date",
        "last_price",
        "bid",
        "bid_qty",
        "offer",
        "offer_qty",
        half_up(F.when(c("offer_qty") != 0, c("bid_qty").cast("double") / c("offer_qty"))).alias("buyers_per_seller"),
        "bid_age_secs",
        "offer_age_secs",
        "bid_change",
        "offer_change",
        "wall_event",
        F.when(c("wall_event").isNotNull(), c("offer")).alias("wall_price"),
        F.when(c("wall_event").isNotNull(), size).alias("wall_qty"),
        "volume_delta",
        F.when(c("bid_qty").isNotNull() & c("offer_qty").isNotNull() & c("volume_delta").isNotNull(), big).alias("is_frozen"),
    )


def _seconds(ts: str) -> Column:
    return F.datediff(F.col(ts), F.lit("1970-01-01").cast("date")) * 86400.0 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.extract(F.lit("SECOND"), F.col(ts)).cast("double")


def _seconds_lag(ts: str, seq) -> Column:
    return F.lag(_seconds(ts)).over(seq)


SIGNAL_COLUMNS = ("last_price", "bid_qty", "offer_qty", "offer", "volume_delta", "bid_age_secs")


def assert_shape(rows: DataFrame, needed: tuple[str, ...] = SIGNAL_COLUMNS) -> None:
    """Raise and name what is missing, rather than let a check stay silent on a column that isn't there."""
    missing = sorted(set(needed) - set(rows.columns))
    if missing:
        raise ValueError(f"snapshot rows lack {', '.join(missing)}")


def grouped(x: Column) -> Column:
    """A whole number with thousands separators."""
    return F.format_number(x, 0)


def plain(x: Column) -> Column:
    """A number as short as it can be written: no decimals if it is whole."""
    return F.when(x == F.floor(x), F.floor(x).cast("string")).otherwise(x.cast("string"))


def signals(rows: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Every hit of the seven checks on each snapshot and the one before it: none to seven rows a pair.

    An unknown volume silences the checks that depend on it.
    """
    assert_shape(rows)
    c = F.col
    seq = Window.partitionBy("symbol", "trading_date").orderBy("ts", "id")
    pair = rows.withColumns({"_px": F.lag("last_price").over(seq), "_offer_qty": F.lag("offer_qty").over(seq), "_nth": F.row_number().over(seq)}).where("_nth > 1")
    before, px, bq, oq, had, traded = c("_px"), c("last_price"), c("bid_qty"), c("offer_qty"), c("_offer_qty"), F.when(c("volume_delta") >= 0, c("volume_delta"))
    buyers = F.when(oq != 0, bq.cast("double") / oq)
    change = F.concat(F.lit("offer "), grouped(had), F.lit(" to "), grouped(oq), F.lit(" with no volume"))
    checks = {
        "NO_PROTECTION": (bq < limits.no_protection_bid, F.concat(F.lit("bid "), grouped(bq), F.lit(f" < {limits.no_protection_bid:,}"))),
        "BUYERS_8_5": ((buyers >= limits.buyers_ratio) & (px > before), F.concat(F.lit("ratio "), F.format_string("%.2f", half_up(buyers, 2)), F.lit(" with price "), plain(before), F.lit(" to "), plain(px))),
        "WALL_PLACED": ((oq > had) & (traded == 0), change),
        "WALL_PULLED": ((oq < had) & (traded == 0), change),
        "BAIT_BID": ((bq > limits.big_qty) & (c("bid_age_secs") < limits.bait_age), F.concat(F.lit("bid "), grouped(bq), F.lit(" only "), c("bid_age_secs").cast("string"), F.lit("s old"))),
        "FROZEN": ((bq > limits.big_qty) & (oq > limits.big_qty) & (traded == 0), F.concat(F.lit("bid "), grouped(bq), F.lit(" / offer "), grouped(oq), F.lit(", nothing traded"))),
        "BID_EMPTY": ((px < before) & (traded > 0) & (traded <= limits.tiny_trade), F.concat(traded.cast("string"), F.lit(" share(s) moved the price "), plain(before), F.lit(" to "), plain(px))),
    }
    hits = F.array(*(F.when(test, F.struct(F.lit(name).alias("signal"), text.alias("detail"))) for name, (test, text) in checks.items()))
    out = pair.withColumn("hit", F.explode(F.array_compact(hits)))
    return out.select("symbol", "trading_date", c("ts").alias("fired_at"), "id", "hit.signal", "hit.detail", c("last_price").alias("price"))


def alert_text(symbol: Column, price: Column, signal: Column, detail: Column) -> Column:
    """A signal as one line of text; without a price that part is left out."""
    at = F.coalesce(F.concat(F.lit(" @ "), plain(price)), F.lit(""))
    return F.trim(F.concat(symbol, at, F.lit(" — "), signal, F.lit(": "), F.coalesce(detail, F.lit(""))))


def score(fired: DataFrame, prices: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Prices 5, 15 and 60 minutes after each signal, and whether the first moved as expected.

    Signals without direction, price or later price are not graded, but they have been looked at.
    """
    all_ = limits.score_minutes
    t = fired.withColumn("_m", F.explode(F.array(*map(F.lit, all_)))).withColumn("_t", F.col("fired_at") + F.make_dt_interval(mins=F.col("_m")))
    got = first_after(t, prices, "last_price", "_t", "_px", ts="ts").groupBy(*fired.columns)
    out = got.agg(*(F.max(F.when(F.col("_m") == m, F.col("_px"))).alias(f"px_{m}min") for m in all_), (F.count("*") / len(all_)).cast("int").alias("_n"))
    return graded(out.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_n")))).drop("_n"), limits)  # repeated signals stay so


def graded(out: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Whether the first later price moved as the signal claims."""
    ways = F.create_map(*[F.lit(x) for pair in DIRECTION.items() for x in pair])
    way = ways[F.col("signal")]
    move = (F.col(f"px_{limits.score_minutes[0]}min") - F.col("price")) * way
    return out.withColumns({"was_right": F.when(way != 0, move >= limits.min_move), "scored": F.lit(True)})


def tally(scored: DataFrame) -> DataFrame:
    return scored.groupBy("signal").agg(F.count_if("was_right").alias("right_n"), F.count("was_right").alias("graded"), F.count("*").alias("fired"))
