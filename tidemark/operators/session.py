"""Facts of one symbol in one session: range, close, volume-gated movement and flow, coverage, look-backs.

Volume and trades are cumulative, so a step counts only where volume rose against the capture just before. One window
over (symbol, session) finds steps, and one aggregate over the same keys makes all facts, so captures are shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import LIMITS, Limits
from ..functions.scalars import data_quality, family_of, half_up, local_hour, local_minute, minute_bucket, ratio, tick_band_crossed, whole

#: Sessions that can close a day, by precedence, and how the source of a close is named.
CLOSE_TIERS = {"Close-Of-Day": 1, "Closing": 2, "Trading at Last": 3, "Close Auction Acceptance": 4, "Trading": 5, "": 5}
TIER_NAMES = ("CLOSE_OF_DAY", "CLOSING", "TRADING_AT_LAST", "AUCTION", "TRADING")
#: Sessions whose prices make a range, and those that can supply a previous close.
RANGE_SESSIONS = ("Trading", "CB Auction", "")
CLOSING_SESSIONS = ("Trading", "Close Auction Acceptance", "Trading at Last", "Close-Of-Day")

DAY = ("symbol", "trading_date")


def close_tier(session: Column) -> Column:
    """1 (best) to 5; null for sessions that can't close, null included."""
    tiers = F.create_map(*[F.lit(x) for pair in CLOSE_TIERS.items() for x in pair])
    return tiers[F.trim(session)]


def primary_only(rows: DataFrame, instruments: DataFrame, flag: str = "is_primary") -> DataFrame:
    """Without symbols whose flag is false; symbols the registry doesn't know stay."""
    return rows.join(instruments.where(~F.col(flag)).select("symbol"), "symbol", "left_anti")


def steps(quotes: DataFrame) -> DataFrame:
    """Captures with the one before (``prev_price``, ``prev_volume``), ``traded`` (null unless volume rose) and marks
    of minutes not seen before."""
    day = Window.partitionBy(*DAY).orderBy("created_at", "id")
    rise = F.col("volume") - F.col("prev_volume")
    q = quotes.withColumns({"prev_price": F.lag("last_price").over(day), "prev_volume": F.lag("volume").over(day), "minute": minute_bucket(F.col("created_at"))})
    q = q.withColumn("traded", F.when(rise > 0, rise))
    step_minute = F.when(F.col("traded").isNotNull(), F.col("minute"))
    before = day.rowsBetween(Window.unboundedPreceding, -1)
    return q.withColumns(
        {
            "new_minute": ~F.lag("minute").over(day).eqNullSafe(F.col("minute")),
            # a traded minute counts once for each half of the day
            "new_step_minute": step_minute.isNotNull() & ~F.max(step_minute).over(before).eqNullSafe(step_minute),
        }
    )


def _facts(limits: Limits) -> dict[str, Column]:
    c = F.col
    px, tier, session = c("last_price"), c("_tier"), c("_label")
    order = F.struct("created_at", "id")
    range_px = F.when(session.isin(*RANGE_SESSIONS) & (px > 0), px)
    in_range = session.isin(*RANGE_SESSIONS)
    can_close = (px > 0) & tier.isNotNull()
    step, move = c("traded").isNotNull(), c("last_price") - c("prev_price")
    moved = step & (move != 0)
    tiny = F.coalesce(c("last_qty") <= limits.tiny_shares, F.lit(False))
    at_offer = F.coalesce(px >= c("offer"), F.lit(False))
    at_bid = ~at_offer & F.coalesce(px <= c("bid"), F.lit(False))
    spread = c("offer") - c("bid")
    minute = c("_minute")
    first = minute < limits.midpoint
    n = lambda x: F.count_if(x)
    total = lambda x: F.coalesce(F.sum(F.when(x, c("traded"))), F.lit(0))
    return {
        "open_px": F.min_by(range_px, F.when(range_px.isNotNull(), order)),
        "high_px": F.max(range_px),
        "low_px": F.min(range_px),
        "close": F.max_by(F.struct(px.alias("px"), tier.alias("tier")), F.when(can_close, F.struct(-tier, order))),
        "last_range_minute": F.max(F.when(in_range, minute)),
        "only_cb": F.bool_and(F.when(in_range, session == "CB Auction")),
        "has_close_of_day": F.coalesce(F.bool_or(session == "Close-Of-Day"), F.lit(False)),
        "total_volume": F.max("volume"),
        "trades": F.max("trades"),
        "highest_minute_volume": F.max("traded"),
        "steps": n(step),
        "moves": n(moved),
        "up_moves": n(moved & (move > 0)),
        "down_moves": n(moved & (move < 0)),
        "up_moves_2plus": n(moved & (move >= 2)),
        "up_moves_3plus": n(moved & (move >= 3)),
        "up_moves_tiny": n(moved & (move > 0) & tiny),
        "down_moves_tiny": n(moved & (move < 0) & tiny),
        "trades_under_100": n(step & tiny),
        "trades_at_offer": n(step & at_offer),
        "trades_at_bid": n(step & at_bid),
        "bought_at_offer": total(step & at_offer),
        "sold_at_bid": total(step & at_bid),
        "shares_inside_spread": total(step & ~at_offer & ~at_bid),
        "up_shares": total(moved & (move > 0)),
        "down_shares": total(moved & (move < 0)),
        "turnover": F.coalesce(F.sum(F.when(step, c("traded") * px)), F.lit(0.0)),
        "first_half": total(first),
        "second_half": total(~first),
        "first_minutes": n(c("new_step_minute") & first),
        "second_minutes": n(c("new_step_minute") & ~first),
        "spread": F.avg(F.when(step & (c("bid") > 0) & (c("offer") > 0) & (spread >= 0), spread)),
        "by_hour": F.array(*(F.sum(F.when(step & (c("_hour") == h), c("traded"))) for h in range(24))),
        "minutes_captured": n(c("new_minute")),
        "last_close": F.max_by(px, F.when((px > 0) & (c("session").isNull() | c("session").isin(*CLOSING_SESSIONS)), order)),
    }


def day_facts(quotes: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """One row for each symbol and session, without look-backs or the market's median."""
    at = F.col("created_at")
    q = steps(quotes).withColumns({"_label": F.trim("session"), "_tier": close_tier(F.col("session")), "_hour": local_hour(at), "_minute": local_minute(at)})  # named once, so that plans stay small
    f = q.groupBy(*DAY).agg(*(x.alias(name) for name, x in _facts(limits).items()))
    c = F.col
    pct = lambda a, b: half_up(F.when(c(b) != 0, 100.0 * c(a) / c(b)))
    up, down = F.when(c("n_upticks") > 0, c("up_shares") / c("n_upticks")), F.when(c("n_downticks") > 0, c("down_shares") / c("n_downticks"))
    f = f.withColumns({"n_upticks": c("up_moves"), "n_downticks": c("down_moves"), "close_px": c("close.px"), "close_source": F.get(F.array(*map(F.lit, TIER_NAMES)), c("close.tier") - 1), "pct_at_offer": pct("trades_at_offer", "steps")})
    most = F.array_max("by_hour")
    return f.select(
        *DAY,
        "open_px",
        "high_px",
        "low_px",
        (c("high_px") - c("low_px")).alias("day_range"),
        "close_px",
        "close_source",
        F.when(c("only_cb"), "CB_ONLY").when(c("last_range_minute") >= limits.full_range, "FULL").when(c("last_range_minute").isNotNull(), "SHORT").alias("range_source"),
        "total_volume",
        "trades",
        ratio(c("total_volume"), c("trades")).alias("avg_trade_size"),
        "highest_minute_volume",
        "steps",
        "moves",
        "up_moves",
        "down_moves",
        "up_moves_2plus",
        "up_moves_3plus",
        "up_moves_tiny",
        "down_moves_tiny",
        "trades_under_100",
        pct("up_moves_tiny", "up_moves").alias("tiny_pct_up"),
        pct("down_moves_tiny", "down_moves").alias("tiny_pct_down"),
        "bought_at_offer",
        "sold_at_bid",
        "shares_inside_spread",
        "trades_at_offer",
        "trades_at_bid",
        "pct_at_offer",
        F.when(~F.coalesce(c("pct_at_offer") > limits.at_offer_max, F.lit(False)), ratio(c("bought_at_offer"), c("sold_at_bid"))).alias("buy_sell_ratio"),
        half_up(up).alias("avg_uptick_shares"),
        half_up(down).alias("avg_downtick_shares"),
        half_up(F.when(down != 0, up / down)).alias("uptick_ratio"),
        "n_upticks",
        "n_downticks",
        half_up(c("turnover") / 1000.0).alias("turnover_kd"),
        ratio(c("first_half"), c("first_minutes")).alias("first_half_shares_per_min"),
        ratio(c("second_half"), c("second_minutes")).alias("second_half_shares_per_min"),
        half_up(c("spread")).alias("avg_spread_fils"),
        half_up(F.when(c("close_px") > 0, 100.0 * c("spread") / c("close_px"))).alias("avg_spread_pct"),
        F.when(most.isNotNull(), F.array_position("by_hour", most) - 1).cast("int").alias("peak_hour"),
        "minutes_captured",
        "has_close_of_day",
        family_of(c("close_px"), limits).alias("family"),
        tick_band_crossed(c("close_px"), c("high_px"), limits).alias("tick_band_crossed"),
        "last_close",
    )


def with_market_median(days: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Coverage and quality against the session's median of minutes captured."""
    median = days.groupBy("trading_date").agg(whole(F.percentile("minutes_captured", 0.5)).alias("market_median"))
    d = days.join(median, "trading_date")
    return d.withColumns(
        {
            "coverage_pct": half_up(F.when(F.col("market_median") != 0, 100.0 * F.col("minutes_captured") / F.col("market_median")), 2),
            "data_quality": data_quality(F.col("minutes_captured"), F.col("market_median"), F.col("has_close_of_day"), limits),
        }
    )


def usable_sessions(quotes: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """(trading_date, nth, usable): sessions in order, and whether capture lasted long enough to supply a close."""
    ends = quotes.groupBy("trading_date").agg(F.max("created_at").alias("last_capture"))
    usable = local_minute(F.col("last_capture")) >= limits.close_cutoff
    return ends.select("trading_date", usable.alias("usable"), F.row_number().over(Window.orderBy("trading_date")).alias("nth"))  # a row a session


def with_look_backs(days: DataFrame, sessions: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Previous close and the one five back, changes, sessions active of the last twenty, and the run of falls.

    Closes count only from sessions that lasted; a previous close may be ``max_sessions_back`` sessions old at most.
    """
    c = F.col
    d = days.join(sessions.select("trading_date", "nth", "usable"), "trading_date")
    d = d.withColumn("usable_close", F.when(c("usable"), c("last_close")))
    of = Window.partitionBy("symbol", c("usable_close").isNotNull()).orderBy("trading_date")
    d = d.withColumn("fifth", F.when(c("usable_close").isNotNull(), F.lag("usable_close", 4).over(of)))
    back = Window.partitionBy("symbol").orderBy("trading_date")
    before = back.rowsBetween(Window.unboundedPreceding, -1)
    seen = F.when(c("usable_close").isNotNull(), F.struct(c("usable_close").alias("px"), c("trading_date").alias("day"), c("fifth"), c("nth")))
    d = d.withColumn("prev", F.last(seen, ignorenulls=True).over(before))
    near = F.lit(True) if limits.max_sessions_back is None else c("nth") - c("prev.nth") <= limits.max_sessions_back
    d = d.withColumns(
        {
            "prev_close": F.when(near, c("prev.px")),
            "prev_session_used": F.when(near, c("prev.day")),
            "chg_5d": half_up(F.when(c("prev.fifth") != 0, 100.0 * (c("close_px") - c("prev.fifth")) / c("prev.fifth"))),
        }
    )
    d = d.withColumns(
        {
            "prev_session_gap_days": F.datediff("trading_date", "prev_session_used"),
            "chg_fils": c("close_px") - c("prev_close"),
            "chg_1d": half_up(F.when(c("prev_close") != 0, 100.0 * (c("close_px") - c("prev_close")) / c("prev_close"))),
        }
    )
    recent = Window.partitionBy("symbol").orderBy("nth").rangeBetween(1 - limits.active_sessions, 0)
    place = F.row_number().over(back)
    stop = F.when(F.coalesce(c("chg_fils"), F.lit(0.0)) >= 0, c("place"))
    d = d.withColumn("days_active", F.count_if(c("total_volume") > 0).over(recent)).withColumn("place", place)
    d = d.withColumn("down_days", (c("place") - F.coalesce(F.max(stop).over(back), F.lit(0))).cast("long"))
    return d.drop("usable_close", "fifth", "prev", "place", "nth", "usable", "last_close", "has_close_of_day")


def symbol_day(quotes: DataFrame, instruments: DataFrame | None = None, limits: Limits = LIMITS) -> DataFrame:
    """All facts for each symbol and session; with a registry, of symbols not known to be secondary."""
    kept = quotes if instruments is None else primary_only(quotes, instruments)
    return with_look_backs(with_market_median(day_facts(kept, limits), limits), usable_sessions(quotes, limits), limits)


def markets_disagree(quotes: DataFrame, market: str = "market") -> DataFrame:
    """Symbols seen under more than one market in a session; must be empty before a session is computed."""
    return quotes.groupBy(*DAY).agg(F.sort_array(F.collect_set(market)).alias("markets")).where(F.size("markets") > 1)


def prev_session(sessions: DataFrame, n: int = 1) -> DataFrame:
    """(trading_date, prev_date): the session ``n`` before each, or the oldest where there are fewer; null for the oldest."""
    order = Window.orderBy("trading_date")  # a row a session
    days = sessions.select("trading_date").distinct()
    oldest = F.first("trading_date").over(order)
    back = F.coalesce(F.lag("trading_date", n).over(order), F.when(oldest < F.col("trading_date"), oldest))
    return days.select("trading_date", back.alias("prev_date"))


def session_close(quotes: DataFrame) -> DataFrame:
    """The latest price of each symbol and session from a session that can close it, or an unlabelled one."""
    ok = (F.col("last_price") > 0) & (F.col("session").isNull() | F.col("session").isin(*CLOSING_SESSIONS))
    return quotes.where(ok).groupBy(*DAY).agg(F.max_by("last_price", F.struct("created_at", "id")).alias("close_px"))


def prev_session_of_symbol(quotes: DataFrame) -> DataFrame:
    """Each symbol's own session before each of its sessions."""
    days = quotes.select(*DAY).distinct()
    return days.withColumn("prev_date", F.lag("trading_date").over(Window.partitionBy("symbol").orderBy("trading_date")))
