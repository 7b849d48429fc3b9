"""Activity pace against each symbol's own past, and the slots that the fastest symbols win."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import LIMITS, Limits
from ..functions.scalars import half_up, local_hour


def pace(quotes: DataFrame, at_hour: int, until_hour: bool = False, limits: Limits = LIMITS) -> DataFrame:
    """Today's trades over the median of trades by ``at_hour`` in the last sessions with data, for every session at once.

    Trades are cumulative. Without a positive median pace is unknown. ``until_hour`` also cuts today at the hour.
    """
    q = quotes.where("trades is not null")
    by_hour = F.max(F.when(local_hour(F.col("created_at")) <= at_hour, F.col("trades")))
    day = q.groupBy("symbol", "trading_date").agg((by_hour if until_hour else F.max("trades")).alias("trades"), by_hour.alias("by_hour")).where("trades is not null")
    sessions = quotes.select("trading_date").distinct().withColumn("nth", F.row_number().over(Window.orderBy("trading_date")))  # a row a session
    past = Window.partitionBy("symbol").orderBy("nth").rangeBetween(-limits.baseline_sessions, -1)
    d = day.join(sessions, "trading_date").withColumns({"median_trades": F.percentile("by_hour", 0.5).over(past), "sessions": F.count("by_hour").over(past)})
    return d.select("symbol", "trading_date", "trades", "median_trades", "sessions", half_up(F.when(F.col("median_trades") > 0, F.col("trades") / F.col("median_trades")), 3).alias("pace"))


PROMOTIONS = "trading_date date, scan int, symbol string, trades long, pace double, slot int, replaced string"


def deal(held: dict[int, tuple[str, float]], symbol: str, speed: float, slots: tuple[int, ...]) -> tuple[int, str | None] | None:
    """The slot that a candidate wins and whom it replaces, if it wins one; ``held`` (slot to symbol and pace) follows.

    A holder keeps its slot; a free slot comes first; else the slowest holder goes, if the newcomer is strictly faster.
    """
    if any(symbol == s for s, _ in held.values()):
        return None
    slot, replaced = next((s for s in slots if s not in held), None), None
    if slot is None:
        slot = min(held, key=lambda s: (held[s][1], s))
        if speed <= held[slot][1]:
            return None
        replaced = held[slot][0]
    held[slot] = (symbol, speed)
    return slot, replaced


def allocate(scans: Iterable[list[tuple]], slots: tuple[int, ...]) -> list[tuple]:
    """Promotions of one session. ``scans``: for each scan its (symbol, pace, trades), the fastest first."""
    held: dict[int, tuple[str, float]] = {}
    out = []
    for scan, rows in enumerate(scans):
        for symbol, speed, trades in rows:
            got = deal(held, symbol, speed, slots)
            if got:
                out.append((scan, symbol, trades, speed, *got))
    return out


def scan(paces: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Promotions over all scans of each session, from (trading_date, scan, symbol, trades, pace).

    The fold depends on order, so a session is one task; its candidates are at most the listed symbols for each scan.
    """
    slots = limits.wakeup_slots

    def fold(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["scan", "pace", "symbol"], ascending=[True, False, True])
        numbers, scans = [], []
        for n, part in rows.groupby("scan", sort=True):
            numbers.append(n)
            scans.append(list(part[["symbol", "pace", "trades"]].itertuples(index=False, name=None)))
        out = [(key[0], numbers[k], *rest) for k, *rest in allocate(scans, slots)]
        return pd.DataFrame(out, columns=[c.split()[0] for c in PROMOTIONS.split(", ")])

    firing = paces.where((F.col("pace") >= limits.pace_min) & (F.col("trades") >= limits.trades_min)).select("trading_date", "scan", "symbol", "trades", "pace")
    return firing.groupBy("trading_date").applyInPandas(fold, PROMOTIONS)


def throttled(signals: DataFrame, limits: Limits = LIMITS, ts: str = "fired_at") -> DataFrame:
    """Signals to send: of each symbol and signal none within ``throttle_secs`` of the last one sent.

    Whether one is sent depends on the one sent before it, so this is a fold: each task streams its keys in order.
    """
    keys, gap = ("symbol", "signal", "trading_date"), limits.throttle_secs

    def keep(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        at, last = None, None
        for rows in batches:
            sent = []
            for key, t in zip(zip(*(rows[k] for k in keys)), rows[ts]):
                if key != at:
                    at, last = key, None
                ok = last is None or (t - last).total_seconds() >= gap
                last = t if ok else last
                sent.append(ok)
            yield rows[sent]

    return signals.repartition(*keys).sortWithinPartitions(*keys, ts, "id").mapInPandas(keep, signals.schema)
