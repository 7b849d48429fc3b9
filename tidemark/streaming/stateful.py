"""Stateful operators over captures: snapshots, the board's fields, minute volumes, slots and later prices.

Each is a processor with its own named states and event-time timers, keyed so that no key's state grows with the feed:
a symbol's day, a symbol's fields, a session's slots, the open signals of a symbol's day. Times are microseconds inside. The rows of
one key in one micro-batch are put in order first; what arrives behind the watermark is dropped by Spark.
"""

from __future__ import annotations

import datetime as dt
import pickle
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from ..config import LIMITS, Limits
from ..operators import minute, wakeup
from . import capture

SECOND, MINUTE, HOUR, DAY = 1_000_000, 60_000_000, 3_600_000_000, 86_400_000_000


def _ms(micros: int) -> int:
    """The first millisecond that isn't before an instant."""
    return -(-micros // 1000)


def _maker(schema: str) -> Row:
    """Makes rows of a schema from values in order."""
    return Row(*(c.split()[0] for c in schema.split(", ")))


class Forgetful(StatefulProcessor):
    """Lets a key's states go once the watermark is ``keep`` past its last row; ``last`` remembers that row's instant.

    One timer a key: where rows came since it was set, it is set anew when it fires.
    """

    def __init__(self, keep: int):
        self.keep = keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at long")

    def seen(self, at: int) -> int | None:
        """Note a row's instant; returns that of the last one."""
        had = self.last.get()[0] if self.last.exists() else None
        if had is None:
            self.handle.registerTimer(_ms(at + self.keep))
        if had is None or at > had:
            self.last.update((at,))
        return had

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.last.exists():
            return
        due = _ms(self.last.get()[0] + self.keep)
        if due > expiredTimerInfo.getExpiryTimeInMs():
            self.handle.registerTimer(due)
        else:
            self.forget()
        yield from ()

    def forget(self) -> None:
        self.last.clear()

    def close(self) -> None:
        pass


def _with_micros(rows: DataFrame, ts: str, limits: Limits) -> DataFrame:
    """Rows with a watermark on ``ts`` and its microseconds as ``us``."""
    return rows.withWatermark(ts, f"{limits.late_minutes} minutes").withColumn("us", F.unix_micros(ts))


def _run(rows: DataFrame, keys: list[str], processor: StatefulProcessor, schema: str, mode: str = "Append", initial=None) -> DataFrame:
    return rows.groupBy(*keys).transformWithState(processor, schema, mode, "EventTime", initial)


# Snapshots


class Snapshots(Forgetful):
    """What a snapshot owes to the one before it: changes, traded volume and ages of levels."""

    OUT = "symbol string, trading_date date, us long, id long, last_price double, bid double, bid_qty long, offer double, offer_qty long, volume_delta long, bid_change long, offer_change long, bid_age_secs long, offer_age_secs long"

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.row = _maker(self.OUT)
        self.carried = handle.getValueState("carried", "volume long, bid double, bid_qty long, bid_age long, offer double, offer_qty long, offer_age long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        had = self.carried.get() if self.carried.exists() else (None,) * 7
        volume, bid, bid_qty, bid_age, offer, offer_qty, offer_age = had
        last = self.last.get()[0] if self.last.exists() else None
        for r in sorted(rows, key=lambda r: (r.us, r.id)):
            if last is not None and r.us <= last:
                continue  # the observation has not moved on
            gap = 0 if last is None else (r.us - last + SECOND // 2) // SECOND
            bid_age, offer_age = _age(r.bid, bid, bid_age, gap), _age(r.offer, offer, offer_age, gap)
            rise = None if r.volume is None or volume is None or r.volume < volume else r.volume - volume
            yield self.row(key[0], key[1], r.us, r.id, r.last_price, r.bid, r.bid_qty, r.offer, r.offer_qty, rise, _change(r.bid_qty, bid_qty), _change(r.offer_qty, offer_qty), bid_age, offer_age)
            volume = volume if r.volume is None else r.volume
            bid, bid_qty, offer, offer_qty = r.bid, r.bid_qty, r.offer, r.offer_qty
            last = r.us
        if last is not None:
            self.seen(last)
            self.carried.update((volume, bid, bid_qty, bid_age, offer, offer_qty, offer_age))

    def forget(self) -> None:
        super().forget()
        self.carried.clear()


def _age(price, before, age, gap):
    return None if price is None else (age or 0) + gap if before == price else 0


def _change(now, before):
    return None if now is None or before is None else now - before


def snapshots(observations: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Snapshots of each symbol's day, as :func:`minute.snapshots` makes them, with state carried from batch to batch.

    An observation that isn't newer than the last is skipped; a day's state goes once the stream is a day past it.
    """
    rows = _with_micros(observations, "created_at", limits).select("symbol", "trading_date", "created_at", "us", "id", "last_price", "volume", "bid", "bid_qty", "offer", "offer_qty")
    out = _run(rows, ["symbol", "trading_date"], Snapshots(DAY), Snapshots.OUT)
    return minute.described(out.withColumn("created_at", F.timestamp_micros("us")), limits)


# The board


class Board(Forgetful):
    """Partial frames merged field by field: each field has an entry with its value and the instant it was last sent."""

    def __init__(self, fields: tuple[str, ...], expiry: int, keep: int):
        super().__init__(keep)
        self.fields, self.expiry = fields, expiry
        self.out = ", ".join(["symbol string", "us long", *(f"{f} double" for f in fields), *(f"{f}_age_secs long" for f in fields)])

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.row = _maker(self.out)
        self.entries = handle.getMapState("fields", "field string", "value double, at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = {k[0]: v for k, v in self.entries.iterator()}
        newest, sent = None, set()
        for r in sorted(rows, key=lambda r: r.us):
            newest = r.us
            for f in self.fields:
                if r[f] is not None and (f not in known or known[f][1] <= r.us):
                    known[f] = (r[f], r.us)
                    sent.add(f)
        had = self.seen(newest)
        at = newest if had is None else max(had, newest)
        values, ages = [], []
        for f in self.fields:
            value, then = known.get(f, (None, None))
            if then is not None and at - then > self.expiry:
                if f not in sent or self.entries.containsKey((f,)):
                    self.entries.removeKey((f,))
                value = then = None
            elif f in sent:
                self.entries.updateValue((f,), (value, then))
            values.append(value)
            ages.append(None if then is None else (at - then) // SECOND)
        yield self.row(key[0], at, *values, *ages)

    def forget(self) -> None:
        super().forget()
        self.entries.clear()


def board(frames: DataFrame, fields: tuple[str, ...], expiry_secs: int = 7 * 86400, keep_secs: int = 7 * 86400, limits: Limits = LIMITS) -> DataFrame:
    """(symbol, ts, each field, its age in seconds): the last known value of each field, from (symbol, ts, fields).

    An age is the time from the field's own last frame to the symbol's. A field not sent for ``expiry_secs`` is unknown
    again, a symbol not seen for ``keep_secs`` is forgotten. Update mode: a symbol's last row is its board. Only frames
    that are the newest of something in their Arrow batch reach the processor, so a busy symbol's task stays short.
    """
    processor = Board(fields, expiry_secs * SECOND, keep_secs * SECOND)
    slim = frames.select("symbol", "ts", *(F.col(f).cast("double").alias(f) for f in fields))
    rows = _with_micros(capture.thinned(slim, "symbol", "ts", fields), "ts", limits)
    out = _run(rows, ["symbol"], processor, processor.out, "Update")
    return out.select("symbol", F.timestamp_micros("us").alias("ts"), *(c for c in out.columns if c not in ("symbol", "us")))


def listed(rows: DataFrame, master: DataFrame, limits: Limits = LIMITS, priced: str = "last") -> DataFrame:
    """The board joined with the symbol master by any alias, and whether the price is stale."""
    age = F.col(f"{priced}_age_secs")
    named = rows.withColumns({"alias": F.upper(F.trim("symbol")), "stale": F.coalesce(age > limits.stale_secs, F.lit(True))}).drop("symbol")
    return named.join(master, "alias")


# Minute volumes


class Volumes(Forgetful):
    """The rise of a cumulative figure over the highest seen in the session's closed minutes."""

    OUT = "symbol string, trading_date date, us long, open double, high double, low double, close double, vol long"

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.row = _maker(self.OUT)
        self.highest = handle.getValueState("highest", "volume long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        had = self.highest.get()[0] if self.highest.exists() else 0
        for r in sorted(rows, key=lambda r: r.us):
            now = had if r.cumulative is None else r.cumulative
            yield self.row(key[0], key[1], r.us, r.open, r.high, r.low, r.close, max(0, now - had))
            had, last = max(had, now), r.us
        self.seen(last)
        self.highest.update((had,))

    def forget(self) -> None:
        super().forget()
        self.highest.clear()


def minute_volumes(quotes: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Bars with the volume traded in their own minute: closed windows, then a running maximum over them."""
    closed = capture.minute_windows(quotes, limits).withColumn("at", F.window_time("w"))
    rows = closed.select("symbol", "trading_date", "at", F.unix_micros("w.start").alias("us"), *(F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close")), F.col("cumulative").cast("long").alias("cumulative"))
    out = _run(rows, ["symbol", "trading_date"], Volumes(DAY), Volumes.OUT)
    return out.select("symbol", "trading_date", F.timestamp_micros("us").alias("minute"), "open", "high", "low", "close", "vol")


# Slots


class Slots(StatefulProcessor):
    """A session's slots: a scan's candidates wait for its instant, then are dealt as :func:`wakeup.deal` says.

    At the session's end each holder is released and the state goes.
    """

    OUT = "trading_date date, scan int, event string, slot int, slot_type string, symbol string, trades long, pace double, replaced string"

    def __init__(self, slots: tuple[int, ...], end: int):
        self.slots, self.end = slots, end

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.row = handle, _maker(self.OUT)
        self.held = handle.getMapState("held", "slot int", "symbol string, pace double, slot_type string")
        self.waiting = handle.getListState("waiting", "us long, scan int, symbol string, trades long, pace double")
        self.ends = handle.getValueState("ends", "us long")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.held.updateValue((initialState.slot,), (initialState.symbol, None, "PREDAY"))
        self.open(initialState.opens)

    def open(self, midnight: int) -> None:
        if not self.ends.exists():
            self.ends.update((midnight + self.end,))
            self.handle.registerTimer(_ms(midnight + self.end))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for r in rows:
            if r.symbol is not None:  # else it only tells the time
                self.open(r.opens)
                self.waiting.appendValue((r.us, r.scan, r.symbol, r.trades, r.pace))
                self.handle.registerTimer(_ms(r.us))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        if self.waiting.exists():
            rows = list(self.waiting.get())
            due = sorted((r for r in rows if _ms(r[0]) <= now), key=lambda r: (r[0], r[1], -r[4], r[2]))
            if due:
                self.waiting.put([r for r in rows if _ms(r[0]) > now]) if len(due) < len(rows) else self.waiting.clear()
                held = {k[0]: (v[0], v[1]) for k, v in self.held.iterator() if v[2] == "WAKEUP"}
                for _, scan, symbol, trades, pace in due:
                    got = wakeup.deal(held, symbol, pace, self.slots)
                    if got:
                        slot, replaced = got
                        self.held.updateValue((slot,), (symbol, pace, "WAKEUP"))
                        yield self.row(key[0], scan, "PROMOTED", slot, "WAKEUP", symbol, trades, pace, replaced)
        if self.ends.exists() and now >= _ms(self.ends.get()[0]):
            for k, (symbol, pace, kind) in sorted(self.held.iterator()):
                yield self.row(key[0], None, "RELEASED", k[0], kind, symbol, None, pace, None)
            self.held.clear()
            self.ends.clear()

    def close(self) -> None:
        pass


def slots(paces: DataFrame, seeds: DataFrame, limits: Limits = LIMITS, end_hours: int = 24) -> DataFrame:
    """Promotions and releases of each session, from a stream (trading_date, at, scan, symbol, trades, pace).

    ``seeds`` (trading_date, slot, symbol) hold slots from the start that no candidate can win. A scan is dealt once the
    stream is past its instant, so its rows may come in any order and in several batches. A row without symbol only moves
    the clock. Sessions end ``end_hours`` after their midnight.
    """
    midnight = F.datediff("trading_date", F.lit("1970-01-01").cast("date")).cast("long") * DAY
    firing = paces.where(F.col("symbol").isNull() | ((F.col("pace") >= limits.pace_min) & (F.col("trades") >= limits.trades_min)))
    rows = _with_micros(firing, "at", limits).select("trading_date", "at", "us", midnight.alias("opens"), F.col("scan").cast("int").alias("scan"), "symbol", F.col("trades").cast("long").alias("trades"), F.col("pace").cast("double").alias("pace"))
    first = seeds.select("trading_date", F.col("slot").cast("int").alias("slot"), "symbol", midnight.alias("opens")).groupBy("trading_date")
    return _run(rows, ["trading_date"], Slots(limits.wakeup_slots, end_hours * HOUR), Slots.OUT, initial=first)


# Later prices


class LaterPrices(StatefulProcessor):
    """Open signals of a symbol's day with the earliest price known at or after each of their instants.

    A day's prices are its own and those that its last signals may still ask for. A price is final once the watermark is
    past it, as none before it can come any more; a signal goes out when all its prices are final, or when the day is over
    with those it has. Then the day's first price that an earlier day lacks goes out too. Prices that a late signal may ask
    for are kept. Rows of one key are looked up and stored together, and it has a timer for the next instant that settles
    something: a call to the state store for each row or signal would take longer than all else.
    """

    def __init__(self, minutes: tuple[int, ...]):
        self.minutes, self.reach = minutes, max(minutes) * MINUTE
        self.out = "symbol string, lane long, emitted timestamp, day long, us long, id long, signal string, trading_date date, price double, " + ", ".join(f"px_{m}min double" for m in minutes)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.row = handle, _maker(self.out)
        self.open = handle.getValueState("open", "packed binary")  # us, id, signal, trading_date, price, then at, id and price of each answer
        self.recent = handle.getValueState("recent", "packed binary")  # us, id, px
        self.first = handle.getValueState("first", "us long, id long, px double")

    def held(self, state) -> list[tuple]:
        return pickle.loads(state.get()[0]) if state.exists() else []

    def hold(self, state, rows: list[tuple]) -> None:
        state.update((pickle.dumps(rows),)) if rows else state.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        had, old = self.held(self.recent), self.held(self.open)
        came, new, unknown = [], [], (None,) * (3 * len(self.minutes))
        for r in rows:
            if r.signal is None:
                came.append((r.us, r.id, r.px))
            else:
                new.append((r.us, r.id, r.signal, r.trading_date, r.price, *unknown))
        came.sort()
        prices = sorted(had + came)
        begins = bisect_left(came, (key[1] * DAY + self.reach,))
        if begins < len(came) and (not self.first.exists() or came[begins] < tuple(self.first.get())):
            self.first.update(came[begins])
        signals = self.looked_up(old, came) + self.looked_up(new, prices)
        # a late signal fired after the watermark at the earliest, and asks for prices some minutes after that
        prices = prices[bisect_left(prices, (watermark * 1000 + min(self.minutes) * MINUTE,)) :]
        self.hold(self.recent, prices)
        yield from self.settle(key, signals, watermark)

    def looked_up(self, signals: list[tuple], prices: list[tuple]) -> list[tuple]:
        if not signals or not prices:
            return signals
        fired, at = np.array([s[0] for s in signals]), np.array([p[0] for p in prices])
        places = [np.searchsorted(at, fired + m * MINUTE).tolist() for m in self.minutes]
        out = []
        for s, *found in zip(signals, *places):
            answers = list(s[5:])
            for k, i in enumerate(found):
                if i < len(prices) and (answers[3 * k] is None or prices[i][:2] < (answers[3 * k], answers[3 * k + 1])):
                    answers[3 * k : 3 * k + 3] = prices[i]
            out.append((*s[:5], *answers))
        return out

    def settle(self, key, signals: Iterable[tuple], watermark: int) -> Iterator[Row]:
        over = _ms((key[1] + 1) * DAY + self.reach) + 1
        emitted = dt.datetime.fromtimestamp(watermark // 1000 + 1)  # not late for what comes after
        still, due = [], over
        for s in signals:
            known = None not in s[5::3]
            final = _ms(max(s[5::3])) + 1 if known else over
            if min(final, over) <= watermark:
                yield self.row(key[0], 2 * key[1] + 1 if known else 0, emitted, key[1], *s[:5], *s[7::3])
            else:
                still.append(s)
                due = min(due, final)
        self.hold(self.open, still)
        if over > watermark:
            self.handle.registerTimer(due)
            return
        if self.first.exists():
            yield self.row(key[0], 0, emitted, key[1], *self.first.get()[:2], None, None, self.first.get()[2], *[None] * len(self.minutes))
        self.first.clear()
        self.recent.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.open.exists() or self.first.exists() or self.recent.exists():
            yield from self.settle(key, self.held(self.open), timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


class LaterDays(StatefulProcessor):
    """What a day's own prices left open, answered by the next day that has a price; all else passes in lanes of its own.

    Days that are over come in one batch, so an earlier day never comes after a later one. A signal that no day answers
    goes out ``patience`` after it fired with the prices it has.
    """

    def __init__(self, minutes: tuple[int, ...], patience: int):
        self.minutes, self.patience = minutes, patience
        self.prices = ", ".join(f"px_{m}min double" for m in minutes)
        self.out = f"symbol string, trading_date date, us long, id long, signal string, price double, {self.prices}"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.row = handle, _maker(self.out)
        self.open = handle.getListState("open", f"day long, us long, id long, signal string, trading_date date, price double, {self.prices}")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if key[1]:
            for r in rows:
                yield self.row(r.symbol, r.trading_date, r.us, r.id, r.signal, r.price, *r[9:])
            return
        signals, firsts = [tuple(s) for s in self.open.get()] if self.open.exists() else [], []
        for r in rows:
            if r.signal is None:
                firsts.append((r.day, r.price))
            else:
                signals.append(tuple(r[3:]))
        yield from self.settle(key, signals, sorted(firsts), timerValues.getCurrentWatermarkInMs())

    def settle(self, key, signals: list[tuple], firsts: list[tuple], watermark: int) -> Iterator[Row]:
        still = []
        for day, us, n, signal, trading_date, price, *found in signals:
            i = bisect_left(firsts, (day + 1,))
            if i < len(firsts) or _ms(us + self.patience) <= watermark:
                after = firsts[i][1] if i < len(firsts) else None
                yield self.row(key[0], trading_date, us, n, signal, price, *(after if x is None else x for x in found))
            else:
                still.append((day, us, n, signal, trading_date, price, *found))
        if still:
            self.open.put(still)
            self.handle.registerTimer(_ms(min(s[1] for s in still) + self.patience))
        else:
            self.open.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.open.exists():
            yield from self.settle(key, [tuple(s) for s in self.open.get()], [], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def scores(seen: DataFrame, limits: Limits = LIMITS, patience_days: int = 30) -> DataFrame:
    """Signals with their later prices and grade, as :func:`minute.score` gives them, from one stream of both.

    ``seen``: (symbol, trading_date, ts, id, signal, price, px); a row without signal is an observed price. Two stateful
    operators in a chain: a symbol's days, each for itself, then what only another day answers. A signal that no price
    answers for ``patience_days`` is graded as far as it can be.
    """
    within, across = LaterPrices(limits.score_minutes), LaterDays(limits.score_minutes, patience_days * DAY)
    day = lambda us: F.floor(us / DAY)
    price = F.col("signal").isNull()
    rows = _with_micros(seen, "ts", limits)
    days = F.sequence(day(F.col("us") - F.when(price, within.reach).otherwise(0)), day(F.col("us")))
    # a row with neither moves the clock only; were it filtered, it would be so before the watermark sees it
    days = F.when(~price | F.col("px").isNotNull(), days).otherwise(F.slice(days, 1, 0))
    rows = rows.select("symbol", F.explode(days).alias("day"), "trading_date", "ts", "us", "id", "signal", "price", "px")
    answers = rows.groupBy("symbol", "day").transformWithState(within, within.out, "Append", "EventTime", None, "emitted")
    out = _run(answers, ["symbol", "lane"], across, across.out)
    return minute.graded(out.withColumn("fired_at", F.timestamp_micros("us")).drop("us"), limits)
