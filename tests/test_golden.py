"""Hand-built captures with known facts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.config import LIMITS, Limits
from tidemark.functions import parsing as p
from tidemark.functions import scalars as f
from tidemark.operators import bars, canonical, market, minute, orders, quality, registry, session, validation, wakeup
from tidemark.sources import capture, sinks

DAY = dt.date(2026, 8, 25)
QUOTE = "symbol string, trading_date date, created_at timestamp_ntz, id long, session string, last_price double, last_qty long, bid double, offer double, bid_qty long, offer_qty long, volume long, trades long"


def at(minutes, day=DAY):
    """An instant so many minutes after 09:00 local."""
    return dt.datetime(day.year, day.month, day.day, 6) + dt.timedelta(minutes=minutes)


def quotes(spark, *rows, symbol="AAA", day=DAY):
    """Rows of (minute, session, price, volume) and any of last_qty, bid, offer, bid_qty, offer_qty, trades."""
    out = []
    for i, (m, s, px, vol, *more) in enumerate(rows):
        qty, bid, offer, bq, oq, trades = (*more, *[None] * 6)[:6]
        out.append((symbol, day, at(m, day), i, s, px, qty, bid, offer, bq, oq, vol, trades))
    return spark.createDataFrame(out, QUOTE)


def facts(spark, *rows):
    return session.day_facts(quotes(spark, *rows)).first()


T = "Trading"


@pytest.mark.parametrize(
    "rows,close,source",
    [
        ([(0, T, 170.0, 1), (1, T, 172.0, 2), (2, "Trading at Last", 174.0, 3), (3, "Close-Of-Day", 176.0, 4)], 176.0, "CLOSE_OF_DAY"),
        ([(0, T, 175.0, 1), (1, "Close Auction Acceptance", 170.0, 2)], 170.0, "AUCTION"),
        ([(0, T, 175.0, 1), (1, "Suspended", 999.0, 2)], 175.0, "TRADING"),
        ([(0, T, 175.0, 1), (1, None, 210.0, 2)], 175.0, "TRADING"),
        ([(0, T, 175.0, 1), (1, "", 210.0, 2)], 210.0, "TRADING"),
        ([(0, "Suspended", 175.0, 1), (1, T, 0.0, 2)], None, None),
        ([(0, "Closing", 150.0, 1), (1, T, 160.0, 2)], 150.0, "CLOSING"),
    ],
)
def test_close(spark, rows, close, source):
    r = facts(spark, *rows)
    assert (r.close_px, r.close_source) == (close, source)


def test_range(spark):
    r = facts(spark, (0, T, 250.0, 1), (1, T, 280.0, 2), (2, "Close Auction Acceptance", 133.0, 3))
    assert (r.low_px, r.high_px, r.open_px, r.day_range) == (250.0, 280.0, 250.0, 30.0)
    assert facts(spark, (0, T, 250.0, 1), (1, "CB Auction", 217.0, 2)).low_px == 217.0
    assert facts(spark, (0, "CB Auction", 217.0, 2)).range_source == "CB_ONLY"
    assert [facts(spark, (m, T, 1.0, 2)).range_source for m in (249, 250)] == ["SHORT", "FULL"]


def test_volume_gate(spark):
    assert facts(spark, (0, T, 100.0, 50), (1, T, 101.0, 50)).moves == 0
    assert facts(spark, (0, T, 100.0, 50), (1, T, 101.0, 150)).moves == 1
    assert facts(spark, (0, T, 100.0, 50), (1, T, 101.0, 20)).steps == 0
    assert facts(spark, (0, T, 100.0, 50), (1, T, 101.0, None), (2, T, 102.0, 90)).steps == 0
    r = facts(spark, *[(i, T, 1.0, 10_876_132) for i in range(5)])
    assert r.total_volume == 10_876_132 and r.highest_minute_volume is None
    assert facts(spark, (0, T, 1.0, 1000), (1, T, 1.0, 6000), (2, T, 1.0, 6500)).highest_minute_volume == 5000


def test_tiny_moves_and_jumps(spark):
    up = [(i, T, 100.0 + i, 1000 * i, 50 if i == 1 else 500) for i in range(5)]
    down = [(5 + i, T, 103.0 - i, 5000 + 1000 * i, 500 if i == 3 else 50) for i in range(4)]
    r = facts(spark, *up, *down)
    assert (r.tiny_pct_up, r.tiny_pct_down, r.trades_under_100) == (25.0, 75.0, 4)
    r = facts(spark, (0, T, 100.0, 1), (1, T, 103.0, 2), (2, T, 105.0, 3), (3, T, 100.0, 4))
    assert (r.up_moves_2plus, r.up_moves_3plus, r.down_moves) == (2, 1, 1)


def test_ratio_is_refused_at_the_offer(spark):
    r = facts(spark, *[(i, T, 10.0, 100 * i, 500, 9.0, 10.0) for i in range(5)])
    assert r.pct_at_offer == 100.0 and r.buy_sell_ratio is None
    r = facts(spark, (0, T, 10.0, 0, 500, 9.0, 10.0), (1, T, 10.0, 100, 500, 9.0, 10.0), (2, T, 9.0, 150, 500, 9.0, 10.0), (3, T, 9.5, 160, 500, 9.0, 10.0))
    assert (r.trades_at_offer, r.trades_at_bid, r.steps, r.buy_sell_ratio, r.shares_inside_spread) == (1, 1, 3, 2.0, 10)


def test_quality_family_and_band(spark):
    one = spark.range(1)
    q = lambda m, med, c: one.select(f.data_quality(F.lit(m), F.lit(med), F.lit(c))).first()[0]
    assert [q(59, 59, True), q(200, 259, True), q(240, 259, True), q(240, 259, False), q(60, None, True)] == ["THIN", "THIN", "FULL", "THIN", "FULL"]
    r = one.select(f.family_of(F.lit(99.9)), f.family_of(F.lit(100.0)), f.tick_band_crossed(F.lit(99.0), F.lit(105.0)), f.tick_band_crossed(F.lit(None).cast("double"), F.lit(105.0))).first()
    assert tuple(r) == ("CRAWLER", None, True, None)
    edges = [one.select(f.regime_of(F.lit(x))).first()[0] for x in (34.9, 35.0, 50.0, 50.1, None)]
    assert edges == ["RISK_OFF", "NEUTRAL", "NEUTRAL", "RISK_ON", None]


def test_look_backs(spark):
    days = [dt.date(2026, 7, d) for d in (21, 22, 23, 26, 27, 28)]
    parts = [quotes(spark, (0, T, 100.0 + i, 5), (230, T, 100.0 + i, 9), day=d) for i, d in enumerate(days)]
    short = quotes(spark, (0, T, 500.0, 5), day=dt.date(2026, 7, 30))  # stopped early: no close to look back to
    after = quotes(spark, (0, T, 111.0, 5), (230, T, 111.0, 9), day=dt.date(2026, 8, 2))
    df = short.unionByName(after)
    for x in parts:
        df = df.unionByName(x)
    r = {x.trading_date: x for x in session.symbol_day(df).collect()}[dt.date(2026, 8, 2)]
    assert (r.prev_close, r.prev_session_used, r.prev_session_gap_days, r.chg_fils) == (105.0, dt.date(2026, 7, 28), 5, 6.0)
    assert r.chg_5d == pytest.approx(100 * 10 / 101, abs=1e-4) and r.days_active == 8 and r.down_days == 0
    far = {x.trading_date: x for x in session.symbol_day(df, limits=Limits(max_sessions_back=1)).collect()}[dt.date(2026, 8, 2)]
    assert far.prev_close is None


def test_market_breadth(spark):
    rows = [(f"s{i}", DAY, 1.0 if i < 24 else -1.0 if i < 117 else 0.0 if i < 128 else None, 109.0 if i == 135 else 0.5, 10, 3, "FULL") for i in range(136)]
    df = spark.createDataFrame(rows, "symbol string, trading_date date, chg_fils double, chg_1d double, total_volume long, trades long, data_quality string")
    r = market.breadth(df).select("*", market.percent(F.col("advancing"), F.col("symbols_traded")).alias("pct"), market.percent(F.col("advancing"), F.col("advancing") + F.col("declining")).alias("ratio")).first()
    assert (r.advancing, r.declining, r.unchanged, r.pct) == (24, 93, 11, 17.6471) and r.ratio == pytest.approx(20.5128)
    assert (r.median_pct_change, r.pct_change_p10, r.pct_change_p90) == (0.5, 0.5, 0.5) and r.avg_pct_change > 1.2


PAIR = "symbol string, trading_date date, ts timestamp_ntz, id long, last_price double, bid_qty long, offer_qty long, offer double, volume_delta long, bid_age_secs long"


def hits(spark, before, now):
    rows = [("AAA", DAY, at(i), i, *r) for i, r in enumerate((before, now))]
    return {r.signal for r in minute.signals(spark.createDataFrame(rows, PAIR)).collect()}


@pytest.mark.parametrize(
    "before,now,want",
    [
        ((10.0, 50000, 50000, 11.0, 5, 900), (10.0, 19999, 50000, 11.0, 5, 900), {"NO_PROTECTION"}),
        ((10.0, 50000, 50000, 11.0, 5, 900), (10.0, 20000, 50000, 11.0, 5, 900), set()),
        ((10.0, 50000, 50000, 11.0, 5, 900), (11.0, 80000, 50000, 11.0, 5, 900), {"BUYERS_8_5"}),
        ((10.0, 50000, 50000, 11.0, 5, 900), (10.0, 80000, 50000, 11.0, 5, 900), set()),
        ((10.0, 50000, 50000, 11.0, 5, 900), (10.0, 50000, 60000, 11.0, 0, 900), {"WALL_PLACED"}),
        ((10.0, 50000, 50000, 11.0, 5, 900), (10.0, 50000, 60000, 11.0, None, 900), set()),
        ((10.0, 50000, 50000, 11.0, 5, 900), (10.0, 50000, 40000, 11.0, 0, 900), {"WALL_PULLED"}),
        ((10.0, 50000, 50000, 11.0, 5, 900), (10.0, 100001, 100000, 11.0, 5, 299), {"BAIT_BID"}),
        ((10.0, 50000, 50000, 11.0, 5, 900), (10.0, 100001, 100000, 11.0, 5, 300), set()),
        ((10.0, 50000, 100001, 11.0, 5, 900), (10.0, 100001, 100001, 11.0, 0, 900), {"FROZEN"}),
        ((10.0, 50000, 50000, 11.0, 5, 900), (9.0, 50000, 50000, 11.0, 100, 900), {"BID_EMPTY"}),
        ((10.0, 50000, 50000, 11.0, 5, 900), (9.0, 50000, 50000, 11.0, 101, 900), set()),
    ],
)
def test_signal_edges(spark, before, now, want):
    assert hits(spark, before, now) == want


def test_missing_column_is_named(spark):
    with pytest.raises(ValueError, match="bid_age_secs"):
        minute.assert_shape(spark.createDataFrame([], PAIR).drop("bid_age_secs"))


def test_snapshots_feed_the_checks(spark):
    q = quotes(spark, (0, T, 10.0, 500, 1, 9.0, 11.0, 50000, 120000), (1, T, 10.0, 500, 1, 9.0, 11.0, 60000, 400000), (2, T, 10.0, 400, 1, 9.0, 12.0, 60000, 400000))
    rows = sorted(minute.snapshots(q).collect(), key=lambda r: r.ts)
    assert [r.volume_delta for r in rows] == [None, 0, None] and [r.wall_event for r in rows] == [None, "ADDED", None]
    assert [r.bid_age_secs for r in rows] == [0, 60, 120] and [r.offer_age_secs for r in rows] == [0, 60, 0]
    assert {r.signal for r in minute.signals(minute.snapshots(q)).collect()} == {"WALL_PLACED"}


def test_scores(spark):
    fired = spark.createDataFrame([("AAA", DAY, at(0), 1, s, 100.0) for s in ("WALL_PULLED", "WALL_PLACED", "FROZEN")], "symbol string, trading_date date, fired_at timestamp_ntz, id long, signal string, price double")
    px = spark.createDataFrame([("AAA", at(4), 1, 90.0), ("AAA", at(5), 2, 104.0), ("AAA", at(20), 3, 96.0)], "symbol string, ts timestamp_ntz, id long, last_price double")
    got = {r.signal: r for r in minute.score(fired, px).collect()}
    assert {k: r.was_right for k, r in got.items()} == {"WALL_PULLED": True, "WALL_PLACED": False, "FROZEN": None}
    assert (got["FROZEN"].px_5min, got["FROZEN"].px_15min, got["FROZEN"].px_60min) == (104.0, 96.0, None)


def test_bars(spark):
    rows = [(i, T, 100.0 + i, 1000 * (i + 1)) for i in range(20)]
    rows[5] = (5, T, 95.0, 6000)
    rows[10] = (10, T, 130.0, 11000)
    b = bars.daily_bars(quotes(spark, *rows)).first()
    assert (b.open_price, b.high_price, b.low_price, b.close_price, b.volume, b.change_value, b.change_pct) == (100.0, 130.0, 95.0, 119.0, 20000, 19.0, 19.0)
    assert bars.daily_bars(quotes(spark, *rows[:3])).count() == 0
    m = sorted(bars.minute_bars(quotes(spark, (0, T, 1.0, 500), (1, T, 1.0, 400), (2, T, 1.0, None), (3, T, 1.0, 900))).collect(), key=lambda r: r.minute)
    assert [r.vol for r in m] == [500, 0, 0, 400]


def slow_swings(closes, least):
    out, i, n = [], 1, len(closes)
    while i < n:
        if closes[i] == closes[i - 1]:
            i += 1
            continue
        way = 1 if closes[i] > closes[i - 1] else -1
        j = i
        while j < n and (closes[j] - closes[j - 1]) * way >= 0:
            j += 1
        size = closes[j - 1] - closes[i - 1]
        if abs(size) >= least:
            out.append(("bull" if size > 0 else "bear", abs(size), i - 1, j - 1))
        i = j
    return out


def test_swings_by_walking(spark):
    closes = [100, 100, 101, 103, 103, 102, 99, 99, 100, 104, 104, 104, 101, 102, 98, 98]
    b = bars.minute_bars(quotes(spark, *[(i, T, float(x), i) for i, x in enumerate(closes)]))
    got = sorted((r.direction, r["size"], r.start_idx, r.end_idx) for r in bars.swings(b).collect())
    assert got == sorted(slow_swings(closes, LIMITS.min_swing))
    r = bars.swing_stats(bars.swings(b)).first()
    want = slow_swings(closes, 2)
    assert r.total_swings == len(want) and r.bull_swings == sum(x[0] == "bull" for x in want) and r.auto_target_fils == max(2.0, int(0.75 * sum(x[1] for x in want) / len(want) * 100 + 0.5) / 100)


def test_slots():
    even = [("a", 9.0, 50), ("b", 8.0, 50), ("c", 7.0, 50), ("d", 6.0, 50), ("e", 5.0, 50), ("f", 4.0, 50)]
    got = wakeup.allocate([even], LIMITS.wakeup_slots)
    assert [x[1] for x in got] == list("abcde")
    got = wakeup.allocate([even[:5], [("g", 5.0, 30), ("h", 5.5, 30), ("a", 99.0, 30)]], LIMITS.wakeup_slots)
    assert got[5:] == [(1, "h", 30, 5.5, 8, "e")]


def test_pace(spark):
    days = [dt.date(2026, 8, d) for d in (2, 3, 4, 5)]
    df = None
    for d, n in zip(days, (10, 20, 30, 240)):
        x = quotes(spark, (60, T, 1.0, 1, 1, 1.0, 1.0, 1, 1, n), (200, T, 1.0, 1, 1, 1.0, 1.0, 1, 1, n), day=d)
        df = x if df is None else df.unionByName(x)
    r = {x.trading_date: x for x in wakeup.pace(df, 11).collect()}
    assert (r[days[3]].pace, r[days[3]].sessions) == (12.0, 3) and r[days[0]].pace is None
    assert wakeup.pace(df, 8).where("pace is not null").count() == 0


def test_orders(spark):
    schema = "order_id long, seq int, symbol string, side string, order_status string, price long, trading_date date, order_value long, net_value long, filled_quantity long, quantity long"
    seen = [(1, i, "X" if i == 0 else None, "BUY", f"st{i}", 5, DAY, 100, 110 if i < 2 else None, q, 6100) for i, q in enumerate((0, 5350, 6100, 6100))]
    seen += [(2, 0, "X", "BUY", "st", 5, DAY, 100, 110, 3500, 3500), (3, 0, "X", "SELL", "st", 5, DAY, 100, 110, 3500, 3500), (4, 0, "X", "BUY", "cancelled", 5, DAY, None, None, 0, 1000)]
    o = orders.fold(spark.createDataFrame(seen, schema))
    r = {x.order_id: x for x in o.collect()}
    assert (r[1].executions_observed, r[1].sighting_count, r[1].symbol, r[1].net_value, r[1].order_status) == (3, 4, "X", 110, "st3")
    assert orders.positions(o).first().net_qty == 6100


def test_registry(spark):
    i = spark.createDataFrame([("OLD", "624", "Main Market", "CAPTURED", "NEW"), ("NEW", "624", "Main Market", None, None), ("GONE", "1", "Main Market", "DELISTED", None), ("AUC", "2", "Main Market", "CAPTURED", None), ("NONE", "3", "Main Market", "CAPTURED", None)], "symbol string, code string, market string, broker_status string, superseded_by string")
    q = quotes(spark, (0, T, 1.0, 1), symbol="NEW").withColumn("market", F.lit("Main Market")).unionByName(quotes(spark, (0, T, 1.0, 1), symbol="AUC").withColumn("market", F.lit("Auction Market")))
    w = spark.createDataFrame([("NEW", DAY)], "symbol string, trading_date date")
    once = registry.refresh(i, q, w)
    r = {x.symbol: x for x in once.collect()}
    assert {k: (x.broker_status, x.is_primary, x.tv_status, x.is_tradeable) for k, x in r.items()} == {
        "OLD": ("ABSENT", False, "ABSENT", False), "NEW": ("CAPTURED", True, "CAPTURED", True), "GONE": ("DELISTED", True, "ABSENT", False), "AUC": ("CAPTURED", True, "ABSENT", False), "NONE": ("ABSENT", False, "ABSENT", False),
    }
    assert r["AUC"].market_changed_on == DAY and r["NEW"].market_changed_on is None
    again = registry.refresh(once.drop("quote_rows", "last_quote", "status_changed"), q, w)
    assert not any(x.status_changed for x in again.collect()) and registry.contradictions(again).count() == 0


def test_numbers(spark):
    cells = ["1,234.50", "(45.2)", "1.24M", "12.5%", "−2.5", "—", "1,721KWF", "845.96 MKWF", "‪1.95%‬", "note 7 see", "", None, "n/a", "0", "23.34 K", "1.2.3", "-"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string").select("i", p.to_number(F.col("c")).alias("n"), p.to_integer(F.col("c")).alias("k"))
    got = {r.i: r.n for r in df.collect()}
    want = [1234.5, -45.2, 1240000.0, 12.5, -2.5, None, 1721.0, 845960000.0, 1.95, 7.0, None, None, None, 0.0, 23340.0, None, None]
    assert [got[i] if got[i] is None else pytest.approx(want[i]) == got[i] for i in range(len(cells))] == [None if w is None else True for w in want]
    assert {r.i: r.k for r in df.collect()}[4] == -2


def test_texts(spark):
    one = spark.range(1)
    get = lambda c: one.select(c.alias("x")).first().x
    assert get(p.to_symbol(F.lit("KSE:abar"))) == get(p.to_symbol(F.lit("ABAR  Al Arabi"))) == "ABAR" and get(p.to_symbol(F.lit("-"))) is None
    assert [get(p.to_side(F.lit(x))) for x in ("buy", "S", "hold", "—")] == ["BUY", "SELL", "UNKNOWN", None]
    assert [get(p.to_time(F.lit(x))) for x in ("1:2:3", "25-08-2026 13:14", "24:00", "x")] == ["01:02:03", "13:14:00", None, None]
    assert get(p.to_date_dmy(F.lit("25-08-2026"))) == DAY and get(p.to_date_dmy(F.lit("2026-08-25"))) is None
    day = F.lit("2026-08-25").cast("date")
    assert {get(p.to_instant(F.lit(x), day)) for x in ("2026-08-25 09:16:02", "25-08-2026 09:16:02", "09:16:02", "2026-08-25T06:16:02Z", "2026-08-25T06:16:02+00:00")} == {dt.datetime(2026, 8, 25, 6, 16, 2)}
    assert get(p.row_date(F.lit("1 Feb '26"), F.lit(None).cast("string"))) == dt.date(2026, 2, 1) and get(p.row_date(F.lit("x"), F.lit("1767225600"))) == dt.date(2026, 1, 1)
    assert get(p.synthetic_id(F.lit("a"), F.lit(None).cast("string"))) is None and get(p.synthetic_id(F.lit("a"), F.lit(1))).startswith("SYN-")
    assert get(p.market_name(F.lit("b"))) == "Auction Market" and get(p.market_name(F.lit("Main Market"))) == "Main Market"
    assert get(p.pick(F.lit('{"a": "", "b": 5}'), F.lit("c"), "a", "b")) == "5"
    sym, code = p.split_symbol(F.lit("ABAR - 101"))
    assert (get(sym), get(code)) == ("ABAR", "101")
    head = F.array(F.lit("Symbol"), F.lit("LAST"))
    assert get(p.looks_like_header(head, ["symbol", "last"], ("symbol", "last"))) and not get(p.looks_like_header(F.array(F.lit("ABAR"), F.lit("5")), ["symbol", "last"], ("symbol", "last")))
    assert p.resolve_columns(["Sym", "Last Price", "Last"], {"last": ("last",), "bid": ("bid",)}) == {"last": 2, "bid": -1}


def test_window_edges(spark):
    cases = {"2026-08-25T05:59:00": False, "2026-08-25T06:00:00": True, "2026-08-25T09:59:59": True, "2026-08-25T10:00:00": False, "2026-08-28T07:00:00": False, "2026-08-29T07:00:00": False, "2026-08-30T07:00:00": True}
    df = spark.createDataFrame([(k, dt.datetime.fromisoformat(k)) for k in cases], "k string, ts timestamp_ntz").select("k", f.is_within_window(F.col("ts")).alias("w"))
    assert {r.k: r.w for r in df.collect()} == cases


def test_books_and_orders_are_validated(spark):
    schema = "symbol string, created_at timestamp_ntz, level int, bid double, offer double, bid_qty long, offer_qty long"
    rows = [("A", at(0), 1, 0.0, 0.0, 0, 0), ("A", at(0), 2, 5.0, None, 1, None), ("A", at(0), 21, 5.0, 6.0, 1, 1), ("", at(0), 1, 5.0, 6.0, 1, 1), ("A", at(0), 3, None, None, 1, 1), ("A", at(0), 4, -1.0, 6.0, 1, 1)]
    good, bad = validation.split(validation.depth(spark.createDataFrame(rows, schema)))
    assert [r.level for r in good.collect()] == [2] and bad.count() == 5
    o = spark.createDataFrame([("1", at(0), 5.0, "HOLD", 10, 12, 3)], "order_id string, created_at timestamp_ntz, price double, side string, quantity long, filled_quantity long, remaining_qty long")
    r = validation.orders(o).first()
    assert (r.side, r.filled_quantity, r.remaining_qty, r.reject_reason) == ("UNKNOWN", None, None, None)


def test_daily_table(spark):
    rows = [("X", 0, None, "1 Feb '26", ["10", "12", "9", "11", "+1", "1 234"]), ("X", 1, None, "1 Feb '26", ["1", "1", "1", "1", "0", "5"]), ("X", 2, None, "2 Feb '26", ["10", "8", "9", "11", "0", "5"]), ("X", 3, None, "3 Feb '26", ["10", "—", "9", "11", "0", "5"]), ("X", 4, "1770163200", None, ["1,000", "1,200", "900", "1,100", "−2", "7"])]
    df = spark.createDataFrame(rows, "symbol string, pos int, unix string, date_text string, `values` array<string>")
    got = {str(r.trade_date): (r.open_price, r.close_price, r.change_value, r.volume) for r in capture.daily_table(df, ["Date", "Open", "High", "Low", "Close", "Change", "Volume"]).collect()}
    assert got == {"2026-02-01": (10.0, 11.0, 1.0, 1234), "2026-02-04": (1000.0, 1100.0, -2.0, 7)}
    with pytest.raises(ValueError, match="open"):
        capture.daily_table(df, ["Date", "High"])


def test_payloads(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"batchId":"b1","capturedAt":"2026-08-25T06:30:00","records":[{"market":"P","symbol":"KSE:abar","last":"170.5","chg":"-2","volume":"1,000","bid":"(170)","bidPrice":"169","bidQty":"5","orderId":"9","symbolRaw":"abar","side":"buy","price":"5","quantity":"1,000","filled":"400"}]}\n'
        '{"batchId":"b2","capturedAt":"2026-08-25T06:00:00","symbol":"xyz","levels":[{"bidPrice":"10","offerPrice":"11"},{"bid":"9","ask":"12","level":"7"}]}\n'
    )
    b = capture.batches(spark, str(tmp_path))
    q = capture.quotes(b).where("batch_id = 'b1'").first()
    assert (q.symbol, q.market, q.last_price, q.chg, q.volume, q.bid) == ("ABAR", "Premier Market", 170.5, -2.0, 1000.0, 170.0)
    d = sorted((r.symbol, r.level, r.bid, r.offer) for r in capture.depth(b).where("batch_id = 'b2'").collect())
    assert d == [("XYZ", 1, 10.0, 11.0), ("XYZ", 7, 9.0, 12.0)]
    o = capture.orders(b).where("batch_id = 'b1'").first()
    assert (o.order_id, o.side, o.quantity, o.remaining_qty) == ("9", "BUY", 1000, 600)
    now = F.lit("2026-08-25 06:31:00").cast("timestamp_ntz")
    assert [r.batchId for r in capture.fresh(b, now).collect()] == ["b1"]


def test_master_ladder_and_grid(spark):
    t = spark.createDataFrame([("SYMBOL|SHRT_DSC|COMPANY_CODE|MARKET_ID", ["101|ABAR|101A|P", "102||| M", "|||"])], "header string, rows array<string>")
    got = {r.alias: (r.symbol, r.code, r.market) for r in capture.symbol_master(t).collect()}
    assert got == {"101": ("ABAR", "101A", "Premier Market"), "ABAR": ("ABAR", "101A", "Premier Market"), "101A": ("ABAR", "101A", "Premier Market"), "102": ("102", "102", "Main Market")}
    cell = "array<struct<price:string,qty:string>>"
    lad = capture.ladder(spark.createDataFrame([("A", at(0), [("9", "1"), ("10", "2")], [("12", "3"), ("11", "4"), ("13", "5")])], f"symbol string, created_at timestamp_ntz, bids {cell}, offers {cell}"))
    assert [(r.level, r.bid, r.bid_qty, r.offer, r.offer_qty) for r in lad.orderBy("level").collect()] == [(1, 10.0, 2.0, 11.0, 4.0), (2, 9.0, 1.0, 12.0, 3.0), (3, None, None, 13.0, 5.0)]
    cells = spark.createDataFrame([(1, 10, "id", "77"), (1, 10, "px", "5"), (1, 20, "px", "6")], "page int, top int, cell string, text string")
    assert [(r.id, r.px) for r in capture.grid(cells, ("id", "px")).collect()] == [("77", "5")]


def test_duplicates_keep_the_fuller_row(spark):
    rows = [("A", at(0), 1, 5.0, 10), ("A", at(0), 2, None, 99), ("B", at(0), 3, 5.0, 10), ("B", at(0), 4, 5.0, 10), ("C", at(0), 5, 5.0, 10), ("C", at(0), 6, 5.0, 11)]
    df = spark.createDataFrame(rows, "symbol string, created_at timestamp_ntz, id long, last_price double, volume long")
    got = {r.symbol: (r.id, r.kind) for r in canonical.richest(df, ["symbol", "created_at"], ("last_price", "volume")).collect()}
    assert got == {"A": (1, "conflicting"), "B": (4, "identical"), "C": (6, "conflicting")}


def test_tables_on_disk(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("A", DAY, 1, 5.0), ("A", DAY, 2, 6.0), ("B", DAY, 3, 7.0)], "symbol string, trading_date date, id long, px double")
    for _ in range(2):  # a retry adds nothing
        sinks.append_new(df, path, ["symbol", "trading_date"], "id")
    assert sorted((r.symbol, r.px) for r in spark.read.parquet(path).collect()) == [("A", 5.0), ("B", 7.0)]
    later = spark.createDataFrame([("A", dt.date(2026, 8, 26), 4, 1.0)], df.schema)
    sinks.replace_days(later, path)
    sinks.replace_days(later.withColumn("px", F.lit(2.0)), path)
    assert sorted((r.symbol, r.px) for r in spark.read.parquet(path).collect()) == [("A", 2.0), ("A", 5.0), ("B", 7.0)]
    assert quality.feed_of(["Premier Market", None]) == "broker" and quality.feed_of(["NYSE"]) == "watchlist"
    with pytest.raises(ValueError):
        quality.feed_of(["Premier Market", "NYSE"])
    assert quality.unique_order(df, ["id"]) and not quality.unique_order(df, ["symbol"])
