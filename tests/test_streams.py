"""Streams give what the batch form gives."""

import datetime as dt
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidemark.config import Limits
from tidemark.operators import bars, minute, wakeup
from tidemark.streaming import capture as streams
from tidemark.streaming import stateful

from .test_golden import DAY, QUOTE, T, at, quotes


def feed(df, folder, parts=3):
    """The rows as files that a stream reads one after the other, in order of id."""
    path = str(folder / "in")
    n = df.count()
    for k in range(parts):
        part = df.where((F.col("id") >= n * k // parts) & (F.col("id") < n * (k + 1) // parts))
        part.coalesce(1).write.mode("append").parquet(path)
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.fixture(scope="module")
def rows(spark):
    return quotes(spark, *[(i / 3, T, 100.0 + i * 7 % 5, 10 * i - (300 if i == 30 else 0), 1, 99.0 + i // 6 % 2, 101.0, 50000 + i, 60000 + i) for i in range(60)]).withColumn("created_at", F.col("created_at").cast("timestamp"))


def test_bars(spark, rows, tmp_path):
    got = streams.drain(streams.minute_bars(feed(rows, tmp_path)), str(tmp_path / "s"), ["symbol", "trading_date", "minute"], "update")
    want = bars.minute_bars(rows).select("minute", "open", "high", "low", "close")
    assert sorted(map(tuple, got.select("minute", "open", "high", "low", "close").collect())) == sorted(map(tuple, want.collect()))


def test_snapshots_carry_state(spark, rows, tmp_path):
    """Three runs of the stream, each from what the last one left, give what one batch gives."""
    got = streams.replay(rows, "created_at", stateful.snapshots, str(tmp_path / "s"), runs=3)
    want = minute.snapshots(rows)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    again = streams.drain(stateful.snapshots(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "s/landed/run=*"))), str(tmp_path / "s"))
    assert again.count() == want.count()  # nothing new landed


def test_an_observation_that_is_not_newer_is_skipped(spark, rows, tmp_path):
    twice = rows.unionByName(rows.withColumns({"id": F.col("id") + 1000, "bid": F.lit(1.0)}))
    got = streams.replay(twice, "created_at", stateful.snapshots, str(tmp_path / "s"), runs=2)
    assert sorted(r.id for r in got.collect()) == list(range(60))


def test_each_field_has_its_own_age(spark, tmp_path):
    df = spark.createDataFrame([("a ", at(0), 5.0, None), ("a ", at(1), None, 7.0), ("a ", at(9), None, 8.0), ("b", at(9), 1.0, None), ("b", at(90), None, 2.0), ("c", at(90), 3.0, None)], "symbol string, ts timestamp, px double, qty double")
    master = spark.createDataFrame([("A", "Alpha"), ("B", "Beta")], "alias string, name string")
    make = lambda f: stateful.listed(stateful.board(f, ("px", "qty"), expiry_secs=3600), master, priced="px")
    got = {r.alias: r for r in streams.replay(df, "ts", make, str(tmp_path / "s"), ["alias"], "update").collect()}
    assert set(got) == {"A", "B"}
    assert (got["A"].px, got["A"].px_age_secs, got["A"].qty, got["A"].qty_age_secs, got["A"].stale) == (5.0, 540, 8.0, 0, True)
    assert (got["B"].px, got["B"].px_age_secs, got["B"].qty) == (None, None, 2.0)  # its price was last sent 81 minutes before


def test_volumes_of_minutes(spark, rows, tmp_path):
    end = spark.createDataFrame([(None, None, dt.datetime(2100, 1, 1), None, None, 0.0, None)], "symbol string, trading_date date, created_at timestamp, id long, session string, last_price double, volume long")
    closing = end.select(*(F.col(c) if c in end.columns else F.lit(None).cast(t).alias(c) for c, t in rows.dtypes))
    got = streams.replay(rows, "created_at", stateful.minute_volumes, str(tmp_path / "s"), closing=closing).where("symbol is not null")
    want = bars.minute_bars(rows).select("minute", "open", "high", "low", "close", "vol")
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_slots_wait_for_a_whole_scan(spark, tmp_path):
    """Rows of a scan come in any order, over several runs; a seeded slot is never won."""
    limits = Limits(pace_min=1.0, trades_min=0, wakeup_slots=(4, 5))
    scan = lambda minute, *pairs: [(DAY, at(minute), minute, s, 10, p) for s, p in pairs]
    paces = scan(0, ("A", 2.0), ("B", 3.0), ("C", 2.5)) + scan(30, ("A", 9.0), ("B", 0.5), ("D", 4.0)) + scan(60, ("C", 5.0))
    cols = "trading_date date, at timestamp, scan int, symbol string, trades long, pace double"
    df = spark.createDataFrame(paces, cols).withColumn("come", F.col("at") + F.make_dt_interval(mins=F.crc32(F.col("symbol").cast("binary")) % 10))
    seeds = spark.createDataFrame([(DAY, 1, "A")], "trading_date date, slot int, symbol string")
    closing = spark.createDataFrame([(None, dt.datetime(2100, 1, 1), None, None, None, None, dt.datetime(2100, 1, 1))], df.schema)
    got = streams.replay(df, "come", lambda p: stateful.slots(p.drop("come"), seeds, limits), str(tmp_path / "s"), closing=closing).collect()
    # first B and C win; then A takes C's slot and D takes B's, as each is faster; at last C takes D's
    assert sorted((r.scan, r.symbol, r.slot, r.replaced) for r in got if r.event == "PROMOTED") == [(0, "B", 4, None), (0, "C", 5, None), (30, "A", 5, "C"), (30, "D", 4, "B"), (60, "C", 4, "D")]
    assert sorted((r.slot, r.slot_type, r.symbol) for r in got if r.event == "RELEASED") == [(1, "PREDAY", "A"), (4, "WAKEUP", "C"), (5, "WAKEUP", "A")]


def test_later_prices_whatever_the_order_of_arrival(spark, tmp_path):
    rng = random.Random(4)
    prices = [("A" if k % 2 else "B", DAY, at(k / 2) if k % 5 else at(k / 2 + 7), k, None, None, None if k % 11 == 0 else float(k)) for k in range(300)]
    fired = [(s, DAY, at(k), 1000 + k, "WALL_PULLED", 5.0, None) for k in range(0, 150, 4) for s in "AB"]
    seen = spark.createDataFrame(prices + fired, "symbol string, trading_date date, ts timestamp, id long, signal string, price double, px double")
    seen = seen.withColumn("come", F.col("ts") + F.make_dt_interval(mins=F.pmod(F.xxhash64("id", F.lit(rng.randrange(99))), F.lit(9)).cast("int")))
    closing = spark.createDataFrame([(None, None, dt.datetime(2100, 1, 1), None, None, None, None, dt.datetime(2100, 1, 1))], seen.schema)
    got = streams.replay(seen, "come", lambda x: stateful.scores(x.drop("come")), str(tmp_path / "s"), runs=4, closing=closing)
    signals = seen.where("signal is not null").select("symbol", "trading_date", F.col("ts").alias("fired_at"), "id", "signal", "price")
    want = minute.score(signals, seen.where("signal is null").select("symbol", "ts", "id", F.col("px").alias("last_price")))
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_later_prices_of_other_days(spark, tmp_path):
    """Prices past midnight, of the next day that has any, and none at all."""
    prices = [("A", DAY, at(m), k, None, None, p) for k, (m, p) in enumerate([(0, 1.0), (16 * 60 + 31, 2.0), (17 * 60 + 4, 3.0), (17 * 60 + 40, 4.0), (4 * 1440, 5.0), (4 * 1440 + 700, 6.0)])]
    fired = [("A", DAY, at(m), 100 + m, "WALL_PULLED", 1.0, None) for m in (-5, 0, 16 * 60 + 30, 17 * 60 - 1, 17 * 60, 18 * 60, 2 * 1440, 4 * 1440 + 690, 5 * 1440)]
    seen = spark.createDataFrame(prices + fired, "symbol string, trading_date date, ts timestamp, id long, signal string, price double, px double")
    closing = spark.createDataFrame([(None, None, dt.datetime(2100, 1, 1), None, None, None, None)], seen.schema)
    got = streams.replay(seen, "ts", stateful.scores, str(tmp_path / "s"), closing=closing)
    signals = seen.where("signal is not null").select("symbol", "trading_date", F.col("ts").alias("fired_at"), "id", "signal", "price")
    want = minute.score(signals, seen.where("signal is null").select("symbol", "ts", "id", F.col("px").alias("last_price")))
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_a_day_of_signals_has_few_timers_and_state_calls():
    """However many signals a key has, it is one timer, and one call to each state."""
    calls = []

    class State:
        value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            calls.append("update")
            self.value = value

        def clear(self):
            self.value = None

    class Handle:
        getValueState = getListState = lambda self, *_: State()

        def registerTimer(self, at):
            calls.append("timer")

    class Now:
        def getCurrentWatermarkInMs(self):
            return 0

    made = stateful.LaterPrices((5, 15, 60))
    made.init(Handle())
    row = Row("us", "id", "signal", "trading_date", "price", "px")
    rows = [row(k * 1_000_000, k, "X" if k % 2 else None, DAY, 1.0, None if k % 2 else 2.0) for k in range(2000)]
    assert list(made.handleInputRows(("A", 0), iter(rows), Now())) == []
    assert calls.count("timer") == 1 and calls.count("update") == 2


def test_alerts_are_throttled(spark, tmp_path):
    t = [0, 30, 59, 60, 61, 125, 130]
    df = spark.createDataFrame([("A", "X", DAY, at(0) + dt.timedelta(seconds=s), i) for i, s in enumerate(t)], "symbol string, signal string, trading_date date, fired_at timestamp, id long")
    got = streams.drain(streams.alerts(feed(df, tmp_path, 2)), str(tmp_path / "s"))
    assert sorted(r.id for r in got.collect()) == sorted(r.id for r in wakeup.throttled(df).collect()) == [0, 3, 5]


def test_frames_merge_by_field(spark, tmp_path):
    df = spark.createDataFrame([("A", at(0), 0, 5.0, None), ("A", at(1), 1, None, 7.0), ("A", at(9), 2, None, 8.0)], "symbol string, ts timestamp, id long, px double, qty double")
    got = streams.drain(streams.merged_frames(feed(df, tmp_path), ("px", "qty")), str(tmp_path / "s"), ["symbol"], "update").first()
    assert (got.px, got.qty, got.stale) == (5.0, 8.0, True)


def test_frames_come_in_any_order(spark, tmp_path):
    """Newest first over several Arrow batches, then older ones within the lateness: the newest of each field stays."""
    secs = F.lit(1_700_000_000) + F.lit(60_000) - F.col("id")
    df = spark.range(30_000).select(F.lit("A").alias("symbol"), F.timestamp_seconds(secs).alias("ts"), "id", F.when(F.col("id") % 3 == 1, F.col("id").cast("double")).alias("px"), F.when(F.col("id") % 3 == 2, F.col("id").cast("double")).alias("qty"))
    (tmp_path / "a").mkdir()
    got = streams.drain(streams.merged_frames(feed(df.coalesce(1), tmp_path / "a", 1), ("px", "qty")), str(tmp_path / "s"), ["symbol"], "update").first()
    assert (got.ts.timestamp(), got.px, got.qty, got.stale) == (1_700_060_000, 1.0, 2.0, False)
    late = spark.createDataFrame([("A", at(20), 0, 5.0, None), ("A", at(10), 1, 6.0, 7.0)], "symbol string, ts timestamp, id long, px double, qty double")
    got = streams.drain(streams.merged_frames(feed(late, tmp_path, 2), ("px", "qty")), str(tmp_path / "t"), ["symbol"], "update").first()
    assert (got.ts, got.px, got.qty, got.stale) == (at(20), 5.0, 7.0, False)


def test_few_frames_of_a_busy_symbol_are_left(spark):
    """What merges to the same board: of each symbol the newest frame, and the newest with each field."""
    n = F.col("id")
    df = spark.range(0, 5000, 1, 1).select(F.concat(F.lit("s"), (n % 3).cast("string")).alias("symbol"), F.timestamp_seconds(n * 7919 % 5003).alias("ts"), *(F.when(n % 5 == k, n.cast("double")).alias(f) for k, f in enumerate(("px", "qty"))))
    left = streams.thinned(df, "symbol", "ts", ("px", "qty"))
    assert left.count() <= 9
    best = lambda x: {r.symbol: tuple(r)[1:] for r in x.groupBy("symbol").agg(F.max("ts"), *(F.max_by(f, F.when(F.col(f).isNotNull(), F.col("ts"))) for f in ("px", "qty"))).collect()}
    assert best(left) == best(df)


def test_retries_and_storing(spark, tmp_path):
    b = spark.createDataFrame([(f"b{i % 2}", at(i), i) for i in range(4)], "batchId string, capturedAt timestamp, id long")
    got = streams.drain(streams.without_retries(feed(b, tmp_path, 2)), str(tmp_path / "s"))
    assert sorted(r.batchId for r in got.collect()) == ["b0", "b1"]
    rows = spark.createDataFrame([("A", DAY, at(0), 0, T, 5.0, *[None] * 5, 5, None), ("A", DAY, at(0), 1, T, 5.0, *[None] * 5, 5, None), ("B", DAY, at(0), 2, T, -5.0, *[None] * 5, 5, None)], QUOTE).withColumn("market", F.lit("Main Market"))
    (tmp_path / "q").mkdir()
    w = streams.store(feed(rows, tmp_path / "q"), str(tmp_path / "t"), str(tmp_path / "r"), ["symbol", "created_at"], "id")
    w.option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start().awaitTermination()
    assert [r.id for r in spark.read.parquet(str(tmp_path / "t")).collect()] == [0]
    assert [r.reject_reason for r in spark.read.parquet(str(tmp_path / "r")).collect()] == ["impossible last_price: -5.0"]
