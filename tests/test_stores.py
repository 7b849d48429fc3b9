"""Merges, ledgers and audits of stored tables, functions in SQL, and the keyed source."""

import datetime as dt
import os
import sqlite3

import pytest
from pyspark.sql import functions as F

from tidemark.functions import registered
from tidemark.operators import quality
from tidemark.sources import capture, keyed, sinks
from tidemark.streaming import capture as streams


def files(path):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


RULES = {"status": "last", "net": "known", "filled": "last", "fills": "rises filled", "seen": "count", "first": "first", "high": "greatest", "low": "least"}


def test_merge_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "orders")
    cols = "id long, at int, status string, net double, filled long, first int, high double, low double"
    put = lambda *rows: sinks.merge(spark.createDataFrame(rows, cols), path, ["id"], RULES, F.col("at"), "bucket", F.col("id") % 4)
    put((1, 1, "new", 5.0, 0, 1, 1.0, 1.0), (1, 2, "twice in a batch", None, 9, 2, 9.0, 9.0), (2, 1, "new", None, None, 1, None, 2.0), (4, 1, "new", 1.0, 3, 1, 1.0, 1.0))
    before = files(path)
    put((1, 3, "part", None, 2, 3, 0.5, 0.5), (5, 3, "new", 7.0, 1, 3, 1.0, None))
    after = files(path)
    assert {f for f in before if f in after} == {f for f in before if "bucket=1" not in f} and all(before[f] == after[f] for f in before if f in after)
    put((1, 4, None, 6.0, 3, 4, 2.0, 3.0), (2, 4, "part", 3.0, 1, 4, 4.0, None))
    put((1, 5, "done", None, 3, 5, None, None))
    got = {r.id: (r.status, r.net, r.filled, r.fills, r.seen, r["first"], r.high, r.low) for r in spark.read.parquet(path).collect()}
    assert got == {1: ("done", 6.0, 3, 3, 4, 1, 2.0, 0.5), 2: ("part", 3.0, 1, 1, 2, 1, 4.0, 2.0), 4: ("new", 1.0, 3, 1, 1, 1, 1.0, 1.0), 5: ("new", 7.0, 1, 1, 1, 3, 1.0, None)}


def test_a_batch_seen_before_gets_its_stored_counts(spark, tmp_path):
    path, ledger = str(tmp_path / "rows"), str(tmp_path / "ledger")
    cols = "batch_id string, id long, key string, reason string"
    first = spark.createDataFrame([("b1", 1, "x", None), ("b1", 2, "x", None), ("b1", 3, "y", "bad"), ("b2", 4, "z", None)], cols)
    more = spark.createDataFrame([("b1", 1, "x", None), ("b1", 9, "new", None), ("b3", 5, "z", None), ("b3", 6, "w", None), ("b4", 7, "v", "bad")], cols)
    send = lambda rows, name: {r.batch_id: (r.offered, r.inserted, r.rejected, r.duplicate) for r in sinks.submit(rows, path, ledger, name, ["key"], "id", "reason").collect()}
    assert send(first, "q-0") == {"b1": (3, 1, 1, False), "b2": (1, 1, 0, False)}
    answer = {"b1": (3, 1, 1, True), "b3": (2, 1, 0, False), "b4": (1, 0, 1, False)}
    assert send(more, "q-1") == answer
    stored = sorted((r.key, r.id) for r in spark.read.parquet(path).collect())
    assert stored == [("w", 6), ("x", 1), ("z", 4)]
    assert send(more, "q-1") == answer and sorted((r.key, r.id) for r in spark.read.parquet(path).collect()) == stored
    # a failure between rows and ledger: the second try counts what the first had already stored
    os.rename(f"{ledger}/submission=q-1", str(tmp_path / "lost"))
    assert send(more, "q-1") == answer
    assert send(more, "q-2") == {b: (*c[:3], True) for b, c in answer.items()}
    assert sorted((r.key, r.id) for r in spark.read.parquet(path).collect()) == stored


def test_pushed_batches_on_a_stream(spark, tmp_path):
    at = str(tmp_path)
    cols = "batch_id string, id long, key string, reason string"
    for k, rows in enumerate(([("b1", 1, "x", None), ("b1", 2, "y", "bad")], [("b1", 1, "x", None), ("b2", 3, "z", None)])):
        spark.createDataFrame(rows, cols).coalesce(1).write.parquet(f"{at}/in/run={k}")
        w = streams.ingest(spark.readStream.schema(cols).parquet(f"{at}/in/run=*"), f"{at}/rows", f"{at}/ledger", "q", ["key"], "id", "reason")
        w.option("checkpointLocation", f"{at}/log").trigger(availableNow=True).start().awaitTermination()
    assert sorted((r.batch_id, r.id, r.submission) for r in spark.read.parquet(f"{at}/rows").collect()) == [("b1", 1, "q-0"), ("b2", 3, "q-1")]
    assert sorted((r.batch_id, r.offered, r.inserted, r.rejected, r.submission) for r in spark.read.parquet(f"{at}/ledger").collect()) == [("b1", 2, 1, 1, "q-0"), ("b2", 1, 1, 0, "q-1")]


def test_a_write_keeps_its_own_audit(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "bad"), (3, None)], "id long, reason string")
    log = str(tmp_path / "log")
    sinks.audited_write(df, str(tmp_path / "a"), log, "some", "reason")
    sinks.audited_write(df.where("id = 2"), str(tmp_path / "b"), log, "none", "reason")
    sinks.audited_write(df.select("id"), str(tmp_path / "c"), log, "all")
    got = {r.run: (r.extracted, r.rejected, r.stored, r.status) for r in spark.read.parquet(log).collect()}
    assert got == {"some": (3, 1, 2, "PARTIAL"), "none": (1, 1, 0, "FAILED"), "all": (3, 0, 3, "SUCCESS")}
    assert spark.read.parquet(str(tmp_path / "a")).columns == ["id"] and spark.read.parquet(str(tmp_path / "a")).count() == 2


def test_functions_in_sql(spark):
    days = [dt.date(2026, 1, d) for d in (1, 4, 5, 6, 11)]
    registered.register(spark, spark.createDataFrame([("A", d) for d in days] + [("B", days[0]), ("B", days[3])], "symbol string, trading_date date"))
    ask = lambda q: [tuple(r) for r in spark.sql(q).collect()]
    d = "date'2026-01-06'"
    assert ask(f"select prev_session({d}), prev_session({d}, 2), prev_session({d}, 99), prev_session(date'2026-01-01'), prev_session(date'2026-02-01', 0)") == [(days[2], days[1], days[0], None, days[4])]
    assert ask(f"select * from prev_session({d}, 2)") == [(1, days[2]), (2, days[1])]
    assert ask(f"select prev_session_of('B', {d}), prev_session_of('C', {d}), is_trading_day(date'2026-01-09'), is_trading_day({d})") == [(days[0], None, False, True)]
    assert sorted(ask(f"select * from symbols_of({d})")) == [("A", 1), ("B", 1)]
    assert ask("select minute_bucket(timestamp_ntz'2026-01-01 21:05:30.5'), trading_day(timestamp_ntz'2026-01-01 21:05:30'), half_up(2.345D, 2), is_within_window(timestamp_ntz'2026-01-06 07:00:00'), is_within_window(timestamp_ntz'2026-01-06 11:00:00')") == [
        (dt.datetime(2026, 1, 1, 21, 5), dt.date(2026, 1, 2), 2.35, True, False)
    ]


@pytest.fixture
def store(spark, tmp_path):
    path = str(tmp_path / "other.db")
    c = sqlite3.connect(path)
    c.execute('create table t ("key" integer, name text, px real, twice integer, maybe integer)')
    c.executemany("insert into t values (?, ?, ?, ?, ?)", [(k * 3, f"n'{k % 7}", None if k % 5 == 0 else k / 2, k // 2, k if k else None) for k in range(1000)])
    c.execute("create table none (k integer, x text)")
    c.commit()
    keyed.register(spark)
    return lambda key, table="t", **more: spark.read.format("keyed").options(module="sqlite3", database=path, table=table, key=key, parts="7", **more)


def test_keyed_ranges_hold_every_row_once(store):
    df = store("key").load()
    assert df.rdd.getNumPartitions() == 7
    sizes = df.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) <= 1000 // 7 + 1
    rows = df.collect()
    assert sorted(r.key for r in rows) == [k * 3 for k in range(1000)]
    assert {(r.key, r.name, r.px) for r in rows} == {(k * 3, f"n'{k % 7}", None if k % 5 == 0 else k / 2) for k in range(1000)}


def test_filters_go_to_the_store(store):
    df = store("key").load().where("key > 300 and name in ('n''1', 'n''2') and px is not null")
    assert sorted(r.key for r in df.collect()) == [k * 3 for k in range(101, 1000) if k % 7 in (1, 2) and k % 5]
    reader = keyed.KeyedReader({"module": "sqlite3", "database": ":memory:", "table": "t", "key": "k"}, df.schema)
    left = list(reader.pushFilters([keyed.GreaterThan(("k",), 3), keyed.In(("n",), ("a", "b")), keyed.IsNotNull(("p",)), keyed.EqualTo(("s",), object())]))
    assert len(left) == 1 and reader._where(5, None) == (' where "k" > ? and "n" in (?, ?) and "p" is not null and "k" >= ?', (3, "a", "b", 5))


def test_a_key_that_orders_nothing_is_refused(store):
    for key in ("twice", "maybe"):
        with pytest.raises(Exception, match="is not unique"):
            store(key).load().collect()


def test_keyed_empty_table(store):
    assert store("k", "none").schema("k long, x string").load().collect() == []


def test_pages_without_a_usable_header(spark):
    rows = [("p", ["Last price", "Symbol"], [["5", "a"], ["Last price", "Symbol"], [" ", ""], ["x", None], ["7K", "b"]]), ("q", ["?", ""], [["c", "1"], ["symbol", "last"]]), ("r", None, [["d", "2"]]), ("s", ["Ticker"], []), ("t", ["Ticker", "Vol"], [["e"], ["f", "3"]])]
    pages = spark.createDataFrame(rows, "page string, header array<string>, rows array<array<string>>")
    aliases = {"symbol": ("symbol", "ticker"), "last_price": ("last",)}
    quotes, report = capture.page_quotes(pages, aliases, {"symbol": 0, "last_price": 1})
    assert sorted((r.page, r.row, r.symbol, r.last_price, r.used_fallback) for r in quotes.collect()) == [("p", 0, "A", 5.0, False), ("p", 4, "B", 7000.0, False), ("q", 0, "C", 1.0, True), ("r", 0, "D", 2.0, True), ("t", 0, "E", None, False), ("t", 1, "F", None, False)]
    assert sorted(map(tuple, report.collect())) == [("p", 2, 3, False), ("q", 1, 1, True), ("r", 1, 0, True), ("s", 0, 0, False), ("t", 2, 0, False)]
    assert capture.page_quotes(pages, aliases)[0].where("page in ('q', 'r')").count() == 0


def test_schema_report(spark):
    spark.createDataFrame([(1, None), (2, "x")], "a long, b string").createOrReplaceTempView("reported")
    got = {(r.table, r.column): (r.found, r.nulls, r.ok) for r in quality.schema_report(spark, {"reported": {"a": "bigint not null", "b": "string not null", "c": "int"}, "nowhere": {"d": "int"}}).collect()}
    assert got == {("reported", "a"): ("bigint", 0, True), ("reported", "b"): ("string", 1, False), ("reported", "c"): ("missing", None, False), ("nowhere", "d"): ("missing table", None, False)}
    assert [(r.column, r.position) for r in quality.catalogue(spark, ["reported"]).orderBy("position").collect()] == [("a", 0), ("b", 1)]


def test_sightings_are_dealt_by_the_size_of_their_table(spark, monkeypatch):
    """What a task holds doesn't grow with the table: its partitions do, and lines and orders are shuffled once."""
    from tidemark.operators import orders
    from tidemark.sources import standins

    monkeypatch.setattr(standins, "LINES", 4096)
    folded = orders.fold(standins.sightings(spark, "/root/testdata/sf0.001"))
    assert folded.rdd.getNumPartitions() == -(-os.path.getsize("/root/testdata/sf0.001/lineitem.parquet") // 4096) > 20
