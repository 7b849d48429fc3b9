"""Jobs over a folder: one day at a time gives what all at once gives; a second run changes nothing."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import jobs
from tidemark.sources import capture, standins

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    standins.quotes(spark, SF).write.parquet(f"{path}/quotes")
    standins.watchlist(spark, SF).write.parquet(f"{path}/watchlist")
    standins.instruments(spark, SF).withColumn("is_tradeable", F.col("is_primary")).write.parquet(f"{path}/instruments")
    standins.summaries(spark, SF).write.parquet(f"{path}/market_summary")
    return path


def rows(spark, path):
    df = spark.read.parquet(path)
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_days_one_by_one(spark, folder):
    path = jobs.run("daily.symbolday", spark, folder)
    every = rows(spark, path)
    days = sorted(r[0] for r in spark.read.parquet(path).select("trading_date").distinct().collect())
    for day in days[-2:]:
        jobs.run("daily.symbolday", spark, folder, str(day))
    assert rows(spark, path) == every
    market = jobs.run("daily.marketday", spark, folder)
    before = rows(spark, market)
    jobs.run("daily.marketday", spark, folder, str(days[-1]))
    assert rows(spark, market) == before
    with pytest.raises(ValueError, match="not a session"):
        jobs.run("daily.marketday", spark, folder, "1999-01-01")


def test_intraday_chain(spark, folder):
    for name in ("signals.minute", "signals.fast", "signals.score", "signals.wakeup", "daily.history", "daily.analysis"):
        path = jobs.run(name, spark, folder)
        assert name == "signals.wakeup" or name == "daily.history" or spark.read.parquet(path).count() > 0


def test_board_and_cells(spark):
    t = dt.datetime(2026, 8, 25, 6)
    frames = spark.createDataFrame([("abar", t, 5.0, None), ("101", t, None, 7.0), ("ABAR", t + dt.timedelta(seconds=1), None, 8.0), ("zz", t, 1.0, 1.0)], "sym string, ts timestamp_ntz, px double, qty double")
    master = spark.createDataFrame([("101", "ABAR", "101", None, "Premier Market"), ("ABAR", "ABAR", "101", None, "Premier Market")], "alias string, symbol string, code string, description string, market string")
    best, unknown = capture.board(frames, master, ("px", "qty"), ("Premier Market",))
    r = best.first()
    assert (r.symbol, r.px, r.qty) == ("ABAR", 5.0, 8.0) and [x.alias for x in unknown.collect()] == ["ZZ"]
    cells = spark.createDataFrame([(["Symbol", "Last", "Volume"],), (["KSE:abar", "1,234.5", "2K"],), (["", "5", "6"],)], "cells array<string>")
    assert [tuple(x) for x in capture.quotes_from_cells(cells, ["Symbol", "Last", "Volume"]).collect()] == [("ABAR", 1234.5, 2000.0)]
