"""Captures as streams: bars by minute, retries dropped, partial frames merged, alerts throttled; and how streams are run."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType

from ..config import LIMITS, Limits
from ..operators import validation
from ..sources import folders, sinks


def without_retries(batches: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Each batch id once; a retry later than the allowed lateness is not even accepted."""
    return batches.withWatermark("capturedAt", f"{limits.late_minutes} minutes").dropDuplicatesWithinWatermark(["batchId"])


def minute_windows(quotes: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Windows ``w`` of one minute with a symbol's prices and cumulative volume in it."""
    order = F.struct("created_at", "id")
    return (
        quotes.where("last_price is not null")
        .withWatermark("created_at", f"{limits.late_minutes} minutes")
        .groupBy(F.window("created_at", "1 minute").alias("w"), "symbol", "trading_date")
        .agg(F.min_by("last_price", order).alias("open"), F.max("last_price").alias("high"), F.min("last_price").alias("low"), F.max_by("last_price", order).alias("close"), F.max("volume").alias("cumulative"))
    )


def minute_bars(quotes: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Bars of one minute, closed once no capture of that minute can come any more."""
    return minute_windows(quotes, limits).select("symbol", "trading_date", F.col("w.start").alias("minute"), "open", "high", "low", "close", "cumulative")


def store(quotes: DataFrame, path: str, rejects: str, keys: list[str], order: str) -> DataStreamWriter:
    """Good rows appended by day unless their key is there; rejected ones kept apart with their reason.

    A batch that is run again after a failure adds nothing twice.
    """

    def put(rows: DataFrame, batch: int) -> None:
        good, bad = validation.split(validation.quotes(rows))
        sinks.append_new(good, path, keys, order)
        bad.withColumn("batch", F.lit(batch)).write.mode("overwrite").parquet(f"{rejects}/batch={batch}")

    return quotes.writeStream.foreachBatch(put)


def ingest(pushed: DataFrame, path: str, ledger: str, query: str, keys: list[str], order: str, reason: str) -> DataStreamWriter:
    """Pushed batches stored once and answered from a ledger (see :func:`sinks.submit`); a micro-batch that is run again
    after a failure replaces what it had written, rows and answers."""

    def put(rows: DataFrame, batch: int) -> None:
        sinks.submit(rows, path, ledger, f"{query}-{batch}", keys, order, reason)

    return pushed.writeStream.foreachBatch(put)


def _keep(state: GroupState, at, after: str) -> None:
    """Let state time out once the watermark is ``after`` past its latest row."""
    due = int((at + pd.Timedelta(after)).timestamp() * 1000)
    state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))


def thinned(frames: DataFrame, key: str, ts: str, fields: tuple[str, ...]) -> DataFrame:
    """Frames without those that say nothing new beside the others of their Arrow batch: of each key the newest stay, and
    the newest with each field, whatever their order. What merges field by field gives the same, with less to shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(ts).cast(pa.int64()).fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
            codes = batch.column(key).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            order, keep = np.lexsort((at, codes)), np.zeros(len(at), bool)
            sent = [np.ones(len(at), bool)]
            for f in fields:
                known = batch.column(f).is_valid()
                sent += [known.to_numpy(zero_copy_only=False), pc.and_kleene(known, pc.invert(batch.column(f).is_nan())).fill_null(False).to_numpy(zero_copy_only=False)]
            for rows in (order[x[order]] for x in sent):
                keep[rows[np.append(codes[rows][1:] != codes[rows][:-1], True)] if len(rows) else rows] = True
            yield batch.filter(pa.array(keep))

    return frames.mapInArrow(run, frames.schema)


def merged_frames(frames: DataFrame, fields: tuple[str, ...], limits: Limits = LIMITS) -> DataFrame:
    """Partial frames of each symbol merged field by field, the last known value of each; a row for each batch's symbols.

    A field's last value is that of its newest frame, in whatever order frames come, in one batch or over several.
    ``stale`` marks a symbol whose price is older than five minutes. A symbol not seen for a week is forgotten.
    """
    frames = thinned(frames.select("symbol", "ts", *(F.col(f).cast("double").alias(f) for f in fields)), "symbol", "ts", fields)
    frames = frames.withWatermark("ts", f"{limits.late_minutes} minutes")
    schema = ", ".join(["symbol string", "ts timestamp", *(f"{f} double" for f in fields), "stale boolean"])
    state_schema = ", ".join(["ts timestamp", *(f"at{k} timestamp, {f} double" for k, f in enumerate(fields))])

    def merge(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        ts, *known = state.get if state.exists else (None, *[None] * (2 * len(fields)))
        for part in parts:
            for row in part.itertuples(index=False):
                ts = row.ts if ts is None or row.ts > ts else ts
                for k, f in enumerate(fields):
                    v, then = getattr(row, f), known[2 * k]
                    if v is not None and v == v and (then is None or row.ts >= then):
                        known[2 * k : 2 * k + 2] = row.ts, float(v)
        state.update((ts, *known))
        _keep(state, ts, "7 days")
        stale = known[0] is None or (ts - known[0]).total_seconds() > 5 * 60
        yield pd.DataFrame([(key[0], ts, *known[1::2], stale)], columns=["symbol", "ts", *fields, "stale"])

    return frames.groupBy("symbol").applyInPandasWithState(merge, schema, state_schema, "update", GroupStateTimeout.EventTimeTimeout)


def alerts(signals: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Signals to send, none within ``throttle_secs`` of the last one sent for its symbol and kind.

    State goes once the stream is past the throttled stretch and allowed lateness, when it can stop nothing any more.
    """
    signals = signals.withWatermark("fired_at", f"{limits.late_minutes} minutes")

    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = state.get[0] if state.exists else None
        rows = pd.concat(list(parts)).sort_values(["fired_at", "id"])
        sent = []
        for t in rows["fired_at"]:
            ok = last is None or (t - last).total_seconds() >= limits.throttle_secs
            last = t if ok else last
            sent.append(ok)
        state.update((last,))
        _keep(state, last, f"{limits.throttle_secs} seconds")
        yield rows[sent]

    return signals.groupBy("symbol", "signal").applyInPandasWithState(run, signals.schema.simpleString()[7:-1].replace(":", " "), "last timestamp", "append", GroupStateTimeout.EventTimeTimeout)


#: Processors with named states and timers need this state store.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def started(writer: DataStreamWriter, spark: SparkSession, partitions: int | None = None) -> StreamingQuery:
    """Start a stream on the state store that processors need; the session's own settings stay as they were.

    A stream's state is cut into ``partitions`` when it first starts, and each costs something in every batch: twice the
    cluster's cores if not given, where the session's shuffles would have more.
    """
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = {"spark.sql.streaming.stateStore.providerClass": STORE, "spark.sql.shuffle.partitions": str(partitions or min(most, 2 * spark.sparkContext.defaultParallelism))}
    had = {key: spark.conf.get(key, None) for key in own}
    for key, value in own.items():
        spark.conf.set(key, value)
    try:
        return writer.start()
    finally:
        for key, value in had.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def drain(stream: DataFrame, path: str, keys: list[str] | None = None, mode: str = "append") -> DataFrame:
    """Run a stream over all that is there and return what it wrote under ``path``; in update mode the last row of each key.

    Run again on the same ``path`` it carries on from its log, and returns what all runs wrote.
    """

    def put(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/out/batch={batch}")

    started(stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/log").trigger(availableNow=True).foreachBatch(put), stream.sparkSession).awaitTermination()
    spark = stream.sparkSession
    out = spark.read.schema(StructType([*stream.schema.fields, StructField("batch", LongType())])).parquet(f"{path}/out")
    if mode == "update":
        cols = [c for c in stream.columns if c not in keys]
        out = out.groupBy(*keys).agg(F.max_by(F.struct(*cols), "batch").alias("r")).select(*keys, "r.*")
    return out.select(*stream.columns)


def replay(rows: DataFrame, at: str, make: Callable[[DataFrame], DataFrame], path: str, keys: list[str] | None = None, mode: str = "append", runs: int = 2, closing: DataFrame | None = None) -> DataFrame:
    """What the stream ``make`` gives over stored rows that land in ``runs`` parts in order of the instant ``at``.

    After each landing the stream runs on what is new and stops, so each run takes up the state that the one before left.
    Rows are written once, and a landing is a move of files. ``closing`` rows land with the last part; later than all
    others, they move the clock past the end, so that nothing stays open.
    """
    spark = rows.sparkSession
    steps = [k / runs for k in range(1, runs)]
    cuts = rows.agg(F.percentile_approx(F.unix_micros(F.col(at)), steps).alias("c")).first().c or []
    part = sum(((F.unix_micros(F.col(at)) > c).cast("int") for c in cuts), F.lit(0))
    rows.withColumn("part", part).write.partitionBy("part").parquet(f"{path}/held")
    fs, landed = folders.file_system(spark, f"{path}/landed")
    fs.mkdirs(landed)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    for k in range(runs):
        held = hadoop(f"{path}/held/part={k}")
        if fs.exists(held):
            fs.rename(held, hadoop(f"{path}/landed/run={k}"))
        if closing is not None and k == runs - 1:
            closing.select(*rows.columns).write.parquet(f"{path}/landed/run={runs}")
        stream = spark.readStream.schema(rows.schema).parquet(f"{path}/landed/run=*")
        out = drain(make(stream), path, keys, mode)
    return out
