"""The measurement stream folded into a status for each program, and the measurements of running jobs."""

from __future__ import annotations

import threading
import time
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery, StreamingQueryListener

from talkmill.operators import catalog
from talkmill.sources import store

MEASUREMENT = "program string, name string, value double, seq long, ts double"
STATUS = "program string, start double, stop double, count double, bytes double, duration double, blocked double, open_start double, last_ts double, first_stop double, marked double, expired boolean"
_STATE = "start double, stop double, count double, bytes double, duration double, blocked double, open_start double, last_ts double, first_stop double, marked double"

#: Rows of a range, and ranges in a micro-batch.
RANGE_ROWS, RANGE_FILES = 200_000, 32

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def new_state() -> dict:
    return {"start": None, "stop": None, "count": 0.0, "bytes": 0.0, "duration": 0.0, "blocked": 0.0, "open_start": None, "last_ts": None, "first_stop": None, "marked": 0.0}


SUMS, MARKS, WAITS = ("count", "bytes", "duration"), ("start", "stop"), ("start_blocking", "stop_blocking")


def folded(state: dict, rows: pd.DataFrame) -> dict:
    """A state with measurements (name, value, seq, ts) of a program, all later than those before: arrays, no loop over rows.

    A stop of waiting closes the interval that is open; without one it counts for nothing. first_stop: the time of the
    first mark of waiting, if that is a stop, which may close an interval of an earlier range. A null value adds nothing.
    """
    rows = rows.sort_values("seq", kind="stable")
    name, value, ts = rows["name"].to_numpy(object), rows["value"].to_numpy(np.float64, na_value=np.nan), rows["ts"].to_numpy(np.float64)
    out = dict(state)
    for n in SUMS:
        out[n] += float(np.nansum(value[name == n]))
    for n in MARKS:
        own = value[name == n]
        if len(own):
            out[n] = None if np.isnan(own[-1]) else float(own[-1])
    wait = np.isin(name, WAITS)
    begins, at = name[wait] == WAITS[0], ts[wait]
    if len(at):
        if not state["marked"] and not begins[0]:
            out["first_stop"] = float(at[0])
        closes = ~begins[1:] & begins[:-1]  # a stop right behind a start
        out["blocked"] += float((at[1:] - at[:-1])[closes].sum())
        if not begins[0] and state["open_start"] is not None:
            out["blocked"] += float(at[0]) - state["open_start"]
        out["open_start"] = float(at[-1]) if begins[-1] else None
        out["marked"] = 1.0
    if not wait.all():
        out["last_ts"] = float(ts[~wait][-1])
    return out


def fold(state: dict, name: str, value: float | None, ts: float) -> dict:
    """One measurement more."""
    return folded(state, pd.DataFrame({"name": [name], "value": [np.nan if value is None else value], "seq": [0], "ts": [ts]}))


def presummed(measurements: DataFrame) -> DataFrame:
    """Measurements with one row for the sums of each program, name and batch of a task, at its last place; marks stay.

    What the state has to fold is then little more than the marks. All columns but value, seq and ts are keys.
    """
    columns = measurements.columns
    keys = [c for c in columns if c not in ("value", "seq", "ts")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sums = batch["name"].isin(SUMS)
            own = batch[sums].sort_values("seq", kind="stable").groupby(keys, sort=False, dropna=False)
            yield pd.concat([own.agg(value=("value", "sum"), seq=("seq", "last"), ts=("ts", "last")).reset_index()[columns], batch[~sums]])

    return measurements.mapInPandas(run, measurements.schema)


def totals() -> list[Column]:
    """What a job observes of the rows (size_bytes, duration) it writes."""
    return [F.count(F.lit(1)).cast("double").alias("count"), F.coalesce(F.sum("size_bytes"), F.lit(0)).cast("double").alias("bytes"), F.coalesce(F.sum("duration"), F.lit(0.0)).alias("duration")]


def emit(spark: SparkSession, path: str, program: str, values: dict[str, float], seq: int) -> None:
    """Measurements of a job into a folder, by the number of its write; what was there under this number is replaced."""
    now = time.time()
    rows = [(program, name, float(value), seq, now) for name, value in values.items()]
    spark.createDataFrame(rows, MEASUREMENT).coalesce(1).write.mode("overwrite").parquet(f"{path}/program={program}/write={seq}")


def emitted(spark: SparkSession, path: str) -> DataFrame:
    """All measurements of a folder."""
    return spark.read.schema(MEASUREMENT).option("recursiveFileLookup", True).parquet(path)


class ProgramStatus(StatefulProcessor):
    """State of one program, or of one range of it where keys name a range too. idle_seconds: how long without a measurement before its status is given as expired."""

    def __init__(self, idle_seconds: float | None = None, keys: tuple[str, ...] = ("program",)):
        self.idle_seconds, self.keys = idle_seconds, keys

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("status", _STATE)

    def row(self, key, state: dict, expired: bool) -> pd.DataFrame:
        out = pd.DataFrame([{**dict(zip(self.keys, key, strict=True)), **state, "expired": expired}])
        floats = [c for c in out.columns if c not in (*self.keys, "expired")]
        return out.astype(dict.fromkeys(floats, "float64"))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state = dict(zip(new_state(), self.state.get(), strict=True)) if self.state.exists() else new_state()
        state = folded(state, pd.concat(list(rows)))
        self.state.update(tuple(state.values()))
        if self.idle_seconds is not None:
            for timer in self.handle.listTimers():
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + int(self.idle_seconds * 1000))
        yield self.row(key, state, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.state.exists():
            yield self.row(key, dict(zip(new_state(), self.state.get(), strict=True)), True)

    def close(self) -> None:
        pass


def use_rocksdb(spark: SparkSession) -> None:
    """State is kept in RocksDB, which this operator needs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def program_status(measurements: DataFrame, idle_seconds: float | None = None, ranged: bool = False) -> DataFrame:
    """A stream of measurements to a stream of statuses, a row for each program that changed.

    ranged: a row for each program and value of the column range; each range is folded on its own, see merged().
    """
    keys, schema = ("program",), STATUS
    if ranged:
        keys, schema = ("program", "range"), STATUS.replace(",", ", range int,", 1)
    return presummed(measurements).groupBy(*keys).transformWithStateInPandas(ProgramStatus(idle_seconds, keys), schema, "Update", "ProcessingTime" if idle_seconds is not None else "None")


def write_ranges(measurements: DataFrame, path: str) -> None:
    """Measurements as files of about RANGE_ROWS rows, each a range of seq, with the range's number.

    A program's rows of one range are all that a task holds at once, however many a program has.
    """
    n = max(1, -(-measurements.count() // RANGE_ROWS))
    measurements.repartitionByRange(n, "seq").withColumn("range", F.spark_partition_id()).write.parquet(path)


def merged(statuses: DataFrame) -> DataFrame:
    """Statuses of programs from those of their ranges, one of each. A range's first stop closes what the marks before left open."""
    floats = [c for c in new_state() if c != "marked"]
    rows = statuses.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})
    w = Window.partitionBy("program", F.col("marked") > 0).orderBy("range")
    rows = rows.withColumn("before", F.when(F.col("marked") > 0, F.lag("open_start").over(w)))
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("range"))).alias(c) for c in ("start", "stop", "last_ts")]
    sums = [F.sum(c).alias(c) for c in ("count", "bytes", "duration")]
    blocked = F.sum(F.col("blocked") + F.coalesce(F.col("first_stop") - F.col("before"), F.lit(0.0))).alias("blocked")
    return rows.groupBy("program").agg(*last, *sums, blocked, F.max_by("open_start", F.when(F.col("marked") > 0, F.col("range"))).alias("open_start"))


def start_reports(status: DataFrame, sink, checkpoint: str, every: str = "20 seconds", **trigger) -> StreamingQuery:
    """Hand the changed statuses to sink(batch, batch_id) at intervals."""
    return status.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": every})).start()


class Silence(StreamingQueryListener):
    """Tells when a query of statuses has fallen silent, or has ended.

    Each progress brings how many statuses of the micro-batch were expired (the observed metric that watched() adds).
    When there are some, `all_expired` is asked; nothing is looked at in between.
    """

    def __init__(self, all_expired) -> None:
        self.all_expired, self.over, self.silent, self.error, self.query_id = all_expired, threading.Event(), False, None, None

    @staticmethod
    def watched(statuses: DataFrame) -> DataFrame:
        return statuses.observe("silence", F.count_if("expired").alias("expired"))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = (event.progress.observedMetrics or {}).get("silence")
        if str(event.progress.id) == self.query_id and seen is not None and seen["expired"] and self.all_expired():
            self.silent = True
            self.over.set()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.id) == self.query_id:
            self.error = event.exception
            self.over.set()


def report_until_idle(measurements: DataFrame, idle_seconds: float, log: str, report: str, checkpoint: str, version: str, timestamp: str, every: str = "1 second", timeout: float | None = None) -> bool:
    """Log the statuses of a stream of measurements until no program has sent any for idle_seconds; then stop, and save the last of each as a report.

    A listener waits for the silence. False if that doesn't happen within timeout seconds; the report is saved all the same.
    """
    spark = measurements.sparkSession

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch", F.lit(batch_id).cast("long")).write.mode("append").parquet(log)

    silence = Silence(lambda: last_statuses(spark, log).where("not expired").isEmpty())
    spark.streams.addListener(silence)
    try:
        query = start_reports(Silence.watched(program_status(measurements, idle_seconds)), sink, checkpoint, every)
        silence.query_id = str(query.id)
        if not query.isActive:
            silence.over.set()
        try:
            silence.over.wait(timeout)
            if query.exception() is not None:
                raise query.exception()
        finally:
            query.stop()
    finally:
        spark.streams.removeListener(silence)
    store.save_report(last_statuses(spark, log), report, version, timestamp)
    return silence.silent


def last_statuses(spark: SparkSession, log: str) -> DataFrame:
    """The last status of each program of a log."""
    return catalog.latest(spark.read.parquet(log), "program", "batch", "expired").drop("batch")
