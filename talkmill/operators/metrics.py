"""Live metrics from a table of measurements: program, name, value, seq, and ts (seconds) of blocking marks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkmill.functions import text
from talkmill.operators.ordering import PART, TIE, split

MEASURES = ["count", "bytes", "duration"]


def record(program: Column, name: str, value: Column, seq: Column) -> Column:
    """A measurement as a struct."""
    return F.struct(program.alias("program"), F.lit(name).alias("name"), value.cast("double").alias("value"), seq.alias("seq"))


def counters(measurements: DataFrame, worker_id: bool = False) -> DataFrame:
    """Sums of count, bytes and duration by program. A null value adds nothing."""
    keys = ["program", "worker_id"] if worker_id else ["program"]
    return measurements.groupBy(*keys).agg(*(F.coalesce(F.sum(F.when(F.col("name") == n, F.col("value"))), F.lit(0.0)).alias(n) for n in MEASURES))


def marks(measurements: DataFrame) -> DataFrame:
    """The last start and stop of each program (null: none)."""
    return measurements.groupBy("program").agg(*(F.max_by(F.when(F.col("name") == n, F.col("value")), F.when(F.col("name") == n, F.col("seq"))).alias(n) for n in ("start", "stop")))


def blocking(measurements: DataFrame, time: str = "ts") -> DataFrame:
    """program, blocked (seconds of closed intervals), n_intervals, and open_start (null: not waiting).

    A stop closes the interval that the mark right before it opened; a start after a start opens a new one, and a stop
    after a stop closes none. Only marks are dealt out, by program and part of the order; each part becomes a row, whose
    first mark may close what the last mark of the part before opened. Marks of one seq follow each other by a hash.
    """
    only = measurements.where(F.col("name").isin(text.BLOCKING_MARKS)).select("program", "name", "seq", F.col(time).alias("t"))
    only = split(only, "seq")
    place = F.struct("seq", TIE)
    w = Window.partitionBy("program", PART).orderBy("seq", TIE)
    row = only.withColumns({"__name": F.lag("name").over(w), "__t": F.lag("t").over(w)})
    closes = (F.col("name") == "stop_blocking") & (F.col("__name") == "start_blocking")
    ends = [f(c, place).alias(f"{end}_{c}") for end, f in (("first", F.min_by), ("last", F.max_by)) for c in ("name", "t")]
    parts = row.groupBy("program", PART).agg(F.coalesce(F.sum(F.when(closes, F.col("t") - F.col("__t"))), F.lit(0.0)).alias("blocked"), F.count_if(closes).alias("n_intervals"), *ends)
    w = Window.partitionBy("program").orderBy(PART)  # a row for each part
    parts = parts.withColumns({"__name": F.lag("last_name").over(w), "__t": F.lag("last_t").over(w)})
    over = (F.col("first_name") == "stop_blocking") & (F.col("__name") == "start_blocking")
    last_name, last_t = F.max_by("last_name", PART), F.max_by("last_t", PART)
    blocked = F.sum(F.col("blocked") + F.when(over, F.col("first_t") - F.col("__t")).otherwise(F.lit(0.0)))
    return parts.groupBy("program").agg(blocked.alias("blocked"), F.sum(F.col("n_intervals") + over.eqNullSafe(True).cast("long")).alias("n_intervals"), F.when(last_name == "start_blocking", last_t).alias("open_start"))


def status(sums: DataFrame, bounds: DataFrame, waits: DataFrame, now: Column) -> DataFrame:
    """All metrics of each program, at the time now. bounds: program, start, stop (null or 0: running)."""
    row = sums.join(bounds, "program").join(waits, "program", "left").withColumn("now", now)
    stopped = F.coalesce(F.col("stop"), F.lit(0.0)) != 0
    is_blocking = F.col("open_start").isNotNull()
    row = row.withColumns({"total_runtime": F.when(stopped, F.col("stop")).otherwise(F.col("now")) - F.col("start"), "total_blocking": F.coalesce("blocked", F.lit(0.0)) + F.when(~stopped & is_blocking, F.col("now") - F.col("open_start")).otherwise(F.lit(0.0)), "state": text.run_state(is_blocking, F.col("stop"))})
    row = row.withColumn("processing", F.col("total_runtime") - F.col("total_blocking"))
    return row.select("program", "state", *MEASURES, "total_runtime", "total_blocking", "processing", (F.try_divide("processing", "total_runtime") * 100).alias("percent_running"), F.try_divide("count", "processing").alias("rate"), F.try_divide(text.megabytes(F.col("bytes")), "processing").alias("mb_rate"), text.real_time_factor(F.col("duration"), F.col("processing")).alias("rtf"))


def with_average(rows: DataFrame, final: str) -> DataFrame:
    """rows (program, count, bytes, duration) and one more, avg: the totals of the final program."""
    return rows.unionByName(rows.where(F.col("program") == final).withColumn("program", F.lit("avg")))


def average_rtf(sums: DataFrame, bounds: DataFrame, final: str, now: Column) -> DataFrame:
    """One row for the final program: bytes, and its duration for each second since its start."""
    row = sums.where(F.col("program") == final).join(bounds, "program")
    return row.select("program", "bytes", F.try_divide("duration", now - F.col("start")).alias("avg_rtf"))


def throughput(rows: DataFrame, elapsed: Column, size: str = "size_bytes") -> DataFrame:
    """One row: files, bytes, and both a second (null in the first second)."""
    out = rows.agg(F.count("*").alias("files"), F.coalesce(F.sum(F.coalesce(F.col(size), F.lit(0))), F.lit(0)).alias("bytes"))
    ok = elapsed >= 1
    return out.select("files", "bytes", F.when(ok, F.try_divide("files", elapsed)).alias("files_per_sec"), F.when(ok, F.try_divide(text.megabytes(F.col("bytes")), elapsed)).alias("mb_per_sec"))


def running_totals(rows: DataFrame, order: str, size: str, *ties: str) -> DataFrame:
    """rows with running files and bytes over all rows, in a numeric order; ties as for split().

    Sums within parts of the order are added to what the parts before hold, so that no task sees all rows.
    """
    rows = split(rows, order, *ties)
    totals = rows.groupBy(PART).agg(F.count("*").alias("__n"), F.sum(size).alias("__b"))
    earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    before = totals.select(PART, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__n0"), F.coalesce(F.sum("__b").over(earlier), F.lit(0)).alias("__b0"))
    inside = Window.partitionBy(PART).orderBy(order, TIE).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.join(F.broadcast(before), PART).withColumns({"files": F.col("__n0") + F.count("*").over(inside), "bytes": F.col("__b0") + F.coalesce(F.sum(size).over(inside), F.lit(0))})
    return out.drop(PART, TIE, "__n0", "__b0")


def discovery_rate(running: DataFrame, started: Column, time: str) -> DataFrame:
    """Megabytes a second up to each row of running totals; at least a thousandth of a second counts as elapsed."""
    return running.withColumn("mb_per_sec", text.megabytes(F.col("bytes")) / F.greatest(F.col(time) - started, F.lit(0.001)))
