"""Columns that turn numbers into report text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = ["B", "KB", "MB", "GB", "TB", "PB"]
BLOCKING_MARKS = ["start_blocking", "stop_blocking"]


def fixed(number: Column, places: int) -> Column:
    """A number to be printed with so many places: ties go to the even digit, as usual in reports of this kind."""
    return F.bround(number.cast("double"), places)


def human_bytes(size: Column) -> Column:
    """One decimal in the first unit below 1024; what is too large even for PB is divided once more and still called PB."""
    size = size.cast("double")
    out = None
    for i, unit in enumerate(UNITS):
        scaled = size / F.lit(float(1024**i))
        text = F.format_string(f"%3.1f {unit}", fixed(scaled, 1))
        out = F.when(scaled < 1024, text) if out is None else out.when(scaled < 1024, text)
    return out.otherwise(F.when(size.isNotNull(), F.format_string("%.1f PB", fixed(size / F.lit(float(1024 ** len(UNITS))), 1))))


def seconds_in(seconds: Column, unit: str) -> Column:
    """Seconds as minutes, hours, days, weeks or months (of four weeks)."""
    per = {"minutes": [60], "hours": [60, 60], "days": [60, 60, 24], "weeks": [60, 60, 24, 7], "months": [60, 60, 24, 7, 4]}[unit]
    out = seconds.cast("double")
    for n in per:
        out = out / F.lit(n)
    return out


def seconds_text(seconds: Column) -> Column:
    """Like 1y 2d 3h 4m 5s, without zero parts; 0s for none. Years have 365 days."""
    left = F.floor(seconds).cast("long")
    parts = []
    for unit, n in (("y", 31_536_000), ("d", 86_400), ("h", 3_600), ("m", 60)):
        whole = F.floor(left / n).cast("long")
        parts.append(F.when(whole != 0, F.concat(whole.cast("string"), F.lit(unit))))
        left = left - whole * n
    parts.append(F.when((left != 0) | (F.floor(seconds) == 0), F.concat(left.cast("string"), F.lit("s"))))
    return F.when(seconds.isNotNull(), F.concat_ws(" ", *parts))


def megabytes(size: Column) -> Column:
    return size / F.lit(1024) / F.lit(1024)


def real_time_factor(duration: Column, processing: Column) -> Column:
    """Seconds of sound for each second of processing; 0 where nothing was processed."""
    return F.when(processing > 0, duration / processing).otherwise(F.lit(0.0))


def percent_text(part: Column, whole: Column) -> Column:
    """Two decimals and a percent sign, or N/A of nothing."""
    return F.when(whole > 0, F.format_string("%.2f%%", fixed(part / whole * 100, 2))).otherwise(F.lit("N/A"))


def shortened(text: Column, n: int = 50) -> Column:
    """At most n characters, with ... where some are left out."""
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit("..."))).otherwise(text)


def preview(text: Column, n: int = 140) -> Column:
    return F.substring(text, 1, n)


def run_state(is_blocking: Column, stop: Column) -> Column:
    """blocking, alive or stopped. A stop of 0 is none."""
    alive = stop.isNull() | (stop == 0)
    return F.when(is_blocking, F.lit("blocking")).when(alive, F.lit("alive")).otherwise(F.lit("stopped"))


def status_line(state: Column, program: Column, rtf: Column, count: Column, rate: Column, mb_rate: Column, mb: Column, minutes: Column, percent: Column) -> Column:
    """One fixed-width report line."""
    return F.format_string("%s %-28s | %7.2fx %,9d %7.1f/s %9.2fMB/s | %10.2fMB %13.1fm | (%6.1f%%)", state, program, fixed(rtf, 2), count.cast("long"), fixed(rate, 1), fixed(mb_rate, 2), fixed(mb, 2), fixed(minutes, 1), fixed(percent, 1))


def is_measurement(name: Column) -> Column:
    """Whether a record measures something, rather than marking a wait."""
    return ~name.isin(BLOCKING_MARKS)


def throughput_text(files: Column, size: Column, elapsed: Column) -> Column:
    """Files and megabytes a second; empty in the first second."""
    return F.when(elapsed < 1, F.lit("")).otherwise(F.format_string("(%.1f files/s, %.1f MB/s)", fixed(files / elapsed, 1), fixed(megabytes(size) / elapsed, 1)))


def random_uuid8() -> Column:
    """A random UUID of version 8."""
    return F.overlay(F.uuid(), F.lit("8"), F.lit(15), F.lit(1))
