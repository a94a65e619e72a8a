"""Columns over sample arrays. Large arrays are never shuffled: lengths are joined back, not samples."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def array_duration(samples: Column, rate: Column) -> Column:
    """Seconds of an array of samples."""
    return F.try_divide(F.size(samples), rate)


def target_samples(duration: Column, rate: Column) -> Column:
    return F.floor(duration * rate).cast("long")


def pad_right(samples: Column, n: Column) -> Column:
    """Zeros up to n samples; longer arrays stay as they are."""
    missing = F.greatest(n - F.size(samples), F.lit(0)).cast("int")
    return F.concat(samples, F.array_repeat(F.lit(0.0).cast("float"), missing))


def mono(channels: Column) -> Column:
    """The mean of all channels; a single one as it is; null without channels."""
    first, n = F.get(channels, F.lit(0)), F.size(channels)
    total = F.aggregate(F.slice(channels, 2, F.greatest(n - 1, F.lit(0))), F.transform(first, lambda x: x.cast("double")), lambda acc, c: F.zip_with(acc, c, lambda x, y: x + y))
    return F.when(n == 1, first).when(n > 1, F.transform(total, lambda x: (x / n).cast("float")))


def is_mono(channels: Column) -> Column:
    """False for null too."""
    return F.coalesce(F.size(channels) == 1, F.lit(False))


def squeeze(channels: Column) -> Column:
    """The first channel as 32-bit floats."""
    return F.get(channels, F.lit(0)).cast("array<float>")


def array_bytes(samples: Column, width: int = 4) -> Column:
    return F.size(samples).cast("long") * width


def shape(channels: Column) -> Column:
    """Samples and channels."""
    return F.struct(F.size(F.get(channels, F.lit(0))).alias("samples"), F.size(channels).alias("channels"))
