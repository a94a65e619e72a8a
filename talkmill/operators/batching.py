"""Batches of recordings: fixed sizes, the longest of a batch, flattening."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkmill.functions import arrays
from talkmill.operators.ordering import PART, TIE, split


def fixed_batches(rows: DataFrame, size: int, order: str, bucket: str, *ties: str) -> DataFrame:
    """rows with batch_id: runs of `size` rows in a numeric order, within each bucket (a key such as a date or an hour).

    Batches never cross buckets. A bucket's rows are numbered in parts of the order, and what the parts before hold is
    added, so a bucket with very many rows is no single task. ties: as for split(), for rows with one value of the order.
    """
    rows = split(rows, order, *ties)
    counts = rows.groupBy(F.col(bucket).alias("__bucket"), F.col(PART).alias("__of")).agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy("__bucket").orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    counts = counts.select("__bucket", "__of", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    number = F.row_number().over(Window.partitionBy(bucket, PART).orderBy(order, TIE)) + F.col("__before")
    out = rows.join(counts, F.col(bucket).eqNullSafe(F.col("__bucket")) & (F.col(PART) == F.col("__of")))
    return out.withColumn("batch_id", F.floor((number - 1) / size).cast("long")).drop(PART, TIE, "__bucket", "__of", "__before")


def longest(rows: DataFrame, keys: list[str], duration: str = "duration") -> DataFrame:
    return rows.groupBy(*keys).agg(F.max(duration).alias("longest"))


def padded_lengths(rows: DataFrame, keys: list[str], rate: int, duration: str = "duration") -> DataFrame:
    """rows (no samples) with pad_samples: the samples of the longest recording of the batch."""
    most = F.max(duration).over(Window.partitionBy(*keys))
    return rows.withColumn("pad_samples", arrays.target_samples(most, F.lit(rate)))


def pad_batch(rows: DataFrame, lengths: DataFrame, key: str, samples: str = "samples") -> DataFrame:
    """Samples padded to their batch's length; lengths (key, pad_samples) are joined to the arrays."""
    return rows.join(lengths.select(key, "pad_samples"), key).withColumn(samples, arrays.pad_right(F.col(samples), F.col("pad_samples")))


def flatten(rows: DataFrame, nested: str, out: str) -> DataFrame:
    """One row for each element of lists of lists."""
    return rows.withColumn(out, F.explode(F.flatten(nested))).drop(nested)
