"""Tables that several steps read, kept in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"

#: The white space of the word and line contracts: blank, tab, line feed, vertical tab, form feed, return.
BLANKS = " \t\n\x0b\f\r"
#: Bytes of an Arrow batch; a larger row is a batch of its own.
BATCH_BYTES = 4 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; without one, a new temporary folder if all tasks run on this machine."""
    found = spark.conf.get(CHECKPOINT_KEY, None)
    if not found:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set(CHECKPOINT_KEY, found)
    return found


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it again: later steps survive lost executors and don't compute it twice."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_small_batches(df: DataFrame) -> DataFrame:
    """Bound the Arrow batches that Python workers get by bytes. One bound for all operators, so the session's value is the same whenever a plan runs."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df


def ascii_lower(col):
    """Lower-case A-Z only. Texts of ASCII alone take the quick path."""
    return F.when(F.length(col) == F.octet_length(col), F.lower(col)).otherwise(F.translate(col, UPPER, LOWER))


def computed_once(value: Column, use) -> Column:
    """use(value), however often it names the value: a lambda's argument is computed once."""
    return F.transform(F.array(value), use)[0]


def running(values: Column, join) -> Column:
    """What join makes of each element of an array of ints and all before it, as prefix sums for +.

    In blocks of the square root of the length: arrays grow by one element at a time only within a block.
    """

    def inside(xs: Column) -> Column:
        return F.aggregate(xs, F.array().cast("array<int>"), lambda acc, x: F.concat(acc, F.array(F.when(F.size(acc) == 0, x).otherwise(join(F.try_element_at(acc, F.lit(-1)), x)))))

    def by_block(v: Column) -> Column:
        n = F.size(v)
        width = F.greatest(F.ceil(F.sqrt(n)).cast("int"), F.lit(1))
        return F.transform(F.sequence(F.lit(0), F.floor((n - 1) / width).cast("int")), lambda i: inside(F.slice(v, i * width + 1, width)))

    def joined(x: Column) -> Column:
        return F.flatten(F.transform(x["blocks"], lambda b, i: F.when(i == 0, b).otherwise(F.transform(b, lambda y: join(x["before"][i - 1], y)))))

    def over(v: Column) -> Column:
        blocks = computed_once(by_block(v), lambda bs: F.struct(bs.alias("blocks"), inside(F.transform(bs, lambda b: F.element_at(b, -1))).alias("before")))
        return F.when(F.size(v) == 0, v).otherwise(computed_once(blocks, joined))

    return computed_once(values, over)
