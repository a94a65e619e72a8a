"""A catalog on disk: an append-only log of document versions, a folder for each number, and snapshots of the last of each.

A snapshot goes to a new folder; nothing that is being read is written over.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmill.functions import documents
from talkmill.operators import catalog
from talkmill.sources import files


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of documents, typed and with defaults. The store's own _id is not carried."""
    return documents.parse_documents(spark.read.text(path))


def append(docs: DataFrame, path: str, seq: int) -> None:
    """Add document versions to the log, in the folder of their number. seq: rises from write to write."""
    docs.drop("_id", "seq").write.mode("append").parquet(f"{path}/seq={seq}")


def append_once(docs: DataFrame, path: str, seq: int) -> None:
    """Like append(), but what is there already under this number stays, and what a broken write left there goes."""
    if not is_written(docs.sparkSession, path, seq):
        docs.drop("_id", "seq").write.mode("overwrite").parquet(f"{path}/seq={seq}")


def append_each(docs: DataFrame, path: str, seqs: list[int]) -> None:
    """Like append_once() for versions of several numbers, which the column seq tells, in one write."""
    spark = docs.sparkSession
    left = [seq for seq in seqs if not is_written(spark, path, seq)]
    if left:
        rows = docs.drop("_id").where(F.col("seq").isin(left)).repartition("seq")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("seq").parquet(path)
        for seq in left:
            files.touch(spark, f"{path}/seq={seq}/_SUCCESS")


def is_written(spark: SparkSession, path: str, seq: int) -> bool:
    """Whether versions of this number were written to their end."""
    return files.exists(spark, f"{path}/seq={seq}/_SUCCESS")


def read_log(spark: SparkSession, path: str, after: int | None = None) -> DataFrame:
    """All versions, with seq; those after a number read only their own folders."""
    log = spark.read.parquet(path).withColumn("seq", F.col("seq").cast("long"))
    return log if after is None else log.where(F.col("seq") > after)


def load_all(spark: SparkSession, path: str, key: str = "uuid", snapshots: str | None = None) -> DataFrame:
    """The last version of each document of a log.

    With snapshots (see compact), only versions after the last snapshot are brought together; documents without any are
    taken from it as they are.
    """
    found = current(spark, snapshots) if snapshots else None
    if found is None:
        return catalog.latest(read_log(spark, path), key, "seq").drop("seq")
    upto, base = found
    tail = catalog.latest(read_log(spark, path, upto), key, "seq").drop("seq")
    newer = tail.select(F.col(key).alias("__newer"))
    return base.drop("bucket", "seq").join(newer, F.col(key).eqNullSafe(F.col("__newer")), "left_anti").unionByName(tail, allowMissingColumns=True)


# Snapshots of a log: the last version of each document, in buckets of keys. A compaction writes only buckets that have
# new versions, and a list of where each bucket was written last.

BUCKETS = 64


def current(spark: SparkSession, snapshots: str) -> tuple[int, DataFrame] | None:
    """Number of the last version in the last snapshot, and its documents with seq and bucket; None without one."""
    if not files.exists(spark, f"{snapshots}/list"):
        return None
    whole = [n for n in files.numbers(spark, f"{snapshots}/list", "upto") if files.exists(spark, f"{snapshots}/list/upto={n}/_SUCCESS")]
    if not whole:
        return None
    upto = max(whole)
    where = spark.read.parquet(f"{snapshots}/list/upto={upto}").collect()  # a row for each bucket
    data = f"{snapshots}/data"
    return upto, spark.read.option("basePath", data).parquet(*(f"{data}/upto={r['upto']}/bucket={r['bucket']}" for r in where)).drop("upto")


def compact(spark: SparkSession, path: str, snapshots: str, key: str = "uuid", buckets: int = BUCKETS) -> int | None:
    """Merge the log's versions since the last snapshot into a new one; the number of its last version (None: nothing to do).

    The number of buckets is that of the first compaction. Older snapshots stay as they are.
    """
    found = current(spark, snapshots)
    tail = read_log(spark, path, found[0] if found else None)
    upto = tail.agg(F.max("seq")).first()[0]
    if upto is None:
        return None
    where = {} if found is None else {r["bucket"]: r["upto"] for r in spark.read.parquet(f"{snapshots}/list/upto={found[0]}").collect()}
    n = spark.read.parquet(f"{snapshots}/list/upto={found[0]}").first()["buckets"] if found else buckets
    tail = tail.where(F.col("seq") <= upto).withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(n)).cast("int"))
    touched = sorted(r["bucket"] for r in tail.select("bucket").distinct().collect())  # at most n
    rows = tail if found is None else tail.unionByName(found[1].where(F.col("bucket").isin(touched)), allowMissingColumns=True)
    merged = catalog.latest(rows, key, "seq").repartition("bucket")
    merged.write.mode("overwrite").partitionBy("bucket").parquet(f"{snapshots}/data/upto={upto}")
    where |= dict.fromkeys(touched, upto)
    spark.createDataFrame([(b, u, n) for b, u in where.items()], "bucket int, upto long, buckets int").coalesce(1).write.mode("overwrite").parquet(f"{snapshots}/list/upto={upto}")
    return upto


def snapshot(spark: SparkSession, log: str, out: str) -> DataFrame:
    """Write the log's last versions to a new folder, and read them."""
    load_all(spark, log).write.parquet(out)
    return spark.read.parquet(out)


def show_all(spark: SparkSession, path: str, n: int = 20) -> None:
    load_all(spark, path).show(n, truncate=80)


def recording_urls(docs: DataFrame) -> DataFrame:
    """filename of each document's first dialog."""
    return docs.select(documents.first_dialog("filename").alias("filename"))


def export_jsonl(docs: DataFrame, path: str) -> None:
    """One JSON document a line; null fields are left out."""
    documents.export_form(docs).write.option("ignoreNullFields", True).json(path)


def clear(spark: SparkSession, path: str, out: str) -> int:
    """Write an empty catalog of the same schema to a new folder; the number of documents left behind."""
    docs = spark.read.parquet(path)
    docs.where(F.lit(False)).write.parquet(out)
    return docs.count()


def save_report(status: DataFrame, path: str, version: str, timestamp: str) -> None:
    """Status rows as JSON, with version and time."""
    status.withColumns({"version": F.lit(version), "timestamp": F.lit(timestamp)}).write.mode("overwrite").json(path)
