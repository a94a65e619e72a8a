"""Recording files and object listings as DataFrames."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmill.functions import paths


#: Tasks for each core that look up or read very many small files, at most: starting a task costs more than reading some hundred.
TASKS = 1


def few_listing_tasks(spark: SparkSession) -> int:
    """Let Spark look up given files in a few tasks for each core, in place of one task for each file; how many."""
    tasks = TASKS * spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", tasks)
    return tasks


def inventory(spark: SparkSession, root: str, audio_only: bool = True, ignore_case: bool = False) -> DataFrame:
    """path, length, modificationTime and basename of all files below root. Contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length", "modificationTime")
    files = files.where(paths.is_audio(F.col("path"), ignore_case)) if audio_only else files
    return files.withColumn("basename", paths.basename(F.col("path")))


#: What tells a file's versions apart.
VERSION = ("length", "modificationTime")


def inventory_changes(spark: SparkSession, root: str, snapshots: str, version: int, audio_only: bool = True) -> DataFrame:
    """What changed below root since the last stored inventory: path, length, modificationTime, basename and change (added, changed, gone).

    The inventory now is stored as this version, which must be above those before; running it again gives the same rows.
    """
    now = f"{snapshots}/version={version}"
    if not exists(spark, f"{now}/_SUCCESS"):
        inventory(spark, root, audio_only).write.mode("overwrite").parquet(now)
    earlier = [n for n in numbers(spark, snapshots, "version") if n < version and exists(spark, f"{snapshots}/version={n}/_SUCCESS")]
    after = spark.read.parquet(now)
    if not earlier:
        return after.withColumn("change", F.lit("added"))
    return differences(spark.read.parquet(f"{snapshots}/version={max(earlier)}"), after)


def differences(before: DataFrame, after: DataFrame) -> DataFrame:
    """Files that are not the same in two inventories; those gone as they were before."""
    old, new = (rows.select("path", F.struct("length", "modificationTime", "basename").alias(name)) for rows, name in ((before, "old"), (after, "new")))
    both = old.join(new, "path", "full")
    same = [F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in VERSION]
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "gone").when(~(same[0] & same[1]), "changed")
    return both.withColumn("change", change).where("change is not null").select("path", F.coalesce("new", "old").alias("f"), "change").select("path", "f.*", "change")


def _hadoop_path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    found, fs_of = _hadoop_path(spark, path)
    return fs_of.exists(found)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file."""
    found, fs_of = _hadoop_path(spark, path)
    fs_of.create(found).close()


def numbers(spark: SparkSession, path: str, key: str) -> list[int]:
    """The numbers of folders `key=number` in a folder, in order; names only are read."""
    found, fs_of = _hadoop_path(spark, path)
    if not fs_of.exists(found):
        return []
    names = (status.getPath().getName() for status in fs_of.listStatus(found))
    return sorted(int(name.removeprefix(f"{key}=")) for name in names if name.startswith(f"{key}="))


def existing(spark: SparkSession, names: list[str]) -> dict[str, str]:
    """Of a bounded list of file names those whose file is there, with the path that Spark gives it. Each is looked up by itself; no folder is listed.

    Names of one store share its connection, so that a look-up costs a few calls of the JVM.
    """
    out, stores = {}, {}
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    for name in names:
        found, store = to_path(name), "/".join(name.split("/", 3)[:3]) if "://" in name else name.partition("/")[0]
        if store not in stores:
            stores[store] = _hadoop_path(spark, name)[1]
        if stores[store].exists(found):
            out[name] = stores[store].makeQualified(found).toString()
    return out


def contents(spark: SparkSession, root: str, extensions: tuple[str, ...] = ("wav",)) -> DataFrame:
    """path, length and content of all files below root with one of the extensions."""
    pattern = f"*.{extensions[0]}" if len(extensions) == 1 else f"*.{{{','.join(extensions)}}}"
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root).select("path", "length", "content")


def contents_of(spark: SparkSession, names: list[str]) -> DataFrame:
    """path, length and content of the files of a bounded list, all of which are there."""
    if not names:
        return spark.createDataFrame([], "path string, length long, content binary")
    few_listing_tasks(spark)
    return spark.read.format("binaryFile").load(names).select("path", "length", "content")


def write_contents(rows: DataFrame, root: str) -> None:
    """Rows (path, content) as files below root, which all tasks can reach; the tasks write them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to, base = fs.FileSystem.from_uri(root if "://" in root else f"file://{root.removeprefix('file:')}")
        folder = None
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                if (own := f"{base}/{path}".rpartition("/")[0]) != folder:  # made once for files that follow each other
                    to.create_dir(own, recursive=True)
                    folder = own
                with to.open_output_stream(f"{base}/{path}") as out:
                    out.write(content)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    rows.select("path", "content").mapInArrow(run, "n long").agg(F.sum("n")).first()


def relative_table(files: DataFrame, root: str, path_col: str = "path") -> DataFrame:
    """relative_path and path of each file."""
    return files.select(paths.relative_path(F.col(path_col), root).alias("relative_path"), F.col(path_col).alias("path"))


def parse_listing(lines: DataFrame, column: str = "value") -> DataFrame:
    """filename and size_bytes of the file lines of a listing: the last and the last but one of at least four parts.

    Blank lines, directories and lines without a whole number there are left out; names with blanks are cut.
    """
    value = F.col(column)
    parts = F.split(F.btrim(value, F.lit(" \t\r")), r"\s+")
    size = F.try_element_at(parts, F.lit(-2))
    rows = lines.where(~value.rlike(r"^\s*$") & ~F.endswith(value, F.lit("/")) & (F.size(parts) >= 4))
    return rows.where(size.rlike(r"^[+-]?[0-9]+$")).select(F.element_at(parts, -1).alias("filename"), size.try_cast("bigint").alias("size_bytes"))


def parse_directories(lines: DataFrame, column: str = "value") -> DataFrame:
    """dir: names of the directories of a listing, without slashes at their ends."""
    value = F.col(column)
    name = F.element_at(F.split(F.btrim(value, F.lit(" \t\r")), r"\s+"), -1)
    return lines.where(F.endswith(value, F.lit("/")) & F.contains(value, F.lit("DIR"))).select(F.rtrim(name, F.lit("/")).alias("dir"))


def key_levels(key: Column) -> dict[str, Column]:
    """bucket, switch, date and hour of an object key, null where it has fewer levels."""
    parts = F.split(key, "/")
    return {name: F.get(parts, F.lit(i)) for i, name in enumerate(("bucket", "switch", "date", "hour"))}


def write_listing(listing: DataFrame, path: str, key_col: str = "object_key") -> None:
    """A listing laid out by date and hour, so that reading some days or hours prunes the rest."""
    listing.withColumns(key_levels(F.col(key_col))).write.mode("append").partitionBy("date", "hour").parquet(path)


def excluding(files: DataFrame, marker: str, path_col: str = "path") -> DataFrame:
    """Files whose path doesn't hold the marker; only the listing is filtered, so excluded trees cost no reads."""
    return files.where(~F.contains(F.col(path_col), F.lit(marker)))
