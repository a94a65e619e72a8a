"""Continuous jobs: files become documents, recordings become transcripts, results go to the catalog's log.

Checkpoints take the place of leases and queues; source limits and triggers that of batch sizes and timeouts.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from talkmill.functions import arrays, documents, paths, text
from talkmill.operators import audio, batching, catalog, inference, ordering
from talkmill.sources import files, store
from talkmill.streaming import live_metrics

STATE = "uuid string, basename string, filename string, created_at timestamp, done boolean, corrupt boolean, processed_by string, claim_present boolean, duration double, language string, transcript string"
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


#: Micro-batches after which Spark writes the list of all files that a stream has seen anew: its cost grows with their number.
LISTED_ANEW = 100


def file_stream(spark: SparkSession, root: str, pattern: str = "*.wav", max_files: int = 8) -> DataFrame:
    """New files below root, at most max_files in a micro-batch. Queries over the stream look them up in few tasks."""
    files.few_listing_tasks(spark)
    spark.conf.set("spark.sql.streaming.fileSource.log.compactInterval", LISTED_ANEW)
    return spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("recursiveFileLookup", True).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", max_files).load(root)


def packed(found: DataFrame) -> DataFrame:
    """Files in fewer tasks where there are very many: Spark counts each small file as 4 MB, which gives hundreds of tasks for a few thousand."""
    return found.coalesce(files.TASKS * found.sparkSession.sparkContext.defaultParallelism)


def discovered(found: DataFrame) -> DataFrame:
    """A document for each new recording. Contents are not read."""
    return documents.new_documents(packed(found).where(paths.is_audio(F.col("path"))).select(F.col("path").alias("filename"), F.col("length").alias("size_bytes")))


def prepared(recordings: DataFrame, rate: int = audio.RATE, decoders: dict[str, audio.Decoder] | None = None) -> DataFrame:
    """path, size_bytes, duration, samples (mono, trimmed) and error of each recording."""
    return audio.preprocess(recordings, rate, decoders)


def padded(batch: DataFrame, rate: int = audio.RATE, size: int = inference.BATCH, parts: int = ordering.PARTS) -> DataFrame:
    """Samples padded to the longest recording of their bucket (as long as it was before trimming).

    Buckets are ranges of durations with about `size` recordings each, or more of them where they are more than `parts`
    buckets; so a long recording lengthens those of its bucket only. One pass over the durations finds the bounds, and a
    recording's length follows from its duration alone: nothing is joined or shuffled.
    """
    told = batch.agg(F.count("duration").alias("n"), F.max("duration").alias("most"), ordering.quantiles_of("duration", parts).alias("q")).first()
    if not told["n"]:
        return batch
    every = max(1, round(parts * size / told["n"]))  # quantiles to a bucket
    bounds = [*(told["q"] or [])[every - 1 :: every], told["most"]]
    longest = ordering.next_of(F.coalesce("duration", F.lit(0.0)), bounds, T.DoubleType())
    return batch.withColumn("samples", arrays.pad_right(F.col("samples"), arrays.target_samples(longest, F.lit(rate))))


def identified(rows: DataFrame, backend: inference.Backend, labels: list[str], all_english: bool = False, drop_others: bool = False) -> DataFrame:
    """rows with language and route; a route column stands for separate queues."""
    code = inference.label_code(inference.label_indexes(F.col("samples"), backend, even=True), labels, F.col("samples").isNull())
    return rows.withColumn("language", code).withColumn("route", inference.route(F.col("language"), all_english, drop_others))


def results(rows: DataFrame) -> DataFrame:
    """What the catalog keeps of a processed recording: size, language, transcript and flags, no samples."""
    bad = F.col("error").isNotNull() | F.col("route").eqNullSafe("corrupt")
    return rows.select(paths.basename(F.col("path")).alias("basename"), F.col("path").alias("filename"), "size_bytes", "duration", "language", "transcript", F.lit(True).alias("done"), bad.alias("corrupt"), F.lit(None).cast("string").alias("processed_by"))


@contextmanager
def processed(recordings: DataFrame, identify: inference.Backend, labels: list[str], transcribe: dict[str, inference.Backend], rate: int = audio.RATE, all_english: bool = False, drop_others: bool = False, decoders: dict[str, audio.Decoder] | None = None) -> Iterator[DataFrame]:
    """Files (path, content) to results, to be used within the context.

    Each file is decoded once and kept on disk meanwhile, as lengths must be known for padding, and identified once;
    its route picks the backend. Backends get arrays of one length at once. Unreadable files, and routes marked corrupt,
    end as corrupt and done. decoders: see audio.load().
    """
    rows = prepared(packed(recordings), rate, decoders).persist(StorageLevel.DISK_ONLY)
    try:
        spoken = inference.transcribe_routes(identified(padded(rows.where("error is null"), rate), identify, labels, all_english, drop_others), transcribe, even=True)
        yield results(spoken.unionByName(rows.where("error is not null").drop("samples"), allowMissingColumns=True))
    finally:
        rows.unpersist()


def process_batch(recordings: DataFrame, log: str, seq: int, identify: inference.Backend, labels: list[str], transcribe: dict[str, inference.Backend], measured: str | None = None, program: str = "processing", **options) -> None:
    """Results of files (path, content) into the log, in a batch or in a micro-batch. options: as for processed().

    measured: a folder of measurements, to which count, bytes and duration of the written rows are added, as observed
    while they were written.
    """
    with processed(recordings, identify, labels, transcribe, **options) as rows:
        if measured is None:
            store.append(rows, log, seq)
            return
        counted = Observation()
        store.append(rows.observe(counted, *live_metrics.totals()), log, seq)
        live_metrics.emit(recordings.sparkSession, measured, program, counted.get, seq)


def start_discovery(new_files: DataFrame, log: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Documents of new files into the log. trigger: as for DataStreamWriter.trigger.

    Documents are columns of the stream, so a micro-batch doesn't build them anew; only their ids are its own.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        store.append(batch.withColumn("uuid", text.random_uuid8()), log, batch_id)

    return discovered(new_files).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "1 second"})).start()


def start_processing(new_files: DataFrame, log: str, checkpoint: str, identify: inference.Backend, labels: list[str], transcribe: dict[str, inference.Backend], options: dict | None = None, **trigger) -> StreamingQuery:
    """Results of new files into the log: one write a micro-batch. A batch that runs again is merged by its number when read.

    options: those of process_batch() and processed(), such as all_english, drop_others (see inference.route), rate, decoders and measured.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        process_batch(batch, log, batch_id, identify, labels, transcribe, **(options or {}))

    return new_files.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "1 second"})).start()


# Claims: documents wait in a queue of claims, beside the log of their states. What comes together, a micro-batch or the
# documents that are pending when a worker starts, is numbered by age once and written as one folder a claim. A claim
# reads its own folder and looks for its own files, however long the log and however full the folders of recordings are;
# the numbers of its two versions follow from its place, so what a broken run has written is not done again.

#: Versions kept for the claims of one micro-batch: its number is shifted by so many bits.
SHIFT = 32
#: Claims that a worker has in hand at once, at most.
CLAIMS_AT_ONCE = 8


def enlisted(docs: DataFrame) -> DataFrame:
    """Documents as states of the claims' log; the file is that of the first dialog where a document has none itself."""
    if "dialog" in docs.columns:
        file = documents.first_dialog("filename")
        docs = docs.withColumn("filename", F.coalesce("filename", file) if "filename" in docs.columns else file)
    return docs.select(*(F.col(c) if c in docs.columns else F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in STATE.split(", "))))


def queued(docs: DataFrame, queue: str, source: int, rows: int = catalog.CLAIM_ROWS) -> None:
    """Write documents as claims of at most `rows`, the oldest first, those of one time in the order of a hash. A source that was written already stays."""
    spark, path = docs.sparkSession, f"{queue}/source={source}"
    if not files.exists(spark, f"{path}/_SUCCESS"):
        numbered = batching.fixed_batches(docs.withColumns({"__age": F.unix_micros("created_at"), "__all": F.lit(0)}), rows, "__age", "__all", "uuid")
        out = numbered.withColumnRenamed("batch_id", "claim").drop("__age", "__all")
        out.repartition("claim").write.mode("overwrite").partitionBy("claim").parquet(path)


def process_claim(spark: SparkSession, queue: str, source: int, number: int, *args, **options) -> bool:
    """Claim the documents of one folder of the queue and process them, as process_claims() does; False if that was done before."""
    return _process(spark, queue, source, [number], *args, **options) == 1


def process_claims(spark: SparkSession, queue: str, source: int, *args, **options) -> int:
    """All claims of a source that aren't done, in order, CLAIMS_AT_ONCE by the same jobs; how many were processed. Arguments: as for process_claim()."""
    numbers = files.numbers(spark, f"{queue}/source={source}", "claim")
    return sum(_process(spark, queue, source, numbers[i : i + CLAIMS_AT_ONCE], *args, **options) for i in range(0, len(numbers), CLAIMS_AT_ONCE))


def _process(spark: SparkSession, queue: str, source: int, numbers: list[int], log: str, owner: str, identify: inference.Backend, labels: list[str], transcribe: dict[str, inference.Backend], **options) -> int:
    """Claim the documents of some folders of the queue and process those whose file is there; how many folders were not done before.

    A claim is written as version source + 1 + 2 * number, its outcome as the next: done, and corrupt too where the
    file is missing or unreadable. A claim is small, and jobs cost much the same for one as for some.
    """
    claims = {n: source + 1 + 2 * n for n in numbers}
    claims = {n: seq for n, seq in claims.items() if not store.is_written(spark, log, seq + 1)}
    if not claims:
        return 0
    folder = f"{queue}/source={source}"
    docs = spark.read.schema(f"{STATE}, claim long").option("basePath", folder).parquet(*(f"{folder}/claim={n}" for n in claims))
    docs = docs.withColumn("seq", source + 1 + 2 * F.col("claim")).drop("claim")
    claimed = docs.withColumns({"processed_by": F.lit(owner), "claim_present": F.lit(True)})
    store.append_each(claimed, log, list(claims.values()))
    there = files.existing(spark, sorted({r["filename"] for r in docs.select("filename").collect() if r["filename"] is not None}))  # of these claims
    out = catalog.finish(claimed, F.lit(True)).withColumn("seq", F.col("seq") + 1)
    ends = [seq + 1 for seq in claims.values()]
    if not there:
        store.append_each(out.withColumn("corrupt", F.lit(True)).select(claimed.columns), log, ends)
        return len(claims)
    with processed(files.contents_of(spark, list(there.values())), identify, labels, transcribe, **options) as found:
        named = spark.createDataFrame(list(there.items()), "filename string, path string")
        told = found.select(F.col("filename").alias("path"), *(F.col(c).alias(f"__{c}") for c in ("duration", "language", "transcript", "corrupt"))).join(F.broadcast(named), "path").drop("path")
        out = out.join(told, "filename", "left")
        out = out.withColumns({c: F.col(f"__{c}") for c in ("duration", "language", "transcript")}).withColumn("corrupt", F.coalesce("__corrupt", F.lit(True)))
        store.append_each(out.select(claimed.columns), log, ends)
    return len(claims)


def new_states(spark: SparkSession, log: str, seq: int) -> DataFrame:
    """The states that were written under one number."""
    return spark.read.schema(STATE).parquet(f"{log}/seq={seq}")


def take_up(spark: SparkSession, queue: str, log: str, owner: str, *args, rows: int = catalog.CLAIM_ROWS, **options) -> None:
    """Finish the source that a broken run has left, then claim what else is pending in the log. The log is read once."""
    written = [n for n in files.numbers(spark, log, "seq") if store.is_written(spark, log, n)]
    if not written:
        return
    batches = [n for n in written if n > 0 and n % (1 << SHIFT) == 0]
    if batches:  # its documents may not have come to the queue
        queued(new_states(spark, log, batches[-1]), queue, batches[-1], rows)
    left = [n for n in files.numbers(spark, queue, "source") if files.exists(spark, f"{queue}/source={n}/_SUCCESS")]
    if left:
        process_claims(spark, queue, left[-1], log, owner, *args, **options)
    pending = catalog.pending(catalog.release(store.load_all(spark, log), owner))
    source = max(*files.numbers(spark, log, "seq"), *left, -1) + 1
    queued(pending.select(*(c.split()[0] for c in STATE.split(", "))), queue, source, rows)
    process_claims(spark, queue, source, log, owner, *args, **options)


def start_claims(new_files: DataFrame, log: str, queue: str, owner: str, checkpoint: str, identify: inference.Backend, labels: list[str], transcribe: dict[str, inference.Backend], rows: int = catalog.CLAIM_ROWS, options: dict | None = None, **trigger) -> StreamingQuery:
    """What is pending in the log of states is claimed and processed; then documents of new files join log and queue, and are claimed in each micro-batch.

    A micro-batch that runs again finds its documents in the queue and goes on with the claims that it has not finished.
    """
    args = (log, owner, identify, labels, transcribe)
    take_up(new_files.sparkSession, queue, *args, rows=rows, **(options or {}))

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark, source = batch.sparkSession, (batch_id + 1) << SHIFT
        store.append_once(enlisted(discovered(batch)), log, source)  # once, as their ids are random
        queued(new_states(spark, log, source), queue, source, rows)
        process_claims(spark, queue, source, *args, **(options or {}))

    return new_files.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "1 second"})).start()
