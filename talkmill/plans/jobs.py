"""User-level jobs: discovery, reconciliation, cleanup plans and processing, as batch runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmill.functions import documents
from talkmill.operators import inference, reconcile
from talkmill.sources import files, store
from talkmill.streaming import process


def job_discover(spark: SparkSession, root: str, cat: DataFrame) -> DataFrame:
    """Files below root with the action for each; documents of the added ones come from documents.new_documents."""
    found = files.inventory(spark, root).select("basename", F.col("path").alias("local_path"), F.col("length").alias("size_bytes"))
    return reconcile.discovery(found, cat)


def job_reconcile(listing: DataFrame, cat: DataFrame, local: DataFrame, transfers: DataFrame) -> dict[str, DataFrame]:
    """All plans of a reconciliation: actions and outcomes, transfers, deletions, file names to set, documents to add."""
    planned = reconcile.actions(listing, cat, local)
    return {
        "outcomes": reconcile.outcomes(planned, transfers),
        "transfer": planned.where("transfer").select("object_key", "local_path"),
        "delete": planned.where("delete_local").select("local_path"),
        "update": planned.where("update_filename").select("basename", F.col("local_path").alias("filename")),
        "create": documents.new_documents(reconcile.created(planned, transfers).select(F.col("local_path").alias("filename"), "size_bytes")),
    }


def job_cleanup_plan(spark: SparkSession, root: str, cat: DataFrame) -> DataFrame:
    """Files below root without a complete document; they are listed, not deleted."""
    found = files.inventory(spark, root, audio_only=False).select("basename", F.col("path").alias("local_path"), F.col("length").alias("local_size"))
    return reconcile.orphans(found, cat)


def job_process(spark: SparkSession, root: str, log: str, identify: inference.Backend, labels: list[str], transcribe: dict[str, inference.Backend], seq: int = 0, extensions: tuple[str, ...] = ("wav",), **options) -> DataFrame:
    """Process all files below root with one of the extensions into the log; the catalog's state after it.

    options: as for process.process_batch(); other media than WAV need decoders.
    """
    process.process_batch(files.contents(spark, root, extensions), log, seq, identify, labels, transcribe, **options)
    return store.load_all(spark, log, "basename")
