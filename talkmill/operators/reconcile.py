"""Compare object listings, the catalog and local files, and plan what is to be done. Nothing is moved or deleted here."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkmill.operators import catalog


def statuses(listing: DataFrame, cat: DataFrame, order: str = "created_at", filename: str = "filename") -> DataFrame:
    """listing (basename, local_path, ...) with ex, done, corrupt, filename and fix of the last document of the basename.

    A basename repeated in the listing keeps each of its rows; fix compares the stored name with the row's path.
    """
    known = catalog.first_of(cat, order, last=True).select("basename", F.lit(True).alias("ex"), F.coalesce("done", F.lit(False)).alias("done"), F.coalesce("corrupt", F.lit(False)).alias("corrupt"), F.col(filename).alias("filename"))
    out = listing.join(known, "basename", "left").withColumn("ex", F.coalesce("ex", F.lit(False)))
    return out.withColumn("fix", F.col("ex") & ~F.col("filename").eqNullSafe(F.col("local_path")))


def with_local(listing: DataFrame, local: DataFrame) -> DataFrame:
    """listing with lex (the file is there), lsize (0 without it) and differs (a listed size that isn't the local one)."""
    own = local.select("local_path", F.lit(True).alias("lex"), F.col("local_size").alias("lsize"))
    out = listing.join(own, "local_path", "left").withColumns({"lex": F.coalesce("lex", F.lit(False)), "lsize": F.coalesce("lsize", F.lit(0))})
    return out.withColumn("differs", F.col("lex") & (F.col("size_bytes") > 0) & (F.col("lsize") != F.col("size_bytes")))


def actions(listing: DataFrame, cat: DataFrame, local: DataFrame, order: str = "created_at") -> DataFrame:
    """basename, action and the plans' flags for each listed object."""
    row = with_local(statuses(listing, cat, order), local)
    ex, fix, lex = F.col("ex"), F.col("fix"), F.col("lex")
    complete = ex & F.col("done") & ~F.col("corrupt")
    stale = ~lex | F.col("differs")

    def either(with_fix: str, without: str):
        return F.when(fix, F.lit(with_fix)).otherwise(F.lit(without))

    action = (
        F.when(complete & lex, either("fixed_filename_and_deleted", "delete_local"))
        .when(complete, either("fixed_filename", "already_processed"))
        .when(ex & F.col("corrupt"), either("fix_corrupt_and_filename", "fix_corrupt"))
        .when(ex & stale, either("fixed_filename_and_download", "download_existing"))
        .when(ex, either("fixed_filename", "exists_correct_size"))
        .when(stale | (F.col("lsize") == 0), F.lit("download_and_create"))
        .otherwise(F.lit("create_vcon_only"))
    )
    out = row.withColumn("action", action)
    return out.withColumns({
        "update_filename": fix,
        "transfer": F.col("action").isin("fix_corrupt", "fix_corrupt_and_filename", "download_existing", "fixed_filename_and_download", "download_and_create"),
        "create": F.col("action").isin("download_and_create", "create_vcon_only"),
        "delete_local": F.col("action").isin("delete_local", "fixed_filename_and_deleted"),
    })


# What is reported for an action, and for one with a transfer whether that worked.
OUTCOMES = {
    "delete_local": "DELETED",
    "fixed_filename": "FIXED_FILENAME",
    "fixed_filename_and_deleted": "FIXED_FILENAME_AND_DELETED",
    "already_processed": "ALREADY_PROCESSED",
    "exists_correct_size": "EXISTS",
    "create_vcon_only": "VCON_CREATED",
    "create_vcon_failed": "VCON_FAILED",
}
TRANSFER_OUTCOMES = {
    "fixed_filename_and_download": ("FIXED_FILENAME_AND_DOWNLOADED", "FIXED_FILENAME_DOWNLOAD_FAILED"),
    "fix_corrupt": ("FIXED", "FIX_FAILED"),
    "fix_corrupt_and_filename": ("FIXED_CORRUPT_AND_FILENAME", "FIX_CORRUPT_AND_FILENAME_FAILED"),
    "download_existing": ("DOWNLOADED", "DOWNLOAD_FAILED"),
    "download_and_create": ("CREATED", "CREATE_FAILED"),
}


def outcomes(planned: DataFrame, transfers: DataFrame) -> DataFrame:
    """planned (basename, action) with outcome. transfers: basename, local_size; more than 0 bytes are a success."""
    done = transfers.groupBy("basename").agg(F.max("local_size").alias("__size"))
    ok = F.coalesce(F.col("__size") > 0, F.lit(False))
    label = F.when(F.startswith("action", F.lit("error_")), F.lit("ERROR"))
    for action, name in OUTCOMES.items():
        label = label.when(F.col("action") == action, F.lit(name))
    for action, (good, bad) in TRANSFER_OUTCOMES.items():
        label = label.when(F.col("action") == action, F.when(ok, F.lit(good)).otherwise(F.lit(bad)))
    return planned.join(done, "basename", "left").withColumn("outcome", label.otherwise(F.lit("UNKNOWN"))).drop("__size")


def created(planned: DataFrame, transfers: DataFrame) -> DataFrame:
    """Rows to make documents of: those ready, and those whose transfer worked."""
    ready = planned.where(F.col("action") == "create_vcon_only")
    good = transfers.where("local_size > 0").select("basename").distinct()
    return ready.unionByName(planned.where(F.col("action") == "download_and_create").join(good, "basename", "left_semi").select(planned.columns))


def discovery(files: DataFrame, cat: DataFrame) -> DataFrame:
    """files (basename, local_path) with action: deleted (its document is done), skipped (open), or added.

    Of several new files of a basename the smallest path is added, the others are skipped.
    """
    known = catalog.first_of(cat).select("basename", F.coalesce("done", F.lit(False)).alias("__done"))
    first = files.groupBy("basename").agg(F.min("local_path").alias("__first"))
    row = files.join(known, "basename", "left").join(first, "basename")
    action = F.when(F.col("__done"), F.lit("deleted")).when(F.col("__done").isNotNull() | (F.col("local_path") != F.col("__first")), F.lit("skipped")).otherwise(F.lit("added"))
    return row.withColumn("action", action).drop("__done", "__first")


def orphans(files: DataFrame, cat: DataFrame, order: str = "created_at") -> DataFrame:
    """Files whose basename's first document isn't complete, or that have none."""
    complete = catalog.first_of(cat, order).where(catalog.is_complete()).select("basename")
    return files.join(complete, "basename", "left_anti")


def finished_files(files: DataFrame, cat: DataFrame) -> DataFrame:
    """Files of documents that are done, with deletable: names that are URLs are not."""
    done = cat.where(catalog.is_done()).select("basename").distinct()
    return files.join(done, "basename", "left_semi").withColumn("deletable", ~F.col("local_path").contains("://"))


def cleanup_summary(files: DataFrame, cat: DataFrame, order: str = "created_at") -> DataFrame:
    """One row: files scanned, to delete, bytes and megabytes freed. One pass over the files."""
    complete = catalog.first_of(cat, order).where(catalog.is_complete()).select("basename", F.lit(True).alias("__keep"))
    orphan = F.col("__keep").isNull()
    out = files.join(complete, "basename", "left").agg(F.count("*").alias("files_scanned"), F.count_if(orphan).alias("files_deleted"), F.coalesce(F.sum(F.when(orphan, F.col("local_size"))), F.lit(0)).alias("bytes_freed"))
    return out.withColumn("mb_freed", F.col("bytes_freed") / F.lit(1048576.0))
