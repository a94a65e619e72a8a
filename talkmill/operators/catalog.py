"""The catalog of conversations: predicates, claims, updates and look-ups.

A catalog is a DataFrame with uuid, basename, filename, done, corrupt, processed_by, claim_present (a claim may be
present and null) and an order column (created_at by default, here `order`). Changes give a new DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Documents claimed at once, and the rows up to which a claim's candidates are broadcast.
CLAIM_ROWS = 512


def is_done() -> Column:
    return F.col("done").eqNullSafe(True)


def is_corrupt() -> Column:
    return F.col("corrupt").eqNullSafe(True)


def is_unclaimed() -> Column:
    """No claim at all. A claim that was set to null is still one."""
    return ~F.coalesce(F.col("claim_present"), F.lit(False))


def is_pending() -> Column:
    return ~is_done() & is_unclaimed() & ~is_corrupt()


def is_complete() -> Column:
    return is_done() & ~is_corrupt()


def flags(cat: DataFrame) -> DataFrame:
    """uuid with the flags' defaults: a missing flag is false."""
    return cat.select("uuid", F.coalesce("done", F.lit(False)).alias("done"), F.coalesce("corrupt", F.lit(False)).alias("corrupt"), "processed_by")


def pending(cat: DataFrame) -> DataFrame:
    return cat.where(is_pending())


def mark_done(cat: DataFrame, condition: Column | None = None) -> DataFrame:
    return cat.withColumn("done", F.lit(True) if condition is None else F.when(condition, F.lit(True)).otherwise(F.col("done")))


def mark_invalid(cat: DataFrame, bad: DataFrame) -> DataFrame:
    """Documents whose uuid bad has become corrupt and done; their claim stays."""
    hit = F.col("__bad").isNotNull()
    joined = cat.join(bad.select("uuid", F.lit(True).alias("__bad")).distinct(), "uuid", "left")
    return joined.withColumns({"corrupt": F.when(hit, F.lit(True)).otherwise(F.col("corrupt")), "done": F.when(hit, F.lit(True)).otherwise(F.col("done"))}).select(cat.columns)


# Claims


def candidates(cat: DataFrame, order: str = "created_at", rows: int = CLAIM_ROWS, byte_budget: int | None = None) -> DataFrame:
    """uuid of the oldest pending documents: a top-k, not a sort. With a budget, only while their sizes add up to it."""
    first = pending(cat).orderBy(order, "uuid").limit(rows)
    if byte_budget is not None:  # over at most `rows` rows
        first = first.withColumn("__sum", F.sum(F.coalesce("size_bytes", F.lit(0))).over(Window.orderBy(order, "uuid").rowsBetween(Window.unboundedPreceding, 0))).where(F.col("__sum") <= byte_budget)
    return first.select("uuid")


def within_budget(cat: DataFrame, byte_budget: int, order: str = "created_at", rows: int = CLAIM_ROWS) -> DataFrame:
    return candidates(cat, order, rows, byte_budget)


def oldest_open(cat: DataFrame, order: str = "created_at") -> DataFrame:
    """The one oldest document that isn't done, whatever else is known of it (the single claim's filter)."""
    return cat.where(~is_done()).orderBy(order, "uuid").limit(1).select("uuid")


def claim(cat: DataFrame, chosen: DataFrame, owner: str, only_unclaimed: bool = True) -> DataFrame:
    """The catalog with the owner set where a uuid is among the chosen (a bounded list) and unclaimed."""
    marked = cat.join(F.broadcast(chosen.select("uuid", F.lit(True).alias("__chosen"))), "uuid", "left")
    take = F.col("__chosen").isNotNull() & (is_unclaimed() if only_unclaimed else F.lit(True))
    return marked.withColumns({"processed_by": F.when(take, F.lit(owner)).otherwise(F.col("processed_by")), "claim_present": F.when(take, F.lit(True)).otherwise(F.col("claim_present"))}).select(cat.columns)


def release(cat: DataFrame, owner: str) -> DataFrame:
    """Open documents of an owner lose their claim."""
    mine = (F.col("processed_by") == owner) & ~is_done()
    return cat.withColumns({"claim_present": F.when(mine, F.lit(False)).otherwise(F.col("claim_present")), "processed_by": F.when(mine, F.lit(None)).otherwise(F.col("processed_by"))})


def finish(cat: DataFrame, condition: Column) -> DataFrame:
    """Done, with the claim set to null but still present."""
    return cat.withColumns({"done": F.when(condition, F.lit(True)).otherwise(F.col("done")), "claim_present": F.when(condition, F.lit(True)).otherwise(F.col("claim_present")), "processed_by": F.when(condition, F.lit(None)).otherwise(F.col("processed_by"))})


def reopen(cat: DataFrame, transferred: DataFrame, clear_claim: bool = False) -> DataFrame:
    """Corrupt documents that were transferred again (basename, filename) are open and get that file name.

    Their claim stays, so they can't be claimed again unless it is cleared.
    """
    new = transferred.select("basename", F.col("filename").alias("__file")).groupBy("basename").agg(F.max("__file").alias("__file"))
    hit = F.col("__file").isNotNull() & is_corrupt()
    out = cat.join(new, "basename", "left").withColumns({"filename": F.when(hit, F.col("__file")).otherwise(F.col("filename")), "done": F.when(hit, F.lit(False)).otherwise(F.col("done")), "__hit": hit})
    out = out.withColumn("corrupt", F.when(F.col("__hit"), F.lit(False)).otherwise(F.col("corrupt")))
    if clear_claim:
        out = out.withColumn("claim_present", F.when(F.col("__hit"), F.lit(False)).otherwise(F.col("claim_present")))
    return out.select(cat.columns)


def changes(before: DataFrame, after: DataFrame, columns: list[str]) -> DataFrame:
    """One row: how many documents were modified, and how many deleted."""
    old = before.select("uuid", F.struct(*columns).alias("__old"))
    new = after.select("uuid", F.struct(*columns).alias("__new"), F.lit(True).alias("__there"))
    both = old.join(new, "uuid", "left")
    return both.agg(F.count_if(F.col("__there") & ~F.col("__old").eqNullSafe(F.col("__new"))).alias("modified"), F.count_if(F.col("__there").isNull()).alias("deleted"))


# Writing


def latest(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The last row of each key by the given columns. An aggregate, so a frequent key is combined before the shuffle."""
    best = F.max_by(F.struct(*rows.columns), F.struct(*order))
    return rows.groupBy(F.col(key).alias("__key")).agg(best.alias("r")).select("r.*")


def upsert(cat: DataFrame, incoming: DataFrame, key: str = "uuid", order: str = "seq") -> DataFrame:
    """Incoming documents replace those of their key or are added; of several for a key the last by `order` counts."""
    columns = cat.columns
    old = cat.withColumns({"__v": F.lit(0), "__o": F.lit(None).cast("long")})
    new = incoming.withColumns({"__v": F.lit(1), "__o": F.col(order).cast("long")})
    return latest(old.unionByName(new.select(*[c for c in incoming.columns if c in columns], "__v", "__o"), allowMissingColumns=True), key, "__v", "__o").select(columns)


def set_fields(cat: DataFrame, updates: DataFrame, fields: list[str], order: str = "created_at", which: str = "first") -> DataFrame:
    """Fields set by basename, in the first document of it by (order, uuid), or in all."""
    new = updates.groupBy("basename").agg(*(F.max(f).alias(f"__{f}") for f in fields), F.lit(True).alias("__hit"))
    out = cat.join(new, "basename", "left")
    hit = F.col("__hit").isNotNull()
    if which == "first":
        heads = cat.where(F.col("basename").isNotNull()).groupBy("basename").agg(F.min_by("uuid", F.struct(order, "uuid")).alias("__head"))
        out = out.join(heads, "basename", "left")
        hit = hit & (F.col("uuid") == F.col("__head"))
    return out.withColumns({f: F.when(hit, F.coalesce(F.col(f"__{f}"), F.col(f))).otherwise(F.col(f)) for f in fields}).select(cat.columns)


def insert(cat: DataFrame, incoming: DataFrame) -> DataFrame:
    return cat.unionByName(incoming, allowMissingColumns=True)


# Look-ups. All are equi-joins; Spark broadcasts a side by its size.


def first_of(cat: DataFrame, order: str = "created_at", last: bool = False) -> DataFrame:
    """The first (or last) document of each basename by (order, uuid)."""
    by = F.struct(order, "uuid")
    pick = (F.max_by if last else F.min_by)(F.struct(*cat.columns), by)
    return cat.where(F.col("basename").isNotNull()).groupBy(F.col("basename").alias("__key")).agg(pick.alias("r")).select("r.*")


def by_basename(cat: DataFrame, wanted: DataFrame, order: str = "created_at") -> DataFrame:
    """wanted (basename) with the first document of it, or nulls."""
    return wanted.join(first_of(cat, order), "basename", "left")


def all_by_basename(cat: DataFrame, wanted: DataFrame) -> DataFrame:
    return wanted.join(cat, "basename")


def exists(cat: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted (basename) with whether the catalog has it."""
    known = cat.where(F.col("basename").isNotNull()).select("basename", F.lit(True).alias("found")).distinct()
    return wanted.select("basename").distinct().join(known, "basename", "left").withColumn("found", F.coalesce("found", F.lit(False)))


def absent(cat: DataFrame, incoming: DataFrame, dedupe: bool = False) -> DataFrame:
    """Incoming documents with a basename that the catalog doesn't have. Repeats among them stay unless dedupe."""
    new = incoming.where(F.col("basename").isNotNull()).join(cat.select("basename"), "basename", "left_anti").select(incoming.columns)
    return latest(new, "basename", "uuid") if dedupe else new


def inaccessible(claimed: DataFrame, inventory: DataFrame) -> DataFrame:
    """Claimed documents without their file in the inventory (local_path)."""
    return claimed.join(inventory.select("local_path"), claimed["filename"] == inventory["local_path"], "left_anti")


def duplicates(cat: DataFrame) -> DataFrame:
    return cat.groupBy("basename").agg(F.count("*").alias("n")).where("n > 1")


# Reports


def statistics(cat: DataFrame, codes: Column) -> DataFrame:
    """Counts and percentages of the whole catalog in one pass. codes: each document's language codes."""
    counts = cat.agg(F.count("*").alias("total"), F.count_if(F.col("done")).alias("done"), F.count_if(F.col("corrupt")).alias("corrupt"), F.count_if(F.array_contains(codes, "en")).alias("english"), F.count_if(F.array_contains(codes, "es")).alias("spanish"))

    def pct(a: str, b: str) -> Column:
        return (F.try_divide(a, b) * 100).alias(f"{a}_pct")

    return counts.select("*", pct("corrupt", "done"), F.try_divide("done", "total").alias("r")).select("total", "done", "corrupt", "english", "spanish", "corrupt_pct", (F.col("r") * 100).alias("done_pct"), pct("english", "done"), pct("spanish", "done"))


def total_bytes(rows: DataFrame, column: str = "size_bytes") -> DataFrame:
    return rows.agg(F.coalesce(F.sum(F.coalesce(F.col(column), F.lit(0))), F.lit(0)).alias("total_bytes"))


def count_elements(cat: DataFrame, kind: str, code: str) -> DataFrame:
    """Documents with an analysis (type, languages as a list) of a type that holds a language."""
    return cat.agg(F.count_if(F.exists("analysis", lambda a: (a["type"] == kind) & F.coalesce(F.array_contains(a["languages"], code), F.lit(False)))).alias("n"))
