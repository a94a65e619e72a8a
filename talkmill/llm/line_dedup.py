"""Drop lines that several documents share, keeping each in the smallest document that holds it.

Lines are exploded and hashed (128 bits), documents are counted for each hash, and the positions that go are
joined to the texts, which are shuffled once. DataFrame functions only.

Defined results: a null text is an empty one (one empty line). Rows with equal doc_id are one document when
documents are counted; each keeps or loses its own lines. Rows with a null doc_id count for nothing and keep all
lines. Input columns named like an added one are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkmill.llm.shared import BLANKS, ascii_lower, materialise

MIN_CHARS, MIN_DOCS = 10, 2


def line_key(line):
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def line_occurrences(docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each line whose key is long enough: doc, text hash, position, and both halves of the key's hash."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("th"), F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
    keyed = lines.select("doc", "th", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    return keyed.select("doc", "th", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(0x5EED), "key").alias("h2"))


def shared_keys(occurrences: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Key hashes held by at least min_docs distinct documents, with the smallest of them."""
    if min_docs <= 2:  # two distinct documents: the smallest is not the largest
        found = occurrences.groupBy("h1", "h2").agg(F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc"))
        return found.where((F.col("first_doc") != F.col("last_doc")) | F.lit(min_docs < 2)).drop("last_doc")
    pairs = occurrences.groupBy("h1", "h2", "doc").agg(F.lit(1).alias("one"))
    return pairs.groupBy("h1", "h2").agg(F.min("doc").alias("first_doc"), F.count("*").alias("n")).where(F.col("n") >= min_docs).drop("n")


def drop_shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with text_col replaced by the lines that stay, and n_lines (before) and n_dropped."""
    seen = materialise(line_occurrences(docs, min_chars, id_col, text_col), "lines")
    # The keys are written first: both sides of the join are then plain, and Spark can split a very common line's rows.
    keys = materialise(shared_keys(seen, min_docs), "shared-lines")
    gone = seen.join(keys, ["h1", "h2"]).where(F.col("doc") != F.col("first_doc"))
    gone = gone.groupBy("doc", "th").agg(F.collect_set("pos").alias("__gone")).withColumnsRenamed({"doc": "__doc", "th": "__th"})
    text = F.coalesce(F.col(text_col), F.lit(""))
    both = docs.withColumn("__hash", F.xxhash64(text)).join(gone, (F.col(id_col) == F.col("__doc")) & (F.col("__hash") == F.col("__th")), "left")
    lines = F.split(text, "\n", -1)
    stays = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__gone")))
    kept = F.when(F.col("__gone").isNull(), text).otherwise(F.array_join(F.transform(stays, lambda i: F.get(lines, i)), "\n"))
    return both.withColumns({text_col: kept, "n_lines": F.size(lines).cast("long"), "n_dropped": F.coalesce(F.size("__gone"), F.lit(0)).cast("long")}).drop("__hash", "__doc", "__th", "__gone")
