"""Operators as stages of a corpus pipeline: each takes (spark, docs, sf_dir) and gives the documents that stay, or the packed pieces.

Defined results of all of them: an empty table gives no rows. Rows are judged one by one, but where a stage drops by
doc_id, rows with equal ids go together: one text that is a copy or holds a leaked passage takes the others of its id
along. Rows without an id are never dropped by id. Columns besides doc_id and text pass unchanged, whatever their
names; n_chars alone is counted anew where lines are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmill.llm import decontam, line_dedup, near_dup, packing, toxicity
from talkmill.llm.queries import table, toxicity_scores, vocabulary
from talkmill.llm.shared import materialise

#: Pieces of a generation that packing remembers for a task: the workers of a pipeline have other stages' work to hold too.
MEMO_PIECES = 150_000


def _without(docs: DataFrame, ids: DataFrame, name: str) -> DataFrame:
    """docs without the rows of these ids. The ids are written first, so their size is known: Spark broadcasts few and shuffles many."""
    return docs.join(materialise(ids.distinct(), name), "doc_id", "left_anti").select(docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows scored below the threshold; null and empty texts are scored by the bias."""
    scored = toxicity_scores(spark, docs, sf_dir)
    return scored.where(F.col("score") < toxicity.THRESHOLD).select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with shared lines only in the smallest document that has them; n_chars is counted anew."""
    out = line_dedup.drop_shared_lines(docs)
    return (out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles of similarity 0.8 or more, the smallest document; null texts, texts without words and rows without an id stay."""
    return _without(docs, near_dup.components(docs, percent=80).where("not kept").select("doc_id"), "near-duplicates")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without any window of a benchmark item; null and empty texts stay. Whole documents go: what stands around a leaked passage gives it away too."""
    found = decontam.find_passages(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, found.where("n_hit > 0").select("doc_id"), "contaminated")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 ids, with the ids and their CRC-32; a null or empty text is its end id alone, repeated rows are packed once each."""
    pieces = packing.pack_documents(docs, vocabulary("word_bpe_49k.json"), end_id=1, memo_pieces=MEMO_PIECES)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "ids")
