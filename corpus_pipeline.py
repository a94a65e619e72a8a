"""A training corpus from raw documents: drop toxic texts, repeated lines, near copies and benchmark leaks, then pack ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from talkmill.llm import stages
from talkmill.llm.shared import new_path

#: In order; each stage reads what the one before it wrote.
STAGES = [
    ("toxicity", stages.drop_toxic),
    ("line_dedup", stages.drop_repeated_lines),
    ("near_dup", stages.drop_near_duplicates),
    ("decontamination", stages.drop_contaminated),
    ("packing", stages.pack),
]

#: SQL expresses neither learning nor tokenising; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of sf_dir, each written as Parquet and read again.

    What stages make of nulls, empty texts and repeated rows is said in talkmill.llm.stages; no documents give no rows.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
