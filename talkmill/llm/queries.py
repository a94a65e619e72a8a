"""The registered queries of the training-data operators: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmill.llm import conversation_repair, decontam, fertility, fill_middle, language_id, license_scan, line_dedup, near_dup, packing, pii, token_store, toxicity, url_filter
from talkmill.llm.shared import new_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file on this machine; executors have it at the same place."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.judge(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_shared_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_private(table(spark, sf_dir, "documents"))
    counts = [pii.count_of(F.col("base"), k).alias(f"n_{k}") for k in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(pii.written(F.col("base")).cast("binary"), 256).alias("base_sha256"), pii.written(F.col("spans")).alias("spans"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, url_filter.rules_table(spark)).select("page_id", "host", "path", "rule", "verdict")


def op3_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.components(table(spark, sf_dir, "documents"), percent=85)


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-store")
    token_store.build_store(table(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"), end_id=0)
    return token_store.read_documents(spark, path)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_matches", F.array_join("licenses", ",").alias("licenses"), "license", F.round("dice", 6).alias("dice"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def toxicity_scores(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with a score learnt from labelled rows that aren't held out."""
    every, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.score(docs, toxicity.fit(every, labels.where(~toxicity.held_out())))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity_scores(spark, table(spark, sf_dir, "documents").select("doc_id", "text"), sf_dir)
    return scored.select("doc_id", F.coalesce(toxicity.held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op10_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_items, joined = F.size("items").cast("long"), F.array_join("items", ",").cast("binary")
    return found.select("doc_id", "n_words", "n_hit", n_items.alias("n_items"), F.sha2(joined, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    summary, rows = conversation_repair.repair(conversation_repair.damage(given))
    conv = F.struct("conv_id").alias("conv")  # as one value, so that a null id meets itself
    found = given.select(conv).distinct().join(summary.withColumn("conv", conv).drop("conv_id"), "conv", "left")
    found = found.join(conversation_repair.digests(rows).select(conv, "sha256"), "conv", "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select("conv.conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), F.coalesce(toxicity.held_out(), F.lit(False))
    found = language_id.identify(docs.select("doc_id", "text"), docs.where(~held).select("doc_id", "text", "lang"))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "entropy", "accepted")


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_middle.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    output, text = F.col("output"), fill_middle.restored(F.col("output"), F.col("form"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *(F.sha2(c.cast("binary"), 256).alias(n) for c, n in ((output, "output_sha256"), (text, "restored_sha256"))))


QUERIES = {
    "op1_fertility": op1_fertility,
    "op2_line_dedup": op2_line_dedup,
    "op3_near_dup": op3_near_dup,
    "op4_token_store": op4_token_store,
    "op5_pii": op5_pii,
    "op6_url_filter": op6_url_filter,
    "op7_license_scan": op7_license_scan,
    "op8_packing": op8_packing,
    "op9_toxicity": op9_toxicity,
    "op10_decontam": op10_decontam,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_language_id": op12_language_id,
    "op13_fill_middle": op13_fill_middle,
}
