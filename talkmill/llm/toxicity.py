"""Toxicity scores: FTRL-proximal logistic regression over hashed words, word pairs and skip-pairs.

Features of a bounded sample of labelled rows are made where the rows are; one task learns from them with
per-coordinate rates and L1 sparsity. What remains is a short table of (coordinate, weight), at most 2^BITS rows,
that goes to every task; scoring reads each text once and shuffles nothing.

Defined results: null and empty texts have the score of the bias alone. Labels other than 0 and 1 are left out, and
of several labels of a document the largest counts. Without labelled rows every score is 0. Repeated rows are scored
one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkmill.llm.kernels import ALPHANUMERIC, Block, blocks, mix, span_hashes, spans
from talkmill.llm.shared import in_small_batches

BITS = 20
#: Bytes of the beginnings that stand for inflected forms of a word.
STEMS = (4, 5)
#: Labelled rows that a fit uses at most, chosen by the hash of their ids; the bound of the sample.
SAMPLE_ROWS = 12_000
PASSES = 3
ALPHA, BETA, L1, L2 = 0.3, 1.0, 3.0, 1.0
THRESHOLD = 0.3

_U = np.uint64


def features(block: Block, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates of all words, their beginnings, neighbouring pairs and pairs with one word between, and their texts (both with repeats)."""
    found = spans(block, ALPHANUMERIC)
    words = span_hashes(block, found.start, found.end, fold=True)
    ids, texts = [words], [found.text]
    with np.errstate(over="ignore"):
        for n in STEMS:
            long = np.flatnonzero(found.end - found.start > n)
            ids.append(mix(span_hashes(block, found.start[long], found.start[long] + n, fold=True) + _U(n)))
            texts.append(found.text[long])
        for gap, salt in ((1, 0x2545F4914F6CDD1D), (2, 0x9E3779B97F4A7C15)):
            a, b = words[:-gap], words[gap:]
            same = found.text[:-gap] == found.text[gap:]
            ids.append(mix(a * _U(salt) + b)[same])
            texts.append(found.text[:-gap][same])
    return (np.concatenate(ids) >> _U(64 - bits)).astype(np.int64), np.concatenate(texts)


def distinct(ids: np.ndarray, texts: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Each coordinate once for each text, in the order of texts."""
    pairs = np.unique(texts << bits | ids)
    return pairs & ((1 << bits) - 1), pairs >> bits


def ftrl(examples: list[np.ndarray], labels: np.ndarray, bits: int = BITS, passes: int = PASSES, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> np.ndarray:
    """Weights of all coordinates and, last, the bias. examples: the coordinates of each."""
    bias = 1 << bits
    z, n = np.zeros(bias + 1), np.zeros(bias + 1)
    for _ in range(passes):
        for own, y in zip(examples, labels, strict=True):
            at = np.append(own, bias)
            zi, root = z[at], np.sqrt(n[at])
            w = np.where(np.abs(zi) > l1, (np.sign(zi) * l1 - zi) / ((beta + root) / alpha + l2), 0.0)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            z[at] += g - (np.sqrt(n[at] + g * g) - root) / alpha * w
            n[at] += g * g
    return np.where(np.abs(z) > l1, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2), 0.0)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text") -> pd.DataFrame:
    """The weights: coordinate (2^bits: bias) and weight. Learns from rows of docs that labels (id_col, label_col) has, and nothing else."""
    given = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y"))
    order = F.xxhash64("id")
    sample = F.broadcast(given.orderBy(order, "id").limit(sample_rows))  # at most sample_rows ids
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(sample, "id").select("y", order.alias("o"), F.xxhash64("text").alias("tie"), "text")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                ids, texts = distinct(*features(block, bits), bits)
                own = np.split(ids.astype(np.int32), np.searchsorted(texts, np.arange(1, block.n)))
                yield pa.RecordBatch.from_arrays([*batch.slice(block.rows.start, block.n).columns[:3], pa.array([x.tobytes() for x in own], pa.binary())], names=["y", "o", "tie", "ids"])

    def learn(table: pa.Table) -> pa.Table:
        order = pc.sort_indices(table, sort_keys=[("o", "ascending"), ("tie", "ascending")])
        ids = table.column("ids")  # used where it is: a sorted copy would double the sample
        w = ftrl([np.frombuffer(ids[i].as_buffer(), np.int32) for i in order.to_pylist()], table.column("y").take(order).to_numpy(), bits)
        at = np.flatnonzero(w)
        return pa.table({"coordinate": at, "weight": w[at]})

    examples = in_small_batches(rows).mapInArrow(extract, "y int, o long, tie long, ids binary")
    # One learner: it goes through the bounded sample in order, and several averaged ones did worse on held-out rows.
    learnt = examples.withColumn("g", F.lit(0)).groupBy("g").applyInArrow(learn, "coordinate long, weight double")
    return learnt.toPandas()  # at most 2^bits + 1 rows, few because of L1


def score(docs: DataFrame, weights: pd.DataFrame, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with a column score from 0 to 1 (replaced if there)."""
    at, values = weights["coordinate"].to_numpy(np.int64), weights["weight"].to_numpy(np.float64)
    slim = docs.drop("score")
    if not len(at):
        return slim.withColumn("score", F.lit(0.0))
    schema = T.StructType([*slim.schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((1 << bits) + 1)
        table[at] = values
        for batch in batches:
            sums = []
            for block in blocks(batch, text_col):
                ids, texts = features(block, bits)
                some = np.flatnonzero(table[ids])
                ids, texts = distinct(ids[some], texts[some], bits)
                sums.append(np.bincount(texts, weights=table[ids], minlength=block.n))
            total = np.concatenate([*sums, np.zeros(0)]) + table[1 << bits]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))], names=[*batch.schema.names, "score"])

    return in_small_batches(slim).mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    """Rows never learnt from: a quarter by CRC-32 of the id as text."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2
