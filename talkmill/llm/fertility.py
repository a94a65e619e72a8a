"""Quality rules from tokeniser fertility, beside plain word and line rules.

Each text is encoded with a public vocabulary that falls back to bytes. Characters per token, the share of byte
tokens and the entropy of the text's tokens must lie in the band of the text's language, or else of its script.
Base rules come first: too few words, or too many words in repeated three-word windows.

Bands are fitted: of the texts that pass the base rules, those of one band and one size (tokens between two powers of
two; short texts vary more and have less entropy) give quartiles, and limits lie some spreads (quartile distances)
beyond them. Texts of equal counts are one there, so that copies don't narrow a band. A size of fewer than MIN_FIT
texts takes its lower limits from the next smaller size that has more, its upper ones from the next larger. The stated
wide bands hold besides, and alone where nothing can be fitted.

Defined results: a null or empty text has no words and fails the base rules; its characters per token, share and
entropy are 0. A language that is null or has no band takes the band of the text's script (of most of its letters).
Repeated rows are judged one by one; an empty table gives an empty result. Other input columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkmill.llm.kernels import NOT_BLANK, Block, blocks, byte_class, ngram_hashes, span_hashes, spans
from talkmill.llm.memo_tokens import encoder
from talkmill.llm.shared import in_small_batches, materialise

MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WORDS = 50, 50, 3
#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Band:
    """Limits, all inclusive: characters per token, share of byte tokens, and bits of entropy of the tokens."""

    min_chars: float
    max_chars: float
    max_bytes: float
    min_entropy: float
    max_entropy: float


#: Texts of a band and size from which quartiles are taken.
MIN_FIT = 50
#: Spreads below the lower and above the upper quartile at which limits lie: the junk to find takes more tokens and has less entropy.
LOW_CHARS, LOW_ENTROPY, HIGH, HIGH_BYTES = 2.0, 1.5, 3.0, 4.0
#: Least spreads: a share of the median of characters per token, a share of byte tokens, and bits.
LEAST_CHARS, LEAST_BYTES, LEAST_ENTROPY = 0.01, 0.005, 0.2
#: Steps to which statistics are rounded before quartiles, so that a group has a bounded number of values.
STEPS = {"chars_per_token": 512, "byte_share": 4096, "entropy": 256}

#: Wide bands of languages, and of scripts for all others. English words take fewer tokens than others'; texts
#: of a script outside the vocabulary fall back to bytes. Entropies are of texts of 50 words or more.
LANGUAGES = {"en": Band(1.8, 6.0, 0.05, 3.5, 14.0), "de": Band(1.5, 6.0, 0.05, 3.5, 14.0), "fr": Band(1.5, 6.0, 0.05, 3.5, 14.0), "es": Band(1.5, 6.0, 0.05, 3.5, 14.0)}
SCRIPTS = {"latin": Band(1.3, 7.0, 0.10, 3.0, 14.0), "cyrillic": Band(1.0, 5.0, 0.20, 3.0, 14.0), "cjk": Band(0.3, 2.5, 0.70, 3.0, 14.0), "other": Band(0.25, 6.0, 0.95, 3.0, 14.0)}

_LEAD = byte_class((0x00, 0x7F), (0xC0, 0xFF))  # first bytes of characters


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values between successive bounds."""
    total = np.concatenate((np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)))
    return total[bounds[1:]] - total[bounds[:-1]]


def _repeats(hashes: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item, whether its hash occurs twice or more in its text, and whether it isn't the first there."""
    order = np.lexsort((np.arange(len(hashes)), hashes, texts))
    same = (hashes[order][1:] == hashes[order][:-1]) & (texts[order][1:] == texts[order][:-1])
    again, twice = np.zeros(len(hashes), bool), np.zeros(len(hashes), bool)
    again[order[1:]] = same
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    return twice, again


def base_counts(block: Block, k: int = REPEAT_WORDS) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    found = spans(block, NOT_BLANK)
    n_words = np.diff(found.bounds)
    chars = _sums(NOT_BLANK[block.data] & _LEAD[block.data], block.offsets)
    wanted = np.zeros(256, bool)
    wanted[list(SYMBOLS.encode())] = True
    symbols = _sums(wanted[block.data], block.offsets)
    line = spans(block, ~byte_class((0x0A, 0x0A)))
    blank = np.concatenate((np.zeros(1, np.int64), np.cumsum(NOT_BLANK[block.data])))
    full = np.flatnonzero(blank[line.end] > blank[line.start])
    _, again = _repeats(span_hashes(block, line.start[full], line.end[full]), line.text[full])
    dup_lines = np.bincount(line.text[full], weights=again, minlength=block.n).astype(np.int64)
    grams, at = ngram_hashes(span_hashes(block, found.start, found.end), found.bounds, k)
    twice, _ = _repeats(grams, found.text[at])
    change = np.zeros(len(found.start) + 1, np.int64)
    np.add.at(change, at[twice], 1)
    np.add.at(change, at[twice] + k, -1)
    return [n_words, chars, symbols, dup_lines, _sums(np.cumsum(change[:-1]) > 0, found.bounds)]


def script(text: str) -> str:
    """The script of most letters; latin for a text without letters."""
    count = dict.fromkeys(SCRIPTS, 0)
    if text.isascii():
        return "latin"
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    count["latin"] = int(((points | 32) - 97 < 26).sum() + ((points >= 0xC0) & (points < 0x250)).sum())
    count["cyrillic"] = int(((points >= 0x400) & (points < 0x530)).sum())
    count["cjk"] = int((((points >= 0x3040) & (points < 0x3100)) | ((points >= 0x3400) & (points < 0xA000)) | ((points >= 0xAC00) & (points < 0xD7B0))).sum())
    count["other"] = int((points >= 0x250).sum()) - count["cyrillic"] - count["cjk"]
    return max(count, key=count.get)


def token_counts(ids: np.ndarray, is_byte: np.ndarray) -> tuple[int, int, float]:
    """Tokens, byte tokens and entropy in bits."""
    if not len(ids):
        return 0, 0, 0.0
    counts = np.bincount(ids)
    share = counts[counts > 0] / len(ids)
    return len(ids), int(is_byte[ids].sum()), float(-(share * np.log2(share)).sum())


def measure(docs: DataFrame, vocabulary: str, languages: dict[str, Band] = LANGUAGES, scripts: dict[str, Band] = SCRIPTS, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    """One row for each row of docs, as of judge() up to band; the id is named doc."""
    lang = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    slim = in_small_batches(docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"), lang.alias("lang")))
    longs = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    fields = [(c, T.LongType(), pa.int64()) for c in longs] + [("base_failed", T.BooleanType(), pa.bool_()), ("n_tokens", T.LongType(), pa.int64()), ("n_bytes", T.LongType(), pa.int64())]
    fields += [(c, T.DoubleType(), pa.float64()) for c in STEPS] + [("band", T.StringType(), pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        is_byte = np.zeros(enc.model.vocab_size(), bool)
        is_byte[list(enc.byte_ids)] = True
        for batch in batches:
            for block in blocks(batch, "text"):
                part = batch.slice(block.rows.start, block.n)
                base = base_counts(block)
                failed = (base[0] < MIN_WORDS) | (100 * base[4] > MAX_REPEAT_PERCENT * base[0])
                rows = []
                for text, language in zip(part.column("text").to_pylist(), part.column("lang").to_pylist(), strict=True):
                    text = text or ""
                    n, by_bytes, entropy = token_counts(np.frombuffer(enc.encode(text), enc.dtype), is_byte)
                    rows.append((n, by_bytes, len(text) / max(n, 1), by_bytes / max(n, 1), entropy, language if language in languages else script(text)))
                columns = [*base, failed, *zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc"), *(pa.array(c, f[2]) for c, f in zip(columns, fields, strict=True))], names=["doc", *(f[0] for f in fields)])

    schema = T.StructType([T.StructField("doc", slim.schema["doc"].dataType), *(T.StructField(c, t) for c, t, _ in fields)])
    return slim.mapInArrow(run, schema)


def size_class() -> Column:
    """Whole part of the binary logarithm of the tokens; 0 for none."""
    return F.length(F.bin("n_tokens")) - 1


def fit(measured: DataFrame) -> dict[tuple[str, int], Band]:
    """Limits by band and size class, of the sizes that have MIN_FIT texts of different counts."""
    ok = measured.where(~F.col("base_failed")).select("band", size_class().alias("size"), "n_words", "word_chars", "n_tokens", "n_bytes", *(F.round(F.col(c) * k).cast("long").alias(c) for c, k in STEPS.items()))
    quartiles = [F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(c) for c in STEPS]
    groups = ok.distinct().groupBy("band", "size").agg(F.count("*").alias("n"), *quartiles).where(F.col("n") >= MIN_FIT)
    out = {}
    for r in groups.collect():
        chars, share, bits = ([q / k for q in r[c]] for c, k in STEPS.items())
        by_chars, by_share, by_bits = max(chars[2] - chars[0], LEAST_CHARS * chars[1]), max(share[2] - share[0], LEAST_BYTES), max(bits[2] - bits[0], LEAST_ENTROPY)
        out[r["band"], r["size"]] = Band(chars[0] - LOW_CHARS * by_chars, chars[2] + HIGH * by_chars, share[2] + HIGH_BYTES * by_share, bits[0] - LOW_ENTROPY * by_bits, bits[2] + HIGH * by_bits)
    return out


def limits(fitted: dict[tuple[str, int], Band], wide: dict[str, Band]) -> list[tuple]:
    """band, size and its limits for sizes up to 2^40 tokens: the fitted ones within the wide ones."""
    out = []
    for name, outer in wide.items():
        sizes = sorted(k for n, k in fitted if n == name)
        for size in range(41):
            low = max((k for k in sizes if k <= size), default=None)
            high = min((k for k in sizes if k >= size), default=None)
            below, above = fitted[name, low] if low is not None else outer, fitted[name, high] if high is not None else outer
            out.append((name, size, max(outer.min_chars, below.min_chars), min(outer.max_chars, above.max_chars), min(outer.max_bytes, above.max_bytes), max(outer.min_entropy, below.min_entropy), min(outer.max_entropy, above.max_entropy)))
    return out


def judge(docs: DataFrame, vocabulary: str, languages: dict[str, Band] = LANGUAGES, scripts: dict[str, Band] = SCRIPTS, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    """One row for each row of docs: the base counts, base_failed, n_tokens, n_bytes, chars_per_token, byte_share, entropy, band, rejected_by and kept.

    vocabulary: path of a SentencePiece model with byte fallback, the same on all executors. band: the language or script
    whose limits held; rejected_by: base, chars_per_token, byte_share or entropy, null for kept rows. Counts are written
    to the shared folder first, as the limits come from all of them.
    """
    measured = materialise(measure(docs, vocabulary, languages, scripts, id_col, text_col, lang_col), "fertility")
    rows = limits(fit(measured), scripts | languages)
    bands = docs.sparkSession.createDataFrame(rows, "band string, __size int, __chars0 double, __chars1 double, __bytes1 double, __bits0 double, __bits1 double")
    both = measured.withColumn("__size", size_class()).join(F.broadcast(bands), ["band", "__size"], "left")
    why = F.when(F.col("base_failed"), "base").when(~F.col("chars_per_token").between(F.col("__chars0"), F.col("__chars1")), "chars_per_token").when(F.col("byte_share") > F.col("__bytes1"), "byte_share").when(~F.col("entropy").between(F.col("__bits0"), F.col("__bits1")), "entropy")
    return both.withColumn("rejected_by", why).select(F.col("doc").alias(id_col), *measured.columns[1:], "rejected_by", F.col("rejected_by").isNull().alias("kept"))
