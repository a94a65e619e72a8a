"""Find passages of benchmark items in documents with an FM-index for each shard of texts.

A shard is a block of whole texts. Its words become symbols (the benchmark's words, one symbol for all others, one
for a text's end); suffixes are sorted, and the Burrows-Wheeler transform goes into a wavelet matrix. All windows of
the items are searched backwards at once, occurrences are located by walking to sampled suffix positions, and the
spans that they cover are merged. Documents are not shuffled; the items' windows are sent to the tasks, in as many
rounds as their bound asks for.

Defined results: null and empty texts have no words. An item with fewer words than a window is one window; one without
words never occurs. Items with equal ids are one item; windows of
items without an id are hit like others, and only items leaves them out. Repeated document rows are judged one by one. Empty tables give
no hits, or no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkmill.llm.kernels import ALPHANUMERIC, Block, blocks, ngram_hashes, span_hashes, spans
from talkmill.llm.shared import in_small_batches, materialise

WINDOW = 10
#: Bytes of text in a shard (a longer text is a shard of its own), and the suffix positions of which one is kept.
SHARD_BYTES, SAMPLE = 1 << 20, 16
#: Bytes of item texts handled in one round over the documents: some 10 times as many on the driver, 4 times in a task.
ROUND_BYTES = 8 << 20

_END, _OTHER, _FIRST = 1, 2, 3  # symbols; 0 ends the shard


def suffix_array(symbols: np.ndarray, n_symbols: int) -> np.ndarray:
    """Sorted suffixes of symbols, whose last one is 0 and occurs once: by packed prefixes, then doubling what is not yet told apart."""
    n = len(symbols)
    bits = max(1, int(n_symbols).bit_length())
    h = max(1, 62 // bits)
    padded = np.concatenate((symbols.astype(np.int64), np.zeros(h, np.int64)))
    key = np.zeros(n, np.int64)
    for j in range(h):
        key = key << bits | padded[j : j + n]
    order = np.argsort(key)
    sorted_key = key[order]
    head = np.ones(n, bool)
    head[1:] = sorted_key[1:] != sorted_key[:-1]
    del key, sorted_key, padded
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    alone = head.copy()
    alone[:-1] &= head[1:]
    slots = np.flatnonzero(~alone)  # places of suffixes that equal a neighbour so far
    while len(slots):
        own = order[slots]
        after = own + h
        pair = rank[own] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        by = np.argsort(pair)  # a group's places stay its own, as its rank leads
        own, pair = own[by], pair[by]
        order[slots] = own
        new = np.ones(len(slots), bool)
        new[1:] = pair[1:] != pair[:-1]
        rank[own] = np.maximum.accumulate(np.where(new, slots, 0))
        alone = new.copy()
        alone[:-1] &= new[1:]
        slots, h = slots[~alone], 2 * h
    return order


class WaveletMatrix:
    """Ranks of symbols in a sequence: a bit vector with popcounts for each bit of a symbol, highest first."""

    def __init__(self, sequence: np.ndarray, n_symbols: int):
        self.bits = max(1, int(n_symbols - 1).bit_length())
        self.words, self.sums, self.zeros = [], [], []
        for level in range(self.bits - 1, -1, -1):
            bit = (sequence >> level & 1).astype(np.uint8)
            packed = np.packbits(bit, bitorder="little")
            packed = np.concatenate((packed, np.zeros(16 - len(packed) % 8, np.uint8))).view(np.uint64)
            self.words.append(packed)
            self.sums.append(np.concatenate((np.zeros(1, np.int64), np.cumsum(np.bitwise_count(packed), dtype=np.int64))))
            self.zeros.append(len(bit) - int(bit.sum()))
            sequence = np.concatenate((sequence[bit == 0], sequence[bit == 1]))

    def ones(self, level: int, i: np.ndarray) -> np.ndarray:
        """Ones before place i on a level."""
        word = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.sums[level][word] + np.bitwise_count(self.words[level][word] & below)

    def down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where the first i places go among places of the symbol on the lowest level (a rank, plus the symbol's start there)."""
        for level in range(self.bits):
            ones = self.ones(level, i)
            i = np.where(symbol >> (self.bits - 1 - level) & 1, self.zeros[level] + ones, i - ones)
        return i

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at places i, and down() of each."""
        symbol = np.zeros(len(i), np.int64)
        for level in range(self.bits):
            bit = (self.words[level][i >> 6] >> (i & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            ones = self.ones(level, i)
            symbol = symbol << 1 | bit
            i = np.where(bit, self.zeros[level] + ones, i - ones)
        return symbol, i


class FMIndex:
    """Counts and places of patterns in a sequence of symbols below n_symbols; the last symbol is 0 and occurs once."""

    def __init__(self, symbols: np.ndarray, n_symbols: int, sample: int = SAMPLE):
        order = suffix_array(symbols, n_symbols)
        self.n = len(symbols)
        self.wavelet = WaveletMatrix(symbols[order - 1], n_symbols)
        self.first = np.concatenate((np.zeros(1, np.int64), np.cumsum(np.bincount(symbols, minlength=n_symbols))))
        every = np.arange(n_symbols)
        self.shift = self.first[:-1] - self.wavelet.down(every, np.zeros(n_symbols, np.int64))
        self.kept = order % sample == 0
        self.kept_before = np.concatenate((np.zeros(1, np.int64), np.cumsum(self.kept)))
        self.samples = order[self.kept]

    def search(self, text: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that begin with each pattern (symbols of text before its end); equal ends: none."""
        lo, hi = np.zeros(len(ends), np.int64), np.full(len(ends), self.n, np.int64)
        live = np.arange(len(ends))
        for step in range(1, int(lengths.max(initial=0)) + 1):
            live = live[(lengths[live] >= step) & (lo[live] < hi[live])]
            c = text[ends[live] - step].astype(np.int64)
            lo[live] = self.shift[c] + self.wavelet.down(c, lo[live])
            hi[live] = self.shift[c] + self.wavelet.down(c, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The positions of suffixes, each walked back to a sampled one."""
        at, steps, todo = rows.copy(), np.zeros(len(rows), np.int64), np.arange(len(rows))
        while len(todo := todo[~self.kept[at[todo]]]):
            symbol, down = self.wavelet.access(at[todo])
            at[todo] = self.shift[symbol] + down
            steps[todo] += 1
        return self.samples[self.kept_before[at]] + steps


@dataclass
class Windows:
    """All distinct windows of some items, as stretches of the items' symbols, and the items of each."""

    vocabulary: np.ndarray  # sorted word hashes; a word's symbol is its place + 3
    symbols: np.ndarray
    ends: np.ndarray
    lengths: np.ndarray
    names: list[str]  # sorted item ids
    items: np.ndarray  # places in names, window after window
    bounds: np.ndarray  # where the items of each window begin, and the end


def item_windows(items: list[tuple[str | None, str]], window: int) -> Windows:
    batch = pa.RecordBatch.from_arrays([pa.array([t for _, t in items], pa.string())], names=["text"])
    words, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for block in blocks(batch, "text"):
        found = spans(block, ALPHANUMERIC)
        words.append(span_hashes(block, found.start, found.end, fold=True))
        counts.append(np.diff(found.bounds))
    words, counts = np.concatenate(words), np.concatenate(counts)
    bounds = np.concatenate((np.zeros(1, np.int64), np.cumsum(counts)))
    hashes, at = ngram_hashes(words, bounds, window)
    short = np.flatnonzero((counts > 0) & (counts < window))
    own = [ngram_hashes(words[bounds[i] : bounds[i + 1]], np.array([0, counts[i]]), int(counts[i]))[0] for i in short]
    hashes, at = np.concatenate([hashes, *own]), np.concatenate((at, bounds[short]))
    owner = np.searchsorted(bounds, at, "right") - 1
    names = sorted({item for item, _ in items if item is not None})
    place = {item: i for i, item in enumerate(names)}
    number = np.array([place.get(item, -1) for item, _ in items], np.int64)[owner]
    order = np.lexsort((number, hashes))
    hashes, at, owner, number = hashes[order], at[order], owner[order], number[order]
    first = np.ones(len(hashes), bool)
    first[1:] = hashes[1:] != hashes[:-1]
    named = number >= 0
    named[1:] &= first[1:] | (number[1:] != number[:-1])
    which = np.cumsum(first) - 1
    vocabulary = np.unique(words)
    lengths = np.minimum(counts[owner[first]], window)
    return Windows(vocabulary, (np.searchsorted(vocabulary, words) + _FIRST).astype(np.int32), at[first] + lengths, lengths, names, number[named], np.searchsorted(which[named], np.arange(int(first.sum()) + 1)))


def stretches(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each of count numbers, joined."""
    return np.repeat(start - np.cumsum(count) + count, count) + np.arange(int(count.sum()))


def shard_hits(block: Block, windows: Windows, earlier: list[list[dict]]) -> tuple[np.ndarray, np.ndarray, list[set[str]], np.ndarray, np.ndarray]:
    """Of a shard: word counts, hit words (booleans over all words), items of each text, and starts and ends of words in bytes.

    earlier: spans of each text that count as hit already.
    """
    found = spans(block, ALPHANUMERIC)
    n_words = np.diff(found.bounds)
    total = len(found.start)
    items: list[set[str]] = [set() for _ in range(block.n)]
    change = np.zeros(total + 1, np.int64)
    for t, old in enumerate(earlier):
        for s in old:
            change[found.bounds[t] + s["start"]] += 1
            change[found.bounds[t] + s["end"]] -= 1
    n_windows = len(windows.ends)
    if total and n_windows:
        words = span_hashes(block, found.start, found.end, fold=True)
        place = np.minimum(np.searchsorted(windows.vocabulary, words), len(windows.vocabulary) - 1)
        symbol = np.where(windows.vocabulary[place] == words, place + _FIRST, _OTHER)
        # Texts are joined with an end symbol behind each, so a text's k-th word moves on by the texts before it.
        sequence = np.full(total + block.n + 1, _END, np.int64)
        sequence[np.arange(total) + found.text] = symbol
        sequence[-1] = 0
        index = FMIndex(sequence, len(windows.vocabulary) + _FIRST)
        lo, hi = index.search(windows.symbols, windows.ends, windows.lengths)
        count = hi - lo
        which = np.repeat(np.arange(len(lo)), count)
        at = index.locate(stretches(lo, count))
        starts = found.bounds[:-1] + np.arange(block.n)
        text = np.searchsorted(starts, at, "right") - 1
        np.add.at(change, at - text, 1)
        np.add.at(change, at - text + windows.lengths[which], -1)
        pairs = np.unique(text * n_windows + which)
        text, which = pairs // n_windows, pairs % n_windows
        n_of = windows.bounds[which + 1] - windows.bounds[which]
        item = windows.items[stretches(windows.bounds[which], n_of)]
        n_names = max(1, len(windows.names))
        for pair in np.unique(np.repeat(text, n_of) * n_names + item).tolist():
            items[pair // n_names].add(windows.names[pair % n_names])
    return found.bounds, np.cumsum(change[:-1]) > 0, items, found.start, found.end


def find_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", cut: bool = False) -> DataFrame:
    """id_col, n_words, n_hit, spans (start and end words of merged hits) and items (ids as sorted strings) of each row of docs.

    cut: also clean_text, the text without the bytes from each span's first word to its last.
    """
    slim = benchmark.select(F.col(item_col).cast("string").alias("item"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text"))
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rounds = size // ROUND_BYTES + 1  # a round's items are collected and sent to every task; each round reads the documents once more
    out = in_small_batches(docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"), F.lit(0).cast("long").alias("n_words"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"), F.array().cast("array<string>").alias("items")))
    for r in range(rounds):
        some = slim if rounds == 1 else slim.where(F.pmod(F.xxhash64("item", "text"), F.lit(rounds)) == r)
        out = _round(out, item_windows([(x["item"], x["text"]) for x in some.toLocalIterator()], window), cut and r == rounds - 1)
        if r < rounds - 1:  # a task holds the windows of one round
            out = materialise(out, "round")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))
    return out.select(F.col("doc").alias(id_col), "n_words", n_hit.alias("n_hit"), "spans", "items", *([F.col("text").alias("clean_text")] if cut else []))


def _round(df: DataFrame, windows: Windows, cut: bool) -> DataFrame:
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text", SHARD_BYTES):
                part = batch.slice(block.rows.start, block.n)
                bounds, hit, items, first, last = shard_hits(block, windows, part.column("spans").to_pylist())
                edge = np.flatnonzero(np.diff(np.concatenate(([0], hit, [0])))) if len(hit) else np.zeros(0, np.int64)
                all_spans, texts = [], part.column("text").to_pylist() if cut else None
                spans_of = np.searchsorted(bounds, edge[::2], "right") - 1 if len(edge) else edge
                by: dict[int, list] = {}
                for t, a, b in zip(spans_of.tolist(), edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                    while a < b:  # hits at one text's end and the next one's start look like one run
                        end = min(b, int(bounds[t + 1]))
                        if end > a:
                            by.setdefault(t, []).append((a, end))
                        a, t = end, t + 1
                for t in range(block.n):
                    all_spans.append([{"start": a - int(bounds[t]), "end": b - int(bounds[t])} for a, b in by.get(t, [])])
                    if cut and t in by:
                        raw, at, kept = block.data[block.offsets[t] : block.offsets[t + 1]].tobytes(), 0, []
                        for a, b in by[t]:
                            kept.append(raw[at : first[a] - block.offsets[t]])
                            at = int(last[b - 1] - block.offsets[t])
                        texts[t] = b"".join([*kept, raw[at:]]).decode()
                every = [sorted(x.union(old)) for x, old in zip(items, part.column("items").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc"), pa.array(texts, pa.string()) if cut else part.column("text"), pa.array(np.diff(bounds), pa.int64()), pa.array(all_spans, span_type), pa.array(every, pa.list_(pa.string()))], names=["doc", "text", "n_words", "spans", "items"])

    return df.mapInArrow(run, T.StructType([T.StructField("doc", df.schema["doc"].dataType), *T.StructType.fromDDL("text string, n_words long, spans array<struct<start:int,end:int>>, items array<string>").fields]))
