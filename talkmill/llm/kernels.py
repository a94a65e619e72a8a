"""Numpy helpers for words, lines and shingles of an Arrow column of texts, a bounded block of bytes at a time."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a single longer text is a block of its own.
BLOCK_BYTES = 1 << 20

_U = np.uint64
_STEP = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the SplitMix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_kept_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def _powers(n: int) -> list[np.ndarray]:
    """At least n powers of an odd base modulo 2^64, and of its inverse. A worker keeps those of blocks (16 MB), not of longer texts."""
    if len(_kept_powers[0]) >= n:
        return _kept_powers
    size = max(BLOCK_BYTES, n)
    with np.errstate(over="ignore"):
        found = [np.cumprod(np.concatenate((np.ones(1, _U), np.full(size - 1, base, _U))), dtype=_U) for base in (_STEP, pow(_STEP, -1, 1 << 64))]
    if size <= BLOCK_BYTES:
        _kept_powers[:] = found
    return found


@lru_cache(maxsize=4)
def _letters(fold: bool) -> np.ndarray:
    """A random-looking 64-bit number for each byte; with fold, A-Z have those of a-z."""
    table = mix((np.arange(256, dtype=_U) + _U(1)) * _U(_STEP & _MASK))
    if fold:
        table = table.copy()
        table[65:91] = table[97:123]
    return table


def byte_class(*spans: tuple[int, int]) -> np.ndarray:
    """A table of booleans by byte, true in the given inclusive ranges."""
    table = np.zeros(256, bool)
    for lo, hi in spans:
        table[lo : hi + 1] = True
    return table


#: Bytes outside [\x20\x09-\x0D]; multi-byte characters count as parts of words.
NOT_BLANK = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: ASCII letters and digits, and all of multi-byte characters.
ALPHANUMERIC = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


@dataclass
class Block:
    """Some whole texts: their rows in the batch, bytes, and offsets (one more than texts)."""

    rows: slice
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1


def blocks(batch: pa.RecordBatch, column: str, size: int = BLOCK_BYTES) -> Iterator[Block]:
    """The texts of a column in blocks of at most size bytes, or one text; null is an empty text."""
    texts = batch.column(column)
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1 + texts.offset)[texts.offset :]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield Block(slice(lo, hi), data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


@dataclass
class Spans:
    """Stretches of bytes within texts: start, end, text number, and where each text's spans begin (one more than texts)."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    bounds: np.ndarray


def spans(block: Block, is_word: np.ndarray) -> Spans:
    """Maximal runs of bytes of a class; a run ends with its text."""
    inside = is_word[block.data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = block.offsets[:-1][block.offsets[:-1] < block.offsets[1:]]
    first[heads] = inside[heads]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    bounds = np.searchsorted(start, block.offsets)
    return Spans(start, end, np.repeat(np.arange(block.n), np.diff(bounds)), bounds)


def span_hashes(block: Block, start: np.ndarray, end: np.ndarray, fold: bool = False) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, from prefix sums; fold: A-Z count as a-z."""
    up, down = _powers(len(block.data))
    sums = np.zeros(len(block.data) + 1, _U)
    with np.errstate(over="ignore"):
        np.cumsum(_letters(fold)[block.data] * up[: len(block.data)], out=sums[1:])
        value = (sums[end] - sums[start]) * down[start]
        return mix(value ^ mix((end - start).astype(_U) * _U(_STEP)))


def ngram_hashes(words: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k successive words, and the positions of their first words; none crosses from text to text."""
    if len(words) < k:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    n = len(words) - k + 1
    with np.errstate(over="ignore"):
        value = np.full(n, k, _U)
        for i in range(k):
            value = mix(value * _U(_STEP) + words[i : i + n])
    ok = np.ones(n, bool)
    for i in range(1, k):  # positions within k - 1 before a text's end
        near = bounds[1:] - i
        ok[near[(near >= 0) & (near < n) & (near >= bounds[:-1])]] = False
    at = np.flatnonzero(ok)
    return value[at], at
