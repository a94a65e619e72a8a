"""Pack token ids of documents into sequences by minimum bin slack.

A document's full windows are sequences of their own. What remains of each is put into groups; for each window a
bitset subset-sum over the lengths that remain finds the filling closest to the capacity beside the longest one, and
backtracking gives how many of each length it takes. Of fillings that leave slack at last the documents are joined and
cut into full windows and lengths that are powers of two, which need no padding. Nothing is shuffled.

Defined results: a null or empty text has the end id alone. Repeated rows are packed once each. Sequence ids hold the
partition's number, so they are unique, and the same for a task that runs again over the same rows. Other input
columns are not carried. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from talkmill.llm.memo_tokens import Encoder, encoder, only_within
from talkmill.llm.shared import in_small_batches

CAPACITY = 2048
#: Remainders packed together; more give fewer cuts, fewer take less memory (at most 8 KB each).
GROUP = 4096


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How many of each length to take for the largest sum up to capacity. counts: length to how many there are."""
    goal, reach, steps = 1 << capacity, 1, []
    mask = (goal << 1) - 1
    for length in sorted(counts, reverse=True):
        if length > capacity:
            continue
        left, some = min(counts[length], capacity // length), 1
        while left:  # 1, 2, 4 ... copies, so that any number up to all of them can be taken
            take = min(some, left)
            wider = (reach | reach << length * take) & mask
            if wider != reach:
                steps.append((length, take, reach))
                reach = wider
            left, some = left - take, some * 2
        if reach & goal:
            break
    at, taken = reach.bit_length() - 1, defaultdict(int)
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            taken[length] += take
            at -= length * take
    return dict(taken)


def windows(counts: dict[int, int], capacity: int) -> Iterator[tuple[dict[int, int], int, int]]:
    """Fillings that use up counts: lengths taken, how often this filling is used, and its sum."""
    counts = {k: v for k, v in counts.items() if v}
    while counts:
        longest = max(counts)
        counts[longest] -= 1
        taken = fill({k: v for k, v in counts.items() if v}, capacity - longest)
        counts[longest] += 1
        taken[longest] = taken.get(longest, 0) + 1
        times = min(counts[k] // n for k, n in taken.items())
        for k, n in taken.items():
            counts[k] -= n * times
            if not counts[k]:
                del counts[k]
        yield taken, times, sum(k * n for k, n in taken.items())


class _Packer:
    """Pieces of the documents of one partition."""

    def __init__(self, capacity: int, group: int, partition: int):
        self.capacity, self.group, self.sequence = capacity, group, partition << 33
        self.waiting: dict[int, deque] = defaultdict(deque)
        self.n_waiting = 0
        self.out: list[tuple] = []

    def put(self, doc, start: int, ids: np.ndarray, total: int, offset: int) -> None:
        self.out.append((doc, start, len(ids), ids.tobytes(), total, self.sequence, offset))

    def add(self, doc, ids: np.ndarray) -> None:
        total, start = len(ids), 0
        for start in range(0, total - self.capacity + 1, self.capacity):
            self.put(doc, start, ids[start : start + self.capacity], total, 0)
            self.sequence += 1
        start = total // self.capacity * self.capacity
        if start < total:
            self.waiting[total - start].append((doc, start, ids[start:].copy(), total))
            self.n_waiting += 1
            if self.n_waiting >= self.group:
                self.pack()

    def pack(self) -> None:
        """Use the fillings without slack; join what finds none and cut it at the capacity, its end at powers of two."""
        for taken, times, total in windows({k: len(v) for k, v in self.waiting.items()}, self.capacity):
            if total < self.capacity:
                continue
            for _ in range(times):
                offset = 0
                for length, n in taken.items():
                    for _ in range(n):
                        doc, start, ids, whole = self.waiting[length].popleft()
                        self.put(doc, start, ids, whole, offset)
                        offset += length
                self.sequence += 1
        rest = [x for k in sorted(self.waiting, reverse=True) for x in self.waiting[k]]
        left = sum(len(x[2]) for x in rest)
        room, offset = 0, 0
        for doc, start, ids, whole in rest:
            at = 0
            while at < len(ids):
                if not room:
                    room, offset = min(self.capacity, 1 << left.bit_length() - 1), 0
                n = min(room, len(ids) - at)
                self.put(doc, start + at, ids[at : at + n], whole, offset)
                at, room, offset, left = at + n, room - n, offset + n, left - n
                if not room:
                    self.sequence += 1
        self.waiting.clear()
        self.n_waiting = 0

    def taken(self, schema: pa.Schema) -> pa.RecordBatch:
        columns = list(zip(*self.out, strict=True)) if self.out else [[]] * len(schema)
        self.out = []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int = 1, capacity: int = CAPACITY, group: int = GROUP, id_col: str = "doc_id", text_col: str = "text", memo_pieces: int | None = None) -> DataFrame:
    """One row for each piece: its document, start there, length, ids (32-bit little-endian), the document's tokens, sequence_id and offset in it.

    vocabulary: path of a public tokenizer's file, the same on all executors. capacity: a power of two. memo_pieces:
    remember so many pieces a generation, and forget them with the task; None: as memo_tokens does, from task to task.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    slim = in_small_batches(docs.select(id_col, text_col))
    kind = slim.schema[0].dataType
    schema = T.StructType([T.StructField(id_col, kind), *(T.StructField(n, T.LongType()) for n in ("start", "length")), T.StructField("ids", T.BinaryType()), *(T.StructField(n, T.LongType()) for n in ("doc_tokens", "sequence_id", "offset"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        if memo_pieces is None:
            yield from packed(batches, enc)
            return
        with only_within(enc, memo_pieces):
            yield from packed(batches, enc)

    def packed(batches: Iterator[pa.RecordBatch], enc: Encoder) -> Iterator[pa.RecordBatch]:
        encode, dtype = enc.encode, enc.dtype
        packer = _Packer(capacity, group, TaskContext.get().partitionId())
        end, out = np.array([end_id], "<u4"), None
        for batch in batches:
            out = out or pa.schema([(id_col, batch.schema.types[0]), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                packer.add(doc, np.concatenate((np.frombuffer(encode(text.as_py() or ""), dtype).astype("<u4"), end)))
            yield packer.taken(out)
        if out:
            packer.pack()
            yield packer.taken(out)

    return slim.mapInArrow(run, schema)
