"""A content-addressed store of token ids.

A rolling hash over the ids cuts each document into chunks, so equal passages give equal chunks. A chunk's address is
the SHA-256 of its ids (unsigned 16-bit little-endian, or 32-bit for large vocabularies); the store holds each
address once. A document's recipe lists its addresses and their Merkle root. A Merkle tree with FANOUT branches stands
over the recipes of each file, in their order, and another one over the files.

    {path}/staged    what tokenising gives, one row for each document (can be deleted after the build)
    {path}/chunks    address, ids
    {path}/recipes   part, row, document, n_tokens, addresses, root; ascending ids within and over the parts
    {path}/manifest  part, n_docs, n_tokens, root
    {path}/top       n_docs, n_tokens, width (bytes of an id), id_type, root: one row; none for an empty store

Reading checks the trees first: recipes that are lost, added or changed stop it. It computes every stored chunk's
address again, recomputes roots from recipes, and gives each document's CRC-32 by combining its chunks' (crc32(A+B)
follows from crc32(A), crc32(B) and the length of B).

Defined results: a null or empty text has the end id alone; repeated rows are stored once and have a recipe each, in
an order fixed by their roots; null ids come first. Other input columns are not carried. An empty table gives empty
files, from which no rows are read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkmill.llm.kernels import mix
from talkmill.llm.memo_tokens import encoder
from talkmill.llm.shared import in_small_batches, materialise

#: Ids in a chunk: at least, on the average beyond that (a power of two), at most. Ids that the rolling hash sees.
LEAST, MEAN, MOST, WINDOW = 128, 512, 4096, 8
#: Ids that are hashed at once.
STRETCH = 1 << 16
#: Branches of a node in the trees over recipes.
FANOUT = 1024


class Damaged(ValueError):
    """The store's recipes are not those that its trees were made of."""

_U = np.uint64


def marks(ids: np.ndarray, mean: int = MEAN) -> np.ndarray:
    """Where the rolling hash of the WINDOW ids before allows a cut, ascending; taken in stretches, so that long texts need no more memory."""
    out = [np.zeros(0, np.int64)]
    for at in range(0, len(ids), STRETCH):
        first = max(0, at - WINDOW + 1)
        table = mix(ids[first : at + STRETCH].astype(_U) + _U(1))
        rolled = table.copy()
        with np.errstate(over="ignore"):
            for i in range(1, WINDOW):
                rolled[i:] += table[:-i] << _U(i * 7)
        found = np.flatnonzero((mix(rolled) & _U(mean - 1)) == 0) + first + 1
        out.append(found[found > at])
    return np.concatenate(out)


def cuts(n: int, allowed: list[int], least: int = LEAST, most: int = MOST) -> list[int]:
    """Ends of the chunks of a document of n ids. A cut depends on the ids before it and on the chunk's length so far."""
    out, last = [], 0
    for at in allowed:
        while at - last > most:
            last += most
            out.append(last)
        if at - last >= least:
            out.append(at)
            last = at
    while n - last > most:
        last += most
        out.append(last)
    if last < n:
        out.append(n)
    return out


def cuts_of_each(ids: np.ndarray, bounds: np.ndarray) -> list[list[int]]:
    """cuts() of documents that stand one behind another. bounds: where they begin, and the end.

    Marks within a document's first ids see some of the one before, but no chunk of LEAST ids ends there.
    """
    allowed = marks(ids)
    own = np.searchsorted(allowed, bounds, "right")
    return [cuts(int(b - a), (allowed[i:j] - a).tolist()) for a, b, i, j in zip(bounds, bounds[1:], own, own[1:], strict=False)]


def merkle_root(hashes: list[bytes]) -> bytes:
    """SHA-256 over pairs, level by level; one left over goes up as it is. Leaves and pairs differ in their first byte."""
    level = [hashlib.sha256(b"\x00" + h).digest() for h in hashes] or [hashlib.sha256(b"").digest()]
    while len(level) > 1:
        pairs = [hashlib.sha256(b"\x01" + a + b).digest() for a, b in zip(level[::2], level[1::2], strict=False)]
        level = pairs + level[2 * len(pairs) :]
    return level[0]


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of polynomials over GF(2) modulo that of CRC-32, bits reflected (the top bit is the constant)."""
    out, b = np.zeros_like(b), b.copy()
    for bit in range(31, -1, -1):
        out ^= np.where(a >> np.uint32(bit) & np.uint32(1), b, np.uint32(0))
        b = np.where(b & np.uint32(1), b >> np.uint32(1) ^ np.uint32(0xEDB88320), b >> np.uint32(1))
    return out


def combine_crcs(crcs: np.ndarray, sizes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """CRC-32 of each group of chunks joined, from the chunks' CRCs and sizes in bytes. bounds: where groups begin, and the end."""
    ends = np.cumsum(sizes)
    after = np.repeat(ends[bounds[1:] - 1] if len(bounds) > 1 else ends[:0], np.diff(bounds)) - ends  # bytes behind a chunk
    power, value, left = np.full(1, 1 << 23, np.uint32), crcs.astype(np.uint32), after.copy()  # x^8
    while left.any():
        odd = np.flatnonzero(left & 1)
        value[odd] = _times(np.broadcast_to(power, len(odd)), value[odd])
        power, left = _times(power, power), left >> 1
    return np.bitwise_xor.reduceat(value, bounds[:-1]) if len(bounds) > 1 else value[:0]


def _staged(docs: DataFrame, vocabulary: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    slim = in_small_batches(docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")))
    schema = T.StructType([T.StructField("doc", slim.schema[0].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("root", T.BinaryType()), T.StructField("addresses", T.ArrayType(T.BinaryType())), T.StructField("ids", T.ArrayType(T.BinaryType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        end, width = enc.pack([end_id]), np.dtype(enc.dtype).itemsize
        for batch in batches:
            n, roots, addresses, parts = [], [], [], []
            raws = [enc.encode(text.as_py() or "") + end for text in batch.column(1)]
            bounds = np.cumsum([0, *map(len, raws)]) // width
            for raw, found in zip(raws, cuts_of_each(np.frombuffer(b"".join(raws), enc.dtype), bounds), strict=True):
                ends = [0, *found]
                own = [raw[a * width : b * width] for a, b in zip(ends, found, strict=False)]
                names = [hashlib.sha256(x).digest() for x in own]
                n.append(len(raw) // width)
                roots.append(merkle_root(names))
                addresses.append(names)
                parts.append(own)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(roots, pa.binary()), pa.array(addresses, pa.list_(pa.binary())), pa.array(parts, pa.list_(pa.binary()))], names=["doc", "n_tokens", "root", "addresses", "ids"])

    return slim.mapInArrow(run, schema)


def build_store(docs: DataFrame, path: str, vocabulary: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode all texts, an end_id behind each, and write the store. Texts are tokenised once."""
    spark = docs.sparkSession
    zstd = {"compression": "zstd"}
    _staged(docs, vocabulary, end_id, id_col, text_col).write.options(**zstd).parquet(f"{path}/staged")
    staged = spark.read.parquet(f"{path}/staged")
    # Each task keeps one of its equal chunks before they are shuffled, so a very common one isn't much to any task.
    chunks = staged.select(F.inline(F.arrays_zip(F.col("addresses").alias("address"), F.col("ids").alias("ids"))))
    chunks.dropDuplicates(["address"]).write.options(**zstd).parquet(f"{path}/chunks")
    recipes = staged.select("doc", "n_tokens", "root", "addresses").repartitionByRange("doc", "root").sortWithinPartitions("doc", "root")
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # counts within the part
    recipes.select(F.spark_partition_id().alias("part"), row.alias("row"), "*").write.options(**zstd).parquet(f"{path}/recipes")
    file_roots(spark.read.parquet(f"{path}/recipes")).write.parquet(f"{path}/manifest")
    width = np.dtype(encoder(vocabulary).dtype).itemsize
    top_root(spark.read.parquet(f"{path}/manifest")).withColumns({"width": F.lit(width), "id_type": F.lit(staged.schema["doc"].dataType.simpleString())}).write.parquet(f"{path}/top")


def _up(nodes: DataFrame, keys: list[str], place: str) -> DataFrame:
    """Nodes (keys, place, hash, n_docs, n_tokens) to those of the tree's root for keys, at place 0: FANOUT of them at most meet in a hash."""
    top = nodes.agg(F.max(place)).first()[0] or 0
    while True:
        ordered = F.array_sort(F.collect_list(F.struct(place, "hash")))
        joined = F.concat(F.lit(b"\x02"), F.unhex(F.array_join(F.transform(ordered, lambda x: F.hex(x["hash"])), "")))
        level = nodes.groupBy(*keys, F.floor(F.col(place) / FANOUT).cast("long").alias("up"))
        nodes = level.agg(F.unhex(F.sha2(joined, 256)).alias("hash"), F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).withColumnRenamed("up", place)
        top //= FANOUT
        if not top:
            return nodes.drop(place)


def file_roots(recipes: DataFrame) -> DataFrame:
    """A row for each part: documents, tokens, and the root of the tree over its documents' roots and numbers of tokens."""
    leaf = F.unhex(F.sha2(F.concat(F.lit(b"\x00"), F.col("root"), F.encode(F.col("n_tokens").cast("string"), "utf-8")), 256))
    leaves = recipes.select("part", F.col("row").alias("place"), leaf.alias("hash"), F.lit(1).cast("long").alias("n_docs"), "n_tokens")
    return _up(leaves, ["part"], "place").withColumnRenamed("hash", "root")


def top_root(manifest: DataFrame) -> DataFrame:
    """n_docs, n_tokens and the root over all parts: one row, or none for an empty store."""
    return _up(manifest.select(F.col("part").alias("place"), F.col("root").alias("hash"), "n_docs", "n_tokens"), [], "place").withColumnRenamed("hash", "root")


def _recipes(spark: SparkSession, path: str) -> tuple[DataFrame, str]:
    """The recipes, unchecked, and the type of the ids. The schema is given, so that a folder without files has no rows."""
    top = spark.read.parquet(f"{path}/top").first()
    if top is None:
        return spark.read.parquet(f"{path}/recipes"), "<u2"
    return spark.read.schema(f"part int, row long, doc {top['id_type']}, n_tokens long, root binary, addresses array<binary>").parquet(f"{path}/recipes"), f"<u{top['width']}"


def damaged_parts(spark: SparkSession, path: str) -> DataFrame:
    """The parts whose recipes don't give the manifest's root (part, expected, found; null: not there), and -1 for the manifest itself."""
    manifest = spark.read.parquet(f"{path}/manifest")
    found = file_roots(_recipes(spark, path)[0]).select("part", F.col("root").alias("found"))
    both = manifest.select("part", F.col("root").alias("expected")).join(found, "part", "full")
    tops = [x.select(F.lit(-1).alias("part"), F.col("root").alias(name)) for x, name in ((spark.read.parquet(f"{path}/top"), "expected"), (top_root(manifest), "found"))]
    return both.unionByName(tops[0].join(tops[1], "part", "full")).where(~F.col("expected").eqNullSafe(F.col("found")))


def checked_recipes(spark: SparkSession, path: str) -> tuple[DataFrame, str]:
    """The recipes and the type of the ids, if the trees over the recipes are as they were written."""
    bad = [r["part"] for r in damaged_parts(spark, path).select("part").limit(20).collect()]
    if bad:
        raise Damaged(f"recipes of {path} are damaged, in part {', '.join(map(str, sorted(bad)))}")
    return _recipes(spark, path)


def read_chunks(spark: SparkSession, path: str, dtype: str) -> DataFrame:
    """address, number of ids and CRC-32 of the ids as 32-bit integers, of each stored chunk; intact: its address is right."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(x.as_buffer(), dtype) for x in batch.column("ids")]
            good = [hashlib.sha256(x).digest() == a.as_py() for x, a in zip(ids, batch.column("address"), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("address"), pa.array([len(x) for x in ids], pa.int64()), pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()), pa.array(good, pa.bool_())], names=["address", "n", "crc", "intact"])

    return in_small_batches(spark.read.parquet(f"{path}/chunks").select("address", "ids")).mapInArrow(run, "address binary, n long, crc long, intact boolean")


def read_documents(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """From the files: document, start (ids of all before it), n_tokens, ids_crc32, and verified (addresses, lengths and root are right)."""
    recipes, dtype = checked_recipes(spark, path)
    totals = recipes.groupBy("part").agg(F.sum("n_tokens").alias("in_part"))
    before = totals.select("part", (F.sum("in_part").over(Window.orderBy("part")) - F.col("in_part")).alias("before"))  # a row for each file
    inside = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    placed = recipes.select("part", "row", "doc", "n_tokens", "root", "addresses", (F.sum("n_tokens").over(inside) - F.col("n_tokens")).alias("within"))
    listed = recipes.select("part", "row", F.posexplode("addresses").alias("seq", "address"))
    # Written first, both sides of the join are plain reads, so Spark can split the rows of a very common chunk.
    chunks = materialise(read_chunks(spark, path, dtype), "chunk-sums")
    found = listed.join(chunks, "address", "left").groupBy("part", "row").agg(F.array_sort(F.collect_list(F.struct("seq", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("crc", F.lit(0)).alias("crc"), F.coalesce("intact", F.lit(False)).alias("intact")))).alias("got"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = batch.column("got")
            flat, bounds = got.flatten(), np.concatenate(([0], np.cumsum([len(x) for x in got]))).astype(np.int64)
            n, crc = flat.field("n").to_numpy(), flat.field("crc").to_numpy()
            intact = flat.field("intact").to_numpy(zero_copy_only=False)
            sums = np.add.reduceat(n, bounds[:-1]) if len(n) else n
            whole = np.logical_and.reduceat(intact, bounds[:-1]) if len(n) else intact
            good = [bool(w) and merkle_root(a) == r for w, a, r in zip(whole, batch.column("addresses").to_pylist(), batch.column("root").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("start"), batch.column("n_tokens"), pa.array(combine_crcs(crc, 4 * n, bounds).astype(np.int64)), pa.array([g and s == t for g, s, t in zip(good, sums, batch.column("n_tokens").to_numpy(), strict=True)], pa.bool_())], names=[id_col, "start", "n_tokens", "ids_crc32", "verified"])

    both = placed.join(found, ["part", "row"]).join(F.broadcast(before), "part")  # before: a row for each recipe file
    slim = both.select("doc", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "root", "addresses", "got")
    schema = T.StructType([T.StructField(id_col, slim.schema[0].dataType), *(T.StructField(c, T.LongType()) for c in ("start", "n_tokens", "ids_crc32")), T.StructField("verified", T.BooleanType())])
    return in_small_batches(slim).mapInArrow(run, schema)


def reconstruct(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """A row for each recipe, those of null and repeated ids too: id_col, n_tokens, and ids, its chunks' bytes joined; null if a chunk is lost."""
    recipes, _ = checked_recipes(spark, path)
    listed = recipes.select("part", "row", "doc", "n_tokens", F.posexplode("addresses").alias("seq", "address"))
    parts = listed.join(spark.read.parquet(f"{path}/chunks"), "address", "left")
    slim = parts.groupBy("part", "row").agg(F.first("doc").alias("doc"), F.first("n_tokens").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("seq", "ids"))).alias("got"))
    slim = slim.select("doc", "n_tokens", F.col("got")["ids"].alias("got"))
    schema = T.StructType([T.StructField(id_col, slim.schema["doc"].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [None if None in (own := x.as_py()) else b"".join(own) for x in batch.column("got")]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("n_tokens"), pa.array(ids, pa.binary())], names=[id_col, "n_tokens", "ids"])

    return in_small_batches(slim).mapInArrow(run, schema)
