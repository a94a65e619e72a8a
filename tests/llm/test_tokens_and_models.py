import hashlib
import math
import shutil
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from talkmill.llm import fertility, packing, token_store, toxicity
from talkmill.llm.memo_tokens import encoder, only_within
from talkmill.llm.queries import QUERIES, vocabulary
from tests.conftest import DATA
from tests.llm.fixtures import documents, empty

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"]
ALPHABET = st.lists(st.sampled_from(list("aAbeE  \n\t.,'!-19éßİ中\x00\x01") + ["'s", "the", "\r\n", "<|endoftext|>", "<|EndOfText|>", " the ", ". The", "be, ", "1. ", "é.\n", "_, ", "e,. ", "İ. ", "\u0958, "]), max_size=30).map("".join)


@lru_cache
def library(name):
    """The plain call of the library."""
    if name.endswith(".json"):
        tokenizer = Tokenizer.from_file(vocabulary(name))
        return lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    return sentencepiece.SentencePieceProcessor(model_file=vocabulary(name)).encode


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=1500, deadline=None)
@given(text=ALPHABET)
def test_pieces_give_the_ids_of_the_whole(name, text):
    e = encoder(vocabulary(name))
    assert np.frombuffer(e.encode(text), e.dtype).tolist() == library(name)(text)


@pytest.mark.parametrize("name", FILES)
def test_a_full_memo_forgets(name):
    e = encoder(vocabulary(name))
    e.memo.clear()
    e.memo.limit, kept = 50, e.memo.limit
    for i in range(300):
        text = f"word{i} and word{i % 7}, more{i}.\nSo it goes"
        assert np.frombuffer(e.encode(text), e.dtype).tolist() == library(name)(text)
        assert len(e.memo) <= 51 and len(e.memo.former) <= 51
    e.memo.limit = kept


def test_a_pipeline_memo_goes_with_its_task(spark, tmp_path):
    vocab = shutil.copy(vocabulary("word_bpe_49k.json"), tmp_path)  # an encoder that no other test has filled
    docs = documents(spark)
    kept = packing.pack_documents(docs, vocab, memo_pieces=50).collect()

    def remembered(batches):
        for b in batches:
            memo = encoder(vocab).memo
            yield pa.RecordBatch.from_pydict({"n": [len(memo) + len(memo.former)]})

    assert spark.range(8, numPartitions=8).mapInArrow(remembered, "n long").groupBy().sum("n").first()[0] == 0
    e = encoder(vocab)
    with only_within(e, 50):
        assert e.encode("some words, and more") and 0 < len(e.memo) and e.memo.limit == 50
    assert not e.memo and not e.memo.former
    assert Counter(kept) == Counter(packing.pack_documents(docs, vocab).collect())


def ids_of(name, docs, end):
    return {d.doc_id: np.array([*library(name)(d.text or ""), end], "<u4") for d in docs}


def test_store(spark, tmp_path):
    docs = documents(spark).collect()
    ids = ids_of("byte_bpe_50k.json", docs, 0)
    token_store.build_store(documents(spark), f"{tmp_path}/s", vocabulary("byte_bpe_50k.json"))
    rows = token_store.read_documents(spark, f"{tmp_path}/s").orderBy(F.col("doc_id").asc_nulls_first(), "start").collect()
    start = 0
    assert len(rows) == len(docs)
    for r in rows:
        own = ids[r.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32, r.verified) == (start, len(own), zlib.crc32(own.tobytes()), True)
        start += len(own)
    chunks = spark.read.parquet(f"{tmp_path}/s/chunks")
    assert chunks.count() == chunks.select("address").distinct().count()
    back = token_store.reconstruct(spark, f"{tmp_path}/s").collect()
    assert Counter(r.doc_id for r in back) == Counter(d.doc_id for d in docs)
    assert all(np.frombuffer(r.ids, "<u2").tolist() == ids[r.doc_id].tolist() for r in back)
    assert spark.read.parquet(f"{tmp_path}/s/manifest").agg(F.sum("n_docs")).first()[0] == len(docs)


@pytest.fixture
def store(spark, tmp_path):
    token_store.build_store(documents(spark), f"{tmp_path}/s", vocabulary("byte_bpe_50k.json"))
    return tmp_path / "s"


def test_store_shows_a_changed_chunk(spark, store):
    chunks = spark.read.parquet(f"{store}/chunks").toPandas()
    chunks.loc[0, "ids"] = b"\x01\x00" + chunks.loc[0, "ids"][2:]
    shutil.rmtree(store / "chunks")
    (store / "chunks").mkdir()
    chunks.to_parquet(store / "chunks" / "part.parquet")
    assert token_store.read_documents(spark, str(store)).where("not verified").count() >= 1


def test_store_shows_a_lost_chunk(spark, store):
    chunks = spark.read.parquet(f"{store}/chunks").toPandas()
    shutil.rmtree(store / "chunks")
    (store / "chunks").mkdir()
    chunks[1:].to_parquet(store / "chunks" / "part.parquet")
    n = documents(spark).count()
    rows = token_store.read_documents(spark, str(store)).collect()
    assert len(rows) == n and not all(r.verified for r in rows)
    back = token_store.reconstruct(spark, str(store)).collect()
    assert len(back) == n and any(r.ids is None for r in back)


@pytest.mark.parametrize("change", ["lost", "changed", "manifest"])
def test_store_shows_damaged_recipes(spark, store, change):
    if change == "lost":
        next(p for p in (store / "recipes").iterdir() if p.suffix == ".parquet").unlink()
    else:
        folder = store / ("manifest" if change == "manifest" else "recipes")
        rows = spark.read.parquet(str(folder)).toPandas()
        rows.loc[0, "n_tokens" if change == "changed" else "root"] = 3 if change == "changed" else b"x" * 32
        shutil.rmtree(folder)
        folder.mkdir()
        rows.to_parquet(folder / "part.parquet")
    with pytest.raises(token_store.Damaged):
        token_store.read_documents(spark, str(store))


def test_tree_of_several_levels(spark, monkeypatch):
    monkeypatch.setattr(token_store, "FANOUT", 4)
    rows = [(i % 7, i // 7, bytes([i]) * 32, i) for i in range(150)]
    recipes = spark.createDataFrame(rows, "part int, row long, root binary, n_tokens long")

    def node(hashes):
        return hashlib.sha256(b"\x02" + b"".join(hashes)).digest()

    def tree(hashes):
        while True:
            hashes = [node(hashes[i : i + 4]) for i in range(0, len(hashes), 4)]
            if len(hashes) == 1:
                return hashes[0]

    want = [tree([hashlib.sha256(b"\x00" + r + str(n).encode()).digest() for p, _, r, n in rows if p == part]) for part in range(7)]
    got = token_store.file_roots(recipes)
    assert [bytes(r.root) for r in got.orderBy("part").collect()] == want
    assert bytes(token_store.top_root(got).first().root) == tree(want)


def test_store_of_nothing(spark, tmp_path):
    token_store.build_store(empty(spark), f"{tmp_path}/s", vocabulary("byte_bpe_50k.json"))
    assert token_store.read_documents(spark, f"{tmp_path}/s").count() == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.binary(max_size=300), min_size=1, max_size=8))
def test_crc_of_parts(parts):
    crcs, sizes = np.array([zlib.crc32(p) for p in parts], np.uint32), np.array([len(p) for p in parts])
    got = token_store.combine_crcs(crcs, sizes, np.array([0, len(parts)]))
    assert int(got[0]) == zlib.crc32(b"".join(parts))


def plain_cuts(ids):
    """Ends of a document's chunks, an id at a time."""
    full, out, last = (1 << 64) - 1, [], 0

    def mixed(x):
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & full
        x = (x ^ x >> 27) * 0x94D049BB133111EB & full
        return x ^ x >> 31

    for at in range(1, len(ids) + 1):
        seen = ids[max(0, at - token_store.WINDOW) : at][::-1]
        rolled = sum(mixed(int(x) + 1) << 7 * i for i, x in enumerate(seen)) & full
        allowed = mixed(rolled) % token_store.MEAN == 0 and at - last >= token_store.LEAST
        if allowed or at - last == token_store.MOST or at == len(ids):
            out.append(at)
            last = at
    return out


def test_cuts(monkeypatch):
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 50_000, n) for n in (1, 127, 128, 129, 1, 5_000, 20_000, 0, 3)] + [np.zeros(9_000, np.int64)]
    want = [plain_cuts(d) for d in docs]
    for stretch in (token_store.STRETCH, 1_000, 3):
        monkeypatch.setattr(token_store, "STRETCH", stretch)
        assert token_store.cuts_of_each(np.concatenate(docs), np.cumsum([0, *map(len, docs)])) == want
    assert token_store.cuts_of_each(np.zeros(0, np.int64), np.array([0])) == []
    moved = plain_cuts(np.concatenate((rng.integers(0, 50_000, 333), docs[6])))
    assert len(set(want[6]) & {x - 333 for x in moved}) > 0.8 * len(want[6])


def test_packing(spark):
    docs = documents(spark).collect()
    ids = ids_of("word_bpe_49k.json", docs, 1)
    rows = packing.pack_documents(documents(spark), vocabulary("word_bpe_49k.json"), capacity=256, group=8).collect()
    seen, sequences = Counter(), {}
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == ids[r.doc_id][r.start : r.start + r.length].tolist() and r.doc_tokens == len(ids[r.doc_id])
        seen.update({(r.doc_id, i): 1 for i in range(r.start, r.start + r.length)})
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    copies = Counter(d.doc_id for d in docs)
    assert seen == Counter({(d, i): copies[d] for d in copies for i in range(len(ids[d]))})
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= 256 and at & (at - 1) == 0  # full, or a power of two
    assert packing.pack_documents(empty(spark), vocabulary("word_bpe_49k.json")).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 3), max_size=5), st.integers(0, 40))
def test_fill_is_best(counts, capacity):
    sums = {0}
    for k, n in counts.items():
        sums |= {s + k * i for s in sums for i in range(n + 1)}
    taken = packing.fill(counts, capacity)
    assert all(n <= counts[k] for k, n in taken.items())
    assert sum(k * n for k, n in taken.items()) == max(s for s in sums if s <= capacity)


def plain_ftrl(examples, labels, bits, passes, alpha, beta, l1, l2):
    """The published per-coordinate update, a coordinate at a time."""
    z, n = {}, {}

    def weight(i):
        zi = z.get(i, 0.0)
        if abs(zi) <= l1:
            return 0.0
        return -(zi - (l1 if zi > 0 else -l1)) / ((beta + n.get(i, 0.0) ** 0.5) / alpha + l2)

    for _ in range(passes):
        for own, y in zip(examples, labels, strict=True):
            at = [*own, 1 << bits]
            w = {i: weight(i) for i in at}
            g = 1 / (1 + math.exp(-sum(w.values()))) - y
            for i in at:
                rate = ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / alpha
                z[i] = z.get(i, 0.0) + g - rate * w[i]
                n[i] = n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z if weight(i)}


def test_ftrl_equals_a_plain_version():
    rng = np.random.default_rng(5)
    examples = [np.unique(rng.integers(0, 64, 9)) for _ in range(120)]
    labels = np.array([int(3 in x or 7 in x) for x in examples])
    options = {"bits": 6, "passes": 3, "alpha": 0.3, "beta": 1.0, "l1": 0.5, "l2": 1.0}
    got = toxicity.ftrl(examples, labels, **options)
    want = plain_ftrl([x.tolist() for x in examples], labels.tolist(), **options)
    assert len(want) > 5 and {i: pytest.approx(w, abs=1e-9) for i, w in want.items()} == {int(i): got[i] for i in np.flatnonzero(got)}


def test_fertility_measures(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    texts = {d.doc_id: d.text or "" for d in documents(spark).collect()}
    rows = fertility.measure(documents(spark), vocabulary("piece_bpe_32k.model")).collect()
    assert len(rows) == documents(spark).count()
    for r in rows:
        ids = model.encode(texts[r.doc])
        share = np.array([*Counter(ids).values()]) / max(1, len(ids))
        n_bytes = sum(model.is_byte(i) for i in ids)
        assert (r.n_tokens, r.n_bytes) == (len(ids), n_bytes)
        assert (r.chars_per_token, r.byte_share, r.entropy) == pytest.approx((len(texts[r.doc]) / max(1, len(ids)), n_bytes / max(1, len(ids)), -(share * np.log2(share)).sum()))


def toxic_rows(spark, n=900):
    rng = np.random.default_rng(3)
    plain = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(n):
        words, bad = list(rng.choice(plain, 60)), bool(rng.random() < 0.2)
        if bad:
            words[int(rng.integers(0, 60))] = str(rng.choice(["dolt", "cretin", "loathsomer", "loathsomest"]))
        rows.append((i, " ".join(words), int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_toxicity_held_out(spark):
    rows = toxic_rows(spark)
    weights = toxicity.fit(rows.select("doc_id", "text"), rows.select("doc_id", "toxic").where(~toxicity.held_out()))
    scored = toxicity.score(rows, weights).where(toxicity.held_out()).collect()
    right = sum((r.score >= toxicity.THRESHOLD) == (r.toxic == 1) for r in scored) / len(scored)
    assert len(scored) > 100 and right > 0.95 and len(weights) < 5000


def test_toxicity_odd_cases(spark):
    weights = toxicity.fit(toxic_rows(spark, 200).select("doc_id", "text"), toxic_rows(spark, 200).select("doc_id", "toxic"))
    out = toxicity.score(documents(spark), weights)
    assert out.count() == documents(spark).count() and out.where("score is null or score < 0 or score > 1").count() == 0
    assert out.where("text is null or text = ''").select("score").distinct().count() == 1
    none = toxicity.fit(documents(spark), spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.score for r in toxicity.score(documents(spark), none).collect()} == {0.0}
    assert toxicity.score(empty(spark), weights).count() == 0


def test_queries_without_sql(spark):
    n = spark.read.parquet(f"{DATA}/documents.parquet").count()
    for name in ("op1_fertility", "op3_near_dup", "op5_pii", "op9_toxicity"):
        assert QUERIES[name](spark, DATA).count() == n
