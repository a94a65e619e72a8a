import numpy as np
import pytest

from talkmill.llm import stages
from tests.conftest import DATA
from tests.llm.fixtures import BLANKS, LOWER, documents
from tests.llm.test_text_operators import brute_components, item_words, shingles
from tests.llm.test_tokens_and_models import library

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    bench = spark.read.parquet(f"{DATA}/benchmark.parquet").first()
    rows = docs.limit(60).collect()
    rows += [(9001, rows[5].text, "en", "x", 1), (9002, f"some words\n{bench.text}\nmore words", "en", "x", 1), (None, None, None, None, None), (9003, "", None, None, 0)]
    df = spark.createDataFrame([tuple(r) for r in rows], docs.schema)
    kept = stages.drop_toxic(spark, df, DATA)
    assert kept.columns == docs.columns and 0 < kept.count() <= len(rows)
    lined = stages.drop_repeated_lines(spark, df, DATA)
    assert lined.columns == docs.columns and lined.count() == len(rows)
    assert lined.where("n_chars <> length(text)").count() == 0
    near = {r.doc_id for r in stages.drop_near_duplicates(spark, df, DATA).collect()}
    assert 9001 not in near and rows[5].doc_id in near and {None, 9003} <= near
    clean = {r.doc_id for r in stages.drop_contaminated(spark, df, DATA).collect()}
    assert 9002 not in clean and {None, 9003} <= clean
    assert stages.pack(spark, df.limit(5), DATA).count() >= 5


def test_run_equals_a_plain_version(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    texts = {r.doc_id: r.text for r in stages.drop_toxic(spark, docs, DATA).collect()}  # scores come from the fitted weights
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    held = {}
    for d, t in texts.items():
        for line in (t or "").split("\n"):
            held.setdefault(key(line), set()).add(d)
    gone = {k: min(ids) for k, ids in held.items() if len(k) >= 10 and len(ids) > 1}
    texts = {d: "\n".join(x for x in (t or "").split("\n") if gone.get(key(x), d) == d) for d, t in texts.items()}
    root = brute_components({d: shingles(t) for d, t in texts.items()}, 80)
    texts = {d: t for d, t in texts.items() if root[d] == d}
    windows = {}
    for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect():
        w = item_words(r.text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(len(w[i : i + 10]), set()).add(tuple(w[i : i + 10]))
    clean = {}
    for d, t in texts.items():
        w = item_words(t)
        if not any(tuple(w[i : i + k]) in some for k, some in windows.items() for i in range(len(w) - k + 1)):
            clean[d] = t
    assert 0 < len(clean) < len(texts) < docs.count()
    pieces = {}
    for r in corpus_pipeline.run(spark, DATA).collect():
        pieces.setdefault(r.doc_id, []).append((r.start, np.frombuffer(r.ids, "<u4").tolist(), r.length))
    assert set(pieces) == set(clean)
    for d, own in pieces.items():
        ids, at = [], 0
        for start, more, length in sorted(own):
            assert start == at and length == len(more)
            ids, at = ids + more, at + length
        assert ids == [*library("word_bpe_49k.json")(clean[d]), 1]


def test_run_over_nothing(spark, tmp_path):
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{DATA}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_keep_other_columns(spark):
    docs = documents(spark).withColumnsRenamed({"word": "kept", "n_words": "component_id"})
    for stage in (stages.drop_toxic, stages.drop_repeated_lines, stages.drop_near_duplicates, stages.drop_contaminated):
        out = stage(spark, docs, DATA)
        assert out.columns == docs.columns and {r.kept for r in out.select("kept").distinct().collect()} <= {"w", None}
