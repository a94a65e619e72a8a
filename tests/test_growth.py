"""Jobs whose cost goes by how often they run, not by their rows: micro-batches, claims and tasks over very many small inputs."""

import os

from pyspark.sql import functions as F

from talkmill.functions import documents
from talkmill.plans import queries
from talkmill.plans.views import view
from talkmill.sources import files, store
from talkmill.streaming import live_metrics, process
from tests.conftest import DATA
from tests.test_audio_and_streams import loud, recordings, teller  # noqa: F401


def test_reports_take_many_ranges_at_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(live_metrics, "RANGE_ROWS", 100)
    _, stream = queries.emitted(view(spark, DATA, "v_measurements"))  # 1,000 rows: ten ranges
    sizes = []
    stream.writeStream.foreachBatch(lambda batch, i: sizes.append(batch.count())).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    assert sizes == [1000]


def test_claims_of_a_source_share_their_jobs(spark, recordings, tmp_path, monkeypatch):  # noqa: F811
    log, queue, looked_up = f"{tmp_path}/states", f"{tmp_path}/queue", []
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").option("recursiveFileLookup", True).load(recordings)
    store.append_once(process.enlisted(process.discovered(found)), log, 0)
    process.queued(process.new_states(spark, log, 0), queue, 0, 1)
    contents_of = files.contents_of
    monkeypatch.setattr(files, "contents_of", lambda s, names: (looked_up.append(len(names)), contents_of(s, names))[1])
    assert process.process_claims(spark, queue, 0, log, "me", loud, ["en", "es"], {"en": teller("E"), "other": teller("O")}) == 3
    assert looked_up == [3]
    assert files.numbers(spark, log, "seq") == [0, 1, 2, 3, 4, 5, 6] and all(store.is_written(spark, log, n) for n in range(7))
    assert all(spark.read.parquet(f"{log}/seq={n}").count() == 1 for n in range(1, 7))  # two versions a claim, each with its own document
    rows = store.load_all(spark, log).collect()
    assert len(rows) == 3 and all(r.done and r.processed_by is None for r in rows) and sum(r.corrupt for r in rows) == 1


def test_versions_written_together(spark, tmp_path):
    log = f"{tmp_path}/log"
    rows = spark.createDataFrame([("a", "x", 1), ("b", "x", 3)], "uuid string, x string, seq long")
    store.append_each(rows, log, [1, 3])
    os.remove(f"{log}/seq=3/_SUCCESS")  # broken off
    store.append_each(rows.withColumn("x", F.lit("y")), log, [1, 3])
    assert {(r.uuid, r.x) for r in store.load_all(spark, log).collect()} == {("a", "x"), ("b", "y")}


def test_small_files_take_a_task_a_core(spark):
    assert process.packed(spark.range(1000).repartition(200)).rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism


def test_seen_files_are_seldom_listed_anew(spark, tmp_path):
    for i in range(12):
        (tmp_path / f"v{i}.wav").write_bytes(b"RIFF")
    stream = process.file_stream(spark, str(tmp_path), max_files=1)
    process.start_discovery(stream, f"{tmp_path}/log", f"{tmp_path}/checkpoint", availableNow=True).awaitTermination()
    seen = os.listdir(f"{tmp_path}/checkpoint/sources/0")
    assert "11" in seen and "9.compact" not in seen
    assert store.load_all(spark, f"{tmp_path}/log").count() == 12


def test_discovery_builds_its_columns_once(spark, tmp_path, monkeypatch):
    for i in range(3):
        (tmp_path / f"v{i}.wav").write_bytes(b"RIFF")
    built, new_documents = [], documents.new_documents
    monkeypatch.setattr(documents, "new_documents", lambda *a: (built.append(1), new_documents(*a))[1])
    process.start_discovery(process.file_stream(spark, str(tmp_path), max_files=1), f"{tmp_path}/log", f"{tmp_path}/checkpoint", availableNow=True).awaitTermination()
    assert built == [1] and files.numbers(spark, f"{tmp_path}/log", "seq") == [0, 1, 2]
    assert spark.read.parquet(f"{tmp_path}/log").select("uuid").distinct().count() == 3
