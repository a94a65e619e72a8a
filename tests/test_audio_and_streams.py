import json
import math
import struct
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from talkmill.operators import audio, inference, metrics
from talkmill.plans import jobs
from talkmill.plans.views import view
from talkmill.sources import files, store
from talkmill.streaming import live_metrics, process
from tests.conftest import DATA


def write_wav(path, rate=8000, channels=1, seconds=0.5, silence=0.0, hz=440):
    n, quiet = int(rate * seconds), int(rate * silence)
    tone = [0] * quiet + [int(20000 * math.sin(2 * math.pi * hz * i / rate)) for i in range(n - quiet)]
    with wave.open(str(path), "wb") as f:
        f.setnchannels(channels)
        f.setsampwidth(2)
        f.setframerate(rate)
        f.writeframes(b"".join(struct.pack("<h", v) * channels for v in tone))


@pytest.fixture
def recordings(tmp_path):
    root = tmp_path / "rec"
    (root / "sub").mkdir(parents=True)
    write_wav(root / "a.wav")
    write_wav(root / "sub" / "b.wav", rate=16000, channels=2, seconds=1.0, silence=0.4)
    (root / "bad.wav").write_bytes(b"RIFF____WAVE")
    (root / "note.txt").write_text("x")
    return str(root)


def loud():
    return lambda arrays: [1 if len(a) > 10_000 else 0 for a in arrays]


def teller(name):
    return lambda: lambda arrays: [[f"{name} {len(a)}"] for a in arrays[:-1]] + [type("Hypothesis", (), {"text": name})() for _ in arrays[-1:]]


def test_inventory(spark, recordings):
    assert sorted(r.basename for r in files.inventory(spark, recordings).collect()) == ["a", "b", "bad"]
    assert files.inventory(spark, recordings, audio_only=False).count() == 4
    plan = files.inventory(spark, recordings)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]


def test_decode(spark, recordings):
    good, bad = audio.split_valid(audio.load(files.contents(spark, recordings)))
    rows = {r.path.rsplit("/", 1)[1]: r for r in good.collect()}
    assert rows["a.wav"].sample_rate == 8000 and rows["a.wav"].duration == 0.5 and len(rows["b.wav"].channels) == 2
    assert bad.count() == 1 and audio.probe(files.contents(spark, recordings)).where("duration is null").count() == 1


def test_resample_keeps_the_tone():
    t = np.arange(8000) / 8000
    out = audio.resample(np.sin(2 * np.pi * 440 * t).astype(np.float32), 8000)
    want = np.sin(2 * np.pi * 440 * np.arange(len(out)) / 16000)
    assert len(out) == 16000 and np.abs(out - want)[200:-200].max() < 0.01


def test_trim():
    x = np.concatenate((np.zeros(6400, np.float32), np.ones(1600, np.float32)))
    assert len(audio.trim_silence(x)) == 1600 and len(audio.trim_silence(np.zeros(100, np.float32))) == 100


def test_preprocess(spark, recordings):
    rows = {r.path.rsplit("/", 1)[1]: r for r in audio.preprocess(files.contents(spark, recordings)).collect()}
    assert rows["bad.wav"].samples is None and rows["bad.wav"].error
    assert rows["b.wav"].duration == 1.0 and abs(len(rows["b.wav"].samples) - 9600) <= 320 and len(rows["a.wav"].samples) == 8000


def test_backends(spark):
    df = spark.createDataFrame([([0.0] * n,) for n in (5, 20_000, 7)], "samples array<float>").coalesce(1)
    assert [r.i for r in df.select(inference.label_indexes(F.col("samples"), loud).alias("i")).collect()] == [0, 1, 0]

    def broken():
        def predict(arrays):
            raise RuntimeError

        return predict

    assert [r.i for r in df.select(inference.label_indexes(F.col("samples"), broken).alias("i")).collect()] == [0, 0, 0]
    short = df.select(inference.transcripts(F.col("samples"), lambda: lambda arrays: ["only"]).alias("t"))
    assert [r.t for r in short.collect()] == ["only", "", ""]
    assert [inference.normalised(x) for x in (["a"], [], None, "s", type("H", (), {"text": "h"})())] == ["a", "", "", "s", "h"]


def test_routes_without_a_backend_pass_through(spark):
    df = spark.createDataFrame([([0.0] * n, r) for n, r in ((5, "en"), (7, "corrupt"), (6, "en"), (8, "other"), (9, None))], "samples array<float>, route string").coalesce(1)
    out = inference.transcribe_routes(df, {"en": teller("E"), "other": teller("O")})
    assert sorted(map(str, (r.transcript for r in out.collect()))) == ["E", "E 5", "None", "None", "O"]


def test_each_file_is_decoded_and_identified_once(spark, recordings):
    with process.processed(files.contents(spark, recordings), loud, ["en", "es"], {"en": teller("E"), "other": teller("O")}) as rows:
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        cached = rows._jdf.queryExecution().withCachedData().toString()
        assert rows.count() == 3
    assert plan.count("label_indexes") + plan.count("identify(") == 1 and plan.count("transcribe(") == 1
    assert plan.count("InMemoryRelation") == cached.count("InMemoryRelation") == 2  # the one table, read for sound and for errors
    assert plan.count("MapInPandas") == 2  # as the plan of that table, shown with each reading


def test_drop_others(spark, recordings, tmp_path):
    out = jobs.job_process(spark, recordings, f"{tmp_path}/log", loud, ["en", "es"], {"en": teller("E")}, drop_others=True)
    rows = {r.basename: r for r in out.collect()}
    assert set(rows) == {"a", "b", "bad"}
    assert rows["a"].corrupt and rows["a"].transcript is None and rows["a"].done and rows["bad"].corrupt
    out = jobs.job_process(spark, recordings, f"{tmp_path}/log2", loud, ["en", "es"], {"en": teller("E")}, all_english=True)
    rows = {r.basename: r for r in out.collect()}
    assert not rows["a"].corrupt and rows["a"].transcript[0] == "E"


def test_claims(spark, recordings, tmp_path):
    log = f"{tmp_path}/states"
    old = spark.createDataFrame([("u1", "gone", "/nowhere/gone.wav", True, "other", False), ("u2", "late", "/nowhere/late.wav", False, None, False), ("u3", "mine", "/nowhere/mine.wav", True, "me", False)], "uuid string, basename string, filename string, claim_present boolean, processed_by string, done boolean")
    store.append(process.enlisted(old), log, -1)
    stream = process.file_stream(spark, recordings, max_files=2)
    process.start_claims(stream, log, f"{tmp_path}/queue", "me", f"{tmp_path}/c", loud, ["en", "es"], {"en": teller("E"), "other": teller("O")}, rows=1, availableNow=True).awaitTermination(240)
    rows = {r.basename: r for r in store.load_all(spark, log).collect()}
    assert set(rows) == {"a", "b", "bad", "gone", "late", "mine"}
    assert not rows["gone"].done and rows["gone"].processed_by == "other"  # another worker's claim
    assert all(rows[n].done and rows[n].corrupt and rows[n].transcript is None for n in ("late", "mine", "bad"))
    assert all(rows[n].done and not rows[n].corrupt and rows[n].transcript for n in ("a", "b")) and rows["a"].processed_by is None


def test_a_silent_stream_is_reported_and_stopped(spark, tmp_path):
    rows = view(spark, DATA, "v_measurements").select("program", "name", F.col("value").cast("double").alias("value"), "seq", "ts")
    rows.repartition(1).write.parquet(f"{tmp_path}/in")
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    live_metrics.use_rocksdb(spark)
    try:
        stream = spark.readStream.schema(live_metrics.MEASUREMENT).parquet(f"{tmp_path}/in")
        assert live_metrics.report_until_idle(stream, 1.0, f"{tmp_path}/log", f"{tmp_path}/report", f"{tmp_path}/c", "1", "now", timeout=120)
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)
    saved = spark.read.json(f"{tmp_path}/report")
    assert saved.where("expired").count() == saved.count() == rows.select("program").distinct().count()
    assert not spark.streams.active


def test_job_process(spark, recordings, tmp_path):
    out = jobs.job_process(spark, recordings, f"{tmp_path}/log", loud, ["en", "es"], {"en": teller("E"), "other": teller("O")})
    rows = {r.basename: r for r in out.collect()}
    assert rows["bad"].corrupt and rows["bad"].done and rows["a"].language == "es" and rows["a"].transcript[0] == "O"
    assert not rows["b"].corrupt and rows["b"].done


def test_job_discover_and_cleanup(spark, recordings):
    cat = spark.createDataFrame([("u", "a", True, False, 1)], "uuid string, basename string, done boolean, corrupt boolean, created_at int")
    assert {r.basename: r.action for r in jobs.job_discover(spark, recordings, cat).collect()} == {"a": "deleted", "b": "added", "bad": "added"}
    assert sorted(r.basename for r in jobs.job_cleanup_plan(spark, recordings, cat).collect()) == ["b", "bad", "note"]


def test_job_reconcile(spark):
    plans = jobs.job_reconcile(view(spark, DATA, "v_listing"), view(spark, DATA, "v_catalog").withColumn("created_at", F.col("created_seq")), view(spark, DATA, "v_local"), view(spark, DATA, "v_local").select("basename", "local_size"))
    assert plans["outcomes"].count() == 200 and plans["create"].count() > 0 and plans["outcomes"].where("outcome = 'UNKNOWN'").count() == 0


def test_streams(spark, recordings, tmp_path):
    found, done = f"{tmp_path}/found", f"{tmp_path}/done"
    process.start_discovery(process.file_stream(spark, recordings), found, f"{tmp_path}/c1", availableNow=True).awaitTermination(120)
    assert sorted(r.basename for r in store.load_all(spark, found).collect()) == ["a", "b", "bad"]
    process.start_processing(process.file_stream(spark, recordings, max_files=2), done, f"{tmp_path}/c2", loud, ["en", "es"], {"en": teller("E"), "other": teller("O")}, availableNow=True).awaitTermination(180)
    rows = {r.basename: r for r in store.load_all(spark, done, "basename").collect()}
    assert set(rows) == {"a", "b", "bad"} and rows["bad"].corrupt and all(r.done for r in rows.values())


def test_live_metrics_equal_the_batch(spark, tmp_path):
    rows = view(spark, DATA, "v_measurements").select("program", "name", F.col("value").cast("double").alias("value"), "seq", "ts")
    rows.repartition(1).write.parquet(f"{tmp_path}/in")
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    live_metrics.use_rocksdb(spark)
    got = []
    try:
        stream = live_metrics.program_status(spark.readStream.schema(live_metrics.MEASUREMENT).parquet(f"{tmp_path}/in"))
        query = stream.writeStream.outputMode("update").foreachBatch(lambda b, i: got.extend(b.collect())).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
        assert query.awaitTermination(240)
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)
    live = {r.program: r for r in got}
    for r in metrics.counters(rows).join(metrics.blocking(rows), "program").collect():
        own = live[r.program]
        assert all(abs(own[c] - r[c]) < 1e-3 for c in ("count", "bytes", "duration", "blocked")), r
        assert own.open_start == pytest.approx(r.open_start) if r.open_start else own.open_start is None or math.isnan(own.open_start)


def test_ranges_of_a_program_are_folded_apart(spark, same, monkeypatch):
    from talkmill.plans import queries

    folders = []
    write = live_metrics.write_ranges
    monkeypatch.setattr(live_metrics, "RANGE_ROWS", 150)
    monkeypatch.setattr(live_metrics, "write_ranges", lambda rows, path: (folders.append(path), write(rows, path)))
    same(queries.QUERIES["R6"](spark, DATA), queries.ORACLES["R6"])
    sizes = spark.read.parquet(folders[0]).groupBy("range").count().collect()
    assert len(sizes) > 3 and max(r["count"] for r in sizes) < 450


def test_idle_timer_state():
    state = live_metrics.new_state()
    for name, value, ts in [("stop_blocking", 0, 1), ("start_blocking", 0, 2), ("start_blocking", 0, 3), ("stop_blocking", 0, 5), ("count", 4, 6), ("count", None, 7), ("start", 1, 8)]:
        state = live_metrics.fold(state, name, value, ts)
    assert (state["blocked"], state["count"], state["start"], state["last_ts"]) == (2, 4.0, 1, 8)


def test_jsonl(spark, tmp_path):
    from talkmill.functions import documents

    (tmp_path / "in").write_text(json.dumps({"uuid": "u", "processed_by": "h", "dialog": [{"size_bytes": 3, "filename": "f"}], "analysis": [{"type": "t", "body": {"q": [1]}}]}))
    store.export_jsonl(store.read_json(spark, f"{tmp_path}/in"), f"{tmp_path}/out")
    row = json.loads(spark.read.text(f"{tmp_path}/out").first().value)
    assert "processed_by" not in row and row["dialog"] == [{"filename": "f"}] and row["analysis"][0]["body"] == {"q": [1]}
    assert [r.filename for r in store.recording_urls(store.read_json(spark, f"{tmp_path}/in")).collect()] == ["f"]
    assert documents.FORMAT_VERSION == row["vcon"]
