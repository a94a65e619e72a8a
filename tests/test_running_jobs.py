"""Claims, padding, counters, statuses, decoders, snapshots and inventories of running jobs."""

import io
import math
import os
import random
import time
import wave
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from talkmill.operators import audio, inference
from talkmill.plans import jobs
from talkmill.plans.views import view
from talkmill.sources import files, store
from talkmill.streaming import live_metrics, process
from tests.conftest import DATA
from tests.test_audio_and_streams import loud, recordings, teller, write_wav  # noqa: F401

# Padding


def test_a_long_recording_leaves_others_short(spark):
    rng = random.Random(1)
    durations = [rng.uniform(1, 4) for _ in range(1000)] + [3 * 3600.0]
    rows = spark.createDataFrame([(i, d, [1.0]) for i, d in enumerate(durations)], "id long, duration double, samples array<float>").repartition(4)
    got = {r.id: r.n for r in process.padded(rows, rate=2).select("id", F.size("samples").alias("n")).collect()}
    assert got[1000] == 3 * 3600 * 2 and all(got[i] >= math.floor(2 * d) for i, d in enumerate(durations))
    assert sum(got[i] > 8 for i in range(1000)) <= 10 and len(set(got.values())) > 3
    few = {r.id: r.n for r in process.padded(rows.where("id < 8"), rate=100).select("id", F.size("samples").alias("n")).collect()}
    assert set(few.values()) == {int(100 * max(durations[:8]))}  # one batch, as long as its longest
    plan = process.padded(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan


def test_backends_get_arrays_of_one_length(spark):
    rng = random.Random(2)
    lengths = [rng.choice([3, 3, 5, 9]) for _ in range(100)]
    rows = spark.createDataFrame([(i, [float(i)] * n, "en" if i % 3 else "other") for i, n in enumerate(lengths)], "id long, samples array<float>, route string").coalesce(1)

    def told():
        return lambda arrays: [f"{int(a[0])} {len(arrays)} {len({len(x) for x in arrays})}" for a in arrays]

    def first():
        return lambda arrays: [int(a[0]) for a in arrays]

    out = inference.transcribe_routes(rows.withColumn("i", inference.label_indexes(F.col("samples"), first, even=True)), {"en": told}, even=True).collect()
    for r in out:
        assert r.i == r.id
        if r.id % 3:
            own, at_once, kinds = map(int, r.transcript.split())
            assert own == r.id and at_once <= inference.BATCH and kinds == 1
        else:
            assert r.transcript is None


# Claims


def test_claims_do_not_read_log_or_folder(spark, recordings, tmp_path, monkeypatch):  # noqa: F811
    log, queue = f"{tmp_path}/states", f"{tmp_path}/queue"
    for i in range(40):
        write_wav(f"{recordings}/x{i}.wav", seconds=0.05)
    old = [(f"u{i}", f"x{i}", f"file:{recordings}/x{i}.wav", i) for i in range(40)]
    docs = spark.createDataFrame(old, "uuid string, basename string, filename string, age long").select("uuid", "basename", "filename", F.timestamp_seconds("age").alias("created_at"))
    for i in range(30):  # a long log
        store.append(process.enlisted(docs.where(f"uuid = 'u{i}'")), log, i - 40)
    store.append(process.enlisted(docs), log, -1)
    read = []
    load_all, inventory, parquet = store.load_all, files.inventory, type(spark.read).parquet
    monkeypatch.setattr(store, "load_all", lambda *a, **k: (read.append("log"), load_all(*a, **k))[1])
    monkeypatch.setattr(files, "inventory", lambda *a, **k: (read.append("folder"), inventory(*a, **k))[1])
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, *paths: (read.extend(p for p in paths if "claim=" in p), parquet(self, *paths))[1])
    process.take_up(spark, queue, log, "me", loud, ["en", "es"], {"en": teller("E"), "other": teller("O")}, rows=7)
    assert read.count("log") == 1 and "folder" not in read
    claims = [p for p in read if "claim=" in p]
    assert len(claims) == len(set(claims)) == 6  # 40 documents, 7 at once, each folder once
    oldest = [r.uuid for r in spark.read.parquet(claims[0]).collect()]
    assert sorted(oldest) == sorted(f"u{i}" for i in range(7))
    done = load_all(spark, log).collect()
    assert len(done) == 40 and all(r.done and not r.corrupt and r.transcript for r in done)


def test_a_batch_that_runs_again_does_no_work_twice(spark, recordings, tmp_path):  # noqa: F811
    log, queue, calls = f"{tmp_path}/states", f"{tmp_path}/queue", f"{tmp_path}/calls"
    os.makedirs(calls)

    def noted():
        def predict(arrays):
            open(f"{calls}/{time.time_ns()}-{len(arrays)}", "w").close()
            return [1 for _ in arrays]

        return predict

    args = (log, "me", noted, ["en", "es"], {"other": teller("O")})
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").option("recursiveFileLookup", True).load(recordings)
    source = 1 << process.SHIFT

    def run():
        store.append_once(process.enlisted(process.discovered(found)), log, source)
        process.queued(process.new_states(spark, log, source), queue, source, 1)
        return process.process_claims(spark, queue, source, *args)

    assert run() == 3
    first, n = {r.uuid: r for r in store.load_all(spark, log).collect()}, len(os.listdir(calls))
    assert len(first) == 3 and n == 2 and sum(r.corrupt for r in first.values()) == 1
    assert run() == 0 and len(os.listdir(calls)) == n
    assert {r.uuid: r for r in store.load_all(spark, log).collect()} == first
    process.take_up(spark, queue, *args)  # and nothing is left for another start
    assert len(os.listdir(calls)) == n and store.load_all(spark, log).count() == 3


def test_a_broken_claim_is_taken_up(spark, recordings, tmp_path):  # noqa: F811
    log, queue = f"{tmp_path}/states", f"{tmp_path}/queue"
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").option("recursiveFileLookup", True).load(recordings)
    source = 1 << process.SHIFT
    store.append_once(process.enlisted(process.discovered(found)), log, source)  # broken off before the queue was written

    def broken():
        raise RuntimeError("no model")

    with pytest.raises(Exception, match="no model"):
        process.take_up(spark, queue, log, "me", broken, ["en"], {"en": teller("E")}, rows=2)
    assert not any(r.done for r in store.load_all(spark, log).collect() if r.transcript)
    process.take_up(spark, queue, log, "me", loud, ["en", "es"], {"en": teller("E"), "other": teller("O")}, rows=2)
    rows = store.load_all(spark, log).collect()
    assert len(rows) == 3 and all(r.done and r.processed_by is None for r in rows) and sum(r.corrupt for r in rows) == 1


# Counters and statuses


def test_observed_counters_equal_the_log(spark, recordings, tmp_path):  # noqa: F811
    log, measured = f"{tmp_path}/log", f"{tmp_path}/measured"
    jobs.job_process(spark, recordings, log, loud, ["en", "es"], {"en": teller("E")}, measured=measured, program="job")
    got = {r.name: r.value for r in live_metrics.emitted(spark, measured).collect()}
    rows = store.load_all(spark, log, "basename").collect()
    sizes = sum(os.path.getsize(r.filename.removeprefix("file:")) for r in rows)
    assert got == {"count": 3.0, "bytes": float(sizes), "duration": 1.5} and sum(r.duration or 0 for r in rows) == 1.5


def plain_fold(rows):
    state = live_metrics.new_state()
    for name, value, ts in rows:
        value = None if value is None or math.isnan(value) else value
        if name in ("start_blocking", "stop_blocking"):
            if not state["marked"] and name == "stop_blocking":
                state["first_stop"] = ts
            state["marked"] = 1.0
            if name == "start_blocking":
                state["open_start"] = ts
            elif state["open_start"] is not None:
                state["blocked"], state["open_start"] = state["blocked"] + ts - state["open_start"], None
            continue
        state["last_ts"] = ts
        if name in ("start", "stop"):
            state[name] = value
        else:
            state[name] += value or 0.0
    return state


@pytest.mark.parametrize("seed", range(20))
def test_folding_arrays_equals_folding_rows(seed):
    rng = random.Random(seed)
    names = ["count", "bytes", "duration", "start", "stop", "start_blocking", "stop_blocking"]
    rows = [(rng.choice(names), rng.choice([None, math.nan, 1.0, 2.5]), float(i)) for i in range(rng.choice([1, 2, 7, 60]))]
    frame = pd.DataFrame(rows, columns=["name", "value", "ts"]).assign(seq=range(len(rows))).astype({"value": "float64"})
    cut = rng.randrange(len(rows) + 1)
    state = live_metrics.new_state()
    for some in (frame[:cut], frame[cut:]):
        if len(some):
            state = live_metrics.folded(state, some.sample(frac=1, random_state=seed))
    want = plain_fold(rows)
    assert state == pytest.approx(want)


def test_presummed_rows_keep_marks_and_sums(spark):
    rows = view(spark, DATA, "v_measurements").select("program", "name", F.col("value").cast("double").alias("value"), "seq", "ts")
    few = live_metrics.presummed(rows.repartition(2))
    marks = rows.where(F.col("name").isin("start_blocking", "stop_blocking"))
    assert few.exceptAll(few.where("name in ('count', 'bytes', 'duration')")).exceptAll(marks).count() == 0
    assert few.count() <= marks.count() + 2 * 7 * 3
    a, b = ({(r.program, r.name): r.v for r in x.groupBy("program", "name").agg(F.sum("value").alias("v")).collect() if r.name in live_metrics.SUMS} for x in (rows, few))
    assert a == pytest.approx(b)


def test_the_listener_wakes_for_a_failed_query(spark, tmp_path):
    rows = view(spark, DATA, "v_measurements").select("program", "name", F.col("value").cast("double").alias("value"), "seq", "ts")
    rows.withColumn("ts", F.lit("x")).write.parquet(f"{tmp_path}/in")  # not of the schema
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    live_metrics.use_rocksdb(spark)
    began = time.monotonic()
    try:
        stream = spark.readStream.schema(live_metrics.MEASUREMENT).parquet(f"{tmp_path}/in")
        with pytest.raises(Exception):
            live_metrics.report_until_idle(stream, 1.0, f"{tmp_path}/log", f"{tmp_path}/report", f"{tmp_path}/c", "1", "now", timeout=300)
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)
    assert time.monotonic() - began < 120 and not spark.streams.active


# Sound


def squeezed(content):
    return audio.decode_wav(zlib.decompress(content))


def wav_bytes(seconds=0.5, rate=8000):
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(2)
        f.setframerate(rate)
        f.writeframes((np.sin(np.arange(int(seconds * rate))) * 9000).astype("<i2").tobytes())
    return out.getvalue()


def test_decoders_by_media_type(spark, recordings, tmp_path):  # noqa: F811
    for name, content in (("c.mp3", zlib.compress(wav_bytes())), ("D.MP3", zlib.compress(wav_bytes(0.25))), ("broken.mp3", b"no"), ("e.flac", b"fLaC")):
        with open(f"{recordings}/{name}", "wb") as f:
            f.write(content)
    found = files.contents(spark, recordings, ("wav", "mp3", "MP3", "flac"))
    loaded = {r.path.rsplit("/", 1)[1]: r for r in audio.load(found, {"audio/mpeg": squeezed}).collect()}
    assert (loaded["c.mp3"].sample_rate, loaded["c.mp3"].duration, loaded["D.MP3"].duration, loaded["a.wav"].duration) == (8000, 0.5, 0.25, 0.5)
    assert loaded["broken.mp3"].error and loaded["e.flac"].error == "ValueError: no decoder for audio/flac" and loaded["broken.mp3"].channels is None
    assert {r.path.rsplit("/", 1)[1] for r in audio.probe(found, {"audio/mpeg": squeezed}).where("duration is null").collect()} == {"bad.wav", "broken.mp3", "e.flac"}
    out = jobs.job_process(spark, recordings, f"{tmp_path}/log", loud, ["en", "es"], {"en": teller("E"), "other": teller("O")}, extensions=("wav", "mp3", "MP3"), decoders={"audio/mpeg": squeezed})
    rows = {r.basename: r for r in out.collect()}
    assert set(rows) == {"a", "b", "bad", "c", "D", "broken"}
    assert rows["c"].transcript and not rows["c"].corrupt and rows["broken"].corrupt and rows["bad"].corrupt


@pytest.mark.parametrize("rate,target", [(8000, 16000), (44100, 16000), (48000, 16000), (16000, 11025), (7, 3), (3, 7)])
def test_filter_bank_equals_the_sum_over_taps(rate, target):
    x, taps = np.random.default_rng(3).normal(size=(2, 501)).astype(np.float32), 16
    out = audio.resample(x, rate, target)
    cut = min(1.0, target / rate)
    half = math.ceil(taps / cut)
    assert out.shape == (2, -(-501 * target // rate)) and np.array_equal(audio.resample(x[0], rate, target), out[0])
    for i in (0, 1, 57, out.shape[1] // 2, out.shape[1] - 1):
        at = i * rate / target
        want = np.zeros(2)
        for j in range(max(0, math.floor(at) - half + 1), min(501, math.floor(at) + half + 1)):
            d = at - j
            if abs(d) < half:
                want += x[:, j] * cut * np.sinc(cut * d) * (0.5 + 0.5 * math.cos(math.pi * d / half))
        assert np.allclose(out[:, i], want, atol=1e-6)


def test_a_click_does_not_hide_quiet_speech():
    rng, n = np.random.default_rng(5), int(audio.RATE * audio.FRAME_SECONDS)
    noise, speech = rng.normal(0, 1e-3, n * 50), rng.normal(0, 3e-2, n * 100)
    sound = np.concatenate((noise, speech)).astype(np.float32)
    clicked = sound.copy()
    clicked[n * 120 : n * 121] = 1.0
    assert len(audio.trim_silence(sound)) == len(audio.trim_silence(clicked)) == n * 100
    rising = np.concatenate((noise, *(rng.normal(0, s, n) for s in (5e-3, 8e-3, 12e-3)), speech))
    assert n * 100 < len(audio.trim_silence(rising)) <= n * 103  # back over the quieter beginning
    flat = np.sin(np.arange(n * 30)).astype(np.float32)
    assert len(audio.trim_silence(flat)) == len(flat)


# Stores


def test_snapshot_and_tail_equal_the_log(spark, tmp_path):
    log, snapshots, rng = f"{tmp_path}/log", f"{tmp_path}/snapshots", random.Random(9)
    assert store.current(spark, snapshots) is None
    for seq in range(6):
        rows = [(f"u{rng.randrange(60)}" if i else None, f"{seq}", i) for i in range(25)]
        rows = list({r[0]: r for r in rows}.values())
        store.append(spark.createDataFrame(rows, "uuid string, basename string, n long"), log, seq)
        if seq in (1, 2, 4):
            assert store.compact(spark, log, snapshots, buckets=8) == seq
        a, b = (sorted(map(str, x.select("uuid", "basename", "n").collect())) for x in (store.load_all(spark, log), store.load_all(spark, log, snapshots=snapshots)))
        assert a == b
    assert store.compact(spark, log, snapshots) == 5 and store.compact(spark, log, snapshots) is None
    plan = store.load_all(spark, log, snapshots=snapshots)._jdf.queryExecution().executedPlan().toString()
    tail = [line for line in plan.splitlines() if "FileScan" in line and "seq" in line and "PartitionFilters" in line]
    assert any("> 5" in line for line in tail)  # of the log only what comes after the snapshot


def test_compaction_writes_touched_buckets_only(spark, tmp_path):
    log, snapshots = f"{tmp_path}/log", f"{tmp_path}/snapshots"
    store.append(spark.range(200).select(F.concat(F.lit("u"), "id").alias("uuid"), "id"), log, 0)
    store.compact(spark, log, snapshots, buckets=16)
    store.append(spark.createDataFrame([("u7", -7)], "uuid string, id long"), log, 1)
    store.compact(spark, log, snapshots)
    assert len(files.numbers(spark, f"{snapshots}/data/upto=0", "bucket")) == 16 and len(files.numbers(spark, f"{snapshots}/data/upto=1", "bucket")) == 1
    rows = {r.uuid: r.id for r in store.load_all(spark, log, snapshots=snapshots).collect()}
    assert len(rows) == 200 and rows["u7"] == -7 and rows["u8"] == 8


def test_a_broken_write_is_written_again(spark, tmp_path):
    log = f"{tmp_path}/log"
    one, two = (spark.createDataFrame([("u", x)], "uuid string, x string") for x in "ab")
    store.append_once(one, log, 3)
    store.append_once(two, log, 3)
    assert store.load_all(spark, log).first().x == "a"
    os.remove(f"{log}/seq=3/_SUCCESS")
    store.append_once(two, log, 3)
    assert [r.x for r in store.load_all(spark, log).collect()] == ["b"]


def test_inventory_changes(spark, recordings, tmp_path):  # noqa: F811
    snapshots = f"{tmp_path}/inventories"

    def changes(version):
        return {r.basename: r.change for r in files.inventory_changes(spark, recordings, snapshots, version).collect()}

    assert changes(1) == {"a": "added", "b": "added", "bad": "added"}
    assert changes(2) == {}
    write_wav(f"{recordings}/new.wav")
    os.remove(f"{recordings}/bad.wav")
    write_wav(f"{recordings}/a.wav", seconds=1.0)
    assert changes(5) == changes(5) == {"new": "added", "bad": "gone", "a": "changed"}
    os.utime(f"{recordings}/new.wav", (1, 1))  # only the time differs
    assert changes(6) == {"new": "changed"}


def test_many_files_are_looked_up_in_few_tasks(spark, tmp_path):
    """Spark would start a task for each given file to look it up."""
    names = []
    for i in range(300):
        (tmp_path / f"v{i}.wav").write_bytes(b"RIFF")
        names.append(str(tmp_path / f"v{i}.wav"))
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", 10000)
    tracker = spark.sparkContext.statusTracker()

    def tasks_of(group, work):
        spark.sparkContext.setJobGroup(group, group)
        done = work()
        stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return done, max(tracker.getStageInfo(s).numTasks for s in stages)

    found, most = tasks_of("few", lambda: files.contents_of(spark, names).select("path"))
    assert most <= files.TASKS * spark.sparkContext.defaultParallelism
    assert found.count() == len(names)
