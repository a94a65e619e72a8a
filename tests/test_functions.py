import json
import re

from pyspark.sql import functions as F

from talkmill.functions import arrays, documents, paths, text


def one(spark, column, **values):
    literals = [F.lit(v).alias(k) for k, v in values.items()]
    return spark.range(1).select(*literals, F.lit(0).alias("_")).select(column.alias("out")).first()["out"]


def test_names(spark):
    cases = {"x.tar.gz": ("gz", "x.tar"), ".wav": ("", ".wav"), "X.WAV": ("WAV", "X"), "noext": ("", "noext"), "a.": ("", "a"), "..a.wav": ("wav", "..a"), "/d.e/f": ("", "f"), "": ("", ""), None: ("", None)}
    df = spark.createDataFrame([(k,) for k in cases], "p string")
    got = {r.p: (r.e, r.b) for r in df.select("p", paths.extension(F.col("p")).alias("e"), paths.basename(F.col("p")).alias("b")).collect()}
    assert got == cases
    audio = {r.p: r.a for r in df.select("p", paths.is_audio(F.col("p")).alias("a")).collect()}
    assert not audio["X.WAV"] and audio["..a.wav"]
    assert one(spark, paths.is_audio(F.col("p"), ignore_case=True), p="X.WAV")


def test_local_paths(spark):
    for key, want in {"vol/a/b.wav": "/base/a/b.wav", "plain": "/base/plain", "vol//x": "/x"}.items():
        assert one(spark, paths.local_path(F.col("k"), "/base"), k=key) == want
    assert one(spark, paths.remote_url(F.col("k"), "u@h:22", "/base"), k="v/a") == "sftp://u@h:22/base/a"


def test_urls(spark):
    assert tuple(one(spark, paths.url_parts(F.col("u")), u="sftp://me@host:2200/p/q")) == ("me", "host", 2200, "/p/q")
    assert tuple(one(spark, paths.url_parts(F.col("u")), u="sftp://me@host/p")) == ("me", "host", 22, "/p")
    assert one(spark, paths.url_parts(F.col("u")), u="sftp://host/p") is None
    assert one(spark, paths.discovery_root(F.col("u")), u="/a") == "/a"


def test_sizes_and_times(spark):
    sizes = {0: "0.0 B", 1023: "1023.0 B", 1024: "1.0 KB", 1280: "1.2 KB", 1536: "1.5 KB", 5 * 1024**3: "5.0 GB", 1024**6: "1.0 PB"}
    for n, want in sizes.items():
        assert one(spark, text.human_bytes(F.col("n")), n=n) == want, n
    times = {0: "0s", 59: "59s", 60: "1m", 3661: "1h 1m 1s", 31_536_000 + 86_400: "1y 1d", 86_399: "23h 59m 59s"}
    for n, want in times.items():
        assert one(spark, text.seconds_text(F.col("n")), n=n) == want
    assert one(spark, text.percent_text(F.col("a"), F.col("b")), a=1, b=3) == "33.33%"
    assert one(spark, text.percent_text(F.col("a"), F.col("b")), a=1, b=0) == "N/A"
    assert one(spark, text.throughput_text(F.col("a"), F.col("b"), F.col("t")), a=10, b=2097152, t=2.0) == "(5.0 files/s, 1.0 MB/s)"
    assert one(spark, text.throughput_text(F.col("a"), F.col("b"), F.col("t")), a=10, b=1, t=0.5) == ""


def test_text(spark):
    assert one(spark, text.shortened(F.col("t")), t="a" * 51) == "a" * 50 + "..."
    assert one(spark, text.shortened(F.col("t")), t="a" * 50) == "a" * 50
    assert re.fullmatch(r"[0-9a-f]{8}-[0-9a-f]{4}-8[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}", one(spark, text.random_uuid8()))
    assert one(spark, text.run_state(F.lit(True), F.lit(5.0))) == "blocking"
    assert one(spark, text.run_state(F.lit(False), F.lit(0.0))) == "alive"
    assert one(spark, text.run_state(F.lit(False), F.lit(5.0))) == "stopped"


DOCS = [
    {},
    {"uuid": "a", "dialog": "no list", "analysis": None},
    {"uuid": "b", "done": True, "processed_by": None, "dialog": [{"duration": "1769", "filename": "f.wav", "basename": "f"}], "analysis": [{"type": "transcript", "body": {"transcript": "old"}}, {"type": "transcript", "body": {"text": "new"}}]},
    {"uuid": "c", "processed_by": "h", "basename": "top", "analysis": [{"type": "language_identification", "body": {"languages": {"es": 1}}}, {"type": "other", "body": {"x": [1, {"y": None}]}}]},
    {"uuid": "d", "analysis": [{"type": "language_identification", "body": {"languages": ["en"]}}]},
]


def parsed(spark):
    return documents.parse_documents(spark.createDataFrame([(json.dumps(d),) for d in DOCS], "value string"))


def test_parse(spark):
    rows = {r.uuid: r for r in parsed(spark).select("*", documents.first_dialog("duration").alias("sec"), documents.effective_basename(F.col("basename"), F.col("dialog")).alias("base")).drop("appended", "redacted", "analysis").collect()}
    assert rows[None].dialog == [] and rows["a"].dialog == [] and rows[None].vcon == "0.0.2"
    assert rows["b"].sec == 1769.0 and rows["a"].sec == 0.0 and rows["b"].base == "f" and rows["c"].base == "top"
    assert (rows["b"].claim_present, rows["c"].claim_present, rows["d"].claim_present) == (True, True, False)
    assert rows["b"].done and not rows["c"].done


def test_analysis(spark):
    df = parsed(spark)
    a = F.col("analysis")
    rows = {r.uuid: r for r in df.select("uuid", documents.transcript(a).alias("first"), documents.transcript(a, "last").alias("last"), documents.languages(a).alias("l"), documents.is_english(documents.languages(a)).alias("en")).collect()}
    assert (rows["b"].first, rows["b"].last) == ("old", "new")
    assert rows["c"].l == ["es"] and rows["d"].l == ["en"] and rows["a"].l is None
    assert rows["d"].en and not rows["c"].en and not rows["a"].en
    more = df.where("uuid = 'd'").withColumn("analysis", documents.append_transcript(a, F.lit('say "hi"'), "v")).withColumn("analysis", documents.append_languages(a, F.array(F.lit("fr")), "v"))
    r = more.select(documents.transcript(a).alias("t"), documents.languages(a, "last").alias("l"), documents.languages(a).alias("l0")).first()
    assert r.t == 'say "hi"' and r.l == ["fr"] and r.l0 == ["en"]
    kept = df.where("uuid = 'c'").select(F.to_json(F.get(a, F.lit(1))["body"]).alias("j")).first().j
    assert json.loads(kept) == {"x": [1, {"y": None}]}


def test_first_dialog_update(spark):
    df = parsed(spark).withColumn("dialog", documents.with_first_dialog("filename", F.lit("new.wav")))
    rows = {r.uuid: r.dialog for r in df.select("uuid", "dialog").collect()}
    assert len(rows["a"]) == 1 and rows["a"][0].filename == "new.wav"
    assert rows["b"][0].filename == "new.wav" and rows["b"][0].basename == "f"


def test_new_documents_and_lists(spark):
    new = documents.new_documents(spark.createDataFrame([("/d/x.mp3",)], "filename string"))
    r = new.withColumn("parties", documents.append_to("parties", F.struct(F.lit("A").alias("name"), F.lit("agent").alias("role")))).drop("analysis").first()
    assert r.basename == "x" and r.dialog[0].mediatype == "audio/mpeg" and [p.name for p in r.parties] == ["Unknown", "A"]


def test_export(spark):
    out = documents.export_form(parsed(spark).withColumn("dialog", documents.with_first_dialog("size_bytes", F.lit(5))))
    assert "processed_by" not in out.columns and all(d.size_bytes is None for r in out.select("dialog").collect() for d in r.dialog[:1])


def test_dict_view(spark):
    raw = F.lit('{"a": 1, "b": {"c": 2}}')
    assert one(spark, documents.keys(raw)) == ["a", "b"] and one(spark, documents.item(raw, "b")) == '{"c":2}' and one(spark, documents.item(raw, "z")) is None


def test_arrays(spark):
    left, right = F.array(F.lit(1.0), F.lit(3.0)).cast("array<float>"), F.array(F.lit(3.0), F.lit(5.0)).cast("array<float>")
    assert one(spark, arrays.mono(F.array(left, right))) == [2.0, 4.0]
    assert one(spark, arrays.mono(F.array(left))) == [1.0, 3.0]
    assert one(spark, arrays.pad_right(left, F.lit(4))) == [1.0, 3.0, 0.0, 0.0]
    assert one(spark, arrays.pad_right(left, F.lit(1))) == [1.0, 3.0]
    assert one(spark, arrays.is_mono(F.lit(None).cast("array<array<float>>"))) is False
