from pyspark.sql import functions as F

from talkmill.operators import batching, catalog, metrics, reconcile
from talkmill.plans.views import view
from talkmill.sources import store
from tests.conftest import DATA

STATE = ["uuid", "processed_by", "claim_present", "done", "corrupt"]


def rows(df, *columns):
    return sorted(df.select(*(columns or df.columns)).collect(), key=str)


def test_claim_and_release(spark):
    cat = view(spark, DATA, "v_catalog")
    chosen = catalog.candidates(cat, "created_seq", rows=10)
    assert chosen.count() == 10
    after = catalog.claim(cat, chosen, "me")
    assert after.where("processed_by = 'me'").count() == 10
    again = catalog.candidates(after, "created_seq", rows=10)
    assert again.join(chosen, "uuid").count() == 0
    assert rows(catalog.release(after, "me"), *STATE) == rows(cat, *STATE)
    assert catalog.pending(cat).where("done").count() == 0


def test_finished_and_reopened_is_not_claimable(spark):
    cat = spark.createDataFrame([("u1", "b1", "f", True, True, None, True, 1)], "uuid string, basename string, filename string, done boolean, corrupt boolean, processed_by string, claim_present boolean, created_at int")
    new = spark.createDataFrame([("b1", "g")], "basename string, filename string")
    assert catalog.pending(catalog.reopen(cat, new)).count() == 0
    assert catalog.pending(catalog.reopen(cat, new, clear_claim=True)).count() == 1


def test_upsert_is_idempotent(spark):
    cat, new = view(spark, DATA, "v_catalog").select("uuid", "basename", "filename", "size_bytes"), view(spark, DATA, "v_incoming")
    once = catalog.upsert(cat, new)
    assert rows(catalog.upsert(once, new)) == rows(once)
    twice = new.unionAll(new.withColumn("seq", F.col("seq") + 1).withColumn("filename", F.lit("later")))
    assert catalog.upsert(cat, twice).where("filename = 'later'").count() == new.count()


def test_first_and_all(spark):
    cat = spark.createDataFrame([("u1", "b", "x", 2), ("u2", "b", "y", 1)], "uuid string, basename string, filename string, created_at int")
    new = spark.createDataFrame([("b", "z")], "basename string, filename string")
    assert {r.uuid: r.filename for r in catalog.set_fields(cat, new, ["filename"]).collect()} == {"u1": "x", "u2": "z"}
    assert {r.filename for r in catalog.set_fields(cat, new, ["filename"], which="all").collect()} == {"z"}
    assert catalog.first_of(cat).first().uuid == "u2" and catalog.first_of(cat, last=True).first().uuid == "u1"
    assert catalog.absent(cat, new.unionAll(spark.createDataFrame([("n", "q"), ("n", "q"), (None, "q")], new.schema)).withColumn("uuid", F.lit("i"))).count() == 2


def test_labels_partition_the_listing(spark):
    listing = view(spark, DATA, "v_listing")
    out = reconcile.actions(listing, view(spark, DATA, "v_catalog"), view(spark, DATA, "v_local"), "created_seq")
    assert out.count() == listing.count() and out.where("action is null").count() == 0
    assert out.where("delete_local and transfer").count() == 0


def test_discovery_of_repeated_names(spark):
    files = spark.createDataFrame([("a", "/1/a.wav"), ("a", "/2/a.wav"), ("b", "/b.wav"), ("c", "/c.wav")], "basename string, local_path string")
    cat = spark.createDataFrame([("u", "b", True, 1), ("v", "c", None, 1)], "uuid string, basename string, done boolean, created_at int")
    assert {r.local_path: r.action for r in reconcile.discovery(files, cat).collect()} == {"/1/a.wav": "added", "/2/a.wav": "skipped", "/b.wav": "deleted", "/c.wav": "skipped"}


def test_blocking_pairs(spark):
    marks = [("p", "start_blocking", 1, 1.0), ("p", "start_blocking", 2, 2.0), ("p", "stop_blocking", 3, 5.0), ("p", "stop_blocking", 4, 9.0), ("p", "count", 5, 9.0), ("p", "start_blocking", 6, 10.0)]
    r = metrics.blocking(spark.createDataFrame(marks, "program string, name string, seq long, ts double")).first()
    assert (r.blocked, r.n_intervals, r.open_start) == (3.0, 1, 10.0)


def test_status_of_a_stopped_program(spark):
    sums = spark.createDataFrame([("p", 10.0, 1048576.0, 50.0)], "program string, count double, bytes double, duration double")
    bounds = spark.createDataFrame([("p", 100.0, 110.0)], "program string, start double, stop double")
    waits = spark.createDataFrame([("p", 5.0, None)], "program string, blocked double, open_start double")
    r = metrics.status(sums, bounds, waits, F.lit(999.0)).first()
    assert (r.total_runtime, r.processing, r.percent_running, r.rate, r.mb_rate, r.rtf, r.state) == (10.0, 5.0, 50.0, 2.0, 0.2, 10.0, "stopped")


def test_padding_a_batch(spark):
    df = spark.createDataFrame([(1, 0, 0.5, [1.0]), (2, 0, 1.0, [1.0] * 9)], "id int, batch_id int, duration double, samples array<float>")
    lengths = batching.padded_lengths(df.drop("samples"), ["batch_id"], 4)
    assert {r.id: len(r.samples) for r in batching.pad_batch(df, lengths, "id").collect()} == {1: 4, 2: 9}


def test_store(spark, tmp_path):
    log = f"{tmp_path}/log"
    docs = spark.createDataFrame([("u1", "a"), ("u2", "b")], "uuid string, basename string")
    store.append(docs, log, 0)
    store.append(docs.where("uuid = 'u1'").withColumn("basename", F.lit("c")), log, 1)
    assert {r.uuid: r.basename for r in store.load_all(spark, log).collect()} == {"u1": "c", "u2": "b"}
    assert store.snapshot(spark, log, f"{tmp_path}/snap").count() == 2
    assert store.clear(spark, f"{tmp_path}/snap", f"{tmp_path}/empty") == 2 and spark.read.parquet(f"{tmp_path}/empty").count() == 0
    store.save_report(docs, f"{tmp_path}/report", "v1", "t")
    assert spark.read.json(f"{tmp_path}/report").where("version = 'v1'").count() == 2
