"""A registered query for each operator that can be compared with SQL, by the operator's id."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmill.functions import arrays, documents, paths, text
from talkmill.operators import audio, batching, catalog, inference, metrics, reconcile
from talkmill.plans.views import oracle, view
from talkmill.sources import files, store
from talkmill.sources.scratch import scratch_path
from talkmill.streaming import live_metrics, process

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BASE = "/data"
STATE = ["uuid", "processed_by", "claim_present", "done", "corrupt"]


def register(name: str, sql: str | None, *needs: str) -> Callable[[Callable[..., DataFrame]], Callable[..., DataFrame]]:
    """Register a function of the named views (or tables) as a query, with its SQL."""

    def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: f(*(view(spark, sf_dir, n) for n in needs))
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return f

    return add


def with_analysis(cat: DataFrame) -> DataFrame:
    """The catalog with its language as an analysis entry, typed as documents are."""
    body = F.parse_json(F.to_json(F.struct(F.array("language").alias("languages"))))
    entry = F.struct(F.lit("language_identification").alias("type"), body.alias("body"))
    words = F.struct(F.lit("transcript").alias("type"), F.parse_json(F.to_json(F.struct(F.concat(F.lit("text of "), "basename").alias("text")))).alias("body"))
    return cat.withColumn("analysis", F.array(words, entry))


def with_dialog(cat: DataFrame) -> DataFrame:
    """The catalog with name, size and duration in a dialog; ids divisible by 7 have none."""
    dialog = F.struct(F.col("filename").alias("filename"), F.concat(F.lit("d-"), "basename").alias("basename"), F.col("duration").alias("duration"), F.col("size_bytes").alias("size_bytes"), F.lit(16000).alias("sample_rate"))
    return cat.withColumn("dialog", F.when(F.col("doc_id") % 7 != 0, F.array(dialog)).otherwise(F.array().cast(f"array<{dialog_type()}>")))


def dialog_type() -> str:
    return "struct<filename:string,basename:string,duration:double,size_bytes:bigint,sample_rate:int>"


# Sources and sinks


@register("S3", "select regexp_replace(local_path, '^/data/', '') as relative_path, local_path as path from v_listing", "v_listing")
def s3(listing):
    return files.relative_table(listing, BASE, "local_path")


_LINES = """case when doc_id % 10 = 0 then '   ' when doc_id % 10 = 1 then concat('  DIR  ', source, '/') when doc_id % 10 = 2 then concat('x ', object_key)
  when doc_id % 10 = 3 then concat('2024-01-01 10:00:00 n/a ', object_key) else concat('2024-01-01 10:00:00   ', cast(size_bytes as varchar(20)), '  ', object_key) end"""


@register("S4", f"select p[-1] as filename, try_cast(p[-2] as bigint) as size_bytes from (select line, regexp_split_to_array(trim(line), '\\s+') as p from (select {_LINES} as line from v_listing)) where trim(line) <> '' and not ends_with(line, '/') and len(p) >= 4 and try_cast(p[-2] as bigint) is not null", "v_listing")
def s4(listing):
    return files.parse_listing(listing.selectExpr(f"{_LINES} as value"))


@register("S5", f"select rtrim(regexp_split_to_array(trim(line), '\\s+')[-1], '/') as dir from (select {_LINES} as line from v_listing) where ends_with(line, '/') and contains(line, 'DIR')", "v_listing")
def s5(listing):
    return files.parse_directories(listing.selectExpr(f"{_LINES} as value"))


@register("S6", "select object_key, split_part(object_key, '/', 1) as bucket, split_part(object_key, '/', 2) as switch, split_part(object_key, '/', 3) as date, cast(null as varchar) as hour from v_listing", "v_listing")
def s6(listing):
    return listing.select("object_key", *(c.alias(k) for k, c in files.key_levels(F.col("object_key")).items()))


@register("S7", "select local_path from v_listing where not contains(local_path, '/src1/')", "v_listing")
def s7(listing):
    return files.excluding(listing.select("local_path"), "/src1/", "local_path")


@register("S9", "select uuid, basename, done, corrupt from v_catalog", "v_catalog")
def s9(cat):
    return cat.select("uuid", "basename", "done", "corrupt")


@register("S11", "select uuid, basename, filename, done, corrupt from v_catalog", "v_catalog")
def s11(cat):
    return cat.select("uuid", "basename", "filename", "done", "corrupt")


@register("S12", "select case when doc_id % 7 <> 0 then filename end as filename from v_catalog", "v_catalog")
def s12(cat):
    return with_dialog(cat).select(documents.first_dialog("filename").alias("filename"))


@register("S13", "select uuid, basename from v_catalog union all select uuid, basename from v_incoming", "v_catalog", "v_incoming")
def s13(cat, incoming):
    return catalog.insert(cat, incoming.drop("seq")).select("uuid", "basename")


_MERGED = """select coalesce(i.uuid, c.uuid) as uuid, case when i.uuid is null then c.basename else i.basename end as basename,
  case when i.uuid is null then c.filename else i.filename end as filename, case when i.uuid is null then c.size_bytes else i.size_bytes end as size_bytes
  from v_catalog c full join v_incoming i on c.uuid = i.uuid"""


def merged(cat, incoming):
    return catalog.upsert(cat.select("uuid", "basename", "filename", "size_bytes"), incoming)


register("S14", _MERGED, "v_catalog", "v_incoming")(merged)
register("J8", _MERGED, "v_catalog", "v_incoming")(merged)


@register("S15", "select c.uuid, coalesce(i.filename, c.filename) as filename, coalesce(i.size_bytes, c.size_bytes) as size_bytes from v_catalog c left join v_incoming i on c.basename = i.basename", "v_catalog", "v_incoming")
def s15(cat, incoming):
    return catalog.set_fields(cat, incoming, ["filename", "size_bytes"], "created_seq").select("uuid", "filename", "size_bytes")


@register("S16", "select count(*) as remaining, (select count(*) from v_catalog) as deleted from v_catalog where false", "v_catalog")
def s16(cat):
    """A catalog on disk, cleared: what the new one holds, and how many documents were left behind."""
    spark = cat.sparkSession
    full, empty = scratch_path(spark, "catalog"), scratch_path(spark, "cleared")
    cat.select(*STATE, "basename", "filename").write.parquet(full)
    deleted = store.clear(spark, full, empty)
    return spark.read.parquet(empty).agg(F.count("*").alias("remaining")).withColumn("deleted", F.lit(deleted).cast("long"))


# Projections and predicates


@register("P1", "select local_path, coalesce(regexp_extract(local_path, '\\.([^./]*)$', 1), '') in ('wav','mp3','ogg','m4a','flac','aac','wma','aiff','au','raw','pcm') as audio from v_listing", "v_listing")
def p1(listing):
    return listing.select("local_path", paths.is_audio(F.col("local_path")).alias("audio"))


@register("P3", "select uuid, case when doc_id % 7 <> 0 then size_bytes end as size_bytes, case when doc_id % 7 <> 0 then filename end as filename, case when doc_id % 7 <> 0 then duration else 0 end as duration, case when doc_id % 7 <> 0 then 16000 end as sample_rate from v_catalog", "v_catalog")
def p3(cat):
    return with_dialog(cat).select("uuid", *(documents.first_dialog(f).alias(f) for f in ("size_bytes", "filename", "duration", "sample_rate")))


@register("P5", "select uuid, case when doc_id % 2 = 0 then basename when doc_id % 7 <> 0 then concat('d-', basename) end as basename from v_catalog", "v_catalog")
def p5(cat):
    top = F.when(F.col("doc_id") % 2 == 0, F.col("basename"))
    return with_dialog(cat).select("uuid", documents.effective_basename(top, F.col("dialog")).alias("basename"))


@register("P6", "select conv_id, arg_min(text, turn) filter (where role = 'user') as first_text from conversations group by conv_id", "conversations")
def p6(turns):
    nested = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.col("role").alias("type"), "text"))).alias("analysis"))
    return nested.select("conv_id", documents.analysis_of("user", F.col("analysis"))["text"].alias("first_text"))


@register("P7", "select uuid, concat('text of ', basename) as transcript from v_catalog", "v_catalog")
def p7(cat):
    return with_analysis(cat).select("uuid", documents.transcript(F.col("analysis")).alias("transcript"))


@register("P8", "select uuid, language as languages from v_catalog", "v_catalog")
def p8(cat):
    return with_analysis(cat).select("uuid", F.array_join(documents.languages(F.col("analysis")), ",").alias("languages"))


@register("P11", "select uuid, done, corrupt, processed_by from v_catalog", "v_catalog")
def p11(cat):
    return catalog.flags(cat.withColumn("done", F.when(F.col("done"), F.lit(True))))


@register("P12", "select uuid, done or size_bytes > 2000 as done from v_catalog", "v_catalog")
def p12(cat):
    return catalog.mark_done(cat, F.col("size_bytes") > 2000).select("uuid", "done")


@register("P13", "select uuid, processed_by, claim_present, done or uuid in (select uuid from v_incoming) as done, corrupt or uuid in (select uuid from v_incoming) as corrupt from v_catalog", "v_catalog", "v_incoming")
def p13(cat, bad):
    return catalog.mark_invalid(cat, bad).select(STATE)


@register("P14", "select uuid from v_catalog where not done and not claim_present and not corrupt", "v_catalog")
def p14(cat):
    return catalog.pending(cat).select("uuid")


@register("P15", "select uuid from v_catalog c where claim_present and not exists (select 1 from v_local l where l.local_path = c.filename)", "v_catalog", "v_local")
def p15(cat, local):
    return catalog.inaccessible(cat.where("claim_present"), local).select("uuid")


@register("P17", "select uuid, language = 'en' as english from v_catalog", "v_catalog")
def p17(cat):
    return with_analysis(cat).select("uuid", documents.is_english(documents.languages(F.col("analysis"))).alias("english"))


_CODE = "case when not no_audio and label_idx = 1 then 'es' else 'en' end"


def _code():
    return inference.label_code(F.col("label_idx"), ["en", "es", "fr"], F.col("no_audio"))


@register("P18", f"select doc_id, lang, case when lang = 'en' then 'en' else 'other' end as route, case when lang = 'en' then 'en' else 'corrupt' end as strict_route from (select doc_id, {_CODE} as lang from v_predictions)", "v_predictions")
def p18(pred):
    rows = pred.select("doc_id", _code().alias("lang"))
    return rows.select("doc_id", "lang", inference.route(F.col("lang")).alias("route"), inference.route(F.col("lang"), drop_others=True).alias("strict_route"))


@register("P19", "select basename, '0.0.2' as vcon, false as done, local_path as filename, case when doc_id % 4 = 0 then 'audio/mpeg' else 'audio/x-wav' end as mediatype, size_bytes, 'Unknown' as party from v_listing", "v_listing")
def p19(listing):
    new = documents.new_documents(listing.select(F.col("local_path").alias("filename"), "size_bytes"))
    d = F.get("dialog", F.lit(0))
    return new.select("basename", "vcon", "done", d["filename"].alias("filename"), d["mediatype"].alias("mediatype"), d["size_bytes"].alias("size_bytes"), F.get("parties", F.lit(0))["name"].alias("party"))


@register("P20", "select vec_id, label from embeddings", "embeddings")
def p20(rows):
    return rows.drop("embedding")


@register("P21", "select vec_id, len(embedding) as n from embeddings", "embeddings")
def p21(rows):
    return rows.select("vec_id", F.size("embedding").alias("n"))


@register("P22", "select l.basename, case when c.uuid is null then 'added' when c.done then 'deleted' else 'skipped' end as action from v_listing l left join v_catalog c on l.basename = c.basename", "v_listing", "v_catalog")
def p22(listing, cat):
    return reconcile.discovery(listing, cat.withColumn("created_at", F.col("created_seq"))).select("basename", "action")


_ACTION = """select j.basename, case when ex and done and not corrupt then case when lex then case when fix then 'fixed_filename_and_deleted' else 'delete_local' end else case when fix then 'fixed_filename' else 'already_processed' end end
  when ex and corrupt then case when fix then 'fix_corrupt_and_filename' else 'fix_corrupt' end
  when ex and (not lex or (size_bytes > 0 and lsize <> size_bytes)) then case when fix then 'fixed_filename_and_download' else 'download_existing' end
  when ex then case when fix then 'fixed_filename' else 'exists_correct_size' end
  when not lex or (size_bytes > 0 and lsize <> size_bytes) or lsize = 0 then 'download_and_create' else 'create_vcon_only' end as action
  from (select l.basename, l.size_bytes, c.uuid is not null as ex, coalesce(c.done, false) as done, coalesce(c.corrupt, false) as corrupt, c.uuid is not null and c.filename is distinct from l.local_path as fix,
    o.basename is not null as lex, coalesce(o.local_size, 0) as lsize from v_listing l left join v_catalog c on l.basename = c.basename left join v_local o on l.local_path = o.local_path) j"""


@register("P23", _ACTION, "v_listing", "v_catalog", "v_local")
def p23(listing, cat, local):
    return reconcile.actions(listing, cat, local, "created_seq").select("basename", "action")


_OUTCOME = f"""select a.basename, a.action, case action when 'delete_local' then 'DELETED' when 'fixed_filename' then 'FIXED_FILENAME' when 'fixed_filename_and_deleted' then 'FIXED_FILENAME_AND_DELETED'
  when 'already_processed' then 'ALREADY_PROCESSED' when 'exists_correct_size' then 'EXISTS' when 'create_vcon_only' then 'VCON_CREATED'
  when 'fixed_filename_and_download' then case when ok then 'FIXED_FILENAME_AND_DOWNLOADED' else 'FIXED_FILENAME_DOWNLOAD_FAILED' end
  when 'fix_corrupt' then case when ok then 'FIXED' else 'FIX_FAILED' end
  when 'fix_corrupt_and_filename' then case when ok then 'FIXED_CORRUPT_AND_FILENAME' else 'FIX_CORRUPT_AND_FILENAME_FAILED' end
  when 'download_existing' then case when ok then 'DOWNLOADED' else 'DOWNLOAD_FAILED' end
  when 'download_and_create' then case when ok then 'CREATED' else 'CREATE_FAILED' end end as outcome
  from (select a.*, exists (select 1 from v_local t where t.basename = a.basename and t.local_size > 0) as ok from ({_ACTION}) a) a"""


@register("P24", _OUTCOME, "v_listing", "v_catalog", "v_local")
def p24(listing, cat, local):
    planned = reconcile.actions(listing, cat, local, "created_seq").select("basename", "action")
    return reconcile.outcomes(planned, local)


# Joins


@register("J1", "select i.basename, c.uuid, c.done from v_incoming i left join v_catalog c on i.basename = c.basename", "v_catalog", "v_incoming")
def j1(cat, incoming):
    return catalog.by_basename(cat, incoming.select("basename"), "created_seq").select("basename", "uuid", "done")


@register("J2", "select i.basename, c.uuid from v_incoming i join v_catalog c on i.basename = c.basename", "v_catalog", "v_incoming")
def j2(cat, incoming):
    return catalog.all_by_basename(cat, incoming.select("basename")).select("basename", "uuid")


@register("J3", "select distinct basename, basename in (select basename from v_catalog) as found from v_listing", "v_catalog", "v_listing")
def j3(cat, listing):
    return catalog.exists(cat, listing)


_ABSENT = "select uuid, basename from v_incoming where basename not in (select basename from v_catalog)"


@register("J4", _ABSENT, "v_catalog", "v_incoming")
def j4(cat, incoming):
    return catalog.absent(cat, incoming).select("uuid", "basename")


register("U5", _ABSENT, "v_catalog", "v_incoming")(j4)


@register("J5", "select l.basename, c.uuid is not null as ex, coalesce(c.done, false) as done, coalesce(c.corrupt, false) as corrupt, c.filename, c.uuid is not null and c.filename is distinct from l.local_path as fix from v_listing l left join v_catalog c on l.basename = c.basename", "v_listing", "v_catalog")
def j5(listing, cat):
    out = reconcile.statuses(listing, cat, "created_seq")
    return out.select("basename", "ex", F.coalesce("done", F.lit(False)).alias("done"), F.coalesce("corrupt", F.lit(False)).alias("corrupt"), "filename", "fix")


@register("J6", "select basename, local_size from v_local where basename not in (select basename from v_catalog where done and not corrupt)", "v_local", "v_catalog")
def j6(local, cat):
    return reconcile.orphans(local, cat, "created_seq").select("basename", "local_size")


_CHOSEN = "select uuid from v_catalog where not done and not claim_present and not corrupt order by created_seq, uuid limit 512"
_CLAIMED = f"select uuid, case when uuid in ({_CHOSEN}) then 'me' else processed_by end as processed_by, claim_present or uuid in ({_CHOSEN}) as claim_present, done, corrupt from v_catalog"


def claimed(cat):
    return catalog.claim(cat, catalog.candidates(cat, "created_seq"), "me").select(STATE)


register("J7", _CLAIMED, "v_catalog")(claimed)
register("T2", _CLAIMED, "v_catalog")(claimed)


@register("J9", "select basename, local_path, not contains(local_path, '://') as deletable from v_local where basename in (select basename from v_catalog where done)", "v_local", "v_catalog")
def j9(local, cat):
    return reconcile.finished_files(local, cat).select("basename", "local_path", "deletable")


@register("J10", "select l.basename, o.basename is not null as lex, coalesce(o.local_size, 0) as lsize, o.basename is not null and l.size_bytes > 0 and coalesce(o.local_size, 0) <> l.size_bytes as differs from v_listing l left join v_local o on l.local_path = o.local_path", "v_listing", "v_local")
def j10(listing, local):
    return reconcile.with_local(listing, local).select("basename", "lex", "lsize", "differs")


# Aggregations


@register("A1", """select total, done, corrupt, english, spanish, round(corrupt / nullif(done, 0) * 100, 9) as corrupt_pct, round(done / nullif(total, 0) * 100, 9) as done_pct, round(english / nullif(done, 0) * 100, 9) as english_pct, round(spanish / nullif(done, 0) * 100, 9) as spanish_pct
  from (select count(*) as total, count(*) filter (where done) as done, count(*) filter (where corrupt) as corrupt, count(*) filter (where language = 'en') as english, count(*) filter (where language = 'es') as spanish from v_catalog)""", "v_catalog")
def a1(cat):
    out = catalog.statistics(with_analysis(cat), documents.languages(F.col("analysis")))
    return out.select(*(F.round(c, 9).alias(c) if c.endswith("_pct") else F.col(c) for c in out.columns))



@register("A2", "select count(*) filter (where language = 'es') as n from v_catalog", "v_catalog")
def a2(cat):
    rows = cat.withColumn("analysis", F.array(F.struct(F.lit("language_identification").alias("type"), F.array("language").alias("languages"))))
    return catalog.count_elements(rows, "language_identification", "es")


@register("A3", "select cast(sum(size_bytes) as bigint) as total_bytes from v_catalog", "v_catalog")
def a3(cat):
    return catalog.total_bytes(cat)


@register("A4", "select cast(sum(local_size) as bigint) as total_bytes from v_local", "v_local")
def a4(local):
    return catalog.total_bytes(local, "local_size")


@register("A5", "select source, max(duration) as longest from v_listing group by source", "v_listing")
def a5(listing):
    return batching.longest(listing, ["source"])


_SUMS = "select program, coalesce(sum(value) filter (where name = 'count'), 0) as count, coalesce(sum(value) filter (where name = 'bytes'), 0) as bytes, coalesce(sum(value) filter (where name = 'duration'), 0) as duration from v_measurements group by program"
_ROUNDED = f"select program, round(count, 6) as count, round(bytes, 6) as bytes, round(duration, 6) as duration from ({_SUMS})"


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


@register("A6", _ROUNDED, "v_measurements")
def a6(rows):
    return rounded(metrics.counters(rows), *metrics.MEASURES)


@register("A7", "select program, arg_max(value, seq) filter (where n = 'start') as start, arg_max(value, seq) filter (where n = 'stop') as stop from (select *, case name when 'count' then 'start' when 'bytes' then 'stop' end as n from v_measurements) group by program", "v_measurements")
def a7(rows):
    return metrics.marks(rows.withColumn("name", F.when(F.col("name") == "count", "start").when(F.col("name") == "bytes", "stop")))


_WAITS = """select program, coalesce(sum(ts - pt) filter (where name = 'stop_blocking' and pn = 'start_blocking'), 0) as blocked, count(*) filter (where name = 'stop_blocking' and pn = 'start_blocking') as n_intervals,
  case when arg_max(name, seq) = 'start_blocking' then arg_max(ts, seq) end as open_start
  from (select *, lag(name) over w as pn, lag(ts) over w as pt from v_measurements where name like '%blocking' window w as (partition by program order by seq)) group by program"""


@register("W4", f"select program, round(blocked, 3) as blocked, n_intervals, round(open_start, 3) as open_start from ({_WAITS})", "v_measurements")
def w4(rows):
    return rounded(metrics.blocking(rows), "blocked", "open_start", places=3)


_BOUNDS = "select program, min(ts) as start, cast(null as double) as stop from v_measurements group by program"
_STATUS = f"""select program, state, count, bytes, duration, total_runtime, total_blocking, p as processing, p / nullif(total_runtime, 0) * 100 as percent_running, count / nullif(p, 0) as rate, bytes / 1024 / 1024 / nullif(p, 0) as mb_rate, case when p > 0 then duration / p else 0 end as rtf
  from (select *, total_runtime - total_blocking as p from (select s.*, case when open_start is not null then 'blocking' else 'alive' end as state, n.now - b.start as total_runtime, blocked + case when open_start is not null then n.now - open_start else 0 end as total_blocking
  from ({_SUMS}) s join ({_BOUNDS}) b using (program) join ({_WAITS}) w using (program), (select max(ts) as now from v_measurements) n))"""


def bounds(rows: DataFrame) -> DataFrame:
    return rows.groupBy("program").agg(F.min("ts").alias("start"), F.lit(None).cast("double").alias("stop"))


def status(rows: DataFrame) -> DataFrame:
    last = rows.agg(F.max("ts").alias("__now"))  # one row
    sums = metrics.counters(rows).join(F.broadcast(last))
    out = metrics.status(sums, bounds(rows), metrics.blocking(rows), F.col("__now"))
    return out


@register("A8", "select program, state, " + ", ".join(f"round({c}, 4) as {c}" for c in ("count", "bytes", "duration", "total_runtime", "total_blocking", "processing", "percent_running", "rate", "mb_rate", "rtf")) + f" from ({_STATUS})", "v_measurements")
def a8(rows):
    return rounded(status(rows), "count", "bytes", "duration", "total_runtime", "total_blocking", "processing", "percent_running", "rate", "mb_rate", "rtf", places=4)


@register("A9", f"select * from ({_ROUNDED}) r union all select 'avg', count, bytes, duration from ({_ROUNDED}) r where program = 'p6'", "v_measurements")
def a9(rows):
    return metrics.with_average(rounded(metrics.counters(rows), *metrics.MEASURES), "p6")


@register("A10", f"select program, round(bytes, 6) as bytes, round(duration / nullif(now - start, 0), 9) as avg_rtf from ({_SUMS}) s join ({_BOUNDS}) b using (program), (select max(ts) as now from v_measurements) where program = 'p6'", "v_measurements")
def a10(rows):
    sums = metrics.counters(rows).join(F.broadcast(rows.agg(F.max("ts").alias("__now"))))
    return metrics.average_rtf(sums, bounds(rows), "p6", F.col("__now")).select("program", F.round("bytes", 6).alias("bytes"), F.round("avg_rtf", 9).alias("avg_rtf"))


@register("A11", "select count(*) as files_scanned, count(*) filter (where not keep) as files_deleted, cast(coalesce(sum(local_size) filter (where not keep), 0) as bigint) as bytes_freed, coalesce(sum(local_size) filter (where not keep), 0) / 1048576.0 as mb_freed from (select *, basename in (select basename from v_catalog where done and not corrupt) as keep from v_local)", "v_local", "v_catalog")
def a11(local, cat):
    return reconcile.cleanup_summary(local, cat, "created_seq")


@register("A12", "select count(*) as files, cast(sum(size_bytes) as bigint) as bytes, round(count(*) / 60.0, 9) as files_per_sec, round(sum(size_bytes) / 1024 / 1024 / 60.0, 9) as mb_per_sec from v_listing", "v_listing")
def a12(listing):
    return rounded(metrics.throughput(listing, F.lit(60.0)), "mb_per_sec", "files_per_sec", places=9)


_RUNNING = "select basename, count(*) over w as files, cast(sum(size_bytes) over w as bigint) as bytes, doc_id from v_listing window w as (order by doc_id rows unbounded preceding)"


def running(listing: DataFrame) -> DataFrame:
    return metrics.running_totals(listing, "doc_id", "size_bytes", "basename")


@register("A13", f"select basename, round(bytes / 1024 / 1024 / greatest(doc_id * 0.01, 0.001), 6) as mb_per_sec from ({_RUNNING})", "v_listing")
def a13(listing):
    timed = running(listing).withColumn("seconds", F.col("doc_id") * F.lit(0.01).cast("double"))
    return metrics.discovery_rate(timed, F.lit(0.0), "seconds").select("basename", F.round("mb_per_sec", 6).alias("mb_per_sec"))


@register("A14", "select basename, count(*) as n from (select basename from v_catalog union all select basename from v_incoming) group by basename having count(*) > 1", "v_catalog", "v_incoming")
def a14(cat, incoming):
    return catalog.duplicates(cat.select("basename").unionAll(incoming.select("basename")))


@register("A15", f"select (select count(*) from ({_CHOSEN})) as modified, 0 as deleted", "v_catalog")
def a15(cat):
    after = catalog.claim(cat, catalog.candidates(cat, "created_seq"), "me")
    return catalog.changes(cat, after, ["processed_by", "claim_present"])


# Windows, limits, sets

_BATCH = "select basename, source, duration, cast(floor((row_number() over (partition by source order by doc_id) - 1) / 8) as bigint) as batch_id from v_listing"


@register("W1", f"select basename, batch_id from ({_BATCH})", "v_listing")
def w1(listing):
    return batching.fixed_batches(listing, 8, "doc_id", "source", "basename").select("basename", "batch_id")


@register("W2", f"select basename, batch_id, cast(floor(max(duration) over (partition by source, batch_id) * 16000) as bigint) as pad_samples from ({_BATCH})", "v_listing")
def w2(listing):
    rows = batching.fixed_batches(listing, 8, "doc_id", "source", "basename")
    return batching.padded_lengths(rows, ["source", "batch_id"], 16000).select("basename", "batch_id", "pad_samples")


_TWO = "(select basename, uuid, created_seq from v_catalog union all select basename, concat('i', uuid), seq from v_incoming)"


@register("W3", f"select basename, arg_min(uuid, (created_seq, uuid)) as first_uuid, arg_max(uuid, (created_seq, uuid)) as last_uuid from {_TWO} group by basename", "v_catalog", "v_incoming")
def w3(cat, incoming):
    rows = cat.select("basename", "uuid", "created_seq").unionAll(incoming.select("basename", F.concat(F.lit("i"), "uuid"), "seq"))
    first = catalog.first_of(rows, "created_seq").select("basename", F.col("uuid").alias("first_uuid"))
    return first.join(catalog.first_of(rows, "created_seq", last=True).select("basename", F.col("uuid").alias("last_uuid")), "basename")


@register("W5", f"select basename, files, bytes from ({_RUNNING})", "v_listing")
def w5(listing):
    return running(listing).select("basename", "files", "bytes")


@register("W6", f"select uuid from (select uuid, sum(size_bytes) over (order by created_seq, uuid rows unbounded preceding) as s from v_catalog where uuid in ({_CHOSEN})) where s <= 100000", "v_catalog")
def w6(cat):
    return catalog.within_budget(cat, 100_000, "created_seq")


@register("T1", "select uuid, case when uuid = (select uuid from v_catalog where not done order by created_seq, uuid limit 1) then 'me' else processed_by end as processed_by, claim_present or uuid = (select uuid from v_catalog where not done order by created_seq, uuid limit 1) as claim_present, done, corrupt from v_catalog", "v_catalog")
def t1(cat):
    return catalog.claim(cat, catalog.oldest_open(cat, "created_seq"), "me", only_unclaimed=False).select(STATE)


@register("T3", "select uuid, case when processed_by = 'host1' and not done then null else processed_by end as processed_by, claim_present and not coalesce(processed_by = 'host1' and not done, false) as claim_present, done, corrupt from v_catalog", "v_catalog")
def t3(cat):
    return catalog.release(cat, "host1").select(STATE)


@register("T4", "select uuid, case when processed_by is not null then null else processed_by end as processed_by, claim_present, done or processed_by is not null as done, corrupt from v_catalog", "v_catalog")
def t4(cat):
    return catalog.finish(cat, F.col("processed_by").isNotNull()).select(STATE)


@register("T5", "select c.uuid, case when corrupt and l.local_path is not null then l.local_path else filename end as filename, done and not (corrupt and l.local_path is not null) as done, corrupt and l.local_path is null as corrupt, claim_present from v_catalog c left join v_local l on c.basename = l.basename", "v_catalog", "v_local")
def t5(cat, local):
    return catalog.reopen(cat, local.withColumnRenamed("local_path", "filename")).select("uuid", "filename", "done", "corrupt", "claim_present")


@register("U1", f"select basename, action from ({_ACTION}) a where action = 'create_vcon_only' or (action = 'download_and_create' and basename in (select basename from v_local where local_size > 0))", "v_listing", "v_catalog", "v_local")
def u1(listing, cat, local):
    planned = reconcile.actions(listing, cat, local, "created_seq").select("basename", "action")
    return reconcile.created(planned, local)


@register("U2", "select uuid, filename from v_catalog union all select uuid, filename from v_incoming", "v_catalog", "v_incoming")
def u2(cat, incoming):
    return catalog.insert(cat.select("uuid", "filename"), incoming.select("uuid", "filename"))


@register("U3", f"select doc_id, {_CODE} as lang from v_predictions", "v_predictions")
def u3(pred):
    rows = pred.select("doc_id", _code().alias("lang"))
    return rows.where(F.col("lang") == "en").unionByName(rows.where(F.col("lang") != "en"))


@register("U4", "select conv_id, text from conversations", "conversations")
def u4(turns):
    nested = turns.groupBy("conv_id", "role").agg(F.collect_list("text").alias("texts")).groupBy("conv_id").agg(F.collect_list("texts").alias("nested"))
    return batching.flatten(nested, "nested", "text")


# Scalar functions

_EXT_SQL = "regexp_extract(local_path, '\\.([^./]*)$', 1)"


@register("F1", f"select local_path, {_EXT_SQL} as ext from v_listing", "v_listing")
def f1(listing):
    return listing.select("local_path", paths.extension(F.col("local_path")).alias("ext"))


@register("F2", "select object_key, regexp_replace(regexp_extract(object_key, '[^/]*$'), '\\.[^.]*$', '') as basename from v_listing", "v_listing")
def f2(listing):
    return listing.select("object_key", paths.basename(F.col("object_key")).alias("basename"))


_LOCAL_SQL = "concat('/data/', regexp_replace(object_key, '^[^/]*/', ''))"


@register("F3", f"select object_key, {_LOCAL_SQL} as local_path from v_listing", "v_listing")
def f3(listing):
    return listing.select("object_key", paths.local_path(F.col("object_key"), BASE).alias("local_path"))


@register("F4", f"select object_key, concat('sftp://me@host:22', {_LOCAL_SQL}) as url from v_listing", "v_listing")
def f4(listing):
    return listing.select("object_key", paths.remote_url(F.col("object_key"), "me@host:22", BASE).alias("url"))


_URL = "case when page_id % 3 = 0 then concat('sftp://me@', substr(url, strpos(url, '://') + 3)) when page_id % 3 = 1 then concat('sftp://you@host:2222/p', cast(page_id as varchar(20))) else url end"
_URL_SPARK = _URL.replace("strpos(url, '://')", "instr(url, '://')")


@register("F5", f"""select page_id, case when has then split_part(netloc, '@', 1) end as username, case when has then split_part(split_part(netloc, '@', 2), ':', 1) end as hostname,
  case when has then coalesce(try_cast(nullif(regexp_extract(split_part(netloc, '@', 2), ':([0-9]+)$', 1), '') as int), 22) end as port, case when has then path end as path
  from (select *, contains(netloc, '@') as has from (select page_id, regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) as netloc, regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) as path from (select page_id, {_URL} as u from pages)))""", "pages")
def f5(pages):
    return pages.selectExpr("page_id", f"{_URL_SPARK} as u").select("page_id", paths.url_parts(F.col("u")).alias("p")).select("page_id", "p.*")


@register("F6", f"select page_id, case when starts_with(u, 'sftp://') then regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) else u end as root from (select page_id, {_URL} as u from pages)", "pages")
def f6(pages):
    return pages.selectExpr("page_id", f"{_URL_SPARK} as u").select("page_id", paths.discovery_root(F.col("u")).alias("root"))


@register("F7", "select local_path, case when doc_id % 4 = 0 then 'audio/mpeg' else 'audio/x-wav' end as media_type from v_listing", "v_listing")
def f7(listing):
    return listing.select("local_path", paths.media_type(F.col("local_path")).alias("media_type"))


@register("F8", "select local_path, substr(local_path, 7) as relative_path from v_listing", "v_listing")
def f8(listing):
    return listing.select("local_path", paths.relative_path(F.col("local_path"), BASE).alias("relative_path"))


@register("F9", "select basename, case when size_bytes < 1024 then printf('%.1f B', size_bytes * 1.0::double) when size_bytes / 1024 < 1024 then printf('%.1f KB', size_bytes / 1024) else printf('%.1f MB', size_bytes / 1048576) end as size_text from v_listing", "v_listing")
def f9(listing):
    return listing.select("basename", text.human_bytes(F.col("size_bytes")).alias("size_text"))


@register("F10", "select basename, duration / 60 as minutes, duration / 60 / 60 as hours, duration / 60 / 60 / 24 as days, duration / 60 / 60 / 24 / 7 as weeks, duration / 60 / 60 / 24 / 7 / 4 as months from v_listing", "v_listing")
def f10(listing):
    return listing.select("basename", *(text.seconds_in(F.col("duration"), u).alias(u) for u in ("minutes", "hours", "days", "weeks", "months")))


@register("F11", """select basename, case when s = 0 then '0s' else concat_ws(' ', case when y <> 0 then y || 'y' end, case when d <> 0 then d || 'd' end, case when h <> 0 then h || 'h' end, case when m <> 0 then m || 'm' end, case when r <> 0 then r || 's' end) end as dur_text
  from (select basename, s, s // 31536000 as y, s % 31536000 // 86400 as d, s % 86400 // 3600 as h, s % 3600 // 60 as m, s % 60 as r from (select basename, size_bytes * 7919 as s from v_listing))""", "v_listing")
def f11(listing):
    return listing.select("basename", text.seconds_text(F.col("size_bytes") * 7919).alias("dur_text"))



@register("F12", None, "v_listing")
def f12(listing):
    return listing.select("basename", text.random_uuid8().alias("uuid"))


@register("F13", "select basename, size_bytes / 1024 / 1024 as mb from v_listing", "v_listing")
def f13(listing):
    return listing.select("basename", text.megabytes(F.col("size_bytes")).alias("mb"))


@register("F14", "select basename, case when doc_id % 5 > 0 then round(duration / (doc_id % 5), 9) else 0 end as rtf from v_listing", "v_listing")
def f14(listing):
    return listing.select("basename", F.round(text.real_time_factor(F.col("duration"), F.col("doc_id") % 5), 9).alias("rtf"))


@register("F15", "select basename, case when doc_id % 5 > 0 then printf('%.2f%%', (doc_id % 3) / (doc_id % 5) * 100) else 'N/A' end as pct from v_listing", "v_listing")
def f15(listing):
    return listing.select("basename", text.percent_text(F.col("doc_id") % 3, F.col("doc_id") % 5).alias("pct"))


@register("F16", "select uuid, concat('Vcon(', uuid, ', ', printf('%.2fs', duration), ', ', case when size_bytes < 1024 then printf('%.1f B', size_bytes * 1.0::double) when size_bytes / 1024 < 1024 then printf('%.1f KB', size_bytes / 1024) else printf('%.1f MB', size_bytes / 1048576) end, ', lang=', language, ', transcript=''text of ', basename, ''')') as summary from v_catalog", "v_catalog")
def f16(cat):
    rows = with_analysis(cat)
    return rows.select("uuid", documents.summary(F.col("uuid"), F.col("duration"), F.col("size_bytes"), documents.languages(F.col("analysis")), documents.transcript(F.col("analysis"))).alias("summary"))


@register("F17", "select doc_id, substr(text, 1, 140) as preview from documents", "documents")
def f17(docs):
    return docs.select("doc_id", text.preview(F.col("text")).alias("preview"))


@register("F18", "select uuid, case when claim_present then 'blocking' when not done then 'alive' else 'stopped' end as state from v_catalog", "v_catalog")
def f18(cat):
    return cat.select("uuid", text.run_state(F.col("claim_present"), F.when(F.col("done"), F.lit(1.0)).otherwise(F.lit(0.0))).alias("state"))


@register("F19", f"""select program, printf('%-8s %-28s | %7.2fx %9d %7.1f/s %9.2fMB/s | %10.2fMB %13.1fm | (%6.1f%%)', state, program, rtf, cast(1 as bigint), rate, mb_rate, bytes / 1024 / 1024, total_runtime / 60, percent_running) as line from ({_STATUS})""", "v_measurements")
def f19(rows):
    s = status(rows)
    return s.select("program", text.status_line(F.rpad("state", 8, " "), F.col("program"), F.col("rtf"), F.lit(1), F.col("rate"), F.col("mb_rate"), text.megabytes(F.col("bytes")), text.seconds_in(F.col("total_runtime"), "minutes"), F.col("percent_running")).alias("line"))


@register("F20", "select uuid, 'basename,done,uuid' as keys, basename as item, 3 as n from v_catalog", "v_catalog")
def f20(cat):
    rows = cat.select("uuid", F.to_json(F.struct("uuid", "basename", "done")).alias("raw"))
    return rows.select("uuid", F.array_join(F.array_sort(documents.keys(F.col("raw"))), ",").alias("keys"), documents.item(F.col("raw"), "basename").alias("item"), F.size(documents.keys(F.col("raw"))).alias("n"))


@register("F21", "select seq, name not in ('start_blocking', 'stop_blocking') as measurement from v_measurements", "v_measurements")
def f21(rows):
    return rows.select("seq", text.is_measurement(F.col("name")).alias("measurement"))


@register("R9", "select program, name, value, seq from v_measurements", "v_measurements")
def r9(rows):
    return rows.select(metrics.record(F.col("program"), "count", F.col("value"), F.col("seq")).withField("name", F.col("name")).alias("m")).select("m.*")


# Sample arrays




@register("X1", "select vec_id, len(embedding) / 16000 as duration from embeddings", "embeddings")
def x1(rows):
    return rows.select("vec_id", arrays.array_duration(F.col("embedding"), F.lit(16000)).alias("duration"))


_PAD = "list_concat(embedding, list_transform(range(0, greatest(100 + vec_id % 50 - len(embedding), 0)), lambda i: 0::float))"


@register("X2", f"select vec_id, len(p) as length, round(list_sum(list_transform(range(1, len(p) + 1), lambda i: p[i]::double * i)), 4) as checksum from (select vec_id, {_PAD} as p from embeddings)", "embeddings")
def x2(rows):
    padded = arrays.pad_right(F.col("embedding"), F.lit(100) + F.col("vec_id") % 50)
    return rows.select("vec_id", padded.alias("p")).select("vec_id", F.size("p").alias("length"), weighted("p").alias("checksum"))


def weighted(column: str):
    """A sum of samples by position."""
    return F.round(F.aggregate(F.transform(column, lambda x, i: x.cast("double") * (i + 1)), F.lit(0.0), lambda a, x: a + x), 4)


@register("X3", "select vec_id, len(embedding) as length, round(list_sum(list_transform(range(1, len(embedding) + 1), lambda i: ((embedding[i]::double + embedding[len(embedding) + 1 - i]::double) / 2)::float::double * i)), 4) as checksum from embeddings", "embeddings")
def x3(rows):
    both = rows.select("vec_id", arrays.mono(F.array("embedding", F.reverse("embedding"))).alias("m"))
    return both.select("vec_id", F.size("m").alias("length"), weighted("m").alias("checksum"))


@register("X6", "select vec_id, len(embedding) * 4 as bytes from embeddings", "embeddings")
def x6(rows):
    return rows.select("vec_id", arrays.array_bytes(F.col("embedding")).alias("bytes"))


@register("X7", "select vec_id, embedding[1] as first, len(embedding) as n from embeddings", "embeddings")
def x7(rows):
    one = rows.select("vec_id", arrays.squeeze(F.array("embedding", F.reverse("embedding"))).alias("s"))
    return one.select("vec_id", F.get("s", F.lit(0)).alias("first"), F.size("s").alias("n"))


@register("X9", "select vec_id, len(embedding) as samples, 2 as channels from embeddings", "embeddings")
def x9(rows):
    return rows.select("vec_id", arrays.shape(F.array("embedding", "embedding")).alias("s")).select("vec_id", "s.*")


@register("I2", f"select doc_id, {_CODE} as lang from v_predictions", "v_predictions")
def i2(pred):
    return pred.select("doc_id", _code().alias("lang"))


# Documents as JSON, read back and changed


def raw_documents(cat: DataFrame) -> DataFrame:
    """The catalog as JSON texts: a claim that isn't there is missing, one that is null is null."""
    dialog = F.when(F.col("doc_id") % 7 != 0, F.array(F.struct(F.lit("recording").alias("type"), F.concat(F.lit("d-"), "basename").alias("basename"), F.col("filename").alias("filename"), F.col("duration").cast("string").alias("duration"), F.col("size_bytes").alias("size_bytes"), F.lit(16000).alias("sample_rate"))))
    text_of = F.array(F.struct(F.lit("transcript").alias("type"), F.struct(F.concat(F.lit("text of "), "basename").alias("text")).alias("body")))
    body = F.to_json(F.struct("uuid", "basename", "filename", "done", "corrupt", F.when(F.col("claim_present"), F.col("processed_by")).alias("processed_by"), dialog.alias("dialog"), text_of.alias("analysis")))
    null_claim = F.col("claim_present") & F.col("processed_by").isNull()
    return cat.select(F.when(null_claim, F.regexp_replace(body, r"\}$", ',"processed_by":null}')).otherwise(body).alias("value"))


def typed(cat: DataFrame) -> DataFrame:
    return documents.parse_documents(raw_documents(cat))


@register("P2", "select uuid, '0.0.2' as vcon, basename, filename, done, corrupt, case when claim_present then processed_by end as processed_by, claim_present, case when doc_id % 7 <> 0 then 1 else 0 end as n_dialog from v_catalog", "v_catalog")
def p2(cat):
    return typed(cat).select("uuid", "vcon", "basename", "filename", "done", "corrupt", "processed_by", "claim_present", F.size("dialog").alias("n_dialog"))


@register("P4", "select uuid, concat('new-', basename) as filename, case when doc_id % 7 <> 0 then concat('d-', basename) end as basename, case when doc_id % 7 <> 0 then duration else 0 end as duration from v_catalog", "v_catalog")
def p4(cat):
    out = typed(cat).withColumn("dialog", documents.with_first_dialog("filename", F.concat(F.lit("new-"), "basename")))
    return out.select("uuid", *(documents.first_dialog(f).alias(f) for f in ("filename", "basename", "duration")))


@register("P9", "select uuid, concat('text of ', basename) as first, concat('more of ', basename) as last from v_catalog", "v_catalog")
def p9(cat):
    out = typed(cat).withColumn("analysis", documents.append_transcript(F.col("analysis"), F.concat(F.lit("more of "), "basename"), "backend"))
    return out.select("uuid", documents.transcript(F.col("analysis")).alias("first"), documents.transcript(F.col("analysis"), "last").alias("last"))


@register("P10", "select uuid, 'en,es' as languages, 2 as n from v_catalog", "v_catalog")
def p10(cat):
    out = typed(cat).withColumn("analysis", documents.append_languages(F.col("analysis"), F.array(F.lit("en"), F.lit("es")), "backend"))
    return out.select("uuid", F.array_join(documents.languages(F.col("analysis")), ",").alias("languages"), F.size("analysis").alias("n"))


@register("F23", "select uuid, basename as party, case when doc_id % 7 <> 0 then 2 else 1 end as n_dialog from v_catalog", "v_catalog")
def f23(cat):
    party = F.struct(F.col("basename").alias("name"), F.lit("agent").alias("role"))
    dialog = F.struct(*(F.lit(None).cast(t).alias(f) for f, t in documents.DIALOG_FIELDS.items()))
    out = typed(cat).withColumns({"parties": documents.append_to("parties", party), "dialog": documents.append_to("dialog", dialog)})
    return out.select("uuid", F.get("parties", F.lit(0))["name"].alias("party"), F.size("dialog").alias("n_dialog"))


@register("S10", "select uuid, false as has_claim, cast(null as bigint) as size_bytes, case when doc_id % 7 <> 0 then filename end as filename from v_catalog", "v_catalog")
def s10(cat):
    lines = documents.export_form(typed(cat)).select(F.to_json(F.struct("*")).alias("value"))
    has_claim = F.array_contains(F.json_object_keys("value"), "processed_by").alias("has_claim")
    return lines.select(documents.item(F.col("value"), "uuid").alias("uuid"), has_claim, F.get_json_object("value", "$.dialog[0].size_bytes").cast("bigint").alias("size_bytes"), F.get_json_object("value", "$.dialog[0].filename").alias("filename"))


@register("S17", "select * from (" + ORACLES["A8"] + ")", "v_measurements")
def s17(rows):
    spark = rows.sparkSession
    path = scratch_path(spark, "report")
    store.save_report(a8(rows), path, "1", "2024-01-01T00:00:00Z")
    columns = {c: "string" if c in ("program", "state") else "double" for c in a8(rows).columns}
    return spark.read.schema(", ".join(f"`{c}` {t}" for c, t in columns.items())).json(path)


# Sound made of the embeddings, and backends that tell what they were given


def wavs(rows: DataFrame) -> DataFrame:
    return audio.wav_files(rows, F.concat(F.lit("v"), F.col("vec_id").cast("string"), F.lit(".wav")), F.col("embedding"))


@register("S18", "select concat('v', vec_id, '.wav') as path, 16000 as sample_rate, len(embedding) / 16000 as duration, 1 as channels, len(embedding) as samples from embeddings", "embeddings")
def s18(rows):
    loaded = audio.load(wavs(rows))
    return loaded.select("path", "sample_rate", "duration", F.size("channels").alias("channels"), F.size(F.get("channels", F.lit(0))).alias("samples"))


def toy_decoder(content: bytes):
    """Sound squeezed by zlib, for a medium that only a plug-in reads."""
    return audio.decode_wav(zlib.decompress(content))


@register("S18_media", "select concat('v', vec_id, case when vec_id % 3 = 0 then '.MP3' when vec_id % 3 = 1 then '.wav' else '.flac' end) as path, case when vec_id % 3 < 2 then 16000 end as sample_rate, case when vec_id % 3 < 2 then len(embedding) end as samples, case when vec_id % 3 = 2 then 'ValueError: no decoder for audio/flac' end as error from embeddings", "embeddings")
def s18_media(rows):
    """A third of the recordings is in a medium with a decoder of its own, a third in one without any."""

    @F.pandas_udf("binary")
    def squeezed(content: pd.Series) -> pd.Series:
        return content.map(zlib.compress)

    third = F.col("vec_id") % 3
    name = F.concat(F.lit("v"), F.col("vec_id").cast("string"), F.when(third == 0, F.lit(".MP3")).when(third == 1, F.lit(".wav")).otherwise(F.lit(".flac")))
    found = audio.wav_files(rows, name, F.col("embedding"))
    found = found.withColumn("content", F.when(F.endswith("path", F.lit(".MP3")), squeezed("content")).otherwise(F.col("content")))
    loaded = audio.load(found, {"audio/mpeg": toy_decoder})
    return loaded.select("path", "sample_rate", F.size(F.get("channels", F.lit(0))).alias("samples"), "error").withColumn("samples", F.when(F.col("error").isNull(), F.col("samples")))


@register("P16", "select concat('v', vec_id, '.wav') as path, vec_id % 10 <> 0 as valid from embeddings", "embeddings")
def p16(rows):
    damaged = wavs(rows).withColumn("content", F.when(F.col("path").rlike(r"0\.wav$"), F.substring("content", 1, 20)).otherwise(F.col("content")))
    good, bad = audio.split_valid(audio.probe(damaged))
    return good.select("path", F.lit(True).alias("valid")).unionAll(bad.select("path", F.lit(False).alias("valid")))


@register("X4", "select vec_id, 2 * len(embedding) as length from embeddings", "embeddings")
def x4(rows):
    return rows.select("vec_id", F.size(audio.resampled(F.col("embedding"), 8000)).alias("length"))


@register("X5", "select vec_id, 320 + len(embedding) as length from embeddings", "embeddings")
def x5(rows):
    quiet = F.concat(F.array_repeat(F.lit(0.0).cast("float"), 640), F.array_repeat(F.lit(0.5).cast("float"), 320), F.col("embedding"))
    return rows.select("vec_id", F.size(audio.trimmed(quiet)).alias("length"))


@register("X8", "select concat('v', vec_id, '.wav') as path, len(embedding) / 16000 as duration, len(embedding) as samples, cast(null as varchar) as error from embeddings", "embeddings")
def x8(rows):
    return audio.preprocess(wavs(rows)).select("path", "duration", F.size("samples").alias("samples"), "error")


def sign_backend():
    return lambda batch: [int(x[0] > 0) for x in batch]


def length_backend(name: str):
    return lambda: lambda batch: [[f"{name} {len(x)}"] for x in batch]


@register("I1", "select vec_id, case when embedding[1] > 0 then 1 else 0 end as label_idx from embeddings", "embeddings")
def i1(rows):
    return rows.select("vec_id", inference.label_indexes(F.col("embedding"), sign_backend).alias("label_idx"))


_HEARD = "select vec_id, concat('{}', ' ', len(embedding)) as transcript from embeddings"


@register("I3", _HEARD.format("any"), "embeddings")
def i3(rows):
    return rows.select("vec_id", inference.transcripts(F.col("embedding"), length_backend("any")).alias("transcript"))


@register("I4", "select vec_id, case when vec_id % 2 = 0 then 'x' else '' end as transcript from embeddings", "embeddings")
def i4(rows):
    backend = lambda: lambda batch: ["x" if int(a[0]) % 2 == 0 else None for a in batch]
    return rows.select("vec_id", inference.transcripts(F.array("vec_id"), backend).alias("transcript"))


@register("J11", "select vec_id, 'heard' as transcript from embeddings", "embeddings")
def j11(rows):
    return rows.select("vec_id", inference.transcripts(F.col("embedding"), lambda: lambda batch: ["heard"] * len(batch)).alias("transcript"))


@register("I6", "select vec_id, concat(case when label % 2 = 0 then 'en' else 'other' end, ' ', len(embedding)) as transcript from embeddings", "embeddings")
def i6(rows):
    routed = rows.select("vec_id", "embedding", F.when(F.col("label") % 2 == 0, F.lit("en")).otherwise(F.lit("other")).alias("route"))
    return inference.transcribe_routes(routed, {"en": length_backend("en"), "other": length_backend("other")}, "embedding").select("vec_id", "transcript")


# Recordings made of the embeddings, as files. Every tenth name is damaged, every seventh has a note beside it.

LABELS = ["en", "es"]
FILES_AT_ONCE = 4096


def write_recordings(rows: DataFrame, name: str = "recordings") -> str:
    """A new folder with a recording for each row; the bytes of damaged ones are no sound."""
    root = scratch_path(rows.sparkSession, name)
    sound = wavs(rows).withColumn("content", F.when(F.col("path").rlike(r"0\.wav$"), F.lit(b"RIFF")).otherwise(F.col("content")))
    notes = rows.where("vec_id % 7 = 0").select(F.concat(F.lit("notes/v"), F.col("vec_id").cast("string"), F.lit(".txt")).alias("path"), F.lit(b"note").alias("content"))
    files.write_contents(sound.unionByName(notes), root)
    return root


def length_routes() -> dict:
    return {route: length_backend(route) for route in ("en", "other")}


_NAMES = "concat('v', vec_id) as basename"
_SIZE = "case when vec_id % 10 = 0 then 4 else 44 + 2 * len(embedding) end"
_SPANISH = "trunc(greatest(-1, least(1, embedding[1])) * 32767) > 0"


@register("S1", f"select {_NAMES}, {_SIZE} as length from embeddings", "embeddings")
def s1(rows):
    return files.inventory(rows.sparkSession, write_recordings(rows)).select("basename", "length")


@register("S2", f"select concat('v', vec_id, '.wav') as name, {_SIZE} as length from embeddings union all select concat('v', vec_id, '.txt'), 4 from embeddings where vec_id % 7 = 0", "embeddings")
def s2(rows):
    found = files.inventory(rows.sparkSession, write_recordings(rows), audio_only=False)
    return found.select(F.substring_index("path", "/", -1).alias("name"), "length")


@register("S1_changes", f"select {_NAMES}, case when vec_id % 5 = 1 then 'gone' when vec_id % 5 = 2 then 'changed' else 'added' end as change from embeddings where vec_id % 5 in (1, 2, 3)", "embeddings")
def s1_changes(rows):
    """Two inventories of a folder: between them a fifth of the recordings goes (to another name), one grows, one comes."""
    spark, snapshots = rows.sparkSession, scratch_path(rows.sparkSession, "inventories")
    before = files.inventory(spark, write_recordings(rows.where("vec_id % 5 <> 3")))
    after = files.inventory(spark, write_recordings(rows.where("vec_id % 5 <> 1").withColumn("embedding", F.when(F.col("vec_id") % 5 == 2, F.concat("embedding", "embedding")).otherwise(F.col("embedding")))))
    both = []
    for i, found in enumerate((before, after)):  # as if of one folder, and damaged files as changed as others
        grown = F.when(F.regexp_extract("basename", "[0-9]+", 0).cast("long") % 5 == 2, F.col("length") + i).otherwise(F.col("length"))
        found.withColumns({"path": F.substring_index("path", "/", -1), "length": grown, "modificationTime": F.lit(None).cast("timestamp")}).write.parquet(f"{snapshots}/version={i}")
        both.append(spark.read.parquet(f"{snapshots}/version={i}"))
    return files.differences(*both).select("basename", "change")


# Streams over the tables, run until their input is used up


def run_out(query) -> None:
    query.awaitTermination()


@register("R1", f"select {_NAMES}, {_SIZE} as size_bytes, false as done from embeddings", "embeddings")
def r1(rows):
    """New recordings stream into the catalog's log as documents."""
    spark, root = rows.sparkSession, write_recordings(rows)
    log = scratch_path(spark, "log")
    run_out(process.start_discovery(process.file_stream(spark, root, max_files=FILES_AT_ONCE), log, scratch_path(spark, "checkpoint"), availableNow=True))
    return store.load_all(spark, log).select("basename", F.get("dialog", F.lit(0))["size_bytes"].alias("size_bytes"), "done")


@register("R2", f"select {_NAMES}, true as done, vec_id % 10 = 0 or vec_id % 4 = 1 as corrupt, case when vec_id % 10 <> 0 and vec_id % 4 <> 1 then concat(case when {_SPANISH} then 'other' else 'en' end, ' ', len(embedding)) end as transcript from embeddings", "embeddings")
def r2(rows):
    """Documents wait in a log of states, those of a quarter without their file; claims go on until none is pending."""
    spark, root = rows.sparkSession, write_recordings(rows.where("vec_id % 4 <> 1"))
    log = scratch_path(spark, "states")
    lost = rows.where("vec_id % 4 = 1").select(F.concat(F.lit(f"{root}/lost/v"), F.col("vec_id").cast("string"), F.lit(".wav")).alias("filename"), F.lit(0).cast("long").alias("size_bytes"))
    store.append(process.enlisted(documents.new_documents(lost)), log, -1)
    stream = process.file_stream(spark, root, max_files=FILES_AT_ONCE)
    run_out(process.start_claims(stream, log, scratch_path(spark, "queue"), "host", scratch_path(spark, "checkpoint"), sign_backend, LABELS, length_routes(), availableNow=True))
    return store.load_all(spark, log).select("basename", "done", "corrupt", "transcript")


@register("R3", "select count(*) as files, cast(ceil(count(*) / 4096) as bigint) as batches from embeddings", "embeddings")
def r3(rows):
    """Micro-batches of a bounded number of files."""
    spark, root = rows.sparkSession, write_recordings(rows)
    log = scratch_path(spark, "log")
    run_out(process.start_discovery(process.file_stream(spark, root, max_files=FILES_AT_ONCE), log, scratch_path(spark, "checkpoint"), availableNow=True))
    return spark.read.parquet(log).agg(F.count("*").alias("files"), F.count_distinct("seq").alias("batches"))


def processing(rows: DataFrame, **options) -> DataFrame:
    """The catalog's state after the stream of recordings has been processed."""
    spark, root = rows.sparkSession, write_recordings(rows)
    log = scratch_path(spark, "log")
    run_out(process.start_processing(process.file_stream(spark, root, max_files=FILES_AT_ONCE), log, scratch_path(spark, "checkpoint"), sign_backend, LABELS, length_routes(), options, availableNow=True))
    return store.load_all(spark, log, "basename")


@register("R11", f"select {_NAMES}, true as done, vec_id % 10 = 0 as corrupt, case when vec_id % 10 <> 0 then len(embedding) / 16000 end as duration from embeddings", "embeddings")
def r11(rows):
    return processing(rows).select("basename", "done", "corrupt", "duration")


@register("R11_observed", f"select 'processing' as program, unnest(['count', 'bytes', 'duration']) as name, unnest([count(*), sum({_SIZE}), round(sum(case when vec_id % 10 <> 0 then len(embedding) / 16000 end), 6)]) as value from embeddings", "embeddings")
def r11_observed(rows):
    """Measurements that the processing job observes while it writes."""
    spark, root = rows.sparkSession, write_recordings(rows)
    log, measured = scratch_path(spark, "log"), scratch_path(spark, "measured")
    stream = process.file_stream(spark, root, max_files=FILES_AT_ONCE)
    run_out(process.start_processing(stream, log, scratch_path(spark, "checkpoint"), sign_backend, LABELS, length_routes(), {"measured": measured}, availableNow=True))
    return live_metrics.emitted(spark, measured).groupBy("program", "name").agg(F.round(F.sum("value"), 6).alias("value"))


@register("R12", f"select {_NAMES}, case when vec_id % 10 <> 0 then case when {_SPANISH} then 'es' else 'en' end end as language, vec_id % 10 = 0 or {_SPANISH} as corrupt, case when vec_id % 10 <> 0 and not {_SPANISH} then concat('en ', len(embedding)) end as transcript from embeddings", "embeddings")
def r12(rows):
    """What isn't English is marked corrupt and isn't transcribed."""
    return processing(rows, drop_others=True).select("basename", "language", "corrupt", "transcript")


@register("R13", f"select {_NAMES}, case when vec_id % 10 <> 0 then concat(case when {_SPANISH} then 'other' else 'en' end, ' ', len(embedding)) end as transcript from embeddings", "embeddings")
def r13(rows):
    return processing(rows).select("basename", "transcript")


@register("R4", _MERGED, "v_catalog", "v_incoming")
def r4(cat, incoming):
    """New documents stream into the catalog's log; its last versions are the merged catalog."""
    spark = cat.sparkSession
    log, source, checkpoint = (scratch_path(spark, n) for n in ("log", "incoming", "checkpoint"))
    columns = ["uuid", "basename", "filename", "size_bytes"]
    store.append(cat.select(columns), log, -1)
    incoming.select(columns).write.parquet(source)
    stream = spark.readStream.schema("uuid string, basename string, filename string, size_bytes long").parquet(source)
    query = stream.writeStream.foreachBatch(lambda batch, i: store.append(batch, log, i)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return store.load_all(spark, log)


@register("S14_compacted", _MERGED, "v_catalog", "v_incoming")
def s14_compacted(cat, incoming):
    """The log of a catalog, compacted twice: the last snapshot with the versions after it is the merged catalog."""
    spark = cat.sparkSession
    log, snapshots = scratch_path(spark, "log"), scratch_path(spark, "snapshots")
    columns = ["uuid", "basename", "filename", "size_bytes"]
    new = incoming.select(columns)
    store.append(cat.select(columns), log, 0)
    store.compact(spark, log, snapshots)
    store.append(new.where(F.crc32(F.col("uuid").cast("binary")) % 2 == 0), log, 1)
    store.compact(spark, log, snapshots)
    store.append(new.where(F.crc32(F.col("uuid").cast("binary")) % 2 == 1), log, 2)
    return store.load_all(spark, log, snapshots=snapshots)


@contextmanager
def state_in_rocksdb(spark: SparkSession) -> Iterator[None]:
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    live_metrics.use_rocksdb(spark)
    try:
        yield
    finally:
        spark.conf.set(key, before)


@register("R6", f"select program, round(count, 3) as count, round(bytes, 3) as bytes, round(duration, 3) as duration, round(blocked, 2) as blocked from ({_SUMS}) join ({_WAITS}) using (program)", "v_measurements")
def r6(rows):
    """The measurements as a stream, folded by program and range of seq; the status of each program from its ranges."""
    spark = rows.sparkSession
    source, out, checkpoint = (scratch_path(spark, n) for n in ("measurements", "status", "checkpoint"))
    live_metrics.write_ranges(rows.select("program", "name", F.col("value").cast("double").alias("value"), "seq", "ts"), source)
    with state_in_rocksdb(spark):
        stream = live_metrics.program_status(spark.readStream.schema(f"{live_metrics.MEASUREMENT}, range int").option("maxFilesPerTrigger", live_metrics.RANGE_FILES).parquet(source), ranged=True)
        query = stream.writeStream.outputMode("update").foreachBatch(lambda batch, i: batch.withColumn("batch", F.lit(i)).write.mode("append").parquet(out)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    last = live_metrics.merged(spark.read.parquet(out).dropDuplicates(["program", "range"]))
    return rounded(last.select("program", *metrics.MEASURES, F.round("blocked", 2).alias("blocked")), *metrics.MEASURES, places=3)


_TOTALS = f"select program, round(count, 3) as count, round(bytes, 3) as bytes, round(duration, 3) as duration from ({_SUMS})"


def emitted(rows: DataFrame) -> tuple[SparkSession, DataFrame]:
    """Measurements as a stream of files, each a range of seq; a micro-batch takes as many as a program's rows may be held of at once."""
    spark, source = rows.sparkSession, scratch_path(rows.sparkSession, "measurements")
    live_metrics.write_ranges(rows.select("program", "name", F.col("value").cast("double").alias("value"), "seq", "ts"), source)
    return spark, spark.readStream.schema(live_metrics.MEASUREMENT).option("maxFilesPerTrigger", live_metrics.RANGE_FILES).parquet(source)


@register("R7", _TOTALS, "v_measurements")
def r7(rows):
    """Reports at intervals: each holds the statuses so far of the programs that changed."""
    spark, stream = emitted(rows)
    log = scratch_path(spark, "reports")
    with state_in_rocksdb(spark):
        sink = lambda batch, i: batch.withColumn("batch", F.lit(i).cast("long")).write.mode("append").parquet(log)
        live_metrics.start_reports(live_metrics.program_status(stream), sink, scratch_path(spark, "checkpoint"), availableNow=True).awaitTermination()
    return rounded(live_metrics.last_statuses(spark, log).select("program", *metrics.MEASURES), *metrics.MEASURES, places=3)


@register("R8", _TOTALS, "v_measurements")
def r8(rows):
    """A stream that falls silent: it is stopped, and the last statuses are saved as a report."""
    spark, stream = emitted(rows)
    log, report = scratch_path(spark, "reports"), scratch_path(spark, "report")
    with state_in_rocksdb(spark):
        live_metrics.report_until_idle(stream, 2.0, log, report, scratch_path(spark, "checkpoint"), "1", "2024-01-01T00:00:00Z", timeout=600)
    saved = spark.read.schema("program string, count double, bytes double, duration double, expired boolean").json(report)
    return rounded(saved.where("expired").select("program", *metrics.MEASURES), *metrics.MEASURES, places=3)
