"""The driver's tables as listings, catalogs and measurements. One SQL text serves Spark and the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

EXT = "case when doc_id % 4 = 0 then '.mp3' when doc_id % 11 = 0 then '.WAV' else '.wav' end"
KEY = "concat('rec', cast(doc_id as varchar(20)))"

_LISTING = f"""select doc_id, {KEY} as basename, source,
  concat('vol', cast(doc_id % 8 + 1 as varchar(20)), '-x/', source, '/', {KEY}, {EXT}) as object_key,
  concat('/data/', source, '/', {KEY}, {EXT}) as local_path,
  n_chars as size_bytes, cast(n_chars as double) / 16.0 as duration from documents"""

VIEWS = {
    "v_listing": _LISTING,
    "v_local": """select basename, local_path,
  case when doc_id % 7 = 0 then 0 when doc_id % 6 = 0 then size_bytes - 1 else size_bytes end as local_size
  from v_listing where doc_id % 2 = 0""",
    "v_catalog": """select concat('u', cast(l.doc_id as varchar(20))) as uuid, l.doc_id, l.basename, l.size_bytes, l.duration,
  case when l.doc_id % 3 = 0 then null when l.doc_id % 3 = 1 then l.local_path else 'sftp://old' end as filename,
  l.doc_id as created_seq, coalesce(b.quality = 1, false) as done, coalesce(b.toxic = 1, false) as corrupt,
  case when l.doc_id % 4 = 1 then concat('host', cast(l.doc_id % 3 as varchar(20))) end as processed_by,
  (l.doc_id % 4 = 1 or l.doc_id % 10 = 3) as claim_present,
  case when d.lang = 'es' then 'es' else 'en' end as language
  from v_listing l join documents d on l.doc_id = d.doc_id left join labels b on l.doc_id = b.doc_id where l.doc_id % 5 <> 0""",
    "v_incoming": "select concat('u', cast(doc_id as varchar(20))) as uuid, basename, local_path as filename, size_bytes + 1 as size_bytes, doc_id as seq from v_listing where doc_id % 9 = 0",
    "v_predictions": """select doc_id, lang as predicted_code, case lang when 'en' then 0 when 'es' then 1 when 'fr' then 2 else 99 end as label_idx,
  (doc_id % 13 = 0) as no_audio from documents""",
    "v_measurements": """select event_id as seq, epoch_seconds as ts, value, concat('p', cast(user_id % 7 as varchar(20))) as program,
  case event_type when 'click' then 'count' when 'view' then 'bytes' when 'purchase' then 'duration' when 'signup' then 'start_blocking' else 'stop_blocking' end as name from v_events""",
}
_NEEDS = {"v_local": ["v_listing"], "v_catalog": ["v_listing", "documents", "labels"], "v_incoming": ["v_listing"], "v_measurements": ["v_events"], "v_listing": ["documents"], "v_predictions": ["documents"]}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table, or a view of it."""
    if name == "v_events":
        return table(spark, sf_dir, "events").selectExpr("*", "unix_micros(cast(ts as timestamp)) / 1e6d as epoch_seconds")
    if name not in VIEWS:
        return table(spark, sf_dir, name)
    text = VIEWS[name]
    for needed in sorted(_NEEDS[name], key=len, reverse=True):
        text = text.replace(f"from {needed}", f"from {{{needed}}}").replace(f"join {needed}", f"join {{{needed}}}")
    return spark.sql(text, **{n: view(spark, sf_dir, n) for n in _NEEDS[name]})


def oracle(query: str) -> str:
    """A DuckDB query with the views it names as common table expressions before it."""
    events = "v_events as (select *, epoch_us(ts) / 1e6 as epoch_seconds from events)"
    wanted: list[str] = []

    def need(text: str) -> None:
        for name in VIEWS:
            if name in text and name not in wanted:
                need(VIEWS[name])
                wanted.append(name)

    need(query)
    ctes = ([events] if "v_measurements" in wanted else []) + [f"{n} as ({VIEWS[n]})" for n in wanted]
    return f"with {', '.join(ctes)} {query}" if ctes else query
