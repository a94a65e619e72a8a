"""Conversation documents: their schema, and columns that read or change nested parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkmill.functions import paths, text

FORMAT_VERSION = "0.0.2"

DIALOG = "struct<type:string,start:string,parties:array<int>,originator:int,mediatype:string,mimetype:string,filename:string,basename:string,encoding:string,duration:string,sample_rate:int,size_bytes:bigint>"
ANALYSIS = "struct<type:string,vendor:string,encoding:string,dialog:int,body:variant,vendor_schema:variant>"
DOCUMENT = f"uuid string, basename string, filename string, created_at string, done boolean, corrupt boolean, processed_by string, parties array<struct<name:string,role:string>>, dialog array<{DIALOG}>, analysis array<{ANALYSIS}>, attachments array<struct<type:string,encoding:string,body:array<string>>>, appended variant, redacted variant"

DIALOG_FIELDS = {"type": "string", "start": "string", "parties": "array<int>", "originator": "int", "mediatype": "string", "mimetype": "string", "filename": "string", "basename": "string", "encoding": "string", "duration": "double", "sample_rate": "int", "size_bytes": "bigint"}


def parse_documents(raw: DataFrame, column: str = "value") -> DataFrame:
    """JSON text, one document a row, to typed documents. What is missing or of the wrong kind gets its default.

    claim_present tells a missing processed_by from a null one. Numbers written as text are read.
    """
    kept = raw.select(F.col(column).alias("raw"))
    # A part of the wrong kind would spoil the parse of all, so each part is parsed on its own.
    part = {p: F.get_json_object("raw", f"$.{p}") for p in ("dialog", "analysis", "parties", "attachments")}
    kinds = {"dialog": f"array<{DIALOG}>", "analysis": f"array<{ANALYSIS}>", "parties": "array<struct<name:string,role:string>>", "attachments": "array<struct<type:string,encoding:string,body:array<string>>>"}
    lists = {p: F.coalesce(F.when(F.startswith(F.trim(c), F.lit("[")), F.from_json(c, kinds[p])), F.from_json(F.lit("[]"), kinds[p])) for p, c in part.items()}
    top = {c: F.get_json_object("raw", f"$.{c}") for c in ("uuid", "basename", "filename", "created_at", "processed_by")}
    out = kept.select(
        *(v.alias(k) for k, v in top.items()),
        F.lit(FORMAT_VERSION).alias("vcon"),
        F.coalesce(F.get_json_object("raw", "$.done").try_cast("boolean"), F.lit(False)).alias("done"),
        F.coalesce(F.get_json_object("raw", "$.corrupt").try_cast("boolean"), F.lit(False)).alias("corrupt"),
        F.coalesce(F.array_contains(F.json_object_keys("raw"), "processed_by"), F.lit(False)).alias("claim_present"),
        *(v.alias(k) for k, v in lists.items()),
        F.try_parse_json(F.get_json_object("raw", "$.appended")).alias("appended"),
        F.try_parse_json(F.get_json_object("raw", "$.redacted")).alias("redacted"),
    )
    return out.withColumns({"dialog": F.transform("dialog", lambda d: d.withField("duration", d["duration"].try_cast("double"))), "created_at": F.try_to_timestamp("created_at")})


def first_dialog(field: str, dialog: Column | None = None) -> Column:
    """A field of the first dialog; a duration is 0 and other fields null where there is none."""
    value = F.get(F.col("dialog") if dialog is None else dialog, F.lit(0))[field]
    return F.coalesce(value, F.lit(0.0)) if field == "duration" else value


def with_first_dialog(field: str, value: Column, dialog: Column | None = None) -> Column:
    """The dialogs with a field of the first one set; one is made where there is none."""
    dialog = F.col("dialog") if dialog is None else dialog
    empty = F.array(F.struct(*((value if f == field else F.lit(None)).cast(t).alias(f) for f, t in DIALOG_FIELDS.items())))
    changed = F.transform(dialog, lambda d, i: F.when(i == 0, d.withField(field, value.cast(DIALOG_FIELDS[field]))).otherwise(d))
    return F.when(F.coalesce(F.size(dialog), F.lit(0)) > 0, changed).otherwise(empty)


def effective_basename(basename: Column, dialog: Column) -> Column:
    return F.coalesce(basename, F.get(dialog, F.lit(0))["basename"])


def analysis_of(kind: str, analysis: Column, pick: str = "first") -> Column:
    """The first (or last) analysis of a type, or null."""
    found = F.filter(analysis, lambda a: a["type"] == kind)
    return F.get(found, F.lit(0)) if pick == "first" else F.try_element_at(found, F.lit(-1))


def transcript(analysis: Column, pick: str = "first") -> Column:
    """The transcript's text, under either of the two keys in use."""
    body = analysis_of("transcript", analysis, pick)["body"]
    return F.coalesce(F.try_variant_get(body, "$.text", "string"), F.try_variant_get(body, "$.transcript", "string"))


def languages(analysis: Column, pick: str = "first") -> Column:
    """Language codes: a list, or the keys of an object; null without a language entry."""
    body = analysis_of("language_identification", analysis, pick)["body"]
    return F.coalesce(F.try_variant_get(body, "$.languages", "array<string>"), F.map_keys(F.try_variant_get(body, "$.languages", "map<string,variant>")))


def analysis_entry(kind: str, body_json: Column, vendor: str) -> Column:
    return F.struct(F.lit(kind).alias("type"), F.lit(vendor).alias("vendor"), F.lit(None).cast("string").alias("encoding"), F.lit(0).alias("dialog"), F.parse_json(body_json).alias("body"), F.lit(None).cast("variant").alias("vendor_schema"))


def append_transcript(analysis: Column, words: Column, vendor: str) -> Column:
    return F.array_append(analysis, analysis_entry("transcript", F.to_json(F.struct(words.alias("text"))), vendor))


def append_languages(analysis: Column, codes: Column, vendor: str) -> Column:
    return F.array_append(analysis, analysis_entry("language_identification", F.to_json(F.struct(codes.alias("languages"))), vendor))


def is_english(codes: Column) -> Column:
    """Exactly one language, and that is English."""
    return F.coalesce((F.size(codes) == 1) & (F.get(codes, F.lit(0)) == "en"), F.lit(False))


def summary(uuid: Column, duration: Column, size: Column, codes: Column, words: Column) -> Column:
    """One line about a document: id, length, size, languages, and the transcript's beginning."""
    seconds = F.format_string("%.2fs", text.fixed(duration, 2))
    listed = F.when(F.size(codes) > 0, F.array_join(codes, ", ")).otherwise(F.lit("N/A"))
    parts = (F.coalesce(uuid, F.lit("N/A")), F.when(duration.isNull(), F.lit("N/A")).otherwise(seconds), F.coalesce(text.human_bytes(size), F.lit("N/A")), listed, F.coalesce(text.shortened(words), F.lit("None")))
    return F.format_string("Vcon(%s, %s, %s, lang=%s, transcript='%s')", *parts)


def new_documents(urls: DataFrame, url_col: str = "filename", now: Column | None = None) -> DataFrame:
    """A fresh document for each recording: one unknown party, and one dialog that points to the file."""
    now = F.current_timestamp() if now is None else now
    url = F.col(url_col)
    values = {"type": F.lit("recording"), "start": F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"), "parties": F.array(F.lit(0)), "originator": F.lit(0), "mediatype": paths.media_type(url), "filename": url, "basename": paths.basename(url), "encoding": F.lit("none"), "size_bytes": F.col("size_bytes") if "size_bytes" in urls.columns else F.lit(None)}
    dialog = F.struct(*(values.get(f, F.lit(None)).cast(t).alias(f) for f, t in DIALOG_FIELDS.items()))
    return urls.select(text.random_uuid8().alias("uuid"), F.lit(FORMAT_VERSION).alias("vcon"), paths.basename(url).alias("basename"), now.alias("created_at"), F.lit(False).alias("done"), F.lit(False).alias("corrupt"), F.lit(None).cast("string").alias("processed_by"), F.lit(False).alias("claim_present"), F.array(F.struct(F.lit("Unknown").alias("name"), F.lit("participant").alias("role"))).alias("parties"), F.array(dialog).alias("dialog"), F.from_json(F.lit("[]"), f"array<{ANALYSIS}>").alias("analysis"))


def append_to(column: str, value: Column) -> Column:
    """A nested list (parties, dialog) with one more element."""
    return F.array_append(F.col(column), value)


def keys(raw: Column) -> Column:
    """The top-level keys of a document's JSON."""
    return F.json_object_keys(raw)


def item(raw: Column, key: str) -> Column:
    """A top-level value of a document's JSON as text; null where it is missing."""
    return F.get_json_object(raw, f"$.{key}")


def export_form(docs: DataFrame) -> DataFrame:
    """Documents as they are exported: without claim, and without size and rate of the first dialog."""
    dialog = F.transform("dialog", lambda d, i: F.when(i == 0, d.withField("size_bytes", F.lit(None).cast("bigint")).withField("sample_rate", F.lit(None).cast("int"))).otherwise(d))
    return docs.withColumn("dialog", dialog).drop("_id", "processed_by", "claim_present")
