"""Columns over file names, object keys and URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The extensions that count as recordings.
AUDIO_EXTENSIONS = ["wav", "mp3", "ogg", "m4a", "flac", "aac", "wma", "aiff", "au", "raw", "pcm"]

# Media types by lower-case extension.
MEDIA_TYPES = {
    "wav": "audio/x-wav",
    "mp3": "audio/mpeg",
    "ogg": "audio/ogg",
    "m4a": "audio/mp4",
    "flac": "audio/flac",
    "aac": "audio/aac",
    "aiff": "audio/x-aiff",
    "au": "audio/basic",
}


def last_segment(path: Column) -> Column:
    return F.regexp_extract(path, r"[^/]*$", 0)


def extension(path: Column) -> Column:
    """What follows the last dot of the last segment; empty for null, without a dot, or with leading dots only."""
    return F.coalesce(F.regexp_extract(last_segment(path), r"^\.*[^.].*?\.([^.]*)$", 1), F.lit(""))


def basename(path: Column) -> Column:
    """The last segment without its extension."""
    name = last_segment(path)
    return F.when(name.rlike(r"^\.*[^.].*\.[^.]*$"), F.regexp_replace(name, r"\.[^.]*$", "")).otherwise(name)


def is_audio(path: Column, ignore_case: bool = False) -> Column:
    """Whether the extension is that of a recording. Upper-case extensions count only with ignore_case."""
    ext = extension(path)
    return (F.lower(ext) if ignore_case else ext).isin(AUDIO_EXTENSIONS)


def join_path(base: str, rest: Column) -> Column:
    """base/rest; a rest that begins with a slash stands alone."""
    return F.when(F.startswith(rest, F.lit("/")), rest).otherwise(F.concat(F.lit(base if base.endswith("/") else base + "/"), rest))


def local_path(key: Column, base: str) -> Column:
    """An object key's path under base: the first segment (the bucket) goes."""
    rest = F.when(F.contains(key, F.lit("/")), F.regexp_replace(key, "^[^/]*/", "")).otherwise(key)
    return join_path(base, rest)


def remote_url(key: Column, authority: str, base: str) -> Column:
    """sftp URL of an object key's local path. authority: user@host:port."""
    return F.concat(F.lit(f"sftp://{authority}"), local_path(key, base))


def url_parts(url: Column, default_port: int = 22) -> Column:
    """Struct of username, hostname, port and path; null without user@host."""
    netloc = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    user, rest = F.split_part(netloc, F.lit("@"), F.lit(1)), F.split_part(netloc, F.lit("@"), F.lit(2))
    port = F.regexp_extract(rest, r":([0-9]+)$", 1)
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    found = F.struct(user.alias("username"), F.split_part(rest, F.lit(":"), F.lit(1)).alias("hostname"), F.when(port == "", F.lit(default_port)).otherwise(port.try_cast("int")).alias("port"), path.alias("path"))
    return F.when(F.contains(netloc, F.lit("@")), found)


def discovery_root(url_or_path: Column) -> Column:
    """The path of an sftp URL; anything else is a path already."""
    return F.when(F.startswith(url_or_path, F.lit("sftp://")), url_parts(url_or_path)["path"]).otherwise(url_or_path)


def media_type(path: Column) -> Column:
    """Media type by extension, in any case; null for others."""
    known = F.create_map(*(F.lit(x) for pair in MEDIA_TYPES.items() for x in pair))
    return F.try_element_at(known, F.lower(extension(path)))


def relative_path(path: Column, root: str) -> Column:
    """path below root; a path elsewhere stays."""
    prefix = root.rstrip("/") + "/"
    return F.when(F.startswith(path, F.lit(prefix)), F.substring(path, len(prefix) + 1, 1 << 30)).otherwise(path)
