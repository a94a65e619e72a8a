"""Judge URLs by host and path rules.

Each distinct URL is expanded into host suffixes and path prefixes; the expressions meet the rules in an equi-join
on the first four bytes of their SHA-256, and the full digest then confirms a hit. The longest rule wins.
DataFrame functions only.

Defined results: a null URL, or one without ://, has empty host and path and meets no rule; so does an empty table of
rules. A URL that no rule fits gets the default verdict. Of two rules of one length the longer host wins, and of two
equal rules the block. Repeated rows stay repeated; input columns named like an added one are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmill.llm.shared import ascii_lower

#: The production rules: verdict, host, path.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def url_parts(url):
    """Host (A-Z lower-cased) and path of a URL column; both empty without ://."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def with_digest(df: DataFrame) -> DataFrame:
    """Adds the digest of host and path, and its first four bytes as a number to join on."""
    digest = F.sha2(F.concat_ws("\n", "host", "path"), 256)
    return df.withColumn("digest", digest).withColumn("short", F.conv(F.substring("digest", 1, 8), 16, 10).cast("long"))


def expressions(urls: DataFrame, path_lengths: list[int]) -> DataFrame:
    """urls (url, host, path) to one row for each host suffix and each path prefix of a length that rules have."""
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    wanted = F.array(*[F.lit(n) for n in path_lengths]).cast("array<int>")
    prefixes = F.transform(F.filter(wanted, lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    hosts = urls.where(F.col("host") != "").select("url", "path", F.explode(suffixes).alias("host"))
    return hosts.select("url", "host", F.explode(prefixes).alias("path"))


def best_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """url with the text and the verdict of the longest rule that fits it; URLs that none fits are absent."""
    lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().collect() if r[0] is not None)  # as many as path lengths
    once = rules.groupBy(ascii_lower(F.col("host")).alias("host"), "path").agg(F.max("verdict").alias("verdict"))
    known = with_digest(once).select("short", F.col("digest").alias("full"), F.col("verdict"), F.concat("host", "path").alias("rule"), F.length("host").alias("hl"))
    found = with_digest(expressions(urls, lengths)).join(known, "short").where(F.col("digest") == F.col("full"))
    best = F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), "hl"))
    return found.groupBy("url").agg(best.alias("best")).select("url", "best.rule", "best.verdict")


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", url_col: str = "url") -> DataFrame:
    """pages with host, path, rule (null: none fits) and verdict."""
    url, (host, path) = F.col(url_col), url_parts(F.col(url_col))
    urls = pages.where(url.isNotNull()).select(url.alias("url")).distinct()
    host_u, path_u = url_parts(F.col("url"))
    best = best_rules(urls.select("url", host_u.alias("host"), path_u.alias("path")), rules).withColumnsRenamed({"url": "__url", "rule": "__rule", "verdict": "__verdict"})
    both = pages.join(best, url == F.col("__url"), "left")
    return both.withColumns({"host": host, "path": path, "rule": F.col("__rule"), "verdict": F.coalesce("__verdict", F.lit(default))}).drop("__url", "__rule", "__verdict")
