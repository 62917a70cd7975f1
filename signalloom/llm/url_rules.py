"""URL filters: host-suffix and path-prefix expressions looked up by short digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import ascii_lower, fresh, renamed

#: Hex digits of a digest that the join compares; the whole digest is compared after it.
SHORT = 8
RULE_SCHEMA = "host string, path string, verdict string"


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A to Z lower-cased; empty without ``://``."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host, to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rules_table(rules: DataFrame) -> DataFrame:
    """Rules (host, path, verdict) as they are looked up: their text, shape and digests.

    The shape is the number of the host's labels and the length of the path. Of rules with equal
    host and path, block goes before allow. A rule without a host, or with a path that is neither empty nor begins
    with ``/``, fits no url and is left out, as is one with a null.
    """
    rules = renamed(rules, host="host", path="path", verdict="verdict").select(
        ascii_lower(F.col("host")).alias("host"), "path", "verdict")
    known = rules.where("host != '' AND path IS NOT NULL AND verdict IS NOT NULL").where(
        (F.col("path") == "") | F.col("path").startswith("/"))
    known = known.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # block sorts after allow
    digest = _digest(F.col("host"), F.col("path"))
    return known.select(
        F.concat("host", "path").alias("rule"), "verdict", F.char_length("host").alias("host_length"),
        F.size(F.split("host", r"\.", -1)).alias("labels"), F.char_length("path").alias("length"),
        digest.alias("rule_digest"), F.substring(digest, 1, SHORT).alias("short"))


def _digest(host: Column, path: Column) -> Column:
    # a path is empty or begins with a slash, which no host holds, so the two can't be cut otherwise
    return F.sha2(F.concat(host, path).cast("binary"), 256)


def _expressions(shapes: list[tuple[int, int]]) -> Column:
    """The host suffix and path prefix of each shape that the url is long enough for."""
    labels = F.size(F.split("host", r"\.", -1))
    each = [F.when((labels >= n) & (F.char_length("path") >= length),
                   F.struct(F.substring_index("host", ".", -n).alias("host"),
                            F.substring("path", 1, length).alias("path")))
            for n, length in shapes]
    return F.filter(F.array(*each), lambda x: x.isNotNull())


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    A rule fits a url if its host is the url's or a parent domain of it and the url's path starts
    with the rule's. Of fitting rules the longest (host and path together) wins, then the one with the longer host; without any, the
    rule is null and the verdict ``default``, as for whatever a list of rules doesn't name.

    Distinct (host, path) pairs are expanded to the host suffixes and path prefixes of the shapes that
    occur among the rules, their short digests meet those of the rules, and whole digests confirm.
    Only pairs of matching digests go on; pages carry no more than their own columns through the
    join with the pairs that a rule fits. Spark broadcasts rules and pairs while they are small.

    Null urls and urls without ``://`` have empty host and path, which no rule fits. Empty labels
    (``a..b``) are labels. Repeated rows give repeated results, empty tables empty ones. Columns
    of ``pages`` named host, path, rule or verdict are replaced.
    """
    rules = rules_table(rules)
    shapes = sorted((r["labels"], r["length"]) for r in rules.select("labels", "length").distinct().collect())
    url = F.col(f"`{url_col}`")
    pages = pages.withColumns({"host": host_of(url), "path": path_of(url)}).drop("rule", "verdict")
    if not shapes:
        return pages.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    pairs = pages.select("host", "path").where("host != ''").distinct()
    asked = pairs.select("host", "path", F.explode(_expressions(shapes)).alias("x")).select(
        "host", "path", _digest(F.col("x.host"), F.col("x.path")).alias("digest")).withColumn(
        "short", F.substring("digest", 1, SHORT))
    confirmed = asked.join(rules, "short").where("digest = rule_digest")
    length = F.col("host_length") + F.col("length")
    best = confirmed.groupBy("host", "path").agg(
        F.max(F.struct(length, "host_length", "rule", "verdict")).alias("best"))
    h, p, b = fresh(pages, "_host", "_path", "_best")
    found = best.select(F.col("host").alias(h), F.col("path").alias(p), F.col("best").alias(b))
    return (pages.join(found, (F.col("host") == F.col(h)) & (F.col("path") == F.col(p)), "left")
            .withColumns({"rule": F.col(f"{b}.rule"), "verdict": F.coalesce(F.col(f"{b}.verdict"), F.lit(default))})
            .drop(h, p, b))
