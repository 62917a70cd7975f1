"""Exact deduplication by a tree merge of sorted digest runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .shared import ascii_lower, renamed, without

#: What two rows must agree in: the digest, and length and a second hash that verify it.
SAME = ["digest", "n_bytes", "second"]


def digest_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One narrow row per document: identifier, digest, length, second hash, run and row number.

    It is written once, so that texts are read and hashed a single time and the numbers
    of runs and rows stay the same when a lost task is repeated.
    """
    norm = ascii_lower(F.col("text"))
    return stored(
        renamed(docs, doc_id=id_col, text=text_col).select(
            "doc_id", F.unhex(F.sha2(norm.cast("binary"), 256)).alias("digest"),
            F.octet_length(norm).cast("long").alias("n_bytes"),
            F.xxhash64(norm).alias("second"), F.spark_partition_id().alias("run"),
            F.monotonically_increasing_id().alias("row")), "digests")


def merge_runs(runs: DataFrame, fan_in: int, best) -> DataFrame:
    """One round: ``fan_in`` neighbouring runs become one, with a row per digest.

    Grouping with a struct extreme sorts each run by digest on both sides of the exchange and
    merges what arrives. A run sends one row per digest however many copies it holds.
    """
    return (runs.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
            .groupBy("run", *SAME)
            .agg(best("best").alias("best"), F.sum("group_size").alias("group_size")))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 keep: str = "largest", fan_in: int = 8) -> DataFrame:
    """Groups of equal texts, with one row for each input row.

    Texts are equal when identical after lower-casing A to Z; null counts as empty, so null and
    empty texts form one group. ``keep`` is ``largest`` or ``smallest`` identifier. Of rows that
    share that identifier one stays; a null identifier stays only in groups without any other.
    Rows that repeat are separate rows. An empty table gives an empty result; other columns
    are ignored.

    Returns doc_id, keep_id, group_size, kept, text_sha256 and the row number ``row``.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is 'largest' or 'smallest'")
    rows = digest_runs(docs, id_col, text_col)
    best = F.max if keep == "largest" else F.min
    key = F.struct(F.col("doc_id").isNotNull() if keep == "largest" else F.col("doc_id").isNull(),
                   F.col("doc_id"), F.col("row"))
    lowest = rows.groupBy("run", *SAME).agg(best(key).alias("best"), F.count("*").alias("group_size"))
    last = rows.agg(F.max("run")).first()[0] or 0
    merged = lowest
    while last > 0:
        merged = merge_runs(merged, fan_in, best)
        last //= fan_in
    # Back down the tree: a digest of many copies is looked up once per run, then inside its run.
    found = lowest.select("run", *SAME).join(merged.drop("run"), SAME)
    return (rows.join(found, ["run", *SAME])
            .select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
                    (F.col("row") == F.col("best.row")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256"), "row"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest",
                 fan_in: int = 8) -> DataFrame:
    """The rows that stay, with all their columns; see :func:`exact_groups` for the rules.

    Of rows that repeat with one identifier and equal texts, one stays.
    """
    groups = stored(exact_groups(docs, id_col, text_col, keep, fan_in).select(
        "doc_id", F.unhex("text_sha256").alias("digest"), "kept"), "groups")
    gone = groups.where(~F.col("kept")).select("doc_id", "digest").distinct()
    digest = F.unhex(F.sha2(ascii_lower(F.col(f"`{text_col}`")).cast("binary"), 256))
    return without(docs, F.col(f"`{id_col}`"), digest, gone, groups.where("kept").select("doc_id", "digest"))
