"""Removal of boilerplate lines, told by the number of distinct sites that carry them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .shared import renamed, small_side

BLANKS = " \t\r\x0b\x0c"


def _lines():
    return F.split(F.col("text"), "\n", -1)


def _hashes(value) -> list:
    """Two independent 64-bit hashes of a text."""
    return [F.xxhash64(value), F.xxhash64(F.lit(1), value)]


def site_lines(docs: DataFrame, text_col: str, site_col: str) -> DataFrame:
    """One narrow stored row per line that isn't blank: hashes of text and line, place and site."""
    t1, t2 = _hashes(F.col("text"))
    l1, l2 = _hashes(F.col("line"))
    return stored(
        renamed(docs, text=text_col, site=site_col).where("text IS NOT NULL")
        .select("site", t1.alias("t1"), t2.alias("t2"), F.posexplode(_lines()).alias("place", "line"))
        .withColumn("line", F.trim(F.col("line"), F.lit(BLANKS))).where("line != ''")
        .select("site", "t1", "t2", "place", l1.alias("l1"), l2.alias("l2")), "lines")


def spread_lines(lines: DataFrame, min_sites: int, log_size: int = 10, margin: float = 0.15) -> DataFrame:
    """Lines (l1, l2) on ``min_sites`` distinct sites or more.

    A HyperLogLog sketch of the sites of each line merges from partial sketches, however often the line
    occurs. Where the estimate is within ``margin`` of the threshold (over four standard errors
    at 2**10 registers), the distinct sites of the line are counted exactly, from a row for each line and
    site.
    """
    estimate = (lines.groupBy("l1", "l2").agg(F.hll_sketch_agg("site", F.lit(log_size)).alias("sketch"))
                .withColumn("sites", F.hll_sketch_estimate("sketch")).drop("sketch")
                .where(F.col("sites") >= min_sites * (1 - margin)))
    estimate = stored(estimate, "spread")
    sure = estimate.where(F.col("sites") > min_sites * (1 + margin)).select("l1", "l2")
    near = estimate.where(F.col("sites") <= min_sites * (1 + margin)).select("l1", "l2")
    exact = (lines.where("site IS NOT NULL").join(small_side(near, near.count()), ["l1", "l2"], "left_semi")
             .groupBy("l1", "l2", "site").agg(F.lit(1).alias("one"))
             .groupBy("l1", "l2").agg(F.count("*").alias("sites"))
             .where(F.col("sites") >= min_sites).select("l1", "l2"))
    return sure.unionByName(exact)


def without_boilerplate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
                        min_sites: int = 10) -> DataFrame:
    """Texts without the lines that ``min_sites`` distinct sites or more carry.

    Lines end at line feeds and are compared without blanks at their ends; blank lines always stay. A null
    site counts as no site. A null text stays null with 0 lines; a text of nothing but boilerplate becomes
    empty. Rows that repeat are separate rows with equal results; an empty table gives an empty
    result; other columns are ignored.

    Returns doc_id, n_lines (blank ones included), n_removed, text.
    """
    lines = site_lines(docs, text_col, site_col)
    boilerplate = stored(spread_lines(lines, min_sites), "boilerplate")
    # What goes depends on the text alone, so equal texts share one entry.
    gone = (lines.join(small_side(boilerplate, boilerplate.count()), ["l1", "l2"])
            .groupBy("t1", "t2").agg(F.collect_set("place").alias("gone")))
    gone = stored(gone, "gone")
    t1, t2 = _hashes(F.col("text"))
    rows = renamed(docs, doc_id=id_col, text=text_col).withColumns({"t1": t1, "t2": t2})
    joined = rows.join(small_side(gone, gone.count()), ["t1", "t2"], "left")
    places = F.coalesce("gone", F.array().cast("array<int>"))
    kept = F.filter(_lines(), lambda x, i: ~F.array_contains(places, i))
    return joined.select(
        "doc_id", F.when(F.col("text").isNull(), 0).otherwise(F.size(_lines())).cast("long").alias("n_lines"),
        F.size(places).cast("long").alias("n_removed"),
        F.when(F.col("text").isNotNull(), F.when(F.size(places) > 0, F.array_join(kept, "\n"))
               .otherwise(F.col("text"))).alias("text"))
