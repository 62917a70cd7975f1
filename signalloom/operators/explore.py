"""Faceted views over the company table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import any_of, split_list
from ..schemas import EXPORT_COLUMNS
from ..session import stored

FACETS = ("segment", "market", "confidence", "best_source", "loc_signal_strength")


def _haystack(*columns: str) -> Column:
    return F.lower(F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in columns]))


def faceted_search(df: DataFrame, facets: dict[str, list[str]] | None = None,
                   keywords: list[str] | None = None, text: str = "", new_only: bool = False,
                   searched: tuple[str, ...] = ("company", "top_keywords", "best_source",
                                                "location"),
                   keyword_column: str = "top_keywords") -> DataFrame:
    """Any value within a facet, all facets together; keywords are substrings."""
    for column, values in (facets or {}).items():
        if values:
            df = df.where(F.col(column).isin(values))
    if keywords:
        listed = F.coalesce(keyword_column, F.lit(""))
        df = df.where(any_of([F.contains(listed, F.lit(k)) for k in keywords]))
    if new_only:
        df = df.where("is_new = 1")
    if text.strip():
        df = df.where(F.contains(_haystack(*searched), F.lit(text.strip().lower())))
    return df


def table_search(df: DataFrame, text: str = "", tier: str = "", confidence: str = "",
                 source: str = "",
                 searched: tuple[str, ...] = ("company", "top_keywords", "location",
                                              "best_source", "all_sources", "perk_excerpt")
                 ) -> DataFrame:
    """Free text over six columns, exact tier and confidence, source as a substring."""
    if text:
        df = df.where(F.contains(_haystack(*searched), F.lit(text.lower())))
    if tier:
        df = df.where(F.col("icp_tier") == tier)
    if confidence:
        df = df.where(F.col("confidence") == confidence)
    if source:
        df = df.where(F.contains(F.coalesce("all_sources", F.lit("")), F.lit(source)))
    return df


def card_order(mode: str) -> list[Column]:
    """Sort keys of the four card orders, with the name to break ties."""
    score, roles = F.desc_nulls_last("gtm_score"), F.desc_nulls_last("role_count")
    name = F.col("company")
    return {"gtm_score": [score, name], "role_count": [roles, name],
            "company": [F.lower("company"), name],
            "new_first": [F.desc_nulls_last("is_new"), score, name]}[mode]


def with_place(df: DataFrame, *order: Column) -> DataFrame:
    """Adds ``place``, each row's number in an order, from 1.

    Rows are sorted in ranges; a range starts at the number of rows in the ranges before it,
    so no task sorts the whole table.
    """
    ranged = stored(df.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumns({"_range": F.spark_partition_id(),
                                  "_at": F.monotonically_increasing_id()}), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("_range").agg(F.count("*").alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy("_range").orderBy("_at"))
    # one row for each range
    return (ranged.withColumn("_own", own).join(F.broadcast(starts), "_range")
            .withColumn("place", F.col("_start") + F.col("_own"))
            .drop("_range", "_at", "_start", "_own"))


def sort_table(df: DataFrame, column: str, descending: bool = False,
               numeric: tuple[str, ...] = ("gtm_score", "unique_roles_with_perk")) -> DataFrame:
    """Order by one column, as numbers for the numeric ones and as text otherwise."""
    key = F.coalesce(F.col(column).cast("string"), F.lit(""))
    if column in numeric:
        key = F.coalesce(F.col(column).cast("double"), F.lit(0.0))
    return df.orderBy(key.desc() if descending else key.asc(), "company")


def keyword_facets(df: DataFrame, column: str = "top_keywords", n: int = 15) -> DataFrame:
    """The n keywords listed by most companies."""
    words = df.select(F.explode(split_list(F.col(column))).alias("keyword"))
    return (words.groupBy("keyword").agg(F.count("*").alias("companies"))
            .orderBy(F.desc("companies"), "keyword").limit(n))


def facet_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-blank values in order."""
    return (df.where(F.coalesce(column, F.lit("")) != "").select(F.col(column).alias("value"))
            .distinct().orderBy("value"))


def kpis(df: DataFrame) -> DataFrame:
    """Companies, new ones, high confidence, and tier exactly Viable."""
    return df.agg(F.count("*").alias("total"), F.count_if(F.col("is_new") == 1).alias("new"),
                  F.count_if(F.col("confidence") == "High").alias("high"),
                  F.count_if(F.col("icp_tier") == "Viable").alias("viable"))


def export_columns(df: DataFrame, columns: tuple[str, ...] = EXPORT_COLUMNS) -> DataFrame:
    return df.select(*columns)
