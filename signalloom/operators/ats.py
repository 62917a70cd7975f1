"""Which applicant-tracking system an account uses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.names import ats_fingerprint
from .state import fresh_cache

BOARD_TYPES = ("greenhouse", "lever", "ashby")
TARGETED_TYPES = (*BOARD_TYPES, "exa")


def fingerprint(df: DataFrame, text: str) -> DataFrame:
    """Adds ats_type and ats_slug (null where no system is recognised)."""
    return (df.withColumn("_a", ats_fingerprint(F.col(text)))
            .withColumn("ats_type", F.col("_a.ats_type"))
            .withColumn("ats_slug", F.col("_a.ats_slug")).drop("_a"))


def resolve(accounts: DataFrame, cache: DataFrame, probes: DataFrame, today: Column,
            days: int = 90, domain: str = "domain_key") -> DataFrame:
    """Adds ats_type, ats_slug and from_cache: fresh cache, else probe, else ('exa', '')."""
    fresh = fresh_cache(cache, today, days).select(
        F.col("domain").alias(domain), F.struct("ats_type", F.coalesce(
            "ats_slug", F.lit("")).alias("ats_slug")).alias("_cached"))
    probed = probes.where("ats_type is not null").groupBy("domain").agg(
        F.min_by(F.struct("ats_type", F.coalesce("ats_slug", F.lit("")).alias("ats_slug")),
                 F.struct("ats_type", "ats_slug")).alias("_probed")
    ).withColumnRenamed("domain", domain)
    unknown = F.struct(F.lit("exa").alias("ats_type"), F.lit("").alias("ats_slug"))
    joined = accounts.join(fresh, domain, "left").join(probed, domain, "left")
    return (joined.withColumn("_a", F.coalesce("_cached", "_probed", unknown))
            .withColumn("ats_type", F.col("_a.ats_type"))
            .withColumn("ats_slug", F.col("_a.ats_slug"))
            .withColumn("from_cache", F.col("_cached").isNotNull())
            .drop("_a", "_cached", "_probed"))


def cache_updates(resolved: DataFrame, domain: str = "domain_key") -> DataFrame:
    """Newly resolved rows, for merge_ats_cache."""
    return (resolved.where(~F.col("from_cache"))
            .select(F.col(domain).alias("domain"), "ats_type", "ats_slug").distinct())


def supported(resolved: DataFrame, types: tuple[str, ...] = TARGETED_TYPES,
              need_slug: bool = False) -> DataFrame:
    kept = resolved.where(F.col("ats_type").isin(*types))
    return kept.where("ats_slug <> ''") if need_slug else kept


def distribution(cache: DataFrame) -> DataFrame:
    return (cache.groupBy("ats_type").agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), "ats_type"))
