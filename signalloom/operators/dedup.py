"""First- and last-wins deduplication, hashed ranks and samples.

Duplicates are resolved with min_by / max_by instead of row_number windows: these combine
inside each map task, so a key holding most of the rows reaches the shuffle as one row per
task and no task ever sorts a whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def _pick(df: DataFrame, keys: list[str], agg) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(agg(F.struct(*rest)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def first_wins(df: DataFrame, keys: list[str], order: str | Column) -> DataFrame:
    return _pick(df, keys, lambda row: F.min_by(row, order))


def last_wins(df: DataFrame, keys: list[str], order: str | Column) -> DataFrame:
    return _pick(df, keys, lambda row: F.max_by(row, order))


def hash_sample(df: DataFrame, n: int, key: str, seed: str = "",
                tie: str | None = None) -> DataFrame:
    """A repeatable random sample of n rows without replacement, seeded by text.

    Ordering by a hash of the key makes this a top-n, which Spark computes per task first.
    ``tie`` orders rows with equal keys.
    """
    order = [F.md5(F.concat(F.lit(seed), F.col(key).cast("string"))), F.col(key)]
    return df.orderBy(*order, *([F.col(tie)] if tie else [])).limit(n)


def hashed_rank(df: DataFrame, key: str, out: str = "rank", digits: int = 3) -> DataFrame:
    """Global 0-based position of each distinct key in the order of its md5 hash.

    The leading hex digits split the order into even ranges; ranks are taken per range and
    shifted by the row counts of the ranges before it, so no global sort is needed.
    """
    hashed = df.withColumn("_h", F.md5(F.col(key).cast("string")))
    hashed = hashed.withColumn("_range", F.substring("_h", 1, digits))
    counts = hashed.groupBy("_range").agg(F.count("*").alias("_n"))
    # 16**digits rows at most, so the single-partition running sum and broadcast are bounded.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", F.coalesce(F.sum("_n").over(before),
                                                F.lit(0)).alias("_start"))
    within = Window.partitionBy("_range").orderBy("_h", key)
    ranked = hashed.withColumn("_pos", F.row_number().over(within) - 1)
    return (ranked.join(F.broadcast(starts), "_range")
            .withColumn(out, F.col("_start") + F.col("_pos"))
            .drop("_h", "_range", "_start", "_pos"))


def batches(df: DataFrame, key: str, size: int = 100, out: str = "batch_id") -> DataFrame:
    """Split distinct keys into batches of ``size``."""
    return (hashed_rank(df, key, "_rank")
            .withColumn(out, F.floor(F.col("_rank") / size)).drop("_rank"))
