"""Filters of keys let every key pass and few others."""

import pytest
from pyspark.sql import functions as F

from signalloom.operators import bloom


@pytest.mark.parametrize("n", [0, 1, 70, 3000])
def test_every_key_passes_and_few_others(spark, n):
    keys = spark.range(n).select(F.concat(F.lit("k"), "id").alias("key"))
    rows = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"), "id").unionByName(
        spark.createDataFrame([(None, -1)], "key string, id long"))
    kept = bloom.may_hold(rows, "key", bloom.build(keys, "key", n), n)
    ids = {r["id"] for r in kept.collect()}
    assert set(range(n)) <= ids and len(ids) - n <= (0 if n == 0 else 20_000 * 0.05)


def test_a_full_filter_only_lets_more_through(spark, monkeypatch):
    monkeypatch.setattr(bloom, "MOST_BITS", 1 << 10)
    keys = spark.range(5000).select(F.col("id").cast("string").alias("key"))
    rows = spark.range(6000).select(F.col("id").cast("string").alias("key"))
    kept = bloom.may_hold(rows, "key", bloom.build(keys, "key", 5000), 5000)
    assert kept.join(keys, "key", "left_semi").count() == 5000
    assert bloom.filter_size(5000) == 1024 and bloom.filter_size(0) == 1024
