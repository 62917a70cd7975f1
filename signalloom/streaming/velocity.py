"""Weekly counts over a stream of postings, and their growth as weeks close."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Windows count from 1970-01-01, a Thursday; four days on is a Monday.
MONDAY = "4 days"


def weekly_counts(stream: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """Postings per key and Monday-aligned week, for update or append mode."""
    return (stream.withWatermark(event_time, delay)
            .groupBy(F.window(event_time, "7 days", startTime=MONDAY).alias("week"), key)
            .agg(F.count("*").alias("signal_count")))


def weekly_distinct(stream: DataFrame, key: str, value: str, event_time: str,
                    delay: str) -> DataFrame:
    """Distinct values per key and closed week, in append mode.

    The window is part of the deduplication key, so its state ends with the week.
    """
    week = F.window(event_time, "7 days", startTime=MONDAY)
    once = (stream.withWatermark(event_time, delay).withColumn("week", week)
            .select("week", key, value).dropDuplicates(["week", key, value]))
    return once.groupBy("week", key).agg(F.count("*").alias("signal_count"))


def week_start(window: str = "week") -> Column:
    """First day of a window as text, independent of the session's time zone."""
    days = F.floor(F.unix_seconds(F.col(f"{window}.start")) / 86400).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days).cast("string")


_DAY, _WEEK = 86_400_000, 7 * 86_400_000
CLOSED = ("company_name string, week_start date, signal_count long, prev_week date, prev_count long, delta long")


class _Growth(StatefulProcessor):
    """Counts the open weeks of a bucket of companies; when the watermark closes one, compares each company's count
    with the one of its week closed before.

    State is, for each open week (a few at a time, as far as the watermark trails), the companies with a row in it
    and their counts, and the last closed week of each company. A bucket's companies are worked on as columns: what is
    asked of the state store does not grow with their number.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        names = T.StructField("company", T.ArrayType(T.StringType()))
        counts = T.StructField("n", T.ArrayType(T.LongType()))
        self._open = handle.getMapState("open", T.StructType([T.StructField("week", T.LongType())]),
                                        T.StructType([names, counts]))
        self._closed = handle.getValueState("closed", T.StructType(
            [names, T.StructField("week", T.ArrayType(T.LongType())), counts]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        added: dict[int, pd.Series] = {}
        for chunk in rows:
            for week, of_week in chunk.groupby("week_ms")["company_name"]:
                if week + _WEEK <= timerValues.getCurrentWatermarkInMs():
                    continue  # closed already
                n = of_week.value_counts()
                added[int(week)] = added[int(week)].add(n, fill_value=0) if int(week) in added else n
        for week, n in added.items():
            if self._open.containsKey((week,)):
                company, before = self._open.getValue((week,))
                n = n.add(pd.Series(list(before), index=list(company)), fill_value=0)
            else:
                self._handle.registerTimer(week + _WEEK)
            self._open.updateValue((week,), (n.index.tolist(), n.astype("int64").tolist()))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        week = expiredTimerInfo.getExpiryTimeInMs() - _WEEK
        company, n = self._open.getValue((week,))
        now = pd.DataFrame({"week": week, "n": list(n)}, index=list(company))
        company, weeks, n = self._closed.get() if self._closed.exists() else ([], [], [])
        last = pd.DataFrame({"week": pd.array(list(weeks), "Int64"), "n": pd.array(list(n), "Int64")}, index=list(company))
        self._open.removeKey((week,))
        kept = pd.concat([last[~last.index.isin(now.index)], now])
        self._closed.update((kept.index.tolist(), [int(w) for w in kept["week"]], [int(c) for c in kept["n"]]))
        last = last.reindex(now.index)
        day = lambda ms: pd.Timestamp(ms, unit="ms").date()
        yield pd.DataFrame({
            "company_name": now.index, "week_start": day(week), "signal_count": now["n"].array,
            "prev_week": [None if pd.isna(w) else day(int(w)) for w in last["week"]], "prev_count": last["n"].array,
            "delta": now["n"].array - last["n"].array})

    def close(self) -> None:
        pass


def closed_weeks(stream: DataFrame, key: str, event_time: str, delay: str, buckets: int = 256) -> DataFrame:
    """One row per key and Monday-aligned week as it closes, with the week closed before it and the growth.

    Rows without a key move the watermark and are not counted. Each key's weeks close in order, each
    once; rows later than ``delay`` are dropped. The state is kept in RocksDB (see :func:`timers`). Keys are
    dealt to ``buckets``, whose open and last weeks are one state each; it stays the same for a checkpoint.
    """
    ms = F.unix_millis(event_time)
    monday = ms - F.pmod(ms - F.lit(4 * _DAY), F.lit(_WEEK))  # 1970-01-05 was a Monday
    # a condition on the key alone would be pushed below the watermark, which then missed those rows
    known = F.when(F.col(event_time).isNull(), False).otherwise(F.col(key).isNotNull())
    name = F.col(key).cast("string")
    rows = stream.withWatermark(event_time, delay).where(known).select(
        F.pmod(F.hash(name), F.lit(buckets)).alias("bucket"), name.alias("company_name"), event_time,
        monday.alias("week_ms"))
    return rows.groupBy("bucket").transformWithStateInPandas(
        _Growth(), CLOSED, "append", "EventTime")


@contextmanager
def timers(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, which keyed state with timers needs."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def growing(closed: DataFrame, min_delta: int = 2) -> DataFrame:
    """Of closed weeks the last of each company, where it grew by ``min_delta``."""
    last = closed.groupBy("company_name").agg(F.max_by(
        F.struct("week_start", "signal_count", "prev_week", "prev_count", "delta"), "week_start").alias("w"))
    return last.select("company_name", "w.*").where(F.col("delta") >= min_delta)
