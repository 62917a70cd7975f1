"""Postings as a stream: landed files in, url deduplication within a watermark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery


def read_stream(spark: SparkSession, folder: str, schema, fmt: str = "parquet",
                glob: str | None = None, files_per_trigger: int | None = None) -> DataFrame:
    """New files of a folder, optionally a limited number per micro-batch."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder)


def as_instant(col: str) -> Column:
    """A zoneless timestamp read as UTC, whatever the session's time zone."""
    return F.expr("timestamp_micros(timestampdiff(MICROSECOND, "
                  f"TIMESTAMP_NTZ '1970-01-01 00:00:00', {col}))")


def first_seen(stream: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """One row per key within the watermark; state is dropped once the delay has passed."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def run_available(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
                  mode: str = "append") -> StreamingQuery:
    """Process what has landed in micro-batches handed to ``write``, then stop."""
    query = (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).foreachBatch(write).start())
    query.awaitTermination()
    return query


def to_batches(path: str) -> Callable[[DataFrame, int], None]:
    """Writer of one folder per micro-batch; a replayed batch overwrites its own folder."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


def latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The newest row per key over all micro-batch folders of an updating stream."""
    rows = spark.read.parquet(path)
    values = [c for c in rows.columns if c not in (*keys, "batch_id")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_v")).select(
        *keys, "_v.*")
