"""A stream merged into a stored history, micro-batch by micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame

from ..operators.state import BUCKETS, bucket_of, touched_parts
from ..sources.tables import Snapshots


def into_history(store: Snapshots, table: str, schema, merge: Callable[[DataFrame, DataFrame, int], DataFrame],
                 batch_key: Column, history_key: Column, buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """Writer for foreachBatch: every micro-batch is a run of the store, committed under its number.

    ``merge(history, batch, batch_id)`` gives the new rows of the buckets where the batch has keys; other buckets
    keep their files. A micro-batch that was committed before the stream could note it comes again after a
    restart, with the same number and rows; it is passed over, so each counts exactly once. One that died
    before its commit left nothing behind. Micro-batches without rows commit nothing.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        run_id = f"batch-{batch_id:012d}"
        if store.has(run_id):
            return
        batch = batch.persist()  # read for its keys and for the merge
        try:
            if batch.isEmpty():
                return
            base = store.version()
            touched = touched_parts(store.parts(table, base), batch, batch_key, buckets)
            merged = merge(store.load(touched, schema), batch, batch_id)
            store.replace(table, merged.withColumn("_bucket", bucket_of(history_key, buckets)), base + 1, run_id,
                          "_bucket", touched)
            store.commit(run_id, base + 1, run_id)
        finally:
            batch.unpersist()
    return write
