"""Hard negatives by Kronecker-packed inner products."""

from __future__ import annotations

from collections.abc import Iterator
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_folder, stored
from .shared import renamed

#: Candidates packed into one wide integer, and anchors whose scores a task holds at a time.
PACK, HELD = 2048, 256
#: Bytes of anchors sent to the tasks at a time.
BLOCK_BYTES = 8 << 20
LAST = (1 << 63) - 1


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Components as rows of ``width`` numbers; shorter vectors end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.asarray(column.value_lengths().fill_null(0), np.int64)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = np.asarray(column.flatten(), np.int64)
    return out


class Pack:
    """Candidates' components, biased to be positive, side by side in one integer for each component.

    A field holds ``size`` bytes, enough for any inner product of biased components, so that sums of
    products never reach the neighbouring field.
    """

    def __init__(self, rows: np.ndarray, bounds: tuple[int, int]):
        self.n, self.width = rows.shape
        self.least, top = bounds
        span = top - self.least
        self.size = max(1, -(-(self.width * span * span).bit_length() // 8))
        self.wide = self.size > 7
        kind = object if self.wide else np.int64
        rows = rows.astype(kind)
        self.sums = rows.sum(axis=1)
        biased = (rows - self.least).T
        self.integers = [int.from_bytes(self._fields(x), "little") for x in biased]

    def _fields(self, numbers: np.ndarray) -> bytes:
        if self.wide:
            return b"".join(int(x).to_bytes(self.size, "little") for x in numbers)
        return np.ascontiguousarray(numbers, "<i8").view(np.uint8).reshape(-1, 8)[:, :self.size].tobytes()

    def scores(self, anchor: np.ndarray) -> np.ndarray:
        """Inner products of all candidates with one anchor: one product for each of its components."""
        parts = anchor.tolist()
        packed = sum(map(mul, (x - self.least for x in parts), self.integers))
        data = packed.to_bytes(self.n * self.size, "little")
        if self.wide:
            fields = np.array([int.from_bytes(data[k: k + self.size], "little")
                               for k in range(0, len(data), self.size)], object)
        else:
            room = np.zeros((self.n, 8), np.uint8)
            room[:, :self.size] = np.frombuffer(data, np.uint8).reshape(self.n, self.size)
            fields = room.view("<i8")[:, 0]
        # the biases' share: sum (a - m)(c - m) = sum ac - m sum a - m sum c + width m^2
        out = fields + self.least * (sum(parts) - self.width * self.least) + self.least * self.sums
        if self.wide:
            out = np.array([max(-LAST, min(LAST, x)) for x in out], np.int64)
        return out


def _best(scores: np.ndarray, fits: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the ``k`` largest fitting scores of each line, the first of equals first, and which exist.

    Score and place make one number where both fit into 63 bits, so that a partial sort is enough.
    """
    n = scores.shape[1]
    k = min(k, n)
    bits = max(1, (n - 1).bit_length())
    reach = 1 << (62 - bits)
    if n and scores.min() > -reach and scores.max() < reach:
        key = np.where(fits, (scores << bits) + np.arange(n - 1, -1, -1), -LAST)
        top = np.argpartition(-key, k - 1, axis=1)[:, :k]
        top = np.take_along_axis(top, np.argsort(-np.take_along_axis(key, top, 1), axis=1), 1)
    else:
        top = np.lexsort((np.broadcast_to(np.arange(n), scores.shape), -scores, ~fits), axis=-1)[:, :k]
    return top, np.take_along_axis(fits, top, 1)


class Kept:
    """The best ``k`` (score, id, row) of each of ``n`` lists so far."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.there = np.zeros((n, 0), bool)
        self.score, self.id, self.row = (np.zeros((n, 0), np.int64) for _ in range(3))
        self.blank = np.zeros((n, 0), bool)

    def add(self, at: slice, there, score, id_, blank, row) -> None:
        """More for the lists ``at``, in places next to what they have."""
        if self.there.shape[1] < 2 * self.k:
            more = 2 * self.k - self.there.shape[1]
            for name in ("there", "score", "id", "blank", "row"):
                setattr(self, name, np.pad(getattr(self, name), ((0, 0), (0, more))))
        new = slice(self.k, self.k + there.shape[1])
        self.there[at, self.k:] = False
        for name, value in (("there", there), ("score", score), ("id", id_), ("blank", blank), ("row", row)):
            getattr(self, name)[at, new] = value
        order = np.lexsort((self.row[at], self.id[at], self.blank[at], -self.score[at], ~self.there[at]), axis=-1)
        for name in ("there", "score", "id", "blank", "row"):
            own = getattr(self, name)
            own[at] = np.take_along_axis(own[at], order, 1)

    def rows(self) -> Iterator[tuple[int, int]]:
        if self.there.shape[1]:
            yield from zip(*np.nonzero(self.there[:, :self.k]))


def _candidates(batch: pa.RecordBatch, width: int, bounds: tuple[int, int]):
    """Packs of a batch in the order of identifiers: components, labels, ids, nulls, rows, pack."""
    ids = batch.column("vec_id")
    blank = np.asarray(ids.is_null())
    ids = np.asarray(ids.fill_null(0), np.int64)
    label, row = (np.asarray(batch.column(c), np.int64) for c in ("label", "row"))
    comps = _matrix(batch.column("parts"), width)

    def packs(chosen: np.ndarray):
        order = chosen[np.lexsort((row[chosen], ids[chosen], blank[chosen]))]
        for at in range(0, len(order), PACK):
            own = order[at: at + PACK]
            yield Pack(comps[own], bounds), label[own], ids[own], blank[own], row[own]
    return label, packs


def _positives(shared, k: int):
    """The best rows of the anchors' labels in each task."""
    def run(batches):
        anchors, labels, rows, bounds, _ = shared.value
        kept = Kept(len(rows), k)
        for batch in batches:
            label, packs = _candidates(batch, anchors.shape[1], bounds)
            for one in np.intersect1d(label, labels):
                asked = np.flatnonzero(labels == one)
                for pack, _, ids, blank, row in packs(np.flatnonzero(label == one)):
                    for at in range(0, len(asked), HELD):
                        own = asked[at: at + HELD]
                        scores = np.stack([pack.scores(anchors[x]) for x in own])
                        top, there = _best(scores, row != rows[own][:, None], k)
                        kept.add(own, there, np.take_along_axis(scores, top, 1), ids[top], blank[top], row[top])
        out = list(kept.rows())
        yield pa.RecordBatch.from_pydict({
            "anchor": pa.array([int(rows[a]) for a, _ in out], pa.int64()),
            "score": pa.array([int(kept.score[x]) for x in out], pa.int64()),
            "vec_id": pa.array([None if kept.blank[x] else int(kept.id[x]) for x in out], pa.int64()),
            "row": pa.array([int(kept.row[x]) for x in out], pa.int64())})
    return run


def _negatives(shared, k: int, low: int, high: int):
    """The best rows of other labels in each task, within the bounds that each positive sets."""
    def share(score: np.ndarray, percent: int, up: bool) -> np.ndarray:
        whole, rest = np.divmod(score, 100)  # percent of a score without leaving 64 bits
        return whole * percent + (-(-rest * percent // 100) if up else rest * percent // 100)

    def run(batches):
        anchors, labels, rows, bounds, (positive, slots) = shared.value
        least, most = share(positive, low, True), share(positive, high, False)
        kept = [Kept(len(rows), k) for _ in range(positive.shape[1])]
        for batch in batches:
            label, packs = _candidates(batch, anchors.shape[1], bounds)
            for pack, own_label, ids, blank, row in packs(np.arange(len(label))):
                for at in range(0, len(rows), HELD):
                    own = slice(at, at + HELD)
                    scores = np.stack([pack.scores(a) for a in anchors[own]])
                    other = own_label != labels[own][:, None]
                    for slot, best in enumerate(kept):
                        fits = (other & (slots[own] > slot)[:, None] & (scores >= least[own, slot][:, None])
                                & (scores <= most[own, slot][:, None]))
                        top, there = _best(scores, fits, k)
                        best.add(own, there, np.take_along_axis(scores, top, 1), ids[top], blank[top], row[top])
        out = [(best, slot, a, i) for slot, best in enumerate(kept) for a, i in best.rows()]
        yield pa.RecordBatch.from_pydict({
            "anchor": pa.array([int(rows[a]) for _, _, a, _ in out], pa.int64()),
            "slot": pa.array([slot for _, slot, _, _ in out], pa.int32()),
            "score": pa.array([int(b.score[a, i]) for b, _, a, i in out], pa.int64()),
            "vec_id": pa.array([None if b.blank[a, i] else int(b.id[a, i]) for b, _, a, i in out], pa.int64()),
            "row": pa.array([int(b.row[a, i]) for b, _, a, i in out], pa.int64())})
    return run


def _first(found: DataFrame, k: int, *keys: str) -> DataFrame:
    order = (F.desc("score"), F.asc_nulls_last("vec_id"), F.asc("row"))
    return found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(
        F.col("rank") <= k)


def prepared(vectors: DataFrame, anchors: Column, id_col: str, vector_col: str, label_col: str,
             scale: int) -> DataFrame:
    """(row, vec_id, label, is_anchor, parts): rows that take part, their components as whole numbers."""
    marked = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("long").alias("label"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
        F.coalesce(anchors, F.lit(False)).alias("is_anchor"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    # floor() takes what passes a long for its last number
    return marked.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & ~odd).select(
        F.monotonically_increasing_id().alias("row"), "vec_id", "label", "is_anchor",
        F.transform("vector", lambda x: F.floor(x * scale)).alias("parts"))


def mine(vectors: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding",
         label_col: str = "label", n_positives: int = 5, n_negatives: int = 5, low: int = 80, high: int = 100,
         scale: int = 256, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Hard negatives of the rows that ``anchors`` marks, for each of their positives.

    A component x counts as floor(scale * x); scores are exact inner products of these. An anchor's positives
    are its ``n_positives`` best other rows of the same label; a positive's negatives the
    ``n_negatives`` best rows of other labels with low/100 * positive score <= score <= high/100 * positive
    score. Higher scores come first, ties by smaller identifier (null last).

    Anchors are taken in blocks of about ``block_bytes``, each sent to the tasks as one bounded table, and
    every block meets all rows: first those of its own labels for the positives, then all
    for the negatives. A task packs the components of up to 2,048 candidates into one integer, multiplies it
    once for each component of an anchor and reads the exact scores from its fields; it keeps no more than
    the best few of an anchor, which Spark merges.

    Rows with a null label or vector, or a null or non-finite component, take no part. A shorter vector ends in
    zeros. Rows that repeat are rows of their own, also as anchors; a null identifier can be
    found but is never an anchor unless ``anchors`` marks it. Components and scores beyond a long count as
    its ends. Empty tables give an empty result; other columns are ignored.

    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    spark = vectors.sparkSession
    rows = stored(prepared(vectors, anchors, id_col, vector_col, label_col, scale), "vectors")
    about = rows.agg(
        F.min(F.array_min("parts")).alias("least"), F.max(F.array_max("parts")).alias("most"),
        F.max(F.size("parts")).alias("width"), F.count_if("is_anchor").alias("n")).first()
    width = about["width"] or 0
    bounds = (min(0, about["least"] or 0), max(0, about["most"] or 0))
    blocks = max(1, -(-about["n"] * 8 * (width + 2 * n_positives) // block_bytes))
    path = shared_folder(spark, "negatives")
    for block in range(blocks):
        own = rows.where("is_anchor").where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block)
        table = own.select("row", "vec_id", "label", "parts").orderBy("row").toArrow()
        numbers = [np.asarray(table.column(c), np.int64) for c in ("label", "row")]
        about_anchors = (_matrix(table.column("parts"), width), *numbers, bounds)
        shared = spark.sparkContext.broadcast((*about_anchors, None))
        found = rows.select("row", "vec_id", "label", "parts")
        positives = stored(_first(found.mapInArrow(
            _positives(shared, n_positives), "anchor long, score long, vec_id long, row long"), n_positives, "anchor"),
            "positives")
        scores = np.zeros((len(numbers[1]), n_positives), np.int64)
        slots = np.zeros(len(numbers[1]), np.int64)
        best = positives.select("anchor", "rank", "score").toArrow()
        at = np.searchsorted(numbers[1], np.asarray(best.column("anchor"), np.int64))
        rank = np.asarray(best.column("rank"), np.int64)
        scores[at, rank - 1] = np.asarray(best.column("score"), np.int64)
        np.maximum.at(slots, at, rank)
        shared = spark.sparkContext.broadcast((*about_anchors, (scores, slots)))
        negatives = _first(found.mapInArrow(
            _negatives(shared, n_negatives, low, high),
            "anchor long, slot int, score long, vec_id long, row long"), n_negatives, "anchor", "slot")
        names = own.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
        (negatives.select("anchor", (F.col("slot") + 1).alias("nth"), "rank", F.col("vec_id").alias("negative_id"),
                          F.col("score").alias("negative_score"))
         .join(positives.select("anchor", F.col("rank").alias("nth"), F.col("vec_id").alias("positive_id"),
                                F.col("score").alias("positive_score")), ["anchor", "nth"])
         .join(names, "anchor")
         .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
         .write.mode("append").parquet(path))
    return spark.read.parquet(path)
