"""Quality classifier: logistic regression over hashed word n-grams, trained by
follow-the-regularised-leader updates and scored as sparse dot products."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import renamed
from .words import BASE, WHITE, Words, chained, hashes, mix, slices, small_batches, words_of

#: log2 of the number of weights.
BITS = 18
#: Words by spelling up to pairs, by shape up to triples.
ORDERS = {"word": (1, 2), "shape": (1, 2, 3)}
VIEWS = sum(len(x) for x in ORDERS.values())


def _shape_bytes() -> bytes:
    out = []
    for b in range(256):
        out.append(b"X"[0] if 65 <= b <= 90 else b"9"[0] if 48 <= b <= 57 else
                   b"x"[0] if 97 <= b <= 122 or b >= 128 else b)
    return bytes(out)


SHAPES = _shape_bytes()


def shape_hashes(raw: bytes, words: Words) -> np.ndarray:
    """Hashes of word shapes: classes of characters, each run once; a word like the one before
    has a shape of its own."""
    data = np.frombuffer(raw.translate(SHAPES), np.uint8)
    change = np.ones(len(data) + 1, bool)
    change[1:-1] = data[1:] != data[:-1]
    change[words.start] = True
    place = np.concatenate([[0], np.cumsum(change[:-1])])
    out = hashes(data[change[:-1]], place[words.start], place[words.end])
    again = np.zeros(len(out), bool)
    again[1:] = words.hash[1:] == words.hash[:-1]
    inner = words.first[(words.first > 0) & (words.first < len(out))]
    again[inner] = False
    return np.where(again, np.uint64(BASE), out)


def grams(column: pa.Array) -> Iterator[tuple[int, int, list[tuple[np.ndarray, np.ndarray]]]]:
    """Groups of documents: first, last + 1, and for each view (document, weight number) pairs."""
    for i, j, raw, offsets in slices(column):
        words = words_of(raw, offsets, WHITE)
        of = np.repeat(np.arange(j - i), np.diff(words.first))
        by = {"word": words.hash, "shape": shape_hashes(raw, words)}
        views = []
        for name, orders in ORDERS.items():
            for n in orders:
                key = chained(by[name], n)
                inside = of[: len(key)] == of[n - 1: n - 1 + len(key)]
                number = mix(key + np.uint64(len(views) + 1)) >> np.uint64(64 - BITS)
                views.append((of[: len(key)][inside], number[inside].astype(np.int64)))
        yield i, j, views


def vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each document as sparse vector: weight numbers, and the share of each in its view."""
    for i, j, views in grams(column):
        cuts = [np.searchsorted(of, np.arange(j - i + 1)) for of, _ in views]
        for d in range(j - i):
            parts = [number[cut[d]: cut[d + 1]] for (_, number), cut in zip(views, cuts)]
            share = np.concatenate([np.full(len(p), 1.0 / max(1, len(p))) for p in parts])
            number, back = np.unique(np.concatenate(parts), return_inverse=True)
            yield number, np.bincount(back, share, len(number))


class Leader:
    """Follow-the-regularised-leader state; the last weight is the constant's."""

    def __init__(self, alpha: float, beta: float, l1: float, l2: float):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z = self.z[at]
        rate = (self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / rate)

    def update(self, number: np.ndarray, value: np.ndarray, label: int) -> None:
        at, x = np.append(number, 1 << BITS), np.append(value, 1.0)
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - label) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample: int = 20000, shards: int = 8, epochs: int = 3,
          alpha: float = 0.5, beta: float = 1.0, l1: float = 0.01, l2: float = 0.01) -> np.ndarray:
    """Weights learned from at most about ``sample`` labelled rows, picked by a hash of the identifier.

    The sample is bounded, so its labels are broadcast and the documents are only scanned. ``shards``
    tasks each follow the leader through their share for ``epochs`` rounds in hash order; their
    weights are averaged by Spark. Rows without label or identifier are left out, null texts count
    as empty, repeated rows are learned from again. Without labels every score is one half.
    """
    named = (labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label"))
             .where("id IS NOT NULL AND label IS NOT NULL"))
    n = named.count()
    if not n:
        return np.zeros((1 << BITS) + 1)
    key = F.xxhash64("id")
    picked = (named.where(F.pmod(key, F.lit(1_000_000)) < min(1.0, sample / n) * 1e6)
              .withColumn("key", F.xxhash64("id", F.lit(1))))
    rows = (renamed(docs, doc_id=id_col, text=text_col)
            .join(F.broadcast(picked), F.col("doc_id") == F.col("id"))
            .select("key", "label", "text", F.pmod("key", F.lit(shards)).cast("int").alias("shard")))

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by("key").combine_chunks()
        leader = Leader(alpha, beta, l1, l2)
        label = table.column("label").to_pylist()
        text = table.column("text").chunk(0) if table.num_rows else pa.array([], pa.string())
        for _ in range(epochs):
            for y, (number, value) in zip(label, vectors(text)):
                leader.update(number, value, y)
        w = leader.weights()
        at = np.flatnonzero(w)
        return pa.table({"number": pa.array(at, pa.int32()), "weight": pa.array(w[at] / shards)})

    mean = (rows.groupBy("shard").applyInArrow(fit, "number int, weight double")
            .groupBy("number").agg(F.sum("weight").alias("weight")).toPandas())
    out = np.zeros((1 << BITS) + 1)
    out[mean["number"]] = np.round(mean["weight"], 9)  # sums in any order agree
    return out


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The probability of label 1 for every whole text: (doc_id, score).

    Null and empty texts have no n-grams and get the constant's score. Rows that repeat give equal
    results; an empty table gives an empty one; other columns are ignored.
    """
    rows = renamed(docs, doc_id=id_col, text=text_col)
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        w = shared.value
        for batch in small_batches(batches):
            total = np.full(batch.num_rows, w[-1])
            for i, j, views in grams(batch.column("text")):
                for of, number in views:
                    count = np.maximum(1, np.bincount(of, minlength=j - i))
                    total[i:j] += np.bincount(of, w[number], j - i) / count
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "score": pa.array(1 / (1 + np.exp(-np.clip(total, -30, 30))))})

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
