"""Benchmark decontamination by Wu-Manber search over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import renamed
from .words import ALNUM, BASE, Words, groups, mix, small_batches, text_of

STATE = "n_words long, spans array<struct<first:long,last:long>>, items array<string>"


class Patterns:
    """Test strings of one length, in words: shift table and suffix buckets."""

    def __init__(self, length: int, texts: list[bytes], hashes: np.ndarray, items: list[list[int]]):
        self.length, self.block = length, min(3, length)
        self.texts, self.items = texts, items
        self.step = length - self.block + 1
        bits = max(12, int(np.ceil(np.log2(64 * len(texts)))))
        self.down = np.uint64(64 - bits)
        self.shift = np.full(1 << bits, self.step, np.uint8 if self.step < 256 else np.int64)
        blocks = [self._blocks(hashes, k) for k in range(self.block - 1, length)]
        for k, b in enumerate(blocks):
            np.minimum.at(self.shift, (b >> self.down).astype(np.int64), self.step - 1 - k)
        key = self._key(blocks[-1], blocks[0])
        self.order = np.argsort(key, kind="stable")
        self.key = key[self.order]

    def _blocks(self, hashes: np.ndarray, last: int) -> np.ndarray:
        out = np.zeros(len(hashes), np.uint64)
        for k in range(last - self.block + 1, last + 1):
            out = out * np.uint64(BASE) + hashes[:, k]
        return mix(out)

    @staticmethod
    def _key(suffix: np.ndarray, prefix: np.ndarray) -> np.ndarray:
        return suffix ^ (prefix * np.uint64(BASE))

    def _at(self, hash_: np.ndarray, last: np.ndarray) -> np.ndarray:
        out = np.zeros(len(last), np.uint64)
        for k in range(self.block - 1, -1, -1):
            out = out * np.uint64(BASE) + hash_[last - k]
        return mix(out)

    def occurrences(self, words: Words) -> Iterator[tuple[int, int]]:
        """(first word, pattern) of each occurrence.

        Probes stand ``step`` words apart, as far as the shift table can reach; where a block
        is in no pattern nothing ends before the next probe. From the other probes the search
        goes on by shifts, for all of them at once.
        """
        low, high = words.first[:-1] + self.length - 1, words.first[1:]
        n = np.maximum(0, -(-(high - low) // self.step))
        doc = np.repeat(np.arange(len(n)), n)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
        at = low[doc] + nth * self.step
        until = np.minimum(at + self.step, high[doc])
        found = []
        while len(at):
            suffix = self._at(words.hash, at)
            shift = self.shift[(suffix >> self.down).astype(np.int64)]
            zero = shift == 0
            if zero.any():
                found.append((at[zero], suffix[zero]))
            at = at + np.where(zero, 1, shift)
            more = at < until
            at, until = at[more], until[more]
        if not found:
            return
        last = np.concatenate([x for x, _ in found])
        start = last - self.length + 1
        key = self._key(np.concatenate([x for _, x in found]), self._at(words.hash, start + self.block - 1))
        left, right = np.searchsorted(self.key, key, "left"), np.searchsorted(self.key, key, "right")
        for k in np.flatnonzero(right > left):
            i = int(start[k])
            text = words.join(i, i + self.length)
            for p in self.order[left[k]: right[k]]:
                if self.texts[p] == text:
                    yield i, int(p)


def build(rows: list[tuple[str, str]], window: int) -> tuple[list[str], list[Patterns]]:
    """Names of the items and the test strings of each length."""
    names = sorted({name for name, _ in rows})
    place = {name: i for i, name in enumerate(names)}
    by_length: dict[int, dict[bytes, tuple[np.ndarray, set[int]]]] = {}
    for i, j, words in groups(pa.array([text or "" for _, text in rows], pa.string()), ALNUM):
        for d in range(j - i):
            a, b = int(words.first[d]), int(words.first[d + 1])
            length = min(window, b - a)
            for k in range(a, b - length + 1) if length else ():
                own = by_length.setdefault(length, {})
                entry = own.setdefault(words.join(k, k + length), (words.hash[k: k + length], set()))
                entry[1].add(place[rows[i + d][0]])
    return names, [Patterns(length, list(own), np.array([h for h, _ in own.values()]),
                            [sorted(s) for _, s in own.values()]) for length, own in by_length.items()]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _scan(shared, last: bool, text_col: str):
    def scan(batches):
        names, patterns = shared.value
        for batch in small_batches(batches):
            n = batch.num_rows
            spans: list[list] = [[] for _ in range(n)]
            items: list[set] = [set() for _ in range(n)]
            if "spans" in batch.schema.names:
                spans = [[(x["first"], x["last"]) for x in row] for row in batch.column("spans").to_pylist()]
                items = [set(x) for x in batch.column("items").to_pylist()]
            count = np.zeros(n, np.int64)
            for i, j, words in groups(text_of(batch, text_col), ALNUM):
                count[i:j] = np.diff(words.first)
                for p in patterns:
                    for at, which in p.occurrences(words):
                        d = int(np.searchsorted(words.first, at, "right")) - 1
                        k = at - int(words.first[d])
                        own = spans[i + d]
                        if own and own[-1][0] <= k <= own[-1][1]:
                            own[-1] = (own[-1][0], max(own[-1][1], k + p.length))
                        else:
                            own.append((k, k + p.length))
                        items[i + d].update(names[x] for x in p.items[which])
            pair = pa.struct([("first", pa.int64()), ("last", pa.int64())])
            drop = {"n_words", "spans", "items"} | ({"text"} if last else set())
            columns = {c: batch.column(c) for c in batch.schema.names if c not in drop}
            columns |= {"n_words": pa.array(count),
                        "spans": pa.array([[{"first": a, "last": b} for a, b in _merged(s)] for s in spans],
                                          pa.list_(pair)),
                        "items": pa.array([sorted(s) for s in items], pa.list_(pa.string()))}
            yield pa.RecordBatch.from_pydict(columns)
    return scan


def _searched(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str,
              item_text_col: str, window: int, block_bytes: int, whole: bool) -> DataFrame:
    spark = docs.sparkSession
    items = renamed(benchmark, item=item_col, text=item_text_col).select(
        F.coalesce(F.col("item").cast("string"), F.lit("")).alias("item"), "text").where("text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-int(size) // block_bytes))
    own = (F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole") if whole
           else F.col(f"`{text_col}`").alias("text"))
    found = docs.select(F.col(f"`{id_col}`").alias("doc_id"), own)
    carried = ", ".join(f"{c} {found.schema[c].dataType.simpleString()}" for c in found.columns if c != "text")
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        shared = spark.sparkContext.broadcast(build([tuple(x) for x in part.collect()], window))
        last = k == blocks - 1
        text = "" if last or whole else ", text string"
        found = found.mapInArrow(_scan(shared, last, text_col), f"{carried}{text}, {STATE}")
    return found


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  window: int = 10, block_bytes: int = 4 << 20) -> DataFrame:
    """Occurrences of benchmark windows in every document.

    Words are runs of ASCII letters, digits and characters beyond ASCII, after lower-casing A
    to Z. Every ``window`` consecutive words of an item are a test string; an item of
    fewer words is one. Items are searched in blocks of about ``block_bytes``, each sent to the
    tasks as one bounded table; with several blocks documents pass from one search to the next.

    Null and empty texts have no words; null or wordless items never occur. Items that share an
    identifier count as one; a null identifier counts as the empty string. Repeated rows
    give repeated results, empty tables empty ones; other columns are ignored.

    Returns doc_id, n_words, spans (merged ranges of hit words, end excluded) and items.
    """
    return _searched(docs, benchmark, id_col, text_col, item_col, item_text_col, window,
                     block_bytes, False)


def report(found: DataFrame) -> DataFrame:
    """The digest columns of :func:`contamination`, one row per document."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")).cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", window: int = 10,
          block_bytes: int = 4 << 20) -> DataFrame:
    """Documents without any occurrence, with all their columns, in one pass and without a join."""
    return (_searched(docs, benchmark, id_col, text_col, item_col, item_text_col, window,
                      block_bytes, True)
            .where("size(spans) = 0").select("whole.*"))
