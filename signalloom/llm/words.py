"""Words of whole Arrow text columns as 64-bit hashes, by numpy, inside Spark tasks.

A column is taken in groups of documents of about a megabyte, so that what a task holds
is bounded by the group and by the longest document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

GROUP_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _table(is_word) -> bytes:
    """A byte table: A-Z become lower case, bytes outside words become blanks."""
    lower = [b + 32 if 65 <= b <= 90 else b for b in range(256)]
    return bytes(b if is_word(b) else 32 for b in lower)


#: Words are runs of anything but ASCII white space.
WHITE = _table(lambda b: not (b == 32 or 9 <= b <= 13))
#: Words are runs of ASCII letters, digits and characters beyond ASCII.
ALNUM = _table(lambda b: b >= 128 or 48 <= b <= 57 or 97 <= b <= 122)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, ``n`` at least."""
    if len(_powers[0]) < n:
        size = max(n, GROUP_BYTES + 65536)
        for i, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            run = np.full(size, base, np.uint64)
            run[0] = 1
            _powers[i] = np.cumprod(run)
    return _powers[0], _powers[1]


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range; ranges are in order and do not overlap."""
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + GROUP_BYTES, "right")))
        low, high = int(start[i]), int(end[j - 1])
        up, down = powers(high - low + 1)
        sums = np.empty(high - low + 1, np.uint64)
        sums[0] = 0
        np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * up[: high - low], out=sums[1:])
        s, e = start[i:j] - low, end[i:j] - low
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


@dataclass
class Words:
    """Words of some documents: bytes, their ranges, hashes and each document's first word."""

    text: bytes
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    def join(self, i: int, j: int) -> bytes:
        """Words i to j, a blank between them."""
        return b" ".join([self.text[a:b] for a, b in zip(self.start[i:j].tolist(), self.end[i:j].tolist())])


def words_of(raw: bytes, offsets: np.ndarray, table: bytes) -> Words:
    """Words of the documents that ``offsets`` cuts from ``raw``."""
    text = raw.translate(table)
    data = np.frombuffer(text, np.uint8)
    solid = np.zeros(len(data) + 2, bool)
    solid[1:-1] = data != 32
    cut = offsets[(offsets > 0) & (offsets < len(data))]
    begins = solid[1:-1] & ~solid[:-2]
    ends = solid[1:-1] & ~solid[2:]
    begins[cut] |= solid[1:-1][cut]
    ends[cut - 1] |= solid[1:-1][cut - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(text, start, end, np.searchsorted(start, offsets), hashes(data, start, end))


def slices(column: pa.Array, size: int = GROUP_BYTES) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """Groups of neighbouring documents: first, last + 1, their bytes, offsets into these."""
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + n + 1]
    data = column.buffers()[2] or pa.py_buffer(b"")
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + size, "right")) - 1)
        yield i, j, data[int(off[i]): int(off[j])].to_pybytes(), off[i: j + 1] - off[i]
        i = j


def groups(column: pa.Array, table: bytes) -> Iterator[tuple[int, int, Words]]:
    """Groups of neighbouring documents with their words."""
    for i, j, raw, offsets in slices(column):
        yield i, j, words_of(raw, offsets, table)


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of ``rows`` rows at most, which bounds what is held beside them."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def text_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The texts of a batch, in a column of their own or inside the whole rows."""
    return batch.column("text") if "text" in batch.schema.names else batch.column("whole").field(name)


def chained(hash_: np.ndarray, length: int) -> np.ndarray:
    """A hash of ``length`` neighbours from each place on; those past the end are left out."""
    n = max(0, len(hash_) - length + 1)
    out = np.zeros(n, np.uint64)
    for k in range(length):
        out = out * np.uint64(BASE) + hash_[k: k + n]
    return mix(out)
