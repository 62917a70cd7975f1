"""Bloom filters of keys: one row of bits that a scan tests before its costly expressions.

A filter lets every key of its table pass and few others; an exact semi-join of the rows that are left
decides. Its size follows the number of keys up to a bound, so that it can always be broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Bits for each key, and bits of a filter at least and at most (2 MB).
BITS_PER_KEY, LEAST_BITS, MOST_BITS = 16, 1 << 10, 1 << 24


def filter_size(keys: int) -> int:
    """A power of two; beyond the bound a filter lets more through."""
    wanted = max(LEAST_BITS, keys * BITS_PER_KEY)
    return min(MOST_BITS, 1 << (wanted - 1).bit_length())


def _slots(key: Column, size: int) -> list[Column]:
    hashed = F.xxhash64(key)
    return [F.pmod(hashed, F.lit(size)), F.pmod(F.shiftrightunsigned(hashed, 32), F.lit(size))]


def build(keys: DataFrame, key: str, n: int) -> DataFrame:
    """The filter of ``n`` or fewer keys as one row with ``size`` / 64 longs in ``_bits``."""
    size = filter_size(n)
    slots = keys.select(F.explode(F.array(*_slots(F.col(key), size))).alias("slot"))
    set_ = slots.groupBy(F.shiftright("slot", 6).alias("id")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("slot").bitwiseAND(63).cast("int"))).alias("bits"))
    every = keys.sparkSession.range(size // 64).join(set_, "id", "left")
    # size / 64 rows meet here, whatever the number of keys
    ordered = F.array_sort(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
    return every.agg(F.transform(ordered, lambda x: x["bits"]).alias("_bits"))


def may_hold(rows: DataFrame, key: str, bits: DataFrame, n: int) -> DataFrame:
    """Rows whose key the filter of ``n`` keys may hold: a semi-join with one broadcast row."""
    size = filter_size(n)
    def is_set(slot: Column) -> Column:
        word = F.get("_bits", F.shiftright(slot, 6).cast("int"))
        return F.getbit(word, slot.bitwiseAND(63).cast("int")) == 1
    one, other = (is_set(slot) for slot in _slots(F.col(key), size))
    return rows.join(F.broadcast(bits), one & other, "left_semi")
