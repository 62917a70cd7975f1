"""Helpers that several operators use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """Lower-cases A to Z and leaves every other character as it is; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    # lower() is the fast path where the text has no character beyond ASCII
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; null has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def renamed(docs: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names, so that others can't clash."""
    return docs.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


#: A side of at most so many narrow rows is broadcast: some tens of MB.
BROADCAST_ROWS = 200_000


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if its counted ``rows`` allow it; else Spark chooses the join."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def fresh(docs: DataFrame, *names: str) -> list[str]:
    """The names, changed where ``docs`` has such a column."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def without(docs: DataFrame, doc_id: Column, digest: Column, gone: DataFrame, kept: DataFrame) -> DataFrame:
    """``docs`` less the rows whose identifier and digest are in ``gone``, both two-column frames.

    What goes is the smaller side, so texts move only where it is too large to broadcast. Pairs also
    in ``kept`` are of rows that repeat: one of each such pair stays.
    """
    names = fresh(docs, "_id", "_digest")
    gone, kept = gone.toDF(*names), kept.toDF(*names)

    def same(other: DataFrame, a: Column, b: Column) -> Column:
        return a.eqNullSafe(other[names[0]]) & (b == other[names[1]])

    twice = stored(gone.join(kept, same(kept, *[gone[c] for c in names]), "left_semi"), "twice")
    gone = stored(gone, "gone")
    out = docs.join(small_side(gone, gone.count()), same(gone, doc_id, digest), "left_anti")
    n = twice.count()
    if n:
        again = docs.join(small_side(twice, n), same(twice, doc_id, digest), "left_semi")
        again = again.withColumns(dict(zip(names, (doc_id, digest)))).dropDuplicates(names).drop(*names)
        out = out.unionByName(again)
    return out
