"""Passages that repeat across documents, by sparse suffix arrays."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .shared import renamed, small_side
from .words import BASE, WHITE, chained, groups, mix

#: A suffix: its anchor's hash, document and place, the words before, nearest first, and after.
SUFFIX = {"key": pa.int64(), "row": pa.int64(), "place": pa.int32(), "left": pa.binary(), "right": pa.binary()}
SPAN = {"row": pa.int64(), "first": pa.int32(), "last": pa.int32(), "other": pa.int64()}
#: A passage of the least length at an anchor: its hash, the least and largest document known to have it, and
#: whether no neighbour has it.
WINDOW = {"hash": pa.int64(), "low": pa.int64(), "high": pa.int64(), "alone": pa.bool_()}


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """The least or largest of each ``width`` neighbours."""
    done, out = 1, x
    while done < width:
        step = min(done, width - done)
        out = pick(out[:-step], out[step:])
        done += step
    return out


def anchors(grams: np.ndarray, window: int) -> np.ndarray:
    """Places whose hash is the least of some ``window`` neighbours: chosen by content alone, so that
    equal passages of ``window`` grams have an anchor in common."""
    least = _slide(grams, window, np.minimum)
    pad = np.zeros(window - 1, grams.dtype)
    top = _slide(np.concatenate([pad, least, pad]), window, np.maximum)
    return np.flatnonzero(top == grams)


def _documents(column: pa.Array, gram: int, window: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Each document long enough: place, word hashes, hashes of its grams, its anchors."""
    for i, j, words in groups(column, WHITE):
        runs, first = chained(words.hash, gram), words.first.tolist()
        for d in range(j - i):
            a, b = first[d], first[d + 1]
            if b - a >= gram + window - 1:
                own = runs[a: b - gram + 1]
                yield i + d, words.hash[a:b], own, anchors(own, window)


def _anchored(gram: int, window: int):
    def run(batches):
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            n = batch.num_rows
            keys: list = [None] * n
            for d, _, grams, at in _documents(batch.column("text"), gram, window):
                keys[d] = np.unique(grams[at]).astype(np.int64)
            yield pa.RecordBatch.from_pydict({
                "row": pa.array(np.arange(row, row + n)), "doc_id": batch.column("doc_id"),
                "text_hash": batch.column("text_hash"), "keys": pa.array(keys, pa.list_(pa.int64()))})
            row += n
    return run


def _suffixes(gram: int, window: int):
    """A suffix at each shared anchor."""
    side = window

    def run(batches):
        for batch in batches:
            row = batch.column("row").to_pylist()
            shared = batch.column("shared")
            out: dict[str, list] = {c: [] for c in SUFFIX}
            for d, hashes, grams, at in _documents(batch.column("text"), gram, window):
                keys = set(shared[d].as_py())
                # words as 32 bits; 0 stands for what is beyond an end and equals nothing
                small = (hashes >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
                small = np.concatenate([np.zeros(side, np.uint32), small, np.zeros(side, np.uint32)])
                for p in at.tolist():
                    key = int(grams[p].astype(np.int64))
                    if key in keys:
                        for c, v in zip(out, (key, row[d], p, small[p: p + side][::-1].tobytes(),
                                              small[p + side + gram: p + 2 * side + gram].tobytes())):
                            out[c].append(v)
                if len(out["key"]) > 5000:
                    yield pa.RecordBatch.from_pydict({c: pa.array(v, SUFFIX[c]) for c, v in out.items()})
                    out = {c: [] for c in SUFFIX}
            if out["key"]:
                yield pa.RecordBatch.from_pydict({c: pa.array(v, SUFFIX[c]) for c, v in out.items()})
    return run


def _same(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words from the first on in which rows agree."""
    equal = (a == b) & (a != 0)
    return np.where(equal.all(axis=1), a.shape[1], equal.argmin(axis=1))


def _prefixes(words: np.ndarray) -> np.ndarray:
    """Hashes of the first 0, 1, 2, ... words of each row."""
    out = np.zeros((words.shape[0], words.shape[1] + 1), np.uint64)
    for k in range(words.shape[1]):
        out[:, k + 1] = out[:, k] * np.uint64(BASE) + words[:, k]
    return out


def _neighbours(gram: int, side: int, least: int, borders: bool, exact: bool = False):
    """Compares sorted suffixes with the next and the last one of another document.

    Rows of one anchor and document that follow each other are a run. What is held is the newest run
    and a row of the one before, so groups of any size stream by. With ``borders`` the first and the last
    two runs are given out too, for the comparison across tasks.

    With ``exact`` (and suffixes in the order of the words after them) passages of ``least`` words that a
    suffix shares with neither neighbour are looked up by hash among all suffixes of the anchor. A passage that
    goes on from a neighbour to the next is hashed at the first only. Anchors that are held whole are settled
    here; passages of the others are given out, to be counted across batches and tasks.
    """
    def sides(t: dict) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.frombuffer(b"".join(t[c]), np.uint32).reshape(len(t["key"]), side) for c in ("left", "right"))

    def compared(t: dict) -> list[tuple[np.ndarray, ...]]:
        """For the next and the last neighbour: its place or -1, how many words left and right agree, or -1."""
        n = len(t["key"])
        left, right = sides(t)
        key = t["key"]
        new = np.append(runs(t), n)
        run = np.repeat(np.arange(len(new) - 1), np.diff(new))
        out = []
        for other in (new[run + 1], new[run] - 1):
            ok = (other >= 0) & (other < n)
            ok[ok] = key[other[ok]] == key[ok]
            l, r = np.full(n, -1), np.full(n, -1)
            l[ok], r[ok] = _same(left[ok], left[other[ok]]), _same(right[ok], right[other[ok]])
            out.append((np.where(ok, other, -1), l, r))
        return out

    def matched(t: dict, near: list) -> Iterator[tuple]:
        row, place = t["row"], t["place"]
        for j, l, r in near:
            i = np.flatnonzero((j >= 0) & (l + r + gram >= least))
            yield row[i], place[i] - l[i], place[i] + gram + r[i], row[j[i]]

    def looked_up(t: dict, near: list, carried: bool, ended: bool) -> Iterator[tuple[dict, dict]]:
        """Spans and windows to give out, of the runs that ended; the first row was done before if ``carried``."""
        key, row, place, n = t["key"], t["row"], t["place"], len(t["key"])
        begin, need = runs(t), least - gram
        left, right = sides(t)
        k = np.arange(need + 1)
        (after, ln, rn), (before, lb, rb) = near
        by_next, by_last = ((k <= l[:, None]) & (need - k <= r[:, None]) for l, r in ((ln, rn), (lb, rb)))
        # no other document agrees on more words to the right than the neighbours do
        most = np.maximum(rn, rb)
        if not carried:
            most[: begin[1] if len(begin) > 1 else n] = need
        if ended:
            most[begin[-1]:] = need
        first = np.zeros((n, 1), bool)
        first[begin] = True
        asked = (k <= (left != 0).sum(axis=1)[:, None]) & (need - k <= (right != 0).sum(axis=1)[:, None])
        asked &= (need - k <= most[:, None]) & ~(first & by_last)
        asked[: int(carried)] = False
        if not ended:
            asked[begin[-1]:] = False
        alone = asked & ~by_next & ~by_last
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.append(starts, n))
        held_whole = (starts > 0) & (starts + sizes < n)
        open_ = (np.add.reduceat(asked, starts, axis=0, dtype=np.int64) > 1) & np.logical_or.reduceat(alone, starts, axis=0)
        asked &= np.repeat(open_ | ~held_whole[:, None], sizes, axis=0)
        if not asked.any():
            return
        i, k = np.nonzero(asked)
        own, at = np.unique(i, return_inverse=True)
        hashes = mix(_prefixes(left[own])[at, k] + key[i].astype(np.uint64)) * np.uint64(BASE)
        hashes = mix(hashes + _prefixes(right[own])[at, need - k] + k.astype(np.uint64))
        other = np.where(by_next[i, k], row[after[i]], np.where(by_last[i, k], row[before[i]], row[i]))
        low, high = np.minimum(row[i], other), np.maximum(row[i], other)
        start, single, here = place[i] - k, alone[i, k], np.repeat(held_whole, sizes)[i]
        # those of anchors held whole
        e = np.flatnonzero(here)
        e = e[np.argsort(hashes[e], kind="stable")]
        if len(e):
            new = np.flatnonzero(np.concatenate([[True], hashes[e][1:] != hashes[e][:-1]]))
            count = np.diff(np.append(new, len(e)))
            least_row = np.repeat(np.minimum.reduceat(low[e], new), count)
            last_row = np.repeat(np.maximum.reduceat(high[e], new), count)
            good = single[e] & (least_row < last_row)
            e, least_row, last_row = e[good], least_row[good], last_row[good]
            yield dict(zip(SPAN, (row[i[e]], start[e], start[e] + least,
                                  np.where(least_row != row[i[e]], least_row, last_row)))), {}
        e = np.flatnonzero(~here)
        if len(e):
            yield {}, {"row": row[i[e]], "place": start[e], "hash": hashes[e].astype(np.int64), "low": low[e],
                       "high": high[e], "alone": single[e]}

    def runs(t: dict) -> np.ndarray:
        """Where runs begin."""
        return np.flatnonzero(np.concatenate(
            [[True], (t["key"][1:] != t["key"][:-1]) | (t["row"][1:] != t["row"][:-1])]))

    def part(t: dict, a: int, b: int) -> dict:
        return {c: v[a:b] for c, v in t.items()}

    def given(columns: dict) -> pa.RecordBatch:
        """Spans, suffixes at a border or windows; columns of the others are null."""
        n = len(columns["row"])
        return pa.RecordBatch.from_pydict({c: pa.array(columns[c], t) if c in columns else pa.nulls(n, t)
                                           for c, t in (SPAN | SUFFIX | WINDOW).items()})

    def join(a: dict | None, b: dict) -> dict:
        return b if a is None else {c: np.concatenate([a[c], b[c]]) if c in ("key", "row", "place") else a[c] + b[c]
                                    for c in b}

    def compare(batches):
        held, head, tail, carried = None, None, None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            now = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in ("key", "row", "place")}
            now |= {k: batch.column(k).to_pylist() for k in ("left", "right")}
            held = join(held, now)
            begin = runs(held)
            if borders and head is None and len(begin) > 2:
                head = part(held, 0, begin[2])
            near = compared(held)
            for x in matched(held, near):
                if len(x[0]):
                    yield given(dict(zip(SPAN, x)))
            if exact:
                yield from (given(x) for found in looked_up(held, near, carried, False) for x in found if x)
            # the last run may go on, and the next one is compared with it
            tail = part(held, begin[max(0, len(begin) - 2)], None)
            carried = bool(begin[-1] > 0)
            held = part(held, max(0, begin[-1] - 1), None)
        if exact and held:
            yield from (given(x) for found in looked_up(held, compared(held), carried, True) for x in found if x)
        if borders and tail:
            yield given(tail if head is None else join(head, tail))
    return compare


def _merged(batches):
    """Union of each row's spans."""
    for batch in batches:
        out = {"row": [], "first": [], "last": [], "other": []}
        for row, spans in zip(batch.column("row").to_pylist(), batch.column("spans").to_pylist()):
            now = None
            for s in sorted(spans, key=lambda s: (s["first"], s["last"])):
                if now and s["first"] <= now[1]:
                    now = (now[0], max(now[1], s["last"]), min(now[2], s["other"]))
                else:
                    if now:
                        for c, v in zip(out, (row, *now)):
                            out[c].append(v)
                    now = (s["first"], s["last"], s["other"])
            for c, v in zip(out, (row, *now)):
                out[c].append(v)
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
            [("row", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("other", pa.int64())]))


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 50,
                      gram: int = 25) -> DataFrame:
    """Passages of ``least`` words or more that stand in another document too.

    Words are runs of anything but ASCII white space, after lower-casing A to Z. Suffixes are kept
    only at anchors, places whose ``gram``-word hash is the least of ``least - gram + 1`` neighbours, so
    that every repeated passage keeps one. Anchors of a single document leave after a count. The others are
    put in suffix order by a range sort, and again in the order of the words before them; in both orders each
    suffix is compared with the next and the last one of another document, across task borders too. Matches
    grow left and right, word by word. What a suffix shares with a document that is its neighbour in neither order
    is found by hashes of the passages of ``least`` words around the anchor. Overlapping spans are united.

    Null, empty and short texts have no passages. Rows that repeat are separate documents. An
    empty table gives an empty result; other columns are ignored.

    Returns doc_id, first_word, end_word (excluded), n_words, other_doc_id: one row per passage
    and document.
    """
    window = least - gram + 1
    rows = (renamed(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
            .withColumn("text_hash", F.xxhash64("text")))
    kind = rows.schema["doc_id"].dataType.simpleString()
    seen = stored(rows.mapInArrow(_anchored(gram, window),
                                  f"row long, doc_id {kind}, text_hash long, keys array<long>"), "anchors")
    keys = seen.select("row", F.explode("keys").alias("key"))
    often = keys.groupBy("key").agg(F.count("*").alias("docs")).where("docs > 1").select("key")
    shared = stored(keys.join(often, "key").groupBy("row").agg(F.collect_list("key").alias("shared")), "shared")
    about = stored(seen.drop("keys").join(shared.select("row"), "row", "left_semi"), "about")
    wanted = about.select("row", F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    texts = (rows.join(small_side(wanted, wanted.count()), F.col("doc_id").eqNullSafe(F.col("id"))
                       & (F.col("text_hash") == F.col("hash"))).select("row", "text").dropDuplicates(["row"]))
    sources = stored(texts.join(shared, "row"), "shared-texts")
    suffixes = sources.mapInArrow(_suffixes(gram, window), "key long, row long, place int, left binary, right binary")
    schema = ("row long, first int, last int, other long, key long, place int, left binary, right binary, "
              "hash long, low long, high long, alone boolean")
    found = []
    for by in ("right", "left"):
        order = ["key", by, "right" if by == "left" else "left", "row", "place"]
        compared = stored(suffixes.repartitionByRange(*order).sortWithinPartitions(*order)
                          .mapInArrow(_neighbours(gram, window, least, True, by == "right"), schema), by)
        # a few rows for each task of the sort
        border = (compared.where("key IS NOT NULL").select(*SUFFIX).repartition(1).sortWithinPartitions(*order)
                  .mapInArrow(_neighbours(gram, window, least, False), schema))
        found += [x.where("first IS NOT NULL").select(*SPAN) for x in (compared, border)]
        if by == "right":
            windows = compared.where("hash IS NOT NULL").select("row", "place", *WINDOW)
            twice = stored(windows.groupBy("hash").agg(F.min("low").alias("least"), F.max("high").alias("most"))
                           .where("least < most"), "windows")
            found.append(windows.where("alone").join(small_side(twice, twice.count()), "hash").select(
                "row", F.col("place").alias("first"), (F.col("place") + least).alias("last"),
                F.when(F.col("least") != F.col("row"), F.col("least")).otherwise(F.col("most")).alias("other")))
    spans = reduce(lambda a, b: a.unionByName(b), found)
    merged = stored(spans.groupBy("row").agg(F.collect_list(F.struct("first", "last", "other")).alias("spans"))
                    .mapInArrow(_merged, "row long, first int, last int, other long"), "passages")
    name = about.select("row", "doc_id")
    return (merged.join(name, "row")
            .join(name.select(F.col("row").alias("other"), F.col("doc_id").alias("other_doc_id")), "other")
            .select("doc_id", F.col("first").alias("first_word"), F.col("last").alias("end_word"),
                    (F.col("last") - F.col("first")).alias("n_words"), "other_doc_id"))
