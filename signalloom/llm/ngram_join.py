"""Jaccard join of word n-gram sets by parity sketches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .components import components
from .shared import BROADCAST_ROWS, renamed, small_side, without
from .words import BASE, WHITE, chained, groups, mix

#: Size bands: band i holds sizes from RATIO**i on, below RATIO**(i + 1).
RATIO = 4
#: Classes for each shingle of a band's upper end; in bands up to FINE each shingle is a class.
CLASSES, FINE = 0.38, 64
SKETCH_BITS = 512
#: Bytes of text for each bucket of keys, and keys that a task gathers before it sends them on.
BUCKET_BYTES, GATHERED = 16 << 20, 500_000
#: Documents that a task holds at a time.
SLICE = 2000


def shingle_sets(column: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each document's place and its set of ``n``-word shingles as sorted 64-bit hashes."""
    for i, j, words in groups(column, WHITE):
        runs = chained(words.hash, n)
        first = words.first.tolist()
        for d in range(j - i):
            a, b = first[d], first[d + 1]
            if b - a >= n:
                yield i + d, np.unique(runs[a: b - n + 1])
            elif b > a:
                yield i + d, mix(chained(words.hash[a:b], b - a) + np.uint64(b - a))
            else:
                yield i + d, np.empty(0, np.uint64)


def most_apart(a: int, b: int, percent: int) -> int:
    """The largest symmetric difference of two linked sets of these sizes."""
    return (a + b) * (100 - percent) // (100 + percent)


def bands(size: int, percent: int) -> list[tuple[int, int]]:
    """Bands where a set of this size meets its partners, and the most that differs in each.

    A set is in its own band, and in the next one too if a linked set can be of that size.
    """
    own = 0
    while RATIO ** (own + 1) <= size:
        own += 1
    end, largest = RATIO ** (own + 1), size * 100 // percent
    out = [(own, most_apart(size, min(end - 1, largest), percent))]
    if largest >= end:
        out.append((own + 1, most_apart(size, largest, percent)))
    return out


def parity_keys(shingles: np.ndarray, band: int, fine: bool) -> np.ndarray:
    """One key for each filled class: its number and the XOR of the set's shingles in it."""
    salt = np.uint64((band * 2 + fine + 1) * 0x632BE59BD9B4E019 & (1 << 64) - 1)
    end = RATIO ** (band + 1)
    if fine or end <= FINE:
        return mix(shingles ^ salt)
    cls = (shingles >> np.uint64(11)) % np.uint64(int(CLASSES * end))
    order = np.argsort(cls)
    cls = cls[order]
    start = np.flatnonzero(np.concatenate([[True], cls[1:] != cls[:-1]]))
    xor = np.bitwise_xor.reduceat(shingles[order], start)
    return mix(xor ^ mix(cls[start] + salt))


def parity_sketch(shingles: np.ndarray) -> np.ndarray:
    """Each shingle flips one bit of the sketch: the bits that differ are at most the shingles that do."""
    odd = np.bincount((shingles & np.uint64(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def _steps(owners: np.ndarray) -> bytes:
    """Ascending node offsets as differences of two bytes: a stretch of a slice has 2 * SLICE nodes at most."""
    return np.diff(owners.astype(np.int64), prepend=0).astype(np.uint16).tobytes()


def _offsets(steps: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(steps, np.uint16), dtype=np.uint32)


def _runs(owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owners in order and how often each stands there, in runs of 255 at most, so that a byte holds it."""
    own, count = np.unique(owners, return_counts=True)
    parts = (count - 1) // 255 + 1
    out = np.full(parts.sum(), 255, np.uint8)
    out[np.cumsum(parts) - 1] = count - (parts - 1) * 255
    return np.repeat(own, parts), out


class _Sender:
    """Gathers keys of nodes and packs them by bucket."""

    def __init__(self, buckets: int):
        self.buckets, self.nodes, self.keys, self.base = buckets, [], [], None
        self.held = 0

    def add(self, node: int, keys: np.ndarray) -> None:
        if self.base is None:
            self.base = node
        self.nodes.append(node - self.base)
        self.keys.append(keys)
        self.held += len(keys)

    def full(self) -> bool:
        return self.held >= GATHERED

    def rows(self) -> list[dict]:
        if not self.nodes:
            return []
        keys = np.concatenate(self.keys)
        owner = np.repeat(np.arange(len(self.nodes), dtype=np.int64), [len(k) for k in self.keys])
        bucket = (keys >> np.uint64(32)) % np.uint64(self.buckets)
        order = np.argsort(bucket, kind="stable")
        keys, owner, bucket = keys[order], owner[order], bucket[order]
        delta = np.array(self.nodes, np.uint32)
        cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
        out = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            own, count = _runs(owner[a:b])  # owners are in order inside a bucket
            out.append({"bucket": int(bucket[a]), "home": self.base, "owners": _steps(delta[own]),
                        "counts": count.tobytes(),
                        "keys": (keys[a:b] & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes()})
        self.__init__(self.buckets)
        return out


KINDS = {
    "row": pa.int64(), "doc_id": None, "text_hash": pa.int64(), "n": pa.int64(), "print1": pa.int64(),
    "print2": pa.int64(), "sketch": pa.list_(pa.int64()), "band": pa.int32(), "filled": pa.list_(pa.int32()),
    "apart": pa.list_(pa.int32()), "home": pa.int64(), "bucket": pa.int32(), "owners": pa.binary(),
    "counts": pa.binary(), "keys": pa.binary()}
SCHEMA = ("row long, doc_id {id}, text_hash long, n long, print1 long, print2 long, sketch array<long>, band int, "
          "filled array<int>, apart array<int>, home long, bucket int, owners binary, counts binary, keys binary")
PACKED = ["home", "bucket", "owners", "counts", "keys"]


def _described(buckets: int, n: int, percent: int, fine: frozenset, only_fine: bool):
    """The pass over the texts: a row for each document, and rows of keys packed by bucket between them.

    The keys of a stretch of documents are packed together; ``home`` is the first node of the stretch.
    """
    def run(batches):
        row = TaskContext.get().partitionId() << 36
        slices_ = ((whole.slice(at, SLICE), at) for whole in batches for at in range(0, whole.num_rows, SLICE))
        for batch, at in slices_:
            size, sender, pending = batch.num_rows, _Sender(buckets), []
            seen = seen if at else set()
            out = {c: [None] * size for c in ("n", "print1", "print2", "sketch", "band", "filled", "apart", "home")}
            for d, shingles in shingle_sets(batch.column("text"), n):
                spread = mix(shingles)
                both = (int(spread.sum(dtype=np.uint64).astype(np.int64)),
                        int(np.bitwise_xor.reduce(spread * np.uint64(BASE)).astype(np.int64)) if len(spread) else 0)
                out["n"][d], (out["print1"][d], out["print2"][d]) = len(shingles), both
                if not len(shingles):
                    continue
                where = bands(len(shingles), percent)
                keys = [parity_keys(shingles, b, b in fine) for b, _ in where]
                out["band"][d], out["sketch"][d] = where[0][0], parity_sketch(shingles).tolist()
                out["filled"][d], out["apart"][d] = [len(k) for k in keys], [x for _, x in where]
                if (len(shingles), *both) in seen:
                    continue  # equal sets of one Arrow batch send their keys once
                seen.add((len(shingles), *both))
                for k, (b, _) in enumerate(where):
                    if not only_fine or b in fine:
                        sender.add((row + d) * 2 + k, keys[k])
                        out["home"][d] = sender.base
                if sender.held >= GATHERED:
                    pending += sender.rows()
            pending += sender.rows()
            columns = {"row": pa.array(np.arange(row, row + size)), "doc_id": batch.column("doc_id"),
                       "text_hash": batch.column("text_hash")}
            columns |= {c: pa.array(v, KINDS[c]) for c, v in out.items()}
            packed = {c: pa.array([p[c] for p in pending], KINDS[c]) for c in PACKED}
            row += size
            yield from pa.concat_tables([pa.table(columns), pa.table(packed)], promote_options="default").select(
                list(KINDS)).to_batches(max_chunksize=SLICE)
    return run


def _shared_keys(table: pa.Table) -> pa.Table:
    """Keys of one bucket that more than one node has, packed by home again: node, logarithm of the
    number of its nodes, key."""
    home, owners, keys = [], [], []
    bucket = table.column("bucket")[0].as_py()
    for base, own, count, key in zip(*(table.column(c).to_pylist() for c in ("home", "owners", "counts", "keys"))):
        owners.append(np.repeat(_offsets(own), np.frombuffer(count, np.uint8)))
        keys.append(np.frombuffer(key, np.uint32))
        home.append(base)
    which = np.repeat(np.arange(len(home)), [len(k) for k in keys])
    owner, key = np.concatenate(owners), np.concatenate(keys)
    order = np.argsort(key)
    key = key[order]
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    count = np.diff(np.append(start, len(key)))
    often = np.repeat(count > 1, count)
    mark = np.repeat(np.log2(count).astype(np.uint8), count)[often]
    key, order = key[often], order[often]
    back = np.argsort(order)
    key, mark, order = key[back], mark[back], order[back]
    cut = np.searchsorted(which[order], np.arange(len(home) + 1))
    out = {"home": [], "owners": [], "marks": [], "keys": []}
    for k, base in enumerate(home):
        a, b = cut[k], cut[k + 1]
        if b > a:
            for c, v in zip(out, (base, _steps(owner[order[a:b]]), mark[a:b].tobytes(), key[a:b].tobytes())):
                out[c].append(v)
    n = len(out["home"])
    return pa.table({"home": pa.array(out["home"], pa.int64()), "bucket": pa.array([bucket] * n, pa.int32()),
                     **{c: pa.array(out[c], pa.binary()) for c in ("owners", "marks", "keys")}})


def _prefixes(sets: pa.Table, packed: pa.Table) -> pa.Table:
    """The rarest shared keys of each set of one home, one more than may differ; ``lead`` marks the first
    and the last. Sets with too few shared keys have no partner."""
    node, mark, key = [], [], []
    for home, bucket, own, m, k in zip(*(packed.column(c).to_pylist() for c in ("home", "bucket", "owners", "marks", "keys"))):
        node.append(_offsets(own).astype(np.int64) + home)
        mark.append(np.frombuffer(m, np.uint8))
        key.append(np.frombuffer(k, np.uint32).astype(np.int64) + (bucket << 32))
    empty = [np.empty(0, np.int64)]
    node, mark, key = (np.concatenate(x or empty) for x in (node, mark, key))
    order = np.lexsort((key, mark, node))
    node, key = node[order], key[order]
    limits, rep = {}, {}
    for row, own, filled, apart in zip(*(sets.column(c).to_pylist() for c in ("row", "rep", "filled", "apart"))):
        rep[row] = own
        for k in range(len(apart)):
            limits[row * 2 + k] = apart[k] + 1 - filled[k]
    start = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]])) if len(node) else np.empty(0, np.int64)
    count = np.diff(np.append(start, len(node)))
    need = np.array([limits[x] for x in node[start].tolist()], np.int64) + count
    rank = np.arange(len(node)) - np.repeat(start, count)
    need = np.repeat(need, count)
    keep = rank < need
    lead = ((rank == 0) | (rank == need - 1))[keep]
    rows = [rep[x] for x in (node[keep] >> 1).tolist()]
    return pa.table({"key": pa.array(key[keep], pa.int64()), "row": pa.array(rows, pa.int64()), "lead": pa.array(lead)})


def _verified(n: int, percent: int):
    def run(batches):
        for batch in batches:
            left = [s for _, s in shingle_sets(batch.column("text_a"), n)]
            good = np.zeros(batch.num_rows, bool)
            for d, right in shingle_sets(batch.column("text_b"), n):
                both = len(np.intersect1d(left[d], right, assume_unique=True))
                good[d] = both * 100 >= percent * (len(left[d]) + len(right) - both)
            yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in ("a", "b")} | {"linked": pa.array(good)})
    return run


def near_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5,
              percent: int = 75) -> tuple[DataFrame, DataFrame]:
    """Documents with their set sizes, and the component of each set that links with another.

    Two documents link when 100 x the shingles they share is at least ``percent`` x those of both.

    1. One pass makes each set's parity sketches. Shingles are dealt to classes, and a class is kept
       as XOR of its shingles; linked sets of sizes a and b differ in at most
       (a + b)(100 - percent) / (100 + percent) shingles and so in as many classes at most. By
       the pigeonhole principle they share all other classes. Only sets of one size band meet.
    2. Keys (class and XOR) are counted in buckets, packed. A set whose shared keys are fewer than
       its filled classes less those that may differ has no partner and leaves. Others keep
       their rarest keys, one more than may differ: linked sets meet in one of these.
    3. In each group of sets with a key, the least is compared with the others; a group whose
       sets are connected by then is done, and others go on with sixteen times as many to compare with. Sizes
       and the Hamming distance of sketches, which is at most the symmetric difference, are compared inside
       the join; only pairs that pass are made and then verified by their sets.

    A band in which some set fills no more classes than may differ is done again with every
    shingle a class of its own, which always suffices, so no link is lost.

    Returns the sets (row, doc_id, text_hash, n, ...) and (row, component), the least row of each component.
    """
    rows = renamed(docs, doc_id=id_col, text=text_col).select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 + int(size) // BUCKET_BYTES
    schema = SCHEMA.format(id=rows.schema["doc_id"].dataType.simpleString())
    described = stored(rows.mapInArrow(_described(buckets, n, percent, frozenset(), False), schema), "described")
    sets = described.where("row IS NOT NULL").drop("bucket", "owners", "counts", "keys")
    several = stored(sets.where("n > 0").groupBy("n", "print1", "print2").agg(
        F.min("row").alias("rep"), F.count("*").alias("m")).where("m > 1").drop("m"), "several")
    n_several = several.count()
    sets = sets.join(small_side(several, n_several), ["n", "print1", "print2"], "left")
    cand = _candidates(described, sets)
    short = [r["band"] for r in sets
             .select("band", F.posexplode(F.arrays_zip("filled", "apart")).alias("k", "x"))
             .where("x.filled <= x.apart").select((F.col("band") + F.col("k")).alias("band"))
             .distinct().collect()]
    if short:
        again = stored(rows.mapInArrow(_described(buckets, n, percent, frozenset(short), True), schema), "fine")
        fine = again.where("row IS NOT NULL").select("row", "home", "filled", "apart").join(
            sets.select("row", "rep"), "row")
        cand = cand.unionByName(_candidates(again, fine))
    cand = stored(cand, "candidates")
    about = stored(sets.join(cand.select("row").distinct(), "row", "left_semi"), "about")
    wanted = about.select("row", F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    texts = stored(_once(rows.join(small_side(wanted, wanted.count()), F.col("doc_id").eqNullSafe(F.col("id"))
                                   & (F.col("text_hash") == F.col("hash"))), sets), "texts")
    label = _connected(cand, about.select("row", "n", "sketch"), texts, n, percent)
    copies = sets.where("rep IS NOT NULL").select("row", "rep")
    label = (copies.join(label.toDF("rep", "at"), "rep", "left").select("row", F.coalesce("at", "rep").alias("component"))
             .unionByName(label.join(copies.select("row"), "row", "left_anti").select("row", "component")))
    return sets, label


def _once(found: DataFrame, sets: DataFrame) -> DataFrame:
    """(row, text) of joined texts, each once: only texts of rows that repeat are shuffled to drop the rest."""
    repeated = stored(sets.groupBy("doc_id", "text_hash").agg(F.count("*").alias("m")).where("m > 1").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")), "repeated")
    n = repeated.count()
    if not n:
        return found.select("row", "text")
    repeated = small_side(repeated, n)
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash"))
    return found.join(repeated, same, "left_anti").select("row", "text").unionByName(
        found.join(repeated, same, "left_semi").select("row", "text").dropDuplicates(["row"]))


def _needed(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The texts of the rows of some pairs, so that a join with them moves no others."""
    rows = stored(pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct(), "needed")
    n = rows.count()
    # beyond this a semi-join would move every text to spare some of them a move
    return texts.join(small_side(rows, n), "row", "left_semi") if n <= BROADCAST_ROWS else texts


def _candidates(described: DataFrame, sets: DataFrame) -> DataFrame:
    """(key, row, lead): the keys by which sets can find their partners, for one of each equal sets."""
    shared = (described.where("bucket IS NOT NULL").select(*PACKED).groupBy("bucket")
              .applyInArrow(_shared_keys, "home long, bucket int, owners binary, marks binary, keys binary"))
    narrow = sets.where("home IS NOT NULL").select(
        "home", "row", F.coalesce("rep", "row").alias("rep"), "filled", "apart")
    return narrow.groupBy("home").cogroup(shared.groupBy("home")).applyInArrow(
        _prefixes, "key long, row long, lead boolean")


def _connected(cand: DataFrame, about: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """(row, component) of all sets with a link, as described in :func:`near_sets`."""
    n_about = about.count()

    def with_sketch(rows: DataFrame, row: str, suffix: str) -> DataFrame:
        side = about.toDF(row, f"n_{suffix}", f"sketch_{suffix}")
        return rows.join(small_side(side, n_about), row)

    bits = F.aggregate(F.zip_with("sketch_a", "sketch_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))),
                       F.lit(0), lambda s, x: s + x)
    near = ((F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
            & (bits * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent)))

    def linked(members: DataFrame, heads: DataFrame, apart, some: bool) -> DataFrame:
        """Verified links between heads and members of a group. Sizes and sketches are compared in the
        join itself, so that pairs that can't link are never made; ``some``: pairs are of few of the texts."""
        left, right = with_sketch(heads, "head", "a"), with_sketch(members, "row", "b")
        pairs = (right.join(left, (right["key"] == left["key"]) & apart & near)
                 .select(F.least("head", "row").alias("a"), F.greatest("head", "row").alias("b")).distinct())
        own = texts
        if some:
            pairs = stored(pairs, "pairs")
            own = _needed(texts, pairs)
        return (pairs.join(own.toDF("b", "text_b"), "b").join(own.toDF("a", "text_a"), "a")
                .select("a", "b", "text_a", "text_b")
                .mapInArrow(_verified(n, percent), "a long, b long, linked boolean").where("linked").select("a", "b"))

    # The first round looks at two keys of each set only; that connects most.
    first = cand.where("lead").select("key", "row")
    links = linked(first, first.groupBy("key").agg(F.min("row").alias("head")), F.col("head") != F.col("row"), False)
    label = stored(components(links).toDF("row", "component"), "labels")
    cand, lead = cand.select("key", "row"), 1
    while True:
        tagged = cand.join(small_side(label, label.count()), "row", "left").select(
            "key", "row", F.coalesce("component", "row").alias("component"))
        mixed = stored(tagged.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"))
                       .where("x != y").select("key"), "mixed")
        n_mixed = mixed.count()
        if not n_mixed:
            return label
        cand = stored(tagged.join(small_side(mixed, n_mixed), "key", "left_semi").distinct(), "candidates")
        if lead == 1:
            heads = cand.groupBy("key").agg(F.min(F.struct("row", "component")).alias("x")).select(
                "key", F.col("x.row").alias("head"), F.col("x.component").alias("of"))
        else:
            nth = F.row_number().over(Window.partitionBy("key").orderBy("row"))
            heads = cand.withColumn("nth", nth).where(F.col("nth") <= lead).select(
                "key", F.col("row").alias("head"), F.col("component").alias("of"))
        links = stored(linked(cand, heads, F.col("of") != F.col("component"), True), "links")
        # sets that met all others of their group leave it
        met = heads.select("key", F.col("head").alias("row"))
        cand = cand.select("key", "row").join(met, ["key", "row"], "left_anti")
        lead *= 16
        if links.isEmpty():
            continue
        # components are joined by links between them
        between = (links.join(label.toDF("a", "of_a"), "a", "left").join(label.toDF("b", "of_b"), "b", "left")
                   .select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")))
        merged = components(between)
        moved = merged.toDF("component", "to")
        label = stored(
            label.join(moved, "component", "left").select("row", F.coalesce("to", "component").alias("component"))
            .unionByName(merged.toDF("row", "component").join(label.select("row"), "row", "left_anti")), "labels")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5,
                percent: int = 75) -> DataFrame:
    """One row per document: (row, doc_id, text_hash, n_shingles, component_id, component_row).

    Words are runs of anything but ASCII white space, after lower-casing A to Z. A document's set
    holds its distinct ``n``-word shingles; fewer words are one shingle. Null, empty and wordless texts
    have empty sets and link with nothing. The component is the least identifier reachable by
    links. Rows that repeat are separate rows with one component; a null identifier is
    never the least of a component with others. An empty table gives an empty result; other columns are ignored.
    """
    sets, label = near_sets(docs, id_col, text_col, n, percent)
    rows = sets.join(label, "row", "left").select(
        "row", "doc_id", "text_hash", F.col("n").alias("n_shingles"), F.coalesce("component", "row").alias("at"))
    rows = stored(rows, "labelled")
    least = (rows.groupBy("at").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("m"))
             .where("m > 1").drop("m"))
    first = (rows.join(least, "at").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
             .groupBy("at").agg(F.min("row").alias("component_row")))
    return (rows.join(least.join(first, "at"), "at", "left")
            .select("row", "doc_id", "text_hash", "n_shingles",
                    F.coalesce("component_id", "doc_id").alias("component_id"),
                    F.coalesce("component_row", "row").alias("component_row")))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5,
                percent: int = 75) -> DataFrame:
    """The document with the least identifier of each component, all columns kept."""
    found = stored(near_groups(docs, id_col, text_col, n, percent), "groups")
    gone = found.where("row != component_row").select("doc_id", "text_hash").distinct()
    kept = found.where("row = component_row").select("doc_id", "text_hash")
    text = F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    return without(docs, F.col(f"`{id_col}`"), text, gone, kept)
