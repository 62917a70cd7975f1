"""Phrase collocations by dynamic itemset counting."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_folder
from .shared import renamed
from .words import BASE, hashes, mix, slices, small_batches, words_of

#: Slots of the table of reached phrases of one length. A task holds a byte for each.
SLOTS = 1 << 24
#: What an empty slot holds.
NEVER = 255
BREAK, BLANK = 10, 32
#: A to Z become lower case, bytes that end a piece line feeds, bytes between words blanks.
_BYTES = bytes(BREAK if b in b".,;:!?" or 10 <= b <= 13 else BLANK if b in (9, 32) else b + 32 if 65 <= b <= 90 else b
               for b in range(256))
#: A language and a phrase, a tab between them (no phrase holds one), are one key: narrow rows make up the work.
STATE = "key string, since int, count long, reached int"


def _tokens(raw: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Each word's number in the list of distinct words, the number of its piece, and that list."""
    text = raw.translate(_BYTES)
    data = np.frombuffer(text, np.uint8)
    solid = np.zeros(len(data) + 2, bool)
    solid[1:-1] = (data != BLANK) & (data != BREAK)
    begins, ends = solid[1:-1] & ~solid[:-2], solid[1:-1] & ~solid[2:]
    cut = offsets[(offsets > 0) & (offsets < len(data))]
    begins[cut] |= solid[1:-1][cut]
    ends[cut - 1] |= solid[1:-1][cut - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offsets)
    piece = (np.cumsum(data == BREAK, dtype=np.int32)[start]
             + np.repeat(np.arange(len(first) - 1, dtype=np.int32), np.diff(first)))
    places = np.empty(2 * len(start), np.int64)
    places[::2], places[1::2] = start, end
    # every other of the ranges between these places is a word
    ranges = pa.Array.from_buffers(pa.large_binary(), max(0, len(places) - 1), [None, pa.py_buffer(places), pa.py_buffer(text)])
    coded = ranges.take(pa.array(np.arange(0, len(ranges), 2))).dictionary_encode()
    return np.asarray(coded.indices, np.int32), piece, coded.dictionary


def _word_hashes(words: pa.Array) -> np.ndarray:
    at = np.frombuffer(words.buffers()[1], np.int64)[words.offset: words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    return hashes(data, at[:-1], at[1:])


def _salt(langs: list[str]) -> np.ndarray:
    return np.concatenate([hashes(np.frombuffer(b, np.uint8), np.zeros(1, np.int64), np.array([len(b)]))
                           for b in (x.encode() for x in langs)] or [np.empty(0, np.uint64)])


def _longer(shorter: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(shorter * np.uint64(BASE) + word)


def _slots(hash_: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    low = np.uint64(size - 1)
    return (hash_ & low).astype(np.int64), ((hash_ >> np.uint64(32)) & low).astype(np.int64)


def _reached_in(table: np.ndarray | None, hash_: np.ndarray) -> np.ndarray:
    """The scan in which each hash was reached, by its two slots: the later of what they hold, or NEVER."""
    if table is None:
        return np.full(len(hash_), NEVER, np.int64)
    one, other = _slots(hash_, len(table))
    return np.maximum(table[one], table[other]).astype(np.int64)


def _counted(shared, longest: int, step: int, shards: int):
    """Occurrences in each group of documents of one language: of words in the first cycle, and of phrases
    both of whose parts (without the last word, without the first) were reached, for a cycle from then on."""
    single = step < shards

    def rows(lang: str, phrase: pa.Array, count: np.ndarray, since: np.ndarray) -> pa.RecordBatch:
        key = pc.binary_join_element_wise(pa.scalar(lang.encode(), pa.large_binary()), phrase,
                                          pa.scalar(b"\t", pa.large_binary()))
        return pa.RecordBatch.from_pydict({
            "key": key.cast(pa.binary()).cast(pa.string()), "since": pa.array(since.astype(np.int32)),
            "count": pa.array(count.astype(np.int64))})

    def group(lang: str, raw: bytes, offsets: np.ndarray, tables: dict):
        word, piece, names = _tokens(raw, offsets)
        if not len(word):
            return
        if single:
            yield rows(lang, pa.array([b""], pa.large_binary()), np.array([len(word)]), np.zeros(1))
            yield rows(lang, names, np.bincount(word, minlength=len(names)), np.zeros(len(names)))
        own = _word_hashes(names)
        gram, hash_, phrase = word, mix(own ^ _salt([lang])[0]), names
        at = np.arange(len(word), dtype=np.int32)  # where phrases of the present length begin, whose numbers gram holds
        for n in range(2, longest + 1):
            reached = _reached_in(tables.get(n - 1), hash_)
            near = reached < NEVER
            # a phrase of n words begins where two of n - 1 words begin side by side in a piece
            two = np.flatnonzero((at[1:] == at[:-1] + 1) & (piece[at[:-1]] == piece[at[1:] + n - 2])
                                 & near[gram[:-1]] & near[gram[1:]])
            if not len(two):
                return
            last = word[at[two] + n - 1]
            key, place, inverse = np.unique(gram[two].astype(np.int64) * len(names) + last,
                                            return_index=True, return_inverse=True)
            before, after = gram[two][place], last[place]
            since = np.maximum(reached[before], reached[gram[two + 1][place]]) + 1
            phrase = pc.binary_join_element_wise(phrase.take(pa.array(before)), names.take(pa.array(after)),
                                                 pa.scalar(b" ", pa.large_binary()))
            hash_ = _longer(hash_[before], own[after])
            at, gram = at[two], inverse.astype(np.int32)
            some = np.flatnonzero(step < since + shards)
            if len(some):
                yield rows(lang, phrase.take(pa.array(some)), np.bincount(gram, minlength=len(key))[some], since[some])

    def run(batches):
        tables = shared.value
        for batch in small_batches(batches, 1000):
            langs, text = batch.column("lang"), batch.column("text")
            for lang in langs.unique().to_pylist():
                for _, _, raw, offsets in slices(text.filter(pc.equal(langs, lang)), 4 << 20):
                    yield from group(lang, raw, offsets, tables)
    return run


def _slots_of(size: int):
    """Rows (n, slot) of both slots of each phrase."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column("phrase").cast(pa.large_string())
            at = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
            raw = column.buffers()[2].to_pybytes()[int(at[0]): int(at[-1])]
            words = words_of(raw, at - at[0], bytes(range(256)))
            langs = batch.column("lang").dictionary_encode()
            salt = _salt(langs.dictionary.to_pylist())[np.asarray(langs.indices, np.int64)]
            n = np.asarray(batch.column("n"), np.int64)
            hash_ = mix(words.hash[words.first[:-1]] ^ salt)
            for k in range(1, int(n.max())):
                long = np.flatnonzero(n > k)
                hash_[long] = _longer(hash_[long], words.hash[words.first[long] + k])
            yield pa.RecordBatch.from_pydict({"n": pa.array(np.concatenate([n, n]).astype(np.int32)),
                                              "slot": pa.array(np.concatenate(_slots(hash_, size)))})
    return run


def _note(tables: dict[int, np.ndarray], reached: DataFrame, step: int, size: int) -> None:
    """Fills the slots of phrases reached in ``step``; what a slot holds never changes.

    They come as bitmaps of 32,768 slots, so the driver gets a bit for each slot at most.
    """
    slots = reached.mapInArrow(_slots_of(size), "n int, slot long").withColumn("slot", F.col("slot") + 1)
    maps = slots.groupBy("n", F.bitmap_bucket_number("slot").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).toArrow()
    for n, part, bits in zip(*(maps.column(c).to_pylist() for c in ("n", "part", "bits"))):
        table = tables.setdefault(n, np.full(size, NEVER, np.uint8))
        own = (part - 1) * 32768 + np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little"))
        table[own] = np.minimum(table[own], step)


def _drop(spark: SparkSession, path: str) -> None:
    """Removes a folder of this operator that a newer one replaces."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def frequent(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = 3, least: int = 10,
             shards: int = 2) -> DataFrame:
    """(lang, phrase, n, count): all phrases of up to ``longest`` words with ``least`` occurrences or more.

    Dynamic itemset counting: documents are dealt to ``shards``, which are scanned one after the other in a
    cycle. Words are counted from the first scan on. A longer phrase is counted from the scan
    after that in which both its parts (without the last word, without the first) have reached
    ``least``, beside the shorter ones that are still counted, and for one full cycle, so that every shard counts once.
    The scans end when the last phrase has completed its cycle, after ``longest`` cycles at most.

    Tasks know in which scan a phrase was reached from a table of a fixed size for each length, by two
    slots of its hash. A slot keeps the first scan that was noted in it, so what a task reads never changes
    after it was set, and every phrase whose parts were reached has one full cycle. Phrases whose slots others
    filled are counted too, for a full cycle of theirs; that is work for nothing as soon as they stay
    below ``least``, and right if they don't. The row with n = 0 has the number of words of a language.

    Each scan's counts and the state (what is reached, or still counted) are summed in one shuffle and
    written; the state before is removed.
    """
    if longest * shards >= NEVER:
        raise ValueError("too many scans: longest times shards must be less than 255")
    spark = docs.sparkSession
    parts = shared_folder(spark, "shards")
    renamed(docs, text=text_col, lang=lang_col).select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"),
        F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int").alias("shard")
    ).where("text != ''").write.partitionBy("shard").parquet(parts)
    texts = spark.read.schema("lang string, text string, shard int").parquet(parts)
    state, path, step, last = None, None, 0, -1
    tables: dict[int, np.ndarray] = {}
    phrase = F.substring_index("key", "\t", -1)
    lang = F.expr("left(key, char_length(key) - char_length(phrase) - 1)")
    words = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " "))).cast("int")
    while step < shards or step <= last + shards:
        shared = spark.sparkContext.broadcast(tables)
        seen = texts.where(F.col("shard") == step % shards).select("lang", "text").mapInArrow(
            _counted(shared, longest, step, shards), "key string, since int, count long"
        ).withColumn("reached", F.lit(None).cast("int"))
        total = (seen if state is None else seen.unionByName(state)).groupBy("key", "since").agg(
            F.sum("count").alias("count"), F.max("reached").alias("reached"))
        whole = F.endswith("key", F.lit("\t"))  # all words of a language
        total = total.withColumn("reached", F.when(~whole, F.coalesce(
            "reached", F.when(F.col("count") >= least, step))).cast("int"))
        needed = (F.col("since") + shards > step + 1) | F.col("reached").isNotNull() | whole
        newer = shared_folder(spark, "phrases")
        total.where(needed).select("key", "since", "count", "reached").write.parquet(newer)
        shared.destroy()
        if path:
            _drop(spark, path)
        path = newer
        state = spark.read.schema(STATE).parquet(path)
        fresh = state.where(F.col("reached") == step).withColumn("phrase", phrase).select(
            lang.alias("lang"), "phrase", words.alias("n")).where(F.col("n") < longest)
        if not fresh.isEmpty():
            _note(tables, fresh, step, SLOTS)
            last = step
        step += 1
    _drop(spark, parts)
    return state.withColumn("phrase", phrase).where("phrase = '' OR reached IS NOT NULL").select(
        lang.alias("lang"), "phrase", words.alias("n"), "count")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = 3, least: int = 10,
                 top: int = 2000, inside: int = 50, shards: int = 2) -> DataFrame:
    """The best ``top`` phrases of 2 to ``longest`` words of each language.

    Texts are lower-cased (A to Z) and split at ``.,;:!?`` and line ends into pieces, and pieces at blanks and
    tabs into words. A phrase is a run of words of one piece; overlapping occurrences all count. A phrase of a
    occurrences, cut into parts of l and r, scores floor(1000000 a a / (l r)); its lowest cut counts, of
    equal ones that with the shorter first part. A phrase that stands inside a longer frequent one with ``inside`` percent of
    its occurrences or more is left out. Counts are those of :func:`frequent`; products are exact decimals.

    Ranks go by score, then a, both descending, then by the phrase's UTF-8 bytes. A null language counts as
    ``und``; null and empty texts have no words; rows that repeat all count; an empty table gives an empty
    result. Other columns are ignored.

    Returns lang, rank, phrase, a, l, r, n (words of the language), score.
    """
    found = frequent(docs, text_col, lang_col, longest, least, shards)
    words = found.where("n = 0").select("lang", F.col("count").alias("words"))
    known = found.where(F.col("n").between(1, longest - 1)).select("lang", "phrase", "count")
    phrases = found.where("n >= 2").select("lang", "phrase", "n", F.col("count").alias("a"))
    cuts = phrases.withColumn("k", F.explode(F.expr("sequence(1, n - 1)"))).withColumns({
        "head": F.expr("substring_index(phrase, ' ', k)"), "tail": F.expr("substring_index(phrase, ' ', k - n)")})
    cuts = (cuts.join(known.toDF("lang", "head", "l"), ["lang", "head"])
            .join(known.toDF("lang", "tail", "r"), ["lang", "tail"]))
    score = F.expr("(CAST(1000000 AS DECIMAL(7, 0)) * (CAST(a AS DECIMAL(19, 0)) * CAST(a AS DECIMAL(19, 0))))"
                   " div (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0)))")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = phrases.where("n >= 3").select(
        "lang", "a", "n", F.split("phrase", " ").alias("w")).select(
        "lang", "a", "n", "w", F.explode(F.expr("sequence(2, n - 1)")).alias("size")).select(
        "lang", "a", F.explode(F.expr("transform(sequence(1, n - size + 1), x -> concat_ws(' ', slice(w, x, size)))"))
        .alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    kept = scored.join(inner, ["lang", "phrase"], "left").where(
        F.col("most").isNull() | (F.col("most") * 100 < F.col("a") * inside))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(words, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", F.col("words").alias("n"),
        "cut.score")
