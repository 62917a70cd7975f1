"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stored
from .shared import fresh, renamed, small_side, word_count

#: 2**31 and the odd number nearest to 2**31 divided by the golden ratio.
RANGE, STEP = 2147483648, 1327217885


def golden_point(i: Column) -> Column:
    """The i-th golden-ratio point in [0, 1), in exact whole-number arithmetic."""
    return F.pmod(F.pmod(i, F.lit(RANGE)) * F.lit(STEP), F.lit(RANGE)) / F.lit(float(RANGE))


def document_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   source_col: str = "source") -> DataFrame:
    """One narrow stored row per document: number, size in words and the shuffle key."""
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return stored(
        renamed(docs, doc_id=id_col, text=text_col, source=source_col).select(
            F.monotonically_increasing_id().alias("row"), "doc_id", "source",
            F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("text_hash"),
            word_count(F.col("text")).alias("size"), key.alias("shuffle")), "sizes")


def source_targets(sizes: DataFrame, weights=(3, 1, 2), share: float = 1.5,
                   most: int = 2) -> DataFrame:
    """One row per source: number, weight, size, target, quota in whole words.

    Sources in code point order, null last, take ``weights`` in turn and share ``share`` of all
    sizes. A target stops at ``most`` times its source's size; the excess is shared again by
    weight until none is above. Only sums reach the driver; a round ends when no further
    source stops.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.array(*[F.lit(w) for w in weights])
    table = stored(
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("sid", F.row_number().over(order).cast("long") - 1)
        .withColumn("weight", F.element_at(turn, (F.col("sid") % len(weights) + 1).cast("int"))),
        "sources")
    cap = F.lit(most) * F.col("source_size")
    total = share * (table.agg(F.sum("source_size")).first()[0] or 0)
    stopped, held, free = -1, 0, table.agg(F.sum("weight")).first()[0] or 0
    level = 0.0
    while free:
        level = (total - held) / free
        at_cap = cap <= F.lit(level) * F.col("weight")
        count, held, free = table.agg(
            F.count_if(at_cap), F.coalesce(F.sum(F.when(at_cap, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~at_cap, F.col("weight"))), F.lit(0))).first()
        if count == stopped:
            break
        stopped = count
    target = F.round(F.least(cap.cast("double"), F.lit(level) * F.col("weight")), 6)
    if not free:  # every source is at its limit
        target = cap.cast("double")
    return (table.withColumn("target", target)
            .withColumn("quota", F.floor(F.col("target") + 0.5)))


def placed(sizes: DataFrame, sources: DataFrame, n_sources: int, digits: int = 3) -> DataFrame:
    """Each document's first word in the shuffled stream of its source.

    A running sum over a whole source would be one task's work, so it is taken inside buckets
    of the shuffle key (16**digits a source) and moved by the sums of the buckets before.
    """
    rows = (sizes.where("size > 0").join(small_side(sources.select("source", "sid"), n_sources),
                                         sizes["source"].eqNullSafe(sources["source"]))
            .select("row", "doc_id", "size", "shuffle", "sid",
                    F.substring("shuffle", 1, digits).alias("bucket")))
    before = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.groupBy("sid", "bucket").agg(F.sum("size").alias("words"))
              .select("sid", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base")))
    inside = (Window.partitionBy("sid", "bucket").orderBy("shuffle", "size", "row")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (rows.join(starts, ["sid", "bucket"])
            .withColumn("first", F.col("base") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .select("row", "doc_id", "sid", "size", "first"))


def slots(spark: SparkSession, sources: DataFrame, block_words: int, chunk: int = 65536) -> DataFrame:
    """The schedule: slot, source and the source's rank among its slots.

    Slot i takes the source at the i-th golden-ratio point of the cumulated targets; a source's
    ranks count its slots in order, by chunks of slots. A source whose last words the even schedule
    leaves over gets closing slots after the others, a few at most.
    """
    words, n_sources = sources.agg(F.sum("quota"), F.count("*")).first()
    n = -(-int(words or 0) // block_words)
    cum = Window.orderBy("sid")
    parts = sources.where("quota > 0").select(
        "sid", "quota", "source_size", "block",
        ((F.sum("quota").over(cum) - F.col("quota")) / F.lit(float(words or 1))).alias("low"),
        (F.sum("quota").over(cum) / F.lit(float(words or 1))).alias("high"))
    # Interval join by cells: a source is repeated once for each cell that its interval touches.
    cells = 1024
    parts = parts.withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("low") * cells), F.floor(F.col("high") * cells))))
    drawn = (spark.range(n).withColumnRenamed("id", "slot")
             .withColumn("point", golden_point(F.col("slot")))
             .withColumn("cell", F.floor(F.col("point") * cells))
             .join(small_side(parts, n_sources + cells), "cell").where("point >= low AND point < high")
             .select("slot", "sid", F.floor(F.col("slot") / chunk).alias("chunk")))
    before = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = drawn.groupBy("sid", "chunk").agg(F.count("*").alias("n"))
    base = counts.select("sid", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    own = Window.partitionBy("sid", "chunk").orderBy("slot")
    ranked = (drawn.join(base, ["sid", "chunk"])
              .select("slot", "sid", (F.col("base") + F.row_number().over(own) - 1).alias("rank")))
    need = blocks_needed(F.col("quota"), F.col("source_size"), F.col("block"))
    closing = (sources.where("quota > 0").select("sid", need.alias("need"))
               .join(counts.groupBy("sid").agg(F.sum("n").alias("have")), "sid", "left")
               .withColumn("have", F.coalesce("have", F.lit(0))).where("have < need")
               .select("sid", F.explode(F.sequence("have", F.col("need") - 1)).alias("rank"))
               .select((F.lit(n) + F.col("rank") * F.lit(n_sources) + F.col("sid")).alias("slot"),
                       "sid", "rank"))
    return ranked.unionByName(closing)


def blocks_needed(words: Column, stream: Column, block: Column) -> Column:
    """Blocks that ``words`` words of a repeated stream of ``stream`` words reach into."""
    per_pass = F.ceil(stream / block)
    passes = F.floor(words / stream)
    return passes * per_pass + F.ceil((words - passes * stream) / block)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", weights=(3, 1, 2), share: float = 1.5, most: int = 2,
        block_words: int = 4096) -> tuple[DataFrame, DataFrame]:
    """The mix, and one row per document with what the mix takes of it.

    Each source is one stream: its documents, shuffled by a hash of their identifier, end to end,
    cut into blocks of equal words (``block_words`` about). The k-th slot of a source takes the k-th
    block of its stream, which starts again at its end. The last block is cut where the source has
    its target, so the words taken are the target rounded to a word, and no document is
    taken more than ``most`` times.

    Null texts and texts without words have size 0 and take no part; a null source is a source of its own.
    Rows that repeat are separate documents. Null identifiers share one place in the shuffle. An
    empty table gives two empty results; other columns are ignored.

    Returns (slot, row, doc_id, source, pass, skip, words), one row for each stretch of a
    document in a slot, and (row, doc_id, text_hash, source, size, source_size, target, taken).
    """
    spark = docs.sparkSession
    sizes = document_sizes(docs, id_col, text_col, source_col)
    sources = stored(
        source_targets(sizes, weights, share, most).withColumn(
            "block", F.greatest(F.lit(1), F.ceil(F.col("source_size") / F.greatest(
                F.lit(1), F.round(F.col("source_size") / block_words))).cast("long"))), "targets")
    n_sources = sources.count()
    block = F.col("block")
    pieces = (placed(sizes, sources, n_sources)
              .join(small_side(sources.select("sid", "block"), n_sources), "sid")
              .withColumn("nth", F.explode(F.sequence(
                  F.floor(F.col("first") / block), F.floor((F.col("first") + F.col("size") - 1) / block))))
              .select("sid", "nth", "row", "doc_id", "first",
                      F.greatest("first", F.col("nth") * block).alias("start"),
                      F.least(F.col("first") + F.col("size"), (F.col("nth") + 1) * block).alias("end")))
    per_pass = F.ceil(F.col("source_size") / block)
    turns = (slots(spark, sources, block_words)
             .join(small_side(sources.select("sid", "source", "source_size", "block", "quota"),
                              n_sources), "sid")
             .withColumn("pass", F.floor(F.col("rank") / per_pass))
             .select("slot", "sid", "source", "pass", (F.col("rank") - F.col("pass") * per_pass).alias("nth"),
                     (F.col("quota") - F.col("pass") * F.col("source_size")).alias("until")))
    mixed = (turns.join(pieces, ["sid", "nth"])
             .withColumn("words", F.least("end", "until") - F.col("start")).where("words > 0")
             .select("slot", "row", "doc_id", "source", "pass",
                     (F.col("start") - F.col("first")).alias("skip"), "words"))
    taken = mixed.groupBy("row").agg(F.sum("words").alias("taken"))
    narrow = sources.select(F.col("source").alias("of"), "source_size", "target")
    per_doc = (sizes.join(small_side(narrow, n_sources), F.col("source").eqNullSafe(F.col("of")))
               .join(taken, "row", "left")
               .select("row", "doc_id", "text_hash", "source", "size", "source_size", "target",
                       F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))
    return mixed, per_doc


def stretch(text: Column, size: Column, skip: Column, words: Column) -> Column:
    """``words`` words of a text after the first ``skip``, with the white space between them as it is.

    The whole text, if these are all its words.
    """
    spaced = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    cut = F.array_join(F.slice(spaced, skip.cast("int") + 1, words.cast("int")), "")
    return F.when(words == size, text).otherwise(F.regexp_replace(cut, r"^[\x20\x09-\x0D]+", ""))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """What the mix takes, in rows that hold their words: one for each stretch of a document in a slot.

    All columns of the document, its text cut to the stretch, and slot, pass, skip, words, source_size and target
    (under names with underscores added where the documents have such columns). A document that is taken
    twice has rows of both passes; one that the mix takes nothing of has none. So the words of a source's rows are its
    target, and ordering by slot gives the schedule.

    Stretches are gathered by document before its text is joined, which moves a text once. Rows that
    agree in identifier and text lend each other their other columns.
    """
    mixed, per_doc = mix(docs, id_col, text_col, **options)
    about = per_doc.select("row", F.col("doc_id").alias("of"), "text_hash", "size", "source_size", "target")
    own_id, own_hash, own_list, size = fresh(docs, "_id", "_hash", "_list", "_size")
    fields = ["slot", "pass", "skip", "words", "source_size", "target"]
    lists = stored(
        mixed.select("row", *fields[:4]).join(about, "row").groupBy("of", "text_hash", "size").agg(
            F.collect_list(F.struct(*fields)).alias(own_list))
        .toDF(own_id, own_hash, size, own_list), "stretches")
    twice = stored(per_doc.where("size > 0").groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).where("n > 1").select(
        F.col("doc_id").alias(own_id), F.col("text_hash").alias(own_hash)), "twice")
    text = F.col(f"`{text_col}`")

    def same(other: DataFrame) -> Column:
        return F.col(f"`{id_col}`").eqNullSafe(other[own_id]) & (F.xxhash64(F.coalesce(text, F.lit(""))) == other[own_hash])
    n = twice.count()
    if n:
        again = docs.join(small_side(twice, n), same(twice)).dropDuplicates([own_id, own_hash]).drop(own_id, own_hash)
        docs = docs.join(small_side(twice, n), same(twice), "left_anti").unionByName(again)
    columns, names = docs.columns, fresh(docs, *fields)
    found = docs.join(small_side(lists, lists.count()), same(lists)).select(
        *[F.col(f"`{c}`") for c in columns], size, F.explode(own_list).alias(own_list))
    part = {name: F.col(f"{own_list}.{field}") for field, name in zip(fields, names)}
    cut = stretch(text, F.col(size), F.col(f"{own_list}.skip"), F.col(f"{own_list}.words"))
    return found.select(*[cut.alias(c) if c == text_col else F.col(f"`{c}`") for c in columns],
                        *[value.alias(name) for name, value in part.items()])
