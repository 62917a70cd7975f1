"""The shared path from landed payloads to postings.

A landed table has one row per API response or page: slug, company, search_term, domain,
url, payload (text) and ``seq``, its place in reading order. Payloads that do not parse give
no rows, so one bad response never fails a run; :mod:`rejects` counts and keeps them.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..functions import text as X
from ..lexicon import PERK_LEXICON, Lexicon
from ..operators.dedup import first_wins, last_wins
from ..schemas import JOB_COLUMNS, LANDED


def with_seq(df: DataFrame, out: str = "seq") -> DataFrame:
    """Number file rows in reading order (file, block, row); gaps are fine, order is not lost.

    monotonically_increasing_id alone follows task numbers, which follow file sizes.
    """
    place = F.struct(F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("row"))
    return df.withColumn(out, place)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """Landed payloads from JSON lines."""
    return with_seq(spark.read.schema(LANDED).json(path))


def write_landed(landed: DataFrame, path: str) -> None:
    """Adds payloads with columns ``source`` and ``landed_on`` to a table with a folder for each source and day.

    The rebalance hint gives a folder few files and splits those of large days.
    """
    landed.hint("rebalance", "source", "landed_on").write.mode("append").partitionBy("source", "landed_on").parquet(path)


def read_days(spark: SparkSession, path: str, source: str, today: date, max_age_days: int) -> DataFrame:
    """Payloads of a source that landed within ``max_age_days``; other sources' and older folders are not read.

    What was posted within that time can't have landed before it, so a feed restricted by :func:`recent`
    finds all of its postings here.
    """
    table = spark.read.schema(T.StructType([*LANDED, T.StructField("source", T.StringType()),
                                            T.StructField("landed_on", T.DateType())])).parquet(path)
    first = F.lit(today - timedelta(days=max_age_days))
    return with_seq(table.where((F.col("source") == source) & (F.col("landed_on") >= first))).drop("source", "landed_on")


def or_blank(name: str) -> Column:
    return F.coalesce(name, F.lit(""))


def landed_texts(pages: DataFrame) -> DataFrame:
    """Pages looked up by url, with the order they landed in, which decides which is newest."""
    order = F.col("fetched_at") if "fetched_at" in pages.columns else F.lit("")
    seq = F.col("seq") if "seq" in pages.columns else F.lit(0)
    return pages.withColumns({"seq": F.struct(order, seq), "pos": F.lit(0)})


def items(landed: DataFrame, schema: str, *paths: str) -> DataFrame:
    """One row per array element (``job``) of the first non-empty array among ``paths``.

    A table that was parsed before, to count its rejects, has ``_p`` already.
    """
    if "_p" in landed.columns:
        return explode_first(landed, *[f"_p.{p or 'items'}" for p in paths]).drop("_p")
    parsed = landed.withColumn("_p", F.from_json("payload", schema))
    return explode_first(parsed, *[f"_p.{p}" if p else "_p" for p in paths]).drop("_p")


def explode_first(df: DataFrame, *paths: str) -> DataFrame:
    arrays = [F.when(F.size(p) > 0, F.col(p)) for p in paths]
    kept = [c for c in df.columns if c != "payload"]
    return df.select(*kept, F.posexplode(F.coalesce(*arrays)).alias("pos", "job"))


def to_jobs(df: DataFrame, number: int, *, source: Column | str, company: Column, title: Column,
            body: Column, url: Column, location: Column | None = None,
            date_posted: Column | None = None, remote: Callable | Column | None = None,
            domain: Column | None = None, lexicon: Lexicon = PERK_LEXICON,
            wanted: tuple[str, ...] | None = None, placed: Callable | None = None,
            searched: Callable | None = None, fallback: Callable | None = None,
            when_empty: Column | None = None, dedup: str = "first",
            need_text: bool = False, keep: Column | None = None, by: tuple[str, ...] = (),
            sift: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Clean, place, match and project one source to the posting columns.

    ``remote``, ``placed`` (text of the location test), ``searched`` (text of the match) and
    ``fallback`` (array of keywords if the lexicon finds none) are functions of the cleaned
    body column. dedup: "first" and "last" keep that row of a url, matched or not, and drop
    blank urls; "none" keeps all. Bodies are reduced to their excerpt before any shuffle:
    what joins a source with other tables is ``sift``, a function of the narrow rows that
    comes before the deduplication. It sees the columns ``by`` of the input too, which are
    also part of the deduplication key.
    """
    blank = F.lit("")
    def value(c: Column | None) -> Column:
        return blank if c is None else F.coalesce(c, blank)
    seq = F.struct(F.lit(number).alias("source_no"), F.col("seq"), F.col("pos"))
    raw = df.select(
        (F.lit(source) if isinstance(source, str) else source).alias("source"),
        value(company).alias("company"), value(title).alias("title"),
        value(location).alias("location"), value(date_posted).alias("date_posted"),
        value(url).alias("url"), value(domain).alias("_domain"),
        value(F.col("search_term") if "search_term" in df.columns else None).alias("term"),
        # what is not kept can't match, so its text is not looked at
        value(body if keep is None else F.when(keep, body)).alias("body"),
        (F.lit(None).cast("string") if remote is None or callable(remote)
         else value(remote)).alias("remote"),
        (F.lit(True) if keep is None else F.coalesce(keep, F.lit(False))).alias("keep"),
        value(when_empty).alias("empty_excerpt"), seq.alias("ingest_seq"),
        *[F.col(c).alias(f"_by_{c}") for c in by])
    full = X.with_clean_text(raw, "body", "full_text").drop("body")
    text = F.col("full_text")
    full = full.withColumn("text_lc", F.lower(text if searched is None else searched(text)))
    full = full.withColumn("kw", X.term_hits("text_lc", lexicon))
    if fallback is not None:
        full = full.withColumn("kw", F.when(F.size("kw") > 0, F.col("kw"))
                               .otherwise(fallback(F.col("text_lc"))))
    where = text if placed is None else placed(text)
    matched = (F.col("keep") & (F.size("kw") > 0) & X.in_location(where, wanted)
               & ((text != "") if need_text else F.lit(True)))
    flagged = full.withColumn("matched", F.coalesce(matched, F.lit(False)))
    low = F.col("text_lc") if searched is None else None
    flagged = flagged.drop("text_lc") if low is None else flagged
    if dedup == "none":
        flagged = X.keep(flagged, F.col("matched"))

    # Rows without a match only hold their url's place: nothing else of them is computed.
    remote_text = remote(text) if callable(remote) else F.coalesce("remote", blank)
    snippet = F.when(text == "", F.col("empty_excerpt")).otherwise(
        X.excerpt(text, F.get("kw", F.lit(0)), low=low))
    computed = {"food_keywords_matched": X.join_list(F.col("kw")), "keyword_count": F.size("kw"),
                "perk_excerpt": F.coalesce(snippet, blank), "remote": remote_text}
    values = [F.when(F.col("matched"), computed[c] if c in computed else F.col(c)).alias(c)
              for c in JOB_COLUMNS if c != "url"]
    extra = [f"_by_{c}" for c in by]
    narrow = flagged.select("url", *values, "ingest_seq", "matched", *extra)
    if sift is not None:
        narrow = sift(narrow)
    if dedup != "none":
        pick = first_wins if dedup == "first" else last_wins
        narrow = pick(narrow.where(F.trim("url") != ""), [*extra, "url"],
                      "ingest_seq").where("matched")
    return narrow.select(*JOB_COLUMNS, "ingest_seq")


def preview(jobs: DataFrame, per_source: int = 5, shown: int = 15) -> DataFrame:
    """Dry-run view: the first rows of each source, a few in all."""
    first = F.row_number().over(Window.partitionBy("source").orderBy("ingest_seq"))
    return (jobs.withColumn("_n", first).where(F.col("_n") <= per_source).drop("_n")
            .orderBy("ingest_seq").limit(shown))


def recent(df: DataFrame, day: str, today: Column, max_age_days: int,
           country: str | None = None) -> DataFrame:
    """Rows dated within ``max_age_days``, of one country if the table names countries."""
    kept = df.where(F.try_to_date(F.substring(day, 1, 10))
                    >= F.date_sub(today, max_age_days))
    return kept.where(F.col("country") == country) if country else kept
