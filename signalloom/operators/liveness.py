"""Which postings are still open, judged from a snapshot of their pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import url_host
from ..lexicon import ALIVE_STATUS, CLOSED_PHRASES, DEAD_STATUS


def closed_phrases(url: Column, phrases=CLOSED_PHRASES) -> Column:
    """All closed phrases that apply to the host of a url, in table order."""
    host = url_host(url)
    none = F.array().cast("array<string>")
    groups = []
    for part, texts in phrases:
        listed = F.array(*[F.lit(t) for t in texts])
        groups.append(listed if part == "" else
                      F.when(F.contains(host, F.lit(part)), listed).otherwise(none))
    return F.concat(*groups)


def first_closed_phrase(host: Column, body: Column, phrases=CLOSED_PHRASES) -> Column:
    """First phrase of the host found in the lower-case body, or null."""
    hits = []
    for part, texts in phrases:
        for text in texts:
            found = F.contains(body, F.lit(text))
            if part:
                found = F.contains(host, F.lit(part)) & found
            hits.append(F.when(found, F.lit(text)))
    return F.coalesce(*hits)


def verdict(url: Column, status: Column, body: Column, fetch_error: Column, host: Column,
            low: Column, phrases=CLOSED_PHRASES) -> Column:
    """struct(is_live, reason) by the first rule that applies.

    ``host`` of the url and ``low``, the lower-case body, should be stored columns.
    """
    def say(live: bool, reason: Column | str) -> Column:
        reason = F.lit(reason) if isinstance(reason, str) else reason
        return F.struct(F.lit(live).alias("is_live"), reason.alias("reason"))

    http = F.concat(F.lit("HTTP "), status.cast("string"))
    phrase = first_closed_phrase(host, low, phrases)
    listed = F.get_json_object(body, "$.is_listed")
    unlisted = (F.contains(host, F.lit("boards-api.greenhouse.io"))
                & (listed.isin("false", "0", "") | body.rlike(r'"is_listed"\s*:\s*null')))
    ashby = F.lower(F.get_json_object(body, "$.status"))
    closed = F.contains(host, F.lit("ashbyhq.com")) & ashby.isin("closed", "draft", "archived")
    return (
        F.when(~F.coalesce(F.startswith(url, F.lit("http")), F.lit(False)),
               say(False, "invalid URL"))
        .when(fetch_error == "timeout", say(True, "timeout (assumed live)"))
        .when(fetch_error == "connection", say(False, "connection error"))
        .when(F.coalesce(fetch_error, F.lit("")) != "",
              say(True, F.concat(F.lit("error ("), fetch_error, F.lit(") — assumed live"))))
        .when(status.isin(*DEAD_STATUS) | ~status.isin(*ALIVE_STATUS), say(False, http))
        .when(phrase.isNotNull(),
              say(False, F.concat(F.lit("page says: '"), phrase, F.lit("'"))))
        .when(unlisted, say(False, "greenhouse: is_listed=false"))
        .when(closed, say(False, F.concat(F.lit("ashby status: "), ashby)))
        .otherwise(say(True, "live")))


def check(crawl: DataFrame, phrases=CLOSED_PHRASES) -> DataFrame:
    """url, is_live, reason for each crawled page."""
    when = [F.col("fetched_at")] if "fetched_at" in crawl.columns else []
    staged = crawl.select("url", "status", "body", "fetch_error", *when,
                          url_host(F.col("url")).alias("_host"),
                          F.lower(F.coalesce("body", F.lit(""))).alias("_low"))
    v = verdict(F.col("url"), F.col("status"), F.col("body"), F.col("fetch_error"),
                F.col("_host"), F.col("_low"), phrases)
    return staged.select("url", *when, v.alias("v")).select("url", *when, "v.is_live", "v.reason")


def verify(jobs: DataFrame, crawl: DataFrame, phrases=CLOSED_PHRASES,
           observe=None) -> DataFrame:
    """Postings not known to be closed; a posting whose page was not crawled is kept.

    Pages are reduced to one verdict per url before the join: the newest by ``fetched_at``, if
    the crawl has such a column, and a live one where several are equally new. ``observe`` (an
    Observation) receives live and removed counts while the result is written.
    """
    checked = check(crawl, phrases)
    newest = F.lit("") if "fetched_at" not in checked.columns else F.coalesce(
        F.col("fetched_at").cast("string"), F.lit(""))
    verdicts = checked.groupBy("url").agg(
        F.max_by("is_live", F.struct(newest, "is_live")).alias("_live"))
    judged = jobs.join(verdicts, "url", "left").withColumn(
        "_live", F.coalesce("_live", F.lit(True)))
    if observe is not None:
        judged = judged.observe(observe, F.count("*").alias("raw_count"),
                                F.count_if("_live").alias("live_count"),
                                F.count_if(~F.col("_live")).alias("removed_count"))
    return judged.where("_live").drop("_live")
