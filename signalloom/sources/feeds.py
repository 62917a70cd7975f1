"""Postings of job feeds and search services."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas as T
from ..functions import text as X
from ..functions.names import employer_from_url
from ..lexicon import (FEED_PATTERNS, PERK_LEXICON, PLATFORM_SLUGS, PLATFORM_SLUGS_CRAWL,
                       Lexicon)
from ..operators import bloom
from ..session import stored
from .base import items, or_blank, recent, to_jobs


def job_board(frame: DataFrame, number: int = 6, lexicon: Lexicon = PERK_LEXICON,
              wanted=None) -> DataFrame:
    """Rows of a job-board export; "nan" reads as blank, the site names the source."""
    def known(name: str) -> Column:
        return F.when(~or_blank(name).isin("", "nan"), F.col(name))
    site = X.first_nonblank("site", default="JobSpy")
    frame = frame.withColumn("pos", F.lit(0))
    return to_jobs(
        frame, number, source=F.concat(F.lit("JobSpy/"), X.title_case(site)),
        company=F.col("company_name"), title=F.col("title"), body=F.col("description"),
        url=F.col("job_url"), location=F.concat_ws(", ", known("city"), known("state")),
        date_posted=F.when(~or_blank("date_posted").isin("nan", "None"),
                           X.iso_prefix(F.col("date_posted"))),
        remote=F.when(F.col("is_remote"), "Remote").otherwise("On-site"),
        placed=lambda text: F.concat_ws(" ", "location", text, "title"),
        lexicon=lexicon, wanted=wanted)


def network_items(landed: DataFrame, number: int = 7, lexicon: Lexicon = PERK_LEXICON,
                  wanted=None) -> DataFrame:
    """Dataset items of a professional network, with many spellings per field.

    Without a lexicon hit the search term counts if the text holds it.
    """
    def first(*names: str) -> Column:
        return X.first_nonblank(*[f"job.{n}" for n in names])
    remote = (F.coalesce("job.workRemoteAllowed", F.lit(False))
              | F.contains(F.lower(or_blank("job.workplaceTypes")), F.lit("remote")))
    return to_jobs(
        items(landed, T.LINKEDIN, ""), number, source="Apify/LinkedIn",
        company=first("companyName", "company"), title=first("title", "jobTitle"),
        body=first("descriptionText", "descriptionHtml", "description", "jobDescription",
                   "body"),
        url=first("applyUrl", "link", "jobUrl", "url"), location=F.col("job.location"),
        date_posted=X.iso_prefix(first("postedAt", "datePosted")),
        remote=F.when(remote, "Remote").otherwise("On-site"),
        placed=lambda text: F.concat_ws(" ", "location", text),
        fallback=lambda text: F.when(F.contains(text, F.lower("term")), F.array("term"))
        .otherwise(F.array().cast("array<string>")),
        lexicon=lexicon, wanted=wanted)


def _by_url(jobs: DataFrame, number: int, source: str, body: Column, title: Column,
            date_posted: Column | None, reject: tuple[str, ...], lexicon: Lexicon,
            wanted) -> DataFrame:
    """Search results whose employer is read from the url; others are no postings."""
    employer = employer_from_url(or_blank("job.url"), reject)
    return to_jobs(
        jobs, number, source=source, company=employer, title=title, body=body,
        url=F.col("job.url"), date_posted=date_posted, remote=F.lit("Unknown"),
        keep=employer != "", need_text=True,
        placed=lambda text: F.concat_ws(" ", text, "title", "url"),
        lexicon=lexicon, wanted=wanted)


def web_search(landed: DataFrame, number: int = 9, lexicon: Lexicon = PERK_LEXICON,
               wanted=None) -> DataFrame:
    return _by_url(items(landed, T.EXA, "results"), number, "Exa", F.col("job.text"),
                   F.col("job.title"), X.iso_prefix(F.col("job.publishedDate")),
                   PLATFORM_SLUGS, lexicon, wanted)


def crawl_search(landed: DataFrame, number: int = 10, lexicon: Lexicon = PERK_LEXICON,
                 wanted=None) -> DataFrame:
    return _by_url(items(landed, T.FIRECRAWL, "data"), number, "Firecrawl",
                   F.col("job.markdown"), F.col("job.metadata.title"), None,
                   PLATFORM_SLUGS_CRAWL, lexicon, wanted)


def targeted_search(landed: DataFrame, number: int = 21,
                    lexicon: Lexicon = PERK_LEXICON) -> DataFrame:
    """Search results per account (``company``, ``domain``); urls are distinct per account."""
    return to_jobs(
        items(landed, T.EXA, "results"), number, source="Targeted-Exa",
        company=F.col("company"), title=F.col("job.title"), body=F.col("job.text"),
        url=F.col("job.url"), date_posted=X.iso_prefix(F.col("job.publishedDate")),
        lexicon=lexicon, by=("domain",))


def _of_accounts(jobs: DataFrame, domains: DataFrame | None):
    """Jobs that may be of the given domains, told by a filter before any text is read, and the sift
    that keeps those that are among their narrow rows. No domains keep all (discovery)."""
    if domains is None:
        return jobs, None
    wanted = stored(domains.select(F.col("domain").alias("_by_job_domain")).distinct(), "domains")
    n = wanted.count()
    jobs = bloom.may_hold(jobs, "job_domain", bloom.build(wanted, "_by_job_domain", n), n)
    # the account's domain is no part of the deduplication key
    return jobs, lambda rows: rows.join(wanted, "_by_job_domain", "left_semi").withColumn(
        "_by_job_domain", F.lit(""))


def _feed(jobs: DataFrame, today, max_age_days, country) -> DataFrame:
    return jobs if today is None else recent(jobs, "day", today, max_age_days, country)


def job_feed(landed: DataFrame, domains: DataFrame | None = None, number: int = 11,
             lexicon: Lexicon = PERK_LEXICON, patterns: tuple[str, ...] = FEED_PATTERNS,
             today: Column | None = None, max_age_days: int = 7,
             country: str | None = None) -> DataFrame:
    """Vendor feed: account monitor with ``domains``, discovery without.

    Title and description are matched, first by the lexicon, then by the pattern list.
    ``today`` applies the age and country restriction the vendor would apply.
    """
    jobs = items(landed, T.THEIRSTACK, "data").withColumns({
        "job_domain": F.lower(F.trim(or_blank("job.company_domain"))),
        "day": X.first_nonblank("job.date_posted", "job.discovered_at"),
        "country": F.col("job.country_code")})
    jobs, sift = _of_accounts(_feed(jobs, today, max_age_days, country), domains)
    title = F.trim(or_blank("job.job_title"))
    return to_jobs(
        jobs, number, source="TheirStack" if domains is not None else "TheirStack-Discovery",
        company=F.trim(X.first_nonblank("job.company_object.name", "job_domain")),
        title=title, body=F.col("job.description"), url=F.trim("job.url"),
        location=F.trim(X.first_nonblank("job.short_location", "job.long_location")),
        date_posted=X.iso_prefix(F.col("day")),
        remote=F.when(F.col("job.remote"), "Remote"), domain=F.col("job_domain"),
        searched=lambda text: F.concat_ws(" ", "title", text),
        fallback=lambda _: X.substring_hits("text_lc", patterns), lexicon=lexicon,
        by=("job_domain",) if domains is not None else (), sift=sift)


def organisation_feed(landed: DataFrame, domains: DataFrame | None = None, number: int = 12,
                      lexicon: Lexicon = PERK_LEXICON, today: Column | None = None,
                      max_age_days: int = 7, country: str | None = None) -> DataFrame:
    """Second vendor feed, with organisation_* fields; same two modes."""
    jobs = items(landed, T.SUMBLE, "jobs").withColumns({
        "job_domain": F.lower(F.trim(or_blank("job.organization_domain"))),
        "day": or_blank("job.datetime_pulled"), "country": F.col("job.country_code")})
    jobs, sift = _of_accounts(_feed(jobs, today, max_age_days, country), domains)
    return to_jobs(
        jobs, number, source="Sumble" if domains is not None else "Sumble-Discovery",
        company=F.trim(X.first_nonblank("job.organization_name", "job_domain")),
        title=F.trim(or_blank("job.job_title")), body=F.col("job.description"),
        url=F.trim("job.url"), location=F.trim(or_blank("job.location")),
        date_posted=X.iso_prefix(F.col("day")), domain=F.col("job_domain"),
        searched=lambda text: F.concat_ws(" ", "title", text), lexicon=lexicon,
        by=("job_domain",) if domains is not None else (), sift=sift)
