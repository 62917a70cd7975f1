"""Postings of applicant-tracking boards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas as T
from ..functions import text as X
from ..lexicon import PERK_LEXICON, Lexicon
from .base import items, landed_texts, or_blank, to_jobs


def _slug_name() -> Column:
    return X.title_case(F.replace(or_blank("slug"), F.lit("-"), F.lit(" ")))


def _location_and(text: Column) -> Column:
    return F.concat_ws(" ", F.col("location"), text)


def _lever_body(job: Column) -> Column:
    lists = F.array_join(F.transform(job["lists"], lambda x: x["content"]), " ")
    return F.concat_ws(" ", job["descriptionPlain"], lists, job["additional"])


def _ashby_body(job: Column) -> Column:
    sections = F.array_join(F.transform(job["descriptionSections"], lambda x: x["content"]), " ")
    html = X.first_nonblank(job["descriptionHtml"], job["descriptionPlain"])
    return F.concat_ws(" ", html, sections)


def _on_site_flag(job: Column) -> Column:
    return F.when(job["isRemote"], "Remote").otherwise("On-site")


def greenhouse(landed: DataFrame, number: int = 0, lexicon: Lexicon = PERK_LEXICON,
               wanted=None) -> DataFrame:
    """Board payloads: jobs[] with HTML content; the company is the board's slug."""
    return to_jobs(
        items(landed, T.GREENHOUSE, "jobs"), number, source="Greenhouse",
        company=_slug_name(), title=F.col("job.title"), body=F.col("job.content"),
        url=F.col("job.absolute_url"), location=F.col("job.location.name"),
        date_posted=X.iso_prefix(F.col("job.updated_at")),
        remote=lambda text: X.infer_remote(F.col("location"), text, remote_in_second=False),
        placed=_location_and, lexicon=lexicon, wanted=wanted, dedup="none")


def lever(landed: DataFrame, number: int = 1, lexicon: Lexicon = PERK_LEXICON,
          wanted=None) -> DataFrame:
    """A JSON array of postings in plain text."""
    return to_jobs(
        items(landed, T.LEVER, ""), number, source="Lever",
        company=F.coalesce("job.company", _slug_name()), title=F.col("job.text"),
        body=_lever_body(F.col("job")), url=F.col("job.hostedUrl"),
        location=F.col("job.categories.location"),
        date_posted=X.millis_to_date(F.col("job.createdAt")),
        remote=X.infer_remote(F.col("job.categories.location"),
                              F.col("job.categories.commitment")),
        placed=_location_and, lexicon=lexicon, wanted=wanted, dedup="none")


def ashby(landed: DataFrame, number: int = 2, lexicon: Lexicon = PERK_LEXICON,
          wanted=None) -> DataFrame:
    """jobs[] or, in older payloads, jobPostings[]."""
    return to_jobs(
        items(landed, T.ASHBY, "jobs", "jobPostings"), number, source="Ashby",
        company=F.coalesce("job.companyName", _slug_name()), title=F.col("job.title"),
        body=_ashby_body(F.col("job")), url=F.col("job.jobUrl"), location=F.col("job.location"),
        date_posted=X.iso_prefix(F.col("job.publishedAt")), remote=_on_site_flag(F.col("job")),
        placed=_location_and, lexicon=lexicon, wanted=wanted, dedup="none")


def workday(lists: DataFrame, details: DataFrame, number: int = 4,
            lexicon: Lexicon = PERK_LEXICON) -> DataFrame:
    """Search pages joined with the landed detail of each posting.

    ``lists.url`` is the public site of the board; ``details.url`` the posting's public url.
    A posting without a landed detail has no text and so no match; of several details the one
    that landed last counts. Texts are matched before the join, which sees none.
    """
    read = F.col("_p") if "_p" in details.columns else F.from_json("payload", T.WORKDAY_DETAIL)
    detail = read["jobPostingInfo"]["jobDescription"]
    matched = to_jobs(landed_texts(details), number, source="Workday", company=F.lit(""),
                      title=F.lit(""), body=detail, url=F.col("url"), lexicon=lexicon,
                      dedup="last")
    place = F.col("job.locationsText")
    listed = items(lists, T.WORKDAY_LIST, "jobPostings").select(
        F.concat("url", or_blank("job.externalPath")).alias("url"),
        or_blank("company").alias("company"), or_blank("job.title").alias("title"),
        F.coalesce(place, F.lit("")).alias("location"), X.infer_remote(place).alias("remote"),
        F.struct(F.lit(number).alias("source_no"), "seq", "pos").alias("ingest_seq"))
    return matched.drop("company", "title", "location", "remote", "ingest_seq").join(
        listed, "url").select(*T.JOB_COLUMNS, "ingest_seq")


def account_boards(landed: DataFrame, resolved: DataFrame, number: int = 13,
                   lexicon: Lexicon = PERK_LEXICON) -> DataFrame:
    """Boards of accounts whose system is known, under the account's name and domain.

    ``landed`` carries ats_type and slug; ``resolved`` comes from ats.resolve.
    """
    accounts = (resolved.where("ats_slug <> ''")
                .select("ats_type", F.col("ats_slug").alias("slug"),
                        X.first_nonblank("name", "domain_key").alias("account_name"),
                        F.col("domain_key").alias("account_domain")))
    def entries(kind: str, schema: str, paths: tuple[str, ...], **fields) -> Column:
        """A board's postings with the fields that all kinds share; null for boards of other kinds."""
        read = F.from_json(F.when(F.col("ats_type") == kind, F.col("payload")), schema)
        lists = F.coalesce(*[F.when(F.size(x) > 0, x) for x in (read[p] if p else read for p in paths)])
        return F.transform(lists, lambda job: F.struct(*[
            F.coalesce(fields[n](job) if n in fields else F.lit(""), F.lit("")).alias(n)
            for n in ("title", "body", "url", "location", "date_posted", "remote")]))

    greenhouse_ = entries(
        "greenhouse", T.GREENHOUSE, ("jobs",), title=lambda j: j["title"], body=lambda j: j["content"],
        url=lambda j: j["absolute_url"], location=lambda j: j["location"]["name"],
        date_posted=lambda j: X.iso_prefix(j["updated_at"]))
    lever_ = entries(
        "lever", T.LEVER, ("",), title=lambda j: j["text"], body=_lever_body, url=lambda j: j["hostedUrl"],
        location=lambda j: j["categories"]["location"], date_posted=lambda j: X.millis_to_date(j["createdAt"]))
    ashby_ = entries(
        "ashby", T.ASHBY, ("jobs", "jobPostings"), title=lambda j: j["title"], body=_ashby_body,
        url=lambda j: j["jobUrl"], location=lambda j: j["location"],
        date_posted=lambda j: X.iso_prefix(j["publishedAt"]), remote=_on_site_flag)
    # One scan: each payload is parsed as the kind it is.
    jobs = landed.select("ats_type", "slug", "seq", F.posexplode(F.coalesce(greenhouse_, lever_, ashby_)).alias("pos", "job"))
    matched = to_jobs(
        jobs, number, source=F.concat(F.lit("Domain-"), F.initcap("ats_type")), company=F.col("slug"),
        title=F.col("job.title"), body=F.col("job.body"), url=F.col("job.url"), location=F.col("job.location"),
        date_posted=F.col("job.date_posted"), remote=F.col("job.remote"), domain=F.col("ats_type"), lexicon=lexicon,
        dedup="none")
    # Only matched, narrow rows meet the accounts.
    matched = matched.withColumnsRenamed({"company": "slug", "_domain": "ats_type"}).join(accounts, ["ats_type", "slug"])
    return first_url_or_blank(matched.withColumns(
        {"company": F.trim("account_name"), "_domain": F.col("account_domain")})
        .select(*T.JOB_COLUMNS, "ingest_seq"))


def first_url_or_blank(jobs: DataFrame) -> DataFrame:
    """First row per url; rows without a url all stay."""
    from ..operators.dedup import first_wins
    own = F.when(F.col("url") == "", F.struct("ingest_seq"))  # a row without url is its own group
    return first_wins(jobs.withColumn("_own", own), ["url", "_own"], "ingest_seq").drop("_own")


# How each board's page links to its postings, before and after the board's slug.
BOARD_LINKS = {
    "greenhouse": (r'href="(https://(?:boards|job-boards)\.greenhouse\.io/', r'/jobs/\d+)"'),
    "lever": (r'href="(https://jobs\.lever\.co/', r'/[a-f0-9-]{36})"'),
    "ashby": (r'href="(/jobs/', r'/[^"]+)"'),
}
BOARD_SOURCES = {"greenhouse": "Targeted-Greenhouse", "lever": "Targeted-Lever",
                 "ashby": "Targeted-Ashby"}


def board_links(boards: DataFrame, first: int | None = None) -> DataFrame:
    """Posting urls on board pages (ats_type, slug, company, url, payload).

    All links of a board are followed, each url once; ``first`` limits how many.
    """
    quoted = F.concat(F.lit("\\Q"), F.col("slug"), F.lit("\\E"))
    links = F.lit(None).cast("array<string>")
    for kind, (before, after) in BOARD_LINKS.items():
        regex = F.concat(F.lit(before), quoted, F.lit(after))
        links = F.when(F.col("ats_type") == kind,
                       F.regexp_extract_all("payload", regex, F.lit(1))).otherwise(links)
    if first is not None:
        links = F.slice(links, 1, first)
    base = F.when(F.col("ats_type") == "ashby", "https://jobs.ashby.com").otherwise("")
    return (boards.select("ats_type", "slug", "company", "seq",
                          F.posexplode(F.array_distinct(links)).alias("pos", "link"))
            .withColumn("url", F.concat(base, "link")).drop("link"))


def targeted_boards(boards: DataFrame, pages: DataFrame, today: str, number: int = 20,
                    first: int | None = None, lexicon: Lexicon = PERK_LEXICON) -> DataFrame:
    """Postings behind the links of board pages, joined with their landed HTML by url.

    The page that landed last counts; it is matched before the join, which sees no text.
    """
    html = F.col("payload")
    matched = to_jobs(landed_texts(pages), number, source="", company=F.lit(""),
                      title=X.page_title(html), body=html, url=F.col("url"),
                      date_posted=F.lit(today), lexicon=lexicon, dedup="last")
    source = F.lit("")
    for kind, label in BOARD_SOURCES.items():
        source = F.when(F.col("ats_type") == kind, label).otherwise(source)
    links = board_links(boards, first).select(
        "url", or_blank("company").alias("company"), source.alias("source"),
        F.struct(F.lit(number).alias("source_no"), "seq", "pos").alias("ingest_seq"))
    return matched.drop("company", "source", "ingest_seq").join(links, "url").select(
        *T.JOB_COLUMNS, "ingest_seq")
