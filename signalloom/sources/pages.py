"""Postings of search and benefit pages with embedded page state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas as T
from ..functions import text as X
from ..lexicon import BENEFIT_LABELS, PERK_LEXICON, Lexicon
from ..operators.dedup import first_wins
from ..schemas import JOB_COLUMNS
from .base import explode_first, or_blank, to_jobs
from .cards import with_job_cards

_REVIEWS = "https://www.glassdoor.com"


def _with_state(landed: DataFrame, schema: str) -> DataFrame:
    if "_p" in landed.columns:  # parsed before, to count its rejects
        return landed
    return landed.withColumn("_p", F.from_json(X.page_state(F.col("payload")), schema))


def benefit_employers(landed: DataFrame, labels=BENEFIT_LABELS) -> DataFrame:
    """employer_id, name, benefit_label, detail_url from benefit pages.

    ``search_term`` is the benefit label. Page state is read where it parses, else links of
    the form ...-E<id>.htm. An employer on several pages takes the first label of ``labels``.
    """
    state = _with_state(landed, T.BENEFIT_PAGE)
    stated = F.transform(
        _first_list("_p.props.pageProps.employers", "_p.props.pageProps.benefitsData.employers"),
        lambda j: F.struct(_first(j, "employerId", "id").alias("employer_id"),
                           _first(j, "employerName", "name").alias("name"),
                           F.coalesce(j["detailUrl"], F.lit("")).alias("detail_url"), F.lit(None).cast("string").alias("link")))
    anchor = r'(?s)<a\b[^>]*href="[^"]*/Benefits/[^"]*-E\d+\.htm[^"]*"[^>]*>.*?</a>'

    def from_link(a: Column) -> Column:
        href = F.regexp_extract(a, 'href="([^"]*)"', 1)
        return F.struct(F.regexp_extract(href, r"-E(\d+)\.htm", 1).alias("employer_id"), F.lit("").alias("name"),
                        F.concat(F.lit(_REVIEWS), href).alias("detail_url"), a.alias("link"))
    links = F.transform(F.regexp_extract_all(
        F.when(F.col("_p.props").isNull(), F.col("payload")), F.lit(anchor), F.lit(0)), from_link)
    # One scan: a page gives what its state lists, or else its links.
    read = state.select("search_term", "seq", F.posexplode(F.coalesce(stated, links)).alias("pos", "e"))
    read = X.with_clean_text(read.withColumn("link", F.col("e.link")), F.col("link"), "linked")
    found = read.select(
        "e.employer_id", F.when(F.col("link").isNull(), F.col("e.name")).otherwise(F.col("linked")).alias("name"),
        F.col("search_term").alias("benefit_label"), "e.detail_url", "seq", "pos")
    rank = F.coalesce(F.array_position(F.array(*[F.lit(x) for x in labels]),
                                       F.col("benefit_label")), F.lit(0))
    found = found.where("employer_id <> ''").withColumn("_o", F.struct(rank, "seq", "pos"))
    return first_wins(found, ["employer_id"], "_o").drop("_o", "seq", "pos")


def benefit_jobs(employers: DataFrame, landed: DataFrame, number: int = 5,
                 wanted=None) -> DataFrame:
    """Open roles of those employers; ``landed.slug`` is the employer id.

    The matched keyword is the benefit label. A page without readable state still yields
    one row that points at all open roles.
    """
    pages = (_with_state(landed, T.EMPLOYER_PAGE)
             .select(F.col("slug").alias("employer_id"), "url", "seq",
                     F.col("_p.props").isNotNull().alias("readable"),
                     F.col("_p.props.pageProps.jobListings.jobListings").alias("jobs")))
    listed = (employers.join(pages, "employer_id")
              .select("*", F.posexplode_outer("jobs").alias("pos", "job")))
    title, location = or_blank("job.jobTitle"), or_blank("job.location")
    roles = listed.where("readable and job is not null").where(X.in_location(location, wanted))
    roles = roles.select(
        "name", "benefit_label", title.alias("title"), location.alias("location"),
        F.concat(F.lit(_REVIEWS), or_blank("job.jobLink")).alias("url"),
        or_blank("job.listingAge").alias("date_posted"),
        X.infer_remote(location).alias("remote"), "seq", "pos")
    stubs = listed.where("not readable and trim(name) <> ''").select(
        "name", "benefit_label", F.lit("(see all open roles)").alias("title"),
        F.lit("").alias("location"), "url", F.lit("").alias("date_posted"),
        F.lit("").alias("remote"), "seq", F.lit(0).alias("pos"))
    both = roles.unionByName(stubs)
    note = F.concat(F.lit("Company lists '"), F.col("benefit_label"),
                    F.lit("' as a verified benefit on Glassdoor (employee-reported)"))
    return both.select(
        F.lit("Glassdoor Benefits").alias("source"), F.col("name").alias("company"), "title",
        "location", "remote", F.col("benefit_label").alias("food_keywords_matched"),
        F.lit(1).alias("keyword_count"), note.alias("perk_excerpt"), "date_posted", "url",
        F.lit("").alias("_domain"),
        F.struct(F.lit(number).alias("source_no"), "seq", "pos").alias("ingest_seq")
    ).select(*JOB_COLUMNS, "ingest_seq")


def _found_via(name: str):
    return F.concat(F.lit(f"Found via {name} search for '"), F.col("search_term"), F.lit("'"))


def _term(_text):
    return F.array("term")


# What a posting on a search page has, wherever on it it stands.
_FOUND = ("url", "title", "company", "location", "body", "date_posted")


def _first_list(*paths: str) -> Column:
    """The first of the lists that has entries."""
    return F.coalesce(*[F.when(F.size(p) > 0, F.col(p)) for p in paths])


def _listed(jobs: Column, **fields) -> Column:
    """A list of postings with the fields of _FOUND, each a function of the entry."""
    return F.transform(jobs, lambda job: F.struct(*[
        F.coalesce(fields[name](job), F.lit("")).alias(name) for name in _FOUND]))


def _first(job: Column, *names: str) -> Column:
    return X.first_nonblank(*[job[n] for n in names])


def _found(pages: DataFrame, listed: Column, page: Column, *kept: str) -> DataFrame:
    """One row (kept columns, seq, pos, and those of _FOUND) per posting of ``listed``, or else per card of ``page``.

    The table is read once: pages that list postings pass the card reader as nulls.
    """
    rows = with_job_cards(pages.select(*kept, "seq", listed.alias("_listed"), page.alias("_page")), "_page")
    rows = rows.drop("_page").select("*", F.posexplode_outer("_listed").alias("_pos", "job")).drop("_listed")
    card = {name: F.col(f"card_{name}") if name in ("url", "title", "company", "location") else F.lit("")
            for name in _FOUND}
    by_card = F.col("job").isNull()
    return rows.where("job is not null or card_url <> ''").select(
        *kept, "seq", F.coalesce("_pos", "card_pos").alias("pos"), by_card.alias("by_card"),
        *[F.when(by_card, card[n]).otherwise(F.col(f"job.{n}")).alias(n) for n in _FOUND])


def search_pages(landed: DataFrame, number: int = 3, lexicon: Lexicon = PERK_LEXICON,
                 wanted=None, site: str = "https://builtin.com") -> DataFrame:
    """Search pages: state jobs[] or jobListings[], else job cards.

    The search term stands in where the text holds no lexicon term.
    """
    state = _with_state(landed, T.SEARCH_PAGE)
    listed = _listed(
        _first_list("_p.props.pageProps.jobs", "_p.props.pageProps.jobListings"),
        url=lambda j: _first(j, "url", "jobUrl", "applyUrl"), title=lambda j: _first(j, "title", "jobTitle"),
        company=lambda j: F.when(F.startswith(j["company"], F.lit("{")),
                                 F.get_json_object(j["company"], "$.name")).otherwise(j["company"]),
        location=lambda j: _first(j, "location", "locationName"),
        body=lambda j: _first(j, "description", "body"), date_posted=lambda j: X.iso_prefix(j["datePosted"]))
    page = F.when(F.col("_p.props").isNull(), F.col("payload"))
    found = _found(state, listed, page, "search_term")
    whole = F.startswith("url", F.lit("http")) | ~F.col("by_card")
    found = found.withColumn("url", F.when(whole, F.col("url")).otherwise(F.concat(F.lit(site), "url")))
    return to_jobs(
        found, number, source="Built In", company=F.col("company"),
        title=F.col("title"), body=F.col("body"), url=F.col("url"),
        location=F.col("location"), date_posted=F.col("date_posted"),
        placed=lambda text: F.concat_ws(" ", "location", text), fallback=_term,
        when_empty=_found_via("Built In"), lexicon=lexicon, wanted=wanted)


def startup_search(landed: DataFrame, number: int = 8, lexicon: Lexicon = PERK_LEXICON,
                   wanted=None) -> DataFrame:
    """Search results as API JSON; pages of a term count only if its API gave nothing.

    Pages are read from their state, else from job cards. The search term is always trusted.
    """
    is_api = F.startswith(F.trim("payload"), F.lit("{"))
    edges = F.from_json(F.when(is_api, F.col("payload")), T.WELLFOUND)["data"]["talent"]["jobListings"]["edges"]
    # Terms that the API answered: a narrow scan of its own, before any text is looked at.
    answered = landed.select(F.col("search_term").alias("_by_search_term"), edges.alias("e")).where(
        F.size("e") > 0).select("_by_search_term", F.lit(True).alias("_answered")).distinct()

    pages = _with_state(landed, T.WELLFOUND_PAGE).withColumn("_edges", edges)
    of_api = _listed(
        _first_list("_edges"), url=lambda j: j["node"]["jobUrl"], title=lambda j: j["node"]["title"],
        company=lambda j: j["node"]["startup"]["name"],
        location=lambda j: F.array_join(j["node"]["locationNames"], ", "), body=lambda j: j["node"]["description"],
        date_posted=lambda j: X.iso_prefix(j["node"]["postedAt"]))
    of_page = _listed(
        _first_list("_p.props.pageProps.jobListings"), url=lambda j: j["jobUrl"], title=lambda j: j["title"],
        company=lambda j: j["companyName"], location=lambda j: j["locationName"], body=lambda j: j["description"],
        date_posted=lambda j: F.lit(""))
    page = F.when(F.col("_p.props").isNull() & ~is_api, F.col("payload"))
    pages = pages.withColumn("from_page", of_api.isNull())
    rows = _found(pages, F.coalesce(of_api, of_page), page, "search_term", "from_page").where(
        "not by_card or title <> ''")
    rows = rows.withColumns({
        "url": F.when(F.col("by_card"), F.concat(F.lit("https://wellfound.com"), "url")).otherwise(F.col("url")),
        "location": F.when(F.col("by_card"), "").otherwise(F.col("location"))})

    def sift(narrow: DataFrame) -> DataFrame:
        """Narrow rows without those of pages whose term the API answered."""
        kept = narrow.join(answered, "_by_search_term", "left").where(
            "not _by_from_page or _answered is null").drop("_answered")
        return kept.withColumns({"_by_search_term": F.lit(""), "_by_from_page": F.lit(False)})
    return to_jobs(
        rows, number, source="Wellfound", company=F.col("company"), title=F.col("title"),
        body=F.col("body"), url=F.col("url"), location=F.col("location"),
        date_posted=F.col("date_posted"),
        remote=lambda text: X.infer_remote(F.col("location"), text),
        placed=lambda text: F.concat_ws(" ", "location", text), fallback=_term,
        when_empty=_found_via("Wellfound"), lexicon=lexicon, wanted=wanted,
        by=("search_term", "from_page"), sift=sift)
