"""Queries of the source normalisers: payloads are built from documents, then read back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..operators import accounts as A
from ..schemas import JOB_COLUMNS
from ..sources import boards, feeds, pages
from ..session import shared_folder
from ..sources.base import preview, read_days, write_landed
from ..sources.registry import SOURCES, read_sources
from ..sources.rejects import reject_report
from . import sql as Q
from .data import LEXICON, documents, landed, supplier_accounts

def _id():
    return F.substring(F.md5("text"), 1, 10)


def _html():
    return F.concat(F.lit("<p>"), "text", F.lit(" &amp; more</p>"))


def _docs(spark, sf):
    """Documents with an id shared by exact copies, a search term and a path."""
    return documents(spark, sf).withColumns({
        "id": _id(), "term": F.when(F.col("lang") == "en", "ering").otherwise("Rien"),
        "path": F.concat(F.lit("/jobs/"), _id())})


def _landed(spark, sf, payload, **columns):
    d = _docs(spark, sf)
    return landed(d, payload, "doc_id", **columns)


def _json(**fields):
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))


def _list(**fields):
    return F.array(F.struct(*[c.alias(n) for n, c in fields.items()]))


def _jobs(jobs):
    return jobs.select(*[c for c in JOB_COLUMNS if c != "keyword_count"],
                       F.col("keyword_count").cast("long").alias("keyword_count"))


def _greenhouse(spark, sf):
    payload = _json(jobs=_list(
        title=F.col("title"), content=_html(), absolute_url=F.col("url"),
        updated_at=F.concat("day", F.lit("T10:00:00Z")),
        location=F.struct(F.col("place").alias("name"))))
    return _landed(spark, sf, payload, slug=F.concat(F.lit("acme-"), "slug"))


def _lever(spark, sf):
    millis = F.unix_date(F.col("day").cast("date")).cast("long") * 86400000 + 3600000
    payload = F.to_json(_list(
        text=F.col("title"), hostedUrl=F.col("url"), createdAt=millis,
        descriptionPlain=F.lit("About"),
        lists=F.array(F.struct(F.lit("<li>We</li>").alias("content")),
                      F.struct(F.col("text").alias("content"))),
        categories=F.struct(F.col("place").alias("location"),
                            F.when(F.col("lang") == "fr", "Hybrid").when(
                                F.col("lang") == "es", "Remote ok").alias("commitment")),
        company=F.when(F.col("lang") == "de", F.upper("slug"))))
    return _landed(spark, sf, payload, slug=F.col("slug"))


def _ashby(spark, sf):
    def jobs():
        return _list(
            title=F.col("title"), companyName=F.when(F.col("lang") != "de", F.col("slug")),
            location=F.col("place"), jobUrl=F.col("url"), publishedAt=F.col("day"),
            isRemote=F.col("lang") == "fr",
            descriptionHtml=F.when(F.col("lang") == "es", "").otherwise(F.lit("<b>Hi</b>")),
            descriptionPlain=F.lit("Plain"),
            descriptionSections=F.array(F.struct(F.col("text").alias("content"))))
    old = F.col("lang") == "en"
    payload = F.when(old, _json(jobPostings=jobs())).otherwise(_json(jobs=jobs()))
    return _landed(spark, sf, payload, slug=F.concat(F.lit("b-"), "slug"))


_SITE = "https://t.wd1.myworkdayjobs.com/en-US/board"


def _workday(spark, sf):
    lists = _landed(spark, sf, _json(total=F.lit(1), jobPostings=_list(
        externalPath=F.col("path"), title=F.col("title"), locationsText=F.when(
            F.col("lang") == "fr", "Hybrid Lyon").otherwise(F.col("place")))),
        company=F.upper("slug"), url=F.lit(_SITE))
    d = _docs(spark, sf)
    detail = landed(d.where("lang <> 'de'"), _json(jobPostingInfo=F.struct(
        _html().alias("jobDescription"))), "doc_id", url=F.concat(F.lit(_SITE), "path"))
    return lists, detail


def _benefit_pages(spark, sf):
    """State pages for most languages, linked pages for Spanish ones."""
    employer = F.regexp_replace("slug", "src", "7")
    old = F.struct(F.array().cast("array<string>").alias("employers"), F.struct(_list(
        id=employer, name=F.upper("slug")).alias("employers")).alias("benefitsData"))
    new = F.struct(_list(employerId=employer, employerName=F.upper("slug"),
                         detailUrl=F.col("url")).alias("employers"))
    state = F.when(F.col("lang") == "en", F.to_json(F.struct(F.struct(
        old.alias("pageProps")).alias("props")))).otherwise(F.to_json(F.struct(F.struct(
            new.alias("pageProps")).alias("props"))))
    link = F.concat(F.lit('<p>x<a class="e" href="/Benefits/X-Benefits-E'), employer, F.lit(
        '.htm"> <b>'), F.upper("slug"), F.lit("</b></a>"), "text")
    page = F.when(F.col("lang") == "es", link).otherwise(F.concat(
        F.lit('<script id="__NEXT_DATA__" type="application/json">'), state, F.lit("</script>")))
    label = (F.when(F.col("lang") == "en", "Meal Plan or Allowance").when(
        F.col("lang") == "fr", "Stocked Kitchen").otherwise("Company Cafeteria"))
    return _landed(spark, sf, page, search_term=label)


def _employer_pages(spark, sf):
    state = F.to_json(F.struct(F.struct(F.struct(F.struct(_list(
        jobTitle=F.col("title"), location=F.col("place"), jobLink=F.col("path"),
        listingAge=F.col("day")).alias("jobListings")).alias("jobListings"))
        .alias("pageProps")).alias("props")))
    page = F.when(F.col("lang") == "de", F.col("text")).otherwise(F.concat(
        F.lit('<script id="__NEXT_DATA__">'), state, F.lit("</script>")))
    return _landed(spark, sf, page, slug=F.regexp_replace("slug", "src", "7"),
                   url=F.col("url"))


def _search_pages(spark, sf):
    """State under either name, and cards for German pages."""
    def jobs(name):
        return F.to_json(F.struct(F.struct(F.struct(_list(
            jobUrl=F.col("path"), title=F.col("title"), company=F.struct(F.col("slug").alias(
                "name")), locationName=F.col("place"), body=_html(), datePosted=F.col("day"))
            .alias(name)).alias("pageProps")).alias("props")))
    state = F.when(F.col("lang") == "en", jobs("jobs")).otherwise(jobs("jobListings"))
    card = F.concat(F.lit('<ul><li class="job-card x"><h3>'), "title", F.lit(
        '</h3><br><span class="company-name">'), "slug", F.lit(
        '</span><i class="loc location">'), "place", F.lit('</i><a href="'), "path",
        F.lit('">go</a></li></ul>'))
    page = F.when(F.col("lang") == "de", card).otherwise(F.concat(
        F.lit('<html><script id="__NEXT_DATA__">'), state, F.lit("</script>")))
    return _landed(spark, sf, page, search_term=F.col("term"))


def _job_board(spark, sf):
    d = _docs(spark, sf)
    return d.select(
        F.concat(F.lit("https://jobs.example"), "path").alias("job_url"),
        F.when(F.col("lang") == "fr", "nan").otherwise(F.lit("Lyon")).alias("city"),
        F.when(F.col("lang") == "de", F.lit(None)).otherwise(F.lit("ST")).alias("state"),
        F.col("slug").alias("company_name"), "title", F.col("text").alias("description"),
        F.when(F.col("lang") == "es", "google").when(F.col("lang") == "en", "indeed").alias(
            "site"), (F.col("lang") == "en").alias("is_remote"),
        F.when(F.col("lang") == "fr", "None").otherwise(F.col("day")).alias("date_posted"),
        F.col("doc_id").alias("seq"))


def _network(spark, sf):
    payload = F.to_json(_list(
        applyUrl=F.when(F.col("lang") == "en", ""), link=F.concat(F.lit("https://n"), "path"),
        company=F.col("slug"), jobTitle=F.col("title"), location=F.col("place"),
        descriptionText=F.lit(" "), body=_html(), datePosted=F.col("day"),
        workRemoteAllowed=F.when(F.col("lang") == "es", True),
        workplaceTypes=F.when(F.col("lang") == "fr", F.lit("Remote,On-site"))))
    return _landed(spark, sf, payload, search_term=F.col("term"))


def _startup(spark, sf):
    node = F.struct(F.col("path").alias("jobUrl"), "title", _html().alias("description"),
                    F.array("place", F.col("lang")).alias("locationNames"),
                    F.col("day").alias("postedAt"), F.struct(F.col("slug").alias("name"))
                    .alias("startup"))
    api = F.to_json(F.struct(F.struct(F.struct(F.struct(F.array(F.struct(node.alias(
        "node"))).alias("edges")).alias("jobListings")).alias("talent")).alias("data")))
    page = F.concat(F.lit('<script id="__NEXT_DATA__">'), F.to_json(F.struct(F.struct(F.struct(
        _list(jobUrl=F.col("path"), title=F.col("title"), description=F.lit(""),
              companyName=F.col("slug"), locationName=F.lit("Remote")).alias("jobListings"))
        .alias("pageProps")).alias("props"))), F.lit("</script>"))
    # Terms of English documents have API results, those of French ones only pages.
    payload = F.when(F.col("lang").isin("en", "es"), api).otherwise(page)
    term = F.when(F.col("lang").isin("en", "de"), "api term").otherwise(F.col("lang"))
    return _landed(spark, sf, payload, search_term=term)


def _by_url(spark, sf, crawl: bool):
    url = (F.when(F.col("lang") == "en", F.concat(F.lit("https://boards.greenhouse.io/"), "slug",
                                                  "path"))
           .when(F.col("lang") == "fr", F.concat(F.lit("https://jobs.lever.co/en/"), _id()))
           .when(F.col("lang") == "de", F.concat(F.lit("https://boards.bamboohr.com/"), _id()))
           .otherwise(F.concat(F.lit("https://jobs.ashbyhq.com/My_"), "slug", F.lit("/"), _id())))
    if crawl:
        payload = _json(data=_list(url=url, markdown=F.col("text"), metadata=F.struct(
            F.col("title").alias("title"))))
    else:
        payload = _json(results=_list(url=url, text=F.col("text"), title=F.col("title"),
                                      publishedDate=F.concat("day", F.lit("T00"))))
    return _landed(spark, sf, payload)


def _feed(spark, sf):
    payload = _json(data=_list(
        job_title=F.concat(F.lit(" "), "title"), url=F.concat(F.lit("https://f"), "path"),
        discovered_at=F.concat("day", F.lit("T01")), company_domain=F.concat(
            F.upper("slug"), F.lit(".com ")), company_object=F.struct(F.when(
                F.col("lang") != "fr", F.col("slug")).alias("name")),
        long_location=F.col("place"), description=_html(), remote=F.col("lang") == "es",
        country_code=F.when(F.col("lang") != "de", "US")))
    return _landed(spark, sf, payload)


def _organisation(spark, sf):
    payload = _json(jobs=_list(
        job_title=F.col("title"), url=F.concat(F.lit("https://o"), "path"),
        datetime_pulled=F.concat("day", F.lit(" 01:00")), organization_domain=F.concat(
            "slug", F.lit(".com")), organization_name=F.col("slug"), location=F.col("place"),
        description=_html(), country_code=F.lit("US")))
    return _landed(spark, sf, payload)


def _domains(spark, sf):
    """Normalised domains of managed suppliers."""
    accounts = supplier_accounts(spark, sf).where("list = 'managed'")
    return accounts.select(A.normalise_domain(F.col("domain")).alias("domain")).where(
        "domain <> ''")


def greenhouse_source(spark, sf):
    return _jobs(boards.greenhouse(_greenhouse(spark, sf), lexicon=LEXICON))


def lever_source(spark, sf):
    return _jobs(boards.lever(_lever(spark, sf), lexicon=LEXICON))


def ashby_source(spark, sf):
    return _jobs(boards.ashby(_ashby(spark, sf), lexicon=LEXICON))


def workday_source(spark, sf):
    return _jobs(boards.workday(*_workday(spark, sf), lexicon=LEXICON))


def benefit_employers(spark, sf):
    return pages.benefit_employers(_benefit_pages(spark, sf))


def benefit_source(spark, sf):
    employers = pages.benefit_employers(_benefit_pages(spark, sf))
    return _jobs(pages.benefit_jobs(employers, _employer_pages(spark, sf)))


def search_page_source(spark, sf):
    return _jobs(pages.search_pages(_search_pages(spark, sf), lexicon=LEXICON))


def job_board_source(spark, sf):
    return _jobs(feeds.job_board(_job_board(spark, sf), lexicon=LEXICON))


def network_source(spark, sf):
    return _jobs(feeds.network_items(_network(spark, sf), lexicon=LEXICON))


def startup_source(spark, sf):
    return _jobs(pages.startup_search(_startup(spark, sf), lexicon=LEXICON))


def web_search_source(spark, sf):
    return _jobs(feeds.web_search(_by_url(spark, sf, False), lexicon=LEXICON))


def crawl_search_source(spark, sf):
    return _jobs(feeds.crawl_search(_by_url(spark, sf, True), lexicon=LEXICON))


def feed_discovery_source(spark, sf):
    return _jobs(feeds.job_feed(_feed(spark, sf), lexicon=LEXICON, patterns=("erly", "ange"),
                                today=F.lit("2024-03-15").cast("date"), max_age_days=60,
                                country="US"))


def feed_monitor_source(spark, sf):
    return _jobs(feeds.job_feed(_feed(spark, sf), _domains(spark, sf), lexicon=LEXICON,
                                patterns=("erly", "ange")))


def organisation_monitor_source(spark, sf):
    return _jobs(feeds.organisation_feed(_organisation(spark, sf), _domains(spark, sf),
                                         lexicon=LEXICON))


def organisation_discovery_source(spark, sf):
    return _jobs(feeds.organisation_feed(
        _organisation(spark, sf), lexicon=LEXICON, today=F.lit("2024-02-05").cast("date"),
        max_age_days=20))


def _account_boards_input(spark, sf):
    """The three board shapes and supplier accounts known to use them."""
    kinds = (("greenhouse", _greenhouse), ("lever", _lever), ("ashby", _ashby))
    parts = [make(spark, sf).withColumn("ats_type", F.lit(kind))
             .withColumn("slug", F.regexp_replace("slug", "^(acme-|b-)", ""))
             for kind, make in kinds]
    payloads = parts[0].unionByName(parts[1]).unionByName(parts[2])
    s = A.with_key(supplier_accounts(spark, sf))
    kind = F.when(F.col("vertical") == "Technology", "greenhouse").when(
        F.col("vertical") == "Pharma", "ashby").otherwise("lever")
    resolved = s.select("name", "domain_key", kind.alias("ats_type"), F.concat(
        F.lit("src"), "zoominfo_id").alias("ats_slug"))
    return payloads, resolved


def account_board_source(spark, sf):
    """Boards of supplier accounts, under the accounts' names."""
    return _jobs(boards.account_boards(*_account_boards_input(spark, sf), lexicon=LEXICON))


def _boards(spark, sf):
    """One board page per document that links to its posting twice and to a stranger."""
    kind = F.when(F.col("lang") == "en", "greenhouse").when(
        F.col("lang") == "fr", "lever").otherwise("ashby")
    uuid = F.concat(F.substring(F.md5("text"), 1, 30), F.lit("-abcde"))
    link = (F.when(F.col("lang") == "en", F.concat(
        F.lit("https://job-boards.greenhouse.io/"), "slug", F.lit("/jobs/"), "doc_id"))
        .when(F.col("lang") == "fr", F.concat(F.lit("https://jobs.lever.co/"), "slug",
                                              F.lit("/"), uuid))
        .otherwise(F.concat(F.lit("/jobs/"), "slug", F.lit("/"), _id())))
    a = F.concat(F.lit('<a href="'), link, F.lit('">x</a>'))
    page = F.concat(F.lit('<a href="/jobs/stranger/1">y</a>'), a, F.lit(
        '<a href="https://jobs.lever.co/other/1">z</a>'), a)
    return _landed(spark, sf, page, slug=F.col("slug"), company=F.upper("slug"), ats_type=kind)


def board_links(spark, sf):
    return boards.board_links(_boards(spark, sf)).select("ats_type", "slug", "url", F.col(
        "seq").alias("doc_id"))


def targeted_board_source(spark, sf):
    links = boards.board_links(_boards(spark, sf))
    d = documents(spark, sf).select("doc_id", "text", "lang", "title")
    html = links.select("url", F.col("seq").alias("doc_id")).join(d, "doc_id").select(
        "url", F.concat(F.when(F.col("lang") == "de", "<TITLE> </TITLE>").otherwise(F.concat(
            F.lit("<title> "), "title", F.lit("</title>"))), F.lit("<p>"), "text").alias(
            "payload"))
    return _jobs(boards.targeted_boards(_boards(spark, sf), html, "2024-02-05",
                                        lexicon=LEXICON))


def targeted_search_source(spark, sf):
    payload = _json(results=_list(url=F.concat(F.lit("https://s"), "path"), text=F.col("text"),
                                  title=F.col("title"), publishedDate=F.col("day")))
    results = _landed(spark, sf, payload, company=F.upper("slug"), domain=F.col("slug"))
    return _jobs(feeds.targeted_search(results, lexicon=LEXICON))


def _inputs(spark, sf):
    one = lambda df: {"landed": df}
    return {"gh": one(_greenhouse(spark, sf)), "lv": one(_lever(spark, sf)),
            "ab": one(_ashby(spark, sf)), "js": {"frame": _job_board(spark, sf)},
            "ex": one(_by_url(spark, sf, False)), "sb": one(_organisation(spark, sf))}


def _totals(jobs):
    return jobs.groupBy("source", "location").agg(
        F.count("*").alias("postings"), F.sum("keyword_count").alias("keywords"))


def all_sources(spark, sf):
    """Selected registry sources in one union."""
    return _totals(read_sources(_inputs(spark, sf), ["gh", "ab", "js", "sb", "wd"], lexicon=LEXICON))


def _every_input(spark, sf):
    """Inputs of all fourteen registry keys."""
    one = lambda df: {"landed": df}
    lists, details = _workday(spark, sf)
    boards_, resolved = _account_boards_input(spark, sf)
    return {**_inputs(spark, sf), "bn": one(_search_pages(spark, sf)), "wd": {"lists": lists, "details": details},
            "gd": {"employers": pages.benefit_employers(_benefit_pages(spark, sf)), **one(_employer_pages(spark, sf))},
            "ap": one(_network(spark, sf)), "wf": one(_startup(spark, sf)), "fc": one(_by_url(spark, sf, True)),
            "ts": one(_feed(spark, sf)), "da": {"landed": boards_, "resolved": resolved}}


def every_source(spark, sf):
    """All registry sources in one union; the two feeds with monitors run as discovery."""
    jobs = read_sources(_every_input(spark, sf), lexicon=LEXICON, options={
        "ts": {"patterns": ("erly", "ange"), "today": F.lit("2024-03-15").cast("date"), "max_age_days": 60,
               "country": "US"},
        "sb": {"today": F.lit("2024-02-05").cast("date"), "max_age_days": 20}})
    return _totals(jobs)


# How a list of postings is named in the payloads that get damaged below; "" is a list at the top.
_DAMAGED = {("gh", "landed"): "jobs", ("lv", "landed"): "", ("ab", "landed"): "jobs", ("bn", "landed"): "state",
            ("wd", "lists"): "jobPostings", ("ex", "landed"): "results", ("fc", "landed"): "data",
            ("ts", "landed"): "data", ("sb", "landed"): "jobs"}
#: Kinds of damage by the first digit of a text's hash.
_KINDS = {"0": "truncated", "1": "blank", "2": "null", "3": "mistyped", "4": "error"}


def _broken(root: str, kind: str, id_: str) -> str:
    """SQL text, for either engine, of a damaged payload."""
    if kind in ("blank", "null"):
        return "'  '" if kind == "blank" else "CAST(NULL AS {string})"
    cut, wrong, error = {
        "": ("""'[{"text":"'""", """'[{"createdAt":"soon","text":"'""", """'{"error":"'"""),
        "state": ("""'{"props":{"pageProps":{"jobs":[{"title":"'""", """'{"props":{"pageProps":{"jobs":"'""",
                  """'{"props":{"pageProps":{"error":"'"""),
    }.get(root, ("'{\"%s\":[{\"title\":\"'" % root, "'{\"%s\":\"'" % root, """'{"error":"'"""))
    ends = {"": ("''", "'\"}]'", "'\"}'"), "state": ("''", "'\"}}}'", "'\"}}}'")}.get(root, ("''", "'\"}'", "'\"}'"))
    k = ("truncated", "mistyped", "error").index(kind)
    text = f"concat({(cut, wrong, error)[k]}, {id_}, {ends[k]})"
    if root == "state":
        text = f"""concat('<script id="__NEXT_DATA__">', {text}, '</script>')"""
    return text


def _damage(spark, sf, inputs):
    """The inputs with payloads of some documents replaced by damaged ones."""
    ids = documents(spark, sf).select(F.col("doc_id").alias("_doc"), F.md5("text").alias("_md5"))
    out = {key: dict(tables) for key, tables in inputs.items()}
    for (key, name), root in _DAMAGED.items():
        if key not in inputs:
            continue
        cases = " ".join("WHEN '%s' THEN %s" % (digit, _broken(root, kind, "substring(_md5, 1, 10)").replace(
            "{string}", "STRING")) for digit, kind in _KINDS.items())
        landed_ = out[key][name]
        out[key][name] = landed_.join(ids, F.col("seq") == F.col("_doc")).withColumn(
            "payload", F.expr(f"CASE substring(_md5, 1, 1) {cases} ELSE payload END")).drop("_doc", "_md5")
    return out


def _landed_days(spark, sf):
    """Two feeds, landed on the day of their posting or the day after."""
    path = shared_folder(spark, "landed-days")
    for source, landed_ in (("ts", _feed(spark, sf)), ("sb", _organisation(spark, sf))):
        days = documents(spark, sf).select(F.col("doc_id").alias("_doc"), F.date_add(
            F.col("day").cast("date"), (F.col("doc_id") % 2).cast("int")).alias("landed_on"))
        write_landed(landed_.join(days, F.col("seq") == F.col("_doc")).drop("seq", "_doc").withColumn(
            "source", F.lit(source)), path)
    return path


def recent_feed(spark, sf):
    """Postings of the last three days of a feed, from the folders of those days.

    Of copies with one url the first in a folder counts, so what tells them apart is left out.
    """
    today = date(2024, 1, 20)
    landed_ = read_days(spark, _landed_days(spark, sf), "ts", today, 3)
    return _jobs(feeds.job_feed(landed_, lexicon=LEXICON, patterns=("erly", "ange"), today=F.lit(today),
                                max_age_days=3)).drop("url", "company", "_domain")


def rejected_payloads(spark, sf):
    """Payloads that can't be used, of nine inputs with damaged ones among them."""
    inputs = _damage(spark, sf, {k: v for k, v in _every_input(spark, sf).items() if any(k == d[0] for d in _DAMAGED)})
    inputs["wd"].pop("details")
    return reject_report(inputs, {key: source.label for key, source in SOURCES.items()})


def isolated_sources(spark, sf):
    """Postings of sources with damaged payloads among theirs, counted as they pass."""
    inputs = _damage(spark, sf, _inputs(spark, sf))
    return _totals(read_sources(inputs, ["gh", "ab", "js", "sb"], lexicon=LEXICON, seen={}, failed={}))


def source_preview(spark, sf):
    """Dry run: five rows per source, fifteen in all."""
    jobs = read_sources(_inputs(spark, sf), lexicon=LEXICON)
    return preview(jobs).select("source", "company", "title", "url", "food_keywords_matched")


QUERIES = {f.__name__: f for f in (
    greenhouse_source, lever_source, ashby_source, workday_source, benefit_employers,
    benefit_source, search_page_source, job_board_source, network_source, startup_source,
    web_search_source, crawl_search_source, feed_discovery_source, feed_monitor_source,
    organisation_monitor_source, organisation_discovery_source, account_board_source,
    board_links, targeted_board_source, targeted_search_source, all_sources, source_preview, every_source, rejected_payloads,
    isolated_sources, recent_feed)}


# --- check SQL ------------------------------------------------------------------------------

_TEXT = "regexp_replace(text, '\\s+', ' ', 'g')"
_BASE = f"""{Q.DOCS}, d AS (SELECT *, substring(md5(text), 1, 10) AS id,
  CASE lang WHEN 'en' THEN 'ering' ELSE 'Rien' END AS term FROM docs)"""


def _select(source: str, company: str = "slug", title: str = "title", location: str = "place",
            remote: str = "'On-site'", day: str = "day", url: str = "url", domain: str = "''",
            body: str = f"trim({_TEXT}) || ' & more'", searched: str = "ct",
            fallback: str = "[]", once: str | None = "url", kept: str = "true",
            from_: str = "d", empty: str = "''", name: str = "m") -> str:
    """CTEs ending in ``name``: matched postings of one source."""
    first = (f"QUALIFY row_number() OVER (PARTITION BY {once} ORDER BY doc_id) = 1"
             if once else "")
    return f"""{name}_b AS (SELECT *, {url} AS u, {body} AS ct FROM {from_}),
{name}_o AS (SELECT * FROM {name}_b {first.replace('url', 'u')}),
{name}_k AS (SELECT *, {Q.hits(f'lower({searched})')} AS kw0 FROM {name}_o),
{name}_f AS (SELECT *, CASE WHEN len(kw0) > 0 THEN kw0 ELSE {fallback} END AS kw FROM {name}_k),
{name} AS (SELECT {source} AS source, {company} AS company, {title} AS title,
  {location} AS location, {remote} AS remote, array_to_string(kw, ', ') AS food_keywords_matched,
  CASE WHEN ct = '' THEN {empty} ELSE {Q.excerpt('ct', 'kw[1]')} END AS perk_excerpt,
  {day} AS date_posted, u AS url, {domain} AS _domain, len(kw) AS keyword_count
  FROM {name}_f WHERE len(kw) > 0 AND {kept})"""


def _only(*args, **kw) -> str:
    return f"WITH {_BASE}, {_select(*args, **kw)} SELECT * FROM m"


_PLAIN_TEXT = f"trim({_TEXT})"
_MANAGED = """EXISTS (SELECT 1 FROM supplier WHERE s_acctbal >= 6000
  AND 'src' || s_suppkey = slug)"""
_GH = dict(source="'Greenhouse'", company="'Acme ' || upper(slug[1]) || substring(slug, 2)",
           remote="CASE WHEN contains(lower(ct), 'hybrid') THEN 'Hybrid' ELSE 'On-site' END",
           once=None)
_AB = dict(source="'Ashby'", company="CASE WHEN lang = 'de' THEN 'B ' || upper(slug[1]) || "
           "substring(slug, 2) ELSE slug END", once=None,
           remote="CASE WHEN lang = 'fr' THEN 'Remote' ELSE 'On-site' END",
           body=f"CASE WHEN lang = 'es' THEN 'Plain ' ELSE 'Hi ' END || {_PLAIN_TEXT}")
_LV = dict(source="'Lever'", company="CASE WHEN lang = 'de' THEN upper(slug) ELSE "
           "upper(slug[1]) || substring(slug, 2) END", once=None,
           remote="CASE lang WHEN 'es' THEN 'Remote' WHEN 'fr' THEN 'Hybrid' ELSE 'On-site' END",
           body=f"'About We ' || {_PLAIN_TEXT}")
_JS = dict(source="'JobSpy/' || CASE lang WHEN 'es' THEN 'Google' WHEN 'en' THEN 'Indeed' "
           "ELSE 'Jobspy' END", location="CASE lang WHEN 'fr' THEN 'ST' WHEN 'de' THEN 'Lyon' "
           "ELSE 'Lyon, ST' END", remote="CASE WHEN lang = 'en' THEN 'Remote' ELSE 'On-site' END",
           day="CASE WHEN lang = 'fr' THEN '' ELSE day END", body=_PLAIN_TEXT,
           url="'https://jobs.example/jobs/' || id")
_SB = dict(source="'Sumble-Discovery'", domain="slug || '.com'", remote="''",
           url="'https://o/jobs/' || id", searched="title || ' ' || ct")
_EX = dict(source="'Exa'", location="''", remote="'Unknown'", body=_PLAIN_TEXT,
           url="CASE lang WHEN 'en' THEN 'https://boards.greenhouse.io/' || slug || '/jobs/' || "
               "id WHEN 'fr' THEN 'https://jobs.lever.co/en/' || id WHEN 'de' THEN "
               "'https://boards.bamboohr.com/' || id ELSE 'https://jobs.ashbyhq.com/My_' || "
               "slug || '/' || id END",
           company="CASE lang WHEN 'en' THEN upper(slug[1]) || substring(slug, 2) WHEN 'es' "
                   "THEN 'My ' || upper(slug[1]) || substring(slug, 2) ELSE 'Https://Boards' "
                   "END", kept="lang <> 'fr'")
_TS = dict(source="'TheirStack-Discovery'",
           company="CASE WHEN lang = 'fr' THEN slug || '.com' ELSE slug END",
           remote="CASE WHEN lang = 'es' THEN 'Remote' ELSE '' END", domain="slug || '.com'",
           url="'https://f/jobs/' || id", searched="title || ' ' || ct",
           fallback="list_filter([CASE WHEN contains(lower(title || ' ' || ct), 'erly') THEN "
                    "'erly' END, CASE WHEN contains(lower(title || ' ' || ct), 'ange') THEN "
                    "'ange' END], lambda x: x IS NOT NULL)")

_EMPLOYERS = """e AS (
  SELECT '7' || substring(slug, 4) AS employer_id, upper(slug) AS name,
    CASE lang WHEN 'en' THEN 'Meal Plan or Allowance' WHEN 'fr' THEN 'Stocked Kitchen'
      ELSE 'Company Cafeteria' END AS benefit_label,
    CASE lang WHEN 'en' THEN '' WHEN 'es' THEN 'https://www.glassdoor.com/Benefits/X-Benefits-E7'
      || substring(slug, 4) || '.htm' ELSE url END AS detail_url,
    CASE lang WHEN 'en' THEN 2 WHEN 'fr' THEN 4 ELSE 3 END AS rank, doc_id FROM d),
employers AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY employer_id
  ORDER BY rank, doc_id) = 1)"""

_CARD = "lang = 'de'"
_BOARD_URL = """CASE lang WHEN 'en' THEN 'https://job-boards.greenhouse.io/' || slug || '/jobs/' ||
  doc_id WHEN 'fr' THEN 'https://jobs.lever.co/' || slug || '/' || substring(md5(text), 1, 30) ||
  '-abcde' ELSE 'https://jobs.ashby.com/jobs/' || slug || '/' || id END"""
_BOARD_KIND = "CASE lang WHEN 'en' THEN 'greenhouse' WHEN 'fr' THEN 'lever' ELSE 'ashby' END"

_DA = """a AS (SELECT 'src' || s_suppkey AS slug, 'Src' || s_suppkey || ' Holdings, Inc.' AS name,
  'https://www.src' || s_suppkey || '.com/careers/' AS dom, CASE n_regionkey WHEN 0 THEN
  'greenhouse' WHEN 2 THEN 'ashby' ELSE 'lever' END AS kind FROM supplier JOIN nation
  ON s_nationkey = n_nationkey WHERE s_acctbal >= 1500),
da AS (SELECT d.*, a.name AS account_name, a.dom, a.kind FROM d JOIN a ON a.slug = d.slug)"""


def _account_boards() -> str:
    parts = []
    for kind, cols in (("greenhouse", _GH), ("lever", _LV), ("ashby", _AB)):
        cols = {**cols, "source": f"'Domain-{kind.title()}'", "company": "account_name",
                "domain": "dom", "kept": f"kind = '{kind}'", "from_": "da", "name": kind,
                "remote": cols["remote"] if kind == "ashby" else "''"}
        parts.append(_select(**cols))
    return (f"WITH {_BASE}, {_DA}, {', '.join(parts)}, u AS (SELECT * FROM greenhouse UNION ALL "
            "SELECT * FROM lever UNION ALL SELECT * FROM ashby) SELECT * FROM u")


_PREVIEW_PARTS = ((0, "g", _GH), (1, "l", _LV), (2, "b", _AB), (6, "j", _JS), (9, "x", _EX),
                  (12, "s", _SB))


def _union(parts, columns: str) -> str:
    ctes = ", ".join(_select(**{**cols, "name": name}) for _, name, cols in parts)
    rows = " UNION ALL ".join(f"SELECT {n} AS source_no, {columns} FROM {name}"
                              for n, name, _ in parts)
    return f"WITH {_BASE}, {ctes}, u AS ({rows})"


SQL = {
    "greenhouse_source": _only(**_GH),
    "lever_source": _only(**_LV),
    "ashby_source": _only(**_AB),
    "workday_source": _only(
        "'Workday'", company="upper(slug)", day="''", once=None, kept="lang <> 'de'",
        location="CASE WHEN lang = 'fr' THEN 'Hybrid Lyon' ELSE place END",
        remote="CASE WHEN lang = 'fr' THEN 'Hybrid' ELSE 'On-site' END",
        url=f"'{_SITE}/jobs/' || id"),
    "benefit_employers": f"WITH {_BASE}, {_EMPLOYERS} SELECT employer_id, name, benefit_label, "
                         "detail_url FROM employers",
    "benefit_source": f"""
WITH {_BASE}, {_EMPLOYERS} SELECT 'Glassdoor Benefits' AS source, name AS company,
  CASE WHEN lang = 'de' THEN '(see all open roles)' ELSE title END AS title,
  CASE WHEN lang = 'de' THEN '' ELSE place END AS location,
  CASE WHEN lang = 'de' THEN '' ELSE 'On-site' END AS remote,
  benefit_label AS food_keywords_matched, 'Company lists ''' || benefit_label ||
    ''' as a verified benefit on Glassdoor (employee-reported)' AS perk_excerpt,
  CASE WHEN lang = 'de' THEN '' ELSE day END AS date_posted,
  CASE WHEN lang = 'de' THEN url ELSE 'https://www.glassdoor.com/jobs/' || id END AS url,
  '' AS _domain, 1 AS keyword_count
FROM d JOIN employers ON employer_id = '7' || substring(slug, 4)""",
    "search_page_source": _only(
        "'Built In'", remote="''", day=f"CASE WHEN {_CARD} THEN '' ELSE day END",
        url=f"CASE WHEN {_CARD} THEN 'https://builtin.com/jobs/' || id ELSE '/jobs/' || id END",
        body=f"CASE WHEN {_CARD} THEN '' ELSE {_PLAIN_TEXT} || ' & more' END",
        fallback="[term]", empty="'Found via Built In search for ''' || term || ''''"),
    "job_board_source": _only(**_JS),
    "network_source": _only(
        "'Apify/LinkedIn'", remote="CASE WHEN lang IN ('es', 'fr') THEN 'Remote' ELSE 'On-site' "
        "END", url="'https://n/jobs/' || id",
        fallback="CASE WHEN contains(lower(ct), lower(term)) THEN [term] ELSE [] END"),
    "startup_source": _only(
        "'Wellfound'", from_="(SELECT * REPLACE (CASE WHEN lang = 'en' THEN 'api term' ELSE "
        "lang END AS term) FROM d WHERE lang <> 'de')",
        location="CASE WHEN lang = 'fr' THEN 'Remote' ELSE place || ', ' || lang END",
        remote="CASE WHEN lang = 'fr' OR contains(lower(ct), 'remote') THEN 'Remote' WHEN "
               "contains(lower(ct), 'hybrid') THEN 'Hybrid' ELSE 'On-site' END",
        day="CASE WHEN lang = 'fr' THEN '' ELSE day END", url="'/jobs/' || id",
        body=f"CASE WHEN lang = 'fr' THEN '' ELSE {_PLAIN_TEXT} || ' & more' END",
        fallback="[term]", empty="'Found via Wellfound search for ''' || term || ''''"),
    "web_search_source": _only(**_EX),
    "crawl_search_source": _only(**{**_EX, "source": "'Firecrawl'", "day": "''"}),
    "feed_discovery_source": _only(**{
        **_TS, "from_": "(SELECT * FROM d WHERE lang <> 'de' AND CAST(day AS DATE) >= "
        "DATE '2024-03-15' - 60)"}),
    "feed_monitor_source": _only(**{**_TS, "source": "'TheirStack'",
                                    "from_": f"(SELECT * FROM d WHERE {_MANAGED})"}),
    "organisation_monitor_source": _only(**{**_SB, "source": "'Sumble'",
                                            "from_": f"(SELECT * FROM d WHERE {_MANAGED})"}),
    "organisation_discovery_source": _only(**{
        **_SB, "from_": "(SELECT * FROM d WHERE CAST(day AS DATE) >= DATE '2024-02-05' - 20)"}),
    "account_board_source": _account_boards(),
    "board_links": f"WITH {_BASE} SELECT {_BOARD_KIND} AS ats_type, slug, {_BOARD_URL} AS url, "
                   "doc_id FROM d",
    "targeted_board_source": _only(
        "CASE lang WHEN 'en' THEN 'Targeted-Greenhouse' WHEN 'fr' THEN 'Targeted-Lever' ELSE "
        "'Targeted-Ashby' END", company="upper(slug)", location="''", remote="''", once=None,
        day="'2024-02-05'", url=_BOARD_URL,
        title="CASE WHEN lang = 'de' THEN 'Unknown Role' ELSE title END",
        body=f"CASE WHEN lang = 'de' THEN '' ELSE title || ' ' END || {_PLAIN_TEXT}"),
    "targeted_search_source": _only(
        "'Targeted-Exa'", company="upper(slug)", location="''", remote="''", once="slug, url",
        url="'https://s/jobs/' || id", body=_PLAIN_TEXT),
    "all_sources": _union([p for p in _PREVIEW_PARTS if p[0] in (0, 2, 6, 12)],
                          "source, location, keyword_count")
    + " SELECT source, location, count(*) AS postings, CAST(sum(keyword_count) AS BIGINT) AS "
      "keywords FROM u GROUP BY ALL",
    "source_preview": _union([p for p in _PREVIEW_PARTS if p[0] < 3],
                             "source, company, title, url, food_keywords_matched")
    + " SELECT u.source, u.company, u.title, u.url, u.food_keywords_matched FROM u JOIN d "
      "ON d.url = u.url QUALIFY row_number() OVER (PARTITION BY source_no ORDER BY doc_id) <= 5",
}


def _rejects_sql() -> str:
    parts = []
    for (key, name), root in _DAMAGED.items():
        label = SOURCES[key].label
        reason = {"truncated": "unparseable", "blank": "empty", "null": "empty", "mistyped": "mistyped",
                  "error": "mistyped" if root == "" else "missing"}
        why = " ".join(f"WHEN '{digit}' THEN '{reason[kind]}'" for digit, kind in _KINDS.items())
        text = " ".join("WHEN '%s' THEN %s" % (digit, _broken(root, kind, "id").replace("{string}", "VARCHAR"))
                        for digit, kind in _KINDS.items())
        parts.append(f"SELECT '{label}' AS source, '{name}' AS input, CASE md5(text)[1] {why} END AS reason, "
                     f"CASE md5(text)[1] {text} END AS payload, doc_id FROM d WHERE md5(text)[1] <= '4'")
    return (f"WITH {_BASE}, r AS ({' UNION ALL '.join(parts)}) SELECT source, input, reason, count(*) AS payloads, "
            "arg_min(md5(coalesce(payload, '')), doc_id) AS first_payload FROM r GROUP BY ALL")


_SOUND = "(SELECT * FROM d WHERE md5(text)[1] > '4')"
SQL |= {
    "every_source": "SELECT source, location, count(*) AS postings, CAST(sum(keyword_count) AS BIGINT) AS keywords "
    "FROM (" + " UNION ALL ".join(f"SELECT source, location, keyword_count FROM ({SQL[name]})" for name in (
        "greenhouse_source", "lever_source", "ashby_source", "search_page_source", "workday_source", "benefit_source",
        "job_board_source", "network_source", "startup_source", "web_search_source", "crawl_search_source",
        "feed_discovery_source", "organisation_discovery_source", "account_board_source")) + ") GROUP BY ALL",
    "rejected_payloads": _rejects_sql(),
    "isolated_sources": _union([(n, name, {**cols, **({} if name == "j" else {"from_": _SOUND})})
                                for n, name, cols in _PREVIEW_PARTS if n in (0, 2, 6, 12)],
                               "source, location, keyword_count")
    + " SELECT source, location, count(*) AS postings, CAST(sum(keyword_count) AS BIGINT) AS keywords "
      "FROM u GROUP BY ALL",
}
SQL["recent_feed"] = "SELECT * EXCLUDE (url, company, _domain) FROM (" + _only(**{
    **_TS, "from_": "(SELECT * FROM d WHERE CAST(day AS DATE) >= DATE '2024-01-20' - 3)"}) + ")"
