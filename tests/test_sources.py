"""Source normalisers on small hand-made payloads."""

import json

from pyspark.sql import functions as F

from signalloom.schemas import JOB_COLUMNS
from signalloom.sources import boards, feeds, pages, tables
from signalloom.sources.base import preview
from signalloom.sources.registry import SOURCES, read_sources

LANDED = ("slug string, company string, search_term string, domain string, url string, "
          "payload string, seq long")


def landed(spark, *rows):
    full = [(r.get("slug"), r.get("company"), r.get("search_term"), r.get("domain"),
             r.get("url"), r["payload"] if isinstance(r["payload"], str)
             else json.dumps(r["payload"]), i) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, LANDED)


def rows(df):
    assert df.columns == [*JOB_COLUMNS, "ingest_seq"]
    return df.orderBy("ingest_seq").collect()


def state(payload):
    return f'<html><script id="__NEXT_DATA__" type="x">{json.dumps(payload)}</script></html>'


def test_board_payloads_and_isolation(spark):
    jobs = {"jobs": [
        {"title": "Chef", "content": "&lt;li&gt;Free lunch&lt;/li&gt; daily", "absolute_url": "u1",
         "updated_at": "2026-04-01T00:00:00Z", "location": {"name": "Remote - US"}},
        {"title": "No perk", "content": "nothing", "absolute_url": "u2", "location": None}]}
    got = rows(boards.greenhouse(landed(spark, {"slug": "acme-labs", "payload": jobs},
                                        {"slug": "broken", "payload": "{not json"})))
    assert len(got) == 1
    r = got[0]
    assert (r.company, r.remote, r.date_posted) == ("Acme Labs", "Remote", "2026-04-01")
    # Tags go before entities are decoded, so escaped markup stays in the text.
    assert r.perk_excerpt == "...<li>Free lunch</li> daily..."


def test_lever_and_ashby_shapes(spark):
    lever = [{"text": "Dev", "hostedUrl": "u", "createdAt": 1704067200000,
              "descriptionPlain": "hi", "lists": [{"content": "<li>free food</li>"}],
              "categories": {"location": "NYC", "commitment": "Hybrid"}}]
    r = rows(boards.lever(landed(spark, {"slug": "big-co", "payload": lever})))[0]
    assert (r.company, r.date_posted, r.remote) == ("Big Co", "2024-01-01", "Hybrid")
    old = {"jobPostings": [{"title": "T", "companyName": "C", "location": "L", "jobUrl": "u",
                            "isRemote": True, "descriptionHtml": "", "descriptionPlain":
                            "meal stipend", "descriptionSections": []}]}
    r = rows(boards.ashby(landed(spark, {"slug": "c", "payload": old})))[0]
    assert (r.company, r.remote, r.food_keywords_matched) == ("C", "Remote", "meal stipend")


def test_workday_without_detail_gives_nothing(spark):
    site = "https://t.wd1.myworkdayjobs.com/en-US/b"
    lists = landed(spark, {"company": "Tee", "url": site, "payload": {"jobPostings": [
        {"externalPath": "/job/1", "title": "A", "locationsText": "Remote"},
        {"externalPath": "/job/2", "title": "B", "locationsText": "NY"}]}})
    details = landed(spark, {"url": site + "/job/1", "payload": {
        "jobPostingInfo": {"jobDescription": "<p>Catered lunch</p>"}}})
    got = rows(boards.workday(lists, details))
    assert [(r.url, r.remote) for r in got] == [(site + "/job/1", "Remote")]


def test_benefit_pages_first_label_wins_and_stub(spark):
    listing = landed(
        spark, {"search_term": "Stocked Kitchen", "payload": state({"props": {"pageProps": {
            "employers": [{"employerId": 7, "employerName": "Seven"}]}}})},
        {"search_term": "Free Lunch or Snacks", "payload":
         '<a href="/Benefits/Seven-Benefits-E7.htm">Seven</a>'
         '<a class="x" href="/Benefits/Nine-Benefits-E9.htm"><b>Nine &amp; Co</b></a>'})
    employers = pages.benefit_employers(listing)
    found = {r.employer_id: (r.name, r.benefit_label) for r in employers.collect()}
    assert found == {"7": ("Seven", "Free Lunch or Snacks"),
                     "9": ("Nine & Co", "Free Lunch or Snacks")}
    open_roles = landed(spark, {"slug": "7", "url": "p7", "payload": state({"props": {
        "pageProps": {"jobListings": {"jobListings": [
            {"jobTitle": "Cook", "location": "Hybrid, NY", "jobLink": "/j/1"}]}}}})},
        {"slug": "9", "url": "p9", "payload": "<p>no state</p>"})
    got = {r.url: r for r in rows(pages.benefit_jobs(employers, open_roles))}
    assert got["https://www.glassdoor.com/j/1"].remote == "Hybrid"
    assert got["p9"].title == "(see all open roles)" and got["p9"].keyword_count == 1


def test_search_pages_state_cards_and_fallback(spark):
    jobs = {"props": {"pageProps": {"jobs": [], "jobListings": [
        {"jobUrl": "u1", "jobTitle": "A", "company": {"name": "Acme"}, "body": "free food"},
        {"url": "u2", "title": "B", "company": "Beta", "description": ""},
        {"url": "u1", "title": "again", "body": "free meals"}]}}}
    card = ('<div class="job-card"><h2>Card role</h2><div class="company-x">Cee</div>'
            '<span class="job-location">NYC</span><p>text<br></p><a href="/jobs/3">go</a></div>'
            '<div class="JobCardWide"><h3>no link</h3></div>')
    got = {r.url: r for r in rows(pages.search_pages(landed(
        spark, {"search_term": "free lunch", "payload": state(jobs)},
        {"search_term": "meal stipend", "payload": card})))}
    assert set(got) == {"u1", "u2", "https://builtin.com/jobs/3"}
    assert got["u1"].company == "Acme" and got["u1"].food_keywords_matched == "free food"
    assert got["u2"].perk_excerpt == "Found via Built In search for 'free lunch'"
    third = got["https://builtin.com/jobs/3"]
    assert (third.title, third.company, third.location) == ("Card role", "Cee", "NYC")


def test_startup_pages_count_only_without_api_results(spark):
    api = {"data": {"talent": {"jobListings": {"edges": [{"node": {
        "jobUrl": "a1", "title": "T", "description": "x", "locationNames": ["NY", "SF"],
        "startup": {"name": "S"}}}]}}}}
    page = state({"props": {"pageProps": {"jobListings": [
        {"jobUrl": "p1", "title": "P", "companyName": "Q", "locationName": "Remote"}]}}})
    card = '<div data-test="JobListing"><h2>C</h2><a href="/jobs/9">x</a></div>'
    got = {r.url: r for r in rows(pages.startup_search(landed(
        spark, {"search_term": "one", "payload": api}, {"search_term": "one", "payload": page},
        {"search_term": "two", "payload": page}, {"search_term": "three", "payload": card},
        {"search_term": "four", "payload": {"data": None}})))}
    assert set(got) == {"a1", "p1", "https://wellfound.com/jobs/9"}
    assert got["a1"].location == "NY, SF" and got["p1"].food_keywords_matched == "two"
    assert got["p1"].perk_excerpt == "Found via Wellfound search for 'two'"


def test_first_url_blocks_later_rows_even_without_a_match(spark):
    items = [{"url": "u", "companyName": "C", "title": "t", "description": "nothing here"}]
    again = [{"link": "u", "company": "C", "jobTitle": "t", "body": "free lunch"},
             {"jobUrl": "v", "company": "C", "descriptionText": "we say GrubHub",
              "workplaceTypes": ["Remote"]}]
    got = rows(feeds.network_items(landed(spark, {"search_term": "x", "payload": items},
                                          {"search_term": "GrubHub", "payload": again})))
    assert [(r.url, r.food_keywords_matched, r.remote) for r in got] == [("v", "GrubHub",
                                                                          "Remote")]


def test_search_results_need_an_employer_url(spark):
    results = {"results": [
        {"url": "https://boards.greenhouse.io/acme-co/jobs/1", "text": "catered meals"},
        {"url": "https://blog.example.com/a", "text": "catered meals"},
        {"url": "https://jobs.lever.co/us/1", "text": "catered meals"}]}
    got = rows(feeds.web_search(landed(spark, {"payload": results})))
    assert [(r.company, r.remote) for r in got] == [("Acme Co", "Unknown")]


def test_feeds_by_mode(spark):
    data = {"data": [
        {"job_title": "A", "url": " u1 ", "company_domain": "ACME.com", "company_object": None,
         "description": "catered breakfast", "date_posted": "2026-04-28"},
        {"job_title": "free lunch lead", "url": "u2", "company_domain": "other.com",
         "company_object": {"name": "Other"}, "description": "x", "remote": True,
         "date_posted": "2026-01-01"}, {"job_title": "free lunch", "url": ""}]}
    table = landed(spark, {"payload": data})
    domains = spark.createDataFrame([("acme.com",)], "domain string")
    got = rows(feeds.job_feed(table, domains))
    assert [(r.source, r.company, r.url, r.food_keywords_matched) for r in got] == [
        ("TheirStack", "acme.com", "u1", "catered breakfast")]
    got = rows(feeds.job_feed(table))
    assert {r.url: r.perk_excerpt for r in got} == {"u1": "...catered breakfast...", "u2": ""}
    got = rows(feeds.job_feed(table, today=F.lit("2026-05-01").cast("date")))
    assert [r.url for r in got] == ["u1"]


def test_board_links_follow_all_or_the_first(spark):
    page = "".join(f'<a href="https://boards.greenhouse.io/a.b/jobs/{i // 2}">x</a>'
                   for i in range(80)) + '<a href="https://boards.greenhouse.io/aXb/jobs/1">'
    board = landed(spark, {"slug": "a.b", "company": "A", "payload": page}).withColumn(
        "ats_type", F.lit("greenhouse"))
    assert boards.board_links(board, first=30).count() == 15
    assert boards.board_links(board).count() == 40


def test_registry_union_and_preview(spark):
    one = lambda n: landed(spark, *[{"slug": "s", "payload": {"jobs": [
        {"title": str(i), "content": "free lunch", "absolute_url": f"u{n}{i}"}]}}
        for i in range(9)])
    jobs = read_sources({"gh": {"landed": one(1)}, "ab": {"landed": landed(
        spark, {"payload": "[]"})}}, ["gh", "ab", "lv"])
    assert jobs.count() == 9 and len(SOURCES) == 14
    assert [r.title for r in preview(jobs).orderBy("ingest_seq").collect()] == list("01234")


def test_csv_round_trips(spark, tmp_path):
    schema = ", ".join(f"{c} {'int' if c == 'keyword_count' else 'string'}" for c in JOB_COLUMNS)
    jobs = spark.createDataFrame([("Greenhouse", 'A "quoted", name', "t\nline", "", "x",
                                   "free lunch", 1, "...e...", "2026-01-01", "u", "")], schema)
    tables.write_jobs(jobs, f"{tmp_path}/jobs")
    back = tables.read_jobs(spark, f"{tmp_path}/jobs").first()
    assert back.company == 'A "quoted", name' and back.title == "t\nline"
    assert not back["_domain"] and back.keyword_count == 1
    (tmp_path / "m.csv").write_text(
        "Account Name,Company Domain Name,ezCater Vertical,Billing City\n"
        "One,one.com,Pharma,Boston\nTwo,,Other,\n")
    (tmp_path / "u.csv").write_text("Account Name,Domain,Zoominfo Industry\nThree,three.com,Law\n")
    got = tables.read_accounts(spark, f"{tmp_path}/m.csv", f"{tmp_path}/u.csv").orderBy("row_no")
    assert [(r["list"], r["name"], r["domain"], r["vertical"]) for r in got.collect()] == [
        ("managed", "One", "one.com", "Pharma"), ("managed", "Two", None, "Other"),
        ("unmanaged", "Three", "three.com", None)]


def test_a_field_of_another_type_loses_only_itself(spark):
    def node(**changed):
        return {"node": {"jobUrl": "u", "title": "Cook", "description": "free lunch", "locationNames": ["NYC"],
                         "postedAt": "2024-01-01", "startup": {"name": "Acme"}, **changed}}
    nodes = [node(jobUrl="a", locationNames="NYC"), node(jobUrl="b"), node(jobUrl="c", startup="Acme"), node(jobUrl="d", postedAt=17)]
    table = landed(spark, {"payload": {"data": {"talent": {"jobListings": {"edges": nodes}}}}, "search_term": "x"})
    got = [(r.url, r.company, r.location, r.date_posted) for r in rows(pages.startup_search(table))]
    assert got == [("a", "Acme", "", "2024-01-01"), ("b", "Acme", "NYC", "2024-01-01"), ("c", "", "NYC", "2024-01-01"),
                   ("d", "Acme", "NYC", "17")]
    page = state({"props": {"pageProps": {"benefitsData": "none", "employers": [
        {"employerId": 7, "employerName": "A", "detailUrl": {"x": 1}}, {"employerId": "8", "employerName": "B"}]}}})
    found = pages.benefit_employers(landed(spark, {"payload": page, "search_term": "Stocked Kitchen"})).collect()
    assert {(r.employer_id, r.name) for r in found} == {("7", "A"), ("8", "B")}
    jobs = [{"text": "T", "descriptionPlain": "free lunch", "hostedUrl": "u", "createdAt": "x", "lists": "none", "categories": ["a"]},
            {"text": "T", "descriptionPlain": "free lunch", "hostedUrl": "v", "createdAt": 1704067200000}]
    got = [(r.url, r.date_posted) for r in rows(boards.lever(landed(spark, {"slug": "a", "payload": jobs})))]
    assert got == [("u", ""), ("v", "2024-01-01")]
