"""Explicit schemas of the tables the engine reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**cols: str) -> T.StructType:
    kinds = {"s": T.StringType(), "i": T.IntegerType(), "l": T.LongType(),
             "b": T.BooleanType(), "d": T.DoubleType()}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in cols.items()])


# --- fixed values: column names, headers and payload fields of the files exchanged -------------

# One job posting. `ingest_seq` orders rows inside the engine and is left out of exports.
JOB_COLUMNS = ("source", "company", "title", "location", "remote", "food_keywords_matched",
               "keyword_count", "perk_excerpt", "date_posted", "url", "_domain")
JOBS_CSV = _struct(source="s", company="s", title="s", location="s", remote="s",
                   food_keywords_matched="s", keyword_count="i", perk_excerpt="s",
                   date_posted="s", url="s", _domain="s")

COMPANY_COLUMNS = (
    "company", "inferred_domain", "gtm_score", "confidence", "icp_tier", "segment", "market",
    "known_markets", "office_cities", "ezcater_vertical", "zi_industry",
    "unique_roles_with_perk", "role_count", "top_keywords", "best_source", "all_sources",
    "location", "remote", "sample_title", "sample_url", "perk_excerpt", "date_first_seen",
    "is_new", "loc_signal_strength", "expansion_confirmed", "expansion_possible",
    "existing_confirmed", "existing_possible", "location_jd_count", "location_detail")

HISTORY_COLUMNS = (
    "name", "domain", "first_seen", "last_seen", "times_seen", "is_new", "gtm_score",
    "top_keywords", "role_count", "sample_title", "sample_url", "location", "perk_excerpt",
    "source", "notified", "segment", "market", "ezcater_vertical", "zi_industry",
    "loc_signal_strength", "expansion_confirmed", "expansion_possible", "existing_confirmed",
    "existing_possible", "location_jd_count", "location_detail", "known_markets",
    "office_cities")

# Columns added to older history tables, with the value old rows take.
HISTORY_DEFAULTS = {
    "segment": "prospect", "market": None, "ezcater_vertical": None, "zi_industry": None,
    "loc_signal_strength": "noise", "expansion_confirmed": None, "expansion_possible": None,
    "existing_confirmed": None, "existing_possible": None, "location_jd_count": 0,
    "location_detail": None, "known_markets": None, "office_cities": None}

EXPORT_COLUMNS = (
    "company", "inferred_domain", "gtm_score", "confidence", "icp_tier",
    "unique_roles_with_perk", "top_keywords", "best_source", "all_sources", "location",
    "remote", "sample_title", "sample_url", "date_first_seen")

TERRITORIES = _struct(market="s", rep_name="s", slack_handle="s", webhook_env_var="s")
PROBES = _struct(domain="s", ats_type="s", ats_slug="s")
ATS_CACHE = _struct(domain="s", ats_type="s", ats_slug="s", checked_at="s")
CRAWL = _struct(url="s", status="i", body="s", fetch_error="s", fetched_at="s")

# A landed payload: one API response or page, as text.
LANDED = _struct(slug="s", company="s", search_term="s", domain="s", url="s", payload="s")

# Header of an account file -> engine column.
ACCOUNT_HEADERS = {
    "Account Name": "name", "ZoomInfo Company ID": "zoominfo_id",
    "ezCater Vertical": "vertical", "Industry": "industry",
    "Zoominfo Industry": "zi_industry", "Billing City": "city",
    "Billing State/Province": "state"}
DOMAIN_HEADERS = {"managed": "Company Domain Name", "unmanaged": "Domain"}

# Vendor payloads, written as DDL: only the fields that are read.
GREENHOUSE = ("jobs array<struct<title string, content string, absolute_url string, "
              "updated_at string, location struct<name string>>>")
LEVER = ("array<struct<text string, company string, hostedUrl string, createdAt bigint, "
         "descriptionPlain string, additional string, lists array<struct<content string>>, "
         "categories struct<location string, commitment string, team string>>>")
_ASHBY_JOB = ("struct<title string, companyName string, location string, jobUrl string, "
              "publishedAt string, isRemote boolean, descriptionHtml string, "
              "descriptionPlain string, descriptionSections array<struct<content string>>>")
ASHBY = f"jobs array<{_ASHBY_JOB}>, jobPostings array<{_ASHBY_JOB}>"
WORKDAY_LIST = ("total int, jobPostings array<struct<externalPath string, title string, "
                "locationsText string>>")
WORKDAY_DETAIL = "jobPostingInfo struct<jobDescription string>"
_EMPLOYERS = ("array<struct<employerId string, id string, employerName string, name string, "
              "detailUrl string>>")
BENEFIT_PAGE = (f"props struct<pageProps struct<employers {_EMPLOYERS}, "
                f"benefitsData struct<employers {_EMPLOYERS}>>>")
EMPLOYER_PAGE = ("props struct<pageProps struct<jobListings struct<jobListings "
                 "array<struct<jobTitle string, location string, jobLink string, "
                 "listingAge string>>>>>")
_BOARD_JOBS = ("array<struct<url string, jobUrl string, applyUrl string, title string, "
               "jobTitle string, company string, location string, locationName string, "
               "description string, body string, datePosted string>>")
SEARCH_PAGE = f"props struct<pageProps struct<jobs {_BOARD_JOBS}, jobListings {_BOARD_JOBS}>>"
LINKEDIN = ("array<struct<applyUrl string, link string, jobUrl string, url string, "
            "companyName string, company string, title string, jobTitle string, "
            "location string, descriptionText string, descriptionHtml string, "
            "description string, jobDescription string, body string, postedAt string, "
            "datePosted string, workRemoteAllowed boolean, workplaceTypes string>>")
WELLFOUND = ("data struct<talent struct<jobListings struct<edges array<struct<node struct<"
             "jobUrl string, title string, description string, locationNames array<string>, "
             "postedAt string, startup struct<name string>>>>>>>")
WELLFOUND_PAGE = ("props struct<pageProps struct<jobListings array<struct<jobUrl string, "
                  "title string, description string, companyName string, "
                  "locationName string>>>>")
EXA = "results array<struct<url string, title string, text string, publishedDate string>>"
FIRECRAWL = "data array<struct<url string, markdown string, metadata struct<title string>>>"
THEIRSTACK = ("data array<struct<job_title string, url string, date_posted string, "
              "discovered_at string, company_domain string, "
              "company_object struct<name string>, short_location string, "
              "long_location string, description string, remote boolean, "
              "country_code string>>")
SUMBLE = ("jobs array<struct<job_title string, url string, datetime_pulled string, "
          "organization_domain string, organization_name string, location string, "
          "description string, country_code string>>")
JOB_BOARD = _struct(job_url="s", city="s", state="s", company_name="s", title="s",
                    description="s", site="s", min_amount="d", max_amount="d", interval="s",
                    is_remote="b", date_posted="s")
