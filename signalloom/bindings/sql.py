"""Building blocks of the check SQL, written apart from the Spark expressions."""

from __future__ import annotations

from ..lexicon import Lexicon
from .data import LEXICON


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def any_contains(column: str, terms) -> str:
    return "(" + " OR ".join(f"contains({column}, {lit(t)})" for t in terms) + ")"


def near(lc: str, term: str, lexicon: Lexicon) -> str:
    """A context word in the window of some occurrence, by the positions of the term."""
    n, w = len(term), lexicon.window
    segs = f"string_split({lc}, {lit(term)})"
    pos = (f"list_transform(range(1, len({segs})), lambda i: CAST(list_sum(list_transform("
           f"list_slice({segs}, 1, i), lambda s: length(s))) AS BIGINT) + (i - 1) * {n})")
    window = (f"substring({lc}, greatest(p - {w}, 0) + 1, "
              f"p + {n + w} - greatest(p - {w}, 0))")
    test = any_contains(window, lexicon.context)
    return f"len(list_filter({pos}, lambda p: {test})) > 0"


def hits(lc: str, lexicon: Lexicon = LEXICON) -> str:
    parts = []
    for term in lexicon.terms:
        test = f"contains({lc}, {lit(term)})"
        if term in lexicon.needs_context:
            test += f" AND {near(lc, term, lexicon)}"
        parts.append(f"CASE WHEN {test} THEN {lit(term)} END")
    return f"list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL)"


def weighted(lc: str, weights: dict[str, int]) -> str:
    return "(" + " + ".join(f"CASE WHEN contains({lc}, {lit(t)}) THEN {w} ELSE 0 END"
                            for t, w in weights.items()) + ")"


def excerpt(text: str, keyword: str) -> str:
    at = f"strpos(lower({text}), lower({keyword}))"
    start = f"greatest({at} - 60, 1)"
    body = (f"regexp_replace(substring({text}, {start}, {at} + length({keyword}) + 60 - "
            f"{start}), '^\\s+|\\s+$', '', 'g')")
    return f"CASE WHEN {at} > 0 THEN '...' || {body} || '...' ELSE '' END"


def clean(text: str) -> str:
    """Tags out, entities of the corpus decoded, white space collapsed."""
    out = f"regexp_replace({text}, '<[^>]+>', ' ', 'g')"
    for entity, char in (("&middot;", "·"), ("&copy;", "©"), ("&quot;", '"'), ("&lt;", "<"),
                         ("&gt;", ">"), ("&#39;", "'")):
        out = f"replace({out}, {lit(entity)}, {lit(char)})"
    out = f"regexp_replace({out}, '&amp;?', '&', 'g')"
    return f"trim(regexp_replace({out}, '\\s+', ' ', 'g'))"


def iso_week(ts: str) -> str:
    return (f"CAST(isoyear({ts}) AS VARCHAR) || '-' || "
            f"lpad(CAST(weekofyear({ts}) AS VARCHAR), 2, '0')")


def confidence(score: str) -> str:
    return (f"CASE WHEN {score} BETWEEN 25 AND 998 THEN 'High' WHEN {score} BETWEEN 12 AND 24 "
            "THEN 'Medium' ELSE 'Low' END")


def tier(score: str) -> str:
    return (f"CASE WHEN {score} >= 30 THEN 'Very Viable' WHEN {score} >= 18 THEN 'Viable' "
            "ELSE 'Monitor' END")


def strength(n: str) -> str:
    return (f"CASE WHEN {n} >= 5 THEN 'confirmed' WHEN {n} >= 3 THEN 'possible' "
            "ELSE 'noise' END")


# Twins of the views in data.py.
DOCS = """docs AS (
  SELECT doc_id, text, lang, source AS slug,
    'role ' || substring(md5(text), 1, 1) || ' ' || lang AS title,
    CASE lang WHEN 'en' THEN 'Austin, TX, USA' WHEN 'fr' THEN 'Brooklyn, NYC'
      WHEN 'de' THEN 'San Diego' ELSE 'Boston, MA' END AS place,
    'https://boards.greenhouse.io/' || source || '/jobs/' || doc_id AS url,
    CAST(DATE '2024-01-01' + CAST(floor(n_chars / 100) AS INTEGER) AS VARCHAR) AS day
  FROM documents)"""

POSTINGS = f"""{DOCS}, matched AS (
  SELECT *, {hits('lower(text)')} AS kw FROM docs),
postings AS (
  SELECT CASE lang WHEN 'en' THEN 'Board' WHEN 'de' THEN 'Feed' ELSE 'Crawl' END AS source,
    slug AS company, title, place AS location, lang, array_to_string(kw, ', ') AS kws,
    len(kw) AS n_kw, kw, {excerpt('text', 'kw[1]')} AS excerpt, day, url, doc_id,
    CASE lang WHEN 'en' THEN 'Austin' WHEN 'fr' THEN 'New York' WHEN 'de' THEN 'Other'
      ELSE 'Boston' END AS market,
    CASE WHEN starts_with(title, 'role 5') THEN slug || '-jobs.com' ELSE '' END AS domain
  FROM matched WHERE len(kw) > 0)"""

SUPPLIERS = """accounts AS (
  SELECT CASE WHEN s_acctbal >= 6000 THEN 'managed' ELSE 'unmanaged' END AS list,
    s_suppkey AS row_no, s_suppkey,
    CASE WHEN s_acctbal < 1500 THEN '' ELSE 'src' || s_suppkey END AS nn,
    CASE WHEN s_acctbal < 1500 THEN '' ELSE 'src' || s_suppkey || '.com' END AS nd,
    CASE WHEN s_acctbal < 1500 THEN ''
      ELSE 'https://www.src' || s_suppkey || '.com/careers/' END AS raw_domain,
    CASE n_regionkey WHEN 0 THEN 'Technology' WHEN 1 THEN 'Retail' WHEN 2 THEN 'Pharma'
      ELSE 'Finance' END AS vertical,
    CASE WHEN n_regionkey = 3 THEN 'Hospitality' ELSE 'Management Consulting' END
      AS zi_industry,
    CASE n_regionkey WHEN 0 THEN 'Austin' WHEN 1 THEN 'brooklyn' WHEN 2 THEN 'San Diego'
      WHEN 3 THEN 'Cambridge' ELSE 'Atlantis' END AS city,
    CASE n_regionkey WHEN 0 THEN 'Texas' WHEN 3 THEN 'Massachusetts' ELSE '' END AS state,
    CASE n_regionkey WHEN 0 THEN 'Austin' WHEN 1 THEN 'New York' WHEN 2 THEN 'San Diego'
      WHEN 3 THEN 'Boston' ELSE 'Other' END AS market
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""

PART_ACCOUNTS = """accounts AS (
  SELECT CASE WHEN p_size >= 40 THEN 'managed' ELSE 'unmanaged' END AS list,
    p_partkey AS row_no,
    lower(replace(p_name || ' ' || p_brand || ' ' || p_type, '#', ' ')) AS nn,
    replace(p_name, ' ', '-') || '-' || lower(p_type) || '.com' AS nd
  FROM part)"""

CUSTOMERS = """accounts AS (
  SELECT CASE WHEN c_acctbal >= 8000 THEN 'managed' ELSE 'unmanaged' END AS list,
    c_custkey AS row_no, c_mktsegment AS vertical,
    CASE WHEN c_acctbal < 0 THEN c_name || ' Grill' ELSE c_name END AS name,
    CASE WHEN c_acctbal < -500 THEN ''
      ELSE 'www.n' || c_nationkey || '-' || lower(c_mktsegment) || '.com' END AS domain,
    'industry ' || c_nationkey AS zi_industry,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Arlington' WHEN 'BUILDING' THEN 'QUEENS'
      WHEN 'FURNITURE' THEN 'queens' WHEN 'HOUSEHOLD' THEN 'Irvine' ELSE 'Atlantis' END
      AS city,
    CASE WHEN c_acctbal > 4000 THEN 'Virginia' ELSE 'Texas' END AS state
  FROM customer)"""

WEEKLY = f"""weekly AS (
  SELECT user_id AS company_name, {iso_week("(CAST(ts AS DATE) - 2)")} AS week, count(*) AS signal_count,
    max(event_type) AS keyword_set FROM events GROUP BY ALL)"""
