"""Queries of the company rollup and its parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scoring as S
from ..operators import markets as M, rollup as R
from ..operators.dedup import first_wins
from ..session import stored
from . import sql as Q
from .data import RUBRIC, postings, supplier_accounts, table


def company_market_signals(spark, sf):
    """The minimum slice: matched documents to scored expansion signals per company.

    A company's known markets are those of its supplier region.
    """
    jobs = R.with_scores(postings(spark, sf), RUBRIC)
    signals = R.market_signals(jobs, rubric=RUBRIC)
    offices = M.with_office(supplier_accounts(spark, sf))
    known = offices.select(F.regexp_replace("domain", r"\.com$", "").alias("company_norm"),
                           "market").distinct()
    flagged = M.flag_expansion(signals, known, "company_norm")
    boosts = R.company_boosts(flagged, rubric=RUBRIC)
    return boosts.orderBy(F.desc("boost"), "company_norm")


def market_signal_rows(spark, sf):
    jobs = R.with_scores(postings(spark, sf), RUBRIC)
    return R.market_signals(jobs, rubric=RUBRIC)


def signal_strength(spark, sf):
    """Events as postings: user is the company, event type the market, value the score."""
    e = table(spark, sf, "events").select(
        F.col("user_id").alias("company_norm"), F.col("event_type").alias("market"),
        F.floor("value").alias("kw_score"))
    return R.market_signals(e, rubric=RUBRIC)


def location_detail(spark, sf):
    signals = signal_strength(spark, sf).withColumn("loc_type", F.when(
        F.col("market").isin("view", "click"), "existing").otherwise("expansion"))
    detail = R.location_detail(signals)
    return detail.select("company_norm", F.to_json("location_detail").alias("detail"))


def expansion_boost(spark, sf):
    signals = signal_strength(spark, sf).withColumn("loc_type", F.when(
        F.col("market").isin("view", "click"), "existing").otherwise("expansion"))
    return R.company_boosts(signals, rubric=RUBRIC)


def posting_scores(spark, sf):
    jobs = R.with_scores(postings(spark, sf), RUBRIC)
    return jobs.select("url", "company_norm", "market", "kw_score", "gtm_score")


def best_posting(spark, sf):
    """Best line per supplier by price, first order and line on ties."""
    li = table(spark, sf, "lineitem").withColumn(
        "place", F.struct("l_orderkey", "l_linenumber"))
    return R.best_posting(li, "l_suppkey", "l_extendedprice", "place",
                          ("l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate"))


def company_sets(spark, sf):
    """Titles, keywords and sources per supplier from its lines and parts."""
    li = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey", "l_returnflag",
                                             "l_linestatus")
    p = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    rows = li.join(p, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_suppkey").alias("company_norm"),
        F.concat_ws(" ", F.upper("p_name"), "p_brand").alias("title"),
        F.concat_ws(", ", F.split("p_name", " ")[0], F.lit(""), "p_type").alias(
            "food_keywords_matched"),
        F.concat("l_returnflag", "l_linestatus").alias("source"))
    rubric = type(RUBRIC)(**{**RUBRIC.__dict__, "source": {"RO": 3, "NF": 2, "AF": 1}})
    return R.company_sets(rows, rubric)


def first_domain(spark, sf):
    """First posting per company that names a verified domain."""
    jobs = postings(spark, sf).where(F.col("_domain") != "")
    return first_wins(jobs.select("company", "_domain", "ingest_seq"), ["company"],
                      "ingest_seq").select("company", F.col("_domain").alias("domain"))


def company_rollup(spark, sf):
    """All 30 company columns from matched documents and supplier accounts."""
    jobs = stored(postings(spark, sf), "postings")
    return R.rollup(jobs, supplier_accounts(spark, sf), RUBRIC)


def top_companies(spark, sf):
    return R.top_companies(company_rollup(spark, sf))


def supplier_rollup(spark, sf):
    """Rollup of every order line: the largest fact table through one grouping."""
    li = table(spark, sf, "lineitem")
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    per = li.groupBy("l_suppkey", "l_returnflag").agg(
        F.count("*").alias("n"), F.sum(cents).alias("cents"), F.max(cents).alias("top"))
    strength = S.signal_strength(F.col("n"), RUBRIC)
    return per.groupBy("l_suppkey").agg(
        F.sum("n").alias("lines"), F.sum("cents").alias("cents"), F.max("top").alias("top"),
        F.array_join(F.array_sort(F.collect_list(F.when(strength == "confirmed", F.col(
            "l_returnflag")))), ", ").alias("confirmed"))


QUERIES = {f.__name__: f for f in (
    company_market_signals, market_signal_rows, signal_strength, location_detail,
    expansion_boost, posting_scores, best_posting, company_sets, first_domain, company_rollup,
    top_companies, supplier_rollup)}

_SCORED = f"""{Q.POSTINGS}, scored AS (
  SELECT *, CAST({Q.weighted('lower(kws)', RUBRIC.keyword)} AS BIGINT) AS kw_score,
    lower(company || ' ' || title || ' ' || excerpt) AS combined FROM postings),
jobs AS (
  SELECT *, CAST(kw_score + 2 * n_kw
    + CASE source WHEN 'Board' THEN 8 WHEN 'Feed' THEN 6 ELSE 2 END
    + {Q.weighted('combined', RUBRIC.vertical)} + {Q.weighted('combined', RUBRIC.size)}
    + {Q.weighted('lower(title)', RUBRIC.persona)} AS BIGINT) AS gtm_score FROM scored),
signals AS (
  SELECT company AS company_norm, market, count(*) AS jd_count, max(kw_score) AS max_kw_score,
    {Q.strength('count(*)')} AS signal_strength
  FROM jobs WHERE kw_score >= 5 GROUP BY company, market)"""

_LISTS = ", ".join(
    f"coalesce(string_agg(market, ', ' ORDER BY market) FILTER (loc_type = '{k}' AND "
    f"signal_strength = '{s}'), '') AS {k}_{s}"
    for k, s in RUBRIC.boost)
_BOOST = ("CAST(sum(CASE " + " ".join(
    f"WHEN loc_type = '{k}' AND signal_strength = '{s}' THEN {p}"
    for (k, s), p in RUBRIC.boost.items()) + " ELSE 0 END) AS BIGINT) AS boost")
_OVERALL = ("CASE " + " ".join(f"WHEN {k}_{s} <> '' THEN '{k}_{s}'" for k, s in RUBRIC.boost)
            + " ELSE 'noise' END AS loc_signal_strength")


def _boosts(flagged: str) -> str:
    return (f"boosts AS (SELECT *, {_OVERALL} FROM (SELECT company_norm, {_BOOST}, "
            f"CAST(sum(jd_count) AS BIGINT) AS location_jd_count, {_LISTS} FROM {flagged} "
            "GROUP BY company_norm))")


_EVENT_SIGNALS = f"""signals AS (
  SELECT user_id AS company_norm, event_type AS market, count(*) AS jd_count,
    CAST(max(floor(value)) AS BIGINT) AS max_kw_score, {Q.strength('count(*)')} AS signal_strength
  FROM events WHERE floor(value) >= 5 GROUP BY ALL),
flagged AS (SELECT *, CASE WHEN market IN ('view', 'click') THEN 'existing' ELSE 'expansion'
  END AS loc_type FROM signals)"""

_DETAIL = ("'{{\"market\":\"' || {m} || '\",\"jd_count\":' || jd_count || "
           "',\"signal_strength\":\"' || signal_strength || '\",\"loc_type\":\"' || loc_type "
           "|| '\",\"max_kw_score\":' || max_kw_score || '}}'").format(m="market")

_BRANDS = " OR ".join(f"(contains(company, '{b}') AND contains(top_keywords, '{b}'))"
                      for b in RUBRIC.brands)

_ROLLUP = f"""
WITH {_SCORED}, {Q.SUPPLIERS},
best AS (SELECT * FROM jobs QUALIFY row_number() OVER (PARTITION BY company
  ORDER BY gtm_score DESC, doc_id) = 1),
sets AS (SELECT company, count(DISTINCT title) AS roles,
  string_agg(DISTINCT source, ', ' ORDER BY source) AS all_sources,
  CASE WHEN bool_or(source = 'Board') THEN 'Board' WHEN bool_or(source = 'Feed') THEN 'Feed'
    ELSE 'Crawl' END AS best_source,
  arg_min(domain, doc_id) FILTER (domain <> '') AS verified FROM jobs GROUP BY company),
words AS (SELECT company, string_agg(DISTINCT w, ', ' ORDER BY w) AS top_keywords
  FROM (SELECT company, unnest(kw) AS w FROM jobs) GROUP BY company),
named AS (SELECT nn, arg_max(list, list = 'managed') AS list, arg_max(raw_domain, row_no)
    AS raw_domain, arg_max(vertical, row_no) AS vertical,
    arg_max(zi_industry, row_no) AS zi_industry FROM accounts WHERE nn <> '' GROUP BY nn),
base AS (
  SELECT b.*, s.roles, s.all_sources, s.best_source, w.top_keywords, n.list,
    coalesce(n.vertical, '') AS vertical, coalesce(n.zi_industry, '') AS zi,
    coalesce(s.verified, nullif(n.raw_domain, ''), b.company || '.com') AS inferred_domain
  FROM best b JOIN sets s USING (company) JOIN words w USING (company)
    LEFT JOIN named n ON n.nn = b.company),
placed AS (
  SELECT base.*, CASE WHEN a.market <> 'Other' THEN a.market ELSE '' END AS known,
    CASE WHEN a.s_suppkey IS NULL THEN '[]' ELSE '[{{"city":"' || a.city || '","state":"' ||
      a.state || '","market":"' || a.market || '"}}]' END AS cities
  FROM base LEFT JOIN accounts a ON a.nd <> ''
    AND a.nd = regexp_replace(regexp_replace(inferred_domain, '^https://www\\.', ''), '/.*', '')),
flagged AS (SELECT s.*, CASE WHEN s.market <> 'Other' AND s.market = p.known THEN 'existing'
  ELSE 'expansion' END AS loc_type FROM signals s JOIN placed p ON p.company = s.company_norm),
{_boosts('flagged')},
details AS (SELECT company_norm, '[' || string_agg({_DETAIL}, ',' ORDER BY jd_count DESC, market)
  || ']' AS detail FROM flagged GROUP BY company_norm),
final AS (
  SELECT p.*, d.detail, coalesce(o.location_jd_count, 0) AS location_jd_count,
    coalesce(o.loc_signal_strength, 'noise') AS loc_signal_strength,
    coalesce(o.expansion_confirmed, '') AS expansion_confirmed,
    coalesce(o.expansion_possible, '') AS expansion_possible,
    coalesce(o.existing_confirmed, '') AS existing_confirmed,
    coalesce(o.existing_possible, '') AS existing_possible,
    CAST(CASE WHEN {_BRANDS} THEN greatest(gtm_score - 25, 0) ELSE gtm_score END
      + CASE list WHEN 'managed' THEN 15 WHEN 'unmanaged' THEN 8 ELSE 0 END
      + coalesce(o.boost, 0) AS BIGINT) AS score
  FROM placed p LEFT JOIN boosts o ON o.company_norm = p.company
    LEFT JOIN details d ON d.company_norm = p.company)
SELECT company, inferred_domain, score AS gtm_score, {Q.confidence('score')} AS confidence,
  {Q.tier('score')} AS icp_tier, coalesce(list, 'prospect') AS segment,
  CASE WHEN known <> '' THEN known ELSE market END AS market, known AS known_markets,
  cities AS office_cities, vertical AS ezcater_vertical, zi AS zi_industry,
  roles AS unique_roles_with_perk, roles AS role_count, top_keywords, best_source, all_sources,
  location, 'On-site' AS remote, title AS sample_title, url AS sample_url,
  substring(excerpt, 1, 200) AS perk_excerpt, day AS date_first_seen, 1 AS is_new,
  loc_signal_strength, expansion_confirmed, expansion_possible, existing_confirmed,
  existing_possible, location_jd_count, coalesce(detail, '[]') AS location_detail
FROM final"""

SQL = {
    "company_market_signals": f"""
WITH {_SCORED}, {Q.SUPPLIERS}, flagged AS (
  SELECT s.*, CASE WHEN EXISTS (SELECT 1 FROM accounts a WHERE a.nd = s.company_norm || '.com'
    AND a.market = s.market AND a.market <> 'Other') THEN 'existing' ELSE 'expansion' END
    AS loc_type FROM signals s),
{_boosts('flagged')} SELECT * FROM boosts""",
    "market_signal_rows": f"WITH {_SCORED} SELECT * FROM signals",
    "signal_strength": f"WITH {_EVENT_SIGNALS} SELECT * FROM signals",
    "location_detail": f"""
WITH {_EVENT_SIGNALS} SELECT company_norm, '[' || string_agg({_DETAIL}, ','
  ORDER BY jd_count DESC, market) || ']' AS detail FROM flagged GROUP BY company_norm""",
    "expansion_boost": f"WITH {_EVENT_SIGNALS}, {_boosts('flagged')} SELECT * FROM boosts",
    "posting_scores": f"WITH {_SCORED} SELECT url, company AS company_norm, market, kw_score, "
                      "gtm_score FROM jobs",
    "best_posting": """
SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice, l_shipdate FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_suppkey
  ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) = 1""",
    "company_sets": """
WITH r AS (SELECT l_suppkey AS company_norm, lower(p_name || ' ' || p_brand) AS title,
  [string_split(p_name, ' ')[1], p_type] AS kw, l_returnflag || l_linestatus AS source
  FROM lineitem JOIN part ON l_partkey = p_partkey),
w AS (SELECT company_norm, string_agg(DISTINCT k, ', ' ORDER BY k) AS top_keywords FROM
  (SELECT company_norm, unnest(kw) AS k FROM r) GROUP BY company_norm)
SELECT company_norm, count(DISTINCT title) AS unique_roles_with_perk,
  any_value(top_keywords) AS top_keywords,
  string_agg(DISTINCT source, ', ' ORDER BY source) AS all_sources,
  CASE WHEN bool_or(source = 'RO') THEN 'RO' WHEN bool_or(source = 'NF') THEN 'NF'
    WHEN bool_or(source = 'AF') THEN 'AF' ELSE min(source) END AS best_source
FROM r JOIN w USING (company_norm) GROUP BY company_norm""",
    "first_domain": f"WITH {Q.POSTINGS} SELECT company, arg_min(domain, doc_id) AS domain "
                    "FROM postings WHERE domain <> '' GROUP BY company",
    "company_rollup": _ROLLUP,
    "top_companies": f"SELECT company, gtm_score, top_keywords FROM ({_ROLLUP}) "
                     "ORDER BY gtm_score DESC, company LIMIT 5",
    "supplier_rollup": """
WITH c AS (SELECT l_suppkey, l_returnflag, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents
  FROM lineitem),
per AS (SELECT l_suppkey, l_returnflag, count(*) AS n, sum(cents) AS cents, max(cents) AS top
  FROM c GROUP BY ALL)
SELECT l_suppkey, CAST(sum(n) AS BIGINT) AS lines, CAST(sum(cents) AS BIGINT) AS cents,
  max(top) AS top, coalesce(string_agg(l_returnflag, ', ' ORDER BY l_returnflag)
    FILTER (n >= 5), '') AS confirmed
FROM per GROUP BY l_suppkey""",
}
ROLLUP_SQL = _ROLLUP
