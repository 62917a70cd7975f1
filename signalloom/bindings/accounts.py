"""Queries of account classification, sampling and matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..lexicon import TierRules
from ..operators import accounts as A, dedup, markets as M
from ..session import shared_folder
from . import sql as Q
from .data import customer_accounts, part_accounts, table

RULES = TierRules(
    icp_verticals=("MACHINERY", "BUILDING"), icp_industries=("industry 3", "industry 14"),
    suppress_verticals=("AUTOMOBILE",), suppress_industries=("industry 7", "industry 21"),
    suppress_tokens=("grill", "000000007"))


def tiering(spark, sf):
    return A.with_tier(customer_accounts(spark, sf), RULES).select("row_no", "list", "tier")


def coverage_stats(spark, sf):
    return A.coverage_stats(customer_accounts(spark, sf), rules=RULES)


def account_counts(spark, sf):
    return A.account_counts(customer_accounts(spark, sf))


def tier_union_dedup(spark, sf):
    tiers = A.all_tiers(customer_accounts(spark, sf), tier2_sample=100, tier3_sample=20,
                        include_tier3=True, seed="run-7", rules=RULES)
    return tiers.select("domain_key", "row_no", "tier")


def domain_universe(spark, sf):
    return A.domain_universe(customer_accounts(spark, sf), rules=RULES)


def unclassified_accounts(spark, sf):
    return A.unclassified(customer_accounts(spark, sf), RULES).select("row_no", "domain_key")


def hash_sample(spark, sf):
    return dedup.hash_sample(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"),
                             500, "o_orderkey", "seed-")


def domain_batches(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    return dedup.batches(orders, "o_orderkey", 100)


def first_wins_dedup(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    return dedup.first_wins(e, ["user_id", "event_type"], "event_id")


def last_wins_dedup(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    return dedup.last_wins(e, ["user_id", "event_type"], "event_id")


def account_index(spark, sf):
    """Name and domain indexes: last duplicate wins, the first keeps the position."""
    accounts = part_accounts(spark, sf)
    names = A.name_index(accounts).select(
        F.concat_ws("/", "list", "nn").alias("key"), F.col("account.zoominfo_id").alias("id"),
        F.col("first_row").cast("string").alias("first_row"))
    domains = A.domain_index(accounts).select(
        F.concat(F.lit("domain/"), "nd").alias("key"),
        F.coalesce("managed.zoominfo_id", F.lit("-")).alias("id"),
        F.coalesce("unmanaged.zoominfo_id", F.lit("-")).alias("first_row"))
    return names.unionByName(domains)


def _companies(spark, sf):
    """Names to look up, made of parts: exact names, sub-names and strangers."""
    p = table(spark, sf, "part")
    plain = p.select(F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("company"),
                     F.lit("").alias("domain"))
    some = p.select(F.concat_ws(" ", "p_type", "p_name").alias("company"),
                    F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("-"),
                             F.replace(F.lower("p_brand"), F.lit("#"), F.lit("")),
                             F.lit(".com")).alias("domain"))
    other = p.select(F.concat(F.lit("The "), F.split("p_name", " ")[1], F.lit(" Partners")).alias(
        "company"), F.concat(F.lit("https://www."), F.replace(
            "p_name", F.lit(" "), F.lit("-")), F.lit("-"), F.lower("p_type"),
            F.lit(".com/jobs/")).alias("domain"))
    return plain.unionByName(some).unionByName(other).distinct()


def account_match_tokens(spark, sf):
    accounts = part_accounts(spark, sf)
    names = A.name_index(accounts)
    wanted = _companies(spark, sf).select(A.normalise_name(F.col("company")).alias("nn"))
    hits = A.token_matches(wanted, names)
    return hits.select("nn", *[F.coalesce(f"{x}.zoominfo_id", F.lit("")).alias(x)
                               for x in A.LISTS])


def account_match(spark, sf):
    matched = A.match_accounts(_companies(spark, sf), part_accounts(spark, sf), "company",
                               "domain")
    return matched.select("company", "domain", "segment",
                          F.coalesce("account.zoominfo_id", F.lit("")).alias("account_id"))


def account_match_exact(spark, sf):
    """Domain and exact-name candidates of both lists side by side."""
    index = A.build_index(part_accounts(spark, sf))
    companies = A.match_domains(_companies(spark, sf), index, "domain")
    companies = A.match_names(companies, index, "company")
    companies = A.with_account(companies, index, A.pick_row("by_domain", "by_name"))
    return companies.select("company", "domain", F.col("pick.segment").alias("segment"),
                            F.coalesce("pick.account.zoominfo_id", F.lit("")).alias("id"))


def account_index_reuse(spark, sf):
    """Matches through an index opened twice: the second time it is read, and a changed list gets its own."""
    root, accounts = shared_folder(spark, "indexes"), part_accounts(spark, sf)
    A.open_index(accounts, root)
    A.open_index(accounts.where("list = 'managed'"), root)
    companies = _companies(spark, sf)
    found = []
    for lists in (accounts, accounts.where("list = 'managed'")):
        matched = A.match_accounts(companies, A.open_index(lists, root), "company", "domain")
        found.append(matched.groupBy("segment").agg(F.count("*").alias("companies"), F.count("account").alias("matched")))
    return found[0].withColumn("lists", F.lit("both")).unionByName(found[1].withColumn("lists", F.lit("managed")))


def office_index(spark, sf):
    """Counts per domain and market."""
    offices = M.with_office(customer_accounts(spark, sf))
    return M.office_counts(offices).select("domain", "market", "n", "first_row")


def known_and_primary_markets(spark, sf):
    counts = M.office_counts(M.with_office(customer_accounts(spark, sf)))
    return M.office_markets(counts).select(
        "domain", F.array_join("known_markets", ", ").alias("known_markets"), "primary_market")


def office_cities(spark, sf):
    cities = M.office_cities(M.with_office(customer_accounts(spark, sf)))
    return cities.select("domain", F.to_json("office_cities").alias("cities"))


def _nation_signals(spark, sf):
    """Nations of a supplier's customers as observed markets, its own region's as known."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    pairs = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
             .groupBy("l_suppkey", "o_custkey").agg(F.count("*").alias("lines")))
    seen = (pairs.join(c, F.col("o_custkey") == F.col("c_custkey"))
            .groupBy(F.col("l_suppkey").alias("supplier"), "c_nationkey")
            .agg(F.sum("lines").alias("jd_count")))
    named = n.withColumn("market", F.when(F.col("n_nationkey") == 4, "Other").otherwise(
        F.col("n_name")))
    signals = (seen.join(named, F.col("c_nationkey") == F.col("n_nationkey"))
               .select("supplier", "market", "jd_count"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("supplier"), "s_nationkey")
    home = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "supplier", "n_regionkey")
    known = home.join(named, "n_regionkey").select("supplier", "market")
    return signals, known


def expansion_flag(spark, sf):
    signals, known = _nation_signals(spark, sf)
    return M.flag_expansion(signals, known, "supplier").select(
        "supplier", "market", F.col("jd_count").cast("long").alias("jd_count"), "loc_type")


def expansion_markets(spark, sf):
    """The anti and semi forms, labelled."""
    signals, known = _nation_signals(spark, sf)
    return (M.expansion_only(signals, known, "supplier").withColumn("kind", F.lit("new"))
            .unionByName(M.existing_only(signals, known, "supplier")
                         .withColumn("kind", F.lit("old"))).select("supplier", "market", "kind"))


QUERIES = {f.__name__: f for f in (
    tiering, coverage_stats, account_counts, tier_union_dedup, domain_universe,
    unclassified_accounts, hash_sample, domain_batches, first_wins_dedup, last_wins_dedup,
    account_index, account_match_tokens, account_match, account_match_exact, account_index_reuse, office_index,
    known_and_primary_markets, office_cities, expansion_flag, expansion_markets)}

_SUPPRESSED = ("(vertical = 'AUTOMOBILE' OR zi_industry IN ('industry 7', 'industry 21') OR "
               "contains(lower(name), 'grill') OR contains(lower(name), '000000007'))")
_ICP = "(vertical IN ('MACHINERY', 'BUILDING') OR zi_industry IN ('industry 3', 'industry 14'))"
_TIERED = f"""{Q.CUSTOMERS}, tiered AS (
  SELECT *, CASE WHEN list = 'managed' THEN '1' WHEN {_SUPPRESSED} THEN 'X'
    WHEN {_ICP} THEN '2' ELSE '3' END AS tier FROM accounts)"""

_COMPANIES = """companies AS (
  SELECT p_name || ' ' || p_brand || ' ' || p_type AS company, '' AS domain FROM part
  UNION SELECT p_type || ' ' || p_name, replace(p_name, ' ', '-') || '-' ||
    replace(lower(p_brand), '#', '') || '.com' FROM part
  UNION SELECT 'The ' || string_split(p_name, ' ')[2] || ' Partners', 'https://www.' ||
    replace(p_name, ' ', '-') || '-' || lower(p_type) || '.com/jobs/' FROM part),
keyed AS (
  SELECT *, trim(regexp_replace(regexp_replace(lower(company), '\\b(the|partners)\\b|[^a-z0-9 ]',
    ' ', 'g'), ' +', ' ', 'g')) AS nn,
    regexp_replace(regexp_replace(domain, '^https://www\\.', ''), '/.*$', '') AS nd
  FROM companies)"""

_INDEXES = f"""{Q.PART_ACCOUNTS},
by_name AS (SELECT list, nn, max(row_no) AS id, min(row_no) AS pos FROM accounts GROUP BY ALL),
by_domain AS (SELECT list, nd, max(row_no) AS id FROM accounts GROUP BY ALL)"""

_TOKEN_HITS = """queries AS (SELECT DISTINCT nn, list_distinct(string_split(nn, ' ')) AS q
  FROM keyed),
token_hits AS (
  SELECT q.nn, n.list, arg_min(n.id, n.pos) AS id FROM queries q JOIN by_name n
    ON len(q.q) >= 2 AND list_has_all(string_split(n.nn, ' '), q.q)
  GROUP BY q.nn, n.list)"""

_STEPS = """
  (SELECT max(id) FROM by_domain d WHERE d.list = '{0}' AND d.nd = k.nd) AS d_{0},
  (SELECT max(id) FROM by_name n WHERE n.list = '{0}' AND n.nn = k.nn) AS n_{0}"""

_OFFICES = f"""{Q.CUSTOMERS}, offices AS (
  SELECT replace(domain, 'www.', '') AS domain, row_no, city, state,
    CASE WHEN lower(city) = 'queens' THEN 'New York' WHEN city = 'Irvine' THEN 'Los Angeles'
      WHEN city = 'Arlington' AND state = 'Texas' THEN 'Dallas'
      WHEN city = 'Arlington' THEN 'Washington DC' ELSE 'Other' END AS market
  FROM accounts WHERE domain <> ''),
counts AS (SELECT domain, market, count(*) AS n, min(row_no) AS first_row FROM offices
  GROUP BY ALL)"""

_SIGNALS = """markets AS (SELECT *, CASE WHEN n_nationkey = 4 THEN 'Other' ELSE n_name END
  AS market FROM nation),
signals AS (
  SELECT l_suppkey AS supplier, market, count(*) AS jd_count
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN markets ON c_nationkey = n_nationkey GROUP BY ALL),
known AS (
  SELECT s_suppkey AS supplier, m.market FROM supplier JOIN nation h
    ON s_nationkey = h.n_nationkey JOIN markets m ON m.n_regionkey = h.n_regionkey
  WHERE m.market <> 'Other')"""

SQL = {
    "tiering": f"WITH {_TIERED} SELECT row_no, list, tier FROM tiered",
    "coverage_stats": f"""
WITH {_TIERED} SELECT count(*) FILTER (tier = '1') AS managed,
  count(*) FILTER (tier <> '1') AS unmanaged_total,
  count(*) FILTER (tier = '2') AS unmanaged_icp,
  count(*) FILTER (tier = 'X') AS unmanaged_suppressed,
  count(*) FILTER (tier = '3') AS unmanaged_unclassified,
  round(count(*) FILTER (tier = '2') / 1000, 1) AS weeks_to_full_cycle
FROM tiered WHERE domain <> ''""",
    "account_counts": f"""
WITH {Q.CUSTOMERS} SELECT list, count(DISTINCT domain) AS accounts FROM accounts
WHERE domain <> '' GROUP BY list""",
    "tier_union_dedup": f"""
WITH {_TIERED}, keyed AS (SELECT *, domain AS domain_key FROM tiered WHERE domain <> ''),
ranked AS (SELECT *, row_number() OVER (PARTITION BY tier
  ORDER BY md5('run-7' || domain_key), domain_key, row_no) AS r FROM keyed),
taken AS (
  SELECT * FROM ranked WHERE tier = '1'
  UNION ALL SELECT * FROM ranked WHERE tier = '2' AND r <= 100
  UNION ALL SELECT * FROM ranked WHERE tier = '3' AND r <= 20)
SELECT domain_key, CAST(arg_min(row_no, tier || lpad(CAST(row_no AS VARCHAR), 12, '0'))
  AS BIGINT) AS row_no, min(tier) AS tier FROM taken GROUP BY domain_key""",
    "domain_universe": f"WITH {_TIERED} SELECT DISTINCT domain FROM tiered "
                       "WHERE domain <> '' AND tier IN ('1', '2')",
    "unclassified_accounts": f"WITH {_TIERED} SELECT row_no, domain AS domain_key FROM tiered "
                             "WHERE domain <> '' AND tier = '3'",
    "hash_sample": "SELECT o_orderkey, o_totalprice FROM orders "
                   "ORDER BY md5('seed-' || o_orderkey), o_orderkey LIMIT 500",
    "domain_batches": """
SELECT o_orderkey, CAST(floor((row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR)),
  o_orderkey) - 1) / 100) AS BIGINT) AS batch_id FROM orders""",
    "first_wins_dedup": """
SELECT event_id, user_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1""",
    "last_wins_dedup": """
SELECT event_id, user_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1""",
    "account_index": f"""
WITH {_INDEXES}
SELECT list || '/' || nn AS key, CAST(id AS VARCHAR) AS id, CAST(pos AS VARCHAR) AS first_row
FROM by_name
UNION ALL SELECT 'domain/' || nd, coalesce(CAST(max(id) FILTER (list = 'managed') AS VARCHAR),
  '-'), coalesce(CAST(max(id) FILTER (list = 'unmanaged') AS VARCHAR), '-')
FROM by_domain GROUP BY nd""",
    "account_match_tokens": f"""
WITH {_INDEXES}, {_COMPANIES}, {_TOKEN_HITS}
SELECT nn, coalesce(CAST(max(id) FILTER (list = 'managed') AS VARCHAR), '') AS managed,
  coalesce(CAST(max(id) FILTER (list = 'unmanaged') AS VARCHAR), '') AS unmanaged
FROM token_hits GROUP BY nn""",
    "account_match": f"""
WITH {_INDEXES}, {_COMPANIES}, {_TOKEN_HITS}, steps AS (
  SELECT k.*, {_STEPS.format('managed')}, {_STEPS.format('unmanaged')},
    (SELECT max(id) FROM token_hits t WHERE t.nn = k.nn AND t.list = 'managed') AS t_m,
    (SELECT max(id) FROM token_hits t WHERE t.nn = k.nn AND t.list = 'unmanaged') AS t_u
  FROM keyed k),
ids AS (SELECT *, coalesce(d_managed, n_managed, t_m) AS m,
  coalesce(d_unmanaged, n_unmanaged, t_u) AS u FROM steps)
SELECT company, domain, CASE WHEN m IS NOT NULL THEN 'managed' WHEN u IS NOT NULL
  THEN 'unmanaged' ELSE 'prospect' END AS segment,
  coalesce(CAST(coalesce(m, u) AS VARCHAR), '') AS account_id FROM ids""",
    "account_match_exact": f"""
WITH {_INDEXES}, {_COMPANIES}, steps AS (
  SELECT k.*, {_STEPS.format('managed')}, {_STEPS.format('unmanaged')} FROM keyed k),
ids AS (SELECT *, coalesce(d_managed, n_managed) AS m,
  coalesce(d_unmanaged, n_unmanaged) AS u FROM steps)
SELECT company, domain, CASE WHEN m IS NOT NULL THEN 'managed' WHEN u IS NOT NULL
  THEN 'unmanaged' ELSE 'prospect' END AS segment,
  coalesce(CAST(coalesce(m, u) AS VARCHAR), '') AS id FROM ids""",
    "office_index": f"WITH {_OFFICES} SELECT domain, market, n, first_row FROM counts",
    "known_and_primary_markets": f"""
WITH {_OFFICES} SELECT domain,
  coalesce(string_agg(market, ', ' ORDER BY market) FILTER (market <> 'Other'), '')
    AS known_markets,
  coalesce(first(market ORDER BY n DESC, first_row) FILTER (market <> 'Other'), 'Other')
    AS primary_market
FROM counts GROUP BY domain""",
    "office_cities": f"""
WITH {_OFFICES}, cities AS (
  SELECT domain, min(row_no) AS r, arg_min(city, row_no) AS city, arg_min(state, row_no) AS state,
    arg_min(market, row_no) AS market FROM offices GROUP BY domain, lower(city), lower(state))
SELECT domain, '[' || string_agg('{{"city":"' || city || '","state":"' || state ||
  '","market":"' || market || '"}}', ',' ORDER BY r) || ']' AS cities
FROM cities GROUP BY domain""",
    "expansion_flag": f"""
WITH {_SIGNALS} SELECT s.supplier, s.market, s.jd_count,
  CASE WHEN k.market IS NULL THEN 'expansion' ELSE 'existing' END AS loc_type
FROM signals s LEFT JOIN known k ON s.supplier = k.supplier AND s.market = k.market""",
    "expansion_markets": f"""
WITH {_SIGNALS} SELECT s.supplier, s.market, CASE WHEN EXISTS (SELECT 1 FROM known k
  WHERE k.supplier = s.supplier AND k.market = s.market) THEN 'old' ELSE 'new' END AS kind
FROM signals s""",
}
_MATCHED = SQL["account_match"][:SQL["account_match"].index("\nSELECT company, domain, CASE")]
SQL["account_index_reuse"] = _MATCHED + """
SELECT 'both' AS lists, CASE WHEN m IS NOT NULL THEN 'managed' WHEN u IS NOT NULL THEN 'unmanaged'
  ELSE 'prospect' END AS segment, count(*) AS companies, count(coalesce(m, u)) AS matched FROM ids GROUP BY ALL
UNION ALL SELECT 'managed', CASE WHEN m IS NOT NULL THEN 'managed' ELSE 'prospect' END, count(*), count(m)
FROM ids GROUP BY ALL"""
