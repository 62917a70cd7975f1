"""Queries of liveness checks, alerts and faceted views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scoring as S, text as X
from ..lexicon import SOURCE_LABELS
from ..operators import alerts as AL, explore as E, liveness as L, velocity as V
from ..sources import tables
from . import sql as Q
from .data import postings, table, weekly_events

_PHRASES = (("blog.", ("thing of", "tion that the")), ("example.org", ("erly and",)),
            ("boards-api.greenhouse.io", ("nothing here",)), ("", ("nerth the", "ring thes")))


def _crawl(spark, sf):
    """Pages as a crawl: status and fetch errors follow from the text, JSON bodies from it."""
    p = table(spark, sf, "pages")
    digit = F.substring(F.md5("url"), 1, 1)
    api = digit.isin("a", "b")
    url = (F.when(digit == "a", F.concat(F.lit("https://boards-api.greenhouse.io/v1/"),
                                         "page_id"))
           .when(digit == "b", F.concat(F.lit("https://api.ashbyhq.com/"), "page_id"))
           .when(digit == "c", F.concat(F.lit("ftp://"), "page_id")).otherwise(F.col("url")))
    listed = F.contains("html", F.lit("ouble"))
    body = F.when(api, F.to_json(F.struct(
        listed.alias("is_listed"), F.when(listed, "Published").otherwise("Archived")
        .alias("status")))).otherwise(F.col("html"))
    status = (F.when(digit == "0", 404).when(digit == "1", 410).when(digit == "2", 500)
              .when(digit == "3", 301).otherwise(200))
    error = (F.when(digit == "4", "timeout").when(digit == "5", "connection")
             .when(digit == "6", "bad chunk"))
    return p.select("page_id", url.alias("url"), status.alias("status"), body.alias("body"),
                    error.alias("fetch_error"))


def liveness(spark, sf):
    checked = L.check(_crawl(spark, sf), _PHRASES)
    return checked.select("url", F.col("is_live").cast("int").alias("is_live"), "reason")


def liveness_default_phrases(spark, sf):
    """The shipped phrase table on documents, some closed by a phrase of their host."""
    d = table(spark, sf, "documents").select(
        F.concat(F.lit("https://"), F.when(F.col("lang") == "fr", "jobs.lever.co").when(
            F.col("lang") == "de", "www.linkedin.com").otherwise("example.com"), F.lit("/"),
            "doc_id").alias("url"), F.lit(200).alias("status"),
        F.when(F.contains("text", F.lit("ungen")), F.concat("text", F.lit(
            " This Job is CLOSED."))).when(F.contains("text", F.lit("reau")), F.concat(
                F.lit("Position has been filled: "), "text")).otherwise(
                F.col("text")).alias("body"), F.lit(None).cast("string").alias("fetch_error"))
    return X.keep(L.check(d), ~F.col("is_live")).select("url", "reason")


def verified_postings(spark, sf):
    """Postings kept by the verdicts of their hosts' pages; unknown pages stay."""
    crawl = _crawl(spark, sf).withColumn("url", F.concat(F.lit("doc "), "page_id"))
    jobs = postings(spark, sf).withColumn("url", F.concat(F.lit("doc "), "ingest_seq"))
    pages = crawl.withColumn("url", F.when(F.col("status") == 200, F.concat(
        F.lit("http-"), "page_id")).otherwise(F.col("url")))
    jobs = jobs.withColumn("url", F.concat(F.lit("http-"), "ingest_seq"))
    # an older crawl of every page says the opposite and must not count
    older = pages.withColumns({"status": F.when(F.col("status") == 200, 404).otherwise(200),
                               "body": F.lit(""), "fetched_at": F.lit("2024-01-01")})
    both = pages.withColumn("fetched_at", F.lit("2024-02-01")).unionByName(older)
    return L.verify(jobs, both, _PHRASES).select("ingest_seq", "company")


# --- alerts ---------------------------------------------------------------------------------

_CHANNELS = ["HOOK_A", "SLACK_WEBHOOK_UNMANAGED_URL", "SLACK_WEBHOOK_URL"]


def _territories(spark, sf):
    """Two thirds of the nations as territories, with a default row."""
    n = table(spark, sf, "nation").where("n_regionkey < 3 or n_nationkey = 4")
    region = F.col("n_regionkey")
    return n.select(
        F.when(F.col("n_nationkey") == 4, "Other").otherwise(F.col("n_name")).alias("market"),
        F.when(region == 0, "Unassigned").otherwise(F.concat(F.lit("Rep "), "n_nationkey"))
        .alias("rep_name"),
        F.when(region == 1, F.concat(F.lit("U"), "n_nationkey")).otherwise("").alias(
            "slack_handle"),
        F.when(region == 2, "HOOK_B").when(region == 1, "").otherwise("HOOK_A").alias(
            "webhook_env_var"))


def _new_companies(spark, sf):
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    name = F.col("c_name")
    rich, thin = F.col("c_acctbal") >= 6500, F.col("c_acctbal") < 3000
    return (c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        name.alias("company"), F.when(rich, "managed").when(thin, "prospect").otherwise(
            "unmanaged").alias("segment"),
        F.when(F.col("n_nationkey") == 2, "").otherwise(F.col("n_name")).alias("market"),
        F.floor(F.col("c_acctbal")).alias("gtm_score"),
        F.length("c_mktsegment").alias("role_count"),
        F.when(thin, "Lever").otherwise("Other Feed").alias("best_source"),
        F.lower("c_mktsegment").alias("top_keywords"),
        F.concat(F.lit("https://x/"), "c_custkey").alias("sample_url"),
        F.when(rich, F.col("c_mktsegment")).otherwise("").alias("ezcater_vertical"),
        F.when(thin, "").otherwise(F.concat(F.lit("...perk \"of\" "), "c_name")).alias(
            "perk_excerpt"),
        F.when(F.col("c_mktsegment") == "BUILDING", "Boston, Miami").otherwise("").alias(
            "expansion_confirmed"),
        F.when(F.col("c_mktsegment") != "MACHINERY", "Denver").otherwise("").alias(
            "expansion_possible")))


def _flags(spark, sf):
    flags = V.accelerating(weekly_events(spark, sf))
    return flags.withColumn("company_name", F.concat(
        F.lit("CUSTOMER#"), F.lpad(F.col("company_name").cast("string"), 9, "0")))


def territory_fallback(spark, sf):
    rows = AL.with_territory(_new_companies(spark, sf), _territories(spark, sf))
    key = AL.channel(F.col("webhook_env_var"), F.col("segment"), _CHANNELS)
    return rows.select("company", "rep_name", F.coalesce(key, F.lit("-")).alias("channel"),
                       AL.rep_tag(F.col("slack_handle"), F.col("rep_name")).alias("tag"))


def group_topk_more(spark, sf):
    o = table(spark, sf, "orders")
    top = AL.top_per_group(o, ["o_orderpriority", "o_orderstatus"],
                           [F.desc("o_totalprice"), F.col("o_orderkey")], 10)
    return top.select("o_orderkey", "o_orderpriority", "o_orderstatus", "position", "total",
                      "more")


def _alert_rows(spark, sf):
    return AL.alert_rows(_new_companies(spark, sf), _flags(spark, sf), _territories(spark, sf),
                         _CHANNELS)


def alert_rows(spark, sf):
    return _alert_rows(spark, sf).select("channel_key", "segment", "group_market", "position",
                                         "company", "text")


def alert_payloads(spark, sf):
    return AL.payloads(_alert_rows(spark, sf), "January 31, 2024", F.lit(99))


# --- views ----------------------------------------------------------------------------------

def _companies(spark, sf):
    """Parts as the company table of the dashboard."""
    p = table(spark, sf, "part")
    word = F.split("p_name", " ")
    score = F.col("p_size") + F.length("p_type")
    return p.select(
        F.concat_ws(" ", "p_name", "p_partkey").alias("company"),
        F.concat(word[1], F.lit(".com")).alias("inferred_domain"), score.alias("gtm_score"),
        S.confidence(score).alias("confidence"), S.icp_tier(score).alias("icp_tier"),
        F.col("p_size").alias("unique_roles_with_perk"), F.col("p_size").alias("role_count"),
        F.concat_ws(", ", word[0], word[1], F.lower("p_type")).alias("top_keywords"),
        F.col("p_brand").alias("best_source"),
        F.concat_ws(", ", "p_brand", F.initcap(word[0])).alias("all_sources"),
        F.concat(F.lit("Hall "), "p_size", F.lit(", East")).alias("location"),
        F.lit("On-site").alias("remote"), F.upper("p_name").alias("sample_title"),
        F.when(F.col("p_size") > 30, F.concat(F.lit("say \"hi\", "), word[0])).otherwise(
            "").alias("sample_url"), F.lit("2024-01-01").alias("date_first_seen"),
        F.col("p_type").alias("segment"), word[1].alias("market"),
        F.when(F.col("p_size") < 12, 1).otherwise(0).alias("is_new"),
        F.when(F.col("p_size") > 25, "noise").otherwise("existing_confirmed").alias(
            "loc_signal_strength"), F.col("p_name").alias("perk_excerpt"))


def faceted_search(spark, sf):
    found = E.faceted_search(
        _companies(spark, sf), {"segment": ["PROMO", "SMALL"], "market": ["bolt", "ring", "rod"],
                                "confidence": ["High", "Low"]},
        keywords=["red", "lar"], text=" brand#1 ", new_only=False)
    return found.orderBy(*E.card_order("new_first")).select("company", "gtm_score", "is_new")


def conversation_search(spark, sf):
    """The same search over turns: role as facet, words as keywords, free text."""
    c = table(spark, sf, "conversations")
    return E.faceted_search(c, {"role": ["user", "system"]}, keywords=["the", "de"],
                            keyword_column="text", text="EN", searched=("text", "role")
                            ).select("conv_id", "turn", "role")


def table_search(spark, sf):
    found = E.table_search(_companies(spark, sf), text="Hall 3", tier="Very Viable",
                           confidence="High", source="Brand#2")
    return E.sort_table(found, "gtm_score", descending=True).select("company", "gtm_score")


def card_orders(spark, sf):
    """Place of every company in each card order."""
    c = _companies(spark, sf).select("company", "gtm_score", "role_count", "is_new")
    parts = []
    for mode in ("gtm_score", "role_count", "company", "new_first"):
        parts.append(E.with_place(c, *E.card_order(mode)).select(
            F.lit(mode).alias("mode"), "company", "place"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def facet_counts_topk(spark, sf):
    return E.keyword_facets(_companies(spark, sf))


def facet_values(spark, sf):
    c = _companies(spark, sf)
    markets = E.facet_values(c, "market").withColumn("facet", F.lit("market"))
    return markets.unionByName(E.facet_values(c, "best_source").withColumn(
        "facet", F.lit("source")))


def dashboard_kpis(spark, sf):
    return E.kpis(_companies(spark, sf))


def dashboard_export(spark, sf):
    """History records as JSON with derived tiers."""
    history = _companies(spark, sf).select(F.col("company").alias("name"), "gtm_score",
                                           F.when(F.col("is_new") == 1, F.col("market"))
                                           .alias("market"))
    return tables.dashboard_records(history, S.confidence, S.icp_tier)


def export_rows(spark, sf):
    return E.export_columns(E.faceted_search(_companies(spark, sf), new_only=True))


QUERIES = {f.__name__: f for f in (
    liveness, liveness_default_phrases, verified_postings, territory_fallback, group_topk_more,
    alert_rows, alert_payloads, faceted_search, conversation_search, table_search, card_orders,
    facet_counts_topk, facet_values, dashboard_kpis, dashboard_export, export_rows)}

_CRAWL = """raw AS (SELECT *, substring(md5(url), 1, 1) AS digit FROM pages),
crawl AS (
  SELECT page_id, digit, CASE digit WHEN 'a' THEN 'https://boards-api.greenhouse.io/v1/' || page_id
      WHEN 'b' THEN 'https://api.ashbyhq.com/' || page_id WHEN 'c' THEN 'ftp://' || page_id
      ELSE url END AS url,
    CASE digit WHEN '0' THEN 404 WHEN '1' THEN 410 WHEN '2' THEN 500 WHEN '3' THEN 301 ELSE 200
      END AS status,
    contains(html, 'ouble') AS listed, lower(html) AS body,
    regexp_extract(url, '://([^/?#]*)', 1) AS host FROM raw),
judged AS (
  SELECT *, CASE WHEN digit IN ('a', 'b') THEN NULL
    WHEN contains(host, 'blog.') AND contains(body, 'thing of') THEN 'thing of'
    WHEN contains(host, 'blog.') AND contains(body, 'tion that the') THEN 'tion that the'
    WHEN contains(host, 'example.org') AND contains(body, 'erly and') THEN 'erly and'
    WHEN contains(body, 'nerth the') THEN 'nerth the'
    WHEN contains(body, 'ring thes') THEN 'ring thes' END AS phrase FROM crawl),
verdicts AS (
  SELECT *, CASE WHEN digit = 'c' THEN 'invalid URL' WHEN digit = '4'
      THEN 'timeout (assumed live)' WHEN digit = '5' THEN 'connection error' WHEN digit = '6'
      THEN 'error (bad chunk) — assumed live' WHEN status IN (404, 410, 500)
      THEN 'HTTP ' || status WHEN phrase IS NOT NULL THEN 'page says: ''' || phrase || ''''
      WHEN digit = 'a' AND NOT listed THEN 'greenhouse: is_listed=false'
      WHEN digit = 'b' AND NOT listed THEN 'ashby status: archived' ELSE 'live' END AS reason
  FROM judged),
final AS (SELECT *, CASE WHEN reason = 'live' OR digit IN ('4', '6') THEN 1 ELSE 0 END AS is_live
  FROM verdicts)"""

_TERRITORY = """t AS (
  SELECT CASE WHEN n_nationkey = 4 THEN 'Other' ELSE n_name END AS market,
    CASE WHEN n_regionkey = 0 THEN 'Unassigned' ELSE 'Rep ' || n_nationkey END AS rep,
    CASE WHEN n_regionkey = 1 THEN 'U' || n_nationkey ELSE '' END AS handle,
    CASE n_regionkey WHEN 2 THEN 'HOOK_B' WHEN 1 THEN '' ELSE 'HOOK_A' END AS env
  FROM nation WHERE n_regionkey < 3 OR n_nationkey = 4),
c AS (
  SELECT c_custkey, c_name AS company, c_mktsegment AS seg, floor(c_acctbal) AS score,
    CASE WHEN c_acctbal >= 6500 THEN 'managed' WHEN c_acctbal < 3000 THEN 'prospect'
      ELSE 'unmanaged' END AS segment,
    CASE WHEN n_nationkey = 2 THEN '' ELSE n_name END AS market
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def _routed(market: str) -> str:
    """Companies with the territory row of ``market`` and their channel."""
    return f"""routed AS (
  SELECT *, CASE WHEN segment <> 'prospect' AND env = 'HOOK_A' THEN 'HOOK_A'
      WHEN segment = 'unmanaged' THEN 'SLACK_WEBHOOK_UNMANAGED_URL'
      ELSE 'SLACK_WEBHOOK_URL' END AS channel,
    CASE WHEN handle <> '' THEN '<@' || handle || '> ' WHEN rep <> 'Unassigned'
      THEN '@' || rep || ' ' ELSE '' END AS tag
  FROM (SELECT c.*, coalesce(t.rep, o.rep) AS rep, coalesce(t.handle, o.handle) AS handle,
    coalesce(t.env, o.env) AS env FROM {market} c LEFT JOIN t ON t.market = c.gm
    CROSS JOIN (SELECT * FROM t WHERE market = 'Other') o))"""


_ALERTS = f"""{Q.WEEKLY}, wr AS (SELECT *, row_number() OVER (PARTITION BY company_name
  ORDER BY week DESC) AS r FROM weekly),
acc AS (SELECT 'Customer#' || lpad(CAST(company_name AS VARCHAR), 9, '0') AS company
  FROM wr GROUP BY company_name HAVING max(signal_count) FILTER (r = 1)
    > max(signal_count) FILTER (r = 2)),
{_TERRITORY},
g AS (SELECT *, CASE WHEN segment = 'prospect' THEN '' WHEN market = '' THEN 'Other'
  ELSE market END AS gm FROM c),
ranked AS (SELECT *, row_number() OVER w AS position, count(*) OVER (PARTITION BY segment, gm)
  AS total FROM g WINDOW w AS (PARTITION BY segment, gm ORDER BY score DESC, company)),
top AS (SELECT * FROM ranked WHERE position <= 10), {_routed('top')},
texts AS (
  SELECT routed.*, CASE WHEN segment = 'managed' THEN ':rotating_light: *MANAGED ACCT*  '
      ELSE '' END || '*<https://x/' || c_custkey || '|' || routed.company || '>*  `score: ' ||
    CAST(score AS BIGINT) || '`' || CASE WHEN market = '' THEN '' ELSE ' :round_pushpin: ' ||
      market END || CASE WHEN segment = 'managed' THEN '  `' || seg || '`' ELSE '' END ||
    CASE WHEN acc.company IS NULL THEN '' ELSE '  :fire: *Accelerating*' END || chr(10) ||
    CASE WHEN segment = 'prospect' THEN {Q.lit(SOURCE_LABELS['Lever'])}
      ELSE ':white_circle: Other Feed' END || chr(10) || ':pushpin: _' || length(seg) ||
    ' roles mentioning food perks_ — `' || lower(seg) || '`' || chr(10) ||
    CASE WHEN seg = 'BUILDING' THEN chr(10) || ':construction: *Expanding to: Boston, Miami* '
      || '— new office signal from JDs' WHEN seg <> 'MACHINERY' THEN chr(10) ||
      ':construction: Possible expansion: Denver — watch list' ELSE '' END ||
    CASE WHEN segment = 'prospect' THEN '' ELSE chr(10) || '> "...perk "of" ' || routed.company
      || '"' || chr(10) END AS text
  FROM routed LEFT JOIN acc ON acc.company = routed.company)"""

_PAYLOAD = f"""WITH {_ALERTS}, groups AS (
  SELECT channel, segment, gm, max(total) AS n, max(tag) AS tag,
    CASE WHEN max(total) > 1 OR max(total) = 0 THEN 's' ELSE '' END AS pl,
    string_agg('{{"type":"section","text":{{"type":"mrkdwn","text":' || to_json(text) || '}}}}',
      ',' ORDER BY position) AS sections FROM texts GROUP BY channel, segment, gm),
words AS (
  SELECT *, CASE segment
      WHEN 'managed' THEN ':briefcase: ' || n || ' Managed Account' || pl || ' — ' || gm
      WHEN 'unmanaged' THEN ':dart: ' || n || ' Unmanaged Account' || pl || ' — ' || gm
      ELSE ':fork_and_knife: ' || n || ' New Lunch Perk Prospects' END AS header,
    CASE segment WHEN 'managed' THEN tag || 'January 31, 2024  •  Rep-owned accounts with '
        || 'active food perk hiring activity'
      WHEN 'unmanaged' THEN tag || 'January 31, 2024  •  Unmanaged accounts with '
        || 'active food perk hiring activity'
      ELSE 'January 31, 2024  •  99 total companies in database' END AS context,
    '_...and ' || (n - 10) || CASE segment WHEN 'managed' THEN ' more managed accounts in '
        || gm || '._' WHEN 'unmanaged' THEN ' more unmanaged accounts in ' || gm || '._'
      ELSE ' more. Open the dashboard to see all._' END AS more,
    CASE segment WHEN 'managed' THEN ':bulb: These rep-owned accounts are actively hiring '
        || 'roles that mention food perks.' WHEN 'unmanaged' THEN ':bulb: These unmanaged '
        || 'accounts are actively hiring roles that mention food perks.'
      ELSE ':bulb: These companies mention food perks (DoorDash, GrubHub, free lunch, catered '
        || 'meals, etc.) in job postings. All listings verified live as of today.' END AS closing,
    CASE segment WHEN 'managed' THEN ':briefcase: ' || n || ' managed accounts with food perk '
        || 'signal — ' || gm WHEN 'unmanaged' THEN ':dart: ' || n || ' unmanaged accounts with '
        || 'food perk signal — ' || gm
      ELSE ':fork_and_knife: ' || n || ' new lunch perk prospects found' END AS summary
  FROM groups)
SELECT channel AS channel_key, segment, gm AS market, n, '{{"text":' || to_json(summary) ||
  ',"blocks":[{{"type":"header","text":{{"type":"plain_text","text":' || to_json(header) ||
  ',"emoji":true}}}},{{"type":"context","elements":[{{"type":"mrkdwn","text":' ||
  to_json(context) || '}}]}},{{"type":"divider"}},' || sections ||
  CASE WHEN n > 10 THEN ',{{"type":"section","text":{{"type":"mrkdwn","text":' ||
    to_json(more) || '}}}}' ELSE '' END ||
  ',{{"type":"divider"}},{{"type":"context","elements":[{{"type":"mrkdwn","text":' ||
  to_json(closing) || '}}]}}]}}' AS payload_json FROM words"""

_VIEW = f"""v AS (
  SELECT p_name || ' ' || p_partkey AS company, string_split(p_name, ' ')[1] AS w1,
    string_split(p_name, ' ')[2] AS w2, p_size + length(p_type) AS gtm_score, p_size, p_type,
    p_brand, p_name, string_split(p_name, ' ')[1] || ', ' || string_split(p_name, ' ')[2] ||
      ', ' || lower(p_type) AS top_keywords, 'Hall ' || p_size || ', East' AS location,
    CASE WHEN p_size < 12 THEN 1 ELSE 0 END AS is_new FROM part),
companies AS (SELECT *, {Q.confidence('gtm_score')} AS confidence, {Q.tier('gtm_score')}
  AS icp_tier, p_brand || ', ' || upper(w1[1]) || substring(w1, 2) AS all_sources FROM v)"""


def _ordered(mode: str, order: str) -> str:
    return (f"(SELECT '{mode}' AS mode, company, row_number() OVER (ORDER BY {order}, company) "
            "AS place FROM companies)")


SQL = {
    "liveness": f"WITH {_CRAWL} SELECT url, is_live, reason FROM final",
    "liveness_default_phrases": """
SELECT 'https://' || CASE lang WHEN 'fr' THEN 'jobs.lever.co' WHEN 'de' THEN 'www.linkedin.com'
  ELSE 'example.com' END || '/' || doc_id AS url,
  CASE WHEN contains(text, 'ungen') THEN CASE WHEN lang = 'de' THEN
    'page says: ''this job is closed''' ELSE 'page says: ''job is closed''' END
    ELSE 'page says: ''position has been filled''' END AS reason
FROM documents WHERE contains(text, 'ungen') OR (contains(text, 'reau') AND lang = 'fr')""",
    "verified_postings": f"""
WITH {Q.POSTINGS}, {_CRAWL.replace("contains(host, 'blog.')", "false").replace(
        "contains(host, 'example.org')", "false")}
SELECT doc_id AS ingest_seq, company FROM postings p LEFT JOIN final f
  ON f.page_id = p.doc_id AND f.status = 200
WHERE f.page_id IS NULL OR f.digit IN ('4', '6') OR (f.digit <> '5' AND f.phrase IS NULL)""",
    "territory_fallback": f"""
WITH {_TERRITORY}, g AS (SELECT *, market AS gm FROM c), {_routed('g')}
SELECT company, rep AS rep_name, channel, tag FROM routed""",
    "group_topk_more": """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus
  ORDER BY o_totalprice DESC, o_orderkey) AS position,
  count(*) OVER (PARTITION BY o_orderpriority, o_orderstatus) AS total FROM orders)
SELECT o_orderkey, o_orderpriority, o_orderstatus, position, total, greatest(total - 10, 0)
  AS more FROM r WHERE position <= 10""",
    "alert_rows": f"WITH {_ALERTS} SELECT channel AS channel_key, segment, gm AS group_market, "
                  "position, company, text FROM texts",
    "alert_payloads": _PAYLOAD,
    "faceted_search": f"""
WITH {_VIEW} SELECT company, gtm_score, is_new FROM companies
WHERE p_type IN ('PROMO', 'SMALL') AND w2 IN ('bolt', 'ring', 'rod')
  AND confidence IN ('High', 'Low') AND (contains(top_keywords, 'red')
    OR contains(top_keywords, 'lar')) AND contains(lower(company || ' ' || top_keywords || ' '
    || p_brand || ' ' || location), 'brand#1')""",
    "conversation_search": """
SELECT conv_id, turn, role FROM conversations WHERE role IN ('user', 'system')
  AND (contains(text, 'the') OR contains(text, 'de'))
  AND contains(lower(text || ' ' || role), 'en')""",
    "table_search": f"""
WITH {_VIEW} SELECT company, gtm_score FROM companies WHERE icp_tier = 'Very Viable'
  AND confidence = 'High' AND contains(all_sources, 'Brand#2') AND contains(lower(company || ' '
  || top_keywords || ' ' || location || ' ' || p_brand || ' ' || all_sources || ' ' || p_name),
  'hall 3')""",
    "card_orders": f"WITH {_VIEW} " + " UNION ALL ".join((
        _ordered("gtm_score", "gtm_score DESC"), _ordered("role_count", "p_size DESC"),
        _ordered("company", "lower(company)"),
        _ordered("new_first", "is_new DESC, gtm_score DESC"))),
    "facet_counts_topk": f"""
WITH {_VIEW} SELECT keyword, count(*) AS companies FROM (SELECT unnest(string_split(top_keywords,
  ', ')) AS keyword FROM companies) GROUP BY keyword ORDER BY companies DESC, keyword LIMIT 15""",
    "facet_values": f"WITH {_VIEW} SELECT DISTINCT w2 AS value, 'market' AS facet FROM companies "
                    "UNION ALL SELECT DISTINCT p_brand, 'source' FROM companies",
    "dashboard_kpis": f"""
WITH {_VIEW} SELECT count(*) AS total, count(*) FILTER (is_new = 1) AS new,
  count(*) FILTER (confidence = 'High') AS high, count(*) FILTER (icp_tier = 'Viable') AS viable
FROM companies""",
    "dashboard_export": f"""
WITH {_VIEW} SELECT '{{"name":"' || company || '","gtm_score":' || gtm_score || ',"market":' ||
  CASE WHEN is_new = 1 THEN '"' || w2 || '"' ELSE 'null' END || ',"company":"' || company ||
  '","confidence":"' || confidence || '","icp_tier":"' || icp_tier || '"}}' AS value
FROM companies""",
    "export_rows": f"""
WITH {_VIEW} SELECT company, w2 || '.com' AS inferred_domain, gtm_score, confidence, icp_tier,
  p_size AS unique_roles_with_perk, top_keywords, p_brand AS best_source, all_sources, location,
  'On-site' AS remote, upper(p_name) AS sample_title, '' AS sample_url,
  '2024-01-01' AS date_first_seen FROM companies WHERE is_new = 1""",
}
