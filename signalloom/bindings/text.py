"""Queries of the text, scoring and name expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names as N, scoring as S, text as X
from ..lexicon import CITY_MARKETS, PLATFORM_SLUGS
from ..operators import ats, liveness, markets as M
from ..operators.rollup import with_scores
from . import sql as Q
from .data import LEXICON, PLAIN, RUBRIC, WEIGHTS, documents, table


def lexicon_match(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    d = X.matched_only(X.with_hits(d, "text", PLAIN).drop("text"))
    return d.select("doc_id", X.join_list(F.col("kw")).alias("kws"),
                    F.size("kw").cast("long").alias("n_kw"))


def lexicon_context_match(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    d = X.matched_only(X.with_hits(d, "text", LEXICON).drop("text"))
    return d.select("doc_id", X.join_list(F.col("kw")).alias("kws"),
                    F.size("kw").cast("long").alias("n_kw"))


def term_fallback(spark, sf):
    """The row's own term stands in where the lexicon finds nothing and the text holds it."""
    d = X.with_hits(documents(spark, sf), "text", LEXICON)
    term = F.when(F.col("lang") == "en", "ering").otherwise("rien")
    held = F.contains(F.lower("text"), term)
    kw = F.when(F.size("kw") > 0, F.col("kw")).when(held, F.array(term))
    return X.matched_only(d.select("doc_id", kw.alias("kw"))).select(
        "doc_id", X.join_list(F.col("kw")).alias("kws"))


def text_excerpt(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", X.excerpt(F.col("text"), F.lit("tion")).alias("snippet"),
                    X.excerpt(F.col("text"), F.col("lang")).alias("lang_snippet"))


def location_filter(spark, sf):
    d = documents(spark, sf)
    return d.where(X.in_location(F.concat_ws(" ", "place", "text"), ("nyc", "reau", "tx,"))
                   ).select("doc_id", "place")


def html_clean(spark, sf):
    p = table(spark, sf, "pages").select("page_id", "html")
    return X.with_clean_text(p, "html", "clean").select("page_id", "clean")


def display_excerpt(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", X.display_excerpt(F.col("html")).alias("shown"))


def title_extract(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", X.page_title(F.col("html")).alias("title"))


def page_state(spark, sf):
    """State JSON wrapped into pages and read back out."""
    p = table(spark, sf, "pages")
    state = F.to_json(F.struct(F.struct("page_id", "url").alias("props")))
    page = F.concat(F.col("html"), F.lit('<script id="__NEXT_DATA__" type="x">'), state,
                    F.lit("</script><script>0</script>"))
    got = F.from_json(X.page_state(page), "props struct<page_id bigint, url string>")
    return p.select(got["props"]["page_id"].alias("page_id"), got["props"]["url"].alias("url"))


def url_host(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", X.url_host(F.col("url")).alias("host"))


_PHRASES = (("blog.", ("thing of", "tion that")), ("example.org", ("ouble", "license")),
            ("", ("nerth the", "onthe", "ring the")))


def closed_phrase_sets(spark, sf):
    p = table(spark, sf, "pages")
    listed = liveness.closed_phrases(F.col("url"), _PHRASES)
    return p.select("page_id", F.array_join(listed, "; ").alias("phrases"))


def _with_board_url(spark, sf):
    """Board urls built from each page's host and path language."""
    p = table(spark, sf, "pages")
    label = F.translate(F.regexp_extract("url", r"^https?://([^./]+\.[^./]+)", 1), ".", "-")
    lang = F.regexp_extract("url", r"\.example\.[a-z]+/([a-z]+)", 1)
    number = F.col("page_id").cast("string")
    board = (F.when(lang == "en", F.concat(F.lit("https://boards.greenhouse.io/"), label,
                                           F.lit("/jobs/"), number))
             .when(lang == "fr", F.concat(F.lit("https://jobs.lever.co/"), label, F.lit("/"),
                                          number))
             .when(lang == "de", F.concat(F.lit("https://jobs.ashbyhq.com/en/"), number))
             .otherwise(F.concat(F.lit("https://"), label,
                                 F.lit(".wd5.myworkdayjobs.com/x/"), number)))
    return p.withColumn("label", label).withColumn("lang", lang).withColumn("board", board)


def url_employer(spark, sf):
    return _with_board_url(spark, sf).select(
        "page_id", N.employer_from_url(F.col("board"), PLATFORM_SLUGS).alias("employer"))


def ats_fingerprint(spark, sf):
    p = _with_board_url(spark, sf)
    found = ats.fingerprint(p.withColumn("t", F.concat_ws(" ", "html", "board")), "t")
    return found.select("page_id", F.coalesce("ats_type", F.lit("")).alias("ats_type"),
                        F.coalesce("ats_slug", F.lit("")).alias("ats_slug"))


def keyword_score(spark, sf):
    d = table(spark, sf, "documents")
    d = d.select("doc_id", F.lower("text").alias("lc"))
    return d.select("doc_id", S.weighted_hits("lc", WEIGHTS).cast("long").alias("score"))


_PART_RUBRIC = type(RUBRIC)(
    keyword={"small": 10, "red": 7, "bolt": 5, "red bolt": 4}, source={"ECONOMY": 8, "PROMO": 3},
    vertical={"widget": 8, "gizmo": 6, "brand#1": 4}, size={"large": 4, "eco": 3},
    persona={"ring": 5, "hot": 3}, brands=(), segment={}, boost={})


def row_score(spark, sf):
    p = table(spark, sf, "part")
    rows = p.select("p_partkey", F.col("p_brand").alias("company"), F.col("p_name").alias("title"),
                    F.col("p_type").alias("perk_excerpt"),
                    F.col("p_name").alias("food_keywords_matched"),
                    F.size(F.split("p_name", " ")).alias("keyword_count"),
                    F.col("p_type").alias("source"), F.lit("").alias("location"))
    return with_scores(rows, _PART_RUBRIC).select("p_partkey", F.col("gtm_score").alias("score"))


def score_tiers(spark, sf):
    c = table(spark, sf, "customer")
    score = F.floor(F.col("c_acctbal") / 8)
    return c.select("c_custkey", S.confidence(score).alias("confidence"),
                    S.icp_tier(score).alias("tier"), S.score_bucket(score).alias("bucket"))


def self_reference(spark, sf):
    p = table(spark, sf, "part")
    rubric = type(RUBRIC)(**{**_PART_RUBRIC.__dict__, "brands": ("bolt", "red", "promo")})
    ref = S.self_referential(F.lower(F.concat_ws(" ", "p_type", "p_brand", "p_name")),
                             F.col("p_name"), rubric)
    return p.select("p_partkey", ref.cast("int").alias("self_ref"))


def name_normalise(spark, sf):
    p = table(spark, sf, "part")
    name = F.concat_ws("", F.lit("The "), F.col("p_name"), F.lit(" Technologies, Inc. ("),
                       F.col("p_brand"), F.lit(") & Co"))
    return p.select("p_partkey", N.normalise_name(name).alias("nn"),
                    N.guess_domain(name).alias("guess"))


def domain_normalise(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", N.normalise_domain(F.upper("url")).alias("nd"))


def slug_forms(spark, sf):
    p = table(spark, sf, "pages")
    host = X.url_host(F.col("url"))
    return p.select("page_id", F.array_join(N.slug_variants(host), ",").alias("variants"),
                    X.prettify_slug(F.translate(host, ".", "_")).alias("pretty"))


def remote_infer(spark, sf):
    """The four variants, on texts made of the document's language and words."""
    d = documents(spark, sf)
    place = F.when(F.col("lang") == "fr", "Remote, EU").when(
        F.col("lang") == "de", "Hybrid / Berlin").otherwise(F.col("place"))
    body = F.replace(F.replace("text", F.lit("heed"), F.lit("hybrid")), F.lit("erly"),
                     F.lit("remote"))
    return d.select(
        "doc_id", X.infer_remote(place, body, remote_in_second=False).alias("place_then_body"),
        X.infer_remote(place, F.col("title")).alias("place_and_title"),
        X.infer_remote(place).alias("place_only"), X.infer_remote(place, body).alias("both"))


def date_forms(spark, sf):
    e = table(spark, sf, "events")
    seconds = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)")
    return e.select("event_id", X.millis_to_date(seconds * 1000).alias("from_millis"),
                    X.iso_prefix(F.col("ts").cast("string")).alias("prefix"),
                    X.iso_week(F.col("ts")).alias("week"))


def list_forms(spark, sf):
    """Blank-skipping choice, list split and join, JSON encoding."""
    p = table(spark, sf, "part")
    listed = F.concat(F.replace("p_name", F.lit(" "), F.lit(", ")), F.lit(", "), F.col("p_type"),
                      F.lit(", , "))
    return p.select(
        "p_partkey", X.first_nonblank(F.when(F.col("p_size") < 20, F.lit("  ")).otherwise(
            F.col("p_name")), "p_brand").alias("chosen"),
        X.join_list(F.array_sort(X.split_list(listed))).alias("sorted_list"),
        F.to_json(F.struct("p_name", "p_size")).alias("as_json"))


def pay_labels(spark, sf):
    o = table(spark, sf, "orders")
    low = F.floor(F.col("o_totalprice")).cast("double")
    yearly = F.col("o_orderstatus") == "F"
    label = X.pay_label(low, low * 2, F.when(yearly, "yearly").otherwise("monthly"))
    return o.select("o_orderkey", label.alias("pay"))


def json_project(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


def primary_keywords(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", S.has_primary_keyword(
        F.upper("p_name"), ("red", "bolt")).cast("int").alias("is_primary"))


def market_of_location(spark, sf):
    """The 16-market rules over location texts made of document words."""
    d = documents(spark, sf)
    where = F.concat_ws(" ", F.col("place"), F.when(F.col("title").startswith("role 9"),
                                                    F.lit(", Dallas")))
    d = d.select("doc_id", F.lower(where).alias("place"), F.lower("text").alias("lc"))
    return d.select("doc_id", M.location_market("place").alias("market"),
                    M.location_market("lc", _WORD_MARKETS).alias("word_market"))


_WORD_MARKETS = (("A", ("license", "ungen")), ("B", ("ouble", "reau")), ("C", ("thing",)))


def city_market_rules(spark, sf):
    """The 35-market billing rules over customers placed in every rule's city in turn."""
    c = table(spark, sf, "customer")
    cities = F.array(*[F.lit(city.title()) for city, _, _ in CITY_MARKETS])
    states = F.array(*[F.lit((state or "Texas").title()) for _, state, _ in CITY_MARKETS])
    n = F.lit(len(CITY_MARKETS))
    c = c.withColumn("city", F.get(cities, F.pmod(F.col("c_custkey"), n).cast("int")))
    c = c.withColumn("state", F.get(states, F.pmod(F.floor(F.col("c_acctbal")), n).cast("int")))
    return c.select("c_custkey", M.city_market("city", "state").alias("market"))


def _city_sql() -> str:
    rules = CITY_MARKETS
    cities = "[" + ", ".join(Q.lit(c) for c, _, _ in rules) + "]"
    states = "[" + ", ".join(Q.lit(s or "texas") for _, s, _ in rules) + "]"
    n = len(rules)
    values = ", ".join(f"({i}, {Q.lit(c)}, {Q.lit(s) if s else 'NULL'}, {Q.lit(m)})"
                       for i, (c, s, m) in enumerate(rules))
    return f"""
WITH rules(n, city, state, market) AS (VALUES {values}),
c AS (SELECT c_custkey, ({cities})[(c_custkey % {n}) + 1] AS city,
  ({states})[CAST(((floor(c_acctbal) % {n}) + {n}) % {n} AS BIGINT) + 1] AS state
  FROM customer)
SELECT c.c_custkey, coalesce(arg_min(r.market, r.n), 'Other') AS market
FROM c LEFT JOIN rules r ON c.city = r.city AND (r.state IS NULL OR contains(c.state, r.state))
GROUP BY c.c_custkey"""


QUERIES = {f.__name__: f for f in (
    lexicon_match, lexicon_context_match, term_fallback, text_excerpt, location_filter,
    html_clean, display_excerpt, title_extract, page_state, url_host, closed_phrase_sets,
    url_employer, ats_fingerprint, keyword_score, row_score, score_tiers, self_reference,
    name_normalise, domain_normalise, slug_forms, remote_infer, date_forms, list_forms,
    pay_labels, json_project, primary_keywords, market_of_location, city_market_rules)}


def _match_sql(lexicon) -> str:
    return (f"WITH m AS (SELECT doc_id, {Q.hits('lower(text)', lexicon)} AS kw FROM documents) "
            "SELECT doc_id, array_to_string(kw, ', ') AS kws, len(kw) AS n_kw FROM m "
            "WHERE len(kw) > 0")


_TERM = "CASE lang WHEN 'en' THEN 'ering' ELSE 'rien' END"
_HOST = "lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1))"
_BOARD = """b AS (SELECT *, replace(regexp_extract(url, '^https?://([^./]+\\.[^./]+)', 1),
    '.', '-') AS label, regexp_extract(url, '\\.example\\.[a-z]+/([a-z]+)', 1) AS lang
  FROM pages)"""
_PRETTY = ("array_to_string(list_transform(string_split({0}, ' '), lambda w: "
           "upper(substring(w, 1, 1)) || lower(substring(w, 2))), ' ')")
_BODY = "replace(replace(text, 'heed', 'hybrid'), 'erly', 'remote')"
_PLACE = ("CASE lang WHEN 'fr' THEN 'Remote, EU' WHEN 'de' THEN 'Hybrid / Berlin' "
          "ELSE place END")


def _remote_sql(remote: list[str], hybrid: list[str]) -> str:
    r = " OR ".join(f"contains(lower({c}), 'remote')" for c in remote)
    h = " OR ".join(f"contains(lower({c}), 'hybrid')" for c in hybrid)
    return f"CASE WHEN {r} THEN 'Remote' WHEN {h} THEN 'Hybrid' ELSE 'On-site' END"


_PART_TEXT = "lower(p_brand || ' ' || p_name || ' ' || p_type)"

SQL = {
    "lexicon_match": _match_sql(PLAIN),
    "lexicon_context_match": _match_sql(LEXICON),
    "term_fallback": f"""
WITH m AS (SELECT doc_id, text, {Q.hits('lower(text)')} AS kw, {_TERM} AS term FROM documents)
SELECT doc_id, CASE WHEN len(kw) > 0 THEN array_to_string(kw, ', ') ELSE term END AS kws
FROM m WHERE len(kw) > 0 OR contains(lower(text), term)""",
    "text_excerpt": f"SELECT doc_id, {Q.excerpt('text', Q.lit('tion'))} AS snippet, "
                    f"{Q.excerpt('text', 'lang')} AS lang_snippet FROM documents",
    "location_filter": f"WITH {Q.DOCS} SELECT doc_id, place FROM docs WHERE "
                       + Q.any_contains("lower(place || ' ' || text)", ("nyc", "reau", "tx,")),
    "html_clean": f"SELECT page_id, {Q.clean('html')} AS clean FROM pages",
    "display_excerpt": """
SELECT page_id, substring(trim(regexp_replace(replace(regexp_replace(html, '<[^>]+>', '', 'g'),
  '&amp;', '&'), '\\s+', ' ', 'g')), 1, 160) AS shown FROM pages""",
    "title_extract": """
SELECT page_id, coalesce(nullif(trim(regexp_extract(html, '<title>([^<]+)</title>', 1)), ''),
  'Unknown Role') AS title FROM pages""",
    "page_state": "SELECT page_id, url FROM pages",
    "url_host": f"SELECT page_id, {_HOST} AS host FROM pages",
    "closed_phrase_sets": f"""
SELECT page_id, array_to_string(list_concat(
  CASE WHEN contains({_HOST}, 'blog.') THEN ['thing of', 'tion that'] ELSE [] END,
  CASE WHEN contains({_HOST}, 'example.org') THEN ['ouble', 'license'] ELSE [] END,
  ['nerth the', 'onthe', 'ring the']), '; ') AS phrases FROM pages""",
    "url_employer": f"""
WITH {_BOARD} SELECT page_id, CASE WHEN lang = 'de' THEN ''
  WHEN lang IN ('en', 'fr') THEN {_PRETTY.format("replace(label, '-', ' ')")}
  ELSE 'Wd5' END AS employer FROM b""",
    "ats_fingerprint": f"""
WITH {_BOARD} SELECT page_id, CASE lang WHEN 'en' THEN 'greenhouse' WHEN 'fr' THEN 'lever'
  WHEN 'de' THEN 'ashby' ELSE 'workday' END AS ats_type,
  CASE WHEN lang IN ('en', 'fr') THEN label WHEN lang = 'de' THEN 'en'
  ELSE regexp_extract(label, '[a-zA-Z0-9]+$') END AS ats_slug FROM b""",
    "keyword_score": f"SELECT doc_id, CAST({Q.weighted('lower(text)', WEIGHTS)} AS BIGINT) "
                     "AS score FROM documents",
    "row_score": f"""
SELECT p_partkey, CAST({Q.weighted('lower(p_name)', _PART_RUBRIC.keyword)} + 2 * 2
  + CASE p_type WHEN 'ECONOMY' THEN 8 WHEN 'PROMO' THEN 3 ELSE 0 END
  + {Q.weighted(_PART_TEXT, _PART_RUBRIC.vertical)} + {Q.weighted(_PART_TEXT, _PART_RUBRIC.size)}
  + {Q.weighted('lower(p_name)', _PART_RUBRIC.persona)} AS BIGINT) AS score FROM part""",
    "score_tiers": f"""
WITH s AS (SELECT c_custkey, CAST(floor(c_acctbal / 8) AS BIGINT) AS s FROM customer)
SELECT c_custkey, {Q.confidence('s')} AS confidence, {Q.tier('s')} AS tier,
  CASE WHEN s >= 20 THEN 'high' WHEN s >= 12 THEN 'med' ELSE 'low' END AS bucket FROM s""",
    "self_reference": """
SELECT p_partkey, CASE WHEN contains(p_name, 'bolt') OR contains(p_name, 'red') THEN 1 ELSE 0
  END AS self_ref FROM part""",
    "name_normalise": """
SELECT p_partkey, trim(regexp_replace(regexp_replace(lower(p_name || ' ' || p_brand),
  '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g')) AS nn,
  'the' || regexp_replace(lower(p_name || 'technologiesinc' || p_brand), '[^a-z0-9]', '', 'g')
  || 'co.com' AS guess FROM part""",
    "domain_normalise": """
SELECT page_id, string_split(regexp_replace(regexp_replace(regexp_replace(lower(url), '/+$',
  ''), '^https?://', ''), '^www\\.', ''), '/')[1] AS nd FROM pages""",
    "slug_forms": f"""
SELECT page_id, regexp_replace(regexp_replace({_HOST}, '\\.(com|org|edu|net|io|co).*$', ''),
  '^www\\.', '') AS variants,
  {_PRETTY.format(f"regexp_replace({_HOST}, '[._-]', ' ', 'g')")} AS pretty FROM pages""",
    "remote_infer": f"""
WITH {Q.DOCS}, t AS (SELECT doc_id, title, {_PLACE} AS p, {_BODY} AS body FROM docs)
SELECT doc_id, {_remote_sql(['p'], ['p', 'body'])} AS place_then_body,
  {_remote_sql(['p', 'title'], ['p', 'title'])} AS place_and_title,
  {_remote_sql(['p'], ['p'])} AS place_only,
  {_remote_sql(['p', 'body'], ['p', 'body'])} AS both FROM t""",
    "date_forms": f"""
SELECT event_id, strftime(ts, '%Y-%m-%d') AS from_millis, strftime(ts, '%Y-%m-%d') AS prefix,
  {Q.iso_week('ts')} AS week FROM events""",
    "list_forms": """
SELECT p_partkey, CASE WHEN p_size < 20 THEN p_brand ELSE p_name END AS chosen,
  array_to_string(list_sort(list_append(string_split(p_name, ' '), p_type)), ', ')
    AS sorted_list,
  '{"p_name":"' || p_name || '","p_size":' || p_size || '}' AS as_json FROM part""",
    "pay_labels": """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN
    '$' || CAST(floor(floor(o_totalprice) / 1000) AS BIGINT) || 'k–$' ||
    CAST(floor(floor(o_totalprice) * 2 / 1000) AS BIGINT) || 'k'
  ELSE '$' || floor(o_totalprice) || '–$' || floor(o_totalprice) * 2 || ' monthly' END AS pay
FROM orders""",
    "json_project": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k "
                    "FROM events",
    "primary_keywords": "SELECT p_partkey, CASE WHEN contains(p_name, 'red') OR "
                        "contains(p_name, 'bolt') THEN 1 ELSE 0 END AS is_primary FROM part",
    "market_of_location": f"""
WITH {Q.DOCS} SELECT doc_id, CASE lang WHEN 'en' THEN 'Austin' WHEN 'fr' THEN 'New York'
  WHEN 'de' THEN CASE WHEN starts_with(title, 'role 9') THEN 'Dallas' ELSE 'Other' END
  ELSE 'Boston' END AS market,
  CASE WHEN {Q.any_contains('lower(text)', ('license', 'ungen'))} THEN 'A'
    WHEN {Q.any_contains('lower(text)', ('ouble', 'reau'))} THEN 'B'
    WHEN contains(lower(text), 'thing') THEN 'C' ELSE 'Other' END AS word_market
FROM docs""",
    "city_market_rules": _city_sql(),
}
