"""Queries of state tables, velocity and runs."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import ats, state as ST, velocity as V
from ..session import shared_folder
from ..sources.tables import Snapshots
from . import sql as Q
from .data import TODAY, table, weekly_events

_CUT = "2024-01-20"


def _halves(spark, sf):
    """Names before the cut as history, names after it as the batch; some are in one only."""
    e = table(spark, sf, "events").withColumn(
        "name", F.concat_ws("-", "event_type", "user_id", F.col("event_id") % 3))
    grouped = lambda d: d.groupBy("name").agg(
        F.sum(F.floor("value")).alias("gtm_score"), F.max("props").alias("keywords"),
        F.min("event_type").alias("first_type"), F.count("*").alias("role_count"))
    before, after = F.col("ts") < _CUT, F.col("ts") >= _CUT
    history = grouped(e.where(before)).select(
        "name", "gtm_score", F.col("keywords").alias("top_keywords"),
        F.col("first_type").alias("domain"), F.col("role_count").alias("times_seen"),
        F.lit("2024-01-10").alias("first_seen"), F.lit("2024-01-19").alias("last_seen"),
        F.lit(1).alias("is_new"), F.when(F.col("role_count") > 3, 1).otherwise(0)
        .alias("notified"))
    batch = grouped(e.where(after)).select(
        F.upper("name").alias("company"), "gtm_score", "keywords", "first_type", "role_count")
    return history, batch


def new_vs_existing(spark, sf):
    history, batch = _halves(spark, sf)
    new = ST.new_companies(batch, history).select("company", F.lit("new").alias("kind"))
    seen = ST.seen_companies(batch, history).select("company", F.lit("seen").alias("kind"))
    return new.unionByName(seen)


def annotate_new(spark, sf):
    history, batch = _halves(spark, sf)
    return ST.annotate_new(batch, history).select("company", "is_new")


def snapshot_merge(spark, sf):
    history, batch = _halves(spark, sf)
    return ST.upsert(history, batch, ST.name_key("name"), ST.name_key("company"),
                     {"keywords": "top_keywords"}, {"company": "name", "first_type": "domain"},
                     F.lit("2024-01-31"), best="gtm_score")


def company_history(spark, sf):
    """The full 28-column merge of two rollup-like batches of suppliers and customers."""
    return ST.merge_companies(_old_history(spark, sf), _batch(spark, sf), TODAY)


def _batch(spark, sf):
    c = table(spark, sf, "customer")
    top = c.groupBy("c_nationkey", "c_mktsegment").agg(
        F.max(F.floor("c_acctbal")).alias("gtm_score"), F.count("*").alias("role_count"),
        F.min("c_name").alias("sample_title"))
    blank = F.lit("").alias
    filled = [F.lit(n).alias(n) for n in (
        "sample_url", "perk_excerpt", "best_source", "segment", "ezcater_vertical",
        "zi_industry", "loc_signal_strength", "expansion_confirmed", "expansion_possible",
        "existing_confirmed", "existing_possible", "known_markets", "office_cities",
        "location_detail", "location")]
    return top.select(
        F.concat(F.lit("N"), "c_nationkey").alias("company"), "gtm_score", "role_count",
        "sample_title", F.col("c_mktsegment").alias("market"),
        F.lower("c_mktsegment").alias("top_keywords"), blank("inferred_domain"),
        F.col("role_count").alias("location_jd_count"), *filled)


def _old_history(spark, sf):
    """A table from before the location columns were added."""
    s = table(spark, sf, "supplier").groupBy("s_nationkey").agg(
        F.max(F.floor("s_acctbal")).alias("gtm_score"), F.count("*").alias("times_seen"))
    old = s.select(F.concat(F.lit("n"), F.col("s_nationkey") + 5).alias("name"), "gtm_score",
                   "times_seen", F.lit("2023-12-01").alias("first_seen"),
                   F.lit("2024-01-01").alias("last_seen"), F.lit(1).alias("is_new"),
                   F.lit(1).alias("notified"), F.lit(1).cast("long").alias("role_count"))
    return reduce(lambda d, c: d.withColumn(c, F.lit(f"old {c}")), (
        "domain", "top_keywords", "sample_title", "sample_url", "location", "perk_excerpt",
        "source"), old)


def schema_evolution(spark, sf):
    full = ST.add_missing(_old_history(spark, sf))
    return full.select("name", "segment", "loc_signal_strength", "location_jd_count",
                       F.coalesce("market", F.lit("-")).alias("market"))


def history_scan(spark, sf):
    history, _ = _halves(spark, sf)
    return ST.history_scan(history).select("name", "company", "gtm_score")


def new_unnotified(spark, sf):
    history, _ = _halves(spark, sf)
    return ST.new_unnotified(history).select("name", "gtm_score")


def mark_notified(spark, sf):
    history, batch = _halves(spark, sf)
    marked = ST.mark_notified(history, batch)
    return marked.select("name", "notified")


def location_merge(spark, sf):
    """Signals of the late events replace those of the early ones per (user, type)."""
    e = table(spark, sf, "events")
    def signals(d):
        return d.groupBy(F.col("user_id").cast("string").alias("company_name"),
                         F.col("event_type").alias("market")).agg(
            F.count("*").alias("jd_count"))
    old = signals(e.where(F.col("ts") < _CUT)).withColumn("last_seen", F.lit("2024-01-20"))
    return ST.merge_locations(old, signals(e.where(F.col("ts") >= _CUT)), "2024-01-31")


def confirmed_offices(spark, sf):
    e = table(spark, sf, "events")
    locations = e.groupBy(F.concat(F.lit("u"), "user_id").alias("company_name"),
                          F.col("event_type").alias("market")).agg(
        F.count("*").alias("jd_count"), F.max(F.floor("value")).alias("max_kw_score"))
    locations = locations.withColumn("signal_strength", F.when(
        F.col("jd_count") >= 15, "confirmed").when(F.col("jd_count") >= 12, "possible")
        .otherwise("noise"))
    s = table(spark, sf, "supplier").select(
        F.concat(F.lit("U"), "s_suppkey").alias("name"), F.floor("s_acctbal").alias(
            "gtm_score"), F.lit("managed").alias("segment"), F.col("s_name").alias(
            "top_keywords"), F.col("s_name").alias("sample_url"))
    found = ST.confirmed_offices(locations, s, min_strength="possible")
    one = ST.confirmed_offices(locations, s, market="view", exact_names=True)
    return found.withColumn("kind", F.lit("any")).unionByName(
        one.withColumn("kind", F.lit("exact"))).select(
        "kind", "company_name", "market", "jd_count", "signal_strength",
        F.coalesce("gtm_score", F.lit(-1)).alias("gtm_score"),
        F.coalesce("segment", F.lit("-")).alias("segment"))


def _cache(spark, sf):
    o = table(spark, sf, "orders")
    return o.groupBy(F.concat(F.lit("d"), "o_custkey").alias("domain")).agg(
        F.min("o_orderpriority").alias("ats_type"), F.min("o_orderstatus").alias("ats_slug"),
        F.max("o_orderdate").cast("date").cast("string").alias("checked_at"))


_ATS_TODAY = "2001-10-01"


def ttl_sweep(spark, sf):
    fresh = ST.fresh_cache(_cache(spark, sf), F.lit(_ATS_TODAY).cast("date"))
    return fresh.select("domain", "checked_at")


def velocity_sweep(spark, sf):
    kept = V.recent_weeks(weekly_events(spark, sf), F.lit("2024-02-05").cast("date"), 2)
    return kept.select("company_name", "week", "signal_count")


def ats_resolution(spark, sf):
    """Fresh cache, else probe, else search; with the updated cache beside it."""
    day = F.lit(_ATS_TODAY).cast("date")
    cache = _cache(spark, sf)
    c = table(spark, sf, "customer")
    accounts = c.select(F.concat(F.lit("d"), "c_custkey").alias("domain_key"))
    probes = c.where(F.col("c_acctbal") > 2000).select(
        F.concat(F.lit("d"), "c_custkey").alias("domain"), F.lower("c_mktsegment").alias(
            "ats_type"), F.lower("c_name").alias("ats_slug"))
    resolved = ats.resolve(accounts, cache, probes, day)
    merged = ST.merge_ats_cache(ST.fresh_cache(cache, day), ats.cache_updates(resolved),
                                _ATS_TODAY)
    return (resolved.select(F.lit("resolved").alias("kind"), "ats_type", F.col(
        "domain_key").alias("domain"), "ats_slug")
        .unionByName(merged.select(F.concat(F.lit("cache "), "checked_at").alias("kind"),
                                   "ats_type", "domain", "ats_slug")))


def ats_distribution(spark, sf):
    return ats.distribution(_cache(spark, sf))


def supported_boards(spark, sf):
    cache = _cache(spark, sf)
    return ats.supported(cache, ("1-URGENT", "2-HIGH"), need_slug=True).select(
        "domain", "ats_type")


def incremental_merge(spark, sf):
    """The merge of one batch into a stored history, by buckets of which only the touched are written."""
    history, batch = _halves(spark, sf)
    store = Snapshots(spark, shared_folder(spark, "history"))
    key, n = ST.name_key("name"), 64
    store.replace("history", history.withColumn("bucket", ST.bucket_of(key, n)), 1, "first", "bucket", ())
    store.commit("2024-01-19", 1, "first")
    touched = ST.touched_parts(store.parts("history", 1), batch, ST.name_key("company"), n)
    merged = ST.upsert(store.load(touched, history.schema), batch, key, ST.name_key("company"),
                       {"keywords": "top_keywords"}, {"company": "name", "first_type": "domain"},
                       F.lit("2024-01-31"), best="gtm_score").drop("new_this_run")
    store.replace("history", merged.withColumn("bucket", ST.bucket_of(key, n)), 2, "second", "bucket", touched)
    store.commit("2024-01-31", 2, "second")
    return store.read("history", 2, history.schema)


def velocity_manifest(spark, sf):
    """A log of one run a week; the run of the last week drops weeks that are too old from the list of parts."""
    weekly = weekly_events(spark, sf)
    store, version = Snapshots(spark, shared_folder(spark, "log")), 0
    oldest = V.first_kept_week(date(2024, 2, 5), 2)
    weeks = sorted(r["week"] for r in weekly.select("week").distinct().collect())
    for week in weeks:
        version += 1
        store.add("log", weekly.where(F.col("week") == week), version, week, f"{week} {week}",
                  keep=lambda part: week != weeks[-1] or part.split(" ")[0] >= oldest)
        store.commit(week, version, week)
    return store.read("log", version, weekly.schema).select("company_name", "week", "signal_count")


def velocity_table(spark, sf):
    return weekly_events(spark, sf)


_TYPES = ("click", "error", "purchase", "signup", "view")


def _type_run(spark, sf, name, run_id, shift=0):
    """One run's contributions: events of a type, their weeks moved by ``shift`` days."""
    e = table(spark, sf, "events").where(F.col("event_type") == name)
    return e.groupBy(F.col("user_id").cast("string").alias("company_name"),
                     X.iso_week(F.date_add(F.col("ts").cast("date"), shift)).alias("week")).agg(
        F.count("*").alias("signal_count"), F.max("props").alias("keyword_set")
    ).withColumn("run_id", F.lit(run_id))


def velocity_merge(spark, sf):
    """Runs by event type; the last run is replayed and must not count twice."""
    log = _type_run(spark, sf, "click", "click")
    for name in (*_TYPES[1:], _TYPES[-1]):
        log = V.add_run(log, _type_run(spark, sf, name, name), name)
    return V.weekly(log)


def velocity_replay(spark, sf):
    """A run replayed with other companies, then in other weeks, leaves no row of before."""
    log = _type_run(spark, sf, "click", "1")
    for name, run_id, shift in (("error", "2", 0), ("view", "3", 0), ("purchase", "3", 0),
                                ("signup", "2", 7)):
        log = V.add_run(log, _type_run(spark, sf, name, run_id, shift), run_id)
    return V.weekly(log)


def velocity_delta(spark, sf):
    return V.week_over_week(weekly_events(spark, sf))


def velocity_last_n(spark, sf):
    return V.last_weeks(weekly_events(spark, sf), 2).select("company_name", "week",
                                                            "signal_count")


def accelerating(spark, sf):
    return V.accelerating(weekly_events(spark, sf))


def run_stats(spark, sf):
    """Orders as companies by first order day, order days as runs."""
    o = table(spark, sf, "orders")
    day = F.col("o_orderdate").cast("date").cast("string")
    companies = o.groupBy("o_custkey").agg(F.min(day).alias("first_seen"))
    runs = o.groupBy(day.alias("ran_at")).agg(F.count("*").alias("new_count"))
    return ST.run_stats(companies, runs, F.lit("1996-01-03"), "ran_at")


def run_metrics(spark, sf):
    li = table(spark, sf, "lineitem")
    return ST.run_metrics(li, li.where("l_linestatus = 'O'"),
                          table(spark, sf, "orders").where("o_orderstatus = 'P'"))


QUERIES = {f.__name__: f for f in (
    new_vs_existing, annotate_new, snapshot_merge, company_history, schema_evolution,
    history_scan, new_unnotified, mark_notified, location_merge, confirmed_offices, ttl_sweep,
    velocity_sweep, incremental_merge, velocity_manifest, ats_resolution, ats_distribution, supported_boards, velocity_table,
    velocity_merge, velocity_replay, velocity_delta, velocity_last_n, accelerating, run_stats, run_metrics)}

_HALVES = f"""ev AS (SELECT *, event_type || '-' || user_id || '-' || (event_id % 3) AS name FROM events),
history AS (SELECT name, CAST(sum(floor(value)) AS BIGINT) AS gtm_score, max(props) AS kw,
  min(event_type) AS domain, count(*) AS n FROM ev WHERE ts < '{_CUT}' GROUP BY name),
batch AS (SELECT upper(name) AS company, CAST(sum(floor(value)) AS BIGINT) AS gtm_score,
  max(props) AS kw, min(event_type) AS domain, count(*) AS n FROM ev
  WHERE ts >= '{_CUT}' GROUP BY ALL)"""
_SEEN = "EXISTS (SELECT 1 FROM history h WHERE h.name = lower(b.company))"
_CACHE = """cache AS (SELECT 'd' || o_custkey AS domain, min(o_orderpriority) AS ats_type,
  min(o_orderstatus) AS ats_slug, strftime(max(o_orderdate), '%Y-%m-%d') AS checked_at
  FROM orders GROUP BY o_custkey),
fresh AS (SELECT * FROM cache WHERE CAST(checked_at AS DATE) >= DATE '2001-10-01' - 90)"""
_OLD = """old AS (SELECT 'n' || (s_nationkey + 5) AS name,
  CAST(max(floor(s_acctbal)) AS BIGINT) AS gtm_score, count(*) AS times_seen
  FROM supplier GROUP BY s_nationkey)"""
_RANKED = f"""{Q.WEEKLY}, ranked AS (SELECT *, row_number() OVER (PARTITION BY company_name
  ORDER BY week DESC) AS r FROM weekly)"""

_FILLED = {n: n for n in (
    "sample_url", "perk_excerpt", "segment", "ezcater_vertical", "zi_industry",
    "loc_signal_strength", "expansion_confirmed", "expansion_possible", "existing_confirmed",
    "existing_possible", "known_markets", "office_cities", "location_detail")}
_OLD_TEXT = {"segment": "'prospect'", "loc_signal_strength": "'noise'",
             "sample_url": "'old sample_url'", "perk_excerpt": "'old perk_excerpt'"}
_MERGED_TEXT = ", ".join(
    f"CASE WHEN b.company IS NULL THEN {_OLD_TEXT.get(n, 'NULL')} ELSE '{n}' END AS {n}"
    for n in _FILLED)

SQL = {
    "new_vs_existing": f"WITH {_HALVES} SELECT company, CASE WHEN {_SEEN} THEN 'seen' "
                       "ELSE 'new' END AS kind FROM batch b",
    "annotate_new": f"WITH {_HALVES} SELECT company, CASE WHEN {_SEEN} THEN 0 ELSE 1 END "
                    "AS is_new FROM batch b",
    "snapshot_merge": f"""
WITH {_HALVES} SELECT coalesce(h.name, b.company) AS name, coalesce(h.domain, b.domain) AS domain,
  coalesce(b.kw, h.kw) AS top_keywords, CASE WHEN h.name IS NULL THEN '2024-01-31'
    ELSE '2024-01-10' END AS first_seen,
  CASE WHEN b.company IS NULL THEN '2024-01-19' ELSE '2024-01-31' END AS last_seen,
  coalesce(h.n, 0) + CASE WHEN b.company IS NULL THEN 0 ELSE 1 END AS times_seen,
  CASE WHEN h.name IS NOT NULL AND b.company IS NOT NULL THEN 0 ELSE 1 END AS is_new,
  CASE WHEN h.n > 3 THEN 1 ELSE 0 END AS notified,
  greatest(coalesce(h.gtm_score, b.gtm_score), coalesce(b.gtm_score, h.gtm_score)) AS gtm_score,
  CASE WHEN h.name IS NULL THEN 1 ELSE 0 END AS new_this_run
FROM history h FULL JOIN batch b ON h.name = lower(b.company)""",
    "company_history": f"""
WITH {_OLD}, g AS (SELECT 'N' || c_nationkey AS company, c_mktsegment AS market,
  CAST(max(floor(c_acctbal)) AS BIGINT) AS gtm_score, count(*) AS n, min(c_name) AS sample
  FROM customer GROUP BY c_nationkey, c_mktsegment),
b AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY company
  ORDER BY gtm_score DESC) = 1)
SELECT coalesce(old.name, b.company) AS name,
  CASE WHEN old.name IS NULL THEN '' ELSE 'old domain' END AS domain,
  CASE WHEN old.name IS NULL THEN '2024-02-05' ELSE '2023-12-01' END AS first_seen,
  CASE WHEN b.company IS NULL THEN '2024-01-01' ELSE '2024-02-05' END AS last_seen,
  coalesce(times_seen, 0) + CASE WHEN b.company IS NULL THEN 0 ELSE 1 END AS times_seen,
  CASE WHEN old.name IS NOT NULL AND b.company IS NOT NULL THEN 0 ELSE 1 END AS is_new,
  greatest(coalesce(old.gtm_score, b.gtm_score), coalesce(b.gtm_score, old.gtm_score))
    AS gtm_score,
  coalesce(lower(b.market), 'old top_keywords') AS top_keywords, coalesce(b.n, 1) AS role_count,
  coalesce(b.sample, 'old sample_title') AS sample_title,
  CASE WHEN old.name IS NULL THEN 'location' ELSE 'old location' END AS location,
  CASE WHEN b.company IS NULL THEN 'old source' ELSE 'best_source' END AS source,
  CASE WHEN old.name IS NULL THEN 0 ELSE 1 END AS notified, b.market AS market,
  coalesce(b.n, 0) AS location_jd_count, {_MERGED_TEXT},
  CASE WHEN old.name IS NULL THEN 1 ELSE 0 END AS new_this_run
FROM old FULL JOIN b ON old.name = lower(b.company)""",
    "schema_evolution": f"WITH {_OLD} SELECT name, 'prospect' AS segment, 'noise' AS "
                        "loc_signal_strength, 0 AS location_jd_count, '-' AS market FROM old",
    "history_scan": f"WITH {_HALVES} SELECT name, name AS company, gtm_score FROM history",
    "new_unnotified": f"WITH {_HALVES} SELECT name, gtm_score FROM history WHERE n <= 3",
    "mark_notified": f"""
WITH {_HALVES} SELECT name, CASE WHEN n > 3 OR EXISTS (SELECT 1 FROM batch b
  WHERE lower(b.company) = name) THEN 1 ELSE 0 END AS notified FROM history""",
    "location_merge": f"""
WITH o AS (SELECT CAST(user_id AS VARCHAR) AS company_name, event_type AS market,
  count(*) AS jd_count FROM events WHERE ts < '{_CUT}' GROUP BY ALL),
n AS (SELECT CAST(user_id AS VARCHAR) AS company_name, event_type AS market,
  count(*) AS jd_count FROM events WHERE ts >= '{_CUT}' GROUP BY ALL)
SELECT coalesce(n.company_name, o.company_name) AS company_name,
  coalesce(n.market, o.market) AS market, coalesce(n.jd_count, o.jd_count) AS jd_count,
  CASE WHEN n.market IS NULL THEN '2024-01-20' ELSE '2024-01-31' END AS last_seen
FROM o FULL JOIN n ON o.company_name = n.company_name AND o.market = n.market""",
    "confirmed_offices": """
WITH l AS (SELECT 'u' || user_id AS company_name, event_type AS market, count(*) AS jd_count
  FROM events GROUP BY ALL),
s AS (SELECT *, CASE WHEN jd_count >= 15 THEN 'confirmed' WHEN jd_count >= 12 THEN 'possible'
  ELSE 'noise' END AS signal_strength FROM l)
SELECT 'any' AS kind, company_name, market, jd_count, signal_strength,
  coalesce(CAST(floor(s_acctbal) AS BIGINT), -1) AS gtm_score,
  CASE WHEN s_suppkey IS NULL THEN '-' ELSE 'managed' END AS segment
FROM s LEFT JOIN supplier ON company_name = 'u' || s_suppkey WHERE signal_strength <> 'noise'
UNION ALL SELECT 'exact', company_name, market, jd_count, signal_strength, -1, '-'
FROM s WHERE signal_strength = 'confirmed' AND market = 'view'""",
    "ttl_sweep": f"WITH {_CACHE} SELECT domain, checked_at FROM fresh",
    "velocity_sweep": f"WITH {Q.WEEKLY} SELECT company_name, week, signal_count FROM weekly "
                      "WHERE week >= '2024-04'",
    "ats_resolution": f"""
WITH {_CACHE}, r AS (SELECT 'd' || c_custkey AS domain, f.domain IS NOT NULL AS cached,
  CASE WHEN f.domain IS NOT NULL THEN f.ats_type WHEN c_acctbal > 2000 THEN lower(c_mktsegment)
    ELSE 'exa' END AS ats_type,
  CASE WHEN f.domain IS NOT NULL THEN f.ats_slug WHEN c_acctbal > 2000 THEN lower(c_name)
    ELSE '' END AS ats_slug FROM customer LEFT JOIN fresh f ON f.domain = 'd' || c_custkey)
SELECT 'resolved' AS kind, ats_type, domain, ats_slug FROM r
UNION ALL SELECT 'cache ' || checked_at, ats_type, domain, ats_slug FROM fresh
UNION ALL SELECT 'cache 2001-10-01', ats_type, domain, ats_slug FROM r WHERE NOT cached""",
    "ats_distribution": f"WITH {_CACHE} SELECT ats_type, count(*) AS n FROM cache "
                        "GROUP BY ats_type",
    "supported_boards": f"WITH {_CACHE} SELECT domain, ats_type FROM cache "
                        "WHERE ats_type IN ('1-URGENT', '2-HIGH')",
    "velocity_table": f"WITH {Q.WEEKLY} SELECT * FROM weekly",
    "velocity_merge": f"""
SELECT CAST(user_id AS VARCHAR) AS company_name, {Q.iso_week('ts')} AS week,
  count(*) AS signal_count, coalesce(max(props) FILTER (event_type = 'view'),
    max(props) FILTER (event_type = 'signup'), max(props) FILTER (event_type = 'purchase'),
    max(props) FILTER (event_type = 'error'), max(props)) AS keyword_set
FROM events GROUP BY ALL""",
    "velocity_replay": f"""
WITH e AS (SELECT CAST(user_id AS VARCHAR) AS company_name, {Q.iso_week('ts')} AS week, event_type,
  props FROM events WHERE event_type IN ('click', 'purchase')
  UNION ALL SELECT CAST(user_id AS VARCHAR), {Q.iso_week('(ts + INTERVAL 7 DAY)')}, event_type, props
  FROM events WHERE event_type = 'signup')
SELECT company_name, week, count(*) AS signal_count,
  coalesce(max(props) FILTER (event_type = 'purchase'), max(props) FILTER (event_type = 'signup'),
    max(props)) AS keyword_set FROM e GROUP BY ALL""",
    "velocity_delta": f"""
WITH {Q.WEEKLY}, latest AS (SELECT company_name, max(week) AS week FROM weekly GROUP BY ALL),
earlier AS (SELECT w.company_name, max(w.week) AS week FROM weekly w JOIN latest l
  ON w.company_name = l.company_name AND w.week < l.week GROUP BY ALL)
SELECT a.company_name, a.week AS this_week, a.signal_count AS this_count, b.week AS prev_week,
  b.signal_count AS prev_count, a.signal_count - b.signal_count AS delta
FROM latest l JOIN weekly a USING (company_name, week)
  JOIN earlier e ON e.company_name = a.company_name
  JOIN weekly b ON b.company_name = e.company_name AND b.week = e.week
WHERE a.signal_count - b.signal_count >= 2""",
    "velocity_last_n": f"WITH {_RANKED} SELECT company_name, week, signal_count FROM ranked "
                       "WHERE r <= 2",
    "accelerating": f"""
WITH {_RANKED} SELECT company_name, CASE WHEN max(signal_count) FILTER (r = 1) >
  max(signal_count) FILTER (r = 2) THEN 1 ELSE 0 END AS accelerating
FROM ranked GROUP BY company_name""",
    "run_stats": """
WITH c AS (SELECT o_custkey, strftime(min(o_orderdate), '%Y-%m-%d') AS first_seen FROM orders
  GROUP BY o_custkey),
r AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS ran_at, count(*) AS n FROM orders GROUP BY ALL)
SELECT (SELECT count(*) FROM c) AS total_companies,
  (SELECT count(*) FROM c WHERE first_seen = '1996-01-03') AS new_today,
  (SELECT count(*) FROM r) AS total_runs, (SELECT max(ran_at) FROM r) AS last_run_date,
  (SELECT arg_max(n, ran_at) FROM r) AS last_run_new""",
    "run_metrics": """
SELECT count(*) AS raw_count, count(*) FILTER (l_linestatus = 'O') AS live_count,
  (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') AS new_count,
  count(*) FILTER (l_linestatus <> 'O') AS removed_count FROM lineitem""",
}
SQL["incremental_merge"] = f"SELECT * EXCLUDE (new_this_run) FROM ({SQL['snapshot_merge']})"
SQL["velocity_manifest"] = SQL["velocity_sweep"]
