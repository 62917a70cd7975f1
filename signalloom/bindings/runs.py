"""Queries of the streams and of the two runs end to end."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import iso_week
from ..operators import accounts as A, state as ST
from ..plans.runs import Run
from ..session import shared_folder
from ..sources import boards
from ..sources.tables import Snapshots
from ..streaming import ingest as I, velocity as SV
from ..streaming.history import into_history
from .data import LEXICON, RUBRIC, documents, postings, supplier_accounts, table
from .ingest import (_boards, _damage, _greenhouse, _json, _landed, _lever, _list, _select, _totals, _union, _BASE,
                     _BOARD_KIND, _BOARD_URL, _GH, _LV)
from .rollup import ROLLUP_SQL
from .state import SQL as STATE_SQL
from .views import _territories


def _land(spark, rows, file) -> str:
    """Rows written as files that land one after the other, in the order of the number ``file``."""
    folder = shared_folder(spark, "landed")
    numbered = rows.withColumn("_file", file)
    for k in sorted(r["_file"] for r in numbered.select("_file").distinct().collect()):
        numbered.where(F.col("_file") == k).drop("_file").coalesce(1).write.mode("append").parquet(folder)
    return folder


def _week_no():
    """Weeks since the first of 2024, a Monday; the tables begin in it."""
    return F.floor(F.datediff("ts", F.lit("2024-01-01")) / 7)


def _late():
    return F.when(F.col("event_id") % 41 == 0, 1).otherwise(0)


def _events(spark, sf, late: bool = True):
    """Events as a stream of weekly files; some events come with the file of the week after."""
    events = table(spark, sf, "events")
    folder = _land(spark, events, _week_no() + (_late() if late else F.lit(0)))
    stream = I.read_stream(spark, folder, events.schema, files_per_trigger=1)
    return stream.withColumn("at", I.as_instant("ts"))


def _run_stream(spark, stream, name: str, mode: str) -> str:
    folder = shared_folder(spark, name)
    I.run_available(stream, I.to_batches(f"{folder}/rows"), f"{folder}/state", mode)
    return f"{folder}/rows"


def weekly_stream_counts(spark, sf):
    """Monday-aligned counts in update mode; the newest row per key is the result."""
    counts = SV.weekly_counts(_events(spark, sf), "user_id", "at", "10 days")
    rows = counts.select(SV.week_start().alias("week_start"), "user_id", "signal_count")
    path = _run_stream(spark, rows, "weekly", "update")
    return I.latest(spark, path, ["week_start", "user_id"])


def weekly_stream_distinct(spark, sf):
    """Distinct event types per user and closed week, in append mode."""
    counts = SV.weekly_distinct(_events(spark, sf, late=False), "user_id", "event_type", "at", "1 day")
    rows = counts.select(SV.week_start().alias("week_start"), "user_id", "signal_count")
    return spark.read.parquet(_run_stream(spark, rows, "distinct", "append")).drop("batch_id")


def stream_dedup(spark, sf):
    """Keys seen in the stream, each once."""
    once = I.first_seen(_events(spark, sf), ["user_id", "event_type"], "at", "60 days")
    path = _run_stream(spark, once.select("user_id", "event_type"), "dedup", "append")
    return spark.read.parquet(path).drop("batch_id")


def _company(events):
    return events.withColumn("name", F.concat_ws("-", "event_type", "user_id"))


_STREAMED = ("name string, domain string, top_keywords string, first_seen string, last_seen string, times_seen long, "
             "is_new int, notified int, gtm_score long")


def stream_upsert(spark, sf):
    """History after a stream of weekly files was merged into it, one micro-batch after the other.

    Every fifth event lands twice and counts once; some come a week late; some of the first week come in the
    last one, which is too late.
    """
    events = table(spark, sf, "events")
    too_late = (F.col("event_id") % 43 == 0) & (_week_no() == 0)
    once = events.withColumn("_f", F.when(too_late, 4).otherwise(_week_no() + _late()))
    again = once.where((F.col("event_id") % 5 == 0) & ~too_late).withColumn("_f", F.col("_f") + 1)
    both = once.unionByName(again)
    folder = _land(spark, both.select(*events.columns, F.col("_f").alias("_file_no")), F.col("_file_no"))
    stream = I.read_stream(spark, folder, events.schema, files_per_trigger=1).withColumn("at", I.as_instant("ts"))
    root = shared_folder(spark, "streamed")
    store = Snapshots(spark, f"{root}/tables")

    def merge(history, batch, _):
        day = batch.agg(F.max(F.date_trunc("week", "ts")).cast("date").cast("string")).first()[0]
        found = _company(batch).groupBy(F.upper("name").alias("company")).agg(
            F.max(F.floor("value")).alias("gtm_score"), F.max("props").alias("keywords"),
            F.min("event_type").alias("first_type"))
        return ST.upsert(history, found, ST.name_key("name"), ST.name_key("company"), {"keywords": "top_keywords"},
                         {"company": "name", "first_type": "domain"}, F.lit(day), best="gtm_score").drop("new_this_run")
    write = into_history(store, "history", _STREAMED, merge, ST.name_key(F.concat_ws("-", "event_type", "user_id")),
                         ST.name_key("name"), 16)
    I.run_available(I.first_seen(stream, ["event_id"], "at", "10 days"), write, f"{root}/state")
    return store.read("history", store.version(), _STREAMED).withColumn("name", ST.name_key("name"))


def stream_acceleration(spark, sf):
    """Companies whose last week grew, from state that compares weeks as they close.

    Events are moved two days back, so that they end with a whole week; a row without a user lands last
    and closes it.
    """
    events = table(spark, sf, "events").withColumn("ts", F.expr("ts - INTERVAL 2 DAYS"))
    end = spark.range(1).select(F.lit("2024-04-01").cast("timestamp_ntz").alias("ts")).withColumns(
        {c: F.lit(None).cast(events.schema[c].dataType) for c in events.columns if c != "ts"}).select(*events.columns)
    file = F.when(F.col("user_id").isNull(), 99).otherwise(_week_no() + _late())
    folder = _land(spark, events.unionByName(end), file)
    stream = I.read_stream(spark, folder, events.schema, files_per_trigger=1).withColumn("at", I.as_instant("ts"))
    with SV.timers(spark):
        path = _run_stream(spark, SV.closed_weeks(stream, "user_id", "at", "10 days"), "growth", "append")
    closed = spark.read.parquet(path).drop("batch_id")
    week = lambda c: iso_week(F.col(c))
    return SV.growing(closed).select(
        F.col("company_name").cast("long").alias("company_name"), week("week_start").alias("this_week"),
        F.col("signal_count").alias("this_count"), week("prev_week").alias("prev_week"), "prev_count", "delta")


def _run(spark, sf, root: str, today: str, run_id: str, **extra) -> Run:
    return Run(spark, root, today, run_id, supplier_accounts(spark, sf), lexicon=LEXICON,
               rubric=RUBRIC, **extra)


def _crawl(spark, sf):
    """A page for every posting, its whole text as the body; every seventh is gone."""
    return documents(spark, sf).select(
        "url", F.when(F.col("doc_id") % 7 == 0, 404).otherwise(200).alias("status"),
        F.col("text").alias("body"), F.lit(None).cast("string").alias("fetch_error"),
        F.lit("2024-02-04").alias("fetched_at"))


def full_run(spark, sf):
    """Verify every posting against its page, roll up, merge, alert and commit; returns the companies of the run."""
    run = _run(spark, sf, shared_folder(spark, "run"), "2024-02-05", "run-1",
               territories=_territories(spark, sf), channels=["SLACK_WEBHOOK_URL"])
    return run.finish(postings(spark, sf), _crawl(spark, sf))["companies"]


def full_run_sources(spark, sf):
    """Postings of a run from landed payloads of two sources, verified against pages whose status and closing
    phrase follow from their content; some payloads are damaged."""
    d = documents(spark, sf)
    digit = F.substring(F.md5("text"), 1, 1)
    crawl = d.select("url", F.when(digit == "a", 404).when(digit == "b", 500).otherwise(200).alias("status"),
                     F.when(digit == "c", F.concat("text", F.lit(" This Position Has Been Filled."))).otherwise(
                         F.col("text")).alias("body"),
                     F.when(digit == "d", "connection").when(digit == "e", "timeout").alias("fetch_error"))
    run = _run(spark, sf, shared_folder(spark, "run"), "2024-02-05", "run-1")
    inputs = _damage(spark, sf, {"gh": {"landed": _greenhouse(spark, sf)}, "lv": {"landed": _lever(spark, sf)}})
    out = run.full(inputs, crawl)
    jobs = _totals(out["jobs"]).withColumn("kind", F.lit("postings"))
    rejects = out["rejects"].groupBy("source", F.col("reason").alias("location")).agg(
        F.count("*").alias("postings")).withColumns({"keywords": F.lit(0).cast("long"), "kind": F.lit("rejects")})
    return jobs.unionByName(rejects)


def second_run(spark, sf):
    """History after the same postings came in twice, a week apart."""
    root = shared_folder(spark, "runs")
    _run(spark, sf, root, "2024-01-29", "run-1").finish(postings(spark, sf))
    out = _run(spark, sf, root, "2024-02-05", "run-2").finish(postings(spark, sf))
    weeks = out["velocity"].groupBy(ST.name_key("company_name").alias("_key")).agg(
        F.array_join(F.array_sort(F.collect_list("week")), " ").alias("weeks"))
    return (out["history"].withColumn("_key", ST.name_key("name")).join(weeks, "_key").select(
        "name", "gtm_score", "times_seen", "is_new", "first_seen", "last_seen",
        "new_this_run", "weeks"))


def run_replay(spark, sf):
    """History after the second run was repeated: it replaces what it did before."""
    root = shared_folder(spark, "runs")
    _run(spark, sf, root, "2024-01-29", "run-1").finish(postings(spark, sf))
    for _ in range(2):
        out = _run(spark, sf, root, "2024-02-05", "run-2").finish(postings(spark, sf))
    total = out["velocity"].groupBy(ST.name_key("company_name").alias("_key")).agg(
        F.sum("signal_count").alias("signals"))
    runs = out["runs"].agg(F.count("*").alias("runs"))  # one row
    return (out["history"].withColumn("_key", ST.name_key("name")).join(total, "_key")
            .join(runs, how="cross").select("name", "times_seen", "signals", "runs"))


def run_notified(spark, sf):
    """History after a run that announced its companies: none is left to announce."""
    root = shared_folder(spark, "runs")
    extra = {"territories": _territories(spark, sf), "channels": ["SLACK_WEBHOOK_URL"]}
    out = _run(spark, sf, root, "2024-01-29", "run-1", **extra).finish(postings(spark, sf))
    left = ST.new_unnotified(out["history"]).select(ST.name_key("name").alias("_key"))
    return (out["history"].withColumn("_key", ST.name_key("name"))
            .join(left.withColumn("waits", F.lit(1)), "_key", "left")
            .select("name", "is_new", "notified", F.coalesce("waits", F.lit(0)).alias("waits")))


def targeted_run(spark, sf):
    """Report of a run over the boards and searches of supplier accounts."""
    run = _run(spark, sf, shared_folder(spark, "targeted"), "2024-02-05", "run-1")
    s = A.with_key(supplier_accounts(spark, sf))
    balance = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("row_no"),
                                                  "s_acctbal")
    kind = F.when(F.col("vertical") == "Technology", "greenhouse").when(
        F.col("vertical") == "Pharma", "ashby").otherwise("lever")
    probes = s.join(balance, "row_no").where("s_acctbal < 8000").select(
        F.col("domain_key").alias("domain"), kind.alias("ats_type"),
        F.concat(F.lit("src"), "zoominfo_id").alias("ats_slug"))
    pages = _boards(spark, sf)
    d = documents(spark, sf).select("doc_id", "text")
    html = boards.board_links(pages).select("url", F.col("seq").alias("doc_id")).join(
        d, "doc_id").select("url", F.concat(F.lit("<p>"), "text").alias("payload"))
    found = _landed(spark, sf, _json(results=_list(
        url=F.concat(F.lit("https://s"), "path"), text=F.col("text"), title=F.col("title"))),
        domain=F.concat(F.lit("https://www."), "slug", F.lit(".com/careers/")))
    return run.targeted(probes, pages, html, found)["report"]


QUERIES = {f.__name__: f for f in (weekly_stream_counts, weekly_stream_distinct, stream_dedup, stream_upsert,
                                   stream_acceleration,
                                   full_run, full_run_sources, second_run, run_replay, run_notified, targeted_run)}

_TEXT = "trim(regexp_replace(text, '\\s+', ' ', 'g'))"
_WEEK = "strftime(date_trunc('week', ts), '%Y-%m-%d') AS week_start"

SQL = {
    "weekly_stream_counts": f"SELECT {_WEEK}, user_id, count(*) AS signal_count FROM events "
                            "GROUP BY ALL",
    "weekly_stream_distinct": f"""
SELECT {_WEEK}, user_id, count(DISTINCT event_type) AS signal_count FROM events
WHERE date_trunc('week', ts) + INTERVAL 7 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY
GROUP BY ALL""",
    "stream_dedup": "SELECT DISTINCT user_id, event_type FROM events",
    "stream_upsert": """
WITH e AS (SELECT *, lower(event_type || '-' || user_id) AS name, floor(date_diff('day', DATE '2024-01-01',
    CAST(ts AS DATE)) / 7) AS week FROM events),
kept AS (SELECT *, week + CASE WHEN event_id % 41 = 0 THEN 1 ELSE 0 END AS file FROM e
  WHERE NOT (event_id % 43 = 0 AND week = 0)),
b AS (SELECT name, file, CAST(max(floor(value)) AS BIGINT) AS score, max(props) AS kw, min(event_type) AS type,
    max(week) AS own FROM kept GROUP BY name, file),
days AS (SELECT file, CAST(DATE '2024-01-01' + CAST(max(own) AS INTEGER) * 7 AS VARCHAR) AS day FROM b GROUP BY file)
SELECT name, arg_min(type, b.file) AS domain, arg_max(kw, b.file) AS top_keywords, arg_min(day, b.file) AS first_seen,
  arg_max(day, b.file) AS last_seen, count(*) AS times_seen, CASE WHEN count(*) = 1 THEN 1 ELSE 0 END AS is_new,
  0 AS notified, max(score) AS gtm_score
FROM b JOIN days ON b.file = days.file GROUP BY name""",
    "stream_acceleration": STATE_SQL["velocity_delta"],
    "full_run": ROLLUP_SQL.replace("FROM matched WHERE len(kw) > 0)",
                                   "FROM matched WHERE len(kw) > 0 AND doc_id % 7 <> 0)"),
    "run_replay": f"""
SELECT company AS name, 2 AS times_seen, 2 * role_count AS signals, 2 AS runs FROM ({ROLLUP_SQL})""",
    "run_notified": f"""
SELECT company AS name, 1 AS is_new, 1 AS notified, 0 AS waits FROM ({ROLLUP_SQL})""",
    "second_run": f"""
SELECT company AS name, gtm_score, 2 AS times_seen, 0 AS is_new, '2024-01-29' AS first_seen,
  '2024-02-05' AS last_seen, 0 AS new_this_run, '2024-05 2024-06' AS weeks
FROM ({ROLLUP_SQL})""",
    "targeted_run": f"""
WITH {_BASE}, worked AS (
  SELECT 'src' || s_suppkey AS slug, CASE WHEN s_acctbal >= 8000 THEN 'exa' ELSE CASE n_regionkey
    WHEN 0 THEN 'greenhouse' WHEN 2 THEN 'ashby' ELSE 'lever' END END AS kind
  FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal >= 1500
    AND (s_acctbal >= 6000 OR n_regionkey IN (0, 2, 4))),
{_select("''", name="b", once=None, url=_BOARD_URL, body=_TEXT, from_=f"""(SELECT d.* FROM d
  JOIN worked w ON w.slug = d.slug AND w.kind = {_BOARD_KIND})""")},
{_select("''", name="s", once="slug, url", url="id", body=_TEXT, from_="""(SELECT d.* FROM d
  JOIN worked w ON w.slug = d.slug AND w.kind = 'exa')""")},
u AS (SELECT * FROM b UNION ALL SELECT * FROM s),
t AS (SELECT (SELECT count(*) FROM worked) AS accounts_checked,
  (SELECT count(DISTINCT company) FROM u) AS companies_with_signal,
  (SELECT count(*) FROM u) AS raw_matches)
SELECT *, CASE WHEN accounts_checked > 0 THEN round(companies_with_signal * 100.0 /
  accounts_checked, 1) ELSE 0.0 END AS match_rate FROM t""",
}
_LIVE = "(SELECT * FROM d WHERE md5(text)[1] > '4' AND md5(text)[1] NOT IN ('a', 'b', 'c', 'd'))"
SQL["full_run_sources"] = _union(
    [(0, "g", {**_GH, "from_": _LIVE}), (1, "l", {**_LV, "from_": _LIVE})], "source, location, keyword_count") + """
SELECT 'postings' AS kind, source, location, count(*) AS postings, CAST(sum(keyword_count) AS BIGINT) AS keywords
FROM u GROUP BY ALL
UNION ALL SELECT 'rejects', s.source, CASE WHEN md5(text)[1] = '0' THEN 'unparseable' WHEN md5(text)[1] IN ('1', '2')
  THEN 'empty' WHEN md5(text)[1] = '3' OR s.source = 'Lever' THEN 'mistyped' ELSE 'missing' END AS location,
  count(*), 0 FROM d, (VALUES ('Greenhouse'), ('Lever')) AS s(source) WHERE md5(text)[1] <= '4' GROUP BY ALL"""
