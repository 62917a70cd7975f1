"""State merges, replays, snapshots and the rollup's invariants."""

import json

import pytest
from pyspark.sql import functions as F

from signalloom.bindings import rollup as RB, runs as RUNS
from signalloom.bindings.data import RUBRIC, postings, supplier_accounts
from signalloom.operators.liveness import verify
from signalloom.operators import rollup as R, state as ST, velocity as V
from signalloom.plans.runs import Run
from signalloom.schemas import COMPANY_COLUMNS, HISTORY_COLUMNS
from signalloom.session import shared_folder
from signalloom.sources.tables import Snapshots


@pytest.fixture(scope="module")
def companies(spark, sf):
    return RB.company_rollup(spark, sf).collect()


def test_rollup_invariants(companies):
    assert companies and tuple(companies[0].asDict()) == COMPANY_COLUMNS
    for c in companies:
        detail = json.loads(c.location_detail)
        assert c.location_jd_count == sum(d["jd_count"] for d in detail)
        counts = [d["jd_count"] for d in detail]
        assert counts == sorted(counts, reverse=True)
        known = set(filter(None, c.known_markets.split(", ")))
        for d in detail:
            n = d["jd_count"]
            assert d["signal_strength"] == ("confirmed" if n >= 5 else "possible" if n >= 3
                                            else "noise")
            assert d["loc_type"] == ("existing" if d["market"] in known else "expansion")
        lists = {}
        for kind in ("expansion", "existing"):
            for level in ("confirmed", "possible"):
                want = sorted(d["market"] for d in detail
                              if (d["loc_type"], d["signal_strength"]) == (kind, level))
                assert c[f"{kind}_{level}"] == ", ".join(want)
                lists[f"{kind}_{level}"] = want
        assert c.loc_signal_strength == next((k for k, v in lists.items() if v), "noise")
        words = c.top_keywords.split(", ")
        assert words == sorted(set(words)) and c.role_count == c.unique_roles_with_perk


def test_other_market_is_expansion(spark):
    from signalloom.operators import markets as M
    signals = spark.createDataFrame([("a", "Other"), ("a", "Boston")], "k string, market string")
    known = spark.createDataFrame([("a", "Other"), ("a", "Boston")], "k string, market string")
    got = {r.market: r.loc_type for r in M.flag_expansion(signals, known, "k").collect()}
    assert got == {"Other": "expansion", "Boston": "existing"}


@pytest.mark.parametrize("n,level", [(2, "noise"), (3, "possible"), (4, "possible"),
                                     (5, "confirmed")])
def test_strength_thresholds(spark, n, level):
    df = spark.range(n).select(F.lit("c").alias("company_norm"), F.lit("m").alias("market"),
                               F.lit(7).alias("kw_score"))
    assert R.market_signals(df).first().signal_strength == level


def _batch(spark, *rows):
    filled = {c: F.lit(c) for c in COMPANY_COLUMNS if c not in (
        "company", "gtm_score", "role_count", "location_jd_count")}
    df = spark.createDataFrame([(n, s) for n, s in rows], "company string, gtm_score long")
    return df.select("*", F.lit(1).cast("long").alias("role_count"),
                     F.lit(2).cast("long").alias("location_jd_count"),
                     *[v.alias(c) for c, v in filled.items()])


def test_company_merge_rules(spark):
    longs, ints = ("times_seen", "gtm_score", "role_count", "location_jd_count"), (
        "is_new", "notified")
    kinds = {**dict.fromkeys(longs, "long"), **dict.fromkeys(ints, "int")}
    empty = spark.createDataFrame([], ", ".join(
        f"{c} {kinds.get(c, 'string')}" for c in HISTORY_COLUMNS))
    first = ST.merge_companies(empty, _batch(spark, ("Acme", 30), ("acme ", 10), ("Beta", 5)),
                               "2026-05-01")
    got = {r.name: r for r in first.collect()}
    assert set(got) == {"Acme", "Beta"} and got["Acme"].gtm_score == 30
    assert got["Beta"].is_new == 1 and got["Beta"].times_seen == 1
    told = ST.mark_notified(first, first.select(F.col("name").alias("company")))
    later = _batch(spark, ("ACME", 12)).withColumn("location", F.lit("moved")).withColumn(
        "market", F.lit("Boston"))
    got = {r.name: r for r in ST.merge_companies(told.drop("new_this_run"), later,
                                                 "2026-05-08").collect()}
    acme = got["Acme"]
    assert (acme.gtm_score, acme.times_seen, acme.is_new, acme.notified) == (30, 2, 0, 1)
    assert (acme.first_seen, acme.last_seen) == ("2026-05-01", "2026-05-08")
    assert acme.location == "location" and acme.market == "Boston"
    assert (got["Beta"].is_new, got["Beta"].last_seen, got["Beta"].new_this_run) == (
        1, "2026-05-01", 0)


def test_velocity_adds_runs_and_ignores_replays(spark):
    batch = spark.createDataFrame([("Acme", 3, "a"), (" ", 9, "x")],
                                  "company string, role_count long, top_keywords string")
    day = F.lit("2027-01-01").cast("date")
    one = V.contributions(batch, day, "r1")
    log = V.add_run(V.add_run(one, V.contributions(batch, day, "r2"), "r2"),
                    V.contributions(batch, day, "r2"), "r2")
    assert [(r.company_name, r.week, r.signal_count) for r in V.weekly(log).collect()] == [
        ("Acme", "2026-53", 6)]
    # a replay whose companies or weeks differ leaves nothing of the run before
    both = spark.createDataFrame([("Acme", 3, "a"), ("Beta", 2, "b")], batch.schema)
    log = V.add_run(one, V.contributions(both, day, "r2"), "r2")
    log = V.add_run(log, V.contributions(batch, F.date_add(day, 7), "r2"), "r2")
    assert sorted((r.company_name, r.week, r.signal_count) for r in V.weekly(log).collect()) == [
        ("Acme", "2026-53", 3), ("Acme", "2027-01", 3)]
    assert V.add_run(log, both.limit(0).transform(lambda b: V.contributions(b, day, "r2")),
                     "r2").count() == 1


def test_week_over_week_equals_self_join(spark):
    rows = [("a", "2024-01", 1), ("a", "2024-03", 4), ("a", "2024-02", 9), ("b", "2024-02", 5),
            ("c", "2024-01", 1), ("c", "2024-02", 3), ("d", "2024-01", 1), ("d", "2024-02", 2)]
    df = spark.createDataFrame(rows, "company_name string, week string, signal_count long")
    got = [(r.company_name, r.prev_week, r.delta) for r in V.week_over_week(df).collect()]
    assert got == [("c", "2024-01", 2)]
    flags = {r.company_name: r.accelerating for r in V.accelerating(df).collect()}
    assert flags == {"a": 0, "b": 0, "c": 1, "d": 1}


def test_uncommitted_snapshots_are_ignored(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path))
    assert store.version() == 0 and store.read("t", 0, "a long").count() == 0
    store.write("t", spark.range(3), 1, "r")
    assert store.version() == 0
    store.write("t", spark.range(5), 1, "r")
    store.commit("2026-05-01", 1, "r")
    assert store.version() == 1 and store.read("t", 1, "id long").count() == 5
    # two runs from one version do not overwrite each other, and the second fails
    store.write("t", spark.range(7), 2, "a/b")
    store.write("t", spark.range(9), 2, "c")
    store.commit("2026-05-02", 2, "a/b")
    with pytest.raises(RuntimeError):
        store.commit("2026-05-02", 2, "c")
    assert store.read("t", 2, "id long").count() == 7
    assert (store.base("a/b"), store.base("new")) == (1, 2)
    with pytest.raises(ValueError):
        store.base("r")


def test_a_shared_folder_is_asked_for_on_a_cluster(spark):
    class Cluster:
        conf = {}
        sparkContext = type("", (), {"master": "spark://host:7077"})
    with pytest.raises(ValueError):
        shared_folder(Cluster, "x")
    Cluster.conf = {"spark.checkpoint.dir": "hdfs://shared/"}
    assert shared_folder(Cluster, "x").startswith("hdfs://shared/x-")


def test_the_newest_crawl_counts(spark):
    crawl = spark.createDataFrame(
        [("https://a", 200, "2024-01-01"), ("https://a", 404, "2024-01-02"), ("https://b", 404, "2024-01-01"),
         ("https://b", 200, "2024-01-02"), ("https://c", 404, None)],
        "url string, status int, fetched_at string").withColumn("body", F.lit("")).withColumn(
        "fetch_error", F.lit(None).cast("string"))
    jobs = spark.createDataFrame([(f"https://{x}",) for x in "abcd"], "url string")
    assert sorted(r.url for r in verify(jobs, crawl).collect()) == ["https://b", "https://d"]


def test_replayed_run_after_a_crash_gives_the_same_state(spark, sf, tmp_path, monkeypatch):
    jobs, accounts = postings(spark, sf), supplier_accounts(spark, sf)

    def run(day, run_id):
        return Run(spark, str(tmp_path), day, run_id, accounts, rubric=RUBRIC)
    run("2026-05-01", "r1").finish(jobs)
    broken = run("2026-05-08", "r2")
    monkeypatch.setattr(broken.store, "commit", lambda *a: (_ for _ in ()).throw(IOError()))
    with pytest.raises(IOError):
        broken.finish(jobs)
    out = run("2026-05-08", "r2").finish(jobs)
    assert {r.times_seen for r in out["history"].collect()} == {2}
    stats = out["stats"].first()
    assert stats.total_runs == 2 and stats.last_run_date == "2026-05-08"
    run("2026-05-08", "r2").export(out, f"{tmp_path}/files")
    record = json.loads(spark.read.text(f"{tmp_path}/files/dashboard/companies").first()[0])
    assert record["company"] == record["name"] and record["confidence"] in (
        "High", "Medium", "Low")


def test_stream_in_small_steps_equals_batch(spark, sf, tmp_path):
    from signalloom.streaming import ingest as I, velocity as SV
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.orderBy("ts").coalesce(1).write.option("maxRecordsPerFile", 250).parquet(
        f"{tmp_path}/in")
    stream = I.read_stream(spark, f"{tmp_path}/in", events.schema, files_per_trigger=1)
    counts = SV.weekly_counts(stream.withColumn("at", I.as_instant("ts")), "user_id", "at",
                              "30 days")
    rows = counts.select(SV.week_start().alias("w"), "user_id", "signal_count")
    I.run_available(rows, I.to_batches(f"{tmp_path}/out"), f"{tmp_path}/ck", "update")
    got = {(r.w, r.user_id): r.signal_count
           for r in I.latest(spark, f"{tmp_path}/out", ["w", "user_id"]).collect()}
    week = F.date_trunc("week", "ts").cast("date").cast("string")
    want = {(r.w, r.user_id): r["count"]
            for r in events.groupBy(week.alias("w"), "user_id").count().collect()}
    assert got == want
    assert RUNS.stream_dedup(spark, sf).count() == events.select(
        "user_id", "event_type").distinct().count()


def _files(folder):
    return {str(f.relative_to(folder)): f.stat().st_mtime_ns for f in folder.rglob("*.parquet")}


def test_untouched_buckets_and_weeks_keep_their_files(spark, tmp_path):
    accounts = spark.createDataFrame([("managed", 1, "Acme", "acme.com", "1", "", "", "", "", "")],
                                     "list string, row_no long, name string, domain string, zoominfo_id string, vertical "
                                     "string, industry string, zi_industry string, city string, state string")
    def jobs(*names):
        rows = [("Greenhouse", n, "Cook", "Austin", "", "catered lunch", 1, "x", "2026-05-01", f"u{n}{k}", "", k)
                for n in names for k in range(3)]
        return spark.createDataFrame(rows, "source string, company string, title string, location string, remote string, "
                                     "food_keywords_matched string, keyword_count int, perk_excerpt string, date_posted "
                                     "string, url string, _domain string, ingest_seq long")
    def run(day, run_id, *names):
        return Run(spark, str(tmp_path), day, run_id, accounts, velocity_weeks=2).finish(jobs(*names))
    first = run("2026-05-04", "r1", *[f"Company {i}" for i in range(40)])
    before, parts = _files(tmp_path), Snapshots(spark, str(tmp_path)).parts("history", 1)
    assert first["history"].where("new_this_run = 1").count() == 40 and len(parts) > 20
    second = run("2026-05-11", "r2", "Company 7", "Fresh")
    after, now = _files(tmp_path), Snapshots(spark, str(tmp_path)).parts("history", 2)
    assert all(after[f] == t for f, t in before.items())
    assert sum(now.get(p) != at for p, at in parts.items()) == 1 and len(set(now) - set(parts)) <= 1
    got = {r.name: r for r in second["history"].collect()}
    assert len(got) == 41 and {n for n, r in got.items() if r.new_this_run} == {"Fresh"}
    assert got["Company 7"].times_seen == 2 and got["Company 8"].times_seen == 1
    assert second["locations"].count() == 41 and second["runs"].count() == 2
    # the log names parts of the last weeks only, and a replay replaces its own
    run("2026-05-18", "r3", "Company 7")
    third = run("2026-05-18", "r3", "Company 8")
    store = Snapshots(spark, str(tmp_path))
    assert sorted(store.parts("velocity_log", store.version())) == ["2026-19 r1", "2026-20 r2", "2026-21 r3"]
    assert {r.company_name for r in third["velocity"].where("week = '2026-21'").collect()} == {"Company 8"}
    run("2026-06-01", "r4", "Company 1")
    assert sorted(store.parts("velocity_log", store.version())) == ["2026-21 r3", "2026-23 r4"]
    # a table with other buckets is written anew as a whole
    again = ST.touched_parts(now, spark.range(1), F.lit("x"), 8)
    assert again == now


def test_of_two_commits_from_one_base_one_wins(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    stores = [Snapshots(spark, str(tmp_path)) for _ in range(6)]
    for k, store in enumerate(stores):
        store.write("t", spark.range(k + 1), 1, f"r{k}")

    def commit(k):
        try:
            stores[k].commit("2026-05-01", 1, f"r{k}")
            return True
        except RuntimeError:
            return False
    with ThreadPoolExecutor(6) as pool:
        won = list(pool.map(commit, range(6)))
    assert won.count(True) == 1 and stores[0].version() == 1
    assert stores[0].read("t", 1, "id long").count() == won.index(True) + 1


def test_a_merge_does_not_shuffle_a_large_history_for_a_small_batch(spark, tmp_path):
    spark.range(200_000).select(F.concat(F.lit("c"), "id").alias("name"), F.lit(1).cast("long").alias("gtm_score"),
                                F.lit("x").alias("first_seen"), F.lit("x").alias("last_seen"), F.lit(1).cast("long").alias(
        "times_seen"), F.lit(1).alias("is_new"), F.lit(0).alias("notified")).write.parquet(f"{tmp_path}/h")
    history = spark.read.parquet(f"{tmp_path}/h")
    spark.createDataFrame([("C7", 5), ("new", 6)], "company string, gtm_score long").write.parquet(f"{tmp_path}/b")
    merged = ST.upsert(history, spark.read.parquet(f"{tmp_path}/b"), ST.name_key("name"), ST.name_key("company"), {},
                       {"company": "name"}, F.lit("today"), best="gtm_score")
    text = merged._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") >= 2
    got = {r.name: r for r in merged.where("last_seen = 'today'").collect()}
    assert merged.count() == 200_001 and got["c7"].gtm_score == 5 and got["new"].new_this_run == 1
