"""Payloads that can't be used: told apart, counted as they pass, kept; good ones are read as before."""

import hashlib
import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Observation

from signalloom.operators import alerts
from signalloom.plans.runs import Run
from signalloom.schemas import JOB_COLUMNS
from signalloom.sources import rejects
from signalloom.sources.registry import SOURCES, read_sources
from test_sources import landed, state

JOB = {"title": "Chef", "content": "free lunch daily", "absolute_url": "u1", "updated_at": "2026-04-01",
       "location": {"name": "Austin"}}
GOOD = {"jobs": [JOB]}
CUT = json.dumps(GOOD)[:-9]
MIXED = {"jobs": [{**JOB, "location": "Austin", "absolute_url": "u2"}, {**JOB, "absolute_url": "u3"}]}


def greenhouse(spark):
    return landed(spark, *({"slug": "acme", "payload": p} for p in (
        GOOD, CUT, "", "  \n", MIXED, {"error": "busy"}, {"jobs": []}, {"jobs": "none"}, "<html>")))


def test_reasons(spark):
    got = rejects.rejected(greenhouse(spark), rejects.SHAPES["gh"]["landed"], "Greenhouse").collect()
    assert {r.seq: r.reason for r in got} == {1: "unparseable", 2: "empty", 3: "empty", 4: "mistyped", 5: "missing",
                                              7: "mistyped", 8: "unparseable"}
    assert {r.payload_hash for r in got if r.seq == 1} == {hashlib.md5(CUT.encode()).hexdigest()}
    lever = landed(spark, {"payload": [{"text": "a", "createdAt": "soon"}]}, {"payload": []}, {"payload": "[{"},
                   {"payload": [{"text": "a", "hostedUrl": "u"}]})
    got = rejects.rejected(lever, rejects.SHAPES["lv"]["landed"], "Lever").collect()
    assert {r.seq: r.reason for r in got} == {0: "mistyped", 2: "unparseable"}


def test_pages_and_kinds(spark):
    pages = landed(spark, {"payload": state({"props": {"pageProps": {"jobs": []}}})}, {"payload": "<ul>cards</ul>"},
                   {"payload": '<script id="__NEXT_DATA__">{"props": </script>'}, {"payload": state({"props": {}})})
    got = rejects.rejected(pages, rejects.SHAPES["bn"]["landed"], "Built In").collect()
    assert {r.seq: r.reason for r in got} == {2: "unparseable", 3: "missing"}
    both = landed(spark, {"payload": {"data": {}}}, {"payload": "<p>cards</p>"}, {"payload": "{"})
    got = rejects.rejected(both, rejects.SHAPES["wf"]["landed"], "Wellfound").collect()
    assert {r.seq: r.reason for r in got} == {0: "missing", 2: "unparseable"}
    from pyspark.sql import functions as F
    kinds = landed(spark, {"payload": GOOD}, {"payload": "[]"}, {"payload": "[]"}).withColumn(
        "ats_type", F.element_at(F.array(F.lit("greenhouse"), F.lit("lever"), F.lit("ashby")), (F.col("seq") + 1).cast("int")))
    got = rejects.rejected(kinds, rejects.SHAPES["da"]["landed"], "Boards").collect()
    assert {r.seq: r.reason for r in got} == {2: "mistyped"}


@pytest.mark.parametrize("key", [k for k in SOURCES if k in rejects.SHAPES and k not in ("gd", "wd", "da")])
def test_every_source_reads_alike_when_watched(spark, key):
    table = landed(spark, {"payload": GOOD, "search_term": "x"}, {"payload": state(GOOD)}, {"payload": CUT}, {"payload": "[]"},
                   {"payload": [{"text": "free lunch", "hostedUrl": "u", "jobUrl": "v", "description": "free lunch"}]},
                   {"payload": {"results": [{"url": "https://jobs.lever.co/acme/1", "text": "free lunch"}],
                                "data": [{"url": "https://jobs.lever.co/acme/1", "markdown": "free lunch",
                                          "description": "free lunch", "job_title": "t"}]}})
    plain = read_sources({key: {"landed": table}})
    seen = {}
    watched = read_sources({key: {"landed": table}}, seen=seen)
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, watched.collect()))
    counts = rejects.counts(seen[key, "landed"])
    assert counts is None or counts["payloads"] == 6 and sum(counts[r] for r in rejects.REASONS) >= 1
    assert counts or key in ("bn", "wf")


def run(spark, root, run_id="1"):
    accounts = spark.createDataFrame([("managed", 1, "Acme", "acme.com", "1", "", "", "", "", "")],
                                     "list string, row_no long, name string, domain string, zoominfo_id string, vertical "
                                     "string, industry string, zi_industry string, city string, state string")
    return Run(spark, str(root), "2026-05-01", run_id, accounts)


def test_a_run_keeps_rejects_and_goes_on_without_a_broken_source(spark, tmp_path):
    broken = greenhouse(spark).drop("payload")
    out = run(spark, tmp_path).full({"gh": {"landed": greenhouse(spark)}, "lv": {"landed": broken}, "wd": {}})
    found = {(r.source, r.reason): r for r in out["rejects"].collect()}
    assert ("Lever", "failed") in found and "payload" in found["Lever", "failed"].seq
    assert ("Workday", "failed") in found and ("Greenhouse", "unparseable") in found
    assert out["jobs"].count() == 3
    with pytest.raises(AnalysisException):
        read_sources({"lv": {"landed": broken}})
    with pytest.raises(ValueError, match="all selected sources failed"):
        read_sources({"lv": {"landed": broken}}, failed={})


def test_a_run_without_rejects_or_rows(spark, tmp_path):
    good = landed(spark, {"slug": "acme", "payload": GOOD})
    out = run(spark, tmp_path / "a").full({"gh": {"landed": good}})
    assert out["rejects"].count() == 0 and out["jobs"].select(*JOB_COLUMNS).count() == 1
    out = run(spark, tmp_path / "b").full({"gh": {"landed": good.limit(0)}, "ex": {"landed": good.where("seq > 5")}})
    assert out["rejects"].count() == 0 and out["jobs"].count() == 0
