"""What the physical plans must and must not hold."""

import re

import pytest
from pyspark.sql import functions as F

from signalloom.bindings import accounts as AB, catalog
from signalloom.bindings.data import part_accounts, postings, supplier_accounts
from signalloom.operators import accounts as A, alerts as AL, rollup as R


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rollup_stays_in_the_jvm(spark, sf):
    text = plan(R.rollup(postings(spark, sf), supplier_accounts(spark, sf)))
    assert "Python" not in text and "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_token_match_is_an_equi_join(spark, sf):
    names = A.name_index(part_accounts(spark, sf))
    asked = AB._companies(spark, sf).select(A.normalise_name(F.col("company")).alias("nn"))
    text = plan(A.token_matches(asked, names))
    assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_top_per_group_limits_before_the_shuffle(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    text = plan(AL.top_per_group(orders, ["o_orderpriority"], [F.desc("o_totalprice")], 10))
    assert text.count("WindowGroupLimit") >= 2


def test_scans_read_only_used_columns(spark, sf):
    text = plan(catalog.QUERIES["lexicon_match"](spark, sf))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text
    text = plan(catalog.QUERIES["velocity_table"](spark, sf))
    assert "value" not in text.split("ReadSchema")[1]


def test_text_conditions_are_not_repeated(spark, sf):
    text = plan(catalog.QUERIES["lexicon_context_match"](spark, sf))
    assert "Filter (" not in text and text.count("lower(") == 1


def test_sample_is_a_top_n(spark, sf):
    assert "TakeOrderedAndProject" in plan(catalog.QUERIES["hash_sample"](spark, sf))


SOURCES = [n for n in catalog.QUERIES if n.endswith("_source")]
TEXTS = {"payload", "body", "html", "description", "job", "full_text", "text_lc", "_p", "text"}


@pytest.mark.parametrize("name", SOURCES)
def test_no_text_of_a_source_is_shuffled(spark, sf, name):
    df = catalog.QUERIES[name](spark, sf)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    for columns in re.findall(r"\) (?:Broadcast)?Exchange *\nInput \[\d+\]: \[([^\]]*)\]", text):
        moved = {c.split("#")[0].strip() for c in columns.split(",")}
        assert not moved & TEXTS, (name, moved)


@pytest.mark.parametrize("name", [n for n in SOURCES if n not in ("search_page_source", "startup_source", "every_source")])
def test_sources_stay_in_the_jvm(spark, sf, name):
    assert "Python" not in plan(catalog.QUERIES[name](spark, sf))


def test_card_pages_are_parsed_once(spark, sf):
    assert plan(catalog.QUERIES["search_page_source"](spark, sf)).count("ArrowEvalPython") == 1


@pytest.mark.parametrize("name", ["feed_monitor_source", "organisation_monitor_source"])
def test_accounts_are_told_before_texts_are_read(spark, sf, name):
    text = plan(catalog.QUERIES[name](spark, sf))
    # lines further down run earlier
    last_text = max(text.rindex("full_text"), text.rindex("text_lc"))
    assert text.count("BroadcastNestedLoopJoin") == 1 and text.index("BroadcastNestedLoopJoin") > last_text
    assert text.index("LeftSemi") < text.index("BroadcastNestedLoopJoin")  # the exact one, of narrow rows


def exchanges(df):
    return len(re.findall(r"(?:Broadcast|\+- |:- )Exchange|BroadcastExchange", plan(df)))


def test_matching_reads_a_stored_index(spark, sf):
    assert exchanges(catalog.QUERIES["account_match"](spark, sf)) <= 8
    assert exchanges(catalog.QUERIES["company_rollup"](spark, sf)) <= 12


def test_recent_days_are_the_only_folders_read(spark, sf):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")  # else the filters are cut short in the text
    try:
        text = plan(catalog.QUERIES["recent_feed"](spark, sf))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", text)[1]
    assert "source" in filters and "landed_on" in filters and "2024-01-17" in filters


@pytest.mark.parametrize("name", ["search_page_source", "account_board_source"])
def test_sources_are_read_in_one_scan(spark, sf, name):
    text = plan(catalog.QUERIES[name](spark, sf))
    scans = re.findall(r"Scan parquet [^\n]*documents\.parquet|FileScan parquet [^\n]*documents\.parquet", text)
    # the bindings build the payloads of the three boards of accounts from a scan each
    assert len(scans) == (3 if name == "account_board_source" else 1) and text.count("full_text") > 0
    assert text.count("ArrowEvalPythonUDTF") == (name == "search_page_source")
