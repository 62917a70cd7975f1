"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame

sys.path.insert(0, str(Path(__file__).resolve().parent))

from signalloom.bindings import catalog  # noqa: E402
from signalloom.session import build_session  # noqa: E402

HEADLINE = (
    "lexicon_match", "lexicon_context_match", "html_clean", "keyword_score", "posting_scores",
    "company_market_signals", "company_rollup", "company_sets", "best_posting",
    "supplier_rollup", "account_match", "tiering", "known_and_primary_markets",
    "expansion_flag", "first_wins_dedup", "domain_batches", "snapshot_merge", "velocity_delta",
    "group_topk_more", "alert_payloads", "faceted_search", "liveness", "greenhouse_source",
    "network_source", "feed_monitor_source", "weekly_stream_counts", "account_board_source",
    "startup_source", "search_page_source", "second_run", "targeted_run")


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", **{
        "spark.master": f"local[{cpus}]", "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    run(spark.read.parquet(f"{sf}/documents.parquet").selectExpr("length(text)"))
    took = {}
    for name in HEADLINE:
        start = time.perf_counter()
        run(catalog.QUERIES[name](spark, sf))
        took[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(took.values()), 3),
                      "unit": "sec", "queries": took, "sf": Path(sf).name}))


if __name__ == "__main__":
    main()
