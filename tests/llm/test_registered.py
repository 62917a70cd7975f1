"""The registered queries of this folder against their SQL, and the pipeline."""

import pytest
from compare import compare, duck
from pyspark.sql import functions as F

from signalloom.llm import queries


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, sf, name):
    text, _, ok = compare(spark, duck(sf), name, queries.QUERIES[name], queries.SQL.get(name), sf)
    assert ok, text


def test_held_out_accuracy(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")  # enough labels to tell
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = queries.op1_language_id(spark, sf).join(docs, "doc_id").where("held_out AND lang IS NOT NULL")
    assert found.where("lang = lang_pred").count() >= 0.97 * found.count() > 0
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scored = queries.op4_quality(spark, sf).join(labels, "doc_id").where("held_out")
    assert scored.where("quality = predicted").count() >= 0.85 * scored.count() > 0


def test_quality_ranks_what_it_has_not_seen(spark, sf):
    sf = sf.replace("sf0.001", "sf0.1")  # hundreds of held-out labels of either kind
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("quality IS NOT NULL")
    rows = queries.op4_quality(spark, sf).join(labels, "doc_id").where("held_out").select("score", "quality", "predicted").collect()
    ranked = sorted(rows, key=lambda r: r["score"])
    good = sum(r["quality"] for r in rows)
    bad = len(rows) - good
    assert min(good, bad) > 50
    # the share of pairs of a good and a bad document that are in the right order; ties count half by their mean rank
    ranks, k = {}, 0
    while k < len(ranked):
        j = k
        while j < len(ranked) and ranked[j]["score"] == ranked[k]["score"]:
            j += 1
        ranks[ranked[k]["score"]], k = (k + 1 + j) / 2, j
    auc = (sum(ranks[r["score"]] for r in rows if r["quality"]) - good * (good + 1) / 2) / (good * bad)
    right = [sum(r["predicted"] == q for r in rows if r["quality"] == q) / n for q, n in ((0, bad), (1, good))]
    assert auc >= 0.97 and sum(right) / 2 >= 0.9, (auc, right)


def test_pipeline(spark, sf):
    import corpus_pipeline
    from signalloom.llm import decontaminate, exact_dedup, mixing, ngram_join
    from signalloom.session import stored

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(stored(stage(spark, kept[-1], sf), "kept"))
        assert kept[-1].columns == docs.columns
        assert kept[-1].exceptAll(kept[-2]).count() == 0
    told, unique, apart, clean = kept[1:]
    assert told.count() >= 0.95 * docs.count()
    assert exact_dedup.exact_groups(unique).where("NOT kept").count() == 0
    near = ngram_join.near_groups(unique).select("component_id").distinct().count()
    assert apart.count() == near == ngram_join.near_groups(apart).select("component_id").distinct().count()
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    found = decontaminate.report(decontaminate.contamination(apart, bench))
    assert clean.count() == found.where("NOT contaminated").count()
    got = corpus_pipeline.STAGES[-1][1](spark, clean, sf)
    share = mixing.mix(clean)[1].where("taken > 0").select("doc_id", "taken")
    words = got.groupBy("doc_id").agg(F.sum(mixing.word_count(F.col("text"))).alias("taken"))
    assert words.exceptAll(share).count() == 0 and words.count() == share.count()
    for r in got.groupBy("source", "target").agg(F.sum("words").alias("words")).collect():
        assert abs(r["words"] - r["target"]) <= 1
    assert got.where("n_chars != length(text)").count() == 0
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, sf).select("doc_id").collect()) == sorted(
        r["doc_id"] for r in got.select("doc_id").collect())
