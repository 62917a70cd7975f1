"""Small tables that hold every awkward case."""

import random

import pytest

#: Columns that clash with names the operators use inside.
EXTRA = {"row": 1, "text_hash": "x", "size": 2.5, "n": None, "key": "k", "first": 3, "whole": "w", "_id": 9,
         "kept": "no", "score": "s", "spans": "p", "_digest": "d"}


def words(rng, n, vocabulary=2000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def corpus(seed=7):
    """(doc_id, text, lang, source) rows: copies, near copies, shared passages, odd texts."""
    rng = random.Random(seed)
    rows, texts = [], []
    for i in range(120):
        kind = rng.random()
        if i < 20 or kind < 0.5:
            text = words(rng, rng.choice([1, 2, 4, 5, 6, 30, 80, 200, 700]))
        elif kind < 0.65:
            text = list(rng.choice(texts))
        elif kind < 0.85:
            text = list(rng.choice(texts))
            for _ in range(max(1, len(text) // 60)):
                text[rng.randrange(len(text))] = "edit"
        else:
            text = words(rng, 60) + rng.choice(texts)[:70] + words(rng, 20)
        texts.append(text)
        rows.append((i, " ".join(text), "en", f"s{i % 7}"))
    odd = [None, "", "   \n\t ", "ÄÖ É ß", "Same Text Here", "SAME text here", "same TEXT here", "x" * 200_000,
           "a b c d e " * 4000, "\n\n", "1 2 3 4", "one word", "tab\tand\x0bvt", "é" * 300, "be " * 400]
    rows += [(200 + k, t, None if k % 2 else "de", None if k % 3 == 0 else "s1") for k, t in enumerate(odd)]
    rows += [rows[3], rows[3], rows[3][:1] + ("another text under a used number",) + rows[3][2:]]
    rows += [(None, "no number", "en", "s2"), (None, "no number", "en", "s2"), (None, None, None, None)]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    """The corpus with clashing extra columns, over several partitions."""
    from pyspark.sql import functions as F
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    path = str(tmp_path_factory.mktemp("llm") / "docs")
    frame.withColumns({c: F.lit(v) for c, v in EXTRA.items() if v is not None}).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.limit(0)
