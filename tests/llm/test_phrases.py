"""Phrase mining against brute force."""

import collections
import random
import re

import pytest

from signalloom.llm import phrases

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts(seed=1):
    rng = random.Random(seed)
    vocabulary = ["new", "york", "city", "Bank", "of", "the", "a", "É", "état", "don't", "x-y", " ", "\x00"]
    rows = []
    for i in range(300):
        words = rng.choices(vocabulary, weights=[8, 6, 5, 4, 9, 9, 6, 2, 2, 2, 2, 1, 1], k=rng.choice([0, 1, 2, 9, 40]))
        if rng.random() < 0.4:
            words += ["New", "York", "CITY"]
        out = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!? ", "\r\n", ";:", "\x0b"]) for w in words)
        rows.append((i, out, rng.choice(["en", "fr", None, "und", ""])))
    rows += [(900, None, "en"), (901, "", "en"), (902, " .. \n", None), (903, None, None), (None, "a " * 3000, "en"),
             (905, "only here", "xx"), (906, "very " * 30_000 + "long", "de"), rows[3], rows[3], rows[5]]
    return rows


def expected(rows, longest=3, least=10, top=2000, inside=50):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UP)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang if lang is not None else "und"] += len(words)
            for k in range(1, longest + 1):
                f[lang if lang is not None else "und"].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in candidates.items():
            if any(100 * b >= inside * a for q, b in candidates.items() if len(q) > len(p)
                   and any(q[i:i + len(p)] == p for i in range(len(q)))):
                continue
            score, _, left, right = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]])
                                        for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(kept)[:top])]
    return sorted(out)


def mined(spark, rows, **more):
    frame = spark.createDataFrame([r + ("p", 1, 2, 0, 9) for r in rows], "doc_id long, text string, lang string, "
                                  "phrase string, count int, n int, shard int, reached int").repartition(3)
    got = phrases.collocations(frame, **more)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("more", [{}, {"longest": 4, "shards": 3, "least": 6}, {"longest": 2, "shards": 1, "top": 7},
                                  {"shards": 5, "least": 3, "inside": 90}])
def test_brute_force(spark, more):
    rows = texts()
    got = mined(spark, rows, **more)
    assert got == expected(rows, **{k: v for k, v in more.items() if k != "shards"}) and len(got) > 10


@pytest.mark.parametrize("slots", [1, 64, 4096])
def test_full_tables_only_cost_work(spark, monkeypatch, slots):
    # with few slots phrases whose parts were not reached are counted too, or from an earlier scan on
    rows = texts(2) + [(i, f"u{i % 700} v{i % 611} w{i % 13} {i}", "en") for i in range(3000)]
    want = expected(rows, least=2)
    monkeypatch.setattr(phrases, "SLOTS", slots)
    assert mined(spark, rows, least=2) == want


def test_counts_and_languages(spark):
    rows = texts(3)
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {(r["lang"], r["phrase"]): r["count"] for r in phrases.frequent(frame, shards=2).collect()}
    assert found["en", "a a a"] >= 2998 and ("en", "") in found and ("xx", "") in found and ("xx", "only") not in found


def test_large_counts_are_exact(spark, monkeypatch):
    big = 4_000_000_000_000
    state = spark.createDataFrame([("en", "", 0, big * 9), ("en", "a", 1, big + 3), ("en", "b", 1, big + 1), ("en", "a b", 2, big)],
                                  "lang string, phrase string, n int, count long")
    monkeypatch.setattr(phrases, "frequent", lambda *a: state)
    (row,) = phrases.collocations(state.select("lang", "phrase")).collect()
    assert row["score"] == 10**6 * big * big // ((big + 3) * (big + 1)) and (row["l"], row["r"]) == (big + 3, big + 1)


def test_nothing(spark):
    frame = spark.createDataFrame([(1, None, "en")], "doc_id long, text string, lang string")
    assert phrases.collocations(frame).collect() == []
    assert phrases.collocations(frame.limit(0)).collect() == []
