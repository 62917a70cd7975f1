"""Hard negatives against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from signalloom.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, row string, score double, parts string, rank int"


def vectors(seed, n=260, width=12, spread=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, spread) for _ in range(width)] for _ in range(3)]
    rows = []
    for i in range(n):
        c = rng.choice(centres)
        rows.append((i, [float(np.float32(x + rng.gauss(0, spread / 3))) for x in c], rng.choice([0, 1, 2, 7])))
    rows += [(1000 + k, rows[0][1], k % 2) for k in range(40)]  # one vector many times
    rows += [rows[20], rows[20], rows[40], rows[41]]  # rows that repeat, anchors too
    rows += [(2001, None, 1), (2002, rows[1][1], None), (2003, [float("nan")] * width, 1), (2004, [None, 1.0], 1),
             (2005, [float("inf")] * width, 0), (None, rows[2][1], 1), (None, rows[2][1], 0), (2006, [], 1),
             (2020, rows[3][1][:5], 2), (-20, rows[5][1], 0)]
    return rows


def expected(rows, n_positives=5, n_negatives=5, low=80, high=100, every=20):
    used = [(r[0], [math.floor(256 * x) for x in r[1]], r[2]) for r in rows
            if r[1] is not None and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    out = []
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    for a in used:
        if a[0] is None or a[0] % every:
            continue
        scored = [(sum(x * y for x, y in zip(a[1], b[1])), b[0], b[2]) for b in used if b is not a]
        for p in sorted((s for s in scored if s[2] == a[2]), key=order)[:n_positives]:
            fit = [s for s in scored if s[2] != a[2] and low * p[0] <= 100 * s[0] <= high * p[0]]
            fit = sorted(fit, key=order)[:n_negatives]
            out += [(a[0], p[1], rank + 1, s[1], p[0], s[0]) for rank, s in enumerate(fit)]
    return sorted(map(repr, out))


def mined(spark, rows, **more):
    frame = spark.createDataFrame([r + ("x", 1.5, "p", 3) for r in rows], SCHEMA).repartition(4)
    got = negatives.mine(frame, F.col("vec_id") % 20 == 0, **more)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(repr(tuple(r)) for r in got.collect())


@pytest.mark.parametrize("spread", [0.3, 1.0, 3e5])
def test_brute_force(spark, spread):
    # the last spread needs fields of more than eight bytes
    rows = vectors(3, spread=spread)
    got = mined(spark, rows)
    assert got == expected(rows) and len(got) > 100


def test_blocks_packs_and_bounds(spark, monkeypatch):
    rows = vectors(4)
    monkeypatch.setattr(negatives, "PACK", 7)
    monkeypatch.setattr(negatives, "HELD", 3)
    assert mined(spark, rows, block_bytes=1000) == expected(rows)
    limits = {"n_positives": 2, "n_negatives": 9, "low": 50, "high": 90}
    assert mined(spark, rows, **limits) == expected(rows, **limits)


def test_fields_hold_the_exact_scores():
    rng = np.random.default_rng(5)
    for top in (3, 300, 1 << 20, 1 << 40):
        rows = rng.integers(-top, top, (50, 9), endpoint=True)
        pack = negatives.Pack(rows, (-top, top))
        for a in rng.integers(-top, top, (4, 9), endpoint=True):
            want = [max(-negatives.LAST, min(negatives.LAST, sum(int(x) * int(y) for x, y in zip(a, r)))) for r in rows]
            assert pack.scores(a).tolist() == want


def test_far_components_and_nothing(spark):
    rows = [(0, [1e300, -1e300], 1), (1, [1e300, 1.0], 1), (2, [-3e38, 2.0], 0), (20, [1.0, 1.0], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert isinstance(negatives.mine(frame, F.col("vec_id") % 20 == 0).collect(), list)
    empty = negatives.mine(frame.limit(0), F.col("vec_id") % 20 == 0)
    assert empty.collect() == [] and empty.columns[0] == "anchor_id"
    assert negatives.mine(frame.where("vec_id = 1"), F.col("vec_id") % 20 == 0).collect() == []
