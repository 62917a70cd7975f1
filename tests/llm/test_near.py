"""N-gram join, repeated passages, decontamination and licenses against brute force."""

import collections
import re

import numpy as np
import pyarrow as pa
import pytest

from signalloom.llm import components, decontaminate, licenses, ngram_join, repeats, words

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UP))


def shingles(text, n=5):
    w = split(text)
    return frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else \
        frozenset([tuple(w)] if w else [])


def roots(n, pairs):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    for a, b in pairs:
        up[max(find(a), find(b))] = min(find(a), find(b))
    return [find(x) for x in range(n)]


def test_words_agree_with_pattern(rows):
    texts = [r[1] for r in rows]
    for table, pattern in ((words.WHITE, r"[^\x20\x09-\x0D]+"), (words.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        got = [None] * len(texts)
        for i, j, w in words.groups(pa.array(texts, pa.string()), table):
            for d in range(j - i):
                got[i + d] = w.join(int(w.first[d]), int(w.first[d + 1])).decode()
        assert got == [" ".join(re.findall(pattern, (t or "").translate(UP))) for t in texts]


def test_hashes_do_not_depend_on_place():
    big = "start " + "word " * 400_000 + "end"
    (_, _, w), = words.groups(pa.array([big]), words.WHITE)
    assert len(w.hash) == 400_002 and len(set(w.hash.tolist())) == 3


@pytest.mark.parametrize("percent", [75, 50])
def test_near_groups(docs, rows, percent):
    sets = [shingles(r[1]) for r in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    root = roots(len(rows), pairs)
    members = collections.defaultdict(list)
    for k, r in enumerate(root):
        members[r].append(rows[k][0])
    least = [min((x for x in members[r] if x is not None), default=None) for r in root]
    want = sorted((repr(rows[k][0]), len(sets[k]), repr(least[k])) for k in range(len(rows)))
    got = ngram_join.near_groups(docs, percent=percent).collect()
    assert sorted((repr(r["doc_id"]), r["n_shingles"], repr(r["component_id"])) for r in got) == want
    assert len(pairs) > 20


def test_owners_are_packed_and_read_back():
    rng = np.random.default_rng(3)
    for n in (1, 7, 255, 256, 3000):
        owners = np.sort(np.concatenate([np.full(n, 5), rng.integers(0, 2 * ngram_join.SLICE, 400)]))
        own, count = ngram_join._runs(owners)
        back = np.repeat(ngram_join._offsets(ngram_join._steps(own)), np.frombuffer(count.tobytes(), np.uint8))
        assert back.tolist() == owners.tolist()


def test_fine_classes_give_the_same(docs, monkeypatch):
    want = sorted(map(repr, ngram_join.near_groups(docs).select("doc_id", "component_id").collect()))
    made = ngram_join._described
    # a band that counts as short is done again with every shingle a class of its own
    monkeypatch.setattr(ngram_join, "CLASSES", 0.004)
    assert sorted(map(repr, ngram_join.near_groups(docs).select("doc_id", "component_id").collect())) == want
    assert ngram_join._described is made


def test_one_of_each(docs, rows):
    got = ngram_join.one_of_each(docs)
    assert got.columns == docs.columns
    left = got.collect()
    ids = ngram_join.near_groups(docs).select("doc_id", "component_id").collect()
    assert {r["doc_id"] for r in left} >= {r["component_id"] for r in ids if r["component_id"] is not None}
    sets = [s for s in (shingles(r["text"]) for r in left) if s]
    assert len(sets) == len(set(sets))


def test_bands_cover_all_partners():
    for size in range(1, 400):
        for other in range(size, size * 100 // 75 + 1):
            shared = {b for b, _ in ngram_join.bands(size, 75)} & {b for b, _ in ngram_join.bands(other, 75)}
            assert shared
            apart = [dict(ngram_join.bands(x, 75)) for x in (size, other)]
            assert any(min(a[b] for a in apart) >= ngram_join.most_apart(size, other, 75) for b in shared)


def test_sketch_is_a_lower_bound():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a = np.unique(rng.integers(0, 2**63, 300, dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.8], rng.integers(0, 2**63, 50, dtype=np.uint64)]))
        apart = bin(int.from_bytes((ngram_join.parity_sketch(a) ^ ngram_join.parity_sketch(b)).tobytes(), "big")).count("1")
        assert apart <= len(np.setxor1d(a, b))


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (170, 2))] + [(400 + k, 401 + k) for k in range(60)] \
        + [(500, 500 + k) for k in range(1, 200)] + [(None, 4), (7, 7)]
    root = roots(900, [(a, b) for a, b in edges if a is not None])
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for a, b in edges if a is not None and a != b for x in (a, b)}
    assert got == {x: root[x] for x in nodes}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_empty(nothing):
    assert ngram_join.near_groups(nothing).count() == 0
    assert ngram_join.one_of_each(nothing).count() == 0
    assert repeats.repeated_passages(nothing).count() == 0
    assert licenses.scan(nothing).count() == 0


@pytest.mark.parametrize("least,gram", [(50, 25), (20, 8)])
def test_repeated_passages(docs, rows, least, gram):
    seen = collections.defaultdict(set)
    texts = [split(r[1]) for r in rows]
    for k, w in enumerate(texts):
        for i in range(len(w) - least + 1):
            seen[tuple(w[i:i + least])].add(k)
    want = collections.Counter()
    for k, w in enumerate(texts):
        hit = {x for i in range(len(w) - least + 1) if len(seen[tuple(w[i:i + least])]) > 1 for x in range(i, i + least)}
        want.update((rows[k][0], x) for x in hit)
    got = collections.Counter()
    for r in repeats.repeated_passages(docs, least=least, gram=gram).collect():
        assert r["n_words"] == r["end_word"] - r["first_word"] >= least
        got.update((r["doc_id"], x) for x in range(r["first_word"], r["end_word"]))
    assert got == want and want


def test_repeats_in_parts(docs, monkeypatch):
    want = {r["doc_id"] for r in repeats.repeated_passages(docs).collect()}
    assert want == {r["doc_id"] for r in repeats.repeated_passages(docs.repartition(2)).collect()}


@pytest.mark.parametrize("size", [10_000, 3])
def test_repeats_apart_in_both_orders(spark, size):
    """Two documents share 12 words left and 13 right of a core; others share more with each on one side only."""
    def grams(text):
        (_, _, w), = words.groups(pa.array([" ".join(text)]), words.WHITE)
        return words.chained(w.hash, 25)
    core = min(([f"c{t}x{k}" for k in range(25)] for t in range(3000)), key=lambda x: int(grams(x)[0]))
    own = lambda name, n=30: [f"{name}o{k}" for k in range(n)]
    for t in range(1000):
        left, right = [f"l{t}x{k}" for k in range(12)], [f"r{t}x{k}" for k in range(13)]
        texts = [own(x) + left + core + right + own(x + "z") for x in "ab"]
        anchors = [{int(g[p]) for p in repeats.anchors(g, 26)} for g in map(grams, texts)]
        if anchors[0] & anchors[1] == {int(grams(core)[0])}:
            break
    for x in "ab":
        for k in range(12):
            texts.append(own(f"{x}p{k}") + core + right + own(x + "z", 1 + k % 2) + own(f"{x}q{k}"))
            texts.append(own(f"{x}s{k}") + own(x)[-1 - k % 2:] + left + core + own(f"{x}t{k}"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    try:
        frame = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
        got = repeats.repeated_passages(frame).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = {r["doc_id"]: (r["first_word"], r["end_word"], r["other_doc_id"]) for r in got}
    assert got == {0: (30, 80, 1), 1: (30, 80, 0)}


ITEMS = [(1, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12"), (2, "short item"), (3, ""), (4, None), (None, "no NUMBER"),
         (5, "x"), (6, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10"), (2, "short item"), (10, "Be be be")]


def brute(rows, items, window):
    word = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(UP))
    out = []
    for doc_id, text, *_ in rows:
        w = word(text)
        hit, found = set(), set()
        for item, item_text in items:
            v = word(item_text)
            n = min(window, len(v))
            tests = {tuple(v[k:k + n]) for k in range(len(v) - n + 1)} if n else set()
            at = [k for k in range(len(w) - n + 1) if tuple(w[k:k + n]) in tests] if tests else []
            hit.update(x for k in at for x in range(k, k + n))
            if at:
                found.add("" if item is None else str(item))
        out.append((doc_id, len(w), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 22, 40])
def test_contamination(spark, rows, block_bytes):
    passage = ITEMS[0][1]
    extra = [(900, "start " + passage.upper().replace(" ", ", ") + " end", "en", "a"), (901, passage[:-4], "en", "a"),
             (902, "Short - item; short item x", "en", "a"), (903, "short", "en", "a"), (904, (passage + " z ") * 3, "en", "a"),
             (905, "be be be be no number", "en", "a")]
    frame = spark.createDataFrame(rows + extra, "doc_id long, text string, lang string, source string").repartition(3)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.contamination(frame, bench, block_bytes=block_bytes).collect()
    got = [(r["doc_id"], r["n_words"], sum(s["last"] - s["first"] for s in r["spans"]), sorted(r["items"])) for r in got]
    assert sorted(got, key=repr) == sorted(brute(rows + extra, ITEMS, 10), key=repr)


def test_random_search():
    rng = np.random.default_rng(5)
    letters = "abcde"
    text = lambda n: " ".join(letters[x] for x in rng.integers(0, 5, n))
    items = [(k, text(int(rng.integers(1, 9)))) for k in range(25)]
    rows = [(k, text(int(rng.integers(0, 120)))) for k in range(60)]
    names, tables = decontaminate.build([(str(k), t) for k, t in items], 4)
    got = []
    for i, j, w in words.groups(pa.array([t for _, t in rows]), words.ALNUM):
        hits = collections.defaultdict(lambda: (set(), set()))
        for p in tables:
            for at, which in p.occurrences(w):
                d = int(np.searchsorted(w.first, at, "right")) - 1
                hits[d][0].update(range(at, at + p.length))
                hits[d][1].update(names[x] for x in p.items[which])
        got += [(rows[d][0], int(w.first[d + 1] - w.first[d]), len(hits[d][0]), sorted(hits[d][1])) for d in range(j - i)]
    assert got == brute(rows, items, 4)


def test_clean(spark, docs, nothing):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    bad = decontaminate.contamination(docs, bench).where("size(spans) > 0").count()
    assert bad > 0
    got = decontaminate.clean(docs, bench)
    assert got.columns == docs.columns and got.count() == docs.count() - bad
    assert decontaminate.clean(nothing, bench).count() == 0
    assert decontaminate.clean(docs, bench.limit(0)).count() == docs.count()


def test_patience():
    assert licenses.patience([1, 2, 3, 4], [1, 2, 3, 4]) == [(0, 0), (1, 1), (2, 2), (3, 3)]
    assert licenses.patience([9, 1, 9, 2, 3], [1, 2, 3]) == [(1, 0), (3, 1), (4, 2)]
    assert licenses.patience([], [1]) == []
    rng = np.random.default_rng(2)
    for _ in range(200):
        a, b = rng.integers(0, 12, 20).tolist(), rng.integers(0, 12, 15).tolist()
        pairs = licenses.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
    perm = rng.permutation(40).tolist()
    assert len(licenses.patience(perm, sorted(perm))) >= len(licenses.rising(perm))


def test_licenses(spark, docs):
    pad = "nothing of that kind here " * 30
    texts = {name: pad + ts[-1] + " " + pad for name, ts in licenses.TEMPLATES.items()}
    rows = [(k, t, name) for k, (name, t) in enumerate(texts.items())]
    rows += [(100, "Released under the terms of the MIT License. " + pad + "released under THE mit license", "MIT"),
             (101, pad, None), (102, None, None), (103, "", None),
             (104, "Licensed under the Apache Licence, Version 2.0", "Apache-2.0")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, want string")
    got = collections.defaultdict(dict)
    for r in licenses.scan(frame).collect():
        got[r["doc_id"]][r["license"]] = r["coverage"]
    for k, _, name in rows:
        assert (name in got[k]) if name else not got[k], (k, name, got[k])
    assert got[100]["MIT"] == 1.0
    assert licenses.scan(docs).count() == 0


@pytest.mark.parametrize("text,want", [
    ("Licensed under CC BY 4.0", ["CC-BY-4.0"]),
    ("Licensed under CC BY-SA 4.0", ["CC-BY-SA-4.0"]),
    ("Licensed under CC BY-NC-SA 4.0", ["CC-BY-NC-SA-4.0"]),
    ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]),
    ("licensed under the GNU General Public License, version 2", ["GPL-2.0"]),
    ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0"]),
    ("This work is licensed under the GNU General Public License, version 4.", []),
    ("licensed under the GNU Lesser General Public License, version 2.1", ["LGPL-2.1"]),
    ("under the GNU Affero General Public License, version 3", ["AGPL-3.0"]),
    ("Mozilla Public License, Version 2.0", ["MPL-2.0"]), ("Mozilla Public License, Version 1.1", []),
    ("Eclipse Public License v2.0", ["EPL-2.0"]), ("CC0 1.0 Universal", ["CC0-1.0"]),
    ("Licensed under the Apache License, Version 1.1", []),
    *[(t, [name]) for name, texts in licenses.TEMPLATES.items() for t in texts],
])
def test_licenses_are_told_apart(text, want):
    pad = "nothing of that kind here " * 5
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": [pad + text + " " + pad]})
    out, = licenses._scan(licenses.TEMPLATES, 0.85)([batch])
    assert out.column("license").to_pylist() == want


def test_all_notices_are_returned():
    text = "a Licensed under CC BY 4.0 b c Released under the MIT License d Licensed under CC BY 4.0 Licensed under CC BY 4.0"
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": [text]})
    out, = licenses._scan(licenses.TEMPLATES, 0.85)([batch])
    got = [(r["license"], r["coverage"], r["first_word"], r["end_word"]) for r in out.to_pylist()]
    assert got == [("CC-BY-4.0", 1.0, 1, 7), ("MIT", 1.0, 9, 14), ("CC-BY-4.0", 1.0, 15, 21), ("CC-BY-4.0", 1.0, 21, 27)]
