"""Exact dedup, line dedup and mixing against brute force."""

import collections
import hashlib
import math
import re

import pytest

from signalloom.llm import exact_dedup, line_dedup, mixing

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def norm(text):
    return (text or "").translate(UP)


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("fan_in", [2, 8])
def test_exact_groups(docs, rows, keep, fan_in):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[norm(r[1])].append(r[0])
    got = exact_dedup.exact_groups(docs, keep=keep, fan_in=fan_in).collect()
    assert len(got) == len(rows)
    kept = collections.Counter()
    for r in got:
        text = next(t for t in groups if hashlib.sha256(t.encode()).hexdigest() == r["text_sha256"])
        ids = [x for x in groups[text] if x is not None]
        best = (max if keep == "largest" else min)(ids) if ids else None
        assert (r["keep_id"], r["group_size"]) == (best, len(groups[text]))
        if r["kept"]:
            kept[text] += 1
            assert r["doc_id"] == best
    assert kept == collections.Counter(list(groups))


def test_deduplicated(docs, rows):
    got = exact_dedup.deduplicated(docs)
    assert got.columns == docs.columns
    got = got.collect()
    assert sorted(norm(r["text"]) for r in got) == sorted({norm(r[1]) for r in rows})


def test_exact_empty(nothing):
    assert exact_dedup.exact_groups(nothing).count() == 0
    assert exact_dedup.deduplicated(nothing).count() == 0


def test_exact_option():
    with pytest.raises(ValueError):
        exact_dedup.exact_groups(None, keep="first")


@pytest.mark.parametrize("min_sites", [2, 4])
def test_lines(spark, docs, rows, min_sites):
    more = [(1000 + k, f"Share this\n  only {k}  \n\nFollow us \r\nend{k % 2}", "en", f"s{k % 5}") for k in range(9)]
    frame = spark.createDataFrame(rows + more, "doc_id long, text string, lang string, source string").repartition(4)
    bare = lambda x: x.strip(" \t\r\x0b\x0c")
    sites = collections.defaultdict(set)
    for _, text, _, site in rows + more:
        for line in (text or "").split("\n"):
            if site is not None and bare(line):
                sites[bare(line)].add(site)
    want = []
    for i, text, _, _ in rows + more:
        lines = text.split("\n") if text is not None else []
        left = [x for x in lines if len(sites[bare(x)]) < min_sites]
        want.append((i, len(lines), len(lines) - len(left), "\n".join(left) if text is not None else None))
    got = [tuple(r) for r in line_dedup.without_boilerplate(frame, min_sites=min_sites).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_near_threshold_is_exact(spark):
    lines = [(f"line {n}", f"site{s}") for n in range(80, 121) for s in range(n)]
    frame = spark.createDataFrame([(k, t, s) for k, (t, s) in enumerate(lines)], "doc_id long, text string, source string")
    got = line_dedup.without_boilerplate(frame, min_sites=100).where("n_removed = 0").select("text").distinct().collect()
    assert sorted(r[0] for r in got) == sorted(f"line {n}" for n in range(80, 100))


def test_lines_empty(docs, nothing):
    assert line_dedup.without_boilerplate(nothing).count() == 0
    assert line_dedup.without_boilerplate(docs).columns == ["doc_id", "n_lines", "n_removed", "text"]


def filled(sizes, weights, share=1.5, most=2):
    """Targets by repeated sharing, for comparison."""
    total, capped = share * sum(sizes), set()
    while True:
        free = [k for k in range(len(sizes)) if k not in capped]
        left = total - sum(most * sizes[k] for k in capped)
        level = left / sum(weights[k] for k in free) if free else 0
        over = {k for k in free if weights[k] * level > most * sizes[k]}
        if not over:
            return [most * sizes[k] if k in capped else weights[k] * level for k in range(len(sizes))]
        capped |= over


@pytest.mark.parametrize("block_words", [50, 4096])
def test_mix(docs, rows, block_words):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    by = collections.defaultdict(int)
    for _, text, _, source in rows:
        by[source] += size(text)
    order = sorted(by, key=lambda s: (s is None, s or ""))
    target = dict(zip(order, filled([by[s] for s in order], [(3, 1, 2)[k % 3] for k in range(len(order))])))
    pieces, per_doc = mixing.mix(docs, block_words=block_words)
    got, pieces = per_doc.collect(), pieces.collect()
    assert len(got) == len(rows)
    taken = collections.defaultdict(int)
    for r in got:
        assert (r["source_size"], r["target"]) == (by[r["source"]], pytest.approx(target[r["source"]], abs=1e-5))
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in order:
        assert taken[s] == math.floor(round(target[s], 6) + 0.5)
    assert sum(p["words"] for p in pieces) == sum(taken.values())
    again = mixing.mix(docs.repartition(3), block_words=block_words)[1].select("doc_id", "size", "taken").collect()
    assert sorted(map(repr, again)) == sorted(repr(r) for r in per_doc.select("doc_id", "size", "taken").collect())
    # slots of a source are spread evenly: any stretch of slots has about its share
    slots = collections.defaultdict(set)
    for p in pieces:
        slots[p["source"]].add(p["slot"])
    assert len(set().union(*slots.values())) == sum(map(len, slots.values()))


def test_mix_odd(spark, nothing):
    for part in mixing.mix(nothing):
        assert part.count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, " ", "a")], "doc_id long, text string, source string")
    assert [r["taken"] for r in mixing.mix(blank)[1].collect()] == [0, 0]
    assert mixing.mixed_documents(blank).count() == 0


@pytest.mark.parametrize("block_words", [50, 4096])
def test_mixed_documents(docs, rows, block_words):
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    got = mixing.mixed_documents(docs.withColumnRenamed("size", "skip"), block_words=block_words)
    assert got.columns == docs.withColumnRenamed("size", "skip").columns + [
        "slot", "pass", "skip_", "words", "source_size", "target"]
    pieces = mixing.mix(docs, block_words=block_words)[0].collect()
    got = got.collect()
    assert len(got) == len(pieces)
    assert sorted((repr(r["doc_id"]), r["slot"], r["pass"], r["skip_"], r["words"]) for r in got) == sorted(
        (repr(p["doc_id"]), p["slot"], p["pass"], p["skip"], p["words"]) for p in pieces)
    texts = collections.defaultdict(list)
    for doc_id, text, _, _ in rows:
        texts[doc_id].append(text)
    words, target = collections.Counter(), {}
    for r in got:
        own = split(r["text"])
        assert len(own) == r["words"] and any(split(t)[r["skip_"]:r["skip_"] + r["words"]] == own for t in texts[r["doc_id"]])
        if r["skip_"] == 0 and any(len(split(t)) == r["words"] for t in texts[r["doc_id"]]):
            assert r["text"] in texts[r["doc_id"]]
        words[r["target"], r["source_size"]] += r["words"]
        target[r["target"], r["source_size"]] = r["target"]
    once = collections.Counter(r["target"] for r in mixing.mix(docs)[1].select("source", "target").distinct().collect())
    for key, total in words.items():
        assert total == once[key[0]] * math.floor(key[0] + 0.5)
