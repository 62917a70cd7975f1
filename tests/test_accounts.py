"""Matching, tiers and deduplication against brute force."""

import random

from pyspark.sql import functions as F

from signalloom import files
from signalloom.operators import accounts as A, dedup

COLUMNS = ("list string, row_no long, name string, domain string, zoominfo_id string, "
           "vertical string, industry string, zi_industry string, city string, state string")


def accounts(spark, rows):
    """rows: (list, name, domain)"""
    full = [(lst, i, name, domain, str(i), "", "", "", "", "")
            for i, (lst, name, domain) in enumerate(rows)]
    return spark.createDataFrame(full, COLUMNS)


def brute(rows, company, domain):
    """The documented waterfall over plain lists; names here are already normalised."""
    def find(lst):
        mine = [(i, n, d) for i, (x, n, d) in enumerate(rows) if x == lst]
        by_domain = {d: i for i, n, d in mine if d}
        by_name = {}
        for i, n, d in mine:
            by_name[n] = i
        if domain and domain in by_domain:
            return by_domain[domain]
        if company in by_name:
            return by_name[company]
        tokens = set(company.split())
        if len(tokens) >= 2:
            for name, i in by_name.items():
                if tokens <= set(name.split()):
                    return i
        return None
    for lst in ("managed", "unmanaged"):
        hit = find(lst)
        if hit is not None:
            return lst, str(hit)
    return "prospect", None


def test_waterfall_matches_brute_force(spark):
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "hot"]
    rows = []
    for _ in range(120):
        name = " ".join(["hot"] * (rng.random() < .6) + rng.sample(words[:7], rng.randint(1, 4)))
        rows.append((rng.choice(["managed", "unmanaged", "unmanaged"]), name,
                     rng.choice(["", f"{rng.choice(words)}.com"])))
    asked = [(" ".join(rng.sample(words, rng.randint(1, 3))),
              rng.choice(["", f"{rng.choice(words)}.com", "new.com"])) for _ in range(150)]
    companies = spark.createDataFrame(sorted(set(asked)), "company string, domain string")
    got = A.match_accounts(companies, accounts(spark, rows), "company", "domain").collect()
    assert len(got) == len(set(asked))
    for r in got:
        found = r.account.zoominfo_id if r.account else None
        assert (r.segment, found) == brute(rows, r.company, r.domain), r


def test_hot_tokens(spark):
    rng = random.Random(9)
    rows = [("managed" if i % 3 else "unmanaged",
             f"acme store {rng.choice('abcdefgh')}{i} {rng.choice(['north', 'south'])}", "")
            for i in range(300)]
    names = A.name_index(accounts(spark, rows))
    asked = spark.createDataFrame([("acme store",), ("store north",), ("acme south",),
                                   ("acme",), ("acme nowhere",), ("south store acme",)],
                                  "nn string")
    found = {r.nn: r for r in A.token_matches(asked, names).collect()}
    assert set(found) == {"acme store", "store north", "acme south", "south store acme"}
    for nn, r in found.items():
        for kind in ("managed", "unmanaged"):
            first = next(str(i) for i, (k, name, _) in enumerate(rows)
                         if k == kind and set(nn.split()) <= set(name.split()))
            assert r[kind].zoominfo_id == first


def test_managed_tokens_beat_unmanaged_domain(spark):
    table = accounts(spark, [("unmanaged", "zeta", "zeta.com"),
                             ("managed", "big zeta north", "other.com")])
    company = spark.createDataFrame([("zeta north", "zeta.com")], "company string, domain string")
    row = A.match_accounts(company, table, "company", "domain").first()
    assert (row.segment, row.account.domain) == ("managed", "other.com")


def test_last_duplicate_wins_and_placeholder_names_are_skipped(spark):
    table = accounts(spark, [("managed", "Acme Inc", "a.com"), ("managed", "ACME", "b.com"),
                             ("managed", "Not Provided", "c.com")])
    index = {r.nn: r for r in A.name_index(table).collect()}
    assert set(index) == {"acme"}
    assert index["acme"].account.domain == "b.com" and index["acme"].first_row == 0


def test_first_and_last_wins_on_a_hot_key(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("k"), F.col("id") % 50)).alias("k"), F.col("id").alias("v"))
    first = {r.k: r.v for r in dedup.first_wins(df, ["k"], "v").collect()}
    last = {r.k: r.v for r in dedup.last_wins(df, ["k"], "v").collect()}
    assert first["hot"] == 0 and last["hot"] == 19998 and len(first) == len(last) == 51


def test_batches_hold_a_hundred_each(spark):
    df = spark.range(1234).select(F.col("id").cast("string").alias("d"))
    sizes = dedup.batches(df, "d", 100).groupBy("batch_id").count().collect()
    assert sorted(r["count"] for r in sizes) == [34] + [100] * 12


def test_sample_is_repeatable_and_seeded(spark):
    df = spark.range(500).select(F.col("id").alias("d"))
    def one(seed):
        return [r.d for r in dedup.hash_sample(df, 50, "d", seed).collect()]
    assert one("a") == one("a") != one("b") and len(set(one("a"))) == 50


def test_an_index_is_built_once_for_each_list(spark, tmp_path):
    table = accounts(spark, [("managed", "Acme Inc", "a.com"), ("unmanaged", "Beta North Labs", "b.com")])
    company = spark.createDataFrame([("labs beta", "x.com"), ("acme", "")], "company string, domain string")
    root = str(tmp_path / "index")
    for _ in range(2):
        found = A.match_accounts(company, A.open_index(table, root), "company", "domain").collect()
        assert {(r.company, r.account.domain) for r in found} == {("labs beta", "b.com"), ("acme", "a.com")}
    built = lambda: len([f for f in (tmp_path / "index").iterdir() if f.name.startswith("tables-")])
    assert built() == 1
    A.open_index(table, root, (("boston", None, "Boston"),))
    A.open_index(table.where("list = 'managed'"), root)
    A.open_index(table.limit(0), root)
    assert built() == 4
    nobody = A.match_accounts(company, A.open_index(table.limit(0), root), "company", "domain").collect()
    assert {r.segment for r in nobody} == {"prospect"}


def test_of_two_writers_of_a_name_one_wins(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    path = str(tmp_path / "some" / "name")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda k: files.create(spark, path, f"text {k}"), range(8)))
    assert won.count(True) == 1 and files.read_text(spark, path) == f"text {won.index(True)}"
    assert files.names(spark, str(tmp_path / "some")) == ["name"] and files.names(spark, str(tmp_path / "none")) == []
    files.delete(spark, path)
    assert files.read_text(spark, path) is None
