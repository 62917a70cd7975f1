"""Text expressions against brute force in Python."""

import html
import html.entities
import random
import re

from pyspark.sql import functions as F

from signalloom.functions import names as N, scoring as S, text as X
from signalloom.lexicon import PERK_CONTEXT, PERK_LEXICON, PERK_RUBRIC, PERK_TERMS
from signalloom.operators import liveness, markets as M
from signalloom.operators.rollup import with_scores


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "i long, t string")


def brute_hits(text, lexicon=PERK_LEXICON):
    low, out = text.lower(), []
    for term in lexicon.terms:
        spots = [m.start() for m in re.finditer(f"(?={re.escape(term)})", low)]
        if term in lexicon.needs_context:
            spots = [p for p in spots if any(
                c in low[max(0, p - 300):p + len(term) + 300] for c in lexicon.context)]
        if spots:
            out.append(term)
    return out


def test_hits_match_brute_force_around_the_window(spark):
    rng = random.Random(5)
    values = ["", "FREE LUNCH for all", "we ship for DoorDash", "total rewardsharebite",
              "grubhubenefit", "foodoordash", "fully stocked kitchen"]
    for _ in range(600):
        term = rng.choice(sorted(PERK_LEXICON.needs_context))
        word = rng.choice(PERK_CONTEXT)
        gap = rng.choice([0, 1, 150, *range(300 - len(word) - 2, 304)])
        filler = "".join(rng.choice("xyzé \n") for _ in range(gap))
        parts = [word, filler, term] if rng.random() < .5 else [term, filler, word]
        values.append("q" * rng.randint(0, 9) + "".join(parts) + "z" * rng.randint(0, 400))
    rows = X.with_hits(texts(spark, values), "t", PERK_LEXICON).collect()
    assert len(rows) == len(values)
    for row in rows:
        assert row.kw == brute_hits(row.t), row.t


def test_gate_words_cover_all_terms():
    gates = X.gate_words(PERK_TERMS)
    assert all(any(g in t for g in gates) for t in PERK_TERMS)
    assert len(gates) < len(PERK_TERMS)


def test_clean_text_decodes_every_entity_once(spark):
    values = ["a <b>x</b>  y", "&lt;li&gt;&amp;lt;", "&#38;amp; &amp;#38;", "&eacute;&hearts;",
              "&copy;&nbsp;&#8212; &#x41;", "AT&T &amp &ampx; &notanentity;", "", "  \n ",
              "3 < 4 and 5 > 4", "&amp;amp;amp;", "　wide x\x1cy\x85z"]
    rows = X.with_clean_text(texts(spark, values), "t", "c").orderBy("i").collect()
    want = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", " ", v))).strip()
            for v in values]
    assert [r.c for r in rows] == want


def test_excerpt_matches_slicing(spark):
    values = ["free lunch", "x" * 200 + " Free Lunch " + "y" * 200, "none here",
              "a\nfree lunch   " + "b" * 90]

    def brute(text, word):
        at = text.lower().find(word)
        if at < 0:
            return ""
        return "..." + text[max(0, at - 60):at + len(word) + 60].strip() + "..."
    rows = texts(spark, values).select("t", X.excerpt(
        F.col("t"), F.lit("free lunch")).alias("e")).collect()
    assert all(r.e == brute(r.t, "free lunch") for r in rows)


def test_scores_add_overlapping_terms(spark):
    df = texts(spark, ["fully stocked kitchen", "catered lunch, doordash", ""])
    got = [r.s for r in df.orderBy("i").select(S.weighted_hits("t", PERK_RUBRIC.keyword).alias("s")).collect()]
    assert got == [7, 17, 0]
    job = spark.createDataFrame([("Acme Biotechnology", "Senior Facilities Director", None,
                                  "free lunch", 1, "Greenhouse", "NYC")],
                                "company string, title string, perk_excerpt string, "
                                "food_keywords_matched string, keyword_count int, "
                                "source string, location string")
    one = with_scores(job).first().gtm_score
    # 7 keyword + 2 count + 2 source + (8 + 8 + 5) vertical + (3 + 1) size + 5 persona
    assert one == 7 + 2 + 2 + 21 + 4 + 5


def test_tiers_at_their_edges(spark):
    df = spark.createDataFrame([(s,) for s in (-1, 0, 11, 12, 17, 18, 24, 25, 30, 998, 999)],
                               "s long")
    got = {r.s: (r.c, r.t) for r in df.select(
        "s", S.confidence(F.col("s")).alias("c"), S.icp_tier(F.col("s")).alias("t")).collect()}
    assert got[999] == ("Low", "Very Viable") and got[-1] == ("Low", "Monitor")
    assert got[12] == ("Medium", "Monitor") and got[18] == ("Medium", "Viable")
    assert got[25] == ("High", "Viable") and got[998] == ("High", "Very Viable")


def test_self_reference_needs_brand_in_both(spark):
    df = spark.createDataFrame([("doordash inc", "doordash"), ("acme", "doordash"),
                                ("grubhub", "free lunch")], "c string, k string")
    got = [r.x for r in df.select(S.self_referential(
        F.col("c"), F.col("k"), PERK_RUBRIC).alias("x")).collect()]
    assert got == [True, False, False]


def test_markets_take_the_first_rule(spark):
    df = texts(spark, ["dallas, tx, usa", "manhattan beach", "san diego", "", "boston, ma "])
    got = [r.m for r in df.orderBy("i").select(
        M.location_market("t").alias("m")).collect()]
    assert got == ["Austin", "New York", "Other", "Other", "Boston"]
    rows = spark.createDataFrame([("Arlington", "Texas"), ("arlington ", "Virginia"),
                                  ("Cambridge", ""), ("San Diego", None)], "c string, s string")
    got = [r.m for r in rows.select(M.city_market("c", "s").alias("m")).collect()]
    assert got == ["Dallas", "Washington DC", "Other", "San Diego"]


def test_names_and_urls(spark):
    df = texts(spark, ["The Acme Group, Inc.", "HTTPS://WWW.Mlb.com/padres/", "2U", "???"])
    rows = df.orderBy("i").select(N.normalise_name(F.col("t")).alias("n"), N.normalise_domain(
        F.col("t")).alias("d"), N.guess_domain(F.col("t")).alias("g")).collect()
    assert rows[0].n == "acme" and rows[1].d == "mlb.com"
    assert rows[2].g == "2u.com" and rows[3].g == "unknown.com"
    urls = texts(spark, ["https://boards.greenhouse.io/acme-co/jobs/1",
                         "https://jobs.lever.co/x/1", "https://careers.smartrecruiters.com/us/1",
                         "https://acme.icims.com/jobs/5", "https://blog.example.com/"])
    got = [r.e for r in urls.orderBy("i").select(
        N.employer_from_url(F.col("t")).alias("e")).collect()]
    assert got == ["Acme Co", "", "", "Https://Acme", ""]
    ats = urls.orderBy("i").select(N.ats_fingerprint(F.col("t")).alias("a")).collect()
    assert ats[0].a.ats_slug == "acme-co" and ats[1].a.ats_type == "lever" and ats[4].a is None


def test_iso_week_at_year_end(spark):
    df = spark.createDataFrame([("2027-01-01",), ("2024-12-30",), ("2024-01-01",)], "d string")
    got = [r.w for r in df.select(X.iso_week(F.col("d").cast("date")).alias("w")).collect()]
    assert got == ["2026-53", "2025-01", "2024-01"]


def test_liveness_rules(spark):
    green, ashby = "https://boards-api.greenhouse.io/x", "https://api.ashbyhq.com/y"
    cases = [("", 200, "", None, False, "invalid URL"),
             ("https://a", None, None, "timeout", True, "timeout (assumed live)"),
             ("https://a", None, None, "connection", False, "connection error"),
             ("https://a", None, None, "odd", True, "error (odd) — assumed live"),
             ("https://a", 404, "", None, False, "HTTP 404"),
             ("https://a", 500, "", None, False, "HTTP 500"),
             ("https://a", 301, "fine", None, True, "live"),
             ("https://a", 200, "Position IS Closed.", None, False,
              "page says: 'position is closed'"),
             ("https://jobs.lever.co/a", 200, "position has been filled", None, False,
              "page says: 'position has been filled'"),
             ("https://a", 200, "position has been filled", None, True, "live"),
             (green, 200, '{"is_listed": false}', None, False, "greenhouse: is_listed=false"),
             (green, 200, '{"is_listed": null}', None, False, "greenhouse: is_listed=false"),
             (green, 200, "{}", None, True, "live"),
             (ashby, 200, '{"status": "Draft"}', None, False, "ashby status: draft"),
             (ashby, 200, "no json", None, True, "live")]
    df = spark.createDataFrame([c[:4] for c in cases],
                               "url string, status int, body string, fetch_error string")
    got = [(r.is_live, r.reason) for r in liveness.check(df).collect()]
    assert got == [c[4:] for c in cases]


def test_verify_keeps_uncrawled_pages(spark):
    jobs = spark.createDataFrame([("u1",), ("http://dead",), ("http://live",)], "url string")
    crawl = spark.createDataFrame([("http://dead", 404, "", None), ("http://live", 200, "", None)],
                                  "url string, status int, body string, fetch_error string")
    assert {r.url for r in liveness.verify(jobs, crawl).collect()} == {"u1", "http://live"}


def test_remote_variants(spark):
    one = spark.range(1)
    def run(*a, **k):
        return one.select(X.infer_remote(*[F.lit(x) for x in a], **k).alias("r")).first().r
    assert run("Remote US", "hybrid", remote_in_second=False) == "Remote"
    assert run("NY", "remote ok, hybrid", remote_in_second=False) == "Hybrid"
    assert run("NY", "remote ok") == "Remote" and run("NY") == "On-site"


def test_title_case_matches_python(spark):
    values = ["2u", "acme co", "o'neil-smith", "https://acme", "a1b2", "été à paris", "", "ABC dEF"]
    got = [r.c for r in texts(spark, values).orderBy("i").select(
        X.title_case(F.col("t")).alias("c")).collect()]
    assert got == [v.title() for v in values]


def test_entities_decode_as_the_standard_library_does(spark):
    rng = random.Random(3)
    parts = ["&", "#", "x", ";", "amp", "lt", "copy", "not", "in", "1", "65", "A", " ", "é", "&#", "\n"]
    texts = [f"a&{n}b &{n}; x" for n in sorted(html.entities.html5)[::7]]
    texts += [f"&#{n};&#x{n:X}z" for n in (*range(0, 170), 0xD800, 0xFDD0, 0xFFFE, 0x1F600, 0x10FFFF, 0x110000, 10**20)]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("d", X._decode_all("t"))
    for r in df.collect():
        assert r.d == html.unescape(r.t), r.t
