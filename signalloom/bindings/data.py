"""How the given tables stand in for postings, accounts and landed payloads.

The perk vocabulary hardly occurs in the corpus, so these bindings bring a vocabulary that
does. Each view below has an SQL twin in ``sql.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import text as X
from ..lexicon import Lexicon, Rubric

TERMS = ("free", "data", "license", "tion that", "ouble", "thing of", "reau", "ment les",
         "eaux de", "lich der", "ungen", "ción de", "mente los", "nerth", "andes")
CONTEXT = ("license", "free", "data", "tion that", "onthe", "ment les", "ring the")
LEXICON = Lexicon(TERMS, frozenset({"ouble", "reau", "nerth"}), CONTEXT, 300)
PLAIN = Lexicon(TERMS)
WEIGHTS = {"free": 7, "data": 5, "license": 10, "tion that": 6, "ouble": 3, "thing of": 8,
           "reau": 4, "ment les": 7, "eaux de": 10, "lich der": 7, "ungen": 5, "ción de": 6,
           "mente los": 10, "nerth": 5, "andes": 4}
RUBRIC = Rubric(
    keyword=WEIGHTS, source={"Board": 8, "Feed": 6, "Crawl": 2},
    vertical={"the": 2, "ción": 3, "role a": 5, "eaux": 4}, size={"src1": 4, "role 3": 3},
    persona={"role b": 5, "fr": 2, "role 7": 4}, brands=("src3", "license", "free"),
    segment={"managed": 15, "unmanaged": 8},
    boost={("expansion", "confirmed"): 15, ("expansion", "possible"): 8,
           ("existing", "confirmed"): 10, ("existing", "possible"): 5})
TODAY = "2024-02-05"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def language_place(lang: Column) -> Column:
    return (F.when(lang == "en", "Austin, TX, USA").when(lang == "fr", "Brooklyn, NYC")
            .when(lang == "de", "San Diego").otherwise("Boston, MA"))


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as raw postings: source is the company, lang the place."""
    d = table(spark, sf, "documents")
    return d.select(
        "doc_id", "text", "lang", F.col("source").alias("slug"),
        F.concat(F.lit("role "), F.substring(F.md5("text"), 1, 1), F.lit(" "),
                 F.col("lang")).alias("title"),
        language_place(F.col("lang")).alias("place"),
        F.concat(F.lit("https://boards.greenhouse.io/"), "source", F.lit("/jobs/"),
                 F.col("doc_id").cast("string")).alias("url"),
        F.date_add(F.lit("2024-01-01").cast("date"),
                   F.floor(F.col("n_chars") / 100).cast("int")).cast("string").alias("day"))


def postings(spark: SparkSession, sf: str, lexicon: Lexicon = LEXICON) -> DataFrame:
    """Matched postings with the 11 columns, from documents."""
    d = X.matched_only(X.with_hits(documents(spark, sf), "text", lexicon).withColumn(
        "snippet", X.excerpt(F.col("text"), F.get("kw", F.lit(0)))).drop("text"))
    return d.select(
        F.when(F.col("lang") == "en", "Board").when(F.col("lang") == "de", "Feed")
        .otherwise("Crawl").alias("source"),
        F.col("slug").alias("company"), "title", F.col("place").alias("location"),
        F.lit("On-site").alias("remote"), X.join_list(F.col("kw")).alias(
            "food_keywords_matched"),
        F.size("kw").alias("keyword_count"),
        F.col("snippet").alias("perk_excerpt"),
        F.col("day").alias("date_posted"), "url",
        F.when(F.col("title").startswith("role 5"),
               F.concat("slug", F.lit("-jobs.com"))).otherwise("").alias("_domain"),
        F.col("doc_id").alias("ingest_seq"))


def supplier_accounts(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as accounts named like the document sources, placed by their region."""
    s = table(spark, sf, "supplier")
    n = table(spark, sf, "nation")
    region = F.col("n_regionkey")
    poor = F.col("s_acctbal") < 1500
    key = F.col("s_suppkey").cast("string")
    return (s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.when(F.col("s_acctbal") >= 6000, "managed").otherwise("unmanaged").alias("list"),
        F.col("s_suppkey").alias("row_no"),
        F.when(poor, "Not Provided").otherwise(
            F.concat(F.lit("Src"), key, F.lit(" Holdings, Inc."))).alias("name"),
        F.when(poor, "").otherwise(F.concat(F.lit("https://www.SRC"), key,
                                            F.lit(".com/careers/"))).alias("domain"),
        key.alias("zoominfo_id"),
        F.when(region == 0, "Technology").when(region == 1, "Retail").when(
            region == 2, "Pharma").otherwise("Finance").alias("vertical"),
        F.lit("").alias("industry"),
        F.when(region == 3, "Hospitality").otherwise("Management Consulting").alias(
            "zi_industry"),
        F.when(region == 0, "Austin").when(region == 1, "brooklyn").when(
            region == 2, "San Diego").when(region == 3, "Cambridge").otherwise(
            "Atlantis").alias("city"),
        F.when(region == 0, "Texas").when(region == 3, "Massachusetts").otherwise("").alias(
            "state")))


def part_accounts(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as accounts with many-token names: size decides the list."""
    p = table(spark, sf, "part")
    blank = F.lit("")
    return p.select(
        F.when(F.col("p_size") >= 40, "managed").otherwise("unmanaged").alias("list"),
        F.col("p_partkey").alias("row_no"),
        F.concat_ws(" ", "p_name", "p_brand", "p_type", F.lit("Group")).alias("name"),
        F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("-"), F.lower("p_type"),
                 F.lit(".com")).alias("domain"),
        F.col("p_partkey").cast("string").alias("zoominfo_id"), F.col("p_type").alias(
            "vertical"), blank.alias("industry"), F.col("p_brand").alias("zi_industry"),
        F.split("p_name", " ")[1].alias("city"), F.split("p_name", " ")[0].alias("state"))


def customer_accounts(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as accounts: market segment as vertical, nation as domain."""
    c = table(spark, sf, "customer")
    segment = F.col("c_mktsegment")
    nation = F.col("c_nationkey").cast("string")
    return c.select(
        F.when(F.col("c_acctbal") >= 8000, "managed").otherwise("unmanaged").alias("list"),
        F.col("c_custkey").alias("row_no"),
        F.when(F.col("c_acctbal") < 0, F.concat(F.col("c_name"), F.lit(" Grill"))).otherwise(
            F.col("c_name")).alias("name"),
        F.when(F.col("c_acctbal") < -500, "").otherwise(F.concat(
            F.lit("WWW.n"), nation, F.lit("-"), F.lower(segment), F.lit(".com"))).alias(
            "domain"),
        F.col("c_custkey").cast("string").alias("zoominfo_id"), segment.alias("vertical"),
        F.lit("").alias("industry"), F.concat(F.lit("industry "), nation).alias("zi_industry"),
        F.when(segment == "AUTOMOBILE", "Arlington").when(segment == "BUILDING", "QUEENS")
        .when(segment == "FURNITURE", "queens").when(segment == "HOUSEHOLD", "Irvine")
        .otherwise("Atlantis").alias("city"),
        F.when(F.col("c_acctbal") > 4000, "Virginia").otherwise("Texas").alias("state"))


def weekly_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events per user and ISO week as a velocity table, from a Saturday on.

    Moved two days back the events end with a whole week, and the first week lies in 2023.
    """
    e = table(spark, sf, "events")
    week = X.iso_week(F.date_sub(F.col("ts").cast("date"), 2))
    return e.groupBy(F.col("user_id").alias("company_name"), week.alias("week")).agg(
        F.count("*").alias("signal_count"),
        F.max("event_type").alias("keyword_set"))


def landed(df: DataFrame, payload: Column, seq: str, **columns: Column) -> DataFrame:
    """A landed table with one payload per row."""
    names = ("slug", "company", "search_term", "domain", "url")
    blank = F.lit(None).cast("string")
    return df.select(*[columns.get(n, blank).alias(n) for n in names],
                     *[c.alias(n) for n, c in columns.items() if n not in names],
                     payload.alias("payload"), F.col(seq).alias("seq"))
