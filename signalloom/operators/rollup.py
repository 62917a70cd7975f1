"""From postings to one row per company.

The postings are read twice, each time narrow and combined before its shuffle: once for the
(company, market) statistics with the best posting, once for the sets of titles, keywords
and sources. Everything after that works on company rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import scoring as S
from ..functions.names import guess_domain, normalise_domain
from ..functions.text import nonblank, split_list
from ..lexicon import LOCATION_MARKETS, PERK_RUBRIC, Rubric
from ..schemas import COMPANY_COLUMNS
from ..session import stored
from . import accounts as A
from .markets import OTHER, fallback_market, location_market


def with_scores(jobs: DataFrame, rubric: Rubric = PERK_RUBRIC,
                markets=LOCATION_MARKETS) -> DataFrame:
    """Postings with a company: company_norm, market, kw_score and gtm_score added."""
    def lower(*names: str) -> Column:
        return F.lower(F.concat_ws(" ", *[F.coalesce(n, F.lit("")) for n in names]))
    texts = jobs.withColumns({
        "company_norm": F.lower(F.trim(F.coalesce("company", F.lit("")))),
        "_kws": lower("food_keywords_matched"), "_title": lower("title"),
        "_text": lower("company", "title", "perk_excerpt"), "_place": lower("location"),
    }).where("company_norm <> ''")
    return texts.withColumns({
        "market": location_market("_place", markets),
        "kw_score": S.weighted_hits("_kws", rubric.keyword).cast("long"),
        "gtm_score": S.posting_score("_kws", "_text", "_title", "keyword_count", "source",
                                     rubric)}).drop("_kws", "_title", "_text", "_place")


def quality_counts(rubric: Rubric = PERK_RUBRIC) -> list[Column]:
    good = F.col("kw_score") >= rubric.quality_gate
    return [F.count_if(good).alias("jd_count"),
            F.max(F.when(good, F.col("kw_score"))).alias("max_kw_score")]


def market_signals(scored: DataFrame, keys: tuple[str, ...] = ("company_norm", "market"),
                   rubric: Rubric = PERK_RUBRIC) -> DataFrame:
    """Postings that pass the quality gate per company and market, with strength."""
    return (scored.groupBy(*keys).agg(*quality_counts(rubric)).where("jd_count > 0")
            .withColumn("signal_strength", S.signal_strength(F.col("jd_count"), rubric)))


def company_boosts(flagged: DataFrame, key: str = "company_norm",
                   rubric: Rubric = PERK_RUBRIC) -> DataFrame:
    """Boost sum, postings and the four market lists from flagged (key, market) signals."""
    def markets(kind: str, level: str) -> Column:
        mine = (F.col("loc_type") == kind) & (F.col("signal_strength") == level)
        listed = F.array_sort(F.collect_list(F.when(mine, F.col("market"))))
        return F.array_join(listed, ", ").alias(f"{kind}_{level}")

    boost = S.location_boost(F.col("loc_type"), F.col("signal_strength"), rubric)
    rolled = flagged.groupBy(key).agg(
        F.sum(boost).alias("boost"), F.sum("jd_count").alias("location_jd_count"),
        *[markets(k, level) for k, level in rubric.boost])
    return rolled.withColumn("loc_signal_strength", S.overall_signal(
        *[F.col(f"{k}_{level}") for k, level in rubric.boost]))


def location_detail(flagged: DataFrame, key: str = "company_norm") -> DataFrame:
    """Signals of a company as an array of structs, most postings first."""
    fields = ("market", "jd_count", "signal_strength", "loc_type", "max_kw_score")
    ordered = F.array_sort(F.collect_list(F.struct(-F.col("jd_count"), *fields)))
    return flagged.groupBy(key).agg(
        F.transform(ordered, lambda x: F.struct(*[x[f].alias(f) for f in fields]))
        .alias("location_detail"))


def best_posting(scored: DataFrame, key: str, score: str, order: str,
                 fields: tuple[str, ...]) -> DataFrame:
    """The highest-scoring row per key, first by ``order`` on ties."""
    best = F.min_by(F.struct(*fields), F.struct(-F.col(score), F.col(order)))
    return scored.groupBy(key).agg(best.alias("_b")).select(key, "_b.*")


def company_sets(scored: DataFrame, rubric: Rubric = PERK_RUBRIC) -> DataFrame:
    """Distinct titles (counted), keywords and sources (sorted, joined), best source.

    Titles are counted after a distinct over (company, kind, value), so a company's titles
    never meet in one task; keyword and source sets are bounded by their vocabularies.
    """
    # Places in the array tell the kinds apart: title, source, then keywords.
    values = F.concat(F.array(nonblank(F.lower(F.trim("title"))),
                              F.coalesce("source", F.lit(""))),
                      split_list(F.col("food_keywords_matched")))
    kind = F.when(F.col("pos") == 0, "title").when(F.col("pos") == 1, "source").otherwise("kw")
    distinct = (scored.select("company_norm", F.posexplode(values).alias("pos", "value"))
                .select("company_norm", kind.alias("kind"), "value")
                .where("value is not null").distinct())
    ranks = F.lit(len(rubric.source))
    for rank, name in reversed(list(enumerate(rubric.source))):
        ranks = F.when(F.col("value") == name, F.lit(rank)).otherwise(ranks)

    def joined(kind: str) -> Column:
        found = F.collect_list(F.when(F.col("kind") == kind, F.col("value")))
        return F.array_join(F.array_sort(found), ", ")
    is_source = F.col("kind") == "source"
    return distinct.groupBy("company_norm").agg(
        F.count_if(F.col("kind") == "title").alias("unique_roles_with_perk"),
        joined("kw").alias("top_keywords"), joined("source").alias("all_sources"),
        F.min_by("value", F.when(is_source, F.struct(ranks, F.col("value"))))
        .alias("best_source"))


_BEST = ("company", "title", "location", "remote", "url", "perk_excerpt", "date_posted",
         "gtm_score", "ingest_seq")


def _company_base(scored: DataFrame, rubric: Rubric) -> DataFrame:
    """Best posting, first verified domain and market statistics of each company."""
    verified = nonblank("_domain")
    per_market = scored.groupBy("company_norm", "market").agg(
        *quality_counts(rubric),
        F.min_by(F.struct(*_BEST), F.struct(-F.col("gtm_score"), F.col("ingest_seq")))
        .alias("best"),
        F.min_by(verified, F.when(verified.isNotNull(), F.col("ingest_seq"))).alias("dom"),
        F.min(F.when(verified.isNotNull(), F.col("ingest_seq"))).alias("dom_seq"))
    stats = F.when(F.col("jd_count") > 0, F.struct("market", "jd_count", "max_kw_score"))
    best_order = F.struct(-F.col("best.gtm_score"), F.col("best.ingest_seq"))
    return per_market.groupBy("company_norm").agg(
        F.min_by("best", best_order).alias("best"),
        F.min_by("dom", F.when(F.col("dom").isNotNull(), F.col("dom_seq"))).alias("verified"),
        F.array_sort(F.collect_list(stats)).alias("stats"))


def _with_locations(df: DataFrame, rubric: Rubric) -> DataFrame:
    """Location columns from ``stats`` and ``known_markets``, both small arrays per row."""
    def flag(s: Column) -> Column:
        known = (s["market"] != OTHER) & F.array_contains(F.col("known_markets"), s["market"])
        return F.struct(
            s["market"].alias("market"), s["jd_count"].alias("jd_count"),
            S.signal_strength(s["jd_count"], rubric).alias("signal_strength"),
            F.when(known, "existing").otherwise("expansion").alias("loc_type"),
            s["max_kw_score"].alias("max_kw_score"))

    def markets(kind: str, level: str) -> Column:
        mine = F.filter("detail", lambda s: (s["loc_type"] == kind)
                        & (s["signal_strength"] == level))
        return F.array_join(F.transform(mine, lambda s: s["market"]), ", ")

    df = df.withColumn("detail", F.transform("stats", flag))
    points = F.aggregate("detail", F.lit(0), lambda acc, s: acc + S.location_boost(
        s["loc_type"], s["signal_strength"], rubric))
    postings = F.aggregate("detail", F.lit(0).cast("long"), lambda acc, s: acc + s["jd_count"])
    ordered = F.array_sort("detail", lambda a, b: F.when(a["jd_count"] > b["jd_count"], -1)
                           .when(a["jd_count"] < b["jd_count"], 1)
                           .when(a["market"] < b["market"], -1)
                           .when(a["market"] > b["market"], 1).otherwise(0))
    return df.withColumns({
        **{f"{kind}_{level}": markets(kind, level) for kind, level in rubric.boost},
        "boost": points, "location_jd_count": postings,
        "location_detail": F.to_json(ordered)})


def rollup(jobs: DataFrame, accounts: DataFrame | A.AccountIndex, rubric: Rubric = PERK_RUBRIC,
           markets=LOCATION_MARKETS, city_rules=None) -> DataFrame:
    """One row per company with the 30 company columns.

    ``jobs`` should be a stored table (it is scanned twice); order by score when presenting. An index of
    the accounts spares building one.
    """
    return rollup_parts(jobs, accounts, rubric, markets, city_rules)[0]


def rollup_parts(jobs: DataFrame, accounts: DataFrame | A.AccountIndex, rubric: Rubric = PERK_RUBRIC,
                 markets=LOCATION_MARKETS, city_rules=None) -> tuple[DataFrame, DataFrame]:
    """The rollup and, from the same pass over the postings, the signals by company_name and market."""
    index = accounts if isinstance(accounts, A.AccountIndex) else A.build_index(accounts, city_rules)
    scored = with_scores(jobs, rubric, markets)
    companies = (_company_base(scored, rubric)
                 .join(company_sets(scored, rubric), "company_norm")
                 .withColumn("company", F.trim("best.company")))
    companies = stored(companies, "companies")  # matching reads it twice
    signals = companies.select(F.col("company_norm").alias("company_name"), F.inline("stats")).withColumn(
        "signal_strength", S.signal_strength(F.col("jd_count"), rubric))

    companies = A.match_names(companies, index, "company")
    companies = A.with_account(companies, index, A.pick_row("by_name", "by_tokens"), "listed")
    listed = nonblank(F.lower(F.trim("listed.account.domain")))
    companies = companies.withColumn("inferred_domain", F.coalesce(
        "verified", listed, guess_domain(F.col("company"))))
    companies = A.match_domains(companies, index, "inferred_domain")
    companies = A.with_account(companies, index, A.pick_row("by_domain", "by_name", "by_tokens"))

    companies = (companies.withColumn("nd", normalise_domain(F.col("inferred_domain")))
                 .join(index.offices, "nd", "left")
                 .withColumn("known_markets", F.coalesce("known_markets", F.array())))
    companies = _with_locations(companies, rubric)

    self_ref = S.self_referential(F.col("company_norm"), F.col("top_keywords"), rubric)
    companies = companies.withColumns({
        "gtm_score": S.company_score(F.col("best.gtm_score"), self_ref, F.col("pick.segment"),
                                     F.col("boost"), rubric),
        "loc_signal_strength": S.overall_signal(
            *[F.col(f"{k}_{level}") for k, level in rubric.boost])})
    companies = companies.withColumn("_place", F.lower(F.coalesce("best.location", F.lit(""))))
    inferred = location_market("_place", markets)
    blank = F.lit("")
    shown = {
        "confidence": S.confidence(F.col("gtm_score")),
        "icp_tier": S.icp_tier(F.col("gtm_score")), "segment": F.col("pick.segment"),
        "market": fallback_market(F.col("primary_market"), inferred),
        "known_markets": F.array_join("known_markets", ", "),
        "office_cities": F.coalesce(F.to_json("office_cities"), F.lit("[]")),
        "ezcater_vertical": F.coalesce("pick.account.vertical", blank),
        "zi_industry": F.coalesce("pick.account.zi_industry", blank),
        "role_count": F.col("unique_roles_with_perk"),
        "location": F.coalesce("best.location", blank),
        "remote": F.coalesce("best.remote", blank),
        "sample_title": F.coalesce("best.title", blank),
        "sample_url": F.coalesce("best.url", blank),
        "perk_excerpt": F.substring(F.coalesce("best.perk_excerpt", blank), 1, 200),
        "date_first_seen": F.coalesce("best.date_posted", blank), "is_new": F.lit(1)}
    return companies.select(*[shown[c].alias(c) if c in shown else F.col(c)
                              for c in COMPANY_COLUMNS]), signals


def by_score(companies: DataFrame) -> DataFrame:
    """Highest score first, then by name."""
    return companies.orderBy(F.desc("gtm_score"), "company")


def top_companies(companies: DataFrame, n: int = 5) -> DataFrame:
    return by_score(companies.select("company", "gtm_score", "top_keywords")).limit(n)
