"""Markets of addresses and postings, and the office index of an account."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.names import normalise_domain
from ..functions.text import contains_any, sql_text
from ..lexicon import CITY_MARKETS, LOCATION_MARKETS

OTHER = "Other"


def location_market(place_lc: str, rules=LOCATION_MARKETS) -> Column:
    """First market with a signal inside the named lower-cased text, else Other."""
    cases = " ".join(f"WHEN {contains_any(place_lc, signals)} THEN {sql_text(market)}"
                     for market, signals in rules)
    return F.expr(f"CASE {cases} ELSE '{OTHER}' END")


def city_market(city: str, state: str, rules=None) -> Column:
    """First rule whose city equals and whose state, if any, is part of the given state."""
    city, state = (f"lower(trim(coalesce({c}, '')))" for c in (city, state))
    cases = []
    for rule_city, rule_state, market in (CITY_MARKETS if rules is None else rules):
        match = f"{city} = {sql_text(rule_city)}"
        if rule_state is not None:
            match += f" AND contains({state}, {sql_text(rule_state)})"
        cases.append(f"WHEN {match} THEN {sql_text(market)}")
    return F.expr(f"CASE {' '.join(cases)} ELSE '{OTHER}' END")


def with_office(accounts: DataFrame, rules=None) -> DataFrame:
    """Account rows that place an office: a domain and a billing city."""
    city = F.trim(F.coalesce("city", F.lit("")))
    state = F.trim(F.coalesce("state", F.lit("")))
    return (accounts.select(normalise_domain(F.col("domain")).alias("domain"),
                            city.alias("city"), state.alias("state"), "row_no")
            .where((F.col("domain") != "") & (F.col("city") != ""))
            .withColumn("market", city_market("city", "state", rules)))


def office_counts(offices: DataFrame) -> DataFrame:
    """Offices per domain and market, with the first row for tie-breaking."""
    return offices.groupBy("domain", "market").agg(
        F.count("*").alias("n"), F.min("row_no").alias("first_row"))


def office_markets(counts: DataFrame) -> DataFrame:
    """Known markets (sorted, without Other) and primary market of each domain."""
    known = F.when(F.col("market") != OTHER, F.col("market"))
    order = F.when(F.col("market") != OTHER, F.struct(-F.col("n"), F.col("first_row")))
    return counts.groupBy("domain").agg(
        F.array_sort(F.collect_set(known)).alias("known_markets"),
        F.coalesce(F.min_by(known, order), F.lit(OTHER)).alias("primary_market"))


def office_cities(offices: DataFrame) -> DataFrame:
    """Distinct office cities of each domain in row order, first spelling kept."""
    cities = offices.groupBy("domain", F.lower("city").alias("_c"),
                             F.lower("state").alias("_s")).agg(
        F.min("row_no").alias("row"),
        F.min_by(F.struct("city", "state", "market"), "row_no").alias("office"))
    ordered = F.array_sort(F.collect_list(F.struct("row", "office")))
    return cities.groupBy("domain").agg(
        F.transform(ordered, lambda x: x["office"]).alias("office_cities"))


def office_index(accounts: DataFrame, rules=None) -> DataFrame:
    """One row per domain: known_markets, primary_market, office_cities."""
    offices = with_office(accounts, rules)
    return office_markets(office_counts(offices)).join(office_cities(offices), "domain")


def flag_expansion(signals: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """loc_type of each (key, market): existing if known, else expansion.

    ``known`` holds distinct (key, market) pairs; Other always counts as expansion.
    """
    marked = known.where(F.col("market") != OTHER).select(key, "market").distinct()
    marked = marked.withColumn("_known", F.lit(True))
    return (signals.join(marked, [key, "market"], "left")
            .withColumn("loc_type", F.when(F.col("_known"), "existing").otherwise("expansion"))
            .drop("_known"))


def expansion_only(signals: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Signals outside the known markets (anti form of flag_expansion)."""
    return signals.join(known.where(F.col("market") != OTHER), [key, "market"], "left_anti")


def existing_only(signals: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return signals.join(known.where(F.col("market") != OTHER), [key, "market"], "left_semi")


def fallback_market(primary: Column, inferred: Column) -> Column:
    primary = F.coalesce(primary, F.lit(OTHER))
    return F.when(primary.isin(OTHER, ""), inferred).otherwise(primary)
