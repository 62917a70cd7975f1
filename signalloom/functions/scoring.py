"""Score expressions: additive substring rubrics, tiers and signal strength."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..lexicon import PERK_RUBRIC, Rubric
from .text import any_of, sql_text


def weighted_hits(text_lc: str, weights: dict[str, int]) -> Column:
    """Sum of the weights of all terms in the named column (overlapping terms add up)."""
    terms = [f"CASE WHEN contains({text_lc}, {sql_text(t)}) THEN {w} ELSE 0 END"
             for t, w in weights.items()]
    return F.expr(" + ".join(terms) or "0")


def source_score(source: str, rubric: Rubric = PERK_RUBRIC) -> Column:
    cases = " ".join(f"WHEN {sql_text(n)} THEN {w}" for n, w in rubric.source.items())
    return F.expr(f"CASE {source} {cases} ELSE 0 END" if cases else "0")


def posting_score(keywords_lc: str, text_lc: str, title_lc: str, keyword_count: str,
                  source: str, rubric: Rubric = PERK_RUBRIC) -> Column:
    """Keyword + count + source + vertical + size + persona points of one posting.

    Takes column names; ``text_lc`` is company, title and excerpt together.
    """
    return (weighted_hits(keywords_lc, rubric.keyword)
            + F.coalesce(keyword_count, F.lit(1)) * rubric.per_keyword
            + source_score(source, rubric)
            + weighted_hits(text_lc, rubric.vertical) + weighted_hits(text_lc, rubric.size)
            + weighted_hits(title_lc, rubric.persona)).cast("long")


def confidence(score: Column) -> Column:
    """High 25-998, Medium 12-24, else Low (so 999 and above read Low)."""
    return (F.when(score.between(25, 998), "High").when(score.between(12, 24), "Medium")
            .otherwise("Low"))


def icp_tier(score: Column) -> Column:
    return (F.when(score >= 30, "Very Viable").when(score >= 18, "Viable")
            .otherwise("Monitor"))


def score_bucket(score: Column) -> Column:
    return F.when(score >= 20, "high").when(score >= 12, "med").otherwise("low")


def signal_strength(postings: Column, rubric: Rubric = PERK_RUBRIC) -> Column:
    return (F.when(postings >= rubric.confirmed_at, "confirmed")
            .when(postings >= rubric.possible_at, "possible").otherwise("noise"))


def location_boost(loc_type: Column, strength: Column, rubric: Rubric = PERK_RUBRIC) -> Column:
    chain = F.when(F.lit(False), F.lit(0))
    for (kind, level), points in rubric.boost.items():
        chain = chain.when((loc_type == kind) & (strength == level), F.lit(points))
    return chain.otherwise(F.lit(0))


def overall_signal(expansion_confirmed: Column, expansion_possible: Column,
                   existing_confirmed: Column, existing_possible: Column) -> Column:
    """Name of the first non-empty market list, in order of value."""
    return (F.when(expansion_confirmed != "", "expansion_confirmed")
            .when(expansion_possible != "", "expansion_possible")
            .when(existing_confirmed != "", "existing_confirmed")
            .when(existing_possible != "", "existing_possible").otherwise("noise"))


def self_referential(company_lc: Column, keywords: Column,
                     rubric: Rubric = PERK_RUBRIC) -> Column:
    """A food brand occurs in the company name and in one of its own keywords.

    ``keywords`` is the joined list; brands hold no separator, so a hit lies in one entry.
    """
    keywords = F.lower(keywords)
    return any_of([F.contains(company_lc, F.lit(b)) & F.contains(keywords, F.lit(b))
                   for b in rubric.brands])


def company_score(best: Column, self_ref: Column, segment: Column, boosts: Column,
                  rubric: Rubric = PERK_RUBRIC) -> Column:
    base = F.when(self_ref, F.greatest(best - rubric.brand_penalty, F.lit(0))).otherwise(best)
    seg = F.when(F.lit(False), F.lit(0))
    for name, points in rubric.segment.items():
        seg = seg.when(segment == name, F.lit(points))
    return (base + seg.otherwise(F.lit(0)) + boosts).cast("long")


def has_primary_keyword(keywords: Column, primary: tuple[str, ...]) -> Column:
    return any_of([F.contains(F.lower(keywords), F.lit(p)) for p in primary])
