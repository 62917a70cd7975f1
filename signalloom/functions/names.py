"""Company names, domains and applicant-tracking slugs."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from ..lexicon import (ATS_PATTERNS, CORPORATE_WORDS, EMPLOYER_URL_PATTERNS, PLATFORM_SLUGS)
from .text import collapse, prettify_slug


def normalise_name(col: Column, drop: tuple[str, ...] = CORPORATE_WORDS) -> Column:
    """Lower case, corporate words and punctuation blanked, spaces collapsed."""
    name = F.trim(F.lower(F.coalesce(col, F.lit(""))))
    name = F.regexp_replace(name, r"(?U)\b(" + "|".join(drop) + r")\b", " ")
    return collapse(F.regexp_replace(name, "[^a-z0-9 ]", " "))


def normalise_domain(col: Column) -> Column:
    """Lower case without scheme, www and path."""
    domain = F.trim(F.lower(F.coalesce(col, F.lit(""))))
    domain = F.regexp_replace(domain, "/+$", "")
    domain = F.regexp_replace(domain, "^https?://", "")
    domain = F.regexp_replace(domain, r"^www\.", "")
    return F.split_part(domain, F.lit("/"), F.lit(1))


def name_tokens(normalised: Column) -> Column:
    """Sorted distinct tokens of a normalised name."""
    return F.array_sort(F.array_distinct(
        F.filter(F.split(normalised, " "), lambda t: t != "")))


def guess_domain(company: Column) -> Column:
    """The name as a .com domain, for companies on no account list."""
    slug = F.lower(F.regexp_replace(F.coalesce(company, F.lit("")), "[^a-zA-Z0-9]", ""))
    return F.when(slug == "", "unknown.com").otherwise(F.concat(slug, F.lit(".com")))


def slug_variants(domain: Column) -> Column:
    base = F.regexp_replace(F.lower(domain), r"\.(com|org|edu|net|io|co).*$", "")
    return F.array(F.regexp_replace(base, r"^www\.", ""))


def _literal(pattern: str) -> str:
    """The longest run of plain characters that every match of a pattern holds, in lower case."""
    plain = re.split(r"\((?:[^()]|\([^()]*\))*\)\??|\[[^\]]*\][+*?]?|\\d[+*]?", pattern)
    return max((p.replace("\\", "") for p in plain), key=len).lower()


def ats_fingerprint(text: Column, patterns=ATS_PATTERNS) -> Column:
    """struct(ats_type, ats_slug) of the first pattern found, or null.

    The text is lower-cased once, and a pattern is tried only where the text holds its host.
    """
    def first(low: Column) -> Column:
        found = []
        for kind, pattern in patterns:
            slug = (F.regexp_extract(text, "(?i)" + pattern, 1) if "/(" in pattern
                    or pattern.startswith("(") and not pattern.startswith("(?:")
                    else F.lit(""))
            found.append(F.when(F.contains(low, F.lit(_literal(pattern))) & text.rlike("(?i)" + pattern),
                                F.struct(F.lit(kind).alias("ats_type"), slug.alias("ats_slug"))))
        return F.coalesce(*found)
    return F.get(F.transform(F.array(F.lower(text)), first), F.lit(0))


def employer_from_url(url: Column, reject: tuple[str, ...] = PLATFORM_SLUGS,
                      patterns=EMPLOYER_URL_PATTERNS) -> Column:
    """Employer name from a posting URL; blank where no pattern yields a usable slug."""
    slugs = []
    for pattern in patterns:
        slug = F.trim(F.lower(F.regexp_extract(url, pattern, 1)))
        slugs.append(F.when((F.length(slug) > 1) & ~slug.isin(*reject), slug))
    return prettify_slug(F.coalesce(*slugs, F.lit("")))
