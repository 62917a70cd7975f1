"""The sources by key, and their union."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation

from ..lexicon import PERK_LEXICON, Lexicon
from . import boards, feeds, pages, rejects


class Source(NamedTuple):
    label: str
    read: Callable[..., DataFrame]
    inputs: tuple[str, ...] = ("landed",)


# Inputs are passed by position in this order; the postings' order follows the listing.
SOURCES: dict[str, Source] = {
    "gh": Source("Greenhouse", boards.greenhouse),
    "lv": Source("Lever", boards.lever),
    "ab": Source("Ashby", boards.ashby),
    "bn": Source("Built In", pages.search_pages),
    "wd": Source("Workday", boards.workday, ("lists", "details")),
    "gd": Source("Glassdoor Benefits", pages.benefit_jobs, ("employers", "landed")),
    "js": Source("JobSpy", feeds.job_board, ("frame",)),
    "ap": Source("LinkedIn", feeds.network_items),
    "wf": Source("Wellfound", pages.startup_search),
    "ex": Source("Exa", feeds.web_search),
    "fc": Source("Firecrawl", feeds.crawl_search),
    "ts": Source("TheirStack", feeds.job_feed),
    "sb": Source("Sumble", feeds.organisation_feed),
    "da": Source("Account boards", boards.account_boards, ("landed", "resolved")),
}


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_sources(inputs: dict[str, dict[str, DataFrame]], selected: list[str] | None = None,
                 options: dict[str, dict] | None = None,
                 lexicon: Lexicon = PERK_LEXICON,
                 seen: dict[tuple[str, str], Observation] | None = None,
                 failed: dict[str, str] | None = None) -> DataFrame:
    """Postings of the selected sources that have landed inputs.

    ``inputs[key]`` names the tables a source reads; ``options[key]`` holds its keyword
    arguments. The benefit source takes no lexicon.

    ``seen`` gets an observation by (key, input) of each table of payloads: how many there were and how
    many could not be used, by reason. They are known once the postings were written. ``failed``
    gets the error of a source whose tables lack what it reads; it is left out then. Without it the
    error is raised.
    """
    parts = []
    for key, source in SOURCES.items():
        if key not in inputs or selected is not None and key not in selected:
            continue
        extra = dict((options or {}).get(key, {}))
        if key != "gd":
            extra.setdefault("lexicon", lexicon)
        own = {}
        try:
            tables = {name: inputs[key][name] for name in source.inputs}
            for name, shapes in rejects.SHAPES.get(key, {}).items() if seen is not None else ():
                own[key, name] = Observation(f"payloads of {key} {name}")
                tables[name] = rejects.watched(tables[name], shapes, own[key, name])
            parts.append(source.read(*tables.values(), **extra))
        except (AnalysisException, KeyError) as error:
            if failed is None:
                raise
            failed[key] = str(error)
            continue
        if seen is not None:
            seen.update(own)
    if not parts:
        raise ValueError("none of the selected sources has landed inputs" if not failed else
                         f"all selected sources failed: {failed}")
    return union_all(parts)
