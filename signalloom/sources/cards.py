"""Job cards of search pages that embed no state: a small HTML helper inside an Arrow table function."""

from __future__ import annotations

import sys
from html.parser import HTMLParser

from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_VOID = {"br", "img", "input", "hr", "meta", "link", "source", "wbr"}
_FIELDS = ("url", "title", "company", "location")
_CARDS = "card_pos int, " + ", ".join(f"card_{f} string" for f in _FIELDS)


def _is_card(tag: str, attrs: dict[str, str]) -> bool:
    names = attrs.get("class", "")
    return (attrs.get("data-id") == "job-card" or attrs.get("data-test") == "JobListing"
            or "job-card" in names.split() or "job-listing" in names.split()
            or "JobCard" in names or "jobListing" in names
            or tag == "article" and "job" in names)


def _roles(tag: str, attrs: dict[str, str]) -> list[str]:
    names = attrs.get("class", "")
    found = []
    if tag in ("h2", "h3") or "title" in names:
        found.append("title")
    if any(word in names for word in ("company", "employer", "startup")):
        found.append("company")
    if "location" in names or attrs.get("data-testid") == "location":
        found.append("location")
    return found


class _CardReader(HTMLParser):
    """Collects the first title, company, location and job link inside each card."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.cards: list[dict[str, str]] = []
        self._depth = 0
        self._open: list[tuple[int, dict]] = []
        self._reading: list[tuple[int, dict, str]] = []

    def handle_starttag(self, tag, attrs):
        attrs = {k: v or "" for k, v in attrs}
        if self._open:
            card = self._open[-1][1]
            if tag == "a" and "/jobs/" in attrs.get("href", ""):
                card.setdefault("url", attrs["href"])
            for role in _roles(tag, attrs):
                if role not in card:
                    card[role] = ""
                    self._reading.append((self._depth, card, role))
        if _is_card(tag, attrs):
            card = {}
            self.cards.append(card)
            self._open.append((self._depth, card))
        if tag not in _VOID:
            self._depth += 1

    def handle_endtag(self, tag):
        if tag in _VOID:
            return
        self._depth -= 1
        self._open = [o for o in self._open if o[0] < self._depth]
        self._reading = [r for r in self._reading if r[0] < self._depth]

    def handle_data(self, data):
        for _, card, role in self._reading:
            card[role] += data.strip()


def _cards(page: str | None) -> list[dict[str, str]]:
    if not page:
        return []
    reader = _CardReader()
    reader.feed(page)
    reader.close()
    return [{k: c.get(k, "") for k in _FIELDS}
            for c in reader.cards]


class _JobCards:
    def eval(self, page: str | None):
        found = _cards(page)
        for pos, card in enumerate(found):
            yield (pos, *card.values())
        if not found:  # keeps the row; an outer lateral join with a table function would drop it
            yield (None,) * (1 + len(_FIELDS))


def with_job_cards(pages: DataFrame, page: str) -> DataFrame:
    """Joins every row with the job cards in its named page: card_pos, card_url, card_title, card_company and
    card_location. Rows whose page is null or holds no card stay once, with nulls.

    A table function beside the rows, so that a page's cards never are one value.
    """
    cards = F.udtf(_JobCards, returnType=_CARDS, useArrow=True)
    return pages.lateralJoin(cards(F.col(page).outer()))
