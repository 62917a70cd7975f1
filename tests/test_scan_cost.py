"""Cleaning and matching of texts in few passes: the answers of the patterns they replace."""

import html
import random
import re

from signalloom.functions import text as X
from signalloom.lexicon import Lexicon
from test_text import texts

#: U+1D49C is two code units, "anna" can overlap itself, and three context words overlap "grub".
LEXICON = Lexicon(("grub", "anna", "plain"), frozenset({"grub", "anna"}), ("meal", "rubber", "bin", "agrubx", "kit"), 12)


def test_context_is_told_as_brute_force_tells_it(spark):
    rng = random.Random(11)
    parts = ["grub", "anna", "annanna", "meal", "rubber", "ubber", "bin", "in", "agrubx", "kit", "\U0001d49c" * 4, "é" * 7,
             "zzzz", "z", "zzzzzzz", "plain", "Grub"]
    values = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 9))) for _ in range(2500)]

    def brute(text):
        low, out = text.lower(), []
        for term in LEXICON.terms:
            spots = [m.start() for m in re.finditer(f"(?={term})", low)]
            if term in LEXICON.needs_context:
                spots = [p for p in spots if any(
                    w in low[max(0, p - LEXICON.window):p + len(term) + LEXICON.window] for w in LEXICON.context)]
            out += [term] * bool(spots)
        return out
    rows = X.with_hits(texts(spark, values), "t", LEXICON).collect()
    assert [r.kw for r in rows] == [brute(r.t) for r in rows]


def test_context_of_a_common_term_takes_no_pattern_over_the_text():
    near = X.term_condition("t", "grub", LEXICON)
    assert "RLIKE" not in near and "split" in near
    assert "RLIKE" in X.term_condition("t", "anna", LEXICON)


def test_tags_entities_and_white_space_as_the_patterns_have_them(spark):
    rng = random.Random(12)
    parts = ["<", ">", "<>", "<b>", "</p>", "a", " ", "  ", "\n", "\t", "\xa0", " ", "&", "&amp;", "&amp", "&lt;", "&#",
             "&1", "& ", "&x", "amp;", "é", "\U0001d49c"]
    values = ["", None, *("".join(rng.choice(parts) for _ in range(rng.randint(1, 12))) for _ in range(3000))]
    rows = X.with_clean_text(texts(spark, values), "t", "c").collect()
    assert len(rows) == len(values)
    for r in rows:
        bare = re.sub(r"<[^>]+>", " ", r.t or "")
        assert r.c == re.sub(r"\s+", " ", html.unescape(bare)).strip(), r.t
