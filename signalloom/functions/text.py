"""Text expressions: cleaning, lexicon matching, excerpts, dates, page state.

All are column expressions that stay in the JVM.
"""

from __future__ import annotations

import html
import html.entities
import re
from functools import cache, reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..lexicon import Lexicon

# Unicode white space as one Java character class (plain \s is ASCII only). The inner
# intersection lets other characters fail on one range test.
_WIDE = r"\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SPACE = r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x20\x85\xa0[\x{1680}-\x{3000}&&[" + _WIDE + "]]]"
_NO_BLANK = SPACE.replace(r"\x20", "")

# Entities decoded without leaving the JVM. '&amp;' is handled last and in one pass, so
# that doubly escaped text is decoded once.
COMMON_ENTITIES = ("lt", "gt", "quot", "apos", "nbsp", "#39", "#x27", "copy", "reg", "middot",
                   "bull", "hellip", "ndash", "mdash", "lsquo", "rsquo", "ldquo", "rdquo")
_AMP = "&(?:amp|#38|#x26);"
_NOT_AMP = "&(?!amp;)(?:#|[A-Za-z])"
_UNCOMMON = "&(?!(?:amp|#38|#x26|" + "|".join(COMMON_ENTITIES) + ");)(?:#|[A-Za-z])"


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions) if conditions else F.lit(False)


def sql_text(text: str) -> str:
    """A string literal for F.expr.

    Long generated conditions are built as one SQL text over named columns: as Column
    objects each of their hundreds of parts would be a call to the JVM.
    """
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def contains_any(name: str, terms) -> str:
    """SQL text: the named column contains any of the terms."""
    return "(" + " OR ".join(f"contains({name}, {sql_text(t)})" for t in terms) + ")"


def nonblank(col: Column | str) -> Column:
    """The value, or null where it is null or only white space."""
    col = F.col(col) if isinstance(col, str) else col
    return F.when(F.trim(col) != "", col)


def first_nonblank(*cols: Column | str, default: str = "") -> Column:
    return F.coalesce(*[nonblank(c) for c in cols], F.lit(default))


def strip(col: Column) -> Column:
    return F.regexp_replace(col, f"^{SPACE}+|{SPACE}+$", "")


def collapse(col: Column) -> Column:
    return F.trim(F.regexp_replace(col, f"{SPACE}+", " "))


# What may be an entity, as the HTML standard reads it.
_ENTITY = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


def _texts(values) -> str:
    """SQL text of an array of strings, written as code units."""
    def literal(value: str) -> str:
        return "'" + "".join(f"\\u{u:04x}" for u in memoryview(
            value.encode("utf-16-le")).cast("H")) + "'"
    return "array(" + ", ".join(literal(v) for v in values) + ")"


@cache
def _entity_sql() -> str:
    """SQL text of one entity ``m`` decoded: by number, by whole name, or by the longest name that
    needs no semicolon and begins it; else it stays. The tables come from the standard library."""
    names = html.entities.html5
    open_names = sorted((n for n in names if not n.endswith(";")), key=len, reverse=True)
    known = f"map_from_arrays({_texts(names)}, {_texts(names.values())})"
    begun = f"map_from_arrays({_texts(open_names)}, {_texts(names[n] for n in open_names)})"
    low = _texts(html.unescape(f"&#{n};") for n in range(160))
    digits = r"regexp_extract(m, r'^&#0*([0-9]*)', 1)"
    hexes = r"regexp_extract(m, r'^&#[xX]0*([0-9a-fA-F]*)', 1)"
    # more digits than the largest code point has count as beyond it
    number = (f"CASE WHEN m RLIKE r'^&#[xX]' THEN CASE WHEN length({hexes}) > 6 THEN 1114112 ELSE "
              f"CAST(conv(concat('0', {hexes}), 16, 10) AS INT) END WHEN length({digits}) > 7 THEN 1114112 "
              f"ELSE CAST(concat('0', {digits}) AS INT) END")
    char = "decode(unhex(lpad(hex(n), 8, '0')), 'UTF-32')"
    numeric = (f"CASE WHEN n < 160 THEN element_at({low}, n + 1) "
               "WHEN n BETWEEN 55296 AND 57343 OR n > 1114111 THEN '\\ufffd' "
               f"WHEN n BETWEEN 64976 AND 65007 OR n % 65536 >= 65534 THEN '' ELSE {char} END")
    prefix = f"regexp_extract(m, r'^&({'|'.join(open_names)})', 1)"
    named = (f"coalesce(try_element_at({known}, substr(m, 2)), CASE WHEN {prefix} != '' THEN "
             f"concat(element_at({begun}, {prefix}), substr(m, length({prefix}) + 2)) ELSE m END)")
    return (f"CASE WHEN m RLIKE '^&#' THEN element_at(transform(array({number}), n -> {numeric}), 1) "
            f"ELSE {named} END")


def _decode_all(text: str) -> Column:
    """All entities of the named column decoded, each once, in one pass over the text."""
    entity = f"r'{_ENTITY}'"
    decoded = f"transform(regexp_extract_all({text}, {entity}, 0), m -> {_entity_sql()})"
    return F.expr(f"array_join(zip_with(split({text}, {entity}, -1), array_append({decoded}, ''), "
                  "(a, b) -> concat(a, b)), '')")


def strip_tags(col: Column) -> Column:
    return F.when(F.contains(col, F.lit("<")),
                  F.regexp_replace(col, "<[^>]+>", " ")).otherwise(col)


def _decode_common(col: Column, only_amp: Column) -> Column:
    common = col
    for name in COMMON_ENTITIES:
        common = F.replace(common, F.lit(f"&{name};"), F.lit(html.unescape(f"&{name};")))
    return (F.when(~F.contains(col, F.lit("&")), col)
            .when(only_amp, F.replace(col, F.lit("&amp;"), F.lit("&")))
            .otherwise(F.regexp_replace(common, _AMP, "&")))


def _with_collapsed(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``, the named column as :func:`collapse` gives it, replacing only what is no single blank."""
    s = F.col("_s")
    df = df.withColumn("_s", F.regexp_replace(text, f"{_NO_BLANK}{SPACE}*", " "))
    return df.withColumn(out, F.trim(F.when(F.contains(s, F.lit("  ")), F.regexp_replace(s, "  +", " "))
                                     .otherwise(s))).drop("_s")


def with_clean_text(df: DataFrame, text: str, out: str, full_entities: bool = True) -> DataFrame:
    """Add ``out``: tags dropped, then entities decoded, then white space collapsed.

    Escaped markup therefore stays. Each step is its own projection, so that no step
    repeats the one before it; without ``full_entities`` only the common ones are decoded.
    """
    t = F.col("_t")
    df = df.withColumn("_t", strip_tags(F.coalesce(text, F.lit(""))))
    df = df.withColumn("_a", ~(F.contains(t, F.lit("&")) & t.rlike(_NOT_AMP)))
    decoded = _decode_common(t, F.col("_a"))
    if full_entities:
        df = df.withColumn("_r", F.when(~F.col("_a") & t.rlike(_UNCOMMON), t))
        df = df.withColumn("_d", _decode_all("_r"))
        decoded = F.when(F.col("_r").isNull(), decoded).otherwise(F.col("_d"))
    df = df.withColumn("_t", decoded)
    return _with_collapsed(df, "_t", out).drop("_t", "_a", "_r", "_d")


def display_excerpt(col: Column, length: int = 160) -> Column:
    text = F.regexp_replace(F.coalesce(col, F.lit("")), "<[^>]+>", "")
    for entity, char in (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " ")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.substring(collapse(text), 1, length)


# --- lexicon matching ---------------------------------------------------------------------

def _gap(chars: int) -> str:
    return r"[\s\S]{0,%d}" % chars


def _joined(term: str, context: tuple[str, ...]) -> list[str]:
    """The texts in which a context word overlaps ``term``."""
    joined = []
    for word in context:
        if term in word:
            joined.append(word)
        for n in range(1, min(len(word), len(term))):
            if word.endswith(term[:n]):
                joined.append(word + term[n:])
            if term.endswith(word[:n]):
                joined.append(term + word[n:])
    return joined


def context_pattern(term: str, context: tuple[str, ...], window: int) -> str | None:
    """A regex that holds where a context word lies inside the window around ``term``.

    Covers words before, after and overlapping the term. None: every occurrence qualifies.
    """
    if any(word in term for word in context):
        return None
    quoted = re.escape(term)
    before: dict[int, list[str]] = {}
    for word in context:
        if len(word) > window:
            raise ValueError(f"context word longer than the window: {word!r}")
        before.setdefault(window - len(word), []).append(re.escape(word))
    joined = [re.escape(j) for j in _joined(term, context)]
    parts = []
    for gap, words in before.items():
        group = "(?:" + "|".join(words) + ")"
        parts += [quoted + _gap(gap) + group, group + _gap(gap) + quoted]
    # The lookahead rejects most positions on their first character.
    heads = "".join(re.escape(c) for c in sorted({w[0] for w in (term, *context)}))
    return f"(?=[{heads}])(?:{'|'.join(parts + joined)})"


def near_condition(text_lc: str, term: str, context: tuple[str, ...], window: int) -> str:
    """SQL text of :func:`context_pattern` for a term that can't overlap itself.

    The text is cut at the term. A context word inside the window of one occurrence but beyond the next is
    inside the window of that one too, so the two ends of what lies between occurrences tell.
    """
    ends = (f"concat(transform(slice(p, 2, size(p)), s -> left(s, {window})), "
            f"transform(slice(p, 1, size(p) - 1), s -> right(s, {window})))")
    near = (f"exists(array(split({text_lc}, {sql_text(re.escape(term))}, -1)), "
            f"p -> exists({ends}, w -> {contains_any('w', context)}))")
    joined = tuple(dict.fromkeys(_joined(term, context)))
    return f"({near} OR {contains_any(text_lc, joined)})" if joined else near


def term_condition(text_lc: str, term: str, lexicon: Lexicon) -> str:
    """SQL text of the test of one term on the named lower-cased column."""
    hit = f"contains({text_lc}, {sql_text(term)})"
    if term in lexicon.needs_context:
        pattern = context_pattern(term, lexicon.context, lexicon.window)
        if pattern and any(term.endswith(term[:n]) for n in range(1, len(term))):
            hit += (f" AND {contains_any(text_lc, lexicon.context)} "
                    f"AND {text_lc} RLIKE {sql_text(pattern)}")
        elif pattern:
            hit += f" AND {near_condition(text_lc, term, lexicon.context, lexicon.window)}"
    return hit


def gate_words(terms: tuple[str, ...]) -> list[str]:
    """A small set of words such that every term holds one of them (greedy cover)."""
    left, gates = list(dict.fromkeys(terms)), []
    while left:
        words = {w for t in left for w in (*t.split(), t)}
        best = max(sorted(words), key=lambda w: (sum(w in t for t in left), len(w)))
        gates.append(best)
        left = [t for t in left if best not in t]
    return gates


def term_hits(text_lc: str, lexicon: Lexicon) -> Column:
    """Lexicon terms found in the named lower-cased column, in lexicon order.

    Most texts hold no term: a few words shared by the terms are looked for first.
    """
    found = ", ".join(f"CASE WHEN {term_condition(text_lc, t, lexicon)} THEN {sql_text(t)} END"
                      for t in lexicon.terms)
    hits = f"array_except(array({found}), array(CAST(NULL AS STRING)))"
    gates = gate_words(lexicon.terms)
    if len(gates) <= len(lexicon.terms) * 2 // 3:
        hits = (f"CASE WHEN {contains_any(text_lc, gates)} THEN {hits} "
                "ELSE CAST(array() AS ARRAY<STRING>) END")
    return F.expr(hits)


def substring_hits(text_lc: str, terms: tuple[str, ...]) -> Column:
    return term_hits(text_lc, Lexicon(tuple(terms)))


def with_hits(df: DataFrame, text: str, lexicon: Lexicon, out: str = "kw") -> DataFrame:
    """Add the array of hits; the text is lower-cased once."""
    return (df.withColumn("_lc", F.lower(F.coalesce(F.col(text), F.lit(""))))
            .withColumn(out, term_hits("_lc", lexicon)).drop("_lc"))


def keep(df: DataFrame, condition: Column) -> DataFrame:
    """Rows where a costly computed condition holds.

    A plain filter would be pushed below the projections it reads, which repeats their
    expressions (here whole-text scans) in the filter. A generator is never pushed. All
    columns are carried along, so select the needed ones first.
    """
    return df.select(F.inline(F.when(condition, F.array(F.struct(*df.columns)))))


def matched_only(df: DataFrame, kw: str = "kw") -> DataFrame:
    return keep(df, F.size(kw) > 0)


def in_location(text: Column, wanted: tuple[str, ...] | None) -> Column:
    """True without a filter, else whether any wanted substring occurs."""
    if wanted is None:
        return F.lit(True)
    # the text is lower-cased once, not once per word
    found = F.transform(F.array(F.lower(text)), lambda low: any_of(
        [F.contains(low, F.lit(w)) for w in wanted]))
    return F.get(found, F.lit(0))


def excerpt(text: Column, keyword: Column, window: int = 120, low: Column | None = None) -> Column:
    """Half a window of characters on each side of the first hit, between ellipses.

    ``low`` is the text in lower case, where that is known already.
    """
    at = F.instr(F.lower(text) if low is None else low, F.lower(keyword))
    start = F.greatest(at - window // 2, F.lit(1))
    end = at + F.length(keyword) + window // 2
    snippet = F.substring(text, start, end - start)
    return (F.when(F.coalesce(at, F.lit(0)) > 0,
                   F.concat(F.lit("..."), strip(snippet), F.lit("...")))
            .otherwise(F.lit("")))


def split_list(col: Column) -> Column:
    """A ", " list as an array of trimmed, non-blank entries."""
    ended = F.concat(F.ltrim(F.coalesce(col, F.lit(""))), F.lit(", "))
    return F.array_remove(F.split(ended, " *, +"), "")


def join_list(col: Column) -> Column:
    return F.array_join(col, ", ")


# --- dates, slugs, page parts ----------------------------------------------------------------

def millis_to_date(col: Column) -> Column:
    """UTC date text of epoch milliseconds; blank for null and zero."""
    day = F.date_add(F.lit("1970-01-01").cast("date"),
                     F.floor(col / F.lit(86400000)).cast("int"))
    return F.when(F.coalesce(col, F.lit(0)) != 0, day.cast("string")).otherwise(F.lit(""))


def iso_prefix(col: Column) -> Column:
    return F.substring(F.coalesce(col, F.lit("")), 1, 10)


def iso_week(col: Column) -> Column:
    """ISO year and week as YYYY-WW."""
    return F.concat(F.extract(F.lit("YEAROFWEEK"), col).cast("string"), F.lit("-"),
                    F.lpad(F.weekofyear(col).cast("string"), 2, "0"))


def title_case(col: Column) -> Column:
    """Upper case for every letter that follows no letter ("2u" gives "2U").

    initcap starts words at blanks only, so other starts get a marked blank for a moment.
    """
    marked = F.regexp_replace(col, r"([^\p{L}])(?=\p{L})", "$1\x01 ")
    return F.replace(F.initcap(marked), F.lit("\x01 "), F.lit(""))


def prettify_slug(col: Column) -> Column:
    return title_case(F.translate(col, "-_", "  "))


def page_title(col: Column, default: str = "Unknown Role") -> Column:
    return first_nonblank(strip(F.regexp_extract(col, "(?i)<title>([^<]+)</title>", 1)),
                          default=default)


def page_state(col: Column) -> Column:
    """The JSON embedded in a page's __NEXT_DATA__ script, or null."""
    body = F.regexp_extract(
        col, r'(?s)<script[^>]*\bid="__NEXT_DATA__"[^>]*>(.*?)</script>', 1)
    return F.when(body != "", body)


def url_host(col: Column) -> Column:
    return F.lower(F.regexp_extract(col, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))


def infer_remote(first: Column, second: Column | None = None,
                 remote_in_second: bool = True) -> Column:
    """Remote / Hybrid / On-site from one or two texts.

    Sources differ in whether "remote" may also come from the second text.
    """
    first = F.lower(F.coalesce(first, F.lit("")))
    second = first if second is None else F.lower(F.coalesce(second, F.lit("")))
    remote = F.contains(first, F.lit("remote"))
    if remote_in_second:
        remote = remote | F.contains(second, F.lit("remote"))
    hybrid = F.contains(first, F.lit("hybrid")) | F.contains(second, F.lit("hybrid"))
    return (F.when(remote, "Remote").when(hybrid, "Hybrid").otherwise("On-site"))


def pay_label(low: Column, high: Column, interval: Column) -> Column:
    """Pay range label, in thousands for yearly pay."""
    def thousands(c: Column) -> Column:
        return F.concat(F.lit("$"), F.floor(c / 1000).cast("string"), F.lit("k"))
    yearly = F.contains(F.lower(F.coalesce(interval, F.lit(""))), F.lit("year"))
    plain = F.concat(F.lit("$"), low.cast("string"), F.lit("–$"), high.cast("string"),
                     F.lit(" "), F.coalesce(interval, F.lit("")))
    known = (F.coalesce(low, F.lit(0)) != 0) & (F.coalesce(high, F.lit(0)) != 0)
    known = known & ~F.isnan(low) & ~F.isnan(high)
    return (F.when(known & yearly, F.concat(thousands(low), F.lit("–"), thousands(high)))
            .when(known, plain).otherwise(F.lit("")))
