"""Main text of web pages: blocks by markup, then differencing against pages of neighbouring URLs."""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import renamed

# Fixed values of HTML: elements by how they are read.
RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
        "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em",
          "font", "i", "img", "ins", "kbd", "label", "mark", "q", "ruby", "rb", "rp", "rt", "s", "samp", "small",
          "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
#: An open element that the start of another ends, and what shields it.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"})}
SHIELDS_P = {"article", "main", "section", "div", "td", "th", "li", "body", "blockquote", "table", "dd", "figure",
             "form", "nav", "aside", "header", "footer"}
# Fixed values of this extractor: what is never part of the article.
DROPPED = RAW | {"nav", "header", "footer", "aside", "head", "button", "select", "svg", "template", "object",
                 "canvas", "audio", "video", "menu", "dialog", "fieldset", "datalist", "math"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog",
         "menu", "menubar", "toolbar", "status"}
NAMES = ("nav|navbar|navigation|menu|header|masthead|footer|sidebar|aside|ad|ads|advert|adverts|advertisement|"
         "sponsor|sponsored|promo|promotion|banner|cookie|cookies|consent|gdpr|notice|notices|alert|popup|modal|"
         "overlay|newsletter|subscribe|subscription|signup|login|comment|comments|replies|reply|respond|disqus|"
         "share|sharing|social|related|recommended|recommendations|breadcrumb|breadcrumbs|pagination|pager|"
         "widget|toolbar|search|copyright|disclaimer|skip|paywall|form")
MAIN_NAMES = "article|content|main|post|entry|story|text|body"
#: Names of what may hold articles that are not the page's own.
LISTS = ("sidebar|aside|ad|ads|advert|adverts|advertisement|sponsor|sponsored|promo|promotion|comment|comments|replies|"
         "reply|respond|disqus|related|recommended|recommendations|widget")
_BAD_NAME = re.compile(rf"(?!(?:is|js)[-_]|(?:.*[-_])?(?:with|without|has|no)[-_]|(?:{MAIN_NAMES})[-_]header)"
                       rf"(?:(?:{NAMES})(?:[-_].*)?|.*[-_](?:{NAMES}))")
_LIST_NAME = re.compile(rf"(?:{LISTS})(?:[-_].*)?|.*[-_](?:{LISTS})")
#: An article of such a name is a comment or an advert.
_BAD_ARTICLE = re.compile(rf"{NAMES}|(?:comment|reply|{LISTS.replace('comments|', '')})[-_].*")
_MAIN_NAME = re.compile(rf"(?:{MAIN_NAMES})(?:[-_](?:{MAIN_NAMES}))*")
PARAGRAPHS = {"p", "blockquote", "pre", "h1", "h2", "h3", "h4", "h5", "h6"}
#: Elements that hold the article if their name says so.
CONTAINERS = {"div", "section", "td", "center"}
_TAG = re.compile(r"<!--(?:>|->|.*?(?:-->|--!>|\Z))|<[!?][^>]*(?:>|\Z)"
                  r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)
#: A page that shares more than this share of its characters with a neighbour is its copy, unless both have other
#: long lines of their own; lines of so many characters are long.
COPY = 0.8
LONG = 50


#: How an element is dropped: never its text, or unless it holds an article, or unless there is no other article.
KEPT, UNLESS_HOLDS, UNLESS_ONLY, DROP = range(4)
#: Whether an element holds the article: not, by its name, or as an article or main element.
NAMED, REAL = 1, 2


def _judge(name: str, attributes: str, inside: bool) -> tuple[int, int]:
    """How an element is dropped, whether it holds the article; ``inside`` an article or main element, articles
    are dropped like other elements."""
    real = name in ("article", "main")
    bad, good = DROP if name in DROPPED else UNLESS_HOLDS if name == "form" else KEPT, REAL if real else 0
    if attributes and name not in ("html", "body"):
        for key, *values in _ATTR.findall(attributes):
            key, value = key.lower(), next((v for v in values if v), "").lower()
            if key in ("class", "id"):
                for x in value.split():
                    if real and not inside:
                        bad = max(bad, UNLESS_ONLY if _BAD_ARTICLE.fullmatch(x) else KEPT)
                    elif _BAD_NAME.fullmatch(x):
                        bad = max(bad, UNLESS_ONLY if _LIST_NAME.fullmatch(x) else UNLESS_HOLDS)
                    if name in CONTAINERS and _MAIN_NAME.fullmatch(x):
                        good = max(good, NAMED)
            elif key == "role":
                bad = max(bad, DROP if value in ROLES else UNLESS_HOLDS if value == "form" else KEPT)
                good = max(good, REAL if value in ("main", "article") else 0)
            elif key == "hidden" or key == "aria-hidden" and value == "true" or \
                    key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                bad = DROP
    return bad, good


def blocks(page: str) -> list[tuple[str, int]]:
    """Blocks of text in page order, each with 0: outside the article, 1: loose inside it,
    2: a paragraph or heading of it. What is dropped by markup gives none.

    Names and forms drop nothing that turns out to hold an article or main element, lists (comments, related
    pages, sidebars) only what holds the page's only ones, and forms stay where the page has no other text.
    Elements that are the article by their name count where no article or main element has text.
    """
    found: list[tuple[list[tuple[str, tuple[int, ...]]], int, bool]] = []
    parts: list[tuple[str, tuple[int, ...]]] = []  # a piece of text, and what drops it
    # name, dropped for good, how far inside the article, numbers of those that may drop it
    stack: list[tuple[str, bool, int, tuple[int, ...]]] = []
    how: list[tuple[int, str]] = []  # of those that may drop
    holders: list[tuple[int, tuple[int, ...]]] = []  # elements that hold the article, and what may drop them
    kind, paragraph, place = 0, False, 0

    def text(to: int) -> None:
        if to > place and not (stack and stack[-1][1]):
            parts.append((html.unescape(page[place:to]), stack[-1][3] if stack else ()))

    def flush() -> None:
        nonlocal kind, paragraph
        if parts:
            found.append((parts.copy(), kind, paragraph))
            parts.clear()
        kind = stack[-1][2] if stack else 0
        paragraph = any(x[0] in PARAGRAPHS for x in stack[-4:])

    def close(names: set[str], shields: set[str]) -> None:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                del stack[k:]
                return
            if stack[k][0] in shields:
                return

    search = _TAG.search
    while m := search(page, place):
        text(m.start())
        place = m.end()
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if name == "br":
            parts.append((" ", ()))
            continue
        block = name not in INLINE
        if block:
            flush()
        if m[1]:
            close({name}, set() if name in ("body", "html", "article", "main") else {"article", "main"} - {name})
        elif name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(page, place)
            place = end.end() if end else len(page)
        elif name not in VOID:
            if block:
                close({"p"}, SHIELDS_P)
            if name in ENDS:
                close(*ENDS[name])
            above = stack[-1] if stack else ("", False, 0, ())
            bad, good = _judge(name, m[3], name == "article" and any(x[0] == "article" for x in stack))
            by = above[3]
            if good and bad == KEPT and not above[1]:
                holders.append((good, by))
            if bad in (UNLESS_HOLDS, UNLESS_ONLY):
                by = (*by, len(how))
                how.append((bad, "article" if good == REAL else name))
            stack.append((name, above[1] or bad == DROP, max(above[2], good), by))
        if block:
            flush()
    text(len(page))
    flush()

    lifted: set[int] = set()

    def kept() -> list[tuple[str, int, bool]]:
        out = []
        for pieces, kind, paragraph in found:
            line = " ".join("".join(x for x, by in pieces if lifted.issuperset(by)).split())
            if line:
                out.append((line, kind, paragraph))
        return out

    for good, by in holders:
        # a form is the page's where it holds the article in any way; other names give way to real elements
        if all(how[x][0] == UNLESS_HOLDS and (good == REAL or how[x][1] == "form") for x in by):
            lifted.update(by)
    out = kept()
    if how and not any(k for _, k, _ in out):
        held = [by for good, by in holders if good == REAL and by] or \
            [(x,) for x, (_, name) in enumerate(how) if name == "article"]
        fewest = min(map(len, held), default=0)
        more = {x for by in held if len(by) == fewest for x in by}
        if not more and not out:
            more = {x for pieces, _, paragraph in found for _, by in pieces if paragraph
                    and all(how[y][1] == "form" for y in by) for x in by}
        if more:
            lifted |= more
            out = kept()
    least = REAL if any(k == REAL for _, k, _ in out) else NAMED
    return [(line, 0 if k < least else 2 if paragraph else 1) for line, k, paragraph in out]


def common(a: list[str], b: list[str]) -> list[int]:
    """Places in ``a`` of a longest common subsequence of two lists of lines.

    Lines that repeat are numbered by occurrence, which makes all lines distinct, so that the
    subsequence is a longest increasing one and takes n log n steps.
    """
    def numbered(lines: list[str]) -> list[tuple[str, int]]:
        seen: dict[str, int] = {}
        out = []
        for x in lines:
            seen[x] = seen.get(x, -1) + 1
            out.append((x, seen[x]))
        return out

    place = {x: i for i, x in enumerate(numbered(b))}
    pairs = [(i, place[x]) for i, x in enumerate(numbered(a)) if x in place]
    tails: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for n, (_, j) in enumerate(pairs):
        k = bisect_left(tails, j)
        back.append(ends[k - 1] if k else -1)
        if k == len(tails):
            tails.append(j)
            ends.append(n)
        else:
            tails[k], ends[k] = j, n
    out, n = [], ends[-1] if ends else -1
    while n >= 0:
        out.append(pairs[n][0])
        n = back[n]
    return out[::-1]


def _body(page: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """The blocks inside the article, or all where none is."""
    inside = any(k for _, k in page)
    return [(x, k) for x, k in page if k or not inside]


def copies(own: list[str], other: list[str], shared: set[int]) -> bool:
    """Whether a page is a copy of another, given the places of its lines that both share.

    A short article in a large template shares most of its characters with any page of the template. It is
    told by the long lines that each page has for itself: those of a copy are missing, or edits of each other.
    """
    if sum(len(own[i]) for i in shared) <= COPY * sum(map(len, own)):
        return False
    left = Counter(other)
    left.subtract(own[i] for i in shared)
    mine = Counter(w for i, x in enumerate(own) if i not in shared and len(x) >= LONG for w in x.split())
    others = Counter(w for x, n in left.items() if n > 0 and len(x) >= LONG for _ in range(n) for w in x.split())
    return 2 * (mine & others).total() >= min(mine.total(), others.total())


def article(own: list[tuple[str, int]], neighbours: list[list[tuple[str, int]]]) -> str:
    """The page's text without the loose lines that it shares with neighbours."""
    kept = _body(own)
    lines = [x for x, _ in kept]
    gone: set[int] = set()
    for other in neighbours:
        shared = common(lines, [x for x, _ in other])
        if not copies(lines, [x for x, _ in _body(other)], set(shared)):
            gone.update(i for i in shared if kept[i][1] < 2)
    return "\n".join(x for i, x in enumerate(lines) if i not in gone)


class Run:
    """Neighbouring pages of equal lines: one copy of the lines, the pages' numbers and addresses, and the last
    page before them that they are no copies of."""

    def __init__(self, block: int, host: str, page: list[tuple[str, int]], names: list[tuple]):
        self.block, self.host, self.page, self.names = block, host, page, names
        self.before: Run | None = None

    def follow(self, last: Run | None) -> None:
        """Sets the page before from the run before."""
        if last and last.host == self.host:
            own, other = ([x for x, _ in _body(r.page)] for r in (self, last))
            self.before = last.before if copies(own, other, set(common(own, other))) else last

    def text(self, after: Run | None) -> str:
        near = [r.page for r in (self.before, after) if r and r.host == self.host]
        return article(self.page, near)


def url_key(url: str | None) -> tuple[str, str]:
    """Host and path of an address, without query, fragment, closing slash and file ending."""
    m = re.match(r"(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].lower(), m[2]) if m else ("", re.split(r"[?#]", url or "")[0])
    return host, re.sub(r"\.\w{1,5}$", "", path.rstrip("/"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              pages_per_block: int = 500, sample: int = 20000) -> DataFrame:
    """The main text of every page: (page_id, url, text).

    Tasks cut a page into blocks of text and drop what markup tells to be no article (menus, headers,
    footers, sidebars, notices, adverts, forms, comments, scripts, hidden parts). Pages are then put in order
    of host and URL path, in blocks of about ``pages_per_block`` neighbours whose borders come from a
    hashed sample of at most ``sample`` addresses, so that a host of any size is spread. Each page is aligned
    with the nearest page before it that is no copy of it and with the next one of other lines, of its host, by
    a longest common subsequence of lines; pages at the borders of a block are compared with those of the next
    block after the others. Shared lines go; paragraphs and headings inside an article element stay, and so do
    all lines shared with a copy of the page. Where a page has an article element, only what is inside is text.

    Null html counts as empty and gives an empty text; a null address is an empty one. Rows that
    repeat are separate pages. An empty table gives an empty one; other columns are ignored.
    """
    rows = renamed(pages, page_id=id_col, url=url_col, html=html_col)
    n = rows.count()
    n_blocks = max(1, min(sample, n // pages_per_block))
    share = min(1.0, sample / max(1, n))
    drawn = (rows.where(F.pmod(F.xxhash64("url", "page_id"), F.lit(1_000_000)) < share * 1e6)
             .select("url", F.col("page_id").cast("string").alias("id")).collect())
    keys = sorted((*url_key(r["url"]), r["id"] or "") for r in drawn)
    borders = [keys[k * len(keys) // n_blocks] for k in range(1, n_blocks)] if keys else []
    shared = pages.sparkSession.sparkContext.broadcast(borders)

    def cut(batches):
        borders = shared.value
        for batch in batches:
            ids = [x if x is not None else "" for x in batch.column("page_id").cast(pa.string()).to_pylist()]
            keys = [(*url_key(u), i) for u, i in zip(batch.column("url").to_pylist(), ids)]
            cut_up = [blocks(page or "") for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "page_id": batch.column("page_id"), "url": batch.column("url"),
                "block": pa.array([bisect_right(borders, k) for k in keys], pa.int32()),
                "host": pa.array([k[0] for k in keys], pa.string()), "path": pa.array([k[1] for k in keys], pa.string()),
                "lines": pa.array([[x for x, _ in b] for b in cut_up], pa.list_(pa.string())),
                "kinds": pa.array([[k for _, k in b] for b in cut_up], pa.list_(pa.int8()))})

    def runs(batches, joined: bool) -> Iterator[Run]:
        """Pages of equal lines that follow each other, in a block or in joined borders, are one."""
        now = None
        for batch in batches:
            c = batch.to_pydict()
            own = ([(x["page_id"], x["url"]) for x in n] for n in c["names"]) if joined else \
                ([x] for x in zip(c["page_id"], c["url"]))
            for block, host, lines, kinds, names in zip(c["block"], c["host"], c["lines"], c["kinds"], own):
                page = [*zip(lines, kinds)]
                if now and (joined or now.block == block) and (now.host, now.page) == (host, page):
                    now.names += names
                    continue
                if now:
                    yield now
                now = Run(block, host, page, names)
        if now:
            yield now

    def walked(batches, joined: bool) -> Iterator[tuple[Run, Run | None, bool, bool]]:
        """Each run, the one after it, and whether it is the first and the last of its block."""
        now, first = None, True
        for after in runs(batches, joined):
            new = now is None or not joined and now.block != after.block
            after.follow(None if new else now)
            if now:
                yield now, None if new else after, first, new
                now.before = None
            now, first = after, new
        if now:
            yield now, None, first, True

    def texts(joined: bool):
        def run(batches):
            done: list[tuple] = []

            def given() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays(
                    [pa.array([d[0] for d in done], id_type), pa.array([d[1] for d in done], pa.string()),
                     pa.array([d[2] for d in done], pa.string())], ["page_id", "url", "text"])
            for now, after, first, final in walked(batches, joined):
                if now.names and (joined or not first and not final):
                    text = now.text(after)
                    for name in now.names:
                        done.append((*name, text))
                        if len(done) >= 500:
                            yield given()
                            done = []
            if done:
                yield given()
        return run

    def borders_of(batches):
        """The first and the last run of each block, and, without names, what stands beside them in it."""
        def given(place: int, r: Run, names: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r.block], pa.int32()), pa.array([place], pa.int32()), pa.array([r.host], pa.string()),
                 pa.array([[x for x, _ in r.page]], pa.list_(pa.string())),
                 pa.array([[k for _, k in r.page]], pa.list_(pa.int8())),
                 pa.array([[{"page_id": i, "url": u} for i, u in names]],
                          pa.list_(pa.struct([("page_id", id_type), ("url", pa.string())])))],
                ["block", "place", "host", "lines", "kinds", "names"])
        for now, after, first, final in walked(batches, False):
            if final and not first and now.before:
                yield given(2, now.before, [])
            if first or final:
                yield given(0 if first else 3, now, now.names)
            if first and after:
                yield given(1, after, [])

    kind = rows.schema["page_id"].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_type
    id_type = to_arrow_type(rows.schema["page_id"].dataType)
    blocked = rows.mapInArrow(cut, f"page_id {kind}, url string, block int, host string, path string, "
                                   "lines array<string>, kinds array<tinyint>")
    ordered = (blocked.repartition(n_blocks, "block")
               .sortWithinPartitions("block", "host", "path", "page_id", F.xxhash64("lines")))
    out = f"page_id {kind}, url string, text string"
    # a few rows for each block
    border = (ordered.mapInArrow(borders_of, "block int, place int, host string, lines array<string>, "
                                 f"kinds array<tinyint>, names array<struct<page_id: {kind}, url: string>>")
              .repartition(1).sortWithinPartitions("block", "place"))
    return ordered.mapInArrow(texts(False), out).unionByName(border.mapInArrow(texts(True), out))
