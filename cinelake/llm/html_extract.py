"""HTML extraction (9) by minimum cut: which blocks of a page are its article.

A page becomes blocks of text with the open elements around them.  A small classifier gives each
block log odds of being content, from its surroundings (element names, class, id and role words)
and its text (links, length, punctuation); an element that wraps the page's main text lends no
odds against it, whatever its name.  Where no article or main is marked up, the innermost element
that holds nearly all text without links plays its part.  The odds become capacities to the two terminals;
neighbouring blocks, and the next block under the same parent, are tied by smoothness edges that
weaken with DOM distance.  The minimum cut is the labelling of least total cost; blocks on the
source side are the text.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.common import pick, slices

# Elements without text of their own page.
SKIPPED = {"script", "style", "noscript", "template", "svg", "annotation", "annotation-xml", "iframe", "object", "canvas", "head", "title",
           "textarea", "select", "option", "datalist", "audio", "video", "map"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
          "label", "mark", "q", "ruby", "rt", "rp", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u",
          "var", "wbr", "img", "input", "math", "semantics", "mrow", "mi", "mn", "mo", "ms", "mtext", "mspace", "mfrac", "msqrt", "mroot", "mstyle",
          "msub", "msup", "msubsup", "munder", "mover", "munderover", "mmultiscripts", "mprescripts", "mtable", "mtr", "mtd", "mpadded",
          "mphantom", "menclose", "mfenced", "merror", "maction"}
CONTENT_TAGS = {"article", "main"}
OTHER_TAGS = {"nav", "footer", "aside", "form", "button", "menu", "dialog", "fieldset", "legend"}
CONTENT_WORDS = {"article", "content", "main", "post", "entry", "story", "body", "text", "prose"}
OTHER_WORDS = {"ad", "ads", "advert", "advertisement", "adverts", "advertising", "alert", "banner", "breadcrumb", "breadcrumbs", "byline", "comment",
               "comments", "consent", "cookie", "cookies", "disclaimer", "disqus", "footer", "form", "gdpr", "header", "hidden", "login",
               "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification", "pager", "pagination", "popup", "privacy",
               "promo", "promotion", "recommended", "related", "replies", "reply", "respond", "search", "share", "sharing", "sidebar",
               "side", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "tags", "teaser", "toolbar", "toc", "topbar", "widget", "complementary", "contentinfo"}
# Log odds.
INSIDE, OUTSIDE, NAMED_CONTENT, NAMED_OTHER, IN_OTHER_TAG = 3.0, -1.0, 1.5, -7.0, -7.0
LONG, SHORT, CLOSED, LINKED = 1.0, -0.5, 0.5, -4.0
# Smoothness of neighbours under one parent; halved for each step of DOM distance beyond.
TIE = 0.6
# Of the text of a page without article or main that is not marked as other, the part that makes an element its wrapper.
WRAPPED = 0.9
# Of the same text, the part that makes an element stand in for the article.
STANDS_IN = 0.9
# Bytes from which a block is long and below which it is short: about 15 and 4 Latin words, 30 and 8 Chinese characters.
LONG_BYTES, SHORT_BYTES = 90, 24
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_CLOSES = {  # an opening tag ends these open elements first
    "p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
_SCOPES = {"article", "main", "section", "div", "nav", "footer", "header", "aside", "form", "ul", "ol", "dl", "table", "body", "html", "blockquote"}
# Elements of a head; any other start tag, or text, ends a head that was left open.
_HEAD = {"head", "html", "base", "basefont", "bgsound", "link", "meta", "noframes", "noscript", "script", "style", "template", "title"}
# Start tags that end an open select; those of tables only inside one.
_ENDS_SELECT, _OF_TABLE = {"input", "keygen", "select", "textarea"}, {"caption", "table", "tbody", "tfoot", "thead", "tr", "td", "th"}
# Start tags that end an open svg, unless one of its elements for HTML text is open.
_ENDS_SVG = {"b", "big", "blockquote", "body", "br", "center", "code", "dd", "div", "dl", "dt", "em", "embed", "h1", "h2", "h3", "h4", "h5", "h6",
             "head", "hr", "i", "img", "li", "listing", "menu", "meta", "nobr", "ol", "p", "pre", "ruby", "s", "small", "span", "strong", "strike",
             "sub", "sup", "table", "tt", "u", "ul", "var"}
_HTML_IN_SVG = ("foreignobject", "desc", "title")
# Skipped elements that the end of an element around them does not end.
_OWN_END = ("object", "template", "select", "textarea", "title", "iframe", "noscript")


class _Page(HTMLParser):
    """Blocks of a page: [text parts, link characters, path of open elements]."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, float]] = [("", 0, 0.0)]  # name, number, log odds of its name and attributes
        self.count = 0
        self.skipped: list[str] = []  # a skipped element and what is open in it
        self.inside: Counter = Counter()  # the same by name
        self.links = 0
        self.parts: list[str] = []
        self.linked = 0
        self.blocks: list[tuple[str, float, tuple]] = []
        self.hidden: set[int] = set()  # numbers of hidden elements

    def end_block(self):
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append((text, min(1.0, self.linked / len(text)), tuple(self.open)))
        self.parts, self.linked = [], 0

    def close_to(self, at: int):
        del self.open[at:]

    def end_skipped(self, tag: str):
        """Ends the innermost skipped ``tag`` and all in it."""
        while True:
            name = self.skipped.pop()
            self.inside[name] -= 1
            if name == tag:
                return

    def implied_end(self, tag: str) -> bool:
        """Ends the skipped elements whose end tag was left out before the start tag ``tag``; True: that is all the tag does."""
        outer, inside = self.skipped[0], self.inside
        if inside["template"]:
            return False
        if outer == "head" and (tag == "body" or len(self.skipped) == 1 and tag not in _HEAD):
            self.end_skipped("head")
        elif outer == "option" and (tag == "option" or tag not in INLINE and tag not in VOID):
            while self.skipped:
                self.end_skipped("option")
        elif inside["select"] and (tag in _ENDS_SELECT or tag in _OF_TABLE and any(name == "table" for name, _, _ in self.open)):
            self.end_skipped("select")
            return tag == "select"
        elif inside["svg"] and tag in _ENDS_SVG and not any(inside[x] for x in _HTML_IN_SVG):
            while inside["svg"]:
                self.end_skipped("svg")
        return False

    def handle_starttag(self, tag, attrs):
        if self.skipped and self.implied_end(tag):
            return
        if tag == "head" and (self.blocks or "".join(self.parts).strip() or any(name not in ("", "html") for name, _, _ in self.open)):
            return  # in a body: no element
        if self.skipped or tag in SKIPPED:
            if tag not in VOID:
                self.skipped.append(tag)
                self.inside[tag] += 1
            return
        if tag == "a":
            self.links = 1
        if tag == "br":
            self.parts.append(" ")
        odds = named(tag, attrs, any(name in CONTENT_TAGS for name, _, _ in self.open))
        if tag in INLINE and not odds:
            return
        if tag in INLINE:  # an inline element that names a role stands for a block of its own
            self.end_block()
            self.push(tag, odds, attrs)
            return
        if tag in VOID:
            if tag == "hr":
                self.end_block()
            return
        self.end_block()
        ends = _CLOSES.get(tag, {"p"} if tag not in ("p",) else set())
        while len(self.open) > 1:
            low = len(self.open) - 1
            while low > 0 and self.open[low][0] not in ends and self.open[low][0] not in _SCOPES:
                low -= 1
            if low > 0 and self.open[low][0] in ends:
                self.close_to(low)
            else:
                break
        self.push(tag, odds, attrs)

    def push(self, tag, odds, attrs):
        self.count += 1
        if is_hidden(attrs):
            self.hidden.add(self.count)
        self.open.append((tag, self.count, odds))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if self.skipped and self.skipped[-1] == tag:
            self.end_skipped(tag)
        elif not self.skipped and tag not in VOID and tag not in SKIPPED:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.skipped:
            if self.inside[tag]:
                self.end_skipped(tag)
                return
            if any(self.inside[x] for x in _OWN_END) or all(name != tag for name, _, _ in self.open):
                return
            self.skipped, self.inside = [], Counter()
        if tag in SKIPPED:
            return
        if tag == "a":
            self.links = 0
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at][0] == tag:
                self.end_block()
                self.close_to(at)
                return
            if self.open[at][0] in _SCOPES and tag not in _SCOPES:
                break
        if tag not in INLINE:
            self.end_block()

    def handle_data(self, data):
        if self.skipped == ["head"] and data.strip():
            self.end_skipped("head")
        if not self.skipped:
            self.parts.append(data)
            if self.links:
                self.linked += len(data.strip())


def is_hidden(attrs) -> bool:
    return any(k in ("hidden", "aria-hidden") and v != "false" or k == "style" and v and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", v)
               for k, v in attrs)


def named(tag: str, attrs, inside: bool = False) -> float:
    """Log odds that an element's name and attributes lend to what stands in it; html and body hold the whole page and lend none.

    ``inside`` an article or main, a header is the article's own.
    """
    if tag in ("html", "body"):
        return 0.0
    odds = INSIDE if tag in CONTENT_TAGS else IN_OTHER_TAG if tag in OTHER_TAGS else 0.0
    words = {w.lower() for k, v in attrs if k in ("class", "id", "role") and v for w in _NAME.findall(v)}
    if words & OTHER_WORDS - ({"header"} if inside else set()) or is_hidden(attrs):
        odds += NAMED_OTHER
    elif words & CONTENT_WORDS:
        odds += NAMED_CONTENT
    return odds


def unwrapped(blocks: list[tuple[str, float, tuple]], hidden: set[int]) -> list[tuple[str, float, tuple]]:
    """The blocks, without the odds against them of elements that wrap the page's main text.

    Text belongs to the innermost element with odds against it.  The one that holds the largest
    article or main wraps the page if no more text stands outside all such elements; on a page
    without article or main, the one that holds nearly all other text.  So do the ones around it.
    """
    free, main, held, around = 0, Counter(), Counter(), {}
    for text, links, path in blocks:
        if any(n in hidden and name not in ("html", "body") for name, n, _ in path):
            continue
        against = [i for i, (_, _, o) in enumerate(path) if o < 0]
        if not against:
            free += len(text) * (1 - links)
            continue
        at = against[-1]
        name, number, _ = path[at]
        around[number] = {path[i][1] for i in against}
        content = [n for x, n, _ in path[at:] if x in CONTENT_TAGS]
        if content:
            main[content[0], number] += len(text) * (1 - links)
        elif name == "form" or name not in OTHER_TAGS:
            held[number] += len(text) * (1 - links)
    wraps: set[int] = set()
    if main:
        (_, number), n = main.most_common(1)[0]
        wraps = around[number] if n >= free else wraps
    elif held and not any(name in CONTENT_TAGS for _, _, path in blocks for name, _, _ in path):
        number, n = held.most_common(1)[0]
        wraps = around[number] if n >= WRAPPED * (free + sum(held.values())) else wraps
    if not wraps:
        return blocks
    return [(text, links, tuple((name, n, 0.0 if n in wraps and name not in CONTENT_TAGS else INSIDE if n in wraps else o) for name, n, o in path))
            for text, links, path in blocks]


def stand_in(blocks: list[tuple[str, float, tuple]], hidden: set[int]) -> list[tuple[str, float, tuple]]:
    """The blocks; on a page without article or main, those of the element that stands in for it as if in an article.

    It is the innermost element that holds ``STANDS_IN`` of the text outside links, headers and
    elements with odds against them, and that is not itself a block of text.  A first-rank heading
    outside all those belongs to it.
    """
    if any(name in CONTENT_TAGS for _, _, path in blocks for name, _, _ in path):
        return blocks

    def plain(path: tuple) -> bool:
        return not any(o < 0 or name == "header" or n in hidden and name not in ("html", "body") for name, n, o in path)

    held: Counter = Counter()
    for text, links, path in blocks:
        if plain(path):
            for _, n, _ in path[:-1] or path:
                held[n] += len(text) * (1 - links)
    if not held[0]:
        return blocks
    # those over half are nested, and an inner element has the larger number
    chosen = max(n for n, size in held.items() if size >= STANDS_IN * held[0])
    return [(text, links, (*path, ("main", chosen, INSIDE))
             if plain(path) and (path[-1][0] == "h1" or any(n == chosen for _, n, _ in path)) else path)
            for text, links, path in blocks]


def log_odds(text: str, links: float, path: tuple) -> float:
    inside = any(name in CONTENT_TAGS for name, _, _ in path)
    good = max((o for _, _, o in path if o > 0), default=0.0)
    bad = min((o for _, _, o in path if o < 0), default=0.0)
    if not inside and any(name == "header" for name, _, _ in path):
        bad = min(bad, IN_OTHER_TAG)
    n = len(text.encode("utf-8", "surrogatepass"))
    return (good + bad + (0.0 if inside else OUTSIDE) + (LONG if n >= LONG_BYTES else SHORT if n < SHORT_BYTES else 0.0)
            + (CLOSED if text[-1] in ".!?…\"”»" else 0.0) + LINKED * links)


def minimum_cut(odds: list[float], edges: dict[tuple[int, int], float]) -> list[bool]:
    """True for the nodes on the content side of a minimum cut (the smallest such side)."""
    near: list[dict[int, float]] = [{} for _ in odds]
    for (a, b), w in edges.items():
        near[a][b] = near[a].get(b, 0.0) + w
        near[b][a] = near[b].get(a, 0.0) + w
    # a node whose odds outweigh all its ties has its label in every minimum cut: it joins its terminal
    odds, side = list(odds), [None] * len(odds)
    todo = deque(range(len(odds)))
    while todo:
        v = todo.popleft()
        if side[v] is None and abs(odds[v]) > sum(near[v].values()):
            side[v] = odds[v] > 0
            for u, w in near[v].items():
                odds[u] += w if side[v] else -w
                near[u].pop(v)
                todo.append(u)
            near[v] = {}
    rest = [v for v, s in enumerate(side) if s is None]
    for v, reached in zip(rest, _source_side(rest, odds, near), strict=True):
        side[v] = reached
    return [bool(s) for s in side]


def _source_side(rest: list[int], odds: list[float], near: list[dict[int, float]]) -> list[bool]:
    """Which of the nodes ``rest`` the source reaches after a maximum flow (level graphs, blocking flows over current arcs)."""
    source, sink = len(rest), len(rest) + 1
    arcs: list[list[int]] = [[] for _ in range(len(rest) + 2)]
    ends, room = [], []  # an arc and its reverse are neighbours: 2 i and 2 i + 1

    def tie(u: int, v: int, forth: float, back: float):
        arcs[u].append(len(ends))
        arcs[v].append(len(ends) + 1)
        ends.extend((v, u))
        room.extend((forth, back))

    at = {v: i for i, v in enumerate(rest)}
    for v, i in at.items():
        if odds[v] > 0:
            tie(source, i, odds[v], 0.0)
        elif odds[v] < 0:
            tie(i, sink, -odds[v], 0.0)
        for u, w in near[v].items():
            if u > v:
                tie(i, at[u], w, w)
    while True:
        level, queue = {source: 0}, deque([source])
        while queue:
            u = queue.popleft()
            for a in arcs[u]:
                if room[a] > 1e-12 and ends[a] not in level:
                    level[ends[a]] = level[u] + 1
                    queue.append(ends[a])
        if sink not in level:
            return [i in level for i in range(len(rest))]
        current = [0] * len(arcs)
        way: list[int] = []  # arcs from the source
        while True:
            u = ends[way[-1]] if way else source
            if u == sink:
                flow = min(room[a] for a in way)
                for a in way:
                    room[a] -= flow
                    room[a ^ 1] += flow
                del way[next(k for k, a in enumerate(way) if room[a] <= 1e-12):]
                continue
            while current[u] < len(arcs[u]):
                a = arcs[u][current[u]]
                if room[a] > 1e-12 and level.get(ends[a]) == level[u] + 1:
                    way.append(a)
                    break
                current[u] += 1
            else:
                if not way:
                    break
                way.pop()
                level.pop(u)  # a dead end of this level graph


def smoothness(paths: list[tuple]) -> dict[tuple[int, int], float]:
    edges: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}
    for i, path in enumerate(paths):
        if i:
            before = {n for _, n, _ in paths[i - 1]}
            shared = sum(n in before for _, n, _ in path)
            apart = max(0, len(path) + len(paths[i - 1]) - 2 * shared - 2)  # 0: siblings or the same element
            edges[i - 1, i] = TIE / 2 ** apart
        parent = path[-2][1] if len(path) > 1 else 0
        if parent in last and last[parent] != i - 1:
            edges[last[parent], i] = TIE / 2
        last[parent] = i
    return edges


def main_text(page: str | None) -> str:
    """The article of a page: its blocks in page order, joined by single spaces."""
    if not page:
        return ""
    parser = _Page()
    parser.feed(page)
    parser.close()
    parser.end_block()
    blocks = unwrapped(parser.blocks, parser.hidden)
    keep = minimum_cut([log_odds(*b) for b in stand_in(blocks, parser.hidden)], smoothness([b[2] for b in blocks]))
    return " ".join(b[0] for b, k in zip(blocks, keep, strict=True) if k)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: page_id, url, text.

    Null and empty html, and pages without content, give an empty text; ids and urls are carried
    along as they are, one result per row, repeated rows too; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, urls, texts in slices(batches, 64):
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array([main_text(t) for t in texts], pa.string())],
                names=["page_id", "url", "text"])

    return (pick(pages, page_id=id_col, url=url_col, html=html_col)
            .select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
            .mapInArrow(run, "page_id bigint, url string, text string"))
