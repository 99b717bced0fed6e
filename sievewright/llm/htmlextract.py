"""Main text of HTML pages by minimum-cut labelling.

A page is read into blocks, the stretches of text between block-level tags; a run
of text in an inline element that is marked as boilerplate is a node of its own
within its block. A linear classifier over a node's text (links, length, its end, and
phrases of notices) gives the cost of calling it content or boilerplate. The marks of
an element, its tags and names, say nothing of a text but of all that it holds: each marked
element is a node, too, with the cost of its marks for every text in it. These costs are the
capacities from the source and to the sink. A text is tied to the element that marks it, by
an edge of the weight of the marks; texts that follow each other, and texts of one parent, by
edges that grow with the share of the DOM path that they have in common. The minimum cut, found by
maximum flow, is the cheapest labelling: prose in an advert goes with the advert, and
a line that looks like nothing with the article around it. Nodes whose own cost outweighs
all their edges are labelled before, which doesn't change the minimum.

Marks are evidence, not verdicts: names of classes and ids count by their words,
a name with words of layout (``has-sidebar``) says nothing, one with words that
aren't known says little, and what holds the page's largest article isn't
boilerplate by its name. Only what isn't shown at all is out for sure.

Each page is a row by itself: no shuffle, and no page is cut. A null or empty
page has an empty text. Malformed markup never fails: unclosed elements end with
their parents, a ``<`` that opens no tag is text, and an unclosed comment or
script runs to the end. Reading takes time in proportion to the page. Repeated
rows give repeated results.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OPENS = re.compile(r"<(?:!--|[!?]|/?[a-zA-Z])")
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>\x00]*+)")
#: Attributes up to a ``>`` outside of quotes.
_QUOTED = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_ATTR = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")

#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content isn't text of the page.
SKIPPED = frozenset("script style noscript template textarea title iframe svg math object canvas audio video select datalist".split())
#: Elements that begin and end a block.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
_CLOSES_P = BLOCK - {"button", "caption", "legend", "option", "optgroup", "td", "th", "tr", "tbody", "thead", "tfoot", "body", "html"}
#: What a start tag closes, up to the first of the second set.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
#: Tags that mark all they hold as boilerplate; header only outside of content.
PLAIN_TAGS = frozenset("nav footer aside form menu dialog button search".split())
PLAIN_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar status".split())
#: Words of class names and ids that mark boilerplate.
PLAIN_WORDS = frozenset(
    """ad ads adv advert advertisement advertisements advertising adsense banner banners breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright
    disqus footer gdpr login menu menus modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promotion recommended recommendations related
    replies reply respond responses rail share sharing sidebar sidebars signin signup skip social sponsor sponsored subscribe subscription toolbar topbar widget widgets masthead
    alert disclaimer overlay paywall teaser outbrain taboola""".split()
)
#: Words that mark boilerplate outside of content, unless a word of content stands beside them.
PERHAPS_PLAIN = frozenset("header meta tags tools links top bottom aside side form search".split())
CONTENT_TAGS = frozenset(("article", "main"))
CONTENT_WORDS = frozenset("article articles content entry post posts story body text main prose blogpost maincontent articlebody".split())
#: Words of names that tell of a page's layout or state; such a name says nothing of what it holds.
LAYOUT_WORDS = frozenset("has no with without is not layout template open opened closed enabled disabled allowed".split())
_WRAPS = frozenset("wrap wrapper wrapped container".split())
#: Words that add nothing to those beside them.
NEUTRAL_WORDS = _WRAPS | frozenset(
    """area bar block box bottom btn button buttons col column columns div entries first global group header icon icons inner item items last left line link links list message msg
    module new page panel primary region right row secondary section site slot small space sub title top unit view wide big center""".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

#: Phrases of legal lines and notices; each counts against a text of up to ``NOTICE_MOST`` code points, and only so many count.
CUES = re.compile(
    r"©|\bcopyright\b|all rights reserved|(?:use|uses|using|accept|our) cookies|cookie (?:policy|settings|preferences)|privacy policy|terms (?:of (?:use|service)|and conditions)"
    r"|(?:subscribe|sign up) (?:to|for) |\bnewsletter\b|\bsponsored\b|\badvertisement\b",
    re.IGNORECASE,
)
#: What a phrase can't be without.
_CUE_PARTS = ("©", "copyright", "all rights", "cookie", "privacy", "terms ", "subscribe", "sign up", "newsletter", "sponsored", "advertisement")
CUE, CUES_MOST, NOTICE_MOST = 200, 3, 400
#: Costs in units of a hundredth: of what isn't shown, of tags and of names that mark boilerplate, of names that may.
HIDDEN = 5_000
PLAIN_TAG, PLAIN_NAME, PERHAPS, WEAK = 600, 500, 300, 120
#: Evidence of content from a tag, a name, and in sum.
CONTENT_TAG, CONTENT_NAME, CONTENT_MOST = 300, 250, 350
#: Against what a page's content doesn't hold, and where that content is at least half of the prose that no mark speaks against.
ELSEWHERE, FAR_ELSEWHERE = 200, 320
EDGE = 100
#: Share of a page's prose that no boilerplate has, where nothing on the page is marked as content.
MOST_PROSE = 0.6
#: Depth of the DOM beyond which elements count as children of that depth.
DEPTH = 256


def name_evidence(value: str, inside: bool) -> tuple[int, int]:
    """(boilerplate, content): what the names of a class attribute or id tell; ``inside`` of content some tell less."""
    plain = content = 0
    for name in value.split():
        words = {w.lower() for w in _NAME.findall(name)}
        if not words or words & LAYOUT_WORDS:
            continue
        good, bad = words & CONTENT_WORDS, words & PLAIN_WORDS
        if bad and good and words & _WRAPS:
            continue
        if bad:
            known = words <= PLAIN_WORDS | CONTENT_WORDS | NEUTRAL_WORDS | PERHAPS_PLAIN or any(w.isdigit() for w in words)
            plain = max(plain, PLAIN_NAME if known else WEAK)
        elif good:
            content = max(content, CONTENT_NAME if words <= CONTENT_WORDS | NEUTRAL_WORDS else CONTENT_NAME // 2)
        elif words & PERHAPS_PLAIN and not inside:
            plain = max(plain, PERHAPS)
    return plain, content


class _Element:
    """An element: its marks as they are read, and its score once the page is known."""

    __slots__ = ("tag", "parent", "depth", "link", "inside", "hidden", "by_tag", "by_name", "content", "holds", "prose", "score", "marks")

    def __init__(self, tag: str, attrs: str, parent: _Element | None):
        while parent and parent.depth >= DEPTH:
            parent = parent.parent
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.link = tag == "a" or bool(parent and parent.link)
        self.hidden = bool(parent and parent.hidden)
        self.by_tag = self.by_name = self.content = self.prose = self.score = 0
        self.holds, self.marks = False, self
        inside = bool(parent and parent.inside)
        if tag in PLAIN_TAGS or (tag == "header" and not inside):
            self.by_tag = PLAIN_TAG
        if tag in CONTENT_TAGS:
            self.content = CONTENT_TAG
        if attrs and tag not in ("html", "body"):
            self._read(attrs, inside)
        self.inside = inside or (self.content > 0 and self.plain < PERHAPS)

    @property
    def plain(self) -> int:
        return max(self.by_tag, self.by_name)

    def _read(self, attrs: str, inside: bool) -> None:
        for m in _ATTR.finditer(attrs):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name in ("class", "id"):
                if self.tag != "a":
                    plain, content = name_evidence(unescape(value), inside)
                    self.by_name, self.content = max(self.by_name, plain), max(self.content, content)
            elif name == "itemprop":
                if value.lower() == "articlebody":
                    self.content = max(self.content, CONTENT_NAME)
            elif name == "role":
                if value.lower() in PLAIN_ROLES:
                    self.by_tag = PLAIN_TAG
                elif value.lower() in ("main", "article"):
                    self.content = max(self.content, CONTENT_TAG)
            elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE)):
                self.hidden = True


class Run:
    """A node of the graph: the text of a block, or of an inline element in it that is marked by itself."""

    __slots__ = ("element", "n", "linked", "end", "cues")

    def __init__(self, element: _Element, n: int, linked: int, end: str, cues: int):
        self.element, self.n, self.linked, self.end, self.cues = element, n, linked, end, cues


def cues_in(text: str) -> int:
    """Distinct phrases of notices in a short text."""
    if len(text) > NOTICE_MOST:
        return 0
    low = text.lower()
    return len({m[0] for m in CUES.finditer(low)}) if any(part in low for part in _CUE_PARTS) else 0


class Page:
    """A page's blocks, each a list of (node, text) in order, and the nodes."""

    def __init__(self, html: str):
        self.root = _Element("#root", "", None)
        self.elements, self.blocks, self.runs = [self.root], [], []
        self._parts: list[tuple[str, _Element]] = []
        self._read(html)
        self._weigh()

    def _flush(self, holder: _Element) -> None:
        parts, self._parts = self._parts, []
        if not any(t.strip() for t, _ in parts):
            return
        gathered: dict[int, list] = {}
        block = []
        for text, element in parts:
            text = unescape(text) if "&" in text else text
            marked = holder
            while element is not holder and element.tag not in BLOCK and element.parent:
                if element.hidden or (element.plain >= PERHAPS and element.tag != "a"):
                    marked = element  # the outermost that is marked
                element = element.parent
            own = gathered.setdefault(id(marked), [marked, len(self.runs) + len(gathered), [], 0])
            block.append((own[1], text))
            own[2].append(text)
        for (_, element), (at, text) in zip(parts, block, strict=True):
            if element.link:
                next(g for g in gathered.values() if g[1] == at)[3] += len(text.strip())
        for marked, _, texts, linked in gathered.values():
            whole = " ".join("".join(texts).split())
            marked.prose += max(len(whole) - linked, 0)
            self.runs.append(Run(marked, len(whole), linked, whole[-1:], cues_in(whole)))
        self.blocks.append(block)

    def _read(self, html: str) -> None:
        stack, open_tags, quotes = [self.root], Counter(), True

        def close(at: int) -> None:
            for e in stack[at:]:
                open_tags[e.tag] -= 1
            del stack[at:]

        def flush() -> None:
            self._flush(next((e for e in reversed(stack) if e.tag in BLOCK), self.root))

        at, end = 0, len(html)
        while at < end:
            m = _OPENS.search(html, at)
            if not m:
                break
            start = m.start()
            if start > at:
                self._parts.append((html[at:start], stack[-1]))
            if m[0] == "<!--":
                over = html.find("-->", m.end())
                at = over + 3 if over >= 0 else end
                continue
            over = html.find(">", m.end())
            if over < 0:  # no tag ends from here on
                at = start
                break
            if m[0] in ("<!", "<?"):
                at = over + 1
                continue
            t = _TAG.match(html, start)
            tag, attrs = t[2].lower(), ""
            q = _QUOTED.match(html, t.end()) if quotes else None
            quotes = quotes and q is not None  # quotes that never end: from here on they are letters
            at = q.end() if q else over + 1
            attrs = html[t.end() : at - 1]
            if tag in SKIPPED and not t[1]:
                if not (attrs.endswith("/") and tag in ("svg", "math")):
                    closed = _end_of(tag).search(html, at)
                    at = closed.end() if closed else end
                self._parts.append((" ", stack[-1]))
                continue
            if tag == "br":
                self._parts.append((" ", stack[-1]))
                continue
            if tag in BLOCK:
                flush()
            if t[1]:
                if open_tags[tag] > 0:
                    for i in range(len(stack) - 1, 0, -1):
                        if stack[i].tag == tag:
                            close(i)
                            break
                        if tag not in BLOCK and stack[i].tag in BLOCK:
                            break  # an inline end tag doesn't end a block
                continue
            if tag in _CLOSES_P and open_tags["p"] > 0:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == "p":
                        close(i)
                        break
                    if stack[i].tag in BLOCK:
                        break
            if tag in _CLOSES:
                what, until = _CLOSES[tag]
                for i in range(len(stack) - 1, 0, -1) if any(open_tags[x] > 0 for x in what) else ():
                    if stack[i].tag in until:
                        break
                    if stack[i].tag in what:
                        close(i)
                        if tag != "tr":
                            break
            if tag not in VOID:
                stack.append(_Element(tag, attrs, stack[-1]))
                self.elements.append(stack[-1])
                open_tags[tag] += 1
        if at < end:
            self._parts.append((html[at:], stack[-1]))
        flush()

    def _weigh(self) -> None:
        """Scores of elements from the root down: evidence of content above 0, of boilerplate below."""
        for e in reversed(self.elements):
            if e.parent:
                e.parent.prose += e.prose
        free = [e for e in self.elements if e.content and e.plain < PERHAPS and not e.hidden and e.prose]
        tagged = [e for e in free if e.content >= CONTENT_TAG] or free
        main = max(tagged, key=lambda e: e.prose, default=None)
        self.has_content = main is not None
        up = main
        while up:
            up.holds = True
            up = up.parent
        for e in self.elements[1:]:
            base = e.parent.score
            spared = e.holds if self.has_content else e.prose >= MOST_PROSE * self.root.prose
            by_tag = 0 if spared and e.tag in ("form", "header") else e.by_tag
            plain = max(by_tag, 0 if spared else e.by_name)
            if plain >= PERHAPS:
                e.score = max(min(base, 0) - plain, -2 * PLAIN_TAG)
            else:
                e.score = base - plain
                if e.content:
                    e.score = min(e.score + (e.content if base >= 0 else e.content // 4), CONTENT_MOST)
            if e.score == e.parent.score and e.hidden == e.parent.hidden:
                e.marks = e.parent.marks  # the outermost of one score speaks for all in it
        unmarked = sum(r.n - r.linked for r in self.runs if not r.element.hidden and r.element.score >= 0)
        self.elsewhere = 0 if main is None else FAR_ELSEWHERE if 2 * main.prose >= unmarked else ELSEWHERE


_ends: dict[str, re.Pattern] = {}


def _end_of(tag: str) -> re.Pattern:
    if tag not in _ends:
        _ends[tag] = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE)
    return _ends[tag]


def cost(run: Run) -> int:
    """Of a text by itself: above 0 it looks like content, below like boilerplate; in hundredths."""
    e = run.element
    share = min(run.linked / max(run.n, 1), 1.0)
    total = -30 + min(run.n, 200) - int(250 * share) - CUE * min(run.cues, CUES_MOST)
    if e.tag in _HEADINGS:
        total += 60
    if e.tag == "li" and share > 0.5:
        total -= 100
    if run.end and run.end in ".!?:;\"'»”…)":
        total += 60
    return total


def marks_cost(e: _Element, elsewhere: int) -> int:
    """What the marks of an element tell of each text in it; ``elsewhere`` counts where the page names its content and this isn't it."""
    return -HIDDEN if e.hidden else e.score - (elsewhere if e.score <= 0 else 0)


def graph(page: Page) -> tuple[list[int], dict[tuple[int, int], int]]:
    """Costs of all texts and then of the elements that mark them, and the edges between these nodes."""
    costs, edges = [cost(r) for r in page.runs], edges_of(page.runs)
    held: dict[int, tuple[_Element, list[int]]] = {}
    for i, r in enumerate(page.runs):
        held.setdefault(id(r.element.marks), (r.element.marks, []))[1].append(i)
    for e, texts in held.values():
        each = marks_cost(e, page.elsewhere)
        edges.update({(i, len(costs)): abs(each) for i in texts if each})
        costs.append(each * len(texts))
    return costs, edges


def _common(a: _Element, b: _Element) -> float:
    """Share of the longer path to the root that two elements have in common."""
    longest = max(a.depth, b.depth, 1)
    while a.depth > b.depth:
        a = a.parent
    while b.depth > a.depth:
        b = b.parent
    while a is not b:
        a, b = a.parent, b.parent
    return a.depth / longest


def edges_of(found: list[Run]) -> dict[tuple[int, int], int]:
    """Capacities between nodes that follow each other, and between neighbours of one parent."""
    edges: dict[tuple[int, int], int] = {}
    last: dict[int, int] = {}
    for i, b in enumerate(found):
        if i:
            edges[i - 1, i] = int(EDGE * (0.2 + _common(found[i - 1].element, b.element)))
        parent = id(b.element.parent or b.element)
        j = last.get(parent)
        if j is not None:
            edges[j, i] = edges.get((j, i), 0) + EDGE // 2
        last[parent] = i
    return edges


def min_cut(costs: list[int], edges: dict[tuple[int, int], int]) -> list[bool]:
    """The labelling of least cost: -cost of each block labelled content, plus the edges between labels.

    costs[i] > 0 is the capacity from the source to i, costs[i] < 0 that from i to
    the sink. Of equal cuts, the one with the fewest blocks of content among those
    that the edges decide.
    """
    n = len(costs)
    near: list[dict[int, int]] = [{} for _ in range(n)]
    for (i, j), c in edges.items():
        near[i][j] = near[i].get(j, 0) + c
        near[j][i] = near[j].get(i, 0) + c
    left, label = list(costs), [None] * n
    todo = deque(range(n))
    while todo:  # blocks that their own cost decides
        i = todo.popleft()
        if label[i] is None and abs(left[i]) >= sum(near[i].values()):
            label[i] = left[i] > 0
            for j, c in near[i].items():
                del near[j][i]
                if label[j] is None:
                    left[j] += c if label[i] else -c
                    todo.append(j)
            near[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        reach = _source_side(rest, left, near)
        for i in rest:
            label[i] = i in reach
    return label


def _source_side(nodes: list[int], costs: list[int], near: list[dict[int, int]]) -> set[int]:
    """Nodes on the source's side of a minimum cut, by Dinic's maximum flow."""
    source, sink = -1, -2
    room: dict[int, dict[int, int]] = {i: {j: c for j, c in near[i].items()} for i in nodes}
    room[source], room[sink] = {}, {}
    for i in nodes:
        if costs[i] > 0:
            room[source][i], room[i][source] = costs[i], 0
        elif costs[i] < 0:
            room[i][sink], room[sink][i] = -costs[i], 0
    while True:
        level, todo = {source: 0}, deque([source])
        while todo:
            u = todo.popleft()
            for v, c in room[u].items():
                if c > 0 and v not in level:
                    level[v] = level[u] + 1
                    todo.append(v)
        if sink not in level:
            return set(level) - {source}
        open_edges = {u: [v for v in room[u] if level.get(v, 0) == level[u] + 1] for u in level}
        path = [source]
        while path:
            u = path[-1]
            if u == sink:
                flow = min(room[a][b] for a, b in zip(path, path[1:], strict=False))
                for a, b in zip(path, path[1:], strict=False):
                    room[a][b] -= flow
                    room[b][a] = room[b].get(a, 0) + flow
                path = [source]
                continue
            ways = open_edges[u]
            while ways and room[u][ways[-1]] <= 0:
                ways.pop()
            if ways:
                path.append(ways[-1])
            else:
                path.pop()
                if path:
                    open_edges[path[-1]].pop()


def main_text(html: str | None) -> str:
    """The page's content blocks, joined by line feeds."""
    page = Page(html or "")
    labels = min_cut(*graph(page))
    kept = (" ".join("".join(t for i, t in block if labels[i]).split()) for block in page.blocks)
    return "\n".join(t for t in kept if t)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        html = batch.column(batch.num_columns - 1)
        texts = [main_text(html[i].as_py()) for i in range(len(html))]
        columns = [batch.column(i) for i in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[*batch.schema.names[:-1], "text", "n_chars"])


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """The columns ``keep`` of each page, its main text and n_chars (code points)."""
    rows = pages.select(*keep, F.col(html_col).cast("string").alias("_html"))
    schema = ", ".join([*(f"`{n}` {t}" for n, t in pages.select(*keep).dtypes), "text string", "n_chars bigint"])
    return rows.mapInArrow(_texts, schema)


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
