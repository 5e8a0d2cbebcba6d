"""Main text of web pages by minimum cuts.

A page is cut into blocks of text. A classifier gives each block the cost of calling it
boilerplate and the cost of calling it content, from the elements it stands in, their
names, its links and its text. Blocks that follow each other, the more the nearer they
are in the document tree, and blocks of one parent, are costly to part. The labelling of least total cost is a
minimum cut between a source tied to every block by its content evidence and a sink tied to it
by its boilerplate evidence; it is found by maximum flow, page by page.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict, deque
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from gridpulse.llm.common import col, map_batches

#: Elements that end a line of text (fixed values).
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option optgroup p pre search "
    "section select summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements without content, and elements whose content is no text of the page (fixed values).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset(
    "script style noscript template iframe svg canvas object video audio textarea noframes annotation annotation-xml".split()
)
#: Of these, such as hold elements: if one is not closed, the rest of the page is not its content.
OPEN_ENDED = frozenset("svg canvas object video audio annotation annotation-xml".split())
#: An element is closed by the start of another of its group within the same container.
CLOSED_BY = {
    **dict.fromkeys("p h1 h2 h3 h4 h5 h6".split(), frozenset(["p"])),
    "li": frozenset(["li", "p"]), "dt": frozenset(["dt", "dd", "p"]), "dd": frozenset(["dt", "dd", "p"]),
    "tr": frozenset(["tr", "td", "th", "p"]), "td": frozenset(["td", "th", "p"]), "th": frozenset(["td", "th", "p"]),
    "option": frozenset(["option"]),
    **dict.fromkeys("article aside blockquote div dl fieldset footer form header hr main nav ol pre section table ul".split(), frozenset(["p"])),
}
CONTAINERS = frozenset("article aside body div dl footer form header main nav ol section table td th ul".split())

#: Elements, roles and words of class and id that mark boilerplate, and those that mark content.
BOILER_TAGS = frozenset("nav header footer aside form head title menu button select dialog fieldset search".split())
CONTENT_TAGS = frozenset("article main".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
CONTENT_ROLES = frozenset("main article".split())
BOILER_WORDS = frozenset(
    "ad ads adsbygoogle advert adverts advertisement advertising adsense sponsor sponsored promo promoted promotion banner "
    "cookie cookies consent gdpr notice notices alert popup modal overlay paywall disclaimer "
    "comment comments commentlist discussion disqus respond reply replies "
    "menu nav navbar navigation navi breadcrumb breadcrumbs pagination pager toolbar topbar "
    "sidebar sidebars aside rail widget widgets related recommended recommendations trending popular "
    "header masthead footer footnav copyright colophon "
    "share sharing social follow newsletter subscribe subscription signup login form search skip".split()
)
#: Marks by these hold for articles too; a form or another name may be around the whole page.
FIRM_WORDS = frozenset("comment comments commentlist discussion disqus respond reply replies".split())
#: With one of these a name tells of the surroundings, as in has-comments.
MODIFIERS = frozenset("with without has no is open closed enabled disabled layout wrap wrapper".split())
CONTENT_WORDS = frozenset("article content story entry post main maintext body text prose".split())

#: Evidence in hundredths: of an element's kind, of standing outside the article, of text and links.
KIND, OUTSIDE, INSIDE, LINKS, LONG_TEXT, SHORT_TEXT = 2000, 250, 700, 400, 250, 80
#: Cost of parting neighbours at no distance in the tree, and blocks of one parent.
NEAR, SIBLINGS = 240, 60

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[A-Za-z][^\s/>]*+)(?P<rest2>[^>]*+)>"
    r"|<[!?/][^>]*+(?:>|\Z)"
    r"|<[A-Za-z][^>]*+\Z",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/]|\Z)", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass(slots=True, eq=False)
class Element:
    number: int
    tag: str
    parent: Element | None  # the nearest element around it that ends a line
    depth: int  # how many such are around it
    boiler: bool
    content: bool
    link: bool
    line: bool
    marks: int = 0  # boilerplate marks on the way from the root
    firm: bool = False  # one of them holds for articles too
    lifts: bool = False  # an article or main without a mark of its own, under marks that are not firm
    article: Element | None = None  # the nearest such around it


@dataclass(slots=True, eq=False)
class Block:
    text: str
    link_chars: int
    place: Element


class Open:
    """The elements that are open, the innermost last; where each tag and the containers are among them."""

    def __init__(self, root: Element) -> None:
        self.stack = [root]
        self.places: dict[str, list[int]] = defaultdict(list)
        self.containers: list[int] = []

    def push(self, element: Element) -> None:
        self.places[element.tag].append(len(self.stack))
        if element.tag in CONTAINERS:
            self.containers.append(len(self.stack))
        self.stack.append(element)

    def close(self, first: int) -> None:
        """Close all from a place on."""
        while len(self.stack) > first:
            gone = self.stack.pop()
            self.places[gone.tag].pop()
            if gone.tag in CONTAINERS:
                self.containers.pop()

    def lines_inside(self, first: int) -> bool:
        """Whether an element inside the one at a place ends a line."""
        last, outer = self.stack[-1], self.stack[first]
        return last.depth + last.line > outer.depth + outer.line

    def ended_by(self, tag: str) -> int | None:
        """The place of the element that an end tag closes; none if it was not begun in the same container."""
        if not self.places[tag]:
            return None
        at = self.places[tag][-1]
        return at if tag in CONTAINERS or not self.containers or self.containers[-1] <= at else None

    def outermost(self, tags: frozenset[str]) -> int | None:
        """The first place of one of the tags within the innermost container that is none of them."""
        low = next((i + 1 for i in reversed(self.containers) if self.stack[i].tag not in tags), 1)
        found = [places[k] for t in tags if (places := self.places[t]) and (k := bisect_left(places, low)) < len(places)]
        return min(found, default=None)


def _kind(tag: str, rest: str) -> tuple[bool, bool, bool]:
    """Whether the element itself marks boilerplate, whether it marks content, and whether the first holds for articles in it."""
    boiler, content = tag in BOILER_TAGS and tag != "form", tag in CONTENT_TAGS
    beside, itself, firm = False, False, False
    if rest and not rest.isspace():
        for name, *values in _ATTRIBUTE.findall(rest):
            name, value = name.lower(), "".join(values)
            if name == "role":
                boiler |= value.strip().lower() in BOILER_ROLES
                content |= value.strip().lower() in CONTENT_ROLES
            elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
                boiler = True
            elif name == "style":
                boiler |= bool(_HIDDEN.search(value))
            elif name in ("class", "id"):
                named = _named(value)
                beside, itself, firm = beside | named[0], itself | named[1], firm | named[2]
    # Pages say of a whole body, and of an article that calls itself one, what it has beside it.
    beside &= tag not in ("html", "body") and not (itself and tag in CONTENT_TAGS)
    firm = boiler or (beside and firm)
    boiler |= beside or tag == "form"
    return boiler, (content or itself) and not boiler, firm


def _named(value: str) -> tuple[bool, bool, bool]:
    """Whether one of the names in a class or id marks boilerplate, whether one marks content alone, and whether the first is firm."""
    boiler = content = firm = False
    for name in value.split():
        words = {w.lower() for w in _WORD.findall(name)}
        if words & MODIFIERS:
            words -= BOILER_WORDS
        boiler |= bool(words & BOILER_WORDS)
        content |= bool(words & CONTENT_WORDS) and not words & BOILER_WORDS
        firm |= bool(words & FIRM_WORDS)
    return boiler, content, firm


def _lift(found: list[Block]) -> None:
    """Take the marks around an article that holds most of the page's long text off its blocks; marks inside it stay."""
    total, size, around = 0, defaultdict(int), {}
    for b in found:
        at = b.place if b.place.lifts else b.place.article
        if at and b.text.count(" ") + 1 >= 12:
            size[at.number] += len(b.text)
        total += len(b.text) * (b.text.count(" ") + 1 >= 12)
        while at and at.number not in around:
            around[at.number] = at
            at = at.article
    for n in sorted(around, reverse=True):  # an element has a larger number than those around it
        if up := around[n].article:
            size[up.number] += size[n]
    least: dict[int, int] = {}  # the most marks around a lifted article that is, or is around, this one
    for n in sorted(around):
        up = around[n].article
        least[n] = max(least[up.number] if up else 0, around[n].marks if 2 * size[n] > total else 0)
    for b in found:
        at = b.place if b.place.lifts else b.place.article
        if at and least[at.number]:
            b.place.boiler = b.place.marks > least[at.number]


def blocks(page: str) -> list[Block]:
    """The blocks of text of a page, in order; broken markup is read as far as it goes."""
    opened, number = Open(Element(0, "", None, 0, False, False, False, True)), 0
    stack = opened.stack
    out: list[Block] = []
    unclosed: set[str] = set()
    parts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, linked, stack[-1] if stack[-1].line else stack[-1].parent))
            parts, linked = [], 0

    def say(raw: str) -> None:
        nonlocal linked
        text = unescape(raw) if "&" in raw else raw
        parts.append(text)
        if stack[-1].link:
            linked += len(text.strip())

    at, end = 0, len(page)
    while at < end:
        found = _TOKEN.search(page, at)
        if not found:
            say(page[at:])
            break
        if found.start() > at:
            say(page[at : found.start()])
        at = found.end()
        tag = found["name"] or found["name2"]
        if not tag:
            continue
        tag = tag.lower()
        if found["end"] or found["end2"]:
            if tag in BLOCKS:
                flush()
            ended = opened.ended_by(tag)
            if ended is not None:
                if opened.lines_inside(ended):
                    flush()
                opened.close(ended)
            continue
        rest = found["rest"] or found["rest2"] or ""
        if tag in DROPPED:
            if not rest.endswith("/") or tag in ("script", "style", "textarea"):
                closing = None if tag in unclosed else re.compile(rf"</{re.escape(tag)}\b[^>]*+(?:>|\Z)", re.I).search(page, at)
                if not closing and tag in OPEN_ENDED:
                    unclosed.add(tag)
                else:
                    at = closing.end() if closing else end
            parts.append(" ")
            continue
        if tag in VOID:
            if tag in BLOCKS:
                flush()
            elif tag in ("br", "wbr", "img"):
                parts.append(" " if tag == "br" else "")
            continue
        line = tag in BLOCKS
        if line:
            flush()
            first = opened.outermost(CLOSED_BY[tag]) if tag in CLOSED_BY else None
            if first is not None:
                opened.close(first)
        number += 1
        boiler, content, firm = _kind(tag, rest)
        up = stack[-1]
        here = Element(
            number, tag, up if up.line else up.parent, up.depth + up.line, up.boiler or boiler, up.content or content,
            up.link or tag == "a", line, up.marks + boiler, up.firm or firm,
        )
        opened.push(here)
        here.article = up if up.lifts else up.article
        here.lifts = tag in CONTENT_TAGS and up.boiler and not boiler and not up.firm
    flush()
    _lift(out)
    return out


def evidence(found: list[Block]) -> list[int]:
    """Content evidence less boilerplate evidence of each block."""
    marked = any(b.place.content and not b.place.boiler for b in found)
    out = []
    for b in found:
        words = b.text.count(" ") + 1
        value = LONG_TEXT if words >= 12 else -SHORT_TEXT if words < 4 else 0
        if any(c in b.text for c in ".!?;:") and words >= 5:
            value += SHORT_TEXT
        if 2 * b.link_chars > len(b.text):
            value -= LINKS
        if marked:
            value += INSIDE if b.place.content else -OUTSIDE
        if b.place.boiler:
            value -= KIND
        out.append(value)
    return out


def _distance(a: Element, b: Element) -> int:
    """Steps from one element to the other, by the nearest around both; no more than matter."""
    steps = 0
    while a is not b and steps < NEAR:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def neighbours(found: list[Block]) -> list[tuple[int, int, int]]:
    """(block, later block, cost of parting them)."""
    out, last = [], {}
    for i, b in enumerate(found):
        if i:
            out.append((i - 1, i, NEAR // (1 + _distance(found[i - 1].place, b.place))))
        parent = b.place.parent.number if b.place.parent else -1
        if parent in last and last[parent] < i - 1:
            out.append((last[parent], i, SIBLINGS))
        last[parent] = i
    return out


def minimum_cut(values: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Labels (true: source side) of least cost; of several least ones, the one with the fewest on the source side.

    A node whose own value outweighs all its edges is labelled by it in every minimum
    cut; its edges then count to its neighbours' values. What remains is cut by maximum flow.
    """
    n = len(values)
    around: list[dict[int, int]] = [{} for _ in range(n)]
    for a, b, w in edges:
        if a != b and w > 0:
            around[a][b] = around[a].get(b, 0) + w
            around[b][a] = around[b].get(a, 0) + w
    value, label = list(values), [None] * n
    waiting = deque(range(n))
    while waiting:
        i = waiting.popleft()
        if label[i] is not None or abs(value[i]) <= sum(around[i].values()) and (around[i] or value[i] > 0):
            continue
        label[i] = value[i] > 0
        for j, w in around[i].items():
            value[j] += w if label[i] else -w
            del around[j][i]
            waiting.append(j)
        around[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        inside = _source_side({i: value[i] for i in rest}, {i: around[i] for i in rest})
        for i in rest:
            label[i] = i in inside
    return label


def _source_side(value: dict[int, int], around: dict[int, dict[int, int]]) -> set[int]:
    """Nodes that the source still reaches after a maximum flow by shortest augmenting paths."""
    source, sink = -1, -2
    room: dict[int, dict[int, int]] = {i: dict(near) for i, near in around.items()}
    room[source], room[sink] = {}, {}
    for i, v in value.items():
        a, b = (source, i) if v > 0 else (i, sink)
        room[a][b] = abs(v)
        room[b].setdefault(a, 0)
    while True:
        level, queue = {source: 0}, deque([source])
        while queue:
            i = queue.popleft()
            for j, r in room[i].items():
                if r > 0 and j not in level:
                    level[j] = level[i] + 1
                    queue.append(j)
        if sink not in level:
            return set(level) - {source}
        nexts = {i: list(room[i]) for i in level}
        path = [source]
        while path:
            i = path[-1]
            if i == sink:
                least = min(room[a][b] for a, b in zip(path, path[1:]))
                for a, b in zip(path, path[1:]):
                    room[a][b] -= least
                    room[b][a] = room[b].get(a, 0) + least
                path = [source]
                continue
            while nexts[i] and not (room[i][nexts[i][-1]] > 0 and level.get(nexts[i][-1]) == level[i] + 1):
                nexts[i].pop()
            if nexts[i]:
                path.append(nexts[i][-1])
            else:
                path.pop()
                if path:
                    nexts[path[-1]].pop()


def main_text(page: str) -> str:
    """Content blocks in page order, joined by line ends; empty if there are none."""
    found = blocks(page)
    labels = minimum_cut(evidence(found), neighbours(found))
    return "\n".join(b.text for b, kept in zip(found, labels) if kept)


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every row, from its whole html; a null html is empty and gives an empty text.

    Rows are read one by one, so null ids and urls, ties and repeats have no effect, and a
    task holds one batch of pages; no rows give none. A page takes time and memory in proportion
    to its length, however deep its elements are or how many are left open.
    """
    kind = pages.schema[id_col].dataType.simpleString()

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(h or "") for h in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["id", "url", "text", "n_chars"],
        )

    rows = pages.select(col(id_col).alias("id"), col(url_col).cast("string").alias("url"), col(html_col).cast("string").alias("html"))
    return map_batches(rows, each, f"id {kind}, url string, text string, n_chars long")
