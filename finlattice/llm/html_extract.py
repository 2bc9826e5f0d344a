"""HTML main-text extraction with consensus host paths.

Each page's containers are scored by the text in them that is neither boilerplate nor link text; the page's best one is
described by its generalised path (tags with classes, digits made alike). In Spark the paths of a host's pages are
voted on, weighted by that text, and every page is extracted again by its host's winning path. A page that
has no text there, or little beside its own best container, falls back to that.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, pieces

# Fixed word lists of the extraction.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
BOILER_TAGS = frozenset("nav header footer aside form script style noscript template iframe textarea title button select option svg canvas menu dialog object head datalist fieldset label".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption legend".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINER = frozenset("article body div main section td".split())
BOILER_WORDS = frozenset(
    "nav navbar navigation menu header masthead topbar footer sidebar aside ad ads advert adverts advertisement advertising adbox adsense banner promo promotion sponsor sponsored cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login social share sharing related recommended recommendations comment comments commentlist reply replies respond disqus breadcrumb breadcrumbs pagination pager toolbar widget widgets search skip copyright disclaimer hidden".split()
)
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar toolbar form".split())
KEPT_TAGS = frozenset("html body main article".split())
#: Tags that stay condemned whatever they hold, tags whose text is none at all, and what shows where the article is.
NEVER = BOILER_TAGS - frozenset("form fieldset label object".split())
NO_TEXT = frozenset("script style noscript template iframe textarea title select option svg canvas head datalist".split())
SIGNS = frozenset("h1 article main".split())
#: Words that often tell how a wrapper is laid out, and not what it holds.
LAYOUT_WORDS = frozenset("nav navbar menu header masthead topbar footer sidebar aside toolbar widget widgets search skip social share sharing hidden overlay modal ad ads promo related notice signup login".split())
#: Elements of running text: inside the article a class word alone doesn't condemn them.
TEXT_TAGS = frozenset("p h2 h3 h4 h5 h6 blockquote ul ol dl table pre figure span em strong b i".split())
#: What heads an entry of a thread: who wrote it, and when.
HEAD_TAGS, HEAD_WORDS = frozenset(("time", "cite")), frozenset("author user username nick nickname name avatar date time datetime timestamp byline posted poster meta by".split())
#: What ends by implication: kind -> (tags that end, tags that bound the search).
SCOPES = {
    "p": ({"p"}, {"table", "button"}), "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}
IMPLIES = {"li": "li", "dt": "dt", "dd": "dt", "tr": "tr", "td": "td", "th": "td", "option": "option"}
SCOPED: dict[str, list[tuple[str, bool]]] = {}
for _kind, (_ends, _bounds) in SCOPES.items():
    for _tag in _ends | _bounds:
        SCOPED.setdefault(_tag, []).append((_kind, _tag in _bounds))

_TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>"']+|"[^"]*"|'[^']*')*+)>|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^<>]*)>""", re.S)
_ATTR = re.compile(r"""([A-Za-z_:][\w:.-]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
#: Characters outside the host's path that make it doubtful; less is a line or two beside a short article.
ARTICLE = 200
_NUMBERED = re.compile(r"[-_]*#+(?=\.|$)")
_DIGITS = re.compile(r"\d+")
_PART = re.compile(r"[-_\s]+")


@dataclass(slots=True)
class Node:
    tag: str
    #: Tag with classes, digits made alike: a step of the path.
    step: str
    parent: int
    #: 0, or condemned: 1 by a layout word, 2 by another word, role or attribute, 3 by its tag for good.
    bad: int
    #: Condemned by a class word only, as an element of running text.
    weak: bool = False
    #: Names an author or a time.
    head: bool = False
    #: Condemned itself or below such an element.
    boiler: bool = False
    chars: int = 0


@dataclass(slots=True)
class Page:
    nodes: list[Node] = field(default_factory=list)
    #: Runs of text: (node, block number, text, in a link).
    runs: list[tuple[int, int, str, bool]] = field(default_factory=list)

    def path(self, i: int) -> str:
        steps = []
        while i > 0:
            steps.append(self.nodes[i].step)
            i = self.nodes[i].parent
        return "".join(reversed(steps))


def _condemned(tag: str, attrs: dict[str, str]) -> int:
    if tag in BOILER_TAGS:
        return 3 if tag in NEVER else 1
    if tag in KEPT_TAGS:
        return 0
    if attrs.get("role", "").lower() in BOILER_ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attrs.get("style", "")):
        return 2
    found = 0
    for name in (*attrs.get("class", "").split(), attrs.get("id", "")) if tag != "h1" else ():
        words = [w for w in _PART.split(name.lower()) if w]
        for i, w in enumerate(words):
            if w in BOILER_WORDS and not (i and words[i - 1] in ("has", "with", "no", "without")):
                found = max(found, 1 if w in LAYOUT_WORDS else 2)
    return found


class _Open:
    """The open elements, and how many of a kind are open within their scope, which tells without a search whether a tag ends one."""

    def __init__(self, nodes: list[Node]) -> None:
        self.nodes, self.stack, self.links = nodes, [0], 0
        self.tags: dict[str, int] = {}
        self.scopes = {kind: [0] for kind in SCOPES}

    def push(self, i: int) -> None:
        tag = self.nodes[i].tag
        self.stack.append(i)
        self.links += tag == "a"
        self.tags[tag] = self.tags.get(tag, 0) + 1
        for kind, bounds in SCOPED.get(tag, ()):
            if bounds:
                self.scopes[kind].append(0)
            else:
                self.scopes[kind][-1] += 1

    def pop(self, to: int) -> None:
        for i in reversed(self.stack[to:]):
            tag = self.nodes[i].tag
            self.links -= tag == "a"
            self.tags[tag] -= 1
            for kind, bounds in SCOPED.get(tag, ()):
                if bounds:
                    self.scopes[kind].pop()
                else:
                    self.scopes[kind][-1] -= 1
        del self.stack[to:]

    def end(self, tags: set[str]) -> None:
        """The innermost open element of these tags ends, with all that is open in it."""
        self.pop(next(d for d in range(len(self.stack) - 1, 0, -1) if self.nodes[self.stack[d]].tag in tags))


def parse(source: str) -> Page:
    """Elements and text runs of a page; unclosed and stray tags are taken as browsers do, roughly. Takes time in proportion to the source."""
    page = Page([Node("", "", -1, 0)])
    now, block, at = _Open(page.nodes), 0, 0

    def text(raw: str) -> None:
        if raw:
            page.runs.append((now.stack[-1], block, html.unescape(raw) if "&" in raw else raw, now.links > 0))

    while (m := _TOKEN.search(source, at)) is not None:
        text(source[at : m.start()])
        at = m.end()
        if m[0].startswith("<![CDATA["):
            text(html.escape(m[0][9:].removesuffix("]]>")))
            continue
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if tag in BLOCK:
            block += 1
        if m[1] or m[4]:
            if now.tags.get(tag):
                now.end({tag})
            continue
        if tag in VOID:
            if tag == "br":
                text(" ")
            continue
        for kind in (*(("p",) if tag in BLOCK else ()), *((IMPLIES[tag],) if tag in IMPLIES else ())):
            if now.scopes[kind][-1]:
                now.end(SCOPES[kind][0])
        given = m[3] or m[6] or ""
        attrs = {a.lower(): b or c or d or "" for a, b, c, d in _ATTR.findall(given)} if given.strip(" /") else {}
        classes = ".".join(sorted(_DIGITS.sub("#", c.lower()) for c in attrs.get("class", "").replace(">", "#").split()))
        bad = _condemned(tag, attrs)
        weak = bad > 0 and tag in TEXT_TAGS and not _condemned(tag, {k: v for k, v in attrs.items() if k not in ("class", "id")})
        head = tag in HEAD_TAGS or not HEAD_WORDS.isdisjoint(_PART.split(f"{attrs.get('class', '')} {attrs.get('itemprop', '')}".lower()))
        page.nodes.append(Node(tag, f">{tag}.{classes}" if classes else f">{tag}", now.stack[-1], bad, weak, head))
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(source, at)
            at = end.end() if end else len(source)
            continue
        if given.rstrip().endswith("/") and tag not in BLOCK:
            continue
        now.push(len(page.nodes) - 1)
    text(source[at:])
    _acquit_text(page)
    _judge(page)
    _condemn_threads(page)
    return page


def _acquit_text(page: Page) -> None:
    """Acquits elements of running text that only a class word condemned, inside article or main or the smallest container with over half of the page's text.

    They need a second sign to stay condemned: mostly links, or neither a heading nor a sentence (a label such as an advert's).
    """
    nodes, n = page.nodes, len(page.nodes)
    if not any(x.weak for x in nodes):
        return
    size, links, none = [0] * n, [0] * n, bytearray(n)
    last: dict[int, str] = {}
    for i in range(1, n):
        none[i] = none[nodes[i].parent] or nodes[i].tag in NO_TEXT
    for i, _, text, link in page.runs:
        if not none[i] and (t := text.strip()):
            (links if link else size)[i] += len(t)
            j = i
            while j > 0 and not nodes[j].weak:
                j = nodes[j].parent
            if j > 0 and not link and (t[-1] in ".!?…:;\"”»" or ". " in t):
                last[j] = t
    for i in range(n - 1, 0, -1):
        size[nodes[i].parent] += size[i]
        links[nodes[i].parent] += links[i]
    at = max((i for i in range(n) if nodes[i].tag in CONTAINER and nodes[i].tag != "body" and 2 * size[i] > size[0]), default=0)
    inside = bytearray(n)
    for i in range(1, n):
        inside[i] = inside[nodes[i].parent] or i == at or nodes[i].tag in ("article", "main")
        if nodes[i].weak and inside[i] and size[i] > links[i] and (nodes[i].tag in HEADING or i in last or size[i] >= 60):
            nodes[i].bad = 0


def _condemn_threads(page: Page) -> None:
    """Condemns threads of readers' entries whatever their class: alike siblings, each with an author or a time, after the article and smaller than it."""
    nodes, n = page.nodes, len(page.nodes)
    own, before = [0] * n, [0] * n
    seen = 0
    heads = [x.head for x in nodes]
    entered = bytearray(n)
    for i, _, text, link in page.runs:
        j = i
        while j > 0 and not entered[j]:
            entered[j], before[j] = 1, seen
            j = nodes[j].parent
        if not nodes[i].boiler and not link:
            seen += len(text.strip())
            own[i] += len(text.strip())
    for i in range(n - 1, 0, -1):
        own[nodes[i].parent] += own[i]
        heads[nodes[i].parent] |= heads[i]
    alike: dict[tuple[int, str], list[int]] = {}
    for i in range(1, n):
        if nodes[i].tag in ("div", "li", "article", "section", "tr", "blockquote", "dd") and own[i] and not nodes[i].boiler:
            alike.setdefault((nodes[i].parent, nodes[i].step), []).append(i)
    bad = bytearray(n)
    for (up, _), entries in alike.items():
        if len(entries) < 2 or up == 0 or nodes[up].tag in KEPT_TAGS or not all(heads[i] for i in entries):
            continue
        text = sum(own[i] for i in entries)
        # nearly all of the container, and over half of the page's text before it
        if 5 * text >= 4 * own[up] and 2 * before[up] > seen:
            bad[up] = 1
    for i in range(1, n):
        bad[i] |= bad[nodes[i].parent]
        nodes[i].boiler |= bool(bad[i])


def _judge(page: Page) -> None:
    """Acquits condemned elements that hold the article all the same, and marks the others and what is below them.

    A word such as sidebar may tell how a wrapper is laid out, and a form may span a page. Down the chain of elements with over
    half of the page's text, a condemned one is acquitted if a headline, article or main is in it and none outside, or, unless its
    word names what it holds (comments, cookies), if the text outside is under a sixteenth of its own. If the
    page has no text left then, elements condemned by layout words only are acquitted, outermost first.
    """
    nodes = page.nodes
    n = len(nodes)
    size, signs, heavy, none = [0] * n, [0] * n, [0] * n, bytearray(n)
    for i in range(1, n):
        none[i] = none[nodes[i].parent] or nodes[i].tag in NO_TEXT
    for i, _, text, link in page.runs:
        if not none[i] and not link:
            size[i] += len(text.strip())
    free, deep, deep_signs = size[:], size[:], [0] * n  # not below a condemned element; the same, but for elements with over half of the text
    total = sum(size)
    for i in range(n - 1, 0, -1):
        up = nodes[i].parent
        signs[i] += nodes[i].tag in SIGNS
        deep_signs[i] += nodes[i].tag in SIGNS
        size[up] += size[i]
        if 2 * size[i] > total:
            heavy[up] = i
        if not nodes[i].bad:
            free[up] += free[i]
            signs[up] += signs[i]
        if not nodes[i].bad or heavy[up] == i and nodes[i].bad < 3:
            deep[up] += deep[i]
            deep_signs[up] += deep_signs[i]
    outside, outside_signs, at = free[0], signs[0], heavy[0]
    while at:
        bad = nodes[at].bad
        if bad:
            if bad == 3 or not (deep_signs[at] and not outside_signs or bad == 1 and deep[at] > 16 * outside):
                break
            nodes[at].bad = 0
            outside, outside_signs = outside + free[at], outside_signs + signs[at]
        at = heavy[at]
    lit = bytearray(n)  # below an element that was acquitted here and has text
    for i in range(1, n):
        node, up = nodes[i], nodes[i].parent
        lit[i] = lit[up]
        if node.bad == 1 and not outside and size[i] and not lit[i] and not nodes[up].boiler:
            node.bad, lit[i] = 0, free[i] > 0
        node.boiler = nodes[up].boiler or node.bad > 0


def best_container(page: Page) -> tuple[int, int]:
    """The article or main with over half of the page's content, else the smallest container of nearly all of it; and its content's size.

    Without article or main a step down leaves only containers without headings behind, which hold a sixteenth of the page's content at most.
    """
    total = 0
    for i, _, text, link in page.runs:
        if not page.nodes[i].boiler and not link:
            page.nodes[i].chars += (n := len(text.strip()))
            total += n
    for i in range(len(page.nodes) - 1, 0, -1):
        page.nodes[page.nodes[i].parent].chars += page.nodes[i].chars
    best = 0
    for i, node in enumerate(page.nodes):  # children come after their parents
        if node.tag in CONTAINER and 2 * node.chars > total:
            best = i
    i = best
    while i > 0:
        if page.nodes[i].tag in ("article", "main"):
            return i, page.nodes[i].chars
        i = page.nodes[i].parent
    near, titled = [0] * len(page.nodes), [False] * len(page.nodes)  # the container a node is in; whether it is in a heading
    for i in range(1, len(page.nodes)):
        node = page.nodes[i]
        near[i] = i if node.tag in CONTAINER else near[node.parent]
        titled[i] = titled[node.parent] or node.tag in HEADING
    own, heads = [0] * len(page.nodes), [0] * len(page.nodes)
    for i, _, text, link in page.runs:
        if not page.nodes[i].boiler and not link:
            n = len(text.strip())
            own[near[i]] += n
            heads[i] += n * titled[i]
    for i in range(len(page.nodes) - 1, 0, -1):
        heads[page.nodes[i].parent] += heads[i]
    best = 0
    for i in range(1, len(page.nodes)):
        if total and page.nodes[i].tag in CONTAINER and 16 * page.nodes[i].chars >= 15 * total:
            if own[best] or heads[i] < heads[best]:
                break
            best = i
    return best, page.nodes[best].chars


def main_text(page: Page, roots: set[int]) -> str:
    """The text below the roots without boilerplate: white space in a block as one space, blocks on lines."""
    inside, blocks = [i in roots for i in range(len(page.nodes))], {}
    for i in range(1, len(page.nodes)):
        inside[i] = inside[i] or inside[page.nodes[i].parent]
    for i, block, text, _ in page.runs:
        if inside[i] and not page.nodes[i].boiler:
            blocks.setdefault(block, []).append(text)
    lines = (" ".join("".join(b).split()) for b in blocks.values())
    return "\n".join(x for x in lines if x)


def _at_path(page: Page, path: str) -> set[int]:
    """Elements at a path; its last step's classes may have other numbers, or none. Of several at a path that ends without class, only those with at least half the text of the largest."""
    steps, level, found = [f">{x}" for x in path.split(">")[1:]], [0] * len(page.nodes), []
    end = _NUMBERED.sub("", steps[-1]) if steps else ""
    for i in range(1, len(page.nodes)):
        node = page.nodes[i]
        up = level[node.parent]
        if 0 <= up < len(steps) and not node.boiler and (node.step == steps[up] or up + 1 == len(steps) and _NUMBERED.sub("", node.step) == end):
            level[i] = up + 1
            if up + 1 == len(steps):
                found.append(i)
        else:
            level[i] = -1
    if len(found) > 1 and "." not in steps[-1] and steps[-1][1:] not in ("article", "main"):
        most = max(page.nodes[i].chars for i in found)
        found = [i for i in found if 2 * page.nodes[i].chars >= most]
    return set(found)


def extract(source: str, path: str | None) -> str:
    """The main text of a page by a path, or by its own best container where the path has less than a third of that one's text and ARTICLE characters are missing."""
    page = parse(source)
    best, _ = best_container(page)
    own = main_text(page, {best})
    roots = _at_path(page, path) if path else set()
    text = main_text(page, roots) if roots else ""
    return text if text and (3 * len(text) >= len(own) or len(own) - len(text) < ARTICLE) else own


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches):
        paths, chars = [], []
        for source in b.column("html").to_pylist():
            page = parse(source or "")
            best, n = best_container(page)
            paths.append(page.path(best))
            chars.append(n)
        yield pa.RecordBatch.from_arrays([b.column("host"), pa.array(paths, pa.string()), pa.array(chars, pa.int64())], names=["host", "path", "chars"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in pieces(batches):
        texts = [extract(s or "", p) for s, p in zip(b.column("html").to_pylist(), b.column("path").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def host(url: str = "url") -> F.Column:
    """The lower-case host of a URL, without user and port; empty if it has none."""
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def host_paths(pages: DataFrame) -> DataFrame:
    """``(host, path)``: each host's winning path, by the content of the pages that vote for it (ties: the first path)."""
    votes = pages.select(host().alias("host"), "html").mapInArrow(_votes, "host string, path string, chars long")
    tally = votes.where("chars > 0").groupBy("host", "path").agg(F.sum("chars").alias("chars"))
    return tally.groupBy("host").agg(F.min_by("path", F.struct(-F.col("chars"), "path")).alias("path"))


def extract_pages(pages: DataFrame, broadcast_rows: int = 20_000, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every row of ``pages`` (``page_id``, ``url``, ``html``).

    Null and empty pages, and pages without content, have an empty text. Pages without host vote together. The
    winning paths are broadcast only if they are at most ``broadcast_rows`` and ``broadcast_bytes``; else they are joined by
    a shuffle on the host, whose large hosts AQE splits.
    """
    winners = durable(host_paths(pages), "host_paths")
    n, size = winners.agg(F.count("*"), F.coalesce(F.sum(F.length("host") + F.length("path")), F.lit(0))).first()
    winners = F.broadcast(winners) if n <= broadcast_rows and 4 * size <= broadcast_bytes else winners
    rows = pages.select("page_id", "url", "html", host().alias("host")).join(winners, "host", "left")
    return rows.select(F.col("page_id").cast("long"), "url", "html", "path").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
