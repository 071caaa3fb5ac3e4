"""HTML extraction by consensus host paths.

A page is read once, tolerantly, into blocks of text, each with the path of its containers: tags with their classes,
numbers in class names generalised, ids left out. Boilerplate subtrees (navigation, headers, footers, sidebars,
notices, adverts, forms, scripts, comments) are recognised by tag, role or class and belong to no container. A class or
id is no proof: one that covers a headline, article or main part and more text than the rest of the page doesn't count,
and no name counts on a page whose text lies below names only. Every
container gets a score: the plain text directly in its blocks counts fully, that of nested containers by half per
level, text in links counts against it. The best container then climbs to what holds the rest of its article: the
outermost article around it, else main; a main with text of its own outside the article; without either, an ancestor
with text of its own (the body only with a headline of its own) or with other sections beside the best one. A page
votes for the path it has climbed to; votes are summed per host in Spark. In a second step every page is extracted
again with its host's winning path; a page without that path, or without text below it, uses its own best container.

The text of a block has its character references decoded and white space turned into single blanks; blocks are joined
in page order by blank lines. A line break inside a block is white space.

Defined results: null, empty and markup-free html work as pages without containers (their text, if any, is the body's
text); a null url or host counts as one host of its own; votes tie towards the larger score, then the smaller path; a
page id may repeat, every row gives a row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiostar.llm.common import small_batches
from regiostar.llm.url_templates import host_of
from regiostar.session import materialize

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(?P<raw>script|style|textarea|title|xmp|iframe|noembed|noframes)\b[^>]*>.*?(?:</(?P=raw)\b[^>]*>|\Z)"
    r"""|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)"""
    r"|<(?P<end2>/?)(?P<tag2>[a-z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.I | re.S,
)
ATTRIBUTE = re.compile(r"""([a-z][\w:-]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
SPACE = re.compile(r"\s+")

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("article body center div main section table tbody td tr".split())
CLOSES_P = BLOCK - {"option", "optgroup", "td", "th", "tr", "tbody", "thead", "tfoot", "body", "html"}
SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th"}, "tfoot": {"tbody", "thead", "tr", "td", "th"},
}
SCOPES = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"},
          "option": {"select"}, "tbody": {"table"}, "tfoot": {"table"}}
SKIPPED = frozenset(
    "head nav header footer aside form script style noscript template iframe button select textarea input label svg math canvas object "
    "embed audio video map dialog menu".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Names that mark boilerplate as whole words of a class or id.
NAMES = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adverts?|adsense|sponsor\w*|promo\w*|banner|sidebar|side-?bar|widget|nav|navbar|navigation|menu|"
    r"breadcrumbs?|header|footer|masthead|cookies?|consent|gdpr|notice|notification|alert|popup|modal|overlay|newsletter|subscri\w*|"
    r"signup|login|share|sharing|social|related|recommend\w*|comments?|commentlist|disqus|respond|repl(?:y|ies)|discussion|pagination|"
    r"pager|toolbar|skip-?link|copyright|legal|disclaimer|byline-?links|tags?|tagcloud)(?:$|[\s_\d-])", re.I,
)
#: Below this a text no longer moves a container's score.
LEAST_SHARE = 2.0**-60
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, a, b, c in ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), unescape(a or b or c))
    return found


class Element:
    """``path`` is a number of the page's paths; ``named`` is the nearest element, itself included, that a name marks as boilerplate."""

    __slots__ = ("tag", "step", "skipped", "link", "path", "parent", "named")

    def __init__(self, tag: str, step: str, skipped: bool, link: bool, path: int, parent: int, named: int):
        self.tag, self.step, self.skipped, self.link, self.path, self.parent, self.named = tag, step, skipped, link, path, parent, named


class Paths:
    """The distinct paths of a page as pairs of parent path and last step, so that memory grows with elements, not with depth."""

    def __init__(self):
        self.steps: list[tuple[int, str]] = [(-1, "")]
        self.lengths = [0]
        self.numbers: dict[tuple[int, str], int] = {}

    def below(self, parent: int, step: str) -> int:
        found = self.numbers.get((parent, step))
        if found is None:
            found = self.numbers[parent, step] = len(self.steps)
            self.steps.append((parent, step))
            self.lengths.append(self.lengths[parent] + len(step) + (parent > 0))
        return found

    def text(self, path: int) -> str:
        steps = []
        while path > 0:
            path, step = self.steps[path]
            steps.append(step)
        return ">".join(reversed(steps))

    def number(self, text: str) -> int:
        """Of a path as text, -1 if the page doesn't have it."""
        return next((i for i, n in enumerate(self.lengths) if n == len(text) and self.text(i) == text), -1)


class Page:
    """Elements in page order (the first stands for the page), their paths, and blocks: element, text, characters inside links."""

    def __init__(self):
        self.paths = Paths()
        self.elements = [Element("body", "", False, False, 0, -1, 0)]
        self.blocks: list[tuple[int, str, int]] = []
        self.plain = 0
        self.under: dict[int, int] = defaultdict(int)  # characters of text below a named element
        self.titled: set[int] = set()  # named elements with a headline, article or main part below them

    def overruled(self) -> set[int]:
        """Named elements whose name can't mean boilerplate.

        Such a one holds more text than the rest of the page, together with a headline, article or main part. Where
        all text of a page lies below names, and none of them is of this kind, no name counts.
        """
        for i in range(len(self.elements) - 1, 0, -1):
            if self.elements[i].named == i and (above := self.elements[self.elements[i].parent].named):
                self.under[above] += self.under[i]
                if i in self.titled:
                    self.titled.add(above)
        total = self.plain + sum(n for i, n in self.under.items() if not self.elements[self.elements[i].parent].named)
        found = {i for i, n in self.under.items() if 2 * n > total and i in self.titled}
        return found or ({*self.under} if not self.plain else set())


def _element(page: Page, tag: str, attrs: str, parent: int, overruled: set[int]) -> Element:
    above, own = page.elements[parent], len(page.elements)
    step, skipped, named = tag, tag in SKIPPED, False
    if attrs and not attrs.isspace() and attrs != "/":
        found = _attributes(attrs)
        classes = sorted(set(re.sub(r"\d+", "#", found.get("class", "").lower()).split()))
        step = ".".join([tag, *classes])
        names = " ".join((found.get("class", ""), found.get("id", "")))
        if tag not in ("html", "body", "article", "main"):
            named = bool(NAMES.search(names))
            skipped = skipped or found.get("role", "").lower() in ROLES
        elif tag == "article":
            skipped = skipped or bool(re.search(r"(?:^|[\s_-])(?:comments?|reply)(?:$|[\s_\d-])", names, re.I))
        skipped = skipped or "hidden" in found or found.get("aria-hidden", "").lower() == "true" or bool(HIDDEN.search(found.get("style", "")))
    path = page.paths.below(above.path, step)
    return Element(tag, step, skipped or above.skipped, tag == "a" or above.link, path, parent, own if named and own not in overruled else above.named)


def parse(html: str) -> Page:
    page = _parsed(html, set())
    overruled = page.overruled() if page.under else None
    return _parsed(html, overruled) if overruled else page


def _parsed(html: str, overruled: set[int]) -> Page:
    page = Page()
    elements, blocks = page.elements, page.blocks
    stack = [0]
    opened: dict[str, int] = defaultdict(int)  # open elements by tag
    pieces: list[str] = []
    linked = [0]

    def flush() -> None:
        if pieces:
            text = SPACE.sub(" ", unescape("".join(pieces))).strip()
            pieces.clear()
            if text:
                blocks.append((owner[0], text, linked[0]))
            linked[0] = 0

    owner = [0]

    def text(raw: str) -> None:
        top = elements[stack[-1]]
        if raw and top.named and not top.skipped:
            page.under[top.named] += len(raw.strip())
        elif raw and not top.skipped:
            page.plain += len(raw.strip())
            if not pieces:
                owner[0] = next(i for i in reversed(stack) if elements[i].tag in BLOCK or i == 0)
            pieces.append(raw)
            if top.link:
                linked[0] += len(raw.strip())

    def close(names: set[str] | frozenset[str], scope: set[str] | frozenset[str]) -> None:
        """Close the nearest open element of these names, if none of the scope's lies above it."""
        if not any(opened[name] for name in names):
            return
        for depth in range(len(stack) - 1, 0, -1):
            tag = elements[stack[depth]].tag
            if tag in names:
                if any(elements[i].tag in BLOCK for i in stack[depth:]):
                    flush()
                for i in stack[depth:]:
                    opened[elements[i].tag] -= 1
                del stack[depth:]
                return
            if tag in scope:
                return

    at = 0
    for m in TOKEN.finditer(html):
        if m.start() > at:
            text(html[at : m.start()])
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        if m["end"] or m["end2"]:
            if tag == "p" and not opened["p"]:
                flush()
            close({tag}, frozenset() if tag in BLOCK else BLOCK)
            continue
        if tag == "br" or tag == "wbr":
            if tag == "br" and pieces:
                pieces.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in ("html", "body") and opened[tag]:
            continue
        if tag in BLOCK:
            flush()
            if tag in CLOSES_P:
                close({"p"}, BLOCK - {"p"})
        if tag in SIBLINGS:
            for _ in range(3):
                before = len(stack)
                close(SIBLINGS[tag], SCOPES[tag])
                if len(stack) == before:
                    break
        attrs = m["attrs"] or m["attrs2"] or ""
        parent = stack[-1]
        element = _element(page, tag, attrs, parent, overruled)
        left_out = element.skipped or element.named
        if left_out and not (elements[parent].skipped or elements[parent].named) and (tag in BLOCK or tag in SKIPPED):
            flush()
        elements.append(element)
        if element.named and not element.skipped and tag in ("h1", "article", "main"):
            page.titled.add(element.named)
        if not attrs.endswith("/") or tag in BLOCK or tag in ("a", "b", "i", "span"):
            stack.append(len(elements) - 1)
            opened[tag] += 1
    text(html[at:])
    flush()
    return page


def container_scores(page: Page) -> dict[int, float]:
    """Score of every container that holds text, by its place among the elements."""
    scores: dict[int, float] = defaultdict(float)
    elements = page.elements
    for place, text, linked in page.blocks:
        worth, share = len(text) - 2.0 * linked, 1.0
        while place > 0 and share > LEAST_SHARE:
            if elements[place].tag in CONTAINERS:
                scores[place] += worth * share
                share /= 2
            place = elements[place].parent
    return scores


def climbed(page: Page, best: int) -> str:
    """Path of the container that holds the rest of the best one's article; the empty path is the page."""
    elements = page.elements
    own: dict[int, float] = defaultdict(float)  # text directly in a container; a headline counts even as a link
    headed: set[int] = set()
    within: dict[tuple[int, int], float] = defaultdict(float)  # text of a section, by the paths of its parent and its own
    for place, text, linked in page.blocks:
        worth, head, direct = len(text) - 2.0 * linked, False, True
        while place >= 0:
            element = elements[place]
            head = head or element.tag == "h1"
            if direct and (element.tag in CONTAINERS or place == 0):
                own[element.path] += len(text) if head else worth
                if head:
                    headed.add(element.path)
                direct = False
            if element.tag == "section":
                within[elements[element.parent].path, element.path] += worth
            place = element.parent
    parts: dict[int, int] = defaultdict(int)
    for (parent, _), worth in within.items():
        parts[parent] += worth > 0
    chosen, at = best, elements[best].parent
    found = {elements[best].tag} & {"article", "main"}
    below = elements[best].tag
    while at >= 0:
        element = elements[at]
        if element.tag == "article":
            take = True
        elif element.tag == "main":
            take = not found or own[element.path] > 0
        elif found:
            take = False
        else:
            take = below == "section" and parts[element.path] > 1
            if element.tag == "body":
                take = take or element.path in headed
            elif element.tag in CONTAINERS:
                take = take or own[element.path] > 0
        if take:
            chosen = at
            found |= {element.tag} & {"article", "main"}
        below, at = element.tag, element.parent
    return page.paths.text(elements[chosen].path)


def best_container(page: Page) -> tuple[str, float] | None:
    """Path and score of the best container, climbed to its article; the path's scores are added, as an article may be cut into like parts."""
    totals: dict[int, float] = defaultdict(float)
    for place, score in container_scores(page).items():
        totals[page.elements[place].path] += score
    if not totals:
        return None
    score = max(totals.values())
    path = min((path for path, x in totals.items() if x == score), key=page.paths.text)
    best = next(i for i, e in enumerate(page.elements) if e.path == path and not e.skipped and not e.named)
    return climbed(page, best), score


def extract(html: str | None, path: str | None) -> str:
    """The text below all containers with this path; without any, below the page's own best, else of the page."""
    if not html:
        return ""
    page = parse(html)
    found = _texts(page, path) if path is not None else []
    if not found:
        own = best_container(page)
        found = _texts(page, own[0]) if own else [t for _, t, _ in page.blocks]
    return "\n\n".join(found)


def _texts(page: Page, path: str) -> list[str]:
    number = page.paths.number(path)
    inside: set[int] = set()
    for i, e in enumerate(page.elements):
        if e.path == number and not e.skipped or e.parent in inside:
            inside.add(i)
    return [t for place, t, _ in page.blocks if place in inside]


def votes(pages: DataFrame) -> DataFrame:
    """host, path, votes, score over all pages of a host; a task adds up its own votes first."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals: dict[tuple[str, str], list[float]] = {}
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                page = html.as_py()
                best = best_container(parse(page)) if page else None
                if best:
                    entry = totals.setdefault((host, best[0]), [0, 0])
                    entry[0] += 1
                    entry[1] += int(best[1])
            keys = list(totals)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                 pa.array([int(totals[k][0]) for k in keys], pa.int64()), pa.array([int(totals[k][1]) for k in keys], pa.int64())],
                ["host", "path", "votes", "score"],
            )

    cast = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(vote, "host string, path string, votes long, score long")
    return cast.groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.sum("score").alias("score"))


def winners(pages: DataFrame) -> DataFrame:
    """host, path: the path with most votes."""
    ranked = F.max_by("path", F.struct("votes", "score", F.hex(F.col("path")).alias("name")))
    return votes(pages).groupBy("host").agg(ranked.alias("winner"))


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, host_path of every page."""
    small_batches(pages.sparkSession)
    chosen = materialize(winners(pages), "host-paths")
    known = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    joined = known.join(chosen, "host", "left").select("page_id", "url", "html", "winner")

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(html.as_py(), path) for html, path in zip(batch.column(2), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), batch.column(3)], ["page_id", "url", "text", "host_path"])

    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, host_path string"
    return joined.mapInArrow(again, schema).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "host_path")
