"""Main text of web pages by consensus paths of their hosts.

1. Every page's containers are scored: characters of content inside, less twice the characters of
   menus, notices and the like, times a bonus for elements marked as articles. A container is named by
   its path of tags and classes, digits generalised.
2. A page votes for the path of its best container (ties: the innermost, then the first). Votes are
   summed per host and path; the host's winner is its most voted path (ties: the longer, then the
   greater one).
3. Pages are read again. Their text is what the winning path holds, without boilerplate inside; a
   page that has no such container uses its own best one.

Boilerplate are elements of certain tags and elements whose class, id or role has a telling word. A word is
not enough where the element is a wrapper of the page: it holds most of the page's unlinked text, and
no article, main or likewise named element stands beside it. Boilerplate inside a line leaves the line whole:
its own text goes, what stands before and after stays one block.

Defined results: null, empty and tagless html give the text that is there, maybe none; pages without a url
vote as one host; repeated rows stay; an empty table gives no rows; extra columns are ignored.
``<br>`` is white space inside a block; white space is Unicode's.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refillcast.llm.common import as_bytes, bounded, staged
from refillcast.operators.joins import join_hot

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)|<[!?][^>]*+>"
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*+)>""",
    re.S)
_ATTR = re.compile(r"""(class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""\bhidden\b(?!\s*=\s*["']?until)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp noembed noframes".split())
#: Elements that never hold article text.
BOILERPLATE = frozenset(
    "nav footer aside form head script style noscript template svg iframe object select button dialog menu "
    "canvas audio video map datalist".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul caption head".split())
CONTAINERS = frozenset("article blockquote body center div dl html main section table tbody td tr ul ol figure details".split())
#: What an opening tag ends if it is open, and the elements that hide it.
ENDS = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir".split())),
    "dt": (frozenset("dt dd".split()), frozenset(["dl"])),
    "dd": (frozenset("dt dd".split()), frozenset(["dl"])),
    "tr": (frozenset("tr td th".split()), frozenset(["table"])),
    "td": (frozenset("td th".split()), frozenset("table tr".split())),
    "th": (frozenset("td th".split()), frozenset("table tr".split())),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
SCOPE = frozenset("article aside blockquote body button details div dl fieldset figure footer form header html li main nav section table td th ul ol".split())
#: Words in classes, ids and roles of what is not the article.
HINTS = frozenset(
    "sidebar side menu nav navbar navigation breadcrumb breadcrumbs footer masthead "
    "topbar share sharing social related "
    "recommended recommendation newsletter subscribe subscription signup login popup modal overlay widget pagination "
    "pager search toolbar complementary contentinfo skip".split())
#: Of adverts and notices; such an element inside a line is one, too.
ADVERTS = frozenset(
    "ad ads adv advert advertisement advertising adslot sponsor sponsored promo promotion promoted banner cookie cookies "
    "consent gdpr notice notices".split())
#: Of readers' comments, which may be longer than the article.
COMMENTS = frozenset("comment comments commentlist respond reply replies disqus".split())
#: Words that tell boilerplate only outside an article.
OUTSIDE = frozenset("alert discussion".split())
#: A name with one of these says what the page has, not what the element is.
MODIFIERS = frozenset("no has with without".split())
#: Words that mark an article's own parts; a header named so belongs to it.
OWN = frozenset("article entry post content story main body headline".split())
ROOTS = frozenset("html body article main".split())
#: Labels of a path, counted from the container upwards.
DEPTH = 12


class Element:
    __slots__ = ("tag", "parent", "labels", "words", "hint", "boiler", "good", "bad", "mass", "bonus", "within")

    def __init__(self, tag: str, parent: Element | None, label: str, words: frozenset = frozenset(), bonus: float = 1.0):
        self.tag, self.parent, self.words, self.bonus = tag, parent, words, bonus
        # The nearest labels: deep nesting must not make long paths.
        self.labels = (*parent.labels[1 - DEPTH :], label) if parent is not None else ()
        self.within = parent is not None and (parent.within or parent.tag in ("article", "main"))
        # Of the tag alone, a sign in the attributes (its kind), and what ``settle`` makes of them.
        self.hint: str | None = None
        self.boiler = False
        self.good = self.bad = self.mass = 0

    @property
    def path(self) -> str:
        return ">".join(self.labels)

    @property
    def score(self) -> float:
        return (self.good - 2 * self.bad) * self.bonus

    @property
    def marked(self) -> bool:
        """Whether the element is named as the article or as what holds it."""
        return self.tag in ("article", "main") or self.bonus > 1.0


#: A piece of a block: the element it stands in, its source, and whether it is part of a link.
Piece = tuple[Element, str, bool]


def described(tag: str, attrs: str, parent: Element | None) -> Element:
    """The element of an opening tag: its path, and the sign of boilerplate it carries."""
    label, words, hidden = tag, frozenset(), False
    bonus = {"article": 1.5, "main": 1.3}.get(tag, 1.0)
    if attrs:
        found = {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(attrs)}
        if "class" in found:
            names = sorted({re.sub(r"\d+", "#", c) for c in found["class"].split()})
            label = ".".join([tag, *names])
        parts = [{w.lower() for w in _PARTS.findall(name)} for v in found.values() for name in v.split()]
        words = frozenset().union(*(p for p in parts if not p & MODIFIERS))
        hidden = bool(_HIDDEN.search(attrs))
        if found.get("itemprop") == "articleBody" or found.get("role") in ("main", "article"):
            return Element(tag, parent, label, words, 1.5)
    out = Element(tag, parent, label, words, bonus)
    if tag in BOILERPLATE:
        out.hint = "tag"
    elif tag in ROOTS:
        # An article that readers wrote is a comment.
        out.hint = "comment" if tag == "article" and words & COMMENTS else None
    elif hidden:
        out.hint = "hidden"
    elif words & COMMENTS:
        out.hint = "comment"
    elif words & ADVERTS:
        out.hint = "advert"
    elif words & HINTS or not out.within and words & OUTSIDE:
        out.hint = "word"
    elif (tag == "header" or "header" in words) and not (out.within or words & OWN):
        # A header inside an article, or named as one of its parts, holds its headline.
        out.hint = "header"
    elif bonus == 1.0 and tag in CONTAINERS and words & OWN:
        out.bonus = 1.2
    return out


def cleaned(pieces: list[Piece]) -> str:
    return " ".join(entities.unescape("".join(text for _, text, _ in pieces)).split())


def wrappers(elements: list[Element], blocks: list[list[Piece]]) -> set[int]:
    """Places of elements that look like boilerplate by a word (or are a form) but hold the page.

    Such an element holds most of the unlinked text that lies outside comments and boilerplate tags, and
    no element named as an article, and not itself inside something that looks like boilerplate, stands beside it.
    """
    suspects = [i for i, e in enumerate(elements) if e.hint in ("word", "advert", "header") or e.hint == "tag" and e.tag == "form"]
    if not suspects:
        return set()
    # Parents come before their children.
    place = {id(e): i for i, e in enumerate(elements)}
    up = [place[id(e.parent)] if e.parent is not None else -1 for e in elements]
    lost, suspected = [False] * len(elements), [False] * len(elements)
    for i, e in enumerate(elements[1:], 1):
        lost[i] = lost[up[i]] or e.hint in ("comment", "hidden") or e.hint == "tag" and e.tag != "form"
        suspected[i] = suspected[up[i]] or e.hint is not None
    for pieces in blocks:
        for e, text, linked in pieces:
            if not linked and not lost[place[id(e)]]:
                e.mass += len(text.strip())
    for e in reversed(elements[1:]):
        e.parent.mass += e.mass
    marked = [i for i, e in enumerate(elements) if e.marked and e.mass and not suspected[i]]
    # Elements are in page order, so what an element holds is the run after it.
    ends = list(range(1, len(elements) + 1))
    for i in range(len(elements) - 1, 0, -1):
        ends[up[i]] = max(ends[up[i]], ends[i])
    return {i for i in suspects if 2 * elements[i].mass > elements[0].mass and all(m < i < ends[m] or i <= m < ends[i] for m in marked)}


def settle(elements: list[Element], blocks: list[list[Piece]]) -> list[tuple[Element, str]]:
    """Decide what is boilerplate, sum up the characters of each element, and give the blocks' texts.

    A line's own words count for an inline element only where it is an advert or hidden, or where
    all of the block is inside such elements.
    """
    spared = wrappers(elements, blocks)
    inline: set[int] = set()
    for i, e in enumerate(elements[1:], 1):
        soft = e.hint in ("word", "comment", "header") and e.tag not in BLOCKS
        above = e.parent.boiler
        e.boiler = above or (e.hint is not None and i not in spared and not soft)
        if not e.boiler and (soft or id(e.parent) in inline):
            if e.tag not in BLOCKS or id(e.parent) in inline:
                inline.add(id(e))
    out = []
    for pieces in blocks:
        kept = [p for p in pieces if not p[0].boiler]
        spoken = [p for p in kept if p[1].strip()]
        gone = not spoken or all(id(p[0]) in inline for p in spoken)
        text = cleaned(pieces if gone else kept)
        if not text:
            continue
        owner = pieces[0][0] if gone else spoken[0][0]
        linked = sum(len(t) for _, t, link in kept if link)
        if gone or linked * 2 > len(text):
            owner.bad += len(text)
        else:
            owner.good += len(text)
        if not gone:
            out.append((owner, text))
    for e in reversed(elements[1:]):
        e.parent.good += e.good
        e.parent.bad += e.bad
    return out


def parse(source: str) -> tuple[list[Element], list[tuple[Element, str]]]:
    """Elements in page order and the text blocks outside boilerplate with an element that holds them."""
    root = Element("", None, "")
    elements, blocks, stack = [root], [], [root]
    pieces: list[Piece] = []
    anchors, opened, at = 0, {}, 0

    def flush() -> None:
        nonlocal pieces
        if pieces:
            blocks.append(pieces)
        pieces = []

    def pop() -> None:
        nonlocal anchors
        gone = stack.pop()
        opened[gone.tag] -= 1
        anchors -= gone.tag == "a"

    def add(text: str) -> None:
        pieces.append((stack[-1], text, anchors > 0))

    def end_open(tags: frozenset, hidden: frozenset) -> None:
        if not any(opened.get(t) for t in tags):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                while len(stack) > i:
                    pop()
                return
            if stack[i].tag in hidden:
                return

    while True:
        token = _TOKEN.search(source, at)
        if token is None:
            break
        if token.start() > at:
            add(source[at : token.start()])
        at = token.end()
        tag = token["tag"]
        if tag is None:
            if token["data"]:
                add(token["data"])
            continue
        tag = tag.lower()
        block = tag in BLOCKS
        if block:
            flush()
        if token["end"]:
            if opened.get(tag):
                while stack[-1].tag != tag:
                    pop()
                pop()
            continue
        if tag in RAW:
            stop = re.compile(rf"</{tag}[\s/>]|\Z", re.I).search(source, at)
            at = stop.start()
            if tag == "textarea" or tag == "xmp":
                flush()
            # The end tag that follows finds nothing open.
            continue
        if tag in VOID:
            if tag == "br":
                add(" ")
            continue
        if block:
            end_open(frozenset(["p"]), SCOPE)
        if tag in ENDS:
            end_open(*ENDS[tag])
        if tag == "body" and opened.get("head"):
            while stack[-1].tag != "head":
                pop()
            pop()
        element = described(tag, token["attrs"], stack[-1])
        elements.append(element)
        stack.append(element)
        opened[tag] = opened.get(tag, 0) + 1
        anchors += tag == "a"
    if at < len(source):
        add(source[at:])
    flush()
    return elements, settle(elements, blocks)


def best_container(elements: list[Element]) -> Element:
    """The highest score; of equal ones the innermost, then the first."""
    best = elements[0]
    for e in elements[1:]:
        if e.tag in CONTAINERS and not e.boiler and (e.score, len(e.labels)) > (best.score, len(best.labels)):
            best = e
    return best


def vote(elements: list[Element]) -> str | None:
    """The path a page votes for: its best container's, none without content."""
    best = best_container(elements)
    return best.path if best.score > 0 and best.labels else None


def main_text(elements: list[Element], blocks: list[tuple[Element, str]], path: str | None) -> str:
    """Blocks inside the winning path, or inside the page's own best container."""
    chosen = {id(e) for e in elements if e.path == path and not e.boiler and e.good} if path else set()
    if not chosen:
        chosen = {id(best_container(elements))}
    # Parents come first in page order.
    inside: set[int] = set()
    for e in elements:
        if id(e) in chosen or (e.parent is not None and id(e.parent) in inside):
            inside.add(id(e))
    return "\n\n".join(text for e, text in blocks if id(e) in inside)


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _decoded(column: pa.Array) -> Iterator[str]:
    return (b.decode("utf-8", "replace") for b in as_bytes(column))


def host_paths(pages: DataFrame) -> DataFrame:
    """Columns host, path: the winner of the votes of the host's pages."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "html"):
            # One batch's votes are added up before they leave the task.
            counts: dict[tuple[str, str], int] = {}
            for host, page in zip(batch.column("host"), _decoded(batch.column("html"))):
                path = vote(parse(page)[0])
                if path:
                    counts[host.as_py(), path] = counts.get((host.as_py(), path), 0) + 1
            rows = [(h, p, n) for (h, p), n in counts.items()]
            columns = list(zip(*rows)) or [(), (), ()]
            kinds = (pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["host", "path", "votes"])

    cast = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(run, "host string, path string, votes long")
    summed = cast.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    best = F.max(F.struct("votes", F.length("path").alias("depth"), "path"))
    return summed.groupBy("host").agg(best.alias("best")).select("host", F.col("best.path").alias("path"))


def extract(pages: DataFrame) -> DataFrame:
    """Columns page_id, url, text, n_chars, path (the host's winner, null if none)."""
    winners = staged(host_paths(pages), "host-paths")
    kinds = dict(pages.dtypes)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "html"):
            texts = [
                main_text(*parse(page), path.as_py())
                for path, page in zip(batch.column("path"), _decoded(batch.column("html")))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64()), batch.column("path")],
                ["page_id", "url", "text", "n_chars", "path"])

    joined = join_hot(pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host")), winners, "host")
    return joined.select("page_id", "url", "html", "path").mapInArrow(
        run, f"page_id {kinds['page_id']}, url string, text string, n_chars long, path string")
