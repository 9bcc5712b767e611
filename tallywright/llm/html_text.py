"""Main text of web pages by tree scoring.

Paragraphs earn points for length and commas and pass them on to their ancestors, less with each
level. A container's points are discounted by its link density; the best container and those of its
siblings that look like prose are kept. Menus, headers, footers, sidebars, notices, adverts, forms,
comments and hidden parts are left out before anything is scored. An article's own header stays. A name
such as ``share-price``, of which only one word speaks of a menu or a notice, takes points away instead:
such a part is left out unless it reads like prose.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr area base col embed input link "
    "meta param source track map picture audio video math".split()
)
RAW = set("script style textarea title noscript iframe template noframes xmp".split())
# Of these the content is a part of the page again where they are never closed.
OPEN_RAW = set("noscript iframe template noframes xmp".split())
BOILER_TAGS = set(
    "head nav header footer aside form button select option dialog menu object svg canvas "
    "fieldset applet".split()
)
BOILER_ROLES = set(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar "
    "toolbar form".split()
)
BOILER_WORDS = set(
    "ad ads adv advert adverts advertisement adsense adbox banner promo promoted promotion sponsor "
    "sponsored sidebar sidebars menu nav navbar navigation footer header masthead topbar toolbar "
    "comment comments disqus reply replies respond cookie cookies consent gdpr notice notices alert "
    "newsletter subscribe subscription signup login social share sharing related recommended "
    "breadcrumb breadcrumbs pagination pager popup modal overlay widget skip copyright disclaimer"
    .split()
)
# Boilerplate words that are common in other senses too, and words that say nothing beside one.
WEAK_WORDS = set(
    "share sharing menu nav header banner notice notices alert related recommended social skip widget "
    "copyright subscription comment reply".split()
)
PLACE_WORDS = set(
    "left right top bottom main list lists link links box slot button buttons area wrapper wrap container "
    "inner outer block section bar panel item items row col column group holder icon icons title unit zone "
    "site page global primary secondary fixed sticky small large js".split()
)
ADVERT_WORDS = set("ad ads advert adverts advertisement adsense adbox sponsor sponsored promo promoted promotion".split())
# Elements whose names may mark them as boilerplate; names of text elements say too little.
NAMED = set("div section ul ol dl table td aside center iframe li p figure blockquote".split())
BOILER_STEMS = re.compile(r"(?:comment|advert|sidebar|cookie|sponsor|newsletter|breadcrumb|disqus|paginat)|\w*(?:nav|menu)$")
# Class names that only say what a layout has beside the content.
LAYOUT = re.compile(r"(?:has|with|without|no)[-_]", re.I)
GOOD_WORDS = set("article content main post entry story body text".split())
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
SCOPE = {
    "li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"},
    "th": {"table"}, "option": {"select"},
    "p": {"td", "th", "article", "section", "div", "body", "aside", "main", "li", "blockquote"},
}
LEVELS = 5  # how far points are passed up
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    __slots__ = ("tag", "up", "boiler", "good", "doubtful", "score", "length", "linked", "commas", "scored", "depth")

    def __init__(self, tag: str, up: Node | None, boiler: bool, good: bool, doubtful: bool = False):
        self.tag, self.up, self.boiler, self.good, self.doubtful = tag, up, boiler, good, doubtful
        self.depth = up.depth + 1 if up else 0
        self.score = 0.0
        self.length = self.linked = self.commas = 0
        self.scored = False


def _marks(tag: str, attrs: str) -> tuple[bool, bool, bool]:
    """(boilerplate, likely content, perhaps boilerplate) by an element's own attributes."""
    boiler = named = good = doubtful = False
    for name, *values in ATTR.findall(attrs):
        name, value = name.lower(), values[0] or values[1] or values[2]
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            boiler = True
        elif name == "role":
            boiler |= value.lower() in BOILER_ROLES
            good |= value.lower() in ("main", "article")
        elif name == "style":
            boiler |= bool(HIDDEN.search(value))
        elif name in ("class", "id"):
            content = False
            for token in value.split():
                words = {w.lower() for w in WORD.findall(token)}
                content |= len(words) == 1 and words <= GOOD_WORDS
                good |= bool(words & GOOD_WORDS)
                if tag in INLINE:
                    named |= bool(words & ADVERT_WORDS) and words <= ADVERT_WORDS | PLACE_WORDS
                elif tag in NAMED and not LAYOUT.match(token):
                    about = {w for w in words if w in BOILER_WORDS or BOILER_STEMS.match(w)}
                    weak = about <= WEAK_WORDS and not words <= about | PLACE_WORDS
                    named |= bool(about) and not weak
                    doubtful |= bool(about) and weak
            named &= not content
    return boiler or named, good, doubtful and not good


def blocks(page: str) -> list[tuple[Node, str, int]]:
    """(block element, its text, characters of it inside links), in page order."""
    root = Node("#root", None, False, False)
    stack, found = [root], []
    parts: list[str] = []
    linked = 0
    link_at = 0  # depth of the stack where the open link began; 0: no open link
    mute: list = []  # tag and open count of a hidden inline element

    def flush() -> None:
        nonlocal linked
        if parts:
            text = "".join(parts)
            if "&" in text:
                text = html_lib.unescape(text)
            text = " ".join(text.split())
            if text:
                found.append((stack[-1], text, min(linked, len(text))))
            parts.clear()
        linked = 0

    def say(text: str) -> None:
        nonlocal linked
        if text and not mute:
            parts.append(text)
            if link_at:
                linked += len(text.strip())

    def pop_to(count: int) -> None:
        nonlocal link_at
        flush()
        del stack[count:]
        if link_at > count:
            link_at = 0

    at, end = 0, len(page)
    while at < end:
        m = TAG.search(page, at)
        if not m:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag, closing, attrs = tag.lower(), m[1] or m[4], m[3] or m[6] or ""
        if tag in RAW:
            if not closing and not attrs.endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
                at = close.end() if close else at if tag in OPEN_RAW else end
            continue
        if tag in INLINE:
            if tag == "a":
                link_at = 0 if closing else len(stack)
            elif tag == "br":
                parts.append(" ")
            if mute:
                if tag == mute[0]:
                    mute[1] += -1 if closing else 1
                    if not mute[1]:
                        mute.clear()
            elif not closing and tag not in VOID and attrs and _marks(tag, attrs)[0]:
                mute[:] = [tag, 1]
            continue
        mute.clear()
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    pop_to(k)
                    break
                if stack[k].tag in SCOPE.get(tag, ()):
                    flush()
                    break
            else:
                flush()
            continue
        flush()
        ends = CLOSED_BY.get(tag, ()) if tag != "p" and tag in CLOSED_BY else ("p",)
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in ends:
                pop_to(k)
                break
            if stack[k].tag in SCOPE.get(tag if tag in CLOSED_BY else "p", ()):
                break
        boiler, good, doubtful = _marks(tag, attrs) if attrs else (False, False, False)
        if tag not in VOID and tag != "hr" and not attrs.endswith("/"):
            up = stack[-1]
            own = tag == "header" and any(n.tag in ("article", "main") for n in stack)
            stack.append(Node(tag, up, up.boiler or boiler or tag in BOILER_TAGS and not own, good, doubtful))
    flush()
    return found


def _summed(kept: list[tuple[Node, str, int]]) -> list[Node]:
    """The blocks' elements and all above them, with the characters, linked ones and commas they hold.

    Each element passes its sums up once, the deepest first, so the work is linear in the page.
    """
    nodes: dict[int, Node] = {}
    for node, _, _ in kept:
        up: Node | None = node
        while up is not None and id(up) not in nodes:
            nodes[id(up)] = up
            up.length = up.linked = up.commas = 0
            up = up.up
    for node, text, linked in kept:
        node.length += len(text)
        node.linked += linked
        node.commas += text.count(",") + text.count("،") + text.count("，")
    for node in sorted(nodes.values(), key=lambda n: -n.depth):
        if node.up is not None:
            node.up.length += node.length
            node.up.linked += node.linked
            node.up.commas += node.commas
    return list(nodes.values())


def main_text(page: str | None) -> str:
    """The article's blocks, one a line; empty for NULL, empty or text-free pages."""
    if not page:
        return ""
    kept = [b for b in blocks(page) if not b[0].boiler]
    nodes = _summed(kept)
    if any(n.doubtful for n in nodes):
        out: dict[int, bool] = {}
        for n in sorted(nodes, key=lambda n: n.depth):
            prose = n.length >= 80 and n.commas > 0 and n.linked < 0.25 * n.length
            out[id(n)] = n.doubtful and not prose or n.up is not None and out[id(n.up)]
        kept = [b for b in kept if not out[id(b[0])]]
        nodes = _summed(kept)
    if not kept:
        return ""
    for node, text, linked in kept:
        size = len(text)
        if node.tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            continue
        points = (1 + text.count(",") + text.count("،") + text.count("，") + min(size / 100, 3.0)) * (
            1 - linked / size
        )
        # A paragraph's points go to what holds it; loose text in a container counts for itself.
        first = node.up if node.tag in ("p", "pre", "li", "td", "th", "dd", "dt", "blockquote") else node
        level, up = 0, first or node
        while up is not None and level < LEVELS:
            up.score += points / (level + 1 if level < 2 else level * 2)
            up.scored = True
            level, up = level + 1, up.up

    def worth(n: Node) -> float:
        bonus = 25 if n.tag in ("article", "main") else 10 if n.good else 0
        return (n.score + bonus) * (1 - n.linked / max(n.length, 1))

    scored = [n for n in nodes if n.scored] or nodes
    best = max(scored, key=lambda n: (worth(n), n.depth))
    for tag in ("article", "main"):  # a part of an article stands for the article
        up = best
        while up is not None and up.tag != tag:
            up = up.up
        if up is not None:
            best = up
            break
    limit = min(max(10.0, 0.2 * worth(best)), worth(best))
    tops = {id(best)}
    if best.tag not in ("article", "main") and best.up is not None:
        for n in nodes:
            if n.up is best.up and n is not best:
                density = n.linked / max(n.length, 1)
                prose = n.tag == "p" and (n.length > 80 and density < 0.25 or density == 0)
                if prose or n.tag in ("h1", "h2", "h3") and density == 0 or n.scored and worth(n) >= limit:
                    tops.add(id(n))
    lines = []
    for node, text, _ in kept:
        up = node
        while up is not None and id(up) not in tops:
            up = up.up
        if up is not None:
            lines.append(text)
    return "\n".join(lines)


def extract_text(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep`` with ``text`` and its length in code points, ``n_chars``.

    A page that is NULL, empty or holds no text gives '' and 0; rows are kept one for one, repeats
    included; an empty table gives an empty one; other columns are left out, so none can clash.
    Pages are independent rows: one pass, no shuffle, memory of one page.
    """
    chosen = pages.select(*keep, F.col(html).alias("__html"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])
    count = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(count)]
            columns = [*batch.columns[:count], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "text", "n_chars"])

    return chosen.mapInArrow(run, f"{fields}, text string, n_chars bigint")
