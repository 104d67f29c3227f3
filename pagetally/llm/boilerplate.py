"""Main text of HTML pages by a minimum cut between content and boilerplate.

A page is read into blocks of text with their path in the markup. A classifier gives each block
a cost of being called content and one of being called boilerplate: these are the capacities to
the two terminals. Neighbouring blocks, and blocks whose parents are near in the tree, are joined
by smoothness edges. The minimum cut is the cheapest labelling; it is found by augmenting paths.
Elements that are boilerplate by their kind (menus, footers) have costs too great to be
outvoted. Other tags and the words of class, id and role are terms of the cost beside words, links
and endings, so that text and neighbours can outvote them.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Generator, Iterable, Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

#: Elements whose text is never shown, or is no text.
HIDDEN = frozenset("script style template iframe svg head title select option textarea button "
                   "datalist canvas audio video map annotation annotation-xml".split())
#: Elements whose content is raw until their end tag.
RAW = frozenset(("script", "style", "textarea", "title", "iframe", "noembed", "xmp"))
#: Elements that do not break a block.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd "
                   "label mark nobr q rb rp rt ruby s samp small span strike strong sub sup time "
                   "tt u var wbr br math annotation annotation-xml semantics maction menclose "
                   "merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts "
                   "mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr "
                   "munder munderover".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that an opening tag of the same group ends.
CLOSED_BY = {"li": ("li",), "p": ("p",), "dt": ("dt", "dd"), "dd": ("dt", "dd"),
             "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
             "option": ("option",)}
#: Opening tags that end an open paragraph.
ENDS_PARAGRAPH = frozenset("address article aside blockquote div dl fieldset figure footer form "
                           "h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table "
                           "ul".split())
#: Elements and words of class, id or role that mark boilerplate, and such that mark content.
BOILER_TAGS = frozenset("nav footer aside menu dialog fieldset".split())
BOILER_WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs footer foot header masthead topbar "
    "banner sidebar side aside rail ad ads advert adverts advertisement advertising adsbox "
    "sponsor sponsored promo promotion promoted notice notices cookie cookies consent gdpr "
    "popup modal overlay newsletter subscribe subscription signup login share sharing social "
    "related recommended recommendations comment comments commentlist disqus reply replies "
    "respond widget widgets pagination pager toolbar search skip legal copyright complementary "
    "contentinfo alert dialog tags toc teaser trending".split())
CONTENT_TAGS = frozenset(("article", "main"))
CONTENT_WORDS = frozenset("article content main post entry story body text".split())
#: Words that mark boilerplate on any element, and such that stand for titles inside content.
STRONG_WORDS = frozenset("comment comments commentlist disqus reply replies ad ads advert adverts "
                         "advertisement sponsored promo related recommended teaser cookie".split())
TITLE_WORDS = frozenset("header head masthead banner topbar".split())
MODIFIERS = frozenset("has no with without js".split())
#: Elements that may stand in the head of a page.
HEAD_TAGS = frozenset("title meta link base script style noscript template".split())
#: Cost that no sum of the others reaches.
CERTAIN = 1000.0
#: What a content mark adds to a block's score, and what a boilerplate mark takes off. A strong word
#: outweighs the longest prose with a content mark inside.
MARKED, AGAINST, STRONGLY = 3.0, 4.0, 9.0
#: Weights of the smoothness edges: next in the page, and same or related parent.
NEXT, NEAR = 0.6, 0.6

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*'|[\"'])*+)>", re.S)
#: A tag that ends at the first ``>``, for pages whose quotes do not pair.
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|style|aria-hidden)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|"
                        r"[^\s\"'>]+))?", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Node:
    """An open element and what it and its ancestors say."""
    tag: str
    parent: Node | None
    depth: int
    hidden: bool = False
    boiler: bool = False
    content: float = 0.0
    against: float = 0.0
    form: float = 0.0
    link: bool = False
    #: The nearest element, this one included, that is not inline.
    holder: Node | None = None


@dataclass
class Block:
    """A run of text between two block boundaries."""
    node: Node
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def _verdict(names: str, tag: str, inside: bool) -> float:
    """What class, id or role say: below 0 for boilerplate, above for content, else 0.

    Of several words in one name the last known one counts, as in ``main-nav``.
    """
    if tag in ("html", "body"):
        return 0.0
    found = 0.0
    for name in names.split():
        said = [w.lower() for w in _WORD.findall(name)]
        if not said or said[0] in MODIFIERS:
            continue
        known = [w for w in said if w in BOILER_WORDS or w in CONTENT_WORDS]
        if any(w in STRONG_WORDS for w in said):
            return -STRONGLY
        if not known or tag in CONTENT_TAGS:
            continue
        if known[-1] in TITLE_WORDS and (inside or len(known) > 1):
            continue
        found = min(found, -AGAINST) if known[-1] in BOILER_WORDS else found or MARKED
    return found


def _opened(tag: str, attributes: str, parent: Node, first: bool) -> Node:
    """A new element; ``first`` says that nothing of the page has been said before it.

    A form is boilerplate as strongly as any mark says, but for an article inside it, and for a form
    that wraps the page from its start.
    """
    node = Node(tag, parent, parent.depth + 1, parent.hidden, parent.boiler, parent.content,
                parent.against, parent.form, parent.link)
    node.holder = parent.holder if tag in INLINE else node
    if tag == "form" and not (first and parent.tag in ("", "html", "body", "div")):
        node.content, node.form = 0.0, STRONGLY
    node.hidden |= tag in HIDDEN
    node.link |= tag == "a"
    node.boiler |= tag in BOILER_TAGS
    verdicts = [0.0]
    if tag in CONTENT_TAGS:
        node.content, node.form = MARKED, 0.0
    if tag == "header" and not node.content or tag == "noscript":
        verdicts.append(-AGAINST)
    if attributes and "=" in attributes or "hidden" in attributes:
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name == "hidden" or name == "aria-hidden" and value == "true" \
                    or name == "style" and _UNSEEN.search(value):
                node.hidden = True
            elif name in ("class", "id", "role"):
                verdicts.append(_verdict(value, tag, node.content > 0))
    if min(verdicts) < 0:
        # content marks around this element say nothing of it
        node.content, node.against = 0.0, max(node.against, -min(verdicts))
    elif max(verdicts) > 0:
        node.content = MARKED
    return node


def _tags(html: str) -> Generator[tuple[int, int, re.Match | str | None], int | None, None]:
    """(start, end, match) of each tag, with the text of a CDATA section or None for comments.

    One pass: what has no end is looked for once. A tag without an end, its quotes closed or not,
    ends the page. When a tag's quotes swallow the rest of the page, quotes no longer count.
    """
    last = html.rfind(">")
    at, pattern, sections = 0, _TAG, True
    while (at := html.find("<", at)) >= 0:
        mark = html[at + 1:at + 2]
        if html.startswith("<!--", at):
            end = html.find("-->", at + 4)
            end = len(html) if end < 0 else end + 3
            yield at, end, None
        elif mark in ("!", "?"):
            end = html.find("]]>", at) if sections and html.startswith("<![CDATA[", at) else -1
            sections = sections and (end >= 0 or not html.startswith("<![CDATA[", at))
            if end >= 0:
                yield at, end + 3, html[at + 9:end]
                end += 3
            else:
                end = html.find(">", at) + 1 or len(html)
                yield at, end, None
        elif mark.isascii() and mark.isalpha() or mark == "/" and html[at + 2:at + 3].isascii() \
                and html[at + 2:at + 3].isalpha():
            match = pattern.match(html, at) if at < last else None
            if match is None and at < last:
                pattern = _PLAIN_TAG
                match = pattern.match(html, at)
            if match is None:
                yield at, len(html), None
                return
            # the reader of the page may go on behind an element's raw text
            end = (yield at, match.end(), match) or match.end()
        else:
            at += 1
            continue
        at = end


def blocks(html: str) -> list[Block]:
    """The visible blocks of a page, in page order."""
    root = Node("", None, 0)
    root.holder = root
    stack = [root]
    open_at: dict[str, list[int]] = {}
    found: list[Block] = []
    current: Block | None = None

    def said(text: str) -> None:
        nonlocal current
        node = stack[-1]
        if not text or node.hidden:
            return
        if current is None:
            if text.isspace():
                return
            current = Block(node.holder)
            found.append(current)
        text = unescape(text)
        current.parts.append(text)
        if node.link:
            current.linked += len(text)

    def close(index: int) -> None:
        for node in stack[index:]:
            open_at[node.tag].pop()
        del stack[index:]

    at, tags, skip = 0, _tags(html), None
    while True:
        try:
            start, end, match = tags.send(skip)
        except StopIteration:
            said(html[at:])
            break
        skip = None
        said(html[at:start])
        at = end
        if match is None:
            continue
        if isinstance(match, str):
            said(match.replace("&", "&amp;"))
            continue
        tag = match[2].lower()
        if tag == "br":
            if current is not None:
                current.parts.append(" ")
            continue
        inline = tag in INLINE
        if not inline:
            current = None
        if match[1]:
            places = open_at.get(tag)
            # an inline element ends only inside its block
            if places and (not inline or places[-1] > stack[-1].holder.depth):
                close(places[-1])
            continue
        if tag in VOID:
            continue
        if stack[-1].tag == "head" and tag not in HEAD_TAGS:
            close(len(stack) - 1)
        ends = CLOSED_BY.get(tag, ())
        if tag in ENDS_PARAGRAPH and "p" not in ends:
            ends = (*ends, "p")
        # formatting that a paragraph left open ends with it
        if not inline and stack[-1].holder.tag in ends:
            close(stack[-1].holder.depth)
        node = _opened(tag, match[3], stack[-1], not found)
        if tag in RAW:
            finish = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            raw = html[at:finish.start() if finish else len(html)]
            if tag == "xmp" and not node.hidden:
                stack.append(node)
                said(raw.replace("&", "&amp;"))
                stack.pop()
            at = skip = finish.end() if finish else len(html)
            continue
        if match[3].endswith("/") and inline:
            continue
        open_at.setdefault(tag, []).append(len(stack))
        stack.append(node)
    return [block for block in found if block.text()]


def costs(block: Block, text: str) -> tuple[float, float]:
    """Cost of calling the block content, and of calling it boilerplate."""
    node = block.node
    if node.boiler:
        return CERTAIN, 0.0
    words = text.count(" ") + 1
    links = block.linked / max(1, len(text))
    ends = text[-1] in ".!?…:;\"'”’)"
    score = min(words, 40) / 10 - 1.2 - 5 * links + (1.0 if ends and words > 4 else 0.0)
    if re.fullmatch("h[1-6]", node.tag):
        score = max(score, 0.3)
    elif node.tag in ("p", "blockquote", "pre", "td", "li"):
        score += 0.6 if node.tag == "p" else 0.0
    # a marked text keeps the notices that are its own
    if not node.content and ("©" in text or re.match(
            r"(?i)\s*copyright\b|all rights reserved", text)):
        score -= 6
    score += node.content - max(node.against, node.form)
    return max(0.0, -score), max(0.0, score)


def cut(content: list[float], boiler: list[float],
        edges: dict[tuple[int, int], float]) -> list[bool]:
    """Whether each block is content in the cheapest labelling.

    Maximum flow by blocking flows over shortest paths; content is what the source still reaches, so a
    block whose two labels cost the same is boilerplate.
    """
    n = len(content)
    source, sink = n, n + 1
    heads: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[float] = []

    def arc(i: int, j: int, forth: float, back: float) -> None:
        heads[i].append(len(to))
        heads[j].append(len(to) + 1)
        to.extend((j, i))
        room.extend((forth, back))

    for i in range(n):
        if boiler[i] > 0:
            arc(source, i, boiler[i], 0.0)
        if content[i] > 0:
            arc(i, sink, content[i], 0.0)
    for (i, j), weight in edges.items():
        arc(i, j, weight, weight)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        waiting = deque((source,))
        while waiting:
            at = waiting.popleft()
            for e in heads[at]:
                if room[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[at] + 1
                    waiting.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        # a blocking flow: each arc is given up once it leads nowhere
        tried = [0] * (n + 2)
        path: list[int] = []
        at = source
        while True:
            if at == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                full = next(k for k, e in enumerate(path) if room[e] <= 1e-9)
                at = to[path[full] ^ 1]
                del path[full:]
                continue
            arcs = heads[at]
            while tried[at] < len(arcs):
                e = arcs[tried[at]]
                if room[e] > 1e-9 and level[to[e]] == level[at] + 1:
                    break
                tried[at] += 1
            else:
                if not path:
                    break
                at = to[path.pop() ^ 1]
                tried[at] += 1
                continue
            path.append(e)
            at = to[e]


def _edges(found: list[Block]) -> dict[tuple[int, int], float]:
    """Smoothness: from each block to the next, and to the last one under the same parent."""
    edges: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}
    for i, block in enumerate(found):
        if i:
            edges[i - 1, i] = NEXT
        for holder, weight in ((block.node.parent, NEAR), (block.node.parent and
                                                           block.node.parent.parent, NEAR / 3)):
            if holder is not None:
                j = last.get(id(holder))
                if j is not None:
                    edges[j, i] = edges.get((j, i), 0.0) + weight
                last[id(holder)] = i
    return edges


def main_text(html: str | None) -> str:
    """The blocks of the content, joined by a line feed; empty without any."""
    found = blocks(html or "")
    if not found:
        return ""
    texts = [block.text() for block in found]
    pairs = [costs(block, text) for block, text in zip(found, texts)]
    keep = cut([c for c, _ in pairs], [b for _, b in pairs], _edges(found))
    return "\n".join(text for text, kept in zip(texts, keep) if kept)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of each row, from the whole html.

    Null html is empty; a page without content has an empty text. Repeated rows and null ids
    give rows of their own, other columns are ignored, an empty table gives no rows.
    """
    kinds = dict(pages.dtypes)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(html) for html in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])
    return pages.select("page_id", "url", F.col("html").cast("string").alias("html")).mapInArrow(
        run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
