"""Pages to node arrays, the one place where Python reads markup.

Every page becomes one row with its nodes in document order. ``last`` is the position of a
node's last descendant, so a subtree is a slice of the array and everything that follows
(see ``extract``) is plain column expressions on the same row, with no shuffle.
"""

from __future__ import annotations

import re
import sys
from bisect import bisect_right
from html import unescape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T


# --- fixed values: tags without an end tag, tags whose text is not page text ---
VOID_TAGS = {
    "area", "base", "basefont", "bgsound", "br", "col", "command", "embed", "frame", "hr",
    "image", "img", "input", "isindex", "keygen", "link", "menuitem", "meta", "nextid",
    "param", "source", "spacer", "track", "wbr",
}
SILENT_TAGS = {"script", "style", "template", "rt", "rp"}
ATTRIBUTES = ["id", "class", "rel", "href"]

NODE_TYPE = T.StructType([
    T.StructField("pos", T.IntegerType()),      # 1-based position in the array
    T.StructField("parent", T.IntegerType()),   # 0 at the top
    T.StructField("last", T.IntegerType()),
    T.StructField("tag", T.StringType()),       # null for a text piece
    *[T.StructField(name, T.StringType()) for name in ATTRIBUTES],
    T.StructField("text", T.StringType()),      # null for an element
])

# Markup on which every reading of HTML agrees: text, plain end and start tags, plain
# comments, the doctype. It is read by one pattern; the first other construct on a page
# hands the rest of that page to the standard parser.
PLAIN = re.compile(
    r"([^<]+)"
    r"|</([a-zA-Z][a-zA-Z0-9]*)>"
    r"|<([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\r\n]+[a-zA-Z][a-zA-Z-]*=\"[^\"&]*\")*)[ \t\r\n]*(/?)>"
    r"|<!--(?!-?>)(?:[^-]|-(?!-))*-->"
    r"|<!(?:doctype|DOCTYPE) html>")
PLAIN_ATTRIBUTE = re.compile(r"([a-zA-Z][a-zA-Z-]*)=\"([^\"]*)\"")
CODE_TAGS = {"script", "style"}
CODE_START = re.compile(rb"<(script|style)(?:[ \t\r\n][^<>]*)?>", re.IGNORECASE)
CODE_END = {tag.encode(): re.compile(f"</{tag}(?=[^a-zA-Z0-9])".encode(), re.IGNORECASE)
            for tag in CODE_TAGS}
RAW_TAGS = CODE_TAGS | {
    "iframe", "noembed", "noframes", "noscript", "plaintext", "textarea", "title", "xmp"}

# Workers get the code of this module with the task, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Outline(HTMLParser):
    """Collects the nodes of pages: one tuple per node, and the last descendants apart."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes = []     # (parent, tag, id, class, rel, href, text)
        self.lasts = []
        self.start_page()

    def start_page(self):
        self.reset()
        self.base = len(self.nodes)
        self.stack = []     # (tag, position) of open elements
        self.parent = 0
        self.silent = 0

    def handle_starttag(self, tag, attrs):
        if attrs:
            given = {name: value or "" for name, value in attrs}
            token_lists = (" ".join(given[name].split()) if name in given else None
                           for name in ("class", "rel"))
            self.nodes.append(
                (self.parent, tag, given.get("id"), *token_lists, given.get("href"), None))
        else:
            self.nodes.append((self.parent, tag, None, None, None, None, None))
        position = len(self.nodes) - self.base
        self.lasts.append(position)
        if tag not in VOID_TAGS:
            self.stack.append((tag, position))
            self.parent = position
            self.silent += tag in SILENT_TAGS

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        stack = self.stack
        if stack and stack[-1][0] == tag:
            self.close_top()
        elif any(tag == name for name, _ in stack):
            while self.close_top() != tag:
                pass

    def close_top(self):
        tag, position = self.stack.pop()
        self.silent -= tag in SILENT_TAGS
        self.lasts[self.base + position - 1] = len(self.nodes) - self.base
        self.parent = self.stack[-1][1] if self.stack else 0
        return tag

    def handle_data(self, data):
        if not self.silent:
            nodes = self.nodes
            nodes.append((self.parent, None, None, None, None, None, data))
            self.lasts.append(len(nodes) - self.base)

    def read_plain(self, html):
        """Read plain markup from the start; the position of the first other construct."""
        place, match = 0, PLAIN.match
        while found := match(html, place):
            place = found.end()
            group = found.lastindex
            if group == 1:
                text = found[1]
                self.handle_data(unescape(text) if "&" in text else text)
            elif group == 2:
                self.handle_endtag(found[2].lower())
            elif group is not None:
                tag, closed = found[3].lower(), found[5]
                after = self.after_code(html, place, tag, closed)
                if after is None:
                    return found.start()
                given = [(name.lower(), value) for name, value in
                         PLAIN_ATTRIBUTE.findall(found[4])] if found[4] else ()
                (self.handle_startendtag if closed else self.handle_starttag)(tag, given)
                if after > place:
                    self.handle_endtag(tag)
                    place = after
        return place

    @staticmethod
    def after_code(html, place, tag, closed):
        """Where reading goes on after a start tag; None when its content is not plain."""
        if tag not in RAW_TAGS:
            return place
        if tag in CODE_TAGS and not closed:
            end = re.compile(f"</{tag}(?=[^a-zA-Z0-9])", re.IGNORECASE).search(html, place)
            plain = end and html[end.end()] == ">"
            return end.end() + 1 if plain else None
        plain = re.compile(f"[^<&]*</{tag}>").match(html, place)
        return place if plain and not closed else None

    def unknown_decl(self, data):
        if data.upper().startswith("CDATA["):
            self.handle_data(data[len("CDATA["):])

    def parse_marked_section(self, i, report=1):
        """An unknown ``<![`` declaration ends at its first ``>``, like a bogus comment."""
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            return self.rawdata.find(">", i) + 1 or -1

    def read(self, html):
        """Add one page; False when the markup is beyond the tokenizer."""
        self.start_page()
        try:
            place = self.read_plain(html)
            if place < len(html):
                self.feed(html[place:])
                self.close()
            sound = True
        except AssertionError:
            del self.nodes[self.base:], self.lasts[self.base:]
            self.stack, sound = [], False
        while self.stack:
            self.close_top()
        return sound


def _node_lists(offsets, positions, parents, lasts, texts, missing=None):
    """Arrow array of node lists from flat columns; ``texts`` are tag, the attributes and text."""
    nodes = pa.StructArray.from_arrays(
        [pa.array(numbers, pa.int32()) for numbers in (positions, parents, lasts)]
        + [pa.array(column, pa.string()) for column in texts], names=NODE_TYPE.names)
    return pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), nodes,
        mask=None if missing is None else pa.array(missing, pa.bool_()))


def _read_each(pages):
    """Node lists of pages that are read one by one; null for a missing or refused page."""
    outline = Outline()
    offsets = [0]
    missing = []
    for html in pages:
        missing.append(html is None or not outline.read(html))
        offsets.append(len(outline.nodes))
    parents, *texts = zip(*outline.nodes) if outline.nodes else [()] * 7
    positions = [place for start, end in zip(offsets, offsets[1:])
                 for place in range(1, end - start + 1)]
    return _node_lists(offsets, positions, parents, outline.lasts, texts, missing)


IGNORED = None      # what a comment or the doctype does; see _deed


def _deed(piece, numbers):
    """What a piece of markup does, and its tag and attributes; None when it is not plain.

    Number n opens tag n, -n ends it, 0 is an element without content. ``numbers`` names tags by
    number, those whose text is no page text first.
    """
    found = PLAIN.fullmatch(piece)
    if not found:
        return None
    if found.lastindex is None:
        return IGNORED, None, {}
    if found.lastindex == 2:
        return -numbers.setdefault(found[2].lower(), len(numbers) + 1), None, {}
    tag = found[3].lower()
    if found[5] and tag in RAW_TAGS:
        return None
    given = {name.lower(): value for name, value in PLAIN_ATTRIBUTE.findall(found[4])}
    given |= {name: " ".join(given[name].split()) for name in ("class", "rel") if name in given}
    opens = not found[5] and tag not in VOID_TAGS
    return numbers.setdefault(tag, len(numbers) + 1) if opens else 0, tag, given


def _nested(starts, odd, deeds, codes, texts):
    """Number of nodes of each page, and of each node its parent, last descendant and origin.

    Page ``i`` has the tokens from ``starts[i]`` on: a code of ``deeds`` and the number, if any, of the
    text behind it. The origin is that code, or minus the number of a text. Odd pages get no nodes.
    """
    sizes, parents, lasts, origins = [], [], [], []
    silent_tags = len(SILENT_TAGS)
    for start, end, skipped in zip(starts, starts[1:], odd):
        if skipped:
            sizes.append(0)
            continue
        base = len(parents) - 1
        names, places, parent, place, silent = [0], [0], 0, 0, 0
        for code, text in zip(codes[start:end], texts[start:end]):
            deed = deeds[code]
            if deed is None:
                pass
            elif deed >= 0:
                place += 1
                origins.append(code)
                parents.append(parent)
                lasts.append(place)
                if deed:
                    names.append(deed)
                    places.append(place)
                    parent = place
                    silent += deed <= silent_tags
            elif -deed in names:
                name = 0
                while name != -deed:
                    name = names.pop()
                    lasts[base + places.pop()] = place
                    silent -= name <= silent_tags
                parent = places[-1]
            if text and not silent:
                place += 1
                origins.append(-text)
                parents.append(parent)
                lasts.append(place)
        for open_place in places[1:]:
            lasts[base + open_place] = place
        sizes.append(place)
    return sizes, parents, lasts, origins


def _outside_code(raw, opened, borders):
    """The places of ``<`` that are not in the content of a script or style."""
    raw, borders, starts, ends = memoryview(raw), borders.tolist(), [], []
    place = borders[0]
    while found := CODE_START.search(raw, place):
        page_end = borders[bisect_right(borders, found.start())]
        place = min(found.end(), page_end)
        if end := CODE_END[found[1].lower()].search(raw, place, page_end):
            starts.append(place)
            ends.append(end.start())
            place = end.end()
    inside = np.zeros(len(opened) + 1, np.int32)
    np.add.at(inside, np.searchsorted(opened, starts), 1)
    np.add.at(inside, np.searchsorted(opened, ends), -1)
    return opened[np.cumsum(inside[:-1]) == 0]


def _cut(data, borders):
    """Texts between ascending positions of a buffer, without copying."""
    return pa.StringArray.from_buffers(
        len(borders) - 1, pa.py_buffer(borders.astype(np.int32)), data)


def _read_together(pages):
    """Node lists of pages, and which of them hold other than plain markup (their list is to be ignored).

    All pages are cut at once: a piece of markup goes from ``<`` to the next ``>``, text fills
    the rest. Every distinct piece is read by one pattern, once.
    """
    borders = np.frombuffer(pages.buffers()[1], np.int32)[pages.offset:pages.offset + len(pages) + 1]
    data = pages.buffers()[2] or pa.py_buffer(b"")
    raw = np.frombuffer(data, np.uint8)[:borders[-1]]
    opened = _outside_code(
        raw, np.flatnonzero(raw[borders[0]:] == ord("<")) + borders[0], borders)
    ends = np.flatnonzero(raw[borders[0]:] == ord(">")) + borders[0]
    page_of = np.searchsorted(borders, opened, side="right") - 1
    following = np.append(opened[1:], borders[-1])      # next piece of markup, if on this page
    following = np.minimum(following, borders[1:][page_of])
    closed = np.append(ends, len(raw))[np.searchsorted(ends, opened)]
    odd = np.zeros(len(pages), bool)
    odd[page_of[closed >= following]] = True
    closed = np.minimum(closed, following - 1)

    # the pieces: one empty piece at each page start, so that a text follows every piece
    order = np.argsort(np.concatenate([borders[:-1], opened]), kind="stable")
    piece_starts = np.concatenate([borders[:-1], opened])[order]
    piece_ends = np.concatenate([borders[:-1], closed + 1])[order]
    text_ends = np.append(piece_starts[1:], borders[-1])
    cut = _cut(data, np.append(np.stack([piece_starts, piece_ends], axis=1).ravel(), text_ends[-1:]))
    pieces = cut.take(pa.array(np.arange(0, len(cut), 2))).dictionary_encode()
    texts = cut.take(pa.array(np.arange(1, len(cut), 2)))
    codes = pieces.indices.to_numpy()
    page_of = np.concatenate([np.arange(len(pages)), page_of])[order]

    numbers = {tag: i for i, tag in enumerate(sorted(SILENT_TAGS), 1)}
    read = [(IGNORED, None, {}) if piece == "" else _deed(piece, numbers)
            for piece in pieces.dictionary.to_pylist()]
    plain = np.array([deed is not None for deed in read], bool)
    odd[page_of[~plain[codes]]] = True
    read = [deed or (IGNORED, None, {}) for deed in read]
    deeds = [deed for deed, _, _ in read]
    marked = pc.match_substring(texts, "&")

    # content of raw tags is plain if their own end tag comes next; only code may hold "&"
    for tag in RAW_TAGS & numbers.keys():
        starting = np.array([deed == numbers[tag] for deed in deeds], bool)[codes]
        ending = np.array([deed == -numbers[tag] for deed in deeds], bool)[codes]
        if tag not in CODE_TAGS:
            exact = np.array([piece == f"</{tag}>" for piece in pieces.dictionary.to_pylist()], bool)
            ending &= exact[codes]
            odd[page_of[starting & marked.to_numpy(zero_copy_only=False)]] = True
        odd[page_of[starting & ~np.append(ending[1:], False)]] = True

    filled = np.where(text_ends > piece_ends, np.arange(1, len(texts) + 1), 0)
    starts = np.searchsorted(page_of, np.arange(len(pages) + 1))
    sizes, parents, lasts, origins = _nested(
        starts.tolist(), odd.tolist(), deeds, codes.tolist(), filled.tolist())

    if pc.any(marked).as_py():
        texts = pc.replace_with_mask(texts, marked, pa.array(
            [unescape(text) for text in texts.filter(marked).to_pylist()], pa.string()))
    origins = np.array(origins, np.int64)
    element, offsets = origins >= 0, np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    of_element = pa.array(np.where(element, origins, 0), mask=~element)
    of_text = pa.array(np.where(element, 0, -origins - 1), mask=element)
    columns = [[tag for _, tag, _ in read]] + [
        [given.get(name) for _, _, given in read] for name in ATTRIBUTES]
    positions = np.arange(1, len(origins) + 1) - np.repeat(offsets[:-1], sizes)
    lists = _node_lists(
        offsets, positions, np.array(parents, np.int32), np.array(lasts, np.int32),
        [pa.array(column, pa.string()).take(of_element) for column in columns]
        + [texts.take(of_text)])
    return lists, odd


def _node_arrays(pages):
    """Arrow array of node lists for Arrow texts of pages; null for a missing or refused page."""
    lists, odd = _read_together(pages.cast(pa.string()).fill_null(""))
    odd |= pages.is_null().to_numpy(zero_copy_only=False)
    if not odd.any():
        return lists
    rest = _read_each(pages.filter(pa.array(odd)).to_pylist())
    places = np.arange(len(pages))
    places[odd] = len(pages) + np.arange(odd.sum())
    return pa.concat_arrays([lists, rest]).take(pa.array(places))


BYTES_AT_ONCE = 4 << 20     # of markup, or one page: bounds an output batch


def _outline_batches(batches):
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            limit = (ends[start - 1] if start else 0) + BYTES_AT_ONCE
            stop = max(start + 1, int(np.searchsorted(ends, limit, side="right")))
            part = batch.slice(start, stop - start)
            start = stop
            html = part.column(part.num_columns - 1)
            kept = [part.column(i) for i in range(part.num_columns - 1)]
            names = [part.schema.field(i).name for i in range(part.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, _node_arrays(html)], [*names, "nodes"])


def html_nodes(pages: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns plus ``nodes``, one row per page.

    Callers that use the nodes more than once should write them to a table first, so that
    pages are read by Python once.
    """
    keep = keep or [name for name in pages.columns if name != html]
    rows = pages.select(*keep, html)
    schema = T.StructType([*[rows.schema[name] for name in keep],
                           T.StructField("nodes", T.ArrayType(NODE_TYPE))])
    return rows.mapInArrow(_outline_batches, schema)


def node_rows(pages: DataFrame) -> DataFrame:
    """One row per node, for inspection and counting."""
    keep = [name for name in pages.columns if name != "nodes"]
    return pages.select(*keep, F.inline("nodes"))
