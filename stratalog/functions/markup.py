"""The one Python step: a single pass over each page that flattens its element tree.

Spark hands Arrow batches to the functions below. They return only what needs the tree (the text
of an element, the nearest enclosing block, the siblings of a heading) as strings; every
extraction from those strings is a native column.

The pass follows a lenient tree builder: void elements close at once, an end tag closes the nearest
open element of its name and everything inside it, an end tag nobody opened is ignored. An element
therefore covers a contiguous range of the page's text nodes.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from html.entities import html5
from html.parser import HTMLParser
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalog.schema import STRINGS

_VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen link "
    "menuitem meta nextid param source spacer track wbr".split()
)
# Text inside these belongs to them alone and is no part of the page's text.
_OWN_TEXT = frozenset(["script", "style", "template", "rt", "rp"])
_KEEP_BLANKS = frozenset(["pre", "textarea"])
_ASCII_BLANKS = " \n\t\f\r"
#: Markup whose pages are read before what they say is handed on.
BYTES_AT_ONCE = 1 << 21


class _Node:
    __slots__ = ("name", "attrs", "parent", "first", "last", "contents", "only", "end")

    def __init__(self, name, attrs, parent, first):
        self.name, self.attrs, self.parent = name, attrs, parent
        self.first = self.last = first  # text nodes [first, last)
        self.contents = 0  # direct children of any kind
        self.only = None  # the direct child while there is just one
        self.end = None  # index after the last descendant, None while open

    def add(self, child):
        self.contents += 1
        self.only = child if self.contents == 1 else None


class _Page:
    """Elements in document order and text nodes in document order."""

    def __init__(self, feed, markup):
        self.nodes = [_Node("", {}, None, 0)]
        self.texts = []
        self.owners = []  # per text node, name of the own-text element around it or ""
        self._open = [0]
        self._counts = {}
        self._own = []
        self._keep = 0
        self._parts = []
        self.complete = feed(self, markup)
        self._flush()
        while self._open:
            self._close_top()

    def _flush(self):
        if not self._parts:
            return
        data = "".join(self._parts)
        self._parts = []
        if not self._keep and not data.strip(_ASCII_BLANKS):
            data = "\n" if "\n" in data else " "
        self._emit(data, self._own[-1] if self._own else "")

    def _emit(self, data, owner):
        self.nodes[self._open[-1]].add(data)
        self.texts.append(data)
        self.owners.append(owner)

    def _close_top(self):
        node = self.nodes[self._open.pop()]
        node.last, node.end = len(self.texts), len(self.nodes)
        if node.name:
            self._counts[node.name] -= 1
        if node.name in _OWN_TEXT:
            self._own.pop()
        if node.name in _KEEP_BLANKS:
            self._keep -= 1

    def start(self, tag, attrs, closed=False):
        if self._parts:
            self._flush()
        parent = self._open[-1]
        node = _Node(tag, attrs, parent, len(self.texts))
        self.nodes[parent].add(node)
        self._open.append(len(self.nodes))
        self.nodes.append(node)
        self._counts[tag] = self._counts.get(tag, 0) + 1
        if tag in _OWN_TEXT:
            self._own.append(tag)
        if tag in _KEEP_BLANKS:
            self._keep += 1
        if closed or tag in _VOID:
            self._close_top()

    def end(self, tag):
        if self._parts:
            self._flush()
        if self._counts.get(tag):
            name = None
            while name != tag:
                name = self.nodes[self._open[-1]].name
                self._close_top()

    def text(self, data):
        self._parts.append(data)

    def named(self, name):
        self._parts.append(html5.get(name + ";") or "&" + name)

    def numbered(self, number):
        self._parts.append(html.unescape(f"&#{number};"))

    def aside(self, data):
        """A comment or declaration: it parts the texts around it and is none itself."""
        self._flush()
        self.nodes[self._open[-1]].add(data)

    def section(self, data):
        self._flush()
        self._emit(data, "")

    # ---- reading -------------------------------------------------------------------------

    def strings(self, node):
        owner = node.name if node.name in _OWN_TEXT else ""
        span = range(node.first, node.last)
        return [self.texts[i] for i in span if self.owners[i] == owner]

    def stripped(self, node):
        return [s for s in (t.strip() for t in self.strings(node)) if s]

    def sole_string(self, node):
        """The element's text if a single text is all it holds, at any depth."""
        child = node.only
        while isinstance(child, _Node):
            child = child.only
        return child

    def find(self, test, start=1, end=None):
        for i in range(start, len(self.nodes) if end is None else end):
            if test(self.nodes[i]):
                return self.nodes[i]
        return None


class _Lenient(HTMLParser):
    """The standard library's tokenizer, which makes something of any markup."""

    def __init__(self, page):
        super().__init__(convert_charrefs=False)
        self.page = page
        self.handle_endtag = page.end
        self.handle_data = page.text
        self.handle_entityref = page.named
        self.handle_charref = page.numbered
        self.handle_comment = self.handle_decl = self.handle_pi = page.aside

    def handle_starttag(self, tag, attrs):
        self.page.start(tag, {k: v or "" for k, v in attrs})

    def handle_startendtag(self, tag, attrs):
        self.page.start(tag, {k: v or "" for k, v in attrs}, closed=True)

    def unknown_decl(self, data):
        if data.upper().startswith("CDATA["):
            self.page.section(data[6:])
        else:
            self.page.aside(data)


def _feed_lenient(page, markup):
    parser = _Lenient(page)
    parser.feed(markup)
    parser.close()
    return True


# Tokens that can be read in one way only. Most pages consist of nothing else, and one expression
# takes them apart several times faster than the lenient tokenizer.
_TOKEN = re.compile(
    r"""
    ([^<&]++)
    |&([a-zA-Z][a-zA-Z0-9]*+)(?:;|(?=[^-.;]))
    |&\#([0-9]++);
    |(&)(?=[^a-zA-Z#])
    |<([a-zA-Z][-a-zA-Z0-9]*+)
        ((?:[ \t\n\r\f]++[a-zA-Z_:@][-\w:.@]*+
            (?:=(?:"[^"]*+"|'[^']*+'|[^\s"'=<>`/&]++))?(?=[ \t\n\r\f/>]))*+)
        [ \t\n\r\f]*+(/?)>
    |</([a-zA-Z][-a-zA-Z0-9]*+)[ \t\n\r\f]*+>
    |<!--([^-]*+(?:-(?!-)[^-]*+)*+)-->
    |<!(doctype[^>]*+)>
    """,
    re.X | re.I | re.A,
)
_ATTRIBUTE = re.compile(r"""([^\s=]+)(?:=(?:"([^"]*)"|'([^']*)'|(\S+)))?""", re.A)
_RAW_END = {name: re.compile(rf"</\s*{name}", re.I) for name in ("script", "style")}


def _feed_plain(page, markup):
    """Feed unambiguous markup; False as soon as something else comes up."""
    at, end, token = 0, len(markup), _TOKEN.match
    start, close, text = page.start, page.end, page.text
    while at < end:
        m = token(markup, at)
        if m is None:
            return False
        at, kind = m.end(), m.lastindex
        if kind == 1:
            text(m[1])
        elif kind == 8:
            close(m[8].lower())
        elif kind == 7:
            tag, attrs = m[5].lower(), {}
            if m[6]:
                for name, a, b, c in _ATTRIBUTE.findall(m[6]):
                    value = a or b or c
                    attrs[name.lower()] = html.unescape(value) if "&" in value else value
            start(tag, attrs, closed=bool(m[7]))
            if tag in _RAW_END and not m[7]:
                stop = _RAW_END[tag].search(markup, at)
                if stop is None or not markup.startswith(">", stop.end()):
                    return False
                if stop.start() > at:
                    text(markup[at:stop.start()])
                at = stop.end() + 1
                close(tag)
        elif kind == 2:
            page.named(m[2])
        elif kind == 3:
            page.numbered(m[3])
        elif kind == 4:
            text("&")
        else:
            page.aside(m[kind])
    return True


def _parse(markup):
    if not markup:
        return None
    page = _Page(_feed_plain, markup)
    if page.complete:
        return page
    try:
        return _Page(_feed_lenient, markup)
    except (AssertionError, ValueError):  # markup the tokenizer rejects: a page without content
        return None


# ---- detail page -----------------------------------------------------------------------------

DETAIL_TYPE = T.StructType([
    T.StructField("page_text", T.StringType()),
    T.StructField("readme_node", T.StringType()),
    T.StructField("application_tokens", T.ArrayType(STRINGS)),
])


def _detail(page, options):
    readme_id, title = options["readme_id"], options["applications_title"]
    node = page.find(lambda n: n.attrs.get("id") == readme_id) or page.find(
        lambda n: n.name == "section" and readme_id in (page.sole_string(n) or "").lower()
    )
    tokens = []
    for heading in page.nodes:
        if heading.name != "h2" or (page.sole_string(heading) or "").strip() != title:
            continue
        block = page.nodes[heading.parent]
        while block.parent is not None and block.name not in ("section", "div"):
            block = page.nodes[block.parent]
        if block.parent is not None:
            tokens.append([s for s in page.stripped(block) if s != title])
    return {
        "page_text": "\n".join(page.strings(page.nodes[0])),
        "readme_node": None if node is None else "\n".join(page.strings(node)),
        "application_tokens": tokens,
    }


# ---- sections for prompts --------------------------------------------------------------------

SECTION_TYPE = T.StructType([
    T.StructField("main_text", T.StringType()),
    T.StructField("full_text", T.StringType()),
    T.StructField("headed_texts", STRINGS),
])


def _sections(page, options):
    by_id = re.compile(options["main_id"], re.I)
    by_class = re.compile(options["main_class"], re.I)
    word = options["heading_word"]
    main = (
        page.find(lambda n: "id" in n.attrs and by_id.search(n.attrs["id"]))
        or page.find(lambda n: "class" in n.attrs and by_class.search(n.attrs["class"]))
        or page.find(lambda n: n.name == "article")
        or page.find(lambda n: n.name == "main")
    )
    texts = []
    for i, heading in enumerate(page.nodes):
        if heading.name not in ("h2", "h3") or word not in "".join(page.stripped(heading)).lower():
            continue
        j, stop = heading.end, page.nodes[heading.parent].end
        while j < stop:
            sibling = page.nodes[j]
            if sibling.name in ("h2", "h3"):
                break
            text = "".join(page.stripped(sibling))
            if text:
                texts.append(text)
            j = sibling.end
    return {
        "main_text": None if main is None else " ".join(page.stripped(main)),
        "full_text": " ".join(page.stripped(page.nodes[0])),
        "headed_texts": texts,
    }


# ---- listing page ----------------------------------------------------------------------------

ANCHOR_TYPE = T.StructType([
    T.StructField("pos", T.IntegerType()),
    T.StructField("href", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("badges", STRINGS),
])


def _anchors(page, options):
    prefix, badge, part = options["prefix"], options["badge_class"], options["badge_class_part"]
    out = []
    for i, link in enumerate(page.nodes):
        if link.name != "a" or not link.attrs.get("href", "").startswith(prefix):
            continue
        inner = page.nodes[i + 1:link.end]

        def first_text(name):
            node = next((n for n in inner if n.name == name), None)
            return None if node is None else "".join(page.stripped(node))

        spans = [n for n in inner if n.name == "span"]
        marked = [n for n in spans if badge in n.attrs.get("class", "").split()] or [
            n for n in spans if part in n.attrs.get("class", "")
        ]
        out.append({
            "pos": len(out),
            "href": link.attrs["href"],
            "title": first_text("h2"),
            "description": first_text("p"),
            "text": "".join(page.strings(link)),
            "badges": ["".join(page.stripped(n)) for n in marked],
        })
    return out


_READERS = {"detail": _detail, "sections": _sections, "anchors": _anchors}
_TYPES = {
    "detail": DETAIL_TYPE, "sections": SECTION_TYPE, "anchors": T.ArrayType(ANCHOR_TYPE),
}


def _arrow(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.StructType):
        return pa.struct([pa.field(f.name, _arrow(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    return pa.int32() if isinstance(kind, T.IntegerType) else pa.string()


def in_parts(batch: pa.Array, most: int) -> Iterator[pa.Array]:
    """A batch in parts of about ``most`` bytes, whatever its rows and their lengths, so that what is
    read from it is never held whole."""
    lengths = pc.fill_null(pc.binary_length(batch), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths, dtype=np.int64) // most
    bounds = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(batch)]
    for start, end in pairwise(bounds):
        yield batch.slice(start, end - start)


def _bounded(batch: pa.Array) -> Iterator[pa.Array]:
    return in_parts(batch, BYTES_AT_ONCE)


def read_page(markup: Column, wanted: tuple[str, ...], **options) -> Column:
    """Struct with one field per reader in ``wanted``; all of them share one pass over the page.

    A NULL or empty page gives NULL fields. The result counts as non-deterministic to the
    optimizer, which keeps a filter on it from running the pass a second time.
    """
    kind = T.StructType([T.StructField(w, _TYPES[w]) for w in wanted])
    out_type = _arrow(kind)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for some in _bounded(batch):
                rows = []
                for value in some:
                    page = _parse(value.as_py())
                    rows.append(
                        {w: None if page is None else _READERS[w](page, options) for w in wanted})
                yield pa.array(rows, out_type)

    return F.arrow_udf(run, kind).asNondeterministic()(markup)
