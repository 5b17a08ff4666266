"""One-pass HTML reader used inside the Spark parse job.

This is the only per-row Python in the HTML path.  It turns one page into
``(title, description, text, hrefs, error)``; everything after that
(whitespace collapsing, Markdown layout, link resolution and filtering) is
done with native Spark Column expressions.

Tree semantics follow the lenient ``html.parser`` tree-building rules that
the extraction contract is defined against:

* tag and attribute names are lower-cased by the stdlib tokenizer;
* a start tag never closes anything implicitly (``<p>`` does not end an open
  ``<p>``); an end tag closes the nearest open element of that name and every
  element opened after it, and is ignored when no such element is open;
* void elements close at once; a later explicit ``</br>`` for one is ignored;
* runs of character data (including decoded entities) form one text node;
  a comment ends the current run and leaves no node behind;
* the document type declaration contributes no text.

Because a node's descendants are exactly the nodes created while it was
open, every element is stored with the half-open index range of its subtree
and "inside X" tests are range tests - no object tree is built.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from html.entities import html5 as _HTML5
from html.parser import HTMLParser

# Element names that close as soon as they open.
VOID_ELEMENTS = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source "
    "track wbr basefont bgsound command frame image isindex nextid spacer".split()
)
# Subtrees dropped before text extraction.  ``linearGradient`` is
# listed by the contract but can never match a lower-cased tag name.
UNWANTED_ELEMENTS = frozenset(
    "script style noscript svg path symbol defs rect circle polygon linearGradient".split()
)
# Text whose direct parent is one of these is skipped.
SKIPPED_PARENTS = frozenset(["script", "style", "meta", "link"])
# Elements that may be a main-content area, and the pattern
# searched (case-insensitively) in their id, then in their class.
CONTENT_ELEMENTS = frozenset(["main", "article", "div", "section"])
CONTENT_PATTERN = re.compile("(content|main|article|post)", re.I)
# Parents whose text ends a paragraph (paragraph mode only).
BLOCK_PARENTS = frozenset("p div li h1 h2 h3 h4 h5 h6 header footer blockquote pre br hr "
                          "table tr section article".split())
# Meta ``name`` values accepted as the page description.
DESCRIPTION_NAMES = ("description", "Description")

# Named character references, accepted with or without the trailing ';'.
_ENTITY = {}
for _k, _v in sorted(_HTML5.items()):
    _ENTITY.setdefault(_k[:-1] if _k.endswith(";") else _k, _v)

_ASCII_SPACE = "\t\n\x0c\r "


class _PageReader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=False)
        # parallel per-node arrays, in document order
        self.kind = []    # 0 = element, 1 = text
        self.value = []   # element name or text
        self.parent = []  # index of parent element, -1 for the document
        self.end = []     # elements: one past the last descendant
        self.attrs = {}   # element index -> attribute dict
        self.stack = []   # open element indices
        self.open_count = {}
        self.closed_voids = Counter()   # void elements already closed, by name
        self.run = []

    def updatepos(self, i, j):
        # line/column tracking is never read here; skipping it saves the
        # newline counting the tokenizer does between every two tokens
        return j

    # -- tree building -------------------------------------------------
    def _flush(self):
        if self.run:
            data = "".join(self.run)
            self.run = []
            if not data.strip(_ASCII_SPACE):
                data = "\n" if "\n" in data else " "
            self.kind.append(1)
            self.value.append(data)
            self.parent.append(self.stack[-1] if self.stack else -1)
            self.end.append(len(self.kind))

    def _open(self, name, attrs):
        self._flush()
        d = {}
        for k, v in attrs:
            d[k] = "" if v is None else v
        i = len(self.kind)
        self.kind.append(0)
        self.value.append(name)
        self.parent.append(self.stack[-1] if self.stack else -1)
        self.end.append(-1)
        self.attrs[i] = d
        self.stack.append(i)
        self.open_count[name] = self.open_count.get(name, 0) + 1
        return i

    def _close(self, name):
        self._flush()
        if not self.open_count.get(name):
            return
        while self.stack:
            i = self.stack.pop()
            nm = self.value[i]
            self.open_count[nm] -= 1
            self.end[i] = len(self.kind)
            if nm == name:
                return

    def handle_starttag(self, tag, attrs, void_close=True):
        self._open(tag, attrs)
        if void_close and tag in VOID_ELEMENTS:
            self._close(tag)
            self.closed_voids[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs, void_close=False)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.closed_voids[tag]:
            self.closed_voids[tag] -= 1
        else:
            self._close(tag)

    def handle_data(self, data):
        self.run.append(data)

    def handle_entityref(self, name):
        self.run.append(_ENTITY.get(name, "&" + name))

    def handle_charref(self, name):
        try:
            cp = int(name[1:], 16) if name[:1] in ("x", "X") else int(name)
        except ValueError:
            cp = -1
        data = None
        if 0 <= cp < 256:
            try:
                data = bytes([cp]).decode("windows-1252")
            except UnicodeDecodeError:
                data = None
        if not data:
            try:
                data = chr(cp)
            except (ValueError, OverflowError):
                data = None
        self.run.append(data or "�")

    def handle_comment(self, data):
        self._flush()

    def handle_decl(self, decl):
        self._flush()

    def handle_pi(self, data):
        self._flush()
        self.run.append(data)
        self._flush()

    def unknown_decl(self, data):
        self._flush()
        self.run.append(data[6:] if data.upper().startswith("CDATA[") else data)
        self._flush()

    def finish(self):
        self.close()
        self._flush()
        n = len(self.kind)
        for i in self.stack:
            self.end[i] = n
        self.stack = []


def _single_string(r: _PageReader, i: int):
    """Text of an element that has exactly one child, followed down.  A first child
    comes right behind its parent, and is the only one if both end together."""
    while i + 1 < r.end[i] == r.end[i + 1]:
        i += 1
        if r.kind[i] == 1:
            return r.value[i]
    return None


def _first(r: _PageReader, name: str, alive=None):
    for i, (k, v) in enumerate(zip(r.kind, r.value)):
        if k == 0 and v == name and (alive is None or alive[i]):
            return i
    return -1


_BLANK_LINE = re.compile(r"\n\s*\n")
_SPACES = re.compile(r"[^\S\n]+")


def paragraphs_of(marked: str) -> str:
    """Paragraph mode: blank lines separate paragraphs; inside one, lines
    and whitespace runs become single spaces; paragraphs are joined by one
    blank line."""
    out = []
    for block in _BLANK_LINE.split(_SPACES.sub(" ", marked)):
        para = " ".join(part.strip() for part in block.split("\n") if part.strip())
        if para:
            out.append(para)
    return "\n\n".join(out)


def _hrefs(r: _PageReader) -> list[str]:
    return [a["href"] for i, a in sorted(r.attrs.items()) if r.value[i] == "a" and "href" in a]


def read_hrefs(html: str) -> list[str]:
    """Every ``<a href>`` of a page, in document order; no text is extracted."""
    r = _PageReader()
    r.feed(html)
    r.finish()
    return _hrefs(r)


# Tokens of markup that leaves no room for error handling.  Attributes are written
# name, name=value or name="value", one space at least before each; a script or
# style ends at its own end tag and holds no comment.
_ATTRIBUTE = r"""\s++([^\s"'<>/=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'=<>`]++))?+"""
_TOKEN = re.compile(
    r"[^<]++|</[a-z][a-z0-9]*+\s*+>|<!--(?:(?!--)[^>])*+(?:(?!--).)*+-->|<!doctype[^<>]*+>"
    rf"|<(script|style)(?:{_ATTRIBUTE})*+>[^<]*+(?:<(?!/\s*\1|!--)[^<]*+)*+</\1\s*>"
    rf"|<(?!script[\s>/]|style[\s>/])([a-z][a-z0-9]*+)((?:{_ATTRIBUTE})*+)\s*+/?+>", re.I | re.S)
_ATTRIBUTES = re.compile(_ATTRIBUTE, re.S)


def scan_hrefs(html: str) -> list[str]:
    """What :func:`read_hrefs` returns, without building a tree: a page that is made of
    well-formed tokens only is scanned for its anchors, any other is read."""
    out, at = [], 0
    for token in _TOKEN.finditer(html):
        if token.start() != at:
            return read_hrefs(html)
        at = token.end()
        if token[4] in ("a", "A"):
            found = None
            for name, value in _ATTRIBUTES.findall(token[5]):
                if name.lower() == "href":
                    found = unescape(value[1:-1] if value[:1] in ('"', "'") else value)
            if found is not None:
                out.append(found)
    return out if at == len(html) else read_hrefs(html)


def read_page(html: str, dedupe_areas: bool = False, keep_paragraphs: bool = False):
    """Parse one page; returns (title, description, text, hrefs).

    ``title`` is None when the page has no usable title; ``text`` is the
    stripped non-blank text pieces joined by one space (whitespace inside the
    pieces is collapsed later, in Spark).  By default an element matching
    both the id and the class rule, and areas nested in other areas, repeat
    their text (the contract's behaviour); ``dedupe_areas`` emits each text
    node at most once, which bounds the output at the page's own size.
    ``keep_paragraphs`` returns body text already cleaned into paragraphs:
    text under block elements ends a paragraph (the contract collapses all
    whitespace instead, so its output is a single line).
    """
    r = _PageReader()
    r.feed(html)
    r.finish()
    kind, value, parent, end, attrs = r.kind, r.value, r.parent, r.end, r.attrs
    n = len(kind)

    hrefs = _hrefs(r)

    title = None
    t = _first(r, "title")
    if t >= 0:
        s = _single_string(r, t)
        if s is not None:
            title = s.strip()

    description = ""
    for i in range(n):
        if kind[i] == 0 and value[i] == "meta" and attrs[i].get("name") in DESCRIPTION_NAMES:
            description = (attrs[i].get("content") or "").strip()
            break

    # drop unwanted subtrees: a node is alive unless inside one
    alive = [True] * n
    i = 0
    while i < n:
        if kind[i] == 0 and value[i] in UNWANTED_ELEMENTS:
            for j in range(i, end[i]):
                alive[j] = False
            i = end[i]
        else:
            i += 1

    def texts(lo, hi, only=None, blocks=False):
        out = []
        for j in range(lo, hi):
            if kind[j] == 1 and alive[j] and (only is None or only[j]):
                p = parent[j]
                if p >= 0 and value[p] in SKIPPED_PARENTS:
                    continue
                s = value[j].strip()
                if s:
                    out.append(s + "\n\n" if blocks and p >= 0 and value[p] in BLOCK_PARENTS else s)
        return out

    areas = []
    for key in ("id", "class"):
        for i in range(n):
            if kind[i] == 0 and alive[i] and value[i] in CONTENT_ELEMENTS:
                v = attrs[i].get(key)
                if v is not None and CONTENT_PATTERN.search(v):
                    areas.append(i)
    pieces = []
    if areas and dedupe_areas:
        covered = [False] * n
        for i in areas:
            for j in range(i + 1, end[i]):
                if not covered[j]:
                    covered[j] = True
        pieces = texts(0, n, covered)
    elif areas:
        for i in areas:
            pieces.extend(texts(i + 1, end[i]))
    else:
        b = _first(r, "body", alive)
        if b >= 0:
            pieces = texts(b + 1, end[b], blocks=keep_paragraphs)
        else:
            pieces = texts(0, n)
    text = " ".join(pieces)
    if keep_paragraphs:
        text = paragraphs_of(text)
    return title, description, text, hrefs
