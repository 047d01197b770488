"""Find elements in one HTML page: the only Python that runs per row, and only where nesting matters.

A page becomes flat lists in document order (tag, attributes, parent, span of descendants, span of text pieces),
so the text of an element is a slice. Broken markup never raises: an end tag closes the nearest open element
of its name or nothing, and whatever is open at the end of the page closes there.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from html.parser import HTMLParser

# Elements that never have content, and elements whose text is not part of the visible text.
VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen link menuitem meta "
    "nextid param source spacer track wbr".split()
)
HIDDEN = frozenset("script style template rt rp".split())

_PART = re.compile(r"\.(?P<cls>[\w-]+)|#(?P<id>[\w-]+)|\[(?P<attr>[\w-]+)(?:(?P<op>[\^*]?=)'(?P<val>[^']*)')?\]|(?P<tag>[\w-]+)")


class Page(HTMLParser):
    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.tags, self.attrs, self.parents, self.last = [], [], [], []
        self.text_from, self.text_to, self.pieces = [], [], []
        self.by_tag, self.by_class = {}, {}
        self._open, self._open_names, self._buffer, self._hidden = [], {}, [], 0
        try:
            self.feed(html)
            self.close()
        except AssertionError:  # malformed declaration: keep what was read
            pass
        self._flush()
        while self._open:
            self._pop()

    def _flush(self):
        if self._buffer:
            piece = " ".join("".join(self._buffer).split())
            self._buffer = []
            if piece and not self._hidden:
                self.pieces.append(piece)

    def _pop(self):
        node = self._open.pop()
        self.last[node] = len(self.tags) - 1
        self.text_to[node] = len(self.pieces)
        self._open_names[self.tags[node]] -= 1
        self._hidden -= self.tags[node] in HIDDEN

    def handle_starttag(self, tag, attrs):
        self._flush()
        node = len(self.tags)
        attributes = {k: v or "" for k, v in attrs}
        attributes["class"] = classes = attributes.get("class", "").split()
        self.tags.append(tag)
        self.attrs.append(attributes)
        self.parents.append(self._open[-1] if self._open else -1)
        self.last.append(node)
        self.text_from.append(len(self.pieces))
        self.text_to.append(len(self.pieces))
        self.by_tag.setdefault(tag, []).append(node)
        for c in set(classes):
            self.by_class.setdefault(c, []).append(node)
        if tag not in VOID:
            self._open.append(node)
            self._open_names[tag] = self._open_names.get(tag, 0) + 1
            self._hidden += tag in HIDDEN

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._pop()

    def handle_endtag(self, tag):
        self._flush()
        if self._open_names.get(tag):
            while self.tags[self._open[-1]] != tag:
                self._pop()
            self._pop()

    def handle_data(self, data):
        self._buffer.append(data)

    def handle_comment(self, data):
        self._flush()

    def handle_decl(self, decl):
        self._flush()

    def handle_pi(self, data):
        self._flush()

    def unknown_decl(self, data):
        self._flush()
        if data.upper().startswith("CDATA["):
            self._buffer.append(data[6:])
            self._flush()

    def text(self, node):
        return " ".join(self.pieces[self.text_from[node] : self.text_to[node]])

    def _fits(self, node, part):
        attributes = self.attrs[node]
        if part["tag"] and part["tag"] != self.tags[node]:
            return False
        if not part["cls"] <= set(attributes["class"]):
            return False
        for name, op, wanted in part["attrs"]:
            value = attributes.get(name)
            if value is None or (name == "class" and not value):
                return False
            if op == "=" and value != wanted or op == "^=" and not value.startswith(wanted):
                return False
            if op == "*=" and wanted not in value:
                return False
        return True

    def _matches(self, node, steps):
        if not self._fits(node, steps[-1][1]):
            return False
        if len(steps) == 1:
            return True
        parent = self.parents[node]
        if steps[-1][0] == ">":
            return parent >= 0 and self._matches(parent, steps[:-1])
        while parent >= 0:
            if self._matches(parent, steps[:-1]):
                return True
            parent = self.parents[parent]
        return False

    def select(self, selector, scope=-1, first=False):
        """Nodes below ``scope`` (-1: the page) that match, in document order."""
        low, high = (0, len(self.tags) - 1) if scope < 0 else (scope + 1, self.last[scope])
        found = set()
        for steps in compiled(selector):
            part = steps[-1][1]
            if part["cls"]:
                nodes = self.by_class.get(min(part["cls"]), [])
            elif part["tag"]:
                nodes = self.by_tag.get(part["tag"], [])
            else:
                nodes = range(len(self.tags))
            for node in nodes[bisect_left(nodes, low) : bisect_right(nodes, high)]:
                if self._matches(node, steps):
                    found.add(node)
                    if first:
                        break
        return sorted(found)[:1] if first else sorted(found)


_COMPILED = {}


def compiled(selector):
    """``"div.a > b [c*='d'], e"`` → alternatives of (combinator, compound) steps."""
    if selector not in _COMPILED:
        alternatives = []
        for alternative in selector.split(","):
            steps, combinator = [], " "
            for word in alternative.split():
                if word == ">":
                    combinator = ">"
                    continue
                part = {"tag": None, "cls": set(), "attrs": []}
                for m in _PART.finditer(word):
                    if m["cls"]:
                        part["cls"].add(m["cls"])
                    elif m["id"]:
                        part["attrs"].append(("id", "=", m["id"]))
                    elif m["attr"]:
                        part["attrs"].append((m["attr"], m["op"], m["val"]))
                    else:
                        part["tag"] = m["tag"]
                steps.append((combinator, part))
                combinator = " "
            alternatives.append(steps)
        _COMPILED[selector] = alternatives
    return _COMPILED[selector]


def field_values(page, root, field):
    """Values of one field below ``root``: one per candidate selector (null where absent), or all matches.

    With ``longer_than`` only texts of more characters count, and the first such candidate is the only value.
    """
    scope = root
    if field["within"]:
        inside = page.select(field["within"], root, first=True)
        if not inside:
            return [] if field["every"] else [None] * len(field["selectors"])
        scope = inside[0]
    out = []
    for selector in field["selectors"]:
        nodes = page.select(selector, scope, first=not field["every"])
        if field["attribute"]:
            values = [page.attrs[n].get(field["attribute"], "") for n in nodes]
        else:
            values = [page.text(n) for n in nodes]
        if field["longer_than"] is not None:
            values = [v for v in values if len(v) > field["longer_than"]]
            if values and not field["every"]:
                return values
            out += values
        else:
            out += values if field["every"] else values or [None]
    return out


def root_values(page, root, fields):
    row = {}
    for name, field in fields.items():
        skip = field["unless"] and row[field["unless"]]
        row[name] = [] if skip else field_values(page, root, field)
    return row


def page_elements(html, root_selector, fields):
    """One dict of field values per root element; without a root selector the page itself is the only root."""
    page = Page(html)
    roots = [-1] if root_selector is None else page.select(root_selector)
    return [root_values(page, root, fields) for root in roots]
