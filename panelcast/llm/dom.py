"""A small forgiving HTML reader: block elements and the text runs between them.

Block elements become nodes of a tree; inline elements are transparent (links
are remembered per character). Each stretch of text between two block borders
is a leaf. Tags may be unclosed, crossed or cut off.
"""

from __future__ import annotations

import html
import re
from collections import Counter

#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose inside is never text of the page.
SILENT = "script style title textarea noscript template iframe svg math select object canvas audio video button"
#: Inline elements: text runs through them.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter nobr output "
                   "progress q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
#: A start tag ends these open elements, up to the nearest of the elements after the bar.
ENDS = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "td": ("td th", "tr table"),
        "th": ("td th", "tr table"), "tr": ("td th tr", "table"), "tbody": ("td th tr tbody thead tfoot", "table"),
        "tfoot": ("td th tr tbody thead tfoot", "table")}
ENDS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in ENDS.items()}
TEXT = "#text"

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + SILENT.replace(" ", "|") + r")\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:_-]*)(?P<attrs>(?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][a-zA-Z0-9:_-]*)(?P<attrs2>[^>]*)>|<[!?/][^>]*>|<[a-zA-Z/!?][^>]*\Z", re.S | re.I)


class Page:
    """Nodes in page order: ``parent`` (-1 for the root), ``name`` (TEXT for
    text leaves), ``attrs`` of elements, ``text`` and ``linked`` (characters
    inside links) of leaves."""

    def __init__(self, source: str):
        self.parent, self.name, self.attrs, self.text, self.linked = [-1], ["html"], [""], [""], [0]
        self._stack, self._open = [0], Counter()
        pieces: list[str] = []
        linked = in_link = 0

        def flush():
            nonlocal linked
            if pieces:
                text = " ".join("".join(pieces).split())
                if text:
                    self._add(TEXT, "", text, min(linked, len(text)))
                pieces.clear()
            linked = 0

        def take(a, b):
            nonlocal linked
            if a < b:
                s = source[a:b]
                s = html.unescape(s) if "&" in s else s
                pieces.append(s)
                if in_link:
                    linked += len(s)

        at = 0
        for m in _TOKEN.finditer(source):
            take(at, m.start())
            at = m.end()
            name = m["name"] or m["name2"]
            if name is None:
                if m["raw"] and m["raw"].lower() != "script":
                    pieces.append(" ")
                continue
            name = name.lower()
            end = m["end"] or m["end2"]
            if name in INLINE:
                if name == "a":
                    in_link = 0 if end else 1
            elif name == "br":
                pieces.append(" ")
            elif name == "hr":
                flush()
            elif name in VOID:
                continue
            elif end:
                flush()
                if self._open[name]:
                    self._close_to(name)
                    in_link = 0
            else:
                flush()
                in_link = 0
                self._make_room(name)
                if name == "html" or name == "body" and self._open[name]:
                    if name == "html":
                        self.attrs[0] = self.attrs[0] or m["attrs"] or ""
                    continue
                self._stack.append(self._add(name, m["attrs"] or m["attrs2"] or "", "", 0))
                self._open[name] += 1
        take(at, len(source))
        flush()

    def _add(self, name, attrs, text, linked) -> int:
        self.parent.append(self._stack[-1])
        self.name.append(name)
        self.attrs.append(attrs)
        self.text.append(text)
        self.linked.append(linked)
        return len(self.parent) - 1

    def _close_to(self, name):
        while True:
            top = self.name[self._stack.pop()]
            self._open[top] -= 1
            if top == name:
                return

    def _make_room(self, name):
        """Elements that a start tag ends although they have no end tag."""
        if self.name[self._stack[-1]] == "p":
            self._close_to("p")
        ends, stop = ENDS.get(name, ((), ()))
        if not any(self._open[x] for x in ends):
            return
        for k in range(len(self._stack) - 1, 0, -1):
            top = self.name[self._stack[k]]
            if top in stop:
                break
            if top in ends:
                for _ in range(len(self._stack) - k):
                    self._open[self.name[self._stack.pop()]] -= 1
