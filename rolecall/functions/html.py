"""One Python pass over page HTML: text, title, embedded JSON, links and sections.

Spark has no HTML reader, so this is the one place where Python sees row data. Each
page is scanned once and only the facets a job asks for are returned. Pages go to Python a
hundred at a time, however the session bounds Arrow batches, so a worker never holds thousands.
"""

from __future__ import annotations

import re
import sys
from html import unescape

from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from rolecall.functions import constants as K

# executors need no installed copy of this package: the pass travels with the task, so
# task code below may use this module's own names only, none of another module here
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_STOP, _BREAK = re.compile("[\"'>]"), re.compile(r"[\s/>]")
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_RAW = {name: re.compile(rf"</{name}\s*/?>|\Z", re.I) for name in ("script", "style", "textarea", "title")}
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# text inside these is never page text
_SILENT = frozenset(["template", "rt", "rp"])
# an end tag closes open elements up to its own, but not past a stronger one
_STRENGTH = {
    "p": 10, "div": 150, "td": 160, "th": 160, "tr": 170, "thead": 180, "tbody": 180,
    "tfoot": 180, "table": 190, "head": 200, "body": 200, "html": 220,
}
_NOISE = frozenset(K.NOISE_TAGS)
_SECTION_NOISE = frozenset(K.SECTION_NOISE_TAGS)
_SECTION_CLASSES = tuple(K.SECTION_CLASSES)

FACETS = {
    "text": "string",
    "title": "string",
    "jsonld": "string",
    "links": "array<struct<href:string,text:string,css:string>>",
    "sections": "array<string>",
}


def _attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), unescape(double or single or bare))
    return found


def clean_lines(pieces: list[str]) -> str:
    """Text nodes on lines of their own, trimmed, blank lines dropped."""
    lines = (line.strip() for line in "\n".join(pieces).splitlines())
    return "\n".join(line for line in lines if line)


class _Page:
    """State of one scan: open elements and what was gathered so far."""

    def __init__(self) -> None:
        self.open: list[tuple[str, object]] = []
        # where elements of each name and of each strength stand in the list above
        self.places: dict[str, list[int]] = {}
        self.strong: dict[int, list[int]] = {}
        # open elements of each kind, kept in step with the list above
        self.silent = self.noise = self.section_noise = 0
        self.link: dict | None = None
        self.inside: list[list[str]] = []
        self.text: list[str] = []
        self.title: str | None = None
        self.jsonld: str | None = None
        self.links: list[dict] = []
        self.sections: list[list[str]] = []

    def push(self, name: str, sink: object) -> None:
        at = len(self.open)
        self.open.append((name, sink))
        self.places.setdefault(name, []).append(at)
        self.strong.setdefault(_STRENGTH.get(name, 100), []).append(at)
        if isinstance(sink, list):
            self.inside.append(sink)
        self._count(name, 1)

    def pop(self) -> None:
        name, sink = self.open.pop()
        self.places[name].pop()
        self.strong[_STRENGTH.get(name, 100)].pop()
        if isinstance(sink, list):
            self.inside.pop()
        elif sink is not None and sink is self.link:
            self.link = None
        self._count(name, -1)

    def _count(self, name: str, step: int) -> None:
        if name in _NOISE:
            self.noise += step
            if name in _SECTION_NOISE:
                self.section_noise += step
        elif name in _SILENT:
            self.silent += step

    def add_text(self, text: str) -> None:
        if self.silent:
            return
        if not self.noise:
            self.text.append(text)
        if self.link is not None:
            self.link["parts"].append(text)
        if self.inside and not self.section_noise:
            for sink in self.inside:
                sink.append(text)

    def start(self, name: str, source: str) -> None:
        sink: object = None
        if name in ("p", "a", "li", "option") and self.open and self.open[-1][0] == name:
            self.pop()
        if name == "a":
            # links do not nest: a new one ends the text of the one before
            self.link = None
            attributes = _attributes(source)
            if "href" in attributes:
                sink = {"href": attributes["href"], "css": attributes.get("class", ""), "parts": []}
                self.links.append(sink)
                self.link = sink
        elif name == "div" and source and not self.section_noise:
            css = " ".join(_attributes(source).get("class", "").split())
            if all(c in css for c in _SECTION_CLASSES):
                sink = []
                self.sections.append(sink)
        if name not in _VOID:
            self.push(name, sink)

    def end(self, name: str) -> None:
        own = self.places.get(name)
        if not own:
            return
        strength = _STRENGTH.get(name, 100)
        if any(s > strength and at and at[-1] > own[-1] for s, at in self.strong.items()):
            return
        for _ in range(len(self.open) - own[-1]):
            self.pop()


class _Marks:
    """Markup of a page from front to back, in one forward pass.

    What is searched ahead is remembered, and so are the places from which no tag can end, so text
    is not searched again from every opening bracket.
    """

    def __init__(self, html: str) -> None:
        self.html = html
        self.ahead: dict[object, int] = {}
        self.dead: set[int] = set()

    def _next(self, what: object, at: int) -> int:
        """First place from ``at`` on, or -1; asked for with growing ``at``."""
        known = self.ahead.get(what, -2)
        if known == -1 or known >= at:
            return known
        if isinstance(what, str):
            found = self.html.find(what, at)
        else:
            match = what.search(self.html, at)
            found = match.start() if match else -1
        self.ahead[what] = found
        return found

    def _tag_end(self, at: int) -> int:
        """Place of the bracket that ends a tag, quoted ones aside; -1 when none does."""
        seen = []
        stop = self._next(_STOP, at)
        while stop >= 0 and stop not in self.dead:
            if self.html[stop] == ">":
                return stop
            seen.append(stop)
            close = self.html.find(self.html[stop], stop + 1)
            if close < 0:
                break
            match = _STOP.search(self.html, close + 1)
            stop = match.start() if match else -1
        self.dead.update(seen)
        return -1

    def after(self, at: int) -> tuple[int, int, str, str, bool] | None:
        """(start, end, name, attributes, closing) of the next markup; comments have no name."""
        html = self.html
        start = html.find("<", at)
        while start >= 0:
            head = html[start + 1 : start + 2]
            if html.startswith("<!--", start):
                end = html.find("-->", start + 4)
                return start, len(html) if end < 0 else end + 3, "", "", False
            if head in ("!", "?"):
                end = self._next(">", start + 2)
                if end >= 0:
                    return start, end + 1, "", "", False
            closing = head == "/"
            begin = start + 1 + closing
            if html[begin : begin + 1].isascii() and html[begin : begin + 1].isalpha():
                name_end = self._next(_BREAK, begin)
                end = self._tag_end(name_end) if name_end >= 0 else -1
                if end >= 0:
                    return start, end + 1, html[begin:name_end].lower(), html[name_end:end], closing
            start = html.find("<", start + 1)
        return None


def scan(html: str) -> _Page:
    page, marks, at = _Page(), _Marks(html), 0
    while True:
        mark = marks.after(at)
        if mark is None:
            if at < len(html):
                page.add_text(unescape(html[at:]))
            return page
        start, end, name, source, closing = mark
        if start > at:
            page.add_text(unescape(html[at:start]))
        at = end
        if not name:
            continue
        if closing:
            page.end(name)
            continue
        page.start(name, source)
        if name in _RAW:
            close = _RAW[name].search(html, at)
            inner = html[at:close.start()]
            if name == "title" and page.title is None:
                page.title = unescape(inner).strip()
            if name == "script" and page.jsonld is None:
                if _attributes(source).get("type") == "application/ld+json":
                    page.jsonld = inner
            if inner and name in ("title", "textarea"):
                page.add_text(unescape(inner))
            at = close.end()
            page.end(name)


def _facets(html: str | None, wanted: tuple[str, ...], decode: bool) -> dict:
    page = scan((unescape(html) if decode else html) if html else "")
    out: dict = {}
    if "text" in wanted:
        out["text"] = clean_lines(page.text)
    if "title" in wanted:
        out["title"] = page.title
    if "jsonld" in wanted:
        out["jsonld"] = page.jsonld
    if "links" in wanted:
        out["links"] = [
            {"href": a["href"], "text": " ".join(a["parts"]).strip(), "css": a["css"]}
            for a in page.links
        ]
    if "sections" in wanted:
        out["sections"] = ["\n".join(parts).strip() for parts in page.sections]
    return out


def page_facets(html: Column, *wanted: str, decode: bool = False) -> Column:
    """struct of the wanted facets; ``decode`` unescapes entity-encoded HTML first."""
    schema = ",".join(f"{name}:{FACETS[name]}" for name in wanted)

    one_pass = F.udf(lambda page: _facets(page, wanted, decode), f"struct<{schema}>", useArrow=False)
    return one_pass(html)
