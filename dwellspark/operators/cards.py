"""From landed pages to links and the cards around them.

This is the one step that needs a document tree, so it runs Python over Arrow batches, one pass over each page.  The
tree is a flat table: every element covers a run of the page's text pieces and of its images, so the text of any
ancestor is a slice.  Everything after this step is column expressions.

Scripts, styles, templates and comments hold no text; void elements hold nothing; an end tag closes up to the nearest
open element of its name and is ignored if there is none; what is left open ends with the page.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame

from .portals import BY_NAME, Portal

VOID = frozenset("area base br col embed hr img input keygen link menuitem meta param source track wbr".split())
SILENT = frozenset(("script", "style", "template"))
#: Tags without anything that the parser has a rule for: quoted values without references, no element of raw text.
PLAIN_START = re.compile(r"""<(?!(?:script|style|textarea|title|iframe|noembed|noframes|noscript|plaintext|xmp)\b)([a-z][a-z0-9]*)((?: [a-z][a-z-]*="[^"<>&]*")*)>""")
PLAIN_VALUE = re.compile(r""" ([a-z-]+)="([^"]*)\"""")
PLAIN_END = re.compile(r"</([a-z][a-z0-9]*)>")


class Page(HTMLParser):
    """The page's text pieces, images, and its elements as (parent, first and end text, first and end image)."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.texts: list[str] = []
        self.images: list[dict] = []
        self.elements: list[list[int]] = [[-1, 0, 0, 0, 0]]
        self.links: list[tuple[int, str]] = []
        self.open: list[tuple[str, int]] = [("", 0)]
        self.piece: list[str] = []
        self.feed(html)
        self.close()
        self._flush()
        while self.open:
            self._end()

    def updatepos(self, i: int, j: int) -> int:
        """Line numbers, which nobody asks for, are not counted."""
        return j

    def parse_starttag(self, i: int) -> int:
        """Plain tags are read by one pattern, all others by the parser's rules."""
        if not (plain := PLAIN_START.match(self.rawdata, i)):
            return super().parse_starttag(i)
        self.lasttag, values = plain.groups()
        self.handle_starttag(self.lasttag, PLAIN_VALUE.findall(values) if values else [])
        return plain.end()

    def parse_endtag(self, i: int) -> int:
        if self.cdata_elem is not None or not (plain := PLAIN_END.match(self.rawdata, i)):
            return super().parse_endtag(i)
        self.handle_endtag(plain[1])
        return plain.end()

    def _flush(self) -> None:
        if not self.piece:
            return
        text = "".join(self.piece).strip()
        self.piece = []
        if text and not any(name in SILENT for name, _ in self.open):
            self.texts.append(text)

    def _end(self) -> None:
        _, at = self.open.pop()
        self.elements[at][2], self.elements[at][4] = len(self.texts), len(self.images)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._flush()
        at = len(self.elements)
        self.elements.append([self.open[-1][1], len(self.texts), 0, len(self.images), 0])
        if tag in ("a", "img"):
            found = {k: v or "" for k, v in reversed(attrs)}
            if tag == "img":
                self.images.append({"src": found.get("src"), "data_src": found.get("data-src")})
            elif "href" in found:
                self.links.append((at, found["href"]))
        self.open.append((tag, at))
        if tag in VOID:
            self._end()

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._end()

    def handle_endtag(self, tag: str) -> None:
        self._flush()
        if tag in VOID:
            return
        if self.open[-1][0] == tag or any(name == tag for name, _ in self.open[1:]):
            while self.open[-1][0] != tag:
                self._end()
            self._end()

    def handle_data(self, data: str) -> None:
        self.piece.append(data)

    def handle_comment(self, data: str) -> None:
        self._flush()

    def text(self, element: int, joint: str = " ") -> str:
        _, first, end, _, _ = self.elements[element]
        return joint.join(self.texts[first:end])


def card_of(page: Page, element: int, portal: Portal, mention: re.Pattern, told: dict[int, tuple[int, int]]) -> int | None:
    """The element that is the listing's card; None if no ancestor qualifies.

    ``told`` keeps what was counted for the page's elements, which its links share: mentions, up to one too many, and
    characters.
    """
    best = None
    for _ in range(portal.max_levels):
        element = page.elements[element][0]
        if element < 0:
            break
        if element not in told:
            text = page.text(element)
            told[element] = (sum(1 for _ in islice(mention.finditer(text), portal.max_mentions + 1)), len(text))
        mentions, chars = told[element]
        if mentions > portal.max_mentions:
            return best if portal.largest else None
        if mentions and chars <= portal.max_text:
            best = element
            if not portal.largest:
                break
    return best


def anchors(pages: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """keys, pos, href, anchor_text of every link of every page, in document order."""
    names = [*keys, "pos", "href", "anchor_text"]
    types = {f.name: f.dataType.simpleString() for f in pages.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r, html in enumerate(batch.column(len(keys)).to_pylist()):
                page = Page(html or "")
                rows += [(r, pos, href, page.text(element)) for pos, (element, href) in enumerate(page.links)]
            at = pa.array([x[0] for x in rows], pa.int64())
            columns = [batch.column(i).take(at) for i in range(len(keys))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([x[1] for x in rows], pa.int32()), *(pa.array([x[i] for x in rows], pa.string()) for i in (2, 3))], names=names)

    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), "pos int", "href string", "anchor_text string"])
    return pages.select(*keys, html).mapInArrow(run, schema)


CARD = "portal string, run_id string, page_num int, fetched_at timestamp, pos int, key string, href string, anchor_text string, has_card boolean, card_text string, card_lines string, images array<struct<src: string, data_src: string>>"


def cards(pages: DataFrame, every_page: bool = False) -> DataFrame:
    """A row for each link to a listing (see CARD); ``has_card`` is false, and the card null, where none qualifies.

    With ``every_page`` a page without such links is a row without ``pos``, whose ``has_card`` is null if the fetch failed.
    """
    image = pa.struct([("src", pa.string()), ("data_src", pa.string())])
    types = (pa.int32(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.string(), pa.string(), pa.list_(image))
    names = [c.split()[0] for c in CARD.split(", ")][:12]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = {n: (re.compile(p.link), re.compile(p.mention)) for n, p in BY_NAME.items() if p.link}
        for batch in batches:
            rows, at = [], []
            for r, (portal, html) in enumerate(zip(batch.column(0).to_pylist(), batch.column(4).to_pylist(), strict=True)):
                if portal not in patterns or html is None:
                    if every_page:
                        at.append(r)
                        rows.append((None,) * len(types))
                    continue
                before, spec, (link, mention) = len(rows), BY_NAME[portal], patterns[portal]
                page, told = Page(html), {}
                for pos, (element, href) in enumerate(page.links):
                    if not (found := link.search(href)):
                        continue
                    card = card_of(page, element, spec, mention, told)
                    at.append(r)
                    whole = (None, None, None) if card is None else (page.text(card), page.text(card, "\n"), page.images[page.elements[card][3] : page.elements[card][4]])
                    rows.append((pos, found[spec.key_group], href, page.text(element), card is not None, *whole))
                if every_page and len(rows) == before:
                    at.append(r)
                    rows.append((None, None, None, None, False, None, None, None))
            take = pa.array(at, pa.int64())
            columns = [batch.column(i).take(take) for i in range(4)]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array([x[i] for x in rows], t) for i, t in enumerate(types))], names=names)

    return pages.select("portal", "run_id", "page_num", "fetched_at", "html").mapInArrow(run, CARD)
