"""The main text of a page, by text and link density over its elements, and what it says of itself in its head."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType, StructField, StructType

from loomcorpus.functions.markup import _STRENGTH, _VOID, DROPPED

# Elements that begin a new block of text, and those whose content is never main text.
BLOCKS = {
    "address", "article", "blockquote", "body", "center", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "hr", "html", "li",
    "main", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "th", "thead", "tr", "ul",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
ASIDE = DROPPED | {"button", "form", "iframe", "noscript", "object", "select", "svg", "template", "textarea", "title"}
# Under which names a head states each field, the first that is there counts.
STATED = {
    "title": ["og:title", "twitter:title", "dc.title"],
    "author": ["author", "article:author", "dc.creator", "twitter:creator"],
    "date": ["article:published_time", "date", "dc.date", "datepublished", "pubdate", "og:updated_time"],
    "description": ["description", "og:description", "twitter:description", "dc.description"],
    "site": ["og:site_name", "application-name"],
}
#: Words from which a block with few links counts as running text, and the share of a page's running text that an element
#: must hold to be its main one.
LEAST_WORDS, MAIN_SHARE = 10, 0.6
#: The share of a page's unlinked text that a marked article must hold to be believed.
MARKED_SHARE = 0.3
#: The share of linked characters from which a block is a list of links.
LINKED = 0.4
#: Shorter pages and texts are no articles.
LEAST_PAGE, LEAST_TEXT = 100, 50
FIELDS = ["text", "title", "author", "date", "description", "site"]


class _Blocks(HTMLParser):
    """The blocks of a page: text, linked characters, whether it is a heading, and the numbers of the elements around it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int]] = []
        self.skipped = self.number = self.links = 0
        self.parts: list[str] = []
        self.linked = 0
        self.blocks: list[tuple[str, int, bool, tuple[int, ...]]] = []
        self.meta: dict[str, str] = {}
        self.named: list[str] = []
        self.in_title = False
        self.articles: set[int] = set()

    def _block(self) -> None:
        text = re.sub(r"\s+", " ", "".join(self.parts)).strip()
        if text:
            self.blocks.append((text, self.linked, any(t in HEADINGS for t, _ in self.open), tuple(n for _, n in self.open)))
        self.parts, self.linked = [], 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        stated = dict(attrs)
        if tag == "meta":
            name = (stated.get("property") or stated.get("name") or stated.get("itemprop") or "").lower()
            if name and (stated.get("content") or "").strip():
                self.meta.setdefault(name, stated["content"].strip())
        if tag == "time" and stated.get("datetime"):
            self.meta.setdefault("pubdate", stated["datetime"].strip())
        self.in_title |= tag == "title"
        if tag in BLOCKS or tag == "br":
            self._block()
        if tag in _VOID:
            return
        if tag == "p" and not self.skipped:  # a paragraph ends an open one
            for at in range(len(self.open) - 1, -1, -1):
                if self.open[at][0] == "p":
                    self._end(at)
                    break
                if self.open[at][0] in BLOCKS:
                    break
        self.number += 1
        self.open.append((tag, self.number))
        if tag in ("article", "main"):
            self.articles.add(self.number)
        self.skipped += tag in ASIDE
        self.links += tag == "a"

    def _end(self, at: int) -> None:
        self._block()
        while len(self.open) > at:
            tag, _ = self.open.pop()
            self.skipped -= tag in ASIDE
            self.links -= tag == "a"

    def handle_endtag(self, tag: str) -> None:
        if tag == "title":
            self.in_title = False
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                if tag in BLOCKS or tag in ASIDE:
                    self._end(at)
                else:
                    for inner, _ in self.open[at:]:
                        self.skipped -= inner in ASIDE
                        self.links -= inner == "a"
                    del self.open[at:]
                return
            if _STRENGTH.get(self.open[at][0], 100) > _STRENGTH.get(tag, 100):
                return

    def handle_data(self, data: str) -> None:
        if self.in_title:
            self.named.append(data)
        if not self.skipped:
            self.parts.append(data)
            self.linked += len(data.strip()) if self.links else 0


def _held(blocks: list[tuple]) -> dict[int, int]:
    """The characters of the blocks in each element."""
    held: dict[int, int] = {}
    for text, _, _, around in blocks:
        for n in around:
            held[n] = held.get(n, 0) + len(text)
    return held


def read_page(html: str | None) -> dict[str, str | None]:
    """``FIELDS`` of a page; a text of under ``LEAST_TEXT`` characters is none, and fields that a page doesn't state are null.

    Running text is a block of ``LEAST_WORDS`` words with few links. The main element is the largest one marked as article
    or main, if it holds ``MARKED_SHARE`` of the text, else the innermost that holds ``MAIN_SHARE`` of the running text of
    several elements, else the whole page; of its blocks those count that aren't mostly links, and repeated ones once.
    """
    if html is None or len(html) < LEAST_PAGE:
        return dict.fromkeys(FIELDS)
    page = _Blocks()
    page.feed(html)
    page.close()
    page._block()
    few = [b for b in page.blocks if b[1] <= LINKED * len(b[0])]
    running = [b for b in few if len(b[0].split()) >= LEAST_WORDS]
    # What a page marks as its article is it, if that holds a fair part of the text; else the innermost element with most running text.
    sizes, held = _held(few), _held(running)
    marked = max((n for n in page.articles if n in sizes), key=lambda n: (sizes[n], n), default=None)
    main = None
    if marked is not None and sizes[marked] >= MARKED_SHARE * sum(len(b[0]) for b in few):
        main = marked
    elif len({b[3] for b in running}) > 1:  # numbers rise inwards
        main = max((n for n, size in held.items() if size >= MAIN_SHARE * sum(len(b[0]) for b in running)), default=None)
    if main is not None:
        few = [b for b in few if main in b[3]]
    seen: set[str] = set()
    kept = [b[0] for b in few if not (b[0] in seen or seen.add(b[0]))]
    text = "\n".join(kept)
    found: dict[str, str | None] = {"text": text if len(text) >= LEAST_TEXT else None}
    for field, names in STATED.items():
        found[field] = next((page.meta[n] for n in names if n in page.meta), None)
    heading = next((b[0] for b in page.blocks if b[2]), None)
    found["title"] = found["title"] or re.sub(r"\s+", " ", "".join(page.named)).strip() or heading
    return found


@pandas_udf(StructType([StructField(f, StringType()) for f in FIELDS]))
def main_text(pages: pd.Series) -> pd.DataFrame:
    """``struct(text, title, author, date, description, site)`` of each page, see ``read_page``."""
    return pd.DataFrame([read_page(p) for p in pages], columns=FIELDS)
