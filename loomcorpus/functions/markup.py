"""Readable text of HTML, with the standard library's parser in Arrow batches."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import StringType

# Elements whose content is no text of the page.
DROPPED = {"nav", "footer", "script", "style", "header", "aside"}
#: What an element's end adds to the text, and what its start does.
_AFTER = {"li": "\n", "dt": "\n", "dd": "\n"}
_BEFORE = {"li": "- ", "dd": "  "}
#: An open element that a start tag ends, within the nearest of its containers.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"}}
_CONTAINERS = {"ul", "ol", "dl", "table"}


#: Elements without an end tag.
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: How strong an end tag is. It doesn't close an open element that is stronger, so a stray one does nothing.
_STRENGTH = {"p": 10, "div": 150, "td": 160, "th": 160, "tr": 170, "thead": 180, "tbody": 180, "tfoot": 180, "table": 190, "head": 200, "body": 200, "html": 220}


class _Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.open: list[tuple[str, bool]] = []  # the open elements, and whether they are part of the text
        self.skipped = 0  # how many of them are dropped ones
        self.tables = 0
        self.rows: list[list[str]] = []
        self.at: list[int] = []  # rows of the open <tr>
        self.cells: list[list[str]] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if not self.skipped and tag in _CLOSES:
            inner = len(self.open)
            while inner and self.open[inner - 1][0] not in _CONTAINERS:
                inner -= 1
            hit = [i for i in range(inner, len(self.open)) if self.open[i][0] in _CLOSES[tag]]
            if hit:
                self._end(hit[0])
        if tag == "br" and not self.skipped:
            self._text("\n", "")
        if tag not in _VOID:
            self.open.append((tag, not self.skipped and tag not in DROPPED))
            self.skipped += tag in DROPPED
        if self.skipped:
            return
        if tag == "table":
            self.tables += 1
        elif tag == "tr" and self.tables:
            self.at.append(len(self.rows))
            self.rows.append([])
        elif tag in ("td", "th") and self.at:
            self.cells.append([])
        self._text(_BEFORE.get(tag, ""), "")

    def handle_endtag(self, tag: str) -> None:
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                # Elements inside that were left open end with their parent, dropped ones too.
                self._end(at)
                return
            if _STRENGTH.get(self.open[at][0], 100) > _STRENGTH.get(tag, 100):
                return

    def handle_data(self, data: str) -> None:
        if not self.skipped:
            self._text(data, data)

    def _text(self, plain: str, cell: str) -> None:
        if not self.tables:
            self.out.append(plain)
        for open_cell in self.cells:
            open_cell.append(cell)

    def _end(self, at: int) -> None:
        """End the open elements from place ``at`` on, the innermost first."""
        while len(self.open) > at:
            tag, kept = self.open.pop()
            self.skipped -= tag in DROPPED
            if not kept:
                continue
            if tag in ("td", "th") and self.cells and self.at:
                text = re.sub(r"\s+", " ", "".join(self.cells.pop())).strip()
                if text:
                    self.rows[self.at[-1]].append(text)
            elif tag == "tr" and self.at:
                self.at.pop()
            elif tag == "table":
                self.tables -= 1
                if not self.tables:
                    lines = [" | ".join(r) for r in self.rows if r]
                    self.out.append("\n\n" + "\n".join(lines) + "\n\n" if lines else "")
                    self.rows, self.at, self.cells = [], [], []
            self._text(_AFTER.get(tag, ""), "")


def read_html(html: str) -> str:
    """The text of a page: some elements dropped, ``<br>``, ``<li>``, ``<dt>`` and ``<dd>`` as lines, tables as rows of
    ``a | b`` without empty cells, entities resolved, blanks and empty lines collapsed."""
    reader = _Reader()
    reader.feed(html)
    reader.close()
    reader._end(0)
    text = re.sub(r"[ \t]+", " ", "".join(reader.out))
    return re.sub(r"\n{3,}", "\n\n", text).strip()


@arrow_udf(StringType())
def html_text(pages: pa.Array) -> pa.Array:
    """One page at a time: beside the batch, whose bytes Spark bounds, only the texts made so far are held, in Arrow's form."""
    texts = (read_html(page.as_py()) if page.is_valid else None for page in pages)
    return pa.array(texts, pa.string(), size=len(pages))
