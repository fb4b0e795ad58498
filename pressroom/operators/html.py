"""The few facts an article page gives: title, publish time, exclude tag."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F

VOID_ELEMENTS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)


class PageFacts(HTMLParser):
    """One pass over a page with a stack of open elements."""

    def __init__(self, title_path: tuple[str, ...]):
        super().__init__(convert_charrefs=True)
        self.title_path = title_path
        self.open: list[str] = []
        self.title: list[str] | None = None
        self.title_depth: int | None = None
        self.published: str | None = None
        self.saw_published = False
        self.primary_depth: int | None = None
        self.saw_primary = False
        self.excluded = False

    def _title_starts(self, tag: str) -> bool:
        *outer, last = self.title_path
        if self.title is not None or tag != last:
            return False
        above = iter(self.open)
        return all(name in above for name in outer)

    def handle_starttag(self, tag, attrs):
        # of repeated attributes the last one counts
        values = {name: value or "" for name, value in attrs}
        inside_primary = self.primary_depth is not None
        if inside_primary and "tag-exclude" in values.get("class", "").split():
            self.excluded = True
        if tag == "meta" and not self.saw_published and values.get("property") == "article:published_time":
            self.saw_published = True
            self.published = values.get("content")
        if tag in VOID_ELEMENTS:
            return
        starts_title = self._title_starts(tag)
        self.open.append(tag)
        if starts_title:
            self.title, self.title_depth = [], len(self.open)
        if not self.saw_primary and values.get("id") == "primary":
            self.saw_primary, self.primary_depth = True, len(self.open)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_ELEMENTS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag not in self.open:
            return
        while self.open.pop() != tag:
            pass
        if self.title_depth is not None and len(self.open) < self.title_depth:
            self.title_depth = None
        if self.primary_depth is not None and len(self.open) < self.primary_depth:
            self.primary_depth = None

    def handle_data(self, data):
        if self.title_depth is not None and not {"script", "style"} & set(self.open[self.title_depth :]):
            self.title.append(data)


def page_facts(body, *title_path: str):
    """Struct column ``(title, published, excluded)`` of an HTML column; ``title`` is NULL
    when no element matches ``title_path`` (outer to inner, as in ``header h1``). A page the
    parser cannot read has no title, whatever stood before the damage."""

    @F.pandas_udf("title string, published string, excluded boolean")
    def facts(pages: pd.Series) -> pd.DataFrame:
        rows = []
        for page in pages:
            parser = PageFacts(title_path)
            try:
                parser.feed(page or "")
                parser.close()
            except (AssertionError, ValueError):  # damaged declarations
                rows.append((None, None, False))
                continue
            title = None if parser.title is None else "".join(parser.title).strip()
            rows.append((title, parser.published, parser.excluded))
        return pd.DataFrame(rows, columns=["title", "published", "excluded"])

    return facts(body)
