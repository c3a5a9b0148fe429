"""Fields of stored HTML pages: title, absolute links, repeated item blocks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame

# fixed values: texts shown when an item has no title or price
NO_TITLE = "(タイトル不明)"
NO_PRICE = "(値段不明)"

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


@dataclass(frozen=True)
class PageSpec:
    """Which elements to read.  A pair is (tag, class or None); ``title_attr`` None means element text."""

    links_in: tuple[str, str | None] = ("div", "side_categories")
    skip_links: int = 1
    item: tuple[str, str | None] = ("article", "product_pod")
    title: tuple[str, str | None] = ("a", None)
    title_attr: str | None = "title"
    price: tuple[str, str | None] = ("p", "price_color")


class PageReader(HTMLParser):
    """Collects the fields of one page in a single pass."""

    def __init__(self, spec: PageSpec):
        super().__init__(convert_charrefs=True)
        self.spec = spec
        self.page_title: str | None = None
        self.links: list[str] = []
        self.items: list[dict[str, str]] = []
        self._open: list[tuple[str, str]] = []
        self._sink: tuple[str, int] | None = None

    def _inside(self, want: tuple[str, str | None]) -> bool:
        return any(tag == want[0] and (want[1] is None or want[1] in names.split()) for tag, names in self._open)

    @staticmethod
    def _is(tag: str, names: str, want: tuple[str, str | None]) -> bool:
        return tag == want[0] and (want[1] is None or want[1] in names.split())

    def handle_starttag(self, tag, attrs):
        values = dict(attrs)
        names = values.get("class") or ""
        if tag not in VOID:
            self._open.append((tag, names))
        if tag == "a" and values.get("href") is not None and self._inside(self.spec.links_in):
            self.links.append(values["href"])
        if tag == "title" and self.page_title is None:
            self.page_title, self._sink = "", ("page", len(self._open))
        if self._is(tag, names, self.spec.item):
            self.items.append({})
        elif self.items and self._inside(self.spec.item):
            item = self.items[-1]
            if "title" not in item and self._is(tag, names, self.spec.title):
                if self.spec.title_attr:
                    item["title"] = values.get(self.spec.title_attr) or NO_TITLE
                else:
                    item["title"], self._sink = "", ("title", len(self._open))
            elif "price" not in item and self._is(tag, names, self.spec.price):
                item["price"], self._sink = "", ("price", len(self._open))

    def handle_endtag(self, tag):
        at = next((i for i in range(len(self._open) - 1, -1, -1) if self._open[i][0] == tag), None)
        if at is None:
            return
        del self._open[at:]
        if self._sink and len(self._open) < self._sink[1]:
            self._sink = None

    def handle_data(self, data):
        if not self._sink:
            return
        field = self._sink[0]
        if field == "page":
            self.page_title += data
        else:
            self.items[-1][field] += data


def extract_page_fields(pages: DataFrame, spec: PageSpec = PageSpec(), key: str = "page_id") -> DataFrame:
    """(page_id, title, links, items) per page; parsing needs no shuffle and keeps one page in memory."""
    kind = pages.schema[key].dataType.simpleString()

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for page, url, html in zip(batch[key], batch["url"], batch["html"]):
                reader = PageReader(spec)
                reader.feed(html or "")
                reader.close()
                rows.append(
                    (
                        page,
                        reader.page_title,
                        [urljoin(url, href) for href in reader.links[spec.skip_links:]],
                        [{"title": i.get("title", NO_TITLE), "price": i.get("price", NO_PRICE)} for i in reader.items],
                    )
                )
            yield pd.DataFrame(rows, columns=[key, "title", "links", "items"])

    schema = f"{key} {kind}, title string, links array<string>, items array<struct<title: string, price: string>>"
    return pages.select(key, "url", "html").mapInPandas(parse, schema)
