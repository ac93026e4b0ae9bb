"""HTML pages as structured records, by a tolerant parser over Arrow batches."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

#: Elements without an end tag, elements whose text isn't content, and elements that end a paragraph.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
SKIP = {"script", "style", "nav", "footer", "aside", "noscript", "template"}
BLOCK = {"p", "div", "li", "h1", "h2", "h3", "h4", "h5", "h6", "td", "th", "blockquote", "pre", "section"}


class Page(HTMLParser):
    """title, headings, paragraphs, tables (rows of cells), links, images. Unclosed and unmatched tags do no harm.

    Where the page has an article element, only what is inside counts, but for the title.
    """

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.title, self.headings, self.paragraphs, self.tables, self.links, self.images = "", [], [], [], [], []
        self.skip, self.open, self.text, self.href, self.scoped = 0, [], [], None, "<article" in html
        self.inside, self.row = 0, None
        self.feed(html)
        self.close()
        self.flush("p")

    def counts(self) -> bool:
        return not self.skip and (self.inside > 0 or not self.scoped)

    def flush(self, tag: str) -> None:
        text = " ".join("".join(self.text).split())
        self.text = []
        if not text:
            return
        if self.row is not None and tag in ("td", "th"):
            self.row.append(text)
        else:
            (self.headings if tag[0] == "h" and tag[1:].isdigit() else self.paragraphs).append(text)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        found = dict(attrs)
        if tag not in VOID:
            self.open.append(tag)
        if tag in SKIP:
            self.skip += 1
        if tag == "article":
            self.inside += 1
        if not self.counts():
            return
        if tag in BLOCK:
            self.flush("p")
        if tag == "table":
            self.tables.append([])
        elif tag == "tr" and self.tables:
            self.row = []
            self.tables[-1].append(self.row)
        elif tag == "a" and found.get("href"):
            self.links.append(found["href"])
        elif tag == "img" and found.get("src"):
            self.images.append(found["src"])
        elif tag == "br":
            self.text.append("\n")

    def handle_endtag(self, tag: str) -> None:
        if tag not in self.open:
            return
        while self.open:
            last = self.open.pop()
            if last in BLOCK and self.counts():
                self.flush(last)
            if last == "tr":
                self.row = None
            if last in SKIP:
                self.skip -= 1
            if last == "article":
                self.inside -= 1
            if last == tag:
                break

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1] == "title":
            self.title += data
        elif self.counts():
            self.text.append(data)


def articles(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, title, headings, paragraphs, links, images (arrays), tables (number), content_hash of headings, paragraphs
    and tables. A null page is an empty one."""
    strings = pa.list_(pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [Page(x or "") for x in batch.column(1).to_pylist()]
            hashes = [hashlib.sha256(json.dumps([p.headings, p.paragraphs, p.tables], ensure_ascii=False).encode()).hexdigest() for p in made]
            arrays = [batch.column(0), pa.array([" ".join(p.title.split()) for p in made], pa.string()), *(pa.array([list(dict.fromkeys(getattr(p, n)) if n in ("links", "images") else getattr(p, n)) for p in made], strings) for n in ("headings", "paragraphs", "links", "images")), pa.array([len(p.tables) for p in made], pa.int64()), pa.array(hashes, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=[key, "title", "headings", "paragraphs", "links", "images", "tables", "content_hash"])

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(key, html).mapInArrow(run, f"{key} {kind}, title string, headings array<string>, paragraphs array<string>, links array<string>, images array<string>, tables long, content_hash string")
