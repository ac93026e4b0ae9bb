"""Office documents and numbered catalogues as rows."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame

#: Names of the document's parts and its elements.
BODY = "word/document.xml"
PARAGRAPH = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}p"
TEXT = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}t"
MOST_FILES, MOST_BYTES, MOST_RATIO = 2_000, 64 << 20, 200

ITEM = re.compile(r"^\s*([0-9]{1,3})[\s.、]+(\S.*)$")
URL = re.compile(r"(https?://\S*|www\.\S*)$")
PAGE = re.compile(r"^\s*[-—]?\s*(?:第\s*)?([0-9]{1,3})\s*(?:页)?\s*[-—]?\s*$")


def paragraphs(content: bytes) -> tuple[str, list[str]]:
    """("success", paragraphs) of a .docx file, or ("failed: why", []). Archives that unpack to too much are refused."""
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            parts = archive.infolist()
            size = sum(x.file_size for x in parts)
            if len(parts) > MOST_FILES or size > MOST_BYTES or size > MOST_RATIO * max(1, sum(x.compress_size for x in parts)):
                return "failed: too large unpacked", []
            raw = archive.read(BODY)
        if b"<!DOCTYPE" in raw or b"<!ENTITY" in raw:
            return "failed: entities", []
        found = ("".join(t.text or "" for t in p.iter(TEXT)).strip() for p in ElementTree.fromstring(raw).iter(PARAGRAPH))
        return "success", [p for p in found if p]
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError, ValueError, EOFError, OSError) as error:
        return f"failed: {type(error).__name__}", []


def docx(files: DataFrame) -> DataFrame:
    """path, status, paragraphs of rows of the binaryFile source. A file that can't be read is a row with its reason."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [paragraphs(x or b"") for x in batch.column("content").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.list_(pa.string()))], names=["path", "status", "paragraphs"])

    return files.select("path", "content").mapInArrow(run, "path string, status string, paragraphs array<string>")


def parse_items(lines: list[str]) -> list[dict]:
    """Numbered items of a catalogue whose lines may wrap: {no, name, url, page, warnings}.

    A number opens an item only if it follows the last one, or skips one with a warning; any other is taken for text.
    A URL may go on in the next line; other text goes on with the name. A line of nothing but a number that doesn't
    follow is a page's.
    """
    items: list[dict] = []
    page, last = 1, 0
    for line in lines:
        opened = ITEM.match(line)
        if opened and int(opened[1]) in (last + 1, last + 2):
            number, rest = int(opened[1]), opened[2].strip()
            url = URL.search(rest)
            items.append({"no": number, "name": rest[: url.start()].strip() if url else rest, "url": url[1] if url else "", "page": page, "warnings": [f"skipped {last + 1}"] if number == last + 2 else []})
            last = number
        elif PAGE.match(line) and line.strip():
            page = int(PAGE.match(line)[1]) + 1
        elif line.strip() and items:
            now, text = items[-1], line.strip()
            url = URL.search(text)
            if now["url"] and re.fullmatch(r"[!-~]+", text):
                now["url"] += text
                now["warnings"].append("wrapped url")
            elif url:
                now["name"] += text[: url.start()].strip()
                now["url"] = now["url"] or url[1]
            else:
                now["name"] += text
    return items


def catalogue(files: DataFrame) -> DataFrame:
    """no, name, url, page, warnings of the items of whole text files (path, value); one file a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, value in zip(batch.column("path").to_pylist(), batch.column("value").to_pylist(), strict=True):
                items = parse_items((value or "").splitlines())
                arrays = [pa.array([path] * len(items), pa.string()), *(pa.array([i[k] for i in items], t) for k, t in (("no", pa.int32()), ("name", pa.string()), ("url", pa.string()), ("page", pa.int32()), ("warnings", pa.list_(pa.string()))))]
                yield pa.RecordBatch.from_arrays(arrays, names=["path", "no", "name", "url", "page", "warnings"])

    return files.select("path", "value").mapInArrow(run, "path string, no int, name string, url string, page int, warnings array<string>")
