"""Documents of a lake: listing, text blocks by kind of file, and markup."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Kinds of documents that are read.
SUFFIXES = ("pdf", "docx", "pptx", "txt", "html", "htm", "xml")


#: The first bytes of kinds of files, in hexadecimal.
MAGIC = {"pdf": "25504446", "doc": "D0CF11E0", "ppt": "D0CF11E0", "docx": "504B0304", "pptx": "504B0304", "dotx": "504B0304"}


def is_of_kind(content: Column, kind: Column) -> Column:
    """Whether a file begins as its kind does (a lost file is often answered by a page); kinds without such bytes pass."""
    known = F.create_map(*[F.lit(x) for pair in MAGIC.items() for x in pair])
    wanted = F.try_element_at(known, F.lower(kind))
    return wanted.isNull() | F.coalesce(F.hex(F.substring(content, 1, 4)) == wanted, F.lit(False))


def list_documents(spark: SparkSession, path: str, categories: list[str] | None = None) -> DataFrame:
    """(path, source, doc_id, doc_type, length, modified): documents below category folders, without runs' own folders."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", F.col("modificationTime").alias("modified"))
    kind = F.lower(F.regexp_extract("path", r"\.([A-Za-z]+)$", 1))
    parts = F.split("path", "/")
    named = files.select("path", F.element_at(parts, -2).alias("source"), F.md5("path").alias("doc_id"), kind.alias("doc_type"), "length", "modified")
    named = named.filter(F.col("doc_type").isin(*SUFFIXES) & ~F.col("path").contains("/_runs/") & (F.col("length") > 0))
    if categories:
        named = named.filter(F.col("path").rlike("/(" + "|".join(categories) + ")/"))
    return named


def _office(content: bytes, member: str, paragraph: str, text: str) -> list[str]:
    out = []
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        for name in sorted((n for n in z.namelist() if n.startswith(member) and n.endswith(".xml")), key=lambda n: (len(n), n)):
            root = ElementTree.fromstring(z.read(name))
            out.append("\n".join("".join(t.text or "" for t in p.iter(text)) for p in root.iter(paragraph)))
    return out


_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.parts, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style")
        if tag in ("p", "div", "br", "li", "tr", "h1", "h2", "h3", "h4"):
            self.parts.append("\n")

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style") and self.skip > 0

    def handle_data(self, data):
        if not self.skip:
            self.parts.append(data)


def blocks_of(content: bytes, kind: str) -> list[tuple[int | None, str]]:
    """(page, text) of a document; nothing if its kind cannot be read here."""
    try:
        if kind == "docx":
            return [(None, t) for t in _office(content, "word/document", f"{_W}p", f"{_W}t")]
        if kind == "pptx":
            return [(i + 1, t) for i, t in enumerate(_office(content, "ppt/slides/slide", f"{_A}p", f"{_A}t"))]
        if kind == "pdf":
            from pypdf import PdfReader  # optional

            return [(i + 1, p.extract_text() or "") for i, p in enumerate(PdfReader(io.BytesIO(content)).pages)]
        text = content.decode("utf-8", "replace")
        if kind in ("html", "htm", "xml"):
            parser = _Text()
            parser.feed(text)
            text = "".join(parser.parts)
        return [(None, text)]
    except (ImportError, zipfile.BadZipFile, ElementTree.ParseError, KeyError, ValueError):
        return []


def extract(documents: DataFrame) -> DataFrame:
    """(doc_id, page, text) of documents (doc_id, doc_type, content)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [(d, p, t) for d, k, c in zip(f["doc_id"], f["doc_type"], f["content"]) for p, t in blocks_of(bytes(c), k) if t.strip()]
            yield pd.DataFrame(rows, columns=["doc_id", "page", "text"]).astype({"page": "Int32"})

    return documents.select("doc_id", "doc_type", "content").mapInPandas(run, "doc_id string, page int, text string")


def read_xml(spark: SparkSession, path: str, row: str, schema: str | None = None) -> DataFrame:
    """Elements of a name as rows; lists and attributes as Spark's reader gives them."""
    reader = spark.read.format("xml").option("rowTag", row)
    return (reader.schema(schema) if schema else reader).load(path)


def tables_of(page: str) -> list[tuple[int, int, list[str]]]:
    """(table, row, cells) of a page."""

    class Tables(HTMLParser):
        def __init__(self) -> None:
            super().__init__()
            self.out, self.table, self.row, self.cell = [], -1, [], None

        def handle_starttag(self, tag, attrs):
            if tag == "table":
                self.table += 1
            elif tag == "tr":
                self.row = []
            elif tag in ("td", "th"):
                self.cell = ""

        def handle_endtag(self, tag):
            if tag in ("td", "th") and self.cell is not None:
                self.row.append(" ".join(self.cell.split()))
                self.cell = None
            elif tag == "tr" and self.row:
                self.out.append((self.table, sum(t == self.table for t, _, _ in self.out), self.row))
                self.row = []

        def handle_data(self, data):
            if self.cell is not None:
                self.cell += data

    parser = Tables()
    parser.feed(page)
    return parser.out


def html_tables(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """(id, table, row, cells) of the tables of pages."""
    kind = pages.schema[id_col].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame([(i, t, r, c) for i, h in zip(f[id_col], f[html_col]) for t, r, c in tables_of(h or "")], columns=[id_col, "table", "row", "cells"])

    return pages.select(id_col, html_col).mapInPandas(run, f"`{id_col}` {kind}, table int, row int, cells array<string>")
