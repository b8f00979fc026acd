"""Spreadsheets (xlsx, xlsm) as a Python data source: ranges of a sheet's rows are partitions.

``spark.read.format("sheets").load(path)`` gives (path, sheet, row, cells) with cells as text. A task streams
through its sheet's part of the zip and keeps its range of rows; the table of shared texts is read once for
each file that a worker meets. Whole numbers have no point, dates are ISO text, truth values are true and false, an
error shows as it stands; an empty cell is an empty text. Of merged cells the first one has the value. Rows without any
cell are left out.
"""

from __future__ import annotations

import datetime
import functools
import io
import posixpath
import re
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Names of the format's parts; numbers of built-in formats that show dates.
MAIN, RELATION = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}", "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
DATES = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
ROWS = 20_000


def opened(path: str) -> io.BufferedIOBase:
    """A file of a store that Arrow knows, for reading anywhere in it."""
    import pyarrow.fs as pafs

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    fs, inner = pafs.FileSystem.from_uri(path) if ":/" in path else (pafs.LocalFileSystem(), path)
    return fs.open_input_file(inner)


def _text(element) -> str:
    """Texts of a cell or shared item; what is only how to say it is left out."""
    out = []
    for x in element:
        if x.tag == f"{MAIN}t":
            out.append(x.text or "")
        elif x.tag == f"{MAIN}r":
            out.append(_text(x))
    return "".join(out)


class Book:
    """What every sheet of a file needs."""

    def __init__(self, raw: io.BufferedIOBase) -> None:
        self.zip = zipfile.ZipFile(raw)
        names = set(self.zip.namelist())
        self.shared: list[str] = []
        if "xl/sharedStrings.xml" in names:
            for _, e in ElementTree.iterparse(self.zip.open("xl/sharedStrings.xml")):
                if e.tag == f"{MAIN}si":
                    self.shared.append(_text(e))
                    e.clear()
        self.dated: list[bool] = []
        if "xl/styles.xml" in names:
            root = ElementTree.parse(self.zip.open("xl/styles.xml")).getroot()
            own = {int(f.get("numFmtId")): f.get("formatCode", "") for f in root.iter(f"{MAIN}numFmt")}
            bare = lambda code: re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", code)
            for xf in root.find(f"{MAIN}cellXfs") if root.find(f"{MAIN}cellXfs") is not None else ():
                n = int(xf.get("numFmtId", 0))
                self.dated.append(n in DATES or n in own and bool(re.search("[dmyhs]", bare(own[n]), re.I)))
        book = ElementTree.parse(self.zip.open("xl/workbook.xml")).getroot()
        setting = book.find(f"{MAIN}workbookPr")
        self.epoch = datetime.datetime(1904, 1, 1) if setting is not None and setting.get("date1904") in ("1", "true") else datetime.datetime(1899, 12, 30)
        links = {r.get("Id"): r.get("Target") for r in ElementTree.parse(self.zip.open("xl/_rels/workbook.xml.rels")).getroot()}
        at = lambda target: target.lstrip("/") if target.startswith("/") else posixpath.normpath(f"xl/{target}")
        self.sheets = {s.get("name"): at(links[s.get(f"{RELATION}id")]) for s in book.iter(f"{MAIN}sheet")}

    def rows_of(self, sheet: str) -> int:
        """The last row that a sheet tells, or 0 if it doesn't."""
        with self.zip.open(self.sheets[sheet]) as f:
            m = re.search(rb'<dimension ref="(?:[A-Z]+\d+:)?[A-Z]+(\d+)"', f.read(4096))
        return int(m[1]) if m else 0

    def value(self, cell) -> str:
        kind, v = cell.get("t", "n"), cell.find(f"{MAIN}v")
        if kind == "inlineStr":
            inner = cell.find(f"{MAIN}is")
            return _text(inner) if inner is not None else ""
        raw = v.text if v is not None and v.text is not None else ""
        if raw == "" or kind in ("str", "e", "d"):
            return raw
        if kind == "s":
            return self.shared[int(raw)]
        if kind == "b":
            return "true" if raw == "1" else "false"
        style = int(cell.get("s", 0))
        number = float(raw)
        if style < len(self.dated) and self.dated[style]:
            return self._date(number)
        return str(int(number)) if number.is_integer() and abs(number) < 1e15 else repr(number)

    def _date(self, number: float) -> str:
        if 0 <= number < 1:
            return (datetime.datetime.min + datetime.timedelta(seconds=round(number * 86400))).time().isoformat()
        # The calendar has a day in 1900 that never was.
        day = number + 1 if number < 60 and self.epoch.year == 1899 else number
        when = self.epoch + datetime.timedelta(seconds=round(day * 86400))
        return when.date().isoformat() if when.time() == datetime.time() else when.isoformat(sep=" ")

    def rows(self, sheet: str, first: int, last: int | None) -> Iterator[tuple[int, list[str]]]:
        """(row, cells) of a range of rows of a sheet; memory is that of one row."""
        at, root = 0, None
        with self.zip.open(self.sheets[sheet]) as f:
            for event, e in ElementTree.iterparse(f, ("start", "end")):
                if root is None:
                    root = e
                if event != "end" or e.tag != f"{MAIN}row":
                    continue
                at = int(e.get("r", at + 1))
                if last is not None and at > last:
                    return
                if at >= first:
                    cells: list[str] = []
                    for c in e.iter(f"{MAIN}c"):
                        column = _column(c.get("r")) if c.get("r") else len(cells)
                        cells += [""] * (column - len(cells)) + [self.value(c)]
                    if any(cells):
                        yield at, cells
                # What has been read is let go, with what the parent holds of it.
                e.clear()
                for child in root.iter(f"{MAIN}sheetData"):
                    child.clear()


def _column(name: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", name)[0]:
        n = 26 * n + ord(c) - 64
    return n - 1


@functools.lru_cache(2)
def _book(path: str, stamp: str) -> Book:
    return Book(opened(path))


class Range(InputPartition):
    def __init__(self, path: str, stamp: str, sheet: str, first: int, last: int | None) -> None:
        self.path, self.stamp, self.sheet, self.first, self.last = path, stamp, sheet, first, last


class SheetReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.options = options

    def partitions(self) -> Sequence[InputPartition]:
        step, out = int(self.options.get("rows", ROWS)), []
        for path, stamp in (x.split("\t") for x in self.options["files"].split("\n") if x):
            book = _book(path, stamp)
            for sheet in book.sheets:
                told = book.rows_of(sheet)
                edges = list(range(1, max(told, 1) + 1, step))
                # What the sheet says of its size is a hint: the last range is open.
                out += [Range(path, stamp, sheet, a, b - 1 if b else None) for a, b in zip(edges, [*edges[1:], None])]
        return out or [Range("", "", "", 1, 0)]

    def read(self, partition: Range) -> Iterator[tuple]:
        if partition.path:
            for row, cells in _book(partition.path, partition.stamp).rows(partition.sheet, partition.first, partition.last):
                yield partition.path, partition.sheet, row, cells


class SheetSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sheets"

    def schema(self) -> str:
        return "path string, sheet string, row int, cells array<string>"

    def reader(self, schema) -> SheetReader:
        return SheetReader(dict(self.options))


def read(spark: SparkSession, path: str, rows: int = ROWS) -> DataFrame:
    """(path, sheet, row, cells) of a file or of all spreadsheets in a folder."""
    spark.dataSource.register(SheetSource)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xls[xm]").option("recursiveFileLookup", "true").load(path)
    listed = "\n".join(f"{r.path}\t{r.modificationTime}" for r in files.select("path", "modificationTime").orderBy("path").collect())
    return spark.read.format("sheets").option("files", listed).option("rows", str(rows)).load()


def table(sheets: DataFrame, path: str, sheet: str) -> DataFrame:
    """One sheet as a table: its first row has the names; cells beyond the names are left out, missing ones are empty."""
    own = sheets.filter((F.col("path") == path) & (F.col("sheet") == sheet))
    head = own.orderBy("row").first()
    if head is None:
        raise ValueError(f"{sheet} of {path} has no rows")
    names: list[str] = []
    for i, n in enumerate(head["cells"]):
        n = n.strip() or f"column_{i + 1}"
        names.append(n if n not in names else f"{n}.{sum(x.split('.')[0] == n for x in names)}")
    cell = lambda i: F.coalesce(F.get("cells", F.lit(i)), F.lit(""))
    return own.filter(F.col("row") > head["row"]).select("row", *[cell(i).alias(n) for i, n in enumerate(names)])
