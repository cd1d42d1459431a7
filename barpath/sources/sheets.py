"""Workbooks (a zip of XML files) as rows, and the factor tables that come in them. SURVEY SRC-11, FN-12, FN-18.

Files are read by Spark (``binaryFile``), so they may be wherever Spark reads from; a workbook is one row, and a task parses it
sheet by sheet, as a stream of XML events.
"""

from __future__ import annotations

import datetime
import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from barpath.session import hold_batches

#: The numbers of built-in formats that show a date or a time.
DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
EPOCH = datetime.datetime(1899, 12, 30)
CELLS = "file string, sheet string, row int, cells array<string>"
#: Rows of a batch.
BATCH = 4096
#: Bytes of workbooks in a batch that goes to a task: a task holds a batch at a time.
BATCH_BYTES = 8 << 20


def _name(tag: str) -> str:
    return tag.rpartition("}")[2]


def _text(element) -> str:
    """The text of a string: that of its runs, without phonetic guides."""
    return "".join(t.text or "" for run in [element, *(r for r in element if _name(r.tag) == "r")] for t in run if _name(t.tag) == "t")


def _elements(book: zipfile.ZipFile, path: str, *names: str) -> Iterator[ElementTree.Element]:
    """The elements of some names, one by one; what has been given is forgotten. A part that is not there has none."""
    if path not in book.namelist():
        return
    with book.open(path) as f:
        root = None
        for event, e in ElementTree.iterparse(f, ("start", "end")):
            if root is None:
                root = e
            if event == "end" and _name(e.tag) in names:
                yield e
                root.clear()


def _column(reference: str) -> int:
    """0 for A1, 26 for AA7."""
    n = 0
    for c in re.match("[A-Z]+", reference)[0]:
        n = 26 * n + ord(c) - 64
    return n - 1


class Workbook:
    def __init__(self, content: bytes):
        self.book = zipfile.ZipFile(io.BytesIO(content))
        targets = {e.get("Id"): e.get("Target") for e in _elements(self.book, "xl/_rels/workbook.xml.rels", "Relationship")}
        place = lambda t: t.lstrip("/") if t.startswith("/") else f"xl/{t}"
        self.sheets, self.epoch = {}, EPOCH
        for e in _elements(self.book, "xl/workbook.xml", "sheet", "workbookPr"):
            if _name(e.tag) == "workbookPr":
                self.epoch = datetime.datetime(1904, 1, 1) if e.get("date1904") in ("1", "true") else EPOCH
            else:
                self.sheets[e.get("name")] = place(targets[next(v for k, v in e.attrib.items() if _name(k) == "id")])
        self.strings = [_text(e) for e in _elements(self.book, "xl/sharedStrings.xml", "si")]
        self.dates = self._dates()

    def _dates(self) -> list[bool]:
        """Whether a style shows a date."""
        own: dict[int, bool] = {}
        for e in _elements(self.book, "xl/styles.xml", "numFmts"):
            for f in e:
                plain = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", f.get("formatCode", ""))
                own[int(f.get("numFmtId"))] = bool(re.search("[dmyhs]", plain, re.IGNORECASE))
        out = []
        for e in _elements(self.book, "xl/styles.xml", "cellXfs"):
            out = [own.get(n, n in DATE_FORMATS) for n in (int(x.get("numFmtId", "0")) for x in e)]
        return out

    def value(self, cell) -> str | None:
        kind = cell.get("t", "n")
        if kind == "inlineStr":
            return next((_text(e) for e in cell if _name(e.tag) == "is"), None)
        v = next((e.text for e in cell if _name(e.tag) == "v"), None)
        if v is None or kind == "e":
            return None
        if kind == "s":
            return self.strings[int(v)]
        if kind == "b":
            return "true" if v == "1" else "false"
        if kind == "n" and (s := int(cell.get("s", "0"))) < len(self.dates) and self.dates[s]:
            day = self.epoch + datetime.timedelta(days=float(v))
            return day.strftime("%Y-%m-%d") if float(v).is_integer() else day.isoformat(" ", "seconds")
        return v

    def rows(self, sheet: str) -> Iterator[tuple[int, list[str | None]]]:
        """(number, cells): cells that a row leaves out are null; rows that a sheet leaves out do not come."""
        number = 0
        for e in _elements(self.book, self.sheets[sheet], "row"):
            number = int(e.get("r", number + 1))
            cells: list[str | None] = []
            for c in e:
                at = _column(c.get("r")) if c.get("r") else len(cells)
                cells += [None] * (at - len(cells))
                cells.append(self.value(c))
            yield number, cells


def _batches(file: str, content: bytes, sheets: Sequence[str] | None) -> Iterator[pa.RecordBatch]:
    book, held = Workbook(content), []

    def batch() -> pa.RecordBatch:
        f, s, r, c = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(f, pa.string()), pa.array(s, pa.string()), pa.array(r, pa.int32()), pa.array(c, pa.list_(pa.string()))], names=["file", "sheet", "row", "cells"])

    for sheet in book.sheets:
        if sheets is None or sheet in sheets:
            for number, cells in book.rows(sheet):
                held.append((file, sheet, number, cells))
                if len(held) == BATCH:
                    yield batch()
                    held.clear()
    if held:
        yield batch()


def cells_of(files: DataFrame, sheets: Sequence[str] | None = None) -> DataFrame:
    """SRC-11: ``file, sheet, row, cells`` of all sheets, or of some, of workbooks (``path``, ``content``, as ``binaryFile`` reads them).
    Cells are text: numbers as they are written, dates as ISO dates, formulas as their last value, errors and gaps null."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):  # one is copied at a time
                yield from _batches(path.as_py(), content.as_py(), sheets)

    hold_batches(files.sparkSession, maxBytesPerBatch=BATCH_BYTES)
    return files.select("path", "content").mapInArrow(run, CELLS)


def read(spark: SparkSession, path: str, sheets: Sequence[str] | None = None) -> DataFrame:
    """The cells of the workbooks at a path."""
    return cells_of(spark.read.format("binaryFile").load(path), sheets)


def factors(cells: DataFrame, items: Sequence[tuple[str, str, str, bool]]) -> DataFrame:
    """``kind, gender, age, bodyweight, mu, sigma, nu`` from sheets of factors. ``items``: (sheet, kind, gender, has_age); the columns are
    age (if it has one), bodyweight, mu, sigma, nu. The first row is the header; rows without a bodyweight or a mu are left out."""
    known = F.broadcast(cells.sparkSession.createDataFrame(list(items), "sheet string, kind string, gender string, has_age boolean"))  # a fixed short list
    at = lambda n: F.get("cells", F.lit(n) + F.when(F.col("has_age"), 1).otherwise(0)).try_cast("double")
    rows = cells.where("row > 1").join(known, "sheet")
    age = F.when(F.col("has_age"), F.get("cells", F.lit(0)).try_cast("int"))
    out = rows.select("kind", "gender", age.alias("age"), *[at(n).alias(c) for n, c in enumerate(("bodyweight", "mu", "sigma", "nu"))])
    return out.where("bodyweight is not null and mu is not null").withColumn("bodyweight", F.col("bodyweight").cast("decimal(5,1)"))


def workbook(sheets: dict[str, list[list]]) -> bytes:
    """A workbook of text (shared), numbers, dates and nulls (gaps)."""
    strings: dict[str, int] = {}
    letters = lambda n: (letters(n // 26 - 1) if n >= 26 else "") + chr(65 + n % 26)

    def cell(x, at: str) -> str:
        if x is None:
            return ""
        if isinstance(x, bool):
            return f'<c r="{at}" t="b"><v>{int(x)}</v></c>'
        if isinstance(x, datetime.date):
            return f'<c r="{at}" s="1"><v>{(x - EPOCH.date()).days}</v></c>'
        if isinstance(x, str):
            return f'<c r="{at}" t="s"><v>{strings.setdefault(x, len(strings))}</v></c>'
        return f'<c r="{at}"><v>{x!r}</v></c>'

    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for k, rows in enumerate(sheets.values(), 1):
            body = "".join(f'<row r="{n}">{"".join(cell(x, f"{letters(i)}{n}") for i, x in enumerate(r))}</row>' for n, r in enumerate(rows, 1) if r)
            z.writestr(f"xl/worksheets/sheet{k}.xml", f"<worksheet {main}><sheetData>{body}</sheetData></worksheet>")
        z.writestr("xl/sharedStrings.xml", f"<sst {main}>{''.join(f'<si><t>{escape(s)}</t></si>' for s in strings)}</sst>")
        z.writestr("xl/styles.xml", f'<styleSheet {main}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        kind = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        names = "".join(f'<sheet name="{escape(n)}" sheetId="{k}" r:id="rId{k}"/>' for k, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="{kind}"><sheets>{names}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{k}" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{links}</Relationships>")
    return out.getvalue()


# The same as a data source: spark.read.format("sheets").load(path), a partition for each sheet of each file.


class _Sheet(InputPartition):
    def __init__(self, path: str, sheet: str):
        self.path, self.sheet = path, sheet


class _SheetReader(DataSourceReader):
    def __init__(self, options):
        self.options = options

    def _open(self, path: str) -> bytes:
        """Through Arrow's file systems: Spark's own do not reach a Python data source."""
        from pyarrow import fs

        system, at = fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)
        with system.open_input_stream(at) as f:
            return f.read()

    def partitions(self) -> list[_Sheet]:
        from pyarrow import fs

        root = self.options["path"]
        system, at = fs.FileSystem.from_uri(root) if ":" in root.split("/")[0] else (fs.LocalFileSystem(), root)
        info = system.get_file_info(at)
        files = [at] if info.is_file else sorted(f.path for f in system.get_file_info(fs.FileSelector(at, recursive=True)) if f.is_file and f.path.endswith(".xlsx"))
        head = root[: len(root) - len(at)] if root.endswith(at) else ""
        wanted = self.options.get("sheets")
        wanted = None if wanted is None else {s.strip() for s in wanted.split(",")}
        return [_Sheet(head + f, s) for f in files for s in Workbook(self._open(head + f)).sheets if wanted is None or s in wanted]

    def read(self, partition: _Sheet) -> Iterator[pa.RecordBatch]:
        return _batches(partition.path, self._open(partition.path), [partition.sheet])


class SheetSource(DataSource):
    """Options: ``sheets``, names with commas between them (default: all)."""

    @classmethod
    def name(cls) -> str:
        return "sheets"

    def schema(self) -> str:
        return CELLS

    def reader(self, schema) -> DataSourceReader:
        return _SheetReader(self.options)
