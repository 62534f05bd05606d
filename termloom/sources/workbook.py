"""Workbooks (.xlsx) as tables.

Files are read through Spark's ``binaryFile`` source, so they may lie on any file system the
cluster mounts; each file is parsed inside the task that holds it.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from termloom.functions.validity import NA_TOKENS

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"

# Number formats of the file format that show dates or times.
_DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
_ROWS_PER_BATCH = 4096


def _texts(node: ElementTree.Element) -> str:
    """Text of a plain or rich string, without reading aids."""
    runs = [node.find(f"{_MAIN}t"), *(run.find(f"{_MAIN}t") for run in node.iter(f"{_MAIN}r"))]
    return "".join(t.text or "" for t in runs if t is not None)


def _shows_date(code: str) -> bool:
    bare = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", code)
    return bool(re.search(r"[ymdhs]", bare, re.IGNORECASE))


def _column(reference: str) -> int:
    number = 0
    for letter in re.match("[A-Z]+", reference)[0]:
        number = number * 26 + ord(letter) - 64
    return number - 1


class _Book:
    """The parts of one workbook file that its cells refer to."""

    def __init__(self, content: bytes):
        self.files = zipfile.ZipFile(io.BytesIO(content))
        book = self._xml("xl/workbook.xml")
        links = self._xml("xl/_rels/workbook.xml.rels")
        targets = {link.get("Id"): link.get("Target") for link in links}
        first = book.find(f"{_MAIN}sheets/{_MAIN}sheet").get(_LINK)
        self.sheet = posixpath.normpath(posixpath.join("/xl", targets[first])).lstrip("/")
        setup = book.find(f"{_MAIN}workbookPr")
        from_1904 = setup is not None and setup.get("date1904") in ("1", "true")
        self.epoch = datetime(1904, 1, 1) if from_1904 else datetime(1899, 12, 30)
        shared = self._xml("xl/sharedStrings.xml")
        self.strings = [] if shared is None else [_texts(item) for item in shared]
        self.date_styles = self._date_styles()

    def _xml(self, name: str) -> ElementTree.Element | None:
        if name not in self.files.namelist():
            return None
        return ElementTree.fromstring(self.files.read(name))

    def _date_styles(self) -> set[int]:
        styles = self._xml("xl/styles.xml")
        if styles is None:
            return set()
        dates = set(_DATE_FORMATS)
        for form in styles.iter(f"{_MAIN}numFmt"):
            if _shows_date(form.get("formatCode", "")):
                dates.add(int(form.get("numFmtId")))
        used = styles.find(f"{_MAIN}cellXfs")
        forms = [] if used is None else [int(xf.get("numFmtId", 0)) for xf in used]
        return {i for i, form in enumerate(forms) if form in dates}

    def value(self, cell: ElementTree.Element):
        kind, value = cell.get("t", "n"), cell.find(f"{_MAIN}v")
        if kind == "inlineStr":
            inline = cell.find(f"{_MAIN}is")
            return None if inline is None else _texts(inline)
        if value is None or value.text is None or kind == "e":
            return None
        if kind == "s":
            return self.strings[int(value.text)]
        if kind == "b":
            return value.text == "1"
        if kind in ("str", "d"):
            return value.text
        number = float(value.text)
        if int(cell.get("s", 0)) in self.date_styles:
            return self.epoch + timedelta(milliseconds=round(number * 86_400_000))
        return int(number) if number.is_integer() else number

    def rows(self) -> Iterator[list]:
        """Cells of the first sheet; skipped rows come out empty, trailing ones do not."""
        pending, last = 0, 0
        with self.files.open(self.sheet) as sheet:
            for _, node in ElementTree.iterparse(sheet):
                if node.tag != f"{_MAIN}row":
                    continue
                number = int(node.get("r", last + 1))
                pending += number - last - 1
                last, cells = number, []
                for cell in node.iter(f"{_MAIN}c"):
                    at = _column(cell.get("r")) if cell.get("r") else len(cells)
                    cells.extend([None] * (at - len(cells)))
                    cells.append(self.value(cell))
                node.clear()
                if all(value is None for value in cells):
                    pending += 1
                    continue
                yield from ([] for _ in range(pending))
                pending = 0
                yield cells


def _header(cells: Sequence, skip: int) -> list[str]:
    """Column names; blank ones are numbered and repeated ones get a suffix."""
    names, seen = [], {}
    for i, cell in enumerate(cells):
        name = f"Unnamed: {i}" if cell is None else _text(cell)
        repeat = seen.get(name, 0)
        seen[name] = repeat + 1
        names.append(f"{name}.{repeat}" if repeat else name)
    return names[skip:]


def _text(value) -> str | None:
    if value is None or (isinstance(value, str) and value in NA_TOKENS):
        return None
    if isinstance(value, datetime):
        midnight = (value.hour, value.minute, value.second, value.microsecond) == (0, 0, 0, 0)
        return value.strftime("%Y-%m-%d") if midnight else str(value)
    return str(value)


def _kind(value) -> str:
    for kind, types in {"boolean": bool, "bigint": int, "double": float, "date": datetime}.items():
        if isinstance(value, types):
            return kind
    return "string"


def _files(spark: SparkSession, path: str) -> DataFrame:
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.xlsx")
        .load(path)
        .select("path", "content")
    )
    if not files.inputFiles():
        raise FileNotFoundError(f"no .xlsx file in {path}")
    return files


def workbook_columns(
    spark: SparkSession, path: str, drop_index: bool = True, kinds: bool = False
) -> DataFrame:
    """``(name, kinds, has_null)`` of all columns, in order of appearance over sorted file names.

    The kinds of cell values are found only on request, as this parses whole files.
    """
    skip = int(drop_index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(*(column.to_pylist() for column in batch.columns)):
                rows = _Book(content).rows()
                names = _header(next(rows, []), skip)
                found = [set() for _ in names]
                for cells in rows if kinds else ():
                    cells = cells[skip:] + [None] * (len(names) - len(cells[skip:]))
                    for seen, value in zip(found, cells):
                        seen.add("null" if _text(value) is None else _kind(value))
                yield pa.RecordBatch.from_pydict(
                    {
                        "path": [path] * len(names),
                        "place": list(range(len(names))),
                        "name": names,
                        "kinds": [sorted(seen) for seen in found],
                    },
                    schema=pa.schema(
                        [
                            ("path", pa.string()),
                            ("place", pa.int32()),
                            ("name", pa.string()),
                            ("kinds", pa.list_(pa.string())),
                        ]
                    ),
                )

    found = _files(spark, path).mapInArrow(
        run, "path string, place int, name string, kinds array<string>"
    )
    return (
        found.groupBy("name")
        .agg(
            F.min(F.struct("path", "place")).alias("first"),
            F.array_distinct(F.flatten(F.collect_set("kinds"))).alias("kinds"),
            F.count("*").alias("files"),
        )
        .orderBy("first")
        .select("name", "kinds", "files")
    )


def read_workbooks(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, drop_index: bool = True
) -> DataFrame:
    """All rows of all workbooks under ``path`` as text, stacked by column name.

    First sheet, names in the first row, first column dropped as an index. ``columns`` saves the
    pass that looks up the names.
    """
    skip = int(drop_index)
    if columns is None:
        columns = [row["name"] for row in workbook_columns(spark, path, drop_index).collect()]
    columns = list(columns)
    arrow = pa.schema([(f"c{i}", pa.string()) for i in range(len(columns))])

    def pack(rows: list[list[str | None]]) -> pa.RecordBatch:
        arrays = [pa.array(values, pa.string()) for values in zip(*rows)]
        return pa.RecordBatch.from_arrays(arrays, schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content").to_pylist():
                rows = _Book(content).rows()
                names = _header(next(rows, []), skip)
                place = [names.index(c) + skip if c in names else None for c in columns]
                waiting = []
                for cells in rows:
                    waiting.append(
                        [
                            _text(cells[p]) if p is not None and p < len(cells) else None
                            for p in place
                        ]
                    )
                    if len(waiting) == _ROWS_PER_BATCH:
                        yield pack(waiting)
                        waiting = []
                if waiting:
                    yield pack(waiting)

    schema = T.StructType([T.StructField(f.name, T.StringType()) for f in arrow])
    return _files(spark, path).mapInArrow(run, schema).toDF(*columns)


def _typed(name: str, kinds: set[str], files: int, all_files: int):
    """JSON value of a text column: whole and fractional numbers, flags and dates keep their kind,
    a column of mixed kinds stays text."""
    column, some_null = F.col(f"`{name}`"), "null" in kinds or files < all_files
    kinds = kinds - {"null"}
    if kinds == {"boolean"}:
        return column.cast("boolean").alias(name)
    if kinds == {"date"}:
        return F.unix_millis(column.cast("timestamp")).alias(name)
    if kinds and kinds <= {"bigint", "double"}:
        whole = kinds == {"bigint"} and not some_null
        return column.cast("bigint" if whole else "double").alias(name)
    return column.alias(name)


def workbook_to_jsonl(spark: SparkSession, path: str, target: str) -> None:
    """Workbook rows as JSON lines with explicit nulls; dates become epoch milliseconds."""
    found = workbook_columns(spark, path, drop_index=False, kinds=True).collect()
    all_files = len(_files(spark, path).inputFiles())
    rows = read_workbooks(spark, path, [row["name"] for row in found], drop_index=False)
    typed = rows.select(
        *(_typed(row["name"], set(row["kinds"]), row["files"], all_files) for row in found)
    )
    typed.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).write.text(target)
