"""Sheets of zipped XML workbooks as tables of text columns."""

from __future__ import annotations

import io
import re
import sys
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SUFFIXES = ("xlsx", "xlsm")
ROW = "__row"
_BATCH = 10_000


def _local(element: ElementTree.Element) -> str:
    """Tag without its namespace."""
    return element.tag.rpartition("}")[2]


def _text(element: ElementTree.Element) -> str:
    """Text of a string item: its runs, without the reading aids."""
    out = []
    for child in element:
        if _local(child) == "t":
            out.append(child.text or "")
        elif _local(child) == "r":
            out += [t.text or "" for t in child if _local(t) == "t"]
    return "".join(out)


def _number(text: str) -> str:
    """Whole numbers without a fraction, others as the shortest text of their double."""
    value = float(text)
    return str(int(value)) if value == int(value) and abs(value) < 2**53 else repr(value)


def column_number(reference: str) -> int:
    """0 for A, 25 for Z, 26 for AA."""
    n = 0
    for c in re.match(r"[A-Z]+", reference).group():
        n = n * 26 + ord(c) - 64
    return n - 1


def sheet_part(book: zipfile.ZipFile, sheet: str | None) -> str:
    """Path of a sheet within the workbook: the named one or the first."""
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    names = [(e.attrib["name"], next(v for k, v in e.attrib.items() if k.rpartition("}")[2] == "id")) for e in root.iter() if _local(e) == "sheet"]
    chosen = [ref for name, ref in names if sheet is None or name == sheet]
    if not chosen:
        raise ValueError(f"no sheet '{sheet}', there are {[name for name, _ in names]}")
    relations = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = next(e.attrib["Target"] for e in relations if e.attrib["Id"] == chosen[0])
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def sheet_rows(content: bytes, sheet: str | None = None) -> Iterator[dict[int, str]]:
    """Column number → text of every row that has a value, in order, read as a stream.

    Formulas give their stored values, truth values ``True`` and ``False``, error values and empty texts nothing; dates are their serial numbers.
    """
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        strings: list[str] = []
        if "xl/sharedStrings.xml" in book.namelist():
            for _, element in ElementTree.iterparse(book.open("xl/sharedStrings.xml")):
                if _local(element) == "si":
                    strings.append(_text(element))
                    element.clear()
        with book.open(sheet_part(book, sheet)) as part:
            for _, element in ElementTree.iterparse(part):
                if _local(element) != "row":
                    continue
                cells, at = {}, -1
                for cell in element:
                    at = column_number(cell.attrib["r"]) if "r" in cell.attrib else at + 1
                    kind = cell.attrib.get("t", "n")
                    value = next((e.text for e in cell if _local(e) == "v"), None)
                    if kind == "inlineStr":
                        value = next((_text(e) for e in cell if _local(e) == "is"), None)
                    elif value is not None:
                        value = {"s": lambda v: strings[int(v)], "b": lambda v: str(v.strip() == "1"), "e": lambda v: None, "n": _number}.get(kind, str)(value)
                    if value:
                        cells[at] = value
                if cells:
                    yield cells
                element.clear()


def header_names(first: dict[int, str]) -> list[str]:
    """Names of the first row: blank ones by their place, repeated ones numbered."""
    names, seen = [], {}
    for i in range(max(first) + 1):
        name = first.get(i, f"Unnamed: {i}")
        n = seen[name] = seen.get(name, -1) + 1
        names.append(f"{name}.{n}" if n else name)
    return names


def read_spreadsheet(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """``__row`` (from 0) and the text columns of a sheet; names come from its first row, blank rows are left out.

    The files are read by Spark, so any file system works; a file is one task, as a zip cannot be split.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, content in zip(pdf["path"], pdf["content"]):
                yield pd.DataFrame({"path": [name], "names": [header_names(next(sheet_rows(content, sheet), {0: "Unnamed: 0"}))]})

    head = files.mapInPandas(first, "path string, names array<string>").orderBy("path").first()
    if head is None:
        raise ValueError(f"no spreadsheet at {path}")
    names = head["names"]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for content in pdf["content"]:
                batch, number = [], 0
                stream = sheet_rows(content, sheet)
                next(stream, None)
                for cells in stream:
                    batch.append([number, *[cells.get(i) for i in range(len(names))]])
                    number += 1
                    if len(batch) == _BATCH:
                        yield pd.DataFrame(batch, columns=[ROW, *names])
                        batch = []
                if batch:
                    yield pd.DataFrame(batch, columns=[ROW, *names]).astype(object)

    schema = ", ".join([f"{ROW} long", *[f"`{name.replace('`', '``')}` string" for name in names]])
    return files.select("content").mapInPandas(rows, schema)


def by_position(sheet: DataFrame, attributes: tuple[str, ...], label: str) -> DataFrame:
    """A sheet whose first rows are ``attributes`` in their order, with their names in the column ``label``."""
    names = F.array(*[F.lit(name) for name in attributes])
    features = [name for name in sheet.columns if name not in (ROW, label)]
    return sheet.where(F.col(ROW) < len(attributes)).select(F.get(names, F.col(ROW).cast("int")).alias(label), *[F.col(f"`{name}`") for name in features])


# Tasks get the code by value: executors need pandas, but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
