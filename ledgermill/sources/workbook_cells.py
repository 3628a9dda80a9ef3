"""XLSX statements to grid rows.

Decoding a workbook is the one step Spark has no expression for. It runs per file inside
``mapInPandas``; sheets are streamed row by row and handed back in batches.
"""

from __future__ import annotations

import datetime as dt
import io
import posixpath
import re
import sys
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.schemas import GRID_SCHEMA, UNREADABLE_SHEET
from ledgermill.sources.csv_cells import EMPTY_TEXTS, XLSX_NAMES, list_files

# Executors need no copy of the package: the worker function travels whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS_PER_BATCH = 5_000
READ_BYTES = 65_536
_BLANK = frozenset(EMPTY_TEXTS)

# Number formats that show a date or a time.
_DATE_FORMATS = frozenset((*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)))
_LITERAL = re.compile(r'"[^"]*"|\\.|\[[^\]]*\]')


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _children(book: zipfile.ZipFile, name: str) -> ElementTree.Element | None:
    return ElementTree.fromstring(book.read(name)) if name in book.namelist() else None


def _joined_text(node: ElementTree.Element) -> str:
    """Text of a plain or rich string, without phonetic runs."""
    parts = []
    for child in node:
        name = _local(child.tag)
        if name == "t":
            parts.append(child.text or "")
        elif name == "r":
            parts.extend(t.text or "" for t in child if _local(t.tag) == "t")
    return "".join(parts)


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    root = _children(book, "xl/sharedStrings.xml")
    return [] if root is None else [_joined_text(si) for si in root]


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Indices of the cell styles that show dates."""
    root = _children(book, "xl/styles.xml")
    if root is None:
        return set()
    custom = {
        int(f.get("numFmtId", -1)) for f in root.iter() if _local(f.tag) == "numFmt"
        and re.search("[dmyhs]", _LITERAL.sub("", f.get("formatCode", "")).lower())
    }
    formats = next((n for n in root if _local(n.tag) == "cellXfs"), [])
    return {
        i for i, xf in enumerate(formats)
        if int(xf.get("numFmtId", 0)) in _DATE_FORMATS or int(xf.get("numFmtId", 0)) in custom
    }


def _column(reference: str) -> int:
    index = 0
    for char in reference:
        if not char.isalpha():
            break
        index = index * 26 + ord(char.upper()) - 64
    return index - 1


def _date_text(serial: str, epoch: dt.datetime) -> str:
    return (epoch + dt.timedelta(seconds=round(float(serial) * 86400))).isoformat(sep=" ")


def _cell(node: ElementTree.Element, strings: list[str], dates: set[int], epoch: dt.datetime):
    """(value, kind), or None for an empty cell."""
    kind, value, formula, inline = node.get("t", "n"), None, None, None
    for child in node:
        name = _local(child.tag)
        if name == "v":
            value = child.text
        elif name == "f":
            formula = child.text or ""
        elif name == "is":
            inline = _joined_text(child)
    if kind == "inlineStr":
        value, kind = inline, "str"
    if value is None:
        return None if formula is None else (f"={formula}", "f")
    if kind in ("s", "str"):
        text = strings[int(value)] if kind == "s" else value
        return None if text in _BLANK else (text, "s")
    if kind == "b":
        return ("true" if value == "1" else "false"), "b"
    if kind == "e":
        return value, "e"
    if kind == "d":
        return value.replace("T", " "), "d"
    if int(node.get("s", 0)) in dates:
        return _date_text(value, epoch), "d"
    return value, "n"


def _ended(stream) -> Iterator[ElementTree.Element]:
    """Elements as they end. ``iterparse`` does the same, but makes a class at every call, which costs more than a small sheet."""
    parser = ElementTree.XMLPullParser(("end",))
    while chunk := stream.read(READ_BYTES):
        parser.feed(chunk)
        for _, node in parser.read_events():
            yield node
    parser.close()
    for _, node in parser.read_events():
        yield node


def _sheet_rows(stream, strings: list[str], dates: set[int], epoch: dt.datetime) -> Iterator[tuple[int, list[dict]]]:
    following_row = 0
    for node in _ended(stream):
        if _local(node.tag) != "row":
            continue
        row_idx = int(node.get("r", following_row + 1)) - 1
        following_row = row_idx + 1
        cells, following = [], 0
        for child in node:
            col_idx = _column(child.get("r")) if child.get("r") else following
            following = col_idx + 1
            found = _cell(child, strings, dates, epoch)
            if found is not None:
                cells.append({"col_idx": col_idx, "value": found[0], "kind": found[1]})
        node.clear()
        if cells:
            yield row_idx, cells


def workbook_rows(content: bytes) -> Iterator[tuple[int, str, bool, int, list[dict]]]:
    """(sheet_idx, sheet, is_active, row_idx, cells) of every non-empty row of a workbook."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        root = _children(book, "xl/workbook.xml")
        links = {r.get("Id"): r.get("Target") for r in _children(book, "xl/_rels/workbook.xml.rels")}
        nodes = list(root.iter())
        active = next((int(n.get("activeTab", 0)) for n in nodes if _local(n.tag) == "workbookView"), 0)
        late = any(_local(n.tag) == "workbookPr" and n.get("date1904") in ("1", "true") for n in nodes)
        epoch = dt.datetime(1904, 1, 1) if late else dt.datetime(1899, 12, 30)
        strings, dates = _shared_strings(book), _date_styles(book)
        sheets = [n for n in nodes if _local(n.tag) == "sheet"]
        for sheet_idx, sheet in enumerate(sheets):
            link = next(v for k, v in sheet.attrib.items() if _local(k) == "id" and k != "id")
            target = links[link]
            name = target.lstrip("/") if target.startswith("/") else posixpath.normpath(f"xl/{target}")
            with book.open(name) as stream:
                for row_idx, cells in _sheet_rows(stream, strings, dates, epoch):
                    yield sheet_idx, sheet.get("name"), sheet_idx == active, row_idx, cells


def _decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["path", "sheet_idx", "sheet", "is_active", "row_idx", "cells"]
    rows: list[tuple] = []
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            try:
                for row in workbook_rows(content):
                    rows.append((path, *row))
                    if len(rows) >= ROWS_PER_BATCH:
                        yield pd.DataFrame(rows, columns=columns)
                        rows = []
            except MemoryError:
                raise  # a failure of the task, not of the file
            except Exception as error:  # whatever is wrong with a file concerns that file only
                # marks it, so that rows already handed on are not loaded
                rows.append((path, UNREADABLE_SHEET, f"{type(error).__name__}: {error}"[:200], False, -1, []))
    if rows:
        yield pd.DataFrame(rows, columns=columns)


def workbook_grid(files: DataFrame) -> DataFrame:
    """Grid rows of XLSX files given as ``path`` and ``content`` bytes."""
    return files.select("path", "content").mapInPandas(_decode, GRID_SCHEMA)


def read_workbook_grid(spark: SparkSession, location: str) -> DataFrame:
    return workbook_grid(list_files(spark, location, XLSX_NAMES))
