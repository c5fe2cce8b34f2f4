"""Workbooks (XLSX) as a table of cells, decoded in tasks with the standard library."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import open_file

CELLS = "file_path string, sheet string, row_num bigint, col_idx int, value string, error string"
_ROWS = 20_000


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _text(node: ElementTree.Element) -> str:
    """The text of a string item: its runs, phonetic hints left out."""
    out = []
    for child in node:
        if _local(child.tag) == "t":
            out.append(child.text or "")
        elif _local(child.tag) == "r":
            out.append(_text(child))
    return "".join(out)


def column_index(ref: str) -> int:
    """0 for A, 25 for Z, 26 for AA."""
    n = 0
    for c in re.match("[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def sheet_cells(content: bytes | str, inner: str | None = None) -> Iterator[tuple[str, int, int, str]]:
    """(sheet, row number from 1, column from 0, text) of every cell that has a value.

    `content` is a workbook or the locator of one, read by ranges; `inner` names a workbook inside
    an archive, of which that member alone comes into memory.
    """
    with zipfile.ZipFile(open_file(content) if isinstance(content, str) else io.BytesIO(content)) as z:
        if inner:
            yield from sheet_cells(z.read(inner))
            return
        names = set(z.namelist())
        strings = []
        if "xl/sharedStrings.xml" in names:
            strings = [_text(si) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))]
        targets = {r.get("Id"): r.get("Target").lstrip("/").removeprefix("xl/") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        for sheet in (s for s in book.iter() if _local(s.tag) == "sheet"):
            rel = next(v for k, v in sheet.attrib.items() if _local(k) == "id")
            row_at = 0
            with z.open("xl/" + targets[rel]) as f:
                for _, row in ElementTree.iterparse(f):
                    if _local(row.tag) != "row":
                        continue
                    row_at = int(row.get("r", row_at + 1))
                    col = -1
                    for c in row:
                        col = column_index(c.get("r")) if c.get("r") else col + 1
                        kind = c.get("t", "n")
                        part = {_local(x.tag): x for x in c}
                        if kind == "inlineStr":
                            value = _text(part["is"]) if "is" in part else None
                        else:
                            value = part["v"].text if "v" in part else None
                            if value is not None and kind == "s":
                                value = strings[int(value)]
                        if value not in (None, ""):
                            yield sheet.get("name"), row_at, col, value
                    row.clear()


def read_cells(books: DataFrame) -> DataFrame:
    """(file_path, sheet, row_num, col_idx, value, error) of `books` (path, source or content, optionally inner).

    Blank cells are absent, row numbers are the sheet's own. A workbook that can't
    be decoded is one row with `error`.
    """
    has_inner, handle = "inner" in books.columns, "source" if "source" in books.columns else "content"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["file_path", "sheet", "row_num", "col_idx", "value", "error"]
        for f in frames:
            for k in range(len(f)):
                path, inner = f["path"].iloc[k], f["inner"].iloc[k] if has_inner else None
                rows = []
                try:
                    for cell in sheet_cells(f[handle].iloc[k], inner):
                        rows.append((path, *cell, None))
                        if len(rows) >= _ROWS:
                            yield pd.DataFrame(rows, columns=names)
                            rows = []
                except (zipfile.BadZipFile, ElementTree.ParseError, KeyError, StopIteration) as e:
                    rows = [(path, None, None, None, None, f"{type(e).__name__}: {e}")]
                if rows:
                    yield pd.DataFrame(rows, columns=names).astype({"row_num": "Int64", "col_idx": "Int32"})

    return books.select("path", handle, *(["inner"] if has_inner else [])).mapInPandas(run, CELLS)


def sheet_names(cells: DataFrame) -> DataFrame:
    return cells.filter("sheet IS NOT NULL").select("file_path", "sheet").distinct()


def pivot_header(cells: DataFrame, sheet: str, columns: list[str]) -> DataFrame:
    """A headed sheet as a table: the named columns (in any order in each file) and file_path, every value a string."""
    own = cells.filter(F.col("sheet") == sheet)
    header = own.filter("row_num = 1").select("file_path", "col_idx", F.upper(F.trim("value")).alias("name"))
    body = own.filter("row_num > 1").join(header, ["file_path", "col_idx"])
    picked = [F.max(F.when(F.col("name") == c.upper(), F.col("value"))).alias(c) for c in columns]
    return body.groupBy("file_path", "row_num").agg(*picked)


def decode_errors(cells: DataFrame) -> DataFrame:
    """(n_files, n_failed, failed): a batch has failed only where no file of it could be opened."""
    files = cells.groupBy("file_path").agg(F.max(F.col("error").isNotNull()).alias("bad"))
    out = files.agg(F.count(F.lit(1)).alias("n_files"), F.count_if("bad").alias("n_failed"))
    return out.withColumn("failed", (F.col("n_files") > 0) & (F.col("n_files") == F.col("n_failed")))
