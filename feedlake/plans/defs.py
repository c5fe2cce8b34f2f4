"""Declarative feed definitions."""

from __future__ import annotations

import re
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    name: str
    width: int


@dataclass(frozen=True)
class Layout:
    """A fixed-width layout; offsets are the running sum of widths."""

    name: str
    fields: tuple[Field, ...]
    token: str = ""
    header: bool = False

    @property
    def width(self) -> int:
        return sum(f.width for f in self.fields)

    @staticmethod
    def parse(name: str, text: str, token: str = "", header: bool = False) -> Layout:
        """A layout from 'field:width, field:width, ...'."""
        pairs = (p.strip().rsplit(":", 1) for p in text.split(",") if p.strip())
        return Layout(name, tuple(Field(n, int(w)) for n, w in pairs), token, header)


def read_layouts(path: str) -> dict[str, Layout]:
    """Layouts by name from a text where '**name** ... token `X` ... header line: no' precedes a line of fields in backticks."""
    text = Path(path).read_text(encoding="utf-8")
    found = re.findall(r"\*\*(\w+)\*\* — token `(\w+)`,[^\n]*header line: (yes|no)[^\n]*\n\n`([^`]+)`", text)
    return {name: Layout.parse(name, fields, token, header == "yes") for name, token, header, fields in found}


@dataclass(frozen=True)
class Sheet:
    """A sheet of a workbook family: its name's LIKE pattern and how it is read.

    header_row: 1-based row of the header, else it is found. labels: constant column
    labels of a key/value sheet, which has no header. include_notes: rows from NOTE on
    are data too.
    """

    table: str
    pattern: str
    header_row: int | None = None
    labels: tuple[str, ...] = ()
    include_notes: bool = False


@dataclass(frozen=True)
class Feed:
    """A family of files: where they lie below a root, how they are read, where their rows go.

    kind: fixed_width, csv, xml, zip_csv (CSV members of archives), quality (a workbook or,
    in later years, a CSV member of archives) or sheet (a sectioned sheet of workbooks).
    member: a glob of members' names. dates: 'path' the path's stamp, else a rule of
    `with_workbook_metadata`. token: what in a workbook's name comes before its year.
    batch: files read and appended at once, all where it is None.
    """

    name: str
    glob: str
    kind: str = "fixed_width"
    layout: Layout | None = None
    member: str = "*"
    sheet: Sheet | None = None
    dates: str = "path"
    token: str = ""
    batch: int | None = None


#: The relation that every sectioned sheet becomes (fixed values).
CELL_GRAIN = T.StructType(
    [T.StructField("row_num", T.LongType())]
    + [T.StructField(n, T.StringType()) for n in "group_label section_code section_label row_label column_group_label column_label value_text file_path directory_name file_name".split()]
    + [T.StructField("file_date", T.DateType())]
    + [T.StructField(n, T.StringType()) for n in "aco_id performance_year benchmark_year submission_id period".split()]
)
