"""Feed files rendered from tables by Spark, for tests and queries."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.plans.defs import Layout
from feedlake.sources.store import write_file


def fixed_width_line(layout: Layout, values: dict[str, Column]) -> Column:
    """A line: each value left-justified, blank-padded and cut to its width."""
    return F.concat(*[F.rpad(F.coalesce(values[f.name].cast("string"), F.lit("")), f.width, " ") for f in layout.fields])


def write_lines(lines: DataFrame, path: str, header: str | None = None) -> None:
    """One-column text files; with a header, as the first line of every file."""
    if header is None:
        lines.toDF("value").write.text(path)
    else:
        writer = lines.toDF(header).write.option("header", True).option("sep", "\u0001").option("quote", "").option("escapeQuotes", False)
        writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def archives(rows: DataFrame, group: str, name: Callable[[int], str], members: Callable[[pd.DataFrame], dict[str, str]]) -> DataFrame:
    """(path, content): one archive for each group (a bounded number of rows), with text members."""

    def build(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
            for member, text in members(frame).items():
                z.writestr(zipfile.ZipInfo(member, (2025, 1, 1, 0, 0, 0)), text)
        return pd.DataFrame({"path": [name(int(key[0]))], "content": [buffer.getvalue()]})

    return rows.groupBy(group).applyInPandas(build, "path string, content binary")


def write_files(files: DataFrame, root: str) -> None:
    """Files of (path, content) below root, written by tasks; a repeated task writes the same again."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for path, content in zip(f["path"], f["content"], strict=True):
                write_file(f"{root.rstrip('/')}/{path.lstrip('/')}", content)
            yield f[["path"]]

    files.select("path", F.col("content").cast("binary").alias("content")).mapInPandas(run, "path string").write.format("noop").mode("overwrite").save()


def _letters(col: int) -> str:
    out = ""
    col += 1
    while col:
        col, r = divmod(col - 1, 26)
        out = chr(65 + r) + out
    return out


def workbook(sheets: dict[str, list[list]]) -> bytes:
    """A small workbook: strings shared, numbers as numbers, None left out."""
    strings: dict[str, int] = {}
    parts = {}
    for k, rows in enumerate(sheets.values(), 1):
        body = []
        for r, row in enumerate(rows, 1):
            cells = []
            for c, v in enumerate(row):
                if v is None:
                    continue
                ref = f"{_letters(c)}{r}"
                if isinstance(v, str):
                    cells.append(f'<c r="{ref}" t="s"><v>{strings.setdefault(v, len(strings))}</v></c>')
                else:
                    cells.append(f'<c r="{ref}"><v>{v}</v></c>')
            if cells:
                body.append(f'<row r="{r}">{"".join(cells)}</row>')
        parts[f"xl/worksheets/sheet{k}.xml"] = f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{"".join(body)}</sheetData></worksheet>'
    names = "".join(f'<sheet name="{escape(n)}" sheetId="{k}" r:id="rId{k}"/>' for k, n in enumerate(sheets, 1))
    rels = "".join(f'<Relationship Id="rId{k}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(sheets) + 1))
    parts["xl/workbook.xml"] = f'<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>{names}</sheets></workbook>'
    parts["xl/_rels/workbook.xml.rels"] = f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{rels}</Relationships>'
    items = "".join(f"<si><t>{escape(s)}</t></si>" for s in strings)
    parts["xl/sharedStrings.xml"] = f'<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">{items}</sst>'
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return buffer.getvalue()


def workbooks(rows: DataFrame, group: str, name: Callable[[int], str], sheets: Callable[[pd.DataFrame], dict[str, list[list]]]) -> DataFrame:
    """(path, content): one workbook for each group (a bounded number of rows)."""

    def build(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"path": [name(int(key[0]))], "content": [workbook(sheets(frame))]})

    return rows.groupBy(group).applyInPandas(build, "path string, content binary")
