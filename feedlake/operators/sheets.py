"""Sectioned sheets: from cells to one row per data row and column, all workbooks in one plan.

Every step is a window over the sheet, which is in place after one exchange of the cells: column 0
is the label column, others hold values; rows are numbered from 1.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.functions.text import is_blank, normalize_label
from feedlake.plans.defs import Sheet

KEY = ["sheet_no", "file_path", "sheet"]
BRACKET = r"^\s*\[([A-Za-z0-9]+)\]\s*(.*)$"
FOOTNOTE = r"^\s*\[[0-9]+\]"


class SheetError(ValueError):
    """A sheet that breaks the grammar's conditions."""


def match_sheets(names: DataFrame, pattern: str) -> DataFrame:
    """(file_path, n, candidates, sheet): sheets whose name is LIKE the pattern; `sheet` is null where not exactly one is."""
    found = names.withColumn("hit", F.col("sheet").like(pattern))
    out = found.groupBy("file_path").agg(F.count_if("hit").alias("n"), F.sort_array(F.collect_set(F.when(F.col("hit"), F.col("sheet")))).alias("candidates"))
    return out.withColumn("sheet", F.when(F.col("n") == 1, F.element_at("candidates", 1)))


def _per_sheet(sheets: list[Sheet], value: Callable[[Sheet], object], kind: str) -> Column:
    """A definition's property by `sheet_no`."""
    return reduce(lambda out, k: F.when(F.col("sheet_no") == k, F.lit(value(sheets[k]))).otherwise(out), range(len(sheets)), F.lit(None)).cast(kind)


def _header(vals: Column, row: Column, below: Column) -> Column:
    """(columns, last_row) of the header in a row of values by column; `below` is the next row (row_num, label, vals).

    The next row continues the header if its label is blank and it labels a column
    whose primary header is blank; then a primary header reaches right to the next.
    """
    text = lambda c: F.when(~is_blank(c), normalize_label(c))
    near = below["row_num"] == row + 1
    under = F.when(near, below["vals"])
    places = F.array_sort(F.array_union(F.map_keys(vals), F.coalesce(F.map_keys(under), F.array().cast("array<int>"))))
    grid = F.transform(places, lambda c: F.struct(c.alias("col_idx"), text(F.try_element_at(vals, c)).alias("head"), text(F.try_element_at(under, c)).alias("sub")))
    goes_on = F.exists(grid, lambda g: g["head"].isNull() & g["sub"].isNotNull()) & F.when(near, below["label"]).isNull()
    carried = lambda i: F.try_element_at(F.filter(F.slice(grid, F.lit(1), i + 1), lambda x: x["head"].isNotNull()), F.lit(-1))["head"]
    sub = lambda g: F.when(goes_on, g["sub"])
    named = F.transform(grid, lambda g, i: F.struct(g["col_idx"].alias("col_idx"), F.when(sub(g).isNotNull(), carried(i)).alias("column_group"), F.coalesce(sub(g), g["head"]).alias("column_label")))
    return F.struct(F.filter(named, lambda g: g["column_label"].isNotNull()).alias("columns"), (row + goes_on.cast("int")).alias("last_row"))


def sheet_grid(cells: DataFrame, sheets: list[Sheet]) -> DataFrame:
    """One row for each row of each sheet that fits a definition, with what its sheet's header says.

    (sheet_no, file_path, sheet, row_num, label, vals, n_sheets, header_row, columns, last_row, notes_row): the
    definition; the label and the values by column; sheets of the workbook that fit; columns
    (col_idx, column_group, column_label); data lies behind last_row and before notes_row (null: to the end).

    Cells meet once, by definition and workbook; all that follows is windows over that one order. The header
    is the hinted row, or the first with two values that aren't blank; definitions with labels
    have these for columns 1, 2, ... and data from row 1.
    """
    fits = F.explode(F.array_compact(F.array(*[F.when(F.col("sheet").like(s.pattern), F.lit(k)) for k, s in enumerate(sheets)])))
    own = cells.select("file_path", "sheet", "row_num", F.col("col_idx").cast("int").alias("col_idx"), "value", fits.alias("sheet_no")).repartition("sheet_no", "file_path")
    held = F.sort_array(F.collect_list(F.when(F.col("col_idx") > 0, F.struct("col_idx", "value"))))
    rows = own.groupBy(*KEY, "row_num").agg(F.max(F.when(F.col("col_idx") == 0, F.col("value"))).alias("label"), held.alias("held"))
    once = F.filter("held", lambda x, i: (i == 0) | (x["col_idx"] != F.get(F.col("held"), i - 1)["col_idx"]))
    rows = rows.select(*KEY, "row_num", "label", F.map_from_entries(once).alias("vals"))

    sheet, order = Window.partitionBy(*KEY), Window.partitionBy(*KEY).orderBy("row_num")
    n_full = F.size(F.filter(F.map_values("vals"), lambda v: ~is_blank(v)))
    hint = _per_sheet(sheets, lambda s: s.header_row, "bigint")
    fit = F.when(hint.isNotNull(), (F.col("row_num") == hint) & (n_full > 0)).otherwise(n_full > 1)
    below = F.lead(F.struct("row_num", normalize_label(F.col("label")).alias("label"), "vals")).over(order)
    rows = rows.withColumns({"below": below, "n_sheets": F.size(F.collect_set("sheet").over(Window.partitionBy("sheet_no", "file_path")))})
    rows = rows.withColumn("header_row", F.min(F.when(fit, F.col("row_num"))).over(sheet))
    header = F.first(F.when(F.col("row_num") == F.col("header_row"), _header(F.col("vals"), F.col("row_num"), F.col("below"))), ignorenulls=True).over(sheet)
    for k, s in enumerate(sheets):
        if s.labels:
            names = F.array(*[F.struct(F.lit(c).alias("col_idx"), F.lit(None).cast("string").alias("column_group"), F.lit(x).alias("column_label")) for c, x in enumerate(s.labels, 1)])
            header = F.when(F.col("sheet_no") == k, F.struct(names.alias("columns"), F.lit(0).cast("bigint").alias("last_row"))).otherwise(header)
    rows = rows.withColumn("header", header).select(*KEY, "row_num", "label", "vals", "n_sheets", "header_row", "header.columns", "header.last_row")
    note = (F.col("row_num") > F.col("last_row")) & F.upper(normalize_label(F.col("label"))).startswith("NOTE") & ~_keeps_notes(sheets)
    return rows.withColumn("notes_row", F.min(F.when(note, F.col("row_num"))).over(sheet))


def _keeps_notes(sheets: list[Sheet]) -> Column:
    return _per_sheet(sheets, lambda s: s.include_notes or bool(s.labels), "boolean")


def sheet_headers(grid: DataFrame) -> DataFrame:
    """(sheet_no, file_path, sheet, n_sheets, header_row, columns, last_row, notes_row): one row for each sheet."""
    return grid.groupBy(*KEY).agg(*[F.first(c).alias(c) for c in ("n_sheets", "header_row", "columns", "last_row", "notes_row")])


def _problem(sheets: list[Sheet]) -> Column:
    """What is wrong with a sheet, or null: its definition fits another one too, or it has no header."""
    many = F.format_string("%s: %s fits %s sheets", F.col("file_path"), _per_sheet(sheets, lambda s: s.pattern, "string"), F.col("n_sheets"))
    bare = F.format_string("%s: no header in %s", F.col("file_path"), F.col("sheet"))
    return F.when(F.col("n_sheets") > 1, many).when(F.col("columns").isNull(), bare)


def sheet_problems(cells: DataFrame, sheets: list[Sheet]) -> DataFrame:
    """(file_path, table, problem) of the sheets that can't be read."""
    found = sheet_headers(sheet_grid(cells, sheets)).select("file_path", _per_sheet(sheets, lambda s: s.table, "string").alias("table"), _problem(sheets).alias("problem"))
    return found.filter("problem IS NOT NULL")


def body_rows(grid: DataFrame, sheets: list[Sheet], strict: bool = False) -> DataFrame:
    """The labelled rows within the bounds, footnote definitions left out; with `strict`, a sheet with a problem ends the job."""
    inside = (F.col("row_num") > F.col("last_row")) & (F.col("notes_row").isNull() | (F.col("row_num") < F.col("notes_row")))
    inside = inside & ~is_blank(F.col("label")) & (_keeps_notes(sheets) | ~F.col("label").rlike(FOOTNOTE))
    if strict:
        inside = F.when(_problem(sheets).isNotNull(), F.raise_error(_problem(sheets)).cast("boolean")).otherwise(inside)
    return grid.filter(inside)


def fill_sections(rows: DataFrame) -> DataFrame:
    """Body rows with row_label, is_section, and section_code, section_label and group_label filled downward.

    A bracketed row, or one without values, starts a section; one without values and
    brackets starts a group too. The row that starts it gives a section's values,
    nulls included, so that a section without a code clears the code before it.
    """
    empty = ~F.exists("columns", lambda c: ~is_blank(F.try_element_at(F.col("vals"), c["col_idx"])))
    code = F.nullif(F.regexp_extract("label", BRACKET, 1), F.lit(""))
    rest = normalize_label(F.regexp_extract("label", BRACKET, 2))
    rows = rows.withColumns({"is_section": empty, "code": code, "rest": rest, "row_label": normalize_label(F.col("label"))})
    starts = F.col("code").isNotNull() | F.col("is_section")
    own_label = F.when(F.col("code").isNotNull(), F.coalesce("rest", "code")).otherwise(F.col("row_label"))
    before = Window.partitionBy(*KEY).orderBy("row_num").rowsBetween(Window.unboundedPreceding, 0)
    section = F.last(F.when(starts, F.struct(F.col("code").alias("code"), own_label.alias("label"))), ignorenulls=True).over(before)
    group = F.last(F.when(F.col("is_section") & F.col("code").isNull(), F.struct("row_label")), ignorenulls=True).over(before)
    rows = rows.withColumns({"section": section, "group": group})
    return rows.select(*KEY, "row_num", "row_label", "is_section", F.col("section.code").alias("section_code"), F.col("section.label").alias("section_label"), F.col("group.row_label").alias("group_label"), "columns", "vals")


def unpivot_cells(rows: DataFrame) -> DataFrame:
    """A row for each data row and retained column, values as they are; a blank cell is a null value."""
    each = rows.filter("NOT is_section").withColumn("c", F.explode("columns"))
    value = F.try_element_at(F.col("vals"), F.col("c.col_idx")).alias("value_text")
    return each.select(*KEY, "row_num", "group_label", "section_code", "section_label", "row_label", F.col("c.column_group").alias("column_group_label"), "c.column_label", value)


def tidy_family(cells: DataFrame, sheets: list[Sheet], strict: bool = False) -> DataFrame:
    """All sheets that fit any of a family's definitions as one long table, with the definition's `table`, in one pass over the cells.

    With `strict`, an ambiguous pattern or a sheet without a header ends the job with an
    error; without, such a sheet adds what can be read of it, or no rows.
    """
    rows = unpivot_cells(fill_sections(body_rows(sheet_grid(cells, sheets), sheets, strict)))
    return rows.withColumn("table", _per_sheet(sheets, lambda s: s.table, "string")).drop("sheet_no")


def tidy_sheets(cells: DataFrame, sheet: Sheet, check: bool = False) -> DataFrame:
    """All sheets that match a definition as one long table; a workbook without the sheet adds no rows.

    With `check`, an ambiguous pattern or a sheet without a header is an error at once (one
    job over the cells); without, such a sheet adds no rows.
    """
    if check:
        bad = sheet_problems(cells, [sheet]).limit(1).collect()
        if bad:
            raise SheetError(bad[0]["problem"])
    return tidy_family(cells, [sheet]).drop("table")


def wide_unpivot(df: DataFrame, keys: list[str], columns: dict[str, str]) -> DataFrame:
    """Wide to long: a row for each column with its label, values as strings, in one pass."""
    names = F.array(*[F.lit(x) for x in columns.values()])
    values = F.array(*[F.col(c).cast("string") for c in columns])
    pairs = F.arrays_zip(names.alias("column_label"), values.alias("value_text"))
    return df.select(*keys, F.inline(pairs).alias("column_label", "value_text"))


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
