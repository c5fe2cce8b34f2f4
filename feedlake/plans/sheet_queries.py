"""Queries over sectioned sheets whose cells are made from customers by nation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedlake.operators import sheets as S
from feedlake.workspace import table

from .defs import Sheet

MAIN = Sheet("main", "Table 1-%")
KEYS = Sheet("parameters", "Parameters", labels=("key", "note"))

#: The file of a customer: one for each nation and 400 customer numbers, so that a sheet has a bounded number of rows.
_FILE = "concat('/store/N', lpad(cast(c_nationkey as string), 2, '0'), '/', cast(floor(c_custkey / 400) as string), '.xlsx')"


def _rows(spark: SparkSession, sf: str) -> DataFrame:
    """The sheet's rows below its headers: (file_path, row_num, label, a, b, c).

    Row 1 is a title and row 2 the header, row 3 a group; then for each segment a
    bracketed section and its customers, at last notes and a row behind them.
    """
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", F.round(F.col("c_acctbal") * 100).cast("bigint").alias("cents"), F.expr(_FILE).alias("file_path"))
    k = F.col("c_custkey")
    label = F.when(k % 50 == 0, F.concat(F.lit("[9] "), "c_name")).when(k % 51 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), "c_name", F.lit("  [2]")))
    data = c.select("file_path", "c_mktsegment", F.lit(1).alias("kind"), k.alias("ord"), label.alias("label"), k.cast("string").alias("a"), F.when(k % 5 != 0, F.col("cents").cast("string")).alias("b"), F.lit("x").alias("c"))
    text = lambda v: F.lit(v).cast("string")
    heads = c.select("file_path", "c_mktsegment").distinct().select("file_path", "c_mktsegment", F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("ord"), F.concat(F.lit("["), F.substring("c_mktsegment", 1, 1), F.lit("1] "), "c_mktsegment").alias("label"), text(None).alias("a"), text(None).alias("b"), text(None).alias("c"))
    w = Window.partitionBy("file_path").orderBy("c_mktsegment", "kind", "ord")
    return data.unionByName(heads).select("file_path", (F.row_number().over(w) + 3).cast("bigint").alias("row_num"), "label", "a", "b", "c")


def cells(spark: SparkSession, sf: str, two_rows: bool = False) -> DataFrame:
    """The cell table of all files: sheet 'Table 1-Main' in each, 'Table 2-Small' in some, 'Parameters' in each."""
    rows = _rows(spark, sf)
    last = rows.groupBy("file_path").agg(F.max("row_num").alias("m"))
    fixed = [
        (F.lit(1), "Report", None, None, None),
        (F.lit(2), None, "Number", None if two_rows else "Balance", "Mark"),
        (F.lit(3), "All customers", None, None, None),
        (F.col("m") + 1, "NOTE: rounded", None, None, None),
        (F.col("m") + 2, "behind", "1", "2", "3"),
    ]
    lit = lambda v: F.lit(v).cast("string")
    frame = F.explode(F.array(*[F.struct(r.cast("bigint").alias("row_num"), lit(x).alias("label"), lit(a).alias("a"), lit(b).alias("b"), lit(c).alias("c")) for r, x, a, b, c in fixed]))
    every = rows.unionByName(last.select("file_path", frame.alias("f")).select("file_path", "f.*"))
    if two_rows:
        every = every.withColumn("b", F.when(F.col("row_num") == 3, "Balance").otherwise(F.col("b"))).withColumn("label", F.when(F.col("row_num") == 3, None).otherwise(F.col("label")))
    cell = F.explode(F.array(*[F.struct(F.lit(k).alias("col_idx"), F.col(v).alias("value")) for k, v in enumerate(("label", "a", "b", "c"))]))
    main = every.select("file_path", F.lit("Table 1-Main").alias("sheet"), "row_num", cell.alias("x")).select("file_path", "sheet", "row_num", "x.*")
    other = last.filter("m % 2 = 0").select("file_path", F.lit("Table 2-Small").alias("sheet"), F.lit(1).cast("bigint").alias("row_num"), F.lit(0).alias("col_idx"), F.lit("t").alias("value"))
    parts = F.explode(F.array(*[F.struct(F.lit(r).cast("bigint").alias("row_num"), F.lit(c).alias("col_idx"), v.alias("value")) for r, c, v in ((1, 0, F.lit("Rows")), (1, 1, F.col("m").cast("string")), (2, 0, F.lit("NOTE")), (2, 1, F.lit("kept")), (2, 2, F.lit("second")), (2, 3, F.lit("dropped")))]))
    params = last.select("file_path", F.lit("Parameters").alias("sheet"), parts.alias("p")).select("file_path", "sheet", "p.*")
    return main.unionByName(other).unionByName(params).filter("value IS NOT NULL").withColumn("error", F.lit(None).cast("string"))


def _grid(spark: SparkSession, sf: str, two_rows: bool = False) -> DataFrame:
    return S.sheet_grid(cells(spark, sf, two_rows), [MAIN])


def sheet_header_detect(spark: SparkSession, sf: str) -> DataFrame:
    return S.sheet_headers(_grid(spark, sf)).select("file_path", "header_row")


def sheet_row_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return S.sheet_headers(_grid(spark, sf)).select("file_path", "last_row", "notes_row")


def footnote_filter(spark: SparkSession, sf: str) -> DataFrame:
    return S.body_rows(_grid(spark, sf), [MAIN]).groupBy("file_path").agg(F.count(F.lit(1)).alias("n"), F.max("row_num").alias("last"))


def two_row_header_merge(spark: SparkSession, sf: str) -> DataFrame:
    each = S.sheet_headers(_grid(spark, sf, True)).select("file_path", "last_row", F.explode("columns").alias("c"))
    return each.select("file_path", F.col("c.col_idx").cast("bigint").alias("col_idx"), "c.column_group", "c.column_label", "last_row")


def section_forward_fill(spark: SparkSession, sf: str) -> DataFrame:
    return S.fill_sections(S.body_rows(_grid(spark, sf), [MAIN])).drop("sheet_no", "sheet", "columns", "vals")


def sheet_unpivot(spark: SparkSession, sf: str) -> DataFrame:
    return S.tidy_sheets(cells(spark, sf), MAIN).drop("sheet")


def key_value_sheet(spark: SparkSession, sf: str) -> DataFrame:
    return S.tidy_sheets(cells(spark, sf), KEYS).select("file_path", "row_num", "row_label", "column_label", "value_text")


def optional_sheet_empty(spark: SparkSession, sf: str) -> DataFrame:
    return S.tidy_sheets(cells(spark, sf), Sheet("absent", r"Table\_9-%")).drop("sheet")


def sheet_pattern_match(spark: SparkSession, sf: str) -> DataFrame:
    names = cells(spark, sf).select("file_path", "sheet").distinct()
    return S.match_sheets(names, "Table%").select("file_path", "n", F.array_join("candidates", ",").alias("candidates"), "sheet")


QUERIES = {
    "sheet_header_detect": sheet_header_detect, "sheet_row_bounds": sheet_row_bounds, "footnote_filter": footnote_filter, "two_row_header_merge": two_row_header_merge,
    "section_forward_fill": section_forward_fill, "sheet_unpivot": sheet_unpivot, "key_value_sheet": key_value_sheet, "optional_sheet_empty": optional_sheet_empty,
    "sheet_pattern_match": sheet_pattern_match,
}

_SQL = """
    WITH c AS (SELECT c_custkey AS k, c_name, c_mktsegment AS seg, round(c_acctbal * 100)::BIGINT AS cents,
                      '/store/N' || lpad(c_nationkey::VARCHAR, 2, '0') || '/' || (c_custkey // 400) || '.xlsx' AS file_path FROM customer),
    u AS (SELECT file_path, seg, 1 AS kind, k, c_name, cents FROM c UNION ALL SELECT DISTINCT file_path, seg, 0, 0, NULL, NULL FROM c),
    r AS (SELECT *, row_number() OVER (PARTITION BY file_path ORDER BY seg, kind, k) + 3 AS row_num FROM u),
    m AS (SELECT file_path, max(row_num) AS m FROM r GROUP BY 1)
"""
_DATA = "SELECT file_path, row_num, 'All customers' AS group_label, seg[1] || '1' AS section_code, seg AS section_label, c_name AS row_label, NULL::VARCHAR AS column_group_label"

ORACLES = {
    "sheet_header_detect": _SQL + "SELECT file_path, 2 AS header_row FROM m",
    "sheet_row_bounds": _SQL + "SELECT file_path, 2 AS last_row, m + 1 AS notes_row FROM m",
    "footnote_filter": _SQL + """
        , b AS (SELECT file_path, row_num FROM r WHERE kind = 0 OR (k % 50 <> 0 AND k % 51 <> 0) UNION ALL SELECT file_path, 3 FROM m)
        SELECT file_path, count(*) AS n, max(row_num) AS last FROM b GROUP BY 1""",
    "two_row_header_merge": _SQL + """
        SELECT file_path, col_idx, column_group, column_label, 3 AS last_row FROM m,
        (VALUES (1, NULL, 'Number'), (2, 'Number', 'Balance'), (3, NULL, 'Mark')) AS v(col_idx, column_group, column_label)""",
    "section_forward_fill": _SQL + """
        SELECT file_path, 3 AS row_num, 'All customers' AS row_label, true AS is_section, NULL AS section_code, 'All customers' AS section_label, 'All customers' AS group_label FROM m
        UNION ALL SELECT file_path, row_num, CASE WHEN kind = 0 THEN '[' || seg[1] || '1] ' || seg ELSE c_name END, kind = 0, seg[1] || '1', seg, 'All customers'
        FROM r WHERE kind = 0 OR (k % 50 <> 0 AND k % 51 <> 0)""",
    "sheet_unpivot": _SQL + f"""
        {_DATA}, 'Number' AS column_label, k::VARCHAR AS value_text FROM r WHERE kind = 1 AND k % 50 <> 0 AND k % 51 <> 0
        UNION ALL {_DATA}, 'Balance', CASE WHEN k % 5 <> 0 THEN cents::VARCHAR END FROM r WHERE kind = 1 AND k % 50 <> 0 AND k % 51 <> 0
        UNION ALL {_DATA}, 'Mark', 'x' FROM r WHERE kind = 1 AND k % 50 <> 0 AND k % 51 <> 0""",
    "key_value_sheet": _SQL + """
        SELECT file_path, 1 AS row_num, 'Rows' AS row_label, 'key' AS column_label, m::VARCHAR AS value_text FROM m UNION ALL SELECT file_path, 1, 'Rows', 'note', NULL FROM m
        UNION ALL SELECT file_path, 2, 'NOTE', 'key', 'kept' FROM m UNION ALL SELECT file_path, 2, 'NOTE', 'note', 'second' FROM m""",
    "optional_sheet_empty": _SQL + f"{_DATA}, 'Number' AS column_label, k::VARCHAR AS value_text FROM r WHERE false",
    "sheet_pattern_match": _SQL + """
        SELECT file_path, CASE WHEN m % 2 = 0 THEN 2 ELSE 1 END AS n, CASE WHEN m % 2 = 0 THEN 'Table 1-Main,Table 2-Small' ELSE 'Table 1-Main' END AS candidates,
               CASE WHEN m % 2 <> 0 THEN 'Table 1-Main' END AS sheet FROM m""",
}
