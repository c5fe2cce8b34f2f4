"""Fixed-width text: one string per line, cut by the layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.paths import plain_path
from feedlake.plans.defs import Layout

from .store import few_list_tasks


def slice_columns(layout: Layout, line: Column | None = None) -> list[Column]:
    """The trimmed fields of a line, by running offset; field names may repeat."""
    line = F.col("value") if line is None else line
    out, start = [], 1
    for f in layout.fields:
        out.append(F.trim(F.substring(line, start, f.width)).alias(f.name))
        start += f.width
    return out


def read_lines(spark: SparkSession, paths: list[str] | str, header: bool = False) -> DataFrame:
    """(value, file_path): every line of the files, or every line behind each file's first."""
    with few_list_tasks(spark):
        if header:
            reader = spark.read.schema("value string").option("header", True).option("enforceSchema", True)
            lines = reader.csv(paths, sep="\u0001", quote="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        else:
            lines = spark.read.text(paths)
    return lines.select("value", plain_path(F.col("_metadata.file_path")).alias("file_path"))


def read_fixed_width(spark: SparkSession, paths: list[str] | str, layout: Layout, strict_csv_lines: bool = False) -> DataFrame:
    """The layout's fields and file_path of every line; an empty line gives nulls.

    With `strict_csv_lines`, lines that a comma-separated reader of one column drops
    (those with a comma) are left out.
    """
    lines = read_lines(spark, paths, layout.header)
    if strict_csv_lines:
        lines = lines.filter(~F.col("value").contains(","))
    cells = [F.when(F.col("value") != "", c).alias(f.name) for c, f in zip(slice_columns(layout), layout.fields, strict=True)]
    return lines.select(*cells, "file_path")
