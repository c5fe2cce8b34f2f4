"""Where a row came from."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.functions import paths as P


def with_lineage(df: DataFrame, file_date: Column | None = None) -> DataFrame:
    """directory_name, file_name and file_date from file_path; the date is the path's stamp unless given."""
    path = F.col("file_path")
    date = P.short_stamp_date(path) if file_date is None else file_date
    return df.withColumns({"directory_name": P.directory_name(path), "file_name": P.base_name(path), "file_date": date})


def file_dates(family: str, path: Column) -> Column:
    """A file's date: 'path' the leftmost stamp of its path, 'stamp' the .D stamp of its name, 'year' and 'quarter' the end of what its name says, 'load' today."""
    name = P.base_name(path)
    return {"path": P.short_stamp_date(path), "stamp": P.creation_date(name), "year": P.year_end(name), "quarter": P.quarter_end(P.quarter_token(name)), "load": F.current_date()}[family]


def with_workbook_metadata(df: DataFrame, family: str, org: str, token: str = "") -> DataFrame:
    """Lineage of workbooks and what their path says of organisation, years, submission and period.

    `family` says which date a file has (see `file_dates`) and what its period is: of 'stamp'
    the submission, of 'year' Y and the year, else the quarter. The year follows `token`.
    """
    path, name = F.col("file_path"), P.base_name(F.col("file_path"))
    year = F.nullif(F.regexp_extract(name, re.escape(token.rstrip(".")) + r"\.Y([0-9]{4})\.", 1), F.lit(""))
    submission = P.submission_id(name)
    period = {"stamp": submission, "year": F.concat(F.lit("Y"), year)}.get(family, P.quarter_token(name))
    date = F.make_date(year.cast("int"), F.lit(12), F.lit(31)) if family == "year" else file_dates(family, path)
    return with_lineage(df, date).withColumns(
        {"aco_id": F.lit(org), "performance_year": P.year_segment(path, org), "benchmark_year": year, "submission_id": submission, "period": period}
    )


def split_stamped(listing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined) by whether the file's name carries its stamps."""
    ok = F.coalesce(P.is_stamped(P.base_name(F.col("file_path"))), F.lit(False))
    return listing.filter(ok), listing.filter(~ok)
