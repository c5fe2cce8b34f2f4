"""Listings of a remote store and the state of what was fetched."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.functions.paths import creation_date

RECORD = "struct<last_updated:string,downloaded_at:string,uploaded_at:string,remote_prefix:string,s3_prefix:string>"
STATE = f"struct<last_run:string,downloaded:map<string,map<string,map<string,map<string,{RECORD}>>>>>"


def parse_listing(lines: DataFrame, column: str = "value") -> DataFrame:
    """(n, total, filename, size, last_updated) of lines 'n of m - NAME (size) Last Updated: time'; other lines are left out."""
    p = r"^\s*([0-9]+) of ([0-9]+) - (\S+) \(([^)]*)\) Last Updated: (\S+)\s*$"
    get = lambda k: F.regexp_extract(column, p, k)
    rows = lines.filter(F.col(column).rlike(p))
    return rows.select(get(1).cast("bigint").alias("n"), get(2).cast("bigint").alias("total"), get(3).alias("filename"), get(4).alias("size"), get(5).alias("last_updated"))


def parse_codes(lines: DataFrame, column: str = "value") -> DataFrame:
    """(title, code) of lines '-----Title, Code n'."""
    p = r"^-+\s*(.*\S)\s*,\s*Code\s+([0-9]+)\s*$"
    return lines.filter(F.col(column).rlike(p)).select(F.regexp_extract(column, p, 1).alias("title"), F.regexp_extract(column, p, 2).cast("bigint").alias("code"))


def flatten_state(docs: DataFrame, column: str = "value") -> DataFrame:
    """(org, year, code, filename, last_updated, downloaded_at, uploaded_at, remote_prefix) of nested state documents."""
    rows = docs.select(F.from_json(column, STATE).alias("s")).select(F.explode("s.downloaded").alias("org", "years"))
    rows = rows.select("org", F.explode("years").alias("year", "codes")).select("org", "year", F.explode("codes").alias("code", "files"))
    rows = rows.select("org", "year", "code", F.explode("files").alias("filename", "r"))
    return rows.select("org", "year", "code", "filename", "r.last_updated", "r.downloaded_at", "r.uploaded_at", F.coalesce("r.remote_prefix", "r.s3_prefix").alias("remote_prefix"))


def new_remote_files(listing: DataFrame, state: DataFrame, require_upload: bool = False) -> DataFrame:
    """Listed files that the state lacks or has with another time; with `require_upload` those not uploaded are new too."""
    known = state.filter("uploaded_at IS NOT NULL") if require_upload else state
    return listing.join(known, ["org", "year", "code", "filename", "last_updated"], "left_anti")


def creation_cutoff(new_files: DataFrame) -> DataFrame:
    """(year, code, cutoff): the oldest creation date among new files; null where a name has none that can be read."""
    d = creation_date(F.col("filename"))
    return new_files.groupBy("year", "code").agg(F.when(F.count_if(d.isNull()) == 0, F.min(d)).alias("cutoff"))
