"""CSV feeds whose headers drift from file to file."""

from __future__ import annotations

import csv
import io
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.functions.paths import plain_path
from feedlake.functions.text import snake_case
from feedlake.operators.naming import header_names, unique_names

from .store import few_list_tasks, list_files, open_file

#: Files up to this size are read by one task anyway, so whether quotes run over line ends needs no look at them.
WHOLE = 128 << 20


def first_records(files: DataFrame) -> DataFrame:
    """(path, size, header, padded): the first record that isn't blank of each of `list_files`; only the start of a file is read.

    padded: whether a line of nothing but blanks comes before it, which a reader of whole records takes for the header.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            heads, padded = [], []
            for source in b.column("source").to_pylist():
                with open_file(source) as f:
                    records = csv.reader(io.TextIOWrapper(f, "utf-8-sig", errors="replace", newline=""), skipinitialspace=True)
                    ahead = False
                    for record in records:
                        if any(c.strip() for c in record):
                            break
                        ahead = ahead or bool(record)
                    else:
                        record = None
                    heads.append(record)
                    padded.append(ahead)
            columns = [b.column("path"), b.column("size"), pa.array(heads, pa.list_(pa.string())), pa.array(padded, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["path", "size", "header", "padded"])

    return files.select("path", "size", "source").mapInArrow(run, "path string, size bigint, header array<string>, padded boolean")


def quoted_line_ends(spark: SparkSession, paths: list[str]) -> set[str]:
    """Which of some large files have a quoted field that runs over a line end.

    Such a field opens in a line and isn't closed there: only quotes at the start of a field open
    one, so a stray quote inside a field doesn't count. The lines of these files are read once more.
    """
    if not paths:
        return set()
    with few_list_tasks(spark):
        lines = spark.read.text(paths)
    lines = lines.select("value", plain_path(F.col("_metadata.file_path")).alias("path"))
    closed = F.regexp_replace("value", r'(^|,) *"([^"]|"")*"(?=\s*(,|$))', "$1")
    found = lines.groupBy("path").agg(F.bool_or(closed.rlike(r'(^|,) *"')).alias("open")).filter("open")
    return {r["path"] for r in found.collect()}


def read_csv_union(spark: SparkSession, paths: list[str] | str, normalize: bool = False) -> DataFrame:
    """Every column as string, files united by column name, ragged lines dropped, file_path added.

    Files are read together by equal header (the driver sees headers and paths only),
    since one read takes its columns by position from the first file. Blank lines ahead of the
    header are passed over, columns without a name are named by their place. Quoted commas,
    quotes and line ends are kept, in headers and in fields; files without a record are left out.
    Only of a file with blanks alone ahead of its header and with quoted line ends are rows that
    repeat the header taken for it.
    """
    heads = first_records(list_files(spark, paths)).filter("header IS NOT NULL").collect()
    limit = min(WHOLE, spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes")))
    unsure = [r["path"] for r in heads if r["size"] > limit or r["padded"]]
    split = set(unsure) - quoted_line_ends(spark, unsure)
    groups = defaultdict(list)
    for r in heads:
        groups[tuple(r["header"]), r["path"] not in split, r["padded"]].append(r["path"])
    frames = []
    for (header, multiline, padded), files in sorted(groups.items()):
        names = header_names(list(header))
        names = [snake_case(n) or n for n in names] if normalize else [n.upper() for n in names]
        schema = T.StructType([T.StructField(n, T.StringType()) for n in unique_names(names)])
        reader = spark.read.option("escape", '"').option("multiLine", multiline).option("mode", "DROPMALFORMED").option("columnPruning", False)
        with few_list_tasks(spark):
            rows = reader.schema(schema).option("header", True).csv(sorted(files))
        rows = rows.select("*", plain_path(F.col("_metadata.file_path")).alias("file_path"))
        if multiline and padded:
            cells = zip(schema.names, header, strict=True)
            rows = rows.filter(~reduce(lambda a, b: a & b, [F.col(f"`{n}`").eqNullSafe(F.lit(h or None)) for n, h in cells]))
        frames.append(rows)
    if not frames:
        return spark.createDataFrame([], "file_path string")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
