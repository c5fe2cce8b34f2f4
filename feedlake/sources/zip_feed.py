"""Archives: members, their safety, and CSV members as rows.

An archive is a row with its `source`, which tasks open and read by ranges, so that neither
archives nor members need fit in memory; or, for small ones that come from a table, with
its `content`.
"""

from __future__ import annotations

import csv
import io
import json
import zipfile
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from feedlake.operators.naming import header_names, unique_names

from .store import list_files, open_file

#: Lines handed to Spark at once, and bytes of packed members that one task reads; a larger member has a task of its own.
LINES, PART = 5000, 64 << 20
#: What a member counts for at least when tables of members are dealt to tasks: opening it takes time too.
OPEN = 256 << 10
#: Tasks that read members at most: a task takes about as long to start as to read some hundred kilobytes, so beyond that each reads more.
TASKS = 5000
ROWS = "archive string, member string, row_no bigint, cells array<string>"


def read_archives(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """(path, source, size, modified) of archive files, which aren't read yet."""
    return list_files(spark, paths)


def _handle(archives: DataFrame) -> str:
    return "source" if "source" in archives.columns else "content"


def _open(handle: str | bytes) -> zipfile.ZipFile:
    return zipfile.ZipFile(open_file(handle) if isinstance(handle, str) else io.BytesIO(handle))


def _dealt(archives: DataFrame) -> DataFrame:
    """Archives that tasks open, dealt to as many as there are cores: their rows are short, so that an adaptive plan would open all of them in one task."""
    if _handle(archives) == "content":
        return archives
    return archives.repartition(max(2, archives.sparkSession.sparkContext.defaultParallelism), "path")


def list_members(archives: DataFrame) -> DataFrame:
    """(archive, member, size, packed, attributes, error) from each archive's directory, which is all that is read of it."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for path, handle in zip(f["path"], f.iloc[:, 1], strict=True):
                try:
                    with _open(handle) as z:
                        rows += [(path, i.filename, i.file_size, i.compress_size, i.external_attr >> 16, None) for i in z.infolist() if not i.is_dir()]
                except zipfile.BadZipFile as e:
                    rows.append((path, None, None, None, None, str(e)))
            yield pd.DataFrame(rows, columns=["archive", "member", "size", "packed", "attributes", "error"])

    return _dealt(archives.select("path", _handle(archives))).mapInPandas(run, "archive string, member string, size bigint, packed bigint, attributes bigint, error string")


def audit_members(members: DataFrame) -> DataFrame:
    """Members with an array of violations: absolute paths, steps upward, links, other separators."""
    m = F.col("member")
    found = F.array_compact(
        F.array(
            F.when(m.rlike(r"^(/|[A-Za-z]:)"), "absolute"),
            F.when(m.rlike(r"(^|[/\\])\.\.([/\\]|$)"), "traversal"),
            F.when(m.contains("\\"), "separator"),
            F.when(F.col("attributes").bitwiseAND(0o170000) == 0o120000, "link"),
        )
    )
    return members.withColumn("violations", found)


def route_members(members: DataFrame, suffix: str, year: int, last_workbook_year: int = 2025) -> DataFrame:
    """Members of a family: the suffix before the ending, no data dictionary, workbooks up to a year and CSV after it."""
    name = F.lower("member")
    ending = ".xlsx" if year <= last_workbook_year else ".csv"
    return members.filter(name.endswith(suffix.lower() + ending) & ~name.contains("dictionary"))


def _records(z: zipfile.ZipFile, member: str) -> Iterator[list[str]]:
    """The records of a member from its header on; the member is unpacked as it is read."""
    with z.open(member) as raw:
        for cells in csv.reader(io.TextIOWrapper(raw, "utf-8-sig", newline="")):
            if cells:
                yield cells


def _columns(header: list[str]) -> list[str]:
    return unique_names([n.upper() for n in header_names(header)])


def _batches(handle: str | bytes, archive: str, members: list[str], columns: list[str] | None = None) -> Iterator[pa.RecordBatch]:
    """Rows of ROWS, the header as row 0; records whose number of cells differs from the header's are dropped.

    With `columns`, cells are in their order, by the member's own header, and null where it lacks one.
    """
    names = ["archive", "member", "row_no", "cells"]
    with _open(handle) as z:
        for member in members:
            width, numbers, rows = None, [], []

            def batch() -> pa.RecordBatch:
                columns = [pa.array([archive] * len(rows)), pa.array([member] * len(rows)), pa.array(numbers, pa.int64()), pa.array(rows, pa.list_(pa.string()))]  # noqa: B023
                return pa.RecordBatch.from_arrays(columns, names)

            for k, cells in enumerate(_records(z, member)):
                if width is None:
                    width = len(cells)
                    at = {n: i for i, n in enumerate(_columns(cells))} if columns else {}
                    places = [at.get(n) for n in columns or ()]
                if len(cells) == width:
                    numbers.append(k)
                    rows.append([None if i is None else cells[i] for i in places] if columns else cells)
                if len(rows) >= LINES:
                    yield batch()
                    numbers, rows = [], []
            if rows:
                yield batch()


class MemberPart(InputPartition):
    """Members read by one task: (source, archive, member)."""

    def __init__(self, members: list[tuple[str, str, str]]):
        self.members = members


class MemberReader(DataSourceReader):
    """Small members share a task, a large one has its own; each is unpacked in pieces of LINES records.

    Where parts of partBytes would be more than TASKS, their size is doubled until they aren't.
    """

    def __init__(self, options: dict[str, str]):
        self.members = [tuple(m) for m in json.loads(options["members"])]
        self.part = int(options.get("partBytes", PART))
        self.columns = json.loads(options.get("columns", "null"))

    def __getstate__(self) -> dict:
        """What every task gets: the list of all members isn't among it, as a task's part has its own."""
        return {"columns": self.columns}

    def _parts(self, limit: int) -> list[list[tuple]]:
        parts, size = [], 0
        for *where, packed in self.members:
            if not parts or size + packed > limit:
                parts.append([])
                size = 0
            parts[-1].append(tuple(where))
            size += packed
        return parts

    def partitions(self) -> list[MemberPart]:
        limit = max(self.part, 1)
        while len(parts := self._parts(limit)) > TASKS:
            limit *= 2
        return [MemberPart(p) for p in parts]

    def read(self, partition: MemberPart) -> Iterator[pa.RecordBatch]:
        for (source, archive), own in groupby(partition.members, lambda m: m[:2]):
            yield from _batches(source, archive, [m[2] for m in own], self.columns)


class ArchiveCsv(DataSource):
    """spark.read.format("archive_csv"): the records of CSV members of archives, by ranges.

    Options: members, a JSON list of [source, archive, member, packed bytes]; partBytes; columns, a JSON list
    of names in whose order cells are given.
    """

    planned = False

    @classmethod
    def name(cls) -> str:
        return "archive_csv"

    def schema(self) -> str:
        return ROWS

    def reader(self, schema) -> MemberReader:
        self.planned = True
        return MemberReader(self.options)

    def __getstate__(self) -> dict:
        """Tasks get the source that was planned, without its options: these list all members."""
        return {"options": {} if self.planned else self.options}


def member_rows(archives: DataFrame, members: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(archive, member, row_no, cells) of the chosen members' CSV records, the header as row 0; with `columns`, cells in their order.

    Records whose number of cells differs from the header's are dropped, quoted line ends are
    kept. The driver sees names of members, as it does of files.
    """
    if _handle(archives) == "source":
        own = archives.select(F.col("path").alias("archive"), "source")
        rows = members.join(own, "archive").select("source", "archive", "member", F.coalesce("packed", F.lit(PART)) if "packed" in members.columns else F.lit(PART)).distinct()
        return scan_members(archives.sparkSession, sorted(map(tuple, rows.collect()), key=lambda m: m[1:3]), columns=columns)
    chosen = members.groupBy("archive").agg(F.sort_array(F.collect_set("member")).alias("members"))
    both = archives.join(chosen, archives["path"] == chosen["archive"]).select("path", "content", "members")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content, wanted in zip(*[b.column(c).to_pylist() for c in ("path", "content", "members")], strict=True):
                yield from _batches(bytes(content), path, wanted, columns)

    return both.mapInArrow(run, ROWS)


def scan_members(spark: SparkSession, members: list[tuple[str, str, str, int]], part_bytes: int = PART, columns: list[str] | None = None) -> DataFrame:
    """The records of (source, archive, member, packed bytes)."""
    spark.dataSource.register(ArchiveCsv)
    return spark.read.format("archive_csv").option("members", json.dumps(members)).option("partBytes", part_bytes).option("columns", json.dumps(columns)).load()


def member_headers(archives: DataFrame, members: DataFrame) -> DataFrame:
    """(archive, member, header, source, packed) of the chosen members; only their first records are unpacked, source is null for contents."""
    handle, packed = _handle(archives), F.col("packed") if "packed" in members.columns else F.lit(PART).cast("bigint")
    chosen = members.groupBy("archive").agg(F.collect_set(F.struct("member", packed.alias("packed"))).alias("members"))
    both = archives.join(chosen, archives["path"] == chosen["archive"]).select("path", handle, "members")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for path, source, wanted in zip(*[c.to_pylist() for c in b.columns], strict=True):
                with _open(source) as z:
                    for m in wanted:
                        header = next(_records(z, m["member"]), None)
                        rows.append({"archive": path, "member": m["member"], "header": header, "source": source if isinstance(source, str) else None, "packed": m["packed"]})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("archive", pa.string()), ("member", pa.string()), ("header", pa.list_(pa.string())), ("source", pa.string()), ("packed", pa.int64())]))

    return _dealt(both).mapInArrow(run, "archive string, member string, header array<string>, source string, packed bigint")


def read_zip_csv(archives: DataFrame, members: DataFrame) -> DataFrame:
    """The chosen CSV members united by column name (upper case), every column a string, file_path archive!member.

    Members are read together, each once behind its first record and by its own header, however many
    headers there are; the driver sees headers and names of members. Empty members are left out.
    """
    spark = archives.sparkSession
    heads = member_headers(archives, members).filter("header IS NOT NULL").collect()
    if not heads:
        return spark.createDataFrame([], "file_path string")
    headers = [_columns(list(h)) for h in sorted({tuple(r["header"]) for r in heads})]
    columns = list(dict.fromkeys(n for names in headers for n in names))
    if _handle(archives) == "source":
        rows = scan_members(spark, sorted((r["source"], r["archive"], r["member"], max(r["packed"], OPEN)) for r in heads), columns=columns)
    else:
        rows = member_rows(archives, spark.createDataFrame([(r["archive"], r["member"]) for r in heads], "archive string, member string"), columns)
    cells = [F.nullif(F.col("cells")[k], F.lit("")).alias(n) for k, n in enumerate(columns)]
    first = len(headers[0])
    return rows.filter("row_no > 0").select(*cells[:first], F.concat("archive", F.lit("!"), "member").alias("file_path"), *cells[first:])
