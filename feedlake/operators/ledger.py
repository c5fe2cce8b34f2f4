"""What a table has been loaded from, and how a batch becomes part of it.

A table at a path has a ledger in its folder `_ledger`, which readers of the table pass over:
a row for each loaded file or member, with its number of rows, also where that is 0, and one
for each archive of which nothing is left to load. A batch is staged with its ledger rows
in `_staging`, marked as ready, then moved, the ledger last. Whoever comes next finishes
what is marked and removes what isn't, so that a batch is loaded once or not at all. Small
batches are staged together, by one job, and then marked and moved one by one.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feedlake.sinks import path_class, path_exists
from feedlake.sources.store import few_list_tasks

from .naming import align_by_name

LEDGER = "file_path string, archive string, member string, size bigint, modified timestamp, n_rows bigint, batch string, columns string"
READY = "_READY"
#: A folder in a batch that isn't ready yet; it becomes READY by a rename.
MARK = "_MARK"
#: Threads that bring staged batches into folders of their own.
MOVERS = 8
#: Column and folders by which staged rows of several batches are told apart.
BATCH = "__batch"


def _fs(spark: SparkSession, path: str):
    p = path_class(spark._jvm)(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    fs, p = _fs(spark, old)
    target = path_class(spark._jvm)(new)
    fs.mkdirs(target.getParent())
    if not fs.rename(p, target):
        raise OSError(f"{old} can't be renamed to {new}")


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file with this text, in place of any there."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_ledger(spark: SparkSession, target: str) -> DataFrame:
    """The ledger of a table; an empty one where there is none."""
    if path_exists(spark, f"{target}/_ledger"):
        return spark.read.schema(LEDGER).parquet(f"{target}/_ledger")
    return spark.createDataFrame([], LEDGER)


def adopt(spark: SparkSession, target: str) -> None:
    """Give a table that was loaded without a ledger one, from its distinct file paths."""
    if not path_exists(spark, target) or path_exists(spark, f"{target}/_ledger"):
        return
    rows = spark.read.option("mergeSchema", True).parquet(target)
    known = rows.groupBy("file_path").agg(F.count(F.lit(1)).alias("n_rows")).withColumns({"batch": F.lit("adopted"), "columns": F.lit(rows.schema.json())})
    align_by_name(known, StructType.fromDDL(LEDGER)).coalesce(1).write.mode("overwrite").parquet(f"{target}/_staging/adopted/ledger")
    _mark(spark, f"{target}/_staging/adopted")
    _finish(spark, target, "adopted")


def table_schema(spark: SparkSession, target: str) -> StructType | None:
    """The columns of a table and those that later batches added, from its ledger; None where there is no table."""
    if not path_exists(spark, target):
        return None
    kept = read_ledger(spark, target).filter("columns IS NOT NULL").select("columns").distinct().collect()
    if not kept:
        if path_exists(spark, f"{target}/_ledger"):
            return None
        return spark.read.option("mergeSchema", True).parquet(target).schema
    fields = {f.name.lower(): f for r in sorted(kept, key=lambda r: len(r["columns"]), reverse=True) for f in StructType.fromJson(json.loads(r["columns"]))}
    first = StructType.fromJson(json.loads(max((r["columns"] for r in kept), key=len)))
    return StructType([*first, *[f for n, f in fields.items() if n not in {x.name.lower() for x in first}]])


def read_table(spark: SparkSession, target: str) -> DataFrame:
    """A loaded table with all columns that any batch has."""
    return spark.read.schema(table_schema(spark, target)).parquet(target)


def _finish(spark: SparkSession, target: str, batch: str) -> None:
    """Move a ready batch's files; those that are moved already are no longer there."""
    stage = f"{target}/_staging/{batch}"
    for folder, into in (("data", target), ("ledger", f"{target}/_ledger")):
        for name in _children(spark, f"{stage}/{folder}"):
            if name.startswith("part-"):
                rename(spark, f"{stage}/{folder}/{name}", f"{into}/part-{batch}-{name.removeprefix('part-')}")
    delete(spark, stage)


def recover(spark: SparkSession, target: str) -> None:
    """Bring a table to the end of its last ready batch, or a refresh to its end, and remove what is unfinished."""
    old, new = f"{target}__old", f"{target}__new"
    if path_exists(spark, f"{new}/{READY}"):
        delete(spark, target)
        rename(spark, new, target)
    elif not path_exists(spark, target) and path_exists(spark, old):
        rename(spark, old, target)
    for rest in (old, new):
        delete(spark, rest)
    delete(spark, f"{target}/{READY}")
    for batch in _children(spark, f"{target}/_staging"):
        if path_exists(spark, f"{target}/_staging/{batch}/{READY}"):
            _finish(spark, target, batch)
        else:
            delete(spark, f"{target}/_staging/{batch}")
    adopt(spark, target)


def _mark(spark: SparkSession, folder: str) -> None:
    fs, p = _fs(spark, f"{folder}/{READY}")
    fs.create(p, True).close()


def batch_name(files: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(files)).encode()).hexdigest()[:16]


def known_batches(spark: SparkSession, target: str, batches: list[str]) -> set[str]:
    """Which of the batches the ledger has."""
    return {r["batch"] for r in read_ledger(spark, target).join(F.broadcast(spark.createDataFrame([(b,) for b in batches], "batch string")), "batch", "left_semi").select("batch").distinct().collect()}


def _fit(rows: DataFrame, there: StructType | None, widen: bool) -> DataFrame:
    """Rows in the columns of the table, and with `widen` their own behind these."""
    if there is None:
        return rows
    have = {f.name.lower() for f in there}
    return align_by_name(rows, StructType([*there, *[f for f in rows.schema if widen and f.name.lower() not in have]]))


def _counted(spark: SparkSession, files: DataFrame, schema: StructType, data: str) -> DataFrame:
    """Ledger rows with the number of staged rows of each file."""
    with few_list_tasks(spark):
        rows = spark.read.schema(schema).parquet(data)
    counts = rows.groupBy("file_path").agg(F.count(F.lit(1)).alias("n_rows"))
    return files.join(counts, "file_path", "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0))).withColumn("columns", F.lit(schema.json()))


def publish(spark: SparkSession, rows: DataFrame | None, files: DataFrame, target: str, batch: str, widen: bool = False) -> None:
    """Append `rows` and their ledger rows `files` (file_path, archive, member, size, modified) as one batch.

    Columns that the table lacks are an error, or with `widen` they are added. A batch that
    the ledger has is left alone. Without rows only the ledger grows.
    """
    if known_batches(spark, target, [batch]):
        return
    stage = f"{target}/_staging/{batch}"
    delete(spark, stage)
    files = files.select("file_path", "archive", "member", "size", "modified", F.lit(batch).alias("batch"))
    if rows is not None:
        rows = _fit(rows, table_schema(spark, target), widen)
        rows.write.parquet(f"{stage}/data")
        files = _counted(spark, files, rows.schema, f"{stage}/data")
    else:
        files = files.withColumns({"n_rows": F.lit(None).cast("bigint"), "columns": F.lit(None).cast("string")})
    align_by_name(files, StructType.fromDDL(LEDGER)).coalesce(1).write.parquet(f"{stage}/ledger")
    _mark(spark, stage)
    _finish(spark, target, batch)


def _write_staged(rows: DataFrame, path: str) -> None:
    """Parquet by batch; tasks put their files in place themselves, as nobody reads them before the round is marked."""
    rows.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy(BATCH).parquet(path)


def stage_round(spark: SparkSession, rows: DataFrame, files: DataFrame, target: str, there: StructType | None, widen: bool = False, small: bool = False) -> tuple[str, StructType]:
    """Write the rows of several batches and their ledger rows `files` (as for `publish`, with `batch`) by one job each; the folder, for `finish_round`, and the columns of the table with this round.

    `there` are its columns before (see `table_schema`). Rows are dealt to batches by their file_path; one that no file has is an error.
    With `small`, tasks share the batches: a plan over few rows may end in one task, which would write file after file.
    """
    tasks = max(2, spark.sparkContext.defaultParallelism)
    stage = f"{target}/_staging/round-{uuid.uuid4().hex[:16]}"
    rows = _fit(rows, there, widen)
    own = F.broadcast(files.groupBy(F.col("file_path").alias("__path")).agg(F.min("batch").alias(BATCH)))
    stray = F.raise_error(F.concat(F.lit("rows of a file that isn't in the round: "), F.col("file_path"))).cast("string")
    dealt = rows.join(own, F.col("file_path") == F.col("__path"), "left").drop("__path").withColumn(BATCH, F.coalesce(BATCH, stray))
    if small:
        dealt = dealt.repartition(tasks, BATCH)
    _write_staged(dealt, f"{stage}/data")
    if there is None:  # a table has a file, though it may have no rows
        rows.limit(0).write.parquet(f"{stage}/none")
    known = _counted(spark, files.select("file_path", "archive", "member", "size", "modified", "batch"), rows.schema, f"{stage}/data")
    known = align_by_name(known, StructType.fromDDL(LEDGER)).withColumn(BATCH, F.col("batch"))
    _write_staged(known.repartition(tasks, BATCH), f"{stage}/ledger")
    return stage, rows.schema


def finish_round(spark: SparkSession, target: str, stage: str, batches: list[str]) -> None:
    """Mark and move the batches of a staged round, one after the other; what comes ahead of their marks is done for several at once."""
    staged = {folder: set(_children(spark, f"{stage}/{folder}")) for folder in ("data", "ledger")}
    rest, none = set(_children(spark, f"{target}/_staging")), path_exists(spark, f"{stage}/none")

    def part(batch: str) -> None:
        own = f"{target}/_staging/{batch}"
        if batch in rest:
            delete(spark, own)
        fs, mark = _fs(spark, f"{own}/{MARK}")
        fs.mkdirs(mark)
        for folder, names in staged.items():
            if f"{BATCH}={batch}" in names:
                rename(spark, f"{stage}/{folder}/{BATCH}={batch}", f"{own}/{folder}")
        if batch == batches[0] and none and f"{BATCH}={batch}" not in staged["data"]:
            rename(spark, f"{stage}/none", f"{own}/data")

    with ThreadPool(MOVERS) as pool:
        pool.map(part, batches)
    for batch in batches:
        rename(spark, f"{target}/_staging/{batch}/{MARK}", f"{target}/_staging/{batch}/{READY}")
        _finish(spark, target, batch)
    delete(spark, stage)


def replace(spark: SparkSession, target: str) -> None:
    """Put the finished table `target`__new in the place of `target`; readers see the one or the other, but for the moment between two renames."""
    old, new = f"{target}__old", f"{target}__new"
    _mark(spark, new)
    if path_exists(spark, target):
        rename(spark, target, old)
    rename(spark, new, target)
    delete(spark, old)
    delete(spark, f"{target}/{READY}")


