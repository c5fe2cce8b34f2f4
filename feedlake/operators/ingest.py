"""Loading only what isn't loaded yet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feedlake.plans.defs import Feed
from feedlake.sources import workbook
from feedlake.sources.listing import discover
from feedlake.sources.store import openable
from feedlake.workspace import workspace

from . import ledger as L
from .lineage import split_stamped, with_lineage
from .readers import as_cell_grain, chosen_members, read_feed
from .sheets import SheetError, sheet_problems, tidy_family

Reader = Callable[[SparkSession, list[str]], DataFrame]
#: What `tidy_family` gives, as it is dealt to tables.
TIDY = "file_path string, sheet string, row_num bigint, group_label string, section_code string, section_label string, row_label string, column_group_label string, column_label string, value_text string, table string"
ARCHIVES = ("zip_csv", "quality")
FILES = "file_path string, archive string, member string, path string, source string, reader_path string, size bigint, modified timestamp, packed bigint"
#: Small batches are read and staged together, up to so many files or bytes as they are stored; a batch beyond that goes alone.
ROUND_FILES, ROUND_BYTES = 2000, 1 << 30
#: Bytes as stored up to which a round is small: a batch of it may be written by one task.
SMALL_BYTES = 64 << 20


def loaded_paths(target: DataFrame) -> DataFrame:
    """The distinct file_path of a loaded table: one column is read, and counted in each task first."""
    return target.select("file_path").distinct()


def missing_files(listing: DataFrame, loaded: DataFrame | None) -> DataFrame:
    """Listed files, path and readable locator, that a loaded table or a ledger has no rows of."""
    return listing if loaded is None else listing.join(loaded_paths(loaded), "file_path", "left_anti")


def feed_files(spark: SparkSession, feed: Feed, listing: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(files to load, archives that were opened) of a listing, in FILES.

    Files and members that the ledger has are left out, also those without rows; an archive
    is opened if it is new or its size or time has changed, and only its directory is read.
    Workbooks whose names have no stamps are left out.
    """
    files = listing.select("file_path", F.col("file_path").alias("path"), openable(spark, F.col("source_path")).alias("source"), F.col("source_path").alias("reader_path"), F.col("length").alias("size"), "modified")
    if feed.kind == "sheet":
        files, _ = split_stamped(files)
    nothing = spark.createDataFrame([], FILES)
    if feed.kind not in ARCHIVES:
        return nothing.unionByName(missing_files(files, known), allowMissingColumns=True), nothing
    seen = known.filter("member IS NULL AND archive IS NOT NULL").select(F.col("archive").alias("path"), "size", "modified")
    opened = files.join(seen, ["path", "size", "modified"], "left_anti")
    members = chosen_members(opened, feed).join(opened.drop("file_path"), F.col("archive") == F.col("path"))
    none = nothing.withColumn("archive", F.col("path"))
    return nothing.unionByName(missing_files(members, known), allowMissingColumns=True), none.unionByName(opened.withColumn("archive", F.col("path")), allowMissingColumns=True)


def load_batch(spark: SparkSession, feed: Feed, files: list, target: str, reader: Reader | None = None, org: str = "") -> None:
    """Read the files (rows of FILES) and append them with their ledger rows, as one batch that is loaded once or not at all."""
    part = spark.createDataFrame(files, FILES)
    if reader is None:
        rows = read_feed(spark, feed, part, org)
    else:
        rows = with_lineage(reader(spark, sorted(r["reader_path"] for r in files)))
    L.publish(spark, rows, part, target, _name(files), widen=feed.kind in ("csv", *ARCHIVES))


def _weight(batch: list) -> int:
    return sum(r["packed"] or r["size"] or 0 for r in batch)


def _small(batches: list[list]) -> bool:
    return sum(map(_weight, batches)) <= SMALL_BYTES


def rounds(files: list, size: int) -> list[list[list]]:
    """Batches of `size` files (rows of FILES), grouped by what is read and staged together."""
    out, n, held = [], 0, 0
    for k in range(0, len(files), size):
        batch = files[k : k + size]
        weight = _weight(batch)
        if not out or n + len(batch) > ROUND_FILES or held + weight > ROUND_BYTES:
            out.append([])
            n, held = 0, 0
        out[-1].append(batch)
        n, held = n + len(batch), held + weight
    return out


def _name(batch: list) -> str:
    return L.batch_name([r["file_path"] for r in batch])


def _round_files(spark: SparkSession, batches: dict[str, list]) -> DataFrame:
    return spark.createDataFrame([(*r, name) for name, files in batches.items() for r in files], f"{FILES}, batch string")


def load_round(spark: SparkSession, feed: Feed, batches: list[list], target: str, there: StructType | None, org: str = "") -> StructType | None:
    """Load batches that are read and staged together, each of them once or not at all; the columns of the table, which were `there` before.

    The ledger must have none of them. Where they can't be read or staged, halves of them are loaded, so that batches ahead of the bad file are.
    """
    if len(batches) == 1:
        load_batch(spark, feed, batches[0], target, org=org)
        return L.table_schema(spark, target)
    named = {_name(b): b for b in batches}
    part = _round_files(spark, named)
    try:
        stage, columns = L.stage_round(spark, read_feed(spark, feed, part, org), part, target, there, feed.kind in ("csv", *ARCHIVES), _small(batches))
    except Exception:
        half = len(batches) // 2
        there = load_round(spark, feed, batches[:half], target, there, org)
        return load_round(spark, feed, batches[half:], target, there, org)
    L.finish_round(spark, target, stage, list(named))
    return columns


def load_files(spark: SparkSession, feed: Feed, new: DataFrame, opened: DataFrame, target: str, reader: Reader | None = None, org: str = "") -> int:
    """Load what `feed_files` has found, in batches of `feed.batch` files or members; names come to the driver, no more."""
    files, archives = sorted(new.collect(), key=lambda r: r["file_path"]), sorted(opened.collect(), key=lambda r: r["path"])
    todo = rounds(files, feed.batch or max(len(files), 1))
    if todo and reader is None:
        # the ledger is asked once, not by every round: it has a file for each batch
        known, there = L.known_batches(spark, target, [_name(b) for batches in todo for b in batches]), L.table_schema(spark, target)
        for batches in todo:
            if fresh := [b for b in batches if _name(b) not in known]:
                there = load_round(spark, feed, fresh, target, there, org)
    else:
        for batch in (b for batches in todo for b in batches):
            load_batch(spark, feed, batch, target, reader, org)
    if archives:
        names = [f"{r['path']} {r['size']} {r['modified']}" for r in archives]
        L.publish(spark, None, spark.createDataFrame(archives, FILES), target, L.batch_name(names))
    return len(files)


def ingest(spark: SparkSession, feed: Feed, root: str, target: str, refresh: bool = False, reader: Reader | None = None, org: str = "") -> int:
    """Read the feed's files that `target` lacks (all with `refresh`), add lineage, append; the number of files read.

    Files, or members of archives, are known by the ledger of `target`; the missing ones are
    appended at once, or `feed.batch` at a time: a batch that was written stays, and the next run
    goes on behind it. Small batches are read and staged together (see `rounds`). A full refresh loads beside the table and takes its place at last, so a
    refresh that fails changes nothing, nor does one that finds no files. `reader` replaces the
    kind's own, and gets one batch at a time.
    """
    L.recover(spark, target)
    into = f"{target}__new" if refresh else target
    new, opened = feed_files(spark, feed, discover(spark, root, feed.glob), L.read_ledger(spark, into))
    n = load_files(spark, feed, new, opened, into, reader, org)
    if refresh and n:
        L.replace(spark, target)
    return n


def ingest_sheets(spark: SparkSession, feeds: list[Feed], root: str, targets: dict[str, str], org: str = "") -> dict[str, int]:
    """Load the tables of a family of workbooks (feeds of one glob), each workbook decoded once for all of them; files read by table.

    Cells of some batches of workbooks are written once, tidied in one plan and dealt to the tables, which
    are loaded as by `ingest`. A table whose sheet can't be read is left as it is, the others are
    loaded, and an error tells of all such tables at last.
    """
    if len({f.glob for f in feeds}) != 1 or any(f.kind != "sheet" for f in feeds):
        raise ValueError("feeds must be sheets of the same workbooks")
    listing, wanted = discover(spark, root, feeds[0].glob), {}
    for f in feeds:
        L.recover(spark, targets[f.name])
        new, _ = feed_files(spark, f, listing, L.read_ledger(spark, targets[f.name]))
        wanted[f.name] = {r["file_path"]: r for r in new.collect()}
    every = [r for _, r in sorted({p: r for rows in wanted.values() for p, r in rows.items()}.items())]
    counts, wrong = dict.fromkeys(targets, 0), {}
    for batches in rounds(every, feeds[0].batch or max(len(every), 1)):
        _load_sheets(spark, feeds, batches, wanted, targets, org, counts, wrong)
    if wrong:
        raise SheetError("; ".join(f"{t}: {p}" for t, p in sorted(wrong.items())))
    return counts


def _load_sheets(spark: SparkSession, feeds: list[Feed], batches: list[list], wanted: dict[str, dict], targets: dict[str, str], org: str, counts: dict[str, int], wrong: dict[str, str]) -> None:
    """Load batches of workbooks into the tables that want them; adds to counts, and to wrong the tables whose sheet can't be read.

    Such a table gets the batches ahead of the first bad one. Where workbooks can't be decoded or
    tidied at all, halves of the batches are loaded, so that those ahead of the bad one are.
    """
    named = {_name(b): b for b in batches}
    files, sheets, order = _round_files(spark, named), [f.sheet for f in feeds], list(named)
    folder = workspace(spark, "cells")
    try:
        workbook.read_cells(files.select("path", "source")).write.parquet(f"{folder}/cells")
        cells = spark.read.parquet(f"{folder}/cells")
        number = F.broadcast(spark.createDataFrame([(r["file_path"], k) for k, b in enumerate(batches) for r in b], "file_path string, n int"))
        found = sheet_problems(cells, sheets).join(number, "file_path").groupBy("table").agg(F.min(F.struct("n", "problem")).alias("first"))
        bad = {r["table"]: r["first"] for r in found.collect()}
        tidy_family(cells, sheets).write.partitionBy("table").parquet(f"{folder}/tidy")
    except Exception:
        L.delete(spark, folder)
        if len(batches) == 1:
            raise
        for half in (batches[: len(batches) // 2], batches[len(batches) // 2 :]):
            _load_sheets(spark, feeds, half, wanted, targets, org, counts, wrong)
        return
    tidy = spark.read.schema(TIDY).parquet(f"{folder}/tidy")
    for f in feeds:
        if f.sheet.table in wrong:
            continue
        until = bad[f.sheet.table]["n"] if f.sheet.table in bad else len(order)
        own = {n: part for n in order[:until] if (part := [r for r in named[n] if r["file_path"] in wanted[f.name]])}
        known = L.known_batches(spark, targets[f.name], list(own)) if own else set()
        fresh = {n: part for n, part in own.items() if n not in known}
        if fresh:
            files = _round_files(spark, fresh)
            rows = tidy.filter(F.col("table") == f.sheet.table).drop("table").join(F.broadcast(files.select("file_path")), "file_path", "left_semi")
            stage, _ = L.stage_round(spark, as_cell_grain(rows, f, org), files, targets[f.name], L.table_schema(spark, targets[f.name]), small=_small(list(fresh.values())))
            L.finish_round(spark, targets[f.name], stage, list(fresh))
        counts[f.name] += sum(map(len, own.values()))
    wrong.update({t: r["problem"] for t, r in bad.items() if t not in wrong})
    L.delete(spark, folder)
