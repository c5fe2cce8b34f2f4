"""Incremental ingest as a stream of files of any kind of feed."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.paths import plain_path
from feedlake.operators import ledger as L
from feedlake.operators.ingest import ROUND_FILES, feed_files, load_files
from feedlake.operators.lineage import split_stamped
from feedlake.plans.defs import Feed
from feedlake.sinks import path_exists
from feedlake.sources.store import few_list_tasks


#: A trigger's note: a line for each of its files, times in microseconds.
NOTE = "file_path string, source_path string, length bigint, micros bigint"


def stream_files(spark: SparkSession, root: str, glob: str, max_files_per_trigger: int = 25) -> DataFrame:
    """A stream of the listing (see `discover`) of new files below root, contents unread; a glob without folders fits at any depth."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").option("maxFilesPerTrigger", max_files_per_trigger)
    if "/" in glob:
        files = files.load(f"{root.rstrip('/')}/{glob}")
    else:
        files = files.option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(root)
    return files.select(plain_path(F.col("_metadata.file_path")).alias("file_path"), F.col("path").alias("source_path"), "length", F.col("modificationTime").alias("modified"))


def loaded_rows(spark: SparkSession, target: str) -> int:
    return L.read_ledger(spark, target).agg(F.sum("n_rows")).first()[0] or 0


def load_listing(spark: SparkSession, feed: Feed, listing: DataFrame, target: str, org: str = "") -> int:
    """Load what a listing has and the table lacks; workbooks without stamps become rows of `target`__unstamped. Files read."""
    L.recover(spark, target)
    if feed.kind == "sheet":
        _, odd = split_stamped(listing)
        side = f"{target}__unstamped"
        L.recover(spark, side)
        odd = odd.select("file_path", F.col("length").alias("size"), "modified").join(L.read_ledger(spark, side).select("file_path"), "file_path", "left_anti")
        names = [r[0] for r in odd.select("file_path").collect()]
        if names:
            files = odd.withColumns({"archive": F.lit(None).cast("string"), "member": F.lit(None).cast("string")})
            L.publish(spark, odd, files, side, L.batch_name(names))
    new, opened = feed_files(spark, feed, listing, L.read_ledger(spark, target))
    return load_files(spark, feed, new, opened, target, org=org)


def load_pending(spark: SparkSession, feed: Feed, target: str, pending: str, org: str = "") -> None:
    """Load the files that triggers have noted below `pending`, then forget the notes; files that were loaded before a run died are in the ledger."""
    if path_exists(spark, pending):
        with few_list_tasks(spark):
            notes = spark.read.schema(NOTE).option("mode", "FAILFAST").json(pending)
        last = notes.withColumn("modified", F.timestamp_micros("micros")).groupBy("file_path").agg(F.max(F.struct("modified", "source_path", "length")).alias("f"))
        load_listing(spark, feed, last.select("file_path", "f.source_path", "f.length", "f.modified"), target, org)
        L.delete(spark, pending)


def stream_ingest(spark: SparkSession, feed: Feed, root: str, target: str, checkpoint: str, max_files_per_trigger: int = 25, org: str = "") -> int:
    """Append the rows of files that neither an earlier run with this checkpoint nor the table's ledger has. Rows appended.

    Runs until what is there is read, then ends. A trigger notes its files below the checkpoint;
    files of small triggers are loaded together, at ROUND_FILES and at the end. The checkpoint and the notes
    say which files there are, the ledger which of them are loaded: where a run died, the next one
    goes on with its notes, and its files are in the table once. Archives and workbooks come whole
    or not at all; a table can be loaded by streams and by `ingest` in turn.
    """
    before, pending, waiting = loaded_rows(spark, target), f"{checkpoint.rstrip('/')}/pending", 0

    def note(listing: DataFrame, trigger: int) -> None:
        nonlocal waiting
        # a trigger's few names as one small file: a job that writes them takes longer than all else of a trigger
        names = listing.select("file_path", "source_path", "length", F.unix_micros("modified").alias("micros")).collect()
        L.put_text(spark, f"{pending}/{trigger}.json", "".join(json.dumps(r.asDict()) + "\n" for r in names))
        waiting += max_files_per_trigger
        if waiting >= ROUND_FILES:
            load_pending(listing.sparkSession, feed, target, pending, org)
            waiting = 0

    with few_list_tasks(spark):  # the stream's session is a copy of this one as it starts
        query = stream_files(spark, root, feed.glob, max_files_per_trigger).writeStream.foreachBatch(note).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    load_pending(spark, feed, target, pending, org)
    return loaded_rows(spark, target) - before
