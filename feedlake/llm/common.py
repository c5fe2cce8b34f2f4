"""Shared helpers: tables that cut lineage, and folders all executors see."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of rows that Spark gathers for a Python worker at once, where the user set nothing.
ARROW_BYTES, _ARROW = "4m", "spark.sql.execution.arrow.maxBytesPerBatch"
#: Spark's setting by which a query's shuffle files go when it ends, not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, as 10,000 rows of long texts fill a task's memory.

    A bound that the application was started with stays. The setting is the session's, as Spark
    reads it when a plan is run; it changes how rows are sent, never a result.
    """
    if spark.sparkContext.getConf().get(_ARROW) is None:
        spark.conf.set(_ARROW, ARROW_BYTES)


def shared_root(spark: SparkSession) -> str:
    """The folder shared by driver and executors, from spark.checkpoint.dir.

    Only where that setting is absent and one machine does all the work (tests, a
    notebook) is a temporary folder made and remembered in the session; on a cluster
    its absence is an error, as executors don't see each other's folders.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.feedlake.scratch", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-feedlake-")
        spark.conf.set("spark.feedlake.scratch", root)
    return root.rstrip("/")


class Scratch:
    """Parquet tables of one run, below the shared folder.

    A written table cuts lineage and survives lost executors, as its files are
    not on an executor's disk. `drop` removes a table that a later one replaced.
    Shuffles of a write go with its end, as nothing reads them again; other
    queries of the session keep what its setting says.
    """

    def __init__(self, spark: SparkSession, name: str):
        bound_batches(spark)
        self.spark = spark
        self.base = f"{shared_root(spark)}/feedlake/{name}-{uuid.uuid4().hex[:12]}"
        self.n = 0

    def table(self, df: DataFrame, name: str = "t") -> DataFrame:
        self.n += 1
        path = f"{self.base}/{self.n:03d}-{name}"
        before = self.spark.conf.get(_CLEANUP, None)
        self.spark.conf.set(_CLEANUP, "true")
        try:
            df.write.mode("overwrite").parquet(path)
        finally:
            self.spark.conf.unset(_CLEANUP) if before is None else self.spark.conf.set(_CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._feedlake_path = path
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        for t in tables:
            if t is not None and getattr(t, "_feedlake_path", None):
                self._delete(t._feedlake_path)

    def clear(self) -> None:
        """Remove all tables of the run."""
        self._delete(self.base)

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def whole_text(col: str | Column = "text") -> Column:
    """A text column where null counts as the empty text."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def connected_components(edges: DataFrame, scratch: Scratch, rounds: int = 60) -> DataFrame:
    """(id, component) of every vertex that has an edge; `edges` is (a, b). The component is its smallest id.

    Large-star and small-star steps in turn, each a grouped minimum joined back to
    the edges, until the edges are stars; the edges of a round are a written table.
    Edges that are no stars after `rounds` rounds (they halve the distances, so that
    takes chains of astronomic length) are an error.
    """

    def step(pairs: DataFrame, larger: bool) -> DataFrame:
        both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(pairs.select(F.col("b").alias("u"), F.col("a").alias("v")))
        if not larger:
            both = both.filter("v < u")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        joined = both.join(least, "u")
        if larger:
            out = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return out.filter("a <> b").distinct()

    def state(t: DataFrame) -> tuple:
        return tuple(t.agg(F.count(F.lit(1)), F.sum(F.shiftright(F.xxhash64("a", "b"), 24))).first())

    now = scratch.table(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    before = state(now)
    while before[0]:
        if rounds == 0:
            raise RuntimeError("components are still changing")
        rounds -= 1
        new = scratch.table(step(step(now, True), False), "edges")
        scratch.drop(now)
        now, after = new, state(new)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
