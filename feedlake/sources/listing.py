"""Discovery: which files of a feed there are, without reading them."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.paths import plain_path

from .store import few_list_tasks

LISTING = "file_path string, source_path string, length bigint, modified timestamp"


class DiscoveryError(RuntimeError):
    """A root could not be listed, which is not the same as no match."""


def discover(spark: SparkSession, root: str, glob: str, missing_ok: bool = True) -> DataFrame:
    """(file_path, source_path, length, modified) of the files below `root` that match; contents aren't read.

    An unmatched pattern gives no rows (with `missing_ok`); every other failure
    raises DiscoveryError, so that a store which can't be listed never looks empty.
    """
    try:
        with few_list_tasks(spark):
            files = spark.read.format("binaryFile").load(f"{root.rstrip('/')}/{glob}")
        return files.select(plain_path(F.col("_metadata.file_path")).alias("file_path"), F.col("path").alias("source_path"), "length", F.col("modificationTime").alias("modified"))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND" and missing_ok:
            return spark.createDataFrame([], LISTING)
        raise DiscoveryError(f"{root}/{glob} can't be listed: {e.getCondition()}") from e


def sources(listing: DataFrame) -> list[str]:
    """The readable paths of a listing: paths only, for a reader's arguments."""
    return [r[0] for r in listing.select("source_path").orderBy("source_path").collect()]


def catalog_tables(spark: SparkSession, databases: list[str]) -> DataFrame:
    """(database, table, kind) of the session's catalogue."""
    rows = [(d, t.name, t.tableType) for d in databases for t in spark.catalog.listTables(d)]
    return spark.createDataFrame(rows, "database string, table string, kind string")
