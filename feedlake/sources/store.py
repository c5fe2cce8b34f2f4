"""Files that tasks open themselves and read by ranges, where a whole file would be too large for a row."""

from __future__ import annotations

import io
import os
from collections.abc import Iterator
from contextlib import contextmanager
from typing import BinaryIO

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.paths import plain_path

_MOUNT = "fs.viewfs.mounttable."
#: Tasks that list many paths at once, and the setting that bounds them; Spark's default has a task for each path.
LIST_TASKS, _LIST_SETTING = 64, "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def mount(spark: SparkSession, name: str, links: dict[str, str]) -> str:
    """A mount table of Hadoop's view file system: folders of other stores under one name; its root as a source prefix."""
    conf = spark._jsc.hadoopConfiguration()
    for folder, target in links.items():
        conf.set(f"{_MOUNT}{name}.link.{folder}", target)
    return f"viewfs://{name}"


def mounted(spark: SparkSession) -> list[tuple[str, str]]:
    """(prefix, where it leads) of every mounted folder, the longest first."""
    found = []
    for name, target in dict(spark._jsc.hadoopConfiguration().getPropsWithPrefix(_MOUNT)).items():
        table, _, folder = name.partition(".link.")
        if folder:
            found.append((f"viewfs://{table}{folder.rstrip('/')}/", target.rstrip("/") + "/"))
    return sorted(found, key=lambda m: -len(m[0]))


def openable(spark: SparkSession, source: Column) -> Column:
    """A locator that tasks can open: mounted folders are followed, anything else stays."""
    out = source
    for prefix, target in reversed(mounted(spark)):
        out = F.when(source.startswith(prefix), F.concat(F.lit(target), F.substring(source, len(prefix) + 1, 1 << 30))).otherwise(out)
    return out


def _remote(scheme: str, rest: str) -> tuple:
    from pyarrow import fs

    host, _, path = rest.removeprefix("//").partition("/")
    store, base = fs.FileSystem.from_uri(f"{ {'s3a': 's3', 's3n': 's3'}.get(scheme, scheme) }://{host}/")
    return store, f"{base.rstrip('/')}/{path}"


def open_file(locator: str) -> BinaryIO:
    """A seekable file; remote stores are opened by Arrow, which reads the ranges that are asked for."""
    scheme, colon, rest = locator.partition(":")
    if not colon or scheme == "file" or "/" in scheme:
        return open("/" + rest.lstrip("/") if scheme == "file" else locator, "rb")
    store, path = _remote(scheme, rest)
    return io.BufferedReader(store.open_input_file(path), 1 << 20)


def write_file(locator: str, content: bytes) -> None:
    """A file with this content, in place of any there."""
    scheme, colon, rest = locator.partition(":")
    if not colon or scheme == "file" or "/" in scheme:
        path = "/" + rest.lstrip("/") if scheme == "file" else locator
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(content)
        return
    store, path = _remote(scheme, rest)
    with store.open_output_stream(path) as f:
        f.write(content)


@contextmanager
def few_list_tasks(spark: SparkSession) -> Iterator[None]:
    """Reads made inside list their paths by at most LIST_TASKS tasks; the paths are the same, a task takes several of them."""
    before = spark.conf.get(_LIST_SETTING)
    spark.conf.set(_LIST_SETTING, str(min(int(before), LIST_TASKS)))
    try:
        yield
    finally:
        spark.conf.set(_LIST_SETTING, before)


def list_files(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """(path, source, size, modified) of files; source is what `open_file` takes, contents aren't read."""
    with few_list_tasks(spark):
        files = spark.read.format("binaryFile").load(paths)
    return files.select(plain_path(F.col("_metadata.file_path")).alias("path"), openable(spark, F.col("path")).alias("source"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
