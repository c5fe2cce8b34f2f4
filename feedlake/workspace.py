"""A working folder that driver and executors share, for rendered feeds and targets."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir; where that is unset, and one machine does all the work, below a temporary one kept in the session."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.feedlake.workspace", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-feedlake-")
        spark.conf.set("spark.feedlake.workspace", root)
    return f"{root.rstrip('/')}/feeds/{name}-{uuid.uuid4().hex[:12]}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
