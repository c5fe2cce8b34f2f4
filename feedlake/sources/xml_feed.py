"""XML documents with a header and repeated records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.functions.paths import plain_path

from .store import few_list_tasks


def read_xml_documents(spark: SparkSession, paths: list[str] | str, row_tag: str, schema: T.StructType | str) -> DataFrame:
    """One row for each document; arrays in the schema say what repeats, however often it does. Adds file_path."""
    with few_list_tasks(spark):
        docs = spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(paths)
    return docs.select("*", plain_path(F.col("_metadata.file_path")).alias("file_path"))


def parse_xml_documents(texts: DataFrame, column: str, schema: T.StructType | str) -> DataFrame:
    """One row for each text that is a whole document, such as the lines of a file; other columns stay."""
    others = [c for c in texts.columns if c != column]
    return texts.select(F.from_xml(F.col(column), schema).alias("_d"), *others).select("_d.*", *others)


def explode_records(docs: DataFrame, records: str, header: str | None = None) -> DataFrame:
    """One row for each record, its fields in lower case, with the document's header fields and file_path."""
    head = [F.col(f"{header}.{f.name}").alias(f.name.lower()) for f in docs.schema[header].dataType] if header else []
    rows = docs.select(F.explode(F.col(records)).alias("_r"), *head, "file_path")
    fields = [F.col(f"_r.{f.name}").alias(f.name.lower()) for f in rows.schema["_r"].dataType]
    return rows.select(*fields, *[h for h in rows.columns if h != "_r"])
