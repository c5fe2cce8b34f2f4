"""Exact token counts from a histogram of encoded lengths."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch
from .encode import encoder, split_batches

#: Lengths summed together before the running totals over blocks.
BLOCK = 1024


def token_lengths(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens) of every whole text; null counts as the empty text with no tokens."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for b in split_batches(batches, "t"):
            _, cuts = enc.batch(b.column("t"))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(np.diff(cuts), pa.int64())], ["id", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    return rows.mapInArrow(run, f"id {kind}, n_tokens bigint").withColumnRenamed("id", id_col)


def length_histogram(lengths: DataFrame) -> DataFrame:
    """(n_tokens, n_docs): documents of each encoded length; counted in each task before the shuffle."""
    return lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """For each length that occurs, what a context limit of that length would hold.

    (n_tokens, n_docs, docs_at_least, tokens_at_least, docs_at_most, quantile,
    truncated_total, total_tokens): documents this long; documents and tokens of
    those at least this long; documents at most this long, also as a share of all;
    tokens left where every document is cut to this length; tokens of all.

    Sums run within blocks of BLOCK lengths and over the blocks' totals, so no
    task reads more than one block or one row for each block. The histogram is
    written first, as both read it and texts are to be encoded once. An empty
    histogram gives no rows.
    """
    histogram = Scratch(histogram.sparkSession, "lengths").table(histogram, "histogram")
    h = histogram.withColumn("block", F.floor(F.col("n_tokens") / BLOCK)).withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("bd"), F.sum("tokens").alias("bt"))
    after = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("bd").over(after), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("bt").over(after), F.lit(0)).alias("later_tokens"),
        F.sum("bd").over(everything).alias("all_docs"),
        F.sum("bt").over(everything).alias("total_tokens"),
    )
    inner = Window.partitionBy("block").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, 0)
    sums = h.join(blocks, "block").select(
        "n_tokens",
        "n_docs",
        (F.sum("n_docs").over(inner) + F.col("later_docs")).alias("docs_at_least"),
        (F.sum("tokens").over(inner) + F.col("later_tokens")).alias("tokens_at_least"),
        "all_docs",
        "total_tokens",
    )
    at_most = F.col("all_docs") - F.col("docs_at_least") + F.col("n_docs")
    return sums.select(
        "n_tokens",
        "n_docs",
        "docs_at_least",
        "tokens_at_least",
        at_most.alias("docs_at_most"),
        (at_most / F.col("all_docs")).alias("quantile"),
        (F.col("total_tokens") - F.col("tokens_at_least") + F.col("docs_at_least") * F.col("n_tokens")).alias("truncated_total"),
        "total_tokens",
    )


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, truncated_total, docs_cut) for any limits, from the suffix sums.

    The shortest length at or above a limit tells how many documents reach it and
    how many tokens lie in shorter ones; above the longest, nothing is cut.
    """
    aggs = []
    for c in limits:
        at = F.col("n_tokens") >= c
        aggs.append(
            F.struct(
                F.lit(c).cast("bigint").alias("context_limit"),
                F.min(F.when(at, F.struct("n_tokens", "docs_at_least", "tokens_at_least"))).alias("reach"),
                F.min(F.when(F.col("n_tokens") > c, F.struct("n_tokens", "docs_at_least"))).alias("over"),
                F.max("total_tokens").alias("total"),
            )
        )
    rows = sums.agg(F.array(*aggs).alias("rows")).select(F.explode("rows").alias("r")).select("r.*")
    kept = F.col("total") - F.col("reach.tokens_at_least") + F.col("reach.docs_at_least") * F.col("context_limit")
    return rows.select("context_limit", F.coalesce(kept, F.col("total"), F.lit(0)).alias("truncated_total"), F.coalesce(F.col("over.docs_at_least"), F.lit(0)).alias("docs_cut"))


def length_quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """(share, n_tokens): the shortest length that at least this share of the documents doesn't exceed."""
    rows = F.array(*[F.struct(F.lit(float(q)).alias("share"), F.min(F.when(F.col("quantile") >= q, F.col("n_tokens"))).alias("n_tokens")) for q in shares])
    return sums.agg(rows.alias("rows")).select(F.explode("rows").alias("r")).select("r.*")
