"""Exact deduplication: group by a 128-bit content hash, confirm by bytes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, whole_text
from .url_filter import _level

#: Repeated hashes up to which a Bloom filter of them is sent to the tasks, and its rate of false positives.
BLOOM_KEYS, BLOOM_RATE = 250_000, 0.01


def content_hash(text: Column) -> Column:
    """128-bit hash of a text's bytes."""
    return F.unhex(F.md5(text))


def may_repeat(rows: DataFrame, scratch: Scratch) -> Callable[[Column], Column]:
    """Whether a hash may occur more than once in `rows` (h): certain where it says no.

    Only hashes are counted, so no text is shuffled. A Bloom filter of the repeated
    ones is sent to the tasks where they are at most BLOOM_KEYS; more of them, and any may repeat.
    """
    again = rows.groupBy("h").count().filter("count > 1").select(F.hex("h").alias("key"))
    again = scratch.table(again, "repeated")
    n = again.count()
    if n == 0 or n > BLOOM_KEYS:
        return lambda h: F.lit(n > 0)
    level = _level(again, n, BLOOM_RATE, 1)
    return lambda h: level.holds(F.hex(h))


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    hash_fn: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row per input row: (id_col, keep_id, group_size, kept, text_sha256, content_hash).

    Rows are grouped by hash first, hashes alone. A row whose hash is certain to occur once
    is answered where it is read. The others are grouped by (hash, bytes): the hash
    deals the rows out, the bytes are compared by the grouping itself, so texts that
    collide stay apart. Copies meet in the partial aggregate, so a group that holds a
    third of the table reaches the shuffle as one row for each map task.

    Members find their group by hash alone, without shuffling texts again. Only
    hashes which carry two or more different texts (collisions) are joined on
    the bytes too.

    Defined cases: a null text counts as the empty text; `keep` says whether the
    smallest or the largest id stays, null ids are kept only where a group has
    no other; of rows that repeat both id and text of the keeper exactly one is
    kept; an empty table gives an empty result; other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "exact_dedup")
    return _exact_dedup(docs, id_col, text_col, keep, hash_fn, scratch)[0]


def _exact_dedup(docs: DataFrame, id_col: str, text_col: str, keep: str, hash_fn: Callable[[Column], Column], scratch: Scratch) -> tuple[DataFrame, Callable[[Column], Column]]:
    if keep not in ("smallest", "largest"):
        raise ValueError("keep must be 'smallest' or 'largest'")
    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("t")).withColumn("h", hash_fn(F.col("t")))
    repeats = may_repeat(rows.select("h"), scratch)
    alone = rows.filter(~repeats(F.col("h"))).select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), F.sha2("t", 256).alias("text_sha256"), "h"
    )
    rows = rows.filter(repeats(F.col("h")))
    pick = F.min("id") if keep == "smallest" else F.max("id")
    groups = rows.groupBy("h", "t").agg(pick.alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = scratch.table(groups.select("h", "keep_id", "group_size", F.sha2("t", 256).alias("text_sha256")), "groups")
    clashes = groups.groupBy("h").count().filter("count > 1").select("h")

    def members(part: DataFrame, key: list[str]) -> DataFrame:
        return part.groupBy("id", *key).agg(F.count(F.lit(1)).alias("n"))

    if clashes.limit(1).count() == 0:
        placed = members(rows, ["h"]).join(groups, "h")
    else:
        clear = members(rows.join(clashes, "h", "left_anti"), ["h"]).join(groups, "h")
        clash = rows.join(clashes, "h", "left_semi")
        split = clash.groupBy("h", "t").agg(pick.alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        split = split.withColumn("text_sha256", F.sha2("t", 256))
        placed = clear.unionByName(members(clash, ["h", "t"]).join(split, ["h", "t"]).drop("t"))
    copies = F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy")
    placed = placed.select("*", copies).withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1))
    found = alone.unionByName(placed.select(*alone.columns)).withColumnRenamed("id", id_col).withColumnRenamed("h", "content_hash")
    return found, repeats


def keep_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows of `docs`, all columns, that exact_dedup keeps: one for each text.

    Rows whose hash is certain to occur once pass as they are read; the others are
    held against the ids to drop, which are written first, so that Spark knows
    their size when it chooses how to join them.
    """
    scratch = Scratch(docs.sparkSession, "keep_exact")
    found, repeats = _exact_dedup(docs, id_col, text_col, keep, content_hash, scratch)
    found = found.filter("NOT kept").select(F.col(id_col).alias("_id"), F.col("content_hash").alias("_h"), "keep_id")
    dropped = Scratch(docs.sparkSession, "keep_exact").table(found, "dropped")
    scratch.clear()
    keeper = F.col("_id").eqNullSafe(F.col("keep_id"))
    gone = dropped.filter(~keeper)
    again = repeats(content_hash(whole_text(text_col)))
    rows = docs.filter(again)
    rows = rows.join(gone, rows[id_col].eqNullSafe(gone["_id"]) & (content_hash(whole_text(text_col)) == gone["_h"]), "left_anti")
    rows = rows.dropDuplicates([id_col, text_col]) if dropped.filter(keeper).limit(1).count() else rows
    return docs.filter(~again).unionByName(rows)
