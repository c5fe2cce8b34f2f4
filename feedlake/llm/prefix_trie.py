"""The trie of all prefixes of conversations, by collapsing identical whole sequences.

A turn is its digest and its length; a prefix is the hash of its last turn's digest and of
the prefix before, computed along each conversation in sorted order. Identical
conversations become one weighted sequence with the list of those that end there, and only
one of them gives prefixes. Sequences that are proper prefixes of others are found by an
anti join, the rest are the leaves; nodes are sums over the weighted prefixes. Sums over
subtrees need no walk: a subtree's weighted turns are what its sequences have left from
there on, and each node's own turn counts once, in the sequence of its smallest member.

Hashes are the first 16 bytes of SHA-256: of 10^12 prefixes, two differing ones meet with a
probability of 10^-15.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, bound_batches, whole_text

ROOT = hashlib.sha256(b"").digest()[:16]
EMPTY = hashlib.sha256(b"").hexdigest()
#: Consecutive ids whose ends are joined to one text, and salts of a parent's children.
CHUNK, SALTS = 4096, 64


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, chars): turns numbered from 1 by turn (null first), role and text; null roles and texts are empty.

    Rows without a conv_id belong to no conversation and are left out; repeated rows are turns of their own.
    """
    role, text = whole_text("role"), whole_text("text")
    rows = conversations.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    w = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    said = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    return rows.select("conv_id", F.row_number().over(w).alias("pos"), F.substring(F.unhex(F.sha2(said, 256)), 1, 16).alias("digest"), F.length("text").cast("bigint").alias("chars"))


def rebuilt_turns(turns: DataFrame, base: Column, heads: Column, most: int) -> DataFrame:
    """(conv_id, part, pos, digest, chars): the first `heads` turns of conversation `base`, then the own turns behind as many.

    `base` and `heads` are expressions of conv_id; `most` is the largest that heads can be.
    Part 0 is a row without a turn for each conversation. A base that is absent gives no
    turns. Heads are joined by the base, so a base meets as many rows as it has users.
    """
    convs = turns.filter("pos = 1").select("conv_id", base.alias("base"), heads.alias("h"))
    start = convs.select("conv_id", F.lit(0).alias("part"), F.lit(0).alias("pos"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("bigint").alias("chars"))
    some = turns.filter(F.col("pos") <= most).select(F.col("conv_id").alias("base"), "pos", "digest", "chars")
    lent = convs.filter("h > 0").join(some, "base").filter("pos <= h").select("conv_id", F.lit(1).alias("part"), "pos", "digest", "chars")
    own = turns.filter(F.col("pos") > heads).select("conv_id", F.lit(2).alias("part"), "pos", "digest", "chars")
    return start.unionByName(lent).unionByName(own)


def _runs(keys: np.ndarray) -> np.ndarray:
    """The places where a sorted array of keys changes, with both ends."""
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]]) if len(keys) else np.zeros(1, np.int64)


def chain_prefixes(rows: DataFrame) -> DataFrame:
    """(conv_id, depth, prefix, parent, chars, before): the prefixes of each conversation of `rebuilt_turns`, from the root on.

    before: characters of the turns ahead of the prefix's last. Conversations are read in order,
    so a task holds the hash and the sum of the one it is in, however long it is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, depth, prefix, before = None, 0, ROOT, 0
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for c, part, digest, n in zip(*[b.column(k).to_pylist() for k in ("conv_id", "part", "digest", "chars")], strict=True):
                parent = prefix
                if part == 0:
                    conv, depth, prefix, before, parent = c, 0, ROOT, 0, None
                else:
                    if c != conv:
                        raise AssertionError("a conversation without its first row")
                    depth += 1
                    prefix = hashlib.sha256(parent + digest).digest()[:16]
                for column, v in zip(out, (depth, prefix, parent, n, before), strict=True):
                    column.append(v)
                before += n
            kinds = (pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64())
            arrays = [pa.array(v, k) for v, k in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), *arrays], ["conv_id", "depth", "prefix", "parent", "chars", "before"])

    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "part", "pos")
    return ordered.mapInArrow(run, "conv_id bigint, depth int, prefix binary, parent binary, chars bigint, before bigint")


def end_digests(ends: DataFrame) -> DataFrame:
    """(prefix, ends_sha256) of (prefix, conv_id): SHA-256 of a prefix's decimal ids, ascending and joined by commas.

    Ids are joined by ranges of CHUNK first, so that a large group is a few rows by the time
    it meets in one task, which hashes its ranges in order and holds one batch of them.
    """
    part = F.floor(F.col("conv_id") / F.lit(CHUNK).cast("decimal(20,0)")).cast("bigint")
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    chunks = ends.groupBy("prefix", part.alias("chunk")).agg(ids.alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for b in batches:
            done: list[tuple] = []
            for prefix, ids in zip(b.column("prefix").to_pylist(), b.column("ids").to_pylist(), strict=True):
                if prefix == key:
                    state.update(b"," + ids.encode())
                else:
                    if key is not None:
                        done.append((key, state.hexdigest()))
                    key, state = prefix, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.binary()), pa.array([d for _, d in done], pa.string())], ["prefix", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["prefix", "ends_sha256"])

    return chunks.repartition("prefix").sortWithinPartitions("prefix", "chunk").mapInArrow(run, "prefix binary, ends_sha256 string")


def collapse(prefixes: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The end of each conversation, and (prefix, conv_id, weight, depth, total, leaf): identical conversations as one sequence, a leaf if none goes on from it.

    conv_id is the smallest of them, weight their number, total the characters of a whole one.
    """
    last = prefixes.groupBy("conv_id").agg(F.max_by(F.struct("prefix", "depth", (F.col("before") + F.col("chars")).alias("total")), "depth").alias("e"))
    last = scratch.table(last.select("conv_id", "e.*"), "ends")
    whole = last.groupBy("prefix").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("weight"), F.first("depth").alias("depth"), F.first("total").alias("total"))
    whole = scratch.table(whole, "whole")
    proper = prefixes.filter("parent IS NOT NULL").select(F.col("parent").alias("prefix")).distinct()
    leaves = whole.join(proper, "prefix", "left_anti").select("conv_id", F.lit(True).alias("leaf"))
    sequences = whole.join(leaves, "conv_id", "left").withColumn("leaf", F.coalesce("leaf", F.lit(False)))
    return last, scratch.table(sequences, "sequences")


def prefix_trie(conversations: DataFrame, base: Callable[[Column], Column] | None = None, heads: Callable[[Column], Column] | None = None, most: int = 0) -> DataFrame:
    """One row for each distinct prefix (role, text) of the conversations, the textless root included.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256):
    its smallest member; turns; its parent's smallest member (null for the root); members;
    children; childless nodes of its subtree; characters that storing shared turns once
    saves in its subtree; the digest of the ids that end there.

    `base` and `heads` rebuild conversations first (see `rebuilt_turns`); without them each is taken
    as it is. An empty table gives no rows, as nothing starts with the root.
    """
    spark = conversations.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark, "trie")
    turns = scratch.table(ordered_turns(conversations), "turns")
    c = F.col("conv_id")
    rebuilt = rebuilt_turns(turns, base(c) if base else c, heads(c) if heads else F.lit(0), most)
    prefixes = scratch.table(chain_prefixes(rebuilt), "prefixes")
    last, sequences = collapse(prefixes, scratch)

    kept = prefixes.join(sequences.select("conv_id", "weight", "total", "leaf"), "conv_id")
    left = F.col("total") - F.col("before")
    nodes = kept.groupBy("prefix").agg(
        F.min("conv_id").alias("conv_id"),
        F.first("depth").alias("depth"),
        F.first("parent").alias("parent"),
        F.first("before").alias("before"),
        F.sum("weight").alias("n_convs"),
        F.sum(F.col("leaf").cast("bigint")).alias("n_leaves"),
        F.sum(F.col("weight") * left).alias("weighted"),
    )
    nodes = scratch.table(nodes, "nodes")

    # The nodes of a smallest member are the end of its sequence, from `depth` on.
    owned = nodes.groupBy("conv_id").agg(F.min("depth").alias("depth"), F.min_by("before", "depth").alias("since"), F.min_by("parent", "depth").alias("parent"), F.min_by("prefix", "depth").alias("top"))
    owned = scratch.table(owned, "owned")
    once = kept.join(owned.select("conv_id", "since"), "conv_id").groupBy("prefix").agg(F.sum(F.col("total") - F.greatest("before", "since")).alias("once"))
    children = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("prefix")).agg(F.count(F.lit(1)).alias("n_children"))

    # The first of a member's nodes has another's node for parent, which may have any number of children: they meet by salt.
    ask = owned.filter("parent IS NOT NULL").select("top", F.col("parent").alias("prefix"), F.pmod(F.xxhash64("top"), F.lit(SALTS)).alias("salt"))
    known = ask.select("prefix", "salt").distinct().join(nodes.select("prefix", F.col("conv_id").alias("above")), "prefix")
    above = ask.join(known, ["prefix", "salt"]).select(F.col("top").alias("prefix"), "above")

    out = nodes.join(once, "prefix", "left").join(children, "prefix", "left").join(above, "prefix", "left").join(end_digests(last.select("prefix", "conv_id")), "prefix", "left")
    return out.select(
        "conv_id",
        F.col("depth").cast("bigint").alias("depth"),
        F.when(F.col("parent").isNotNull(), F.coalesce("above", "conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"),
        "n_leaves",
        (F.col("weighted") - F.coalesce("once", F.lit(0))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )
