"""Packing documents into fixed windows: repeat counts of length combinations by least squares."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch
from .encode import encoder, split_batches

#: Above any rank of a document among those of one length.
_RANKS = 1 << 40


def combinations(window: int, step: int = 37) -> list[tuple[int, ...]]:
    """Shallow combinations of lengths that fill a window: all pairs, and triples whose middle length goes in steps."""
    pairs = [(a, window - a) for a in range(1, window // 2 + 1)]
    triples = [(a, b, window - a - b) for a in range(1, window // 3 + 1) for b in range(a, (window - a) // 2 + 1, step)]
    return pairs + triples


def solve_counts(histogram: np.ndarray, combos: list[tuple[int, ...]], rounds: int = 400) -> np.ndarray:
    """Non-negative counts x that bring A x near the histogram (A has how often a combination uses a length).

    Accelerated projected gradient; its size is set by the window, not by the corpus.
    """
    a = np.zeros((len(histogram), len(combos)), np.float32)
    for c, parts in enumerate(combos):
        for n in parts:
            a[n, c] += 1
    scale = max(float(histogram.max(initial=0)), 1.0)
    h = (histogram / scale).astype(np.float32)
    v = np.ones(a.shape[1], np.float32)
    for _ in range(20):
        v = a.T @ (a @ v)
        size = float(np.linalg.norm(v))
        v /= size
    x = y = np.zeros(a.shape[1], np.float32)
    t = 1.0
    for _ in range(rounds):
        nxt = np.maximum(0, y - (a.T @ (a @ y - h)) / size)
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = nxt + ((t - 1) / t_next) * (nxt - x)
        x, t = nxt, t_next
    return x.astype(np.float64) * scale


@dataclass(frozen=True)
class Plan:
    """Where a rest of length l and rank r goes: intervals of ranks, and what is left for the stream.

    keys (l * _RANKS + first rank of an interval, ascending), sequence and offset of
    each interval; used[l] ranks have intervals; the others follow each other in one
    stream, those of length l from stream[l], in windows from `stream_sequence` on.
    """

    window: int
    keys: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    used: np.ndarray
    stream: np.ndarray
    stream_sequence: int
    full_sequence: int


def plan_windows(histogram: np.ndarray, window: int) -> Plan:
    """Solve, round down, fill exactly with leftover pairs, and lay the rest in a stream, longest first."""
    combos = combinations(window)
    solved = solve_counts(histogram, combos)
    left = histogram.astype(np.int64).copy()
    used = np.zeros(window, np.int64)
    rows: list[tuple[int, int, int, int]] = []
    sequence = 0

    def take(parts: tuple[int, ...], count: int) -> None:
        nonlocal sequence
        offset = 0
        for n in parts:
            rows.append((n, int(used[n]), sequence, offset))
            used[n] += count
            left[n] -= count
            offset += n
        sequence += count

    def most(parts: tuple[int, ...]) -> int:
        return min(int(left[n]) // parts.count(n) for n in parts)

    for c in np.argsort(-solved, kind="stable"):
        if (count := min(int(solved[c]), most(combos[c]))) > 0:
            take(combos[c], count)
    for parts in combos:
        if (count := most(parts)) > 0:
            take(parts, count)
    stream = np.zeros(window, np.int64)
    at = 0
    for n in range(window - 1, 0, -1):
        stream[n] = at
        at += int(left[n]) * n
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return Plan(window, table[:, 0] * _RANKS + table[:, 1], table[:, 2], table[:, 3], used, stream, sequence, sequence + -(-at // window))


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _encoded(docs: DataFrame, tokenizer: str, window: int, id_col: str, text_col: str) -> DataFrame:
    """A row for each document: its length, checksums of its whole windows, and the rest behind them.

    `part` and the counters in it are made once and written: rank among the rests
    of one length in this part, whole windows before this document in this part.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, part int, doc_tokens bigint, rest int, rank bigint, whole_before bigint, whole_crc array<bigint>, rest_crc bigint, rest_ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        seen, whole = np.zeros(window, np.int64), 0
        for b in split_batches(batches, "t"):
            ids, cuts = enc.batch(b.column("t"))
            n = np.diff(cuts) + 1
            rest, ranks, before = n % window, np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
            crcs, rest_crc, tails = [], np.zeros(len(n), np.int64), []
            for k in range(len(n)):
                own = np.append(ids[cuts[k] : cuts[k + 1]], np.uint16(0))
                full = len(own) // window
                crcs.append([_crc(own[j * window : (j + 1) * window]) for j in range(full)])
                tail = own[full * window :]
                tails.append(tail.tobytes())
                rest_crc[k] = _crc(tail)
                ranks[k] = seen[len(tail)]
                seen[len(tail)] += 1
                before[k] = whole
                whole += full
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(np.full(len(n), part, np.int32)), pa.array(n), pa.array(rest.astype(np.int32)), pa.array(ranks), pa.array(before), pa.array(crcs, pa.list_(pa.int64())), pa.array(rest_crc), pa.array(tails, pa.binary())],
                ["id", "part", "doc_tokens", "rest", "rank", "whole_before", "whole_crc", "rest_crc", "rest_ids"],
            )

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: str, window: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack every document into windows; a row for each piece:
    (id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    A document is its token ids and a closing 0. Whole windows of a document are
    sequences of their own. The rests, shorter than a window, are counted by length;
    least squares says how often each combination of two or three lengths that fills
    a window is used; rounded down and bounded by what exists, that gives each rest
    of length l and rank r its place in closed form. Leftovers fill exact pairs as far
    as they go, and what remains is laid end to end, longest first, and cut at window
    ends, so only the last sequence is not full. At most (window - 1) counts reach the
    driver. Ranks are made of positions in a part and sums over parts, so that one
    length held by a third of all documents isn't sorted in one task.

    Defined cases: null and empty texts are the closing 0 alone; rows that repeat
    are packed each; an empty table gives no rows; other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "pack")
    rows = scratch.table(_encoded(docs, tokenizer, window, id_col, text_col), "encoded")
    counts = rows.groupBy("part", "rest").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("whole_crc")).alias("whole"))
    counts = scratch.table(counts, "counts")
    histogram = np.zeros(window, np.int64)
    for r in counts.groupBy("rest").agg(F.sum("n").alias("n")).collect():
        histogram[r["rest"]] = r["n"]
    histogram[0] = 0
    plan = plan_windows(histogram, window)

    parts = counts.groupBy("part").agg(F.sum("whole").alias("n")).select(F.lit(-1).alias("rest"), "part", "n")
    before = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = counts.select("rest", "part", "n").unionByName(parts).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    whole = sums.filter("rest = -1").select("part", F.col("before").alias("whole_base"))
    bases = sums.filter("rest >= 0").select("part", "rest", F.col("before").alias("rank_base")).join(whole, "part")
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    names = [f.split()[0] for f in schema.split(", ")]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows == 0:
                continue
            get = lambda c: b.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
            n, rest, rank = get("doc_tokens"), get("rest"), get("rank") + get("rank_base")
            full = n // plan.window
            row = np.repeat(np.arange(len(n)), full)
            j = np.arange(len(row)) - np.repeat(np.cumsum(full) - full, full)
            crc = b.column("whole_crc").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            out = [(row, j * plan.window, np.full(len(row), plan.window), crc, plan.full_sequence + (get("whole_base") + get("whole_before"))[row] + j, np.zeros(len(row), np.int64))]
            planned = np.flatnonzero((rest > 0) & (rank < plan.used[rest]))
            at = np.searchsorted(plan.keys, rest[planned] * _RANKS + rank[planned], "right") - 1
            if len(planned):
                step = rest[planned] * _RANKS + rank[planned] - plan.keys[at]
                out.append((planned, full[planned] * plan.window, rest[planned], get("rest_crc")[planned], plan.sequence[at] + step, plan.offset[at]))
            loose = np.flatnonzero((rest > 0) & (rank >= plan.used[rest]))
            if len(loose):
                place_at = plan.stream[rest[loose]] + (rank[loose] - plan.used[rest[loose]]) * rest[loose]
                sequence, offset = place_at // plan.window, place_at % plan.window
                first = np.minimum(rest[loose], plan.window - offset)
                own = get("rest_crc")[loose]
                cut = np.flatnonzero(first < rest[loose])
                tails = b.column("rest_ids")
                second_crc = np.zeros(len(cut), np.int64)
                for k, c in enumerate(cut):
                    ids = np.frombuffer(tails[int(loose[c])].as_py(), np.uint16)
                    own[c], second_crc[k] = _crc(ids[: first[c]]), _crc(ids[first[c] :])
                start = full[loose] * plan.window
                out.append((loose, start, first, own, plan.stream_sequence + sequence, offset))
                out.append((loose[cut], start[cut] + first[cut], rest[loose][cut] - first[cut], second_crc, plan.stream_sequence + sequence[cut] + 1, np.zeros(len(cut), np.int64)))
            cols = [np.concatenate(x) for x in zip(*out, strict=True)]
            row = cols[0]
            values = [b.column("id").take(pa.array(row)), *(pa.array(cols[k].astype(np.int64)) for k in (1, 2, 3)), pa.array(n[row]), pa.array(cols[4].astype(np.int64)), pa.array(cols[5].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(values, names)

    return rows.join(bases, ["part", "rest"]).mapInArrow(place, schema).withColumnRenamed("id", id_col)
