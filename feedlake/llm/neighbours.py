"""Near duplicates among embeddings by NN-descent over a neighbour graph."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, connected_components

#: Neighbours in a list at first and at most, mean rows of a start group, most rows compared in one, and the share of pairs at the threshold that the groups are to bring together.
LIST, LIMIT, CELL, GROUP, TOGETHER = 12, 48, 128, 512, 0.98
#: Rounds at most, and of a larger list; share of changed lists at which descent ends.
ROUNDS, MORE, STILL = 8, 2, 0.01
#: Linked vectors that make an audit (of all, of a size class), the recall that ends the starts, the one below which there is no result, and starts at most.
AUDIT, CLASS_AUDIT, RECALL, LEAST_RECALL, STARTS = 50, 20, 0.98, 0.9, 4
#: Rows compared at once, rows of a block of the exact search, and about how many components' centres are sent to the tasks at once.
BLOCK, WIDE, CENTRES = 1024, 4096, 4096


def _matrix(column: pa.Array) -> np.ndarray:
    """Unit vectors (rows) of a column of binaries of doubles."""
    if len(column) == 0:
        return np.zeros((0, 0))
    width = len(column[0].as_py()) // 8
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), width)


def unit_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): vectors of length 1 as doubles; null, empty, zero and non-finite ones are left out, as is a null id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for mixed in batches:
            size = pc.if_else(pc.is_null(mixed.column("id")), None, pc.list_value_length(mixed.column("v")))
            for n in pc.unique(size).to_pylist():
                if n:
                    b = mixed.filter(pc.equal(size, n))
                    x = b.column("v").flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, n)
                    scale = np.abs(x).max(axis=1)
                    good = np.isfinite(scale) & (scale > 0)
                    x = x[good] / scale[good, None]
                    x /= np.sqrt((x * x).sum(axis=1))[:, None]
                    cuts = pa.py_buffer((np.arange(len(x) + 1) * n * 8).astype(np.int32))
                    packed = pa.Array.from_buffers(pa.binary(), len(x), [None, cuts, pa.py_buffer(np.ascontiguousarray(x))])
                    yield pa.RecordBatch.from_arrays([b.column("id").filter(pa.array(good)), packed], ["id", "v"])

    return table.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("v")).mapInArrow(run, "id bigint, v binary")


def _splits(count: int, least: float) -> tuple[int, int]:
    """(planes, splits): hyperplanes that leave about CELL rows a side, and how often to split for TOGETHER of the pairs at the threshold to share one."""
    planes = max(0, int(np.ceil(np.log2(max(count, 1) / CELL))))
    share = (1 - np.arccos(np.clip(least, -1, 1)) / np.pi) ** planes
    return planes, 1 if share >= 1 else min(64, max(2, int(np.ceil(np.log(1 - TOGETHER) / np.log(1 - share)))))


def _start(vectors: DataFrame, count: int, seed: int, least: float) -> DataFrame:
    """(id, other, sim): the best LIST of each vector among those on its side of random hyperplanes, and up to LIMIT links.

    Groups larger than GROUP are cut by a hash of the id, another one in each split: they
    only start the graph.
    """
    planes, splits = _splits(count, least)

    def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for mixed in batches:
            size = pc.binary_length(mixed.column("v"))
            for n in pc.unique(size).to_pylist():
                b = mixed.filter(pc.equal(size, n))
                x = _matrix(b.column("v"))
                for s in range(splits):
                    normal = np.random.default_rng([seed, s, x.shape[1]]).normal(size=(x.shape[1], planes))
                    key = ((x @ normal > 0) @ (1 << np.arange(planes))) * splits + s + x.shape[1] * (splits << planes)
                    yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64)), b.column("id"), b.column("v")], ["key", "id", "v"])

    keyed = vectors.mapInArrow(sides, "key bigint, id bigint, v binary")
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    parts = keyed.join(sizes, "key").withColumn("part", F.pmod(F.xxhash64("id", "key", F.lit(seed)), F.ceil(F.col("n") / GROUP)))

    def best(table: pa.Table) -> pa.Table:
        ids, x = table.column("id").to_numpy(), _matrix(table.column("v").combine_chunks())
        if len(ids) < 2:
            return pa.table({"id": pa.array([], pa.int64()), "other": pa.array([], pa.int64()), "sim": pa.array([], pa.float64())})
        out = []
        for a in range(0, len(ids), BLOCK):
            sim = x[a : a + BLOCK] @ x.T
            sim[np.arange(len(sim)), np.arange(a, a + len(sim))] = -2
            k = min(LIMIT, len(ids) - 1)
            top = np.argpartition(-sim, k - 1, axis=1)[:, :k]
            best = np.take_along_axis(sim, top, 1)
            last = np.partition(best, -min(LIST, k), axis=1)[:, -min(LIST, k)]
            i, j = np.nonzero((best >= last[:, None]) | (best >= least))
            out.append((ids[a : a + BLOCK][i], ids[top[i, j]], best[i, j]))
        cols = [np.concatenate(c) for c in zip(*out, strict=True)]
        return pa.table(dict(zip(("id", "other", "sim"), cols, strict=True)))

    return parts.select("key", "part", "id", "v").groupBy("key", "part").applyInArrow(best, "id bigint, other bigint, sim double")


def _lists(edges: DataFrame, least: float) -> DataFrame:
    """(id, other, sim, fresh, k): the best LIST of each vector's edges, and up to LIMIT that are links, by rank; of equal edges the older counts."""
    one = edges.groupBy("id", "other").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    w = Window.partitionBy("id").orderBy(F.col("sim").desc(), "other")
    return one.withColumn("k", F.row_number().over(w)).filter((F.col("k") <= LIST) | ((F.col("k") <= LIMIT) & (F.col("sim") >= least)))


def _round(lists: DataFrame, vectors: DataFrame, keep: int = LIST, short: DataFrame | None = None, least: float = -2.0) -> DataFrame:
    """(id, other, sim, fresh): better pairs among the neighbours, forward and back, of each vector.

    Each vector gets the vectors of its `keep` neighbours and of at most as many that name
    it; pairs with one fresh edge at least are compared, and the best `keep` of those better than the
    worst of a list are told to it. With `short` (id), these lists alone grow, by links of `least` or more.
    """
    if short is None:
        worst = lists.groupBy("id").agg(F.coalesce(F.max(F.when(F.col("k") == keep, F.col("sim"))), F.lit(-2.0)).alias("worst"))
    else:
        grows = short.select("id", F.lit(True).alias("grows"))
        worst = lists.select("id").distinct().join(grows, "id", "left").select("id", F.when(F.col("grows"), F.lit(np.nextafter(least, -2).item())).otherwise(2.0).alias("worst"))
    lists = lists.filter(F.col("k") <= keep)
    back = lists.select(F.col("other").alias("id"), F.col("id").alias("other"), "fresh")
    w = Window.partitionBy("id").orderBy(F.col("fresh").desc(), F.xxhash64("id", "other"))
    back = back.withColumn("k", F.row_number().over(w)).filter(F.col("k") <= keep).drop("k")
    around = lists.select("id", "other", "fresh").unionByName(back).groupBy("id", "other").agg(F.max("fresh").alias("fresh"))
    if short is not None:
        around = around.join(around.join(short.select(F.col("id").alias("other")), "other", "left_semi").select("id").distinct(), "id", "left_semi")
    member = vectors.join(worst, "id").select(F.col("id").alias("other"), "v", "worst")
    sets = around.join(member, "other").groupBy("id").agg(F.collect_list(F.struct("other", "v", "worst", "fresh")).alias("m"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows == 0:
                continue
            m = b.column("m").flatten()
            cuts = np.asarray(b.column("m").offsets)
            cuts = cuts - cuts[0]
            other, worst, fresh = (m.field(c).to_numpy(zero_copy_only=False) for c in ("other", "worst", "fresh"))
            vectors = m.field("v").to_pylist()
            out = []
            for a, z in zip(cuts[:-1], cuts[1:], strict=True):
                x = np.frombuffer(b"".join(vectors[a:z]), np.float64).reshape(z - a, -1)
                sim = x @ x.T
                better = (sim > worst[a:z, None]) & (fresh[a:z, None] | fresh[None, a:z]) & (other[a:z, None] != other[None, a:z])
                if z - a > keep:
                    last = np.argpartition(-np.where(better, sim, -3), keep - 1, axis=1)[:, keep:]
                    np.put_along_axis(better, last, False, 1)
                i, j = np.nonzero(better)
                out.append((other[a:z][i], other[a:z][j], sim[i, j]))
            cols = [np.concatenate(c) for c in zip(*out, strict=True)]
            pair, at = np.unique(np.stack(cols[:2], 1), axis=0, return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1]), pa.array(cols[2][at]), pa.array(np.ones(len(at), bool))], ["id", "other", "sim", "fresh"])

    return sets.mapInArrow(run, "id bigint, other bigint, sim double, fresh boolean")


def neighbour_graph(vectors: DataFrame, scratch: Scratch, count: int, least: float, seed: int = 0, rounds: int = ROUNDS) -> DataFrame:
    """(id, other, sim, fresh): lists of near neighbours, refined until hardly any changes, then enlarged where they are saturated.

    A list whose LIST entries are all links is saturated, as there may be more: it gets twice the room and MORE
    rounds among the neighbours of its neighbours, again until it has LIMIT entries or gains none.
    """

    def grown(lists: DataFrame, new: DataFrame) -> DataFrame:
        edges = lists.drop("k").withColumn("fresh", F.lit(False))
        merged = scratch.table(_lists(edges.unionByName(new), least), "lists")
        scratch.drop(lists)
        return merged

    lists = scratch.table(_lists(_start(vectors, count, seed, least).withColumn("fresh", F.lit(True)), least), "start")
    for _ in range(rounds):
        lists = grown(lists, _round(lists, vectors))
        if lists.filter("fresh").count() <= STILL * LIST * count:
            break
    keep = LIST
    while keep < LIMIT:
        keep *= 2
        full = lists.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.min("sim").alias("worst")).filter((F.col("n") >= LIST) & (F.col("n") < LIMIT) & (F.col("worst") >= least))
        short = scratch.table(full.select("id"), "short")
        if short.limit(1).count() == 0:
            break
        lists = scratch.table(lists.withColumn("fresh", F.lit(True)), "lists")
        for _ in range(MORE):
            lists = grown(lists, _round(lists, vectors, keep, short, least))
        gained = lists.filter("fresh").limit(1).count()
        scratch.drop(short)
        if not gained:
            break
    return lists


def _forest(pairs: np.ndarray) -> np.ndarray:
    """A spanning forest of the pairs: no more rows than vertices."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(up, up)
        return x

    out = []
    for a, b in pairs.tolist():
        x, y = find(a), find(b)
        if x != y:
            parent[x] = y
            out.append((a, b))
    return np.array(out, np.int64).reshape(-1, 2)


def _touched(rows: DataFrame, centres: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], least: float) -> DataFrame:
    """(id, near): the wanted components in which a vector may have links.

    By the triangle inequality of angles none lies further from a component's centre
    than its radius and the angle of a link. `centres` has, by length of the
    vectors, the components, their centres and radii.
    """
    reach = float(np.arccos(min(max(least, -1.0), 1.0))) + 1e-6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = pc.binary_length(b.column("v"))
            for n in pc.unique(size).to_pylist():
                if n in centres:
                    some = b.filter(pc.equal(size, n))
                    names, c, radius = centres[n]
                    i, j = np.nonzero(np.arccos(np.clip(_matrix(some.column("v")) @ c.T, -1, 1)) <= radius + reach)
                    yield pa.RecordBatch.from_arrays([some.column("id").take(pa.array(i)), pa.array(names[j])], ["id", "near"])

    return rows.select("id", "v").mapInArrow(run, "id bigint, near bigint")


def _radii(rows: DataFrame, components: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Components (about CENTRES of them), centres (the vector of the smallest id) and radii by length of the vectors."""
    found = rows.join(components.select(F.col("component").alias("id")), "id", "left_semi").select("id", "v").collect()
    at = {r["id"]: np.frombuffer(r["v"], np.float64) for r in found}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = b.column("component").to_pylist()
            cos = np.array([np.frombuffer(v, np.float64) @ at[k] for k, v in zip(c, b.column("v").to_pylist(), strict=True)], float)
            yield pa.RecordBatch.from_arrays([b.column("component"), pa.array(np.arccos(np.clip(cos, -1, 1)))], ["component", "angle"])

    own = rows.filter("wanted").join(components, "component", "left_semi")
    radius = {r["component"]: r["r"] for r in own.select("component", "v").mapInArrow(run, "component bigint, angle double").groupBy("component").agg(F.max("angle").alias("r")).collect()}
    out = {}
    for n in {len(v) for v in at.values()}:
        names = [k for k, v in at.items() if len(v) == n]
        out[n * 8] = (np.array(names, np.int64), np.stack([at[k] for k in names]), np.array([radius[k] for k in names]))
    return out


def _search(rows: DataFrame, scratch: Scratch, least: float) -> DataFrame:
    """(id, n, a, b): exact links of the wanted vectors with all others; `rows` is (id, v, m, component, wanted).

    n is, for a wanted vector, the number of its links, and for another one that of its
    links with wanted ones, each counted m times; (a, b) are components that
    links join. Wanted vectors lie in blocks of about WIDE rows, and the others that may
    link to a block's components are dealt in parts of about WIDE rows: a task compares one block with
    one part, and what leaves it are numbers for its rows and a forest of its components.
    """
    wanted = rows.filter("wanted").select("id", "component", F.length("v").alias("size"))
    sizes = wanted.groupBy("component", "size").agg(F.count(F.lit(1)).alias("c"))
    bins = max(1, -(-wanted.count() // WIDE))
    part = F.pmod(F.xxhash64("id", F.lit(11)), F.ceil(F.col("c") / WIDE))
    small = F.pmod(F.xxhash64("component", F.lit(12)), F.lit(bins))
    block = F.when(F.col("c") >= WIDE, F.xxhash64("size", "component", part)).otherwise(F.xxhash64("size", small))
    members = scratch.table(wanted.join(sizes, ["component", "size"]).select("id", "component", "size", block.alias("block")), "members")
    blocks = members.select("component", "size", "block").distinct()
    components = members.select("component").distinct()
    turns = max(1, -(-components.count() // max(CENTRES, 1)))
    touched = []
    for k in range(turns):
        some = components.filter(F.pmod(F.xxhash64("component", F.lit(14)), F.lit(turns)) == k)
        near = _touched(rows, _radii(rows, some), least)
        touched.append(scratch.table(near.join(blocks.select(F.col("component").alias("near"), "block"), "near").select("id", "block").distinct(), "touched"))
    pairs = scratch.table(reduce(DataFrame.unionByName, touched).distinct(), "pairs")
    scratch.drop(*touched)
    parts = pairs.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / WIDE).alias("parts"))
    right = pairs.join(parts, "block").select("block", F.pmod(F.xxhash64("id", F.lit(13)), F.col("parts")).alias("part"), "id", F.lit(False).alias("left"))
    left = members.join(parts, "block").select("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"), "id", F.lit(True).alias("left"))
    dealt = left.unionByName(right).join(rows, "id")

    def count(table: pa.Table) -> pa.Table:
        get = lambda c: table.column(c).to_numpy()
        ids, m, component, wanted, first = get("id"), get("m"), get("component"), get("wanted"), get("left")
        x = _matrix(table.column("v").combine_chunks())
        here, there = np.flatnonzero(first), np.flatnonzero(~first)
        n, joins = np.zeros(len(ids), np.int64), np.zeros((0, 2), np.int64)
        for a in range(0, len(here), BLOCK):
            i = here[a : a + BLOCK]
            near = (x[i] @ x[there].T >= least) & (ids[i][:, None] != ids[there][None, :])
            n[i] += near @ m[there]
            n[there] += (m[i] @ near) * ~wanted[there]
            y, z = np.nonzero(near & (component[i][:, None] != component[there][None, :]))
            joins = _forest(np.unique(np.concatenate([joins, np.stack([component[i][y], component[there][z]], 1)]), axis=0))
        some = np.flatnonzero(n)
        none = lambda k: pa.nulls(k, pa.int64())
        cols = [(pa.array(ids[some]), none(len(joins))), (pa.array(n[some]), none(len(joins))), (none(len(some)), pa.array(joins[:, 0])), (none(len(some)), pa.array(joins[:, 1]))]
        return pa.table({c: pa.chunked_array(list(v)) for c, v in zip(("id", "n", "a", "b"), cols, strict=True)})

    return dealt.groupBy("block", "part").applyInArrow(count, "id bigint, n bigint, a bigint, b bigint")


def audit(fresh: DataFrame, edges: DataFrame, labels: DataFrame, wanted: DataFrame) -> tuple[float, int]:
    """(recall, vectors): the lowest mean recall of a vector's links, of all vectors and in any size class, and the vectors it rests on.

    `fresh` has links (id, other) of a start that the graph had no part in, so a
    share of all links of every kind, however rare they are; each vector that has some is asked
    which of them are known. Vectors of `wanted` were compared with all. A size class is the
    power of two of the largest component at a vector's links; one with fewer than CLASS_AUDIT
    vectors counts only among all.
    """
    sizes = labels.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    size = labels.join(sizes, "component").select("id", "size")
    sure = wanted.select("id", F.lit(True).alias("sure"))
    asked = fresh.join(edges.select("id", "other", F.lit(True).alias("known")), ["id", "other"], "left").join(sure, "id", "left")
    asked = asked.join(sure.toDF("other", "sure2"), "other", "left").join(size, "id", "left").join(size.toDF("other", "size2"), "other", "left")
    each = asked.groupBy("id").agg(
        F.avg(F.coalesce("known", "sure", "sure2", F.lit(False)).cast("double")).alias("recall"),
        F.floor(F.log2(F.max(F.greatest(F.coalesce("size", F.lit(1)), F.coalesce("size2", F.lit(1)))))).alias("class"),
    )
    rows = each.groupBy("class").agg(F.sum("recall").alias("found"), F.count(F.lit(1)).alias("n")).collect()
    total = sum(r["n"] for r in rows)
    means = [r["found"] / r["n"] for r in rows if r["n"] >= CLASS_AUDIT] + ([sum(r["found"] for r in rows) / total] if total else [])
    return min(means, default=0.0), total


def _linked(lists: DataFrame, least: float, scratch: Scratch) -> DataFrame:
    """(id, other): edges at the threshold, both ways, once each."""
    near = lists.filter(F.col("sim") >= least).select("id", "other")
    return scratch.table(near.unionByName(near.select(F.col("other").alias("id"), F.col("id").alias("other"))).distinct(), "near")


def near_duplicates(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.95) -> DataFrame:
    """One row per input row: (id_col, n_links, component_id, kept, recall).

    Vectors with cosine >= `least` (double precision) link. Equal vectors are one class
    with a size, so copies fill no lists. The neighbour graph of the classes starts
    with random hyperplane groups, is refined by comparing neighbours of neighbours, and its
    saturated lists are enlarged. Links are its edges at the threshold, both ways. Recall is measured
    for each vector on the links of another start, which then count too; below RECALL, or with fewer
    than AUDIT linked vectors seen, the graph is started anew, at most STARTS times, and the edges
    of all are used. A recall below LEAST_RECALL is an error; `recall` is the last one measured, null where
    no vector was linked.

    Vectors with LIMIT links or more are in groups so dense that lists would be pairs of
    all: these alone are compared exactly, in blocks, with the classes that can lie near their component.

    Defined cases: null, zero and non-finite vectors (or with such components) have no
    links and are their own component, as have null ids no component; vectors of
    different lengths don't link; a repeated row counts once and is answered each time
    (with different vectors under one id the first in order counts); an empty table
    gives no rows; other columns are not read.
    """
    scratch = Scratch(table.sparkSession, "neighbours")
    vectors = scratch.table(unit_vectors(table, id_col, vector_col).groupBy("id").agg(F.min("v").alias("v")), "vectors")
    classes = scratch.table(vectors.groupBy("v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("m")), "classes")
    reps = classes.select("id", "v")
    count = classes.count()
    dense = lambda pairs: scratch.table(pairs.groupBy("id").count().filter(F.col("count") >= LIMIT).select("id"), "dense")
    edges = labels = fresh = None
    for attempt in range(STARTS):
        lists = neighbour_graph(reps, scratch, count, least, attempt)
        near = _linked(lists, least, scratch)
        graph = scratch.table((near if edges is None else near.unionByName(edges)).distinct(), "graph")
        scratch.drop(lists, near, edges, labels, fresh)
        labels = scratch.table(connected_components(graph.select(F.col("id").alias("a"), F.col("other").alias("b")), scratch), "labels")
        fresh = _linked(_start(reps, count, STARTS + attempt, least), least, scratch)
        recall, asked = audit(fresh, graph, labels, full := dense(graph))
        edges = scratch.table(graph.unionByName(fresh).distinct(), "edges")
        scratch.drop(graph, full)
        if asked >= AUDIT and recall >= RECALL:
            break
    if asked >= AUDIT and recall < LEAST_RECALL:
        raise RuntimeError(f"recall of {recall:.3f} after {STARTS} starts")
    wanted = dense(edges).withColumn("wanted", F.lit(True))
    rows = classes.join(labels, "id", "left").join(wanted, "id", "left")
    rows = scratch.table(rows.select("id", "v", "m", F.coalesce("component", "id").alias("component"), F.coalesce("wanted", F.lit(False)).alias("wanted")), "rows")
    exact = scratch.table(_search(rows, scratch, least), "exact")
    joined = labels.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(exact.filter("a is not null").select("a", "b"))
    joined = joined.unionByName(fresh.select(F.col("id").alias("a"), F.col("other").alias("b")))
    labels = scratch.table(connected_components(joined, scratch), "labels")
    searched = rows.filter("wanted").select("id")
    rest = edges.join(searched, "id", "left_anti").join(searched.toDF("other"), "other", "left_anti").join(classes.select(F.col("id").alias("other"), "m"), "other")
    links = rest.select("id", F.col("m").alias("n")).unionByName(exact.filter("id is not null").select("id", "n")).groupBy("id").agg(F.sum("n").alias("n"))
    answers = classes.join(links, "id", "left").join(labels, "id", "left")
    answers = answers.select("v", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("component", "id").alias("component"))
    answers = scratch.table(vectors.join(answers, "v").select("id", "n_links", "component"), "answers")
    ids = F.col(id_col).cast("bigint")
    out = table.select(F.col(id_col)).join(answers, ids == F.col("id"), "left")
    component = F.when(F.col(id_col).isNotNull(), F.coalesce(F.col("component"), ids))
    return out.select(id_col, F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.coalesce(component == ids, F.lit(True)).alias("kept"), F.lit(recall if asked else None).cast("double").alias("recall"))
