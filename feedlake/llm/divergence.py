"""How the vocabulary of each source differs from its language and from the other sources.

A term's share p of a group is 1 + floor(10^9 (count + 2) / (N + 2 V)), for V kept terms
and N occurrences of them; the divergence of two shares is floor((p - q)^2 / (p + q)).

The terms that set a group apart most are found by dominance: of two terms, the one with
the higher count in the group, the lower count in the language and the earlier name has
the higher rank whatever the totals are. So each partition keeps its skyband, the terms
that fewer than k others dominate; skybands are merged by group, and only what is left is
given exact values and ranked. Sums over all terms, for pairs of sources, are made
of dense blocks of terms and sources; a task returns sums, never pairs of a term's sources.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, whole_text
from .encode import split_batches

#: Counters of a task before it hands them on, terms it retains before that, and terms and sources of a block.
COUNTERS, RETAINED, TERMS, SOURCES = 300_000, 500_000, 2048, 256
#: What bytes become: A-Z in lower case, other letters and all of non-ASCII as they are, the rest a space.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def count_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, n_docs): occurrences and documents of each term of each group; a group itself is the term ''.

    Null texts, languages and sources count as empty. Tasks sum up what they read, in
    as many counters as COUNTERS allows, before the shuffle.
    """
    rows = docs.select(whole_text("lang").alias("lang"), whole_text("source").alias("source"), whole_text("text").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, n_docs) in found.items():
                terms = pa.array([b"", *n], pa.binary()).view(pa.string())
                sums = [pa.array([0, *n.values()], pa.int64()), pa.array([0, *[n_docs[t] for t in n]], pa.int64())]
                names = [pa.array([x] * len(terms)) for x in (lang, source)]
                yield pa.RecordBatch.from_arrays([*names, terms, *sums], ["lang", "source", "term", "n", "n_docs"])
            found.clear()

        for b in split_batches(batches, "text"):
            for lang, source, text in zip(*[b.column(c).to_pylist() for c in ("lang", "source", "text")], strict=True):
                n, n_docs = found.setdefault((lang, source), (Counter(), Counter()))
                before = len(n)
                words = text.translate(_LETTERS).split()
                n.update(words)
                n_docs.update(set(words))
                size += len(n) - before + (before == 0)
                if size >= COUNTERS:
                    yield from flush()
                    size = 0
        yield from flush()

    parts = rows.mapInArrow(run, "lang string, source string, term string, n bigint, n_docs bigint")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def kept_terms(counts: DataFrame, least: int) -> DataFrame:
    """(lang, term, lang_n, counts): terms in at least so many documents of a language, with their counts by source.

    The term '' has all sources of a language, each with the count 0. A row has one entry for
    each source of the language that has the term, which is less than a source's pairs are.
    """
    entry = F.collect_list(F.struct("source", "n"))
    found = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("n_docs").alias("n_docs"), entry.alias("counts"))
    return found.filter((F.col("term") == "") | (F.col("n_docs") >= least)).drop("n_docs")


def share(count: Column, total: Column) -> Column:
    """1 + floor(10^9 (count + 2) / total), in three steps that stay exact to 9 x 10^15 occurrences."""
    rest, out = count + 2, F.lit(0)
    for _ in range(3):
        out = out * 1000 + F.call_function("div", rest * 1000, total)
        rest = (rest * 1000) % total
    return out + 1


def _shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    rest, out = counts + 2, np.zeros_like(counts)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, totals)
        out = out * 1000 + more
    return out + 1


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def skyband(n: np.ndarray, lang_n: np.ndarray, term: np.ndarray, k: int) -> np.ndarray:
    """Places of the rows that fewer than k others dominate, by higher n, lower lang_n and earlier term.

    Rows come in an order in which all that dominate a row precede it, and are compared by
    blocks with those retained so far: whoever has k dominators has k of them there.
    """
    name = np.unique(term, return_inverse=True)[1] if len(term) else np.zeros(0, np.int64)
    order = np.lexsort((name, lang_n, -n))
    kept = np.zeros(0, np.int64)
    for at in range(0, len(order), 256):
        part = order[at : at + 256]
        over = lambda rows, part=part: (lang_n[rows][None, :] <= lang_n[part][:, None]) & (name[rows][None, :] < name[part][:, None])
        near = np.tril(over(part), -1).sum(1)
        kept = np.concatenate([kept, part[near + over(kept).sum(1) < k]])
    return kept


def prune(rows: DataFrame, k: int) -> DataFrame:
    """The rows (lang, source, term, n, lang_n) that aren't dominated k times by rows of their group in their partition."""
    names = ["lang", "source", "term", "n", "lang_n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], pd.DataFrame] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                yield pa.RecordBatch.from_pandas(pd.concat(held.values()), preserve_index=False)
            held.clear()

        for b in batches:
            for key, new in b.to_pandas().groupby(["lang", "source"], sort=False):
                old = held.get(key)
                both = new if old is None else pd.concat([old, new])
                best = both.iloc[np.sort(skyband(both["n"].to_numpy(), both["lang_n"].to_numpy(), both["term"].to_numpy(object), k))]
                held[key] = best
                size += len(best) - (0 if old is None else len(old))
            if size >= RETAINED:
                yield from flush()
                size = 0
        yield from flush()

    return rows.select(*names).mapInArrow(run, "lang string, source string, term string, n bigint, lang_n bigint")


def distinctive_terms(kept: DataFrame, groups: DataFrame, most: int) -> DataFrame:
    """(lang, source, part, item, value, rank): the terms that are commoner in a source than in its language."""
    rows = kept.filter("term <> ''").select("lang", "term", "lang_n", F.explode("counts").alias("c")).select("lang", "c.source", "term", "c.n", "lang_n")
    merged = prune(prune(rows, most).repartition("lang", "source"), most)
    exact = merged.join(groups.select("lang", "source", "total", "lang_total"), ["lang", "source"])
    p, q = share(F.col("n"), F.col("total")), share(F.col("lang_n"), F.col("lang_total"))
    exact = exact.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).filter("p > q")
    return _ranked(exact.select("lang", "source", F.lit("term").alias("part"), "item", divergence(F.col("p"), F.col("q")).alias("value"))).filter(F.col("rank") <= most)


def _ranked(rows: DataFrame) -> DataFrame:
    w = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.withColumn("rank", F.row_number().over(w))


def source_pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank): each other source of the language, by the sum over all kept terms.

    Terms are dealt to blocks by hash, sources too where a language has many: a block is a
    dense table of at most about TERMS by two times SOURCES shares, whose sums are added up.
    """
    most, terms = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 0, kept.count()
    n_blocks, n_salts = -(-most // SOURCES) or 1, -(-terms // TERMS) or 1
    block = lambda source: F.pmod(F.xxhash64(source), F.lit(n_blocks)).cast("int")
    last = F.lit(n_blocks - 1)
    one = kept.filter("term <> ''").select("lang", F.pmod(F.xxhash64("term"), F.lit(n_salts)).cast("int").alias("salt"), "counts", F.explode(F.sequence(F.lit(0), last)).alias("a"))
    one = one.select("*", F.explode(F.sequence("a", last)).alias("b"))
    if n_blocks > 1:
        one = one.withColumn("counts", F.filter("counts", lambda c: block(c["source"]).isin(F.col("a"), F.col("b"))))
    own = groups.select("lang", "source", "total", "terms", block(F.col("source")).alias("k"))
    sides = own.select("*", F.explode(F.sequence("k", last)).alias("o")).select("lang", "source", "total", "terms", F.col("k").alias("a"), F.col("o").alias("b"), F.lit(0).alias("side"))
    sides = sides.unionByName(own.select("*", F.explode(F.sequence(F.lit(0), "k")).alias("o")).select("lang", "source", "total", "terms", F.col("o").alias("a"), F.col("k").alias("b"), F.lit(1).alias("side")))
    sides = sides.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_salts - 1))).alias("salt"))

    def run(key: tuple, counts: pa.Table, members: pa.Table) -> pa.Table:
        lang, first, second, salt = (k.as_py() for k in key)
        counts, members = counts.combine_chunks(), members.combine_chunks()
        shares, names = [], []
        for side in (0, 1):
            part = members.filter(pc.equal(members["side"], side))
            names.append(part["source"].combine_chunks())
            table = np.zeros((len(counts), len(part)), np.int64)
            if len(counts):
                lists = counts["counts"].combine_chunks()
                at = pc.index_in(lists.flatten().field("source"), names[-1])
                row = np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets)))
                fits = np.asarray(at.is_valid())
                table[row[fits], np.asarray(at.drop_null())] = np.asarray(lists.flatten().field("n"))[fits]
                table = _shares(table, np.asarray(part["total"]))
            shares.append(table)
        sums = np.zeros((len(names[0]), len(names[1])), np.int64)
        for k in range(len(sums) if len(counts) else 0):
            p = shares[0][:, k : k + 1]
            sums[k] = ((p - shares[1]) ** 2 // (p + shares[1])).sum(0)
        i, j = np.divmod(np.arange(sums.size), max(sums.shape[1], 1))
        some = np.ones(sums.size, bool) if salt == 0 else sums.ravel() > 0
        if first == second:
            some &= i != j
        i, j = i[some], j[some]
        x, y, v = names[0].take(pa.array(i)), names[1].take(pa.array(j)), sums[i, j]
        if first != second:
            x, y, v = pa.concat_arrays([x, y]), pa.concat_arrays([y, x]), np.concatenate([v, v])
        return pa.table({"lang": pa.array([lang] * len(v), pa.string()), "source": x, "item": y, "value": pa.array(v, pa.int64())})

    keys = ["lang", "a", "b", "salt"]
    sums = one.groupBy(*keys).cogroup(sides.groupBy(*keys)).applyInArrow(run, "lang string, source string, item string, value bigint")
    sums = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    return _ranked(sums.select("lang", "source", F.lit("pair").alias("part"), "item", "value"))


def source_divergence(docs: DataFrame, least: int = 10, most: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank) of every group of documents: part 'pair' has all other sources, part 'term' the `most` terms.

    Null texts, languages and sources count as empty texts and groups named ''. Every row is
    a document, repeated ids and rows too. Languages without kept terms have pairs of value 0
    and no terms; ties are ranked by name in UTF-8; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "divergence")
    kept = scratch.table(kept_terms(count_terms(docs), least), "kept")
    totals = kept.select("lang", F.explode("counts").alias("c")).groupBy("lang", F.col("c.source").alias("source")).agg(F.sum("c.n").alias("n"))
    langs = kept.groupBy("lang").agg(F.count_if(F.col("term") != "").alias("terms"), F.sum("lang_n").alias("lang_n"))
    both = totals.join(langs, "lang").select("lang", "source", "terms", (F.col("n") + 2 * F.col("terms")).alias("total"), (F.col("lang_n") + 2 * F.col("terms")).alias("lang_total"))
    groups = scratch.table(both, "groups")
    return source_pairs(kept, groups).unionByName(distinctive_terms(kept, groups, most))
