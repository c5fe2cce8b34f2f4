"""Language identification: text likelihoods fused with what surrounds the text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch
from .encode import split_batches
from .subword import gram_buckets, joined, word_spans

#: Buckets of byte trigrams, training rows of all languages and of one at least, their longest text, n-grams that a text counts for at most, weight of a parent in a host's prior.
BUCKETS, TRAIN_ROWS, TRAIN_LEAST, TRAIN_CHARS, EVIDENCE, PARENT = 1 << 14, 3000, 100, 20_000, 60.0, 20.0
#: Parts of a language in the first step of picking its training rows.
PARTS = 64
#: The answer for texts in none of the languages, and its prior.
UNKNOWN, UNKNOWN_PRIOR = "und", 0.001


@dataclass(frozen=True)
class TextModel:
    """languages and log P(trigram | language) by bucket; the last column is any text at all."""

    languages: tuple[str, ...]
    table: np.ndarray

    def log_likelihoods(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(mean log likelihood of each text under each column, trigrams of each text)."""
        data, cuts = joined(texts)
        data, _, _ = word_spans(data, digits=False)
        grams = gram_buckets(data, range(3, 4), BUCKETS - 1)
        at, bucket = grams[0] if grams else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        first = np.searchsorted(at + 1, cuts)
        n = np.diff(first)
        out = np.zeros((len(n), self.table.shape[1]))
        for k in range(self.table.shape[1]):
            sums = np.concatenate([[0.0], np.cumsum(self.table[bucket, k], dtype=np.float64)])
            out[:, k] = (sums[first[1:]] - sums[first[:-1]]) / np.maximum(n, 1)
        return out, n


def train_text_model(rows: list[tuple[str, str]]) -> TextModel:
    """Smoothed trigram frequencies of each language of (text, language)."""
    languages = tuple(sorted({y for _, y in rows}))
    counts = np.zeros((BUCKETS, len(languages) + 1))
    for k, language in enumerate(languages):
        data, _ = joined(pa.array([t for t, y in rows if y == language], pa.large_string()))
        for _, bucket in gram_buckets(word_spans(data, digits=False)[0], range(3, 4), BUCKETS - 1):
            counts[:, k] = np.bincount(bucket, minlength=BUCKETS)
    table = np.log(counts + 0.3) - np.log((counts + 0.3).sum(axis=0))
    return TextModel(languages, table.astype(np.float32))


def training_rows(docs: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(text, label): the same number of distinct ids of each labelled language, those of the smallest hashes.

    TRAIN_ROWS are shared by the languages, but none has fewer than TRAIN_LEAST (or
    all it has). An id counts once in a language, with one text. Texts over TRAIN_CHARS
    characters come after the others and count by their beginning, so a language of long texts
    alone is known too. Only the ids picked are broadcast.
    """
    labelled = docs.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    labelled = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"), F.col(label_col).alias("y")).withColumn("h", F.xxhash64("t"))
    ids = labelled.groupBy("y", "id").agg(F.min(F.struct((F.length("t") > TRAIN_CHARS).alias("long"), "h")).alias("text"))
    languages = labelled.agg(F.count_distinct("y")).first()[0]
    most = max(TRAIN_LEAST, TRAIN_ROWS // max(languages, 1))
    order = [F.col("text.long"), F.xxhash64("id"), F.col("id")]
    picked = ids.withColumn("part", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(PARTS)))
    for keys in (("y", "part"), ("y",)):
        picked = picked.withColumn("k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("k") <= most)
    picked = picked.select("y", "id", F.col("text.h").alias("h"))
    texts = labelled.withColumn("t", F.substring("t", 1, TRAIN_CHARS)).join(F.broadcast(picked), ["y", "id", "h"])
    return texts.groupBy("y", "id").agg(F.min("t").alias("t")).select("t", "y")


def identify(
    docs: DataFrame,
    model: TextModel,
    id_col: str = "doc_id",
    text_col: str = "text",
    declared: Column | None = None,
    host_levels: list[Column] | None = None,
    least: float = 0.5,
) -> DataFrame:
    """(id_col, language, confidence, text_language, text_hash, accepted) of every row; text_hash (xxhash64) tells apart rows of one id.

    A posterior multiplies four kinds of evidence: the whole text's likelihood
    (trigrams in words; long texts count as EVIDENCE trigrams, as trigrams aren't
    independent), the declared language's likelihood, and the prior of the host,
    smoothed towards that of the coarser level (`host_levels` from coarse, such as
    an address suffix, to fine), and that towards the whole table's. Priors and the
    reliability of declarations are sums of the text posteriors by grouped
    aggregation, so a host that holds a third of all rows meets as one row a task.

    `accepted` says that the language is known and its posterior at least `least`.
    Defined cases: a null, empty or wordless text is 'und', not accepted, whatever
    surrounds it; a null or unknown declaration says nothing; a null host has the
    prior of its parent; a single row decides for itself; ties go to the language
    first in the alphabet; repeated rows are answered each; extra columns unread.
    """
    scratch = Scratch(docs.sparkSession, "language")
    kind = docs.schema[id_col].dataType.simpleString()
    names = [*model.languages, UNKNOWN]
    size = len(names)
    levels = [f"host{k}" for k in range(len(host_levels or []))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in split_batches(batches, "t", 1_000_000):
            ll, n = model.log_likelihoods(b.column("t"))
            ll = ll * np.minimum(n, EVIDENCE)[:, None]
            ll -= ll.max(axis=1, keepdims=True)
            rows = pa.FixedSizeListArray.from_arrays(pa.array(ll.ravel()), size).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(n), rows, *(b.column(c) for c in ("text_hash", "declared", *levels))], ["id", "n", "ll", "text_hash", "declared", *levels])

    base = [F.log(F.lit((1 - UNKNOWN_PRIOR) / (size - 1) if k < size - 1 else UNKNOWN_PRIOR)) for k in range(size)]
    said = F.lit(None).cast("string") if declared is None else F.when(F.lower(declared).isin(list(model.languages)), F.lower(declared))
    cols = [F.col(id_col).alias("id"), F.col(text_col).alias("t"), F.xxhash64(text_col).alias("text_hash"), said.alias("declared"), *(c.cast("string").alias(n) for c, n in zip(host_levels or [], levels, strict=True))]
    schema = f"id {kind}, n bigint, ll array<double>, text_hash bigint, declared string" + "".join(f", {c} string" for c in levels)
    rows = docs.select(*cols).mapInArrow(run, schema)

    def together(*logs) -> Column:
        return F.array(*[sum((a[k] for a in logs[1:]), logs[0][k]) for k in range(size)])

    def mass(logs: Column) -> Column:
        return F.aggregate(F.transform(logs, lambda x: F.exp(x - F.array_max(logs))), F.lit(0.0), lambda a, x: a + x)

    text = [F.col("ll")[k] for k in range(size)]
    alone = together(text, base)
    rows = scratch.table(rows.withColumn("p", F.when(F.col("n") > 0, F.transform(alone, lambda x: F.exp(x - F.array_max(alone)) / mass(alone)))), "likelihoods")
    sums = [F.coalesce(F.sum(F.col("p")[k]), F.lit(0.0)).alias(f"s{k}") for k in range(size)]

    total = rows.filter("n > 0").agg(*sums).first()
    weight = sum(total) + size
    parent = [F.lit((v + 1.0) / weight) for v in total]
    fused = [text]
    if declared is not None:
        told = {r["declared"]: r for r in rows.filter("n > 0 and declared is not null").groupBy("declared").agg(*sums).collect()}
        of = [sum(r[f"s{k}"] for r in told.values()) for k in range(size)]
        likely = [F.lit(0.0) for _ in range(size)]
        for d in model.languages:
            for k in range(size):
                p = ((told[d][f"s{k}"] if d in told else 0.0) + 0.5) / (of[k] + 0.5 * len(model.languages))
                likely[k] = F.when(F.col("declared") == d, F.log(F.lit(p))).otherwise(likely[k])
        fused.append(likely)
    found = rows
    if levels:
        finest = rows.filter("n > 0").groupBy(*levels).agg(*sums)
        prior = finest.select(*levels).distinct()
        for j, _ in enumerate(levels):
            keys = levels[: j + 1]
            part = finest.groupBy(*keys).agg(*[F.sum(f"s{k}").alias(f"t{k}") for k in range(size)])
            on = [prior[c].eqNullSafe(part[c]) for c in keys]
            volume = sum((F.col(f"t{k}") for k in range(1, size)), F.col("t0")) + PARENT
            new = [F.when(prior[keys[-1]].isNull(), parent[k]).otherwise((F.col(f"t{k}") + PARENT * parent[k]) / volume).alias(f"q{k}") for k in range(size)]
            prior = prior.join(part, on).select(*[prior[c] for c in levels], *new)
            parent = [F.col(f"q{k}") for k in range(size)]
        prior = prior.select(*[F.col(c).alias(f"_{c}") for c in levels], *[f"q{k}" for k in range(size)])
        found = rows.join(prior, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in levels], "left")
        parent = [F.coalesce(F.col(f"q{k}"), F.lit((v + 1.0) / weight)) for k, v in enumerate(total)]
    fused.append([F.log(x) for x in parent])

    names_column = F.array(*[F.lit(x) for x in names])
    label = lambda logs: F.element_at(names_column, F.array_position(logs, F.array_max(logs)).cast("int"))
    empty, logs = F.col("n") == 0, F.col("logs")
    out = found.withColumn("logs", together(*fused)).select(
        F.col("id").alias(id_col),
        F.when(empty, UNKNOWN).otherwise(label(logs)).alias("language"),
        F.when(empty, F.lit(0.0)).otherwise(1 / mass(logs)).alias("confidence"),
        F.when(empty, UNKNOWN).otherwise(label(F.col("p"))).alias("text_language"),
        "text_hash",
    )
    return out.withColumn("accepted", (F.col("language") != UNKNOWN) & (F.col("confidence") >= least))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> TextModel:
    """The text model of a bounded sample of labelled rows; without any, only 'und' is known."""
    rows = training_rows(docs, id_col, text_col, label_col).orderBy("t", "y").collect()
    return train_text_model([(r["t"], r["y"]) for r in rows])
