"""Toxicity: subword-bag embeddings averaged into a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches
from .encode import split_batches
from .subword import gram_buckets, joined, word_spans

#: n-gram sizes with the blanks at a word's ends, number of buckets, embedding size, words in a bag.
SIZES, BUCKETS, WIDTH, BAG = range(3, 8), 1 << 17, 8, 2
#: Step sizes of embeddings and softmax, share of the largest gradient in every step's scale, and weight of the toxic class in the loss.
RATE, SOFT_RATE, FLOOR, TOXIC_WEIGHT = 2.0, 0.05, 0.02, 0.4
#: Most training rows of each class, and the longest text used for training.
TRAIN_TOXIC, TRAIN_CLEAN, TRAIN_CHARS = 800, 1200, 4000


def _words(texts: pa.Array) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, np.ndarray, np.ndarray]:
    """(n-grams as (start, bucket) for each size, word starts, word ends, index of each text's first word)."""
    data, cuts = joined(texts)
    data, starts, ends = word_spans(data)
    return gram_buckets(data, SIZES, BUCKETS - 1), starts, ends, np.searchsorted(starts, cuts)


def _owner(at: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The word of each n-gram: its second byte lies in the word."""
    return np.searchsorted(starts, at + 1, "right") - 1


def _bags(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(largest mean over BAG neighbouring words of each text, first word of that bag; -1 for texts without words)."""
    sums = np.concatenate([[0.0], np.cumsum(values)])
    best, where = np.zeros(len(first) - 1), np.full(len(first) - 1, -1)
    for k in range(len(first) - 1):
        a, b = first[k], first[k + 1]
        if b > a:
            size = min(BAG, b - a)
            means = (sums[a + size : b + 1] - sums[a : b - size + 1]) / size
            where[k] = a + int(np.argmax(means))
            best[k] = means[where[k] - a]
    return best, where


@dataclass(frozen=True)
class Model:
    """value[bucket]: an n-gram's embedding times the difference of the softmax's two columns; bias; empty: score without words."""

    value: np.ndarray
    bias: float
    empty: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        grams, starts, ends, first = _words(texts)
        total = int(ends[-1]) + 2 if len(ends) else 1
        sums, counts = np.zeros(total), np.zeros(total, np.int32)
        for at, bucket in grams:
            sums[: len(at) and at[-1] + 1] += np.bincount(at, self.value[bucket], int(at[-1]) + 1 if len(at) else 0)
            counts[at] += 1
        cum, n = np.concatenate([[0.0], np.cumsum(sums)]), np.concatenate([[0], np.cumsum(counts)])
        low = np.maximum(starts - 1, 0)
        values = (cum[ends] - cum[low]) / np.maximum(n[ends] - n[low], 1)
        best, where = _bags(values, first)
        return np.where(where >= 0, 1 / (1 + np.exp(-np.clip(best + self.bias, -40, 40))), self.empty)


def train(texts: list[str], labels: np.ndarray, rounds: int = 80, seed: int = 1) -> Model:
    """Embeddings and softmax trained jointly by gradient descent on a bounded sample.

    Each step moves both by their gradients of one cross entropy: the embedding of
    an n-gram along the difference of the softmax's columns, these along the error's mean
    embedding. A text's bag is at first all its words, then the BAG neighbouring words that the
    model so far finds most toxic, so that a single phrase in a long text can be
    learned from a label of the whole. Steps are scaled by the past gradients of each
    embedding and by a share of the largest, so that n-grams seen in few texts hardly move.
    One class only: a constant score.
    """
    labels = np.asarray(labels, float)
    rate = float(labels.mean()) if len(labels) else 0.0
    if not 0 < rate < 1:
        return Model(np.zeros(BUCKETS, np.float32), float(np.log((rate + 1e-3) / (1 - rate + 1e-3))), rate)
    grams, starts, _, first = _words(pa.array(texts, pa.large_string()))
    gram = np.concatenate([b for _, b in grams])
    word = np.concatenate([_owner(at, starts).astype(np.int32) for at, _ in grams])
    del grams
    per_word = np.maximum(np.bincount(word, minlength=len(starts)), 1)
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 0.01, (BUCKETS, WIDTH)).astype(np.float32)
    w = rng.normal(0, 0.3, (2, WIDTH))
    bias, past, soft_past = np.zeros(2), np.zeros(BUCKETS), np.zeros((2, WIDTH))
    text_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    length = np.maximum(np.diff(first), 1)
    weight = np.where(labels == 1, TOXIC_WEIGHT / labels.sum(), (1 - TOXIC_WEIGHT) / (1 - labels).sum())
    for step in range(rounds):
        value = e @ (w[1] - w[0]).astype(np.float32)
        values = np.bincount(word, value[gram], len(starts)) / per_word
        if step < rounds // 4:
            mean = np.bincount(text_of, values, len(length)) / length
            share = 1.0 / length[text_of]
        else:
            mean, where = _bags(values, first)
            share = np.zeros(len(starts))
            for k in np.flatnonzero(where >= 0):
                size = min(BAG, length[k])
                share[where[k] : where[k] + size] = 1.0 / size
        p = 1 / (1 + np.exp(-np.clip(mean + bias[1] - bias[0], -40, 40)))
        error = weight * (p - labels)
        g = np.bincount(gram, (share * error[text_of] / per_word)[word], BUCKETS)
        direction = w[1] - w[0]
        soft = np.stack([-(g @ e), g @ e])
        past += g * g * (direction @ direction)
        soft_past += soft * soft
        root = np.sqrt(past)
        e -= np.outer(RATE * g / (root + FLOOR * max(float(root.max()), 1e-12)), direction).astype(np.float32)
        w -= SOFT_RATE * soft / np.sqrt(soft_past + 1e-12)
        bias += np.array([1, -1]) * 2.0 * error.sum()
    value = e @ (w[1] - w[0]).astype(np.float32)
    return Model(value, float(bias[1] - bias[0]), float(min(0.05, rate)))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(text, label) of a bounded sample of labelled rows: the smallest hashes of each class.

    Ids with a text of at most TRAIN_CHARS characters are sampled, so that long texts
    are replaced in training (they are scored whole). At most TRAIN_TOXIC + TRAIN_CLEAN ids are
    broadcast, and an id gives one text, however often it is repeated.
    """
    texts = docs.select(id_col, F.col(text_col).alias("t")).filter(F.length("t") <= TRAIN_CHARS)
    one = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).alias("y"))
    one = one.join(texts.select(id_col), id_col, "left_semi")
    picked = None
    for y, n in ((1, TRAIN_TOXIC), (0, TRAIN_CLEAN)):
        part = one.filter(F.col("y") == y).orderBy(F.xxhash64(id_col), id_col).limit(n)
        picked = part if picked is None else picked.unionByName(part)
    return texts.join(F.broadcast(picked), id_col).groupBy(id_col).agg(F.min("t").alias("t"), F.min("y").alias("y")).select("t", "y")


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """(id_col, score, predicted) of every whole text, from the labelled rows in `labels` (id_col, toxic).

    The model is fitted on the driver from a bounded sample and sent to the tasks
    (half a megabyte). Null texts count as empty; a text without words gets a low
    constant score; rows that repeat get the same score each; without labels of
    both classes every text gets the share of toxic labels.
    """
    bound_batches(docs.sparkSession)
    rows = training_rows(docs, labels, id_col, text_col).orderBy("t", "y").collect()
    model = train([r["t"] for r in rows], np.array([r["y"] for r in rows]))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in split_batches(batches, "t", 4_000_000):
            s = model.scores(b.column("t"))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["id", "score", "predicted"])

    scored = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(run, f"id {kind}, score double, predicted int")
    return scored.withColumnRenamed("id", id_col)
