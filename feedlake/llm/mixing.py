"""Mixing to target weights: soft domain membership and rates by projected-gradient least squares.

Everything here is DataFrame expressions; no Python runs on the executors.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, whole_text

#: Buckets of hashed words, most training rows (shared by the domains), words that a text counts for at most, and steps between 0 and 1 of a cell.
BUCKETS, TRAIN_ROWS, EVIDENCE, GRID = 4096, 4000, 40.0, 50
#: Rounds of projected gradient at most, the distance of all shares from the targets at which they end, and the one that counts as met.
ROUNDS, ENOUGH, MET = 60, 1e-6, 1e-3
#: Domains at most.
MOST_DOMAINS = 16


def words_of(text: Column) -> Column:
    """Lower-cased words between white space; none of an empty text."""
    return F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def _adder(weights: Column):
    return lambda total, bucket: total + F.element_at(weights, bucket)


@dataclass(frozen=True)
class DomainModel:
    """Naive Bayes over hashed words: log prior and log P(bucket | domain), by domain."""

    domains: tuple[str, ...]
    prior: np.ndarray
    table: np.ndarray

    def log_odds(self, words: Column) -> list[Column]:
        """Log posterior odds of each domain to the first; words count by their mean, as EVIDENCE words at most."""
        count = F.size(words)
        logs: list[Column] = [F.lit(0.0)]
        buckets = F.transform(words, lambda w: _bucket(w) + 1)
        for k in range(1, len(self.domains)):
            odds = ",".join(f"{x:.4f}" for x in self.table[k] - self.table[0])
            weights = F.split(F.lit(odds), ",").cast("array<double>")
            total = F.aggregate(buckets, F.lit(0.0), _adder(weights))
            mean = F.when(count > 0, total / count * F.least(count, F.lit(EVIDENCE))).otherwise(0.0)
            logs.append(mean + float(self.prior[k] - self.prior[0]))
        return logs

    def posteriors(self, logs: list[Column]) -> list[Column]:
        """P(domain)."""
        top = F.greatest(*logs) if len(logs) > 1 else logs[0]
        raw = [F.exp(x - top) for x in logs]
        total = sum(raw[1:], raw[0])
        return [x / total for x in raw]


def fit_domains(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DomainModel:
    """Fit on `labelled` (id_col, domain): rows of the smallest id hashes, as many of each domain, TRAIN_ROWS in all, whole texts.

    Priors are of all labelled rows. Only ids of the sample are broadcast; what reaches the
    driver are counts by domain and bucket. There may be up to MOST_DOMAINS domains;
    without labelled rows there is one, 'all'.
    """
    known = labelled.filter(F.col(id_col).isNotNull() & F.col("domain").isNotNull()).groupBy(id_col).agg(F.min("domain").alias("domain"))
    known = Scratch(docs.sparkSession, "domains").table(known, "labelled")
    sizes = {r["domain"]: r["count"] for r in known.groupBy("domain").count().limit(MOST_DOMAINS + 1).collect()}
    if len(sizes) > MOST_DOMAINS:
        raise ValueError(f"more than {MOST_DOMAINS} domains")
    domains = tuple(sorted(sizes)) or ("all",)
    parts = [known.filter(F.col("domain") == d).orderBy(F.xxhash64(id_col), id_col).limit(TRAIN_ROWS // len(domains)) for d in domains]
    picked = reduce(DataFrame.unionByName, parts)
    rows = docs.select(id_col, whole_text(text_col).alias("t")).join(F.broadcast(picked), id_col).dropDuplicates([id_col])
    counts = np.full((len(domains), BUCKETS), 0.5)
    words = rows.select("domain", F.explode(words_of(F.col("t"))).alias("w"))
    for r in words.groupBy("domain", _bucket(F.col("w")).alias("b")).count().collect():
        counts[domains.index(r["domain"]), r["b"]] += r["count"]
    prior = np.log(np.array([sizes.get(d, 1) for d in domains], float))
    return DomainModel(domains, prior, np.log(counts) - np.log(counts.sum(axis=1, keepdims=True)))


def solve_rates(cells: DataFrame, domains: tuple[str, ...], targets: dict[str, float]) -> tuple[list[np.ndarray], np.ndarray]:
    """Steps whose replay gives each document's rate, and the shares reached.

    `cells` has p0, p1, ... (posteriors) and tokens. Minimised over rates r >= 0 is the
    weighted sum of (share of expected tokens - target)^2: each round adds up, over all cells,
    the tokens that the present rates expect in each domain and the moments of the posteriors
    where the rate isn't 0, and moves every rate against its gradient, scaled by these moments, not
    below 0. So rates that stay above 0 meet the targets at once, and a few rounds settle which
    do. A step is a vector with one number for each domain, so a rate is a function of a
    document's posteriors and the list of steps; rates are never written between rounds. A step that
    doesn't lower the objective is taken back and halved.
    """
    size = len(domains)
    want = np.array([max(targets.get(d, 0.0), 0.0) for d in domains])
    want = want / want.sum() if want.sum() > 0 else np.full(size, 1.0 / size)
    p = [F.col(f"p{k}") for k in range(size)]

    def sums(steps: list[np.ndarray]) -> tuple[float, np.ndarray, np.ndarray]:
        rows = cells.withColumn("r", rate_of(p, steps))
        shares = [F.sum(F.col("tokens") * F.col("r") * x) for x in p]
        moments = [F.sum(F.when(F.col("r") > 0, F.col("tokens") * x * y)) for x in p for y in p]
        first = rows.agg(F.sum("tokens").alias("n"), *shares, *moments).first()
        values = np.array([float(x or 0) for x in first])
        total = max(values[0], 1.0)
        return values[0], values[1 : size + 1] / total, values[size + 1 :].reshape(size, size) / total

    total, shares, moments = sums([])
    if total == 0:
        return [], np.zeros(size)
    weight, speed = 1 / np.maximum(shares, 1e-6), 1.0
    steps: list[np.ndarray] = []
    for _ in range(ROUNDS):
        if np.abs(shares - want).max() < ENOUGH or speed < 1e-6:
            break
        step = -speed * np.linalg.pinv(moments, rcond=1e-9, hermitian=True) @ (shares - want)
        _, new, less = sums([*steps, step])
        if (weight * (new - want) ** 2).sum() < (weight * (shares - want) ** 2).sum():
            steps.append(step)
            shares, moments, speed = new, less, min(1.0, speed * 2)
        else:
            speed /= 2
    return steps, shares


def rate_of(p: list[Column], steps: list[np.ndarray]) -> Column:
    """Replay: from 1, add each step weighted by the posteriors, never below 0."""
    if not steps:
        return F.lit(1.0)
    rows = F.split(F.lit(";".join(",".join(f"{x:.12g}" for x in s) for s in steps)), ";")
    parsed = F.transform(rows, lambda s: F.split(s, ",").cast("array<double>"))
    move = lambda s: sum((s[k] * p[k] for k in range(1, len(p))), s[0] * p[0])
    return F.aggregate(parsed, F.lit(1.0), lambda r, s: F.greatest(F.lit(0.0), r + move(s)))


def mix(docs: DataFrame, model: DomainModel, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text", seed: int = 0, whole: bool = False) -> DataFrame:
    """(id_col, tokens, p_<domain> ..., rate, copies, share_<domain> ...) of every row; with `whole` also `row`, a struct of all its columns.

    Rates make the expected tokens of the domains match `targets` (shares, made to
    add up to 1) at the corpus's own total. `copies` rounds a rate up or down by the
    hash of id and seed, with the rate as its mean: 0 leaves a document out.

    Tokens are words between white space. For the rounds, documents fall into a
    bounded number of cells (posteriors rounded to 1 / GRID), and a cell has the mean
    posteriors of its tokens, so a round reads cells, whatever the corpus's size;
    cells are summed in each task first, so a source that holds a third of all rows is
    a handful of rows in the shuffle. Each document's rate follows from its own
    posteriors. share_<domain> is the share that the rates reach in the cells; where one is further than
    MET from its target, as that of a domain without documents, there is a warning too.

    Defined cases: null and empty texts have no words, the prior's posteriors and a
    rate like any other; without tokens every rate is 1; a domain that no document
    reaches keeps its deficit; targets of unknown domains count as 0; null ids are
    hashed as such; repeated rows get the same rate each; other columns unread.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    size = len(model.domains)
    row = [F.struct(*[docs[c] for c in docs.columns]).alias("row")] if whole else []
    words = docs.select(F.col(id_col).alias("id"), words_of(whole_text(text_col)).alias("w"), *row)
    row = ["row"] if whole else []
    scored = words.select("id", F.size("w").cast("bigint").alias("tokens"), F.array(*model.log_odds(F.col("w"))).alias("l"), *row)
    scored = scored.select("id", "tokens", *[x.alias(f"p{k}") for k, x in enumerate(model.posteriors([F.col("l")[k] for k in range(size)]))], *row)
    scored = scratch.table(scored, "scored")
    grid = [F.round(F.col(f"p{k}") * GRID).alias(f"c{k}") for k in range(size)]
    means = [(F.sum(F.col("tokens") * F.col(f"p{k}")) / F.sum("tokens")).alias(f"p{k}") for k in range(size)]
    cells = scratch.table(scored.filter("tokens > 0").groupBy(*grid).agg(F.sum("tokens").alias("tokens"), *means), "cells")
    steps, shares = solve_rates(cells, model.domains, targets)
    total = sum(max(x, 0) for x in targets.values())
    if total > 0 and any(abs(max(targets.get(d, 0), 0) / total - x) > MET for d, x in zip(model.domains, shares, strict=True)):
        warnings.warn(f"the targets are not met, the shares reached are {dict(zip(model.domains, shares.round(4).tolist(), strict=True))}", stacklevel=2)
    u = F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(1 << 40)) / float(1 << 40)
    rated = scored.withColumn("rate", rate_of([F.col(f"p{k}") for k in range(size)], steps))
    return rated.select(
        F.col("id").alias(id_col),
        "tokens",
        *[F.col(f"p{k}").alias(f"p_{d}") for k, d in enumerate(model.domains)],
        "rate",
        (F.floor("rate") + (u < F.col("rate") - F.floor("rate")).cast("int")).cast("int").alias("copies"),
        *[F.lit(float(x)).alias(f"share_{d}") for d, x in zip(model.domains, shares, strict=True)],
        *row,
    )


def label_domains(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id_col, domain) of a table of labels quality and toxic: good, poor or toxic."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    return labels.select(id_col, domain.alias("domain"))
