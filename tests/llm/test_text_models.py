import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from feedlake.llm import language_id, mixing, toxicity
from feedlake.llm.queries import held_out, identified
from feedlake.llm.subword import gram_buckets, joined


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    scored = toxicity.score_toxicity(docs, labels.filter(~held_out()))
    rows = scored.join(labels.filter(held_out()), "doc_id").select("score", "toxic").toPandas()
    pos, neg = rows[rows.toxic == 1].score.to_numpy(), rows[rows.toxic == 0].score.to_numpy()
    assert (pos[:, None] > neg[None, :]).mean() > 0.75
    assert (neg >= 0.7).mean() < 0.1


def test_toxicity_edges(spark, docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (8, 0), (10, 0), (None, 1), (77, 1)], "doc_id bigint, toxic int")
    for some in (labels, labels.limit(0), labels.filter("toxic = 0")):
        got = toxicity.score_toxicity(docs, some).collect()
        assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score_toxicity(docs.limit(0), labels).count() == 0


def test_misspellings_share_vectors():
    clean = [f"this is a plain sentence about item number {k} and nothing else" for k in range(60)]
    bad = [f"you are a worthless person said item {k} to nobody" for k in range(60)]
    model = toxicity.train(clean + bad, np.array([0] * 60 + [1] * 60))
    s = model.scores(pa.array(["such a worthles thing", "such a plain thing"]))
    assert s[0] > s[1]


def test_scores_equal_a_plain_forward_pass():
    rng = np.random.default_rng(5)
    model = toxicity.Model(rng.normal(size=toxicity.BUCKETS).astype(np.float32), -0.3, 0.02)
    texts = ["You are Dumb!", "one", "", " -- ", "Grüße an d0ct0r house and a very long wordthatneverends", None]

    def word_mean(word):
        data, _ = joined(pa.array([word], pa.large_string()))
        buckets = [b for _, grams in gram_buckets(data, toxicity.SIZES, toxicity.BUCKETS - 1) for b in grams]
        return sum(float(model.value[b]) for b in buckets) / max(len(buckets), 1)

    want = []
    for t in texts:
        means = [word_mean(w) for w in re.findall("[0-9a-zA-Z\u0080-\uffff]+", t or "")]
        size = min(toxicity.BAG, len(means))
        bags = [sum(means[k : k + size]) / size for k in range(len(means) - size + 1)] if means else []
        want.append(1 / (1 + np.exp(-(max(bags) + model.bias))) if bags else model.empty)
    assert np.allclose(model.scores(pa.array(texts, pa.large_string())), want, atol=1e-6)


def test_training_sample_replaces_long_texts_and_takes_one_text_for_an_id(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TRAIN_CHARS", 10)
    monkeypatch.setattr(toxicity, "TRAIN_CLEAN", 5)
    docs = spark.createDataFrame([(k, "x" * 20 if k < 40 else f"t{k}") for k in range(50)] + [(45, f"again{k}") for k in range(30)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, 0) for k in range(50)], "doc_id bigint, toxic int")
    rows = toxicity.training_rows(docs, labels).collect()
    assert len(rows) == 5 and all(len(r["t"]) <= 10 for r in rows)
    monkeypatch.setattr(toxicity, "TRAIN_CLEAN", 50)
    assert len(toxicity.training_rows(docs, labels).collect()) == 10


def test_language_accuracy_and_rejects(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = identified(docs).join(docs.select("doc_id", "lang"), "doc_id").select("language", "lang", "accepted").toPandas()
    assert (rows.language == rows.lang).mean() > 0.98
    assert rows.accepted.mean() > 0.98


def test_language_edges(spark, docs):
    model = language_id.fit(docs)
    got = language_id.identify(docs, model, declared=F.col("lang"), host_levels=[F.col("lang"), F.col("source")]).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == docs.count()
    assert all(by[i]["language"] == "und" and not by[i]["accepted"] for i in (4, 5, 6))
    assert language_id.identify(docs.limit(0), model).count() == 0
    assert language_id.identify(docs, language_id.fit(docs.limit(0))).filter("accepted").count() == 0


def test_host_prior_decides_short_texts(spark):
    model = language_id.train_text_model([("the and of this that with " * 5, "en"), ("der und die das mit nicht " * 5, "de")])
    rows = [(k, "der und die das mit", "h1") for k in range(50)] + [(90, "in", "h1"), (91, "the and of this", "h2"), (92, "in", "h2")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, host string")
    got = {r["doc_id"]: r["language"] for r in language_id.identify(docs, model, host_levels=[F.col("host")]).collect()}
    assert got[90] == "de" and got[91] == "en"


def replay(p, steps):
    r = np.ones(len(p))
    for s in steps:
        r = np.maximum(0, r + p @ s)
    return r


def test_mixing_meets_its_targets(spark):
    rng = np.random.default_rng(3)
    kinds = {"a": "apple pear plum", "b": "bolt nut screw", "c": "cello violin drum"}
    rows, labels = [], []
    for k in range(300):
        kind = "abc"[min(int(rng.exponential(0.8)), 2)]
        rows.append((k, " ".join(rng.choice(kinds[kind].split(), 30))))
        labels.append((k, kind))
    docs, labelled = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels[:150], "doc_id bigint, domain string")
    targets = {"a": 0.2, "b": 0.5, "c": 0.3}
    out = mixing.mix(docs, mixing.fit_domains(docs, labelled), targets).toPandas()
    p, tokens = out[["p_a", "p_b", "p_c"]].to_numpy(), out.tokens.to_numpy()
    shares = (p * (tokens * out.rate.to_numpy())[:, None]).sum(axis=0) / tokens.sum()
    assert np.abs(shares - [0.2, 0.5, 0.3]).max() < 0.01
    assert (out.rate >= 0).all() and np.abs(out.copies - out.rate).max() <= 1
    cells = spark.createDataFrame([(0.9, 0.1, 5), (0.1, 0.9, 20)], "p0 double, p1 double, tokens bigint")
    steps, reached = mixing.solve_rates(cells, ("x", "y"), {"x": 0.6, "y": 0.4})
    r = replay(np.array([[0.9, 0.1], [0.1, 0.9]]), steps)
    want = (np.array([[0.9, 0.1], [0.1, 0.9]]) * (r * [5, 20])[:, None]).sum(axis=0) / 25
    assert np.allclose(want, reached, atol=1e-6)


def test_mixing_edges(spark, docs):
    labelled = spark.createDataFrame([(1, "x"), (10, "y"), (None, "z"), (5, None)], "doc_id bigint, domain string")
    for some in (labelled, labelled.limit(0)):
        got = mixing.mix(docs, mixing.fit_domains(docs, some), {"x": 0.5, "y": 0.5}).collect()
        assert len(got) == docs.count() and all(r["rate"] >= 0 for r in got)
    assert mixing.mix(docs.limit(0), mixing.fit_domains(docs, labelled), {"x": 1.0}).count() == 0


def test_every_labelled_language_has_a_model(spark):
    rows = [(k, "the and of this that with", "en") for k in range(7000)] + [(7, "the and of this that with", "en")] * 4000
    rows += [(9000 + k, "der und die das mit nicht", "de") for k in range(2)] + [(9100 + k, "och att det som en " * 2000, "sv") for k in range(2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    sample = language_id.training_rows(docs, "doc_id", "text", "lang").groupBy("y").count().collect()
    assert {r["y"]: r["count"] for r in sample} == {"en": 1000, "de": 2, "sv": 2}
    got = language_id.identify(docs.filter("doc_id >= 9000"), language_id.fit(docs)).collect()
    assert all(r["text_language"] == ("de" if r["doc_id"] < 9100 else "sv") for r in got)


def test_rates_are_those_of_a_plain_solution(spark):
    rng = np.random.default_rng(3)
    p = rng.dirichlet([0.3, 0.2, 0.1], size=400)
    tokens = rng.integers(1, 500, 400)
    want = np.array([0.04, 0.06, 0.9])
    lam = np.zeros(3)
    for _ in range(60_000):
        gap = (tokens * np.maximum(0, 1 + p @ lam)) @ p / tokens.sum() - want
        lam -= 2.0 * gap
    assert np.abs(gap).max() < 1e-6 and (1 + p @ lam < 0).any()
    cells = spark.createDataFrame([(*map(float, a), int(n)) for a, n in zip(p, tokens, strict=True)], "p0 double, p1 double, p2 double, tokens bigint")
    steps, shares = mixing.solve_rates(cells, ("a", "b", "c"), dict(zip("abc", want, strict=True)))
    rates = np.array([r[0] for r in cells.select(mixing.rate_of([F.col(f"p{k}") for k in range(3)], steps)).collect()])
    assert np.abs(shares - want).max() < 1e-6 and len(steps) < 40 and rates.min() == 0
    assert np.abs((tokens * rates) @ p / tokens.sum() - want).max() < 1e-6
    none, kept = mixing.solve_rates(cells, ("a", "b", "c", "d")[:3], {"a": 1.0})
    assert kept[0] > 0.9 and kept.sum() < 1.1
