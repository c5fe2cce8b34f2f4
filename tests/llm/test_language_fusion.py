"""Language identification against the same fusion in plain Python, on written rows and on the pages."""

import math
import re
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feedlake.llm import language_id as L
from feedlake.llm.queries import language_id_pages
from feedlake.llm.subword import gram_buckets, joined


def likelihoods(model, text):
    """(mean log likelihoods, number of trigrams), word by word."""
    buckets = []
    for word in re.findall("[a-zA-Z\u0080-\U0010ffff]+", text or ""):
        data, _ = joined(pa.array([word], pa.large_string()))
        buckets += [b for _, grams in gram_buckets(data, range(3, 4), L.BUCKETS - 1) for b in grams]
    columns = range(model.table.shape[1])
    return [sum(float(model.table[b, k]) for b in buckets) / max(len(buckets), 1) for k in columns], len(buckets)


def softmax(logs):
    raw = [math.exp(x - max(logs)) for x in logs]
    return [x / sum(raw) for x in raw]


def fused(model, rows, declares=True):
    """[(language, confidence)] of rows (text, declared, hosts from coarse to fine)."""
    names = [*model.languages, L.UNKNOWN]
    size = len(names)
    base = [math.log((1 - L.UNKNOWN_PRIOR) / (size - 1))] * (size - 1) + [math.log(L.UNKNOWN_PRIOR)]
    texts, p = [], []
    for text, _, _ in rows:
        mean, n = likelihoods(model, text)
        texts.append(([x * min(n, L.EVIDENCE) for x in mean], n))
        p.append(softmax([a + b for a, b in zip(texts[-1][0], base, strict=True)]) if n else [0.0] * size)
    total = [sum(c) for c in zip(*p, strict=True)]
    told, under = defaultdict(lambda: [0.0] * size), defaultdict(lambda: [0.0] * size)
    for (_, declared, hosts), q in zip(rows, p, strict=True):
        if (declared or "").lower() in model.languages:
            told[declared.lower()] = [a + b for a, b in zip(told[declared.lower()], q, strict=True)]
        for j in range(len(hosts)):
            under[hosts[: j + 1]] = [a + b for a, b in zip(under[hosts[: j + 1]], q, strict=True)]
    out = []
    for (_, declared, hosts), (logs, n) in zip(rows, texts, strict=True):
        prior = [(x + 1) / (sum(total) + size) for x in total]
        for j in range(len(hosts)):
            if hosts[j] is not None:
                t = under[hosts[: j + 1]]
                prior = [(t[k] + L.PARENT * prior[k]) / (sum(t) + L.PARENT) for k in range(size)]
        logs = [a + math.log(b) for a, b in zip(logs, prior, strict=True)]
        if declares and (declared or "").lower() in model.languages:
            of = [sum(t[k] for t in told.values()) for k in range(size)]
            logs = [x + math.log((told[declared.lower()][k] + 0.5) / (of[k] + 0.5 * (size - 1))) for k, x in enumerate(logs)]
        best = softmax(logs)
        out.append((names[best.index(max(best))], max(best)) if n else (L.UNKNOWN, 0.0))
    return out


def same(got, want):
    assert len(got) == len(want)
    for r, (language, confidence) in zip(got, want, strict=True):
        assert r["confidence"] == pytest.approx(confidence, abs=1e-6)
        assert r["language"] == language and r["accepted"] == (language != L.UNKNOWN and confidence >= 0.5)


TEXTS = {
    "en": "the and of this that with from have are was for".split(),
    "de": "der und die das mit nicht ist ein von auf für".split(),
    "sv": "och att det som en är på inte jag för".split(),
}


def test_four_kinds_of_evidence_against_plain_python(spark):
    model = L.train_text_model([(" ".join(words[k % 7 :] + words), y) for y, words in TEXTS.items() for k in range(20)])
    rows = []
    for k in range(240):
        y = ("en", "de", "de", "sv")[k % 4]
        text = " ".join(TEXTS[y][(k * j) % 10] for j in range(1 + k % 9))
        declared = (y.upper(), None, "en", "xx", "", "de")[k % 6]
        suffix = (None, "de", "se", "org")[k % 4 if k % 11 else 3]
        host = None if k % 5 == 0 else f"h{k % 3}.{suffix}"
        rows.append((text, declared, (suffix, host)))
    rows += [(None, "en", ("org", "a")), ("", None, (None, None)), (" 12 -- ", "de", ("de", "b")), ("für", None, ("de", "only")), ("für", None, ("se", "only")), ("in", "sv", (None, "only"))]
    rows += [("of that " * 3000, "de", ("de", "h1.de")), ("qqxzw kjjqv zzxqw", "en", ("org", None)), *[("det som", "sv", ("se", "h2.se"))] * 30]
    clash = "'x' AS n, 'x' AS ll, 'x' AS p, 'x' AS q0, 'x' AS s0, 'x' AS t0, 'x' AS logs, 'x' AS id, 'x' AS host0, 'x' AS language, 'x' AS text_hash"
    docs = spark.createDataFrame([(k, t, d, *h) for k, (t, d, h) in enumerate(rows)], "doc_id bigint, text string, said string, suffix string, host string")
    docs = docs.selectExpr("*", *clash.split(", ")).repartition(5)
    got = L.identify(docs, model, declared=F.col("said"), host_levels=[F.col("suffix"), F.col("host")]).orderBy("doc_id").collect()
    want = fused(model, rows)
    same(got, want)
    assert {x for x, _ in want} >= {"en", "de", "sv", L.UNKNOWN}
    assert any(a[0] != b[0] for a, b in zip(want, fused(model, rows, declares=False), strict=True))
    got = L.identify(docs, model, host_levels=[F.col("host")]).orderBy("doc_id").collect()
    same(got, fused(model, [(t, None, h[1:]) for t, _, h in rows]))


def test_pages_against_plain_python(spark, sf):
    rows = []
    pages = spark.read.parquet(f"{sf}/pages.parquet").orderBy("page_id").collect()
    for r in pages:
        rest = r["url"].split("://", 1)[1] if "://" in (r["url"] or "") else ""
        host = re.split("[/?#]", rest)[0].translate({c: c + 32 for c in range(65, 91)})
        declared = re.search(r"<html[^>]*\slang=[\"']?([A-Za-z]+)", r["html"] or "", re.A)
        body = re.sub(r"<(script|style)\b.*?</\1>", " ", r["html"] or "", flags=re.S | re.A)
        rows.append((re.sub(r"<[^>]*>|&[a-z]+;", " ", body), declared and declared[1], (host.split(".")[-1], host)))
    model = L.fit(spark.read.parquet(f"{sf}/documents.parquet"))
    got = language_id_pages(spark, sf).orderBy("page_id").collect()
    assert [r["page_id"] for r in got] == [r["page_id"] for r in pages]
    same(got, fused(model, rows))


def test_pages_without_markup_hosts_or_rows(spark, sf, tmp_path):
    english = "<html lang='en'><body>the and of this that with from have</body></html>"
    pages = [(1, None, None), (2, "no address", english), (3, "http://a.example.org/x", ""), (4, "http://a.example.org/y", "<script>the and of</script>"), (None, "HTTP://A.example.org", english), (5, "http://b", english), (5, "http://b", english)]
    some = spark.createDataFrame(pages, "page_id bigint, url string, html string").selectExpr("*", "'x' AS text", "'x' AS host", "'x' AS suffix", "'x' AS declared")
    spark.read.parquet(f"{sf}/documents.parquet").write.parquet(f"{tmp_path}/documents.parquet")
    some.write.parquet(f"{tmp_path}/pages.parquet")
    got = language_id_pages(spark, str(tmp_path)).collect()
    assert len(got) == 7 and {r["page_id"] for r in got if r["language"] == L.UNKNOWN} == {1, 3, 4}
    some.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/pages.parquet")
    assert language_id_pages(spark, str(tmp_path)).count() == 0
