import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlake.llm import divergence
from feedlake.llm.queries import ORACLES, QUERIES


def brute(rows, least, most):
    """(lang, source, text) by the definition, in whole numbers of any size."""
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    counts, langs, seen, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(lower))
        groups.add((lang, source))
        counts[lang, source].update(terms)
        langs[lang].update(terms)
        seen[lang].update(set(terms))
    out = set()
    for lang, source in groups:
        kept = [t for t, n in seen[lang].items() if n >= least]
        p = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c[x] for x in kept) + 2 * len(kept)) for t in kept}
        own, all_ = p(counts[lang, source]), p(langs[lang])
        f = lambda a, b: (a - b) ** 2 // (a + b)
        pairs = [(-sum(f(own[t], other[t]) for t in kept), s.encode()) for s in sorted(s for x, s in groups if x == lang and s != source) for other in [p(counts[lang, s])]]
        terms = [(-f(own[t], all_[t]), t.encode()) for t in kept if counts[lang, source][t] and own[t] > all_[t]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:most])):
            out |= {(lang, source, part, item.decode(), -v, k) for k, (v, item) in enumerate(found, 1)}
    return out


def test_against_brute_force(spark):
    rng = random.Random(5)
    words = [f"{a}{b}" for a in "aAbé日ſ" for b in ("", "x", "Y", "zz", "ü")]
    rows = [(rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "é", None, "C"]), rng.choice([" ", "1", "\n", "_"]).join(rng.choice(words) for _ in range(rng.randint(0, 30)))) for _ in range(150)]
    rows += [("fr", "a", "one two"), ("fr", "b", None), ("it", "a", ""), ("en", "empty", None)] + [("xx", "a", "same word here")] * 12
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(5)
    got = divergence.source_divergence(df, least=4, most=3)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, 4, 3)


def test_blocks_of_sources_and_terms(spark, monkeypatch):
    monkeypatch.setattr(divergence, "SOURCES", 3)
    monkeypatch.setattr(divergence, "TERMS", 4)
    monkeypatch.setattr(divergence, "COUNTERS", 20)
    monkeypatch.setattr(divergence, "RETAINED", 5)
    rng = random.Random(6)
    rows = [("en", f"s{rng.randint(0, 10)}", " ".join(rng.choice("abcdefghij") * rng.randint(1, 2) for _ in range(20))) for _ in range(80)]
    got = divergence.source_divergence(spark.createDataFrame(rows, "lang string, source string, text string"), least=2, most=4)
    assert {tuple(r) for r in got.collect()} == brute(rows, 2, 4)


def test_skyband_keeps_whoever_has_fewer_dominators():
    rng = np.random.default_rng(0)
    for size, k in ((0, 3), (1, 1), (700, 1), (700, 5)):
        n, low, term = rng.integers(0, 12, size), rng.integers(0, 12, size), np.array([f"t{x:03d}" for x in rng.permutation(size)], object)
        over = [sum((n[j] >= n[i]) and (low[j] <= low[i]) and (term[j] < term[i]) for j in range(size)) for i in range(size)]
        assert sorted(divergence.skyband(n, low, term, k)) == [i for i in range(size) if over[i] < k]


def test_shares_of_large_counts_are_exact(spark):
    cases = [(0, 1), (10**15, 9 * 10**15), (123_456_789_012, 987_654_321_098_765), (7, 10**9 + 7), (10**15, 10**15 + 2)]
    want = [1 + 10**9 * (n + 2) // (t + 2) for n, t in cases]
    df = spark.createDataFrame([(n, t + 2) for n, t in cases], "n bigint, t bigint")
    assert [r[0] for r in df.select(divergence.share(F.col("n"), F.col("t"))).collect()] == want
    assert divergence._shares(np.array([n for n, _ in cases]), np.array([t + 2 for _, t in cases])).tolist() == want


def test_edge_rows_and_columns(docs):
    rows = [(r["lang"], r["source"], r["text"]) for r in docs.collect()]
    assert {tuple(r) for r in divergence.source_divergence(docs, least=2).collect()} == brute(rows, 2, 10)
    assert divergence.source_divergence(docs.limit(0)).count() == 0


@pytest.mark.parametrize("table, name", [("documents", "op11_source_divergence")])
def test_query_against_sql(spark, sf, table, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    got = QUERIES[name](spark, sf)
    want = con.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(map(repr, (tuple(r[n] for n in names) for r in got.collect()))) == sorted(map(repr, want.fetchall()))
