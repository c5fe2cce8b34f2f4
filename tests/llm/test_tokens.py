import zlib

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from feedlake.llm import packing, token_counts
from feedlake.llm.encode import Encoder
from feedlake.llm.queries import TOKENIZER


def test_encoder_agrees_with_the_tokenizer(spark, sf):
    texts = [r[0] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").limit(60).collect()]
    texts += ["", None, "a  b", "a \n b", " x", "x ", "\n\n x y", "  ", "café 日本 x", "<|endoftext|> a b", "a b", "it's  'll d' a\tb \r\n c", "a\x00b c", "x \t y"]
    tokenizer, encoder = Tokenizer.from_file(TOKENIZER), Encoder(TOKENIZER)
    for _ in range(2):
        ids, cuts = encoder.batch(pa.array(texts))
        for k, t in enumerate(texts):
            assert ids[cuts[k] : cuts[k + 1]].tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids


def test_suffix_sums(docs):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    lengths = [len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) for r in docs.collect()]
    sums = token_counts.suffix_sums(token_counts.length_histogram(token_counts.token_lengths(docs, TOKENIZER)))
    for r in sums.collect():
        n = r["n_tokens"]
        assert r["n_docs"] == lengths.count(n)
        assert r["docs_at_least"] == sum(x >= n for x in lengths)
        assert r["tokens_at_least"] == sum(x for x in lengths if x >= n)
        assert r["docs_at_most"] == sum(x <= n for x in lengths)
        assert r["truncated_total"] == sum(min(x, n) for x in lengths)
    limits = [1, 7, 1024, 10**6]
    for r in token_counts.at_limits(sums, limits).collect():
        assert r["truncated_total"] == sum(min(x, r["context_limit"]) for x in lengths)
        assert r["docs_cut"] == sum(x > r["context_limit"] for x in lengths)
    half = token_counts.length_quantiles(sums, [0.5]).first()["n_tokens"]
    assert half == min(n for n in lengths if sum(x <= n for x in lengths) >= 0.5 * len(lengths))
    assert token_counts.suffix_sums(token_counts.length_histogram(token_counts.token_lengths(docs.limit(0), TOKENIZER))).count() == 0


def test_packing_covers_every_token_once(spark, sf, docs):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    own = docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).select("doc_id", "text")
    more = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("doc_id + 100 AS doc_id", "text")
    rows = own.unionByName(more)
    pieces = packing.pack(rows, TOKENIZER, 1024).toPandas()
    ids = {r["doc_id"]: np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4") for r in rows.collect()}
    for i, g in pieces.sort_values("start").groupby("doc_id"):
        at = 0
        for r in g.itertuples():
            assert r.start == at and r.doc_tokens == len(ids[i])
            assert zlib.crc32(ids[i][at : at + r.length].tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(ids[i])
    assert set(pieces.doc_id) == set(ids)
    full = 0
    for _, g in pieces.sort_values("offset").groupby("sequence_id"):
        assert (g.offset.to_numpy() == np.cumsum(g.length) - g.length).all()
        assert g.length.sum() <= 1024
        full += g.length.sum() == 1024
    assert full >= pieces.sequence_id.nunique() - 1


def test_packing_of_repeated_and_missing_rows(docs):
    assert packing.pack(docs.limit(0), TOKENIZER).count() == 0
    assert packing.pack(docs, TOKENIZER).groupBy("doc_id").count().count() == docs.select("doc_id").distinct().count()


def test_counts_use_no_more_than_there_is():
    rng = np.random.default_rng(0)
    histogram = rng.integers(0, 50, 64)
    histogram[0] = 0
    plan = packing.plan_windows(histogram, 64)
    assert (plan.used <= histogram).all()
    assert plan.used.sum() > 0.6 * histogram.sum()
