"""The registered queries of the training-data operators, with their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import divergence, exact_dedup, language_id, mixing, neighbours, ngram_join, packing, pii, piece_codec, prefix_trie, token_counts, toxicity, url_filter
from .common import read_table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

#: The rules of the URL query (fixed values).
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


#: Shares of expected tokens that the mixture is to have.
MIX_TARGETS = {"good": 0.85, "poor": 0.10, "toxic": 0.05}


def mixture(docs: DataFrame, labels: DataFrame, whole: bool = False) -> DataFrame:
    model = mixing.fit_domains(docs, mixing.label_domains(labels))
    return mixing.mix(docs, model, MIX_TARGETS, whole=whole)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def held_out(col: str = "doc_id"):
    """Rows whose labels nothing is learned from."""
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels").filter(~held_out())
    scored = toxicity.score_toxicity(read_table(spark, sf_dir, "documents"), labels, threshold=0.7)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def identified(docs: DataFrame) -> DataFrame:
    return language_id.identify(docs, language_id.fit(docs), host_levels=[F.col("source")])


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identified(read_table(spark, sf_dir, "documents"))


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of raw pages: the text model of documents, the page's lang attribute, its suffix and host."""
    host = url_filter.host_of(F.col("url"))
    declared = F.regexp_extract("html", r"<html[^>]*\slang=[\"']?([A-Za-z]+)", 1)
    body = F.regexp_replace(F.regexp_replace("html", r"(?s)<(script|style)\b.*?</\1>", " "), r"<[^>]*>|&[a-z]+;", " ")
    pages = read_table(spark, sf_dir, "pages").select("page_id", body.alias("text"), declared.alias("declared"), F.substring_index(host, ".", -1).alias("suffix"), host.alias("host"))
    model = language_id.fit(read_table(spark, sf_dir, "documents"))
    return language_id.identify(pages, model, "page_id", "text", F.col("declared"), [F.col("suffix"), F.col("host")])


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = token_counts.token_lengths(read_table(spark, sf_dir, "documents"), TOKENIZER)
    return token_counts.suffix_sums(token_counts.length_histogram(lengths))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(read_table(spark, sf_dir, "documents"))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql("SELECT * FROM VALUES " + ", ".join(str(r) for r in URL_RULES) + " AS rules(host, path, verdict)")
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"), rules)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(read_table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), TOKENIZER, 1024)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"), keep="largest")
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(read_table(spark, sf_dir, "documents"), least=10, most=10)


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = piece_codec.encode_pieces(read_table(spark, sf_dir, "documents"), PIECES)
    both = piece_codec.decode_pieces(ids, PIECES, keep=("doc_id", "ids"))
    said = F.array_join(F.col("ids").cast("array<string>"), " ")
    return both.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(said, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = lambda c: F.crc32(c.cast("string").cast("binary")) % 6
    return prefix_trie.prefix_trie(read_table(spark, sf_dir, "conversations"), lambda c: c - c % 100, heads, most=5)


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_toxicity": op2_toxicity,
    "op3_near_dedup": op3_near_dedup,
    "op4_language_id": op4_language_id,
    "language_id_pages": language_id_pages,
    "op5_token_counts": op5_token_counts,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_url_filters": op7_url_filters,
    "op8_pii": op8_pii,
    "op9_packing": op9_packing,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_source_divergence": op11_source_divergence,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES = {
    "op10_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY t)
    """,
    "op7_url_filters": r"""
        WITH r(rhost, rpath, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
               ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
        p AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
        q AS (SELECT page_id, lower(regexp_extract(rest, '^[^/?#]*')) AS host,
                     regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
        m AS (SELECT q.page_id, q.host, q.path, r.rhost || r.rpath AS rule, r.verdict,
                     row_number() OVER (PARTITION BY q.page_id ORDER BY length(r.rhost || r.rpath) DESC, length(r.rhost) DESC) AS k
              FROM q LEFT JOIN r ON (q.host = r.rhost OR suffix(q.host, '.' || r.rhost)) AND starts_with(q.path, r.rpath))
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE k = 1
    """,
    "op11_source_divergence": r"""
        WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
        w AS (SELECT id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
        kept AS (SELECT lang, term, count(*) AS ln FROM w GROUP BY 1, 2 HAVING count(DISTINCT id) >= 10),
        c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
        g AS (SELECT DISTINCT lang, source FROM d),
        l AS (SELECT lang, count(*) AS v, sum(ln) AS n FROM kept GROUP BY 1),
        gn AS (SELECT lang, source, coalesce(sum(n), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY 1, 2),
        p AS (SELECT lang, source, term, coalesce(c.n, 0) AS cnt, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (gn.n + 2 * v)::HUGEINT AS p
              FROM gn JOIN kept USING (lang) JOIN l USING (lang) LEFT JOIN c USING (lang, source, term)),
        pl AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (ln + 2)) // (n + 2 * v)::HUGEINT AS q FROM kept JOIN l USING (lang)),
        s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
              FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
        r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
              FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
              UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p JOIN pl USING (lang, term) WHERE cnt > 0 AND p > q),
        k AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
        SELECT lang, source, part, item, value, rank::INT AS rank FROM k WHERE part = 'pair' OR rank <= 10
    """,
    "op13_prefix_trie": r"""
        WITH o AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
                          {'r': coalesce(role, ''), 't': coalesce(text, '')} AS x FROM conversations WHERE conv_id IS NOT NULL),
        k AS (SELECT c, list(x ORDER BY pos) AS xs,
                     (xor(list_reduce(list_prepend(4294967295, list_transform(string_split(c::VARCHAR, ''), lambda y: ord(y)::BIGINT)),
                          lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda u, v: xor(u >> 1, 3988292384 * (u & 1)))), 4294967295) % 6)::INT AS h FROM o GROUP BY c),
        s AS (SELECT k.c, list_concat(coalesce(b.xs, [])[1:k.h], k.xs[k.h + 1:]) AS xs FROM k LEFT JOIN k AS b ON b.c = k.c - k.c % 100),
        p AS (SELECT c, xs, d, xs[1:d] AS key FROM (SELECT c, xs, unnest(range(len(xs) + 1)) AS d FROM s)),
        n AS (SELECT key, d, min(c) AS conv_id, count(*) AS n_convs, coalesce(any_value(length(key[d].t)), 0) AS chars,
                     coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(xs) = d), '') AS ends FROM p GROUP BY key, d),
        ch AS (SELECT key[1:d - 1] AS key, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
        m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN ch USING (key)),
        sub AS (SELECT key[1:e] AS key, sum((n_convs - 1) * chars) AS saved, count(*) FILTER (n_children = 0) AS n_leaves
                FROM (SELECT *, unnest(range(d + 1)) AS e FROM m) GROUP BY 1)
        SELECT m.conv_id, m.d AS depth, q.conv_id AS parent_conv_id, m.n_convs, m.n_children, sub.n_leaves, sub.saved::BIGINT AS saved_tokens, sha256(m.ends) AS ends_sha256
        FROM m JOIN sub USING (key) LEFT JOIN n AS q ON m.d > 0 AND q.d = m.d - 1 AND q.key = m.key[1:m.d - 1]
    """,
}
