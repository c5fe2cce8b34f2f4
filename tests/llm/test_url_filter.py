from feedlake.llm.queries import URL_RULES
from feedlake.llm.url_filter import build_cascade, judge_urls
from pyspark.sql import functions as F

URLS = [
    "http://a.example.org/es/1?q=/en/1", "HTTPS://A.Example.ORG/en/12", "http://example.org", "http://org/", "http://x.com/fr/", "http://x.com/de/y#z",
    "http://x.com/DE/", "http://notorg/", "x.com/de/", None, "", "http://", "http://com/fr/", "http://a..org/", "http://x.net/de/", "ftp://u@b.example.org:80/es/",
    "see http://x.com/de/ and http://y.org/",
]


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:end], rest[end:]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_against_brute_force(spark):
    pages = spark.createDataFrame([(k, u, "x", "y") for k, u in enumerate(URLS)], "page_id bigint, url string, host string, keys string")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judge_urls(pages, rules).collect()}
    assert got == {k: brute(u) for k, u in enumerate(URLS)}
    assert judge_urls(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in judge_urls(pages, rules.limit(0)).collect()} == {"allow"}


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(20_000).select(F.col("id").cast("string").alias("key"))
    listed = universe.filter("cast(key as int) % 97 = 0")
    cascade = build_cascade(universe, listed)
    assert len(cascade.levels) > 1
    wrong = universe.filter(cascade.holds(F.col("key")) != (F.col("key").cast("int") % 97 == 0))
    assert wrong.count() == 0
