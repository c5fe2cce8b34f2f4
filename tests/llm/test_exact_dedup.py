import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from feedlake.llm.exact_dedup import exact_dedup, keep_exact


def brute(rows, keep):
    groups = defaultdict(list)
    for r in rows:
        groups[r["text"] or ""].append(r["doc_id"])
    pick = max if keep == "largest" else min
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = pick(known) if known else None
        kept = False
        for i in ids:
            first = i == best and not kept
            kept |= first
            out.append((i, best, len(ids), first, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def collect(df):
    return sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in df.collect()), key=str)


def test_against_brute_force(docs):
    for keep in ("smallest", "largest"):
        assert collect(exact_dedup(docs, keep=keep)) == brute(docs.collect(), keep)


def test_colliding_hashes_stay_apart(docs):
    weak = lambda t: F.substring(F.unhex(F.md5(t)), 1, 0)
    assert collect(exact_dedup(docs, hash_fn=weak)) == brute(docs.collect(), "smallest")


def test_kept_rows_are_one_for_each_text(docs):
    kept = keep_exact(docs, keep="largest").collect()
    assert len(kept) == len({r["text"] or "" for r in docs.collect()})
    assert kept[0].asDict().keys() == docs.first().asDict().keys()


def test_empty_table(docs):
    assert exact_dedup(docs.limit(0)).count() == 0
