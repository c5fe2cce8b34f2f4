import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
from pyspark.sql import functions as F

from feedlake.llm import prefix_trie
from feedlake.llm.queries import ORACLES, QUERIES

RULES = {"base": lambda c: c - c % 100, "heads": lambda c: F.crc32(c.cast("string").cast("binary")) % 6, "most": 5}
SCHEMA = "conv_id bigint, turn bigint, role string, text string"
NAMES = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def brute(rows, rebuild=True):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    whole = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if rebuild else 0
        whole[c] = own.get(c - c % 100, [])[:h] + v[h:]
    members = defaultdict(list)
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members[tuple(whole[c][:d])].append(c)
    children = defaultdict(list)
    for key in members:
        if key:
            children[key[:-1]].append(key)
    saved, leaves = {}, {}
    for key in sorted(members, key=len, reverse=True):
        saved[key] = (len(members[key]) - 1) * (len(key[-1][1]) if key else 0) + sum(saved[x] for x in children[key])
        leaves[key] = sum(leaves[x] for x in children[key]) or 1
    digest = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    return sorted(
        (m[0], len(k), members[k[:-1]][0] if k else -1, len(m), len(children[k]), leaves[k], saved[k], digest(c for c in m if len(whole[c]) == len(k))) for k, m in members.items()
    )


def found(df):
    return sorted(tuple(-1 if r[n] is None else r[n] for n in NAMES) for r in df.collect())


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    rng = random.Random(2)
    rows = []
    for c in [*range(0, 230), 300, 301, 555]:
        if c == 200:
            continue
        for t in range(rng.randint(1, 9)):
            rows.append((c, rng.choice([t, t, None, 3]), rng.choice(["user", "bot", None]), rng.choice(["a", "bb", "日本", None, "ccc" * 5])))
    rows += [(None, 1, "user", "lost"), (7, 2, "user", "again"), (7, 2, "user", "again")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = prefix_trie.prefix_trie(df, **RULES)
    assert got.columns == NAMES and {t for _, t in got.dtypes[:-1]} == {"bigint"}
    assert found(got) == brute(rows)
    assert found(prefix_trie.prefix_trie(df)) == brute(rows, rebuild=False)


def test_long_chains_and_large_groups(spark):
    rows = [(1, t, "user", f"t{t}") for t in range(3000)] + [(c, t, "user", f"t{t}") for c in range(2, 400) for t in range(3)]
    rows += [(c, 0, "bot", "hello") for c in range(1000, 1300)] + [(c, t, "bot", "hello" if t == 0 else f"own {c}") for c in range(2000, 2300) for t in (0, 1)]
    assert found(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows, rebuild=False)


def test_roles_and_texts_are_told_apart(spark):
    rows = [(1, 0, "a", "bc"), (2, 0, "ab", "c"), (3, 0, "", "abc"), (4, 0, None, "abc"), (5, 0, "1:", "x"), (6, 0, "1", ":x")]
    assert len(found(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA)))) == 6
    assert found(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows, rebuild=False)


def test_edge_tables_and_columns(spark):
    rows = [(1, 0, None, None), (1, None, "u", ""), (2, 0, "u", "x" * 300_000), (2, 0, "u", "x" * 300_000), (150, 1, "u", "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    wide = df.selectExpr("*", *[f"'q' AS {c}" for c in ("depth", "prefix", "pos", "digest", "chars", "base", "h", "part", "weight", "leaf", "salt", "id")])
    assert found(prefix_trie.prefix_trie(wide, **RULES)) == brute(rows)
    assert prefix_trie.prefix_trie(df.limit(0), **RULES).count() == 0


def test_query_against_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    want = con.execute(ORACLES["op13_prefix_trie"])
    order = [[d[0] for d in want.description].index(n) for n in NAMES]
    assert found(QUERIES["op13_prefix_trie"](spark, sf)) == sorted(tuple(-1 if r[k] is None else r[k] for k in order) for r in want.fetchall())
