import numpy as np
from pyspark.sql import functions as F

from feedlake.llm import neighbours
from feedlake.llm.neighbours import near_duplicates


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x", "y") for i, v in rows], "vec_id bigint, embedding array<float>, id string, v string")


def brute(rows, least=0.95):
    good = {i: np.array(v, np.float32).astype(float) for i, v in rows if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    ids = sorted(good)
    parent = {i: i for i, _ in rows}
    links = dict.fromkeys(parent, 0)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if len(good[a]) == len(good[b]) and good[a] @ good[b] / np.linalg.norm(good[a]) / np.linalg.norm(good[b]) >= least:
                links[a] += 1
                links[b] += 1
                x, y = a, b
                while parent[x] != x:
                    x = parent[x]
                while parent[y] != y:
                    y = parent[y]
                parent[max(x, y)] = min(x, y)
    out = {}
    for i in parent:
        x = i
        while parent[x] != x:
            x = parent[x]
        out[i] = (links[i], x, x == i)
    return out


def test_recall_of_pairs_and_one_large_group(spark):
    rng = np.random.default_rng(1)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(300, 16)))]
    rows += [(1000 + i, rows[i][1] + rng.normal(scale=0.05, size=16)) for i in range(40)]
    rows += [(2000 + i, rows[7][1] + rng.normal(scale=0.02, size=16)) for i in range(80)]
    rows += [(3000, None), (3001, [0.0] * 16), (3002, [float("nan")] * 16), (3003, [None] * 16), (3004, [1.0, 0.0]), (3005, [])]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in near_duplicates(table(spark, rows)).collect()}
    want = brute(rows)
    assert sum(min(got[i][0], n) for i, (n, _, _) in want.items()) >= 0.97 * sum(n for n, _, _ in want.values())
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(got[i][1] == want[i][1] for i in want) >= 0.97 * len(want)
    assert all(got[i] == (0, i, True) for i in range(3000, 3006))


def test_empty_and_repeated(spark):
    assert near_duplicates(table(spark, []).limit(0)).count() == 0
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (None, [1.0, 0.0])]
    got = near_duplicates(table(spark, rows)).collect()
    assert len(got) == 4 and all(r["n_links"] == 0 for r in got)


def answers(spark, rows):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in near_duplicates(table(spark, rows)).collect()}


def test_lists_full_of_own_copies_still_meet(spark):
    rng = np.random.default_rng(2)
    a = np.eye(32)[0]
    b = 0.96 * a + np.sqrt(1 - 0.96**2) * np.eye(32)[1]
    rows = [(i, a + rng.normal(scale=1e-4, size=32)) for i in range(30)] + [(100 + i, b + rng.normal(scale=1e-4, size=32)) for i in range(30)]
    rows += [(200 + i, v) for i, v in enumerate(rng.normal(size=(100, 32)))] + [(1000 + i, a) for i in range(700)]
    assert answers(spark, rows) == brute(rows)


def test_search_beyond_the_component_counts_both_sides(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "AUDIT", 0)
    monkeypatch.setattr(neighbours, "RECALL", 0.0)
    rng = np.random.default_rng(4)
    a = np.eye(32)[0]
    b = 0.96 * a + np.sqrt(1 - 0.96**2) * np.eye(32)[1]
    rows = [(i, a + rng.normal(scale=1e-4, size=32)) for i in range(30)] + [(100 + i, b + rng.normal(scale=1e-4, size=32)) for i in range(30)]
    rows += [(200 + i, v) for i, v in enumerate(rng.normal(size=(100, 32)))]
    assert answers(spark, rows) == brute(rows)
    monkeypatch.setattr(neighbours, "CENTRES", 1)
    assert answers(spark, rows) == brute(rows)


def test_audit_sees_the_loss_of_small_groups_and_of_everything(spark):
    large = [(i, j) for i in range(40) for j in range(40) if i != j]
    pairs = [(100 + 2 * k + d, 101 + 2 * k - d) for k in range(15) for d in (0, 1)]
    frame = lambda rows: spark.createDataFrame(rows, "id bigint, other bigint")
    labels = spark.createDataFrame([(i, 0) for i in range(40)], "id bigint, component bigint")
    none = frame([]).select("id")
    assert neighbours.audit(frame(large + pairs), frame(large), labels, none) == (0.0, 70)
    assert neighbours.audit(frame(large + pairs), frame(large + pairs), labels, none) == (1.0, 70)
    assert neighbours.audit(frame([]), frame(large), labels, none)[1] < neighbours.AUDIT


def test_few_links_among_many_vectors_are_found_without_comparing_all(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(50_000, 12)))]
    rows += [(100_000 + i, rows[i][1] + rng.normal(scale=0.08, size=12)) for i in range(40)]
    searched = []
    real = neighbours._search
    monkeypatch.setattr(neighbours, "_search", lambda rows, scratch, least: searched.append(rows.filter("wanted").count()) or real(rows, scratch, least))
    monkeypatch.setattr(neighbours, "AUDIT", 20)
    got = near_duplicates(table(spark, rows)).cache()
    x = np.array([np.array(v, np.float32) for _, v in rows], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    ids = np.array([i for i, _ in rows])
    want = {}
    for a in range(0, len(x), 5000):
        i, j = np.nonzero(x[a : a + 5000] @ x.T >= 0.95)
        for k, n in zip(*np.unique(i[i + a != j], return_counts=True), strict=True):
            want[int(ids[a + k])] = int(n)
    found = {r["vec_id"]: r["n_links"] for r in got.filter("n_links > 0").collect()}
    assert searched == [0] and all(found[k] <= want[k] for k in found)
    assert sum(found.values()) >= 0.98 * sum(want.values()) and len(want) >= 80
    assert got.select("recall").distinct().count() == 1 and got.first()["recall"] >= 0.9


def test_saturated_lists_are_enlarged_before_anything_is_searched(spark, monkeypatch):
    rng = np.random.default_rng(9)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(400, 24)))]
    rows += [(1000 + 100 * g + i, rows[g][1] + rng.normal(scale=0.02, size=24)) for g in range(5) for i in range(30)]
    monkeypatch.setattr(neighbours, "_search", lambda rows, scratch, least: rows.filter("wanted").select("id", F.lit(1 // 0 if rows.filter("wanted").count() else 0).cast("bigint").alias("n"), F.lit(None).cast("bigint").alias("a"), F.lit(None).cast("bigint").alias("b")))
    got, want = answers(spark, rows), brute(rows)
    assert sum(n for n, _, _ in got.values()) >= 0.98 * sum(n for n, _, _ in want.values())
    assert all(got[i][1:] == want[i][1:] for i in want)


def test_splits_grow_with_the_table():
    assert neighbours._splits(100, 0.95) == (0, 1)
    planes, splits = neighbours._splits(10**6, 0.95)
    assert planes == 13 and 12 <= splits <= 16 and neighbours._splits(10**9, 0.95)[1] > splits
