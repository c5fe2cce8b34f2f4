"""Every query against its SQL on the smallest tables; the registry's shape."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from feedlake.queries import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or v != v:
        return "NULL"
    return repr(round(v, 6) + 0.0) if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def sql(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, sql, name):
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    rows = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    result = sql.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall())
    assert rows == want


def test_registry(spark):
    assert set(ORACLES) == set(QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


def test_nothing_else_imports_the_corpus_operators():
    root = Path(entry.__file__).parent / "feedlake"
    for path in root.rglob("*.py"):
        if "llm" not in path.parts:
            assert "llm" not in path.read_text(encoding="utf-8"), path
