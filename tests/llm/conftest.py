import pytest

CLASH = "id, t, h, n, key, p, score, keep_id, copies, component, row, base, word, count"


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty and long texts, repeated rows, copies, and extra columns whose names operators use inside."""
    long = " ".join(f"word{k % 977} thing{k % 31}" for k in range(30_000))
    same = "the quick brown fox jumps over the lazy dog again and again until it is tired of it all"
    rows = [
        (1, same, "en", "a"), (2, same, "en", "a"), (2, same, "en", "a"), (3, same + " now", "en", None), (4, None, None, None), (5, "", "en", "a"),
        (6, "  \n\t ", "en", "b"), (7, long, "en", "b"), (8, "one two", "de", "b"), (9, "ONE TWO", "de", "b"), (None, "an id that is null", "en", "a"),
        (10, "der hund und die katze sind im haus und nicht im garten", "de", "c"), (11, "Mail a.b@c.example.org or +1 (555) 010-9999, 10.0.0.256 and 10.0.0.7.", "en", "c"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    return df.selectExpr("*", *[f"'x' AS {c.strip()}" for c in CLASH.split(",")])
