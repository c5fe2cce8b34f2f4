"""Names and types at a table's edge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def unique_names(names: list[str]) -> list[str]:
    """Names as given, repeats (in any case) with _1, _2, ... behind."""
    seen: dict[str, int] = {}
    taken = {n.lower() for n in names}
    out = []
    for n in names:
        k = seen.get(n.lower(), 0)
        seen[n.lower()] = k + 1
        new = n
        while k and new.lower() in taken:
            new = f"{n}_{k}"
            k += 1
        taken.add(new.lower())
        out.append(new)
    return out


def header_names(header: list[str]) -> list[str]:
    """A header's names, trimmed; one without a name is `column` and its place from 0, as wide as the last."""
    wide = len(str(max(len(header) - 1, 0)))
    return [n.lstrip("\ufeff").strip() or f"column{k:0{wide}d}" for k, n in enumerate(header)]


def dedupe_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*unique_names(df.columns))


def rename_columns(df: DataFrame, case: str = "lower") -> DataFrame:
    return df.toDF(*[c.lower() if case == "lower" else c.upper() for c in df.columns])


def all_string(df: DataFrame) -> DataFrame:
    return df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def align_by_name(df: DataFrame, target: T.StructType) -> DataFrame:
    """The target's columns by name, whatever the case; absent ones null, others an error."""
    have = {c.lower(): c for c in df.columns}
    extra = sorted(set(have) - {f.name.lower() for f in target})
    if extra:
        raise ValueError(f"columns that the target lacks: {', '.join(extra)}")
    return df.select(*[(F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in target])


def typed(df: DataFrame, contract: dict[str, str]) -> DataFrame:
    """Declared columns cast (string, date, integer, numeric); what can't be read is null, counted in n_unparsed."""
    kinds = {"string": "string", "integer": "bigint", "numeric": "double"}
    out, bad = [], F.lit(0)
    for name, kind in contract.items():
        c = F.col(name)
        v = F.coalesce(F.try_to_date(c, "yyyy-MM-dd"), F.try_to_date(c, "yyyyMMdd")) if kind == "date" else c.try_cast(kinds[kind])
        out.append(v.alias(name))
        bad = bad + (c.isNotNull() & v.isNull()).cast("int")
    return df.select(*out, bad.cast("bigint").alias("n_unparsed"))
