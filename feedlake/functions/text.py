"""Column expressions over labels, digests and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(c: Column) -> Column:
    """Null, or nothing but white space (no-break included)."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"[\s\x{a0}]+", "") == ""


def normalize_label(c: Column) -> Column:
    """White space (no-break included) collapsed, ends trimmed, a closing [n] mark dropped; blank is null."""
    text = F.trim(F.regexp_replace(c, r"[\s\x{a0}]+", " "))
    return F.nullif(F.trim(F.regexp_replace(text, r"\s*\[[0-9]+\]$", "")), F.lit(""))


def snake_case(name: str) -> str:
    """A header as a lower snake-case name."""
    import re

    return re.sub(r"[^a-z0-9]+", "_", name.strip().lower()).strip("_")


def digest(c: Column) -> Column:
    """sha256:<hex> of a text; null stays null."""
    return F.concat(F.lit("sha256:"), F.sha2(c, 256))


def reuse_fingerprint(stage: Column, run: Column) -> Column:
    return digest(F.concat(stage, F.lit("|"), run))


def is_digest(c: Column) -> Column:
    return F.coalesce(c.rlike("^sha256:[0-9a-f]{64}$"), F.lit(False))


def is_logical_id(c: Column) -> Column:
    return F.coalesce(c.rlike("^[a-z0-9][a-z0-9_.-]{0,127}$"), F.lit(False))


def ordered_list(value: Column, order: Column) -> Column:
    """An aggregate: the values of a group as an array, by `order`."""
    return F.transform(F.sort_array(F.collect_list(F.struct(order.alias("o"), value.alias("v")))), lambda s: s["v"])


def join_list(values: Column, sep: str = ",") -> Column:
    """An array of strings joined; an empty array or one of nulls alone is null, not ''."""
    some = F.filter(values, lambda v: v.isNotNull())
    return F.when(F.size(some) > 0, F.array_join(some, sep))
