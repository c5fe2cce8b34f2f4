"""Contracts, readiness, conformance and audits as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlake.functions.paths import location_violations


def output_violations(expected: DataFrame, produced: DataFrame, forbidden: list[str]) -> DataFrame:
    """(name, key, violation): what differs between (name, coordinates) contracts and results, by coordinate.

    missing and unexpected tables, key_missing, key_unexpected, value_drift, forbidden.
    """
    e = expected.select("name", F.explode("coordinates").alias("key", "want"))
    p = produced.select("name", F.explode("coordinates").alias("key", "got"))
    names = expected.select("name", F.lit(True).alias("in_e")).join(produced.select("name", F.lit(True).alias("in_p")), "name", "full")
    tables = names.filter("in_e IS NULL OR in_p IS NULL").select("name", F.lit(None).cast("string").alias("key"), F.when(F.col("in_p").isNull(), "missing").otherwise("unexpected").alias("violation"))
    both = names.filter("in_e AND in_p").select("name")
    keys = e.join(both, "name", "left_semi").join(p.join(both, "name", "left_semi"), ["name", "key"], "full")
    kind = F.when(F.col("got").isNull(), "key_missing").when(F.col("want").isNull(), "key_unexpected").when(F.col("want") != F.col("got"), "value_drift")
    drift = keys.select("name", "key", kind.alias("violation")).filter("violation IS NOT NULL")
    banned = p.filter(F.col("key").isin(forbidden)).select("name", "key", F.lit("forbidden").alias("violation"))
    return tables.unionByName(drift).unionByName(banned)


def locate_outputs(expected: DataFrame, catalog: DataFrame) -> DataFrame:
    """(name, schema): the contract's schema where the table is there, else the first schema that has it; absent ones left out.

    Names meet whatever their case.
    """
    seen = catalog.select(F.upper("table").alias("k"), "schema")
    placed = expected.select("name", F.upper("name").alias("k"), F.col("schema").alias("wanted")).join(seen, "k")
    own = F.max(F.when(F.upper("schema") == F.upper("wanted"), F.col("schema")))
    return placed.groupBy("name").agg(F.coalesce(own, F.min("schema")).alias("schema"))


def column_violations(written: DataFrame, declared: DataFrame, exempt: list[str]) -> DataFrame:
    """(table, violation, columns) of (table, column) pairs: declared but not written, written but not declared."""
    sides = ((declared, written, "not_written"), (written, declared, "not_declared"))
    parts = []
    for have, lack, name in sides:
        gap = have.join(lack, ["table", "column"], "left_anti").filter(~F.col("column").isin(exempt))
        parts.append(gap.groupBy("table").agg(F.array_join(F.sort_array(F.collect_list("column")), ",").alias("columns")).withColumn("violation", F.lit(name)))
    return parts[0].unionByName(parts[1]).select("table", "violation", "columns")


def readiness(gates: DataFrame, observed: DataFrame) -> DataFrame:
    """(gate, ordinal, expected, observed, ready) in policy order; an unobserved gate is ready only if null is expected.

    A gate without a name is an error (one small job over the policy).
    """
    if gates.filter(F.trim(F.coalesce("gate", F.lit(""))) == "").limit(1).count():
        raise ValueError("a gate needs a name")
    both = gates.join(observed, "gate", "left")
    return both.select("gate", "ordinal", "expected", "observed", F.col("expected").eqNullSafe(F.col("observed")).alias("ready"))


def conformance(columns: DataFrame, contract: DataFrame, counts: DataFrame) -> DataFrame:
    """(table, ordinal, violation): columns not as the contract has them by place, and required tables without rows.

    columns and contract: (table, ordinal, name, type), the contract's also optional;
    counts: (table, n_rows).
    """
    got = columns.select("table", "ordinal", F.col("name").alias("gn"), F.col("type").alias("gt"))
    both = contract.join(got, ["table", "ordinal"], "full")
    kind = F.when(F.col("gn").isNull(), "absent").when(F.col("name").isNull(), "extra").when(F.col("name") != F.col("gn"), "name").when(F.col("type") != F.col("gt"), "type")
    drift = both.select("table", "ordinal", kind.alias("violation")).filter("violation IS NOT NULL")
    need = contract.groupBy("table").agg(F.min("optional").alias("optional")).filter("NOT optional")
    empty = need.join(counts, "table", "left").filter("coalesce(n_rows, 0) = 0").select("table", F.lit(None).cast("int").alias("ordinal"), F.lit("no_rows").alias("violation"))
    return drift.unionByName(empty)


def audit_locations(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn("violations", location_violations(F.col(column)))


def identity_audit(rows: DataFrame) -> DataFrame:
    """Release rows (image, revision, commit) with what isn't an exact identity."""
    return rows.withColumn(
        "violations",
        F.array_compact(
            F.array(
                F.when(~F.coalesce(F.col("image").rlike("^[^@\\s]+@sha256:[0-9a-f]{64}$"), F.lit(False)), "image"),
                F.when(~F.coalesce(F.col("revision").rlike("^[A-Za-z0-9_-]+:[1-9][0-9]*$"), F.lit(False)), "revision"),
                F.when(~F.coalesce(F.col("commit").rlike("^[0-9a-f]{40}$"), F.lit(False)), "commit"),
            )
        ),
    )


def lease_audit(events: DataFrame) -> DataFrame:
    """(lease, seq, violation) over (lease, seq, owner, token, at, until): takeovers of a live lease, tokens that don't rise."""
    w = Window.partitionBy("lease").orderBy("seq")
    rows = events.select("*", F.lag("owner").over(w).alias("po"), F.lag("token").over(w).alias("pt"), F.lag("until").over(w).alias("pu"))
    kind = F.when((F.col("owner") != F.col("po")) & (F.col("at") < F.col("pu")), "overlap").when((F.col("owner") != F.col("po")) & (F.col("token") <= F.col("pt")), "token")
    return rows.select("lease", "seq", kind.alias("violation")).filter("violation IS NOT NULL")


def gate_rollup(results: DataFrame) -> DataFrame:
    """(run, stage, ordinal, first_failed, halted) over (run, stage, ordinal, gate_no, gate, passed).

    A stage's first failing gate, and whether an earlier stage's failure stopped it.
    """
    stages = results.groupBy("run", "stage", "ordinal").agg(F.min_by(F.when(~F.col("passed"), F.col("gate")), F.when(~F.col("passed"), F.col("gate_no"))).alias("first_failed"))
    before = Window.partitionBy("run").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    return stages.withColumn("halted", F.coalesce(F.max(F.col("first_failed").isNotNull()).over(before), F.lit(False)))


def task_exit(events: DataFrame) -> DataFrame:
    """(task, status, code) over (task, ordinal, code): success only if every container ended with 0; none known is a failure."""
    bad = F.col("code").isNull() | (F.col("code") != 0)
    rows = events.groupBy("task").agg(
        F.min_by(F.when(F.col("code") != 0, F.col("code")), F.when(F.col("code") != 0, F.col("ordinal"))).alias("code"), F.count_if(bad).alias("n_bad")
    )
    return rows.select("task", F.when(F.col("n_bad") == 0, "succeeded").otherwise("failed").alias("status"), "code")
