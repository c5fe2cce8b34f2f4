"""Run evidence: append-only typed records, their checks and what follows from them.

A record has run_id, seq, occurred_at, record_type and the fields of its type. Order
is `seq`; the last record of a key holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.text import is_digest, is_logical_id, reuse_fingerprint
from feedlake.workspace import workspace

#: Rounds in which chains of reused runs are followed, each twice as far as the one before.
HOPS = 32

#: Fields of each record type besides the common ones, and the outcomes of a stage (fixed values).
FIELDS = {
    "run_started": ("param_digests",),
    "stage_attempted": ("stage_id", "outcome"),
    "stage_reused": ("stage_id", "reused_from_run_id", "fingerprint"),
    "prerequisite_checked": ("prerequisite_id", "observed_digest", "satisfied"),
    "stage_blocked": ("stage_id", "prerequisite_id", "reason"),
    "metric_observed": ("stage_id", "metric_id", "value"),
    "artifact_observed": ("artifact_id", "intended_digest", "observed_digest"),
}
OUTCOMES = ("succeeded", "failed")
COMMON = ("run_id", "seq", "occurred_at", "record_type")
SCHEMA = (
    "run_id string, seq bigint, occurred_at string, record_type string, param_digests map<string,string>, stage_id string, outcome string, "
    "reused_from_run_id string, fingerprint string, prerequisite_id string, observed_digest string, satisfied boolean, reason string, "
    "metric_id string, value bigint, artifact_id string, intended_digest string"
)


def parse_evidence(lines: DataFrame, column: str = "value") -> DataFrame:
    """Typed records of JSON lines, with `problem`: a type or a field that isn't known, or a field the type lacks."""
    keys = F.json_object_keys(F.col(column))
    rows = lines.select(F.from_json(column, SCHEMA).alias("r"), keys.alias("keys"))
    allowed = F.create_map(*[x for t, fs in FIELDS.items() for x in (F.lit(t), F.array(*[F.lit(f) for f in (*COMMON, *fs)]))])
    own = F.try_element_at(allowed, F.col("r.record_type"))
    problem = F.when(F.col("keys").isNull(), "not_json").when(own.isNull(), "unknown_type").when(F.size(F.array_except("keys", own)) > 0, "unknown_field").when(F.size(F.array_except(own, "keys")) > 0, "missing_field")
    return rows.select("r.*", problem.alias("problem"))


def read_evidence(spark: SparkSession, path: str) -> DataFrame:
    return parse_evidence(spark.read.text(path))


def evidence_violations(records: DataFrame) -> DataFrame:
    """Records with an array of violations: ids, digests and closed vocabularies of their type."""
    t = F.col("record_type")

    def wrong(types: tuple[str, ...], ok, name: str):
        return F.when(t.isin(*types) & ~F.coalesce(ok, F.lit(False)), name)

    having = lambda f: tuple(k for k, v in FIELDS.items() if f in v)
    checks = [
        F.when(~t.isin(*FIELDS), "record_type"),
        F.when(~is_logical_id(F.col("run_id")), "run_id"),
        *[wrong(having(f), is_logical_id(F.col(f)), f) for f in ("stage_id", "prerequisite_id", "metric_id", "artifact_id", "reused_from_run_id")],
        *[wrong(having(f), is_digest(F.col(f)), f) for f in ("fingerprint", "intended_digest")],
        F.when(t.isin(*having("observed_digest")) & F.col("observed_digest").isNotNull() & ~is_digest(F.col("observed_digest")), "observed_digest"),
        wrong(having("outcome"), F.col("outcome").isin(*OUTCOMES), "outcome"),
        wrong(having("value"), F.col("value") >= 0, "value"),
    ]
    return records.withColumn("violations", F.array_compact(F.array(*checks)))


def append_evidence(records: DataFrame, path: str) -> int:
    """Append a whole batch of valid records, or nothing. The number of records."""
    bad = evidence_violations(records).filter(F.size("violations") > 0).limit(1).collect()
    if bad:
        raise ValueError(f"record {bad[0]['seq']} of {bad[0]['run_id']}: {', '.join(bad[0]['violations'])}")
    records.write.mode("append").json(path)
    return records.count()


def append_metrics(records: DataFrame, contract: DataFrame, path: str) -> int:
    """Append metric records of runs, all or none: undeclared metrics and declared ones that a touched stage lacks refuse the batch."""
    gap = metric_gaps(records.select("run_id", "stage_id", "metric_id"), contract).limit(1).collect()
    if gap:
        raise ValueError(f"metric {gap[0]['metric_id']} of {gap[0]['stage_id']} is {gap[0]['gap']}")
    return append_evidence(records, path)


def run_summary(records: DataFrame, contract: DataFrame | None = None) -> DataFrame:
    """(run_id, kind, key, state): the last word on every stage, prerequisite, metric and artifact of a run.

    With a contract of (stage_id, metric_id), a metric that it doesn't declare is an error, and each
    declared metric that a run lacks is a row of kind missing_metric, also of stages it never touched.
    """
    if contract is not None:
        metrics = records.filter("record_type = 'metric_observed'").select("run_id", "stage_id", "metric_id")
        odd = metrics.join(contract.select("stage_id", "metric_id"), ["stage_id", "metric_id"], "left_anti").limit(1).collect()
        if odd:
            raise ValueError(f"metric {odd[0]['metric_id']} of {odd[0]['stage_id']} is undeclared")
        declared = F.array(*[F.lit(f"{r['stage_id']}/{r['metric_id']}") for r in contract.select("stage_id", "metric_id").distinct().collect()]).cast("array<string>")
        name = F.concat_ws("/", "stage_id", "metric_id")
        seen = records.groupBy("run_id").agg(F.collect_set(F.when(F.col("record_type") == "metric_observed", name)).alias("seen"))
        lacking = seen.select("run_id", F.lit("missing_metric").alias("kind"), F.explode(F.array_except(declared, "seen")).alias("key"), F.lit("missing").alias("state"))
        return run_summary(records).unionByName(lacking)
    t = F.col("record_type")
    kind = F.when(t.isin("stage_attempted", "stage_reused", "stage_blocked"), "stage").when(t == "prerequisite_checked", "prerequisite").when(t == "metric_observed", "metric").when(t == "artifact_observed", "artifact")
    key = F.coalesce(F.when(t == "metric_observed", F.concat_ws("/", "stage_id", "metric_id")), F.when(t == "prerequisite_checked", F.col("prerequisite_id")), F.when(t == "artifact_observed", F.col("artifact_id")), F.col("stage_id"))
    state = (
        F.when(t == "stage_attempted", F.col("outcome"))
        .when(t == "stage_reused", "reused")
        .when(t == "stage_blocked", "blocked")
        .when(t == "prerequisite_checked", F.when(F.col("satisfied"), "satisfied").otherwise("unsatisfied"))
        .when(t == "metric_observed", F.col("value").cast("string"))
        .when(t == "artifact_observed", F.when(F.col("observed_digest").eqNullSafe(F.col("intended_digest")), "valid").otherwise("invalid"))
    )
    rows = records.select("run_id", kind.alias("kind"), key.alias("key"), state.alias("state"), "seq").filter("kind IS NOT NULL")
    return rows.groupBy("run_id", "kind", "key").agg(F.max_by("state", "seq").alias("state"))


def phase_status(records: DataFrame, overlay: DataFrame) -> DataFrame:
    """(run_id, stage_id, status): completed, failed or skipped by the last record; else the overlay's passing status."""
    t = F.col("record_type")
    status = F.when(t == "stage_reused", "skipped").when(F.col("outcome") == "succeeded", "completed").otherwise("failed")
    done = records.filter(t.isin("stage_attempted", "stage_reused")).groupBy("run_id", "stage_id").agg(F.max_by(status, "seq").alias("done"))
    both = done.join(overlay.withColumnRenamed("status", "passing"), ["run_id", "stage_id"], "full")
    return both.select("run_id", "stage_id", F.coalesce("done", "passing").alias("status"))


def phase_origin(phases: DataFrame) -> DataFrame:
    """(run_id, stage_id, origin): the run that did a phase; a reused phase has that of the run it names, through chains of any length.

    Each round takes every run's origin to its origin's origin, so the hops double; a
    run that isn't recorded is an origin itself. Runs that name each other in a circle are an error.
    """
    base = workspace(phases.sparkSession, "origins")
    now = phases.select("run_id", "stage_id", F.coalesce("satisfied_by", "run_id").alias("origin"))
    for k in range(HOPS):
        prior = now.select(F.col("run_id").alias("origin"), "stage_id", F.col("origin").alias("carried"))
        new = now.join(prior, ["origin", "stage_id"], "left").select("run_id", "stage_id", F.coalesce("carried", "origin").alias("origin"), (F.col("carried") != F.col("origin")).alias("moved"))
        new.write.parquet(f"{base}/{k}")
        now = phases.sparkSession.read.parquet(f"{base}/{k}")
        if now.filter("moved").limit(1).count() == 0:
            return now.drop("moved")
        now = now.drop("moved")
    raise ValueError("runs that reuse each other in a circle")


def metric_gaps(metrics: DataFrame, contract: DataFrame) -> DataFrame:
    """(run_id, stage_id, metric_id, gap): declared metrics of stages a run touched that it lacks, and undeclared ones."""
    runs = metrics.select("run_id", "stage_id").distinct()
    missing = runs.join(contract, "stage_id").join(metrics, ["run_id", "stage_id", "metric_id"], "left_anti").withColumn("gap", F.lit("missing"))
    extra = metrics.join(contract, ["stage_id", "metric_id"], "left_anti").select("run_id", "stage_id", "metric_id").distinct().withColumn("gap", F.lit("undeclared"))
    return missing.select("run_id", "stage_id", "metric_id", "gap").unionByName(extra)


def prerequisite_records(observations: DataFrame) -> DataFrame:
    """(run_id, stage_id, n_checked, n_blocked, ready) over (run_id, stage_id, prerequisite_id, satisfied)."""
    return observations.groupBy("run_id", "stage_id").agg(F.count(F.lit(1)).alias("n_checked"), F.count_if(~F.col("satisfied")).alias("n_blocked"), F.bool_and("satisfied").alias("ready"))


def artifact_status(artifacts: DataFrame) -> DataFrame:
    status = F.when(F.col("observed_digest").isNull(), "unobserved").when(F.col("observed_digest") == F.col("intended_digest"), "valid").otherwise("invalid")
    return artifacts.withColumn("status", status)


def verify_reuse(reused: DataFrame) -> DataFrame:
    """Reuse records with whether their fingerprint is that of stage and run."""
    return reused.withColumn("verified", F.col("fingerprint") == reuse_fingerprint(F.col("stage_id"), F.col("reused_from_run_id")))


def read_runs(spark: SparkSession, folder: str) -> DataFrame:
    """(run_id, status, started_at, ended_at, file_path, modified) of one JSON manifest for each file; unreadable ones are left out."""
    schema = "run_id string, status string, started_at string, ended_at string"
    runs = spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").json(folder)
    return runs.select("*", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_modification_time").alias("modified")).filter("run_id IS NOT NULL")


def latest_run(runs: DataFrame, key: str) -> DataFrame:
    """(key, run_id): the run modified last in each group, the larger id where times tie."""
    return runs.groupBy(key).agg(F.max_by("run_id", F.struct("modified", "run_id")).alias("run_id"))


def latest_runs(runs: DataFrame, n: int) -> DataFrame:
    """The n newest runs of (run_id, modified): a top-n, not a sort of all."""
    return runs.orderBy(F.col("modified").desc(), F.col("run_id").desc()).limit(n)
