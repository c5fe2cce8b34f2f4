"""Queries over paths, labels, contracts, evidence and state made from the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions import paths as P
from feedlake.functions import text as X
from feedlake.operators import evidence as E
from feedlake.operators import governance as G
from feedlake.operators import lineage
from feedlake.operators import state as ST
from feedlake.workspace import table, workspace


def s(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def label_normalize(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    raw = F.concat(F.lit("  "), F.col("text"), F.lit(" [12] "))
    return d.select("doc_id", X.normalize_label(raw).alias("label"))


def _paths(spark: SparkSession, sf: str) -> DataFrame:
    """Delivery paths by order: valid, impossible and missing stamps."""
    k = F.col("o_orderkey")
    stamp = F.when(k % 4 == 0, "259999").when(k % 4 == 1, "250230").otherwise(F.date_format("o_orderdate", "yyMMdd"))
    year = F.date_format("o_orderdate", "yyyy")
    quarter = F.concat(year, F.lit("Q"), s(k % 5 + 1))
    name = F.when(k % 3 == 0, F.concat(F.lit("P.A1.B."), quarter, F.lit(".D"), stamp, F.lit(".T"), F.lpad(s(k % 9999999), 7, "0"), F.lit(".xlsx"))).otherwise(F.concat(F.lit("P.A1.B.Y"), year, F.lit("."), s(k), F.when(k % 2 == 0, F.lit(".D250101.txt")).otherwise(F.lit(".csv"))))
    return table(spark, sf, "orders").select(k.alias("k"), F.concat(F.lit("/store/A1/"), year, F.lit("/A1/"), F.when(k % 7 == 0, F.lit("x")).otherwise(year), F.lit("/"), name).alias("file_path"))


def path_lineage(spark: SparkSession, sf: str) -> DataFrame:
    return lineage.with_lineage(_paths(spark, sf)).drop("k")


def filename_date_parse(spark: SparkSession, sf: str) -> DataFrame:
    return _paths(spark, sf).select("file_path", P.creation_date(P.base_name(F.col("file_path"))).alias("created"))


def quarter_end_date(spark: SparkSession, sf: str) -> DataFrame:
    token = F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("Q"), s(F.col("o_orderkey") % 6))
    return table(spark, sf, "orders").select("o_orderkey", P.quarter_end(token).alias("ends"))


def workbook_path_metadata(spark: SparkSession, sf: str) -> DataFrame:
    rows = lineage.with_workbook_metadata(_paths(spark, sf), "quarter", "A1")
    return rows.select("file_path", "file_date", "aco_id", "performance_year", "benchmark_year", "submission_id", "period")


def delivery_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    good, bad = lineage.split_stamped(_paths(spark, sf))
    return good.select("file_path", F.lit("accepted").alias("status")).unionByName(bad.select("file_path", F.lit("quarantined").alias("status")))


def location_audit(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("page_id")
    url = F.when(k % 6 == 0, F.concat("url", F.lit("/../x"))).when(k % 6 == 1, F.concat("url", F.lit("/*.csv"))).when(k % 6 == 2, F.regexp_replace("url", "^https?", "ftp")).when(k % 6 == 3, F.lit("")).when(k % 6 == 4, F.replace("url", F.lit("://"), F.lit("://u:p@"))).otherwise(F.col("url"))
    return G.audit_locations(table(spark, sf, "pages").select("page_id", url.alias("location")), "location").select("page_id", F.array_join("violations", ",").alias("violations"))


def redact_url(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", P.redact_url(F.concat(F.lit("get "), F.replace("url", F.lit("://"), F.lit("://user:pw@")), F.lit(" now"))).alias("line"))


def digest_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", X.digest(F.col("props")).alias("props_digest"), X.reuse_fingerprint(F.col("event_type"), s("user_id")).alias("fingerprint"))


def identity_audit(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("s_suppkey")
    h = F.sha2(s(k), 256)
    rows = table(spark, sf, "supplier").select(
        k.alias("k"),
        F.concat(F.lit("reg/app"), F.when(k % 3 == 0, F.lit(":latest")).otherwise(F.concat(F.lit("@sha256:"), h))).alias("image"),
        F.concat(F.lit("task:"), s(k % 4)).alias("revision"),
        F.when(k % 5 == 0, F.substring(h, 1, 7)).otherwise(F.substring(h, 1, 40)).alias("commit"),
    )
    return G.identity_audit(rows).select("k", F.array_join("violations", ",").alias("violations"))


def output_contract_diff(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    k = F.col("p_partkey")
    coordinates = F.create_map(F.lit("schema"), F.col("p_brand"), F.lit("table"), F.col("p_type"))
    expected = p.filter("p_partkey % 5 <> 0").select(F.concat(F.lit("t"), s(k)).alias("name"), coordinates.alias("coordinates"))
    drift = F.create_map(F.lit("schema"), F.when(k % 3 == 0, "other").otherwise(F.col("p_brand")), F.when(k % 4 == 0, "secret").otherwise("table"), F.col("p_type"))
    produced = p.filter("p_partkey % 7 <> 0").select(F.concat(F.lit("t"), s(k)).alias("name"), drift.alias("coordinates"))
    return G.output_violations(expected, produced, ["secret"])


def placement_lookup(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    expected = p.select(F.concat(F.lit("t"), s("p_partkey")).alias("name"), F.col("p_brand").alias("schema"))
    seen = p.filter("p_partkey % 3 <> 0").select(F.concat(F.lit("T"), s("p_partkey")).alias("table"), F.when(F.col("p_partkey") % 2 == 0, F.upper("p_brand")).otherwise(F.lit("zz")).alias("schema"))
    more = p.filter("p_partkey % 5 = 0").select(F.concat(F.lit("T"), s("p_partkey")).alias("table"), F.lit("aa").alias("schema"))
    return G.locate_outputs(expected, seen.unionByName(more))


def source_columns_diff(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(F.concat(F.lit("t"), s("l_orderkey")).alias("table"), F.concat(F.lit("c"), s("l_linenumber")).alias("column"), "l_returnflag").distinct()
    written, declared = lines.filter("l_returnflag <> 'A'").drop("l_returnflag").distinct(), lines.filter("l_returnflag <> 'R'").drop("l_returnflag").distinct()
    return G.column_violations(written, declared, ["c7"])


def schema_conformance(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").select(F.concat(F.lit("t"), s("p_partkey")).alias("table"), "p_partkey", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("ordinal"))
    k = F.col("p_partkey")
    name = F.concat(F.lit("c"), s("ordinal"))
    contract = p.select("table", "ordinal", name.alias("name"), F.lit("string").alias("type"), (k % 2 == 0).alias("optional"))
    got = p.filter((k % 5 != 0) | (F.col("ordinal") < 3)).select("table", "ordinal", F.when((k % 7 == 0) & (F.col("ordinal") == 2), "other").otherwise(name).alias("name"), F.when((k % 11 == 0) & (F.col("ordinal") == 1), "date").otherwise("string").alias("type"))
    counts = p.filter("ordinal = 1").select("table", (k % 9).alias("n_rows"))
    return G.conformance(got, contract, counts)


def readiness_gates(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    gates = c.select(F.concat(F.lit("g"), s(k)).alias("gate"), k.alias("ordinal"), F.when(k % 6 != 0, F.col("c_mktsegment")).alias("expected"))
    observed = c.filter("c_custkey % 4 <> 0").select(F.concat(F.lit("g"), s(k)).alias("gate"), F.when(k % 3 == 0, "other").otherwise(F.col("c_mktsegment")).alias("observed"))
    return G.readiness(gates, observed)


TYPES = ["run_started", "stage_attempted", "stage_reused", "prerequisite_checked", "stage_blocked", "metric_observed", "artifact_observed"]


def records(spark: SparkSession, sf: str, flaws: bool = False) -> DataFrame:
    """Events as evidence: user = run, event type = stage; with `flaws`, some fields break their rules."""
    k, run = F.col("event_id"), F.concat(F.lit("run-"), s("user_id"))
    kind = F.element_at(F.array(*[F.lit(t) for t in TYPES]), (k % 7 + 1).cast("int"))
    good = X.digest(s("user_id"))
    shown = F.when(k % 3 == 0, X.digest(s(k))).otherwise(good)
    when = lambda types, c: F.when(kind.isin(*types), c)
    having = lambda f: [t for t, fs in E.FIELDS.items() if f in fs]
    value = F.floor("value").cast("bigint")
    return table(spark, sf, "events").select(
        F.when(F.lit(flaws) & (k % 17 == 0), F.lit("Run 1")).otherwise(run).alias("run_id"),
        k.alias("seq"),
        F.date_format("ts", "yyyy-MM-dd").alias("occurred_at"),
        kind.alias("record_type"),
        when(having("param_digests"), F.create_map(F.lit("p"), good)).alias("param_digests"),
        when(having("stage_id"), F.col("event_type")).alias("stage_id"),
        when(having("outcome"), F.when(F.lit(flaws) & (k % 5 == 0), "maybe").when(k % 2 == 0, "succeeded").otherwise("failed")).alias("outcome"),
        when(having("reused_from_run_id"), F.lit("run-0")).alias("reused_from_run_id"),
        when(having("fingerprint"), F.when(k % 4 == 0, X.digest(s(k))).otherwise(X.reuse_fingerprint(F.col("event_type"), F.lit("run-0")))).alias("fingerprint"),
        when(having("prerequisite_id"), F.concat(F.lit("pre-"), s(k % 3))).alias("prerequisite_id"),
        when(having("observed_digest"), F.when(F.lit(flaws) & (k % 5 == 1), "sha256:00").otherwise(shown)).alias("observed_digest"),
        when(having("satisfied"), k % 2 == 0).alias("satisfied"),
        when(having("reason"), F.lit("late")).alias("reason"),
        when(having("metric_id"), F.concat(F.lit("m"), s(k % 4))).alias("metric_id"),
        when(having("value"), F.when(F.lit(flaws) & (k % 3 == 0), F.lit(-1)).otherwise(value)).alias("value"),
        when(having("artifact_id"), F.concat(F.lit("art-"), s(k % 5))).alias("artifact_id"),
        when(having("intended_digest"), good).alias("intended_digest"),
    )


def evidence_validate(spark: SparkSession, sf: str) -> DataFrame:
    return E.evidence_violations(records(spark, sf, True)).select("seq", F.array_join("violations", ",").alias("violations"))


def evidence_append(spark: SparkSession, sf: str) -> DataFrame:
    path, r = workspace(spark, "evidence"), records(spark, sf)
    for k in range(2):
        E.append_evidence(r.filter(F.col("seq") % 2 == k), path)
    return E.read_evidence(spark, path).select("run_id", "seq", "record_type", "stage_id", "value", "problem")


def evidence_strict_parse(spark: SparkSession, sf: str) -> DataFrame:
    r = records(spark, sf)
    odd = F.when(F.col("seq") % 11 == 0, "mystery").otherwise(F.col("record_type"))
    line = F.to_json(F.struct("run_id", "seq", "occurred_at", odd.alias("record_type"), *[F.col(c) for c in r.columns[4:]], F.when(F.col("seq") % 13 == 0, F.lit(1)).alias("surprise")))
    lines = r.select("seq", F.when(F.col("seq") % 19 == 0, F.lit("not json")).otherwise(line).alias("value"))
    return E.parse_evidence(lines).groupBy(F.coalesce("problem", F.lit("none")).alias("problem")).agg(F.count(F.lit(1)).alias("n"))


def evidence_summary(spark: SparkSession, sf: str) -> DataFrame:
    return E.run_summary(records(spark, sf))


def manifest_projection(spark: SparkSession, sf: str) -> DataFrame:
    overlay = table(spark, sf, "events").filter("user_id % 3 = 0").select(F.concat(F.lit("run-"), s("user_id")).alias("run_id"), F.col("event_type").alias("stage_id"), F.lit("running").alias("status")).distinct()
    return E.phase_status(records(spark, sf), overlay)


def prerequisite_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return E.prerequisite_records(table(spark, sf, "events").select(s("user_id").alias("run_id"), F.col("event_type").alias("stage_id"), s("event_id").alias("prerequisite_id"), (F.col("event_id") % 3 != 0).alias("satisfied")))


def missing_metrics(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    metrics = e.select(s("user_id").alias("run_id"), F.col("event_type").alias("stage_id"), F.concat(F.lit("m"), s(F.col("event_id") % 5)).alias("metric_id")).distinct()
    contract = e.select(F.col("event_type").alias("stage_id")).distinct().select("stage_id", F.explode(F.array(F.lit("m0"), F.lit("m1"), F.lit("m2"), F.lit("m9"))).alias("metric_id"))
    return E.metric_gaps(metrics, contract)


def artifact_validity(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_id")
    return E.artifact_status(table(spark, sf, "events").select(k, X.digest(s("user_id")).alias("intended_digest"), F.when(k % 4 == 0, None).when(k % 4 == 1, X.digest(s(k))).otherwise(X.digest(s("user_id"))).alias("observed_digest"))).select("event_id", "status")


def resume_lineage(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    return E.phase_origin(o.select(s(k).alias("run_id"), F.lit("load").alias("stage_id"), F.when(k % 4 == 1, s(k - 1)).when(k % 4 == 2, s(k - 2)).alias("satisfied_by")))


def reuse_verify(spark: SparkSession, sf: str) -> DataFrame:
    return E.verify_reuse(records(spark, sf).filter("record_type = 'stage_reused'")).select("seq", "verified")


def gate_halt_rollup(spark: SparkSession, sf: str) -> DataFrame:
    line = table(spark, sf, "lineitem").filter("l_linenumber IS NOT NULL")
    results = line.groupBy(F.col("l_orderkey").alias("run"), F.col("l_returnflag").alias("stage"), F.col("l_linenumber").alias("gate_no")).agg(F.min("l_partkey").alias("p"))
    ordinal = F.when(F.col("stage") == "N", 1).when(F.col("stage") == "A", 2).otherwise(3)
    return G.gate_rollup(results.select("run", "stage", ordinal.alias("ordinal"), "gate_no", F.concat(F.lit("g"), s("gate_no")).alias("gate"), (F.col("p") % 3 != 0).alias("passed")))


def task_exit_rollup(spark: SparkSession, sf: str) -> DataFrame:
    line = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("task"), F.col("l_linenumber").alias("ordinal")).agg(F.min("l_partkey").alias("p"))
    return G.task_exit(line.select("task", "ordinal", F.when(F.col("p") % 10 == 0, None).when(F.col("p") % 10 < 3, F.col("p") % 10).otherwise(0).alias("code")))


def lease_audit(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    k = F.col("event_id")
    return G.lease_audit(e.select(F.col("user_id").alias("lease"), k.alias("seq"), (k % 3).alias("owner"), F.floor(k / 7).alias("token"), k.alias("at"), (k + k % 50).alias("until")))


def listing_parse(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    line = F.when(k % 9 == 0, F.concat(F.lit("-----Orders, Code "), s(k))).otherwise(F.concat(F.lit(" "), s(k), F.lit(" of 99 - P."), s(k), F.lit(".D250101 (24.35 MB) Last Updated: "), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")))
    lines = table(spark, sf, "orders").select(line.alias("value"))
    files = ST.parse_listing(lines).select("n", "filename", "last_updated")
    return files.unionByName(ST.parse_codes(lines).select(F.col("code").alias("n"), F.col("title").alias("filename"), F.lit(None).cast("string").alias("last_updated")))


def _state(spark: SparkSession, sf: str) -> DataFrame:
    """A nested state document for each of many customers: years, codes and files of their orders."""
    k = F.col("o_orderkey")
    record = F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("last_updated"), F.lit("d").alias("downloaded_at"), F.when(k % 2 == 0, F.lit("u")).alias("uploaded_at"), F.when(k % 3 == 0, F.lit("new")).alias("remote_prefix"), F.lit("old").alias("s3_prefix"))
    o = table(spark, sf, "orders").filter("o_orderkey % 5 <> 0").select(s("o_custkey").alias("org"), F.date_format("o_orderdate", "yyyy").alias("year"), F.col("o_orderstatus").alias("code"), F.concat(F.lit("f"), s(k)).alias("filename"), record.alias("r"))
    pack = lambda keys, key, value: (lambda df: df.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(key, value))).alias("m")))
    files = pack(["org", "year", "code"], "filename", "r")(o)
    codes = pack(["org", "year"], "code", "m")(files)
    years = pack(["org"], "year", "m")(codes)
    doc = F.struct(F.lit("now").alias("last_run"), F.create_map("org", "m").alias("downloaded"))
    return ST.flatten_state(years.select(F.to_json(doc).alias("value")))


def state_flatten(spark: SparkSession, sf: str) -> DataFrame:
    return _state(spark, sf)


def _listed(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select(s("o_custkey").alias("org"), F.date_format("o_orderdate", "yyyy").alias("year"), F.col("o_orderstatus").alias("code"), F.concat(F.lit("f"), s(k)).alias("filename"), F.when(k % 7 == 0, "newer").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("last_updated"))


def state_diff(spark: SparkSession, sf: str) -> DataFrame:
    return ST.new_remote_files(_listed(spark, sf), _state(spark, sf), require_upload=True).select("filename", "last_updated")


def oldest_new_cutoff(spark: SparkSession, sf: str) -> DataFrame:
    stamp = F.when(F.col("o_orderkey") % 1000 == 0, "259999").otherwise(F.date_format("o_orderdate", "yyMMdd"))
    return ST.creation_cutoff(table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("year"), F.col("o_orderstatus").alias("code"), F.concat(F.lit("P.D"), stamp, F.lit(".x")).alias("a"), F.concat(F.lit("P.A.D"), stamp, F.lit(".T1")).alias("filename")))


def _runs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(s("o_orderkey").alias("run_id"), F.col("o_orderdate").alias("modified"))


def latest_run(spark: SparkSession, sf: str) -> DataFrame:
    runs = table(spark, sf, "orders").select(F.col("o_custkey").alias("dir"), F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").alias("modified"))
    return E.latest_run(runs, "dir")


def runs_top_n(spark: SparkSession, sf: str) -> DataFrame:
    return E.latest_runs(_runs(spark, sf), 20).select("run_id", F.date_format("modified", "yyyy-MM-dd").alias("day"))


QUERIES = {f.__name__: f for f in (
    label_normalize, path_lineage, filename_date_parse, quarter_end_date, workbook_path_metadata, delivery_quarantine, location_audit, redact_url,
    digest_fingerprint, identity_audit, output_contract_diff, placement_lookup, source_columns_diff, schema_conformance, readiness_gates,
    evidence_validate, evidence_append, evidence_strict_parse, evidence_summary, manifest_projection, prerequisite_blocks, missing_metrics,
    artifact_validity, resume_lineage, reuse_verify, gate_halt_rollup, task_exit_rollup, lease_audit, listing_parse, state_flatten, state_diff,
    oldest_new_cutoff, latest_run, runs_top_n,
)}

_PATHS = """
    WITH o AS (SELECT o_orderkey AS k, o_orderdate AS d, strftime(o_orderdate, '%Y') AS y,
                      CASE WHEN o_orderkey % 4 = 0 THEN '259999' WHEN o_orderkey % 4 = 1 THEN '250230' ELSE strftime(o_orderdate, '%y%m%d') END AS stamp FROM orders),
    n AS (SELECT *, CASE WHEN k % 3 = 0 THEN 'P.A1.B.' || y || 'Q' || (k % 5 + 1) || '.D' || stamp || '.T' || lpad((k % 9999999)::VARCHAR, 7, '0') || '.xlsx'
                         ELSE 'P.A1.B.Y' || y || '.' || k || CASE WHEN k % 2 = 0 THEN '.D250101.txt' ELSE '.csv' END END AS name FROM o),
    p AS (SELECT *, '/store/A1/' || y || '/A1/' || CASE WHEN k % 7 = 0 THEN 'x' ELSE y END || '/' || name AS file_path FROM n)
"""
_QUARTER = "CASE WHEN {n} BETWEEN 1 AND 4 THEN last_day(make_date({y}::INT, ({n} * 3)::INT, 1)) END"
_RUNS = """
    WITH e AS (SELECT *, event_id AS k, 'run-' || user_id AS run, ['run_started', 'stage_attempted', 'stage_reused', 'prerequisite_checked', 'stage_blocked',
                      'metric_observed', 'artifact_observed'][event_id % 7 + 1] AS t FROM events)
"""
_STATE = """
    WITH st AS (SELECT o_custkey::VARCHAR AS org, strftime(o_orderdate, '%Y') AS year, o_orderstatus AS code, 'f' || o_orderkey AS filename, strftime(o_orderdate, '%Y-%m-%d') AS last_updated,
                       'd' AS downloaded_at, CASE WHEN o_orderkey % 2 = 0 THEN 'u' END AS uploaded_at, CASE WHEN o_orderkey % 3 = 0 THEN 'new' ELSE 'old' END AS remote_prefix
                FROM orders WHERE o_orderkey % 5 <> 0)
"""

ORACLES = {
    "label_normalize": r"""
        WITH a AS (SELECT doc_id, trim(regexp_replace(chr(32) || chr(160) || text || ' [12] ', '[\s\x{a0}\x0b]+', ' ', 'g')) AS t FROM documents)
        SELECT doc_id, nullif(trim(regexp_replace(t, '\s*\[[0-9]+\]$', '')), '') AS label FROM a""",
    "path_lineage": _PATHS + r"""
        SELECT file_path, regexp_extract(file_path, '^(.*)/', 1) AS directory_name, name AS file_name,
               try_strptime('20' || regexp_extract(file_path, '\.D([0-9]{6})\.', 1), '%Y%m%d')::DATE AS file_date FROM p""",
    "filename_date_parse": _PATHS + r"SELECT file_path, try_strptime('20' || regexp_extract(name, '\.D([0-9]{6})\.', 1), '%Y%m%d')::DATE AS created FROM p",
    "quarter_end_date": f"SELECT o_orderkey, {_QUARTER.format(n='(o_orderkey % 6)', y='year(o_orderdate)')} AS ends FROM orders",
    "workbook_path_metadata": _PATHS + f"""
        SELECT file_path, CASE WHEN k % 3 = 0 THEN {_QUARTER.format(n='(k % 5 + 1)', y='y')} END AS file_date, 'A1' AS aco_id, CASE WHEN k % 7 = 0 THEN y ELSE y END AS performance_year,
               CASE WHEN k % 3 <> 0 THEN y END AS benchmark_year, CASE WHEN k % 3 = 0 THEN lpad((k % 9999999)::VARCHAR, 7, '0') END AS submission_id,
               CASE WHEN k % 3 = 0 AND k % 5 < 4 THEN y || 'Q' || (k % 5 + 1) END AS period FROM p""",
    "delivery_quarantine": _PATHS + "SELECT file_path, CASE WHEN k % 3 = 0 THEN 'accepted' ELSE 'quarantined' END AS status FROM p",
    "location_audit": r"""
        WITH u AS (SELECT page_id, CASE page_id % 6 WHEN 0 THEN url || '/../x' WHEN 1 THEN url || '/*.csv' WHEN 2 THEN regexp_replace(url, '^https?', 'ftp') WHEN 3 THEN ''
                          WHEN 4 THEN replace(url, '://', '://u:p@') ELSE url END AS l FROM pages)
        SELECT page_id, concat_ws(',', CASE WHEN l = '' THEN 'blank' END, CASE WHEN NOT regexp_matches(l, '^(s3|az|azure|abfss|gs|https?)://') THEN 'scheme' END,
               CASE WHEN regexp_matches(l, '(^|/)\.\.(/|$)') THEN 'traversal' END, CASE WHEN regexp_matches(l, '[*?\[\]{}]') THEN 'glob' END,
               CASE WHEN regexp_matches(l, '[?#]') THEN 'query' END, CASE WHEN regexp_matches(l, '://[^/]*@') THEN 'credentials' END) AS violations FROM u""",
    "redact_url": r"SELECT page_id, 'get ' || regexp_replace(url, '[?#].*$', '') || ' now' AS line FROM pages",
    "digest_fingerprint": "SELECT event_id, 'sha256:' || sha256(props) AS props_digest, 'sha256:' || sha256(event_type || '|' || user_id) AS fingerprint FROM events",
    "identity_audit": """
        SELECT s_suppkey AS k, concat_ws(',', CASE WHEN s_suppkey % 3 = 0 THEN 'image' END, CASE WHEN s_suppkey % 4 = 0 THEN 'revision' END, CASE WHEN s_suppkey % 5 = 0 THEN 'commit' END) AS violations FROM supplier""",
    "output_contract_diff": """
        WITH p AS (SELECT p_partkey AS k, 't' || p_partkey AS name FROM part)
        SELECT name, NULL AS key, CASE WHEN k % 7 = 0 THEN 'missing' ELSE 'unexpected' END AS violation FROM p WHERE (k % 5 <> 0) <> (k % 7 <> 0)
        UNION ALL SELECT name, 'schema', 'value_drift' FROM p WHERE k % 5 <> 0 AND k % 7 <> 0 AND k % 3 = 0
        UNION ALL SELECT name, 'table', 'key_missing' FROM p WHERE k % 5 <> 0 AND k % 7 <> 0 AND k % 4 = 0
        UNION ALL SELECT name, 'secret', 'key_unexpected' FROM p WHERE k % 5 <> 0 AND k % 7 <> 0 AND k % 4 = 0
        UNION ALL SELECT name, 'secret', 'forbidden' FROM p WHERE k % 7 <> 0 AND k % 4 = 0""",
    "placement_lookup": """
        SELECT 't' || p_partkey AS name, CASE WHEN p_partkey % 3 <> 0 AND p_partkey % 2 = 0 THEN upper(p_brand) WHEN p_partkey % 5 = 0 THEN 'aa' ELSE 'zz' END AS schema
        FROM part WHERE p_partkey % 3 <> 0 OR p_partkey % 5 = 0""",
    "source_columns_diff": """
        WITH w AS (SELECT DISTINCT 't' || l_orderkey AS t, 'c' || l_linenumber AS c FROM lineitem WHERE l_returnflag <> 'A'),
        d AS (SELECT DISTINCT 't' || l_orderkey AS t, 'c' || l_linenumber AS c FROM lineitem WHERE l_returnflag <> 'R')
        SELECT t AS "table", 'not_written' AS violation, string_agg(c, ',' ORDER BY c) AS columns FROM (SELECT * FROM d EXCEPT SELECT * FROM w) WHERE c <> 'c7' GROUP BY t
        UNION ALL SELECT t, 'not_declared', string_agg(c, ',' ORDER BY c) FROM (SELECT * FROM w EXCEPT SELECT * FROM d) WHERE c <> 'c7' GROUP BY t""",
    "schema_conformance": """
        WITH p AS (SELECT p_partkey AS k, 't' || p_partkey AS t FROM part)
        SELECT t AS "table", 3 AS ordinal, 'absent' AS violation FROM p WHERE k % 5 = 0 UNION ALL SELECT t, 2, 'name' FROM p WHERE k % 7 = 0
        UNION ALL SELECT t, 1, 'type' FROM p WHERE k % 11 = 0 UNION ALL SELECT t, NULL, 'no_rows' FROM p WHERE k % 2 = 1 AND k % 9 = 0""",
    "readiness_gates": """
        WITH g AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 6 <> 0 THEN c_mktsegment END AS expected,
                          CASE WHEN c_custkey % 4 <> 0 THEN CASE WHEN c_custkey % 3 = 0 THEN 'other' ELSE c_mktsegment END END AS observed FROM customer)
        SELECT 'g' || k AS gate, k AS ordinal, expected, observed, expected IS NOT DISTINCT FROM observed AS ready FROM g""",
    "evidence_validate": _RUNS + """
        SELECT k AS seq, concat_ws(',', CASE WHEN k % 17 = 0 THEN 'run_id' END, CASE WHEN t IN ('prerequisite_checked', 'artifact_observed') AND k % 5 = 1 THEN 'observed_digest' END,
               CASE WHEN t = 'stage_attempted' AND k % 5 = 0 THEN 'outcome' END, CASE WHEN t = 'metric_observed' AND (k % 3 = 0 OR floor(value) < 0) THEN 'value' END) AS violations FROM e""",
    "evidence_append": _RUNS + """
        SELECT run AS run_id, k AS seq, t AS record_type, CASE WHEN t LIKE 'stage%' OR t = 'metric_observed' THEN event_type END AS stage_id,
               CASE WHEN t = 'metric_observed' THEN floor(value)::BIGINT END AS value, NULL AS problem FROM e""",
    "evidence_strict_parse": _RUNS + """
        SELECT CASE WHEN k % 19 = 0 THEN 'not_json' WHEN k % 11 = 0 THEN 'unknown_type' WHEN k % 13 = 0 THEN 'unknown_field' ELSE 'none' END AS problem, count(*) AS n FROM e GROUP BY 1""",
    "evidence_summary": _RUNS + """
        , r AS (SELECT run AS run_id, k, CASE WHEN t LIKE 'stage%' THEN 'stage' WHEN t = 'prerequisite_checked' THEN 'prerequisite' WHEN t = 'metric_observed' THEN 'metric' WHEN t = 'artifact_observed' THEN 'artifact' END AS kind,
               CASE WHEN t LIKE 'stage%' THEN event_type WHEN t = 'prerequisite_checked' THEN 'pre-' || (k % 3) WHEN t = 'metric_observed' THEN event_type || '/m' || (k % 4) ELSE 'art-' || (k % 5) END AS key,
               CASE t WHEN 'stage_attempted' THEN CASE WHEN k % 2 = 0 THEN 'succeeded' ELSE 'failed' END WHEN 'stage_reused' THEN 'reused' WHEN 'stage_blocked' THEN 'blocked'
                    WHEN 'prerequisite_checked' THEN CASE WHEN k % 2 = 0 THEN 'satisfied' ELSE 'unsatisfied' END WHEN 'metric_observed' THEN (floor(value)::BIGINT)::VARCHAR
                    ELSE CASE WHEN k % 3 = 0 AND k <> user_id THEN 'invalid' ELSE 'valid' END END AS state FROM e WHERE t <> 'run_started')
        SELECT run_id, kind, key, arg_max(state, k) AS state FROM r GROUP BY ALL""",
    "manifest_projection": _RUNS + """
        , d AS (SELECT run AS run_id, event_type AS stage_id, arg_max(CASE WHEN t = 'stage_reused' THEN 'skipped' WHEN k % 2 = 0 THEN 'completed' ELSE 'failed' END, k) AS s
                FROM e WHERE t IN ('stage_attempted', 'stage_reused') GROUP BY ALL),
        o AS (SELECT DISTINCT run AS run_id, event_type AS stage_id, 'running' AS p FROM e WHERE user_id % 3 = 0)
        SELECT run_id, stage_id, coalesce(s, p) AS status FROM d FULL JOIN o USING (run_id, stage_id)""",
    "prerequisite_blocks": "SELECT user_id::VARCHAR AS run_id, event_type AS stage_id, count(*) AS n_checked, count(*) FILTER (event_id % 3 = 0) AS n_blocked, bool_and(event_id % 3 <> 0) AS ready FROM events GROUP BY 1, 2",
    "missing_metrics": """
        WITH m AS (SELECT DISTINCT user_id::VARCHAR AS run_id, event_type AS stage_id, 'm' || (event_id % 5) AS metric_id FROM events),
        w AS (SELECT run_id, stage_id, unnest(['m0', 'm1', 'm2', 'm9']) AS metric_id FROM (SELECT DISTINCT run_id, stage_id FROM m))
        SELECT *, 'missing' AS gap FROM (SELECT * FROM w EXCEPT SELECT * FROM m) UNION ALL SELECT *, 'undeclared' FROM (SELECT * FROM m WHERE metric_id IN ('m3', 'm4'))""",
    "artifact_validity": "SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'unobserved' WHEN 1 THEN CASE WHEN event_id = user_id THEN 'valid' ELSE 'invalid' END ELSE 'valid' END AS status FROM events",
    "resume_lineage": """
        SELECT o.o_orderkey::VARCHAR AS run_id, 'load' AS stage_id, CASE WHEN o.o_orderkey % 4 = 1 THEN (o.o_orderkey - 1)::VARCHAR WHEN o.o_orderkey % 4 = 2 THEN (o.o_orderkey - 2)::VARCHAR
               ELSE o.o_orderkey::VARCHAR END AS origin FROM orders o""",
    "reuse_verify": _RUNS + "SELECT k AS seq, k % 4 <> 0 AS verified FROM e WHERE t = 'stage_reused'",
    "gate_halt_rollup": """
        WITH r AS (SELECT l_orderkey AS run, l_returnflag AS stage, l_linenumber AS g, min(l_partkey) % 3 <> 0 AS ok FROM lineitem GROUP BY 1, 2, 3),
        st AS (SELECT run, stage, CASE stage WHEN 'N' THEN 1 WHEN 'A' THEN 2 ELSE 3 END AS ordinal, 'g' || min(CASE WHEN NOT ok THEN g END) AS first_failed FROM r GROUP BY ALL)
        SELECT *, coalesce(bool_or(first_failed IS NOT NULL) OVER (PARTITION BY run ORDER BY ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS halted FROM st""",
    "task_exit_rollup": """
        WITH l AS (SELECT l_orderkey AS task, l_linenumber AS o, min(l_partkey) % 10 AS p FROM lineitem GROUP BY 1, 2)
        SELECT task, CASE WHEN count(*) FILTER (p < 3) = 0 THEN 'succeeded' ELSE 'failed' END AS status, arg_min(p, o) FILTER (p IN (1, 2)) AS code FROM l GROUP BY 1""",
    "lease_audit": """
        WITH e AS (SELECT user_id AS lease, event_id AS seq, event_id % 3 AS o, event_id // 7 AS tk, event_id + event_id % 50 AS u, lag(event_id % 3) OVER w AS po, lag(event_id // 7) OVER w AS pt,
                          lag(event_id + event_id % 50) OVER w AS pu FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
        SELECT lease, seq, CASE WHEN seq < pu THEN 'overlap' ELSE 'token' END AS violation FROM e WHERE o <> po AND (seq < pu OR tk <= pt)""",
    "listing_parse": """
        SELECT o_orderkey AS n, CASE WHEN o_orderkey % 9 = 0 THEN 'Orders' ELSE 'P.' || o_orderkey || '.D250101' END AS filename,
               CASE WHEN o_orderkey % 9 <> 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS last_updated FROM orders""",
    "state_flatten": _STATE + "SELECT * FROM st",
    "state_diff": _STATE + """
        SELECT 'f' || o_orderkey AS filename, CASE WHEN o_orderkey % 7 = 0 THEN 'newer' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS last_updated
        FROM orders WHERE o_orderkey % 7 = 0 OR o_orderkey % 5 = 0 OR o_orderkey % 2 = 1""",
    "oldest_new_cutoff": """
        SELECT strftime(o_orderdate, '%Y-%m') AS year, o_orderstatus AS code, CASE WHEN count(*) FILTER (o_orderkey % 1000 = 0) = 0 THEN min(make_date(2000 + year(o_orderdate)::INT % 100, month(o_orderdate)::INT, day(o_orderdate)::INT)) END AS cutoff FROM orders GROUP BY 1, 2""",
    "latest_run": "SELECT o_custkey AS dir, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS run_id FROM orders GROUP BY 1",
    "runs_top_n": "SELECT o_orderkey::VARCHAR AS run_id, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders ORDER BY o_orderdate DESC, o_orderkey::VARCHAR DESC LIMIT 20",
}
