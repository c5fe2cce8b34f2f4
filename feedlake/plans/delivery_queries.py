"""Queries over deliveries as files: ledgers, archives by ranges, streams, families, external and mounted stores."""

from __future__ import annotations

import uuid
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake import fixtures, sinks
from feedlake.operators import evidence as E
from feedlake.operators import governance as G
from feedlake.operators import ledger as L
from feedlake.operators import naming
from feedlake.operators.ingest import ingest, ingest_sheets
from feedlake.sources import csv_feed, listing, store, zip_feed
from feedlake.streaming.ingest import stream_ingest
from feedlake.workspace import table, workspace

from .defs import Feed, Layout, Sheet, read_layouts
from .families import families
from .governance_queries import ORACLES as GOVERNANCE
from .governance_queries import records

ORG = "A0001"
LAYOUTS = Path(__file__).resolve().parents[2] / "FIXTURES.md"
SEGMENT_FILES = Feed("segments", "A*.zip", "zip_csv", member="P.*.csv", dates="load", batch=7)


def _family(name: str, layouts: bool = False) -> dict[str, Feed]:
    return {f.name: f for f in families(ORG, read_layouts(str(LAYOUTS)) if layouts else {})[name]}


def _cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


def _segment_archives(spark: SparkSession, sf: str, first: bool = False) -> DataFrame:
    """(path, content): archives of 500 customers with a CSV member for each segment, or at first for two of them."""

    def members(frame: pd.DataFrame) -> dict[str, str]:
        out = {"Data Dictionary P.x.csv": "a,b\n1,2\n"}
        for segment, part in frame.groupby("c_mktsegment"):
            if not first or segment in ("BUILDING", "MACHINERY"):
                extra = ["balance"] if segment == "BUILDING" else []
                out[f"P.{segment.lower()}.csv"] = part.sort_values("c_custkey")[["c_custkey", "c_name", *extra]].to_csv(index=False)
        return out

    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", _cents("c_acctbal").alias("balance"), F.floor(F.col("c_custkey") / 500).alias("g"))
    return fixtures.archives(c, "g", lambda k: f"A{k:05d}.zip", members)


def incremental_members(spark: SparkSession, sf: str) -> DataFrame:
    """An archive that gains members after it was loaded: these are loaded, the others aren't again."""
    root, target = workspace(spark, "members"), workspace(spark, "target")
    fixtures.write_files(_segment_archives(spark, sf, first=True), root)
    early = ingest(spark, SEGMENT_FILES, root, target)
    fixtures.write_files(_segment_archives(spark, sf), root)
    ingest(spark, SEGMENT_FILES, root, target)
    again = ingest(spark, SEGMENT_FILES, root, target)
    rows = L.read_table(spark, target)
    return rows.select("C_CUSTKEY", "C_NAME", "BALANCE", F.regexp_extract("file_name", "[^!]+$", 0).alias("member"), (F.lit(early) > 0).alias("loaded_early"), F.lit(again).cast("bigint").alias("loaded_again")).transform(naming.rename_columns)


def incremental_no_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A file for each nation with its rich customers: files without rows are in the ledger, and aren't read again."""
    root, target = workspace(spark, "rich"), workspace(spark, "target")
    rich = table(spark, sf, "customer").filter("c_acctbal > 9500").select("c_nationkey", F.concat_ws(",", "c_custkey", "c_name").alias("line"))
    lines = rich.groupBy("c_nationkey").agg(F.array_join(F.sort_array(F.collect_list("line")), "\n").alias("lines"))
    files = table(spark, sf, "nation").join(lines, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    text = F.concat_ws("\n", F.lit("custkey,name"), "lines", F.lit(""))
    fixtures.write_files(files.select(F.format_string("N%d.csv", "n_nationkey").alias("path"), text.alias("content")), root)
    feed = Feed("rich", "N*.csv", "csv", dates="load", batch=10)
    ingest(spark, feed, root, target)
    again = ingest(spark, feed, root, target)
    known = L.read_ledger(spark, target)
    return known.select(F.regexp_extract("file_path", r"N(\d+)\.csv$", 1).cast("bigint").alias("nationkey"), "n_rows", F.lit(again).cast("bigint").alias("loaded_again"))


def zip_member_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Members of archive files by the data source of ranges, a task for every two kilobytes of them, up to `zip_feed.TASKS` tasks."""
    root = workspace(spark, "ranges")
    fixtures.write_files(_segment_archives(spark, sf), root)
    archives = zip_feed.read_archives(spark, f"{root}/*.zip")
    found = zip_feed.list_members(archives).filter("member LIKE 'P.%'").join(archives, F.col("archive") == F.col("path"))
    members = sorted(tuple(r) for r in found.select("source", "archive", "member", "packed").collect())
    rows = zip_feed.scan_members(spark, members, part_bytes=2048).filter("row_no > 0")
    return rows.select(F.regexp_extract("archive", r"A\d+", 0).alias("archive"), "member", "row_no", F.col("cells")[0].alias("custkey"), F.size("cells").cast("bigint").alias("n_cells"))


def csv_blank_lead(spark: SparkSession, sf: str) -> DataFrame:
    """Blank lines ahead of a header whose last column has no name."""
    root = workspace(spark, "blank")
    text = F.concat_ws("\n", F.lit("\n\ns_suppkey,s_name,"), F.array_join(F.sort_array(F.collect_list(F.concat_ws(",", "s_suppkey", "s_name", F.lit("")))), "\n"))
    s = table(spark, sf, "supplier").groupBy("s_nationkey").agg(text.alias("content"))
    fixtures.write_files(s.select(F.format_string("S%d.csv", "s_nationkey").alias("path"), "content"), root)
    return naming.rename_columns(csv_feed.read_csv_union(spark, root).drop("file_path"))


def csv_quoted(spark: SparkSession, sf: str) -> DataFrame:
    """Fields with commas, doubled quotes, line ends and, unquoted, a stray quote."""
    root = workspace(spark, "quoted")
    note = F.concat(F.lit('"'), "p_type", F.lit(', ""'), "p_brand", F.lit('""\n'), "p_name", F.lit('"'))
    line = F.concat_ws(",", "p_partkey", F.concat(F.col("p_size").cast("string"), F.lit('" wide')), note)
    p = table(spark, sf, "part").groupBy(F.floor(F.col("p_partkey") / 500).alias("g")).agg(F.concat_ws("\n", F.lit("partkey,size,note"), F.array_join(F.collect_list(line), "\n")).alias("content"))
    fixtures.write_files(p.select(F.format_string("P%d.csv", "g").alias("path"), "content"), root)
    return naming.rename_columns(csv_feed.read_csv_union(spark, root).drop("file_path"))


def refresh_replaces_whole(spark: SparkSession, sf: str) -> DataFrame:
    """A refresh that fails in its second batch leaves the table as it was; the next one replaces it whole."""
    root, target = workspace(spark, "refresh"), workspace(spark, "target")
    text = lambda rows: rows.groupBy("c_mktsegment").agg(F.concat_ws("\n", F.lit("custkey,segment"), F.array_join(F.collect_list(F.concat_ws(",", "c_custkey", "c_mktsegment")), "\n")).alias("content"))
    c, feed = table(spark, sf, "customer"), Feed("customers", "*.csv", "csv", dates="load", batch=2)
    fixtures.write_files(text(c.filter("c_custkey % 2 = 0")).select(F.concat("c_mktsegment", F.lit(".csv")).alias("path"), "content"), root)
    ingest(spark, feed, root, target)
    fixtures.write_files(text(c).select(F.concat("c_mktsegment", F.lit(".csv")).alias("path"), "content"), root)
    count = lambda: L.read_table(spark, target).filter("CUSTKEY % 2 = 1").count()
    calls = []

    def reader(session: SparkSession, paths: list[str]) -> DataFrame:
        calls.append(paths)
        if len(calls) > 1:
            raise OSError("the store is gone")
        return csv_feed.read_csv_union(session, paths)

    try:
        ingest(spark, feed, root, target, refresh=True, reader=reader)
    except OSError:
        kept = count()
    ingest(spark, feed, root, target, refresh=True)
    rows = L.read_table(spark, target)
    return rows.select(F.col("CUSTKEY").cast("bigint").alias("custkey"), F.col("SEGMENT").alias("segment"), F.lit(kept).cast("bigint").alias("odd_after_failure"))


def stream_zip(spark: SparkSession, sf: str) -> DataFrame:
    """A stream of archives; archives that gain members are loaded by a later run without doubles."""
    root, target, checkpoint = workspace(spark, "zips"), workspace(spark, "target"), workspace(spark, "checkpoint")
    fixtures.write_files(_segment_archives(spark, sf, first=True), root)
    stream_ingest(spark, SEGMENT_FILES, root, target, checkpoint, max_files_per_trigger=4)
    fixtures.write_files(_segment_archives(spark, sf), f"{root}/")
    ingest(spark, SEGMENT_FILES, root, target)
    stream_ingest(spark, SEGMENT_FILES, root, target, checkpoint)
    rows = L.read_table(spark, target)
    return naming.rename_columns(rows.select("C_CUSTKEY", "C_NAME", "BALANCE", F.regexp_extract("file_name", "[^!]+$", 0).alias("member")))


def _annual_books(spark: SparkSession, sf: str, folder: str) -> DataFrame:
    """(path, content): a stamped workbook of 200 suppliers each with two tables and parameters."""

    def sheets(frame: pd.DataFrame) -> dict[str, list[list]]:
        rows = frame.sort_values("s_suppkey")
        main = [["Report"], [None, "Number", "Balance"], ["[A1] All"], *[[r.s_name, int(r.s_suppkey), None if r.s_suppkey % 5 == 0 else int(r.cents)] for r in rows.itertuples()], ["Note: rounded"], ["behind", 1, 2]]
        other = [["Nations", "Key", "Name"], *[[r.s_name, int(r.s_nationkey), f"n{r.s_nationkey}"] for r in rows.itertuples() if r.s_suppkey % 2 == 0]]
        return {"Table_1-Main": main, "Table_3-Other": other + [["none", 0, "n0"]], "Parameters": [["Rows", len(rows)], ["NOTE", "kept"]]}

    s = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey", _cents("s_acctbal").alias("cents"), F.floor(F.col("s_suppkey") / 200).alias("g"))
    return fixtures.workbooks(s, "g", lambda k: f"{ORG}/2025/01/{folder}/P.{ORG}.ACO.AEXPU.Y{2000 + k}.D259999.T1111111.xlsx", sheets)


def family_annual(spark: SparkSession, sf: str) -> DataFrame:
    """All tables of a family of workbooks, each workbook decoded once; by table, label and year."""
    root, base = workspace(spark, "annual"), workspace(spark, "tables")
    fixtures.write_files(_annual_books(spark, sf, f"P.{ORG}.ACO.BNMRK.D259999.T1111111"), root)
    feeds = _family("annual")
    targets = {n: f"{base}/{n}" for n in feeds}
    ingest_sheets(spark, list(feeds.values()), root, targets, ORG)
    again = ingest_sheets(spark, list(feeds.values()), root, targets, ORG)
    parts = [L.read_table(spark, targets[n]).select(F.lit(n).alias("table_name"), "row_label", "section_code", "column_label", "value_text", "benchmark_year") for n in feeds]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("loaded_again", F.lit(sum(again.values())).cast("bigint"))


def family_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Two report tables from the same archives; file paths of members have no mark, file names do."""

    def members(frame: pd.DataFrame) -> dict[str, str]:
        rows = frame.sort_values("c_custkey")
        return {"ALR_x-1.csv": rows[["c_custkey", "c_name"]].to_csv(index=False), "ALR_x-2.csv": rows[rows.c_custkey % 2 == 0][["c_custkey", "c_mktsegment"]].to_csv(index=False)}

    root, base = workspace(spark, "reports"), workspace(spark, "tables")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", F.floor(F.col("c_custkey") / 500).alias("g"))
    fixtures.write_files(fixtures.archives(c, "g", lambda k: f"{ORG}/2025/Q/P.{ORG}.ACO.QEXPU/P.{ORG}.ACO.AALR.D259999.T{k:07d}", members), root)
    feeds, parts = _family("reports"), []
    for name in ("AALR1_ASSIGNED_BENEFICIARIES", "AALR2_ASSIGNED_BENEFICIARIES_TIN"):
        ingest(spark, feeds[name], root, f"{base}/{name}", org=ORG)
        rows = L.read_table(spark, f"{base}/{name}")
        value = F.col("C_NAME") if "C_NAME" in rows.columns else F.col("C_MKTSEGMENT")
        parts.append(rows.select(F.lit(name).alias("table_name"), F.col("C_CUSTKEY").alias("custkey"), value.alias("value"), F.regexp_extract("file_path", r"T\d{7}.*$", 0).alias("path_end"), F.regexp_extract("file_name", r"T\d{7}.*$", 0).alias("name_end")))
    return parts[0].unionByName(parts[1])


def stream_workbook(spark: SparkSession, sf: str) -> DataFrame:
    """A stream of workbooks; one without stamps becomes a row of the side table."""
    root, target, checkpoint = workspace(spark, "books"), workspace(spark, "target"), workspace(spark, "checkpoint")
    folder = f"P.{ORG}.ACO.BNMRK.D259999.T1111111"
    books = _annual_books(spark, sf, folder)
    fixtures.write_files(books, root)
    fixtures.write_files(books.limit(1).select(F.lit(f"{ORG}/2025/01/{folder}/P.{ORG}.ACO.AEXPU.Y1999.backup.xlsx").alias("path"), "content"), root)
    feed = _family("annual")["AEXPU_TABLE_1"]
    for _ in range(2):
        stream_ingest(spark, feed, root, target, checkpoint, max_files_per_trigger=3, org=ORG)
    odd = spark.read.parquet(f"{target}__unstamped").count()
    rows = L.read_table(spark, target)
    return rows.select("row_label", "section_code", "column_label", "value_text", "benchmark_year", F.lit(odd).cast("bigint").alias("n_unstamped"))


def staged_load(spark: SparkSession, sf: str) -> DataFrame:
    """Batches staged as Parquet and loaded into a database once each, however often they come; a truncating one replaces all rows."""
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", "/dev/null")
    url, folder = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true", workspace(spark, "stage")
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    steps = [("old", s.filter("s_suppkey % 3 = 0"), "append"), ("b0", s.filter("s_suppkey % 2 = 0"), "truncate"), ("b1", s.filter("s_suppkey % 2 = 1"), "append"), ("b0", s.filter("s_suppkey % 2 = 0"), "truncate"), ("b1", s.filter("s_suppkey % 2 = 1"), "append")]
    for batch, rows, mode in steps:
        sinks.load_database(spark, sinks.stage(rows, folder, batch), url, "suppliers", batch, mode)
    return naming.rename_columns(spark.read.format("jdbc").option("url", url).option("dbtable", "SUPPLIERS").load())


def mounted_store(spark: SparkSession, sf: str) -> DataFrame:
    """A store behind a mount table: listed, loaded and written by a scheme other than file; what is listed is what is loaded."""
    root = workspace(spark, "store")
    layout = Layout.parse("orders", "orderkey:12, status:1")
    o = table(spark, sf, "orders").select(fixtures.fixed_width_line(layout, {"orderkey": F.col("o_orderkey"), "status": F.col("o_orderstatus")}).alias("value"), F.year("o_orderdate").alias("year"))
    o.repartition("year").write.partitionBy("year").text(f"{root}/in")
    mount = store.mount(spark, f"m{uuid.uuid4().hex[:8]}", {"/in": f"{root}/in", "/out": root})
    feed, target = Feed("orders", "in/year=*/*.txt", layout=layout), f"{mount}/out/table"
    ingest(spark, feed, mount, target)
    again = ingest(spark, feed, mount, target)
    names = listing.discover(spark, mount, feed.glob).select("file_path").withColumn("listed", F.lit(True))
    rows = spark.read.parquet(target).join(names, "file_path", "left")
    return rows.select("orderkey", "status", F.col("file_path").startswith("viewfs://").alias("mounted"), "listed", F.lit(again).cast("bigint").alias("loaded_again"))


def catalog_placement(spark: SparkSession, sf: str) -> DataFrame:
    """Where the catalogue has expected tables, by its own scan."""
    tag = uuid.uuid4().hex[:8]
    spark.sql(f"CREATE DATABASE feedlake_{tag}")
    parts = table(spark, sf, "region")
    names = sorted(r[0] for r in parts.select("r_name").collect())
    for k, n in enumerate(names):
        sinks.write_table(parts.filter(F.col("r_name") == n), f"{f'feedlake_{tag}' if k % 2 else 'default'}.{n.replace(' ', '_')}_{tag}")
    seen = listing.catalog_tables(spark, ["default", f"feedlake_{tag}"]).filter(F.col("table").endswith(tag)).select("table", F.col("database").alias("schema"))
    expected = parts.select(F.concat(F.upper(F.replace(F.col("r_name"), F.lit(" "), F.lit("_"))), F.lit(f"_{tag}")).alias("name"), F.lit(f"feedlake_{tag}").alias("schema"))
    placed = G.locate_outputs(expected, seen)
    return placed.select(F.regexp_replace("name", f"_{tag}$", "").alias("name"), F.regexp_replace("schema", f"_{tag}$", "").alias("schema"))


def summary_with_contract(spark: SparkSession, sf: str) -> DataFrame:
    """Summaries of runs against a contract of six metrics of each stage: those that a run never had are rows."""
    own = records(spark, sf)
    stages = table(spark, sf, "events").select(F.col("event_type").alias("stage_id")).distinct()
    contract = stages.select("stage_id", F.explode(F.array(*[F.lit(f"m{k}") for k in range(6)])).alias("metric_id"))
    rows = E.run_summary(own, contract).filter("kind IN ('metric', 'missing_metric')")
    return rows.select("run_id", "kind", "key")


QUERIES = {f.__name__: f for f in (
    incremental_members, incremental_no_rows, zip_member_ranges, csv_blank_lead, csv_quoted, refresh_replaces_whole, stream_zip, family_annual,
    family_reports, stream_workbook, staged_load, mounted_store, catalog_placement, summary_with_contract,
)}

_MEMBERS = "SELECT c_custkey::VARCHAR AS c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN (round(c_acctbal * 100)::BIGINT)::VARCHAR END AS balance, 'P.' || lower(c_mktsegment) || '.csv' AS member"
_MAIN = """
    SELECT s_name AS row_label, 'A1' AS section_code, 'Number' AS column_label, s_suppkey::VARCHAR AS value_text, (2000 + s_suppkey // 200)::VARCHAR AS benchmark_year FROM supplier
    UNION ALL SELECT s_name, 'A1', 'Balance', CASE WHEN s_suppkey % 5 <> 0 THEN (round(s_acctbal * 100)::BIGINT)::VARCHAR END, (2000 + s_suppkey // 200)::VARCHAR FROM supplier
"""

ORACLES = {
    "incremental_members": f"{_MEMBERS}, true AS loaded_early, 0::BIGINT AS loaded_again FROM customer",
    "incremental_no_rows": "SELECT n_nationkey AS nationkey, count(c_custkey) AS n_rows, 0::BIGINT AS loaded_again FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey AND c_acctbal > 9500 GROUP BY 1",
    "zip_member_ranges": """
        SELECT 'A' || lpad((c_custkey // 500)::VARCHAR, 5, '0') AS archive, 'P.' || lower(c_mktsegment) || '.csv' AS member,
               row_number() OVER (PARTITION BY c_custkey // 500, c_mktsegment ORDER BY c_custkey) AS row_no, c_custkey::VARCHAR AS custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 3 ELSE 2 END::BIGINT AS n_cells FROM customer""",
    "csv_blank_lead": "SELECT s_suppkey::VARCHAR AS s_suppkey, s_name, NULL::VARCHAR AS column2 FROM supplier",
    "csv_quoted": """
        SELECT p_partkey::VARCHAR AS partkey, p_size || '" wide' AS size, p_type || ', "' || p_brand || '"' || chr(10) || p_name AS note FROM part""",
    "refresh_replaces_whole": "SELECT c_custkey AS custkey, c_mktsegment AS segment, 0::BIGINT AS odd_after_failure FROM customer",
    "stream_zip": f"{_MEMBERS} FROM customer",
    "family_annual": f"""
        WITH m AS ({_MAIN}), g AS (SELECT s_suppkey // 200 AS g, count(*) AS n FROM supplier GROUP BY 1),
        a AS (SELECT 'AEXPU_TABLE_1' AS table_name, * FROM m
              UNION ALL SELECT 'AEXPU_TABLE_3', s_name, NULL, 'Key', s_nationkey::VARCHAR, (2000 + s_suppkey // 200)::VARCHAR FROM supplier WHERE s_suppkey % 2 = 0
              UNION ALL SELECT 'AEXPU_TABLE_3', s_name, NULL, 'Name', 'n' || s_nationkey, (2000 + s_suppkey // 200)::VARCHAR FROM supplier WHERE s_suppkey % 2 = 0
              UNION ALL SELECT 'AEXPU_TABLE_3', 'none', NULL, 'Key', '0', (2000 + g)::VARCHAR FROM g UNION ALL SELECT 'AEXPU_TABLE_3', 'none', NULL, 'Name', 'n0', (2000 + g)::VARCHAR FROM g
              UNION ALL SELECT 'AEXPU_PARAMETERS', 'Rows', NULL, 'VALUE', n::VARCHAR, (2000 + g)::VARCHAR FROM g UNION ALL SELECT 'AEXPU_PARAMETERS', 'NOTE', NULL, 'VALUE', 'kept', (2000 + g)::VARCHAR FROM g)
        SELECT *, 0::BIGINT AS loaded_again FROM a""",
    "family_reports": """
        WITH c AS (SELECT *, 'T' || lpad((c_custkey // 500)::VARCHAR, 7, '0') AS t FROM customer)
        SELECT 'AALR1_ASSIGNED_BENEFICIARIES' AS table_name, c_custkey::VARCHAR AS custkey, c_name AS value, t || 'ALR_x-1.csv' AS path_end, t || '!ALR_x-1.csv' AS name_end FROM c
        UNION ALL SELECT 'AALR2_ASSIGNED_BENEFICIARIES_TIN', c_custkey::VARCHAR, c_mktsegment, t || 'ALR_x-2.csv', t || '!ALR_x-2.csv' FROM c WHERE c_custkey % 2 = 0""",
    "stream_workbook": f"SELECT *, 1::BIGINT AS n_unstamped FROM ({_MAIN})",
    "staged_load": "SELECT s_suppkey, s_name FROM supplier",
    "mounted_store": "SELECT o_orderkey::VARCHAR AS orderkey, o_orderstatus AS status, true AS mounted, true AS listed, 0::BIGINT AS loaded_again FROM orders",
    "catalog_placement": """
        WITH r AS (SELECT *, row_number() OVER (ORDER BY r_name) - 1 AS k FROM region)
        SELECT upper(replace(r_name, ' ', '_')) AS name, CASE WHEN k % 2 = 1 THEN 'feedlake' ELSE 'default' END AS schema FROM r""",
    "summary_with_contract": f"""
        WITH m AS (SELECT run_id, key FROM ({GOVERNANCE["evidence_summary"]}) WHERE kind = 'metric'),
        d AS (SELECT run_id, event_type || '/m' || i AS key FROM (SELECT DISTINCT 'run-' || user_id AS run_id FROM events), (SELECT DISTINCT event_type FROM events), (SELECT unnest(range(6)) AS i))
        SELECT run_id, 'metric' AS kind, key FROM m UNION ALL SELECT run_id, 'missing_metric', key FROM (SELECT * FROM d EXCEPT SELECT * FROM m)""",
}
