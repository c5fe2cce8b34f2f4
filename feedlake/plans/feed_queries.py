"""Queries over rendered feeds: fixed width, CSV, archives, XML, workbooks, ingest."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake import fixtures, sinks
from feedlake.functions.text import join_list, ordered_list
from feedlake.operators import ingest as I
from feedlake.operators import naming
from feedlake.operators.readers import cell_grain
from feedlake.operators.sheets import union_by_name, wide_unpivot
from feedlake.sources import csv_feed, fixed_width, listing, workbook, xml_feed, zip_feed
from feedlake.streaming.ingest import stream_ingest
from feedlake.workspace import table, workspace

from .defs import Feed, Layout, Sheet

LINES = Layout.parse("lines", "orderkey:12, linenumber:3, partkey:12, quantity:6, cents:14, flag:1, shipdate:10")
CUSTOMERS = Layout.parse("customers", "custkey:12, name:30, segment:15", header=True)
ORDERS = Layout.parse("orders", "orderkey:12, custkey:12, status:1, orderdate:10")


def cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


def day(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    values = {"orderkey": F.col("l_orderkey"), "linenumber": F.col("l_linenumber"), "partkey": F.col("l_partkey"), "quantity": F.col("l_quantity").cast("int"), "cents": cents("l_extendedprice"), "flag": F.col("l_returnflag"), "shipdate": day("l_shipdate")}
    return table(spark, sf, "lineitem").select(fixtures.fixed_width_line(LINES, values).alias("value"))


def fixed_width_parse(spark: SparkSession, sf: str) -> DataFrame:
    path = workspace(spark, "lines")
    fixtures.write_lines(_lines(spark, sf), path)
    return fixed_width.read_fixed_width(spark, path, LINES).drop("file_path")


def fixed_width_header_skip(spark: SparkSession, sf: str) -> DataFrame:
    path = workspace(spark, "customers")
    values = {"custkey": F.col("c_custkey"), "name": F.col("c_name"), "segment": F.col("c_mktsegment")}
    fixtures.write_lines(table(spark, sf, "customer").select(fixtures.fixed_width_line(CUSTOMERS, values)), path, "FILE SUMMARY")
    return fixed_width.read_fixed_width(spark, path, CUSTOMERS).drop("file_path")


def csv_union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    path, o = workspace(spark, "drift"), table(spark, sf, "orders")
    o.filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus").write.option("header", True).csv(f"{path}/one")
    o.filter("o_orderstatus <> 'F'").select("o_orderstatus", "o_orderpriority", "o_orderkey").write.option("header", True).csv(f"{path}/two")
    return naming.rename_columns(csv_feed.read_csv_union(spark, [f"{path}/one", f"{path}/two"]).drop("file_path"))


def csv_drop_malformed(spark: SparkSession, sf: str) -> DataFrame:
    path = workspace(spark, "ragged")
    line = F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus", F.when(F.col("o_orderkey") % 7 == 0, F.lit("extra")))
    short = F.when(F.col("o_orderkey") % 11 == 0, F.col("o_orderkey").cast("string")).otherwise(line)
    fixtures.write_lines(table(spark, sf, "orders").select(short), path, "orderkey,custkey,status")
    return naming.rename_columns(csv_feed.read_csv_union(spark, path).drop("file_path"))


def csv_normalize_headers(spark: SparkSession, sf: str) -> DataFrame:
    path = workspace(spark, "headers")
    line = F.concat_ws(",", "s_suppkey", "s_name", cents("s_acctbal"))
    fixtures.write_lines(table(spark, sf, "supplier").select(line), path, "Supp Key,Supplier-Name, Acct.Balance (cents)")
    return csv_feed.read_csv_union(spark, path, normalize=True).drop("file_path")


def _archives(spark: SparkSession, sf: str) -> DataFrame:
    """Archives of 500 customers, a CSV member for each segment (one with a column more) and a dictionary."""

    def members(frame: pd.DataFrame) -> dict[str, str]:
        out = {}
        for segment, part in frame.groupby("c_mktsegment"):
            rows = part.sort_values("c_custkey")
            cols = ["c_custkey", "c_name"] + (["balance"] if segment == "BUILDING" else [])
            out[f"P.{segment.lower()}.csv"] = rows[cols].to_csv(index=False)
        out["Data Dictionary building.csv"] = "a,b\n1,2\n"
        return out

    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", cents("c_acctbal").alias("balance"), F.floor(F.col("c_custkey") / 500).alias("g"))
    path = workspace(spark, "archives")
    fixtures.archives(c, "g", lambda k: f"/store/A{k:05d}", members).write.parquet(path)
    return spark.read.parquet(path)


def zip_member_list(spark: SparkSession, sf: str) -> DataFrame:
    return zip_feed.list_members(_archives(spark, sf)).select("archive", "member")


def member_routing(spark: SparkSession, sf: str) -> DataFrame:
    return zip_feed.route_members(zip_feed.list_members(_archives(spark, sf)), "building", 2026).select("archive", "member")


def zip_member_scan(spark: SparkSession, sf: str) -> DataFrame:
    books = _archives(spark, sf)
    members = zip_feed.list_members(books).filter(~F.lower("member").contains("dictionary"))
    return naming.rename_columns(zip_feed.read_zip_csv(books, members))


def member_safety_audit(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("s_suppkey")
    name = F.concat(F.when(k % 5 == 1, "/root/").when(k % 5 == 2, "../").when(k % 5 == 3, "a\\").otherwise("in/"), k.cast("string"))
    members = table(spark, sf, "supplier").select(k.alias("suppkey"), name.alias("member"), F.when(k % 7 == 0, 0o120777).otherwise(0o100644).cast("bigint").alias("attributes"))
    return zip_feed.audit_members(members).select("suppkey", F.array_join("violations", ",").alias("violations"))


XML = "Header struct<HeaderCode:string>, Records struct<Record:array<struct<Key:string,Reasons:struct<Reason:array<string>>>>>"


def _xml(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of a few orders each, a record for each order, a reason for each of its lines."""
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(ordered_list(F.concat("l_returnflag", F.col("l_linenumber").cast("string")), F.col("l_linenumber")).alias("r"))
    orders = table(spark, sf, "orders").select("o_orderkey").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    reasons = F.concat(F.lit("<Reasons>"), F.array_join(F.transform(F.coalesce("r", F.array().cast("array<string>")), lambda x: F.concat(F.lit("<Reason>"), x, F.lit("</Reason>"))), ""), F.lit("</Reasons>"))
    record = F.concat(F.lit("<Record><Key>"), F.col("o_orderkey").cast("string"), F.lit("</Key>"), reasons, F.lit("</Record>"))
    docs = orders.select(F.floor(F.col("o_orderkey") / 32).alias("g"), record.alias("x")).groupBy("g").agg(F.array_join(F.sort_array(F.collect_list("x")), "").alias("x"))
    path = workspace(spark, "xml")
    fixtures.write_lines(docs.select(F.concat(F.lit("<Bundle><Header><HeaderCode>H"), F.col("g").cast("string"), F.lit("</HeaderCode></Header><Records>"), "x", F.lit("</Records></Bundle>"))), path)
    return xml_feed.parse_xml_documents(fixed_width.read_lines(spark, path), "value", XML)


def xml_explode(spark: SparkSession, sf: str) -> DataFrame:
    rows = xml_feed.explode_records(_xml(spark, sf), "Records.Record", "Header")
    return rows.select("key", join_list(F.col("reasons.Reason")).alias("reasons"), "headercode")


def list_string_agg(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(ordered_list(F.when(F.col("l_returnflag") == "R", F.col("l_linenumber").cast("string")), F.col("l_linenumber")).alias("v"))
    return lines.select(F.col("l_orderkey").alias("orderkey"), join_list(F.col("v")).alias("returned"))


def ordered_array_agg(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(ordered_list(F.col("l_partkey").cast("string"), F.col("l_linenumber")).alias("parts"))
    return rows.select(F.col("l_orderkey").alias("orderkey"), F.array_join("parts", "|").alias("parts"))


def _books(spark: SparkSession, sf: str, odd_only: bool = False) -> DataFrame:
    """Workbooks of 200 parts, one sheet for small sizes and one for large; every third part lacks its type."""

    def sheets(frame: pd.DataFrame) -> dict[str, list[list]]:
        out = {}
        for name, part in (("Small", frame[frame.p_size <= 25]), ("Large", frame[frame.p_size > 25])):
            if len(part):
                rows = part.sort_values("p_partkey").itertuples(index=False)
                out[name] = [["PARTKEY", "TYPE", "CENTS"], *([str(r.p_partkey), None if r.p_partkey % 3 == 0 else r.p_type, int(r.cents)] for r in rows)]
        return out

    p = table(spark, sf, "part").select("p_partkey", "p_type", "p_size", cents("p_retailprice").alias("cents"), F.floor(F.col("p_partkey") / 200).alias("g"))
    path = workspace(spark, "books")
    fixtures.workbooks(p.filter("p_partkey % 2 = 1") if odd_only else p, "g", lambda k: f"/store/B{k:05d}.xlsx", sheets).write.parquet(path)
    return spark.read.parquet(path)


def workbook_cells(spark: SparkSession, sf: str) -> DataFrame:
    return workbook.read_cells(_books(spark, sf)).select("file_path", "sheet", "row_num", F.col("col_idx").cast("bigint").alias("col_idx"), "value")


def workbook_sheet_names(spark: SparkSession, sf: str) -> DataFrame:
    return workbook.sheet_names(workbook.read_cells(_books(spark, sf)))


def workbook_sheet_table(spark: SparkSession, sf: str) -> DataFrame:
    return workbook.pivot_header(workbook.read_cells(_books(spark, sf)), "Small", ["partkey", "type", "cents"]).drop("row_num")


def workbook_cell_grain(spark: SparkSession, sf: str) -> DataFrame:
    feed = Feed("parts", "*.xlsx", "sheet", sheet=Sheet("parts", "Small"), dates="stamp")
    grain = cell_grain(workbook.read_cells(_books(spark, sf)), feed, "store")
    return grain.select("row_num", "row_label", "column_label", "value_text", "file_path", "directory_name", "file_name")


def external_sink_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path, s = workspace(spark, "external"), table(spark, sf, "supplier").select("s_suppkey", "s_name")
    for k, mode in enumerate(("overwrite", "append")):
        sinks.external_writer(s.filter(f"s_suppkey % 2 = {k}"), "json", {"path": path, "compression": "gzip"}, mode).save()
    return spark.read.schema("s_suppkey bigint, s_name string").json(path)


def decode_error_rollup(spark: SparkSession, sf: str) -> DataFrame:
    books = _books(spark, sf)
    broken = F.pmod(F.regexp_extract("path", r"B(\d+)", 1).cast("bigint"), F.lit(3)) == 0
    return workbook.decode_errors(workbook.read_cells(books.withColumn("content", F.when(broken, F.lit("not a workbook").cast("binary")).otherwise(F.col("content")))))


def mixed_format_union(spark: SparkSession, sf: str) -> DataFrame:
    old = workbook.read_cells(_books(spark, sf, odd_only=True))
    parts = union_by_name([workbook.pivot_header(old, s, ["partkey", "type"]).select("partkey", "type") for s in ("Small", "Large")])

    def members(frame: pd.DataFrame) -> dict[str, str]:
        return {"P.quality.csv": frame.sort_values("p_partkey")[["p_partkey", "p_brand"]].rename(columns={"p_partkey": "partkey", "p_brand": "brand"}).to_csv(index=False)}

    p = table(spark, sf, "part").filter("p_partkey % 2 = 0").select("p_partkey", "p_brand", F.floor(F.col("p_partkey") / 500).alias("g"))
    path = workspace(spark, "mixed")
    fixtures.archives(p, "g", lambda k: f"/store/Q{k:05d}.zip", members).write.parquet(path)
    new = spark.read.parquet(path)
    csv = zip_feed.read_zip_csv(new, zip_feed.route_members(zip_feed.list_members(new), "quality", 2026))
    return union_by_name([parts, naming.rename_columns(csv.drop("file_path"))])


def discover_files(spark: SparkSession, sf: str) -> DataFrame:
    path = workspace(spark, "listing")
    o = table(spark, sf, "orders").select(F.concat(F.lit("Y"), F.date_format("o_orderdate", "yyyy")).alias("year"), F.col("o_orderkey").cast("string").alias("value"))
    o.repartition("year").write.partitionBy("year").text(path)
    found = listing.discover(spark, path, "year=Y*/*.txt")
    return found.groupBy(F.regexp_extract("file_path", "year=(Y[0-9]+)", 1).alias("year")).agg(F.sum("length").cast("bigint").alias("bytes"))


def _deliveries(spark: SparkSession, sf: str) -> tuple[str, str, DataFrame]:
    """Order files by month below a root; a second delivery adds the later years."""
    root, target = workspace(spark, "orders"), workspace(spark, "target")
    values = {"orderkey": F.col("o_orderkey"), "custkey": F.col("o_custkey"), "status": F.col("o_orderstatus"), "orderdate": day("o_orderdate")}
    o = table(spark, sf, "orders")
    return root, target, o.select(fixtures.fixed_width_line(ORDERS, values).alias("value"), F.date_format("o_orderdate", "yyyyMM").alias("month"), F.year("o_orderdate").alias("y"))


def _deliver(lines: DataFrame, root: str) -> None:
    lines.select("value", "month").repartition("month").write.mode("append").partitionBy("month").text(root)


FEED = Feed("orders", "month=*/*.txt", layout=ORDERS)


def incremental_append(spark: SparkSession, sf: str) -> DataFrame:
    root, target, lines = _deliveries(spark, sf)
    _deliver(lines.filter("y < 1996"), root)
    I.ingest(spark, FEED, root, target)
    I.ingest(spark, FEED, root, target)
    _deliver(lines.filter("y >= 1996"), root)
    I.ingest(spark, FEED, root, target)
    return spark.read.parquet(target).select("orderkey", "custkey", "status", "orderdate")


def full_refresh_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    root, target, lines = _deliveries(spark, sf)
    _deliver(lines, root)
    I.ingest(spark, FEED, root, target)
    I.ingest(spark, FEED, root, target, refresh=True)
    return spark.read.parquet(target).groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("file_path").alias("n_files")).select("status", "n", (F.col("n_files") > 0).alias("has_files"))


def stream_ingest_query(spark: SparkSession, sf: str) -> DataFrame:
    root, target, lines = _deliveries(spark, sf)
    checkpoint, feed = workspace(spark, "checkpoint"), Feed("orders", "*.txt", layout=ORDERS)
    _deliver(lines.filter("y < 1996"), root)
    stream_ingest(spark, feed, root, target, checkpoint)
    _deliver(lines.filter("y >= 1996"), root)
    stream_ingest(spark, feed, root, target, checkpoint)
    stream_ingest(spark, feed, root, target, checkpoint)
    return spark.read.parquet(target).select("orderkey", "custkey", "status", "orderdate")


def incremental_missing_files(spark: SparkSession, sf: str) -> DataFrame:
    path = F.concat(F.lit("/store/f"), F.col("o_orderkey").cast("string"))
    o = table(spark, sf, "orders")
    candidates = o.select(path.alias("file_path"), F.concat(F.lit("file:"), path).alias("source_path"))
    return I.missing_files(candidates, o.filter("o_orderkey % 3 <> 0").select(path.alias("file_path")))


def loaded_paths_query(spark: SparkSession, sf: str) -> DataFrame:
    return I.loaded_paths(table(spark, sf, "lineitem").select(F.concat(F.lit("/f/"), F.col("l_orderkey").cast("string")).alias("file_path")))


def append_by_name(spark: SparkSession, sf: str) -> DataFrame:
    target, p = workspace(spark, "byname"), table(spark, sf, "part")
    sinks.write(p.filter("p_partkey % 2 = 0").select("p_partkey", "p_brand", "p_type"), target)
    sinks.write(p.filter("p_partkey % 2 = 1").select(F.col("p_type").alias("P_TYPE"), F.col("p_partkey").alias("P_PARTKEY")), target)
    return spark.read.parquet(target)


def table_sink_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    name, c = "feedlake_roundtrip_" + workspace(spark, "t").rsplit("-", 1)[1], table(spark, sf, "customer")
    for k in range(2):
        sinks.write_table(c.filter(f"c_custkey % 2 = {k}").select("c_custkey", "c_name"), name)
    return spark.table(name)


def column_case_normalize(spark: SparkSession, sf: str) -> DataFrame:
    return naming.rename_columns(naming.rename_columns(table(spark, sf, "part").select("p_partkey", "p_brand"), "upper"), "lower")


def dedupe_columns(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    return naming.dedupe_columns(p.select(F.col("p_partkey").alias("k"), F.col("p_brand").alias("delimiter"), F.col("p_type").alias("delimiter"), F.col("p_name").alias("delimiter")))


def all_string_projection(spark: SparkSession, sf: str) -> DataFrame:
    return naming.all_string(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", F.to_date("l_shipdate").alias("l_shipdate")))


def typed_projection(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    bad = F.col("o_orderkey") % 5 == 0
    raw = o.select(F.col("o_orderkey").cast("string").alias("k"), F.when(bad, "n/a").otherwise(F.col("o_custkey").cast("string")).alias("i"), F.when(bad, "20250230").otherwise(F.date_format("o_orderdate", "yyyyMMdd")).alias("d"), F.col("o_orderstatus").alias("s"))
    return naming.typed(raw, {"k": "integer", "i": "integer", "d": "date", "s": "string"})


def wide_unpivot_query(spark: SparkSession, sf: str) -> DataFrame:
    return wide_unpivot(table(spark, sf, "part"), ["p_partkey"], {"p_brand": "Brand", "p_type": "Type", "p_size": "Size"})


QUERIES = {
    "fixed_width_parse": fixed_width_parse, "fixed_width_header_skip": fixed_width_header_skip, "csv_union_by_name": csv_union_by_name,
    "csv_drop_malformed": csv_drop_malformed, "csv_normalize_headers": csv_normalize_headers, "zip_member_list": zip_member_list,
    "member_routing": member_routing, "zip_member_scan": zip_member_scan, "member_safety_audit": member_safety_audit, "xml_explode": xml_explode,
    "list_string_agg": list_string_agg, "ordered_array_agg": ordered_array_agg, "workbook_cells": workbook_cells, "workbook_sheet_names": workbook_sheet_names,
    "workbook_sheet_table": workbook_sheet_table, "decode_error_rollup": decode_error_rollup, "workbook_cell_grain": workbook_cell_grain, "external_sink_roundtrip": external_sink_roundtrip, "mixed_format_union": mixed_format_union,
    "discover_files": discover_files, "incremental_append": incremental_append, "full_refresh_overwrite": full_refresh_overwrite,
    "stream_ingest": stream_ingest_query, "incremental_missing_files": incremental_missing_files, "loaded_paths": loaded_paths_query,
    "append_by_name": append_by_name, "table_sink_roundtrip": table_sink_roundtrip, "column_case_normalize": column_case_normalize,
    "dedupe_columns": dedupe_columns, "all_string_projection": all_string_projection, "typed_projection": typed_projection, "wide_unpivot": wide_unpivot_query,
}

_ORDERS = "SELECT o_orderkey::VARCHAR AS orderkey, o_custkey::VARCHAR AS custkey, o_orderstatus AS status, strftime(o_orderdate, '%Y-%m-%d') AS orderdate FROM orders"
_CELLS = """
    WITH p AS (SELECT *, '/store/B' || lpad((p_partkey // 200)::VARCHAR, 5, '0') || '.xlsx' AS file_path,
                      CASE WHEN p_size <= 25 THEN 'Small' ELSE 'Large' END AS sheet FROM part),
    r AS (SELECT *, row_number() OVER (PARTITION BY file_path, sheet ORDER BY p_partkey) + 1 AS row_num FROM p)
"""

ORACLES = {
    "fixed_width_parse": """
        SELECT l_orderkey::VARCHAR AS orderkey, l_linenumber::VARCHAR AS linenumber, l_partkey::VARCHAR AS partkey, (l_quantity::INT)::VARCHAR AS quantity,
               (round(l_extendedprice * 100)::BIGINT)::VARCHAR AS cents, l_returnflag AS flag, strftime(l_shipdate, '%Y-%m-%d') AS shipdate FROM lineitem""",
    "fixed_width_header_skip": "SELECT c_custkey::VARCHAR AS custkey, c_name AS name, c_mktsegment AS segment FROM customer",
    "csv_union_by_name": "SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderstatus, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority FROM orders",
    "csv_drop_malformed": "SELECT o_orderkey::VARCHAR AS orderkey, o_custkey::VARCHAR AS custkey, o_orderstatus AS status FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0",
    "csv_normalize_headers": "SELECT s_suppkey::VARCHAR AS supp_key, s_name AS supplier_name, (round(s_acctbal * 100)::BIGINT)::VARCHAR AS acct_balance_cents FROM supplier",
    "zip_member_list": """
        WITH a AS (SELECT DISTINCT '/store/A' || lpad((c_custkey // 500)::VARCHAR, 5, '0') AS archive, 'P.' || lower(c_mktsegment) || '.csv' AS member FROM customer)
        SELECT * FROM a UNION ALL SELECT DISTINCT archive, 'Data Dictionary building.csv' FROM a""",
    "member_routing": "SELECT DISTINCT '/store/A' || lpad((c_custkey // 500)::VARCHAR, 5, '0') AS archive, 'P.building.csv' AS member FROM customer WHERE c_mktsegment = 'BUILDING'",
    "zip_member_scan": """
        SELECT c_custkey::VARCHAR AS c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN (round(c_acctbal * 100)::BIGINT)::VARCHAR END AS balance,
               '/store/A' || lpad((c_custkey // 500)::VARCHAR, 5, '0') || '!P.' || lower(c_mktsegment) || '.csv' AS file_path FROM customer""",
    "member_safety_audit": r"""
        SELECT s_suppkey AS suppkey, concat_ws(',', CASE WHEN s_suppkey % 5 = 1 THEN 'absolute' END, CASE WHEN s_suppkey % 5 = 2 THEN 'traversal' END,
               CASE WHEN s_suppkey % 5 = 3 THEN 'separator' END, CASE WHEN s_suppkey % 7 = 0 THEN 'link' END) AS violations FROM supplier""",
    "xml_explode": """
        SELECT o_orderkey::VARCHAR AS key, string_agg(l_returnflag || l_linenumber, ',' ORDER BY l_linenumber, l_returnflag) AS reasons, 'H' || (o_orderkey // 32) AS headercode
        FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""",
    "list_string_agg": "SELECT l_orderkey AS orderkey, string_agg(CASE WHEN l_returnflag = 'R' THEN l_linenumber::VARCHAR END, ',' ORDER BY l_linenumber) AS returned FROM lineitem GROUP BY l_orderkey",
    "ordered_array_agg": "SELECT l_orderkey AS orderkey, string_agg(l_partkey::VARCHAR, '|' ORDER BY l_linenumber, l_partkey::VARCHAR) AS parts FROM lineitem GROUP BY l_orderkey",
    "workbook_cells": _CELLS + """,
        h AS (SELECT DISTINCT file_path, sheet FROM p)
        SELECT file_path, sheet, 1 AS row_num, c AS col_idx, ['PARTKEY', 'TYPE', 'CENTS'][c + 1] AS value FROM h, (SELECT unnest([0, 1, 2]) AS c)
        UNION ALL SELECT file_path, sheet, row_num, 0, p_partkey::VARCHAR FROM r
        UNION ALL SELECT file_path, sheet, row_num, 1, p_type FROM r WHERE p_partkey % 3 <> 0
        UNION ALL SELECT file_path, sheet, row_num, 2, (round(p_retailprice * 100)::BIGINT)::VARCHAR FROM r""",
    "workbook_sheet_names": _CELLS + "SELECT DISTINCT file_path, sheet FROM p",
    "workbook_sheet_table": _CELLS + """
        SELECT file_path, p_partkey::VARCHAR AS partkey, CASE WHEN p_partkey % 3 <> 0 THEN p_type END AS type,
               (round(p_retailprice * 100)::BIGINT)::VARCHAR AS cents FROM p WHERE sheet = 'Small'""",
    "workbook_cell_grain": _CELLS + """,
        s AS (SELECT row_num, p_partkey::VARCHAR AS row_label, file_path, '/store' AS directory_name, substr(file_path, 8) AS file_name, p_type, p_retailprice, p_partkey FROM r WHERE sheet = 'Small')
        SELECT row_num, row_label, 'TYPE' AS column_label, CASE WHEN p_partkey % 3 <> 0 THEN p_type END AS value_text, file_path, directory_name, file_name FROM s
        UNION ALL SELECT row_num, row_label, 'CENTS', (round(p_retailprice * 100)::BIGINT)::VARCHAR, file_path, directory_name, file_name FROM s""",
    "external_sink_roundtrip": "SELECT s_suppkey, s_name FROM supplier",
    "decode_error_rollup": """
        WITH f AS (SELECT DISTINCT p_partkey // 200 AS g FROM part)
        SELECT count(*) AS n_files, count(*) FILTER (g % 3 = 0) AS n_failed, count(*) = count(*) FILTER (g % 3 = 0) AS failed FROM f""",
    "mixed_format_union": """
        SELECT p_partkey::VARCHAR AS partkey, CASE WHEN p_partkey % 2 = 1 AND p_partkey % 3 <> 0 THEN p_type END AS type,
               CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS brand FROM part""",
    "discover_files": "SELECT 'Y' || year(o_orderdate) AS year, sum(length(o_orderkey::VARCHAR) + 1)::BIGINT AS bytes FROM orders GROUP BY 1",
    "incremental_append": _ORDERS,
    "stream_ingest": _ORDERS,
    "full_refresh_overwrite": "SELECT o_orderstatus AS status, count(*) AS n, true AS has_files FROM orders GROUP BY 1",
    "incremental_missing_files": "SELECT '/store/f' || o_orderkey AS file_path, 'file:/store/f' || o_orderkey AS source_path FROM orders WHERE o_orderkey % 3 = 0",
    "loaded_paths": "SELECT DISTINCT '/f/' || l_orderkey AS file_path FROM lineitem",
    "append_by_name": "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS p_brand, p_type FROM part",
    "table_sink_roundtrip": "SELECT c_custkey, c_name FROM customer",
    "column_case_normalize": "SELECT p_partkey, p_brand FROM part",
    "dedupe_columns": "SELECT p_partkey AS k, p_brand AS delimiter, p_type AS delimiter_1, p_name AS delimiter_2 FROM part",
    "all_string_projection": "SELECT l_orderkey::VARCHAR AS l_orderkey, l_linenumber::VARCHAR AS l_linenumber, l_returnflag, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM lineitem",
    "typed_projection": """
        SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS i, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate::DATE END AS d,
               o_orderstatus AS s, CASE WHEN o_orderkey % 5 = 0 THEN 2 ELSE 0 END::BIGINT AS n_unparsed FROM orders""",
    "wide_unpivot": """
        SELECT p_partkey, 'Brand' AS column_label, p_brand AS value_text FROM part UNION ALL SELECT p_partkey, 'Type', p_type FROM part
        UNION ALL SELECT p_partkey, 'Size', p_size::VARCHAR FROM part""",
}
