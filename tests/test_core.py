"""Operators on small written files and rows, with faults."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from feedlake import fixtures, sinks
from feedlake.functions import paths as P
from feedlake.functions import text as X
from feedlake.operators import evidence, governance, ingest, naming, sheets, state
from feedlake.plans.defs import CELL_GRAIN, Feed, Layout, Sheet, read_layouts
from feedlake.sources import csv_feed, fixed_width, listing, workbook, xml_feed, zip_feed
from feedlake.streaming.ingest import stream_ingest

LAYOUT = Layout.parse("t", "id:4, name:6, id:3")


def put(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_layouts_are_read_from_text():
    found = read_layouts(str(__import__("pathlib").Path(__file__).resolve().parents[1] / "FIXTURES.md"))
    assert len(found) == 13
    assert found["parta_demo_codes"].width == 324 and found["partb_demo_codes"].width == 128
    assert found["cclf0_summary_stats_header_record"].header


def test_fixed_width_lines(spark, tmp_path):
    path = put(tmp_path, "P.D250131.x/a b.D259999.T0", "0001 ann  77\n\n0002,bob  78\n")
    rows = [tuple(r) for r in naming.dedupe_columns(fixed_width.read_fixed_width(spark, path, LAYOUT)).collect()]
    assert [r[:3] for r in rows] == [("0001", "ann", "77"), (None, None, None), ("0002", ",bob", "78")]
    assert rows[0][3] == path
    assert fixed_width.read_fixed_width(spark, path, LAYOUT, strict_csv_lines=True).count() == 2


def test_lineage_takes_the_leftmost_stamp(spark):
    df = spark.createDataFrame([("/a/P.D250131.x/f.D240229.T0",), ("/a/f.D259999.T0",), ("f",)], "file_path string")
    rows = df.select(P.directory_name(F.col("file_path")), P.base_name(F.col("file_path")), P.short_stamp_date(F.col("file_path")).cast("string")).collect()
    assert [tuple(r) for r in rows] == [("/a/P.D250131.x", "f.D240229.T0", "2025-01-31"), ("/a", "f.D259999.T0", None), ("", "f", None)]


def test_csv_union_and_faults(spark, tmp_path):
    put(tmp_path, "one.csv", "a,b\n1,2\nbad\n3,4,5\n")
    put(tmp_path, "two.csv", 'b,c\n6,"x, y"\n')
    rows = csv_feed.read_csv_union(spark, str(tmp_path)).drop("file_path").orderBy("B").collect()
    assert [r.asDict() for r in rows] == [{"A": "1", "B": "2", "C": None}, {"A": None, "B": "6", "C": "x, y"}]
    put(tmp_path, "n/three.csv", "First Name, First  Name\nq,r\n")
    assert csv_feed.read_csv_union(spark, str(tmp_path / "n"), normalize=True).columns[:2] == ["first_name", "first_name_1"]


def test_csv_quotes_in_headers_and_fields(spark, tmp_path):
    put(tmp_path, "a/one.csv", '\ufeff"name, full",id\n"Doe, J",1\n"said ""no""",2\n')
    got = csv_feed.read_csv_union(spark, str(tmp_path / "a")).drop("file_path").orderBy("ID").collect()
    assert [r.asDict() for r in got] == [{"NAME, FULL": "Doe, J", "ID": "1"}, {"NAME, FULL": 'said "no"', "ID": "2"}]
    put(tmp_path, "b/one.csv", 'id,note\n1,"line one\nline two"\n2,plain\n')
    put(tmp_path, "b/two.csv", 'id,"a\nb"\n3,x\n')
    got = csv_feed.read_csv_union(spark, str(tmp_path / "b")).drop("file_path").orderBy("ID").collect()
    assert [(r["ID"], r["NOTE"], r["A\nB"]) for r in got] == [("1", "line one\nline two", None), ("2", "plain", None), ("3", None, "x")]
    put(tmp_path, "c/empty.csv", "")
    put(tmp_path, "c/one.csv", "a\n1\n")
    assert csv_feed.read_csv_union(spark, str(tmp_path / "c")).count() == 1


def test_reused_runs_are_followed_to_the_first(spark):
    rows = [("a", "s", None), ("b", "s", "a"), ("c", "s", "b"), ("d", "s", "c"), ("e", "s", "d"), ("f", "s", "gone"), ("b", "t", None)]
    got = {(r["run_id"], r["stage_id"]): r["origin"] for r in evidence.phase_origin(spark.createDataFrame(rows, "run_id string, stage_id string, satisfied_by string")).collect()}
    assert got == {**{(k, "s"): "a" for k in "abcde"}, ("f", "s"): "gone", ("b", "t"): "b"}
    with pytest.raises(ValueError):
        evidence.phase_origin(spark.createDataFrame([("x", "s", "y"), ("y", "s", "z"), ("z", "s", "x")], "run_id string, stage_id string, satisfied_by string"))


def test_notes_behind_other_white_space(spark):
    from feedlake.functions.text import is_blank

    df = spark.createDataFrame([("\u00a0 \t",), (None,), ("x",)], "v string")
    assert [r[0] for r in df.select(is_blank(F.col("v"))).collect()] == [True, True, False]
    rows = [["h", "x", "y"], ["a", "1", "2"], ["\u00a0\tNote: x"]]
    assert sheets.sheet_headers(sheets.sheet_grid(cells_of(spark, rows), [Sheet("t", "%")])).first()["notes_row"] == 3


def test_discovery_fails_closed(spark, tmp_path):
    assert listing.discover(spark, str(tmp_path), "*.none").count() == 0
    with pytest.raises(listing.DiscoveryError):
        listing.discover(spark, str(tmp_path), "*.none", missing_ok=False)
    with pytest.raises(Exception, match="nowhere"):
        listing.discover(spark, "nowhere://x", "*").count()
    put(tmp_path, "a b'+%.txt", "x")
    assert listing.discover(spark, str(tmp_path), "*.txt").first()["file_path"].endswith("/a b'+%.txt")


def test_ingest_reads_each_file_once(spark, tmp_path):
    root, target = tmp_path / "in", str(tmp_path / "out")
    layout = Layout.parse("t", "k:2, v:2")
    feed = Feed("t", "*.txt", layout=layout)
    assert ingest.ingest(spark, feed, str(root), target) == 0
    put(root, "a.D250101.txt", "1 x\n2 y\n")
    assert [ingest.ingest(spark, feed, str(root), target) for _ in range(2)] == [1, 0]
    put(root, "b.D250102.txt", "3 z\n")
    assert ingest.ingest(spark, feed, str(root), target) == 1
    assert sorted(r["k"] for r in spark.read.parquet(target).collect()) == ["1", "2", "3"]
    assert ingest.ingest(spark, feed, str(root), target, refresh=True) == 2
    assert spark.read.parquet(target).count() == 3


def test_stream_reads_each_file_once(spark, tmp_path):
    root, args = tmp_path / "in", (str(tmp_path / "out"), str(tmp_path / "check"))
    feed = Feed("t", "*.txt", layout=Layout.parse("t", "k:2"))
    put(root, "a.txt", "1 \n2 \n")
    assert stream_ingest(spark, feed, str(root), *args) == 2
    put(root, "b.txt", "3 \n")
    assert [stream_ingest(spark, feed, str(root), *args) for _ in range(2)] == [1, 0]
    assert spark.read.parquet(args[0]).count() == 3


def test_archives(spark, tmp_path):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("a.csv", 'x,y\n1,"two\nlines"\nragged\n')
        z.writestr("../up.csv", "x\n1\n")
        z.writestr("b.csv", "y,z\n5,6\n")
    books = spark.createDataFrame([("/s/one.zip", bytearray(buffer.getvalue())), ("/s/bad.zip", bytearray(b"no"))], "path string, content binary")
    members = zip_feed.list_members(books)
    assert members.filter("error IS NOT NULL").count() == 1
    audit = {r["member"]: r["violations"] for r in zip_feed.audit_members(members.filter("error IS NULL")).collect()}
    assert audit == {"a.csv": [], "../up.csv": ["traversal"], "b.csv": []}
    rows = zip_feed.read_zip_csv(books, members.filter("member IN ('a.csv', 'b.csv')")).orderBy("file_path").collect()
    assert [r.asDict() for r in rows] == [
        {"X": "1", "Y": "two\nlines", "Z": None, "file_path": "/s/one.zip!a.csv"},
        {"X": None, "Y": "5", "Z": "6", "file_path": "/s/one.zip!b.csv"},
    ]


def test_xml_documents(spark, tmp_path):
    body = "<Doc><Head><Code>H</Code></Head><Items><Item><Id>1</Id><Why><R>a</R><R>b</R></Why></Item><Item><Id>2</Id></Item></Items></Doc>"
    put(tmp_path, "a.xml", body)
    schema = "Head struct<Code:string>, Items struct<Item:array<struct<Id:string,Why:struct<R:array<string>>>>>"
    docs = xml_feed.read_xml_documents(spark, str(tmp_path), "Doc", schema)
    rows = xml_feed.explode_records(docs, "Items.Item", "Head").select("id", X.join_list(F.col("why.R")).alias("why"), "code").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [("1", "a,b", "H"), ("2", None, "H")]


def test_workbook_cells_and_errors(spark):
    content = fixtures.workbook({"S 1": [["h", None, 2], [], ["<&>", "x"]], "T": [[1]]})
    books = spark.createDataFrame([("/a.xlsx", bytearray(content)), ("/b.xlsx", bytearray(b"?"))], "path string, content binary")
    cells = workbook.read_cells(books)
    got = sorted((r["sheet"], r["row_num"], r["col_idx"], r["value"]) for r in cells.filter("error IS NULL").collect())
    assert got == [("S 1", 1, 0, "h"), ("S 1", 1, 2, "2"), ("S 1", 3, 0, "<&>"), ("S 1", 3, 1, "x"), ("T", 1, 0, "1")]
    assert tuple(workbook.decode_errors(cells).first()) == (2, 1, False)
    assert workbook.column_index("AB12") == 27


def cells_of(spark, rows, sheet="Table 1-A", path="/f.xlsx"):
    flat = [(path, sheet, r, c, v) for r, row in enumerate(rows, 1) for c, v in enumerate(row) if v is not None]
    return spark.createDataFrame(flat, "file_path string, sheet string, row_num bigint, col_idx int, value string")


CANONICAL = [
    ["Table 1"], ["Report"], ["Org"], ["Contents"], ["Benchmark", "BY1", "BY2"], ["Assigned Beneficiaries"], ["[A1] Assigned Beneficiaries", "5780", "5902"],
    ["[A2] Person Years", "5622", "5778"], ["ESRD", "-", "42"], ["Trended Expenditures"], ["[B] Per Capita ($)"], ["ESRD", "144209", None], ["Note: rounded."], ["[1]A footnote."],
]


def test_sectioned_sheet(spark):
    rows = sheets.tidy_sheets(cells_of(spark, CANONICAL), Sheet("t", "Table 1-%")).orderBy("row_num", "column_label").collect()
    assert len(rows) == 8
    assert [r["section_code"] for r in rows[::2]] == ["A1", "A2", "A2", "B"]
    assert [r["group_label"] for r in rows[::2]] == ["Assigned Beneficiaries"] * 3 + ["Trended Expenditures"]
    assert rows[-1]["value_text"] is None and rows[-1]["column_label"] == "BY2"


def test_plain_section_clears_the_code(spark):
    rows = [["h", "a", "b"], ["[X] code", "1", "2"], ["Plain"], ["row", "3", "4"]]
    got = sheets.tidy_sheets(cells_of(spark, rows), Sheet("t", "%")).filter("row_label = 'row'").first()
    assert got["section_code"] is None and got["section_label"] == "Plain" and got["group_label"] == "Plain"


def test_two_row_header_hint_and_errors(spark):
    rows = [["x", "Group", None, "Own"], [None, "p", "q"], ["r", "1", None, "3"]]
    got = {(r["column_group_label"], r["column_label"]): r["value_text"] for r in sheets.tidy_sheets(cells_of(spark, rows), Sheet("t", "%")).collect()}
    assert got == {("Group", "p"): "1", ("Group", "q"): None, (None, "Own"): "3"}
    hinted = sheets.tidy_sheets(cells_of(spark, [["a", "b", "c"], ["h", "d", "e"], ["r", "1", "2"]]), Sheet("t", "%", header_row=2))
    assert {r["column_label"] for r in hinted.collect()} == {"d", "e"}
    with pytest.raises(sheets.SheetError, match="no header"):
        sheets.tidy_sheets(cells_of(spark, [["only"], ["labels"]]), Sheet("t", "%"), check=True)
    two = cells_of(spark, CANONICAL).unionByName(cells_of(spark, CANONICAL, "Table 1-B"))
    with pytest.raises(sheets.SheetError, match="fits"):
        sheets.tidy_sheets(two, Sheet("t", "Table 1-%"), check=True)
    assert [f.name for f in CELL_GRAIN][0] == "row_num" and len(CELL_GRAIN) == 17


def test_sinks_align_by_name(spark, tmp_path):
    target = str(tmp_path / "t")
    sinks.write(spark.createDataFrame([(1, "x")], "a int, b string"), target)
    sinks.write(spark.createDataFrame([("y",)], "B string"), target)
    assert sorted(tuple(r) for r in spark.read.parquet(target).collect() if r["a"]) == [(1, "x")]
    with pytest.raises(ValueError, match="extra"):
        sinks.write(spark.createDataFrame([(1,)], "extra int"), target)
    with pytest.raises(ValueError):
        sinks.external_writer(spark.range(1), "jdbc", {"url": "x"}, "truncate")
    assert sinks.remote_conf("gs", keyfile="k")["spark.hadoop.fs.gs.auth.service.account.json.keyfile"] == "k"


def test_names_and_types(spark):
    assert len(set(map(str.lower, naming.unique_names(["d", "D", "d_1", "d"])))) == 4
    df = spark.createDataFrame([("1", "2024-02-30", "x")], "i string, d string, n string")
    assert tuple(naming.typed(df, {"i": "integer", "d": "date", "n": "numeric"}).first()) == (1, None, None, 2)


def test_labels(spark):
    df = spark.createDataFrame([(" a \t b [3] ",), ("  ",), (None,), ("[3]",)], "v string")
    assert [r[0] for r in df.select(X.normalize_label(F.col("v"))).collect()] == ["a b", None, None, None]
    quarters = spark.createDataFrame([("2024Q1",), ("2024Q5",), ("x",)], "v string").select(P.quarter_end(F.col("v")).cast("string")).collect()
    assert [r[0] for r in quarters] == ["2024-03-31", None, None]


def test_evidence_batches_fail_whole(spark, tmp_path):
    path = str(tmp_path / "log")
    fields = {c.split()[0]: None for c in evidence.SCHEMA.split(", ")}
    good = fields | {"run_id": "r1", "seq": 1, "record_type": "metric_observed", "stage_id": "s", "metric_id": "m", "value": 3}
    bad = good | {"seq": 2, "value": -1}
    assert evidence.append_evidence(spark.createDataFrame([tuple(good.values())], evidence.SCHEMA), path) == 1
    with pytest.raises(ValueError, match="value"):
        evidence.append_evidence(spark.createDataFrame([tuple(good.values()), tuple(bad.values())], evidence.SCHEMA), path)
    assert spark.read.text(path).count() == 1
    contract = spark.createDataFrame([("s", "m"), ("s", "n")], "stage_id string, metric_id string")
    with pytest.raises(ValueError, match="n of s is missing"):
        evidence.append_metrics(spark.createDataFrame([tuple(good.values())], evidence.SCHEMA), contract, path)
    with pytest.raises(ValueError, match="undeclared"):
        evidence.append_metrics(spark.createDataFrame([tuple(good.values())], evidence.SCHEMA), contract.limit(0), path)
    assert spark.read.text(path).count() == 1
    assert evidence.append_metrics(spark.createDataFrame([tuple(good.values())], evidence.SCHEMA), contract.filter("metric_id = 'm'"), path) == 1
    odd = spark.createDataFrame([('{"run_id":"r","seq":1,"occurred_at":"t","record_type":"stage_blocked","stage_id":"s","prerequisite_id":"p"}',)], "value string")
    assert evidence.parse_evidence(odd).first()["problem"] == "missing_field"


def test_readiness_and_exit_codes(spark):
    gates = spark.createDataFrame([("a", 1, "x"), ("b", 2, None), ("c", 3, "y")], "gate string, ordinal int, expected string")
    seen = spark.createDataFrame([("a", "x"), ("c", "z")], "gate string, observed string")
    assert [r["ready"] for r in governance.readiness(gates, seen).orderBy("ordinal").collect()] == [True, True, False]
    assert governance.readiness(gates.limit(0), seen).count() == 0
    with pytest.raises(ValueError, match="name"):
        governance.readiness(spark.createDataFrame([(" ", 1, "x")], gates.schema), seen)
    events = spark.createDataFrame([("t", 1, 0), ("t", 2, None), ("u", 1, 0), ("v", 1, 3), ("v", 2, 4)], "task string, ordinal int, code int")
    assert {r["task"]: (r["status"], r["code"]) for r in governance.task_exit(events).collect()} == {"t": ("failed", None), "u": ("succeeded", None), "v": ("failed", 3)}


def test_listing_lines(spark):
    lines = spark.createDataFrame([("-----A feed, Code 213",), (" 1 of 2 - P.A.D240101.T1 (24.35 MB) Last Updated: 2024-01-02T03:04:05.678Z",), ("noise",)], "value string")
    assert tuple(state.parse_codes(lines).first()) == ("A feed", 213)
    assert tuple(state.parse_listing(lines).first())[:3] == (1, 2, "P.A.D240101.T1")


def test_manifests_that_cannot_be_read_are_left_out(spark, tmp_path):
    put(tmp_path, "a.json", '{\n "run_id": "r1",\n "status": "completed"\n}')
    put(tmp_path, "b.json", "{ no")
    rows = evidence.read_runs(spark, str(tmp_path)).collect()
    assert [(r["run_id"], r["status"]) for r in rows] == [("r1", "completed")]
