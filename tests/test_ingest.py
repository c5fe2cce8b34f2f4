"""Ledgers, batches that die, refreshes that fail, archives by ranges, streams, families, stores."""

import io
import tracemalloc
import zipfile

import pytest
from pyspark.sql import functions as F

from feedlake import fixtures, sinks
from feedlake.operators import evidence, ledger, sheets
from feedlake.operators.ingest import ingest, ingest_sheets
from feedlake.plans.defs import Feed, Layout, Sheet
from feedlake.sources import csv_feed, store, zip_feed
from feedlake.streaming.ingest import stream_ingest

LINES = Feed("t", "*.txt", layout=Layout.parse("t", "k:2, v:2"), batch=1)
REPORT = Feed("r", "P.*.zip", "zip_csv", member="ALR*-1.csv", dates="load", batch=2)


def put(folder, name, content):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())


def packed(**members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in members.items():
            z.writestr(name.replace("__", "-") + ".csv", content)
    return buffer.getvalue()


def keys(spark, target, column="k"):
    return sorted(r[column] for r in ledger.read_table(spark, target).collect())


def test_members_that_come_later_are_loaded_and_empty_ones_once(spark, tmp_path):
    root, target = tmp_path / "in", str(tmp_path / "out")
    put(root, "P.a.zip", packed(ALR_x__1="k\n1\n", other="k\n9\n"))
    put(root, "P.none.zip", packed(other="k\n9\n"))
    put(root, "P.empty.zip", packed(ALR_e__1="k\n"))
    load = lambda: ingest(spark, REPORT, str(root), target)
    assert [load(), load()] == [2, 0]
    put(root, "P.a.zip", packed(ALR_x__1="k\n1\n", ALR_y__1="k\n2\n"))
    assert [load(), load()] == [1, 0]
    assert keys(spark, target, "K") == ["1", "2"]
    known = {r["file_path"].rsplit("/", 1)[1]: r["n_rows"] for r in ledger.read_ledger(spark, target).filter("member IS NOT NULL").collect()}
    assert known == {"P.a.zipALR_x-1.csv": 1, "P.a.zipALR_y-1.csv": 1, "P.empty.zipALR_e-1.csv": 0}
    opened = ledger.read_ledger(spark, target).filter("member IS NULL").count()
    assert opened == 4  # three archives, one of them in two states


def test_tables_loaded_without_a_ledger_are_gone_on_with(spark, tmp_path):
    root, target = tmp_path / "in", str(tmp_path / "out")
    put(root, "a.txt", "1 x\n")
    sinks.write(spark.createDataFrame([("1", "x", str(root / "a.txt"), str(root), "a.txt", None)], "k string, v string, file_path string, directory_name string, file_name string, file_date date"), target)
    put(root, "b.txt", "2 y\n")
    assert [ingest(spark, LINES, str(root), target) for _ in range(2)] == [1, 0]
    assert keys(spark, target) == ["1", "2"]


def test_a_batch_is_finished_or_removed_by_the_next_run(spark, tmp_path, monkeypatch):
    root, target = tmp_path / "in", str(tmp_path / "out")
    for k in (1, 2, 3):
        put(root, f"{k}.txt", f"{k} x\n")
    real, calls = ledger._finish, []

    def dies(session, path, batch):
        calls.append(batch)
        if len(calls) == 2:
            name = ledger._children(session, f"{path}/_staging/{batch}/data")
            part = next(n for n in name if n.startswith("part-"))
            ledger.rename(session, f"{path}/_staging/{batch}/data/{part}", f"{path}/part-{batch}-{part.removeprefix('part-')}")
            raise OSError("killed between two files")
        real(session, path, batch)

    monkeypatch.setattr(ledger, "_finish", dies)
    with pytest.raises(OSError, match="killed"):
        ingest(spark, LINES, str(root), target)
    monkeypatch.setattr(ledger, "_finish", real)
    (tmp_path / "out" / "_staging" / "unfinished" / "data").mkdir(parents=True)
    assert ingest(spark, LINES, str(root), target) == 1
    assert keys(spark, target) == ["1", "2", "3"]
    assert ledger._children(spark, f"{target}/_staging") == []


def test_a_refresh_that_fails_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    root, target = tmp_path / "in", str(tmp_path / "out")
    for k in (1, 2):
        put(root, f"{k}.txt", f"{k} x\n")
    ingest(spark, LINES, str(root), target)
    put(root, "1.txt", "5 x\n")
    calls = []

    def reader(session, paths):
        calls.append(paths)
        if len(calls) == 2:
            raise OSError("gone")
        return session.read.text(paths).select(F.substring("value", 1, 1).alias("k"), F.lit("x").alias("v"), F.col("_metadata.file_path").alias("file_path"))

    with pytest.raises(OSError, match="gone"):
        ingest(spark, LINES, str(root), target, refresh=True, reader=reader)
    assert keys(spark, target) == ["1", "2"]
    assert ingest(spark, LINES, str(root), target, refresh=True) == 2
    assert keys(spark, target) == ["2", "5"]
    # between the two renames: the new table is ready, the old one has moved
    ledger.rename(spark, target, f"{target}__old")
    ingest(spark, LINES, str(root), f"{target}__new")
    ledger._mark(spark, f"{target}__new")
    assert ingest(spark, LINES, str(root), target) == 0
    assert keys(spark, target) == ["2", "5"] and not sinks.path_exists(spark, f"{target}__old")
    assert ingest(spark, Feed("t", "*.none", layout=LINES.layout), str(root), target, refresh=True) == 0
    assert keys(spark, target) == ["2", "5"]


def test_a_stream_that_dies_in_a_batch_goes_on_without_doubles(spark, tmp_path, monkeypatch):
    root, target, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    put(root, "P.a.zip", packed(ALR_x__1="k\n1\n"))
    put(root, "P.b.zip", packed(ALR_x__1="k\n2\n"))
    real, calls = ledger._mark, []

    def dies(session, folder):
        real(session, folder)
        calls.append(folder)
        if len(calls) == 2:
            raise OSError("killed")

    monkeypatch.setattr(ledger, "_mark", dies)
    with pytest.raises(Exception, match="killed"):
        stream_ingest(spark, REPORT, str(root), target, check, max_files_per_trigger=1)
    monkeypatch.setattr(ledger, "_mark", real)
    stream_ingest(spark, REPORT, str(root), target, check, max_files_per_trigger=1)
    assert keys(spark, target, "K") == ["1", "2"]
    put(root, "P.c.zip", packed(ALR_x__1="k,n\n3,x\n"))
    assert stream_ingest(spark, REPORT, str(root), target, check) == 1
    assert keys(spark, target, "K") == ["1", "2", "3"] and "N" in ledger.read_table(spark, target).columns
    assert stream_ingest(spark, REPORT, str(root), target, check) == ingest(spark, REPORT, str(root), target) == 0


def test_a_large_member_is_read_in_pieces_by_a_task_of_its_own(spark, tmp_path):
    line = ",".join(["x" * 40] * 5) + "\n"
    with zipfile.ZipFile(tmp_path / "big.zip", "w", zipfile.ZIP_DEFLATED) as z:
        with z.open("big.csv", "w") as f:
            f.write(b"a,b,c,d,e\n")
            for _ in range(100):
                f.write((line * 5000).encode())
        z.writestr("s1.csv", "a\n1\n")
        z.writestr("s2.csv", "a\n2\n")
    archives = zip_feed.read_archives(spark, str(tmp_path / "big.zip"))
    members = zip_feed.list_members(archives)
    assert members.agg(F.max("size")).first()[0] > 100_000_000
    found = members.join(archives, F.col("archive") == F.col("path")).select("source", "archive", "member", "packed").collect()
    reader = zip_feed.MemberReader({"members": __import__("json").dumps([list(r) for r in found]), "partBytes": "1000"})
    parts = reader.partitions()
    assert sorted(len(p.members) for p in parts) == [1, 2]
    tracemalloc.start()
    rows = sum(b.num_rows for p in parts for b in reader.read(p))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 500_000 + 1 + 4 and peak < 20_000_000
    assert zip_feed.read_zip_csv(archives, members.filter("member LIKE 's%'")).count() == 2


def test_stores_are_opened_by_ranges(tmp_path):
    store.write_file(f"file://{tmp_path}/d/a.bin", b"0123456789")
    with store.open_file(f"file:{tmp_path}/d/a.bin") as f:
        f.seek(7)
        assert f.read(2) == b"78"
    with store.open_file(str(tmp_path / "d" / "a.bin")) as f:
        assert f.read(1) == b"0"


def test_csv_faults(spark, tmp_path):
    def read(name, text):
        put(tmp_path, f"{name}/f.csv", text)
        df = csv_feed.read_csv_union(spark, str(tmp_path / name)).drop("file_path")
        return df.columns, sorted(tuple(r) for r in df.collect())

    assert read("blank", "\n\na,b\n1,2\n\n3,4\n") == (["A", "B"], [("1", "2"), ("3", "4")])
    assert read("blanks", "\n  \na,b\n1,2\n") == (["A", "B"], [("1", "2")])
    assert read("both", ' \na,b\n1,"x\ny"\n2,z\n') == (["A", "B"], [("1", "x\ny"), ("2", "z")])
    assert read("unnamed", "a,,\n1,2,\n") == (["A", "COLUMN1", "COLUMN2"], [("1", "2", None)])
    assert read("stray", 'a,b\n5" pipe,2\n3,x"y\n') == (["A", "B"], [("3", 'x"y'), ('5" pipe', "2")])
    assert read("empty", "\n\n") == ([], [])


def test_large_csv_files_are_split_unless_quotes_run_over_lines(spark, tmp_path):
    put(tmp_path, "plain.csv", "a,b\n" + 'q" r,"x, ""y"""\n' * 3)
    put(tmp_path, "open.csv", 'a,b\n1,"x\ny"\n')
    assert csv_feed.quoted_line_ends(spark, [str(tmp_path / "plain.csv"), str(tmp_path / "open.csv")]) == {str(tmp_path / "open.csv")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16")
    try:
        rows = csv_feed.read_csv_union(spark, str(tmp_path)).drop("file_path").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(tuple(r) for r in rows) == [("1", "x\ny")] + [('q" r', 'x, "y"')] * 3


def test_a_family_is_loaded_but_for_the_tables_that_cannot_be_read(spark, tmp_path):
    good = [["h", "x", "y"], ["[1]"], ["r", 1, 2]]
    names = {"Table 1": good, "Table 2a": good, "Table 2b": good, "Table 3": [["only"], ["labels"]]}
    for k in range(3):
        put(tmp_path, f"in/B{k}.D250101.T000000{k}.xlsx", fixtures.workbook(names if k == 2 else {"Table 1": good, "Table 3": good}))
    feeds = [Feed(f"t{k}", "*.xlsx", "sheet", sheet=Sheet(f"t{k}", f"Table {k}%"), dates="path", batch=2) for k in (1, 2, 3)]
    targets = {f.name: str(tmp_path / "out" / f.name) for f in feeds}
    with pytest.raises(sheets.SheetError, match="t2: .*fits 2 sheets.*t3: .*no header"):
        ingest_sheets(spark, feeds, str(tmp_path / "in"), targets)
    assert keys(spark, targets["t1"], "value_text") == ["1", "1", "1", "2", "2", "2"]
    assert keys(spark, targets["t3"], "value_text") == ["1", "1", "2", "2"]
    with pytest.raises(Exception, match="no header"):
        ingest(spark, feeds[2], str(tmp_path / "in"), targets["t3"])
    with pytest.raises(ValueError, match="same workbooks"):
        ingest_sheets(spark, [feeds[0], LINES], str(tmp_path), targets)


def test_sheets_in_one_exchange(spark):
    cells = spark.createDataFrame([("f", "Table 1", 1, 0, "a"), ("f", "Table 1", 1, 1, "b"), ("f", "Table 1", 1, 1, "again")], "file_path string, sheet string, row_num bigint, col_idx int, value string")
    tidy = sheets.tidy_family(cells, [Sheet("a", "Table 1%"), Sheet("b", "Table%"), Sheet("c", "%", labels=("v",))])
    plan = tidy._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert [(r["table"], r["value_text"]) for r in tidy.collect()] == [("c", "again")]


def test_database_loads_come_once_and_roll_back(spark, tmp_path):
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", "/dev/null")
    url = f"jdbc:derby:memory:{tmp_path.name};create=true"
    read = lambda: sorted(tuple(r) for r in spark.read.format("jdbc").option("url", url).option("dbtable", "T").load().collect())
    load = lambda rows, batch, mode: sinks.load_database(spark, sinks.stage(spark.createDataFrame(rows, "a int, b string"), str(tmp_path), batch), url, "t", batch, mode)
    assert [load([(1, "x")], "one", "append"), load([(9, "never staged again")], "one", "append")] == [True, False]
    assert load([(2, "y")], "two", "append") and read() == [(1, "x"), (2, "y")]
    with pytest.raises(Exception):
        sinks.load_database(spark, sinks.stage(spark.createDataFrame([(3, 4)], "a int, extra int"), str(tmp_path), "bad"), url, "t", "bad", "truncate")
    assert read() == [(1, "x"), (2, "y")]
    assert load([(5, None)], "three", "truncate") and not load([(5, None)], "three", "truncate") and read() == [(5, None)]
    for table, batch, mode in (("t; x", "b", "append"), ("t", "b'", "append"), ("t", "b", "replace")):
        with pytest.raises(ValueError):
            sinks.load_database(spark, str(tmp_path / "one"), url, table, batch, mode)


def test_summary_refuses_undeclared_metrics(spark):
    fields = {c.split()[0]: None for c in evidence.SCHEMA.split(", ")}
    seen = fields | {"run_id": "r", "seq": 1, "record_type": "metric_observed", "stage_id": "s", "metric_id": "m", "value": 3}
    records = spark.createDataFrame([tuple(seen.values())], evidence.SCHEMA)
    contract = spark.createDataFrame([("s", "m"), ("s", "n"), ("other", "o")], "stage_id string, metric_id string")
    got = {(r["kind"], r["key"], r["state"]) for r in evidence.run_summary(records, contract).collect()}
    assert got == {("metric", "s/m", "3"), ("missing_metric", "s/n", "missing"), ("missing_metric", "other/o", "missing")}
    with pytest.raises(ValueError, match="m of s is undeclared"):
        evidence.run_summary(records, contract.filter("metric_id <> 'm'"))
