"""Many small batches, archives and triggers: work that is shared, and loads that stay as they were."""

import io
import zipfile

import pytest

from feedlake import fixtures
from feedlake.operators import ingest as I
from feedlake.operators import ledger, sheets
from feedlake.plans.defs import Feed, Layout, Sheet

LINES = Feed("t", "*.txt", layout=Layout.parse("t", "k:2, v:2"), batch=1)


def put(folder, name, content):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())


def counted(monkeypatch, module, name):
    real, calls = getattr(module, name), []
    monkeypatch.setattr(module, name, lambda *a, **k: calls.append(name) or real(*a, **k))
    return calls


def batches(spark, target):
    return sorted(r["n"] for r in ledger.read_ledger(spark, target).filter("n_rows IS NOT NULL").groupBy("batch").count().withColumnRenamed("count", "n").collect())


def test_batches_of_a_family_are_decoded_and_tidied_together(spark, tmp_path, monkeypatch):
    for k in range(5):
        bad = {"Table 2": [["only"], ["labels"]]} if k == 3 else {"Table 2": [["h", "x", "y"], ["r", k, k]]}
        put(tmp_path, f"in/B{k}.D250101.T000000{k}.xlsx", fixtures.workbook({"Table 1": [["h", "x", "y"], ["r", k, k]], **bad}))
    feeds = [Feed(f"t{k}", "*.xlsx", "sheet", sheet=Sheet(f"t{k}", f"Table {k}"), dates="path", batch=1) for k in (1, 2)]
    targets = {f.name: str(tmp_path / "out" / f.name) for f in feeds}
    calls = counted(monkeypatch, I, "tidy_family")
    with pytest.raises(sheets.SheetError, match="t2: .*B3.*no header"):
        I.ingest_sheets(spark, feeds, str(tmp_path / "in"), targets)
    assert len(calls) == 1
    values = {n: sorted(r["value_text"] for r in ledger.read_table(spark, t).collect()) for n, t in targets.items()}
    assert values == {"t1": [str(k) for k in range(5) for _ in "xy"], "t2": [str(k) for k in range(3) for _ in "xy"]}
    assert batches(spark, targets["t1"]) == [1] * 5 and batches(spark, targets["t2"]) == [1] * 3


def test_triggers_are_loaded_together_and_none_is_lost(spark, tmp_path, monkeypatch):
    from feedlake.streaming import ingest as S

    root, target, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    for k in range(6):
        put(root, f"{k}.txt", f"{k} x\n")
    calls = counted(monkeypatch, S, "load_listing")
    assert S.stream_ingest(spark, LINES, str(root), target, check, max_files_per_trigger=2) == 6
    assert len(calls) == 1 and batches(spark, target) == [1] * 6

    def dies(*_, **__):
        raise OSError("killed")

    put(root, "6.txt", "6 x\n")
    with monkeypatch.context() as m:
        m.setattr(S, "load_listing", dies)
        with pytest.raises(OSError, match="killed"):
            S.stream_ingest(spark, LINES, str(root), target, check, max_files_per_trigger=2)
    put(root, "7.txt", "7 x\n")
    monkeypatch.setattr(S, "ROUND_FILES", 1)
    assert S.stream_ingest(spark, LINES, str(root), target, check, max_files_per_trigger=2) == 2
    assert sorted(r["k"] for r in ledger.read_table(spark, target).collect()) == [str(k) for k in range(8)]
    assert S.stream_ingest(spark, LINES, str(root), target, check) == 0


def archive(**members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in members.items():
            z.writestr(f"{name}.csv", content)
    return buffer.getvalue()


def test_members_of_many_batches_are_read_in_one_plan(spark, tmp_path, monkeypatch):
    root, target = tmp_path / "in", str(tmp_path / "out")
    for k in range(4):
        put(root, f"a{k}!.zip", archive(x=f"k,c{k}\n{k},y\n", y=f"k\n{k + 4}\n", z="k\n"))
    feed = Feed("z", "*.zip", "zip_csv", dates="load", batch=2)
    calls = counted(monkeypatch, I, "read_feed")
    assert [I.ingest(spark, feed, str(root), target) for _ in range(2)] == [12, 0]
    assert len(calls) == 1 and batches(spark, target) == [2] * 6
    rows = ledger.read_table(spark, target)
    assert sorted((r["K"], r["C0"], r["C3"]) for r in rows.collect()) == [(str(k), "y" if k == 0 else None, "y" if k == 3 else None) for k in range(8)]
    assert sorted(r["n_rows"] for r in ledger.read_ledger(spark, target).filter("member IS NOT NULL").collect()) == [0] * 4 + [1] * 8
    paths = {r["file_path"] for r in rows.collect()}
    assert len(paths) == 8 and f"{root}/a0!.zipx.csv" in paths


def test_batches_ahead_of_a_file_that_cannot_be_read_are_loaded(spark, tmp_path, monkeypatch):
    root, target = tmp_path / "in", str(tmp_path / "out")
    for k in range(5):
        put(root, f"{k}.txt", f"{k} x\n")
    real = I.read_feed

    def reads(session, feed, files, org=""):
        if files.filter("file_path LIKE '%3.txt'").count():
            raise OSError("unreadable")
        return real(session, feed, files, org)

    monkeypatch.setattr(I, "read_feed", reads)
    with pytest.raises(OSError, match="unreadable"):
        I.ingest(spark, LINES, str(root), target)
    assert sorted(r["k"] for r in ledger.read_table(spark, target).collect()) == ["0", "1", "2"]
    monkeypatch.setattr(I, "read_feed", real)
    assert I.ingest(spark, LINES, str(root), target) == 2


def test_a_round_without_rows_is_a_table(spark, tmp_path):
    root, target = tmp_path / "in", str(tmp_path / "out")
    for k in range(2):
        put(root, f"a{k}.zip", archive(x="k,v\n"))
    assert I.ingest(spark, Feed("z", "*.zip", "zip_csv", dates="load", batch=1), str(root), target) == 2
    assert spark.read.parquet(target).count() == 0 and "V" in ledger.read_table(spark, target).columns


def test_rounds_hold_small_batches_up_to_a_bound():
    files = [{"packed": None, "size": s} for s in (1, 1, 1, I.ROUND_BYTES, 1)]
    assert [[len(b) for b in r] for r in I.rounds(files, 2)] == [[2], [2], [1]]
    assert [len(r) for r in I.rounds([{"packed": 1, "size": 9}] * (I.ROUND_FILES + 1), 1)] == [I.ROUND_FILES, 1]


def test_tasks_get_their_own_members_only(spark, tmp_path):
    import json

    from pyspark import cloudpickle

    from feedlake.sources import zip_feed

    members = [[f"/in/{k}.zip", f"/in/{k}.zip", "x.csv", 10] for k in range(5000)]
    source = cloudpickle.loads(cloudpickle.dumps(zip_feed.ArchiveCsv({"members": json.dumps(members), "partBytes": "10"})))
    reader = source.reader(None)
    assert len(reader.partitions()) == 5000 and len(cloudpickle.dumps((reader, source))) < 2000
    put(tmp_path, "0.zip", archive(x="a,b\n1,2\n", y="a\n3\n"))
    path = str(tmp_path / "0.zip")
    rows = zip_feed.scan_members(spark, [(path, path, m, 10) for m in ("x.csv", "y.csv")], part_bytes=1, columns=["B", "A"])
    assert sorted((r["member"], r["row_no"], tuple(r["cells"])) for r in rows.filter("row_no > 0").collect()) == [("x.csv", 1, ("2", "1")), ("y.csv", 1, (None, "3"))]
    assert rows.rdd.getNumPartitions() == 2


def test_rounds_ask_the_ledger_once(spark, tmp_path, monkeypatch):
    root, target = tmp_path / "in", str(tmp_path / "out")
    for k in range(8):
        put(root, f"a{k}.zip", archive(x=f"k,c{k}\n{k},y\n"))
    monkeypatch.setattr(I, "ROUND_FILES", 2)
    asked = [counted(monkeypatch, ledger, n) for n in ("known_batches", "table_schema")]
    assert I.ingest(spark, Feed("z", "*.zip", "zip_csv", dates="load", batch=1), str(root), target) == 8
    assert [len(a) for a in asked] == [2, 1]  # the second time for the row of opened archives
    rows = ledger.read_table(spark, target)
    assert sorted((r["K"], *(r[f"C{c}"] for c in range(8))) for r in rows.collect()) == [(str(k), *("y" if c == k else None for c in range(8))) for k in range(8)]
    assert batches(spark, target) == [1] * 8


def test_many_paths_are_listed_by_few_tasks(spark, tmp_path):
    from feedlake.sources import listing, store

    for k in range(store.LIST_TASKS + 16):
        put(tmp_path, f"{k}.txt", f"{k} x\n")
    before = spark.conf.get(store._LIST_SETTING)
    spark.sparkContext.setJobGroup("lists", "lists")
    try:
        found = listing.discover(spark, str(tmp_path), "*.txt")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("lists") for s in tracker.getJobInfo(j).stageIds]
    assert stages and max(s.numTasks for s in stages) <= store.LIST_TASKS
    assert found.count() == store.LIST_TASKS + 16 and spark.conf.get(store._LIST_SETTING) == before


def test_a_trigger_leaves_one_small_note_with_exact_times(spark, tmp_path, monkeypatch):
    import json
    import os

    from feedlake.streaming import ingest as S

    root, target, check = tmp_path / "in", str(tmp_path / "out"), tmp_path / "check"
    for k in range(3):
        put(root, f'é"{k}.txt', f"{k} x\n")
    with monkeypatch.context() as m:
        m.setattr(S, "load_pending", lambda *_, **__: None)
        assert S.stream_ingest(spark, LINES, str(root), target, str(check), max_files_per_trigger=2) == 0
    notes = [json.loads(line) for n in (check / "pending").glob("*.json") for line in n.read_text().splitlines()]
    assert len(list((check / "pending").glob("*.json"))) == 2
    assert {n["file_path"]: n["micros"] // 1000 for n in notes} == {str(f): os.stat(f).st_mtime_ns // 10**6 for f in root.iterdir()}
    assert S.stream_ingest(spark, LINES, str(root), target, str(check), max_files_per_trigger=2) == 3
    assert sorted(r["k"] for r in ledger.read_table(spark, target).collect()) == ["0", "1", "2"]


def test_tasks_that_read_members_have_a_bound(monkeypatch):
    import json

    from feedlake.sources import zip_feed

    sizes = [10, 10, 10, 10, 500, 10, 10, 10, 10]
    members = [[f"/{k}.zip", f"/{k}.zip", "x.csv", s] for k, s in enumerate(sizes)]
    parts = lambda: [[m[0] for m in p.members] for p in zip_feed.MemberReader({"members": json.dumps(members), "partBytes": "10"}).partitions()]
    assert [len(p) for p in parts()] == [1] * 9
    monkeypatch.setattr(zip_feed, "TASKS", 5)
    assert [len(p) for p in parts()] == [2, 2, 1, 2, 2]
    assert [m for p in parts() for m in p] == [m[0] for m in members]
    monkeypatch.setattr(zip_feed, "TASKS", 1)
    assert [len(p) for p in parts()] == [9]


def test_archives_are_opened_by_several_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    from feedlake.sources import zip_feed

    for k in range(40):
        put(tmp_path, f"{k}.zip", archive(x=f"a\n{k}\n"))
    # rows behind a shuffle, as those of a listing without what the ledger has
    archives = zip_feed.read_archives(spark, str(tmp_path)).select("path", "source").distinct()
    members = spark.createDataFrame([(r["path"], "x.csv") for r in archives.collect()], "archive string, member string")
    listed, heads = zip_feed.list_members(archives), zip_feed.member_headers(archives, members)
    for rows in (listed, heads):
        found = rows.select("archive", "member", F.spark_partition_id().alias("task")).collect()
        assert len(found) == len({r["archive"] for r in found}) == 40 and {r["member"] for r in found} == {"x.csv"}
        assert len({r["task"] for r in found}) > 1
