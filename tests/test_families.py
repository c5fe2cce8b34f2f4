import datetime
import io
import zipfile
from pathlib import Path

from feedlake import fixtures
from feedlake.operators.ingest import ingest
from feedlake.plans.defs import CELL_GRAIN, read_layouts
from feedlake.plans.families import families

ORG = "A0001"
FEEDS = {f.name: f for group in families(ORG, read_layouts(str(Path(__file__).resolve().parents[1] / "FIXTURES.md"))).values() for f in group}
TABLE = [["Title"], [None, "BY1", "BY2"], ["People"], ["[A1] Assigned", 5780, 5902], ["ESRD", None, 42], ["Note: rounded."], ["behind", 1, 2]]


def put(root, path, content):
    file = root / ORG / path
    file.parent.mkdir(parents=True, exist_ok=True)
    file.write_bytes(content if isinstance(content, bytes) else content.encode())


def packed(**members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, content in members.items():
            z.writestr(name.replace("__", "-").replace("_dot_", "."), content)
    return buffer.getvalue()


def load(spark, name, root, tmp, **kw):
    target = str(tmp / "out" / name)
    return ingest(spark, FEEDS[name], str(root), target, org=ORG, **kw), spark.read.option("mergeSchema", True).parquet(target)


def test_there_are_59_tables_of_ten_families():
    groups = families(ORG, read_layouts(str(Path(__file__).resolve().parents[1] / "FIXTURES.md")))
    assert len(groups) == 10 and len(FEEDS) == sum(map(len, groups.values())) == 59


def test_fixed_width_in_batches(spark, tmp_path):
    line = "A" * 13 + " " * 424
    for k in range(7):
        put(tmp_path, f"2025/ZCY25/P.{ORG}.ACO.ZCY25/P.{ORG}.ACO.ZC1Y25.D25010{k + 1}.T000000{k}", line + "\n")
    assert FEEDS["parta_claims_header"].batch == 3
    n, rows = load(spark, "parta_claims_header", tmp_path, tmp_path)
    assert n == 7 and rows.count() == 7 and rows.select("file_date").distinct().count() == 7
    n, rows = load(spark, "parta_claims_header", tmp_path, tmp_path, refresh=True)
    assert n == 7 and rows.count() == 7
    assert load(spark, "parta_claims_header", tmp_path, tmp_path)[0] == 0


def test_reports_have_the_load_date_and_may_gain_columns(spark, tmp_path):
    folder = f"2025/QEXPU/P.{ORG}.ACO.QEXPU.D259999.T0000000"
    put(tmp_path, f"{folder}/P.{ORG}.ACO.AALR.D259999.T0000001", packed(**{"ALR_x__1_dot_csv": "mbi,aco\n1,a\n", "ALR_x__2_dot_csv": "tin\n9\n"}))
    n, rows = load(spark, "AALR1_ASSIGNED_BENEFICIARIES", tmp_path, tmp_path)
    assert n == 1 and [tuple(r) for r in rows.select("MBI", "ACO").collect()] == [("1", "a")]
    assert rows.first()["file_date"] in (datetime.date.today(), datetime.date.today() - datetime.timedelta(1))
    put(tmp_path, f"{folder}/P.{ORG}.ACO.AALR.D259999.T0000002", packed(**{"ALR_y__1_dot_csv": "mbi,extra\n2,e\n"}))
    n, rows = load(spark, "AALR1_ASSIGNED_BENEFICIARIES", tmp_path, tmp_path)
    assert n == 1 and {tuple(r) for r in rows.select("MBI", "ACO", "EXTRA").collect()} == {("1", "a", None), ("2", None, "e")}


def test_quality_measures_from_workbooks_and_later_from_csv(spark, tmp_path):
    book = fixtures.workbook({"DM_001SSP": [["BENE_MBI_ID", "DM_AGE"], ["1", "70"]], "Other": [["X"], ["y"]]})
    put(tmp_path, f"2025/Q/P.{ORG}.QMCQM.D259999.T04/P.{ORG}.ACO.MCQM.2025Q4.D259999.T04", packed(quality_dot_xlsx=book))
    csv = packed(**{"P_001_dot_csv": "BENE_MBI_ID,DM_DX\n2,y\n", "P_112_dot_csv": "BENE_MBI_ID\n3\n", "DataDictionary_dot_xlsx": b"decoy"})
    put(tmp_path, f"2026/Q/P.{ORG}.ACO.QEXPU.D269999.T01/P.{ORG}.ACO.MCQM.2026Q1.D269999.T01.zip", csv)
    n, rows = load(spark, "MCQM_DM_001SSP", tmp_path, tmp_path)
    got = {tuple(r) for r in rows.select("BENE_MBI_ID", "DM_AGE", "DM_DX", "period", "file_date", "file_name").collect()}
    assert n == 2
    assert got == {("1", "70", None, "2025Q4", datetime.date(2025, 12, 31), "quality.xlsx"), ("2", None, "y", "2026Q1", datetime.date(2026, 3, 31), "P_001.csv")}
    assert load(spark, "MCQM_DM_001SSP", tmp_path, tmp_path)[0] == 0


def test_plain_lists_bundles_and_documents(spark, tmp_path):
    put(tmp_path, f"2025/SB/{ORG}.SBMON.1/DM_x.csv", "a,b\n1,2\n")
    put(tmp_path, "2025/PL/Participants List 1.csv", "name\nann\n")
    xml = "<PFDCACOBeneData><Header><HeaderCode>H</HeaderCode><FileCreationDate>20250101</FileCreationDate><PerformanceYear>2025</PerformanceYear><ReportMonth>01</ReportMonth></Header><Beneficiarys><Beneficiary><MBI>M1</MBI><BeneExcReasons><BeneExcReason>A</BeneExcReason><BeneExcReason>B</BeneExcReason></BeneExcReasons></Beneficiary></Beneficiarys></PFDCACOBeneData>"
    put(tmp_path, f"2025/BNEX/P.{ORG}.BNEX.R25.D250101.T1234567.xml", xml)
    assert load(spark, "SHADOW_BUNDLES_DM", tmp_path, tmp_path)[1].select("A", "B").first() == ("1", "2")
    assert load(spark, "PARTICIPANTS_LIST", tmp_path, tmp_path)[1].select("NAME").first() == ("ann",)
    row = load(spark, "beneficiary_exclusions", tmp_path, tmp_path)[1].first()
    assert (row["mbi"], row["beneexcreasons"], row["headercode"], row["file_date"]) == ("M1", "A,B", "H", datetime.date(2025, 1, 1))


def test_workbooks_become_the_cell_grain(spark, tmp_path):
    book = fixtures.workbook({"Table_1-Main": TABLE, "Table_1A-Other": TABLE, "Parameters": [["Note", "x"], ["Rate", 3]]})
    folder = f"2025/01/P.{ORG}.ACO.BNMRK.D259999.T1111111"
    for year in (2022, 2023):
        put(tmp_path, f"{folder}/P.{ORG}.ACO.AEXPU.Y{year}.D259999.T1111111.xlsx", book)
    put(tmp_path, f"{folder}/P.{ORG}.ACO.AEXPU.Y2024.D259999.T1111111.backup.xlsx", book)
    put(tmp_path, f"{folder}/P.{ORG}.ACO.BNMRK.D250131.T2222222.xlsx", fixtures.workbook({"Table 1 - x": TABLE}))
    _, rows = load(spark, "AEXPU_TABLE_1", tmp_path, tmp_path)
    assert rows.dtypes == [(f.name, f.dataType.simpleString()) for f in CELL_GRAIN]
    got = {tuple(r) for r in rows.filter("benchmark_year = 2022").select("row_num", "section_code", "row_label", "column_label", "value_text").collect()}
    assert got == {(4, "A1", "[A1] Assigned", "BY1", "5780"), (4, "A1", "[A1] Assigned", "BY2", "5902"), (5, "A1", "ESRD", "BY1", None), (5, "A1", "ESRD", "BY2", "42")}
    meta = {tuple(r) for r in rows.select("file_date", "aco_id", "performance_year", "benchmark_year", "submission_id", "period").distinct().collect()}
    assert meta == {(datetime.date(y, 12, 31), ORG, "2025", str(y), "1111111", f"Y{y}") for y in (2022, 2023)}
    assert load(spark, "AEXPU_PARAMETERS", tmp_path, tmp_path)[1].count() == 4
    assert load(spark, "AEXPU_TABLE_4", tmp_path, tmp_path)[1].count() == 0
    row = load(spark, "BNMRK_TABLE_1", tmp_path, tmp_path)[1].first()
    assert (row["file_date"], row["benchmark_year"], row["period"]) == (datetime.date(2025, 1, 31), None, "2222222")
