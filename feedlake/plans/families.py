"""The ten families of deliveries and their 59 tables."""

from __future__ import annotations

from .defs import Feed, Layout, Sheet

#: Files appended at once (fixed values): most families, claims, quality measures, workbooks.
DEFAULT_BATCH, CLAIMS_BATCH, QUALITY_BATCH, WORKBOOK_BATCH = 25, 3, 5, 2

#: Report tables (fixed values): table, first letters of archive and member, end of the member.
REPORTS = [
    ("AALR1_ASSIGNED_BENEFICIARIES", "ALR", "-1.csv"),
    ("AALR2_ASSIGNED_BENEFICIARIES_TIN", "ALR", "-2.csv"),
    ("AALR4_ASSIGNED_BENEFICIARIES_TIN_NPI", "ALR", "-4.csv"),
    ("AALR5_BENEFICIARY_TURNOVER", "ALR", "-5.csv"),
    ("AALR6_BENEFICIARIES_ASSIGNABLE_OR_VOLUNTARY", "ALR", "-6.csv"),
    ("AALR9_BENEFICIARIES_UNDERSERVED", "ALR", "-9.csv"),
    ("BAIP_BENEFICIARY_ADVANCED_INVESTMENT_PAYMENT", "BAIP", ".csv"),
    ("BEUR_BENEFICIARY_EXPENDITURE_UTILIZATION_REPORT", "BEUR", ".csv"),
    ("NCBP_NON_CLAIMS_BASED_PAYMENTS", "NCBP", ".csv"),
]

#: Quality tables (fixed values): table, sheet of the workbooks (None: never in one), end of the CSV member.
QUALITY = [
    ("MCQM_BENEFICIARIES", "Medicare_CQM_Beneficiaries", "_MCQMbenes.csv"),
    ("MCQM_DM_001SSP", "DM_001SSP", "_001.csv"),
    ("MCQM_BCS_112SSP", "BCS_112SSP", "_112.csv"),
    ("MCQM_CCS_113SSP", None, "_113.csv"),
    ("MCQM_DEP_134SSP", "DEP_134SSP", "_134.csv"),
    ("MCQM_HTN_236SSP", "HTN_236SSP", "_236.csv"),
]

#: Bundle and list tables (fixed values): table and glob of the file.
BUNDLES = [(f"SHADOW_BUNDLES_{x}", f"{x}_*.csv") for x in ("DM", "EPI", "HH", "HS", "IP", "OPL", "PB", "SN")]
LISTS = [("PARTICIPANTS_LIST", "Participants List*.csv"), ("PROVIDER_AND_SUPPLIER_LIST", "Providers and Suppliers List*.csv")]

#: Sheets of workbooks (fixed values): table's end and LIKE pattern; each family has a key/value sheet Parameters too.
BENCHMARK = [(f"TABLE_{x}", f"Table {x} - %") for x in ("1", "1A", "1B", "1C", "2", "3", "4", "5", "6")]
ANNUAL = [(f"TABLE_{x}", rf"Table\_{x}-%") for x in ("1", "1A", "3", "4", "4A")]
QUARTERLY = [(f"TABLE_{x}", rf"Table\_{x}-%") for x in ("1", "2", "3")]


def _workbooks(org: str, token: str, sheets: list[tuple[str, str]], dates: str) -> list[Feed]:
    glob = f"{org}/*/*/*/P.{org}*.{token}.*.xlsx"
    every = [Sheet(f"{token}_{t}", pattern) for t, pattern in sheets] + [Sheet(f"{token}_PARAMETERS", "Parameters", labels=("VALUE",))]
    return [Feed(s.table, glob, "sheet", sheet=s, dates=dates, token=f".{token}.", batch=WORKBOOK_BATCH) for s in every]


def families(org: str, layouts: dict[str, Layout]) -> dict[str, list[Feed]]:
    """The feeds of an organisation by family; `layouts` are those of `read_layouts`."""
    own = {k: v for k, v in layouts.items() if v.token != "MBI"}
    claims = [Feed(n, f"{org}/*/*/P.{org}.ACO*/*{v.token}*", layout=v, batch=CLAIMS_BATCH) for n, v in own.items()]
    xref = [Feed(n, f"{org}/*/*/P.{org}*{v.token}*", layout=v, batch=DEFAULT_BATCH) for n, v in layouts.items() if v.token == "MBI"]
    reports = [Feed(t, f"{org}/*/*/P.{org}.ACO*/*{kind}*T*", "zip_csv", member=f"*{kind}*{end}", dates="load", batch=DEFAULT_BATCH) for t, kind, end in REPORTS]
    quality = [
        Feed(t, f"{org}/*/*/P.{org}*/P.{org}.ACO.MCQM*", "quality", member=f"*{end}", sheet=Sheet(t, name) if name else None, dates="quarter", batch=QUALITY_BATCH)
        for t, name, end in QUALITY
    ]
    plain = lambda rows, folder: [Feed(t, f"{org}/*/*/{folder}{g}", "csv", dates="load", batch=DEFAULT_BATCH) for t, g in rows]
    return {
        "claims": claims,
        "reports": reports,
        "quality": quality,
        "bundles": plain(BUNDLES, f"{org}*SBMON*/"),
        "lists": plain(LISTS, ""),
        "exclusions": [Feed("beneficiary_exclusions", f"{org}/*/*/P.{org}.BNEX*.xml", "xml", batch=DEFAULT_BATCH)],
        "exclusion_xref": xref,
        "benchmark": _workbooks(org, "BNMRK", BENCHMARK, "stamp"),
        "annual": _workbooks(org, "AEXPU", ANNUAL, "year"),
        "quarterly": _workbooks(org, "QEXPU", QUARTERLY, "quarter"),
    }
