"""Reading any feed by its definition."""

from __future__ import annotations

from fnmatch import translate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions import paths as P
from feedlake.functions.text import join_list
from feedlake.plans.defs import CELL_GRAIN, Feed
from feedlake.sources import workbook, zip_feed
from feedlake.sources.csv_feed import read_csv_union
from feedlake.sources.fixed_width import read_fixed_width
from feedlake.sources.xml_feed import explode_records, read_xml_documents

from .lineage import file_dates, with_lineage, with_workbook_metadata
from .naming import dedupe_columns
from .sheets import tidy_family, union_by_name

#: The document of exclusions (fixed values).
EXCLUSIONS_TAG = "PFDCACOBeneData"
EXCLUSIONS = (
    "Header struct<HeaderCode:string,FileCreationDate:string,PerformanceYear:string,ReportMonth:string>, "
    "Beneficiarys struct<Beneficiary:array<struct<MBI:string,HICN:string,FirstName:string,MiddleName:string,LastName:string,"
    "DOB:string,Gender:string,BeneExcReasons:struct<BeneExcReason:array<string>>>>>"
)
#: The last year in which quality measures come as workbooks (fixed value).
LAST_WORKBOOK_YEAR = 2025


def read_exclusions(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """One row for each person of each document, reasons joined, the document's header on every row."""
    docs = read_xml_documents(spark, paths, EXCLUSIONS_TAG, EXCLUSIONS)
    rows = explode_records(docs, "Beneficiarys.Beneficiary", "Header")
    return rows.withColumn("beneexcreasons", join_list(F.col("beneexcreasons.BeneExcReason")))


def cell_grain(cells: DataFrame, feed: Feed, org: str) -> DataFrame:
    """A feed's sectioned sheets, tidy, in the columns and types of CELL_GRAIN; a sheet that can't be read ends the job."""
    return as_cell_grain(tidy_family(cells, [feed.sheet], strict=True), feed, org)


def as_cell_grain(tidy: DataFrame, feed: Feed, org: str) -> DataFrame:
    tidy = with_workbook_metadata(tidy, feed.dates, org, feed.token)
    return tidy.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CELL_GRAIN])


def headed_sheet(cells: DataFrame, sheet: str) -> DataFrame:
    """A headed sheet with every column that some file names, and file_path; the driver sees the names only."""
    head = cells.filter((F.col("sheet") == sheet) & (F.col("row_num") == 1))
    names = head.groupBy(F.upper(F.trim("value")).alias("name")).agg(F.min("col_idx").alias("at")).orderBy("at", "name").collect()
    return workbook.pivot_header(cells, sheet, [r["name"] for r in names]).drop("row_num")


def chosen_members(archives: DataFrame, feed: Feed) -> DataFrame:
    """(archive, member, packed, file_path) of the safe members that belong to a feed, data dictionaries left out.

    Members of quality archives are workbooks up to LAST_WORKBOOK_YEAR, if the feed has a sheet, and CSV behind it. Reports' file
    paths are the archive and the member without a mark between, those of quality members have one.
    """
    members = zip_feed.audit_members(zip_feed.list_members(archives)).filter("error IS NULL AND size(violations) = 0")
    fits = F.col("member").rlike("^" + translate(feed.member))
    if feed.kind == "quality":
        late = F.coalesce(F.regexp_extract("archive", r"\.([0-9]{4})Q[0-9]\.", 1).try_cast("int") > LAST_WORKBOOK_YEAR, F.lit(False))
        book = F.col("member").rlike("^" + translate("*.xlsx")) if feed.sheet is not None else F.lit(False)
        fits = F.when(late, fits).otherwise(book)
    path = F.concat("archive", F.lit("!" if feed.kind == "quality" else ""), "member")
    return members.filter(fits & ~F.col("member").contains("Dictionary")).select("archive", "member", "packed", path.alias("file_path"))


def _quality(archives: DataFrame, members: DataFrame, feed: Feed) -> DataFrame:
    """Measures of archives: the named sheet of workbooks, and CSV members."""
    book = F.col("member").endswith(".xlsx")
    parts = [zip_feed.read_zip_csv(archives, members.filter(~book))]
    if feed.sheet is not None:
        inner = members.filter(book).select("archive", F.col("file_path").alias("own"), F.col("member").alias("inner"))
        books = archives.join(inner, archives["path"] == F.col("archive")).select(F.col("own").alias("path"), "source", "inner")
        parts.append(headed_sheet(workbook.read_cells(books), feed.sheet.pattern))
    out = union_by_name(parts)
    archive, member = F.substring_index("file_path", "!", 1), F.substring_index("file_path", "!", -1)
    period = F.nullif(F.regexp_extract(F.concat(archive, F.lit("/"), member), r"\.([0-9]{4}Q[0-9])\.", 1), F.lit(""))
    return out.withColumns({"directory_name": archive, "file_name": member, "file_date": P.quarter_end(period), "period": period})


def _reports(archives: DataFrame, members: DataFrame, feed: Feed) -> DataFrame:
    """CSV members of archives; the mark between archive and member stays in the file's name, not in its path."""
    rows = zip_feed.read_zip_csv(archives, members)
    path = F.col("file_path")
    names = {"directory_name": P.directory_name(path), "file_name": P.base_name(path), "file_date": file_dates(feed.dates, path)}
    own = F.broadcast(members.select(F.concat("archive", F.lit("!"), "member").alias("__marked"), F.col("file_path").alias("__path")).distinct())
    return rows.withColumns(names).join(own, path == F.col("__marked")).withColumn("file_path", F.col("__path")).drop("__marked", "__path")


def read_feed(spark: SparkSession, feed: Feed, files: DataFrame, org: str = "") -> DataFrame:
    """All rows of a feed's files with lineage, by the feed's kind; archives and workbooks are decoded in tasks.

    `files` has file_path, path, source and, for archives, member and packed bytes.
    """
    if feed.kind == "sheet":
        return cell_grain(workbook.read_cells(files.select("path", "source")), feed, org)
    if feed.kind in ("quality", "zip_csv"):
        archives = files.select("path", "source").distinct()
        members = files.select(F.col("path").alias("archive"), "member", "packed", "file_path")
        return (_quality if feed.kind == "quality" else _reports)(archives, members, feed)
    paths = [r[0] for r in files.select("reader_path").orderBy("reader_path").collect()]
    if feed.kind == "csv":
        rows = read_csv_union(spark, paths)
    elif feed.kind == "xml":
        rows = read_exclusions(spark, paths)
    elif feed.kind == "fixed_width":
        rows = dedupe_columns(read_fixed_width(spark, paths, feed.layout))
    else:
        raise ValueError(f"no reader for {feed.kind}")
    return with_lineage(rows, file_dates(feed.dates, F.col("file_path")))
