"""Column expressions over delivery paths: lineage, stamps, periods, identities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def plain_path(uri: Column) -> Column:
    """A file URI as a plain path: scheme dropped, percent escapes decoded, '+' kept."""
    return F.regexp_replace(F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B"))), "^file:(//)?", "")


def directory_name(path: Column) -> Column:
    return F.regexp_extract(path, "^(.*)/", 1)


def base_name(path: Column) -> Column:
    """What is behind the last slash; it is asked for each row, and a pattern bound to the end only would be tried from each letter of a path."""
    return F.substring_index(path, "/", -1)


def short_stamp_date(path: Column) -> Column:
    """The leftmost .D<yymmdd>. stamp of a whole path as a date, or null for placeholders."""
    return F.try_to_date(F.concat(F.lit("20"), F.regexp_extract(path, r"\.D([0-9]{6})\.", 1)), "yyyyMMdd")


def quarter_end(token: Column) -> Column:
    """The last day of a 'YYYYQn' quarter; null where n isn't 1 to 4."""
    year, quarter = F.regexp_extract(token, r"^([0-9]{4})Q([1-4])$", 1), F.regexp_extract(token, r"^([0-9]{4})Q([1-4])$", 2)
    return F.when(quarter != "", F.last_day(F.make_date(F.try_to_number(year, F.lit("9999")).cast("int"), F.try_to_number(quarter, F.lit("9")).cast("int") * 3, F.lit(1))))


def quarter_token(name: Column) -> Column:
    """The leftmost YYYYQn between dots, or null."""
    return F.nullif(F.regexp_extract(name, r"\.([0-9]{4}Q[1-4])\.", 1), F.lit(""))


def year_end(name: Column) -> Column:
    """31 December of a .Y<year>. token, or null."""
    year = F.nullif(F.regexp_extract(name, r"\.Y([0-9]{4})\.", 1), F.lit(""))
    return F.make_date(year.cast("int"), F.lit(12), F.lit(31))


def creation_date(name: Column) -> Column:
    """The date of a .D stamp of 6 (yymmdd) or 8 (yyyymmdd) digits, or null."""
    stamp = F.regexp_extract(name, r"\.D([0-9]{8}|[0-9]{6})(\.|$)", 1)
    return F.try_to_date(F.when(F.length(stamp) == 6, F.concat(F.lit("20"), stamp)).otherwise(stamp), "yyyyMMdd")


def year_segment(path: Column, org: str) -> Column:
    """The four-digit segment after the last segment that names the organisation, or null."""
    parts = F.split(path, "/")
    places = F.sequence(F.lit(1), F.size(parts) - 1)
    found = F.filter(places, lambda k: (F.element_at(parts, k) == org) & F.element_at(parts, k + 1).rlike("^[0-9]{4}$"))
    return F.when(F.size(parts) > 1, F.when(F.size(found) > 0, F.element_at(parts, F.element_at(found, -1) + 1)))


def submission_id(name: Column) -> Column:
    """The seven digits of a .T stamp before the ending, or null."""
    return F.nullif(F.regexp_extract(name, r"\.T([0-9]{7})(\.xlsx)?$", 1), F.lit(""))


def is_stamped(name: Column) -> Column:
    """Whether a workbook's name has date and time stamps."""
    return name.rlike(r"\.D[0-9]{6}\.T[0-9]{7}\.xlsx$")


def redact_url(text: Column) -> Column:
    """URLs without user info, query and fragment."""
    return F.regexp_replace(F.regexp_replace(text, r"([A-Za-z][A-Za-z0-9+.-]*://)[^/@\s?#]*@", "$1"), r"([A-Za-z][A-Za-z0-9+.-]*://[^?#\s]*)[?#]\S*", "$1")


def location_violations(location: Column) -> Column:
    """Why a location may not be used as a source, as an array of words; empty where it may."""
    return F.array_compact(
        F.array(
            F.when(F.coalesce(F.trim(location), F.lit("")) == "", "blank"),
            F.when(~location.rlike(r"^(s3|az|azure|abfss|gs|https?)://"), "scheme"),
            F.when(location.rlike(r"(^|/)\.\.(/|$)"), "traversal"),
            F.when(location.rlike(r"[*?\[\]{}]"), "glob"),
            F.when(location.rlike(r"[?#]"), "query"),
            F.when(location.rlike(r"://[^/]*@"), "credentials"),
            F.when(location.rlike(r"[^\x21-\x7e]"), "charset"),
        )
    )
