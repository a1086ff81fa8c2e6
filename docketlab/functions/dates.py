"""Dates in many formats, and differences between sets of them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import _col, _text

# Formats in the order in which they are tried. Two-digit years of 69 and later are of the last century.
FORMATS = ("yyyy-M-d", "yyyy/M/d", "yyyy.M.d", "M/d/yyyy", "M-d-yyyy", "M.d.yyyy", "yy-M-d", "yy/M/d", "yy.M.d", "M/d/yy", "M-d-yy", "M.d.yy", "MMMM d, yyyy", "MMM d, yyyy")
LEGACY_FORMATS = ("yyyy-M-d", "M/d/yyyy", "M-d-yyyy", "M.d.yyyy", "yyyy/M/d", "yyyy.M.d", "yyyyMMdd", "M/d/yy", "M-d-yy", "M.d.yy", "d.M.yy")
_SHAPE = {"yyyy": "[0-9]{4}", "MMMM": "[A-Za-z]+", "MMM": "[A-Za-z]{3}", "MM": "[0-9]{2}", "dd": "[0-9]{2}", "yy": "[0-9]{2}", "M": "[0-9]{1,2}", "d": "[0-9]{1,2}"}


def _parse(c: Column, fmt: str) -> Column:
    """A date by one format, or null; the shape is checked first, as parsers are lenient about digits."""
    shape, at = "", 0
    while at < len(fmt):
        for part in ("yyyy", "MMMM", "MMM", "MM", "dd", "yy", "M", "d"):
            if fmt.startswith(part, at):
                shape, at = shape + _SHAPE[part], at + len(part)
                break
        else:
            shape, at = shape + ("\\." if fmt[at] == "." else fmt[at]), at + 1
    value = F.initcap(c) if "MMM" in fmt else c
    day = F.to_date(F.try_to_timestamp(value, F.lit(fmt)))
    if "yyyy" not in fmt and "yy" in fmt:
        day = F.when(F.year(day) >= 2069, F.add_months(day, -1200)).otherwise(day)
    return F.when(c.rlike(f"^{shape}$"), day)


def parse_date(c) -> Column:
    """The day that a string names, or null. Strings like times (12:30, 18.14.24) name none; years are 1900 to 2100.

    Six digits are month, day and year, or else year, month and day; eight are year first, or else month first.
    """
    v = F.trim(_text(c))
    tried = [_parse(v, f) for f in (*FORMATS[:12], "yyyyMMdd", *FORMATS[12:], "MMddyy", "yyMMdd", "MMddyyyy")]
    day = F.when(v.rlike(r"^[0-9]{1,2}[:.\-][0-9]{1,2}[:.\-][0-9]{1,2}$") | v.rlike(r"^[0-9]{1,2}:[0-9]{2}$"), F.lit(None).cast("date")).otherwise(F.coalesce(*tried))
    return F.when(F.year(day).between(1900, 2100), day)


def legacy_date(c) -> Column:
    return F.coalesce(*[_parse(_text(c), f) for f in LEGACY_FORMATS])


def date_set(values) -> Column:
    """Distinct days of an array of strings, as ISO strings in order."""
    days = F.transform(F.coalesce(_col(values), F.array().cast("array<string>")), lambda x: F.date_format(parse_date(x), "yyyy-MM-dd"))
    return F.array_sort(F.array_distinct(F.filter(days, lambda x: x.isNotNull())))


def iso_date(c) -> Column:
    """A date if the string is a valid one of the form yyyy-MM-dd, else null."""
    return F.when(_text(c).rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.to_date(F.try_to_timestamp(_text(c), F.lit("yyyy-MM-dd"))))


def least_gap(a, b) -> Column:
    """Least difference in days between two arrays of ISO strings; -1 if either is empty."""
    return F.coalesce(days_gap(F.transform(_col(a), lambda x: x.cast("date")), F.transform(_col(b), lambda x: x.cast("date"))), F.lit(-1))


def days_gap(a, b) -> Column:
    """Least difference in days between two arrays of dates; null if either is empty."""
    return F.array_min(F.flatten(F.transform(_col(a), lambda x: F.transform(_col(b), lambda y: F.abs(F.datediff(x, y))))))


def within_days(a, b, days: int = 365, required: bool = False) -> Column:
    gap = least_gap(a, b)
    return F.when(gap < 0, F.lit(not required)).otherwise(gap <= days)


def days_apart(a, b) -> Column:
    return F.abs(F.datediff(iso_date(a), iso_date(b)))


def from_parts(year, month, day) -> Column:
    """ISO text of three numbers (not checked against the calendar), null if any is missing."""
    y, m, d = (_col(x).cast("int") for x in (year, month, day))
    return F.when(y.isNotNull() & m.isNotNull() & d.isNotNull(), F.format_string("%d-%02d-%02d", y, m, d))


def range_dates(c) -> Column:
    """ISO days of "YYYYMMDD[-YYYYMMDD], ...": both ends of each range."""
    parts = F.filter(F.split(F.regexp_replace(_text(c), r"\s", ""), "[,-]"), lambda x: x.rlike("^[0-9]{8}$"))
    return F.transform(parts, lambda x: F.concat_ws("-", F.substring(x, 1, 4), F.substring(x, 5, 2), F.substring(x, 7, 2)))


def truth_dates(start, end, ranges) -> Column:
    """All days of a labelled case: start, end, and those of its ranges."""
    return F.concat(F.array_compact(F.array(_col(start), _col(end))), range_dates(ranges))


def dates_match(found, truth, start) -> Column:
    """Whether days agree: any in common, or nothing found where there is no start."""
    nothing = F.coalesce(F.size(_col(found)), F.lit(0)) <= 0
    return F.when(_col(start).isNull() & nothing, True).otherwise(F.coalesce(F.arrays_overlap(_col(found), _col(truth)), F.lit(False)))


def latest_year(c) -> Column:
    """Latest year among the dates of a comma list, or else the first number from 1900 to 2099 in it."""
    years = F.transform(F.split(_text(c), ","), lambda x: F.year(parse_date(F.trim(x))))
    fallback = F.regexp_extract(_text(c), r"\b((?:19|20)[0-9]{2})\b", 1)
    return F.coalesce(F.array_max(F.filter(years, lambda y: y.isNotNull())), F.when(fallback != "", fallback.cast("int")))


def naive_timestamp(c) -> Column:
    """A timestamp without zone (zoned ones as of UTC), null for empty or unreadable text."""
    return F.try_to_timestamp(F.nullif(F.trim(_text(c)), F.lit(""))).cast("timestamp_ntz")
