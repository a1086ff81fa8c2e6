"""Dates, identifiers and names found in file paths and other metadata by patterns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import _col, _text

# Patterns of dates (strict, then legacy), identifiers, and what is no identifier or name.
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December|Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Sept|Oct|Nov|Dec"
DATES = (
    rf"(?i)\b((?:{MONTHS})\.?\s+\d{{1,2}}(?:st|nd|rd|th)?,?\s+\d{{4}})\b",
    r"\b(\d{4}-\d{1,2}-\d{1,2})\b", r"\b(\d{1,2}[/.-]\d{1,2}[/.-]\d{4})\b", r"\b(\d{1,2}[/.-]\d{1,2}[/.-]\d{2})\b", r"\b(\d{4}[/.]\d{1,2}[/.]\d{1,2})\b",
    r"(\d{4}[01]\d[0-3]\d)", r"([01]\d[0-3]\d\d{4})", r"(\d{4}-\d{1,2}-\d{1,2})", r"(\d{1,2}[/.-]\d{1,2}[/.-]\d{2,4})", r"(\d{2}\.\d{2}\.\d{2})", r"([01]\d[0-3]\d\d{2})",
)
LEGACY_DATES = (
    r"\b(\d{4}-\d{1,2}-\d{1,2})\b", r"\b(\d{4}-\d{1,2})\b", r"\b(\d{1,2}[/.-]\d{1,2}[/.-]\d{4})\b", r"\b(\d{1,2}[/.-]\d{1,2}[/.-]\d{2})\b", r"\b(\d{4}[/.]\d{1,2}[/.]\d{1,2})\b",
    r"\b(\d{4}[01]\d[0-3]\d)\b", r"(\d{4}-\d{1,2}-\d{1,2})", r"(\d{1,2}[/.-]\d{1,2}[/.-]\d{2,4})", r"(\d{2}\.\d{2}\.\d{2})",
)
IDS = (
    r"(?i)((?:IAD|IA|OIA|OAI)[-_]?\d{2,4}[-_]?\d{1,4})", r"(?i)Case#([A-Za-z0-9-]+)", r"(?i)\b([A-Z]-[A-Z]{2,4}-\d{1,3}-\d{1,2}-[A-Z])\b",
    r"(?:^|(?<=[^0-9]))(\d{2,4}-\d{3,5}-\d{3,5})(?=[^0-9]|$)", r"(?:^|(?<=[^0-9]))(\d{2,4}-\d{3,5})(?=[^0-9]|$)", r"(?i)(?:^|(?<=[^A-Za-z0-9]))([A-Z]{2,4}\d{6,})(?=[^A-Za-z0-9]|$)", r"(?i)\b(OIS[-_]?\d{4,})\b",
)
LEGACY_IDS = (
    r"(?i)((?:IAD|IA|OIA|OAI)[-_]?\d+)", r"(?i)\b([A-Z]-[A-Z]{2,4}-\d{1,3}-\d{1,2}-[A-Z])\b", r"(?i)((?:IAD|IA|OIA|OAI)[-_]?\d{2,4}[-_]?\d{1,4})", r"(?i)Case#([A-Za-z0-9-]+)",
    r"(?i)([A-Z]-[A-Z]{2,4}-\d{1,3}-\d{1,2}-[A-Z])", r"\b(\d{4}-\d{4})\b", r"\b(\d{2,4}-\d{2,4})\b", r"(?i)(IAD\d+)", r"(?i)(IA\d+)", r"(?i)(OIA\d+)", r"(?i)(OAI\d+)",
)
NO_IDS = r"(?i)^(?:F\d{1,3}|TF\d+[A-Z]?|FMT\d+|\d{1,6}|[A-Z]{1,2}\d{1,2}|[A-Z]{2,6}|FILE\d+|IADFORM\d*|INCIDENT\d*|REPORT\d*|FORM\d*|OIS(?:19|20)\d{2})$"
NO_PERSONS = r"^b\s*\d+\s*b|^\d+\s*\d+\s*b\s*\d+\s*[a-z]|subject\s*b\s*\d+\s*b|name\s*redacted|victim|suspect|unnamed|^unknown|\bdoe\b|witness\s+\d+|officer\s*\d+|^confidential\s+informant|\bci\b|^[a-z]+$|^\w{1,2}$"
TITLED = r"(?i)\b(?:Officer|Det\.|Detective|Sgt\.|Sergeant|Lt\.|Lieutenant|Cpl\.|Corporal|Chief|Sheriff|Deputy)\s+(?!of\s|or\s)([A-Z][a-z]+\s+(?:[A-Z][a-z]*\s+)?[A-Z][a-z]+)\b"
SUFFIXED = r"(?i)\b([A-Z][a-z]{2,}\s+(?:[A-Z][a-z]{2,}\s+)?[A-Z][a-z]{2,}\s+(?:Jr\.|Sr\.|I{1,3}|IV))\b"
LAST_INITIAL = r"\b([A-Z][a-z]{2,}),\s+([A-Z])(?:\b|\s|\.|\s-\s)"
ORGANISATIONS = ("of police", "or police", "of the police", "police department", "police commission", "police board", "city of", "county of", "state of", "department of", "board of", "bureau of")


def _all(c: Column, patterns) -> Column:
    return F.concat(*[F.regexp_extract_all(c, F.lit(p), F.lit(1)) for p in patterns])


def _cut(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.substring_index(F.substring_index(x, "(", 1), "__", 1), r"^\s+|\s+$", ""))


def metadata_dates(c, patterns=DATES) -> Column:
    """Distinct date-like strings of a text, by pattern and then place."""
    return F.array_distinct(F.filter(F.transform(_all(_text(c), patterns), _cut), lambda x: x != ""))


def legacy_dates(c) -> Column:
    return metadata_dates(c, LEGACY_DATES)


def metadata_ids(c) -> Column:
    """Distinct identifiers of a text that are specific enough, without those that are part of another."""
    found = F.transform(_all(_text(c), IDS), lambda x: F.regexp_replace(_cut(F.regexp_replace(x, r"\s+", "")), "^_+|_+$", ""))
    ids = F.array_distinct(F.filter(found, lambda x: (x != "") & ~x.rlike(NO_IDS)))
    return F.filter(ids, lambda x: ~F.exists(ids, lambda y: (x != y) & F.contains(y, x)))


def legacy_ids(c) -> Column:
    found = F.transform(_all(_text(c), LEGACY_IDS), lambda x: F.regexp_replace(_cut(F.regexp_replace(x, r"\s+", "")), "^_|_$", ""))
    return F.array_sort(F.array_distinct(F.filter(found, lambda x: x != "")))


def metadata_names(c) -> Column:
    """Names of persons in a text: "Last, F", after titles, and with suffixes; the first of each spelling in lower case."""
    text = _text(c)
    last, initial = (F.regexp_extract_all(text, F.lit(LAST_INITIAL), F.lit(k)) for k in (1, 2))
    short = F.zip_with(last, initial, lambda a, b: F.concat(a, F.lit(", "), b))
    long = F.filter(_all(text, (TITLED, SUFFIXED)), lambda x: (F.length(F.trim(x)) >= 4) & ~F.lower(x).rlike("|".join(ORGANISATIONS)))
    names = F.filter(F.concat(short, F.transform(long, lambda x: F.trim(x))), lambda x: ~F.lower(x).rlike(NO_PERSONS))
    keys = F.transform(names, F.lower)
    return F.filter(F.transform(names, lambda x, i: F.when(F.array_position(keys, F.lower(x)) == i + 1, x)), lambda x: x.isNotNull())


def path_parts(c) -> Column:
    """Struct of a path's directory and file name."""
    return F.struct(F.regexp_extract(_text(c), "^(.*)/[^/]*$", 1).alias("directory"), F.regexp_extract(_text(c), "([^/]*)$", 1).alias("name"))


def export_agency(c) -> Column:
    """The agency in an export's file name: output--agency--date."""
    return F.regexp_extract(_text(c), r"output--(.+?)--\d{4}-\d{2}-\d{2}", 1)


def answer_indices(c, n: int, most: int) -> Column:
    """Numbers below ``n`` in an answer, each once, ``most`` at most."""
    found = F.transform(F.regexp_extract_all(_text(c), F.lit(r"\b(\d+)\b"), F.lit(1)), lambda x: x.try_cast("int"))
    return F.slice(F.array_distinct(F.filter(found, lambda x: x.isNotNull() & (x < n))), 1, most)


def marked_line(c, mark: str) -> Column:
    """What follows the colon in the first line with ``mark`` (in any case)."""
    line = F.element_at(F.filter(F.split(_text(c), "\n"), lambda x: F.contains(F.upper(x), F.lit(mark.upper()))), 1)
    return F.trim(F.regexp_replace(line, "^[^:]*:", ""))


def before_reasoning(c) -> Column:
    """Struct of an answer before, and from, its first line that mentions reasoning."""
    return F.struct(F.regexp_extract(_text(c), r"(?is)^(.*?)(?:^|\n)[^\n]*REASONING", 1).alias("meta"), F.regexp_extract(_text(c), r"(?is)((?:^|\n)[^\n]*REASONING.*)$", 1).alias("reasoning"))


def heading_line(c) -> Column:
    """Whether a line is a heading in capitals."""
    return _col(c).rlike(r"^\s*[A-Z][A-Z0-9 ,.&/()-]{3,}$")


def section_line(c) -> Column:
    return _col(c).rlike(r"^\s*\d+(?:\.\d+)+\b")
