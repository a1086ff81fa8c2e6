"""Lists and JSON kept in strings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import _col, _text


def _array(c: Column) -> Column:
    """A JSON or single-quoted list; bare None counts as null."""
    return F.from_json(F.regexp_replace(c, r"\bNone\b", "null"), "array<string>")


def text_list(c) -> Column:
    """Elements of a list literal, of a JSON object's values, of a comma list, or the text alone; blanks and nulls go."""
    v = F.trim(_text(c))
    parsed = F.when(v.startswith("["), _array(v)).when(v.startswith("{"), F.map_values(F.from_json(v, "map<string,string>")))
    split = F.split(v, ",")
    return F.filter(F.transform(F.coalesce(parsed, split), lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != ""))


def text_list_or_null(c) -> Column:
    out = text_list(c)
    return F.when(F.size(out) > 0, out)


def json_field(c, field: str) -> Column:
    """One field of each object of a JSON array, or of a single object."""
    many = F.from_json(_col(c), f"array<struct<{field}:string>>")[field]
    one = F.array(F.from_json(_col(c), f"struct<{field}:string>")[field])
    return F.array_compact(F.when(F.trim(_text(c)).startswith("["), many).otherwise(one))


def page_texts(c) -> Column:
    """(page, text) structs of JSON pages, whose keys may be page_number/text or page/page_content, bare or in messages."""
    schema = "array<struct<page_number:int,page:int,text:string,page_content:string>>"
    rows = F.coalesce(F.when(F.trim(_text(c)).startswith("["), F.from_json(_col(c), schema)), F.from_json(_col(c), f"struct<messages:{schema}>")["messages"])
    return F.transform(rows, lambda x: F.struct(F.coalesce(x["page_number"], x["page"]).alias("page"), F.coalesce(x["text"], x["page_content"]).alias("text")))


def whole_text(c) -> Column:
    """The pages' texts with blank lines between, or the string itself if it holds no pages."""
    return F.coalesce(F.array_join(F.transform(page_texts(c), lambda x: x["text"]), "\n\n"), _col(c))


def agencies_to_check(agency, mentioned) -> Column:
    """The source agency and those of a list literal; any other string is one agency."""
    more = F.when(F.trim(_text(mentioned)) == "", F.array().cast("array<string>")).otherwise(F.coalesce(F.when(F.trim(_text(mentioned)).startswith("["), _array(_text(mentioned))), F.array(_text(mentioned))))
    return F.concat(F.array_compact(F.array(F.nullif(_text(agency), F.lit("")))), F.filter(more, lambda x: x.isNotNull() & (x != "")))


def cluster_id(c) -> Column:
    return F.regexp_extract(_col(c).cast("string"), r"^\[?\s*(-?\d+)", 1).try_cast("int")


def chunks(values, n: int = 4) -> Column:
    """The array in slices of ``n``."""
    size = F.size(_col(values))
    starts = F.when(size > 0, F.sequence(F.lit(0), F.greatest(size - 1, F.lit(0)), F.lit(n))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.slice(_col(values), i + 1, n))


def backfilled(indices, n, count) -> Column:
    """Chosen indices, then the others below ``n`` in order, ``count`` in all."""
    every = F.sequence(F.lit(0), _col(n) - 1) if not isinstance(n, int) else F.sequence(F.lit(0), F.lit(n - 1))
    return F.slice(F.array_distinct(F.concat(_col(indices), every)), 1, count)


def text_vector(c) -> Column:
    """Numbers of a comma list or a space-separated array, or null if any is none."""
    parts = F.filter(F.split(F.regexp_replace(_text(c), r"[\[\],]", " "), r"\s+"), lambda x: x != "")
    numbers = F.transform(parts, lambda x: x.try_cast("float"))
    return F.when((F.size(parts) > 0) & ~F.exists(numbers, lambda x: x.isNull()), numbers)


def ordered_union(a, b) -> Column:
    return F.array_distinct(F.concat(_col(a), _col(b)))
