"""Case records from document tables, page ranges, and clean-up of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.lists import page_texts
from ..functions.text import _text, case_key

NO_SUMMARY = "No summary"


def without_listed(df: DataFrame, key: str, deny: list[str]) -> DataFrame:
    return df.where(~F.coalesce(F.col(key).isin(deny), F.lit(False))) if deny else df


def blank_for(df: DataFrame, key: str, listed: list[str], columns: list[str]) -> DataFrame:
    """Those of the columns that are there, empty for listed keys."""
    hit = F.coalesce(F.col(key).isin(listed), F.lit(False)) if listed else F.lit(False)
    return df.withColumns({c: F.when(hit, F.lit("")).otherwise(F.col(c).cast("string")) for c in columns if c in df.columns})


def fill_labels(df: DataFrame, columns: list[str], value: str = "UNCLEAR") -> DataFrame:
    return df.fillna({c: value for c in columns if c in df.columns})


def number_part(c) -> Column:
    """A number out of text that may hold "na" and white space, or null."""
    return F.nullif(F.regexp_replace(_text(c), r"na|\s+", ""), F.lit("")).try_cast("double")


def belongs(c, any_case: bool = False) -> Column:
    return (F.lower(_text(c)) == "true") if any_case else (_text(c) == "TRUE")


def assigned(c) -> Column:
    """Whether a case name is given: not null, and without "n/a" or a question mark."""
    return ~F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("?")).rlike(r"n/a|\?")


def matches_keywords(c, patterns: list[str]) -> Column:
    """Whether a text has any of the keywords; lines that begin with # are none."""
    words = [p.strip().lower() for p in patterns if p.strip() and not p.strip().startswith("#")]
    out = F.lit(False)
    for w in words:
        out = out | F.contains(F.lower(_text(c)), F.lit(w))
    return out


def readable_page(c, least: int = 50) -> Column:
    return F.length(F.trim(_text(c))) >= least


def nonempty_documents(pages: DataFrame, doc: str, text: str, least: int = 150) -> DataFrame:
    """Pages of documents with at least one page of so many characters."""
    longest = F.max(F.length(F.trim(_text(text)))).over(W.partitionBy(doc))
    return pages.withColumn("__n", longest).where(F.col("__n") >= least).drop("__n")


def with_columns(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Columns that are missing, as nulls of their types."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in wanted.items() if c not in df.columns})


def only_columns(df: DataFrame, allowed: list[str]) -> DataFrame:
    return df.select([c for c in allowed if c in df.columns])


def case_records(cases: DataFrame, documents: DataFrame, key: str, order: str, summary: str, ocr: str, keep_null: bool = False) -> DataFrame:
    """One row for each case with its summaries and texts in order; a case without documents has one empty summary."""
    given = F.coalesce(summary, F.lit(NO_SUMMARY)) if keep_null else F.col(summary)
    rows = documents.select(case_key(key).alias("__k"), F.struct(F.col(order).alias("o"), given.alias("s"), F.col(ocr).alias("t")).alias("x"))
    grouped = rows.groupBy("__k").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    part = lambda f: F.array_compact(F.transform("xs", lambda x: x[f]))
    joined = cases.select(case_key(key).alias("__k")).distinct().join(grouped, "__k", "left")
    summaries = F.coalesce(part("s"), F.array().cast("array<string>"))
    return joined.select(F.col("__k").alias(key), F.when(F.size(summaries) > 0, summaries).otherwise(F.array(F.lit(NO_SUMMARY))).alias("summaries"), F.coalesce(part("t"), F.array().cast("array<string>")).alias("ocr_texts"))


PAGE_BREAK = "\n\n===== PAGE BREAK =====\n\n"


def page_range_text(pages: Column, start: Column, end: Column) -> Column:
    """Texts of the (page, text) structs in a range; of all, if none is in it or it is not given."""
    inside = F.filter(pages, lambda x: x["page"].between(start, end))
    chosen = F.when(start.isNull() | end.isNull() | (F.size(inside) == 0), pages).otherwise(inside)
    return F.array_join(F.transform(chosen, lambda x: x["text"]), PAGE_BREAK)


def page_range_of_json(ocr, start, end) -> Column:
    return F.coalesce(page_range_text(page_texts(ocr), F.col(start), F.col(end)), F.col(ocr))


def first_rows(df: DataFrame, key: str, order: str, n: int) -> DataFrame:
    return df.withColumn("__n", F.row_number().over(W.partitionBy(key).orderBy(order))).where(F.col("__n") <= n).drop("__n")


def keep_first(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each key by an explicit order."""
    return df.withColumn("__n", F.row_number().over(W.partitionBy(*keys).orderBy(order))).where("__n = 1").drop("__n")


def replaced(df: DataFrame, corrections: DataFrame, key: str) -> DataFrame:
    """Rows whose key is corrected are exchanged for the corrections."""
    return df.join(corrections.select(key).distinct(), key, "left_anti").unionByName(corrections)


def todo(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not done yet."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def stratified(df: DataFrame, key: str, group: str, target: int, seed: int = 0) -> DataFrame:
    """Up to ``target`` rows of each group, in the order of a hash of their key."""
    order = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    return df.withColumn("__n", F.row_number().over(W.partitionBy(group).orderBy(order, key))).where(F.col("__n") <= target).drop("__n")


def sampled_keys(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """All rows of ``n`` keys, chosen by hash."""
    order = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    return df.join(df.select(key).distinct().orderBy(order, key).limit(n), key, "left_semi")
