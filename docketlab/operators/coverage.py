"""Which rows count and how many have what: officers of incidents, employment rows, features, texts, mismatches."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

#: Values that stand for no feature.
NOTHING = ("", "None", "[]")
EMPLOYMENT = ("first_name", "middle_name", "last_name", "suffix", "agency_name", "start_date", "end_date", "person_nbr")
KINDS = ("dates", "case_ids", "names")


def has_value(c) -> Column:
    return ~F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")).isin(*NOTHING)


def incident_officers(incidents: DataFrame) -> DataFrame:
    """One row for each officer of each incident (``intake_case_name, INCIDENT_DATE_STR, extracted_officers.deduped``).

    Incidents without officers or date have none; so have dates with "None" in them and names "not provided".
    """
    each = incidents.select(F.col("intake_case_name").alias("case_name"), F.col("INCIDENT_DATE_STR").alias("incident_date"), F.explode("extracted_officers.deduped").alias("o"))
    rows = each.select("case_name", "incident_date", "o.name", "o.rank", "o.agency", "o.role")
    provided = ~F.contains(F.lower(F.coalesce("name", F.lit(""))), F.lit("not provided"))
    return rows.where(~F.contains("incident_date", F.lit("None")) & provided)


def summaries_by_name(files: DataFrame, case: str, name: str, summary: str) -> DataFrame:
    """``case, summaries``: each case's (name, summary) by name; blank summaries are left out, of one name the last summary stays."""
    kept = files.where(F.trim(F.coalesce(summary, F.lit(""))) != "").withColumn(name, F.coalesce(name, F.lit("unknown")))
    one = kept.groupBy(case, name).agg(F.max(summary).alias(summary))
    return one.groupBy(case).agg(F.array_sort(F.collect_list(F.struct(F.col(name).alias("name"), F.col(summary).alias("summary")))).alias("summaries"))


def employment_rows(rows: DataFrame) -> DataFrame:
    """The columns of employment, names and agency in lower case, nulls as empty texts."""
    low = [F.lower(c).alias(c) for c in EMPLOYMENT[:5]]
    return rows.select(*low, *EMPLOYMENT[5:]).fillna("", [c for c, kind in rows.dtypes if c in EMPLOYMENT and kind == "string"])


def ever_worked_at(rows: DataFrame, agencies, person: str = "person_nbr", agency: str = "agency_name") -> DataFrame:
    """All rows of the persons of whom any row's agency has one of the given names in it."""
    listed = F.lower(F.coalesce(agency, F.lit(""))).rlike("|".join(re.escape(x.lower()) for x in agencies))
    return rows.join(rows.where(listed).select(person).distinct(), person, "left_semi").select(*rows.columns)


def with_text(rows: DataFrame, text: str, present: bool = True) -> DataFrame:
    """Rows that have, or lack, a text."""
    blank = F.coalesce(text, F.lit("")) == ""
    return rows.where(~blank if present else blank)


def features_of(kind: str, mode: str) -> Column:
    """A row's features out of its path, its name, or both, as a set; null if there are none."""
    of = {"filepath_only": ("fp",), "filename_only": ("fn",), "combined": ("fp", "fn")}[mode]
    found = F.array_distinct(F.concat(*[F.coalesce(f"extracted_{kind}_{x}", F.array().cast("array<string>")) for x in of]))
    return F.when(F.size(found) > 0, found)


def feature_coverage(rows: DataFrame) -> DataFrame:
    """One row: how many documents have each kind of feature in their path, in their name, in either, and any or none at all."""
    each = {f"{k}_{x}": has_value(f"extracted_{k}_{x}") for k in KINDS for x in ("fp", "fn")}
    each |= {f"{k}_any": each[f"{k}_fp"] | each[f"{k}_fn"] for k in KINDS}
    some = each["dates_any"] | each["case_ids_any"] | each["names_any"]
    counts = [F.count_if(v).alias(f"documents_with_{k}") for k, v in each.items()]
    return rows.agg(F.count("*").alias("total_documents"), *counts, F.count_if(some).alias("documents_with_any_feature"), F.count_if(~some).alias("documents_with_no_features"))


def text_counts(rows: DataFrame, agency: str, text: str) -> DataFrame:
    """``agency, n_rows, n_text``: rows and rows with a text by agency, and in all as "TOTAL"."""
    sets = rows.groupingSets([[], [agency]], agency).agg(F.count("*").alias("n_rows"), F.count_if(F.coalesce(text, F.lit("")) != "").alias("n_text"), F.grouping_id().alias("all"))
    return sets.select(F.when(F.col("all") == 1, "TOTAL").otherwise(F.col(agency)).alias("agency"), "n_rows", "n_text")


def mismatches(rows: DataFrame, kind: str = "class") -> DataFrame:
    """The rows that are false positives or false negatives."""
    return rows.where(F.col(kind).isin("FP", "FN"))
