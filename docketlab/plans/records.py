"""Queries over what is written and read back, and over keys and short texts, each with equivalent SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import coverage, metrics
from ..sources import tables
from .catalogue import query, r6, t
from .scratch import shared_root


def place(spark, name: str) -> str:
    """A new path in the folder that the cluster shares."""
    return f"{shared_root(spark)}/{uuid.uuid4().hex[:12]}-{name}"


_PARTIES = "SELECT {0}_{1} AS id, {0}_name AS name, {0}_nationkey AS nation, {0}_acctbal AS balance FROM {2}"


def _parties(spark, d, table: str):
    c = table[0]
    return t(spark, d, table).select(F.col(f"{c}_{table[:4]}key").alias("id"), F.col(f"{c}_name").alias("name"), F.col(f"{c}_nationkey").alias("nation"), F.col(f"{c}_acctbal").alias("balance"))


@query(f"{_PARTIES.format('c', 'custkey', 'customer')} UNION ALL {_PARTIES.format('s', 'suppkey', 'supplier')}")
def records_written_and_appended(spark, d):
    """Customers as a stream of records, to which suppliers are appended, read back."""
    path, rows = place(spark, "records.jsonl"), _parties(spark, d, "customer")
    tables.write_records(rows, path)
    tables.write_records(_parties(spark, d, "supplier"), path, append=True)
    return tables.read_table(spark, path, rows.schema)


@query("SELECT count(*) AS n FROM documents")
def records_counted(spark, d):
    """Whole documents, with their line breaks, quotes and non-ASCII letters, as records; how many were written."""
    return tables.write_records(t(spark, d, "documents"), place(spark, "documents.jsonl"))


@query("SELECT doc_id, md5(text) AS body, lang FROM documents WHERE text IS NOT NULL AND text <> ''")
def records_keep_texts(spark, d):
    path, rows = place(spark, "documents.jsonl"), t(spark, d, "documents").select("doc_id", "text", "lang")
    tables.write_records(rows, path)
    return tables.read_records(spark, path, rows.schema, strict=True).where("text <> ''").select("doc_id", F.md5("text").alias("body"), "lang")


@query(_PARTIES.format("c", "custkey", "customer"))
def export_round_trip(spark, d):
    path, rows = place(spark, "customers.csv"), _parties(spark, d, "customer")
    tables.write_csv(rows, path)
    return tables.read_table(spark, path, rows.schema)


@query("SELECT o_orderstatus AS bucket, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 1")
def bucketed_results(spark, d):
    path = place(spark, "buckets")
    tables.write_buckets(t(spark, d, "orders").select("o_orderkey", "o_orderstatus"), path, F.col("o_orderstatus"))
    back = spark.read.schema("o_orderkey long, bucket string").json(path)
    return back.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("o_orderkey").cast("long").alias("keys"))


@query("""
SELECT p_partkey, sha1(lower(p_name || p_brand)) AS uid, sha256(trim(p_name) || '|' || trim(p_brand)) AS mention, trim(replace(lower(replace(p_type, ' ', '_')), '_', ' ')) AS agency,
       CASE WHEN length(p_name) > 12 THEN substr(p_name, 1, 12) || '...' ELSE p_name END AS short, p_brand || '/' || p_name AS path,
       regexp_extract('https://drive.example.com/file/d/' || p_brand || '/view', '/d/([A-Za-z0-9_-]+)', 1) AS drive, '.' || lower(p_type) AS suffix
FROM part
""")
def keys_and_short_texts(spark, d):
    p = t(spark, d, "part")
    return p.select(
        "p_partkey", T.legacy_uid("p_name", "p_brand").alias("uid"), T.mention_uid("p_name", "p_brand").alias("mention"), T.agency_key(F.replace("p_type", F.lit(" "), F.lit("_"))).alias("agency"),
        T.truncated("p_name", 12).alias("short"), T.full_path("p_brand", "p_name").alias("path"),
        T.drive_id(F.concat(F.lit("https://drive.example.com/file/d/"), "p_brand", F.lit("/view"))).alias("drive"), T.extension(F.concat("p_name", F.lit("."), "p_type")).alias("suffix"),
    )


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'FALSE' ELSE 'UNCLEAR' END AS status, CASE WHEN o_orderkey % 3 = 0 THEN 'TRUE' WHEN o_orderkey % 3 = 1 THEN 'FALSE' ELSE 'UNCLEAR' END AS flag,
       o_orderpriority AS kept
FROM orders
""")
def tristate_values(spark, d):
    flag = F.element_at(F.array(F.lit(" yes "), F.lit("n"), F.lit("maybe")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    listed = F.concat(F.lit("Unnamed officer, "), "o_orderpriority", F.lit(" , , unnamed"))
    return t(spark, d, "orders").select("o_orderkey", T.tristate("o_orderstatus").alias("status"), T.tristate(flag).alias("flag"), T.without_unnamed(listed).alias("kept"))


@query("""
WITH s AS (SELECT CAST(l_linenumber AS VARCHAR) AS method, avg(l_discount) FILTER (l_returnflag = 'A') AS a, avg(l_discount) FILTER (l_returnflag = 'N') AS n, avg(l_discount) FILTER (l_returnflag = 'R') AS r,
                  avg(l_discount) AS mean FROM lineitem GROUP BY 1)
SELECT method, round(a, 6) AS a, round(n, 6) AS n, round(r, 6) AS r, round(mean, 6) AS mean_f1 FROM s
""")
def ranked_methods(spark, d):
    scores = t(spark, d, "lineitem").select(F.col("l_linenumber").cast("string").alias("method"), F.col("l_returnflag").alias("category"), F.col("l_discount").cast("double").alias("f1"))
    return metrics.ranked_methods(scores).select("method", r6("A").alias("a"), r6("N").alias("n"), r6("R").alias("r"), r6("mean_f1").alias("mean_f1"))


@query("""
SELECT coalesce(lang, 'TOTAL') AS agency, n_rows, n_text FROM
  (SELECT lang, count(*) AS n_rows, CAST(count(*) FILTER (coalesce(text, '') <> '') AS BIGINT) AS n_text, grouping(lang) AS g FROM documents GROUP BY GROUPING SETS ((lang), ()))
""")
def texts_by_agency(spark, d):
    return coverage.text_counts(t(spark, d, "documents"), "lang", "text")


@query("""
WITH x AS (SELECT regexp_extract(text, '[0-9]{4}-[0-9]{2}-[0-9]{2}', 0) AS dp, '' AS dn, regexp_extract(text, 'password=[0-9a-f]+', 0) AS cp, CASE WHEN doc_id % 2 = 0 THEN '[]' ELSE lang END AS cn,
                  regexp_extract(text, '[a-z]+@[a-z.]+', 0) AS np, 'None' AS nn FROM documents)
SELECT count(*) AS total_documents, count(*) FILTER (dp <> '') AS documents_with_dates_fp, CAST(0 AS BIGINT) AS documents_with_dates_fn, count(*) FILTER (dp <> '') AS documents_with_dates_any,
       count(*) FILTER (cp <> '') AS documents_with_case_ids_fp, count(*) FILTER (cn <> '[]') AS documents_with_case_ids_fn, count(*) FILTER (cp <> '' OR cn <> '[]') AS documents_with_case_ids_any,
       count(*) FILTER (np <> '') AS documents_with_names_fp, CAST(0 AS BIGINT) AS documents_with_names_fn, count(*) FILTER (np <> '') AS documents_with_names_any,
       count(*) FILTER (dp <> '' OR cp <> '' OR cn <> '[]' OR np <> '') AS documents_with_any_feature, count(*) FILTER (NOT (dp <> '' OR cp <> '' OR cn <> '[]' OR np <> '')) AS documents_with_no_features
FROM x
""")
def feature_coverage(spark, d):
    found = lambda pattern: F.regexp_extract("text", pattern, 0)
    return coverage.feature_coverage(t(spark, d, "documents").select(
        found(r"[0-9]{4}-[0-9]{2}-[0-9]{2}").alias("extracted_dates_fp"), F.lit("").alias("extracted_dates_fn"), found("password=[0-9a-f]+").alias("extracted_case_ids_fp"),
        F.when(F.col("doc_id") % 2 == 0, "[]").otherwise(F.col("lang")).alias("extracted_case_ids_fn"), found(r"[a-z]+@[a-z.]+").alias("extracted_names_fp"), F.lit("None").alias("extracted_names_fn"),
    ))


@query("""
SELECT o_orderkey, o_custkey AS person_nbr, lower(o_orderpriority) AS agency_name FROM orders
WHERE o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority ILIKE '%urgent%' OR o_orderpriority ILIKE '%not spec%')
""")
def ever_worked_at(spark, d):
    rows = t(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("person_nbr"), F.lower("o_orderpriority").alias("agency_name"))
    return coverage.ever_worked_at(rows, ["Urgent", "Not Spec"])


@query("""
SELECT c_custkey, CAST(n AS BIGINT) AS n, names FROM (SELECT o_custkey AS c_custkey, count(*) AS n, string_agg(o_orderkey || ':' || o_orderpriority, ';' ORDER BY CAST(o_orderkey AS VARCHAR)) AS names
  FROM orders WHERE o_orderstatus <> 'O' GROUP BY 1)
""")
def summaries_by_name(spark, d):
    o = t(spark, d, "orders").select("o_custkey", F.col("o_orderkey").cast("string").alias("file"), F.when(F.col("o_orderstatus") == "O", "  ").otherwise(F.col("o_orderpriority")).alias("summary"))
    found = coverage.summaries_by_name(o, "o_custkey", "file", "summary")
    each = F.transform("summaries", lambda x: F.concat(x["name"], F.lit(":"), x["summary"]))
    return found.select(F.col("o_custkey").alias("c_custkey"), F.size("summaries").cast("long").alias("n"), F.array_join(each, ";").alias("names"))


@query("""
SELECT c_name AS case_name, CAST(o_orderdate AS DATE)::VARCHAR AS incident_date, o_orderpriority AS name, o_orderstatus AS rank
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 5 <> 0 AND o_orderpriority NOT ILIKE '%not specified%'
""")
def incident_officers(spark, d):
    """Orders as officers of their customer's incident of the day; every fifth has no date, and some names are not provided."""
    o = t(spark, d, "orders").join(t(spark, d, "customer").withColumnRenamed("c_custkey", "o_custkey"), "o_custkey")
    name = F.regexp_replace("o_orderpriority", "(?i)not specified", "Not Provided")
    officer = F.struct(name.alias("name"), F.col("o_orderstatus").alias("rank"), F.lit("").alias("agency"), F.lit("").alias("role"))
    date = F.when(F.col("o_orderkey") % 5 == 0, "None").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    made = o.select(F.col("c_name").alias("intake_case_name"), date.alias("INCIDENT_DATE_STR"), F.struct(F.array(officer).alias("deduped")).alias("extracted_officers"))
    return coverage.incident_officers(made).select("case_name", "incident_date", "name", "rank")
