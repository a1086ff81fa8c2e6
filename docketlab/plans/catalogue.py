"""Queries that apply the library's operators to the given tables, each with equivalent SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..functions import dates as D, extract as X, lists as L, similarity as M, text as T
from ..operators import cases, clustering, graph, learning, legacy, linkage, metrics, pii, segmentation
from ..streaming import pages as streams
from . import completions
from .scratch import written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def r6(c) -> Column:
    return F.round(c, 6)


# --- sensitive pages ---------------------------------------------------------------------------------------------

_B, _E = r"(?:^|[^\pL\pN_])", r"(?:$|[^\pL\pN_])"
_SHAPES = ", ".join(
    f"('{_B}({sep.join(f'[0-9]{{{n}}}' for n in groups)}){_E}')" for groups in pii.CARD_GROUPS for sep in (r"\s", "-", r"\.")
) + ", " + ", ".join(f"('{_B}([0-9]{{{n}}}){_E}')" for n in pii.CARD_LENGTHS)
_BRAND_SQL = "CASE " + " ".join(f"WHEN length(num) = {n} AND regexp_matches(num, '^(?:{p})') THEN '{b}'" for b, p, n in pii.BRANDS) + " END"
_CARD_SQL = rf"""
WITH shapes(p) AS (VALUES {_SHAPES}),
c AS (SELECT doc_id, regexp_replace(unnest(regexp_extract_all(text, p, 1)), '[\s.\-]', '', 'g') AS num FROM documents, shapes),
b AS (SELECT DISTINCT doc_id, num, {_BRAND_SQL} AS brand FROM c),
v AS (SELECT *, list_sum(list_transform(generate_series(1, length(num)), lambda i:
        CASE WHEN (length(num) - i) % 2 = 1 THEN (2 * CAST(num[i] AS INT)) // 10 + (2 * CAST(num[i] AS INT)) % 10 ELSE CAST(num[i] AS INT) END)) AS s FROM b WHERE brand IS NOT NULL)
SELECT doc_id, num AS number, brand FROM v WHERE s % 10 = 0"""


@query(_CARD_SQL)
def pii_card_pages(spark, d):
    rows = t(spark, d, "documents").where(F.col("text").rlike(r"\d{4}"))
    return rows.select("doc_id", F.explode(F.array_distinct(pii.cards("text"))).alias("c")).select("doc_id", "c.number", "c.brand")


@query(r"SELECT doc_id, CAST(len(regexp_extract_all(text, '[^ \t\n\x0B\f\r]+')) AS BIGINT) AS n_words FROM documents WHERE len(regexp_extract_all(text, '[^ \t\n\x0B\f\r]+')) <= 20")
def pii_low_word_pages(spark, d):
    return pii.image_page_candidates(t(spark, d, "documents"), "text").select("doc_id", T.word_count("text").cast("long").alias("n_words"))


@query(r"""
WITH f AS (SELECT source, doc_id, regexp_matches(text, '[A-Za-z0-9._]+@[A-Za-z0-9]+\.[a-z]+') AS e, regexp_matches(text, '[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}') AS i,
  len(regexp_extract_all(text, '[^ \t\n\x0B\f\r]+')) <= 20 AS l FROM documents),
g AS (SELECT source, doc_id, concat_ws(',', CASE WHEN e THEN 'email' END, CASE WHEN i THEN 'ip' END, CASE WHEN l THEN 'low_words' END) AS reasons FROM f)
SELECT source AS file, string_agg(doc_id, ', ' ORDER BY doc_id) AS pages, CAST(count(*) AS BIGINT) AS n FROM g WHERE reasons <> '' GROUP BY source""")
def pii_reason_rollup(spark, d):
    extra = {"email": F.col("text").rlike(r"[A-Za-z0-9._]+@[A-Za-z0-9]+\.[a-z]+"), "ip": F.col("text").rlike(r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}"), "low_words": T.low_words("text")}
    reasons = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in extra.items()]))
    flagged = t(spark, d, "documents").select(F.col("source").alias("file"), F.col("doc_id").alias("page"), reasons.alias("reasons")).where(F.size("reasons") > 0)
    counted = flagged.groupBy("file").agg(F.count("*").alias("n"))
    return pii.file_report(flagged).join(counted, "file").select("file", "pages", "n")


@query()
def pii_flagged_files(spark, d):
    pages = t(spark, d, "documents")
    return pii.file_report(pii.flagged_pages(pages, "source", "doc_id", "text"))


@query("SELECT source AS file, bool_or(regexp_matches(lower(text), 'rape|incest|prostitution|sodomy')) AS penal FROM documents GROUP BY source")
def penal_style_gate(spark, d):
    return t(spark, d, "documents").groupBy(F.col("source").alias("file")).agg(F.max(F.col("text").rlike("(?i)rape|incest|prostitution|sodomy")).alias("penal"))


@query("""
SELECT o_orderkey, t AS page FROM (SELECT o_orderkey, 'number ' || substr(lpad(CAST(o_orderkey AS VARCHAR), 9, '0'), 1, 3) || '-' || substr(lpad(CAST(o_orderkey AS VARCHAR), 9, '0'), 4, 2) || '-' ||
  CASE WHEN o_orderkey % 3 = 0 THEN 'x' ELSE '' END || substr(lpad(CAST(o_orderkey AS VARCHAR), 9, '0'), 6, 4) AS t FROM orders)
WHERE length(t) >= 15 AND regexp_matches(t, '[0-9]{3}-[0-9]{2}-[0-9]{4}')""")
def ssn_pages(spark, d):
    k = F.lpad(F.col("o_orderkey").cast("string"), 9, "0")
    made = F.concat(F.lit("number "), F.substring(k, 1, 3), F.lit("-"), F.substring(k, 4, 2), F.lit("-"), F.when(F.col("o_orderkey") % 3 == 0, "x").otherwise(""), F.substring(k, 6, 4))
    return t(spark, d, "orders").select("o_orderkey", made.alias("page")).where(pii.has_ssn("page"))


@query()
def birth_date_pages(spark, d):
    # A small file for its work would be read by one task.
    c = t(spark, d, "customer").select("c_custkey").repartition(linkage._tasks(spark.range(0)), "c_custkey")
    label = F.element_at(F.array(*map(F.lit, ("DOB: ", "date of birth ", "born on\n", "Birthday "))), (F.col("c_custkey") % 4 + 1).cast("int"))
    return c.select("c_custkey", pii.has_birth_date(F.concat(label, F.format_string("%02d/%02d/19%02d", F.col("c_custkey") % 12 + 1, F.col("c_custkey") % 28 + 1, F.col("c_custkey") % 90 + 10))).alias("dob"))


# --- case records ------------------------------------------------------------------------------------------------


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS k, CASE WHEN count(o_orderkey) = 0 THEN 'No summary' ELSE coalesce(string_agg(o_orderpriority, ';' ORDER BY o_orderkey), '') END AS summaries, CAST(count(o_orderkey) AS BIGINT) AS n
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""")
def case_assembly(spark, d):
    docs = t(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("k"), "o_orderkey", "o_orderpriority", F.col("o_orderstatus"))
    found = cases.case_records(t(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("k")), docs, "k", "o_orderkey", "o_orderpriority", "o_orderstatus")
    return found.select("k", F.array_join("summaries", ";").alias("summaries"), F.size("ocr_texts").cast("long").alias("n"))


@query("""
WITH p AS (SELECT conv_id, max(turn) AS last FROM conversations GROUP BY conv_id)
SELECT conv_id, string_agg(text, '|' ORDER BY turn) AS pages FROM conversations JOIN p USING (conv_id)
WHERE (CASE WHEN last >= 3 THEN turn BETWEEN 2 AND 3 ELSE true END) GROUP BY conv_id""")
def page_range_assembly(spark, d):
    rows = t(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(F.col("turn").alias("page"), "text"))).alias("pages"))
    text = cases.page_range_text(F.col("pages"), F.lit(2), F.when(F.array_max(F.col("pages.page")) >= 3, F.lit(3)))
    return rows.select("conv_id", F.replace(text, F.lit(cases.PAGE_BREAK), F.lit("|")).alias("pages"))


@query("""
SELECT p_partkey, lower(regexp_replace(p_name, '\\s+', '', 'g')) AS k, regexp_replace(regexp_replace(upper('IA' || lpad(CAST(p_partkey AS VARCHAR), 6, '0')), '[^A-Z0-9]', '', 'g'), '([A-Z])0+([0-9])', '\\1\\2') AS id FROM part""".replace("\\\\", "\\"))
def key_normalise(spark, d):
    return t(spark, d, "part").select("p_partkey", T.case_key("p_name").alias("k"), T.case_id(F.concat(F.lit("ia-"), F.lpad(F.col("p_partkey").cast("string"), 6, "0"))).alias("id"))


_DATE_SHAPES = ("yyyy-MM-dd", "yyyy/M/d", "MM/dd/yyyy", "M-d-yyyy", "yyyyMMdd", "MMMM d, yyyy", "MMM d, yyyy")


@query("SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS day FROM orders")
def date_parse_matrix(spark, d):
    shaped = F.element_at(F.array(*[F.date_format("o_orderdate", f) for f in _DATE_SHAPES]), (F.col("o_orderkey") % len(_DATE_SHAPES) + 1).cast("int"))
    return t(spark, d, "orders").select("o_orderkey", F.date_format(D.parse_date(shaped), "yyyy-MM-dd").alias("day"))


@query("""
WITH f AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS b FROM orders GROUP BY o_custkey)
SELECT o_custkey, CAST(abs(date_diff('day', a, b)) AS INT) AS gap, abs(date_diff('day', a, b)) <= 365 AS near FROM f""")
def date_gap_pairs(spark, d):
    day = lambda c: F.array(F.date_format(c, "yyyy-MM-dd"))
    rows = t(spark, d, "orders").groupBy("o_custkey").agg(day(F.min("o_orderdate")).alias("a"), day(F.max("o_orderdate")).alias("b"))
    return rows.select("o_custkey", D.least_gap("a", "b").alias("gap"), D.within_days("a", "b").alias("near"))


@query("SELECT o_custkey, CAST(max(year(o_orderdate)) AS INT) AS latest FROM orders GROUP BY o_custkey")
def incident_year(spark, d):
    rows = t(spark, d, "orders").groupBy("o_custkey").agg(F.concat_ws(", ", F.collect_list(F.date_format("o_orderdate", "MM/dd/yyyy"))).alias("days"))
    return rows.select("o_custkey", D.latest_year("days").alias("latest"))


@query(r"SELECT page_id, coalesce(string_agg(x, ',' ORDER BY x), '') AS ids FROM (SELECT page_id, unnest(list_distinct(regexp_extract_all('OIS' || CAST(page_id + 1000 AS VARCHAR) || ' Case#' || CAST(page_id AS VARCHAR) || 'A-7 ' || url, '(?i)(OIS[0-9]{4,}|Case#[A-Za-z0-9-]+)'))) AS y, regexp_replace(y, '(?i)^Case#', '') AS x FROM pages) WHERE NOT regexp_matches(x, '^OIS(19|20)[0-9]{2}$') GROUP BY page_id")
def regex_ids(spark, d):
    found = X.metadata_ids(F.concat(F.lit("OIS"), (F.col("page_id") + 1000).cast("string"), F.lit(" Case#"), F.col("page_id").cast("string"), F.lit("A-7 ")))
    return t(spark, d, "pages").select("page_id", F.array_join(F.array_sort(found), ",").alias("ids"))


@query("""
WITH p AS (SELECT page_id, split_part(split_part(url, '?', 1), '#', 1) AS u FROM pages),
q AS (SELECT page_id, list_filter(string_split(u, '/'), lambda x: x <> '') AS parts FROM p)
SELECT page_id, CAST(len(parts) - 1 AS INT) AS depth, array_to_string(parts[1 : greatest(len(parts) - 2, 0)], '/') AS up FROM q""")
def url_dir_depth(spark, d):
    u = F.substring_index(F.substring_index("url", "?", 1), "#", 1)
    return t(spark, d, "pages").select("page_id", T.shared_depth(u, u).alias("depth"), T.directory_at(u, 1).alias("up"))


# --- measures ----------------------------------------------------------------------------------------------------

_PRF = "round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1"
_COUNTS = "count_if(p AND g) AS tp, count_if(p AND NOT g) AS fp, count_if(NOT p AND g) AS fn, count_if(NOT p AND NOT g) AS tn"
_LABELLED = "SELECT lang, source, n_chars > 1000 AS p, quality = 1 AS g FROM documents JOIN labels USING (doc_id)"
_FOUR = "CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn"


def _labelled(spark, d) -> DataFrame:
    return t(spark, d, "documents").drop("text").join(t(spark, d, "labels"), "doc_id").withColumns({"p": F.col("n_chars") > 1000, "g": F.col("quality") == 1})


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[r6(c).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


@query(f"WITH x AS ({_LABELLED}), c AS (SELECT {_COUNTS} FROM x) SELECT {_FOUR}, {_PRF}, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy FROM c")
def prf_binary(spark, d):
    return _rounded(metrics.binary_prf(_labelled(spark, d), F.col("p"), F.col("g")))


@query(f"""WITH x AS ({_LABELLED}), c AS (SELECT CASE WHEN grouping(lang) = 1 THEN 'overall' ELSE 'group' END AS scope, lang AS grp, {_COUNTS} FROM x GROUP BY GROUPING SETS ((), (lang)))
SELECT scope, grp, {_FOUR}, {_PRF}, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy FROM c""")
def grouped_prf(spark, d):
    return _rounded(metrics.grouped_prf(_labelled(spark, d), F.col("p"), F.col("g"), "lang"))


@query("SELECT quality AS gold, toxic AS pred, CAST(count(*) AS BIGINT) AS n FROM labels GROUP BY 1, 2")
def confusion(spark, d):
    return metrics.confusion(t(spark, d, "labels"), "quality", "toxic")


@query(f"""WITH a AS (SELECT min(doc_id) || '|' || max(doc_id) AS k FROM documents GROUP BY text HAVING count(*) > 1), b AS (SELECT min(doc_id) || '|' || max(doc_id) AS k FROM documents GROUP BY substr(text, 1, 200) HAVING count(*) > 1),
c AS (SELECT (SELECT count(*) FROM a JOIN b USING (k)) AS tp, (SELECT count(*) FROM b ANTI JOIN a USING (k)) AS fp, (SELECT count(*) FROM a ANTI JOIN b USING (k)) AS fn)
SELECT tp, fp, fn, {_PRF} FROM c""")
def prf_set(spark, d):
    docs = t(spark, d, "documents")
    key = lambda g: docs.groupBy(g.alias("g")).agg(F.count("*").alias("n"), F.concat_ws("|", F.min("doc_id"), F.max("doc_id")).alias("k")).where("n > 1")
    return _rounded(metrics.set_prf(key(F.substring("text", 1, 200)), key(F.col("text")), "k"))


@query(f"""WITH x AS (SELECT unnest(['quality', 'toxic']) AS field, unnest([n_chars > 1000, n_chars < 300]) AS p, unnest([quality = 1, toxic = 1]) AS g FROM documents JOIN labels USING (doc_id)),
c AS (SELECT coalesce(field, 'micro') AS field, {_COUNTS} FROM x GROUP BY GROUPING SETS ((), (field))) SELECT field, {_FOUR}, {_PRF}, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy FROM c""")
def tristate_micro(spark, d):
    rows = _labelled(spark, d)
    s = lambda c: F.when(c, "TRUE").otherwise("FALSE")
    return _rounded(metrics.field_metrics(rows, {"quality": (s(F.col("n_chars") > 1000), s(F.col("quality") == 1)), "toxic": (s(F.col("n_chars") < 300), s(F.col("toxic") == 1))}))


@query("""
WITH w AS (SELECT doc_id, unnest(list_distinct(string_split(text, ' '))) AS value FROM documents)
SELECT value, CAST(count(*) AS BIGINT) AS df FROM w GROUP BY value HAVING count(*) >= floor((SELECT count(*) FROM documents) * 0.1)""")
def doc_frequency_filter(spark, d):
    return metrics.frequent_values(t(spark, d, "documents"), "doc_id", F.split("text", " ", -1))


@query("SELECT p_name AS mention_uid, CAST(count(DISTINCT p_brand) AS BIGINT) AS persons FROM part GROUP BY p_name HAVING count(DISTINCT p_brand) >= 2")
def ambiguity(spark, d):
    return linkage.ambiguous_mentions(t(spark, d, "part").select(F.col("p_name").alias("mention_uid"), F.col("p_brand").alias("post_person_nbr")))


@query("""
WITH r AS (SELECT l_orderkey, l_linenumber, l_extendedprice, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS rank FROM lineitem)
SELECT k.l_orderkey, CAST(k.rank AS INT) AS rank, r.l_linenumber, r.l_extendedprice FROM (SELECT DISTINCT l_orderkey, unnest([1, 2, 3]) AS rank FROM lineitem) k LEFT JOIN r ON r.l_orderkey = k.l_orderkey AND r.rank = k.rank""")
def best_match_topk(spark, d):
    return linkage.top_candidates(t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice"), "l_orderkey", "l_extendedprice", "l_linenumber")


@query("SELECT conv_id, turn, role FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations) WHERE n <= 3")
def first_n_pages(spark, d):
    return cases.first_rows(t(spark, d, "conversations").select("conv_id", "turn", "role"), "conv_id", "turn", 3)


@query("SELECT min(doc_id) AS doc_id FROM documents GROUP BY text")
def keep_first_dedup(spark, d):
    return cases.keep_first(t(spark, d, "documents"), ["text"], "doc_id").select("doc_id")


@query("SELECT l_partkey, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey * 10 + l_linenumber) AS n FROM lineitem) WHERE n <= 3")
def citations_top3(spark, d):
    rows = t(spark, d, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("o"))
    return cases.first_rows(rows, "l_partkey", "o", 3).drop("o")


# --- joins and linkage -------------------------------------------------------------------------------------------


@query("""
WITH m AS (SELECT p_partkey AS a, upper(split_part(p_name, ' ', 1)) AS f, upper(split_part(p_name, ' ', 2)) AS l FROM part WHERE p_partkey % 7 = 0), r AS (SELECT p_partkey AS b, upper(split_part(p_name, ' ', 1)) AS f, upper(split_part(p_name, ' ', 2)) AS l FROM part WHERE p_partkey % 7 = 1)
SELECT a, b FROM m, r WHERE (substr(m.f, 1, 2) = substr(r.f, 1, 2) AND m.l = r.l) OR (m.f = r.f AND substr(m.l, 1, 2) = substr(r.l, 1, 2))""")
def name_net_join(spark, d):
    first, last = F.split("p_name", " ")[0], F.coalesce(F.try_element_at(F.split("p_name", " "), F.lit(2)), F.lit(""))
    m = t(spark, d, "part").where("p_partkey % 7 = 0").select(F.col("p_partkey").alias("a"), first.alias("mention_first_name"), last.alias("mention_last_name"))
    r = t(spark, d, "part").where("p_partkey % 7 = 1").select(F.col("p_partkey").alias("b"), first.alias("post_first_name"), last.alias("post_last_name"))
    return linkage.name_net(m, r).select("a", "b")


@query("""
WITH n AS (SELECT p_partkey AS k, upper(split_part(p_name, ' ', 1)) AS f, upper(split_part(p_name, ' ', 2)) AS l FROM part)
SELECT m.k AS a, r.k AS b FROM n m JOIN n r ON m.l = r.l AND substr(m.f, 1, 2) = substr(r.f, 1, 2) WHERE m.k <> r.k
UNION SELECT m.k, r.k FROM n m JOIN n r ON m.f = r.f AND substr(m.l, 1, 2) = substr(r.l, 1, 2) WHERE m.k <> r.k""")
def name_net_join_whole(spark, d):
    """All parts against all others; the SQL of :func:`name_net_join` has a seventh of them on each side."""
    first, last = F.split("p_name", " ")[0], F.coalesce(F.try_element_at(F.split("p_name", " "), F.lit(2)), F.lit(""))
    p = t(spark, d, "part")
    m = p.select(F.col("p_partkey").alias("a"), first.alias("mention_first_name"), last.alias("mention_last_name"))
    r = p.select(F.col("p_partkey").alias("b"), first.alias("post_first_name"), last.alias("post_last_name"))
    return linkage.name_net(m, r).where("a <> b").select("a", "b")


@query("""
WITH s AS (SELECT l_suppkey, min(CAST(l_shipdate AS DATE)) AS a, max(CAST(l_shipdate AS DATE)) AS b FROM lineitem GROUP BY l_suppkey)
SELECT o_orderkey, l_suppkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN s USING (l_suppkey) WHERE year(a) <= year(o_orderdate) + 1 AND year(b) >= year(o_orderdate) - 1 AND CAST(o_orderdate AS DATE) BETWEEN a AND b GROUP BY 1, 2""")
def range_stint_join(spark, d):
    """Stints meet the lines before these meet their orders, so what is left is distinct where it is. Both joins are
    dealt to as many tasks as the lines need, as a task would get more of them the larger the table is."""
    lines = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey", F.to_date("l_shipdate").alias("shipped"))
    tasks = linkage._tasks(lines, lines.count())
    spans = lines.groupBy("l_suppkey").agg(F.min("shipped").alias("a"), F.max("shipped").alias("b")).repartition(tasks, "l_suppkey")
    held = lines.drop("shipped").repartition(tasks, "l_suppkey").join(spans, "l_suppkey").repartition(tasks, "o_orderkey")
    orders = t(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"), F.year("o_orderdate").alias("y")).repartition(tasks, "o_orderkey")
    rows = orders.join(held, "o_orderkey")
    return rows.where(linkage.in_years(F.col("a"), F.col("b"), "y", F.lit("2000-01-01").cast("date")) & linkage.overlaps_day("day", "a", "b")).select("o_orderkey", "l_suppkey").distinct()


@query("""
WITH c AS (SELECT l_orderkey, l_suppkey, s_nationkey, n_regionkey FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey)
SELECT l_orderkey AS mention_uid, CAST(count(*) AS BIGINT) AS n FROM c WHERE (l_orderkey, l_suppkey) IN (SELECT l_orderkey, l_suppkey FROM c WHERE n_regionkey = 1) GROUP BY l_orderkey""")
def county_semi(spark, d):
    rows = t(spark, d, "lineitem").join(t(spark, d, "supplier").join(t(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")), F.col("l_suppkey") == F.col("s_suppkey"))
    rows = rows.select(F.col("l_orderkey").alias("mention_uid"), F.col("l_suppkey").alias("post_person_nbr"), F.col("n_regionkey").cast("string").alias("county"), F.lit("1").alias("mention_county"), F.lit("POLICE").alias("mention_agency_type"))
    return linkage.county_kept(rows).groupBy("mention_uid").agg(F.count("*").alias("n"))


@query("""
SELECT p_partkey, concat_ws('|', 'i_first_pre_' || lower(substr(a, 1, 1)), CASE WHEN length(a) >= 2 THEN 'i_first_suf_' || lower(right(a, 2)) END, 'i_last_pre_' || lower(substr(b, 1, 1)), CASE WHEN length(b) >= 2 THEN 'i_last_suf_' || lower(right(b, 2)) END,
 'p_first_pre_' || lower(substr(b, 1, 1)), CASE WHEN length(b) >= 2 THEN 'p_first_suf_' || lower(right(b, 2)) END, 'p_last_pre_' || lower(substr(a, 1, 1)), CASE WHEN length(a) >= 2 THEN 'p_last_suf_' || lower(right(a, 2)) END) AS keys
FROM (SELECT p_partkey, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b FROM part) WHERE a <> '' AND b <> ''""")
def blocking_keys(spark, d):
    a, b = F.split("p_name", " ")[0], F.coalesce(F.try_element_at(F.split("p_name", " "), F.lit(2)), F.lit(""))
    none = F.lit(None).cast("string")
    rows = t(spark, d, "part").select("p_partkey", a.alias("incident_first_name"), b.alias("incident_last_name"), b.alias("post_first_name"), a.alias("post_last_name"), *[none.alias(f"{s}_{p}") for s in ("incident", "post") for p in ("middle_name", "suffix", "name")], *[F.lit(None).cast("date").alias(c) for c in ("incident_date", "post_start_date", "post_end_date")])
    return rows.where((F.col("incident_first_name") != "") & (F.col("incident_last_name") != "")).select("p_partkey", linkage.blocking_keys(rows).alias("keys"))


@query("SELECT o_orderkey FROM orders ANTI JOIN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_quantity > 40) l ON l_orderkey = o_orderkey")
def anti_resume(spark, d):
    done = t(spark, d, "lineitem").where("l_quantity > 40").select(F.col("l_orderkey").alias("o_orderkey"))
    return cases.todo(t(spark, d, "orders").select("o_orderkey"), done, "o_orderkey")


_MENTIONS = """m AS (SELECT p_partkey AS u, split_part(p_name, ' ', 1) AS f, split_part(p_name, ' ', 2) AS l, p_brand AS st, p_type AS ag FROM part WHERE p_partkey % 5 = 0),
r AS (SELECT p_partkey AS p, split_part(p_name, ' ', 1) AS f, split_part(p_name, ' ', 2) AS l, p_brand AS st, p_type AS ag FROM part WHERE p_partkey % 5 <> 0)"""


def _mentions(spark, d) -> tuple[DataFrame, DataFrame]:
    first, last = F.split("p_name", " ")[0], F.coalesce(F.try_element_at(F.split("p_name", " "), F.lit(2)), F.lit(""))
    none, p = F.lit(None).cast("string"), t(spark, d, "part")
    m = p.where("p_partkey % 5 = 0").select(F.col("p_partkey").alias("mention_uid"), first.alias("mention_first_name"), none.alias("mention_middle_name"), last.alias("mention_last_name"), none.alias("mention_suffix"), F.col("p_brand").alias("state"), F.lit(1995).alias("incident_year"), F.lit("POLICE").alias("mention_agency_type"), F.col("p_type").alias("mention_agency"), none.alias("mentioned_agencies"))
    r = p.where("p_partkey % 5 <> 0").select(F.col("p_partkey").alias("post_person_nbr"), first.alias("post_first_name"), none.alias("post_middle_name"), last.alias("post_last_name"), none.alias("post_suffix"), F.lit("1990-01-01").cast("date").alias("post_start_date"), F.lit(None).cast("date").alias("post_end_date"), F.lit("POLICE").alias("post_agency_type"), F.col("p_type").alias("post_agency_name"), F.col("p_brand").alias("state"), F.lit(None).cast("string").alias("county"))
    return m, r


@query(f"WITH {_MENTIONS} SELECT u AS mention_uid, CAST(count(DISTINCT p) AS BIGINT) AS same_name FROM m LEFT JOIN r ON upper(m.f) = upper(r.f) AND upper(m.l) = upper(r.l) AND upper(m.st) = upper(r.st) GROUP BY u")
def same_name_persons(spark, d):
    m, r = _mentions(spark, d)
    return linkage.same_name_persons(m, r)


@query(f"""WITH {_MENTIONS}, sn AS (SELECT u, count(DISTINCT p) AS n FROM m LEFT JOIN r ON upper(m.f) = upper(r.f) AND upper(m.l) = upper(r.l) AND upper(m.st) = upper(r.st) GROUP BY u),
c AS (SELECT u, p, m.f = r.f AND m.l = r.l AS exact, m.ag = r.ag AS valid FROM m, r WHERE (substr(upper(m.f), 1, 2) = substr(upper(r.f), 1, 2) AND upper(m.l) = upper(r.l)) OR (upper(m.f) = upper(r.f) AND substr(upper(m.l), 1, 2) = substr(upper(r.l), 1, 2))),
g AS (SELECT u, count(*) AS nc, count_if(exact) AS ne, count(DISTINCT CASE WHEN exact THEN p END) AS np, bool_or(exact AND valid) AS ok FROM c GROUP BY u)
SELECT u AS mention_uid, CASE WHEN sn.n >= 2 THEN 'Several persons of the same name' WHEN coalesce(nc, 0) = 0 THEN 'No candidates found' WHEN ne = 0 THEN 'No exact name above the threshold' WHEN np >= 2 THEN 'Several persons with the exact name' WHEN NOT ok THEN 'Agency cannot be validated' ELSE '' END AS reason
FROM m JOIN sn USING (u) LEFT JOIN g USING (u)""")
def resolve_decision(spark, d):
    m, r = _mentions(spark, d)
    common = spark.createDataFrame([("NOBODY",)], "last_name string")
    return linkage.resolve(m, r, common, F.lit("2000-01-01").cast("date")).select("mention_uid", "reason")


@query("SELECT p_partkey, p_partkey % 2 = 0 AND p_partkey % 3 <> 0 AS a FROM part")
def nonle_guard(spark, d):
    source = F.when(F.col("p_partkey") % 2 == 0, F.lit("County Coroner")).otherwise(F.lit("City Police"))
    registry = F.when(F.col("p_partkey") % 3 == 0, F.lit("City Library")).otherwise(F.lit("County Sheriff"))
    return t(spark, d, "part").select("p_partkey", T.guard_blocks(F.array(source), registry).alias("a"))


# --- match graphs ------------------------------------------------------------------------------------------------

_TOKENS = "k AS (SELECT DISTINCT doc_id, w FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM documents) WHERE length(w) >= 12), rare AS (SELECT w FROM k GROUP BY w HAVING count(*) BETWEEN 2 AND 3)"


def _tokens(spark, d) -> DataFrame:
    return t(spark, d, "documents").select(F.col("doc_id").alias("id"), F.explode(F.array_distinct(F.split("text", " ", -1))).alias("w")).where(F.length("w") >= 12)


def _token_edges(spark, d) -> DataFrame:
    k = _tokens(spark, d)
    rare = k.groupBy("w").agg(F.count("*").alias("n")).where("n BETWEEN 2 AND 3").select("w")
    return graph.star_edges(k.join(rare, "w", "left_semi"), "w")


@query(f"WITH {_TOKENS}, m AS (SELECT w, min(doc_id) AS src FROM k JOIN rare USING (w) GROUP BY w) SELECT DISTINCT src, doc_id AS dst FROM m JOIN k USING (w) WHERE src <> doc_id")
def inverted_id_edges(spark, d):
    return _token_edges(spark, d)


@query("""
WITH e AS (SELECT event_id, CAST(ts AS DATE) AS day, user_id FROM events), m AS (SELECT day, user_id, min(event_id) AS src FROM e GROUP BY 1, 2) SELECT DISTINCT src, event_id AS dst FROM m JOIN e USING (day, user_id) WHERE src <> event_id""")
def date_name_edges(spark, d):
    rows = t(spark, d, "events").select(F.col("event_id").alias("id"), F.concat_ws("|", F.to_date("ts"), "user_id").alias("k"))
    return graph.star_edges(rows, "k")


_FEW = f"{_TOKENS}, mm AS (SELECT w, min(doc_id) AS src FROM k JOIN rare USING (w) GROUP BY w), e AS (SELECT DISTINCT src, doc_id AS dst FROM mm JOIN k USING (w) WHERE src <> doc_id AND src % 5 < 4 AND (src * 7 + doc_id) % 10 < 3), b AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e)"


@query()
def components(spark, d):
    """Documents linked by any word they share, however many share it; SQL that recurses over all edges is too slow."""
    return graph.components(t(spark, d, "documents").select(F.col("doc_id").alias("id")), graph.star_edges(_tokens(spark, d), "w"))


@query(f"WITH RECURSIVE {_FEW.replace('documents', '(SELECT * FROM documents WHERE lang = ' + chr(39) + 'es' + chr(39) + ')')}, v AS (SELECT doc_id AS id FROM documents WHERE lang = 'es'), reach(id, node) AS (SELECT id, id FROM v UNION SELECT reach.id, b.dst FROM reach JOIN b ON b.src = reach.node) SELECT id, min(node) AS component FROM reach GROUP BY id")
def components_of_one_language(spark, d):
    docs = t(spark, d, "documents").where("lang = 'es'")
    k = docs.select(F.col("doc_id").alias("id"), F.explode(F.array_distinct(F.split("text", " ", -1))).alias("w")).where(F.length("w") >= 12)
    rare = k.groupBy("w").agg(F.count("*").alias("n")).where("n BETWEEN 2 AND 3").select("w")
    edges = graph.star_edges(k.join(rare, "w", "left_semi"), "w").where("src % 5 < 4 AND (src * 7 + dst) % 10 < 3")
    return graph.components(docs.select(F.col("doc_id").alias("id")), edges)


def _members(spark, d) -> DataFrame:
    return t(spark, d, "events").select(F.col("event_id").alias("id"), F.concat_ws("|", F.to_date("ts"), "user_id").alias("k")).withColumn("component", F.min("id").over(W.partitionBy("k"))).drop("k")


@query("""
WITH e AS (SELECT event_id, CAST(ts AS DATE) AS day, user_id FROM events), m AS (SELECT *, min(event_id) OVER (PARTITION BY day, user_id) AS component, count(*) OVER (PARTITION BY day, user_id) AS size FROM e),
x AS (SELECT component, size, CASE WHEN event_id = component THEN size - 1 ELSE 1 END / greatest(size - 1, 1) AS share FROM m)
SELECT component, CAST(size AS BIGINT) AS size, round(min(CASE WHEN size = 1 THEN 0 ELSE share END), 6) AS least, size <= 2 OR min(share) >= 0.3 AS valid FROM x GROUP BY component, size""")
def cluster_density(spark, d):
    return _rounded(graph.density(_members(spark, d), date_name_edges(spark, d)))


@query()
def cluster_split(spark, d):
    # Both are read several times: by the density, and by the split of what is loose.
    return graph.split_components(written(_members(spark, d), "members"), written(date_name_edges(spark, d), "edges"))


@query("""
SELECT a.vec_id AS src, b.vec_id AS dst, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS similarity FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id
WHERE list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) >= 0.4""")
def cosine_edges(spark, d):
    return _rounded(clustering.cosine_edges(t(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector")), 0.4))


@query()
def embedding_clusters(spark, d):
    return clustering.threshold_clusters(t(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label"), 0.4, "label")


def _incident_docs(spark, d) -> DataFrame:
    """Orders as documents of cases: their customer, clerk-like priority, day and part names as features."""
    o = t(spark, d, "orders")
    s = lambda c: F.array(c)
    none = F.array().cast("array<string>")
    return o.select(
        F.col("o_orderkey").alias("id"), F.concat_ws("/", F.lit("agency"), F.lit("batch"), F.col("o_orderstatus"), F.expr("o_orderkey div 4").cast("string"), F.concat(F.col("o_orderkey").cast("string"), F.lit(".pdf"))).alias("path"),
        F.when(F.col("o_orderkey") % 3 == 0, s(F.concat(F.lit("IA"), F.col("o_custkey").cast("string")))).otherwise(none).alias("t1_case_ids"), s(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("t1_dates"),
        s(F.concat(F.lit("person "), F.col("o_custkey").cast("string"))).alias("t1_names"), none.alias("t2_case_ids"), s(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("t2_dates"), s(F.concat(F.lit("subject "), F.col("o_custkey").cast("string"))).alias("t2_subjects"), none.alias("t2_officers"),
    )


@query("""
WITH o AS (SELECT o_orderkey AS id, o_orderkey % 3 = 0 AS has, o_custkey AS cid, o_custkey AS cust, CAST(o_orderdate AS DATE) AS day, o_orderstatus || '/' || (o_orderkey // 4) AS dir FROM orders),
p AS (SELECT a.id AS src, b.id AS dst, a.has AND b.has AND a.cid = b.cid AS same, a.has AND b.has AND a.cid <> b.cid AS conflict, a.dir = b.dir AS dir, a.cust = b.cust AND a.day = b.day AS who FROM o a JOIN o b ON a.id < b.id AND ((a.has AND b.has AND a.cid = b.cid) OR a.dir = b.dir OR (a.cust = b.cust AND a.day = b.day))),
q AS (SELECT *, CASE WHEN same THEN 'case_id_only' WHEN dir AND NOT conflict THEN 'exact_dir_match' WHEN who AND NOT conflict THEN 'name_and_date' WHEN who THEN 'subject_name_and_date' END AS match_type FROM p)
SELECT src, dst, CASE WHEN match_type = 'subject_name_and_date' THEN 2 ELSE 1 END AS tier, match_type FROM q WHERE match_type IS NOT NULL""")
def incident_edges(spark, d):
    return clustering.match_edges(_incident_docs(spark, d))


@query()
def incident_clusters(spark, d):
    return clustering.cluster(_incident_docs(spark, d))


@query()
def deterministic_clusters(spark, d):
    return clustering.deterministic_clusters(_incident_docs(spark, d))


# --- cluster measures: events by user and day against events by user and type --------------------------------------


def _partitions(spark, d) -> tuple[DataFrame, DataFrame]:
    e = t(spark, d, "events")
    return e.select(F.col("event_id").alias("id"), F.concat_ws("|", "user_id", F.to_date("ts")).alias("gt")), e.select(F.col("event_id").alias("id"), F.concat_ws("|", "user_id", "event_type").alias("cluster"))


_PARTS = "x AS (SELECT event_id AS id, user_id || '|' || CAST(ts AS DATE) AS gt, user_id || '|' || event_type AS cluster FROM events), n AS (SELECT gt, cluster, count(*) AS n FROM x GROUP BY 1, 2), a AS (SELECT gt, count(*) AS gs FROM x GROUP BY 1), c AS (SELECT cluster, count(*) AS cs FROM x GROUP BY 1), j AS (SELECT * FROM n JOIN a USING (gt) JOIN c USING (cluster))"
_BEST = _PARTS + ", r AS (SELECT *, row_number() OVER (PARTITION BY gt ORDER BY n DESC, cluster) AS rk, count(*) OVER (PARTITION BY gt) AS parts FROM j), best AS (SELECT gt, cluster, n, gs, cs, n / cs AS p, n / gs AS r, 2 * (n / cs) * (n / gs) / (n / cs + n / gs) AS f, parts - 1 AS splits, cs - n AS merged FROM r WHERE rk = 1)"


@query(f"WITH {_BEST} SELECT gt, cluster, n, gs AS gt_size, cs AS cluster_size, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, splits, merged FROM best")
def best_match_cluster_f1(spark, d):
    return _rounded(metrics.best_match(*_partitions(spark, d)))


@query(f"WITH {_BEST} SELECT round(avg(p), 6) AS precision, round(avg(r), 6) AS recall, round(avg(f), 6) AS f1, count(*) AS clusters, CAST(count_if(splits > 0) AS BIGINT) AS with_splits, CAST(count_if(merged > 0) AS BIGINT) AS with_merges FROM best")
def best_match_summary(spark, d):
    return _rounded(metrics.best_match_summary(metrics.best_match(*_partitions(spark, d))))


@query(f"WITH {_PARTS}, s AS (SELECT sum(n * n / cs) / sum(n) AS p, sum(n * n / gs) / sum(n) AS r FROM j) SELECT round(p, 6) AS precision, round(r, 6) AS recall, round(2 * p * r / (p + r), 6) AS f1 FROM s")
def bcubed(spark, d):
    return _rounded(metrics.bcubed(*_partitions(spark, d)))


@query(f"WITH {_PARTS}, s AS (SELECT (SELECT sum(n * (n - 1) / 2) FROM n) AS s, (SELECT sum(gs * (gs - 1) / 2) FROM a) AS a, (SELECT sum(cs * (cs - 1) / 2) FROM c) AS b, (SELECT count(*) FROM x) AS n) SELECT round((s - a * b / (n * (n - 1) / 2)) / ((a + b) / 2 - a * b / (n * (n - 1) / 2)), 6) AS ari FROM s")
def ari(spark, d):
    return _rounded(metrics.adjusted_rand(*_partitions(spark, d)))


@query(f"WITH {_BEST} SELECT CAST(count_if(f = 1) AS BIGINT) AS perfect, CAST(count_if(f >= 0.8 AND f < 1) AS BIGINT) AS good, CAST(count_if(f >= 0.5 AND f < 0.8) AS BIGINT) AS fair, CAST(count_if(f < 0.5) AS BIGINT) AS poor FROM best")
def quality_bands(spark, d):
    return metrics.quality_bands(metrics.best_match(*_partitions(spark, d)))


@query("SELECT CAST(count(*) AS BIGINT) AS clusters, CAST(count_if(c = 1) AS BIGINT) AS singletons, CAST(count_if(c > 1) AS BIGINT) AS multiple, max(c) AS largest, round(avg(c), 6) AS mean FROM (SELECT user_id, event_type, count(*) AS c FROM events GROUP BY 1, 2)")
def cluster_sizes(spark, d):
    return _rounded(metrics.cluster_sizes(_partitions(spark, d)[1]))


@query("""SELECT lang, count(*) AS n, round(avg(n_chars), 6) AS mean, round(coalesce(stddev_samp(n_chars), 0), 4) AS std, min(n_chars)::DOUBLE AS min, max(n_chars)::DOUBLE AS max, quantile_cont(n_chars, 0.25) AS q1, quantile_cont(n_chars, 0.5) AS median, quantile_cont(n_chars, 0.75) AS q3,
quantile_cont(n_chars, 0.75) - quantile_cont(n_chars, 0.25) AS iqr FROM documents GROUP BY lang""")
def score_statistics(spark, d):
    rows = metrics.describe(t(spark, d, "documents"), "n_chars", "lang")
    return rows.withColumn("mean", r6("mean")).withColumn("std", F.round("std", 4))


@query()
def bootstrap_interval(spark, d):
    return metrics.bootstrap_ci(t(spark, d, "embeddings").select("label", F.size("embedding").alias("x")).withColumn("x", F.col("x") + F.col("label")), "x", "label", samples=200)


@query("WITH m AS (SELECT lang, avg(quality) AS m FROM documents JOIN labels USING (doc_id) GROUP BY lang), s AS (SELECT lang, count(*) AS share FROM documents GROUP BY lang) SELECT round(sum(m * share) / sum(share), 6) AS value FROM m JOIN s USING (lang)")
def poststratified(spark, d):
    shares = t(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("share"))
    return _rounded(metrics.poststratified(_labelled(spark, d), "lang", F.col("quality"), shares))


@query("""SELECT CASE WHEN grouping(source) = 1 THEN 'total' ELSE source END AS scope, CAST(sum(n_chars) AS BIGINT) AS tokens_in, CAST(sum(n_chars // 10) AS BIGINT) AS tokens_out, count(*) AS calls, round((sum(n_chars) * 0.4 + sum(n_chars // 10) * 1.6) / 1e6, 6) AS cost
FROM documents GROUP BY GROUPING SETS ((), (source))""")
def token_costs(spark, d):
    return _rounded(metrics.token_costs(t(spark, d, "documents").select("source", F.col("n_chars").alias("tokens_in"), F.expr("n_chars div 10").alias("tokens_out")), "source"))


# --- similarity --------------------------------------------------------------------------------------------------

_PAIRS = "x AS (SELECT a.p_partkey AS a, b.p_partkey AS b, lower(a.p_name) AS n, lower(b.p_name) AS m FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey)"


def _name_pairs(spark, d, similarity: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``a, b, similarity`` of the parts of a brand and size; ``similarity`` adds it to pairs of names (``n, m``).

    Names are compared once for all parts that have them, in either order, as a measure may tell the orders apart. The
    table is small for the pairs it makes, so parts meet in blocks that are dealt by number.
    """
    key = ["brand", "size", "nameless"]
    p = t(spark, d, "part").where("p_brand IS NOT NULL AND p_size IS NOT NULL").select(F.col("p_brand").alias("brand"), F.col("p_size").alias("size"), F.col("p_name").isNull().alias("nameless"), F.coalesce(F.lower("p_name"), F.lit("")).alias("name"), "p_partkey")
    side = lambda df, k: df.withColumnsRenamed({c: f"{k}_{c}" for c in (*key, "name")})
    m, r = side(p, "a").withColumnRenamed("p_partkey", "a"), side(p, "b").withColumnRenamed("p_partkey", "b")
    ours, theirs = ([f"{k}_{c}" for c in (*key, "name")] for k in "ab")
    met = linkage.in_blocks(m, ours, "__mb").join(linkage.in_blocks(r, theirs, "__rb"), (F.col("a_brand") == F.col("b_brand")) & (F.col("a_size") == F.col("b_size")))
    pair = ["a_name", "a_nameless", "b_name", "b_nameless"]
    null = lambda k: F.when(~F.col(f"{k}_nameless"), F.col(f"{k}_name"))
    alike = similarity(met.select(*pair).distinct().withColumns({"n": null("a"), "m": null("b")})).select(*pair, "similarity")
    return linkage.block_join(m, r, met.join(alike, pair), ours, theirs).where("a < b").select("a", "b", "similarity")


@query(f"WITH {_PAIRS} SELECT a, b, round(1 - levenshtein(n, m) / greatest(length(n), length(m)), 6) AS similarity FROM x")
def levenshtein_sim(spark, d):
    return _rounded(_name_pairs(spark, d, lambda x: x.withColumn("similarity", M.levenshtein_similarity("n", "m"))))


@query("""
WITH p AS (SELECT p_partkey AS k, lower(p_name) AS n FROM part), r AS (SELECT n, min(k) AS k FROM p GROUP BY n)
SELECT r.k AS a, p.k AS b, CAST(1 AS DOUBLE) AS similarity FROM p JOIN r ON p.n IS NOT DISTINCT FROM r.n WHERE p.k <> r.k
UNION ALL SELECT x.k, y.k, CASE WHEN x.n IS NULL OR y.n IS NULL THEN 1 ELSE round(1 - levenshtein(x.n, y.n) / greatest(length(x.n), length(y.n)), 6) END FROM r x JOIN r y ON x.k < y.k""")
def levenshtein_sim_whole(spark, d):
    """All parts, whatever their brand and size; the SQL of :func:`levenshtein_sim` has those of one brand and size.

    The least part of a name stands for it: rows link it to the name's other parts (1.0) and to those of all other names.
    """
    p = t(spark, d, "part").select(F.col("p_partkey").alias("k"), F.lower("p_name").alias("n"))
    names = p.groupBy("n").agg(F.min("k").alias("a"))
    members = p.join(names.withColumnRenamed("n", "m"), F.col("n").eqNullSafe(F.col("m"))).where("k <> a").select("a", F.col("k").alias("b"), F.lit(1.0).alias("similarity"))
    pairs = names.join(names.select(F.col("a").alias("b"), F.col("n").alias("m")), F.col("a") < F.col("b")).select("a", "b", M.levenshtein_similarity("n", "m").alias("similarity"))
    return _rounded(members.unionByName(pairs))


@query(f"WITH {_PAIRS} SELECT a, b, round(jaro_winkler_similarity(n, m), 6) AS similarity FROM x")
def jaro_winkler_sim(spark, d):
    return _rounded(_name_pairs(spark, d, lambda x: x.withColumn("similarity", M.jaro_winkler("n", "m"))))


@query(f"WITH {_PAIRS} SELECT a, b, round((0.45 * jaro_winkler_similarity(split_part(n, ' ', 1), split_part(m, ' ', 1)) + 0.45 * jaro_winkler_similarity(split_part(n, ' ', 2), split_part(m, ' ', 2))) / 0.9, 6) AS similarity FROM x")
def weighted_name_sim(spark, d):
    word = lambda c, k: F.coalesce(F.try_element_at(F.split(c, " "), F.lit(k)), F.lit(""))
    parts = {"first": M.component_similarity(word("n", 1), word("m", 1)), "last": M.component_similarity(word("n", 2), word("m", 2))}
    return _rounded(_name_pairs(spark, d, lambda x: x.withColumns(parts).withColumn("similarity", M.weighted_similarity({k: F.col(k) for k in parts}))))


@query()
def fuzzy_dedup(spark, d):
    rows = t(spark, d, "part").groupBy("p_brand").agg(F.collect_set("p_name").alias("names"))
    return rows.select("p_brand", M.distinct_strings("names").alias("kept"))


# --- sequences ---------------------------------------------------------------------------------------------------


@query("""WITH s AS (SELECT conv_id, turn, CASE WHEN row_number() OVER (PARTITION BY conv_id ORDER BY turn) > 1 AND role <> 'user' THEN 0 ELSE 1 END AS st FROM conversations), g AS (SELECT *, sum(st) OVER (PARTITION BY conv_id ORDER BY turn) AS segment FROM s)
SELECT conv_id, CAST(segment AS INT) AS segment, min(turn) AS start_page, max(turn) AS end_page, count(*) AS n_pages FROM g GROUP BY conv_id, segment""")
def islands(spark, d):
    rows = segmentation.segments(t(spark, d, "conversations").select("conv_id", "turn", "role"), "conv_id", "turn", F.col("role") != "user")
    return segmentation.contents(rows, "conv_id", "turn")


@query(r"""WITH p AS (SELECT conv_id, turn, string_split(lag(text) OVER (PARTITION BY conv_id ORDER BY turn), chr(10)) AS l FROM conversations)
SELECT conv_id, turn, array_to_string(l[greatest(len(l) - 4, 1) : len(l)], chr(10)) AS previous FROM p""")
def lag_context(spark, d):
    return segmentation.previous_tail(t(spark, d, "conversations"), "conv_id", "turn", "text").select("conv_id", "turn", "previous")


@query()
def page_fold(spark, d):
    return segmentation.fold_pages(t(spark, d, "conversations"), "conv_id", "turn", "text")


@query("SELECT event_type, time_bucket(INTERVAL '1 hour', ts) AS start, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def events_windows(spark, d):
    rows = streams.tumbling(t(spark, d, "events"), "ts", "1 hour", "event_type", values={"total": F.round(F.sum("value"), 4)})
    return rows.withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("""
WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events),
k AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS nr FROM g)
SELECT user_id, min(ts) AS "start", max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n FROM k GROUP BY user_id, nr
""")
def events_sessions(spark, d):
    found = streams.sessions(t(spark, d, "events"), "ts", "30 minutes", "user_id")
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


# --- samples, models, prompts ------------------------------------------------------------------------------------


@query("SELECT c_custkey, c_nationkey FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY md5(CAST(c_custkey AS VARCHAR) || ':0'), c_custkey) AS n FROM customer) WHERE n <= 5")
def stratified_sample(spark, d):
    return cases.stratified(t(spark, d, "customer").select("c_custkey", "c_nationkey"), "c_custkey", "c_nationkey", 5)


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM (SELECT DISTINCT o_custkey FROM orders) ORDER BY md5(CAST(o_custkey AS VARCHAR) || ':0'), o_custkey LIMIT 20)")
def key_sample(spark, d):
    return cases.sampled_keys(t(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_custkey", 20)


@query("SELECT value, n FROM (SELECT unnest(string_split(text, ' ')) AS value, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, value LIMIT 50)")
def most_common_values(spark, d):
    return metrics.most_common(t(spark, d, "documents").select(F.explode(F.split("text", " ", -1)).alias("w")), "w")


@query()
def llm_distinct_map(spark, d):
    docs = t(spark, d, "documents").select("doc_id", "lang", "source", "text")
    done = completions.complete(docs, T.render("Source $source in $lang: $text", source="source", lang="lang", text="text"))
    return done.select("doc_id", "answer", "answer_error")


@query()
def summary_filter(spark, d):
    return completions.filtered_summaries(t(spark, d, "conversations").select("conv_id", "turn", "text"), "conv_id", "turn", "text", 4)


@query()
def ml_score(spark, d):
    rows = _labelled(spark, d).select("doc_id", F.col("quality").alias("label"), F.col("n_chars").cast("double").alias("length_ratio_chars"), F.length("source").cast("double").alias("length_ratio_source"))
    _, model, _ = learning.train(rows, ["length_ratio_chars", "length_ratio_source"], names=("logistic",), folds=2)
    return learning.scored(rows, model).select("doc_id", r6("match_probability").alias("match_probability"))


@query()
def name_cleaning(spark, d):
    c = t(spark, d, "customer").select("c_custkey", F.concat(F.element_at(F.array(*map(F.lit, ("Sgt. ", "Police Officer II ", "Officer ", "", "K-9 Handler "))), (F.col("c_custkey") % 5 + 1).cast("int")), F.lit("John "), F.col("c_mktsegment"), F.lit(" #12")).alias("name"))
    return c.select("c_custkey", T.clean_officer_name("name").alias("cleaned"), T.invalid_name("name").alias("invalid"), T.person_name("name").alias("person"), F.array_join(X.metadata_names("name"), ",").alias("names"), T.mention_uid("c_custkey", "name").alias("uid"))


@query()
def list_parsing(spark, d):
    v = F.concat(F.lit("['"), F.col("r_name"), F.lit("', None, 'x']"))
    return t(spark, d, "region").select("r_regionkey", L.text_list(v).alias("elements"), L.text_vector(F.lit("[1.5 2 3]")).alias("vector"), L.chunks(F.sequence(F.lit(1), F.lit(9))).alias("chunks"))


# --- earlier forms -----------------------------------------------------------------------------------------------


@query(r"""
WITH w AS (SELECT conv_id, turn, unnest(regexp_extract_all(lower(text), '[a-z]{2,}')) AS term FROM conversations WHERE turn < 2), p AS (SELECT term, conv_id, turn, count(*) AS tf FROM w WHERE term NOT IN ('the', 'of', 'and', 'to', 'in') GROUP BY ALL)
SELECT term, CAST(sum(tf) AS BIGINT) AS tf, count(*) AS df FROM p GROUP BY term HAVING length(term) >= 12""")
def tfidf_terms(spark, d):
    pages = t(spark, d, "conversations").where("turn < 2").withColumn("words", F.array_join(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]{2,})"), F.lit(1)), " "))
    return legacy.term_weights(pages, "words", None).where("length(term) >= 12").select("term", "tf", "df")


@query()
def tfidf_terms_of_documents(spark, d):
    """All terms of all documents with their weight; the SQL of :func:`tfidf_terms` has long terms of first turns."""
    return legacy.term_weights(t(spark, d, "documents"), "text", None).select("term", "tf", "df", r6("tfidf").alias("tfidf"))


@query()
def manual_features(spark, d):
    return legacy.file_features(t(spark, d, "conversations"), "conv_id", "turn", "text", ["the", "of"], ["the"])


@query()
def persons_merged(spark, d):
    rows = t(spark, d, "supplier").select(F.col("s_nationkey").alias("k"), F.concat(F.lit("Smith, "), F.when(F.col("s_suppkey") % 2 == 0, "John").otherwise("Mary")).alias("name"), F.array(F.lit("witness")).alias("person_type"), F.col("s_suppkey").alias("page_number"), F.col("s_name").alias("document_name"), F.lit("high").alias("confidence"), F.lit("").alias("address"))
    return legacy.merged_persons(rows, "k")


@query()
def path_weight_edges(spark, d):
    """Orders as files of their customer and day: by turns PDFs with an id, with a name, with a number, and recordings
    with an id; every thousandth order has a day alone."""
    o = t(spark, d, "orders").join(t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name"), "o_custkey", "left")
    turn, day_alone = F.col("o_orderkey") % 4, F.col("o_orderkey") % 1000 == 1
    case = F.concat(F.lit("IA"), F.col("o_custkey").cast("string"))
    known = turn.isin(0, 3)
    document = F.when(turn == 0, F.concat(case, F.lit(".pdf"))).when(turn == 3, F.concat(case, F.lit(".mp3"))).otherwise("scan.pdf")
    number = F.when(turn == 2, F.concat(F.lit("N"), F.col("o_custkey").cast("string")))
    return legacy.edges(o.select(
        F.col("o_orderkey").alias("id"), document.alias("document_name"), F.when(known, F.concat(F.lit("a/"), case)).otherwise("a/b").alias("gdrive_path"),
        F.when((turn != 2) & ~day_alone, F.col("c_name")).alias("name"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), number.alias("case_numbers"),
    ))


@query()
def pair_model_features(spark, d):
    docs = _incident_docs(spark, d)
    pairs = clustering.pair_features(clustering.candidate_pairs(docs, clustering.Rules()), docs)
    rows = legacy.model_features(pairs)
    return rows.select("a", "b", *legacy.tier_features([c for c in rows.columns if "_" in c], (1, 2)))
