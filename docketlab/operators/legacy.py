"""Earlier forms of clustering: weights of path features, their blocking, and features of pairs for learned models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.ml import PipelineModel

from ..functions import dates as D, extract as X, text as T
from . import graph
from .learning import scored


def prepared(docs: DataFrame) -> DataFrame:
    """Documents (``id, document_name, gdrive_path, name, date, case_numbers``) with ids and dates out of name and path."""
    ids = F.array_sort(F.array_union(X.legacy_ids("document_name"), X.legacy_ids("gdrive_path")))
    found = F.filter(F.transform(F.array_union(X.legacy_dates("document_name"), X.legacy_dates("gdrive_path")), D.legacy_date), lambda x: x.isNotNull())
    return docs.withColumns({"ids": ids, "incident_id": F.nullif(F.array_join(ids, ", "), F.lit("")), "days": F.array_distinct(found), "names": _names("name"), "numbers": _names("case_numbers"), "extension": T.extension("document_name")})


def _names(c: str) -> Column:
    return F.filter(F.split(T.without_unnamed(c), ", "), lambda x: x != "")


def id_similarity(a, b) -> Column:
    """1 if two texts have an identifier in common, else 0."""
    return F.when(F.coalesce(F.arrays_overlap(X.legacy_ids(a), X.legacy_ids(b)), F.lit(False)), 1.0).otherwise(0.0)


#: Parts that the documents of a month are dealt to.
MONTH_PARTS = 16


def days_near() -> Column:
    """Whether the days found in names and paths are at most 180 apart, or one side has none."""
    gap = F.array_min(F.flatten(F.transform("a_days", lambda x: F.transform("b_days", lambda y: F.abs(F.datediff(x, y))))))
    return gap.isNull() | (gap <= 180)


def by_days(gap: Column) -> Column:
    """Weight of a difference in days; null if it is not known."""
    return F.when(gap <= 30, 1.0).when(gap <= 60, 0.7).when(gap <= 90, 0.5).when(gap.isNotNull(), 0.0)


def comparable() -> Column:
    """Whether a pair may match: both or neither have ids and numbers, ids that are there overlap, and days are at most 180 apart."""
    has = lambda s, c: F.size(f"{s}_{c}") > 0
    return (has("a", "ids") == has("b", "ids")) & (has("a", "numbers") == has("b", "numbers")) & (~has("a", "ids") | F.arrays_overlap("a_ids", "b_ids")) & days_near()


def weight() -> Column:
    """Weight of a pair by kinds of file, ids, names within 90 days, case numbers, or days and names; 0 if nothing says.

    The first document's being a PDF and the second's not is no mirror of the other order: pairs have the lesser id first.
    """
    a, b = F.col("a_extension"), F.col("b_extension")
    both_known = (a != "") & (b != "")
    gap = D.days_apart("a_date", "b_date")
    share = lambda c: F.size(F.array_intersect(f"a_{c}", f"b_{c}")) > 0
    named = (F.size("a_names") > 0) & (F.size("b_names") > 0)
    numbered = (F.size("a_numbers") > 0) & (F.size("b_numbers") > 0) & F.coalesce(F.col("a_date"), F.lit("")).rlike(".") & F.coalesce(F.col("b_date"), F.lit("")).rlike(".")
    near = F.coalesce(gap < 90, F.lit(False))
    by_date = by_days(gap)
    by_name = F.when(named, F.when(share("names"), 1.0).otherwise(0.0))
    mean = F.when(by_date.isNotNull() & by_name.isNotNull(), (by_date + by_name) / 2).otherwise(F.coalesce(by_date, by_name, F.lit(0.0)))
    one = lambda c: F.when(c, 1.0).otherwise(0.0)
    return (
        F.when(both_known & (a != ".pdf") & (b != ".pdf"), id_similarity("a_document_name", "b_document_name"))
        .when(both_known & (a == ".pdf") & (b != ".pdf"), id_similarity("a_gdrive_path", "b_gdrive_path"))
        .when(named & near & share("names"), 1.0)
        .when((a == ".pdf") & (b == ".pdf"), F.when(F.col("a_incident_id").isNotNull() & F.col("b_incident_id").isNotNull(), one(F.col("a_incident_id") == F.col("b_incident_id"))).when(numbered, one(share("numbers") & near)).otherwise(mean))
        .otherwise(0.0)
    )


def edges(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """``src, dst, weight`` of pairs above ``least``. Pairs meet by an id, a name or a number in common, or by a month
    next to one another where neither has ids or numbers and one has no names: a weight of more than a half, the least
    that ``least`` may be, needs one of these."""
    p = prepared(docs)
    month = lambda d: F.year(d) * 12 + F.month(d)
    own = F.transform("ids", lambda x: F.concat(F.lit("i:"), x))
    people = F.transform("names", lambda x: F.concat(F.lit("n:"), x))
    numbers = F.transform("numbers", lambda x: F.concat(F.lit("c:"), x))
    keys = p.select("id", F.explode(F.array_distinct(F.concat(own, people, numbers))).alias("k"))
    pairs = keys.withColumnRenamed("id", "a").join(keys.withColumnRenamed("id", "b"), "k").where("a < b").select("a", "b")
    none = lambda c: ~F.coalesce(F.size(c) > 0, F.lit(False))
    dated = p.where(none("ids") & none("numbers") & (F.col("extension") == ".pdf") & D.iso_date("date").isNotNull())
    # Of such a pair both have ids in neither name nor path, no numbers, and one no names: its days alone give the weight.
    dated = dated.select("id", D.iso_date("date").alias("day"), month(D.iso_date("date")).alias("m"), none("names").alias("bare"), "days")
    around = F.explode(F.transform(F.sequence(F.lit(-2), F.lit(2)), lambda k: F.col("m") + k))  # weights above a half end at 60 days
    # A month of many documents is dealt to parts by number; those without names go to each part, as they are few.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64("id"), F.lit(MONTH_PARTS)).cast("int").alias("part")
    bare = dated.where("bare").select(F.col("id").alias("other"), F.col("day").alias("other_day"), F.col("days").alias("b_days"), around.alias("m"))
    bare = bare.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(MONTH_PARTS - 1)))).repartition(tasks, "m", "part")
    dated = dated.select("id", "day", F.col("days").alias("a_days"), "m", "bare", part).repartition(tasks, "m", "part")
    gap = F.abs(F.datediff("day", "other_day"))
    months = dated.join(bare, ["m", "part"]).where("id <> other AND (NOT bare OR id < other)").where(days_near()).withColumn("weight", by_days(gap)).where(F.col("weight") > least)
    months = months.select(F.least("id", "other").alias("src"), F.greatest("id", "other").alias("dst"), "weight")
    # Documents without names, ids and numbers share no key, so no pair is in both nets.
    side = lambda s: p.select(F.col("id").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in p.columns if c != "id"])
    rows = pairs.distinct().join(side("a"), "a").join(side("b"), "b").where(comparable()).withColumn("weight", weight())
    return rows.where(F.col("weight") > least).select(F.col("a").alias("src"), F.col("b").alias("dst"), "weight").unionByName(months)


def merged_groups(clusters: DataFrame, docs: DataFrame, keys: list[str]) -> DataFrame:
    """Clusters joined further by equal values of the key columns; joining is transitive, so the order does not matter."""
    links = clusters.select(F.col("id"), F.concat(F.lit("k:"), F.col("cluster").cast("string")).alias("k"))
    for c in keys:
        links = links.unionByName(docs.where(F.col(c).isNotNull()).select("id", F.concat(F.lit(f"{c}:"), F.col(c).cast("string")).alias("k")))
    return graph.components(clusters.select("id"), graph.star_edges(links, "k")).withColumnRenamed("component", "cluster")


def model_features(pairs: DataFrame) -> DataFrame:
    """Features of pairs (from :func:`docketlab.operators.clustering.pair_features`) for a learned model; a missing difference is null."""
    n = lambda c: F.col(f"n_{c}")
    out = {}
    # Taken by several features each, so they are columns of their own, made once for a pair.
    shared = F.array_intersect("a_t1_names", "b_t1_names")
    pairs = pairs.withColumns({"__gap1": D.days_gap("a_t1_days", "b_t1_days"), "__gap2": D.days_gap("a_t2_days", "b_t2_days"), "__shared": shared, "__depth": T.common_depth(F.col("a_directories"), F.col("b_directories"))})
    pairs = pairs.withColumns({"__full": F.exists("__shared", lambda x: F.contains(x, F.lit(" "))), "__longest": F.coalesce(F.array_max(F.transform("__shared", F.length)), F.lit(0))})
    for tier, ids, days, gap in (("tier1", "t1_case_ids", "t1_dates", F.col("__gap1")), ("tier2", "t2_case_ids", "t2_dates", F.col("__gap2"))):
        out |= {f"{tier}_has_case_id_match": n(ids) > 0, f"{tier}_num_shared_case_ids": n(ids), f"{tier}_has_exact_date_match": n(days) > 0, f"{tier}_num_shared_dates": n(days), f"{tier}_min_date_diff_days": gap}
        out |= {f"{tier}_dates_within_{k}d": F.coalesce(gap <= k, F.lit(False)) for k in (30, 90, 180, 365)}
    full, longest, depth = F.col("__full"), F.col("__longest"), F.col("__depth")
    out |= {"tier1_has_name_match": n("t1_names") > 0, "tier1_num_shared_names": n("t1_names"), "tier1_max_shared_name_length": longest, "tier1_has_full_name_match": full, "tier1_has_long_name_match": longest >= 8, "tier1_has_substantial_name_match": full | (longest >= 8)}
    out |= {"shared_dir_depth": depth, "shared_2plus_dirs": depth >= 2, "shared_3plus_dirs": depth >= 3, "exact_dir_match": F.col("same_dir")}
    out |= {"tier2_has_subject_match": n("t2_subjects") > 0, "tier2_num_shared_subjects": n("t2_subjects"), "tier2_has_officer_match": n("t2_officers") > 0, "tier2_num_shared_officers": n("t2_officers")}
    rows = pairs.withColumns(out).drop("__gap1", "__gap2", "__shared", "__depth", "__full", "__longest")
    c = F.col
    least = F.least("tier1_min_date_diff_days", "tier2_min_date_diff_days")
    return rows.withColumns({
        "any_case_id_match": c("tier1_has_case_id_match") | c("tier2_has_case_id_match"), "any_date_match": c("tier1_has_exact_date_match") | c("tier2_has_exact_date_match"),
        "combined_min_date_diff_days": least, "combined_dates_within_365d": F.coalesce(least <= 365, F.lit(False)),
        "tier1_case_id_and_close_dates": c("tier1_has_case_id_match") & c("tier1_dates_within_365d"), "tier1_name_and_date": c("tier1_has_substantial_name_match") & c("tier1_has_exact_date_match"),
        "tier2_case_id_and_close_dates": c("tier2_has_case_id_match") & c("tier2_dates_within_365d"), "tier2_subject_and_date": c("tier2_has_subject_match") & c("tier2_has_exact_date_match"),
        "tier2_subject_and_case_id": c("tier2_has_subject_match") & c("tier2_has_case_id_match"), "tier2_officer_date_and_case_id": c("tier2_has_officer_match") & c("tier2_has_exact_date_match") & c("tier2_has_case_id_match"),
        "tier2_officer_date_and_subject": c("tier2_has_officer_match") & c("tier2_has_exact_date_match") & c("tier2_has_subject_match"),
    })


def tier_features(columns: list[str], tiers: tuple[int, ...]) -> list[str]:
    """The feature columns that a subset of tiers may use."""
    out = {c for k in (1, 2) if k in tiers for c in columns if c.startswith(f"tier{k}_")}
    if 1 in tiers:
        out |= {c for c in columns if c.startswith(("shared_", "exact_dir"))}
    if {1, 2} <= set(tiers):
        out |= {c for c in columns if c.startswith(("any_", "combined_"))}
    return [c for c in columns if c in out]


def model_edges(features: DataFrame, first: PipelineModel, second: PipelineModel | None = None, threshold: float = 0.5) -> DataFrame:
    """Pairs that a joint model likes; or, with a second model, those that it likes among what the first leaves."""
    one = scored(features, first, "p").where(F.col("p") > threshold).select(F.col("a").alias("src"), F.col("b").alias("dst"))
    if second is None:
        return one
    rest = features.join(one.withColumnsRenamed({"src": "a", "dst": "b"}), ["a", "b"], "left_anti")
    return one.unionByName(scored(rest, second, "p").where(F.col("p") > threshold).select(F.col("a").alias("src"), F.col("b").alias("dst")))


# --- persons merged by alike names ---------------------------------------------------------------------------------

#: Order of confidence.
CONFIDENCE = {"high": 3, "medium": 2, "low": 1}


def merged_persons(rows: DataFrame, case: str, threshold: int = 85) -> DataFrame:
    """One row for each person of a case: names whose sorted words are alike to the first's count as one.

    ``rows`` has ``name, person_type`` (array), ``page_number, document_name, confidence, address``. Clusters are found
    name by name within a case; the fields are merged by aggregation.
    """
    import pandas as pd

    from ..functions.similarity import token_sort_value

    def mark(pdf: pd.DataFrame) -> pd.DataFrame:
        heads: list[tuple[str, int]] = []
        out = []
        for name in sorted({n for n in pdf["key"] if n}):
            nr = next((k for h, k in heads if token_sort_value(h, name) >= threshold), None)
            if nr is None:
                nr = len(heads)
                heads.append((name, nr))
            out.append((pdf["case"].iloc[0], name, nr))
        return pd.DataFrame(out, columns=["case", "key", "person"])

    key = F.trim(F.regexp_replace(F.lower(F.coalesce("name", F.lit(""))), r"\s+", " "))
    keyed = rows.withColumn("case", F.col(case).cast("string")).withColumn("key", key)
    marks = keyed.select("case", "key").distinct().groupBy("case").applyInPandas(mark, "case string, key string, person int")
    best = F.coalesce(*[F.when(F.max(F.when(F.col("confidence") == k, v).otherwise(0)) == v, k) for k, v in CONFIDENCE.items()], F.lit("low"))
    text = lambda c: F.array_join(F.array_sort(F.collect_set(F.when(F.trim(c) != "", F.col(c)))), "; ").alias(c)
    return keyed.join(marks, ["case", "key"]).groupBy("case", "person").agg(
        F.mode("name", True).alias("name"), F.count("*").alias("original_count"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("person_type")))).alias("person_type"),
        F.array_sort(F.collect_set("page_number")).alias("page_number"), text("document_name"), text("address"), best.alias("confidence"),
    )


# --- manuals: terms, headings and sections of labelled pages, and a row of counts for each file --------------------

HEADING, SECTION = r"^[A-Z0-9][A-Z0-9\s]{4,50}$", r"^(\d+(?:\.\d+)+)"
#: Words too common to tell (the most frequent of English).
STOP = "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which one you were all her she there would their we him been has when who will no more if out so up said what its about than into them can only other time new some could these two may first then do any like my now over such our man me even most made after also did many".split()


def term_weights(pages: DataFrame, text: str, n: int | None = 30) -> DataFrame:
    """The ``n`` most frequent words of the pages (None: all, in no order), with their document frequency and TF-IDF weight."""
    rows = pages.withColumn("__d", F.monotonically_increasing_id()).select("__d", F.explode(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"(?U)(\b\w\w+\b)"), F.lit(1))).alias("term"))
    per = rows.where(~F.col("term").isin(STOP)).groupBy("term", "__d").agg(F.count("*").alias("tf")).groupBy("term").agg(F.sum("tf").alias("tf"), F.count("*").alias("df"))
    total = pages.agg(F.count("*").alias("pages"))
    idf = F.log((1 + F.col("pages")) / (1 + F.col("df"))) + 1
    out = per.crossJoin(F.broadcast(total)).withColumn("tfidf", F.col("tf") * idf).drop("pages")
    return out if n is None else out.orderBy(F.desc("tf"), "term").limit(n)


def page_lines(pages: DataFrame, text: str) -> DataFrame:
    return pages.select("*", F.explode(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(x))).alias("line"))


def headings(pages: DataFrame, text: str, n: int = 30) -> DataFrame:
    return page_lines(pages, text).where(F.col("line").rlike(HEADING)).groupBy(F.lower("line").alias("heading")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "heading").limit(n)


def sections(pages: DataFrame, text: str) -> DataFrame:
    return page_lines(pages, text).select(F.regexp_extract("line", SECTION, 1).alias("section")).where("section <> ''").groupBy("section").agg(F.count("*").alias("n"))


def file_features(pages: DataFrame, file: str, page: str, text: str, terms: list[str], heads: list[str]) -> DataFrame:
    """Counts of known terms, headings and numbered sections on a file's first two pages and after them."""
    import re

    t = F.lower(F.coalesce(text, F.lit("")))
    words = sum((F.when(t.rlike(rf"\b{re.escape(w)}\b"), 1).otherwise(0) for w in terms), F.lit(0))
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    any_head = "|".join(map(re.escape, heads)) or "(?!)"
    n_heads = F.size(F.filter(lines, lambda x: F.lower(x).rlike(any_head)))
    n_sections = F.size(F.filter(lines, lambda x: F.trim(x).rlike(SECTION + r"\b")))
    rows = pages.select(F.col(file).alias("file"), F.col(page).alias("page"), F.length(F.coalesce(text, F.lit(""))).alias("chars"), words.alias("keyword"), n_heads.alias("header"), n_sections.alias("section"))
    part = lambda c, early: F.sum(F.when((F.col("page") <= 2) == F.lit(early), F.col(c)).otherwise(0)).alias(("early_" if early else "late_") + c)
    return rows.groupBy("file").agg(*[part(c, e) for c in ("keyword", "header", "section") for e in (True, False)], F.count_distinct("page").alias("page_count"), F.sum("chars").alias("text_length"))


def first_pages(pages: DataFrame, file: str, page: str, n: int = 3) -> DataFrame:
    return pages.withColumn("__n", F.row_number().over(W.partitionBy(file).orderBy(page))).where(F.col("__n") <= n).drop("__n")
