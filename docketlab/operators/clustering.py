"""Incident clustering: pair rules as equi-joins, a match graph, its components, and their refinement."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.dates import within_days
from ..functions.text import _directories, render
from ..plans import completions
from ..plans.scratch import written
from . import graph


@dataclass(frozen=True)
class Rules:
    """What is compared. ``tiers`` in use, rules switched off by name, and features left out."""

    tiers: tuple[int, ...] = (1, 2)
    off: frozenset[str] = frozenset()
    without: frozenset[str] = frozenset()  # of case_ids, dates, subject_names, officer_names
    days: int = 365
    dates_required: bool = False
    similarity: float = 0.9
    density: float = 0.3

    def on(self, rule: str) -> bool:
        return rule not in self.off


def _shared(docs: DataFrame, *columns: str) -> DataFrame:
    """Pairs (``a`` < ``b``) that share a value of each of the array columns, by one equi-join on the values together."""
    rows = docs.select("id", *columns)
    for c in columns:
        rows = rows.withColumn(c, F.explode(F.array_distinct(c)))
    left, right = rows.withColumnRenamed("id", "a"), rows.withColumnRenamed("id", "b")
    return left.join(right, list(columns)).where("a < b").select("a", "b").distinct()


def _directory(c: str) -> Column:
    return F.regexp_extract(F.coalesce(c, F.lit("")), "^(.*)/[^/]*$", 1)


def _deep(c: str) -> Column:
    """The directory if it is at least four levels deep, else null."""
    return F.when((F.size(F.split(c, "/")) > 4) & (_directory(c) != ""), _directory(c))


def _key(net: int, k: Column, of: Column | str = "") -> Column:
    return F.struct(F.lit(net).alias("net"), k.alias("k"), (F.lit(of) if isinstance(of, str) else of).alias("of"))


def _keys(net: int, first: str, second: str | None = None) -> Column:
    """Keys of a document under a net: each value of the array, or each value of the first with each of the second."""
    one = F.array_distinct(first)
    if second is None:
        return F.transform(one, lambda x: _key(net, x))
    return F.flatten(F.transform(one, lambda x: F.transform(F.array_distinct(second), lambda y: _key(net, x, y))))


def candidate_pairs(docs: DataFrame, rules: Rules) -> DataFrame:
    """Every pair that some rule may match, once. Documents have ``id, path`` and the sets ``t1_*`` and ``t2_*``.

    A pair that shares no key of a rule matches by none, so all pairs need not be made. The keys of all rules meet in
    one equi-join, so documents are read and dealt by key once.
    """
    nets = []
    if 1 in rules.tiers:
        if rules.on("t1_case_id") and "case_ids" not in rules.without:
            nets.append(_keys(1, "t1_case_ids"))
        if rules.on("t1_exact_dir"):
            nets.append(F.array(_key(2, _deep("path"))))
        if rules.on("t1_name_date"):
            nets.append(_keys(3, "t1_names", "t1_dates"))
    if 2 in rules.tiers:
        if rules.on("t2_case_id"):
            nets.append(_keys(4, "t2_case_ids"))
        if rules.on("t2_subject"):
            nets.append(_keys(5, "t2_subjects", "t2_dates"))
        if rules.on("t2_date_officer"):
            nets.append(_keys(6, "t2_officers", "t2_dates"))
    if not nets:
        return docs.select(F.col("id").alias("a"), F.col("id").alias("b")).where(F.lit(False))
    none = F.array().cast("array<struct<net:int,k:string,of:string>>")
    rows = docs.select("id", F.inline(F.flatten(F.array(*[F.coalesce(n, none) for n in nets])))).where("k IS NOT NULL AND of IS NOT NULL")
    rows = rows.withColumn("h", F.xxhash64("net", "k", "of"))  # numbers are sorted faster than texts that begin alike
    pairs = rows.withColumnRenamed("id", "a").join(rows.withColumnRenamed("id", "b"), ["h", "net", "k", "of"]).where("a < b").select("a", "b")
    return pairs.repartition("a").distinct()  # the features of a are joined next


def _features(docs: DataFrame, side: str) -> DataFrame:
    """Columns of one side of a pair; what depends on one document alone is made here, once and not for each pair."""
    cols = ["path", "t1_case_ids", "t1_dates", "t1_names", "t2_case_ids", "t2_dates", "t2_subjects", "t2_officers"]
    dates = lambda c: F.transform(c, lambda x: x.cast("date"))
    made = {"directory": _deep("path"), "directories": _directories("path"), "t1_days": dates("t1_dates"), "t2_days": dates("t2_dates")}
    return docs.select(F.col("id").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in cols], *[v.alias(f"{side}_{k}") for k, v in made.items()])


def pair_features(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Shared values and differences of each pair; missing differences are null."""
    both = pairs.join(_features(docs, "a"), "a").join(_features(docs, "b"), "b")
    out = both.withColumns({f"n_{c}": F.size(F.array_intersect(f"a_{c}", f"b_{c}")) for c in ("t1_case_ids", "t1_dates", "t1_names", "t2_case_ids", "t2_dates", "t2_subjects", "t2_officers")})
    return out.withColumns({
        "same_dir": F.coalesce(F.col("a_directory") == F.col("b_directory"), F.lit(False)),
        "both_ids": (F.size("a_t1_case_ids") > 0) & (F.size("b_t1_case_ids") > 0),
        "long_name": F.exists(F.array_intersect("a_t1_names", "b_t1_names"), lambda x: F.contains(x, F.lit(" ")) | (F.length(x) >= 8)),
    })


def tier1(rules: Rules) -> Column:
    """match, block or maybe. A shared id matches; a directory, or a long name and a date, unless the ids conflict;
    a conflict with neither blocks."""
    ids = F.lit("case_ids" not in rules.without and rules.on("t1_case_id"))
    conflict = ids & F.col("both_ids") & (F.col("n_t1_case_ids") == 0)
    where = F.col("same_dir") & F.lit(rules.on("t1_exact_dir"))
    who = F.col("long_name") & (F.col("n_t1_dates") > 0) & F.lit(rules.on("t1_name_date") and "dates" not in rules.without and not {"subject_names", "officer_names"} <= rules.without)
    return F.when(ids & (F.col("n_t1_case_ids") > 0), "case_id_only").when(where & ~conflict, "exact_dir_match").when(who & ~conflict, "name_and_date").when(conflict & ~where & ~who, "block").otherwise("maybe")


def tier2(rules: Rules) -> Column:
    """The rule that matches, or null: a shared id in the date window (outside it nothing matches); a subject with a
    date or id; a date and officer with an id or subject."""
    has = lambda c, f: (F.col(c) > 0) & F.lit(f not in rules.without)
    ids, dates, subjects, officers = has("n_t2_case_ids", "case_ids"), has("n_t2_dates", "dates"), has("n_t2_subjects", "subject_names"), has("n_t2_officers", "officer_names")
    near = within_days("a_t2_dates", "b_t2_dates", rules.days, rules.dates_required)
    first = ids & F.lit(rules.on("t2_case_id"))
    subject = subjects & (dates | ids) & F.lit(rules.on("t2_subject"))
    officer = dates & officers & (ids | subjects) & F.lit(rules.on("t2_date_officer"))
    return (
        F.when(first & near, "case_id_only").when(first, F.lit(None).cast("string")).when(subject & dates, "subject_name_and_date").when(subject, "subject_name_and_case_id")
        .when(officer & ids, "date_officer_and_case_id").when(officer, "date_officer_and_subject")
    )


def shares_directories(n: int = 2) -> Column:
    """Whether two paths have their first directories in common; a missing path is no bar."""
    begin = lambda s: F.slice(f"{s}_directories", 1, n)
    return F.col("a_path").isNull() | F.col("b_path").isNull() | ((F.size("a_directories") >= n) & (begin("a") == begin("b")))


def no_match():
    """Provider without a model: no pair matches, and no merge is approved."""
    return lambda prompt: "0.0"


#: The pair's summaries are ``$a`` and ``$b``; the answer has a score of 0, 0.5 or 1.
COMPARISON = "Score 1.0 if the two summaries tell of the same incident, 0.5 if they may, 0.0 if not.\n\n1: $a\n\n2: $b"
#: The files' common directory is ``$directory`` and their paths ``$paths``; the answer has 1 for yes.
APPROVAL = "Score 1.0 if all these files are of one incident, 0.0 if not.\n\nDirectory: $directory\n$paths"


def tier3_pairs(summaries: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Pairs ``a, b`` that share a type of summary whose vectors are of ``rules.similarity`` or more."""
    some = summaries.where(F.col("vector").isNotNull() & (F.trim(F.coalesce("summary", F.lit(""))) != ""))
    return cosine_edges(some, rules.similarity, "type").select(F.col("src").alias("a"), F.col("dst").alias("b")).distinct()


def tier3_edges(pairs: DataFrame, summaries: DataFrame, provider: completions.Provider = no_match, prompt: str = COMPARISON, **asked) -> DataFrame:
    """``src, dst`` of the pairs whose summaries a model scores 1; an error or another answer is no match."""
    each = F.concat(F.col("type"), F.lit(": "), F.col("summary"))
    whole = summaries.where(F.trim(F.coalesce("summary", F.lit(""))) != "").groupBy("id").agg(F.array_join(F.array_sort(F.collect_list(each)), "\n").alias("body"))
    rows = pairs.join(whole.select(F.col("id").alias("a"), F.col("body").alias("one")), "a").join(whole.select(F.col("id").alias("b"), F.col("body").alias("two")), "b")
    done = completions.complete(rows, render(prompt, a="one", b="two"), provider, valid=completions.verdict("answer").isNotNull(), **asked)
    return done.where(completions.verdict("answer") == 1).select(F.col("a").alias("src"), F.col("b").alias("dst"))


def match_edges(docs: DataFrame, rules: Rules = Rules(), summaries: DataFrame | None = None, provider: completions.Provider = no_match, prompt: str = COMPARISON, **asked) -> DataFrame:
    """``src, dst, tier, match_type`` of all pairs that a tier matches; a block in the first keeps the others away.

    The third tier, if it is among the rules' tiers, takes ``summaries`` (``id, type, summary, vector``, those that say
    something): pairs past its gate that the others leave open are put to ``provider``, offline to none.
    """
    third = 3 in rules.tiers and summaries is not None
    pairs = candidate_pairs(docs, rules).withColumn("gate", F.lit(False))
    if third:
        pairs = pairs.unionByName(tier3_pairs(summaries, rules).withColumn("gate", F.lit(True))).groupBy("a", "b").agg(F.max("gate").alias("gate"))
    rows = pair_features(pairs, docs)
    first = F.when(shares_directories(), tier1(rules)).otherwise("maybe") if 1 in rules.tiers else F.lit("maybe")
    second = tier2(rules) if 2 in rules.tiers else F.lit(None).cast("string")
    rows = rows.select("a", "b", "gate", first.alias("one"), second.alias("two"))
    if third:
        rows = written(rows, "tiers")
    hit = ~F.col("one").isin("maybe", "block")
    # The number keeps the filter above the rules, which it would repeat for each use of their results.
    once = rows.withColumn("__nr", F.monotonically_increasing_id())
    found = once.select("__nr", F.col("a").alias("src"), F.col("b").alias("dst"), F.when(hit, 1).when((F.col("one") == "maybe") & F.col("two").isNotNull(), 2).alias("tier"), F.when(hit, F.col("one")).otherwise(F.col("two")).alias("match_type"))
    found = found.where(F.col("tier").isNotNull() & (F.col("__nr") >= 0)).drop("__nr")
    if not third:
        return found
    left = rows.where((F.col("one") == "maybe") & F.col("two").isNull() & F.col("gate")).select("a", "b")
    return found.unionByName(tier3_edges(left, summaries, provider, prompt, **asked).select("src", "dst", F.lit(3).alias("tier"), F.lit("llm_summary_comparison").alias("match_type")))


def cluster(docs: DataFrame, rules: Rules = Rules(), edges: DataFrame | None = None) -> DataFrame:
    """``id, cluster``: components of the match graph, loose ones split (documents that share one id stay together)."""
    edges = written(match_edges(docs, rules) if edges is None else edges, "matches")  # read by the rounds, the density and the split
    members = graph.components(docs.select("id"), edges)
    keys = docs.select("id", F.array_union("t1_case_ids", "t2_case_ids").alias("keys"))
    return graph.split_components(members, edges, keys, rules.density)


def metadata_weight() -> Column:
    """1 for a shared id, or for two shared names at least; else 0."""
    return F.when((F.col("n_t1_case_ids") > 0) | (F.col("n_t1_names") >= 2), 1.0).otherwise(0.0)


def metadata_edges(docs: DataFrame) -> DataFrame:
    """Pairs of metadata weight 1: an id in common by one join, two names by counting the names in common."""
    ids = _shared(docs, "t1_case_ids")
    names = docs.select("id", F.explode(F.array_distinct("t1_names")).alias("name"))
    pairs = names.withColumnRenamed("id", "a").join(names.withColumnRenamed("id", "b"), "name").where("a < b").groupBy("a", "b").agg(F.count("*").alias("n")).where("n >= 2").select("a", "b")
    return ids.unionByName(pairs).distinct().select(F.col("a").alias("src"), F.col("b").alias("dst"))


def deterministic_clusters(docs: DataFrame) -> DataFrame:
    """Components by shared ids; then, of what is left alone, by shared pairs of date and name; ids are dense."""
    by_id = docs.select("id", F.explode("t1_case_ids").alias("k"))
    first = graph.components(docs.select("id"), graph.star_edges(by_id, "k"))
    alone = first.withColumn("n", F.count("*").over(W.partitionBy("component"))).where("n = 1").select("id")
    rest = docs.join(alone, "id", "left_semi").select("id", F.explode("t1_dates").alias("d"), "t1_names").select("id", "d", F.explode("t1_names").alias("p")).select("id", F.concat_ws("|", "d", "p").alias("k"))
    second = graph.components(alone, graph.star_edges(rest, "k")).withColumnRenamed("component", "again")
    return first.join(second, "id", "left").select("id", F.coalesce("again", "component").alias("cluster"))


#: Blocks that a group is dealt to, which is how often each vector is sent, until blocks would have more vectors than the second.
BLOCKS, LARGEST_BLOCK = 16, 65_536


def _block_pairs(rows: DataFrame, block: int) -> DataFrame:
    """Rows (``grp, id, vector``) once for each block of their group, with the pair ``p, q`` of blocks that meet there."""
    blocks = lambda n: F.ceil(F.count("*") / n)
    sizes = rows.groupBy("grp").agg(F.greatest(F.least(blocks(block), F.lit(BLOCKS)), blocks(LARGEST_BLOCK)).cast("int").alias("blocks"))
    dealt = rows.join(sizes, "grp").withColumn("nr", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    # Each vector meets each block of its group once: as many copies as there are blocks, not as vectors.
    return dealt.withColumn("with", other).select("grp", F.least("nr", "with").alias("p"), F.greatest("nr", "with").alias("q"), "nr", "id", "vector")


def cosine_edges(vectors: DataFrame, threshold: float, group: str | None = None, block: int = 2048) -> DataFrame:
    """``src, dst, similarity`` of vectors (``id, vector``) at that cosine or more, within each group.

    Vectors are dealt to numbered blocks of ``block`` or more, and each pair of blocks is a task's work, done as products
    of tiles of ``block`` vectors. A group has 16 blocks at most, larger ones as it grows, so what is sent grows as the
    input does; they are sent as they are and brought to length one where they meet. A missing vector has no edges.
    """
    rows = vectors.where(F.col("vector").isNotNull()).select("id", F.col(group).cast("string").alias("grp") if group else F.lit("").alias("grp"), "vector")
    tasks = _block_pairs(rows, block)

    def multiply(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(b["id"].to_numpy(), b["nr"].to_numpy(), b["vector"].flatten().to_numpy(zero_copy_only=False)) for b in batches]
        ids, nrs, flat = (np.concatenate(x) for x in zip(*got))
        x = flat.astype(np.float64).reshape(len(ids), -1)
        length = np.sqrt((x * x).sum(axis=1, keepdims=True))
        np.divide(x, length, out=x, where=length > 0)
        p, q = key[1].as_py(), key[2].as_py()
        left, right = np.flatnonzero(nrs == p), np.flatnonzero(nrs == q)
        for m in range(0, len(left), block):
            for n in range(m if p == q else 0, len(right), block):
                one, two = left[m : m + block], right[n : n + block]
                score = x[one] @ x[two].T
                i, j = np.nonzero(score >= threshold)
                a, b, s = ids[one[i]], ids[two[j]], score[i, j]
                keep = a < b if p == q and m == n else a != b
                yield pa.RecordBatch.from_pydict({"src": np.minimum(a, b)[keep], "dst": np.maximum(a, b)[keep], "similarity": s[keep]})

    return tasks.groupBy("grp", "p", "q").applyInArrow(multiply, "src long, dst long, similarity double")


def threshold_clusters(vectors: DataFrame, threshold: float, group: str | None = None) -> DataFrame:
    return graph.components(vectors.select("id"), cosine_edges(vectors, threshold, group))


def hybrid_edges(vectors: DataFrame, docs: DataFrame, threshold: float) -> DataFrame:
    """Cosine where both documents have a vector, metadata otherwise."""
    near = cosine_edges(vectors, threshold).select("src", "dst")
    have = vectors.select("id")
    meta = metadata_edges(docs)
    both = meta.join(have.withColumnRenamed("id", "src"), "src", "left_semi").join(have.withColumnRenamed("id", "dst"), "dst", "left_semi")
    return near.unionByName(meta.join(both, ["src", "dst"], "left_anti"))


def singleton_directories(clusters: DataFrame, docs: DataFrame, depth: int = 0) -> DataFrame:
    """Directories, so many levels up, with several clusters of one document: what an approver may merge."""
    from ..functions.text import directory_at

    alone = clusters.withColumn("n", F.count("*").over(W.partitionBy("cluster"))).where("n = 1").select("id")
    rows = docs.join(alone, "id", "left_semi").select("id", directory_at("path", depth).alias("directory"))
    return rows.groupBy("directory").agg(F.count("*").alias("n"), F.min("id").alias("first")).where("n > 1")


def singletons_merged(clusters: DataFrame, docs: DataFrame, depth: int = 0, provider: completions.Provider = no_match, prompt: str = APPROVAL, **asked) -> DataFrame:
    """``id, cluster``: clusters of one document in a directory, so many levels up, are one cluster if a model approves.

    Offline nothing is merged; the merged cluster is its least id.
    """
    from ..functions.text import directory_at

    alone = clusters.withColumn("n", F.count("*").over(W.partitionBy("cluster"))).where("n = 1").select("id")
    rows = docs.join(alone, "id", "left_semi").select("id", "path", directory_at("path", depth).alias("directory")).where(~F.coalesce("directory", F.lit("")).isin("", "."))
    groups = rows.groupBy("directory").agg(F.count("*").alias("n"), F.min("id").alias("merged"), F.array_join(F.array_sort(F.collect_list("path")), "\n").alias("paths")).where("n > 1")
    done = completions.complete(groups, render(prompt, directory="directory", paths="paths"), provider, valid=completions.verdict("answer").isNotNull(), **asked)
    yes = rows.join(done.where(completions.verdict("answer") == 1).select("directory", "merged"), "directory").select("id", "merged")
    return clusters.join(yes, "id", "left").select("id", F.coalesce("merged", "cluster").alias("cluster"))
