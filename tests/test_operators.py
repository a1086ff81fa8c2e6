import datetime as dt
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketlab.operators import cases, clustering, graph, learning, linkage, metrics, segmentation
from docketlab.plans import completions
from docketlab.sources import tables
from docketlab.streaming import pages as streams


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_set_and_binary_measures(spark):
    s = lambda x: spark.createDataFrame([(v,) for v in x], "k string")
    assert rows(metrics.set_prf(s("abx"), s("abc"), "k"))[0] == (2, 1, 1, pytest.approx(2 / 3), pytest.approx(2 / 3), pytest.approx(2 / 3))
    assert rows(metrics.set_prf(s(""), s(""), "k")) == [(0, 0, 0, 0.0, 0.0, 0.0)]
    b = spark.createDataFrame([(True, True), (False, True), (False, False), (True, False)], "p boolean, g boolean")
    assert rows(metrics.binary_prf(b, F.col("p"), F.col("g"))) == [(1, 1, 1, 1, 0.5, 0.5, 0.5, 0.5)]
    c = spark.createDataFrame([("a", "a"), ("b", "a"), ("b", "b")], "gold string, pred string")
    assert rows(metrics.confusion(c, "gold", "pred")) == [("a", "a", 1), ("b", "a", 1), ("b", "b", 1)]


def ari(a, b):
    pairs = list(itertools.combinations(range(len(a)), 2))
    same = lambda x: [x[i] == x[j] for i, j in pairs]
    s, t, both = sum(same(a)), sum(same(b)), sum(p and q for p, q in zip(same(a), same(b)))
    expected = s * t / len(pairs)
    return (both - expected) / ((s + t) / 2 - expected) if (s + t) / 2 != expected else 1.0


def test_cluster_measures(spark):
    rng = random.Random(2)
    a, b = [rng.randrange(4) for _ in range(40)], [rng.randrange(5) for _ in range(40)]
    truth = spark.createDataFrame(list(enumerate(map(str, a))), "id int, gt string")
    test = spark.createDataFrame(list(enumerate(map(str, b))), "id int, cluster string")
    assert metrics.adjusted_rand(truth, test).first()[0] == pytest.approx(ari(a, b))
    p = sum(sum(a[i] == a[j] for j in range(40) if b[j] == b[i]) / b.count(b[i]) for i in range(40)) / 40
    assert metrics.bcubed(truth, test).first()["precision"] == pytest.approx(p)
    same = metrics.adjusted_rand(truth, truth.withColumnRenamed("gt", "cluster")).first()[0]
    assert same == pytest.approx(1.0) and metrics.adjusted_rand(truth.limit(1), test).first()[0] == 0.0
    best = metrics.best_match(truth, truth.withColumnRenamed("gt", "cluster"))
    assert metrics.best_match_summary(best).first()["f1"] == 1.0 and metrics.quality_bands(best).first()["perfect"] == 4


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    n, edges = 60, [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(k, k + 1) for k in range(60, 90)]
    label = list(range(91))
    for _ in label:
        for u, v in edges:
            label[u] = label[v] = min(label[u], label[v])
    v = spark.createDataFrame([(i,) for i in range(91)], "id long")
    got = graph.components(v, spark.createDataFrame(edges, "src long, dst long"))
    assert {r.id: r.component for r in got.collect()} == dict(enumerate(label))
    pairs = spark.createDataFrame(edges, "u long, v long")
    by_rounds, at_once = ({r.node: r.root for r in graph.star_components(pairs, per_task=k).collect()} for k in (20, 1000))
    assert by_rounds == at_once == {i: label[i] for i in {x for u, v in edges if u != v for x in (u, v)}}


def test_density_and_split(spark):
    # Two dense groups on a chain: 1-4 and 6-9, with 5 between.
    edges = [*itertools.combinations(range(1, 5), 2), (4, 5), (5, 6), *itertools.combinations(range(6, 10), 2)]
    e = spark.createDataFrame(edges, "src long, dst long")
    m = spark.createDataFrame([(i, 1) for i in range(1, 10)], "id long, component long")
    d = graph.density(m, e).first()
    assert (d.size, d.valid) == (9, False) and d.least == pytest.approx(2 / 8)
    got = {r.id: r.cluster for r in graph.split_components(m, e).collect()}
    assert {got[i] for i in range(1, 5)} == {1} and got[5] == 5 and {got[i] for i in range(6, 10)} == {6}
    keys = spark.createDataFrame([(i, ["X"]) for i in range(1, 10)], "id long, keys array<string>")
    assert {r.cluster for r in graph.split_components(m, e, keys).collect()} == {1}
    assert len({r.cluster for r in graph.split_components(m, e, threshold=0.5, grow=True).collect()}) >= 2


def features(i, path="", ids=(), dates=(), names=(), ids2=(), dates2=(), subjects=(), officers=()):
    return (i, path, *map(list, (ids, dates, names, ids2, dates2, subjects, officers)))


DOCS = "id long, path string, t1_case_ids array<string>, t1_dates array<string>, t1_names array<string>, t2_case_ids array<string>, t2_dates array<string>, t2_subjects array<string>, t2_officers array<string>"


@pytest.mark.parametrize(
    "a,b,want",
    [
        (dict(ids=["X1"]), dict(ids=["X1"]), (1, "case_id_only")),
        (dict(ids=["X1"]), dict(ids=["X2"]), None),
        (dict(path="a/b/c/d/1"), dict(path="a/b/c/d/2"), (1, "exact_dir_match")),
        (dict(path="a/b/c/d/1", ids=["X1"]), dict(path="a/b/c/d/2", ids=["X2"]), None),
        (dict(names=["john smith"], dates=["2020-01-01"]), dict(names=["john smith"], dates=["2020-01-01"]), (1, "name_and_date")),
        (dict(names=["smith"], dates=["2020-01-01"]), dict(names=["smith"], dates=["2020-01-01"]), None),
        (dict(ids2=["Y"], dates2=["2020-01-01"]), dict(ids2=["Y"], dates2=["2020-06-01"]), (2, "case_id_only")),
        (dict(ids2=["Y"], dates2=["2020-01-01"], subjects=["s"]), dict(ids2=["Y"], dates2=["2023-06-01"], subjects=["s"]), None),
        (dict(dates2=["2020-01-01"], subjects=["s"]), dict(dates2=["2020-01-01"], subjects=["s"]), (2, "subject_name_and_date")),
        (dict(dates2=["2020-01-01"], officers=["o"]), dict(dates2=["2020-01-01"], officers=["o"]), None),
        (dict(ids=["X1"], dates2=["2020-01-01"], subjects=["s"]), dict(ids=["X2"], dates2=["2020-01-01"], subjects=["s"]), None),
    ],
)
def test_pair_rules(spark, a, b, want):
    docs = spark.createDataFrame([features(1, **{"path": "r/s/1", **a}), features(2, **{"path": "r/s/2", **b})], DOCS)
    got = [(r.tier, r.match_type) for r in clustering.match_edges(docs).collect()]
    assert got == ([want] if want else [])


def test_cosine_edges_match_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.normal(size=(70, 5))
    x[3] = 0
    df = spark.createDataFrame([(i, v.tolist(), "ab"[i % 2]) for i, v in enumerate(x)], "id long, vector array<double>, g string")
    n = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    for group in (None, "g"):
        want = {(i, j) for i, j in itertools.combinations(range(70), 2) if n[i] @ n[j] >= 0.7 and (group is None or i % 2 == j % 2)}
        assert {(r.src, r.dst) for r in clustering.cosine_edges(df, 0.7, group, block=16).collect()} == want


MENTION = "mention_uid string, mention_first_name string, mention_middle_name string, mention_last_name string, mention_suffix string, state string, incident_year int, mention_agency_type string, mention_agency string, mentioned_agencies string"
STINT = "post_person_nbr string, post_first_name string, post_middle_name string, post_last_name string, post_suffix string, post_start_date date, post_end_date date, post_agency_type string, post_agency_name string, state string, county string"


def stint(nr, first, last, agency="City PD", start=2010, end=None, state="CA"):
    return (nr, first, None, last, None, dt.date(start, 1, 1), dt.date(end, 1, 1) if end else None, "POLICE", agency, state, None)


def test_resolution(spark):
    who = lambda uid, f, l, agency="City PD", state="CA": (uid, f, None, l, None, state, 2015, "POLICE", agency, None)
    m = spark.createDataFrame([who("a", "ANN", "LEE"), who("b", "BO", "SMITH"), who("c", "CY", "POE", "Other PD"), who("d", "DI", "ROE"), who("e", "AB", "NONE"), who("f", "ANN", "LEE", state=None), who("g", "GUS", "OLD"), who("h", "HAL", "FOX", "County Coroner")], MENTION)
    r = spark.createDataFrame([stint("1", "Ann", "Lee"), stint("2", "Bo", "Smith"), stint("3", "Cy", "Poe"), stint("4", "Di", "Roe"), stint("5", "Di", "Roe"), stint("6", "Gus", "Old", start=1990, end=2000), stint("7", "Hal", "Fox", "County Sheriff")], STINT)
    common = spark.createDataFrame([("smith",)], "last_name string")
    got = {x.mention_uid: x for x in linkage.resolve(m, r, common, F.lit("2020-01-01").cast("date")).collect()}
    assert (got["a"].status, got["a"].post_person_nbr) == ("auto_matched", "1") and got["a"].match_probability == 1.0
    assert all(got[k].status == "review" for k in "bcdefgh")
    assert got["b"].gates[-1].status == "flag" and len(got["b"].gates) == 2 and got["h"].reason == "Source agency is not law enforcement"
    assert got["c"].reason == "Agency cannot be validated" and got["d"].reason.startswith("Several persons of") and got["g"].reason == "No candidates found" and got["f"].reason.startswith("No state")
    gold = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "")], "mention_uid string, post_person_nbr string")
    assert rows(linkage.link_prf(linkage.resolve(m, r, common, F.lit("2020-01-01").cast("date")), gold))[0][:3] == (1, 0, 1)


def test_alike_mentions_and_registry_rows_are_resolved_as_one(spark):
    rng = random.Random(8)
    name = lambda: (rng.choice(["ann", "Ann", "anna", "bo", ""]), rng.choice(["lee", "leo", "Lee", None]))
    mentions = [(f"m{k}", f, None, l, None, rng.choice(["CA", "NY"]), 2015, "POLICE", rng.choice(["City PD", "Other PD"]), None) for k in range(150) for f, l in [name()]] + [("m3", "bo", None, "lee", None, "CA", 2015, "POLICE", "City PD", None)]
    stints = [stint(str(rng.randrange(40)), *name(), rng.choice(["City PD", "Town PD"]), start=rng.choice([1990, 2010]), end=rng.choice([2000, None])) for _ in range(60)] + [stint("90", "cy", "poe"), stint("91", "cy", "poe"), stint("90", "cy", "poe", "Town PD")]
    mentions += [("x", "cy", None, "poe", None, "TX", 2015, "POLICE", "City PD", None), ("y", "cy", None, "poe", None, "TX", 2015, "POLICE", "City PD", None)]
    m, r = spark.createDataFrame(mentions, MENTION), spark.createDataFrame(stints, STINT)
    day, none = F.lit("2020-01-01").cast("date"), spark.createDataFrame([], "last_name string")
    every = linkage.name_score(linkage.candidates(m, r.withColumnRenamed("state", "post_state"), day))
    good = every.where("match_probability > 0.5").where(linkage.exact_name())
    n_all, n_good = ({x.mention_uid: x["count"] for x in df.groupBy("mention_uid").count().collect()} for df in (every, good))
    persons = {x.mention_uid: x.n for x in good.groupBy("mention_uid").agg(F.count_distinct("post_person_nbr").alias("n")).collect()}
    joined = m.join(r.select(F.col("state").alias("s"), "post_first_name", "post_last_name", "post_person_nbr"), linkage.exact_name() & (F.col("state") == F.col("s")))
    same = {x.mention_uid: x.n for x in joined.groupBy("mention_uid").agg(F.count_distinct("post_person_nbr").alias("n")).collect()}
    likeliest = {x.mention_uid: x.post_person_nbr for x in linkage.best_rows(good).collect()}
    got = {x.mention_uid: x for x in linkage.resolve(m, r, none, day).collect()}
    assert set(got) == {x[0] for x in mentions} and persons["x"] == 2
    for uid, x in got.items():
        found = {g["name"]: g["detail"] for g in x.gates}
        if "Exact-name match" in found:
            assert [found[k] for k in ("Candidates found", "Exact-name match", "Not ambiguous")] == [str(c.get(uid, 0)) for c in (n_all, n_good, persons)]
        assert x.post_person_nbr is None or x.post_person_nbr == likeliest[uid]
    counted = {x.mention_uid: x.same_name for x in linkage.same_name_persons(m.where("mention_first_name <> '' AND mention_last_name IS NOT NULL"), r).collect()}
    assert all(n == same.get(uid, 0) for uid, n in counted.items()) and len({x.ambiguous for x in got.values()}) == 2
    # Mentions that are alike are compared once: as many rows of kinds as for one of them.
    once = lambda ms: linkage._candidate_kinds(linkage._stand_ins(ms), linkage._kinds(r.withColumnRenamed("state", "post_state"))[0], r, day).count()
    assert once(m.where("mention_uid IN ('x', 'y')")) == once(m.where("mention_uid = 'x'")) == 2


def test_case_records(spark):
    c = spark.createDataFrame([("Case 1",), ("case2",)], "k string")
    d = spark.createDataFrame([("CASE1", 2, "b", None), ("case 1", 1, "a", "t"), ("case1", 3, None, "u")], "k string, o int, s string, t string")
    assert rows(cases.case_records(c, d, "k", "o", "s", "t")) == [("case1", ["a", "b"], ["t", "u"]), ("case2", ["No summary"], [])]
    assert rows(cases.case_records(c, d, "k", "o", "s", "t", keep_null=True))[0][1] == ["a", "b", "No summary"]


def test_segments(spark):
    p = spark.createDataFrame([("d", 1, True), ("d", 2, True), ("d", 3, False), ("d", 4, None)], "doc string, page int, c boolean")
    s = segmentation.segments(p, "doc", "page", F.col("c"))
    assert [r.is_start for r in s.orderBy("page").collect()] == [1, 0, 1, 1]
    assert rows(segmentation.contents(s, "doc", "page")) == [("d", 1, 1, 2, 2), ("d", 2, 3, 3, 1), ("d", 3, 4, 4, 1)]


def test_page_fold_batch_and_stream_agree(spark, tmp_path):
    body = "x" * 200
    data = [("d", k, ("NEW TITLE\n" if k % 3 == 1 else "goes on\n") + body) for k in range(1, 8)] + [("short", 1, "tiny")]
    df = spark.createDataFrame(data, "doc string, page long, text string")
    batch = rows(segmentation.fold_pages(df, "doc", "page", "text"))
    assert [r[3] for r in batch] == [False, True, True, False, True, True, False]
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    df.where("doc = 'd'").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = streams.fold_page_stream(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
    q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == batch


def test_resumable_run_and_sources(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    for k in range(2):
        spark.createDataFrame([(k, "x")], "id long, t string").write.mode("append").parquet(src)
        streams.run_resumable(spark.readStream.schema("id long, t string").parquet(src), lambda b: b, out, str(tmp_path / "cp")).awaitTermination(120)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [0, 1]
    df = spark.createDataFrame([(1, "é"), (2, None)], "id long, t string")
    assert tables.write_records(df, str(tmp_path / "r.jsonl")).first().n == 2
    assert rows(tables.read_table(spark, str(tmp_path / "r.jsonl"), "id long, t string")) == rows(df)
    tables.write_csv(df, str(tmp_path / "c.csv"))
    assert tables.read_table(spark, str(tmp_path / "c.csv")).count() == 2
    assert rows(tables.resume(df, str(tmp_path / "none"), "id")) == rows(df) and [r.id for r in tables.resume(df, out, "id").collect()] == [2]


def test_bundles(spark, tmp_path):
    import json

    page = lambda n, t: {"page_number": n, "text": t}
    case = {"case_name": "C", "case_files": [{"file_name": "f", "sha1": "s", "page_range": {"gdrive_id": "g"}, "ocr_doc_text_per_page": {"page_texts": [page(1, "hello"), page(2, "  "), page(3, None)]}}]}
    (tmp_path / "agency_case_file_bundle-1.json").write_text(json.dumps(case))
    got = tables.bundle_pages(tables.read_bundles(spark, str(tmp_path / "*.json")))
    assert rows(got) == [("C", "f", "s", "g", 1, "hello")]


def failing():
    def answer(prompt):
        raise ValueError("no such model")

    return answer


def test_completions_are_asked_once_and_cached(spark):
    df = spark.createDataFrame([(1, "p"), (2, "p"), (3, "q")], "id long, text string")
    got = completions.complete(df, F.col("text"))
    assert rows(got.select("id", "answer", "answer_error")) == [(1, "p", None), (2, "p", None), (3, "q", None)]
    bad = completions.complete(df, F.col("text"), failing)
    assert all(r.answer is None and "no such model" in r.answer_error for r in bad.collect())
    from docketlab.functions.text import prompt_key

    cache = df.where("id = 3").select(prompt_key(F.lit("offline").alias("model"), F.col("text").alias("prompt")).alias("key"), F.lit("cached").alias("answer"))
    assert {r.id: r.answer for r in completions.complete(df, F.col("text"), cache=cache).collect()} == {1: "p", 2: "p", 3: "cached"}
    tries = []

    def flaky(prompt):
        tries.append(prompt)
        if len(tries) < 3:
            raise RuntimeError("rate limit")
        return "ok"

    assert completions.call(flaky, "x", completions.Retry(first_wait=0.0)) == ("ok", None) and len(tries) == 3


def test_summary_filter_and_tree(spark):
    df = spark.createDataFrame([("k", i, f"s{i}") for i in range(10)] + [("m", 0, "only")], "key string, nr int, s string")
    assert rows(completions.filtered_summaries(df, "key", "nr", "s", 3).groupBy("key").count()) == [("k", 2), ("m", 1)]
    got = completions.tree_combined(df, "key", "nr", "s", lambda a, b: F.concat(a, b))
    assert rows(got) == [("k", "".join(f"s{i}" for i in range(10))), ("m", "only")]


def test_training_and_samples(spark):
    rng = random.Random(1)
    data = [(i, float(i % 2), i % 2 + rng.random() * 0.5, None if i % 9 == 0 else rng.random()) for i in range(120)]
    df = spark.createDataFrame(data, "id long, label double, a_jaro double, b_jaro double")
    best, model, accuracy = learning.train(df, learning.feature_columns(df), names=("logistic",), folds=2)
    p = {r.id: r.match_probability for r in learning.scored(df, model).collect()}
    assert best == "logistic" and accuracy["logistic"] > 0.9 and sum((p[i] > 0.5) == (i % 2 == 1) for i in p) > 110
    parts = {r.part: r["count"] for r in df.withColumn("part", learning.split_of("id", {"train": 0.7, "valid": 0.2, "test": 0.1})).groupBy("part").count().collect()}
    assert set(parts) == {"train", "valid", "test"} and parts["train"] > parts["valid"] > 0
    docs = spark.createDataFrame([(i, i % 4 == 0, 3) for i in range(40)], "id long, y boolean, n int")
    kept = {r.y: r.s for r in learning.balanced_by_pages(docs, "y", "n").groupBy("y").agg(F.sum("n").alias("s")).collect()}
    assert kept == {True: 30, False: 30}


PATHS = "id long, document_name string, gdrive_path string, name string, date string, case_numbers string"


@pytest.mark.parametrize(
    "a,b,want",
    [
        (("IAD-552.pdf", "p", None, None, None), ("IAD-552.pdf", "p", None, None, None), 1.0),
        (("IAD-552.pdf", "p", None, None, None), ("IAD-553.pdf", "p", None, None, None), None),
        (("a.pdf", "p", "Ann Lee", "2020-01-01", None), ("b.pdf", "p", "Ann Lee", "2020-01-20", None), 1.0),
        (("a.pdf", "p", "Ann Lee", "2020-01-01", None), ("b.pdf", "p", "Bo Poe", "2020-01-20", None), None),
        (("a.pdf", "p", None, "2020-01-01", None), ("b.pdf", "p", None, "2020-02-20", None), 0.7),
        (("a.pdf", "p", None, "2020-01-01", "N1"), ("b.pdf", "p", None, "2020-02-01", "N1"), 1.0),
        (("IA12.mp3", "p", None, None, None), ("IA12.wav", "p", None, None, None), 1.0),
    ],
)
def test_path_weights(spark, a, b, want):
    from docketlab.operators import legacy

    got = [r.weight for r in legacy.edges(spark.createDataFrame([(1, *a), (2, *b)], PATHS)).collect()]
    assert got == ([want] if want else [])


def test_persons_and_pair_features(spark):
    from docketlab.operators import legacy

    row = lambda n, p, c: ("case", n, ["witness"], p, f"d{p}", c, "")
    df = spark.createDataFrame([row("Smith, John", 1, "low"), row("john smith", 2, "high"), row("Mary Roe", 3, "medium")], "k string, name string, person_type array<string>, page_number int, document_name string, confidence string, address string")
    got = sorted((r.original_count, r.page_number, r.confidence) for r in legacy.merged_persons(df, "k").collect())
    assert got == [(1, [3], "medium"), (2, [1, 2], "high")]
    docs = spark.createDataFrame([features(1, path="a/b/c/d/x", names=["john smith"], dates=["2020-01-01"]), features(2, path="a/b/c/d/y", names=["john smith"], dates=["2020-01-31"])], DOCS)
    pairs = clustering.pair_features(clustering.candidate_pairs(docs, clustering.Rules()), docs)
    f = legacy.model_features(pairs).first()
    assert (f.tier1_min_date_diff_days, f.tier2_min_date_diff_days, f.combined_min_date_diff_days) == (30, None, 30)
    assert f.exact_dir_match and f.shared_3plus_dirs and f.tier1_has_full_name_match and not f.tier1_name_and_date
    assert "any_date_match" not in legacy.tier_features(["tier1_x", "any_date_match", "tier2_y"], (1,))


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_keys_of_all_rules_meet_in_one_join(spark):
    same = dict(path="a/b/c/d/1", ids=["X"], names=["ann lee"], dates=["2020-01-01"], ids2=["Y"], dates2=["2020-01-01"], subjects=["s"], officers=["o"])
    only = [dict(ids=["X"]), dict(path="a/b/c/d/2"), dict(names=["ann lee"], dates=["2020-01-01", None]), dict(ids2=["Y", "Y"]), dict(subjects=["s"], dates2=["2020-01-01"]), dict(officers=["o"], dates2=["2020-01-01"]), dict(path="a/b/c/1"), dict(path="a/b/c/2", names=["ann lee"])]
    docs = spark.createDataFrame([features(1, **same), *[features(k, **x) for k, x in enumerate(only, 2)], (10, None, None, *[[]] * 6)], DOCS)
    pairs = clustering.candidate_pairs(docs, clustering.Rules())
    assert rows(pairs) == [(1, k) for k in range(2, 8)]
    assert plan(pairs).count("Join Inner") == 1


def test_split_takes_components_that_batches_break(spark):
    links = [(10 * k + i, 10 * k + i + 1) for k in range(8) for i in range(5)]
    e = spark.createDataFrame(links, "src long, dst long")
    m = spark.createDataFrame([(10 * k + i, 10 * k) for k in range(8) for i in range(6)] + [(100, 100)], "id long, component long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        split = graph.split_components(m, e)
        got = {r.id: r.cluster for r in split.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {min(p): p for k in range(8) for p in graph.split_members(list(range(10 * k, 10 * k + 6)), {v: {w for x in links for w in x if v in x and w != v} for v in range(10 * k, 10 * k + 6)}, {}, 0.3)}
    assert got == {v: c for c, p in want.items() for v in p} | {100: 100}
    assert "FlatMapGroups" not in plan(split)  # no call for each component


def test_component_rounds_end_when_forests_settle(spark, monkeypatch):
    written, names = graph.written, []
    monkeypatch.setattr(graph, "written", lambda df, name: names.append(name) or written(df, name))
    links = [(10 * k + i, 10 * k + i + 1) for k in range(30) for i in range(5)]
    got = {r.node: r.root for r in graph.star_components(spark.createDataFrame(links, "u long, v long"), per_task=50).collect()}
    assert got == {10 * k + i: 10 * k for k in range(30) for i in range(6)}
    assert names.count("forest") <= 2  # near ids are dealt together, and no round is spent on seeing that nothing changes
    u, v = np.array([5, 5, 5, 3, 8]), np.array([0, 1, 2, 4, 3])
    assert graph.least_reached(u, v, 9).tolist() == [0, 0, 0, 3, 3, 0, 6, 7, 3]


def test_vectors_are_sent_to_sixteen_blocks_at_most(spark):
    x = np.random.default_rng(2).normal(size=(200, 3)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(900, None)], "id long, vector array<float>")
    n = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    found = clustering.cosine_edges(df, 0.8, block=4)  # 50 blocks of 4, or 16 blocks
    assert {(r.src, r.dst) for r in found.collect()} == {(i, j) for i, j in itertools.combinations(range(200), 2) if n[i] @ n[j] >= 0.8}
    assert found.count() == len({(r.src, r.dst) for r in found.collect()})
    sent = clustering._block_pairs(df.where("id < 200").withColumn("grp", F.lit("")), 4)
    assert sent.count() == 200 * 16 and dict(sent.dtypes)["vector"] == "array<float>"
