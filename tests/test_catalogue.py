import datetime as dt
import itertools
import math
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from docketlab.operators import clustering, legacy, linkage
from docketlab.plans import catalogue


def tables(spark, path, **given):
    """Folder with the given tables, each as (rows, schema)."""
    for name, (rows, schema) in given.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_components_take_every_shared_word(spark, tmp_path):
    rng = random.Random(3)
    words = [f"{'w' * 12}{k}" for k in range(30)]
    docs = [(i, " ".join(["short", *rng.sample(words[:15], 1), *rng.sample(words[15:], rng.randrange(2))])) for i in range(60)] + [(60, "nothing shared"), (61, "q" * 12)]
    root = {i: i for i, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by_word = defaultdict(list)
    for i, text in docs:
        for w in set(text.split(" ")):
            if len(w) >= 12:
                by_word[w].append(i)
    for ids in by_word.values():
        for i in ids:
            a, b = sorted((find(ids[0]), find(i)))
            root[b] = a
    assert max(map(len, by_word.values())) > 3
    d = tables(spark, tmp_path, documents=(docs, "doc_id long, text string"))
    assert {r.id: r.component for r in catalogue.components(spark, d).collect()} == {i: find(i) for i, _ in docs}


def test_name_net_takes_all_parts(spark, tmp_path):
    names = ["red ring", "red rim", "rex ring", "blue ring", "blue bolt", "RED ring", "green"]
    parts = [(i, names[i % len(names)]) for i in range(30)]
    want = set()
    for a, x in parts:
        for b, y in parts:
            (f, l), (g, m) = ((z.upper().split(" ") + [""])[:2] for z in (x, y))
            if a != b and (f[:2] == g[:2] and l == m or f == g and l[:2] == m[:2]):
                want.add((a, b))
    d = tables(spark, tmp_path, part=(parts, "p_partkey long, p_name string"))
    rows = [(r.a, r.b) for r in catalogue.name_net_join_whole(spark, d).collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want
    some = {(r.a, r.b) for r in catalogue.name_net_join(spark, d).collect()}
    assert some == {(a, b) for a, b in want if a % 7 == 0 and b % 7 == 1} != want


def test_term_weights_of_all_documents(spark, tmp_path):
    rng = random.Random(4)
    words = ["éclair", "straße", "ab", "a", "longerthantwelve", "Mixed", "x1", *(f"rare{k}" for k in range(50))]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 30)))) for i in range(40)] + [(40, None), (41, "")]
    tf, df = Counter(), Counter()
    for _, text in docs:
        found = re.findall(r"\b\w\w+\b", (text or "").lower())
        tf.update(found)
        df.update(set(found))
    d = tables(spark, tmp_path, documents=(docs, "doc_id long, text string"))
    got = {r.term: (r.tf, r.df, r.tfidf) for r in catalogue.tfidf_terms_of_documents(spark, d).collect()}
    assert {w: x[:2] for w, x in got.items()} == {w: (tf[w], df[w]) for w in tf}
    assert all(abs(x[2] - tf[w] * (math.log((1 + len(docs)) / (1 + df[w])) + 1)) < 1e-5 for w, x in got.items())


def test_every_branch_of_path_weights_is_run(spark, tmp_path):
    rng = random.Random(5)
    day = dt.datetime(2020, 1, 1)
    orders = [(k, rng.randrange(3), day + dt.timedelta(days=rng.randrange(400))) for k in [*range(60), 1001, 2001, 3001]]
    d = tables(spark, tmp_path, orders=(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp"), customer=([(k, f"Customer#{k}") for k in range(3)], "c_custkey long, c_name string"))
    got = {(r.src, r.dst): r.weight for r in catalogue.path_weight_edges(spark, d).collect()}
    want, kinds = {}, Counter()
    for (i, c, x), (j, e, y) in itertools.combinations(sorted(orders), 2):
        gap, same, p, q = abs((x - y).days), c == e, i % 4, j % 4
        alone = [k % 1000 == 1 for k in (i, j)]
        if p in (0, 3) and q in (0, 3):
            # A recording before a PDF is no mirror of the other order: only names within 90 days speak for it.
            w, kind = (1.0 if same and ((p, q) != (3, 0) or gap < 90) else 0.0), "id"
        elif p == q == 2:
            w, kind = (1.0 if same and gap < 90 else 0.0), "number"
        elif p == q == 1 and not any(alone):
            w, kind = (1.0 if same and gap < 90 else 0.5 * same + 0.5 * (1.0 if gap <= 30 else 0.7 if gap <= 60 else 0.5 if gap <= 90 else 0.0)), "name"
        elif p == q == 1:
            w, kind = (1.0 if gap <= 30 else 0.7 if gap <= 60 else 0.5 if gap <= 90 else 0.0), "date"
        else:
            continue
        if w > 0.5:
            want[i, j] = w
            kinds[kind] += 1
    assert got == want and set(kinds) == {"id", "number", "name", "date"}


def test_pairs_of_path_weights_are_all_met(spark):
    rng = random.Random(6)
    pick = lambda *x: rng.choice([None, *x])
    rows = [(i, rng.choice(["IA12.pdf", "IA13.mp3", "s.pdf", "s.pdf", "s", "s.mp3"]), rng.choice(["p", "p/IA12"]), pick("Ann Lee", "Bo Poe", "Ann Lee, Bo Poe"), pick(*(f"2020-0{m}-{x}" for m in range(1, 8) for x in ("01", "15", "30") if (m, x) != (2, "30"))), pick(None, "N1", "N2")) for i in range(150)]
    docs = spark.createDataFrame(rows, "id long, document_name string, gdrive_path string, name string, date string, case_numbers string")
    p = legacy.prepared(docs)
    side = lambda s: p.select(*[F.col(c).alias(s if c == "id" else f"{s}_{c}") for c in p.columns])
    every = side("a").crossJoin(side("b")).where("a < b").where(legacy.comparable()).withColumn("w", legacy.weight()).where("w > 0.5")
    want = {(r.a, r.b): r.w for r in every.collect()}
    assert {(r.src, r.dst): r.weight for r in legacy.edges(docs).collect()} == want and len(want) > 100


def test_prompts_hold_the_documents_text(spark, tmp_path):
    docs = [(1, "de", "web", "first text\nmore"), (2, "de", "web", "second text"), (3, "de", "web", None)]
    d = tables(spark, tmp_path, documents=(docs, "doc_id long, lang string, source string, text string"))
    asked = {r.doc_id: r.answer for r in catalogue.llm_distinct_map(spark, d).collect()}
    assert asked == {1: "Source web in de: first text", 2: "Source web in de: second text", 3: "Source web in de:"}


CASES = "id long, path string, t1_case_ids array<string>, t1_dates array<string>, t1_names array<string>, t2_case_ids array<string>, t2_dates array<string>, t2_subjects array<string>, t2_officers array<string>"


def test_third_tier_asks_about_what_the_others_leave(spark):
    ids = {1: ["X1"], 2: ["X1"], 3: [], 4: [], 5: ["Y1"], 6: ["Y2"], 7: [], 8: []}
    docs = spark.createDataFrame([(i, f"a/b/c/{i}/x.pdf", k, *([[]] * 6)) for i, k in ids.items()], CASES)
    near, far = [1.0, 0.0], [0.0, 1.0]
    summaries = [(i, "dates_summary", f"alike {i}", near) for i in range(1, 7)] + [(7, "subject_names_summary", "alike 7", near), (8, "dates_summary", "alike 8", far)]
    summaries = spark.createDataFrame(summaries, "id long, type string, summary string, vector array<double>")

    def model():
        def answer(prompt):
            if "alike 3" in prompt and "alike 4" in prompt:
                return '{"similarity": 1.0}'
            if "alike 5" in prompt and "alike 6" in prompt:
                raise AssertionError("blocked pairs are not asked about")
            return "no idea" if "alike 1" in prompt else "0.5"

        return answer

    rules = clustering.Rules(tiers=(1, 2, 3))
    found = lambda *a: {(r.src, r.dst, r.tier, r.match_type) for r in clustering.match_edges(docs, *a).collect()}
    first = (1, 2, 1, "case_id_only")
    assert found(rules, summaries, model) == {first, (3, 4, 3, "llm_summary_comparison")}
    assert found(rules, summaries) == found(rules) == found() == {first}
    yes = lambda: lambda prompt: "1.0"
    every = {(r[0], r[1]) for r in found(rules, summaries, yes)}
    assert every == {p for p in itertools.combinations(range(1, 7), 2)} - {(a, b) for a, b in itertools.combinations(range(1, 7), 2) if ids[a] and ids[b] and ids[a] != ids[b]}
    assert {r[:2] for r in found(clustering.Rules(tiers=(3,)), summaries, yes)} == set(itertools.combinations(range(1, 7), 2))


def test_singletons_are_merged_where_approved(spark):
    paths = {1: "a/b/1", 2: "a/b/2", 3: "a/c/3", 4: "a/c/4", 5: "a/c/5", 6: "6", 7: "7"}
    docs = spark.createDataFrame([(i, p, *([[]] * 7)) for i, p in paths.items()], CASES)
    clusters = spark.createDataFrame([(i, 4 if i == 5 else i) for i in paths], "id long, cluster long")
    model = lambda: lambda prompt: "1.0" if "a/b/1\na/b/2" in prompt else "0.0"
    merged = {r.id: r.cluster for r in clustering.singletons_merged(clusters, docs, provider=model).collect()}
    assert merged == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4, 6: 6, 7: 7}
    assert {r.id: r.cluster for r in clustering.singletons_merged(clusters, docs).collect()} == {r.id: r.cluster for r in clusters.collect()}


def test_frequent_names_are_dealt_to_blocks(spark, monkeypatch):
    monkeypatch.setattr(linkage, "NAME_BLOCK", 16)
    m = spark.createDataFrame([(i, "Ann" if i % 10 else "Anna", "Lee") for i in range(60)] + [(300, "Bo", "Poe"), (301, None, "Poe")], "mention_uid long, mention_first_name string, mention_last_name string")
    r = spark.createDataFrame([(i, "ann", "LEE") for i in range(40)] + [(200, "Bob", "Poe"), (201, "Bo", "Pond"), (202, None, "Poe"), (200, "Bob", "Poe")], "post_person_nbr long, post_first_name string, post_last_name string")
    found = linkage.name_net(m, r)
    got = Counter((x.mention_uid, x.post_person_nbr) for x in found.collect())
    assert got == Counter({(i, j): 1 for i in range(60) for j in range(40)}) + Counter({(300, 200): 2, (300, 201): 1})
    sizes = [x["count"] for x in found.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 0.6 * sum(sizes)  # two names, but no task has most of their pairs


def test_names_are_compared_once_and_parts_meet_in_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(linkage, "NAME_BLOCK", 8)
    names = ["red ring", "Red Ring", "red rim", "blue", None]
    parts = [(i, names[i % 5], "B1", i % 2) for i in range(60)] + [(60, "red ring", None, 1), (61, "red ring", "B2", 1)]
    d = tables(spark, tmp_path, part=(parts, "p_partkey long, p_name string, p_brand string, p_size int"))
    want = {(a, b): (x, y) for a, x, p, q in parts for b, y, u, v in parts if a < b and p == u == "B1" and q == v}
    asked = spark.sparkContext.accumulator(0)

    def measure(x):
        asked.add(x.count())
        return x.withColumn("similarity", F.struct("n", "m"))

    got = [((r.a, r.b), tuple(r.similarity)) for r in catalogue._name_pairs(spark, d, measure).collect()]
    low = lambda x: x and x.lower()
    assert len(got) == len(want) and dict(got) == {k: (low(x), low(y)) for k, (x, y) in want.items()}
    assert asked.value == 16  # four names, each with each: pairs of names, not of parts
    a, b = next((k for k, v in want.items() if v == ("red ring", "red rim")))
    assert {(r.a, r.b): r.similarity for r in catalogue.levenshtein_sim(spark, d).collect()}[a, b] == 0.75


def test_names_meet_whatever_their_brand_and_size(spark, tmp_path):
    parts = [(1, "red ring", "B1", 1), (2, "Red Ring", "B2", 1), (3, "red rim", "B1", 2), (4, None, "B3", 3), (5, "red rim", None, None)]
    d = tables(spark, tmp_path, part=(parts, "p_partkey long, p_name string, p_brand string, p_size int"))
    got = {(r.a, r.b): r.similarity for r in catalogue.levenshtein_sim_whole(spark, d).collect()}
    assert got == {(1, 2): 1.0, (3, 5): 1.0, (1, 3): 0.75, (1, 4): 1.0, (3, 4): 1.0}


def test_stint_join_takes_more_tasks_for_more_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(linkage, "ROWS_PER_TASK", 5)
    day = lambda n: dt.datetime(1995, 1, 1) + dt.timedelta(days=n)
    orders = [(k, day(k)) for k in range(40)]
    lines = [(k, k % 3, day(k + 10 * j)) for k in range(40) for j in range(3)]
    d = tables(spark, tmp_path, orders=(orders, "o_orderkey long, o_orderdate timestamp"), lineitem=(lines, "l_orderkey long, l_suppkey long, l_shipdate timestamp"))
    found = catalogue.range_stint_join(spark, d)
    first = {s: min(x for _, t, x in lines if t == s) for s in range(3)}
    assert sorted(map(tuple, found.collect())) == [(k, k % 3) for k, x in orders if first[k % 3] <= x]
    assert found.rdd.getNumPartitions() == 24  # 120 lines, 5 a task


def test_pairs_by_days_alone_take_no_features(spark, monkeypatch):
    monkeypatch.setattr(legacy, "weight", lambda: F.lit(0.0))
    days = [("Ann Lee", "2020-01-01"), (None, "2020-01-20"), (None, "2020-02-25"), (None, "2020-05-01"), (None, None)]
    docs = spark.createDataFrame([(k, "s.pdf", "p", name, day, None) for k, (name, day) in enumerate(days)], "id long, document_name string, gdrive_path string, name string, date string, case_numbers string")
    got = [(r.src, r.dst, r.weight) for r in legacy.edges(docs).collect()]
    assert sorted(got) == [(0, 1, 1.0), (0, 2, 0.7), (1, 2, 0.7)]
