import random

import numpy as np
import pytest

from docketlab.llm import toxicity as T

DOC, LABEL = "doc_id long, text string", "doc_id long, quality int, toxic int"


def random_index(rng, n=300, m=40):
    vectors = []
    for _ in range(n):
        at = np.array(sorted({min(m - 1, int(rng.expovariate(4 / m))) for _ in range(rng.randrange(1, 9))}))
        w = np.array([rng.choice([0.5, 1.0, 2.0]) for _ in at])
        vectors.append((at, w / np.sqrt((w * w).sum())))
    ids = rng.sample(range(10 * n), n)
    return T.build(vectors, ids, [rng.randrange(2) for _ in range(n)], {str(k): k for k in range(m)}, np.ones(m)), vectors


@pytest.mark.parametrize("n, m", [(300, 40), (3000, 400), (5, 3), (64, 2)])
def test_nearest_is_exact(n, m):
    rng = random.Random(n)
    index, vectors = random_index(rng, n, m)
    dense = np.zeros((n, m))
    for i, (at, w) in enumerate(vectors):
        dense[i, at] = w
    for q in range(min(n, 80)):
        at, w = vectors[q]
        cosine = dense @ dense[q]
        cosine[q] = -1
        best, value = T.nearest(index, at, w, skip=q)
        order = sorted((i for i in range(n) if cosine[i] > T.TIE), key=lambda i: (-round(cosine[i], 5), index.ids[i]))[: T.NEIGHBOURS]
        assert np.allclose(value, cosine[order], atol=1e-5) and np.allclose(value, cosine[best], atol=1e-5)
        assert best.tolist() == order  # ties are few values here: the least ids win, in whatever block they are
    assert len(T.nearest(index, np.zeros(0, np.int64), np.zeros(0))[0]) == 0


def test_blocks_that_cannot_matter_are_left_out():
    rng = random.Random(4)
    vectors = [(np.array(sorted(rng.sample(range(20 * (i // 640), 20 * (i // 640) + 20), 6))), np.full(6, 6**-0.5)) for i in range(6400)]
    index = T.build(vectors, range(6400), [0] * 6400, {str(k): k for k in range(200)}, np.ones(200))
    assert (index.row >= 0).all() or (index.row < 0).any()
    best, _ = T.nearest(index, *vectors[3], skip=3)
    assert set(best.tolist()) <= set(range(640))


def test_calibration_is_monotone_and_pooled():
    steps, scores = T.calibrate(np.array([0.1, 0.5, 0.5, 0.9, 1.0]), np.array([0, 1, 0, 0, 1]), np.ones(5))
    assert (np.diff(scores) >= 0).all() and (np.diff(steps) >= 0).all() and len(steps) == len(scores) and steps[0] == 0.1 and steps[-1] == 1


def corpus(n=400, seed=3):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefgh", k=rng.randrange(2, 8))) for _ in range(300)]
    bad = ["zornig", "zornlich", "wutwort", "schimpf"]
    docs, labels = [], []
    for i in range(n):
        toxic = i % 5 < 2
        w = rng.choices(words, k=60)
        for _ in range(3 if toxic else 0):
            w[rng.randrange(60)] = rng.choice(bad)
        docs.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_held_out_documents_and_odd_rows(spark):
    docs, labels = corpus()
    odd = [(900, None), (901, ""), (902, "WUTWORT"), (902, "WUTWORT"), (None, "schimpf"), (903, "plain " * 50_000)]
    d = spark.createDataFrame([(a, b, 1.0, "x") for a, b in docs + odd], DOC + ", score double, h string")
    marks = spark.createDataFrame(labels + [(1, 1, None), (None, 1, 1), (5_000, 0, 1)], LABEL)
    rows = T.assess(d, marks).collect()
    assert len(rows) == len(docs) + len(odd)
    score = {r.doc_id: r.score for r in rows}
    assert all((score[i] >= 0.5) == (t == 1) for i, _, t in labels)
    assert score[900] == score[901] == score[903] < 0.5 < score[902] and score[None] > 0.5
    assert all(0 <= r.score <= 1 for r in rows) and all(len(r.evidence) <= T.NEIGHBOURS for r in rows)
    kept = T.drop_toxic(d, marks)
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} == {i for i, _, t in labels if not t} | {900, 901, 903}


def test_empty_tables(spark):
    docs, labels = corpus(20)
    d, marks = spark.createDataFrame(docs, DOC), spark.createDataFrame(labels, LABEL)
    assert T.assess(d.limit(0), marks).collect() == []
    assert {r.score for r in T.assess(d, marks.limit(0)).collect()} == {0.5}


def test_a_common_passage_makes_no_copies(spark):
    rng = random.Random(8)
    passage = " ".join(f"pass{k}" for k in range(80))
    docs, labels = [], []
    for i in range(160):
        own = [f"own{rng.randrange(400)}" for _ in range(20)]
        docs.append((i, " ".join([*own, passage, *(["wutwort"] if i % 16 == 0 else [])])))
        labels.append((i, 1, int(i % 16 == 0)))
    copy = " ".join(f"copied{k}" for k in range(60))
    for i in range(160, 200):
        docs.append((i, f"{copy} end{i}"))
        labels.append((i, 1, 1))
    model = T.train(spark.createDataFrame(docs, DOC), spark.createDataFrame(labels, LABEL))
    factor = {t: model.index.factor[k] for t, k in model.index.vocabulary.items()}
    assert {t for d, x in docs for t in T.terms(x)} == set(factor)  # no word is left out
    assert factor["wutw"] > 5 * max(f for t, f in factor.items() if t.startswith("copi"))


def test_repeated_ids_and_texts_without_toxic_words(spark):
    docs, labels = corpus()
    d = spark.createDataFrame(docs + [(i, "another text of the same id") for i, _ in docs[:50]] + docs[:20], DOC)
    model = T.train(d, spark.createDataFrame(labels + labels, LABEL))
    assert len(model.index.ids) == len(set(model.index.ids.tolist())) == len(docs)
    found = T.assess(spark.createDataFrame(docs, DOC), spark.createDataFrame(labels, LABEL)).collect()
    assert all(len(r.evidence) == T.NEIGHBOURS for r in found) and {e.toxic for r in found for e in r.evidence} == {0, 1}
