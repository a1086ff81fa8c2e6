import random

import numpy as np
from pyspark.sql import functions as F

from docketlab.llm import quality_model as M

DOC, LABEL = "doc_id long, text string", "doc_id long, quality int, toxic int"


def corpus(n=500, seed=3):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefgh", k=rng.randrange(2, 8))) for _ in range(300)]
    junk = [lambda w: "!! ".join(w).upper(), lambda w: " | ".join(w), lambda w: " ".join(w[:1] * 40), lambda w: " ".join(x + "***" for x in w)]
    docs, labels = [], []
    for i in range(n):
        w, good = rng.choices(words, k=rng.randrange(20, 90)), i % 4 != 0
        docs.append((i, " ".join(w).capitalize() + "." if good else rng.choice(junk)(w)))
        labels.append((i, int(good), 0))
    return docs, labels


def test_held_out_documents_and_odd_rows(spark):
    docs, labels = corpus()
    odd = [(900, None), (901, ""), (1, docs[1][1]), (None, docs[1][1]), (903, "plain " * 50_000)]
    d = spark.createDataFrame([(a, b, 1.0, "x") for a, b in docs + odd], DOC + ", lines double, score string")
    rows = M.assess(d, spark.createDataFrame(labels + [(1, None, 1), (None, 0, 1)], LABEL)).collect()
    assert len(rows) == len(docs) + len(odd)
    score = {r.doc_id: r.score for r in rows}
    assert sum((score[i] >= 0.5) == (q == 1) for i, q, _ in labels) > 0.97 * len(labels)
    assert all(0 <= r.score <= 1 for r in rows) and score[900] == score[901] and score[None] == score[1]
    assert M.assess(d.limit(0), spark.createDataFrame(labels, LABEL)).collect() == []
    assert {r.score for r in M.assess(d, spark.createDataFrame([], LABEL)).collect()} == {0.5}


def test_compiled_column_equals_the_model(spark):
    rng = np.random.default_rng(2)
    x = rng.random((600, 3))
    y = ((x[:, 0] > 0.4) & (x[:, 1] <= 0.7)).astype(float)
    model = M.fit(x, y, ["a", "b", "c"])
    assert ((model.score(x) >= 0.5) == (y == 1)).mean() > 0.97
    got = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double").select(model.column().alias("s")).toPandas()["s"]
    assert np.allclose(got, model.score(x))
    assert len(model.rules) < len(M.extract_rules(x, y))


def test_lasso_zeroes_useless_weights():
    rng = np.random.default_rng(5)
    z = rng.integers(0, 2, (2000, 12)).astype(float)
    y = (rng.random(2000) < 1 / (1 + np.exp(-(3 * z[:, 0] - 2 * z[:, 1])))).astype(float)
    intercept, w = M.lasso(z, y, 0.02)
    assert w[0] > 0.5 and w[1] < -0.3 and np.abs(w[2:]).max() < 0.1 and (w == 0).sum() >= 6


def test_statistics(spark):
    row = spark.createDataFrame([("A b b b, !! x|y 12\nz",)], "t string").select(*(c.alias(k) for k, c in M.statistics(F.col("t")).items())).first()
    assert row.marks == 2 / 7 and row.symbols == 1 / 7 and row.commas == 1 / 7 and row.lines == 1 / 7 and row.same_again == 1 / 7
