import random
import zlib

import numpy as np

from docketlab.llm import sharding as S

ROWS = "doc_id long, text string"


def check(spark, docs, **kw):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], ROWS + ", shard string, size int")
    rows = S.assign(df, **kw).collect()
    body = lambda t: (t or "").encode()
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in rows), key=str) == sorted(((d, len(body(t)) + 8, zlib.crc32(body(t))) for d, t in docs), key=str)
    shards = {}
    for r in rows:
        shards.setdefault(r.shard, []).append(r)
    for held in shards.values():
        assert sorted(r.slot for r in held) == list(range(len(held)))
    return shards


def test_balance_groups_and_odd_rows(spark):
    rng = random.Random(1)
    docs = [(i, "é word " * rng.randrange(1, 60) + str(i)) for i in range(3000)]
    docs += [(5000 + i, "copy of a text") for i in range(20)] + [(None, "a"), (None, "a"), (7, None), (7, ""), (8, "long " * 5_000)]
    shards = check(spark, docs, shards=6, units=64)
    size = [sum(r["size"] for r in held) for held in shards.values()]
    assert len(shards) == 6 and max(size) < 1.02 * min(size)
    homes = {}
    for k, held in shards.items():
        for r in held:
            homes.setdefault((r.h1, r.h2), set()).add(k)
    assert all(len(x) == 1 for x in homes.values())


def test_a_third_of_all_rows_is_one_group(spark):
    docs = [(i, f"text {i} " * 9) for i in range(2000)] + [(10_000 + i, "hot " * 20) for i in range(1000)]
    shards = check(spark, docs, shards=8, units=32)
    rows = [len(h) for h in shards.values()]
    assert max(rows) < 1.1 * min(rows)


def test_empty_table(spark):
    assert check(spark, []) == {}


def test_place_follows_the_dot_product():
    rng = np.random.default_rng(3)
    units = rng.random((200, 3)) + 0.1
    share = units * 5 / units.sum(axis=0)
    left, want = np.ones((5, 3)), {}
    for k in sorted(range(200), key=lambda k: (-(share[k] * S.WEIGHTS).sum(), k)):
        scores = [(left[s] * share[k] * S.WEIGHTS).sum() for s in range(5)]
        want[k] = scores.index(max(scores))
        left[want[k]] -= share[k]
    assert S.place(units, 5).tolist() == [want[k] for k in range(200)]
