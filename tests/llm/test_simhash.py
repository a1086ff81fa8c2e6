import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from docketlab.llm import simhash

ROWS = "doc_id long, text string"


def brute_print(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows):
    prints = [brute_print(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 3:
            parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, prints[i], least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def sample(n, rng):
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(n):
        if i and rng.random() < 0.5:
            t = rows[rng.randrange(i)][1].split(" ")
            for _ in range(rng.randrange(3)):
                t[rng.randrange(len(t))] = rng.choice(words)
            rows.append((i, " ".join(t)))
        else:
            rows.append((i, " ".join(rng.choices(words, k=rng.choice([1, 2, 3, 40, 300])))))
    return rows


def result(spark, rows):
    got = simhash.near_duplicates(spark.createDataFrame(rows, ROWS)).collect()
    return sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got), key=str)


def test_matches_brute_force(spark):
    rows = sample(160, random.Random(5))
    assert result(spark, rows) == brute_components(rows)


def test_edge_rows(spark):
    long = "Abé " * 40_000
    rows = [(3, None), (1, ""), (2, " \n\t"), (7, "Only Two"), (7, "only two"), (9, long), (8, long), (None, "only two"), (None, "alone here now")]
    assert result(spark, rows) == brute_components(rows)
    assert result(spark, []) == []


def test_extra_columns_do_not_clash(spark):
    df = spark.createDataFrame([(1, "a b c d", 5, "x"), (2, "a b c d", 6, "y"), (3, "completely other words", 7, "z")], ROWS + ", fp int, component_id string")
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {1, 3}
    again = df.unionByName(df.where("doc_id = 1"))
    assert sorted(r.doc_id for r in simhash.drop_near_duplicates(again).collect()) == [1, 3]


@pytest.mark.parametrize("heaviest", [4, 40])
def test_heavy_subtries_are_split_without_loss(spark, heaviest):
    rng = random.Random(heaviest)
    base = [rng.getrandbits(64) for _ in range(12)]
    prints = {b ^ sum(1 << x for x in rng.sample(range(64), rng.randrange(4))) for b in base for _ in range(12)}
    rows = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(sorted(prints))]
    got = {r.fp: r.component_id for r in simhash.components(spark.createDataFrame(rows, "doc_id long, fp long"), heaviest=heaviest).collect()}
    label = {i: i for i, _ in rows}
    for _ in rows:
        for (i, a), (j, b) in itertools.combinations(rows, 2):
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3:
                label[i] = label[j] = min(label[i], label[j])
        if got == {f: label[i] for i, f in rows}:
            break
    assert got == {f: label[i] for i, f in rows}


def test_trie_pairs_against_all_pairs():
    rng = np.random.default_rng(1)
    keys = np.sort(rng.integers(0, 1 << 12, 3000, dtype=np.uint64) << np.uint64(52))
    keys = np.unique(keys | rng.integers(0, 4, len(keys), dtype=np.uint64))
    zero, end = np.array([0]), np.array([len(keys)])
    got = set()
    for i, j in simhash.trie_pairs(keys, (zero, end), (zero, end), np.array([0])):
        got |= set(zip(np.minimum(i, j).tolist(), np.maximum(i, j).tolist()))
    d = np.bitwise_count(keys[:, None] ^ keys[None, :])
    assert got == {(i, j) for i, j in zip(*np.nonzero(d <= 3)) if i < j}
