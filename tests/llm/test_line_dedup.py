import itertools
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from docketlab.llm import line_dedup as L

ROWS = "doc_id long, text string"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(prev[j] + 1, row[-1] + 1, prev[j - 1] + (x != y)))
    return row[-1]


def edited(line, rng, n):
    for _ in range(n):
        k, c = rng.randrange(len(line) + 1), rng.choice("abc é")
        line = rng.choice([line[:k] + c + line[k:], line[:k] + line[k + 1 :], line[:k] + c + line[k + 1 :]])
    return line


@pytest.mark.parametrize("edits", [0, 1, 2, 3])
def test_banded_distance(edits):
    rng = random.Random(edits)
    for _ in range(3000):
        a = "".join(rng.choices("ab é", k=rng.randrange(14)))
        b = edited(a, rng, rng.randrange(5)) if rng.random() < 0.8 else "".join(rng.choices("ab", k=rng.randrange(14)))
        assert L.within(a, b, edits) == (distance(a, b) <= edits), (a, b)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_every_similar_pair_shares_a_key(edits):
    rng = random.Random(edits)
    for _ in range(1500):
        a = "".join(rng.choices("abc", k=rng.randrange(edits + 1, 30)))
        b = edited(a, rng, rng.randrange(edits + 1))
        if len(b) <= edits:
            continue
        each = [L.entries([x], edits, 1) for x in (a, b)]
        keys = [{r: set(key[role == r].tolist()) for r in (L.INDEX, L.PROBE)} for _, role, key, *_ in each]
        assert keys[0][L.INDEX] & keys[1][L.PROBE] or keys[1][L.INDEX] & keys[0][L.PROBE]


def brute(docs, per_edit=L.PER_EDIT, edits=L.EDITS):
    """Texts without repeated lines, from all pairs of lines."""
    at = [((d is None, d or 0), t, nr, x, d) for d, t in dict.fromkeys(docs) if t is not None for nr, x in enumerate(t.split("\n")) if x.encode().split()]
    lines = sorted({x for *_, x, _ in at})
    root = {x: x for x in lines}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(lines, 2):
        e = min(edits, min(len(a), len(b)) // per_edit)
        if e and abs(len(a) - len(b)) <= e and distance(a, b) <= e:
            root[find(a)] = find(b)
    classes = defaultdict(list)
    for order, t, nr, x, d in at:
        classes[find(x)].append((order, t, nr, d))
    gone = defaultdict(set)
    for members in classes.values():
        ids = {m[0] for m in members}
        first = min(members, key=lambda m: (m[0], 0 if len(ids) == len(members) else L_hash(m[1]), m[2]))
        for m in members:
            if m != first:
                gone[m[3], m[1]].add(m[2])
    return sorted(((d, t if t is None else "\n".join(x for nr, x in enumerate(t.split("\n")) if nr not in gone[d, t])) for d, t in docs), key=str)


def L_hash(text):
    import xxhash

    h = xxhash.xxh64_intdigest((text or "").encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def corpus(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randrange(2, 9)))
    pool = [" ".join(word() for _ in range(rng.choice([2, 4, 7, 12, 20]))) for _ in range(40)]
    docs = []
    for i in range(n):
        lines = [edited(rng.choice(pool), rng, rng.choice([0, 0, 1, 2, 3])) if rng.random() < 0.6 else " ".join(word() for _ in range(9)) for _ in range(rng.randrange(8))]
        docs.append((i, "\n".join(lines)))
    return docs + [(3, docs[3][1]), (100, docs[5][1]), (101, None), (102, ""), (103, "\n\n"), (None, docs[7][1]), (104, "long line here of words " * 5_000)]


def run(spark, docs):
    df = spark.createDataFrame([(d, t, "x", 7) for d, t in docs], ROWS + ", line string, nr int")
    out = L.dedup_lines(df)
    assert out.columns == [*df.columns, "__ld_lines"]
    return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    docs = corpus(seed)
    assert run(spark, docs) == brute(docs)
    assert run(spark, []) == []


def test_entries_are_those_of_the_plain_rules():
    rng = random.Random(3)
    lines = ["".join(rng.choices("abé\U0001f600 ", k=rng.randrange(1, 90))) for _ in range(200)]
    which, role, _, start, size, more = L.entries(lines, 2, 20)
    got = sorted(zip(which.tolist(), role.tolist(), start.tolist(), size.tolist(), more.tolist()))
    want = []
    for i, n in enumerate(map(len, lines)):
        e = L.budget(n, 2, 20)
        want += [(i, L.INDEX, at, size, 0) for at, size in (L.segments(n, e) if e else [])]
        for indexed in range(n - 2, n + 1):
            if (e := L.budget(indexed, 2, 20)) and n - indexed <= e:
                want += [(i, L.PROBE, at, size, n - indexed) for _, at, size in L.windows(n, indexed, e)]
    assert got == sorted(want)


@pytest.mark.parametrize("per_line, group", [(0, 4), (0, 60), (4, 9), (0, L.GROUP), (L.PAIRS_PER_LINE, L.GROUP)])
def test_frequent_segments_lose_no_link(spark, per_line, group):
    rng = random.Random(5)
    stem, tail = "a common beginning of very many of these lines, ", " and a common end of them all"
    docs = [(i, stem + "".join(rng.choices("xyz", k=rng.randrange(6, 40))) + tail) for i in range(90)]
    docs += [(200 + i, edited(rng.choice(docs)[1], rng, 2)) for i in range(60)]
    df = spark.createDataFrame(docs, ROWS)
    text = F.coalesce(F.col("text"), F.lit(""))
    near = lambda a, b: a != b and abs(len(a) - len(b)) <= 2 and distance(a, b) <= 2
    want = {tuple(sorted((L_hash(a), L_hash(b)))) for (_, a), (_, b) in itertools.combinations(docs, 2) if near(a, b)}
    got = {tuple(sorted((r.u, r.v))) for r in L.similar_lines(df, text, per_line=per_line, group=group)[0].collect()}
    assert got <= want and components(got) == components(want) and len(want) > 30


def components(pairs):
    root = {}
    for a, b in pairs:
        group = root.setdefault(a, {a}) | root.setdefault(b, {b})
        for x in group:
            root[x] = group
    return {frozenset(g) for g in root.values()}


def test_lines_of_few_words_repeat(spark):
    chinese = "".join(chr(0x4E00 + 7 * k) for k in range(60))
    url = "https://example.org/a/path/of/some/length?key=0123456789abcdef"
    docs = [(1, f"All rights reserved.\n\n{chinese}\nok"), (2, f"All rights reserved.\n\n \t\n{url}\nother"), (3, f"ok\n{chinese[:-1]}x\n\n{url[:-1]}e\n \t"), (4, "okay\nOK")]
    assert run(spark, docs) == [(1, docs[0][1]), (2, f"\n \t\n{url}\nother"), (3, "\n \t"), (4, "okay\nOK")]


def test_links_of_a_group_of_copies_are_few(spark):
    rng = random.Random(8)
    base = "one line of which there are very many slightly different copies in the corpus"
    docs = [(i, edited(base, rng, 2)) for i in range(1500)] + [(2000 + i, f"common beginning of lines that differ, number {i:05d} " + str(rng.random())) for i in range(1500)]
    links = L.similar_lines(spark.createDataFrame(docs, ROWS), F.col("text"))[0]
    got = {(r.u, r.v) for r in links.collect()}
    lines = {t for _, t in docs}
    assert len(got) <= 15 * len(lines)
    assert max(map(len, components(got))) == len({t for i, t in docs if i < 2000})


def test_a_group_that_no_segment_divides(spark):
    docs = [(i, "a beginning that is common to all of them " + f"{i:03d}") for i in range(300)]
    df = spark.createDataFrame(docs, ROWS)
    for group in (7, 50):
        got = {(r.u, r.v) for r in L.similar_lines(df, F.col("text"), per_line=0, group=group)[0].collect()}
        assert len(components(got)) == 1 and len(next(iter(components(got)))) == 300


def test_lines_by_length(spark):
    docs = [(1, "Item 1\nof nineteen letters"), (2, "Item 2\nof nineteen lettera"), (3, "one of twenty letters 1\nItem 1"), (4, "one of twenty letters 2"), (5, "one of twenty letterz 3")]
    assert run(spark, docs) == [(1, docs[0][1]), (2, docs[1][1]), (3, "one of twenty letters 1"), (4, ""), (5, docs[4][1])] == brute(docs)


def test_text_of_very_many_lines(spark):
    import time

    line = lambda i: f"line {i} of a text that another document has as well {i * i}"
    body = "\n".join(map(line, range(16_000)))
    df = spark.createDataFrame([(1, body), (2, "a line of its own\n" + body)], ROWS)
    began = time.perf_counter()
    got = {r.doc_id: r.text for r in L.dedup_lines(df).collect()}
    assert got[1].startswith(line(0)) and got[2] == "a line of its own" and time.perf_counter() - began < 60
