import random
import re

from docketlab.llm import decontaminate as D

DOC, ITEM = "doc_id long, text string", "item_id long, text string"


def words(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, bench, window=10):
    out = []
    for d, t in docs:
        w, hit, items = words(t), set(), set()
        for i, b in bench:
            v = words(b)
            n = min(window, len(v))
            grams = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)} if v else set()
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in grams:
                    hit |= set(range(k, k + n))
                    items.add(str(i) if i is not None else "null")
        out.append((d, len(w), len(hit), tuple(sorted(items))))
    return sorted(out, key=str)


def run(spark, docs, bench, **kw):
    found = D.find_contamination(spark.createDataFrame(docs, DOC), spark.createDataFrame(bench, ITEM), **kw)
    return sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in found.collect()), key=str)


def case(rng, n=60):
    vocab = [f"w{i}" for i in range(25)] + ["É", "naïve", "X9"]
    bench = [(i, " ".join(rng.choices(vocab, k=rng.choice([1, 4, 10, 11, 30])))) for i in range(12)] + [(3, "w1, W2. w3!"), (50, None), (51, "--"), (None, "w4 w5 w6 w7")]
    docs = []
    for i in range(n):
        t = rng.choices(vocab + ["zz", "qq"], k=rng.randrange(80))
        if rng.random() < 0.5:
            k = rng.randrange(len(t) + 1)
            t[k:k] = rng.choice([b for b in bench if b[1]])[1].split()
        docs.append((i, ", ".join(t)))
    return docs + [(100, None), (101, ""), (5, docs[5][1]), (5, "other text"), (None, bench[0][1])], bench


def test_matches_brute_force(spark):
    docs, bench = case(random.Random(3))
    assert run(spark, docs, bench) == brute(docs, bench)


def test_blocks_of_a_large_benchmark_and_pieces_of_a_long_item(spark):
    docs, bench = case(random.Random(4))
    assert run(spark, docs, bench, block_bytes=150) == brute(docs, bench)
    tests = D.prepare([("null" if i is None else str(i), (t or "").encode()) for i, t in bench], 10, piece=7)
    got = D.find_hits([(t or "").encode() for _, t in docs], tests)
    assert sorted(((d, n, sum(e - b for b, e in s), tuple(i)) for (d, _), (n, s, i) in zip(docs, got)), key=str) == brute(docs, bench)


def test_empty_tables_and_long_text(spark):
    docs, bench = case(random.Random(6), 8)
    assert run(spark, [], bench) == []
    assert run(spark, docs, []) == brute(docs, [])
    long = [(1, "w1 zz " * 100_000 + bench[3][1])]
    assert run(spark, long, bench[3:4]) == brute(long, bench[3:4])


def test_longest_matches(spark):
    text = "a b c d e f g h i j k l m"
    docs = [(1, "x a b c d e f g h i j k y"), (2, "a b c d e f g h i j z"), (3, "b c d e f g h i j k l m")]
    got = {r.item_word: (r.n_words, r.n_places, r.doc_id, r.doc_word) for r in D.longest_matches(spark.createDataFrame(docs, DOC).coalesce(1), spark.createDataFrame([(7, text)], ITEM)).collect()}
    assert got[0] == (11, 1, 1, 1) and got[1] == (12, 1, 3, 0)


def test_longest_matches_are_those_of_all_places():
    for seed in range(6):
        rng = random.Random(seed)
        vocab = [f"w{i}" for i in range(rng.choice([2, 4, 30]))]
        bench = [(str(i), " ".join(rng.choices(vocab, k=rng.choice([1, 3, 12, 25]))).encode()) for i in range(6)]
        docs = [(i, " ".join(rng.choices(vocab + ["zz"], k=rng.randrange(60)) + rng.choice(bench)[1].decode().split())) for i in range(8)]
        tests = D.prepare(bench, 4)
        got = {(i, o): (n, places, d, w) for i, o, n, places, d, w in D.longest_in_shard([d for d, _ in docs], [t.encode() for _, t in docs], tests)}
        want = {}
        for name, b in bench:
            v = b.decode().split()
            for o in range(len(v) - min(4, len(v)) + 1):
                found = []
                for d, t in docs:
                    w = t.split()
                    for k in range(len(w)):
                        n = 0
                        while o + n < len(v) and k + n < len(w) and v[o + n] == w[k + n]:
                            n += 1
                        found.append((n, d, k))
                most = max(n for n, *_ in found)
                if most >= min(4, len(v)):
                    first = min((d, k) for n, d, k in found if n == most)
                    want[name, o] = (most, sum(n == most for n, *_ in found), *first)
        assert got == want


def test_a_long_copied_item_takes_no_quadratic_time():
    import time

    body = " ".join(f"x{i}" for i in range(20_000)).encode()
    tests = D.prepare([("1", body)], 10)
    began = time.perf_counter()
    (n, spans, items), = D.find_hits([b"before it " + body + b" after"], tests)
    assert (n, spans, items) == (20_003, [[2, 20_002]], ["1"]) and time.perf_counter() - began < 5
    found = D.longest_in_shard([5], [body], tests)
    assert found[0] == ("1", 0, 20_000, 1, 5, 0) and time.perf_counter() - began < 10


def test_clean_documents_stay_with_their_columns(spark):
    docs = spark.createDataFrame([(1, "one two three four", "n"), (2, "one two three five", "n"), (2, "one two three four", "m"), (None, "fine", "h"), (4, None, "s")], DOC + ", h string")
    kept = D.decontaminate(docs, spark.createDataFrame([(1, "two three four")], ITEM))
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == [(2, "one two three five"), (4, None), (None, "fine")]
