import random
import re
from collections import Counter

import numpy as np

from docketlab.llm import quality_rules as Q

ROWS = "doc_id long, text string"


def brute(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = {k + j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered)


def texts():
    rng = random.Random(2)
    vocab = ["a", "b", "the", "été", "x|y", "#", "中文", "ok.", "A!"]
    out = ["".join(rng.choice(vocab) + rng.choice([" ", "  ", "\n", "\t", "\x0b", " "]) for _ in range(rng.randrange(60))) for _ in range(80)]
    return out + [None, "", " \n \n", "\n\n", "same\nsame\nsame", "a a a a a", "a b a b a b", "w " * 100_000]


def test_statistics_match_brute_force(spark):
    rows = list(enumerate(texts())) + [(0, "again"), (None, "no id")]
    got = Q.assess(spark.createDataFrame([(d, t, "x") for d, t in rows], ROWS + ", kept string")).collect()
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got), key=str) == sorted(((d, *brute(t)) for d, t in rows), key=str)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_junk_goes_and_prose_stays(spark):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghij", k=rng.randrange(2, 8))) for _ in range(500)]
    prose = lambda: " ".join(rng.choices(words, k=120)).capitalize() + "."
    junk = [lambda: " ".join(w + "***" for w in rng.choices(words, k=120)), lambda: " | ".join(rng.choices(words, k=120)), lambda: "!! ".join(rng.choices(words, k=120)).upper()]
    rows = [(i, prose()) for i in range(200)] + [(1000 + i, rng.choice(junk)()) for i in range(40)]
    got = {r.doc_id: r.kept for r in Q.assess(spark.createDataFrame(rows, ROWS)).collect()}
    assert all(got[d] == (d < 1000) for d in got)
    assert Q.assess(spark.createDataFrame([], ROWS)).collect() == []


def test_em_equals_em_over_single_rows():
    rng = np.random.default_rng(4)
    rows = rng.integers(0, 3, (400, 4))
    patterns, counts = np.unique(rows, axis=0, return_counts=True)
    a, b = Q.fit(patterns, counts.astype(float)), Q.fit(rows, np.ones(len(rows)))
    assert np.allclose(a[0], b[0]) and np.allclose(a[1], b[1])
    true = rng.random(3000) < 0.7
    votes = np.stack([np.where(rng.random(3000) < 0.3, Q.NONE, np.where(rng.random(3000) < acc, ~true, true).astype(int)) for acc in (0.9, 0.8, 0.85, 0.75)], axis=1)
    share, table = Q.fit(votes, np.ones(3000))
    assert ((Q.posterior(votes, share, table) > 0.5) == true).mean() > 0.85 and abs(share[0] - 0.7) < 0.1


def test_a_bad_rule_is_outvoted():
    rng = np.random.default_rng(9)
    junk = rng.random(4000) < 0.15
    good = lambda acc: np.where(rng.random(4000) < 0.25, Q.NONE, np.where(rng.random(4000) < acc, junk, ~junk).astype(int))
    votes = np.stack([good(0.97), good(0.95), good(0.96), good(0.95), np.where(rng.random(4000) < 0.4, Q.JUNK, Q.GOOD)], axis=1)
    share, table = Q.fit(votes, np.ones(4000))
    right = Q.accuracies(share, table)
    assert right[4] < 0.7 < 0.9 < right[:4].min() and abs(share[1] - 0.15) < 0.03
    kept, all_pass = Q.posterior(votes, share, table) >= 0.5, (votes != Q.JUNK).all(axis=1)
    assert (kept == ~junk).mean() > 0.97 and (all_pass == ~junk).mean() < 0.7
    assert (kept[kept != all_pass] == ~junk[kept != all_pass]).mean() > 0.95


def plain_votes(t):
    """The rules' votes on a text, from its characters."""
    n, chars, symbols, dup, repeated = brute(t)
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    upper, letters = len(re.findall("[A-Z]", t)), len(re.findall("[A-Za-z]", t))
    pick = lambda v, good, junk: Q.JUNK if junk(v) else Q.GOOD if good(v) else Q.NONE
    return [
        pick((symbols + t.count("!")) / n, lambda v: v < 0.02, lambda v: v > 0.1), pick(t.count("!") / n, lambda v: v < 0.01, lambda v: v > 0.1),
        pick(upper / max(letters, 1), lambda v: 0 < v < 0.1, lambda v: v > 0.3), pick(chars / n, lambda v: 4 <= v <= 6.5, lambda v: v < 3.5 or v > 7),
        pick(max(Counter(words).values()) / n, lambda v: v < 0.1, lambda v: v > 0.2), pick(repeated / n, lambda v: v <= 0.05, lambda v: v > 0.2),
        pick(dup / len(lines), lambda v: v <= 0.1, lambda v: v > 0.3), pick(n / len(lines), lambda v: 20 <= v <= 100, lambda v: v < 8 or v > 300),
        pick(n, lambda v: v >= 200, lambda v: v < 100),
    ]


def test_verdicts_match_brute_force(spark):
    rng = random.Random(12)
    words = ["".join(rng.choices("abcdefghij", k=rng.randrange(2, 8))) for _ in range(500)]
    sentence = lambda k: " ".join(rng.choices(words, k=k)).capitalize() + "."
    rows = [(i, "\n".join(sentence(rng.randrange(6, 60)) for _ in range(rng.randrange(1, 12)))) for i in range(300)]
    rows += [(1000 + i, re.sub(" ", rng.choice(["*** ", " | ", "!! "]), sentence(rng.randrange(60, 300)))) for i in range(60)]
    rows += [(2000 + i, rows[i][1] + "\n" + "\n".join([sentence(8)] * rng.randrange(1, 9))) for i in range(60)]
    got = {r.doc_id: r for r in Q.assess(spark.createDataFrame(rows, ROWS)).collect()}
    open_ = [(d, plain_votes(t)) for d, t in rows if brute(t)[0] >= 50 and 2 * brute(t)[4] <= brute(t)[0]]
    patterns = np.array([v for _, v in open_])
    kept = Q.posterior(patterns, *Q.fit(patterns, np.ones(len(patterns)))) >= 0.5
    assert {d: bool(k) for (d, _), k in zip(open_, kept)} == {d: got[d].kept for d, _ in open_}
    assert all(got[d].n_against == v.count(Q.JUNK) for d, v in open_)
    assert all(not got[d].kept for d, _ in rows if d not in dict(open_))
    seen = {(got[d].kept, got[d].n_against > 0) for d, _ in open_}
    assert (True, True) in seen and (False, True) in seen  # not all must pass
    rules = {r.rule: r.accuracy for r in Q.report(spark.createDataFrame(rows, ROWS)).collect()}
    assert len(rules) == 9 and rules["length"] < 0.9
