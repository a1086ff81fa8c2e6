import itertools
import random
from collections import defaultdict

import pytest

from docketlab.llm import chat as C

ROWS = "conv_id long, turn long, role string, text string"


def legal(roles):
    rest = roles[1:] if roles[:1] == [C.SYSTEM] else roles
    return len(rest) % 2 == 0 and all(r == (C.USER, C.ASSISTANT)[k % 2] for k, r in enumerate(rest)) and (not roles or bool(rest))


def least(roles):
    """Cheapest repair over all labels, merges and inserted messages."""
    best = None
    for labels in itertools.product(range(3), repeat=len(roles)):
        for merges in itertools.product((False, True), repeat=max(0, len(roles) - 1)):
            if any(m and labels[k] != labels[k + 1] for k, m in enumerate(merges)):
                continue
            cost = sum(0 if a == b else C.NAME if a == C.UNKNOWN else C.RELABEL for a, b in zip(roles, labels)) + C.MERGE * sum(merges)
            kept = [labels[0], *(r for r, m in zip(labels[1:], merges) if not m)] if roles else []
            # Inserted messages before each and at the end, up to two.
            for gaps in itertools.product(((), (C.USER,), (C.ASSISTANT,), (C.USER, C.ASSISTANT)), repeat=len(kept) + 1):
                whole = [r for g, k in zip(gaps, [*kept, None]) for r in (*g, *([] if k is None else [k]))]
                total = cost + C.INSERT * sum(map(len, gaps))
                if (best is None or total < best) and legal(whole):
                    best = total
    return best


@pytest.mark.parametrize("n", [1, 2, 3])
def test_cost_is_least(n):
    for roles in itertools.product(range(4), repeat=n):
        moves = C.best_moves(list(roles))
        assert sum(m[2] for m in moves) + C.END[moves[-1][1]] == least(list(roles)), roles


def parse(sequence):
    return [m.split("|>\n", 1) for m in sequence.split("<|end|>\n") if m]


def run(spark, rows):
    got = defaultdict(list)
    for r in C.repair(spark.createDataFrame([(*x, "e") for x in rows], ROWS + ", piece string")).collect():
        got[r.conv_id].append(r)
    return got


def test_conversations_over_many_partitions(spark):
    rng = random.Random(4)
    names = ["user", "assistant", "system", "human", "GPT", "tool", None]
    rows = [(c, t, rng.choice(names), f"t{t} of {c}" if rng.random() < 0.95 else None) for c, n in ((1, 900), (2, 3), (3, 1), (4, 500), (5, 2), (None, 4)) for t in range(n)]
    rng.shuffle(rows)
    got = run(spark, rows)
    want = defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        want[c].append((role, text))
    assert {c: len(x) for c, x in got.items()} == {c: len(x) for c, x in want.items()}
    for c, turns in got.items():
        turns.sort(key=lambda r: r.turn)
        numbers = [C.role_number(r) for r, _ in want[c]]
        moves = C.best_moves(numbers)
        assert sum(r.cost for r in turns) == sum(m[2] for m in moves) + C.END[moves[-1][1]]
        messages = parse("".join(r.piece for r in turns))
        assert legal([C.ROLES.index(m[0].removeprefix("<|")) for m in messages])
        assert "".join(m[1] for m in messages).replace("\n", "") == "".join(t or "" for _, t in want[c])


def test_odd_rows(spark):
    assert run(spark, []) == {}
    got = run(spark, [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "system", "s"), (1, 1, "assistant", "b" * 100_000), (2, 0, "assistant", "")])
    assert len(got[1]) == 4 and sum(r.cost for r in got[1]) == C.MERGE
    assert [r.action for r in got[1] if r.turn == 0].count("merge") == 1
    assert got[2][0].role == "user" or got[2][0].piece == "<|user|>\n<|end|>\n<|assistant|>\n<|end|>\n"
