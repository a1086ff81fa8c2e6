import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from docketlab.llm import packing as P
from docketlab.llm.tokens import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
ROWS = "doc_id long, text string"


def best_fit(lengths, capacity):
    """Sequences that best-fit decreasing opens, one piece after another."""
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
        gaps.append((min(fits) if fits else capacity) - n)
    return len(gaps)


@pytest.mark.parametrize("seed,capacity", [(1, 10), (2, 16), (3, 64), (4, 100)])
def test_plan_is_best_fit_decreasing(seed, capacity):
    rng = random.Random(seed)
    lengths = [rng.choice([1, 2, capacity // 3, capacity - 1, rng.randrange(1, capacity)]) for _ in range(rng.randrange(1, 300))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    rows, made = P.plan(counts, capacity)
    assert made == best_fit(lengths, capacity)
    held, ranks = defaultdict(list), defaultdict(list)
    for length, first, n, seq, at in rows.tolist():
        for k in range(n):
            held[seq + k].append((at, length))
            ranks[length].append(first + k)
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in counts.items()}
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(held) == made and P.plan({}, capacity)[1] == 0


@pytest.mark.parametrize("n,want", [(1, [(0, 1)]), (1024, [(0, 1024)]), (1025, [(0, 1), (1, 1024)]), (2048, [(0, 1024), (1024, 1024)]), (2050, [(0, 2), (2, 1024), (1026, 1024)])])
def test_split(n, want):
    assert P.split(n) == want


def check(rows, docs):
    exact = Tokenizer.from_file(PATH)
    want = []
    for d, t in docs:
        ids = np.array(exact.encode(t or "", add_special_tokens=False).ids + [2], dtype="<u4")
        want += [(d, k, at, n, zlib.crc32(ids[at : at + n].tobytes())) for k, (at, n) in enumerate(P.split(len(ids)))]
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows], key=str) == sorted(want, key=str)
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(held) == best_fit([r.length for r in rows], 1024)


def test_documents_round_trip(spark):
    rng = random.Random(9)
    vocab = ["the", "été", "Straße", "don't", "12", "—", "中文", "🙂", "\n", "<|endoftext|>", "  ", " ", "x" * 50]
    docs = [(i, " ".join(rng.choices(vocab, k=rng.choice([3, 50, 400, 900])))) for i in range(60)]
    docs += [(7, docs[7][1]), (100, None), (101, ""), (None, "no id"), (102, "word " * 20_000), (103, "a" * 3_000)]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], ROWS + ", length int, part string")
    check(P.pack_documents(df, PATH).collect(), docs)
    assert P.pack_documents(df.limit(0), PATH).collect() == []


def test_both_libraries_agree():
    both = Encoder(open(PATH, encoding="utf-8").read())
    assert both.quick is not None
    for t in ["", " a  b", "It's we'll I'D", "tab\t\tx \n\n y ", "ça va? ÀÉ ß", "12ab 3,4", "a\u0085b c", "<|endoftext|>", "\x1c\x1d", "٣٤ ² ½"]:
        assert both.encode(t).tolist() == both.exact.encode(t, add_special_tokens=False).ids
