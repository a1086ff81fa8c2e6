"""The corpus pipeline against brute-force versions of its stages, on a small corpus."""

import random

import public_tokenizers
import pytest

import corpus_pipeline as P

from .test_decontaminate import brute as brute_hits
from .test_line_dedup import brute as brute_lines
from .test_packing import check as check_packing
from .test_simhash import brute_components

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefgh", k=rng.randrange(2, 8))) for _ in range(400)]
    line = lambda n=14: " ".join(rng.choices(words, k=n))
    docs = [(i, "\n".join(line() for _ in range(6))) for i in range(60)]
    for i in range(60, 75):  # toxic ones
        t = line(60).split()
        for _ in range(5):
            t[rng.randrange(60)] = rng.choice(["schimpfa", "schimpfe"])
        docs.append((i, " ".join(t)))
    shared = line(55)
    docs += [(80 + k, f"{line()}\n{shared}\n{line()}") for k in range(6)]  # a passage that repeats
    docs += [(90, docs[0][1]), (91, docs[1][1]), (92, docs[2][1].replace(" ", "  ", 1))]  # copies
    bench = [(k, line(25)) for k in range(3)]
    docs += [(100 + k, f"{line()} {b} {line()}") for k, (_, b) in enumerate(bench)]  # leaks
    docs += [(110, ""), (111, None)]
    labels = [(i, 1, int(60 <= i < 75)) for i in range(75)]
    return docs, bench, labels


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    docs, bench, labels = corpus()
    d = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], DOC).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    tables, now = {"input": docs}, spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in P.STAGES:
        now = P.materialize(stage(spark, now, d), name)
        if name != "packing":
            assert now.columns == P.COLUMNS
            tables[name] = [(r.doc_id, r.text) for r in now.collect()]
    return spark, d, tables, now.collect()


def by_id(rows):
    return sorted(rows, key=str)


def test_toxic_documents_go(run):
    tables = run[2]
    assert {i for i, _ in tables["input"]} - {i for i, _ in tables["toxicity"]} == set(range(60, 75))


def test_repeated_lines_go(run):
    tables = run[2]
    assert by_id(tables["line_dedup"]) == by_id(brute_lines(tables["toxicity"]))
    assert dict(tables["line_dedup"])[90] == "" and dict(tables["line_dedup"])[0] == dict(tables["input"])[0]


def test_near_duplicates_go(run):
    tables = run[2]
    kept = {c for _, _, c in brute_components(tables["line_dedup"])}
    assert by_id(tables["simhash"]) == by_id((i, t) for i, t in tables["line_dedup"] if i in kept)


def test_leaks_go(run):
    tables, bench = run[2], corpus()[1]
    bad = {i for i, _, hit, _ in brute_hits(tables["simhash"], bench) if hit}
    assert bad == {100, 101, 102}
    assert by_id(tables["decontamination"]) == by_id((i, t) for i, t in tables["simhash"] if i not in bad)


def test_what_is_left_is_packed(run):
    _, _, tables, packed = run
    check_packing(packed, tables["decontamination"])


def test_run_gives_the_same(run):
    spark, d, _, packed = run
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in P.run(spark, d).collect()) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in packed)


def test_tokenizer_file():
    assert P.tokenizer_path() == public_tokenizers.path("byte_bpe_50k.json")
