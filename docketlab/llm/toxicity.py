"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Vectors are over all words of the labelled examples, each by its first letters. A term's weight is its TF-IDF, lifted
where its tie to the label is far beyond chance: none is left out for its label, but terms that tell the classes apart decide which examples are
near. The index keeps for each term its postings, or, if it is frequent, its weights by blocks of examples with their
largest. A text's rare terms are added up first; of its frequent terms only the blocks are scored whose bound could
still better the worst of the best. Neighbours of both classes vote by their cosine; the share of toxic votes is
calibrated by what such shares meant for the examples themselves.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import id_and_bytes, materialize, text_hash
from .labelled import fold, label_sample

#: Labelled examples of each class at most; all others of the labelled rows only count as how many there are.
PER_CLASS = 3_000
NEIGHBOURS = 9
BLOCK = 64
#: Blocks scored before the bound is looked at again.
STEP = 32
#: Terms in more than one of so many examples are kept by blocks.
FREQUENT = 16
#: Standard errors by which a term's log odds must differ from even before it is lifted, and the weight of all others.
SURE = 4.0
PLAIN = 0.1
#: Examples of one label with so large a share of their word pairs in common (Jaccard) count once.
ALIKE = 0.8
KIN_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
HELD_OUT_OF = 5
WORD = re.compile(r"\w+")
#: Letters of a word's beginning that are its term.
STEM = 4
#: Cosines this close are equal; of equally near examples the one of least id is taken first.
TIE = 1e-6


def words(text: str) -> list[str]:
    """All words of a text in lower case."""
    return WORD.findall(text.lower())


def terms(text: str) -> list[str]:
    """The beginnings of all words of a text: forms of one word are one term, whatever the language."""
    return [w[:STEM] for w in WORD.findall(text.lower())]


def word_pairs(words: list[str]) -> set[int]:
    """Hashes of a text's word pairs; of its one word if there is no pair."""
    pairs = {f"{a} {b}" for a, b in zip(words, words[1:])} or {" ".join(words)}
    return {xxhash.xxh64_intdigest(p, 7) for p in pairs}


def kins(pairs: set[int]) -> list[int]:
    """Least hashes of word pairs, one for each of KIN_SEEDS orders: near copies share most of them."""
    h = np.fromiter(pairs, dtype=np.uint64, count=len(pairs))
    return [int(((h ^ (h >> np.uint64(29))) * np.uint64(m)).min() >> np.uint64(1)) for m in KIN_SEEDS]


def lift(pos: np.ndarray, neg: np.ndarray, n_pos: int, n_neg: int) -> np.ndarray:
    """Factors of terms that occur in so many examples of either class: PLAIN, and more if the log odds are surely not even."""
    a, b = pos + 0.5, neg + 0.5
    odds = np.log(a / (n_pos - pos + 0.5)) - np.log(b / (n_neg - neg + 0.5))
    return PLAIN + np.maximum(0.0, np.abs(odds) / np.sqrt(1 / a + 1 / b) - SURE) * (n_pos > 0) * (n_neg > 0)


def vector(words: list[str], vocabulary: dict[str, int], factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms and weights of a text's unit vector (weights 1 + ln tf, times idf, lifted)."""
    get = vocabulary.get
    tf = [(k, n) for w, n in Counter(words).items() if (k := get(w)) is not None]
    if not tf:
        return np.zeros(0, np.int64), np.zeros(0)
    tf.sort()
    at = np.array([k for k, _ in tf], dtype=np.int64)
    w = (1 + np.log(np.array([n for _, n in tf], dtype=float))) * factor[at]
    return at, w / np.sqrt((w * w).sum())


@dataclass
class Index:
    """Examples as unit vectors, numbered by blocks.

    Rare terms have postings ``example, weight`` from ``start[t]`` to ``start[t + 1]``. Frequent ones have a row
    ``row[t]`` (else -1): ``dense[b, row]`` are the weights in block b, ``bound[row, b]`` the largest of them.
    """

    vocabulary: dict[str, int]
    factor: np.ndarray
    start: np.ndarray
    example: np.ndarray
    weight: np.ndarray
    row: np.ndarray
    dense: np.ndarray
    bound: np.ndarray
    ids: np.ndarray
    label: np.ndarray


def build(vectors: list[tuple[np.ndarray, np.ndarray]], ids, label, vocabulary, factor) -> Index:
    n, size = len(vectors), len(vocabulary)
    blocks = -(-n // BLOCK)
    at = np.concatenate([v[0] for v in vectors]) if n else np.zeros(0, np.int64)
    weight = np.concatenate([v[1] for v in vectors]) if n else np.zeros(0)
    who = np.repeat(np.arange(n), [len(v[0]) for v in vectors])
    df = np.bincount(at, minlength=size)
    row = np.full(size, -1, np.int64)
    often = np.flatnonzero(df * FREQUENT > n)
    row[often] = np.arange(len(often))
    dense = np.zeros((blocks, len(often), BLOCK), np.float32)
    many = row[at] >= 0
    dense[who[many] // BLOCK, row[at[many]], who[many] % BLOCK] = weight[many]
    order = np.lexsort((who[~many], at[~many]))
    start = np.concatenate(([0], np.cumsum(np.bincount(at[~many], minlength=size))))
    return Index(
        vocabulary, factor, start, who[~many][order].astype(np.int32), weight[~many][order].astype(np.float32), row, dense,
        np.ascontiguousarray(dense.max(axis=2, initial=0).T), np.asarray(ids, dtype=np.int64), np.asarray(label, dtype=np.int64),
    )


def nearest(index: Index, at: np.ndarray, w: np.ndarray, k: int = NEIGHBOURS, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
    """The k examples of largest positive cosine, and the cosines; example ``skip`` is left out."""
    n, blocks = len(index.ids), len(index.dense)
    if not len(at) or not n:
        return np.zeros(0, np.int64), np.zeros(0)
    row = index.row[at]
    rare, often = at[row < 0], row[row >= 0]
    lo, size = index.start[rare], index.start[rare + 1] - index.start[rare]
    where = np.repeat(lo - np.cumsum(size) + size, size) + np.arange(size.sum())
    sums = np.bincount(index.example[where], weights=index.weight[where] * np.repeat(w[row < 0], size), minlength=blocks * BLOCK)
    sums = sums.astype(float).reshape(blocks, BLOCK)
    if skip >= 0:
        sums[skip // BLOCK, skip % BLOCK] = -np.inf
    mine = w[row >= 0].astype(np.float32)
    bounds = np.maximum(sums.max(axis=1), 0) + mine @ index.bound[often]
    order, floor = np.argsort(-bounds, kind="stable"), 0.0
    found, cosine = np.zeros(0, np.int64), np.zeros(0)
    for s in range(0, blocks, STEP):
        some = order[s : s + STEP]
        some = some[bounds[some] > floor - 2 * TIE]
        if not len(some):
            break
        score = sums[some] + np.einsum("t,btk->bk", mine, index.dense[some[:, None], often[None, :]])
        b, j = np.nonzero(score > max(TIE, floor - 2 * TIE))
        found = np.concatenate([found, some[b] * BLOCK + j])
        cosine = np.concatenate([cosine, score[b, j]])
        if len(cosine) >= k:
            floor = np.partition(cosine, len(cosine) - k)[len(cosine) - k]
            near = cosine > floor - 2 * TIE
            found, cosine = found[near], cosine[near]
    top = np.lexsort((index.ids[found], -np.round(cosine / TIE)))[:k]
    return found[top], cosine[top]


def vote(index: Index, best: np.ndarray, cosine: np.ndarray) -> float:
    """Share of toxic neighbours, each counting as its cosine; -1 without neighbours."""
    return float((cosine * index.label[best]).sum() / cosine.sum()) if len(best) else -1.0


def calibrate(shares: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points (share, score) of a non-decreasing line, by pooled adjacent violators.

    A pool is a point at its mean share; its score is smoothed by one example at even odds.
    """
    order = np.argsort(shares, kind="stable")
    pools: list[list[float]] = []  # largest share, weight, toxic weight, weighted shares
    for s, y, w in zip(shares[order], label[order], weight[order]):
        pools.append([s, w, w * y, w * s])
        while len(pools) > 1 and (pools[-2][0] == s or pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]):
            last = pools.pop()
            pools[-1] = [last[0], *(x + z for x, z in zip(pools[-1][1:], last[1:]))]
    score = np.maximum.accumulate(np.array([(t + 0.5) / (w + 1) for _, w, t, _ in pools])) if pools else np.zeros(0)
    return np.array([x / w for _, w, _, x in pools]), score


@dataclass
class Model:
    index: Index
    steps: np.ndarray
    scores: np.ndarray
    nothing: float  # score of a text without neighbours

    def score(self, words: list[str]) -> tuple[float, np.ndarray, np.ndarray]:
        best, cosine = nearest(self.index, *vector(words, self.index.vocabulary, self.index.factor))
        share = vote(self.index, best, cosine)
        if share < 0:
            return self.nothing, best, cosine
        return float(np.interp(share, self.steps, self.scores)) if len(self.scores) else self.nothing, best, cosine


def _terms(body: bytes) -> list[str]:
    return terms(body.decode("utf-8", "replace"))


def _words(body: bytes) -> list[str]:
    return words(body.decode("utf-8", "replace"))


def single_examples(examples: DataFrame) -> DataFrame:
    """``examples`` (``doc_id, label, body``) without those alike to an earlier one of their label.

    Near copies would make all their words look tied to their label. An example goes if it is alike to the first of its
    label that shares a least hash, which stays or is alike to an earlier one.
    """

    def mark(batches):
        for b in batches:
            kin = [kins(word_pairs(_words(x))) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(kin, pa.list_(pa.int64()))], ["doc_id", "label", "kin"])

    def alike(batches):
        for b in batches:
            out, last = [], (None, None)
            for d, body, other in zip(*(c.to_pylist() for c in b.columns)):
                if last[0] != other:
                    last = other, word_pairs(_words(other))
                x = word_pairs(_words(body))
                if len(x & last[1]) >= ALIKE * len(x | last[1]):
                    out.append(d)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], ["doc_id"])

    each = materialize(examples.mapInArrow(mark, "doc_id long, label int, kin array<long>"), "kin").select("doc_id", "label", F.posexplode("kin").alias("seed", "kin"))
    leads = each.groupBy("label", "seed", "kin").agg(F.min("doc_id").alias("lead"))
    meet = each.join(leads, ["label", "seed", "kin"]).where("doc_id > lead").select("doc_id", "lead").distinct()
    bodies = examples.select("doc_id", "body")
    meet = meet.join(bodies, "doc_id").join(bodies.select(F.col("doc_id").alias("lead"), F.col("body").alias("other")), "lead").select("doc_id", "body", "other")
    copies = materialize(meet.mapInArrow(alike, "doc_id long").distinct(), "copies")
    return examples.join(F.broadcast(copies), "doc_id", "left_anti").select("doc_id", "label", "body")  # fewer ids than the sample has


def train(docs: DataFrame, labels: DataFrame, column: str = "toxic", allowed=None, per_class: int = PER_CLASS) -> Model:
    """Learn from at most ``per_class`` labelled documents of each class (the sample's bound, whatever the corpus).

    An id that several rows of ``docs`` have is one example, by the least of their texts. The examples' terms are
    counted, their vectors made and their own neighbours found on the executors; the driver holds the sample's terms
    with their counts, the vectors, and a share of votes for each example.
    """
    sample, sizes = label_sample(labels, column, F.lit(True) if allowed is None else allowed, per_class)
    sample = materialize(sample, "sample")  # at most 2 * per_class pairs of numbers
    examples = id_and_bytes(docs).join(F.broadcast(sample), F.col("doc_id") == F.col("id")).groupBy("doc_id").agg(F.max("label").alias("label"), F.min("body").alias("body"))
    examples = materialize(examples, "examples")
    single = single_examples(examples)

    def count(batches):
        for b in batches:
            seen = Counter()
            for label, body in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                for t in set(_terms(body)):
                    seen[t, label] += 1
            columns = [pa.array([t for t, _ in seen], pa.string()), pa.array([y for _, y in seen], pa.int32()), pa.array(list(seen.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["term", "label", "n"])

    n = {r["label"]: r["count"] for r in examples.groupBy("label").count().collect()}
    of = lambda k: F.sum(F.when(F.col("label") == k, F.col("n")).otherwise(0))
    counted = materialize(examples.mapInArrow(count, "term string, label int, n long").groupBy("term").agg(F.sum("n").alias("n")), "terms")
    alone = single.mapInArrow(count, "term string, label int, n long").groupBy("term").agg(of(1).alias("pos"), of(0).alias("neg"))
    df = counted.join(alone, "term", "left").select("term", F.coalesce("pos", F.lit(0)).alias("pos"), F.coalesce("neg", F.lit(0)).alias("neg")).toArrow().sort_by("term")
    n_single = {r["label"]: r["count"] for r in single.groupBy("label").count().collect()}
    vocabulary = {t: k for k, t in enumerate(df["term"].to_pylist())}
    pos, neg = (df[c].to_numpy().astype(float) for c in ("pos", "neg"))
    idf = np.log((1 + sum(n_single.values())) / (1 + pos + neg)) + PLAIN
    held = docs.sparkSession.sparkContext.broadcast((vocabulary, idf * lift(pos, neg, n_single.get(1, 0), n_single.get(0, 0))))

    def project(batches):
        known, factor = held.value
        for b in batches:
            found = [vector(_terms(x), known, factor) for x in b.column(2).to_pylist()]
            columns = [pa.array([x[k].astype(t).tobytes() for x in found], pa.binary()) for k, t in enumerate(("<i4", "<f4"))]
            yield pa.RecordBatch.from_arrays([*b.columns[:2], *columns], ["doc_id", "label", "term", "weight"])

    rows = examples.mapInArrow(project, "doc_id long, label int, term binary, weight binary").toArrow()
    rows = [(d, y, np.frombuffer(t, "<i4"), np.frombuffer(w, "<f4")) for d, y, t, w in zip(*(c.to_pylist() for c in rows.columns))]
    rows.sort(key=lambda r: _kind(r[2], r[3], held.value[1]) + (r[0],))
    empty = {k: sum(1 for _, y, t, _ in rows if y == k and not len(t)) for k in (0, 1)}
    rows = [r for r in rows if len(r[2])]
    index = build([r[2:] for r in rows], [r[0] for r in rows], [r[1] for r in rows], *held.value)
    del rows, df
    own = docs.sparkSession.sparkContext.broadcast(index)

    def shares(batches):
        index = own.value
        place = {d: i for i, d in enumerate(index.ids.tolist())}
        for b in batches:
            out = [(place[d], vector(_terms(x), index.vocabulary, index.factor)) for d, x in zip(b.column(0).to_pylist(), b.column(2).to_pylist()) if d in place]
            found = [vote(index, *nearest(index, *v, skip=i)) for i, v in out]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in out], pa.int64()), pa.array(found, pa.float64())], ["place", "share"])

    share = examples.repartition(8, "doc_id").mapInArrow(shares, "place long, share double").toArrow().sort_by("place")["share"].to_numpy()
    # An example stands for so many labelled documents of its class.
    worth = {k: max(1.0, sizes[k] / max(1, n.get(k, 0))) for k in (0, 1)}
    some = share >= 0
    steps, scores = calibrate(share[some], index.label[some], np.array([worth[y] for y in index.label[some].tolist()]))
    lonely = [worth[k] * (empty[k] + int((~some & (index.label == k)).sum())) for k in (0, 1)]
    usual = (sizes[1] + 0.5) / (sum(sizes.values()) + 1)
    return Model(index, steps, scores, (lonely[1] + usual) / (sum(lonely) + 1))


def _kind(term, weight, factor) -> tuple:
    """Examples of one kind come together, so that blocks' bounds are close: heaviest lifted term, most common term, length."""
    if not len(term):
        return (-1, -1, 0)
    heavy = int(term[weight.argmax()])
    return (heavy if factor[heavy] > 10 * PLAIN else -1, int(term[factor[term].argmin()]), len(term))


EVIDENCE = "array<struct<doc_id:bigint,cosine:double,toxic:int>>"
ARROW_EVIDENCE = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))


def assess(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """``doc_id, h, score, evidence`` for every row of ``docs``; the evidence is its nearest examples with their cosines and labels.

    Only labelled rows whose id is not held out (crc32 modulo five is not zero) are learnt from. Null and empty texts,
    and those without any term of the index, get the score of such texts among the examples and no evidence; without
    labels every score is even. Repeated rows are scored each; an empty table gives an empty result.
    """
    held = docs.sparkSession.sparkContext.broadcast(train(docs, labels, allowed=fold(HELD_OUT_OF) != 0, per_class=per_class))

    def run(batches):
        model = held.value
        for b in batches:
            out = [model.score(terms(x.decode("utf-8", "replace"))) for x in b.column(1).to_pylist()]
            ids, label = model.index.ids, model.index.label
            evidence = [[{"doc_id": int(ids[i]), "cosine": float(c), "toxic": int(label[i])} for i, c in zip(best.tolist(), cosine.tolist())] for _, best, cosine in out]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([x[0] for x in out], pa.float64()), pa.array(evidence, ARROW_EVIDENCE)], ["doc_id", "h", "score", "evidence"])

    return id_and_bytes(docs).withColumn("h", F.xxhash64("body")).mapInArrow(run, f"doc_id long, h long, score double, evidence {EVIDENCE}")


def drop_toxic(docs: DataFrame, labels: DataFrame, reject_from: float = 0.5) -> DataFrame:
    """``docs`` without the rows whose score is ``reject_from`` or more."""
    bad = materialize(assess(docs, labels).where(F.col("score") >= reject_from).select(F.col("doc_id").alias("__tx_id"), F.col("h").alias("__tx_h")).distinct(), "toxic")
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["__tx_id"]) & (text_hash(docs["text"]) == bad["__tx_h"]), "left_anti")
