"""Benchmark decontamination with suffix arrays over shards of the training words.

Each shard of documents gets a suffix array over its words; every suffix of every benchmark item is binary-searched in
it, word by word, which gives its longest verbatim match and all places of it. Words that no benchmark item has can be
in no match, so they end a run, and runs shorter than the shortest window can hold none: neither enters the array.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import id_and_bytes, materialize, text_hash

WINDOW = 10
#: Bytes of benchmark text searched in one pass over the documents; larger benchmarks take more passes.
BLOCK_BYTES = 16 << 20
#: Words of an item in one block at most; longer items go in pieces that overlap by a window less one word.
PIECE_WORDS = 200_000
#: Bytes of documents in one suffix array.
SHARD_BYTES = 8 << 20
#: A-Z to a-z; digits, a-z and all bytes of non-ASCII characters stay; the rest separates words.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(body: bytes) -> list[bytes]:
    return body.translate(WORDS).split()


@dataclass
class Tests:
    """Benchmark suffixes of one block. ``codes`` holds word numbers from 1, with a 0 after each item (or piece)."""

    vocabulary: dict[bytes, int]
    codes: np.ndarray
    start: np.ndarray  # places of the suffixes in codes
    offset: np.ndarray  # their words before, in the item
    item: np.ndarray  # numbers into names
    need: np.ndarray  # a match counts from so many words
    is_window: np.ndarray  # whether as many words follow
    names: list[str]
    shortest: int
    longest: int


def prepare(items: list[tuple[str, bytes]], window: int = WINDOW, piece: int = PIECE_WORDS) -> Tests:
    vocabulary: dict[bytes, int] = {}
    codes, start, offset, item, need, is_window, names, longest, shortest = [], [], [], [], [], [], [], 0, window
    for name, body in items:
        words = words_of(body)
        if not words:
            continue
        w = min(window, len(words))
        shortest = min(shortest, w)
        for at in range(0, max(1, len(words) - w + 1), piece):
            part = words[at : at + piece + w - 1]
            longest = max(longest, len(part))
            start += range(len(codes), len(codes) + len(part))
            offset += range(at, at + len(part))
            item += [len(names)] * len(part)
            need += [w] * len(part)
            is_window += [i + w <= len(part) for i in range(len(part))]
            codes += [vocabulary.setdefault(x, len(vocabulary) + 1) for x in part]
            codes.append(0)
        names.append(name)
    as_array = lambda x: np.array(x, dtype=np.int64)
    return Tests(vocabulary, np.append(as_array(codes), np.zeros(longest + 1, np.int64)), as_array(start), as_array(offset), as_array(item), as_array(need), np.array(is_window, dtype=bool), names, shortest, longest)


def prefix_ranks(text: np.ndarray, depth: int) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4 ... numbers, up to ``depth`` at least or until all differ (prefix doubling)."""
    ranks, k = [np.unique(text, return_inverse=True)[1].ravel().astype(np.int64)], 1
    while k < depth and len(text) and int(ranks[-1].max()) < len(text) - 1:
        rank = ranks[-1]
        nxt = np.zeros_like(rank)
        nxt[:-k] = rank[k:] + 1
        key = rank * (int(rank.max()) + 2) + nxt
        order = np.argsort(key, kind="stable")
        new = np.empty_like(rank)
        new[order] = np.concatenate(([0], np.diff(key[order]) != 0)).cumsum()
        ranks.append(new)
        k *= 2
    return ranks


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``text`` in order of their first ``depth`` numbers at least."""
    return np.argsort(prefix_ranks(text, depth)[-1], kind="stable")


def _narrow(values, lo, hi, wanted):
    """In each [lo, hi), where values(i) ascends, the first index whose value is at least ``wanted``."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = np.flatnonzero(lo < hi)
        if not len(open_):
            return lo
        mid = (lo[open_] + hi[open_]) >> 1
        less = values(mid) < wanted[open_]
        lo[open_[less]] = mid[less] + 1
        hi[open_[~less]] = mid[~less]


def search(text: np.ndarray, order: np.ndarray, tests: Tests) -> tuple[np.ndarray, np.ndarray]:
    """For every test suffix that has as many words as its window, the range in ``order`` that matches them.

    The search goes on word by word, up to the window's last.
    """
    n = len(tests.start)
    lo, hi = np.zeros(n, np.int64), np.full(n, len(order), np.int64)
    padded = np.append(text, np.zeros(int(tests.need.max(initial=0)) + 2, np.int64))
    live, depth = np.flatnonzero(tests.is_window), 0
    lo[~tests.is_window] = hi[~tests.is_window] = 0
    while len(live):
        wanted = tests.codes[tests.start[live] + depth]
        at = lambda i, d=depth: padded[order[i] + d]
        first = _narrow(at, lo[live], hi[live], wanted)
        lo[live], hi[live] = first, _narrow(at, first, hi[live], wanted + 1)
        depth += 1
        live = live[(hi[live] > lo[live]) & (tests.need[live] > depth)]
    return lo, hi


def search_longest(text: np.ndarray, tests: Tests) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every test suffix that matches by its window at least: its number, the words of its longest match, its range in an order of ``text``, and that order.

    One array of ranks holds the suffixes of the text and of the tests. A test suffix is searched among the text's by
    rank; its longest match is that with one of its two neighbours, found from the ranks by 1, 2, 4 ... words.
    """
    joined = np.concatenate([text, tests.codes])
    ends = joined == 0  # what ends a run or an item is like nothing else
    joined[ends] = joined.max(initial=0) + 1 + np.arange(ends.sum())
    ranks = prefix_ranks(joined, len(joined))
    padded = [np.append(r, np.full(1, -1)) for r in ranks]
    order = np.argsort(ranks[-1][: len(text)], kind="stable")
    which = np.flatnonzero(tests.is_window)
    mine = tests.start[which] + len(text)
    at = np.searchsorted(ranks[-1][order], ranks[-1][mine])

    def common(a, b):
        a, b, out = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for k in range(len(ranks) - 1, -1, -1):
            same = np.flatnonzero(padded[k][np.minimum(a, len(joined))] == padded[k][np.minimum(b, len(joined))])
            same = same[(a[same] < len(joined)) & (b[same] < len(joined))]
            for x in (a, b, out):
                x[same] += 1 << k
        return out

    beside = [np.clip(at + d, 0, len(order) - 1) for d in (-1, 0)]
    length = np.maximum(*(common(order[i], mine) for i in beside))
    keep = length >= tests.need[which]
    which, mine, at, length = which[keep], mine[keep], at[keep], length[keep]
    level = np.frexp(length)[1] - 1  # 2 ** level words or more
    shift = length - (1 << level)

    def same(i):
        out = np.zeros(len(i), bool)
        for k in np.unique(level).tolist():
            some = level == k
            a, b = order[i[some]], mine[some]
            r = padded[k]
            second = lambda x: r[np.minimum(x + shift[some], len(joined))]  # noqa: B023, E731
            out[some] = (r[a] == r[b]) & (second(a) == second(b))
        return out

    lo, hi = np.zeros(len(at), np.int64), np.full(len(at), len(order), np.int64)
    low_to, high_from = at.copy(), at.copy()
    while (open_ := lo < low_to).any():  # before the suffix's place, what matches comes last
        mid = (lo + low_to) >> 1
        ok = same(np.minimum(mid, len(order) - 1))
        low_to = np.where(open_ & ok, mid, low_to)
        lo = np.where(open_ & ~ok, mid + 1, lo)
    while (open_ := high_from < hi).any():  # and after it, first
        mid = (high_from + hi) >> 1
        ok = same(np.minimum(mid, len(order) - 1))
        high_from = np.where(open_ & ok, mid + 1, high_from)
        hi = np.where(open_ & ~ok, mid, hi)
    return which, length, lo, hi, order


@dataclass
class Shard:
    counts: np.ndarray  # words of each document
    starts: np.ndarray  # words before it
    text: np.ndarray  # runs that may match, with a 0 after each
    place: np.ndarray  # where in the shard each number of text is


def build_shard(bodies: list[bytes], tests: Tests) -> Shard:
    get = tests.vocabulary.get
    codes: list[int] = []
    counts = np.zeros(len(bodies), np.int64)
    for k, body in enumerate(bodies):
        words = words_of(body)
        counts[k] = len(words)
        codes += [get(w, 0) for w in words]
        codes.append(0)
    all_codes = np.array(codes, dtype=np.int64)
    starts = np.cumsum(counts + 1) - counts - 1
    edge = np.diff(np.concatenate(([0], (all_codes > 0).astype(np.int8), [0])))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    keep = end - begin >= tests.shortest
    begin, end = begin[keep], end[keep]
    sizes = end - begin + 1
    place = np.repeat(begin, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    text = all_codes[np.minimum(place, max(0, len(all_codes) - 1))] if len(place) else np.zeros(0, np.int64)
    return Shard(counts, starts, text, place)


def _spread(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the range, and index, for every index of all ranges."""
    n = hi - lo
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + lo[which]


def find_hits(bodies: list[bytes], tests: Tests) -> list[tuple[int, list[list[int]], list[str]]]:
    """For each document its words, the word ranges that windows cover, and the items whose windows they are."""
    shard = build_shard(bodies, tests)
    spans: list[list[list[int]]] = [[] for _ in bodies]
    items: list[set[int]] = [set() for _ in bodies]
    if len(shard.text) and len(tests.start):
        order = suffix_array(shard.text, int(tests.need.max()))
        lo, hi = search(shard.text, order, tests)
        hit = np.flatnonzero(hi > lo)
        same = np.unique(np.stack([lo[hit], hi[hit], tests.need[hit]], axis=1), axis=0, return_inverse=True)
        ranges, group = same[0], same[1].ravel()
        owners: list[set[int]] = [set() for _ in ranges]
        for g, i in zip(group.tolist(), tests.item[hit].tolist()):
            owners[g].add(i)
        which, index = _spread(ranges[:, 0], ranges[:, 1])
        at = shard.place[order[index]]
        cover = np.zeros(int(shard.starts[-1] + shard.counts[-1]) + 2, np.int64)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + ranges[which, 2], -1)
        edge = np.diff(np.concatenate(([0], (np.cumsum(cover) > 0).astype(np.int8), [0])))
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        doc = np.searchsorted(shard.starts, begin, side="right") - 1
        for d, b, e in zip(doc.tolist(), (begin - shard.starts[doc]).tolist(), (end - shard.starts[doc]).tolist()):
            spans[d].append([b, e])
        pairs = np.unique(np.stack([np.searchsorted(shard.starts, at, side="right") - 1, which], axis=1), axis=0)
        for d, g in pairs.tolist():
            items[d] |= owners[g]
    return [(n, s, sorted({tests.names[i] for i in k})) for n, s, k in zip(shard.counts.tolist(), spans, items)]


def longest_in_shard(ids: list[int], bodies: list[bytes], tests: Tests) -> list[tuple[str, int, int, int, int, int]]:
    """For every test suffix that matches by its window at least: item, words before, longest match, its places, and document and word of the first."""
    shard = build_shard(bodies, tests)
    if not len(shard.text) or not len(tests.start):
        return []
    out = []
    which, length, lo, hi, order = search_longest(shard.text, tests)
    for i, k in enumerate(which.tolist()):
        at = int(shard.place[order[lo[i] : hi[i]]].min())
        d = int(np.searchsorted(shard.starts, at, side="right")) - 1
        out.append((tests.names[tests.item[k]], int(tests.offset[k]), int(length[i]), int(hi[i] - lo[i]), ids[d], at - int(shard.starts[d])))
    return out


def _shards(batches):
    """The rows of an Arrow stream by shards: as many as come to the bytes of one, one at least."""
    for b in batches:
        bodies, at, size = b.column(1).to_pylist(), 0, 0
        for k, body in enumerate(bodies):
            size += len(body)
            if size >= SHARD_BYTES or k == len(bodies) - 1:
                yield b.slice(at, k + 1 - at), bodies[at : k + 1]
                at, size = k + 1, 0


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, limit: int):
    """Lists of (item, bytes), each within the limit or a single item."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("body")).where("length(body) > 0").distinct()
    total = items.agg(F.sum(F.length("body"))).first()[0] or 0
    if total <= limit:
        yield [(r.item, bytes(r.body)) for r in items.collect()]
        return
    dealt = materialize(items.withColumn("part", F.pmod(F.xxhash64("item", "body"), F.lit(-(-2 * total // limit)))), "benchmark")
    for k in range(-(-2 * total // limit)):
        block, size = [], 0
        for r in dealt.where(F.col("part") == k).select("item", "body").toLocalIterator():
            if block and size + len(r.body) > limit:
                yield block
                block, size = [], 0
            block.append((r.item, bytes(r.body)))
            size += len(r.body)
        if block:
            yield block


FOUND = "doc_id long, h long, n_words long, spans array<array<int>>, items array<string>"


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for every row of ``docs``: ``doc_id, h, n_words, n_hit, spans, items``.

    ``spans`` are the word ranges [from, to) inside any occurrence of an item's window, ``items`` the items with such
    occurrences (as strings, in order), ``h`` a hash of the text. Null or wordless documents have no words and no hits;
    repeated documents or items change nothing; an item without id is named "null"; an empty benchmark hits nothing.
    The benchmark is held in memory only up to ``block_bytes``: a larger one is searched block by block, with one pass
    over the documents for each and the hits joined afterwards.
    """
    bodies = id_and_bytes(docs, id_col, text_col).withColumn("h", F.xxhash64("body"))
    passes = []
    for block in _blocks(benchmark, item_col, item_text_col, block_bytes):
        tests = prepare(block, window)
        held = docs.sparkSession.sparkContext.broadcast(tests)

        def run(batches, held=held):
            for rows, texts in _shards(batches):
                found = find_hits(texts, held.value)
                columns = [rows.column(0), rows.column(2), pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.list_(pa.list_(pa.int32()))), pa.array([x[2] for x in found], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "h", "n_words", "spans", "items"])

        passes.append(bodies.mapInArrow(run, FOUND))
    found = passes[0] if len(passes) == 1 else _merged(passes)
    return found.select("doc_id", "h", "n_words", F.expr("aggregate(spans, 0L, (n, s) -> n + s[1] - s[0])").alias("n_hit"), "spans", "items")


def _merged(passes: list[DataFrame]) -> DataFrame:
    """Each document's hits of all passes. Rows are told apart by id and text; equal ones are counted and given back."""
    rows = passes[0]
    for p in passes[1:]:
        rows = rows.unionByName(p)
    rows = materialize(rows, "passes")
    key = ["doc_id", "h", "n_words"]
    items = F.array_sort(F.array_distinct(F.flatten(F.collect_set("items"))))
    whole = rows.groupBy(*key).agg((F.count("*") / len(passes)).cast("int").alias("__n"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("spans")))).alias("all"), items.alias("items"))
    joined = F.expr(
        "aggregate(all, cast(array() as array<array<int>>), (a, s) -> CASE WHEN size(a) > 0 AND element_at(a, -1)[1] >= s[0] "
        "THEN concat(slice(a, 1, size(a) - 1), array(array(element_at(a, -1)[0], greatest(element_at(a, -1)[1], s[1])))) ELSE concat(a, array(s)) END)"
    )
    return whole.select(*key, joined.alias("spans"), "items", F.explode(F.expr("sequence(1, __n)"))).drop("col")


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item, item_word, n_words, n_places, doc_id, doc_word``: for every benchmark suffix its longest verbatim match in
    the corpus, how often it is there (over all shards), and the first place."""
    rows = None
    for block in _blocks(benchmark, "item_id", "text", block_bytes):
        held = docs.sparkSession.sparkContext.broadcast(prepare(block, window))

        def run(batches, held=held):
            for part, texts in _shards(batches):
                found = longest_in_shard(part.column(0).to_pylist(), texts, held.value)
                yield pa.RecordBatch.from_pylist([dict(zip(("item", "item_word", "n_words", "n_places", "doc_id", "doc_word"), x)) for x in found], schema=LONGEST_ARROW)

        part = id_and_bytes(docs).mapInArrow(run, "item string, item_word long, n_words long, n_places long, doc_id long, doc_word long")
        rows = part if rows is None else rows.unionByName(part)
    best = rows.groupBy("item", "item_word", "n_words").agg(F.sum("n_places").alias("n_places"), F.min(F.struct("doc_id", "doc_word")).alias("first"))
    top = best.withColumn("most", F.max("n_words").over(W.partitionBy("item", "item_word"))).where("n_words = most")
    return top.select("item", "item_word", "n_words", "n_places", "first.doc_id", "first.doc_word")


LONGEST_ARROW = pa.schema([("item", pa.string()), ("item_word", pa.int64()), ("n_words", pa.int64()), ("n_places", pa.int64()), ("doc_id", pa.int64()), ("doc_word", pa.int64())])


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold any window of the benchmark."""
    bad = materialize(find_contamination(docs, benchmark).where("n_hit > 0").groupBy("doc_id", "h").count(), "leaks").withColumnsRenamed({"doc_id": "__dc_id", "h": "__dc_h"})
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["__dc_id"]) & (text_hash(docs["text"]) == bad["__dc_h"]), "left_anti")
