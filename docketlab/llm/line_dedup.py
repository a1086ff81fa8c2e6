"""Near-duplicate lines by a segment-partition edit join, and documents without their repeated lines.

Two lines at most ``edits`` apart: if one is cut into ``edits + 1`` segments, one segment at least is a substring of the
other, near its own place. So each line is indexed by its segments (with its length) and probes the indexes of its own
and of slightly lesser lengths with the substrings at the places that can match. Index entries and probes meet in
buckets of packed hashes; lines that repeat exactly meet as one. Candidates are verified by banded bit-parallel edit
distance, and linked lines form classes, of which the first line in the corpus stays.

The budget grows with the length: a line may differ by one edit for every ``per_edit`` characters of the shorter line,
by ``edits`` at most. Shorter lines match exactly; blank lines are left alone.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.graph import star_components
from .common import discard, materialize, partitions, text_hash

EDITS = 2
#: Characters of a line for each edit that it may differ by.
PER_EDIT = 20
SEED = 42
#: A segment's pairs are passed on if they are at most so many times its lines; else its lines meet with their texts.
PAIRS_PER_LINE = 4
#: Lines of one segment that are compared in one task at most; beyond, they are dealt out by further segments.
GROUP = 20_000
#: Pairs of lines compared outright; beyond, the rest of the lines is segmented again.
OUTRIGHT = 64
#: Characters whose segments are hashed at a time.
CHUNK = 1 << 19
INDEX, PROBE = 1, 2


def budget(n: int, edits: int = EDITS, per_edit: int = PER_EDIT) -> int:
    """Edits by which lines may differ, the shorter of which has n characters."""
    return min(edits, n // per_edit)


def segments(n: int, edits: int = EDITS) -> list[tuple[int, int]]:
    """(start, length) of the segments of a line of n characters; the later ones are longer by one if need be."""
    parts = edits + 1
    short, longer = n // parts, n % parts
    out, at = [], 0
    for k in range(parts):
        size = short + (k >= parts - longer)
        out.append((at, size))
        at += size
    return out


def windows(n: int, indexed: int, edits: int = EDITS):
    """(segment, start, length) of the substrings with which a line of n characters probes those of ``indexed``.

    If segment k is the first to match, at most k edits lie before it and at most edits - k after it.
    """
    more = n - indexed
    for k, (at, size) in enumerate(segments(indexed, edits)):
        lo = max(0, at - k, at + more - (edits - k))
        hi = min(n - size, at + k, at + more + (edits - k))
        for start in range(lo, hi + 1):
            yield k, start, size


_FACTOR, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(factor: int, n: int) -> np.ndarray:
    """Powers of ``factor`` from 0 to n - 1, modulo 2^64."""
    if len(_powers.get(factor, ())) < n:
        steps = np.full(max(n, CHUNK + 1), factor, dtype=np.uint64)
        steps[0] = 1
        _powers[factor] = np.cumprod(steps)
    return _powers[factor][:n]


def entries(lines: list[str], edits: int = EDITS, per_edit: int = PER_EDIT):
    """(line, role, key, start, length, characters more than the indexed line) of all index entries and probes, as arrays.

    A key is a hash of the segment's text, number, and the length of the indexed line. The texts' hashes are those of
    polynomials modulo 2^64, so that all segments of all lines come from one running sum.
    """
    n = np.array([len(x) for x in lines], dtype=np.int64)
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    offset = np.cumsum(n) - n
    total = len(points) + 1
    mixed = (points + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed ^= mixed >> np.uint64(29)
    run = np.concatenate(([np.uint64(0)], np.cumsum(mixed * _power(_FACTOR, total)[:-1])))
    back = _power(_INVERSE, total)
    allowed = np.minimum(edits, n // per_edit)
    out = []

    def add(which, role, k, e, indexed, start, size, more):
        at = offset[which] + start
        h = (run[at + size] - run[at]) * back[at]
        h ^= (indexed.astype(np.uint64) << np.uint64(8)) + np.uint64(k * (edits + 1) + e)
        h *= np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xC4CEB9FE1A85EC53)
        h ^= h >> np.uint64(29)
        out.append((which, np.full(len(which), role, np.int8), h, start, size, np.full(len(which), more, np.int8)))

    for more in range(edits + 1):
        for e in range(max(1, more), edits + 1):
            indexed = n - more
            which = np.flatnonzero((indexed > 0) & (np.minimum(edits, indexed // per_edit) == e))
            if not len(which):
                continue
            length = indexed[which]
            short, longer = length // (e + 1), length % (e + 1)
            for k in range(e + 1):
                start = k * short + np.maximum(0, k - (e + 1 - longer))
                size = short + (k >= e + 1 - longer)
                if not more:
                    add(which, INDEX, k, e, length, start, size, 0)
                lo = np.maximum(0, np.maximum(start - k, start + more - (e - k)))
                hi = np.minimum(n[which] - size, np.minimum(start + k, start + more + (e - k)))
                for step in range(2 * e + 1):
                    ok = lo + step <= hi
                    if ok.any():
                        add(which[ok], PROBE, k, e, length[ok], lo[ok] + step, size[ok], more)
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int8, np.uint64, np.int64, np.int64, np.int8))
    return tuple(np.concatenate(x) for x in zip(*out))


def within(a: str, b: str, edits: int = EDITS) -> bool:
    """Whether a and b are at most ``edits`` insertions, deletions and substitutions apart.

    One register for each number of edits; its bit i says that so many edits turn the first j characters of b into the
    first j + i - edits of a. The registers hold the band around the diagonal alone, and die out early on other texts.
    """
    if abs(len(a) - len(b)) > edits:
        return False
    if a == b:
        return True
    lo, top = 0, min(len(a), len(b))
    for step in (64, 8, 1):
        while lo + step <= top and a[lo : lo + step] == b[lo : lo + step]:
            lo += step
    if a[lo + edits :] == b[lo + edits :] and len(a) == len(b):
        return True
    m, n = len(a) - lo, len(b) - lo
    width = (1 << (2 * edits + 1)) - 1
    state = [((1 << (d + 1)) - 1) << edits for d in range(edits + 1)]
    for j in range(n):
        c, same = b[lo + j], 0
        for i in range(max(0, edits - j), min(2 * edits + 1, m - j + edits)):
            if a[lo + j + i - edits] == c:
                same |= 1 << i
        legal = width
        if m - j - 1 + edits < 2 * edits:
            legal &= (1 << (max(0, m - j - 1 + edits) + 1)) - 1
        before, old = state, 0
        state = []
        for d in range(edits + 1):
            new = before[d] & same
            if d:
                new |= before[d - 1] | before[d - 1] >> 1 | old << 1
            old = new & legal
            state.append(old)
        if not state[-1]:
            return False
    return bool(state[-1] >> (m - n + edits) & 1)


PAIR = np.dtype([("key", "<u4"), ("line", "<u8")])
MET = "kind int, bucket int, key long, a long, b long"


def _chunks(lines, sizes=len):
    """Lists of lines of about CHUNK characters."""
    out, size = [], 0
    for x in lines:
        out.append(x)
        size += sizes(x)
        if size >= CHUNK:
            yield out
            out, size = [], 0
    if out:
        yield out


def _packed(buckets: int, edits: int, per_edit: int):
    """Task: from documents' bytes to rows (bucket, index, probes) of packed (hash of the key, line) pairs, each line once."""

    def fresh(bodies, seen):
        for body in bodies:
            for raw in body.split(b"\n"):
                if len(raw) < per_edit or (h := xxhash.xxh64_intdigest(raw, SEED)) in seen:
                    continue
                seen.add(h)
                if len(line := raw.decode("utf-8", "replace")) >= per_edit and line.strip():
                    yield h, line

    def run(batches):
        seen: set[int] = set()
        for b in batches:
            for part in _chunks(fresh(b.column(0).to_pylist(), seen), lambda x: len(x[1])):
                hashes = np.array([h for h, _ in part], dtype=np.uint64)
                which, role, key, *_ = entries([x for _, x in part], edits, per_edit)
                bucket = (key % np.uint64(buckets)).astype(np.int64)
                cut = {}
                for r in (INDEX, PROBE):
                    mine = np.flatnonzero(role == r)
                    mine = mine[np.argsort(bucket[mine], kind="stable")]
                    data = np.empty(len(mine), dtype=PAIR)
                    data["key"], data["line"] = (key[mine] >> np.uint64(32)).astype(np.uint32), hashes[which[mine]]
                    cut[r] = data, np.searchsorted(bucket[mine], np.arange(buckets + 1))
                at = np.flatnonzero((np.diff(cut[INDEX][1]) > 0) | (np.diff(cut[PROBE][1]) > 0))
                payload = [pa.array([cut[r][0][cut[r][1][i] : cut[r][1][i + 1]].tobytes() for i in at.tolist()], pa.binary()) for r in (INDEX, PROBE)]
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *payload], ["bucket", "index", "probes"])

    return run


def _distinct(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs in order of x, then y."""
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    new = np.append(True, (x[1:] != x[:-1]) | (y[1:] != y[:-1]))[: len(x)]
    return x[new], y[new]


def _meet(per_line: int):
    """Task: in each bucket, the lines that share a key.

    Of a key with few lines the pairs (kind 0), of which there are ``per_line`` times its entries at most; of any other
    its entries (kinds 1 and 2). Either way the rows grow as the entries do.
    """

    def run(batches):
        held = defaultdict(lambda: ([], []))
        for b in batches:
            for bucket, index, probes in zip(*(c.to_pylist() for c in b.columns)):
                held[bucket][0].append(index)
                held[bucket][1].append(probes)
        for bucket in list(held):
            index, probes = (np.frombuffer(b"".join(x), dtype=PAIR) for x in held.pop(bucket))
            (index_key, index_line), (probe_key, probe_line) = _distinct(index["key"], index["line"]), _distinct(probes["key"], probes["line"])
            keys, first, n_index = np.unique(index_key, return_index=True, return_counts=True)
            if not len(keys):
                continue
            group = np.searchsorted(keys, probe_key)
            ok = (group < len(keys)) & (keys[np.minimum(group, len(keys) - 1)] == probe_key)
            probe_key, probe_line, group = probe_key[ok], probe_line[ok], group[ok]
            n_probes = np.bincount(group, minlength=len(keys))
            heavy = n_index * n_probes > per_line * (n_index + n_probes)
            light = ~heavy[group]
            lines, groups = probe_line[light], group[light]
            for at in range(0, len(lines), 1 << 16):
                p, g = lines[at : at + (1 << 16)], groups[at : at + (1 << 16)]
                which = np.repeat(np.arange(len(p)), n_index[g])
                k = np.arange(len(which)) - np.repeat(np.cumsum(n_index[g]) - n_index[g], n_index[g])
                a, b = index_line[first[g][which] + k], p[which]
                a, b = _distinct(np.minimum(a, b)[a != b], np.maximum(a, b)[a != b])
                if len(a):
                    yield _rows(0, bucket, np.zeros(len(a), np.int64), a, b)
            if heavy.any():
                own = heavy[np.searchsorted(keys, index_key)]
                yield _rows(INDEX, bucket, index_key[own].astype(np.int64), index_line[own], index_line[own])
                yield _rows(PROBE, bucket, probe_key[~light].astype(np.int64), probe_line[~light], probe_line[~light])

    return run


def _rows(kind, bucket, key, a, b):
    n = len(a)
    kinds, buckets = pa.array(np.full(n, kind, np.int32)), pa.array(np.full(n, bucket, np.int32))
    lines = [pa.array(np.ascontiguousarray(x).view(np.int64)) for x in (a, b)]
    return pa.RecordBatch.from_arrays([kinds, buckets, pa.array(key), *lines], ["kind", "bucket", "key", "a", "b"])


def _verify(edits: int, per_edit: int):
    def run(batches):
        for b in batches:
            keep = [within(x, y, budget(min(len(x), len(y)), edits, per_edit)) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return run


def corpus_lines(docs: DataFrame, text: Column) -> DataFrame:
    """``id, row, nr, line, body``: the lines that are not blank, with their number in the text; ``row`` tells texts apart."""
    each = docs.select(F.col("doc_id").cast("long").alias("id"), text_hash(text).alias("row"), F.posexplode(F.split(text, "\n", -1)).alias("nr", "body"))
    return each.where(F.col("body").rlike(r"\S")).select("id", "row", "nr", F.xxhash64("body").alias("line"), "body")


REST = "key long, line long, role int, body string, rest string, more int"
LINKS = "u long, v long"


def similar_lines(docs: DataFrame, text: Column, edits: int = EDITS, per_edit: int = PER_EDIT, per_line: int = PAIRS_PER_LINE, group: int = GROUP):
    """Links ``u, v`` between hashes of different lines within their budget of edits, and ``line, check`` of the lines linked.

    All links are given but for those that others imply among the lines of a frequent segment: of these there is a
    forest, of one link a line and segment at most.
    """
    spark = docs.sparkSession
    buckets = max(partitions(spark), 2 * docs.rdd.getNumPartitions())  # so a bucket's entries come from half a split's lines on average
    packed = docs.select(text.cast("binary").alias("body")).mapInArrow(_packed(buckets, edits, per_edit), "bucket int, index binary, probes binary")
    met = materialize(packed.repartition(buckets, "bucket").mapInArrow(_meet(per_line), MET), "met")
    pairs = materialize(met.where("kind = 0").select("a", "b").distinct(), "pairs")
    lines = corpus_lines(docs, text).where(F.length("body") >= per_edit).select("line", "body")
    wanted = materialize(pairs.select(F.col("a").alias("want")).union(pairs.select("b")).union(met.where("kind > 0").select("a")).distinct(), "wanted")
    # A merge join at every size: what is wanted grows with the corpus, so a broadcast of it would only do while it is small.
    bodies = materialize(lines.join(wanted.hint("merge"), lines["line"] == wanted["want"]).groupBy("line").agg(F.first("body").alias("body")), "bodies")
    first, second = bodies.withColumnsRenamed({"line": "a", "body": "one"}), bodies.withColumnsRenamed({"line": "b", "body": "two"})
    both = pairs.join(first, "a").join(second, "b").select(F.col("a").alias("u"), F.col("b").alias("v"), "one", "two")
    found = both.mapInArrow(_verify(edits, per_edit), LINKS)
    heavy = met.where("kind > 0").select("kind", "bucket", "key", F.col("a").alias("line"))
    if not heavy.isEmpty():
        found = found.unionByName(_refined(heavy.join(bodies, "line"), buckets, edits, per_edit, group))
    found = materialize(found, "found")
    for t in (met, pairs, wanted):
        discard(t)
    return found, bodies.select("line", F.hash("body").alias("check"))


def solve(index: list, probes: list, edits: int, find, union) -> None:
    """Join the lines of ``index`` with those of ``probes`` that are at most ``edits`` apart.

    Both hold (line, text, rest): the lines share what is not in their rests, so of two that are close the rests are
    close as well. What all rests begin and end with is cut off; of what is left one segment is shared again, so lines
    are dealt to groups by segments until a group is small, or is of one class already.
    """
    if len({find(x[0]) for x in index} | {find(x[0]) for x in probes}) < 2:
        return
    if len(index) * len(probes) > OUTRIGHT:
        lead, text, rest = index[0]
        for line, other, its in probes:
            if find(line) != find(lead) and within(rest, its, edits) and within(text, other, edits):
                union(line, lead)
        if len({find(x[0]) for x in index} | {find(x[0]) for x in probes}) < 2:
            return
        rests = [r for *_, r in index] + [r for *_, r in probes]
        head, tail = affixes(min(rests), max(rests), min(x[::-1] for x in rests), max(x[::-1] for x in rests), min(map(len, rests)))
        n = len(index[0][2]) - head - tail
        if n > edits:
            groups = defaultdict(lambda: ([], []))
            parts = segments(n, edits)
            for line, text, rest in index:
                rest = rest[head : len(rest) - tail]
                for k, (at, size) in enumerate(parts):
                    groups[k, rest[at : at + size]][0].append((line, text, rest[:at] + rest[at + size :]))
            for line, text, rest in probes:
                rest = rest[head : len(rest) - tail]
                for k, at, size in windows(len(rest), n, edits):
                    if (k, part := rest[at : at + size]) in groups:
                        groups[k, part][1].append((line, text, rest[:at] + rest[at + size :]))
            for some, others in groups.values():
                if others:
                    solve(some, others, edits, find, union)
            return
    for line, text, rest in probes:
        at = find(line)
        for other, its, left in index:
            if at != find(other) and within(left, rest, edits) and within(its, text, edits):
                union(line, other)
                at = find(line)


def affixes(least: str, most: str, least_back: str, most_back: str, shortest: int) -> tuple[int, int]:
    """Characters that all of some strings begin and end with, from their extremes in order, read either way."""
    head = next((i for i, (a, b) in enumerate(zip(least, most)) if a != b), min(len(least), len(most)))
    tail = next((i for i, (a, b) in enumerate(zip(least_back, most_back)) if a != b), min(len(least_back), len(most_back)))
    head = min(head, shortest)
    return head, min(tail, shortest - head)


def _compare(edits: int, per_edit: int):
    """Task: rows of REST in order of their keys; links inside each key's lines, as a forest."""

    def links(rows):
        root: dict[int, int] = {}
        out = []

        def find(x):
            while (up := root.setdefault(x, x)) != x:
                root[x] = x = root[up]
            return x

        def union(a, b):
            out.append((a, b))
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)

        index = list({(x[0], x[3]): (x[0], x[2], x[3]) for x in rows if x[1] == INDEX}.values())
        probes = list({(x[0], x[3]): (x[0], x[2], x[3]) for x in rows if x[1] == PROBE}.values())
        by_length = defaultdict(lambda: ([], []))  # a key's hash may be that of two lengths
        for x in index:
            by_length[len(x[1]), len(x[2])][0].append(x)
        for some in by_length.values():
            e = budget(len(some[0][0][1]), edits, per_edit)
            solve(some[0], [x for x in probes if 0 <= len(x[1]) - len(some[0][0][1]) <= e], e, find, union)
        return out

    def run(batches):
        now, rows = None, []
        for b in batches:
            out = []
            for key, *row in zip(*(c.to_pylist() for c in b.columns)):
                if key != now:
                    out += links(rows)
                    now, rows = key, []
                rows.append(row)
            yield _linked(out)
        yield _linked(links(rows))

    return run


def _linked(out: list[tuple[int, int]]):
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["u", "v"])


def _refined(heavy: DataFrame, buckets: int, edits: int, per_edit: int, limit: int) -> DataFrame:
    """Links among lines that share a frequent segment.

    What is left of two such lines without the shared segment is again at most ``edits`` apart. The lines of a key are
    compared in one task if they are ``limit`` at most; else what all of them begin and end with is cut off, and they
    are dealt out under the key so far by segments of the rest. That goes on until all groups are small enough or their
    rests too short to be cut; such a group is dealt out in blocks of index entries times blocks of probes.
    """

    def first(batches):
        for b in batches:
            kind, bucket, key, line = (b.column(c).to_numpy(zero_copy_only=False) for c in ("kind", "bucket", "key", "line"))
            body, out, at = b.column("body").to_pylist(), [], 0
            for part in _chunks(body):
                which, role, k, start, size, more = entries(part, edits, per_edit)
                row = which + at
                mine = (role == kind[row]) & (k % np.uint64(buckets) == bucket[row].astype(np.uint64)) & (k >> np.uint64(32) == key[row].astype(np.uint64))
                for i in np.flatnonzero(mine).tolist():
                    x, s = body[row[i]], int(start[i])
                    out.append((int(k[i : i + 1].view(np.int64)[0]), int(line[row[i]]), int(role[i]), x, x[:s] + x[s + int(size[i]) :], int(more[i])))
                at += len(part)
            yield _batch(out)

    def again(batches):
        digest = xxhash.xxh64_intdigest
        for b in batches:
            out = []
            for key, line, role, body, rest, more, head, tail in zip(*(c.to_pylist() for c in b.columns)):
                rest = rest[head : len(rest) - tail]
                n = len(rest)
                e = budget(len(body) - more, edits, per_edit)
                places = ((k, at, size) for k, (at, size) in enumerate(segments(n, e))) if role == INDEX else windows(n, n - more, e)
                for k, at, size in places:
                    new = digest(f"{key}/{k}/{n - more}/{rest[at : at + size]}")
                    out.append((new - (1 << 64) if new >> 63 else new, line, role, body, rest[:at] + rest[at + size :], more))
            yield _batch(out)

    rows, small = materialize(heavy.select("kind", "bucket", "key", "line", "body").mapInArrow(first, REST), "rest"), []
    while True:
        back = F.reverse("rest")
        size = rows.groupBy("key").agg(
            F.count_if(F.col("role") == INDEX).alias("i"), F.count_if(F.col("role") == PROBE).alias("p"),
            F.min("rest").alias("least"), F.max("rest").alias("most"), F.min(back).alias("least_back"), F.max(back).alias("most_back"),
            F.min(F.length("rest")).alias("shortest"), F.max(F.length("rest")).alias("longest"),
        )
        size = materialize(size.where("i > 0 AND p > 0"), "sizes")
        small.append(rows.join(size.where(f"i + p <= {limit}").select("key"), "key"))
        big = size.where(f"i + p > {limit}")
        if big.isEmpty():
            break
        cut = materialize(big.mapInPandas(_affix_frames, "key long, i long, p long, head int, tail int, longest int"), "affixes")
        short = cut.where(f"longest - head - tail <= {2 * edits + 1}")
        blocks = rows.join(F.broadcast(short) if short.count() <= 10_000 else short, "key")
        wide = F.when(F.col("role") == INDEX, F.ceil(F.col("p") / limit)).otherwise(F.ceil(F.col("i") / limit))
        own = F.pmod(F.xxhash64("line", "rest"), F.when(F.col("role") == INDEX, F.ceil(F.col("i") / limit)).otherwise(F.ceil(F.col("p") / limit)))
        blocks = blocks.select("*", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), wide - 1)).alias("other"))
        name = F.when(F.col("role") == INDEX, F.xxhash64("key", "own", "other")).otherwise(F.xxhash64("key", "other", "own"))
        small.append(blocks.select(name.alias("key"), "line", "role", "body", "rest", "more"))
        deeper = rows.join(cut.where(f"longest - head - tail > {2 * edits + 1}").select("key", "head", "tail"), "key")
        rows = materialize(deeper.mapInArrow(again, REST).distinct(), "rest")
    together = small[0]
    for x in small[1:]:
        together = together.unionByName(x)
    return together.repartition(buckets, "key").sortWithinPartitions("key").mapInArrow(_compare(edits, per_edit), LINKS)


def _affix_frames(frames):
    for f in frames:
        found = [affixes(*x) for x in zip(f["least"], f["most"], f["least_back"], f["most_back"], f["shortest"])]
        f["head"], f["tail"] = [x[0] for x in found], [x[1] for x in found]
        yield f[["key", "i", "p", "head", "tail", "longest"]]


def _batch(out: list[tuple]):
    types = (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate(types)], ["key", "line", "role", "body", "rest", "more"])


def line_classes(docs: DataFrame, text_col: str = "text", edits: int = EDITS, per_edit: int = PER_EDIT, group: int = GROUP) -> DataFrame:
    """``id, row, nr, class, kept`` for each line that is alike another: its document, number, class and whether it is the class's first.

    A class has the name of its least line hash. The first line is that of least doc_id (null last), then text hash and
    number. Documents that repeat with id and text count once. Lines are told apart by 96 bits of two hashes.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    links, linked = similar_lines(docs.select("doc_id", text_col), text, edits, per_edit, group=group)
    roots = star_components(links)
    roots = materialize(roots.join(linked, roots["node"] == linked["line"]).select("node", F.col("check").alias("its"), "root"), "roots")
    at = corpus_lines(docs, text).withColumn("check", F.hash("body")).drop("body")
    at = at.join(roots, (at["line"] == roots["node"]) & (at["check"] == roots["its"]), "left")
    at = at.select("id", "row", "nr", F.coalesce("root", "line").alias("class"), F.when(F.col("root").isNull(), F.col("check")).alias("check"))
    at = materialize(at, "lines")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "row", "nr")
    first = at.groupBy("class", "check").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last")
    first = materialize(first.select(F.col("class").alias("of"), F.col("check").alias("by"), "first"), "first")
    same = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("row") == F.col("first.row")) & (F.col("nr") == F.col("first.nr"))
    of = (at["class"] == first["of"]) & at["check"].eqNullSafe(first["by"])
    return at.join(first, of).select("id", "row", "nr", "class", same.alias("kept"))


def dedup_lines(docs: DataFrame, text_col: str = "text", edits: int = EDITS, per_edit: int = PER_EDIT, group: int = GROUP) -> DataFrame:
    """``docs`` with all columns, their texts without repeated lines, and ``__ld_lines``: array of (nr, class, kept) of the lines that are alike others.

    Every row stays, also one whose lines all go (its text is then empty); null texts stay null, and texts without
    repeated lines stay as they are. Blank lines are left alone, and lines of under ``per_edit`` characters match only
    exactly. Empty tables, null ids, repeated rows and very long texts are taken as they come.
    """
    found = line_classes(docs, text_col, edits, per_edit, group)
    by_doc = found.groupBy(F.col("id").alias("__ld_id"), F.col("row").alias("__ld_row"))
    by_doc = by_doc.agg(F.array_sort(F.collect_set(F.struct("nr", "class", "kept"))).alias("__ld_lines"))
    by_doc = materialize(by_doc.withColumn("__ld_drop", F.expr("transform(filter(__ld_lines, x -> NOT x.kept), x -> x.nr)")), "bydoc")
    mine = docs["doc_id"].cast("long").eqNullSafe(by_doc["__ld_id"]) & (text_hash(docs[text_col]) == by_doc["__ld_row"])
    joined = docs.join(by_doc, mine, "left").drop("__ld_id", "__ld_row")
    stay = f"filter(split(`{text_col}`, '\\n', -1), (x, i) -> NOT array_contains(__ld_drop, i))"
    less = F.expr(f"CASE WHEN size(__ld_drop) > 0 THEN array_join({stay}, '\\n') ELSE `{text_col}` END")
    return joined.withColumn(text_col, less).drop("__ld_drop")
