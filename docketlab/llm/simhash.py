"""SimHash near-duplicates: a binary-trie self-join over the distinct fingerprints.

Fingerprints are cut into four blocks of 16 bits. Two that differ in at most three bits agree in one block at least, so
each fingerprint is rotated to start with each block in turn and becomes part of the sub-trie below that block. Inside,
pairs of trie nodes are traversed together: differing bits accumulate, and a pair is pruned once they exceed the budget.
A sub-trie with too many fingerprints for one task is itself descended by more bits as a table of node pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..operators.graph import star_components
from .common import LOWER, id_and_bytes, materialize, partitions, text_hash

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 3
BLOCK = 16
#: Node pairs of at most so many combinations are compared outright.
LEAF = 1 << 8
#: Combinations expanded in memory at a time.
EXPAND = 1 << 20
#: Hashes whose bits are counted at a time.
CHUNK = 1 << 15
#: SQL for a fingerprint with its block ``blk`` in front.
ROTATED = f"(CASE WHEN blk = 0 THEN fp ELSE shiftleft(fp, cast(blk * {BLOCK} AS int)) | shiftrightunsigned(fp, cast(64 - blk * {BLOCK} AS int)) END)"


def fingerprint(body: bytes) -> int:
    """64-bit SimHash of whole text: bit set if it is set in over half of the shingles' hashes; no words: zero."""
    words = body.translate(LOWER).split()
    n = len(words)
    if not n:
        return 0
    digest = xxhash.xxh64_intdigest
    if n < SHINGLE_WORDS:
        return digest(b" ".join(words), SEED)
    total, ones = n - SHINGLE_WORDS + 1, np.zeros(64, np.int64)
    for at in range(0, total, CHUNK):
        part = words[at : at + CHUNK + SHINGLE_WORDS - 1]
        h = np.array([digest(b"%b %b %b" % t, SEED) for t in zip(part, part[1:], part[2:])], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, h, fp`` (a hash of the text and the fingerprint, as signed longs) for every row; no shuffle."""

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(x) for x in b.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(fp)], ["doc_id", "h", "fp"])

    return id_and_bytes(docs, id_col, text_col).withColumn("h", F.xxhash64("body")).mapInArrow(run, "doc_id long, h long, fp long")


def _bound(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """First index in each [lo, hi) whose key has the bit in mask; each range is sorted and agrees above that bit."""
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi) >> 1
        right = open_ & ((keys[np.minimum(mid, len(keys) - 1)] & mask) == 0)
        lo = np.where(right, mid + 1, lo)
        hi = np.where(open_ & ~right, mid, hi)
    return lo


def _leaf_pairs(keys, lo1, hi1, lo2, hi2, same, budget):
    """Index pairs within the budget among the combinations of each node pair, a bounded number at a time."""
    sizes = (hi1 - lo1) * (hi2 - lo2)
    at = 0
    while at < len(sizes):
        upto = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), EXPAND, side="right")))
        s = sizes[at:upto]
        which = np.repeat(np.arange(at, upto), s)
        k = np.arange(len(which)) - np.repeat(np.cumsum(s) - s, s)
        width = (hi2 - lo2)[which]
        i, j = lo1[which] + k // width, lo2[which] + k % width
        near = (np.bitwise_count(keys[i] ^ keys[j]) <= budget) & ((i < j) | ~same[which])
        yield i[near], j[near]
        at = upto


def trie_pairs(keys: np.ndarray, nodes1, nodes2, depth: np.ndarray, budget: int = MAX_BITS):
    """Yield index pairs of keys at most ``budget`` bits apart, from the given pairs of trie nodes.

    ``keys`` are uint64; each node is a range [lo, hi) of sorted keys that agree in their first ``depth`` bits; a node
    paired with itself stands for the pairs inside it.
    """
    lo1, hi1, lo2, hi2 = nodes1[0], nodes1[1], nodes2[0], nodes2[1]
    spent = np.bitwise_count(np.where(depth > 0, (keys[lo1] ^ keys[lo2]) >> (64 - np.maximum(depth, 1)).astype(np.uint64), np.uint64(0))).astype(np.int64) if len(lo1) else np.zeros(0, np.int64)
    while len(lo1):
        same = (lo1 == lo2) & (hi1 == hi2)
        live = (spent <= budget) & (hi1 > lo1) & (hi2 > lo2) & ~(same & (hi1 - lo1 < 2))
        leaf = live & (((hi1 - lo1) * (hi2 - lo2) <= LEAF) | (depth >= 64))
        yield from _leaf_pairs(keys, lo1[leaf], hi1[leaf], lo2[leaf], hi2[leaf], same[leaf], budget)
        go = live & ~leaf
        lo1, hi1, lo2, hi2, depth, spent, same = (x[go] for x in (lo1, hi1, lo2, hi2, depth, spent, same))
        if not len(lo1):
            return
        mask = np.left_shift(np.uint64(1), (63 - depth).astype(np.uint64))
        m1, m2 = _bound(keys, lo1, hi1, mask), _bound(keys, lo2, hi2, mask)
        cross = ~same  # of a node with itself, (1, 0) is (0, 1) again
        lo1, hi1, lo2, hi2, spent, depth = (
            np.concatenate(x)
            for x in (
                (lo1, m1, lo1, m1[cross]), (m1, hi1, m1, hi1[cross]), (lo2, m2, m2, lo2[cross]), (m2, hi2, hi2, m2[cross]),
                (spent, spent, spent + 1, spent[cross] + 1), (depth + 1, depth + 1, depth + 1, depth[cross] + 1),
            )
        )


def fold(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``root`` (each item's least known fellow) with the links i-j added; labels are flat again afterwards."""
    while True:
        a, b = root[i], root[j]
        if (a == b).all():
            return root
        low, high = np.minimum(a, b), np.maximum(a, b)
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]


def _join_partition(batches):
    """Links inside one partition of node-pair tasks, as a spanning forest: at most one row for each fingerprint here."""
    parts = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches if b.num_rows]
    if not parts:
        return
    blk, left, right, depth, fp = (np.concatenate(x) for x in zip(*parts))
    fp = fp.view(np.uint64)
    shift = (blk.astype(np.uint64) * np.uint64(BLOCK)) & np.uint64(63)
    keys = np.where(shift > 0, (fp << shift) | (fp >> ((np.uint64(64) - shift) & np.uint64(63))), fp)
    down = (64 - depth).astype(np.uint64)
    side = (keys >> down != left.view(np.uint64) >> down).astype(np.int8)
    order = np.lexsort((keys, side, right, left, depth, blk))
    blk, left, right, depth, side, keys, fp = (x[order] for x in (blk, left, right, depth, side, keys, fp))
    task = np.concatenate(([True], (np.diff(blk) != 0) | (np.diff(left) != 0) | (np.diff(right) != 0) | (np.diff(depth) != 0)))
    at = np.flatnonzero(task)
    ends = np.append(at[1:], len(keys))
    cut = np.add.reduceat(side == 0, at) + at  # where the second side begins
    alone = left[at] == right[at]
    both = alone | ((cut > at) & (cut < ends))
    at, ends, cut, alone = (x[both] for x in (at, ends, cut, alone))
    lo2, hi1 = np.where(alone, at, cut), np.where(alone, ends, cut)
    ids, where = np.unique(fp, return_inverse=True)
    root = np.arange(len(ids))
    for i, j in trie_pairs(keys, (at, hi1), (lo2, ends), depth[at].astype(np.int64)):
        if len(i):
            root = fold(root, where[i], where[j])
    linked = np.flatnonzero(root != np.arange(len(ids)))
    if len(linked):
        yield pa.RecordBatch.from_arrays([pa.array(ids[linked].view(np.int64)), pa.array(ids[root[linked]].view(np.int64))], ["u", "v"])


def _tasks(fps: DataFrame, heaviest: int) -> DataFrame:
    """Rows ``blk, left, right, depth, fp``: every fingerprint in each node pair that it takes part in.

    At first a node pair is a block's sub-trie with itself. One of more than ``heaviest`` fingerprints is replaced by
    the pairs of its descendants four bits below that the budget still allows, again and again.
    """
    block = F.explode(F.expr(f"sequence(0, {64 // BLOCK - 1})"))
    top = -(1 << (64 - BLOCK))
    rows = fps.select("fp", block.alias("blk")).select("blk", "fp", F.expr(ROTATED).bitwiseAND(F.lit(top)).alias("left")).select("blk", "left", F.col("left").alias("right"), F.lit(BLOCK).alias("depth"), "fp")
    done: DataFrame | None = None
    key = ["blk", "left", "right", "depth"]
    while True:
        on_left = F.expr(f"shiftrightunsigned({ROTATED}, cast(64 - depth AS int)) = shiftrightunsigned(left, cast(64 - depth AS int))")
        size = rows.groupBy(*key).agg(F.count("*").alias("n"), F.count_if(on_left).alias("n_left")).where("depth < 64").where(F.col("n") > heaviest)
        heavy = materialize(size.select(*key, F.expr("left = right OR n_left BETWEEN 1 AND n - 1").alias("both")), "heavy")
        if heavy.isEmpty():
            return rows if done is None else done.unionByName(rows)
        light = rows.join(heavy, key, "left_anti")
        done = light if done is None else done.unionByName(light)
        rows = materialize(_descend(rows.join(heavy.where("both"), key, "left_semi")), "descend")


def _descend(rows: DataFrame, bits: int = 4) -> DataFrame:
    """Each node pair's rows, dealt to the pairs of its nodes' descendants ``bits`` further down that may still match."""
    step = F.expr(f"CAST(shiftrightunsigned(key, cast({64 - bits} - depth AS int)) & {(1 << bits) - 1} AS int)")
    shifted = rows.withColumn("key", F.expr(ROTATED)).withColumn("mine", step)
    prefix = lambda c: f"shiftrightunsigned({c}, cast(64 - depth AS int))"
    other = shifted.withColumn("on_left", F.expr(f"{prefix('key')} = {prefix('left')}")).withColumn("theirs", F.explode(F.expr(f"sequence(0, {(1 << bits) - 1})")))
    ok = other.where(F.expr(f"bit_count(left ^ right) + bit_count(mine ^ theirs) <= {MAX_BITS}"))
    child = lambda node, c: f"{node} | shiftleft(cast({c} AS bigint), cast({64 - bits} - depth AS int))"
    alone = "left = right"
    a = F.expr(f"CASE WHEN {alone} THEN {child('left', 'least(mine, theirs)')} WHEN on_left THEN {child('left', 'mine')} ELSE {child('left', 'theirs')} END")
    b = F.expr(f"CASE WHEN {alone} THEN {child('right', 'greatest(mine, theirs)')} WHEN on_left THEN {child('right', 'theirs')} ELSE {child('right', 'mine')} END")
    return ok.select("blk", a.alias("left"), b.alias("right"), (F.col("depth") + bits).cast("int").alias("depth"), "fp")


def components(prints: DataFrame, heaviest: int = 200_000, rows_per_task: int = 1_000_000) -> DataFrame:
    """``prints`` has ``doc_id, fp``; returns ``fp, component_id`` with one row for each distinct fingerprint.

    Copies share a fingerprint and so are joined once. ``component_id`` is the least doc_id reachable over links of at
    most three bits. No pair, component or fingerprint goes to the driver.
    """
    spark = prints.sparkSession
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "prints")
    tasks = _tasks(distinct.select("fp"), heaviest)
    n = max(partitions(spark), distinct.count() * (64 // BLOCK) // rows_per_task)
    links = tasks.repartition(n, "blk", "left", "right").mapInArrow(_join_partition, "u long, v long")
    roots = star_components(links)
    least = roots.join(distinct, roots.node == distinct.fp).groupBy("root").agg(F.min("first").alias("component_id"))
    linked = roots.join(least, "root").select(F.col("node").alias("fp"), "component_id")
    return materialize(distinct.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "first").alias("component_id")), "components")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for every row of ``docs``: ``doc_id, h, fp, component_id``.

    Null or wordless texts have fingerprint zero and are linked like any other; repeated rows stay, each with the same
    component; rows without doc_id take part, but give no component its name (all without: null). An empty table gives
    an empty result, and columns other than the two named are ignored.
    """
    prints = materialize(fingerprints(docs, id_col, text_col), "docprints")
    return prints.join(components(prints), "fp").select("doc_id", "h", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each component stays, the one of least doc_id, with all its columns.

    Rows without doc_id stay only where no row of their component has one. Rows that repeat both doc_id and text are
    reduced to one; rows that share a doc_id only are judged each by its own text.
    """
    found = near_duplicates(docs)
    best = materialize(found.where("doc_id <=> component_id").groupBy("doc_id", "h").count(), "kept")
    best = best.withColumnsRenamed({"doc_id": "__nd_id", "h": "__nd_h", "count": "__nd_n"})
    mine = (docs["doc_id"].eqNullSafe(best["__nd_id"])) & (text_hash(docs["text"]) == best["__nd_h"])
    once = docs.join(best, mine, "left_semi")
    return once if best.where("__nd_n > 1").isEmpty() else once.dropDuplicates(["doc_id", "text"])
