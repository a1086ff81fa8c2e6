"""Best-fit packing of tokenized documents into sequences, in bulk-synchronous rounds.

Pieces are range-sorted by length, and a piece's rank among those of its length is found from per-partition counts.
Pieces of one length are alike, and so are gaps of one size: both are kept as runs (a size and how many), at most one
for each number below the capacity. A round takes the longest length left: its successor among the gaps, the least one
that fits, goes to its pieces in order of rank; the gaps shrink; then the next gap or length follows. So the rounds are
those of best-fit decreasing, the plan is bounded by the capacity and not by the data, and each piece finds its place
by its length and rank.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict, deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import id_and_bytes, materialize, partitions
from .tokens import encoder

CAPACITY = 1024
END = 2
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
RANKED = PIECES + ", part int, nth long"
PLACED = PIECES + ", sequence_id long, offset long"


def split(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n tokens: full ones, but that the first may be shorter."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def tokenize(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` for each piece; the text's ids are followed by the end id.

    The vocabulary file is read by the driver and broadcast (a file of a few MB), so executors need no path to it.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        held = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        encode = encoder(held.value).encode
        for b in batches:
            out = []
            for doc, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = np.append(encode(body.decode("utf-8", "replace")), np.uint32(END)).astype("<u4")
                out += [(doc, k, at, n, zlib.crc32(ids[at : at + n])) for k, (at, n) in enumerate(split(len(ids), capacity))]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * 5, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return id_and_bytes(docs, id_col, text_col).mapInArrow(run, PIECES)


def _rank(batches):
    """Number each row among those of its length in this partition."""
    part, seen = TaskContext.get().partitionId(), defaultdict(int)
    for b in batches:
        length = b.column(3).to_numpy()
        order = np.argsort(length, kind="stable")
        sizes, first, count = np.unique(length[order], return_index=True, return_counts=True)
        before = np.array([seen[s] for s in sizes.tolist()], dtype=np.int64)
        nth = np.empty(len(length), np.int64)
        nth[order] = np.arange(len(length)) + np.repeat(before - first, count)
        for s, c in zip(sizes.tolist(), count.tolist()):
            seen[s] += c
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(length), part, np.int32)), pa.array(nth)], names=[*b.schema.names, "part", "nth"])


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Best fit for so many pieces of each length: rows (length, first rank, pieces, first sequence, offset) and the number of sequences.

    The pieces of a row go to consecutive sequences, each to the row's offset.
    """
    gaps: dict[int, deque] = defaultdict(deque)  # size: runs of (first sequence, sequences)
    open_, rows, made = [], [], 0
    for length in sorted(counts, reverse=True):
        done, total = 0, counts[length]
        while done < total:
            at = bisect_left(open_, length)
            gap = open_[at] if at < len(open_) else capacity
            each = gap // length
            wanted = -(-(total - done) // each)
            if at < len(open_):
                first, n = gaps[gap].popleft()
                taken = min(n, wanted)
                if taken < n:
                    gaps[gap].appendleft((first + taken, n - taken))
                if not gaps[gap]:
                    open_.pop(at)
            else:
                first, taken, made = made, wanted, made + wanted
            placed = min(total - done, taken * each)
            for k in range(each):  # the k-th piece of each sequence; the last sequence may get fewer
                n = placed // each + (k < placed % each)
                if n:
                    rows.append((length, done, n, first, capacity - gap + k * length))
                    done += n
            whole, rest = divmod(placed, each)
            for lo, n, used in ((first, whole, each), (first + whole, 1 if rest else 0, rest)):
                left = gap - used * length
                if n and left:
                    if not gaps[left]:
                        insort(open_, left)
                    gaps[left].append((lo, n))
    return np.array(rows, dtype=np.int64).reshape(-1, 5), made


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``. Full pieces are a sequence each, with negative numbers."""
    spark = pieces.sparkSession
    pieces = materialize(pieces, "pieces")
    part = pieces.where(F.col("length") < capacity)
    n = max(partitions(spark), part.count() // 2_000_000)
    ranged = part.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(n, "length", "__tie").drop("__tie")
    ranked = materialize(ranged.mapInArrow(_rank, RANKED), "ranked")
    # As rows are range-sorted, a partition and a length meet in at most so many rows as there are partitions and lengths together.
    found = ranked.groupBy("part", "length").count().orderBy("length", "part").toPandas()
    key = found["part"].to_numpy(np.int64) * (capacity + 1) + found["length"].to_numpy(np.int64)
    base = (found.groupby("length")["count"].cumsum() - found["count"]).to_numpy(np.int64)
    order = np.argsort(key)
    rows, _ = plan({int(k): int(v) for k, v in found.groupby("length")["count"].sum().items()}, capacity)
    run_key = (rows[:, 0] << 50) + rows[:, 1]
    by_run = np.argsort(run_key)
    held = spark.sparkContext.broadcast((key[order], base[order], run_key[by_run], rows[by_run]))

    def place(batches):
        keys, bases, run_keys, runs = held.value
        for b in batches:
            length, at = b.column(3).to_numpy(), b.column(5).to_numpy().astype(np.int64)
            rank = bases[np.searchsorted(keys, at * (capacity + 1) + length)] + b.column(6).to_numpy()
            run = runs[np.searchsorted(run_keys, (length << 50) + rank, side="right") - 1]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(run[:, 3] + rank - run[:, 1]), pa.array(run[:, 4])], names=[*b.schema.names[:5], "sequence_id", "offset"])

    whole = pieces.where(F.col("length") >= capacity).withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    return ranked.mapInArrow(place, PLACED).unionByName(whole)


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row for each piece of each row of ``docs``.

    Null and empty texts are the end id alone; repeated rows are packed each; rows without doc_id keep a null one; an
    empty table gives an empty result; other columns are ignored.
    """
    return pack(tokenize(docs, tokenizer_path, id_col, text_col, capacity), capacity)
