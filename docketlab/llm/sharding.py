"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly, and equal texts stay together.

Groups of equal texts are the units. A group above an eighth of a shard is cut into chunks; small groups are placed
together, by hash of their text, so the number of units is bounded by a parameter and not by the data. Units are placed from the
largest on, each into the shard whose residual capacity has the largest dot product with it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import discard, materialize

SHARDS = 24
#: Units for each shard: groups above a shard's share by this number are placed alone, the others in as many bins.
UNITS = 256
#: Weights of bytes, tokens and rows in the dot product; the law is on bytes.
WEIGHTS = np.array([1.0, 0.1, 0.1])
#: Share of a shard up to which a group of equal texts stays whole.
WHOLE = 0.125
#: Rows of one counting task of the slots.
SLOT_ROWS = 500_000


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, tokens, text_crc32, h1, h2`` for every row; two hashes tell texts apart. Null texts are empty."""
    body = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(body) + 8).cast("long").alias("size"), F.regexp_count(body, F.lit(r"\S++")).cast("long").alias("tokens"),
        F.crc32(body.cast("binary")).alias("text_crc32"), F.xxhash64(body).alias("h1"), F.xxhash64(body, F.lit(1)).alias("h2"),
    )


def place(units: np.ndarray, shards: int = SHARDS, weights: np.ndarray = WEIGHTS) -> np.ndarray:
    """The shard of each unit (a row of bytes, tokens, rows); the order is by weighted share, largest first, then as given."""
    total = np.maximum(units.sum(axis=0), 1)
    share = units * shards / total
    residual = np.ones((shards, units.shape[1]))
    out = np.zeros(len(units), np.int64)
    for k in np.argsort(-(share @ weights), kind="stable").tolist():
        to = int((residual @ (weights * share[k])).argmax())
        out[k] = to
        residual[to] -= share[k]
    return out


def assign(docs: DataFrame, shards: int = SHARDS, units: int = UNITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, h1, h2, shard, slot`` for every row of ``docs``.

    ``slot`` counts a shard's rows from 0 without gaps. Null texts are empty ones of size 8; repeated rows are placed
    each, with their text's group; null ids are kept; an empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = materialize(sizes(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "sizes")
    measures = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    whole = rows.agg(*measures).first()
    bins = shards * units
    shares = [F.col(c) * bins / max(1, whole[c] or 0) for c in ("bytes", "tokens", "rows")]
    groups = rows.groupBy("h1", "h2").agg(*measures)
    # Each measure's total allows fewer than `bins` groups above its limit, so there are fewer than three times as many.
    large = F.greatest(*shares)
    chunks = F.greatest(F.lit(1), F.least(F.col("rows"), F.ceil(large / (WHOLE * units)))).cast("int")
    heavy = materialize(groups.where(large > 1).select("h1", "h2", chunks.alias("chunks")), "heavy")
    keyed = rows.join(F.broadcast(heavy), ["h1", "h2"], "left")
    alone = F.col("chunks").isNotNull()
    keyed = keyed.withColumns({
        "u1": F.when(alone, F.col("h1")), "u2": F.when(alone, F.col("h2")),
        "nr": F.when(alone, F.pmod(F.xxhash64("row"), F.col("chunks"))).otherwise(F.pmod("h1", F.lit(bins))).cast("int"),
    })
    found = keyed.groupBy("u1", "u2", "nr").agg(*measures).orderBy("u1", "u2", "nr").collect()
    where = place(np.array([[r["bytes"], r["tokens"], r["rows"]] for r in found], dtype=float).reshape(-1, 3), shards)
    to = spark.createDataFrame([(r["u1"], r["u2"], r["nr"], int(k)) for r, k in zip(found, where)], "v1 long, v2 long, n int, shard int")
    same = F.col("u1").eqNullSafe(F.col("v1")) & F.col("u2").eqNullSafe(F.col("v2")) & (F.col("nr") == F.col("n"))
    dealt = keyed.join(F.broadcast(to), same)
    out = materialize(dealt.select("doc_id", "size", "text_crc32", "h1", "h2", "shard", "row"), "dealt")
    discard(rows)
    return _with_slots(out)


def _with_slots(rows: DataFrame) -> DataFrame:
    """Number the rows of each shard: by counters inside a partition, from the counts of the partitions before."""
    part = F.shiftright("row", 33)  # the partition is in a generated id's upper bits
    counts = rows.groupBy("shard", part.alias("part")).count()
    before = counts.withColumn("base", F.sum("count").over(W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, -1)))
    before = materialize(before.select(F.col("shard").alias("s"), F.col("part").alias("p"), F.coalesce("base", F.lit(0)).cast("long").alias("base")), "before")
    numbered = rows.repartition("shard", part).sortWithinPartitions("shard", part, "row").mapInArrow(_count, NUMBERED)
    side = before if before.count() > 1_000_000 else F.broadcast(before)
    joined = numbered.join(side, (F.col("shard") == F.col("s")) & (F.shiftright("row", 33) == F.col("p")))
    return joined.select("doc_id", "size", "text_crc32", "h1", "h2", "shard", (F.col("base") + F.col("nth")).alias("slot"))


NUMBERED = "doc_id long, size long, text_crc32 long, h1 long, h2 long, shard int, row long, nth long"


def _count(batches):
    """Number rows, which come in order of shard and former partition, within both."""
    last, seen = None, 0
    for b in batches:
        if not b.num_rows:
            continue
        key = b.column(5).to_numpy().astype(np.int64) * (1 << 31) + (b.column(6).to_numpy() >> 33)
        starts = np.flatnonzero(np.concatenate(([True], np.diff(key) != 0)))
        lengths = np.diff(np.append(starts, len(key)))
        nth = np.arange(len(key)) - np.repeat(starts, lengths)
        if key[0] == last:
            nth[: lengths[0]] += seen
        seen = int(nth[-1]) + 1
        last = key[-1]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(nth)], names=[*b.schema.names, "nth"])
