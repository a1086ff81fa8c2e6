"""A bounded sample of labelled documents to learn from."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def fold(modulus: int):
    """crc32 of the doc_id as text, modulo ``modulus`` (null ids: as the text "null")."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary")), F.lit(modulus))


def label_sample(labels: DataFrame, column: str, allowed, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """``id, label`` of at most ``per_class`` labelled ids of each class, by hash order, and how many there are of each.

    An id that is labelled repeatedly has the larger label; rows without id or label are left out.
    """
    one = labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1)).where(allowed)
    one = one.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(F.col(column).cast("int")).alias("label"))
    sizes = {r["label"]: r["count"] for r in one.groupBy("label").count().collect()}
    parts = [by_hash(one.where(F.col("label") == k), F.xxhash64("id"), sizes.get(k, 0), per_class) for k in (0, 1)]
    return parts[0].unionByName(parts[1]), {k: sizes.get(k, 0) for k in (0, 1)}


def by_hash(rows: DataFrame, hashed, size: int, n: int) -> DataFrame:
    """``n`` of ``size`` rows, those of least hash.

    Rows are first held against the hash below which four times as many are expected, so what is sorted, and what meets
    in one task, is bounded whatever the table's size.
    """
    part = F.pmod(hashed, F.lit(1 << 40))
    some = rows.where(part < int((1 << 40) * min(1.0, 4 * n / size))) if size > 4 * n else rows
    return some.orderBy(part, *some.columns).limit(n)
