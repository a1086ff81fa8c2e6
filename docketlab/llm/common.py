"""Shared helpers: scratch tables in the folder that all executors see, and byte-level text tools."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.scratch import delete, discard, shared_root, written as materialize

__all__ = ["LOWER", "clean_scratch", "discard", "id_and_bytes", "materialize", "partitions", "table", "text_hash"]

#: bytes.translate table: A-Z to a-z, all else as it is.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def clean_scratch(spark: SparkSession) -> None:
    """Delete all that this application left in the shared folder; call it once its results are written."""
    delete(spark, shared_root(spark))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Two columns only, so that extra columns of any name neither clash nor get shuffled: ``doc_id`` and the text's UTF-8 bytes (null: empty)."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("body"))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_hash(text):
    """The hash that :func:`id_and_bytes` texts get from ``xxhash64``, of a text column."""
    return F.xxhash64(F.coalesce(text.cast("binary"), F.lit(b"")))
