"""The queries of this subpackage: each applies one operator to its whole table and shapes the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat, decontaminate, html_extract, line_dedup, packing, quality_model, quality_rules, sharding, simhash, toxicity
from .common import table
from .labelled import fold


def op1_suffix_array_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


#: Windows that fit in no document are no rows of ``hits``; translate() lower-cases A-Z alone.
OP1_SQL = r"""
WITH low AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS a, 'abcdefghijklmnopqrstuvwxyz' AS b),
d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), a, b), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents, low),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), a, b), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark, low),
iw AS (SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[k : k + least(10, len(w)) - 1], ' ') AS t
       FROM i, LATERAL (SELECT unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS k) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT r, k, n, array_to_string(w[k : k + n - 1], ' ') AS t FROM d, sizes, LATERAL (SELECT unnest(generate_series(1, len(w) - n + 1)) AS k)),
hits AS (SELECT r, k, n, item FROM dw JOIN iw USING (n, t)),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT r, k, n FROM hits), LATERAL (SELECT unnest(generate_series(k, k + n - 1)) AS p) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
"""


def op6_quality_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_model.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", (fold(quality_model.HELD_OUT_OF) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("text").alias("before"))
    found = line_dedup.dedup_lines(docs)
    lines = F.coalesce(F.col("__ld_lines"), F.expr("cast(array() as array<struct<nr:int,class:bigint,kept:boolean>>)"))
    n = F.size(F.split(F.coalesce("before", F.lit("")), "\n", -1))
    return found.select("doc_id", n.alias("n_lines"), F.size(F.filter(lines, lambda x: ~x["kept"])).alias("n_dropped"), lines.alias("lines"), "text")


def op8_simhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_chat_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair(table(spark, sf_dir, "conversations"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op4_vector_bin_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.assign(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.assess(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior", "n_against")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_toxicity_nearest_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", (fold(toxicity.HELD_OUT_OF) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_array_decontamination": op1_suffix_array_decontamination,
    "op2_chat_role_repair": op2_chat_role_repair,
    "op3_html_extraction": op3_html_extraction,
    "op4_vector_bin_packing": op4_vector_bin_packing,
    "op5_quality_rules": op5_quality_rules,
    "op6_quality_rule_ensemble": op6_quality_rule_ensemble,
    "op7_line_dedup": op7_line_dedup,
    "op8_simhash_near_dup": op8_simhash_near_dup,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_toxicity_nearest_examples": op10_toxicity_nearest_examples,
}

ORACLES: dict[str, str] = {"op1_suffix_array_decontamination": OP1_SQL}
