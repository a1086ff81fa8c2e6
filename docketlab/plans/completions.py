"""Stages that ask a model: each distinct prompt once, through a cache, by a provider that may be exchanged."""

from __future__ import annotations

import hashlib
import re
import time
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.extract import answer_indices
from ..functions.text import prompt_key
from .scratch import written

#: Takes a prompt and gives its answer; it is made anew in each task.
Provider = Callable[[], Callable[[str], str]]
#: Words of errors after which a call is repeated.
RETRY_WORDS = ("rate limit", "timeout", "timed out", "overloaded", "connection", "429", "500", "502", "503", "504")


def is_retryable(error: Exception) -> bool:
    return any(w in str(error).lower() for w in RETRY_WORDS)


def offline() -> Callable[[str], str]:
    """Provider without a model: the first line of the prompt that has text, or the numbers 0, 1, ... for selections."""

    def answer(prompt: str) -> str:
        return next((x.strip() for x in prompt.splitlines() if x.strip()), "")

    return answer


@dataclass(frozen=True)
class Retry:
    tries: int = 4
    first_wait: float = 1.0
    longest_wait: float = 20.0


def call(answer: Callable[[str], str], prompt: str, retry: Retry) -> tuple[str | None, str | None]:
    """The answer or the error of the last try."""
    wait = retry.first_wait
    for k in range(retry.tries):
        try:
            return answer(prompt), None
        except Exception as e:
            if k + 1 == retry.tries or not is_retryable(e):
                return None, f"{type(e).__name__}: {e}"
            time.sleep(wait)
            wait = min(retry.longest_wait, 2 * wait)
    return None, "no try"


ANSWERS = "key string, prompt string, answer string, error string, tokens_in long, tokens_out long"


def complete(df: DataFrame, prompt: Column, provider: Provider = offline, model: str = "offline", cache: DataFrame | None = None, retry: Retry = Retry(), valid: Column | None = None, name: str = "answer") -> DataFrame:
    """``df`` with ``name`` (null on failure), and ``name`` with ``_error``.

    Prompts are made distinct before the provider is called and answers joined back; those in ``cache`` (``key,
    answer``) are not asked again. ``valid`` is a test over ``answer``: answers that fail it count as errors.
    """
    keyed = df.withColumn("__prompt", prompt).withColumn("__key", prompt_key(F.lit(model).alias("model"), F.col("__prompt").alias("prompt")))
    wanted = keyed.select(F.col("__key").alias("key"), F.col("__prompt").alias("prompt")).distinct()
    if cache is not None:
        wanted = wanted.join(cache.select("key"), "key", "left_anti")

    def run(batches):
        answer = provider()
        for b in batches:
            out = [(k, p, *call(answer, p or "", retry)) for k, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            columns = [pa.array([x[i] for x in out], pa.string()) for i in range(4)]
            tokens = [pa.array([len((x[i] or "").split()) for x in out], pa.int64()) for i in (1, 2)]
            yield pa.RecordBatch.from_arrays([*columns, *tokens], ["key", "prompt", "answer", "error", "tokens_in", "tokens_out"])

    got = written(wanted.mapInArrow(run, ANSWERS), "answers")
    ok = F.coalesce(valid if valid is not None else F.lit(True), F.lit(False))
    fresh = got.select("key", F.when(ok, F.col("answer")).alias("answer"), F.coalesce("error", F.when(~ok, F.lit("invalid answer"))).alias("error"))
    if cache is not None:
        fresh = fresh.unionByName(cache.select("key", "answer", F.lit(None).cast("string").alias("error")))
    fresh = fresh.withColumnsRenamed({"key": "__key", "answer": name, "error": f"{name}_error"})
    return keyed.join(fresh, "__key", "left").drop("__key", "__prompt")


def usage(answers: DataFrame, *keys: str) -> DataFrame:
    return answers.groupBy(*keys).agg(F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"), F.count("*").alias("calls"))


def hashed_embedding(texts: DataFrame, id_col: str, text_col: str, dims: int = 384) -> DataFrame:
    """Offline embedding: hashed word counts at length one; blank texts are zero vectors."""

    def run(batches):
        for b in batches:
            out = []
            for t in b.column(1).to_pylist():
                v = [0.0] * dims
                for w in re.findall(r"\w+", (t or "").lower()):
                    h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
                    v[h % dims] += 1.0 if h >> 63 else -1.0
                n = sum(x * x for x in v) ** 0.5
                out.append([x / n for x in v] if n else v)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.float32()))], ["id", "embedding"])

    return texts.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {dict(texts.dtypes)[id_col]}, embedding array<float>")


def filtered_summaries(df: DataFrame, key: str, order: str, text: str, most: int, chunk: int = 4, pick: int = 2, provider: Provider | None = None, backfill: bool = True) -> DataFrame:
    """Up to ``most`` important texts of each key: each chunk of four gives two, and again until few enough are left.

    Without a provider the first of each chunk are taken. Rounds are few, as each halves what is left.
    """
    w = F.row_number().over(_window(key, order)) - 1
    rows = df.select(key, order, text).withColumn("__nr", w)
    while True:
        counted = rows.groupBy(key).agg(F.count("*").alias("__n"))
        if counted.where(F.col("__n") > most).isEmpty():
            return rows.drop("__nr")
        rows = rows.join(counted, key).withColumn("__c", F.floor(F.col("__nr") / chunk)).withColumn("__i", F.col("__nr") % chunk)
        if provider is None:
            kept = rows.where((F.col("__n") <= most) | (F.col("__i") < pick))
        else:
            prompts = rows.groupBy(key, "__c").agg(F.concat_ws("\n", F.transform(F.array_sort(F.collect_list(F.struct("__i", text))), lambda x: F.concat(x["__i"].cast("string"), F.lit(": "), x[text]))).alias("__p"))
            asked = complete(prompts, F.col("__p"), provider, name="__a").withColumn("__pick", answer_indices("__a", chunk, pick))
            if backfill:
                asked = asked.withColumn("__pick", F.slice(F.array_distinct(F.concat(F.coalesce("__pick", F.array().cast("array<int>")), F.sequence(F.lit(0), F.lit(chunk - 1)))), 1, pick))
            kept = rows.join(asked.select(key, "__c", "__pick"), [key, "__c"]).where((F.col("__n") <= most) | F.array_contains("__pick", F.col("__i").cast("int")))
        rows = written(kept.select(key, order, text, (F.row_number().over(_window(key, order)) - 1).alias("__nr")), "kept")


def _window(key: str, order: str):
    from pyspark.sql import Window

    return Window.partitionBy(key).orderBy(order)


def tree_combined(df: DataFrame, key: str, order: str, text: str, combine: Callable[[Column, Column], Column]) -> DataFrame:
    """One text for each key: neighbours are combined two by two, level by level."""
    rows = df.select(key, (F.row_number().over(_window(key, order)) - 1).alias("nr"), F.col(text).alias("t"))
    while not rows.where("nr > 0").isEmpty():
        pair = F.array_sort(F.collect_list(F.struct("nr", "t")))
        pairs = rows.groupBy(key, F.floor(F.col("nr") / 2).cast("int").alias("nr")).agg(pair.alias("p"))
        rows = written(pairs.select(key, "nr", F.when(F.size("p") > 1, combine(F.col("p")[0]["t"], F.try_element_at("p", F.lit(2))["t"])).otherwise(F.col("p")[0]["t"]).alias("t")), "level")
    return rows.select(key, F.col("t").alias(text))


def chained(df: DataFrame, steps: list[tuple[str, Column]], provider: Provider = offline) -> DataFrame:
    """Prompts one after another, each of which may use the answers before (as columns of the steps' names)."""
    for name, prompt in steps:
        df = complete(df, prompt, provider, name=name)
    return df


def dual_roles(rows: DataFrame, role: str = "agency_type", both: str = "has_dual_role") -> DataFrame:
    """Rows with both roles, once for each; others as they are."""
    roles = F.when(F.col(both), F.array(F.lit("RESPONDING"), F.lit("INVESTIGATING"))).otherwise(F.array(F.col(role)))
    return rows.withColumn(role, F.explode(roles))


def verdict(c: Column) -> Column:
    """0, 0.5 or 1 out of an answer, or null."""
    return F.regexp_extract(c, r"(?:^|[^0-9.])(0\.5|[01](?:\.0)?)(?![0-9])", 1).try_cast("double")


def says_match(c: Column) -> Column:
    return F.contains(F.upper(c), F.lit("MATCH")) & ~F.contains(F.upper(c), F.lit("NO_MATCH"))
