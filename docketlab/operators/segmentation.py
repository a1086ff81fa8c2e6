"""Page sequences cut into documents."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F


def previous_tail(pages: DataFrame, doc: str, page: str, text: str, lines: int = 5) -> DataFrame:
    """With ``previous``: the last lines of the page before."""
    before = F.lag(text).over(W.partitionBy(doc).orderBy(page))
    rows = F.split(before, "\n")
    return pages.withColumn("previous", F.array_join(F.slice(rows, F.greatest(F.size(rows) - lines + 1, F.lit(1)), lines), "\n"))


def segments(pages: DataFrame, doc: str, page: str, continuation: Column) -> DataFrame:
    """With ``segment`` from 1: a page begins one unless it continues and is not the first."""
    w = W.partitionBy(doc).orderBy(page)
    start = F.when((F.row_number().over(w) > 1) & F.coalesce(continuation, F.lit(False)), 0).otherwise(1)
    return pages.withColumn("__s", start).withColumn("segment", F.sum("__s").over(w.rowsBetween(W.unboundedPreceding, 0)).cast("int")).withColumnRenamed("__s", "is_start")


def contents(segmented: DataFrame, doc: str, page: str) -> DataFrame:
    """One entry for each segment: first and last page and how many."""
    return segmented.groupBy(doc, "segment").agg(F.min(page).alias("start_page"), F.max(page).alias("end_page"), F.count("*").alias("n_pages"))


def history_text(done: list[tuple], current: tuple | None, pages: list[tuple], recent: int) -> str:
    """What is known so far: closed segments as one line each, and the last pages one by one."""
    lines = [f"Pages {a}-{b}: {kind}" for a, b, kind in done]
    if current:
        lines.append(f"Current from page {current[0]}: {current[2]}")
    return "\n".join(lines + [f"Page {p}: {meta}" for p, meta in pages[-recent:]])


#: Takes (text, history, previous tail) and gives (document type, continuation).
Classifier = Callable[[str, str, str], tuple[str, bool]]


def by_first_line(text: str, history: str, previous: str) -> tuple[str, bool]:
    """Offline classifier: a page continues unless its first line is in capitals."""
    first = next((x for x in text.splitlines() if x.strip()), "")
    return first.strip()[:40], not (first.isupper() or not previous)


def fold_pages(pages: DataFrame, doc: str, page: str, text: str, classify: Classifier = by_first_line, use_history: bool = True, use_context: bool = True, recent: int = 15) -> DataFrame:
    """``doc, page, document_type, continuation``: each page judged in order, with what came before it.

    A document's pages are judged one after another by nature; documents are spread over the tasks.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        done, current, seen, tail, out = [], None, [], "", []
        pdf = pdf.sort_values("page")
        texts = pdf["text"].fillna("").tolist() if pdf["text"].fillna("").str.strip().str.len().max() >= 150 else []
        for nr, t in zip(pdf["page"].tolist(), texts):
            kind, goes_on = classify(t, history_text(done, current, seen, recent) if use_history else "", tail if use_context else "")
            if goes_on and current:
                current = (current[0], nr, current[2])
            else:
                if current:
                    done.append(current)
                current = (nr, nr, kind)
            seen = [*seen, (nr, kind)][-recent:]
            tail = "\n".join(t.splitlines()[-5:])
            out.append((pdf["doc"].iloc[0], nr, kind, bool(goes_on)))
        return pd.DataFrame(out, columns=["doc", "page", "document_type", "continuation"])

    rows = pages.select(F.col(doc).cast("string").alias("doc"), F.col(page).cast("long").alias("page"), F.col(text).alias("text"))
    return rows.groupBy("doc").applyInPandas(run, "doc string, page long, document_type string, continuation boolean")


def boundary_prf(gold: DataFrame, predicted: DataFrame, keys: list[str]) -> DataFrame:
    """Measures of where documents begin (``label`` 1 against ``is_start`` 1), on the pages that both have."""
    from .metrics import binary_prf

    both = gold.join(predicted, keys)
    return binary_prf(both, F.col("is_start") == 1, F.col("label") == 1)
