"""Stateful page segmentation, resumable runs, and windows over event streams."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.segmentation import by_first_line, history_text


class PageFold(StatefulProcessor):
    """Judges a document's pages as they come; the state is what the batch fold carries from page to page."""

    def __init__(self, classify=by_first_line, recent: int = 15):
        self.classify, self.recent = classify, recent

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.now = handle.getValueState("now", "start long, stop long, kind string, tail string")
        self.done = handle.getListState("done", "start long, stop long, kind string")
        self.seen = handle.getListState("seen", "page long, kind string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows)).sort_values("page")
        current, tail = None, ""
        if self.now.exists():
            start, stop, kind, tail = self.now.get()
            current = (start, stop, kind)
        done, seen, out = list(self.done.get()), list(self.seen.get()), []
        for nr, text in zip(pdf["page"].tolist(), pdf["text"].fillna("").tolist()):
            kind, goes_on = self.classify(text, history_text(done, current, seen, self.recent), tail)
            if goes_on and current:
                current = (current[0], nr, current[2])
            else:
                if current:
                    done.append(current)
                current = (nr, nr, kind)
            seen = [*seen, (nr, kind)][-self.recent :]
            tail = "\n".join(text.splitlines()[-5:])
            out.append((key[0], nr, kind, bool(goes_on)))
        self.now.update((*current, tail))
        self.done.put(done)
        self.seen.put(seen)
        yield pd.DataFrame(out, columns=["doc", "page", "document_type", "continuation"])

    def close(self) -> None:
        pass


def fold_page_stream(pages: DataFrame, classify=by_first_line, recent: int = 15) -> DataFrame:
    """Stream of (doc, page, text) to judged pages; needs the RocksDB state store."""
    return pages.groupBy("doc").transformWithStateInPandas(PageFold(classify, recent), "doc string, page long, document_type string, continuation boolean", "Append", "None")


def run_resumable(stream: DataFrame, process: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Process what is there in batches and stop; a second run goes on where the first ended."""

    def each(batch: DataFrame, number: int) -> None:
        # The batch's number is part of the path, so a batch that is repeated after a failure replaces itself.
        process(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def tumbling(events: DataFrame, ts: str, width: str, *keys: str, late: str | None = None, values: dict[str, Column] | None = None) -> DataFrame:
    """Counts (and other aggregates by name) in windows of fixed width; ``late`` is the watermark of a stream. An extension."""
    rows = events.withColumn(ts, F.col(ts).cast("timestamp"))
    rows = rows.withWatermark(ts, late) if late else rows
    made = [c.alias(k) for k, c in (values or {}).items()]
    return rows.groupBy(F.window(ts, width).alias("w"), *keys).agg(F.count("*").alias("n"), *made).select(F.col("w.start").alias("start"), *keys, "n", *(values or {}))


def sessions(events: DataFrame, ts: str, gap: str, *keys: str, late: str | None = None) -> DataFrame:
    rows = events.withColumn(ts, F.col(ts).cast("timestamp"))
    rows = rows.withWatermark(ts, late) if late else rows
    return rows.groupBy(F.session_window(ts, gap).alias("w"), *keys).agg(F.count("*").alias("n")).select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
