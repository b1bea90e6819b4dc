"""Which page sequences are complete, as a stream with state per sequence.

Pages arrive in any order and more than once. The state of a sequence (run and code)
holds the ranges of page numbers seen and the lowest page that ends it, so it grows
with the gaps of a sequence and not with its pages. A sequence is reported as complete
once no page up to its stop is missing; one that stays incomplete is reported with its
gaps when event time has passed its last page by a delay. State is kept in RocksDB and
in the checkpoint, so a restarted stream goes on where it was. Pages that arrive later
than that count nowhere here; ``page_ranges`` over the landed pages has the last word.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..sources.landed import page_records, total_pages
from ..sources.page_order import SEQUENCE, ends_sequence

DELAY = "1 hour"
EVENTS = "run_id string, catmat string, event string, page bigint, last_page bigint"
_STATE = "ranges string, stop bigint, told boolean, due bigint"
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def page_arrivals(pages: DataFrame, page_size: int = 500) -> DataFrame:
    """Readable pages of a stream with ``landed_at``: number and whether they end their
    sequence."""
    body = F.try_parse_json("body")
    counted = pages.withColumn("__body", body).filter("__body IS NOT NULL AND page >= 1").select(
        *SEQUENCE,
        F.col("page").cast("long").alias("page"),
        "landed_at",
        F.size(page_records(F.col("__body"))).alias("records"),
        total_pages(F.col("__body")).alias("declared_pages"),
    )
    return counted.withColumn("ends", ends_sequence(page_size)).select(*SEQUENCE, "page", "landed_at", "ends")


def _packed(arrived: DataFrame) -> DataFrame:
    """Arrivals as few plain columns: Spark hands each column of each sequence to Python
    on its own, which takes longer than what is done with it. A page is twice its number,
    and one more if it ends its sequence."""
    ends = F.coalesce("ends", F.lit(False)).cast("long")
    return arrived.select(
        *SEQUENCE, "landed_at", (F.col("page") * 2 + ends).alias("mark"), F.unix_millis("landed_at").alias("landed_ms")
    )


def added(ranges: list[tuple[int, int]], pages: list[int]) -> list[tuple[int, int]]:
    """Disjoint sorted ranges with more pages in them."""
    out: list[tuple[int, int]] = []
    for first, last in sorted([*ranges, *((p, p) for p in set(pages))]):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def gaps(ranges: list[tuple[int, int]], stop: int | None) -> list[tuple[int, int]]:
    """Missing pages from 1 up to the stop, or to the last page seen."""
    end, at, out = stop if stop is not None else max((r[1] for r in ranges), default=0), 1, []
    for first, last in ranges:
        if first > at:
            out.append((at, min(first - 1, end)))
        at = last + 1
        if at > end:
            break
    if at <= end:
        out.append((at, end))
    return [g for g in out if g[0] <= g[1]]


def _shown(ranges: list[tuple[int, int]]) -> str:
    return ",".join(f"{a}-{b}" for a, b in ranges)


def _read(text: str) -> list[tuple[int, int]]:
    return [(int(a), int(b)) for a, b in (r.split("-") for r in text.split(",") if r)]


def _follow(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Times out once the watermark, which is behind event time by the delay, has passed
    the last page."""
    text, stop, told, due = state.get if state.exists else ("", None, False, 0)
    ranges, events = _read(text), []
    if state.hasTimedOut:
        if not told:
            events = [("gap", a, b) for a, b in gaps(ranges, stop)]
            if stop is None:
                events.append(("unfinished", 1, ranges[-1][1]))
        state.remove()
    else:
        for rows in batches:
            marks = rows["mark"].to_numpy().tolist()
            ranges = added(ranges, [m >> 1 for m in marks])
            stops = [m >> 1 for m in marks if m & 1]
            if stops:
                stop = min(stops if stop is None else [stop, *stops])
            due = max(due, *rows["landed_ms"].to_numpy().tolist())
        if not told and stop is not None and not gaps(ranges, stop):
            events, told = [("complete", 1, stop)], True
        state.update((_shown(ranges), stop, told, due))
        state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))
    if events:  # an empty frame costs as much as a full one
        yield pd.DataFrame([(*key, *e) for e in events], columns=["run_id", "catmat", "event", "page", "last_page"])


def sequence_events(pages: DataFrame, page_size: int = 500, delay: str = DELAY) -> DataFrame:
    """A stream of events of sequences: ``complete`` (pages 1 to the stop) as soon as it
    is so, or, once the delay is over, each ``gap`` up to the stop or the last page, and
    ``unfinished`` for a sequence whose stop has not been seen."""
    arrived = page_arrivals(pages, page_size).withWatermark("landed_at", delay)
    return _packed(arrived).groupBy(*SEQUENCE).applyInPandasWithState(
        _follow, EVENTS, _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


def start_completeness_stream(
    spark: SparkSession,
    pages: DataFrame,
    path: str,
    checkpoint: str,
    page_size: int = 500,
    delay: str = DELAY,
    available_now: bool = True,
) -> StreamingQuery:
    """Append the events to Parquet at ``path``."""
    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, _ROCKS)
    try:
        writer = sequence_events(pages, page_size, delay).writeStream.format("parquet").outputMode("append")
        writer = writer.option("path", path).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer).start()
    finally:
        spark.conf.set(_STORE, before)
