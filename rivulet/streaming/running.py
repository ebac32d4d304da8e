"""W10 / A7 on streams: one row per page view with the distinct visitors of its window so far.

1. ``FirstSightingProcessor`` (keyed by a shard of the bitmap, all windows together) marks each row whose bit was not set
   in its window before. While a window's shard has at most ``SPARSE`` bits they are one list of offsets in map state, one
   request for all rows of a micro-batch; then they are pages of ``PAGE`` bits, and a row costs one page, not a bitmap. A
   window is ``shards`` keys, so a window that takes all traffic is as many tasks.
2. Each micro-batch's marked rows are written once, then numbered: the window's count before the batch plus the running
   sum of the marks in (event time, seq) order, taken over parts of equal row counts (``running_sum``). The counts of the
   windows that can still grow are written next to them for the next batch.

Everything of a batch lies in folders of its batch id and is overwritten by a replay, so the result is exactly-once.
Rows count in arrival order from batch to batch, and in (event time, seq) order inside a batch. Rows behind the watermark
are dropped by Spark. Null visitors mark nothing and get the count before them.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from rivulet.functions.timefmt import duration_ms, duration_str
from rivulet.operators.prefix import running_sum
from rivulet.session import keyed_state, stream_checkpoint
from rivulet.streaming.sinks import batch_folders

PAGE = 1024  # bits of a bitmap page, the unit of state of a full window
SPARSE = 8192  # offsets of a window's shard that are kept as a list
MARKS = "window_start timestamp, shard long, event_time timestamp, seq long, is_new long"
SIGHTED = "start long, shard long, event_time timestamp, seq long, no_seq boolean, is_new long"


class FirstSightingProcessor(StatefulProcessor):
    """Per bitmap shard: marks rows whose offset their window (``start``, ms) has not seen; forgets a window when it closes."""

    def __init__(self, size_ms: int, sparse: int = SPARSE):
        self.size_ms, self.sparse = size_ms, sparse

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.windows = handle.getMapState("windows", "start long", "paged boolean, held binary")  # offsets, or page numbers
        self.pages = handle.getMapState("pages", "start long, page long", "bits binary")

    def _unseen(self, start: int, values: np.ndarray) -> np.ndarray:
        """Which of the window's sorted distinct ``values`` are new to it; they are kept."""
        if self.windows.containsKey((start,)):
            paged, held = self.windows.getValue((start,))
            held = np.frombuffer(held, np.int64)
        else:
            paged, held = False, np.empty(0, np.int64)
            self.handle.registerTimer(start + self.size_ms)
        if paged:
            return self._unseen_in_pages(start, values, held)
        fresh = ~np.isin(values, held, assume_unique=True)
        if fresh.any():
            held = np.union1d(held, values)
            if len(held) > self.sparse:
                self._unseen_in_pages(start, held, np.empty(0, np.int64))
            else:
                self.windows.updateValue((start,), (False, held.tobytes()))
        return fresh

    def _unseen_in_pages(self, start: int, values: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        page = values // PAGE
        here = np.unique(page)
        fresh = np.zeros(len(values), bool)
        for number, a, b in zip(here.tolist(), np.searchsorted(page, here), np.searchsorted(page, here, "right")):
            at = (start, number)
            held = self.pages.getValue(at) if self.pages.containsKey(at) else None
            bits = np.unpackbits(np.frombuffer(held[0], np.uint8)) if held else np.zeros(PAGE, np.uint8)
            place = values[a:b] % PAGE
            fresh[a:b] = bits[place] == 0
            if fresh[a:b].any():
                bits[place] = 1
                self.pages.updateValue(at, (np.packbits(bits).tobytes(),))
        if not np.isin(here, numbers).all():
            self.windows.updateValue((start,), (True, np.union1d(numbers, here).tobytes()))
        return fresh

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        parts = [p for p in rows if len(p)]
        if not parts:
            return
        pdf = pd.concat(parts, ignore_index=True).sort_values(["event_time", "no_seq", "seq"], kind="mergesort", ignore_index=True)
        known = pdf.loc[pdf["offset"].notna(), ["start", "offset"]].astype(np.int64).drop_duplicates()
        new = np.zeros(len(pdf), np.int64)
        for start, first in known.sort_values("offset").groupby("start")["offset"]:
            new[first.index[self._unseen(int(start), first.to_numpy())]] = 1
        yield pdf[["start", "event_time", "seq", "no_seq"]].assign(shard=key[0], is_new=new)[[c.split()[0] for c in SIGHTED.split(", ")]]

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        start = expiredTimerInfo.getExpiryTimeInMs() - self.size_ms  # each window has its own timer
        if self.windows.containsKey((start,)):
            paged, held = self.windows.getValue((start,))
            for number in np.frombuffer(held, np.int64).tolist() if paged else []:
                self.pages.removeKey((start, number))
            self.windows.removeKey((start,))
        return iter([])

    def close(self) -> None:
        pass


def first_sightings(rows: DataFrame, offset_col: str, size, watermark="0 seconds", shards: int = 64, sparse: int = SPARSE) -> DataFrame:
    """MARKS rows of a stream of (event_time, seq, offset): each row with 1 if its window saw the offset for the first time."""
    keyed_state(rows.sparkSession)
    size_ms = duration_ms(size)
    src = rows.withWatermark("event_time", duration_str(watermark)).select(
        F.unix_millis(F.window("event_time", f"{size_ms} milliseconds")["start"]).alias("start"),
        # neighbouring pages fall to different shards; a null visitor belongs to shard 0
        F.coalesce(F.pmod(F.floor(F.col(offset_col) / PAGE), F.lit(shards)), F.lit(0)).cast("long").alias("shard"),
        # a column with a null would reach pandas as doubles
        "event_time", F.coalesce("seq", F.lit(0)).alias("seq"), F.col("seq").isNull().alias("no_seq"),
        F.col(offset_col).cast("long").alias("offset"))
    marks = src.groupBy("shard").transformWithStateInPandas(
        FirstSightingProcessor(size_ms, sparse), SIGHTED, "append", "EventTime", eventTimeColumnName="event_time")
    return marks.select(F.timestamp_millis("start").alias("window_start"), "shard", "event_time",
                        F.when(~F.col("no_seq"), F.col("seq")).alias("seq"), "is_new")


def start_running_visitors(rows: DataFrame, name: str, path: str, offset_col: str = "offset", size="1 hour", watermark="0 seconds",
                           shards: int = 64, checkpoint: str | None = None, available_now: bool = False,
                           sparse: int = SPARSE) -> StreamingQuery:
    """One row per input row under ``path``/rows: window_start, window_end, event_time, seq, uv (see ``read_running_visitors``)."""
    size_ms, delay_ms = duration_ms(size), duration_ms(watermark)
    totals = "window_start timestamp, uv long"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        here = {kind: os.path.join(path, kind, f"batch_id={batch_id}") for kind in ("marks", "rows", "totals")}
        batch.write.mode("overwrite").parquet(here["marks"])  # the stateful plan runs once
        marks = spark.read.schema(MARKS).parquet(here["marks"])
        earlier = [b for b in batch_folders(spark, os.path.join(path, "totals")) if b < batch_id]
        before = (spark.read.schema(totals).parquet(os.path.join(path, "totals", f"batch_id={earlier[-1]}")) if earlier
                  else spark.createDataFrame([], totals))
        counted = running_sum(marks, ["window_start"], ["event_time", "seq"], "is_new", "run")
        known = before.withColumnRenamed("uv", "known")
        out = counted.join(known, "window_start", "left").select(
            "window_start", F.timestamp_millis(F.unix_millis("window_start") + size_ms).alias("window_end"), "event_time", "seq",
            (F.col("run") + F.coalesce("known", F.lit(0))).alias("uv"))
        out.write.mode("overwrite").parquet(here["rows"])
        added = marks.groupBy("window_start").agg(F.sum("is_new").alias("uv"))
        now = before.unionByName(added).groupBy("window_start").agg(F.sum("uv").alias("uv"))
        newest = now.agg(F.unix_millis(F.max("window_start"))).first()[0]
        if newest is not None:  # a window that ends before the newest window's start less the delay is behind every later watermark
            now = now.where(F.unix_millis("window_start") + size_ms > F.lit(newest - delay_ms))
        now.write.mode("overwrite").parquet(here["totals"])

    w = (first_sightings(rows, offset_col, size, watermark, shards, sparse).writeStream.queryName(name).outputMode("append").foreachBatch(write)
         .option("checkpointLocation", checkpoint or stream_checkpoint(rows.sparkSession, name)))
    return (w.trigger(availableNow=True) if available_now else w).start()


def read_running_visitors(spark: SparkSession, path: str) -> DataFrame:
    """window_start, window_end, event_time, seq, uv of all complete batches."""
    done = batch_folders(spark, os.path.join(path, "rows"))
    schema = "window_start timestamp, window_end timestamp, event_time timestamp, seq long, uv long"
    return spark.read.schema(schema).parquet(*[os.path.join(path, "rows", f"batch_id={b}") for b in done]) if done else spark.createDataFrame([], schema)
