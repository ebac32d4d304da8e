"""Streaming sliding-window counts without window expansion (the streaming form of ``delta``).

A keyed processor keeps one count per slide-wide pane in map state. When the
watermark passes window ends, it emits every window of the key that ended,
with counts from prefix sums over the sorted panes - O(panes + output) per
firing, never size/slide state rows per pane - and drops the panes no later
window needs.

Rows reach the processor with their time as a plain number, so Spark's row
filter does not drop a late row whose windows are partly open: the row counts
in the windows that have not been emitted and in no other, as with a windowed
aggregation. A window is emitted once per key, final.

Keys are salted (by a hash of the row's time), so a global window, or one of
few keys, is worked on by ``salts`` tasks; a windowed sum over the salts' final
counts puts each window together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from rivulet.functions.timefmt import duration_ms


SALTS = 8


class SlidingCountProcessor(StatefulProcessor):
    def __init__(self, key_names: list[str], size_ms: int, slide_ms: int, count_name: str):
        self.key_names = key_names
        self.slide_ms, self.n = slide_ms, size_ms // slide_ms
        self.count_name = count_name

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.panes = handle.getMapState("panes", "pane long", "c long")
        self.cursor = handle.getValueState("cursor", "next_slot long")  # first window end not yet emitted

    def _set_timer(self, next_slot: int, panes) -> None:
        """One timer: the next window end to emit, or, without panes, the time to forget the cursor."""
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        at = max(next_slot, min(panes) + 1) if len(panes) else next_slot + self.n
        self.handle.registerTimer(int(at) * self.slide_ms)

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        done = timerValues.getCurrentWatermarkInMs() // self.slide_ms  # windows up to this slot have ended
        held = self.cursor.get()[0] if self.cursor.exists() else None
        # the first slot this key may still emit: what it has not emitted, or, for a new key, what has not ended
        open_slot = held if held is not None and held <= done else done + 1
        fresh: dict[int, int] = {}
        for pdf in rows:
            if len(pdf):  # the last column is the time (computed columns arrive without their names)
                panes, counts = np.unique(np.floor_divide(pdf.iloc[:, -1].to_numpy(), self.slide_ms * 1000), return_counts=True)
                for p, c in zip(panes.tolist(), counts.tolist()):
                    if p + self.n >= open_slot:  # some window of the pane is open
                        fresh[p] = fresh.get(p, 0) + c
        if not fresh:
            return iter([])
        for p, c in fresh.items():
            old = self.panes.getValue((p,))[0] if self.panes.containsKey((p,)) else 0
            self.panes.updateValue((p,), (old + c,))
        first = max(min(fresh) + 1, open_slot)
        next_slot = first if held is None else min(held, first)
        self.cursor.update((next_slot,))
        self._set_timer(next_slot, [k[0] for k in self.panes.keys()])
        return iter([])

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        items = sorted((k[0], v[0]) for k, v in self.panes.iterator())
        if not self.cursor.exists():
            return
        if not items:  # nothing came for a whole window size: rows that late have no open window
            self.cursor.clear()
            return
        p = np.array([i[0] for i in items], dtype=np.int64)
        c = np.array([i[1] for i in items], dtype=np.int64)
        next_slot = self.cursor.get()[0]
        last_slot = timerValues.getCurrentWatermarkInMs() // self.slide_ms  # windows ending at or before the watermark
        if last_slot >= next_slot:
            # window ending at slot s holds panes s-n .. s-1: candidate ends are the union of [p+1, p+n]
            ends = np.unique(np.concatenate([np.arange(max(q + 1, next_slot), min(q + self.n, last_slot) + 1)
                                             for q in p.tolist()] or [np.array([], dtype=np.int64)]))
            if len(ends):
                csum = np.concatenate([[0], np.cumsum(c)])
                cnt = csum[np.searchsorted(p, ends, side="left")] - csum[np.searchsorted(p, ends - self.n, side="left")]
                out = {k: [v] * len(ends) for k, v in zip(self.key_names, key)}
                out["window_start"] = pd.to_datetime((ends - self.n) * self.slide_ms, unit="ms")
                out["window_end"] = pd.to_datetime(ends * self.slide_ms, unit="ms")
                out[self.count_name] = cnt
                yield pd.DataFrame(out)[self.key_names + ["window_start", "window_end", self.count_name]]
            next_slot = last_slot + 1
            self.cursor.update((next_slot,))
            for q in p[p < next_slot - self.n].tolist():  # no window from next_slot on holds these panes
                self.panes.removeKey((q,))
            p = p[p >= next_slot - self.n]
        self._set_timer(next_slot, p.tolist())

    def close(self) -> None:
        pass


def sliding_count_stream(df: DataFrame, keys: list[str], time_col: str, size, slide, count_name: str = "count",
                         salts: int = SALTS) -> DataFrame:
    """Keys, window_start, window_end, count per finished window; ``df`` needs a watermark on ``time_col``."""
    size_ms, slide_ms = duration_ms(size), duration_ms(slide)
    if size_ms % slide_ms:
        raise ValueError("slide must divide size")
    keys = list(keys)
    us = F.unix_micros(time_col)
    rows = df.select(*keys, F.pmod(F.xxhash64(us), F.lit(salts)).cast("int").alias("_salt"), us.alias("_us"))
    salted = [*keys, "_salt"]
    schema = T.StructType([*[rows.schema[k] for k in salted], T.StructField("window_start", T.TimestampType()),
                           T.StructField("window_end", T.TimestampType()), T.StructField(count_name, T.LongType())])
    proc = SlidingCountProcessor(salted, size_ms, slide_ms, count_name)
    parts = rows.groupBy(*salted).transformWithStateInPandas(proc, schema, "append", "EventTime",
                                                             eventTimeColumnName="window_end")
    # all salts emit a window end in the same micro-batch (the watermark is global); its sum closes one slide later
    one = F.window("window_end", f"{slide_ms} milliseconds")
    total = parts.groupBy(one.alias("window"), *keys).agg(F.sum(count_name).alias(count_name))
    end = F.col("window.start")
    return total.select(*keys, F.timestamp_millis(F.unix_millis(end) - size_ms).alias("window_start"), end.alias("window_end"), count_name)
