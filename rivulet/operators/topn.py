"""Top-N per group.

Batch: ``row_number() <= N`` over (group ORDER BY count DESC, key ASC).
Catalyst turns the filter into ``WindowGroupLimit`` on both sides of the
exchange, so each map task ships at most N rows per group. Ties: count
descending, then key ascending - a total order, so results repeat (the
reference keeps arrival order for ties).

Streaming refuses ranking windows. Counts arrive once per (window, key) in
append mode, all keys of a window in one micro-batch. A keyed step per (window,
hash bucket of keys) streams over its rows and passes on the N best, never
holding more than one Arrow batch; an aggregation then merges at most N x
buckets entries per window. ``rivulet.streaming.sinks.top_n_per_batch`` ranks
each micro-batch as a batch instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from rivulet.functions.reports import ReportStyle, report_line, report_text
from rivulet.functions.timefmt import duration_ms


def top_n(df: DataFrame, group_cols, key_col: str, count_col: str, n: int, rank_col: str = "rank") -> DataFrame:
    group_cols = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    w = Window.partitionBy(*group_cols).orderBy(F.col(count_col).desc(), F.col(key_col).asc())
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


class BestOfBucket(StatefulProcessor):
    """The N best (count desc, key asc) rows of one (window, bucket); stateless, as all of them come together."""

    def __init__(self, key_col: str, count_col: str, n: int):
        self.key_col, self.count_col, self.n = key_col, count_col, n

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        best = None
        for pdf in rows:
            pdf = pdf.set_axis(["_end", self.key_col, self.count_col, "_bucket"], axis=1)  # computed columns come unnamed
            both = pdf if best is None else pd.concat([best, pdf])
            best = both.sort_values([self.count_col, self.key_col], ascending=[False, True]).head(self.n)
        if best is not None and len(best):
            best = best.assign(_at=pd.Timestamp(int(key[0]), unit="us"))
            yield best[["_at", self.key_col, self.count_col]]

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        return iter([])

    def close(self) -> None:
        pass


def _top_arrays(counts: DataFrame, slide, key_col: str, count_col: str, n: int, buckets: int) -> DataFrame:
    """window (ends at window_end), _top: the ranked (c, k) array of every window end."""
    entry = F.struct(F.col(count_col).alias("c"), F.col(key_col).alias("k"))
    ordered = F.array_sort(F.collect_list(entry), lambda a, b: F.when(a["c"] > b["c"], -1).when(a["c"] < b["c"], 1)
                           .when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0))
    rows = counts.select((F.unix_micros("window.end") - 1).alias("_end"), key_col, count_col,
                         F.pmod(F.hash(F.col(key_col)), F.lit(buckets)).alias("_bucket"))
    schema = T.StructType([T.StructField("_at", T.TimestampType()), rows.schema[key_col], rows.schema[count_col]])
    local = rows.groupBy("_end", "_bucket").transformWithStateInPandas(
        BestOfBucket(key_col, count_col, n), schema, "append", "EventTime", eventTimeColumnName="_at")
    # a tumbling window of `slide` around the window's event time identifies the window end
    return local.groupBy(F.window("_at", f"{duration_ms(slide)} milliseconds").alias("window")).agg(
        F.slice(ordered, 1, n).alias("_top"))


def top_n_stream(counts: DataFrame, slide, key_col: str, count_col: str, n: int, buckets: int = 16,
                 rank_col: str = "rank") -> DataFrame:
    """Top-N per window end of a streaming windowed count (needs a watermark upstream).

    ``counts`` has a ``window`` struct column from a windowed aggregation and
    one row per (window, key). Returns window_end, rank, key, count rows.
    """
    merged = _top_arrays(counts, slide, key_col, count_col, n, buckets)
    return merged.select(F.col("window.end").alias("window_end"),
                         F.posexplode("_top").alias("_pos", "_e")).select(
        "window_end", (F.col("_pos") + 1).alias(rank_col), F.col("_e.k").alias(key_col), F.col("_e.c").alias(count_col))


def report_stream(counts: DataFrame, slide, key_col: str, count_col: str, n: int, style: ReportStyle,
                  buckets: int = 16) -> DataFrame:
    """The ranked text report per window end of a streaming windowed count: window_end, report."""
    merged = _top_arrays(counts, slide, key_col, count_col, n, buckets)
    return merged.select(F.col("window.end").alias("window_end"),
                         report_text(style, F.col("window.end"), F.transform(
                             "_top", lambda e, i: report_line(style, i + 1, e["k"], e["c"]))).alias("report"))
