"""Registered queries of the streaming forms and of the user hooks, over the whole ``events`` table.

A streaming query is fed the table in slices, as a source would deliver it: each slice is written as files of an input
folder in the shared folder, the query runs over what is new (``availableNow``) and stops, and the next run goes on from
its checkpoint. The result is read from its sink. Slices by time deliver in order; slices by ``event_id`` modulo
``SLICES`` deliver rows of the whole time span again and again, so that every slice but the first is late.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rivulet.functions.timefmt import to_epoch_millis
from rivulet.operators.aggregates import bitmap_offset
from rivulet.operators.hooks import IntegerAverage, QuantileSketch, aggregate, process_windows
from rivulet.plans import jobs
from rivulet.plans.catalog import AD_CAP, LOGIN_MAX_FAILS, LOGIN_WITHIN
from rivulet.session import keyed_state, shared_folder
from rivulet.sources import tables
from rivulet.sources.records import parse_apache_log, parse_user_behavior
from rivulet.sources.text import read_lines
from rivulet.streaming import jobs as stream_jobs
from rivulet.streaming import revisions, running, sinks

SLICES = 4
SPAN = "400 days"  # longer than the table: no row is too late where a query is to revise everything
LATE_AFTER = "3 days"
CLOSE_AFTER = "2 hours"


def in_time_slices(df: DataFrame, time_col: str, n: int = SLICES) -> list[DataFrame]:
    """``df`` cut at ``n`` - 1 points of time, about equal counts, in order. Any cut points give the same results."""
    us = F.unix_micros(F.col(time_col).cast("timestamp"))
    cuts = df.agg(F.percentile_approx(us, [i / n for i in range(1, n)])).first()[0] or []
    number = sum((F.when(us >= F.lit(c), 1).otherwise(0) for c in cuts), F.lit(0))
    return [df.where(F.coalesce(number, F.lit(0)) == i) for i in range(n)]


def in_id_slices(df: DataFrame, id_col: str = "event_id", n: int = SLICES) -> list[DataFrame]:
    return [df.where(F.coalesce(F.pmod(F.col(id_col), F.lit(n)), F.lit(0)) == i) for i in range(n)]


def feed(slices: list[DataFrame], start: Callable[[DataFrame], StreamingQuery], text: bool = False) -> None:
    """Delivers the slices one after the other to a query that ``start`` starts on the stream of them; each run ends when it is done."""
    spark = slices[0].sparkSession
    keyed_state(spark)
    folder = shared_folder(spark, "feed")
    for part in slices:
        if text:
            part.write.mode("append").text(folder)
            stream = read_lines(spark, folder, streaming=True, max_files_per_trigger=None)
        else:
            part.write.mode("append").parquet(folder)
            stream = spark.readStream.schema(part.schema).parquet(folder)
        start(stream).awaitTermination()


def _place(spark: SparkSession, name: str) -> tuple[str, str]:
    """(result folder, checkpoint) of one run of a registered query."""
    root = shared_folder(spark, name)
    return os.path.join(root, "result"), os.path.join(root, "checkpoint")


def _pv_offsets(ev: DataFrame) -> DataFrame:
    pv = tables.user_behavior(ev, ("pv",))
    return pv.where(F.col("behavior") == jobs.PV_BEHAVIOR).select("event_time", "seq", bitmap_offset("user_id").alias("offset"))


# ---- streams ---------------------------------------------------------------------------

def q_stream_unique_visitors_running(spark, sf_dir):
    """One row per page view with the bitmap count after it."""
    path, checkpoint = _place(spark, "uv-running")
    ev = tables.events(spark, sf_dir)
    feed(in_time_slices(ev, "ts"), lambda s: running.start_running_visitors(
        _pv_offsets(s), "uv_running", path, checkpoint=checkpoint, available_now=True))
    return jobs.epoch_ms(running.read_running_visitors(spark, path).drop("event_time"), "window_start", "window_end")


def q_stream_url_changelog(spark, sf_dir):
    """The ranking that the folded changelog leaves after every slice revised every window."""
    path, checkpoint = _place(spark, "url-changelog")
    ev = tables.events(spark, sf_dir)

    def start(s: DataFrame) -> StreamingQuery:
        logs = parse_apache_log(tables.apache_log_lines(s)).rows
        return stream_jobs.start_url_changelog(logs, "url_changelog", path, allowed_lateness=SPAN, checkpoint=checkpoint, available_now=True)

    feed(in_id_slices(ev), start)
    return jobs.epoch_ms(revisions.fold_changelog(revisions.read_changelog(spark, path, "url"), "url"), "window_end")


def q_stream_lateness_split(spark, sf_dir):
    """Every row with whether it came later than LATE_AFTER behind the slices before."""
    path, checkpoint = _place(spark, "lateness")
    ev = tables.events(spark, sf_dir).select("event_id", "ts")
    feed(in_id_slices(ev), lambda s: revisions.start_lateness_split(s, "lateness", path, LATE_AFTER, "ts", checkpoint, available_now=True))
    return revisions.read_split(spark, path, ev.schema).select("event_id", "late")


def q_stream_page_views(spark, sf_dir):
    """CSV lines from files, parsed, counted per hour; the windows that the watermark closed, from a file sink."""
    path, checkpoint = _place(spark, "page-views")
    lines = [tables.user_behavior_lines(part) for part in in_time_slices(tables.events(spark, sf_dir), "ts")]

    def start(s: DataFrame) -> StreamingQuery:
        views = jobs.page_views(parse_user_behavior(s).rows, watermark=CLOSE_AFTER)
        return sinks.start(views, "page_views", "parquet", path=path, checkpoint=checkpoint, available_now=True)

    feed(lines, start, text=True)
    return jobs.epoch_ms(spark.read.schema("window_start timestamp, window_end timestamp, pv long").parquet(path), "window_start", "window_end")


def _upserted(spark, sf_dir, name):
    path, checkpoint = _place(spark, name)
    ev = tables.events(spark, sf_dir)
    feed(in_id_slices(ev), lambda s: sinks.upsert_latest(
        jobs.unique_visitors_bitmap_shards(tables.user_behavior(s, ("pv",)), watermark=SPAN), name, path,
        ["window_start", "window_end", "shard"], "uv", checkpoint=checkpoint, available_now=True))
    return path, checkpoint


def q_stream_unique_visitors_upsert(spark, sf_dir):
    """Bitmap shards in update mode, the last revision of each upserted, summed per window."""
    path, _ = _upserted(spark, sf_dir, "uv_upsert")
    return jobs.epoch_ms(sinks.read_latest_sum(spark, path, ["window_start", "window_end"], "shard", "uv"), "window_start", "window_end")


def q_stream_unique_visitors_state(spark, sf_dir):
    """The same counts read out of the running query's state, without its sink."""
    _, checkpoint = _upserted(spark, sf_dir, "uv_state")
    return jobs.epoch_ms(sinks.read_bitmap_state(spark, checkpoint), "window_start", "window_end")


def q_stream_ad_clicks(spark, sf_dir):
    """The click cap's tagged rows, clicks that pass and one warning per capped key and day."""
    path, checkpoint = _place(spark, "ad-clicks")
    ev = tables.events(spark, sf_dir)

    def start(s: DataFrame) -> StreamingQuery:
        tagged = stream_jobs.click_cap_stream(tables.ad_clicks(s), AD_CAP, CLOSE_AFTER)
        return sinks.start(tagged, "ad_clicks", "parquet", path=path, checkpoint=checkpoint, available_now=True)

    feed(in_time_slices(ev, "ts"), start)
    return spark.read.parquet(path).select("user_id", "ad_id", "province", "ts", "seq", "kind", "msg")


def q_stream_login_fail_warnings(spark, sf_dir):
    """The episodes that the watermark closed."""
    path, checkpoint = _place(spark, "logins")
    ev = tables.events(spark, sf_dir)

    def start(s: DataFrame) -> StreamingQuery:
        found = stream_jobs.login_fail_warnings_stream(tables.logins(s), LOGIN_MAX_FAILS, LOGIN_WITHIN, CLOSE_AFTER)
        return sinks.start(found, "logins", "parquet", path=path, checkpoint=checkpoint, available_now=True)

    feed(in_time_slices(ev, "ts"), start)
    return spark.read.parquet(path).drop("event_time")


# ---- hooks -----------------------------------------------------------------------------

def _labelled(tumbling: DataFrame, sliding: DataFrame, *columns) -> DataFrame:
    both = tumbling.withColumn("windows", F.lit("tumbling")).unionByName(sliding.withColumn("windows", F.lit("sliding")))
    return both.select("windows", to_epoch_millis("window_end").alias("window_end"), *columns)


def q_custom_average(spark, sf_dir):
    """A4 through the aggregate hook: mean event seconds per item, per day and per day every two hours."""
    pv = tables.user_behavior(tables.events(spark, sf_dir), ("pv",)).where(F.col("behavior") == "pv")
    fn = IntegerAverage("ts")
    runs = [aggregate(pv, fn, "item_id", "event_time", "1 day", slide, ["ts"], "avg_ts") for slide in (None, "2 hours")]
    return _labelled(*runs, "item_id", "avg_ts")


def q_custom_quantiles(spark, sf_dir):
    """A quantile sketch through the aggregate hook: median and 99th percentile of the value in cents, per type and hour."""
    ev = tables.events(spark, sf_dir).select(F.col("ts").cast("timestamp").alias("event_time"), "event_type",
                                             F.round(F.col("value") * 100).cast("long").alias("cents"))
    fn = QuantileSketch("cents")
    runs = [aggregate(ev, fn, "event_type", "event_time", "1 hour", slide, ["cents"], "q") for slide in (None, "5 minutes")]
    return _labelled(*runs, "event_type", F.col("q")[0].alias("p50"), F.col("q")[1].alias("p99"))


ACTIVITY = ("channel string, window_start timestamp, window_end timestamp, n long, longest_gap_us long, first_user string, last_user string")


def activity(key: tuple, rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, longest pause, first and last user of one window; holds one batch at a time."""
    import numpy as np

    n, gap, last_us, first_user, last_user = 0, 0, None, None, None
    for b in rows:
        us = b.column("event_time").cast(pa.timestamp("us", "UTC")).cast(pa.int64()).to_numpy()
        users = b.column("user_id")
        if not len(us):
            continue
        if n == 0:
            first_user = users[0].as_py()
        steps = np.diff(us, prepend=us[0] if last_us is None else last_us)
        n, gap, last_us, last_user = n + len(us), max(gap, int(steps.max())), int(us[-1]), users[len(us) - 1].as_py()
    channel, start, end = key
    yield pa.RecordBatch.from_arrays(
        [pa.array([channel], pa.string()), pa.array([start], pa.timestamp("us", "UTC")), pa.array([end], pa.timestamp("us", "UTC")),
         pa.array([n]), pa.array([gap]), pa.array([first_user], pa.string()), pa.array([last_user], pa.string())],
        names=[c.split()[0] for c in ACTIVITY.split(", ")])


def q_custom_windows(spark, sf_dir):
    """The full-window hook on marketing rows: activity per channel in windows of an hour every twenty minutes."""
    rows = tables.marketing(tables.events(spark, sf_dir))
    out = process_windows(rows, activity, "channel", "event_time", "1 hour", ACTIVITY, "20 minutes", ["event_time", "user_id"], ["seq"])
    return jobs.epoch_ms(out, "window_start", "window_end")


STREAM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stream_unique_visitors_running": q_stream_unique_visitors_running,
    "stream_url_changelog": q_stream_url_changelog,
    "stream_lateness_split": q_stream_lateness_split,
    "stream_page_views": q_stream_page_views,
    "stream_unique_visitors_upsert": q_stream_unique_visitors_upsert,
    "stream_unique_visitors_state": q_stream_unique_visitors_state,
    "stream_ad_clicks": q_stream_ad_clicks,
    "stream_login_fail_warnings": q_stream_login_fail_warnings,
    "custom_average": q_custom_average,
    "custom_quantiles": q_custom_quantiles,
    "custom_windows": q_custom_windows,
}
