"""The reference's nine jobs as parameterised DataFrame plans.

Every job takes typed rows (``event_time`` TIMESTAMP, ``seq`` tie-breaker,
plus the record's fields) from a batch or a streaming DataFrame and returns
DataFrames shaped like the reference's output records. Reference values are
the defaults; thresholds, sizes and columns are parameters.

On streams the job sets the watermark the reference uses (``watermark``),
so the caller only picks the sink; results are final rows in append mode.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions.reports import HOT_ITEMS_STYLE, HOT_URLS_STYLE, ranked_report
from rivulet.functions.timefmt import duration_ms, duration_str, sql_timestamp_string, to_epoch_millis
from rivulet.operators.aggregates import (
    bitmap_distinct_count,
    bitmap_shard_counts,
    bitmap_offset,
    distinct_count,
    running_distinct,
    sketch_distinct_count,
)
from rivulet.operators.patterns import click_cap, login_fail_bursts, login_fail_episodes
from rivulet.operators.topn import report_stream, top_n, top_n_stream
from rivulet.operators.windows import sliding_count, tumbling_aggregate

# --- fixed values: labels that must equal the reference's output ----------
PV_BEHAVIOR = "pv"
MARKETING_TOTAL_CHANNEL = "app marketing"
MARKETING_TOTAL_BEHAVIOR = "total"
# ---------------------------------------------------------------------------


def _watermarked(df: DataFrame, delay) -> DataFrame:
    return df.withWatermark("event_time", duration_str(delay)) if df.isStreaming else df


def _pv(behavior: DataFrame) -> DataFrame:
    return behavior.where(F.col("behavior") == PV_BEHAVIOR)


# --- hot items / hot urls (E1): windowed count, then top-N per window end ---

def _hot(rows: DataFrame, key: str, top: int, size, slide, method: str, style=None) -> DataFrame:
    """Ranked rows, or with ``style`` the report, per window end of a table or stream."""
    streaming = rows.isStreaming
    counts = sliding_count(rows, key, "event_time", size, slide, method="direct" if streaming else method,
                           window_struct=streaming)
    if streaming:
        return report_stream(counts, slide, key, "count", top, style) if style else top_n_stream(counts, slide, key, "count", top)
    ranked = top_n(counts, "window_end", key, "count", top).select("window_end", "rank", key, "count")
    return ranked_report(ranked, style, key=key) if style else ranked


def hot_items(behavior: DataFrame, top: int = 3, size="1 hour", slide="5 minutes", watermark="0 seconds",
              method: str = "auto") -> DataFrame:
    """Top ``top`` items by page views per sliding window: window_end (TIMESTAMP), rank, item_id, count."""
    return _hot(_watermarked(_pv(behavior), watermark), "item_id", top, size, slide, method)


def hot_items_report(behavior: DataFrame, top: int = 3, size="1 hour", slide="5 minutes", watermark="0 seconds",
                     method: str = "auto") -> DataFrame:
    """F7 text per window end, of tables and streams: window_end, report."""
    return _hot(_watermarked(_pv(behavior), watermark), "item_id", top, size, slide, method, HOT_ITEMS_STYLE)


def _late_by(out_of_order, allowed_lateness) -> str:
    return f"{duration_ms(out_of_order) + duration_ms(allowed_lateness)} milliseconds"


def hot_urls(logs: DataFrame, top: int = 5, size="1 minute", slide="5 seconds", out_of_order="1 second",
             allowed_lateness="60 seconds", method: str = "auto") -> DataFrame:
    """Top ``top`` URLs per sliding window: window_end, rank, url, count.

    On streams the watermark trails by out-of-orderness + allowed lateness:
    a row up to that late still counts, and each window is emitted once,
    final. ``streaming.jobs.start_url_revisions`` publishes a window at once
    and again for each late row, as the reference does.
    """
    return _hot(_watermarked(logs, _late_by(out_of_order, allowed_lateness)), "url", top, size, slide, method)


def hot_urls_report(logs: DataFrame, top: int = 5, size="1 minute", slide="5 seconds", out_of_order="1 second",
                    allowed_lateness="60 seconds", method: str = "auto") -> DataFrame:
    """F7 text per window end, of tables and streams: window_end, report."""
    return _hot(_watermarked(logs, _late_by(out_of_order, allowed_lateness)), "url", top, size, slide, method, HOT_URLS_STYLE)


def url_counts(logs: DataFrame, size="1 minute", slide="5 seconds", out_of_order="1 second",
               allowed_lateness="60 seconds") -> DataFrame:
    """window_end, url, count per sliding window; on streams for update mode, where each late row revises its windows."""
    logs = _watermarked(logs, _late_by(out_of_order, allowed_lateness))
    return sliding_count(logs, "url", "event_time", size, slide, method="direct").select("window_end", "url", "count")


def item_report(ranked: DataFrame) -> DataFrame:
    """F7 text per window end of ``hot_items`` rows of a table."""
    return ranked_report(ranked, HOT_ITEMS_STYLE, key="item_id")


def url_report(ranked: DataFrame) -> DataFrame:
    return ranked_report(ranked, HOT_URLS_STYLE, key="url")


# --- page views / unique visitors ------------------------------------------

def page_views(behavior: DataFrame, size="1 hour", watermark="0 seconds") -> DataFrame:
    """Page views per tumbling window: window_start, window_end, pv."""
    pv = _watermarked(_pv(behavior), watermark)
    return tumbling_aggregate(pv, [], "event_time", size, count_name="pv")


def unique_visitors(behavior: DataFrame, size="1 hour", watermark="0 seconds") -> DataFrame:
    """Exact distinct users per tumbling window: window_start, window_end, uv."""
    pv = _watermarked(_pv(behavior), watermark)
    return distinct_count(pv, [], "event_time", size, "user_id", "uv")


def unique_visitors_bitmap(behavior: DataFrame, size="1 hour", watermark="0 seconds") -> DataFrame:
    """Distinct bitmap offsets per window (what the reference's bitmap holds at window end)."""
    pv = _watermarked(_pv(behavior), watermark)
    return bitmap_distinct_count(pv, [], "event_time", size, "user_id", "uv")


def unique_visitors_bitmap_shards(behavior: DataFrame, size="1 hour", watermark="0 seconds") -> DataFrame:
    """Per window and bitmap shard, the distinct offsets so far; on streams use update mode + ``upsert_latest``.

    ``streaming.sinks.read_latest_sum`` turns the upserted shards back into
    one exact count per window (the reference's Redis hash ``count``).
    """
    pv = _watermarked(_pv(behavior), watermark).withColumn("_offset", bitmap_offset("user_id"))
    return bitmap_shard_counts(pv, [], "event_time", size, "_offset", "uv")


def unique_visitors_running(behavior: DataFrame, size="1 hour") -> DataFrame:
    """Per page view, the bitmap count after it (the reference fires per element): seq, window_start, window_end, uv."""
    pv = _pv(behavior).withColumn("_offset", bitmap_offset("user_id"))
    return running_distinct(pv, [], "event_time", "seq", size, "_offset", "uv")


def unique_visitors_sketch(behavior: DataFrame, size="1 hour", watermark="0 seconds", lg_config_k: int = 12,
                           keep_sketch: bool = False) -> DataFrame:
    """HLL estimate per window: kilobytes of state per window whatever the traffic."""
    pv = _watermarked(_pv(behavior), watermark)
    return sketch_distinct_count(pv, [], "event_time", size, "user_id", "uv", lg_config_k, keep_sketch)


# --- marketing (360x sliding windows) ---------------------------------------

def _marketing_rows(events: DataFrame, excluded: str, watermark) -> DataFrame:
    return _watermarked(events.where(F.col("behavior") != excluded), watermark)


def _as_marketing_record(counts: DataFrame, channel, behavior) -> DataFrame:
    return counts.select("window_start", "window_end", channel.alias("channel"), behavior.alias("behavior"),
                         F.col("count"))


def as_printed(df: DataFrame, *cols: str) -> DataFrame:
    """Sink-side rendering of TIMESTAMP columns as ``Timestamp.toString`` text (the reference's records)."""
    for c in cols:
        df = df.withColumn(c, sql_timestamp_string(c))
    return df


def marketing_total(events: DataFrame, size="1 hour", slide="10 seconds", excluded: str = "UNINSTALL",
                    watermark="0 seconds", method: str = "auto") -> DataFrame:
    """All non-excluded marketing events per sliding window.

    MarketingViewCount rows with TIMESTAMP bounds; ``as_printed`` renders them
    as the reference's text at the sink.
    """
    rows = _marketing_rows(events, excluded, watermark)
    counts = sliding_count(rows, [], "event_time", size, slide, method=method)
    return _as_marketing_record(counts, F.lit(MARKETING_TOTAL_CHANNEL), F.lit(MARKETING_TOTAL_BEHAVIOR))


def marketing_by_channel(events: DataFrame, size="1 hour", slide="10 seconds", excluded: str = "UNINSTALL",
                         watermark="0 seconds", method: str = "auto") -> DataFrame:
    """Per (channel, behaviour) per sliding window (MarketingViewCount rows)."""
    rows = _marketing_rows(events, excluded, watermark)
    counts = sliding_count(rows, ["channel", "behavior"], "event_time", size, slide, method=method)
    return _as_marketing_record(counts, F.col("channel"), F.col("behavior"))


# --- ads: click cap + blacklist side output + sliding count by province -----

@dataclass
class AdStatistics:
    by_province: DataFrame  # CountByProvince: window_end (TIMESTAMP), province, count
    blacklist: DataFrame  # BlackListWarning: user_id, ad_id, ts, msg
    passed: DataFrame  # clicks under the cap


def ad_clicks_by_province(clicks: DataFrame, max_count: int = 100, size="1 hour", slide="5 seconds",
                          method: str = "auto") -> AdStatistics:
    """Batch form; the streaming form is ``rivulet.streaming.jobs.ad_clicks_by_province_stream``."""
    capped = click_cap(clicks, ("user_id", "ad_id"), "event_time", "seq", max_count)
    counts = sliding_count(capped.passed, "province", "event_time", size, slide, method=method)
    by_province = counts.select("window_end", "province", "count")
    return AdStatistics(by_province, capped.warnings, capped.passed)


# --- login failures ----------------------------------------------------------

def login_fail_warnings(logins: DataFrame, max_fails: int = 2, within="2 seconds") -> DataFrame:
    """T4 batch form: user_id, first_fail_time, last_fail_time, first_seq, fail_count, msg."""
    return login_fail_episodes(logins, "user_id", "event_time", "seq", "event_type", "fail", within, max_fails)


def login_fail_burst_rows(logins: DataFrame, max_fails: int = 2, within="2 seconds") -> DataFrame:
    """Every fail that opens >= max_fails fails within ``within`` with no success between."""
    return login_fail_bursts(logins, "user_id", "event_time", "seq", "event_type", "fail", within, max_fails)


def epoch_ms(df: DataFrame, *cols: str) -> DataFrame:
    """Render TIMESTAMP columns as epoch milliseconds (the reference's ``windowEnd: Long``)."""
    for c in cols:
        df = df.withColumn(c, to_epoch_millis(c))
    return df
