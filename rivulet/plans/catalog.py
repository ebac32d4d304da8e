"""Registered queries: the nine jobs (and their operators) over the driver's tables.

Each entry takes (spark, sf_dir) and reads the whole ``events`` table; the
stand-in mapping is in ``rivulet.sources.tables``. Parameters that differ from
the reference's defaults are the ones the table's density needs (stated per
query): ``events`` has ~14 rows per hour at sf0.01, not a click stream.
Window bounds are epoch milliseconds (the reference's ``windowEnd: Long``)
or ``Timestamp.toString`` text where the reference prints that.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.functions.timefmt import to_epoch_millis
from rivulet.operators.aggregates import integer_average
from rivulet.operators.windows import tumbling_aggregate
from rivulet.plans import jobs
from rivulet.sources import tables
from rivulet.sources.records import parse_ad_clicks, parse_apache_log, parse_logins, parse_user_behavior

# stand-in parameters for the driver's events table
AD_CAP = 1  # <= 5 clicks per (user, ad, day) in `events`; cap 1 -> click 3 warns
LOGIN_WITHIN = "6 hours"  # a 2 s window finds no bursts at ~14 rows/hour
LOGIN_MAX_FAILS = 2


def _behavior(spark, sf_dir, only=None):
    return tables.user_behavior(tables.events(spark, sf_dir), only)


def _pv(spark, sf_dir):
    return _behavior(spark, sf_dir, only=("pv",))


def _logs(spark, sf_dir):
    return parse_apache_log(tables.apache_log_lines(tables.events(spark, sf_dir))).rows


def q_page_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.epoch_ms(jobs.page_views(_pv(spark, sf_dir)), "window_start", "window_end")


def q_unique_visitors(spark, sf_dir):
    return jobs.epoch_ms(jobs.unique_visitors(_pv(spark, sf_dir)), "window_start", "window_end")


def q_unique_visitors_bitmap(spark, sf_dir):
    return jobs.epoch_ms(jobs.unique_visitors_bitmap(_pv(spark, sf_dir)), "window_start", "window_end")


def q_unique_visitors_bitmap_shards(spark, sf_dir):
    return jobs.epoch_ms(jobs.unique_visitors_bitmap_shards(_pv(spark, sf_dir)), "window_start", "window_end")


def q_unique_visitors_running(spark, sf_dir):
    return jobs.epoch_ms(jobs.unique_visitors_running(_pv(spark, sf_dir)), "window_start", "window_end")


SKETCH_LG_K = 12
SKETCH_SIGMAS = 4  # stated bound: within 4 standard errors (1.04 / sqrt(2^k) of the count), or one visitor


def q_unique_visitors_sketch(spark, sf_dir):
    """The exact count of every window and whether the sketch's estimate keeps its stated error bound."""
    pv = _pv(spark, sf_dir)
    sketch = jobs.unique_visitors_sketch(pv, lg_config_k=SKETCH_LG_K).withColumnRenamed("uv", "estimate")
    exact = jobs.unique_visitors(pv)
    bound = F.greatest(F.lit(1.0), F.col("uv") * (SKETCH_SIGMAS * 1.04 / 2 ** (SKETCH_LG_K / 2)))
    both = exact.join(sketch, ["window_start", "window_end"], "full").select(
        "window_start", "window_end", "uv", (F.abs(F.col("estimate") - F.col("uv")) <= bound).alias("within_bound"))
    return jobs.epoch_ms(both, "window_start", "window_end")


def q_page_views_printed(spark, sf_dir):
    """Page views with the window bounds as ``Timestamp.toString`` text."""
    return jobs.as_printed(jobs.page_views(_pv(spark, sf_dir)), "window_start", "window_end")


def q_hot_items(spark, sf_dir):
    return jobs.epoch_ms(jobs.hot_items(_pv(spark, sf_dir)), "window_end")


def q_hot_items_report(spark, sf_dir):
    return jobs.epoch_ms(jobs.item_report(jobs.hot_items(_pv(spark, sf_dir))), "window_end")


def q_hot_urls(spark, sf_dir):
    return jobs.epoch_ms(jobs.hot_urls(_logs(spark, sf_dir)), "window_end")


def q_hot_urls_report(spark, sf_dir):
    return jobs.epoch_ms(jobs.url_report(jobs.hot_urls(_logs(spark, sf_dir))), "window_end")


def q_item_average_time(spark, sf_dir):
    """A4 (defined, unused in the reference): integer-division mean of event seconds per item and day."""
    pv = _pv(spark, sf_dir).where(F.col("behavior") == "pv")
    res = tumbling_aggregate(pv, "item_id", "event_time", "1 day", integer_average("ts").alias("avg_ts"),
                             count_name=None)
    return res.select(to_epoch_millis("window_end").alias("window_end"), "item_id", "avg_ts")


def _marketing(spark, sf_dir):
    return tables.marketing(tables.events(spark, sf_dir), exclude=(tables.EXCLUDED_MARKETING_BEHAVIOR,))


def q_marketing_total(spark, sf_dir):
    res = jobs.marketing_total(_marketing(spark, sf_dir))
    return jobs.epoch_ms(res, "window_start", "window_end")


def q_marketing_by_channel(spark, sf_dir):
    res = jobs.marketing_by_channel(_marketing(spark, sf_dir))
    return jobs.epoch_ms(res, "window_start", "window_end")


def _ads(spark, sf_dir):
    return jobs.ad_clicks_by_province(tables.ad_clicks(tables.events(spark, sf_dir)), max_count=AD_CAP)


def q_ad_clicks_capped(spark, sf_dir):
    return _ads(spark, sf_dir).passed.select("user_id", "ad_id", "province", "ts", "seq")


def q_ad_blacklist(spark, sf_dir):
    return _ads(spark, sf_dir).blacklist


def q_ad_clicks_by_province(spark, sf_dir):
    return jobs.epoch_ms(_ads(spark, sf_dir).by_province, "window_end")


def q_login_fail_warnings(spark, sf_dir):
    return jobs.login_fail_warnings(tables.logins(tables.events(spark, sf_dir)), LOGIN_MAX_FAILS, LOGIN_WITHIN)


def q_login_fail_bursts(spark, sf_dir):
    return jobs.login_fail_burst_rows(tables.logins(tables.events(spark, sf_dir)), LOGIN_MAX_FAILS, LOGIN_WITHIN)


def q_parse_access_log(spark, sf_dir):
    """S6 over the whole table rendered as access-log lines."""
    return _logs(spark, sf_dir).select("ip", "user_id", to_epoch_millis("event_time").alias("event_time"),
                                       "method", "url")


def q_parse_user_behavior(spark, sf_dir):
    """S3 over the whole table rendered as CSV lines (with padding spaces the parser trims)."""
    lines = tables.user_behavior_lines(tables.events(spark, sf_dir))
    return parse_user_behavior(lines).rows.drop("event_time", "seq")


def q_parse_ad_clicks(spark, sf_dir):
    """S4 over the whole table rendered as CSV lines; ``event_time`` is F3, ``seq`` the caller's order."""
    rows = parse_ad_clicks(tables.ad_click_lines(tables.events(spark, sf_dir)), seq="seq").rows
    return jobs.epoch_ms(rows, "event_time")


def q_parse_logins(spark, sf_dir):
    """S5 over the whole table rendered as CSV lines."""
    return jobs.epoch_ms(parse_logins(tables.login_lines(tables.events(spark, sf_dir)), seq="seq").rows, "event_time")


def q_parse_rejects(spark, sf_dir):
    """Lines and rejected lines of every parser: with the parsers' rows they account for each event."""
    ev = tables.events(spark, sf_dir)
    out = None
    for name, parsed in (("access_log", parse_apache_log(tables.apache_log_lines(ev))),
                         ("ad_clicks", parse_ad_clicks(tables.ad_click_lines(ev), seq="seq")),
                         ("logins", parse_logins(tables.login_lines(ev), seq="seq")),
                         ("user_behavior", parse_user_behavior(tables.user_behavior_lines(ev)))):
        lines = parsed.rows.select(F.lit(0).alias("bad")).unionByName(parsed.rejects.select(F.lit(1).alias("bad")))
        part = lines.agg(F.count("*").alias("n_lines"), F.coalesce(F.sum("bad"), F.lit(0)).alias("n_rejects")).select(
            F.lit(name).alias("parser"), "n_lines", "n_rejects")
        out = part if out is None else out.unionByName(part)
    return out


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "page_views": q_page_views,
    "unique_visitors": q_unique_visitors,
    "unique_visitors_bitmap": q_unique_visitors_bitmap,
    "unique_visitors_bitmap_shards": q_unique_visitors_bitmap_shards,
    "unique_visitors_running": q_unique_visitors_running,
    "unique_visitors_sketch": q_unique_visitors_sketch,
    "hot_items": q_hot_items,
    "hot_items_report": q_hot_items_report,
    "hot_urls": q_hot_urls,
    "hot_urls_report": q_hot_urls_report,
    "item_average_time": q_item_average_time,
    "marketing_total": q_marketing_total,
    "marketing_by_channel": q_marketing_by_channel,
    "ad_clicks_capped": q_ad_clicks_capped,
    "ad_blacklist": q_ad_blacklist,
    "ad_clicks_by_province": q_ad_clicks_by_province,
    "login_fail_warnings": q_login_fail_warnings,
    "login_fail_bursts": q_login_fail_bursts,
    "parse_access_log": q_parse_access_log,
    "parse_user_behavior": q_parse_user_behavior,
    "parse_ad_clicks": q_parse_ad_clicks,
    "parse_logins": q_parse_logins,
    "parse_rejects": q_parse_rejects,
    "page_views_printed": q_page_views_printed,
}
