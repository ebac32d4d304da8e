"""Adapters from the driver's ``events`` table to the reference's record types.

The driver tables (``events``: event_id, ts TIMESTAMP_NTZ, user_id, event_type
in {click, error, purchase, signup, view}, value, props '{"k": n}') stand in
for the reference's click, log, marketing, ad and login streams. The mapping
is a set of column expressions, so filters and column pruning still reach the
parquet scan. Every adapter keeps ``seq`` (= event_id) as a total-order
tie-breaker and ``event_time`` as a TIMESTAMP (watermarks refuse NTZ).

The same mapping is written in SQL in ``rivulet.plans.oracle`` for the DuckDB
checks; change both together.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.functions.timefmt import LOG_TIME_FORMAT
from rivulet.session import raise_shuffle_partitions

# --- fixed values: names used by the reference's inputs -------------------
CHANNELS = ["wechat", "weibo", "appstore", "huaweistore"]
PROVINCES = ["beijing", "guangdong", "hebei", "henan", "jiangsu", "shanghai", "zhejiang"]
EXCLUDED_MARKETING_BEHAVIOR = "UNINSTALL"
# ---------------------------------------------------------------------------

# stand-in code lists (ours): event types in sorted order give ad ids 1..5
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as its files split; shuffle partitions are raised to what its size needs."""
    raise_shuffle_partitions(spark, os.path.join(sf_dir, "events.parquet"))
    return table(spark, sf_dir, "events")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("long")


def _t() -> Column:
    return F.col("ts").cast("timestamp")


def user_behavior(ev: DataFrame, only=None) -> DataFrame:
    """UserBehavior: item = props.k, category = k div 10, 'view' plays 'pv'.

    ``only``: the behaviours the caller keeps. Catalyst cannot invert the
    CASE mapping, so the raw event types that can map to them are filtered
    here, where the predicate reaches the parquet scan (``PushedFilters``).
    The job's own filter still decides; this only drops rows it would drop.
    """
    if only is not None:
        raw = {("view" if b == "pv" else b) for b in only} | set(only)
        ev = ev.where(F.col("event_type").isin(*sorted(raw)))
    return ev.select(
        F.col("user_id"),
        _k().alias("item_id"),
        (_k() / 10).cast("int").alias("category_id"),
        F.when(F.col("event_type") == "view", F.lit("pv")).otherwise(F.col("event_type")).alias("behavior"),
        F.unix_seconds(_t()).alias("ts"),
        _t().alias("event_time"),
        F.col("event_id").alias("seq"),
    )


def _ip() -> Column:
    """10.a.b.c from the user id (user_id >= 0); NULL without one."""
    return F.expr(
        "concat('10.', cast((user_id div 65536) % 256 AS STRING), '.', "
        "cast((user_id div 256) % 256 AS STRING), '.', cast(user_id % 256 AS STRING))"
    )


def _url() -> Column:
    return F.concat(F.lit("/"), F.col("event_type"), F.lit("/"), _k().cast("string"))


def _line(sep: str, *fields: Column) -> Column:
    """Fields joined to a line; a NULL is an empty field, so the others keep their places."""
    return F.concat_ws(sep, *[F.coalesce(f.cast("string"), F.lit("")) for f in fields]).alias("value")


def user_behavior_lines(ev: DataFrame) -> DataFrame:
    """UserBehavior rows rendered as CSV lines, with padding spaces that the parser trims."""
    return user_behavior(ev).select(_line(", ", *map(F.col, ("user_id", "item_id", "category_id", "behavior", "ts"))))


def apache_log_lines(ev: DataFrame) -> DataFrame:
    """Events rendered as access-log lines: 'ip user - dd/MM/yyyy:HH:mm:ss +0000 METHOD url'."""
    method = F.when(F.col("event_type").isin("purchase", "signup"), F.lit("POST")).otherwise(F.lit("GET"))
    return ev.select(_line(
        " ", _ip(), F.col("user_id"), F.lit("-"), F.date_format(_t(), LOG_TIME_FORMAT), F.lit("+0000"), method, _url()))


def ad_click_lines(ev: DataFrame) -> DataFrame:
    """AdClickEvent rows rendered as CSV lines, with the tab and carriage return that the parser trims."""
    c = ad_clicks(ev)
    return c.select(_line(",", *map(F.col, ("user_id", "ad_id", "province", "city")),
                          F.concat(F.lit("\t"), F.col("ts").cast("string"), F.lit("\r"))), "seq")


def login_lines(ev: DataFrame) -> DataFrame:
    """LoginEvent rows rendered as CSV lines."""
    c = logins(ev)
    return c.select(_line(", ", *map(F.col, ("user_id", "ip", "event_type", "ts"))), "seq")


def marketing(ev: DataFrame, exclude=None) -> DataFrame:
    """MarketingUserBehavior: 'signup' plays UNINSTALL, channel by k mod 4.

    ``exclude``: behaviours the caller drops; for UNINSTALL the raw 'signup'
    rows are dropped at the scan (see ``user_behavior``).
    """
    if exclude is not None and EXCLUDED_MARKETING_BEHAVIOR in exclude:
        ev = ev.where(F.col("event_type") != "signup")
    channels = F.array(*[F.lit(c) for c in CHANNELS])
    return ev.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.when(F.col("event_type") == "signup", F.lit(EXCLUDED_MARKETING_BEHAVIOR))
        .otherwise(F.upper("event_type")).alias("behavior"),
        F.element_at(channels, (F.pmod(_k(), F.lit(len(CHANNELS))) + 1).cast("int")).alias("channel"),
        F.unix_millis(_t()).alias("ts"),
        _t().alias("event_time"),
        F.col("event_id").alias("seq"),
    )


def ad_clicks(ev: DataFrame) -> DataFrame:
    """AdClickEvent: ad id by event type, province by user id mod 7."""
    provinces = F.array(*[F.lit(p) for p in PROVINCES])
    province = F.element_at(provinces, (F.pmod("user_id", F.lit(len(PROVINCES))) + 1).cast("int"))
    return ev.select(
        F.col("user_id"),
        F.array_position(F.array(*[F.lit(e) for e in EVENT_TYPES]), F.col("event_type")).alias("ad_id"),
        province.alias("province"),
        province.alias("city"),
        F.unix_seconds(_t()).alias("ts"),
        _t().alias("event_time"),
        F.col("event_id").alias("seq"),
    )


def logins(ev: DataFrame) -> DataFrame:
    """LoginEvent: 'error' plays a failed login, every other type a success."""
    return ev.select(
        F.col("user_id"),
        _ip().alias("ip"),
        F.when(F.col("event_type") == "error", F.lit("fail")).otherwise(F.lit("success")).alias("event_type"),
        F.unix_seconds(_t()).alias("ts"),
        _t().alias("event_time"),
        F.col("event_id").alias("seq"),
    )
