"""Typed record schemas of the five inputs (S3-S6) and their line parsers.

Each parser takes a DataFrame with a string ``value`` column (a text file, a
Kafka topic, or a directory stream) and returns ``Parsed(rows, rejects)``:
rows that parse fully, typed, plus an ``event_time`` TIMESTAMP; and the raw
lines that do not, so one bad line never stops a job. Parsing is
``split`` + ``trim`` + ``try_cast``: JVM-side, in whole-stage codegen, and the
same code serves batch and streaming inputs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.timefmt import parse_log_time

USER_BEHAVIOR = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("category_id", T.IntegerType()),
    T.StructField("behavior", T.StringType()),
    T.StructField("ts", T.LongType()),  # epoch seconds
])

AD_CLICK = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("ad_id", T.LongType()),
    T.StructField("province", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("ts", T.LongType()),  # epoch seconds
])

LOGIN = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("ip", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("ts", T.LongType()),  # epoch seconds
])

MARKETING = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("behavior", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("ts", T.LongType()),  # epoch milliseconds
])

APACHE_LOG = T.StructType([
    T.StructField("ip", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("method", T.StringType()),
    T.StructField("url", T.StringType()),
])


@dataclass
class Parsed:
    rows: DataFrame
    rejects: DataFrame


def _fields(sep: str) -> Column:
    return F.split(F.col("value"), sep)


_TRIMMED = "".join(map(chr, range(33)))  # every character up to the blank, as Java's String.trim


def _trim(c: Column) -> Column:
    return F.btrim(c, F.lit(_TRIMMED))


def _keep_valid(lines: DataFrame, fields: list[Column], names: list[str], seq: str | None = None) -> Parsed:
    """Build each record once; keep it when every field parsed.

    ``inline(filter(array(rec), all fields non-null))`` yields 0 or 1 rows
    per line without a Filter node: a filter on parsed columns would be
    pushed down to the scan with the parse expressions inlined, evaluating
    them twice and before any repartitioning.
    """
    # seq orders rows with equal event times: the caller's column (offset, line number), else a content hash
    order = F.xxhash64("value") if seq is None else F.col(seq)
    recs = lines.select(F.col("value"), F.struct(*[c.alias(n) for c, n in zip(fields, names)],
                                                 order.alias("seq")).alias("_rec"))

    def valid(r):
        cond = F.lit(True)
        for n in names:
            cond = cond & r[n].isNotNull()
        return cond

    kept = F.filter(F.array(F.col("_rec")), valid)
    rows = recs.select(F.inline(kept))
    rejects = recs.where(F.size(kept) == 0).select("value")
    return Parsed(rows, rejects)


def _delimited(lines: DataFrame, schema: T.StructType, sep: str, time_unit: str, seq: str | None = None) -> Parsed:
    """Positional fields; every field trimmed and cast; the line must hold all of them."""
    parts = _fields(sep)
    cols = [_trim(F.get(parts, i)).try_cast(f.dataType) if f.dataType != T.StringType() else _trim(F.get(parts, i))
            for i, f in enumerate(schema.fields)]
    parsed = _keep_valid(lines, cols, schema.fieldNames(), seq)
    ts = F.col("ts")
    event_time = F.timestamp_seconds(ts) if time_unit == "s" else F.timestamp_millis(ts)
    return Parsed(parsed.rows.withColumn("event_time", event_time), parsed.rejects)


def parse_user_behavior(lines: DataFrame, seq: str | None = None) -> Parsed:
    """S3: 'user,item,category,behavior,ts' -> UserBehavior."""
    return _delimited(lines, USER_BEHAVIOR, ",", "s", seq)


def parse_ad_clicks(lines: DataFrame, seq: str | None = None) -> Parsed:
    """S4: 'user,ad,province,city,ts' -> AdClickEvent."""
    return _delimited(lines, AD_CLICK, ",", "s", seq)


def parse_logins(lines: DataFrame, seq: str | None = None) -> Parsed:
    """S5: 'user,ip,type,ts' -> LoginEvent."""
    return _delimited(lines, LOGIN, ",", "s", seq)


def parse_marketing(lines: DataFrame, seq: str | None = None) -> Parsed:
    """'user,behavior,channel,ts_ms' -> MarketingUserBehavior."""
    return _delimited(lines, MARKETING, ",", "ms", seq)


def parse_apache_log(lines: DataFrame, seq: str | None = None) -> Parsed:
    """Split on single spaces; tokens 0 ip, 1 user, 3 time, 5 method, 6 url."""
    parts = _fields(" ")
    cols = [_trim(F.get(parts, 0)), _trim(F.get(parts, 1)), parse_log_time(_trim(F.get(parts, 3))),
            _trim(F.get(parts, 5)), _trim(F.get(parts, 6))]
    return _keep_valid(lines, cols, APACHE_LOG.fieldNames(), seq)
