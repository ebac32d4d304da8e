import datetime as dt

import pytest
from pyspark.sql import functions as F

from rivulet.functions import date_string, duration_ms, parse_log_time, poly_hash, sql_timestamp_string


@pytest.mark.parametrize("value,expected", [("543462", 398203944), ("937166", 5543688), ("7", 55), ("", 0)])
def test_poly_hash_golden(spark, value, expected):
    assert spark.range(1).select(poly_hash(F.lit(value))).first()[0] == expected


def test_poly_hash_matches_java_wrapping_arithmetic(spark):
    def java_hash(s, seed=61, bits=29):
        r = 0
        for ch in s:
            r = (r * seed + ord(ch)) & 0xFFFFFFFFFFFFFFFF  # 64-bit wrap
        return r & ((1 << bits) - 1)

    words = ["a", "user-123", "x" * 40, "9" * 25, "Zz09_!"]
    got = spark.createDataFrame([(w,) for w in words], "s string").select(poly_hash("s")).collect()
    assert [r[0] for r in got] == [java_hash(w) for w in words]


def test_log_time_parse_strict(spark):
    row = spark.range(1).select(parse_log_time(F.lit("17/05/2015:10:05:03")).alias("a"),
                                parse_log_time(F.lit("32/05/2015:10:05:03")).alias("b")).first()
    assert row.a == dt.datetime(2015, 5, 17, 10, 5, 3)
    assert row.b is None


def test_timestamp_renderings(spark):
    ts = F.lit("2017-11-26 09:00:00").cast("timestamp")
    frac = F.lit("2017-11-26 09:00:00.120").cast("timestamp")
    row = spark.range(1).select(sql_timestamp_string(ts).alias("a"), date_string(ts).alias("b"),
                                sql_timestamp_string(frac).alias("c")).first()
    assert row.a == "2017-11-26 09:00:00.0"
    assert row.b == "Sun Nov 26 09:00:00 UTC 2017"
    assert row.c == "2017-11-26 09:00:00.12"


def test_durations():
    assert duration_ms("1 hour") == 3_600_000
    assert duration_ms("5 seconds") == 5000
    assert duration_ms(dt.timedelta(minutes=5)) == 300_000
    with pytest.raises(ValueError):
        duration_ms("5 fortnights")


def test_poly_hash_non_ascii_bmp(spark):
    """Inside the BMP a character's code point is its UTF-16 unit, so the hash equals Java's."""
    word = "用户é7"
    r = 0
    for ch in word:
        r = (r * 61 + ord(ch)) & 0xFFFFFFFFFFFFFFFF
    assert spark.range(1).select(poly_hash(F.lit(word))).first()[0] == r & ((1 << 29) - 1)
