"""Out-of-order and late rows: streams against batch, and wide windows against plain windowed counts."""

import os
import random

import pytest
from pyspark.sql import functions as F

from rivulet.operators.patterns import click_cap, login_fail_episodes
from rivulet.operators.windows import sliding_count
from rivulet.plans import jobs
from rivulet.streaming.jobs import (click_cap_stream, login_fail_warnings_stream, read_url_ranking, start_ad_pipeline,
                                    start_url_revisions)
from rivulet.streaming.sinks import _bases, read_latest, start, upsert_latest

T0 = 1_600_000_000


def _stream(spark, scratch, batches, schema, names):
    """Each list of rows is one micro-batch; times are seconds after T0."""
    src = os.path.join(scratch, "src")
    for n, rows in enumerate(batches):
        df = spark.createDataFrame(rows, schema).select(*[F.timestamp_seconds(F.col(c) + T0).alias(c) if c == "event_time" else c for c in names])
        tmp = os.path.join(src, f"b{n:03d}")
        df.coalesce(1).write.parquet(tmp)
        for root, _, files in os.walk(tmp):
            for x in files:
                os.utime(os.path.join(root, x), (T0 + n, T0 + n))
    kind = spark.read.parquet(os.path.join(src, "b000")).schema
    return (spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(src),
            spark.read.option("recursiveFileLookup", "true").parquet(src))


def _run(df, scratch, name):
    q = start(df, name, fmt="memory", checkpoint=os.path.join(scratch, "ck", name))
    q.processAllAvailable()
    q.stop()
    return sorted(map(tuple, df.sparkSession.table(name).collect()), key=str)


WIN = ("k string, event_time long", ["k", "event_time"])


def _windows(spark, scratch, batches, size, slide, delay, keys, name):
    s, _ = _stream(spark, scratch, batches, *WIN)
    s = s.withWatermark("event_time", delay)
    out = []
    for method in ("direct", "delta"):
        got = sliding_count(s, keys, "event_time", size, slide, method=method)
        out.append(_run(got.select(*keys, F.unix_seconds("window_end").alias("e"), "count"), scratch, f"{name}_{method}"))
    last = T0 + 10 ** 6
    return [[r for r in rows if r[-2] < last] for rows in out]


def test_rows_in_any_order_within_the_delay(spark, scratch):
    batches = [[("a", 500)], [("a", 300)], [("a", 600)], [("a", 10 ** 6)], [("a", 10 ** 6 + 5000)]]
    direct, delta = _windows(spark, scratch, batches, "100 seconds", "5 seconds", "600 seconds", ["k"], "w_order")
    assert direct == delta and len(delta) == 60


def test_late_row_counts_in_the_windows_still_open(spark, scratch):
    batches = [[("a", 0), ("a", 50)], [("a", 60)], [("a", 60)], [("a", 20)], [("a", 10 ** 6)], [("a", 10 ** 6 + 5000)]]
    direct, delta = _windows(spark, scratch, batches, "100 seconds", "5 seconds", "0 seconds", ["k"], "w_late")
    assert direct == delta and len(delta) > 0


@pytest.mark.parametrize("size,slide", [("60 seconds", "5 seconds"), ("100 seconds", "5 seconds"), ("360 seconds", "1 second")])
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_wide_windows_equal_plain_windows(spark, scratch, size, slide, keys):
    r = random.Random(7)
    batches, now = [], 0
    for _ in range(6):
        now += 200
        batches.append([(r.choice("ab"), now + r.randint(-150, 0)) for _ in range(15)])
    batches += [[("a", 10 ** 6), ("b", 10 ** 6)], [("a", 10 ** 6 + 5000), ("b", 10 ** 6 + 5000)]]
    direct, delta = _windows(spark, scratch, batches, size, slide, "300 seconds", keys, f"w_{size[:3].strip()}_{len(keys)}")
    assert direct == delta and len(delta) > 0


def test_global_window_uses_several_keys(spark, scratch):
    s, _ = _stream(spark, scratch, [[("a", i) for i in range(50)]], *WIN)
    plan = sliding_count(s.withWatermark("event_time", "0 seconds"), [], "event_time", "100 seconds", "1 second", method="delta")
    text = plan._jdf.queryExecution().analyzed().toString()
    assert "_salt" in text and "TransformWithState" in text


def test_click_cap_around_midnight_equals_batch(spark, scratch):
    midnight = (T0 // 86400 + 1) * 86400 - T0
    row = lambda n, s: (1, 7, "p", "c", T0 + midnight + s, midnight + s, n)
    batches = [[row(0, -50), row(1, -40)], [row(2, 10), row(3, 20)], [row(4, -30)], [row(5, 30), row(6, 40)]]
    names = ["user_id", "ad_id", "province", "city", "ts", "event_time", "seq"]
    s, b = _stream(spark, scratch, batches, "user_id long, ad_id long, province string, city string, ts long, event_time long, seq long", names)
    got = _run(click_cap_stream(s, max_count=1, watermark="1 hour").select("kind", "seq"), scratch, "cap_midnight")
    assert [k for k, _ in got].count("pass") == 4 and [k for k, _ in got].count("warn") == 2
    assert click_cap(b, max_count=1).passed.count() == 4 and click_cap(b, max_count=1).warnings.count() == 2


def test_cap_day_is_utc_in_any_session_zone(spark):
    rows = spark.createDataFrame([(1, 1, 1_600_041_600 + i * 17_000, i) for i in range(5)], "user_id long, ad_id long, t long, seq long")
    rows = rows.withColumn("event_time", F.timestamp_seconds("t"))
    for zone in ("America/Los_Angeles", "UTC"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        assert click_cap(rows, max_count=1).passed.count() == 2
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_login_stream_equals_batch_out_of_order(spark, scratch):
    r = random.Random(11)
    rows = [(u, r.choice(["fail", "fail", "fail", "success"]), t, 0) for u in (1, 2) for t in r.sample(range(0, 400), 120)]
    rows = [(u, k, t, i) for i, (u, k, t, _) in enumerate(sorted(rows, key=lambda x: x[2] + r.uniform(0, 4.9)))]
    rows[:0] = [(9, "fail", 10, 1000), (9, "fail", 8, 1001), (9, "fail", 11, 1002)]
    batches = [rows[i:i + 40] for i in range(0, len(rows), 40)] + [[(5, "success", 5000, 2000)], [(5, "success", 9000, 2001)]]
    s, b = _stream(spark, scratch, batches, "user_id long, event_type string, event_time long, seq long", ["user_id", "event_type", "event_time", "seq"])
    cols = ["user_id", "first_fail_time", "last_fail_time", "fail_count", "msg"]
    got = _run(login_fail_warnings_stream(s, out_of_order="20 seconds").select(*cols), scratch, "login_order")
    want = sorted(map(tuple, login_fail_episodes(b).select(*cols).collect()), key=str)
    assert got == want and (9, T0 + 8, T0 + 10, 2, "login fail in 2 second for 2 times.") in got


def test_ads_pipeline_available_now(spark, scratch):
    from conftest import fixture_path

    from rivulet.sources import parse_ad_clicks

    os.makedirs(os.path.join(scratch, "in"))
    lines = open(fixture_path("ad_clicks.csv")).read().splitlines()
    for n, part in enumerate([lines[:70], lines[70:], ["1,1,zz,zz,1511800000"], ["1,2,zz,zz,1511900000"]]):
        path = os.path.join(scratch, "in", f"{n}.csv")
        open(path, "w").write("\n".join(part) + "\n")
        os.utime(path, (T0 + n, T0 + n))
    raw = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(os.path.join(scratch, "in"))
    p = start_ad_pipeline(parse_ad_clicks(raw).rows, os.path.join(scratch, "ads"), checkpoint_root=os.path.join(scratch, "ck"), available_now=True)
    p.cap.awaitTermination()
    p.by_province.awaitTermination()
    out = spark.read.parquet(p.by_province_path).where("province <> 'zz'")
    assert out.count() == 5988
    assert p.blacklist(spark).count() == 1


def test_reports_on_streams_equal_batch(spark, scratch):
    from test_streaming import _behavior_stream

    stream, _ = _behavior_stream(spark, scratch)
    got = _run(jobs.hot_items_report(stream).where(~F.col("report").contains("商品ID=-1")), scratch, "t_report")
    from conftest import SF001

    from rivulet.sources import tables

    batch = jobs.hot_items_report(tables.user_behavior(tables.events(spark, SF001)))
    assert got == sorted(map(tuple, batch.collect()), key=str) and len(got) > 0
    with pytest.raises(ValueError):
        jobs.item_report(jobs.hot_items(stream))


def test_url_revisions_end_at_the_batch_result(spark, scratch):
    r = random.Random(5)
    batches = [[(f"/u{r.randint(0, 4)}", 60 * n + r.randint(-30, 30)) for _ in range(30)] for n in range(1, 5)]
    s, b = _stream(spark, scratch, batches, "url string, event_time long", ["url", "event_time"])
    path = os.path.join(scratch, "urls")
    q = start_url_revisions(s, "urls", path, checkpoint=os.path.join(scratch, "ck"), allowed_lateness="300 seconds")
    q.processAllAvailable()
    q.stop()
    got = sorted(map(tuple, read_url_ranking(spark, path).collect()), key=str)
    assert got == sorted(map(tuple, jobs.hot_urls(b).collect()), key=str)


def test_upserted_table_is_compacted(spark, scratch):
    batches = [[("a", n), (f"k{n}", n)] for n in range(8)]
    s, _ = _stream(spark, scratch, batches, *WIN)
    path = os.path.join(scratch, "up")
    q = upsert_latest(s, "compact", path, "k", "event_time", output_mode="append", checkpoint=os.path.join(scratch, "ck"), compact_every=3)
    q.processAllAvailable()
    q.stop()
    got = {x.k: int(x.event_time.timestamp()) - T0 for x in read_latest(spark, path, "k").collect()}
    assert {k for k in got} == {"a", *(f"k{n}" for n in range(8))}
    assert max(got.values()) - got["a"] == 0
    assert _bases(spark, path) == [3, 6]


def test_parsers_trim_control_characters_and_take_an_order(spark):
    from rivulet.sources import parse_user_behavior

    lines = spark.createDataFrame([("1,2,3,\tpv\x0b,\x004 ", 9)], "value string, line long")
    got = parse_user_behavior(lines, seq="line").rows.collect()
    assert [(x.behavior, x.ts, x.seq) for x in got] == [("pv", 4, 9)]
    assert parse_user_behavior(lines).rows.first().seq != 9


def test_no_local_checkpoint_folder_on_a_cluster(monkeypatch):
    from rivulet import session

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return type("C", (), {"get": lambda *a: None})()

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, *a):
            return None

    fake = type("S", (), {"conf": Conf(), "sparkContext": Context()})()
    with pytest.raises(ValueError):
        session.checkpoint_dir(fake)
