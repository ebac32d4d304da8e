"""Stream = batch parity. Inputs are written as files into a folder read as a
stream one file per micro-batch; a final sentinel row far in the future moves
the watermark past every window (a bounded input is flushed at its end in the
reference; Spark's append mode needs the watermark to pass)."""

import os

import pytest
from conftest import SF001, fixture_path
from pyspark.sql import functions as F

from rivulet.plans import jobs
from rivulet.sources import parse_ad_clicks, parse_logins, tables
from rivulet.streaming.jobs import click_cap_stream, login_fail_warnings_stream
from rivulet.streaming.sinks import read_latest, start, top_n_per_batch, upsert_latest


def _text_stream(spark, scratch, lines, per_file, sentinel):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    lines = lines + [sentinel]
    for n, i in enumerate(range(0, len(lines), per_file)):
        f = os.path.join(src, f"part{n:04d}.txt")
        with open(f, "w") as fh:
            fh.write("\n".join(lines[i:i + per_file]) + "\n")
        os.utime(f, (1_600_000_000 + n, 1_600_000_000 + n))  # file source orders by mtime
    return spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(src)


def _run(df, scratch, name, mode="append", prefix=None):
    q = start(df, name, fmt="memory", output_mode=mode, checkpoint=os.path.join(scratch, "ckpt", name), prefix=prefix)
    q.processAllAvailable()
    q.stop()
    return df.sparkSession.table(name)


def test_login_warnings_stream(spark, scratch):
    lines = open(fixture_path("logins.csv")).read().splitlines()
    raw = _text_stream(spark, scratch, lines, 20, "9999,1.1.1.1,success,1558500000")
    out = _run(login_fail_warnings_stream(parse_logins(raw).rows), scratch, "t_login", prefix="LoginFail")
    assert {r.sink for r in out.collect()} == {"LoginFail"}
    got = [tuple(r) for r in out.select("user_id", "first_fail_time", "last_fail_time", "msg").collect()]
    assert got == [(1035, 1558430842, 1558430844, "login fail in 2 second for 3 times.")]


def test_click_cap_stream(spark, scratch):
    lines = open(fixture_path("ad_clicks.csv")).read().splitlines()
    raw = _text_stream(spark, scratch, lines, 50, "1,1,zz,zz,1511800000")
    out = _run(click_cap_stream(parse_ad_clicks(raw).rows, max_count=100), scratch, "t_cap")
    assert out.where("kind = 'pass' AND province <> 'zz'").count() == 123
    warn = [tuple(r) for r in out.where("kind = 'warn'").select("user_id", "ad_id", "ts", "msg").collect()]
    assert warn == [(937166, 1715, 1511661702, "click over 100 times today.")]


def _behavior_stream(spark, scratch):
    """sf0.001 events as UserBehavior rows, three parquet files in time order plus a sentinel."""
    b = tables.user_behavior(tables.events(spark, SF001)).toPandas()
    b = b.sort_values("event_time")
    src = os.path.join(scratch, "behavior")
    os.makedirs(src)
    parts = [b.iloc[: len(b) // 3], b.iloc[len(b) // 3: 2 * len(b) // 3], b.iloc[2 * len(b) // 3:]]
    sentinel = b.iloc[:1].copy()
    sentinel["event_time"] = sentinel["event_time"] + __import__("pandas").Timedelta(days=30)
    sentinel["item_id"] = -1
    # a page view: Catalyst pushes the job's filter below the watermark node, so only
    # rows that pass it move the watermark
    sentinel["behavior"] = "pv"
    for n, p in enumerate(parts + [sentinel]):
        f = os.path.join(src, f"p{n}.parquet")
        spark.createDataFrame(p).coalesce(1).write.parquet(f)
        for root, _, files in os.walk(f):
            for x in files:
                os.utime(os.path.join(root, x), (1_600_000_000 + n, 1_600_000_000 + n))
    schema = spark.read.parquet(os.path.join(src, "p0.parquet")).schema
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(src))
    return stream, b


def test_windowed_jobs_stream_equal_batch(spark, scratch):
    stream, _ = _behavior_stream(spark, scratch)
    batch = tables.user_behavior(tables.events(spark, SF001))
    cutoff = batch.agg(F.max("event_time")).first()[0]

    pv_s = _run(jobs.page_views(stream), scratch, "t_pv").where(F.col("window_start") <= cutoff)
    assert sorted(map(tuple, pv_s.collect())) == sorted(map(tuple, jobs.page_views(batch).collect()))

    uv_s = _run(jobs.unique_visitors(stream), scratch, "t_uv").where(F.col("window_start") <= cutoff)
    assert sorted(map(tuple, uv_s.collect())) == sorted(map(tuple, jobs.unique_visitors(batch).collect()))


def test_hot_items_stream_equal_batch(spark, scratch):
    stream, _ = _behavior_stream(spark, scratch)
    batch = tables.user_behavior(tables.events(spark, SF001))
    got = _run(jobs.hot_items(stream), scratch, "t_hot").where("item_id <> -1")
    exp = jobs.hot_items(batch)
    assert sorted(map(tuple, got.select("window_end", "rank", "item_id", "count").collect())) == \
        sorted(map(tuple, exp.collect()))


def test_upsert_latest_keeps_last_value(spark, scratch):
    stream, _ = _behavior_stream(spark, scratch)
    batch = tables.user_behavior(tables.events(spark, SF001))
    path = os.path.join(scratch, "uv_table")
    q = upsert_latest(jobs.unique_visitors_sketch(stream), "t_upsert", path, "window_end", "uv",
                      checkpoint=os.path.join(scratch, "ckpt", "upsert"))
    q.processAllAvailable()
    q.stop()
    exp = jobs.unique_visitors_sketch(batch)
    cutoff = exp.agg(F.max("window_end")).first()[0]
    latest = read_latest(spark, path, "window_end").where(F.col("window_end") <= cutoff)
    assert sorted((r.window_end, r.uv) for r in latest.collect()) == sorted((r.window_end, r.uv) for r in exp.collect())


def test_top_n_per_batch_sink_equals_batch(spark, scratch):
    from rivulet.operators.windows import sliding_count

    stream, _ = _behavior_stream(spark, scratch)
    batch = tables.user_behavior(tables.events(spark, SF001))
    pv = stream.where("behavior = 'pv'").withWatermark("event_time", "0 seconds")
    counts = sliding_count(pv, "item_id", "event_time", "1 hour", "5 minutes", method="direct")
    path = os.path.join(scratch, "top")
    q = top_n_per_batch(counts, "t_topbatch", path, "item_id", 3, checkpoint=os.path.join(scratch, "ckpt", "top"))
    q.processAllAvailable()
    q.stop()
    got = spark.read.parquet(path).drop("batch_id").where("item_id <> -1")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, jobs.hot_items(batch).collect()))


@pytest.mark.parametrize("method", ["pane", "auto"])
def test_marketing_pane_chain_stream_equal_batch(spark, scratch, method):
    """Wide sliding windows on a stream: chained aggregations ('pane') or the pane-count processor ('auto')."""
    import pandas as pd

    m = tables.marketing(tables.events(spark, SF001)).toPandas().sort_values("event_time")
    src = os.path.join(scratch, "mk")
    os.makedirs(src)
    sentinel = m.iloc[:1].copy()
    sentinel["event_time"] = sentinel["event_time"] + pd.Timedelta(days=30)
    sentinel["behavior"], sentinel["channel"] = "CLICK", "zz"
    parts = [m.iloc[: len(m) // 2], m.iloc[len(m) // 2:], sentinel]
    for n, p in enumerate(parts):
        f = os.path.join(src, f"p{n}.parquet")
        spark.createDataFrame(p).coalesce(1).write.parquet(f)
        for root, _, files in os.walk(f):
            for x in files:
                os.utime(os.path.join(root, x), (1_600_000_000 + n, 1_600_000_000 + n))
    schema = spark.read.parquet(os.path.join(src, "p0.parquet")).schema
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(src))
    got = _run(jobs.marketing_by_channel(stream, size="10 minutes", slide="10 seconds", method=method),
               scratch, f"t_mk_{method}").where("channel <> 'zz'")
    batch = tables.marketing(tables.events(spark, SF001))
    exp = jobs.marketing_by_channel(batch, size="10 minutes", slide="10 seconds")
    assert got.count() == exp.count() > 0
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))


def test_ads_job_stream_equal_batch(spark, scratch):
    """Keyed stateful cap, then a windowed count on its output, in one streaming query."""
    from rivulet.streaming.jobs import ad_clicks_by_province_stream

    lines = open(fixture_path("ad_clicks.csv")).read().splitlines()
    raw = _text_stream(spark, scratch, lines, 50, "1,1,zz,zz,1511800000")
    res = ad_clicks_by_province_stream(parse_ad_clicks(raw).rows, max_count=100, size="1 minute", slide="5 seconds")
    got = _run(res.by_province, scratch, "t_ads_prov").where("province <> 'zz'")
    batch = jobs.ad_clicks_by_province(parse_ad_clicks(spark.read.text(fixture_path("ad_clicks.csv"))).rows,
                                       max_count=100, size="1 minute", slide="5 seconds")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.by_province.collect()))


def test_hot_urls_stream_allowed_lateness(spark, scratch):
    """The watermark trails by 1 s out-of-orderness + 60 s lateness; later rows are dropped."""
    import datetime as dt

    from rivulet.sources import parse_apache_log

    def line(t, url):
        stamp = dt.datetime.fromtimestamp(t, dt.timezone.utc).strftime("%d/%m/%Y:%H:%M:%S")
        return f"10.0.0.1 u - {stamp} +0000 GET {url}"

    src = os.path.join(scratch, "logs")
    os.makedirs(src)
    batches = [
        [line(1_000_000 + i, "/a") for i in range(5)] + [line(1_000_005, "/b")],
        [line(1_000_100, "/a")],  # watermark -> 1_000_100 - 61 s = 1_000_039
        # Spark filters late rows by the previous batch's watermark: one more batch before it applies
        [line(1_000_100, "/a")],
        [line(1_000_050, "/b"), line(1_000_000, "/c")],  # 50 s late; 100 s late
        [line(1_100_000, "/z")],  # sentinel
    ]
    for n, rows in enumerate(batches):
        f = os.path.join(src, f"b{n}.txt")
        with open(f, "w") as fh:
            fh.write("\n".join(rows) + "\n")
        os.utime(f, (1_600_000_000 + n, 1_600_000_000 + n))
    raw = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(src)
    out = _run(jobs.hot_urls(parse_apache_log(raw).rows), scratch, "t_urls")
    at = lambda sec: dt.datetime(1970, 1, 1) + dt.timedelta(seconds=sec)
    # like a windowed operator with allowed lateness: the 100 s late row is dropped from the windows the
    # watermark (1_000_039) already closed, and still counted in the open ones (ends 1_000_040 .. 1_000_060)
    assert sorted(r.window_end for r in out.where("url = '/c'").collect()) == [at(1_000_040 + 5 * i) for i in range(5)]
    end = at(1_000_060)
    b_counts = {r.window_end: r["count"] for r in out.where("url = '/b'").collect()}
    assert b_counts[end] == 2  # the window [1_000_000, 1_000_060) holds /b at +5 s and the late /b at +50 s


def test_login_stream_equal_batch_on_events(spark, scratch):
    """Event-time timers across micro-batches give the batch episodes (input in time order)."""
    import pandas as pd

    from rivulet.operators.patterns import login_fail_episodes

    lg = tables.logins(tables.events(spark, SF001)).select("user_id", "event_type", "event_time", "seq")
    pdf = lg.toPandas().sort_values(["event_time", "seq"])
    sentinel = pd.DataFrame({"user_id": [-1], "event_type": ["success"],
                             "event_time": [pdf["event_time"].max() + pd.Timedelta(days=30)], "seq": [-1]})
    src = os.path.join(scratch, "lg")
    os.makedirs(src)
    parts = [pdf.iloc[: len(pdf) // 3], pdf.iloc[len(pdf) // 3: 2 * len(pdf) // 3], pdf.iloc[2 * len(pdf) // 3:], sentinel]
    for n, p in enumerate(parts):
        f = os.path.join(src, f"p{n}.parquet")
        spark.createDataFrame(p, schema=lg.schema).coalesce(1).write.parquet(f)
        for root, _, files in os.walk(f):
            for x in files:
                os.utime(os.path.join(root, x), (1_600_000_000 + n, 1_600_000_000 + n))
    stream = (spark.readStream.schema(lg.schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(src))
    got = _run(login_fail_warnings_stream(stream, within="6 hours"), scratch, "t_lg_ev")
    exp = login_fail_episodes(lg, within="6 hours")
    cols = ["user_id", "first_fail_time", "last_fail_time", "first_seq", "fail_count", "msg"]
    assert exp.count() > 0
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, exp.select(cols).collect()))


def test_bitmap_shards_update_mode_equal_batch(spark, scratch):
    """W10/A6 on a stream: update-mode bitmap shards, upserted, summed per window = batch bitmap count."""
    from rivulet.streaming.sinks import read_latest_sum

    stream, _ = _behavior_stream(spark, scratch)
    batch = tables.user_behavior(tables.events(spark, SF001))
    path = os.path.join(scratch, "shards")
    q = upsert_latest(jobs.unique_visitors_bitmap_shards(stream), "t_shards", path, ["window_end", "shard"], "uv",
                      checkpoint=os.path.join(scratch, "ckpt", "shards"))
    q.processAllAvailable()
    q.stop()
    exp = jobs.unique_visitors_bitmap(batch)
    cutoff = exp.agg(F.max("window_end")).first()[0]
    got = read_latest_sum(spark, path, "window_end", "shard", "uv").where(F.col("window_end") <= cutoff)
    assert sorted(map(tuple, got.collect())) == sorted((r.window_end, r.uv) for r in exp.collect())


def test_ad_pipeline_runs_the_cap_once(spark, scratch):
    from rivulet.streaming.jobs import start_ad_pipeline

    lines = open(fixture_path("ad_clicks.csv")).read().splitlines()
    raw = _text_stream(spark, scratch, lines, 50, "1,1,zz,zz,1511800000")
    p = start_ad_pipeline(parse_ad_clicks(raw).rows, os.path.join(scratch, "ads"), max_count=100,
                          size="1 minute", slide="5 seconds", checkpoint_root=os.path.join(scratch, "ckpt", "ads"))
    p.cap.processAllAvailable()
    p.by_province.processAllAvailable()
    p.cap.stop()
    p.by_province.stop()
    warn = [tuple(r) for r in p.blacklist(spark).collect()]
    assert warn == [(937166, 1715, 1511661702, "click over 100 times today.")]
    got = spark.read.parquet(p.by_province_path).where("province <> 'zz'")
    batch = jobs.ad_clicks_by_province(parse_ad_clicks(spark.read.text(fixture_path("ad_clicks.csv"))).rows,
                                       max_count=100, size="1 minute", slide="5 seconds")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.by_province.collect()))


def test_wide_windows_stream_delta_equal_batch(spark, scratch):
    """720x windows on a stream by the keyed pane-count processor (streaming form of `delta`)."""
    from rivulet.operators.windows import sliding_count

    lines = open(fixture_path("ad_clicks.csv")).read().splitlines()
    raw = _text_stream(spark, scratch, lines, 50, "1,1,zz,zz,1511800000")
    rows = parse_ad_clicks(raw).rows.withWatermark("event_time", "0 seconds")
    got = _run(sliding_count(rows, "province", "event_time", "1 hour", "5 seconds"), scratch, "t_wide").where(
        "province <> 'zz'")
    batch = parse_ad_clicks(spark.read.text(fixture_path("ad_clicks.csv"))).rows
    exp = sliding_count(batch, "province", "event_time", "1 hour", "5 seconds")
    assert got.count() == exp.count() == 5991
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))


def test_ad_pipeline_wide_windows_golden(spark, scratch):
    """The full ads job on a stream at the reference's 1 h / 5 s: the fixture's 5,988 province windows."""
    from rivulet.streaming.jobs import start_ad_pipeline

    lines = open(fixture_path("ad_clicks.csv")).read().splitlines()
    raw = _text_stream(spark, scratch, lines, 50, "1,1,zz,zz,1511800000")
    p = start_ad_pipeline(parse_ad_clicks(raw).rows, os.path.join(scratch, "ads"), max_count=100,
                          checkpoint_root=os.path.join(scratch, "ckpt", "ads"))
    p.cap.processAllAvailable()
    p.by_province.processAllAvailable()
    p.cap.stop()
    p.by_province.stop()
    got = spark.read.parquet(p.by_province_path).where("province <> 'zz'")
    stats = {r.province: (r.n, r.mx) for r in got.groupBy("province").agg(
        F.count("*").alias("n"), F.max("count").alias("mx")).collect()}
    assert stats == {"beijing": (1460, 102), "guangdong": (828, 5), "hebei": (720, 1), "henan": (735, 3),
                     "jiangsu": (730, 4), "shanghai": (780, 2), "zhejiang": (735, 5)}


def test_marketing_total_stream_auto_equal_batch(spark, scratch):
    """A global (keyless) 360x window on a stream through the pane-count processor."""
    import pandas as pd

    m = tables.marketing(tables.events(spark, SF001)).toPandas().sort_values("event_time")
    src = os.path.join(scratch, "mt")
    os.makedirs(src)
    sentinel = m.iloc[:1].copy()
    # one global key: the sentinel must lie beyond every window of the data (last row + size)
    sentinel["event_time"] = m["event_time"].max() + pd.Timedelta(days=2)
    sentinel["behavior"] = "CLICK"
    for n, p in enumerate([m.iloc[: len(m) // 2], m.iloc[len(m) // 2:], sentinel]):
        f = os.path.join(src, f"p{n}.parquet")
        spark.createDataFrame(p).coalesce(1).write.parquet(f)
        for root, _, files in os.walk(f):
            for x in files:
                os.utime(os.path.join(root, x), (1_600_000_000 + n, 1_600_000_000 + n))
    schema = spark.read.parquet(os.path.join(src, "p0.parquet")).schema
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(src))
    batch = jobs.marketing_total(tables.marketing(tables.events(spark, SF001)))
    cutoff = batch.agg(F.max("window_end")).first()[0]
    got = _run(jobs.marketing_total(stream), scratch, "t_mt").where(F.col("window_end") <= cutoff)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))
