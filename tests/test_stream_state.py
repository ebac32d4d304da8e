"""Streams that go on from a table, processing-time resets, late rows as a table, rankings as a changelog, running counts."""

import os
import random
import time

from pyspark.sql import functions as F

from rivulet.operators.patterns import click_cap, click_cap_state, login_fail_episodes, login_open_episodes
from rivulet.operators.windows import sliding_count
from rivulet.operators.topn import top_n
from rivulet.plans.streams import feed
from rivulet.streaming import revisions, running
from rivulet.streaming.jobs import click_cap_reset_stream, click_cap_stream, login_fail_warnings_stream
from rivulet.streaming.sinks import start

T0 = 1_600_041_600  # a UTC midnight
CLICK = "user_id long, ad_id long, province string, city string, ts long, seq long"
LOGIN = "user_id long, event_type string, t long, seq long"


def clicks(spark, rows):
    return spark.createDataFrame([(u, a, "p", "c", T0 + s, i) for u, a, s, i in rows], CLICK).withColumn("event_time", F.timestamp_seconds("ts"))


def to_parquet(df, scratch, name):
    return start(df, name, "parquet", path=os.path.join(scratch, name), checkpoint=os.path.join(scratch, f"{name}-ck"), available_now=True)


def test_click_cap_goes_on_from_a_table(spark, scratch):
    r = random.Random(1)
    day = sorted((r.randint(1, 4), r.randint(1, 2), r.randint(-3600, 86_000)) for _ in range(200))
    rows = [(u, a, s, i) for i, (u, a, s) in enumerate(sorted(day, key=lambda x: x[2]))]
    noon = 43_200
    before, after = clicks(spark, [x for x in rows if x[2] < noon]), clicks(spark, [x for x in rows if x[2] >= noon])
    whole = click_cap(clicks(spark, rows), max_count=9)
    state = click_cap_state(before, 9)
    feed([after], lambda s: to_parquet(click_cap_stream(s, 9, "1 hour", earlier=state), scratch, "cap"))
    got = spark.read.parquet(os.path.join(scratch, "cap"))
    first = click_cap(before, max_count=9)
    ids = lambda df: {x.seq for x in df.select("seq").collect()}
    assert ids(first.passed) | ids(got.where("kind = 'pass'")) == ids(whole.passed)
    assert first.warnings.count() + got.where("kind = 'warn'").count() == whole.warnings.count() > 0


def test_login_episodes_go_on_from_a_table(spark, scratch):
    r = random.Random(3)
    rows = sorted(((r.randint(1, 3), r.choice(["fail", "fail", "fail", "success"]), t) for t in r.sample(range(2000), 700)), key=lambda x: x[2])
    rows = [(*x, i) for i, x in enumerate(rows)] + [(9, "success", 9000, 5000)]
    logins = lambda part: spark.createDataFrame(part, LOGIN).withColumn("event_time", F.timestamp_seconds("t"))
    cols = ["user_id", "first_fail_time", "last_fail_time", "first_seq", "fail_count"]
    whole = {tuple(x) for x in login_fail_episodes(logins(rows), within="20 seconds").select(*cols).collect()}
    cut = next(x[1] + 1 for x in sorted(whole, key=lambda x: abs(x[1] - 1000)) if x[2] > x[1] + 1)  # inside an episode
    before, after = logins([x for x in rows if x[2] < cut]), logins([x for x in rows if x[2] >= cut])
    state = login_open_episodes(before, F.timestamp_seconds(F.lit(cut)), within="20 seconds")
    feed([after, logins([(9, "success", 20_000, 6000)])], lambda s: to_parquet(
        login_fail_warnings_stream(s, 2, "20 seconds", "5 seconds", earlier=state), scratch, "logins"))
    got = {tuple(x) for x in spark.read.parquet(os.path.join(scratch, "logins")).select(*cols).collect()}
    closed = {x for x in whole if x[1] + 20 < cut}
    assert got | closed == whole and not got & closed
    assert any(x[1] < cut <= x[2] for x in got)  # an episode across the cut


def _until(query, condition, seconds=60):
    """Waits for a running query's rows; processing-time timers keep it from ever being idle."""
    end = time.time() + seconds
    while time.time() < end:
        if query.exception():
            raise query.exception()
        if condition():
            return
        time.sleep(0.3)
    raise AssertionError("no such rows")


def _running_cap(spark, scratch, name, max_count, reset):
    folder = os.path.join(scratch, "in")
    schema = clicks(spark, []).schema
    os.makedirs(folder)
    stream = spark.readStream.schema(schema).parquet(folder)
    query = start(click_cap_reset_stream(stream, max_count, reset), name, "memory", checkpoint=os.path.join(scratch, "ck"), processing_time="300 milliseconds")
    return query, lambda rows: clicks(spark, rows).coalesce(1).write.mode("append").parquet(folder), lambda: spark.table(name).select("kind", "seq").collect()


def test_processing_time_resets_twice(spark, scratch):
    """Bursts of four clicks, each after another multiple of five seconds of the clock: every one has the whole cap."""
    query, deliver, found = _running_cap(spark, scratch, "cap_resets", 1, "5 seconds")
    try:
        for n in range(3):
            deliver([(1, 1, n * 10 + i, n * 10 + i) for i in range(4)])
            _until(query, lambda n=n: sum(x.seq // 10 == n for x in found()) == 3)
            if n < 2:
                time.sleep(5.5)
    finally:
        query.stop()
    assert sorted((x.seq // 10, x.kind) for x in found()) == [(n, k) for n in range(3) for k in ("pass", "pass", "warn")]


def test_within_a_reset_the_count_goes_on(spark, scratch):
    query, deliver, found = _running_cap(spark, scratch, "cap_goes_on", 2, "3650 days")
    try:
        deliver([(1, 1, i, i) for i in range(2)])
        _until(query, lambda: len(found()) == 2)
        deliver([(1, 1, 10 + i, 10 + i) for i in range(3)])
        _until(query, lambda: len(found()) == 4)
    finally:
        query.stop()
    assert sorted((x.kind, x.seq) for x in found()) == [("pass", 0), ("pass", 1), ("pass", 10), ("warn", 11)]


def test_late_rows_are_a_table(spark, scratch):
    r = random.Random(6)
    rows = [(i, T0 + r.randint(0, 5000) if i % 50 else None) for i in range(600)]
    r.shuffle(rows)
    batches = [rows[i:i + 150] for i in range(0, 600, 150)]
    df = lambda part: spark.createDataFrame(part, "id long, s long").select("id", F.timestamp_seconds("s").alias("event_time"))
    path, ck = os.path.join(scratch, "split"), os.path.join(scratch, "ck")
    feed([df(b) for b in batches], lambda s: revisions.start_lateness_split(s, "split", path, "20 minutes", checkpoint=ck, available_now=True))
    got = {x.id: x.late for x in revisions.read_split(spark, path, df(rows[:1]).schema).collect()}
    want, newest = {}, None
    for b in batches:
        for i, s in b:
            want[i] = newest is not None and s is not None and s < newest - 1200
        newest = max(filter(None, [newest, *(s for _, s in b)]))
    assert got == want and any(want.values()) and len(got) == 600


def test_a_late_row_revises_its_windows_only(spark, scratch):
    df = lambda part: spark.createDataFrame(part, "url string, s long").select("url", F.timestamp_seconds(F.col("s") + T0).alias("event_time"))
    first = [("a", 1), ("a", 2), ("b", 3), ("c", 61), ("c", 62), ("a", 63)]
    late = [("b", 4), ("b", 5)]
    path, ck = os.path.join(scratch, "log"), os.path.join(scratch, "ck")

    def run(s):
        counts = sliding_count(s.withWatermark("event_time", "10 minutes"), "url", "event_time", "1 minute", "1 minute", "direct")
        return revisions.start_ranking_changelog(counts.select("window_end", "url", "count"), "log", path, "url", 2, "1 minute", "10 minutes", ck, available_now=True)

    feed([df(first), df(late), df([("z", 100_000)]), df([("b", 7)])], run)
    changes = revisions.read_changelog(spark, path, "url")
    rows = sorted((x.batch_id, int(x.window_end.timestamp()) - T0, x.sign, x["rank"], x.url, x["count"]) for x in changes.collect())
    ids = sorted({x[0] for x in rows})
    second = [x[1:] for x in rows if x[0] == ids[1]]
    assert second == [(60, -1, 1, "a", 2), (60, -1, 2, "b", 1), (60, 1, 1, "b", 3), (60, 1, 2, "a", 2)]
    assert not any(x[4] == "b" and x[5] == 4 for x in rows)  # beyond the lateness: dropped
    folded = {(int(x.window_end.timestamp()) - T0, x["rank"], x.url, x["count"]) for x in revisions.fold_changelog(changes, "url").collect()}
    batch = top_n(sliding_count(df(first + late), "url", "event_time", "1 minute", "1 minute"), "window_end", "url", "count", 2)
    want = {(int(x.window_end.timestamp()) - T0, x["rank"], x.url, x["count"]) for x in batch.collect()}
    assert want < folded and len(folded) == len(want) + 1  # and z's window
    kept = revisions._last(spark, path, "ranking", 10**6, "window_end timestamp")  # noqa: SLF001
    assert kept.distinct().count() == 1  # closed windows are not carried along


def test_running_visitors_over_batches(spark, scratch):
    r = random.Random(8)
    rows = sorted((r.randint(0, 3 * 3600 - 1), r.choice([-1, *range(0, 200_000, 777)])) for _ in range(240))
    rows = [(s, i, None if o < 0 else o) for i, (s, o) in enumerate(rows)]
    df = lambda part: spark.createDataFrame(part, "s long, seq long, offset long").select(F.timestamp_seconds(F.col("s") + T0).alias("event_time"), "seq", "offset")
    path, ck = os.path.join(scratch, "uv"), os.path.join(scratch, "ck")
    feed([df(rows[i:i + 80]) for i in range(0, 240, 80)], lambda s: running.start_running_visitors(s, "uv", path, watermark="5 seconds", shards=4, checkpoint=ck, available_now=True))
    got = {x.seq: (int(x.window_start.timestamp()) - T0, x.uv) for x in running.read_running_visitors(spark, path).collect()}
    seen, want = {}, {}
    for s, seq, o in rows:
        w = seen.setdefault(s // 3600, set())
        if o is not None:
            w.add(o)
        want[seq] = (s // 3600 * 3600, len(w))
    assert got == want
    last = running.batch_folders(spark, os.path.join(path, "totals"))[-1]
    assert spark.read.parquet(os.path.join(path, "totals", f"batch_id={last}")).count() == 2  # the first window is behind every later watermark
