from conftest import SF01
from pyspark.sql import functions as F

from rivulet.functions.hashing import poly_hash
from rivulet.plans import jobs
from rivulet.sources import tables


def test_pv_uv_properties(spark):
    b = tables.user_behavior(tables.events(spark, SF01))
    pv = jobs.page_views(b)
    uv = jobs.unique_visitors(b)
    bm = jobs.unique_visitors_bitmap(b)
    sk = jobs.unique_visitors_sketch(b)
    assert pv.agg(F.sum("pv")).first()[0] == b.where("behavior = 'pv'").count()
    j = pv.join(uv, ["window_start", "window_end"]).join(bm.withColumnRenamed("uv", "bm"), ["window_start", "window_end"])
    assert j.where("uv > pv OR bm > uv").count() == 0
    # the sketch is close to exact at these sizes
    e = uv.join(sk.withColumnRenamed("uv", "est"), ["window_start", "window_end"])
    assert e.where(F.abs(F.col("est") - F.col("uv")) > F.greatest(F.lit(1.0), F.col("uv") * 0.05)).count() == 0


def test_running_uv_brute_force(spark):
    b = tables.user_behavior(tables.events(spark, SF01)).where("behavior = 'pv'")
    rows = b.select("seq", "event_time", F.unix_micros("event_time").alias("us"), poly_hash(F.col("user_id")).alias("off")).collect()
    expected = {}
    seen = {}
    for r in sorted(rows, key=lambda r: (r.us, r.seq)):
        w = r.us // 3_600_000_000
        s = seen.setdefault(w, set())
        s.add(r.off)
        expected[r.seq] = len(s)
    got = {r.seq: r.uv for r in jobs.unique_visitors_running(tables.user_behavior(tables.events(spark, SF01))).collect()}
    assert got == expected


def test_running_uv_last_equals_window_total(spark):
    b = tables.user_behavior(tables.events(spark, SF01))
    run = jobs.unique_visitors_running(b).groupBy("window_end").agg(F.max("uv").alias("uv"))
    tot = jobs.unique_visitors_bitmap(b).select("window_end", "uv")
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, tot.collect()))


def test_sketch_rollup_daily(spark):
    from rivulet.operators.aggregates import sketch_rollup

    b = tables.user_behavior(tables.events(spark, SF01)).where("behavior = 'pv'")
    hourly = jobs.unique_visitors_sketch(tables.user_behavior(tables.events(spark, SF01)), keep_sketch=True)
    daily = sketch_rollup(hourly.withColumn("event_time", F.col("window_start")), [], "event_time", "1 day")
    exact = b.groupBy(F.window("event_time", "1 day").alias("w")).agg(F.count_distinct("user_id").alias("uv"))
    j = daily.join(exact, daily.window_start == F.col("w.start"))
    assert j.count() == exact.count()
    assert j.where(F.abs(daily.uv - exact.uv) > 3).count() == 0


def test_bitmap_shards_sum_to_bitmap_count(spark):
    b = tables.user_behavior(tables.events(spark, SF01))
    shards = jobs.unique_visitors_bitmap_shards(b).groupBy("window_end").agg(F.sum("uv").alias("uv"))
    total = jobs.unique_visitors_bitmap(b).select("window_end", "uv")
    assert sorted(map(tuple, shards.collect())) == sorted(map(tuple, total.collect()))


def test_nulls_are_not_distinct_values(spark):
    import datetime as dt

    from rivulet.operators.aggregates import distinct_count, running_distinct

    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    rows = [(t0 + dt.timedelta(minutes=i), i, v) for i, v in enumerate([None, 1, None, 1, 2])]
    df = spark.createDataFrame(rows, "t timestamp, seq long, v long")
    assert [r.uv for r in distinct_count(df, [], "t", "1 hour", "v").collect()] == [2]
    run = sorted((r.seq, r.uv) for r in running_distinct(df, [], "t", "seq", "1 hour", "v").collect())
    assert run == [(0, 0), (1, 1), (2, 1), (3, 1), (4, 2)]
