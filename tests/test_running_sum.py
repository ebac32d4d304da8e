"""Running sums over parts of equal row counts, and the login entries found by doubling."""

import random
from collections import Counter

from pyspark.sql import functions as F

from rivulet.operators.aggregates import running_distinct
from rivulet.operators.patterns import login_fail_episodes
from rivulet.operators.prefix import running_sum


def test_running_sum_equals_plain_python(spark):
    r = random.Random(1)
    data = [(r.choice(["a", "b", None]), r.randint(0, 50), i, r.randint(-3, 3)) for i in range(500)]
    df = spark.createDataFrame(data, "k string, t long, seq long, v long")
    got = {(x.k, x.seq): x.run for x in running_sum(df, ["k"], ["t", "seq"], "v", "run").collect()}
    want, totals = {}, Counter()
    for k, t, seq, v in sorted(data, key=lambda x: (str(x[0]), x[1], x[2])):
        totals[k] += v
        want[k, seq] = totals[k]
    assert got == want
    assert running_sum(df.where("t < 0"), ["k"], ["t", "seq"], "v", "run").collect() == []


def test_a_busy_minute_is_spread(spark):
    """A third of all rows in one minute: no part holds more than about its share."""
    n = 30_000
    t = F.when(F.col("id") % 3 == 0, F.lit(1800)).otherwise(F.col("id") % 3600)
    df = spark.range(n).select(F.timestamp_seconds(t).alias("t"), F.col("id").alias("seq"), (F.col("id") % 997).alias("v"))
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        out = running_distinct(df, [], "t", "seq", "1 hour", "v")
        got = out.agg(F.max("uv"), F.count("*")).first()
        assert got[0] == 997 and got[1] == n
        base = df.select(F.lit(0).alias("k"), "t", "seq", F.lit(1).alias("w"))
        from rivulet.operators import prefix

        held = []
        real = prefix.materialize
        prefix.materialize = lambda d, name: held.append(real(d, name)) or held[-1]
        try:
            running_sum(base, ["k"], ["t", "seq"], "w", "run")
        finally:
            prefix.materialize = real
        sizes = [r["count"] for r in held[0].groupBy("_part").count().collect()]
        assert len(sizes) == 16 and max(sizes) < 2 * n / 16
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def fold(times, w, least):
    """Greedy episodes of one user's fails."""
    out, t0, n, last = [], None, 0, None
    for t in times:
        if t0 is None or t > t0 + w:
            if t0 is not None and n >= least:
                out.append((t0, last, n))
            t0, n = t, 0
        n, last = n + 1, t
    if t0 is not None and n >= least:
        out.append((t0, last, n))
    return out


def test_entries_by_doubling_on_a_run_of_many_blocks(spark):
    r = random.Random(4)
    t, times = 0, []
    while t < 40_000:  # one run over 40 blocks of 1000 s
        times.append(t)
        t += r.choice([1, 7, 60, 99, 100])
    logins = spark.createDataFrame([(1, "fail", t, i) for i, t in enumerate(times)] + [(2, "fail", 5, 9), (2, "fail", 6, 10)],
                                   "user_id long, event_type string, t long, seq long").withColumn("event_time", F.timestamp_seconds("t"))
    got = login_fail_episodes(logins, within="100 seconds", run_block="1000 seconds")
    assert sorted((x.user_id, x.first_fail_time, x.last_fail_time, x.fail_count) for x in got.collect()) == sorted(
        [(1, *e) for e in fold(times, 100, 2)] + [(2, 5, 6, 2)])
