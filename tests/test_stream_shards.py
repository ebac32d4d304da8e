"""Keyed streams over many keys: the state and the calls are per shard, results those of the batch operators."""

import os
import random

import pytest
from pyspark.sql import functions as F

from rivulet.operators.patterns import click_cap, login_fail_episodes
from rivulet.plans.streams import feed
from rivulet.streaming import running
from rivulet.streaming.jobs import click_cap_stream, login_fail_warnings_stream
from rivulet.streaming.sinks import start

T0 = 1_600_041_600  # a UTC midnight
BIG = 2**60 + 1  # no double holds it
CLICK = "user_id long, ad_id long, province string, city string, ts long, seq long"


def _fed(parts, stream, path):
    """State rows after every slice."""
    queries = []

    def run(s):
        queries.append(start(stream(s), "shards", "parquet", path=path, checkpoint=f"{path}-ck", available_now=True))
        return queries[-1]

    feed(parts, run)
    return [max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress) for q in queries]


def test_the_click_cap_keeps_state_by_shard(spark, scratch):
    r = random.Random(5)
    rows = sorted(((r.randint(1, 1500), r.randint(1, 2), r.randint(0, 3000)) for _ in range(3000)), key=lambda x: x[2])
    rows += [(BIG, 1, 3001)] * 5 + [(None, 1, 3002)] * 5 + [(0, 1, 3003)] * 5 + [(None, None, 3004)] * 5 + [(BIG, None, 3005)] * 2
    rows = [(u, a, "p", "c", T0 + s, BIG + i) for i, (u, a, s) in enumerate(rows)] + [(7, 1, "p", "c", None, BIG + 5000)]
    df = lambda part: spark.createDataFrame(part, CLICK).withColumn("event_time", F.timestamp_seconds("ts"))
    path = os.path.join(scratch, "cap")
    held = _fed([df(rows[:2000]), df(rows[2000:])], lambda s: click_cap_stream(s, 2, "2 hours", shards=8), path)
    assert max(held) < 200  # 2,000 pairs
    got = spark.read.parquet(path)
    whole = click_cap(df(rows), max_count=2)
    columns = ["user_id", "ad_id", "ts", "seq"]
    found = lambda x: sorted((tuple(r) for r in x.select(*columns).collect()), key=str)
    assert found(got.where("kind = 'pass'")) == found(whole.passed)
    warned = [(x.user_id, x.ad_id, x.ts) for x in got.where("kind = 'warn'").collect()]
    assert sorted(warned, key=str) == sorted((tuple(x) for x in whole.warnings.select("user_id", "ad_id", "ts").collect()), key=str)
    assert {BIG, None, 0} <= {x[0] for x in warned}


def test_the_login_rule_keeps_state_by_shard(spark, scratch):
    r = random.Random(6)
    rows = sorted(((r.randint(1, 1500), r.choice(["fail", "fail", "success"]), r.randint(0, 3000)) for _ in range(6000)), key=lambda x: x[2])
    rows += [(BIG, "fail", 3010), (BIG, "fail", 3011), (None, "fail", 3020), (0, "fail", 3020), (None, "fail", 3021)]
    rows = [(*x, BIG + i) for i, x in enumerate(rows)]
    df = lambda part: spark.createDataFrame(part, "user_id long, event_type string, t long, seq long").withColumn("event_time", F.timestamp_seconds("t"))
    path = os.path.join(scratch, "logins")
    held = _fed([df(rows[:3000]), df(rows[3000:]), df([(9, "success", 9000, BIG - 1)])],
                lambda s: login_fail_warnings_stream(s, 2, "100 seconds", "5 minutes", shards=8), path)
    assert max(held) < 200  # 1,500 users
    columns = ["user_id", "first_fail_time", "last_fail_time", "first_seq", "fail_count"]
    found = lambda x: sorted((tuple(r) for r in x.select(*columns).collect()), key=str)
    got = found(spark.read.parquet(path))
    assert got == found(login_fail_episodes(df(rows), within="100 seconds"))
    assert BIG in {x[0] for x in got} and None not in {x[0] for x in got}


@pytest.mark.parametrize("sparse", [3, 8192])
def test_running_visitors_keep_lists_then_pages(spark, scratch, sparse):
    r = random.Random(9)
    rows = sorted((r.randint(0, 2 * 3600 - 1), r.choice([-1, *range(0, 3_000_000, 3_001)])) for _ in range(900))
    rows = [(s, BIG + i, None if o < 0 else o) for i, (s, o) in enumerate(rows)]
    df = lambda part: spark.createDataFrame(part, "s long, seq long, offset long").select(F.timestamp_seconds(F.col("s") + T0).alias("event_time"), "seq", "offset")
    path, queries = os.path.join(scratch, "uv"), []

    def run(s):
        queries.append(running.start_running_visitors(s, "uv", path, watermark="5 seconds", shards=4, sparse=sparse, checkpoint=f"{path}-ck", available_now=True))
        return queries[-1]

    feed([df(rows[i:i + 300]) for i in range(0, 900, 300)] + [df([(90_000, 1, 5)])], run)
    held = [max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress) for q in queries]
    assert sparse == 3 or max(held) < 100  # by shard and window, not by page
    assert queries[-1].lastProgress["stateOperators"][0]["numRowsTotal"] < 10  # the closed windows' lists and pages are gone
    got = {x.seq: x.uv for x in running.read_running_visitors(spark, path).collect()}
    seen, want = {}, {1: 1}
    for s, seq, o in rows:
        w = seen.setdefault(s // 3600, set())
        if o is not None:
            w.add(o)
        want[seq] = len(w)
    assert got == want
