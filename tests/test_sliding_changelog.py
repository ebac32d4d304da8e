"""The changelog of sliding rankings from a state of blocks: the same rankings as from a state of windows, in less state."""

import os
import random

import pytest
from pyspark.sql import functions as F

from rivulet.operators.topn import top_n
from rivulet.operators.windows import sliding_count
from rivulet.plans.streams import STREAM_QUERIES, feed
from rivulet.streaming import revisions

T0 = 1_600_041_600  # a UTC midnight


def _state(queries) -> int:
    return max(op.numRowsTotal for q in queries for p in q.recentProgress for op in p.stateOperators)


def _ranking(df) -> set:
    return {(int(x.window_end.timestamp()) - T0, x["rank"], x.url, x["count"]) for x in df.collect()}


@pytest.mark.parametrize("hot_keys", [100_000, 3])
def test_blocks_rank_as_windows_do(spark, scratch, monkeypatch, hot_keys):
    monkeypatch.setattr(revisions, "HOT_KEYS", hot_keys)
    r = random.Random(5)
    urls = [*(f"/{i}" for i in range(7)), None]
    # every batch reaches back over windows that are closed, windows that are half open and new ones
    rows = [[(r.choice(urls), 100 * b + r.randint(-90, 100)) for _ in range(70)] + [(None, None)] for b in range(3)]
    df = lambda part: spark.createDataFrame(part, "url string, s long").select("url", F.timestamp_seconds(F.col("s") + T0).alias("event_time"))
    queries = {"direct": [], "blocks": []}

    def place(kind):
        return os.path.join(scratch, kind), os.path.join(scratch, f"{kind}-ck")

    def direct(s):
        path, ck = place("direct")
        counts = sliding_count(s.withWatermark("event_time", "30 seconds"), "url", "event_time", "1 minute", "5 seconds", "direct")
        queries["direct"].append(revisions.start_ranking_changelog(
            counts.select("window_end", "url", "count"), "direct", path, "url", 3, "1 minute", "30 seconds", ck, available_now=True))
        return queries["direct"][-1]

    def blocks(s):
        path, ck = place("blocks")
        queries["blocks"].append(revisions.start_sliding_changelog(
            s, "blocks", path, "url", 3, "1 minute", "5 seconds", "30 seconds", checkpoint=ck, available_now=True))
        return queries["blocks"][-1]

    found = {}
    for kind, start in (("direct", direct), ("blocks", blocks)):
        feed([df(b) for b in rows], start)
        changes = revisions.read_changelog(spark, place(kind)[0], "url").cache()
        assert {x["sign"] for x in changes.collect()} == {1, -1}
        found[kind] = _ranking(revisions.fold_changelog(changes, "url"))
    assert found["blocks"] == found["direct"]
    whole = top_n(sliding_count(df(sum(rows, [])), "url", "event_time", "1 minute", "5 seconds"), "window_end", "url", "count", 3)
    assert found["blocks"] != _ranking(whole)  # some rows were late for some windows
    assert _state(queries["blocks"]) * 4 < _state(queries["direct"])


def test_registered_changelog_holds_two_state_rows_an_event_at_most(spark, scratch, monkeypatch):
    queries, start = [], revisions._start  # noqa: SLF001
    monkeypatch.setattr(revisions, "_start", lambda *a: queries.append(start(*a)) or queries[-1])
    kinds = ["click", "view", "error"]
    rows = [(i, T0 + 37 * i, i % 5, kinds[i % 3], 1.0, f'{{"k": {i % 4}}}') for i in range(40)]
    events = spark.createDataFrame(rows, "event_id long, s long, user_id long, event_type string, value double, props string")
    events = events.select("event_id", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value", "props")
    events.write.parquet(os.path.join(scratch, "events.parquet"))
    got = {(x.window_end, x["rank"], x.url, x["count"]) for x in STREAM_QUERIES["stream_url_changelog"](spark, scratch).collect()}
    counts = {}
    for _, s, _, kind, _, props in rows:
        for end in range(s // 5 * 5 + 5, s // 5 * 5 + 65, 5):
            url = f"/{kind}/{props[6:-1]}"
            counts.setdefault(end, {})[url] = counts.get(end, {}).get(url, 0) + 1
    want = {(end * 1000, i, u, c) for end, n in counts.items() for i, (u, c) in enumerate(sorted(n.items(), key=lambda e: (-e[1], e[0]))[:5], 1)}
    assert got == want
    assert _state(queries) <= 2 * len(rows)
