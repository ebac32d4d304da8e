"""Property test: the three sliding-window plans agree on random inputs.

Covers null keys (null-safe joins in the delta plan), pre-epoch times (floor,
not truncation), rows exactly on slot boundaries, and tiny blocks (many block
boundaries in the two-level running sum)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rivulet.operators import windows

EPOCH = dt.datetime(1970, 1, 1)


def _rows(df):
    return sorted((r.k if r.k is not None else "<null>", r.window_start, r.window_end, r["count"])
                  for r in df.select("k", "window_start", "window_end", "count").collect())


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    events=st.lists(st.tuples(st.sampled_from(["a", "b", None]),
                              st.integers(min_value=-3_000, max_value=3_000),  # seconds around the epoch
                              st.sampled_from([0, 0, 500_000, 999_999])),       # microseconds (0: on a boundary)
                    min_size=1, max_size=60),
    slide_s=st.sampled_from([1, 5, 10]),
    ratio=st.sampled_from([1, 3, 12, 40]),
    block=st.sampled_from([2, 7, 4096]),
)
def test_sliding_plans_agree(spark, events, slide_s, ratio, block):
    rows = [(k, EPOCH + dt.timedelta(seconds=s, microseconds=us)) for k, s, us in events]
    df = spark.createDataFrame(rows, "k string, t timestamp")
    size_ms, slide_ms = slide_s * ratio * 1000, slide_s * 1000
    direct = _rows(windows._direct(df, ["k"], "t", size_ms, slide_ms, "count"))
    pane = _rows(windows._pane_batch(df, ["k"], "t", size_ms, slide_ms, "count"))
    delta = _rows(windows._delta(df, ["k"], "t", size_ms, slide_ms, "count", block_slots=block))
    assert direct == pane == delta
    assert sum(r[3] for r in direct) == ratio * len(rows)
