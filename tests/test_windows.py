import pytest
from conftest import SF001, SF01

from rivulet.operators.windows import sliding_count
from rivulet.sources import tables


def _rows(df):
    return sorted(tuple(r) for r in df.select("item_id", "window_start", "window_end", "count").collect())


@pytest.mark.parametrize("size,slide", [("1 hour", "5 minutes"), ("1 hour", "10 minutes"), ("30 minutes", "30 minutes")])
def test_direct_pane_delta_agree(spark, size, slide):
    b = tables.user_behavior(tables.events(spark, SF001))
    results = [_rows(sliding_count(b, "item_id", "event_time", size, slide, method=m)) for m in ("direct", "pane", "delta")]
    assert results[0] == results[1] == results[2]
    assert len(results[0]) > 0


def test_delta_small_blocks_cross_block_boundaries(spark):
    """Tiny blocks force many block boundaries inside the two-level running sum."""
    from rivulet.operators import windows

    b = tables.user_behavior(tables.events(spark, SF001))
    direct = _rows(sliding_count(b, "item_id", "event_time", "1 hour", "1 minute", method="direct"))
    tiny = sorted(tuple(r) for r in windows._delta(b, ["item_id"], "event_time", 3_600_000, 60_000, "count", block_slots=7)
                  .select("item_id", "window_start", "window_end", "count").collect())
    assert direct == tiny


def test_global_360x_windows_total(spark):
    """Sum over windows of a 1h/10s count = 360 x rows (every row is in 360 windows)."""
    m = tables.marketing(tables.events(spark, SF01))
    res = sliding_count(m, [], "event_time", "1 hour", "10 seconds")
    total = res.agg({"count": "sum"}).first()[0]
    assert total == 360 * m.count()


def test_slide_must_divide_size(spark):
    b = tables.user_behavior(tables.events(spark, SF001))
    with pytest.raises(ValueError):
        sliding_count(b, [], "event_time", "1 hour", "7 minutes")
