"""DataFrame -> DataFrame operators: windows, aggregates, top-N, keyed patterns."""

from rivulet.operators.aggregates import (
    bitmap_distinct_count,
    bitmap_offset,
    distinct_count,
    integer_average,
    running_distinct,
    sketch_distinct_count,
    sketch_rollup,
)
from rivulet.operators.patterns import CapResult, click_cap, login_fail_bursts, login_fail_episodes
from rivulet.operators.topn import top_n, top_n_stream
from rivulet.operators.windows import sliding_count, slot_index, tumbling_aggregate

__all__ = [
    "CapResult", "bitmap_distinct_count", "bitmap_offset", "click_cap", "distinct_count", "integer_average",
    "login_fail_bursts", "login_fail_episodes", "running_distinct", "sketch_distinct_count", "sketch_rollup",
    "sliding_count", "slot_index", "top_n", "top_n_stream", "tumbling_aggregate",
]
