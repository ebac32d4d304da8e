"""Event-time windows: tumbling (W1, W2) and sliding (W3-W6) aggregation.

Windows align to the epoch and are half-open ``[start, end)``, as in the
reference. Results carry ``window_start`` / ``window_end`` TIMESTAMP columns.

Sliding windows have three plans, picked by ``method``:

``direct``  ``F.window(t, size, slide)``. Catalyst expands each row into
            size/slide windows before the partial aggregate. The default of
            streams for small ratios.

``pane``    count per slide-wide pane first (partial + final aggregate, so a
            hot key collapses map-side), partition the panes by key, and only
            behind that exchange spread each pane over the size/slide windows
            that contain it and add. For tables with many rows a pane and key;
            a key's whole history is then one partition. Works on streams (two
            chained windowed aggregations in append mode).

``delta``   A window count is a step function of the window end:
            pane ``p`` adds ``c`` at slot ``p+1`` and removes it at slot
            ``p+1+size/slide``. Aggregate the +/- deltas per (key, slot), take
            a running sum, and expand each constant segment into its slots.
            Work is O(panes + output rows) instead of O(panes * size/slide),
            which is what makes the 360x / 720x windows cheap; the default of
            tables at every ratio. The running sum
            is two-level (per block of slots, then within a block), so a single
            key - the global windows of the marketing job - is still spread
            over many tasks. On streams the same idea runs as a keyed
            processor (``rivulet.streaming.sliding``): pane counts in state,
            windows emitted from prefix sums as the watermark passes them.

All three give identical rows (tested).

Streams in update mode that rank or store revised counts may hold ``sliding_blocks`` in place of the windows: one state
row per key and block of ``size`` with the block's pane counts; ``block_counts`` reads the windows off it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.functions.timefmt import duration_ms

DIRECT_MAX_RATIO = 12  # size/slide up to which `auto` expands rows directly
DELTA_BLOCK_SLOTS = 4096  # slots per block of the two-level running sum


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _key_cols(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys or [])


def slot_index(time_col, slide_ms: int) -> Column:
    """floor(t / slide) as a long, exact for any timestamp (pre-epoch included)."""
    us = F.unix_micros(_col(time_col))
    step = slide_ms * 1000
    return ((us - F.pmod(us, F.lit(step))) / F.lit(step)).cast("long")


def slot_to_ts(slot: Column, slide_ms: int) -> Column:
    return F.timestamp_micros(slot * F.lit(slide_ms * 1000))


def tumbling_aggregate(df: DataFrame, keys, time_col: str, size, *aggs: Column, count_name: str | None = "count") -> DataFrame:
    """Tumbling windows of ``size`` per key: keys, window_start, window_end, aggs."""
    keys = _key_cols(keys)
    all_aggs = ([F.count(F.lit(1)).alias(count_name)] if count_name else []) + list(aggs)
    w = F.window(_col(time_col), f"{duration_ms(size)} milliseconds")
    res = df.groupBy(w.alias("window"), *keys).agg(*all_aggs)
    measures = [c for c in res.columns if c not in keys and c != "window"]
    return res.select(*keys, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                      *measures)


def sliding_count(df: DataFrame, keys, time_col: str, size, slide, method: str = "auto",
                  count_name: str = "count", window_struct: bool = False) -> DataFrame:
    """Count rows per key in sliding windows: keys, window_start, window_end, count.

    Only windows holding at least one row appear (as in any event-driven
    window operator). ``window_struct`` (streams) keeps Spark's ``window``
    column instead, which carries the event time for a chained aggregation.
    """
    keys = _key_cols(keys)
    size_ms, slide_ms = duration_ms(size), duration_ms(slide)
    if size_ms % slide_ms:
        raise ValueError("slide must divide size")
    ratio = size_ms // slide_ms
    if method == "auto":
        if df.isStreaming:
            method = "direct" if ratio <= DIRECT_MAX_RATIO else "delta"
        else:
            method = "delta"
    if window_struct and method not in ("direct", "pane"):
        raise ValueError("window_struct needs the 'direct' or 'pane' method")
    if method == "direct":
        return _direct(df, keys, time_col, size_ms, slide_ms, count_name, window_struct)
    if method == "pane":
        if df.isStreaming:
            return _pane_stream(df, keys, time_col, size_ms, slide_ms, count_name, window_struct)
        return _pane_batch(df, keys, time_col, size_ms, slide_ms, count_name)
    if method == "delta":
        if df.isStreaming:  # keyed processor: pane counts in state, windows emitted as the watermark passes
            from rivulet.streaming.sliding import sliding_count_stream
            return sliding_count_stream(df, keys, time_col, f"{size_ms} milliseconds", f"{slide_ms} milliseconds",
                                        count_name)
        return _delta(df, keys, time_col, size_ms, slide_ms, count_name)
    raise ValueError(f"unknown method {method!r}")


def sliding_blocks(df: DataFrame, keys, time_col: str, size, slide) -> DataFrame:
    """Pane counts per key and block: block_start, keys, _newest, _p0 .. _pN; for update mode.

    The block at ``b`` counts the panes of the windows that end in [b + size, b + 2 * size): 2 * size/slide - 1 of them, so
    a row lies in two blocks at most where it lies in size/slide windows. A block's row is dropped as late only when all its
    windows are. ``_newest`` is the newest ``time_col`` of the block.
    """
    keys, n, size_ms, slide_ms = _key_cols(keys), _ratio(size, slide), duration_ms(size), duration_ms(slide)
    w = F.window(F.col(time_col), f"{(2 * n - 1) * slide_ms} milliseconds", f"{size_ms} milliseconds")
    rows = df.select(*keys, F.col(time_col), w.alias("_block"))
    pane = F.floor((F.unix_micros(time_col) - F.unix_micros("_block.start")) / F.lit(slide_ms * 1000))
    panes = [F.count_if(F.col("_pane") == i).alias(f"_p{i}") for i in range(2 * n - 1)]
    counted = rows.withColumn("_pane", pane).groupBy("_block", *keys).agg(F.max(time_col).alias("_newest"), *panes)
    return counted.select(F.col("_block.start").alias("block_start"), *keys, "_newest", *[f"_p{i}" for i in range(2 * n - 1)])


def block_counts(blocks: DataFrame, keys, size, slide, count_name: str = "count") -> DataFrame:
    """block_start, keys, window_end, count of the windows of ``sliding_blocks`` that hold a row."""
    keys, n, size_ms, slide_ms = _key_cols(keys), _ratio(size, slide), duration_ms(size), duration_ms(slide)
    each = blocks.select("*", F.explode(F.array(*[F.lit(i) for i in range(n)])).alias("_i"))
    held = [F.when((F.col("_i") <= j) & (F.col("_i") > j - n), F.col(f"_p{j}")).otherwise(0) for j in range(2 * n - 1)]
    end = F.timestamp_micros(F.unix_micros("block_start") + F.lit(size_ms * 1000) + F.col("_i").cast("long") * F.lit(slide_ms * 1000))
    counts = each.select("block_start", *keys, end.alias("window_end"), sum(held[1:], held[0]).alias(count_name))
    return counts.where(F.col(count_name) > 0)


def _ratio(size, slide) -> int:
    if duration_ms(size) % duration_ms(slide):
        raise ValueError("slide must divide size")
    return duration_ms(size) // duration_ms(slide)


def _window_out(res, keys, count_name, window_struct):
    if window_struct:
        return res.select("window", *keys, count_name)
    return res.select(*keys, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                      count_name)


def _direct(df, keys, time_col, size_ms, slide_ms, count_name, window_struct=False):
    w = F.window(_col(time_col), f"{size_ms} milliseconds", f"{slide_ms} milliseconds")
    return _window_out(df.groupBy(w.alias("window"), *keys).agg(F.count(F.lit(1)).alias(count_name)),
                       keys, count_name, window_struct)


def _with_slot_bounds(df, keys, slot_col, size_ms, slide_ms, count_name, value_col):
    return df.select(
        *keys,
        slot_to_ts(F.col(slot_col) - F.lit(size_ms // slide_ms), slide_ms).alias("window_start"),
        slot_to_ts(F.col(slot_col), slide_ms).alias("window_end"),
        F.col(value_col).alias(count_name),
    )


def _panes(df, keys, time_col, slide_ms):
    """Rows per (key, pane); the partial aggregate collapses hot keys before the shuffle."""
    return df.groupBy(*keys, slot_index(time_col, slide_ms).alias("_pane")).agg(F.count(F.lit(1)).alias("_c"))


def _pane_batch(df, keys, time_col, size_ms, slide_ms, count_name):
    n = size_ms // slide_ms
    panes = _panes(df, keys, time_col, slide_ms)
    if keys:  # panes move, not their n copies; the sum below then needs no further exchange
        panes = panes.repartition(*keys)
    spread = panes.select(*keys, F.explode(F.sequence(F.col("_pane") + 1, F.col("_pane") + n)).alias("_slot"), "_c")
    summed = spread.groupBy(*keys, "_slot").agg(F.sum("_c").alias("_c"))
    return _with_slot_bounds(summed, keys, "_slot", size_ms, slide_ms, count_name, "_c")


def _pane_stream(df, keys, time_col, size_ms, slide_ms, count_name, window_struct=False):
    """Two chained windowed aggregations; the second re-windows each pane's event time.

    A late row is dropped once its pane closes (not its last window), so use
    a larger watermark delay where lateness matters.
    """
    panes = df.groupBy(F.window(_col(time_col), f"{slide_ms} milliseconds").alias("pane"), *keys).agg(
        F.count(F.lit(1)).alias("_c"))
    w = F.window(F.window_time("pane"), f"{size_ms} milliseconds", f"{slide_ms} milliseconds")
    return _window_out(panes.groupBy(w.alias("window"), *keys).agg(F.sum("_c").alias(count_name)),
                       keys, count_name, window_struct)


def _null_safe_on(left: str, right: str, keys: list[str], extra: list[str]) -> Column:
    """Join condition, null-safe on every column.

    Null-safe equality also keeps Catalyst from inferring ``isnotnull``
    filters on one side only; both sides of the self-joins here then stay the
    same plan, and their shuffle is computed once and reused.
    """
    cond = None
    for k in list(keys) + list(extra):
        c = F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
        cond = c if cond is None else cond & c
    return cond


def _delta(df, keys, time_col, size_ms, slide_ms, count_name, block_slots: int = DELTA_BLOCK_SLOTS):
    n = size_ms // slide_ms
    panes = _panes(df, keys, time_col, slide_ms)
    # slot s = the window ending at s * slide; pane p is inside windows p+1 .. p+n
    pm = F.array(F.struct((F.col("_pane") + 1).alias("s"), F.col("_c").alias("d")),
                 F.struct((F.col("_pane") + 1 + n).alias("s"), (-F.col("_c")).alias("d")))
    deltas = (panes.select(*keys, F.inline(pm)).groupBy(*keys, F.col("s").alias("_slot")).agg(F.sum("d").alias("_d"))
              .withColumn("_blk", F.floor(F.col("_slot") / F.lit(block_slots))))

    # level 1: per (key, block) totals -> offset carried into each block, and the
    # first slot of the next block (where the block's last segment ends)
    blocks = deltas.groupBy(*keys, "_blk").agg(F.sum("_d").alias("_bd"), F.min("_slot").alias("_bmin"))
    wb = Window.partitionBy(*keys).orderBy("_blk")
    blocks = blocks.select(
        *keys, "_blk",
        F.coalesce(F.sum("_bd").over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.lead("_bmin").over(wb).alias("_next_blk_slot"),
    )
    d, b = deltas.alias("d"), blocks.alias("b")
    joined = d.join(b, _null_safe_on("d", "b", keys, ["_blk"])).select(
        *[F.col(f"d.{k}").alias(k) for k in keys], "d._slot", "d._d", "d._blk", "b._off", "b._next_blk_slot")

    # level 2: running sum inside each (key, block)
    wi = Window.partitionBy(*keys, "_blk").orderBy("_slot")
    seg = joined.select(
        *keys, "_slot",
        (F.col("_off") + F.sum("_d").over(wi.rowsBetween(Window.unboundedPreceding, 0))).alias("_cnt"),
        F.coalesce(F.lead("_slot").over(wi), F.col("_next_blk_slot")).alias("_next"),
    )
    # a positive segment always ends at a later delta (every +c has its -c)
    out = seg.where(F.col("_cnt") > 0).select(
        *keys, F.explode(F.sequence(F.col("_slot"), F.col("_next") - 1)).alias("_slot"), "_cnt")
    return _with_slot_bounds(out, keys, "_slot", size_ms, slide_ms, count_name, "_cnt")
