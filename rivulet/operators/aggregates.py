"""Windowed aggregates: counts, sums, integer average, distinct visitors.

Distinct counting never buffers a window's rows in one place:

* exact distinct (A5) is ``count_distinct``, which Catalyst plans as a
  two-level aggregate - (window, user) first, hashed over all tasks, then a
  partial count per task - so a global window (``timeWindowAll``) is not a
  single task. Streams use the same two-level shape explicitly, since
  streaming refuses ``count_distinct``.
* bitmap distinct (A6) counts distinct hash offsets, the exact value a bitmap
  of 2^29 bits would hold (collisions included).
* sketch distinct uses mergeable HLL sketches (kilobytes per window), which
  also roll up (hours -> days) without re-reading rows.
* running distinct (A7) is a prefix sum over parts of equal row counts; see ``running_distinct``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.hashing import poly_hash
from rivulet.functions.timefmt import duration_ms
from rivulet.operators.prefix import running_sum
from rivulet.operators.windows import _col, _key_cols, slot_index, slot_to_ts, tumbling_aggregate


def integer_average(col_name: str) -> Column:
    """sum / count with integral division, then as DOUBLE (the reference's AverageAgg)."""
    # DECIMAL(38) sums do not overflow, however many rows a group has
    return F.expr(f"CAST(sum(CAST({col_name} AS DECIMAL(20, 0))) div count({col_name}) AS DOUBLE)")


def bitmap_offset(value_col, seed: int = 61, bits: int = 29) -> Column:
    """Bit position of a visitor in the 2^bits bitmap: polynomial hash of its string form."""
    return poly_hash(_col(value_col).cast("string"), seed, bits)


def distinct_count(df: DataFrame, keys, time_col: str, size, value_col, name: str = "uv") -> DataFrame:
    """Exact distinct ``value_col`` per key and tumbling window: keys, window_start, window_end, name."""
    keys = _key_cols(keys)
    value = _col(value_col)
    if not df.isStreaming:
        return tumbling_aggregate(df, keys, time_col, size, F.count_distinct(value).alias(name), count_name=None)
    size_str = f"{duration_ms(size)} milliseconds"
    # nulls are not values (as in count_distinct)
    per_value = df.where(value.isNotNull()).groupBy(
        F.window(_col(time_col), size_str).alias("window"), *keys, value.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    # re-window on the first window's event time: the same window, now without the value
    return (per_value.groupBy(F.window(F.window_time("window"), size_str).alias("window"), *keys)
            .agg(F.count(F.lit(1)).alias(name))
            .select(*keys, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), name))


def bitmap_distinct_count(df: DataFrame, keys, time_col: str, size, value_col, name: str = "uv",
                          seed: int = 61, bits: int = 29) -> DataFrame:
    """Distinct bitmap offsets per window: the reference's bitmap count, collisions included."""
    with_offset = df.withColumn("_offset", bitmap_offset(value_col, seed, bits))
    return distinct_count(with_offset, keys, time_col, size, "_offset", name)


def sketch_distinct_count(df: DataFrame, keys, time_col: str, size, value_col, name: str = "uv",
                          lg_config_k: int = 12, keep_sketch: bool = False) -> DataFrame:
    """HLL estimate per window; with ``keep_sketch`` also the sketch bytes for later roll-ups."""
    keys = _key_cols(keys)
    res = tumbling_aggregate(df, keys, time_col, size, F.hll_sketch_agg(_col(value_col), lg_config_k).alias("sketch"),
                             count_name=None)
    res = res.withColumn(name, F.hll_sketch_estimate("sketch"))
    return res if keep_sketch else res.drop("sketch")


def sketch_rollup(sketches: DataFrame, keys, time_col: str, size, name: str = "uv") -> DataFrame:
    """Merge per-window sketches into coarser windows (e.g. hourly -> daily) without the rows."""
    keys = _key_cols(keys)
    res = tumbling_aggregate(sketches, keys, time_col, size, F.hll_union_agg("sketch").alias("sketch"),
                             count_name=None)
    return res.withColumn(name, F.hll_sketch_estimate("sketch")).drop("sketch")


def running_distinct(df: DataFrame, keys, time_col: str, seq_col: str, size, value_col, name: str = "uv") -> DataFrame:
    """For every row, the distinct values seen so far in its tumbling window.

    Order inside a window is (time, seq). Plan, all distributed:
      1. first sighting of each value per window = ``min(struct(t, seq))``
         (partial aggregate: a hot visitor collapses map-side);
      2. union rows (weight 0) with first sightings (weight 1, sorting just
         before their own row);
      3. running sum of the weights over parts of equal row counts
         (``running_sum``): a minute that holds a third of all rows is spread
         like any other rows.
    Output: keys, seq, window_start, window_end, name.
    """
    keys = _key_cols(keys)
    size_ms = duration_ms(size)
    t = _col(time_col)
    base = df.select(*keys, slot_index(t, size_ms).alias("_win"), F.unix_micros(t).alias("_us"),
                     F.col(seq_col).alias("_seq"), _col(value_col).alias("_v"))
    firsts = (base.where(F.col("_v").isNotNull())  # nulls are not values (as in count_distinct)
              .groupBy(*keys, "_win", "_v").agg(F.min(F.struct("_us", "_seq")).alias("_f"))
              .select(*keys, "_win", F.col("_f._us").alias("_us"), F.col("_f._seq").alias("_seq"), F.lit(1).alias("_w"), F.lit(0).alias("_kind")))
    rows = base.select(*keys, "_win", "_us", "_seq", F.lit(0).alias("_w"), F.lit(1).alias("_kind"))
    running = running_sum(firsts.unionByName(rows), [*keys, "_win"], ["_us", "_seq", "_kind"], "_w", "_run")
    return running.where(F.col("_kind") == 1).select(
        *keys, F.col("_seq").alias(seq_col),
        slot_to_ts(F.col("_win"), size_ms).alias("window_start"),
        slot_to_ts(F.col("_win") + 1, size_ms).alias("window_end"),
        F.col("_run").alias(name),
    )


def bitmap_shard_counts(df: DataFrame, keys, time_col: str, size, offset_col, name: str = "uv") -> DataFrame:
    """Distinct bitmap offsets per window, per 32768-bit shard of the bitmap: keys, window_start, window_end, shard, name.

    The reference's per-window bitmap, sharded with Spark's bitmap
    aggregates (``bitmap_bucket_number`` / ``bitmap_bit_position`` /
    ``bitmap_construct_agg``): state is at most 4 KB per (window, shard), a
    hot window spreads over up to 2^29 / 32768 shards, and the sum over shards
    is the exact count. One aggregation, so on a stream it runs in update
    mode (the reference fires on every element; this fires per micro-batch).
    """
    keys = _key_cols(keys)
    off = _col(offset_col)
    res = df.groupBy(F.window(_col(time_col), f"{duration_ms(size)} milliseconds").alias("window"), *keys,
                     F.bitmap_bucket_number(off).alias("shard")).agg(
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(off))).alias(name))
    return res.select(*keys, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                      "shard", name)
