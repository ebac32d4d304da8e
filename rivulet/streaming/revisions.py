"""What late rows do. Rankings that are revised as a signed changelog, and rows beyond lateness as a table.

``start_ranking_changelog`` ranks a windowed count in update mode. A micro-batch carries the windows' changed counts only.
Counts of a window only grow, so its new top N come from its old top N and the changed keys: nothing else is read. What
changed in the ranking leaves as rows with sign -1 (taken back) and +1 (now valid); the sum of the signs of all batches
is the ranking (``fold_changelog``). The rankings of windows that can still change are kept next to it.
``start_sliding_changelog`` does the same for sliding windows from a state of pane counts.

``start_lateness_split`` tags every row of a stream as on time or late, before any watermark could drop it: late is
what lies further than ``delay`` behind the newest time of the batches before. One pass; both parts are tables.

Folders of a batch carry its id and are overwritten by a replay.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rivulet.functions.timefmt import duration_ms
from rivulet.operators.topn import top_n
from rivulet.operators.windows import block_counts, sliding_blocks
from rivulet.session import stream_checkpoint
from rivulet.streaming.sinks import batch_folders

HOT_KEYS = 100_000  # changed keys of a block in a batch above which they are dealt into SHARDS
SHARDS = 64


def _folder(path: str, kind: str, batch_id: int) -> str:
    return os.path.join(path, kind, f"batch_id={batch_id}")


def _last(spark: SparkSession, path: str, kind: str, batch_id: int, schema) -> DataFrame:
    """The table ``kind`` as the newest batch before ``batch_id`` left it."""
    earlier = [b for b in batch_folders(spark, os.path.join(path, kind)) if b < batch_id]
    return spark.read.schema(schema).parquet(_folder(path, kind, earlier[-1])) if earlier else spark.createDataFrame([], schema)


def _start(df: DataFrame, write, mode: str, name: str, checkpoint: str | None, available_now: bool) -> StreamingQuery:
    w = (df.writeStream.queryName(name).outputMode(mode).foreachBatch(write)
         .option("checkpointLocation", checkpoint or stream_checkpoint(df.sparkSession, name)))
    return (w.trigger(availableNow=True) if available_now else w).start()


def _rank_batch(spark: SparkSession, path: str, batch_id: int, changed: DataFrame, key: str, top: int, closed) -> None:
    """Writes a batch's changes and the ranking after it. ``changed``: window_end, ``key``, count of a batch, all of a window's
    changed keys or its ``top`` best of them. ``closed``: of the newest window end ranked, the end (ms, or None) up to which
    no window changes any more."""
    kind = changed.schema[key].dataType.simpleString()
    names = ["window_end", "rank", key, "count"]
    before = _last(spark, path, "ranking", batch_id, f"window_end timestamp, rank int, `{key}` {kind}, count long")
    both = changed.select("window_end", key, "count", F.lit(None).cast("int").alias("rank"), F.lit(None).cast("long").alias("had")).unionByName(
        before.withColumn("had", F.col("count")))
    # a changed key's count replaces the one it was ranked with; the exchange by window serves the ranking too
    keyed = both.repartition("window_end").groupBy("window_end", key).agg(
        F.max("count").alias("count"), F.max("rank").alias("old_rank"), F.max("had").alias("had"))
    ranked = keyed.withColumn("rank", F.row_number().over(Window.partitionBy("window_end").orderBy(F.col("count").desc(), F.col(key).asc())))
    ranked.where((F.col("rank") <= top) | F.col("old_rank").isNotNull()).write.mode("overwrite").parquet(_folder(path, "steps", batch_id))
    steps = spark.read.schema(f"window_end timestamp, `{key}` {kind}, count long, old_rank int, had long, rank int").parquet(
        _folder(path, "steps", batch_id))
    moved = ~(F.col("rank").eqNullSafe(F.col("old_rank")) & F.col("count").eqNullSafe(F.col("had")))
    back = steps.where(moved & F.col("old_rank").isNotNull()).select("window_end", F.col("old_rank").alias("rank"), key, F.col("had").alias("count"),
                                                                    F.lit(-1).alias("sign"))
    valid = steps.where(moved & (F.col("rank") <= top)).select(*names, F.lit(1).alias("sign"))
    back.unionByName(valid).write.mode("overwrite").parquet(_folder(path, "changes", batch_id))
    whole = steps.where(F.col("rank") <= top).select(*names)
    end = closed(whole)
    if end is not None:
        whole = whole.where(F.unix_millis("window_end") > F.lit(end))
    whole.write.mode("overwrite").parquet(_folder(path, "ranking", batch_id))


def start_ranking_changelog(counts: DataFrame, name: str, path: str, key: str, top: int, size, delay, checkpoint: str | None = None,
                            available_now: bool = False) -> StreamingQuery:
    """Changelog of the top ``top`` keys of every window under ``path``/changes.

    ``counts``: a streaming windowed count (``window_end``, ``key``, ``count``), taken in update mode. ``size`` and ``delay``
    are its window size and watermark delay: they say how long a window can change.
    """
    kept_ms = duration_ms(size) + duration_ms(delay)
    kind = counts.schema[key].dataType

    def closed(whole: DataFrame) -> int | None:  # the newest row is at most ``size`` before that end, so older ends are behind every later watermark
        newest = whole.agg(F.unix_millis(F.max("window_end"))).first()[0]
        return None if newest is None else newest - kept_ms

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.select("window_end", key, "count").write.mode("overwrite").parquet(_folder(path, "counts", batch_id))  # the stateful plan runs once
        changed = spark.read.schema(f"window_end timestamp, `{key}` {kind.simpleString()}, count long").parquet(_folder(path, "counts", batch_id))
        if not changed.isEmpty():  # nothing moved: the ranking of the batch before stands
            _rank_batch(spark, path, batch_id, changed, key, top, closed)

    return _start(counts, write, "update", name, checkpoint, available_now)


def start_sliding_changelog(rows: DataFrame, name: str, path: str, key: str, top: int, size, slide, delay, time_col: str = "event_time",
                            checkpoint: str | None = None, available_now: bool = False) -> StreamingQuery:
    """The same changelog for the counts of ``rows`` per ``key`` in sliding windows; rows may trail by ``delay``.

    The state is ``sliding_blocks``: a row per key and block of ``size``, not per window. A changed block's windows are
    counted and ranked by one task, those of a hot block by shards of its keys, so only the best go on. Windows that the
    watermark closed keep their ranking: a late row still counts in the later windows of its block. ``path``/mark holds the
    newest time of each batch; like Spark's filter of late rows, a batch takes the watermark that the batch before it had.
    """
    delay_ms = duration_ms(delay)
    blocks = sliding_blocks(rows.withWatermark(time_col, f"{delay_ms} milliseconds"), key, time_col, size, slide)

    def watermark(spark: SparkSession, batch_id: int) -> int:
        """That of a batch, in ms: it trails the newest row of the batches before."""
        newest = _last(spark, path, "mark", batch_id, "ms long").first()
        return max(0, newest.ms - delay_ms) if newest else 0

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(_folder(path, "blocks", batch_id))  # the stateful plan runs once
        held = spark.read.schema(batch.schema).parquet(_folder(path, "blocks", batch_id))
        newest = held.agg(F.unix_millis(F.max("_newest"))).first()[0]
        if newest is None:  # nothing moved: the ranking of the batch before stands
            return
        before = _last(spark, path, "mark", batch_id, "ms long").first()
        late = watermark(spark, batch_id - 1)
        hot = held.groupBy("block_start").count().where(F.col("count") > HOT_KEYS).select("block_start", F.lit(True).alias("_hot"))
        sharded = held.join(F.broadcast(hot), "block_start", "left").withColumn(
            "_shard", F.when(F.col("_hot"), F.pmod(F.hash(key), F.lit(SHARDS))).otherwise(0))
        # a block (a shard of a hot one) lies in one task: its windows are counted and ranked there without another exchange
        counts = block_counts(sharded.repartition("block_start", "_shard"), [key, "_shard"], size, slide)
        best = top_n(counts.where(F.unix_millis("window_end") > F.lit(late)), ["window_end", "block_start", "_shard"], key, "count", top)
        _rank_batch(spark, path, batch_id, best, key, top, lambda _: watermark(spark, batch_id))
        spark.createDataFrame([(max(newest, before.ms if before else newest),)], "ms long").coalesce(1).write.mode("overwrite").parquet(
            _folder(path, "mark", batch_id))

    return _start(blocks, write, "update", name, checkpoint, available_now)


def read_changelog(spark: SparkSession, path: str, key: str, key_type: str = "string") -> DataFrame:
    """batch_id, window_end, rank, key, count, sign of all complete batches."""
    done = batch_folders(spark, os.path.join(path, "changes"))
    schema = f"window_end timestamp, rank int, `{key}` {key_type}, count long, sign int, batch_id long"
    if not done:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", os.path.join(path, "changes")).parquet(*[_folder(path, "changes", b) for b in done])


def fold_changelog(changes: DataFrame, key: str) -> DataFrame:
    """The ranking that a changelog leaves: window_end, rank, key, count."""
    names = ["window_end", "rank", key, "count"]
    return changes.groupBy(*names).agg(F.sum("sign").alias("_n")).where("_n > 0").select(*names)


def start_lateness_split(rows: DataFrame, name: str, path: str, delay, time_col: str = "event_time", checkpoint: str | None = None,
                         available_now: bool = False) -> StreamingQuery:
    """Every row of a stream under ``path``/rows, tagged ``late``; rows without a time are on time.

    ``rows`` must carry no watermark yet: one set further down (on the rows that are on time) cannot drop any of them,
    as long as it reads them in batches that are not finer than these and trails by at least ``delay``.
    """
    delay_us = duration_ms(delay) * 1000

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mark = _last(spark, path, "mark", batch_id, "us long").first()
        newest = mark.us if mark and mark.us is not None else None
        us = F.unix_micros(F.col(time_col).cast("timestamp"))
        late = F.lit(False) if newest is None else F.coalesce(us < F.lit(newest - delay_us), F.lit(False))
        here = _folder(path, "rows", batch_id)
        batch.withColumn("late", late).write.mode("overwrite").partitionBy("late").parquet(here)
        seen = spark.read.schema(batch.schema).parquet(here).agg(F.max(us)).first()[0]
        now = max((x for x in (newest, seen) if x is not None), default=None)
        spark.createDataFrame([(now,)], "us long").coalesce(1).write.mode("overwrite").parquet(_folder(path, "mark", batch_id))

    return _start(rows, write, "append", name, checkpoint, available_now)


def read_split(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of all complete batches with ``late`` and ``batch_id``."""
    from pyspark.sql.types import BooleanType, LongType, StructType

    done = batch_folders(spark, os.path.join(path, "rows"))
    full = StructType([*schema.fields]).add("batch_id", LongType()).add("late", BooleanType())
    if not done:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", os.path.join(path, "rows")).parquet(*[_folder(path, "rows", b) for b in done])
