"""Sinks (K1, K3) and stream helpers.

Every streaming query gets a checkpoint under the shared checkpoint folder
(``spark.checkpoint.dir``), so a restarted query - or one whose executors
were lost - resumes from its offsets and state.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rivulet.session import stream_checkpoint


def start(df: DataFrame, name: str, fmt: str = "console", output_mode: str = "append", path: str | None = None,
          available_now: bool = False, processing_time: str | None = None, checkpoint: str | None = None,
          prefix: str | None = None, **options) -> StreamingQuery:
    """K1 and friends: console, memory (tests), parquet, ...

    ``prefix`` labels every row (a leading ``sink`` column), like the
    reference's ``print("pv count")``. The checkpoint defaults to
    ``<spark.checkpoint.dir>/streams/<name>``: a query restarted under the
    same name resumes where it stopped.
    """
    if prefix is not None:
        df = df.select(F.lit(prefix).alias("sink"), "*")
    w = (df.writeStream.queryName(name).format(fmt).outputMode(output_mode)
         .option("checkpointLocation", checkpoint or stream_checkpoint(df.sparkSession, name)))
    for k, v in options.items():
        w = w.option(k, v)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start(path) if path else w.start()


COMPACT_EVERY = 64  # micro-batches between snapshots of an upserted table


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FileSystem API, any scheme
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path  # noqa: SLF001


def _bases(spark: SparkSession, path: str) -> list[int]:
    """Snapshot ids of an upserted table whose first batch is complete, oldest first."""
    fs, Path = _fs(spark, path)
    if not fs.exists(Path(path)):
        return []
    ids = [int(s.getPath().getName()[5:]) for s in fs.listStatus(Path(path)) if s.getPath().getName().startswith("base=")]
    return sorted(b for b in ids if fs.exists(Path(f"{path}/base={b}/batch_id={b}/_SUCCESS")))


def batch_folders(spark: SparkSession, path: str) -> list[int]:
    """Ids of the complete ``batch_id=N`` folders under ``path``, in order."""
    fs, Path = _fs(spark, path)
    if not fs.exists(Path(path)):
        return []
    ids = [int(s.getPath().getName()[9:]) for s in fs.listStatus(Path(path)) if s.getPath().getName().startswith("batch_id=")]
    return sorted(b for b in ids if fs.exists(Path(f"{path}/batch_id={b}/_SUCCESS")))


def upsert_latest(df: DataFrame, name: str, path: str, key_cols, order_col: str,
                  output_mode: str = "update", available_now: bool = False,
                  checkpoint: str | None = None, compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """K3: keep the latest value per key (the reference's Redis hash ``count``).

    Each micro-batch keeps its last row per key and writes it under
    ``path/base=B/batch_id=N`` with overwrite: replaying a batch after a
    failure rewrites the same folder, so the table is exactly-once. Every
    ``compact_every`` batches the table so far and the new batch are written
    together as the first folder of a new base; once that is complete, bases
    before the previous one are deleted (a reader may still be on that one).
    ``read_latest`` reads the newest base only.
    """
    keys = [key_cols] if isinstance(key_cols, str) else list(key_cols)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        w = Window.partitionBy(*keys).orderBy(F.col(order_col).desc())
        latest = batch.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
        base = batch_id - batch_id % compact_every
        older = [b for b in _bases(spark, path) if b < batch_id]
        if batch_id == base and older:
            before = read_latest(spark, path, keys, older[-1])
            latest = latest.unionByName(before.join(latest.select(*keys), keys, "left_anti"))
        latest.write.mode("overwrite").parquet(os.path.join(path, f"base={base}", f"batch_id={batch_id}"))
        fs, Path = _fs(spark, path)
        for b in older[:-1] if batch_id == base else []:
            fs.delete(Path(f"{path}/base={b}"), True)

    w = (df.writeStream.queryName(name).outputMode(output_mode).foreachBatch(write)
         .option("checkpointLocation", checkpoint or stream_checkpoint(df.sparkSession, name)))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def read_latest(spark: SparkSession, path: str, key_cols, base: int | None = None) -> DataFrame:
    """The upserted table: newest batch's row per key."""
    keys = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    base = _bases(spark, path)[-1] if base is None else base
    df = spark.read.parquet(os.path.join(path, f"base={base}"))
    w = Window.partitionBy(*keys).orderBy(F.col("batch_id").desc())
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "batch_id")


def read_latest_sum(spark: SparkSession, path: str, group_cols, shard_col: str, value_col: str) -> DataFrame:
    """Upserted per-shard values summed per group (e.g. bitmap shards -> one count per window)."""
    groups = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    latest = read_latest(spark, path, groups + [shard_col])
    return latest.groupBy(*groups).agg(F.sum(value_col).alias(value_col))


def read_bitmap_state(spark: SparkSession, checkpoint: str, name: str = "uv") -> DataFrame:
    """window_start, window_end, ``name``: the counts of a ``bitmap_shard_counts`` query, read from the state of its last
    finished batch with Spark's state reader. The query may be running; nothing is written."""
    state = spark.read.format("statestore").load(checkpoint)
    held = state.schema["value"].dataType[0].name  # the aggregation's one buffer
    return (state.select("key.window", F.bitmap_count(f"value.{held}").alias("_n")).groupBy("window").agg(F.sum("_n").alias(name))
            .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), name))


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", max_files_per_trigger: int = 1) -> DataFrame:
    """A directory as a stream of files (each file a micro-batch with ``max_files_per_trigger=1``)."""
    return (spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", str(max_files_per_trigger))
            .load(path))


def top_n_per_batch(counts: DataFrame, name: str, path: str, key_col: str, n: int, count_col: str = "count",
                    checkpoint: str | None = None, available_now: bool = False) -> StreamingQuery:
    """Streaming top-N without list state.

    ``counts`` is a windowed count in append mode (``window_start``,
    ``window_end``, key, count). The watermark is global, so every key of a
    window is emitted in the same micro-batch; ranking each micro-batch as a
    batch DataFrame (``WindowGroupLimit``) is therefore exact. Each batch is
    written to ``path/batch_id=N`` with overwrite, so replays are idempotent.
    """
    from rivulet.operators.topn import top_n

    def write(batch: DataFrame, batch_id: int) -> None:
        ranked = top_n(batch, "window_end", key_col, count_col, n).select("window_end", "rank", key_col, count_col)
        ranked.write.mode("overwrite").parquet(os.path.join(path, f"batch_id={batch_id}"))

    w = (counts.writeStream.queryName(name).outputMode("append").foreachBatch(write)
         .option("checkpointLocation", checkpoint or stream_checkpoint(counts.sparkSession, name)))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
