"""Shared helpers of the corpus operators: intermediate tables, table reading, column checks."""

from __future__ import annotations

import os
import sys
import types
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.session import checkpoint_dir

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BATCH_ROWS = 512  # rows of one Arrow batch: bounds a task's memory when texts are long


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), "tables", f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Smaller Arrow batches, so that a batch of very long texts fits a worker."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def worker_cache() -> dict:
    """What this Python process keeps from task to task.

    The package is shipped by value, so a global of its modules lives for one task (and would be shipped
    with whatever the driver has put in it); this one belongs to the process.
    """
    return sys.modules.setdefault("rivulet_worker_cache", types.ModuleType("rivulet_worker_cache")).__dict__.setdefault("held", {})


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, _UPPER, _LOWER)


def null_as_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first ``name_``, ``name__`` ... that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


FILTER_BITS = 27  # a broadcast id filter has at most 2^27 bits, 16 MB


def without_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not in ``ids`` (one column of that name), without moving most rows.

    A bit filter of bounded size is broadcast; rows that miss it stay where they
    are, only those that hit it (the ids and a few per cent more) meet ``ids`` in
    an exact anti-join. With more ids than the filter can tell apart, more rows
    take the join. A null key matches nothing.
    """
    ids = materialize(ids.select(key).where(F.col(key).isNotNull()), "ids")
    bits = min(FILTER_BITS, max(15, (64 * ids.count()).bit_length()))
    place = F.shiftrightunsigned(F.xxhash64(key), 64 - bits)
    at_, block_, bits_, hit_ = (free_name(df, n) for n in ("_at", "_block", "_bits", "_hit"))
    blocks = ids.select(place.alias(at_)).groupBy(F.shiftright(at_, 15).alias(block_)).agg(
        F.bitmap_construct_agg(F.col(at_) % 32768).alias(bits_))
    at = F.col(at_) % 32768
    byte = F.conv(F.hex(F.col(bits_).substr((at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.col(bits_).isNotNull() & (byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) != 0)
    marked = (df.withColumn(at_, place).withColumn(block_, F.shiftright(at_, 15))
              .join(F.broadcast(blocks), block_, "left").withColumn(hit_, F.coalesce(hit, F.lit(False))))
    sure = marked.where(~F.col(hit_)).select(*df.columns)
    rest = marked.where(hit_).select(*df.columns).join(ids, key, "left_anti")
    return sure.unionByName(rest.select(*df.columns))
