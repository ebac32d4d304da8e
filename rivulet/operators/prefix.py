"""Running sums over a global order, spread over tasks by equal row counts.

Rows are range-partitioned on (keys, order): Spark samples the rows for the split points, so every part holds about as
many rows, however unevenly time or keys are filled. Sums of whole parts become offsets (a row per key and part), and the
sum inside a part starts from its offset. No key, window or busy minute is one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.operators.windows import _null_safe_on
from rivulet.session import materialize


def running_sum(df: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over the rows of the same keys up to and with this one.

    ``order`` must order the rows of a key totally. The partitioned rows are written to the shared folder once, since
    offsets and rows must see the same parts.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = materialize(df.repartitionByRange(n, *keys, *order).withColumn("_part", F.spark_partition_id()), "running-sum")
    sums = parts.groupBy(*keys, "_part").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*keys, "_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    rows = parts.alias("a").join(offsets.alias("b"), _null_safe_on("a", "b", keys, ["_part"])).select("a.*", "b._before")
    inside = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.col("_before") + F.sum(value).over(inside)).select(*df.columns, name)
