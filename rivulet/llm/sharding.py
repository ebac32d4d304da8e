"""Sharding by global byte-size prefix sums (law ``bytes``).

Documents are ordered by (hash of text, doc_id), so equal texts are neighbours.
The order is realised by a range partitioning on both keys, so one text that
holds a third of all rows still spreads over many tasks. Each partition keeps a
running byte sum; its total goes to the driver (one row per partition), where
the totals become offsets. The n-1 cuts lie at equal byte targets. A cut that
would split a group of equal texts moves to that group's nearer end, if that
moves it by at most ``TOLERANCE`` of a shard; else the group is cut between its
rows, as sizes would not be near equal otherwise. A shard's size is therefore
within twice ``TOLERANCE`` of the target, give or take one row. Shards are
contiguous, slots are gapless.

Defined cases: a null text has size 1 and hashes as the empty text; an empty
table gives an empty result; fewer rows than shards leave shards empty;
repeated rows keep one slot each and spread over tasks. Columns other than those named by ``carry``
are dropped; a carried column must not be one of the result's names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.llm.common import materialize, null_as_empty


TOLERANCE = 0.05  # of a shard's target size: how far a cut moves to keep equal texts together


def _running(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Adds run_rows and run_bytes: rows and bytes up to and with each row of a sorted partition."""
    rows = total = 0
    for b in batches:
        sums = np.cumsum(b.column(size).to_numpy(zero_copy_only=False)) + total
        at = np.arange(rows + 1, rows + b.num_rows + 1)
        names = [*b.schema.names, "run_rows", "run_bytes"]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.int64()), pa.array(sums, pa.int64())], names=names)
        if b.num_rows:
            rows, total = int(at[-1]), int(sums[-1])


def shard_documents(docs: DataFrame, n_shards: int = 16, text: str = "text", carry: Sequence[str] = (),
                    keep_groups: bool = True) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and the carried columns of every document."""
    placed, cuts = _place(docs, n_shards, text, carry, keep_groups)
    shard = sum((F.when(F.col("_row") >= F.lit(c), 1).otherwise(0) for c in cuts[1:]), F.lit(0))
    first = F.element_at(F.array(*[F.lit(c).cast("long") for c in cuts]), F.col("shard") + 1)
    out = placed.withColumn("shard", shard.cast("int"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                      (F.col("_row") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
                      *[c for c in carry if c != "doc_id"])


def assign_shards(docs: DataFrame, n_shards: int = 16, text: str = "text", keep_groups: bool = True) -> DataFrame:
    """``docs`` with its shard added: the same shards, found by comparing each row with the cut keys, so no text moves.

    Repeated rows of one document stay together even where a cut falls between them.
    """
    placed, cuts = _place(docs, n_shards, text, (), keep_groups)
    keys = {r["_row"]: (r["_g"], r["doc_id"]) for r in
            placed.where(F.col("_row").isin(cuts[1:])).select("_row", "_g", "doc_id").collect()}  # a row per cut
    kind = docs.schema["doc_id"].dataType
    here = F.struct(_group(text).alias("g"), F.col("doc_id").alias("d"))
    above = [here >= F.struct(F.lit(keys[c][0]).alias("g"), F.lit(keys[c][1]).cast(kind).alias("d")) for c in cuts[1:] if c in keys]
    return docs.withColumn("shard", sum((F.when(a, 1).otherwise(0) for a in above), F.lit(0)).cast("int"))


def _group(text: str):
    """Hash that equal texts share; the order of the shards."""
    return F.xxhash64(null_as_empty(F.col(text)))


def _place(docs: DataFrame, n_shards: int, text: str, carry: Sequence[str], keep_groups: bool) -> tuple[DataFrame, list[int]]:
    """(rows with their global row number and end byte, first global row of every shard)."""
    spark = docs.sparkSession
    t = null_as_empty(F.col(text))
    base = docs.select(
        "doc_id", (F.octet_length(t) + F.lit(1)).cast("long").alias("size"), F.crc32(t.cast("binary")).alias("text_crc32"),
        _group(text).alias("_g"), F.monotonically_increasing_id().alias("_tie"), *[F.col(c) for c in carry if c != "doc_id"])
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    part = (base.repartitionByRange(n, "_g", "doc_id", "_tie").sortWithinPartitions("_g", "doc_id", "_tie")
            .withColumn("_pid", F.spark_partition_id()))
    schema = T.StructType([*part.schema.fields, T.StructField("run_rows", T.LongType()), T.StructField("run_bytes", T.LongType())])
    at = part.columns.index("size")
    ranked = materialize(part.mapInArrow(lambda it: _running(it, at), schema), "sharding")

    # per-partition totals: one row per range partition
    totals = sorted((r["_pid"], r["n"], r["b"]) for r in
                    ranked.groupBy("_pid").agg(F.max("run_rows").alias("n"), F.max("run_bytes").alias("b")).collect())
    row_at, byte_at, rows, total = {}, {}, 0, 0
    for pid, k, b in totals:
        row_at[pid], byte_at[pid], rows, total = rows, total, rows + k, total + b
    starts = spark.createDataFrame([(p, row_at[p], byte_at[p]) for p, *_ in totals], "_pid int, row0 long, byte0 long")
    placed = ranked.join(F.broadcast(starts), "_pid").select(
        "*", (F.col("row0") + F.col("run_rows") - 1).alias("_row"), (F.col("byte0") + F.col("run_bytes")).alias("_end"))
    return placed, _cuts(placed, total, rows, n_shards, keep_groups)


def _cuts(placed: DataFrame, total: int, rows: int, n_shards: int, keep_groups: bool) -> list[int]:
    """First global row of every shard; looks at one row and one group of texts per cut."""
    targets = [total * k / n_shards for k in range(1, n_shards)]
    if not rows or not targets:
        return [0] + [rows] * (n_shards - 1)
    begin = F.col("_end") - F.col("size")
    crossing = placed.where(_any([(begin < t) & (F.col("_end") >= t) for t in targets]))
    hit = crossing.select("_g", "_row", begin.alias("b"), F.col("_end").alias("e")).collect()  # <= n_shards - 1 rows
    extent = {r["_g"]: r for r in placed.where(F.col("_g").isin([h["_g"] for h in hit])).groupBy("_g").agg(
        F.min("_row").alias("r0"), F.max("_row").alias("r1"), F.min(begin).alias("b"), F.max("_end").alias("e")).collect()}
    cuts = [0]
    for t in targets:
        h = next(x for x in hit if x["b"] < t <= x["e"])
        g = extent[h["_g"]]
        if keep_groups and min(t - g["b"], g["e"] - t) <= TOLERANCE * total / n_shards:
            cut = g["r0"] if t - g["b"] < g["e"] - t else g["r1"] + 1
        else:
            cut = h["_row"] if t - h["b"] < h["e"] - t else h["_row"] + 1
        cuts.append(max(cut, cuts[-1]))
    return cuts


def _any(conditions):
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out



