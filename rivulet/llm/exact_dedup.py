"""Exact dedup by a heavy-hitter split.

Misra-Gries summaries of every partition find the digests that may be frequent.
Their exact counts and winners (verified by a second, map-side combined count)
form a table of at most ``max_heavy`` rows; it is broadcast and settles the
frequent copies without moving a row. All other digests take an ordinary
shuffle, where no group can hold more than about rows / ``counters`` rows of
any partition's input.

Defined cases: a null text is an empty text; repeated rows (same id, same text)
form one group whose winner is one of them (``kept`` is true for exactly one
row); an empty table gives an empty result; null ids rank below all others.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rivulet.llm.common import ascii_lower, materialize, null_as_empty

COUNTERS = 1024   # Misra-Gries counters of a partition: every digest above rows/1025 of a partition survives
MAX_HEAVY = 8192  # rows of the broadcast winner table; candidates beyond it take the ordinary shuffle


def misra_gries(batches: Iterator[pa.RecordBatch], counters: int = COUNTERS) -> Iterator[pa.RecordBatch]:
    """Misra-Gries over column 0: (digest, count), the count a lower bound, of the digests that survive."""
    kept: dict[str, int] = {}
    for batch in batches:
        for pair in batch.column(0).value_counts().to_pylist():
            kept[pair["values"]] = kept.get(pair["values"], 0) + pair["counts"]
        if len(kept) > counters:  # subtract the (counters+1)-th largest count from all: the batched decrement
            cut = sorted(kept.values(), reverse=True)[counters]
            kept = {d: n - cut for d, n in kept.items() if n > cut}
    yield pa.RecordBatch.from_pydict({"digest": pa.array(list(kept), pa.string()),
                                      "low": pa.array(list(kept.values()), pa.int64())})


def digests(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, text_sha256 of the normalised text (A-Z lowered), and a row number ``rid``; written once."""
    out = docs.select("doc_id", F.sha2(ascii_lower(null_as_empty(F.col(text))), 256).alias("text_sha256"))
    return materialize(out.withColumn("rid", F.monotonically_increasing_id()), "digests")


def resolve(keyed: DataFrame, counters: int = COUNTERS, max_heavy: int = MAX_HEAVY) -> DataFrame:
    """keep_id, group_size and kept for rows of (doc_id, text_sha256, rid)."""
    rank = F.struct(F.col("doc_id"), F.col("rid"))
    guess = (keyed.select("text_sha256").mapInArrow(lambda it: misra_gries(it, counters), "digest string, low long")
             .groupBy("digest").agg(F.sum("low").alias("low")).where("low > 1")
             .orderBy(F.desc("low"), "digest").limit(max_heavy))
    # verified: exact counts and winners of the guessed digests, combined map-side
    heavy = materialize(
        keyed.join(F.broadcast(guess.select(F.col("digest").alias("text_sha256"))), "text_sha256", "left_semi")
        .groupBy("text_sha256").agg(F.max(rank).alias("win"), F.count("*").alias("group_size")), "heavy")
    settled = keyed.join(F.broadcast(heavy), "text_sha256")
    rest = keyed.join(F.broadcast(heavy.select("text_sha256")), "text_sha256", "left_anti")
    group = Window.partitionBy("text_sha256")
    rest = rest.withColumns({"win": F.max(rank).over(group), "group_size": F.count("*").over(group)})
    return settled.unionByName(rest).select(
        "doc_id", F.col("win.doc_id").alias("keep_id"), "group_size", (F.col("win.rid") == F.col("rid")).alias("kept"),
        "text_sha256", "rid")


def exact_dedup(docs: DataFrame, text: str = "text", counters: int = COUNTERS, max_heavy: int = MAX_HEAVY) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256. The largest doc_id stays."""
    return resolve(digests(docs, text), counters, max_heavy).drop("rid")
