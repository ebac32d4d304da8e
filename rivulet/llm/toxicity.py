"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text is folded (A-Z and accented Latin-1 lowered, every run of other ASCII
signs one space) and its n-grams of 3 to 6 characters are hashed to 2^22 buckets. On
at most ``max_train_docs`` labelled documents, chosen by a hash of doc_id (the
classifier's documented bound), Spark counts in how many documents of either
class a bucket occurs. The buckets whose smoothed log-count ratio r is large and
most significant are the features; a present feature has value r. A logistic
regression with L2 penalty over those rows gives the weights; it keeps the
labels' natural ratio, so the score is a probability.

Scoring reads every n-gram of every whole text in one vectorised pass.

Defined cases: null and empty texts score like a text without any feature;
repeated rows score equally; a document with several labels counts as toxic if
one of them is, and of several labelled rows with one id the one with the
smallest text hash is read; without labelled rows of both classes the score is the share of
label 1 (0 without rows); extra columns are kept by ``score``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.llm import textvec
from rivulet.llm.common import bound_batches, materialize

ORDERS = (3, 4, 5, 6)
BITS = 22
MAX_TRAIN_DOCS = 8000
FEATURES = 4096
LEAST_RATIO = 1.0   # |log-count ratio| of a feature
LEAST_DOCS = 5      # documents that hold it
PENALTY = 1e-4
THRESHOLD = 0.3
_B = np.uint64(0x9E3779B97F4A7C15)


def fold(part) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of folded texts, each with a space before and after."""
    raw, off = textvec.texts(part)
    n = len(off) - 1
    table = textvec.alnum_table()
    b = textvec.fold_latin1(table[raw], raw)
    b = np.where(b == 0, 32, b - 1).astype(np.uint8)
    # one space before and after each text
    out = np.insert(b, np.concatenate([off[:-1], off[1:]]), 32) if n else b
    new = off + 2 * np.arange(n + 1)
    space = out == 32
    drop = np.zeros(len(out), bool)
    drop[1:] = space[1:] & space[:-1]
    drop[new[:-1]] = False
    kept = np.concatenate([[0], np.cumsum(~drop)])
    return out[~drop], kept[new]


def grams(b: np.ndarray, off: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per order: (bucket of the n-gram at each character, text of the character); n-grams across texts are left out."""
    first = (b & 0xC0) != 0x80  # where UTF-8 characters begin
    off = np.concatenate([[0], np.cumsum(first)])[off]
    b = b if first.all() else np.frombuffer(b.tobytes().decode().encode("utf-32-le"), np.uint32)
    c = b.astype(np.uint64) + np.uint64(1)
    text = np.repeat(np.arange(len(off) - 1), np.diff(off))
    h = np.zeros(len(b), np.uint64)
    for k in range(1, ORDERS[-1] + 1):
        h = h[:len(b) - k + 1] * _B + c[k - 1:]
        h ^= h >> np.uint64(29)
        if k in ORDERS and len(h):
            inside = text[:len(h)] == text[k - 1:]
            yield ((h * np.uint64(0xD1342543DE82EF95)) >> np.uint64(64 - BITS)).astype(np.int64)[inside], text[:len(h)][inside]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per bucket and class of a task."""
    total = np.zeros((2, 1 << BITS), np.int32)
    for b in batches:
        for part in textvec.slices(b, "text"):
            y = part.column("y").to_numpy(zero_copy_only=False)
            for bucket, text in grams(*fold(part.column("text"))):
                for i in range(part.num_rows):
                    lo, hi = np.searchsorted(text, [i, i + 1])
                    total[y[i], np.unique(bucket[lo:hi])] += 1
    at = np.flatnonzero(total.any(axis=0))
    yield pa.RecordBatch.from_pydict({"bucket": pa.array(at), "neg": pa.array(total[0, at].astype(np.int64)),
                                      "pos": pa.array(total[1, at].astype(np.int64))})


def present(part, slot: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) pairs of the features that each text holds, each once."""
    found = []
    for bucket, text in grams(*fold(part)):
        f = slot[bucket]
        hit = f >= 0
        found.append(text[hit] * n + f[hit])
    pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return pairs // max(n, 1), pairs % max(n, 1)


def _rows(batches: Iterator[pa.RecordBatch], slot: np.ndarray, n: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for part in textvec.slices(b, "text"):
            text, f = present(part.column("text"), slot, n)
            cut = np.searchsorted(text, np.arange(part.num_rows + 1))
            yield pa.RecordBatch.from_pydict({"y": part.column("y"), "f": pa.array(
                [f[cut[i]:cut[i + 1]].astype(np.int32) for i in range(part.num_rows)], pa.list_(pa.int32()))})


def fit(y: np.ndarray, row: np.ndarray, f: np.ndarray, r: np.ndarray, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression on present features valued r (Adam on the full batch, deterministic): r * weight and bias."""
    w, m, v = np.zeros(len(r) + 1), np.zeros(len(r) + 1), np.zeros(len(r) + 1)
    w[-1] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    for t in range(1, rounds + 1):
        z = np.bincount(row, r[f] * w[f], len(y)) + w[-1]
        d = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / len(y)
        g = np.append(np.bincount(f, d[row] * r[f], len(r)), d.sum())
        g[:-1] += PENALTY * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
    return r * w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, max_train_docs: int = MAX_TRAIN_DOCS) -> tuple[np.ndarray, np.ndarray, float]:
    """(feature of each bucket or -1, feature weights, bias) from documents (doc_id, text) and labels (doc_id, toxic)."""
    bound_batches(docs.sparkSession)
    picked = (labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train_docs))
    # at most max_train_docs rows: bounded, so broadcast; one row of each id, however often it repeats
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.struct(F.xxhash64("text").alias("h"), F.col("text").alias("text")).alias("t")).join(F.broadcast(picked), "doc_id")
    rows = materialize(rows.groupBy("doc_id").agg(F.min("t").alias("t"), F.first("y").alias("y")).select("y", "t.text")
                       .repartition(spark.sparkContext.defaultParallelism), "toxtrain")
    n = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    neg, pos = n.get(0, 0), n.get(1, 0)
    slot = np.full(1 << BITS, -1, np.int16)
    if not pos or not neg:
        rate = pos / (neg + pos) if neg + pos else 0.0
        return slot, np.zeros(0), float(np.log(max(rate, 1e-12) / max(1 - rate, 1e-12)))
    ratio = F.log((F.col("pos") + 1.0) / (pos + 2.0)) - F.log((F.col("neg") + 1.0) / (neg + 2.0))
    chosen = (rows.mapInArrow(_counts, "bucket long, neg long, pos long").groupBy("bucket")
              .agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos")).where(F.col("neg") + F.col("pos") >= LEAST_DOCS)
              .withColumn("r", ratio).where(F.abs("r") >= LEAST_RATIO)
              .orderBy((F.abs("r") / F.sqrt(1 / (F.col("pos") + 1.0) + 1 / (F.col("neg") + 1.0))).desc(), "bucket")
              .limit(FEATURES).select("bucket", "r").collect())
    r = np.array([x["r"] for x in chosen])
    slot[[x["bucket"] for x in chosen]] = np.arange(len(chosen))
    got = rows.mapInArrow(lambda it: _rows(it, slot, len(r)), "y int, f array<int>").collect()  # a bounded sample's features
    y = np.array([x["y"] for x in got], float)
    row = np.repeat(np.arange(len(got)), [len(x["f"]) for x in got])
    f = np.concatenate([np.array(x["f"], np.int64) for x in got])
    weights, bias = fit(y, row, f, r)
    return slot, weights, bias


def _score(batches: Iterator[pa.RecordBatch], slot, weights, bias, threshold, text) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for part in textvec.slices(b, text):
            at, f = present(part.column(text), slot, len(weights))
            z = np.bincount(at, weights[f], part.num_rows) + bias if len(weights) else np.full(part.num_rows, bias)
            p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                                             names=[*part.schema.names, "score", "predicted"])


def score(docs: DataFrame, model: tuple, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score and predicted added; columns of those names are replaced."""
    bound_batches(docs.sparkSession)
    slot, weights, bias = model
    docs = docs.drop("score", "predicted")
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return docs.mapInArrow(lambda it: _score(it, slot, weights, bias, threshold, text), schema)
