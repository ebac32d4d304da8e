"""User hooks: aggregates with accumulators, and whole windows as an iterator of batches."""

import random
import sys
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from rivulet.operators import hooks
from rivulet.operators.hooks import AggregateFunction, IntegerAverage, QuantileSketch, aggregate, process_windows

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import a test module

T0 = 1_600_000_000


def rows(spark, n=600, seed=1, keys=("a", "b", None), hot=0):
    r = random.Random(seed)
    data = [(r.choice(keys), r.uniform(0, 5000), r.choice([None, r.randint(-50, 10**6)]), i) for i in range(n)]
    data += [("hot", 100.0 + i / 100, i, n + i) for i in range(hot)]
    df = spark.createDataFrame(data, "k string, s double, v long, seq long")
    return data, df.withColumn("t", F.timestamp_micros((F.lit(T0 * 1_000_000) + F.col("s") * 1_000_000).cast("long")))


def windows(s, size, slide):
    us = int((T0 * 1_000_000) + s * 1_000_000)
    slot = us // (slide * 1_000_000)
    return [(slot + 1 + i) * slide for i in range(size // slide)]


def by_window(data, size, slide):
    out = defaultdict(list)
    for k, s, v, seq in data:
        for end in windows(s, size, slide):
            out[k, end].append((s, seq, v))
    return out


@pytest.mark.parametrize("slide", [None, 100])
def test_integer_average_equals_plain_python(spark, slide, monkeypatch):
    monkeypatch.setattr(hooks, "MAX_HELD", 7)  # accumulators leave in many pieces
    data, df = rows(spark, hot=200)
    got = aggregate(df.repartition(5), IntegerAverage("v"), "k", "t", "1200 seconds", f"{slide} seconds" if slide else None, ["v"])
    have = {(r.k, int(r.window_end.timestamp())): r.value for r in got.collect()}
    want = {}
    for key, group in by_window(data, 1200, slide or 1200).items():
        values = [v for *_, v in group if v is not None]
        want[key] = float(int(sum(values) / len(values)) if sum(values) < 0 else sum(values) // len(values)) if values else None
    assert have == want and len(want) > 8


def test_quantiles_keep_their_bound(spark):
    data, df = rows(spark, n=3000)
    got = aggregate(df, QuantileSketch("v", (0.25, 0.5, 0.99)), "k", "t", "1 hour", None, ["v"])
    groups = by_window(data, 3600, 3600)
    for r in got.collect():
        values = sorted(v for *_, v in groups[r.k, int(r.window_end.timestamp())] if v is not None)
        for q, found in zip((0.25, 0.5, 0.99), r.value):
            true = values[max(1, -(-len(values) * q // 1).__int__()) - 1]
            assert abs(found) <= abs(true) and abs(true - found) <= abs(true) * 2 ** -6
    assert got.count() == len(groups)


def test_quantile_buckets_are_first_binary_digits():
    import numpy as np

    q = QuantileSketch("v", bits=7)
    v = np.array([0, 1, -1, 127, 128, 129, 255, 256, 2**53 - 1, 2**53, 2**62 + 12345, 2**63 - 1, -(2**40) - 7])
    want = [int(np.sign(x)) * (abs(int(x)) >> max(0, abs(int(x)).bit_length() - 7) << max(0, abs(int(x)).bit_length() - 7)) for x in v]
    assert q._buckets(v).tolist() == want  # noqa: SLF001


class Longest(AggregateFunction):
    """The longest text of a column, first in order among equals."""

    state = "best string"
    result_type = "string"

    def create(self):
        return (None,)

    def _better(self, a, b):
        return a if b is None or (a is not None and (-len(a), a) <= (-len(b), b)) else b

    def add(self, state, rows):
        best = state[0]
        for x in rows.column("x").to_pylist():
            best = self._better(best, x)
        return (best,)

    def merge(self, a, b):
        return (self._better(a[0], b[0]),)

    def result(self, state):
        return state[0]


def test_a_users_own_aggregate_without_keys(spark):
    df = spark.createDataFrame([("aa", 1), ("bbb", 2), (None, 3), ("ccc", 700)], "x string, s long").withColumn("t", F.timestamp_seconds(F.col("s") + T0 - T0 % 600))
    got = aggregate(df, Longest(), [], "t", "10 minutes", None, ["x"], "longest").orderBy("window_end").collect()
    assert [r.longest for r in got] == ["bbb", "ccc"]
    assert aggregate(df.where("s < 0"), Longest(), [], "t", "10 minutes", None, ["x"]).collect() == []


def gaps(key, batches):
    n, last, longest = 0, None, 0
    for b in batches:
        for t in b.column("t").cast(pa.timestamp("us", "UTC")).cast(pa.int64()).to_pylist():
            longest = max(longest, 0 if last is None else t - last)
            n, last = n + 1, t
    yield pa.RecordBatch.from_pydict({"k": pa.array([key[0]], pa.string()), "end": pa.array([int(key[2].timestamp())]), "n": pa.array([n]), "gap": pa.array([longest])})


@pytest.mark.parametrize("slide", [None, 600])
def test_whole_windows_come_sorted(spark, slide):
    data, df = rows(spark, hot=300)
    got = process_windows(df.repartition(6), gaps, "k", "t", "1200 seconds", "k string, end long, n long, gap long",
                          f"{slide} seconds" if slide else None, ["t"], ["seq"])
    have = {(r.k, r.end): (r.n, r.gap) for r in got.collect()}
    want = {}
    for key, group in by_window(data, 1200, slide or 1200).items():
        us = sorted(int(T0 * 1_000_000 + s * 1_000_000) for s, *_ in group)
        want[key] = (len(us), max((b - a for a, b in zip(us, us[1:])), default=0))
    assert have == want


def test_a_large_window_arrives_in_batches(spark):
    n = 60_000
    df = spark.range(n).select(F.lit("one").alias("k"), F.timestamp_micros(F.lit(T0 * 1_000_000) + F.col("id")).alias("t"), F.col("id").alias("seq"))

    def sizes(key, batches):
        seen = [b.num_rows for b in batches]
        yield pa.RecordBatch.from_pydict({"batches": pa.array([len(seen)]), "most": pa.array([max(seen)]), "n": pa.array([sum(seen)])})

    got = process_windows(df, sizes, "k", "t", "1 hour", "batches long, most long, n long", None, ["seq"]).first()
    assert got.n == n and got.batches >= 5 and got.most <= int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))


def test_grouping_adds_no_exchange_or_sort(spark):
    _, df = rows(spark)
    plan = process_windows(df, gaps, "k", "t", "1 hour", "k string, end long, n long, gap long", None, ["t"], ["seq"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and text.count("Sort") == 1
