"""Operator 12 against brute force in plain Python integers."""

import random

import numpy as np
import pyarrow as pa
import pytest

from rivulet.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=100):
    """Rows of (vec_id, vector, label), vector in whole numbers, as (anchor, positive, rank, negative, scores) sorted."""
    rows = [(i, v, c) for i, v, c in rows if v is not None and c is not None]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    key = lambda x: (-x[1], x[0] is None, x[0] or 0)
    out = []
    for at, (i, v, c) in enumerate(rows):
        if i is None or i % every:
            continue
        same = sorted(((j, dot(v, w)) for k, (j, w, d) in enumerate(rows) if d == c and k != at), key=key)[:5]
        other = sorted(((j, dot(v, w)) for j, w, d in rows if d != c), key=key)
        for p, s in same:
            fits = [(j, t) for j, t in other if 80 * s <= 100 * t <= 100 * s][:5]
            out += [(i, p, r, j, s, t) for r, (j, t) in enumerate(fits, 1)]
    return out


def got(df, **kw):
    return sorted((tuple(r) for r in hn.mine(df, **kw).collect()), key=repr)


def whole(v):
    return None if v is None else [int(np.floor(256 * float(np.float32(x)))) for x in v]


def random_rows(n, dim, labels, seed, clustered=False):
    r = np.random.default_rng(seed)
    centers = r.normal(size=(12, dim))
    at = r.integers(0, 12, n)
    v = (centers[at] + 0.1 * r.normal(size=(n, dim)) if clustered else r.normal(size=(n, dim))).astype(np.float32)
    return [(i, v[i].tolist(), int(r.integers(0, labels))) for i in range(n)]


@pytest.mark.parametrize("clustered", [False, True])
def test_equals_brute_force(spark, clustered):
    rows = random_rows(1500, 16, 6, 1, clustered)
    want = sorted(brute([(i, whole(v), c) for i, v, c in rows]), key=repr)
    assert got(spark.createDataFrame(rows, SCHEMA)) == want
    assert len(want) > 100
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(7), part_rows=100) == want


def test_ties_repeats_nulls_and_odd_rows(spark):
    r = random.Random(5)
    rows = [(i, [r.choice([0.0, 0.5, 1.0]) for _ in range(3)], r.randint(0, 2)) for i in range(400)]
    rows += [(1000 + i, [1.0, 1.0, 0.5], 1) for i in range(300)]  # one very common vector
    rows += [(100, [1.0, 1.0, 1.0], 1)] * 3 + [(None, [1.0, 1.0, 1.0], 2), (7, None, 1), (200, [1.0, 1.0, 1.0], None)]
    odd = [(300, [float("nan"), 1.0, 1.0], 1), (500, [1.0, None, 1.0], 2), (600, [float("inf"), 1.0, 1.0], 2)]
    short = [(700, [1.0], 1), (701, [], 0), (702, [1.0, 1.0, 1.0, 1.0], 2), (-100, [-1.0, -1.0, -1.0], 3), (-200, [-1.0, -0.5, -1.0], 3)]
    df = spark.createDataFrame([(*x, "extra", 1) for x in rows + odd + short], SCHEMA + ", rid string, part int")
    want = sorted(brute([(i, whole(v), c) for i, v, c in rows + short]), key=repr)
    assert got(df) == want
    assert got(df, part_rows=50) == want


def test_empty_and_lonely(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    assert got(spark.createDataFrame([(0, [1.0, 2.0], 1)], SCHEMA)) == []
    assert got(spark.createDataFrame([(0, [1.0, 2.0], 1), (1, [1.0, 2.0], 1)], SCHEMA)) == []
    assert got(spark.createDataFrame([(0, None, 1), (100, [1.0], None)], SCHEMA)) == []


def test_scores_beyond_floats_are_exact(spark):
    r = random.Random(2)
    rows = [(i, [float(r.randint(-2**22, 2**22)) for _ in range(8)], r.randint(0, 3)) for i in range(600)]
    want = sorted(brute([(i, whole(v), c) for i, v, c in rows]), key=repr)
    assert max(abs(x[4]) for x in want) > 2**53
    assert got(spark.createDataFrame(rows, SCHEMA)) == want
    with pytest.raises(Exception, match="too large"):
        got(spark.createDataFrame([(0, [1e30], 1), (1, [1.0], 1)], SCHEMA))


def test_shifted_labels(spark):
    rows = [(0, [1.0], 9), (7, [1.0], 3), (8, [1.0], 3), (14, [1.0], None), (None, [1.0], 4), (21, [1.0], 2**31 - 1)]
    out = hn.shifted_labels(spark.createDataFrame(rows, SCHEMA))
    assert {r.vec_id: r.label for r in out.collect()} == {0: 0, 7: 4, 8: 3, 14: None, None: 4, 21: 8}


def make_part(v, labels, books=None):
    n = len(v)
    books = books or [hn.fit_book(x.astype(float)) for x in hn.halves(v)]
    one, two = hn.halves(v)
    t = pa.table({"rid": pa.array(range(n), pa.int64()), "vec_id": pa.array(range(n), pa.int64()), "label": pa.array(labels, pa.int64()),
                  "c1": pa.array(hn.nearest(one, books[0])), "c2": pa.array(hn.nearest(two, books[1])),
                  "v": pa.array([x.astype("<i4").tobytes() for x in v], pa.binary())})
    return hn.Part(t, books, v.shape[1])


def test_walk_visits_by_bound_and_stops_when_certified():
    r = np.random.default_rng(3)
    centers = r.normal(size=(8, 20)) * 300
    v = np.floor(centers[r.integers(0, 8, 4000)] + r.normal(size=(4000, 20)) * 5)
    part = make_part(v, [0] * 4000)
    q = v[:1]
    exact = v @ q[0]
    state = hn._State(np.array([exact.max() * 0.98]), np.array([np.inf]))  # noqa: SLF001
    seen = np.concatenate(list(part.all.walk(q, state)))
    assert set(np.flatnonzero(exact >= state.low[0])) <= set(seen.tolist())
    assert len(seen) < 2500  # far clusters were never visited
    everything = np.concatenate(list(part.all.walk(q, hn._State(np.array([-np.inf]), np.array([np.inf])))))  # noqa: SLF001
    assert sorted(everything.tolist()) == list(range(4000))


def test_a_half_cluster_bound_holds_for_all_members():
    r = np.random.default_rng(4)
    v = np.floor(r.normal(size=(500, 7)) * 256)
    part = make_part(v, [0] * 500)
    q = np.floor(r.normal(size=(9, 7)) * 256)
    low = np.sort(q @ v.T, axis=1)[:, -3]
    for a in range(9):
        seen = np.concatenate(list(part.all.walk(q[a:a + 1], hn._State(low[a:a + 1], np.array([np.inf])))))  # noqa: SLF001
        assert set(np.flatnonzero(v @ q[a] >= low[a])) <= set(seen.tolist())


def test_only_first_copies_are_kept():
    part = make_part(np.ones((50, 4)), [0] * 30 + [1] * 20)
    assert part.all.rows.tolist() == [*range(6), *range(30, 36)]
