"""User-defined aggregates and window functions over event-time windows.

``AggregateFunction`` is the incremental hook: create / add / merge / result. ``aggregate`` adds rows to
accumulators map-side (one per key and pane in each task, from Arrow batches), ships only accumulators, merges
them per pane behind one exchange, and for sliding windows merges panes, not rows, into windows. A key or window
that holds a third of all rows reaches its merge as one accumulator a task.

``process_windows`` is the full-window hook: a function gets a window's key and an iterator of Arrow batches of its
rows in a stated order, and yields result batches. Spark sorts and spills the rows; the function sees one batch at a
time, so a window larger than a worker's memory passes through it.

The built-in aggregates remain the fast path; these are for what they cannot say.

Defined cases: null keys are a key of their own; rows with a null time are in no window; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rivulet.functions.timefmt import duration_ms
from rivulet.operators.windows import _col, _key_cols, slot_index, slot_to_ts

MAX_HELD = 1 << 16  # accumulators a task holds before it sends them


class AggregateFunction:
    """A user's aggregate. Accumulators are tuples of the ``state`` fields, so they move as typed columns.

    ``merge`` must be associative and commutative, and ``add`` to a fresh accumulator followed by ``merge`` must equal
    ``add`` to the merged one: the engine picks what it adds and what it merges.
    """

    state: str        # DDL of the accumulator's fields
    result_type: str  # DDL type of the result

    def create(self) -> tuple:
        raise NotImplementedError

    def add(self, state: tuple, rows: pa.RecordBatch) -> tuple:
        """``rows``: the input columns of some rows of the accumulator's key and pane."""
        raise NotImplementedError

    def merge(self, a: tuple, b: tuple) -> tuple:
        raise NotImplementedError

    def result(self, state: tuple):
        raise NotImplementedError


def _arrow(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(StructType.fromDDL(ddl))


def _groups(batch: pa.RecordBatch, names: Sequence[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """(key values, rows) of each distinct key of a batch."""
    codes = np.stack([batch.column(n).dictionary_encode(null_encoding="encode").indices.to_numpy() for n in names], axis=1)
    _, at = np.unique(codes, axis=0, return_inverse=True)
    order = np.argsort(at.ravel(), kind="stable")
    cuts = [0, *(np.flatnonzero(np.diff(at.ravel()[order])) + 1).tolist(), len(order)]
    rows = batch.take(pa.array(order))
    firsts = rows.select(list(names)).take(pa.array(cuts[:-1])).to_pylist()
    for first, a, z in zip(firsts, cuts, cuts[1:]):
        yield tuple(first[n] for n in names), rows.slice(a, z - a)


def _rows_out(names: Sequence[str], keys: list[tuple], states: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array([k[i] for k in keys], schema.field(n).type) for i, n in enumerate(names)]
    last = schema.field(len(names))
    if pa.types.is_struct(last.type):
        fields = [f.name for f in last.type]
        states = [dict(zip(fields, s)) for s in states]
    return pa.RecordBatch.from_arrays([*columns, pa.array(states, last.type)], names=[*names, last.name])


def _accumulate(batches: Iterator[pa.RecordBatch], fn: AggregateFunction, names: list[str], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """(keys, pane, state): accumulators of a task's rows."""
    held: dict[tuple, tuple] = {}
    for b in batches:
        if not b.num_rows:
            continue
        for key, rows in _groups(b, names):
            held[key] = fn.add(held[key] if key in held else fn.create(), rows)
        if len(held) >= MAX_HELD:
            yield _rows_out(names, list(held), list(held.values()), schema)
            held = {}
    if held:
        yield _rows_out(names, list(held), list(held.values()), schema)


def _same(a: tuple, b: tuple) -> bool:
    return all(x == y or (x != x and y != y) for x, y in zip(a, b))


def _merge(batches: Iterator[pa.RecordBatch], fn: AggregateFunction, names: list[str], schema: pa.Schema, final: bool) -> Iterator[pa.RecordBatch]:
    """Accumulators (or results) of rows sorted by key: one running accumulator, whatever a key's number of rows."""
    key, state = None, None
    keys, out = [], []
    fields = None
    for b in batches:
        fields = fields or [f.name for f in b.schema.field("_state").type]
        for row in b.to_pylist():
            now, part = tuple(row[n] for n in names), tuple(row["_state"][f] for f in fields)
            if key is not None and _same(key, now):
                state = fn.merge(state, part)
                continue
            if key is not None:
                keys.append(key)
                out.append(fn.result(state) if final else state)
            key, state = now, part
        if len(keys) >= 8192:
            yield _rows_out(names, keys, out, schema)
            keys, out = [], []
    if key is not None:
        keys.append(key)
        out.append(fn.result(state) if final else state)
    if keys:
        yield _rows_out(names, keys, out, schema)


def aggregate(df: DataFrame, fn: AggregateFunction, keys, time_col: str, size, slide=None, inputs: Sequence[str] = (),
              name: str = "value") -> DataFrame:
    """``fn`` over the ``inputs`` columns per key and window of a table: keys, window_start, window_end, name."""
    keys = _key_cols(keys)
    size_ms = duration_ms(size)
    pane_ms = duration_ms(slide) if slide is not None else size_ms
    if size_ms % pane_ms:
        raise ValueError("slide must divide size")
    n = size_ms // pane_ms
    rows = df.where(_col(time_col).isNotNull()).select(*keys, slot_index(time_col, pane_ms).alias("_pane"), *inputs)
    key_ddl = "".join(f"`{k}` {df.schema[k].dataType.simpleString()}, " for k in keys)
    state = f"struct<{', '.join(f'{f.name}:{f.dataType.simpleString()}' for f in StructType.fromDDL(fn.state))}>"

    def stage(part: DataFrame, slot: str, kind: str, run: Callable) -> DataFrame:
        ddl = f"{key_ddl}`{slot}` long, _state {kind}"
        schema, names = _arrow(ddl), [*keys, slot]
        return part.mapInArrow(lambda it: run(it, fn, names, schema), ddl)

    def merged(part: DataFrame, slot: str, final: bool) -> DataFrame:
        together = part.repartition(*keys, slot).sortWithinPartitions(*keys, slot)
        return stage(together, slot, fn.result_type if final else state, lambda it, f, names, schema: _merge(it, f, names, schema, final))

    partial = stage(rows, "_pane", state, _accumulate)
    if n == 1:
        done = merged(partial, "_pane", True).withColumn("_slot", F.col("_pane") + 1)
    else:  # slot s: the window that ends at s * slide; a pane is part of windows pane + 1 .. pane + n
        panes = merged(partial, "_pane", False)
        spread = panes.select(*keys, F.explode(F.sequence(F.col("_pane") + 1, F.col("_pane") + n)).alias("_slot"), "_state")
        done = merged(spread, "_slot", True)
    return done.select(*keys, slot_to_ts(F.col("_slot") - n, pane_ms).alias("window_start"), slot_to_ts(F.col("_slot"), pane_ms).alias("window_end"),
                       F.col("_state").alias(name))


# ---- two aggregates through the hook -------------------------------------------------

class IntegerAverage(AggregateFunction):
    """Sum / count with integral division, as DOUBLE (A4). Nulls are no values; without values the result is null."""

    state = "total decimal(38,0), n long"
    result_type = "double"

    def __init__(self, column: str):
        self.column = column

    def create(self) -> tuple:
        return 0, 0

    def add(self, state: tuple, rows: pa.RecordBatch) -> tuple:
        values = [v for v in rows.column(self.column).to_pylist() if v is not None]
        return state[0] + sum(values), state[1] + len(values)

    def merge(self, a: tuple, b: tuple) -> tuple:
        return a[0] + b[0], a[1] + b[1]

    def result(self, state: tuple):
        total, n = int(state[0]), state[1]
        if not n:
            return None
        whole = abs(total) // n
        return float(whole if total >= 0 else -whole)


class QuantileSketch(AggregateFunction):
    """Quantiles of integers from counts of their first ``bits`` binary digits.

    A value's bucket is the value with all later digits zero, so a quantile is below the true one by less than
    2^(1 - bits) of it, whatever the number of rows; an accumulator has at most 2 * 64 * 2^bits buckets. Bucket counts
    add, so the result does not depend on how rows were split. Results are nearest-rank quantiles.
    """

    state = "bucket array<long>, n array<long>"
    result_type = "array<long>"

    def __init__(self, column: str, at: Sequence[float] = (0.5, 0.99), bits: int = 7):
        self.column, self.at, self.bits = column, tuple(at), bits

    def create(self) -> tuple:
        return [], []

    def _buckets(self, v: np.ndarray) -> np.ndarray:
        size = np.abs(v)
        length = np.frexp(size.astype(np.float64))[1].astype(np.int64)
        length -= (length > 0) & (size >> np.maximum(length - 1, 0) == 0)  # a float that was rounded up
        cut = np.maximum(length - self.bits, 0)
        return np.sign(v) * (size >> cut << cut)

    def add(self, state: tuple, rows: pa.RecordBatch) -> tuple:
        v = rows.column(self.column).drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
        bucket, n = np.unique(self._buckets(v), return_counts=True)
        return self.merge(state, (bucket.tolist(), n.tolist()))

    def merge(self, a: tuple, b: tuple) -> tuple:
        both = dict(zip(*a))
        for bucket, n in zip(*b):
            both[bucket] = both.get(bucket, 0) + n
        order = sorted(both)
        return order, [both[x] for x in order]

    def result(self, state: tuple):
        bucket, n = state
        if not bucket:
            return None
        up = np.cumsum(np.array(n, np.int64))
        # the first bucket whose running count reaches the rank
        rank = [max(1, int(np.ceil(q * float(up[-1])))) for q in self.at]
        return [int(bucket[i]) for i in np.searchsorted(up, rank, "left")]


# ---- whole windows -------------------------------------------------------------------

def process_windows(df: DataFrame, fn: Callable[[tuple, Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keys, time_col: str, size,
                    schema: str, slide=None, columns: Sequence[str] = (), order: Sequence[str] = ()) -> DataFrame:
    """``fn(key, rows)`` over every key and window of a table; its batches, of ``schema``, are the result.

    ``key`` is (key values ..., window start, window end) as Python values. ``rows`` yields the window's rows (the keys,
    ``window_start``, ``window_end``, ``columns``) in Arrow batches, sorted by time and then by ``order``. Spark groups and
    sorts (and spills) them; ``fn`` sees them once, a batch at a time, and need not read all. With ``slide`` a row is in
    size / slide windows and is copied that often: prefer ``aggregate`` where an accumulator will do.
    """
    keys = _key_cols(keys)
    window = F.window(_col(time_col), *[f"{duration_ms(x)} milliseconds" for x in (size, slide) if x is not None])
    wanted = list(dict.fromkeys([*keys, *columns, *order, time_col]))
    rows = df.select(*wanted, window.alias("_w")).select(
        *wanted, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"))
    group = [*keys, "window_start", "window_end"]
    # the exchange and the sort already satisfy the grouping below, which adds neither
    rows = rows.repartition(*group).sortWithinPartitions(*group, time_col, *order)
    shown = [*group, *(c for c in dict.fromkeys([*columns]) if c not in group)]

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = tuple(k.as_py() for k in key)
        yield from fn(values, (b.select(shown) for b in batches))

    return rows.groupBy(*group).applyInArrow(run, schema)
