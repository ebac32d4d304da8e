"""Hard-negative mining by an inverted multi-index, exact.

Vectors become integers, floor(256 x). Two codebooks, one a half of the vector, are fitted by k-means
on a bounded sample; a row's cell is its pair of nearest half-centroids. Rows are dealt over index
parts; each part holds its rows by cell and the exact radius of each of its half-clusters.

1. Positives: every anchor meets the cells of its own label in every part.
2. Negatives: every anchor, now with its positives' scores, meets the cells of all labels.

In both, a block of neighbouring anchors walks a part's cells by the multi-sequence algorithm: a
half-cluster's bound is the largest inner product its radius allows to any anchor of the block, cells
leave a heap by the sum of their two bounds, and cells that no anchor needs are passed over. The walk
stops once the best bound left is under the lowest score that could still enter any anchor's lists: the
lists are then certified. Bounds only order and prune; scores are exact integers, so the result is that
of brute force. A part's lists (five an anchor, or an anchor and positive) are merged by a ranking.

Anchors are a hundredth of the rows and grow with them: they stream past the parts in blocks and are
never held whole. Of rows with equal label and vector a part keeps the first ``KEEP + 1`` by vec_id: later
ones lose every tie, so no result needs them.

Defined cases: rows with a null label, a null vector or a null or non-finite component take no part;
vectors of unequal length are compared over the components both have; rows that repeat a vec_id are rows
of their own, an anchor excludes only itself, and ties of equal vec_ids have no order that shows;
a null vec_id is no anchor and comes last among ties; an anchor without positives has no rows; an empty
table gives an empty result; extra columns are ignored. A component of 2^31 or more after scaling
raises, as does a score beyond 64 bits.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rivulet.llm.common import materialize

SCALE = 256
KEEP = 5                 # positives an anchor, and negatives a positive
CENTROIDS = 16           # of each half
SAMPLE = 8192            # rows the codebooks are fitted on
ROUNDS = 8
PART_ROWS = 1 << 18      # most rows of an index part
LEAST_ROWS = 512         # parts are not cut smaller than this to occupy idle cores
ANCHORS = 128            # anchors that walk together
STEP_ROWS = 8192         # rows scored at once
_ROW = "part int, kind int, rid long, vec_id long, label long, c1 int, c2 int, v binary, high array<long>"


# ---- codebooks -------------------------------------------------------------------

def halves(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = (v.shape[1] + 1) // 2
    return v[:, :h], v[:, h:]


def nearest(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Index of the nearest centroid of each row; ties to the smaller index."""
    return (np.square(book).sum(axis=1)[None, :] - 2.0 * (x @ book.T)).argmin(axis=1)


def fit_book(x: np.ndarray, k: int = CENTROIDS, rounds: int = ROUNDS) -> np.ndarray:
    """k-means from rows spread evenly over the sample; fewer distinct rows give fewer centroids."""
    book = np.unique(x, axis=0)
    if len(book) > k:
        book = x[np.unique(np.linspace(0, len(x) - 1, k).astype(int))].astype(float)
        for _ in range(rounds):
            at = nearest(x, book)
            size = np.bincount(at, minlength=len(book))
            sums = np.zeros_like(book)
            np.add.at(sums, at, x)
            book = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], book)
    return book


# ---- one part of the index ---------------------------------------------------------

class Cells:
    """Rows by cell with half-cluster radii; walked by the multi-sequence algorithm."""

    def __init__(self, v: np.ndarray, at: np.ndarray, c1: np.ndarray, c2: np.ndarray, books: list[np.ndarray]):
        """``v``: the part's vectors; ``at``: the rows that belong here; ``c1``, ``c2``: their half-centroids."""
        self.books = books
        k2 = len(books[1])
        cell = c1[at].astype(np.int64) * k2 + c2[at]
        self.rows = at[np.argsort(cell, kind="stable")]
        self.start = np.searchsorted(np.sort(cell), np.arange(len(books[0]) * k2 + 1))
        self.radius = []
        for x, c, book in zip(halves(v[at]), (c1[at], c2[at]), books):
            r = np.full(len(book), -np.inf)
            np.maximum.at(r, c, np.sqrt(np.square(x - book[c]).sum(axis=1)))
            self.radius.append(r * (1 + 1e-9) + 1e-6)  # above any rounding of the distances
        self.k2 = k2

    def walk(self, q: np.ndarray, state) -> Iterator[np.ndarray]:
        """Rows of the cells that some anchor of ``q`` needs, about STEP_ROWS at a time, best bounds first.

        ``state.low`` is the lowest score that still matters to each anchor and ``state.high`` the highest;
        the caller raises ``low`` between steps.
        """
        up, down, order, best = [], [], [], []
        for x, book, r in zip(halves(q), self.books, self.radius):
            mid, reach = x @ book.T, np.sqrt(np.square(x).sum(axis=1))[:, None] * np.maximum(r, 0)[None, :]
            slack = 1e-6 * (np.abs(mid) + reach) + 0.5
            up.append(np.where(r > -np.inf, mid + reach + slack, -np.inf))
            down.append(mid - reach - slack)
            top = up[-1].max(axis=0)
            order.append([i for i in np.argsort(-top, kind="stable").tolist() if r[i] > -np.inf])
            best.append(top)
        if not order[0] or not order[1]:
            return
        one, two = order
        heap, seen = [(-(best[0][one[0]] + best[1][two[0]]), 0, 0)], {(0, 0)}
        step, n = [], 0
        while heap:
            bound, i, j = heapq.heappop(heap)
            if -bound < state.low.min():
                break  # certified: no cell left can hold a score that matters
            a, b = one[i], two[j]
            s, e = self.start[a * self.k2 + b], self.start[a * self.k2 + b + 1]
            if e > s and ((up[0][:, a] + up[1][:, b] >= state.low) & (down[0][:, a] + down[1][:, b] <= state.high)).any():
                step.append(self.rows[s:e])
                n += e - s
                if n >= STEP_ROWS:
                    yield np.concatenate(step)
                    step, n = [], 0
            for p in ((i + 1, j), (i, j + 1)):
                if p[0] < len(one) and p[1] < len(two) and p not in seen:
                    seen.add(p)
                    heapq.heappush(heap, (-(best[0][one[p[0]]] + best[1][two[p[1]]]), *p))
        if step:
            yield np.concatenate(step)


def at_most(score: np.ndarray) -> np.ndarray:
    """Floats that are not above the given whole numbers (equal to them below 2^53)."""
    f = score.astype(np.float64)
    return np.where(np.abs(f) < 2**53, f, np.nextafter(f, -np.inf))


class Lists:
    """For each slot its KEEP best rows by (score descending, vec_id, row id)."""

    def __init__(self, part: Part, slots: int):
        self.part, self.fifth = part, np.full(slots, -np.inf)
        self.slot, self.row, self.score = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, slot: np.ndarray, row: np.ndarray, score: np.ndarray) -> None:
        if not len(slot):
            return
        slot, row, score = np.concatenate([self.slot, slot]), np.concatenate([self.row, row]), np.concatenate([self.score, score.astype(np.int64)])
        p = self.part
        o = np.lexsort((p.rid[row], p.vec[row], p.no_id[row], -score, slot))
        slot, row, score = slot[o], row[o], score[o]
        first = np.searchsorted(slot, slot)  # where each slot begins
        rank = np.arange(len(slot)) - first
        keep = rank < KEEP
        full = rank == KEEP - 1
        self.fifth[slot[full]] = at_most(score[full])
        self.slot, self.row, self.score = slot[keep], row[keep], score[keep]


class Part:
    """One index part: vectors, labels, ids, and cells of every label and of all rows."""

    def __init__(self, rows: pa.Table, books: list[np.ndarray], dim: int):
        self.books, self.dim = books, dim
        v = vectors(rows["v"], dim)
        self.vec, self.no_id = ids(rows["vec_id"])
        self.rid = rows["rid"].to_numpy()
        self.label = rows["label"].to_numpy()
        self.c1, self.c2 = (rows[c].to_numpy().astype(np.int64) for c in ("c1", "c2"))
        use = self._first_copies(v)
        self.norm = float(np.sqrt(np.square(v).sum(axis=1).max())) if len(v) else 0.0
        self.v = v
        self.all = Cells(v, use, self.c1, self.c2, books)
        labels = self.label[use]
        o = np.argsort(labels, kind="stable")
        cut = np.flatnonzero(np.diff(labels[o])) + 1
        self.by_label = {int(self.label[g[0]]): Cells(v, g, self.c1, self.c2, books) for g in np.split(use[o], cut) if len(g)}
        self.held: dict = {}

    def _first_copies(self, v: np.ndarray) -> np.ndarray:
        """Rows that are among the first KEEP + 1 of their label and vector."""
        _, label = np.unique(self.label, return_inverse=True)
        same = np.ascontiguousarray(np.concatenate([label[:, None], v], axis=1)).view(np.dtype((np.void, 8 * (self.dim + 1)))).ravel()
        _, group = np.unique(same, return_inverse=True)
        o = np.lexsort((self.rid, self.vec, self.no_id, group))
        g = group[o]
        return np.sort(o[np.arange(len(g)) - np.searchsorted(g, g) <= KEEP])

    def scores(self, q: np.ndarray, q_norm: float, rows: np.ndarray) -> np.ndarray:
        """Exact inner products: in the narrowest arithmetic that no partial sum can leave."""
        most = q_norm * self.norm * (1 + 1e-9)
        if most < 2**24 - 1:
            kind = np.float32
        elif most < 2**53 - 1:
            kind = np.float64
        elif most < 2**62:
            kind = np.int64
        else:
            exact = np.array(q.astype(np.int64), object) @ np.array(self.v[rows].astype(np.int64), object).T
            if exact.size and max(abs(exact.min()), abs(exact.max())) >= 2**63:
                raise OverflowError("a score passes 64 bits")
            return exact.astype(np.int64)
        if kind not in self.held:
            self.held = {kind: self.v.astype(kind)}
        return q.astype(kind) @ self.held[kind][rows].T


class Anchors:
    """A block of anchors: vectors, ids, labels and (for negatives) their positives' scores."""

    def __init__(self, rows: pa.Table, dim: int):
        self.v = vectors(rows["v"], dim)
        self.norm = float(np.sqrt(np.square(self.v).sum(axis=1).max()))
        self.rid, self.label = rows["rid"].to_numpy(), rows["label"].to_numpy()
        self.high = rows["high"].to_pylist()


class _State:
    """What a walk asks for: the lowest and highest score that matter to each anchor."""

    def __init__(self, low: np.ndarray, high: np.ndarray):
        self.low, self.high = low, high


def vectors(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    """n x dim floats from little-endian 32-bit integers; shorter ones are filled with zeros."""
    out = np.zeros((len(column), dim))
    for i, b in enumerate(column.to_pylist()):
        x = np.frombuffer(b, "<i4")
        out[i, :len(x)] = x
    return out


def ids(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(ids with 0 for null, null flags)."""
    return column.fill_null(0).to_numpy(), column.is_null().to_numpy().astype(np.int8)


def find_positives(part: Part, anchors: Anchors) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of each anchor's first KEEP other rows of its label in this part."""
    out = []
    for label in np.unique(anchors.label).tolist():
        cells = part.by_label.get(label)
        if cells is None:
            continue
        mine = np.flatnonzero(anchors.label == label)
        q = anchors.v[mine]
        lists = Lists(part, len(mine))
        state = _State(lists.fifth, np.full(len(mine), np.inf))
        for rows in cells.walk(q, state):
            s = part.scores(q, anchors.norm, rows)
            own = part.rid[rows][None, :] == anchors.rid[mine][:, None]
            if own.any():
                s = np.where(own, s.dtype.type(-(2**24)) if s.dtype == np.float32 else s.min() - 1, s)
            low = lists.fifth
            if len(rows) > KEEP + 1:  # of these rows alone only the first KEEP can enter
                low = np.maximum(low, at_most(np.partition(s, len(rows) - KEEP, axis=1)[:, len(rows) - KEEP]))
            a, r = np.nonzero((s >= low[:, None]) & ~own)
            lists.add(a, rows[r], s[a, r])
        out.append((mine[lists.slot], lists.row, lists.score))
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*out))


def find_negatives(part: Part, anchors: Anchors) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, positive, row, score) of each positive's first KEEP rows of another label in its window."""
    n = len(anchors.rid)
    # (anchor, positive) -> window: 80 * positive <= 100 * score <= 100 * positive, in whole numbers
    window = {(i, j): (-(-80 * h // 100), h) for i, hs in enumerate(anchors.high) for j, h in enumerate(hs) if h >= 0}
    least, high = np.full((n, KEEP), np.inf), np.full((n, KEEP), -np.inf)
    for at, (low, top) in window.items():
        least[at], high[at] = low, top
    wide = any(top >= 2**53 for _, top in window.values())  # floats would round: such windows are compared as integers
    if wide:
        least = np.where(least < np.inf, np.nextafter(least, -np.inf), least)
    lists = Lists(part, n * KEEP)

    def lowest() -> np.ndarray:
        return np.maximum(least, lists.fifth.reshape(n, KEEP)).min(axis=1)

    state = _State(lowest(), high.max(axis=1))
    for rows in part.all.walk(anchors.v, state):
        s = part.scores(anchors.v, anchors.norm, rows)
        a, r = np.nonzero((s >= state.low[:, None]) & (s <= state.high[:, None]) & (part.label[rows][None, :] != anchors.label[:, None]))
        found = s[a, r]
        bar = np.maximum(least, lists.fifth.reshape(n, KEEP))
        for j in range(KEEP):
            if wide:
                ok = np.array([(i, j) in window and window[i, j][0] <= int(x) <= window[i, j][1] for i, x in zip(a.tolist(), found.tolist())], bool)
            else:
                ok = (found >= bar[a, j]) & (found <= high[a, j])
            lists.add(a[ok] * KEEP + j, rows[r[ok]], found[ok])
        state.low = lowest()
    return lists.slot // KEEP, lists.slot % KEEP, lists.row, lists.score


def _walk_parts(batches: Iterator[pa.RecordBatch], books: list[np.ndarray], dim: int, negatives: bool) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (part, kind): an index part's rows (kind 0), then the anchors (kind 1) in blocks."""
    number, held, part, block = None, [], None, []

    def search():
        anchors = Anchors(pa.Table.from_batches(block), dim)
        if negatives:
            a, j, row, score = find_negatives(part, anchors)
        else:
            a, row, score = find_positives(part, anchors)
            j = np.zeros(len(a), np.int64)
        block.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(anchors.rid[a]), pa.array(j, pa.int32()), pa.array(part.vec[row], mask=part.no_id[row] > 0), pa.array(part.rid[row]),
             pa.array(score.astype(np.int64))], names=["rid", "j", "other_id", "other_rid", "score"])

    for b in batches:
        numbers, kinds = b.column("part").to_numpy(), b.column("kind").to_numpy()
        cut = np.flatnonzero(np.diff(numbers * 2 + kinds)) + 1
        for s, e in zip([0, *cut.tolist()], [*cut.tolist(), len(numbers)]):
            if s == e:
                continue
            run = b.slice(s, e - s)
            if numbers[s] != number:
                if block:
                    yield search()
                number, held, part = numbers[s], [], None
            if kinds[s] == 0:
                held.append(run)
                continue
            if not held:
                continue  # a part without rows
            if part is None:
                part = Part(pa.Table.from_batches(held), books, dim)
            for i in range(0, run.num_rows, ANCHORS):
                block.append(run.slice(i, ANCHORS))
                if sum(x.num_rows for x in block) >= ANCHORS:
                    yield search()
    if block:
        yield search()


def _coded(batches: Iterator[pa.RecordBatch], books: list[np.ndarray], dim: int) -> Iterator[pa.RecordBatch]:
    """Rows with the half-centroids of their vector."""
    for b in batches:
        one, two = halves(vectors(b.column("v"), dim))
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(nearest(one, books[0]), pa.int32()), pa.array(nearest(two, books[1]), pa.int32())],
                                         names=[*b.schema.names, "c1", "c2"])


def _scaled(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    """(vec_id, label, v) of the rows whose vector is whole, finite and not null; v as 32-bit integers."""
    for b in batches:
        out, keep = [], []
        for i, x in enumerate(b.column("x").to_pylist()):
            if x is None or any(c is None for c in x):
                continue
            w = np.floor(scale * np.array(x, np.float64))
            if not np.isfinite(w).all():
                if np.isfinite(np.array(x, np.float64)).all():
                    raise OverflowError("a component is too large")
                continue
            if len(w) and np.abs(w).max() >= 2**31:
                raise OverflowError("a component is too large")
            keep.append(i)
            out.append(w.astype("<i4").tobytes())
        rows = b.take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays([rows.column("vec_id"), rows.column("label"), pa.array(out, pa.binary())], names=["vec_id", "label", "v"])


# ---- the operator ------------------------------------------------------------------

def _pass(rows: DataFrame, anchors: DataFrame, parts: int, books: list[np.ndarray], dim: int, negatives: bool) -> DataFrame:
    """(rid, j, other_id, other_rid, score): every part's lists of every anchor."""
    names = [c.split()[0] for c in _ROW.split(", ")]
    index = rows.select(F.pmod(F.xxhash64("rid"), F.lit(parts)).cast("int").alias("part"), F.lit(0).alias("kind"), "rid", "vec_id", "label",
                        "c1", "c2", "v", F.lit(None).cast("array<long>").alias("high"))
    asked = anchors.withColumn("kind", F.lit(1)).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).select(names)
    order = ["part", "kind", "label", "c1", "c2", "rid"]
    return (index.unionByName(asked).repartitionById(parts, "part").sortWithinPartitions(*order)
            .mapInArrow(lambda it: _walk_parts(it, books, dim, negatives), "rid long, j int, other_id long, other_rid long, score long"))


def _best(found: DataFrame, *keys: str) -> DataFrame:
    """The first KEEP of each group by score, then id, with their rank."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("other_id"), "other_rid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= KEEP)


def mine(vectors_: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label",
         anchor_every: int = 100, part_rows: int = PART_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for every anchor and positive.

    Anchors are the rows whose id is divisible by ``anchor_every``. A positive's negatives are the first
    KEEP rows of another label that score between 80 and 100 per cent of it.
    """
    spark = vectors_.sparkSession
    given = vectors_.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("x"))
    rows = materialize(given.where("label is not null and x is not null").mapInArrow(
        lambda it: _scaled(it, SCALE), "vec_id long, label long, v binary").withColumn("rid", F.monotonically_increasing_id()), "vectors")
    n, width = rows.agg(F.count("*"), F.max(F.octet_length("v"))).first()
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n:
        return spark.createDataFrame([], result)
    dim = max(2, width // 4)  # two halves at least, of one component each
    sample = rows.orderBy(F.xxhash64("vec_id"), "rid").limit(SAMPLE).select("v").collect()  # at most SAMPLE rows
    books = [fit_book(x) for x in halves(vectors(pa.chunked_array([pa.array([r.v for r in sample], pa.binary())]), dim))]
    rows = materialize(rows.mapInArrow(lambda it: _coded(it, books, dim), "vec_id long, label long, v binary, rid long, c1 int, c2 int"), "coded")
    parts = max(-(-n // part_rows), min(4 * spark.sparkContext.defaultParallelism, -(-n // LEAST_ROWS)))
    anchors = rows.where(F.col("vec_id") % anchor_every == 0)
    blank = anchors.withColumn("high", F.lit(None).cast("array<long>"))
    positives = materialize(_best(_pass(rows, blank, parts, books, dim, False), "rid"), "positives")
    high = positives.groupBy("rid").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"]).alias("high"))  # KEEP at most
    negatives = _best(_pass(rows, anchors.join(high, "rid"), parts, books, dim, True), "rid", "j")
    pairs = positives.select("rid", (F.col("rank") - 1).alias("j"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (negatives.select("rid", "j", "rank", F.col("other_id").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(pairs, ["rid", "j"]).join(anchors.select("rid", F.col("vec_id").alias("anchor_id")), "rid")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def shifted_labels(vectors_: DataFrame) -> DataFrame:
    """``vec_id, embedding, label`` with label (label + 1) % 10 where vec_id is divisible by 7."""
    label = F.col("label").cast("long")
    return vectors_.select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"))
