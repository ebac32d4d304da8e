"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact similarity.

Texts are words (A-Z and accented Latin-1 folded, other ASCII signs separate)
and five-word shingles; an item with fewer words is one shingle. For an item of
L words, every window of L words of a document (or the whole document, where it
is shorter) that holds a shingle of a benchmark item is fingerprinted; other
windows share no shingle with any item, so their similarity is 0.

A window has two fingerprints of 128 SimHash bits, with independent votes: in
one a shingle votes as often as it occurs, in the other once. A repeated shingle
can swamp the first, rare extra shingles weigh more in the second. Each is cut
into eight 16-bit blocks, and items are stored under all values within three
bits of each of their blocks, so any fingerprint within ``RADIUS`` = 31 bits
meets its item in some block (31 = 8 * 3 + 7). Only windows that meet an item
within the radius, by either fingerprint, are candidates. They are verified by
the exact weighted Jaccard similarity of the shingle multisets (sum of minimum
over sum of maximum counts), which comes for all candidate windows of a document
and item at once from the places where shared shingles enter and leave them.

Two sets at similarity 0.8 lie 19 of 128 bits apart on average, with a standard
deviation of 4: each fingerprint loses about 0.2 % of such windows, both lose it
in about 4 of a million cases; tests measure the recall against all windows.

The items are written as small files, each the index of ``MAX_INDEX_BYTES`` of
item text; a task builds an index when a text first shares a shingle with it and
holds the last ``HELD``. One pass over the documents serves any benchmark;
documents never move.

Defined cases: null or empty texts match nothing, null items are skipped;
repeated rows give repeated result rows; of equally similar windows the one with
the smaller Hamming distance, then the first, is reported; an empty benchmark
leaves every document; item ids of any type are carried; extra columns are kept
by ``decontaminate``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.llm import textvec
from rivulet.llm.common import bound_batches, shared_path, worker_cache

WORDS = 5
THRESHOLD = 0.8
BLOCKS, RADIUS = 8, 31
_NEAR = RADIUS // BLOCKS  # bits by which the nearest block may differ
MAX_INDEX_BYTES = 256 << 10
HELD = 8       # built indexes a worker keeps
STARTS = 2048  # windows fingerprinted at once
_FLIPS = np.array([sum(1 << b for b in c) for k in range(_NEAR + 1) for c in combinations(range(16), k)], np.uint16)
_SIGNS = np.array([1, -1], np.int8)
_FAMILIES = np.array([0x5851F42D4C957F2D, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], np.uint64)  # ours: any four numbers


def signs(shingles: np.ndarray, family: int) -> np.ndarray:
    """SimHash votes of shingles: n x 128 of +1 and -1; the two families are independent."""
    two = np.stack([textvec.mix(shingles ^ f) for f in _FAMILIES[2 * family:2 * family + 2]], axis=1)
    bits = np.unpackbits(two.view(np.uint8).reshape(len(shingles), 16), axis=1)
    return _SIGNS[bits]


def pack(votes: np.ndarray) -> np.ndarray:
    """n x 128 vote sums to n x 8 blocks of 16 bits."""
    return np.packbits(votes > 0, axis=1).view(np.uint16)


class Item:
    """One benchmark item: words, shingle counts, two fingerprints."""

    def __init__(self, hashes: np.ndarray):
        self.n = len(hashes)
        self.width = min(WORDS, self.n)
        self.shingles, self.counts = np.unique(shingle_run(hashes, self.width), return_counts=True)
        weighted = (signs(self.shingles, 0) * self.counts[:, None]).sum(axis=0, dtype=np.int32)
        self.prints = [pack(weighted[None, :])[0], pack(signs(self.shingles, 1).sum(axis=0, dtype=np.int32)[None, :])[0]]


def shingle_run(hashes: np.ndarray, width: int) -> np.ndarray:
    """Shingles of ``width`` words; shorter widths than five are kept apart from others by the width."""
    sh = textvec.shingles(hashes, width)[:len(hashes) - width + 1]
    return sh if width == WORDS else sh ^ np.uint64(width)


def merged(starts: np.ndarray, stops: np.ndarray) -> Iterator[tuple[int, int]]:
    """Unions of the intervals [start, stop), which are sorted by start."""
    top = np.maximum.accumulate(stops)
    cut = np.flatnonzero(starts[1:] > top[:-1]) + 1
    for a, z in zip([0, *cut.tolist()], [*cut.tolist(), len(starts)]):
        yield int(starts[a]), int(top[z - 1])


class Index:
    """Items by length with the Hamming blocks of their fingerprints, and all their shingles."""

    def __init__(self, texts: pa.Array):
        h, off, _, _ = textvec.words(texts, textvec.alnum_table(), latin1=True)
        self.rows = np.flatnonzero(np.diff(off) > 0)  # row of each item among the texts
        self.items = [Item(h[off[i]:off[i + 1]]) for i in self.rows.tolist()]
        self.owners: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))  # width -> shingle -> items
        self.by_length = defaultdict(list)
        for i, it in enumerate(self.items):
            self.by_length[it.n].append(i)
            for s in it.shingles.tolist():
                self.owners[it.width][s].append(i)
        self.known = {w: np.array(sorted(o), np.uint64) for w, o in self.owners.items()}
        self.maybe = {}
        for w, k in self.known.items():
            self.maybe[w] = np.zeros(1 << 20, bool)
            self.maybe[w][(k >> np.uint64(44)).astype(np.int64)] = True
        self.tables: dict[tuple[int, int], list] = {}

    def _table(self, length: int, which: int) -> list:
        """Per block (sorted values, items) of one fingerprint of the items of a length."""
        if (length, which) not in self.tables:
            at = np.array(self.by_length[length], np.int32)
            prints = np.stack([self.items[i].prints[which] for i in at])
            blocks = []
            for j in range(BLOCKS):
                values = (prints[:, j][:, None] ^ _FLIPS[None, :]).ravel()
                o = np.argsort(values, kind="stable")
                blocks.append((values[o], np.repeat(at, len(_FLIPS))[o]))
            self.tables[length, which] = blocks
        return self.tables[length, which]

    def hits(self, sh: np.ndarray, width: int) -> np.ndarray:
        """Positions whose shingle belongs to some item."""
        at = np.flatnonzero(self.maybe[width][(sh >> np.uint64(44)).astype(np.int64)])
        k = self.known[width]
        x = np.minimum(np.searchsorted(k, sh[at]), len(k) - 1)
        return at[k[x] == sh[at]]

    def near(self, prints: np.ndarray, length: int, which: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, distance) of all windows and items whose fingerprints are within the radius."""
        pairs = []
        for j, (values, owner) in enumerate(self._table(length, which)):
            lo, hi = np.searchsorted(values, prints[:, j], "left"), np.searchsorted(values, prints[:, j], "right")
            n = hi - lo
            window = np.repeat(np.arange(len(prints)), n)
            item = owner[np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]
            pairs.append(window * np.int64(len(self.items)) + item)
        pairs = np.unique(np.concatenate(pairs))
        window, item = pairs // len(self.items), pairs % len(self.items)
        mine = np.stack([self.items[i].prints[which] for i in self.by_length[length]])
        row = np.searchsorted(np.array(self.by_length[length]), item)
        distance = np.bitwise_count(prints[window] ^ mine[row]).sum(axis=1).astype(np.int64)
        keep = distance <= RADIUS
        return window[keep], item[keep], distance[keep]

    def search(self, h: np.ndarray, off: np.ndarray, shingles: dict) -> Iterator[tuple[int, int, int, int, int, float]]:
        """(text, item, first word, words, distance, similarity): the best verified window of each text and item.

        ``shingles``: the texts' shingles by width, shared by the indexes of a benchmark.
        """
        if not len(h):
            return
        for width in self.owners:
            if len(h) < width:
                continue
            if width not in shingles:
                sh = textvec.shingles(h, width)
                shingles[width] = sh if width == WORDS else sh ^ np.uint64(width)
            sh = shingles[width]
            at = self.hits(sh, width)
            doc = np.searchsorted(off, at, "right") - 1
            ok = at + width <= off[doc + 1]
            at, doc = at[ok], doc[ok]
            cut = np.flatnonzero(np.diff(doc)) + 1
            for places in np.split(at, cut):
                if len(places):
                    d = int(np.searchsorted(off, places[0], "right")) - 1
                    yield from self._text(d, sh, places, int(off[d]), int(off[d + 1]), width)

    def _text(self, d: int, sh: np.ndarray, places: np.ndarray, a: int, z: int, width: int):
        """Results of one text, words ``a`` to ``z``; ``places``: where it shares a shingle with an item."""
        shared = defaultdict(list)  # item -> places of its shingles
        lengths = defaultdict(list)  # item length -> places of shingles of such items
        values, back = np.unique(sh[places], return_inverse=True)
        order = np.argsort(back, kind="stable")
        for value, group in zip(values.tolist(), np.split(places[order], np.cumsum(np.bincount(back))[:-1])):
            owners = self.owners[width][value]
            for i in owners:
                shared[i].append(group)
            for n in {self.items[i].n for i in owners}:
                lengths[n].append(group)
        best = {}
        for n, groups in lengths.items():
            ps = np.sort(np.concatenate(groups))
            size = min(n, z - a)
            found = defaultdict(list)  # item -> (starts, distances)
            first = np.clip(ps - (size - width), a, z - size)
            for lo, hi in merged(first, np.clip(ps, a, z - size) + 1):
                for c in range(lo, hi, STARTS):
                    e = min(hi, c + STARTS)
                    for which in (0, 1):
                        window, item, distance = self.near(self._prints(sh, c, e, size - width + 1, which), n, which)
                        for i in np.unique(item).tolist():
                            mine = item == i
                            found[i].append((c + window[mine], distance[mine]))
            for i, parts in found.items():
                if i not in shared:  # near by chance: no shingle in common
                    continue
                starts, distances = (np.concatenate(x) for x in zip(*parts))
                sims = self._similarities(sh, np.sort(np.concatenate(shared[i])), i, starts, a, z, size, width)
                o = np.lexsort((starts, distances, -sims))[0]
                if sims[o] >= THRESHOLD:
                    best[i] = (int(starts[o]) - a, size, int(distances[o]), float(sims[o]))
        for i in sorted(best):
            yield d, i, *best[i]

    def _similarities(self, sh, ps, i, starts, a, z, size, width) -> np.ndarray:
        """Exact similarity of the windows at ``starts`` to item ``i``, whose shingles lie at ``ps``.

        Of a shingle that the item holds c times, an occurrence counts in the windows that hold it
        but not its c-th predecessor; the sum over the occurrences is the size of the intersection.
        """
        it, k = self.items[i], size - width + 1
        total = k + int(it.counts.sum())
        x = np.searchsorted(it.shingles, sh[ps])
        order = np.argsort(x, kind="stable")
        x, p = x[order], ps[order]
        before = np.arange(len(p)) - it.counts[x]
        full = (before >= 0) & (x[np.maximum(before, 0)] == x)
        lo, hi = np.maximum(p - k + 1, a), np.minimum(p, z - size)
        lo[full] = np.maximum(lo[full], p[before[full]] + 1)
        ok = lo <= hi
        # windows that an occurrence has begun to count in, less those it has ceased to count in
        common = np.searchsorted(np.sort(lo[ok]), starts, "right") - np.searchsorted(np.sort(hi[ok] + 1), starts, "right")
        return common / (total - common)

    @staticmethod
    def _prints(sh: np.ndarray, first: int, last: int, k: int, which: int) -> np.ndarray:
        """Fingerprints of the windows of k shingles that start at ``first`` to ``last`` (excluded)."""
        run = sh[first:last - 1 + k]
        votes = signs(run, which).astype(np.int32)
        sums = np.concatenate([np.zeros((1, 128), np.int32), np.cumsum(votes, axis=0, dtype=np.int32)])
        out = sums[k:] - sums[:-k]
        if which:  # a shingle votes once: take back the votes of occurrences with an earlier one in the window
            order = np.argsort(run, kind="stable")
            again = np.flatnonzero(run[order][1:] == run[order][:-1])
            p, q = order[again + 1], order[again]  # an occurrence and the one before it
            close = p - q < k
            p, q = p[close], q[close]
            if len(p):
                back = np.zeros((last - first + 1, 128), np.int32)
                lo, hi = np.maximum(p - k + 1, 0), np.minimum(q, last - first - 1)
                keep = lo <= hi
                np.add.at(back, lo[keep], votes[p[keep]])
                np.subtract.at(back, hi[keep] + 1, votes[p[keep]])
                out = out - np.cumsum(back, axis=0, dtype=np.int32)[:-1]
        return pack(out)


class Benchmark:
    """The items' files, and the indexes that a worker has built of them."""

    def __init__(self, files: list[str]):
        self.files = files
        self.held: dict[str, tuple[Index, pa.Array]] = {}

    def indexes(self) -> Iterator[tuple[Index, pa.Array]]:
        """(index, ids of the rows) of every file; the last HELD stay in memory."""
        from pyarrow import fs, parquet

        for uri in self.files:
            if uri not in self.held:
                files, path = fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri.removeprefix("file:"))
                items = parquet.read_table(path, filesystem=files, partitioning=None).combine_chunks()
                while len(self.held) >= HELD:
                    self.held.pop(next(iter(self.held)))
                self.held[uri] = (Index(items.column("text").combine_chunks()), items.column("item_id").combine_chunks())
            yield self.held[uri]

    def search(self, column: pa.Array) -> Iterator[tuple[pa.Array, list[tuple]]]:
        """(ids, results) of every index for a column of texts."""
        h, off, _, _ = textvec.words(column, textvec.alnum_table(), latin1=True)
        shingles: dict = {}
        for index, ids in self.indexes():
            got = list(index.search(h, off, shingles))
            if got:
                yield ids.take(pa.array(index.rows[[g[1] for g in got]])), got


def write_items(benchmark: DataFrame, limit: int = MAX_INDEX_BYTES) -> list[str]:
    """Files of about ``limit`` bytes of items in the shared folder: (item_id, text), nulls left out."""
    spark = benchmark.sparkSession
    b = benchmark.select("item_id", "text").where("text is not null")
    total = b.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    root = shared_path(spark, "benchmark")
    n = max(1, -(-total // limit))
    b.repartition(n, F.xxhash64("item_id", "text")).sortWithinPartitions("item_id", "text").write.parquet(root)
    return sorted(r[0] for r in spark.read.parquet(root).select(F.input_file_name()).distinct().collect())  # a row per file


def _benchmark(files: list[str]) -> Benchmark:
    """This worker's benchmark; the one it last worked on is kept."""
    held = worker_cache()
    if "benchmark" not in held or held["benchmark"].files != files:
        held["benchmark"] = Benchmark(files)
    return held["benchmark"]


def _matches(batches: Iterator[pa.RecordBatch], files: list[str], text: str) -> Iterator[pa.RecordBatch]:
    bench = _benchmark(files)
    for b in batches:
        for part in textvec.slices(b, text):
            for ids, got in bench.search(part.column(text)):
                docs = part.column("doc_id").take(pa.array([g[0] for g in got], pa.int64()))
                cols = [ids, pa.array([g[2] for g in got], pa.int64()), pa.array([g[3] for g in got], pa.int32()),
                        pa.array([g[4] for g in got], pa.int32()), pa.array([g[5] for g in got], pa.float64())]
                yield pa.RecordBatch.from_arrays([docs, *cols], names=["doc_id", "item_id", "start_word", "n_words", "hamming", "similarity"])


def _clean(batches: Iterator[pa.RecordBatch], files: list[str], text: str) -> Iterator[pa.RecordBatch]:
    bench = _benchmark(files)
    for b in batches:
        for part in textvec.slices(b, text):
            keep = np.ones(part.num_rows, bool)
            for _, got in bench.search(part.column(text)):
                keep[[g[0] for g in got]] = False
            yield part.filter(pa.array(keep))


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, item_id, start_word, n_words, hamming, similarity): the best window of each document and item."""
    bound_batches(docs.sparkSession)
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("item_id", benchmark.schema["item_id"].dataType),
        T.StructField("start_word", T.LongType()), T.StructField("n_words", T.IntegerType()),
        T.StructField("hamming", T.IntegerType()), T.StructField("similarity", T.DoubleType())])
    files = write_items(benchmark)
    return docs.select("doc_id", text).mapInArrow(lambda it: _matches(it, files, text), schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; all columns, no shuffle."""
    bound_batches(docs.sparkSession)
    files = write_items(benchmark)
    return docs.mapInArrow(lambda it: _clean(it, files, text), docs.schema)
