"""N-gram Jaccard join with signature trees, exact, as connected components.

A document is the set of its distinct k-word shingles (64-bit hashes; fewer
words: the whole sequence as one). Documents with equal sets are one node.

1. Blocks. Shingles have one global order: by hash, the most frequent ones last
   (a Misra-Gries list over all documents decides which; any order is correct).
   Two linked sets share a shingle within the first n - ceil(t n) + 1 of the
   larger and the first n - ceil(2t/(1+t) n) + 1 of the smaller, so every
   shingle of those prefixes is a block. Rows without a neighbour of fitting
   size in their block leave at once.
2. Signature trees over each block's bitmaps. A tree node holds the OR of its
   members' token bitmaps, their size range and their largest bitmap excess. A
   dual traversal drops node pairs whose maximum possible overlap is too small.
   Pairs that survive connect nodes into candidate components; pairs already
   connected are skipped, so a block never emits more than a forest.
3. Signature trees over each candidate component, now with the exact sets at
   the leaves: surviving pairs are verified by intersection. In larger
   components the sets with too few members in common with all others together
   leave first, and the traversal ends at nodes of up to PACK sets, whose
   overlaps are counted together: frequent shingles by a product of 0/1
   matrices, the others by their pairs of rows. Components too large for one
   task are cut into chunks that share hub members; only nodes left outside a
   component's main class then meet all its chunks. No cap, no pair list.

Blocks of the most frequent shingles (hit only by sets that consist mostly of
such shingles) are joined through hubs per size class instead of a tree, which
may only enlarge candidate components; step 3 stays exact.

Defined cases: null and empty texts, and texts without words, have size 0, link
with nothing and are their own component; repeated rows and equal texts share
a component; null ids rank below all others only if a component has no other
id; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rivulet.llm import textvec
from rivulet.llm.common import bound_batches, materialize
from rivulet.llm.components import connected_components

COUNTERS = 4096      # Misra-Gries counters of a task
HEAVY = 16384        # frequent shingles that are ordered last (affects speed only)
HEAVY_LEAST = 128    # estimated occurrences from which a shingle can be one of them
CHUNK = 4_000_000    # shingles of one step-3 task
HUBS = 16
FANOUT = 8
FEW = 24             # sets of a step-3 block from which overlaps are counted by packs
PACK = 512           # sets of a pack,
PACK_SHINGLES = 1 << 19  # and their shingles together
DENSE = 1500         # pairs of rows from which a shingle is a matrix column
_COLUMNS, _PAIRS = 2048, 1 << 19  # counted at once
FILTER_BITS = 27     # at most 16 MB of id filter are broadcast
_SEEN = 1 << 20


def _need(total: int, percent: int) -> int:
    """Smallest overlap of two sets with ``total`` members together: ceil(t / (1 + t) * total)."""
    return -(-percent * total // (100 + percent))


# ---- signature trees ---------------------------------------------------------

class Leaf:
    """One set: size, bitmap (an int of ``width`` bits) and, in step 3, its sorted shingles."""

    __slots__ = ("key", "n", "width", "bits", "half", "excess", "half_excess", "shingles", "low", "high", "kids", "first", "one", "count", "total", "pack")

    def __init__(self, key: int, n: int, bitmap: bytes, shingles: np.ndarray | None = None):
        self.key, self.n, self.width, self.shingles = key, n, len(bitmap) * 8, shingles
        self.bits = int.from_bytes(bitmap, "little")
        h = self.width // 2
        self.half = (self.bits | self.bits >> h) & ((1 << h) - 1)
        self.excess, self.half_excess = n - self.bits.bit_count(), n - self.half.bit_count()
        self.low = self.high = n
        self.kids, self.first, self.one = (), key, True
        self.count, self.total, self.pack = 1, n, None


class Node:
    """OR of the members' bitmaps, their size range and the largest bitmap excess; in step 3 its pack, where it is one."""

    __slots__ = ("width", "bits", "half", "excess", "half_excess", "low", "high", "kids", "first", "one", "count", "total", "pack")

    def __init__(self, kids: list):
        self.kids, self.width, self.first, self.one = kids, kids[0].width, kids[0].first, False
        self.bits = self.half = 0
        for k in kids:
            self.bits |= k.bits
            self.half |= k.half
        self.excess, self.half_excess = max(k.excess for k in kids), max(k.half_excess for k in kids)
        self.low, self.high = min(k.low for k in kids), max(k.high for k in kids)
        self.count, self.total, self.pack = sum(k.count for k in kids), sum(k.total for k in kids), None


def build_trees(leaves: list[Leaf]) -> list:
    """One tree per bitmap width, members in order of size."""
    roots = []
    for _, level in groupby(sorted(leaves, key=lambda x: (x.width, x.n, x.key)), key=lambda x: x.width):
        level = list(level)
        while len(level) > 1:
            level = [Node(level[i:i + FANOUT]) if len(level[i:i + FANOUT]) > 1 else level[i] for i in range(0, len(level), FANOUT)]
        roots += level
    return roots


class Classes:
    """Union-find over node keys."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        r = x
        while (p := up.get(r, r)) != r:
            r = p
        while (p := up.get(x, x)) != r:
            up[x] = r
            x = p
        return r

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def stars(self) -> Iterator[tuple[int, int]]:
        for x in list(self.up):
            r = self.find(x)
            if r != x:
                yield x, r


def most_overlap(x, y) -> int:
    """Upper bound of the overlap of any member of x with any member of y."""
    if x.width == y.width:
        common, ex, ey = (x.bits & y.bits).bit_count(), x.excess, y.excess
    elif x.width == 2 * y.width:
        common, ex, ey = (x.half & y.bits).bit_count(), x.half_excess, y.excess
    elif y.width == 2 * x.width:
        common, ex, ey = (x.bits & y.half).bit_count(), x.excess, y.half_excess
    else:
        common, ex, ey = min(x.high, y.high), 0, 0
    return min(x.high, y.high, common + min(ex, ey))


def _uniform(node, classes: Classes) -> bool:
    """All members in one class; once true, it stays true."""
    if not node.one:
        r = classes.find(node.first)
        node.one = all(_uniform(k, classes) and classes.find(k.first) == r for k in node.kids)
    return node.one


def traverse(left: list, right: list | None, classes: Classes, percent: int, verify, meet=None) -> None:
    """Dual traversal: joins the classes of all pairs (left x right, or within left) that pass ``verify``.

    With ``meet`` it ends at nodes that are packs: meet(x, y) joins the classes of the linked pairs of two of them.
    """
    if right is None:
        stack = [(left[j], left[i]) for i in range(len(left)) for j in range(i)] + [(x, x) for x in left]
    else:
        stack = [(x, y) for x in left for y in right]
    while stack:
        x, y = stack.pop()
        if x is y:
            if not x.kids or _uniform(x, classes):
                continue
            if meet and _is_pack(x):
                meet(x, x)
                continue
            kids = x.kids
            stack += [(kids[i], kids[j]) for i in range(len(kids)) for j in range(i + 1, len(kids))]
            stack += [(k, k) for k in kids]
            continue
        if x.high * 100 < percent * y.low or y.high * 100 < percent * x.low:
            continue
        if most_overlap(x, y) < _need(x.low + y.low, percent):
            continue
        if _uniform(x, classes) and _uniform(y, classes) and classes.find(x.first) == classes.find(y.first):
            continue
        if meet and _is_pack(x) and _is_pack(y):
            meet(x, y)
        elif not x.kids and not y.kids:
            if verify(x, y):
                classes.join(x.key, y.key)
        elif meet and x.kids and _is_pack(y) and not _is_pack(x):
            stack += [(k, y) for k in x.kids]
        elif meet and y.kids and _is_pack(x) and not _is_pack(y):
            stack += [(x, k) for k in y.kids]
        elif x.kids and (not y.kids or x.high - x.low >= y.high - y.low):
            stack += [(k, y) for k in x.kids]
        else:
            stack += [(x, k) for k in y.kids]


def linked(x: Leaf, y: Leaf, percent: int) -> bool:
    """Exact: 100 * intersection >= percent * union."""
    a, b = (x.shingles, y.shingles) if x.n <= y.n else (y.shingles, x.shingles)
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    common = int((b[at] == a).sum())
    return 100 * common >= percent * (x.n + y.n - common)


# ---- overlaps of packs ---------------------------------------------------------

def _is_pack(x) -> bool:
    """Small enough for one pack; a single set always is."""
    return not x.kids or (x.count <= PACK and x.total <= PACK_SHINGLES)


class Pack:
    """The sets under a tree node by shingle: of shingle i, the rows ``row[at[i]:at[i] + k[i]]`` hold it."""

    def __init__(self, node):
        leaves, stack = [], [node]
        while stack:
            x = stack.pop()
            stack += x.kids
            if not x.kids:
                leaves.append(x)
        self.keys = [x.key for x in leaves]
        self.n = np.array([x.n for x in leaves], np.int64)
        every = np.concatenate([x.shingles for x in leaves])
        order = np.argsort(every, kind="stable")
        self.row = np.repeat(np.arange(len(leaves), dtype=np.int32), self.n)[order]
        every = every[order]
        at = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
        self.shingle, self.at, self.k = every[at], at.astype(np.int32), np.diff(np.r_[at, len(every)]).astype(np.int32)


def _spans(at: np.ndarray, k: np.ndarray) -> np.ndarray:
    """at[0], at[0] + 1, ... (k[0] of them), at[1], ..."""
    return np.repeat(at - np.cumsum(k, dtype=np.int64) + k, k) + np.arange(int(k.sum()))


def _parts(size: np.ndarray, limit: int) -> Iterator[slice]:
    """Runs of about ``limit`` in all, one element at least."""
    total, a = np.cumsum(size), 0
    while a < len(size):
        z = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + limit, "right")))
        yield slice(a, z)
        a = z


def overlaps(x: Pack, y: Pack) -> np.ndarray:
    """Size of the intersection of every set of x with every set of y."""
    at = np.minimum(np.searchsorted(y.shingle, x.shingle), len(y.shingle) - 1)
    i = np.flatnonzero(y.shingle[at] == x.shingle)
    xa, xk, ya, yk = x.at[i], x.k[i], y.at[at[i]], y.k[at[i]]
    nx, ny = len(x.n), len(y.n)
    out = np.zeros((nx, ny), np.int64)
    pairs = xk * yk
    dense = np.flatnonzero(pairs >= DENSE)
    for c in range(0, len(dense), _COLUMNS):
        d = dense[c:c + _COLUMNS]
        one, two = np.zeros((nx, len(d)), np.float32), np.zeros((ny, len(d)), np.float32)
        one[x.row[_spans(xa[d], xk[d])], np.repeat(np.arange(len(d)), xk[d])] = 1
        two[y.row[_spans(ya[d], yk[d])], np.repeat(np.arange(len(d)), yk[d])] = 1
        out += (one @ two.T).astype(np.int64)
    thin = np.flatnonzero(pairs < DENSE)
    for part in _parts(pairs[thin], _PAIRS):
        d = thin[part]
        mine = _spans(xa[d], xk[d])
        many = np.repeat(yk[d], xk[d])
        code = np.repeat(x.row[mine], many) * ny + y.row[_spans(np.repeat(ya[d], xk[d]), many)]
        out += np.bincount(code, minlength=nx * ny).reshape(nx, ny)
    return out


def meet_packs(x, y, classes: Classes, percent: int) -> None:
    """Joins the classes of all linked pairs of sets under x and y."""
    for z in (x, y):
        if z.pack is None:
            z.pack = Pack(z)
    p, q = x.pack, y.pack
    common = overlaps(p, q)
    link = 100 * common >= percent * (p.n[:, None] + q.n[None, :] - common)
    own, other = np.arange(len(p.n)), np.arange(len(q.n)) + (0 if x is y else len(p.n))
    top = len(p.n) + len(q.n)
    while True:  # each set's least neighbour's label, until none changes
        was = own, other
        own = np.minimum(own, np.where(link, other[None, :], top).min(axis=1))
        other = own if x is y else np.minimum(other, np.where(link, own[:, None], top).min(axis=0))
        if (own == was[0]).all() and (other == was[1]).all():
            break
    keys = p.keys if x is y else p.keys + q.keys
    for i, r in enumerate((own if x is y else np.concatenate([own, other])).tolist()):
        if i != r:
            classes.join(keys[i], keys[r])


def linkable(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of the distinct sets have enough members in common with the others together; the rest link with none.

    A few rounds, as a set that leaves takes members from others; none of the left out is linked, whenever it stops.
    """
    n = np.array([len(s) for s in sets], np.int64)
    need = -(-percent * n // 100)
    every = np.concatenate(sets)
    at, known = np.empty(len(every), np.int32), 0
    for part in range(8):  # an eighth of the shingles at a time
        mine = np.flatnonzero(every & np.uint64(7) == part)
        values, place = np.unique(every[mine], return_inverse=True)
        at[mine] = place + known
        known += len(values)
    owner = np.repeat(np.arange(len(sets), dtype=np.int32), n)
    alive = np.ones(len(sets), bool)
    for _ in range(8):
        shared = np.bincount(at)[at] > 1
        keep = np.bincount(owner[shared], minlength=len(sets)) >= need
        gone = int((alive & ~keep).sum())
        alive &= keep
        if not alive.any() or gone * 64 <= int(alive.sum()):
            break
        stay = alive[owner]
        at, owner = at[stay], owner[stay]
    return alive


def bitmap(shingles: np.ndarray) -> bytes:
    """Token bitmap of a power-of-two width, half to once the set's size (64 bits at least).

    It holds one fixed quarter of all shingles (by hash); a set's other shingles
    count as excess, so the overlap bound stays an upper bound.
    """
    width = max(64, 1 << ((len(shingles) - 1) // 2).bit_length())
    bits = np.zeros(width, np.uint8)
    part = shingles[shingles >> np.uint64(40) & np.uint64(3) == 0]
    bits[(part & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


# ---- per-document passes -------------------------------------------------------

def _frequent(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Misra-Gries summary of a task's shingle occurrences."""
    table = textvec.ascii_space_table()
    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for b in batches:
        for part in textvec.slices(b, "text"):
            h, off, _, _ = textvec.words(part.column("text"), table)
            sh, n = np.unique(textvec.shingles(h, k)[:max(0, len(h) - k + 1)], return_counts=True)
            again = n > 1  # single occurrences of a slice would not survive the decrement below
            both = np.concatenate([keys, sh[again]])
            weight = np.concatenate([counts, n[again]])
            keys, at = np.unique(both, return_inverse=True)
            counts = np.bincount(at, weight, len(keys)).astype(np.int64)
            if len(keys) > COUNTERS:
                counts -= np.partition(counts, len(counts) - COUNTERS - 1)[len(counts) - COUNTERS - 1]
                keys, counts = keys[counts > 0], counts[counts > 0]
    yield pa.RecordBatch.from_pydict({"token": pa.array(keys.view(np.int64)), "low": pa.array(counts)})


def frequent_shingles(docs: DataFrame, k: int) -> np.ndarray:
    """At most HEAVY shingles, sorted; only the order of prefixes depends on them."""
    rows = (docs.mapInArrow(lambda it: _frequent(it, k), "token long, low long").groupBy("token").agg(F.sum("low").alias("low"))
            .where(F.col("low") >= HEAVY_LEAST).orderBy(F.desc("low"), "token").limit(HEAVY).collect())
    return np.sort(np.array([r["token"] for r in rows], np.int64).view(np.uint64))


def digest(shingles: np.ndarray) -> int:
    """Identity of a set: 63 bits of a digest of its sorted members."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little") >> 1


def _sketches(batches: Iterator[pa.RecordBatch], k: int, percent: int, heavy: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(doc_id, print, n, node, prefix, ordinary, bitmap); the last three only at a node's first sight in the task."""
    table = textvec.ascii_space_table()
    maybe = np.zeros(1 << 20, bool)
    maybe[(heavy >> np.uint64(44)).astype(np.int64)] = True
    seen: set[int] = set()
    for b in batches:
        for part in textvec.slices(b, "text"):
            n, node, prefix, ordinary, bits = [], [], [], [], []
            for s in textvec.shingle_sets(part.column("text"), table, k):
                d = digest(s) if len(s) else None
                n.append(len(s))
                node.append(d)
                if d is None or d in seen:
                    prefix.append(None), ordinary.append(None), bits.append(None)
                    continue
                if len(seen) >= _SEEN:
                    seen.clear()
                seen.add(d)
                often = maybe[(s >> np.uint64(44)).astype(np.int64)]
                if often.any():
                    x = s[often]
                    often[often] = heavy[np.minimum(np.searchsorted(heavy, x), len(heavy) - 1)] == x
                p = len(s) - -(-percent * len(s) // 100) + 1
                order = np.concatenate([s[~often], s[often]])[:p]
                prefix.append(order.view(np.int64))
                ordinary.append(min(p, int((~often).sum())))
                bits.append(bitmap(s))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("print"), pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(prefix, pa.list_(pa.int64())),
                 pa.array(ordinary, pa.int32()), pa.array(bits, pa.binary())],
                names=["doc_id", "print", "n", "node", "prefix", "ordinary", "bitmap"])


def _filter_places(x: np.ndarray, bits: int) -> np.ndarray:
    return (textvec.mix(x.view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def node_filter(nodes: DataFrame) -> tuple[np.ndarray, int]:
    """A bit per hashed node (64 or more bits a node up to 2^FILTER_BITS); false positives only cost time."""
    count = nodes.count()
    bits = min(FILTER_BITS, max(15, (64 * count).bit_length()))

    def places(it):
        for b in it:
            yield pa.RecordBatch.from_pydict({"at": pa.array(_filter_places(b.column(0).to_numpy(zero_copy_only=False), bits))})

    rows = (nodes.select("node").mapInArrow(places, "at long").groupBy(F.shiftright("at", 15).alias("block"))
            .agg(F.bitmap_construct_agg(F.col("at") % 32768).alias("bits")).collect())
    out = np.zeros(1 << (bits - 3), np.uint8)
    for r in rows:
        out[r["block"] * 4096:(r["block"] + 1) * 4096] = np.frombuffer(r["bits"], np.uint8)
    return out, bits


def _sets(batches: Iterator[pa.RecordBatch], k: int, wanted: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """(node, n, shingles) of the texts with wanted prints, once a task."""
    table = textvec.ascii_space_table()
    seen: set[int] = set()
    for b in batches:
        at = _filter_places(b.column("print").to_numpy(zero_copy_only=False), bits)
        hit = (wanted[at >> 3] >> (at & 7).astype(np.uint8)) & 1
        for part in textvec.slices(b.filter(pa.array(hit == 1)), "text"):
            sets = [s for s in textvec.shingle_sets(part.column("text"), table, k) if len(s)]
            node = np.array([digest(s) for s in sets], np.int64)
            out = []
            for i, d in enumerate(node.tolist()):
                if d not in seen:
                    if len(seen) >= _SEEN:
                        seen.clear()
                    seen.add(d)
                    out.append(i)
            yield pa.RecordBatch.from_pydict({"node": pa.array(node[out]), "n": pa.array([len(sets[i]) for i in out], pa.int64()),
                                              "shingles": pa.array([sets[i].tobytes() for i in out], pa.binary())})


# ---- trees inside tasks --------------------------------------------------------

def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[list[dict]]:
    """Rows of equal ``key`` of a partition sorted by it."""
    held: list[dict] = []
    for b in batches:
        for _, rows in groupby(b.to_pylist(), key=lambda r: r[key]):
            rows = list(rows)
            if held and held[0][key] != rows[0][key]:
                yield held
                held = []
            held += rows
    if held:
        yield held


def _edges(classes: Classes) -> Iterator[pa.RecordBatch]:
    stars = list(classes.stars())
    for i in range(0, len(stars), 50000):
        part = stars[i:i + 50000]
        yield pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in part], pa.int64()), "b": pa.array([b for _, b in part], pa.int64())})


def _candidate_links(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Forest of the pairs that a block's signature trees cannot exclude."""
    classes = Classes()
    for rows in _groups(batches, "token"):
        traverse(build_trees([Leaf(r["node"], r["n"], r["bitmap"]) for r in rows]), None, classes, percent, lambda x, y: True)
    yield from _edges(classes)


def _true_links(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Forest of the verified pairs of each block: within it, or of outsiders against members."""
    classes = Classes()
    for rows in _groups(batches, "block"):
        sets: dict[int, np.ndarray] = {}
        sides: dict[tuple, None] = {}
        for r in rows:
            sets.setdefault(r["node"], np.frombuffer(r["shingles"], np.uint64))
            sides[r["node"], r["outside"]] = None
            if r["label"] is not None:
                classes.join(r["node"], r["label"])
        meet = None
        if len(sets) > FEW:
            meet = lambda x, y: meet_packs(x, y, classes, percent)
            sets = {d: s for (d, s), stays in zip(sets.items(), linkable(list(sets.values()), percent)) if stays}
        leaves = {(d, o): Leaf(d, len(sets[d]), bitmap(sets[d]), sets[d]) for d, o in sides if d in sets}
        test = lambda x, y: x.key != y.key and linked(x, y, percent)
        if rows[0]["grid"]:
            out = [x for (_, o), x in leaves.items() if o]
            all_ = [x for (_, o), x in leaves.items() if not o]
            traverse(build_trees(out), build_trees(all_), classes, percent, test, meet)
        else:
            traverse(build_trees(list(leaves.values())), None, classes, percent, test, meet)
    yield from _edges(classes)


def _verify(sets: DataFrame, blocks: DataFrame, percent: int) -> DataFrame:
    """Verified forest edges of (node, block, outside, grid, label) rows."""
    n = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = sets.join(blocks, "node").repartition(n, "block").sortWithinPartitions("block", "node")
    return rows.select("block", "node", "n", "shingles", "outside", "grid", "label").mapInArrow(
        lambda it: _true_links(it, percent), "a long, b long")


# ---- the join ------------------------------------------------------------------

def _size_class(n: Column) -> Column:
    """Sizes in steps of one per cent."""
    return F.floor(F.log(n.cast("double")) / F.lit(float(np.log(1.01)))).cast("long")


def _fitting(batches: Iterator[pa.RecordBatch], steps: int) -> Iterator[pa.RecordBatch]:
    """Rows (x, rid) sorted by x = block << 16 | size class << 1 | index flag: those with a partner of fitting size.

    A pair fits if its classes are at most ``steps`` apart and the smaller set
    (either, in one class) has the block's shingle in its index prefix.
    """
    carry = None
    done = False
    batches = iter(batches)
    while not done:
        b = next(batches, None)
        done = b is None
        if done:
            if carry is None:
                return
            x, rid = carry
        else:
            x, rid = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            if carry is not None:
                x, rid = np.concatenate([carry[0], x]), np.concatenate([carry[1], rid])
            if not len(x):
                continue
            end = int(np.searchsorted(x >> 16, x[-1] >> 16))  # the last block may go on in the next batch
            carry, x, rid = (x[end:], rid[end:]), x[:end], rid[:end]
        if not len(x):
            continue
        cls = x >> 1  # block and size class
        first = np.flatnonzero(np.r_[True, cls[1:] != cls[:-1]])
        size = np.diff(np.r_[first, len(x)])
        key, index = cls[first], np.maximum.reduceat(x & 1, first) == 1
        block = key >> 15
        more = np.zeros(len(key), bool)  # a larger class of the block fits
        more[:-1] = (block[1:] == block[:-1]) & (key[1:] - key[:-1] <= steps)
        last = np.maximum.accumulate(np.where(index, np.arange(len(key)), -1))  # nearest class up to this one with an index row
        before = np.r_[-1, last[:-1]]
        at = np.maximum(before, 0)
        under = (before >= 0) & (block[at] == block) & (key - key[at] <= steps)
        several = size > 1
        whole = under | (several & index)  # every row of the class has an index partner that is not larger
        each = np.repeat(np.arange(len(key)), size)
        keep = whole[each] | ((x & 1 == 1) & (more | several)[each])
        yield pa.RecordBatch.from_pydict({"token": pa.array(x[keep] >> 16), "rid": pa.array(rid[keep])})


def _candidates(nodes: DataFrame, percent: int) -> DataFrame:
    """Candidate edges (a, b) of row ids from signature trees over the prefix blocks."""
    t = percent
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = nodes.select("rid", "n", "ordinary", F.posexplode("prefix").alias("pos", "token"))
    short = F.expr(f"n - ({2 * t} * n + {100 + t - 1}) div {100 + t} + 1")  # index prefix of the smaller set
    # the rows of the largest shuffle are two numbers: 48 bits of the shingle (shared ones only add candidates),
    # 15 of the size class, the index flag; and the row id
    x = F.shiftleft(F.col("token"), 16).bitwiseOR(F.shiftleft(_size_class(F.col("n")), 1)).bitwiseOR((F.col("pos") < short).cast("long"))
    rows = each.where(F.col("pos") < F.col("ordinary")).select(x.alias("x"), "rid")
    steps = int(np.ceil(np.log(100 / t) / np.log(1.01))) + 1
    light = (rows.repartition(parts, F.shiftright("x", 16)).sortWithinPartitions("x")
             .mapInArrow(lambda it: _fitting(it, steps), "token long, rid long"))
    full = light.join(nodes.select("rid", "n", "bitmap"), "rid").repartition(parts, "token").sortWithinPartitions("token")
    trees = full.select("token", F.col("rid").alias("node"), "n", "bitmap").mapInArrow(lambda it: _candidate_links(it, t), "a long, b long")
    # blocks of frequent shingles: hubs per size class; fitting sizes are in one class or in neighbours
    size = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(100 / t)))).cast("long")
    hot = each.where(F.col("pos") >= F.col("ordinary")).select("token", "rid", size.alias("class"))
    hubs = hot.groupBy("token", "class").agg(F.min("rid").alias("hub"))
    star = hot.join(hubs, ["token", "class"]).select(F.col("rid").alias("a"), F.col("hub").alias("b"))
    chain = hubs.alias("x").join(hubs.select("token", (F.col("class") - 1).alias("class"), F.col("hub").alias("next")), ["token", "class"])
    return trees.unionByName(star).unionByName(chain.select(F.col("hub").alias("a"), F.col("next").alias("b"))).where("a <> b")


def jaccard_components(docs: DataFrame, k: int = 4, percent: int = 85, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text)."""
    bound_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("print"))
    heavy = frequent_shingles(docs.select("text"), k)
    key = dict(docs.dtypes)["doc_id"]
    sketch = materialize(docs.mapInArrow(
        lambda it: _sketches(it, k, percent, heavy),
        f"doc_id {key}, print long, n long, node long, prefix array<long>, ordinary int, bitmap binary")
        .withColumn("rid", F.monotonically_increasing_id()), "sketches")
    # a node that several tasks saw first: one of its rows stays (only ids move)
    seen = sketch.where("prefix is not null")
    twice = seen.groupBy("node").agg(F.min("rid").alias("keep"), F.count("*").alias("k")).where("k > 1").select("node", "keep")
    losers = materialize(seen.select("node", "rid").join(twice, "node").where("rid <> keep").select("rid"), "losers")
    nodes = seen.join(losers, "rid", "left_anti").drop("doc_id")
    near = connected_components(_candidates(nodes, percent), "candidates").withColumnRenamed("node", "rid")
    members = materialize(near.join(nodes.select("rid", "print", "node", "n"), "rid").drop("rid"), "members")
    labels = _components(docs, members, k, percent, chunk)
    # smallest doc_id of every component, through the (few) nodes
    first = sketch.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("low"))
    named = first.join(labels, "node", "left").withColumn("c", F.coalesce("component", "node"))
    ids = named.join(named.groupBy("c").agg(F.min("low").alias("component_id")), "c").select("node", "component_id")
    return sketch.select("doc_id", "n", "node").join(ids, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def _components(docs: DataFrame, members: DataFrame, k: int, percent: int, chunk: int) -> DataFrame:
    """(node, component) of the verified links among candidate components."""
    wanted, bits = node_filter(members.select(F.col("print").alias("node")))
    members = members.drop("print")
    sets = docs.select("print", "text").mapInArrow(lambda it: _sets(it, k, wanted, bits), "node long, n long, shingles binary")
    sizes = members.groupBy("component").agg(F.ceil(F.sum("n") / chunk).cast("int").alias("chunks"))
    rows = materialize(members.join(sizes, "component"), "chunks")
    large = rows.where("chunks > 1")
    plain = lambda df: df.select("node", "block", F.lit(False).alias("outside"), F.lit(False).alias("grid"), F.lit(None).cast("long").alias("label"))
    own = rows.select("node", F.concat_ws("/", "component", F.pmod(F.xxhash64("node"), F.col("chunks"))).alias("block"))
    if large.isEmpty():
        return connected_components(_verify(sets, plain(own), percent), "links")
    sets = materialize(sets, "sets")  # read in two rounds
    # hubs: the members with the smallest hashes of a large component meet every chunk
    rank = Window.partitionBy("component").orderBy("node")
    hubs = (large.withColumn("r", F.row_number().over(rank)).where(F.col("r") <= HUBS)
            .select("node", "component", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("c"))
            .select("node", F.concat_ws("/", "component", "c").alias("block")))
    edges = materialize(_verify(sets, plain(own.unionByName(hubs).distinct()), percent), "links1")
    labels = connected_components(edges, "links1").withColumnRenamed("component", "label")
    # what is outside the main class of a large component meets all its chunks
    put = materialize(large.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "labelled")
    count = put.groupBy("component", "label").agg(F.count("*").alias("size"))
    main = count.groupBy("component").agg(F.max(F.struct("size", "label")).alias("m")).select("component", F.col("m.label").alias("main"))
    put = put.join(main, "component")
    out = put.where("label <> main")
    parts = out.groupBy("component").agg(F.ceil(F.sum("n") / chunk).cast("int").alias("parts"))
    grid = put.join(parts, "component")
    mine = F.pmod(F.xxhash64("node", F.lit(2)), F.col("parts"))
    outer = grid.where("label <> main").select("node", "component", "label", mine.alias("i"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("j"), F.lit(True).alias("outside"))
    inner = grid.select("node", "component", "label", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("i"), F.pmod(F.xxhash64("node"), F.col("chunks")).alias("j"), F.lit(False).alias("outside"))
    blocks = outer.unionByName(inner.select(outer.columns)).select(
        "node", F.concat_ws("/", "component", "i", "j").alias("block"), "outside", F.lit(True).alias("grid"), "label")
    return connected_components(edges.unionByName(_verify(sets, blocks, percent)), "links")
