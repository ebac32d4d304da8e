"""Operator 1 against brute force over all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from rivulet.llm import jaccard_join as J
from rivulet.llm.components import connected_components

_LOW = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, k):
    w = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().translate(_LOW))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k, percent):
    sets = [(i, shingle_set(t, k)) for i, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            s, t = sets[a][1], sets[b][1]
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                up[find(a)] = find(b)
    low = {}
    for a in range(len(rows)):
        low.setdefault(find(a), []).append(rows[a][0])
    low = {r: min((x for x in ids if x is not None), default=None) for r, ids in low.items()}
    return sorted(((rows[a][0], len(sets[a][1]), low[find(a)]) for a in range(len(rows))), key=str)


def corpus(seed=5, groups=25, copies=8):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    common = " ".join(r.choice(words) for _ in range(30))
    rows, n = [], 0
    for _ in range(groups):
        base = [r.choice(words) for _ in range(r.choice([3, 6, 25, 60, 200]))]
        for _ in range(r.randint(1, copies)):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 4])):
                w[r.randrange(len(w))] = r.choice(words)
            text = " ".join(w)
            rows.append((n, r.choice([text, text.upper(), "\t" + text + "\n", text + " " + common, common + " " + text])))
            n += 1
    return rows


def run(spark, rows, k=4, percent=85, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(map(tuple, J.jaccard_components(df, k, percent, **kw).collect()), key=str)


@pytest.mark.parametrize("k,percent,chunk,heavy", [(4, 85, J.CHUNK, 128), (5, 80, J.CHUNK, 3), (4, 85, 300, 128), (4, 60, 300, 3)])
def test_equals_brute_force(spark, monkeypatch, k, percent, chunk, heavy):
    monkeypatch.setattr(J, "HEAVY_LEAST", heavy)
    monkeypatch.setattr(J, "HUBS", 2)
    rows = corpus()
    assert run(spark, rows, k, percent, chunk=chunk) == brute(rows, k, percent)


def test_chain_of_near_copies_in_small_chunks(spark, monkeypatch):
    """A long chain, each text linked to the next only, cut into many chunks."""
    monkeypatch.setattr(J, "HUBS", 1)
    words = [f"v{i}" for i in range(1000)]
    rows = [(i, " ".join(words[4 * i:4 * i + 80])) for i in range(40)]
    got = run(spark, rows, 4, 85, chunk=400)
    assert got == brute(rows, 4, 85)
    assert {c for _, _, c in got} == {0}


def test_odd_rows(spark):
    rows = [(3, None), (4, ""), (5, " \t\r\n"), (6, "one two"), (6, "one two"), (7, "ONE  two"), (None, "one two"), (8, "two one"),
            (9, "a b c d e f g"), (10, "a b c d e f g"), (11, "x" * 200000), (12, "é è " * 3000)]
    assert run(spark, rows) == brute(rows, 4, 85)
    assert run(spark, []) == []


def test_clashing_columns_are_ignored(spark):
    df = spark.createDataFrame([(1, "a b c d e", 7, "z"), (2, "a b c d e", 8, "z")], "doc_id long, text string, node long, component_id string")
    assert sorted(map(tuple, J.jaccard_components(df).collect())) == [(1, 2, 1), (2, 2, 1)]


def test_signature_tree_bound_never_below_overlap():
    r = np.random.default_rng(2)
    sets = [np.unique(r.integers(0, 2000, r.integers(1, 300)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in range(60)]
    leaves = [J.Leaf(i, len(s), J.bitmap(s), s) for i, s in enumerate(sets)]
    for x in leaves:
        for y in leaves:
            assert J.most_overlap(x, y) >= len(np.intersect1d(x.shingles, y.shingles))
    for tree in J.build_trees(leaves):
        stack = [tree]
        while stack:
            node = stack.pop()
            for k in node.kids:
                assert node.low <= k.low and node.high >= k.high and node.bits & k.bits == k.bits
                for y in leaves:
                    assert J.most_overlap(node, y) >= J.most_overlap(k, y) - 0 or y.width not in (node.width, 2 * node.width, node.width // 2)
                stack.append(k)


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (103, 101), (200, 200)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 103: 100}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def family(seed, members, size=120, changes=0.5):
    """Sets that share a core, each with 0 to ``changes`` of its members taken from a small or a large pool."""
    r = np.random.default_rng(seed)
    core = r.integers(0, 2**63, size).astype(np.uint64)
    small = r.integers(0, 2**63, 300).astype(np.uint64)
    out = []
    for _ in range(members):
        s = core.copy()
        other = r.random(size) < r.random() * changes
        s[other] = np.where(r.random(int(other.sum())) < 0.5, r.choice(small, int(other.sum())), r.integers(0, 2**63, int(other.sum())).astype(np.uint64))
        out.append(np.unique(s[:r.integers(size // 2, size + 1)] if r.random() < 0.2 else s))
    return out


def block(sets, outside=None):
    rows = [{"block": "b", "node": i, "n": len(s), "shingles": s.tobytes(), "outside": o, "grid": outside is not None, "label": None}
            for o in ([False] if outside is None else [False, True]) for i, s in enumerate(sets) if not o or i in outside]
    schema = pa.schema([("block", pa.string()), ("node", pa.int64()), ("n", pa.int64()), ("shingles", pa.binary()), ("outside", pa.bool_()),
                        ("grid", pa.bool_()), ("label", pa.int64())])
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def classes_of(batches, sets):
    c = J.Classes()
    for b in batches:
        for a, z in zip(b["a"].to_pylist(), b["b"].to_pylist()):
            c.join(a, z)
    return [c.find(i) for i in range(len(sets))]


def brute_classes(sets, percent, wanted=lambda a, b: True):
    c = J.Classes()
    for a in range(len(sets)):
        for b in range(a):
            common = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            if wanted(a, b) and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                c.join(a, b)
    return [c.find(i) for i in range(len(sets))]


def test_large_component_is_not_verified_pair_by_pair(monkeypatch):
    """Copies of one text, many of them too much changed to be linked: no intersection of single pairs."""
    calls = []
    single = J.linked
    monkeypatch.setattr(J, "linked", lambda x, y, percent: calls.append(1) or single(x, y, percent))
    sets = family(1, 250)
    got = classes_of(J._true_links(iter([block(sets)]), 80), sets)
    assert got == brute_classes(sets, 80)
    assert 20 < len(set(got)) < 230
    assert len(calls) < len(sets)


@pytest.mark.parametrize("grid", [False, True])
def test_packs_of_any_size_equal_brute_force(monkeypatch, grid):
    for name, value in {"FEW": 3, "PACK": 9, "PACK_SHINGLES": 700, "DENSE": 6, "_COLUMNS": 5, "_PAIRS": 40}.items():
        monkeypatch.setattr(J, name, value)
    lone = [np.array([7], np.uint64), np.array([7], np.uint64), np.arange(3, dtype=np.uint64)]
    sets = family(2, 40) + family(3, 30, size=20) + family(4, 20, size=400, changes=0.3) + lone[:1] + lone[2:]
    outside = set(range(0, len(sets), 3)) if grid else None
    got = classes_of(J._true_links(iter([block(sets, outside)]), 70), sets)
    assert got == brute_classes(sets, 70, lambda a, b: not grid or a in outside or b in outside)


def test_overlaps_are_exact():
    sets = family(5, 60) + family(6, 50, size=30)
    x, y = (J.Node([J.Leaf(i, len(s), J.bitmap(s), s) for i, s in part]) for part in (list(enumerate(sets))[:70], list(enumerate(sets))[40:]))
    p, q = J.Pack(x), J.Pack(y)
    want = [[len(np.intersect1d(sets[a], sets[b])) for b in q.keys] for a in p.keys]
    assert J.overlaps(p, q).tolist() == want


def test_sets_that_leave_before_the_trees_have_no_link():
    sets = family(7, 120) + family(8, 60, size=15)
    for percent in (60, 80, 100):
        alive = J.linkable(sets, percent)
        classes = brute_classes(sets, percent)
        assert all(alive[i] or classes.count(classes[i]) == 1 for i in range(len(sets)))
        assert not alive.all()


def test_texts_of_equal_words_with_other_prints(spark):
    """Texts that differ in case only are one node; the row whose text is read for it stands for the others."""
    base = [" ".join(f"w{i}_{j}" for j in range(40)) for i in range(3)]
    rows = [(i, t) for i, t in enumerate([base[0], base[0].upper(), base[0] + " x", base[1], base[1].title(), base[2], base[2] + "\n", None])]
    assert run(spark, rows) == brute(rows, 4, 85)
