"""Operator 13 against plain Python counts."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from rivulet.llm import phrases as ph

SCHEMA = "doc_id long, text string, lang string"


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute(rows, least, top, longest=5):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for k in range(1, longest + 1):
                f[lang or "und"].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        dropped = {q for p, a in found.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                   if (q := p[i:j]) != p and 100 * a >= 100 * found[q]}
        scored = []
        for p, a in found.items():
            if p not in dropped:
                s, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                scored.append((" ".join(p), a, counts[p[:k]], counts[p[k:]], n[lang], s))
        scored.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        out += [(lang, i, *x) for i, x in enumerate(scored[:top], 1)]
    return sorted(out)


def corpus(seed, n=400):
    r = random.Random(seed)
    words = ["the", "The", "of", "x1", "é", "É", "a-b", "\x00", " nb", "中", "q"] + [f"w{i}" for i in range(40)]
    fixed = ["new york city hall", "of the", "x1 x1 x1", "w1 w2 w3 w4 w5 w6 w7", "a-b é"]
    seps = [" "] * 12 + ["\t", "  ", ". ", ", ", "\n", "\x0b", "!?", " ; ", ":"]
    def text():
        return "".join((r.choice(fixed) if r.random() < 0.3 else r.choice(words)) + r.choice(seps) for _ in range(r.randint(0, 60)))
    return [(text(), r.choice(["en", "en", "fr", None, "und"])) for _ in range(n)] + [(None, "en"), ("", "fr"), ("...", "de"), ("alone", "de")]


def got(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, c, "x", 1) for i, (t, c) in enumerate(rows)], SCHEMA + ", h string, f int")
    return sorted(tuple(r) for r in ph.collocations(df, **kw).collect())


@pytest.mark.parametrize("head", [ph.HEAD, 40, 3])
def test_equals_brute_force(spark, head):
    rows = corpus(1) + [("over and over " * 30, "en")] * 3
    want = brute(rows, 12, 40)
    assert got(spark, rows, least=12, top=40, head=head) == want
    assert {len(x[2].split(" ")) for x in want} >= {2, 3, 4, 5}


def test_small_buffers_and_tiles(spark, monkeypatch):
    rows = corpus(2)
    for name, value in [("BUCKET_BITS", 8), ("BUCKET_BLOCK", 64), ("TILE", 8), ("DENSE_FROM", 4), ("DENSE_TILES", 3), ("BUFFER", 50), ("ENTRIES", 20)]:
        monkeypatch.setattr(ph, name, value)
    assert got(spark, rows, least=10, top=2000) == brute(rows, 10, 2000)


def test_ties_at_the_limit_and_empty_tables(spark):
    rows = [(f"{a} {b}", "en") for a, b in ["ab", "cd", "ef", "gh", "zé", "za"] for _ in range(5)]
    assert got(spark, rows, least=5, top=4) == brute(rows, 5, 4)
    assert got(spark, [], least=5) == []
    assert got(spark, [("one two three", "en")], least=5) == []
    assert got(spark, [("word", "en")] * 9, least=5) == []


def test_another_salt_where_hashes_meet(spark, monkeypatch):
    real = ph._hashed  # noqa: SLF001
    def clash(batches, salt):
        for b in real(batches, salt):
            yield b if salt > 7 else b.set_column(3, "h", ph.pa.array(np.zeros(b.num_rows, np.int64)))
    monkeypatch.setattr(ph, "_hashed", clash)
    words = spark.createDataFrame([("en", "a", 200), ("en", "b", 1), ("fr", "a", 3)], "lang string, word string, f long")
    found, salt = ph.hash_words(words, 100)
    assert salt == 8 and [(r.lang, r.word) for r in found.collect()] == [("en", "a")]


def test_tiles_count_every_pair(monkeypatch):
    monkeypatch.setattr(ph, "DENSE_FROM", 100)
    monkeypatch.setattr(ph, "BUFFER", 3000)
    r = np.random.default_rng(1)
    left, right = (np.minimum(r.zipf(1.3, 20000), 30000).astype(np.int64) for _ in range(2))
    tiles = ph.Tiles()
    codes = ph.pair_keys(left, right)
    for part in np.array_split(codes, 17):
        tiles.add(part)
    assert tiles.dense
    total = Counter()
    for c, n in tiles.take():
        for x, k in zip(c.tolist(), n.tolist()):
            total[x] += k
    assert total == Counter(codes.tolist())
    assert list(tiles.take()) == []
