"""Operators 4, 6, 8 and 9: brute force, generated truth and held-out accuracy."""

import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF001
from pyspark.sql import functions as F

from rivulet.llm import decontamination as D
from rivulet.llm import html_dom, html_extraction, language_id, textvec, toxicity

DOCS = "doc_id long, text string"


# ---- word and shingle hashing --------------------------------------------------------

def test_words_equal_a_plain_split(monkeypatch):
    monkeypatch.setattr(textvec, "SLICE_BYTES", 64)  # also exercise the cuts of long texts
    r = random.Random(1)
    rows = [None, "", "  ", "A b\tC\x0b", "é É x"] + ["".join(r.choice("aB \té\n\x00.-") for _ in range(r.randint(0, 400))) for _ in range(60)]
    col = pa.array(rows)
    h, off, s, e = textvec.words(col, textvec.ascii_space_table())
    raw, offsets = textvec.texts(col)
    seen = {}
    for i, t in enumerate(rows):
        low = bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode())
        want = re.findall(rb"[^\x20\x09-\x0d]+", low)
        got = [bytes(c + 32 if 65 <= c <= 90 else c for c in raw[a:b].tobytes()) for a, b in zip(s[off[i]:off[i + 1]], e[off[i]:off[i + 1]])]
        assert got == want
        for w, x in zip(want, h[off[i]:off[i + 1]].tolist()):
            assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


def test_slices_cover_every_row_once():
    col = pa.array([None, "a" * 10, "", "b" * 100, "c", "d" * 3])
    batch = pa.RecordBatch.from_arrays([col, pa.array(range(6))], names=["text", "i"])
    parts = list(textvec.slices(batch, "text", 12))
    assert [i for p in parts for i in p.column("i").to_pylist()] == list(range(6)) and len(parts) > 2


# ---- 4 decontamination ---------------------------------------------------------------

def plain_words(t):
    t = "".join(c.lower() if "A" <= c <= "Z" or "À" <= c <= "Þ" and c != "×" else c for c in t or "")
    return re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", t)


def counts(w, k):
    out = {}
    for i in range(len(w) - k + 1):
        out[tuple(w[i:i + k])] = out.get(tuple(w[i:i + k]), 0) + 1
    return out


def brute_similarity(text, item):
    """Best weighted Jaccard of an item-sized window, over all windows."""
    w, v = plain_words(text), plain_words(item)
    k = min(5, len(v))
    if not v or len(w) < k:
        return 0.0
    size, b, best = min(len(v), len(w)), counts(v, k), 0.0
    for s in range(len(w) - size + 1):
        a = counts(w[s:s + size], k)
        low = sum(min(n, b.get(x, 0)) for x, n in a.items())
        best = max(best, low / (sum(a.values()) + sum(b.values()) - low))
    return best


def decontamination_rows(seed=2):
    r = random.Random(seed)
    words = [f"word{i}" for i in range(300)]
    items = [(i, " ".join(r.choices(words, k=r.choice([2, 4, 5, 6, 12, 25, 60])))) for i in range(25)]
    rows = []
    for n in range(140):
        w = r.choices(words, k=r.randint(0, 120))
        if n % 2:
            v = r.choice(items)[1].split()
            for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
                at = r.randrange(len(v))
                r.choice([lambda: v.__setitem__(at, r.choice(words)), lambda: v.insert(at, r.choice(words)), lambda: v.pop(at) if len(v) > 2 else None])()
            at = r.randint(0, len(w))
            w[at:at] = v
        sep = r.choice([" ", "  ", ", ", "*** ", "\n"])
        rows.append((n, sep.join(w).upper() if n % 5 == 0 else sep.join(w)))
    return items, rows


def test_contamination_equals_brute_force(spark):
    items, rows = decontamination_rows()
    rows += [(500, None), (501, ""), (502, "x " * 40000 + items[6][1])]
    got = {(r.doc_id, r.item_id): r for r in D.find_contamination(
        spark.createDataFrame([(*x, 1, "c") for x in rows], DOCS + ", item_id int, similarity string"),
        spark.createDataFrame([*items, (99, None), (98, "")], "item_id long, text string")).collect()}
    text, item = dict(rows), dict(items)
    want = {(d, i): s for d in text for i in item if d != 502 or i == 6 if (s := brute_similarity(text[d], item[i]) if d != 502 else 1.0) >= 0.8}
    near = {k for k, s in want.items() if s >= 0.8}
    assert set(got) - {k for k in got if k[0] == 502} == near - {(502, 6)} and (502, 6) in got
    for k, r in got.items():
        if k[0] != 502:
            assert abs(r.similarity - want[k]) < 1e-9 and r.hamming <= D.RADIUS


def test_long_items_with_repeated_words_are_found(spark):
    r = random.Random(9)
    words = [f"word{i}" for i in range(5000)]
    items, rows = [], []
    for n, size in enumerate([40, 100, 150, 200, 300]):
        v = r.choices(words, k=size)
        items.append((n, " ".join(v)))
        keep = size * 8 // 9 + 2
        rows.append((n, " ".join(v[:keep] + ["rep"] * (size - keep))))  # one shingle swamps the fingerprint
        rows.append((100 + n, " ".join(r.choices(words, k=70) + v[:keep] + ["rep"] * 300)))
        rows.append((200 + n, " ".join(v[:size // 2] + ["rep"] * (size - size // 2))))
    run = ["rep"] * 30
    items.append((50, " ".join(r.choices(words, k=60) + run + r.choices(words, k=60))))
    v = items[-1][1].split()
    rows += [(300, " ".join(v[:75] + v[80:])), (301, " ".join(v[:70] + run[:8] + v[70:])), (302, " ".join(run * 20))]
    text, item = dict(rows), dict(items)
    want = {(d, i): s for d in text for i in item if (s := brute_similarity(text[d], item[i])) >= 0.8}
    got = {(x.doc_id, x.item_id): x for x in D.find_contamination(spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert set(got) == set(want) and len(want) >= 10 and max(x.hamming for x in got.values()) <= D.RADIUS
    assert all(x.similarity <= want[k] + 1e-9 for k, x in got.items())


def test_recall_of_the_fingerprints_alone():
    """Windows of 20 to 300 words at similarity 0.8 and a little more, with scattered changes and with repeated runs."""
    r = random.Random(12)
    words = [f"word{i}" for i in range(20000)]
    hit = total = 0
    for size in (20, 45, 90, 150, 300):
        for n in range(60):
            v = r.choices(words, k=size)
            index = D.Index(pa.array([" ".join(v)]))
            w = list(v)
            if n % 3:
                while True:  # scattered changes, as many as leave the similarity at 0.8
                    x = list(w)
                    x[r.randrange(size)] = r.choice(words)
                    if brute_similarity(" ".join(x), " ".join(v)) < 0.8:
                        break
                    w = x
            else:
                keep = size * 8 // 9 + 2
                w = v[:keep] + ["rep"] * (size - keep)
            text = " ".join(r.choices(words, k=50) + w + r.choices(words, k=50))
            if brute_similarity(text, " ".join(v)) >= 0.8:
                h, off, _, _ = textvec.words(pa.array([text]), textvec.alnum_table(), latin1=True)
                total += 1
                hit += len(list(index.search(h, off, {})))
    assert total >= 280 and hit >= 0.99 * total


def test_the_multi_index_decides(monkeypatch):
    index = D.Index(pa.array([" ".join(f"q{i}" for i in range(30))]))
    h, off, _, _ = textvec.words(pa.array([" ".join(f"q{i}" for i in range(30))]), textvec.alnum_table(), latin1=True)
    assert [(g[0], g[1], g[5]) for g in index.search(h, off, {})] == [(0, 0, 1.0)]
    z = np.zeros(0, np.int64)
    monkeypatch.setattr(D.Index, "near", lambda self, prints, length, which: (z, z, z))
    assert list(index.search(h, off, {})) == []


def test_a_very_long_text_of_repeated_item_words():
    import tracemalloc

    item = " ".join(f"q{i}" for i in range(300))
    index = D.Index(pa.array([item]))
    h, off, _, _ = textvec.words(pa.array([(item + " ") * 300]), textvec.alnum_table(), latin1=True)  # 90,000 words
    tracemalloc.start()
    got = list(index.search(h, off, {}))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got[0][2:4] == (0, 300) and got[0][5] == 1.0 and peak < 100 << 20


def test_item_ids_of_any_type_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g", "x"), (2, "other words", "y"), (3, None, "z")], DOCS + ", item_id string")
    bench = spark.createDataFrame([("first", "a b c d e f g", 1), ("none", None, 2), (None, "other words", 3)], "item_id string, text string, doc_id long")
    got = sorted((x.doc_id, x.item_id, x.similarity) for x in D.find_contamination(docs, bench).collect())
    assert got == [(1, "first", 1.0), (2, None, 1.0)]
    assert [tuple(x) for x in D.decontaminate(docs, bench).collect()] == [(3, None, "z")]


def test_multi_index_finds_every_fingerprint_within_the_radius():
    r = random.Random(4)
    index = D.Index(pa.array([" ".join(f"q{r.randint(0, 99)}" for _ in range(12)) for i in range(30)]))
    for i, it in enumerate(index.items):
        for which in (0, 1):
            for _ in range(20):
                bits = np.unpackbits(it.prints[which].view(np.uint8))
                flip = r.sample(range(128), r.randint(0, D.RADIUS))
                bits[flip] ^= 1
                _, items, distances = index.near(np.packbits(bits).view(np.uint16)[None, :], it.n, which)
                assert (i, len(flip)) in set(zip(items.tolist(), distances.tolist()))


def test_the_second_fingerprint_counts_a_shingle_once():
    r = np.random.default_rng(1)
    sh = r.integers(0, 12, 90).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in (1, 7, 40):
        got = D.Index._prints(sh, 3, 45, k, 1)  # noqa: SLF001
        want = [D.pack(D.signs(np.unique(sh[s:s + k]), 1).sum(axis=0, dtype=np.int32)[None, :])[0] for s in range(3, 45)]
        assert np.array_equal(got, np.array(want))


def test_decontaminate_keeps_columns_and_clean_rows(spark, monkeypatch):
    items, rows = decontamination_rows(7)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], DOCS + ", n_words string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    bad = {r.doc_id for r in D.find_contamination(docs, bench).collect()}
    out = D.decontaminate(docs, bench)
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == {i for i, _ in rows} - bad
    monkeypatch.setattr(D, "write_items", lambda b, real=D.write_items: real(b, 300))  # several index files
    monkeypatch.setattr(D, "HELD", 2)
    assert {r.doc_id for r in D.find_contamination(docs, bench).collect()} == bad
    assert D.decontaminate(docs, bench.limit(0)).count() == len(rows) and D.find_contamination(docs.limit(0), bench).count() == 0


# ---- 6 extraction --------------------------------------------------------------------

@pytest.fixture(scope="module")
def forest(spark):
    return html_extraction.train(spark.read.parquet(f"{SF001}/pages.parquet"))


def truth(page):
    dom = html_dom.Dom(page)
    label = list(dom.label)
    for i in range(1, len(label)):
        label[i] = label[i] if label[i] is not None else label[dom.parent[i]]
    return " ".join(t for k, t in zip(dom.run_node, dom.run_text) if label[k] == "1")


def test_extraction_on_unseen_layouts(forest):
    gen = html_extraction.Layouts([f"mot{i}" for i in range(500)], seed=999)
    f1 = []
    for _ in range(150):
        page = gen.page()
        got, want = set(html_extraction.main_text(page, forest).split()), set(truth(page).split())
        f1.append(2 * len(got & want) / max(1, len(got) + len(want)))
    assert np.mean(f1) > 0.93


def test_extraction_of_the_corpus_pages(spark, forest):
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    import html

    good = 0
    got = html_extraction.extract(pages, forest).collect()
    for r in got:
        body = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"</?(?:p|h1)>|<br>", " ", body).replace("<b>", "").replace("</b>", "")).split())
        good += r.text == want and r.n_chars == len(want)
    assert good >= 0.97 * len(got)


def test_extraction_edges(spark, forest):
    odd = [None, "", "   ", "plain &amp; simple", "<p>un<b>closed", "</div></p>stray", "<script>var a='<p>'", "<!-- open", "<p class='x>quote", "< 5 & > 3",
           "<div>" * 3000 + "deep", "<article><p>" + "long words, and more. " * 20000 + "</p></article>"]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(odd)], "page_id long, html string")
    got = {r.page_id: r for r in html_extraction.extract(df, forest).collect()}
    assert [got[i].text for i in range(4)] == ["", "", "", "plain & simple"]
    assert all(r.n_chars == len(r.text) for r in got.values()) and len(got) == len(odd)
    assert got[11].n_chars == len(("long words, and more. " * 20000).strip())
    assert html_extraction.extract(df.limit(0), forest).count() == 0


def test_decoding_has_no_contradictions(forest):
    """What lies below a dropped node is never kept."""
    page = '<body><div class="content"><p>Aa bb, cc.</p></div><div class="comments"><div class="content"><p>Long comment, with words. And more.</p></div></div></body>'
    dom = html_dom.Dom(page)
    p = np.full(len(dom.tag), 0.5)
    p[[i for i, t in enumerate(dom.tag) if t == "div"]] = [0.99, 1e-4, 0.3]
    assert html_dom.decode(dom, p) == "Aa bb, cc."


# ---- 8 toxicity ----------------------------------------------------------------------

def test_toxicity_held_out(spark):
    r = random.Random(9)
    calm, bad = [f"calm{i}" for i in range(200)], ["grubnaf", "zlokkid"]
    rows = []
    for i in range(900):
        y = int(r.random() < 0.15)
        w = r.choices(calm, k=r.randint(5, 200))
        if y:
            w.insert(r.randrange(len(w)), r.choice(bad) + r.choice(["", "s", "ly"]))
        rows.append((i, " ".join(w), y))
    docs = spark.createDataFrame([x[:2] for x in rows], DOCS)
    labels = spark.createDataFrame([(i, y, 1) for i, _, y in rows if i % 3] + [(5000, None, 1), (None, 1, 1)], "doc_id long, toxic int, quality int")
    model = toxicity.train(docs, labels)
    got = {x.doc_id: x for x in toxicity.score(docs, model).collect()}
    held = [(got[i].predicted, y) for i, _, y in rows if i % 3 == 0]
    assert sum(p == y for p, y in held) / len(held) > 0.97
    assert all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.3) for x in got.values())


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "a" * 500000, "x"), (3, "a" * 500000, "x"), (4, "ok", "x")], DOCS + ", toxic string")
    none = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    got = toxicity.score(docs, none).collect()
    assert len(got) == 5 and all(x.predicted == 0 for x in got) and "toxic" in got[0].asDict()
    one = toxicity.train(docs, spark.createDataFrame([(4, 1), (4, 0)], "doc_id long, toxic int"))
    assert all(x.predicted == 1 for x in toxicity.score(docs, one).collect())
    assert toxicity.score(docs.limit(0), none).count() == 0


# ---- 9 language ID -------------------------------------------------------------------

@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    return language_id.train(docs.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0).select("doc_id", "lang", "text"), rounds=2)


def test_language_held_out(spark, model):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").where(F.crc32(F.col("doc_id").cast("string")) % 5 == 0)
    got = language_id.identify(docs, model).collect()
    assert len(got) > 20 and sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got)


def test_language_edges(spark, model):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "12 345 --- !!"), (4, "—…€"), (5, "the of and"), (5, "the of and"), (6, "x" * 300000),
                                  (7, "日本語"), (8, "12 é")], DOCS)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(docs, model).collect()}
    assert [got[i] for i in (1, 2, 3, 4)] == [("und", 0.0)] * 4
    assert got[5][0] == "en" and all(got[i][0] in model[0] and 0 <= got[i][1] <= 1 for i in (5, 6, 7, 8))
    blank = language_id.train(spark.createDataFrame([(1, None, "a"), (2, "en", None)], "doc_id long, lang string, text string"))
    assert {r.lang_pred for r in language_id.identify(docs, blank).collect()} == {"und"}
    assert language_id.identify(docs.limit(0), model).count() == 0


def test_forward_sums_all_segmentations():
    v = language_id.pieces(language_id.PIECES)
    probs = np.random.default_rng(1).random((len(v) + 1, 2))
    probs[-1] = 0
    word = bytes([language_id.START]) + b"another"
    where = {p: i for i, p in enumerate(v.pieces)}

    def total(i, lang):
        if i == len(word):
            return 1.0
        return sum(probs[where[word[i:j]], lang] * total(j, lang) for j in range(i + 1, len(word) + 1) if word[i:j] in where)

    got = v.forward(np.frombuffer(word, np.uint8)[None, :], probs)[0]
    assert np.allclose(np.exp(got), [total(0, 0), total(0, 1)])
    # expected counts: the pieces of every segmentation spell the word once
    e = v.expected(np.frombuffer(word, np.uint8)[None, :], np.array([3.0]), probs[:, 0])
    assert abs(sum(e[i] * len(p) for i, p in enumerate(v.pieces)) - 3.0 * len(word)) < 1e-6


# ---- registration --------------------------------------------------------------------

def test_one_query_for_each_operator_and_the_pipeline():
    import __spark_entry__ as entry

    names = list(entry.queries())
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names


def test_pipeline_stages(spark):
    import corpus_pipeline as P

    assert [n for n, _ in P.STAGES] == ["language", "near_duplicates", "decontaminate", "mix", "shard"]
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns = docs.columns
    extra = docs.limit(3).withColumns({"doc_id": F.lit(None).cast("long"), "text": F.lit(None).cast("string")})
    docs = docs.unionByName(extra)
    sizes = []
    for name, stage in P.STAGES:
        from rivulet.llm.common import materialize

        docs = materialize(stage(spark, docs, SF001), name)
        sizes.append(docs.count())
        if name != "shard":
            assert docs.columns == columns
    assert docs.columns == [*columns, "shard"] and docs.count() == sizes[3]
    ids = docs.select("doc_id", "text").distinct()
    assert ids.count() == ids.select("doc_id").distinct().count() == sizes[2] <= sizes[1] <= sizes[0]
    assert os.path.basename(P.__file__) == "corpus_pipeline.py"


def test_language_stage_without_labels_rejects_only_texts_without_a_letter(spark):
    import corpus_pipeline as P

    rows = [(1, "Some words."), (2, "été"), (3, "漢字 1"), (4, "12 -- 3"), (5, ""), (6, None), (None, "x")]
    docs = spark.createDataFrame([(i, t, None) for i, t in rows], DOCS + ", lang string")
    out = P.language(spark, docs, SF001)
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == {1, 2, 3, None}


def test_near_duplicate_stage_keeps_one_row_of_each_component(spark):
    import corpus_pipeline as P

    r = random.Random(12)
    text = [" ".join(f"w{r.randint(0, 999)}" for _ in range(60)) for _ in range(6)]
    near = [t + " end" for t in text]
    rows = [(0, text[0]), (1, near[0]), (1, text[1]), (2, text[2]), (2, text[3]), (3, near[3]),  # one id, different texts
            (None, text[4]), (None, near[4]), (None, text[4]), (None, near[2]), (7, text[5]), (7, text[5]), (7, near[5]), (None, None), (8, ""), (8, "")]
    out = P.near_duplicates(spark, spark.createDataFrame([(*x, "s") for x in rows], DOCS + ", source string").repartition(4), SF001)
    assert out.columns == ["doc_id", "text", "source"]
    got = [(x.doc_id, x.text) for x in out.collect()]
    by = {0: {(0, text[0])}, 1: {(1, text[1])}, 2: {(2, text[2])}, 3: {(2, text[3])}, 4: {(None, text[4]), (None, near[4])}, 5: {(7, text[5]), (7, near[5])}}
    for n, choice in by.items():
        assert len([x for x in got if x[1] in (text[n], near[n])]) == 1 and choice & set(got)
    assert len(got) == 9 and got.count((8, "")) == 2 and (None, None) in got
