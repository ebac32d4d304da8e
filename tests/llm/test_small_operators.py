"""Operators 2, 3, 5, 7 and 10 against plain Python."""

import gzip
import hashlib
import math
import os
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rivulet.llm import exact_dedup, mixing, sharding, token_ledger, warc
from rivulet.llm.common import shared_path

WORDS = [f"w{i}" for i in range(50)]


def docs(spark, rows, schema="doc_id long, text string, source string, lang string"):
    return spark.createDataFrame(rows, schema)


# ---- 2 sharding ------------------------------------------------------------------

def sharding_rows(seed=1, n=600):
    r = random.Random(seed)
    return [(i, r.choice([None, "", "copy of a text " * 20, " ".join(r.choices(WORDS, k=r.randint(1, 60))), "é" * r.randint(1, 40)])) for i in range(n)]


def test_shards_are_near_equal_contiguous_and_gapless(spark):
    rows = sharding_rows() + [(5, "twice"), (5, "twice")]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 16).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    size, slots = Counter(), defaultdict(list)
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    total = sum(size.values())
    assert set(size) == set(range(16))
    assert max(size.values()) - min(size.values()) < 0.25 * total / 16  # one text is at most 301 bytes
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_small_groups_of_equal_texts_stay_together(spark):
    rows = [(i, f"text {i // 4} " * 5) for i in range(800)]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 16).collect()
    where = defaultdict(set)
    for r in got:
        where[r.text_crc32].add(r.shard)
    assert all(len(s) == 1 for s in where.values())


def test_assigned_shards_equal_the_shards(spark):
    df = spark.createDataFrame(sharding_rows(n=300) + [(None, "no id")], "doc_id long, text string")
    want = {(r.doc_id, r.text): r.shard for r in sharding.shard_documents(df, 16, carry=("doc_id", "text")).collect()}
    got = sharding.assign_shards(df, 16)
    assert got.columns == ["doc_id", "text", "shard"]
    assert {(r.doc_id, r.text): r.shard for r in got.collect()} == want
    assert sharding.assign_shards(df.limit(0), 16).count() == 0


def test_sharding_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.shard_documents(empty, 16).collect() == []
    one = sharding.shard_documents(spark.createDataFrame([(1, None, 9)], "doc_id long, text string, shard int"), 16, carry=("doc_id", "text")).collect()
    assert [(r.doc_id, r.size, r.text_crc32, r.slot, r.text) for r in one] == [(1, 1, 0, 0, None)]


# ---- 3 WARC ------------------------------------------------------------------------

def test_warc_round_trip(spark):
    long = "<p>été</p>" * 30
    rows = [(4, "http://a/b c\r\n", long), (2, None, long), (9, "http://x", long), (3, "http://s", "short"), (1, "http://t", "short"),
            (5, "http://n", None), (6, "http://m", ""), (9, "http://x", long), (7, "http://big", "y" * 3_000_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    pages = pages.sparkSession.createDataFrame(pages.collect(), pages.schema)
    root, index = warc.write_archives(pages)
    got = warc.read_records(index, root).collect()
    assert len(got) == len(rows)
    want = {r[0]: (r[2] or "").encode() for r in rows}
    for r in got:
        body = want[r.page_id]
        assert r.payload_bytes == len(body) and r.payload_digest == hashlib.sha256(body).hexdigest()
        if r.record_type == "response":
            assert bytes(r.payload) == body and r.refers_to is None
        else:
            assert r.payload is None and r.refers_to == 2 and body == long.encode()
    assert Counter((r.page_id, r.record_type) for r in got) == Counter(
        {(2, "response"): 1, (4, "revisit"): 1, (9, "revisit"): 2, **{(i, "response"): 1 for i in (1, 3, 5, 6, 7)}})
    # the index alone finds one record, and the files are plain gzip members
    one = index.where("page_id = 3")
    assert [bytes(r.payload) for r in warc.read_records(one, root).collect()] == [b"short"]
    files = [f for f in os.listdir(root.removeprefix("file:")) if f.endswith(".warc.gz")]
    raw = b"".join(gzip.open(os.path.join(root.removeprefix("file:"), f)).read() for f in files)
    assert raw.count(b"WARC/1.1\r\n") == len(rows)


def test_warc_rows_keep_their_roles_when_the_splits_change(spark, scratch, monkeypatch):
    rows = [(i, f"http://{i}", f"<p>page {i % 60}</p>" * 20) for i in range(200)]
    spark.createDataFrame(rows, "page_id long, url string, html string").repartition(8).write.parquet(f"{scratch}/pages")
    conf = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(conf)

    def resplit(df, name, real=warc.materialize):
        out = real(df, name)
        if name == "warckeys":  # from now on the pages are split otherwise, as after the loss of an executor
            spark.conf.set(conf, "200")
        return out

    monkeypatch.setattr(warc, "materialize", resplit)
    try:
        spark.conf.set(conf, "100m")
        root, index = warc.write_archives(spark.read.parquet(f"{scratch}/pages"))
        index = index.collect()
    finally:
        spark.conf.set(conf, old)
    assert len(index) == 200
    for r in index:
        assert r.payload_digest == hashlib.sha256(rows[r.page_id][2].encode()).hexdigest() and r.url == f"http://{r.page_id}"
        assert (r.record_type, r.refers_to) == (("response", None) if r.page_id < 60 else ("revisit", r.page_id % 60))
    assert {bytes(r.payload) for r in warc.read_records(spark.createDataFrame(index, warc.INDEX), root).where("payload is not null").collect()} == {
        h.encode() for _, _, h in rows}


def test_warc_repeated_rows(spark):
    long, other = "<p>a</p>" * 30, "<p>b</p>" * 30
    rows = [(1, "b", long), (1, "a", long), (1, "a", long), (1, "a", long), (1, None, long), (None, "a", long), (1, "a", other),
            (None, None, "c" * 200), (None, None, "c" * 200), (3, "s", "short"), (3, "s", "short")]
    root, index = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = Counter((r.page_id, r.url, r.record_type, r.refers_to, bytes(r.payload or b"").decode()) for r in warc.read_records(index, root).collect())
    anon = "urn:page:None"
    assert got == Counter({(1, "a", "response", None, long): 1, (1, "a", "revisit", 1, ""): 2, (1, "b", "revisit", 1, ""): 1,
                           (1, "urn:page:1", "revisit", 1, ""): 1, (None, "a", "revisit", 1, ""): 1, (1, "a", "response", None, other): 1,
                           (None, anon, "response", None, "c" * 200): 1, (None, anon, "revisit", None, ""): 1, (3, "s", "response", None, "short"): 2})


def test_warc_ranges_are_coalesced():
    row = lambda f, o, n: {"file": f, "offset": o, "length": n}
    rows = [row("a", 0, 10), row("a", 10, 5), row("a", 100, 5), row("a", 9000, 5), row("b", 0, 5)]
    assert [len(x) for x in warc._ranges(rows, gap=100, most=1000)] == [3, 1, 1]
    assert [len(x) for x in warc._ranges(rows, gap=10 ** 6, most=104)] == [2, 1, 1, 1]


def test_warc_empty(spark):
    root, index = warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"))
    assert warc.read_records(index, root).count() == 0


# ---- 5 exact dedup -----------------------------------------------------------------

@pytest.mark.parametrize("counters,max_heavy", [(4, 2), (1024, 8192), (1, 1)])
def test_exact_dedup_equals_brute_force(spark, counters, max_heavy):
    r = random.Random(3)
    rows = [(i, r.choice([None, "", "Hot Text", "hot text", "HOT TEXT", f"t{r.randint(0, 60)}", "É", "é"])) for i in range(500)]
    rows += [(7, "again"), (7, "again"), (None, "again"), (None, "only null")]
    df = spark.createDataFrame([(*x, "extra", 1) for x in rows], "doc_id long, text string, keep_id string, group_size int").repartition(5)
    got = exact_dedup.exact_dedup(df, counters=counters, max_heavy=max_heavy).collect()
    fold = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    groups = defaultdict(list)
    for i, t in rows:
        groups[fold(t)].append(i)
    digest = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    assert len(got) == len(rows)
    kept = Counter()
    for x in got:
        g = groups[digest[x.text_sha256]]
        top = max((i for i in g if i is not None), default=None)
        assert (x.keep_id, x.group_size) == (top, len(g))
        assert not x.kept or x.doc_id == top
        kept[x.text_sha256] += x.kept
    assert set(kept.values()) == {1}
    assert exact_dedup.exact_dedup(df.limit(0)).count() == 0


# ---- 7 mixing ----------------------------------------------------------------------

def mixing_rows(seed=4):
    r = random.Random(seed)
    sources = ["big"] * 300 + ["mid"] * 60 + ["low"] * 20 + [None] * 10
    return [(i, " ".join(r.choices(WORDS, k=r.randint(1, 40))) if i % 17 else r.choice([None, "", "  a \t b "]), s, "en") for i, s in enumerate(sources)]


def test_mixture_realises_the_weights(spark):
    rows = mixing_rows()
    df = docs(spark, rows)
    tokens = {i: max(1, len((t or "").split())) for i, t, *_ in rows}
    size = Counter()
    for i, _, s, _ in rows:
        size[s] += tokens[i]
    got = mixing.mixture(df, block_tokens=500, max_epochs=2.0).collect()
    seen = Counter((r.doc_id, r.epoch) for r in got)
    assert max(seen.values()) == 1 and all(r.tokens == tokens[r.doc_id] for r in got)
    assert {r.doc_id for r in got if r.epoch == 0} == set(tokens)  # nothing is lost
    weight = {r.source: r.weight for r in got}
    assert math.isclose(sum(weight.values()), 1, rel_tol=1e-9)
    budget = size["big"] / weight["big"]
    epochs = {s: weight[s] * budget / size[s] for s in size}
    assert math.isclose(max(epochs.values()), 2.0, abs_tol=1e-6) and math.isclose(min(epochs.values()), 1.0, abs_tol=1e-9)
    # temperature form: log weight is linear in log share
    a = [(math.log(size[s]), math.log(weight[s])) for s in size]
    slope = {round((y - a[0][1]) / (x - a[0][0]), 6) for x, y in a[1:]}
    assert len(slope) == 1
    made, per_block = Counter(), defaultdict(Counter)
    for r in got:
        made[r.source] += r.tokens
        per_block[r.block][r.source] += r.tokens
    for s in size:
        assert -1e-6 <= made[s] - weight[s] * budget <= 40  # the document that crosses the budget belongs to it
    blocks = max(1, round(budget / 500))
    assert set(per_block) == set(range(blocks))
    for b in per_block.values():
        for s in size:
            assert abs(b[s] - weight[s] * budget / blocks) <= 2 * 40
    for b in per_block:
        assert sorted(r.slot for r in got if r.block == b) == list(range(sum(r.block == b for r in got)))


def test_mixture_meets_an_entropy_and_repeats(spark):
    df = docs(spark, mixing_rows())
    got = mixing.mixture(df, target_entropy=1.0, max_epochs=None)
    w = [r[0] for r in got.select("weight").distinct().collect()]
    assert math.isclose(-sum(x * math.log(x) for x in w), 1.0, abs_tol=1e-6)
    assert sorted(map(str, got.collect())) == sorted(map(str, mixing.mixture(df, target_entropy=1.0, max_epochs=None).collect()))


def test_mix_documents_keeps_columns_and_all_rows(spark):
    rows = mixing_rows()
    out = mixing.mix_documents(docs(spark, rows).withColumn("epoch", F.lit(3)), max_epochs=2.0)
    assert out.columns == ["doc_id", "text", "source", "lang", "epoch"]
    got = Counter(tuple(r)[:4] for r in out.collect())
    assert set(got) == set(rows) and max(got.values()) == 2
    plan = Counter(r.doc_id for r in mixing.mixture(docs(spark, rows), max_epochs=2.0).collect())
    assert {k[0]: v for k, v in got.items()} == plan
    assert mixing.mix_documents(docs(spark, [])).count() == 0 and mixing.mixture(docs(spark, [])).count() == 0


def test_budget_that_no_exponent_meets(spark):
    with pytest.raises(ValueError):
        mixing.mixture(docs(spark, mixing_rows()), max_epochs=2.0, budget=10 ** 7)


# ---- 10 token counts ---------------------------------------------------------------

VERSIONS = {v: f"{token_ledger.TOKENIZER_DIR}/{v}.tiktoken" for v in ("byte_bpe_50k", "byte_bpe_multi_50k")}


def test_ledger_follows_inserts_revisions_deletes_and_replays(spark):
    r = random.Random(6)
    state, ledger = {}, token_ledger.TokenLedger(spark, shared_path(spark, "ledger"), VERSIONS)
    enc = {v: token_ledger.encoder(p) for v, p in VERSIONS.items()}
    for batch in range(5):
        changes = {}
        for _ in range(40):
            i = r.choice([None, *range(60)])
            op = r.choice(["insert", "revise", "delete", "insert"])
            changes[i] = (op, i, r.choice(["s1", "s2", None]), r.choice(["en", None]), r.choice([None, "", "a b <|endoftext|>", " ".join(r.choices(WORDS, k=9))]))
        df = spark.createDataFrame(list(changes.values()), "op string, doc_id long, source string, lang string, text string").withColumn("tokens", F.lit("x"))
        assert ledger.apply(batch, df) is True
        assert ledger.apply(batch, df) is False  # delivered again
        for op, i, s, g, t in changes.values():
            state.pop(i, None)
            if op != "delete":
                state[i] = (s, g, t)
        want = Counter()
        for s, g, t in state.values():
            for v in VERSIONS:
                want[s, g, v, "n"] += 1
                want[s, g, v, "t"] += len(enc[v].encode_ordinary(t or ""))
        got = {(x.source, x.lang, x.tokenizer): (x.n_docs, x.n_tokens) for x in ledger.totals().collect()}
        assert got == {(s, g, v): (n, want[s, g, v, "t"]) for (s, g, v, k), n in want.items() if k == "n"}


def test_registered_ledger_alters_totals_and_ends_at_the_whole_table(spark, monkeypatch):
    from conftest import SF001

    from rivulet.llm.queries import QUERIES

    seen, real = [], token_ledger.TokenLedger.apply

    def apply(self, batch_id, changes):
        done = real(self, batch_id, changes)
        seen.append((done, {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in self.totals().collect()}))
        return done

    monkeypatch.setattr(token_ledger.TokenLedger, "apply", apply)
    got = {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in QUERIES["op10_token_counts"](spark, SF001).collect()}
    want = defaultdict(lambda: (0, 0))
    for v, path in VERSIONS.items():
        enc = token_ledger.encoder(path)
        for d in spark.read.parquet(f"{SF001}/documents.parquet").collect():
            n, t = want[d.source, d.lang, v]
            want[d.source, d.lang, v] = n + 1, t + len(enc.encode_ordinary(d.text or ""))
    assert got == dict(want) == seen[-1][1]
    assert [done for done, _ in seen] == [True, False, True, True]
    assert seen[0][1] == seen[1][1] != seen[2][1] != seen[3][1]


def test_ledger_ignores_a_batch_without_its_marker(spark):
    ledger = token_ledger.TokenLedger(spark, shared_path(spark, "ledger"), {"byte_bpe_50k": VERSIONS["byte_bpe_50k"]})
    rows = spark.createDataFrame([("insert", 1, "s", "en", "one two")], "op string, doc_id long, source string, lang string, text string")
    assert ledger.totals().count() == 0
    spark.range(1).write.parquet(f"{ledger.root}/rollup/batch=0")  # a writer died here
    assert ledger.totals().count() == 0
    assert ledger.apply(0, rows.limit(0)) and ledger.totals().count() == 0
    assert ledger.apply(1, rows.unionByName(rows)) and ledger.totals().count() == 1
    assert ledger.totals().first()["n_docs"] == 2


def test_long_texts_are_counted_in_pieces(monkeypatch):
    enc = token_ledger.encoder(VERSIONS["byte_bpe_50k"])
    r = random.Random(8)
    text = "".join(r.choice(["ab", " cd", "  ", "\n", ", ", "12", " é", "x"]) for _ in range(5000))
    monkeypatch.setattr(token_ledger, "_PIECE", 100)
    assert token_ledger.count_tokens(text, enc) == len(enc.encode_ordinary(text))


# ---- helper ------------------------------------------------------------------------

@pytest.mark.parametrize("bits", [3, 27])
def test_without_ids_is_exact(spark, monkeypatch, bits):
    from rivulet.llm import common

    monkeypatch.setattr(common, "FILTER_BITS", max(bits, 15))
    df = spark.range(5000).select(F.when(F.col("id") % 100 != 0, F.col("id")).alias("doc_id"), F.lit("x").alias("text"))
    for ids in (spark.range(0, 5000, 3), spark.range(0), spark.range(4990, 9000)):
        got = common.without_ids(df, ids.select(F.col("id").alias("doc_id")), "doc_id")
        gone = {r.id for r in ids.collect()}
        assert Counter(r.doc_id for r in got.collect()) == Counter(i if i % 100 else None for i in range(5000) if not (i % 100 and i in gone))
