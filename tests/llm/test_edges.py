"""Clashing column names, repeated ids, large groups and unknown changes."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from rivulet.llm import html_dom, html_extraction, language_id, sharding, token_ledger, toxicity
from rivulet.llm.common import free_name, shared_path, without_ids


def test_without_ids_keeps_columns_of_its_own_names(spark):
    df = spark.createDataFrame([(i, i * 10, f"b{i}", i % 2 == 0, "x") for i in range(200)], "doc_id long, _at long, _block string, _hit boolean, _bits string")
    got = without_ids(df, spark.createDataFrame([(i,) for i in range(0, 200, 3)], "doc_id long"), "doc_id")
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect())) == [(i, i * 10, f"b{i}", i % 2 == 0, "x") for i in range(200) if i % 3]
    assert free_name(df, "_AT") == "_AT_" and free_name(df, "new") == "new"


def test_language_stage_keeps_columns_of_its_own_names(spark):
    import corpus_pipeline as P

    rows = [(i, "the cat and the dog are here now" if i % 2 else "der hund und die katze sind hier", "en" if i % 2 else "de", 0.25, "mine", i)
            for i in range(40)] + [(99, "12 34", None, 0.5, "mine", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, lang_pred string, _row long")
    got = P.language(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect())) == sorted(r for r in rows if r[0] != 99)
    again = P.near_duplicates(spark, docs.unionByName(docs.where("doc_id = 1")), "")  # repeated ids: rows are told apart
    assert again.columns == docs.columns
    assert sorted(r.doc_id for r in again.collect()) == [0, 1, 99]
    model = language_id.train(docs)
    assert language_id.identify(docs, model).columns == ["doc_id", "text", "lang", "_row", "lang_pred", "score"]


def test_toxicity_replaces_its_columns_and_reads_an_id_once(spark):
    words = [f"calm{i}" for i in range(50)]
    r = random.Random(1)
    rows = [(i, " ".join(r.choices(words, k=20)) + (" grubnaf" if i % 5 == 0 else ""), 9.0, 7) for i in range(200)]
    docs = spark.createDataFrame(rows + [rows[0]] * 300, "doc_id long, text string, score double, predicted int")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(200)], "doc_id long, toxic int")
    got = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    assert len(got) == 500 and all(0 <= x.score <= 1 and x.predicted == int(x.doc_id % 5 == 0) for x in got)


def test_grams_are_of_characters():
    b, off = toxicity.fold(pa.array(["ñandú 中文字 x", "", None, "plain text"]))
    texts = [b[a:z].tobytes().decode() for a, z in zip(off, off[1:])]
    got = list(toxicity.grams(b, off))
    for k, (bucket, text) in zip(toxicity.ORDERS, got):
        assert Counter(text.tolist()) == Counter({i: len(t) - k + 1 for i, t in enumerate(texts) if len(t) >= k})
    ascii_only = toxicity.grams(*toxicity.fold(pa.array(["plain text"])))
    assert [x[0].tolist() for x in ascii_only] == [bucket[text == 3].tolist() for bucket, text in got]


def test_groups_near_a_shard_in_size_are_cut(spark):
    """Seventeen groups of equal texts of 0.94 shard each: every shard is within a tenth of the target."""
    rows = [(g * 100 + i, f"text of group {g} " * 5) for g in range(17) for i in range(60)]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 16).collect()
    size = Counter()
    for r in got:
        size[r.shard] += r.size
    target = sum(size.values()) / 16
    assert len(size) == 16 and all(abs(s - target) <= (2 * sharding.TOLERANCE + 0.03) * target for s in size.values())


def test_equal_rows_keep_their_slots(spark):
    got = sharding.shard_documents(spark.createDataFrame([(None, "same")] * 160, "doc_id long, text string"), 16).collect()
    assert Counter(r.shard for r in got) == {i: 10 for i in range(16)}
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(10)) for s in range(16))


def test_ledger_refuses_unknown_changes(spark):
    tokenizers = {"t": f"{token_ledger.TOKENIZER_DIR}/byte_bpe_50k.tiktoken"}
    ledger = token_ledger.TokenLedger(spark, shared_path(spark, "ledger"), tokenizers)
    schema = "op string, doc_id long, source string, lang string, text string"
    for op in ("upsert", None):
        with pytest.raises(Exception, match="unknown op"):
            ledger.apply(0, spark.createDataFrame([(op, 1, "s", "en", "x"), ("insert", 2, "s", "en", "y")], schema))
    assert ledger.totals().count() == 0
    with pytest.raises(ValueError):
        token_ledger.TokenLedger(spark, "x", {})
    ledger.apply(0, spark.createDataFrame([("insert", 1, "s", "en", "one"), ("insert", 2, "s", "en", "two")], schema))
    ledger.apply(1, spark.createDataFrame([("delete", 1, None, None, None), ("insert", 1, "s", "en", "new text"), ("delete", 2, None, None, None)], schema))
    assert [r.n_docs for r in ledger.totals().collect()] == [1]  # deletions first, then what the batch inserts


def test_flattened_trees_equal_the_fitted_model(spark):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    r = np.random.default_rng(0)
    x = r.random((400, 6))
    y = ((x[:, 0] > 0.4) ^ (x[:, 1] * x[:, 2] > 0.3)).astype(float)
    rows = spark.createDataFrame([(v.tolist(), float(c), i) for i, (v, c) in enumerate(zip(x, y))], "x array<double>, label double, i long")
    table = rows.select(array_to_vector("x").alias("features"), "label", "i")
    fitted = GBTClassifier(maxIter=6, maxDepth=4, stepSize=0.3, seed=1).fit(table)
    forest = html_extraction.Forest([html_extraction._flatten(t.toDebugString) for t in fitted.trees], list(fitted.treeWeights))  # noqa: SLF001
    want = {r["i"]: r["probability"][1] for r in fitted.transform(table).select("i", "probability").collect()}
    assert np.allclose(forest.probability(x), [want[i] for i in range(400)], atol=1e-9)


def test_formulas_and_shown_elements_keep_their_text():
    def runs(page):
        return " ".join(html_dom.Dom(page).run_text)

    assert runs("<body><p>Energy is <math><mi>E</mi><mo>=</mo><mi>m</mi><annotation>E=m</annotation></math> here.</p></body>").split() == [
        "Energy", "is", "E=m", "here."]
    assert "shown" in runs("<body><p aria-hidden='true'>shown</p><p hidden>not</p><object><p>fallback</p></object></body>")
    assert "not" not in runs("<body><p hidden>not</p></body>") and "fallback" in runs("<body><object><p>fallback</p></object></body>")
