"""Operator 11: Simple-8b coding and token-id files against the tokenizer itself and plain Python."""

import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rivulet.llm import simple8b, textvec, token_ids

CHARS = list("aAbJKİIß'.,;:!?<|>1２é \t\n\r\x0b\x0c\x1c\x85　̱́̌Σσςǰ中‍😀-_") + ["<|endoftext|>", "'s", "'LL", "J̌", "don't", "word"]


@given(st.lists(st.tuples(st.integers(0, 2**64 - 1), st.integers(0, 63)), max_size=200), st.lists(st.integers(0, 200), max_size=4))
@settings(max_examples=200, deadline=None)
def test_simple8b_round_trip(values, cuts):
    ids = np.array([v >> s for v, s in values], np.uint64)
    ends = np.sort(np.minimum(np.array([*cuts, len(ids)]), len(ids)))
    words, sizes, raws = simple8b.pack(ids, ends)
    back, n = simple8b.unpack(words, sizes, raws)
    assert back.tolist() == ids.tolist()
    assert n.tolist() == np.diff(ends, prepend=0).tolist()
    assert int(raws.sum()) == int((ids >> np.uint64(60) > 0).sum())


def test_words_hold_as_many_ids_as_fit():
    for count, bits in simple8b.WIDTHS:
        ids = np.full(3 * count, (1 << bits) - 1, np.uint64)
        words, sizes, _ = simple8b.pack(ids, [len(ids)])
        assert len(words) == sizes[0] == 3
    with pytest.raises(ValueError):
        simple8b.pack(np.array([1, 2]), [2])
    with pytest.raises(ValueError):
        simple8b.unpack(np.array([15 << 60], np.uint64), [1], [0])


def whole(texts):
    e = token_ids.encoder(token_ids.tokenizer_path())
    return [x.ids for x in e.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def split(ids, sizes):
    ends = np.cumsum(sizes).tolist()
    return [ids[a:z].tolist() for a, z in zip([0, *ends], ends)]


def test_pieces_equal_whole_texts(monkeypatch):
    r = random.Random(1)
    texts = ["".join(r.choices(CHARS, k=r.randint(0, 40))) for _ in range(4000)] + [None, ""]
    e = token_ids.Encoder(token_ids.tokenizer_path())
    want = whole(texts)
    assert split(*e(pa.array(texts))) == want
    monkeypatch.setattr(token_ids, "PART_BYTES", 16)  # texts cut into many parts, and a cache emptied all the time
    monkeypatch.setattr(token_ids, "CACHE_PIECES", 50)
    assert split(*token_ids.Encoder(token_ids.tokenizer_path())(pa.array(texts))) == want
    assert split(*e(pa.array([], pa.string()))) == []


def expected(rows):
    """{(doc_id, start): (n, crc)} of rows in doc_id order; only for distinct ids."""
    out, at = {}, 0
    for (d, _), ids in sorted(zip(rows, whole([t for _, t in rows])), key=lambda x: (x[0][0] is not None, x[0][0] or 0)):
        ids = [*ids, token_ids.END_ID]
        out[d] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    return out


def test_files_round_trip(spark, scratch):
    r = random.Random(2)
    rows = [(i * 7 % 1009, "".join(r.choices(CHARS, k=r.randint(0, 60)))) for i in range(900)]
    rows += [(None, "no id"), (5000, None), (5001, ""), (5002, "a long text, with words " * 60000)]
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, start string, file long")
    root, index = token_ids.write_ids(docs, root=f"{scratch}/ids")
    got = token_ids.read_ids(token_ids.starts(index), root).collect()
    assert {x.doc_id: (x.start, x.n_tokens, x.ids_crc32) for x in got} == expected(rows)
    assert len(got) == len(rows)
    some = token_ids.starts(index).where("doc_id in (14, 5002) or doc_id is null")
    full = {x.doc_id: x.ids for x in token_ids.read_ids(some, root, with_ids=True).collect()}
    assert full == {d: [*ids, 2] for (d, _), ids in zip(rows, whole([t for _, t in rows])) if d in (14, 5002, None)}


def test_repeated_rows_follow_each_other(spark, scratch):
    docs = spark.createDataFrame([(3, "x")] * 50 + [(3, f"y{i}") for i in range(50)] + [(1, "first")], "doc_id long, text string")
    root, index = token_ids.write_ids(docs.repartition(6), root=f"{scratch}/ids")
    got = sorted(token_ids.read_ids(token_ids.starts(index), root).collect(), key=lambda x: x.start)
    assert [x.doc_id for x in got] == [1] + [3] * 100
    at = 0
    for x in got:
        assert x.start == at
        at += x.n_tokens


def test_empty_table_and_other_key_types(spark, scratch):
    root, index = token_ids.write_ids(spark.createDataFrame([], "doc_id long, text string"), root=f"{scratch}/a")
    assert token_ids.read_ids(token_ids.starts(index), root).collect() == []
    docs = spark.createDataFrame([("b", "two words"), ("a", "one")], "doc_id string, text string")
    root, index = token_ids.write_ids(docs, root=f"{scratch}/b")
    assert [(x.doc_id, x.start) for x in token_ids.read_ids(token_ids.starts(index), root).orderBy("doc_id").collect()] == [("a", 0), ("b", 2)]


def test_damaged_files_are_refused(spark, scratch):
    root, index = token_ids.write_ids(spark.createDataFrame([(1, "some words")], "doc_id long, text string"), root=f"{scratch}/a")
    name = f"{root}/{index.first().file}"
    raw = bytearray(open(name, "rb").read())
    raw[-30] ^= 1
    open(name, "wb").write(raw)
    with pytest.raises(Exception, match="damaged"):
        token_ids.read_ids(token_ids.starts(index), root).collect()


def test_blocks_cut_long_documents():
    n = token_ids.BLOCK + 5
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["a " * n])], names=["doc_id", "text"])
    out = next(token_ids._packed(iter([batch]), token_ids.tokenizer_path(), 2))  # noqa: SLF001
    table = np.frombuffer(out["blocks"][0].as_py(), "<u4").reshape(-1, 3)
    assert table[:, 0].tolist() == [token_ids.BLOCK, 6]
    assert out["n_tokens"][0].as_py() == n + 1
    assert os.path.basename(token_ids.tokenizer_path()) == token_ids.TOKENIZER
    assert textvec.SLICE_BYTES < token_ids.PART_BYTES
