"""Token ids of a corpus as Simple-8b files, written in doc_id order and read back.

1. The texts are range-partitioned and sorted by (doc_id, hash of the text, row), so a doc_id that
   repeats without end still spreads.
2. Each task tokenises its texts whole and packs them (``simple8b``): a document is one or more blocks
   of at most ``BLOCK`` ids, an end id after its last one. Texts are cut into pieces where this vocabulary
   always cuts, and each distinct piece is encoded once a worker (a bounded cache); tests hold this
   against encoding whole texts. Other vocabularies need another ``Encoder``.
   The words go straight to the task's one file.
3. A file is a head, the words of all blocks, a directory (ids, words and raw words of every block,
   blocks of every document) and a foot with the counts and the crc32 of directory and counts.
   A reader needs the foot, the directory and the byte ranges of the documents it wants.

File names hold a random part and only files named by the committed index table count, so retried
and speculative tasks do no harm. Offsets of whole files come from one row per file.

Defined cases: a null or empty text is the end id alone; null doc_ids come first; rows of one
doc_id follow each other in the order of their texts' hash; special-token strings in a text are
ordinary text; an empty table gives no file and an empty result; extra columns are ignored.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rivulet.llm import simple8b, textvec
from rivulet.llm.common import bound_batches, materialize, shared_path, worker_cache

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
BLOCK = 1 << 16           # ids of a block
CACHE_PIECES = 1 << 20    # pieces held by a worker's cache; it is emptied beyond that
LONG_PIECE = 64           # characters; longer pieces are encoded but not looked up again
PART_BYTES = 8 << 20      # bytes of text tokenised at once
READ_WORDS = 1 << 20      # words read and decoded at once
INDEX = "file string, part int, doc long, first long, n_tokens long, word long, n_words long, block long, n_blocks long"
_MAGIC, _VERSION = b"S8BT", 1
_HEAD = 8
_FOOT = np.dtype([("blocks", "<u8"), ("docs", "<u8"), ("words", "<u8"), ("ids", "<u8"), ("crc", "<u4"), ("magic", "S4")])
_SPACE, _LETTER, _STOP = 1, 2, 8
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = _SPACE
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
_KIND[[ord(c) for c in ".,;:!?"]] = _STOP


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of whole texts; distinct pieces are encoded once and kept, up to a bound.

    Texts are cut where the vocabulary's splitter always cuts and nothing merges over the cut: at ASCII
    white space (dropped) and between an ASCII letter and a stop. ASCII capitals before an ASCII byte
    are folded first, as the vocabulary would; one before a combining mark is left to it.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self._clear()

    def _clear(self) -> None:
        self.place: dict[str, int] = {}
        self.ids, self.n = np.zeros(1 << 16, np.uint32), 0
        self.starts, self.sizes, self.count = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), 0

    def _add(self, pieces: list[str]) -> np.ndarray:
        """Places of new pieces."""
        # a piece of a-z only passes the normaliser and the splitter unchanged: its ids come from the merges alone
        plain = [p.isascii() and p.isalpha() and p.islower() for p in pieces]
        rest = iter(self.tokenizer.encode_batch_fast([p for p, x in zip(pieces, plain) if not x], add_special_tokens=False))
        merge = self.tokenizer.model.tokenize
        got = [[t.id for t in merge(p)] if x else next(rest).ids for p, x in zip(pieces, plain)]
        size = np.fromiter(map(len, got), np.int64, len(got))
        total = int(size.sum())
        while self.n + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.count + len(got) > len(self.starts):
            self.starts, self.sizes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.sizes))
        self.ids[self.n:self.n + total] = np.fromiter(chain.from_iterable(got), np.uint32, total)
        at = np.arange(self.count, self.count + len(got))
        self.starts[at], self.sizes[at] = self.n + np.cumsum(size) - size, size
        self.place.update((p, i) for p, i in zip(pieces, at.tolist()) if len(p) <= LONG_PIECE)
        self.count, self.n = self.count + len(got), self.n + total
        return at

    def _pieces(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each text) of texts of moderate length."""
        kind = _KIND[raw]
        keep = kind != _SPACE
        begins = np.zeros(len(raw), bool)
        begins[1:] = (kind[:-1] == _SPACE) | (kind[:-1] + kind[1:] == _LETTER + _STOP)
        begins[offsets[:-1][offsets[:-1] < len(raw)]] = True
        begins &= keep
        low = raw.copy()
        capital = (raw >= 65) & (raw <= 90)
        capital[:-1] &= raw[1:] < 128
        low[capital] += 32
        at = np.flatnonzero(begins)
        kept = np.concatenate([[0], np.cumsum(keep)])
        if not len(at):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        ends = np.append(kept[at], kept[-1])
        words = pa.StringArray.from_buffers(len(at), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(low[keep])).dictionary_encode()
        distinct = words.dictionary.to_pylist()
        if self.count > CACHE_PIECES or self.n > 8 * CACHE_PIECES:
            self._clear()
        place = np.fromiter(map(self.place.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(place < 0)
        if len(new):
            place[new] = self._add([distinct[i] for i in new.tolist()])
        use = place[words.indices.to_numpy(zero_copy_only=False)]
        start, size = self.starts[use], self.sizes[use]
        done = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.repeat(start - done[:-1], size) + np.arange(done[-1])]
        return ids, np.diff(done[np.searchsorted(at, offsets)])

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each text) of whole texts, nulls as empty ones."""
        raw, offsets = textvec.texts(column)
        n = len(offsets) - 1
        cuts, owner = [], []
        for i in np.flatnonzero(np.diff(offsets) > PART_BYTES).tolist():
            at = int(offsets[i])
            while offsets[i + 1] - at > PART_BYTES:  # cut before a white space; without one the text stays whole
                space = np.flatnonzero(_KIND[raw[at + PART_BYTES:offsets[i + 1]]] == _SPACE)
                if not len(space):
                    break
                at += PART_BYTES + int(space[0])
                cuts.append(at)
                owner.append(i)
        where = np.insert(offsets, np.array(owner, np.int64) + 1, cuts) if cuts else offsets
        text = np.repeat(np.arange(n), 1 + np.bincount(np.array(owner, np.int64), minlength=n))
        out, sizes = [np.zeros(0, np.uint32)], np.zeros(n, np.int64)
        i = 0
        while i < len(text):
            j = max(i + 1, int(np.searchsorted(where, where[i] + PART_BYTES, "right")) - 1)
            ids, k = self._pieces(raw[where[i]:where[j]], where[i:j + 1] - where[i])
            out.append(ids)
            np.add.at(sizes, text[i:j], k)
            i = j
        return np.concatenate(out), sizes


def encoder(path: str) -> Encoder:
    """This worker's encoder of a tokenizer file."""
    held = worker_cache()
    if ("encoder", path) not in held:
        held["encoder", path] = Encoder(path)
    return held["encoder", path]


def with_end(ids: np.ndarray, sizes: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same documents with ``end_id`` after each."""
    return np.insert(ids, np.cumsum(sizes), np.uint32(end_id)), sizes + 1


def _packed(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, n_tokens, words, blocks): each document's blocks as one run of words and (ids, words, raws) triples; order is kept."""
    encode = encoder(path)
    for b in batches:
        for part in textvec.slices(b, "text", PART_BYTES):
            ids, sizes = with_end(*encode(part.column("text")), end_id)
            ends = np.cumsum(sizes)
            blocks = -(-sizes // BLOCK)
            nth = np.arange(int(blocks.sum())) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            cut = np.minimum(np.repeat(ends - sizes, blocks) + (nth + 1) * BLOCK, np.repeat(ends, blocks))
            words, n_words, raws = simple8b.pack(ids, cut)
            table = np.stack([np.diff(cut, prepend=0), n_words, raws], axis=1).astype("<u4")
            last = np.cumsum(blocks)
            at = np.concatenate([[0], np.cumsum(n_words)])
            words = words.astype("<u8", copy=False)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sizes, pa.int64()),
                 pa.array([words[at[z - k]:at[z]].tobytes() for z, k in zip(last.tolist(), blocks.tolist())], pa.binary()),
                 pa.array([table[z - k:z].tobytes() for z, k in zip(last.tolist(), blocks.tolist())], pa.binary())],
                names=["doc_id", "n_tokens", "words", "blocks"])


def _fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri.removeprefix("file:"))


def _write(batches: Iterator[pa.RecordBatch], root: str) -> Iterator[pa.RecordBatch]:
    """One file of a sorted partition; its index rows (doc_id and the columns of INDEX)."""
    from pyspark import TaskContext

    fs, base = _fs(root)
    part = TaskContext.get().partitionId()
    name, out = f"part-{part:06d}-{uuid.uuid4().hex}.s8b", None
    tables, per_doc = [], []
    ids = words = docs = blocks = 0
    try:
        for b in batches:
            if not b.num_rows:
                continue
            if out is None:
                out = fs.open_output_stream(f"{base}/{name}", compression=None)
                out.write(_MAGIC + _VERSION.to_bytes(4, "little"))
            for w in b.column("words"):
                out.write(w.as_buffer())
            n = b.column("n_tokens").to_numpy()
            size = pc.binary_length(b.column("words")).to_numpy(zero_copy_only=False).astype(np.int64) // 8
            k = pc.binary_length(b.column("blocks")).to_numpy(zero_copy_only=False).astype(np.int64) // 12
            tables += b.column("blocks").to_pylist()
            per_doc.append(k.astype("<u4"))
            before = lambda x, done: done + np.cumsum(x) - x
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([name] * b.num_rows), pa.array([part] * b.num_rows, pa.int32()),
                 pa.array(docs + np.arange(b.num_rows)), pa.array(before(n, ids)), pa.array(n), pa.array(before(size, words)), pa.array(size),
                 pa.array(before(k, blocks)), pa.array(k)],
                names=["doc_id", *(c.split()[0] for c in INDEX.split(", "))])
            ids, words, docs, blocks = ids + int(n.sum()), words + int(size.sum()), docs + b.num_rows, blocks + int(k.sum())
        if out is not None:
            directory = b"".join(tables) + np.concatenate(per_doc).tobytes()
            out.write(directory)
            counts = np.array([blocks, docs, words, ids], "<u8").tobytes()
            out.write(counts + zlib.crc32(counts, zlib.crc32(directory)).to_bytes(4, "little") + _MAGIC)
    finally:
        if out is not None:
            out.close()


def write_ids(docs: DataFrame, root: str | None = None, text: str = "text", path: str | None = None,
              end_id: int = END_ID) -> tuple[str, DataFrame]:
    """(folder of the files, index table): doc_id, file, its part number, place in it, ids before it in the file and its own."""
    spark = docs.sparkSession
    bound_batches(spark)
    path = path or tokenizer_path()
    root = root or shared_path(spark, "token-ids")
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)  # noqa: SLF001 - Hadoop FileSystem API
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)  # noqa: SLF001
    key = dict(docs.dtypes)["doc_id"]
    order = ["doc_id", "_hash", "_row"]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", F.col(text).alias("text")).withColumns(
        {"_hash": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})  # _row only spreads equal rows
    rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select("doc_id", "text")
    return root, materialize(rows.mapInArrow(lambda it: _write(_packed(it, path, end_id), root), f"doc_id {key}, {INDEX}"), "token-index")


class File:
    """One open file: its checked directory, and decoded ranges of blocks."""

    def __init__(self, fs, path: str):
        self.file = fs.open_input_file(path)
        size = self.file.size()
        head = self.file.read_at(_HEAD, 0)
        foot = self.file.read_at(_FOOT.itemsize, size - _FOOT.itemsize)
        self.foot = np.frombuffer(foot, _FOOT)[0]
        at = _HEAD + 8 * int(self.foot["words"])
        directory = self.file.read_at(max(0, size - _FOOT.itemsize - at), min(at, size))
        if head != _MAGIC + _VERSION.to_bytes(4, "little") or self.foot["magic"] != _MAGIC or zlib.crc32(foot[:32], zlib.crc32(directory)) != self.foot["crc"]:
            raise ValueError(f"damaged file {path}")
        n = int(self.foot["blocks"])
        self.table = np.frombuffer(directory, "<u4", 3 * n).reshape(n, 3).astype(np.int64)
        self.word = np.concatenate([[0], np.cumsum(self.table[:, 1])])
        self.doc_block = np.concatenate([[0], np.cumsum(np.frombuffer(directory, "<u4", offset=12 * n).astype(np.int64))])

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids of blocks ``first`` to ``last`` (excluded), one read."""
        a, z = int(self.word[first]), int(self.word[last])
        words = np.frombuffer(self.file.read_at(8 * (z - a), _HEAD + 8 * a), "<u8")
        ids, n = simple8b.unpack(words, self.table[first:last, 1], self.table[first:last, 2])
        if not np.array_equal(n, self.table[first:last, 0]):
            raise ValueError("damaged block")
        return ids

    def runs(self, first: int, last: int) -> Iterator[tuple[int, int]]:
        """Cuts of a block range into reads of about READ_WORDS words."""
        while first < last:
            z = max(first + 1, int(np.searchsorted(self.word, self.word[first] + READ_WORDS, "right")) - 1)
            yield first, min(z, last)
            first = min(z, last)

    def close(self) -> None:
        self.file.close()


def _stretches(file: File, docs: np.ndarray) -> Iterator[np.ndarray]:
    """Sorted documents of a file in stretches of neighbours, of about READ_WORDS words."""
    cut = np.flatnonzero(np.diff(docs) > 1) + 1
    for run in np.split(docs, cut):
        start = file.word[file.doc_block[run]]
        i = 0
        while i < len(run):
            j = max(i + 1, int(np.searchsorted(start, start[i] + READ_WORDS, "right")))
            yield run[i:j]
            i = j


def _documents(file: File, docs: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(document, some of its ids in order) of sorted documents; a long one comes in several parts."""
    for run in _stretches(file, docs):
        first, last = int(file.doc_block[run[0]]), int(file.doc_block[run[-1] + 1])
        for a, z in file.runs(first, last):
            ids = file.ids(a, z)
            owner = np.searchsorted(file.doc_block, np.arange(a, z), "right") - 1
            n = np.bincount(owner - owner[0], file.table[a:z, 0]).astype(np.int64)
            ends = np.cumsum(n)
            for d, (s, e) in enumerate(zip((ends - n).tolist(), ends.tolist())):
                yield int(owner[0]) + d, ids[s:e]


def _read(batches: Iterator[pa.RecordBatch], root: str, with_ids: bool) -> Iterator[pa.RecordBatch]:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of index rows sorted by file and place."""
    fs, base = _fs(root)
    name, file = None, None
    try:
        for b in batches:
            names = b.column("file").to_pylist()
            cuts = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
            for a, z in zip(cuts, cuts[1:]):
                if a == z:
                    continue
                if names[a] != name:
                    if file is not None:
                        file.close()
                    name, file = names[a], File(fs, f"{base}/{names[a]}")
                docs = b.column("doc").to_numpy()[a:z]
                crc, n, ids = dict.fromkeys(docs.tolist(), 0), dict.fromkeys(docs.tolist(), 0), {}
                for d, some in _documents(file, docs):
                    raw = some.astype("<u4").tobytes()
                    crc[d], n[d] = zlib.crc32(raw, crc[d]), n[d] + len(some)
                    if with_ids:
                        ids.setdefault(d, []).append(some.astype(np.int64))
                part = b.slice(a, z - a)
                if list(n.values()) != part.column("n_tokens").to_pylist():
                    raise ValueError(f"{name} and its index differ")
                cols = [part.column("doc_id"), part.column("start"), pa.array(list(n.values()), pa.int64()), pa.array(list(crc.values()), pa.int64())]
                if with_ids:
                    cols.append(pa.array([np.concatenate(ids[d]) for d in docs.tolist()], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:len(cols)])
    finally:
        if file is not None:
            file.close()


def starts(index: DataFrame) -> DataFrame:
    """The index with ``start``: ids of all documents before each, over all files in their order."""
    files = index.groupBy("file", "part").agg(F.sum("n_tokens").alias("_n"))  # one row per file
    before = F.coalesce(F.sum("_n").over(Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return index.join(files.select("file", before.alias("_before")), "file").withColumn("start", F.col("_before") + F.col("first")).drop("_before")


def read_ids(index: DataFrame, root: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of the index rows, read back from the files.

    ``index`` carries ``start`` (see ``starts``) and may be any selection of rows.
    """
    spark = index.sparkSession
    key = dict(index.dtypes)["doc_id"]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (index.select("doc_id", "file", "doc", "n_tokens", "start").repartitionByRange(n, "file", "doc")
            .sortWithinPartitions("file", "doc"))
    schema = f"doc_id {key}, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    return rows.mapInArrow(lambda it: _read(it, root, with_ids), schema)
