"""Language identification with segmentation-marginalised unigram pieces.

The vocabulary is a fixed public piece model's: its lower-case letter pieces
(with the word-start mark) plus all single bytes as fallback. Each language has
a probability for every piece, and a word's probability is the sum over all its
segmentations (forward algorithm). A text is the product of its words. Piece
probabilities come from a few EM rounds (forward-backward expected counts) over
the words of at most ``max_train_docs`` labelled documents per language, chosen
by a hash of doc_id; that bound is the classifier's documented sample. Words,
expected counts and scoring are Spark jobs; the driver holds only the table of
pieces x languages.

Words are runs of letters (bytes of non-ASCII characters count as letters),
capitals A-Z and Latin-1 folded; a run over ``MAX_WORD`` bytes is scored as
consecutive runs, so texts are used whole.

Defined cases: null text, or text without any letter, gives ``und`` with score
0; ties go to the first language in sorted order; repeated rows get equal
results; extra columns are kept by ``identify``; an empty table or no labelled
row gives ``und`` for every document.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from rivulet.llm import textvec
from rivulet.llm.common import bound_batches, materialize, worker_cache

PIECES = "/opt/tokenizers/piece_bpe_32k.model"
MAX_TRAIN_DOCS = 1500   # labelled documents per language that the classifier is fitted on
EM_ROUNDS = 3
MAX_WORD = 40           # bytes
CACHE = 1 << 19         # scored words a task keeps
SMOOTHING = 0.5         # added to every piece's expected count
START = 1               # byte that stands for the word-start mark
_MARK = "▁"
_B = np.uint64(0x100000001B3)


def letter_table() -> np.ndarray:
    """Fold A-Z; every ASCII byte that is no letter separates."""
    t = textvec.alnum_table()
    t[48:58] = 0
    return t


class Pieces:
    """The vocabulary as byte strings with a sorted hash index."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        found = {bytes([b]) for b in range(2, 256)} | {bytes([START])}
        for i in range(sp.vocab_size()):
            p = sp.id_to_piece(i)
            word = p.removeprefix(_MARK)
            if word.isalpha() and word == word.lower() and len(word.encode()) < MAX_WORD:
                found.add((bytes([START]) if p.startswith(_MARK) else b"") + word.encode())
        self.pieces = sorted(found)
        self.longest = max(map(len, self.pieces))
        h = np.zeros(len(self.pieces), np.uint64)
        with np.errstate(over="ignore"):
            for i, p in enumerate(self.pieces):
                x = np.uint64(len(p))
                for c in p:
                    x = x * _B + np.uint64(c + 1)
                h[i] = x
        self.order = np.argsort(h)
        self.hashes = h[self.order]
        self.maybe = np.zeros(1 << 20, bool)  # quick test: most substrings are no piece
        self.maybe[(textvec.mix(h) >> np.uint64(44)).astype(np.int64)] = True

    def __len__(self) -> int:
        return len(self.pieces)

    def ids(self, chars: np.ndarray) -> list[np.ndarray]:
        """For words of equal length (n x length bytes): [k-1] is the piece of chars[:, i:i+k] at i, or -1."""
        n, length = chars.shape
        c = chars.astype(np.uint64) + np.uint64(1)
        out = []
        for k in range(1, min(length, self.longest) + 1):
            x = np.full((n, length - k + 1), k, np.uint64)
            for j in range(k):
                x = x * _B + c[:, j:j + length - k + 1]
            found = np.full(x.shape, -1, np.int32)
            hit = self.maybe[((textvec.mix(x)) >> np.uint64(44)).astype(np.int64)]
            y = x[hit]
            at = np.minimum(np.searchsorted(self.hashes, y), len(self.hashes) - 1)
            found[hit] = np.where(self.hashes[at] == y, self.order[at], -1)
            out.append(found)
        return out

    def forward(self, chars: np.ndarray, probs: np.ndarray) -> np.ndarray:
        """log of the summed probability of all segmentations, per word and language; probs: (pieces + 1) x languages."""
        ids = self.ids(chars)
        n, length = chars.shape
        alpha = np.zeros((length + 1, n, probs.shape[1]))
        alpha[0] = 1.0
        for j in range(1, length + 1):
            for k in range(1, min(j, len(ids)) + 1):
                alpha[j] += alpha[j - k] * probs[ids[k - 1][:, j - k]]
        return np.log(alpha[length])

    def expected(self, chars: np.ndarray, count: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Expected piece counts of weighted words under one language (p: pieces + 1, the last 0)."""
        ids = self.ids(chars)
        n, length = chars.shape
        alpha, beta = np.zeros((length + 1, n)), np.zeros((length + 1, n))
        alpha[0] = beta[length] = 1.0
        for j in range(1, length + 1):
            for k in range(1, min(j, len(ids)) + 1):
                alpha[j] += alpha[j - k] * p[ids[k - 1][:, j - k]]
        for i in range(length - 1, -1, -1):
            for k in range(1, min(length - i, len(ids)) + 1):
                beta[i] += beta[i + k] * p[ids[k - 1][:, i]]
        got, weight = [], []
        scale = count / alpha[length]
        for k, at in enumerate(ids, 1):
            for i in range(length - k + 1):
                piece = at[:, i]
                hit = piece >= 0
                got.append(piece[hit])
                weight.append((alpha[i] * p[piece] * beta[i + k] * scale)[hit])
        return np.bincount(np.concatenate(got), np.concatenate(weight), len(p))


_LOADED: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The vocabulary, loaded once per worker."""
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def _runs(folded: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Words by length: length -> (indices, marked byte matrix); longer words become several rows of one index."""
    size = ends - starts
    rows = defaultdict(lambda: ([], []))
    which = np.arange(len(starts))
    out = {}
    left, s, w, fresh = size.copy(), starts.copy(), which, np.ones(len(starts), bool)
    while len(w):
        take = np.minimum(left, MAX_WORD)
        for k in np.unique(take):
            sel = take == k
            chars = folded[s[sel][:, None] + np.arange(k)]
            for mark in (True, False):
                m = fresh[sel] == mark
                if m.any():
                    body = chars[m]
                    if mark:
                        body = np.concatenate([np.full((len(body), 1), START, np.uint8), body], axis=1)
                    rows[body.shape[1]][0].append(w[sel][m])
                    rows[body.shape[1]][1].append(body)
        more = left > MAX_WORD
        s, left, w, fresh = (s + take)[more], (left - take)[more], w[more], np.zeros(int(more.sum()), bool)
    for k, (at, body) in rows.items():
        out[k] = (np.concatenate(at), np.concatenate(body))
    return out


def _fold(raw: np.ndarray) -> np.ndarray:
    """Bytes with A-Z and Latin-1 capitals folded (separators stay as they are)."""
    lower = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
    return textvec.fold_latin1(lower, raw)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = letter_table()
    for b in batches:
        for part in textvec.slices(b, "text"):
            raw, _ = textvec.texts(part.column("text"))
            h, off, s, e = textvec.words(part.column("text"), table, latin1=True)
            low = _fold(raw).tobytes()
            langs = part.column("lang").to_pylist()
            doc_lang = defaultdict(list)
            for i, lang in enumerate(langs):
                doc_lang[lang].append(np.arange(off[i], off[i + 1]))
            for lang, at in doc_lang.items():
                at = np.concatenate(at)
                if not len(at):
                    continue
                _, first, n = np.unique(h[at], return_index=True, return_counts=True)
                at = at[first]
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * len(at), pa.string()),
                    "word": pa.array([low[a:z] for a, z in zip(s[at], e[at])], pa.binary()),
                    "n": pa.array(n, pa.int64())})


def _expect(batches: Iterator[pa.RecordBatch], path: str, langs: list[str], probs: np.ndarray) -> Iterator[pa.RecordBatch]:
    vocab = pieces(path)
    total = np.zeros((probs.shape[1], len(vocab) + 1))
    for b in _larger(batches):
        n = b.column("n").to_numpy(zero_copy_only=False).astype(float)
        data, off = _binary(b.column("word"))
        which = np.array([langs.index(x) for x in b.column("lang").to_pylist()], int)
        for _, (at, chars) in _runs(data, off[:-1], off[1:]).items():
            for lang in np.unique(which[at]):
                m = which[at] == lang
                total[lang] += vocab.expected(chars[m], n[at[m]], probs[:, lang])
    lang, piece = np.nonzero(total)
    yield pa.RecordBatch.from_pydict({"lang": pa.array(lang, pa.int32()), "piece": pa.array(piece, pa.int32()),
                                      "n": pa.array(total[lang, piece], pa.float64())})


def _larger(batches: Iterator[pa.RecordBatch], rows: int = 20000) -> Iterator[pa.RecordBatch]:
    """The same rows in larger batches."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _binary(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    col = col.cast(pa.large_binary())
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64, len(col) + 1, col.offset * 8)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), off


def train(labelled: DataFrame, path: str = PIECES, max_train_docs: int = MAX_TRAIN_DOCS, rounds: int = EM_ROUNDS):
    """(languages, probs): piece probabilities, (pieces + 1) x languages, from (doc_id, lang, text) rows."""
    spark = labelled.sparkSession
    bound_batches(spark)
    labelled = labelled.where("lang is not null and text is not null")
    # per language the rows with the smallest hashes: a share just above the bound by counts (a row a language, broadcast, as
    # the model holds every language anyway), then exactly the bound, so no task reads or ranks a whole language
    keys = labelled.select("doc_id", "lang", F.xxhash64("doc_id").alias("h"))
    share = keys.groupBy("lang").agg((F.lit(1.2 * max_train_docs + 50) / F.count("*")).alias("share"))
    few = keys.join(F.broadcast(share), "lang").where((F.col("h") / F.lit(2.0 ** 64) + 0.5) < F.col("share"))
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    picked = few.withColumn("k", F.row_number().over(order)).where(F.col("k") <= max_train_docs).select("doc_id", "lang").distinct()
    # at most max_train_docs rows a language: bounded, so broadcast
    sample = labelled.select("doc_id", "lang", "text").join(F.broadcast(picked), ["doc_id", "lang"], "left_semi")
    words = materialize(sample.select("lang", "text").mapInArrow(_count_words, "lang string, word binary, n long")
                        .groupBy("lang", "word").agg(F.sum("n").alias("n"))
                        .repartition(spark.sparkContext.defaultParallelism), "langwords")  # few bytes, much work
    langs = sorted(r[0] for r in words.select("lang").distinct().collect())
    vocab = pieces(path)
    probs = np.zeros((len(vocab) + 1, len(langs)))
    probs[:-1] = 1.0 / len(vocab)
    for _ in range(rounds if langs else 0):
        got = (words.mapInArrow(lambda it, p=probs: _expect(it, path, langs, p), "lang int, piece int, n double")
               .groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas())
        n = np.full((len(vocab) + 1, len(langs)), SMOOTHING)
        n[got["piece"].to_numpy(int), got["lang"].to_numpy(int)] += got["n"].to_numpy(float)
        n[-1] = 0
        probs = n / n.sum(axis=0)
    return langs, probs


class Scorer:
    """Log-probabilities of words per language, with a direct-mapped cache of words seen in this task."""

    def __init__(self, path: str, probs: np.ndarray):
        self.vocab, self.probs = pieces(path), probs
        self.tags, self.logs = np.zeros(CACHE, np.uint64), np.zeros((CACHE, probs.shape[1]))

    def __call__(self, folded: np.ndarray, h: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """Per word and language."""
        slot = (h & np.uint64(CACHE - 1)).astype(np.int64)
        out = self.logs[slot]
        miss = np.flatnonzero(self.tags[slot] != h)
        if len(miss):
            u, first, back = np.unique(h[miss], return_index=True, return_inverse=True)
            i = miss[first]
            logs = np.zeros((len(u), self.probs.shape[1]))
            for _, (w, chars) in _runs(folded, s[i], e[i]).items():
                for a in range(0, len(w), 20000):
                    np.add.at(logs, w[a:a + 20000], self.vocab.forward(chars[a:a + 20000], self.probs))
            out[miss] = logs[back]
            self.tags[slot[i]], self.logs[slot[i]] = u, logs
            clash = self.tags[slot[i]] != u  # two new words of one slot: keep one, whole
            if clash.any():
                self.tags[slot[i][clash]] = 0
        return out


def scorer(path: str, probs: np.ndarray) -> Scorer:
    """This worker's scorer; its cache outlives a task as long as the model stays the same."""
    held = worker_cache().get("language", (None, None))
    if held[0] != path or not np.array_equal(held[1].probs, probs):
        held = worker_cache()["language"] = (path, Scorer(path, probs))
    return held[1]


def score_batch(column, words_of: Scorer, langs: list[str]) -> tuple[list[str], np.ndarray]:
    """(predicted language, posterior) of each text."""
    table = letter_table()
    n = len(column)
    pred, score = ["und"] * n, np.zeros(n)
    if not langs:
        return pred, score
    raw, offsets = textvec.texts(column)
    h, off, s, e = textvec.words(column, table, latin1=True)
    total = np.zeros((n, len(langs)))
    if len(h):
        logs = words_of(_fold(raw), h, s, e)
        sums = np.concatenate([np.zeros((1, len(langs))), np.cumsum(logs, axis=0)])
        total = sums[off[1:]] - sums[off[:-1]]
    ascii_letter = np.concatenate([[0], np.cumsum(((raw | 32) >= 97) & ((raw | 32) <= 122))])
    sure = ascii_letter[offsets[1:]] > ascii_letter[offsets[:-1]]
    best = total.argmax(axis=1)
    post = 1.0 / np.exp(total - total[np.arange(n), best][:, None]).sum(axis=1)
    for i in range(n):
        if off[i + 1] > off[i] and (sure[i] or any(c.isalpha() for c in raw[offsets[i]:offsets[i + 1]].tobytes().decode())):
            pred[i], score[i] = langs[best[i]], post[i]
    return pred, score


def _score(batches: Iterator[pa.RecordBatch], path: str, langs: list[str], probs: np.ndarray, text: str, names) -> Iterator[pa.RecordBatch]:
    words_of = scorer(path, probs) if langs else None
    for b in batches:
        for part in textvec.slices(b, text):
            pred, score = score_batch(part.column(text), words_of, langs)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                             names=[*part.schema.names, *names])


def identify(docs: DataFrame, model: tuple, text: str = "text", path: str = PIECES, names=("lang_pred", "score")) -> DataFrame:
    """``docs`` with the columns ``names``, prediction and posterior, added; columns of those names are replaced."""
    bound_batches(docs.sparkSession)
    langs, probs = model
    docs = docs.drop(*(n for n in names if n != text))
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    return docs.mapInArrow(lambda it: _score(it, path, langs, probs, text, names), schema)
