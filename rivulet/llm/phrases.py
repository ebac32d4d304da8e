"""Phrase collocation mining: frequent phrases of two to five words per language, scored at their weakest cut.

1. Words. One aggregation counts (lang, word); words of at least ``least`` occurrences are the vocabulary.
   A phrase can only be frequent if all its parts are, so other words end a stretch. Words become 64-bit
   hashes of (lang, word); no vocabulary word shares its hash with any word of the corpus, else the pass
   is repeated with another salt.
2. Levels two to five, one pass over the texts each. A pair is (phrase of the level below, next word).
   Both sides carry ids ranked by frequency, so frequent pairs lie in the first tiles of the id plane:
   tiles of ``TILE`` x ``TILE`` that fill up are counted by a dense bincount, the others as sorted
   coordinates. Each task sends its counts, keyed by the words' hashes, to one aggregation; pairs that
   reach ``least`` are ranked again and are the left sides of the next level.
   The ranked lists that tasks receive hold ``HEAD`` entries a level at most. Phrases beyond it pass a bit
   filter of at most 16 MB instead and get ids within the task: a false positive costs time, not correctness.
   From level three on one more pass has first counted the phrases of each of 2^22 hash buckets (at most
   4 MB a task and level): phrases of buckets below ``least`` are never sent.
3. Scores. All parts of a frequent phrase are frequent, so both sides of every cut are in the counted
   tables; arithmetic is decimal and exact below 10^38.

Only words and phrases move, combined within each task; a language or a word with a third of all rows is
one key of a combined aggregation.

Defined cases: a null or empty text has no words; a null lang is ``und``; repeated rows count each time;
ties in score and count are ordered by the phrase's UTF-8 bytes; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rivulet.llm import textvec
from rivulet.llm.common import ascii_lower, bound_batches, materialize, null_as_empty
from rivulet.llm.jaccard_join import _filter_places, node_filter

LEAST = 100
LONGEST = 5
TOP = 2000
HEAD = 1 << 18        # entries of a ranked list that tasks receive
TILE = 1024           # ids along a tile's side
DENSE_FROM = 1 << 15  # pairs of one tile in one flush from which it is counted densely
DENSE_TILES = 8       # dense tiles a task keeps (8 MB each)
BUFFER = 1 << 22      # pairs gathered before they are counted
ENTRIES = 1 << 21     # distinct pairs a task holds before it sends them
BUCKET_BITS, BUCKET_BLOCK = 22, 1 << 15
NO_LANG = "und"
# fixed values of the contract: what ends a piece, what separates words
STOPS = ".,;:!?\n\x0b\x0c\r"
SPACES = " \t"
_U = np.uint64
_LOW = _U((1 << 32) - 1)


def word_table() -> np.ndarray:
    """Fold A-Z to a-z; stops, space and tab separate words."""
    t = np.arange(256, dtype=np.uint16)
    t[65:91] += 32
    t += 1
    t[[ord(c) for c in STOPS + SPACES]] = 0
    return t


_STOP = np.isin(np.arange(256), [ord(c) for c in STOPS])


# ---- words -------------------------------------------------------------------------

def count_words(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, word, f) of every word."""
    words = F.explode(F.split(ascii_lower(null_as_empty(F.col(text))), "[ \\t.,;:!?\\n-\\r]+"))
    return (docs.select(F.coalesce(F.col(lang), F.lit(NO_LANG)).alias("lang"), words.alias("word"))
            .where("word <> ''").groupBy("lang", "word").agg(F.count("*").alias("f")))


def lang_keys(langs: list[str], salt: int) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8, salt=salt.to_bytes(2, "little")).digest(), "little") for x in langs], np.uint64)


def _hashed(batches: Iterator[pa.RecordBatch], salt: int) -> Iterator[pa.RecordBatch]:
    """(lang, word, f) rows with the hash that the texts' pass gives the word."""
    table = word_table()
    for b in batches:
        h, off, _, _ = textvec.words(b.column("word"), table, salt=salt)
        if len(h) != b.num_rows:
            raise ValueError("a word was cut")
        d = b.column("lang").dictionary_encode()
        keys = lang_keys(d.dictionary.to_pylist(), salt)[d.indices.to_numpy()] if b.num_rows else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(textvec.mix(h ^ keys).view(np.int64))], names=[*b.schema.names, "h"])


def hash_words(words: DataFrame, least: int, first_salt: int = 7) -> tuple[DataFrame, int]:
    """(lang, word, f, h) of the words of at least ``least`` occurrences, none of whose hashes any other word has; and the salt."""
    for salt in range(first_salt, first_salt + 64):
        hashed = materialize(words.mapInArrow(lambda it, s=salt: _hashed(it, s), "lang string, word string, f long, h long"), "phrase-words")
        if hashed.groupBy("h").agg(F.count("*").alias("k"), F.max("f").alias("f")).where((F.col("k") > 1) & (F.col("f") >= least)).isEmpty():
            return materialize(hashed.where(F.col("f") >= least), "vocabulary"), salt
    raise ValueError("no salt keeps the words apart")


# ---- ids in a task -----------------------------------------------------------------

class Ids:
    """Ids of the keys of one level: ranks for the listed ones, ids of the task's own for others that the filter lets through."""

    def __init__(self, ranked: np.ndarray, wanted: tuple[np.ndarray, int] | None):
        """``ranked``: keys in order of rank; ``wanted``: bit filter of the keys beyond them, None if there are none."""
        self.keys = ranked.copy()  # by id
        self.wanted = wanted
        self.order = np.argsort(ranked, kind="stable")
        self.sorted = ranked[self.order]

    def __call__(self, keys: np.ndarray, hashes: np.ndarray | None) -> np.ndarray:
        """Id of each key, -1 for none; ``hashes``: what the filter knows them by."""
        if not len(keys):
            return np.zeros(0, np.int64)
        out = self._find(keys)
        if self.wanted is not None:
            miss = np.flatnonzero(out < 0)
            bits, size = self.wanted
            at = _filter_places(hashes[miss], size)
            miss = miss[(bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
            if len(miss):
                self._add(np.unique(keys[miss]))
                out[miss] = self._find(keys[miss])
        return out

    def _find(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.sorted):
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(np.searchsorted(self.sorted, keys), len(self.sorted) - 1)
        return np.where(self.sorted[at] == keys, self.order[at], -1)

    def _add(self, new: np.ndarray) -> None:
        ids = np.arange(len(self.keys), len(self.keys) + len(new))
        self.keys = np.concatenate([self.keys, new])
        at = np.searchsorted(self.sorted, new)
        self.sorted, self.order = np.insert(self.sorted, at, new), np.insert(self.order, at, ids)


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return left.astype(np.uint64) << _U(32) | right.astype(np.uint64)


def phrase_hash(parts: list[np.ndarray]) -> np.ndarray:
    """What a bit filter knows a phrase by: a hash of its words' hashes."""
    out = parts[0]
    for p in parts[1:]:
        out = textvec.mix(out * _U(0x9E3779B97F4A7C15) + p)
    return out


class Tiles:
    """Counts of (left id, right id) pairs: full tiles by dense bincount, the rest as sorted coordinates."""

    def __init__(self):
        self.held, self.n = [], 0
        self.dense: dict[int, np.ndarray] = {}
        self.codes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, codes: np.ndarray) -> None:
        self.held.append(codes)
        self.n += len(codes)
        if self.n >= BUFFER:
            self.flush()

    def flush(self) -> None:
        if not self.n:
            return
        codes = np.concatenate(self.held)
        self.held, self.n = [], 0
        side = _U(TILE.bit_length() - 1)
        tile = codes >> (_U(32) + side) << _U(32) | (codes & _LOW) >> side
        first = tile < _U(1 << 36)  # ranks of the first sixteen tile rows
        first &= (tile & _LOW) < _U(16)
        near = np.flatnonzero(first)
        place = ((tile[near] >> _U(32)) * _U(16) + (tile[near] & _LOW)).astype(np.int64)
        sparse = [codes[~first]]
        size = np.bincount(place, minlength=256)
        for t in np.argsort(-size, kind="stable").tolist():
            if not size[t]:
                break
            mine = codes[near[place == t]] if t in self.dense or (size[t] >= DENSE_FROM and len(self.dense) < DENSE_TILES) else None
            if mine is None:
                continue
            mask = _U(TILE - 1)
            at = ((mine >> _U(32) & mask) * _U(TILE) + (mine & mask)).astype(np.int64)
            self.dense[t] = self.dense.get(t, 0) + np.bincount(at, minlength=TILE * TILE)
            size[t] = 0
        sparse.append(codes[near[size[place] > 0]])
        self._merge(*np.unique(np.concatenate(sparse), return_counts=True))

    def _merge(self, codes: np.ndarray, counts: np.ndarray) -> None:
        both, weight = np.concatenate([self.codes, codes]), np.concatenate([self.counts, counts])
        o = np.argsort(both, kind="stable")  # two sorted runs
        both, weight = both[o], weight[o]
        if len(both):
            first = np.flatnonzero(np.r_[True, both[1:] != both[:-1]])
            self.codes, self.counts = both[first], np.add.reduceat(weight, first)

    def full(self) -> bool:
        return len(self.codes) >= ENTRIES

    def take(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All counts so far, which are then forgotten."""
        self.flush()
        if len(self.codes):
            yield self.codes, self.counts
        for t, table in self.dense.items():
            at = np.flatnonzero(table)
            left, right = at // TILE + t // 16 * TILE, at % TILE + t % 16 * TILE
            yield pair_keys(left, right), table[at]
        self.dense, self.codes, self.counts = {}, np.zeros(0, np.uint64), np.zeros(0, np.int64)


def stretches(part: pa.RecordBatch, table: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, whether the next word follows it within the same piece)."""
    column = part.column("text")
    raw, _ = textvec.texts(column)
    h, off, start, end = textvec.words(column, table, salt=salt)
    n = np.diff(off)
    d = part.column("lang").fill_null(NO_LANG).dictionary_encode()
    keys = lang_keys(d.dictionary.to_pylist(), salt)[d.indices.to_numpy()]
    joined = np.zeros(len(h), bool)
    if len(h):
        stops = np.concatenate([[0], np.cumsum(_STOP[raw], dtype=np.int32)])
        joined[:-1] = stops[start[1:]] == stops[end[:-1]]
        joined[off[1:][off[1:] > 0] - 1] = False
    return textvec.mix(h ^ np.repeat(keys, n)), joined


def _walk(part: pa.RecordBatch, k: int, salt: int, ids: list[Ids]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(level, codes, hashes) of the places where a phrase of 2 to ``k`` words starts whose parts of one word less are frequent.

    A level without ids of its own lets all phrases pass on; codes are then empty.
    """
    h, joined = stretches(part, word_table(), salt)
    word = ids[0](h, h)
    at = np.flatnonzero(word >= 0)
    element, name = word[at], h[at]  # of the phrase that starts at each of these places
    for level in range(2, k + 1):
        # places whose phrase is followed by the phrase of the next word
        run = at[1:] == at[:-1] + 1
        if level == 2:
            run &= joined[at[:-1]]
        keep = np.flatnonzero(run)
        at, known = at[keep], level - 2 < len(ids)
        codes = pair_keys(element[keep], word[at + level - 1]) if known else np.zeros(0, np.uint64)
        name = phrase_hash([name[keep], h[at + level - 1]])
        yield level, codes, name
        if level - 1 < len(ids):
            element = ids[level - 1](codes, name)
            good = element >= 0
            at, element, name = at[good], element[good], name[good]


def _level(batches: Iterator[pa.RecordBatch], k: int, salt: int, ranked: list, wanted: list, often: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Counts of the phrases of k words whose two parts of k - 1 words are frequent: (w1 .. wk, n)."""
    ids = [Ids(r, w) for r, w in zip(ranked, wanted)]
    tiles = Tiles()
    for b in batches:
        for part in textvec.slices(b, "text", 4 * textvec.SLICE_BYTES):
            for level, codes, name in _walk(part, k, salt, ids):
                if level == k:
                    tiles.add(codes if often is None else codes[often[_bucket(name)]])
        if tiles.full():
            yield from _counts(tiles, k, ids)
    yield from _counts(tiles, k, ids)


def _bucket(name: np.ndarray) -> np.ndarray:
    return (textvec.mix(name) >> _U(64 - BUCKET_BITS)).astype(np.int64)


def _bucket_counts(batches: Iterator[pa.RecordBatch], longest: int, salt: int, ranked: list, wanted: list, least: int) -> Iterator[pa.RecordBatch]:
    """(level, block, counts): how many phrases of three and more words fall into each bucket in this task, at most ``least``."""
    ids = [Ids(r, w) for r, w in zip(ranked, wanted)]
    total = np.zeros((longest - 2, 1 << BUCKET_BITS), np.int32)
    for b in batches:
        for part in textvec.slices(b, "text", 4 * textvec.SLICE_BYTES):
            for level, _, name in _walk(part, longest, salt, ids):
                if level > 2 and len(name):
                    total[level - 3] = np.minimum(total[level - 3] + np.bincount(_bucket(name), minlength=1 << BUCKET_BITS), least)
    for i, counts in enumerate(total):
        blocks = np.flatnonzero(counts.reshape(-1, BUCKET_BLOCK).any(axis=1))
        yield pa.RecordBatch.from_pydict({
            "level": pa.array(np.full(len(blocks), i + 3), pa.int32()), "block": pa.array(blocks, pa.int32()),
            "counts": pa.array([counts[j * BUCKET_BLOCK:(j + 1) * BUCKET_BLOCK].astype(_count_type(least)).tobytes() for j in blocks.tolist()], pa.binary())})


def _count_type(least: int) -> str:
    return "<u1" if least < 256 else "<u4"


def _merged_counts(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """(level, block, bits) of rows sorted by level and block: the buckets with ``least`` phrases in all tasks together."""
    key, total = None, None
    done = lambda: pa.RecordBatch.from_pydict({
        "level": pa.array([key[0]], pa.int32()), "block": pa.array([key[1]], pa.int32()), "bits": pa.array([np.packbits(total >= least).tobytes()], pa.binary())})
    for b in batches:
        for level, block, counts in zip(*(b.column(i).to_pylist() for i in range(3))):
            if key is not None and key != (level, block):
                yield done()
                total = None
            key = (level, block)
            more = np.frombuffer(counts, _count_type(least)).astype(np.int64)
            total = more if total is None else np.minimum(total + more, least)
    if key is not None:
        yield done()


def frequent_buckets(docs: DataFrame, salt: int, ranked: list, wanted: list, least: int, longest: int) -> dict[int, np.ndarray]:
    """Per level from three: which of 2^BUCKET_BITS hash buckets hold ``least`` phrases whose pairs of words are all frequent.

    A phrase of another bucket is not frequent, so its occurrences are never sent. With very many phrases all buckets fill
    up and the filter lets everything pass; results do not depend on it.
    """
    rows = (docs.mapInArrow(lambda it: _bucket_counts(it, longest, salt, ranked, wanted, least), "level int, block int, counts binary")
            .repartition("level", "block").sortWithinPartitions("level", "block"))
    out = {k: np.zeros(1 << BUCKET_BITS, bool) for k in range(3, longest + 1)}
    for r in rows.mapInArrow(lambda it: _merged_counts(it, least), "level int, block int, bits binary").collect():  # 2^BUCKET_BITS bits a level
        out[r["level"]][r["block"] * BUCKET_BLOCK:(r["block"] + 1) * BUCKET_BLOCK] = np.unpackbits(np.frombuffer(r["bits"], np.uint8)).astype(bool)
    return out


def _counts(tiles: Tiles, k: int, ids: list[Ids]) -> Iterator[pa.RecordBatch]:
    for codes, n in tiles.take():
        for i in range(0, len(codes), 1 << 16):
            yield pa.RecordBatch.from_arrays([*(pa.array(w.view(np.int64)) for w in _spelled(codes[i:i + (1 << 16)], k, ids)), pa.array(n[i:i + (1 << 16)])],
                                             names=[*(f"w{j + 1}" for j in range(k)), "n"])


def _spelled(codes: np.ndarray, k: int, ids: list[Ids]) -> list[np.ndarray]:
    """The words' hashes of phrases given as (left id, right id)."""
    out = []
    for level in range(k - 1, 0, -1):
        left, right = (codes >> _U(32)).astype(np.int64), (codes & _LOW).astype(np.int64)
        out.append(ids[0].keys[right])
        codes = ids[level - 1].keys[left]
    return [codes, *reversed(out)]


# ---- ranked lists of a level ---------------------------------------------------------

def _names(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        parts = [b.column(i).to_numpy().view(np.uint64) for i in range(k)]
        name = parts[0]
        for p in parts[1:]:
            name = phrase_hash([name, p])
        yield pa.RecordBatch.from_arrays([pa.array(name.view(np.int64))], names=["node"])


def rank(found: DataFrame, k: int, ranked: list[np.ndarray], head: int) -> tuple[np.ndarray, tuple | None]:
    """(keys of at most ``head`` phrases by frequency, bit filter of all if there are more)."""
    cols = [f"w{j + 1}" for j in range(k)]
    rows = found.orderBy(F.desc("f"), *cols).limit(head).select(*cols).toPandas()  # at most ``head`` rows
    w = [rows[c].to_numpy(np.int64).view(np.uint64) for c in cols]
    if k == 1:
        keys = w[0]
    else:
        levels = [Ids(r, None) for r in ranked]
        word = [levels[0](x, None) for x in w]
        element = word[0]
        good = np.logical_and.reduce([x >= 0 for x in word])
        for level in range(2, k):
            element = levels[level - 1](pair_keys(np.maximum(element, 0), np.maximum(word[level - 1], 0)), None)
            good &= element >= 0
        keys = pair_keys(element[good], word[k - 1][good])
    if found.count() <= len(keys):
        return keys, None
    return keys, node_filter(found.mapInArrow(lambda it: _names(it, k), "node long"))


def count_phrases(docs: DataFrame, words: DataFrame, salt: int, least: int, longest: int, head: int) -> list[DataFrame]:
    """Tables (w1 .. wk, f) of the phrases of at least ``least`` occurrences, k = 1 to ``longest``."""
    levels = [words.select(F.col("h").alias("w1"), "f")]
    ranked, wanted, often = [], [], {}
    for k in range(2, longest + 1):
        keys, more = rank(levels[-1], k - 1, ranked, head)
        if not len(keys) and more is None:
            break
        ranked, wanted = [*ranked, keys], [*wanted, more]
        if k == 3:
            often = frequent_buckets(docs, salt, ranked, wanted, least, longest)
        cols = [f"w{j + 1}" for j in range(k)]
        schema = ", ".join(f"{c} long" for c in cols) + ", n long"
        got = docs.mapInArrow(lambda it, k=k, r=ranked, w=wanted, o=often.get(k): _level(it, k, salt, r, w, o), schema)
        levels.append(materialize(got.groupBy(*cols).agg(F.sum("n").alias("f")).where(F.col("f") >= least), f"phrases-{k}"))
    return levels


# ---- scores ---------------------------------------------------------------------------

def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, top: int = TOP,
                 head: int = HEAD) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases."""
    bound_batches(docs.sparkSession, 4096)
    every = materialize(count_words(docs, text, lang), "phrase-counts")
    totals = every.groupBy("lang").agg(F.sum("f").alias("n"))
    words, salt = hash_words(every, least)
    texts = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    levels = count_phrases(texts, words, salt, least, longest, head)
    key = lambda k: F.array(*[F.col(f"w{j + 1}") for j in range(k)]).alias("key")
    freq = levels[0].select(key(1), "f")
    for k, level in enumerate(levels[1:], 2):
        freq = freq.unionByName(level.select(key(k), "f"))
    phrases = freq.where(F.size("key") > 1).select("key", F.col("f").alias("a"))
    # a phrase inside a longer one with as many occurrences goes; between them lies one that is a word longer
    inner = phrases.where(F.size("key") > 2).select(F.col("a").alias("b"), F.explode(F.array(
        F.expr("slice(key, 1, size(key) - 1)"), F.expr("slice(key, 2, size(key) - 1)"))).alias("key"))
    inner = inner.groupBy("key").agg(F.max("b").alias("b"))
    kept = phrases.join(inner, "key", "left").where("b is null or b < a").select("key", "a")
    cuts = kept.select("*", F.explode(F.expr("sequence(1, size(key) - 1)")).alias("cut"))
    cuts = cuts.withColumns({"left": F.expr("slice(key, 1, cut)"), "right": F.expr("slice(key, cut + 1, size(key) - cut)"), "first": F.col("key")[0]})
    names = words.select(F.col("h").alias("first"), "lang").join(totals, "lang")
    cuts = (cuts.join(freq.select(F.col("key").alias("left"), F.col("f").alias("l")), "left")
            .join(freq.select(F.col("key").alias("right"), F.col("f").alias("r")), "right").join(names, "first"))
    exact = F.expr("(cast(1000 as decimal(4,0)) * cast(a as decimal(17,0)) * cast(n as decimal(17,0))) div "
                   "(cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    weakest = cuts.groupBy("key", "lang", "a", "n").agg(F.min(F.struct(exact.alias("score"), "cut", "l", "r")).alias("m"))
    scored = weakest.select("key", "lang", "a", "n", "m.score", "m.l", "m.r")
    # ties at the limit stay until the texts are known
    near = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    scored = materialize(scored.withColumn("near", F.rank().over(near)).where(F.col("near") <= top), "phrase-scores")
    spelled = (scored.select("key", F.posexplode("key").alias("pos", "h")).join(words.select("h", "word"), "h")
               .groupBy("key").agg(F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))), lambda x: x["word"])).alias("phrase")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (scored.join(spelled, "key").withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
