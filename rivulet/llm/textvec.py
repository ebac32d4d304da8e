"""Vectorised word and shingle hashing over Arrow string batches.

Every function works on whole texts: an Arrow string column is viewed as one
UTF-8 byte buffer with offsets, a 256-entry table folds each byte (0 marks a
separator) and numpy finds the words and hashes them, with no per-word Python.
Hashes are 64-bit and seed-free, so every executor, retry and run agrees.
Null texts count as empty texts: they have no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20  # bytes of text handled at once; longer texts are cut between words, never shortened
_BLOCK = 256 << 10  # bytes whose words are found at once: the arrays of a block stay in the processor's cache
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: a bijection that spreads every input bit (uint64, wrap-around)."""
    x = x.astype(np.uint64, copy=True)
    x += _U(0x9E3779B97F4A7C15)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def multipliers(n: int, salt: int) -> np.ndarray:
    """n fixed odd 64-bit numbers; the first k of any longer table are the same."""
    return mix(np.arange(n, dtype=np.uint64) + _U((salt << 32) & (2**64 - 1))) | _U(1)


def ascii_space_table() -> np.ndarray:
    """Fold A-Z to a-z; separators are exactly 0x20 and 0x09-0x0D."""
    t = np.arange(256, dtype=np.uint16)
    t[65:91] += 32
    t += 1  # so that byte 0 is not a separator
    t[[0x20, *range(0x09, 0x0E)]] = 0
    return t


def alnum_table() -> np.ndarray:
    """Fold A-Z to a-z; every ASCII byte that is no letter or digit separates words."""
    t = ascii_space_table()
    b = np.arange(256)
    word = (b >= 128) | ((b >= 48) & (b < 58)) | ((b >= 65) & (b < 91)) | ((b >= 97) & (b < 123))
    t[~word] = 0
    return t


def texts(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column, nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, off, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``limit`` text bytes (one row at least); every row comes once."""
    col = batch.column(column)
    _, offsets = texts(col)
    i, n = 0, batch.num_rows
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(n, max(j, i + 1))
        yield batch.slice(i, j - i)
        i = j


def _word_hashes(b: np.ndarray, first: np.ndarray, salt: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, start and end positions of the words of folded bytes; ``first`` marks where texts begin."""
    word = b != 0
    begins = word.copy()
    begins[1:] &= ~word[:-1] | first[1:]
    starts = np.flatnonzero(begins)
    if len(starts) == 0:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z
    stops = word.copy()
    stops[:-1] &= ~word[1:] | first[1:]
    ends = np.flatnonzero(stops) + 1
    span = np.diff(np.append(starts, len(b)))
    at = np.arange(starts[0], len(b)) - np.repeat(starts, span)
    # separators between words have value 0; their place can exceed the longest word, so clip it
    table = multipliers(int((ends - starts).max()), salt)
    np.minimum(at, len(table) - 1, out=at)
    v = b[starts[0]:].astype(np.uint64) * table[at]
    return mix(np.add.reduceat(v, starts - starts[0]) + (ends - starts).astype(np.uint64)), starts, ends


def fold_latin1(b: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Lower-case the accented Latin-1 capitals (UTF-8 C3 80-9E but 97) of folded bytes."""
    if len(raw) > 1:
        up = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)
        b[1:][up] += 32
    return b


def words(column, table: np.ndarray, latin1: bool = False, salt: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, per-text offsets into them, byte starts, byte ends) of the words of every whole text; another salt, other hashes."""
    raw, offsets = texts(column)
    n = len(raw)
    out_h, out_s, out_e = [], [], []
    lo = 0
    while lo < n:
        hi = min(n, lo + min(_BLOCK, 2 * SLICE_BYTES))
        while hi < n:  # move the cut to a separator or the start of a text
            block = raw[hi:hi + 65536]
            gap = np.flatnonzero(table[block] == 0)
            nxt = np.searchsorted(offsets, hi)
            stop = min(offsets[nxt] if nxt < len(offsets) else n, hi + gap[0] if len(gap) else hi + len(block))
            found = len(gap) or (nxt < len(offsets) and offsets[nxt] <= hi + len(block))
            hi = int(stop)
            if found:
                break
        part = raw[lo:hi]
        b = table[part]
        if latin1:
            b = fold_latin1(b, part)
        first = np.zeros(len(part), bool)
        cut = offsets[(offsets >= lo) & (offsets < hi)] - lo
        first[cut] = True
        h, s, e = _word_hashes(b, first, salt)
        out_h.append(h)
        out_s.append(s + lo)
        out_e.append(e + lo)
        lo = hi
    if not out_h:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), z, z
    h, s, e = np.concatenate(out_h), np.concatenate(out_s), np.concatenate(out_e)
    return h, np.searchsorted(s, offsets), s, e


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words that start at each word (the last k-1 places are not valid shingles)."""
    q = multipliers(k, 11)
    out = np.zeros(len(h), np.uint64)
    for j in range(k):
        out[:len(h) - j] += h[j:] * q[j]
    return mix(out)


def distinct(x: np.ndarray) -> np.ndarray:
    """The sorted distinct values."""
    x = np.sort(x)
    first = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=first[1:])
    return x[first]


def shingle_sets(column, table: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct k-word shingle hashes of each text; fewer words give the whole sequence as one."""
    h, off, _, _ = words(column, table)
    sh = shingles(h, k)
    for i in range(len(off) - 1):
        a, b = int(off[i]), int(off[i + 1])
        if b - a >= k:
            yield distinct(sh[a:b - k + 1])
        elif b > a:
            yield shingles(h[a:b], b - a)[:1] ^ _U(b - a)
        else:
            yield np.zeros(0, np.uint64)
