"""Simple-8b: runs of unsigned 64-bit integers as 64-bit words, packed and unpacked with numpy.

The top four bits of a word select how many integers its other 60 bits hold, and how wide each is
(``WIDTHS``). An integer of 2^60 or more is an escape: its word has selector 0 and the number of a
raw word, and the raw words follow the packed words of the run. A word never holds integers of two
runs and is always full, so runs can be cut, moved and decoded on their own, and a decoder needs
no padding rule.
"""

from __future__ import annotations

import numpy as np

# fixed values of the format: integers per word and bits of each, for selectors 1 to 14
WIDTHS = [(60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
_COUNT = np.array([1, *(c for c, _ in WIDTHS), 1], np.int64)
_SELECTOR = {c: s + 1 for s, (c, _) in enumerate(WIDTHS)}
_U = np.uint64


def _most(ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many integers a word that starts at each place can hold at most, within its run."""
    n = len(ids)
    here = np.arange(n)
    left = np.repeat(ends, np.diff(ends, prepend=0)) - here
    top = int(ids.max()) if n else 0
    best = np.ones(n, np.int64)
    for count, bits in reversed(WIDTHS[:-1]):
        if top >> bits:
            wide = np.where(ids >> ids.dtype.type(bits) > 0, here, n)
            room = np.minimum(np.minimum.accumulate(wide[::-1])[::-1] - here, left)
        else:
            room = left
        best[room >= count] = count
    return best


def pack(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, words of each run, raw words among them) of unsigned ``ids``; ``ends`` are the runs' ends in them."""
    ends = np.asarray(ends, np.int64)
    if not len(ids):
        return np.zeros(0, np.uint64), np.zeros(len(ends), np.int64), np.zeros(len(ends), np.int64)
    if ids.dtype.kind != "u":
        raise ValueError("ids must be unsigned")
    best = _most(ids, ends)
    step = best.tolist()
    starts, i, n = [], 0, len(ids)
    while i < n:
        starts.append(i)
        i += step[i]
    starts = np.array(starts, np.int64)
    count = best[starts]
    words = np.zeros(len(starts), np.uint64)
    wide = ids.astype(np.uint64, copy=False)
    escape = np.zeros(len(starts), bool)
    for c, bits in WIDTHS:
        at = np.flatnonzero(count == c)
        if not len(at):
            continue
        w = np.full(len(at), _SELECTOR[c] << 60, np.uint64)
        if c == 1:
            big = wide[starts[at]] >> _U(60) > 0
            escape[at[big]] = True
            w |= np.where(big, _U(0), wide[starts[at]])
        else:
            for j in range(c):
                w |= wide[starts[at] + j] << _U(j * bits)
        words[at] = w
    sizes = np.diff(np.searchsorted(starts, ends), prepend=0)
    raws = np.zeros(len(ends), np.int64)
    if escape.any():
        run = np.repeat(np.arange(len(ends)), sizes)
        raws = np.bincount(run[escape], minlength=len(ends))
        first = np.cumsum(raws) - raws
        at = np.flatnonzero(escape)
        words[at] = (np.arange(len(at)) - first[run[at]]).astype(np.uint64)  # selector 0, number of the raw word
        words = np.insert(words, np.cumsum(sizes)[run[at]], wide[starts[at]])
        sizes = sizes + raws
    return words, sizes, raws


def unpack(words: np.ndarray, sizes: np.ndarray, raws: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ids of each run) of whole runs that lie one after the other."""
    sizes, raws = np.asarray(sizes, np.int64), np.asarray(raws, np.int64)
    run = np.repeat(np.arange(len(sizes)), sizes)
    ends = np.cumsum(sizes)
    packed = np.arange(len(words)) < (ends - raws)[run]
    at = np.flatnonzero(packed)
    w, run = words[at], run[at]
    selector = (w >> _U(60)).astype(np.int64)
    count = _COUNT[selector]
    first = np.cumsum(count) - count
    ids = np.zeros(int(count.sum()), np.uint64)
    for s in np.unique(selector).tolist():
        rows = np.flatnonzero(selector == s)
        if s == 0:
            ids[first[rows]] = words[(ends - raws)[run[rows]] + w[rows].astype(np.int64)]
            continue
        if s > len(WIDTHS):
            raise ValueError("no such selector")
        c, bits = WIDTHS[s - 1]
        lanes = w[rows][:, None] >> (np.arange(c, dtype=np.uint64) * _U(bits))[None, :] & _U((1 << bits) - 1)
        ids[first[rows][:, None] + np.arange(c)[None, :]] = lanes
    return ids, np.bincount(run, count, len(sizes)).astype(np.int64)
