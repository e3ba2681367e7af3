"""Words of many texts at once, as positions and 64-bit hashes in flat arrays; used inside Python tasks."""

from __future__ import annotations

import numpy as np
import xxhash

from wayfleet.llm.common import mixed

_ALL = np.arange(256)
LOWER = np.where((_ALL >= 65) & (_ALL <= 90), _ALL + 32, _ALL).astype(np.uint8)
# Bytes of the words of PLAIN_WORD: digits, letters, and whatever is not ASCII.
PLAIN = ((_ALL >= 48) & (_ALL <= 57)) | ((_ALL >= 65) & (_ALL <= 90)) | ((_ALL >= 97) & (_ALL <= 122)) | (_ALL >= 128)
WHITE = ~((_ALL == 32) | ((_ALL >= 9) & (_ALL <= 13)))

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SPAN = 1 << 18
_LONG_WORD = 1 << 12
_UP = np.concatenate(([np.uint64(1)], np.full(_SPAN + _LONG_WORD, _BASE))).cumprod(dtype=np.uint64)
_DOWN = np.concatenate(([np.uint64(1)], np.full(_SPAN + _LONG_WORD, _BASE_INVERSE))).cumprod(dtype=np.uint64)
_STEP = np.uint64(0xD1342543DE82EF95)


def find_words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = PLAIN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each word begins and ends in ``data``, and the row it is in.  A word never crosses a row's end."""
    inside = kind[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def hash_words(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial in its bytes, from running sums, so no word is touched on its own."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = starts[at]
        to = max(at + 1, int(np.searchsorted(starts, base + _SPAN)))
        end = min(int(ends[to - 1]), int(base) + _SPAN + _LONG_WORD)
        sums = np.zeros(end - base + 1, np.uint64)
        np.cumsum((low[base:end].astype(np.uint64) + np.uint64(1)) * _UP[: end - base], out=sums[1:])
        s, e = starts[at:to] - base, ends[at:to] - base
        out[at:to] = (sums[np.minimum(e, end - base)] - sums[s]) * _DOWN[s]
        at = to
    for i in np.flatnonzero(ends - starts > _LONG_WORD):
        out[i] = xxhash.xxh64_intdigest(low[starts[i] : ends[i]].tobytes())
    return mixed(out)


def hash_grams(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` consecutive words, in order of their first word."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, np.uint64(size))
    for j in range(size):
        out = out * _STEP + words[j : j + n]
    return mixed(out)


def whole_grams(rows: np.ndarray, size: int) -> np.ndarray:
    """Which runs of ``size`` words lie in one row."""
    n = len(rows) - size + 1
    return rows[:n] == rows[size - 1 :] if n > 0 else np.zeros(0, bool)
