"""Words and word hashes of whole Arrow text columns, without a Python step per word.

Bytes A-Z are lower-cased; words are the longest runs of bytes that are no separator. Separators are
ASCII, so cutting UTF-8 bytes is the same as cutting characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text is handled alone.
CHUNK = 2_000_000
_BASE, _M1, _M2 = np.uint64(0x100000001B3 * 2 + 1), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class _Powers:
    def __init__(self):
        self.table = np.ones(1, np.uint64)

    def up_to(self, n: int) -> np.ndarray:
        if len(self.table) < n:
            steps = np.full(max(n, 2 * len(self.table), 64), _BASE, np.uint64)
            steps[0] = 1
            self.table = np.multiply.accumulate(steps)
        return self.table


_POWERS = _Powers()


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each row starts (nulls are empty)."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    kind = np.int64 if wide else np.int32
    buffers = texts.buffers()
    at = np.frombuffer(buffers[1], kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def chunks(texts: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row starts) of runs of rows with about ``limit`` bytes."""
    if not len(texts):
        return
    data, at = text_bytes(texts)
    first = 0
    while first < len(at) - 1:
        last = max(int(np.searchsorted(at, at[first] + limit, "right")) - 1, first + 1)
        yield first, data[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def word_places(data: np.ndarray, at: np.ndarray, blank: np.ndarray = _SPACE) -> tuple[np.ndarray, ...]:
    """(hash and first byte of each word, where the words of each row start, lower-cased bytes, which bytes are words)."""
    low = _LOWER[data]
    word = ~blank[low]
    start = word.copy()
    start[1:] &= ~word[:-1]
    row_starts = at[:-1][at[:-1] < len(data)]
    start[row_starts] |= word[row_starts]
    first = np.flatnonzero(start)
    bounds = np.searchsorted(first, at)
    if not len(first):
        return np.zeros(0, np.uint64), first, bounds, low, word
    place = np.zeros(len(data), np.int32)
    place[first] = first
    place = np.arange(len(data), dtype=np.int32) - np.maximum.accumulate(place)
    place[~word] = 0
    value = (low + np.uint64(1)) * _POWERS.up_to(int(place.max()) + 1)[place]
    value[~word] = 0
    return mix(np.add.reduceat(value, first)), first, bounds, low, word


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, where the words of each row start)."""
    hashes, _, bounds, _, _ = word_places(data, at)
    return hashes, bounds


def shingle_hashes(hashes: np.ndarray, bounds: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each shingle, repeats included; where the shingles of each row start).

    A row with fewer words than ``size``, but at least one, has its whole sequence as one shingle.
    """
    count = np.diff(bounds)
    n = len(hashes)
    factor = _POWERS.up_to(64)
    salts = np.arange(size, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    whole = np.zeros(n, np.uint64)
    for k in range(min(size, n)):
        whole[: n - k] += hashes[k:] * factor[k + 1]
    end = np.repeat(bounds[1:], count)
    fits = np.arange(n) + size <= end
    short = (count > 0) & (count < size)
    for r in np.flatnonzero(short):
        words = hashes[bounds[r] : bounds[r + 1]]
        whole[bounds[r]] = np.append(words * factor[1 : len(words) + 1], salts[len(words)]).sum(dtype=np.uint64)
        fits[bounds[r]] = True
    per_row = np.where(short, 1, np.maximum(count - size + 1, 0))
    return mix(whole[fits]), np.concatenate([[0], np.cumsum(per_row)])
