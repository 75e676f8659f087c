"""Words of many texts as arrays: where they stand in the bytes, and a 64-bit hash of each."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

from millrace.llm.common import bounds, ragged

#: White space that parts words: space and \x09 to \x0D. Everything else belongs to a word.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: Longer words are hashed one at a time.
LONG_WORD = 64


def mixed(h: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts behind one another, and where each text begins (one more than texts)."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class WordTable:
    """Words of texts in order: data[start[i]:end[i]]; text t has the words first[t] .. first[t+1]-1."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word: eight bytes at a time, all words side by side."""
        size = self.end - self.start
        out = mixed(size.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eights = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), (len(self.data) + 1,), (1,)) if len(padded) else padded
        live = np.flatnonzero(size <= LONG_WORD)
        for at in range(0, LONG_WORD, 8):
            live = live[size[live] > at]
            if not live.size:
                break
            left = np.minimum(size[live] - at, 8).astype(np.uint64)
            word = eights[self.start[live] + at] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - left * np.uint64(8)))
            out[live] = mixed(out[live] ^ word) + np.uint64(at + 1)
        for i in np.flatnonzero(size > LONG_WORD).tolist():
            out[i] = xxhash.xxh64_intdigest(self.data[self.start[i] : self.end[i]].tobytes())
        return out


def word_table(column: pa.Array, lower: bool = False) -> WordTable:
    """The words of every text of an Arrow string column without nulls; `lower` turns A-Z into a-z."""
    data, offsets = raw_bytes(column)
    if lower:
        data = _LOWER[data]
    inside = ~_SPACE[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    full = np.flatnonzero(np.diff(offsets) > 0)
    begins[offsets[full]] = inside[offsets[full]]
    ends[offsets[full + 1] - 1] = inside[offsets[full + 1] - 1]
    start = np.flatnonzero(begins)
    return WordTable(data, start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets))


def shingle_table(words: WordTable, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of `size` words (a text with fewer words: one of all its words), and where each text's begin."""
    h = words.hashes()
    count = np.diff(words.first)
    rolled = np.full(len(h), size, np.uint64)
    n = len(h)
    for k in range(size):
        part = np.zeros(n, np.uint64)
        part[: max(n - k, 0)] = h[k:]
        rolled = mixed(rolled + part)
    whole = np.maximum(count - size + 1, 0)
    short = np.flatnonzero((count > 0) & (count < size))
    sizes = whole.copy()
    sizes[short] = 1
    begin = bounds(sizes)
    out = np.empty(int(begin[-1]), np.uint64)
    out[ragged(begin[:-1], whole)] = rolled[ragged(words.first[:-1], whole)]
    for t in short.tolist():
        key = np.full(1, count[t], np.uint64)
        for x in h[words.first[t] : words.first[t + 1]]:
            key = mixed(key + x)
        out[begin[t]] = mixed(key)[0]
    return out, begin
