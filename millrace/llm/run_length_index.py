"""A run-length index of short strings, and the matching statistics it gives.

The index is the Burrows-Wheeler transform of all strings, of which only what lies at the heads of its runs is kept: the
text position there, the position of the lexicographic neighbour above, and how many characters the two share. Between
two run heads the neighbour moves along with the text and the shared length falls by one with every position, so matching
statistics for every position are streamed from the samples. In repetitive texts runs are few.
"""

from __future__ import annotations

import numpy as np

from millrace.llm.common import bounds

WORD = 8
#: Three ranks below this go into one number.
TRIPLE = 1 << 21


class RunLengthIndex:
    """Strings one after another in `text` (bytes). No match leaves its string."""

    def __init__(self, text: np.ndarray, sizes: np.ndarray):
        self.n = len(text)
        self.start = bounds(sizes)
        left = np.repeat(self.start[1:], sizes) - np.arange(self.n)  # bytes to the end of the own string
        words = self._words(text, left)
        order = self._sorted(words[: self.n], left, int(sizes.max()) if len(sizes) else 0)
        before = np.concatenate([[-1], text[:-1].astype(np.int64)]) if self.n else np.zeros(0, np.int64)
        first = self.start[:-1]
        before[first] = -1 - np.arange(len(first))  # what stands before a string is like nothing else
        bwt = before[order]
        head = np.ones(self.n, bool)
        head[1:] = bwt[1:] != bwt[:-1]
        rows = np.flatnonzero(head)
        above = np.full(self.n, -2, np.int64)
        above[order[rows]] = np.where(rows > 0, order[rows - 1], -1)
        #: the samples at run heads, in text order
        self.sample = np.flatnonzero(above > -2)
        self.above = above[self.sample]
        self.shared = self._shared(words, left, self.sample, self.above)
        self.runs = len(rows)

    @staticmethod
    def _words(text: np.ndarray, left: np.ndarray) -> np.ndarray:
        """The next 8 bytes at every position and at 8 more, first byte highest, zero where the own string has ended."""
        n = len(text)
        padded = np.concatenate([text, np.zeros(WORD, np.uint8)])
        out = np.zeros(n + WORD, np.uint64)
        out[:n] = np.ndarray(n, ">u8", padded, 0, (1,))
        at = np.flatnonzero(left < WORD)
        gone = (8 * (WORD - left[at])).astype(np.uint64)
        out[at] = (out[at] >> gone) << gone
        return out

    @staticmethod
    def _sorted(words: np.ndarray, left: np.ndarray, longest: int) -> np.ndarray:
        """Suffixes in order; equal ones by place. Ranks by 7 bytes, then by three times as many each time.

        Where three ranks do not go into one number, by twice as many.
        """
        n = len(left)
        if not n:
            return np.zeros(0, np.int64)
        depth = WORD - 1
        # 7 bytes, and how many of them are the string's own
        key = (words & ~np.uint64(0xFF)) | np.minimum(left, depth).astype(np.uint64)
        ranks = 3 if n < TRIPLE else 2
        while True:
            order = np.argsort(key)
            held = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.concatenate([[True], held[1:] != held[:-1]]))
            if rank[order[-1]] == n:
                return order
            if depth >= longest:
                return np.argsort(rank * n + np.arange(n))
            key = rank.copy()
            for k in range(1, ranks):
                key *= n + 1
                there = n - k * depth
                if there > 0:
                    key[:there] += np.where(left[:there] > k * depth, rank[k * depth :], 0)
            depth *= ranks

    @staticmethod
    def _shared(words: np.ndarray, left: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many bytes the strings at `a` and `b` share, word by word; none where b is -1."""
        out = np.zeros(len(a), np.int64)
        going = np.flatnonzero(b >= 0)
        at, beside = a[going], b[going]
        most = np.minimum(left[at], left[beside])
        length = 0
        while going.size:
            apart = words[at] ^ words[beside]
            equal = apart == 0
            ends = ~equal | (most <= length + WORD)
            same = np.where(equal, WORD, (apart.astype(">u8").view(np.uint8).reshape(-1, WORD) != 0).argmax(axis=1))
            out[going[ends]] = np.minimum(length + same[ends], most[ends])
            going, at, beside, most = going[~ends], at[~ends] + WORD, beside[~ends] + WORD, most[~ends]
            length += WORD
        return out

    def matching_statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """(length, place) for every position: the longest match with its neighbour above, and where that is."""
        step = np.zeros(self.n, np.int64)
        step[self.sample] = 1
        last = np.cumsum(step) - 1
        moved = np.arange(self.n) - self.sample[last]
        return self.shared[last] - moved, self.above[last] + moved

    def later_matches(self, length: int) -> np.ndarray:
        """Positions whose next `length` bytes also start at an earlier position."""
        found, place = self.matching_statistics()
        up = np.where(found >= length, place, np.arange(self.n))
        while True:  # equal strings hang in one chain; its top names them all
            further = up[up]
            if np.array_equal(further, up):
                break
            up = further
        first = np.arange(self.n)
        np.minimum.at(first, up, np.arange(self.n))
        return np.flatnonzero(first[up] < np.arange(self.n))
