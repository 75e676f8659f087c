"""Texts as codes of their pieces, for tokenizers whose tokens never cross certain places.

A piece is a run of white space and the run of other characters after it. A text is cut before white space that follows
something else, where neither the byte-level pattern nor the word marker of a piece model lets a token pass. A corpus
repeats its pieces, so each distinct one is solved once per batch, and a cache keeps solved ones from batch to batch.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from millrace.llm.common import bounds, ragged

PIECES = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
#: White space beyond ASCII, or characters that some take for it: such a text is one piece.
OTHER_SPACE = "\x1c-\x1f\x85\xa0  -     　"
WHOLE = re.compile(f"[{OTHER_SPACE}]")
#: Texts that the quick way, cutting at every space and line end, would cut wrongly.
UNEVEN = "[ \\n][ \\n]|[\\x00\\t\\x0b-\\r" + OTHER_SPACE + "]"

#: Pieces solved, or written out as ids, at once: what that needs besides does not grow with the batch.
AT_ONCE = 1 << 16


def cut(text: str) -> list[str]:
    return [text] if WHOLE.search(text) else PIECES.findall(text)


class Coded(NamedTuple):
    values: list[str]  # distinct pieces
    codes: np.ndarray  # index into values, of all pieces of all rows in order
    sizes: np.ndarray  # pieces of each row


def coded(column: pa.Array, cut: Callable[[str], list[str]] = cut, uneven: str = UNEVEN) -> Coded:
    """The pieces of a column of texts without nulls."""
    column = column.cast(pa.large_string())
    odd = np.asarray(pc.match_substring_regex(column, uneven).to_numpy(zero_copy_only=False), dtype=bool)
    even = column.filter(pa.array(~odd)) if odd.any() else column
    marked = pc.replace_substring(pc.replace_substring(even, "\n", "\0\n"), " ", "\0 ")
    lists = pc.split_pattern(marked, "\0")
    del marked
    flat, sizes = lists.flatten(), np.diff(np.asarray(lists.offsets, dtype=np.int64))
    del lists
    if odd.any():
        cuts = [cut(t) for t in column.filter(pa.array(odd)).to_pylist()]
        flat = pa.concat_arrays([flat, pa.array([p for c in cuts for p in c], pa.large_string())])
        order = np.argsort(np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)]), kind="stable")
        sizes = np.concatenate([sizes, np.array([len(c) for c in cuts], np.int64)])
        starts = bounds(sizes)[:-1][order]
        sizes = sizes[order]
    named = flat.dictionary_encode()
    del flat
    codes = np.asarray(named.indices, dtype=np.int64)
    if odd.any():
        codes = codes[ragged(starts, sizes)]
    return Coded(named.dictionary.to_pylist(), codes, sizes)


class PieceIds:
    """Token ids of pieces. A worker keeps those of pieces met twice in a batch, up to `limit` of them."""

    def __init__(self, solve: Callable[[list[str]], list], limit: int = 300_000):
        self.solve, self.limit = solve, limit
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.start, self.size, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def spans(self, pieces: Coded) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where those of each distinct piece begin, how many they are)."""
        values = pieces.values
        found = np.fromiter(map(self.index.get, values, [-1] * len(values)), np.int64, len(values))
        new = np.flatnonzero(found < 0)
        start, size = np.zeros(len(values), np.int64), np.zeros(len(values), np.int64)
        old = np.flatnonzero(found >= 0)
        start[old], size[old] = self.start[found[old]], self.size[found[old]]
        if not new.size:
            return self.flat, start, size
        flats, counts = [self.flat], []
        for at in range(0, len(new), AT_ONCE):
            solved = self.solve([values[i] for i in new[at : at + AT_ONCE]])
            counts.append(np.fromiter(map(len, solved), np.int64, len(solved)))
            flats.append(np.fromiter(itertools.chain.from_iterable(solved), np.uint32, int(counts[-1].sum())))
        flat, sizes = np.concatenate(flats), np.concatenate(counts)
        start[new], size[new] = bounds(sizes)[:-1] + len(self.flat), sizes
        # what one batch repeats, later ones are likely to have again
        again = new[np.bincount(pieces.codes, minlength=len(values))[new] > 1]
        again = again[np.fromiter((len(values[i]) <= 64 for i in again), bool, len(again))]
        if len(self.index) + len(again) > self.limit:
            self.clear()
        if len(self.index) + len(again) <= self.limit:
            at = range(len(self.index), len(self.index) + len(again))
            kept = size[again]
            begin = bounds(kept)[:-1] + len(self.flat)
            self.flat = np.concatenate([self.flat, flat[ragged(start[again], kept)]])
            self.start, self.size = np.concatenate([self.start, begin]), np.concatenate([self.size, kept])
            self.index.update(zip([values[i] for i in again], at, strict=True))
        return flat, start, size

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows one after another, where each row's ids begin and the last ones end)."""
        pieces = coded(column)
        flat, start, size = self.spans(pieces)
        ends = bounds(size[pieces.codes])
        ids = np.empty(ends[-1], np.uint32)
        for at in range(0, len(pieces.codes), AT_ONCE):
            codes = pieces.codes[at : at + AT_ONCE]
            ids[ends[at] : ends[at + len(codes)]] = flat[ragged(start[codes], size[codes])]
        return ids, ends[bounds(pieces.sizes)]
