"""Periodic runs of words by online dyadic square catching (operator 12).

Words are appended one after another. Every completed block of 2^k words is a catcher: it waits for its own words to come
again at a distance of 2^k to 2^(k+1)-1 words, which is a square's second half beginning. For a word that is appended, at
each level exactly one catcher has that distance, so a word costs one suffix comparison a level. A comparison is one of
hashes, kept for all windows of 2^k words and doubled from level to level; where two neighbouring catchers of a level
report the same distance, the square is extended to both sides by leaps of falling powers of two, and squares of one
distance that touch are one run. A run of period q has at least 4 * q words, so for 2^k <= q < 2^(k+1) two neighbouring
catchers always lie in it: nothing is missed, wherever the blocks begin. A run is reported with its smallest period, and
the words of each are compared themselves before it is.

Texts of a slice are appended behind one another with a mark of their own between them, the longest first, so that each
level works on a front part of the arrays. The comparisons of a level are made for all appended words at once.

A null text counts as empty and has no runs. Every row is returned, repeated ones too; of rows without an id the text stays
as it is in `damaged`. Of ties for the greatest exponent the smallest start counts, then the smallest period. Long texts
are worked on whole, alone in their slice, with some 8 bytes a word and level. An empty table gives an empty result; extra
columns are left behind.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import from_arrow_schema

from millrace.llm.common import bounds, slices, texts
from millrace.llm.word_table import WordTable, mixed, word_table

#: A run has this many words at least, and this many times its period.
LEAST_WORDS = 6
LEAST_POWER = 4
#: Text appended at once; windows of all levels are held for it.
APPEND_BYTES = 4 << 20


class SquareCatcher:
    """Catchers over one sequence of 64-bit words, with marks that occur once between its texts.

    `live[k]`: how many words, from the front, level k works on; texts behind are too short for its periods.
    """

    def __init__(self, words: np.ndarray, live: list[int]):
        self.level = [words]
        for k, n in enumerate(live[1:]):
            window, half = self.level[k][:n], 1 << k
            self.level.append(mixed(window[:-half] * np.uint64(0x9E3779B97F4A7C15) + window[half:]) if n > half else window[:0])

    def caught(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(begin of the catcher, distance) where a row of neighbouring catchers of level k with one distance begins."""
        window, block = self.level[k], 1 << k
        word = np.arange(block, len(window))
        catcher = (word // block - 1) * block
        again = np.zeros(len(window) + block, bool)
        again[word] = window[catcher] == window[word]
        # the neighbour with the same distance is the catcher one block on, compared at the word one block on
        first = np.flatnonzero(again[: len(window)] & again[block:])
        first = first[~again[first - block]]
        return (first // block - 1) * block, first - (first // block - 1) * block

    def reach(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """How many words from `left` on equal those from `right` on."""
        out = np.zeros(len(left), np.int64)
        for k in range(len(self.level) - 1, -1, -1):
            window, block = self.level[k], 1 << k
            todo = np.arange(len(left))
            while todo.size:
                todo = todo[right[todo] + out[todo] < len(window)]
                todo = todo[window[left[todo] + out[todo]] == window[right[todo] + out[todo]]]
                out[todo] += block
        return out

    def reach_back(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """How many words that end before `left` equal those that end before `right`."""
        out = np.zeros(len(left), np.int64)
        for k in range(len(self.level) - 1, -1, -1):
            window, block = self.level[k], 1 << k
            todo = np.arange(len(left))
            while todo.size:
                todo = todo[(left[todo] - out[todo] >= block) & (right[todo] - out[todo] - block < len(window))]
                todo = todo[window[left[todo] - out[todo] - block] == window[right[todo] - out[todo] - block]]
                out[todo] += block
        return out

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, smallest period) of all runs, by start and period."""
        found = [np.zeros((3, 0), np.int64)]
        for k in range(len(self.level)):
            at, period = self.caught(k)
            if not at.size:
                continue
            start = at - self.reach_back(at, at + period)
            length = at + period + self.reach(at, at + period) - start
            keep = length >= np.maximum(LEAST_WORDS, LEAST_POWER * period)
            found.append(np.stack([start[keep], length[keep], period[keep]]))
        start, length, period = np.concatenate(found, axis=1)
        # a run that has a smaller period too was caught with it: same start and length
        order = np.lexsort((period, length, start))
        start, length, period = start[order], length[order], period[order]
        new = np.ones(len(start), bool)
        new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
        start, length, period = start[new], length[new], period[new]
        order = np.lexsort((period, start))
        return start[order], length[order], period[order]


def text_runs(words: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of each of several texts, given as arrays of word hashes."""
    order = sorted(range(len(words)), key=lambda i: -len(words[i]))
    sizes = np.array([len(words[i]) + 1 for i in order], np.int64)
    begin = bounds(sizes)
    row = np.empty(int(begin[-1]), np.uint64)
    for i, at in zip(order, begin[:-1].tolist(), strict=True):
        row[at : at + len(words[i])] = words[i]
    # the marks count down from the largest number; words keep clear of them
    marks = np.uint64(0xFFFFFFFFFFFFFFFF) - np.arange(len(order), dtype=np.uint64)
    row[row >= (marks[-1] if len(marks) else 0)] >>= np.uint64(1)
    row[begin[1:] - 1] = marks
    live = [len(row)]
    while (n := int(begin[np.searchsorted(-(sizes - 1), -(LEAST_POWER << len(live)), side="right")])) > 0:
        live.append(n)
    start, length, period = SquareCatcher(row, live).runs()
    at = np.searchsorted(start, begin)
    out: list = [None] * len(words)
    for place, i in enumerate(order):
        part = slice(at[place], at[place + 1])
        out[i] = (start[part] - begin[place], length[part], period[part])
    return out


def exact(words: list[bytes], runs: tuple[np.ndarray, np.ndarray, np.ndarray]) -> bool:
    """Whether the words of each run are equal themselves, and not only their hashes."""
    return all(words[s : s + n - q] == words[s + q : s + n] for s, n, q in zip(*(x.tolist() for x in runs), strict=True))


def damaged(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which word stands at each place of a text of n words, where some texts get a tail that repeats; None: all as they are."""
    if doc_id is None or not n or (h := zlib.crc32(str(doc_id).encode())) % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    place = np.arange(n)
    place[a:] = a + (place[a:] - a) % p
    return place


def scanned(
    df: DataFrame, finish: Callable, schema: pa.Schema, change: Callable | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """A row for each row: `finish(doc_id, words, runs)` gives it, for the words after `change(doc_id, number of words)`."""

    def run(batches):
        for part in slices(batches, limit=APPEND_BYTES):
            ids = part.column("doc_id").to_pylist()
            table = word_table(part.column("text"))
            hashes = table.hashes()
            sizes = np.diff(table.first)
            places = [change(i, n) if change else None for i, n in zip(ids, sizes.tolist(), strict=True)]
            own = [hashes[table.first[t] : table.first[t + 1]] for t in range(len(ids))]
            own = [h if p is None else h[p] for h, p in zip(own, places, strict=True)]
            rows = []
            for t, (found, h) in enumerate(zip(text_runs(own), own, strict=True)):
                words = _words(table, t)
                if places[t] is not None:
                    words = [words[i] for i in places[t].tolist()]
                if not exact(words, found):  # two words share a hash: number the words of this text instead
                    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
                    found = text_runs([mixed(np.array([number[w] for w in words], np.uint64))])[0]
                rows.append(finish(ids[t], words, found))
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return texts(df, doc_id, text).mapInArrow(run, from_arrow_schema(schema))


def _words(table: WordTable, t: int) -> list[bytes]:
    a, b = int(table.first[t]), int(table.first[t + 1])
    return table.data[table.start[a] : table.end[b - 1]].tobytes().split() if b > a else []


def collapsed(words: list[bytes], runs: tuple[np.ndarray, np.ndarray, np.ndarray]) -> list[bytes]:
    """The words but those of a run after its first period."""
    start, length, period = runs
    if not len(start):
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    np.add.at(gone, start + period, 1)
    np.add.at(gone, start + length, -1)
    keep = np.cumsum(gone[:-1]) == 0
    return [w for w, k in zip(words, keep.tolist(), strict=True) if k]


def runs(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, runs, text): every run as (start, length, period) in words, and the text without repetitions, its words
    joined by one space."""

    def finish(i, words, found):
        spans = [dict(zip(("start", "length", "period"), r, strict=True)) for r in zip(*(x.tolist() for x in found), strict=True)]
        return {"doc_id": i, "runs": spans, "text": b" ".join(collapsed(words, found)).decode()}

    span = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
    schema = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(span)), ("text", pa.string())])
    return scanned(df, finish, schema, None, doc_id, text)


def run_digests(df: DataFrame) -> DataFrame:
    """A row for each document, after `damaged`: its number of runs, the one with the greatest exponent, and digests."""

    def finish(i, words, found):
        spans = list(zip(*(x.tolist() for x in found), strict=True))
        best = spans[0] if spans else (None, None, None)
        for s, n, q in spans[1:]:
            if n * best[2] > best[1] * q:  # spans come by start, then period: the first of equals stays
                best = (s, n, q)
        return {
            "doc_id": i,
            "n_runs": len(spans),
            "start": best[0],
            "length": best[1],
            "period": best[2],
            "exponent_milli": 1000 * best[1] // best[2] if spans else None,
            "runs_sha256": hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in spans).encode()).hexdigest(),
            "collapsed_sha256": hashlib.sha256(b" ".join(collapsed(words, found))).hexdigest(),
        }

    numbers = [(c, pa.int64()) for c in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli")]
    return scanned(df, finish, pa.schema([*numbers, ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())]), damaged)
