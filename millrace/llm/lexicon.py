"""A minimal acyclic transducer from words to token ids, in one file that readers memory-map.

Words with equal endings share states. Every transition carries the number of words that sort before those behind it,
so the sum along a word's path is the word's number, which the ids are stored by.
"""

from __future__ import annotations

import numpy as np

from millrace.llm.common import bounds

HEAD = np.dtype("<i8")
PARTS = (("keys", "<i8"), ("to", "<i4"), ("skip", "<i4"), ("final", "u1"), ("start", "<i8"), ("ids", "<u4"))


def compile_lexicon(words: dict[bytes, list[int]]) -> bytes:
    """The file's bytes. Words are added in order; a state is settled when no later word can pass it any more."""
    order = sorted(words)
    settled: dict[tuple, int] = {}
    final, count, edges = [], [], []

    def settle(node: list) -> int:
        mark = (node[0], tuple(node[1]))
        state = settled.get(mark)
        if state is None:
            state = settled[mark] = len(final)
            final.append(node[0])
            count.append(node[0] + sum(count[t] for _, t in node[1]))
            edges.append(mark[1])
        return state

    path: list[list] = [[0, []]]  # open states of the last word: [final, settled transitions]
    last = b""
    for word in order:
        common = 0
        while common < len(last) and common < len(word) and last[common] == word[common]:
            common += 1
        while len(path) > common + 1:
            state = settle(path.pop())
            path[-1][1].append((last[len(path) - 1], state))
        path.extend([0, []] for _ in word[common:])
        path[-1][0] = 1
        last = word
    while len(path) > 1:
        state = settle(path.pop())
        path[-1][1].append((last[len(path) - 1], state))
    root = settle(path[0])

    keys, to, skip = [], [], []
    for state, out in enumerate(edges):
        passed = final[state]
        for byte, target in out:
            keys.append(state << 8 | byte)
            to.append(target)
            skip.append(passed)
            passed += count[target]
    ids = [words[w] for w in order]
    arrays = {
        "keys": np.array(keys, np.int64),
        "to": np.array(to, np.int64),
        "skip": np.array(skip, np.int64),
        "final": np.array(final, np.int64),
        "start": bounds(np.fromiter(map(len, ids), np.int64, len(ids))),
        "ids": np.array([x for row in ids for x in row], np.int64),
    }
    head = np.array([root, *(len(arrays[name]) for name, _ in PARTS)], HEAD)
    return b"".join([head.tobytes(), *(arrays[name].astype(kind).tobytes() for name, kind in PARTS)])


class Lexicon:
    """Reads such a file through a memory map."""

    def __init__(self, path: str):
        head = np.fromfile(path, HEAD, 1 + len(PARTS))
        self.root, at = int(head[0]), head.nbytes
        for (name, kind), n in zip(PARTS, head[1:].tolist(), strict=True):
            dtype = np.dtype(kind)
            setattr(self, name, np.memmap(path, dtype, "r", at, (n,)) if n else np.zeros(0, dtype))
            at += n * dtype.itemsize

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 where it is not in the lexicon; all words walk side by side."""
        out = np.full(len(words), -1, np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        if not len(self.keys) or not len(words):
            return out
        text = np.frombuffer(b"".join(words), np.uint8)
        begin = bounds(sizes)[:-1]
        at = np.flatnonzero(sizes > 0)
        state, number, step = np.full(len(at), self.root, np.int64), np.zeros(len(at), np.int64), 0
        while at.size:
            key = state << 8 | text[begin[at] + step]
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = self.keys[edge] == key
            at, edge = at[known], edge[known]
            number, state = number[known] + self.skip[edge], self.to[edge].astype(np.int64)
            step += 1
            ended = sizes[at] == step
            full = ended & (self.final[state] > 0)
            out[at[full]] = number[full]
            at, state, number = at[~ended], state[~ended], number[~ended]
        return out

    def ids_of(self, number: int) -> list[int]:
        return self.ids[self.start[number] : self.start[number + 1]].tolist()
