"""Exact byte-pair merging of many words at once."""

from __future__ import annotations

import functools
import heapq
import json

import numpy as np

from millrace.llm.bpe_library import LETTERS

#: Words up to this many bytes are merged side by side in one matrix; longer ones one by one with a heap.
SIDE_BY_SIDE = 32
NONE = 1 << 30


class Merges:
    """The merge rules of a byte-level BPE file, as sorted pairs."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, vocab = spec["model"], spec["model"]["vocab"]
        if model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("a BPE that merges every word by its rules is needed")
        self.byte_ids = np.array([vocab[c] for c in LETTERS], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)  # by rank
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["content"]}
        size = max(max(vocab.values()), *self.special.values(), 0) + 1
        back = {c: b for b, c in enumerate(LETTERS)}
        self.bytes = [b""] * size
        for token, i in vocab.items():
            self.bytes[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        for token, i in self.special.items():
            self.bytes[i] = token.encode()

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the rule for each pair, NONE without one. A negative right side is no symbol."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((right >= 0) & (left >= 0) & (self.keys[at] == key), self.rank[at], NONE)

    def merge(self, words: list[bytes]) -> list[list[int]]:
        out: list[list[int]] = [[] for _ in words]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for low, high in ((1, 8), (9, 16), (17, SIDE_BY_SIDE)):
            for block in np.array_split(some := np.flatnonzero((sizes >= low) & (sizes <= high)), max(1, len(some) // 50_000)):
                if block.size:
                    for i, ids in zip(block.tolist(), self._together([words[i] for i in block], sizes[block], high), strict=True):
                        out[i] = ids
        for i in np.flatnonzero(sizes > SIDE_BY_SIDE):
            out[i] = self._alone(words[i])
        return out

    def _together(self, words: list[bytes], sizes: np.ndarray, width: int) -> list[list[int]]:
        """In each round every word has its lowest-ranked, leftmost pair merged, until none has a rule left."""
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
        ids = np.where(np.arange(width) < sizes[:, None], self.byte_ids[raw], -1)
        ids = np.concatenate([ids, np.full((len(words), 1), -1)], axis=1)
        ranks = self.ranks(ids[:, :-1], ids[:, 1:])
        done = np.empty_like(ids)
        row = np.arange(len(words))
        while row.size:
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(row.size), at]
            over = best == NONE
            if over.any():
                done[row[over]] = ids[over]
                going = ~over
                row, ids, ranks, at, best = row[going], ids[going], ranks[going], at[going], best[going]
                if not row.size:
                    break
            every, column = np.arange(row.size), np.arange(width)
            ids[every, at] = self.merged[best]
            after = column[None, :] > at[:, None]
            ids[:, :-1] = np.where(after, ids[:, 1:], ids[:, :-1])
            ids[:, -1] = -1
            ranks[:, :-1] = np.where(after[:, :-1], ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = NONE
            ranks[every, at] = self.ranks(ids[every, at], ids[every, at + 1])
            before = np.flatnonzero(at > 0)
            ranks[before, at[before] - 1] = self.ranks(ids[before, at[before] - 1], ids[before, at[before]])
        n = (done >= 0).sum(axis=1)
        return [line[:k] for line, k in zip(done.tolist(), n.tolist(), strict=True)]

    def _alone(self, word: bytes) -> list[int]:
        """One long word: pairs in a heap by (rank, place), symbols in a linked list."""
        ids = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        after, before = [*range(1, len(ids)), -1], [-1, *range(len(ids) - 1)]
        first = self.ranks(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != NONE]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.merged[rank]), -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] >= 0:
                    r = self.pair(ids[left], ids[after[left]])
                    if r != NONE:
                        heapq.heappush(heap, (r, left, ids[left], ids[after[left]]))
        return [x for x in ids if x >= 0]

    @functools.cached_property
    def table(self) -> dict[int, int]:
        return dict(zip(self.keys.tolist(), self.rank.tolist(), strict=True))

    def pair(self, a: int, b: int) -> int:
        return self.table.get(a << 32 | b, NONE)


@functools.lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)
