"""Packing documents into sequences by bounded-space online best fit (operator 9).

Documents longer than a sequence are cut into whole sequences, the first piece taking what is left over. Pieces are
dealt to groups of about `GROUP_TOKENS` tokens by a hash, and each group is packed in one pass: a bounded number of bins is
open, kept in a bit set by free space; a piece goes where the least space stays free, and when too many bins are open the
fullest closes. A whole-sequence piece is a sequence of its own at once.

Null text counts as empty: its one piece holds the end id. Equal rows are packed each on its own. Rows with a null id
are packed too. An empty table gives no pieces. Extra columns change nothing.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bpe_library import library_ids
from millrace.llm.common import slices, texts, written

OPEN_BINS = 1024
GROUP_TOKENS = 64 << 20
#: Text encoded at once, or a single one: larger slices repeat more pieces, which is quicker, and take more of a worker's memory.
READ_BYTES = 4 << 20
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, row long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class OpenBins:
    """Open bins by free space. Bit f of `some` says that `bins[f]` is not empty."""

    def __init__(self, capacity: int, most: int = OPEN_BINS):
        self.capacity, self.most = capacity, most
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.some, self.open, self.made = 0, 0, 0

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) for a piece of 1 to `capacity`."""
        fitting = self.some >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            bin_ = self.take(free)
        else:
            if self.open >= self.most:
                self.take((self.some & -self.some).bit_length() - 1)  # the fullest closes
            free, bin_ = self.capacity, self.made
            self.made += 1
        if free > length:
            rest = free - length
            self.bins[rest].append(bin_)
            self.some |= 1 << rest
            self.open += 1
        return bin_, self.capacity - free

    def take(self, free: int) -> int:
        bin_ = self.bins[free].pop()
        if not self.bins[free]:
            self.some &= ~(1 << free)
        self.open -= 1
        return bin_


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces."""
    first = total % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, total, capacity))] if total else []


def pieces(df: DataFrame, tokenizer_path: str, end_id: int, capacity: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each piece of every whole text with its end id; `row` tells equal rows apart within a task."""

    def run(batches):
        row = 0
        for part in slices(batches, limit=READ_BYTES):
            ids, at = library_ids(tokenizer_path).encode(part.column("text"))
            out: list[list] = [[], [], [], [], [], []]
            for key, a, b in zip(part.column("doc_id").to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                own = np.append(ids[a:b], end_id).astype("<u4")
                row += 1
                for k, (start, length) in enumerate(cut(len(own), capacity)):
                    for column, value in zip(out, (key, k, start, length, zlib.crc32(own[start : start + length].tobytes()), row), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), *[pa.int64()] * 4)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(out, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32", "row"]
            )
            pa.default_memory_pool().release_unused()  # a worker lives on, beside the next stage's

    return texts(df, doc_id, text).mapInArrow(run, PIECES)


def pack(found: DataFrame, capacity: int, open_bins: int = OPEN_BINS, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Sequences for written pieces. The order within a group is by hash, so it is the same when a task is repeated."""
    total = found.agg(F.sum("length")).first()[0] or 0
    groups = int(total // group_tokens) + 1
    mix = F.xxhash64("doc_id", "piece", "row")

    def run(batches):
        bins, key = OpenBins(capacity, open_bins), None
        for batch in batches:
            at = []
            for group, length in zip(batch.column("pack_group").to_pylist(), batch.column("length").to_pylist(), strict=True):
                if group != key:
                    bins, key = OpenBins(capacity, open_bins), group
                at.append((group, *bins.place(length)))
            group, bin_, offset = np.array(at, np.int64).reshape(-1, 3).T
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(bin_ * groups + group), pa.array(offset)], names=[*names, "sequence_id", "offset"]
            )

    dealt = found.withColumn("pack_order", mix).withColumn("pack_group", F.pmod(F.col("pack_order"), F.lit(groups)))
    # a group is bounded by its tokens, whatever the documents; as many groups as tokens need
    placed = dealt.repartition(groups, "pack_group").sortWithinPartitions("pack_group", "pack_order", "doc_id", "piece", "row", "ids_crc32")
    return placed.mapInArrow(run, PACKED)


def packed(df: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All texts of `df` as pieces in sequences of at most `capacity` tokens."""
    return pack(written(pieces(df, tokenizer_path, end_id, capacity, doc_id, text), "pieces"), capacity)
