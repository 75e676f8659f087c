"""Token ids as length-delimited binary records (operator 1).

A record is: length (8 bytes), masked CRC-32C of the length, payload, masked CRC-32C of the payload, all little-endian;
readers of the common TFRecord framing can read the files. The payload is the document id (8 bytes, signed) and its
ids, of 2 bytes where the vocabulary fits into them, else 4. Beside each file `x.rec` lies `x.idx`: the place of every
record (8 bytes each) and of the file's end, for reads in any order.

Documents are range-partitioned by id and sorted, so files in the order of their names hold ascending ids; equal ids are
ordered by their text, rows without an id by a hash of theirs, as they may be many. A file appears under its name only when it is complete, so a repeated or lost task does no harm.

Null text counts as empty, long texts are taken whole; a document without tokens still has its end id. Rows with a null id get the id -2^63 in the
files and come back as null, first. Empty tables give no records. Extra columns change nothing.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.bpe_library import library_ids, vocab_size
from millrace.llm.checksums import crc32c, masked
from millrace.llm.common import bounds, ragged, shared_folder, slices, store_of, texts, written
from millrace.operators.joins import task_salt

NULL_ID = -(1 << 63)
FRAME = 16  # bytes around a payload
READ_BYTES = 8 << 20


def frame(payload: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of the records, size of each record) for payloads one after another."""
    whole = sizes + FRAME
    at = bounds(whole)[:-1]
    out = np.zeros(int(whole.sum()), np.uint8)
    length = np.ascontiguousarray(sizes.astype("<u8")).view(np.uint8)
    eight = np.full(len(sizes), 8, np.int64)
    out[ragged(at, eight)] = length
    out[ragged(at + 8, eight // 2)] = masked(crc32c(length, eight)).astype("<u4").view(np.uint8)
    out[ragged(at + 12, sizes)] = payload
    out[ragged(at + 12 + sizes, eight // 2)] = masked(crc32c(payload, sizes)).astype("<u4").view(np.uint8)
    return out, whole


def unframe(data: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(payloads, size of each) of the records at `at` of the given whole sizes; raises where a checksum is wrong."""
    eight = np.full(len(at), 8, np.int64)
    length = np.ascontiguousarray(data[ragged(at, eight)])
    inner = length.view("<u8").astype(np.int64)
    if not np.array_equal(inner + FRAME, sizes):
        raise ValueError("a record's length differs from the index")
    payload = data[ragged(at + 12, inner)]
    four = eight // 2
    said = np.ascontiguousarray(data[ragged(at + 8, four)]).view("<u4"), np.ascontiguousarray(data[ragged(at + 12 + inner, four)]).view("<u4")
    if not np.array_equal(said[0], masked(crc32c(length, eight))) or not np.array_equal(said[1], masked(crc32c(payload, inner))):
        raise ValueError("a record's checksum is wrong")
    return payload, inner


def put(store: fs.FileSystem, path: str, parts: Iterable[bytes]) -> None:
    """A file that has its name only when it is whole."""
    draft = f"{path}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(draft) as out:
        for part in parts:
            out.write(part)
    store.move(draft, path)


def write_records(df: DataFrame, folder: str, tokenizer_path: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes every whole text's ids and `end_id`; returns (shard, records, tokens), a row per file."""
    width = 2 if max(vocab_size(tokenizer_path) - 1, end_id) < 1 << 16 else 4
    store, path = store_of(folder)
    store.create_dir(path, recursive=True)

    def run(batches):
        shard, store, path = TaskContext.get().partitionId(), *store_of(folder)
        places, count = [np.zeros(1, np.int64)], [0, 0]

        def parts() -> Iterator[bytes]:
            for part in slices(batches):
                ids, at = library_ids(tokenizer_path).encode(part.column("text"))
                n = np.diff(at)
                keys = np.array([NULL_ID if x is None else x for x in part.column("doc_id").to_pylist()], "<i8")
                sizes = 8 + (n + 1) * width
                begin = bounds(sizes)[:-1]
                payload = np.zeros(int(sizes.sum()), np.uint8)
                payload[ragged(begin, np.full(len(n), 8, np.int64))] = keys.view(np.uint8)
                payload[ragged(begin + 8, n * width)] = ids.astype(f"<u{width}").view(np.uint8)
                ends = np.full(len(n), end_id, f"<u{width}").view(np.uint8)
                payload[ragged(begin + 8 + n * width, np.full(len(n), width, np.int64))] = ends
                data, whole = frame(payload, sizes)
                places.append(places[-1][-1] + np.cumsum(whole))
                count[0] += len(n)
                count[1] += int(n.sum()) + len(n)
                yield data.tobytes()

        put(store, f"{path}/{shard:06d}.rec", parts())
        put(store, f"{path}/{shard:06d}.idx", [np.concatenate(places).astype("<i8").tobytes()])
        yield pa.RecordBatch.from_pydict({"shard": [shard], "records": [count[0]], "tokens": [count[1]]})

    # rows without an id may be many: they go by a hash of the text, and equal ones of them by the task they come from
    nameless = F.when(F.col("doc_id").isNull(), F.xxhash64("text")), F.when(F.col("doc_id").isNull(), task_salt())
    dealt = texts(df, doc_id, text).select("*", nameless[0].alias("hash"), nameless[1].alias("task"))
    ordered = dealt.repartitionByRange("doc_id", "hash", "task").sortWithinPartitions("doc_id", "hash", "text").drop("hash", "task")
    # one job: its few rows, one per file, are the list of what is there
    return written(ordered.mapInArrow(run, "shard long, records long, tokens long"), "shards")


class RecordFile:
    """Reads a record file by its index, in any order."""

    def __init__(self, folder: str, shard: int):
        self.store, path = store_of(folder)
        self.path = f"{path}/{shard:06d}.rec"
        with self.store.open_input_stream(f"{path}/{shard:06d}.idx") as source:
            self.places = np.frombuffer(source.read(), "<i8")

    def __len__(self) -> int:
        return len(self.places) - 1

    def runs(self, limit: int = READ_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Payloads of neighbouring records, about `limit` bytes at a time, from the first to the last."""
        with self.store.open_input_file(self.path) as source:
            i = 0
            while i < len(self):
                j = max(i + 1, int(np.searchsorted(self.places, self.places[i] + limit, side="right")) - 1)
                source.seek(int(self.places[i]))
                data = np.frombuffer(source.read(int(self.places[j] - self.places[i])), np.uint8)
                yield unframe(data, self.places[i:j] - self.places[i], np.diff(self.places[i : j + 1]))
                i = j

    def record(self, i: int) -> bytes:
        """The payload of record `i`."""
        with self.store.open_input_file(self.path) as source:
            source.seek(int(self.places[i]))
            size = int(self.places[i + 1] - self.places[i])
            return unframe(np.frombuffer(source.read(size), np.uint8), np.zeros(1, np.int64), np.array([size]))[0].tobytes()


def parse(payload: bytes, width: int) -> tuple[int | None, np.ndarray]:
    key = struct.unpack_from("<q", payload)[0]
    return (None if key == NULL_ID else key), np.frombuffer(payload, f"<u{width}", offset=8)


def read_records(spark: SparkSession, folder: str, shards: DataFrame, width: int) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of all records, read back from the files, a task per file."""
    # a row for each file, which is bounded by the number of tasks that wrote them
    found = sorted((r["shard"], r["tokens"]) for r in shards.collect())
    first = dict(zip((s for s, _ in found), bounds(np.array([t for _, t in found], np.int64))[:-1].tolist(), strict=True))
    base = np.full(max(first, default=-1) + 1, -1, np.int64)
    base[list(first)] = list(first.values())

    def run(batches):
        for batch in batches:
            for shard in batch.column("id").to_pylist():
                if base[shard] < 0:
                    continue
                start = int(base[shard])
                for payload, sizes in RecordFile(folder, shard).runs():
                    n = (sizes - 8) // width
                    at, raw = bounds(sizes), payload.tobytes()
                    keys, sums = [], []
                    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                        key, ids = parse(raw[a:b], width)
                        keys.append(key)
                        sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
                    begin = start + bounds(n)
                    start = int(begin[-1])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys, pa.int64()), pa.array(begin[:-1]), pa.array(n), pa.array(sums, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    count = max(1, len(base))
    return spark.range(0, len(base), 1, count).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def record_digests(df: DataFrame, tokenizer_path: str, end_id: int = 2, folder: str | None = None) -> DataFrame:
    """Writes the records of `df` and reads them back."""
    spark = df.sparkSession
    folder = folder or shared_folder(spark, "records")
    shards = write_records(df, folder, tokenizer_path, end_id)
    width = 2 if max(vocab_size(tokenizer_path) - 1, end_id) < 1 << 16 else 4
    return read_records(spark, folder, shards, width)
