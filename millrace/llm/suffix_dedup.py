"""Removal of long repeated byte strings with a run-length index (operator 3).

Every string of `LENGTH` bytes that also starts earlier, in a document with a smaller id or earlier in the same one, is
removed, wherever the two lie. Equal strings have to meet in one task without a global index:

1. Each such string (window) has an anchor, the smallest of the hashes of its `GRAM`-byte parts. Neighbouring windows with
   the same anchor make a context of some 140 bytes; equal windows have equal anchors. Contexts are named by hashes and
   dealt by their anchor. Equal contexts are one: all but the first are removed whole. This is where copies and hot
   passages collapse, first within each task.
2. Only different contexts with a common anchor can still share single windows. Their bytes are fetched from the
   documents, and each task builds a run-length index over what it has: matching statistics streamed from it give every
   window that also starts earlier. Where an anchor has very many different contexts (a frequent phrase), contexts are cut
   into parts that share more bytes around the anchor, so that its windows spread over many tasks.
3. All removed spans of a document are merged and the rest is hashed.

Rows with a null id count as the smallest id; rows that share an id are ordered by a hash of their text; equal rows are
one document, and each is returned. Null text counts as empty. Texts of less than `LENGTH` bytes lose nothing. An empty
table gives an empty result; extra columns are left behind.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from millrace.llm.common import bounds, ragged, ship, slices, written
from millrace.llm.run_length_index import RunLengthIndex

LENGTH = 100
GRAM = 24
#: Windows handled at once; a longer text is handled in parts that overlap.
BLOCK = 1 << 20
PLACE_BITS = 24
INDEX_BYTES = 1 << 20
#: Different contexts of an anchor from which they are cut, and how many windows a cut then holds.
CUTS = ((1_000, 19), (100_000, 1))
NO_ID = -(1 << 63)
SPAN = "k_id long, k_hash long, start long, size long"


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two random tables for bytes, powers of an odd base modulo 2^64, and of its inverse."""
    draw = np.random.default_rng(20240607)
    tables = draw.integers(0, 1 << 64, (2, 256), np.uint64, endpoint=False)
    base = 0x9E3779B97F4A7C15
    up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return tables, np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def parts(size: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first window, windows) of the parts that texts of these sizes are handled in."""
    windows = np.maximum(size - length + 1, 0)
    n = -(-windows // BLOCK)
    text = np.repeat(np.arange(len(size)), n)
    first = (np.arange(len(text)) - np.repeat(bounds(n)[:-1], n)) * BLOCK
    return text, first, np.minimum(windows[text] - first, BLOCK)


def contexts(data: np.ndarray, begin: np.ndarray, windows: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Contexts of parts of `data`: where each begins, its windows, the place of its anchor in it, and its two names."""
    n = len(data)
    tables, up, down = _powers(max(2 * BLOCK, 1 << int(n).bit_length()))

    def sums(k: int) -> np.ndarray:
        out = np.zeros(n + 1, np.uint64)
        np.cumsum(tables[k][data] * up[:n], dtype=np.uint64, out=out[1:])
        return out

    one = sums(0)
    named = mixed((one[gram:] - one[:-gram]) * down[: n - gram + 1])
    place = np.uint64((1 << PLACE_BITS) - 1)
    low = (named & ~place) | np.arange(len(named), dtype=np.uint64)
    width, have = length - gram + 1, 1
    while 2 * have <= width:
        low, have = np.minimum(low[:-have], low[have:]), 2 * have
    if have < width:
        low = np.minimum(low[: len(low) - (width - have)], low[width - have :])
    at = ragged(begin, windows)
    anchor = (low[at] & place).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(at)))
    first, anchor = at[head], anchor[head]
    other = sums(1)
    own = (other[first + count - 1 + length] - other[first]) * down[first]
    shape = (count.astype(np.uint64) << np.uint64(32)) | (anchor - first).astype(np.uint64)
    return {"first": first, "windows": count, "anchor": anchor - first, "key": named[anchor], "name": mixed(own ^ mixed(shape))}


ENTRY = (("k_id", "<i8"), ("k_hash", "<i8"), ("start", "<i8"), ("windows", "<i4"), ("anchor", "<i4"), ("key", "<u8"), ("name", "<u8"))
MARK = (("k_id", "<i8"), ("k_hash", "<i8"), ("start", "<i8"), ("size", "<i8"))


def squeeze(columns: dict[str, np.ndarray], layout) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(columns[c], kind).tobytes() for c, kind in layout))


def unsqueeze(blob: bytes, layout) -> dict[str, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, at, out = len(raw) // sum(np.dtype(k).itemsize for _, k in layout), 0, {}
    for name, kind in layout:
        out[name] = np.frombuffer(raw, kind, n, at)
        at += n * np.dtype(kind).itemsize
    return out


def stacked(parts: list[dict[str, np.ndarray]], layout) -> dict[str, np.ndarray]:
    return {c: np.concatenate([p[c] for p in parts]) if parts else np.zeros(0, kind) for c, kind in layout}


def split_first(e: dict[str, np.ndarray], names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(first entries of equal names, the others that stand elsewhere), as row numbers."""
    order = np.lexsort((e["start"], e["k_hash"], e["k_id"], *(e[n] for n in reversed(names))))
    same = np.ones(max(len(order) - 1, 0), bool)
    for n in names:
        same &= e[n][order][1:] == e[n][order][:-1]
    head = np.concatenate([[True], ~same])[: len(order)]
    first = np.repeat(order[head], np.diff(np.append(np.flatnonzero(head), len(order))))
    rest, of = order[~head], first[~head]
    elsewhere = (e["k_id"][rest] != e["k_id"][of]) | (e["k_hash"][rest] != e["k_hash"][of]) | (e["start"][rest] != e["start"][of])
    return order[head], rest[elsewhere]


def named_contexts(batches, buckets: int, length: int):
    """(bucket, entries, marks): contexts by anchor, and what is known to be removed from this task's texts alone."""
    for part in slices(batches, limit=2 * BLOCK):
        text = part.column("text").cast(pa.large_string())
        at = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1, text.offset * 8)
        data = np.frombuffer(text.buffers()[2], np.uint8, int(at[-1])) if text.buffers()[2] is not None else np.zeros(0, np.uint8)
        of, first, windows = parts(np.diff(at), length)
        k_id, k_hash = np.asarray(part.column("k_id")), np.asarray(part.column("k_hash"))
        # parts side by side up to the block size; one of its own where it is that long
        group = (np.cumsum(windows + length - 1) // (2 * BLOCK)) if len(of) else np.zeros(0, np.int64)
        entries, marks = [], []
        for g in np.unique(group):
            own = np.flatnonzero(group == g)
            take = ragged(at[of[own]] + first[own], windows[own] + length - 1)
            begin = bounds(windows[own] + length - 1)[:-1]
            c = contexts(data[take], begin, windows[own], length)
            row = np.searchsorted(begin, c["first"], side="right") - 1
            c["start"] = c["first"] - begin[row] + first[own][row]
            c["k_id"], c["k_hash"] = k_id[of[own][row]], k_hash[of[own][row]]
            keep, rest = split_first(c, ["key", "name"])
            entries.append({n: c[n][keep] for n, _ in ENTRY})
            marks.append({"k_id": c["k_id"][rest], "k_hash": c["k_hash"][rest], "start": c["start"][rest], "size": c["windows"][rest] + length - 1})
        e, m = stacked(entries, ENTRY), stacked(marks, MARK)
        if not len(e["key"]):
            continue
        bucket = (e["key"] % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((e["start"], e["k_hash"], e["k_id"], bucket))
        cut = np.flatnonzero(np.diff(bucket[order])) + 1
        rows = np.split(order, cut)
        blobs = [squeeze({n: e[n][r] for n, _ in ENTRY}, ENTRY) for r in rows]
        known: list[bytes | None] = [None] * len(rows)
        known[int(e["key"][0] >> np.uint64(20)) % len(rows)] = squeeze(m, MARK)  # with any bucket, a different one for each batch
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(bucket[r[0]]) for r in rows], pa.int32()), pa.array(blobs, pa.binary()), pa.array(known, pa.binary())],
            names=["bucket", "entries", "marks"],
        )


NEED = "key long, windows long, anchor long, cut long"


def meet(batches, length: int, cuts=CUTS):
    """For each bucket: spans to remove (key null), and contexts whose bytes have to be compared."""
    held, marks, bucket = [], [], None
    for batch in batches:
        for b, entries, own in zip(*(batch.column(c).to_pylist() for c in ("bucket", "entries", "marks")), strict=True):
            if b != bucket and held:
                yield decided(held, marks, length, cuts)
                held, marks = [], []
            bucket = b
            held.append(unsqueeze(entries, ENTRY))
            if own is not None:
                marks.append(unsqueeze(own, MARK))
    if held:
        yield decided(held, marks, length, cuts)


def decided(held: list, marks: list, length: int, cuts) -> pa.RecordBatch:
    e, m = stacked(held, ENTRY), stacked(marks, MARK)
    order = np.argsort(e["key"], kind="stable")
    key = e["key"][order]
    twin = np.zeros(len(key), bool)
    twin[1:] |= key[1:] == key[:-1]
    twin[:-1] |= key[1:] == key[:-1]
    e = {n: e[n][order[twin]] for n, _ in ENTRY}
    keep, rest = split_first(e, ["key", "name"])
    names, count = np.unique(e["key"][keep], return_counts=True)
    n = count[np.searchsorted(names, e["key"][keep])]
    ask, n = keep[n > 1], n[n > 1]
    cut = np.zeros(len(ask), np.int64)
    for most, windows in cuts:
        cut[n > most] = windows
    out = {
        "k_id": np.concatenate([m["k_id"], e["k_id"][rest], e["k_id"][ask]]),
        "k_hash": np.concatenate([m["k_hash"], e["k_hash"][rest], e["k_hash"][ask]]),
        "start": np.concatenate([m["start"], e["start"][rest], e["start"][ask]]),
        "size": np.concatenate([m["size"], e["windows"][rest] + length - 1, e["windows"][ask] + length - 1]),
    }
    none = np.zeros(len(m["k_id"]) + len(rest), np.int64)
    is_mark = np.concatenate([none == 0, np.zeros(len(ask), bool)])
    more = {"key": e["key"][ask].view(np.int64), "windows": e["windows"][ask], "anchor": e["anchor"][ask], "cut": cut}
    return pa.RecordBatch.from_arrays(
        [*(pa.array(out[n].astype(np.int64)) for n, _ in MARK), *(pa.array(np.concatenate([none, more[c].astype(np.int64)]), mask=is_mark) for c in more)],
        names=[*out, *more],
    )


def fetch(batches, length: int):
    """The bytes of contexts, or of their parts, from (z, needs) of each document.

    Of equal parts in one batch only the first goes on; the others are spans to remove, which have no bytes. Equal rows
    give the same parts at the same places: those are one, here, and where they come from several batches in `matched`.
    """
    unpack = zstandard.ZstdDecompressor()
    for part in slices(batches, "z", 1 << 20):
        rows, parted = [], []
        for k_id, k_hash, z, needs in zip(*(part.column(c).to_pylist() for c in ("k_id", "k_hash", "z", "needs")), strict=True):
            text = unpack.decompress(z)
            for need in needs:
                start, windows, step = need["start"], need["windows"], need["cut"]
                piece = text[start : start + windows + length - 1]
                if step:
                    parted += [(key, k_id, k_hash, at, own) for key, at, own in cut_context(piece, start, windows, need["anchor"], step, length)]
                else:
                    rows.append((need["key"], k_id, k_hash, start, piece, len(piece)))
        met: set = set()
        for key, k_id, k_hash, at, piece in sorted(set(parted)):
            new = (key, piece) not in met
            met.add((key, piece))
            rows.append((key, k_id, k_hash, at, piece, len(piece)) if new else (k_id ^ at, k_id, k_hash, at, None, len(piece)))
        columns = zip(*rows, strict=True) if rows else [()] * 6
        kinds = (*[pa.int64()] * 4, pa.binary(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(columns, kinds, strict=True)], names=["key", "k_id", "k_hash", "start", "bytes", "size"])


def cut_context(piece: bytes, start: int, windows: int, anchor: int, step: int, length: int):
    """Parts of a context of `step` windows each, by how far before the anchor they begin; each is keyed by what all share."""
    for c in range(anchor // step + 1):
        last = anchor - c * step  # of these windows the last one, and the first one
        first = last - step + 1
        a, b = max(first, 0), min(last, windows - 1)
        if a <= b:
            core = piece[last : first + length]
            named = hashlib.blake2b(core, digest_size=8, key=c.to_bytes(2, "little")).digest()
            yield int.from_bytes(named, "little", signed=True), start + a, piece[a : b + length]


def compare(batches, length: int):
    """Windows that also start earlier, found by an index over contexts that share a key."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        known = pc.is_null(batch.column("bytes"))
        if pc.any(known).as_py():
            yield batch.filter(known).select(["k_id", "k_hash", "start", "size"])
            batch = batch.filter(pc.invert(known))
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.column("bytes").nbytes
        if n >= INDEX_BYTES:
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            key = np.asarray(table.column("key"))
            whole = int(np.searchsorted(key, key[-1], side="left"))
            at = 0
            size = np.cumsum(np.asarray(pc.binary_length(table.column("bytes")), dtype=np.int64))
            while at < whole:
                base = size[at - 1] if at else 0
                to = min(whole, max(at + 1, int(np.searchsorted(size, base + INDEX_BYTES, side="right"))))
                to = int(np.searchsorted(key, key[to - 1], side="right"))  # a key's contexts stay together
                yield matched(table.slice(at, to - at), length)
                at = to
            held, n = [table.slice(whole)], table.slice(whole).column("bytes").nbytes
    if held:
        yield matched(pa.Table.from_batches(held).combine_chunks().to_batches()[0], length)


def matched(rows: pa.RecordBatch, length: int) -> pa.RecordBatch:
    """Rows are sorted by (key, document, start)."""
    columns = {c: np.asarray(rows.column(c)) for c in ("key", "k_id", "k_hash", "start")}
    once = np.ones(rows.num_rows, bool)
    once[1:] = np.any([columns[c][1:] != columns[c][:-1] for c in columns], axis=0)
    pieces = rows.column("bytes").filter(pa.array(once))
    columns = {c: v[once] for c, v in columns.items()}
    size = np.asarray(pc.binary_length(pieces), dtype=np.int64)
    found = RunLengthIndex(np.frombuffer(b"".join(pieces.to_pylist()), np.uint8), size).later_matches(length)
    head = np.ones(len(found), bool)
    begin = bounds(size)
    row = np.searchsorted(begin, found, side="right") - 1
    head[1:] = (found[1:] != found[:-1] + 1) | (row[1:] != row[:-1])
    at = np.flatnonzero(head)
    run = np.diff(np.append(at, len(found)))
    row, first = row[at], found[at]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns["k_id"][row]), pa.array(columns["k_hash"][row]), pa.array(columns["start"][row] + first - begin[row]), pa.array(run + length - 1)],
        names=["k_id", "k_hash", "start", "size"],
    )


def merged(spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of the maximal runs that spans (start, size) cover."""
    if not len(spans):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    end = np.maximum.accumulate(spans[:, 0] + spans[:, 1])
    new = np.concatenate([[True], spans[1:, 0] > end[:-1]])
    return spans[new, 0], end[np.append(np.flatnonzero(new)[1:] - 1, len(spans) - 1)]


def rest_of(batches):
    """What is left of each document."""
    unpack = zstandard.ZstdDecompressor()
    for part in slices(batches, "z", 1 << 20):
        out: list[list] = [[], [], [], []]
        for z, spans in zip(part.column("z").to_pylist(), part.column("spans").to_pylist(), strict=True):
            text = unpack.decompress(z)
            begin, end = merged(np.array([(s["start"], s["size"]) for s in spans or ()], np.int64).reshape(-1, 2))
            kept = b"".join(text[a:b] for a, b in zip([0, *end.tolist()], [*begin.tolist(), len(text)], strict=True))
            for column, value in zip(out, (len(text), len(text) - len(kept), len(begin), kept), strict=True):
                column.append(value)
        kinds = (*[pa.int64()] * 3, pa.binary())
        yield pa.RecordBatch.from_arrays(
            [part.column("row"), *(pa.array(x, k) for x, k in zip(out, kinds, strict=True))], names=["row", "n_bytes", "n_removed", "n_spans", "kept"]
        )


def packed_texts(plain: DataFrame) -> DataFrame:
    """Texts compressed one by one, for the joins that move them; other columns as they are."""
    names = [c for c in plain.columns if c != "text"]

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for part in slices(batches):
            z = pa.array([pack.compress(t.encode()) for t in part.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), z], names=[*names, "z"])

    return plain.mapInArrow(run, StructType([plain.schema[n] for n in names] + [StructField("z", BinaryType())]))


def kept_bytes(df: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text", cuts=CUTS) -> DataFrame:
    """(row, n_bytes, n_removed, n_spans, kept): for each row its columns but the text, and what is left of that, as bytes."""
    ship(df.sparkSession)
    own = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    others = [F.col(f"`{c}`") for c in df.columns if c != text]
    plain = df.select(
        F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(NO_ID)).alias("k_id"), F.xxhash64(own).alias("k_hash"), F.struct(*others).alias("row"), own.alias("text")
    )
    buckets = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = plain.select("k_id", "k_hash", "text").mapInArrow(
        lambda batches: named_contexts(batches, buckets, length), "bucket int, entries binary, marks binary"
    )
    met = names.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(lambda batches: meet(batches, length, cuts), f"{SPAN}, {NEED}")
    found = written(met, "contexts")
    squeezed = packed_texts(plain.select("k_id", "k_hash", "text"))
    needs = (
        found.where("key IS NOT NULL")
        .groupBy("k_id", "k_hash")
        .agg(F.collect_list(F.struct("start", "windows", "anchor", "key", "cut")).alias("needs"))
    )
    asked = squeezed.join(needs, ["k_id", "k_hash"]).select("k_id", "k_hash", "z", "needs")
    pieces = asked.mapInArrow(
        lambda batches: fetch(batches, length), "key long, k_id long, k_hash long, start long, bytes binary, size long"
    )
    compared = (
        pieces.repartition("key").sortWithinPartitions("key", "k_id", "k_hash", "start").mapInArrow(lambda batches: compare(batches, length), SPAN)
    )
    spans = (
        found.where("key IS NULL")
        .select("k_id", "k_hash", "start", "size")
        .union(compared)
        .groupBy("k_id", "k_hash")
        .agg(F.collect_list(F.struct("start", "size")).alias("spans"))
    )
    whole = packed_texts(plain).join(spans, ["k_id", "k_hash"], "left").select("row", "z", "spans")
    counts = [StructField(n, LongType()) for n in ("n_bytes", "n_removed", "n_spans")]
    return whole.mapInArrow(rest_of, StructType([plain.schema["row"], *counts, StructField("kept", BinaryType())]))


def digests(df: DataFrame, length: int = LENGTH, cuts=CUTS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    return kept_bytes(df, length, cuts=cuts).select(F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def clean_documents(df: DataFrame, length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows of `df` with all their columns, their text without what starts earlier.

    A character of which only some bytes are left is not text any more and goes too.
    """
    left = kept_bytes(df, length, doc_id, text)
    rest = F.try_validate_utf8(F.col("kept").cast("string"))
    sound = F.when(rest.isNotNull(), rest).otherwise(F.regexp_replace(F.make_valid_utf8(F.col("kept").cast("string")), "\ufffd", ""))
    return left.select(*((sound if c == text else F.col(f"row.`{c}`")).alias(c) for c in df.columns))
