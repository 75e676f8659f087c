"""Documents whose shingle sets are alike, by a size-aware join of light and heavy sets (operator 11).

Texts with the same words in the same order have the same set and are one node. Two nodes link when their sets' Jaccard
similarity reaches `percent`, that is when they share `needed(s, t)` of their s and t shingles. A boundary on the set size
splits the work:

- Light sets list their subsets. A set of s shingles emits, for each size t of a possible partner, its subsets of
  needed(s, t) shingles; two light sets link exactly when they share such a subset, and all sets that meet in one hang from
  its first set, so no pairs are made.
- Heavy sets, and light ones that can link with a heavy one, scan inverted lists. The rarest s - needed + 1 shingles of a set
  are enough: of two sets that link, one lies in a list of these that the other lies in too. Lists with one set go at once.
- The boundary is the size up to which listing subsets costs less than scanning lists, both counted on the table's own
  light sets: subsets that would be made against entries and what their lists hold.

How rare a shingle is comes from a sketch of fixed size in which every task adds up its distinct texts; it only orders the
shingles, so an error in it costs time and never a link. A shingle that a large share of all texts has is at the end of the
order and is in no list but those of sets made of nothing else.

A list is not expanded into pairs. How many of their shingles fall into each of 64 classes bounds what two sets can share;
of short lists only sets stay that may link with another one there. Each set is then held against the one in the middle of
the list's sets of its size, which settles groups of near copies; lists whose sets are all connected by then are done. In the
others, sets that are not yet connected are compared in tiles by 256 classes, and pairs that pass are held against each
other: as profiles of as many classes as there are shingles, and what passes that shingle by shingle. Lists of many sets are
dealt out as pairs of parts.

Shingles are compared by 64-bit hashes, texts by 128-bit ones. Null and empty texts, and texts without words, have no
shingles and link with nothing. Rows with a null id have a component like others, named by the smallest id in it, or null
where there is none. Repeated rows are each returned. Long texts are handled whole, alone in their slice. An empty table
gives an empty result; extra columns are left behind.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bounds, discard, slices, texts, written
from millrace.llm.simhash import components
from millrace.llm.word_table import mixed, shingle_table, word_table

SHINGLE = 5
PERCENT = 80
#: Text worked on at once.
PART_BYTES = 4 << 20
#: Counters of the sketch, and the rows it is added up in.
COUNTERS = 1 << 20
SLOTS = 64
#: A shingle counted more often than this many times the mean counter is put behind the others, by powers of two.
COMMON = 4
#: Largest set that may list its subsets.
LIGHT = 16
#: Entries of inverted lists that are handled at once, and that a task holds before it passes them on.
BUCKET = 1 << 20
HELD = 1 << 21
#: Ids of documents that are sent to every executor at most.
SENT_IDS = 1 << 20
#: Classes that shingles are counted in, for lists as they come and for sets that are still apart.
CLASSES, WIDE = 64, 256
TILE = 256
#: Sets in a list up to which one task looks for the one in the middle.
LONG_LIST = 100_000
TILE_ROWS = 4096
NODE = np.dtype("S16")


def needed(s, t, percent: int = PERCENT):
    """How many shingles sets of these sizes have to share."""
    return -(-percent * (s + t) // (100 + percent))


def partners(s: int, percent: int = PERCENT) -> range:
    """Sizes of sets that a set of `s` shingles can link with."""
    return range(-(-percent * s // 100), 100 * s // percent + 1)


def scanned(s, percent: int = PERCENT):
    """How many of its rarest shingles a set scans the lists of."""
    return s - -(-percent * s // 100) + 1


def listed(s: int, percent: int = PERCENT) -> int:
    """How many subsets a set lists."""
    return sum(comb(s, int(needed(s, t, percent))) for t in partners(s, percent))


def sets_in(part: pa.RecordBatch, size: int) -> Iterator[tuple[bytes, np.ndarray]]:
    """(node, shingles in ascending order) of every text."""
    words = word_table(part.column("text"), lower=True)
    hashes, begin = shingle_table(words, size)
    for t in range(part.num_rows):
        a, b = int(words.first[t]), int(words.first[t + 1])
        if a == b:
            yield b"", hashes[:0]
            continue
        raw = b" ".join(words.data[words.start[a] : words.end[b - 1]].tobytes().split())
        yield hashlib.blake2b(raw, digest_size=16).digest(), np.unique(hashes[begin[t] : begin[t + 1]])


def members(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, node, n, classes, wide, light) of every row, and in rows with a `slot` the counters of a task.

    `classes`, `wide`: how many shingles fall into each class, 255 at most; `light`: small sets themselves.
    """

    def run(batches):
        seen: set[bytes] = set()
        counts = np.zeros(COUNTERS, np.uint32)
        for part in slices(batches, limit=PART_BYTES):
            found = list(sets_in(part, size))
            fresh = []
            for node, shingles in found:
                if node not in seen:
                    seen.add(node)
                    fresh.append(shingles)
            if fresh:
                counts += np.bincount(counter_of(np.concatenate(fresh)), minlength=COUNTERS).astype(np.uint32)
            light = [s.astype("<u8").tobytes() if 0 < len(s) <= LIGHT else None for _, s in found]
            classes, wide = ([counted(s, k) for _, s in found] for k in (CLASSES, WIDE))
            yield batch(part.column("doc_id"), [x for x, _ in found], [len(s) for _, s in found], classes, wide, light, None, None)
        if counts.any():
            squeeze = zstandard.ZstdCompressor(level=1).compress
            rows = [squeeze(c.astype("<u4").tobytes()) for c in np.split(counts, SLOTS)]
            yield batch([None] * SLOTS, None, None, None, None, None, range(SLOTS), rows)

    def batch(ids, node, n, classes, wide, light, slot, counts):
        def column(values, kind):
            return pa.array(values, kind) if values is not None else pa.nulls(len(ids), kind)

        columns = [column(node, pa.binary()), column(n, pa.int32()), *(column(x, pa.binary()) for x in (classes, wide, light))]
        columns += [column(slot, pa.int32()), column(counts, pa.binary())]
        ids = ids if isinstance(ids, pa.Array) else pa.array(ids, pa.int64())
        return pa.RecordBatch.from_arrays([ids, *columns], names=["doc_id", "node", "n", "classes", "wide", "light", "slot", "counts"])

    return docs.mapInArrow(run, "doc_id long, node binary, n int, classes binary, wide binary, light binary, slot int, counts binary")


def counted(shingles: np.ndarray, classes: int) -> bytes:
    """How many shingles fall into each class, 255 at most; `classes` is a power of two."""
    at = (shingles >> np.uint64(65 - classes.bit_length())).astype(np.int64)
    return np.minimum(np.bincount(at, minlength=classes), 255).astype(np.uint8).tobytes()


def counter_of(shingles: np.ndarray) -> np.ndarray:
    return (mixed(shingles) >> np.uint64(64 - COUNTERS.bit_length() + 1)).astype(np.int64)


def sketch(rows: DataFrame) -> np.ndarray:
    """The counters of all tasks added up: `COUNTERS` numbers, whatever the table's size."""

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for slot, blob in zip(b.column("slot").to_pylist(), b.column("counts").to_pylist(), strict=True):
                total[slot] = total.get(slot, 0) + np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), "<u4").astype(np.uint64)
        if total:
            blobs = [total[s].astype("<u8").tobytes() for s in total]
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(blobs, pa.binary())], names=["slot", "counts"])

    out = np.zeros((SLOTS, COUNTERS // SLOTS), np.float64)
    for r in rows.repartition("slot").mapInArrow(run, "slot int, counts binary").collect():
        out[r.slot] = np.frombuffer(r.counts, "<u8")
    return out.ravel().astype(np.float32)


def levels(counts: np.ndarray) -> np.ndarray:
    """0 for the counters of rare shingles, more for common ones."""
    over = counts / (COMMON * max(float(counts.mean()), 4.0))
    return np.clip(np.floor(np.log2(np.maximum(over, 0.5))) + 1, 0, 30).astype(np.uint8)


def rarest(shingles: np.ndarray, level: np.ndarray, percent: int) -> np.ndarray:
    """The shingles of a set whose lists it scans; shingles come in ascending order."""
    order = np.argsort(level[counter_of(shingles)], kind="stable")
    return shingles[order[: scanned(len(shingles), percent)]]


def boundary(light: DataFrame, counts: np.ndarray, percent: int = PERCENT) -> int:
    """The largest size at which sets list their subsets: where the counted costs of both ways, up to it and from it, are least.

    `light`: (node, n, light), one row a node. At most `LIGHT` rows come back.
    """
    level, counts = levels(counts), np.maximum(counts - float(counts.mean()), 1).astype(np.float32)

    def run(batches):
        cost = np.zeros(LIGHT + 1)
        for b in batches:
            for blob in b.column("light").to_pylist():
                s = np.frombuffer(blob, "<u8")
                scans = rarest(s, level, percent)
                # an entry in each list, and a candidate for each other set in it
                cost[len(s)] += float(counts[counter_of(scans)].sum()) + len(scans)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(LIGHT + 1), pa.int32()), pa.array(cost)], names=["n", "scan"])

    scan = light.select("light").mapInArrow(run, "n int, scan double").groupBy("n").agg(F.sum("scan").alias("scan"))
    scan = {r.n: r.scan for r in scan.collect()}
    sets = {r.n: r["count"] for r in light.groupBy("n").count().collect()}
    saved, best, total = 0.0, 0, 0.0
    for s in range(1, LIGHT + 1):
        # a set that can still link with a heavy one scans in any case; this is what it saves once the boundary is past it
        total += scan.get(s, 0.0) - sets.get(s, 0) * listed(s, percent)
        if total > saved:
            saved, best = total, s
    return best


def light_links(light: DataFrame, most: int, percent: int = PERCENT) -> DataFrame:
    """(a, b): links that connect all light sets that link, from the subsets they share."""

    def run(batches):
        for b in batches:
            one, two, node, larger = [], [], [], []
            for name, blob in zip(b.column("node").to_pylist(), b.column("light").to_pylist(), strict=True):
                s = np.frombuffer(blob, "<u8")
                for t in partners(len(s), percent):
                    if t > most:
                        continue
                    pick = np.array(list(combinations(range(len(s)), int(needed(len(s), t, percent)))), np.int64)
                    keys = np.full((2, len(pick)), min(len(s), t) * 1000 + max(len(s), t), np.uint64)
                    for c in range(pick.shape[1]):
                        part = s[pick[:, c]]
                        keys[0], keys[1] = mixed(keys[0] + part), mixed(keys[1] ^ mixed(part + np.uint64(1)))
                    one.append(keys[0])
                    two.append(keys[1])
                    node += [name] * len(pick)
                    larger += [len(s) > t if len(s) != t else None] * len(pick)
            if node:
                names = ["k1", "k2", "node", "larger"]
                keys = [pa.array(np.concatenate(x).view(np.int64)) for x in (one, two)]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(node, pa.binary()), pa.array(larger, pa.bool_())], names=names)

    keyed = light.where(F.col("n") <= most).select("node", "light")
    keyed = written(keyed.mapInArrow(run, "k1 long, k2 long, node binary, larger boolean"), "subsets")
    # sizes differ: both sides hang from the other's first set; sizes equal: all from the first
    first = keyed.groupBy("k1", "k2").agg(
        F.min(F.when(~F.col("larger"), F.col("node"))).alias("small"),
        F.min(F.when(F.col("larger"), F.col("node"))).alias("large"),
        F.min(F.when(F.col("larger").isNull(), F.col("node"))).alias("equal"),
        F.count("*").alias("sets"),
    )
    other = F.when(F.col("larger").isNull(), F.col("equal")).when(F.col("larger"), F.col("small")).otherwise(F.col("large"))
    met = keyed.join(first.where("sets > 1"), ["k1", "k2"]).select(F.col("node").alias("a"), other.alias("b"))
    return met.where("a <> b").distinct()


ENTRY = "h long, node binary, n int, hub binary, many int"


def bands(h: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    """For rows by list, then size: where runs of sets begin that are in one list and about the same size."""
    begin = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    last = np.append(begin[1:], len(h)) - 1
    band = np.zeros(len(h), bool)
    band[begin] = True
    # sizes within a list may lie too far apart
    wide = 100 * n[begin] < percent * n[last]
    for a, z in zip(begin[wide].tolist(), last[wide].tolist(), strict=True):
        at = a
        while (at := a + int(np.searchsorted(n[a : z + 1], 100 * n[at] // percent, side="right"))) <= z:
            band[at] = True
    return np.flatnonzero(band)


def middle(starts: np.ndarray, number: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """For each row the one of its band whose classes are nearest to the band's mean; ties to the smaller number."""
    rows = len(number)
    size = np.diff(np.append(starts, rows))
    mean = np.add.reduceat(classes.astype(np.float32), starts, axis=0) / size[:, None].astype(np.float32)
    band, far = np.repeat(np.arange(len(starts)), size), np.empty(rows, np.float32)
    for a in range(0, rows, 1 << 16):
        z = slice(a, a + (1 << 16))
        far[z] = np.abs(classes[z] - mean[band[z]]).sum(axis=1)
    order = np.lexsort((number, far, band))
    return np.repeat(order[starts], size)


def inverted_lists(docs: DataFrame, counts: np.ndarray, most: int, buckets: int, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(h, node, n, hub, many): the lists of two sets or more, how many each holds, and for each set the least one of about
    its size in the list."""
    level = levels(counts)

    def scan(batches):
        seen: set[bytes] = set()
        node, count, held, n = [], [], [], 0
        for part in slices(batches, limit=PART_BYTES):
            for name, shingles in sets_in(part, size):
                if not len(shingles) or name in seen or 100 * len(shingles) // percent <= most:
                    continue
                seen.add(name)
                node.append(name)
                count.append(len(shingles))
                held.append(rarest(shingles, level, percent))
                n += len(held[-1])
            if n > HELD:
                yield packed(node, count, held)
                node, count, held, n = [], [], [], 0
        if node:
            yield packed(node, count, held)

    def packed(node, count, held):
        h, own = np.concatenate(held), np.repeat(np.arange(len(node), dtype=np.uint32), [len(x) for x in held])
        node, count = np.frombuffer(b"".join(node), NODE), np.array(count, np.uint32)
        bucket = (h % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        at = np.searchsorted(bucket[order], np.arange(buckets + 1))
        names, blobs = [], []
        for i in np.flatnonzero(np.diff(at)).tolist():
            here = order[at[i] : at[i + 1]]
            used, place = np.unique(own[here], return_inverse=True)
            head = np.array([len(here), len(used)], "<u4")
            arrays = (head, h[here].astype("<u8"), place.astype("<u4"), node[used], count[used].astype("<u4"))
            names.append(i)
            blobs.append(b"".join(x.tobytes() for x in arrays))
        return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "entries"])

    def gather(batches):
        now, held = None, []
        for b in batches:
            for bucket, blob in zip(b.column("bucket").to_pylist(), b.column("entries").to_pylist(), strict=True):
                if bucket != now and held:
                    yield from lists(held)
                    held = []
                now = bucket
                held.append(blob)
        if held:
            yield from lists(held)

    def lists(blobs):
        hs, owns, nodes, counts, base = [], [], [], [], 0
        for blob in blobs:
            e, m = np.frombuffer(blob, "<u4", 2).tolist()
            hs.append(np.frombuffer(blob, "<u8", e, 8))
            owns.append(np.frombuffer(blob, "<u4", e, 8 + 8 * e).astype(np.int64) + base)
            nodes.append(np.frombuffer(blob, NODE, m, 8 + 12 * e))
            counts.append(np.frombuffer(blob, "<u4", m, 8 + 12 * e + 16 * m))
            base += m
        h, own = np.concatenate(hs), np.concatenate(owns)
        # copies from several tasks become one; nodes are numbered in the order of their names
        node, first, number = np.unique(np.concatenate(nodes), return_index=True, return_inverse=True)
        count = np.concatenate(counts)[first].astype(np.int64)
        own = number[own]
        order = np.lexsort((own, count[own], h))
        h, own = h[order], own[order]
        once = np.ones(len(h), bool)
        once[1:] = (h[1:] != h[:-1]) | (own[1:] != own[:-1])
        h, own = h[once], own[once]
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        sizes = np.diff(np.append(np.flatnonzero(new), len(h)))
        many = np.repeat(sizes > 1, sizes)
        h, own, rows = h[many], own[many], np.repeat(sizes, sizes)[many]
        if not len(h):
            return
        n = count[own]
        starts = bands(h, n, percent)
        hub = np.repeat(np.minimum.reduceat(own, starts), np.diff(np.append(starts, len(h))))
        raw = pa.Array.from_buffers(pa.binary(16), len(node), [None, pa.py_buffer(node.tobytes())]).cast(pa.binary())
        for a in range(0, len(h), 1 << 16):
            z = slice(a, a + (1 << 16))
            columns = [pa.array(h[z].view(np.int64)), raw.take(pa.array(own[z])), pa.array(n[z], pa.int32())]
            columns += [raw.take(pa.array(hub[z])), pa.array(rows[z], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["h", "node", "n", "hub", "many"])

    entries = docs.mapInArrow(scan, "bucket int, entries binary")
    return entries.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(gather, ENTRY)


def sets_of(docs: DataFrame, nodes: DataFrame, made, kind: str, size: int = SHINGLE) -> DataFrame:
    """(node, n, made) of `nodes` (node, n, doc_id): what `made` gives for a list of sets, each from one of its documents. Texts are
    only moved where there are more ids than `SENT_IDS`."""
    ids = written(nodes.select(F.col("doc_id").alias("one")).distinct(), "ids")
    ids = F.broadcast(ids) if ids.count() <= SENT_IDS else ids
    mine = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("one")), "left_semi")

    def run(batches):
        seen: set[bytes] = set()
        for part in slices(batches, limit=PART_BYTES):
            found = []
            for name, shingles in sets_in(part, size):
                if len(shingles) and name not in seen:
                    seen.add(name)
                    found.append((name, shingles))
            if found:
                columns = [pa.array([x for x, _ in found], pa.binary()), made([x for _, x in found])]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "made"])

    # a document with a wanted id may have another text, and several may have the wanted one
    found = mine.mapInArrow(run, f"node binary, made {kind}").join(nodes.select("node", "n"), "node")
    return written(found.groupBy("node", "n").agg(F.first("made").alias("made")), "sets")


def whole(sets: list[np.ndarray]) -> pa.Array:
    ends = pa.array(bounds(np.array([len(x) for x in sets])), pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(sets).view(np.int64)))


def profiles(sets: list[np.ndarray]) -> pa.Array:
    """How many shingles fall into each of as many classes as a set has shingles, to the next power of two."""
    out = []
    for x in sets:
        out.append(counted(x, max(1 << int(len(x) - 1).bit_length(), 2)))
    return pa.array(out, pa.binary())


def apart(a: bytes, b: bytes) -> int:
    """In how many shingles two sets of these profiles differ at least."""
    one, two = (np.frombuffer(x, np.uint8).astype(np.int64) for x in (a, b))
    few = min(len(one), len(two))
    return int(np.abs(one.reshape(few, -1).sum(axis=1) - two.reshape(few, -1).sum(axis=1)).sum())


def _classes(column: pa.Array, classes: int = CLASSES) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, classes).astype(np.int16)


def may_link(n, m, differ, percent: int = PERCENT):
    """Whether sets of n and m shingles that differ in `differ` at least can link."""
    return (n + m - differ >= 2 * needed(n, m, percent)) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))


def near(pairs: DataFrame, nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Those of the pairs (a, b) of nodes that may link by their sizes and classes."""

    def side(name):
        return nodes.select(F.col("node").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in ("n", "wide")))

    def run(batches):
        for b in batches:
            n, m = (np.asarray(b.column(c)).astype(np.int64) for c in ("n_a", "n_b"))
            if b.num_rows:
                differ = np.abs(_classes(b.column("wide_a"), WIDE) - _classes(b.column("wide_b"), WIDE)).sum(axis=1)
                yield b.select(["a", "b"]).filter(pa.array(may_link(n, m, differ, percent)))

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a binary, b binary")


def linked(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Those of the pairs (a, b) that link, as a table: bounded by a profile of a byte a shingle, then shingle by shingle."""

    def fetched(pairs, made, kind):
        wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        return sets_of(docs, wanted.join(nodes, "node").select("node", "n", "doc_id"), made, kind, size)

    def sides(pairs, sets):
        one, two = (sets.select(F.col("node").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("n", "made"))) for x in ("a", "b"))
        return pairs.join(one, "a").join(two, "b")

    def run(batches):
        for b in batches:
            made = zip(b.column("made_a").to_pylist(), b.column("made_b").to_pylist(), strict=True)
            n, m = (np.asarray(b.column(c)).astype(np.int64) for c in ("n_a", "n_b"))
            yield b.select(["a", "b"]).filter(pa.array(may_link(n, m, np.array([apart(x, y) for x, y in made], np.int64), percent)))

    bounded = fetched(pairs, profiles, "binary")
    close = written(sides(pairs, bounded).mapInArrow(run, "a binary, b binary"), "pairs")
    sets = fetched(close, whole, "array<long>")
    shared = F.size(F.array_intersect("made_a", "made_b"))
    links = sides(close, sets).where(100 * shared >= percent * (F.col("n_a") + F.col("n_b") - shared)).select("a", "b")
    links = written(links, "links")
    discard(bounded, close, sets)
    return links


def compared(list_id: np.ndarray, group: np.ndarray, n: np.ndarray, classes: np.ndarray, percent: int = PERCENT) -> Iterator[tuple]:
    """Row numbers (i, j) of pairs in one list, of different groups, that may link; rows come by list, then n."""
    rows = len(n)
    begin = np.flatnonzero(np.concatenate([[True], list_id[1:] != list_id[:-1]]))
    size = np.diff(np.append(begin, rows))

    def pairs(i, j):
        keep = (group[i] != group[j]) & (100 * n[i] >= percent * n[j])
        i, j = i[keep], j[keep]
        for a in range(0, len(i), 1 << 14):
            x, y = i[a : a + (1 << 14)], j[a : a + (1 << 14)]
            near = may_link(n[x], n[y], np.abs(classes[x] - classes[y]).sum(axis=1), percent)
            yield x[near], y[near]

    # short lists side by side: row against the row `step` further
    row, end, step = np.flatnonzero(np.repeat(size <= TILE, size)), np.repeat(begin + size, size), 0
    while row.size:
        step += 1
        row = row[row + step < end[row]]
        row = row[100 * n[row] >= percent * n[row + step]]  # rows further on are larger still
        yield from pairs(row, row + step)
    for first, many in zip(begin[size > TILE].tolist(), size[size > TILE].tolist(), strict=True):
        last = first + many
        for a in range(first, last, TILE):
            a_end = min(a + TILE, last)
            for b in range(a, last, TILE):
                if 100 * n[a_end - 1] < percent * n[b]:
                    break
                i, j = (x.ravel() for x in np.meshgrid(np.arange(a, a_end), np.arange(b, min(b + TILE, last)), indexing="ij"))
                yield from pairs(i[i < j], j[i < j])


def whole_groups(batches, key: str, rows: int) -> Iterator[pa.Table]:
    """Batches that come by `key` as tables of about `rows` rows that do not part a group."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n < rows:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        keys = np.asarray(table.column(key).chunk(0))
        cut = int(np.searchsorted(keys, keys[-1], side="left"))
        if cut:
            yield table.slice(0, cut)
        held, n = table.slice(cut).to_batches(), len(keys) - cut
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def promising(lists: DataFrame, nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(h, node, hub): of short lists only the sets that may link with another one in them, of others all. The hub is the set
    in the middle of those of its size: copies of a text lie around it, and link with it when they do not with one another.
    """

    def run(batches):
        for table in whole_groups(batches, "h", 20_000):
            h, n = (table.column(c).to_numpy().astype(np.int64) for c in ("h", "n"))
            order = np.lexsort((n, h))
            table, h, n = table.take(pa.array(order)), h[order], n[order]
            classes = _classes(table.column("classes").combine_chunks())
            short = np.flatnonzero(table.column("many").to_numpy() <= TILE)
            keep = np.ones(len(h), bool)
            keep[short] = False
            for i, j in compared(h[short], np.arange(len(short)), n[short], classes[short], percent):
                keep[short[i]] = keep[short[j]] = True
            if not keep.any():
                continue
            node = table.column("node").combine_chunks().filter(pa.array(keep))
            number = np.unique(np.array(node.to_pylist(), NODE), return_inverse=True)[1]
            hub = middle(bands(h[keep], n[keep], percent), number, classes[keep])
            yield pa.RecordBatch.from_arrays([pa.array(h[keep]), node, node.take(pa.array(hub))], names=["h", "node", "hub"])

    some = lists.where(F.col("many") <= LONG_LIST).select("h", "node", "n", "many").join(nodes.select("node", "classes"), "node")
    some = some.repartition("h").sortWithinPartitions("h").mapInArrow(run, "h long, node binary, hub binary")
    return some.union(lists.where(F.col("many") > LONG_LIST).select("h", "node", "hub"))


def open_pairs(lists: DataFrame, nodes: DataFrame, groups: DataFrame, percent: int = PERCENT, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(a, b): pairs of sets in one list that are in different groups, may link, and were not held against each other."""
    placed = lists.join(groups, "node", "left").select("h", "node", "hub", F.coalesce("root", "node").alias("root"))
    # lists that are one group are done; a list over the limit is cut into parts, each pair of parts a list of its own
    sizes = placed.groupBy("h").agg(F.count("*").alias("rows"), F.min("root").alias("low"), F.max("root").alias("high"))
    left = placed.join(sizes.where("low <> high").select("h", "rows"), "h").withColumn("parts", F.ceil(F.col("rows") / tile_rows).cast("int"))
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    dealt = left.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tile = F.when(F.col("parts") == 1, F.col("h")).otherwise(F.xxhash64("h", F.least("own", "other"), F.greatest("own", "other")))
    full = dealt.select(tile.alias("tile"), "node", "hub", F.xxhash64("root").alias("grp")).join(nodes.select("node", "n", "wide"), "node")

    def run(batches):
        for table in whole_groups(batches, "tile", 20_000):
            yield from found(table)

    def found(table):
        tile, n, group = (table.column(c).to_numpy().astype(np.int64) for c in ("tile", "n", "grp"))
        order = np.lexsort((n, tile))
        table, tile, n, group = table.take(pa.array(order)), tile[order], n[order], group[order]
        node, hub = table.column("node").combine_chunks(), table.column("hub").combine_chunks()
        named, hubs = (np.array(x.to_pylist(), NODE) for x in (node, hub))
        classes = _classes(table.column("wide").combine_chunks(), WIDE)
        for i, j in compared(tile, group, n, classes, percent):
            new = (named[i] != hubs[j]) & (named[j] != hubs[i])
            i, j = i[new], j[new]
            if len(i):
                yield pa.RecordBatch.from_arrays([node.take(pa.array(i)), node.take(pa.array(j))], names=["a", "b"])

    pairs = full.repartition("tile").sortWithinPartitions("tile").mapInArrow(run, "a binary, b binary")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def similar(df: DataFrame, size: int = SHINGLE, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(members, links): (doc_id, node, n) of every row, and links (a, b) of nodes that connect all nodes that link."""
    docs = texts(df, doc_id, text)
    rows = written(members(docs, size), "members")
    counts, rows = sketch(rows.where("slot IS NOT NULL").select("slot", "counts")), rows.where("slot IS NULL").drop("slot", "counts")
    firsts = [F.first(c).alias(c) for c in ("n", "classes", "wide", "light")]
    nodes = written(rows.where("n > 0").groupBy("node").agg(*firsts, F.min("doc_id").alias("doc_id")), "nodes")
    light = nodes.where("light IS NOT NULL").select("node", "n", "light")
    most = boundary(light, counts, percent)
    # what lists will hold, for the number of buckets
    entries = nodes.agg(F.sum(F.col("n") * F.lit((100 - percent) / 100) + 1)).first()[0]
    lists = written(inverted_lists(docs, counts, most, int((entries or 0) // BUCKET) + 1, size, percent), "lists")
    lists, every = written(promising(lists, nodes, percent), "lists"), lists
    discard(every)
    pairs = lists.where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    pairs = written(near(pairs, nodes, percent), "pairs")
    found = written(linked(pairs, nodes, docs, size, percent).union(light_links(light, most, percent)), "links")
    groups = components(found).select("node", "root")
    rest = written(open_pairs(lists, nodes, groups, percent), "pairs")
    found = found.union(linked(rest, nodes, docs, size, percent))
    discard(lists, pairs, rest)
    return rows.select("doc_id", "node", "n"), found


def similar_documents(df: DataFrame, size: int = SHINGLE, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id), one row for each row of `df`."""
    rows, links = similar(df, size, percent, doc_id, text)
    roots = components(links)
    nodes = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("first_id"))
    placed = written(nodes.join(roots, "node", "left").select("node", "first_id", F.coalesce("root", "node").alias("root")), "placed")
    named = placed.join(placed.groupBy("root").agg(F.min("first_id").alias("component_id")), "root").select("node", "component_id")
    alone = rows.where("n = 0").select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return rows.where("n > 0").join(named, "node").select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id").union(alone)
