"""SimHash near-duplicates by tiled exact comparison (operator 8).

A fingerprint has a bit for each of 64 places that is set in more than half of a text's shingle hashes. Equal
fingerprints are one node, so copies cost nothing more. Two nodes that differ in at most `RADIUS` bits are equal in some
blocks of bits; nodes are dealt to tasks by such blocks, and each group is compared exactly in tiles: exclusive-or and
bit counts in numpy, tiles sorted by population count, and pairs of tiles whose counts are further apart than the radius
left out. A group larger than `TILE_ROWS` is dealt out as pairs of parts, so no task holds a whole hot group. A task
passes on one link from each node to a representative of what it found connected, never all pairs; components are then
settled by joins over the links.

Null text counts as empty and has fingerprint zero, which links like any other. Rows with a null id have a component
like others, named by the smallest id in it, or null where there is none. Repeated rows are each returned. Long texts are
taken whole. An empty table gives an empty result; extra columns are left behind, but kept by `one_of_each`.
"""

from __future__ import annotations

import itertools
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bounds, heavy, ragged, ship, slices, texts, written
from millrace.operators.joins import left_lookup
from millrace.session import durable

RADIUS = 3
SHINGLE = 3
SEED = 42
TILE_ROWS = 4096
TILE = 256
#: Shingles hashed at once.
HASHED = 1 << 17
XXH64_PRIMES = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
#: Nodes a group has on average, at most, before nodes are dealt by more bits.
GROUP_ROWS = 4096


def shingle_hashes(text: str, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of all shingles of a text, A-Z in lower case."""
    words = text.encode().lower().split()  # bytes: only A-Z change, and only ASCII white space splits
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    pairs = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)
    return np.fromiter((digest(joined[a:b], SEED) for a, b in pairs), np.uint64, len(words) - size + 1)


def xxh64(data: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of many pieces of `data`, which goes on for 8 bytes after the last. Pieces of 32 bytes or more are hashed one by one."""
    p1, p2, p3, p4, p5 = (np.uint64(p) for p in XXH64_PRIMES)
    turned = lambda x, n: (x << np.uint64(n)) | (x >> np.uint64(64 - n))
    eight = np.ndarray(len(data) - 7, "<u8", data, 0, (1,))
    four = np.ndarray(len(data) - 3, "<u4", data, 0, (1,))
    h = size.astype(np.uint64) + np.uint64(seed) + p5
    for k in range(3):
        some = np.flatnonzero(size >= 8 * k + 8)
        x = h[some] ^ (turned(eight[start[some] + 8 * k].astype(np.uint64) * p2, 31) * p1)
        h[some] = turned(x, 27) * p1 + p4
    some = np.flatnonzero(size & 4)
    x = h[some] ^ (four[start[some] + (size[some] & ~7)].astype(np.uint64) * p1)
    h[some] = turned(x, 23) * p2 + p3
    for k in range(3):
        some = np.flatnonzero((size & 3) > k)
        x = h[some] ^ (data[start[some] + (size[some] & ~3) + k].astype(np.uint64) * p5)
        h[some] = turned(x, 11) * p1
    h = (h ^ (h >> np.uint64(33))) * p2
    h = (h ^ (h >> np.uint64(29))) * p3
    h ^= h >> np.uint64(32)
    long = np.flatnonzero(size >= 32)
    h[long] = [xxhash.xxh64_intdigest(data[a : a + n], seed) for a, n in zip(start[long].tolist(), size[long].tolist(), strict=True)]
    return h


def shingle_hashes_of(texts: list[str], size: int = SHINGLE) -> list[np.ndarray]:
    """`shingle_hashes` of each text, many shingles at once."""
    words = [t.encode().lower().split() for t in texts]
    n = np.array([len(w) for w in words], np.int64)
    data = np.frombuffer(b"\n".join(b" ".join(w) for w in words if w) + b"\n" + bytes(8), np.uint8)
    ends = np.flatnonzero((data == 32) | (data == 10))
    starts = np.concatenate([[0], ends[:-1] + 1])
    many = np.where(n > 0, np.maximum(n - size + 1, 1), 0)
    at = ragged(bounds(n)[:-1], many)
    last = at + np.repeat(np.minimum(n, size) - 1, many)
    blocks = range(0, len(at), HASHED)
    found = [xxh64(data, starts[at[i : i + HASHED]], ends[last[i : i + HASHED]] - starts[at[i : i + HASHED]]) for i in blocks]
    return np.split(np.concatenate([np.zeros(0, np.uint64), *found]), bounds(many)[1:-1]) if len(texts) else []


def fingerprint(hashes: np.ndarray) -> int:
    if not len(hashes):
        return 0
    count = np.zeros(64, np.int64)
    for part in np.array_split(hashes, len(hashes) // 100_000 + 1):
        bits = np.unpackbits(part.astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
        count += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(count * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint of every whole text, its bits as a signed number."""

    def run(batches):
        for part in slices(batches):
            found = np.array([fingerprint(shingle_hashes(t)) for t in part.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return texts(df, doc_id, text).mapInArrow(run, "doc_id long, fp long")


def scheme(nodes: int, radius: int = RADIUS) -> list[list[tuple[int, int]]]:
    """Which blocks of bits, as (lowest bit, width), make each key.

    With radius + a blocks, two nodes within the radius agree in a blocks or more. More nodes take a larger `a`, so keys
    of more bits: that changes the work, not what is found.
    """
    for agree in range(1, 65 - radius):
        blocks = radius + agree
        at = [64 * i // blocks for i in range(blocks + 1)]
        ranges = [(a, b - a) for a, b in itertools.pairwise(at)]
        if nodes / 2.0 ** (64 * agree // blocks) <= GROUP_ROWS or comb(blocks, agree) > 40:
            break
    return [list(c) for c in itertools.combinations(ranges, agree)]


def group_keys(fp: Column, keys: list[list[tuple[int, int]]]) -> Column:
    """One key for each set of blocks; the hash only deals nodes out, every pair is compared by its bits."""
    return F.array(
        *(
            F.xxhash64(F.lit(i), *(F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1)) for low, width in blocks))
            for i, blocks in enumerate(keys)
        )
    )


class Union:
    """Disjoint sets over 0 .. n-1, joined many pairs at once."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, x: np.ndarray) -> np.ndarray:
        while True:
            up = self.parent[x]
            if np.array_equal(up, x):
                return x
            x = up

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            a, b = self.find(a), self.find(b)
            apart = a != b
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))


def compare(key: np.ndarray, fp: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For rows sorted by key: the row each one is linked to, within the rows of its key."""
    n = len(fp)
    pop = np.bitwise_count(fp).astype(np.int64)
    order = np.lexsort((fp, pop, key))
    key, fp, pop = key[order], fp[order], pop[order]
    union = Union(n)
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if n else np.zeros(0, np.int64)
    size = np.diff(np.append(begin, n))
    # small groups are one tile each: all of them side by side, row against the row `step` further
    row = np.flatnonzero(np.repeat(size <= TILE, size))
    end = np.repeat(begin + size, size)
    step = 0
    while row.size:
        step += 1
        row = row[row + step < end[row]]
        row = row[pop[row + step] - pop[row] <= radius]
        near = row[np.bitwise_count(fp[row] ^ fp[row + step]) <= radius]
        union.join(near, near + step)
    for first, rows in zip(begin[size > TILE].tolist(), size[size > TILE].tolist(), strict=True):
        last = first + rows
        for a in range(first, last, TILE):
            a_end = min(a + TILE, last)
            for b in range(a, last, TILE):
                if pop[b] - pop[a_end - 1] > radius:
                    break
                b_end = min(b + TILE, last)
                i, j = np.nonzero(np.bitwise_count(fp[a:a_end, None] ^ fp[None, b:b_end]) <= radius)
                union.join(i + a, j + b)
    out = np.empty(n, np.int64)
    out[order] = order[union.find(np.arange(n))]
    return out


def links(nodes: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(a, b): from nodes (fp), links that connect all within the radius of each other."""
    keys = scheme(nodes.count(), radius)
    dealt = nodes.select("fp", F.explode(group_keys(F.col("fp"), keys)).alias("grp"))
    # a group over the limit is cut into parts by a hash; each pair of parts is a group of its own
    large = dealt.groupBy("grp").count().where(F.col("count") > tile_rows)
    parts = dealt.join(large, "grp", "left").withColumn("parts", F.ceil(F.coalesce("count", F.lit(1)) / F.lit(tile_rows)).cast("int"))
    own = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("parts")).cast("int")
    pairs = parts.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tiles = pairs.select(
        "fp",
        F.when(F.col("parts") == 1, F.col("grp"))
        .otherwise(F.xxhash64("grp", F.least("own", "other"), F.greatest("own", "other")))
        .alias("tile"),
    )

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0
        for batch in batches:
            tile, fp = np.asarray(batch.column("tile")), np.asarray(batch.column("fp")).view(np.uint64)
            held.append((tile, fp))
            n += len(tile)
            if n < 50_000:
                continue
            tile, fp = (np.concatenate(x) for x in zip(*held, strict=True))
            whole = int(np.searchsorted(tile, tile[-1], side="left"))
            yield from found(tile[:whole], fp[:whole])
            held, n = [(tile[whole:], fp[whole:])], len(tile) - whole
        if held:
            yield from found(*(np.concatenate(x) for x in zip(*held, strict=True)))

    def found(tile: np.ndarray, fp: np.ndarray):
        to = fp[compare(tile, fp, radius)]
        some = to != fp
        yield pa.RecordBatch.from_arrays([pa.array(fp[some].view(np.int64)), pa.array(to[some].view(np.int64))], names=["a", "b"])

    return tiles.repartition("tile").sortWithinPartitions("tile").mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes with links (a, b): the smallest node that can be reached.

    Links are turned, in rounds, into links to the smallest neighbour: first those of larger nodes, then those of smaller
    ones, until nothing changes and every node hangs from its root. The number of rounds grows with the logarithm of the
    longest chain; each round is written down before the next.
    """
    stars = durable(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    before = None
    while True:
        mark = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = mark
        both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        wide = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = wide.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        lowest = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        stars = durable(small.union(lowest.select("a", F.col("m").alias("b"))).distinct())


def rooted(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """`nodes`, one row for each fp, with the root of the component that it is in."""
    root_of = components(links(nodes.select("fp"), radius))
    placed = nodes.join(root_of, nodes["fp"] == root_of["node"], "left")
    return placed.select(*nodes.columns, F.coalesce("root", "fp").alias("root"))


def near_duplicates(df: DataFrame, radius: int = RADIUS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id), one row for each row of `df`."""
    marked = written(fingerprints(df, doc_id, text), "fingerprints")
    placed = rooted(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), radius)
    named = placed.join(placed.groupBy("root").agg(F.min("first_id").alias("component_id")), "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(df: DataFrame, radius: int = RADIUS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of `df`, whole, for each component: the one with the smallest id.

    Rows without an id come after all others, equal ids go by a hash of the text, then by one of the whole row; of rows that
    are equal throughout one stays.
    """
    ship(df.sparkSession)
    number, t = F.col(f"`{doc_id}`").cast("long"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    others = F.to_json(F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in df.columns if c not in (doc_id, text))))
    keys = ["k_null", "k_id", "k_hash", "k_row"]
    key = [number.isNull().alias(keys[0]), F.coalesce(number, F.lit(0)).alias(keys[1]), F.xxhash64(t).alias(keys[2])]
    key.append(F.xxhash64(F.lit(1), t, F.col(f"`{text}`").isNull(), others).alias(keys[3]))

    def run(batches):
        for part in slices(batches):
            found = np.array([fingerprint(shingle_hashes(x)) for x in part.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keys), pa.array(found.view(np.int64))], names=[*keys, "fp"])

    read = df.select(*key, t.alias("text")).mapInArrow(run, "k_null boolean, k_id long, k_hash long, k_row long, fp long")
    rows = written(read.groupBy(*keys, "fp").agg(F.count("*").alias("rows")), "fingerprints")
    placed = rooted(rows.groupBy("fp").agg(F.min(F.struct(*keys, "rows")).alias("one")), radius)
    stay = written(placed.groupBy("root").agg(F.min("one").alias("one")).select("one.*"), "stay")
    kept = left_lookup(df.select(*key, row.alias("row")), stay, keys, "inner", heavy=heavy(stay, keys, "rows"))
    once = kept.where("rows = 1").select("row").union(kept.where("rows > 1").groupBy(*keys).agg(F.first("row").alias("row")).select("row"))
    return once.select(*(F.col(f"row.`{c}`").alias(c) for c in df.columns))
