"""Approximate nearest neighbours over balanced posting lists (operator 4).

Nearness is the inner product. Vectors get one more component so that the largest inner product is the smallest distance:
all then have the largest norm M, and a query, scaled to M, has 0 there. Centroids come from a balanced split of a bounded
sample (`SAMPLE_ROWS`, or `SAMPLE_BYTES`): halves of equal size, again and again, so lists are about equally long. There are
at most `CENTROIDS`, whatever the data, so they and their neighbour graph fit into every worker. All vectors are indexed:
a vector goes to the list of its nearest centroid and, near a boundary, to further lists. A query searches the graph and takes
the lists whose centroid is at most (1 + reach) times as far as the nearest, and further ones until they hold `k` other ids.

The reach follows from the data: `TRIED` queries are answered by brute force over all rows, in one job, and the reach is
widened from `REACH` until the lists within it hold at least `RECALL` of what that found. At the widest all lists are read.

A list longer than `PART_ROWS` lies in parts, dealt by a hash, so a vector that very many rows share is spread over tasks;
queries stream past one part at a time. Scores are computed anew in double precision on the original vectors, in the
same order of operations for each pair, so equal vectors have equal scores and ties go to the smaller id.

Vectors that are null, zero, or hold a null or non-finite component, and rows without an id, take no part; nor do those
whose length differs from that of most. Repeated ids count once, with their largest score. Empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import ship, written

SAMPLE_ROWS = 20_000
SAMPLE_BYTES = 48 << 20
CENTROIDS = 4096
LIST_ROWS = 200
COPIES = 3
BOUNDARY = 0.03
REACH = 0.13
WIDER = 0.01  # step by which the reach grows
TRIED = 256
TRIED_BYTES = 8 << 20
RECALL = 0.95  # 0.9 is required; the share over `TRIED` queries is off by 0.02 at most, as a rule
DEGREE = 16
BEAM = 64
PART_ROWS = 8192
HELD = 1_000_000  # rows a task holds before it cuts them down
SEARCHED = 512  # vectors that walk the graph side by side


def split(points: np.ndarray, leaves: int, seed: int = 5) -> np.ndarray:
    """Centroids of `leaves` groups of about equal size: each group is halved where two centres balance."""
    draw = np.random.default_rng(seed)
    groups = [np.arange(len(points))]
    while len(groups) < leaves:
        groups.sort(key=len)
        own = groups.pop()
        if len(own) < 2:
            groups.append(own)
            break
        x = points[own]
        centre = x[draw.choice(len(own), 2, replace=False)]
        for _ in range(6):
            lean = x @ (centre[1] - centre[0])
            order = np.argsort(lean, kind="stable")
            low, high = order[: len(own) // 2], order[len(own) // 2 :]
            centre = np.stack([x[low].mean(axis=0), x[high].mean(axis=0)])
        groups += [own[low], own[high]]
    return np.stack([points[g].mean(axis=0) for g in groups])


class CentroidGraph:
    """Centroids with links to near ones, searched from fixed entries by best-first walks of many queries at once."""

    def __init__(self, centroids: np.ndarray, degree: int = DEGREE):
        self.at = centroids
        self.norm = (centroids**2).sum(axis=1)
        n = len(centroids)
        k = min(degree, n - 1)
        near = np.zeros((n, k), np.int64)
        for a in range(0, n, 512):
            d = self.norm[None, :] - 2 * centroids[a : a + 512] @ centroids.T
            d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
            near[a : a + 512] = np.argsort(d, axis=1, kind="stable")[:, :k]
        # links both ways; the most linked-to keep all of theirs, filled up with themselves
        back = [[] for _ in range(n)]
        for i, row in enumerate(near.tolist()):
            for j in row:
                back[j].append(i)
        links = [list(dict.fromkeys([*row, *back[i]]))[: 2 * degree] for i, row in enumerate(near.tolist())]
        width = max((len(x) for x in links), default=0)
        self.links = np.array([x + [i] * (width - len(x)) for i, x in enumerate(links)], np.int64).reshape(n, width)
        self.entries = np.unique(np.linspace(0, n - 1, min(n, 32)).astype(np.int64))

    def search(self, q: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """(centroids, squared distances) of about the `beam` nearest of each query, nearest first."""
        n, m = len(self.at), len(q)
        beam = min(beam, n)
        square = (q**2).sum(axis=1)[:, None]
        seen = np.zeros((m, n), bool)
        seen[:, self.entries] = True
        dist = square + self.norm[self.entries][None, :] - 2 * q @ self.at[self.entries].T
        first = np.argsort(dist, axis=1, kind="stable")[:, :beam]
        best, dist = self.entries[first], np.take_along_axis(dist, first, 1)
        done = np.zeros(best.shape, bool)
        row = np.arange(m)
        while row.size:
            open_ = np.where(done[row], np.inf, dist[row])
            step = open_.argmin(axis=1)
            going = np.isfinite(open_[np.arange(row.size), step])
            row, step = row[going], step[going]
            if not row.size:
                break
            done[row, step] = True
            links = self.links[best[row, step]]
            fresh = ~seen[row[:, None], links]
            seen[row[:, None], links] = True
            d = square[row] + self.norm[links] - 2 * np.einsum("mld,md->ml", self.at[links], q[row])
            d[~fresh] = np.inf
            ordered = np.sort(links, axis=1)
            if (ordered[:, 1:] == ordered[:, :-1]).any():  # a link that fills up a row must not come twice
                order = np.argsort(links, axis=1, kind="stable")
                twice = np.zeros(links.shape, bool)
                np.put_along_axis(twice, order[:, 1:], np.take_along_axis(links, order, 1)[:, 1:] == np.take_along_axis(links, order, 1)[:, :-1], 1)
                d[twice] = np.inf
            width = beam
            every = np.concatenate([dist[row], d], axis=1)
            ids, over = np.concatenate([best[row], links], axis=1), np.concatenate([done[row], np.zeros(links.shape, bool)], axis=1)
            keep = np.argsort(every, axis=1, kind="stable")[:, :width]
            if best.shape[1] < min(width, every.shape[1]):
                more = min(width, every.shape[1]) - best.shape[1]
                best = np.concatenate([best, np.zeros((m, more), np.int64)], axis=1)
                dist = np.concatenate([dist, np.full((m, more), np.inf)], axis=1)
                done = np.concatenate([done, np.ones((m, more), bool)], axis=1)
            k = keep.shape[1]
            best[row, :k], dist[row, :k] = np.take_along_axis(ids, keep, 1), np.take_along_axis(every, keep, 1)
            done[row, :k] = np.take_along_axis(over, keep, 1) | ~np.isfinite(dist[row, :k])
        order = np.argsort(dist, axis=1, kind="stable")[:, :beam]
        return np.take_along_axis(best, order, 1), np.maximum(np.take_along_axis(dist, order, 1), 0)

    def lists_of(self, x: np.ndarray, copies: int = COPIES, boundary: float = BOUNDARY) -> tuple[np.ndarray, np.ndarray]:
        """(row, list): the nearest list of each vector, and further ones whose centroid is nearly as near."""
        near, d = self.search(x, 2 * copies)
        d = np.sqrt(d)
        ok = np.isfinite(d) & (d <= (1 + boundary) * d[:, :1])
        ok[:, copies:] = False
        row, k = np.nonzero(ok)
        return row, near[row, k]

    def probes(self, q: np.ndarray, reach: float = REACH, held: np.ndarray | None = None, need: int = 0, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """(row, list): the lists a query has to look into: those within reach, and further ones until they hold `need` by `held`."""
        near, d = self.search(q, beam)
        ok = self.wanted(near, d, reach, held, need)
        more = ok.all(axis=1) & (near.shape[1] < len(self.at))  # the walk ended before the reach did: all centroids, then
        row, k = np.nonzero(ok & ~more[:, None])
        rows, lists = [row], [near[row, k]]
        left = np.flatnonzero(more)
        if left.size:
            d = self.distances(q[left])
            near = np.argsort(d, axis=1, kind="stable")
            row, k = np.nonzero(self.wanted(near, np.take_along_axis(d, near, 1), reach, held, need))
            rows.append(left[row])
            lists.append(near[row, k])
        return np.concatenate(rows), np.concatenate(lists)

    def distances(self, q: np.ndarray) -> np.ndarray:
        """Squared distances of each query to all centroids."""
        return np.maximum((q**2).sum(axis=1)[:, None] + self.norm[None, :] - 2 * q @ self.at.T, 0)

    @staticmethod
    def wanted(near: np.ndarray, square: np.ndarray, reach: float, held: np.ndarray | None, need: int) -> np.ndarray:
        """Which of the centroids, nearest first, are within reach or still needed."""
        d = np.sqrt(square)
        ok = np.isfinite(d) & (d <= (1 + reach) * d[:, :1])
        if held is not None:
            before = np.cumsum(held[near], axis=1) - held[near]
            ok |= np.isfinite(d) & (before < need)
        return ok


def usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, v, norm) of the vectors that take part."""
    v = df.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    fine = "v IS NOT NULL AND vec_id IS NOT NULL AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    v = v.where(fine).withColumn("norm", F.expr("sqrt(aggregate(v, 0D, (a, x) -> a + x * x))")).where("norm > 0")
    # one row for each length there is
    sizes = v.groupBy(F.size("v").alias("n")).count().orderBy(F.col("count").desc(), "n").first()
    return v.where(F.size("v") == (sizes["n"] if sizes else -1))


def matrix(column: pa.Array) -> np.ndarray:
    values = np.asarray(column.flatten(), dtype=np.float64)
    return values.reshape(len(column), -1)


def raised(x: np.ndarray, most: float) -> np.ndarray:
    """Vectors with the component that gives all of them the norm `most`."""
    rest = np.sqrt(np.maximum(most * most - (x**2).sum(axis=1), 0.0))
    return np.concatenate([x, rest[:, None]], axis=1)


def asks_as(q: np.ndarray, most: float) -> np.ndarray:
    """Queries as they are compared with centroids: of norm `most`, with 0 in the component that vectors have besides."""
    return np.concatenate([q * (most / np.sqrt((q**2).sum(axis=1)))[:, None], np.zeros((len(q), 1))], axis=1)


def brute(v: DataFrame, ids: np.ndarray, q: np.ndarray, k: int) -> DataFrame:
    """(query_id, vec_id): the `k` nearest of each of a few queries among all rows, in one job."""
    asked = v.sparkSession.sparkContext.broadcast((ids, q))

    def run(batches):
        query, x = asked.value
        best = Best(k)
        for batch in batches:
            for at in range(0, batch.num_rows, PART_ROWS):
                part = batch.slice(at, PART_ROWS)
                best.add(*best_of(np.asarray(part.column("vec_id")), matrix(part.column("v")), query, x, k))
                if best.n > HELD:
                    best.cut()
        if best.n:
            yield best.emit()

    found = v.select("vec_id", "v").mapInArrow(run, "query_id long, vec_id long, score double")
    return ranked(found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")), k).select("query_id", "vec_id")


def ranked(once: DataFrame, k: int) -> DataFrame:
    """The `k` best of each query, with their rank; equal scores go by id."""
    place = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return once.withColumn("rank", F.row_number().over(place).cast("int")).where(F.col("rank") <= k)


def reach_for(index: CentroidGraph, lists: DataFrame, v: DataFrame, tried: pa.Table, most: float, k: int, least: float, recall: float) -> float:
    """The smallest reach, from `least` on, within which `lists` hold `recall` of the true neighbours of the queries tried."""
    if not tried.num_rows:
        return least
    ids, first = np.unique(np.asarray(tried.column("vec_id")), return_index=True)
    q = matrix(tried.column("v").combine_chunks())[first]
    truth = brute(v, ids, q, k).toArrow()
    if not truth.num_rows:
        return least
    asks, near = np.searchsorted(ids, np.asarray(truth.column("query_id"))), np.asarray(truth.column("vec_id"))
    d = np.sqrt(index.distances(asks_as(q, most)))
    ratio = d / np.maximum(d.min(axis=1, keepdims=True), 1e-300)
    wanted = v.sparkSession.createDataFrame(pa.table({"vec_id": np.unique(near)}))
    placed = lists.join(F.broadcast(wanted), "vec_id").select("vec_id", "list").distinct().toArrow()
    vec, at = np.asarray(placed.column("vec_id")), np.asarray(placed.column("list"))
    order = np.argsort(vec, kind="stable")
    vec, at = vec[order], at[order]
    begin, end = np.searchsorted(vec, near, side="left"), np.searchsorted(vec, near, side="right")
    needed = np.sort([ratio[a, at[i:j]].min() - 1 for a, i, j in zip(asks, begin, end, strict=True)])
    return max(least, float(np.ceil(needed[int(np.ceil(recall * len(needed))) - 1] / WIDER) * WIDER))


def nearest(
    df: DataFrame, query_every: int, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", reach: float = REACH, recall: float = RECALL
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id `query_every` divides, the `k` nearest other rows found."""
    spark = df.sparkSession
    ship(spark)
    v = usable(df, vec_id, vector)
    seen = v.agg(F.count("*").alias("n"), F.max("norm").alias("most"), F.max(F.size("v")).alias("width")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if not seen["n"]:
        return spark.createDataFrame([], schema)
    n, most = seen["n"], float(seen["most"])
    rows = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * (seen["width"] + 1))))
    # the rows with the smallest hashes: the same ones whatever the partitions
    drawn = v.orderBy(F.xxhash64("vec_id"), "vec_id").limit(rows).select("v").toArrow().column("v").combine_chunks()
    leaves = int(max(1, min(CENTROIDS, n // LIST_ROWS)))
    graph = CentroidGraph(split(raised(matrix(drawn), most), leaves))
    index = spark.sparkContext.broadcast(graph)
    some = max(1, min(TRIED, TRIED_BYTES // (8 * (seen["width"] + 1))))
    tried = v.where(F.col("vec_id") % query_every == 0).orderBy(F.xxhash64("vec_id", F.lit(3)), "vec_id", F.xxhash64("v")).limit(some)
    tried = tried.select("vec_id", "v").toArrow()

    def post(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SEARCHED):
                part = batch.slice(at, SEARCHED)
                row, lists = index.value.lists_of(raised(matrix(part.column("v")), most))
                picked = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(lists), picked.column("vec_id"), picked.column("v")], names=["list", "vec_id", "v"])

    def probe(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SEARCHED):
                part = batch.slice(at, SEARCHED)
                row, lists = index.value.probes(asks_as(matrix(part.column("v")), most), reach, held, k + 1)
                picked = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(lists), picked.column("vec_id"), picked.column("v")], names=["list", "vec_id", "v"])

    row = "list long, vec_id long, v array<double>"
    lists = written(v.select("vec_id", "v").mapInArrow(post, row), "lists")
    reach = reach_for(graph, lists, v, tried, most, k, reach, recall)
    # a row for each list, of which there are at most CENTROIDS
    sizes = {r["list"]: r["count"] for r in lists.groupBy("list").count().collect()}
    parts = np.ones(leaves, np.int64)
    for which, count in sizes.items():
        parts[which] = -(-count // PART_ROWS)
    # ids by the first list each is in: so many different ones do some lists hold at least, and all lists exactly
    held = np.zeros(leaves, np.int64)
    for r in lists.groupBy("vec_id").agg(F.min("list").alias("list")).groupBy("list").count().collect():
        held[r["list"]] = r["count"]
    count_of = F.array(*(F.lit(int(p)) for p in parts)) if parts.max() > 1 else None
    of_list = F.lit(1) if count_of is None else F.get(count_of, F.col("list").cast("int"))
    asked = v.where(F.col("vec_id") % query_every == 0).select("vec_id", "v").mapInArrow(probe, row)
    stored = lists.withColumn("part", F.pmod(F.xxhash64("vec_id"), of_list).cast("int")).withColumn("asks", F.lit(0))
    asking = asked.withColumn("part", F.explode(F.sequence(F.lit(0), of_list.cast("int") - 1))).withColumn("asks", F.lit(1))
    met = stored.select("list", "part", "asks", "vec_id", "v").union(asking.select("list", "part", "asks", "vec_id", "v"))
    found = met.repartition("list", "part").sortWithinPartitions("list", "part", "asks", "vec_id").mapInArrow(
        lambda batches: scan(batches, k), "query_id long, vec_id long, score double"
    )
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return ranked(once, k).select("query_id", "rank", "vec_id", "score")


class Best:
    """The `k` nearest of each query over all lists that a task has seen, so that a task passes on `k` rows for a query.

    What is held is cut down to that whenever `HELD` rows have come in; if it is still more, it is passed on as it is.
    """

    def __init__(self, k: int):
        self.k, self.rows, self.n = k, [], 0

    def add(self, query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        self.rows.append((query, ids, score))
        self.n += len(query)

    def cut(self) -> None:
        query, ids, score = (np.concatenate(x) for x in zip(*self.rows, strict=True)) if self.rows else (np.zeros(0, np.int64),) * 3
        order = np.lexsort((ids, -score, query))
        query, ids, score = query[order], ids[order], score[order]
        # copies of a vector in several lists count once; they stand side by side
        new = np.ones(len(query), bool)
        new[1:] = (query[1:] != query[:-1]) | (ids[1:] != ids[:-1]) | (score[1:] != score[:-1])
        query, ids, score = query[new], ids[new], score[new]
        head = np.ones(len(query), bool)
        head[1:] = query[1:] != query[:-1]
        first = np.flatnonzero(head)
        keep = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query)))) < self.k
        self.rows, self.n = [(query[keep], ids[keep], score[keep])], int(keep.sum())

    def emit(self) -> pa.RecordBatch:
        self.cut()
        query, ids, score = self.rows[0]
        self.rows, self.n = [], 0
        return pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(ids, pa.int64()), pa.array(score, pa.float64())], names=["query_id", "vec_id", "score"])


def once(ids: np.ndarray, x: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Vectors of a list without repeated rows."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    same = np.flatnonzero(ids[1:] == ids[:-1])
    again = same[(x[same] == x[same + 1]).all(axis=1)] + 1
    return [np.delete(ids, again)], [np.delete(x, again, axis=0)]


def scan(batches, k: int):
    """The `k` nearest of each part of a list for the queries that follow it."""
    part, ids, held, merged, best = None, [], [], False, Best(k)
    for batch in batches:
        which = np.stack([np.asarray(batch.column(c), dtype=np.int64) for c in ("list", "part", "asks")], axis=1)
        cut = np.flatnonzero(np.any(which[1:] != which[:-1], axis=1)) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(which)], strict=True):
            if a == b:
                continue
            own, asks = tuple(which[a, :2]), which[a, 2]
            vec, x = np.asarray(batch.column("vec_id").slice(a, b - a)), matrix(batch.column("v").slice(a, b - a))
            if own != part:
                part, ids, held, merged = own, [], [], False
            if not asks:
                ids.append(vec)
                held.append(x)
            elif ids:
                if len(ids) > 1 or not merged:
                    ids, held, merged = *once(np.concatenate(ids), np.concatenate(held)), True
                for at in range(0, len(vec), 256):
                    best.add(*best_of(ids[0], held[0], vec[at : at + 256], x[at : at + 256], k))
                if best.n > HELD:
                    best.cut()
                    if best.n > HELD // 2:
                        yield best.emit()
    if best.n:
        yield best.emit()


def best_of(ids: np.ndarray, x: np.ndarray, query: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, score) rows: the `k` nearest of `x` for each of `q`."""
    rough = q @ x.T
    rough[query[:, None] == ids[None, :]] = -np.inf
    if len(ids) > k:
        least = np.partition(rough, len(ids) - k, axis=1)[:, len(ids) - k]
    else:
        least = np.full(len(query), -np.inf)
    # sums of another order differ a little: all that may belong to the k are scored anew
    slack = 1e-9 * (1.0 + np.abs(np.where(np.isfinite(least), least, 0.0)))
    i, j = np.nonzero((rough >= (least - slack)[:, None]) & np.isfinite(rough))
    score = (q[i] * x[j]).sum(axis=1)
    order = np.lexsort((ids[j], -score, i))
    i, j, score = i[order], j[order], score[order]
    head = np.concatenate([[True], i[1:] != i[:-1]]) if len(i) else np.zeros(0, bool)
    first = np.flatnonzero(head)
    keep = np.arange(len(i)) - np.repeat(first, np.diff(np.append(first, len(i)))) < k
    return query[i][keep], ids[j][keep], score[keep]
