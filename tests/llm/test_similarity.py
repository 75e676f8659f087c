"""The similarity join of shingle sets, against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from millrace.llm import size_aware_join as join


def shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def components_by_hand(rows, size=5, percent=80):
    """One (doc_id, n, component) a row; rows: (doc_id, text)."""
    sets = [shingles(t, size) for _, t in rows]
    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, s in enumerate(sets):
        for j in {j for x in s for j in where[x] if j > i}:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                root[find(j)] = find(i)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def near_copies(seed, n):
    """Texts of all sizes with words replaced, added and left out, so that similarities lie around the limit."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [f"p{i}" for i in range(60)]
    base = [[draw.choice(vocabulary) for _ in range(draw.choice([1, 3, 4, 5, 6, 8, 9, 10, 14, 20, 45, 120, 300]))] for _ in range(n // 6)]
    base += [passage[a : a + draw.randint(5, 60)] + [draw.choice(vocabulary) for _ in range(draw.randint(0, 12))] for a in range(0, 50, 2)]
    rows = []
    for i in range(n):
        words = list(draw.choice(base))
        for _ in range(draw.choice([0, 0, 1, 1, 2, 4])):
            at = draw.randrange(len(words) + 1)
            words[at : at + draw.choice([0, 1])] = [draw.choice(vocabulary)] * draw.choice([0, 1])
        text = draw.choice([" ", "\n", "\t "]).join(words)
        rows.append((draw.choice([i, i, i, i, 7, None]), draw.choice([text, text, text.upper()])))
    return [*rows, (n, None), (n + 1, ""), (n + 1, "   "), (n + 2, "word"), (n + 3, "Word "), (None, " "), (n + 4, "É é"), (n + 5, "é é")]


def test_rules_of_sizes():
    for percent in (60, 80, 95):
        for s in range(1, 60):
            for t in range(1, 60):
                least = next((i for i in range(min(s, t) + 1) if 100 * i >= percent * (s + t - i)), None)
                assert (least is not None) == (t in join.partners(s, percent)), (s, t)
                if least is not None:
                    assert least == join.needed(s, t, percent) and s - least + 1 <= join.scanned(s, percent)


@pytest.mark.parametrize("seed", [1, 2])
def test_components_by_hand(spark, seed):
    rows = near_copies(seed, 900)
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, node string, n int").repartition(5)
    got = sorted((tuple(r) for r in join.similar_documents(df).collect()), key=str)
    assert got == components_by_hand(rows)
    assert join.similar_documents(df.limit(0)).count() == 0


@pytest.mark.parametrize("most", [0, 7, 16])
def test_every_boundary_gives_the_same(spark, monkeypatch, most):
    rows = near_copies(3, 500)
    monkeypatch.setattr(join, "boundary", lambda *_: most)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted((tuple(r) for r in join.similar_documents(df).collect()), key=str) == components_by_hand(rows)


def test_lists_cut_into_tiles_and_common_shingles(spark, monkeypatch):
    """A passage that all texts hold, in lists of many parts, with every shingle counted as common."""
    draw = random.Random(8)
    passage = [f"p{i}" for i in range(40)]
    rows = [(i, " ".join(passage[: draw.randint(30, 40)] + [f"x{draw.randint(0, 30)}" for _ in range(draw.randint(0, 12))])) for i in range(300)]
    monkeypatch.setattr(join, "COMMON", 0.001)
    want = components_by_hand(rows)
    docs = join.texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "doc_id", "text")
    members = join.members(docs).where("slot IS NULL")
    lists = join.written(join.inverted_lists(docs, np.zeros(join.COUNTERS, np.float32), 0, 3), "lists")
    nodes = members.groupBy("node").agg(F.first("n").alias("n"), F.first("wide").alias("wide"), F.min("doc_id").alias("doc_id"))
    nothing = spark.createDataFrame([], "node binary, root binary")
    pairs = join.open_pairs(lists, nodes, nothing, tile_rows=40)
    hubs = join.near(lists.where("node <> hub").selectExpr("node AS a", "hub AS b").distinct(), nodes)
    links = join.linked(pairs, nodes, docs).union(join.linked(hubs, nodes, docs)).collect()
    name = {r.node: r.doc_id for r in members.select("node", "doc_id").collect()}
    assert links and len({c for _, _, c in want}) < len(rows)
    found = {frozenset((name[bytes(r.a)], name[bytes(r.b)])) for r in links}
    sets_by_hand = {d: shingles(t) for d, t in rows}
    linked = {
        frozenset((a, b))
        for a in name.values()
        for b in name.values()
        if a < b and 100 * len(sets_by_hand[a] & sets_by_hand[b]) >= 80 * len(sets_by_hand[a] | sets_by_hand[b])
    }
    assert found == linked


def test_large_group_of_near_copies_makes_few_pairs(spark):
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*words[: i % 200], f"own{i}", *words[i % 200 + 1 :]])) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    members, links = join.similar(df)
    # a set has a link for each different least set of its lists; all pairs would be 1,124,250
    assert links.count() <= 5 * len(rows) and members.count() == len(rows)
    assert {tuple(r) for r in join.similar_documents(df).select("component_id").distinct().collect()} == {(0,)}


def test_sketch_orders_common_shingles_last(spark):
    rows = [(i, " ".join(["one two three four five", *(f"w{i}x{k}" for k in range(20))])) for i in range(400)]
    docs = join.texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    counts = join.sketch(join.members(docs).where("slot IS NOT NULL").select("slot", "counts"))
    assert counts.sum() == 400 * 21
    common = next(s for _, s in join.sets_in(pa.RecordBatch.from_pydict({"text": ["one two three four five"]}), 5))
    assert counts[join.counter_of(common)[0]] >= 400 and join.levels(counts)[join.counter_of(common)[0]] > 3


def test_production_join(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in driver.queries()["op11_shingle_join"](spark, sf_dir).collect()), key=str)
    assert got == components_by_hand(docs)


def test_profiles_bound_the_difference():
    draw = np.random.default_rng(3)
    for _ in range(200):
        pool = draw.integers(0, 1 << 64, 400, np.uint64, endpoint=False)
        a, b = (np.unique(draw.choice(pool, draw.integers(1, 300))) for _ in range(2))
        one, two = join.profiles([a, b]).to_pylist()
        assert join.apart(one, two) <= len(np.setxor1d(a, b))
        assert join.apart(one, one) == 0
