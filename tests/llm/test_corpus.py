import hashlib
import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

import __spark_entry__ as driver
import corpus_pipeline
from millrace.llm import language_id, line_quality, line_templates, nearest, simhash, suffix_dedup
from millrace.llm.queries import SQL
from tests.oracle import compare, connect

DIRTY = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, columns="doc_id long, text string"):
    return spark.createDataFrame(rows, columns).repartition(4)


def passages(seed=3, n=120):
    draw = random.Random(seed)
    base = ["".join(draw.choice("abcdefgh ") for _ in range(draw.randint(90, 400))) for _ in range(6)]
    rows = []
    for i in range(n):
        kind = draw.random()
        if kind < 0.2:
            text = draw.choice(base)
        elif kind < 0.4:
            text = "".join(draw.choice("xyz é") for _ in range(draw.randint(0, 300)))
        elif kind < 0.5:
            text = "a" * draw.randint(0, 400)
        else:
            text = ""
            for _ in range(draw.randint(1, 4)):
                s = draw.choice(base)
                a = draw.randrange(len(s))
                text += s[a : a + draw.randint(50, 250)] + "".join(draw.choice("PQR") for _ in range(draw.randint(0, 9)))
        rows.append((3 * i, text))
    return [*rows, (1000, "ab" * 500), (1001, ""), (1002, None)]


def without_repeats(rows, length=100):
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            if raw[i : i + length] in seen:
                gone[i : i + length] = True
            seen.add(raw[i : i + length])
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[doc] = (len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("cuts", [suffix_dedup.CUTS, ((1, 19), (3, 1)), ((0, 5),)])
def test_repeats_as_found_by_hand(spark, cuts):
    rows = [*passages(), (None, passages()[0][1])]
    got = {r[0]: tuple(r)[1:] for r in suffix_dedup.digests(documents(spark, rows), cuts=cuts).collect()}
    assert got == without_repeats(rows)


def test_repeats_over_block_ends_and_equal_rows(spark):
    draw = random.Random(1)
    long = "".join(draw.choice("abcdefghijklmnop") for _ in range(suffix_dedup.BLOCK + 5000))
    tail = long[suffix_dedup.BLOCK - 300 : suffix_dedup.BLOCK + 300]
    rows = [(1, long), (2, "x" + tail + "y"), (2, "x" + tail + "y")]
    got = sorted(tuple(r)[:4] for r in suffix_dedup.digests(documents(spark, rows)).collect())
    assert got == [(1, len(long), 0, 0), (2, 602, 600, 1), (2, 602, 600, 1)]
    assert suffix_dedup.digests(documents(spark, [])).count() == 0


@pytest.mark.parametrize("cuts", [suffix_dedup.CUTS, ((0, 5),), ((0, 1),)])
def test_equal_rows_are_one_document(spark, cuts):
    rows = passages()
    twice = spark.createDataFrame([*rows, *rows[:60], *rows[:20]], "doc_id long, text string").repartition(2)
    got = [tuple(r) for r in suffix_dedup.digests(twice, cuts=cuts).collect()]
    assert len(got) == len(rows) + 80 and {r[0]: r[1:] for r in got} == without_repeats(rows) and len(set(got)) == len(rows)


def test_repeats_leave_whole_characters(spark):
    text = "é" * 60 + "end of it"
    df = spark.createDataFrame([(1, "é" * 60, "x"), (2, "q" + text, "y")], "doc_id long, text string, row string")
    got = {r.doc_id: (r.text, r.row) for r in suffix_dedup.clean_documents(df).collect()}
    assert got[2] == ("qend of it", "y") and set(got[1][0]) == {"é"}


def near_by_hand(rows, radius=3):
    prints = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
        prints.append(sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes)))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= radius:
            a, b = sorted((find(i), find(j)))
            parent[b] = a
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), 1 << 60), doc)
    return sorted((rows[i][0], f"{prints[i]:016x}", least[find(i)]) for i in range(len(rows)))


@pytest.mark.parametrize("radius", [3, 14])
def test_near_duplicates_as_found_by_hand(spark, radius):
    draw = random.Random(2)
    words = [f"w{i}" for i in range(40)]
    base = [[draw.choice(words) for _ in range(120)] for _ in range(5)]
    rows = [(0, None), (1, ""), (2, " \t"), (3, "One"), (4, "one"), (5, "ONE two"), (5, "ONE two")]
    for i in range(10, 120):
        own = list(draw.choice(base))
        for _ in range(draw.randint(0, 3)):
            own[draw.randrange(len(own))] = draw.choice(words)
        rows.append((i, " ".join(own)))
    df = documents(spark, rows).selectExpr("*", "1 AS fp", "2 AS root")
    assert sorted(map(tuple, simhash.near_duplicates(df, radius).collect())) == near_by_hand(rows, radius)
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


def test_one_row_of_each_component_stays(spark):
    draw = random.Random(12)
    one, two, three = (own_words(draw, 80) for _ in range(3))
    rows = [(None, one)] * 5 + [(None, one + " x")] + [(7, two), (7, two), (3, two + " y"), (9, None), (8, ""), (4, three), (4, one + " z"), (None, None)]
    df = documents(spark, rows).selectExpr("*", "1 AS k_id", "map('a', 2) AS rows")
    got = simhash.one_of_each(df)
    assert got.columns == df.columns
    classes = {}
    prints = [simhash.fingerprint(simhash.shingle_hashes(t or "")) for _, t in rows]
    for i, p in enumerate(prints):
        classes.setdefault(min(j for j, q in enumerate(prints) if (p ^ q).bit_count() <= simhash.RADIUS), []).append(rows[i])
    least = sorted((min((d is None, d or 0) for d, _ in c) for c in classes.values()))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got.collect()) == least
    assert simhash.one_of_each(documents(spark, [(None, one)] * 4)).count() == 1
    assert simhash.one_of_each(documents(spark, [])).count() == 0


def test_large_groups_are_cut_into_tiles(spark):
    draw = np.random.default_rng(4)
    centre = draw.integers(0, 1 << 63, dtype=np.int64)
    near = {int(centre) ^ (1 << int(a)) ^ (1 << int(b)) for a, b in draw.integers(0, 60, (400, 2))}
    nodes = spark.createDataFrame([(x,) for x in near], "fp long")
    tree = simhash.components(simhash.links(nodes, tile_rows=50)).collect()
    assert {r["root"] for r in tree} == {min(near)} and {r["node"] for r in tree} == near - {min(near)}


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(-5, -6)], "a long, b long")
    got = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert got == {i: 0 for i in range(1, 301)} | {-5: -6}


def test_quality_matches_its_sql(spark, sf_dir):
    con = connect(sf_dir)
    assert compare(driver.queries()["op6_quality_rules"](spark, sf_dir), con, SQL["op6_quality_rules"]) is None


def test_quality_edges(spark):
    good = "\n".join(" ".join(f"word{chr(97 + i)}{chr(97 + k)}" for k in range(8)) + "." for i in range(8))
    rows = [
        (1, None),
        (2, ""),
        (3, good),
        (3, good),
        (4, good + "\nHome | News | About | Contact\n\nAll rights reserved."),
        (5, "the cat sat " * 40),
        (None, "\n".join("no closing mark here at all " + chr(97 + i) * 4 for i in range(20))),
    ]
    df = documents(spark, rows).selectExpr("*", "1 AS w", "2 AS kept", "'z' AS row")
    got = {r["doc_id"]: r for r in line_quality.quality(df).collect()}
    assert not got[1]["kept"] and not got[2]["kept"] and got[1]["n_words"] == 0
    assert got[3]["kept"] and got[3]["n_lines_removed"] == 0
    assert got[4]["kept"] and got[4]["n_lines_removed"] == 2 and got[4]["n_symbols"] == 3
    assert got[5]["base_failed"] and got[5]["n_repeat_words"] == 120
    assert not got[None]["kept"] and got[None]["n_lines_removed"] == 20
    clean = {r["doc_id"]: r for r in line_quality.clean_documents(df).collect()}
    assert set(clean) == {3, 4} and clean[4]["text"] == good + "\n" and clean[4]["kept"] == 2 and clean[4]["row"] == "z"
    assert line_quality.quality(documents(spark, [])).count() == 0


def test_repeated_words_by_hand(spark):
    draw = random.Random(6)
    rows = [(i, " ".join(draw.choice("abc") for _ in range(draw.randint(0, 40)))) for i in range(60)]
    got = {r["doc_id"]: r["n_repeat_words"] for r in line_quality.quality(documents(spark, rows)).collect()}
    for doc, text in rows:
        words = text.split()
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        assert got[doc] == len({i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)})


def test_templates(spark):
    draw = random.Random(8)
    rows = []
    for i in range(40):
        own = " ".join(draw.choice(["rain", "sun", "wind", "sea", "hill", "road"]) + str(draw.choice("abcdef")) for _ in range(20 + i))
        name = "".join(draw.choice("abcdefgh") for _ in range(6))
        rows.append((i, f"{own}.\nPosted by user {name} on day {i}\n\nAll content is free."))
    same = "A text of its own that was copied again and again.\nIts second line is here as well."
    rows += [(100 + i, same) for i in range(30)] + [(200, None), (201, ""), (None, "alone"), (0, rows[0][1])]
    df = documents(spark, rows).selectExpr("*", "1 AS places", "2 AS k_id")
    got = {r["doc_id"]: r for r in line_templates.without_lines(df).select("row.doc_id", "n_lines", "n_dropped", "kept_text").collect()}
    assert all(got[i]["n_dropped"] == 2 and got[i]["kept_text"] == rows[i][1].split("\n")[0] + "\n" for i in range(40))
    assert all(got[100 + i]["n_dropped"] == 0 and got[100 + i]["kept_text"] == same for i in range(30))
    assert (got[200]["n_lines"], got[201]["kept_text"], got[None]["n_dropped"]) == (0, "", 0)
    clean = line_templates.clean_documents(df)
    assert clean.columns == df.columns and clean.count() == len(rows)
    assert line_templates.digests(documents(spark, [])).count() == 0


def own_words(draw, n):
    return " ".join("".join(draw.choice("abcdefghijklm") for _ in range(7)) for _ in range(n))


def test_recurring_lines_among_copies_and_as_longest_lines(spark):
    draw = random.Random(9)
    shared, passage, few = "Read more about this on our own pages today", own_words(draw, 50), own_words(draw, 9)
    footer = "All rights of this site are with its owners"
    rows = [(i, f"{own_words(draw, 40)}\n{shared}\n{own_words(draw, 30)}") for i in range(100)]
    rows += [(1000 + i, f"{own_words(random.Random(1), 40)}\n{shared}") for i in range(1000)]
    near = own_words(draw, 400).split()
    for i in range(60):  # one word another: near-duplicates
        rows.append((3000 + i, "\n".join(" ".join(f"other{i}".replace(str(i), chr(97 + i % 26)) if k == 5 * i else w for k, w in enumerate(near[a : a + 40], a)) for a in range(0, 400, 40))))
    rows += [(4000 + i, "\n".join([own_words(draw, 6), passage, *(own_words(draw, 5) for _ in range(i % 4)), footer])) for i in range(300)]
    rows += [(5000 + i, f"{own_words(draw, 20)}\n{few}\n{own_words(draw, 20)}") for i in range(3)]
    got = {r["doc_id"]: r for r in line_templates.without_lines(documents(spark, rows)).select("row.doc_id", "n_dropped", "kept_text").collect()}
    lost = {d: [x for x in t.split("\n") if x not in got[d]["kept_text"].split("\n")] for d, t in rows}
    assert all(lost[d] == [shared] for d, _ in rows if d < 3000)
    assert all(lost[d] == [] for d, _ in rows if 3000 <= d < 4000)
    assert all(lost[d] == [passage, footer] for d, _ in rows if 4000 <= d < 5000)
    assert all(lost[d] == [few] for d, _ in rows if d >= 5000)


def test_language_of_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right = got.selectExpr("avg(int(lang = lang_pred)) AS r", "min(score) AS low", "max(score) AS high").first()
    assert right["r"] > 0.98 and 0 <= right["low"] <= right["high"] <= 1


def test_language_edges(spark):
    rows = [(i, "the old house on the hill", "en") for i in range(12)] + [(20 + i, "das alte haus am berg", "de") for i in range(12)]
    rows += [(50, None, "en"), (51, "123 !?", None), (52, "häuser hillside berge", None), (None, "the", "de"), (53, "日本", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS score")
    got = {r["doc_id"]: r for r in language_id.language_id(df).collect()}
    assert got[0]["lang_pred"] == "en" and got[20]["lang_pred"] == "de" and 0 < got[0]["score"] <= 1
    assert (got[50]["lang_pred"], got[51]["lang_pred"], got[51]["score"]) == ("und", "und", 0.0)
    assert got[53]["lang_pred"] in ("en", "de") and got[None]["held_out"] is False
    bare = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert [tuple(r)[2:] for r in language_id.language_id(bare).collect()] == [("und", 0.0)]
    assert language_id.language_id(bare.where("doc_id > 1")).count() == 0


def test_nearest_vectors(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding").collect()]
    rows += [(1001, None), (1002, [0.0] * 64), (1003, [float("nan")] * 64), (1004, [None] + [1.0] * 63), (1005, [1.0, 2.0]), (None, rows[0][1])]
    rows += [(2000 + i, rows[7][1]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS list", "2 AS score")
    got = {}
    for r in nearest.nearest(df, 20).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and i not in range(1001, 1006)]
    ids, x = np.array([i for i, _ in good]), np.stack([v for _, v in good])
    hits = total = 0
    for k in np.flatnonzero(ids % 20 == 0):
        score = (x * x[k]).sum(axis=1)
        score[k] = -np.inf
        best = np.lexsort((ids, -score))[:20]
        mine = sorted(got[ids[k]])
        assert [r for r, _, _ in mine] == list(range(1, 21))
        assert mine == [(n + 1, i, s) for n, (i, s) in enumerate(sorted(((i, s) for _, i, s in mine), key=lambda p: (-p[1], p[0])))]
        hits, total = hits + len({i for _, i, _ in mine} & set(ids[best].tolist())), total + 20
    assert hits / total >= 0.9
    few = spark.createDataFrame([(0, [1.0, 0.0]), (20, [0.0, 2.0]), (3, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, nearest.nearest(few, 20).collect()))[:2] == [(0, 1, 3, 1.0), (0, 2, 20, 0.0)]
    assert nearest.nearest(few.where("vec_id > 99"), 20).count() == 0


def recall_of(spark, x, every, **more):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(8)
    got = {}
    for r in nearest.nearest(df, every, **more).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = []
    for k in range(0, len(x), every):
        score = x @ x[k]
        score[k] = -np.inf
        hits.append(len(got.get(k, set()) & set(np.argsort(-score)[:20].tolist())) / 20)
    return np.mean(hits), min(len(v) for v in got.values())


def test_reach_follows_from_the_data(spark, monkeypatch):
    monkeypatch.setattr(nearest, "LIST_ROWS", 8)  # as many lists as a large table has
    x = np.random.default_rng(1).normal(size=(6000, 64))
    mean, least = recall_of(spark, x / np.linalg.norm(x, axis=1)[:, None], 20)
    assert mean >= 0.9 and least == 20


def test_queries_go_on_until_enough_is_found(spark, monkeypatch):
    monkeypatch.setattr(nearest, "LIST_ROWS", 4)
    draw = np.random.default_rng(2)
    x = np.repeat(np.eye(40) * 10, 10, axis=0) + draw.normal(size=(400, 40)) * 0.01
    mean, least = recall_of(spark, x, 20, recall=0.01)
    assert least == 20


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "repeated_passages", "best_fit_packing"]
    odd = spark.createDataFrame([(None, None, None, None, None), (-1, "", None, "s", 0)], DIRTY)
    step = docs.select("doc_id", "text", "lang", "source", "n_chars").union(odd)
    before = None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, step = step, stage(spark, step, sf_dir).checkpoint()
        assert step.columns == docs.columns
        ids, was = [r[0] for r in step.select("doc_id").collect()], [r[0] for r in before.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= set(was)
        if name in ("line_dedup", "repeated_passages"):
            assert set(ids) == set(was)
        if name == "near_duplicates":
            rows = [tuple(r) for r in before.select("doc_id", "text").collect()]
            assert sorted(ids) == sorted({c for _, _, c in near_by_hand(rows)})
        if name == "repeated_passages":
            want = without_repeats([tuple(r) for r in before.select("doc_id", "text").collect()])
            text = {r[0]: r[1] for r in step.select("doc_id", "text").collect()}
            assert all(len(text[d].encode()) <= n - gone for d, (n, gone, _, _) in want.items())
    assert step.where("n_chars <> length(text)").count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, step, sf_dir)
    assert packed.select("doc_id").distinct().count() == step.count()
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, sf_dir)
        assert empty.count() == 0
