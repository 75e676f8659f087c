"""Runs of words and the order of roles, against brute force."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as driver
from millrace.llm import conversation_repair, runs, word_table

# --- runs of words (operator 12) ---


def runs_by_hand(words):
    out = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            n = i + q - s
            if n >= max(6, 4 * q) and not any((a, b) == (s, n) for a, b, _ in out):
                out.append((s, n, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def digests_by_hand(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = runs_by_hand(words)
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, sha(listed), sha(kept))


def texts_with_runs(seed, n):
    draw = random.Random(seed)
    for _ in range(n):
        words = [draw.choice("abcdefgh"[: draw.choice([1, 2, 3, 5])]) for _ in range(draw.randint(0, 90))]
        if words and draw.random() < 0.6:
            a, p = draw.randrange(len(words)), 1 + draw.randint(0, len(words) // 4)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        yield draw.choice([" ", "\n", " \t"]).join(words)


def test_runs_of_many_texts_at_once():
    texts = list(texts_with_runs(5, 1500))
    table = word_table.word_table(pa.array(texts))
    h = table.hashes()
    found = runs.text_runs([h[a:b] for a, b in zip(table.first, table.first[1:])])
    assert [list(zip(*(x.tolist() for x in f), strict=True)) for f in found] == [runs_by_hand(t.split()) for t in texts]


def test_long_runs():
    words = np.arange(1, 40_001, dtype=np.uint64)
    words[1000:9000] = np.tile(words[1000:3000], 4)
    words[20_000:30_000] = 7
    found = list(zip(*(x.tolist() for x in runs.text_runs([words])[0]), strict=True))
    assert found == [(1000, 8000, 2000), (20_000, 10_000, 1)]


def test_run_digests(spark):
    rows = [*enumerate(texts_with_runs(6, 400)), (1000, None), (1001, ""), (1002, "x " * 3000), (1003, "aé \x0b b" * 40), (5, "a b " * 9), (5, "a b " * 9)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, start int, n_runs string").repartition(3)
    got = sorted(tuple(r) for r in runs.run_digests(df).collect())
    assert got == sorted(digests_by_hand(i, t) for i, t in rows)
    assert runs.run_digests(df.limit(0)).count() == 0


def test_runs_and_text_without_them(spark):
    df = spark.createDataFrame([(None, "so so so so so so it goes"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in runs.runs(df).collect()}
    assert [tuple(x) for x in got[None].runs] == [(0, 6, 1)] and got[None].text == "so it goes"
    assert got[2].runs == [] and got[2].text == ""
    assert runs.run_digests(df).where("doc_id IS NULL AND n_runs = 1").count() == 1


def test_words_that_share_a_hash(spark, monkeypatch):
    monkeypatch.setattr(word_table.WordTable, "hashes", lambda self: np.ones(len(self.start), np.uint64))
    table = word_table.word_table(pa.array(["a b c d e f g"]))
    found = runs.text_runs([table.hashes()])[0]
    assert not runs.exact(list("abcdefg"), found) and runs.exact(list("aaaaaaa"), found)


def test_words_are_hashed_alike_wherever_they_stand():
    draw = random.Random(2)
    words = ["".join(draw.choice("abé") for _ in range(draw.randint(1, 90))) for _ in range(300)]
    lines = [" ".join(draw.choice(words) for _ in range(draw.randint(0, 30))) for _ in range(200)]
    table = word_table.word_table(pa.array(["", *lines, ""])[1:-1])
    named = defaultdict(set)
    for i, h in enumerate(table.hashes().tolist()):
        named[h].add(table.data[table.start[i] : table.end[i]].tobytes())
    assert all(len(x) == 1 for x in named.values()) and {w for x in named.values() for w in x} == {w.encode() for x in lines for w in x.split()}


def test_production_runs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in driver.queries()["op12_periodic_runs"](spark, sf_dir).collect())
    assert got == sorted(digests_by_hand(r.doc_id, r.text) for r in docs)


# --- order of roles (operator 13) ---

NEXT = {("", "s"): "S", ("", "u"): "U", ("S", "u"): "U", ("U", "a"): "A", ("A", "u"): "U"}


def cheapest(rows):
    """Least (cost, audit) by searching all edits; rows: (role, text, fault)."""
    todo, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, state, out = heapq.heappop(todo)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "A"):
            return cost, audit, "\n".join(out)
        for symbol, role in (("u", "user"), ("a", "assistant")):
            if to := NEXT.get((state, symbol)):
                heapq.heappush(todo, (cost + 2, audit + "I", i, to, (*out, f"{role}:")))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(todo, (cost + 3, audit + "D", i + 1, state, out))
            if fault not in (1, 2):
                if to := NEXT.get((state, role[:1])):
                    heapq.heappush(todo, (cost + (fault == 3), audit + "K", i + 1, to, (*out, f"{role}:{text}")))
                for symbol, name in (("u", "user"), ("a", "assistant")):
                    if to := NEXT.get((state, symbol)):
                        heapq.heappush(todo, (cost + 2 + (fault == 3), audit + "R", i + 1, to, (*out, f"{name}:{text}")))


def repaired_by_hand(rows, damage=True):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        now = convs[conv]
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        now += [] if kind == 0 else [(turn, role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, now in convs.items():
        now.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marked = set(), []
        for _, role, text in now:
            bare = re.sub(r"[\x20\x09-\x0D]", "", text)
            marked.append((role, text, 1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0))
            seen.add((role, text))
        turns = {t for t, _, _ in now if t is not None}
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit, text = cheapest(marked)
        counts = [sum(f == k for _, _, f in marked) for k in (1, 2, 3)]
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed, n):
    draw = random.Random(seed)
    for conv in range(n):
        for turn in range(draw.randint(1, 9)):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", None, "", "unknown", "tool"])
            text = draw.choice(["Yes.", "no", "Why? ", " \t", "", None, "x!\n", f"t{draw.randint(0, 3)}."])
            yield conv, draw.choice([turn, turn, turn, None, draw.randint(0, 4)]), role, text
    for turn in range(40):
        yield None, turn, draw.choice(["user", "assistant"]), f"line {turn % 30}."


CONV = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("seed", [1, 2])
def test_repair_against_all_edits(spark, seed):
    rows = [(*r, 0, "n") for r in conversations(seed, 400)]
    df = spark.createDataFrame(rows, f"{CONV}, gaps int, n string").repartition(5)
    got = sorted((tuple(r) for r in conversation_repair.repair_digests(df).collect()), key=str)
    assert got == repaired_by_hand([r[:4] for r in rows])
    assert conversation_repair.repair_digests(df.limit(0)).count() == 0


def test_repair_returns_its_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "More."), (1, 2, "assistant", "Well"), (2, 0, "system", "Be kind.")]
    got = {r.conv_id: r for r in conversation_repair.repair(spark.createDataFrame(rows, CONV)).collect()}
    by_hand = {r[0]: r for r in repaired_by_hand(rows, damage=False)}
    assert got[1].repaired == ["user:Hi.", "assistant:", "user:More.", "assistant:Well"] and got[1].audit == "KIKK"
    assert got[2].repaired == [] and (got[2].cost, got[2].audit) == by_hand[2][6:8] == (3, "D")


def test_long_conversation_keeps_ties_in_order():
    """Ways that tie all along: the least audit is found without comparing whole audits."""
    draw = random.Random(4)
    for roles in (["u"] + ["u", "a"] * 300, ["a", "u"] * 300, [draw.choice("ua") for _ in range(600)]):
        rows = [({"u": "user", "a": "assistant"}[r], f"{i}.", 0) for i, r in enumerate(roles)]
        way = conversation_repair.Repair(conversation_repair.Rows())
        for row in rows:
            way.append(*row)
        cost, audit, made = way.best()
        assert (cost, audit, "\n".join(made)) == cheapest(rows)


def test_production_repair(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted((tuple(r) for r in driver.queries()["op13_conversation_repair"](spark, sf_dir).collect()), key=str)
    assert got == repaired_by_hand(rows)
