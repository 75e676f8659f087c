"""Steps inside operators: the run-length index against a plain search, shingles hashed many at once, lines read."""

import random

import numpy as np
import pytest

from millrace.llm import line_templates, run_length_index, simhash
from millrace.llm.common import bounds
from millrace.llm.run_length_index import RunLengthIndex


def pieces(seed, n, longest):
    draw = np.random.default_rng(seed)
    few = [draw.integers(0, 2, int(k), np.uint8) for k in draw.integers(1, longest, 6)]  # with zero bytes
    out = []
    for _ in range(n):
        own = few[draw.integers(6)].copy()
        if draw.random() < 0.5:
            own[draw.integers(len(own))] ^= 1
        out.append(own[draw.integers(len(own)) :] if draw.random() < 0.3 else own)
    return np.concatenate(out), np.array([len(p) for p in out])


@pytest.mark.parametrize("triple", [1 << 21, 0])
def test_matches_as_found_by_hand(monkeypatch, triple):
    monkeypatch.setattr(run_length_index, "TRIPLE", triple)
    for seed in range(12):
        text, sizes = pieces(seed, 40, 60)
        begin = bounds(sizes)
        for length in (1, 7, 8, 20):
            seen, later = set(), []
            for a, b in zip(begin[:-1], begin[1:], strict=True):
                for i in range(a, b - length + 1):
                    word = text[i : i + length].tobytes()
                    if word in seen:
                        later.append(i)
                    seen.add(word)
            assert RunLengthIndex(text, sizes).later_matches(length).tolist() == later
    assert RunLengthIndex(np.zeros(0, np.uint8), np.zeros(0, np.int64)).later_matches(3).tolist() == []


def test_pieces_of_contexts_take_few_sorts(monkeypatch):
    sorts = []
    for name in ("argsort", "lexsort"):
        plain = getattr(np, name)
        monkeypatch.setattr(np, name, lambda *a, plain=plain, **k: sorts.append(1) or plain(*a, **k))
    text, sizes = pieces(1, 3000, 176)
    assert RunLengthIndex(text, sizes).runs and len(sorts) <= 5


def test_many_shingles_hash_as_one_by_one():
    draw = random.Random(3)
    texts = ["", "one", "Two wOrds", *(" ".join("".join(draw.choice("aZ1é\x1c漢") for _ in range(draw.randrange(1, 16))) for _ in range(draw.randrange(9))) for _ in range(400))]
    got = simhash.shingle_hashes_of(texts)
    assert all(np.array_equal(a, simhash.shingle_hashes(t)) for a, t in zip(got, texts, strict=True)) and simhash.shingle_hashes_of([]) == []
    for text in ("a b c\nd\ne f", "\nx\n", "x", "a\nb c d e\nf", "a b\n\x1c \n c é d"):
        lines = text.split("\n")
        for i in range(len(lines)):
            rest = simhash.shingle_hashes("\n".join(lines[:i] + lines[i + 1 :]))
            assert np.array_equal(line_templates.hashes_without(text, i, simhash.shingle_hashes(text)), rest)


def test_words_of_lines_without_template_stay_where_they_are(spark, monkeypatch):
    rows = [(i, f"alone {i:x} {'abcdefgh'[i % 8]} " + "word " * (i % 5) + f"\nthe same line in every text x{'abc'[i % 3]}") for i in range(400)]
    said, texts = [], []
    plain = line_templates.written
    monkeypatch.setattr(line_templates, "written", lambda df, name: {"said": said, "read": texts}.get(name, []).append(t := plain(df, name)) or t)
    monkeypatch.setattr(line_templates, "discard", lambda *tables: None)
    df = spark.createDataFrame(rows * 3, "doc_id long, text string").repartition(4)
    kept = {r.doc_id: r.n_dropped for r in line_templates.without_lines(df).select("row.doc_id", "n_dropped").collect()}
    assert len(kept) == 400 and said[0].where("said LIKE 'the same line%'").count() == 3
    assert texts[0].count() <= 4 * 400 and set(said[0].columns) == {"leaf", "line", "n", "said"}
