import tracemalloc
import zlib
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from tokenizers import Tokenizer

from millrace.llm import bpe, packing, pieces, token_counts, token_records
from millrace.llm.bpe_library import library_ids
from millrace.llm.bpe_merge import merges
from millrace.llm.checksums import crc32c, masked
from millrace.llm.lexicon import Lexicon, compile_lexicon
from millrace.llm.pieces import PieceIds, coded

BYTE, PIECE = path("byte_bpe_50k.json"), path("piece_bpe_32k.model")
LIBRARY = Tokenizer.from_file(BYTE)
ODD = [" ", "  ", "\n", "\t", "\r\n", "a", "Foo", "bar", "'s", "'ll", "1", "23", "!", "é", "ß", "\xa0", "　", "<|endoftext|>", "中文"]
ODD += ["\x1c", "\x85", "​", "😀", "\0", "...", "▁", "<s>", "<0x0A>", "ԱՙӿԀ", "x" * 70]
texts = st.lists(st.one_of(st.sampled_from(ODD), st.text(max_size=4)), max_size=12).map("".join)
ROWS = [(5, "Hello  world.\nAgain"), (1, None), (3, ""), (5, "Hello  world.\nAgain"), (2, "x" * 9000), (None, " "), (4, "a b " * 3000), (7, "<|endoftext|> \n\n")]


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def documents(spark, rows=ROWS):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return df.selectExpr("doc_id", "text", "1 AS start", "'x' AS ids", "2 AS length", "3 AS k_id", "4 AS row")


@settings(max_examples=300, deadline=None)
@given(st.lists(texts, min_size=1, max_size=4))
def test_pieces_give_the_library_s_ids(rows):
    ids, at = library_ids(BYTE).encode(pa.array(rows, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [ids_of(t) for t in rows]


def test_encoding_needs_little_beside_its_ids(monkeypatch):
    # bytes of numpy and Python for each piece: its code, its end and its id are 20
    column = pa.array(["a b c d " * 125_000], pa.string())
    library_ids(BYTE).encode(column.slice(0, 0))
    tracemalloc.start()
    ids, _ = library_ids(BYTE).encode(column)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 36 * len(ids)
    monkeypatch.setattr(pieces, "AT_ONCE", 3)
    rows = [t or "" for _, t in ROWS]
    library_ids(BYTE).clear()
    ids, at = library_ids(BYTE).encode(pa.array(rows, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [ids_of(t) for t in rows]


@settings(max_examples=300, deadline=None)
@given(st.lists(texts, min_size=1, max_size=4))
def test_lexicon_and_merging_give_the_library_s_ids(tmp_path_factory, rows):
    file = tmp_path_factory.getbasetemp() / "lexicon.bin"
    if not file.exists():
        words = [bpe.as_bytes(w) for w in ("ĠFoo", "bar", "Foo", "Ġa", "a", "123", "Ã©")]
        file.write_bytes(compile_lexicon(dict(zip(words, merges(BYTE).merge(words)))))
    encoder = PieceIds(bpe.LexiconIds(Lexicon(str(file)), BYTE))
    ids, at = encoder.encode(pa.array(rows, pa.string()))
    for a, b, text in zip(at[:-1], at[1:], rows):
        assert ids[a:b].tolist() == ids_of(text)
        assert bpe.Decoder(BYTE)(ids[a:b]) == LIBRARY.decode(ids_of(text), skip_special_tokens=False)


def test_any_ids_decode_as_the_library_does():
    draw = np.random.default_rng(1)
    for _ in range(100):
        ids = draw.integers(0, 50257, 12)
        assert bpe.Decoder(BYTE)(ids) == LIBRARY.decode(ids.tolist(), skip_special_tokens=False)


def test_long_words_merge_like_short_ones():
    words = [b"abcdefgh" * 40, "é".encode() * 300, b"a" * 33, b"ab"]
    assert merges(BYTE).merge(words) == [ids_of(w.decode()) for w in words]


def test_lexicon_shares_endings_and_numbers_words(tmp_path):
    words = {w: [i, i + 1] for i, w in enumerate([b"a", b"aing", b"bing", b"cing", b"", b"zing", b"b"])}
    (tmp_path / "x").write_bytes(compile_lexicon(words))
    lexicon = Lexicon(str(tmp_path / "x"))
    found = lexicon.numbers([*words, b"ing", b"ain", b"aingx"])
    assert [lexicon.ids_of(n) for w, n in zip(words, found) if w] == [v for w, v in words.items() if w]
    assert found[-3:].tolist() == [-1, -1, -1]
    assert len(lexicon.final) == 6  # root, after a, after b, c and z, i, n, g at the end
    (tmp_path / "none").write_bytes(compile_lexicon({}))
    assert Lexicon(str(tmp_path / "none")).numbers([b"a"]).tolist() == [-1]


def test_round_trip(spark):
    got = sorted(map(tuple, bpe.round_trip(documents(spark), BYTE).collect()), key=str)
    want = []
    for doc, text in ROWS:
        ids = ids_of(text)
        raw = np.array(ids, "<u4").tobytes()
        want.append((doc, len(ids), sha256(raw).hexdigest(), sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bpe.round_trip(documents(spark, []), BYTE).count() == 0


def test_encode_then_decode(spark):
    df = documents(spark)
    name = bpe.build_lexicon(df.selectExpr("doc_id", "coalesce(text, '') AS text"), BYTE)
    back = bpe.decode(bpe.encode(df, BYTE, name), BYTE)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(((d, t or "") for d, t in ROWS), key=str)


def test_lexicon_words_are_counted_whole(spark, monkeypatch):
    texts = ["a b a c", "a b d", "e f", None, "", "w" * 65] * 4
    df = spark.createDataFrame([(t or "",) for t in texts], "text string").repartition(3)
    counts = bpe.word_counts(df)
    want = {r["word"]: r["n"] for r in counts.collect()}
    assert want["a"] == 8 and "w" * 65 not in want
    monkeypatch.setattr(bpe, "HELD_WORDS", 1)
    assert {r["word"]: r["n"] for r in bpe.word_counts(df).collect()} == want
    for size in range(len(want) + 2):
        got = bpe.frequent_words(counts, size)
        assert len(got) <= size and all(want[w] > n for w in got for v, n in want.items() if v not in got)
    assert sorted(bpe.frequent_words(counts, 100)) == sorted(want)


@settings(max_examples=200, deadline=None)
@given(st.lists(texts, min_size=1, max_size=4))
def test_token_counts_of_pieces(rows):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    counter = token_counts.counter(PIECE)
    for text in rows:
        pieces = token_counts.cut(" " + text.replace("▁", " ")) if text else []
        n = int(counter.counts(pieces, np.zeros(len(pieces), bool)).sum()) if pieces else 0
        assert n == len(library.encode(text))


def test_token_counts(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    want = [(d, len((t or "").encode()), n := len(library.encode(t or "")), n > 4096) for d, t in ROWS]
    got = token_counts.token_counts(documents(spark), PIECE).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert token_counts.token_counts(documents(spark, []), PIECE).count() == 0


def test_crc32c_and_its_mask():
    assert crc32c(np.frombuffer(b"123456789", np.uint8), np.array([9])).tolist() == [0xE3069283]
    assert masked(np.array([0xE3069283], np.uint32)).tolist() == [(0xE3069283 >> 15 | 0xE3069283 << 17 & 0xFFFFFFFF) + 0xA282EAD8 & 0xFFFFFFFF]
    strings = [bytes(range(256)) * k + b"tail" for k in (0, 1, 2, 9)]

    def plain(data):
        crc = 0xFFFFFFFF
        for byte in data:
            crc ^= byte
            for _ in range(8):
                crc = crc >> 1 ^ (0x82F63B78 if crc & 1 else 0)
        return crc ^ 0xFFFFFFFF

    assert crc32c(np.frombuffer(b"".join(strings), np.uint8), np.array([len(s) for s in strings])).tolist() == [plain(s) for s in strings]


def test_records(spark, tmp_path):
    folder = str(tmp_path / "records")
    got = [tuple(r)[:4] for r in token_records.record_digests(documents(spark), BYTE, 2, folder).collect()]
    want, start = [], 0
    for doc, text in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*ids_of(text), 2]
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want
    file = next(f for i in range(50) if (tmp_path / "records" / f"{i:06d}.rec").exists() and len(f := token_records.RecordFile(folder, i)) > 0)
    last = token_records.parse(file.record(len(file) - 1), 2)
    assert last[1][-1] == 2
    broken = np.fromfile(file.path, np.uint8)
    broken[20] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        token_records.unframe(broken, file.places[:-1], np.diff(file.places))


def test_no_records(spark, tmp_path):
    assert token_records.record_digests(documents(spark, []), BYTE, 2, str(tmp_path / "none")).count() == 0


def test_packing(spark):
    got = [r.asDict() for r in packing.packed(documents(spark), BYTE, 2048, 0).collect()]
    whole = sorted([(d, [*ids_of(t), 0]) for d, t in ROWS], key=str)
    assert sum(r["length"] for r in got) == sum(len(i) for _, i in whole)
    pieces = sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=str)
    want = []
    for doc, ids in whole:
        for k, (start, length) in enumerate(packing.cut(len(ids), 2048)):
            want.append((doc, k, start, length, zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())))
    assert pieces == sorted(want, key=str)
    for s in {r["sequence_id"] for r in got}:
        own = sorted((r["offset"], r["length"]) for r in got if r["sequence_id"] == s)
        assert [o for o, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1]] and sum(n for _, n in own) <= 2048
    assert packing.packed(documents(spark, []), BYTE).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=200), st.integers(1, 8))
def test_open_bins(lengths, most):
    bins = packing.OpenBins(64, most)
    used: dict[int, int] = {}
    for n in lengths:
        b, offset = bins.place(n)
        assert offset == used.get(b, 0) and offset + n <= 64
        used[b] = offset + n
        assert bins.open <= most + 1


def test_cut():
    assert packing.cut(5000, 2048) == [(0, 904), (904, 2048), (2952, 2048)]
    assert packing.cut(4096, 2048) == [(0, 2048), (2048, 2048)] and packing.cut(1, 2048) == [(0, 1)]


def test_coded_keeps_row_order():
    rows = ["a b", "a  b", "", "c\td", "a b"]
    c = coded(pa.array(rows))
    at = np.concatenate([[0], np.cumsum(c.sizes)])
    assert ["".join(c.values[k] for k in c.codes[a:b]) for a, b in zip(at[:-1], at[1:])] == rows
