"""Encoding and decoding with byte-level BPE through a lexicon of frequent words (operator 10).

One pass counts the words (pre-tokens) of all texts. The most frequent, at most a fixed number, are merged once, compiled into a
minimal acyclic transducer with their ids as output, and written to the shared folder; Spark hands the file to every
executor, whose workers memory-map it. Encoding looks words up in it and merges unseen ones exactly. Which words the
lexicon holds changes only speed, never ids.

A null text counts as empty and has no ids; long texts are taken whole. Strings of special tokens within a text become that token, as in the
tokenizers library. Rows are independent; repeated rows and ids, and extra columns, change nothing; an empty table gives
an empty result, with an empty lexicon.
"""

from __future__ import annotations

import functools
import hashlib
import re
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.bpe_library import LETTERS, PreTokens
from millrace.llm.bpe_merge import merges
from millrace.llm.common import discard, shared_folder, slices, store_of, texts, written
from millrace.llm.lexicon import Lexicon, compile_lexicon
from millrace.llm.pieces import PieceIds, coded

#: Words in the lexicon, which bounds its file and the work of compiling it.
LEXICON_WORDS = 100_000
#: Distinct pieces a counting task holds before it passes them on.
HELD_WORDS = 200_000
#: Letters of the longest piece whose words may be in the lexicon, which bounds its file.
LONGEST = 64
BYTES = {ord(c): b for b, c in enumerate(LETTERS)}


def as_bytes(word: str) -> bytes:
    """A word in byte letters as its bytes."""
    return word.translate(BYTES).encode("latin-1")


def word_counts(df: DataFrame) -> DataFrame:
    """(word, n): words in byte letters with how often they occur. A task passes on what it counted whenever it holds many."""

    def emit(count: Counter[str]) -> pa.RecordBatch:
        pre, words = PreTokens(), Counter()
        for piece, n in count.items():
            for word in pre(piece):
                words[word] += n
        return pa.RecordBatch.from_pydict({"word": pa.array(list(words), pa.string()), "n": pa.array(list(words.values()), pa.int64())})

    def run(batches):
        count: Counter[str] = Counter()
        for part in slices(batches):
            pieces = coded(part.column("text"))
            for piece, n in zip(pieces.values, np.bincount(pieces.codes, minlength=len(pieces.values)).tolist(), strict=True):
                if len(piece) <= LONGEST:
                    count[piece] += n
            if len(count) > HELD_WORDS:
                yield emit(count)
                count = Counter()
        yield emit(count)

    return df.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, size: int) -> list[str]:
    """The words with the largest counts, of each count all or none: as many counts as give at most `size` words."""
    # a count that is reached has a word at least, so `size` rows of these are enough
    by_count = counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.col("n").desc()).limit(size).collect()
    total, least = 0, None
    for row in by_count:
        total += row["words"]
        if total > size:
            break
        least = row["n"]
    return [] if least is None else [r["word"] for r in counts.where(F.col("n") >= least).select("word").collect()]


def build_lexicon(df: DataFrame, tokenizer_path: str, size: int = LEXICON_WORDS) -> str:
    """Compiles the at most `size` most frequent words of `df` and gives the file to all executors; returns its name there."""
    spark: SparkSession = df.sparkSession
    counts = written(word_counts(df), "words")
    words = sorted(as_bytes(w) for w in frequent_words(counts, size))
    discard(counts)
    content = compile_lexicon(dict(zip(words, merges(tokenizer_path).merge(words), strict=True)))
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    folder = shared_folder(spark, "lexicon")
    store, path = store_of(folder)
    store.create_dir(path, recursive=True)
    with store.open_output_stream(f"{path}/{name}") as out:
        out.write(content)
    spark.sparkContext.addFile(f"{folder}/{name}")
    return name


class LexiconIds:
    """Solves pieces: words by the lexicon, the rest by merging."""

    def __init__(self, lexicon: Lexicon, tokenizer_path: str):
        self.lexicon, self.merges, self.pre = lexicon, merges(tokenizer_path), PreTokens()
        special = sorted(self.merges.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

    def words(self, pieces: list[str]) -> list[list]:
        """The words of each piece; a special token is its id."""
        together = "\0".join(pieces)
        special = self.special if self.special and self.special.search(together) else None
        out = []
        for piece in pieces:
            if special and special.search(piece):
                cut = special.split(piece)
                out.append([x for i, p in enumerate(cut) for x in ([self.merges.special[p]] if i % 2 else self.pre(p))])
            else:
                out.append(self.pre(piece))
        return out

    def __call__(self, pieces: list[str]) -> list[list[int]]:
        split = self.words(pieces)
        distinct = list({w: None for words in split for w in words if isinstance(w, str)})
        raw = [as_bytes(w) for w in distinct]
        number = self.lexicon.numbers(raw)
        unseen = np.flatnonzero(number < 0)
        ids: dict = dict(zip((distinct[i] for i in unseen), self.merges.merge([raw[i] for i in unseen]), strict=True))
        start, flat = self.lexicon.start, self.lexicon.ids
        seen = np.flatnonzero(number >= 0)
        begin, end = start[number[seen]].tolist(), start[number[seen] + 1].tolist()
        for i, a, b in zip(seen.tolist(), begin, end, strict=True):
            ids[distinct[i]] = flat[a:b].tolist()
        return [ids[w[0]] if len(w) == 1 and isinstance(w[0], str) else [x for p in w for x in (ids[p] if isinstance(p, str) else [p])] for w in split]


@functools.lru_cache(maxsize=1)
def encoder(name: str, tokenizer_path: str) -> PieceIds:
    return PieceIds(LexiconIds(Lexicon(SparkFiles.get(name)), tokenizer_path))


class Decoder:
    """Ids back to text, bytes that are no text replaced as the library does."""

    def __init__(self, tokenizer_path: str):
        table = merges(tokenizer_path).bytes
        self.size = np.fromiter(map(len, table), np.int64, len(table))
        self.start = np.concatenate([[0], np.cumsum(self.size)[:-1]])
        self.text = np.frombuffer(b"".join(table), np.uint8)

    def __call__(self, ids: np.ndarray) -> str:
        size = self.size[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self.text[np.repeat(self.start[ids] - (ends - size), size) + np.arange(total)].tobytes().decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def decoder(tokenizer_path: str) -> Decoder:
    return Decoder(tokenizer_path)


def encode(df: DataFrame, tokenizer_path: str, lexicon: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids) of every whole text; ids are 32-bit little-endian unsigned numbers in a binary value."""

    def run(batches):
        for part in slices(batches):
            ids, at = encoder(lexicon, tokenizer_path).encode(part.column("text"))
            raw = ids.astype("<u4").tobytes()
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([raw[4 * a : 4 * b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.binary())],
                names=["doc_id", "ids"],
            )

    return texts(df, doc_id, text).mapInArrow(run, "doc_id long, ids binary")


def decode(df: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids count as none."""

    def run(batches):
        for part in slices(batches, "ids"):
            back = decoder(tokenizer_path)
            rows = part.column("ids").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([back(np.frombuffer(r or b"", "<u4")) for r in rows], pa.string())], names=["doc_id", "text"]
            )

    return df.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(df: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): every text encoded and decoded again."""
    plain = texts(df, doc_id, text)
    lexicon = build_lexicon(plain, tokenizer_path)

    def run(batches):
        for part in slices(batches):
            ids, at = encoder(lexicon, tokenizer_path).encode(part.column("text"))
            back, of_ids, of_text = decoder(tokenizer_path), [], []
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                own = ids[a:b]
                of_ids.append(hashlib.sha256(own.astype("<u4").tobytes()).hexdigest())
                of_text.append(hashlib.sha256(back(own).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(at)), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return plain.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
