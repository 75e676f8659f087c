"""Language identification by word-first backoff (operator 2).

A word that any language knows is scored by its log frequency in each language; an unseen word falls back to its character
n-grams, the longest length first of which any language knows one. A text's score for a language is the mean over
its words. The model holds the most frequent words and n-grams of each language and is fitted on a sample of labelled
documents: about `TRAINING_DOCS` of each language, chosen by a hash of the id. That bounds the model, and what is collected
and broadcast, whatever the size of the corpus; prediction covers every text.

Null ids are never trained on. A null text, or one without a letter, is `und` with score 0. Without any labelled
document every text is `und`. Ties go to the language that sorts first. Rows are independent.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import bounds, ship, slices, written

TRAINING_DOCS = 8_000
WORDS = 20_000
GRAMS = 6_000
LONGEST = 5
PENALTY = 7.0  # -log10 of the frequency taken for what a language does not know
UNKNOWN = "und"


def words_of(column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct words, codes of all words in order, words of each row): runs of letters in lower case."""
    plain = pc.utf8_trim(pc.replace_substring_regex(pc.utf8_lower(column.cast(pa.large_string())), r"[^\p{L}]+", " "), " ")
    lists = pc.split_pattern(plain, " ")
    named = lists.flatten().dictionary_encode()
    sizes = np.diff(np.asarray(lists.offsets, np.int64))
    return named.dictionary.to_pylist(), np.asarray(named.indices, np.int64), sizes


def grams(word: str, n: int) -> list[str]:
    held = f" {word} "
    return [held[i : i + n] for i in range(len(held) - n + 1)]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def training(df: DataFrame, docs: int = TRAINING_DOCS) -> DataFrame:
    """About `docs` labelled documents of each language, (lang, text); those held out never."""
    pool = df.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~F.col("held_out"))
    share = F.lit(0.0)
    for lang, n in sorted((r["lang"], r["count"]) for r in pool.groupBy("lang").count().collect()):
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, docs / n))).otherwise(share)
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(1 << 30)
    return pool.where(draw < share).select("lang", "text")


def frequencies(sample: DataFrame) -> DataFrame:
    """(lang, size, gram, n): words as size 0, and n-grams by size, counted in each task and added up."""

    def run(batches):
        count: dict[str, Counter] = {}
        for part in slices(batches):
            langs, codes = np.unique(np.asarray(part.column("lang").to_pylist(), dtype=object), return_inverse=True)
            words, seen, sizes = words_of(part.column("text"))
            lang = np.repeat(codes, sizes)
            for k, name in enumerate(langs):
                n = np.bincount(seen[lang == k], minlength=len(words))
                own = count.setdefault(name, Counter())
                for i in np.flatnonzero(n):
                    if words[i]:
                        own[words[i]] += int(n[i])
        for name, own in count.items():
            by_gram: Counter[str] = Counter()
            for word, n in own.items():
                for size in range(1, LONGEST + 1):
                    for gram in grams(word, size):
                        by_gram[gram] += n
            rows = [(name, 0, w, n) for w, n in own.items()] + [(name, len(g), g, n) for g, n in by_gram.items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names=["lang", "size", "gram", "n"])

    counted = sample.mapInArrow(run, "lang string, size long, gram string, n long")
    return counted.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))


class Model:
    """Scores words in all languages at once."""

    def __init__(self, langs: list[str], tables: list[dict[str, int]], values: np.ndarray, fallback: int):
        self.langs, self.fallback = langs, fallback
        self.tables = tables  # by size, 0 for words: gram -> row of `values`
        self.values = values  # -log10 frequency in each language

    def scores(self, words: list[str]) -> np.ndarray:
        """A row for each word: its own, or the mean over its longest known n-grams; NaN where not even a character is known."""
        rows: list[int] = []
        counts = np.zeros(len(words), np.int64)
        whole, tables = self.tables[0], self.tables
        for i, word in enumerate(words):
            if not word:
                continue
            row = whole.get(word)
            if row is not None:
                rows.append(row)
                counts[i] = 1
                continue
            held = f" {word} "
            for size in range(min(LONGEST, len(held)), 0, -1):
                table = tables[size]
                found = [table[g] for g in [held[k : k + size] for k in range(len(held) - size + 1)] if g in table]
                if found:
                    rows += found
                    counts[i] = len(found)
                    break
        out = np.full((len(words), len(self.langs)), np.nan)
        some = np.flatnonzero(counts)
        if some.size:
            total = np.add.reduceat(self.values[np.array(rows, np.int64)], bounds(counts[some])[:-1], axis=0)
            out[some] = total / counts[some][:, None]
        return out

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        words, codes, sizes = words_of(column)
        if not self.langs:
            return [UNKNOWN] * len(sizes), np.zeros(len(sizes))
        table = self.scores(words)
        known = ~np.isnan(table[:, 0])
        at = bounds(sizes)
        total = np.stack([np.diff(bounds_of(np.where(known, table[:, k], 0.0)[codes])[at]) for k in range(len(self.langs))], axis=1)
        n = np.diff(bounds_of(known[codes].astype(float))[at])
        lettered = np.diff(bounds_of(np.fromiter((w != "" for w in words), float, len(words))[codes])[at]) > 0
        mean = total / np.maximum(n, 1)[:, None]
        best = mean.argmin(axis=1)
        share = 10.0 ** -(mean - mean.min(axis=1, keepdims=True))
        score = share.max(axis=1) / share.sum(axis=1)
        best, score = np.where(n > 0, best, self.fallback), np.where(n > 0, score, 1.0 / len(self.langs))
        return [self.langs[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), lettered.tolist(), strict=True)], np.where(lettered, score, 0.0)


def bounds_of(values: np.ndarray) -> np.ndarray:
    return np.concatenate([[0.0], np.cumsum(values)])


def fit(df: DataFrame, docs: int = TRAINING_DOCS) -> tuple[list[str], list[dict], np.ndarray, int]:
    """What `Model` is made of, from (doc_id, text, lang, held_out)."""
    counts = written(frequencies(training(df, docs)), "frequencies")  # used twice
    totals = {(r["lang"], r["size"]): r["n"] for r in counts.groupBy("lang", "size").agg(F.sum("n").alias("n")).collect()}
    place = Window.partitionBy("lang", "size").orderBy(F.col("n").desc(), "gram")
    # at most WORDS + LONGEST * GRAMS rows of each language
    top = counts.withColumn("place", F.row_number().over(place)).where(F.col("place") <= F.when(F.col("size") == 0, WORDS).otherwise(GRAMS)).where(F.col("place") <= max(WORDS, GRAMS)).drop("place")
    langs = sorted({lang for lang, _ in totals})
    index = {lang: i for i, lang in enumerate(langs)}
    tables: list[dict] = [{} for _ in range(LONGEST + 1)]
    kept = top.toArrow()
    rows: list[int] = []
    for size, gram in zip(kept.column("size").to_pylist(), kept.column("gram").to_pylist(), strict=True):
        table = tables[size]
        rows.append(table.setdefault(gram, sum(map(len, tables))))
    values = np.full((sum(map(len, tables)), len(langs)), PENALTY)
    for row, lang, size, n in zip(rows, *(kept.column(c).to_pylist() for c in ("lang", "size", "n")), strict=True):
        values[row, index[lang]] = -np.log10(n / totals[lang, size])
    fallback = max(range(len(langs)), key=lambda i: (totals[langs[i], 0], -i)) if langs else 0
    return langs, tables, values, fallback


def language_id(df: DataFrame, docs: int = TRAINING_DOCS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every whole text; `df` has doc_id, text and lang."""
    ship(df.sparkSession)
    plain = df.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    ).withColumn("held_out", held_out(F.col("doc_id")))
    parts = df.sparkSession.sparkContext.broadcast(fit(plain, docs))

    def run(batches):
        model = Model(*parts.value)
        for part in slices(batches):
            lang, score = model.predict(pc.fill_null(part.column("text"), ""))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return plain.select("doc_id", "text", "held_out").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
