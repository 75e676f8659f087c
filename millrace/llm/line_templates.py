"""Line dedup by a log-template tree (operator 7).

Each line goes down a tree of fixed depth: its number of words, then its first `LEADING` words, words with a digit counting
as variable. Within a leaf, a word that stands at the same place in the lines of `MIN_SOURCES` texts or more is a constant,
any other is variable; a line with at least half of its words constant has the template that its constants make. A line is
removed where its template recurs in at least `MIN_SOURCES` documents that are not copies of each other, or, with
`LONG` words or more, where the line as it is (but for digits) recurs in at least `RECURS`, which short ones do by chance.

Copies are equal texts and near-duplicates by SimHash, as in operator 8; each class of them counts once, whatever its
size. A line that makes more than half of its document would make unlike documents near-duplicates, so that template is
counted by what its documents hold besides; and where it recurs, so are the other templates of these documents.

Equal texts are read once in a task, counted and judged once, and each row is returned with what its text came to; ids, null
or repeated, play no part. Only names of lines are moved; words are fetched for the lines that may have a template. Lines without a word are neither counted nor removed. Null text counts as empty. Long texts are taken whole,
and alone where they are longer than a slice. Other columns are kept as they are, in `row`. An empty table gives an empty
result. Frequent leaves, lines and words at a place are salted by how often they were counted.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import discard, heavy, ship, slices, written
from millrace.llm.simhash import SHINGLE, components, fingerprint, links, shingle_hashes, shingle_hashes_of
from millrace.operators.joins import left_lookup

LEADING = 3
MIN_SOURCES = 8
RECURS = 2
LONG = 6
VARIABLE = "<*>"
#: Names a text.
KEY = ["k_hash", "k_more"]
DIGIT = re.compile(r"\d")
#: Text read at once, or a single one.
READ_BYTES = 1 << 20
#: Names of texts that a task holds at most, to read copies once.
HELD_KEYS = 200_000


def masked(line: str) -> list[str]:
    """Words of a line, those with a digit as variables."""
    words = line.split()
    return [VARIABLE if DIGIT.search(w) else w for w in words] if DIGIT.search(line) else words


def leaf_of(words: list[str]) -> int:
    """The leaf's name, as a signed number."""
    return xxhash.xxh64_intdigest(f"{len(words)} " + " ".join(words[:LEADING]), 1) - (1 << 63)


def text_key(text: str) -> tuple[Column, Column]:
    """What names a text: 128 bits of hash."""
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return F.xxhash64(t).alias("k_hash"), F.xxhash64(F.lit(1), t).alias("k_more")


def read_lines(docs: DataFrame) -> DataFrame:
    """What one reading of each text gives: its fingerprints, and leaf, name, number of words and first use of every line.

    `longest` is the place of the line that has more than half of all words, or -1; `rest` is the fingerprint without that
    line. A line without a word has leaf 0. `first` is 2 where the text has not had the line before, nor another of its leaf,
    1 where it has had the leaf only, else 0. `said` has the masked lines. A task gives each text once.
    """

    def run(batches):
        done: set[tuple[int, int]] = set()
        for part in slices(batches, limit=READ_BYTES):
            rows: dict[str, list] = {c: [] for c in ("longest", "whole", "rest", "leaves", "lines", "sizes", "first", "said")}
            own = []
            for i, key in enumerate(zip(*(part.column(c).to_pylist() for c in KEY), strict=True)):
                if key in done:
                    continue
                if len(done) >= HELD_KEYS:
                    done.clear()
                done.add(key)
                own.append(i)
            part = part.take(pa.array(own, pa.int64()))
            texts = part.column("text").to_pylist()
            for text, hashes in zip(texts, shingle_hashes_of(texts), strict=True):
                words = [masked(line) for line in text.split("\n")]
                said = [" ".join(w) for w in words]
                sizes = [len(w) for w in words]
                leaves = [leaf_of(w) if w else 0 for w in words]
                seen: set[str] = set()
                met: set[int] = set()
                first = []
                for leaf, line in zip(leaves, said, strict=True):
                    first.append(0 if line in seen else 1 if leaf in met else 2)
                    seen.add(line)
                    met.add(leaf)
                most = max(range(len(words)), key=sizes.__getitem__)
                most = most if 2 * sizes[most] > sum(sizes) else -1
                rows["longest"].append(most)
                rows["whole"].append(fingerprint(hashes))
                rows["rest"].append(rows["whole"][-1] if most < 0 else fingerprint(hashes_without(text, most, hashes)))
                rows["leaves"].append(leaves)
                rows["lines"].append([xxhash.xxh64_intdigest(line, 2) - (1 << 63) for line in said])
                rows["sizes"].append(sizes)
                rows["first"].append(first)
                rows["said"].append("\n".join(said))
            prints = {c: pa.array(np.array(rows[c], np.uint64).view(np.int64)) for c in ("whole", "rest")}
            lists = {c: pa.array(rows[c], pa.list_(kind)) for c, kind in (("leaves", pa.int64()), ("lines", pa.int64()), ("sizes", pa.int32()), ("first", pa.int8()))}
            yield pa.RecordBatch.from_pydict({c: part.column(c) for c in KEY} | {"longest": pa.array(rows["longest"], pa.int32())} | prints | lists | {"said": pa.array(rows["said"], pa.string())})

    return docs.mapInArrow(
        run,
        "k_hash long, k_more long, longest int, whole long, rest long, leaves array<long>, lines array<long>, sizes array<int>, first array<byte>, said string",
    )


def hashes_without(text: str, place: int, hashes: np.ndarray) -> np.ndarray:
    """The shingle hashes of a text without one of its lines, from those of the text.

    Only shingles over the gap are new.
    """
    lines = text.split("\n")
    before, line, after = ("\n".join(x).encode().split() for x in (lines[:place], lines[place : place + 1], lines[place + 1 :]))
    if len(before) + len(after) < 2 * SHINGLE:
        return shingle_hashes("\n".join(lines[:place] + lines[place + 1 :]))
    near = b" ".join(before[len(before) - min(len(before), SHINGLE - 1) :] + after[: SHINGLE - 1]).decode()
    gap = shingle_hashes(near) if before and after else hashes[:0]
    return np.concatenate([hashes[: max(0, len(before) - SHINGLE + 1)], gap, hashes[len(before) + len(line) :]])


def templates(counts: DataFrame, least: int) -> DataFrame:
    """(leaf, line, template) of the lines that have enough constants, from lines with the texts `n` that have them.

    The leading words of a leaf are constant by what a leaf is. Words are compared by 64-bit hashes, and a template is the
    exclusive-or of its constants with their places, so that no line's words are put together again.
    """
    words = counts.select("leaf", "line", "n", F.posexplode(F.split("said", " ")).alias("at", "word"))
    open_word = (F.col("at") >= LEADING) & (F.col("word") != VARIABLE)
    words = written(
        words.select("leaf", "line", "n", "at", F.when(open_word, F.xxhash64("word")).alias("word"), ((F.col("word") != VARIABLE) & ~open_word).alias("leading"), F.xxhash64("at", "word").alias("part")),
        "words",
    )
    by_place = written(words.where("word IS NOT NULL").groupBy("leaf", "at", "word").agg(F.sum("n").alias("m"), F.count("*").alias("rows")).where(F.col("m") >= least), "constants")
    keys = ["leaf", "at", "word"]
    kept = left_lookup(words, by_place.select(*keys, F.lit(True).alias("constant")), keys, heavy=heavy(by_place, keys, "rows"))
    constant = F.coalesce("constant", "leading")
    shape = kept.groupBy("leaf", "line").agg(F.bit_xor(F.when(constant, F.col("part"))).alias("shape"), F.count_if(constant).alias("constants"), F.count("*").alias("size"))
    shape = shape.where("2 * constants >= size").select("leaf", "line", F.xxhash64("leaf", "shape", "constants").alias("template"))
    shape = written(shape, "shapes")
    discard(words, by_place)
    return shape


def classes(first: DataFrame) -> DataFrame:
    """(k_hash, k_more, longest, whole, rest): fingerprints replaced by what names the class of near-duplicates."""
    both = first.select(F.col("whole").alias("fp")).union(first.select(F.col("rest").alias("fp"))).distinct()
    root_of = written(components(links(written(both, "prints"))), "roots")
    for name in ("whole", "rest"):
        root = root_of.select(F.col("node").alias(name), "root")
        first = left_lookup(first, root, [name]).withColumn(name, F.coalesce("root", name)).drop("root")
    return first.select(*KEY, "longest", "whole", "rest")


def recurring(held: DataFrame) -> DataFrame:
    """The templates that enough classes of documents have, from (template, need, key)."""
    once = held.groupBy("template", "need", "key").agg(F.lit(1).alias("one"))
    return once.groupBy("template", "need").count().where("count >= need").select("template")


def named_lines(tree: DataFrame, read: DataFrame, least: int, recurs: int) -> DataFrame:
    """(k_hash, k_more, place, template, need): the templates of lines that may recur, where they stand.

    `tree` has each text once, `read` the lines as they were read.
    """
    # only lines of leaves that recur can have a template that does
    uses = tree.select(F.explode(F.arrays_zip("leaves", "first")).alias("x")).select(F.col("x.leaves").alias("leaf"), F.col("x.first").alias("first"))
    often = uses.where("leaf <> 0").groupBy("leaf").agg(F.count_if(F.col("first") == 2).alias("texts"), F.count("*").alias("rows"))
    often = written(often.where("texts > 1"), "leaves")
    at = tree.select(*KEY, F.posexplode(F.arrays_zip("leaves", "lines", "sizes", "first")).alias("place", "x"))
    at = at.select(*KEY, "place", F.col("x.leaves").alias("leaf"), F.col("x.lines").alias("line"), F.col("x.sizes").alias("size"), F.col("x.first").alias("first"))
    found = left_lookup(at.where("leaf <> 0"), often.select("leaf", "texts"), ["leaf"], "inner", salted=True, heavy=heavy(often, ["leaf"], "rows"))
    found = written(found, "lines")
    counts = found.groupBy("leaf", "line").agg(
        F.count_if(F.col("first") > 0).alias("n"), F.count("*").alias("rows"), F.max("texts").alias("texts"), F.max("size").alias("size")
    )
    counts = written(counts, "counts")
    wanted = written(often.where(F.col("texts") >= least).select("leaf"), "like")  # few: of its own size, so that words are not moved
    said = read.select(F.arrays_zip("leaves", "lines", "first", F.split("said", "\n").alias("said")).alias("x")).select(F.inline("x"))
    said = said.where("leaves <> 0 AND first > 0").select(F.col("leaves").alias("leaf"), F.col("lines").alias("line"), "said")
    said = left_lookup(said, wanted, ["leaf"], "inner", heavy=heavy(often, ["leaf"], "rows"))
    said = said.groupBy("leaf", "line").agg(F.first("said").alias("said"))
    spoken = written(counts.where(F.col("texts") >= least).select("leaf", "line", "n").join(said, ["leaf", "line"]), "said")
    shaped = templates(spoken, least)
    need = F.when(F.col("size") >= LONG, min(recurs, least)).otherwise(least)
    as_it_is = F.when(F.col("n") >= need, F.struct(F.xxhash64(F.lit(1), "leaf", "line").alias("template"), need.alias("need")))
    like = F.when(F.col("template").isNotNull(), F.struct("template", F.lit(least).alias("need")))
    names = counts.join(shaped, ["leaf", "line"], "left").select("leaf", "line", F.array_compact(F.array(as_it_is, like)).alias("names"))
    names = written(names.where(F.size("names") > 0), "names")
    keys = ["leaf", "line"]
    marked = left_lookup(found.select(*KEY, "place", *keys), names, keys, "inner", heavy=heavy(counts, keys, "rows"))
    marked = written(marked.select(*KEY, "place", F.inline("names")), "marked")
    discard(often, wanted, found, counts, spoken, shaped, names)
    return marked


def dropped_lines(docs: DataFrame, least: int = MIN_SOURCES, recurs: int = RECURS) -> DataFrame:
    """(k_hash, k_more, places): the lines of each distinct text that are to go, from (k_hash, k_more, text) of every row."""
    read = written(read_lines(docs), "read")
    once = read.groupBy(*KEY).agg(F.first(F.struct("longest", "whole", "rest", "leaves", "lines", "sizes", "first")).alias("x"))
    tree = written(once.select(*KEY, "x.*"), "texts")
    marked = named_lines(tree, read, least, recurs)
    discard(read)
    first = written(classes(tree.select(*KEY, "longest", "whole", "rest")), "classes")
    discard(tree)
    held = (
        marked.join(first, KEY)
        .groupBy("template", "need", *KEY)
        .agg(F.max(F.col("place") == F.col("longest")).alias("most"), F.min("whole").alias("whole"), F.min("rest").alias("rest"))
    )
    held = written(held, "held")
    large = recurring(held.withColumn("key", F.when(F.col("most"), F.col("rest")).otherwise(F.col("whole"))))
    large = written(large, "large")
    without = left_lookup(held.where("most"), large.distinct(), ["template"], "inner").select(*KEY, F.lit(True).alias("without")).distinct()
    without = written(without, "without")
    again = written(held.join(without, KEY).select("template").distinct(), "again")
    small = left_lookup(held, again, ["template"], "inner").join(without, KEY, "left")
    small = recurring(small.withColumn("key", F.when(F.col("most") | F.col("without"), F.col("rest")).otherwise(F.col("whole"))))
    gone = written(large.union(small).distinct(), "gone")
    places = left_lookup(marked, gone, ["template"], "inner").groupBy(*KEY).agg(F.sort_array(F.collect_set("place")).alias("places"))
    places = written(places, "places")
    discard(marked, first, held, large, without, again, gone)
    return places


def without_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = MIN_SOURCES) -> DataFrame:
    """(row, n_lines, n_dropped, kept_text): every row of `df` whole as `row`, with what is left of its text."""
    ship(df.sparkSession)
    own = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    gone = dropped_lines(df.select(*text_key(text), own.alias("text")), least)
    whole = df.select(*text_key(text), F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"))
    copies = written(df.select(*text_key(text)).groupBy(*KEY).agg(F.count("*").alias("rows")), "copies")
    many = written(heavy(copies, KEY, "rows"), "many")
    discard(copies)
    # by the shuffle at every size, so that the cost stays in proportion
    joined = left_lookup(whole, gone, KEY, salted=True, heavy=many)
    t = F.coalesce(F.col(f"row.`{text}`").cast("string"), F.lit(""))
    lines = F.split(t, "\n")
    rest = F.when(F.col("places").isNull(), t).otherwise(F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("places", i)), "\n"))
    return joined.select(
        "row",
        F.size(F.filter(lines, lambda x: x.rlike(r"\S"))).cast("long").alias("n_lines"),
        F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_dropped"),
        rest.alias("kept_text"),
    )


def clean_documents(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows of `df` with all their columns, their text without the recurring lines."""
    return without_lines(df, doc_id, text).select(*((F.col("kept_text") if c == text else F.col(f"row.`{c}`")).alias(c) for c in df.columns))


def digests(df: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every row."""
    return without_lines(df).select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
