"""Quality rules, line first (operator 6): built-in functions only.

Lines are split at line ends; one without a word is neither judged nor counted. A line fails when it does not end with a
closing mark, when marks or symbols crowd its words, when it is a row of navigation links, or when it holds a stock phrase.
Failed lines are removed; a document goes when its failed lines hold more than half of the characters of its words, or
when it is too short or repeats itself too much (`base_failed`).

Repeated three-word windows are found by 64-bit hashes within a document, sorted with their places.

Null text counts as empty: no words, which fails. Rows are independent; repeated rows and ids, other columns, and an
empty table need no special case.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space between words, closing marks, symbols, and stock phrases in lower case.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
SPACES = " \t\n\v\f\r"
CLOSING = r"[.!?…:;\"'”’»)\]。！？][\x20\x09-\x0D]*$"
CLOSING_MARKS = tuple(".!?…:;\"'”’»)]。！？")
SYMBOL = r"[#*$%&|<>]"
SYMBOLS = "#*$%&|<>"
CROWDED = r"[!?][!?]|[#*$%&|<>]"
LINKS = r"(\|.*\|)|(».*»)|(›.*›)|(>.*>)"
PHRASES = (
    "all rights reserved|licensed under|released under the|terms of (use|service)|privacy policy|use cookies|enable javascript"
    "|lorem ipsum|click here|sign up for|subscribe to our|skip to (main )?content|powered by"
)
MIN_WORDS = 50
REPEATED_PERCENT = 50
LOST_PERCENT = 50
CROWDED_PERCENT = 20


def count_of(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def words_of(text: Column) -> Column:
    for space in SPACES[1:]:
        text = F.replace(text, F.lit(space), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def bare(line: Column) -> Column:
    """A line without white space at its end; empty if it has no word."""
    return F.rtrim(line, F.lit(SPACES))


def holds(text: Column, parts) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(p)) for p in parts])


def line_fails(line: Column) -> Column:
    """Whether a line with a word is to be removed. What a pattern cannot do without is looked for before the pattern is."""
    crowd = F.regexp_count(line, F.lit(CROWDED)) * 100
    words = F.regexp_count(line, F.lit(WORD + "+"))
    return (
        ~F.right(bare(line), F.lit(1)).isin(*CLOSING_MARKS)
        | (holds(line, [*SYMBOLS, *(a + b for a in "!?" for b in "!?")]) & (crowd > words * CROWDED_PERCENT))
        | (holds(line, "|»›>") & line.rlike(LINKS))
        | F.lower(line).rlike(PHRASES)
    )


def measured(df: DataFrame, doc_id: str = "doc_id", text: str = "text", cleaned: bool = False) -> DataFrame:
    """All measures and the verdict of every whole text; with `cleaned`, also `clean_text`, which has the failed
    lines removed, and `row`, all columns of `df` as they were.
    """
    whole = [F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row")] if cleaned else []
    d = df.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("t"), *whole
    )
    judged = F.transform(
        F.split("t", "\n"), lambda x: F.struct(x.alias("x"), F.when(bare(x) != "", line_fails(x)).alias("bad"))
    )
    d = with_repeated_words(once(d, w=words_of(F.col("t"))))
    d = once(d, lines=judged)
    d = once(d, worded=F.transform(F.filter("lines", lambda x: x.bad.isNotNull()), lambda x: x.x))
    lost = F.array_join(F.transform(F.filter("lines", lambda x: x.bad), lambda x: x.x), "\n")
    clean = F.array_join(F.transform(F.filter("lines", lambda x: ~F.coalesce(x.bad, F.lit(False))), lambda x: x.x), "\n")
    measures = F.struct(
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.when(holds(F.col("t"), SYMBOLS), count_of(F.col("t"), SYMBOL)).otherwise(0).cast("long").alias("n_symbols"),
        (F.size("worded") - F.size(F.array_distinct("worded"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.size("worded").cast("long").alias("n_lines"),
        F.size(F.filter("lines", lambda x: x.bad)).cast("long").alias("n_lines_removed"),
        F.length(F.regexp_replace(lost, SPACE + "+", "")).cast("long").alias("lost_chars"),
        *([clean.alias("clean_text")] if cleaned else []),
    )
    d = once(d, m=measures).select("doc_id", "m.*", *(["row"] if cleaned else []))
    base = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEATED_PERCENT)
    kept = ~F.col("base_failed") & (F.col("lost_chars") * 100 <= F.col("word_chars") * LOST_PERCENT)
    return d.withColumn("base_failed", base).withColumn("kept", kept)


def once(d: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are computed a single time: each is unfolded from an array of one.

    A projection would be folded into every later use, a filter on it even into the scan, once for each mention.
    """
    for name, column in columns.items():
        d = d.select("*", F.explode(F.array(column)).alias(name))
    return d


def with_repeated_words(d: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words in three-word windows that the text has twice or more."""
    windows = """CASE WHEN size(w) < 3 THEN array() ELSE
        sort_array(transform(slice(w, 1, size(w) - 2), (x, i) -> struct(xxhash64(x, w[i + 1], w[i + 2]) AS h, i AS i))) END"""
    places = """array_sort(array_compact(transform(s, (x, j) ->
        CASE WHEN x.h = get(s, j - 1).h OR x.h = get(s, j + 1).h THEN x.i END)))"""
    covered = "aggregate(transform(p, (x, j) -> least(3, coalesce(get(p, j + 1) - x, 3))), 0L, (a, x) -> a + x)"
    d = once(once(d, s=F.expr(windows)), p=F.expr(places))
    return d.withColumn("n_repeat_words", F.expr(covered)).drop("s", "p")


COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_lines_removed", "lost_chars")


def quality(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The measures and the verdict of every whole text."""
    return measured(df, doc_id, text).select(*COLUMNS)


#: The same in SQL for checking.
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
lines AS (
  SELECT r, doc_id, n, x FROM (
    SELECT r, doc_id, unnest(string_split(t, chr(10))) AS x, unnest(range(len(string_split(t, chr(10))))) AS n FROM d)
  WHERE regexp_matches(x, '{WORD}')),
judged AS (
  SELECT r, n, x, length(regexp_replace(x, '{SPACE}+', '', 'g')) AS chars,
    NOT regexp_matches(x, '{CLOSING.replace("'", "''")}')
    OR len(regexp_extract_all(x, '{CROWDED}')) * 100 > len(regexp_extract_all(x, '{WORD}+')) * {CROWDED_PERCENT}
    OR regexp_matches(x, '{LINKS}') OR regexp_matches(lower(x), '{PHRASES}') AS bad
  FROM lines),
by_line AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup_lines, count(*) FILTER (bad) AS n_lines_removed,
    coalesce(sum(chars) FILTER (bad), 0) AS lost_chars
  FROM judged GROUP BY r),
words AS (
  SELECT r, i, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM (
    SELECT r, unnest(regexp_extract_all(t, '{WORD}+')) AS w, unnest(range(len(regexp_extract_all(t, '{WORD}+')))) AS i FROM d)
  WINDOW o AS (PARTITION BY r ORDER BY i)),
again AS (SELECT r, i FROM (
  SELECT r, i, count(*) OVER (PARTITION BY r, w, w2, w3) AS c FROM words WHERE w3 IS NOT NULL) WHERE c > 1),
by_word AS (
  SELECT r, count(*) AS n_words, sum(length(w)) AS word_chars FROM words GROUP BY r),
by_window AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
m AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
    len(regexp_extract_all(t, '{SYMBOL}')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
    coalesce(n_lines_removed, 0) AS n_lines_removed, coalesce(lost_chars, 0) AS lost_chars
  FROM d LEFT JOIN by_line USING (r) LEFT JOIN by_word USING (r) LEFT JOIN by_window USING (r)),
b AS (SELECT *, n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {REPEATED_PERCENT} AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND lost_chars * 100 <= word_chars * {LOST_PERCENT} AS kept, n_lines::BIGINT AS n_lines,
  n_lines_removed::BIGINT AS n_lines_removed, lost_chars::BIGINT AS lost_chars
FROM b
"""


def clean_documents(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that pass, with all their columns, their text without the failed lines."""
    passed = measured(df, doc_id, text, cleaned=True).where("kept")
    return passed.select(*((F.col("clean_text") if c == text else F.col(f"row.`{c}`")).alias(c) for c in df.columns))
