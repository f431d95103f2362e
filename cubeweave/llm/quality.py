"""Quality rules, line first, as column expressions.

Lines that are navigation, symbols, shouting, repeats or boilerplate are
removed; a document that loses too much of its text, or what remains of it too
little or too repetitive, is rejected.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of a window, and the least words of a document.
WINDOW = 5
LEAST_WORDS = 10
#: Most of a document's words, in percent, that may be in windows found twice or more.
MOST_REPEATED = 20
#: Least of a document's word characters, in percent, that its clean lines must hold.
LEAST_CLEAN = 50
#: Most of a document's words, in percent, that may equal the word before them.
MOST_STUTTERS = 30
#: Symbols for 100 word characters beyond which a line is navigation or noise.
MOST_SYMBOLS = 5
#: A line of fewer words needs punctuation.
SHORT_LINE = 3
#: A line is boilerplate if it has one of these phrases (fixed values).
BOILERPLATE = [
    "all rights reserved",
    "cookie policy",
    "copyright (c)",
    "click here",
    "javascript is disabled",
    "privacy policy",
    "subscribe to our",
    "terms of service",
    "terms of use",
]
SPACES = " \t\n\x0B\f\r"
SYMBOLS = "#*$%&|<>"
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def _without(text: Column, characters: str) -> Column:
    """The text without the characters; each is ASCII, so bytes can be compared."""
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _split(text: Column) -> Column:
    """The words: runs of characters other than U+0020 and U+0009 to U+000D."""
    for c in SPACES[1:]:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def _repeated(words: Column) -> Column:
    """How many words are in windows of WINDOW words that are found twice or more.

    Windows are compared by 64-bit numbers made from their words' numbers.
    Documents without a repeated window, nearly all, end after one pass.
    """
    number = F.transform(words, lambda w: F.xxhash64(w))

    def windows(n: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(n) - WINDOW)
        return F.transform(places, lambda i: F.xxhash64(*(F.get(n, i + j) for j in range(WINDOW))))

    def positions(w: Column) -> Column:
        """Places of repeated windows, in order: equal windows are neighbours after sorting."""
        marked = F.array_sort(F.transform(w, lambda x, i: F.struct(x.alias("w"), i.alias("i"))))
        return F.array_sort(
            _let(marked, lambda m: F.filter(F.transform(m, lambda x, i: F.when((F.get(m, i - 1)["w"] == x["w"]) | (F.get(m, i + 1)["w"] == x["w"]), x["i"])), lambda i: i.isNotNull()))
        )

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    count = _let(number, lambda n: _let(windows(n), lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(_let(positions(w), covered))))
    return F.when(F.size(words) > WINDOW, count).otherwise(F.lit(0))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def _word_characters(text: Column) -> Column:
    return F.length(_without(text, SPACES))


def _clean(line: Column) -> Column:
    """Whether a line passes the rules of lines."""
    phrases = "|".join(re.escape(p) for p in BOILERPLATE)
    words = WORD + (SPACE + WORD) * (SHORT_LINE - 1)
    symbols = F.length(line) - F.length(_without(line, SYMBOLS))
    shouting = line.rlike(r"\p{Lu}") & ~line.rlike(r"\p{Ll}") & line.rlike(words)
    fragment = ~line.rlike("[.!?:;]") & ~line.rlike(words)
    return (symbols * 100 <= _word_characters(line) * MOST_SYMBOLS) & ~shouting & ~fragment & ~F.lower(line).rlike(phrases)


def _judged(docs: DataFrame, text_col: str) -> DataFrame:
    """Each row of ``docs`` as the column row, with its statistics and verdict."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select("*", _split(F.col("text")).alias("words"), F.split("text", "\n").alias("lines"))
    filled = lambda line: line.rlike(WORD)
    rows = rows.select("*", F.filter(F.array_distinct("lines"), filled).alias("distinct"))
    rows = rows.select("*", F.filter("distinct", _clean).alias("clean"))
    statistics = F.struct(
        F.size("words").cast("bigint").alias("n_words"),
        _word_characters(F.col("text")).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("bigint").alias("n_symbols"),
        (F.size(F.filter("lines", filled)) - F.size("distinct")).cast("bigint").alias("n_dup_lines"),
        _repeated(F.col("words")).cast("bigint").alias("n_repeat_words"),
        F.size(F.filter("words", lambda w, i: w == F.get("words", i - 1))).cast("bigint").alias("n_stutters"),
        _word_characters(F.array_join("clean", "")).cast("bigint").alias("clean_chars"),
        F.array_join("clean", "\n").alias("clean_text"),
    )
    # a generator, so that a filter on the verdict is not pushed below the columns above and makes them again for each use
    rows = rows.select("row", F.inline(F.array(statistics)))
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    rows = rows.withColumn("base_failed", failed)
    clean = (F.col("clean_chars") * 100 >= F.col("word_chars") * LEAST_CLEAN) & (F.col("n_stutters") * 100 <= F.col("n_words") * MOST_STUTTERS)
    return rows.withColumn("kept", ~F.col("base_failed") & clean)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Statistics and verdict of each row of ``docs``.

    Returns the id column, n_words, word_chars (code points in words),
    n_symbols, n_dup_lines (lines with a word that equal an earlier line),
    n_repeat_words (words in windows of five that the text has twice or more),
    clean_chars (word characters of the distinct lines that pass the rules of
    lines), clean_text (those lines), base_failed (fewer than 10 words, or more than
    20 % of them repeated), n_stutters (words that equal the one before) and
    kept: not base_failed, at least half of the word characters are in clean
    lines, and at most 30 % of the words are stutters.

    Null and empty texts have no words and fail. Repeated rows are judged
    alike, each on its own; an empty table gives no rows. Other columns of
    ``docs`` are not returned.
    """
    judged = _judged(docs.select(id_col, text_col), text_col)
    return judged.select(F.col("row")[id_col].alias(id_col), *[c for c in judged.columns if c != "row"])


def passing(docs: DataFrame, text_col: str = "text", cleaned: bool = False) -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, with all their columns.

    Texts are whole, or, ``cleaned``, the lines that pass the rules of lines: one of
    each, in order, without those that have no word.
    """
    kept = _judged(docs, text_col).where("kept")
    if not cleaned:
        return kept.select("row.*")
    row = F.col("row")
    return kept.select(*[F.col("clean_text").alias(c) if c == text_col else row.getField(c).alias(c) for c in docs.columns])


def digests(docs: DataFrame) -> DataFrame:
    return quality_rules(docs).drop("clean_text", "clean_chars", "n_stutters")


#: The same in SQL for DuckDB.
SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws, string_split(t, chr(10)) AS ls FROM d),
g AS (SELECT doc_id, i, ws[i:i+{WINDOW - 1}] AS gram FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM w)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, (SELECT unnest(range({WINDOW})) AS k) GROUP BY doc_id),
f AS (SELECT doc_id, t, ws, list_filter(ls, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM w),
l AS (SELECT doc_id, line FROM (SELECT doc_id, unnest(list_distinct(ls)) AS line FROM f)
  WHERE len(regexp_replace(line, '[^{SYMBOLS}]', '', 'g')) * 100 <= len(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) * {MOST_SYMBOLS}
  AND NOT (regexp_matches(line, '\p{{Lu}}') AND NOT regexp_matches(line, '\p{{Ll}}') AND regexp_matches(line, '{WORD + (SPACE + WORD) * (SHORT_LINE - 1)}'))
  AND NOT (NOT regexp_matches(line, '[.!?:;]') AND NOT regexp_matches(line, '{WORD + (SPACE + WORD) * (SHORT_LINE - 1)}'))
  AND NOT regexp_matches(lower(line), '{"|".join(re.escape(p) for p in BOILERPLATE)}')),
k AS (SELECT doc_id, sum(len(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g'))) AS n FROM l GROUP BY doc_id),
a AS (SELECT doc_id, len(ws) AS n_words, len(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
  len(regexp_replace(t, '[^{SYMBOLS}]', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
  coalesce(c.n, 0) AS n_repeat_words, coalesce(k.n, 0) AS clean_chars,
  len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS n_stutters
  FROM f LEFT JOIN c USING (doc_id) LEFT JOIN k USING (doc_id)),
b AS (SELECT *, n_words < {LEAST_WORDS} OR n_repeat_words * 100 > n_words * {MOST_REPEATED} AS base_failed FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND clean_chars * 100 >= word_chars * {LEAST_CLEAN} AND n_stutters * 100 <= n_words * {MOST_STUTTERS} AS kept FROM b
"""
