"""Quality rules, line by line first, then on the document. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import SPACE, WORD

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
#: Marks between the entries of a menu or a path of links; three make a navigation line.
NAVIGATION = r"(?:[|»›•·].*){3}"
#: Phrases of page furniture; they fail a line of at most BOILERPLATE_WORDS words.
BOILERPLATE = (
    r"(?i)(?:cookie (?:policy|settings|notice)|accept (?:all )?cookies|privacy policy|terms of (?:use|service)"
    r"|all rights reserved|javascript (?:is|must)|enable javascript|sign (?:in|up)|log ?in to|subscribe (?:to|now)"
    r"|share (?:on|this)|click here|read more|back to top|lorem ipsum)"
)
BOILERPLATE_WORDS = 25
#: A line of this many words has some punctuation, and some small letter if its script has them.
LONG_LINE, SHOUT_LINE = 8, 5
PUNCTUATION = r"[.,;:!?…。，！？؟।]"
#: Share of symbols among a line's word characters above which it fails.
MAX_SYMBOLS = 0.05
#: Share of a document's word characters that may go with failing lines.
MAX_LOSS = 0.3


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def word_chars(text: Column) -> Column:
    return F.length(F.translate(text, BLANKS, "")).cast("long")


def symbols(text: Column) -> Column:
    return (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long")


def line_passes(line: Column) -> Column:
    """Whether a line stays; lines without a word always do."""
    n = F.size(F.array_remove(F.split(line, rf"[{SPACE}]+"), ""))
    fails = (
        (symbols(line) > word_chars(line) * F.lit(MAX_SYMBOLS))
        | ((n >= LONG_LINE) & ~line.rlike(PUNCTUATION))
        | ((n >= SHOUT_LINE) & line.rlike(r"\p{Lu}") & ~line.rlike(r"\p{Ll}"))
        | line.rlike(NAVIGATION)
        | ((n <= BOILERPLATE_WORDS) & line.rlike(BOILERPLATE))
    )
    return ~fails


def repeated_words(words: Column) -> Column:
    """Number of words that lie in a 3-word window found at least twice.

    Windows are sorted by hash and place; those with an equal neighbour are repeated. Their places, sorted, cover
    three words each less the overlap with the next.
    """

    def covered(places: Column) -> Column:
        n = F.size(places)
        gaps = F.transform(
            F.sequence(F.lit(1), n),
            lambda i: F.when(i == n, 3).otherwise(
                F.least(F.lit(3), F.get(places, i) - F.get(places, i - 1))
            ),
        )
        return F.when(n > 0, F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)).otherwise(F.lit(0).cast("long"))

    def repeated(windows: Column) -> Column:
        def twice(window: Column, i: Column) -> Column:
            return F.coalesce(F.get(windows, i - 1)["h"] == window["h"], F.lit(False)) | F.coalesce(
                F.get(windows, i + 1)["h"] == window["h"], F.lit(False)
            )

        return F.array_sort(F.transform(F.filter(windows, twice), lambda w: w["i"]))

    def counted(w: Column) -> Column:
        hashes = F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")),
        )
        places = let(F.sort_array(hashes), repeated)
        return F.when(F.size(w) > 2, let(places, covered)).otherwise(F.lit(0).cast("long"))

    return let(words, counted)


def quality_rules(docs: DataFrame, min_words: int = 50, max_loss: float = MAX_LOSS) -> DataFrame:
    """All columns of ``docs`` but those it replaces, with ``n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words`` (long), ``base_failed, kept`` (boolean), ``clean_chars`` (long) and ``clean_text``.

    Lines that fail a punctuation, navigation or boilerplate rule go; the rest, joined again, is ``clean_text``. A
    document is kept if it passes the base rules (at least ``min_words`` words, at most half of them in repeated
    3-word windows) and loses at most ``max_loss`` of its word characters. A null or empty text has no words, is not
    kept, and its clean text is empty. Repeated rows give repeated results, an empty table an empty result; columns
    of ``docs`` named like a result are replaced. A text may have any length; rows are handled one by one.
    """
    made = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "clean_chars", "clean_text")
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.array_remove(F.split(text, rf"[{SPACE}]+"), "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    duplicates = let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    counts = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("r")))
    clean = F.array_join(F.filter(F.split(text, "\n"), line_passes), "\n")
    kept = [F.col(c) for c in docs.columns if c not in made]
    held = "_counts"
    while held in docs.columns:
        held += "_"
    first = docs.select(
        *kept, word_chars(text).alias("word_chars"), symbols(text).alias("n_symbols"), duplicates.alias("n_dup_lines"),
        counts.alias(held), clean.alias("clean_text"),
    )
    n, repeats = F.col(held)["n"], F.col(held)["r"]
    return first.select(
        *[F.col(c) for c in docs.columns if c not in made],
        n.alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", repeats.alias("n_repeat_words"),
        ((n < min_words) | (repeats * 100 > n * 50)).alias("base_failed"),
        word_chars(F.col("clean_text")).alias("clean_chars"), "clean_text",
    ).withColumn(
        "kept",
        ~F.col("base_failed") & (F.col("word_chars") - F.col("clean_chars") <= F.col("word_chars") * F.lit(max_loss)),
    )


ORACLE = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^{SPACE}]+') AS words, string_split(t, chr(10)) AS lines FROM d),
g AS (
  SELECT doc_id, i, words[i] || chr(10) || words[i + 1] || chr(10) || words[i + 2] AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
r AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (
      SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g) WHERE c > 1)
  GROUP BY doc_id),
l AS (
  SELECT doc_id, line, len(regexp_extract_all(line, '[^{SPACE}]+')) AS n,
         length(regexp_replace(line, '[{SPACE}]', '', 'g')) AS chars,
         length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g')) AS symbols
  FROM (SELECT doc_id, unnest(lines) AS line FROM w)),
p AS (
  SELECT doc_id, count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS dups,
         coalesce(sum(chars) FILTER (NOT (
           symbols > chars * {MAX_SYMBOLS}
           OR (n >= {LONG_LINE} AND NOT regexp_matches(line, '{PUNCTUATION}'))
           OR (n >= {SHOUT_LINE} AND regexp_matches(line, '\p{{Lu}}') AND NOT regexp_matches(line, '\p{{Ll}}'))
           OR regexp_matches(line, '{NAVIGATION}')
           OR (n <= {BOILERPLATE_WORDS} AND regexp_matches(line, '{BOILERPLATE}')))), 0) AS clean_chars
  FROM l GROUP BY doc_id),
b AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(t, '[{SPACE}]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         p.dups::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words, clean_chars
  FROM w JOIN p ON w.doc_id = p.doc_id LEFT JOIN r ON w.doc_id = r.doc_id),
c AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars - clean_chars <= word_chars * {MAX_LOSS} AS kept
FROM c
"""
