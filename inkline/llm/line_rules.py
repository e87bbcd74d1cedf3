"""Quality rules that clean a text line by line before they judge it.

Everything is a column expression over the row: nothing is shuffled. ``let``
binds an intermediate value, so that it is computed once however often it is used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\f\r"
WINDOW = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
MAX_LOST_PERCENT = 50

# A line of this many characters needs a sentence end somewhere.
PROSE_CHARS = 60
SENTENCE_ENDS = (".", "!", "?", "\u2026", "\u3002", "\uff01", "\uff1f")
CHARS_PER_SYMBOL, CHARS_PER_SHOUT = 25, 25
MIN_SEPARATORS = 2
NAVIGATION_CHARS = 40
NAVIGATION = r"^[^a-z]*(home|menu|login|log in|sign in|sign up|register|about us|contact us|contact|search|next|previous|back to top|read more|skip to content|sitemap|site map|share this|top)[^a-z]*$"
BOILERPLATE = ("accept cookies", "accept all cookies", "uses cookies", "cookie policy", "privacy policy", "terms of use", "terms of service",
               "enable javascript", "subscribe to our newsletter", "click here to", "lorem ipsum")
BLANK, SYMBOL = r"[\x20\x09-\x0D]", r"[#*$%&|<>]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def any_of(line: Column, parts: tuple[str, ...]) -> Column:
    found = F.contains(line, F.lit(parts[0]))
    for p in parts[1:]:
        found = found | F.contains(line, F.lit(p))
    return found


def count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def word_chars(text: Column) -> Column:
    return (F.length(text) - count(text, BLANK)).cast("long")


def has_word(line: Column) -> Column:
    return F.rlike(line, F.lit("[^" + BLANK[1:]))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, BLANKS, " " * len(BLANKS)), " "), "")


def window_hashes(words: Column) -> Column:
    """A hash for each WINDOW words in a row."""
    n = F.size(words) - (WINDOW - 1)
    rows = F.arrays_zip(*[F.slice(words, F.lit(k + 1), F.greatest(n, F.lit(0))) for k in range(WINDOW)])
    return F.transform(rows, lambda x: F.xxhash64(x))


def covered(places: Column) -> Column:
    """Words in windows that start at these places, in ascending order."""
    steps = F.transform(places, lambda p, i: F.when(i + 1 < F.size(places), F.least(F.lit(WINDOW), F.get(places, i + 1) - p)).otherwise(WINDOW))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)


def repeated_words(words: Column) -> Column:
    """Words inside windows that the text holds twice or more; texts without any are told apart first."""
    def found(hashes: Column) -> Column:
        entries = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        def twice(s: Column) -> Column:
            return F.filter(s, lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)))
        places = let(entries, lambda s: F.sort_array(F.transform(twice(s), lambda x: x["i"])))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(let(places, covered))

    return let(window_hashes(words), found)


def line_fails(line: Column) -> Column:
    """Punctuation, navigation and boilerplate rules for a line that has a word."""
    def judged(chars: Column) -> Column:
        shouts = (F.length(line) - F.length(F.replace(line, F.lit("!!"), F.lit("")))) / 2
        return (((chars >= PROSE_CHARS) & ~any_of(line, SENTENCE_ENDS))
                | (F.contains(line, F.lit("!!")) & (shouts * CHARS_PER_SHOUT >= chars))
                | (F.contains(line, F.lit("|")) & (count(line, "[|]") >= MIN_SEPARATORS))
                | (count(line, SYMBOL) * CHARS_PER_SYMBOL > chars)
                | ((chars <= NAVIGATION_CHARS) & F.rlike(F.lower(line), F.lit(NAVIGATION)))
                | any_of(F.lower(line), BOILERPLATE))

    return let(F.length(line), judged)


def apply_rules(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and the base figures, the cleaned text and the verdict.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long),
    base_failed, n_lines and n_failed_lines (lines with a word), lost_chars
    (word characters in failed lines), cleaned (the lines that pass, blank ones
    included), kept. Null and empty texts have no words, fail the base rules and are
    cleaned to an empty text. Repeated rows are judged alike; an input
    column of one of these names is replaced.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))

    def base(words: Column) -> Column:
        return F.struct(F.size(words).cast("long").alias("n_words"), repeated_words(words).alias("n_repeat_words"))

    def by_line(lines: Column) -> Column:
        filled = F.filter(lines, has_word)
        def report(parts: Column) -> Column:
            failed = F.filter(parts, lambda x: line_fails(x))
            return let(failed, lambda bad: F.struct(
                F.size(parts).cast("long").alias("n_lines"), F.size(bad).cast("long").alias("n_failed_lines"),
                (F.size(parts) - F.size(F.array_distinct(parts))).cast("long").alias("n_dup_lines"),
                word_chars(F.array_join(bad, "")).alias("lost_chars"),
                # equal lines fail alike, so the failed lines are known by their text
                F.when(F.size(bad) == 0, F.lit(None)).otherwise(F.array_join(F.filter(lines, lambda x: ~has_word(x) | ~line_fails(x)), "\n")).alias("cleaned")))
        return let(filled, report)

    judged = docs.withColumns({"_words": let(words_of(text), base), "_lines": let(F.split(text, "\n"), by_line)})
    n, repeats = F.col("_words.n_words"), F.col("_words.n_repeat_words")
    judged = judged.withColumns({
        "n_words": n, "word_chars": word_chars(text), "n_symbols": count(text, SYMBOL).cast("long"),
        "n_dup_lines": F.col("_lines.n_dup_lines"), "n_repeat_words": repeats,
        "base_failed": (n < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n),
        "n_lines": F.col("_lines.n_lines"), "n_failed_lines": F.col("_lines.n_failed_lines"), "lost_chars": F.col("_lines.lost_chars"),
        "cleaned": F.coalesce("_lines.cleaned", text)}).drop("_words", "_lines")
    return judged.withColumn("kept", ~F.col("base_failed") & (100 * F.col("lost_chars") <= MAX_LOST_PERCENT * F.col("word_chars")))


ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') ws, string_split(t, chr(10)) ls FROM d),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1))) i FROM w)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) n FROM g) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT i + k) n FROM r, (SELECT unnest([0, 1, 2, 3, 4]) k) GROUP BY doc_id),
l AS (SELECT doc_id, l, length(regexp_replace(l, '[\\x20\\x09-\\x0D]', '', 'g')) chars
      FROM (SELECT doc_id, unnest(ls) l FROM w) WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]')),
j AS (SELECT doc_id, l, chars, (length(l) >= {PROSE_CHARS} AND NOT regexp_matches(l, '[{"".join(SENTENCE_ENDS)}]'))
        OR contains(l, '!!') AND (length(l) - length(replace(l, '!!', ''))) / 2 * {CHARS_PER_SHOUT} >= length(l)
        OR length(l) - length(replace(l, '|', '')) >= {MIN_SEPARATORS}
        OR (length(l) - length(regexp_replace(l, '{SYMBOL}', '', 'g'))) * {CHARS_PER_SYMBOL} > length(l)
        OR length(l) <= {NAVIGATION_CHARS} AND regexp_matches(lower(l), '{NAVIGATION}')
        OR regexp_matches(lower(l), '{"|".join(BOILERPLATE)}') bad FROM l),
s AS (SELECT doc_id, count(*) n_lines, count(*) - count(DISTINCT l) n_dup_lines, count(*) FILTER (WHERE bad) n_failed_lines,
        coalesce(sum(chars) FILTER (WHERE bad), 0) lost_chars FROM j GROUP BY doc_id),
b AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) n_words, CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) word_chars,
        CAST(length(t) - length(regexp_replace(t, '{SYMBOL}', '', 'g')) AS BIGINT) n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) n_dup_lines,
        CAST(coalesce(c.n, 0) AS BIGINT) n_repeat_words, CAST(coalesce(n_lines, 0) AS BIGINT) n_lines,
        CAST(coalesce(n_failed_lines, 0) AS BIGINT) n_failed_lines, CAST(coalesce(lost_chars, 0) AS BIGINT) lost_chars
      FROM w LEFT JOIN c USING (doc_id) LEFT JOIN s USING (doc_id)),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words base_failed FROM b)
SELECT *, NOT base_failed AND 100 * lost_chars <= {MAX_LOST_PERCENT} * word_chars kept FROM f
"""
