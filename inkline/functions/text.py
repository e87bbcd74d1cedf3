"""Tokenisers and string counts as column expressions.

Character classes are spelled out instead of using ``\\w``, ``\\s`` and ``\\b``:
those are ASCII-only in Java, while the feature definitions are Unicode.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[a-zA-Z0-9_\p{L}\p{N}]+"
WORD_APOS = r"[a-zA-Z0-9_\p{L}\p{N}]+(?:'[a-zA-Z0-9_\p{L}\p{N}]+)?"
ALPHA_APOS = r"^[A-Za-z]+(?:'[A-Za-z]+)?$"
LETTERS_ONLY = r"^\p{L}+$"
TERM = r"[a-z0-9_\p{L}\p{N}]{2,}"
SPACE = r"[\t-\r\x1c-\x20\x85\p{Z}]"
SENTENCE_END = r"[.!?]+"
SENTENCE_KEEP = r"[^.!?]+[.!?]*"
CLAUSE_END = r"[,;:]"
ASCII_PUNCT = r"[!-/:-@\[-`{-~]"
UPPER = r"\p{Lu}"
DIGIT = r"[\p{Nd}\x{b2}\x{b3}\x{b9}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}]"
SPECIAL = r"[^a-zA-Z0-9 \p{L}\p{N}\t-\r\x1c-\x1f\x85\p{Z}]"


def extract_all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def strip(text: Column) -> Column:
    """Remove Unicode whitespace at both ends (Spark's ``trim`` drops only blanks)."""
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def collapse_spaces(text: Column) -> Column:
    return strip(F.regexp_replace(text, f"{SPACE}+", " "))


def flatten_lines(text: Column) -> Column:
    """Line breaks to blanks, then strip."""
    return strip(F.translate(text, "\n\r", "  "))


def word_tokens(text: Column) -> Column:
    return extract_all(text, WORD)


def alpha_tokens(text: Column) -> Column:
    """Lower-cased ASCII words with an optional inner apostrophe."""
    raw = extract_all(text, WORD_APOS)
    return F.filter(F.transform(raw, F.lower), lambda w: w.rlike(ALPHA_APOS))


def term_tokens(text: Column, stopwords: tuple[str, ...] = ()) -> Column:
    """Vectoriser tokens: lower case, two or more characters, stop words out."""
    terms = extract_all(F.lower(text), TERM)
    if stopwords:
        terms = F.filter(terms, lambda w: ~w.isin(*stopwords))
    return terms


def blank_tokens(text: Column) -> Column:
    """Pieces between runs of whitespace."""
    return F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")


def sentences(text: Column) -> Column:
    """Pieces between runs of ``.!?`` without the terminator."""
    pieces = F.transform(F.split(text, SENTENCE_END), strip)
    return F.filter(pieces, lambda s: s != "")


def sentences_terminated(text: Column) -> Column:
    """Sentences that keep their terminator."""
    pieces = F.transform(extract_all(text, SENTENCE_KEEP), strip)
    return F.filter(pieces, lambda s: s != "")


def clauses(text: Column) -> Column:
    return F.split(text, CLAUSE_END)


def joined(tokens: Column) -> Column:
    """Tokens as one blank-padded string, the form the counting patterns below read."""
    return F.concat(F.lit(" "), F.array_join(tokens, " "), F.lit(" "))


def word_ngrams(padded: Column, n: int) -> Column:
    """All word n-grams of a padded token string, in no particular order.

    One regex pass per starting offset: the pass at offset k reads the grams
    that start at tokens k, k + n, k + 2n, ...
    """
    gram = " ".join(["[^ ]+"] * n)
    passes = [extract_all(F.regexp_replace(padded, "^" + " [^ ]+" * k, ""), gram) for k in range(n)]
    return F.concat(*passes)


def ordered_ngrams(tokens: Column, n: int, sep: str = " ") -> Column:
    """Word n-grams in text order; empty when there are fewer than n tokens."""
    room = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
    out = F.slice(tokens, F.lit(1), room)
    for k in range(1, n):
        out = F.zip_with(out, F.slice(tokens, F.lit(k + 1), room), lambda a, b: F.concat(a, F.lit(sep), b))
    return out


def char_trigrams(text: Column) -> Column:
    """All character trigrams, in no particular order (one pass per offset)."""
    return F.concat(*[extract_all(F.substring(text, k, 2**31 - 1), "(?s).{3}") for k in (1, 2, 3)])


def count_pattern(text: Column, pattern: str) -> Column:
    return F.size(extract_all(text, pattern))


def count_listed(padded: Column, words: tuple[str, ...]) -> Column:
    """Tokens of a padded token string that are in a word list."""
    return count_pattern(padded, " (?:" + "|".join(words) + ")(?= )")


def count_suffixed(padded: Column, suffixes: tuple[str, ...]) -> Column:
    """Tokens of a padded token string that end in one of the suffixes."""
    return count_pattern(padded, "(?:" + "|".join(suffixes) + ")(?= )")


def count_text(text: Column, piece: str) -> Column:
    """Non-overlapping occurrences of a literal piece."""
    gone = F.length(text) - F.length(F.replace(text, F.lit(piece), F.lit("")))
    return gone if len(piece) == 1 else (gone / F.lit(len(piece))).cast("int")


def _independent(pieces: tuple[str, ...]) -> bool:
    """No piece overlaps itself or starts with another, so start positions count occurrences."""
    overlaps = any(p[:k] == p[-k:] for p in pieces for k in range(1, len(p)))
    prefixed = any(a != b and b.startswith(a) for a in pieces for b in pieces)
    return not overlaps and not prefixed


def count_texts(text: Column, pieces: tuple[str, ...]) -> Column:
    """Summed occurrences of several literal pieces, each counted on its own."""
    if len(pieces) > 2 and _independent(pieces):
        starts = "".join(sorted({p[0] for p in pieces}))
        plain = "|".join(re.escape(p) for p in pieces)
        return count_pattern(text, f"(?=[{re.escape(starts)}])(?={plain})")
    out = count_text(text, pieces[0])
    for piece in pieces[1:]:
        out = out + count_text(text, piece)
    return out


def count_class(text: Column, char_class: str) -> Column:
    """Characters of ``text`` that match a single-character class."""
    return F.length(text) - F.length(F.regexp_replace(text, f"{char_class}+", ""))


def count_where(tokens: Column, test) -> Column:
    return F.size(F.filter(tokens, test))


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` as double, 0 where the denominator is 0."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def sum_array(values: Column, zero=0.0) -> Column:
    kind = "double" if isinstance(zero, float) else "long"
    return F.aggregate(values, F.lit(zero).cast(kind), lambda acc, v: acc + v.cast(kind))


def syllables(padded: Column, vowels: str) -> Column:
    """Syllables of all tokens of a padded string of lower-cased tokens.

    A token has one syllable per vowel group, less one for a final e, and at
    least one. Summed over tokens: all groups, less the final e's, plus one for
    each token left at zero (no vowel at all, or a single group that ends in e).
    """
    v, k = f"[{vowels}]", f"[^{vowels} ]"
    groups, final_e = count_pattern(padded, f"{v}+"), count_pattern(padded, "e(?= )")
    return groups - final_e + count_pattern(padded, f" {k}++(?= )") + count_pattern(padded, f" {k}*+{v}*e(?= )")


def complex_words(padded: Column, vowels: str) -> Column:
    """Tokens with three or more syllables: four vowel groups, or three and no final e."""
    v, k = f"[{vowels}]", f"[^{vowels} ]"
    three = f" {k}*+{v}++(?:{k}++{v}++){{2}}"
    return count_pattern(padded, f"{three}{k}++{v}") + count_pattern(padded, f"{three}{k}*+(?<!e)(?= )")
