"""SQL fragments shared by the oracle queries."""

from __future__ import annotations

from ..functions import text as tx


def quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def words_list(words) -> str:
    return "(" + ", ".join(quote(w) for w in words) + ")"


def strip_sql(e: str) -> str:
    return f"regexp_replace({e}, '^{tx.SPACE}+|{tx.SPACE}+$', '', 'g')"


WORDS = f"regexp_extract_all(text, '{tx.WORD}')"
FLAT = strip_sql("translate(text, chr(10) || chr(13), '  ')")
CLEAN = strip_sql(f"regexp_replace(text, '{tx.SPACE}+', ' ', 'g')")


def sentences_sql(e: str) -> str:
    return (f"list_filter(list_transform(regexp_split_to_array({e}, '{tx.SENTENCE_END}'), "
            f"lambda x: {strip_sql('x')}), lambda x: x <> '')")


def sentences_term_sql(e: str) -> str:
    return (f"list_filter(list_transform(regexp_extract_all({e}, '{tx.SENTENCE_KEEP}'), "
            f"lambda x: {strip_sql('x')}), lambda x: x <> '')")


def alpha_sql(e: str) -> str:
    apos = quote(tx.WORD_APOS)
    alpha = quote(tx.ALPHA_APOS)
    return (f"list_filter(list_transform(regexp_extract_all({e}, {apos}), lambda x: lower(x)), "
            f"lambda x: regexp_matches(x, {alpha}))")


def count_class_sql(e: str, cls: str) -> str:
    return f"(length({e}) - length(regexp_replace({e}, {quote(cls + '+')}, '', 'g')))"


def count_sql(e: str, piece: str) -> str:
    return f"(length({e}) - length(replace({e}, {quote(piece)}, ''))) // {len(piece)}"


def counts_sql(e: str, pieces) -> str:
    return "(" + " + ".join(count_sql(e, p) for p in pieces) + ")"


def ratio_sql(a: str, b: str) -> str:
    return f"coalesce(({a})::double / nullif(({b})::double, 0), 0.0)"


def r(e: str, digits: int = 6) -> str:
    return f"round(({e})::double, {digits}) + 0.0"


def exact(e: str) -> str:
    """An expression without the output rounding of ``r``."""
    head, tail = r("|").split("|")
    return e[len(head) : -len(tail)].join(("((", ")::double)")) if e.startswith(head) and e.endswith(tail) else e


def big(e: str) -> str:
    return f"({e})::bigint"


# documents with every token array the feature families read
BASE = f"""
base AS (
  SELECT doc_id, text, lower(text) AS low, {FLAT} AS flat, {CLEAN} AS clean,
         {WORDS} AS words, {sentences_sql('text')} AS sents
  FROM documents),
toks AS (
  SELECT *, lower(flat) AS flat_low, {alpha_sql('flat')} AS atoks, {sentences_term_sql('flat')} AS ksents,
         list_transform(words, lambda x: lower(x)) AS lwords,
         list_filter(words, lambda x: regexp_matches(x, '{tx.LETTERS_ONLY}')) AS alpha
  FROM base)"""


def freq_cte(name: str, array: str) -> str:
    """One row per document and token, plus per-document totals of the frequencies."""
    return f"""
{name}_tf AS (SELECT doc_id, w, count(*) AS f FROM (SELECT doc_id, unnest({array}) AS w FROM toks) GROUP BY doc_id, w),
{name} AS (SELECT doc_id, sum(f)::double AS n, count(*)::double AS v, sum(f * f)::double AS s2,
            sum(CASE WHEN f = 1 THEN 1 ELSE 0 END)::double AS hapax, sum(f * ln(f)) AS flogf,
            sum(CASE WHEN f > 1 THEN f ELSE 0 END)::double AS rep_tokens,
            sum(CASE WHEN f > 1 THEN 1 ELSE 0 END)::double AS rep_types
     FROM {name}_tf GROUP BY doc_id)"""
