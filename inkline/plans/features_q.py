"""Feature-family queries over the whole ``documents`` table."""

from __future__ import annotations

from ..functions import lexicons as lx, sequential, stylometry as st, text as tx
from ..sources.tables import load, spread
from pyspark.sql import functions as F

from .registry import query, r6, tidy
from .sqltext import (BASE, alpha_sql, big, count_class_sql, count_sql, counts_sql, freq_cte, quote, r, ratio_sql,
                      words_list)


def docs(spark, sf):
    return spread(load(spark, sf, "documents").select("doc_id", "text"), "doc_id")


def family(spark, sf, features):
    return tidy(st.select_features(st.prepare(docs(spark, sf)), ["doc_id"], features))


def plain_sql(cols: dict[str, str], extra_ctes: str = "", joins: str = "") -> str:
    body = ",\n  ".join(f"{e} AS {k}" for k, e in cols.items())
    return f"WITH {BASE}{extra_ctes}\nSELECT t.doc_id,\n  {body}\nFROM toks t {joins}"


def left(*names: str) -> str:
    return " ".join(f"LEFT JOIN {n} ON {n}.doc_id = t.doc_id" for n in names)


# --- feat_basic --------------------------------------------------------------
SQL_BASIC = {
    "char_count": big("length(text)"),
    "char_count_no_spaces": big("length(replace(clean, ' ', ''))"),
    "word_count": big("len(words)"),
    "word_count_alpha": big("greatest(len(atoks), 1)"),
    "sentence_count": big("len(sents)"),
    "sentence_count_terminated": big("greatest(len(ksents), 1)"),
}


@query("feat_basic", plain_sql(SQL_BASIC))
def feat_basic(spark, sf):
    return family(spark, sf, st.basic())


# --- feat_lexical ------------------------------------------------------------
SQL_LEXICAL = {
    "vocab_size": big("coalesce(w.v, 0)"),
    "type_token_ratio": r("coalesce(w.v / w.n, 0)"),
    "hapax_ratio": r("coalesce(w.hapax / w.n, 0)"),
    "yules_k": r("coalesce((a.s2 - a.n) * 10000 / (a.n * a.n), 0)"),
    "yules_k_types": r("CASE WHEN w.n >= 2 THEN (w.s2 - w.v) * 10000 / (w.v * w.v) ELSE 0 END"),
    "simpsons_index": r("coalesce(w.s2 / (w.n * w.n), 0)"),
}


@query("feat_lexical", plain_sql(SQL_LEXICAL, "," + freq_cte("w", "lwords") + "," + freq_cte("a", "atoks"), left("w", "a")))
def feat_lexical(spark, sf):
    return family(spark, sf, st.lexical())


# --- feat_sentence -----------------------------------------------------------
SENT_CTE = f""",
sl AS (SELECT doc_id, avg(k) AS m, stddev_pop(k) AS sd, max(k) AS hi, min(k) AS lo FROM (
  SELECT doc_id, len(regexp_extract_all(s, '{tx.WORD}')) AS k FROM (SELECT doc_id, unnest(sents) AS s FROM toks))
  GROUP BY doc_id)"""
SQL_SENTENCE = {
    "avg_sentence_length": r("coalesce(sl.m, 0)"),
    "sentence_length_std": r("coalesce(sl.sd, 0)"),
    "max_sentence_length": big("coalesce(sl.hi, 0)"),
    "min_sentence_length": big("coalesce(sl.lo, 0)"),
}


@query("feat_sentence", plain_sql(SQL_SENTENCE, SENT_CTE, left("sl")))
def feat_sentence(spark, sf):
    return family(spark, sf, st.sentence())


# --- feat_wordlen ------------------------------------------------------------
WLEN_CTE = """,
wl AS (SELECT doc_id, avg(k) AS m, stddev_pop(k) AS sd, max(k) AS hi FROM (
  SELECT doc_id, length(unnest(words)) AS k FROM toks) GROUP BY doc_id),
al AS (SELECT doc_id, avg(k) AS m, var_pop(k) AS va, count(*) AS n, sum(CASE WHEN k > 6 THEN 1 ELSE 0 END) AS lo,
  sum(CASE WHEN k <= 3 THEN 1 ELSE 0 END) AS sh FROM (SELECT doc_id, length(unnest(atoks)) AS k FROM toks) GROUP BY doc_id)"""
SQL_WORDLEN = {
    "avg_word_length": r("coalesce(wl.m, 0)"),
    "word_length_std": r("coalesce(wl.sd, 0)"),
    "word_length_variance": r("coalesce(al.va, 0)"),
    "max_word_length": big("coalesce(wl.hi, 0)"),
    "long_word_count": big("coalesce(al.lo, 0)"),
    "short_word_count": big("coalesce(al.sh, 0)"),
    "long_word_ratio": r("coalesce(al.lo::double / al.n, 0)"),
    "short_word_ratio": r("coalesce(al.sh::double / al.n, 0)"),
}


@query("feat_wordlen", plain_sql(SQL_WORDLEN, WLEN_CTE, left("wl", "al")))
def feat_wordlen(spark, sf):
    return family(spark, sf, st.word_length())


# --- feat_syllables, feat_readability ----------------------------------------
SYL_CTE = """,
sa AS (SELECT doc_id, sum(s) AS syl, sum(CASE WHEN s >= 3 THEN 1 ELSE 0 END) AS poly FROM (
  SELECT doc_id, CASE WHEN w = '' THEN 0 ELSE greatest(1, g - CASE WHEN w LIKE '%e' AND g > 1 THEN 1 ELSE 0 END) END AS s
  FROM (SELECT doc_id, w, len(regexp_extract_all(w, '[aeiou]+')) AS g FROM (
    SELECT doc_id, regexp_replace(unnest(atoks), '[^a-z]', '', 'g') AS w FROM toks))) GROUP BY doc_id),
sy AS (SELECT doc_id, sum(s) AS syl, sum(CASE WHEN s >= 3 THEN 1 ELSE 0 END) AS poly FROM (
  SELECT doc_id, greatest(1, len(regexp_extract_all(w, '[aeiouy]+')) - CASE WHEN w LIKE '%e' THEN 1 ELSE 0 END) AS s
  FROM (SELECT doc_id, unnest(lwords) AS w FROM toks)) GROUP BY doc_id)"""
SQL_SYLLABLES = {
    "syllables_ascii": big("coalesce(sa.syl, 0)"),
    "syllables_y": big("coalesce(sy.syl, 0)"),
    "complex_words_ascii": big("coalesce(sa.poly, 0)"),
    "complex_words_y": big("coalesce(sy.poly, 0)"),
}


@query("feat_syllables", plain_sql(SQL_SYLLABLES, SYL_CTE, left("sa", "sy")))
def feat_syllables(spark, sf):
    return family(spark, sf, st.syllables())


W, S = "nullif(len(words), 0)::double", "nullif(len(sents), 0)::double"
WA, SA = "nullif(len(atoks), 0)::double", "nullif(len(ksents), 0)::double"
EASE = f"(206.835::double - 1.015::double * ({W} / {S}) - 84.6::double * (sy.syl / {W}))"


def kincaid(w, s):
    return f"coalesce(0.39::double * ({w} / {s}) + 11.8::double * (sy.syl / {w}) - 15.59::double, 0)"


def fog(w, s, poly):
    return f"coalesce(0.4::double * ({w} / {s} + 100.0::double * ({poly} / {w})), 0)"


def smog(s):
    return f"coalesce(1.0430::double * sqrt(30.0::double * sy.poly / {s}) + 3.1291::double, CASE WHEN {s} IS NULL THEN 0 ELSE 3.1291 END)"


SQL_READABILITY = {
    "avg_syllables_per_word": r(f"coalesce(sy.syl / {W}, 0)"),
    "flesch_reading_ease": r(f"CASE WHEN {EASE} IS NULL THEN 0 ELSE greatest(0.0, least(100.0, {EASE})) END"),
    "flesch_reading_ease_raw": r(f"coalesce({EASE}, 0)"),
    "flesch_kincaid_grade": r(kincaid(W, S)),
    "gunning_fog": r(fog(W, S, "sy.poly")),
    "gunning_fog_ascii": r(fog(WA, SA, "sa.poly")),
    "smog_index": r(smog(S)),
}


@query("feat_readability", plain_sql(SQL_READABILITY, SYL_CTE, left("sa", "sy")))
def feat_readability(spark, sf):
    return family(spark, sf, st.readability())


# --- feat_punct, feat_charclass ----------------------------------------------
PUNCT = count_class_sql("flat", tx.ASCII_PUNCT)
SQL_PUNCT = {
    **{name: big(count_sql("flat", p)) for name, p in (
        ("comma_count", ","), ("period_count", "."), ("question_count", "?"), ("exclamation_count", "!"),
        ("semicolon_count", ";"), ("colon_count", ":"), ("hyphen_count", "-"))},
    "quote_count": big(counts_sql("flat", ('"', "'"))),
    "parenthesis_count": big(counts_sql("flat", ("(", ")"))),
    "punctuation_count": big(PUNCT),
    "punctuation_density": r(ratio_sql(PUNCT, "length(flat)")),
    "avg_punct_per_sentence": r(ratio_sql(PUNCT, "len(ksents)")),
    **{name: r(ratio_sql(count_sql("text", p), "length(text)")) for name, p in (
        ("comma_rate", ","), ("semicolon_rate", ";"), ("colon_rate", ":"), ("exclamation_rate", "!"),
        ("question_rate", "?"), ("ellipsis_rate", "..."))},
    "dash_rate": r(ratio_sql(counts_sql("text", ("-", "—")), "length(text)")),
}


@query("feat_punct", plain_sql(SQL_PUNCT))
def feat_punct(spark, sf):
    return family(spark, sf, st.punctuation())


SQL_CHARCLASS = {
    "uppercase_count": big(count_class_sql("text", tx.UPPER)),
    "digit_count": big(count_class_sql("text", tx.DIGIT)),
    "capitalization_rate": r(ratio_sql(count_class_sql("text", tx.UPPER), "length(text)")),
    "numeric_rate": r(ratio_sql(count_class_sql("text", tx.DIGIT), "length(text)")),
    "whitespace_ratio": r(ratio_sql(count_class_sql("text", tx.SPACE), "length(text)")),
    "special_char_rate": r(ratio_sql(count_class_sql("text", tx.SPECIAL), "length(text)")),
}


@query("feat_charclass", plain_sql(SQL_CHARCLASS))
def feat_charclass(spark, sf):
    return family(spark, sf, st.char_classes())


# --- feat_lexicons, feat_phrases, feat_passive, feat_suffix -------------------
def in_count(arr: str, words) -> str:
    return f"len(list_filter({arr}, lambda x: x IN {words_list(words)}))"


LALPHA = "list_transform(alpha, lambda x: lower(x))"
SQL_LEXICONS = {
    **{name: r(ratio_sql(in_count(arr, words), f"len({arr})")) for name, (arr, words) in st.TOKEN_SHARES.items()},
    "first_person_pronoun_count": big(in_count("atoks", lx.FIRST_PERSON)),
    "stopword_count_long": big(in_count(LALPHA, lx.ENGLISH_STOPWORDS)),
    "stopword_ratio_long": r(ratio_sql(in_count(LALPHA, lx.ENGLISH_STOPWORDS), "len(alpha)")),
}


@query("feat_lexicons", plain_sql(SQL_LEXICONS))
def feat_lexicons(spark, sf):
    return family(spark, sf, st.lexicon_shares())


SQL_PHRASES = {
    **{name: r(ratio_sql(counts_sql("low", p), "greatest(len(words), 1)")) for name, p in st.PHRASE_RATES.items()},
    "contraction_count": big(counts_sql("flat_low", lx.CONTRACTIONS_ALL)),
}


@query("feat_phrases", plain_sql(SQL_PHRASES))
def feat_phrases(spark, sf):
    return family(spark, sf, st.phrases())


SQL_PASSIVE = {
    "passive_sentence_rate": r(ratio_sql(
        f"len(list_filter(ksents, lambda s: regexp_matches(array_to_string(regexp_extract_all(lower(s), "
        f"{quote(tx.WORD_APOS)}), ' '), {quote(st.PASSIVE_PATTERN)})))", "len(ksents)")),
    "passive_voice_rate": r(ratio_sql(counts_sql("low", lx.PASSIVE_PHRASES), "len(sents)")),
}


@query("feat_passive", plain_sql(SQL_PASSIVE))
def feat_passive(spark, sf):
    return family(spark, sf, st.passive())


def suffix_count(arr: str, suffixes) -> str:
    return f"len(list_filter({arr}, lambda x: regexp_matches(x, '({'|'.join(suffixes)})$')))"


SQL_SUFFIX = {
    "adverb_count": big(suffix_count("atoks", ("ly",))),
    "abstract_noun_count": big(suffix_count("atoks", lx.ABSTRACT_SUFFIXES)),
    "complex_verb_count": big(in_count("atoks", lx.COMPLEX_VERBS)),
    "sophisticated_adjective_count": big(in_count("atoks", lx.SOPHISTICATED_ADJECTIVES)),
    "noun_verb_ratio": r(ratio_sql(suffix_count("words", lx.NOUN_SUFFIXES), suffix_count("words", lx.VERB_SUFFIXES))),
    "formality_score": r(
        ratio_sql("len(list_filter(words, lambda x: length(x) > 8))", "len(words)") + " - " + ratio_sql(
            in_count("words", lx.INFORMAL_WORDS) + " + " + counts_sql("text", lx.INFORMAL_CONTRACTIONS), "len(words)")),
}


@query("feat_suffix", plain_sql(SQL_SUFFIX))
def feat_suffix(spark, sf):
    return family(spark, sf, st.suffixes())


# --- feat_entropy, feat_repetition, feat_burstiness ---------------------------
def grams(arr: str, n: int) -> str:
    if n == 2:
        return f"list_transform(range(1, len({arr})), lambda i: {arr}[i] || ' ' || {arr}[i+1])"
    return f"list_transform(range(1, len({arr}) - 1), lambda i: {arr}[i] || ' ' || {arr}[i+1] || ' ' || {arr}[i+2])"


def nats(t: str) -> str:
    return f"coalesce(ln({t}.n) - {t}.flogf / {t}.n, 0)"


ENTROPY_CTE = ",".join(["", freq_cte("w", "lwords"), freq_cte("a", "atoks"), freq_cte("b", grams("lwords", 2)),
                        freq_cte("ch", "string_split(text, '')"), freq_cte("cf", "string_split(flat, '')")])
SQL_ENTROPY = {
    "char_entropy": r(nats("ch")),
    "word_entropy": r(nats("w")),
    "bigram_entropy": r(nats("b")),
    "char_entropy_bits": r(f"{nats('cf')} / ln(2.0)"),
    "word_entropy_bits": r(f"{nats('a')} / ln(2.0)"),
}


@query("feat_entropy", plain_sql(SQL_ENTROPY, ENTROPY_CTE, left("w", "a", "b", "ch", "cf")))
def feat_entropy(spark, sf):
    return family(spark, sf, st.entropies())


REP_CTE = ",".join(["", freq_cte("w", "lwords"), freq_cte("a", "atoks"), freq_cte("b", grams("lwords", 2)),
                    freq_cte("t3", grams("lwords", 3)), freq_cte("a3", grams("atoks", 3)), freq_cte("l", LALPHA)])
SQL_REPETITION = {
    "word_repetition_rate": r("coalesce(1 - w.v / w.n, 0)"),
    "bigram_repetition_rate": r("coalesce(1 - b.v / b.n, 0)"),
    "trigram_repetition_rate": r("coalesce(1 - t3.v / t3.n, 0)"),
    "trigram_uniqueness": r("coalesce(a3.v / a3.n, 0)"),
    "repeated_word_ratio": r("coalesce(a.rep_tokens / a.n, 0)"),
    "repeated_words": big("coalesce(l.rep_types, 0)"),
    "repeated_word_type_ratio": r("coalesce(l.rep_types / l.v, 0)"),
}


@query("feat_repetition", plain_sql(SQL_REPETITION, REP_CTE, left("w", "a", "b", "t3", "a3", "l")))
def feat_repetition(spark, sf):
    return family(spark, sf, st.repetition())


BURST_CTE = """,
w AS (SELECT doc_id, avg(f) AS m, stddev_pop(f) AS sd, count(*) AS v FROM (
  SELECT doc_id, w, count(*) AS f FROM (SELECT doc_id, unnest(lwords) AS w FROM toks) GROUP BY doc_id, w) GROUP BY doc_id)"""


@query("feat_burstiness", plain_sql(
    {"burstiness": r("CASE WHEN w.v >= 2 THEN (w.sd - w.m) / (w.sd + w.m) ELSE 0 END")}, BURST_CTE, left("w")))
def feat_burstiness(spark, sf):
    return family(spark, sf, st.burstiness())


# --- feat_structure, feat_syntax, feat_cohesion --------------------------------
TRI_CTE = """,
c3 AS (SELECT doc_id, count(DISTINCT g) AS v, count(*) AS n FROM (
  SELECT doc_id, unnest(list_transform(range(1, length(text) - 1), lambda i: substr(text, i, 3))) AS g FROM toks) GROUP BY doc_id),
st AS (SELECT doc_id, count(DISTINCT g) AS v, count(*) AS n FROM (
  SELECT doc_id, lower(regexp_split_to_array(unnest(sents), '%s+')[1]) AS g FROM toks) GROUP BY doc_id)""" % tx.SPACE
SQL_STRUCTURE = {
    "paragraph_break_rate": r(ratio_sql("(length(text) - length(replace(text, chr(10) || chr(10), ''))) // 2", "len(sents)")),
    "newline_count": big("length(text) - length(replace(text, chr(10), ''))"),
    "avg_clause_length": r(
        f"list_avg(list_transform(regexp_split_to_array(text, '{tx.CLAUSE_END}'), "
        f"lambda x: len(regexp_extract_all(x, '{tx.WORD}'))))"),
    "avg_chars_per_sentence": r(ratio_sql("length(clean)", "len(ksents)")),
    "char_trigram_diversity": r("coalesce(c3.v::double / c3.n, 0)"),
    "sentence_starter_diversity": r("coalesce(st.v::double / st.n, 0)"),
    "question_sentence_rate": r(ratio_sql("len(list_filter(ksents, lambda s: s LIKE '%?'))", "len(ksents)")),
}


@query("feat_structure", plain_sql(SQL_STRUCTURE, TRI_CTE, left("c3", "st")))
def feat_structure(spark, sf):
    return family(spark, sf, st.structure())


def any_sql(test: str) -> str:
    return f"CASE WHEN len(list_filter(ksents, lambda s: {test})) > 0 THEN 1 ELSE 0 END"


SQL_SYNTAX = {"syntax_variety": r("(" + " + ".join([
    any_sql("s LIKE '%?'"), any_sql("s LIKE '%!'"), any_sql("NOT (s LIKE '%?') AND NOT (s LIKE '%!')"),
    any_sql("regexp_matches(s, '[:;]')"), any_sql(f"len(regexp_extract_all(s, '{tx.WORD}')) <= 5")]) + ") / 5.0")}


@query("feat_syntax", plain_sql(SQL_SYNTAX))
def feat_syntax(spark, sf):
    return family(spark, sf, st.syntax())


COHESION_CTE = """,
win AS (SELECT doc_id, unnest(CASE WHEN len(words) > 10 THEN range(1, len(words) - 9) ELSE [] END) AS i FROM toks),
co AS (SELECT t.doc_id, avg(len(list_intersect(t.words[i:i+4], t.words[i+5:i+9]))::double
        / len(list_distinct(t.words[i:i+9]))) AS m FROM win JOIN toks t ON t.doc_id = win.doc_id GROUP BY t.doc_id)"""


@query("feat_cohesion", plain_sql({"lexical_cohesion": r("coalesce(co.m, 0)")}, COHESION_CTE, left("co")))
def feat_cohesion(spark, sf):
    cohesion = sequential.lexical_cohesion(tx.joined(tx.word_tokens(F.col("text"))))
    return docs(spark, sf).select("doc_id", r6(cohesion).alias("lexical_cohesion"))


# --- feat_sentiment ------------------------------------------------------------
VALENCE_VALUES = ", ".join(f"({quote(w)}, {v}::double)" for w, v in lx.VALENCE)


VALENCE_CTE = f""",
lexicon(w, valence) AS (VALUES {VALENCE_VALUES}),
vs AS (SELECT doc_id, sum(valence) AS s FROM (SELECT doc_id, unnest(atoks) AS w FROM toks) JOIN lexicon USING (w) GROUP BY doc_id)"""
SQL_SENTIMENT = r("coalesce(vs.s / sqrt(vs.s * vs.s + 15), 0)")


@query("feat_sentiment", plain_sql({"sentiment": SQL_SENTIMENT}, VALENCE_CTE, left("vs")))
def feat_sentiment(spark, sf):
    return family(spark, sf, st.sentiment())


# --- Arrow-backed columns, wide catalogues --------------------------------------
def zero_state(place: str) -> str:
    return f"{{'ended': 0::BIGINT, 'start': 0::BIGINT, 'length': 0::BIGINT, 'kinds': 0::BIGINT, 'place': ({place})::BIGINT}}"


def stretches_sql(places: str) -> str:
    """Stretches of a list of states that carry each token's place before."""
    grown, limit = "s.kinds + (t.place < s.start)::BIGINT", f"{sequential.THRESHOLD}::DOUBLE"
    folded = (f"list_reduce(list_prepend({zero_state('-1')}, {places}), lambda s, t: CASE WHEN {grown} < {limit} * (s.length + 1) "
              "THEN {'ended': s.ended + 1, 'start': s.start + s.length + 1, 'length': 0::BIGINT, 'kinds': 0::BIGINT, 'place': t.place} "
              f"ELSE {{'ended': s.ended, 'start': s.start, 'length': s.length + 1, 'kinds': {grown}, 'place': t.place}} END)")
    return f"(SELECT z.ended + CASE WHEN z.length > 0 THEN (1 - z.kinds / z.length::DOUBLE) / (1 - {limit}) ELSE 0 END FROM (SELECT {folded} AS z))"


MTLD_CTE = f""",
tk AS (SELECT doc_id, unnest(lwords) AS w, unnest(range(len(lwords))) AS i, len(lwords) AS n FROM toks),
pl AS (SELECT doc_id, i, n, coalesce(lag(i) OVER v, -1) AS a, n - 1 - coalesce(lead(i) OVER v, n) AS b FROM tk WINDOW v AS (PARTITION BY doc_id, w ORDER BY i)),
ml AS (SELECT doc_id, any_value(n) AS n, count(*) FILTER (a < 0) AS kinds, list({zero_state('a')} ORDER BY i) AS ahead, list({zero_state('b')} ORDER BY i DESC) AS back
       FROM pl GROUP BY doc_id),
mk AS (SELECT doc_id, n, kinds, {stretches_sql('ahead')} AS ka, {stretches_sql('back')} AS kb FROM ml),
mt AS (SELECT doc_id, CASE WHEN n < {sequential.LEAST} THEN kinds ELSE (CASE WHEN ka > 0 THEN n / ka ELSE n END + CASE WHEN kb > 0 THEN n / kb ELSE n END) / 2 END AS m FROM mk)"""


@query("feat_mtld", plain_sql({"mtld": r("coalesce(mt.m, 0)")}, MTLD_CTE, left("mt")))
def feat_mtld(spark, sf):
    words = F.lower(tx.joined(tx.word_tokens(F.col("text"))))
    return docs(spark, sf).select("doc_id", r6(sequential.mtld(words)).alias("mtld"))


@query("feat_compression")
def feat_compression(spark, sf):
    return docs(spark, sf).select("doc_id", r6(sequential.compression_ratio("text")).alias("compression_ratio"))


@query("feature_vector_56")
def feature_vector_56(spark, sf):
    return tidy(st.vector_56(docs(spark, sf), ["doc_id"]))


ALL_CTE = (REP_CTE + "," + freq_cte("ch", "string_split(text, '')") + SENT_CTE + WLEN_CTE + SYL_CTE + TRI_CTE + COHESION_CTE + MTLD_CTE)
ALL_JOINS = left("w", "b", "t3", "ch", "sl", "wl", "al", "sa", "sy", "c3", "st", "co", "mt")
SQL_56 = {
    **SQL_BASIC, **SQL_LEXICAL, **SQL_SENTENCE, **SQL_WORDLEN, **SQL_READABILITY, **SQL_PUNCT, **SQL_PHRASES, **SQL_ENTROPY, **SQL_REPETITION, **SQL_PASSIVE,
    **SQL_LEXICONS, **SQL_STRUCTURE, **SQL_CHARCLASS, **SQL_SUFFIX, "yules_k": SQL_LEXICAL["yules_k_types"], "mtld": r("coalesce(mt.m, 0)"),
    "lexical_cohesion": r("coalesce(co.m, 0)"), "burstiness": r("""CASE WHEN w.v >= 2 THEN (sqrt(w.v * w.s2 - w.n * w.n) / w.v - w.n / w.v)
      / (sqrt(w.v * w.s2 - w.n * w.n) / w.v + w.n / w.v) ELSE 0 END"""),
}
CHECKED_56 = [name for name in st.NAMES_56 if name != "compression_ratio"]


@query("feature_vector_checked", plain_sql({k: f"({SQL_56[k]})::DOUBLE" for k in CHECKED_56}, ALL_CTE, ALL_JOINS))
def feature_vector_checked(spark, sf):
    """The assembled vector without its codec column, which SQL can't express."""
    return tidy(st.vector_56(docs(spark, sf), ["doc_id"]).select("doc_id", *CHECKED_56))


def prefix(p: str, feats: dict) -> dict:
    return {f"{p}_{k}": v for k, v in feats.items()}


WIDE_CTE = (REP_CTE.replace("," + freq_cte("t3", grams("lwords", 3)), "") + "," + freq_cte("cf", "string_split(flat, '')") + WLEN_CTE + SYL_CTE + f""",
kl AS (SELECT doc_id, avg(k) AS km, stddev_pop(k) AS ksd, avg(g) AS gm, stddev_pop(g) AS gsd FROM (
  SELECT doc_id, len({alpha_sql('s')}) AS k, len(regexp_extract_all(s, '{tx.WORD}')) AS g FROM (SELECT doc_id, unnest(ksents) AS s FROM toks))
  GROUP BY doc_id),
ll AS (SELECT doc_id, avg(k) AS m, sum(CASE WHEN k >= 7 THEN 1 ELSE 0 END) AS lo, sum(CASE WHEN k <= 3 THEN 1 ELSE 0 END) AS sh FROM (
  SELECT doc_id, length(unnest(alpha)) AS k FROM toks) GROUP BY doc_id)""" + VALENCE_CTE)
WIDE_JOINS = left("vs", "a", "a3", "l", "cf", "al", "sa", "sy", "kl", "ll")


def class_ratio(text: str, cls: str) -> str:
    return r(ratio_sql(count_class_sql(text, cls), f"length({text})"))


SQL_45 = {
    "char_count": big("length(flat)"), "word_count": SQL_BASIC["word_count_alpha"], "sentence_count": SQL_BASIC["sentence_count_terminated"],
    "avg_word_length": r("coalesce(al.m, 0)"), "avg_sentence_length": r("coalesce(kl.km, 0)"), "sentence_length_std": r("coalesce(kl.ksd, 0)"),
    "unique_words": big("coalesce(a.v, 0)"), "type_token_ratio": r("coalesce(a.v / a.n, 0)"), "hapax_ratio": r("coalesce(a.hapax / a.n, 0)"),
    **{k: SQL_PUNCT[k] for k in ("comma_count", "period_count", "question_count", "exclamation_count", "semicolon_count", "colon_count",
                                 "quote_count", "punctuation_density", "punctuation_count")},
    "uppercase_ratio": class_ratio("flat", tx.UPPER), "digit_ratio": class_ratio("flat", tx.DIGIT), "whitespace_ratio": class_ratio("flat", tx.SPACE),
    **{k: SQL_LEXICONS[k] for k in ("stopword_ratio", "pronoun_ratio", "conjunction_ratio", "transition_ratio", "modal_ratio", "passive_ratio",
                                    "first_person_pronoun_count")},
    "long_word_ratio": SQL_WORDLEN["long_word_ratio"], "short_word_ratio": SQL_WORDLEN["short_word_ratio"],
    "word_length_variance": SQL_WORDLEN["word_length_variance"], "repeated_word_ratio": SQL_REPETITION["repeated_word_ratio"],
    "yules_k": SQL_LEXICAL["yules_k"], "char_entropy": SQL_ENTROPY["char_entropy_bits"], "word_entropy": SQL_ENTROPY["word_entropy_bits"],
    "passive_voice_rate": SQL_PASSIVE["passive_sentence_rate"], "gunning_fog": SQL_READABILITY["gunning_fog_ascii"],
    "contraction_count": SQL_PHRASES["contraction_count"],
    **{k: SQL_SUFFIX[k] for k in ("adverb_count", "complex_verb_count", "abstract_noun_count", "sophisticated_adjective_count")},
    "trigram_uniqueness": SQL_REPETITION["trigram_uniqueness"], "syntax_variety": SQL_SYNTAX["syntax_variety"],
    "vader_compound_score": SQL_SENTIMENT,
}
LONG_STOPS = in_count(LALPHA, lx.ENGLISH_STOPWORDS)
CPUNCT = count_class_sql("clean", tx.ASCII_PUNCT)
SQL_40 = {
    "char_count": big("length(clean)"), "char_count_no_spaces": SQL_BASIC["char_count_no_spaces"], "word_count": big("len(words)"),
    "sentence_count": big("len(ksents)"), "alpha_word_count": big("len(alpha)"), "avg_word_length": r("coalesce(ll.m, 0)"),
    "avg_sentence_length": r("coalesce(kl.gm, 0)"), "std_sentence_length": r("coalesce(kl.gsd, 0)"), "unique_words": big("coalesce(l.v, 0)"),
    "type_token_ratio": r("coalesce(l.v / l.n, 0)"), "stopword_count": big(LONG_STOPS), "stopword_ratio": r(ratio_sql(LONG_STOPS, "len(alpha)")),
    "uppercase_chars": big(count_class_sql("clean", tx.UPPER)), "uppercase_ratio": class_ratio("clean", tx.UPPER),
    "digit_count": big(count_class_sql("clean", tx.DIGIT)), "digit_ratio": class_ratio("clean", tx.DIGIT),
    "punctuation_count": big(CPUNCT), "punctuation_ratio": r(ratio_sql(CPUNCT, "length(clean)")),
    **{k: big(count_sql("clean", p)) for k, p in (("comma_count", ","), ("period_count", "."), ("semicolon_count", ";"), ("colon_count", ":"),
                                                  ("exclamation_count", "!"), ("question_count", "?"), ("hyphen_count", "-"))},
    "quote_count": big(counts_sql("clean", ('"', "'"))), "parenthesis_count": big(counts_sql("clean", ("(", ")"))),
    "newline_count": SQL_STRUCTURE["newline_count"], "long_word_count": big("coalesce(ll.lo, 0)"), "short_word_count": big("coalesce(ll.sh, 0)"),
    "long_word_ratio": r(ratio_sql("ll.lo", "len(alpha)")), "short_word_ratio": r(ratio_sql("ll.sh", "len(alpha)")),
    "avg_chars_per_sentence": r(ratio_sql("length(clean)", "len(ksents)")), "flesch_reading_ease": r(f"coalesce({EASE.replace(S, SA)}, 0)"),
    "flesch_kincaid_grade": r(kincaid(W, SA)), "gunning_fog": r(fog(W, SA, "sy.poly")), "smog_index": r(smog(SA)),
    "repeated_words": SQL_REPETITION["repeated_words"], "repeated_word_ratio": SQL_REPETITION["repeated_word_type_ratio"],
    "avg_punct_per_sentence": r(ratio_sql(CPUNCT, "len(ksents)")),
}


@query("features_wide", plain_sql({**prefix("v45", SQL_45), **prefix("v40", SQL_40)}, WIDE_CTE, WIDE_JOINS))
def features_wide(spark, sf):
    feats = {**prefix("v45", st.catalogue_45()), **prefix("v40", st.catalogue_40())}
    return family(spark, sf, feats)
