"""Stylometric feature families over a prepared token frame.

``prepare`` adds the arrays every family reads. Each step is its own
projection and each array is used several times downstream, so Catalyst keeps
it materialised once per row, and column pruning drops the arrays a query does
not touch. No step needs an exchange.
"""

from __future__ import annotations

from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import counts, lexicons as lx, sequential, text as tx
from .text import ratio

c = F.col



ASCII_TOKEN = "(?<= )[a-z]+(?:'[a-z]+)?(?= )"
LETTER_TOKEN = r"(?<= )\p{L}+(?= )"
SORTED = "wal"  # words, ASCII words, letter words


def prepare(df: DataFrame, text: str = "text") -> DataFrame:
    """Add token, sentence and frequency arrays for the three catalogues."""
    out = df.withColumns({
        "low": F.lower(c(text)),
        "flat": tx.flatten_lines(c(text)),
        "clean": tx.collapse_spaces(c(text)),
        "words": tx.word_tokens(c(text)),
        "sents": tx.sentences(c(text)),
    })
    out = out.withColumns({
        "flat_low": F.lower(c("flat")),
        "ksents": tx.sentences_terminated(c("flat")),
        "wjoin": tx.joined(c("words")),
        "lwords": F.transform("words", F.lower),
    })
    # each kept-terminator sentence as one padded string of its lower-cased tokens
    out = out.withColumns({
        "ktoks": F.transform("ksents", lambda s: tx.joined(tx.extract_all(F.lower(s), tx.WORD_APOS))),
        "ljoin": F.lower(c("wjoin")),
    })
    out = out.withColumns({
        "atoks": tx.extract_all(F.array_join("ktoks", ""), ASCII_TOKEN),
        "ltoks": tx.extract_all(c("ljoin"), LETTER_TOKEN),
    })
    out = out.withColumns({
        "ajoin": tx.joined(c("atoks")),
        "sent_len": F.transform("sents", lambda s: F.size(tx.word_tokens(s))),
        "ksent_len": F.transform("ktoks", lambda s: tx.count_pattern(s, ASCII_TOKEN)),
        "cwords_len": F.transform("ktoks", lambda s: tx.count_pattern(s, "[^ ']+")),
        "wlen": F.transform("words", F.length),
        "alen": F.transform("atoks", F.length),
        "w_sorted": F.sort_array("lwords"),
        "a_sorted": F.sort_array("atoks"),
        "l_sorted": F.sort_array("ltoks"),
        "n_words": F.size("words"),
        "n_sents": F.size("sents"),
        "n_atoks": F.size("atoks"),
        "n_ksents": F.size("ksents"),
    })
    out = out.withColumns({f"{k}_ends": counts.run_ends(c(f"{k}_sorted")) for k in SORTED})
    out = out.withColumns({f"{k}_freq": counts.run_lengths(c(f"{k}_ends")) for k in SORTED})
    return _listed_counts(out)


# --- small numeric helpers over arrays --------------------------------------

def _mean(values: Column, n: Column) -> Column:
    return ratio(tx.sum_array(values, 0), n)


def _var_pop(values: Column, n: Column) -> Column:
    """Population variance from exact integer sums."""
    s1, s2 = tx.sum_array(values, 0), counts.sum_squares(values)
    m = n.cast("long")
    return F.when(n > 0, (m * s2 - s1 * s1).cast("double") / (m * m).cast("double")).otherwise(F.lit(0.0))


def _std_pop(values: Column, n: Column) -> Column:
    return F.sqrt(_var_pop(values, n))


def _max(values: Column) -> Column:
    return F.coalesce(F.array_max(values), F.lit(0))


def _min(values: Column) -> Column:
    return F.coalesce(F.array_min(values), F.lit(0))


def _hapax(freq: str) -> Column:
    return tx.count_where(c(freq), lambda f: f == 1)


def _distinct_share(grams: Column) -> Column:
    return ratio(F.size(F.array_distinct(grams)), F.size(grams))


def _at_least_one(n: Column) -> Column:
    return F.greatest(n, F.lit(1))


# --- families ---------------------------------------------------------------

def basic(text: str = "text") -> dict[str, Column]:
    return {
        "char_count": F.length(text),
        "char_count_no_spaces": F.length(F.replace(c("clean"), F.lit(" "), F.lit(""))),
        "word_count": c("n_words"),
        "word_count_alpha": _at_least_one(c("n_atoks")),
        "sentence_count": c("n_sents"),
        "sentence_count_terminated": _at_least_one(c("n_ksents")),
    }


def lexical() -> dict[str, Column]:
    n, v = c("n_words"), F.size("w_freq")
    s2 = counts.sum_squares(c("w_freq"))
    na = c("n_atoks")
    return {
        "vocab_size": v,
        "type_token_ratio": ratio(v, n),
        "hapax_ratio": ratio(_hapax("w_freq"), n),
        "yules_k": F.when(na > 0, ratio((counts.sum_squares(c("a_freq")) - na) * 10000, na.cast("long") * na)).otherwise(0.0),
        "yules_k_types": F.when(n >= 2, ratio((s2 - v) * 10000, v.cast("long") * v)).otherwise(0.0),
        "simpsons_index": ratio(s2, n.cast("long") * n),
    }


def sentence() -> dict[str, Column]:
    n = c("n_sents")
    return {
        "avg_sentence_length": _mean(c("sent_len"), n),
        "sentence_length_std": _std_pop(c("sent_len"), n),
        "max_sentence_length": _max(c("sent_len")),
        "min_sentence_length": _min(c("sent_len")),
    }


def word_length() -> dict[str, Column]:
    n, na = c("n_words"), c("n_atoks")
    long_n, short_n = tx.count_pattern(c("ajoin"), " [^ ]{7}"), tx.count_pattern(c("ajoin"), " [^ ]{1,3}(?= )")
    return {
        "avg_word_length": ratio(F.length("wjoin") - n - 1, n),
        "word_length_std": _std_pop(c("wlen"), n),
        "word_length_variance": _var_pop(c("alen"), na),
        "max_word_length": _max(c("wlen")),
        "long_word_count": long_n,
        "short_word_count": short_n,
        "long_word_ratio": ratio(long_n, na),
        "short_word_ratio": ratio(short_n, na),
    }


def _letters() -> Column:
    """ASCII tokens without their apostrophes, padded."""
    return F.replace(c("ajoin"), F.lit("'"), F.lit(""))


def syllables() -> dict[str, Column]:
    return {
        "syllables_ascii": sequential.syllables(_letters(), "aeiou"),
        "syllables_y": sequential.syllables(c("ljoin"), "aeiouy"),
        "complex_words_ascii": sequential.complex_words(_letters(), "aeiou"),
        "complex_words_y": sequential.complex_words(c("ljoin"), "aeiouy"),
    }


def _fog(words: Column, sents: Column, complex_words: Column) -> Column:
    fog = 0.4 * (words / sents + 100.0 * (complex_words / words))
    return F.when((words > 0) & (sents > 0), fog).otherwise(0.0)


def _dbl(x: Column) -> Column:
    return F.nullif(x, F.lit(0)).cast("double")


def readability() -> dict[str, Column]:
    w, s = _dbl(c("n_words")), _dbl(c("n_sents"))
    wa, sa = _dbl(c("n_atoks")), _dbl(c("n_ksents"))
    counted = syllables()
    syl, poly = counted["syllables_y"], counted["complex_words_y"].cast("double")
    poly_a = counted["complex_words_ascii"].cast("double")
    ease = 206.835 - 1.015 * (w / s) - 84.6 * (syl / w)
    zero = F.lit(0.0)
    return {
        "avg_syllables_per_word": F.coalesce(syl / w, zero),
        "flesch_reading_ease": F.when(ease.isNull(), zero).otherwise(F.greatest(zero, F.least(F.lit(100.0), ease))),
        "flesch_reading_ease_raw": F.coalesce(ease, zero),
        "flesch_kincaid_grade": F.coalesce(0.39 * (w / s) + 11.8 * (syl / w) - 15.59, zero),
        "gunning_fog": _fog(w, s, poly),
        "gunning_fog_ascii": _fog(wa, sa, poly_a),
        "smog_index": F.coalesce(1.0430 * F.sqrt(30.0 * poly / s) + 3.1291, zero),
    }


def punctuation(text: str = "text") -> dict[str, Column]:
    t, flat, n = c(text), c("flat"), F.length(text)
    dens = tx.count_class(flat, tx.ASCII_PUNCT)
    return {
        "comma_count": tx.count_text(flat, ","),
        "period_count": tx.count_text(flat, "."),
        "question_count": tx.count_text(flat, "?"),
        "exclamation_count": tx.count_text(flat, "!"),
        "semicolon_count": tx.count_text(flat, ";"),
        "colon_count": tx.count_text(flat, ":"),
        "quote_count": tx.count_texts(flat, ('"', "'")),
        "hyphen_count": tx.count_text(flat, "-"),
        "parenthesis_count": tx.count_texts(flat, ("(", ")")),
        "punctuation_count": dens,
        "punctuation_density": ratio(dens, F.length(flat)),
        "avg_punct_per_sentence": ratio(dens, c("n_ksents")),
        "comma_rate": ratio(tx.count_text(t, ","), n),
        "semicolon_rate": ratio(tx.count_text(t, ";"), n),
        "colon_rate": ratio(tx.count_text(t, ":"), n),
        "exclamation_rate": ratio(tx.count_text(t, "!"), n),
        "question_rate": ratio(tx.count_text(t, "?"), n),
        "ellipsis_rate": ratio(tx.count_text(t, "..."), n),
        "dash_rate": ratio(tx.count_texts(t, ("-", "—")), n),
    }


def char_classes(text: str = "text") -> dict[str, Column]:
    t, n = c(text), F.length(text)
    return {
        "uppercase_count": tx.count_class(t, tx.UPPER),
        "digit_count": tx.count_class(t, tx.DIGIT),
        "capitalization_rate": ratio(tx.count_class(t, tx.UPPER), n),
        "numeric_rate": ratio(tx.count_class(t, tx.DIGIT), n),
        "whitespace_ratio": ratio(tx.count_class(t, tx.SPACE), n),
        "special_char_rate": ratio(tx.count_class(t, tx.SPECIAL), n),
    }


# column -> (token set, word list); the share is over that set's tokens
TOKEN_SHARES = {
    "stopword_ratio": ("atoks", lx.STOPWORDS_SHORT),
    "pronoun_ratio": ("atoks", lx.PRONOUNS_LONG),
    "first_person_ratio": ("atoks", lx.FIRST_PERSON),
    "conjunction_ratio": ("atoks", lx.CONJUNCTIONS),
    "transition_ratio": ("atoks", lx.TRANSITION_TOKENS),
    "modal_ratio": ("atoks", lx.MODALS),
    "passive_ratio": ("atoks", lx.BE_VERBS),
    "modal_verb_rate": ("lwords", lx.MODALS),
    "determiner_rate": ("lwords", lx.DETERMINERS),
    "pronoun_rate": ("lwords", lx.PRONOUNS_SHORT),
    "first_person_rate": ("lwords", lx.FIRST_PERSON),
    "third_person_rate": ("lwords", lx.THIRD_PERSON),
}
LISTED = tuple(sorted({w for _, words in TOKEN_SHARES.values() for w in words} | set(lx.ENGLISH_STOPWORDS)))


def _listed_counts(df: DataFrame) -> DataFrame:
    """Counts of every lexicon word in the three token arrays, one compiled pass each."""
    for tokens in ("atoks", "lwords", "ltoks"):
        model = CountVectorizerModel.from_vocabulary(list(LISTED), inputCol=tokens, outputCol=f"{tokens}_bag")
        df = model.transform(df)
    return df.withColumns({f"{t}_bag": vector_to_array(f"{t}_bag") for t in ("atoks", "lwords", "ltoks")})


def _listed(tokens: str, words: tuple[str, ...]) -> Column:
    return F.expr("cast(" + " + ".join(f"{tokens}_bag[{LISTED.index(w)}]" for w in words) + " as int)")


def lexicon_shares() -> dict[str, Column]:
    out = {name: ratio(_listed(arr, words), F.size(arr)) for name, (arr, words) in TOKEN_SHARES.items()}
    long_stops = _listed("ltoks", lx.ENGLISH_STOPWORDS)
    out["first_person_pronoun_count"] = _listed("atoks", lx.FIRST_PERSON)
    out["stopword_count_long"] = long_stops
    out["stopword_ratio_long"] = ratio(long_stops, F.size("ltoks"))
    return out


# column -> phrases counted as substrings of the lower-cased text, per word
PHRASE_RATES = {
    "ai_phrase_rate": lx.HALLMARK_PHRASES,
    "transition_word_rate": lx.TRANSITION_PHRASES,
    "hedging_rate": lx.HEDGES,
    "intensifier_rate": lx.INTENSIFIERS,
    "contraction_rate": lx.CONTRACTIONS_NO_S,
}


def phrases() -> dict[str, Column]:
    out = {k: ratio(tx.count_texts(c("low"), v), _at_least_one(c("n_words"))) for k, v in PHRASE_RATES.items()}
    out["contraction_count"] = tx.count_texts(c("flat_low"), lx.CONTRACTIONS_ALL)
    return out


PASSIVE_PATTERN = (
    "(^| )(" + "|".join(lx.BE_VERBS) + ") ([^ ]*ed|" + "|".join(lx.IRREGULAR_PARTICIPLES) + ")( |$)"
)


def passive() -> dict[str, Column]:
    return {
        "passive_sentence_rate": ratio(tx.count_where(c("ktoks"), lambda s: s.rlike(PASSIVE_PATTERN)), c("n_ksents")),
        "passive_voice_rate": ratio(tx.count_texts(c("low"), lx.PASSIVE_PHRASES), c("n_sents")),
    }


def suffixes(text: str = "text") -> dict[str, Column]:
    nouns = tx.count_suffixed(c("wjoin"), lx.NOUN_SUFFIXES)
    verbs = tx.count_suffixed(c("wjoin"), lx.VERB_SUFFIXES)
    formal = tx.count_pattern(c("wjoin"), " [^ ]{9}")
    informal = tx.count_listed(c("wjoin"), lx.INFORMAL_WORDS) + tx.count_texts(c(text), lx.INFORMAL_CONTRACTIONS)
    return {
        "adverb_count": tx.count_suffixed(c("ajoin"), ("ly",)),
        "abstract_noun_count": tx.count_suffixed(c("ajoin"), lx.ABSTRACT_SUFFIXES),
        "complex_verb_count": tx.count_listed(c("ajoin"), lx.COMPLEX_VERBS),
        "sophisticated_adjective_count": tx.count_listed(c("ajoin"), lx.SOPHISTICATED_ADJECTIVES),
        "noun_verb_ratio": ratio(nouns, verbs),
        "formality_score": ratio(formal, c("n_words")) - ratio(informal, c("n_words")),
    }


def entropies(text: str = "text") -> dict[str, Column]:
    log2 = F.ln(F.lit(2.0))
    return {
        "char_entropy": sequential.char_entropy(c(text)),
        "word_entropy": counts.entropy_nats(c("w_freq"), c("n_words")),
        "bigram_entropy": sequential.pair_entropy(c("ljoin")),
        "char_entropy_bits": sequential.char_entropy(c("flat")) / log2,
        "word_entropy_bits": counts.entropy_nats(c("a_freq"), c("n_atoks")) / log2,
    }


def _repeat_rate(n_distinct: Column, n: Column) -> Column:
    return F.when(n > 0, 1.0 - ratio(n_distinct, n)).otherwise(0.0)


def repetition() -> dict[str, Column]:
    pairs, triples, triples_a = (F.greatest(c(n) - k, F.lit(0)) for n, k in (("n_words", 1), ("n_words", 2), ("n_atoks", 2)))
    repeated = F.filter(c("a_freq"), lambda f: f > 1)
    repeated_types = tx.count_where(c("l_freq"), lambda f: f > 1)
    return {
        "word_repetition_rate": _repeat_rate(F.size("w_freq"), c("n_words")),
        "bigram_repetition_rate": _repeat_rate(sequential.gram_kinds(c("ljoin"), 2), pairs),
        "trigram_repetition_rate": _repeat_rate(sequential.gram_kinds(c("ljoin"), 3), triples),
        "trigram_uniqueness": ratio(sequential.gram_kinds(c("ajoin"), 3), triples_a),
        "repeated_word_ratio": ratio(tx.sum_array(repeated, 0), c("n_atoks")),
        "repeated_words": repeated_types,
        "repeated_word_type_ratio": ratio(repeated_types, F.size("l_freq")),
    }


def structure(text: str = "text") -> dict[str, Column]:
    starters = F.transform("sents", lambda s: F.lower(F.split(s, f"{tx.SPACE}+")[0]))
    questions = tx.count_where(c("ksents"), lambda s: s.endswith("?"))
    pieces = tx.clauses(c(text))
    return {
        "paragraph_break_rate": ratio(tx.count_text(c(text), "\n\n"), c("n_sents")),
        "newline_count": tx.count_text(c(text), "\n"),
        "avg_clause_length": ratio(c("n_words"), F.size(pieces)),
        "avg_chars_per_sentence": ratio(F.length("clean"), c("n_ksents")),
        "char_trigram_diversity": sequential.char_trigram_share(c(text)),
        "sentence_starter_diversity": ratio(F.size(F.array_distinct(starters)), c("n_sents")),
        "question_sentence_rate": ratio(questions, c("n_ksents")),
    }


def burstiness() -> dict[str, Column]:
    v, n, s2 = F.size("w_freq").cast("long"), c("n_words").cast("long"), counts.sum_squares(c("w_freq"))
    mean = ratio(n, v)
    std = F.sqrt(F.when(v > 0, (v * s2 - n * n).cast("double") / (v * v).cast("double")).otherwise(0.0))
    return {"burstiness": F.when(v >= 2, (std - mean) / (std + mean)).otherwise(0.0)}


def syntax() -> dict[str, Column]:
    def some(test):
        return F.when(F.exists("ksents", test), 1).otherwise(0)

    kinds = (
        some(lambda s: s.endswith("?"))
        + some(lambda s: s.endswith("!"))
        + some(lambda s: ~s.endswith("?") & ~s.endswith("!"))
        + some(lambda s: s.rlike("[:;]"))
        + some(lambda s: F.size(tx.word_tokens(s)) <= 5)
    )
    return {"syntax_variety": kinds / F.lit(5.0)}


# --- catalogues (fixed values: names and order of the three feature vectors) -------------------------------------------------------------

NAMES_45 = (
    "char_count", "word_count", "sentence_count", "avg_word_length", "avg_sentence_length", "sentence_length_std",
    "unique_words", "type_token_ratio", "hapax_ratio", "comma_count", "period_count", "question_count",
    "exclamation_count", "semicolon_count", "colon_count", "quote_count", "punctuation_density", "uppercase_ratio",
    "digit_ratio", "whitespace_ratio", "stopword_ratio", "pronoun_ratio", "conjunction_ratio", "transition_ratio",
    "modal_ratio", "passive_ratio", "long_word_ratio", "short_word_ratio", "repeated_word_ratio", "yules_k",
    "word_length_variance", "char_entropy", "word_entropy", "passive_voice_rate", "punctuation_count", "gunning_fog",
    "first_person_pronoun_count", "contraction_count", "adverb_count", "complex_verb_count", "abstract_noun_count",
    "sophisticated_adjective_count", "trigram_uniqueness", "syntax_variety", "vader_compound_score",
)

NAMES_56 = (
    "char_count", "word_count", "sentence_count", "vocab_size",
    "type_token_ratio", "hapax_ratio", "yules_k", "simpsons_index",
    "avg_sentence_length", "sentence_length_std", "max_sentence_length", "min_sentence_length",
    "avg_word_length", "word_length_std", "max_word_length",
    "flesch_reading_ease", "avg_syllables_per_word", "gunning_fog",
    "comma_rate", "semicolon_rate", "colon_rate", "exclamation_rate", "question_rate", "ellipsis_rate", "dash_rate",
    "ai_phrase_rate", "transition_word_rate", "hedging_rate", "intensifier_rate", "contraction_rate",
    "char_entropy", "word_entropy", "bigram_entropy",
    "bigram_repetition_rate", "trigram_repetition_rate", "word_repetition_rate",
    "passive_voice_rate", "modal_verb_rate", "determiner_rate", "pronoun_rate", "first_person_rate",
    "third_person_rate", "paragraph_break_rate", "avg_clause_length", "mtld", "burstiness", "compression_ratio",
    "char_trigram_diversity", "capitalization_rate", "numeric_rate", "special_char_rate",
    "sentence_starter_diversity", "question_sentence_rate", "noun_verb_ratio", "formality_score", "lexical_cohesion",
)

NAMES_40 = (
    "char_count", "char_count_no_spaces", "word_count", "sentence_count", "alpha_word_count", "avg_word_length",
    "avg_sentence_length", "std_sentence_length", "unique_words", "type_token_ratio", "stopword_count",
    "stopword_ratio", "uppercase_chars", "uppercase_ratio", "digit_count", "digit_ratio", "punctuation_count",
    "punctuation_ratio", "comma_count", "period_count", "semicolon_count", "colon_count", "exclamation_count",
    "question_count", "quote_count", "hyphen_count", "parenthesis_count", "newline_count", "long_word_count",
    "short_word_count", "long_word_ratio", "short_word_ratio", "avg_chars_per_sentence", "flesch_reading_ease",
    "flesch_kincaid_grade", "gunning_fog", "smog_index", "repeated_words", "repeated_word_ratio",
    "avg_punct_per_sentence",
)


ARROW_56 = ("mtld", "compression_ratio", "lexical_cohesion")


def catalogue_45() -> dict[str, Column]:
    """The 45-feature catalogue; its last column is ``sentiment`` with the default lexicon."""
    flat, n, na = c("flat"), F.length("flat"), c("n_atoks")
    shares, punct, rep = lexicon_shares(), punctuation(), repetition()
    wl, suf, ent = word_length(), suffixes(), entropies()
    own = {
        "char_count": n,
        "word_count": _at_least_one(na),
        "sentence_count": _at_least_one(c("n_ksents")),
        "avg_word_length": _mean(c("alen"), na),
        "avg_sentence_length": _mean(c("ksent_len"), c("n_ksents")),
        "sentence_length_std": _std_pop(c("ksent_len"), c("n_ksents")),
        "unique_words": F.size("a_freq"),
        "type_token_ratio": ratio(F.size("a_freq"), na),
        "hapax_ratio": ratio(_hapax("a_freq"), na),
        "uppercase_ratio": ratio(tx.count_class(flat, tx.UPPER), n),
        "digit_ratio": ratio(tx.count_class(flat, tx.DIGIT), n),
        "whitespace_ratio": ratio(tx.count_class(flat, tx.SPACE), n),
        "yules_k": lexical()["yules_k"],
        "char_entropy": ent["char_entropy_bits"],
        "word_entropy": ent["word_entropy_bits"],
        "passive_voice_rate": passive()["passive_sentence_rate"],
        "gunning_fog": readability()["gunning_fog_ascii"],
        "contraction_count": phrases()["contraction_count"],
        "syntax_variety": syntax()["syntax_variety"],
        "vader_compound_score": sentiment()["sentiment"],
    }
    pool = {**punct, **shares, **rep, **wl, **suf, **own}
    return {name: pool[name] for name in NAMES_45}


def catalogue_56(text: str = "text") -> dict[str, Column]:
    """The 56-feature catalogue without its three Arrow columns."""
    pool = {
        **basic(text), **lexical(), **sentence(), **word_length(), **readability(), **punctuation(text), **phrases(),
        **entropies(text), **repetition(), **passive(), **lexicon_shares(), **structure(text), **burstiness(),
        **char_classes(text), **suffixes(text),
    }
    pool["yules_k"] = pool["yules_k_types"]
    return {name: pool[name] for name in NAMES_56 if name not in ARROW_56}


def catalogue_40() -> dict[str, Column]:
    """The 40-feature catalogue; alphabetic words are letter-only word tokens."""
    clean, n, nk = c("clean"), F.length("clean"), c("n_ksents")
    na = F.size("ltoks")
    padded = tx.joined(c("ltoks"))
    long_n, short_n = tx.count_pattern(padded, " [^ ]{7}"), tx.count_pattern(padded, " [^ ]{1,3}(?= )")
    stops = _listed("ltoks", lx.ENGLISH_STOPWORDS)
    up, digits, punct = (tx.count_class(clean, k) for k in (tx.UPPER, tx.DIGIT, tx.ASCII_PUNCT))
    w, s = _dbl(c("n_words")), _dbl(nk)
    counted = syllables()
    syl, poly = counted["syllables_y"], counted["complex_words_y"].cast("double")
    rep, zero = repetition(), F.lit(0.0)
    pool = {
        "char_count": n,
        "char_count_no_spaces": basic()["char_count_no_spaces"],
        "word_count": c("n_words"),
        "sentence_count": nk,
        "alpha_word_count": na,
        "avg_word_length": ratio(F.length(padded) - F.size("ltoks") - 1, F.size("ltoks")),
        "avg_sentence_length": _mean(c("cwords_len"), nk),
        "std_sentence_length": _std_pop(c("cwords_len"), nk),
        "unique_words": F.size("l_freq"),
        "type_token_ratio": ratio(F.size("l_freq"), na),
        "stopword_count": stops,
        "stopword_ratio": ratio(stops, na),
        "uppercase_chars": up,
        "uppercase_ratio": ratio(up, n),
        "digit_count": digits,
        "digit_ratio": ratio(digits, n),
        "punctuation_count": punct,
        "punctuation_ratio": ratio(punct, n),
        "newline_count": structure()["newline_count"],
        "long_word_count": long_n,
        "short_word_count": short_n,
        "long_word_ratio": ratio(long_n, na),
        "short_word_ratio": ratio(short_n, na),
        "avg_chars_per_sentence": ratio(n, nk),
        "flesch_reading_ease": F.coalesce(206.835 - 1.015 * (w / s) - 84.6 * (syl / w), zero),
        "flesch_kincaid_grade": F.coalesce(0.39 * (w / s) + 11.8 * (syl / w) - 15.59, zero),
        "gunning_fog": _fog(w, s, poly),
        "smog_index": F.coalesce(1.0430 * F.sqrt(30.0 * poly / s) + 3.1291, zero),
        "repeated_words": rep["repeated_words"],
        "repeated_word_ratio": rep["repeated_word_type_ratio"],
        "avg_punct_per_sentence": ratio(punct, nk),
    }
    for name, piece in (("comma_count", ","), ("period_count", "."), ("semicolon_count", ";"), ("colon_count", ":"),
                        ("exclamation_count", "!"), ("question_count", "?"), ("hyphen_count", "-")):
        pool[name] = tx.count_text(clean, piece)
    pool["quote_count"] = tx.count_texts(clean, ('"', "'"))
    pool["parenthesis_count"] = tx.count_texts(clean, ("(", ")"))
    return {name: pool[name] for name in NAMES_40}


def select_features(df: DataFrame, keep: list[str], features: dict[str, Column]) -> DataFrame:
    return df.select(*keep, *[col.alias(name) for name, col in features.items()])


def sentiment(lexicon: tuple[tuple[str, float], ...] = lx.VALENCE, alpha: float = 15.0) -> dict[str, Column]:
    """Compound valence of the tokens, ``s / sqrt(s^2 + alpha)``.

    The lexicon is a bounded table given by the caller, so it travels inside
    the plan as a map literal and the lookup needs no join.
    """
    table = F.create_map(*[F.lit(x) for pair in lexicon for x in pair])
    hits = F.filter("atoks", lambda w: w.isin(*[word for word, _ in lexicon]))
    total = tx.sum_array(F.transform(hits, lambda w: F.try_element_at(table, w)), 0.0)
    return {"sentiment": total / F.sqrt(total * total + alpha)}


def vector_56(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """All 56 features in catalogue order; missing or empty text gives zeros."""
    raw = df.withColumn(text, F.coalesce(c(text), F.lit("")))
    feats = catalogue_56(text)
    prepared = prepare(raw, text)
    arrow = {
        "mtld": sequential.mtld(c("ljoin")),
        "compression_ratio": sequential.compression_ratio(c(text)),
        "lexical_cohesion": sequential.lexical_cohesion(c("wjoin")),
    }
    out = prepared.select(*keep, *[col.alias(k) for k, col in {**feats, **arrow}.items()])
    return out.select(*keep, *[F.coalesce(c(k).cast("double"), F.lit(0.0)).alias(k) for k in NAMES_56])
