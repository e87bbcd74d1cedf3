"""Column functions against plain Python on awkward texts."""

import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from inkline.functions import counts, lexicons as lx, sequential as sq, stylometry as st, text as tx

TEXTS = [
    "", " ", "word", "...!?", "Don't stop; it's fine, isn't it? Yes! No.\n\nNew part: the end...",
    "Élan vital où ça? 東京は大きい。 naïve café 123 ½ x²", "a a a b b c " * 40, "thus thus,thusthus n't'll 'd",
    "the bee made free use of aeiou rhythm eye e", "x" * 300 + " " + "yz " * 200, "Line one\r\nline two three",
    "don't've o'er rock'n'roll 'quoted' I'm",
]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string").repartition(3, "doc_id")


def column(frame, col):
    return {r["doc_id"]: r["v"] for r in frame.select("doc_id", col.alias("v")).collect()}


def words(t):
    return re.findall(r"\b\w+\b", t)


def sentences(t):
    return [s.strip() for s in re.split(r"[.!?]+", t) if s.strip()]


def test_tokens_and_sentences(frame):
    assert column(frame, tx.word_tokens(F.col("text"))) == {i: words(t) for i, t in enumerate(TEXTS)}
    assert column(frame, tx.sentences(F.col("text"))) == {i: sentences(t) for i, t in enumerate(TEXTS)}


def alpha(t):
    flat = t.replace("\n", " ").replace("\r", " ").strip()
    return [w.lower() for w in re.findall(r"\b\w+(?:'\w+)?\b", flat) if re.match(r"^[A-Za-z]+(?:'[A-Za-z]+)?$", w)]


def test_ascii_tokens_agree_with_definition(frame):
    got = column(st.prepare(frame), F.col("atoks"))
    assert got == {i: alpha(t) for i, t in enumerate(TEXTS)}


def syllables(word, vowels):
    groups = len(re.findall(f"[{vowels}]+", word))
    return max(1, groups - (1 if word.endswith("e") else 0))


def test_syllable_counts(frame):
    p = st.prepare(frame)
    f = st.syllables()
    for vowels, tok, kind in (("aeiouy", lambda t: [w.lower() for w in words(t)], "y"), ("aeiou", lambda t: [w.replace("'", "") for w in alpha(t)], "ascii")):
        want = {i: [syllables(w, vowels) for w in tok(t)] for i, t in enumerate(TEXTS)}
        assert column(p, f[f"syllables_{kind}"]) == {i: sum(v) for i, v in want.items()}
        assert column(p, f[f"complex_words_{kind}"]) == {i: sum(x >= 3 for x in v) for i, v in want.items()}


@pytest.mark.parametrize("phrases", [lx.HALLMARK_PHRASES, lx.HEDGES, lx.CONTRACTIONS_ALL, lx.PASSIVE_PHRASES, ("aa", "a"), ("ab", "abc", "b")])
def test_phrase_counts(frame, phrases):
    got = column(frame, tx.count_texts(F.lower("text"), phrases))
    assert got == {i: sum(t.lower().count(p) for p in phrases) for i, t in enumerate(TEXTS)}


def test_frequencies(frame):
    got = column(frame, F.array_sort(counts.char_frequencies(F.col("text"))))
    assert got == {i: sorted(Counter(t).values()) for i, t in enumerate(TEXTS)}
    got = column(st.prepare(frame), F.array_sort("w_freq"))
    assert got == {i: sorted(Counter(w.lower() for w in words(t)).values()) for i, t in enumerate(TEXTS)}


def test_ngrams(frame):
    padded = tx.joined(tx.word_tokens(F.col("text")))
    for n in (2, 3):
        want = {i: sorted(" ".join(w[k:k + n]) for k in range(len(w) - n + 1)) for i, w in enumerate(map(words, TEXTS))}
        assert {i: sorted(v) for i, v in column(frame, tx.word_ngrams(padded, n)).items()} == want
        assert {i: sorted(v) for i, v in column(frame, tx.ordered_ngrams(tx.word_tokens(F.col("text")), n)).items()} == want
    tri = {i: sorted(v) for i, v in column(frame, tx.char_trigrams(F.col("text"))).items()}
    assert tri == {i: sorted(t[k:k + 3] for k in range(len(t) - 2)) for i, t in enumerate(TEXTS)}


def brute_mtld(w, limit=0.72):
    if len(w) < 50:
        return float(len(set(w)))

    def one(seq):
        factor, start = 0.0, 0
        for k in range(len(seq)):
            part = seq[start:k + 1]
            if len(set(part)) / len(part) < limit:
                factor, start = factor + 1, k + 1
        rest = seq[start:]
        if rest:
            factor += (1 - len(set(rest)) / len(rest)) / (1 - limit)
        return len(seq) / factor if factor > 0 else float(len(seq))

    return (one(w) + one(w[::-1])) / 2


def brute_cohesion(w):
    vals = []
    for i in range(len(w) - 10):
        a, b = set(w[i:i + 5]), set(w[i + 5:i + 10])
        vals.append(len(a & b) / len(a | b))
    return sum(vals) / len(vals) if vals else 0.0


def test_sequential_columns(frame):
    joined = tx.joined(tx.word_tokens(F.col("text")))
    got = column(frame, sq.mtld(F.lower(joined)))
    assert got == pytest.approx({i: brute_mtld([w.lower() for w in words(t)]) for i, t in enumerate(TEXTS)})
    assert column(frame, sq.lexical_cohesion(joined)) == pytest.approx({i: brute_cohesion(words(t)) for i, t in enumerate(TEXTS)})
    want = {i: len(zlib.compress(t.encode())) / len(t.encode()) if t else 0.0 for i, t in enumerate(TEXTS)}
    assert column(frame, sq.compression_ratio("text")) == pytest.approx(want)


def test_vector_56(frame, spark):
    out = st.vector_56(frame.unionByName(spark.createDataFrame([(99, None)], "doc_id int, text string")), ["doc_id"])
    assert out.columns == ["doc_id", *st.NAMES_56] and len(st.NAMES_56) == 56
    rows = {r["doc_id"]: r.asDict() for r in out.collect()}
    assert all(v == 0.0 for k, v in rows[99].items() if k != "doc_id")
    assert all(v == 0.0 for k, v in rows[0].items() if k != "doc_id")
    for i, r in rows.items():
        for name in ("type_token_ratio", "hapax_ratio", "capitalization_rate", "char_trigram_diversity", "lexical_cohesion"):
            assert 0.0 <= r[name] <= 1.0
        if r["type_token_ratio"] == 1.0:
            assert r["hapax_ratio"] == 1.0


def test_catalogue_sizes(spark):
    assert len(st.NAMES_45) == 45 and len(st.NAMES_40) == 40
    assert list(st.catalogue_45()) == list(st.NAMES_45) and list(st.catalogue_40()) == list(st.NAMES_40)


def test_no_exchange_in_feature_pass(spark, frame):
    df = st.select_features(st.prepare(spark.range(3).selectExpr("id doc_id", "'a b' text")), ["doc_id"], st.lexical())
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_arrow_counts_equal_the_patterns(spark):
    """Character and gram entropies, distinct shares and syllables as the sorted arrays and patterns give them."""
    texts = ["  ", " the queue eye rhythm strengths idea ", None, "", " e ee ie be see naïve café don't 12 _e the queue eye the queue ", " \U0001f600a e\U0001f600 ae x ", " a a a a a b "]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(2)
    t, zero = F.col("t"), F.lit(0.0)
    grams = df.withColumn("g", F.sort_array(tx.word_ngrams(t, 2))).withColumn("e", counts.run_ends(F.col("g")))
    pairs = [
        (sq.char_entropy(t), counts.entropy_nats(counts.char_frequencies(t), F.length(t))),
        (sq.char_trigram_share(t), tx.ratio(F.size(F.array_distinct(tx.char_trigrams(t))), F.size(tx.char_trigrams(t)))),
        (sq.pair_entropy(t), counts.entropy_nats(counts.run_lengths(F.col("e")), F.size("g"))),
        *[(sq.gram_kinds(t, n), F.coalesce(F.size(F.array_distinct(tx.word_ngrams(t, n))), F.lit(0))) for n in (2, 3)],
        *[(new(t, v), old(t, v)) for v in ("aeiou", "aeiouy") for new, old in ((sq.syllables, tx.syllables), (sq.complex_words, tx.complex_words))]]
    apart = [F.abs(F.coalesce(a.cast("double"), zero) - F.coalesce(b.cast("double"), zero)) for a, b in pairs]
    for row in grams.select("t", *apart).collect():
        assert max(row[1:]) < 1e-11, row
