"""Periodic runs, vector codes and chat formatting against brute force, on small tables with every odd case."""

import hashlib
import json
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkline.llm import chat, runs, vector_codes as vc


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- periodic runs --------------------------------------------------------------

def all_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(6, 4 * q):
                found.setdefault((start, i - start + q), q)
            i += 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def kept_words(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def some_words(rng):
    n, kinds = rng.choice([0, 1, 5, 6, 7, 25, 120, 700]), rng.choice([1, 2, 3, 60])
    words = [f"w{rng.randrange(kinds)}" for _ in range(n)]
    if n and rng.random() < 0.6:
        a, p = rng.randrange(n), rng.randint(1, max(1, n // 4))
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if rng.random() < 0.4:
            words[rng.randrange(n)] = "other"
    return words


@pytest.mark.parametrize("pending", [1, 40, runs.PENDING])
def test_runs_of_a_block(monkeypatch, pending):
    monkeypatch.setattr(runs, "PENDING", pending)
    monkeypatch.setattr(runs, "TOGETHER", 64)
    rng = random.Random(pending)
    for size in (0, 1, 3, 25, 25):
        docs = [some_words(rng) for _ in range(size)]
        docs += docs[: size // 4]
        got = runs.find_runs([[w.encode() for w in d] for d in docs])
        assert [list(map(tuple, g.tolist())) for g in got] == [all_runs(d) for d in docs]


def test_extensions_match_word_by_word():
    rng = np.random.default_rng(3)
    for kinds, n in ((1, 400), (2, 500), (30, 300)):
        codes = np.append(rng.integers(0, kinds, n), kinds)
        codes[n // 2 : n // 2 + 150] = codes[:150]
        index = runs.CoverIndex(codes)
        i, j = rng.integers(0, n, (2, 2000))
        i, j = i[i != j], j[i != j]
        for a, b, got in zip(i, j, index.extension(i, j), strict=True):
            k = 0
            while max(a, b) + k < len(codes) and codes[a + k] == codes[b + k]:
                k += 1
            assert got == k


def test_index_holds_sampled_suffixes_only():
    index = runs.CoverIndex(np.append(np.zeros(3100, np.int64), 1))
    assert len(index.places) == len(index.rank) == 3100 * len(runs.COVER) // runs.V


@pytest.fixture(scope="module")
def odd_docs(spark):
    rng = random.Random(9)
    texts = [None, "", " \t\n", "a a a a a a", "a a a a a", "x y x y x y x y", "\x0bé\x0cé é\ré é  é\n", "z " * 6000, "日本 語 " * 5, "a b c d e f g h i j k l"]
    texts += [" ".join(some_words(rng)) for _ in range(60)]
    rows = [(i, t, "n", 1.0) for i, t in enumerate(texts)] + [(None, "q q q q q q q", "n", 2.0), (3, texts[3], "n", 2.0), (3, "r r r r r r", "n", 2.0)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, runs string, n_words double").repartition(3)


def test_periodic_runs_of_a_table(spark, odd_docs):
    rows, df = odd_docs
    want = []
    for doc_id, text, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        want.append((doc_id, len(words), tuple(all_runs(words)), kept_words(words, all_runs(words))))
    got = [(r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in runs.periodic_runs(df).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert runs.periodic_runs(df.filter("doc_id < 0")).count() == 0


def test_run_digests_with_planted_rounds(spark, odd_docs):
    rows, df = odd_docs
    got = {r.doc_id: r for r in runs.digests(runs.periodic_runs(runs.with_rounds(df.filter("n_words = 1")))).collect()}
    planted = 0
    for doc_id, text, *_ in (r for r in rows if r[3] == 1.0):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        found = all_runs(words)
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3
        r = got[doc_id]
        assert (r.n_runs, r.start, r.length, r.period) == (len(found), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if found else None)
        assert r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in found)) and r.collapsed_sha256 == sha(kept_words(words, found))
    assert planted > 1
    nothing = runs.with_rounds(df.filter("doc_id < 0"))
    assert runs.digests(runs.periodic_runs(nothing)).count() == 0


# --- vector codes ---------------------------------------------------------------

def coded_by_hand(rows, parts, entries, rounds):
    width = max((len(v) for _, _, v in rows), default=0)
    width = -(-width // parts) * parts
    x = {k: [int(np.floor(256 * float(np.float32(c)))) for c in v] + [0] * (width - len(v)) for k, (_, _, v) in enumerate(rows)}
    w = width // parts
    cell = lambda k, p: x[k][p * w : (p + 1) * w]
    order = sorted(x, key=lambda k: (rows[k][0] is None, rows[k][0] or 0, rows[k][2]))[:entries]
    books = [[list(cell(k, p)) for k in order] for p in range(parts)]

    def nearest(k, p):
        return min((sum((a - b) ** 2 for a, b in zip(cell(k, p), c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        at = {(k, p): nearest(k, p)[1] for k in x for p in range(parts)}
        for p in range(parts):
            for e in range(len(order)):
                mine = [cell(k, p) for k in x if at[k, p] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    out = [[nearest(k, p) for p in range(parts)] for k in x]
    return [("".join(f"{e:02x}" for _, e in row), sum(d for d, _ in row)) for row in out], books


@pytest.mark.parametrize("n,width,entries", [(200, 8, 16), (10, 8, 64), (150, 6, 5)])
def test_codes_match_a_loop(spark, n, width, entries):
    rng = np.random.default_rng(n)
    centres = rng.normal(size=(6, width)).astype(np.float32) / 4
    rows = [(int(k) * 3 % 101, [None, 1, 2][k % 3], [float(c) for c in centres[k % 6] + rng.normal(size=width).astype(np.float32) / 20]) for k in range(n)]
    rows += [(k + 500, 1, rows[0][2]) for k in range(n // 3)] + [(None, 2, rows[1][2]), (7, None, [0.5] * (width - 2)), (900, 1, [])]
    bad = [(800, 1, None), (801, 1, [1.0] * (width - 1) + [None]), (802, 2, [float("nan")] * width), (803, 2, [float("inf")] + [0.0] * (width - 1))]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows + bad], "vec_id long, label int, embedding array<float>, code string, error int").repartition(4)
    coded, books = vc.compress(df, parts=4, entries=entries)
    want, want_books = coded_by_hand(rows, 4, entries, 2)
    totals = {}
    for (_, label, _), (_, error) in zip(rows, want):
        totals[label] = totals.get(label, 0) + error
    got = [tuple(r) for r in vc.with_label_error(coded).select("vec_id", "label", "code", "error", "label_error").collect()]
    assert sorted(map(str, got)) == sorted(str((i, label, c, e, totals[label])) for (i, label, _), (c, e) in zip(rows, want))
    assert books.tolist() == want_books
    assert vc.digest(books) == sha(",".join(str(c) for part in want_books for entry in part for c in entry))
    assert vc.reconstruct(want[0][0], books).shape == (books.shape[0] * books.shape[2],)


def test_balls_equal_all_comparisons_with_fewer():
    rng = np.random.default_rng(5)
    before = rng.integers(-60, 60, (40, 3))
    x = before[rng.integers(0, 40, 4000)] + rng.integers(-3, 4, (4000, 3))
    own, _ = vc.full_assign(x, before)
    book = before + rng.integers(-1, 2, before.shape)
    code, best, compared = vc.ball_assign(x, own, book, (book != before).any(1))
    want, far = vc.full_assign(x, book)
    assert (code == want).all() and (best == far).all() and compared < 4000 * 10
    assert vc.ball_assign(x, own, before, np.zeros(40, bool))[2] == 0


def test_balls_with_ties_and_equal_entries():
    rng = np.random.default_rng(6)
    book = rng.integers(0, 3, (20, 2))  # entries repeat, and many parts lie half way
    x = rng.integers(0, 3, (500, 2))
    own = rng.integers(0, 20, 500)
    code, best, _ = vc.ball_assign(x, own, book, np.ones(20, bool))
    want, far = vc.full_assign(x, book)
    assert (code == want).all() and (best == far).all()


def test_no_vectors_and_large_ones(spark):
    schema = "vec_id long, label int, embedding array<float>"
    coded, books = vc.compress(spark.createDataFrame([(1, 1, None)], schema))
    assert vc.with_label_error(coded).count() == 0 and books.shape[1] == 0
    with pytest.raises(ValueError):
        vc.compress(spark.createDataFrame([(1, 1, [1e30])], schema))


# --- chat -----------------------------------------------------------------------

TURNS = [
    (1, 0, "system", "be\\kind"), (1, 1, "user", "hi [INST] <s>"), (1, 2, "assistant", "</s>[INST] ok [/INST]"), (1, 3, "user", "\\<\\s>"), (1, 4, "assistant", "é🎉\\"),
    (2, 0, "user", None), (2, 1, "assistant", ""),
    (3, 0, "assistant", "first"), (3, 1, "user", "second"),
    (4, 0, "user", "a"), (4, 0, "user", "a"), (4, None, "tool", "[TEXT] x [/ROLE]"), (4, 2, None, "no role"), (4, 3, "[TEXT]", "<\\unk>"),
    (None, 0, "user", "lost"), (None, 1, "assistant", "found"),
    (5, 2, "assistant", "z" * 50_000), (5, 1, "user", "<unk>[ROLE]"), (6, 0, "user", "open end"),
]
VALID = {1: True, 2: True, 3: False, 4: False, None: True, 5: True, 6: False}


@pytest.fixture(scope="module")
def talks(spark):
    return spark.createDataFrame([(*t, "x", 1) for t in TURNS], "conv_id long, turn int, role string, text string, formatted string, state int").repartition(4)


def test_formatted_text_is_read_back(talks):
    made = {r.conv_id: r for r in chat.format_conversations(talks).select("*", chat.read_turns(F.col("formatted")).alias("back")).collect()}
    assert set(made) == set(VALID)
    for conv, r in made.items():
        own = sorted(((t[1] is not None, t[1] or 0, t[2] or "", t[3] or "") for t in TURNS if t[0] == conv))
        assert [tuple(b) for b in r.back] == [(role, text) for _, _, role, text in own]
        assert r.formatted == "".join(s.text for s in r.segments) and len(r.segments) == 3 * len(own)
        assert r.valid == VALID[conv]
        marks = sum(r.formatted.count(m) for m in ("<<SYS>>", "[INST]", "<s>", "[ROLE]"))
        assert marks == len(own) and r.formatted.count("<unk>") == 0
    assert [made[k].fault_at for k in (1, 3, 4)] == [None, 0, 0]


def test_chat_digests_by_hand(spark, talks):
    got = {r.conv_id: r for r in chat.digests(chat.format_conversations(chat.with_planted(spark, talks))).collect()}
    turns = TURNS + [(-7, 0, "user", chat.PLANTED_TEXT), (-7, 1, "assistant", chat.PLANTED_TEXT)]
    for conv in {t[0] for t in turns}:
        own = sorted(((t[1] is not None, t[1] or 0, t[2] or "", t[3] or "") for t in turns if t[0] == conv))
        loss = "".join(text for _, _, role, text in own if role == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(own), sha("".join(f"{role}\n{text}\n" for _, _, role, text in own)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss)) and r.formatted_chars > sum(len(t[3]) for t in own)
    assert chat.format_conversations(talks.filter("turn > 99")).count() == 0


def test_chat_plan_has_no_python(spark, talks):
    plan = chat.digests(chat.format_conversations(talks))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_templates_are_checked():
    with pytest.raises(ValueError):
        chat.Template({"user": ("<u>", "<u>>")}, ("[r]", "[t]", "[/r]"), {"": ("user",)}, (), ("user",))
    with pytest.raises(ValueError):
        chat.Template({"user": ("<\\u>", "</u>")}, ("[r]", "[t]", "[/r]"), {"": ("user",)}, (), ("user",))
    own = chat.Template({"human": ("<|h|>", "<|/h|>")}, ("[r]", "[t]", "[/r]"), {"": ("human",), "human": ("bot",)}, ("bot",), ("bot",), escape="~")
    assert json.dumps(own.control) == json.dumps(["<|h|>", "<|/h|>", "[r]", "[t]", "[/r]"])
