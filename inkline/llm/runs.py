"""Periodic runs of words, and texts collapsed to one round of each.

A run is a stretch of consecutive words with smallest period q (words q apart
are equal) that holds at least ``POWER`` rounds and ``LEAST`` words and that no
neighbouring word extends. For each q the words q apart are compared on a grid
so wide that every run of that period meets it; over all q those are
harmonically many places. From an equal pair on, the longest common extensions
to both sides bound the run.

Extensions come from a difference cover: of every V places those with COVER's
residues are sampled, so that any two places reach sampled ones by a common
shift of less than V words. These few words are compared; where they are equal,
the extension is the least entry between both sampled suffixes in the
table of common prefixes of sorted neighbours. Only the sampled suffixes are sorted,
and only of documents with pairs that the few words leave open.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as wd

POWER, LEAST = 4, 6
V, COVER = 31, (1, 5, 11, 24, 25, 27)  # a perfect difference set: every difference modulo 31 occurs once
TOGETHER, PENDING = 1 << 16, 1 << 20  # pairs compared at once, open pairs held before they are settled

RUN = T.StructType([T.StructField(name, T.LongType(), False) for name in ("start", "length", "period")])


def cover_shifts() -> np.ndarray:
    """``[a, b]``: after how many words places with residues a and b are first both sampled."""
    sampled = np.isin((np.arange(V)[:, None] + np.arange(V)) % V, COVER)
    both = sampled[:, None] & sampled[None]
    if not both.any(2).all():
        raise ValueError("not a difference cover")
    return both.argmax(2)


SHIFT = cover_shifts()


def few_words(codes: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many words are equal from i and j on before both places are sampled, and whether all are."""
    shift = SHIFT[i % V, j % V]
    length = np.zeros(len(i), np.int64)
    running = np.arange(len(i))
    for k in range(V):
        running = running[shift[running] > k]
        if not len(running):
            break
        running = running[codes[i[running] + k] == codes[j[running] + k]]
        length[running] = k + 1
    return length, length == shift


def ranks(order: np.ndarray, keys: list[np.ndarray]) -> np.ndarray:
    """Dense ranks of the rows sorted by ``order``; equal keys share one."""
    new = np.zeros(len(order), bool)
    for key in keys:
        ordered = key[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


class CoverIndex:
    """Longest common extensions of a sequence of codes; the last code must occur once."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.places = np.flatnonzero(np.isin(np.arange(len(codes)) % V, COVER))
        self.slot = np.full(len(codes) + 1, -1, np.int64)
        self.slot[self.places] = np.arange(len(self.places))
        order, levels = self.sort()
        self.rank = levels[-1]
        self.table = [self.neighbours(order, levels)]
        while 2 << (len(self.table) - 1) <= len(self.table[0]):
            half, last = 1 << (len(self.table) - 1), self.table[-1]
            self.table.append(np.minimum(last[:-half], last[half:]))

    def at(self, places: np.ndarray) -> np.ndarray:
        """Numbers of sampled places; -1 behind the end."""
        return self.slot[np.minimum(places, len(self.codes))]

    def sort(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """Order of the sampled suffixes, and their ranks by the first V, 2 V, 4 V... words."""
        padded = np.concatenate([self.codes, np.zeros(V, np.int64)])  # the last code differs before these are met
        bits = max(1, int(self.codes.max()).bit_length())
        together, keys = max(1, 62 // bits), []
        for k in range(0, V, together):
            key = np.zeros(len(self.places), np.int64)
            for step in range(k, min(k + together, V)):
                key = key << bits | padded[self.places + step]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        levels, n = [ranks(order, keys)], len(self.places)
        while n and levels[-1].max() + 1 < n:
            after = self.at(self.places + (V << (len(levels) - 1)))
            key = levels[-1] * (n + 1) + np.where(after < 0, 0, levels[-1][after] + 1)
            order = np.argsort(key, kind="stable")
            levels.append(ranks(order, [key]))
        return order, levels

    def neighbours(self, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common prefixes of suffixes next to each other in the order: halving spans of equal rank, then words."""
        a, b = self.places[order[:-1]], self.places[order[1:]]
        length = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 2, -1, -1):
            x, y = self.at(a + length), self.at(b + length)
            length += (V << k) * ((x >= 0) & (y >= 0) & (levels[k][x] == levels[k][y]))
        running = np.arange(len(a))
        while len(running):
            running = running[self.codes[a[running] + length[running]] == self.codes[b[running] + length[running]]]
            length[running] += 1
        return length

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words are equal from the places i and j on; no i equals its j."""
        length, reached = few_words(self.codes, i, j)
        far = np.flatnonzero(reached)
        x, y = self.rank[self.slot[i[far] + length[far]]], self.rank[self.slot[j[far] + length[far]]]
        low, high = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp((high - low).astype(float))[1] - 1
        for k in np.unique(level):
            of = np.flatnonzero(level == k)
            row = self.table[k]
            length[far[of]] += np.minimum(row[low[of]], row[high[of] - (1 << int(k))])
        return length


class Block:
    """Documents side by side, longest first, a code of its own before, between and behind them."""

    def __init__(self, docs: list[np.ndarray], numbers: np.ndarray):
        self.docs, self.numbers = docs, numbers
        self.sizes = np.array([len(d) for d in docs], np.int64)
        self.starts = np.cumsum(np.concatenate(([0], self.sizes + 1)))[:-1] + 1
        first = max((int(d.max()) for d in docs if len(d)), default=-1) + 1
        self.codes = np.empty(int(self.sizes.sum()) + len(docs) + 1, np.int64)
        self.codes[0] = first
        for k, (at, doc) in enumerate(zip(self.starts.tolist(), docs, strict=True)):
            self.codes[at : at + len(doc)] = doc
            self.codes[at + len(doc)] = first + k + 1
        self.back = self.codes[::-1]

    def owner(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, places, side="right") - 1

    def grid(self) -> Iterator[tuple[np.ndarray, int]]:
        """Places whose word is repeated q words on, at least one of each run of period q."""
        for q in range(1, int(self.sizes[0]) // POWER + 1):
            least = max(LEAST, POWER * q)
            held = int(np.searchsorted(-self.sizes, -least, side="right"))
            if not held:
                return
            end, gap = int(self.starts[held - 1] + self.sizes[held - 1]), least - q
            hits = np.flatnonzero(self.codes[: end - q : gap] == self.codes[q:end:gap]) * gap
            if len(hits):
                yield hits, q

    def settle(self, i: np.ndarray, q: np.ndarray, after: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Rows (document, start, length, period) of the pairs whose extensions make a run."""
        length = before + after + q
        good = length >= np.maximum(LEAST, POWER * q)
        i, q, before, length = i[good], q[good], before[good], length[good]
        owner = self.owner(i)
        return np.stack([self.numbers[owner], i - before - self.starts[owner], length, q], axis=1)

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The grid's places and periods, many periods together."""
        places, periods, held = [], [], 0
        for hits, q in self.grid():
            places.append(hits)
            periods.append(np.full(len(hits), q))
            held += len(hits)
            if held >= TOGETHER:
                yield np.concatenate(places), np.concatenate(periods)
                places, periods, held = [], [], 0
        if held:
            yield np.concatenate(places), np.concatenate(periods)

    def runs(self) -> np.ndarray:
        found, pending, held, index = [np.zeros((0, 4), np.int64)], [], 0, None
        for i, q in self.pairs():
            after, on = few_words(self.codes, i, i + q)
            before, back = few_words(self.back, len(self.codes) - i, len(self.codes) - i - q)
            still = on | back
            found.append(self.settle(i[~still], q[~still], after[~still], before[~still]))
            i, q = i[still], q[still]
            inside = self.owner(i) == self.owner(i + q)  # a pair across two documents can't make a run
            pending.append(np.stack([i[inside], q[inside]]))
            held += pending[-1].shape[1]
            if held >= PENDING:
                index = index or self.indexes()
                found = [least_periods(np.concatenate([*found, self.extend(pending, index)]))]
                pending, held = [], 0
        if held and index:
            found.append(self.extend(pending, index))
        elif held:
            found.append(self.open_documents(pending))
        return least_periods(np.concatenate(found))

    def indexes(self) -> tuple[CoverIndex, CoverIndex]:
        return CoverIndex(self.codes), CoverIndex(self.back)

    def extend(self, pending: list[np.ndarray], index: tuple[CoverIndex, CoverIndex]) -> np.ndarray:
        i, q = np.concatenate(pending, axis=1)
        after = index[0].extension(i, i + q)
        before = index[1].extension(len(self.codes) - i, len(self.codes) - i - q)
        return self.settle(i, q, after, before)

    def open_documents(self, pending: list[np.ndarray]) -> np.ndarray:
        """The open pairs on an index of their documents alone."""
        i, q = np.concatenate(pending, axis=1)
        owner = self.owner(i)
        needed, place = np.unique(owner, return_inverse=True)
        part = Block([self.docs[k] for k in needed], self.numbers[needed])
        return part.extend([np.stack([i - self.starts[owner] + part.starts[place], q])], part.indexes())


def least_periods(runs: np.ndarray) -> np.ndarray:
    """Each stretch once, with its smallest period, by document, start and period.

    A stretch found by a multiple of its period has the same bounds.
    """
    runs = runs[np.lexsort(runs[:, [3, 2, 1, 0]].T)]
    if len(runs):
        first = np.ones(len(runs), bool)
        first[1:] = (runs[1:, :3] != runs[:-1, :3]).any(1)
        runs = runs[first]
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


def find_runs(docs: list[list[bytes]]) -> list[np.ndarray]:
    """For each list of words its runs as rows (start, length, period)."""
    table: dict[bytes, int] = defaultdict()
    table.default_factory = table.__len__
    codes = [np.fromiter(map(table.__getitem__, d), np.int64, len(d)) for d in docs]
    order = sorted(range(len(docs)), key=lambda k: -len(docs[k]))
    rows = Block([codes[k] for k in order], np.array(order, np.int64)).runs() if docs else np.zeros((0, 4), np.int64)
    return [part[:, 1:] for part in np.split(rows, np.searchsorted(rows[:, 0], np.arange(1, len(docs))))] if docs else []


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those that a run holds after its first round, one blank apart."""
    if not len(runs):
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return b" ".join(words[k] for k in np.flatnonzero(np.cumsum(edges[:-1]) == 0))


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = wd.text_bytes(batch.column("text"))
        raw = memoryview(data)
        for a, b in wd.row_blocks(offsets):
            docs = [bytes(raw[x:y]).split() for x, y in zip(offsets[a:b].tolist(), offsets[a + 1 : b + 1].tolist(), strict=True)]
            runs = find_runs(docs)
            flat = np.concatenate(runs)
            lists = pa.ListArray.from_arrays(
                np.cumsum([0, *map(len, runs)]).astype(np.int32),
                pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=[pa.field(f.name, pa.int64(), False) for f in RUN.fields]))
            text = pa.array([collapsed(d, r).decode() for d, r in zip(docs, runs, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id")[a:b], pa.array([len(d) for d in docs], pa.int64()), lists, text],
                                             ["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and the collapsed text of every row.

    Words are what blanks and the characters \\x09-\\x0D leave; their numbers
    begin at 0. Null, empty and blank texts have no words, no runs and an empty
    collapsed text. Rows are judged one by one: ids may be null or repeated,
    further columns are left out. A stretch with several periods is one run of the
    smallest. A long text is held whole, with about 100 bytes a word;
    short ones share blocks of 1 MB. One pass, no exchange.
    """
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(RUN, False)), T.StructField("collapsed", T.StringType())])
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(scan, schema)


def strongest(runs: Column) -> Column:
    """The run of the greatest exact length / period, the first of equals; null without runs."""
    def better(best: Column, run: Column) -> Column:
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast(RUN), better)


def with_rounds(docs: DataFrame) -> DataFrame:
    """Texts of a tenth of the ids, repeated from one of their words on: known runs beside those of the corpus."""
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = F.coalesce(hashed % 10 == 0, F.lit(False))
    words = F.when(chosen, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    out = docs.select("doc_id", "text", words.alias("_words"), F.floor(hashed / 10).alias("_g"))
    n = F.nullif(F.size("_words"), F.lit(0))
    out = out.withColumn("_a", F.col("_g") % n)
    out = out.withColumn("_p", 1 + F.floor((n - F.col("_a")) / (3 + F.col("_g") % 8)))
    repeated = F.transform("_words", lambda w, i: F.when(i < F.col("_a"), w).otherwise(
        F.get("_words", (F.col("_a") + (i - F.col("_a")) % F.col("_p")).cast("int"))))
    return out.select("doc_id", F.when(F.col("_a").isNotNull(), F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """The numbers of the strongest run, and digests of all runs and of the collapsed text."""
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    best = found.withColumn("_best", strongest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[F.col(f"_best.{k}").alias(k) for k in ("start", "length", "period")],
        F.floor(1000 * F.col("_best.length") / F.col("_best.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


ORACLE = r"""
WITH hashed AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         xor(4294967295::UBIGINT, list_reduce(
           list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
           lambda h, b: list_reduce(list_prepend(xor(h, b), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
             lambda x, z: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))))::BIGINT AS h
  FROM documents),
drawn AS (SELECT k, doc_id, words, len(words) AS n, h % 10 = 0 AND len(words) > 0 AS chosen, h // 10 AS g FROM hashed),
placed AS (SELECT *, CASE WHEN chosen THEN g % n END AS a FROM drawn),
rounds AS (SELECT *, CASE WHEN chosen THEN 1 + (n - a) // (3 + g % 8) END AS p FROM placed),
numbered AS (SELECT k, n, chosen, a, p, words, unnest(range(n)) AS i FROM rounds),
tokens AS (SELECT k, n, i, words[1 + CASE WHEN chosen AND i >= a THEN a + (i - a) % p ELSE i END] AS w FROM numbered),
pairs AS (
  SELECT x.k, x.i, y.i - x.i AS q FROM tokens x JOIN tokens y ON x.k = y.k AND x.w = y.w AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (SELECT k, q, i, i - row_number() OVER (PARTITION BY k, q ORDER BY i) AS island FROM pairs),
stretches AS (
  SELECT k, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY k, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT k, start, length, min(q) AS period FROM stretches GROUP BY k, start, length),
lists AS (SELECT k, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
          FROM runs GROUP BY k),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY k ORDER BY length::DOUBLE / period DESC, start, period) = 1),
gone AS (SELECT DISTINCT k, unnest(range(start + period, start + length)) AS i FROM runs),
left_over AS (
  SELECT k, string_agg(w, ' ' ORDER BY i) AS text FROM tokens ANTI JOIN gone USING (k, i) GROUP BY k)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
       (1000 * length // period)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM hashed LEFT JOIN lists USING (k) LEFT JOIN best USING (k) LEFT JOIN left_over USING (k)
"""
