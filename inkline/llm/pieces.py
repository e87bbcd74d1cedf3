"""SentencePiece encoding and decoding for merge-type vocabularies.

Encoding starts from single characters and keeps an agenda of adjacent symbol
pairs that form a piece; the pair of the highest score is merged first, the
leftmost of equals, until no pair is left. Characters without a piece become
byte pieces.

No piece holds the blank mark after another character, and no piece holds a
line break, so merging never crosses those places: a text is cut there into
units, and equal units are encoded once. Units that a task hasn't met are
encoded together, their agendas as rows of one matrix; long ones have a heap of
their own. Each new unit's ids and decoded form are compared with the
sentencepiece library's, a batch at a time; a difference is an error.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as wd

BLANK = "▁"
ROW_CHARS = 32  # longer units use the heap
TOGETHER = 64  # units in one text of the comparison
UNITS_KEPT = 400_000  # units a worker remembers before it starts afresh
NONE = np.int32(2**31 - 1)
PAD = np.int32(-0x110001)


class Vocabulary:
    """Pieces, scores and the table of symbol pairs that form a piece."""

    def __init__(self, model: bytes):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(size)]
        if any(sp.is_unused(i) for i in range(size)):
            raise ValueError("vocabularies with unused pieces aren't supported")
        self.byte = {int(names[i][3:5], 16): i for i in range(size) if sp.is_byte(i)}
        plain = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        self.unknown = sp.unk_id()
        symbols = {names[i]: i for i in plain}
        inner = {c for i in plain if len(names[i]) > 1 for c in names[i]}
        for c in sorted(inner - symbols.keys()):  # can be merged although they're no piece themselves
            symbols[c] = len(names)
            names.append(c)
        self.pieces = size
        self.score = np.full(len(names), -np.inf, np.float32)
        self.score[plain] = [sp.get_score(i) for i in plain]
        self.output = [b"" if i < size and (sp.is_control(i)) else n.replace(BLANK, " ").encode() for i, n in enumerate(names)]
        for value, i in self.byte.items():
            self.output[i] = bytes([value])
        self.output[self.unknown] = " ⁇ ".encode()
        self.is_byte = frozenset(self.byte.values())
        self.symbol = np.arange(-1, -0x110001, -1, dtype=np.int32)  # a character without a piece is -1 - code point
        for n, i in symbols.items():
            if len(n) == 1:
                self.symbol[ord(n)] = i
        pairs = {}
        for i in plain:
            for k in range(1, len(names[i])):
                left, right = symbols.get(names[i][:k]), symbols.get(names[i][k:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = i
        self.pairs = pairs
        self._table(pairs)
        apart = all(BLANK not in names[i].lstrip(BLANK) for i in plain)
        ends = "".join(c for c in "\n\t" if c not in inner)
        self.unit = re.compile(f"{BLANK}*[^{BLANK}{ends}]+|{BLANK}+|[{ends}]" if ends else f"{BLANK}*[^{BLANK}]+|{BLANK}+") if apart else re.compile(r"(?s).+")
        self.simple = apart and ends == "\n\t"
        self.sizes = np.array([len(x) for x in self.output], np.int64)
        self.offsets = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(self.output), np.uint8)
        # the library's own behaviour on a lone letter tells whether a blank is put in front
        self.prefix = BLANK if sp.encode("a", out_type=str)[:1] != ["a"] else ""

    def _table(self, pairs: dict[int, int]) -> None:
        """Open addressing: where a pair's hash points, or soon after, stands the pair."""
        self.width = max(4, (4 * len(pairs)).bit_length())
        slots = (1 << self.width) + len(pairs) + 1  # probing runs on past the hashed slots; the last stays empty
        keys, ranks, values = np.full(slots, -1, np.int64), np.full(slots, NONE, np.int32), np.full(slots, -1, np.int32)
        order = {x: i for i, x in enumerate(sorted({float(self.score[v]) for v in pairs.values()}, reverse=True))}
        at = self._slot(np.fromiter(pairs, np.int64, len(pairs)))
        for (key, value), i in zip(pairs.items(), at.tolist(), strict=True):
            while keys[i] >= 0:
                i += 1
            keys[i], ranks[i], values[i] = key, order[float(self.score[value])], value
        self.keys, self.ranks, self.values = keys, ranks, values

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.width)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The slot of each pair in the table; slot -1, the last, is an empty one."""
        out = np.full(len(left), -1, np.int64)
        ask = np.flatnonzero((left >= 0) & (right >= 0))
        key = left[ask].astype(np.int64) << 32 | right[ask]
        slot = self._slot(key)
        while len(ask):
            there = self.keys[slot]
            hit = there == key
            out[ask[hit]] = slot[hit]
            go = np.flatnonzero(~hit & (there >= 0))
            ask, key, slot = ask[go], key[go], slot[go] + 1
        return out

    def encode_rows(self, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of rows of characters, one agenda per row, and how many each row has in the end.

        A round merges every row's best pair. The agenda holds each pair's
        place in the order of scores, so its smallest entry, the leftmost of
        equals, is the pair to merge. Merging takes one symbol and one pair out of
        the row; a row without pairs is done.
        """
        rows, wide = codes.shape
        done, n = self.symbol[codes], lengths.copy()
        done[np.arange(wide) >= lengths[:, None]] = PAD
        active, symbols = np.arange(rows), done
        agenda = self.ranks[self.find(symbols[:, :-1].ravel(), symbols[:, 1:].ravel())].reshape(rows, wide - 1)
        while wide > 1 and len(active):
            at = agenda.argmin(axis=1)
            row = np.arange(len(active))
            going = agenda[row, at] < NONE
            if not going.all():
                out = active[~going]
                done[out, :wide] = symbols[~going]
                n[out] = (symbols[~going] != PAD).sum(axis=1)
                active, symbols, agenda, at = active[going], symbols[going], agenda[going], at[going]
                row = row[: len(active)]
                if not len(active):
                    break
            symbols[row, at] = self.values[self.find(symbols[row, at], symbols[row, at + 1])]
            stay = np.ones(symbols.shape, bool)
            stay[row, at + 1] = False
            symbols = symbols[stay].reshape(len(active), wide - 1)
            stay = np.ones(agenda.shape, bool)
            stay[row, at] = False
            agenda = agenda[stay].reshape(len(active), wide - 2)
            wide -= 1
            for place in (at - 1, at):
                r = np.flatnonzero((place >= 0) & (place < wide - 1))
                p = place[r]
                agenda[r, p] = self.ranks[self.find(symbols[r, p], symbols[r, p + 1])]
        done[active, :wide] = symbols
        n[active] = (symbols != PAD).sum(axis=1)
        return done, n

    def encode_long(self, unit: str) -> list[int]:
        """Symbols of one unit by a heap of (score, place) entries; entries of changed pairs are passed over."""
        symbol = self.symbol[np.frombuffer(unit.encode("utf-32-le"), np.uint32)].tolist()
        following, before = list(range(1, len(symbol) + 1)), list(range(-1, len(symbol) - 1))
        agenda: list[tuple[float, int, int, int, int]] = []

        def propose(i: int) -> None:
            j = following[i]
            if j < len(symbol) and symbol[i] is not None and symbol[i] >= 0 and symbol[j] >= 0 and (piece := self.pairs.get(symbol[i] << 32 | symbol[j])) is not None:
                heapq.heappush(agenda, (-float(self.score[piece]), i, symbol[i], symbol[j], piece))

        for i in range(len(symbol)):
            propose(i)
        while agenda:
            _, i, left, right, piece = heapq.heappop(agenda)
            j = following[i]
            if symbol[i] != left or j >= len(symbol) or symbol[j] != right:
                continue
            symbol[i], symbol[j] = piece, None
            following[i] = following[j]
            if following[i] < len(symbol):
                before[following[i]] = i
            propose(i)
            if before[i] >= 0:
                propose(before[i])
        return [s for s in symbol if s is not None]

    def ids_of(self, symbols: list[int]) -> list[int]:
        """Symbols to ids: characters that are no piece become byte pieces, or the unknown piece without those."""
        out: list[int] = []
        for s in symbols:
            if 0 <= s < self.pieces:
                out.append(s)
            else:
                c = self.output[s] if s >= 0 else chr(-1 - s).encode()
                out += [self.byte[x] for x in c] if self.byte else [self.unknown]
        return out

    def encode_units(self, units: list[str], check: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units in a row, and each unit's end there; compares them with the library's."""
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        codes = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
        starts = np.cumsum(lengths) - lengths
        special: dict[int, list[int]] = {}
        found, low, n = [], 0, np.zeros(len(units), np.int64)
        for wide in (4, 6, 8, 10, 12, 16, 24, ROW_CHARS):
            rows = np.flatnonzero((lengths > low) & (lengths <= wide))
            low = wide
            for part in np.array_split(rows, len(rows) // 8_000 + 1):
                at = np.minimum(starts[part][:, None] + np.arange(wide), max(0, len(codes) - 1))
                symbols, n[part] = self.encode_rows(codes[at], lengths[part])
                odd = ((symbols >= self.pieces) | ((symbols < 0) & (np.arange(wide) < n[part][:, None]))).any(axis=1)
                special |= {i: self.ids_of(s[:k]) for i, s, k in zip(part[odd].tolist(), symbols[odd].tolist(), n[part[odd]].tolist(), strict=True)}
                found.append((part[~odd], symbols[~odd]))
        special |= {i: self.ids_of(self.encode_long(units[i])) for i in np.flatnonzero(lengths > ROW_CHARS).tolist()}
        for i, ids in special.items():
            n[i] = len(ids)
        ends = np.cumsum(n)
        out = np.zeros(int(n.sum()), np.int32)
        for part, symbols in found:
            inside = np.arange(symbols.shape[1]) < n[part][:, None]
            out[((ends - n)[part][:, None] + np.arange(symbols.shape[1]))[inside]] = symbols[inside]
        for i, ids in special.items():
            out[ends[i] - n[i] : ends[i]] = ids
        if check:
            self.compare(units, out, ends)
        return out, ends

    def compare(self, units: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        """Compares with the library, many units to a text where a line break keeps them apart."""
        if not self.simple:
            theirs, mine = self.library.encode([u[len(self.prefix) :] for u in units], num_threads=1), np.split(ids, ends[:-1])
            wrong = any(x != y.tolist() for x, y in zip(theirs, mine, strict=True))
        else:
            head = self.library.encode("\n")
            texts = ["\n" + "\n".join(units[i : i + TOGETHER]) for i in range(0, len(units), TOGETHER)]
            theirs = np.array([x for t in self.library.encode(texts, num_threads=1) for x in t], np.int32)
            starts = np.concatenate(([0], ends[:-1]))
            wide = len(head) - 1  # the first unit of a text comes after all of head, the others after its last id
            first = np.arange(len(units)) % TOGETHER == 0
            marks = np.array([x for f in first.tolist() for x in (head if f else head[wide:])], np.int32)
            wrong = not np.array_equal(np.insert(ids, np.repeat(starts, np.where(first, len(head), len(head) - wide)), marks), theirs)
        if wrong:
            raise ValueError("an encoded unit differs from the library's")
        if self.decode(ids.tolist()) != self.library.decode(ids.tolist()):
            raise ValueError("a decoded unit differs from the library's")

    def units(self, text: str) -> list[str]:
        if not text:
            return []
        if self.simple and "  " not in text and "\t" not in text and BLANK not in text and text[0] != " ":
            return [u for u in (self.prefix + text.replace(" ", " " + BLANK).replace("\n", " \n ")).split(" ") if u]
        return self.unit.findall(self.prefix + text.replace(" ", BLANK))

    def encode(self, text: str) -> list[int]:
        return self.encode_units(self.units(text), check=False)[0].tolist()

    def decode_rows(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """Texts of the rows of valid ids that end at ``ends``; the blank that encoding put in front is left out."""
        size = self.sizes[ids]
        upto = np.concatenate(([0], np.cumsum(size)))
        raw = self.bytes[np.repeat(self.offsets[ids] - upto[:-1], size) + np.arange(upto[-1])]
        if self.prefix:
            keep = np.ones(len(raw), bool)
            starts = np.concatenate(([0], ends[:-1]))
            keep[upto[starts[starts < ends]]] = False
            raw = raw[keep]
            upto = np.concatenate(([0], np.cumsum(keep)))[upto]
        at = np.concatenate(([0], upto[ends])).astype(np.int32)
        return pa.Array.from_buffers(pa.string(), len(ends), [None, pa.py_buffer(at), pa.py_buffer(raw)])

    def decode(self, ids: list[int]) -> str:
        """Text of any ids: pieces in order, one leading blank less, invalid bytes as U+FFFD each."""
        raw = b"".join([self.output[i] for i in ids])
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            parts, run = [], b""
            for i in [*ids, None]:
                if i in self.is_byte:
                    run += self.output[i]
                    continue
                while run:
                    for k in (4, 3, 2, 1):
                        try:
                            parts.append(run[:k].decode())
                            run = run[k:]
                            break
                        except UnicodeDecodeError:
                            pass
                    else:
                        parts.append("�")
                        run = run[1:]
                if i is not None:
                    parts.append(self.output[i].decode())
            text = "".join(parts)
        return text[1:] if self.prefix and text[:1] == " " and ids and ids[0] not in self.is_byte else text


_loaded: dict[bytes, tuple[Vocabulary, dict]] = {}


def loaded(model: bytes) -> tuple[Vocabulary, dict]:
    """The worker's vocabulary and the units it remembers: unit -> ids as int32 bytes."""
    if model not in _loaded:
        _loaded.clear()
        _loaded[model] = (Vocabulary(model), {})
    return _loaded[model]


def coder(model, check: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(doc_id, text) to (doc_id, ids, decoded)."""
        vocabulary, known = loaded(model.value)
        for batch in batches:
            _, offsets = wd.text_bytes(batch.column(1))
            for i, j in wd.row_blocks(offsets):
                units = [vocabulary.units(t) for t in batch.column(1).slice(i, j - i).to_pylist()]
                if len(known) > UNITS_KEPT:
                    known.clear()
                new = list({u for us in units for u in us if u not in known})
                if new:
                    flat, ends = vocabulary.encode_units(new, check)
                    raw, at = flat.tobytes(), (4 * ends).tolist()
                    known.update(zip(new, [raw[a:b] for a, b in zip([0, *at], at, strict=False)], strict=True))
                ids = [b"".join([known[u] for u in us]) for us in units]
                ends = np.cumsum([len(x) // 4 for x in ids])
                flat = np.frombuffer(b"".join(ids), np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i),
                     pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(flat)),
                     vocabulary.decode_rows(flat, ends)],
                    names=["doc_id", "ids", "decoded"])

    return run


def tokenise(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", check: bool = True) -> DataFrame:
    """(doc_id, ids, decoded) per row: whole text encoded without begin or end ids, and the ids decoded again.

    A null text is an empty one: no ids, an empty decoded text. Ids that are
    null or repeat are passed through, other columns are ignored. The
    model file is read on the driver and sent to the workers, so only the driver needs it.
    """
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(coder(model, check), "doc_id long, ids array<int>, decoded string"))


def digests(tokens: DataFrame) -> DataFrame:
    """Counts and SHA-256 of the ids and of the decoded text."""
    return tokens.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                         F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                         F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
