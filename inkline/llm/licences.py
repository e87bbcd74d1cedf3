"""Licence scan: a trained paragraph classifier, confirmed against templates.

Paragraphs are lines; longer ones are read in overlapping windows. Features are
hashed words and word pairs. A multinomial logistic regression over the licence
families and an unknown class is trained on the templates, on pieces of them
with words left out and with strange words around, and on a bounded sample of
the corpus's own lines as unknown ones (those that resemble a template left out).
Its temperature is calibrated on examples that training didn't see. A window that
is probably not unknown is compared with the templates of all families, as it may
name several and the classifier's probability then goes to few of them. A family is
confirmed where enough of the window's three-word sequences, or of a template's, are
shared and no other family's template explains them better; each confirmed family
is a span of its own. A window without any is reported once, as unconfirmed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as wd
from .sample import first_by_hash

# Notices of public licences.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0"),
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the MIT License - see the LICENSE file for details.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT"),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
        "SPDX-License-Identifier: GPL-3.0-or-later"),
    "LGPL": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "Licensed under the GNU Lesser General Public License, version 3."),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Released under the BSD 3-Clause License.", "Licensed under the BSD 2-Clause License.", "SPDX-License-Identifier: BSD-3-Clause"),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, version 2.0."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Released under the ISC License."),
    "CC-BY": (
        "Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Text is available under the Creative Commons Attribution License 4.0"),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply."),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC-SA 4.0."),
    "CC0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "This work is dedicated to the public domain under CC0 1.0 Universal.", "This is free and unencumbered software released into the public domain."),
    "Proprietary": (
        "All rights reserved.", "Copyright (c) 2024 Example Corp. All rights reserved.",
        "No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher.",
        "This document is confidential and proprietary."),
}
# SPDX identifiers and their families.
SPDX = {
    "Apache-2.0": "Apache-2.0", "MIT": "MIT", "GPL-2.0": "GPL", "GPL-2.0-only": "GPL", "GPL-2.0-or-later": "GPL", "GPL-2.0+": "GPL", "GPL-3.0": "GPL",
    "GPL-3.0-only": "GPL", "GPL-3.0-or-later": "GPL", "LGPL-2.1": "LGPL", "LGPL-2.1-only": "LGPL", "LGPL-2.1-or-later": "LGPL", "LGPL-3.0": "LGPL",
    "LGPL-3.0-only": "LGPL", "LGPL-3.0-or-later": "LGPL", "BSD-2-Clause": "BSD", "BSD-3-Clause": "BSD", "MPL-2.0": "MPL-2.0", "ISC": "ISC",
    "CC-BY-4.0": "CC-BY", "CC-BY-SA-4.0": "CC-BY-SA", "CC-BY-NC-4.0": "CC-BY-NC", "CC-BY-NC-SA-4.0": "CC-BY-NC", "CC0-1.0": "CC0", "Unlicense": "CC0"}
SPDX_TAG, SPDX_JOINS, SPDX_WITH = "SPDX-License-Identifier:", ("AND", "OR"), "WITH"
UNKNOWN = "unknown"
BUCKETS = 1 << 15
WINDOW, STRIDE = 48, 24
MAX_UNKNOWN = 3000  # lines of the corpus that training may see
MIN_PROBABILITY, MIN_SHARED, GRAM = 0.5, 0.6, 3
SHORT_TEMPLATE, MIN_OF_WINDOW = 8, 1 / 6  # a single sequence shared with a template of fewer ones must be so much of the window
IS_MARK = np.zeros(256, bool)
IS_MARK[list(b".,;:")] = True
SPAN = "array<struct<first_word:int,n_words:int,family:string,probability:double,shared:double,confirmed:boolean>>"


def features(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word and of the pair it makes with the next."""
    pair = np.zeros(len(words), np.uint64)
    pair[:-1] = wd.mix(words[:-1] * np.uint64(wd.STEP[1]) + words[1:] * np.uint64(wd.STEP[2]))
    return (words % np.uint64(BUCKETS)).astype(np.int64), (pair % np.uint64(BUCKETS)).astype(np.int64)


def bare(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The text with a blank for the mark that ends a word, as a licence's name may end a sentence or stand inside one; word numbers stay."""
    blank = wd.IS_SPACE[data]
    ends, begins = np.ones(len(data) + 1, bool), np.ones(len(data) + 1, bool)
    ends[1 : len(data)], begins[1 : len(data)] = blank[1:], blank[:-1]
    ends[offsets] = begins[offsets] = True
    return np.where(IS_MARK[data] & ends[1:] & ~begins[:-1], np.uint8(32), data)


def hashed(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    at = np.array([0, len(raw)])
    return wd.word_hashes(bare(raw, at), at)[0]


def grams(words: np.ndarray) -> np.ndarray:
    return np.unique(wd.shingles(words, np.array([len(words)]), GRAM)[0]) if len(words) else words


def shared_part(mine: np.ndarray, families: dict[str, list[np.ndarray]], family: str) -> float:
    """The largest share of the smaller side's three-word sequences that a template of the family has in common with the window."""
    return max((len(np.intersect1d(mine, t, assume_unique=True)) / min(len(mine), len(t)) for t in families[family] if len(t) and len(mine)), default=0.0)


def template_grams() -> dict[str, list[np.ndarray]]:
    return {f: [grams(hashed(t)) for t in ts] for f, ts in TEMPLATES.items()}


def spdx_words() -> dict[int, str]:
    """Hashes of what may stand in an SPDX expression, bracketed or not: identifiers to families, AND and OR to "", WITH to its own name."""
    plain = {**SPDX, **dict.fromkeys(SPDX_JOINS, ""), SPDX_WITH: SPDX_WITH}
    return {int(hashed(left + word + right)[0]): value for word, value in plain.items() for left in ("", "(", "((") for right in ("", ")", "))")}


def spdx_families(words: np.ndarray, tag: int, known: dict[int, str]) -> set[str]:
    """Families that SPDX expressions behind a tag in the window name; an expression ends with the first other word."""
    out: set[str] = set()
    for at in np.flatnonzero(words == np.uint64(tag)):
        k = at + 1
        while k < len(words) and (value := known.get(int(words[k]))) is not None:
            if value == SPDX_WITH:
                k += 1  # the exception's name
            elif value:
                out.add(value)
            k += 1
    return out


def confirmed(mine: np.ndarray, families: dict[str, list[np.ndarray]], probability: dict[str, float]) -> dict[str, float]:
    """Families with a template that shares enough with the window, and how much.

    A template is passed over if what it shares is part of what another family's
    matching template shares (the Lesser GPL's line holds sequences of the GPL's), or
    the same and the other family is more probable. Beside the most probable family
    others need two shared sequences, as many notices hold a phrase like "all rights reserved"; and a single
    one confirms a short template only where it is a sixth of the window.
    """
    first = max(probability, key=probability.__getitem__)
    found = []
    for f, templates in families.items():
        for t in templates:
            common = np.intersect1d(mine, t, assume_unique=True)
            enough = len(common) >= (1 if f == first else 2) and len(common) / min(len(mine), len(t)) >= MIN_SHARED
            if enough and (len(common) > 1 or len(t) >= SHORT_TEMPLATE or len(common) / len(mine) >= MIN_OF_WINDOW):
                found.append((f, common, len(common) / min(len(mine), len(t))))
    out: dict[str, float] = {}
    for f, common, share in found:
        rank = (len(common), probability[f])
        if not any(g != f and (len(other), probability[g]) > rank and np.isin(common, other).all() for g, other, _ in found):
            out[f] = max(share, out.get(f, 0.0))
    return out


def vector(words: np.ndarray) -> np.ndarray:
    """All buckets of a window; the last word has no pair inside it."""
    a, b = features(words)
    return np.concatenate((a, b[:-1]))


def examples(lines: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """Buckets and class numbers: varied templates, and the corpus's lines as class 0."""
    rng = np.random.default_rng(5)
    strange = [w for t in lines for w in t.split()][:20_000] or ["lorem", "ipsum"]
    known, xs, ys = template_grams(), [], []
    for text in lines:
        h = hashed(text)[:WINDOW]
        if len(h) and all(shared_part(grams(h), known, f) < MIN_SHARED / 2 for f in TEMPLATES):
            xs.append(vector(h))
            ys.append(0)
    for y, texts in enumerate(TEMPLATES.values(), 1):
        for k in range(240):
            words = texts[k % len(texts)].split()
            if k % 3:  # a third stay as they are
                words = [w for w in words if rng.random() > 0.08] or words
                if len(words) > 14 and rng.random() < 0.5:
                    at = int(rng.integers(0, len(words) - 10))
                    words = words[at : at + int(rng.integers(10, len(words) - at + 1))]
                around = rng.integers(0, len(strange), int(rng.integers(0, 8)))
                words = [strange[i] for i in around[::2]] + words + [strange[i] for i in around[1::2]]
            xs.append(vector(hashed(" ".join(words))[:WINDOW]))
            ys.append(y)
    return xs, np.array(ys)


def train(lines: list[str]) -> dict[str, np.ndarray]:
    """Weights, offsets and temperature. Full-batch gradient steps with a penalty on the weights' squares; a fifth is kept for calibration."""
    xs, y = examples(lines)
    held = np.random.default_rng(9).random(len(xs)) < 0.2
    classes = len(TEMPLATES) + 1
    used, at = np.unique(np.concatenate([xs[i] for i in np.flatnonzero(~held)]), return_inverse=True)
    size = np.array([len(x) for x in xs])
    row = np.repeat(np.arange((~held).sum()), size[~held])
    value = np.repeat(1 / np.sqrt(size[~held]), size[~held])
    w, b = np.zeros((len(used), classes)), np.zeros(classes)
    target = np.eye(classes)[y[~held]]
    balance = (len(target) / (classes * np.maximum(target.sum(axis=0), 1)))[y[~held]][:, None] ** 0.5
    square_w, square_b = np.full_like(w, 1e-8), np.full_like(b, 1e-8)
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    for _ in range(200):
        z = np.add.reduceat(w[at] * value[:, None], starts) + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        error = (p / p.sum(axis=1, keepdims=True) - target) * balance / len(target)
        grad = np.stack([np.bincount(at, error[row, c] * value, len(used)) for c in range(classes)], axis=1) + 1e-6 * w
        square_w += grad**2
        square_b += error.sum(axis=0) ** 2
        w -= 0.3 * grad / np.sqrt(square_w)
        b -= 0.3 * error.sum(axis=0) / np.sqrt(square_b)
    weights = np.zeros((BUCKETS, classes), np.float32)
    weights[used] = w
    z = np.array([weights[xs[i]].sum(axis=0) / np.sqrt(size[i]) for i in np.flatnonzero(held)]) + b
    def loss(t: float) -> float:
        s = z / t
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(s)), y[held]]).mean())
    temperature = min(np.geomspace(0.1, 4, 40), key=loss)
    return {"weights": weights, "offsets": b.astype(np.float32), "temperature": np.float32(temperature)}


def sample_lines(docs: DataFrame, most: int = MAX_UNKNOWN) -> list[str]:
    """Lines of the documents that come first in md5 order, at most ``most`` documents with one line and 400 characters each."""
    head = docs.select("doc_id", F.substring(F.element_at(F.split(F.coalesce("text", F.lit("")), "\n"), -1), 1, 400).alias("a"),
                       F.substring(F.element_at(F.split(F.coalesce("text", F.lit("")), "\n"), 1), 1, 400).alias("b"))
    rows = first_by_hash(head, F.col("doc_id"), most // 2, docs.count()).collect()
    return [x for r in rows for x in (r["a"], r["b"]) if x]


def line_offsets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of all lines of the rows, and each line's row."""
    breaks = np.flatnonzero(data == 10) + 1
    at = np.unique(np.concatenate((offsets, breaks)))
    return at, np.searchsorted(offsets, at[:-1], side="right") - 1


def scan(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(doc_id, text) to (doc_id, spans)."""
        m, known, names = model.value, template_grams(), [UNKNOWN, *TEMPLATES]
        tag, identifiers = int(hashed(SPDX_TAG)[0]), spdx_words()
        for batch in batches:
            data, offsets = wd.text_bytes(batch.column(1))
            for i, j in wd.row_blocks(offsets, wd.BLOCK_BYTES // 2):
                block, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                spans: list[list[dict]] = [[] for _ in range(j - i)]
                lines, row = line_offsets(block, at)
                words, counts = wd.word_hashes(bare(block, lines), lines)
                if len(words):
                    a, b = features(words)
                    starts = np.cumsum(counts) - counts
                    upto_a, upto_b = (np.concatenate((np.zeros((1, len(names))), np.cumsum(m["weights"][x], axis=0, dtype=np.float64))) for x in (a, b))
                    pieces = np.where(counts > 0, 1 + np.maximum(0, -(-(counts - WINDOW) // STRIDE)), 0)
                    line = np.repeat(np.arange(len(counts)), pieces)
                    nth = np.arange(len(line)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                    first = starts[line] + nth * STRIDE
                    last = np.minimum(first + WINDOW, starts[line] + counts[line])
                    n = last - first
                    z = upto_a[last] - upto_a[first] + upto_b[last - 1] - upto_b[first]
                    z = (z / np.sqrt(2 * n - 1)[:, None] + m["offsets"]) / m["temperature"]
                    p = np.exp(z - z.max(axis=1, keepdims=True))
                    p /= p.sum(axis=1, keepdims=True)
                    best = 1 + p[:, 1:].argmax(axis=1)
                    begins = np.concatenate((starts, [len(words)]))[np.searchsorted(row, np.arange(j - i))]  # first words of the rows' first lines
                    for k in np.flatnonzero(1 - p[:, 0] >= MIN_PROBABILITY).tolist():
                        mine, r = grams(words[first[k] : last[k]]), int(row[line[k]])
                        sure = confirmed(mine, known, dict(zip(names[1:], p[k, 1:].tolist(), strict=True)))
                        sure |= dict.fromkeys(spdx_families(words[first[k] : last[k]], tag, identifiers), 1.0)
                        guess = names[best[k]]
                        for family, shared in (sure or {guess: shared_part(mine, known, guess)}).items():
                            spans[r].append({"first_word": int(first[k] - begins[r]), "n_words": int(n[k]), "family": family,
                                             "probability": float(p[k, names.index(family)]), "shared": shared, "confirmed": family in sure})
                kind = pa.list_(pa.struct([("first_word", pa.int32()), ("n_words", pa.int32()), ("family", pa.string()), ("probability", pa.float64()),
                                           ("shared", pa.float64()), ("confirmed", pa.bool_())]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(spans, kind)], names=["doc_id", "spans"])

    return run


def scan_licences(docs: DataFrame, lines: list[str] | None = None) -> DataFrame:
    """(doc_id, spans): the windows of each text that the classifier takes for a licence.

    Null and empty texts have no spans, repeated rows the same ones; other
    columns are ignored. ``lines`` replaces the sample of unknown lines; with none
    at all the templates alone are learned. A sequence shorter than three words counts as one. A long line is read
    whole, in windows. Of equally probable families the first in TEMPLATES is the guess; of equally good
    templates each family is reported. ``first_word`` counts a text's words from 0. SPDX expressions confirm each identifier they hold.
    """
    lines = sample_lines(docs) if lines is None else lines
    model = docs.sparkSession.sparkContext.broadcast(train(lines))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(scan(model), f"doc_id long, spans {SPAN}")


def summary(scanned: DataFrame) -> DataFrame:
    """Per document: its confirmed families in order of name, how many spans were confirmed and how many not."""
    sure = F.filter("spans", lambda s: s["confirmed"])
    return scanned.select("doc_id", F.array_join(F.array_sort(F.array_distinct(F.transform(sure, lambda s: s["family"]))), ",").alias("licences"),
                          F.size(sure).cast("long").alias("n_confirmed"), (F.size("spans") - F.size(sure)).cast("long").alias("n_unconfirmed"))
