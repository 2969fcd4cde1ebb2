"""Licence scans: a paragraph classifier over sparse word n-grams, and a comparison with templates.

A softmax regression on hashed one- to three-word grams knows the licence families, reserved rights and an unknown
class. It is trained on the notices and identifiers below, whole, in part and inside other text, against paragraphs of
the corpus and shuffled notices; a temperature fitted on held-out examples calibrates its probabilities. A paragraph
is a run of lines that are not blank; it is read line by line and, for wrapped notices, across its lines, in overlapping
windows of ``WINDOW`` words. The model decides on every window: those left out before it is asked are windows whose
grams can't outweigh the unknown class in any family. Each paragraph that is given a family is compared with the notices
of that family: ``similarity`` is the largest share of a notice's word pairs (or of its only word) that it holds.

Paragraphs that speak of licences or copyright (``TERMS``) and are given no family are reported as ``unknown``, with the
probability of that class at the first such window. Reserved rights grant nothing, so that row is never ``confirmed``.

Edge cases: null and empty texts have no paragraph; very long texts and lines are read whole; repeated rows are
reported each. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chainloom.llm.common import Piece, combine, pieces, words_of

# Short notices as the licences ask for them.
NOTICES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ),
    "BSD": (
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, Version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "All-rights-reserved": ("All rights reserved.", "Copyright holder. All rights reserved."),
}
# Identifiers as they stand in file heads and lists; each is a notice of its family.
IDENTIFIERS: dict[str, tuple[str, ...]] = {
    "Apache-2.0": ("Apache-2.0",),
    "MIT": ("SPDX-License-Identifier: MIT",),
    "GPL-3.0": ("GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "GPLv3", "GPLv3+"),
    "GPL-2.0": ("GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPLv2", "GPLv2+"),
    "LGPL": ("LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later", "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPLv3", "LGPLv3+"),
    "BSD": ("BSD-3-Clause", "BSD-2-Clause"),
    "MPL-2.0": ("MPL-2.0",),
    "CC-BY": ("CC-BY-4.0",),
    "CC-BY-SA": ("CC-BY-SA-4.0",),
    "CC-BY-NC": ("CC-BY-NC-4.0",),
    "Unlicense": ("SPDX-License-Identifier: Unlicense",),
}
NOTICES = {f: n + IDENTIFIERS.get(f, ()) for f, n in NOTICES.items()}
RESERVED, UNKNOWN = "All-rights-reserved", "unknown"
TERMS = (
    "license licence licenses licences licensed licenced licensing licensee licensor sublicense relicensed copyright copyrighted copyleft "
    "spdx-license-identifier eula \u00a9 lizenz lizenziert licencia licenciado urheberrecht"
)
WINDOW, STRIDE, SLOTS = 48, 24, 2**18
FOUND = "doc_id bigint, paragraph bigint, first_word bigint, family string, probability double, similarity double, confirmed boolean"


def _hashes(text: str) -> np.ndarray:
    """Word hashes; punctuation at the ends of words does not count."""
    clean = " ".join(w.strip(".,;:!?\"'()[]") for w in text.split())
    batch = pa.RecordBatch.from_arrays([pa.array([clean], pa.large_string())], names=["text"])
    return words_of(next(pieces(iter([batch])))).hash


_MARKS = np.zeros(256, bool)
_MARKS[list(b".,;:!?\"'()[]")] = True


def _stripped(piece: Piece) -> Piece:
    """The piece with punctuation at word ends turned to blanks (so that words keep their texts)."""
    data = piece.data.copy()
    space = np.isin(data, (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D))
    mark = _MARKS[data]
    for _ in range(3):  # up to three marks in a row
        blank = space | (data == 0x20)
        edge = np.zeros(len(data), bool)
        edge[1:] |= blank[:-1]
        edge[:-1] |= blank[1:]
        data[mark & edge] = 0x20
    return Piece(piece.batch, data, piece.starts)


def _grams(h: np.ndarray) -> np.ndarray:
    return np.concatenate([combine(*(h[i : len(h) - n + 1 + i] for i in range(n))) for n in (1, 2, 3) if len(h) >= n] or [h])


def _slots(h: np.ndarray) -> np.ndarray:
    return np.unique((_grams(h) >> np.uint64(46)).astype(np.int64))


def _pairs(h: np.ndarray) -> np.ndarray:
    return np.unique(combine(h[:-1], h[1:])) if len(h) > 1 else h


@dataclass
class LicenceModel:
    families: list[str]
    weight: np.ndarray  # slots and a row of zeros x classes, the last class is unknown
    bias: np.ndarray
    temperature: float
    evidence: np.ndarray  # of each slot, the most it can add to a family over the unknown class; 0 at least
    terms: np.ndarray  # sorted hashes of TERMS
    notices: list[list[np.ndarray]]  # word pairs of each family's notices

    def probabilities(self, slots: list[np.ndarray], lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Class probabilities of the windows [lo, hi); ``slots`` are those of the grams of 1, 2, .. words from each word on."""
        at = np.minimum(lo[:, None] + np.arange(WINDOW), len(slots[0]) - 1)
        word = np.arange(WINDOW) < (hi - lo)[:, None]
        rows = []
        for n, s in enumerate(slots):
            inside = word if n == 0 else np.pad(word[:, n:], ((0, 0), (0, n)))
            rows.append(np.where(inside, s[np.minimum(at, len(s) - 1)], SLOTS))
        mine = np.sort(np.concatenate(rows, 1), 1)
        mine[:, 1:][mine[:, 1:] == mine[:, :-1]] = SLOTS  # a slot counts once; SLOTS has no weight
        n = np.maximum((mine < SLOTS).sum(1), 1)
        z = (self.weight[mine].sum(1) / np.sqrt(n)[:, None] + self.bias) / self.temperature
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def similarity(self, family: int, h: np.ndarray) -> float:
        mine = np.concatenate([_pairs(h), h])
        return max(float(np.isin(p, mine).mean()) for p in self.notices[family])


def _examples(background: list[np.ndarray], rng: np.random.Generator) -> tuple[list[np.ndarray], np.ndarray]:
    """Word-hash sequences and classes: parts of notices, notices in other text, shuffled ones, other text."""
    xs, ys = [], []
    unknown = len(NOTICES)
    some = [b for b in background if len(b)] or [_hashes("a text without any notice")]
    for y, notices in enumerate(NOTICES.values()):
        for text in notices:
            h = _hashes(text)
            for i in range(24):
                n = len(h) if i % 3 == 0 else int(rng.integers(max(min(3, len(h)), (2 * len(h)) // 3), len(h) + 1))
                at = int(rng.integers(0, len(h) - n + 1))
                part = h[at : at + n]
                if i % 2:
                    around = some[int(rng.integers(len(some)))]
                    part = np.concatenate([around[: int(rng.integers(0, 12))], part, around[12 : int(rng.integers(12, 28))]])
                xs.append(part)
                ys.append(y)
            for _ in range(6 if len(h) > 3 else 0):  # the words alone are no notice
                xs.append(rng.permutation(h))
                ys.append(unknown)
    notice_pairs = np.unique(np.concatenate([_pairs(_hashes(t)) for n in NOTICES.values() for t in n]))
    for b in some:
        if np.isin(_pairs(b), notice_pairs).sum() < 2:  # an unlabelled notice must not teach the unknown class
            xs.append(b)
            ys.append(unknown)
    return xs, np.array(ys)


def fit(background: list[str], *, steps: int = 200, rate: float = 2.0, ridge: float = 1e-3, seed: int = 3) -> LicenceModel:
    rng = np.random.default_rng(seed)
    families = list(NOTICES)
    xs, y = _examples([_hashes(b)[:WINDOW] for b in background], rng)
    slots = [_slots(x) for x in xs]
    used, of = np.unique(np.concatenate(slots), return_inverse=True)
    row = np.repeat(np.arange(len(xs)), [len(s) for s in slots])
    value = 1 / np.sqrt(np.array([max(len(s), 1) for s in slots], float))[row]
    classes = len(families) + 1
    held = np.arange(len(xs)) % 5 == 0
    share = np.bincount(y, minlength=classes)
    cost = (1 / share[y]) * (~held)
    cost /= cost.sum()
    w, b = np.zeros((len(used), classes)), np.zeros(classes)
    target = np.eye(classes)[y]

    def logits():
        z = np.empty((len(xs), classes))
        for c in range(classes):
            z[:, c] = np.bincount(row, w[of, c] * value, len(xs)) + b[c]
        return z

    def soft(z):
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    speed_w, speed_b = np.zeros_like(w), np.zeros_like(b)
    for _ in range(steps):  # gradient steps with momentum
        d = (soft(logits()) - target) * cost[:, None]
        g = np.stack([np.bincount(of, d[row, c] * value, len(used)) for c in range(classes)], 1) + ridge * w * 0.01
        speed_w, speed_b = 0.9 * speed_w - rate * g, 0.9 * speed_b - rate * d.sum(0)
        w, b = w + speed_w, b + speed_b
    z = logits()[held]
    temperature = min(
        (0.1, 0.2, 0.3, 0.5, 0.7, 1.0, 1.5, 2.0),
        key=lambda t: -np.log(soft(z / t)[np.arange(held.sum()), y[held]] + 1e-12).mean(),
    )
    weight = np.zeros((SLOTS + 1, classes), np.float32)
    weight[used] = w
    notices = [[_pairs(_hashes(t)) for t in NOTICES[f]] for f in families]
    evidence = np.maximum(0, (weight[:, :-1] - weight[:, -1:]).max(1))
    return LicenceModel(families, weight, b, temperature, evidence, np.unique(_hashes(TERMS)), notices)


def train(docs: DataFrame, *, rows: int = 1000) -> LicenceModel:
    """Fit on the notices and on a paragraph (48 words at most) of at most ``rows`` documents, those of smallest id hash."""
    first = F.element_at(F.split("text", "\n"), 1)
    picked = docs.where("doc_id is not null and text is not null").select("doc_id", F.xxhash64("doc_id").alias("h"))
    picked = picked.orderBy("h", "doc_id").limit(rows)
    found = docs.select("doc_id", "text").join(F.broadcast(picked.select("doc_id")), "doc_id")
    texts = found.select(F.array_join(F.slice(F.split(first, " "), 1, WINDOW), " ")).collect()
    return fit(sorted(r[0] for r in texts if r[0]))


def _found(model: LicenceModel, piece: Piece, ids: list, least: float, similar: float) -> list[tuple]:
    words = words_of(_stripped(piece))
    h = words.hash
    if not len(h):
        return []
    # sums up to each word of what its grams can add to a family at most, and of the terms
    most, slots = np.zeros(len(h) + 1), []
    for n in range(1, min(3, len(h)) + 1):
        grams = combine(*(h[i : len(h) - n + 1 + i] for i in range(n)))
        slots.append((grams >> np.uint64(46)).astype(np.int32))
        most[1 : len(h) - n + 2] += model.evidence[slots[-1]]
    most = np.cumsum(most)
    at = np.minimum(np.searchsorted(model.terms, h), len(model.terms) - 1)
    terms = np.append(0, np.cumsum(model.terms[at] == h))
    need = float(model.bias[-1] - model.bias[:-1].max())  # a window has one slot at least

    newlines = np.flatnonzero(piece.data == 0x0A)
    line = np.searchsorted(newlines, words.begin)
    doc = words.doc()
    new_line = np.append(True, line[1:] != line[:-1])
    # a line without words parts paragraphs if it is blank, not if it is of punctuation only
    blank = np.append(0, np.cumsum(np.diff(np.append(-1, newlines)) - 1 == _spaces(piece, newlines)))
    new_par = np.append(True, (doc[1:] != doc[:-1]) | (blank[line[1:]] > blank[line[:-1] + 1]))
    new_line |= new_par
    par_start = np.flatnonzero(new_par)
    par_end = np.append(par_start[1:], len(h))
    line_start = np.flatnonzero(new_line)
    line_end = np.append(line_start[1:], len(h))
    par_doc = doc[par_start]
    number = np.arange(len(par_start)) - np.searchsorted(par_doc, par_doc)
    # lines, and paragraphs of several lines
    wide = np.searchsorted(line_start, par_end) - np.searchsorted(line_start, par_start) > 1
    start, stop = np.append(line_start, par_start[wide]), np.append(line_end, par_end[wide])
    count = np.maximum(1, -(-(stop - start - WINDOW + STRIDE) // STRIDE))
    lo = np.repeat(start, count) + STRIDE * (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
    hi = np.minimum(np.repeat(stop, count), lo + WINDOW)
    some = np.flatnonzero((most[hi] - most[lo] > need) | (terms[hi] > terms[lo]))
    lo, hi = lo[some], hi[some]
    best: dict[tuple, tuple] = {}
    unknown: dict[int, tuple] = {}
    for i in range(0, len(lo), 1000):
        a, z = lo[i : i + 1000], hi[i : i + 1000]
        p = model.probabilities(slots, a, z)
        c = p.argmax(1)
        named = (c < len(model.families)) & (p.max(1) >= least)
        par = np.searchsorted(par_start, a, "right") - 1
        for w in np.flatnonzero(named | (terms[z] > terms[a])).tolist():
            k, back = int(par[w]), int(par_start[par[w]] - a[w])
            if named[w]:
                row = (float(p[w, c[w]]), model.similarity(c[w], h[a[w] : z[w]]), back)
                best[k, int(c[w])] = max(best.get((k, int(c[w])), row), row)
            else:
                row = (back, float(p[w, -1]))
                unknown[k] = max(unknown.get(k, row), row)
    known = {k for k, _ in best}
    out = [(k, c, *row) for (k, c), row in best.items()]
    out += [(k, len(model.families), q, 0.0, back) for k, (back, q) in unknown.items() if k not in known]
    names = [*model.families, UNKNOWN]
    return [
        (ids[par_doc[k]], int(number[k]), -back, names[c], p, s, s >= similar and names[c] not in (RESERVED, UNKNOWN))
        for k, c, p, s, back in sorted(out)
    ]


def _spaces(piece: Piece, newlines: np.ndarray) -> np.ndarray:
    """Number of white-space bytes of each line, without its newline."""
    space = np.append(0, np.cumsum(np.isin(piece.data, (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D))))
    return space[newlines] - space[np.append(0, newlines[:-1] + 1)]


def scan(docs: DataFrame, model: LicenceModel, *, least: float = 0.5, similar: float = 0.7) -> DataFrame:
    """One row per paragraph and licence family (or ``unknown``) found in it: probability, similarity, confirmed."""
    names = [c.split()[0] for c in FOUND.split(", ")]
    types = {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_()}
    kinds = [types[c.split()[1]] for c in FOUND.split(", ")]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            rows = _found(shared.value, piece, piece.batch.column(0).to_pylist(), least, similar)
            if rows:
                cols = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, FOUND)
