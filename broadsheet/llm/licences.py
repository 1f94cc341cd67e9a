"""Licence scan: a trained paragraph classifier, an unknown class with a calibrated bound, and a comparison with templates.

Paragraphs and their lines are cut into windows of words. A window is the set of its word n-grams (one and two words), hashed; a
sparse multinomial logistic regression gives the probability of each licence family and of ordinary text. It is trained on
notices of the families in changed surroundings and on a bounded sample of lines of the corpus. On a held-out part its
probabilities are calibrated by a temperature, and a bound is set below which a notice is reported as unknown. A predicted
family is confirmed when the window holds most of one of its templates' n-grams.
"""

from __future__ import annotations

import functools
import random
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import combine, doc_words, table, text_bytes, texts
from .queries import query

#: Dimensions of the hashed n-grams.
DIMENSIONS = 1 << 16
#: Words of a window and how far the next one starts.
WINDOW, STEP = 32, 16
#: Documents whose lines teach what ordinary text looks like, and how many of their lines are used.
SAMPLE_DOCS, SAMPLE_LINES = 2000, 6000
#: Changed copies of each notice in the training set.
COPIES = 30
EPOCHS = 12
#: Share of a template's two-word n-grams that a window must hold to confirm a family.
CONFIRMED = 0.6
#: Precision on the held-out part that sets the bound of the unknown class.
PRECISION = 0.99

# Notices of licence families.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.", "Licensed under the MIT license.", "This project is distributed under the terms of the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS.", "SPDX-License-Identifier: Apache-2.0",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "Released under the GNU GPL v3 or later.", "Licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "LGPL": ["This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License.", "Licensed under the GNU Lesser General Public License, version 2.1.", "SPDX-License-Identifier: LGPL-2.1-only"],
    "AGPL": ["Licensed under the GNU Affero General Public License, version 3.", "This program is distributed under the terms of the GNU Affero General Public License.", "SPDX-License-Identifier: AGPL-3.0-only"],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.", "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.", "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0"],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Available under CC BY-NC-SA 4.0."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "Text is available under the Creative Commons Attribution-ShareAlike License."],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "Public-Domain": ["This work is dedicated to the public domain under CC0 1.0.", "This is free and unencumbered software released into the public domain.", "No rights reserved."],
    "Proprietary": ["All rights reserved.", "Copyright 2020 by the authors. All rights reserved.", "No part of this publication may be reproduced without the prior written permission of the publisher.", "This document is proprietary and confidential."],
}
# Notices that name no family above; they teach the unknown class.
UNKNOWN = [
    "Licensed under the Example Community License.", "Use of this software is subject to the terms of the license agreement.", "Released under a custom license, see LICENSE for details.", "Distributed under the terms of the vendor licence, version 1.",
]
NONE, OTHER = "none", "unknown"
CLASSES = [NONE, OTHER, *TEMPLATES]


def _features(words: np.ndarray) -> np.ndarray:
    """Hashed one- and two-word n-grams of a window."""
    pairs = combine([words[:-1], words[1:]]) if len(words) > 1 else words[:0]
    return np.unique((np.concatenate([words, pairs]) % np.uint64(DIMENSIONS)).astype(np.int64))


_PUNCTUATION = bytes(b if chr(b).isalnum() or b > 127 else 32 for b in range(256))


def _words(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of each line's words and the words' fingerprints, without case and punctuation."""
    offsets, (words,) = doc_words([x.translate(_PUNCTUATION) for x in lines], lower=True)
    return offsets, words


def _windows(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Line, start and end of the windows of each line with words; a short line is one window."""
    sizes = np.diff(offsets)
    n = np.where(sizes > 0, 1 + np.maximum(0, -(-(sizes - WINDOW) // STEP)), 0)
    line = np.repeat(np.arange(len(sizes)), n)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start = offsets[line] + k * STEP
    return line, start, np.minimum(start + WINDOW, offsets[line + 1])


@functools.lru_cache(maxsize=1)
def _template_pairs() -> list[tuple[int, np.ndarray]]:
    """The two-word n-grams of every template with the number of its family."""
    out = []
    for family, notices in TEMPLATES.items():
        for notice in notices:
            _, words = _words([notice.encode()])
            out.append((CLASSES.index(family), np.unique(combine([words[:-1], words[1:]]))))
    return out


def similarity(words: np.ndarray, family: int | None = None) -> float:
    """The largest share of a template's two-word n-grams that a window holds, over all families or one."""
    return _nearest(words, family)[0]


def _nearest(words: np.ndarray, family: int | None = None) -> tuple[float, int, int]:
    """The largest share of a template's two-word n-grams that a window holds, and the words from its first to its last one."""
    if len(words) < 2:
        return 0.0, 0, len(words)
    placed = combine([words[:-1], words[1:]])
    pairs = np.unique(placed)
    shares = [(len(np.intersect1d(pairs, own, assume_unique=True)) / len(own), len(own), k) for k, (f, own) in enumerate(_template_pairs()) if family is None or f == family]
    if not shares:
        return 0.0, 0, len(words)
    held, _, k = max(shares)
    at = np.flatnonzero(np.isin(placed, _template_pairs()[k][1]))
    near = np.diff(at) <= 3  # a common pair far from the others is no part of the notice
    near = at[np.append(near, False) | np.append(False, near)] if len(at) > 1 else at
    at = near if len(near) else at
    return held, *((int(at[0]), int(at[-1]) + 2) if len(at) else (0, len(words)))


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # float32, one row per hashed n-gram and a last row of constants
    temperature: float
    bound: float

    def hopeful(self, words: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Windows that may be more like some notice than like ordinary text. Every place adds what its n-gram could add for
        the best class, so the sum is a bound and no notice is missed."""
        gain = np.maximum(self.weights[:, 1:].max(axis=1) - self.weights[:, 0], 0)
        run = np.zeros(len(words) + 1)
        np.cumsum(gain[(words % np.uint64(DIMENSIONS)).astype(np.int64)], out=run[1:])
        total = run[end] - run[start]
        if len(words) > 1:
            np.cumsum(gain[(combine([words[:-1], words[1:]]) % np.uint64(DIMENSIONS)).astype(np.int64)], out=run[1 : len(words)])
            total += run[end - 1] - run[start]
        return np.flatnonzero(total > self.weights[-1, 0] - self.weights[-1, 1:].max())

    def logits(self, windows: list[np.ndarray]) -> np.ndarray:
        return np.array([self.weights[_features(w)].sum(axis=0) + self.weights[-1] for w in windows], dtype=float).reshape(len(windows), self.weights.shape[1])

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def _examples(lines: list[str]) -> list[tuple[np.ndarray, int]]:
    """Windows with their class: lines of the corpus that hold no template, and notices, whole or cut, between words of them."""
    rng = random.Random(7)
    out = []
    for line in lines:
        offsets, words = _words([line.encode()])
        for _, a, b in zip(*_windows(offsets)):
            if similarity(words[a:b]) < 0.4:
                out.append((words[a:b], 0))
    spare = [w for line in lines for w in line.split()] or ["text"]
    notices = [(n, CLASSES.index(f)) for f, own in TEMPLATES.items() for n in own] + [(n, 1) for n in UNKNOWN]
    for notice, label in notices:
        for k in range(COPIES):
            words = notice.split()
            if k and len(words) > 10:
                size = rng.randint(8, len(words))
                at = rng.randint(0, len(words) - size)
                words = words[at : at + size]
            before, after = (rng.choices(spare, k=rng.choice([0, 0, 4, 10, 14])) for _ in "ab") if k else ([], [])
            out.append((_words([" ".join([*before, *words, *after]).encode()])[1][: 2 * WINDOW], label))
    rng.shuffle(out)
    return out


def train(lines: list[str]) -> Model:
    """Multinomial logistic regression by adaptive gradient steps over the examples, calibrated on every fifth of them."""
    examples = _examples(lines)
    known = [(_features(w), w, y) for w, y in examples]
    fitted, held = [e for k, e in enumerate(known) if k % 5], known[::5]
    weights = np.zeros((DIMENSIONS + 1, len(CLASSES)))
    seen = np.full_like(weights, 1e-6)
    rng = np.random.default_rng(7)
    for _ in range(EPOCHS):
        order = rng.permutation(len(fitted))
        for at in range(0, len(order), 64):
            batch = [fitted[k] for k in order[at : at + 64]]
            flat = np.concatenate([f for f, _, _ in batch])
            row = np.repeat(np.arange(len(batch)), [len(f) for f, _, _ in batch])
            z = np.tile(weights[-1], (len(batch), 1))
            np.add.at(z, row, weights[flat])
            z = np.exp(z - z.max(axis=1, keepdims=True))
            z /= z.sum(axis=1, keepdims=True)
            z[np.arange(len(batch)), [y for _, _, y in batch]] -= 1
            touched, back = np.unique(flat, return_inverse=True)
            step = np.zeros((len(touched), len(CLASSES)))
            np.add.at(step, back, z[row])
            step = step / len(batch) + 1e-5 * weights[touched]
            seen[touched] += step**2
            weights[touched] -= 0.3 * step / np.sqrt(seen[touched])
            constant = z.mean(axis=0)
            seen[-1] += constant**2
            weights[-1] -= 0.3 * constant / np.sqrt(seen[-1])
    model = Model(weights.astype(np.float32), 1.0, 0.5)
    logits = model.logits([w for _, w, _ in held])
    label = np.array([y for _, _, y in held])
    losses = {t: -np.log(np.maximum(Model(model.weights, t, 0.5).probabilities(logits)[np.arange(len(label)), label], 1e-12)).mean() for t in (0.5, 0.7, 1.0, 1.4, 2.0, 3.0, 4.0, 6.0)}
    temperature = min(losses, key=losses.get)
    p = Model(model.weights, temperature, 0.5).probabilities(logits)
    best, top = p.argmax(axis=1), p.max(axis=1)
    bound = 0.5
    for t in np.arange(0.5, 0.96, 0.05):
        chosen = (best > 1) & (top >= t)
        bound = float(t)
        if not chosen.any() or (label[chosen] == best[chosen]).mean() >= PRECISION:
            break
    return Model(model.weights, temperature, bound)


def sample_lines(base: DataFrame) -> list[str]:
    """At most ``SAMPLE_LINES`` lines of ``SAMPLE_DOCS`` documents drawn by a hash of the id."""
    ids = base.select("doc_id").where(F.col("doc_id").isNotNull()).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    lines = base.join(F.broadcast(ids), "doc_id").select(F.explode(F.split("text", "\n")).alias("line")).where(F.trim("line") != "")
    lines = lines.select(F.substring("line", 1, 2000).alias("line")).distinct().orderBy(F.xxhash64("line"), "line").limit(SAMPLE_LINES)
    return [r["line"] for r in lines.collect()]


@dataclass(frozen=True)
class Notice:
    start: int
    end: int
    family: int
    probability: float
    certain: float
    held: float
    confirmed: bool


def _judge(m: Model, words: np.ndarray, spans: list[tuple[int, int]]) -> list[Notice]:
    """Those of the windows that are more like a notice than like ordinary text."""
    if not spans:
        return []
    logits = m.logits([words[a:b] for a, b in spans])
    sure = np.flatnonzero(logits[:, 0] < logits[:, 1:].max(axis=1))
    out = []
    for k, p in zip(sure, m.probabilities(logits[sure]) if len(sure) else []):
        own = int(p[1:].argmax()) + 1
        family = own if p[own] >= m.bound else 1
        start, end = spans[k]
        held = similarity(words[start:end], own if own > 1 else None)
        out.append(Notice(start, end, family, float(p[family]), float(1 - p[0]), held, held >= CONFIRMED and family > 1))
    return out


def _without(start: int, end: int, taken: list[Notice]) -> list[tuple[int, int]]:
    """What is left of a window beside the notices, in pieces of two words at least."""
    out, at = [], start
    for n in sorted(taken, key=lambda n: n.start):
        if n.end > at and n.start < end:
            out.append((at, n.start))
            at = max(at, n.end)
    return [(a, b) for a, b in [*out, (at, end)] if b - a > 1]


def _apart(found: list[Notice], rank) -> list[Notice]:
    """The notices that don't overlap a better one."""
    out: list[Notice] = []
    for n in sorted(found, key=rank):
        if all(n.end <= o.start or n.start >= o.end for o in out):
            out.append(n)
    return out


def notices(m: Model, words: np.ndarray, windows: list[tuple[int, int]]) -> list[Notice]:
    """The notices in overlapping windows of one paragraph, apart from each other.

    A window that holds a template is cut to it, so that two notices in one window are judged one by one and a notice stands
    where its words do. What is left of the windows beside confirmed notices is judged again until no more are confirmed.
    Unconfirmed windows that overlap are one notice per family.
    """
    taken: list[Notice] = []
    todo, seen = windows, set()
    while todo:
        spans: set[tuple[int, int]] = set()
        for n in _judge(m, words, todo):
            share, a, b = _nearest(words[n.start : n.end])
            if share >= CONFIRMED:
                spans.add((n.start + a, n.start + b))
        new = _apart([n for n in _judge(m, words, sorted(spans)) if n.confirmed], lambda n: (-n.held, -(n.end - n.start), -n.certain, n.start))
        new = [n for n in new if all(n.end <= o.start or n.start >= o.end for o in taken)]
        taken += new
        seen.update(todo)
        todo = sorted({x for a, b in todo for x in _without(a, b, new)} - seen) if new else []
    left = sorted({x for a, b in windows for x in _without(a, b, taken)})
    groups: dict[int, list[list[Notice]]] = {}
    for n in _judge(m, words, left):
        if n.confirmed:  # its family's words are there, though not as one run
            taken += [n] if all(n.end <= o.start or n.start >= o.end for o in taken) else []
            continue
        own = groups.setdefault(n.family, [])
        if own and n.start < max(o.end for o in own[-1]):
            own[-1].append(n)
        else:
            own.append([n])
    best = [max(run, key=lambda n: (n.certain, n.start - n.end)) for runs in groups.values() for run in runs]
    known = taken + [n for n in best if n.family > 1]
    best = [n for n in best if all(n.end <= o.start or n.start >= o.end for o in (known if n.family == 1 else taken))]
    return sorted(taken + best, key=lambda n: (n.start, n.family))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per licence notice in ``docs``: doc_id, line (from 0) where it begins, family, probability, similarity, confirmed.

    Lines without words, such as blank ones and those of comment marks, part paragraphs. Windows run over whole paragraphs,
    since notices are wrapped, and over single lines. ``family`` is ``unknown`` for a notice whose family is not certain
    enough. Null, empty and blank texts have no rows, rows that repeat are scanned alike, an empty table gives no rows.
    """
    base = texts(docs, id_col, text_col)
    model = docs.sparkSession.sparkContext.broadcast(train(sample_lines(base)))

    def run(batches):
        m = model.value
        for batch in batches:
            keys, places, lines, firsts = [], [], [], []
            found: list[tuple] = []

            def judge() -> None:
                offsets, words = _words(lines)
                first = np.flatnonzero(np.array(firsts, dtype=bool))
                bounds = np.append(first, len(lines))
                line, start, end = _windows(offsets)
                paragraph = np.searchsorted(first, line, side="right") - 1
                several, more_start, more_end = _windows(offsets[bounds])
                wrapped = np.diff(bounds)[several] > 1
                paragraph = np.concatenate([paragraph, several[wrapped]])
                start, end = np.concatenate([start, more_start[wrapped]]), np.concatenate([end, more_end[wrapped]])
                hopeful = m.hopeful(words, start, end)
                logits = m.logits([words[start[k] : end[k]] for k in hopeful])
                windows: dict[int, set] = {}
                for k in hopeful[logits[:, 0] < logits[:, 1:].max(axis=1)] if len(hopeful) else []:
                    windows.setdefault(int(paragraph[k]), set()).add((int(start[k]), int(end[k])))
                for _, own in sorted(windows.items()):
                    for n in notices(m, words, sorted(own)):
                        at = int(np.searchsorted(offsets, n.start, side="right")) - 1
                        found.append((keys[at], places[at], CLASSES[n.family], n.probability, n.held, n.confirmed))
                keys.clear(), places.clear(), lines.clear(), firsts.clear()

            size = 0
            for key, raw in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                begins = True
                for place, x in enumerate(raw.split(b"\n")):
                    if x.translate(_PUNCTUATION).strip():
                        keys.append(key), places.append(place), lines.append(x), firsts.append(begins)
                        size += len(x)
                        begins = False
                    else:
                        begins = True
                if size > 1 << 20:
                    judge()
                    size = 0
            judge()
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.float64(), pa.bool_())
            columns = list(zip(*found)) if found else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["doc_id", "line", "family", "probability", "similarity", "confirmed"])

    return base.mapInArrow(run, "doc_id long, line long, family string, probability double, similarity double, confirmed boolean")


@query("op6_license_scan")
def op6_license_scan(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents"))
