"""Operator 7: licence scans with a trained paragraph classifier.

Paragraphs (lines, and blocks of lines between blank ones, for wrapped text) are scored by a multinomial logistic
regression over hashed word n-grams. It is trained on licence templates, cut and disturbed in many ways, and on paragraphs
of the corpus and of other licences as the unknown class; a threshold on held-out paragraphs of these calibrates "unknown".
What the classifier says is confirmed by comparing the paragraph with the family's templates.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import chunks, mix64

#: Short texts of licence families, as they stand in notices.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Licensed under the Apache License, Version 2.0.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "GPL": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This work is licensed under the GNU General Public License, version 3.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "CC-BY": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "CC-BY-NC": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
        "You may not use the material for commercial purposes under this Attribution-NonCommercial license.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "LGPL": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "AGPL": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Licensed under the ISC License.",
        "SPDX-License-Identifier: ISC",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "SPDX-License-Identifier: Unlicense",
    ),
    "EPL": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
        "SPDX-License-Identifier: EPL-2.0",
    ),
    "BSL-1.0": (
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)",
        "SPDX-License-Identifier: BSL-1.0",
    ),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
}
#: Notices of other licences and of none, which are unknown here. Every other one only calibrates.
OTHERS = (
    "The contents of this file are subject to the terms of the Common Development and Distribution License (the \"License\"). You may not use this file except in compliance with the License.",
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
    "Licensed under the EUPL, Version 1.2 or as soon they will be approved by the European Commission - subsequent versions of the EUPL.",
    "This program is free software. It comes without any warranty, to the extent permitted by applicable law. You can redistribute it and/or modify it under the terms of the Do What The Fuck You Want To Public License, Version 2.",
    "Copyright 2020 The Authors. All rights reserved. No part of this document may be reproduced without the written permission of the publisher.",
    "This is free software; you can redistribute it and/or modify it under the same terms as the Perl 5 programming language system itself, or under the Artistic License.",
    "This proprietary software is licensed, not sold. You may not copy, modify or distribute it except as your agreement with the owner expressly permits.",
    "Use of this service is subject to our terms and conditions; by using it you accept our privacy policy and the licence agreement.",
)
FAMILIES = tuple(TEMPLATES)
BITS = 18
#: Documents, and lines of these, that train and calibrate the unknown class; disturbed copies of a template.
MAX_DOCS, MAX_LINES, COPIES = 400, 3_000, 32
#: Share of a paragraph's n-grams, or of a template's, that the two must have in common.
CONFIRM = 0.5
_TOKEN = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")
_TOKEN_OR_LINE = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*|\n")
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def grams(paragraph: str) -> list[str]:
    """Lower-case words and pairs of words."""
    w = _TOKEN.findall(paragraph.lower())
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])]


_TEMPLATE_GRAMS = {f: [frozenset(grams(t)) for t in ts] for f, ts in TEMPLATES.items()}


def slots(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots of the words and pairs of words of all lines of the texts, the line of each, and each text's first line."""
    hashes: dict[str, int] = {"\n": 0}
    codes: list[int] = []
    firsts, line = [0], 0
    for t in texts:
        for w in _TOKEN_OR_LINE.findall(t.lower()):
            if (h := hashes.get(w)) is None:
                h = hashes[w] = zlib.crc32(w.encode("utf-8", "replace")) | 1 << 32
            codes.append(h)
        codes.append(0)
        line += t.count("\n") + 1
        firsts.append(line)
    h = np.array(codes, dtype=np.uint64)
    lines = np.cumsum(h == 0) - (h == 0)
    pair = (h[:-1] > 0) & (h[1:] > 0)
    both = mix64(h[:-1][pair] * _PAIR + h[1:][pair])
    found = np.concatenate([mix64(h[h > 0]), both]) & np.uint64((1 << BITS) - 1)
    of = np.concatenate([lines[h > 0], lines[:-1][pair]])
    order = np.argsort(of, kind="stable")
    return found[order].astype(np.int64), of[order], np.array(firsts)


class LicenceModel:
    """Softmax regression: weights by (slot, class), the last class being unknown; and the calibrated threshold."""

    def __init__(self) -> None:
        self.weights = np.zeros((1 << BITS, len(FAMILIES) + 1), dtype=np.float32)
        self.threshold = 0.5

    def sums(self, found: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """For each of n lines: the sum of its slots' weights, and how many slots it has."""
        count = np.bincount(of, minlength=n)
        z = np.zeros((n, self.weights.shape[1]), dtype=np.float32)
        if len(found):
            at = np.flatnonzero(count)
            z[at] = np.add.reduceat(self.weights[found], np.concatenate([[0], np.cumsum(count)[:-1]])[at], axis=0)
        return z, count

    @staticmethod
    def softmax(z: np.ndarray, count: np.ndarray) -> np.ndarray:
        z = z * (3 / np.sqrt(np.maximum(count, 1)))[:, None]
        z[:, -1] += 1
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def probabilities(self, paragraph: str) -> np.ndarray:
        found, of, _ = slots([paragraph.replace("\n", " ")])
        return self.softmax(*self.sums(found, of, 1))[0]

    def fit(self, paragraphs: list[str], classes: list[int], epochs: int = 50, rate: float = 0.5) -> None:
        """Full-batch gradient steps (AdaGrad)."""
        found, of, _ = slots([p.replace("\n", " ") for p in paragraphs])
        y = np.zeros((len(paragraphs), self.weights.shape[1]), dtype=np.float32)
        y[np.arange(len(y)), classes] = 1
        order = np.argsort(found, kind="stable")
        used, first = np.unique(found[order], return_index=True)
        squares = np.full((len(used), y.shape[1]), 1e-6, dtype=np.float32)
        for _ in range(epochs if len(used) else 0):
            z, count = self.sums(found, of, len(y))
            err = (y - self.softmax(z, count)) * (3 / np.sqrt(np.maximum(count, 1)))[:, None].astype(np.float32)
            step = np.add.reduceat(err[of[order]], first, axis=0)
            squares += step**2
            self.weights[used] += rate * step / np.sqrt(squares)

    def confirmed(self, paragraph: str, best: int, p: float) -> tuple[str, float, float] | None:
        """(family, probability, likeness to its nearest template) if the template comparison confirms it."""
        own, family = frozenset(grams(paragraph)), FAMILIES[best]
        like = max((len(own & t) / max(1, min(len(own), len(t))) for t in _TEMPLATE_GRAMS[family]), default=0.0)
        return (family, p, float(like)) if own and like >= CONFIRM else None

    def classify(self, paragraph: str) -> tuple[str, float, float] | None:
        p = self.probabilities(paragraph)
        best = int(p[:-1].argmax())
        return self.confirmed(paragraph, best, float(p[best])) if p[best] >= self.threshold else None

    def scan(self, texts: list[str | None]) -> list[tuple[int, list[tuple[tuple[str, float, float], int]]]]:
        """For each text: its number of paragraphs (lines that are not blank), and what is confirmed, with its paragraph's
        number. A block of several lines counts, by its first line, if none of its lines does by itself."""
        given = [t or "" for t in texts]
        found, of, firsts = slots(given)
        z, count = self.sums(found, of, int(firsts[-1]))
        by_line = self.softmax(z, count)[:, :-1]
        likely = by_line.max(1) >= self.threshold
        out = []
        for i, t in enumerate(given):
            lines, a = t.split("\n"), int(firsts[i])
            filled = np.array([bool(x.strip()) for x in lines])
            number, hits = np.cumsum(filled) - 1, {}
            for j in np.flatnonzero(likely[a : a + len(lines)] & filled).tolist():
                best = int(by_line[a + j].argmax())
                if c := self.confirmed(lines[j], best, float(by_line[a + j, best])):
                    hits[j] = c
            edges = np.flatnonzero(np.diff(np.concatenate([[0], filled, [0]]).astype(int)))
            starts, ends = edges[::2], edges[1::2]
            several = ends - starts > 1
            if several.any():
                sums = np.concatenate([np.zeros((1, z.shape[1]), z.dtype), np.cumsum(z[a : a + len(lines)], axis=0, dtype=np.float64)])
                counts = np.concatenate([[0], np.cumsum(count[a : a + len(lines)])])
                p = self.softmax(sums[ends[several]] - sums[starts[several]], counts[ends[several]] - counts[starts[several]])[:, :-1]
                for s, e, row in zip(starts[several].tolist(), ends[several].tolist(), p):
                    if row.max() >= self.threshold and not any(s <= j < e for j in hits):
                        best = int(row.argmax())
                        if c := self.confirmed(" ".join(lines[s:e]), best, float(row[best])):
                            hits[s] = c
            out.append((int(filled.sum()), [(hits[j], int(number[j])) for j in sorted(hits)]))
        return out


def disturbed(template: str, rng: np.random.Generator, filler: list[str]) -> str:
    """A template as it may stand in a text: words lost, a part only, or other words around it."""
    w = template.split()
    w = [x for x in w if rng.random() > 0.06] or w
    if len(w) > 14 and rng.random() < 0.4:
        a = int(rng.integers(0, len(w) - 10))
        w = w[a : a + int(rng.integers(10, len(w) - a + 1))]
    if filler and rng.random() < 0.3:
        extra = [filler[int(i)] for i in rng.integers(0, len(filler), int(rng.integers(1, 9)))]
        w = extra + w if rng.random() < 0.5 else w + extra
    return " ".join(w)


def train(lines: list[str]) -> LicenceModel:
    """Model from the templates, other notices, and sampled lines; a line with a template's words is left out."""
    rng = np.random.default_rng(5)
    every = [t for ts in _TEMPLATE_GRAMS.values() for t in ts]
    plain = [p for p in lines if not any(len(t & g) >= 0.8 * len(t) for g in [frozenset(grams(p))] for t in every)]
    filler = [w for p in plain[::7] for w in p.split()]
    x, y = [], []
    for k, ts in enumerate(TEMPLATES.values()):
        for t in ts:
            x += [t] + [disturbed(t, rng, filler) for _ in range(COPIES)]
            y += [k] * (COPIES + 1)
    cut = len(plain) * 2 // 3
    other = [disturbed(t, rng, filler) for t in OTHERS[::2] for _ in range(COPIES)]
    model = LicenceModel()
    model.fit(x + plain[:cut] + other, y + [len(FAMILIES)] * (cut + len(other)))
    # unknown is calibrated on paragraphs not learned from: no more than one in a thousand plain ones may pass, and few of
    # the other licences
    best = lambda ps: sorted((float(model.probabilities(p)[:-1].max()) for p in ps), reverse=True)
    rest, odd = best(plain[cut:]), best([disturbed(t, rng, filler) for t in OTHERS[1::2] for _ in range(10)])
    limits = [v[len(v) // share] for v, share in ((rest, 1000), (odd, 20)) if v]
    model.threshold = float(np.clip(max(limits) + 0.02, 0.5, 0.9))
    return model


def fit(docs: DataFrame) -> LicenceModel:
    """Model from MAX_LINES lines, in the order of a hash, of MAX_DOCS texts, in the order of a hash of the id; null ids are
    not taken."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("_h")).where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    # ids first, so that no more than the chosen lines go to the driver
    keys = rows.select("doc_id", "_h").orderBy(F.xxhash64("doc_id"), "_h").limit(MAX_DOCS).distinct()
    lines = rows.join(F.broadcast(keys), ["doc_id", "_h"]).select(F.explode(F.split("text", "\n")).alias("line")).where(F.btrim("line") != "")
    chosen = lines.distinct().orderBy(F.xxhash64("line"), "line").limit(MAX_LINES)
    return train([r["line"] for r in chosen.collect()])


FOUND = "family string, n_paragraphs long, n_licence_paragraphs long, families array<string>, probability double, likeness double, paragraph long"


def scan(docs: DataFrame, model: LicenceModel) -> DataFrame:
    """For every row's whole text: doc_id, family ("unknown" where no paragraph is a confirmed licence), n_paragraphs,
    n_licence_paragraphs, families (all, in order), and probability, likeness and number of the likeliest paragraph.

    Null and empty texts have no paragraphs; repeated rows are scanned each; other columns are not read."""
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for _, part in chunks(b.column("text").to_pylist(), 1_000_000):
                for n, found in model.scan(part):
                    best = max(found, key=lambda x: (x[0][1], -x[1]), default=None)
                    rows.append((best[0][0] if best else "unknown", n, len(found), sorted({c[0] for c, _ in found}), *((best[0][1], best[0][2], best[1]) if best else (None,) * 3)))
            types = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.float64(), pa.float64(), pa.int64())
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *columns], ["doc_id", *(x.split()[0] for x in FOUND.split(", "))])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind.simpleString()}, {FOUND}")
