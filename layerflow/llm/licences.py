"""Licence scan: a trained paragraph classifier, confirmed by comparison with templates.

Paragraphs are single lines and, for notices that are wrapped, groups of consecutive lines without an empty one: those
where enough word pairs of a template lie close together, pairs across a line's end included (comment marks are no
words).  A group is reported if it is confirmed, by its first line; it replaces what its lines would be confirmed as by
fewer pairs.

Each paragraph is a sparse vector of the word n-grams (1..3) that the training notices hold.
Multinomial logistic regression gives a licence family or ``none`` (ordinary text); its temperature is
calibrated on held-out paragraphs.  A paragraph that is not ``none`` but whose calibrated probability
stays below ``SURE`` is ``unknown``: a licence, of no known family.  A family is confirmed if one of its
templates is contained in the paragraph (share of the template's word pairs) to ``CONFIRM``.

Trained on the notices below, varied by a rule, and on paragraphs of at most ``MAX_TRAIN_DOCS``
documents that have no licence word (their first ``PARAGRAPH_CHARS`` characters; of their words, ``FILLER`` picked by
hash vary the notices); every paragraph of every document is scored, whole.

Defined results: null and empty texts have no paragraphs; a paragraph without a known n-gram is ``none``
and returned nowhere; equal rows give equal results; other columns are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerflow.llm.common import lean, row_key, sample_of, table

MAX_TRAIN_DOCS = 300
MAX_TRAIN_PARAGRAPHS = 1_200
PARAGRAPH_CHARS = 2_000  # of a training paragraph only
FILLER = 5_000
SURE = 0.6
CONFIRM = 0.6
STRETCH = 2  # a wrapped notice may have so many times its template's words
NONE, UNKNOWN = "none", "unknown"

#: Notices by licence family, as authors write them.
NOTICES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
                   "SPDX-License-Identifier: Apache-2.0", "Released under the Apache 2.0 license."),
    "MIT": ("Released under the MIT License.", "This project is licensed under the MIT License.", "SPDX-License-Identifier: MIT",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction."),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-or-later",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
                "Licensed under the GPLv3."),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0-only",
                "under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."),
    "LGPL": ("Licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-3.0-only",
             "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation."),
    "AGPL-3.0": ("Licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-only"),
    "BSD": ("Use of this source code is governed by a BSD-style license.", "Licensed under the BSD 3-Clause License.",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
            "SPDX-License-Identifier: BSD-3-Clause"),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.",
                "SPDX-License-Identifier: MPL-2.0", "Licensed under the Mozilla Public License 2.0."),
    "ISC": ("Licensed under the ISC License.", "SPDX-License-Identifier: ISC"),
    "Unlicense": ("This is free and unencumbered software released into the public domain.", "Released under the Unlicense."),
    "CC0": ("Dedicated to the public domain under CC0 1.0.", "Licensed under CC0 1.0 Universal."),
    "CC-BY": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-ND": ("Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    "proprietary": ("Copyright. All rights reserved.", "All rights reserved. No part of this publication may be reproduced without permission.",
                    "Proprietary and confidential. Unauthorized copying is strictly prohibited."),
}
#: Notices of no family above, and prose that speaks of licences.
OTHERS = ("Licensed under the Example Corporation Community License, revision 7.", "Released under the terms of our own license agreement.",
          "This work is licensed under the terms in the file LICENSE.", "See the license for details of the terms.")
PROSE = ("He lost his driving licence in the spring.", "The public library is open to the general public.", "Version 3 of the plan was released in May.",
         "The work of the foundation is under way.", "They gave permission to copy the file to the source folder.", "The software industry is free to grow.",
         "The rights of the people were reserved to them.", "Attribution of the poem to her is international news.")
TOKEN = re.compile(r"[^\W_]+(?:[.+\-][^\W_]+)*")


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


class Features:
    """n-grams (1..3) of known words as feature numbers.  A key is built from word numbers, so it is
    exact: base ``len(words) + 1``, three digits."""

    def __init__(self, words: dict[str, int], keys: np.ndarray):
        self.words, self.keys, self.base = words, keys, len(words) + 1

    @classmethod
    def of(cls, notices: list[str]) -> "Features":
        lists = [tokens(t) for t in notices]
        own = cls({w: k + 1 for k, w in enumerate(sorted({w for x in lists for w in x}))}, np.zeros(0, np.int64))
        own.keys = np.unique(np.concatenate([own._keys(own._ids(x))[0] for x in lists]))
        return own

    def _ids(self, words: list[str]) -> np.ndarray:
        get = self.words.get
        return np.fromiter((get(w, 0) for w in words), np.int64, len(words))

    def _keys(self, ids: np.ndarray, group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        group = np.zeros(len(ids), np.int64) if group is None else group
        keys, at = [], []
        for n in (1, 2, 3):
            if len(ids) < n:
                continue
            m = len(ids) - n + 1
            key, ok = np.zeros(m, np.int64), group[:m] == group[n - 1:n - 1 + m]
            for k in range(n):
                key = key * self.base + ids[k:k + m]
                ok &= ids[k:k + m] > 0
            keys.append(key[ok])
            at.append(group[:m][ok])
        return (np.concatenate(keys), np.concatenate(at)) if keys else (np.zeros(0, np.int64),) * 2

    def numbered(self, paragraphs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers (0: unknown) of all paragraphs in a row, and the paragraph of each."""
        lists = [tokens(p) for p in paragraphs]
        return (self._ids([w for x in lists for w in x]),
                np.repeat(np.arange(len(lists)), [len(x) for x in lists]))

    def present(self, ids: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(paragraph, feature) pairs, each once."""
        keys, at = self._keys(ids, group)
        if not len(keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        f = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = self.keys[f] == keys
        pair = np.unique(at[hit] * len(self.keys) + f[hit])
        return pair // len(self.keys), pair % len(self.keys)


def pairs(text: str) -> set[tuple[str, str]]:
    w = tokens(text)
    return set(zip(w, w[1:])) or {(x, "") for x in w}


class Model:
    def __init__(self, words: dict[str, int], keys: np.ndarray, classes: list[str], weights: np.ndarray,
                 bias: np.ndarray, heat: float = 1.0):
        self.parts = words, keys, classes, weights, bias, heat
        self.features, self.classes, self.weights, self.bias, self.heat = Features(words, keys), classes, weights, bias, heat
        self.templates = {f: [pairs(t) for t in ts] for f, ts in NOTICES.items()}

        # word pairs of the templates as numbers, and which templates have each
        flat = [(f, t) for f, ts in NOTICES.items() for t in ts]
        own = [np.unique(self._pair_keys(self.features.numbered([t])[0])) for _, t in flat]
        self.sizes, self.words = [len(k) for k in own], [len(tokens(t)) for _, t in flat]
        order = np.argsort(np.concatenate(own), kind="stable")
        self.pair_keys = np.concatenate(own)[order]
        self.pair_template = np.repeat(np.arange(len(own)), self.sizes)[order]

    def _pair_keys(self, ids: np.ndarray) -> np.ndarray:
        """A number per adjacent pair of known words, -1 where one is unknown."""
        return np.where((ids[:-1] > 0) & (ids[1:] > 0), ids[:-1] * self.features.base + ids[1:], -1)

    def logits(self, ids: np.ndarray, group: np.ndarray, n: int) -> np.ndarray:
        row, f = self.features.present(ids, group)
        out = np.zeros((n, len(self.classes)))
        np.add.at(out, row, self.weights[f])
        return out + self.bias

    def judged(self, z: np.ndarray, text: str) -> tuple[str, float, float, bool]:
        """(family, probability, similarity, confirmed) of a paragraph that is not ``none``."""
        p = np.exp((z - z.max()) / self.heat)
        p /= p.sum()
        best = int(p.argmax())
        family, own = self.classes[best] if p[best] >= SURE else UNKNOWN, pairs(text)
        like = max((len(t & own) / len(t) for t in self.templates.get(family, [])), default=0.0)
        return family, float(p[best]), like, like >= CONFIRM

    def scan(self, text: str | None) -> Iterator[tuple[int, int, str, float, float, bool]]:
        """(paragraph, its first code point, family, probability, similarity, confirmed)."""
        if not text:
            return
        lines = text.split("\n")
        start = np.cumsum([0] + [len(x) + 1 for x in lines])
        ids, group = self.features.numbered(lines)
        z, none = self.logits(ids, group, len(lines)), self.classes.index(NONE)
        found = {k: self.judged(z[k], lines[k]) for k in np.flatnonzero(z.argmax(axis=1) != none).tolist()}
        sure = {k: self.matched(f[0], lines[k]) for k, f in found.items() if f[-1]}
        for a, b in self.wrapped(ids, group, lines, sure):
            joined = " ".join(lines[a:b + 1])
            z = self.logits(*self.features.numbered([joined]), 1)[0]
            if int(z.argmax()) != none and (whole := self.judged(z, joined))[-1]:
                found = {k: f for k, f in found.items() if not (a <= k <= b and f[-1])} | {a: whole}
        for k, f in sorted(found.items()):
            yield (k, int(start[k]), *f)

    def matched(self, family: str, text: str) -> int:
        """Word pairs that the text shares with the family's template it shares most with."""
        own = pairs(text)
        return max((len(t & own) for t in self.templates.get(family, [])), default=0)

    def wrapped(self, ids: np.ndarray, group: np.ndarray, lines: list[str], sure: dict[int, int]) -> list[tuple[int, int]]:
        """(first, last) line of groups where a template's word pairs are close together: enough different
        ones to confirm it, and more than a line of the group has that is confirmed by itself (``sure``: line ->
        pairs).  Groups do not overlap; those with most pairs come first."""
        if len(ids) < 2 or len(lines) < 2:
            return []
        run = np.cumsum([not x.strip() for x in lines])[group]       # an empty line ends a run
        keys = np.where(run[:-1] == run[1:], self._pair_keys(ids), -1)
        lo, hi = (np.searchsorted(self.pair_keys, keys, side) for side in ("left", "right"))
        hits = np.flatnonzero(hi > lo)
        if not len(hits):
            return []
        n = (hi - lo)[hits]
        which = np.repeat(lo[hits] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        template, at = self.pair_template[which], np.repeat(hits, n)
        many = np.bincount(template, minlength=len(self.sizes)) >= CONFIRM * np.array(self.sizes)
        spans = [(n, int(group[i]), int(group[j + 1])) for t in np.flatnonzero(many).tolist()
                 for n, i, j in _close(at[template == t], keys, run, self.sizes[t], STRETCH * self.words[t])]
        out, taken = [], set()
        for n, a, b in sorted(spans, key=lambda x: (-x[0], x[1], x[2])):
            own = range(a, b + 1)
            if a < b and not taken.intersection(own) and n > max((sure.get(k, 0) for k in own)):
                out.append((a, b))
                taken.update(own)
        return sorted(out)


def _close(at: np.ndarray, keys: np.ndarray, run: np.ndarray, size: int, most: int) -> list[tuple[int, int, int]]:
    """(different pairs, first, last place) of stretches of at most ``most`` words in one run that hold the
    share ``CONFIRM`` of a template's ``size`` pairs; of overlapping ones the first that holds most.  No stretch
    begins with a pair that it has again."""
    out, held, i = [], {}, 0
    at = at.tolist()
    for j, p in enumerate(at):
        key = int(keys[p])
        held[key] = held.get(key, 0) + 1
        while p - at[i] >= most or run[at[i]] != run[p] or held[int(keys[at[i]])] > 1:
            k = int(keys[at[i]])
            held[k] -= 1
            if not held[k]:
                del held[k]
            i += 1
        if len(held) >= CONFIRM * size:
            if not out or at[i] > out[-1][2]:
                out.append((len(held), at[i], p))
            elif len(held) > out[-1][0]:
                out[-1] = (len(held), at[i], p)
    return out


def _varied(rng: np.random.Generator, text: str, filler: list[str]) -> str:
    """A notice as it stands in a document: words lost, other words around it."""
    w = [x for x in text.split() if rng.random() > 0.04] or text.split()
    some = lambda n: list(rng.choice(filler, n)) if n and filler else []
    return " ".join(some(int(rng.integers(0, 12))) + w + some(int(rng.integers(0, 12))))


def train(prose: list[str], seed: int = 11, copies: int = 14, steps: int = 250) -> Model:
    """Logistic regression by gradient descent; the temperature minimises the held-out log loss."""
    rng = np.random.default_rng(seed)
    classes = [NONE, UNKNOWN, *NOTICES]
    filler = sorted({w for p in prose for w in p.split()}, key=lambda w: (crc32(w.encode()), w))[:FILLER] or ["text"]
    rows = [(f, t if k == 0 else _varied(rng, t, filler)) for f, ts in NOTICES.items() for t in ts for k in range(copies)]
    rows += [(UNKNOWN, t if k == 0 else _varied(rng, t, filler)) for t in OTHERS for k in range(copies)]
    rows += [(NONE, t if k == 0 else _varied(rng, t, filler)) for t in PROSE for k in range(copies // 2)]
    rows += [(NONE, p) for p in prose]
    features = Features.of([t for ts in NOTICES.values() for t in ts] + list(OTHERS) + list(PROSE))
    order = rng.permutation(len(rows))
    y = np.array([classes.index(rows[k][0]) for k in order])
    row, f = features.present(*features.numbered([rows[k][1] for k in order]))
    x = np.zeros((len(rows), len(features.keys)), np.float32)
    x[row, f] = 1
    held = np.arange(len(rows)) % 5 == 0
    a, b = x[~held], np.eye(len(classes), dtype=np.float32)[y[~held]]
    w, c = np.zeros((x.shape[1], len(classes)), np.float32), np.zeros(len(classes), np.float32)
    vw, vc = np.zeros_like(w), np.zeros_like(c)
    for _ in range(steps):
        z = a @ w + c
        p = np.exp(z - z.max(axis=1, keepdims=True))
        g = (p / p.sum(axis=1, keepdims=True) - b) / len(a)
        vw, vc = 0.9 * vw - 1.0 * (a.T @ g + 2e-4 * w), 0.9 * vc - 1.0 * g.sum(axis=0)
        w, c = w + vw, c + vc
    z = x[held] @ w + c

    def loss(t: float) -> float:
        s = z / t
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(s)), y[held]]).mean())

    heat = min(np.geomspace(0.3, 3.0, 25), key=loss)
    return Model(features.words, features.keys, classes, w.astype(np.float64), c.astype(np.float64), float(heat))


def training_prose(docs: DataFrame, text_col: str = "text") -> list[str]:
    rows = sample_of(docs, row_key(docs, text_col), MAX_TRAIN_DOCS).select(F.col(text_col).alias("text"))
    p = rows.select(F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("p")).where(
        r"p <> '' AND NOT p RLIKE '(?i)licen[cs]e|copyright|spdx|rights|released|creative|public'")
    p = p.select(F.substring("p", 1, PARAGRAPH_CHARS).alias("p"))
    return [r["p"] for r in p.orderBy(F.xxhash64("p"), "p").limit(MAX_TRAIN_PARAGRAPHS).collect()]


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per licence paragraph."""
    shared = docs.sparkSession.sparkContext.broadcast(model.parts)  # their size is that of the notices

    @lean
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Model(*shared.value)
        for p in parts:
            yield pd.DataFrame([(d, *m) for d, t in zip(p["doc_id"], p["text"]) for m in own.scan(t)],
                               columns=["doc_id", "paragraph", "start", "family", "probability", "similarity", "confirmed"])

    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    out = rows.mapInPandas(run, "doc_id string, paragraph long, start long, family string, probability double, "
                                "similarity double, confirmed boolean")
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = scan(docs, train(training_prose(docs)))
    return out.withColumns({c: F.round(c, 6) for c in ("probability", "similarity")})
