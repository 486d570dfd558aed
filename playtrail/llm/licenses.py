"""Licence notices found by a trained paragraph classifier.

Paragraphs are the lines of a text. Features are the word 1-, 2- and 3-grams of
the licence templates (so a paragraph without any of them has the score of an
empty one). A softmax regression is trained on variants of the templates
(words left out, taken from the corpus in front and behind, case) against an unknown
class: up to ``MAX_UNKNOWN`` distinct paragraphs of the corpus, those of smallest hash among the ones
of ``LONGEST`` characters or fewer (bounds of the sample to fit on only), less those that share a 3-gram with a template, and sentences that speak of licences without granting one. Its
logits are divided by a temperature fitted on a held-out fifth of the variants
(calibration); a family is predicted only if its probability is at least
``LIKELY`` and above the unknown class.

A prediction is confirmed by its template: the share of the template's word
bigrams that the paragraph holds must be ``CONFIRM`` or more. From that follows which
paragraphs need the classifier at all: of every template, the fewest long words are
taken without which too few of its bigrams are left (``KEYS``), and a paragraph
that holds none of them, found by one automaton over the text, can't be confirmed.

Nulls: a null text has no paragraph. Empty paragraphs are not counted. Rows come
back one for one.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.llm.common import text_chunks

MAX_UNKNOWN = 2_000
LIKELY = 0.6
CONFIRM = 0.6
VARIANTS = 24  # of each template
LONGEST = 2_000  # characters of a paragraph in the sample to fit on
SPARE = 4  # times as many lines as wanted, for copies

# Notices of the licence families: in a sentence, as title, as identifier, as standard
# header, and the paragraphs of the licence texts that grant or forbid.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "This file is licensed to you under the Apache License 2.0",
        "Apache License, Version 2.0",
        "SPDX-License-Identifier: Apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
        "each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work",
    ],
    "MIT": [
        "Released under the MIT License",
        "This software is licensed under the MIT license",
        "The MIT License (MIT)",
        "MIT License",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Licensed under the BSD 3-Clause License",
        "BSD 2-Clause License",
        "SPDX-License-Identifier: BSD-3-Clause",
        "SPDX-License-Identifier: BSD-2-Clause",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation",
        "may be used to endorse or promote products derived from this software without specific prior written permission",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3",
        "under the terms of the GNU General Public License as published by the Free Software Foundation",
        "Licensed under the GNU General Public License v2",
        "GNU General Public License",
        "SPDX-License-Identifier: GPL-2.0-only",
        "SPDX-License-Identifier: GPL-2.0-or-later",
        "SPDX-License-Identifier: GPL-3.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "LGPL": [
        "under the terms of the GNU Lesser General Public License",
        "Licensed under the GNU LGPL, version 2.1",
        "GNU Lesser General Public License",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "SPDX-License-Identifier: LGPL-3.0-only",
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Mozilla Public License Version 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "CC-BY": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        "Licensed under CC BY 4.0",
        "Creative Commons Attribution 4.0 International",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 License",
        "Creative Commons Attribution-ShareAlike 4.0 International",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 License",
        "Creative Commons Attribution-NonCommercial 4.0 International",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "CC0": [
        "To the extent possible under law, the author has waived all copyright, CC0 1.0 Universal",
        "Dedicated to the public domain",
        "CC0 1.0 Universal",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "Proprietary": [
        "All rights reserved",
        "No part of this publication may be reproduced without permission",
        "No part of this publication may be reproduced, distributed, or transmitted in any form or by any means, without the prior written permission of the publisher",
        "SPDX-License-Identifier: LicenseRef-Proprietary",
    ],
}
UNRELATED = [
    "He lost his driving license last year", "The license fee has to be paid in advance", "a public library with general rules",
    "The version of the story is not clear", "Rights of way are reserved for trams", "the terms of the contract were published",
    "a work of the common people", "Released in the spring", "Table reserved for all guests", "the foundation of the free city",
]
WORD = re.compile(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*")


def grams(text: str) -> list[str]:
    """Word 1-, 2- and 3-grams, lower-case."""
    w = WORD.findall(text.lower())
    return [" ".join(w[k : k + n]) for n in (1, 2, 3) for k in range(len(w) - n + 1)]


FAMILIES = list(TEMPLATES)
VOCABULARY = {g: k for k, g in enumerate(dict.fromkeys(g for t in TEMPLATES.values() for x in t for g in grams(x)))}
BIGRAMS = [
    (family, text, {g for g in grams(text) if g.count(" ") == 1}) for family, own in TEMPLATES.items() for text in own
]


def key_words(bigrams: set[str], share: float = CONFIRM) -> set[str]:
    """Words of a template, the longest first, until the bigrams without any of them
    are less than ``share`` of all: a text without these words can't hold that share."""
    keys: set[str] = set()
    left = bigrams
    for word in sorted({w for g in bigrams for w in g.split()}, key=lambda w: (-len(w), w)):
        if len(left) < share * len(bigrams):
            break
        keys.add(word)
        left = {g for g in left if word not in g.split()}
    return keys


KEYS = ahocorasick.Automaton()
for _key in sorted(set().union(*(key_words(b) for _, _, b in BIGRAMS))):
    KEYS.add_word(_key, _key)
KEYS.make_automaton()


def may_hold_notice(text: str) -> bool:
    """Does a lower-case text hold a key word (maybe inside another word)?"""
    return next(KEYS.iter(text), None) is not None


@dataclass
class Classifier:
    """Weights of the families and the unknown class (last), and the temperature."""

    weights: np.ndarray
    temperature: float

    def probabilities(self, text: str) -> np.ndarray:
        return _softmax((_features(text) @ self.weights) / self.temperature)

    def classify(self, text: str) -> tuple[str, float, str, float, bool] | None:
        """(family, probability, template, share of it, confirmed); None if unknown."""
        found = [g for g in grams(text) if g in VOCABULARY]
        if not found:
            return None
        p = self.probabilities(text)
        best = int(p[:-1].argmax())
        if p[best] < LIKELY or p[best] <= p[-1]:
            return None
        have = set(found)
        share, template = max((len(b & have) / len(b), t) for f, t, b in BIGRAMS if f == FAMILIES[best])
        return FAMILIES[best], float(p[best]), template, share, share >= CONFIRM


def _features(text: str) -> np.ndarray:
    x = np.zeros(len(VOCABULARY) + 1)
    for g in grams(text):
        k = VOCABULARY.get(g)
        if k is not None:
            x[k] = 1.0 + g.count(" ")
    norm = np.linalg.norm(x)
    if norm:
        x /= norm
    x[-1] = 1.0
    return x


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _variants(fillers: list[str], seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    words = [w for f in fillers for w in f.split()][:20_000] or ["and", "the"]
    rows, classes = [], []
    for k, family in enumerate(FAMILIES):
        for n in range(VARIANTS * len(TEMPLATES[family])):
            own = TEMPLATES[family][n % len(TEMPLATES[family])].split()
            if n >= 2 * len(TEMPLATES[family]) and len(own) > 4:
                own = [w for w in own if rng.random() > 0.08]
            lead, trail = ([words[i] for i in rng.integers(0, len(words), rng.integers(0, 9))] if n % 3 else [] for _ in range(2))
            rows.append(_features(" ".join([*lead, *own, *trail])))
            classes.append(k)
    for text in [*UNRELATED * 6, *fillers]:
        rows.append(_features(text))
        classes.append(len(FAMILIES))
    return np.array(rows), np.array(classes)


def train(docs: DataFrame, max_unknown: int = MAX_UNKNOWN) -> Classifier:
    """Fit on template variants and a bounded sample of the corpus's paragraphs."""
    lines = docs.select(F.explode(F.split(F.col("text").cast("string"), "\n")).alias("line")).filter("line <> ''")
    lines = lines.filter(F.length("line") <= LONGEST).select("line", F.shiftrightunsigned(F.xxhash64("line"), 1).alias("hash"))
    total = lines.count()
    # Those of smallest hash are some among the lowest hashes: of these, distinct lines (copies are one
    # line), so that a few thousand rows are sorted however large the corpus is.
    share = min(1.0, SPARE * max_unknown / max(1, total))
    low = lines.filter(F.col("hash") <= min(int(share * (1 << 63)), (1 << 63) - 1)).distinct()
    found = low.coalesce(1).orderBy("hash", "line").limit(max_unknown).collect()  # max_unknown rows at most
    three = {g for g in VOCABULARY if g.count(" ") == 2}
    fillers = [r["line"] for r in found if three.isdisjoint(grams(r["line"]))]
    x, y = _variants(fillers)
    held = np.arange(len(y)) % 5 == 0
    target = np.eye(len(FAMILIES) + 1)[y]
    weights = np.zeros((x.shape[1], target.shape[1]))
    balance = (len(y) / np.bincount(y, minlength=target.shape[1]).clip(1))[y]
    balance = (balance / balance.mean())[:, None]
    own, goal, scale = x[~held], target[~held], balance[~held]
    for _ in range(600):
        grad = own.T @ ((_softmax(own @ weights) - goal) * scale) / len(own) + 1e-4 * weights
        weights -= 4.0 * grad
    logits = x[held] @ weights
    heat = np.geomspace(0.2, 5, 40)
    loss = [-np.log(_softmax(logits / t)[np.arange(held.sum()), y[held]] + 1e-12).mean() for t in heat]
    return Classifier(weights, float(heat[int(np.argmin(loss))]))


def scan(docs: DataFrame, model: Classifier) -> DataFrame:
    """For every row of (doc_id, text): n_paragraphs, and the confirmed notices in order."""
    notice = "struct<paragraph: long, family: string, probability: double, template: string, share: double>"
    kind = pa.struct([("paragraph", pa.int64()), ("family", pa.string()), ("probability", pa.float64()), ("template", pa.string()), ("share", pa.float64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple | None] = {}
        for b in text_chunks(batches):
            counts, notices = [], []
            for text in b.column(1).to_pylist():
                lines = [x for x in (text or "").split("\n") if x and not x.isspace()]
                counts.append(len(lines))
                own = []
                for k, line in enumerate(lines if may_hold_notice((text or "").lower()) else ()):
                    if not may_hold_notice(line.lower()):
                        continue
                    got = known.get(line, ...)
                    if got is ...:
                        got = model.classify(line)
                        if len(line) < 500:
                            if len(known) > 50_000:
                                known.clear()
                            known[line] = got
                    if got and got[4]:
                        own.append(dict(zip(("paragraph", "family", "probability", "template", "share"), (k, *got[:4]))))
                notices.append(own)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(counts, pa.int64()), pa.array(notices, pa.list_(kind))], ["doc_id", "n_paragraphs", "notices"]
            )

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return picked.mapInArrow(run, f"doc_id long, n_paragraphs long, notices array<{notice}>")
