"""Licence scan: a trained classifier of paragraphs, confirmed by comparison with templates.

Each paragraph of a text is the set of its word n-grams (one and two words).  Sparse logistic regression over the n-grams of the
templates gives a probability for each licence family and for ``unknown``; the probabilities are calibrated on examples
kept apart, and so is the least probability at which a family is predicted at all.  A prediction counts as confirmed if the
paragraph shares enough word pairs with a template of that family.

A notice inside a long line, or wrapped over several, is only a part of paragraphs.  So chains of words whose pairs all occur in templates,
across line ends, are classified too, as if each stood alone; a chain is confirmed by how much of a template it holds.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridclear.llm.common import map_batches, texts

UNKNOWN = "unknown"

#: Notices as their publishers word them, or as projects usually shorten them.
TEMPLATES: dict[str, list[str]] = {
    "Apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "This project is released under the Apache 2.0 license.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the BSD 3-Clause License.",
        "Licensed under the BSD 2-Clause License.",
    ],
    "CC-BY": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply.",
        "Licensed under CC BY-SA 4.0.",
    ],
    "CC-BY-NC": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under CC BY-NC-ND 4.0, for noncommercial purposes only.",
    ],
    "CC0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "This work is dedicated to the public domain under CC0 1.0 Universal.",
        "Released into the public domain under CC0.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Released under the GNU GPL v2 or later.",
    ],
    "LGPL": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
        "Licensed under the GNU Lesser General Public License, version 3.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT license. See the LICENSE file in the project root.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "Proprietary": [
        "Copyright. All rights reserved.",
        "All rights reserved worldwide.",
        "Copyright 2020 the author. All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher.",
        "This document is proprietary and confidential. Unauthorized copying of this file, via any medium, is strictly prohibited.",
    ],
}
#: Ordinary sentences with words of licences, as further examples of ``unknown``.
ORDINARY = [
    "She lost her driving license and had to apply for a new one at the office.",
    "The work of the public library is free for any person in the town.",
    "He asked for permission to use the hall, and the terms were reasonable.",
    "The new version of the software was released in March and sold well.",
    "A copy of the letter was distributed to all members of the foundation.",
    "The general public is invited to the opening of the exhibition.",
    "Students at MIT built a small machine that can copy documents.",
    "The conditions on the road were poor and the notice came late.",
    "The Apache helicopters were seen in the north, under heavy rain.",
    "Any later reader may find the source of the story in the archive.",
    "The singer reserved all rights to the film for her children.",
    "The table was reserved, and all rights of way were closed that year.",
]

WORD = re.compile(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*")


@dataclass(frozen=True)
class Training:
    """``background`` bounds the paragraphs of the corpus that are learned as ``unknown``, ``background_ngrams`` their n-grams beyond those
    of templates, the most frequent ones; the rest is the descent."""

    background: int = 600
    background_ngrams: int = 4000
    variants: int = 20  # altered copies of each template sentence
    steps: int = 200
    rate: float = 2.0
    penalty: float = 1e-4
    least_shared: float = 0.5  # of the word pairs of the shorter of paragraph and template
    piece_words: int = 60  # longer paragraphs are read in overlapping pieces
    chain_shared: float = 0.6  # of a template's word pairs, in a chain
    chain_pairs: int = 16  # templates with more pairs count as having so many there
    seed: int = 3


def ngrams(words: list[str]) -> set[str]:
    return {*words, *map(" ".join, zip(words, words[1:]))}


def pairs(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:]))


Piece = tuple[int, int, list[str]]  # start, end, words


def pieces(found: list[tuple[int, int, str]], piece_words: int) -> Iterable[Piece]:
    """Words in pieces that overlap by half."""
    for k in range(0, max(1, len(found) - piece_words // 2), piece_words // 2):
        piece = found[k : k + piece_words]
        yield piece[0][0], piece[-1][1], [w for *_, w in piece]


def paragraphs(text: str) -> list[list[tuple[int, int, str]]]:
    """(start, end, word) of every word of each line that has words."""
    lines, start = [], 0
    for line in text.split("\n"):
        low = line.lower()
        if len(low) != len(line):  # a letter whose small form is longer; the places of the others stay
            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in line)
        found = [(start + m.start(), start + m.end(), m[0]) for m in WORD.finditer(low)]
        if found:
            lines.append(found)
        start += len(line) + 1
    return lines


def chains(lines: list[list[tuple[int, int, str]]], known: set[tuple[str, str]]) -> Iterable[list[tuple[int, int, str]]]:
    """The longest runs of three or more words of a text whose pairs are all known."""
    every = [word for line in lines for word in line]
    words = [w for *_, w in every]
    begin = None
    for i, is_known in enumerate([*map(known.__contains__, zip(words, words[1:])), False]):
        if is_known:
            begin = i if begin is None else begin
        elif begin is not None:
            if i - begin > 1:
                yield every[begin : i + 1]
            begin = None


@dataclass
class Model:
    families: list[str]  # the last is UNKNOWN
    vocabulary: dict[str, int]
    weights: np.ndarray  # (n-grams, families)
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.5
    known_pairs: set[tuple[str, str]] = field(default_factory=set)
    templates: list[tuple[str, set[tuple[str, str]]]] = field(default_factory=list)

    def probabilities(self, paragraphs: list[list[str]]) -> np.ndarray:
        """(paragraphs, families)"""
        at, sizes, starts = [], [], []
        for words in paragraphs:
            grams = ngrams(words)
            starts.append(len(at))
            sizes.append(len(grams))
            at.append(len(self.vocabulary))  # a row of zeros, so that no paragraph is without
            at += [k for k in map(self.vocabulary.get, grams) if k is not None]
        if not starts:
            return np.zeros((0, len(self.families)))
        rows = np.vstack([self.weights, np.zeros_like(self.weights[:1])])[at]
        sums = np.add.reduceat(rows, starts, axis=0) / np.sqrt(np.maximum(sizes, 1))[:, None]
        return softmax((sums + self.bias) / self.temperature)

    def classify(self, paragraphs: list[list[str]]) -> list[tuple[str, float]]:
        """The family of each paragraph and its probability; ``unknown`` below the calibrated threshold."""
        p = self.probabilities(paragraphs)
        best = p[:, :-1].argmax(axis=1)
        return [
            (self.families[k], float(row[k])) if row[k] >= self.threshold else (UNKNOWN, float(row[-1])) for row, k in zip(p, best)
        ]

    def shared(self, words: list[str], family: str) -> float:
        """The largest share of word pairs that the paragraph has in common with a template of the family."""
        own = pairs(words)
        return max(
            (len(own & t) / max(1, min(len(own), len(t))) for name, t in self.templates if name == family), default=0.0
        )

    def held(self, words: list[str], family: str, most: int) -> float:
        """The largest part of a template of the family that a chain holds, of ``most`` word pairs where it has more."""
        return largest_part(pairs(words), (t for name, t in self.templates if name == family), most)


def largest_part(own: set[tuple[str, str]], templates: Iterable[set[tuple[str, str]]], most: int) -> float:
    return max((min(1.0, len(own & t) / max(1, min(len(t), most))) for t in templates), default=0.0)


def altered(words: list[str], rng: random.Random) -> list[str]:
    """A template as projects change it: a line of it, words left out or exchanged, a name and a year before it."""
    if len(words) > 14 and rng.random() < 0.6:
        length = rng.randint(8, min(20, len(words)))
        start = rng.randint(0, len(words) - length)
        words = words[start : start + length]
    out = [w for w in words if rng.random() > 0.06]
    out = [w if rng.random() > 0.03 else rng.choice(["project", "library", "our", "code", "data", "team"]) for w in out]
    if rng.random() < 0.3:
        out = ["copyright", "c", str(rng.randint(1990, 2025)), *out]
    if rng.random() < 0.2:
        out = [*out, "all", "files", "in", "this", "folder"]
    return out or words


def fit(background: list[str], how: Training = Training()) -> Model:
    """A model from the templates and unlabelled paragraphs of the corpus; those that look like a template are left out."""
    rng = random.Random(how.seed)
    templates = [(family, WORD.findall(t.lower())) for family, all_ in TEMPLATES.items() for t in all_]
    families = [*TEMPLATES, UNKNOWN]
    sets = [(family, pairs(words)) for family, words in templates]
    examples = [(words, family) for family, words in templates]
    examples += [(altered(words, rng), family) for family, words in templates for _ in range(how.variants)]
    ordinary = [WORD.findall(t.lower()) for t in [*ORDINARY, *sorted(background)]]
    ordinary += [altered(WORD.findall(t.lower()), rng) for t in ORDINARY for _ in range(how.variants)]
    for words in ordinary:
        own = pairs(words)
        if words and all(len(own & t) < how.least_shared * min(len(own), len(t)) or not own for _, t in sets):
            examples.append((words, UNKNOWN))
    known = {p for _, t in sets for p in t}
    for words in ordinary:  # what a scan meets as chains
        for chain in chains([[(0, 0, w) for w in words]], known):
            run = [w for *_, w in chain]
            if largest_part(pairs(run), (t for _, t in sets), how.chain_pairs) < how.chain_shared:
                examples.append((run, UNKNOWN))
    grams_of = [(sorted(ngrams(words)), family) for words, family in examples]
    vocabulary = {gram: k for k, gram in enumerate(sorted({g for grams, family in grams_of if family != UNKNOWN for g in grams}))}
    others = Counter(g for grams, family in grams_of if family == UNKNOWN for g in grams if g not in vocabulary)
    for gram, _ in sorted(others.items(), key=lambda item: (-item[1], item[0]))[: how.background_ngrams]:
        vocabulary[gram] = len(vocabulary)
    rng.shuffle(examples)
    rows = np.zeros((len(examples), len(vocabulary)), np.float32)
    for row, (words, _) in zip(rows, examples):
        grams = ngrams(words)
        row[[vocabulary[g] for g in grams if g in vocabulary]] = 1 / math.sqrt(max(len(grams), 1))
    labels = np.array([families.index(family) for _, family in examples])
    kept_apart = np.arange(len(examples)) % 5 == 0
    x, y = rows[~kept_apart], labels[~kept_apart]
    weights, bias = np.zeros((len(vocabulary), len(families)), np.float32), np.zeros(len(families), np.float32)
    velocity = np.zeros_like(weights)
    for _ in range(how.steps):
        p = softmax(x @ weights + bias)
        p[np.arange(len(y)), y] -= 1
        velocity = 0.9 * velocity - how.rate * (x.T @ p / len(y) + how.penalty * weights)
        weights += velocity
        bias -= 0.1 * how.rate * p.mean(axis=0)
    model = Model(families, vocabulary, weights, bias)
    logits, truth = rows[kept_apart] @ weights + bias, labels[kept_apart]
    losses = {t: -np.log(softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in np.geomspace(0.05, 5, 40)}
    model.temperature = float(min(losses, key=losses.get))
    p = softmax(logits / model.temperature)
    wrong = p[:, :-1].max(axis=1)[p[:, :-1].argmax(axis=1) != truth]
    # Above all but one in a hundred of the family probabilities that would have been wrong.
    model.threshold = float(min(0.95, max(0.5, np.quantile(wrong, 0.99) if len(wrong) else 0.5)))
    model.templates = sets
    model.known_pairs = known
    return model


def softmax(logits: np.ndarray) -> np.ndarray:
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def background(docs: DataFrame, how: Training = Training()) -> list[str]:
    """At most ``how.background`` lines of the corpus, one of each of as many documents, chosen by a hash.

    Of a large corpus only documents under a bound of the hash are considered, some eight for each line wanted, so that partitions have few to send.
    """
    scale = 1 << 40
    bound = scale * 8 * how.background // max(docs.select("doc_id").count(), 1)
    hashed = F.xxhash64("doc_id", F.lit(how.seed))
    lines = F.split(F.col("text"), "\n")
    line = F.element_at(lines, (F.pmod(hashed, F.size(lines)) + 1).cast("int"))
    chosen = docs.filter(F.pmod(hashed, F.lit(scale)) < bound).filter("text IS NOT NULL")
    sample = chosen.select(F.substring(line, 1, 400).alias("line"), hashed.alias("hash"))
    return [r[0] for r in sample.filter("length(line) > 0").orderBy("hash", "line").limit(how.background).collect()]


FINDING = pa.struct(
    [("start", pa.int64()), ("end", pa.int64()), ("family", pa.string()), ("probability", pa.float64()), ("shared", pa.float64()), ("confirmed", pa.bool_())]
)
FINDING_DDL = "struct<start: long, end: long, family: string, probability: double, shared: double, confirmed: boolean>"


def finding(start: int, end: int, family: str, probability: float, shared: float, confirmed: bool) -> dict:
    return {"start": start, "end": end, "family": family, "probability": probability, "shared": shared, "confirmed": confirmed}


def scan(docs: DataFrame, how: Training = Training(), model: Model | None = None) -> DataFrame:
    """(doc_id, n_paragraphs, families, findings) of each row of ``docs`` (doc_id, text), whatever else it has.

    ``n_paragraphs`` are the lines with words.  ``findings`` are all paragraphs (pieces of them, where they are long) predicted to belong to a
    family, with their code points, probability, the share of word pairs in common with a template and whether that confirms them, and
    confirmed chains outside of confirmed paragraphs of their family; ``families`` the confirmed ones in order.  A null or
    empty text has no paragraphs and empty lists; repeated rows are scanned each for itself, null ids stay null; an empty table
    gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    if model is None:
        model = fit(background(docs, how), how)
    known = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        model, counts, families, findings = known.value, [], [], []
        for text in texts(batch):
            lines = paragraphs(text)
            read = [piece for line in lines for piece in pieces(line, how.piece_words)]
            found = []
            for (start, end, words), (family, probability) in zip(read, model.classify([words for *_, words in read])):
                if family != UNKNOWN:
                    shared = model.shared(words, family)
                    found.append(finding(start, end, family, probability, shared, shared >= how.least_shared))
            runs = [piece for chain in chains(lines, model.known_pairs) for piece in pieces(chain, how.piece_words)]
            inside = [(f["start"], f["end"], f["family"]) for f in found if f["confirmed"]]
            for (start, end, words), (family, probability) in zip(runs, model.classify([words for *_, words in runs])):
                if family != UNKNOWN and not any(a < end and start < b and name == family for a, b, name in inside):
                    part = model.held(words, family, how.chain_pairs)
                    if part >= how.chain_shared:
                        found.append(finding(start, end, family, probability, part, True))
            counts.append(len(lines))
            findings.append(found)
            families.append(sorted({f["family"] for f in found if f["confirmed"]}))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(families, pa.list_(pa.string())), pa.array(findings, pa.list_(FINDING))],
            names=["doc_id", "n_paragraphs", "families", "findings"],
        )

    return map_batches(docs, rows, f"doc_id long, n_paragraphs long, families array<string>, findings array<{FINDING_DDL}>")
