"""Licence scans: a trained classifier, a calibrated unknown class, and templates that confirm.

Paragraphs are blocks between lines without words, joined over line ends and comment marks. What is classified are
their lines and overlapping windows of their words, in several lengths, so that a notice is seen whole wherever it is
wrapped and whatever surrounds it. Features are hashed words and word pairs; a multinomial logistic regression
tells licence families from each other and from everything else. It is trained on the notices below, cut, thinned out
and embedded in other words, against a bounded sample of lines that resemble no notice, and windows of them. A
temperature and the probability from which a family is believed are set on examples kept aside. A prediction counts
only if the window holds enough of one of the family's notices, in word pairs that no better prediction rests on, and
if no other family's notice fits the same words better. A pair that many families use counts little, so that versions and
names decide.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm.common import staged, with_python

#: What short notices of the families say.
NOTICES = {
    "agpl-3.0": [
        "licensed under the GNU Affero General Public License version 3",
        "under the terms of the GNU Affero General Public License",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "bsd": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ],
    "cc-by": ["Licensed under CC BY 4.0.", "licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "cc0": ["Released into the public domain under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related rights"],
    "epl-2.0": [
        "Licensed under the Eclipse Public License 2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
        "made available under the terms of the Eclipse Public License v2.0 which accompanies this distribution",
    ],
    "gpl-2.0": [
        "licensed under the GNU General Public License, version 2.",
        "under the terms of the GNU General Public License version 2",
        "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    ],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "lgpl": [
        "licensed under the GNU Lesser General Public License",
        "under the terms of the GNU Lesser General Public License version 2.1",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License",
    ],
    "mit": [
        "MIT License",
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "proprietary": ["All rights reserved.", "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited"],
    "unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary",
    ],
    "zlib": [
        "Licensed under the zlib License.",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely",
    ],
}
#: The families' names in the standard identifier lines.
SPDX = {
    "agpl-3.0": ["AGPL-3.0"],
    "apache-2.0": ["Apache-2.0"],
    "bsd": ["BSD-2-Clause", "BSD-3-Clause"],
    "cc-by": ["CC-BY-4.0"],
    "cc-by-nc": ["CC-BY-NC-4.0"],
    "cc-by-sa": ["CC-BY-SA-4.0"],
    "cc0": ["CC0-1.0"],
    "epl-2.0": ["EPL-2.0"],
    "gpl-2.0": ["GPL-2.0"],
    "gpl-3.0": ["GPL-3.0"],
    "isc": ["ISC"],
    "lgpl": ["LGPL-2.1", "LGPL-3.0"],
    "mit": ["MIT"],
    "mpl-2.0": ["MPL-2.0"],
    "unlicense": ["Unlicense"],
    "zlib": ["Zlib"],
}
#: Says nothing about the licence of a text that names one.
RESERVED = "All rights reserved."
FAMILIES = tuple(sorted(NOTICES))
UNKNOWN = len(FAMILIES)
BITS = 16
#: Paragraphs outside licences that the classifier sees, at most (about), and copies made of each notice.
TRAIN_PARAGRAPHS, COPIES = 6_000, 60
#: Lengths and strides, in words, of the windows of a paragraph. Every notice lies whole in one of some length.
WINDOWS = ((12, 6), (24, 8), (48, 16))
#: Share of a notice's word pairs that a line or window must hold to confirm the family.
CONFIRMED = 0.6
#: Paragraphs outside licences that may pass the calibrated probability, as a share.
PASSING = 0.002
EPOCHS, BATCH, RATE, L2 = 6, 64, 0.5, 1e-5
REMEMBERED = 200_000
#: The weight of a word pair that one family alone uses.
WHOLE = 5040
#: Line ends, with the comment marks that are words where a line starts with one, and words.
_TOKEN = re.compile(r"\n(?:[^\w\n]*(?:rem|dnl|c)(?=[^\S\n]))?|\w+")


class _Words(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = -1 if word[0] == "\n" else zlib.crc32(word.encode())
        return value


def _read(text: str | None, words: _Words) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a text, and the number of each word's line."""
    found = _TOKEN.findall("\n" + text.lower()) if text else []
    hashes = np.fromiter(map(words.__getitem__, found), np.int64, len(found))
    return hashes[hashes >= 0], np.cumsum(hashes < 0)[hashes >= 0]


def _starts(line: np.ndarray, apart: int) -> np.ndarray:
    """Where the lines of words that are not empty (1 apart), or the paragraphs (2 apart), begin."""
    return np.append(0, 1 + np.flatnonzero(np.diff(line) >= apart))


def paragraphs(text: str | None, words: _Words) -> list[np.ndarray]:
    """Word hashes of every paragraph that holds a word."""
    p, line = _read(text, words)
    return np.split(p, _starts(line, 2)[1:]) if len(p) else []


def _units(line: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Starts and ends of what is classified: the lines, then the windows of each length, which end with their paragraph."""
    starts = _starts(line, 1)
    yield starts, np.append(starts[1:], len(line))
    starts = _starts(line, 2)
    ends = np.append(starts[1:], len(line))
    for length, stride in WINDOWS:
        number = 1 + np.maximum(0, -(-(ends - starts - length) // stride))
        owner = np.repeat(np.arange(len(starts)), number)
        begin = starts[owner] + stride * (np.arange(len(owner)) - (np.cumsum(number) - number)[owner])
        yield begin, np.minimum(begin + length, ends[owner])


def _pairs(p: np.ndarray) -> np.ndarray:
    return (p[1:] * 0x9E3779B1 + p[:-1] * 0x85EBCA77) & 0x7FFFFFFFFFFF


def features(p: np.ndarray) -> np.ndarray:
    """Hashed words and word pairs of one paragraph."""
    mixed = np.concatenate([p * 0xC2B2AE35 + 1, _pairs(p) * 0x27D4EB2F + 2])
    return (mixed ^ mixed >> 23) * 0x5851F42D >> 11 & (1 << BITS) - 1


def _notices() -> list[tuple[int, np.ndarray]]:
    words = _Words()
    spdx = {name: [f"SPDX-License-Identifier: {x}" for x in SPDX.get(name, ())] for name in FAMILIES}
    return [(k, paragraphs(n, words)[0]) for k, name in enumerate(FAMILIES) for n in NOTICES[name] + spdx[name]]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _logits(weights: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    return np.array([weights[0] + weights[1 + f].sum(axis=0) / np.sqrt(len(f)) for f in found])


def fit(others: list[np.ndarray]) -> tuple[np.ndarray, float, float]:
    """Weights (bias first), temperature and the probability from which a family is believed; one bounded set of examples."""
    rng = np.random.default_rng(5)
    notices = _notices()
    pairs = np.unique(np.concatenate([_pairs(n) for _, n in notices]))
    holds = np.array([np.isin(pairs, _pairs(n)) for _, n in notices]).astype(np.int64)
    others = [p for p in others if (holds @ np.isin(pairs, _pairs(p)) / holds.sum(axis=1)).max() < 0.3] or [np.arange(1, 9)]
    examples = [(features(p), UNKNOWN) for p in others]
    for p in others:
        length = WINDOWS[rng.integers(len(WINDOWS))][0]
        if len(p) > length:
            a = rng.integers(len(p) - length + 1)
            examples.append((features(p[a : a + length]), UNKNOWN))
    for family, notice in notices:
        room = next(length for length, stride in WINDOWS if length - stride >= len(notice)) - len(notice)
        for _ in range(COPIES):
            copy = notice[rng.random(len(notice)) > rng.choice([0.0, 0.0, 0.1, 0.2])]
            around = others[rng.integers(len(others))]
            a, b = rng.integers(0, 7, 2) if rng.random() < 0.5 else rng.multinomial(rng.integers(room + 1), [0.5, 0.5])
            examples.append((features(np.concatenate([around[:a], copy if len(copy) > 1 else notice, around[len(around) - b :]])), family))
    order = rng.permutation(len(examples))
    aside, used = order[: len(order) // 5], order[len(order) // 5 :]
    weights, seen = np.zeros((1 + (1 << BITS), UNKNOWN + 1)), np.full((1 + (1 << BITS), 1), 1e-6)
    for _ in range(EPOCHS):
        mixed = rng.permutation(used)
        for at in range(0, len(mixed), BATCH):
            rows = [examples[k] for k in mixed[at : at + BATCH]]
            p = _softmax(_logits(weights, [f for f, _ in rows]))
            p[np.arange(len(rows)), [y for _, y in rows]] -= 1
            index = np.concatenate([np.append(0, 1 + f) for f, _ in rows])
            value = np.concatenate([np.append(1.0, np.full(len(f), 1 / np.sqrt(len(f)))) for f, _ in rows])
            owner = np.repeat(np.arange(len(rows)), [len(f) + 1 for f, _ in rows])
            touched, place = np.unique(index, return_inverse=True)
            g = L2 * weights[touched]
            np.add.at(g, place, value[:, None] * p[owner] / len(rows))
            seen[touched] += (g * g).mean(axis=1, keepdims=True)
            weights[touched] -= RATE * g / np.sqrt(seen[touched])
    logits, truth = _logits(weights, [examples[k][0] for k in aside]), np.array([examples[k][1] for k in aside])
    chance = lambda t: -np.log(_softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean()
    temperature = float(min(np.geomspace(0.25, 8, 26), key=chance))
    family = _softmax(logits / temperature)[:, :UNKNOWN].max(axis=1)[truth == UNKNOWN]
    return weights.astype(np.float32), temperature, float(max(0.5, np.quantile(family, 1 - PASSING) if len(family) else 0.5))


def learn(docs: DataFrame, *, text_col: str = "text") -> tuple[np.ndarray, float, float]:
    """A model for the paragraphs of ``docs``, from a bounded sample of them fitted in one task."""
    total = max(1, docs.count())
    # Documents first: reading a few of them is enough. A hash of the line decides, so reruns agree.
    few = docs.filter(F.pmod(F.xxhash64(F.lit(9), text_col), F.lit(1_000_000)) < int(min(1.0, TRAIN_PARAGRAPHS / total) * 1_000_000) + 1)
    lines = few.select(F.explode(F.array_distinct(F.split(F.col(text_col), "\n"))).alias("line")).filter(F.col("line").rlike(r"\w"))
    lines = staged(lines.select("line", F.xxhash64(F.lit(9), "line").alias("h")), "licence-lines")
    share = min(1.0, TRAIN_PARAGRAPHS / max(1, lines.count()))
    chosen = lines.filter(F.pmod("h", F.lit(1_000_000)) < int(share * 1_000_000)).select("line").distinct()

    def fitted(rows: pd.DataFrame) -> pd.DataFrame:
        words = _Words()
        weights, temperature, believed = fit([p for line in sorted(rows["line"]) for p in paragraphs(line, words)[:1]])
        return pd.DataFrame({"weights": [weights.tobytes()], "temperature": [temperature], "believed": [believed]})

    model = with_python(chosen.withColumn("one", F.lit(1))).groupBy("one").applyInPandas(fitted, "weights binary, temperature double, believed double").head()
    if model is None:
        return np.zeros((1 + (1 << BITS), UNKNOWN + 1), np.float32), 1.0, 1.0
    return np.frombuffer(model["weights"], np.float32).reshape(-1, UNKNOWN + 1), model["temperature"], model["believed"]


class _Scanner:
    """Finds the licences of texts; one per task."""

    def __init__(self, weights: np.ndarray, temperature: float, believed: float) -> None:
        notices = _notices()
        self.words, self.weights, self.temperature, self.believed = _Words(), weights, temperature, believed
        self.family = np.array([family for family, _ in notices])
        self.pairs = np.unique(np.concatenate([_pairs(n) for _, n in notices]))
        self.holds = np.array([np.isin(self.pairs, _pairs(n)) for _, n in notices])
        used = np.array([self.holds[self.family == k].any(axis=0) for k in range(UNKNOWN)]).sum(axis=0)
        #: What a pair tells: the less, the more families use it. Whole numbers, so that sums are exact.
        self.weight = self.holds * (WHOLE // used)
        self.sizes = self.weight.sum(axis=1)
        self.reserved = next(k for k, (_, n) in enumerate(notices) if np.array_equal(n, paragraphs(RESERVED, self.words)[0]))

    def find(self, text: str | None) -> list[tuple[str, float, float, int]]:
        """(family, probability, similarity, line on which its paragraph starts) of the lines and windows that name a licence."""
        p, line = _read(text, self.words)
        pairs = _pairs(p)
        place = np.searchsorted(self.pairs, pairs).clip(max=len(self.pairs) - 1)
        at = np.flatnonzero(self.pairs[place] == pairs)
        ids = place[at]
        if not len(at):
            return []
        # Only what holds enough of a notice can be confirmed, so only that is classified. Repeated pairs count at first.
        counts = np.zeros((len(at) + 1, len(self.sizes)), np.int64)
        np.cumsum(self.weight.T[ids], axis=0, out=counts[1:])
        spans = []
        for start, end in _units(line):
            lo, hi = np.searchsorted(at, start), np.searchsorted(at, end - 1)
            some = np.flatnonzero(hi > lo)
            enough = (counts[hi[some]] - counts[lo[some]]) / self.sizes >= CONFIRMED
            some, enough = some[enough.any(axis=1)], enough[enough.any(axis=1)]
            spans += zip(start[some].tolist(), end[some].tolist(), lo[some].tolist(), hi[some].tolist(), strict=True)
            # And the words from the first to the last of a notice alone, as several may stand in a line.
            for k, notice in zip(*np.nonzero(enough), strict=True):
                own = lo[some[k]] + np.flatnonzero(self.holds[notice, ids[lo[some[k]] : hi[some[k]]]])
                spans.append((int(at[own[0]]), int(at[own[-1]]) + 2, int(own[0]), int(own[-1]) + 1))
        spans = sorted(set(spans))
        if not spans:
            return []
        chances = _softmax(_logits(self.weights, [features(p[a:b]) for a, b, _, _ in spans]) / self.temperature)
        found = []
        for k in np.flatnonzero((chances.argmax(axis=1) != UNKNOWN) & (chances.max(axis=1) >= self.believed)).tolist():
            start, _, lo, hi = spans[k]
            family, chance = int(chances[k].argmax()), float(chances[k].max())
            distinct = np.unique(ids[lo:hi])
            alike = self.weight[:, distinct].sum(axis=1) / self.sizes
            notice = int(np.where(self.family == family, alike, 0).argmax())
            # A notice of another family that fits better, and mostly by the same words, is what stands there.
            mine = self.holds[notice, distinct]
            shared = (self.holds[:, distinct] & mine).sum(axis=1) * 2 > mine.sum()
            if alike[notice] >= CONFIRMED and not (shared & (alike > alike[notice]) & (self.family != family)).any():
                found.append((-float(alike[notice]), -chance, start, family, notice, lo, hi))
        # Windows that cut a notice may take it for another family's: a word pair counts for the best prediction's family only.
        owner, kept = np.full(len(at), -1), []
        blocks = _starts(line, 2)
        for alike, chance, start, family, notice, lo, hi in sorted(found):
            own = lo + np.flatnonzero(self.holds[notice, ids[lo:hi]])
            own = own[(owner[own] < 0) | (owner[own] == family)]
            if self.weight[notice, np.unique(ids[own])].sum() >= CONFIRMED * self.sizes[notice]:
                owner[own] = family
                kept.append((FAMILIES[family], -chance, -alike, int(line[blocks[np.searchsorted(blocks, start, "right") - 1]]), notice))
        named = any(k[-1] != self.reserved for k in kept)
        return [k[:-1] for k in kept if not named or k[-1] != self.reserved]


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ``licences`` (families in order), ``paragraphs`` (that name one), ``probability`` and ``similarity`` (the best) of every row.

    Every line and window of every text is looked at. Null, empty and unlicensed texts have no licences, 0 paragraphs
    and null figures; so do texts that only some unknown licence stands in. Rights reserved are no licence where the text
    names one. Repeated rows, null ids and empty tables are fine; other columns are not read.
    """
    weights, temperature, believed = learn(docs, text_col=text_col)
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # of fixed size

    def classify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = _Scanner(shared.value, temperature, believed)
        for batch in batches:
            rows = []
            for text in batch["text"]:
                found = scanner.find(text)
                best = [max((f[k] for f in found), default=None) for k in (1, 2)]
                rows.append((sorted({f[0] for f in found}), len({f[3] for f in found}), *best))
            out = pd.DataFrame(rows, columns=["licences", "paragraphs", "probability", "similarity"])
            yield pd.concat([batch[["doc_id"]].reset_index(drop=True), out], axis=1)

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    return with_python(texts).mapInPandas(
        classify, f"doc_id {kind}, licences array<string>, paragraphs int, probability double, similarity double"
    )
