"""Licence notices by a paragraph classifier, each confirmed by comparison with a template.

1. Consecutive lines that are not blank are a paragraph, however they are wrapped; a long one is taken in windows of WINDOW_WORDS words that overlap
   by half. All windows are rated that can confirm a template at all: each of those has a word of GATE, as CONFIRMED leaves out fewer words of a
   template than are in GATE.
2. A logistic regression per family on sparse word n-grams (one to three words, hashed) rates the stretches of a window that match
   a template. It is trained on the templates, on variants of them, and on a bounded sample of lines of the corpus without cues and of cue
   words in other surroundings, which are the class "unknown".
3. The probability below which a line is unknown is calibrated: the largest at which held-out variants are still
   recognised, but no less than any held-out unknown line reaches.
4. A family is confirmed where the stretch holds a share of the template's words, in order, of at least CONFIRMED. What lies before and behind a
   confirmed notice is rated again, so a window can hold several.
5. Lines with a word of CUES outside all confirmed notices are unknown.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import id_and_text
from .hashed_text import Rows, as_rows, logistic, sigmoid

# Notices by which licences are applied, by family.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."],
    "MIT": ["Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.", "This project is licensed under the terms of the MIT license."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", "This program is free software; you can redistribute it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or any later version."],
    "LGPL": ["This library is licensed under the GNU Lesser General Public License, version 2.1.", "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3.", "Distributed under the terms of the GNU Affero General Public License.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.", "Use of this source code is governed by a BSD-style license.", "Licensed under the BSD 3-Clause License."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License 2.0."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.", "Licensed under the ISC License."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["Dedicated to the public domain under CC0 1.0.", "To the extent possible under law, the author has waived all copyright under Creative Commons Zero."],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "Released under the Unlicense."],
    "Proprietary": ["All rights reserved. No part of this work may be reproduced without permission.", "This material is proprietary and confidential."],
}
CUES = ["license", "licensed", "licence", "licenced", "copyright", "permission", "redistribution", "redistribute", "unlicense", "cc0", "reserved", "proprietary", "licenses", "spdx", "unencumbered", "isc", "mpl"]
UNKNOWN = "unknown"
#: Variants of a template, and lines of the corpus, that are learned from.
VARIANTS, CORPUS_LINES = 60, 4_000
CONFIRMED = 0.7
_PLACES = 1 << 18
_WORD = re.compile(r"[a-z0-9][a-z0-9.]*[a-z0-9]|[a-z0-9]")
_CUE = r"(?i)\b(" + "|".join(CUES) + r"|redistributions|cc[ -]by)\b"
#: Every template has more words of these than CONFIRMED lets be absent.
GATE = ["license", "licensed", "released", "4.0", "apache", "mozilla", "clause", "dedicated", "domain", "cc0", "unlicense", "proprietary", "confidential", "reserved",
        "rights", "reproduced", "permission", "hereby", "granted", "charge", "obtaining", "copy", "software", "associated", "documentation", "files", "permitted",
        "redistribution", "redistribute", "modification", "binary", "forms", "source", "governed", "bsd", "style", "code", "gnu", "public", "general", "affero",
        "lesser", "library", "version", "terms", "compliance", "distribute", "distributed", "modify", "purpose", "fee", "extent", "waived", "copyright", "creative",
        "commons", "attribution", "international", "unencumbered", "mit", "conditions", "program", "published", "foundation"]
#: A notice of up to half as many words stands whole in one window.
WINDOW_WORDS = 120


def words_of(line: str) -> list[str]:
    return _WORD.findall(line.lower())


def places_of(words: list[str]) -> np.ndarray:
    grams = {" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)}
    return np.unique(np.array([xxhash.xxh3_64_intdigest(g) % _PLACES for g in grams], np.int64))


def variants(template: list[str], filler: list[list[str]], rng, n: int) -> list[list[str]]:
    """The template with words left out, and set among words of the corpus."""
    out = []
    for _ in range(n):
        words = [w for w in template if rng.random() > rng.choice([0.0, 0.05, 0.1])]
        around = filler[rng.integers(len(filler))] if filler else []
        cut = int(rng.integers(0, len(around) + 1)) if rng.random() < 0.5 else 0
        out.append(around[:cut] + words + (around[cut:cut + 20] if rng.random() < 0.3 else []))
    return out


@dataclass
class Families:
    """``weights[f]`` by place and a constant per family; ``least`` is the calibrated probability of a known family."""

    names: list[str]
    places: np.ndarray
    weights: np.ndarray
    constants: np.ndarray
    least: float

    def rate(self, words: list[str]) -> np.ndarray:
        """Probability of each family."""
        places = places_of(words)
        at = np.minimum(np.searchsorted(self.places, places), len(self.places) - 1)
        return sigmoid(self.weights[:, at[self.places[at] == places]].sum(axis=1) + self.constants)

    def notices(self, words: list[str]) -> list[tuple[int, int, str, float, float]]:
        """Confirmed notices (start, end, family, probability, share) in the words of a paragraph, by place and without overlap."""
        step = WINDOW_WORDS // 2
        waiting = [(a, min(a + WINDOW_WORDS, len(words))) for a in range(0, max(len(words) - step, 1), step)]
        hits = []
        while waiting:
            a, b = waiting.pop()
            if hit := self._longest(words[a:b]):
                matched, s, e, *rest = hit
                hits.append((matched, a + s, a + e, *rest))
                waiting += [(a, a + s), (a + e, b)]
        kept: list[tuple] = []
        for matched, s, e, *rest in sorted(hits, key=lambda h: (-h[0], h[1])):
            if all(e <= k[0] or k[1] <= s for k in kept):
                kept.append((s, e, *rest))
        return sorted(kept)

    def _longest(self, words: list[str]) -> tuple | None:
        """(words matched, start, end, family, probability, share) of the confirmed notice with most words, if there is one."""
        held = set(words)
        if held.isdisjoint(GATE):
            return None
        spans = []
        for family, template in _templates():
            least = math.ceil(CONFIRMED * len(template) - 1e-9)
            if sum(t in held for t in template) >= least and (m := matched_span(words, template))[0] >= least:
                spans.append((m[1], m[2], m[0], family, m[0] / len(template)))
        regions: list[list[tuple]] = []
        for span in sorted(spans):
            if regions and span[0] < max(x[1] for x in regions[-1]):
                regions[-1].append(span)
            else:
                regions.append([span])
        best = None
        for region in regions:
            p = self.rate(words[region[0][0]:max(x[1] for x in region)])
            # Of the families that the classifier takes the stretch for, the one with most words confirmed, then the likeliest.
            for s, e, n, name, share in region:
                f = self.names.index(name)
                if p[f] >= self.least and (best is None or (n, p[f]) > (best[0], best[4])):
                    best = n, s, e, name, float(p[f]), share
        return best

    def classify(self, line: str) -> tuple[str, float, float]:
        """(family or unknown, probability, share of the best template of that family)."""
        words = words_of(line)
        p = self.rate(words)
        best = int(np.argmax(p))
        name, share = self.names[best], max(template_share(words, words_of(t)) for t in TEMPLATES[self.names[best]])
        if p[best] < self.least or share < CONFIRMED:
            return UNKNOWN, float(p[best]), share
        return name, float(p[best]), share


def template_share(words: list[str], template: list[str]) -> float:
    """Longest common subsequence of the two, as a share of the template."""
    row = np.zeros(len(template) + 1, np.int64)
    wanted = set(template)
    for w in words:
        if w in wanted:
            hit = np.append(0, row[:-1] + np.array([t == w for t in template]))
            row = np.maximum.accumulate(np.maximum(row, hit))
    return float(row[-1]) / len(template)


@cache
def _templates() -> list[tuple[str, list[str]]]:
    return [(name, words_of(t)) for name, texts in TEMPLATES.items() for t in texts]


def _reach(words: list[str], template: list[str]) -> tuple[int, int]:
    """Length of the longest common subsequence, and after how many words it is first reached; a bit per word of the template."""
    masks: dict[str, int] = {}
    for i, t in enumerate(template):
        masks[t] = masks.get(t, 0) | 1 << i
    full = (1 << len(template)) - 1
    row, most, end = full, 0, 0
    for at, w in enumerate(words, 1):
        if w in masks:
            hit = row & masks[w]
            row = ((row + hit) | (row - hit)) & full
            if (n := len(template) - row.bit_count()) > most:
                most, end = n, at
    return most, end


def matched_span(words: list[str], template: list[str]) -> tuple[int, int, int]:
    """(length of the longest common subsequence, start, end) of the first stretch of words that holds it, as short as its end allows."""
    n, end = _reach(words, template)
    return n, end - _reach(words[:end][::-1], template[::-1])[1], end


def paragraphs(text: str) -> list[tuple[list[str], list[int]]]:
    """Words of each run of lines that are not blank, and the line of each word."""
    out, words, places = [], [], []
    for at, line in enumerate(text.split("\n")):
        if line.strip():
            found = words_of(line)
            words += found
            places += [at] * len(found)
        elif words:
            out.append((words, places))
            words, places = [], []
    return [*out, (words, places)] if words else out


def notices_of(text: str, model: Families) -> list[tuple[int, str, float, float]]:
    """(line, family, probability, share): confirmed notices by their first line, and lines with a cue outside them."""
    found, covered = [], set()
    for words, places in paragraphs(text):
        for start, end, *rest in model.notices(words):
            found.append((places[start], *rest))
            covered.update(places[start:end])
    cue = _cue()
    for at, line in enumerate(text.split("\n")):
        if at not in covered and cue.search(line):
            found.append((at, *model.classify(line)))
    return sorted(found)


@cache
def _cue() -> re.Pattern:
    return re.compile(_CUE, re.ASCII)


def train_families(lines: list[str], seed: int = 5) -> Families:
    """Fit on the templates and on ``lines`` of the corpus that name no licence."""
    rng = np.random.default_rng(seed)
    names, filler = list(TEMPLATES), [w for w in map(words_of, lines) if w]
    texts, family, held = [], [], []
    for f, name in enumerate(names):
        for template in map(words_of, TEMPLATES[name]):
            some = [template, *variants(template, filler, rng, VARIANTS)]
            texts += some
            family += [f] * len(some)
            held += [i % 5 == 4 for i in range(len(some))]
    cues = [c for c in CUES for _ in range(20)]
    strangers = filler + [(filler[rng.integers(len(filler))] if filler else ["text"])[:10] + [c, "the", "of"] for c in cues]
    texts += strangers
    family += [-1] * len(strangers)
    held += [i % 5 == 4 for i in range(len(strangers))]
    rows, family, held = as_rows([places_of(t) for t in texts], 0, 1), np.array(family), np.array(held)
    k, weights, constants = len(rows.names), [], []
    learned: Rows = rows.some(~held)
    for f in range(len(names)):
        w = logistic(learned, np.zeros((learned.n, 0)), (family[~held] == f).astype(float))
        weights.append(w[:k])
        constants.append(w[-1])
    weights, constants = np.array(weights), np.array(constants)
    checked = rows.some(held)
    p = sigmoid(np.stack([checked.times(w) for w in weights]) + constants[:, None]).max(axis=0)
    known = family[held] >= 0
    least = max(min(0.9, float(np.quantile(p[known], 0.02))), float(np.quantile(p[~known], 0.999)) if (~known).any() else 0.0)
    used = weights.any(axis=0)
    return Families(names, rows.names[used], weights[:, used], constants, least)


def corpus_lines(docs: DataFrame, rows: int = CORPUS_LINES, id_col: str = "doc_id", text_col: str = "text") -> list[str]:
    """First lines without cues of at most ``rows`` documents, those of the smallest hashes of the id; they come to the driver."""
    source = id_and_text(docs, id_col, text_col)
    chosen = source.select("doc_id").orderBy(F.xxhash64("doc_id")).limit(rows).distinct()
    line = F.substring_index("text", "\n", 1).substr(1, 400)
    found = source.join(F.broadcast(chosen), "doc_id").select("doc_id", line.alias("line")).filter(~F.col("line").rlike(_CUE))
    return [r["line"] for r in found.orderBy(F.xxhash64("doc_id"), "line").limit(rows).collect()]


def license_notices(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", corpus_rows: int = CORPUS_LINES) -> DataFrame:
    """Rows (doc_id, families, unknown_lines, notices), one per row of ``docs``.

    ``families``: the confirmed families of the text, sorted; ``unknown_lines``: lines with a cue outside confirmed notices;
    ``notices``: ARRAY<STRUCT<line, family, probability, share>> of both, ``line`` being a notice's first, counted from 0. A null or
    empty text has none. Only texts with a cue or a word of GATE leave the JVM.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train_families(corpus_lines(docs, corpus_rows, id_col, text_col)))
    gate = "|".join([r"(?i)" + "|".join(re.escape(w) for w in GATE), _CUE])  # GATE as parts of words: more than whole words can be
    notice = pa.struct([("line", pa.int32()), ("family", pa.string()), ("probability", pa.float64()), ("share", pa.float64())])

    def scan(batches):
        model = shared.value
        for b in batches:
            found = [[dict(zip(("line", "family", "probability", "share"), x)) for x in notices_of(text, model)] if text else [] for text in b["text"].to_pylist()]
            families = [sorted({x["family"] for x in f} - {UNKNOWN}) for f in found]
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array(families, pa.list_(pa.string())), pa.array([sum(x["family"] == UNKNOWN for x in f) for f in found], pa.int64()), pa.array(found, pa.list_(notice))],
                ["doc_id", "families", "unknown_lines", "notices"])

    return id_and_text(docs, id_col, text_col).select("doc_id", F.when(F.col("text").rlike(gate), F.col("text")).alias("text")).mapInArrow(
        scan, "doc_id bigint, families array<string>, unknown_lines bigint, notices array<struct<line:int,family:string,probability:double,share:double>>")
