"""Licence scan by a trained paragraph classifier.

A paragraph is a block of lines without a blank one between them. Every line of it is classified, and
every run of its words, over whatever lines, that has enough word pairs of a template in a stretch of
about the template's length: a wrapped notice is judged as a whole, and each of several notices of a
paragraph by itself. The classifier: a softmax regression over hashed word n-grams
(one and two words) tells licence families apart from one another and from ``unknown``, which stands
for ordinary text and for licences not among the families. It is trained here: positives are the
families' notices and variants of them (comment marks, other years and names, words left out) and
notices made of the licences' names; negatives are paragraphs of a bounded sample of the documents
(``sample`` of them), notices whose telling words were exchanged and sentences that talk of a licence. The unknown class is calibrated on variants and paragraphs kept
aside: a temperature and the lowest family probability that lets at most ``slips`` of them
through. A line that is surely a notice of some family is of those whose names it has; every other family has to pass
by its own probability, and is confirmed only if the line or run shares enough word pairs with one
of that family's templates, or the line has one of its names whole; a run also needs a word that tells the
template's licence, if it has one. Versions are not told apart. Works that are in the public domain without a licence
are ``unknown``.

Cases: null and empty texts have no licence; paragraphs of any length are read whole; repeated rows each
give a row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodbook.llm.common import batches, hashes, rolling

# Short notices by which works name their licence.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License 2.0.",
        "Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GNU GPL v3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Licensed under the GNU General Public License version 2.",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-3.0-only",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
    ),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "BSD": (
        "Released under the BSD 3-Clause License.",
        "Licensed under the BSD license.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY-NC-SA 4.0.",
        "Licensed under CC BY-NC-ND 4.0.",
    ),
    "CC0": (
        "This work is dedicated to the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work (CC0).",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Released under the Unlicense.",
    ),
    "Proprietary": (
        "All rights reserved.",
        "All rights reserved. No part of this work may be reproduced without prior written permission.",
    ),
}
# Names of licences, as notices and headings give them, and the notices that are made of them.
NAMES = {
    "MIT": ("MIT", "MIT License", "The MIT License (MIT)", "MIT/X11 License", "Expat License"),
    "Apache-2.0": ("Apache License", "Apache License 2.0", "Apache License, Version 2.0", "Apache 2.0", "Apache-2.0", "Apache Software License"),
    "GPL": ("GPL", "GNU GPL", "GPLv2", "GPLv3", "GPL-2.0", "GPL-3.0", "GPL version 2", "GNU General Public License", "GNU General Public License v2.0", "GNU General Public License, version 3", "GNU Public License"),
    "LGPL": ("LGPL", "GNU LGPL", "LGPLv2", "LGPLv3", "LGPL-2.1", "LGPL-3.0", "GNU Lesser General Public License", "GNU Library General Public License", "GNU Lesser General Public License, version 3"),
    "AGPL": ("AGPL", "GNU AGPL", "AGPLv3", "AGPL-3.0", "GNU Affero General Public License", "Affero General Public License", "GNU Affero General Public License, version 3"),
    "BSD": ("BSD", "BSD License", "BSD 2-Clause License", "BSD 3-Clause License", "BSD-2-Clause", "BSD-3-Clause", "New BSD License", "Simplified BSD License", "Modified BSD License"),
    "MPL-2.0": ("MPL", "MPL 2.0", "MPL-2.0", "Mozilla Public License", "Mozilla Public License 2.0", "Mozilla Public License, Version 2.0"),
    "CC-BY": (
        "CC BY", "CC BY 3.0", "CC BY 4.0", "CC BY-SA", "CC BY-SA 3.0", "CC BY-SA 4.0", "Creative Commons Attribution", "Creative Commons Attribution License",
        "Creative Commons Attribution 3.0 Unported License", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution-ShareAlike", "Creative Commons Attribution-ShareAlike 3.0 Unported License",
    ),
    "CC-BY-NC": (
        "CC BY-NC", "CC BY-NC 3.0", "CC BY-NC 4.0", "CC BY-NC-SA", "CC BY-NC-SA 3.0", "CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial", "Creative Commons Attribution-NonCommercial 3.0 Unported License",
        "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
    ),
    "CC0": ("CC0", "CC0 1.0", "CC0-1.0", "CC0 1.0 Universal", "Creative Commons Zero"),
    "Unlicense": ("Unlicense", "The Unlicense"),
    "ISC": ("ISC", "ISC License", "The ISC License"),
    "BSL-1.0": ("BSL-1.0", "Boost Software License", "Boost Software License 1.0", "Boost Software License, Version 1.0"),
    "EPL": ("EPL", "EPL 1.0", "EPL-2.0", "Eclipse Public License", "Eclipse Public License 2.0", "Eclipse Public License - v 2.0", "Eclipse Public License, Version 1.0"),
}
FRAMES = (
    "{}", "License: {}", "Licence: {}", "Licensed under {}", "Licensed under the {}", "Released under the {}", "This code is licensed under the {}", "This project is {} licensed",
    "Distributed under the terms of the {}", "SPDX-License-Identifier: {}", "Available under {}", "Published under the {}", "This work is made available under the {}", "Copyright the authors, {}",
    "Copyright (c) 2010 The Authors. All files: {}", "Use of this program is governed by the {}", "Subject to the terms of the {}", "Terms and conditions: {}", "The {} covers all files of this package",
    "You can copy and change this library in accordance with the {}", "Our software comes with the {}", "The files in this folder fall under the {}.", "This package is free software; see the {} for details",
)
# A licence that is talked of is not a notice.
MENTIONS = (
    "We compared the {} with others in last week's lecture and found many differences.", "The history of the {} begins decades ago and fills a whole chapter of the book.",
    "He wrote an article about the {} for a magazine.", "Critics of the {} say that it goes too far.", "Students at {} built a robot last summer.",
    "I do not understand why anybody would choose {} today.", "Did you read what she said about {} on the list?", "Lawyers have argued over {} for years, and a judge had to decide.",
    "The panel on {} was the best part of the conference.", "According to the newspaper, most firms avoid {} when they can.", "Their talk explained how {} came about and who opposed it.",
    "The authors of {} never thought that it would be so widely used, he told us.", "My question is whether {} still matters.", "Last year {} was in the news again because of a law suit.",
    "There is a long debate on {} between its friends and its enemies.", "Some people think {} is too strict; others like it.", "What is {} and where does it come from?",
)
TEMPLATES |= {
    "ISC": (
        "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "BSL-1.0": ("Distributed under the Boost Software License, Version 1.0.",),
    "EPL": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0.", "SPDX-License-Identifier: EPL-2.0"),
}
FAMILIES = tuple(TEMPLATES)
UNKNOWN = len(FAMILIES)
TELLING = frozenset("mit apache gnu gpl lgpl agpl bsd mozilla mpl cc cc0 creative unlicense affero lesser isc boost eclipse epl".split())
WORD = re.compile(r"\w+")
BITS = 16
RESULT = "doc_id long, licences array<string>, licence string, probability double, likeness double, paragraphs int"


def words(paragraph: str) -> list[str]:
    return WORD.findall(paragraph.lower())


def features(h: np.ndarray) -> np.ndarray:
    """Feature numbers of one and two words, from word hashes."""
    return (np.concatenate([h, rolling(h, 2)]) >> np.uint64(64 - BITS)).astype(np.int64)


def pairs(ws: list[str]) -> set:
    return set(zip(ws, ws[1:], strict=False)) or {tuple(ws)}


PAIRS = {name: [pairs(words(t)) for t in ts] for name, ts in TEMPLATES.items()}


def likeness(ws: list[str], family: str) -> float:
    """Share of a template's word pairs that the paragraph has, for the family's closest template."""
    own = pairs(ws)
    return max(len(own & t) / len(t) for t in PAIRS[family])


CALLED = {tuple(words(n)): family for family, names in NAMES.items() for n in names}
LONGEST = max(map(len, CALLED))
FIRST = frozenset(n[0] for n in CALLED)
# names that are ordinary words or stand for other things as well
AMBIGUOUS = frozenset((w,) for w in "mit isc bsd epl mpl".split())


def named(ws: list[str]) -> set[str]:
    """The families whose names the line has; of names inside one another the longest counts, and an ambiguous one only beside a word of licensing."""
    out, at = set(), 0
    while at < len(ws):
        step = 1
        if ws[at] in FIRST:
            for n in range(min(LONGEST, len(ws) - at), 0, -1):
                name = tuple(ws[at : at + n])
                family = CALLED.get(name)
                if family and (name not in AMBIGUOUS or any(w == "under" or w.startswith(("licen", "spdx")) for w in ws)):
                    out.add(family)
                    step = n
                    break
        at += step
    return out


def confirmed(ws: list[str], family: str) -> float:
    """How like the line is to what the family's notices say: 1 if it has one of its names whole, else its likeness to a template."""
    return 1.0 if family in named(ws) else likeness(ws, family)


# all templates' word pairs by hash, and which template has which
KNOWN = [(name, words(t), p) for name, ts in TEMPLATES.items() for t, p in zip(ts, PAIRS[name], strict=True)]
_hash = {p: rolling(hashes(list(p)), 2)[0] for _, _, ps in KNOWN for p in ps}
PAIR_HASHES = np.unique(np.array(list(_hash.values()), np.uint64))
HAS = np.array([np.isin(PAIR_HASHES, [_hash[p] for p in ps]) for _, _, ps in KNOWN])


def runs(two: np.ndarray, block: np.ndarray, confirm: float) -> list[tuple[int, int, int]]:
    """(template, first word, last word) of the stretches of words that have ``confirm`` of a template's pairs.

    ``two`` are the hashes of the pairs of neighbouring words, ``block`` the paragraph of each, -1 where a pair crosses
    paragraphs. Of a stretch that reaches the share, the shortest part that does and the longest one are given.
    """
    slot = np.searchsorted(PAIR_HASHES, two).clip(max=len(PAIR_HASHES) - 1)
    at = np.flatnonzero((PAIR_HASHES[slot] == two) & (block >= 0))
    if not len(at):
        return []
    slot, block = slot[at], block[at]
    need = np.array([max(1, int(np.ceil(confirm * len(ps) - 1e-9))) for _, _, ps in KNOWN])
    blocks, inverse = np.unique(block, return_inverse=True)
    found = np.unique(inverse * len(PAIR_HASHES) + slot)
    which, pair = np.divmod(found, len(PAIR_HASHES))
    counts = np.add.reduceat(HAS[:, pair].astype(np.int64), np.searchsorted(which, np.arange(len(blocks))), axis=1)
    bounds = np.searchsorted(inverse, np.arange(len(blocks) + 1))
    out = []
    for t, b in np.argwhere(counts >= need[:, None]):
        own = slice(bounds[b], bounds[b + 1])
        hit = HAS[t, slot[own]]
        place, kind = at[own][hit].tolist(), slot[own][hit].tolist()
        span = int(1.5 * len(KNOWN[t][1])) + 2
        held: dict[int, int] = {}
        left, tight, best = 0, None, 0
        for right in range(len(place)):
            if tight and place[right] - tight[0] > span:
                out += [(int(t), *tight), (int(t), tight[0], place[last] + 1)]
                left, tight, held = last + 1, None, {}
                for k in kind[left:right]:
                    held[k] = held.get(k, 0) + 1
            held[kind[right]] = held.get(kind[right], 0) + 1
            if tight:
                if len(held) > best:
                    best, last = len(held), right
                continue
            while place[right] - place[left] > span or held[kind[left]] > 1:
                held[kind[left]] -= 1
                if not held[kind[left]]:
                    del held[kind[left]]
                left += 1
            if len(held) >= need[t]:
                tight, best, last = (place[left], place[right] + 1), len(held), right
        if tight:
            out += [(int(t), *tight), (int(t), tight[0], place[last] + 1)]
    return list(dict.fromkeys(out))


def split_lines(texts: list) -> tuple[list[int], list[list[str]], list[int]]:
    """For each line with words: its text's number, its words, and the number of its paragraph."""
    owner, rows, block = [], [], []
    blocks = 0
    for i, t in enumerate(texts):
        blocks += 1
        for p in t.split("\n") if t else ():
            if ws := words(p):
                owner.append(i)
                rows.append(ws)
                block.append(blocks)
            elif not p.strip():
                blocks += 1
    return owner, rows, block


def within_blocks(block: list[int], own: np.ndarray) -> np.ndarray:
    """The paragraph of each pair of neighbouring words, whose lines are ``own``; -1 between paragraphs."""
    of_word = np.array(block)[own]
    return np.where(of_word[:-1] == of_word[1:], of_word[:-1], -1)


def ordinary_lines(texts: list, least: float = 0.5) -> list[list[str]]:
    """Words of the lines that neither have nor are part of something that has ``least`` of a template's pairs."""
    _, rows, block = split_lines(texts)
    if not rows:
        return []
    own = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    flat = [w for r in rows for w in r]
    taken = set()
    for t, x, y in runs(rolling(hashes(flat), 2), within_blocks(block, own), least):
        telling = TELLING & set(KNOWN[t][1])
        if not telling or telling & set(flat[x : y + 1]):
            taken.update(range(own[x], own[y] + 1))
    return [ws for k, ws in enumerate(rows) if k not in taken and not named(ws) and max(likeness(ws, f) for f in FAMILIES) < least]


def variants(rng: np.random.Generator, copies: int) -> tuple[list[list[str]], list[int]]:
    rows, labels = [], []
    for k, name in enumerate(FAMILIES):
        for text in TEMPLATES[name]:
            own = words(text)
            for c in range(copies):
                drop = rng.random(len(own)) < (0.0 if c == 0 else 0.06)
                kept = [w for w, d in zip(own, drop, strict=True) if not d]
                lead = [["copyright", str(1990 + int(rng.integers(40))), "the", "authors"], ["this", "file", "is"], []][int(rng.integers(3)) if c else 2]
                rows.append(lead + kept)
                labels.append(k)
            # the same notice without the words that name the licence
            if TELLING & set(own):
                rows += [[f"x{rng.integers(1 << 30)}" if w in TELLING else w for w in own]] * 2
                labels += [UNKNOWN] * 2
    for name, called in NAMES.items():
        for n in called:
            rows += [words(frame.format(n)) for frame in FRAMES]
            labels += [FAMILIES.index(name)] * len(FRAMES)
            rows += [words(m.format(n)) for m in MENTIONS]
            labels += [UNKNOWN] * len(MENTIONS)
    return rows, labels


@dataclass(frozen=True)
class Licences:
    weights: np.ndarray  # features x classes
    bias: np.ndarray
    temperature: float
    least: float

    def probabilities(self, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        sums = np.zeros((len(sizes), len(self.bias)))
        full = sizes > 0
        sums[full] = np.add.reduceat(self.weights[flat], starts[full], axis=0) / np.sqrt(sizes[full])[:, None]
        z = (sums + self.bias) / self.temperature
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def _flat(rows: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    fs = [features(hashes(r)) for r in rows]
    sizes = np.array([len(f) for f in fs])
    return np.concatenate(fs) if fs else np.zeros(0, np.int64), np.cumsum(sizes) - sizes, sizes


def train(docs: DataFrame, sample: int = 500, slips: float = 0.0005, copies: int = 24, steps: int = 200) -> Licences:
    """``sample`` documents, those with the smallest hashes of their ids, give the ordinary paragraphs."""
    known = docs.filter("doc_id is not null and text is not null").select("doc_id", "text")
    # ids are chosen first, so that texts of ``sample`` documents only leave the executors, one for each id
    few = known.select("doc_id").distinct().orderBy(F.xxhash64("doc_id", F.lit("licence")), "doc_id").limit(sample)
    texts = known.join(F.broadcast(few), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")).orderBy("doc_id")
    rng = np.random.default_rng(7)
    ordinary = ordinary_lines([r.text for r in texts.toLocalIterator()])
    rows, labels = variants(rng, copies)
    rows, labels = rows + ordinary, np.array(labels + [UNKNOWN] * len(ordinary))
    aside = rng.random(len(rows)) < 0.25
    classes = len(FAMILIES) + 1
    flat, _, sizes = _flat([r for r, x in zip(rows, aside, strict=True) if not x])
    y = np.eye(classes)[labels[~aside]]
    weight = (1.0 / np.maximum(y.sum(axis=0), 1))[labels[~aside]]
    weight /= weight.sum()
    row = np.repeat(np.arange(len(sizes)), sizes)
    w, b = np.zeros((1 << BITS, classes), np.float64), np.zeros(classes)
    # what a single paragraph has tells nothing of others
    again = np.bincount(flat, minlength=1 << BITS)[flat] > 1
    row, flat = row[again], flat[again]
    used, place = np.unique(flat, return_inverse=True)
    local, v, vb = np.zeros((len(used), classes)), np.zeros((len(used), classes)), np.zeros(classes)
    root = np.sqrt(np.maximum(sizes, 1))[:, None]
    for _ in range(steps):  # Adagrad on the features that occur
        z = np.stack([np.bincount(row, local[place, k], len(sizes)) for k in range(classes)], 1) / root + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        e = (p - y) * weight[:, None]
        g = np.stack([np.bincount(place, (e / root)[row, k], len(used)) for k in range(classes)], 1) + 1e-6 * local
        v, vb = v + g * g, vb + e.sum(axis=0) ** 2
        local -= 0.3 * g / (np.sqrt(v) + 1e-9)
        b -= 0.3 * e.sum(axis=0) / (np.sqrt(vb) + 1e-9)
    w[used] = local
    held, truth = _flat([r for r, x in zip(rows, aside, strict=True) if x]), labels[aside]
    raw = Licences(w, b, 1.0, 0.5)
    best = min(
        (float(-np.mean(np.log(np.maximum(Licences(w, b, t, 0.5).probabilities(*held)[np.arange(len(truth)), truth], 1e-12)))), t) for t in (0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0)
    ) if len(truth) else (0.0, 1.0)
    p = Licences(w, b, best[1], 0.5).probabilities(*held) if len(truth) else raw.probabilities(*_flat([]))
    wrong = np.sort(p[truth == UNKNOWN, :UNKNOWN].max(axis=1)) if (truth == UNKNOWN).any() else np.zeros(1)
    least = float(min(0.9, max(0.5, wrong[min(len(wrong) - 1, int(len(wrong) * (1 - slips)))])))
    return Licences(w.astype(np.float32), b, best[1], least)


def stretched(found: list[tuple]) -> int:
    """Number of separate stretches of lines among ``found`` (.., first line, last line)."""
    n, end = 0, -1
    for first, last in sorted(x[3:] for x in found):
        n, end = n + (first > end), max(end, last)
    return n


def scan(docs: DataFrame, model: Licences, confirm: float = 0.6) -> DataFrame:
    """One row per row of ``docs``: all confirmed families by name, the surest one, its figures, and how many lines or runs of lines name a licence."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for f in frames:
            texts = f["text"].tolist()
            for a, b in batches(texts, 500_000):
                owner, rows, block = split_lines(texts[a:b])
                found: list[list[tuple]] = [[] for _ in range(b - a)]
                if rows:
                    lengths = np.array([len(r) for r in rows])
                    h = hashes([w for r in rows for w in r])
                    # features of all paragraphs at once: single words, and the pairs that do not cross paragraphs
                    own = np.repeat(np.arange(len(rows)), lengths)
                    two = rolling(h, 2)
                    within = own[:-1] == own[1:]
                    flat = np.concatenate([h, two[within]]) >> np.uint64(64 - BITS)
                    belongs = np.concatenate([own, own[:-1][within]])
                    order = np.argsort(belongs, kind="stable")
                    sizes = np.bincount(belongs, minlength=len(rows))
                    p = m.probabilities(flat[order].astype(np.int64), np.cumsum(sizes) - sizes, sizes)
                    notice = 1.0 - p[:, UNKNOWN] >= m.least
                    calls = [(r, FAMILIES.index(name)) for r in np.flatnonzero(notice) for name in named(rows[r])]
                    for r, k in sorted({*calls, *map(tuple, np.argwhere(p[:, :UNKNOWN] >= m.least).tolist())}):
                        if (like := confirmed(rows[r], FAMILIES[k])) >= confirm:
                            found[owner[r]].append((float(1.0 - p[r, UNKNOWN] if (r, k) in calls else p[r, k]), like, FAMILIES[k], int(r), int(r)))
                    stretches = runs(two, within_blocks(block, own), confirm)
                    flat_words = [w for r in rows for w in r] if stretches else []
                    parts = [flat_words[x : y + 1] for _, x, y in stretches]
                    p = m.probabilities(*_flat(parts)) if parts else p
                    for (t, x, y), ws, chance in zip(stretches, parts, p, strict=False):
                        family, template, _ = KNOWN[t]
                        chance = float(chance[FAMILIES.index(family)])
                        telling = TELLING & set(template)
                        if chance >= m.least and (not telling or telling & set(ws)) and (like := likeness(ws, family)) >= confirm:
                            found[owner[own[x]]].append((chance, like, family, int(own[x]), int(own[y])))
                yield pd.DataFrame({
                    "doc_id": f["doc_id"].iloc[a:b],
                    "licences": [sorted({x[2] for x in g}) for g in found],
                    "licence": [max(g)[2] if g else None for g in found],
                    "probability": [max(g)[0] if g else None for g in found],
                    "likeness": [max(g)[1] if g else None for g in found],
                    "paragraphs": [stretched(g) for g in found],
                })

    return docs.select("doc_id", "text").mapInPandas(run, RESULT)
