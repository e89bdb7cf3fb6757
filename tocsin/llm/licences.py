"""Licence scan: a trained paragraph classifier, confirmed by templates.

A paragraph is a run of lines that hold a word: a blank line or one of comment marks alone ends it,
and comment marks are no words, so a notice that is wrapped over lines reads as one. Its words and
word pairs are the sparse features of a multinomial logistic regression over licence families and
``unknown``. It is trained on pieces of licence templates
(whole, cut, with words changed) and, as unknown, on a bounded sample of the corpus's own
paragraphs and on template words in random order. Probabilities are calibrated on held-out
pieces by one temperature, and the least probability of a family is set so that held-out unknown
paragraphs stay unknown. A prediction stands only if a template of that family contains most of the
paragraph's word triples (the whole sequence for shorter ones), or the paragraph most of a
template's, if the words that set the template's family apart (a version, Lesser, Affero, NC, SA)
stand in it, and if none of them stands in one of the two where the other has a different word. So
"Licensed under the Apache License" without a version has no family.

A paragraph is classified as a whole, and so are its sentences, the lines that hold most of a
template, and the places where most of one stands, so a notice inside a long line is found as if it
stood alone. Only paragraphs that share no word triple with any template are passed over: none of
them can be confirmed. "All rights reserved" in a copyright line counts as proprietary only in
documents without any other notice.

Defined results: null and empty texts have no licence; equal texts get equal results; families of a
document are listed once, in alphabetical order; an empty table gives no rows and the classifier
then knows no unknown paragraph but shuffled ones; other columns are ignored. Rows keep their
``doc_id``, null too, and repeated rows are scanned each; very long texts are read whole.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tocsin.llm.common import slices, text_or_empty

#: Corpus paragraphs in the training set: about so many documents, one paragraph of each.
SAMPLE_DOCS = 1000
#: The sample ends with the paragraph that brings it to so many bytes; paragraphs stay whole.
SAMPLE_BYTES = 16 << 20
#: Variants of each template in training, least similarity.
VARIANTS, LEAST_SIMILAR = 24, 0.8
TRIPLE = 3
UNKNOWN = "unknown"
#: The tag of a licence identifier is three words.
WORDS = re.compile(r"spdx(?=-license)|license(?=-identifier)|[^\W_]+(?:[.'-][^\W_]+)*")
ZEROS = re.compile(r"(?<=\d)(?:\.0)+$")
SENTENCES = re.compile(r"(?<=[.!?:;])\s+")
LINE_ENDS = re.compile(r"\n")
RIGHTS = "Proprietary"
RESERVED = re.compile(r"\ball\s+rights\s+reserved\b", re.I)
COPYRIGHT = re.compile(r"\bcopyright\b|\(c\)|\u00a9", re.I)
CONFIDENTIAL = re.compile(r"\bconfidential\b", re.I)
#: A template may stand in up to so many times its own words.
WINDOW = 2
CHUNKS_HELD = 800_000

# Sentences by which the families name themselves.
SENTENCES_OF = {
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "under the terms of the GNU Affero General Public License as published by the Free "
        "Software Foundation, either version 3 of the License",
    ],
    "Apache-1.1": ["Licensed under the Apache License, Version 1.1."],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this '
        "file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "BSD": [
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-ND": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 "
        "International License.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License.",
    ],
    "CC-BY-NC-SA": [
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons "
        "Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License.",
    ],
    "CC0": [
        "Released into the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or "
        "neighboring rights to this work.",
    ],
    "EPL-2.0": [
        "This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License 2.0",
        "which is available at https://www.eclipse.org/legal/epl-2.0",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "under the terms of the GNU General Public License as published by the Free Software "
        "Foundation, either version 2 of the License, or any later version.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "under the terms of the GNU General Public License as published by the Free Software "
        "Foundation, either version 3 of the License, or any later version.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ],
    "LGPL-2.1": [
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "under the terms of the GNU Lesser General Public License as published by the Free "
        "Software Foundation, either version 2.1 of the License",
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "under the terms of the GNU Lesser General Public License as published by the Free "
        "Software Foundation, either version 3 of the License",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED',
    ],
    "MPL-1.1": ["Licensed under the Mozilla Public License, version 1.1."],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "Proprietary": ["All rights reserved.", "Confidential and proprietary. Do not distribute."],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software",
    ],
}

# Names of the families in short notices.
NAMES = {
    "AGPL-3.0": ["the GNU Affero General Public License v3.0", "the AGPLv3"],
    "Apache-1.1": ["the Apache License, Version 1.1"],
    "Apache-2.0": ["the Apache License, Version 2.0", "the Apache License 2.0",
                   "the Apache 2.0 License"],
    "BSD": ["the BSD License", "the 2-Clause BSD License", "the 3-Clause BSD License"],
    "CC-BY": ["CC BY 4.0", "CC BY"],
    "CC-BY-NC": ["CC BY-NC 4.0", "CC BY-NC"],
    "CC-BY-NC-SA": ["CC BY-NC-SA 4.0", "CC BY-NC-SA"],
    "CC-BY-ND": ["CC BY-ND 4.0", "CC BY-ND"],
    "CC-BY-SA": ["CC BY-SA 4.0", "CC BY-SA"],
    "EPL-2.0": ["the Eclipse Public License 2.0", "the Eclipse Public License, version 2.0"],
    "GPL-2.0": ["the GNU General Public License, version 2", "the GNU General Public License v2.0",
                "the GPLv2"],
    "GPL-3.0": ["the GNU General Public License, version 3", "the GNU General Public License v3.0",
                "the GPLv3"],
    "ISC": ["the ISC License"],
    "LGPL-2.1": ["the GNU Lesser General Public License, version 2.1", "the LGPLv2.1"],
    "LGPL-3.0": ["the GNU Lesser General Public License, version 3", "the LGPLv3"],
    "MIT": ["the MIT License"],
    "MPL-1.1": ["the Mozilla Public License, version 1.1"],
    "MPL-2.0": ["the Mozilla Public License, version 2.0", "the Mozilla Public License 2.0"],
    "Unlicense": ["the Unlicense"],
}
FORMS = ("Licensed under {}.", "Released under {}.", "Distributed under the terms of {}.")

# Licence identifiers that are not the family's own name.
IDENTIFIERS = {
    "AGPL-3.0": ["AGPL-3.0-only", "AGPL-3.0-or-later"],
    "BSD": ["BSD-2-Clause", "BSD-3-Clause"],
    "CC-BY": ["CC-BY-4.0"],
    "CC-BY-NC": ["CC-BY-NC-4.0"],
    "CC-BY-NC-SA": ["CC-BY-NC-SA-4.0"],
    "CC-BY-ND": ["CC-BY-ND-4.0"],
    "CC-BY-SA": ["CC-BY-SA-4.0"],
    "CC0": ["CC0-1.0"],
    "GPL-2.0": ["GPL-2.0-only", "GPL-2.0-or-later"],
    "GPL-3.0": ["GPL-3.0-only", "GPL-3.0-or-later"],
    "LGPL-2.1": ["LGPL-2.1-only", "LGPL-2.1-or-later"],
    "LGPL-3.0": ["LGPL-3.0-only", "LGPL-3.0-or-later"],
}
OWN_NAME = ("AGPL-3.0", "Apache-1.1", "Apache-2.0", "EPL-2.0", "GPL-2.0", "GPL-3.0", "ISC",
            "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-1.1", "MPL-2.0", "Unlicense")


def templates_of(family: str) -> list[str]:
    """Its sentences, its names in short notices, and its tags."""
    tags = [*([family] if family in OWN_NAME else []), *IDENTIFIERS.get(family, [])]
    return list(dict.fromkeys([
        *SENTENCES_OF.get(family, []),
        *(form.format(name) for name in NAMES.get(family, []) for form in FORMS),
        *(f"SPDX-License-Identifier: {tag}" for tag in tags),
    ]))


TEMPLATES = {
    family: templates_of(family) for family in sorted({*SENTENCES_OF, *NAMES, *IDENTIFIERS})
}


#: Words that set families apart, besides numbers in the families that are named by version.
APART = re.compile(
    r"lesser|library|affero|(?:by|attribution)-.*|non-?commercial|share-?alike|no-?deriv.*"
)


def words_of(paragraph: str) -> list[str]:
    return [whole_version(x) for x in WORDS.findall(paragraph.lower())]


def whole_version(word: str) -> str:
    """2.0 is written 2."""
    return ZEROS.sub("", word) if word.endswith(".0") else word


def features_of(words: list[str]) -> list[str]:
    return [*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))]


def triples(words: list[str]) -> frozenset[tuple[str, ...]]:
    if len(words) <= TRIPLE:
        return frozenset([tuple(words)])
    return frozenset(zip(*(words[i:] for i in range(TRIPLE))))


def followers(words: list[str]) -> dict[tuple[str, str], set[str]]:
    """The words that follow each pair of words."""
    found: dict[tuple[str, str], set[str]] = {}
    for a, b, c in zip(words, words[1:], words[2:]):
        found.setdefault((a, b), set()).add(c)
    return found


def keys_of(words: list[str]) -> tuple[frozenset[str], frozenset[str]]:
    """The words that set families apart, and those that hold a number."""
    apart = frozenset(w for w in words if APART.fullmatch(w))
    return apart, frozenset(w for w in words if any(map(str.isdigit, w))) - apart


def differs(some: dict, template: dict, family: str) -> bool:
    """Whether a pair of both is followed by other words here and there, of which one sets
    families apart."""
    versions = any(map(str.isdigit, family))

    def apart(word: str) -> bool:
        return bool(APART.fullmatch(word)) or versions and any(map(str.isdigit, word))

    return any(
        some[pair].isdisjoint(after) and any(map(apart, some[pair] | after))
        for pair, after in template.items()
        if pair in some
    )


def training_set(corpus: list[str], seed: int = 11) -> tuple[list[list[str]], list[str]]:
    """Paragraphs as words, and their families."""
    rng = np.random.default_rng(seed)
    texts, families = [], []
    for family, templates in TEMPLATES.items():
        for words in map(words_of, templates):
            for i in range(VARIANTS):
                piece = list(words)
                if i % 3 == 1 and len(words) > 6:  # cut
                    size = int(rng.integers(max(5, len(words) * 2 // 3), len(words) + 1))
                    at = int(rng.integers(0, len(words) - size + 1))
                    piece = piece[at : at + size]
                elif i % 3 == 2 and corpus:  # within other words
                    extra = words_of(corpus[int(rng.integers(len(corpus)))])[: len(words) // 4]
                    piece = piece + extra if i % 2 else extra + piece
                texts.append(piece)
                families.append(family)
            for _ in range(VARIANTS // 3):  # the same words in no order
                texts.append([words[k] for k in rng.permutation(len(words))])
                families.append(UNKNOWN if len(words) > 3 else family)
    return texts + [words_of(p) for p in corpus], families + [UNKNOWN] * len(corpus)


@dataclass
class LicenceModel:
    """Weights per feature and family; the temperature and least probability from calibration."""

    families: list[str]
    index: dict[str, int]
    weights: np.ndarray
    intercept: np.ndarray
    temperature: float = 1.0
    least: float = 0.5

    def logits(self, words: list[str]) -> np.ndarray:
        known = sorted({self.index[x] for x in features_of(words) if x in self.index})
        missing = sum(x not in self.index for x in words) / max(1, len(words))
        return self.intercept + self.weights[:, known].sum(1) + self.weights[:, -1] * missing

    def probabilities(self, words: list[str]) -> np.ndarray:
        z = self.logits(words) / self.temperature
        z = np.exp(z - z.max())
        return z / z.sum()

    def family(self, words: list[str], all_of_it: bool = False) -> tuple[str, float]:
        """The confirmed family of a paragraph, or unknown, and the probability. ``all_of_it``:
        the paragraph must hold most of a template, a part of one is not enough."""
        p = self.probabilities(words)
        best = int(p.argmax())
        name = self.families[best]
        if name == UNKNOWN or p[best] < self.least or not confirmed(words, name, all_of_it):
            return UNKNOWN, float(p[self.families.index(UNKNOWN)])
        return name, float(p[best])


TEMPLATE_TRIPLES = {
    family: [triples(words_of(t)) for t in templates] for family, templates in TEMPLATES.items()
}
TEMPLATE_FOLLOWERS = {
    family: [followers(words_of(t)) for t in templates] for family, templates in TEMPLATES.items()
}
TEMPLATE_KEYS = {
    family: [keys_of(words_of(t)) for t in templates] for family, templates in TEMPLATES.items()
}
TEMPLATE_WORDS = frozenset(w for of in TEMPLATES.values() for t in of for w in words_of(t))
KNOWN_TRIPLES = frozenset(x for of in TEMPLATE_TRIPLES.values() for t in of for x in t)
#: The place of each of a template's triples in it.
PLACES = [
    {x: i for i, x in enumerate(zip(w, w[1:], w[2:]))}
    for of in TEMPLATES.values() for w in map(words_of, of)
]


def confirmed(words: list[str], family: str, all_of_it: bool = False) -> bool:
    """Whether a template holds most of the paragraph's triples (not if ``all_of_it``), or the
    paragraph a template's, the words that set families apart are there, and none of them differs."""
    own, known = triples(words), frozenset(words)
    alike = [
        after
        for t, after, (apart, numbers) in zip(
            TEMPLATE_TRIPLES[family], TEMPLATE_FOLLOWERS[family], TEMPLATE_KEYS[family]
        )
        if own & t
        and len(own & t) >= LEAST_SIMILAR * (len(t) if all_of_it else min(len(own), len(t)))
        and apart <= known and (not numbers or numbers & known)
    ]
    follows = followers(words) if alike else {}
    return any(not differs(follows, after, family) for after in alike)


def shares_triple(words: list[str]) -> bool:
    return not KNOWN_TRIPLES.isdisjoint(zip(words, words[1:], words[2:]))


def mostly_template(words: list[str]) -> bool:
    own = triples(words)
    return len(own & KNOWN_TRIPLES) >= LEAST_SIMILAR * len(own)


def windows(words: list[str]) -> list[tuple[int, int]]:
    """Places (first word, word after the last) that hold most of a template's triples.

    From each shared triple on, the words up to the last new triple of that template are a place;
    of places that overlap, the one with the most triples counts, and of those the shortest. Where
    the template goes on at either end, the place does so by as many words.
    """
    own = list(zip(words, words[1:], words[2:]))
    shared = [i for i, x in enumerate(own) if x in KNOWN_TRIPLES]
    found = set()
    for template in PLACES:
        at = [i for i in shared if own[i] in template]
        most = WINDOW * (len(template) + TRIPLE - 1)
        here, best = [], (0, 0, 0)  # triples, the first one's place, the last one's
        for k, first in enumerate(at):
            seen, last = set(), first
            for i in at[k:]:
                if i + TRIPLE > first + most:
                    break
                if own[i] not in seen:
                    seen.add(own[i])
                    last = i
            if len(seen) < LEAST_SIMILAR * len(template):
                continue
            if best[0] and first > best[2]:
                here.append(best)
                best = (0, 0, 0)
            if (len(seen), first - last) > (best[0], best[1] - best[2]):
                best = (len(seen), first, last)
        for count, first, last in [*here, best]:
            if count:
                start = first - template[own[first]]
                stop = last + TRIPLE + max(template.values()) - template[own[last]]
                found.add((max(0, start), min(len(words), stop)))
    return sorted(found)


def parts_of(text: str, ends: re.Pattern) -> list[tuple[int, int, list[str]]]:
    """Start, stop and words of what stands between the ends and may be a notice."""
    found, start = [], 0
    for stop, after in [*((m.start(), m.end()) for m in ends.finditer(text)), (len(text), 0)]:
        own = words_of(text[start:stop])
        if shares_triple(own):
            found.append((start, stop, own))
        start = after
    return found


def notices(paragraph: str, model: LicenceModel) -> list[tuple[int, int, str, float]]:
    """The confirmed notices in a paragraph: start and stop in code points, family, probability.

    Lines that are a template and little else come first, then the paragraph and its sentences of
    that kind, then the places of templates, then what else the paragraph and its sentences give as
    wholes; a part counts if its family is not yet found where it stands.
    """
    lower = paragraph.lower()
    spots = [m.span() for m in WORDS.finditer(lower)]
    words = [whole_version(lower[a:b]) for a, b in spots]
    if not shares_triple(words):
        return []
    if len(lower) != len(paragraph):  # a letter that has two in lower case
        old = [i for i, x in enumerate(paragraph) for _ in x.lower()]
        spots = [(old[a], old[b - 1] + 1) for a, b in spots]
    own_lines = parts_of(paragraph, LINE_ENDS) if "\n" in paragraph else []
    lines = [part for part in own_lines if mostly_template(part[2])]
    wholes = [(0, len(paragraph), words)]
    if SENTENCES.search(paragraph):
        wholes += parts_of(paragraph, SENTENCES)
    places = [(spots[a][0], spots[b - 1][1], words[a:b]) for a, b in windows(words)]
    mostly, others = [], []
    for part in wholes:
        (mostly if mostly_template(part[2]) else others).append(part)
    found: list[tuple[int, int, str, float]] = []
    parts = [(lines, True), (mostly, False), (places, False), (others, False)]
    for (start, stop, own), all_of_it in ((x, alone) for of, alone in parts for x in of):
        family, p = model.family(own, all_of_it)
        if family != UNKNOWN and not any(
            f == family and a < stop and start < b for a, b, f, _ in found
        ):
            found.append((start, stop, family, p))
    return sorted(found)


def paragraphs(text: str) -> Iterator[tuple[int, str]]:
    """Runs of lines that hold a word, and where they start."""
    start = at = stop = 0
    for line in text.split("\n"):
        if not WORDS.search(line):
            if stop > start:
                yield start, text[start:stop]
            start = at + len(line) + 1
        else:
            stop = at + len(line)
        at += len(line) + 1
    if stop > start:
        yield start, text[start:stop]


def copyright_line(text: str, start: int, stop: int) -> bool:
    """Whether a place is "all rights reserved" in a line that names a holder of rights."""
    if not RESERVED.search(text[start:stop]) or CONFIDENTIAL.search(text[start:stop]):
        return False
    reserved = start + RESERVED.search(text[start:stop]).start()
    line = text[text.rfind("\n", 0, reserved) + 1 : reserved]
    return COPYRIGHT.search(line) is not None


def notices_of(text: str, model: LicenceModel, known: KnownWords) -> list[tuple]:
    """All notices of a text, with the number of the line in which each starts."""
    found = []
    if not known.may_share(text):
        return found
    line = at = 0
    for begin, paragraph in paragraphs(text):
        if not known.may_share(paragraph):
            continue
        for start, stop, family, p in notices(paragraph, model):
            # A part may begin with white space; its first word tells the line.
            first = begin + start + WORDS.search(paragraph[start:stop].lower()).start()
            if first >= at:
                line += text.count("\n", at, first)
            else:
                line -= text.count("\n", first, at)
            at = first
            found.append((begin + start, begin + stop, family, p, line))
    if any(s[2] != RIGHTS for s in found):
        return [s for s in found if s[2] != RIGHTS or not copyright_line(text, s[0], s[1])]
    return found


def corpus_paragraphs(docs: DataFrame) -> list[str]:
    """A sample bounded in rows and bytes: of documents chosen by a hash, the whole paragraph in
    the middle."""
    share = min(1.0, SAMPLE_DOCS / max(1, docs.count()))
    lines = F.split(text_or_empty(), "\n", -1)
    order = F.xxhash64("doc_id")
    chosen = (
        docs.where(F.pmod(order, F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
        .select(
            order.alias("at"),
            F.element_at(lines, F.floor(F.size(lines) / 2).cast("int") + 1).alias("line"),
        )
        .where(F.length("line") > 0)
        .limit(2 * SAMPLE_DOCS)
    )
    before = Window.orderBy("at", "line").rowsBetween(Window.unboundedPreceding, -1)
    size = F.coalesce(F.sum(F.octet_length("line")).over(before), F.lit(0))
    chosen = chosen.withColumn("before", size).where(F.col("before") < SAMPLE_BYTES).select("line")
    found = sorted({r.line for r in chosen.collect()})
    return [p for p in found if not triples(words_of(p)) & KNOWN_TRIPLES]


def fit(docs: DataFrame) -> LicenceModel:
    """Train on three quarters of the pieces, calibrate on the rest."""
    texts, families = training_set(corpus_paragraphs(docs))
    names = sorted(set(families) | {UNKNOWN})
    index = {x: i for i, x in enumerate(sorted({
        f for of in TEMPLATES.values() for t in of for f in features_of(words_of(t))
    }))}
    size = len(index) + 1
    model = LicenceModel(names, index, np.zeros((len(names), size)), np.zeros(len(names)))

    def vector(words: list[str]):
        known = {index[x]: 1.0 for x in features_of(words) if x in index}
        missing = sum(x not in index for x in words) / max(1, len(words))
        return Vectors.sparse(size, known | {size - 1: missing})

    number = {n: float(i) for i, n in enumerate(names)}
    held = [i % 4 == 3 for i in range(len(texts))]
    rows = [
        (vector(w), number[f]) for w, f, h in zip(texts, families, held) if not h and w
    ]
    frame = docs.sparkSession.createDataFrame(rows, ["features", "label"])
    line = LogisticRegression(
        family="multinomial", maxIter=60, regParam=1e-3, standardization=False
    ).fit(frame)
    model.weights, model.intercept = line.coefficientMatrix.toArray(), line.interceptVector.toArray()
    calibrate(model, [(w, number[f]) for w, f, h in zip(texts, families, held) if h and w])
    return model


def calibrate(model: LicenceModel, rows: list[tuple[list[str], float]]) -> None:
    """The temperature of least log loss, and the family probability no unknown piece reaches."""
    logits = np.stack([model.logits(w) for w, _ in rows])
    label = np.array([y for _, y in rows], int)
    best = np.inf
    for temperature in np.geomspace(0.25, 4, 17):
        z = logits / temperature
        z = z - z.max(1, keepdims=True)
        loss = float((np.log(np.exp(z).sum(1)) - z[np.arange(len(z)), label]).mean())
        if loss < best:
            best, model.temperature = loss, float(temperature)
    unknown = model.families.index(UNKNOWN)
    z = logits / model.temperature
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    p[:, unknown] = 0
    reached = p[label == unknown].max(1)
    model.least = float(min(0.9, max([0.5, *np.quantile(reached, [0.99])]))) if len(reached) else 0.5


class KnownWords(dict):
    """Of a chunk of text, for each of its words whether it stands in a template."""

    def __missing__(self, chunk: str) -> str:
        if len(self) > CHUNKS_HELD:
            self.clear()
        found = "".join("1" if w in TEMPLATE_WORDS else "0" for w in words_of(chunk))
        self[chunk] = found = sys.intern(found)
        return found

    def may_share(self, text: str) -> bool:
        """Whether as many words as a triple has stand in templates in a row."""
        return "1" * TRIPLE in "".join(map(self.__getitem__, text.split()))


def scanned(docs: DataFrame, model: LicenceModel) -> DataFrame:
    """``doc_id``, ``licences`` (families in alphabetical order) and ``spans``: each confirmed
    notice's place in code points, its family, its calibrated probability and, as ``paragraph``, the
    number of the line in which it starts, from 0 on."""
    span = pa.struct(
        [
            ("start", pa.int64()), ("stop", pa.int64()), ("family", pa.string()),
            ("p", pa.float64()), ("paragraph", pa.int64()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = KnownWords()
        for batch in batches:
            for part in slices(batch, 1):
                spans = [notices_of(x, model, known) for x in part.column(1).to_pylist()]
                families = [sorted({s[2] for s in of}) for of in spans]
                keys = ("start", "stop", "family", "p", "paragraph")
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(families, pa.list_(pa.string())),
                        pa.array([[dict(zip(keys, s)) for s in of] for of in spans], pa.list_(span)),
                    ],
                    ["doc_id", "licences", "spans"],
                )

    schema = (
        "doc_id long, licences array<string>, "
        "spans array<struct<start: long, stop: long, family: string, p: double, paragraph: long>>"
    )
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, schema)
