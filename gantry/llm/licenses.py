"""Licence scan: a trained paragraph classifier whose findings are checked against templates.

A paragraph is a line with a word. Notices are also looked for across lines: the lines up
to the next empty one, without comment marks around them, are joined and read in stretches
of ``STRETCH`` words that overlap by half, so every notice lies whole in one; what is found
there is reported at the line where it begins. The features of a paragraph or stretch are the word uni- and bigrams that occur
in it, out of those of the notices below and the most frequent ones of the corpus sample.
A softmax regression with a class for each licence family, one for licence text of no such
family and one for other text is trained in numpy on the driver: on damaged and embedded copies
of notices, and on paragraphs of ``SAMPLE_DOCS`` different texts, the first by a hash, each of at
most ``SAMPLE_BYTES`` bytes. A temperature fitted on left-out examples calibrates it.

A family is reported if licence text as a whole is at least as likely as ``ACCEPT``, and one
of the family's notices is found in the paragraph to ``SIMILARITY`` of its bigrams. Families
other than the most probable one also need half of the bigrams that no other family has
(the notices of some differ in a word only). A notice of fewer than ``SHORT_NOTICE`` words has to
end a line. A paragraph can have several families. A line or stretch that fails the comparison
but is licence text to ``ACCEPT_UNKNOWN``, of that class or of a family, is reported as ``unknown``.

Cases: null, empty and wordless texts have no paragraphs; equal rows give equal results;
an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gantry.llm.common import chunks, lowest_by_hash, text_or_empty

SAMPLE_DOCS, SAMPLE_BYTES, SAMPLE_PARAGRAPHS = 400, 1 << 16, 3000
#: Frequent n-grams of the sample that are features besides those of the notices.
COMMON_GRAMS = 600
COPIES = 24
ACCEPT, ACCEPT_UNKNOWN = 0.5, 0.9
SIMILARITY, OWN_SIMILARITY = 0.7, 0.5
#: Words of a stretch of joined lines; half of it holds the longest notice.
STRETCH = 64

# ---- fixed values: public licence notices, by family ----
NOTICES: dict[str, list[str]] = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License.",
        "This project is released under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files.",
        "This software is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation.",
        "Licensed under the GNU GPL, version 2 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met.",
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "public-domain": [
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited.",
    ],
}
# ---------------------------------------------------------

# ---- fixed values: public licence notices of none of these families ----
UNKNOWN_NOTICES = [
    "This software is provided as-is, without any express or implied warranty. In no event will the authors be held "
    "liable for any damages arising from the use of this software.",
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
    "alter it and redistribute it freely, subject to the following restrictions.",
    "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, "
    "and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph "
    "appear in all copies.",
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
    "The contents of this file are subject to the terms of the Common Development and Distribution License.",
    "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    "This package is licensed under the terms of the Artistic License 2.0.",
    "Licensed under the Open Software License, version 3.0.",
    "Licensed under the Academic Free License, version 3.0 or later; you may use this work under its terms.",
    "Distributed under the terms of the PostgreSQL License. See the accompanying file COPYING or a copy on the web.",
    "This license governs use of the accompanying software. If you use the software, you accept this license.",
    "SPDX-License-Identifier: EPL-2.0",
    "SPDX-License-Identifier: Zlib",
]
# --------------------------------------------------------------------------

FAMILIES = sorted(NOTICES)
_UNKNOWN = len(FAMILIES)
_OTHER = _UNKNOWN + 1
#: Notices of fewer words have to end a line: their words also stand inside other sentences.
SHORT_NOTICE = 4
_EDGES = bytes(set(range(0x21, 0x7F)) - set(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"))


def plain_words(paragraph: bytes) -> list[bytes]:
    return [word.strip(_EDGES) or word for word in paragraph.lower().split()]


def paragraphs(text: bytes) -> list[list[bytes]]:
    """The words of each line that has any."""
    return [words for line in text.split(b"\n") if (words := line.lower().split())]


#: Words of comment marks only, at the ends of a line.
_MARKS = b"/*#;%-!<>|\"'"


def unmarked(line: list[bytes]) -> list[bytes]:
    """The words of a line without comment marks around them."""
    a, b = 0, len(line)
    while a < b and not line[a].strip(_MARKS):
        a += 1
    while a < b and not line[b - 1].strip(_MARKS):
        b -= 1
    return line[a:b]


def stretches(text: bytes) -> list[tuple[list[bytes], list[int]]]:
    """Words of joined lines, each with the number of its paragraph, where lines are joined."""
    found: list[tuple[list[bytes], list[int]]] = []
    words: list[bytes] = []
    places: list[int] = []

    def close() -> None:
        if places and places[0] != places[-1]:
            for at in range(0, max(1, len(words) - STRETCH // 2), STRETCH // 2):
                of = places[at : at + STRETCH]
                if of[0] != of[-1]:
                    found.append((words[at : at + STRETCH], of))
        words.clear()
        places.clear()

    place = -1
    for line in text.split(b"\n"):
        whole = line.lower().split()
        place += bool(whole)
        inner = unmarked(whole)
        if not inner:
            close()
        words += inner
        places += [place] * len(inner)
    close()
    return found


def bigrams(words: list[bytes]) -> set[tuple[bytes, ...]]:
    return set(zip(words, words[1:])) or {tuple(words)}


@dataclass
class Classifier:
    words: dict[bytes, int]
    pairs: np.ndarray  # sorted first * len(words) + second
    weights: np.ndarray  # of words, then pairs, then the constant; by class
    notices: list[list[set]]
    own: list[set]  # bigrams of each family's notices that no other family's have
    short: dict[frozenset, tuple[bytes, ...]]  # words of the short ones among the notices

    def features(self, ids: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Paragraphs and their features, each pair once, from the words in order (-1: no feature)."""
        known = ids >= 0
        found = [(owner[known], ids[known])]
        if len(self.pairs) and len(ids) > 1:
            both = known[1:] & known[:-1] & (owner[1:] == owner[:-1])
            pair = ids[:-1][both] * len(self.words) + ids[1:][both]
            place = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            hit = self.pairs[place] == pair
            found.append((owner[1:][both][hit], len(self.words) + place[hit]))
        size = len(self.weights)
        features = np.unique(np.concatenate([o * size + f for o, f in found]))
        return np.divmod(features, size)

    def logits(self, ids: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """Class scores of ``n`` paragraphs from their words in order."""
        owners, features = self.features(ids, owner)
        out = np.repeat(self.weights[-1:], n, axis=0)
        if len(owners):
            first = np.flatnonzero(np.r_[True, owners[1:] != owners[:-1]])
            out[owners[first]] += np.add.reduceat(self.weights[features], first, axis=0)
        return out

    def _ends_a_line(self, notice: set, words: list[bytes], ends: list[int]) -> bool:
        wanted = self.short.get(frozenset(notice))
        return wanted is None or any(tuple(words[max(0, e - len(wanted)) : e]) == wanted for e in ends)

    def families(self, words: list[bytes], best: int, ends: list[int]) -> dict[str, set]:
        """The families whose notices are in the paragraph, each with those of its bigrams.

        ``ends``: the numbers of words up to the end of each line.
        """
        here = bigrams(words)
        found = {}
        for family, notices in enumerate(self.notices):
            similar = [n for n in notices if len(n & here) >= SIMILARITY * len(n) and self._ends_a_line(n, words, ends)]
            if family != best:
                own = self.own[family]
                similar = [n for n in similar if n & own and len(n & own & here) >= OWN_SIMILARITY * len(n & own)]
            if similar:
                found[FAMILIES[family]] = set.union(*similar) & here
        return found


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def train(others: list[list[bytes]], seed: int = 5) -> Classifier:
    """A classifier from the notices and other paragraphs, as words."""
    rng = np.random.default_rng(seed)
    notices = [[plain_words(n.encode()) for n in NOTICES[f]] for f in FAMILIES]
    foreign = [plain_words(n.encode()) for n in UNKNOWN_NOTICES]
    known = [bigrams(words) for of_family in [*notices, foreign] for words in of_family]
    # paragraphs that hold a notice are no examples of other text
    others = [p for p in others if all(len(bigrams(p) & k) < 0.5 * len(k) for k in known)]
    classes = [*notices, foreign]
    notice_words = {w for of_class in classes for words in of_class for w in words}
    common = Counter(w for p in others for w in set(p)).most_common(COMMON_GRAMS)
    vocabulary = {w: i for i, w in enumerate(sorted(notice_words | {w for w, _ in common}))}
    pair_counts = Counter(pair for p in others for pair in set(zip(p, p[1:])) if pair[0] in vocabulary and pair[1] in vocabulary)
    pairs = {pair for of_class in classes for words in of_class for pair in zip(words, words[1:])}
    pairs |= {pair for pair, _ in pair_counts.most_common(COMMON_GRAMS)}
    coded = np.array(sorted(vocabulary[a] * len(vocabulary) + vocabulary[b] for a, b in pairs), np.int64)

    filler = [w for p in others for w in p] or [b"text"]
    examples: list[tuple[list[bytes], int]] = [(p, _OTHER) for p in others]
    for family, of_class in enumerate(classes):
        for words in of_class:
            for copy in range(COPIES):
                kept = [w for w in words if copy == 0 or rng.random() > 0.08] or words
                around = [int(x) for x in rng.integers(0, 40, 2)] if copy % 2 else [0, 0]
                at = rng.integers(0, len(filler), 2)
                before, after = (filler[a : a + n] for a, n in zip(at, around))
                examples.append(([*before, *kept, *after], family))
    labels = np.array([label for _, label in examples])
    size = len(vocabulary) + len(coded) + 1
    of_notices = [[bigrams(w) for w in f] for f in notices]
    of_family = [set.union(*f) for f in of_notices]
    own = [mine.difference(*(f for f in of_family if f is not mine)) for mine in of_family]
    short = {frozenset(bigrams(w)): tuple(w) for f in notices for w in f if len(w) < SHORT_NOTICE}
    model = Classifier(vocabulary, coded, np.zeros((size, _OTHER + 1), np.float32), of_notices, own, short)
    x = np.zeros((len(examples), size), np.float32)
    x[model.features(*numbered([p for p, _ in examples], vocabulary))] = 1
    x[:, -1] = 1
    held = rng.random(len(labels)) < 0.2
    wanted = np.eye(_OTHER + 1, dtype=np.float32)[labels]
    balance = 1 / np.bincount(labels, minlength=_OTHER + 1)[labels].astype(np.float32)
    balance = np.where(held, 0, balance)[:, None].astype(np.float32)
    balance /= balance.sum()
    weights = np.zeros((size, _OTHER + 1), np.float32)
    speed = np.zeros_like(weights)
    for _ in range(250):
        gradient = x.T @ ((_softmax(x @ weights) - wanted) * balance) + 1e-5 * weights
        speed = 0.9 * speed - 2.0 * gradient
        weights += speed
    left = x[held] @ weights
    losses = [(-np.log(_softmax(left * t)[np.arange(len(left)), labels[held]] + 1e-9).mean(), t) for t in np.geomspace(0.2, 5, 25)]
    model.weights = (weights * min(losses)[1] if held.any() else weights).astype(np.float32)
    return model


def numbered(found: list[list[bytes]], vocabulary: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    words = [w for p in found for w in p]
    ids = np.fromiter((vocabulary.get(w, -1) for w in words), np.int64, len(words))
    return ids, np.repeat(np.arange(len(found)), [len(p) for p in found])


class _Numbers(dict):
    """Features of words as they stand in a text, kept while a task runs."""

    def __init__(self, vocabulary: dict[bytes, int]):
        self.vocabulary = vocabulary

    def __missing__(self, word: bytes) -> int:
        number = self[word] = self.vocabulary.get(word.strip(_EDGES) or word, -1)
        return number


def scan(texts: list[bytes], model: Classifier, numbers: _Numbers) -> list[tuple[int, list[tuple[int, str, float]]]]:
    """For each text its paragraphs, and place, family and probability of those with a licence."""
    results: list[tuple[int, list[tuple[int, str, float]]]] = []
    for a, b in chunks(texts):
        if len(numbers) > 500_000:
            numbers.clear()
        units: list[tuple[int, list[bytes], list[int]]] = []
        counts = []
        for i, text in enumerate(texts[a:b]):
            found = paragraphs(text)
            counts.append(len(found))
            units += [(i, words, [place]) for place, words in enumerate(found)]
            units += [(i, words, places) for words, places in stretches(text)]
        words = [w for _, of_unit, _ in units for w in of_unit]
        ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        owner = np.repeat(np.arange(len(units)), [len(u[1]) for u in units])
        chance = _softmax(model.logits(ids, owner, len(units)))
        licence = 1 - chance[:, _OTHER]
        named: list[dict[tuple[int, str], float]] = [{} for _ in counts]
        unknown: list[list[tuple[float, set[int]]]] = [[] for _ in counts]
        covered: list[set[int]] = [set() for _ in counts]
        for u in np.flatnonzero(licence >= ACCEPT).tolist():
            text, of_unit, places = units[u]
            plain = [w.strip(_EDGES) or w for w in of_unit]
            joined = len(places) > 1
            ends = [k + 1 for k in range(len(plain) - 1) if joined and places[k] != places[k + 1]] + [len(plain)]
            families = model.families(plain, int(chance[u, :_UNKNOWN].argmax()), ends)
            for family, shared in families.items():
                # pairs of the notice, by line; a line's own findings come first and are not repeated
                at = [k for k, pair in enumerate(zip(plain, plain[1:])) if pair in shared] or [0]
                lines = {places[k] for k in at} | {places[k + 1] for k in at} if joined else {places[0]}
                if not joined or not any((line, family) in named[text] for line in lines):
                    key = (min(lines), family)
                    named[text][key] = max(named[text].get(key, 0.0), float(licence[u]))
                covered[text] |= lines
            if not families and licence[u] >= ACCEPT_UNKNOWN:
                unknown[text].append((float(licence[u]), set(places)))
        for count, of_named, of_unknown, known in zip(counts, named, unknown, covered):
            rest = []
            # a line's own findings come first; lines told once are not told again
            for p, lines in of_unknown:
                if not lines & known:
                    rest.append((min(lines), "unknown", p))
                    known = known | lines
            results.append((count, sorted([(place, family, p) for (place, family), p in of_named.items()] + rest)))
    return results


_RESULT = "n_paragraphs long, n_licensed long, n_unknown long, families string, findings string"


def sample_texts(docs: DataFrame, id_col: str, text_col: str) -> list[bytes]:
    """At most ``SAMPLE_DOCS`` different texts of at most ``SAMPLE_BYTES`` bytes, in the order of a hash.

    The hashes are chosen without the texts; of the copies of a chosen one, those of the smallest
    id send theirs.
    """
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    texts = texts.where(F.octet_length("text") <= SAMPLE_BYTES).withColumn("hash", F.xxhash64("text"))
    one_of_each = texts.groupBy("hash").agg(F.min("id").alias("first"))
    chosen = F.broadcast(lowest_by_hash(one_of_each, "hash", SAMPLE_DOCS).withColumnRenamed("hash", "chosen"))
    same = (F.col("hash") == F.col("chosen")) & F.col("id").eqNullSafe(F.col("first"))
    found = texts.join(chosen, same).groupBy("hash").agg(F.first("text").alias("text"))
    return [r.text.encode() for r in sorted(found.collect())]


def license_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: paragraphs, licensed and unknown ones, the families found (sorted,
    comma-joined) and all findings (paragraph:family:probability, comma-joined)."""
    chosen = sample_texts(docs, id_col, text_col)
    others = [[w.strip(_EDGES) or w for w in p] for t in chosen for p in paragraphs(t)]
    shared = docs.sparkSession.sparkContext.broadcast(train(others[:: max(1, len(others) // SAMPLE_PARAGRAPHS)]))

    @F.pandas_udf(_RESULT)
    def report(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        numbers = _Numbers(model.words)
        for series in batches:
            rows = []
            for count, found in scan(list(series), model, numbers):
                named = sorted({family for _, family, _ in found if family != "unknown"})
                listed = ",".join(f"{place}:{family}:{chance:.3f}" for place, family, chance in found)
                unknown = sum(family == "unknown" for _, family, _ in found)
                licensed = len({place for place, family, _ in found if family != "unknown"})
                rows.append((count, licensed, unknown, ",".join(named), listed))
            yield pd.DataFrame(rows, columns=["n_paragraphs", "n_licensed", "n_unknown", "families", "findings"])

    found = docs.select(F.col(id_col), report(text_or_empty(text_col).cast("binary")).alias("found"))
    return found.select(id_col, "found.*")
