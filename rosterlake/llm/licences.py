"""Licence texts in documents by MinHash bands over overlapping windows.

Texts and templates become hashes of five-word shingles (words: runs of letters and digits, lower case). Templates
of m shingles belong to the class of size M, the power of two with M/2 < m <= M. Windows of 2M shingles start at
every multiple of M, so any m successive shingles lie inside one window. A band is one MinHash value; a window
retrieves the templates of its class with which it agrees in some band.

A window that holds ``CONTAINMENT`` of a template's shingles has Jaccard similarity of at least
c m / (2M + (1 - c) m) with it; the number of bands is the least for which such a window is missed with probability
of at most ``MISS`` (one value per band suits this: chance agreements need a common shingle, as exact as the check).
Every retrieved pair is verified: the share of the template's distinct shingles found in the window, exactly.

Minima of all classes come from one pass: minima of neighbouring blocks of M/2 give those of M.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SHINGLE, CONTAINMENT, MISS, SEED = 5, 0.8, 1e-3, 3
#: Templates sent to the tasks at a time; a longer list is searched in several passes.
AT_ONCE = 2000
TOP = np.uint64(48)
WORD = re.compile(r"[^\W_]+")

# fixed values: common licence statements and notices
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                   "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
                   "either express or implied."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                "the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
                     "conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def word_list(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def shingles(text: str | None) -> np.ndarray:
    """Hashes of the five-word shingles in text order."""
    digest = xxhash.xxh3_64_intdigest
    words = "\n".join(word_list(text)).encode("utf-8", "replace").split(b"\n")
    hashes = np.fromiter(map(digest, words), np.uint64, len(words))
    return common.windows(hashes, SHINGLE) if len(words) >= SHINGLE else np.empty(0, np.uint64)


def bands_for(jaccard: float, miss: float = MISS) -> int:
    """Least number of one-value bands that miss a pair of this similarity with probability ``miss`` at most."""
    return 1 if jaccard >= 1 else math.ceil(math.log(miss) / math.log(1 - jaccard))


def factors(bands: int) -> np.ndarray:
    """Odd multipliers: the hash functions of the bands."""
    return np.random.default_rng(SEED).integers(1, 2**64, bands, np.uint64) | np.uint64(1)


class Index:
    """Template shingles and their MinHash values, by class."""

    def __init__(self, templates: list[tuple[str, str]], containment: float = CONTAINMENT) -> None:
        self.containment = containment
        self.sets = [np.unique(shingles(text)) for _, text in templates]
        short = [text for (_, text), s in zip(templates, self.sets) if not len(s)]
        if short:
            raise ValueError(f"templates need {SHINGLE} words: {short}")
        members: dict[int, list[int]] = defaultdict(list)
        for i, s in enumerate(self.sets):
            members[1 << (len(s) - 1).bit_length()].append(i)
        self.bands = {}
        for size, some in members.items():
            least = min(len(self.sets[i]) for i in some)
            self.bands[size] = bands_for(containment * least / (2 * size + (1 - containment) * least))
        self.multipliers = factors(max(self.bands.values()))
        self.found: dict[int, dict[tuple[int, int], list[int]]] = {}
        self.quick: dict[int, np.ndarray] = {}
        for size, some in members.items():
            table, quick = defaultdict(list), np.zeros(1 << 16, bool)
            for i in some:
                for band, value in enumerate((self.sets[i][None, :] * self.multipliers[:self.bands[size], None]).min(axis=1).tolist()):
                    table[band, value].append(i)
                    quick[value >> 48] = True
            self.found[size], self.quick[size] = dict(table), quick
        self.largest = max(members)

    def candidates(self, text: np.ndarray) -> set[tuple[int, int, int]]:
        """(first shingle, class, template) of windows that agree with a template in some band."""
        out: set[tuple[int, int, int]] = set()
        step = max(4096 // self.largest, 1) * self.largest
        for at in range(0, len(text), step):
            part = text[at:at + step + self.largest]
            values = part[None, :] * self.multipliers[:, None]
            size = 1
            while size <= self.largest:
                if size in self.found:
                    use = values[:self.bands[size]]
                    window = use.copy()
                    np.minimum(use[:, 1:], use[:, :-1], out=window[:, :-1])
                    hit = self.quick[size].take(window >> TOP).ravel()
                    if hit.any():
                        for place in np.flatnonzero(hit).tolist():
                            band, n = divmod(place, window.shape[1])
                            for i in self.found[size].get((band, int(window[band, n])), ()):
                                out.add((at + n * size, size, i))
                size *= 2
                if values.shape[1] > 1:
                    even = values[:, :-1:2] if values.shape[1] % 2 else values[:, ::2]
                    halved = np.minimum(even, values[:, 1::2])
                    values = np.concatenate([halved, values[:, -1:]], axis=1) if values.shape[1] % 2 else halved
        return out

    def matches(self, text: np.ndarray) -> list[tuple[int, int, int, float]]:
        """(template, first word, word after the last, containment) of verified windows; overlapping ones are joined."""
        found: dict[int, list[tuple[int, int, float]]] = defaultdict(list)
        for start, size, i in sorted(self.candidates(text)):
            window = text[start:start + 2 * size]
            hit = np.isin(window, self.sets[i])
            share = len(np.unique(window[hit])) / len(self.sets[i])
            if share >= self.containment - 1e-9:
                places = np.flatnonzero(hit) + start
                first, last = int(places[0]), int(places[-1]) + SHINGLE
                if found[i] and first < found[i][-1][1]:
                    a, b, s = found[i][-1]
                    found[i][-1] = (min(a, first), max(b, last), max(s, share))
                else:
                    found[i].append((first, last, share))
        return [(i, *m) for i in sorted(found) for m in found[i]]


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, id_column: str = "doc_id", text_column: str = "text",
         containment: float = CONTAINMENT) -> DataFrame:
    """A row per passage of a document that holds a template.

    Returns ``doc_id``, ``licence``, ``template`` (place in the list), ``start_word``, ``end_word`` and
    ``containment``. Null, empty and short texts give no row; rows without an id give rows with a null id; rows that
    repeat an id are scanned as texts of their own.
    """
    common.prepare(docs.sparkSession)
    templates = TEMPLATES if templates is None else templates
    rows = docs.select(F.col(id_column).cast("string").alias("id"), F.col(text_column).cast("string").alias("text"))
    schema = "id string, licence string, template int, start_word int, end_word int, containment double"

    def search(first: int):
        some = templates[first:first + AT_ONCE]

        def run(frames):
            index = Index(some, containment)
            for frame in frames:
                out = [(i, some[t][0], first + t, a, b, s) for i, text in zip(frame["id"], frame["text"]) if text
                       for t, a, b, s in index.matches(shingles(text))]
                yield pd.DataFrame(out, columns=["id", "licence", "template", "start_word", "end_word", "containment"])

        return rows.mapInPandas(run, schema)

    found = search(0)
    for first in range(AT_ONCE, len(templates), AT_ONCE):
        found = found.unionByName(search(first))
    return found.select(F.col("id").cast("long").alias("doc_id"), "licence", "template", "start_word", "end_word", "containment")
