"""Licence scans: normalised passages compared to templates by the Dice coefficient over word bigrams."""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows

#: Least Dice coefficient of a match.
THRESHOLD = 0.8
ROWS = 256

# Notices as their publishers word them.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    "mit": (
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "gpl-2.0": (
        "This work is licensed under the GNU General Public License, version 2",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    "lgpl-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "lgpl-2.1": ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",),
    "agpl-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",),
    "isc": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",),
    "bsd": (
        "Released under the BSD License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ),
    "unlicense": ("This is free and unencumbered software released into the public domain.",),
    "cc-by-4.0": ("Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    "cc-by-sa-4.0": ("Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    "cc-by-nc-4.0": ("Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
}

_WORD = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"[^\n.!?]*(?:[.!?]+(?=\S)[^\n.!?]*)*[.!?]*")


def bigrams(words: list[str]) -> frozenset:
    """The set of neighbouring words; a single word stands for itself."""
    return frozenset(zip(words, words[1:])) or frozenset((w, "") for w in words)


def normalised(text: str) -> list[str]:
    """Lower-case words of letters and digits; all else only parts words."""
    return _WORD.findall(text.lower())


class Templates:
    """Templates by the size of their bigram sets, and which of them hold a bigram."""

    def __init__(self, templates=None, threshold: float = THRESHOLD):
        pairs = [(name, bigrams(normalised(t))) for name, texts in (templates or TEMPLATES).items() for t in texts]
        self.pairs = sorted(pairs, key=lambda p: (len(p[1]), p[0]))
        self.sizes = [len(b) for _, b in self.pairs]
        self.threshold = threshold
        self.lengths = [0] * len(self.pairs)
        for name, texts in (templates or TEMPLATES).items():
            for t in texts:
                n = self.pairs.index((name, bigrams(normalised(t))))
                self.lengths[n] = max(self.lengths[n], len(normalised(t)))
        self.holders: dict[tuple, list[int]] = defaultdict(list)
        for n, (_, b) in enumerate(self.pairs):
            for x in b:
                self.holders[x].append(n)

    def best(self, words: list[str]) -> tuple[str, float] | None:
        """The template with the highest coefficient (ties: by name) if that reaches the threshold.

        2 common / (a + b) with common at most the smaller: only templates of
        size a t / (2 - t) to a (2 - t) / t can reach t.
        """
        own = bigrams(words)
        a, t = len(own), self.threshold
        low = bisect_left(self.sizes, a * t / (2 - t) - 1e-9)
        high = bisect_right(self.sizes, a * (2 - t) / t + 1e-9)
        if low >= high:
            return None
        common: dict[int, int] = defaultdict(int)
        for x in own:
            for n in self.holders.get(x, ()):
                if low <= n < high:
                    common[n] += 1
        found = [(-2 * c / (a + self.sizes[n]), self.pairs[n][0]) for n, c in common.items()]
        return (min(found)[1], -min(found)[0]) if found and -min(found)[0] >= t else None


def windows(spelt: list[str], shared: list[int], templates: Templates):
    """(first, last) words of the windows of each template's own number of words that may match it, wherever lines and sentences end.

    2 common / (a + b) >= t with a >= common takes at least b t / (2 - t) of the
    template's bigrams, so windows start where a bigram of the template has so
    many others of its bigrams close behind; they end with the last of them.
    """
    places: dict[int, list[int]] = defaultdict(list)
    for i in shared:
        for n in templates.holders[(spelt[i], spelt[i + 1] if i + 1 < len(spelt) else "")]:
            places[n].append(i)
    for n, hits in places.items():
        least = max(1, math.ceil(templates.sizes[n] * templates.threshold / (2 - templates.threshold) - 1e-9))
        if len(hits) < least:
            continue
        length = templates.lengths[n]
        for i in range(len(hits) - least + 1):
            if hits[i + least - 1] - hits[i] < length - 1:
                stop = bisect_right(hits, hits[i] + length - 2) - 1
                yield hits[i], hits[stop] + 2


def passages(text: str):
    """(start, end) of the whole text, its paragraphs (at blank lines), lines and sentences; each once."""
    spans = {(0, len(text))} if text else set()
    at = 0
    for block in re.split(r"(\n[ \t\r]*\n)", text):
        spans.add((at, at + len(block)))
        at += len(block)
    at = 0
    for line in text.split("\n"):
        spans.add((at, at + len(line)))
        for m in _SENTENCE.finditer(line):
            spans.add((at + m.start(), at + m.end()))
        at += len(line) + 1
    return spans


def matches(text: str | None, templates: Templates) -> list[tuple[int, int, str, float]]:
    """(start, end, licence, coefficient) of the matching passages and windows by start; none overlaps a better one.

    Of overlapping matches the one with the higher coefficient stays, then the earlier, then the longer.
    """
    if not text:
        return []
    words = [(m.start(), m.group()) for m in _WORD.finditer(text.lower())] if len(text.lower()) == len(text) else [(m.start(), m.group().lower()) for m in _WORD.finditer(text)]
    at = [s for s, _ in words]
    spelt = [w for _, w in words]
    shared = [i for i, pair in enumerate(zip(spelt, [*spelt[1:], ""])) if pair in templates.holders]
    if not shared:
        return []
    largest = templates.sizes[-1] * (2 - templates.threshold) / templates.threshold
    found = []
    for start, end in passages(text):
        first, last = bisect_left(at, start), bisect_left(at, end)
        k = bisect_left(shared, first)
        if k < len(shared) and shared[k] < last and (last - first <= largest + 1 or len(set(zip(spelt[first:last], spelt[first + 1 : last]))) <= largest):
            best = templates.best(spelt[first:last])
            if best:
                # from the first word to the last
                found.append((at[first], at[last - 1] + len(spelt[last - 1]), *best))
    for first, last in set(windows(spelt, shared, templates)):
        best = templates.best(spelt[first:last])
        if best:
            last = min(last, len(spelt))
            found.append((at[first], at[last - 1] + len(spelt[last - 1]), *best))
    out: list[tuple[int, int, str, float]] = []  # by start; as none overlap, only the neighbours can be in the way
    for m in sorted(set(found), key=lambda m: (-m[3], m[0], -m[1])):
        k = bisect_left(out, m[:1])
        if (k == 0 or out[k - 1][1] <= m[0]) and (k == len(out) or out[k][0] >= m[1]):
            out.insert(k, m)
    return out


def licences(docs: DataFrame, templates=None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_matches, licence, score and spans of every row of ``docs``.

    Whole texts, paragraphs, lines, sentences and, across all of these, windows of
    each template's number of words are compared to every template whose size
    allows ``threshold``.  ``licence`` and ``score`` are those of the
    best match, ``spans`` lists licence:start:end (code points) of all.  Null
    and empty texts match nothing; a null doc_id is kept; repeated rows come
    back as given; extra columns are ignored.
    """
    kept = Templates(templates, threshold)

    def run(cols):
        found = [matches(t, kept) for t in cols["text"]]
        best = [min(((-m[3], m[0], m[2]) for m in f), default=None) for f in found]
        return {
            "doc_id": cols["doc_id"], "n_matches": [len(f) for f in found], "licence": [b and b[2] for b in best],
            "score": [-b[0] if b else 0.0 for b in best], "spans": [",".join(f"{m[2]}:{m[0]}:{m[1]}" for m in f) for f in found],
        }

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return map_rows(rows, "doc_id bigint, n_matches bigint, licence string, score double, spans string", run, ROWS)
