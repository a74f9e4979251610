"""License scan: template fingerprints pick candidates, banded alignment confirms them.

Templates are cut into words; an inverted index holds fingerprint -> (template,
place). What is indexed depends on the least coverage, so that no match is
missed:

* of templates of up to 32 words, single words: one more, the rarer ones, than a
  match may leave out, so every match holds one;
* of longer ones the hashes of their 3-word shingles: all of them, or, where a match
  must hold a run of 5 template words, the winnowed ones (the smallest of each 3 in
  a row). Runs are those that words replaced or left out allow; words put in may
  break them up further. Where a match need not hold a run of 3, words again.

A text's hits of one template are grouped by diagonal; each group is aligned with
the template inside a band around its diagonals, and matches that cover enough of
the template are reported with their coverage and span. Words put into a longer
template break it into groups of different diagonals: those that cover too little
alone are chained in the order of text and template, up to ``GAP`` words apart, and
aligned one after the other, each with what the one before it left of the template.

The index is built from the templates given, is small, and travels with the
task; texts are scanned whole and nothing is shuffled. A group is aligned only
if enough of the template's words occur within its band, whatever their order.

The templates are notices, headers and the whole texts in ``license_texts``.
Texts that differ little, as headers of the GNU licenses do, match each other's
templates; coverage and then matched words tell which is nearest.

Defined cases: null and empty texts have no match; templates of fewer than 3
words are rejected; overlapping matches of one template are reported once, the
one that covers most; repeated rows are scanned alike; an empty table gives an
empty result; columns other than id and text are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapstats.llm.common import gives_back, text_or_empty
from lapstats.llm.hashing import mix, words

SHINGLE, WINDOW, BAND = 3, 3, 6
#: Templates of up to so many words are found by single words, and not chained.
SHORT = 32
#: Words that may be put in between two parts of a template, and words without a hit inside a part.
GAP, STRETCH = 400, 16
#: Words that are indexed last, as most texts hold them.
_COMMON = frozenset("a all an and any are as at be but by can for from have if in is it its no not of on or that the this to "
                    "under use used was which will with work you your".split())

_GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the {} as published by the "
    "Free Software Foundation, either version {} of the License, or (at your option) any later version.")
# Notices as their licenses or stewards word them.
NOTICES = {
    "MIT-notice": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-text": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version."),
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-text": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "BSD-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:"),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "All-rights-reserved-notice": "All rights reserved.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."),
    "GPL-2.0-header": _GNU.format("GNU General Public License", 2),
    "LGPL-2.1-header": _GNU.replace("This program", "This library").format("GNU Lesser General Public License", 2.1),
    "LGPL-3.0-header": _GNU.format("GNU Lesser General Public License", 3),
    "AGPL-3.0-header": _GNU.format("GNU Affero General Public License", 3),
    "AGPL-3.0-network-use": (
        "Notwithstanding any other provision of this License, if you modify the Program, your modified version must "
        "prominently offer all users interacting with it remotely through a computer network (if your version supports such "
        "interaction) an opportunity to receive the Corresponding Source of your version by providing access to the "
        "Corresponding Source from a network server at no charge, through some standard or customary means of facilitating "
        "copying of software."),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "BSL-1.0-notice": "Distributed under the Boost Software License, Version 1.0.",
    "BSD-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-SA-4.0-notice": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0-text": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC0-1.0-notice": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to "
        "this software to the public domain worldwide. This software is distributed without any warranty."),
}


def license_texts() -> dict[str, str]:
    """The whole texts that lie beside this module, by SPDX name, without copyright lines and appendices."""
    folder = resources.files(__package__) / "license_texts"
    return {f.name.removesuffix(".txt"): f.read_text(encoding="utf-8")
            for f in sorted(folder.iterdir(), key=lambda f: f.name) if f.name.endswith(".txt")}


TEMPLATES = NOTICES | license_texts()

#: The same words as hashing.words takes, with their places.
_WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _shingles(h: np.ndarray) -> np.ndarray:
    n = len(h) - SHINGLE + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    code = h[:n].copy()
    for i in range(1, SHINGLE):
        code = mix(code * np.uint64(31) + h[i:i + n])
    return code


def _hashes(text: str) -> np.ndarray:
    return words(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8))


class Index:
    """Words and shingles of templates, fingerprint -> (template, place), for matches of ``least`` coverage or more."""

    def __init__(self, templates: dict[str, str], least: float = 0.8) -> None:
        self.least = least
        self.words: dict[str, list[int]] = {}
        self.arrays: dict[str, np.ndarray] = {}
        self.places: defaultdict[int, list[tuple[str, int]]] = defaultdict(list)
        self.word_places: defaultdict[int, list[tuple[str, int]]] = defaultdict(list)
        for name, text in templates.items():
            h = _hashes(text)
            if len(h) < SHINGLE:
                raise ValueError(f"template {name} has fewer than {SHINGLE} words")
            self.words[name] = h.tolist()
            self.arrays[name] = h
            need = next((k for k in range(1, len(h)) if k / len(h) >= least), len(h))
            gaps = len(h) - need
            run = -(-need // (gaps + 1))  # the words next to each other that a match holds at least
            if len(h) <= SHORT or run < SHINGLE:
                own = [m[0].translate(_LOWER) for m in _WORD.finditer(text)]
                rare = sorted(range(len(h)), key=lambda j: (own[j] in _COMMON, -len(own[j]), j))
                for j in sorted(rare[:gaps + 1]):
                    self.word_places[int(h[j])].append((name, j))
                continue
            code = _shingles(h)
            window = WINDOW if run >= SHINGLE + WINDOW - 1 else 1
            # Of equal values in a window the last one.
            picked = {min(range(i, min(i + window, len(code))), key=lambda j: (int(code[j]), -j))
                      for i in range(max(len(code) - window + 1, 1))}
            for j in sorted(picked):
                self.places[int(code[j])].append((name, j))
        self.prints = np.array(sorted(self.places), np.uint64)
        self.word_prints = np.array(sorted(self.word_places), np.uint64)

    def may_cover(self, name: str, h: np.ndarray, low: int, high: int, least: float) -> bool:
        """Whether enough of the template's words occur in the text within the diagonals, each by itself."""
        template = self.arrays[name]
        need = least * len(template)
        if min(high + len(template), len(h)) - max(low, 0) < need:
            return False
        found = np.zeros(len(template), bool)
        for d in range(low, high + 1):
            a, b = max(-d, 0), min(len(template), len(h) - d)
            if a < b:
                found[a:b] |= template[a:b] == h[a + d:b + d]
        return int(found.sum()) >= need

    def chained(self, name: str, h: np.ndarray, groups: list[tuple[int, int, int, int, int, int]],
                least: float) -> list[tuple[float, int, int, int]]:
        """Matches made of groups (text start and end, diagonals, template start and end), by text start."""
        template, out = self.words[name], []
        need = least * len(template)
        while len(groups) > 1:
            # Heaviest chain that ends in each group; its weight is the template words between its groups' hits.
            weight, before = [], []
            for i, (start, _, _, _, first, last) in enumerate(groups):
                best, come = 0, -1
                for p in range(i - 1, -1, -1):
                    if start - groups[p][0] > len(template) + GAP:
                        break
                    if groups[p][5] <= first + SHINGLE - 1 and groups[p][1] <= start + BAND and start - groups[p][1] <= GAP \
                            and weight[p] > best:
                        best, come = weight[p], p
                weight.append(best + last - first)
                before.append(come)
            at = top = max(range(len(groups)), key=lambda i: weight[i])
            chain = []
            while at >= 0:
                chain.append(at)
                at = before[at]
            # At each end of a group, winnowing and the shingles may hide a few words.
            if weight[top] + 2 * (WINDOW + SHINGLE) * len(chain) < need:
                break
            chain.reverse()
            matched, place, span = 0, 0, []
            for n, g in enumerate(chain if len(chain) > 1 else ()):  # one alone has been aligned before
                _, _, low, high, first, _ = groups[g]
                end = groups[chain[n + 1]][4] if n + 1 < len(chain) else len(template)
                # What the group before has left; the next one gets what this one leaves.
                a = min(place, first) if n == 0 else place
                got = align(template[a:max(end, a)], h, low - BAND + a, high + BAND + a)
                if got and (not span or got[1] > span[-1]):
                    matched += got[0]
                    span += got[1:]
                place = max(end, a)
            if span and matched >= need:
                out.append((matched / len(template), matched, span[0], span[-1]))
            groups = [g for i, g in enumerate(groups) if i not in set(chain)]
        return out

    def match(self, text: str, least: float) -> list[tuple[str, float, int, int, int]]:
        """(template, coverage, matched words, start, end) of a text's matches by start."""
        if least < self.least:
            raise ValueError(f"the index is for a coverage of {self.least} or more")
        h = _hashes(text)
        starts: defaultdict[str, list[tuple[int, int, int]]] = defaultdict(list)
        for code, prints, indexed, size in ((_shingles(h), self.prints, self.places, SHINGLE),
                                            (h, self.word_prints, self.word_places, 1)):
            if not len(code) or not len(prints):
                continue
            at = np.minimum(np.searchsorted(prints, code), len(prints) - 1)
            for i in np.flatnonzero(prints[at] == code).tolist():
                for name, j in indexed[int(code[i])]:
                    starts[name].append((i - j, j, j + size))
        if not starts:
            return []
        places: list[tuple[int, int]] = []
        found = []
        for name, hits in starts.items():
            taken: list[tuple[float, int, int, int]] = []
            apart = []
            # Narrower for short templates, so that one match does not reach into the next.
            band = min(BAND, max(len(self.words[name]) // 3, 1))
            for low, high, parts in _groups(sorted(hits), band):
                got = (align(self.words[name], h, low - band, high + band)
                       if self.may_cover(name, h, low - band, high + band, least) else None)
                if got and got[0] / len(self.words[name]) >= least:
                    taken.append((got[0] / len(self.words[name]), *got))
                else:
                    apart += [(first + low, last + high, low, high, first, last) for first, last in parts]
            if len(self.words[name]) > SHORT and len(apart) > 1:
                free = [g for g in apart if all(g[1] <= s or g[0] > e for _, _, s, e in taken)]
                taken += self.chained(name, h, sorted(free), least)
            if taken and not places:
                places = [m.span() for m in _WORD.finditer(text)]
            found += [(name, cover, matched, places[a][0], places[b][1]) for cover, matched, a, b in _disjoint(taken)]
        return sorted(found, key=lambda x: (x[3], -x[1], x[0]))


def _groups(hits: list[tuple[int, int, int]], band: int) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """Runs of diagonals that lie within a band of one another, and the stretches of the template that their hits cover."""
    at = 0
    while at < len(hits):
        end = bisect_right(hits, hits[at][0] + band, lo=at, key=lambda x: x[0])
        parts: list[tuple[int, int]] = []
        for _, a, b in sorted(hits[at:end], key=lambda x: x[1]):
            if parts and a - parts[-1][1] <= STRETCH:
                parts[-1] = (parts[-1][0], max(parts[-1][1], b))
            else:
                parts.append((a, b))
        yield hits[at][0], hits[end - 1][0], parts
        at = end


def _disjoint(taken: list[tuple[float, int, int, int]]) -> list[tuple[float, int, int, int]]:
    """Matches that cover most first; those that overlap one taken go."""
    starts: list[int] = []
    out: dict[int, tuple[float, int, int, int]] = {}
    for m in sorted(taken, key=lambda m: (-m[0], m[3] - m[2], m[2])):
        at = bisect_right(starts, m[3])  # those taken are disjoint, so only the last that starts before m's end can meet it
        if not at or out[starts[at - 1]][3] < m[2]:
            starts.insert(at, m[2])
            out[m[2]] = m
    return list(out.values())


def align(template: list[int], text: np.ndarray, low: int, high: int) -> tuple[int, int, int] | None:
    """Most template words matched in order within diagonals ``low``..``high``; (matched, first, last word of the text).

    Among alignments with the most matches, one with the shortest span in the text.
    """
    # A state: matched words, and the text's first and last word of them. Diagonal: text place - template place.
    width = high - low + 1
    best: list[tuple[int, int, int]] = [(0, 0, -1)] * width
    n = len(text)
    for i, w in enumerate(template):
        row: list[tuple[int, int, int]] = []
        for k in range(width):
            j = i + low + k
            # A template word left out keeps the text place: diagonal k + 1 of the row before.
            state = best[k + 1] if k + 1 < width else (0, 0, -1)
            if row and _better(row[-1], state):
                state = row[-1]  # a text word left out
            if 0 <= j < n and text[j] == w:
                m, s, e = best[k]
                new = (m + 1, s if m else j, j)
                if _better(new, state):
                    state = new
            elif _better(best[k], state):
                state = best[k]
            row.append(state)
        best = row
    top = best[0]
    for s in best[1:]:
        if _better(s, top):
            top = s
    return top if top[0] else None


def _better(a: tuple[int, int, int], b: tuple[int, int, int]) -> bool:
    return a[0] > b[0] or a[0] == b[0] and a[0] > 0 and a[2] - a[1] < b[2] - b[1]


def scan(docs: DataFrame, templates: dict[str, str] | None = None, least: float = 0.8,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and matches (array of license, coverage, matched_words, start, end in code points) for every row."""
    given = dict(TEMPLATES if templates is None else templates)
    kind = T.ArrayType(T.StructType([
        T.StructField("license", T.StringType()), T.StructField("coverage", T.DoubleType()),
        T.StructField("matched_words", T.LongType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    names = ("license", "coverage", "matched_words", "start", "end")
    arrow = pa.list_(pa.struct(list(zip(names, (pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64()), strict=True))))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(given, least)
        for b in batches:
            found = [[dict(zip(names, m, strict=True)) for m in index.match(t, least)] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, arrow)], names=["doc_id", "matches"])

    narrow = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(F.col(text_col)).alias("__text"))
    return narrow.mapInArrow(gives_back(scanned), T.StructType([T.StructField("doc_id", narrow.schema["doc_id"].dataType),
                                                    T.StructField("matches", kind)]))
