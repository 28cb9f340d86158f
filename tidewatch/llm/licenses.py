"""License scans by patience alignment.

A text is cut into windows, each overlapping the next by the template's length, wherever there are words
that give a template away; where these find nothing, into wider ones, up to the whole text. In a window, words that are unique both to the window and to a template are anchors; the longest increasing subsequence of
their places is kept, and the gaps between anchors are aligned in the same way. The share of a template's
words that are aligned is its coverage.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS = re.compile(r"[a-z0-9]+")

# Words of public license notices, in the form that files and pages carry.
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING "
    "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
    "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_APACHE = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You "
    "may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
    "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
    "either express or implied. See the License for the specific language governing permissions and limitations under the License."
)
_GPL = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
    "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed "
    "in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
    "PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public "
    "License along with this program. If not, see https://www.gnu.org/licenses/."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
    "are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
    "the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR "
    "DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."
)
_MPL = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
    "file, You can obtain one at https://mozilla.org/MPL/2.0/."
)
#: (license, template); several templates may name one license.
TEMPLATES = (
    ("MIT", _MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", _GPL),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("BSD", _BSD),
    ("BSD", "Released under the BSD License."),
    ("ISC", _ISC),
    ("MPL-2.0", _MPL),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
)


@dataclass(frozen=True)
class Scan:
    """`least` coverage of a template. One of less than `short` words must be covered by `least_short`, its telling
    words and numbers included, in a stretch of as many words and two more. The first windows are half as long
    again as their template, and `slack` words; they double until they hold the text.
    """

    least: float = 0.7
    short: int = 16
    least_short: float = 0.75
    slack: int = 8


def unique_anchors(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of words unique in both, thinned to the longest run that rises in both."""
    once_a, once_b = Counter(a), Counter(b)
    place = {w: j for j, w in enumerate(b) if once_b[w] == 1}
    pairs = [(i, place[w]) for i, w in enumerate(a) if once_a[w] == 1 and w in place]
    tails: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(tails, j)
        back.append(ends[at - 1] if at else -1)
        if at == len(tails):
            tails.append(j)
            ends.append(k)
        else:
            tails[at], ends[at] = j, k
    chain, k = [], ends[-1] if ends else -1
    while k >= 0:
        chain.append(pairs[k])
        k = back[k]
    return chain[::-1]


def patience(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of aligned places: equal starts and ends, anchors, and the same for each gap between anchors."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        last = (a0 - 1, b0 - 1)
        anchors = [(a0 + i, b0 + j) for i, j in unique_anchors(a[a0:a1], b[b0:b1])]
        for i, j in anchors:
            out.append((i, j))
            todo.append((last[0] + 1, i, last[1] + 1, j))
            last = (i, j)
        if anchors:
            todo.append((last[0] + 1, a1, last[1] + 1, b1))
    return sorted(out)


class Scanner:
    """Templates as words, and for each the words that give it away: those of the fewest licenses.

    A stretch that covers a template as wanted has one of its cues: the places of all other words are too few.
    """

    def __init__(self, templates: tuple[tuple[str, str], ...], scan: Scan) -> None:
        self.scan = scan
        self.templates = [(name, WORDS.findall(text.lower())) for name, text in templates]
        self.templates = [(name, words) for name, words in self.templates if words]
        licenses: dict[str, set[str]] = {}
        for name, words in self.templates:
            for w in words:
                licenses.setdefault(w, set()).add(name)
        self.cues = [self._cues(words, licenses) for _, words in self.templates]
        self.any = set().union(*self.cues)

    def _cues(self, words: list[str], licenses: dict[str, set[str]]) -> set[str]:
        order = sorted(set(words), key=lambda w: (w in _COMMON, len(licenses[w]), w))
        if len(words) < self.scan.short:
            return {w for w in order if (w in _COMMON, len(licenses[w])) == (order[0] in _COMMON, len(licenses[order[0]]))}
        count, left, cues = Counter(words), len(words), set()
        while left >= self.scan.least * len(words):
            cues.add(order[len(cues)])
            left -= count[order[len(cues) - 1]]
        return cues

    def find(self, text: str) -> list[tuple[str, float, int, int]]:
        """(license, coverage, start, end) in words: the best template of a license at a place, and of licenses
        of which one's stretch lies inside another's, the one with more words aligned."""
        words = WORDS.findall(text.lower())
        if self.any.isdisjoint(words):
            return []
        at = [i for i, w in enumerate(words) if w in self.any]
        counts, found = Counter(words), []
        for (name, template), cues in zip(self.templates, self.cues):
            if sum(min(n, counts[w]) for w, n in Counter(template).items()) < min(self.scan.least, self.scan.least_short) * len(template):
                continue
            places = [i for i in at if words[i] in cues]
            if places:
                look = self._short if len(template) < self.scan.short else self._long
                found += look(name, template, cues, words, places)
        found.sort(key=lambda f: (f[0], f[2], -f[1]))
        out: list[tuple[str, float, int, int, int]] = []
        for f in found:
            if out and out[-1][0] == f[0] and f[2] < out[-1][3]:
                if f[1] > out[-1][1]:
                    out[-1] = f
            else:
                out.append(f)
        dense = [g for g in out if g[3] - g[2] <= 3 * g[4]]
        inner = lambda f: any(g[2] <= f[2] and f[3] <= g[3] and g[4] > f[4] for g in dense if g[0] != f[0])
        return [f[:4] for f in out if not inner(f)]

    def _long(self, name: str, template: list[str], cues: set[str], words: list[str], places: list[int]) -> list[tuple[str, float, int, int, int]]:
        """Alignments in windows around cues. What windows of one width leave is gone over by wider ones, up to
        the whole text, so words put into a notice do not hide it, however many."""
        size = len(template)
        wanted = Counter(template)
        width, found = size + max(size // 2, 1) + self.scan.slack, []
        while True:
            step, done, new = max(width // 3, 1), -1, []
            for i in places:
                for start in range(max((i - width) // step + 1, done + 1, 0), i // step + 1):
                    done = start
                    first, last = start * step, min(start * step + width, len(words))
                    window = words[first:last]
                    if sum((wanted & Counter(w for w in window if w in wanted)).values()) < self.scan.least * size:
                        continue
                    pairs = patience(window, template)
                    if len(pairs) >= self.scan.least * size:
                        new.append((name, len(pairs) / size, first + pairs[0][0], first + pairs[-1][0] + 1, len(pairs)))
            found += [f for f in new if not any(f[2] < g[3] and g[2] < f[3] for g in found)]
            if width >= len(words):
                return found
            width *= 2
            places = [i for i in places if not any(f[2] <= i < f[3] for f in found)]

    def _short(self, name: str, template: list[str], cues: set[str], words: list[str], places: list[int]) -> list[tuple[str, float, int, int, int]]:
        """Alignments of a short template around its first cue that hold all its cues and numbers."""
        scan, size = self.scan, len(template)
        needed = {j for j, w in enumerate(template) if w in cues or w.isdigit()}
        k = min(j for j, w in enumerate(template) if w in cues)
        out = []
        for i in places:
            if words[i] != template[k]:
                continue
            first = max(i - k - 1, 0)
            window = words[first : i - k + size + 1]
            if not needed <= {j for j, w in enumerate(template) if w in window}:
                continue
            pairs = patience(window, template)
            if len(pairs) >= scan.least_short * size and needed <= {j for _, j in pairs}:
                out.append((name, len(pairs) / size, first + pairs[0][0], first + pairs[-1][0] + 1, len(pairs)))
        return out


# English words too frequent to give a license away.
_COMMON = set("a an and any are as at be by for from if in is it no not of on or that the this to use was with you".split())


def scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, settings: Scan = Scan()) -> DataFrame:
    """doc_id, license, coverage, start and end (words) of every license notice in every text.

    Null and empty texts have none; repeated rows each give their own; without templates there are no
    rows. Texts are independent, so nothing is shuffled.
    """
    scanner = Scanner(templates, settings)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.float64(), pa.int32(), pa.int32()]
        for part in parts:
            rows = [(doc.as_py(), *f) for doc, text in zip(part.column(0), part.column(1)) for f in scanner.find(text.as_py() or "")]
            if rows:
                yield pa.record_batch([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], ["doc_id", "license", "coverage", "start", "end"])

    found = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, license string, coverage double, start int, end int")
    return found.withColumn("words", F.expr("end - start"))
