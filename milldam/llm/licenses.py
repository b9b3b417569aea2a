"""Licence scans by patience alignment.

A text is compared with licence templates word by word. A part of a text is aligned with a template by patience: words
unique to both are anchors, the longest increasing subsequence of them is kept, and the gaps between anchors are aligned
in the same way. The share of the template's words that are matched is its coverage.

A part qualifies with COVERAGE or more, if it is at most WIDE times as long as the template (SHORT templates: twice),
and, for short templates, if all the words with capitals or digits in them (names, versions) are matched. Regions are
the qualifying parts that end first, one behind the other, so that a template that stands several times in a text is
found as often; each is then aligned further with what the template has before and behind, up to the next region.
Where regions of several templates share over half of the shorter one's words, the one with most matched words stays
(ties: higher coverage, then the template's place in the list).

Parts are looked for only where enough of the template's telling words (its longest ones, half of it) stand within that
length, and aligned only where the longest common subsequence, which no alignment exceeds, reaches the coverage.

Defined results: null and empty texts have no licence; an empty table gives an empty table; several regions of one text
are rows of their own; repeated rows are scanned alike; whole texts are scanned, whatever their length; ids keep their
type; extra columns are left out.
"""

from __future__ import annotations

import math
import uuid
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, slices, table
from .decontaminate import terms, term

COVERAGE = 0.8
#: A region's length at most, in lengths of the template; templates of fewer words than SHORT may only double.
WIDE, SHORT = 4, 20
KNOWN = 500_000

# The wording of public licences and of statements that name them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "MIT": "Released under the MIT License.",
    "MIT text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause text": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-3-Clause text": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "Zlib text": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. This notice may not be removed or altered from any source distribution.""",
    "Unlicense text": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0 notice": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.""",
    "LGPL-2.1 notice": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.""",
    "MPL-2.0 notice": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0 name": "Licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-4.0 short": "Licensed under CC BY 4.0.",
    "CC-BY-4.0": "Licensed under a Creative Commons Attribution 4.0 International License.",
}


#: Words of statements that carry no name though they have capitals.
PLAIN = {"license", "licence", "version", "international"}


def rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence of (i, j), sorted by i, whose j rise."""
    tails, last, back = [], [], [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(tails, j)
        back[k] = last[at - 1] if at else -1
        tails[at : at + 1], last[at : at + 1] = [j], [k]
    out, k = [], last[-1] if last else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def align(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Patience alignment: matched places of a and b, in order."""
    out, gaps = [], [(0, len(a), 0, len(b))]
    while gaps:
        i, m, j, n = gaps.pop()
        while i < m and j < n and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            out.append((m, n))
        if i == m or j == n:
            continue
        ours, theirs = Counter(a[i:m]), Counter(b[j:n])
        place = {b[k]: k for k in range(j, n) if theirs[b[k]] == 1 and b[k] >= 0}
        anchors = rising([(k, place[a[k]]) for k in range(i, m) if ours[a[k]] == 1 and a[k] in place])
        if not anchors:
            continue
        out += anchors
        edges = [(i - 1, j - 1), *anchors, (m, n)]
        gaps += [(p + 1, x, q + 1, y) for (p, q), (x, y) in zip(edges, edges[1:]) if p + 1 < x and q + 1 < y]
    return sorted(out)


class Template:
    """A template's word numbers, and what regions of it must have."""

    def __init__(self, name: str, ids: list[int], spelled: list[str], text: str, coverage: float):
        self.name, self.ids, n = name, ids, len(ids)
        self.need = max(1, math.ceil(coverage * n - 1e-9))
        self.width = 2 * n + 2 if n < SHORT else WIDE * n
        self.counts = Counter(ids)
        self.mask = {i: sum(1 << k for k, x in enumerate(ids) if x == i) for i in self.counts}
        chosen, have = set(), 0
        for i in sorted(self.counts, key=lambda i: (-len(spelled[i]), i)):
            if have >= max(n / 2, n - self.need + 1):
                break
            chosen.add(i)
            have += self.counts[i]
        self.telling, self.enough = sorted(chosen), max(1, have - (n - self.need))
        raw = [t for t in text.split() if term(t)]
        named = [k for k, t in enumerate(raw) if k and any(c.isupper() or c.isdigit() for c in term(t)) and term(t).lower() not in PLAIN]
        self.named = set(named) if n < SHORT else set()

    def fits(self, matched: list[tuple[int, int]]) -> bool:
        return len(matched) >= self.need and self.named <= {j for _, j in matched}

    def starts(self, words: list[int], end: int, low: int) -> int:
        """The last start from which the longest common subsequence up to `end` reaches the need, or -1."""
        n, need, mask = len(self.ids), self.need, self.mask
        full = (1 << n) - 1
        free, reversed_ = full, self.reversed()
        for k in range(end - 1, low - 1, -1):
            m = reversed_.get(words[k])
            if m is None:
                continue
            hit = free & m
            free = ((free + hit) | (free - hit)) & full
            if n - free.bit_count() >= need:
                return k
        return -1

    def reversed(self) -> dict[int, int]:
        """Masks of the template read backwards."""
        if not hasattr(self, "_back"):
            n = len(self.ids)
            self._back = {i: sum(1 << (n - 1 - k) for k, x in enumerate(self.ids) if x == i) for i in self.counts}
        return self._back

    def cores(self, words: list[int], begin: int, end: int) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
        """Qualifying parts of words[begin:end] that end first: start, end, matched places; each begins behind the one before."""
        have, total, first = Counter(), 0, begin
        for e in range(begin, end):
            w = words[e]
            if w not in self.counts:
                continue
            have[w] += 1
            total += have[w] <= self.counts[w]
            while e + 1 - first > self.width:
                x = words[first]
                if x in self.counts:
                    total -= have[x] <= self.counts[x]
                    have[x] -= 1
                first += 1
            if total < self.need:
                continue
            f = self.starts(words, e + 1, first)
            while f >= first:
                matched = align(words[f : e + 1], self.ids)
                if self.fits(matched):
                    yield f, e + 1, [(f + i, j) for i, j in matched]
                    have, total, first = Counter(), 0, e + 1
                    break
                f -= 1

    def regions(self, words: list[int], begin: int, end: int) -> list[list[tuple[int, int]]]:
        """Matched places of each region in words[begin:end]."""
        cores, out, done = list(self.cores(words, begin, end)), [], begin
        for k, (f, e, matched) in enumerate(cores):
            then = cores[k + 1][0] if k + 1 < len(cores) else end
            (head, tail) = matched[0][1], matched[-1][1] + 1
            low = max(done, f - 2 * head, e - self.width)
            before = [(low + i, j) for i, j in align(words[low:f], self.ids[:head])] if head else []
            start = before[0][0] if before else matched[0][0]
            high = min(then, e + 2 * (len(self.ids) - tail), start + self.width)
            behind = [(e + i, tail + j) for i, j in align(words[e:high], self.ids[tail:])] if tail < len(self.ids) else []
            out.append(before + matched + behind)
            done = out[-1][-1][0] + 1
        return out


class Scanner:
    """Templates as word numbers; keeps the numbers of chunks that it has met."""

    def __init__(self, templates: dict[str, str], coverage: float):
        self.name, self.vocabulary, self.known = uuid.uuid4().hex, {}, {}
        numbered = [(name, [self.vocabulary.setdefault(t, len(self.vocabulary)) for t in terms(text)], text) for name, text in templates.items()]
        spelled = list(self.vocabulary)
        self.templates = [Template(name, ids, spelled, text, coverage) for name, ids, text in numbered if ids]
        self.tells = np.zeros((len(self.templates), len(spelled) + 1), bool)
        for k, template in enumerate(self.templates):
            self.tells[k, template.telling] = True
        self.any = self.tells.any(axis=0)

    def ids(self, text: str) -> np.ndarray:
        chunks = text.lower().split()
        known = self.known
        try:
            out = list(map(known.__getitem__, chunks))
        except KeyError:
            if len(known) > KNOWN:
                known.clear()
            none = len(self.vocabulary)
            for c in chunks:
                if c not in known:
                    t = term(c)
                    known[c] = self.vocabulary.get(t, none) if t else -1
            out = list(map(known.__getitem__, chunks))
        ids = np.array(out, dtype=np.int64)
        return ids[ids >= 0]

    def scan(self, text: str | None) -> list[tuple[str, float, int, int, int]]:
        """(template, coverage, matched words, first and last word of the region), words counted without bare punctuation."""
        ids = self.ids(text) if text else np.zeros(0, np.int64)
        if not len(ids) or not self.any[ids].any():
            return []
        none, words, found = len(self.vocabulary), None, []
        for k, template in enumerate(self.templates):
            at = np.flatnonzero(self.tells[k, ids])
            enough = template.enough - 1
            if len(at) <= enough:
                continue
            close = at[enough:] - at[: len(at) - enough] < template.width
            if not close.any():
                continue
            words = words or [i if i != none else -1 for i in ids.tolist()]
            begins, ends = np.maximum(at[: len(at) - enough][close] - template.width, 0), np.minimum(at[enough:][close] + template.width + 1, len(words))
            cuts = np.flatnonzero(begins[1:] > ends[:-1]) + 1
            for i, j in zip(np.concatenate(([0], cuts)), np.concatenate((cuts, [len(begins)])), strict=True):
                for matched in template.regions(words, int(begins[i]), int(ends[j - 1])):
                    found.append((-len(matched), -len(matched) / len(template.ids), k, matched[0][0], matched[-1][0]))
        kept: list[tuple] = []
        for region in sorted(found):
            _, _, _, f, g = region
            if not any(2 * (min(g, y) - max(f, x) + 1) > min(g - f, y - x) + 1 for *_, x, y in kept):
                kept.append(region)
        return [(self.templates[k].name, -share, -matched, f, g) for matched, share, k, f, g in sorted(kept, key=lambda r: (r[3], r[2]))]


_scanners: dict[str, Scanner] = {}


def license_scan(df: DataFrame, templates: dict[str, str] = TEMPLATES, coverage: float = COVERAGE, text: str = "text") -> DataFrame:
    """(doc_id, license, coverage, n_matched, first_word, last_word) of every region found."""
    bounded_batches(df.sparkSession)
    scanner = Scanner(templates, coverage)
    shared, key = df.sparkSession.sparkContext.broadcast(scanner), scanner.name

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _scanners:
            _scanners.clear()
            _scanners[key] = shared.value
        scanner = _scanners[key]
        for whole in batches:
            for batch in slices(whole, "text"):
                rows = [(d, *m) for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True) for m in scanner.scan(t)]
                cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
                kinds = [batch.column("doc_id").type, pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "license", "coverage", "n_matched", "first_word", "last_word"])

    found = T._parse_datatype_string("license string, coverage double, n_matched long, first_word long, last_word long")
    return df.select("doc_id", F.col(text).alias("text")).mapInArrow(run, T.StructType([df.schema["doc_id"], *found.fields]))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))
