"""License scans by winnowed fingerprints and banded alignment.

Templates are cut into overlapping GRAM-word grams; winnowing keeps the least hash of every few neighbours (one or two in short
templates, WINDOW in long ones). The kept hashes form an inverted index (hash to template and place). A document's grams are looked up
in it, and templates with enough hits along near diagonals are candidates. Each candidate is aligned with the document's words around
its hits, within a band, so that inserted, dropped and replaced words (names, years, line noise) are tolerated; the alignment gives
the matched share of the template and the span in the document.

Templates are whole public texts: those of license_texts/ (Apache, GPL, LGPL, MPL, CC0), MIT, BSD, ISC and Unlicense without the
copyright line, and the notices for source files (-header) and single lines (-notice). Entries named -excerpt hold the first part of
a text, so that a truncated one is found, too; their coverage and span are of the excerpt alone. A text that holds another (Apache-2.0
ends with its header) is reported with it. "all-rights-reserved" is a notice that grants nothing; it is reported as such.

The index holds the templates only, so it doesn't grow with the data. Documents are scanned where they lie: no shuffle.

Words are runs of letters and digits in lower case; offsets are code points of the source text, the end exclusive. Defined
results: null and empty texts have no licenses; long texts are scanned whole; repeated rows are scanned one by one; of equally
good alignments of a template the first is reported, and of overlapping ones only the best; an empty table gives an empty
result; further columns are ignored; a text that has no three words in a row of a template, or too few of its kept grams, is not
found.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from tessera.llm.common import arrow_map

GRAM, WINDOW = 3, 3
#: Words that a document may run ahead of a template or behind it: so many at least, and one in BAND_SHARE of the template's.
BAND, BAND_SHARE = 12, 40
#: Grams for which the winnowing window grows by one.
SHORT = 16
#: Of the kept grams of a long template one in LEAST_HITS has to be found; a gram that comes more often in a template is not kept.
LEAST_HITS, MOST_PLACES = 20, 3
#: The least matched share of a template that is reported.
LEAST = 0.7
_WORD = regex.compile(r"[\p{L}\p{N}]+(?:\.[0-9]+)*")

#: Public license texts, file headers and notices, by identifier. What ends in -excerpt is the beginning of another.
TEMPLATES: dict[str, str] = {
    "all-rights-reserved": "All rights reserved.",
    "MIT-notice": "Released under the MIT License.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "MIT-excerpt": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "Apache-2.0-header-excerpt": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/",
    "GPL-header-excerpt": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "BSD-clauses-excerpt": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "ISC-excerpt": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MPL-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
    "MPL-2.0-header-excerpt": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to https://unlicense.org/",
    "Unlicense-excerpt": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}


def whole_texts() -> dict[str, str]:
    """All templates: those above and the files of license_texts/, which the driver reads."""
    folder = Path(__file__).resolve().parent / "license_texts"
    return TEMPLATES | {f.stem: f.read_text(encoding="utf-8") for f in sorted(folder.glob("*.txt"))}


def words(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    found = list(_WORD.finditer(text.lower() if len(text.lower()) == len(text) else text))
    return [m[0].lower() for m in found], [m.span() for m in found]


def grams(ws: list[str]) -> list[int]:
    if len(ws) < GRAM:
        return []
    return [xxhash.xxh3_64_intdigest(" ".join(ws[k : k + GRAM])) for k in range(len(ws) - GRAM + 1)]


def winnow(hashes: list[int]) -> set[int]:
    """Places of the hashes that winnowing keeps: the last least one of each window. Short templates have short windows: a changed
    word costs them three grams, which may be all that a longer window keeps."""
    window = min(WINDOW, 1 + (len(hashes) - 1) // SHORT)
    if len(hashes) <= window:
        return set(range(len(hashes)))
    return {min(range(k, k + window), key=lambda j: (hashes[j], -j)) for k in range(len(hashes) - window + 1)}


class Index:
    """Templates and the inverted index of their winnowed grams."""

    def __init__(self, templates: dict[str, str]):
        self.names = list(templates)
        numbers: dict[str, int] = {}
        self.words = [words(t)[0] for t in templates.values()]
        self.numbers = numbers
        self.coded = [np.array([numbers.setdefault(w, len(numbers) + 1) for w in ws], np.int64) for ws in self.words]
        self.need: list[int] = []
        self.band = [max(BAND, len(ws) // BAND_SHARE) for ws in self.words]
        self.post: dict[int, list[tuple[int, int]]] = defaultdict(list)
        # a document's gram is hashed only if its first two words begin a kept gram
        self.heads: set[tuple[str, str]] = set()
        for t, ws in enumerate(self.words):
            hashes = grams(ws)
            often = Counter(hashes)
            places = [k for k in sorted(winnow(hashes)) if often[hashes[k]] <= MOST_PLACES]
            # replaced words cost up to three grams each, so a text within LEAST may keep few; the alignment decides
            self.need.append(1 if len(hashes) <= SHORT else max(2, len(places) // LEAST_HITS))
            for k in places:
                self.post[hashes[k]].append((t, k))
                self.heads.add((ws[k], ws[k + 1]))

    def candidates(self, ws: list[str]) -> dict[int, list[int]]:
        """Template to the sorted document places where it may begin, one for each run of near diagonals with enough hits."""
        hits: dict[int, list[int]] = defaultdict(list)
        heads, post = self.heads, self.post
        for k, pair in enumerate(zip(ws, ws[1:], strict=False)):
            if pair in heads and k + GRAM <= len(ws):
                for t, at in post.get(xxhash.xxh3_64_intdigest(" ".join(ws[k : k + GRAM])), ()):
                    hits[t].append(k - at)
        out: dict[int, list[int]] = {}
        for t, shifts in hits.items():
            shifts.sort()
            runs, begin = [], 0
            for k in range(1, len(shifts) + 1):
                if k == len(shifts) or shifts[k] - shifts[begin] > self.band[t]:
                    if k - begin >= self.need[t]:
                        runs.append(shifts[(begin + k) // 2])
                    begin = k
            if runs:
                out[t] = runs
        return out

    def holds(self, coded: np.ndarray, t: int, shift: int) -> int:
        """How many of a template's words come at all where an alignment may reach: it matches no more."""
        band = self.band[t]
        return int(np.count_nonzero(np.isin(self.coded[t], coded[max(0, shift - band) : max(0, shift + len(self.coded[t]) + band)])))

    def align(self, coded: np.ndarray, t: int, shift: int) -> tuple[int, int, int] | None:
        """(matched words, first and end place in the document) of the banded alignment: most matches, then fewest skips.
        ``coded`` are the document's words as numbers, 0 for those of no template."""
        own, band = self.coded[t], self.band[t]
        n, width = len(own), 2 * band + 1
        # the document from the first place that the band reaches, with places of no word around it
        low = shift - band
        part = np.zeros(n + width, np.int64) - 1
        a, b = max(0, low), min(len(coded), low + n + width)
        if a < b:
            part[a - low : b - low] = coded[a:b]
        # a cell's value: matches first, then fewer skips; moves: 1 match, 2 both skipped, 3 a template's word skipped, 4 a document's
        one, steps = np.int64(1 << 32), np.arange(width, dtype=np.int64)
        above = np.zeros(width + 1, np.int64)
        moves = np.empty((n, width), np.int8)
        bottom = np.int64(-(1 << 62))
        for i in range(n):
            here = part[i : i + width]
            same, some = here == own[i], here >= 0
            diagonal = np.where(same, above[:-1] + one, np.where(some, above[:-1] - 1, bottom))
            down = above[1:] - 1
            down[-1] = -1  # from beyond the band nothing has matched
            row = np.maximum(diagonal, down)
            move = np.where(diagonal > down, np.where(same, 1, 2), 3).astype(np.int8)
            across = np.maximum.accumulate(row + steps) - steps
            move[across > row] = 4
            moves[i] = move
            above[:-1] = across
        d = int(np.argmax(above[:-1]))
        matched, first, end = 0, -1, -1
        i = n - 1
        while i >= 0:
            move = moves[i, d]
            if move == 4:
                d -= 1
                continue
            if move == 3:
                d += 1
                if d == width:
                    break
            elif move == 1:
                matched += 1
                first = low + i + d
                end = first + 1 if end < 0 else end
            i -= 1
        return (matched, first, end) if matched else None

    def scan(self, text: str | None) -> list[tuple[str, int, int, float, int, int]]:
        """(license, matched words, template words, coverage, start, end) of all matches, in order of license and place."""
        ws, spans = words(text or "")
        found = self.candidates(ws)
        if not found:
            return []
        coded = np.fromiter((self.numbers.get(w, 0) for w in ws), np.int64, len(ws))
        out = []
        for t, shifts in found.items():
            n = len(self.words[t])
            # notices are short: all but one of their words must match
            least = max(LEAST * n, min(n - 1, 6) if n > 3 else n)
            good = {f for shift in shifts if self.holds(coded, t, shift) >= least and (f := self.align(coded, t, shift)) and f[0] >= least and f[2] - f[1] <= 2 * n + self.band[t]}
            out += [(self.names[t], m, n, round(m / n, 6), spans[a][0], spans[b - 1][1]) for m, a, b in _best(good)]
        return sorted(out, key=lambda r: (r[0], r[4]))


def _best(found: set[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of overlapping alignments the best: most words, then the first. Taken spans are kept in order, so each is looked up in them."""
    taken: list[tuple[int, int]] = []
    out = []
    for m, a, b in sorted(found, key=lambda f: (-f[0], f[1], f[2])):
        k = bisect_left(taken, (a, b))
        if (k == 0 or taken[k - 1][1] <= a) and (k == len(taken) or b <= taken[k][0]):
            taken.insert(k, (a, b))
            out.append((m, a, b))
    return out


_SCHEMA = "doc_id long, license string, n_matched long, n_template long, coverage double, char_start long, char_end long"


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """A row for each license text found in each document."""
    shared = docs.sparkSession.sparkContext.broadcast(Index(templates or whole_texts()))

    def batch(b: pa.RecordBatch) -> pa.RecordBatch | None:
        rows = [(k, *r) for k, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True) for r in shared.value.scan(text)]
        if not rows:
            return None
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [f.split()[0] for f in _SCHEMA.split(", ")])

    return arrow_map(docs.select("doc_id", "text"), batch, _SCHEMA)
