"""License scans: MinHash bands over overlapping text windows retrieve templates, exact shingle containment verifies.

Texts and templates are compared as ASCII-lower-cased words of letters and digits, in shingles of WIDTH words. A template of n
shingles belongs to the smallest scale s with n <= 3/4 s; windows of s shingles start every s/4, so one of them holds
all of a copy. Such a window has Jaccard similarity of at least 3/8 to the template if the copy is exact, and 0.28
if a quarter of its shingles are lost. With BANDS bands of one row a window misses its template with a probability
of (1 - J) ** BANDS at most: under 2e-5 and 4e-4. Windows whose band meets a template's are merged into regions of whole
texts. Within a region a copy is the shortest run of words that holds the share `containment` of the template's distinct shingles,
with what follows and precedes it without a shingle occurring more often than in the template; the next copy begins behind it.

Templates are a bounded list that is sent out; texts are mapped, not shuffled. Null and empty texts match nothing, nor do
templates of fewer words than a shingle; rows that repeat a doc_id or lack one are scanned each; a text of any length is scanned
whole. Columns other than doc_id and text are not read; an empty table gives an empty result.

Licenses differ by few words, so containment alone would report siblings too. A copy must hold each number of its template
(versions) next to one of its neighbours there. Of two templates that share most of the shorter one's shingles and match
one passage, that stays of whose telling shingles (its own that the other lacks) the passage holds the larger share; one that has
none is a part of the other and goes. Equal shares go by containment, then length, then the order of the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from orrery.llm.common import arrow_rows, slices, texts
from orrery.llm.jaccard import MEMO, mixed

WIDTH, BANDS, LEAST = 2, 36, 8
CONTAINMENT = 0.8

# Public license notices in their usual wording.
TEMPLATES = {
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "MIT line": "Released under the MIT License.",
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-ND-4.0": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "CC-BY-NC-SA-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "CC-BY-NC-ND-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    "GPL-2.0 line": "This work is licensed under the GNU General Public License, version 2.",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "Apache-2.0 notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "MIT permission": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
    "GPL-3.0 notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "MIT": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "ISC": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    "BSD-2-Clause": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    "MIT-0": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "0BSD": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. This notice may not be removed or altered from any source distribution.",
    "GPL-2.0 notice": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "LGPL-2.1 notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "LGPL-3.0 notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
    "AGPL-3.0 notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.",
    "EPL-2.0 notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "BSD-3-Clause": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    "MPL-2.0 notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
}

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))
_OUT = "doc_id long, license string, start_word long, end_word long, containment double, windows long"


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        h = xxh64_intdigest(word)
        if len(self) < MEMO:
            self[word] = h
        return h


class Scanner:
    def __init__(self, templates: dict[str, str], containment: float):
        self.hashes, self.containment = _Hashes(), containment
        self.names = [*templates]
        counted = [np.unique(self.shingles(t), return_counts=True) for t in templates.values()]
        self.sets = [a for a, _ in counted]
        self.often = [dict(zip(a.tolist(), n.tolist())) for a, n in counted]
        # for each template the shingles of each of its numbers, and against siblings what either has alone
        self.numbers = [self._numbers(t) for t in templates.values()]
        self.alone: dict[tuple[int, int], np.ndarray] = {}
        for i, a in enumerate(self.sets):
            for j, b in enumerate(self.sets):
                if i != j and len(a) and len(b) and len(np.intersect1d(a, b)) >= containment * min(len(a), len(b)):
                    self.alone[i, j] = np.setdiff1d(a, b)
        rng = np.random.default_rng(4)
        self.keys = rng.integers(1, 1 << 63, BANDS, dtype=np.uint64) | np.uint64(1)
        self.scales: dict[int, list[int]] = {}
        for k, s in enumerate(self.sets):
            scale = LEAST
            while 4 * len(s) > 3 * scale:
                scale *= 2
            if len(s):
                self.scales.setdefault(scale, []).append(k)
        # for each scale and band the templates' least hashes
        self.bands = {scale: [self._band(ks, key) for key in self.keys] for scale, ks in self.scales.items()}

    def _band(self, ks: list[int], key: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        least = np.array([(self.sets[k] * key).min() for k in ks], np.uint64)
        order = np.argsort(least)
        return least[order], np.array(ks)[order]

    def _numbers(self, text: str) -> list[np.ndarray]:
        """The shingles around each word of digits."""
        w, own = text.encode().translate(_FOLD).split(), self.shingles(text)
        return [own[max(0, i - 1) : i + 1] for i, x in enumerate(w) if x.isdigit()]

    def settled(self, s: np.ndarray, found: list[tuple]) -> list[tuple]:
        """Of the copies (template, first, end, share, windows) of one text those that hold their numbers and lose to no sibling of their passage."""
        found = [f for f in found if all(np.isin(n, s[f[1] : f[2]]).any() for n in self.numbers[f[0]])]

        def loses(f: tuple, g: tuple) -> bool:
            if (f[0], g[0]) not in self.alone or 2 * (min(f[2], g[2]) - max(f[1], g[1])) < min(f[2] - f[1], g[2] - g[1]):
                return False
            passage = s[min(f[1], g[1]) : max(f[2], g[2])]

            def rank(a: tuple, b: tuple) -> tuple:
                own = self.alone[a[0], b[0]]
                return np.isin(own, passage).mean() if len(own) else -1.0, a[3], len(self.sets[a[0]]), -a[0]

            return rank(f, g) < rank(g, f)

        return [f for f in found if not any(loses(f, g) for g in found)]

    def shingles(self, text: str) -> np.ndarray:
        w = text.encode().translate(_FOLD).split()
        h = np.fromiter(map(self.hashes.__getitem__, w), np.uint64, len(w))
        if len(h) < WIDTH:
            return np.zeros(0, np.uint64)
        return mixed(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:])

    def retrieved(self, s: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(template, start, scale) of windows that share a band with a template; windows start at multiples of a quarter of the scale in the shingles of several texts laid end to end."""
        top = max(self.bands, default=LEAST)
        n = -(-len(s) // top) * top + top
        padded = np.zeros(n, np.uint64)
        padded[: len(s)] = s
        found: dict[int, list[np.ndarray]] = {scale: [] for scale in self.bands}
        for band, key in enumerate(self.keys):
            least = padded * key
            least[len(s) :] = np.iinfo(np.uint64).max
            step = 1
            while step < top // 4:
                # the least hash of each run of `step` shingles, for all scales in turn
                least, step = np.minimum(least[::2], least[1::2]), 2 * step
                if 4 * step in self.bands:
                    window = np.minimum(np.minimum(least[:-3], least[1:-2]), np.minimum(least[2:-1], least[3:]))
                    for a, k in zip(*self.bands[4 * step][band]):
                        at = np.flatnonzero(window == a)
                        if len(at):
                            found[4 * step].append(at * len(self.sets) + k)
        for scale, codes in found.items():
            if codes:
                for code in np.unique(np.concatenate(codes)):
                    yield int(code % len(self.sets)), int(code // len(self.sets)) * (scale // 4), scale

    def scan(self, batch: list[str]) -> Iterator[tuple[int, str, int, int, float, int]]:
        """(number of the text, license, start, end word, containment, windows)."""
        each = [self.shingles(t) for t in batch]
        ends = np.cumsum([len(x) for x in each])
        if not len(ends) or not ends[-1]:
            return
        s = np.concatenate(each)
        regions: dict[int, list[list[int]]] = {}
        for k, a, scale in sorted(self.retrieved(s)):
            own = regions.setdefault(k, [])
            # a copy may reach beyond a window that meets only part of it
            lo, hi = max(0, a - scale), min(len(s), a + 2 * scale)
            if own and lo <= own[-1][1]:
                own[-1][1] = max(own[-1][1], hi)
                own[-1][2] += 1
            else:
                own.append([lo, hi, 1])
        found: dict[int, list[tuple]] = {}
        for k, spans in regions.items():
            t, size = self.sets[k], len(self.sets[k])
            for lo, hi, windows in spans:
                hits = np.flatnonzero(np.isin(s[lo:hi], t)) + lo
                doc = np.searchsorted(ends, hits, "right")
                # hits that stand apart by more than the template's length belong to different copies
                for part in np.split(hits, np.flatnonzero((np.diff(hits) > size) | (np.diff(doc) > 0)) + 1):
                    for a, b in self.copies(s[part], k):
                        share = len(np.unique(s[part[a:b]])) / size
                        found.setdefault(int(np.searchsorted(ends, part[a], "right")), []).append((k, int(part[a]), int(part[b - 1]) + 1, share, windows))
        for d, own in found.items():
            base = int(ends[d] - len(each[d]))
            for k, first, end, share, windows in self.settled(s, own):
                yield d, self.names[k], first - base, end - 1 - base + WIDTH, share, windows

    def copies(self, hits: np.ndarray, k: int) -> Iterator[tuple[int, int]]:
        """Runs (first, end) of hits that each hold the asked share of template k's distinct shingles."""
        need, often = self.containment * len(self.sets[k]), self.often[k]
        hits = hits.tolist()
        seen: dict[int, int] = {}
        first, begin = 0, 0
        at = 0
        while at < len(hits):
            seen[hits[at]] = seen.get(hits[at], 0) + 1
            at += 1
            if len(seen) < need:
                continue
            # the shortest run that ends here
            while True:
                x = hits[first]
                if seen[x] == 1 and len(seen) - 1 < need:
                    break
                seen[x] -= 1
                if not seen[x]:
                    del seen[x]
                first += 1
            while first > begin and seen.get(hits[first - 1], 0) < often[hits[first - 1]]:
                first -= 1
                seen[hits[first]] = seen.get(hits[first], 0) + 1
            while at < len(hits) and seen.get(hits[at], 0) < often[hits[at]]:
                seen[hits[at]] = seen.get(hits[at], 0) + 1
                at += 1
            yield first, at
            first = begin = at
            seen = {}


def scan(docs: DataFrame, templates: dict[str, str] | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """(doc_id, license, start_word, end_word, containment, windows): one row for each copy of a template in a text."""
    templates = TEMPLATES if templates is None else templates
    kinds = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("start_word", pa.int64()), ("end_word", pa.int64()), ("containment", pa.float64()), ("windows", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, containment)

        def rows():
            for b in batches:
                for part in slices(b, 1, 200):
                    keys = part.column(0).to_pylist()
                    yield from ((keys[d], *rest) for d, *rest in scanner.scan(part.column(1).to_pylist()))

        yield from arrow_rows(rows(), kinds)

    return texts(docs).mapInArrow(run, _OUT)
