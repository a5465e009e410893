"""License scans by patience alignment (operator 7).

Each template is a known licence notice as a list of words. Text and template are aligned as patience
diff does: words that are unique in both are anchors; the longest increasing subsequence of their
places keeps those in one order; between neighbouring anchors the same is done again, down to gaps
without unique common words, where equal words at the gap's ends are matched and the rest is not.
Coverage is the share of the template's words that the alignment matches, counted in the stretch of
text around it: the alignment is made within windows of the text, at each place where a run of the
template's rare words begins, so that a notice in a long document is aligned with its surroundings
only. A template is found where the coverage is ``COVERAGE`` or more.

Words are runs of letters and digits, in lower case. Defined cases: a null or empty text has no
words and no notice; a null doc_id stays null; equal rows get equal results; an empty table gives no
row; other columns are not read. Of templates found at overlapping places the one with more matched
words counts, of equal ones the first listed.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm.common import query, table

COVERAGE = 0.8


def _gnu(name: str, version: str, what: str = "program", below: str = "You should have received a copy of the {name} along with this {what}. If not, see <https://www.gnu.org/licenses/>.") -> tuple[str, str]:
    """The first paragraph of the standard header of a GNU licence, and the whole header."""
    first = (f"This {what} is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation, "
             f"either version {version} of the License, or (at your option) any later version.")
    hope = (f"This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS "
            f"FOR A PARTICULAR PURPOSE. See the {name} for more details.")
    return first, f"{first} {hope} {below.format(name=name, what=what)}"


_BY_POST = "You should have received a copy of the {name} along with this {what}; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA"
_GNU = {
    "GPL-2.0": _gnu("GNU General Public License", "2", below=_BY_POST),
    "GPL-3.0": _gnu("GNU General Public License", "3"),
    "LGPL-2.0": _gnu("GNU Library General Public License", "2", "library", _BY_POST),
    "LGPL-2.1": _gnu("GNU Lesser General Public License", "2.1", "library", _BY_POST),
    "LGPL-3.0": _gnu("GNU Lesser General Public License", "3", "library"),
    "LGPL-2.1-program": _gnu("GNU Lesser General Public License", "2.1", below=_BY_POST),
    "LGPL-3.0-program": _gnu("GNU Lesser General Public License", "3"),
    "AGPL-3.0": _gnu("GNU Affero General Public License", "3"),
}
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAME = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."

# Published licence notices, whole and in their short forms; of long ones the first sentence too,
# for texts that hold no more of it.
TEMPLATES = {
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "LGPL-2.1": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "Apache-2.0-short": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "MIT-short": "Released under the MIT License.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-4.0-short": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-short": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0-short": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "public-domain": "This work is in the public domain.",
    "all-rights-reserved": "All rights reserved.",
    **{f"{name}-header": first for name, (first, _) in _GNU.items()},
    **{f"{name}-whole": whole for name, (_, whole) in _GNU.items()},
    "Apache-2.0-whole": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "MIT-whole": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "BSD-2-Clause": f"{_BSD_HEAD} {_BSD_END}",
    "BSD-3-Clause": f"{_BSD_HEAD} {_BSD_NAME} {_BSD_END}",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "EPL-1.0": "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "MPL-2.0-whole": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
}

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[tuple[str, int, int]]:
    return [(m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(text)]


def increasing(places: list[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence, by patience piles."""
    tops: list[int] = []
    pile: list[int] = []
    before: list[int] = []
    for k, x in enumerate(places):
        j = bisect_left(tops, x)
        before.append(pile[j - 1] if j else -1)
        if j == len(tops):
            tops.append(x)
            pile.append(k)
        else:
            tops[j], pile[j] = x, k
    out = []
    k = pile[-1] if pile else -1
    while k >= 0:
        out.append(k)
        k = before[k]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of places of equal words of both, increasing in both."""
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
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        at = {w: k for k, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        anchors = [(k, at[w]) for k, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in at]
        kept = [anchors[k] for k in increasing([y for _, y in anchors])]
        if not kept:
            continue
        out += kept
        edges = [(a0 - 1, b0 - 1), *kept, (a1, b1)]
        todo += [(x0 + 1, x1, y0 + 1, y1) for (x0, y0), (x1, y1) in zip(edges, edges[1:], strict=False)]
    return sorted(out)


@dataclass(frozen=True)
class Found:
    template: str
    begin: int
    end: int
    matched: int
    coverage: float


class Licenses:
    """Templates with their words; a text is only aligned where it holds a template's seed, the words that
    fewest templates share."""

    def __init__(self, templates: dict[str, str] = TEMPLATES, coverage: float = COVERAGE):
        self.coverage = coverage
        self.templates = {name: [w for w, _, _ in words_of(t)] for name, t in templates.items()}
        self.counts = {name: Counter(t) for name, t in self.templates.items()}
        self.words = set().union(*self.templates.values()) if templates else set()

    def find(self, text: str | None) -> list[Found]:
        words = words_of(text or "")
        if not words:
            return []
        ours = [(k, w) for k, (w, _, _) in enumerate(words) if w in self.words]
        present = {w for _, w in ours}
        found: list[Found] = []
        for name, template in self.templates.items():
            own = self.counts[name]
            n = len(template)
            need = max(1, -(-round(self.coverage * 1000) * n // 1000))
            # no alignment matches more than the template's words that the text has at all
            if sum(own[w] for w in own.keys() & present) < need:
                continue
            places = [k for k, w in ours if w in own]
            slack = n // 4 + 2  # words that may stand between in a changed notice
            i = 0
            while i + need <= len(places):
                # the need-th of the template's words from here on must come soon enough
                if places[i + need - 1] - places[i] >= n + slack:
                    i += 1
                    continue
                lo, hi = max(0, places[i] - slack), min(len(words), places[i] + n + slack)
                pairs = align([w for w, _, _ in words[lo:hi]], template)
                if len(pairs) >= self.coverage * n:
                    first, last = lo + pairs[0][0], lo + pairs[-1][0]
                    found.append(Found(name, words[first][1], words[last][2], len(pairs), len(pairs) / n))
                    while i < len(places) and places[i] <= last:
                        i += 1
                else:
                    i += 1
        best: list[Found] = []
        for f in sorted(found, key=lambda f: (-f.matched, -f.coverage)):
            if all(f.end <= g.begin or g.end <= f.begin for g in best):
                best.append(f)
        return sorted(best, key=lambda f: f.begin)


def scan(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and notices, an array of (template, begin, end, matched, coverage)."""
    templates = TEMPLATES if templates is None else templates
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = pa.list_(pa.struct([("template", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("matched", pa.int64()), ("coverage", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Licenses(templates, coverage)
        for batch in batches:
            rows = [[vars(f) for f in known.find(t)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], ["doc_id", "notices"])

    return own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, notices array<struct<template:string,begin:bigint,end:bigint,matched:bigint,coverage:double>>")


@query
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    text = F.array_join(F.transform("notices", lambda f: F.concat_ws(":", f["template"], f["begin"], f["end"], F.round(f["coverage"], 3))), ",")
    return found.select("doc_id", F.size("notices").cast("long").alias("n_notices"), F.array_join(F.array_distinct(F.transform("notices", lambda f: f["template"])), ",").alias("licenses"), text.alias("notices"))
