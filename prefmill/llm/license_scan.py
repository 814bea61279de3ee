"""License scans by conditional compression.

A text is its words (runs of ASCII letters and digits, lower-cased; points and
hyphens inside words stay). Line ends, comment signs, indentation and other
punctuation are no words, so a wrapped notice is the notice.

Candidates. A notice is a place where at most ``MAX_DIFF`` of a template's
words are replaced, missing or added. A template that allows k of them is cut
into k + 1 runs of words, so one run stands unchanged in every such place; an
Aho-Corasick automaton over all runs finds the places, and a block is what the
template could cover around them. Nothing else decides what is looked at.

Ranking. Each block is compressed alone and with each candidate template as a
zstandard raw dictionary; templates are ranked by how much smaller the
dictionary makes the block. In that order each is confirmed by exact wording:
the least number of differing words over all places in the block (edit
distance, bit-parallel). The template that explains most words wins, of equal
ones the better ranked; the rest of the block is searched again. The ranking
drops no template.

Templates are notices, (id, wording); callers pass their own list for more.

Edge cases: null or empty text has no blocks and finds nothing; a document
with several notices lists each, ordered by position; equal notices are found
each time they stand; repeated rows give repeated rows; a null doc_id is kept;
characters that change their length when lower-cased don't move positions.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from prefmill.llm.util import arrow_map, slices, texts_of
from prefmill.llm.vocab import Cache

GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
CONDITIONS = """1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution."""
DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT
HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED
TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE,
EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
ENDORSEMENT = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from
this software without specific prior written permission."""


def _free_software(name: str, version: str) -> str:
    return f"""This program is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free
Software Foundation, either version {version} of the License, or (at your option) any later version. This program is distributed in the hope that
it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the
{name} for more details."""


#: Identifiers that "SPDX-License-Identifier:" lines are recognised with (fixed values).
SPDX = [
    "MIT",
    "Apache-2.0",
    "BSD-2-Clause",
    "BSD-3-Clause",
    "ISC",
    "Zlib",
    "Unlicense",
    "MPL-2.0",
    "EPL-2.0",
    *(f"{n}{tail}" for n in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0") for tail in ("", "-only", "-or-later")),
    "CC0-1.0",
    "CC-BY-4.0",
    "CC-BY-SA-4.0",
    "CC-BY-NC-4.0",
]
#: Public notices in their usual wording (fixed values).
TEMPLATES: list[tuple[str, str]] = [
    ("MIT", "Released under the MIT License."),
    ("MIT", GRANT),
    (
        "MIT",
        f"""{GRANT} (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions
of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE
OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may
obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the
License for the specific language governing permissions and limitations under the License.""",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("GPL-3.0-or-later", _free_software("GNU General Public License", "3")),
    ("GPL-2.0-or-later", _free_software("GNU General Public License", "2")),
    ("LGPL-3.0-or-later", _free_software("GNU Lesser General Public License", "3")),
    ("AGPL-3.0-or-later", _free_software("GNU Affero General Public License", "3")),
    ("MPL-2.0", "This work is licensed under the Mozilla Public License, version 2.0."),
    (
        "MPL-2.0",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    ),
    ("BSD-3-Clause", BSD),
    ("BSD-2-Clause", f"{BSD}: {CONDITIONS} {DISCLAIMER}"),
    ("BSD-3-Clause", f"{BSD}: {CONDITIONS} {ENDORSEMENT} {DISCLAIMER}"),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the
above copyright notice and this permission notice appear in all copies.""",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("proprietary", "All rights reserved."),
    *((name, f"SPDX-License-Identifier: {name}") for name in SPDX),
]
WORD = re.compile(rb"[A-Za-z0-9]+(?:[.\-][A-Za-z0-9]+)*")
#: Share of a template's words that may differ.
MAX_DIFF = 0.1
#: A place explains its template's words less so many for each that differs; the place that explains most wins.
COST = 3


def words_of(text: str) -> list[str]:
    return b" ".join(WORD.findall(text.encode("utf-8"))).lower().decode("ascii").split(" ") if text else []


def spare(template: list[str]) -> int:
    """Words of a template that may differ."""
    return int(MAX_DIFF * len(template))


def distances(template: list[str], words: list[str]) -> list[int]:
    """For each word, the least edit distance of the template to a run of words that ends there (bit-parallel)."""
    m = len(template)
    full, top = (1 << m) - 1, 1 << (m - 1)
    masks: dict[str, int] = {}
    for k, w in enumerate(template):
        masks[w] = masks.get(w, 0) | 1 << k
    plus, minus, score, out = full, 0, m, []
    for w in words:
        eq = masks.get(w, 0)
        x = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = (minus | ~(x | plus)) & full, plus & x
        score += (up & top > 0) - (down & top > 0)
        up, down = up << 1 & full, down << 1 & full
        plus, minus = (down | ~((eq | minus) | up)) & full, up & (eq | minus)
        out.append(score)
    return out


def nearest(template: list[str], words: list[str]) -> tuple[int, int]:
    """(differing words, word after the last) of the best place, of equally good ones the first to end."""
    found = distances(template, words)
    least = min(found, default=len(template))
    return least, found.index(least) + 1 if found else 0


def _begin(template: list[str], words: list[str], least: int) -> int:
    """Where the place that ends with ``words`` begins: the last begin at this distance (dynamic programming)."""
    m = len(template)
    row = list(range(m + 1))  # distances of the template's last j words to the words taken so far, from the end
    for n, w in enumerate(reversed(words), 1):
        diagonal, row[0] = row[0], n
        for j in range(1, m + 1):
            diagonal, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diagonal + (template[m - j] != w))
        if row[m] == least:
            return len(words) - n
    return 0


class Scanner:
    """Templates as an automaton of their runs and as raw dictionaries, and what they make of a text."""

    def __init__(self, templates: list[tuple[str, str]]):
        import ahocorasick
        import zstandard

        self.templates = [(name, words_of(wording)) for name, wording in templates]
        self.plain = zstandard.ZstdCompressor(level=19)
        self.with_template = [
            zstandard.ZstdCompressor(level=19, dict_data=zstandard.ZstdCompressionDict(" ".join(w).encode("ascii").ljust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for _, w in self.templates
        ]
        self.runs = ahocorasick.Automaton()
        known: dict[str, list[tuple[int, int, int]]] = {}
        for k, (_, words) in enumerate(self.templates):
            parts = spare(words) + 1
            for i in range(parts if words else 0):
                a, b = i * len(words) // parts, (i + 1) * len(words) // parts
                known.setdefault(f" {' '.join(words[a:b])} ", []).append((k, a, b - a))
        for run, at in known.items():
            self.runs.add_word(run, (run.count(" ") - 1, at))
        if known:
            self.runs.make_automaton()
        self.blocks = Cache(lambda found: [self._scan(*b) for b in found], cap=20_000)

    def candidates(self, words: list[str]) -> list[tuple[int, int, tuple[int, ...]]]:
        """(first word, word after the last, templates) of the blocks where a notice may stand."""
        if not words or not len(self.runs):
            return []
        joined = f" {' '.join(words)} "
        spans: list[tuple[int, int, int]] = []
        at = counted = 0
        for end, (n, found) in self.runs.iter(joined):
            # words before the end, counted on from the last hit
            counted += joined.count(" ", at, end)
            at = end
            for k, a, _ in found:
                own, more = len(self.templates[k][1]), spare(self.templates[k][1])
                first = counted - n - a
                spans.append((max(0, first - more), min(len(words), first + own + more), k))
        out: list[list] = []
        for a, b, k in sorted(spans):
            if out and a <= out[-1][1]:
                out[-1][1] = max(b, out[-1][1])
                out[-1][2].add(k)
            else:
                out.append([a, b, {k}])
        return [(a, b, tuple(sorted(ks))) for a, b, ks in out]

    def reductions(self, block: str, chosen: tuple[int, ...]) -> list[tuple[float, int]]:
        """(share of the block's compressed size that the template saves, template), best first."""
        raw = block.encode("ascii")
        alone = len(self.plain.compress(raw))
        return sorted(((1 - len(self.with_template[k].compress(raw)) / alone, k) for k in chosen), key=lambda x: (-x[0], x[1]))

    def _scan(self, block: str, chosen: tuple[int, ...]) -> list[tuple[str, float, int, int]]:
        """(license, reduction, differing words, first word) of every notice in a block."""
        words = block.split(" ")
        out: list[tuple[str, float, int, int]] = []
        free = [(0, len(words))]
        while free:
            a, b = free.pop()
            best = None
            for rank, (gain, k) in enumerate(self.reductions(" ".join(words[a:b]), chosen) if b > a else []):
                name, template = self.templates[k]
                diff, end = nearest(template, words[a:b])
                key = (COST * diff - len(template), rank)
                if diff <= spare(template) and (best is None or key < best[0]):
                    best = (key, name, gain, diff, template, a + end)
            if best:
                _, name, gain, diff, template, end = best
                low = max(a, end - len(template) - diff)
                first = low + _begin(template, words[low:end], diff)
                out.append((name, gain, diff, first))
                free += [(a, first), (end, b)]
        return sorted(out, key=lambda r: (r[3], r[0]))

    def scan(self, texts: list[str]) -> list[list[tuple[str, float, int, int]]]:
        """(license, reduction, differing words, character position) of every notice of each text."""
        split = [words_of(t) for t in texts]
        spans = [self.candidates(w) for w in split]
        keys = [[(" ".join(w[a:b]), ks) for a, b, ks in s] for w, s in zip(split, spans, strict=True)]
        have = self.blocks.fill({k for own in keys for k in own})
        out = []
        for text, s, own in zip(texts, spans, keys, strict=True):
            found = [(name, gain, diff, a + first) for (a, _, _), key in zip(s, own, strict=True) for name, gain, diff, first in have[key]]
            if found:
                raw = text.encode("utf-8")
                starts = [m.start() for m in WORD.finditer(raw)]
                found = [(name, gain, diff, len(raw[: starts[first]].decode("utf-8"))) for name, gain, diff, first in found]
            out.append(found)
        return out


def blocks(text: str, templates: list[tuple[str, str]] | None = None) -> list[tuple[int, str]]:
    """(position, words) of the candidates of a text."""
    words, raw = words_of(text), text.encode("utf-8")
    starts = [m.start() for m in WORD.finditer(raw)]
    return [(len(raw[: starts[a]].decode("utf-8")), " ".join(words[a:b])) for a, b, _ in scanner(tuple(templates or TEMPLATES)).candidates(words)]


@functools.lru_cache(maxsize=2)
def scanner(templates: tuple[tuple[str, str], ...]) -> Scanner:
    return Scanner(list(templates))


def licenses(docs: DataFrame, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """doc_id, n_licenses, licenses (ids joined by commas, in order), notices (id, reduction, differing words, position).

    A narrow, single pass over the texts.
    """
    chosen = tuple(templates or TEMPLATES)
    notice = pa.struct([("license", pa.string()), ("reduction", pa.float64()), ("diff_words", pa.int32()), ("position", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = scanner(chosen)
        for batch in slices(batches):
            found = s.scan(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(f) for f in found], pa.int32()),
                    pa.array([",".join(x[0] for x in f) for f in found], pa.string()),
                    pa.array([[dict(zip(("license", "reduction", "diff_words", "position"), x, strict=True)) for x in f] for f in found], pa.list_(notice)),
                ],
                names=["doc_id", "n_licenses", "licenses", "notices"],
            )

    schema = "doc_id long, n_licenses int, licenses string, notices array<struct<license: string, reduction: double, diff_words: int, position: long>>"
    return arrow_map(texts_of(docs), run, schema)
