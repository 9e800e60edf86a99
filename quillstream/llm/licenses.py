"""License scans: winnowed template fingerprints pick candidates, banded alignment decides.

Templates are cut into words; of the hashes of SHINGLE adjacent words, the least of each PICK neighbours enters an
inverted index (fingerprint -> template and place). Two kinds of templates:

* Notices have a name in them (`{...}`), the words that tell a license and its version from its relatives. It has to be
  in the text word for word, side by side. Only the name's fingerprint with the least hash is in the index, as no match
  can be without it. From the name, the words before and after it are aligned to either side.
* Texts have no such name. All of their winnowed fingerprints are in the index: SHINGLE + PICK - 1 words in common, side
  by side, give a hit. Hits on near diagonals form a region, with whose words the template is aligned in a band.

The alignment has the best score: each template word found counts one, each one missing and each word of the text
between the first and the last match that isn't the template's costs one. A match has LEAST_COVERAGE of the template's
words, and foreign words inside it are at most the rest's share of them. Of matches that overlap, the one with the best
score stays (ties: the first, then the longer, then by name), so a text that differs from a known license in a few
words gets the nearest license, and a notice that names a license which isn't known gets none.

The index is made of the templates alone, so its size doesn't depend on the documents. Texts of any length are read
whole, once, and nothing is shuffled. Null and empty texts match nothing; repeated rows give repeated results; an empty
table gives none; other columns than id and text, whatever their names, aren't read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from quillstream.llm.common import trimmed

SHINGLE = 3
PICK = 2
BAND = 8
LEAST_COVERAGE = 0.8
SCHEMA = "doc_id long, license_id string, template string, start long, end long, template_words long, matched_words long, inserted_words long, coverage double"
WORD = re.compile(r"[a-z0-9]+")

_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE '
    "ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY "
    "OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_TWO = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution. "
)
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_REST = (
    ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, '
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH "
    "THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_MIT_GRANT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
)
_MIT_REST = (
    ' THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE '
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE "
    "SOFTWARE."
)
_BSD_ENDORSE = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
_BSD_ADVERTISE = "All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the organization. "
#: License texts.
TEXTS = {
    "MIT": _MIT_GRANT + ", subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software." + _MIT_REST,
    "MIT-0": _MIT_GRANT + "." + _MIT_REST,
    "ISC": _ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies." + _ISC_REST,
    "0BSD": _ISC_GRANT + "." + _ISC_REST,
    "BSD-2-Clause": _BSD_TWO + _DISCLAIMER,
    "BSD-3-Clause": _BSD_TWO + _BSD_ENDORSE + _DISCLAIMER,
    "BSD-4-Clause": _BSD_TWO + _BSD_ADVERTISE + _BSD_ENDORSE + _DISCLAIMER,
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means."
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
        "software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of this software must not be misrepresented; you must not claim "
        "that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. Altered source versions must be plainly marked as such, "
        "and must not be misrepresented as being the original software. This notice may not be removed or altered from any source distribution."
    ),
    "BSL-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, "
        "execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software "
        "and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, "
        "unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor." + _MIT_REST
    ),
    "X11": (
        _MIT_GRANT + ", subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
        + _MIT_REST.replace("AUTHORS OR COPYRIGHT HOLDERS", "X CONSORTIUM")
        + " Except as contained in this notice, the name of the X Consortium shall not be used in advertising or otherwise to promote the sale, use or other dealings in this Software without prior written authorization from the X Consortium."
    ),
    "BSD-1-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. " + _DISCLAIMER
    ),
    "BSD-3-Clause-Clear": _BSD_TWO.replace("are permitted provided that", "are permitted (subject to the limitations in the disclaimer below) provided that") + _BSD_ENDORSE + "NO EXPRESS OR IMPLIED LICENSES TO ANY PARTY'S PATENT RIGHTS ARE GRANTED BY THIS LICENSE. " + _DISCLAIMER,
    "PostgreSQL": (
        "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph "
        "and the following two paragraphs appear in all copies. IN NO EVENT SHALL THE PROVIDER BE LIABLE TO ANY PARTY FOR DIRECT, INDIRECT, SPECIAL, INCIDENTAL, OR CONSEQUENTIAL DAMAGES, INCLUDING LOST PROFITS, ARISING OUT OF THE USE OF "
        "THIS SOFTWARE AND ITS DOCUMENTATION, EVEN IF THE PROVIDER HAS BEEN ADVISED OF THE POSSIBILITY OF SUCH DAMAGE. THE PROVIDER SPECIFICALLY DISCLAIMS ANY WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE. THE SOFTWARE PROVIDED HEREUNDER IS ON AN \"AS IS\" BASIS, AND THE PROVIDER HAS NO OBLIGATIONS TO PROVIDE MAINTENANCE, SUPPORT, UPDATES, ENHANCEMENTS, OR MODIFICATIONS."
    ),
    "WTFPL": (
        "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed. DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE TERMS AND CONDITIONS FOR "
        "COPYING, DISTRIBUTION AND MODIFICATION 0. You just DO WHAT THE FUCK YOU WANT TO."
    ),
    "FSFAP": "Copying and distribution of this file, with or without modification, are permitted in any medium without royalty provided the copyright notice and this notice are preserved. This file is offered as-is, without any warranty.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. This work is published from the country of the author.",
    "NTP": (
        "Permission to use, copy, modify, and distribute this software and its documentation for any purpose with or without fee is hereby granted, provided that the above copyright notice appears in all copies and that both the "
        "copyright notice and this permission notice appear in supporting documentation, and that the name of the trademark holder not be used in advertising or publicity pertaining to distribution of the software without specific, "
        "written prior permission. The trademark holder makes no representations about the suitability this software for any purpose. It is provided \"as is\" without express or implied warranty."
    ),
}
#: Longer notices, with their names.
HEADERS = {
    "Apache-2.0": (
        'Licensed under the {Apache License, Version 2.0} (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless '
        'required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for '
        "the specific language governing permissions and limitations under the License."
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the {Mozilla Public License, v. 2.0}. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
}
#: Names of licenses and of their versions. GNU and Creative Commons names follow from the rules below.
NAMES = {
    "MIT": "MIT License", "MIT-0": "MIT No Attribution License", "ISC": "ISC License", "Zlib": "zlib License", "Unlicense": "The Unlicense", "PostgreSQL": "PostgreSQL License", "WTFPL": "Do What The Fuck You Want To Public License",
    "BSD-2-Clause": "BSD 2-Clause License|2-Clause BSD License|Simplified BSD License|FreeBSD License", "BSD-3-Clause": "BSD 3-Clause License|3-Clause BSD License|New BSD License|Modified BSD License",
    "BSD-4-Clause": "BSD 4-Clause License|4-Clause BSD License|Original BSD License", "0BSD": "BSD Zero Clause License", "CC0-1.0": "CC0 1.0|Creative Commons Zero 1.0|CC0 License",
}
VERSIONS = {
    "Apache": ("Apache License", "1.0 1.1 2.0"), "MPL": ("Mozilla Public License", "1.0 1.1 2.0"), "EPL": ("Eclipse Public License", "1.0 2.0"), "CDDL": ("Common Development and Distribution License", "1.0 1.1"),
    "BSL": ("Boost Software License", "1.0"), "Artistic": ("Artistic License", "1.0 2.0"), "EUPL": ("European Union Public Licence", "1.1 1.2"), "OFL": ("SIL Open Font License", "1.0 1.1"), "ODbL": ("Open Database License", "1.0"),
    "AFL": ("Academic Free License", "3.0"), "OSL": ("Open Software License", "3.0"), "MS-PL": ("Microsoft Public License", ""), "UPL": ("Universal Permissive License", "1.0"), "Python": ("Python Software Foundation License", "2.0"),
    "GPL": ("GNU General Public License", "1.0 2.0 3.0"), "LGPL": ("GNU Lesser General Public License", "2.1 3.0"), "AGPL": ("GNU Affero General Public License", "1.0 3.0"), "GFDL": ("GNU Free Documentation License", "1.1 1.2 1.3"),
}
CC_PARTS = {"BY": "Attribution", "NC": "NonCommercial", "ND": "NoDerivatives", "SA": "ShareAlike"}
CC_LICENSES = "BY BY-SA BY-ND BY-NC BY-NC-SA BY-NC-ND"
CC_VERSIONS = {"1.0": "Generic", "2.0": "Generic", "2.5": "Generic", "3.0": "Unported", "4.0": "International"}
#: What stands around a name.
PHRASES = ["Released under the {}", "Released under {}", "Licensed under the {}", "Licensed under {}", "This work is licensed under the {}", "This work is licensed under a {}", "This project is licensed under the {}", "Distributed under the terms of the {}", "Available under the {}"]
OR_LATER = " or (at your option) any later version"
GNU_HEADER = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the {%s} as published by the Free Software Foundation, either {version %s of the License%s. This program is distributed in the hope that it "
    "will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the %s for more details. You should have received a copy of the %s along with this program. If "
    "not, see <https://www.gnu.org/licenses/>."
)


def names() -> Iterator[tuple[str, str]]:
    """(license, name as it stands in notices)."""
    for k, listed in NAMES.items():
        for name in listed.split("|"):
            yield k, name
    for k, (name, listed) in VERSIONS.items():
        gnu = name.startswith("GNU")
        for v in listed.split() or [""]:
            forms = [f"{name} version {v}", f"{name} {v}", f"{name} v{v}", f"{name} v {v}", f"{k} {v}", f"{k}v{v}", f"{k} v{v}"] if v else [name, f"{k} License"]
            if v.endswith(".0"):
                forms += [f.removesuffix(".0") for f in forms]
            forms += [f"{k} {v} License"] if v else []
            for f in forms:
                yield f"{k}-{v}".rstrip("-"), f
                if gnu:
                    yield f"{k}-{v}-or-later", f + " or later"
                    yield f"{k}-{v}-or-later", f + OR_LATER
    for k in CC_LICENSES.split():
        parts = "-".join(CC_PARTS[x] for x in k.split("-"))
        for v, kind in CC_VERSIONS.items():
            for f in (f"CC {k} {v}", f"Creative Commons {k} {v}", f"Creative Commons {parts} {v}", f"Creative Commons {parts} {v} {kind}"):
                yield f"CC-{k}-{v}", f
                yield f"CC-{k}-{v}", f + " License"


def built_in() -> dict[tuple[str, str], str]:
    """(license, kind of template) -> template; a name in braces."""
    out = {(k, "text"): t for k, t in TEXTS.items()} | {(k, "header"): t for k, t in HEADERS.items()}
    ids = set()
    for k, name in names():
        ids.add(k)
        for i, phrase in enumerate(PHRASES):
            out[k, f"{name}, notice {i}"] = phrase.format("{" + name + "}")
    for k in ids:
        out[k, "identifier"] = "{SPDX-License-Identifier: " + k + "}"
    for k in ("GPL", "LGPL", "AGPL"):
        name, listed = VERSIONS[k]
        for v in listed.split():
            for suffix, later in (("", "}"), ("-or-later", OR_LATER + "}")):
                for form in {v, v.removesuffix(".0")}:
                    # the version tells these apart, so it belongs to the name: what stands between them has to be there as well
                    out[f"{k}-{v}{suffix}", f"header {form}"] = (GNU_HEADER % (name, form, later, name, name)).replace("} as published", " as published").replace("either {", "either ")
    return out


TEMPLATES = built_in()


@dataclass(frozen=True)
class Template:
    license_id: str
    kind: str
    words: tuple[str, ...]
    #: The name's place: words[a:b]; equal numbers: no name.
    a: int
    b: int

    @classmethod
    def of(cls, license_id: str, kind: str, text: str) -> Template:
        before, _, rest = text.lower().partition("{")
        name, _, after = rest.partition("}")
        parts = [WORD.findall(x) for x in (before, name, after)]
        return cls(license_id, kind, tuple(sum(parts, [])), len(parts[0]), len(parts[0]) + len(parts[1]))


class Index:
    """Inverted index of the templates' winnowed fingerprints."""

    def __init__(self, templates: dict[tuple[str, str], str], shingle: int = SHINGLE, pick: int = PICK) -> None:
        from xxhash import xxh64_intdigest

        self.templates = [Template.of(*k, t) for k, t in templates.items()]
        self.places: dict[tuple[str, ...], list[tuple[int, int]]] = defaultdict(list)
        for number, t in enumerate(self.templates):
            words = t.words[t.a : t.b] or t.words
            size = min(shingle, len(words))
            grams = [words[i : i + size] for i in range(len(words) - size + 1)] if size else []
            hashes = [xxh64_intdigest(" ".join(g), 1) for g in grams]
            n = len(grams) if t.b > t.a else min(pick, len(grams))
            for i in sorted({min(range(x, x + n), key=lambda y: (hashes[y], -y)) for x in range(len(grams) - n + 1)} if n else ()):
                self.places[grams[i]].append((number, i + (t.a if t.b > t.a else 0)))
        self.sizes = sorted({len(g) for g in self.places})

    def candidates(self, words: list[str]) -> Iterator[tuple[Template, int, int]]:
        """(template, first and last diagonal): template word i of an occurrence is near the text's word diagonal + i; exactly there if it is the name's."""
        hits: dict[int, list[int]] = defaultdict(list)
        places = self.places
        for size in self.sizes:
            for i, gram in enumerate(zip(*[words[k:] for k in range(size)])):
                if gram in places:
                    for number, at in places[gram]:
                        hits[number].append(i - at)
        for number, diagonals in hits.items():
            t = self.templates[number]
            if t.b > t.a:
                for d in diagonals:
                    if tuple(words[max(0, d + t.a) : d + t.b]) == t.words[t.a : t.b]:
                        yield t, d, d
                continue
            diagonals.sort()
            band = band_of(len(t.words))
            low = high = diagonals[0]
            for d in diagonals[1:]:
                if d - high > band:
                    yield t, low, high
                    low = d
                high = d
            yield t, low, high


def band_of(words: int) -> int:
    """Diagonals beside a hit's: a fifth of the template, BAND at least, but so few that the next occurrence isn't among them."""
    return min(max(BAND, words // 5), max(1, words // 2))


def align(template: tuple[str, ...], words: list[str], low: int, high: int, band: int) -> tuple[int, int, int]:
    """(equal words, first and last text word among them) of the best alignment with diagonals from low - band to high + band: three for each equal word, less the span's words."""
    # cell: (score + last word, equal words, first word, last word) of the best alignment of template words before i and text words up to j
    above: dict[int, tuple] = {}
    best: tuple = (0, 0, 0, 0, -1)
    for i, w in enumerate(template):
        row: dict[int, tuple] = {}
        left = None
        for j in range(max(0, low - band + i), min(len(words), high + band + i + 1)):
            cell = above.get(j)
            if left is not None and (cell is None or left > cell):
                cell = left
            if words[j] == w:
                was = above.get(j - 1)
                new = (was[0] + 3, was[1] + 1, was[2], j) if was is not None and was[0] + 3 - j > 2 else (2 + j, 1, j, j)
                if cell is None or new > cell:
                    cell = new
                if (new[0] - j, new[1], -j) > best[:3]:
                    best = (new[0] - j, new[1], -j, new[2], j)
            if cell is not None:
                row[j] = left = cell
        above = row
    return best[1], best[3], best[4]


def extend(template: tuple[str, ...], words: list[str]) -> tuple[int, int]:
    """(equal words, text words that they reach over) of the best alignment that starts at the first words: three for each equal word, less the words reached over."""
    above = [(-1, 0)] * (len(words) + 1)  # (score + last word used, equal words) with the words up to each one
    best = (0, 0, 0)
    for w in template:
        row = above[:1]
        for j, x in enumerate(words):
            cell = max(row[j], above[j + 1])
            if x == w:
                new = (above[j][0] + 3, above[j][1] + 1)
                cell = max(cell, new)
                best = max(best, (new[0] - j, new[1], -j))
            row.append(cell)
        above = row
    return best[1], 1 - best[2] if best[1] else 0


def matched(t: Template, words: list[str], low: int, high: int, least: float) -> tuple[int, int, int] | None:
    """(equal words, first and last text word) of a template near the diagonals, if it is there."""
    n = len(t.words)
    if t.b > t.a:
        spare = int((1 - least) * n + 1e-9)
        at = low + t.a
        before, back = extend(t.words[: t.a][::-1], words[max(0, at - t.a - spare) : at][::-1])
        after, on = extend(t.words[t.b :], words[low + t.b : low + n + spare])
        found = before + t.b - t.a + after, at - back, low + t.b + on - 1
    else:
        found = align(t.words, words, low, high, band_of(n))
    equal, first, last = found
    inserted = last - first + 1 - equal
    return found if equal >= least * n - 1e-9 and inserted <= (1 - least) * n + 1e-9 else None


def best_matches(found: list[tuple]) -> list[tuple]:
    """Of overlapping (license, template, first, last, template's words, equal words) those with the best score."""
    score = lambda f: 3 * f[5] - f[4] - (f[3] - f[2] + 1)
    taken: list[tuple] = []
    for f in sorted(set(found), key=lambda f: (-score(f), f[2], -f[3], f[0], f[1])):
        if all(f[3] < g[2] or g[3] < f[2] for g in taken):
            taken.append(f)
    return sorted(taken, key=lambda f: f[2])


def scan_text(text: str, index: Index, least: float = LEAST_COVERAGE) -> list[tuple]:
    """(license, template, start, end, template's words, equal words, inserted words, coverage) of each match, by its place."""
    lower = text.lower() if text.isascii() else "".join(c.lower() if c.isascii() else c for c in text)
    words = WORD.findall(lower)
    found = []
    for t, low, high in index.candidates(words):
        if (m := matched(t, words, low, high, least)) is not None:
            found.append((t.license_id, t.kind, m[1], m[2], len(t.words), m[0]))
    if not found:
        return []
    spans = [m.span() for m in WORD.finditer(lower)]
    return [(k, kind, spans[a][0], spans[b][1], n, m, b - a + 1 - m, m / n) for k, kind, a, b, n, m in best_matches(found)]


def scan(docs: DataFrame, templates: dict[tuple[str, str], str] | None = None, least: float = LEAST_COVERAGE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each license match in each text. templates: (license, kind) -> text, with a name in braces or without."""
    told = TEMPLATES if templates is None else templates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(told)
        types = [pa.int64(), pa.string(), pa.string(), *[pa.int64()] * 5, pa.float64()]
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = [(i, *f) for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True) for f in (scan_text(t, index, least) if t else ())]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    return docs.select(key, text).mapInArrow(trimmed(run), SCHEMA)
