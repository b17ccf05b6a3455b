"""Operator 10: licence notices and texts by Dice coefficient over word bigrams.

A unit of text (the whole text, or one of its lines) is normalised: lower
case, anything but letters and digits to spaces.  It is compared with every
template by Dice = 2 * common / (own + theirs) over distinct word bigrams.
Size bounds prune: a unit of n bigrams can reach the threshold t only with
templates of t / (2 - t) * n to (2 - t) / t * n bigrams, and a template
without a common bigram cannot reach it at all.

A notice in the middle of a paragraph, one wrapped over lines and a licence
body inside a longer file are no such unit.  So every window of a text that has
as many words as a template is compared with it, too, by the same coefficient;
counts of the window's bigrams are kept while it slides.  The size bound for
windows: with c bigrams in common anywhere in the text, no window goes beyond
2 * c / (c + theirs), so most templates are never slid.

Edge cases: NULL, empty and one-word units have no bigrams and match nothing; a
text shorter than a template is one window; equal coefficients go to the
template that comes first by name; repeated rows are scanned each; an empty
table gives an empty table.  The longest text is scanned whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

THRESHOLD = 0.7
#: Usual short notices of public licences.
TEMPLATES: Mapping[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Licensed under the BSD 2-Clause License.",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
    "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
    "USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. "
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission. "
)
_BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, '
    "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, "
    "EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_GNU = (
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU {0} as published by the Free Software "
    "Foundation, either version {1} of the License, or (at your option) any later version."
)
#: Usual headers and bodies (or the grants of long bodies) of public licences.
TEXTS: Mapping[str, tuple[str, ...]] = {
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may '
        "obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or '
        "implied. See the License for the specific language governing permissions and limitations under the License.",
        "2. Grant of Copyright License. Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, "
        "worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, "
        "publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form.",
    ),
    "BSD-2-Clause": (_BSD_CONDITIONS + _BSD_WARRANTY,),
    "BSD-3-Clause": (_BSD_CONDITIONS + _BSD_NAMES + _BSD_WARRANTY,),
    "GPL-2.0": (_GNU.format("General Public License", 2),),
    "GPL-3.0": (_GNU.format("General Public License", 3),),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies.",
    ),
    "LGPL-2.1": (_GNU.format("Lesser General Public License", 2.1),),
    "LGPL-3.0": (_GNU.format("Lesser General Public License", 3),),
    "MIT": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the '
        '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software.",
        _WARRANTY,
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
        "You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
}
_NOT_WORD = re.compile(r"[\W_]+")


def words_of(text: str) -> list[str]:
    return _NOT_WORD.sub(" ", text.lower()).split()


def bigrams(text: str) -> set[tuple[str, str]]:
    words = words_of(text)
    return set(zip(words, words[1:], strict=False))


def best_window(grams: list[tuple[str, str]], width: int, theirs: set[tuple[str, str]]) -> float:
    """Greatest Dice of ``theirs`` and the distinct bigrams of any ``width`` neighbouring ones (all, if fewer)."""
    width = min(width, len(grams))
    counts: Counter[tuple[str, str]] = Counter()
    own = common = 0
    best = 0.0
    for i, g in enumerate(grams):
        counts[g] += 1
        if counts[g] == 1:
            own += 1
            common += g in theirs
        if i >= width:
            old = grams[i - width]
            counts[old] -= 1
            if not counts[old]:
                del counts[old]
                own -= 1
                common -= old in theirs
        if i >= width - 1:
            best = max(best, 2 * common / (own + len(theirs)))
    return best


class Windows:
    """Templates that slide over a text: every window of as many words is compared."""

    def __init__(self, templates: Mapping[str, Sequence[str]], threshold: float = THRESHOLD):
        self.threshold = threshold
        words = [(name, words_of(t)) for name, texts in sorted(templates.items()) for t in texts]
        self.parts = [(name, len(w) - 1, set(zip(w, w[1:], strict=False))) for name, w in words if len(w) > 1]
        self.index: dict[tuple[str, str], list[int]] = {}
        for k, (_, _, grams) in enumerate(self.parts):
            for g in grams:
                self.index.setdefault(g, []).append(k)

    def best(self, text: str) -> tuple[str, float] | None:
        """The template of greatest Dice with a window, from the threshold on."""
        words = words_of(text)
        grams = list(zip(words, words[1:], strict=False))
        common = Counter(k for g in self.index.keys() & set(grams) for k in self.index[g])
        found = None
        for k, c in sorted(common.items()):
            name, width, theirs = self.parts[k]
            bound = 2 * c / (c + len(theirs))
            if bound < self.threshold or found is not None and bound < found[1]:
                continue
            dice = best_window(grams, width, theirs)
            if dice >= self.threshold and (found is None or dice > found[1]):
                found = name, dice
        return found


class Matcher:
    """Templates with an index from bigram to template."""

    def __init__(self, templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD):
        self.sets = {name: bigrams(t) for name, t in sorted(templates.items())}
        self.threshold = threshold
        self.index: dict[tuple[str, str], list[str]] = {}
        for name, grams in self.sets.items():
            for g in grams:
                self.index.setdefault(g, []).append(name)
        sizes = [len(g) for g in self.sets.values()]
        self.least = threshold / (2 - threshold) * min(sizes, default=1)
        self.most = (2 - threshold) / threshold * max(sizes, default=0)

    def best(self, unit: str) -> tuple[str, float] | None:
        """The template of greatest Dice from the threshold on."""
        grams = bigrams(unit)
        n = len(grams)
        if not self.least <= n <= self.most:
            return None
        common = Counter(name for g in grams for name in self.index.get(g, ()))
        found = None
        for name in sorted(common):
            size = len(self.sets[name])
            if self.threshold / (2 - self.threshold) * size <= n <= (2 - self.threshold) / self.threshold * size:
                dice = 2 * common[name] / (n + size)
                if dice >= self.threshold and (found is None or dice > found[1]):
                    found = name, dice
        return found

    def scan(self, text: str) -> tuple[str | None, float, int]:
        """Best licence of a text, its coefficient, and how many lines match a template."""
        lines = text.split("\n")
        hits = [h for h in map(self.best, lines) if h]
        matched = len(hits)
        if len(lines) > 1 and (whole := self.best(text)):
            hits.append(whole)
        if not hits:
            return None, 0.0, 0
        name, dice = min(hits, key=lambda h: (-h[1], h[0]))
        return name, dice, matched


def scan_licenses(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
    texts: Mapping[str, Sequence[str]] = TEXTS,
) -> DataFrame:
    """One row per input row: the id column, ``license``, ``dice`` (the greatest of all units and windows) and
    ``n_license_lines`` (lines that match a short notice on their own)."""
    fixed = dict(templates)
    sliding = {name: [*([fixed[name]] if name in fixed else []), *texts.get(name, ())] for name in {*fixed, *texts}}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, windows = Matcher(fixed, threshold), Windows(sliding, threshold)

        def scan(text: str) -> tuple[str | None, float, int]:
            name, dice, lines = matcher.scan(text)
            # no window goes beyond 1, and of equal ones the first name counts
            inside = windows.best(text)
            if inside and (-inside[1], inside[0]) < (-dice, name or ""):
                name, dice = inside
            return name, dice, lines

        for batch in batches:
            found = [scan(t.as_py() or "") for t in batch.column("text")]
            name, dice, lines = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(name, pa.string()), pa.array(dice, pa.float64()), pa.array(lines, pa.int64())], names=["key", "license", "dice", "n_license_lines"])

    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(docs[id_col].alias("key"), docs[text_col].alias("text"))
    return src.mapInArrow(run, f"key {kind}, license string, dice double, n_license_lines bigint").withColumnRenamed("key", id_col)
