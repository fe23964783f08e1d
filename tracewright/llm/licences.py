"""Licence scan: parts of a text against licence templates by the Dice coefficient over word bigrams.

Compared are the whole text, its paragraphs, lines and sentences, and every run of its words, so a licence of several
paragraphs, shortened or not, is found in the middle of a longer text. Size bounds prune: a part can only reach the
threshold with templates of a similar number of bigrams, and a text only with those whose bigrams it shares enough of.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import small_batches

THRESHOLD = 0.8

_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions
and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_NAMES = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
_BSD_AS_IS = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN
NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS;
OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF
SUCH DAMAGE."""

#: Fixed values: (licence, template) with the wording of the public licences and of the usual notices.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use,
copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be
included in all copies or substantial portions of the Software. """ + _AS_IS),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE
AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO
EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING
FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN
CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("BSD-2-Clause", f"{_BSD} {_BSD_AS_IS}"),
    ("BSD-3-Clause", f"{_BSD} {_BSD_NAMES} {_BSD_AS_IS}"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or
agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF
ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the
License."""),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This
program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public
License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This
program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("Unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
non-commercial, and by any means."""),
)

#: Full texts of the longer licences, one file each, named by the licence; texts of public licences are fixed values.
TEXTS = Path(__file__).parent / "licence_texts"


@cache
def templates_of(folder: str | None = str(TEXTS)) -> tuple[tuple[str, str], ...]:
    """TEMPLATES and, of each file of a folder (on the driver), its licence and text."""
    files = sorted(Path(folder).glob("*.txt")) if folder else []
    return TEMPLATES + tuple((f.stem, f.read_text(encoding="utf-8")) for f in files)


_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"(?<=[.!?;])\s+|\n+")
_PARAGRAPH = re.compile(r"\n\s*\n")


def words(text: str) -> list[str]:
    """Normalised text: its lower-cased words, without punctuation, white space and underscores."""
    return _WORD.findall(text.lower().replace("_", " "))


def bigrams(of: list[str]) -> set[tuple[str, str]]:
    return set(zip(of, of[1:], strict=False))


def parts(text: str) -> Iterator[str]:
    """What is compared: the whole text, its paragraphs, its lines and its sentences."""
    yield text
    for cut in (_PARAGRAPH.split(text), text.split("\n"), _SENTENCE.split(text)):
        if len(cut) > 1:
            yield from cut


class Scanner:
    def __init__(self, templates: tuple[tuple[str, str], ...], threshold: float = THRESHOLD):
        self.threshold = threshold
        made = sorted(((len(g), name, g) for name, t in templates if (g := bigrams(words(t)))), key=lambda x: (x[0], x[1]))
        self.sizes, self.names, self.grams = ([x[i] for x in made] for i in range(3))
        self.holders: dict[tuple[str, str], list[int]] = {}
        for i, grams in enumerate(self.grams):
            for gram in grams:
                self.holders.setdefault(gram, []).append(i)
        # dice = 2 shared / (n + m) with n >= shared, so of the m bigrams of a template at least so many are shared
        self.least = [m * threshold / (2 - threshold) - 1e-9 for m in self.sizes]

    def _shared(self, grams: set[tuple[str, str]]) -> dict[int, int]:
        """Templates that a text of these bigrams can hold, with the number of bigrams they share."""
        counts = Counter(i for g in grams & self.holders.keys() for i in self.holders[g])
        return {i: n for i, n in counts.items() if n >= self.least[i]}

    def _windows(self, grams: list[tuple[str, str]], possible: Iterable[int]) -> Iterator[tuple[int, float]]:
        """Of each of these templates the largest coefficient over all runs of words.

        The best run begins with a shared bigram that it has nowhere else (else it could begin later), and has at most
        m (2 - t) / t distinct ones. So for each shared bigram the runs that begin with it and end before it comes again are
        looked at, all ends at once: a bigram counts at its first place within the run.
        """
        numbers: dict[tuple[str, str], int] = {}
        ids = np.fromiter((numbers.setdefault(g, len(numbers)) for g in grams), np.int64, len(grams))
        order = np.argsort(ids, kind="stable")
        before, after = np.full(len(ids), -1), np.full(len(ids), len(ids))
        same = ids[order[1:]] == ids[order[:-1]]
        before[order[1:][same]], after[order[:-1][same]] = order[:-1][same], order[1:][same]
        for i in possible:
            wanted = np.zeros(len(numbers), bool)
            wanted[[numbers[g] for g in self.grams[i] if g in numbers]] = True
            shared, m, best = wanted[ids], self.sizes[i], 0.0
            most = int(m * (2 - self.threshold) / self.threshold + 1e-9)
            for at in np.flatnonzero(shared).tolist():
                span, last = 2 * most, int(after[at])
                while True:
                    first = before[at : min(at + span, last)] < at
                    n = np.cumsum(first)
                    if n[-1] > most or at + span >= last:
                        break
                    span *= 2
                end = int(np.searchsorted(n, most, "right"))
                both = np.cumsum(first[:end] & shared[at : at + end])
                if both[-1] >= self.least[i]:
                    best = max(best, float((2 * both / (n[:end] + m)).max()))
            yield i, best

    def scan(self, text: str | None) -> dict[str, float]:
        """Licences whose Dice coefficient with some part of the text reaches the threshold, and the largest."""
        found: dict[str, float] = {}
        seen = words(text or "")
        grams = list(zip(seen, seen[1:], strict=False))
        possible = self._shared(set(grams))
        if not possible:
            return found

        def keep(i: int, dice: float) -> None:
            if dice >= self.threshold and dice > found.get(self.names[i], 0):
                found[self.names[i]] = dice

        for i, dice in self._windows(grams, possible):
            keep(i, dice)
        t = self.threshold
        for part in parts(text):
            own = bigrams(words(part))
            n = len(own)
            # dice <= 2 min(n, m) / (n + m), so only templates of such sizes m can reach the threshold
            lo, hi = bisect_left(self.sizes, n * t / (2 - t) - 1e-9), bisect_right(self.sizes, n * (2 - t) / t + 1e-9)
            if any(lo <= i < hi for i in possible):
                for i, both in self._shared(own).items():
                    if lo <= i < hi:
                        keep(i, 2 * both / (n + self.sizes[i]))
        return found


def licences_of(spark, text: str = "text", templates: tuple[tuple[str, str], ...] | None = None, threshold: float = THRESHOLD) -> Column:
    """array<struct<licence, dice>> of a text column, the largest coefficient first, ties by name; empty if none.

    templates: (licence, text) pairs, templates_of() where none are given. Null and empty texts hold none; equal
    texts get equal results.
    """
    templates = templates_of() if templates is None else templates

    @F.pandas_udf("array<struct<licence: string, dice: double>>")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(templates, threshold)
        for batch in batches:
            found = [scanner.scan(t if isinstance(t, str) else None) for t in batch]
            yield pd.Series([[{"licence": k, "dice": v} for k, v in sorted(x.items(), key=lambda y: (-y[1], y[0]))] for x in found])

    small_batches(spark)
    return scan.asNondeterministic()(F.col(text))


def scan_documents(docs: DataFrame, templates: tuple[tuple[str, str], ...] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, licence, dice, n_licences, licences of every row of docs.

    licence and dice are the best match over the whole text, its paragraphs, lines and sentences and all runs of its words,
    of any length; null and 0 where no template reaches the threshold, as for null and empty texts. Repeated rows are scanned alike; an empty
    table gives no rows; other columns are ignored.
    """
    found = docs.select("doc_id", licences_of(docs.sparkSession, "text", templates, threshold).alias("licences"))
    best = F.get("licences", F.lit(0))
    return found.select("doc_id", best["licence"].alias("licence"), F.coalesce(best["dice"], F.lit(0.0)).alias("dice"), F.size("licences").alias("n_licences"), "licences")
