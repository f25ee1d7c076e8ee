"""Licence scans: normalised text against licence templates by the Dice coefficient over word bigrams.

dice = 2 |A and B| / (|A| + |B|) of the sets of word bigrams of a passage and a
template.  For dice >= t a passage must share at least t / (2 - t) |B| bigrams
with the template and can have between that many and (2 - t) / t |B| of its
own; these bounds drop most templates before anything is compared.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import OrderedDict
from collections.abc import Mapping
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import functions as F, types as T
from pyspark.sql.functions import pandas_udf

from .shared import ship_package

#: Least Dice coefficient of a finding.
THRESHOLD = 0.8
_WORD = re.compile(r"[^\W_]+")

_WARRANTY_MIT = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
    "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
    "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_BSD_TWO = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. ")
_BSD_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT "
    "HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
    "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
    "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_GNU = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} as published by the Free Software "
        "Foundation, either version {1} of the License, or (at your option) any later version. This program is distributed in the hope that it will be "
        "useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} "
        "for more details. You should have received a copy of the GNU {0} along with this program. If not, see https://www.gnu.org/licenses/.")

#: The texts of well-known licences, their notices, and short statements that refer to them.
TEMPLATES: dict[str, list[str]] = {
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions: " + _WARRANTY_MIT,
        "Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the terms of the MIT license."],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may "
        "obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or "
        "implied. See the License for the specific language governing permissions and limitations under the License.",
        "Licensed under the Apache License, Version 2.0.", "Released under the Apache License, Version 2.0."],
    "BSD-2-Clause": [_BSD_TWO + _BSD_WARRANTY, "Licensed under the BSD 2-Clause License."],
    "BSD-3-Clause": [_BSD_TWO + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
                     "derived from this software without specific prior written permission. " + _BSD_WARRANTY, "Licensed under the BSD 3-Clause License."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
            "above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL "
            "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.", "Licensed under the ISC License."],
    "GPL-2.0": [_GNU.format("General Public License", "2"), "This work is licensed under the GNU General Public License, version 2."],
    "GPL-3.0": [_GNU.format("General Public License", "3"), "This work is licensed under the GNU General Public License, version 3."],
    "LGPL-2.1": [_GNU.format("Lesser General Public License", "2.1"), "This work is licensed under the GNU Lesser General Public License, version 2.1."],
    "LGPL-3.0": [_GNU.format("Lesser General Public License", "3"), "This work is licensed under the GNU Lesser General Public License, version 3."],
    "AGPL-3.0": [_GNU.format("Affero General Public License", "3"), "This work is licensed under the GNU Affero General Public License, version 3."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
                "file, You can obtain one at http://mozilla.org/MPL/2.0/.", "Licensed under the Mozilla Public License, Version 2.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
                  "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
                "Released under CC0 1.0 Universal."],
    **{f"CC-{x}-4.0": [f"This work is licensed under a Creative Commons {n} 4.0 International License.", f"Licensed under CC {x} 4.0."]
       for x, n in {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
                    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}.items()},
}


def normalised_words(text: str) -> list[str]:
    """Lower-case words; case, punctuation and white space do not count."""
    return _WORD.findall(text.lower())


@dataclass
class Scanner:
    """Finds passages that are like a template; built once a worker from the templates' texts."""
    templates: Mapping[str, list[str]]
    threshold: float = THRESHOLD
    _ready: tuple | None = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return {**self.__dict__, "_ready": None}

    def _index(self) -> tuple:
        if self._ready is None:
            grams, of_gram, firsts = [], {}, set()
            for name, texts in self.templates.items():
                for text in texts:
                    words = normalised_words(text)
                    own = set(zip(words, words[1:]))
                    if own:
                        firsts.update(a for a, _ in own)
                        for g in own:
                            of_gram.setdefault(g, []).append(len(grams))
                        grams.append((name, len(own)))
            self._ready = grams, of_gram, firsts
        return self._ready

    def scan(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(licence, dice, first word, last word + 1) of the passages found, in text order, none overlapping another.

        For every template that enough different bigrams of the text belong
        to, passages between two of its bigrams are measured within the size
        bounds; of overlapping passages the one most alike is kept, of equally
        alike ones the longest.
        """
        grams, of_gram, firsts = self._index()
        words = normalised_words(text or "")
        hits: dict[int, list[int]] = {}
        for i in [i for i, w in enumerate(words[:-1]) if w in firsts]:
            for k in of_gram.get((words[i], words[i + 1]), ()):
                hits.setdefault(k, []).append(i)
        t = self.threshold
        found = []
        for k, places in hits.items():
            name, size = grams[k]
            least, most = t / (2 - t) * size, (2 - t) / t * size
            if len(places) >= least and len({(words[i], words[i + 1]) for i in places}) >= least:
                found += [(-d, a - b, a, b, name) for d, a, b in self._passages(words, places, size, least, most)]
        out: list[tuple] = []  # disjoint, by first word
        for d, _, a, b, name in sorted(found):
            at = bisect_left(out, a, key=lambda x: x[2])
            if (at == 0 or out[at - 1][3] <= a) and (at == len(out) or out[at][2] >= b):
                out.insert(at, (name, round(-d, 6), a, b))
        return out

    def _passages(self, words: list[str], places: list[int], size: int, least: float, most: float) -> list[tuple[float, int, int]]:
        """Passages of one template: for each start the best end within the size bounds; the caller chooses among overlaps.

        Bounds count different bigrams, so a passage may be of any length: from
        the last place back to the first, `ahead` keeps the next place of each
        of the `most` bigrams that come first from there on, the nearest last.
        """
        out: list[tuple[float, int, int]] = []
        own = {(words[i], words[i + 1]) for i in places}
        ahead: OrderedDict = OrderedDict()
        for start in range(places[-1], places[0] - 1, -1):
            gram = (words[start], words[start + 1])
            ahead[gram] = start
            ahead.move_to_end(gram)
            if len(ahead) > most:
                ahead.popitem(last=False)
            if gram not in own:
                continue
            best, shared = (0.0, 0, 0), 0
            for inside, (g, i) in enumerate(reversed(ahead.items()), 1):
                if g in own:
                    shared += 1
                    dice = 2 * shared / (inside + size)
                    if shared >= least and dice > best[0]:
                        best = (dice, start, i + 2)
            if best[0] >= self.threshold:
                out.append(best)
        return out


RESULT = T.ArrayType(T.StructType([T.StructField("license", T.StringType()), T.StructField("dice", T.DoubleType()),
                                   T.StructField("first_word", T.IntegerType()), T.StructField("end_word", T.IntegerType())]))


def licenses(templates: Mapping[str, list[str]] | None = None, threshold: float = THRESHOLD):
    """A column function: text -> array of struct(license, dice, first_word, end_word).

    Whole texts; null, empty and unlike texts give an empty array; equal texts
    equal findings.
    """
    scanner = Scanner(templates or TEMPLATES, threshold)
    ship_package()

    @pandas_udf(RESULT)
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(("license", "dice", "first_word", "end_word"), x)) for x in scanner.scan(t)] for t in texts], dtype=object)
    return run


def scan_documents(docs, id_col: str = "doc_id", text_col: str = "text", **settings):
    """(id, n_licenses, license, dice, findings) per row: the licence most alike (null without any) and all passages.

    Repeated rows come back as often; other columns are ignored.
    """
    found = docs.select(F.col(id_col), licenses(**settings)(F.col(text_col)).alias("findings"))
    best = F.element_at(F.array_sort(F.transform("findings", lambda f: F.struct((-f["dice"]).alias("d"), f["license"].alias("l")))), 1)
    some = F.size("findings") > 0
    return found.select(id_col, F.size("findings").cast("long").alias("n_licenses"), F.when(some, best["l"]).alias("license"),
                        F.when(some, -best["d"]).alias("dice"), "findings")
