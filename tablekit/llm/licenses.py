"""Licence scan: lines, whole texts and stretches of words compared with licence templates by word bigrams.

Text is normalised to lower-case words of letters and digits. A unit is the set of its word
bigrams. It matches a template if the Dice coefficient 2 |A n B| / (|A| + |B|) of the two sets
is at least ``least``. Units are each line, the whole text if it has several lines, and, so that
a licence above code or a notice within a line is found, stretches of the whole text: as many
words as the template, from each place that holds one of its bigrams.

The Dice coefficient bounds the sizes: |A| lies between least / (2 - least) |B| and (2 - least) /
least |B|, and templates outside these bounds are not compared. In a stretch at least least / (2 -
least) |B| places hold bigrams of the template; places that are not followed by so many are
passed over. Everything is column expressions over the row itself: no Python, no shuffle.

* Null and empty texts, and units of fewer than two words, have no bigrams and no match.
* A template is listed once, with its best unit: of equal scores a stretch, then the whole text,
  then lines in order; of stretches the first. Of equal templates the first in order of name is the best.
* Repeated rows give a row each. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST = 0.7

_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
    "IN THE SOFTWARE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution. "
)
_BSD_NAME = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission. "
)
_BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE "
    "LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
    "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
    "DAMAGE."
)
_GPL = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
    "the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it "
    "will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General "
    "Public License for more details."
)
#: Licence texts and the notices that name them.
TEMPLATES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
    '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, '
    "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _WARRANTY,
    "mit-notice": "Released under the MIT License.",
    "bsd-2-clause": _BSD + _BSD_WARRANTY,
    "bsd-3-clause": _BSD + _BSD_NAME + _BSD_WARRANTY,
    "bsd-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
    'copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD '
    "TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE "
    "OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may '
    "obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
    'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the '
    "License for the specific language governing permissions and limitations under the License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0": _GPL,
    "lgpl-3.0": _GPL.replace("GNU General", "GNU Lesser General"),
    "agpl-3.0": _GPL.replace("GNU General", "GNU Affero General"),
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
    "You can obtain one at http://mozilla.org/MPL/2.0/.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
    "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}


def pairs(text: str) -> list[str]:
    """The word bigrams of a template, place by place."""
    words = [w for w in re.split(r"[^a-z0-9]+", text.lower()) if w]
    return [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def bigrams(text: str) -> list[str]:
    """The distinct word bigrams of a template, in order."""
    return list(dict.fromkeys(pairs(text)))


def _template_rows(templates: dict[str, str], least: float) -> Column:
    """Literal rows (name, size bounds, bigrams), one for each template."""
    rows = []
    for name in sorted(templates):
        grams = bigrams(templates[name])
        rows.append(
            F.struct(
                F.lit(name).alias("name"),
                F.lit(least / (2 - least) * len(grams)).alias("low"),
                F.lit((2 - least) / least * len(grams)).alias("high"),
                F.array(*map(F.lit, grams)).alias("grams"),
            )
        )
    return F.array(*rows)


def unit_bigrams(words: Column) -> Column:
    n = F.size(words) - 1
    return F.array_distinct(F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat_ws(" ", a, b)))


def _stretches(templates: dict[str, str], least: float) -> Column:
    """(dice, license, start) of stretches of ``_pairs`` that may match; ``_hits`` are the places of bigrams of any template."""

    def places_of(grams: list[str]) -> Column:
        return F.filter("_hits", lambda i: F.get("_pairs", i).isin(*grams))

    found = []
    for name in sorted(templates):
        grams = bigrams(templates[name])
        need = math.ceil(least / (2 - least) * len(grams) - 1e-9)
        found.append(F.struct(F.lit(name).alias("license"), F.lit(len(pairs(templates[name]))).alias("length"), F.lit(need).alias("need"), F.array(*map(F.lit, grams)).alias("grams"), places_of(grams).alias("places")))

    def compared(t: Column) -> Column:
        places = F.filter(t["places"], lambda p, k: F.coalesce(F.get(t["places"], k + t["need"] - 1) < p + t["length"], F.lit(False)))

        def dice(p: Column) -> Column:
            own = F.array_distinct(F.slice("_pairs", p + 1, t["length"]))
            return F.lit(2.0) * F.size(F.array_intersect(own, t["grams"])) / (F.size(own) + F.size(t["grams"]))

        return F.transform(places, lambda p: F.struct(dice(p).alias("dice"), t["license"].alias("license"), F.lit(-2).alias("unit"), p.alias("start")))

    return F.flatten(F.transform(F.array(*found), compared))


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, least: float = LEAST, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id and ``matches`` (unit, start, license, dice), best first.

    ``unit`` is the line, -1 for the whole text, -2 for a stretch; that has its first word in ``start``.
    """
    table = _template_rows(templates, least)
    fewest = min(len(bigrams(t)) for t in templates.values()) * least / (2 - least)
    lines = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), "\n")

    def words(u: Column) -> Column:
        return F.split(F.trim(F.regexp_replace(u, r"[^\p{L}\p{N}]+", " ")), " ")

    numbered = F.transform("_lines", lambda u, i: F.struct(i.alias("unit"), words(u).alias("words")))
    # a set has no more bigrams than its unit has pairs of neighbours
    long_enough = F.filter(numbered, lambda u: F.size(u["words"]) - 1 >= F.lit(max(1.0, fewest)))
    line_sets = F.transform(long_enough, lambda u: F.struct(u["unit"].alias("unit"), unit_bigrams(u["words"]).alias("grams")))
    n = F.size("_words") - 1
    neighbours = F.zip_with(F.slice("_words", 1, n), F.slice("_words", 2, n), lambda a, b: F.concat_ws(" ", a, b))
    whole_set = F.when((F.size("_lines") > 1) & (F.size("_pairs") > 0), F.array(F.struct(F.lit(-1).alias("unit"), F.array_distinct("_pairs").alias("grams"))))
    vocabulary = sorted({g for t in templates.values() for g in bigrams(t)})
    hits = F.filter(F.transform("_pairs", lambda pair, i: F.when(pair.isin(*vocabulary), i)), lambda i: i.isNotNull())

    def compared(u: Column) -> Column:
        size = F.size(u["grams"])
        fitting = F.filter(F.col("_templates"), lambda t: (size >= t["low"]) & (size <= t["high"]))
        return F.transform(
            fitting,
            lambda t: F.struct(
                (F.lit(2.0) * F.size(F.array_intersect(u["grams"], t["grams"])) / (size + F.size(t["grams"]))).alias("dice"),
                t["name"].alias("license"), u["unit"].alias("unit"), F.lit(None).cast("int").alias("start"),
            ),
        )

    units = F.concat("_line_sets", F.coalesce(whole_set, F.array().cast(_UNITS)))
    found = F.filter(F.concat(F.flatten(F.transform(units, compared)), _stretches(templates, least)), lambda m: m["dice"] >= F.lit(least))
    ordered = F.array_sort(F.transform(found, lambda m: F.struct((-m["dice"]).alias("order"), m["license"].alias("license"), m["unit"].alias("unit"), m["start"].alias("start"))))
    best = F.filter("_ordered", lambda m, i: ~F.exists(F.slice("_ordered", 1, i), lambda earlier: earlier["license"] == m["license"]))
    return (
        docs.select(F.col(doc_id), lines.alias("_lines"))
        .select(doc_id, "_lines", words(F.array_join("_lines", " ")).alias("_words"))
        .select(doc_id, "_lines", F.when(n > 0, neighbours).otherwise(F.array().cast("array<string>")).alias("_pairs"))
        .select(doc_id, "_lines", "_pairs", line_sets.alias("_line_sets"), hits.alias("_hits"), table.alias("_templates"))
        .select(doc_id, ordered.alias("_ordered"))
        .select(doc_id, F.transform(best, lambda m: F.struct(m["unit"].alias("unit"), m["start"].alias("start"), m["license"].alias("license"), (-m["order"]).alias("dice"))).alias("matches"))
    )


_UNITS = "array<struct<unit:int,grams:array<string>>>"
