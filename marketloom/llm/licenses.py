"""License scans: MinHash bands over overlapping text windows, then exact containment, in DataFrame operations only.

A template's shingles are its runs of ``SHINGLE`` words. For every template length L the text is cut into windows of W = L + stride - 1
words, ``stride`` apart, so that each stretch of L words lies whole in some window; a window that holds the template then has a
similarity to it of at least s = (L - SHINGLE + 1) / (W - SHINGLE + 1). Each of ``BANDS`` bands is one MinHash value, and the stride is chosen
so that s is at least ``LEAST_SIMILARITY``. A window that holds only the share ``CONTAINMENT`` of the template's shingles has a similarity of at
least 0.8 s / (1 + 0.2 s), 0.33 here, and shares a band with a probability of at least 1 - (1 - 0.33)^BANDS, above 0.99999. What a band
retrieves is verified exactly: the share of the template's shingles found in the window.

Before windows of a length are cut, two tests that no match fails: a text must hold a word of the ``marker`` of a template of this length (words chosen such
that without any of them more shingles would be missing than the containment allows), and then, by codes, as many of the template's shingles
anywhere as a window needs. The templates are parameters; up to ``BROADCAST_CHARS`` characters of them are joined by broadcast, more by
a shuffle.

Words are runs of letters and digits, lower-cased; nulls and texts without words match nothing. Rows that repeat a doc_id are scanned
each by its own text, and equal rows give equal results. A template of fewer words than a shingle is refused.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHINGLE = 2
BANDS = 32
LEAST_SIMILARITY = 0.45
BROADCAST_CHARS = 1 << 20
CONTAINMENT = 0.8

# fixed values: the notices that the scan looks for, one-line ones first, then the headers and bodies that licensed files carry
TEMPLATES = {
    "mit": "Released under the MIT License.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "all-rights-reserved": "All rights reserved.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to "
    "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom "
    "the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission "
    "notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT "
    "WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
    "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES "
    "OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
    "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
    "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
    "required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, "
    "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
    "permissions and limitations under the License.",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
    "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
    "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You "
    "should have received a copy of the GNU General Public License along with this program. If not, see "
    "http://www.gnu.org/licenses/",
    "lgpl-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
    "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
    "any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
    "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more "
    "details. You should have received a copy of the GNU Lesser General Public License along with this library",
    "mpl-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
    "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "bsd-3-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this "
    "list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND "
    "CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS "
    "BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON "
    "ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY "
    "WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "isc-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "
    "AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
    "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE "
    "OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
}
WORD = r"[a-z0-9\x{80}-\x{10FFFF}]+"


def template_words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", "".join(c.lower() if c < "\x80" else c for c in text))


def _shingles(words: list[str]) -> list[str]:
    return list(dict.fromkeys(" ".join(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)))


def marker(words: list[str], containment: float = CONTAINMENT) -> list[str]:
    """Words, longest first, that touch more shingles than may be missing."""
    shingles, out = _shingles(words), []
    allowed = len(shingles) - -(-len(shingles) * containment // 1)
    for word in sorted(dict.fromkeys(words), key=lambda w: (-len(w), w)):
        out.append(word)
        if sum(any(w in s.split() for w in out) for s in shingles) > allowed:
            return out
    return out


def geometry(length: int) -> tuple[int, int]:
    """(window, stride) in words for templates of ``length`` words."""
    shingles = length - SHINGLE + 1
    stride = max(1, int(shingles / LEAST_SIMILARITY) - shingles + 1)
    return length + stride - 1, stride


def _lowered(text: str) -> Column:
    return F.translate(F.col(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _pairs(words: Column, join: Callable[[Column, Column], Column]) -> Column:
    """``join`` of each word and the next one."""
    rest = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, 1, rest), F.slice(words, 2, rest), join)


def shingles(words: Column) -> Column:
    return F.array_distinct(_pairs(words, lambda a, b: F.concat_ws(" ", a, b)))


def bands(words: Column, n: int = BANDS) -> Column:
    """The MinHash value of each band: the smallest seeded code of the shingles of an array of words."""

    def value(codes: Column, band: int) -> Column:
        return F.array_min(F.transform(codes, lambda c: F.xxhash64(c, F.lit(band))))

    return F.transform(F.array(_pairs(words, lambda a, b: F.xxhash64(a, b))), lambda codes: F.array(*[value(codes, i) for i in range(n)]))[0]


def codes(words: Column) -> Column:
    """A code of every shingle of an array of words, in order."""
    return _pairs(words, lambda a, b: F.xxhash64(a, b))


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """(doc_id, code of the text, license, first_word, containment) of every window that holds enough of a template."""
    spark = docs.sparkSession
    split = {name: template_words(text) for name, text in templates.items()}
    if not all(len(w) >= SHINGLE for w in split.values()):
        raise ValueError(f"a template has at least {SHINGLE} words")
    lowered = _lowered("text")
    lengths = sorted({len(w) for w in split.values()})

    def possible(length: int) -> Column:
        marks = sorted({m for w in split.values() if len(w) == length for m in marker(w, containment)})
        return reduce(or_, [F.contains(F.col("lowered"), F.lit(m)) for m in marks])

    listed = spark.createDataFrame(list(split.items()), "license string, words array<string>")
    coded = {r["license"]: r["codes"] for r in listed.select("license", F.array_distinct(codes(F.col("words"))).alias("codes")).collect()}

    def enough(length: int) -> Column:
        """Whether ``held``, the text's codes that any template has, can fill a window for a template of this length."""
        own = [c for name, c in coded.items() if len(split[name]) == length]
        need = lambda c: -(-len(c) * round(1000 * containment) // 1000)
        return reduce(or_, [F.size(F.array_intersect("held", F.array(*[F.lit(v) for v in c]))) >= need(c) for c in own])

    def cut(length: int, test: Column) -> Column:
        window, stride = geometry(length)
        return F.when(test, F.struct(F.lit(length).alias("length"), F.lit(window).alias("window"), F.lit(stride).alias("stride")))

    def stored(value: Column, name: str) -> Column:
        """A column by a one-row generator, so that it is computed once and not again wherever it is used."""
        return F.inline(F.array(F.struct(value.alias(name))))

    every = sorted({v for c in coded.values() for v in c})

    def marked(length: int) -> Column:
        return F.exists("marked", lambda n: n == length)

    texts = (
        docs.where(F.col("text").isNotNull())
        .select("doc_id", F.xxhash64("text").alias("code"), stored(lowered, "lowered"))
        .select("doc_id", "code", "lowered", stored(F.array_compact(F.array(*[F.when(possible(n), F.lit(n)) for n in lengths])), "marked"))
        .where(F.size("marked") > 0)
        .select("doc_id", "code", "marked", stored(F.regexp_extract_all("lowered", F.lit(WORD), F.lit(0)), "words"))
        .select("doc_id", "code", "marked", "words", stored(F.array_distinct(F.filter(codes(F.col("words")), lambda c: c.isin(*every))), "held"))
        .select("doc_id", "code", "words", stored(F.array_compact(F.array(*[cut(n, marked(n) & enough(n)) for n in lengths])), "grid"))
        .where(F.size("grid") > 0)
        .select("doc_id", "code", "grid", "words")
    )
    known = (
        spark.createDataFrame([(name, len(words), words) for name, words in split.items()], "license string, length int, words array<string>")
        .select("license", "length", shingles(F.col("words")).alias("wanted"), F.posexplode(bands(F.col("words"))).alias("band", "value"))
    )
    if sum(map(len, templates.values())) <= BROADCAST_CHARS:
        known = F.broadcast(known)
    last = F.greatest(F.size("words") - F.col("window") + F.col("stride") - 1, F.lit(0))
    places = F.sequence(F.lit(0), last, F.col("stride"))
    windows = (
        texts.where(F.size("words") >= SHINGLE)
        .select("doc_id", "code", "words", F.inline("grid"))
        # Windows are cut inside the array, so that no row carries a whole text's words.
        .select("doc_id", "code", "length", F.inline(F.transform(places, lambda at: F.struct(at.alias("at"), F.slice("words", at + 1, F.col("window")).alias("part")))))
    )
    retrieved = (
        windows.select("*", F.posexplode(bands(F.col("part"))).alias("band", "value"))
        .join(known, ["length", "band", "value"])
        .withColumn("containment", F.size(F.array_intersect("wanted", shingles(F.col("part")))) / F.size("wanted"))
        .where(F.col("containment") >= containment)
    )
    return retrieved.select("doc_id", "code", "license", F.col("at").cast("long").alias("first_word"), "containment").distinct()


def licensed(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """One row per document and license found: the number of windows, the best containment, the first word of the first window."""
    return (
        scan(docs, templates, containment)
        .groupBy("doc_id", "code", "license")
        .agg(F.count("*").alias("n_windows"), F.max("containment").alias("containment"), F.min("first_word").alias("first_word"))
    )
