"""License scans by diagonal voting, in DataFrame functions only.

A template is a short phrase or a whole license text.  Every rolling k-word
gram of the documents is hashed and joined to the positions of the same gram in
the templates; the words of both are compared, so a vote is exact.  A phrase's
gram is the phrase itself: every vote is a place where it stands.  For license
texts (grams of ``GRAM`` words) the votes are counted by document, template and
diagonal (position in the document minus position in the template): an
unchanged copy is one diagonal, an inserted or missing word moves the rest to a
neighbouring one.  Diagonals of a document and template that are at most
``SLACK`` apart are merged, and the merged span is verified: at least
``COVERAGE`` of the template's words must lie in matched grams, and at least
half of the span's words.

The templates are a fixed list of a few thousand grams, and the only thing that
is broadcast.  The grams of a document are made, joined and (unless they vote)
dropped inside the task that reads it; only votes and one marker row per
document are shuffled, counted in the map tasks first.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starbuild.llm.common import text_or_empty

#: Words per gram of a license text.
GRAM = 4
#: Neighbouring diagonals that are merged: at most this many words apart.
SLACK = 8
#: Share of a license text's words that a verified span must have.
COVERAGE = 0.6
DENSITY = 0.5

#: A word: ASCII letters and digits and everything that is not ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrase: bool = False     # stands for its label wherever its words stand consecutively
    base: bool = False       # counted in the base columns

    @property
    def words(self) -> list[str]:
        return re.findall(WORD, self.text.lower())

    @property
    def gram(self) -> int:
        return len(self.words) if self.phrase else GRAM


def _phrases(label: str, *texts: str, base: bool = False) -> list[Template]:
    return [Template(label, t, True, base) for t in texts]


#: Phrases that name a license, and the public texts of the
#: licenses themselves or of the notices that go with them.
TEMPLATES = [
    *_phrases("mit", "mit license", base=True),
    *_phrases("apache", "apache license", base=True),
    *_phrases("gpl", "general public license", base=True),
    *_phrases("mit", "spdx license identifier mit"),
    *_phrases("apache", "spdx license identifier apache"),
    *_phrases("gpl", "spdx license identifier gpl"),
    *_phrases("lgpl", "lesser general public license", "library general public license", "spdx license identifier lgpl"),
    *_phrases("agpl", "affero general public license", "spdx license identifier agpl"),
    *_phrases("bsd", "bsd license", "3 clause bsd", "2 clause bsd", "spdx license identifier bsd"),
    *_phrases("mpl", "mozilla public license", "spdx license identifier mpl"),
    *_phrases("epl", "eclipse public license", "spdx license identifier epl"),
    *_phrases("isc", "isc license", "spdx license identifier isc"),
    *_phrases("cc-by-nc", "cc by nc", "creative commons attribution noncommercial",
              "creative commons attribution non commercial"),
    *_phrases("cc-by-sa", "cc by sa", "creative commons attribution sharealike", "creative commons attribution share alike"),
    *_phrases("cc-by", "licensed under cc by 4", "licensed under cc by 3", "creative commons attribution 4 0"),
    *_phrases("cc0", "cc0 1 0", "creative commons zero"),
    Template("mit", """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS
BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    Template("bsd", """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    Template("isc", """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS
IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    Template("apache", """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable
law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
permissions and limitations under the License."""),
    Template("gpl", """
This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License
as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You
should have received a copy of the GNU General Public License along with this program."""),
    Template("mpl", """
This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    Template("unlicense", """
This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
commercial or non-commercial, and by any means."""),
    Template("zlib", """
This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software. Permission is granted to anyone to use this software for any
purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but
is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the
original software. 3. This notice may not be removed or altered from any source distribution."""),
]

_TEMPLATE = "template int, label string, phrase boolean, base boolean, length int, k int"


def gram_table(spark: SparkSession, templates: Sequence[Template], longest: int) -> DataFrame:
    """One row per gram position of every template, and a marker row (``k`` 0,
    no template) that every document meets once."""
    rows = [(None, None, None, None, None, 0, None, [])]
    for i, t in enumerate(templates):
        words = t.words
        rows += [(i, t.label, t.phrase, t.base, len(words), t.gram, at, words[at:at + t.gram])
                 for at in range(len(words) - t.gram + 1)]
    key = gram_key(F.col("k"), [F.get("gram", F.lit(i)) for i in range(longest)])
    return spark.createDataFrame(rows, f"{_TEMPLATE}, at int, gram array<string>").withColumn("key", key)


def document_words(text: Column) -> Column:
    """The words of a text, A-Z in lower case.

    ``lower`` changes letters outside ASCII as well, which no template has; the
    two whose lower case has an ASCII letter (U+0130 and U+212A) are replaced first."""
    ascii_safe = F.replace(F.replace(text, F.lit("\u212a"), F.lit("\ufffd")), F.lit("\u0130"), F.lit("\ufffd"))
    # split, not regexp_extract_all: that copies the text once per match
    return F.array_remove(F.split(F.lower(ascii_safe), BETWEEN), "")


def gram_key(k: Column, words: Sequence[Column]) -> Column:
    """Hash of a gram's words (null beyond the k-th, which the hash passes over)."""
    return F.xxhash64(k, *words)


def votes(docs: DataFrame, templates: Sequence[Template], id_col: str, text_col: str) -> DataFrame:
    """``(id, text_hash, n_words, pos, at, <template columns>)`` of every gram that
    document and template share, and a marker row per document.

    Only positions whose word starts some gram of the templates are hashed."""
    text = text_or_empty(text_col)
    spots = (docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), document_words(text).alias("w"))
             .withColumn("n_words", F.size("w").cast("long"))
             .select("*", F.explode(F.sequence(F.lit(-1), F.size("w") - 1)).alias("pos")))
    pos = F.col("pos")
    starts = sorted({w for t in templates for w in t.words[:len(t.words) - t.gram + 1]})
    sizes = sorted({t.gram for t in templates})
    marker = F.when(pos < 0, F.lit(0))
    spots = (spots.where((pos < 0) | F.get("w", pos).isin(starts))
             .select("*", F.explode(F.array(marker, *[
                 F.when((pos >= 0) & (pos + k <= F.size("w")), F.lit(k)) for k in sizes])).alias("k"))
             .where("k is not null"))
    key = gram_key(F.col("k"), [F.when(F.col("k") > i, F.get("w", pos + i)) for i in range(max(sizes))])
    met = (spots.withColumn("key", key).alias("d")
           .join(F.broadcast(gram_table(docs.sparkSession, templates, max(sizes))).alias("t"), F.col("d.key") == F.col("t.key")))
    gram = F.when(F.col("d.k") > 0, F.slice("w", pos + 1, F.col("d.k"))).otherwise(F.array().cast("array<string>"))
    # equal in both directions: as a plain equality the words would become part of the join's key
    same = (F.col("d.k") == F.col("t.k")) & (gram <= F.col("t.gram")) & (gram >= F.col("t.gram"))
    return met.where(same).select("id", "text_hash", "n_words", pos.cast("long").alias("pos"), "at", "template", "label",
                                  "phrase", "base", "length", F.col("t.k").alias("k"))


def spans(found: DataFrame, slack: int, coverage: float, density: float) -> DataFrame:
    """``(id, text_hash, n_words, template, label, base, hits, first, last, score)``
    of the verified spans of ``votes``; the marker rows stay (no template, and
    ``hits`` copies of the row).  A phrase has one row for all its places."""
    doc = ["id", "text_hash", "n_words"]
    kind = ["template", "label", "phrase", "base", "length", "k"]
    long = F.expr("template is not null and not phrase")
    diagonal = F.when(long, F.col("pos") - F.col("at")).otherwise(F.lit(0))
    lines = (found.groupBy(*doc, *kind, diagonal.alias("diagonal"))
             .agg(F.count(F.lit(1)).alias("hits"), F.min("pos").alias("first"), F.max("pos").alias("last"),
                  F.collect_set(F.when(long, F.col("pos"))).alias("spots")))     # at most a template's length
    by_diagonal = Window.partitionBy(*doc, "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by_diagonal) > slack, F.lit(False))
    bands = (lines.withColumn("apart", apart.cast("int"))
             .withColumn("band", F.sum("apart").over(by_diagonal.rowsBetween(Window.unboundedPreceding, 0)))
             .groupBy(*doc, *kind, "band")
             .agg(F.sum("hits").alias("hits"), F.min("first").alias("first"), F.max("last").alias("last"),
                  F.collect_set(F.transform("spots", lambda p: p - F.col("diagonal"))).alias("ats"),
                  F.collect_list("spots").alias("spots")))

    def covered(places: Column) -> Column:
        """How many words lie in the grams at these places."""
        at = F.array_distinct(F.flatten(places))
        return F.size(F.array_distinct(F.flatten(F.transform(at, lambda p: F.sequence(p, p + F.col("k") - 1)))))

    share = F.when(long, covered(F.col("ats")) / F.col("length")).otherwise(F.lit(1.0))
    dense = covered(F.col("spots")) / (F.col("last") + F.col("k") - F.col("first"))
    return (bands.withColumn("score", share).where(~long | ((F.col("score") >= coverage) & (dense >= density)))
            .select(*doc, "template", "label", "base", "hits", "first", "last", "score"))


def license_scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, id_col: str = "doc_id",
                 text_col: str = "text", slack: int = SLACK, coverage: float = COVERAGE,
                 density: float = DENSITY) -> DataFrame:
    """``(id, n_words, n_base, first_word, last_word, base_labels, labels, score)``
    of every row.

    ``n_base`` counts the places of the base phrases, ``first_word`` and
    ``last_word`` are their smallest and largest start (words from 0; null
    without one).  Labels are distinct, in code-point order and joined by commas
    (empty text: none); ``score`` is the best share of a template's words that a
    verified span has (phrases: 1; nothing found: 0).

    Edge cases: null, empty and blank texts have no words and no labels; rows
    that share id and text are counted once and returned as often as they
    occur; null ids are like any other; an empty table gives an empty result;
    extra columns are ignored.  A text's words and grams are held by one task."""
    found = spans(votes(docs, templates, id_col, text_col), slack, coverage, density)
    base, marker = F.col("base"), F.col("template").isNull()
    per_doc = (found.groupBy("id", "text_hash", "n_words")
               .agg(F.max(F.when(marker, F.col("hits"))).alias("copies"),
                    F.sum(F.when(base, F.col("hits")).otherwise(F.lit(0))).alias("hits"),
                    F.min(F.when(base, F.col("first"))).alias("first_word"),
                    F.max(F.when(base, F.col("last"))).alias("last_word"),
                    F.array_sort(F.collect_set(F.when(base, F.col("label")))).alias("base_labels"),
                    F.array_sort(F.collect_set("label")).alias("labels"),
                    F.coalesce(F.max(F.when(~marker, F.col("score"))), F.lit(0.0)).alias("score")))
    return (per_doc.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
            .select("id", "n_words", F.expr("hits div copies").alias("n_base"), "first_word", "last_word",
                    F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"),
                    "score"))
