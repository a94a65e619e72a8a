"""Find licence notices and texts in documents by Dice coefficients over word bigrams.

Units are the lines of a text, the text as a whole, and windows of two or more consecutive lines. A unit's words are lower-cased (A-Z) and stripped of
punctuation; its distinct bigrams meet those of the templates in an equi-join, and only pairs of fitting sizes are
scored: a Dice coefficient of t needs a size ratio of at least t / (2 - t), and as large a share of a template's
bigrams. So a match must hold one of any bigrams that make up more than the rest; texts and lines without a word of
such a set of each template are left out before their words are cut. DataFrame functions only.

Windows find notices that are wrapped over lines within longer texts. For each template they begin and end with lines
that hold its bigrams (other lines at the ends only lower the coefficient), and end where a bigram is met that the
window had not yet; bigrams may cross line ends. The size bound holds for a window's bigrams with repeats too: it has at
most (2 - t) / t times as many as the template's text. So the windows from one line are few however long the text is, and
time grows in proportion to its length. Of a licence's windows that begin in a line the one with the highest coefficient
counts, then the shortest; of these, of those that end in a line the same, then the last to begin. Of windows that
overlap, the one with the highest coefficient counts, then the smallest name, then the first and shortest. A window
doesn't count, and only keeps others of its licence from counting, if the whole text or one of its lines matches with at
least its coefficient.

Defined results: null and empty texts match nothing, nor do units and templates of fewer than two words. Of several
templates for a unit, the highest coefficient wins, then the smallest name. Rows equal in id and text are reported
alike. An empty table gives an empty result; input columns other than id and text are not carried.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkmill.llm.shared import ascii_lower, computed_once, materialise, running

PERCENT = 80
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Short notices, and the public texts or file headers of common licences.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'),
    ("BSD-3-Clause", 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/."),
    ("ISC", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("proprietary", "Copyright. All rights reserved. No part of this work may be reproduced without permission."),
    ("proprietary", "All rights reserved."),
]


def template_words(templates=TEMPLATES) -> list[list[str]]:
    return [re.findall(WORD, text.translate({c: c + 32 for c in range(65, 91)})) for _, text in templates]


def template_bigrams(templates=TEMPLATES) -> list[set[tuple[str, str]]]:
    return [set(zip(w, w[1:], strict=False)) for w in template_words(templates)]


def anchors(grams: list[set[tuple[str, str]]], percent: int) -> list[str]:
    """Words of which every match holds at least one: in each template they touch more bigrams than a match may miss."""
    need = [len(g) - -(-len(g) * percent // (200 - percent)) + 1 if g else 0 for g in grams]
    open_grams, chosen = [set(g) for g in grams], []
    while any(n > 0 for n in need):
        gain: dict[str, int] = {}
        for g, n in zip(open_grams, need, strict=True):
            touched: dict[str, int] = {}
            for pair in g if n > 0 else ():
                for w in set(pair):
                    touched[w] = touched.get(w, 0) + 1
            for w, k in touched.items():
                gain[w] = gain.get(w, 0) + min(k, n)
        word = max(gain, key=lambda w: (gain[w] * len(w) ** 5, w))  # long words are rare elsewhere
        chosen.append(word)
        for i, g in enumerate(open_grams):
            left = {p for p in g if word not in p}
            need[i] -= len(g) - len(left)
            open_grams[i] = left
    return chosen


def holds_any(text: Column, words: list[str]) -> Column:
    """Whether text holds one of the words; null for a null text. exists() over an array of one computes the text once."""

    def one_of(t: Column) -> Column:
        found = F.lit(False)
        for w in words:  # short words are parts of many others, so they must stand alone
            found = found | (F.contains(t, F.lit(w)) if len(w) > 3 else F.contains(t, F.lit(w)) & t.rlike(rf"(?<![a-z0-9]){w}(?![a-z0-9])"))
        return found

    return F.exists(F.array(text), one_of)


def bigrams(text):
    """The distinct bigrams of a text column, as an array; empty below two words."""
    words = F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))
    pairs = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(pairs)


def units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, hash of the text, unit (0: all of it, else the line's number) and the unit's text; a single line is the text itself."""
    some = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    lines = F.split("text", "\n", -1)
    parts = F.when(F.size(lines) == 1, F.array("text")).otherwise(F.concat(F.array("text"), lines))
    return some.select("doc", "th", F.posexplode(parts).alias("unit", "text"))


def line_pairs(text: Column) -> Column:
    """Bigrams of a text over its line ends: an array of first (line of the first word), last (line of the second) and bigram."""
    words = F.flatten(F.transform(F.split(ascii_lower(text), "\n", -1), lambda x, i: F.transform(F.regexp_extract_all(x, F.lit(WORD), F.lit(0)), lambda w: F.struct((i + 1).alias("line"), w.alias("word")))))

    def pairs(w: Column) -> Column:
        n = F.greatest(F.size(w) - 1, F.lit(0))
        return F.zip_with(F.slice(w, 1, n), F.slice(w, 2, n), lambda a, b: F.struct(a["line"].alias("first"), b["line"].alias("last"), F.concat_ws(" ", a["word"], b["word"]).alias("bigram")))

    return F.transform(F.array(words), pairs)[0]  # an array of one computes the words once


def ends(met: DataFrame, percent: int, most: int) -> DataFrame:
    """Windows that hold enough bigrams of a template: doc, th, license, m, size, start, end, common. met: bigrams of templates where they are.

    A row counts for the starts behind the bigram's place before, at most `most` bigrams back: from each of them it is
    the next place of its bigram. Counted by the line where they end, these are the window's bigrams of the template.
    """
    key = ["doc", "th", "template", "license", "m", "size"]
    every = met.groupBy(*key).agg(F.collect_list(F.struct("pos", "first", "last", "gram")).alias("hits"))  # of one text
    rows = every.where(F.size(F.array_distinct(F.col("hits")["gram"])) * (200 - percent) >= percent * F.col("m")).select(*key, F.inline("hits"))
    by = Window.partitionBy(*key)
    rows = rows.withColumn("i", F.dense_rank().over(by.orderBy("first")))
    rows = rows.withColumns({"near": F.min("i").over(by.orderBy("pos").rangeBetween(-most, 0)), "seen": F.lag("i").over(Window.partitionBy(*key, "gram").orderBy("pos"))})
    least = F.greatest("near", F.coalesce(F.col("seen") + 1, F.lit(1)))
    rows = rows.where(least <= F.col("i")).select(*key, "first", "last", "i", F.explode(F.sequence(least, F.col("i"))).alias("s"))
    rows = rows.groupBy(*key, "s", F.col("last").alias("end")).agg(F.count("*").alias("c"), F.max(F.when(F.col("i") == F.col("s"), F.col("first"))).alias("own"))
    of_start = Window.partitionBy(*key, "s")
    rows = rows.withColumns({"common": F.sum("c").over(of_start.orderBy("end")), "start": F.max("own").over(of_start)})
    return rows.where(f"start < end and common * {200 - percent} >= {percent} * m").select("doc", "th", "license", "m", "size", "start", "end", "common")


def with_sizes(text: Column, found: Column) -> Column:
    """found windows with n, their different bigrams, and all, these with repeats. A window's bigrams are a slice of the text's."""
    words_before = running(F.transform(F.split(ascii_lower(text), "\n", -1), lambda x: F.size(F.regexp_extract_all(x, F.lit(WORD), F.lit(0)))), lambda a, b: a + b)

    def sized(z: Column) -> Column:
        def one(w: Column) -> Column:
            at = F.when(w["start"] == 1, F.lit(0)).otherwise(F.get(z["before"], w["start"] - 2))
            inside = F.filter(F.slice(z["pairs"], at + 1, F.get(z["before"], w["end"] - 1) - at), lambda p: p["last"] <= w["end"])["bigram"]
            return F.struct(w.alias("w"), computed_once(inside, lambda xs: F.struct(F.size(F.array_distinct(xs)).alias("n"), F.size(xs).alias("all"))).alias("s"))

        return F.transform(found, one)

    return computed_once(F.struct(line_pairs(text).alias("pairs"), words_before.alias("before")), sized)


def windows(some: DataFrame, own: DataFrame, known: DataFrame, percent: int, most: int) -> DataFrame:
    """Matches of windows, as matches() has them; unit is the first line. some: doc, th, text; own: matches of lines and whole texts; most: bigrams of a window."""
    wrapped = some.where(F.contains("text", F.lit("\n"))).dropDuplicates(["doc", "th"])
    met = wrapped.select("doc", "th", F.posexplode(line_pairs(F.col("text"))).alias("pos", "p")).select("doc", "th", "pos", "p.*").join(known, "bigram")
    by_doc = ends(met, percent, most).groupBy("doc", "th").agg(F.collect_list(F.struct("license", "m", "size", "start", "end", "common")).alias("found")).alias("f")
    units_of = own.groupBy("doc", "th").agg(F.collect_list(F.struct("unit", "license", "dice")).alias("own")).alias("o")
    by_doc = by_doc.join(units_of, F.expr("f.doc <=> o.doc and f.th = o.th"), "left").select("f.doc", "f.th", "found", F.coalesce("own", F.filter(F.array(F.struct(F.lit(0).alias("unit"), F.lit("").alias("license"), F.lit(0.0).alias("dice"))), lambda o: F.lit(False))).alias("own"))
    # Where all windows hold lines that match fully, none can count, and texts aren't needed.
    by_doc = by_doc.where("exists(found, f -> not exists(own, o -> o.dice >= 1 and (o.unit = 0 or o.unit between f.start and f.end)))").alias("f")
    texts = wrapped.alias("t").join(by_doc, F.expr("t.doc <=> f.doc and t.th = f.th")).select("t.doc", "t.th", "own", F.explode(with_sizes(F.col("text"), F.col("found"))).alias("x"))
    each = texts.select("doc", "th", "own", "x.w.*", "x.s.*").where(f"200 * common >= {percent} * (n + m) and {percent} * all <= {200 - percent} * size")
    minus = (-2 * F.col("common") / (F.col("n") + F.col("m"))).alias("minus")
    each = each.groupBy("doc", "th", "license", "start").agg(F.first("own").alias("own"), F.min(F.struct(minus, "end")).alias("best"))
    each = each.groupBy("doc", "th", "license", "best.end").agg(F.first("own").alias("own"), F.min(F.struct("best.minus", (-F.col("start")).alias("back"))).alias("best"))
    each = each.select("doc", "th", "own", "license", (-F.col("best.back")).alias("start"), "end", (-F.col("best.minus")).alias("dice"))
    each = each.withColumn("told", F.expr("exists(own, o -> o.dice >= dice and (o.unit = 0 or o.unit between start and end))"))
    best = each.groupBy("doc", "th").agg(F.array_sort(F.collect_set(F.struct((-F.col("dice")).alias("minus"), "license", "start", "end", "told"))).alias("all"))

    def add(kept: Column, w: Column) -> Column:
        over = F.exists(kept, lambda k: (k["start"] <= w["end"]) & (k["end"] >= w["start"]) & (~k["told"] | (k["license"] == w["license"])))
        return F.when(over, kept).otherwise(F.concat(kept, F.array(w)))

    kept = best.select("doc", "th", F.inline(F.aggregate("all", F.filter("all", lambda w: F.lit(False)), add))).where("not told")
    return kept.select("doc", "th", F.col("start").alias("unit"), "license", (-F.col("minus")).alias("dice"))


_KNOWN = pa.schema([("template", pa.int32()), ("license", pa.string()), ("m", pa.int32()), ("size", pa.int32()), ("gram", pa.int32()), ("bigram", pa.string())])


def matches(docs: DataFrame, templates=TEMPLATES, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, th (hash of its text), unit, license and dice of each unit's best template with 100 * dice >= percent.

    templates: (name, text) of each. percent: from 1 to 100. Texts with anchor words and the matches of lines and whole
    texts are written to the shared folder first, as windows need both.
    """
    grams = template_bigrams(templates)
    lengths = [max(0, len(w) - 1) for w in template_words(templates)]
    rows = [{"template": i, "license": templates[i][0], "m": len(g), "size": lengths[i], "gram": k, "bigram": " ".join(pair)} for i, g in enumerate(grams) for k, pair in enumerate(sorted(g))]
    # A local relation, of which Spark knows the size and so how to join it.
    known = docs.sparkSession.createDataFrame(pa.Table.from_pylist(rows, _KNOWN))
    words = anchors(grams, percent)
    some = docs.where(holds_any(ascii_lower(F.col(text_col)), words))
    some = materialise(some.select(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text")), "license-texts")
    own = units(some, "doc", "text").where(holds_any(ascii_lower(F.col("text")), words)).select("doc", "th", "unit", bigrams(F.col("text")).alias("b"))
    sizes = [len(g) for g in grams if g] or [0]
    fits = F.col("n").between(min(sizes) * percent / (200 - percent), max(sizes) * (200 - percent) / percent)
    met = own.select("doc", "th", "unit", F.size("b").alias("n"), F.explode("b").alias("bigram")).where(fits).join(known, "bigram").where(f"{percent} * (n + m) <= 200 * least(n, m)")
    # Rows equal in id and text have every bigram several times.
    scored = met.groupBy("doc", "th", "unit", "template", "license", "n", "m").agg(F.count_distinct("bigram").alias("common")).where(f"200 * common >= {percent} * (n + m)")
    dice = (2 * F.col("common") / (F.col("n") + F.col("m"))).alias("dice")
    best = scored.select("doc", "th", "unit", "license", dice).groupBy("doc", "th", "unit").agg(F.max("dice").alias("dice"), F.min(F.struct((-F.col("dice")).alias("minus"), "license")).alias("best"))
    found = materialise(best.select("doc", "th", "unit", "best.license", "dice"), "license-units")
    return found.unionByName(windows(some, found, known, percent, max(lengths, default=0) * (200 - percent) // percent))


def scan(docs: DataFrame, templates=TEMPLATES, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_matches (units with a licence, windows among them), licenses (their names, sorted), license and dice of the best unit (null: none)."""
    found = matches(docs, templates, percent, id_col, text_col)
    best = F.min(F.struct((-F.col("dice")).alias("minus"), "license")).alias("best")
    by = found.groupBy("doc", "th").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("license")).alias("names"), best).withColumnRenamed("th", "hit")
    every = docs.select(F.col(id_col), F.xxhash64(text_col).alias("th"))
    both = every.join(by, F.col(id_col).eqNullSafe(F.col("doc")) & (F.col("th") == F.col("hit")), "left")
    return both.select(id_col, F.coalesce("n", F.lit(0)).cast("long").alias("n_matches"), F.coalesce("names", F.array().cast("array<string>")).alias("licenses"), F.col("best.license").alias("license"), (-F.col("best.minus")).alias("dice"))
