"""Licence scan in DataFrame operations: sparse TF-IDF cosine to templates, then inheritance from the nearest directory above.

Compared with the templates, as sets of words, are the units of a file:

* every line,
* every block of neighbouring lines that are all comments or all other text (blank lines end a block), such as a header wrapped over several lines,
* the whole text of a file that is named like a licence.

A word weighs ``ln((files + 1) / (files with the word + 1)) + 1``, template word or not. Weights lie at 1 or above, so with K the squared weights of its template words a
unit of m other words has a squared length of K + m at least, a product with a template of K at most, and a cosine of K / sqrt((K + m) T) at most, T being the smallest
squared length of a template. The units for which that reaches ``LEAST`` are few, and only their words need weights.

The best template of at least ``LEAST`` is the file's own licence. A file named like a licence, or one whose first line or block is a notice, speaks
for its directory. A file without a licence of its own takes that of the nearest directory at or above its own that has one (its best notice, then the
smallest licence name and doc_id).
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from invoicelake.llm.common import stored

LEAST = 0.75
CLASS_RATIO = 1.25  # squared weights of the template words of one class differ by this at most, for the bound
_GNU = ("is free software: you can redistribute it and/or modify it under the terms of the GNU {0} as published by the Free Software Foundation, either "
        "version {1} of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} for more details. ")
_GNU_END = "You should have received a copy of the GNU {0} along with this program. If not, see <https://www.gnu.org/licenses/>."
_AS_IS = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED "
          "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
          "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
          "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
          "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_BSD = ("Copyright (c). All rights reserved. Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution. ")
_BSD_3 = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without "
          "specific prior written permission. ")
_GENERAL, _LESSER, _AFFERO = "General Public License", "Lesser General Public License", "Affero General Public License"
# fixed values: public notices, file headers and the texts of short licences by SPDX name; of the long ones the title stands for the file
TEMPLATES = {
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3.", _GNU.format(_AFFERO, 3) + _GNU_END.format(_AFFERO),
                 "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a "
                   "copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed "
                   "under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
                   "for the specific language governing permissions and limitations under the License."],
    "BSD-2-Clause": ["Redistribution under the BSD 2-Clause License is permitted.", _BSD + _AS_IS],
    "BSD-3-Clause": ["Redistribution under the BSD 3-Clause License is permitted.", _BSD + _BSD_3 + _AS_IS],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0-1.0": ["Released into the public domain under CC0 1.0.", "Creative Commons Legal Code CC0 1.0 Universal"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", _GNU.format(_GENERAL, 2) + _GNU_END.format(_GENERAL),
                "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", _GNU.format(_GENERAL, 3) + _GNU_END.format(_GENERAL),
                "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "ISC": ["Released under the ISC License.",
            "ISC License Copyright (c) Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
            "that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES "
            "WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
            "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR "
            "OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3.", _GNU.format(_LESSER, 3) + _GNU_END.format(_LESSER),
                 "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "MIT": ["Released under the MIT License.",
            "MIT License Copyright (c) Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
            "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
            "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The "
            "above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS "
            "IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
            "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
            "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."],
    "MPL-2.0": ["Licensed under the Mozilla Public License, Version 2.0.", "Mozilla Public License Version 2.0",
                "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can "
                "obtain one at https://mozilla.org/MPL/2.0/."],
    "Proprietary": ["All rights reserved."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
for _name, _texts in TEMPLATES.items():
    if _name != "Proprietary":
        _texts.append(f"SPDX-License-Identifier: {_name}")
        if "GPL" in _name:
            _texts += [f"SPDX-License-Identifier: {_name}-{kind}" for kind in ("only", "or-later")]
NAMES = r"(?i)(^|/)((un)?licen[cs]e|copying|notice)[^/]*$"
COMMENT = r"^[ \t]*(#|//|/?\*|--|;|%|<!--|dnl |rem )"


def template_words(templates: dict[str, list[str]]) -> list[tuple[str, int, str]]:
    """(licence, number of the template, word)."""
    return [(name, k, word) for name, texts in sorted(templates.items()) for k, text in enumerate(texts)
            for word in sorted(set(re.findall("[a-z0-9]+", text.lower())))]


def _among(words: Column, some: list[str]) -> Column:
    """The words that are in a fixed list. Spark looks them up in one hash set per query; ``array_intersect`` would build the set anew for every array."""
    return F.filter(words, lambda w: w.isin(some))


def _words(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(text, "[^a-z0-9]+", -1), lambda w: w != ""))


def _body() -> Column:
    return F.lower(F.coalesce("text", F.lit("")))


def weight(n_files: float, df: float) -> float:
    return math.log((n_files + 1) / (df + 1)) + 1


def _units(files: DataFrame) -> DataFrame:
    """``file, doc_id, path, units``: the word sets of what is compared, ``top`` telling the first line and block."""
    lines = F.split(F.replace(_body(), F.lit("\x01"), F.lit(" ")), "\n", -1)
    rows = files.select("file", "doc_id", "path", lines.alias("lines"))
    kind = F.transform("lines", lambda x: F.when(~x.rlike(r"[^ \t\r]"), "b").when(x.rlike(COMMENT), "c").otherwise("p"))
    rows = rows.select("file", "doc_id", "path", "lines", kind.alias("kinds"))
    # arrays used inside a function are referenced a second time, so that Spark computes them once per row
    joined = F.transform("lines", lambda x, i: F.concat(F.when(i == 0, "").when(F.get("kinds", i - 1) == F.get("kinds", i), "\n").otherwise("\x01"), x))
    blocks = F.filter(F.split(F.array_join(joined, ""), "\x01", -1), lambda x: x.rlike("[a-z0-9]"))

    def unit(top: Column, text: Column) -> Column:
        return F.struct(top.alias("top"), _words(text).alias("words"))
    whole = F.when(F.coalesce(F.regexp_like("path", F.lit(NAMES)), F.lit(False)), F.array(unit(F.lit(False), F.array_join("lines", "\n"))))
    several = F.filter(F.transform(blocks, lambda x, i: F.struct((i == 0).alias("top"), x.alias("text"))), lambda x: F.instr(x["text"], "\n") > 0)
    return rows.select("file", "doc_id", "path", F.concat(
        F.transform("lines", lambda x, i: unit(i == 0, x)), F.transform(several, lambda x: unit(x["top"], x["text"])),
        F.coalesce(whole, F.array().cast("array<struct<top:boolean,words:array<string>>>"))).alias("units"))


def _files_with(files: DataFrame, words: list[str] | None = None) -> DataFrame:
    """A row for every file and word of it (of ``words``, if given); a file counts once."""
    found = _words(_body())
    return files.select(F.explode(found if words is None else _among(found, words)).alias("word"))


def notices(files: DataFrame, templates: dict[str, list[str]] | None = None, least: float = LEAST) -> tuple[DataFrame, DataFrame]:
    """The files (``file, doc_id, path``) and their best notices (``file, licence, similarity, first_line``); all files are counted."""
    spark, pairs = files.sparkSession, template_words(templates or TEMPLATES)
    files = files.select("doc_id", "path", "text")
    vocabulary = sorted({word for _, _, word in pairs})
    total = files.count()
    counted = _files_with(files, vocabulary).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    df = dict.fromkeys(vocabulary, 0) | {row["word"]: row["df"] for row in counted.collect()}  # as many as the templates have words
    squares = sorted((weight(total, df[word]) ** 2, word) for word in vocabulary)
    of_word = {word: square for square, word in squares}
    lengths: dict[tuple[str, int], float] = {}
    for name, k, word in pairs:
        lengths[name, k] = lengths.get((name, k), 0.0) + of_word[word]
    classes: list[list[tuple[float, str]]] = []
    for square, word in squares:
        if not classes or square > classes[-1][0][0] * CLASS_RATIO:
            classes.append([])
        classes[-1].append((square, word))

    known_part = F.transform("units", lambda u: F.struct(u["top"].alias("top"), u["words"].alias("words"), _among(u["words"], vocabulary).alias("known")))
    sized = F.transform(F.filter(known_part, lambda u: F.size(u["known"]) > 0), lambda u: F.struct(
        u["top"].alias("top"), u["words"].alias("words"), F.size(u["known"]).alias("n"),
        F.array(*(F.size(_among(u["known"], [word for _, word in group])) for group in classes)).alias("counts")))

    squares_of_templates = sorted(set(lengths.values()))
    squared = F.array(*map(F.lit, squares_of_templates))

    def bounded(unit: Column) -> Column:
        """The squared lengths of the templates a unit can reach ``least`` with, ``least_t`` to ``most_t``; once per unit, not once per template."""
        low, high = (sum((F.get(unit["counts"], F.lit(k)) * F.lit(group[end][0]) for k, group in enumerate(classes)), F.lit(0.0)) for end in (0, -1))
        others, slack = F.size(unit["words"]) - unit["n"], least * least * (1 - 1e-9)
        return F.struct(unit["top"].alias("top"), unit["words"].alias("words"), (slack * (low + others)).alias("least_t"),
                        (high * high / (slack * (high + others))).alias("most_t"))

    def possible(unit: Column) -> Column:
        least_t, most_t = unit["least_t"], unit["most_t"]
        return ((least_t <= most_t) & (least_t <= squares_of_templates[-1]) & (most_t >= squares_of_templates[0])
                & F.exists(squared, lambda t: (t >= least_t) & (t <= most_t)))
    sized = F.transform(sized, bounded)
    kept = F.transform(F.filter(sized, possible), lambda u: F.struct(u["top"].alias("top"), u["words"].alias("words")))
    tagged = files.withColumn("file", F.monotonically_increasing_id())
    rows = stored(_units(tagged).select("file", "doc_id", "path", kept.alias("units")), "licence-units")
    units = rows.select("file", F.posexplode("units").alias("unit", "x")).select("file", "unit", "x.top", "x.words")
    terms = units.select("file", "unit", "top", F.size("words").alias("size"), F.explode("words").alias("word"))
    inside = F.broadcast(spark.createDataFrame(list(of_word.items()), "word string, w2 double"))  # a row per template word
    table = F.broadcast(spark.createDataFrame([(name, k, word, of_word[word], lengths[name, k]) for name, k, word in pairs],
                                              "licence string, template int, word string, w2 double, template2 double"))
    own = terms.join(inside, "word").groupBy("file", "unit").agg(F.sum("w2").alias("known2"), (F.max("size") - F.count(F.lit(1))).alias("others"), F.max("top").alias("top"))
    dots = terms.join(table, "word").groupBy("file", "unit", "licence", "template").agg(F.sum("w2").alias("dot"), F.max("template2").alias("template2"))
    # once more the bound, now with the products themselves
    near = F.col("dot") >= least * (1 - 1e-9) * F.sqrt((F.col("known2") + F.col("others")) * F.col("template2"))
    near = stored(dots.join(own, ["file", "unit"]).filter(near), "licence-candidates")
    strange = stored(terms.join(near.select("file", "unit").distinct(), ["file", "unit"]).filter(~F.col("word").isin(vocabulary)).select("file", "unit", "word"), "licence-words")
    # few words are asked for (Spark broadcasts them when they are small by their measured size), and they are counted in the tasks
    rare = _files_with(files).join(strange.select("word").distinct(), "word", "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    n = F.lit(total).cast("double")
    rare = rare.select("word", F.pow(F.log((n + 1) / (F.col("df") + 1)) + 1, 2).alias("w2"))
    rest = strange.join(rare, "word").groupBy("file", "unit").agg(F.sum("w2").alias("other2"))
    unit2 = F.col("known2") + F.coalesce("other2", F.lit(0.0))
    scored = near.join(rest, ["file", "unit"], "left").withColumn("similarity", F.round(F.col("dot") / F.sqrt(unit2 * F.col("template2")), 6))
    best = scored.filter(F.col("similarity") >= least).groupBy("file").agg(
        F.min(F.struct((-F.col("similarity")).alias("s"), "licence")).alias("best"), F.max("top").alias("first_line"))
    return rows.select("file", "doc_id", "path"), best.select("file", F.col("best.licence").alias("licence"),
                                                              (-F.col("best.s")).alias("similarity"), "first_line")


def scan(files: DataFrame, templates: dict[str, list[str]] | None = None, least: float = LEAST) -> DataFrame:
    """One row per file: ``doc_id, path, licence, similarity, via, from_doc_id``; via is own, inherited or none.

    ``files`` has doc_id, path (``a/b/name``; NULL: no directory) and text (NULL: empty). Rows that repeat an id are files of their own.
    """
    rows, best = notices(files, templates, least)
    marked = stored(rows.join(best, "file", "left").withColumn(
        "directory", F.when(F.instr("path", "/") > 0, F.regexp_extract("path", "^(.*)/[^/]*$", 1))), "licence-own")
    speaks = marked.filter(F.col("licence").isNotNull() & F.col("directory").isNotNull()
                           & (F.col("first_line") | F.regexp_like("path", F.lit(NAMES))))
    given = speaks.groupBy("directory").agg(F.min(F.struct((-F.col("similarity")).alias("s"), "licence", "doc_id")).alias("g"))
    # distinct directories climb, not files: a directory with a third of all files is one row here
    parts = F.split("directory", "/", -1)
    above = (marked.select("directory").dropna().distinct()
             .select("directory", F.explode(F.sequence(F.lit(1), F.size(parts))).alias("depth"))
             .select("directory", "depth", F.array_join(F.slice(F.split("directory", "/", -1), F.lit(1), F.col("depth")), "/").alias("up")))
    nearest = (above.join(given.withColumnRenamed("directory", "up"), "up").groupBy("directory")
               .agg(F.max_by("g", "depth").alias("g")))
    out = marked.join(nearest, "directory", "left")
    own = F.col("licence").isNotNull()
    return out.select(
        "doc_id", "path", F.coalesce("licence", "g.licence").alias("licence"), F.coalesce("similarity", -F.col("g.s")).alias("similarity"),
        F.when(own, "own").when(F.col("g").isNotNull(), "inherited").otherwise("none").alias("via"),
        F.when(own, F.col("doc_id")).otherwise(F.col("g.doc_id")).alias("from_doc_id"))


def document_path(doc_id: Column, source: Column) -> Column:
    """A path for documents that have none: their source, then directories of 1,000 and 100 neighbouring ids. Ids that are multiples of
    100 and 1,000 lie one and two directories higher."""
    thousand, hundred = F.floor(doc_id / 1000), F.floor(doc_id / 100)
    folder = (F.when(doc_id % 1000 == 0, F.lit("")).when(doc_id % 100 == 0, F.concat(thousand.cast("string"), F.lit("/")))
              .otherwise(F.concat(thousand.cast("string"), F.lit("/"), hundred.cast("string"), F.lit("/"))))
    return F.concat(F.coalesce(source, F.lit("")), F.lit("/"), folder, doc_id.cast("string"))
