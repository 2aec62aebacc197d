"""Licence scans: sparse TF-IDF cosine to templates, then inheritance from the nearest directory.

What is compared with every template is each line of a file, each header, which is a run of consecutive
lines with terms such as a comment block, and the whole file, as a licence file is one. Terms are
weighted by how few lines of the whole corpus have them; only the templates' terms are counted, a number
that does not grow, and any other term has the weight of a term that no line has.

A text can only reach the threshold with a template if it has one of the template's rarest terms
(so many that the rest of the template is too light without them), so other files, and then other
texts of a file, are passed over without loss. What is left is reduced to distinct texts. Their
terms, with counts, are joined with the templates' postings, one row per term and template, and summed
by text and template; a text and a template that share no term never meet. A file's licence is that of
its best text, found again by hashes of the text.

A directory has the licence of its licence files or else, where most licensed files directly in it
agree, theirs. A file without a licence of its own takes that of the nearest ancestor directory that has one: the
distinct directories are joined with their ancestors, of which there are as many as a path has
parts, and files are joined with their directory.

Everything is a native column expression. Defined cases: null and empty texts have no licence of
their own; a null path has no directory and inherits nothing; of equal scores the template that
comes first by name wins; repeated rows each get a result and each count; a very long text is
compared as a whole like any other; an empty table gives no rows; helper columns take names that
no input column has.
"""

from __future__ import annotations

import re
from collections import Counter
from math import log, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import fresh
from cohortloom.operators.materialize import settle
from cohortloom.operators.sizing import broadcast_small

# Notices that licence stewards ask authors to use, short forms and full texts, by SPDX id.
_GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} as published by the Free Software Foundation, {1}."
_WARRANTY = " This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} for more details."
_LATER = "either version {0} of the License, or (at your option) any later version"
_MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
_MIT_RIGHTS = _MIT + " (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
_MIT_FULL = _MIT_RIGHTS + " The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_APACHE = "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_MPL = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."


def _gnu(spdx: str, kind: str, version: int) -> list[str]:
    header = _GNU.format(kind, _LATER.format(version))
    return [
        f"This work is licensed under the GNU {kind}, version {version}.", f"Licensed under the GNU {kind} v{version}.0.",
        f"Licensed under {spdx}.", header, header + _WARRANTY.format(kind), _GNU.format(kind, f"version {version} of the License"),
    ]


_DISCLAIMER = " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_SOURCE_FORM = _BSD + " 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_ENDORSE = " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
_ISC_FULL = _ISC + " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
_UNLICENSE = "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
_VERBATIM = " Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."


def _title(kind: str, version: str, year: int) -> list[str]:
    title = f"GNU {kind} Version {version}"
    return [title, f"{title} Copyright (C) {year} Free Software Foundation, Inc. <https://fsf.org/>" + _VERBATIM]


TEMPLATES = {
    "AGPL-3.0": _gnu("AGPL-3.0", "Affero General Public License", 3) + _title("Affero General Public License", "3, 19 November 2007", 2007),
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", _APACHE, "Released under the Apache License 2.0.", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/", _APACHE + " You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License.", _SOURCE_FORM, _SOURCE_FORM + _DISCLAIMER],
    "BSD-3-Clause": [_BSD, "Use of this source code is governed by a BSD-style license.", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.", "Licensed under the BSD 3-Clause License.", _SOURCE_FORM + _ENDORSE, _SOURCE_FORM + _ENDORSE + _DISCLAIMER],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "Licensed under CC BY-SA 4.0."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "Licensed under CC0 1.0.", "CC0 1.0 Universal Public Domain Dedication."],
    "GPL-2.0": _gnu("GPL-2.0", "General Public License", 2) + _title("General Public License", "2, June 1991", 1989),
    "GPL-3.0": _gnu("GPL-3.0", "General Public License", 3) + _title("General Public License", "3, 29 June 2007", 2007),
    "ISC": ["Licensed under the ISC License.", _ISC, _ISC_FULL],
    "LGPL-3.0": _gnu("LGPL-3.0", "Lesser General Public License", 3) + _title("Lesser General Public License", "3, 29 June 2007", 2007),
    "MIT": ["Released under the MIT License.", _MIT, "Licensed under the MIT License.", _MIT_RIGHTS, _MIT_FULL],
    "MPL-2.0": [_MPL, "Licensed under the Mozilla Public License 2.0.", _MPL + " If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "Unlicense": [_UNLICENSE, "Released into the public domain under the Unlicense."],
    "proprietary": ["All rights reserved. Unauthorized copying of this file is strictly prohibited.", "All rights reserved."],
}
THRESHOLD = 0.6
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice|legal|terms)([._-].*)?$"
TERM = "[a-z0-9]+"


def _plain(lines: Column) -> Column:
    """The lines' terms, separated by single blanks and, between lines, line breaks."""
    return F.regexp_replace(F.lower(F.array_join(lines, "\n")), r"[^a-z0-9\n]+", " ")


def _joined(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[ \n]+", " "))


def _vocabulary(templates: dict[str, list[str]]) -> list[tuple[str, Counter]]:
    return [(name, Counter(re.findall(TERM, text.lower()))) for name, texts in sorted(templates.items()) for text in texts]


def _weights(plain: DataFrame, vocabulary: list[str]) -> tuple[dict[str, float], float]:
    """Inverse document frequency of each template term over all lines, and of any other term."""
    lines = plain.select(F.explode(F.split("plain", "\n")).alias("line")).select(F.trim("line").alias("line")).filter("line != ''")
    # The empty text stands for the line itself.
    found = lines.select(F.explode(F.array_append(F.array_distinct(F.split("line", " ")), F.lit(""))).alias("term"))
    counts = dict(found.filter(F.col("term").isin("", *vocabulary)).groupBy("term").count().collect())  # one row per template term
    total = counts.get("", 0)
    return {t: log((1 + total) / (1 + counts.get(t, 0))) + 1 for t in vocabulary}, log(1 + total) + 1


def _needed(vector: dict[str, float], idf: dict[str, float], threshold: float) -> list[str]:
    """The rarest terms, so many that a text with none of them stays below the threshold."""
    rest = sum(w * w for w in vector.values())
    bound, found = (threshold * threshold - 1e-9) * rest, []
    for term, weight in sorted(vector.items(), key=lambda x: (-idf[x[0]], x[0])):
        if rest < bound:
            break
        found.append(term)
        rest -= weight * weight
    return found


def _texts(plain: Column) -> Column:
    """Lines, headers and the whole of a file, each text once."""
    lines = F.split(plain, "\n")
    headers = F.split(plain, r"\n(?: ?\n)+")
    return F.array_distinct(F.transform(F.concat(lines, headers, F.array(plain)), _joined))


def _hashes(value: Column, names: tuple[str, str]) -> list[Column]:
    return [F.xxhash64(value).alias(names[0]), F.xxhash64(F.lit(1), value).alias(names[1])]


def _best(texts: DataFrame, vectors: list[tuple[str, dict[str, float]]], idf: dict[str, float], other: float, threshold: float) -> DataFrame:
    """(t1, t2, best) of the distinct texts that reach the threshold with a template."""
    spark = texts.sparkSession
    weights = spark.createDataFrame(list(idf.items()), "term string, idf double")
    names = spark.createDataFrame(
        [(turn, name, sqrt(sum(w * w for w in vector.values()))) for turn, (name, vector) in enumerate(vectors)],
        "turn int, name string, norm double",
    )
    postings = spark.createDataFrame(
        [(term, turn, weight) for turn, (_, vector) in enumerate(vectors) for term, weight in vector.items()],
        "term string, turn int, weight double",
    )
    key = ["t1", "t2"]
    words = texts.select(*_hashes(F.col("text"), ("t1", "t2")), F.explode(F.split("text", " ")).alias("term"))
    counted = words.groupBy(*key, "term").agg(F.count(F.lit(1)).alias("n"))
    # The templates' terms are as many as their texts have, whatever the input.
    own = F.col("n") * F.coalesce("idf", F.lit(other))
    weighed = settle(counted.join(F.broadcast(weights), "term", "left").select(*key, "term", own.alias("x")))
    lengths = weighed.groupBy(*key).agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("length"))
    dots = (
        weighed.join(F.broadcast(postings), "term").groupBy(*key, "turn").agg(F.sum(F.col("x") * F.col("weight")).alias("dot"))
    )
    score = F.round(F.col("dot") / (F.col("length") * F.col("norm")), 6)
    scored = dots.join(lengths, key).join(F.broadcast(names), "turn").withColumn("score", score)
    passed = scored.filter(F.col("score") >= threshold)
    return passed.groupBy(*key).agg(F.max(F.struct("score", (-F.col("turn")).alias("turn"), "name")).alias("best"))


def own_licences(files: DataFrame, lines: Column, templates: dict[str, list[str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``files`` with own_licence and own_score of the best text, null below the threshold.

    Input columns of these two names are replaced.
    """
    others = [c for c in files.columns if c.lower() not in ("own_licence", "own_score")]
    whole = F.coalesce(lines, F.array().cast("array<string>"))
    plain = files.select(_plain(whole).alias("plain"), *_hashes(whole, ("f1", "f2")))
    counted = _vocabulary(templates)
    idf, other = _weights(plain, sorted({t for _, c in counted for t in c}))
    vectors = [(name, {t: n * idf[t] for t, n in c.items()}) for name, c in counted]
    needed = F.array(*map(F.lit, sorted({t for _, v in vectors for t in _needed(v, idf, threshold)})))

    def heavy(text: Column) -> Column:
        return F.arrays_overlap(F.split(text, r"[ \n]+"), needed)

    # Files of equal lines are dealt with alike, so two hashes of the lines name them.
    file_key = ["f1", "f2"]
    some = plain.filter(heavy(F.col("plain")))
    texts = some.select(*file_key, F.explode(_texts(F.col("plain"))).alias("text"))
    texts = settle(texts.filter(heavy(F.col("text"))))
    best = settle(_best(texts.select("text").distinct(), vectors, idf, other, threshold))
    # Both sides are written, so AQE can split the key of a notice that very many files have.
    met = texts.select(*file_key, *_hashes(F.col("text"), ("t1", "t2"))).join(broadcast_small(best)[0], ["t1", "t2"])
    found = settle(met.groupBy(*file_key).agg(F.max("best").alias("best")))
    keys = [fresh(files.columns, name) for name in file_key]
    chosen = fresh(files.columns, "chosen")
    found = found.withColumnsRenamed(dict(zip([*file_key, "best"], [*keys, chosen])))
    keyed = files.select(*others, *_hashes(whole, tuple(keys)))
    joined = keyed.join(broadcast_small(found)[0], keys, "left")
    return joined.select(
        *others, F.col(f"{chosen}.name").alias("own_licence"), F.col(f"{chosen}.score").alias("own_score")
    )


def url_path(url: Column) -> Column:
    """host/part/part/name of a URL, without query and fragment."""
    bare = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    return F.when(F.contains(bare, F.lit("/")), bare).otherwise(F.concat(bare, F.lit("/")))


def directory_of(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def inherit(files: DataFrame, path: Column, licence_file: str = LICENCE_FILE) -> DataFrame:
    """``files`` (with own_licence) with licence and inherited_from, the directory it comes from.

    Input columns of these two names are replaced.
    """
    others = [c for c in files.columns if c.lower() not in ("licence", "inherited_from")]
    folder, name = fresh(files.columns, "folder"), fresh(files.columns, "name")
    placed = files.select(*others, directory_of(path).alias(folder), F.regexp_extract(path, r"([^/]*)$", 1).alias(name))
    # What directories are told from is written once, so that the files are not scanned for each use of it.
    held = settle(placed.select(F.col(folder).alias("holder"), F.col(name).rlike(licence_file).alias("named"), "own_licence"))
    votes = settle(
        held.filter("own_licence is not null and holder is not null")
        .groupBy("holder", "own_licence")
        .agg(F.count(F.lit(1)).alias("files"), F.count(F.when(F.col("named"), 1)).alias("licence_files"))
    )
    order = F.struct("licence_files", "files")
    winner = votes.groupBy("holder").agg(
        F.max(F.struct(order.alias("votes"), "own_licence")).alias("w"),
        F.sum("files").alias("all"),
    )
    licensed = settle(
        winner.filter((F.col("w.votes.licence_files") > 0) | (2 * F.col("w.votes.files") > F.col("all")))
        .select("holder", F.col("w.own_licence").alias("theirs"))
    )
    parts = F.split("inside", "/")
    ancestors = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    taken = [*files.columns, folder, name]
    inside, source = fresh(taken, "inside"), fresh(taken, "nearest")
    nearest = settle(
        held.select(F.col("holder").alias("inside")).filter("inside is not null").distinct()
        .withColumn("holder", F.explode(ancestors))
        .join(licensed, "holder")
        .groupBy("inside")
        .agg(F.max(F.struct(F.length("holder").alias("depth"), "holder", "theirs")).alias("nearest"))
        .withColumnsRenamed({"inside": inside, "nearest": source})
    )
    joined = placed.join(nearest, F.col(folder) == F.col(inside), "left")
    own = F.col("own_licence")
    return joined.select(
        *others,
        F.coalesce(own, F.col(f"{source}.theirs")).alias("licence"),
        F.when(own.isNull(), F.col(f"{source}.holder")).alias("inherited_from"),
    )


def scan(files: DataFrame, path: Column, lines: Column, **settings) -> DataFrame:
    """Own licences, then inheritance; see own_licences and inherit."""
    place = fresh([*files.columns, "own_licence", "own_score", "licence", "inherited_from"], "place")
    scanned = own_licences(files.withColumn(place, path), lines, **settings)
    return inherit(scanned, F.col(place)).drop(place)
