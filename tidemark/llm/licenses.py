"""Licence scans with built-in functions only: Dice coefficient over word bigrams."""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Notices and licence texts, as published with the licences.
TEMPLATES: list[tuple[str, str]] = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
     documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
     use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
     Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be
     included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
     EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
     NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN
     AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
     THE SOFTWARE."""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
     the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable
     law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
     CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
     limitations under the License."""),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
     License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This
     program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
     MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
     provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND
     THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
     FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
     WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
     ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
     distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
]

#: Dice coefficient from which a passage is that licence.
THRESHOLD = 0.8

_NOT_WORD = r"[^a-z0-9]+"


def template_bigrams(text: str) -> list[str]:
    """The distinct word bigrams of a normalised template; a single word stands for itself."""
    words = [w for w in re.split(_NOT_WORD, text.lower()) if w]
    return sorted({" ".join(p) for p in zip(words, words[1:])} or set(words))


def marks(own: list[str], threshold: float) -> set[str]:
    """Words of which every passage that is alike to a template holds at least one.

    Dice t needs at least t / (2 - t) of the template's bigrams in the passage, so any set of bigrams that leaves fewer than that must be
    touched. Words that cover such a set are taken greedily, those in many bigrams and long ones first.
    """
    need = math.ceil(threshold / (2 - threshold) * len(own) - 1e-9)
    left, chosen = [b.split() for b in own], set()
    while len(left) >= need:
        count = Counter(w for b in left for w in set(b))
        chosen.add(max(count, key=lambda w: (count[w] * len(w) ** 2, w)))
        left = [b for b in left if not chosen & set(b)]
    return chosen


def _normalised(text: Column) -> Column:
    """Lower case; all between words (a-z, digits) is one space, but line feeds stay."""
    return F.regexp_replace(F.lower(text), r"[^a-z0-9\n]+", " ")


def _any_word(words: set[str]) -> str:
    """A pattern for any of the words, alternatives grouped by first letter."""
    groups: dict[str, list[str]] = {}
    for word in sorted(words):
        groups.setdefault(word[0], []).append(word[1:])
    return r"\b(?:" + "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in groups.items()) + r")\b"


def _words(passage: Column) -> Column:
    """Of normalised text."""
    return F.array_remove(F.split(passage, " "), "")


def _bigrams(words: Column) -> Column:
    pairs = F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(F.when(F.size(words) > 1, pairs).otherwise(words))


def _let(value: Column, use) -> Column:
    """`use(value)`, with the value computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _best(bigrams: Column, templates: list[tuple[str, list[str]]], threshold: float) -> Column:
    """(dice, -number) of the most alike template, null if none reaches the threshold.

    2 |A and B| / (|A| + |B|) >= t needs |A| between t / (2 - t) |B| and (2 - t) / t |B|: templates beyond that are not compared.
    """
    size = F.size(bigrams)
    ratio = threshold / (2 - threshold)
    found = []
    for n, (_, own) in enumerate(templates):
        dice = 2.0 * F.size(F.array_intersect(bigrams, F.array(*[F.lit(b) for b in own]))) / (size + len(own))
        near = (size >= ratio * len(own) - 1e-9) & (size <= len(own) / ratio + 1e-9)
        found.append(F.when(near, F.struct(dice.alias("dice"), F.lit(-n).alias("minus"))))
    return F.array_max(F.filter(F.array(*found), lambda x: x["dice"] >= threshold))


def licences(docs: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD,
             id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, found), one row per row of `docs`; found: array of (passage, licence, dice).

    The passages of a document are its lines, numbered from 1, and its whole text, number 0. Each is compared with the templates
    (name, text) by the Dice coefficient over distinct word bigrams; `found` has the passages that reach the threshold, each with the most
    alike template (equal: the first one listed), in order of the numbers. A document of one line gives that line and its text.

    Everything happens inside a row with built-in functions: no shuffle, no join. Texts and passages without any of the `marks` of
    the templates are passed over before they are split. Templates are a list in the program, so their number is bounded. Null and empty texts, and an empty table, give nothing; other columns are not read.
    """
    bigrams = [(name, template_bigrams(text)) for name, text in (TEMPLATES if templates is None else templates)]
    bigrams = [(name, own) for name, own in bigrams if own]
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), _normalised(text).alias("text"))
    kind = "array<struct<passage int, licence string, dice double>>"
    if not bigrams:
        return rows.select("doc_id", F.array().cast(kind).alias("found"))
    # the smallest passage that any template can be alike to; shorter ones need no bigrams at all
    least = threshold / (2 - threshold) * min(len(own) for _, own in bigrams)
    names = F.array(*[F.lit(name) for name, _ in bigrams])
    signs = F.lit(_any_word(set().union(*(marks(own, threshold) for _, own in bigrams))))

    def marked(text: Column) -> Column:
        return F.rlike(text, signs)

    passages = rows.select("doc_id", F.when(marked(F.col("text")), F.concat(F.array(F.replace("text", F.lit("\n"), F.lit(" "))), F.split("text", "\n"))).otherwise(
        F.array().cast("array<string>")).alias("passages"))

    def look(passage: Column, number: Column) -> Column:
        best = F.when(marked(passage), _let(_words(passage), lambda words: F.when(
            F.size(words) >= least, _let(_bigrams(words), lambda b: _best(b, bigrams, threshold)))))
        return F.struct(number.cast("int").alias("passage"), best.alias("best"))

    seen = passages.select("doc_id", F.filter(F.transform("passages", look), lambda x: x["best"].isNotNull()).alias("seen"))
    return seen.select("doc_id", F.transform("seen", lambda x: F.struct(
        x["passage"].alias("passage"), F.element_at(names, 1 - x["best"]["minus"]).alias("licence"),
        x["best"]["dice"].alias("dice"))).cast(kind).alias("found"))


def template_words(text: str) -> list[str]:
    return [w for w in re.split(_NOT_WORD, text.lower()) if w]


def anchors(text: str, threshold: float) -> list[tuple[str, int]]:
    """(word, place) of the marks of a template in it: where a text has such a word, a run that begins `place` words before may be the template."""
    chosen = marks(template_bigrams(text), threshold)
    return [(w, j) for j, w in enumerate(template_words(text)) if w in chosen]


def licence_runs(docs: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD,
                 id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, runs), one row per row of `docs`; runs: array of (start, words, licence, dice), licences anywhere in the text.

    A run is as many words as its template has, whatever stands between them: line ends, comment marks, the words of a paragraph before and after. Runs
    begin wherever one of the template's marks puts them (`anchors`; clipped to the text), and are compared by the Dice coefficient over distinct
    word bigrams. Of overlapping runs the most alike stays (equal: the longer, the template listed first, the earlier). `start` counts
    words from 0. Everything happens inside a row with built-in functions; texts without any mark are passed over. Null and empty texts have no runs.
    """
    given = [(name, template_words(text), template_bigrams(text), anchors(text, threshold))
             for name, text in (TEMPLATES if templates is None else templates) if template_words(text)]
    kind = "array<struct<start int, words int, licence string, dice double>>"
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.replace(_normalised(text), F.lit("\n"), F.lit(" ")).alias("text"))
    if not given:
        return rows.select("doc_id", F.array().cast(kind).alias("runs"))
    signs = sorted({w for *_, own in given for w, _ in own})
    words = rows.select("doc_id", F.when(F.rlike("text", F.lit(_any_word(set(signs)))), _words(F.col("text"))).otherwise(F.array().cast("array<string>")).alias("w"))
    places = words.withColumn("at", F.filter(F.transform("w", lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: x["w"].isin(signs)))

    def alike(number: int, size: int, own: list[str], marked: list[tuple[str, int]]) -> Column:
        """The runs of one template that reach the threshold."""
        by_word: dict[str, list[int]] = {}
        for word, j in marked:
            by_word.setdefault(word, []).append(j)

        def begun(word: str, before: list[int]) -> Column:
            return F.transform(F.filter("at", lambda x: x["w"] == word), lambda x: F.array(*[x["i"] - F.lit(j) for j in before]))

        starts = F.array_distinct(F.flatten(F.concat(*[begun(word, before) for word, before in by_word.items()])))

        def run(start: Column) -> Column:
            first = F.greatest(start, F.lit(0))
            length = F.least(start + size, F.size("w")) - first
            return _let(_bigrams(F.slice("w", first + 1, length)), lambda b: F.struct(
                (2.0 * F.size(F.array_intersect(b, F.array(*[F.lit(x) for x in own]))) / (F.size(b) + len(own))).alias("dice"),
                length.alias("words"), F.lit(-number).alias("minus"), (-first).alias("start")))

        return F.filter(F.transform(starts, run), lambda x: x["dice"] >= threshold)

    found = F.concat(*[alike(n, len(ws), own, marked) for n, (_, ws, own, marked) in enumerate(given)])
    every = places.select("doc_id", F.array_distinct(found).alias("f"))
    # minus the start and the number: a greater struct is a better run
    better = lambda x: F.exists("f", lambda y: (y > x) & (-y["start"] < -x["start"] + x["words"]) & (-x["start"] < -y["start"] + y["words"]))
    best = F.array_sort(F.transform(F.filter("f", lambda x: ~better(x)), lambda x: F.struct(
        (-x["start"]).alias("start"), x["words"].alias("words"), F.element_at(F.array(*[F.lit(g[0]) for g in given]), 1 - x["minus"]).alias("licence"),
        x["dice"].alias("dice"))))
    return every.select("doc_id", best.cast(kind).alias("runs"))
