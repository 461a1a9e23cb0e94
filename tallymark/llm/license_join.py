"""License scan: fixed phrases, and an exact set-similarity join of text blocks with license templates.

The blocks of a template of n words are the windows of 2n words of a text that begin at every n-th word, so that any n words in
a row lie in one, however lines are wrapped, indented or commented out. A block meets the template when it holds at least
`CONTAINMENT` of its distinct words. What no whole text holds, none of its blocks does: the join is on whole texts first.
Words are put in one global order, rarest in the corpus first. Projected on the templates' words and put in that order, a text
and a template that meet share a word within the template's prefix (prefix filter), the text has enough words (length filter),
and the places of the shared word leave room for enough more (positional filter). Of what passes, the blocks are verified.

Templates are a parameter of bounded size (`MOST_TEMPLATE_WORDS` distinct words in all), so the join needs no shuffle of
texts, however often one block is repeated, while the candidates are few enough to be broadcast.

Defined results: a null text counts as empty: no words, nulls for first and last word, empty labels, score 0. Rows are
told apart by id and text; every input row gives one output row. Without templates only the phrases count. An empty table
gives an empty result. Other columns of the input are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import ascii_lower, bounded, text_of

CONTAINMENT = 0.8
MOST_TEMPLATE_WORDS = 2_000
#: Candidates (ids and a template, some 20 bytes each) that may be broadcast; beyond, texts are shuffled to them.
CANDIDATES = 400_000
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Public notices by which texts are commonly licensed, (label, text).
TEMPLATES: tuple[tuple[str, str], ...] = (
    (
        "mit",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
        files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
        modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
        is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be
        included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY
        KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
        NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
        WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
        OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "Released under the MIT License."),
    (
        "apache",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
        License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law
        or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
        CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
        limitations under the License.""",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    (
        "gpl",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
        published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This
        program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
        MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have
        received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.""",
    ),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    (
        "bsd",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
        following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
        the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of
        the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software
        without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY
        EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
        PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
        INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
        SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
        CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE,
        EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    ),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    (
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND
        THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
        FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
        WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
        ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    (
        "mpl",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
        with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    ),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    (
        "unlicense",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile,
        sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or
        non-commercial, and by any means.""",
    ),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
)

#: Between words, upper case letters still counting as parts of words.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def all_words(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate({c: c + 32 for c in range(65, 91)}))


def template_words(text: str) -> list[str]:
    """The distinct words."""
    return list(dict.fromkeys(all_words(text)))


def least_shared(size: int, containment: float = CONTAINMENT) -> int:
    """The fewest shared words with which a template of so many words is met."""
    return next(k for k in range(1, size + 1) if k >= containment * size - 1e-9)


def _pieces(text: Column) -> Column:
    return F.split(text, BETWEEN + "+")


def n_words(text: Column) -> Column:
    """Words of a text: pieces between separators, less the empty ones at its ends."""
    pieces = _pieces(text)
    edge = lambda side: F.when(text.rlike(side), 1).otherwise(0)
    return F.when(text == "", 0).otherwise(F.size(pieces) - edge("^" + BETWEEN) - edge(BETWEEN + r"\z")).cast("bigint")


def base_scan(documents: DataFrame, keep: list[str]) -> DataFrame:
    """`keep`, n_words, places (starts of the phrases, in words) and base_labels (an array) per row."""
    pattern = "|".join(f"{BETWEEN}+".join(phrase.split()) for phrase in PHRASES)
    rows = documents.select(*keep, text_of().alias("t"))
    # (?i) is ASCII only here; the words of the few texts with a phrase are then looked at one by one
    rows = rows.withColumn("w", F.when(F.col("t").rlike(f"(?i){pattern}"), F.filter(_pieces(ascii_lower(F.col("t"))), lambda x: x != "")))
    w = F.col("w")
    at = lambda i, phrase: F.coalesce(F.forall(
        F.array(*[F.get(w, i + k).eqNullSafe(word) for k, word in enumerate(phrase.split())]), lambda same: same), F.lit(False))
    found = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.size(w) - 1),
            lambda i: F.struct(
                i.cast("bigint").alias("i"),
                F.coalesce(*[F.when(at(i, phrase), F.lit(label)) for phrase, label in PHRASES.items()]).alias("label"),
            ),
        ),
        lambda x: x["label"].isNotNull(),
    )
    rows = rows.withColumn("found", F.when(w.isNotNull(), found).otherwise(F.array().cast("array<struct<i:bigint,label:string>>")))
    return rows.select(
        *keep,
        n_words(F.col("t")).alias("n_words"),
        F.transform("found", lambda x: x["i"]).alias("places"),
        F.array_distinct(F.transform("found", lambda x: x["label"])).alias("base_labels"),
    )


def global_order(documents: DataFrame, words: list[str]) -> list[str]:
    """`words`, rarest in the corpus first, ties by the word. Only this bounded list is counted and collected."""
    if len(words) > MOST_TEMPLATE_WORDS:
        raise ValueError(f"templates have {len(words)} distinct words; at most {MOST_TEMPLATE_WORDS} are allowed")
    known = F.array(*[F.lit(word) for word in words])
    held = documents.select(F.explode(F.array_intersect(known, _pieces(ascii_lower(text_of())))).alias("word"))
    frequency = {row["word"]: row["count"] for row in held.groupBy("word").count().collect()}  # at most the words asked for
    return sorted(words, key=lambda word: (frequency.get(word, 0), word.encode()))


def similar_texts(documents: DataFrame, keep: list[str], sets: list[list[str]], order: list[str], containment: float) -> DataFrame:
    """`keep`, template_id of whole texts that may hold a block that meets the template."""
    spark = documents.sparkSession
    place = {word: i for i, word in enumerate(order)}
    index = []
    for t, words in enumerate(sets):
        words = sorted(words, key=place.__getitem__)
        need = least_shared(len(words), containment)
        index += [(word, t, i, len(words), need) for i, word in enumerate(words[: len(words) - need + 1])]
    index = spark.createDataFrame(index, "word string, template_id int, at int, size int, need int")
    ordered = F.array(*[F.lit(word) for word in order])
    shortest = min(least_shared(len(words), containment) for words in sets)
    # a text's words among the templates' words, in the global order
    projected = documents.select(*keep, F.array_intersect(ordered, _pieces(ascii_lower(text_of()))).alias("own")).where(F.size("own") >= shortest)
    return (
        projected.select(*keep, F.size("own").alias("held"), F.posexplode("own").alias("own_at", "word"))
        .join(F.broadcast(index), "word")
        .where(F.col("held") >= F.col("need"))
        .where(F.least("at", "own_at") + 1 + F.least(F.col("size") - F.col("at") - 1, F.col("held") - F.col("own_at") - 1) >= F.col("need"))
        .select(*keep, "template_id")
        .distinct()
    )


def similar_blocks(
    documents: DataFrame,
    keep: list[str],
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """Every text and template whose containment some block meets: `keep`, template_id, label, block (the best, from 0), containment."""
    spark = documents.sparkSession
    sets = [template_words(text) for _, text in templates]
    result = ", ".join([*[f"`{k}` {dict(documents.dtypes)[k]}" for k in keep], "template_id int, label string, block int, containment double"])
    if not any(sets):
        return spark.createDataFrame([], result)
    order = global_order(documents, sorted(set().union(*sets)))
    candidates = bounded(similar_texts(documents, keep, sets, order, containment), CANDIDATES)
    whole = [
        (t, label, words, least_shared(len(words), containment), len(all_words(text)))
        for t, ((label, text), words) in enumerate(zip(templates, sets))
        if words
    ]
    described = spark.createDataFrame(whole, "template_id int, label string, template_words array<string>, least int, n int")
    near = documents.join(candidates, keep).join(F.broadcast(described), "template_id")
    n = F.col("n")

    def best(words: Column) -> Column:
        last = F.greatest(F.ceil(F.size(words) / n).cast("int") - 2, F.lit(0))
        shared = F.transform(
            F.sequence(F.lit(0), last),
            lambda k: F.struct(
                F.size(F.array_intersect("template_words", F.slice(words, k * n + 1, 2 * n))).alias("shared"), (-k).alias("block")
            ),
        )
        return F.array_max(shared)

    words = F.filter(_pieces(ascii_lower(text_of())), lambda w: w != "")
    found = near.select(*keep, "template_id", "label", "least", "template_words", F.get(F.transform(F.array(words), best), F.lit(0)).alias("b"))
    return found.where(F.col("b.shared") >= F.col("least")).select(
        *keep,
        "template_id",
        "label",
        (-F.col("b.block")).alias("block"),
        (F.col("b.shared") / F.size("template_words")).alias("containment"),
    )


def scanned(
    documents: DataFrame,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """Per document: doc_id, n_words, places, base_labels, template_labels (arrays), score.

    score is 1 with a phrase, else the largest containment of a template that is met, else 0.
    """
    keyed = documents.select("doc_id", F.xxhash64(text_of()).alias("key"), "text")
    met = (
        similar_blocks(keyed, ["doc_id", "key"], templates, containment)
        .groupBy(F.col("doc_id").alias("met_id"), F.col("key").alias("met_key"))
        .agg(F.collect_set("label").alias("template_labels"), F.max("containment").alias("best"))
    )
    empty = F.array().cast("array<string>")
    return (
        base_scan(keyed, ["doc_id", "key"])
        .join(met, F.col("doc_id").eqNullSafe(F.col("met_id")) & (F.col("key") == F.col("met_key")), "left")
        .select(
            "doc_id",
            "n_words",
            "places",
            "base_labels",
            F.coalesce("template_labels", empty).alias("template_labels"),
            F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        )
    )
