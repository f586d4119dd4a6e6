"""Licence families of paragraphs by a trained classifier, confirmed against templates.

A multinomial logistic regression over sparse word unigrams and bigrams tells the families apart and
from everything else. Its threshold for "unknown" is calibrated on held-out paragraphs without any
licence. What it finds is compared with the wording of the family before it is confirmed. Only
DataFrame functions and the DataFrame estimators of Spark are used.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions.binding import let
from pagemill.llm.tables import written

# Fixed wording of the families: sentences that notices and texts of the licence are made of.
TEMPLATES = {
    "mit": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "The Software is provided AS IS, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement.",
        "In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the Software or the use or other dealings in the Software.",
        "SPDX-License-Identifier: MIT",
    ),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS.",
        "See the License for the specific language governing permissions and limitations under the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-3.0-only",
        "SPDX-License-Identifier: GPL-2.0-only",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "agpl": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "bsd": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "This software is provided by the copyright holders and contributors AS IS and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "SPDX-License-Identifier: BSD-2-Clause",
    ),
    "isc": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "The software is provided AS IS and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness.",
        "SPDX-License-Identifier: ISC",
    ),
    "mpl-2.0": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "epl-2.0": (
        "Licensed under the Eclipse Public License, version 2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
        "SPDX-License-Identifier: EPL-2.0",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "SPDX-License-Identifier: Unlicense",
    ),
    "cc0": (
        "Licensed under CC0 1.0.",
        "This work is licensed under the Creative Commons CC0 1.0 Universal Public Domain Dedication.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
}
UNKNOWN = "unknown"
FAMILIES = (UNKNOWN, *TEMPLATES)
FEATURES = 1 << 14          # words and word pairs of the positive examples, most frequent first
LONGEST_FEATURE = 100       # characters; longer ones are no words
HINTS = ("licens", "licenc", "copyright", "redistribut", "permission", "warrant", "public domain")    # of paragraphs worth comparing in training
VARIANTS = 12               # altered copies of every template sentence in training
FALSE_ALARMS = 0.001        # share of held-out paragraphs without licence above the threshold
WEIGHTS = {"template": 1.0, "near": 1.0, "far": 4.0}      # of the sums of sentences, agreeing paragraphs and others in training
STEPS = 1 << 16             # of a probability, for the threshold
CONFIRMED = 0.6             # share of a paragraph's word pairs, or of a sentence's, that agree
_EDGES = " \t\r.,;:!?()[]{}<>\"'*#_=|"      # around a word, not part of it


@dataclass
class Classifier:
    """``needed``: words of which a paragraph above the threshold has one; None if there are no such words."""
    model: PipelineModel
    threshold: float
    needed: list[str] | None


def words(paragraph: Column) -> Column:
    """Lower-case words between blanks, without the punctuation around them."""
    spaced = F.when(paragraph.contains("\t"), F.translate(paragraph, "\t", " ")).otherwise(paragraph)
    parts = F.split(F.lower(F.coalesce(spaced, F.lit(""))), " ")
    return F.filter(F.transform(parts, lambda w: F.btrim(w, F.lit(_EDGES))), lambda w: w != "")


def word_pairs(tokens: Column) -> Column:
    """Neighbouring words; a single word is a pair of its own."""
    pairs = F.zip_with(tokens, F.slice(tokens, 2, F.greatest(F.size(tokens), F.lit(1))),
                       lambda a, b: F.concat_ws(" ", a, F.coalesce(b, F.lit(""))))
    return F.array_distinct(F.when(F.size(tokens) > 1, F.slice(pairs, 1, F.greatest(F.size(tokens) - 1, F.lit(1)))).otherwise(pairs))


def features(tokens: Column) -> Column:
    """Words and word pairs; no word has a blank, so they cannot be confused."""
    return F.concat(tokens, word_pairs(tokens))


def _one_of(values: list[str]) -> str:
    """SQL text of a test for one of the values; thousands of them are parsed at once, not made into columns one by one."""
    quoted = ["'" + re.sub("[^A-Za-z0-9]", lambda c: f"\\U{ord(c[0]):08X}", value) + "'" for value in values]
    return f"IN ({', '.join(quoted)})" if quoted else "IS NULL"


def features_of(vocabulary: list[str], tokens: str) -> Column:
    """Those of the features of the column that may be in the vocabulary: words of it, and pairs of two such words.

    Most words of a text are in no feature; leaving them out first saves putting them into pairs that nobody looks for.
    """
    known = sorted({word for feature in vocabulary for word in feature.split(" ") if word})

    def of(marked: Column) -> Column:
        number = F.size(marked)
        pairs = F.zip_with(marked, F.slice(marked, 2, F.greatest(number, F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
        single = F.transform(marked, lambda w: F.concat(w, F.lit(" ")))
        return F.filter(F.concat(marked, F.when(number == 1, single).otherwise(pairs)), lambda feature: feature.isNotNull())

    return let(F.expr(f"transform(`{tokens}`, w -> CASE WHEN w {_one_of(known)} THEN w END)"), of)


def template_shares(tokens: Column) -> Column:
    """Map of family -> best agreement with a sentence of it: shared word pairs by those of the shorter side."""
    def best(pairs: Column, name: str) -> Column:
        shares = []
        for sentence in TEMPLATES[name]:
            tokens_of = [w for w in (part.strip(_EDGES) for part in re.split(" ", sentence.lower())) if w]
            own = F.array(*[F.lit(" ".join(p)) for p in dict.fromkeys(zip(tokens_of, tokens_of[1:]))])
            least = F.least(F.size(own), F.size(pairs))
            shares.append(F.when(least > 0, F.size(F.array_intersect(own, pairs)) / least).otherwise(0.0))
        return F.greatest(*shares, F.lit(0.0))

    names = F.array(*[F.lit(name) for name in TEMPLATES])
    return F.map_from_arrays(names, let(word_pairs(tokens), lambda pairs: F.array(*[best(pairs, name) for name in TEMPLATES])))


def _with_once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """The rows with one more column; as it is generated, later filters and columns read it and do not compute it anew."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


def paragraphs(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, paragraph_no, paragraph): the lines of every text that have a letter or digit; numbers from 0."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.posexplode(F.split(F.col(f"`{text}`"), "\n")).alias("paragraph_no", "paragraph"))
    return rows.filter(F.col("paragraph").rlike(r"[\p{L}\p{N}]"))


def _altered(sentences: DataFrame) -> DataFrame:
    """Template sentences, whole and with one word in six left out, different ones in each copy."""
    kept = F.filter("tokens", lambda w: (F.col("variant") == 0) | (F.pmod(F.xxhash64("variant", w, "family"), F.lit(6)) != 0))
    return (sentences.withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS))))
            .select(kept.alias("tokens"), "family"))


def train(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> Classifier:
    """A classifier of FAMILIES.

    Positive examples are template sentences, whole and altered, and all paragraphs of the corpus that
    agree with a template; the others are all paragraphs of the corpus without any of HINTS, of which a third by
    hash is held out to calibrate. Features are words and word pairs of the positive examples, counted over all of
    them. A paragraph is then a set of features; equal ones are one example with their number, so training moves
    these sets and no text. Sentences, agreeing paragraphs and the others weigh the same in sum, whatever their
    numbers. The threshold is the least probability that no more than a share FALSE_ALARMS of all held-out
    paragraphs exceeds.
    """
    spark = docs.sparkSession
    template = spark.createDataFrame([(s, f) for f, sentences in TEMPLATES.items() for s in sentences], "sentence string, family string")
    template = template.select(words(F.col("sentence")).alias("tokens"), "family")
    lines = paragraphs(docs, doc_id, text)
    hinted = _has_any(F.col("paragraph"), HINTS)
    near = _with_once(lines.filter(hinted).groupBy("paragraph").agg(F.count("*").alias("n")), "tokens", words(F.col("paragraph")))
    best = F.array_max(F.transform(F.map_entries(template_shares(F.col("tokens"))), lambda e: F.struct(
        e["value"].alias("share"), e["key"].alias("family"))))
    near = (_with_once(near, "best", best).filter(F.col("best.share") >= CONFIRMED)
            .select("tokens", F.col("best.family").alias("family"), "n", F.lit("near").alias("kind")))
    names = F.array(*[F.lit(f) for f in FAMILIES])
    positive = (_altered(template).select("tokens", "family", F.lit(1).cast("long").alias("n"), F.lit("template").alias("kind")).unionByName(near)
                .withColumn("label", (F.array_position(names, F.col("family")) - 1).cast("double")))
    positive = written(positive, "examples")
    counts = (positive.select(F.explode(F.array_distinct(features(F.col("tokens")))).alias("feature"), "n")
              .filter(F.length("feature") <= LONGEST_FEATURE).groupBy("feature").agg(F.sum("n").alias("count")).filter("count > 1"))
    vocabulary = [r["feature"] for r in counts.orderBy(F.desc("count"), "feature").limit(FEATURES).collect()]
    vectors = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="terms", outputCol="features")
    vectors.setBinary(True)
    held = F.pmod(F.xxhash64("paragraph", F.lit(9)), F.lit(3)) == 0
    far = _with_once(lines.filter(~hinted), "tokens", words(F.col("paragraph"))).select("tokens", held.alias("held"))
    far = written(vectors.transform(_with_terms(far, vocabulary)).groupBy("features", "held").agg(F.count("*").alias("n")), "paragraphs")
    examples = (vectors.transform(_with_terms(positive, vocabulary)).select("features", "label", "n", "kind")
                .unionByName(far.filter("not held").select("features", F.lit(0.0).alias("label"), "n", F.lit("far").alias("kind"))))
    sizes = {r["kind"]: r["n"] for r in examples.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    share = reduce(lambda w, kind: w.when(F.col("kind") == kind, F.col("n") * F.lit(WEIGHTS[kind] / sizes[kind])), sorted(sizes), F.when(F.lit(False), 0.0))
    fit = LogisticRegression(family="multinomial", weightCol="share", maxIter=25, regParam=0.001, elasticNetParam=1.0, standardization=False).fit(
        examples.withColumn("share", share * sizes["template"]))
    model = PipelineModel([vectors, fit])
    threshold = max(0.5, _exceeded_by(fit.transform(far.filter("held")), 1 - F.element_at(vector_to_array("probability"), 1)))
    leads = _leads(vocabulary, fit.coefficientMatrix.toArray(), fit.interceptVector.toArray(), threshold)
    return Classifier(model, threshold, _needed_words(far, vocabulary, leads))


def _exceeded_by(rows: DataFrame, value: Column) -> float:
    """The least of STEPS steps from 0 to 1 that no more than a share FALSE_ALARMS of ``n`` summed over the rows exceeds."""
    counts = rows.groupBy(F.ceil(value * STEPS).alias("step")).agg(F.sum("n").alias("n")).collect()
    above, spare = 0, FALSE_ALARMS * sum(r["n"] for r in counts)
    for row in sorted(counts, key=lambda r: -r["step"]):
        above += row["n"]
        if above > spare:
            return row["step"] / STEPS
    return 0.0


def _with_terms(rows: DataFrame, vocabulary: list[str]) -> DataFrame:
    return _with_once(rows, "terms", features_of(vocabulary, "tokens"))


def _has_any(paragraph: Column, parts) -> Column:
    """Whether one of the parts, which are in lower case, stands anywhere in the paragraph."""
    return let(F.lower(paragraph), lambda low: reduce(or_, [low.contains(part) for part in parts], F.lit(False)))


def _leads(vocabulary, weights, bias, threshold: float) -> list[tuple[float, dict[str, float]]]:
    """For each family the lead that a probability above the threshold asks of one family at least, and its words.

    A pair of words counts for the longer of the two, as it cannot be there without it.
    """
    least = math.log(threshold / max(1 - threshold, 1e-12) / len(TEMPLATES)) - 1e-6
    result = []
    for family in range(1, len(FAMILIES)):
        lead, by_word = weights[family] - weights[0], {}
        for at in (lead > 0).nonzero()[0]:
            word = max(vocabulary[at].split(" "), key=len)
            by_word[word] = by_word.get(word, 0.0) + float(lead[at])
        result.append((float(least - (bias[family] - bias[0])), by_word))
    return result


def _needed_words(others: DataFrame, vocabulary, leads) -> list[str] | None:
    """Words of which every paragraph above the threshold has one.

    The words of a family that are left out here add up to less than the lead it needs; they are
    the most common ones in ``others``, the paragraphs without licence, for the lead that they give.
    """
    if min(spare for spare, _ in leads) <= 0:
        return None
    if not any(by_word for _, by_word in leads):
        return []
    counts = others.select(F.explode(F.unwrap_udt("features")["indices"]).alias("at"), "n").groupBy("at").agg(F.sum("n").alias("n"))
    common, needed = {vocabulary[r["at"]]: r["n"] for r in counts.collect()}, set()
    for spare, by_word in leads:
        for word in sorted(by_word, key=lambda w: (-common.get(w, 0) / by_word[w], w)):
            if by_word[word] < spare:
                spare -= by_word[word]
            else:
                needed.add(word)
    return sorted(needed)


def _may_be_licence(tokens: str, classifier: Classifier) -> Column:
    """False only if no family can reach the threshold, whatever the order of the words."""
    return F.lit(True) if classifier.needed is None else F.expr(f"exists(`{tokens}`, w -> w {_one_of(classifier.needed)})")


def scan(docs: DataFrame, classifier: Classifier, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, paragraph_no, family, probability, similarity, confirmed) of the paragraphs with a licence.

    Every paragraph of every text is classified; where it has none of the words without which the
    threshold is out of reach, the model need not be asked. ``probability`` is that of the family;
    paragraphs below the threshold are unknown and not returned. ``confirmed`` is whether the wording
    agrees with the family's.

    Null and empty texts have no paragraphs; repeated rows give repeated results; rows without id are
    scanned like others; other columns are not read.
    """
    rows = _with_once(paragraphs(docs, doc_id, text), "tokens", words(F.col("paragraph")))
    rows = rows.filter(_may_be_licence("tokens", classifier))
    scored = classifier.model.transform(_with_terms(rows, classifier.model.stages[0].vocabulary))
    scored = _with_once(scored.select("doc_id", "paragraph_no", "tokens", "probability"), "by_family", vector_to_array("probability"))
    place = F.array_position("by_family", F.array_max("by_family")).cast("int")
    names = F.array(*[F.lit(f) for f in FAMILIES])
    found = scored.select("doc_id", "paragraph_no", "tokens", F.element_at(names, place).alias("family"),
                          F.array_max("by_family").alias("probability"),
                          (1 - F.element_at("by_family", 1)).alias("licence"))
    found = found.filter((F.col("family") != UNKNOWN) & (F.col("licence") >= classifier.threshold))
    found = _with_once(found, "similarity", F.element_at(template_shares(F.col("tokens")), F.col("family")))
    return found.select("doc_id", "paragraph_no", "family", "probability", "similarity", (F.col("similarity") >= CONFIRMED).alias("confirmed"))
