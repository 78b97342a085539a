"""Licence scan: a trained paragraph classifier, confirmed by template comparison (DataFrame functions only).

Paragraphs (lines) are classified by multinomial logistic regression over sparse word uni- and
bigrams: one class for each licence family and ``unknown``.  Positive training rows are the notices
below and seeded variants of them; negative rows are notices of licences without a class, ordinary
sentences and a bounded sample of the corpus (``UNKNOWN_SAMPLE`` paragraphs expected).  A temperature
and the least probability of a named family are calibrated on whole notices, of named and of other
licences, that a first fit has not seen; the model is then fitted on all rows.  A prediction counts
when a template of its family confirms it: enough words in common, some of them side by side, and one
that few families have.  The fit runs on the driver over those bounded rows; the scan is all Catalyst
expressions.

A feature always contains a word that ordinary paragraphs hardly have.  A text without any such word
has no feature, so its paragraphs are ``unknown`` by the intercept, and it needs no scoring.

Defined results: null and empty texts have no paragraph and no licence; repeated rows are scanned
each; ties go to the family that sorts first; an empty table gives an empty result; very long
paragraphs are scored whole; extra columns are ignored.
"""

from __future__ import annotations

import random
import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Licence notices by family (fixed values).
TEMPLATES = {
    "agpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Licensed under the GNU Affero General Public License, version 3.",
        "Released under the AGPL-3.0 license.",
    ],
    "apache": [
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Licensed under the BSD 3-Clause License.",
        'This software is provided by the copyright holders and contributors "as is" and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed.',
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "This article is distributed under the terms of the Creative Commons Attribution License (CC BY), which permits unrestricted use, distribution and reproduction in any medium, provided the original work is properly cited.",
    ],
    "cc-by-nc": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
        "Available under the CC BY-NC-SA 4.0 license, for noncommercial use only.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License (CC BY-NC-ND).",
    ],
    "cc-by-sa": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
        "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply.",
    ],
    "gpl": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GPL-3.0 license.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
        "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "mit": [
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software',
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        'The software is provided "as is", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement.',
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License 2.0.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright (c) 2020 Example Corporation. All rights reserved. Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential.",
        "No part of this publication may be reproduced, distributed, or transmitted in any form without the prior written permission of the publisher.",
    ],
    "public-domain": [
        "This is free and unencumbered software released into the public domain.",
        "This work has been dedicated to the public domain under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ],
}
#: Notices of licences that have no class here (fixed values).
OTHER = [
    "Distributed under the Eclipse Public License 2.0.",
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "Distributed under the Boost Software License, Version 1.0.",
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
    "This package is free software; you can redistribute it under the terms of the Artistic License 2.0.",
    "The contents of this file are subject to the terms of the Common Development and Distribution License.",
    "Licensed under the European Union Public Licence, version 1.2.",
    "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    "Do what the fuck you want to public license, version 2.",
    "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice appear in all copies.",
    "Licensed under the Open Software License version 3.0.",
    "Licensed under the Academic Free License version 3.0.",
    "SPDX-License-Identifier: EPL-2.0",
    "SPDX-License-Identifier: BSL-1.0",
]
#: Ordinary sentences that use some of the same words (fixed values).
ORDINARY = [
    "He renewed his driving licence at the office before the end of the month.",
    "The general public was free to use the library, and any person could copy the list.",
    "The version of the story that was published in the paper had no source.",
    "The software was released in March and the source of the error was found later.",
    "Permission to enter the building is granted at the door.",
    "The rights of the workers were discussed under the terms of the new law.",
    "She reserved a table for two and all of them came.",
    "This program is on every evening; you can see it again or listen to it at any later time.",
    "The work was distributed to the groups under the following conditions.",
    "A copy of the notice was sent to the public office.",
]
UNKNOWN = "unknown"
UNKNOWN_SAMPLE, VARIANTS, ROUNDS = 600, 12, 250
#: A word in a larger share of the sampled paragraphs is ordinary.
ORDINARY_SHARE = 0.01
#: Least threshold of a named family, whatever the calibration says.
LEAST_PROBABILITY = 0.3
#: Share of the paragraph's words that a template must have, and of its word pairs; a template that is
#: in the paragraph as a whole confirms as well.  A word of at most so many families tells them apart.
CONFIRMED, PAIRED, FAMILIES = 0.6, 0.35, 3
#: A word of such a share of the notices is a notice's word, unless it is one of these (fixed values).
NOTICE_WORD = 0.2
STOPS = set("a an and any by for from has in is it its of on or that the this to under use with you your".split())
_NOT_WORD = r"[^\p{L}\p{N}]+"


def _tokens(text: str) -> list[str]:
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def _grams(words: list[str]) -> list[str]:
    return words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


class LicenceModel:
    """Weights of (gram, class), intercepts, temperature and threshold."""

    def __init__(self, negatives: list[str], seed: int = 5):
        rng = random.Random(seed)
        self.classes = sorted(TEMPLATES) + [UNKNOWN]
        unknown, rows = len(self.classes) - 1, []  # rows: (words, class, whether its notice is held out at first)
        notices = [(k, n, text) for k, family in enumerate(sorted(TEMPLATES)) for n, text in enumerate(TEMPLATES[family])]
        for k, n, text in notices + [(unknown, n, text) for n, text in enumerate(OTHER)]:
            words = _tokens(text)
            pieces = [words] + [_tokens(s) for s in re.split(r"(?<=[.;:])\s+", text) if len(_tokens(s)) >= 3]
            for v in range(VARIANTS):
                kept = [w for w in pieces[v % len(pieces)] if v < len(pieces) or rng.random() > 0.15]
                rows.append((kept, k, n % 3 == 2))
        rows += [(_tokens(t), unknown, i % 5 == 4) for i, t in enumerate([*negatives, *ORDINARY * 4])]
        share: dict[str, int] = {}
        for text in negatives:  # the corpus tells what is ordinary, not the sentences written for contrast
            for w in set(_tokens(text)):
                share[w] = share.get(w, 0) + 1
        # A word of many notices is no ordinary word, however often the corpus grants licences.
        spoken = {w for w in share if sum(w in _tokens(text) for _, _, text in notices) < NOTICE_WORD * len(notices)}
        ordinary = {w for w, n in share.items() if n > max(1, ORDINARY_SHARE * len(negatives)) and w in spoken | STOPS}
        self.grams = sorted({g for words, k, _ in rows if k != unknown for g in _grams(words) if any(w not in ordinary for w in g.split(" "))})
        self.cues = sorted({w for g in self.grams for w in g.split(" ") if w not in ordinary})
        at = {g: i for i, g in enumerate(self.grams)}
        x = np.zeros((len(rows), len(self.grams)), dtype=np.float32)
        for r, (words, _, _) in enumerate(rows):
            x[r, [at[g] for g in _grams(words) if g in at]] = 1.0
        y = np.eye(len(self.classes), dtype=np.float32)[[k for _, k, _ in rows]]
        held = np.array([h for _, _, h in rows])
        self._fit(x[~held], y[~held])
        self._calibrate(x[held], y[held])
        self._fit(x, y)

    def _fit(self, x, y, rate=1.0, ridge=2e-4, shrink=2e-5):
        """Proximal gradient with momentum: ridge, and soft thresholds that keep the weights sparse."""
        n, self.weights = len(x), np.zeros((x.shape[1], y.shape[1]), dtype=np.float32)
        self.bias, vw, vb = np.zeros(y.shape[1], dtype=np.float32), 0.0, 0.0
        for _ in range(ROUNDS):
            z = x @ self.weights + self.bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p = (p / p.sum(axis=1, keepdims=True) - y) / n
            vw, vb = 0.9 * vw - rate * (x.T @ p + ridge * self.weights), 0.9 * vb - rate * p.sum(axis=0)
            self.weights, self.bias = self.weights + vw, self.bias + vb
            self.weights = np.sign(self.weights) * np.maximum(np.abs(self.weights) - rate * shrink, 0)
        if self.classes[int(self.bias.argmax())] != UNKNOWN:
            self.bias[-1] = self.bias.max() + 1.0  # no feature: unknown

    def _calibrate(self, x, y):
        z = x @ self.weights + self.bias

        def probabilities(t):
            p = np.exp((z - z.max(axis=1, keepdims=True)) / t)
            return p / p.sum(axis=1, keepdims=True)

        grid = [0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0]
        self.temperature = min(grid, key=lambda t: -np.log(np.maximum((probabilities(t) * y).sum(axis=1), 1e-9)).mean())
        p = probabilities(self.temperature)
        wrong = np.sort(p[:, :-1].max(axis=1)[y[:, -1] == 1])
        # At most a twentieth of unseen notices of other licences, and of ordinary sentences, may pass for a family.
        self.threshold = float(min(0.9, max(LEAST_PROBABILITY, wrong[int(0.95 * len(wrong))] + 0.01))) if len(wrong) else 0.5


def training_negatives(docs: DataFrame, text_col: str, expected: int = UNKNOWN_SAMPLE) -> list[str]:
    """About ``expected`` paragraphs, twice as many at most, one a text, of different texts chosen by hash.

    Copies of a text count once, in the share that is drawn and in the draw.
    """
    hashed = F.xxhash64(F.lit("licence"), F.col(text_col))
    n = docs.where(F.col(text_col).isNotNull()).agg(F.approx_count_distinct(hashed)).first()[0]
    draw = F.pmod(hashed, F.lit(1 << 30)) / F.lit(float(1 << 30))
    lines = F.split(F.col(text_col), r"\n")
    line = F.element_at(lines, (F.pmod(F.xxhash64(F.col(text_col)), F.size(lines)) + 1).cast("int"))
    rows = docs.where(F.col(text_col).isNotNull() & (draw < F.lit(min(1.0, expected / max(n, 1))))).select(hashed.alias("drawn"), line.alias("line"))
    rows = rows.groupBy("drawn").agg(F.min("line").alias("line")).where(~F.lower("line").rlike("licen[cs]|copyright|rights reserved|public domain"))
    return sorted(r["line"] for r in rows.orderBy("drawn").limit(2 * expected).collect())


def template_shapes() -> dict[str, list[tuple[set[str], set[str], set[str]]]]:
    """(words, word pairs, marks) of each template.

    Marks are its words that no other family has; where there is none, those that at most FAMILIES have.
    """
    words_of = {f: [_tokens(t) for t in texts] for f, texts in sorted(TEMPLATES.items())}
    plain = STOPS | {w for t in ORDINARY for w in _tokens(t)}
    spread: dict[str, int] = {}
    for texts in words_of.values():
        for w in set().union(*texts):
            spread[w] = spread.get(w, 0) + 1
    marks = lambda t, most: {w for w in t if spread[w] <= most and len(w) > 1 and not w.isdigit() and w not in plain}
    return {f: [(set(t), set(_grams(t)[len(t) :]), marks(t, 1) or marks(t, FAMILIES)) for t in texts] for f, texts in words_of.items()}


def _sql_text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _NOT_WORD), lambda w: w != "")


def scan_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: LicenceModel | None = None) -> DataFrame:
    """(id, row, paragraph, text, family, probability, similarity): paragraphs with a confirmed licence."""
    spark = docs.sparkSession
    model = model or LicenceModel(training_negatives(docs, text_col))
    cues = F.array(*[F.lit(w) for w in model.cues])
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where(F.arrays_overlap(_words(F.col("text")), cues))
    lines = rows.select("id", F.xxhash64("text").alias("row"), F.posexplode(F.split("text", r"\n")).alias("paragraph", "text"))
    lines = lines.withColumn("words", _words(F.col("text"))).where(F.arrays_overlap("words", cues))
    pairs = F.transform(F.sequence(F.lit(1), F.size("words") - 1), lambda i: F.concat_ws(" ", F.element_at("words", i), F.element_at("words", i + 1)))
    grams = F.array_distinct(F.when(F.size("words") > 1, F.concat("words", pairs)).otherwise(F.col("words")))

    values = ", ".join(
        f"({_sql_text(g)}, array({', '.join(f'{v:.6f}D' for v in w)}))" for g, w in zip(model.grams, model.weights.tolist(), strict=True) if any(w)
    )
    weights = spark.sql(f"SELECT gram, w FROM VALUES {values} AS t(gram, w)")  # one for each gram of the notices
    k = len(model.classes)
    sums = (
        lines.select("id", "row", "paragraph", F.explode(grams).alias("gram"))
        .join(F.broadcast(weights), "gram")
        .groupBy("id", "row", "paragraph", "gram")
        .agg(F.any_value("w").alias("w"))  # repeated rows count once
        .groupBy("id", "row", "paragraph")
        .agg(*[F.sum(F.col("w")[i]).alias(f"z{i}") for i in range(k)])
    )
    logits = F.array(*[(F.round(F.col(f"z{i}"), 4) + F.lit(float(round(model.bias[i], 4)))) / F.lit(model.temperature) for i in range(k)])
    scored = sums.select("id", "row", "paragraph", logits.alias("z")).withColumn("top", F.array_max("z"))
    total = F.aggregate(F.transform("z", lambda v: F.exp(v - F.col("top"))), F.lit(0.0), lambda a, v: a + v)
    names = F.array(*[F.lit(c) for c in model.classes])
    scored = scored.select(
        "id", "row", "paragraph", (1 / total).alias("probability"), F.element_at(names, F.array_position("z", F.col("top")).cast("int")).alias("family")
    ).where((F.col("family") != UNKNOWN) & (F.col("probability") >= model.threshold))

    listed = lambda words: "array(" + ", ".join(_sql_text(w) for w in sorted(words)) + ")" if words else "cast(array() as array<string>)"
    shapes = ", ".join(
        f"({_sql_text(f)}, array({', '.join(f'struct({listed(words)} AS words, {listed(pairs)} AS pairs, {listed(marks)} AS marks)' for words, pairs, marks in own)}))" for f, own in template_shapes().items()
    )
    templates = spark.sql(f"SELECT family, shapes FROM VALUES {shapes} AS t(family, shapes)")
    found = lines.dropDuplicates(["id", "row", "paragraph"]).join(scored, ["id", "row", "paragraph"]).join(F.broadcast(templates), "family")
    found = found.withColumn("own", F.array_distinct("words")).withColumn("own_pairs", F.array_distinct(F.when(F.size("words") > 1, pairs).otherwise(F.array().cast("array<string>"))))

    def likeness(t):
        words, side = F.size(F.array_intersect("own", t["words"])), F.size(F.array_intersect("own_pairs", t["pairs"]))
        told = (F.size(t["marks"]) == 0) | F.arrays_overlap("own", t["marks"])
        whole = (words == F.size(t["words"])) & (side == F.size(t["pairs"]))
        return F.when(told & whole, 1.0).when(told & (side >= PAIRED * F.size("own_pairs")), words / F.size("own")).otherwise(0.0)

    found = found.withColumn("similarity", F.array_max(F.transform("shapes", likeness)))
    return found.where(F.col("similarity") >= CONFIRMED).select("id", "row", "paragraph", "text", "family", "probability", "similarity")


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: LicenceModel | None = None) -> DataFrame:
    """(id, families, n_paragraphs, first_paragraph, probability) for every row; families sorted."""
    found = scan_paragraphs(docs, id_col, text_col, model).groupBy("id", "row").agg(
        F.array_sort(F.collect_set("family")).alias("families"),  # at most one for each class
        F.count(F.lit(1)).alias("n_paragraphs"),
        F.min("paragraph").alias("first_paragraph"),
        F.min("probability").alias("probability"),
    )
    rows = docs.select(F.col(id_col).cast("long").alias("d_id"), F.xxhash64(F.col(text_col)).alias("d_row"))
    same = F.col("d_id").eqNullSafe(F.col("id")) & (F.col("d_row") == F.col("row"))
    return rows.join(found, same, "left").select(
        F.col("d_id").alias("id"),
        F.coalesce("families", F.array().cast("array<string>")).alias("families"),
        F.coalesce("n_paragraphs", F.lit(0)).cast("long").alias("n_paragraphs"),
        "first_paragraph",
        "probability",
    )
