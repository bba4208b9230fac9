"""Licence families of paragraphs by a trained classifier (method 8). Only DataFrame and ML functions of the JVM.

A sparse logistic regression over word unigrams and bigrams tells licence families, other licences, and ordinary
text apart. It is trained on the templates below, alone and among other text, and on a bounded sample of paragraphs
of the corpus that mention no licence. A second such sample calibrates it: a family has to be more probable
than it is for all but a small share of ordinary paragraphs. What is clearly a licence, but of no family
with certainty, is `unknown`.

Related licences share most of their words, so each family has deciding words, such as a version or "Lesser", that must
stand, or must not stand, in the paragraph; families that these exclude are out of the question, and the
probabilities are those of the others. A family is then confirmed by comparison with its templates: enough of the word
bigrams of one of them must stand in the paragraph. Otherwise the paragraph counts as unknown.

Lines are judged one by one, and so are the windows of a paragraph of several lines, up to a blank line, that has a
word of licences: wrapped licences are seen whole. Where a paragraph has a family, its other lines are not unknown.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gleanrank.llm.words import least_by_hash
from gleanrank.session import materialize

NONE, UNKNOWN = "none", "unknown"
# Fixed texts: statements by which works of each family are licensed.
TEMPLATES = {
    "agpl-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "apache-1.1": [
        "Licensed under the Apache Software License, Version 1.1.",
        "SPDX-License-Identifier: Apache-1.1",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd-2-clause": [
        "Released under the BSD 2-Clause License.",
        "Released under the Simplified BSD License.",
        "SPDX-License-Identifier: BSD-2-Clause",
    ],
    "bsd-3-clause": [
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc-by-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "cc-by-nc-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "cc-by-sa-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "cc0-1.0": [
        "This work is dedicated to the public domain under CC0 1.0 Universal.",
        "Released under CC0 1.0.",
        "The texts are in the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "epl-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
        "SPDX-License-Identifier: EPL-2.0",
    ],
    "gpl-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or any later version.",
        "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "SPDX-License-Identifier: GPL-3.0-only",
    ],
    "isc": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "SPDX-License-Identifier: ISC",
    ],
    "lgpl-2.1": [
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or any later version.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ],
    "lgpl-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "SPDX-License-Identifier: LGPL-3.0-only",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    UNKNOWN: [
        "Licensed under the terms of the license agreement.",
        "This work is licensed under its own license.",
        "Released under the Artistic License.",
        "Licensed under the Mozilla Public License, version 1.1.",
        "Distributed under the Eclipse Public License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
        "This program is free software; you can redistribute it under the terms of its license.",
        "All rights reserved. No part of this work may be used without a license from the publisher.",
    ],
}
# Fixed patterns, for a paragraph's words joined by spaces: what must be there for a family, and what must not.
DECIDING = {
    "agpl-3.0": (r"(?:affero|agpl).*\bv?3(?:\.0)?\b", r"\bversion [12]\b"),
    "apache-1.1": (r"apache.*\b1\.1\b", r"\b2\.0\b"),
    "apache-2.0": (r"apache.*\bv?2(?:\.0)?\b", r"\b1\.[01]\b"),
    "bsd-2-clause": (r"\b2-clause|bsd-2|simplified bsd", r"3-clause|4-clause|neither the name|endorse"),
    "bsd-3-clause": (r"\b3-clause|bsd-3|new bsd|modified bsd|neither the name", r"2-clause|4-clause|advertising materials"),
    "cc-by-4.0": (r"(?:\bcc[ -]by\b|attribution|licenses by\b).*4\.0", r"-nc|-sa|-nd|non-?commercial|share-?alike|no-?deriv"),
    "cc-by-nc-4.0": (r"(?:by-nc|non-?commercial).*4\.0", r"-sa\b|-nd\b|share-?alike|no-?deriv"),
    "cc-by-sa-4.0": (r"(?:by-sa|share-?alike).*4\.0", r"-nc\b|-nd\b|non-?commercial|no-?deriv"),
    "cc0-1.0": (r"\bcc0", r"\bby-"),
    "epl-2.0": (r"(?:eclipse public license|epl).*\bv?2(?:\.0)?\b", r"\b1\.0\b"),
    "gpl-2.0": (r"(?:general public license|gpl).*\b(?:version 2|v2|2\.0|2)\b|gplv2|gpl-2", r"lesser|library general|affero|lgpl|agpl|version 3|gplv3|gpl-3|\bv3\b"),
    "gpl-3.0": (r"(?:general public license|gpl).*\b(?:version 3|v3|3\.0|3)\b|gplv3|gpl-3", r"lesser|library general|affero|lgpl|agpl|version 2|gplv2|gpl-2|\bv2\b"),
    "isc": (r"\bisc\b|with or without fee is hereby granted", r"\bmit\b"),
    "lgpl-2.1": (r"(?:lesser general public|lgpl).*2\.1", r"version 3|lgplv3|lgpl-3"),
    "lgpl-3.0": (r"(?:lesser general public|lgpl).*\bv?3(?:\.0)?\b|lgplv3", r"version 2|2\.1|lgplv2"),
    "mit": (r"\bmit\b|granted free of charge to any person", r"with or without fee"),
    "mpl-2.0": (r"(?:mozilla public license|mpl).*\bv?2(?:\.0)?\b", r"\b1\.[01]\b"),
}
#: Words that a paragraph of several lines must have to be looked at as a whole.
CUES = r"(?i)licen[cs]|copyright|redistribut|permission|spdx|\bgpl|\bcc0|creative commons|public domain|endorse"
BEFORE = ["", "Copyright 2020 The Authors. ", "Note: ", "// "]
BEHIND = ["", " All rights reserved.", " See the LICENSE file."]
#: Words of a paragraph that are judged at once; longer ones are cut into windows that overlap by half.
WINDOW = 64
CLASSES = [NONE, *sorted(TEMPLATES)]
_FEATURES = 1 << 15
#: Probability of ordinary text from which no deciding words are looked for.
DOUBT = 0.95


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*"), 0)


def bigrams_of(words: Column) -> Column:
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.concat_ws(" ", a, b))


def _with_terms(rows: DataFrame) -> DataFrame:
    """Adds `terms`, the unigrams and bigrams of the column `words`."""
    return rows.withColumn("bigrams", bigrams_of(F.col("words"))).withColumn("terms", F.concat("words", "bigrams"))


def paragraph_windows(docs: DataFrame, text: str) -> DataFrame:
    """(row, doc_id, paragraph, words): the words of each line of each text, and of each paragraph of several lines that
    has a word of licences; long ones in windows. A row without words where a text has none."""
    # The number of the row is given before its lines are dealt out.
    paragraphs = F.split(F.col(text).cast("string"), r"\r?\n[ \t\r]*\n")
    wrapped = lambda p: F.when((F.instr(p, "\n") > 0) & p.rlike(CUES), F.array(p)).otherwise(F.array().cast("array<string>"))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), paragraphs.alias("paragraphs")).withColumn(
        "row", F.monotonically_increasing_id()
    ).select("row", "doc_id", F.posexplode_outer("paragraphs").alias("paragraph", "whole"))
    base = base.select("row", "doc_id", "paragraph", F.explode_outer(F.concat(F.split("whole", r"\n"), wrapped(F.col("whole")))).alias("line"))
    lines = base.select("row", "doc_id", "paragraph", F.coalesce(words_of(F.col("line")), F.array().cast("array<string>")).alias("all"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("all") - WINDOW // 2 - 1, F.lit(0)), F.lit(WINDOW // 2))
    windows = F.when(F.size("all") <= WINDOW, F.array("all")).otherwise(
        F.transform(starts, lambda s: F.slice(F.col("all"), s + 1, F.lit(WINDOW)))
    )
    return lines.select("row", "doc_id", "paragraph", F.explode(windows).alias("words"))


def _templates(spark: SparkSession) -> DataFrame:
    rows = [(family, text) for family, texts in sorted(TEMPLATES.items()) for text in texts]
    return spark.createDataFrame(rows, "family string, template string")


def train(docs: DataFrame, text: str = "text", sample: int = 10_000, false_share: float = 1e-4) -> tuple[PipelineModel, float, float]:
    """The classifier, and the probabilities from which a family and an unknown licence count.

    `sample` bounds the documents that ordinary paragraphs are taken from (those of least hash of the id), the
    paragraphs used in training, and those used in the calibration: of least hash among lines that hold
    no word of licences, each with at most a window of its words.
    """
    spark = docs.sparkSession
    some = least_by_hash(
        docs.select("doc_id", F.col(text).cast("string").alias("text")), F.xxhash64("doc_id"), sample, docs.count()
    )
    lines = some.select(F.explode(F.split("text", r"\n")).alias("line"))
    plain = lines.filter("line <> ''").filter(~F.lower("line").rlike("licen|copyright|all rights|redistribut"))
    least = plain.select("line", F.xxhash64("line").alias("at")).orderBy("at", "line").limit(2 * sample)
    # Of a long line the window that its hash picks, as lines are judged in windows.
    words = least.select(words_of(F.col("line")).alias("all"), "at")
    first = F.pmod("at", F.greatest(F.size("all") - WINDOW, F.lit(0)) + 1).cast("int") + 1
    drawn = materialize(words.select(F.slice("all", first, F.lit(WINDOW)).alias("words"), "at"), "plain-paragraphs")
    ordinary, held = drawn.filter("at % 2 = 0"), drawn.filter("at % 2 <> 0")
    wrapped = _templates(spark).select(
        F.col("family"), "template", F.explode(F.array(*map(F.lit, BEFORE))).alias("before")
    ).select("family", "template", "before", F.explode(F.array(*map(F.lit, BEHIND))).alias("behind"))
    alone = wrapped.select("family", words_of(F.concat("before", "template", "behind")).alias("words"))
    # Words of twenty ordinary paragraphs, to put the templates between: a window's worth in all.
    around = ordinary.orderBy("at").limit(20).agg(F.collect_list(F.slice("words", 1, 20)).alias("around"))
    among = _templates(spark).crossJoin(F.broadcast(around)).select("family", "template", F.explode("around").alias("around"))
    among = among.select("family", F.slice(F.concat("around", words_of(F.col("template")), "around"), 1, WINDOW).alias("words"))
    label = F.array_position(F.array(*map(F.lit, CLASSES)), F.col("family")) - 1
    rows = alone.union(among).union(ordinary.select(F.lit(NONE).alias("family"), "words"))
    # A bounded sample: few partitions, as each step of the fit is a pass over all of them.
    rows = materialize(
        _with_terms(rows.withColumn("label", label.cast("double"))).select("label", "terms").coalesce(4), "licence-rows"
    ).coalesce(4)
    stages = [
        HashingTF(inputCol="terms", outputCol="counts", numFeatures=_FEATURES, binary=True),
        Normalizer(inputCol="counts", outputCol="features"),
        LogisticRegression(maxIter=60, regParam=1e-4, family="multinomial"),
    ]
    model = Pipeline(stages=stages).fit(rows)
    told = _judged(held, model).agg(
        F.max("best_p").alias("family"), F.count("best").alias("families"), F.max("unknown_p").alias("licence"),
        F.count_if(F.col("unknown_p") > 0.5).alias("licences"), F.count("*").alias("total"),
    ).first()

    def level(highest: float | None, number: int) -> float:
        # With fewer false ones than the share allows, an even chance is enough.
        return min(max(float(highest), 0.5), 0.99) if number > false_share * told["total"] else 0.5

    return model, level(told["family"], told["families"]), level(told["licence"], told["licences"])


def _judged(rows: DataFrame, model: PipelineModel) -> DataFrame:
    """Adds the most probable family that the deciding words allow, its probability, and that of ordinary text.

    `best_p` is the family's share among allowed families and other licences; `unknown_p` is what is not ordinary. Without an
    allowed family, and in text that is ordinary beyond doubt, `best` is null.
    """
    scored = model.transform(_with_terms(rows)).withColumn("p", vector_to_array("probability"))
    # Deciding words are looked for only where the text may be a licence.
    scored = scored.withColumn("maybe", F.element_at("p", 1) < DOUBT).withColumn("joined", F.when(F.col("maybe"), F.array_join("words", " ")))
    allowed = [
        F.struct(F.element_at("p", CLASSES.index(f) + 1).alias("p"), F.lit(f).alias("family"), (F.col("joined").rlike(must) & ~F.col("joined").rlike(barred)).alias("ok"))
        for f, (must, barred) in DECIDING.items()
    ]
    fits = F.filter(F.array(*allowed), lambda a: a["ok"])
    scored = scored.withColumn("fits", F.when(F.col("maybe"), fits)).withColumn("top", F.array_max("fits"))
    total = F.aggregate("fits", F.element_at("p", CLASSES.index(UNKNOWN) + 1), lambda s, a: s + a["p"])
    return (
        scored.withColumn("best", F.col("top.family")).withColumn("best_p", F.col("top.p") / total)
        .withColumn("unknown_p", 1 - F.element_at("p", 1))
        .drop("p", "probability", "rawPrediction", "prediction", "counts", "features", "fits", "top", "joined", "maybe")
    )


def scan_licences(docs: DataFrame, text: str = "text", sample: int = 10_000, confirm: float = 0.6) -> DataFrame:
    """(doc_id, licence, families, n_paragraphs, probability) for every row of `docs`.

    `licence` is `none`, the one family found, `unknown`, or `several`; `families` lists all, sorted and joined by
    commas (unknown included); `n_paragraphs` counts the windows that hold a licence, `probability` is the highest of
    a family or unknown licence in the document.

    Defined cases: null and empty texts have no licence; rows that share a doc_id, and rows with a null one,
    are judged each for itself; repeated rows alike; an empty table gives an empty result. Other columns are
    ignored.
    """
    spark = docs.sparkSession
    model, level, unknown_level = train(docs, text, sample)
    judged = _judged(paragraph_windows(docs, text), model)
    # A few rows for each family, fixed above.
    known = _templates(spark).select("family", bigrams_of(words_of(F.col("template"))).alias("wanted"))
    known = known.groupBy("family").agg(F.collect_list("wanted").alias("wanted"))
    judged = judged.join(F.broadcast(known), F.col("best") == F.col("family"), "left")
    # Templates of one word (identifiers) have no bigram; those of two words or more do.
    share = F.array_max(F.transform("wanted", lambda w: F.size(F.array_intersect(w, F.col("bigrams"))) / F.greatest(F.size(w), F.lit(1))))
    sure = F.coalesce((F.col("best_p") >= level) & (share >= confirm), F.lit(False))
    # A confirmed family is one even where the classifier finds ordinary text a little more probable.
    likely = (F.size("words") > 0) & (sure | (F.col("unknown_p") > unknown_level))
    family = F.when(likely, F.when(sure, F.col("best")).otherwise(UNKNOWN))
    told = F.when(likely, F.struct("paragraph", family.alias("family")))
    p = F.when(likely, F.coalesce("best_p", "unknown_p"))
    found = judged.select("row", "doc_id", told.alias("told"), p.alias("p")).groupBy("row", "doc_id").agg(
        F.collect_set("told").alias("told"), F.count("told").alias("n_paragraphs"), F.coalesce(F.max("p"), F.lit(0.0)).alias("probability")
    )
    # What is unknown beside a family in the same paragraph is a part of that licence.
    beside = lambda t: F.exists("told", lambda o: (o["paragraph"] == t["paragraph"]) & (o["family"] != UNKNOWN))
    kept = F.filter("told", lambda t: (t["family"] != UNKNOWN) | ~beside(t))
    found = found.withColumn("all", F.array_sort(F.array_distinct(F.transform(kept, lambda t: t["family"]))))
    return found.select(
        "doc_id",
        F.when(F.size("all") == 0, NONE).when(F.size("all") == 1, F.col("all")[0]).otherwise("several").alias("licence"),
        F.array_join("all", ",").alias("families"), "n_paragraphs", "probability",
    )
