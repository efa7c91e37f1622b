"""Licence scan: a trained classifier of paragraphs, confirmed by comparison with templates.

Paragraphs are the lines of a text. Their word n-grams feed a multinomial logistic regression with an
L1 penalty, so only a few n-grams keep a weight; those form a small table, and scanning a corpus is a
join with it. A paragraph without any weighted n-gram is unknown and costs only the tokenising.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.session import materialize

UNKNOWN = "unknown"

# The usual short notices of licence families.
TEMPLATES = (
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("apache", "This software is released under the Apache License 2.0."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("bsd", "Released under the BSD 3-Clause License."),
    ("bsd", "Licensed under the BSD 2-Clause License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0 Universal."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation."),
    ("gpl", "Released under the GNU General Public License version 2."),
    ("lgpl", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("lgpl", "Released under the GNU Lesser General Public License version 3."),
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("mpl", "Licensed under the Mozilla Public License, Version 2.0."),
    ("proprietary", "All rights reserved."),
    ("proprietary", "Copyright, all rights reserved. No part of this publication may be reproduced without the prior written permission of the publisher."),
)

# Sentences with words of licences that grant nothing.
OTHERS = (
    "You need a driving license to rent this car.",
    "The work is done and the version is new.",
    "The public library is open to any person free of charge.",
    "This general view of the law was published by the foundation.",
    "The author has written a new source of income in the publication.",
    "Copyright is a subject that students of law can use.",
    "Conditions of use are under review by the commons.",
    "The file was released under pressure from the public.",
    "Please read the terms and conditions before you use this website.",
    "The license plate of the car was covered with mud.",
)

# Words around a notice, for training.
FRAMES = (
    ("the following text was given with this file", "and so on"),
    ("see below", "for more read on"),
    ("note", "end of note"),
    ("by the way", "thank you"),
)

# Words that make no n-gram by themselves.
COMMON = ("a", "an", "and", "any", "are", "as", "at", "be", "by", "for", "from", "has", "in", "is",
          "it", "may", "not", "of", "on", "or", "that", "the", "this", "to", "under", "was", "were",
          "which", "with", "you")


class Model(NamedTuple):
    """``weights``: (gram, w: an array with a weight for each family); both lists are bounded by
    the training notices."""

    weights: DataFrame
    intercept: list[float]
    families: list[str]
    cues: list[str]
    threshold: float


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits; a dot, plus or hyphen inside stays."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+(?:[.+-][\p{L}\p{N}]+)*"), F.lit(0))


def ngrams(words: Column, longest: int = 3) -> Column:
    """Distinct n-grams that hold at least one word outside ``COMMON``."""
    def pieces(n: int) -> Column:
        def piece(w: Column, i: Column) -> Column:
            more = [F.get(words, i + k) for k in range(1, n)]
            content = ~w.isin(*COMMON) | ~more[-1].isin(*COMMON)
            return F.when(content, F.concat_ws(" ", w, *more))

        starts = F.slice(words, 1, F.greatest(F.size(words) - (n - 1), F.lit(0)))
        return F.array_compact(F.transform(starts, piece))

    parts = [F.filter(words, lambda w: ~w.isin(*COMMON)), *map(pieces, range(2, longest + 1))]
    return F.array_distinct(F.concat(*parts))


def paragraphs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, paragraph: its number from 0, words) of the lines of each text; null has none."""
    lines = docs.select(F.col(key), F.posexplode(F.split(text, "\n")).alias("paragraph", "line"))
    return lines.select(key, "paragraph", tokens(F.col("line")).alias("words"))


def training_rows(spark: SparkSession) -> DataFrame:
    """(family, words): every notice whole, with each run of three words left out, and inside other
    words; and as the unknown class every other sentence."""
    rows = spark.createDataFrame(
        [*TEMPLATES, *((UNKNOWN, s) for s in OTHERS)], "family string, text string")
    rows = rows.select("family", tokens(F.col("text")).alias("words"))
    size = F.size("words")
    cut = rows.where(size > 5).select("family", F.explode(F.sequence(F.lit(1), size - 2)).alias("i"), "words")
    cut = cut.select("family", F.concat(
        F.slice("words", 1, F.col("i") - 1), F.slice("words", F.col("i") + 3, F.size("words"))).alias("words"))
    framed = rows.where(F.col("family") != UNKNOWN).select("family", F.explode(F.array(*[
        F.concat(F.split(F.lit(before), " "), "words", F.split(F.lit(after), " "))
        for before, after in FRAMES])).alias("words"))
    return rows.union(cut).union(framed)


def train(spark: SparkSession, penalty: float = 0.0005, negatives: DataFrame | None = None,
          max_negatives: int = 500) -> Model:
    """Fit the classifier and its threshold.

    ``negatives``: paragraphs (words) of a corpus, nearly all of them without a licence; the
    ``max_negatives`` of lowest hash join the unknown class. The threshold is the highest licence
    probability that an unknown training row reaches, and one half at least.
    """
    rows = training_rows(spark)
    if negatives is not None:
        rows = rows.union(negatives.select(F.lit(UNKNOWN).alias("family"), "words")
                          .orderBy(F.xxhash64("words"), "words").limit(max_negatives))
    families = sorted({f for f, _ in TEMPLATES})
    names = [UNKNOWN, *families]
    index = F.array_position(F.lit(names), F.col("family")) - 1
    # A few hundred rows: one partition, so that each step of the solver is one task.
    rows = materialize(rows.coalesce(1).select(index.cast("double").alias("label"),
                                   ngrams(F.col("words")).alias("grams")), "licence-training")
    # The n-grams of notices are the vocabulary; other texts teach how little one of them says.
    vector = CountVectorizer(inputCol="grams", outputCol="features", binary=True, minDF=2,
                             vocabSize=50_000).fit(rows.where("label > 0"))
    ready = vector.transform(rows)
    fitted = LogisticRegression(family="multinomial", regParam=penalty, elasticNetParam=1.0,
                                maxIter=60, standardization=False).fit(ready)
    matrix = fitted.coefficientMatrix.toArray()
    weights = [(gram, [float(x) for x in matrix[:, i]])
               for i, gram in enumerate(vector.vocabulary) if abs(matrix[:, i]).max() > 1e-6]
    unsure = fitted.transform(ready).where("label = 0").agg(
        F.max(1 - F.get(vector_to_array("probability"), 0))).first()[0]
    cues = sorted({next(w for w in (g.split(" ")[0], g.split(" ")[-1]) if w not in COMMON)
                   for g, _ in weights})
    return Model(spark.createDataFrame(weights, "gram string, w array<double>"),
                 [float(x) for x in fitted.interceptVector], names, cues,
                 max(0.5, float(unsure or 0)))


def word_pairs(text: str) -> list[str]:
    """Distinct pairs of neighbouring words of a template, which is plain ASCII."""
    words = re.findall(r"[a-z0-9]+(?:[.+-][a-z0-9]+)*", text.lower())
    return sorted(set(map(" ".join, zip(words, words[1:], strict=False))))


def template_hits(words: Column) -> Column:
    """The word pairs of a paragraph that some template has."""
    pairs = F.transform(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))),
                        lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1)))
    every = sorted({p for _, text in TEMPLATES for p in word_pairs(text)})
    return F.array_intersect(pairs, F.lit(every).cast("array<string>"))


def similarity(hits: Column, family: str) -> Column:
    """The largest share of the word pairs of one of the family's templates among ``hits``."""
    shares = [F.size(F.array_intersect(hits, F.lit(own).cast("array<string>"))) / len(own)
              for own in (word_pairs(text) for name, text in TEMPLATES if name == family)]
    return F.greatest(*shares) if len(shares) > 1 else shares[0]


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", model: Model | None = None,
         least_similarity: float = 0.6) -> DataFrame:
    """A row for every paragraph that the classifier takes for a licence notice:
    (key, paragraph, family, probability, similarity, confirmed).

    ``similarity`` is the largest share of a template of that family found in the paragraph;
    ``confirmed`` needs ``least_similarity``. Null and empty texts give no row, nor does an empty
    table; repeated rows give repeated results. Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    if model is None:
        model = train(spark, negatives=paragraphs(docs, key, text).where(
            (F.size("words") > 3) & ~F.exists("words", lambda w: w.like("%licen%"))
            & (F.col("paragraph") == 1)))
    base = model.intercept
    rows = paragraphs(docs, key, text).where(
        F.arrays_overlap("words", F.lit(model.cues).cast("array<string>")))
    # All n-grams of a row are exploded in the task that made it; the sums are combined there. A row
    # carries its similarities and not its words, which may be many.
    rows = rows.select(key, "paragraph", "words", F.monotonically_increasing_id().alias("n"),
                       template_hits(F.col("words")).alias("pairs"))
    rows = rows.withColumn("similarities", F.array(*[similarity(F.col("pairs"), f) for f in model.families[1:]]))
    hits = rows.select(F.struct(key, "paragraph", "n", "similarities").alias("row"),
                       F.explode(ngrams(F.col("words"))).alias("gram")).join(F.broadcast(model.weights), "gram")
    summed = hits.groupBy("row").agg(*[
        (F.sum(F.get("w", i)) + base[i]).alias(f"z{i}") for i in range(len(base))])
    scores = [F.col(f"z{i}") for i in range(len(base))]
    most = F.greatest(*scores)
    total = sum((F.exp(z - most) for z in scores), F.lit(0.0))
    best = F.greatest(*[F.struct(z.alias("z"), F.lit(i).alias("at")) for i, z in enumerate(scores[1:])])
    found = summed.select("row", best.alias("best"), (F.exp(best["z"] - most) / total).alias("probability"),
                          (1 - F.exp(scores[0] - most) / total).alias("licensed"))
    names = F.lit(model.families[1:]).cast("array<string>")
    return (found.where(F.col("licensed") > model.threshold)
            .select(F.col("row")[key].alias(key), F.col("row.paragraph").alias("paragraph"),
                    F.get(names, F.col("best.at")).alias("family"), "probability",
                    F.get(F.col("row.similarities"), F.col("best.at")).alias("similarity"))
            .withColumn("confirmed", F.col("similarity") >= least_similarity))
