"""License scan: a trained paragraph classifier with template comparison.

Lines with a cue stem are candidates; where a cue runs over a line end, the line that it begins on is one. A candidate that
isn't confirmed by itself is read together with its neighbours: all stretches of up to ``WRAPPED`` lines around it that no
blank line interrupts and that cover a template, so notices may be wrapped. Of them the most probable confirmed one counts. Their word 1- to 3-grams, hashed to ``FEATURES`` numbers, go into a
multinomial logistic regression over licence families and an unknown class, trained on the templates' sentences and on
all distinct candidates of the corpus: paragraphs that contain a template are of its family, all others are unknown. Lines
without a cue are never classified, so they are not trained on. A quarter of the candidates, by hash, is kept from training
and sets the probability from which on a family is believed: above what ``1 - MISTAKES`` of its unknown paragraphs get,
counted in steps of ``1 / STEPS``, and ``LEAST`` at any rate. A believed family counts as
confirmed if the family's nearest template covers it: the best shared share of words reaches ``COVER``.

Both training and scan are DataFrame work; the model is compiled into the scan as arrays of numbers, so the scan is a
single projection without a shuffle.

Cases: null, empty and blank texts have no paragraphs and an empty list; very long texts are scanned whole; repeated
rows give equal rows; a family that occurs several times is listed once; ties between families go to the first in
order; an empty table gives an empty result. Columns other than id and text are not read.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import discard, settle

FEATURES = 512
MISTAKES = 0.002
#: Steps in which probabilities are counted for the threshold; a fixed number that the driver gets.
STEPS = 10000
LEAST = 0.5
COVER = 0.8
WRAPPED = 5
#: Characters of a neighbouring line that can belong to a template; the longest has about 150.
_REACH = 400

#: Sentences by which licences are named in texts.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "You may not use this file except in compliance with the License.",
        "Distributed under the Apache Software License.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Use of this source code is governed by a BSD-style license.",
        "Released under the BSD License.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License.",
        "Licensed under the GPL, version 2 or later.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
        "Licensed under the MIT License.",
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright, all rights reserved. No part of this publication may be reproduced without permission.",
    ],
}
#: Stems without which a paragraph names no licence.
CUES = r"licen[sc]|copyright|rights reserved|redistribut|permission is hereby|\bgpl\b|\bbsd\b|creative commons|\bcc by\b|public domain|spdx"
FAMILIES = sorted(TEMPLATES)


def normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " "))


def _grams(norm: str) -> str:
    """Hashed 1- to 3-grams of a normalised paragraph, as SQL; each gram once."""
    return (
        f"array_distinct(flatten(transform(sequence(1, 3), n -> transform(sequence(0, greatest(size(split({norm}, ' ')) - n, 0)), "
        f"i -> cast(pmod(xxhash64(array_join(slice(split({norm}, ' '), i + 1, n), ' ')), {FEATURES}) AS int)))))"
    )


def _contains(norm: Column, sentences: list[str]) -> Column:
    found = F.lit(False)
    for s in sentences:
        found = found | F.concat(F.lit(" "), norm, F.lit(" ")).contains(f" {_plain(s)} ")
    return found


def _plain(sentence: str) -> str:
    return " ".join("".join(c if c.isalnum() else " " for c in sentence.lower()).split())


def _cued(text: str) -> tuple[Column, Column]:
    """All lines of a text, and the places of its candidates."""
    cues = CUES.replace(chr(92), chr(92) * 2)
    # A cue over a line end lies within the last and the first characters of the two lines.
    spans = f"lower(concat(right(all[i], 40), ' ', left(all[i + 1], 40))) rlike '{cues}' AND NOT lower(all[i + 1]) rlike '{cues}'"
    cued = f"lower(all[i]) rlike '{cues}' OR (i + 1 < size(all) AND {spans})"
    lines = F.coalesce(F.expr(f"split(cast({text} AS string), '\\n', -1)"), F.array().cast("array<string>"))
    return lines, F.expr(f"CASE WHEN size(all) = 0 THEN cast(array() AS array<int>) ELSE filter(sequence(0, size(all) - 1), i -> {cued}) END")


def candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The distinct normalised paragraphs with a cue, and how often they occur."""
    lines, at = _cued(text_col)
    found = docs.select(lines.alias("all")).withColumn("at", at).select(F.explode(F.expr("transform(at, i -> all[i])")).alias("line"))
    return found.select(normalised(F.col("line")).alias("norm")).groupBy("norm").agg(F.count("norm").alias("n"))


class Model:
    """Weights per gram and class, biases, and the probability from which on a family is believed."""

    def __init__(self, weights: np.ndarray, biases: np.ndarray, least: float):
        self.weights, self.biases, self.least = weights, biases, least  # class 0 is unknown

    def scored(self, norm: str) -> str:
        """SQL for an array of class probabilities of a normalised paragraph."""
        # Text that the optimizer folds into one constant; thousands of literals would slow every plan.
        rows = "from_json('" + json.dumps([[float(f"{w:.6g}") for w in row] for row in self.weights]) + "', 'array<array<double>>')"
        bias = "from_json('" + json.dumps([float(f"{b:.6g}") for b in self.biases]) + "', 'array<double>')"
        logits = f"transform(array({_grams(norm)}), gs -> zip_with({rows}, {bias}, (w, b) -> b + aggregate(gs, 0D, (s, g) -> s + w[g])))"
        return f"transform({logits}, l -> transform(l, x -> exp(x - array_max(l)) / aggregate(l, 0D, (s, y) -> s + exp(y - array_max(l)))))[0]"


def fit(docs: DataFrame) -> Model:
    """Train on the templates and on all distinct candidates of the corpus."""
    spark = docs.sparkSession
    own = [(_plain(s), k + 1, 0) for k, family in enumerate(FAMILIES) for s in TEMPLATES[family]]
    # Texts that cue words alone don't make licences; they keep the unknown class from being empty.
    own += [(x, 0, 0) for x in ("the driver held a fishing licence", "he was licensed to drive", "they discuss copyright at school", "licence", "license", "permission", "the rights of man", "reserved seats")]
    label = F.lit(0)
    norm = F.col("norm")
    for k in reversed(range(len(FAMILIES))):
        label = F.when(_contains(norm, TEMPLATES[FAMILIES[k]]), k + 1).otherwise(label)
    held = F.when(F.pmod(F.xxhash64("norm", F.lit(4)), F.lit(4)) == 0, 1).otherwise(0)
    sample = candidates(docs).select("norm", label.alias("label"), held.alias("held"))
    sample = sample.union(spark.createDataFrame(own, "norm string, label int, held int"))
    # Sorted, so that sums over rows come out alike in reruns.
    sample = settle(sample.sortWithinPartitions("norm", "held"), "license-candidates")
    # The number of a gram is the word that stands for it: vectors are sparse.
    numbers = CountVectorizerModel.from_vocabulary([str(k) for k in range(FEATURES)], inputCol="grams", outputCol="features", binary=True)
    seen = sample.filter("held = 0").select(F.col("label").cast("double").alias("label"), F.expr(f"cast({_grams('norm')} AS array<string>)").alias("grams"))
    trained = LogisticRegression(family="multinomial", regParam=0.002, maxIter=30, standardization=False).fit(numbers.transform(seen).select("label", "features"))
    model = Model(trained.coefficientMatrix.toArray(), trained.interceptVector.toArray(), LEAST)
    unknown = sample.filter("held = 1 AND label = 0").withColumn("p", F.expr(model.scored("norm"))).select(F.expr("array_max(slice(p, 2, size(p) - 1))").alias("p"))
    model.least = min(0.95, max(LEAST, _exceeded(unknown)))
    discard(sample)
    return model


def _exceeded(unknown: DataFrame) -> float:
    """The least step that at most ``MISTAKES`` of all probabilities ``p`` exceed; 0 if there are none."""
    counts = unknown.groupBy(F.least(F.ceil(F.col("p") * STEPS), F.lit(STEPS)).alias("step")).agg(F.count("*").alias("n"))
    many = np.zeros(STEPS + 1, np.int64)
    for row in counts.collect():
        many[row["step"]] = row["n"]
    above = many.sum() - np.cumsum(many)
    return int(np.argmax(above <= MISTAKES * many.sum())) / STEPS


def _cover(norm: str, family: str) -> str:
    """SQL for the best share of a template's words that a paragraph has, for the family's templates."""
    cases = []
    for k, name in enumerate(FAMILIES):
        shares = ", ".join(f"size(array_intersect(split({norm}, ' '), split('{_plain(s)}', ' '))) / {len(set(_plain(s).split()))}D" for s in TEMPLATES[name])
        cases.append(f"WHEN {family} = {k + 1} THEN array_max(array({shares}))")
    return f"(CASE {' '.join(cases)} ELSE 0D END)"


def _covers_any(norm: str) -> str:
    """SQL for whether a text covers a template of any family."""
    return " OR ".join(f"size(array_intersect(split({norm}, ' '), split('{_plain(s)}', ' '))) >= {COVER * len(set(_plain(s).split()))}D" for family in FAMILIES for s in TEMPLATES[family])


def scan_licenses(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, candidate paragraphs, those of a believed and of a confirmed family, and the confirmed families."""
    model = model or fit(docs)
    names = "array('unknown', " + ", ".join(f"'{f}'" for f in FAMILIES) + ")"
    lines, at = _cued(text_col)
    df = docs.select(F.col(id_col).alias("doc_id"), lines.alias("all")).withColumn("at", at)
    part = f"CASE WHEN j < i THEN right(all[j], {_REACH}) WHEN j > i THEN left(all[j], {_REACH}) ELSE all[j] END"
    around = [(a, b) for a in range(WRAPPED) for b in range(WRAPPED - a) if a + b]
    stretches = ", ".join(
        f"CASE WHEN i >= {a} AND i + {b} < size(all) AND forall(slice(all, i - {a} + 1, {a + b + 1}), l -> l rlike '[^[:space:]]') "
        f"THEN array_join(transform(sequence(i - {a}, i + {b}), j -> {part}), ' ') END".replace("[^[:space:]]", chr(92) * 2 + "S")
        for a, b in around
    )
    df = df.withColumn("lines", F.expr("transform(at, i -> all[i])")).withColumn("norms", F.transform("lines", normalised))
    df = df.withColumn("scored", F.expr(f"transform(norms, x -> named_struct('x', x, 'p', {model.scored('x')}))"))
    best = f"named_struct('x', s.x, 'p', array_max(s.p), 'c', CASE WHEN array_max(s.p) >= {model.least!r}D THEN array_position(s.p, array_max(s.p)) - 1 ELSE 0 END)"
    df = df.withColumn("own", F.expr(f"transform(scored, s -> {best})"))
    df = df.withColumn("own", F.expr(f"transform(own, (b, k) -> named_struct('b', b, 'i', CASE WHEN b.c > 0 AND {_cover('b.x', 'b.c')} >= {COVER}D THEN NULL ELSE at[k] END))"))
    df = df.withColumn("wide", F.expr(f"transform(own, o -> CASE WHEN o.i IS NULL THEN cast(array() AS array<string>) ELSE transform(array(o.i), i -> array_compact(array({stretches})))[0] END)"))
    df = df.withColumn("wide", F.transform("wide", lambda ws: F.transform(ws, normalised)))
    df = df.withColumn("wide", F.expr(f"transform(wide, ws -> filter(ws, x -> {_covers_any('x')}))"))
    df = df.withColumn("wide", F.expr(f"transform(wide, ws -> transform(ws, x -> named_struct('x', x, 'p', {model.scored('x')})))"))
    df = df.withColumn("wide", F.expr(f"transform(wide, ws -> transform(ws, s -> {best}))"))
    df = df.withColumn("wide", F.expr(f"transform(wide, ws -> filter(ws, b -> b.c > 0 AND {_cover('b.x', 'b.c')} >= {COVER}D))"))
    top = "array_max(transform(ws, b -> named_struct('p', b.p, 'b', b))).b"
    df = df.withColumn("best", F.expr(f"zip_with(own, wide, (o, ws) -> CASE WHEN size(ws) > 0 THEN {top} ELSE o.b END)"))
    df = df.withColumn("believed", F.expr("filter(best, b -> b.c > 0)"))
    df = df.withColumn("confirmed", F.expr(f"filter(believed, b -> {_cover('b.x', 'b.c')} >= {COVER}D)"))
    return df.select(
        "doc_id", F.size("lines").cast("long").alias("n_candidates"), F.size("believed").cast("long").alias("n_believed"), F.size("confirmed").cast("long").alias("n_confirmed"),
        F.expr(f"array_join(sort_array(array_distinct(transform(confirmed, b -> {names}[int(b.c)]))), ',')").alias("licenses"),
        F.expr("coalesce(array_max(transform(confirmed, b -> b.p)), 0D)").alias("probability"),
    )
