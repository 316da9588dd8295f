"""Licence scans: a sparse n-gram classifier of paragraphs, confirmed by comparison with templates, in DataFrame operations only."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

UNKNOWN = "unknown"
#: Customary wordings of licence notices by family.
TEMPLATES = {
    "agpl": ["This program is licensed under the GNU Affero General Public License, version 3.", "GNU Affero General Public License as published by the Free Software Foundation, AGPL-3.0"],
    "all-rights-reserved": ["All rights reserved.", "Copyright. All rights reserved. No part of this publication may be reproduced without prior written permission."],
    "apache": ["Licensed under the Apache License, Version 2.0.", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.', "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "bsd": ["Released under the BSD License.", "Licensed under the BSD 3-Clause License.", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc0": ["Released under CC0 1.0 Universal.", "To the extent possible under law, the author has waived all copyright and related rights. Public domain dedication."],
    "gpl": ["This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", "Licensed under the GPL, version 2 or later."],
    "lgpl": ["Licensed under the GNU Lesser General Public License, version 2.1.", "GNU Lesser General Public License as published by the Free Software Foundation, LGPL-3.0"],
    "mit": ["Released under the MIT License.", "Licensed under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, version 2.0."],
}
#: Sentences with words of licences that grant nothing.
OTHERS = ["The version of the story is under review.", "He was granted permission to leave.", "A driver needs a licence to use the public road.", "The work of the author is free.", "All rights and wrongs of the general public.", "The software was released in the following year.", "This source is public.", "Terms and conditions of the international agreement.", "Apache and Mozilla are software foundations.", "He took a commercial flight to the university.", "The law is required by the people.", "A copy of the file was distributed."]

#: Sample of negatives: rows of docs, characters of an excerpt of each (at a place its id chooses), lines taken from it and words of a line.
SAMPLE_ROWS, SAMPLE_CHARS, SAMPLE_LINES, SAMPLE_WORDS = 200, 8_192, 10, 60
#: Lines that a window over wrapped lines has, and what parts paragraphs and sentences.
WRAP, PARAGRAPHS, SENTENCES = 4, r"\n[ \t\r]*\n\s*", r"(?<=[.;])\s+"
#: Lasso weight and steps; probability and template agreement that a licence needs.
LASSO, STEPS, LEAST, AGREE = 2e-4, 500, 0.5, 0.5
#: Bytes of vocabulary that are broadcast at most; it comes from TEMPLATES alone.
BETWEEN = r"[^\p{L}\p{N}]+"


def tokens(text: str) -> list[str]:
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def ngrams(words: list[str]) -> list[str]:
    return words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


class LicenceModel:
    """Weights [n-gram, class] with their classes (the last is UNKNOWN), biases, a temperature, and template n-gram counts."""

    def __init__(self, vocabulary: list[str], classes: list[str], weights: np.ndarray, bias: np.ndarray, temperature: float):
        self.vocabulary, self.classes, self.weights, self.bias, self.temperature = vocabulary, classes, weights, bias, temperature


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _examples(rng: np.random.Generator, filler: list[str]) -> tuple[list[list[str]], list[int]]:
    """Whole templates, runs of most of their words, and templates within other words; and runs of few common words as unknown."""
    rows, y = [], []
    for k, family in enumerate(TEMPLATES):
        for t in TEMPLATES[family]:
            w = tokens(t)
            for i in range(24):
                n = len(w) if i % 3 == 0 else max(2, int(len(w) * rng.uniform(0.6, 1)))
                s = int(rng.integers(0, len(w) - n + 1))
                around = list(rng.choice(filler, int(rng.integers(0, 8)))) if i % 2 else []
                cut = int(rng.integers(0, len(around) + 1))
                rows.append(around[:cut] + w[s : s + n] + around[cut:])
                y.append(k)
    return rows, y


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS, sample_lines: int = SAMPLE_LINES, sample_words: int = SAMPLE_WORDS, seed: int = 5) -> LicenceModel:
    """A model fitted on the driver to the templates and, as unknown, to lines of at most sample_rows documents.

    Of each sampled document an excerpt of sample_chars characters is read, of that at most sample_lines lines, of a line at most sample_words words. Lines
    that share over half their n-grams with a template aren't used. The unknown class is calibrated on a third of the examples: a
    temperature and a shift of its score are chosen by likelihood.
    """
    rng, families = np.random.default_rng(seed), list(TEMPLATES)
    known = docs.filter("text is not null and doc_id is not null")
    # rows are chosen by their ids alone, so tasks send no text that isn't used
    picked = known.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    start = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.greatest(F.length("text") - sample_chars, F.lit(0)) + 1).cast("int") + 1
    rows = sorted(known.join(F.broadcast(picked), "doc_id").select("doc_id", F.substring("text", start, F.lit(sample_chars)).alias("text")).collect(), key=lambda r: (r.doc_id, r.text))
    wordings = [set(ngrams(tokens(t))) for ts in TEMPLATES.values() for t in ts]
    plain = [tokens(x) for x in OTHERS]
    for r in rows:
        lines = [w for w in map(tokens, r.text.split("\n")) if w]
        for i in rng.permutation(len(lines))[:sample_lines]:
            g = set(ngrams(lines[i]))
            if not any(len(g & t) > 0.5 * min(len(g), len(t)) for t in wordings):
                plain.append(lines[i][:sample_words])
    filler = sorted({w for p in plain for w in p})
    often = Counter(w for p in plain for w in set(p))
    vocabulary = sorted({g for t in wordings for g in t if " " in g or often[g] <= max(1, len(plain) // 100)})
    at = {g: k for k, g in enumerate(vocabulary)}
    texts, y = _examples(rng, filler)
    texts, y = texts + plain, np.array(y + [len(families)] * len(plain))
    x = np.zeros((len(texts), len(vocabulary)), np.float32)
    for i, t in enumerate(texts):
        x[i, [at[g] for g in set(ngrams(t)) if g in at]] = 1
    held = np.arange(len(y)) % 3 == 0
    one = np.eye(len(families) + 1, dtype=np.float32)[y]
    a, o = x[~held], one[~held]
    w, b = np.zeros((x.shape[1], o.shape[1]), np.float32), np.zeros(o.shape[1], np.float32)
    rate = 2 / max(1e-9, float(np.linalg.norm(a / np.sqrt(len(a)), 2)) ** 2)
    z, t = w.copy(), 1.0
    for _ in range(STEPS):  # accelerated proximal gradient
        d = (_softmax(a @ z + b) - o) / len(a)
        new = z - rate * (a.T @ d)
        new = np.sign(new) * np.maximum(np.abs(new) - rate * LASSO, 0)
        b = b - d.sum(axis=0)
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        z, w = new + np.float32((before - 1) / t) * (new - w), new
    logits, best = x[held] @ w + b, (np.inf, 1.0, 0.0)
    for temperature in (0.25, 0.4, 0.6, 0.8, 1.0, 1.25):
        for shift in np.linspace(-3, 3, 13):
            p = _softmax((logits + np.r_[np.zeros(len(families)), shift]) / temperature)
            loss = -np.log(np.maximum((p * one[held]).sum(axis=1), 1e-12)).mean()
            best = min(best, (loss, temperature, float(shift)))
    b[-1] += best[2]
    return LicenceModel(vocabulary, [*families, UNKNOWN], w.astype(float), b.astype(float), best[1])


def _vocabulary(spark: SparkSession, model: LicenceModel) -> DataFrame:
    """(h, w, t): a row for each n-gram's hash with its weights by class and the templates it is in, by number."""
    wordings = [set(ngrams(tokens(t))) for ts in TEMPLATES.values() for t in ts]
    rows = [(*(g.split(" ") if " " in g else (g, None)), [float(v) for v in model.weights[k]], [i for i, t in enumerate(wordings) if g in t]) for k, g in enumerate(model.vocabulary)]
    return spark.createDataFrame(rows, "a string, b string, w array<double>, t array<int>").select(_hash(F.col("a"), F.col("b")).alias("h"), "w", "t")


def _hash(a: Column, b: Column) -> Column:
    """Of a word, or of two in a row; a null second word is no word."""
    return F.when(b.isNull(), F.xxhash64(a)).otherwise(F.xxhash64(a, b, F.lit(2)))


def _rare(model: LicenceModel) -> list[str] | None:
    """Single words of the vocabulary, if no template can be agreed with by n-grams that have none of them."""
    rare = {g for g in model.vocabulary if " " not in g}
    for ts in TEMPLATES.values():
        for t in ts:
            own = set(ngrams(tokens(t))) & set(model.vocabulary)
            if sum(not rare & set(g.split(" ")) for g in own) >= AGREE * len(own):
                return None
    return sorted(rare)


def passages(docs: DataFrame, model: LicenceModel) -> DataFrame:
    """(doc_id, row, paragraph, line, kind, family, probability, agreement) of the passages that the classifier takes for a licence and a template confirms.

    Passages of a paragraph (parted by blank lines) are its lines (kind 0), sentences of lines (1) and, for wrapped notices, windows of WRAP lines (2), which count
    where no line of the paragraph is one. row tells texts of one doc_id apart. Agreement is the share of the template's known n-grams that the passage has. Only n-grams of the
    vocabulary, which is bounded by the templates, are summed, and passages without any of its words that a licence must have never leave their task.
    """
    spark, n = docs.sparkSession, len(model.classes)
    vocabulary = _vocabulary(spark, model)
    sizes = [len(set(ngrams(tokens(t))) & set(model.vocabulary)) for ts in TEMPLATES.values() for t in ts]
    of = [k for k, ts in enumerate(TEMPLATES.values()) for _ in ts]
    rare = _rare(model)
    split = lambda c: F.array_remove(F.split(F.lower(c), BETWEEN), "")
    some = (lambda c: F.exists(c, lambda x: x.isin(rare))) if rare else (lambda c: F.size(c) > 0)
    key = ["doc_id", "row", "paragraph"]
    paras = docs.select("doc_id", F.xxhash64("text").alias("row"), F.posexplode(F.split("text", PARAGRAPHS)).alias("paragraph", "body")).withColumn("words", split("body")).filter(some("words"))
    unit = lambda kind, at, text: F.struct(F.lit(kind).alias("kind"), at.cast("int").alias("line"), text.alias("text"))
    lines = paras.select(*key, F.split("body", r"\r?\n").alias("lines"))
    single = F.transform("lines", lambda x, i: unit(0, i, x))
    parts = F.flatten(F.transform("lines", lambda x, i: F.when(F.size(F.split(x, SENTENCES)) > 1, F.transform(F.split(x, SENTENCES), lambda y: unit(1, i, y))).otherwise(F.array().cast("array<struct<kind:int,line:int,text:string>>"))))
    wrapped = F.when(F.size("lines") > 1, F.transform(F.sequence(F.lit(0), F.size("lines") - 2, F.lit(WRAP // 2)), lambda i: unit(2, i, F.array_join(F.slice("lines", i + 1, WRAP), " ")))).otherwise(F.array().cast("array<struct<kind:int,line:int,text:string>>"))
    words = lines.select(*key, F.posexplode(F.concat(single, parts, wrapped)).alias("unit", "u")).select(*key, "unit", "u.kind", "u.line", split("u.text").alias("words")).filter(some("words"))
    key = [*key, "unit", "kind", "line"]
    at, w = F.sequence(F.lit(0), F.size("words") - 1), F.col("words")
    grams = F.concat(F.transform(w, lambda x: F.xxhash64(x)), F.transform(at, lambda i: F.xxhash64(F.get(w, i), F.coalesce(F.get(w, i + 1), F.lit("")), F.lit(2))))
    grams = words.select(*key, F.explode(F.array_distinct(grams)).alias("h"))
    met = grams.join(F.broadcast(vocabulary), "h")
    sums = met.groupBy(*key, "h").agg(F.first("w").alias("w"), F.first("t").alias("t")).groupBy(*key).agg(*(F.sum(F.col("w")[k]).alias(f"w{k}") for k in range(n)), *(F.sum(F.array_contains("t", k).cast("int")).alias(f"t{k}") for k in range(len(of))))
    logits = F.array(*((F.col(f"w{k}") + float(model.bias[k])) / model.temperature for k in range(n)))
    sums = sums.withColumn("logits", logits).withColumn("top", F.array_max("logits"))
    sums = sums.withColumn("class", F.array_position("logits", F.col("top")) - 1).withColumn("probability", 1 / F.aggregate("logits", F.lit(0.0), lambda s, x: s + F.exp(x - F.col("top"))))
    agree = F.lit(0.0)
    for k, family in enumerate(TEMPLATES):
        shares = [F.col(f"t{i}") / float(max(1, sizes[i])) for i, f in enumerate(of) if f == k]
        agree = F.when(F.col("class") == k, F.greatest(*shares) if len(shares) > 1 else shares[0]).otherwise(agree)
    names = F.array(*(F.lit(c) for c in model.classes))
    out = sums.select("doc_id", "row", "paragraph", "line", "kind", F.get(names, F.col("class").cast("int")).alias("family"), "probability", agree.alias("agreement"))
    return out.filter(F.col("family") != UNKNOWN).filter((F.col("probability") >= LEAST) & (F.col("agreement") >= AGREE))


def scan(docs: DataFrame, model: LicenceModel) -> DataFrame:
    """For every row of docs (doc_id, text): doc_id, licence (the family of its likeliest passage, unknown without one), probability,
    n_paragraphs (lines, or wrapped passages, with a licence) and licences (all families, sorted and comma-joined).

    Rows are told apart by doc_id and text, so repeated rows each get the same result; null, empty and unlicensed texts are unknown with probability 0; a row without doc_id is
    scanned like any other; an empty table gives no rows; other columns are ignored.
    """
    lined = F.min("kind") < 2
    found = passages(docs.filter("text is not null"), model).groupBy("doc_id", "row", "paragraph").agg(
        lined.alias("lined"), F.collect_set(F.struct((F.col("kind") == 2).alias("wrapped"), F.when(F.col("kind") < 2, F.col("line")).alias("line"), "family")).alias("hits"), F.collect_list(F.struct("probability", "family", (F.col("kind") == 2).alias("wrapped"))).alias("seen")
    )
    keep = lambda c: F.filter(c, lambda x: x["wrapped"] != F.col("lined"))
    found = found.select("doc_id", "row", keep("hits").alias("hits"), keep("seen").alias("seen")).groupBy("doc_id", "row").agg(
        F.max(F.array_max(F.transform("seen", lambda x: F.struct(x["probability"].alias("probability"), x["family"].alias("family"))))).alias("best"), F.sum(F.size("hits")).alias("n"), F.array_join(F.sort_array(F.array_distinct(F.flatten(F.collect_list(F.transform("hits", lambda x: x["family"]))))), ",").alias("licences")
    )
    found = found.withColumnsRenamed({"doc_id": "hit_id", "row": "hit_row"})
    rows = docs.select("doc_id", F.xxhash64("text").alias("row"))
    out = rows.join(found, F.expr("doc_id <=> hit_id and row = hit_row"), "left")
    return out.select("doc_id", F.coalesce("best.family", F.lit(UNKNOWN)).alias("licence"), F.coalesce(F.round("best.probability", 6), F.lit(0.0)).alias("probability"), F.coalesce("n", F.lit(0)).cast("long").alias("n_paragraphs"), F.coalesce("licences", F.lit("")).alias("licences"))


def op7_licences(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan(docs, fit(docs))
