"""Licence scan with a trained paragraph classifier, in DataFrame operations only.

A sparse logistic regression on word pairs is trained on variants of short licence notices and on half
of the paragraphs of the corpus as the unknown class. The probability from which a family is believed is
calibrated on the other half. Paragraphs count by the word pairs of notices that they hold, so all of
them are a short table of different sets with their numbers. A believed family is confirmed if enough word pairs of one of
its notices stand in the paragraph. Word pairs outside the notices have no weight, so the scan is one
explode and one join with the small weight table.

A paragraph is a line. Notices that are wrapped over lines are found in runs of neighbouring lines with
words, pairs across the line ends included; lines that are confirmed by themselves are left out there.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devigil.llm.shared import Landing

UNKNOWN = "unknown"
KEY = ("doc_id", "hash_a", "hash_b")
#: A line: its text, the block and the line in the block.
AT = (*KEY, "block", "line")
#: Short notices by licence family, as published for use in files.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("GPL", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation."),
    ("LGPL", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("AGPL", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD", "Released under the BSD 3-Clause License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY", "Licensed under CC BY 4.0."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("proprietary", "All rights reserved."),
    ("proprietary", "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential."),
)


@dataclass(frozen=True)
class LicenceParams:
    """``negatives`` bounds the weight of the corpus paragraphs against that of the notices, in the halves
    for training and calibration together. Word pairs in more than ``common`` of the paragraphs carry no
    licence. ``false_rate`` of the calibration paragraphs may be believed; ``contained`` is the part
    of a notice's word pairs that confirms it."""

    negatives: int = 8000
    common: float = 0.002
    false_rate: float = 0.0005
    least_probability: float = 0.5
    contained: float = 0.75
    ridge: float = 2e-4


def words_of(text):
    """Words in lower case."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def pairs_of(words):
    """Pairs of neighbouring words of an array column; a single word is a pair with nothing.

    The array must be a column: written out inside, it would be worked out again for every pair.
    """
    n = F.size(words)
    pairs = F.zip_with(F.slice(words, 1, n - 1), F.slice(words, 2, n - 1), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(n > 1, pairs).otherwise(words)


def with_pairs(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``grams`` for ``text``: the pairs of neighbouring words, as often as they stand."""
    listed = df.withColumn("words", words_of(F.col(text)))
    return listed.withColumn("grams", pairs_of(F.col("words"))).drop("words", text)


def notices(spark: SparkSession) -> DataFrame:
    """``notice, family, text``: the templates."""
    rows = [(i, family, text) for i, (family, text) in enumerate(NOTICES)]
    return spark.createDataFrame(rows, "notice int, family string, text string")


def paragraphs(docs: DataFrame) -> DataFrame:
    """``doc_id, hash_a, hash_b, paragraph, text``: the lines of every text that are not blank."""
    keyed = docs.filter("text is not null").select(
        "doc_id", F.xxhash64("text").alias("hash_a"), F.xxhash64("text", F.lit(1)).alias("hash_b"), "text"
    )
    each = keyed.select(*KEY, F.posexplode(F.split("text", "\n", -1)).alias("paragraph", "text"))
    return each.filter(F.trim("text") != "")


def variants(templates: DataFrame) -> DataFrame:
    """``family, grams``: each notice whole, after other words, and without each of its words."""
    words = F.split("text", " ")
    cut = F.transform(words, lambda _, i: F.array_join(F.filter(words, lambda _, j: i != j), " "))
    texts = F.concat(F.array("text", F.concat(F.lit("Note: "), "text"), F.concat("text", F.lit(" See the file."))), cut)
    return with_pairs(templates.select("family", F.explode(texts).alias("text")))


@dataclass(frozen=True)
class LicenceModel:
    """``weights`` has a row for each word pair: its weight by class; ``classes[0]`` is unknown."""

    classes: list[str]
    intercepts: list[float]
    weights: DataFrame
    templates: DataFrame
    threshold: float


def _probabilities(hits: DataFrame, keys: tuple[str, ...], classes: list[str], intercepts: list[float]) -> DataFrame:
    """Softmax over the classes from ``weights`` summed by key, and the best family."""
    sums = [F.sum(F.col("weights")[i]).alias(f"w{i}") for i in range(len(classes))]
    summed = hits.groupBy(*keys).agg(*sums)
    raised = [F.exp(F.col(f"w{i}") + F.lit(b)) for i, b in enumerate(intercepts)]
    whole = sum(raised[1:], raised[0])
    ranked = [F.struct((e / whole).alias("probability"), F.lit(c).alias("family")) for e, c in zip(raised, classes)]
    best = F.array_max(F.array(*ranked[1:]))
    return summed.select(*keys, best.alias("best")).select(*keys, "best.probability", "best.family")


def _templates(spark: SparkSession) -> DataFrame:
    """``notice, family, grams``: the different word pairs of the notices."""
    return with_pairs(notices(spark)).withColumn("grams", F.array_distinct("grams"))


def notice_pairs(docs: DataFrame) -> DataFrame:
    """``placed_pairs`` that stand in a notice too; equal rows of ``docs`` are found once."""
    grams = _templates(docs.sparkSession).select(F.explode("grams").alias("gram")).distinct()
    # one row for each word pair of the notices
    return placed_pairs(docs).join(F.broadcast(grams), "gram").dropDuplicates([*AT, "next", "gram"])


def train(
    docs: DataFrame, params: LicenceParams = LicenceParams(), pairs: DataFrame | None = None
) -> LicenceModel:
    """Fit on the notices and all paragraphs of ``docs``; ``pairs`` are its ``notice_pairs`` if at hand."""
    spark = docs.sparkSession
    store = Landing(spark, "licences")
    texts = notices(spark)
    templates = store.land(_templates(spark), "templates")
    if pairs is None:
        pairs = store.land(notice_pairs(docs), "pairs")
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.trim(x) != "")
    sized = docs.filter("text is not null").select(
        "doc_id", F.xxhash64("text").alias("hash_a"), F.xxhash64("text", F.lit(1)).alias("hash_b"), F.size(lines).alias("n")
    )
    seen = max(1, sized.distinct().agg(F.sum("n").alias("n")).first()["n"] or 0)
    own = [row["grams"] for row in templates.select("grams").collect()]
    all_grams = sorted({g for grams in own for g in grams})
    # paragraphs by the word pairs they hold; those without any are what the others leave
    held = pairs.filter("line = next").groupBy(*AT).agg(F.array_sort(F.collect_set("gram")).alias("grams"))
    half = F.pmod(F.xxhash64(*KEY[1:], "block", "line"), F.lit(2)).alias("half")
    sets = store.land(held.groupBy("grams", half).agg(F.count(F.lit(1)).alias("n")), "sets")
    without = max(0, seen - (sets.agg(F.sum("n").alias("n")).first()["n"] or 0))
    # notices stand in the corpus too and are no examples of the unknown class
    parts = [F.size(F.array_intersect("grams", F.array(*map(F.lit, g)))) / len(g) for g in own]
    plain = sets.filter(F.greatest(*parts) < 0.5)
    common = plain.select(F.explode("grams").alias("gram"), "n").groupBy("gram").agg(F.sum("n").alias("n"))
    dropped = {r["gram"] for r in common.filter(F.col("n") > max(3.0, params.common * seen)).collect()}
    known = [g for g in all_grams if g not in dropped]
    classes = [UNKNOWN, *sorted({family for family, _ in NOTICES})]
    label = F.element_at(F.create_map(*[x for i, c in enumerate(classes) for x in (F.lit(c), F.lit(float(i)))]), F.col("family"))
    share = min(1.0, params.negatives / seen)
    bare = spark.createDataFrame([(0.0, [], share * without / 2)], "label double, grams array<string>, weight double")
    rows = variants(texts).select(label.alias("label"), "grams", F.lit(5.0).alias("weight")).union(
        plain.filter("half = 0").select(F.lit(0.0).alias("label"), "grams", F.col("n") * F.lit(share))
    ).union(bare)
    encoder = CountVectorizer(inputCol="grams", outputCol="features", binary=True).fit(
        spark.createDataFrame([(known,)], "grams array<string>")
    )
    data = store.land(encoder.transform(rows).select("label", "features", "weight"), "training")
    fit = LogisticRegression(
        family="multinomial", weightCol="weight", regParam=params.ridge, elasticNetParam=0.5, maxIter=60
    ).fit(data)
    matrix = fit.coefficientMatrix.toArray()
    table = [(g, [float(x) for x in matrix[:, i]]) for i, g in enumerate(encoder.vocabulary)]
    weights = spark.createDataFrame(table, "gram string, weights array<double>")
    intercepts = [float(x) for x in fit.interceptVector]
    tested = plain.filter("half = 1").select("grams", "n", F.explode("grams").alias("gram"))
    hits = tested.join(F.broadcast(weights), "gram")
    scores = _probabilities(hits, ("grams", "n"), classes, intercepts)
    believed = max(1, int(params.false_rate * seen / 2))
    # below the least probability it does not matter how many there are
    above = scores.filter(F.col("probability") > params.least_probability).groupBy("probability")
    top = above.agg(F.sum("n").alias("n")).orderBy(F.desc("probability")).limit(believed).collect()
    counts = accumulate(r["n"] for r in top)
    reached = [r["probability"] for r, count in zip(top, counts) if count >= believed]
    threshold = max([params.least_probability, *reached[:1]])
    grams = templates.select(
        "notice", "family", F.filter("grams", lambda g: g.isin(known)).alias("grams")
    )
    sized = grams.select("notice", "family", F.size("grams").alias("n_grams"), F.explode("grams").alias("gram"))
    rows = [tuple(r) for r in sized.collect()]
    held = spark.createDataFrame(rows, "notice int, family string, n_grams int, gram string")
    return LicenceModel(classes, intercepts, weights, held, threshold)


def placed_pairs(docs: DataFrame) -> DataFrame:
    """``doc_id, hash_a, hash_b, block, line, next, gram``: the word pairs of every text, with the lines
    that their words stand on. A line without words begins a new block."""
    keyed = docs.filter("text is not null").select(
        "doc_id", F.xxhash64("text").alias("hash_a"), F.xxhash64("text", F.lit(1)).alias("hash_b"), "text"
    )
    blocks = F.split("text", r"\n(?=[^\p{L}\p{N}\n]*(?:\n|\z))", -1)
    each = keyed.select(*KEY, F.posexplode(blocks).alias("block", "text"))

    def placed(line, i):
        return F.transform(words_of(line), lambda w: F.struct(w.alias("w"), i.alias("i")))

    listed = each.select(*KEY, "block", F.flatten(F.transform(F.split("text", "\n", -1), placed)).alias("words"))
    n = F.size("words")
    pairs = F.zip_with(
        F.slice("words", 1, n - 1), F.slice("words", 2, n - 1),
        lambda a, b: F.struct(a["i"].alias("line"), b["i"].alias("next"), F.concat(a["w"], F.lit(" "), b["w"]).alias("gram")),
    )
    return listed.filter(n > 1).select(*KEY, "block", F.inline(pairs))


def _confirmed(hits: DataFrame, keys: tuple[str, ...], model: LicenceModel, params: LicenceParams) -> DataFrame:
    """``keys, family, probability, contained`` of what is believed and confirmed; ``hits`` are distinct."""
    found = _probabilities(hits, keys, model.classes, model.intercepts)
    found = found.filter(F.col("probability") > model.threshold)
    seen = hits.select(*keys, "gram").join(F.broadcast(model.templates), "gram")
    seen = seen.groupBy(*keys, "family", "notice").agg((F.count(F.lit(1)) / F.max("n_grams")).alias("contained"))
    seen = seen.groupBy(*keys, "family").agg(F.max("contained").alias("contained"))
    condition = _same("f", "s", (*keys, "family"))
    joined = found.alias("f").join(seen.alias("s"), condition).filter(F.col("contained") >= params.contained)
    return joined.select(*[f"f.{k}" for k in keys], "f.family", "f.probability", "s.contained")


def _same(left: str, right: str, keys: tuple[str, ...]):
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return condition


def scan(
    docs: DataFrame,
    model: LicenceModel,
    params: LicenceParams = LicenceParams(),
    pairs: DataFrame | None = None,
) -> DataFrame:
    """``doc_id, hash_a, hash_b, block, line, family, probability, contained`` of every line with a
    confirmed licence, and with ``line`` null of every block that has one over several lines.
    The hashes are those of the text; equal rows of ``docs`` are found once. ``pairs`` are the
    ``notice_pairs`` of ``docs`` if at hand."""
    store = Landing(docs.sparkSession, "licences")
    at, run = AT, (*KEY, "block")
    if pairs is None:
        pairs = store.land(notice_pairs(docs), "pairs")
    # a row for each word pair of the notices at most
    hits = pairs.join(F.broadcast(model.weights), "gram")
    single = store.land(_confirmed(hits.filter("line = next"), at, model, params), "single")
    # the rest of the lines together; a confirmed line is no part of a wrapped notice
    done = single.select(*at)
    rest = hits.alias("h").join(done.alias("d"), _same("h", "d", at), "left_anti")
    rest = rest.dropDuplicates([*run, "gram"])
    wrapped = _confirmed(rest, run, model, params)
    wrapped = wrapped.select(*run, F.lit(None).cast("int").alias("line"), "family", "probability", "contained")
    return single.unionByName(wrapped)


def licences(docs: DataFrame, params: LicenceParams = LicenceParams()) -> DataFrame:
    """``doc_id, licence, n_paragraphs, families`` for every row of ``docs`` (``doc_id, text``).

    A paragraph is a line, or neighbouring lines that have a wrapped notice between them.

    ``licence`` is the family of the most probable licence paragraph (the first by name on a tie),
    ``unknown`` without one; ``families`` are all families by name. Null, empty and blank texts are
    ``unknown``; equal rows get equal results.
    """
    pairs = Landing(docs.sparkSession, "licences").land(notice_pairs(docs), "pairs")
    found = scan(docs, train(docs, params, pairs), params, pairs)
    ranked = F.struct((-F.col("probability")).alias("p"), "family")
    per_text = found.groupBy(*KEY).agg(
        F.min(ranked)["family"].alias("licence"), F.count(F.lit(1)).alias("n_paragraphs"),
        F.sort_array(F.collect_set("family")).alias("families"),
    )
    rows = docs.select("doc_id", F.xxhash64("text").alias("hash_a"), F.xxhash64("text", F.lit(1)).alias("hash_b"))
    on = [F.col(f"d.{k}").eqNullSafe(F.col(f"p.{k}")) for k in KEY]
    joined = rows.alias("d").join(per_text.alias("p"), on[0] & on[1] & on[2], "left")
    return joined.select(
        "d.doc_id", F.coalesce("licence", F.lit(UNKNOWN)).alias("licence"),
        F.coalesce("n_paragraphs", F.lit(0)).alias("n_paragraphs"),
        F.array_join(F.coalesce("families", F.array().cast(T.ArrayType(T.StringType()))), ",").alias("families"),
    )


CHECK = r"""
WITH n(family, notice) AS (VALUES
  ('Apache-2.0', 'Licensed under the Apache License, Version 2.0.'), ('MIT', 'Released under the MIT License.'),
  ('GPL', 'This work is licensed under the GNU General Public License, version 3.'),
  ('CC-BY-NC', 'Licensed under CC BY-NC 4.0.'), ('proprietary', 'All rights reserved.')
), l AS (
  SELECT doc_id, text, family FROM (
    SELECT DISTINCT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
    FROM documents) JOIN n ON contains(line, notice)
), p AS (
  SELECT doc_id, text, count(*) AS n_paragraphs, string_agg(DISTINCT family, ',' ORDER BY family) AS families FROM l GROUP BY ALL
)
SELECT d.doc_id, coalesce(families, 'unknown') AS licence, coalesce(n_paragraphs, 0) AS n_paragraphs, coalesce(families, '') AS families
FROM documents d LEFT JOIN p ON d.doc_id = p.doc_id AND d.text = p.text
"""
