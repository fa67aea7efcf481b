"""License scans: a trained classifier of paragraphs, in DataFrame operations only.

Paragraphs are what blank lines part; line ends inside them are blanks, so a wrapped notice is one.
Long ones are read in windows of words that overlap by the longest template's length, so that every
notice lies whole in one. A window's features are the words, pairs and triples that occur in the
templates of the license families, divided by the root of their number. A multinomial logistic
regression with a class for anything else is trained on templates, on templates with a tenth of their
words left out, and on all windows of the corpus that share a feature with templates but hold none.
Windows of equal features count as one of their joint mass. A family's chance must exceed what all but
a thousandth of those windows reach (read to six decimals); a prediction is confirmed when the window holds most word triples
of one of the family's templates. The confirmed notice's words are then blotted out and the rest of
the window is scanned again, until nothing is found, so a paragraph may have several families.

Defined results: a null or empty text has no notice. Rows are scanned one by one, whatever their
ids; paragraphs count from 0. A family comes once a paragraph, with the best of its windows. Equal
chances go to the first name. Only ``doc_id`` and ``text`` are read, whatever other columns there are.
A text without line ends is one paragraph, however long. An empty table gives an empty result.
"""

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitelens.llm.common import stored

STEPS, RATE, PENALTY = 30, 60.0, 1e-3
#: Share of a template's word triples that confirms a prediction.
CONFIRM = 0.7
#: Chance that a family must have at least.
LEAST_CHANCE = 0.5
VARIANTS = 12

# License families and the sentences that announce them.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files, to deal in the Software without restriction",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License 2.0.",
        "you may not use this file except in compliance with the License. You may obtain a copy "
        "of the License at http www apache org licenses LICENSE 2.0",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License",
        "Released under the GPL, version 3 or later.",
    ],
    "GPL-2.0": [
        "Licensed under the GNU General Public License, version 2.",
        "under the terms of the GNU General Public License version 2 as published by the Free "
        "Software Foundation",
    ],
    "LGPL-3.0": [
        "Licensed under the GNU Lesser General Public License, version 3.",
        "under the terms of the GNU Lesser General Public License as published by the Free "
        "Software Foundation",
    ],
    "BSD": [
        "Released under the BSD License.",
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ],
    "MPL-2.0": [
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License.",
    ],
    "CC0-1.0": [
        "Released under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related rights "
        "to this work and dedicates it to the public domain",
    ],
}
# Words too common to be a feature alone.
COMMON = """a an the of to in on at is are be been by for from with or and this that it its as any
all not may you your under either file work use copy forms terms most than more related following
person deal can without source late later see law was has have but they which possible met extent
used version subject author program public project""".split()

OTHER = "unknown"
#: What stands for a word of a notice that was found; no word has this sign.
BLOT = "|"
#: Words of the longest template; windows are twice as long and begin as far apart.
LONGEST = max(len(re.findall(r"[^\W_]+", x)) for own in TEMPLATES.values() for x in own)
CLASSES = [*sorted(TEMPLATES), OTHER]


def _words(text):
    """Lower-case words and numbers of a paragraph."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda x: x != "")


def _grams(words, n: int):
    """All runs of ``n`` words."""
    last = F.size(words) - F.lit(n)
    return F.when(
        last >= 0,
        F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(words, i + 1, n), " ")),
    ).otherwise(F.array().cast("array<string>"))


def _templates(spark: SparkSession) -> DataFrame:
    rows = [(f, i, t) for f, own in TEMPLATES.items() for i, t in enumerate(own)]
    found = spark.createDataFrame(rows, "family string, template int, text string").coalesce(1)
    return found.withColumn("words", _words(F.col("text")))


def _features(words):
    return F.array_distinct(F.concat(words, _grams(words, 2), _grams(words, 3)))


def vocabulary(templates: DataFrame) -> DataFrame:
    """``gram``: what a feature can be, and ``''``; bounded by the templates."""
    some = F.exists(F.split("gram", " "), lambda x: ~x.isin(COMMON) & ~x.rlike(r"^\d+$"))
    grams = templates.select(F.explode(_features(F.col("words"))).alias("gram")).distinct()
    return grams.where(some).union(templates.select(F.lit("")).limit(1))


def _windows(words):
    """Runs of words in which every run as long as the longest template lies whole."""
    more = F.greatest(F.lit(0), F.ceil(F.size(words) / LONGEST).cast("int") - 2)
    return F.transform(
        F.sequence(F.lit(0), more), lambda i: F.slice(words, i * LONGEST + 1, 2 * LONGEST)
    )


def paragraphs(docs: DataFrame, anchors: list[str]) -> DataFrame:
    """``doc_id, at, paragraph, words`` of every window that has a feature; ``at`` tells rows apart.

    A feature holds at least one of the ``anchors``, so any other window has none and is unknown.
    """
    own = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("at"), "text"
    )
    parts = own.select(
        "doc_id", "at", F.posexplode(F.split("text", r"\n\s*\n")).alias("paragraph", "part")
    )
    cut = parts.select("doc_id", "at", "paragraph", _words(F.col("part")).alias("words"))
    # windows are cut before they are exploded, so that no row holds more than its own
    cut = cut.select("doc_id", "at", "paragraph", F.explode(_windows(F.col("words"))).alias("words"))
    return cut.where(F.arrays_overlap("words", F.array(*map(F.lit, anchors))))


def _held(rows: DataFrame, known: DataFrame, key: list[str]) -> DataFrame:
    """``key, gram, value`` of the features of ``rows`` (``key, words``), and ``''`` for the base."""
    some = F.concat(F.array(F.lit("")), _features(F.col("words")))
    grams = rows.select(*key, F.explode(some).alias("gram"))
    grams = grams.join(F.broadcast(known), "gram", "left_semi").groupBy(*key)
    grams = grams.agg(F.collect_list("gram").alias("grams"))
    value = F.when(F.col("gram") == "", 1.0).otherwise(1 / F.sqrt(F.size("grams") - 1))
    return grams.select("*", F.explode("grams").alias("gram")).select(*key, "gram", value.alias("value"))


def _triples(templates: DataFrame) -> DataFrame:
    triples = F.array_distinct(
        F.when(F.size("words") >= 3, _grams(F.col("words"), 3)).otherwise(_grams(F.col("words"), 2))
    )
    return templates.select(
        "family", "template", F.size(triples).alias("of"), F.explode(triples).alias("triple")
    )


def compared(rows: DataFrame, templates: DataFrame, key: list[str]) -> DataFrame:
    """``key, family, similarity, template``: the largest share of a template's word triples in a
    window, and the first template that has it.
    """
    own = F.array_distinct(F.concat(_grams(F.col("words"), 3), _grams(F.col("words"), 2)))
    return (
        rows.select(*key, F.explode(own).alias("triple"))
        .join(F.broadcast(_triples(templates)), "triple")
        .groupBy(*key, "family", "template")
        .agg((F.count("*") / F.first("of")).alias("similarity"))
        .groupBy(*key, "family")
        .agg(F.max(F.struct("similarity", (-F.col("template")).alias("earlier"))).alias("best"))
        .select(*key, "family", "best.similarity", (-F.col("best.earlier")).alias("template"))
    )


def _training(templates: DataFrame, others: DataFrame) -> DataFrame:
    """``class, words``: templates and variants of them, and windows of the corpus."""
    drop = lambda w, i: F.pmod(F.xxhash64(w, i, F.col("variant")), F.lit(10)) != 0
    positive = (
        templates.withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))))
        .withColumn(
            "words", F.when(F.col("variant") == 0, F.col("words")).otherwise(F.filter("words", drop))
        )
        .select(F.col("family").alias("class"), "words")
    )
    return positive.unionByName(others.select(F.lit(OTHER).alias("class"), "words"))


def _others(windows: DataFrame, templates: DataFrame) -> DataFrame:
    """Distinct windows of the corpus that hold no template."""
    rows = windows.select(F.xxhash64("words").alias("key"), "words").dropDuplicates(["key"])
    rows = stored(rows, "license-paragraphs")
    alike = compared(rows, templates, ["key"]).where(F.col("similarity") >= CONFIRM).select("key")
    return rows.join(alike.distinct(), "key", "left_anti")


def _feature_sets(rows: DataFrame, grams: list[str]) -> DataFrame:
    """``own, mass, n, value, held``: the sets of features of ``rows`` (``class, words``), once a class.

    ``held`` are places in ``grams``, each of ``value``; the classes have equal masses together.
    """
    known = F.array(*map(F.lit, grams))
    sets = rows.select("class", F.array_sort(F.array_intersect(_features(F.col("words")), known)).alias("set"))
    sets = stored(sets.groupBy("class", "set").agg(F.count("*").alias("n")), "license-sets")
    all_of = F.broadcast(sets.groupBy("class").agg(F.sum("n").alias("all")))
    place = lambda x: (F.array_position(known, x) - 1).cast("int")
    found = sets.join(all_of, "class").select(
        (F.array_position(F.array(*map(F.lit, CLASSES)), F.col("class")) - 1).cast("int").alias("own"),
        (F.col("n") / F.col("all") / len(CLASSES)).alias("mass"),
        "n",
        (1 / F.sqrt(F.greatest(F.size("set"), F.lit(1)))).alias("value"),
        F.transform("set", place).alias("held"),
    )
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(found.repartition(tasks), "license-training")


def _set_chances(sets: DataFrame, grams: list[str], values: dict) -> DataFrame:
    """``sets`` with ``chances``, one for each class: softmax of the margins."""
    table = [[values[g, c] for c in CLASSES] for g in grams]
    weights = sets.sparkSession.createDataFrame([(table,)], "weights array<array<double>>")
    w, base = F.col("weights"), grams.index("")

    def margin(c):
        held = F.aggregate("held", F.lit(0.0), lambda total, g: total + w[g][c])
        return w[base][c] + F.col("value") * held

    raised = F.transform(F.sequence(F.lit(0), F.lit(len(CLASSES) - 1)), lambda c: F.exp(margin(c)))
    found = sets.join(F.broadcast(weights.coalesce(1))).withColumn("e", raised)
    found = found.withColumn("whole", F.aggregate("e", F.lit(0.0), lambda total, x: total + x))
    return found.select(*sets.columns, F.transform("e", lambda x: x / F.col("whole")).alias("chances"))


def _chances(held: DataFrame, weights: DataFrame, key: str) -> DataFrame:
    """``key, class, chance``: softmax of each row's margins; ``weights`` is a row for each feature
    and class.
    """
    margins = (
        held.join(F.broadcast(weights), "gram")
        .groupBy(key, "class")
        .agg(F.sum(F.col("value") * F.col("weight")).alias("margin"))
        .withColumn("e", F.exp("margin"))
    )
    whole = Window.partitionBy(key)
    return margins.select(key, "class", (F.col("e") / F.sum("e").over(whole)).alias("chance"))


def _weights(spark: SparkSession, values: dict[tuple[str, str], float]) -> DataFrame:
    rows = [(gram, kind, w) for (gram, kind), w in values.items()]
    return spark.createDataFrame(rows, "gram string, class string, weight double").coalesce(1)


def train(windows: DataFrame, templates: DataFrame, known: DataFrame) -> tuple[DataFrame, float]:
    """Weights, and the chance that a family must exceed, after full-batch gradient steps.

    Every one of ``windows`` counts. A step is a pass over the sets of features that sums slopes in
    the tasks; the driver holds the weights, as many as the templates have features, times the
    classes.
    """
    spark = windows.sparkSession
    grams = sorted(x.gram for x in known.collect())
    sets = _feature_sets(_training(templates, _others(windows, templates)), grams)
    values = {(g, c): 0.0 for g in grams for c in CLASSES}
    each = F.struct(F.lit(grams.index("")).alias("gram"), F.lit(1.0).alias("value"))
    held = F.transform("held", lambda g: F.struct(g.alias("gram"), F.col("value").alias("value")))
    for _ in range(STEPS):
        chances = _set_chances(sets, grams, values)
        miss = F.transform(
            "chances", lambda x, c: (x - (c == F.col("own")).cast("double")) * F.col("mass")
        )
        slopes = (
            chances.select(miss.alias("miss"), F.inline(F.concat(F.array(each), held)))
            .groupBy("gram")
            .agg(*(F.sum(F.col("value") * F.col("miss")[c]).alias(f"c{c}") for c in range(len(CLASSES))))
        )
        for x in slopes.collect():
            gram = grams[x["gram"]]
            for c, kind in enumerate(CLASSES):
                own = PENALTY * values[gram, kind] / len(CLASSES) * bool(gram)
                values[gram, kind] -= RATE * (x[f"c{c}"] + own)
    other = CLASSES.index(OTHER)
    families = F.filter("chances", lambda x, c: c != other)
    reached = (
        _set_chances(sets.where(F.col("own") == other), grams, values)
        .groupBy(F.round(F.array_max(families), 6).alias("chance"))
        .agg(F.sum("n").alias("n"))
        .agg(F.expr("percentile(chance, 0.999, n)"))
        .first()[0]
    )
    return _weights(spark, values), max(LEAST_CHANCE, min(0.95, reached or 0.0))


def _blotted(words, triples):
    """``words`` without those that lie in any of ``triples``."""
    held = F.transform(
        words, lambda x, i: F.array_contains(triples, F.array_join(F.slice(words, i + 1, 3), " "))
    )

    def inside(i):
        near = F.slice(held, F.greatest(i - 1, F.lit(1)), F.least(i + 1, F.lit(3)))
        return F.exists(near, lambda x: x)

    return F.transform(words, lambda x, i: F.when(inside(i), F.lit(BLOT)).otherwise(x))


def _confirmed(
    rows: DataFrame, weights: DataFrame, least: float, templates: DataFrame, known: DataFrame
) -> DataFrame:
    """``window, family, chance, similarity, template`` of each of ``rows`` with a confirmed family."""
    chances = _chances(_held(rows, known, ["window"]), weights, "window")
    best = Window.partitionBy("window").orderBy(F.desc("chance"), "class")
    predicted = (
        chances.withColumn("place", F.row_number().over(best))
        .where((F.col("place") == 1) & (F.col("class") != OTHER) & (F.col("chance") > least))
        .select("window", F.col("class").alias("family"), "chance")
    )
    predicted = stored(predicted, "license-predictions")
    alike = compared(rows.join(predicted.select("window"), "window"), templates, ["window"])
    found = predicted.join(alike, ["window", "family"]).where(F.col("similarity") >= CONFIRM)
    return stored(found, "license-confirmed")


def license_notices(docs: DataFrame) -> DataFrame:
    """``doc_id, paragraph, family, chance, similarity`` of every confirmed notice."""
    docs = docs.select("doc_id", "text")
    templates = stored(_templates(docs.sparkSession), "license-templates")
    known = stored(vocabulary(templates), "license-vocabulary")
    single = known.select(F.explode(F.split("gram", " ")).alias("word")).distinct()
    plain = ~F.col("word").isin([*COMMON, ""]) & ~F.col("word").rlike(r"^\d+$")
    anchors = sorted(x.word for x in single.where(plain).collect())
    rows = paragraphs(docs, anchors).withColumn("window", F.monotonically_increasing_id())
    rows = stored(rows, "license-candidates")
    weights, least = train(rows, templates, known)
    of = ["family", "template"]
    triples = _triples(templates).groupBy(*of).agg(F.collect_set("triple").alias("triples"))
    found, left = [], rows.select("window", "words")
    for _ in range(sum(map(len, TEMPLATES.values()))):  # a round takes one template from each window
        now = _confirmed(left, weights, least, templates, known)
        found.append(now)
        rest = left.join(now.select("window", *of), "window").join(F.broadcast(triples), of)
        rest = rest.select("window", _blotted(F.col("words"), F.col("triples")).alias("words"))
        left = stored(
            rest.where(F.arrays_overlap("words", F.array(*map(F.lit, anchors)))), "license-rest"
        )
        if left.isEmpty():
            break
    return (
        rows.select("window", "at", "doc_id", "paragraph")
        .join(reduce(DataFrame.unionByName, found), "window")
        .groupBy("at", "doc_id", "paragraph", "family")
        .agg(F.round(F.max("chance"), 6).alias("chance"), F.max("similarity").alias("similarity"))
        .drop("at")
    )
