"""Licence notices in documents: Dice coefficient of word bigrams against templates.

DataFrame functions only. Text is normalised to lower-case words of letters,
digits and inner dots or hyphens.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DICE = 0.9

# --- fixed values: licence notices and texts to look for -------------------
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("Apache-2.0", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
# ----------------------------------------------------------------------------


def normalised_words(text: Column | str) -> Column:
    """Lower-case words; marks around and between words are dropped, those inside (2.0, by-nc) stay."""
    cleaned = F.regexp_replace(F.lower(text), "[^\\p{L}\\p{N}.\\-]+|[.\\-]+(?![\\p{L}\\p{N}])|(?<![\\p{L}\\p{N}])[.\\-]+", " ")
    return F.filter(F.split(cleaned, " +"), lambda word: word != "")


def _bigrams(words: str) -> Column:
    """Hashes of all pairs of neighbouring words."""
    pairs = F.transform(words, lambda word, i: F.xxhash64(word, F.get(F.col(words), i + 1)))
    return F.slice(pairs, 1, F.greatest(F.size(words) - 1, F.lit(0)))


def _dice(a: str, b: str) -> Column:
    """Twice the shared bigrams, each as often as both have it, over all bigrams of both."""

    def numbered(x: str) -> Column:
        return F.transform(x, lambda h, i: F.xxhash64(h, F.size(F.filter(F.slice(x, F.lit(1), i), lambda y: y == h))))

    return 2 * F.size(F.array_intersect(numbered(a), numbered(b))) / (F.size(a) + F.size(b))


def template_table(spark, templates: list[tuple[str, str]], dice: float) -> DataFrame:
    """Templates with their bigrams and the sizes a passage may have to reach the coefficient.

    Of sizes a and b the coefficient is at most 2 min(a, b) / (a + b), so b is
    between a * dice / (2 - dice) and a * (2 - dice) / dice.
    """
    rows = [(i, name, text) for i, (name, text) in enumerate(templates)]
    table = spark.createDataFrame(rows, "template INT, license STRING, template_text STRING")
    table = table.withColumn("words", normalised_words("template_text"))
    table = table.select("template", "license", "words", _bigrams("words").alias("template_bigrams"))
    n = F.size("template_bigrams")
    return table.where(n > 0).select(
        "*", F.ceil(n * dice / (2 - dice) - 1e-9).cast("int").alias("low"), F.floor(n * (2 - dice) / dice + 1e-9).cast("int").alias("high")
    )


def signal_words(bigrams: int, words: list[str], dice: float) -> list[str]:
    """Words of a template of which a passage has at least one if it reaches the coefficient.

    Of a template of a bigrams at least a * dice / (2 - dice) are shared. So
    words are taken, the longest first, until more bigrams would be missing
    without them than may be. None if letters alone can't do that.
    """
    may_miss, chosen, missing = bigrams - bigrams * dice / (2 - dice) + 1e-9, [], set()
    for word in sorted({w for w in words if w.isalpha()}, key=lambda w: (-len(w), w)):
        chosen.append(word)
        missing |= {i for i in range(bigrams) if word in (words[i], words[i + 1])}
        if len(missing) > may_miss:
            return chosen
    return []


def _may_hold(text: str, signals: list[list[str]]) -> Column:
    """Whether a text has a signal word of some template; always true if a template has none."""
    if not all(signals):
        return F.lit(True)
    words = sorted({word for chosen in signals for word in chosen})
    return F.rlike(F.lower(text), F.lit("|".join(words)))


def passages(documents: DataFrame) -> DataFrame:
    """Sentences, lines, paragraphs and whole texts of every document, as (doc_id, text_hash, passage).

    Sentences end with a stop, exclamation or question mark, colon or
    semicolon before white space; paragraphs at empty lines.
    """
    paragraphs = F.split("text", "\\n[ \\t\\r]*\\n\\s*")
    lines = F.split("text", "\\n")
    sentences = F.flatten(F.transform(lines, lambda line: F.split(line, "(?<=[.!?:;])\\s+")))
    every = F.concat(F.array("text"), paragraphs, lines, sentences)
    return documents.select("doc_id", F.xxhash64("text").alias("text_hash"), F.explode(F.array_distinct(every)).alias("passage"))


def scan_licenses(documents: DataFrame, templates: list[tuple[str, str]] | None = None, dice: float = DICE) -> DataFrame:
    """doc_id, license, dice (of its best passage) and n_passages of every licence found in a document.

    Whole texts are read, as sentences, lines, paragraphs and as one passage;
    a passage counts for its best template (ties: the first). Null and empty
    texts hold nothing. Repeated rows of one id and text give one row for
    each licence, rows with a null id are told apart by their text. An empty
    table gives no rows; further columns are ignored. `templates` is a list
    held by the driver; its signal words and bigrams filter passages as constants.
    """
    spark = documents.sparkSession
    table = template_table(spark, TEMPLATES if templates is None else templates, dice)
    facts = table.select("template_bigrams", "words", "low", "high").collect()  # of the caller's list
    if not facts:
        facts_low, facts_high, known = 1, 0, [0]
    else:
        facts_low, facts_high = min(f.low for f in facts), max(f.high for f in facts)
        known = sorted({h for f in facts for h in f.template_bigrams})
    signals = [signal_words(len(f.template_bigrams), f.words, dice) for f in facts]
    texts = documents.select("doc_id", "text").where(F.col("text").isNotNull() & _may_hold("text", signals))
    sized = passages(texts).where(_may_hold("passage", signals))
    words = sized.select("doc_id", "text_hash", F.explode(F.array(normalised_words("passage"))).alias("words"))
    words = words.where((F.size("words") > facts_low) & (F.size("words") <= facts_high + 1))
    cut = words.select("doc_id", "text_hash", F.explode(F.array(_bigrams("words"))).alias("bigrams"))
    near = cut.where(F.exists("bigrams", lambda h: h.isin(known)))
    bounded = table.drop("words").select("*", F.explode(F.sequence("low", "high")).alias("n")).drop("low", "high")
    matched = near.withColumn("n", F.size("bigrams")).join(F.broadcast(bounded), "n")
    matched = matched.withColumn("dice", _dice("bigrams", "template_bigrams")).where(F.col("dice") >= dice)
    best = matched.groupBy("doc_id", "text_hash", "bigrams").agg(
        F.max_by(F.struct("license", "dice"), F.struct("dice", -F.col("template"))).alias("best")
    )
    return best.groupBy("doc_id", "text_hash", F.col("best.license").alias("license")).agg(
        F.max("best.dice").alias("dice"), F.count(F.lit(1)).alias("n_passages")
    ).drop("text_hash")


def _shared_at_least(a: int, b: int, dice: float) -> int:
    """How many bigrams a passage of b shares with a template of a to reach the coefficient."""
    return math.ceil(dice * (a + b) / 2 - 1e-9)


def _least_run(a: int, low: int, high: int, dice: float) -> int:
    """Shared bigrams that follow one another in any window that reaches the coefficient."""
    runs = []
    for b in range(low, high + 1):
        shared = _shared_at_least(a, b, dice)
        runs.append(-(-shared // (b - shared + 1)))
    return max(1, min(runs, default=1))


def scan_notices(documents: DataFrame, templates: list[tuple[str, str]] | None = None, dice: float = DICE) -> DataFrame:
    """The columns of `scan_licenses`, for notices anywhere in the words of a text.

    Windows of all sizes that can reach the coefficient slide over the
    normalised words, so line ends, comment marks and neighbours play no part.
    The best window of a template begins and ends with a bigram of it; only
    those are tried. Of windows that overlap the best counts (ties: the
    longest, then the first template). `n_passages` counts windows that don't
    overlap, those with the same bigrams of the template at the same distances
    once. Null, repeated and empty rows are treated as `scan_licenses` does.
    """
    spark = documents.sparkSession
    table = template_table(spark, TEMPLATES if templates is None else templates, dice)
    facts = table.collect()  # of the caller's list
    known = sorted({h for f in facts for h in f.template_bigrams}) or [0]
    signals = [signal_words(len(f.template_bigrams), f.words, dice) for f in facts]
    run = min((_least_run(len(f.template_bigrams), f.low, f.high, dice) for f in facts), default=1)
    rows = [
        (h, f.template, f.license, len(f.template_bigrams), f.low, f.high, _shared_at_least(len(f.template_bigrams), f.low, dice), f.template_bigrams.count(h))
        for f in facts for h in sorted(set(f.template_bigrams))
    ]
    items = spark.createDataFrame(rows, "h BIGINT, template INT, license STRING, a INT, low INT, high INT, needed INT, most INT")

    texts = documents.select("doc_id", "text").where(F.col("text").isNotNull() & _may_hold("text", signals))
    words = texts.select("doc_id", F.xxhash64("text").alias("text_hash"), F.explode(F.array(normalised_words("text"))).alias("words"))
    pairs = words.select("doc_id", "text_hash", F.explode(F.array(_bigrams("words"))).alias("bigrams"))
    placed = F.filter(F.transform("bigrams", lambda h, i: F.struct(i.alias("pos"), h.alias("h"))), lambda x: x.h.isin(known))
    anchors = pairs.select("doc_id", "text_hash", F.explode(F.array(placed)).alias("anchors"))
    # any window holds so many anchors in a row
    follow = F.transform("anchors", lambda x, i: F.get(F.col("anchors"), i + (run - 1)).pos - x.pos == run - 1)
    anchors = anchors.where(F.exists(follow, lambda x: F.coalesce(x, F.lit(False))))
    anchors = anchors.select("doc_id", "text_hash", F.explode("anchors").alias("x")).select("doc_id", "text_hash", "x.pos", "x.h")

    key = ["doc_id", "text_hash"]
    bounds = ["template", "license", "a", "low", "high", "needed"]
    matched = anchors.join(F.broadcast(items), "h").groupBy(*key, *bounds).agg(F.array_sort(F.collect_set(F.struct("pos", "h", "most"))).alias("own"))
    matched = matched.where(F.size("own") >= F.col("needed"))
    # a window from here has enough of the template's bigrams
    ahead = F.transform(
        "own",
        lambda x, i: F.when(F.get(F.col("own"), i + F.col("needed") - 1).pos - x.pos < F.col("high"), F.slice(F.col("own"), i + 1, F.col("high"))),
    )
    starts = matched.select(*key, *bounds, F.explode(F.filter(ahead, lambda x: x.isNotNull())).alias("ahead"))
    starts = starts.withColumn("begin", F.get("ahead", F.lit(0)).pos)
    starts = starts.select(*key, *bounds, "begin", F.explode(F.array(F.filter("ahead", lambda x: x.pos - F.col("begin") < F.col("high")))).alias("own"))
    # bigrams count as often as the template has them
    counted = F.transform("own", lambda x, i: F.size(F.filter(F.slice(F.col("own"), F.lit(1), i + 1), lambda y: y.h == x.h)) <= x.most)
    starts = starts.select("*", F.explode(F.array(counted)).alias("counted"))
    ends = F.transform(
        "own",
        lambda x, i: F.struct(
            (2 * F.size(F.filter(F.slice(F.col("counted"), F.lit(1), i + 1), lambda y: y)) / (F.col("a") + x.pos - F.col("begin") + 1)).alias("dice"),
            x.pos.alias("end"),
        ),
    )
    windows = starts.withColumn("best", F.array_max(ends)).where(F.col("best.dice") >= dice)
    within = F.filter("own", lambda x: x.pos <= F.col("best.end"))
    windows = windows.select(
        *key, "template", "license", "begin", F.col("best.end").alias("end"), F.col("best.dice").alias("dice"),
        F.xxhash64(F.transform(within, lambda x: F.struct(x.h, x.pos - F.col("begin")))).alias("passage"),
    )

    # windows that hang together by overlaps are settled together
    ordered = Window.partitionBy(*key).orderBy("begin", "end", "template")
    before = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    windows = windows.withColumn("opens", F.coalesce(F.col("begin") > before, F.lit(True)).cast("int"))
    windows = windows.withColumn("cluster", F.sum("opens").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    ranked = F.struct((-F.col("dice")).alias("less"), (F.col("begin") - F.col("end")).alias("shorter"), "template", "begin", "end", "license", "passage")
    clusters = windows.groupBy(*key, "cluster").agg(F.array_sort(F.collect_list(ranked)).alias("ranked"))
    taken = F.aggregate(
        "ranked",
        F.slice("ranked", 1, 0),
        lambda kept, x: F.when(F.exists(kept, lambda y: (x.begin <= y.end) & (y.begin <= x.end)), kept).otherwise(F.concat(kept, F.array(x))),
    )
    found = clusters.select(*key, F.explode(taken).alias("x"))
    return found.groupBy(*key, F.col("x.license").alias("license")).agg(
        (-F.min("x.less")).alias("dice"), F.size(F.collect_set("x.passage")).cast("bigint").alias("n_passages")
    ).drop("text_hash")
