"""Licence scan by Dice coefficient over word bigrams (operator 2), DataFrame functions only.

A text is normalised (lower case; every run of other characters than a-z and 0-9 becomes a blank) in three kinds of passages: the whole
text, its paragraphs (between blank lines) and its lines. A passage's distinct word bigrams A are
compared with a template's B: Dice = 2 |A and B| / (|A| + |B|). A Dice of at least ``least`` needs
|B| * least / (2 - least) <= |A| <= |B| * (2 - least) / least, so a passage whose size lies outside these bounds for
every template is dropped before any bigram is compared, and a pair outside them is never counted. Only bigrams
that occur in a template leave a passage. Most notices are the same line over and over, so passages are reduced to their different sets of such bigrams first;
each set meets the templates' bigrams once, in a broadcast join (the template list is a parameter, its size is checked against ``MOST_BIGRAMS``), and the
passages are joined with what their set matches. The best passage of each document and template is returned.

A notice may also stand in the middle of a line. So the longest runs of words of which every two neighbours are a bigram of some template are passages
too (``runs``), wherever they begin and end in the whole text; such a passage is returned in its normalised form. A foreign word inside a notice ends
its run. Runs follow from the places of known bigrams alone, so a text of any length is one row per such place, sorted, and never one large array.

The templates of ``scan_public`` are notices, headers and short texts of common licences in their usual phrasings, and the full texts of long ones
(``licence_list``). A row names the template; a notice is often like templates of a neighbouring version too, and its own has the highest Dice.

Null and empty texts, and passages of fewer than two words, match nothing. Ties between passages go to whole ones before runs, to the shorter passage,
then to the last in order of text. Repeated rows are found once per id; rows of a null id are taken together.
"""

from __future__ import annotations

import re
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopscope.llm.licence_list import MORE, TEXTS
from shopscope.session import stored

LEAST = 0.8
MOST_BIGRAMS = 20_000

#: Opening statements of well-known public licences; ``licence_list`` holds the wider list.
TEMPLATES = {
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "MIT-notice": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "BSD-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "ISC-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "all-rights-reserved": "Copyright. All rights reserved.",
}

#: Words of most English texts tell least of a licence.
COMMON = set("a an and any are as at be by for from in is it may not of on or other that the this to under with you your work project".split())


def bigrams_of(text: str) -> set[str]:
    """Distinct word bigrams of a normalised text; the same as the plan computes."""
    words = re.sub("[^a-z0-9]+", " ", text.translate({k: k + 32 for k in range(65, 91)})).split()
    return {f"{a} {b}" for a, b in zip(words, words[1:])}


def scan(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST, inside: bool = True) -> DataFrame:
    """(doc_id, licence, dice, passage): documents with a passage like a template; ``inside`` looks for runs inside lines as well. Runs a job."""
    sets = {name: bigrams_of(text) for name, text in (TEMPLATES if templates is None else templates).items()}
    sets = {name: found for name, found in sets.items() if found}
    if sum(map(len, sets.values())) > MOST_BIGRAMS:
        raise ValueError(f"templates with more than {MOST_BIGRAMS} bigrams belong in a table of their own")
    if not sets:
        return docs.filter(F.lit(False)).select("doc_id", F.lit("").alias("licence"), F.lit(0.0).alias("dice"), F.lit("").alias("passage"))
    # Whole numbers throughout: rounded bounds would drop passages that lie on them. least is up / down.
    up, down = Fraction(str(least)).as_integer_ratio()
    hits = stored(candidates(docs, sets, up, down, inside), "passages")
    # At most MOST_BIGRAMS rows, checked above.
    wanted = docs.sparkSession.createDataFrame(
        [(name, len(found), b) for name, found in sorted(sets.items()) for b in sorted(found)], "licence string, n_template int, bigram string")
    bags = hits.select("hit", "n_own").distinct()
    pairs = bags.withColumn("bigram", F.explode("hit")).join(F.broadcast(wanted), "bigram").filter(
        (F.col("n_own") * (2 * down - up) >= F.col("n_template") * up) & (F.col("n_own") * up <= F.col("n_template") * (2 * down - up)))
    # A set has each bigram once, so rows are counted.
    counted = pairs.groupBy("hit", "n_own", "licence", "n_template").agg(F.count(F.lit(1)).alias("common"))
    alike = counted.filter(F.col("common") * (2 * down) >= (F.col("n_own") + F.col("n_template")) * up)
    dice = alike.select("hit", "n_own", "licence", (2.0 * F.col("common") / (F.col("n_own") + F.col("n_template"))).alias("dice"))
    best = F.max_by("passage", F.struct(F.col("dice"), F.col("whole"), -F.length("passage"), F.col("passage")))
    return hits.join(dice, ["hit", "n_own"]).groupBy("doc_id", "licence").agg(F.max("dice").alias("dice"), best.alias("passage"))


def candidates(docs: DataFrame, sets: dict[str, set[str]], up: int, down: int, inside: bool) -> DataFrame:
    """(doc_id, whole, passage, n_own, hit): passages with bigrams enough, how many they have, and those in templates, sorted."""
    texts = docs.select(F.col("doc_id"), F.col("text").alias("text"))
    low = -(-min(len(s) for s in sets.values()) * up // (2 * down - up))
    high = max(len(s) for s in sets.values()) * (2 * down - up) // up
    lines = F.split("text", "\n")
    paragraphs = F.split("text", r"\n[ \t\r]*\n")
    passages = F.array_distinct(F.concat(lines, paragraphs, F.array("text")))
    cut = texts.filter("text IS NOT NULL").select("doc_id", F.explode(passages).alias("passage"))
    # Bounds first: a bigram takes at least three characters with the blank that parts it from the next one.
    cut = cut.filter(F.length("passage") >= 2 * low)
    cut = cut.select("doc_id", "passage", _once(_words("passage")).alias("words"))
    # A passage of many words may still repeat few bigrams, so only the lower bound holds for words.
    cut = cut.filter(F.size("words") > max(1, low))
    # Without a telling word of a template there is no match; this spares most passages the bigrams.
    telling = _constants(_telling_words(sets, up, down))
    cut = cut.filter(F.arrays_overlap("words", telling))
    pairs = F.transform(F.sequence(F.lit(0), F.size("words") - 2), lambda k: F.concat_ws(" ", F.get("words", k), F.get("words", k + 1)))
    cut = cut.select("doc_id", "passage", _once(F.array_distinct(pairs)).alias("own")).filter(F.size("own").between(low, high))
    known = _constants(sorted(set().union(*sets.values())))
    hits = cut.select("doc_id", F.lit(True).alias("whole"), "passage", F.size("own").alias("n_own"), _once(F.array_intersect("own", known)).alias("hit"))
    # As template >= common, a match also has common >= own * least / (2 - least); other passages need not be joined.
    hits = hits.filter(F.size("hit") * (2 * down - up) >= F.col("n_own") * up)
    if inside:
        hits = hits.unionByName(runs(texts, sets, telling, low, high).withColumn("whole", F.lit(False)))
    return hits.withColumn("hit", F.array_sort("hit"))


def scan_public(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """``scan`` for the whole list: ``TEMPLATES``, the notices of ``licence_list`` and its full texts.

    Only long passages are compared with the full texts, so these are scanned for by themselves, and not inside lines.
    """
    return scan(docs, {**TEMPLATES, **MORE}, least).union(scan(docs, TEXTS, least, inside=False))


def runs(texts: DataFrame, sets: dict[str, set[str]], telling: Column, low: int, high: int) -> DataFrame:
    """(doc_id, passage, n_own, hit): the longest runs of words whose bigrams all occur in templates, of ``low`` to ``high`` different bigrams."""
    spark = texts.sparkSession
    # A text that repeats in rows of one id is the same text; rows of a null id are told apart by their text.
    found = texts.filter("text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("key"), _once(_words("text")).alias("words"))
    found = found.filter((F.size("words") > low) & F.arrays_overlap("words", telling))
    # Words and their followers side by side: one row per place.
    follow = F.arrays_zip(F.col("words").alias("a"), F.slice("words", F.lit(2), F.size("words")).alias("b"))
    places = found.select("doc_id", "key", F.posexplode(follow).alias("pos", "w")).select(
        "doc_id", "key", "pos", F.col("w.a").alias("a"), F.concat_ws(" ", "w.a", "w.b").alias("bigram"))
    # At most MOST_BIGRAMS rows, checked by the caller.
    known = spark.createDataFrame([(b,) for b in sorted(set().union(*sets.values()))], "known string")
    places = places.join(F.broadcast(known), F.col("bigram") == F.col("known"), "left_semi")
    # Places that follow one another have the same distance from their rank; a repeated row has the ranks of the first.
    rank = F.dense_rank().over(Window.partitionBy("doc_id", "key").orderBy("pos"))
    own = F.collect_set("bigram")
    run = places.withColumn("run", F.col("pos") - rank).groupBy("doc_id", "key", "run").agg(
        own.alias("hit"), F.array_sort(F.collect_set(F.struct("pos", "a"))).alias("way"), F.max_by("bigram", "pos").alias("last"))
    run = run.filter(F.size("hit").between(low, high))
    passage = F.concat_ws(" ", F.transform("way", lambda w: w["a"]), F.element_at(F.split("last", " "), -1))
    return run.select("doc_id", passage.alias("passage"), F.size("hit").alias("n_own"), "hit")


def _words(text: str) -> Column:
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.split(F.trim(F.regexp_replace(lower, "[^a-z0-9]+", " ")), " ")


def _once(value: Column) -> Column:
    """Exploding a one-element array computes an expression once, however often later steps use it."""
    return F.explode(F.array(value))


def _constants(values: list[str]) -> Column:
    """An array of words or bigrams as one constant; as many literals would take seconds to plan."""
    return F.split(F.lit("\n".join(values)), "\n")


def _telling_words(sets: dict[str, set[str]], up: int, down: int) -> list[str]:
    """Words of which every template has at least one in so many bigrams that no match can do without them all.

    For each template, its longest words, common ones last, are taken until the bigrams without any of them are too few for a match.
    """
    taken: set[str] = set()
    for found in sets.values():
        words = sorted({w for b in found for w in b.split()}, key=lambda w: (w in COMMON, -len(w), w))
        left = [b.split() for b in found]
        for word in words:
            # A match has 2 * common >= least * (own + template) and own >= common, so common >= template * least / (2 - least), least being up / down.
            if len(left) * (2 * down - up) < len(found) * up:
                break
            taken.add(word)
            left = [pair for pair in left if word not in pair]
    return sorted(taken)
