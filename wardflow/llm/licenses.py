"""License scans: an exact set-similarity join of text blocks with licence templates.

Only DataFrame functions. A block is a sentence, or one of the half-overlapping runs of ``LONG``
words of a longer one. It is found for a template if it holds at least ``CONTAINMENT`` of the
template's distinct words. All words of the templates are counted over all texts and ordered from
rare to frequent. Of t distinct words, n of which must be shared, the t - n + 1 rarest form the
template's prefix: a block without a word of any prefix cannot match. The others are spread by
their words and hash-joined with the prefixes. The length filter asks for n known words in the
block, the prefix filter on its side for a word among all but the last n - 1 of them, the
positional filter for enough words behind the place where both meet. What passes is compared as
sets, once per pair: at the rarest word that both share.

Words that no template holds can't be shared, so they are left out of blocks beforehand; this
changes no intersection. Templates that differ in a version or a clause form a family: of these, a
block takes the one of which it holds the greatest part, and of these the one with most words.

Defined cases: NULL and empty texts have no words, no labels and score 0; rows that repeat a
document are each judged; an empty table gives no rows. Texts are cut whole, so a row takes about
sixty bytes per word of its text in one task. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.staging import ascii_lower, let, staged

#: What parts words of lower-cased texts, and what ends a sentence.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SENTENCE_END = r"[.!?;:]+[\x20\x09-\x0D]+|\n[\x20\x09\x0D]*\n"
#: Words of the longest block; a passage of half as many always lies whole in one.
LONG = 256
CONTAINMENT = 0.9
#: Templates may hold so many different words; they are written into the plan (about 1 MB).
MOST_WORDS = 20_000

# Phrases that name a licence wherever their words stand one after the other.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Sentences of common licences and notices, with family and label.
TEMPLATES = (
    ("mit", "mit", "Released under the MIT License"),
    ("mit", "mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of "
     "this software and associated documentation files (the \"Software\"), to deal in the Software "
     "without restriction, including without limitation the rights to use, copy, modify, merge, "
     "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
     "whom the Software is furnished to do so, subject to the following conditions"),
    ("apache", "apache-2", "Licensed under the Apache License, Version 2.0"),
    ("apache", "apache-2", "You may not use this file except in compliance with the License"),
    ("gpl", "gpl-2", "licensed under the GNU General Public License, version 2"),
    ("gpl", "gpl-3", "licensed under the GNU General Public License, version 3"),
    ("gpl", "gpl", "This program is free software: you can redistribute it and/or modify it under "
     "the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("gpl", "lgpl", "This library is free software: you can redistribute it and/or modify it under "
     "the terms of the GNU Lesser General Public License as published by the Free Software "
     "Foundation"),
    ("gpl", "agpl", "This program is free software: you can redistribute it and/or modify it under "
     "the terms of the GNU Affero General Public License as published by the Free Software "
     "Foundation"),
    ("bsd", "bsd", "Redistribution and use in source and binary forms, with or without modification, "
     "are permitted provided that the following conditions are met"),
    ("isc", "isc", "Permission to use, copy, modify, and/or distribute this software for any purpose "
     "with or without fee is hereby granted, provided that the above copyright notice and this "
     "permission notice appear in all copies"),
    ("mpl", "mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("cc", "cc-by", "licensed under a Creative Commons Attribution International License"),
    ("cc", "cc-by-sa", "licensed under a Creative Commons Attribution ShareAlike International "
     "License"),
    ("cc", "cc-by-nc", "licensed under a Creative Commons Attribution NonCommercial International "
     "License"),
    ("cc", "cc-by-nc-sa", "licensed under a Creative Commons Attribution NonCommercial ShareAlike "
     "International License"),
    ("cc", "cc-by", "licensed under CC BY 4.0"),
    ("cc", "cc-by-sa", "licensed under CC BY SA 4.0"),
    ("cc", "cc-by-nc", "licensed under CC BY NC 4.0"),
    ("public", "unlicense", "This is free and unencumbered software released into the public "
     "domain"),
    ("zlib", "zlib", "This software is provided as-is, without any express or implied warranty"),
)


def words(text: Column) -> Column:
    """The words of a text in order, A to Z lower-cased; none for NULL."""
    cut = F.filter(F.split(ascii_lower(text), BETWEEN), lambda w: w != "")
    return F.coalesce(cut, F.array().cast("array<string>"))


def _templates(df: DataFrame, templates: Sequence[tuple[str, str, str]], containment: float
               ) -> DataFrame:
    """``family, label``, distinct words ``known`` and ``need``, how many a block must hold."""
    rows = df.sparkSession.createDataFrame(list(templates), "family string, label string, text string")
    cut = rows.select("family", "label", F.array_distinct(words(F.col("text"))).alias("known"))
    need = F.greatest(F.lit(1), F.ceil(F.size("known") * F.lit(containment) - F.lit(1e-9)).cast("int"))
    return cut.filter(F.size("known") > 0).dropDuplicates().withColumn("need", need)


def word_order(documents: DataFrame, vocabulary: Sequence[str]) -> list[str]:
    """``vocabulary`` from rare to frequent over all texts, equal ones by code point."""
    if not vocabulary:
        return []
    every = documents.select(F.explode(words(F.col("text"))).alias("word"))
    counts = every.filter(F.col("word").isin(*vocabulary)).groupBy("word").count()
    known = {r["word"]: r["count"] for r in counts.collect()}
    return sorted(vocabulary, key=lambda w: (known.get(w, 0), w))


def _starts(known: Column, phrase: str) -> Column:
    """Where the phrase's words stand one after the other."""
    parts = phrase.split(" ")
    whole = F.array(*[F.lit(p) for p in parts])
    last = F.size(known) - len(parts)
    every = F.filter(F.sequence(F.lit(0), last), lambda i: (F.get(known, i) == parts[0])
                     & (F.slice(known, i + 1, len(parts)) == whole))
    return F.when((last >= 0) & F.array_contains(known, parts[0]), every).otherwise(
        F.array().cast("array<int>"))


def _blocks(text: Column, vocabulary: Sequence[str], prefixes: Sequence[str]) -> Column:
    """Distinct template words of each block that holds a word of a prefix."""
    def cut(sentence: Column) -> Column:
        return let(words(sentence), lambda known: F.when(F.size(known) <= LONG, F.array(known))
                   .otherwise(F.transform(F.sequence(F.lit(1), F.size(known), F.lit(LONG // 2)),
                                          lambda i: F.slice(known, i, LONG))))

    runs = F.flatten(F.transform(F.split(text, SENTENCE_END), cut))
    known = F.transform(runs, lambda run: F.array_distinct(
        F.filter(run, lambda w: w.isin(*vocabulary))))
    return F.array_distinct(F.filter(known, lambda run: F.exists(run, lambda w: w.isin(*prefixes))))


def _joined(scans: DataFrame, templates: DataFrame, order: list[str]) -> DataFrame:
    """``key, block, family, label, containment, n_shared`` of all pairs that meet the threshold."""
    ranks = F.array(*[F.lit(w) for w in order])

    def coded(known: Column) -> Column:
        return F.array_sort(F.transform(known, lambda w: F.array_position(ranks, w)))

    sets = staged(templates.withColumn("codes", coded(F.col("known"))).drop("known"), "templates")
    size = F.size("codes")
    index = sets.select(
        "*", F.posexplode(F.slice("codes", F.lit(1), size - F.col("need") + 1)).alias("j", "code"))
    blocks = scans.select("key", F.posexplode("blocks").alias("block", "known")).select(
        "key", "block", coded(F.col("known")).alias("held"))
    spread = blocks.select("*", F.posexplode("held").alias("i", "word"))
    n_held = F.size("held")
    behind = F.least(n_held - F.col("i"), size - F.col("j"))
    met = spread.join(index, F.col("word") == F.col("code")).filter(
        (n_held >= F.col("need")) & (F.col("i") <= n_held - F.col("need")) & (behind >= F.col("need")))
    shared = met.withColumn("shared", F.array_intersect("held", "codes"))
    return (shared.filter((F.array_min("shared") == F.col("word"))
                          & (F.size("shared") >= F.col("need")))
            .select("key", "block", "family", "label", (F.size("shared") / size).alias("containment"),
                    F.size("shared").alias("n_shared")))


def license_blocks(documents: DataFrame, templates: Sequence[tuple[str, str, str]] = TEMPLATES,
                   phrases: Mapping[str, str] = PHRASES, containment: float = CONTAINMENT
                   ) -> tuple[DataFrame, DataFrame]:
    """The scan of all rows, and the pairs of block and template that were found in them.

    Scan: ``key, doc_id, n_words``, ``starts`` (per phrase), ``blocks``. Pairs: ``key, block,
    family, label, containment, n_shared``, of each family those held most.
    """
    sets = _templates(documents, templates, containment)
    few = sets.collect()
    vocabulary = sorted({w for t in few for w in t["known"]})
    if len(vocabulary) > MOST_WORDS:
        raise ValueError(f"templates of more than {MOST_WORDS} different words")
    order = word_order(documents, vocabulary)
    place = {w: i for i, w in enumerate(order)}
    prefixes = sorted({w for t in few for w in sorted(t["known"], key=place.get)[
        :len(t["known"]) - t["need"] + 1]})
    cut = documents.select("doc_id", "text", words(F.col("text")).alias("words"))
    none = F.array().cast("array<array<string>>")
    held = F.when(F.exists("words", lambda w: w.isin(*prefixes)),
                  _blocks(F.col("text"), vocabulary, prefixes)).otherwise(none) if prefixes else none
    starts = F.array(*[_starts(F.col("words"), p) for p in phrases]) if phrases else (
        F.array().cast("array<array<int>>"))
    scans = staged(cut.select(
        F.monotonically_increasing_id().alias("key"), "doc_id",
        F.size("words").cast("long").alias("n_words"), starts.alias("starts"),
        held.alias("blocks")), "scans")
    pairs = _joined(scans.filter(F.size("blocks") > 0), sets, order)
    held = F.struct("containment", "n_shared")
    best = (pairs.groupBy("key", "block", "family", held.alias("held"))
            .agg(F.collect_set("label").alias("labels"))
            .groupBy("key", "block", "family").agg(F.max(F.struct("held", "labels")).alias("top")))
    return scans, best.select("key", "block", "family", F.explode("top.labels").alias("label"),
                              "top.held.containment", "top.held.n_shared")


def scanned(documents: DataFrame, templates: Sequence[tuple[str, str, str]] = TEMPLATES,
            phrases: Mapping[str, str] = PHRASES, containment: float = CONTAINMENT) -> DataFrame:
    """One row per document: base places of the phrases, and the labels of both ways.

    ``score`` is 1 where a phrase stands, else the greatest containment found, 0 without any.
    """
    scans, pairs = license_blocks(documents, templates, phrases, containment)
    found = staged(pairs.groupBy("key").agg(F.collect_set("label").alias("found"),
                                            F.max("containment").alias("most")), "found")
    names = F.array(*[F.lit(label) for label in phrases.values()]) if phrases else (
        F.array().cast("array<string>"))
    base = F.array_sort(F.array_distinct(F.transform(F.filter(
        F.arrays_zip("starts", names.alias("names")), lambda x: F.size(x["starts"]) > 0),
        lambda x: x["names"])))
    every = F.flatten("starts")
    joined = scans.withColumn("base", base).join(
        found.withColumnRenamed("key", "_key"), F.col("key") == F.col("_key"), "left")
    labels = F.array_sort(F.array_union("base", F.coalesce(
        "found", F.array().cast("array<string>"))))
    return joined.select(
        "doc_id", "n_words", F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.when(F.size(every) > 0, 1.0).otherwise(F.coalesce("most", F.lit(0.0))).alias("score"))
