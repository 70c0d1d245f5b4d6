"""License scans (operator 7) by a positional rare-token index, in DataFrame
expressions only.

The index holds, for each mandatory phrase of each licence template, the
``RARE`` words of highest IDF (document frequencies counted over the whole
table) with their positions in the template; the phrase's other words are never
looked up.  All their places in a file vote for (template, place of its first
word), and a place needs votes from two different template positions (from one,
if a phrase of the template has only one indexed word).  A candidate counts when a mandatory phrase of
its template stands at the expected words.  Its score is the share of the
template's words found in place.

A phrase that stands in a file brings its own rare words, in place, whatever
else the file holds; so no place is lost, however many licence words a file
has.

Base labels come from three phrases wherever their words stand in a row.

Defined results: a null or empty text has no words, labels or score; null ids
and repeated rows are scanned like others; an empty table gives an empty
result; very long texts are scanned whole, their words in one row; other
columns are not read."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import columns_or_null, let, lower_ascii, staged

# Phrases of the base labels.
BASE = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}

# Label, mandatory phrases (one must stand in place), text.
TEMPLATES = [
    ("mit", ["mit license"], "released under the mit license"),
    ("mit", ["mit license"], "licensed under the mit license"),
    ("mit", ["permission is hereby granted free of charge", "without warranty of any kind"],
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction including without limitation the "
     "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
     "persons to whom the software is furnished to do so subject to the following conditions the above copyright "
     "notice and this permission notice shall be included in all copies or substantial portions of the software the "
     "software is provided as is without warranty of any kind express or implied including but not limited to the "
     "warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the "
     "authors or copyright holders be liable for any claim damages or other liability whether in an action of contract "
     "tort or otherwise arising from out of or in connection with the software or the use or other dealings in the "
     "software"),
    ("apache", ["apache license"], "licensed under the apache license version 2 0"),
    ("apache", ["apache license", "in compliance with the license"],
     "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
     "the license you may obtain a copy of the license at"),
    ("gpl", ["general public license"], "licensed under the gnu general public license version 3"),
    ("gpl", ["terms of the gnu general public license"],
     "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation either version"),
    ("lgpl", ["lesser general public license"], "licensed under the gnu lesser general public license"),
    ("agpl", ["affero general public license"], "licensed under the gnu affero general public license"),
    ("mpl", ["mozilla public license"],
     "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("bsd", ["redistribution and use in source and binary forms"],
     "redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met"),
    ("isc", ["permission to use copy modify and or distribute this software"],
     "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted"),
    ("cc-by", ["cc by 4"], "licensed under cc by 4 0"),
    ("cc-by", ["cc by 3"], "licensed under cc by 3 0"),
    ("cc-by-sa", ["cc by sa"], "licensed under cc by sa 4 0"),
    ("cc-by-nc", ["cc by nc"], "licensed under cc by nc 4 0"),
    ("cc-by-nd", ["cc by nd"], "licensed under cc by nd 4 0"),
    ("cc-by", ["creative commons attribution"], "licensed under a creative commons attribution 4 0 license"),
    ("unlicense", ["released into the public domain"],
     "this is free and unencumbered software released into the public domain"),
]

# Words that are not indexed.
STOP = frozenset("a an and any are as at be by for from in into is it of on or that the this to under with you".split())

#: Rarest words looked up per phrase; a phrase that stands in a file holds
#: them all, so two lose no place.
RARE = 2
_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def licence_words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), _BREAKS, -1), "")


def vocabulary(templates=TEMPLATES) -> list[str]:
    """Indexed words, those of the mandatory phrases; the base phrases are
    among them."""
    return sorted({w for _, phrases, _ in templates for p in phrases for w in p.split()} - STOP)


def _indexed(phrase: list[str]) -> dict[str, int]:
    """First position of each indexed word of a phrase."""
    return {w: j for j, w in reversed(list(enumerate(phrase))) if w not in STOP}


def checked(templates) -> list:
    """The templates, each of whose phrases must stand in its text and hold an
    indexed word."""
    for label, phrases, text in templates:
        for p in phrases:
            if not _phrase_places([p], text.split()) or not _indexed(p.split()):
                raise ValueError(f"{label}: phrase '{p}' cannot be looked up in its template")
    return list(templates)


def _votes_needed(phrases: list[str]) -> int:
    return min(2, *[len(_indexed(p.split())) for p in phrases], 2)


def _phrase_at(words: Column, start: Column, phrase: list[str]) -> Column:
    same = F.get(words, start) == phrase[0]
    for j, word in enumerate(phrase[1:], 1):
        same = same & (F.get(words, start + j) == word)
    return same


def _base_places(words: Column) -> Column:
    """Structs (at, label) of all base places, in order."""
    def place(i):
        label = F
        for name, phrase in BASE.items():
            label = label.when(_phrase_at(words, i, phrase.split()), F.lit(name))
        return F.struct(i.alias("at"), label.alias("label"))
    return F.filter(F.transform(F.sequence(F.lit(0), F.size(words) - 1), place), lambda x: x["label"].isNotNull())


def _scanned(docs: DataFrame, templates) -> DataFrame:
    """One pass over the texts.  The words of a file are kept only if it has
    as many different indexed words as the base phrases (two) and every
    mandatory phrase hold."""
    known = sorted({*vocabulary(templates), *(w for p in BASE.values() for w in p.split())})
    least = min(2, *[_votes_needed(phrases) for _, phrases, _ in templates], 2)
    base_type = "array<struct<at:int,label:string>>"
    df = columns_or_null(docs, doc_id="long", text="string").select("doc_id", licence_words(F.col("text")).alias("w"))
    df = df.select("doc_id", F.size("w").cast("long").alias("n_words"), "w", F.when(
        F.exists("w", lambda w: w.isin(known)), F.array_distinct(F.filter("w", lambda w: w.isin(known)))).alias("mine"))
    df = df.withColumn("w", F.when(F.size("mine") >= least, F.col("w")))
    return staged(df.select(
        F.monotonically_increasing_id().alias("uid"), "doc_id", "n_words", "w", "mine",
        F.coalesce(let(F.col("w"), lambda w: F.when(F.array_contains(w, "license"), _base_places(w))),
                   F.array().cast(base_type)).alias("base")), "licence-words")


def _phrase_places(phrases: list[str], words: list[str]) -> list[tuple[int, list[str]]]:
    """(place in the template, words) of the mandatory phrases."""
    split = [p.split() for p in phrases]
    return [(i, p) for p in split for i in range(len(words)) if words[i:i + len(p)] == p]


def candidates(files: DataFrame, templates=TEMPLATES, rare: int = RARE) -> DataFrame:
    """(uid, template, start) that enough rare words of a mandatory phrase
    agree on."""
    spark = files.sparkSession
    hit = files.filter(F.col("w").isNotNull())
    n = files.count()
    # as many rows as there are indexed words
    df = {r.word: r["count"] for r in files.select(F.explode("mine").alias("word")).groupBy("word").count().collect()}
    postings = set()
    for t, (_, phrases, text) in enumerate(templates):
        for i, phrase in _phrase_places(phrases, text.split()):
            own = _indexed(phrase)
            if own.keys() - df.keys():
                continue  # in no file
            by_idf = sorted(own, key=lambda w: (-math.log((n + 1) / (df[w] + 1)), w))
            postings |= {(t, i + own[w], w, _votes_needed(phrases)) for w in by_idf[:max(rare, 2)]}
    if not postings:
        return spark.createDataFrame([], "uid long, template int, start int")
    looked_up = sorted({w for _, _, w, _ in postings})
    places = hit.select("uid", F.posexplode("w").alias("at", "word")).filter(F.col("word").isin(looked_up))
    index = spark.createDataFrame(sorted(postings), "template int, place int, word string, need int")  # fixed by the templates
    return (places.join(F.broadcast(index), "word")
            .groupBy("uid", "template", (F.col("at") - F.col("place")).alias("start"))
            .agg(F.countDistinct("place").alias("votes"), F.min("need").alias("need"))
            .filter(F.col("votes") >= F.col("need"))
            .select("uid", "template", "start"))


def verified(files: DataFrame, found: DataFrame, templates=TEMPLATES) -> DataFrame:
    """(uid, label, score) of the candidates with a mandatory phrase in
    place."""
    rows = []
    for t, (label, phrases, text) in enumerate(templates):
        words = text.split()
        at = _phrase_places(phrases, words)
        rows.append((t, label, words, [p for _, p in at], [i for i, _ in at]))
    table = files.sparkSession.createDataFrame(
        rows, "template int, label string, words array<string>, phrases array<array<string>>, at array<int>")
    there = lambda words, i, phrase: F.slice(
        words, F.greatest(i, F.lit(0)) + 1, F.size(phrase)) == phrase
    both = (found.join(F.broadcast(table), "template").join(files.select("uid", "w"), "uid"))
    ok = F.exists(F.arrays_zip("phrases", "at"), lambda x: (F.col("start") + x["at"] >= 0) & there(
        F.col("w"), F.col("start") + x["at"], x["phrases"]))
    match = F.transform("words", lambda w, i: F.when(
        (F.col("start") + i >= 0) & (F.get(F.col("w"), F.col("start") + i) == w), 1).otherwise(0))
    share = F.aggregate(match, F.lit(0), lambda a, x: a + x) / F.size("words")
    return both.filter(ok).select("uid", "label", share.cast("double").alias("score"))


def scan_licenses(docs: DataFrame, templates=TEMPLATES, rare: int = RARE) -> DataFrame:
    """One row per document: n_words, n_base, first_word, last_word,
    base_labels, labels, score."""
    templates = checked(templates)
    files = _scanned(docs, templates)
    found = verified(files, candidates(files, templates, rare), templates)
    best = found.groupBy("uid").agg(F.collect_set("label").alias("more"), F.max("score").alias("score"))
    base = F.array_sort(F.array_distinct(F.transform("base", lambda x: x["label"])))
    return files.drop("w", "mine").join(best, "uid", "left").select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.get("base", F.lit(0))["at"].cast("long").alias("first_word"),
        F.get("base", F.size("base") - 1)["at"].cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.coalesce("more", F.array().cast("array<string>")))), ",")
        .alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
