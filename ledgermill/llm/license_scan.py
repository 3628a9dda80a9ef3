"""License scans by an exact set-similarity join of text blocks with license templates.

A block is ``block_words`` consecutive words of a text; blocks start at every multiple of half that, so every passage up to half a block
lies whole in one. A block meets a template if it contains at least ``percent`` of its distinct words. The join:

* Words are ordered by their number in all documents, rarest first. Words of no template never match and are left out of blocks.
* Prefix filter: for an overlap of a words, block and template share a word among the first ``size - a + 1`` of each. Whole texts without
  any template's prefix word are put aside in the first reading.
* Length filter: a block with fewer than a template words is out. Positional filter: after a match at positions i and j no more than the shorter rest can follow.
* What is left is verified by counting the words in common.

Only DataFrame functions are used. The index of prefix words holds a few words a template and is broadcast: its size follows from the templates given, not from the
data. Texts that occur several times are scanned once; their rows meet the result by ``join_hot``.

Defined results: a null text has no words, no labels and score 0. Repeated rows give a row each. An empty table gives no rows; columns other than
the two named ones are left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import HOT_SHARE, join_hot, stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words: ASCII other than digits and lower-case letters.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases that label a text by themselves.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))
#: Usual license notices and their labels.
TEMPLATES = (
    ("This work is licensed under the GNU General Public License, version 3", "gpl"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License", "gpl"),
    ("under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", "lgpl"),
    ("under the terms of the GNU Affero General Public License as published by the Free Software Foundation", "agpl"),
    ("Licensed under the Apache License, Version 2.0", "apache"),
    ("Licensed under CC BY 4.0", "cc-by"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
    ("Released under the MIT License", "mit"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "bsd"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mpl"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("This is free and unencumbered software released into the public domain", "unlicense"),
    ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work", "cc0"),
)
PERCENT, BLOCK_WORDS = 80, 64


def words_of(text: str) -> list[str]:
    """Words of a template or phrase."""
    lower = text.translate(str.maketrans(UPPER, LOWER))
    return "".join(c if not c.isascii() or c.isdigit() or c in LOWER else " " for c in lower).split(" ")


def template_words(text: str) -> list[str]:
    return list(dict.fromkeys(w for w in words_of(text) if w))


def least_overlap(size: int, percent: int) -> int:
    return max(1, -(-percent * size // 100))


def _plain(text: str) -> Column:
    """The text's words with one space between."""
    lower = F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), UPPER, LOWER)
    return F.trim(F.regexp_replace(lower, NO_WORD, " "))


def _words(plain: Column) -> Column:
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def _literals(words: Sequence[str]) -> Column:
    return F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>")


def word_counts(docs: DataFrame, words: Sequence[str], text: str = "text") -> dict[str, int]:
    """How often each of ``words`` occurs in all texts."""
    rows = docs.select(F.explode(_words(_plain(text))).alias("word")).where(F.col("word").isin(list(words)))
    counts = dict.fromkeys(words, 0)
    return counts | {r.word: r.n for r in rows.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}


def _places(words: Column, phrase: Sequence[str]) -> Column:
    """Where the phrase's words stand consecutively, from 0."""
    here = lambda w, i: reduce(lambda a, b: a & b, [F.get(words, i + k) == p for k, p in enumerate(phrase) if k], w == phrase[0])
    return F.filter(F.transform(words, lambda w, i: F.when(here(w, i), i)), lambda at: at.isNotNull())


class Templates:
    """Templates with their words in the corpus's order, rarest first."""

    def __init__(self, templates: Sequence[tuple[str, str]], counts: dict[str, int], percent: int):
        order = sorted(counts, key=lambda w: (counts[w], w))
        rank = {w: k for k, w in enumerate(order)}
        self.order, self.labels = order, [label for _, label in templates]
        self.words = [sorted(template_words(text), key=rank.__getitem__) for text, _ in templates]
        self.least = [least_overlap(len(w), percent) for w in self.words]

    def prefixes(self) -> list[tuple[str, int, int, int, int]]:
        """(word, template, position, size, least overlap) of every prefix word."""
        return [(w, t, i, len(words), a) for t, (words, a) in enumerate(zip(self.words, self.least)) for i, w in enumerate(words[:len(words) - a + 1])]


def blocks_found(texts: DataFrame, templates: Templates, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(key, start, template, label, containment) of every block of ``texts`` (key, words) that meets a template."""
    spark = texts.sparkSession
    index = spark.createDataFrame(templates.prefixes(), "word string, template int, at int, size int, least int")
    rows = [(t, label, words, a) for t, (label, words, a) in enumerate(zip(templates.labels, templates.words, templates.least))]
    whole = spark.createDataFrame(rows, "template int, label string, template_words array<string>, least int")
    starts = texts.where(F.size("words") > 0).select("key", "words", F.explode(F.sequence(F.lit(0), F.size("words") - 1, F.lit(block_words // 2))).alias("start"))
    # in the order of the first array: the corpus's order
    blocks = starts.select("key", "start", F.array_intersect(_literals(templates.order), F.slice("words", F.col("start") + 1, block_words)).alias("own"))
    probes = blocks.select("key", "start", "own", F.posexplode("own").alias("j", "word"))
    n = F.size("own")
    hits = probes.join(F.broadcast(index), "word").where(
        (n >= F.col("least")) & (F.col("j") <= n - F.col("least"))
        & (1 + F.least(F.col("size") - F.col("at") - 1, n - F.col("j") - 1) >= F.col("least")))
    pairs = hits.groupBy("key", "start", "template").agg(F.first("own").alias("own"))
    common = F.size(F.array_intersect("own", "template_words"))
    verified = pairs.join(F.broadcast(whole), "template").where(common >= F.col("least"))
    return verified.select("key", "start", "template", "label", (common / F.size("template_words")).alias("containment"))


def scan(
    docs: DataFrame, phrases: Sequence[tuple[str, str]] = PHRASES, templates: Sequence[tuple[str, str]] = TEMPLATES, percent: int = PERCENT,
    block_words: int = BLOCK_WORDS, id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Per document: n_words, places of phrases (n_base, first_word, last_word), base_labels, labels and score.

    ``labels`` adds those of the templates met by a block. The score is 1 where a phrase stands, else the highest containment of a block that
    meets a template, else 0.
    """
    longest = max((len(template_words(t)) for t, _ in templates), default=0)
    if longest > block_words // 2:
        raise ValueError(f"templates may have up to {block_words // 2} distinct words")
    names = sorted({w for t, _ in templates for w in template_words(t)})
    ranked = Templates(templates, word_counts(docs, names, text), percent)
    split = [([w for w in words_of(p) if w], label) for p, label in phrases]

    rows = docs.select(F.col(id_column).alias("_id"), F.col(text).cast("string").alias("_text"))
    rows = rows.withColumn("_plain", _plain("_text")).withColumn("_all", _words(F.col("_plain")))
    padded = F.concat(F.lit(" "), F.col("_plain"), F.lit(" "))
    has_phrase = reduce(lambda a, b: a | b, [padded.contains(f" {' '.join(words)} ") for words, _ in split], F.lit(False))
    has_prefix = F.arrays_overlap(F.col("_all"), _literals(sorted({p[0] for p in ranked.prefixes()}))) if templates else F.lit(False)
    rows = rows.select("_id", F.size("_all").cast("long").alias("n_words"), has_phrase.alias("_phrase"), F.when(has_phrase | F.coalesce(has_prefix, F.lit(False)), F.struct(
        F.sha2(F.col("_text").cast("binary"), 256).alias("key"), F.col("_all").alias("words"))).alias("_found"))
    rows = stage(rows, "license-texts")
    plain = rows.where(F.col("_found").isNull()).select("_id", "n_words")
    some = rows.where(F.col("_found").isNotNull()).select("_id", "n_words", F.col("_found.key").alias("key"))

    texts = rows.where(F.col("_found").isNotNull()).groupBy(F.col("_found.key").alias("key")).agg(
        F.count(F.lit(1)).alias("_n"), F.first("_found.words").alias("words"), F.first("_phrase").alias("_phrase"))
    texts = stage(texts, "license-distinct")
    met = blocks_found(texts, ranked, block_words).groupBy("key").agg(F.collect_set("label").alias("_met"), F.max("containment").alias("_best"))
    labelled = [(_places(F.col("words"), words), label) for words, label in split]
    none = F.array().cast("array<int>")
    places = F.when(F.col("_phrase"), F.flatten(F.array(*[p for p, _ in labelled]))).otherwise(none) if split else none
    base = F.when(F.col("_phrase"), F.array_compact(F.array(*[F.when(F.size(p) > 0, label) for p, label in labelled]))).otherwise(F.array().cast("array<string>")) if split else F.array().cast("array<string>")
    judged = texts.select("key", "_n", places.alias("_places"), F.array_sort(F.array_distinct(base)).alias("_base")).join(met, "key", "left")
    total = sum(r[0] or 0 for r in texts.agg(F.sum("_n")).collect())
    labels = F.array_sort(F.array_union("_base", F.coalesce("_met", F.array().cast("array<string>"))))
    judged = judged.select(
        "key", "_n", F.size("_places").cast("long").alias("n_base"), F.array_min("_places").cast("long").alias("first_word"), F.array_max("_places").cast("long").alias("last_word"),
        F.concat_ws(",", "_base").alias("base_labels"), F.concat_ws(",", labels).alias("labels"),
        F.when(F.size("_places") > 0, 1.0).otherwise(F.coalesce("_best", F.lit(0.0))).alias("score"))
    found = join_hot(some, judged, "key", F.col("_n") > total * HOT_SHARE)
    result = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    unknown = F.lit(None).cast("long")
    plain = plain.select("_id", "n_words", F.lit(0).cast("long").alias("n_base"), unknown.alias("first_word"), unknown.alias("last_word"), F.lit("").alias("base_labels"), F.lit("").alias("labels"), F.lit(0.0).alias("score"))
    return found.select("_id", *result).unionByName(plain).withColumnRenamed("_id", id_column)
