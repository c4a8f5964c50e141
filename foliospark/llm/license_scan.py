"""License notices by an exact set-similarity join of text blocks with license templates.

A text block is a line, or three lines in a row; a template meets it when at least ``CONTAINED`` of the template's distinct words
are in it. Words are put in the order of their document frequency in the corpus, rare ones first. Of a template of size t that needs o common words, the first
common word is among its first t - o + 1 words, so only these are in the index (prefix filter). A block needs o words of the
templates' vocabulary (length filter), and o of them from that first common word on (positional filter). What is left is counted.
All pairs of such a block and a template that meet the threshold are found; a notice wrapped so narrowly that no three lines hold enough of it is not.

Templates are a fixed, small table (``TEMPLATES``); their index is a literal in the plan, so each document is scanned where it lies. Besides,
three phrases are looked up word by word. Nulls are empty texts; an empty text has no words, places or labels and score 0; repeated rows are scanned each. Very long texts are
scanned whole, in one row. An empty table gives no rows. Added columns replace input columns of the same name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import keeps_columns, text_or_empty

CONTAINED = 0.9
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Notices as their licenses print them.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("all-rights-reserved", "All rights reserved"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def template_words(text: str) -> list[str]:
    """Distinct words, by the same rule as the documents'."""
    import re

    return sorted(set(re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER)))))


def line_words(text: Column) -> Column:
    """The words of each line; a line end is no part of a word."""
    return F.transform(F.split(F.translate(text, UPPER, LOWER), "\n"), lambda x: F.regexp_extract_all(x, F.lit(WORD), 0))


def word_order(docs: DataFrame, vocabulary: list[str], text: str = "text") -> list[str]:
    """The templates' words by document frequency, rare first; words that never occur come first of all."""
    own = F.array_distinct(F.filter(F.flatten(line_words(text_or_empty(text))), lambda w: w.isin(vocabulary)))
    counts = docs.select(F.explode(own).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()  # a row per word of the templates
    n = {r["w"]: r["n"] for r in counts}
    return sorted(vocabulary, key=lambda w: (n.get(w, 0), w))


class Index:
    """The templates as ranks, and per rank the templates that have it in their prefix."""

    def __init__(self, order: list[str], templates: list[tuple[str, str]], contained: float):
        rank = {w: i for i, w in enumerate(order)}
        self.order, self.labels = order, [label for label, _ in templates]
        self.sets = [sorted(rank[w] for w in template_words(t)) for _, t in templates]
        self.need = [math.ceil(contained * len(s) - 1e-9) for s in self.sets]
        self.prefix: list[list[int]] = [[] for _ in order]
        for t, (own, need) in enumerate(zip(self.sets, self.need)):
            for r in own[:len(own) - need + 1]:
                self.prefix[r].append(t)
        self.rare = [order[r] for r, of in enumerate(self.prefix) if of]


def _matches(lines: Column, index: Index) -> Column:
    """array<struct<line, lines, template, containment>> of the blocks of one document."""
    known, rare = index.order, index.rare
    ints = lambda values: F.array(*[F.lit(v) for v in values]).cast("array<int>")
    sets = F.array(*[ints(s) for s in index.sets])
    need = ints(index.need)
    prefix = F.array(*[ints(p) for p in index.prefix])
    order = F.array(*[F.lit(w) for w in known])
    own = F.transform(lines, lambda ws: F.filter(ws, lambda w: w.isin(known)))

    def block(i: Column, n: int) -> Column:
        words = F.flatten(F.slice(own, i + 1, n))
        candidate = F.exists(words, lambda w: w.isin(rare))
        ranks = F.when(candidate, F.array_sort(F.transform(F.array_distinct(words), lambda w: (F.array_position(order, w) - 1).cast("int")))).otherwise(F.array().cast("array<int>"))
        return _let(ranks, lambda b: _let(
            F.array_distinct(F.flatten(F.transform(b, lambda r, at: F.filter(F.get(prefix, r), lambda t: F.size(b) - at >= F.get(need, t))))),
            lambda found: F.filter(F.transform(found, lambda t: F.struct(
                i.cast("int").alias("line"), F.lit(n).alias("lines"), t.alias("template"),
                (F.size(F.array_intersect(b, F.get(sets, t))) / F.size(F.get(sets, t))).alias("containment"),
                (F.size(F.array_intersect(b, F.get(sets, t))) >= F.get(need, t)).alias("met"))), lambda m: m["met"])))

    blocks = F.sequence(F.lit(0), F.size(lines) - 1)
    single = F.flatten(F.transform(blocks, lambda i: block(i, 1)))
    # From the last line on there is nothing to join.
    triple = F.flatten(F.transform(F.slice(blocks, 1, F.greatest(F.size(lines) - 1, F.lit(0))), lambda i: block(i, 3)))
    return F.concat(single, triple)


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def phrase_places(words: Column, phrases: dict[str, str]) -> Column:
    """array<struct<at, label>> of the places where a phrase's words stand one after the other."""
    return F.concat(*[_phrase(words, phrase.split(" "), label) for phrase, label in phrases.items()])


def _phrase(words: Column, parts: list[str], label: str) -> Column:
    def here(i: Column) -> Column:
        test = F.get(words, i + len(parts) - 1) == parts[-1]  # the last word first: it is the rarest
        for k, p in enumerate(parts[:-1]):
            test = test & (F.get(words, i + k) == p)
        return F.coalesce(test, F.lit(False))

    places = F.transform(F.filter(F.sequence(F.lit(0), F.size(words) - 1), here), lambda i: F.struct(i.cast("bigint").alias("at"), F.lit(label).alias("label")))
    return F.when(F.array_contains(words, parts[-1]), places).otherwise(F.array().cast("array<struct<at:bigint,label:string>>"))


@keeps_columns
def scan(docs: DataFrame, text: str = "text", templates: list[tuple[str, str]] | None = None, contained: float = CONTAINED,
         phrases: dict[str, str] | None = None) -> DataFrame:
    """The documents with ``n_words``, ``places`` (phrases) and ``notices`` (blocks that contain a template, with its label)."""
    templates = templates or TEMPLATES
    vocabulary = sorted({w for _, t in templates for w in template_words(t)})
    index = Index(word_order(docs, vocabulary, text), templates, contained)
    labels = F.array(*[F.lit(x) for x in index.labels])
    rows = docs.drop("n_words", "places", "notices").withColumn("_lines", line_words(text_or_empty(text)))
    rows = rows.withColumn("_words", F.flatten("_lines"))
    # A document without any word of a prefix has no notice.
    some = F.exists("_words", lambda w: w.isin(index.rare))
    none = F.array().cast("array<struct<line:int,lines:int,template:int,containment:double,met:boolean>>")
    found = F.transform(F.when(some, _matches(F.col("_lines"), index)).otherwise(none), lambda m: F.struct(
        m["line"].alias("line"), m["lines"].alias("lines"), m["template"].alias("template"), F.get(labels, m["template"]).alias("label"), m["containment"].alias("containment")))
    return rows.withColumns({"n_words": F.size("_words").cast("bigint"), "places": phrase_places(F.col("_words"), phrases or PHRASES), "notices": found}).drop("_lines", "_words")
