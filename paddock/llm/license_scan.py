"""License text in documents, by an exact set-similarity join of text blocks with license templates.

A template of s words is met by the blocks of 2 * s words that begin at every s-th word, so that each
passage of its length lies in one block. The join returns all (block, template) with
|words of the block and the template| >= threshold * |words of the template|. Words are ordered by how often the
corpus has them. A block that reaches the threshold holds one of the template's rarest words (prefix filter), has enough
words (length filter) and enough words after the first common one in that order (positional filter);
only what passes is intersected. The words of the documents are streamed past a broadcast
table of prefixes, so the texts are never shuffled.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import row_key, table
from .decontam import _split

#: (name, label, text) of the wordings that are looked for.
TEMPLATES = (
    ("mit-notice", "mit", "released under the MIT license"),
    ("mit-grant", "mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the software without restriction"),
    ("apache-notice", "apache", "licensed under the Apache license, version 2.0"),
    ("apache-terms", "apache", "you may not use this file except in compliance with the license. You may obtain a copy of the license at"),
    ("gpl-notice", "gpl", "licensed under the GNU general public license"),
    ("gpl-terms", "gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU general public license as published by the free software foundation"),
    ("lgpl-notice", "lgpl", "licensed under the GNU lesser general public license"),
    ("bsd-terms", "bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc-grant", "isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl-notice", "mpl", "subject to the terms of the Mozilla public license"),
    ("cc-by", "cc-by", "licensed under CC BY 4.0"),
    ("cc-by-sa", "cc-by-sa", "licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "cc-by-nc", "licensed under CC BY-NC 4.0"),
    ("cc-by-nd", "cc-by-nd", "licensed under CC BY-ND 4.0"),
    ("cc-attribution", "cc-by", "licensed under a creative commons attribution license"),
    ("cc0-notice", "cc0", "to the extent possible under law, the author has waived all copyright and related or neighboring rights"),
    ("unlicense", "unlicense", "This is free and unencumbered software released into the public domain"),
)
#: Label by phrase; a phrase counts wherever its words stand consecutively.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
THRESHOLD = 0.9
#: Templates are a parameter and are broadcast; so many characters at most.
MAX_TEMPLATE_CHARS = 8 << 20


def _words(text: str) -> list[str]:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def needed(n_tokens: int, threshold: float) -> int:
    """The fewest common words that reach the threshold."""
    return max(1, math.ceil(Fraction(str(threshold)) * n_tokens))


def finer(templates: Sequence[tuple[str, str, str]]) -> dict[str, list[list[str]]]:
    """For each template, what the templates that hold all its words and further ones have more."""
    sets = {name: set(_words(text)) for name, _, text in templates}
    return {a: [sorted(sets[b] - sets[a]) for b in sets if sets[a] < sets[b]] for a in sets}


def scanned(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """_id, _k, words of each row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_t")).withColumn("_k", row_key("_id", F.col("_t")))
    return _split(rows, F.col("_t")).select("_id", "_k", "words")


def word_order(rows: DataFrame, templates: Sequence[tuple[str, str, str]]) -> list[str]:
    """Words of the templates from the rarest in ``rows`` on, ties by the word itself."""
    known = sorted({w for _, _, text in templates for w in _words(text)})
    words = rows.sparkSession.createDataFrame([(w,) for w in known], "word string")
    found = rows.select(F.explode_outer("words").alias("word")).join(F.broadcast(words), "word").groupBy("word").count()
    often = {r["word"]: r["count"] for r in found.collect()}  # one row a word of the templates
    return sorted(known, key=lambda w: (often.get(w, 0), w))


def prefixes(spark: SparkSession, templates: Sequence[tuple[str, str, str]], order: list[str], threshold: float) -> DataFrame:
    """The index of prefixes: word, place (in the template's order), template, label, span, tokens, need,
    more (of finer templates)."""
    rank, more = {w: i for i, w in enumerate(order)}, finer(templates)
    rows = []
    for name, label, text in templates:
        words = _words(text)
        tokens = sorted(set(words), key=rank.__getitem__)
        need = needed(len(tokens), threshold)
        rows += [(w, i + 1, name, label, len(words), tokens, need, more[name]) for i, w in enumerate(tokens[: len(tokens) - need + 1])]
    return spark.createDataFrame(rows, "word string, place int, template string, label string, span int, tokens array<string>, need int, more array<array<string>>")


def license_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: Sequence[tuple[str, str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Return every (row, block, template) that reaches the threshold: _id, _k (a hash of the row's id and
    text), template, label, first_word, n_words (of the block), overlap, containment, finer (the block also
    holds all further words of a template that has this one's words and more, as CC BY-NC has CC BY's).

    Null and empty texts have no blocks; rows that repeat id and text give their blocks as often; no
    rows give none. Templates without words are left out. Other columns of ``docs`` are not read."""
    if sum(len(text) for _, _, text in templates) > MAX_TEMPLATE_CHARS:
        raise ValueError(f"templates have over {MAX_TEMPLATE_CHARS} characters")
    templates = [t for t in templates if _words(t[2])]
    rows = scanned(docs, id_col, text_col)
    order = word_order(rows, templates)
    index = F.broadcast(prefixes(docs.sparkSession, templates, order, threshold))
    met = rows.select("_id", "_k", "words", F.posexplode_outer("words").alias("pos", "word")).join(index, "word")
    # the two blocks of the template's grid that hold the word, each with its words only
    step = F.expr("pos div span").cast("int")
    starts = F.when(step > 0, F.array((step - 1) * F.col("span"), step * F.col("span"))).otherwise(F.array(step * F.col("span")))
    cut = F.transform(starts, lambda s: F.struct(s.alias("first"), F.slice(F.col("words"), s + 1, F.col("span") * 2).alias("block")))
    blocks = met.select("_id", "_k", "pos", "word", "place", "template", "label", "tokens", "need", "more", F.explode(cut).alias("cut")).select("*", "cut.first", "cut.block").drop("cut")
    # length filter, and the word's first place in the block speaks for all
    blocks = blocks.where((F.size("block") >= F.col("need")) & (F.array_position("block", F.col("word")) == F.col("pos") - F.col("first") + 1))
    ranked = blocks.withColumn("ranked", F.array_intersect(F.array(*map(F.lit, order)) if order else F.array().cast("array<string>"), F.col("block")))
    # positional filter on both sides of the word
    after = F.size("ranked") - F.array_position("ranked", F.col("word")) + 1
    ahead = F.size("tokens") - F.col("place") + 1
    common = F.array_intersect("tokens", "ranked")
    sure = ranked.where(F.least(after, ahead) >= F.col("need")).withColumn("common", common)
    sure = sure.where((F.size("common") >= F.col("need")) & (F.element_at("common", 1) == F.col("word")))
    held = F.exists("more", lambda words: F.size(F.array_intersect(words, F.col("ranked"))) == F.size(words))
    return sure.select("_id", "_k", "template", "label", F.col("first").cast("long").alias("first_word"), F.size("block").cast("long").alias("n_words"), F.size("common").alias("overlap"), (F.size("common") / F.size("tokens")).alias("containment"), held.alias("finer"))


def _places(phrase: list[str]) -> Column:
    """Where the phrase's words stand consecutively in ``words``; only texts that hold all of them are looked through."""
    here = F.transform("words", lambda w, i: F.when(_follows(w, i, phrase), i))
    held = F.array_contains("words", phrase[0])
    for w in phrase[1:]:
        held &= F.array_contains("words", w)
    return F.when(held, F.array_compact(here)).otherwise(F.array().cast("array<int>"))


def _follows(word: Column, i: Column, phrase: list[str]) -> Column:
    same = word == phrase[0]
    for j, w in enumerate(phrase[1:], 1):
        same &= F.get("words", i + j) == w
    return same


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: Sequence[tuple[str, str, str]] = TEMPLATES, threshold: float = THRESHOLD, phrases: Mapping[str, str] = PHRASES) -> DataFrame:
    """Return for each row: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``n_base`` counts the places of all ``phrases``; ``first_word`` and ``last_word`` are the first words of the
    first and last place, null without one. ``labels`` adds those of the templates that a block of the text
    contains, unless that block belongs to a finer one. ``score`` is 1 where a phrase stands, else the greatest containment of a template that reaches
    the threshold, else 0. Null and empty texts have no words, no labels ('') and score 0. Repeated rows
    give repeated results, null ids are ids like others, no rows give none; other columns
    are not read."""
    every = [(_words(p), label) for p, label in phrases.items() if _words(p)]
    rows = scanned(docs, id_col, text_col)
    rows = rows.select("_id", "_k", F.size("words").cast("long").alias("n_words"), *(_places(words).alias(f"_p{i}") for i, (words, _) in enumerate(every)))
    none = F.array().cast("array<int>")
    places = F.concat(none, *(F.col(f"_p{i}") for i in range(len(every))))
    base = F.array_distinct(F.array_compact(F.array(F.lit(None).cast("string"), *(F.when(F.size(f"_p{i}") > 0, label) for i, (_, label) in enumerate(every)))))
    rows = rows.select("_id", "_k", "n_words", places.alias("places"), base.alias("base"))
    found = license_blocks(docs, id_col, text_col, templates, threshold).where("not finer").groupBy(F.col("_id").alias("_i"), F.col("_k").alias("_j")).agg(F.collect_set("label").alias("found"), F.max("containment").alias("most"))
    out = rows.join(found, rows["_id"].eqNullSafe(found["_i"]) & (rows["_k"] == found["_j"]), "left")

    def listed(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return out.select(
        F.col("_id").alias(id_col),
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        listed(F.col("base")).alias("base_labels"),
        listed(F.concat("base", F.coalesce("found", F.array().cast("array<string>")))).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce("most", F.lit(0.0))).alias("score"),
    )


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of license phrases and labels of license wordings in all documents."""
    return license_scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    tokens = ", ".join(f"('{name}', '{label}', {len(_words(text))}, {needed(len(set(_words(text))), THRESHOLD)}, {len(set(_words(text)))}, '{w}')" for name, label, text in TEMPLATES for w in sorted(set(_words(text))))
    spans = {name: len(_words(text)) for name, _, text in TEMPLATES}
    more = ", ".join(f"('{name}', {spans[name]}, {i}, {len(words)}, '{w}')" for name, all_more in finer(TEMPLATES).items() for i, words in enumerate(all_more) for w in words)
    phrases = ", ".join(f"('{' '.join(_words(p))}', {len(_words(p))}, '{label}')" for p, label in PHRASES.items())
    return rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
t(template, label, span, need, size, word) AS (VALUES {tokens}),
g(template, span, finer, size, word) AS (VALUES {more}),
f(phrase, n, label) AS (VALUES {phrases}),
x AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM d),
b AS (
  SELECT r, template, any_value(label) AS label, block, count(DISTINCT word) / any_value(size)::DOUBLE AS part, any_value(need) AS need, count(DISTINCT word) AS n
  FROM (SELECT r, template, label, need, size, word, unnest([pos // span, pos // span - 1]) AS block FROM x JOIN t USING (word))
  WHERE block >= 0 GROUP BY r, template, block),
held AS (
  SELECT DISTINCT r, template, block FROM (SELECT r, template, finer, size, word, unnest([pos // span, pos // span - 1]) AS block FROM x JOIN g USING (word))
  GROUP BY r, template, block, finer HAVING count(DISTINCT word) = any_value(size)),
m AS (SELECT r, list(DISTINCT label) AS labels, max(part) AS most FROM b ANTI JOIN held USING (r, template, block) WHERE n >= need GROUP BY r),
p AS (
  SELECT r, f.label, pos FROM (SELECT r, w, pos FROM x JOIN d USING (r) WHERE word IN (SELECT split_part(phrase, ' ', 1) FROM f)) JOIN f
  ON array_to_string(w[pos + 1:pos + f.n], ' ') = f.phrase),
q AS (SELECT r, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list(DISTINCT label) AS labels FROM p GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       array_to_string(list_sort(coalesce(q.labels, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(q.labels, []), coalesce(m.labels, [])))), ',') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(most, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN q USING (r) LEFT JOIN m USING (r)
"""


SQL = _sql()
