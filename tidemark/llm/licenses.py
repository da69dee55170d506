"""License scans as an exact set-similarity join, in DataFrame functions only.

Blocks are windows of consecutive words, whatever the line breaks: for each template all windows of
SLACK times as many words as its wording has. A template is a set of words; it is found in a block if
at least THRESHOLD of its words stand in it (containment). Words are ordered by their frequency over
all documents, rarest first. A text with a block that reaches the threshold must hold one of the first
n - need + 1 words of the template (prefix filter), need words at all (length filter), and, when
w is the first shared word, enough words from w on in both (positional filter). Texts with a
prefix word are exploded, joined with the templates on it, filtered, and verified window by window.
Phrases, the base, are found as consecutive words anywhere in the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table

THRESHOLD = 0.95
#: Room for words that stand between those of a notice, such as comment marks at line starts.
SLACK = 1.5
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases and their labels (fixed values).
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Label, wording: notices in common use (fixed values). Their words, numbers included, are the sets joined on.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("apache-2", "You may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("gpl-2", "This work is licensed under the GNU General Public License, version 2."),
    ("lgpl-3", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("bsd-3", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("bsd-3", "Released under the BSD 3-Clause License."),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]


def lowered(text: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"))


def template_sets(spark: SparkSession, templates: list[tuple[str, str]]) -> list[tuple[str, list[str], int]]:
    """Each template's distinct words, by the same expression as the texts', and the words of a window."""
    rows = spark.createDataFrame([(i, label, text) for i, (label, text) in enumerate(templates)], "i int, label string, text string")
    got = rows.select("i", "label", F.array_distinct(words(lowered(F.col("text")))).alias("w"), F.size(words(lowered(F.col("text")))).alias("n")).collect()  # as many rows as templates
    return [(r.label, list(r.w), int(SLACK * r.n)) for r in sorted(got, key=lambda r: r.i) if r.w]


def frequencies(texts: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Documents that hold each template word, over all documents; as many rows as the templates have words."""
    found = texts.select(F.explode(F.array_intersect(words(lowered(F.col("text"))), F.array(*map(F.lit, vocabulary)))).alias("w"))
    return {r.w: r.n for r in found.groupBy("w").agg(F.count("*").alias("n")).collect()}


def phrase_starts(phrases: dict[str, str], w: str = "words") -> Column:
    """array<struct<at, label>> of all places where a phrase's words stand consecutively."""
    parts = []
    for phrase, label in phrases.items():
        p = phrase.split(" ")
        test = " AND ".join([f"x = '{p[0]}'"] + [f"get({w}, i + {k}) = '{v}'" for k, v in enumerate(p) if k])
        parts.append(f"filter(transform({w}, (x, i) -> if({test}, struct(i AS at, '{label}' AS label), null)), s -> s IS NOT NULL)")
    return F.expr(f"concat({', '.join(parts)})")


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of df: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, blocks.

    blocks: the found blocks as array<struct<block, label, containment>>, all that begin with a word of their template;
    block is the place of the first word, from 0. score: the greatest containment found, 1 with a phrase, else 0. Null
    and empty texts have no words, empty label strings and null places; ties keep every label; repeated rows get a row
    each; other columns of df are not carried.
    """
    spark = df.sparkSession
    sets = template_sets(spark, TEMPLATES if templates is None else templates)
    texts = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    vocabulary = sorted({x for _, s, _ in sets for x in s})
    count = frequencies(texts, vocabulary) if sets else {}
    order = {x: i for i, x in enumerate(sorted(vocabulary, key=lambda x: (count.get(x, 0), x)))}
    index = []
    for k, (label, s, width) in enumerate(sets):
        s = sorted(s, key=order.get)
        need = max(1, -int(-threshold * len(s) // 1))
        index += [(k, label, s, need, width, p, s[p]) for p in range(len(s) - need + 1)]
    # at most as many rows as the templates have words: fit to be broadcast at any input size
    heads = F.broadcast(spark.createDataFrame(index, "template int, label string, members array<string>, need int, width int, place int, w string"))
    prefix = F.array(*[F.lit(x) for x in sorted({i[6] for i in index})]) if index else F.array().cast("array<string>")
    ranked = F.array(*[F.lit(x) for x in sorted(vocabulary, key=order.get)]) if sets else F.array().cast("array<string>")

    low = texts.select(F.monotonically_increasing_id().alias("rid"), "doc_id", lowered(F.col("text")).alias("low"))
    base = low.withColumn("words", words(F.col("low")))
    gate = " OR ".join("(" + " AND ".join(f"contains(low, '{x}')" for x in p.split(" ")) + ")" for p in PHRASES)
    base = base.withColumn("starts", F.when(F.expr(gate), phrase_starts(PHRASES)))
    has = " OR ".join(f"contains(low, '{x}')" for x in sorted({i[6] for i in index})) or "false"
    base = base.withColumn("shared", F.when(F.expr(has), F.array_intersect(ranked, F.col("words"))))  # in the global order
    base = base.withColumn("keys", F.array_intersect(F.col("shared"), prefix))
    # texts are carried on only where words of a template stand
    base = base.select("rid", "doc_id", F.size("words").cast("long").alias("n_words"), "starts", F.when(F.size("keys") > 0, F.col("low")).alias("low"), "shared", "keys")
    base = base.select("rid", "doc_id", "n_words", "starts", "low", "shared", F.explode_outer("keys").alias("w"))
    pairs = base.join(heads, "w", "left")
    # the first shared prefix word alone proposes the pair; its places bound what can still be shared
    at = F.array_position("shared", F.col("w"))
    ahead = F.size(F.array_intersect(F.slice("members", 1, F.col("place")), F.col("shared")))
    possible = F.least(F.size("members") - F.col("place"), F.size("shared") - at.cast("int") + 1)
    share = F.size(F.array_intersect("members", "shared"))
    # the template's words in the text, by place; then the distinct ones in the window from each of them on
    marks = f"filter(transform(regexp_extract_all(low, r'({WORD})'), (x, i) -> struct(i AS i, array_position(members, x) AS k)), s -> s.k > 0)"
    count = "size(array_distinct(transform(filter(slice(m, j + 1, width), s -> s.i < v.i + width), s -> s.k)))"
    blocks = F.expr(f"filter(transform(array({marks}), m -> transform(m, (v, j) -> struct(v.i AS block, label, {count} AS share)))[0], b -> b.share >= need)")
    blocks = F.transform(blocks, lambda b: F.struct(b.block.alias("block"), b.label.alias("label"), (b.share / F.size("members")).alias("containment")))
    found = F.when((F.col("n_words") >= F.col("need")) & (possible >= F.col("need")) & (F.when(F.col("place") > 0, ahead).otherwise(0) == 0) & (share >= F.col("need")), blocks)
    out = pairs.groupBy("rid").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.first("starts").alias("starts"), F.array_distinct(F.flatten(F.collect_list(found))).alias("blocks"))
    places = F.col("starts.at")
    none = F.array().cast("array<string>")
    base_labels = F.coalesce(F.col("starts.label"), none)
    return out.select(
        "doc_id",
        "n_words",
        F.when(F.col("starts").isNull(), 0).otherwise(F.size("starts")).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base_labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_labels, F.col("blocks.label"))), ",").alias("labels"),
        F.when(F.size(base_labels) > 0, 1.0).otherwise(F.coalesce(F.array_max(F.col("blocks.containment")), F.lit(0.0))).alias("score"),
        "blocks",
    )


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels and phrase places of all whole `documents`."""
    return scan(table(spark, sf_dir, "documents")).drop("blocks")
