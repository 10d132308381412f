"""Licence scans: an exact containment join of text blocks with licence templates.

Blocks and templates are sets of words. Template words are ordered by how many
documents have them, rarest first. A block that holds at least ``alpha`` of a
template's ``n`` words must hold one of its first ``n - alpha + 1`` words in
that order (prefix filter), must have ``alpha`` template words at all (length
filter), and behind the first shared word both sides must have enough words
left (positional filter); what remains is verified. A template whose
words are all in another template that the block also meets says less, so it
is not reported. All of it is DataFrame expressions and joins.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Base phrases and their labels (fixed values).
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Notices in common use (fixed values): label, text. The first group is one line
#: each, the second runs over several lines.
LINE_TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "Licensed under the GNU General Public License."),
    ("lgpl", "Licensed under the GNU Lesser General Public License."),
    ("bsd", "Licensed under the BSD 3-Clause License."),
    ("mpl", "Licensed under the Mozilla Public License, Version 2.0."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("all-rights-reserved", "Copyright. All rights reserved."),
)
NOTICE_TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the "
               "License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
)


def word_set(text: str) -> set[str]:
    return {w for w in re.split(SEPARATORS, text.lower()) if w}


def words(text):
    """Column of the words of a text, A-Z lowered. ``lower`` may touch other
    letters too; none of those turns into a letter of a base phrase."""
    return F.array_remove(F.split(F.lower(text), SEPARATORS), "")


def phrase_places(w: str = "words") -> str:
    """SQL for the (0-based) starts of the base phrases' places, with their labels."""
    tests = []
    for phrase, label in PHRASES.items():
        p = phrase.split()
        tests.append(f"WHEN w = '{p[-1]}' AND i >= {len(p) - 1} AND " + " AND ".join(
            f"get({w}, i - {len(p) - 1 - k}) = '{x}'" for k, x in enumerate(p[:-1]))
            + f" THEN named_struct('at', i - {len(p) - 1}, 'label', '{label}')")
    last = " OR ".join(f"w = '{x}'" for x in sorted({p.split()[-1] for p in PHRASES}))
    return (f"filter(transform({w}, (w, i) -> CASE WHEN NOT ({last}) THEN NULL {' '.join(tests)} END), "
            f"x -> x IS NOT NULL)")


def template_index(docs: DataFrame, threshold: tuple[int, int]) -> tuple[dict[str, int], list[tuple]]:
    """Global order of the template words, and one row per prefix word of each template.

    ``docs`` has the array column ``words``; all documents are counted, and one
    row per template word comes back.
    """
    templates = [(label, word_set(t), kind) for kind, ts in enumerate((LINE_TEMPLATES, NOTICE_TEMPLATES))
                 for label, t in ts]
    known = sorted(set().union(*(s for _, s, _ in templates)))
    hits = F.array_intersect("words", F.array(*map(F.lit, known)))
    times = {r["t"]: r["n"] for r in
             docs.select(F.explode(hits).alias("t")).groupBy("t").agg(F.count("*").alias("n")).collect()}
    order = {w: i for i, w in enumerate(sorted(known, key=lambda w: (times.get(w, 0), w)))}
    rows = []
    for k, (label, s, kind) in enumerate(templates):
        wider = [j for j, (_, t, other) in enumerate(templates) if s < t and other == kind]
        ranks = sorted(order[w] for w in s)
        alpha = -(-len(ranks) * threshold[0] // threshold[1])
        for i, r in enumerate(ranks[:len(ranks) - alpha + 1]):
            rows.append((r, k, label, kind, i, len(ranks), alpha, ranks, wider))
    return order, rows


def scan(docs: DataFrame, threshold: tuple[int, int] = (9, 10), block_lines: int = 20) -> DataFrame:
    """Base phrases and template matches of every document.

    ``docs`` has doc_id and text. Returns doc_id, n_words, n_base, first_word,
    last_word, base_labels, labels, score (1 with a base phrase, else the best
    containment reached, else 0) and n_blocks (matching blocks and templates).
    Blocks are single lines for one-line templates, and every run of
    ``block_lines`` lines, each half overlapping the next, for notices.
    Containment must reach threshold[0] / threshold[1].
    A null or empty text has no words, null places and empty labels; repeated
    rows get equal rows; an empty table gives an empty result; other columns
    are ignored. Texts are not shuffled; only matches and counts are.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", text.alias("text")).select("doc_id", "text", words(F.col("text")).alias("words"))
    order, rows = template_index(base, threshold)
    index = spark.createDataFrame(rows, "rank int, template int, label string, kind int, i int, n int, alpha int, "
                                  "ranks array<int>, wider array<int>")
    first = sorted({r[0] for r in rows})
    by_rank = {v: k for k, v in order.items()}
    row = F.xxhash64("text").alias("row")

    # documents that hold a prefix word at all; their blocks as ranks of template words
    likely = base.where(F.arrays_overlap("words", F.array(*(F.lit(by_rank[r]) for r in first))))
    lines = F.split("text", "\n")
    runs = F.transform(F.sequence(F.lit(0), F.greatest(F.size("lines") - 1, F.lit(0)), F.lit(max(1, block_lines // 2))),
                       lambda i: F.concat_ws("\n", F.slice("lines", i + 1, F.lit(block_lines))))
    cut = likely.select("doc_id", row, lines.alias("lines"))
    blocks = (cut.select("doc_id", "row", F.lit(0).alias("kind"), F.posexplode("lines").alias("block", "part"))
              .unionByName(cut.select("doc_id", "row", F.lit(1).alias("kind"), F.posexplode(runs).alias("block", "part"))))
    ranked = F.create_map(*(x for w, r in order.items() for x in (F.lit(w), F.lit(r))))
    known = F.array(*map(F.lit, order))
    blocks = blocks.select("doc_id", "row", "kind", "block", F.array_sort(F.transform(
        F.array_intersect(words(F.col("part")), known), lambda w: F.element_at(ranked, w))).alias("have"))
    probe = blocks.select("doc_id", "row", "kind", "block", "have", F.posexplode("have").alias("j", "rank"))
    candidates = (probe.join(F.broadcast(index), ["rank", "kind"])  # bounded by the templates above
                  .where((F.size("have") >= F.col("alpha"))
                         & (1 + F.least(F.col("n") - 1 - F.col("i"), F.size("have") - 1 - F.col("j")) >= F.col("alpha"))))
    hit = F.struct("template", "label", (F.col("shared") / F.col("n")).alias("share"), "wider")
    match = (candidates.withColumn("shared", F.size(F.array_intersect("have", "ranks")))
             .where("shared >= alpha").groupBy("doc_id", "row", "kind", "block").agg(F.collect_set(hit).alias("hits"))
             .withColumn("hit", F.explode(F.filter("hits", lambda h: ~F.arrays_overlap(h["wider"], F.col("hits.template"))))))
    per_doc = match.groupBy("doc_id", "row").agg(
        F.collect_set("hit.label").alias("found"), F.max("hit.share").alias("best"), F.count("*").alias("n_blocks"))

    places = F.when(F.arrays_overlap("words", F.array(*(F.lit(x) for x in sorted({p.split()[-1] for p in PHRASES})))),
                    F.expr(phrase_places()))
    counted = (base.select("doc_id", row, F.size("words").cast("long").alias("n_words"), places.alias("places"))
               .select("doc_id", "row", "n_words", F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_base"),
                       F.col("places.at").alias("at"), F.array_distinct("places.label").alias("base")))
    none = F.array().cast("array<string>")
    same = counted["doc_id"].eqNullSafe(per_doc["doc_id"]) & (counted["row"] == per_doc["row"])
    return counted.join(per_doc, same, "left").select(
        counted["doc_id"], "n_words", F.greatest("n_base", F.lit(0)).alias("n_base"),
        F.array_min("at").cast("long").alias("first_word"), F.array_max("at").cast("long").alias("last_word"),
        F.concat_ws(",", F.array_sort("base")).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_union(F.coalesce("base", none), F.coalesce("found", none)))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        F.coalesce("n_blocks", F.lit(0)).alias("n_blocks"))
