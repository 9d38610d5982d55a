"""License scan with a positional rare-token index, in SQL functions only.

Texts are lower-cased (A-Z) and cut into words. A template is a run of words with a label and a mandatory key phrase.

1. Document frequencies of the templates' words are counted over all documents; the ``RARE`` words of highest inverse
   document frequency of each template, with their relative positions, are its index entries (a table bounded by the
   templates, put into the plan as literals).
2. A document's index words give, per template, sets of starts (position less relative position). The starts on which all
   of a template's rare words agree are its candidates.
3. At a candidate the key phrase must stand word for word at its place; the score is the share of the template's weight
   (inverse document frequencies) whose words stand at their places. ``THRESHOLD`` of it gives the label.

The base phrases are templates that are all index words and all key phrase, so their candidates are their places.

Null and empty texts have no words, no labels and score 0; each row is judged by itself, so repeated rows do no harm; a
long text is one array of words. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RARE = 3
THRESHOLD = 0.8
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# fixed values: base phrases and labels
BASE = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
# fixed values: (label, opening words of the licence or of its usual notice, key phrase within them)
TEMPLATES = [
    ("agpl", "under the terms of the GNU Affero General Public License", "affero general public license"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", "apache license version 2 0"),
    ("artistic-2.0", "Licensed under the Artistic License 2.0", "artistic license 2 0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted", "source and binary forms"),
    ("bsl-1.0", "Distributed under the Boost Software License, Version 1.0", "boost software license"),
    ("cc-by-4.0", "Licensed under CC BY 4.0", "cc by 4 0"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", "cc by nc 4 0"),
    ("cc-by-nc-4.0", "Creative Commons Attribution-NonCommercial 4.0 International", "attribution noncommercial 4 0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0", "cc by sa 4 0"),
    ("cc0", "CC0 1.0 Universal Public Domain Dedication", "public domain dedication"),
    ("epl-2.0", "Eclipse Public License 2.0", "eclipse public license"),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2", "general public license version 2"),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3", "general public license version 3"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "with or without fee"),
    ("lgpl", "under the terms of the GNU Lesser General Public License", "lesser general public license"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "hereby granted free of charge"),
    ("mit", "Released under the MIT License", "mit license"),
    ("mpl-2.0", "Mozilla Public License, v. 2.0", "mozilla public license"),
    ("proprietary", "All rights reserved. Unauthorized copying of this file is strictly prohibited", "unauthorized copying"),
    ("unlicense", "This is free and unencumbered software released into the public domain", "unencumbered software"),
]


def template_words(text: str) -> list[str]:
    return [w for w in re.split(SEPARATORS, text.lower()) if w]


def _at(words: list[str], phrase: list[str]) -> int:
    return next(i for i in range(len(words) - len(phrase) + 1) if words[i : i + len(phrase)] == phrase)


def _array(values: list[str]) -> Column:
    return F.array(*(F.lit(v) for v in values))


def _split(docs: DataFrame) -> DataFrame:
    """doc_id, _words (as split: the first may be empty), _lead (0 or 1), n_words."""
    # the Kelvin sign is the only character outside A-Z whose lower case is an ASCII letter
    lower = F.lower(F.replace(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit("K"), F.lit("κ")))
    split = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.split(lower, SEPARATORS).alias("_words"))
    lead = (F.element_at("_words", 1) == F.lit("")).cast("int")
    # a text of separators only splits into two empty words, an empty text into one
    tail = ((F.element_at("_words", -1) == F.lit("")) & (F.size("_words") > 1)).cast("int")
    return split.withColumn("_lead", lead).withColumn("n_words", (F.size("_words") - F.col("_lead") - tail).cast("bigint"))


def document_frequencies(docs: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Number of documents, and of those that contain each word of the vocabulary."""
    found = _split(docs).select(F.array_intersect("_words", _array(vocabulary)).alias("found"))
    rows = found.select(F.explode(F.concat("found", F.array(F.lit("")))).alias("word")).groupBy("word").count()
    counts = {r["word"]: r["count"] for r in rows.collect()}  # at most one row per vocabulary word
    return counts.pop("", 0), counts


def _starts(word: str, at: int) -> Column:
    return F.transform(F.filter("_hits", lambda h: h["w"] == F.lit(word)), lambda h: h["i"] - F.lit(at))


def _agreed(words: list[str], places: list[int]) -> Column:
    """Starts on which the words at these places of a template agree."""
    out = F.array_distinct(_starts(words[places[0]], places[0]))
    for p in places[1:]:
        out = F.array_intersect(out, _starts(words[p], p))
    return out


def license_scan(docs: DataFrame, rare: int = RARE, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, best_label."""
    templates = [(label, template_words(text), template_words(key)) for label, text, key in TEMPLATES]
    base = [(label, template_words(text)) for text, label in BASE]
    total, frequency = document_frequencies(docs, sorted({w for _, ws, _ in templates for w in ws}))
    weight = {w: math.log((1 + total) / (1 + frequency.get(w, 0))) + 1 for _, ws, _ in templates for w in ws}
    places = [
        sorted(range(len(ws)), key=lambda i, ws=ws: (-weight[ws[i]], i))[:rare] for _, ws, _ in templates
    ]  # the rarest words first
    index = sorted({ws[p] for (_, ws, _), ps in zip(templates, places) for p in ps} | {w for _, ws in base for w in ws})

    words = _split(docs).withColumn(
        "_hits",
        F.when(
            F.arrays_overlap("_words", _array(index)),
            F.filter(
                F.transform("_words", lambda w, i: F.when(w.isin(index), F.struct(w.alias("w"), (i - F.col("_lead")).alias("i")))),
                lambda h: h.isNotNull(),
            ),
        ),
    )

    def verified(t: int) -> Column:
        """Scores of a template at its candidates with the key phrase."""
        _, ws, key = templates[t]
        sum_of_weights = sum(weight[w] for w in ws)
        k = _at(ws, key)

        def word(start: Column, i: int) -> Column:
            return F.get("_words", start + F.col("_lead") + F.lit(i))

        def score(start: Column) -> Column:
            return sum((F.when(word(start, i) == F.lit(w), weight[w]).otherwise(0.0) for i, w in enumerate(ws)), F.lit(0.0)) / sum_of_weights

        def has_key(start: Column) -> Column:
            out = F.lit(True)
            for i, w in enumerate(key):
                out = out & F.coalesce(word(start, k + i) == F.lit(w), F.lit(False))
            return out

        return F.transform(F.filter(_agreed(ws, places[t]), has_key), score)

    none = F.array().cast("array<double>")
    scored = words.withColumns(
        {f"_base{b}": F.when(F.col("_hits").isNotNull(), _agreed(ws, list(range(len(ws))))) for b, (_, ws) in enumerate(base)}
        | {f"_t{t}": F.array_max(F.when(F.col("_hits").isNotNull(), verified(t)).otherwise(none)) for t in range(len(templates))}
    )
    empty = F.array().cast("array<int>")
    all_places = F.concat(*(F.coalesce(F.col(f"_base{b}"), empty) for b in range(len(base))))
    kept = F.array_compact(F.array(*(F.when(F.size(f"_base{b}") > 0, F.lit(label)) for b, (label, _) in enumerate(base))))
    own = F.array_compact(
        F.array(*(F.when(F.col(f"_t{t}") >= F.lit(threshold), F.struct(F.col(f"_t{t}").alias("score"), F.lit(label).alias("label"))) for t, (label, _, _) in enumerate(templates)))
    )
    out = scored.select("doc_id", "n_words", all_places.alias("_places"), kept.alias("_kept"), own.alias("_own"))
    best = F.array_max("_own")
    return out.select(
        "doc_id",
        "n_words",
        F.size("_places").cast("bigint").alias("n_base"),
        F.array_min("_places").cast("bigint").alias("first_word"),
        F.array_max("_places").cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("_kept")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("_kept", F.transform("_own", lambda x: x["label"])))), ",").alias("labels"),
        F.greatest(F.when(F.size("_kept") > 0, F.lit(1.0)).otherwise(F.lit(0.0)), F.coalesce(best["score"], F.lit(0.0))).alias("score"),
        best["label"].alias("best_label"),
    )
