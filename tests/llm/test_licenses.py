"""License scan against a direct search."""

import math
import re

from upkeep.llm import licenses, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs):
    templates = [(label, words(t), words(k)) for label, t, k in licenses.TEMPLATES]
    all_words = [words(t) for _, t in docs]
    df = {w: sum(w in set(ws) for ws in all_words) for _, t, _ in templates for w in t}
    weight = {w: math.log((1 + len(docs)) / (1 + n)) + 1 for w, n in df.items()}
    out = []
    for (doc, _), ws in zip(docs, all_words):
        places, kept, own = [], set(), []
        for phrase, label in licenses.BASE:
            p = phrase.split()
            found = [i for i in range(len(ws)) if ws[i : i + len(p)] == p]
            places += found
            kept |= {label} if found else set()
        for label, t, key in templates:
            rare = sorted(range(len(t)), key=lambda i: (-weight[t[i]], i))[: licenses.RARE]
            k = next(i for i in range(len(t)) if t[i : i + len(key)] == key)
            at = lambda i: ws[i] if 0 <= i < len(ws) else None
            scores = [
                sum(weight[w] for i, w in enumerate(t) if at(s + i) == w) / sum(weight[w] for w in t)
                for s in range(-len(t), len(ws))
                if all(at(s + i) == t[i] for i in rare) and all(at(s + k + i) == w for i, w in enumerate(key))
            ]
            if scores and max(scores) >= licenses.THRESHOLD:
                own.append((max(scores), label))
        score = max([1.0 if kept else 0.0, *(s for s, _ in own)])
        labels = ",".join(sorted(kept | {x for _, x in own}))
        out.append((doc, len(ws), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(kept)), labels, round(score, 9)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9)) for r in df.collect()), key=str)


def test_query(spark, sf_dir, documents):
    want = brute(documents)
    assert {"cc-by-nc-4.0", "apache,apache-2.0", "mit"} <= {r[6] for r in want}
    assert got(queries.op1_licenses(spark, sf_dir)) == want


def test_edges(spark):
    texts = [
        "MIT License", "  mit LICENSE.", "mitK license", "mİt license", "x MIT license mit license general public license Apache-License", "license mit",
        "...", "", None, "Released under the MIT License and Redistribution, and use: in source and binary forms with or without CHANGES are permitted",
        "redistribution and use in source and binary forms, with or without modification, are permitted", "CC0 1.0 Universal Public Domain Dedication",
        "This work is licensed under the GNU General Public License, version 3.", "mit license " * 500, "by nc 4 0", "Licensed under CC BY-NC 4.0", "кé general public licensed", "the GNU Lesser General Public License",
        "worK unauthorized copying of this file is strictly prohibited", "All rights reserved unauthorized copying of this file is strictly prohibited",
    ]
    docs = list(enumerate(texts)) + [(None, "mit license"), (0, "MIT License")]
    assert got(licenses.license_scan(spark.createDataFrame(docs, "doc_id bigint, text string"))) == brute(docs)


def test_odd(spark, odd_documents, no_documents):
    docs = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert got(licenses.license_scan(odd_documents)) == brute(docs)
    assert licenses.license_scan(no_documents).collect() == []


def test_no_python_in_the_plan(spark, sf_dir):
    plan = queries.op1_licenses(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
