"""Span removal against a direct search for every span."""

import hashlib

import numpy as np
import pytest

from upkeep.llm import queries, span_dedup


def brute(docs, span):
    """``docs`` in document order; rows (id, text)."""
    seen, out = set(), []
    for doc, text in docs:
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, dtype=bool)
        for i in range(len(raw) - span + 1):
            w = raw[i : i + span]
            if w in seen:
                gone[i : i + span] = True
            seen.add(w)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((doc, len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def got(df):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def test_query(spark, sf_dir, documents):
    want = brute(sorted(documents), 100)
    assert sum(r[2] for r in want) > 1000
    assert got(queries.op9_suffix_dedup(spark, sf_dir)) == sorted(want)


@pytest.mark.parametrize("strings", [50, 8, 1])
def test_random(spark, monkeypatch, strings):
    """Edited copies, moved passages, runs of one byte and repeats inside a document, also with parts too large for a block
    down to the last halving."""
    seed = strings
    monkeypatch.setattr(span_dedup, "STRINGS_PER_BLOCK", strings)
    random = np.random.default_rng(seed)
    make = lambda n: "".join(random.choice(list("abñ "), n))
    base = [make(int(random.integers(0, 300))) for _ in range(8)]
    texts = list(base) + ["x" * 90, "é" * 60, "x" * 70 + base[1], None, ""]
    for _ in range(30):
        t = str(random.choice(base)) + make(10) + str(random.choice(base))
        cuts = sorted(random.integers(0, len(t) + 1, 2))
        texts.append(t[: cuts[0]] + make(int(random.integers(0, 3))) + t[cuts[1] :] + t[cuts[0] : cuts[1]])
    docs = list(enumerate(texts))
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    assert got(span_dedup.span_report(df, span=40, gram=12)) == sorted(brute(docs, 40))


def test_odd(spark, odd_documents, no_documents):
    out = got(span_dedup.span_report(odd_documents.where("doc_id is not null")))
    rows = {(r.doc_id, r.text) for r in odd_documents.collect() if r.doc_id is not None}
    want = {r[0]: r for r in brute(sorted(rows, key=lambda r: r[0]), 100)}
    assert out == sorted(want[r.doc_id] for r in odd_documents.collect() if r.doc_id is not None)
    assert span_dedup.span_report(odd_documents).count() == 10
    assert span_dedup.span_report(no_documents).collect() == []


def test_many_texts_under_one_id(spark):
    """Texts of different lengths under one id and under none: clean ones stay whole, the shared passage is cut from all
    but the first."""
    random = np.random.default_rng(7)
    passage = "".join(random.choice(list("abcdefgh "), 140))
    own = ["".join(random.choice(list("ijklmnopqrst "), 100 + i % 60)) for i in range(5600)]
    texts = [t + passage if i % 14 == 0 else t for i, t in enumerate(own)]
    rows = [(9 if i < 2800 else None, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    order = sorted(df.selectExpr("doc_id", "xxhash64(text) as h", "text").collect(), key=lambda r: (r.doc_id is None, r.h))
    want = brute([(r.doc_id, r.text) for r in order], 100)
    assert sum(r[2] > 0 for r in want) == 399
    key = lambda r: (r[0] is None, *r[1:])
    rows = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in span_dedup.span_report(df).collect()]
    assert sorted(rows, key=key) == sorted(want, key=key)


def test_order_of_documents_without_id_and_repeated_ids(spark):
    long = "the quick brown fox jumps over the lazy dog and runs away " * 3
    rows = [(5, long + "a"), (None, long), (None, long), (3, "zz" + long), (5, "other text " + long)]
    out = span_dedup.span_report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    removed = {(r.doc_id, r.n_bytes): r.n_removed for r in out}
    assert removed[(None, len(long))] == len(long) and len(out) == 5
    assert all(removed[(5, n)] >= len(long) for n in (len(long) + 1, len(long) + 11))
    assert removed[(3, len(long) + 2)] < len(long)


def test_remove_keeps_columns(spark):
    long = "abc défg hij klmn opqr stuv wxyz 0123 456 789 " * 3
    unique = "".join(f"{i} " for i in range(100))
    df = spark.createDataFrame([(1, unique, 7, len(unique)), (2, "é" + unique + long, 8, 1), (3, unique, 9, 1), (4, None, 1, None), (5, "", 1, 0)], "doc_id bigint, text string, ranges int, n_chars bigint")
    out = {r.doc_id: r for r in span_dedup.remove_repeats(df).collect()}
    assert sorted(out) == [1, 2, 4, 5] and list(out[1].asDict()) == df.columns
    assert out[1].text == unique and out[2].text.startswith("é") and out[2].n_chars == len(out[2].text) < 200
    assert out[4].text is None and out[5].text == ""
