"""Decontamination against a direct search for every window."""

import hashlib
import re

import numpy as np
import pytest

from upkeep.llm import decontaminate, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        if item is None or not w:
            continue
        n = min(10, len(w))
        for i in range(len(w) - n + 1):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    sizes = sorted({len(k) for k in windows})
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (key := tuple(w[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[key]
        out.append((doc, len(w), len(hit), sorted(found)))
    return out


def got(df):
    return [(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in df.collect()]


def same(a, b):
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(a, key=key) == sorted(b, key=key)


def test_query(spark, sf_dir, documents):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = brute(documents, items)
    assert any(r[2] for r in want)
    rows = queries.op4_decontamination(spark, sf_dir).collect()
    assert {(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows} == {
        (d, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0) for d, n, h, i in want
    }
    assert len(rows) == len(documents)


@pytest.mark.parametrize("seed", range(3))
def test_random(spark, seed):
    """Few distinct words, so windows repeat, overlap and tie; items of every length."""
    random = np.random.default_rng(seed)
    letters = np.array(["a", "b", "É", "C9"])
    make = lambda n: " ,".join(random.choice(letters, n))
    items = [(i, make(int(random.integers(7, 24)))) for i in range(30)] + [(30, None), (None, "a b"), (31, ""), (32, make(12)), (33, "zz")]
    docs = [(i, make(int(random.integers(0, 200)))) for i in range(40)] + [(40, items[3][1] + " x " + items[4][1]), (41, None), (42, "q zz a")]
    out = decontaminate.contamination(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    )
    same(got(out), brute(docs, items))


def test_odd(spark, odd_documents, no_documents):
    items = spark.createDataFrame([(1, "over and over"), (2, "same text twice over and over again in here ok"), (3, "word")], "item_id bigint, text string")
    docs = [(r.doc_id, r.text) for r in odd_documents.collect()]
    same(got(decontaminate.contamination(odd_documents, items)), brute(docs, [(r.item_id, r.text) for r in items.collect()]))
    assert decontaminate.contamination(no_documents, items).collect() == []
    clean = decontaminate.decontaminate(odd_documents, spark.createDataFrame([], "item_id bigint, text string"))
    assert clean.count() == 10 and clean.columns == odd_documents.columns
    kept = decontaminate.decontaminate(odd_documents, items)
    # (null, null) has no words and stays, (null, 'word') goes
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect())[0] == (0, "")
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 5]


def test_rows_are_decided_one_by_one(spark):
    """Of rows without an id and of a repeated id only those with a window go; the clean ones stay."""
    items = spark.createDataFrame([(1, "word")], "item_id bigint, text string")
    rows = [(None, "word"), (None, None), (None, "clean one"), (None, "clean one"), (5, "a word here"), (5, "a word here"), (5, "clean two"), (6, "clean three")]
    kept = decontaminate.decontaminate(spark.createDataFrame(rows, "doc_id bigint, text string"), items)
    want = [r for r in rows if "word" not in (r[1] or "")]
    key = lambda r: (r[0] or 0, r[1] or "")
    assert sorted([tuple(r) for r in kept.collect()], key=key) == sorted(want, key=key)
