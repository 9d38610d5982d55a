"""Ranked search against scoring every document for every item, and the sharing DAG against plain sums."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from upkeep.llm import queries, ranked_search

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in WORD.findall(text or "")]


def brute(docs, items, top=10):
    counts = [(d, Counter(words(t))) for d, t in docs]
    counts = [(d, c, sum(c.values())) for d, c in counts if c]
    n_docs, total = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    asked = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, set()).update(words(text))
    out = []
    for item, terms in asked.items():
        scored = []
        for d, c, n in counts:
            m = 10 + 90 * n * n_docs // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if t in c
            )
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        scored.sort(key=lambda s: s[:3])
        out += [(item, r + 1, d, -s) for r, (s, _, _, d) in enumerate(scored[:top])]
    return out


def got(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def test_query(spark, sf_dir, documents):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = brute(documents, items)
    assert len(want) > 100 and got(queries.op12_ranked_search(spark, sf_dir)) == sorted(want, key=str)


@pytest.mark.parametrize("seed", range(2))
def test_random(spark, seed, monkeypatch):
    """Few words, so that scores tie, rows repeat and items share most terms; several blocks of items, small steps."""
    monkeypatch.setattr(ranked_search, "TERMS_PER_BLOCK", 60)
    monkeypatch.setattr(ranked_search, "DOCUMENTS_PER_STEP", 7)
    random = np.random.default_rng(seed)
    letters = np.array(["a", "B", "É", "c9", "d", "e", "f", "G", "zz", "h"])
    make = lambda n: " ,".join(random.choice(letters, n))
    docs = [(int(random.integers(0, 60)), make(int(random.integers(0, 9)))) for _ in range(150)]
    docs += [(None, make(4)) for _ in range(5)] + [(70, None), (71, ""), (72, "a " * 5000)]
    items = [(i % 25, make(int(random.integers(0, 9)))) for i in range(40)] + [(None, "a"), (90, None), (91, "unknown")]
    found = ranked_search.search(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert got(found) == sorted(brute(docs, items), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_the_dag_sums_what_the_items_ask(seed):
    random = np.random.default_rng(seed)
    common = random.integers(0, 300, 12)
    items = [{*random.integers(0, 300, int(random.integers(0, 20))).tolist(), *random.choice(common, 8).tolist()} for _ in range(40)]
    plan = ranked_search.share(items, 300)
    rows, terms = np.nonzero(random.random((9, 300)) < 0.4)
    value = random.integers(1, 1 << 40, len(rows))
    nodes = ranked_search.node_scores(plan, rows, terms, np.where(np.isin(terms, list(set().union(*items))), value, 0), 9)
    whole = np.zeros((9, 300), dtype=np.int64)
    whole[rows, terms] = value
    for item, own in zip(items, plan.parts):
        assert nodes[own].sum(axis=0).tolist() == whole[:, sorted(item)].sum(axis=1).tolist()
    assert plan.pairs and plan.additions() < sum(max(len(i) - 1, 0) for i in items)


def test_equal_items_are_summed_once():
    plan = ranked_search.share([[1, 2, 3], [3, 2, 1], [4, 1, 2, 3], []], 5)
    assert plan.n_nodes == 2 and not plan.pairs and plan.parts == [[0], [0], [0, 1], []]


def test_terms_with_equal_hashes(monkeypatch):
    """Terms are told apart by their bytes."""
    import pyarrow as pa

    from upkeep.llm.common import Hasher, chunks

    monkeypatch.setattr(Hasher, "ranges", lambda self, data, starts, ends: np.zeros(len(starts), dtype=np.uint64))
    known = ranked_search.Vocabulary([b"ab", b"cd", b"abc"])
    n, row, term = known.find(next(chunks(pa.array(["ab abc x", "cd AB", ""]))))
    assert n.tolist() == [3, 2, 0] and sorted(zip(row.tolist(), term.tolist())) == [(0, 0), (0, 2), (1, 0), (1, 1)]


def test_odd(spark, odd_documents, no_documents):
    items = spark.createDataFrame([("x", "word same text", 1), ("y", "alpha", 2), (None, "text", 3), ("z", None, 4)], "item_id string, text string, doc_id int")
    docs = [(r.doc_id, r.text) for r in odd_documents.collect()]
    want = brute(docs, [(r.item_id, r.text) for r in items.collect()])
    assert got(ranked_search.search(odd_documents, items)) == sorted(want, key=str)
    assert ranked_search.search(no_documents, items).collect() == []
    assert ranked_search.search(odd_documents, items.limit(0)).collect() == []
