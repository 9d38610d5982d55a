"""The n-gram join against all pairs by an inverted index."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from upkeep.llm import ngram_join
from upkeep.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def brute(docs):
    sets = [(d, shingles(t)) for d, t in docs]
    index = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        for x in s:
            index[x].append(i)
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by_id = {}
    for i, (d, s) in enumerate(sets):
        if d is not None and s:
            parent[root(i)] = root(by_id.setdefault(d, i))
    for i, (d, s) in enumerate(sets):
        if d is None:
            continue
        shared = Counter(j for x in s for j in index[x] if j < i and sets[j][0] is not None)
        for j, c in shared.items():
            if 100 * c >= 80 * (len(s) + len(sets[j][1]) - c):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, s) in enumerate(sets):
        if d is not None:
            r = root(i)
            least[r] = min(least.get(r, d), d)
    return sorted(((d, len(s), None if d is None else least[root(i)]) for i, (d, s) in enumerate(sets)), key=key)


def key(r):
    return (r[0] is None, r[0] or 0, r[1])


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=key)


def test_query(spark, sf_dir, documents):
    from upkeep.llm import queries

    want = brute(documents)
    assert got(queries.op3_ngram_join(spark, sf_dir)) == want
    assert sum(d != c for d, _, c in want) > 5


@pytest.mark.parametrize("seed", range(2))
def test_chains_passages_and_groups(spark, monkeypatch, seed):
    """Chains of small edits, a passage in most texts, a large group of near copies, short texts, exact copies."""
    monkeypatch.setattr(ngram_join, "ROWS_PER_BLOCK", 4000)
    monkeypatch.setattr(ngram_join, "MEMBERS_PER_TASK", 4)
    random = np.random.default_rng(seed)
    make = lambda n: [f"w{x}" for x in random.integers(0, 500, n)]
    passage = make(25)
    texts = []
    for _ in range(6):
        words = make(60)
        for _ in range(8):
            words = list(words)
            words[int(random.integers(0, 60))] = f"e{random.integers(0, 9)}"
            texts.append(words)
    hot = make(50)
    for i in range(30):
        texts.append([*hot[: 48 - i % 5], f"z{i}", "END"])
    texts += [make(int(random.integers(5, 90))) + passage for _ in range(40)]
    texts += [["a"], ["a"], ["A", "b"], ["a", "b", "c", "d"], ["a", "b", "c", "d"], ["a", "b", "c", "d", "e"], [], list("abcdefgh"), list("abcdefghi")]
    texts += [texts[0]] * 5
    order = random.permutation(len(texts))
    docs = [(int(i), " \t".join(texts[j])) for i, j in enumerate(order)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert got(ngram_join.jaccard_components(df)) == brute(docs)


def test_odd(spark, odd_documents, no_documents):
    docs = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert got(ngram_join.jaccard_components(odd_documents)) == brute(docs)
    assert got(ngram_join.jaccard_components(no_documents)) == []


def test_rows_of_one_id_are_one_node(spark):
    a, b = "one two three four five six seven eight nine ten", "q w e r t y u i o p a s d f"
    rows = [(5, a), (7, a), (7, b), (9, b + " "), (11, "other words that nobody shares at all"), (None, a), (None, None)]
    found = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in found) == [(0, 0), (0, 0), (5, 5), (7, 5), (7, 5), (9, 5), (11, 11)]


def test_one_of_each_loses_no_text(spark):
    """Rows are judged by their texts: an unrelated text of a repeated id stays, copies go with any id or none."""
    a, b = "one two three four five six seven eight nine ten", "q w e r t y u i o p a s d f"
    c = " ".join(f"c{i}" for i in range(40))
    rows = [(5, a, 1), (7, a, 2), (7, b, 3), (None, a, 4), (None, c, 5), (None, c + " more", 6), (None, c, 7), (8, None, 8), (8, None, 9), (None, "", 10)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n int")
    kept = ngram_join.one_of_each(df)
    assert kept.columns == df.columns
    got = [tuple(r) for r in kept.collect()]
    assert sorted(r[2] for r in got if r[1] in (a, b)) == [1, 3] and sorted(r[2] for r in got if not r[1]) == [8, 9, 10]
    assert len([r for r in got if r[1] and r[1].startswith("c0")]) == 1 and len(got) == 6
    unique = df.where("n in (1, 3, 5)").withColumn("doc_id", df["n"])
    assert sorted(r.n for r in ngram_join.one_of_each(unique).collect()) == [1, 3, 5]


def test_long_chain_components(spark):
    n = 200
    order = np.random.default_rng(1).permutation(n).tolist()
    links = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(500, 501), (501, 500), (7, 7)], "a bigint, b bigint")
    labels = {r.node: r.label for r in connected_components(links).collect()}
    assert labels == {**dict.fromkeys(range(n), 0), 500: 500, 501: 500}
