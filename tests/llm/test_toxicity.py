"""Toxicity: held-out accuracy and fold, plain scores, counterfactual pairs, false positives on group mentions, odd rows."""

import zlib

import numpy as np
import pyarrow as pa

from upkeep.llm import queries, toxicity
from upkeep.llm.common import Hasher, chunks

SF = "/root/testdata/sf0.1"


def plain_features(text):
    """The documented features word by word."""
    found = {}
    words = [w.encode() for w in toxicity._WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))]
    hasher = Hasher()

    def bucket(data, k):
        raw = np.frombuffer(data, np.uint8)
        h = hasher.ranges(raw, np.array([0]), np.array([len(raw)]))
        return int((toxicity.mix(h + np.uint64(k)) if k else h)[0]) & (toxicity.BUCKETS - 1)

    for w in words:
        for b in [bucket(w, 0), *(bucket(w[:k], k) for k in toxicity.PREFIXES if len(w) > k)]:
            found[b] = found.get(b, 0) + 1
    return {b: (c / len(words)) ** 0.5 for b, c in found.items()}


def test_held_out_fold(spark):
    rows = {r.doc_id: r for r in queries.op11_toxicity(spark, SF).collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for d, r in rows.items())
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [(rows[d].predicted, t) for d, t in labels.items() if rows[d].held_out]
    assert np.mean([p for p, t in held if t]) > 0.85 and np.mean([p for p, t in held if not t]) < 0.01


def test_scores_are_the_plain_sums(spark, sf_dir, documents):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit_toxicity(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.toxicity_scores(docs, model).collect()}
    for doc, text in documents[:60]:
        margin = model.bias + sum(v * float(model.weights[b]) for b, v in plain_features(text).items())
        assert abs(got[doc] - 1 / (1 + np.exp(-margin))) < 1e-6


def test_learns_nothing_from_the_held_out_fold(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "if(pmod(crc32(cast(doc_id as string)), 5) = 0, 1 - toxic, toxic) as toxic")
    a, b = toxicity.fit_toxicity(docs, labels), toxicity.fit_toxicity(docs, turned)
    assert np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_swaps():
    pairs = toxicity.swaps("Nothing here. My Muslim friend, a BLIND man! rest")
    assert len(pairs) == toxicity.SWAPS
    for before, after in pairs:
        a, b = (toxicity._WORD.findall(s) for s in (before, after))
        assert len(a) == len(b) == 6 and a[0] == "my"
        changed = [(x, y) for x, y in zip(a, b) if x != y]
        assert [x for x, _ in changed] == ["muslim", "blind", "man"]
        assert all(toxicity._CATEGORY[x] is toxicity._CATEGORY[y] for x, y in changed)


def test_neutral_mentions_of_a_group_are_not_toxic():
    """A group that the toxic sentences name far more often than the clean ones."""
    random = np.random.default_rng(5)
    plain = [f"w{i}" for i in range(60)]
    texts, target = [], []
    for i in range(400):
        toxic = i % 2
        words = list(random.choice(plain, 8)) + ([f"slur{random.integers(5)}"] if toxic and random.random() < 0.7 else [])
        group = "muslim" if random.random() < (0.8 if toxic else 0.05) else random.choice(["christian", "hindu", "sikh"])
        texts.append(" ".join(random.permutation([*words, group])))
        target.append(float(toxic))
    rows = toxicity.sparse_rows(texts)
    changes = [[toxicity.difference(*toxicity.sparse_rows(list(p))) for p in toxicity.swaps(t)] for t in texts]
    neutral = [" ".join([*random.choice(plain, 8), "muslim"]) for _ in range(200)]
    hateful = [" ".join([*random.choice(plain, 8), "slur1", "sikh"]) for _ in range(50)]

    def scores(model, some):
        return np.concatenate([model.scores(c, Hasher()) for c in chunks(pa.array(some))])

    free = toxicity.train(rows, np.array(target), changes, strength=0.0)
    held = toxicity.train(rows, np.array(target), changes)
    assert np.mean(scores(free, neutral) >= 0.5) > 0.5
    assert np.mean(scores(held, neutral) >= 0.5) < 0.25
    assert np.mean(scores(held, hateful) >= 0.5) > 0.9
    swapped = [t.replace("muslim", "hindu") for t in neutral]
    assert np.abs(scores(held, neutral) - scores(held, swapped)).mean() < 0.25 * np.abs(scores(free, neutral) - scores(free, swapped)).mean()


def test_one_text_of_a_repeated_id(spark):
    docs = spark.createDataFrame([(1, f"text {i % 7}") for i in range(500)] + [(2, "b"), (3, None), (None, "c")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 0), (None, 1), (4, None)], "doc_id bigint, toxic int")
    rows = toxicity.training_texts(docs, labels).collect()
    assert sorted((r.doc_id, r.toxic) for r in rows) == [(d, t) for d, t in ((1, 1), (2, 0)) if zlib.crc32(str(d).encode()) % 5]


def test_per_class_bounds_the_sample(spark):
    docs = spark.range(2000).selectExpr("id as doc_id", "concat('word ', id) as text")
    labels = docs.selectExpr("doc_id", "if(doc_id % 10 = 0, 1, 0) as toxic")
    rows = toxicity.training_texts(docs, labels, per_class=60).collect()
    assert 40 <= sum(r.toxic for r in rows) <= 60 and 40 <= sum(1 - r.toxic for r in rows) <= 60


def test_odd(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(1, 1), (2, 0), (6, 0), (7, 1), (None, 1), (5, None)], "doc_id bigint, toxic int")
    model = toxicity.fit_toxicity(odd_documents, labels)
    out = toxicity.toxicity_scores(odd_documents, model)
    assert out.columns == ["doc_id", "score", "predicted"] and out.count() == 10
    bias = 1 / (1 + np.exp(-model.bias))
    assert all(abs(r.score - bias) < 1e-9 for r in out.where("doc_id in (2, 3, 4)").collect())
    assert toxicity.toxicity_scores(no_documents, model).collect() == []
    none = toxicity.fit_toxicity(odd_documents, labels.limit(0))
    assert {r.score for r in toxicity.toxicity_scores(odd_documents, none).collect()} == {0.5}
    assert {r.score for r in toxicity.toxicity_scores(odd_documents, toxicity.fit_toxicity(no_documents, labels)).collect()} == {0.5}
