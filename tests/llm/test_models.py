"""Quality classifier and language identification: held-out accuracy, folds, and odd rows."""

import zlib

import numpy as np

from upkeep.llm import language, quality, queries
from upkeep.llm.common import Hasher, chunks

import pyarrow as pa

SF = "/root/testdata/sf0.01"


def test_quality_on_the_held_out_fold(spark):
    rows = {r.doc_id: r for r in queries.op7_quality(spark, SF).collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) and r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for d, r in rows.items())
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [(rows[d].predicted, q) for d, q in labels.items() if rows[d].held_out]
    assert np.mean([p == q for p, q in held]) > 0.9


def test_quality_learns_nothing_from_the_held_out_fold(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    trees = quality.fit_quality(docs, labels)
    other = quality.fit_quality(docs, labels.selectExpr("doc_id", "if(pmod(crc32(cast(doc_id as string)), 4) = 2, 1 - quality, quality) as quality"))
    assert all(np.array_equal(getattr(trees, f), getattr(other, f)) for f in ("feature", "threshold", "leaf"))


def test_quality_odd(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(1, 1), (1, 0), (5, None), (None, 1), (6, 1), (3, 0)], "doc_id bigint, quality int")
    trees = quality.fit_quality(odd_documents, labels)
    assert quality.quality_scores(odd_documents, trees).count() == 10
    assert quality.quality_scores(no_documents, trees).collect() == []
    none = quality.fit_quality(odd_documents, labels.limit(0))
    assert {r.score for r in quality.quality_scores(odd_documents, none).collect()} == {0.5}
    assert quality.keep_good(odd_documents, none, threshold=0.5).count() == 10


def test_trees_learn_a_threshold_and_an_interaction():
    random = np.random.default_rng(0)
    x = random.normal(size=(3000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > 0)).astype(float)
    p = quality.fit_trees(x[:2000], y[:2000]).scores(x[2000:])
    assert np.mean((p > 0.5) == y[2000:]) > 0.95


def test_statistics_do_not_depend_on_the_neighbours():
    texts = ["a b a b\nc", "", "XYZ!! é", None, "a b a b\nc", "x" * 5000]
    whole = np.vstack([quality.statistics(c, Hasher()) for c in chunks(pa.array(texts))])
    single = np.vstack([quality.statistics(c, Hasher()) for t in texts for c in chunks(pa.array([t], pa.string()))])
    assert np.allclose(whole, single) and np.isfinite(whole).all()


def test_language_on_the_held_out_fold(spark):
    rows = {r.doc_id: r for r in queries.op8_language(spark, SF).collect()}
    truth = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert set(rows) == set(truth)
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and 0 <= r.score <= 1 for d, r in rows.items())
    held = [rows[d].lang_pred == lang for d, (lang, _) in truth.items() if rows[d].held_out and lang is not None]
    assert np.mean(held) > 0.97


def test_language_odd(spark, odd_documents, no_documents):
    model = language.fit_language(odd_documents)
    out = {(r.doc_id, r.lang_pred) for r in language.identify(odd_documents, model).collect()}
    assert {(2, "und"), (3, "und"), (4, "und"), (None, "und")} <= out
    assert all(lang in {"en", "es"} for d, lang in out if d in (1, 5, 6, 7))
    empty = language.fit_language(no_documents)
    assert {r.lang_pred for r in language.identify(odd_documents, empty).collect()} == {"und"}
    assert language.identify(no_documents, model).collect() == []


def test_quality_scores_are_a_walk_down_each_tree(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    trees = quality.fit_quality(docs, labels)
    rows = docs.select("doc_id", "text").limit(80).collect()
    got = {r.doc_id: r.score for r in quality.quality_scores(docs, trees).collect()}
    for r in rows:
        x = quality.statistics(next(chunks(pa.array([r.text], pa.string()))), Hasher())[0]
        total = trees.base
        for feature, threshold, leaf in zip(trees.feature, trees.threshold, trees.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if x[feature[node]] > threshold[node] else 1)
            total += leaf[node - len(feature)]
        assert abs(got[r.doc_id] - 1 / (1 + np.exp(-total))) < 1e-9


def test_statistics_by_hand():
    x = dict(zip(quality.FEATURES, quality.statistics(next(chunks(pa.array(["Ab ab, ab ab!\n12 #x"]))), Hasher())[0]))
    assert np.isclose(x["log_bytes"], np.log1p(19)) and np.isclose(x["log_words"], np.log1p(6)) and np.isclose(x["log_lines"], np.log1p(2))
    assert np.isclose(x["upper_share"], 1 / 19) and np.isclose(x["digit_share"], 2 / 19) and np.isclose(x["space_share"], 5 / 19) and np.isclose(x["symbol_share"], 2 / 19)
    assert np.isclose(x["word_mean"], 14 / 6) and np.isclose(x["word_longest"], np.log1p(3)) and np.isclose(x["distinct_words"], 1) and x["repeated_next"] == 0
    assert np.isclose(x["symbol_words"], 2 / 6) and np.isclose(x["distinct_lines"], 1)


def plain_subwords(text):
    """Buckets of the 2-, 3- and 4-grams of a text, one by one."""
    data = (text or "").encode()
    code = [c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in data]
    out = []
    for n in (2, 3, 4):
        for i in range(len(code) - n + 1):
            if code[i] == 32 and code[i + 1] == 32:
                continue
            value = code[i]
            for c in code[i + 1 : i + n]:
                value = (value * 0x01000193 & 0xFFFFFFFF) ^ c
            mixed = ((value ^ (value >> 15)) * 0x85EBCA6B + n) & 0xFFFFFFFF
            out.append((mixed ^ (mixed >> 13)) & (language.BUCKETS - 1))
    return out


def test_language_scores_are_plain_means(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit_language(docs)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, model).collect()}
    for r in docs.select("doc_id", "text").limit(40).collect():
        found = plain_subwords(r.text)
        mean = sum(model.table[b].astype(float) for b in found) / max(len(found), 1)
        z = (mean + model.bias) / model.temperature
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert got[r.doc_id][0] == model.languages[int(p.argmax())] and abs(got[r.doc_id][1] - p.max()) < 1e-6


def test_samples_are_bounded_in_rows(spark):
    """An id with many texts gives one of them; classes are sampled to their bound; the same rows give the same sample."""
    from upkeep.llm.common import one_text_each, sample_of_classes

    known = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'a', 'b') as lang")
    sample = sample_of_classes(known, 100)
    assert sample == sample_of_classes(known.repartition(5), 100)
    assert all(70 <= sum(c == k for _, c in sample) <= 100 for k in "ab")
    assert sorted(sample_of_classes(known, 10**6)) == [(i, "b" if i % 3 else "a") for i in range(3000)]
    assert sample_of_classes(known.limit(0), 5) == []
    hot = spark.range(5000).selectExpr("7L as doc_id", "if(id % 2 = 0, 'a', 'b') as lang", "concat('text ', id % 50) as text")
    rows = one_text_each(hot, spark.createDataFrame([(7, "b"), (8, "a")], "doc_id bigint, lang string"), on=("lang",)).collect()
    assert [(r.doc_id, r.lang) for r in rows] == [(7, "b")] and int(rows[0].text.split()[1]) % 2 == 1


def test_language_letters():
    chunk = next(chunks(pa.array(["12 !", "1 ж", "€ 5", "a", "", "中"])))
    assert language.has_letter(chunk).tolist() == [False, True, False, True, False, True]
