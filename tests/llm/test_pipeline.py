"""The pipeline's stages against brute force, each on what its predecessor kept."""

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import test_decontaminate, test_ngram_join, test_tokens
from upkeep.llm.common import written


def spans(docs, span=100):
    """(doc_id, text) without repeated spans and the characters they split; texts left with nothing are dropped."""
    seen, out = set(), []
    for doc, text in docs:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), dtype=bool)
        for i in range(len(raw) - span + 1):
            if raw[i : i + span] in seen:
                gone[i : i + span] = True
            seen.add(raw[i : i + span])
        if gone.any():
            text = bytes(b for b, g in zip(raw, gone) if not g).decode("utf-8", "ignore")
        if text or not gone.any():
            out.append((doc, text))
    return out


def pairs(df):
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
        kept.append(docs)
        assert name == "packing" or docs.columns == columns
    quality, near, span, clean, packed = kept
    first = pairs(quality)
    components = {d: c for d, _, c in test_ngram_join.brute(first)}
    assert pairs(near) == [(d, t) for d, t in first if components[d] == d]
    assert pairs(span) == spans(pairs(near))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    dirty = {d for d, _, hit, _ in test_decontaminate.brute(pairs(span), items) if hit}
    assert pairs(clean) == [(d, t) for d, t in pairs(span) if d not in dirty]
    assert len(first) > len(pairs(near)) > len(pairs(clean)) > 0
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {d: [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2])] for d, t in pairs(clean)}
    test_tokens.check_pieces(packed.collect(), ids)


def test_quality_rejects_bad_labels(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.quality_stage(spark, docs, sf_dir).select("doc_id").collect()}
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()]
    good, bad = [d in kept for d, q in labels if q == 1], [d in kept for d, q in labels if q == 0]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.3


def test_odd_rows(spark, sf_dir, odd_documents, no_documents):
    for docs in (odd_documents, no_documents):
        for name, stage in corpus_pipeline.STAGES:
            new = written(stage(spark, docs, sf_dir), name)
            assert name == "packing" or new.columns == docs.columns
            docs = new
    near = corpus_pipeline.near_duplicate_stage(spark, odd_documents, sf_dir)
    assert sorted((r.doc_id or 0) for r in near.collect()) == [0, 0, 1, 2, 3, 4, 5, 6]
