"""Language identification: averaged hashed subword embeddings with a linear softmax.

A document is the mean of the embeddings of its byte 2-, 3- and 4-grams (letters lower-cased, all else one separator),
hashed into ``BUCKETS`` rows; a linear softmax over that mean gives the language. Both are trained together by
stochastic gradient descent in numpy on a bounded sample: ``per_language`` documents of each language by a hash of doc_id, one
text each. As the model is linear, embedding times output weights is one table of scores per bucket, and applying
it to whole texts is a gather and a sum per document.

The last part of the sample is not trained on: it sets the temperature of the softmax and the score below which a
prediction is marked ``rejected`` (the lowest score that keeps ``precision`` on it).

Texts that are null or have no letter get ``und`` and score 0. Rows without a language are not learned from; without
any, every text is ``und``. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.common import LOWER, Chunk, chunks, one_text_each, sample_of_classes

BUCKETS = 1 << 16
DIMENSIONS = 16
PER_LANGUAGE = 1200
HELD_OUT_MODULUS = 3
HELD_OUT_REMAINDER = 1
UNDETERMINED = "und"

_BYTE = np.arange(256)
_ASCII_LETTER = ((_BYTE >= 65) & (_BYTE <= 90)) | ((_BYTE >= 97) & (_BYTE <= 122))
_NORMAL = np.where(_ASCII_LETTER | (_BYTE >= 128), LOWER, 32).astype(np.uint32)


def subwords(chunk: Chunk) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of every n-gram, one n at a time; n-grams that are only separators are left out."""
    code = _NORMAL[chunk.data]
    row = np.repeat(np.arange(len(chunk)), np.diff(chunk.bounds))
    value = code.copy()
    for n in range(2, 5):
        if len(code) < n:
            return
        value = value[: len(code) - n + 1] * np.uint32(0x01000193) ^ code[n - 1 :]
        keep = row[: len(value)] == row[n - 1 :]
        keep &= ~((code[: len(value)] == 32) & (code[1 : len(value) + 1] == 32))
        mixed = (value ^ (value >> np.uint32(15))) * np.uint32(0x85EBCA6B) + np.uint32(n)
        mixed ^= mixed >> np.uint32(13)
        yield row[: len(value)][keep], (mixed & np.uint32(BUCKETS - 1)).astype(np.int64)[keep]


def has_letter(chunk: Chunk) -> np.ndarray:
    counts = np.concatenate([[0], np.cumsum(_ASCII_LETTER[chunk.data])])
    found = counts[chunk.bounds[1:]] > counts[chunk.bounds[:-1]]
    for i in np.flatnonzero(~found):
        text = chunk.data[chunk.bounds[i] : chunk.bounds[i + 1]]
        if (text >= 128).any():
            found[i] = any(c.isalpha() for c in text.tobytes().decode("utf-8", "replace"))
    return found


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # buckets x languages: embedding times output weights
    bias: np.ndarray
    temperature: float
    reject_below: float

    def probabilities(self, chunk: Chunk) -> np.ndarray:
        sums = np.zeros((len(chunk), len(self.languages)))
        counts = np.zeros(len(chunk))
        for row, bucket in subwords(chunk):
            counts += np.bincount(row, minlength=len(chunk))
            for k in range(len(self.languages)):
                sums[:, k] += np.bincount(row, self.table[bucket, k], len(chunk))
        logits = (sums / np.maximum(counts, 1)[:, None] + self.bias) / self.temperature
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        return p / p.sum(axis=1, keepdims=True)


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max())
    return z / z.sum()


def train(
    buckets: list[np.ndarray],
    weights: list[np.ndarray],
    target: np.ndarray,
    languages: list[str],
    epochs: int = 5,
    rate: float = 0.5,
    precision: float = 0.99,
) -> LanguageModel:
    """SGD over documents given as distinct buckets with shares; every sixth document calibrates instead."""
    k = len(languages)
    random = np.random.default_rng(20240501)
    embedding = random.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    output = random.normal(0, 0.1, (DIMENSIONS, k))
    bias = np.zeros(k)
    learn = [i for i in range(len(target)) if i % 6 != 5]
    check = [i for i in range(len(target)) if i % 6 == 5]
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in random.permutation(learn):
            rows, share = embedding[buckets[i]], weights[i]
            mean = share @ rows
            error = _softmax(mean @ output + bias)
            error[target[i]] -= 1
            back = output @ error
            output -= step * np.outer(mean, error)
            bias -= step * 0.1 * error
            # the mean dilutes each row's gradient by its share; the square root keeps rare subwords learning
            embedding[buckets[i]] -= step * np.sqrt(share)[:, None] * back
    table = embedding @ output
    logits = np.array([weights[i] @ table[buckets[i]] + bias for i in check]).reshape(len(check), k)
    truth = target[check]
    temperature, reject = 1.0, 0.0
    if len(check):

        def loss(t: float) -> float:
            z = logits / t
            z = z - z.max(axis=1, keepdims=True)
            return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), truth]).mean())

        temperature = float(min(np.geomspace(0.05, 20, 61), key=loss))
        p = np.array([_softmax(z) for z in logits / temperature])
        right, best = p.argmax(axis=1) == truth, p.max(axis=1)
        order = np.argsort(-best, kind="stable")
        enough = np.cumsum(right[order]) >= precision * np.arange(1, len(order) + 1)
        reject = float(best[order][np.flatnonzero(enough).max()]) if enough.any() else 1.0
    return LanguageModel(languages, table.astype(np.float32), bias, temperature, reject)


def held_out() -> F.Column:
    return F.coalesce(
        F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(HELD_OUT_MODULUS)) == F.lit(HELD_OUT_REMAINDER), F.lit(False)
    )


def fit_language(docs: DataFrame, per_language: int = PER_LANGUAGE) -> LanguageModel:
    """Model learned from at most ``per_language`` documents of each language outside the held-out fold."""
    known = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang")).where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull()
    ).where(~held_out())
    # of an id with several languages the first in order counts
    known = known.groupBy("doc_id").agg(F.min("lang").alias("lang"))
    sample = sample_of_classes(known, per_language)
    if not sample:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0, 1.0)
    ids = docs.sparkSession.createDataFrame(sample, "doc_id bigint, lang string")
    texts = one_text_each(docs, ids, on=("lang",))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(2)):
                found = list(subwords(chunk))
                row = np.concatenate([r for r, _ in found]) if found else np.empty(0, np.int64)
                bucket = np.concatenate([b for _, b in found]) if found else np.empty(0, np.int64)
                cell, count = np.unique(row * BUCKETS + bucket, return_counts=True)
                bounds = np.searchsorted(cell, np.arange(len(chunk) + 1) * BUCKETS)
                out = [(cell[a:b] % BUCKETS, count[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
                doc, lang = (c.slice(chunk.first, len(chunk)) for c in batch.columns[:2])
                yield pa.RecordBatch.from_arrays(
                    [
                        doc,
                        lang,
                        pa.array([b.astype("<i4").tobytes() for b, _ in out], pa.binary()),
                        pa.array([c.astype("<i4").tobytes() for _, c in out], pa.binary()),
                    ],
                    ["doc_id", "lang", "buckets", "counts"],
                )

    rows = texts.select("doc_id", "lang", "text").mapInArrow(run, "doc_id bigint, lang string, buckets binary, counts binary").collect()
    # a fixed order, mixing the languages: training must not depend on which task ended first
    rows.sort(key=lambda r: (r["doc_id"] * 2654435761 % 4294967296, r["doc_id"], r["lang"], bytes(r["buckets"])))
    languages = sorted({r["lang"] for r in rows})
    buckets, weights, target = [], [], []
    for r in rows:
        b, c = np.frombuffer(r["buckets"], "<i4"), np.frombuffer(r["counts"], "<i4")
        if len(b):
            buckets.append(b)
            weights.append(c / c.sum())
            target.append(languages.index(r["lang"]))
    if not target:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0, 1.0)
    return train(buckets, weights, np.array(target), languages)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """Per row of ``docs``: doc_id, lang_pred, score, rejected (score below the calibrated bound)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                lang, score = [UNDETERMINED] * len(chunk), np.zeros(len(chunk))
                if m.languages:
                    letters = has_letter(chunk)
                    p = m.probabilities(chunk)
                    score = np.where(letters, p.max(axis=1), 0.0)
                    lang = [m.languages[k] if ok else UNDETERMINED for k, ok in zip(p.argmax(axis=1), letters)]
                doc = batch.column(0).slice(chunk.first, len(chunk))
                yield pa.RecordBatch.from_arrays([doc, pa.array(lang, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = rows.mapInArrow(run, "doc_id bigint, lang_pred string, score double")
    return found.withColumn("rejected", F.col("score") < F.lit(model.reject_below))
