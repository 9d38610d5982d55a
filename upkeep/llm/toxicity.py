"""Toxicity classifier, regularised by counterfactuals of identity terms.

A text is described by its words and the leading 3 to 6 bytes of longer words (A-Z lower-cased), hashed into ``BUCKETS``;
the value of a bucket is the square root of its share of the words, scaled by the squared log ratio of the documents of
either class that hold it (rare buckets are left out). A logistic model over that is trained in numpy by stochastic
gradient descent with adaptive steps on a bounded sample: ``per_class`` toxic and as many other labelled documents
outside the held-out fold, one text of each.

Mentioning a group is not toxic. In the labelled sentences of the sample that name one (``IDENTITY_TERMS``), the name is
swapped for others of its category, and every step also penalises the squared change of the score that the swap
makes, so the weights of such names are drawn together and toxic neighbours do not colour them.

Null and empty texts have no words and get the score of the bias alone. Labels that are null are ignored, repeated labels
of a document are averaged, and without any usable label every score is 0.5. Of a doc_id with several texts the one of the
least hash is learned from. Rows are scored one by one; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.common import LOWER, WORD_BYTE, Chunk, Hasher, chunks, mix, one_text_each, sample_of_classes

BUCKETS = 1 << 18
PREFIXES = (3, 4, 5, 6)
PER_CLASS = 4_000
SENTENCES = 8  # counterfactual sentences of one document of the sample
SWAPS = 2  # swapped versions of a sentence
STRENGTH = 20.0
HELD_OUT_MODULUS = 5
THRESHOLD = 0.5

IDENTITY_TERMS = {
    "gender": "women men woman man girls boys female male frauen männer femmes hommes mujeres hombres transgender nonbinary".split(),
    "religion": "muslim muslims christian christians jewish jews hindu hindus buddhist buddhists sikh atheist catholic protestant".split(),
    "origin": "african asian european american mexican chinese indian arab turkish polish russian german french spanish italian immigrant immigrants refugee refugees".split(),
    "colour": "black white brown latino latina indigenous".split(),
    "sexuality": "gay lesbian straight bisexual queer heterosexual homosexual".split(),
    "ability": "blind deaf disabled autistic wheelchair able".split(),
    "age": "old young elderly teenage".split(),
}
_CATEGORY = {term: mates for mates in IDENTITY_TERMS.values() for term in mates}
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_SENTENCE = re.compile(r"[^.!?\n]+")


def features(chunk: Chunk, hasher: Hasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, value) of every bucket that a row of the chunk has, ordered by row."""
    data = LOWER[chunk.data]
    starts, ends, first = chunk.words(WORD_BYTE)
    n = np.diff(first)
    row = np.repeat(np.arange(len(chunk)), n)
    sums = hasher.sums(data)
    cells = [row * BUCKETS + (hasher.between(sums, starts, ends) & np.uint64(BUCKETS - 1)).astype(np.int64)]
    for k in PREFIXES:
        long = np.flatnonzero(ends - starts > k)
        start = starts[long]
        bucket = mix(hasher.between(sums, start, start + k) + np.uint64(k)) & np.uint64(BUCKETS - 1)
        cells.append(row[long] * BUCKETS + bucket.astype(np.int64))
    cell = np.sort(np.concatenate(cells))
    at = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])) if len(cell) else np.empty(0, dtype=np.int64)
    count = np.diff(np.append(at, len(cell)))
    row = cell[at] // BUCKETS
    return row, cell[at] % BUCKETS, np.sqrt(count / n[row])


def swaps(text: str, sentences: int = SENTENCES, versions: int = SWAPS) -> list[tuple[str, str]]:
    """(sentence, sentence with its identity terms swapped) of the first sentences that name a group."""
    out = []
    for found in _SENTENCE.finditer(text.lower()):
        sentence = found.group()
        named = [w for w in _WORD.findall(sentence) if w in _CATEGORY]
        if not named:
            continue
        for v in range(1, versions + 1):

            def other(m: re.Match) -> str:
                mates = _CATEGORY.get(m.group())
                return mates[(mates.index(m.group()) + v * (len(sentence) % (len(mates) - 1) + 1)) % len(mates)] if mates else m.group()

            out.append((sentence, _WORD.sub(other, sentence)))
        if len(out) >= sentences * versions:
            break
    return out


def sparse_rows(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, values) of each text."""
    out = []
    for chunk in chunks(pa.array(texts, pa.string())):
        row, bucket, value = features(chunk, Hasher())
        bounds = np.searchsorted(row, np.arange(len(chunk) + 1))
        out += [(bucket[a:b], value[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    return out


def difference(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """``a - b`` of two sparse rows."""
    bucket, at = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    value = np.bincount(at, np.concatenate([a[1], -b[1]]), len(bucket))
    return bucket[value != 0], value[value != 0]


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray
    bias: float

    def scores(self, chunk: Chunk, hasher: Hasher) -> np.ndarray:
        row, bucket, value = features(chunk, hasher)
        margin = self.bias + np.bincount(row, value * self.weights[bucket], len(chunk))
        return 1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500)))


Sparse = tuple[np.ndarray, np.ndarray]


def class_ratio(rows: list[Sparse], target: np.ndarray, smooth: float = 5.0, least: int = 3) -> np.ndarray:
    """Squared log ratio of the shares of toxic and other documents that hold each bucket; 0 below ``least`` documents."""
    toxic, other = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for (bucket, _), label in zip(rows, target):
        (toxic if label else other)[bucket] += 1
    n_toxic, n_other = max(target.sum(), 1.0), max((1 - target).sum(), 1.0)
    share = n_toxic / (n_toxic + n_other)
    ratio = np.log((toxic + smooth * share) / n_toxic) - np.log((other + smooth * (1 - share)) / n_other)
    return np.where(toxic + other >= least, ratio**2, 0.0)


def train(
    rows: list[Sparse],
    target: np.ndarray,
    changes: list[list[Sparse]],
    epochs: int = 8,
    rate: float = 0.5,
    strength: float = STRENGTH,
    decay: float = 1e-4,
) -> ToxicityModel:
    """Logistic model over sparse rows; ``changes[i]`` are the counterfactual differences of row ``i``, whose scores are
    drawn to 0 with ``strength``."""
    scale = class_ratio(rows, target)
    own = [(bucket, value * scale[bucket]) for bucket, value in rows]
    swapped = [[(bucket, value * scale[bucket]) for bucket, value in c] for c in changes]
    weights, seen = np.zeros(BUCKETS), np.full(BUCKETS, 1e-2)
    bias, seen_bias = 0.0, 1e-2
    random = np.random.default_rng(20240611)
    for _ in range(epochs):
        for i in random.permutation(len(own)):
            bucket, value = own[i]
            margin = bias + float(value @ weights[bucket])
            error = 1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500))) - target[i]
            gradient = error * value + decay * weights[bucket]
            seen[bucket] += gradient**2
            weights[bucket] -= rate * gradient / np.sqrt(seen[bucket])
            seen_bias += error**2
            bias -= rate * error / np.sqrt(seen_bias)
            for at, change in swapped[i]:
                # an implicit step on strength * (change @ weights) ** 2, which cannot overshoot
                step = strength * rate / len(swapped[i])
                weights[at] -= float(change @ weights[at]) * step / (1.0 + step * float(change @ change)) * change
    return ToxicityModel((weights * scale).astype(np.float32), float(bias))


def held_out() -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(HELD_OUT_MODULUS)) == F.lit(0), F.lit(False))


def training_texts(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """(doc_id, toxic, text): at most ``per_class`` labelled documents of each class outside the held-out fold, one text each."""
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("double").alias("toxic"))
        .where(~held_out())
        .groupBy("doc_id")
        .agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic"))
    )
    ids = docs.sparkSession.createDataFrame(sample_of_classes(known, per_class), "doc_id bigint, toxic int")
    return one_text_each(docs, ids)


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, strength: float = STRENGTH) -> ToxicityModel:
    """The model learned from ``training_texts``."""
    row = "struct<buckets:binary,values:binary>"
    kind = pa.struct([("buckets", pa.binary()), ("values", pa.binary())])

    def pack(sparse: Sparse) -> dict:
        return {"buckets": sparse[0].astype("<i4").tobytes(), "values": sparse[1].astype("<f4").tobytes()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                texts = part.column(2).to_pylist()
                pairs = [swaps(t) for t in texts]
                changes = [[difference(*sparse_rows(list(p))) for p in own] for own in pairs]
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[:2],
                        pa.array([pack(s) for s in sparse_rows(texts)], kind),
                        pa.array([[pack(c) for c in own] for own in changes], pa.list_(kind)),
                    ],
                    ["doc_id", "toxic", "own", "changes"],
                )

    sample = training_texts(docs, labels, per_class)
    rows = sample.mapInArrow(run, f"doc_id bigint, toxic int, own {row}, changes array<{row}>").collect()  # at most 2 * per_class
    rows.sort(key=lambda r: r["doc_id"])  # the order in which tasks end must not show in the model

    def unpack(r) -> Sparse:
        return np.frombuffer(r["buckets"], "<i4"), np.frombuffer(r["values"], "<f4").astype(np.float64)

    target = np.array([r["toxic"] for r in rows], dtype=np.float64)
    return train([unpack(r["own"]) for r in rows], target, [[unpack(c) for c in r["changes"]] for r in rows], strength=strength)


def toxicity_scores(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: doc_id, score, predicted (score >= threshold)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                score = shared.value.scores(chunk, hasher)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(chunk.first, len(chunk)), pa.array(score)], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    scored = rows.mapInArrow(run, "doc_id bigint, score double")
    return scored.withColumn("predicted", (F.col("score") >= F.lit(threshold)).cast("int"))
