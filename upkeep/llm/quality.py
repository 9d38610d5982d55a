"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics are computed from the whole text, vectorised over the bytes of a batch. The trees are fitted in numpy on
a bounded sample of labelled documents (``max_train`` of them by a hash of doc_id, so the same ones each time, one text each),
flattened into arrays and applied by vectorised traversal inside Spark tasks.

Null and empty texts have all statistics 0 and get a score like any other text. Labels that are null are ignored,
repeated labels of a document are averaged, and without any usable label every score is 0.5. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.common import NON_SPACE_BYTE, Chunk, Hasher, chunks, one_text_each, sample_of_classes

MAX_TRAIN = 20_000
HELD_OUT_MODULUS = 4
HELD_OUT_REMAINDER = 2
THRESHOLD = 0.7

_BYTE = np.arange(256)
_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
_LETTER = _UPPER | ((_BYTE >= 97) & (_BYTE <= 122)) | (_BYTE >= 128)
_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_SPACE = ~NON_SPACE_BYTE
_SENTENCE = np.isin(_BYTE, [ord(c) for c in ".,;:?'\"-()"])
_SYMBOL = ~(_LETTER | _DIGIT | _SPACE | _SENTENCE)
_CLASSES = {
    "upper": _UPPER,
    "letter": _LETTER,
    "digit": _DIGIT,
    "space": _SPACE,
    "newline": _BYTE == 10,
    "sentence": _SENTENCE,
    "symbol": _SYMBOL,
    "stop": np.isin(_BYTE, [ord(c) for c in ".!?"]),
    "wide": _BYTE >= 128,
}
FEATURES = [
    "log_bytes", "log_words", *(f"{c}_share" for c in _CLASSES), "word_mean", "word_deviation", "word_longest", "distinct_words",
    "distinct_pairs", "commonest_word", "repeated_next", "log_lines", "distinct_lines", "line_words", "symbol_words", "entropy",
]


def _per_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive bounds (empty rows give 0)."""
    sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _distinct(owner: np.ndarray, hashes: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the number of distinct hashes and the count of its commonest one."""
    order = np.lexsort((hashes, owner))
    o, h = owner[order], hashes[order]
    first = np.ones(len(o), dtype=bool)
    first[1:] = (o[1:] != o[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(first)
    runs = np.diff(np.append(at, len(o)))
    most = np.zeros(rows)
    np.maximum.at(most, o[at], runs)
    return np.bincount(o[at], minlength=rows).astype(np.float64), most


def statistics(chunk: Chunk, hasher: Hasher) -> np.ndarray:
    """One row of ``FEATURES`` per document of the chunk."""
    rows, data, bounds = len(chunk), chunk.data, chunk.bounds
    n_bytes = np.diff(bounds).astype(np.float64)
    per_byte = np.maximum(n_bytes, 1)
    out = {"log_bytes": np.log1p(n_bytes)}
    for name, table in _CLASSES.items():
        out[f"{name}_share"] = _per_row(table[data], bounds) / per_byte

    starts, ends, first = chunk.words(NON_SPACE_BYTE)
    owner = np.repeat(np.arange(rows), np.diff(first))
    n_words = np.diff(first).astype(np.float64)
    per_word = np.maximum(n_words, 1)
    hashes = hasher.ranges(data, starts, ends)
    lengths = (ends - starts).astype(np.float64)
    mean = _per_row(lengths, first) / per_word
    out["log_words"] = np.log1p(n_words)
    out["word_mean"] = mean
    out["word_deviation"] = np.sqrt(np.maximum(_per_row(lengths**2, first) / per_word - mean**2, 0))
    longest = np.zeros(rows)
    np.maximum.at(longest, owner, lengths)
    out["word_longest"] = np.log1p(longest)
    distinct, most = _distinct(owner, hashes, rows)
    out["distinct_words"] = distinct / per_word
    out["commonest_word"] = most / per_word
    same_row = owner[1:] == owner[:-1]
    pairs = (hashes[1:] * np.uint64(31) + hashes[:-1])[same_row]
    distinct_pairs, _ = _distinct(owner[1:][same_row], pairs, rows)
    out["distinct_pairs"] = distinct_pairs / np.maximum(n_words - 1, 1)
    again = np.concatenate([(hashes[1:] == hashes[:-1]) & same_row, [False]])[: len(hashes)]
    out["repeated_next"] = _per_row(again, first) / per_word
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    out["symbol_words"] = _per_row(symbols[ends] > symbols[starts], first) / per_word

    line_starts, line_ends, line_first = chunk.words(_BYTE != 10)
    n_lines = np.diff(line_first).astype(np.float64)
    line_owner = np.repeat(np.arange(rows), np.diff(line_first))
    distinct_lines, _ = _distinct(line_owner, hasher.ranges(data, line_starts, line_ends), rows)
    out["log_lines"] = np.log1p(n_lines)
    out["distinct_lines"] = distinct_lines / np.maximum(n_lines, 1)
    out["line_words"] = np.log1p(n_words / np.maximum(n_lines, 1))

    row_of_byte = np.repeat(np.arange(rows), np.diff(bounds))
    counts = np.bincount(row_of_byte * 256 + data, minlength=rows * 256).reshape(rows, 256)
    share = counts / per_byte[:, None]
    out["entropy"] = -np.sum(share * np.log2(np.where(share > 0, share, 1)), axis=1)
    return np.column_stack([out[f] for f in FEATURES]).astype(np.float64)


@dataclass(frozen=True)
class Trees:
    """Boosted trees of equal depth as arrays: node ``i`` has children ``2i+1`` and ``2i+2``."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray  # trees x inner nodes; larger values go right
    leaf: np.ndarray  # trees x leaves

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1] if self.feature.size else 0
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            while inner and node.size and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - inner]
        return 1.0 / (1.0 + np.exp(-total))


def fit_trees(
    x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, smooth: float = 2.0
) -> Trees:
    """Logistic gradient boosting on feature histograms; ``y`` in 0..1."""
    inner, leaves = (1 << depth) - 1, 1 << depth
    if not len(x):
        return Trees(0.0, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, leaves)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)])
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    margin = np.full(len(y), base)
    all_feature, all_threshold, all_leaf = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, hessian = y - p, p * (1 - p)
        feature, threshold = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            base_node, count = (1 << level) - 1, 1 << level
            local = node - base_node
            best = np.full(count, 1e-6)
            for f in range(x.shape[1]):
                width = len(edges[f]) + 1
                if width < 2:
                    continue
                cell = local * width + binned[:, f]
                g = np.cumsum(np.bincount(cell, gradient, count * width).reshape(count, width), axis=1)
                h = np.cumsum(np.bincount(cell, hessian, count * width).reshape(count, width), axis=1)
                gl, hl, gt, ht = g[:, :-1], h[:, :-1], g[:, -1:], h[:, -1:]
                gain = gl**2 / (hl + smooth) + (gt - gl) ** 2 / (ht - hl + smooth) - gt**2 / (ht + smooth)
                cut = gain.argmax(axis=1)
                value = gain[np.arange(count), cut]
                better = value > best
                best[better] = value[better]
                feature[base_node + np.flatnonzero(better)] = f
                threshold[base_node + np.flatnonzero(better)] = edges[f][cut[better]]
            node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > threshold[node])
        at = node - inner
        leaf = rate * np.bincount(at, gradient, leaves) / (np.bincount(at, hessian, leaves) + smooth)
        margin += leaf[at]
        all_feature.append(feature)
        all_threshold.append(threshold)
        all_leaf.append(leaf)
    return Trees(base, np.array(all_feature), np.array(all_threshold), np.array(all_leaf))


def held_out() -> F.Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(HELD_OUT_MODULUS)) == F.lit(HELD_OUT_REMAINDER)


def fit_quality(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Trees:
    """Trees fitted on at most ``max_train`` labelled documents outside the held-out fold."""
    known = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("double").alias("quality"))
        .where(~held_out())
        .groupBy("doc_id")
        .agg(F.avg("quality").alias("quality"))
    )
    sample = sample_of_classes(known.select("doc_id", F.lit(1).alias("any")), max_train)
    if not sample:
        return fit_trees(np.zeros((0, len(FEATURES))), np.zeros(0))
    ids = docs.sparkSession.createDataFrame([(doc,) for doc, _ in sample], "doc_id bigint")
    texts = one_text_each(docs, known.join(F.broadcast(ids), "doc_id"))  # at most max_train ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for chunk in chunks(batch.column(2)):
                x = statistics(chunk, hasher)
                doc, label = (c.slice(chunk.first, len(chunk)) for c in batch.columns[:2])
                yield pa.RecordBatch.from_arrays([doc, label, pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "quality", "x"])

    rows = texts.select("doc_id", "quality", "text").mapInArrow(run, "doc_id bigint, quality double, x array<double>").collect()
    rows.sort(key=lambda r: r["doc_id"])  # the order in which tasks end must not show in the trees
    if not rows:
        return fit_trees(np.zeros((0, len(FEATURES))), np.zeros(0))
    return fit_trees(np.array([r["x"] for r in rows]), np.array([r["quality"] for r in rows]))


def quality_scores(docs: DataFrame, trees: Trees, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: all its columns but text, then score and predicted (score >= threshold)."""
    model = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                score = model.value.scores(statistics(chunk, hasher))
                doc = batch.column(0).slice(chunk.first, len(chunk))
                yield pa.RecordBatch.from_arrays([doc, pa.array(score)], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    scored = rows.mapInArrow(run, "doc_id bigint, score double")
    return scored.withColumn("predicted", (F.col("score") >= F.lit(threshold)).cast("int"))


def keep_good(docs: DataFrame, trees: Trees, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the trees do not reject, with all their columns; texts are not shuffled."""
    model = docs.sparkSession.sparkContext.broadcast(trees)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for chunk in chunks(batch.column(at)):
                good = model.value.scores(statistics(chunk, hasher)) >= threshold
                yield batch.slice(chunk.first, len(chunk)).filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
