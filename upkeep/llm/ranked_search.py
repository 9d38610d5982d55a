"""Ranked lexical search of many items at once, by common subexpressions of their term sets.

Texts are cut into words (letters and digits, A-Z lower-cased). With ``N`` documents that have a term, ``L`` terms in all
of them, ``n`` in one of them, ``df`` documents holding a term and ``tf`` places of it in a document:

    weight = floor(1000 * ln((2 N + 2) / (2 df + 1)))             (in doubles; all else is 64-bit integer)
    m      = 100 - 90 + ((90 * n * N) div L)
    score  = sum over the item's terms of weight * ((1000000000 * tf) div (1000 * tf + 8 * m))

A score is a sum over terms, so items that share terms share parts of their scores:

1. Terms that stand in the same items are one node: their part of a document's score is one accumulator.
2. The pair of nodes that most items share becomes a node of its own, which replaces the pair there; again until no pair is
   shared. This gives a DAG from terms to items in which every shared part is summed once per document.
3. One pass over the texts writes each document's terms that any item asks for; statistics are counts over that table.
4. Another pass over that table fills the nodes for a batch of documents at a time, combines them along the DAG and
   keeps the best of each item; a window over the few that every task keeps gives the ranks.

Items are taken in blocks of about ``TERMS_PER_BLOCK`` terms, so what is planned and broadcast is bounded however many
items there are; each block is a pass over the documents.

Null and empty texts have no terms and are never found. Every row of the documents is ranked, so repeated rows have
equal scores and ranks of their own; equal scores go by doc_id, rows without an id last. Rows that repeat an item_id
are one item with the terms of all; items without an id are ignored, items without terms find nothing. Extra columns are
ignored; empty tables give no rows.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from upkeep.llm.common import LOWER, WORD_BYTE, Chunk, Hasher, chunks, list_array, release, written

TOP = 10
TERMS_PER_BLOCK = 20_000
DOCUMENTS_PER_STEP = 256
SALTS = 64
PAIRED = 200  # of an item's nodes the most widely held ones are looked at for pairs; only the plan depends on it


class Vocabulary:
    """Finds the given terms in a chunk of texts: by hash, then byte by byte."""

    def __init__(self, terms: list[bytes]) -> None:
        self.hasher = Hasher()
        data = np.frombuffer(b"".join(terms), dtype=np.uint8)
        ends = np.cumsum([len(t) for t in terms], dtype=np.int64) if terms else np.empty(0, dtype=np.int64)
        starts = np.append(0, ends[:-1]) if terms else ends
        hashes = self.hasher.ranges(data, starts, ends)
        self.order = np.argsort(hashes, kind="stable")
        self.sorted = hashes[self.order]
        self.data, self.starts, self.sizes = data, starts, ends - starts

    def find(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words per row, and (row, term) of every word that is a term."""
        data = LOWER[chunk.data]
        starts, ends, first = chunk.words(WORD_BYTE)
        n = np.diff(first)
        none = np.empty(0, dtype=np.int64)
        if not len(self.sorted) or not len(starts):
            return n, none, none
        words = self.hasher.ranges(data, starts, ends)
        owner = np.repeat(np.arange(len(chunk)), n)
        at = np.searchsorted(self.sorted, words)
        at[at == len(self.sorted)] = 0
        hit = np.flatnonzero(self.sorted[at] == words)
        rows, terms = [], []
        while len(hit):  # terms with equal hashes follow each other: more than one turn only then
            term = self.order[at[hit]]
            size = ends[hit] - starts[hit]
            same = size == self.sizes[term]
            for part in range(0, len(hit), 1 << 18):
                piece = slice(part, part + (1 << 18))
                s = np.where(same[piece], size[piece], 0)
                word = np.repeat(np.arange(len(s)), s)
                inner = np.arange(len(word)) - np.repeat(np.cumsum(s) - s, s)
                unequal = data[np.repeat(starts[hit[piece]], s) + inner] != self.data[np.repeat(self.starts[term[piece]], s) + inner]
                same[part + word[unequal]] = False
            rows.append(owner[hit[same]])
            terms.append(term[same])
            hit = hit[~same]
            at[hit] += 1
            hit = hit[at[hit] < len(self.sorted)]
            hit = hit[self.sorted[at[hit]] == words[hit]]
        return n, np.concatenate(rows) if rows else none, np.concatenate(terms) if terms else none


@dataclass(frozen=True)
class SharingPlan:
    """The DAG: ``node_of`` term -> its first node, ``pairs`` (new node, node, node) in order, ``parts`` nodes per item."""

    node_of: np.ndarray
    pairs: list[tuple[int, int, int]]
    parts: list[list[int]]
    n_nodes: int

    def additions(self) -> int:
        """Additions per document once the nodes of the terms are filled."""
        return len(self.pairs) + sum(max(len(p) - 1, 0) for p in self.parts)


def share(items: list[Iterable[int]], n_terms: int) -> SharingPlan:
    """The query-sharing DAG of items given as term numbers."""
    sets = [sorted(set(terms)) for terms in items]
    holders: dict[int, list[int]] = defaultdict(list)
    for i, terms in enumerate(sets):
        for t in terms:
            holders[t].append(i)
    by_items: dict[tuple[int, ...], int] = {}
    node_of = np.zeros(n_terms, dtype=np.int64)
    for t in sorted(holders):
        node_of[t] = by_items.setdefault(tuple(holders[t]), len(by_items))
    parts = [{int(node_of[t]) for t in terms} for terms in sets]
    held = [set(key) for key in by_items]  # items that hold a node

    shared: Counter[tuple[int, int]] = Counter()
    for part in parts:
        own = sorted(sorted((n for n in part if len(held[n]) > 1), key=lambda n: (-len(held[n]), n))[:PAIRED])
        shared.update((a, b) for i, a in enumerate(own) for b in own[i + 1 :])
    queue = [(-c, pair) for pair, c in shared.items() if c > 1]
    heapq.heapify(queue)
    live = {n for pair in shared for n in pair}
    pairs: list[tuple[int, int, int]] = []
    while queue:
        count, (a, b) = heapq.heappop(queue)
        both = held[a] & held[b]
        if len(both) < 2:
            continue
        if len(both) != -count:  # counted before other merges: back with its present count
            heapq.heappush(queue, (-len(both), (a, b)))
            continue
        new = len(held)
        held.append(both)
        pairs.append((new, a, b))
        held[a] -= both
        held[b] -= both
        near: Counter[int] = Counter()
        for i in both:
            parts[i] -= {a, b}
            near.update(n for n in parts[i] if n in live)
            parts[i].add(new)
        live.add(new)
        for n, c in sorted(near.items()):
            if c > 1:
                heapq.heappush(queue, (-c, (min(n, new), max(n, new))))
    return SharingPlan(node_of, pairs, [sorted(p) for p in parts], len(held))


class Best:
    """The best ``top`` documents of each item so far: score descending, then rows with an id, then doc_id."""

    def __init__(self, n_items: int, top: int) -> None:
        self.top = top
        self.score = np.zeros((n_items, top), dtype=np.int64)
        self.doc = np.zeros((n_items, top), dtype=np.int64)
        self.unnamed = np.ones((n_items, top), dtype=bool)

    def add(self, item: int, score: np.ndarray, doc: np.ndarray, unnamed: np.ndarray) -> None:
        near = np.flatnonzero((score > 0) & (score >= self.score[item, -1]))
        if not len(near):
            return
        s, d, u = (np.append(a[item], b[near]) for a, b in ((self.score, score), (self.doc, doc), (self.unnamed, unnamed)))
        best = np.lexsort((d, u, -s))[: self.top]
        self.score[item], self.doc[item], self.unnamed[item] = s[best], d[best], u[best]


def node_scores(plan: SharingPlan, rows: np.ndarray, terms: np.ndarray, parts: np.ndarray, n_rows: int) -> np.ndarray:
    """All nodes (nodes x documents) from the documents' (row, term, part of the score)."""
    nodes = np.zeros(plan.n_nodes * n_rows, dtype=np.int64)
    np.add.at(nodes, plan.node_of[terms] * n_rows + rows, parts)
    nodes = nodes.reshape(plan.n_nodes, n_rows)
    for new, a, b in plan.pairs:
        np.add(nodes[a], nodes[b], out=nodes[new])
    return nodes


def _scan_terms(vocabulary):
    """(doc_id, text) -> doc_id, n, distinct terms found and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vocabulary(vocabulary.value)
        size = max(len(vocabulary.value), 1)
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                n, row, term = known.find(chunk)
                cell, tf = np.unique(row * size + term, return_counts=True)
                per_row = np.bincount(cell // size, minlength=len(chunk))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.first, len(chunk)),
                        pa.array(n.astype(np.int64)),
                        list_array(pa.array((cell % size).astype(np.int32)), per_row),
                        list_array(pa.array(tf.astype(np.int64)), per_row),
                    ],
                    ["doc_id", "n", "terms", "tf"],
                )

    return run


def _rank(shared, top: int):
    """(doc_id, n, terms, tf) -> the best of each item in this task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, weight, documents, total = shared.value
        best = Best(len(plan.parts), top)
        for batch in batches:
            for first in range(0, batch.num_rows, DOCUMENTS_PER_STEP):
                part = batch.slice(first, DOCUMENTS_PER_STEP)
                unnamed = part.column(0).is_null().to_numpy(zero_copy_only=False)
                doc = part.column(0).fill_null(0).to_numpy()
                n = part.column(1).to_numpy()
                row = np.repeat(np.arange(len(doc)), np.diff(part.column(2).offsets.to_numpy()))
                terms, tf = (part.column(j).flatten().to_numpy() for j in (2, 3))
                m = np.array([10 + 90 * k * documents // total for k in n.tolist()], dtype=np.int64)  # exact for any size
                scores = weight[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
                nodes = node_scores(plan, row, terms, scores, len(doc))
                for item, own in enumerate(plan.parts):
                    if own:
                        best.add(item, nodes[own].sum(axis=0), doc, unnamed)
        item, place = np.nonzero(best.score > 0)
        ids = pa.array(best.doc[item, place], pa.int64(), mask=best.unnamed[item, place])
        yield pa.RecordBatch.from_arrays([pa.array(item.astype(np.int64)), ids, pa.array(best.score[item, place])], ["item", "doc_id", "score"])

    return run


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, terms): the distinct terms of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                text = LOWER[chunk.data].tobytes()
                starts, ends, first = chunk.words(WORD_BYTE)
                words = [text[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist())]
                own = [sorted(set(words[a:b])) for a, b in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(chunk.first, len(chunk)), pa.array(own, pa.list_(pa.string()))], ["item_id", "terms"])

    kind = items.schema["item_id"].dataType
    named = items.where(F.col("item_id").isNotNull()).select("item_id", "text")
    each = named.mapInArrow(run, f"item_id {kind.simpleString()}, terms array<string>")
    return each.select("item_id", F.explode("terms").alias("term")).groupBy("item_id").agg(F.sort_array(F.collect_set("term")).alias("terms"))


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` documents with the highest scores above 0 for each item: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    asked = written(item_terms(items), "item-terms")
    total_terms = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, -(-total_terms // TERMS_PER_BLOCK))
    out = None
    for block in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == F.lit(block)).orderBy("item_id").collect()
        vocabulary = sorted({t for r in own for t in r["terms"]})
        number = {t: i for i, t in enumerate(vocabulary)}
        shared_terms = spark.sparkContext.broadcast([t.encode() for t in vocabulary])
        found = texts.mapInArrow(_scan_terms(shared_terms), "doc_id bigint, n bigint, terms array<int>, tf array<bigint>")
        found = written(found.where("n > 0"), "document-terms")
        documents, total = found.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        holding = found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()  # one row per term
        weight = np.zeros(len(vocabulary), dtype=np.int64)
        for term, df in holding:
            weight[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
        plan = share([[number[t] for t in r["terms"]] for r in own], len(vocabulary))
        shared_plan = spark.sparkContext.broadcast((plan, weight, documents, total))
        kept = found.where(F.size("terms") > 0).mapInArrow(_rank(shared_plan, top), "item bigint, doc_id bigint, score bigint")
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        kept = kept.withColumn("salt", F.pmod(F.xxhash64("doc_id", F.spark_partition_id()), F.lit(SALTS)))
        kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= top)
        ranks = kept.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(own)], f"item bigint, item_id {items.schema['item_id'].dataType.simpleString()}")
        ranked = written(ranks.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"), "ranks")
        out = ranked if out is None else out.unionByName(ranked)
        release(spark)
    return out
