"""Approximate nearest neighbours by balanced posting lists (largest cosine).

1. On a bounded sample (``MAX_SAMPLE`` vectors by a hash of vec_id) the unit vectors are split in halves along
   their principal direction until there are enough lists, then moved a few times to the nearest centre with a penalty on
   full ones: lists of near-equal size. Their centroids are linked into a graph (nearest neighbours both ways and a ring),
   which is broadcast; its size is bounded by ``MAX_LISTS``.
2. Every vector is indexed: a best-first search of the graph finds its nearest centroids; besides the nearest list it is
   put into others up to ``COPIES`` whose distance is within ``(1 + COPY_RATIO)`` of the nearest (boundary vectors).
3. A query's lists come from the same graph, pruned by distance ratio (``PROBE_RATIO``), at least ``LEAST_PROBES`` and at
   most as many as this table needs: for ``TRIALS`` queries the true neighbours are found in the whole table, and from
   ``PROBES`` on the limit rises until ``RECALL`` of them are in a list that is read. Where the ratio prunes too much for
   that, it is given up, so in the end all lists are read. Lists are dealt to blocks of about ``BLOCK`` vectors and their
   queries to groups of as many, so a list of any size, however often it is asked, is no single task.
4. Blocks are scored exactly, in double precision, on the original vectors; the best are merged per query.

Equal vectors are searched once: of those only the ``k + 1`` smallest ids can be among the ``k`` nearest, as ties go to
the smaller id, and equal queries share a search. Vectors that are null, zero, hold a null or a non-finite component, lack
an id or have another length than most take no part. A vec_id that repeats with other vectors counts with its best score.
Extra columns are ignored; with no usable vector the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upkeep.llm.common import written

MAX_SAMPLE = 20_000
LIST_SIZE = 256
MAX_LISTS = 4096
COPIES = 4
COPY_RATIO = 0.15
PROBES = 64
LEAST_PROBES = 16
PROBE_RATIO = 0.35
TRIALS = 256
RECALL = 0.95
BLOCK = 4096
LINKS = 12


@dataclass(frozen=True)
class CentroidGraph:
    centroids: np.ndarray  # unit vectors
    links: np.ndarray  # neighbours of each centroid; may name one twice
    entries: np.ndarray

    def search(self, vectors: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroids and their distances, by best-first search of all vectors side by side."""
        n, c = len(vectors), len(self.centroids)
        beam = min(c, max(wanted + wanted // 2, 24))
        step = max(1, beam // 96)  # centroids opened at once: a wide beam takes no more rounds
        rows = np.arange(n)[:, None]
        seen = np.zeros((n, c), dtype=bool)
        ids = np.broadcast_to(self.entries, (n, len(self.entries))).copy()
        seen[:, self.entries] = True
        score = vectors @ self.centroids[self.entries].T
        done = np.zeros(ids.shape, dtype=bool)
        while True:
            open_score = np.where(done, -np.inf, score)
            most = min(step, open_score.shape[1])
            best = np.argpartition(-open_score, most - 1, axis=1)[:, :most] if most > 1 else open_score.argmax(axis=1)[:, None]
            opened = open_score[rows, best] > -np.inf
            active = np.flatnonzero(opened.any(axis=1))
            if not len(active):
                break
            done[active[:, None], best[active]] = True
            near = self.links[ids[active[:, None], best[active]]]
            near = np.where(opened[active][:, :, None], near, self.entries[0]).reshape(len(active), -1)  # an entry is seen
            fresh = ~seen[active[:, None], near]
            seen[active[:, None], near] = True
            # a centroid linked twice is fresh twice in this step only; the second is dropped
            order = np.argsort(near, axis=1, kind="stable")
            ordered = np.take_along_axis(near, order, axis=1)
            again = np.zeros(near.shape, dtype=bool)
            np.put_along_axis(again, order[:, 1:], ordered[:, 1:] == ordered[:, :-1], axis=1)
            fresh &= ~again
            found = np.where(fresh, np.einsum("nd,nkd->nk", vectors[active], self.centroids[near]), -np.inf)
            all_ids = np.concatenate([ids, np.zeros((n, near.shape[1]), ids.dtype)], axis=1)
            all_score = np.concatenate([score, np.full((n, near.shape[1]), -np.inf)], axis=1)
            all_done = np.concatenate([done, np.ones((n, near.shape[1]), bool)], axis=1)
            at = ids.shape[1]
            all_ids[active, at:], all_score[active, at:], all_done[active, at:] = near, found, ~fresh
            keep = np.argsort(-all_score, axis=1, kind="stable")[:, :beam]
            ids, score, done = all_ids[rows, keep], all_score[rows, keep], all_done[rows, keep]
        order = np.argsort(-score, axis=1, kind="stable")[:, :wanted]
        score = score[rows, order]
        return np.where(score > -np.inf, ids[rows, order], -1), np.sqrt(np.maximum(2 - 2 * score, 0))


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def fit_graph(sample: np.ndarray, lists: int, rounds: int = 4) -> CentroidGraph:
    """Balanced clusters of the sample and a graph of their centroids."""
    points = unit(sample)
    lists = max(1, min(lists, len(points)))
    groups = [np.arange(len(points))]
    while len(groups) < lists:
        groups.sort(key=len)
        g = groups.pop()
        centred = points[g] - points[g].mean(axis=0)
        direction = np.linalg.svd(centred[:512], full_matrices=False)[2][0]
        order = g[np.argsort(centred @ direction, kind="stable")]
        groups += [order[: len(g) // 2], order[len(g) // 2 :]]
    random = np.random.default_rng(20240501)
    centroids = np.array([points[g].mean(axis=0) for g in groups])
    for _ in range(rounds):
        lengths = np.sqrt((centroids * centroids).sum(axis=1, keepdims=True))
        centroids = np.where(lengths > 1e-12, centroids / np.maximum(lengths, 1e-12), points[random.integers(0, len(points), len(centroids))])
        score = points @ centroids.T
        sizes = np.bincount(score.argmax(axis=1), minlength=len(centroids)) / (len(points) / len(centroids))
        own = (score - 0.05 * sizes).argmax(axis=1)  # full lists give points away
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, points)
        centroids = np.where(np.bincount(own, minlength=len(centroids))[:, None] > 0, sums, centroids)
    lengths = np.sqrt((centroids * centroids).sum(axis=1, keepdims=True))
    centroids = np.where(lengths > 1e-12, centroids / np.maximum(lengths, 1e-12), points[: len(centroids)])
    c = len(centroids)
    nearest = np.argsort(-(centroids @ centroids.T), axis=1, kind="stable")[:, 1 : LINKS + 1]
    back: list[list[int]] = [[] for _ in range(c)]
    for i, row in enumerate(nearest.tolist()):
        for j in row:
            if len(back[j]) < LINKS:
                back[j].append(i)
    ring = random.permutation(c)
    following = np.empty(c, dtype=np.int64)
    following[ring] = np.roll(ring, -1)
    links = np.array([[*row, *b, *[following[i]] * (LINKS + 1 - len(b))] for i, (row, b) in enumerate(zip(nearest.tolist(), back))])
    return CentroidGraph(centroids, links.reshape(c, -1), ring[: min(c, 8)])


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (doubles) of the vectors that take part."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(
        ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))) & F.exists("embedding", lambda x: x != 0)
    )
    lengths = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows.where(F.size("embedding") == F.lit(lengths[0]["d"] if lengths else 0)).distinct()


def _matrix(column) -> np.ndarray:
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(array, pa.ChunkedArray):
        array = array.chunk(0)
    flat = array.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat.reshape(len(array), -1), dtype=np.float64)


def lists_of(graph: CentroidGraph, vectors: np.ndarray, wanted: int, least: int, ratio: float) -> list[list[int]]:
    ids, distance = graph.search(unit(vectors), wanted)
    keep = (distance <= (1 + ratio) * distance[:, :1]) | (np.arange(ids.shape[1]) < least)
    keep &= ids >= 0
    return [row[k].tolist() for row, k in zip(ids, keep)]


def _place(graph, wanted: int, least: int, ratio: float):
    """(..., embedding) -> the same with its lists: those within the distance ratio, ``least`` at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                part = batch.slice(first, 1024)
                lists = lists_of(graph.value, _matrix(part.column(part.num_columns - 1)), wanted, least, ratio)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lists, pa.list_(pa.int32()))], [*part.schema.names, "lists"])

    return run


def best(queries: np.ndarray, vectors: np.ndarray, ids: list[list[int]], k: int) -> Iterator[list[tuple[int, float]]]:
    """For each query the ``k`` best (vec_id, cosine), ties to the smaller id; the cosine is a plain double sum."""
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    for first in range(0, len(queries), 256):
        part = queries[first : first + 256]
        lengths = np.sqrt((part * part).sum(axis=1))
        rough = (part @ vectors.T) / (lengths[:, None] * norms)
        edge = np.partition(rough, max(0, len(vectors) - k), axis=1)[:, max(0, len(vectors) - k)] - 1e-9
        for q, length, row, least in zip(part, lengths, rough, edge):
            near = np.flatnonzero(row >= least)
            score = (vectors[near] * q).sum(axis=1) / (norms[near] * length)
            pairs = [(-s, v) for s, i in zip(score.tolist(), near.tolist()) for v in ids[i]]
            yield [(v, -s) for s, v in sorted(pairs)[:k]]


def _score(k: int):
    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if vectors.num_rows and queries.num_rows:
            names = zip(queries.column("q").to_pylist(), queries.column("qh").to_pylist())
            found = best(_matrix(queries.column("embedding")), _matrix(vectors.column("embedding")), vectors.column("ids").to_pylist(), k)
            out = [(q, qh, v, s) for (q, qh), pairs in zip(names, found) for v, s in pairs]
        columns = list(zip(*out)) or [[]] * 4
        kinds = [("q", pa.int64()), ("qh", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]
        return pa.table({n: pa.array(c, t) for (n, t), c in zip(kinds, columns)})

    return run


def _true(graph, trial, k: int):
    """(h, ids, embedding) -> of a partition, the ``k`` nearest other vectors of each trial query and the lists they are in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, queries = trial.value
        q = unit(queries)
        rows = np.arange(len(q))[:, None]
        score = np.full((len(q), k), -np.inf)
        found = np.zeros((len(q), k, q.shape[1]))
        for batch in batches:
            for first in range(0, batch.num_rows, 8192):
                part = batch.slice(first, 8192)
                vectors = _matrix(part.column(2))
                near = q @ unit(vectors).T
                near[hashes[:, None] == part.column(0).to_numpy(zero_copy_only=False)] = -np.inf
                top = np.argpartition(-near, min(k, len(vectors)) - 1, axis=1)[:, :k]
                every = np.concatenate([score, near[rows, top]], axis=1)
                keep = np.argsort(-every, axis=1, kind="stable")[:, :k]
                found = np.concatenate([found, vectors[top]], axis=1)[rows, keep]
                score = every[rows, keep]
        own, at = np.nonzero(score > -np.inf)
        for first in range(0, len(own), 1024):
            part = slice(first, first + 1024)
            lists = lists_of(graph.value, found[own[part], at[part]], COPIES, 1, COPY_RATIO)
            columns = [pa.array(own[part], pa.int32()), pa.array(score[own[part], at[part]]), pa.array(lists, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["t", "score", "lists"])

    return run


def enough(graph: CentroidGraph, queries: np.ndarray, true: list[tuple[int, list[int]]], probes: int) -> tuple[int, float]:
    """The first limit from ``probes`` on, and the ratio, by which ``RECALL`` of ``true`` (query, lists) are in a list read."""
    lists = len(graph.centroids)
    for ratio in (PROBE_RATIO, float("inf")):
        wanted = min(probes, lists)
        while True:
            read = [set(x) for x in lists_of(graph, queries, wanted, LEAST_PROBES, ratio)]
            if sum(not read[t].isdisjoint(x) for t, x in true) >= RECALL * len(true):
                return wanted, ratio
            if wanted == lists:
                break
            wanted = min(lists, wanted + max(1, wanted // 4))
    return lists, float("inf")


def _some(rows: DataFrame, key: Column, count: int, most: int) -> DataFrame:
    """At most ``most`` of ``count`` rows, the same ones each time: those below a bound on a hash first, so that no more than about
    that many come together, then the smallest hashes."""
    place = F.pmod(F.xxhash64(key), F.lit(1 << 40))
    share = min(1.0, 1.25 * most / max(count, 1) + 64 / max(count, 1))
    return rows.where(place < F.lit(int(share * (1 << 40)))).orderBy(place, key).limit(most)


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, probes: int = PROBES) -> DataFrame:
    """The ``k`` nearest rows of each row whose vec_id is divisible by ``every``: query_id, rank, vec_id, score.

    ``probes`` is the least limit of lists per query; it rises with what the table needs (``enough``).
    """
    spark = vectors.sparkSession
    rows = usable(vectors).withColumn("h", F.xxhash64("embedding"))
    smallest = Window.partitionBy("h", "embedding").orderBy("vec_id")
    kept = rows.withColumn("_r", F.row_number().over(smallest)).where(F.col("_r") <= F.lit(k + 1))
    classes = written(kept.groupBy("h", "embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select("h", "ids", "embedding"), "vectors")
    asked = written(rows.where(F.col("vec_id") % F.lit(every) == 0).select("vec_id", "h", "embedding"), "queries")

    count = classes.count()
    lists = min(MAX_LISTS, max(1, count // LIST_SIZE)) if count > 2 * LIST_SIZE else 1
    sample = _some(classes, F.get("ids", F.lit(0)), count, MAX_SAMPLE).select("embedding").toArrow()
    if not sample.num_rows:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    graph = spark.sparkContext.broadcast(fit_graph(_matrix(sample.column(0)), lists))

    index = classes.mapInArrow(_place(graph, COPIES, 1, COPY_RATIO), "h bigint, ids array<bigint>, embedding array<double>, lists array<int>")
    index = written(index.select("h", "ids", "embedding", F.explode("lists").alias("list")), "index")
    blocks = index.groupBy("list").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    dealt = index.join(blocks, "list").select("list", F.pmod("h", "blocks").cast("int").alias("block"), "ids", "embedding")
    one = asked.groupBy("h", "embedding").agg(F.min("vec_id").alias("q")).select("q", F.col("h").alias("qh"), "embedding")
    limit, ratio = probes, PROBE_RATIO
    if len(graph.value.centroids) > LEAST_PROBES:  # else all lists are read
        trial = _some(one, F.col("q"), one.count(), TRIALS).select("qh", "embedding").toArrow()
        if trial.num_rows:
            queries = _matrix(trial.column(1))
            asking = spark.sparkContext.broadcast((trial.column(0).to_numpy(), queries))
            true = classes.mapInArrow(_true(graph, asking, k), "t int, score double, lists array<int>")
            closest = Window.partitionBy("t").orderBy(F.desc("score"))
            true = true.withColumn("_r", F.row_number().over(closest)).where(F.col("_r") <= F.lit(k)).select("t", "lists").collect()
            limit, ratio = enough(graph.value, queries, [(t, x) for t, x in true], probes)
    probed = one.mapInArrow(_place(graph, limit, LEAST_PROBES, ratio), "q bigint, qh bigint, embedding array<double>, lists array<int>")
    probed = written(probed.select("q", "qh", "embedding", F.explode("lists").alias("list")), "probes")
    # the queries of a list are dealt to groups as its vectors are to blocks; each block meets each group in a task of its own
    groups = written(probed.groupBy("list").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("groups")), "query-groups")
    probed = probed.join(groups, "list").join(blocks, "list")
    probed = probed.select(
        "list", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.pmod(F.xxhash64("qh", "q"), "groups").cast("int").alias("part"), "q", "qh", "embedding"
    )
    dealt = dealt.join(groups, "list").select("list", "block", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"), "ids", "embedding")
    found = (
        dealt.groupBy("list", "block", "part")
        .cogroup(probed.groupBy("list", "block", "part"))
        .applyInArrow(_score(k + 1), "q bigint, qh bigint, vec_id bigint, score double")
        .groupBy("q", "qh", "vec_id")
        .agg(F.max("score").alias("score"))
    )
    order = Window.partitionBy("q", "qh").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= F.lit(k + 1)).drop("_r")
    shared = asked.groupBy("h", "embedding").agg(F.min("vec_id").alias("q"))
    named = asked.join(shared, ["h", "embedding"]).select(F.col("vec_id").alias("query_id"), "q", F.col("h").alias("qh"))
    pairs = named.join(found, ["q", "qh"]).where("vec_id != query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= F.lit(k))
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
