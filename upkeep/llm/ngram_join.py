"""Exact Jaccard self-join on word n-grams by multiple-global-order filtering, and its components.

A document is the set of its distinct ``K``-word shingles (fewer words: the whole sequence is its one shingle; no words:
the empty set, linked with nothing). Two sets link when ``100 * |A & B| >= percent * |A | B|``. Under any global order of
the shingles, linked sets share a shingle among their first ``p(n) = n - ceil(percent * n / 100) + 1`` ones, and ``k + 1``
shingles among their first ``p(n) + k``. That holds for every order, so candidates must pass several before the sets are
compared in full:

1. first order (by hash), prefixes of ``DEPTH_PERCENT`` of ``p(n)``: a document is done unless it has as many shingles in
   common with others there as a link needs; common passages are too few for that.
2. second order (rarest first among the documents left, all their shingles counted), ``p(n)`` shingles: a document whose
   own shingles fill its prefix is done; prefix shingles of more than one document are the postings that give pairs, and a
   pair must have room for enough common shingles after the first.
3. all hash orders, pair by pair: the prefixes must meet under each.

Exact copies are one class from the start. Within a posting not all pairs are formed: each set is first compared with one
leader, ``STARS`` times with other leaders, links become components, and only pairs across components are formed
afterwards, so a group of thousands of near copies costs a few comparisons per member, and no link between different
components is lost.

Shingles are compared by 64-bit hashes. Rows with a null doc_id are returned with a null component. Rows repeating a
doc_id with other texts are one node with the links of each. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from upkeep.llm.common import LOWER, NON_SPACE_BYTE, Chunk, Hasher, chunks, list_array, mix, release, shingle_hashes, written
from upkeep.llm.components import connected_components
from upkeep.operators.ids import with_sequence

K = 5
PERCENT = 80
DEPTH_PERCENT = 150
ROWS_PER_BLOCK = 50_000_000
STARS = 3
MEMBERS_PER_TASK = 128
# the global orders: by hash, and by two other hashes of it
ORDERS = (None, np.uint64(0x51ED270B9F1E35A5), np.uint64(0xA24BAED4963EE407))


def prefix_length(n, percent: int):
    return n - (percent * n + 99) // 100 + 1


def deep_length(n, percent: int):
    """``DEPTH_PERCENT`` of the prefix, at most ``n``."""
    return np.minimum(n, prefix_length(n, percent) * DEPTH_PERCENT // 100)


def _prefix_sql(n: str, percent: int) -> str:
    return f"({n} - ({percent} * ({n}) + 99) div 100 + 1)"


def _deep_sql(n: str, percent: int) -> str:
    return f"least({n}, {_prefix_sql(n, percent)} * {DEPTH_PERCENT} div 100)"


def shingle_sets(chunk: Chunk, hasher: Hasher, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending within each row, and row bounds."""
    data = LOWER[chunk.data]
    starts, ends, first = chunk.words(NON_SPACE_BYTE)
    words = hasher.ranges(data, starts, ends)
    n_words = np.diff(first)
    grams = shingle_hashes(words, k)
    owner = np.repeat(np.arange(len(chunk)), n_words)
    whole = np.flatnonzero(np.arange(len(grams)) + k <= np.repeat(first[1:], n_words)[: len(grams)])
    rows, hashes = [owner[whole]], [grams[whole]]
    for n in range(1, k):  # short texts: the whole sequence, told apart by its length
        short = np.flatnonzero(n_words == n)
        if len(short):
            rows.append(short)
            hashes.append(mix(shingle_hashes(words, n)[first[short]] + np.uint64(n)))
    row, h = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    row, h = row[new], h[new]
    return h, np.searchsorted(row, np.arange(len(chunk) + 1))


def _deep_prefixes(h: np.ndarray, bounds: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The first hashes of each row, and how many."""
    n = np.diff(bounds)
    take = np.where(n > 0, deep_length(n, percent), 0)
    rank = np.arange(len(h)) - np.repeat(bounds[:-1], n)
    return h[rank < np.repeat(take, n)], take


def _row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values, out=sums[1:])
    return (sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64)


def _scan(k: int, percent: int):
    """(doc_id, text) -> doc_id, n, two hashes of the set, and its deep prefix by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                h, bounds = shingle_sets(chunk, hasher, k)
                prefix, sizes = _deep_prefixes(h, bounds, percent)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.first, len(chunk)),
                        pa.array(np.diff(bounds).astype(np.int64)),
                        pa.array(_row_sums(h, bounds)),
                        pa.array(_row_sums(mix(h ^ ORDERS[-1]), bounds)),
                        list_array(pa.array(prefix.view(np.int64)), sizes),
                    ],
                    ["doc_id", "n", "h1", "h2", "prefix"],
                )

    return run


def _scan_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                h, bounds = shingle_sets(chunk, hasher, k)
                sets = [h[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
                doc = batch.column(0).slice(chunk.first, len(chunk))
                yield pa.RecordBatch.from_arrays([doc, pa.array(sets, pa.binary())], ["doc", "hashes"])

    return run


def _first(h: np.ndarray, n: int) -> np.ndarray:
    return np.partition(h, n - 1)[:n]


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two ascending hash sets link: a common prefix shingle under each order first, then the whole sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    m, n = prefix_length(len(a), percent), prefix_length(len(b), percent)
    for seed in ORDERS:
        x, y = (a[:m], b[:n]) if seed is None else (_first(mix(a ^ seed), m), _first(mix(b ^ seed), n))
        if not len(np.intersect1d(x, y, assume_unique=True)):
            return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _verify(percent: int):
    def run(sets: pa.Table, pairs: pa.Table) -> pa.Table:
        own: dict[int, list[np.ndarray]] = {}
        for doc, hashes in zip(sets.column("doc").to_pylist(), sets.column("hashes").to_pylist()):
            own.setdefault(doc, []).append(np.frombuffer(hashes, dtype=np.uint64))
        found = [
            (a, b)
            for a, b in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist())
            if any(similar(x, y, percent) for x in own.get(a, []) for y in own.get(b, []))
        ]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip("ab", zip(*found) if found else ([], []))})

    return run


def _explode_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, hashes) -> one row per shingle: doc, n, token."""
    for batch in batches:
        for first in range(0, batch.num_rows, 256):
            part = batch.slice(first, 256)
            sets = [np.frombuffer(h, dtype=np.int64) for h in part.column(1).to_pylist()]
            n = np.array([len(x) for x in sets], dtype=np.int64)
            docs = np.repeat(part.column(0).to_numpy(), n)
            token = np.concatenate(sets) if sets else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(docs), pa.array(np.repeat(n, n)), pa.array(token)], ["doc", "n", "token"])


def _labelled(postings: DataFrame, labels: DataFrame) -> DataFrame:
    """Postings with the component of each document (itself where it has no link yet)."""
    named = labels.withColumnRenamed("node", "doc")
    return postings.join(named, "doc", "left").withColumn("label", F.coalesce("label", "doc"))


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link.

    Pairs are compared cluster by cluster (components of the candidate pairs), so a set travels once for all its pairs;
    the pairs of a large cluster are dealt to a grid of tasks, each with at most about twice ``MEMBERS_PER_TASK`` sets.
    """
    cluster = connected_components(pairs)
    members = written(cluster.groupBy("label").agg(F.ceil(F.count("*") / F.lit(MEMBERS_PER_TASK)).cast("int").alias("g")), "clusters")
    dealt = pairs.join(cluster.withColumnRenamed("node", "a"), "a").join(members, "label")
    at = [F.pmod(F.xxhash64(c), "g").cast("int").alias(f"s{c}") for c in "ab"]
    dealt = written(dealt.select("label", *at, "a", "b"), "dealt")
    key = ["label", "sa", "sb"]
    needed = dealt.select(*key, F.explode(F.array("a", "b")).alias("doc")).distinct().join(sets, "doc")
    needed = needed.toDF(*needed.columns)  # columns of its own: both sides come from the same table
    return needed.groupBy(*key).cogroup(dealt.groupBy(*key)).applyInArrow(_verify(percent), "a bigint, b bigint")


def _links_of_repeated_ids(narrow: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): classes that rows of one doc_id belong to, by their representatives; none where ids are unique."""
    spark = narrow.sparkSession
    named = narrow.where("doc_id is not null and n > 0")
    ids = named.agg(F.count("*"), F.countDistinct("doc_id")).first()
    if ids[0] == ids[1]:
        return spark.createDataFrame([], "a bigint, b bigint")
    several = named.distinct().groupBy("doc_id").agg(F.count("*").alias("c")).where("c > 1").select("doc_id")
    own = written(named.join(written(several, "several"), "doc_id").join(classes, ["n", "h1", "h2"]).select("doc_id", "rep").distinct(), "own-classes")
    first = own.groupBy("doc_id").agg(F.min("rep").alias("a"))
    return written(own.join(first, "doc_id").where("rep != a").select("a", F.col("rep").alias("b")).distinct(), "links")


def jaccard_components(docs: DataFrame, words: int = K, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    sets = written(rows.mapInArrow(_scan(words, percent), "doc_id bigint, n bigint, h1 bigint, h2 bigint, prefix array<bigint>"), "sets")
    narrow = sets.select("doc_id", "n", "h1", "h2")
    classes = narrow.where("doc_id is not null and n > 0").groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("rep"))
    classes = written(classes, "classes")
    reps = classes.select("rep").distinct()

    # shingles that stand in the deep prefixes of more than one distinct set; written, as are other sides of joins on
    # hot keys: a join that deals both sides itself can split them
    token = sets.join(reps, F.col("doc_id") == F.col("rep"), "left_semi").select(
        F.col("doc_id").alias("doc"), "n", F.explode("prefix").alias("token")
    )
    again = token.groupBy("token").agg(F.count("*").alias("c")).where("c > 1").select("token")
    again = written(again, "shared-shingles")
    release(spark)
    shared = written(token.join(again, "token"), "shared-places")
    release(spark)
    # documents with enough of them; the partner may be smaller and then shares fewer
    smallest = f"({percent} * n + 99) div 100"
    enough = F.expr(f"{_deep_sql(smallest, percent)} - {_prefix_sql(smallest, percent)} + 1")
    alive = shared.groupBy("doc", "n").agg(F.count("*").alias("c")).where(F.col("c") >= enough).select("doc", "n")
    alive = alive.hint("shuffle_hash")
    whole = rows.join(alive.select(F.col("doc").alias("doc_id")), "doc_id", "left_semi")
    whole = written(whole.mapInArrow(_scan_sets(words), "doc bigint, hashes binary"), "whole-sets")
    release(spark)

    # second order, rarest first among these documents: shingles that one document alone has come first, so only documents
    # with few of them reach any that they share
    every = whole.mapInArrow(_explode_sets, "doc bigint, n bigint, token bigint")
    counts = written(every.groupBy("token").agg(F.count("*").alias("c")).where("c > 1"), "frequencies")
    places = written(every.join(counts, "token"), "shared-tokens")
    release(spark)
    few = places.groupBy("doc", "n").agg(F.count("*").alias("m")).withColumn("room", F.expr(f"{_prefix_sql('n', percent)} - (n - m)"))
    few = written(few.where("room > 0"), "few-own")
    rarest = Window.partitionBy("doc", "n").orderBy("c", "token")
    near = places.join(few, ["doc", "n"]).withColumn("r", F.row_number().over(rarest)).where(F.col("r") <= F.col("room"))
    # at: the place in the order, after the document's own shingles
    near = written(near.select("doc", "n", "token", (F.col("n") - F.col("m") + F.col("r") - 1).alias("at")), "prefixes")
    again = written(near.groupBy("token").agg(F.count("*").alias("c")).where("c > 1").select("token"), "met")
    postings = written(near.join(again, "token"), "postings")
    release(spark)

    # if a shingle is the first that two sets share, they share no more than what either has from there on
    possible = F.expr(f"{100 + percent} * least(n - at, n2 - at2) >= {percent} * (n + n2)")
    links = _links_of_repeated_ids(narrow, classes)
    labels = spark.createDataFrame([], "node bigint, label bigint") if links.isEmpty() else connected_components(links)
    for turn in range(STARS):
        # in each posting one set leads, another one each time; a set meets the leader it shares most postings with
        now = written(_labelled(postings, labels), "now")
        order = F.xxhash64("doc", F.lit(turn)) if turn else F.col("doc")
        lead = now.groupBy("token").agg(F.min_by(F.struct("doc", "label", "n", "at"), order).alias("lead"), F.min("label").alias("lo"), F.max("label").alias("hi"))
        lead = written(lead.where("lo != hi").select("token", "lead"), "leaders")
        met = now.join(lead, "token").where("label != lead.label").withColumns({"n2": F.col("lead.n"), "at2": F.col("lead.at")})
        met = met.where(possible).groupBy("doc", F.col("lead.doc").alias("a")).agg(F.count("*").alias("c"))
        pairs = met.groupBy("doc").agg(F.max_by("a", F.struct(F.col("c"), -F.col("a"))).alias("a"))
        pairs = written(pairs.select("a", F.col("doc").alias("b")), "pairs")
        found = written(_links(pairs, whole, percent), "links")
        links = links.unionByName(found)
        labels = connected_components(links)

    # what is left: pairs of different components in a posting. The set of the smaller component leads; leaders are taken
    # in as many blocks as the postings need, so no block is large
    now = written(_labelled(postings, labels), "now")
    sizes = written(now.select("doc", "label").distinct().groupBy("label").agg(F.count("*").alias("size")), "sizes")
    per_label = now.groupBy("token", "label").agg(F.count("*").alias("m"))
    mixed = per_label.groupBy("token").agg(F.sum("m").alias("s"), F.max("m").alias("m")).where("s > m")
    mixed = written(mixed.select("token", (F.col("s") * (F.col("s") - F.col("m"))).alias("rows")), "mixed")
    blocks = -(-(mixed.agg(F.sum("rows")).first()[0] or 0) // ROWS_PER_BLOCK)
    rest = written(now.join(mixed.select("token"), "token").join(sizes, "label"), "rest")
    for block in range(blocks):
        now = written(_labelled(rest.withColumnRenamed("label", "first_label"), labels), "now")
        leads = now.where(F.pmod(F.xxhash64("doc"), F.lit(blocks)) == F.lit(block)).select(
            "token", *(F.col(c).alias(f"{c}2") for c in ("doc", "n", "at", "label", "first_label", "size"))
        )
        leading = F.struct("size2", "first_label2", "doc2") < F.struct("size", "first_label", "doc")
        pairs = now.join(leads, "token").where(leading & (F.col("label") != F.col("label2"))).where(possible)
        pairs = written(pairs.select(F.col("doc2").alias("a"), F.col("doc").alias("b")).distinct(), "pairs")
        found = written(_links(pairs, whole, percent), "links")
        if found.limit(1).count():
            links = links.unionByName(found)
            labels = connected_components(links)

    component = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "n", "h1", "h2", F.coalesce("label", "rep").alias("component_id")
    )
    return narrow.join(component, ["n", "h1", "h2"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_row``: a number for each distinct (doc_id, text), by doc_id (null last) and text digest."""
    digest = F.coalesce(F.sha2("text", 256), F.lit(""))
    keyed = docs.withColumns({"_id": F.col("doc_id").cast("bigint"), "_digest": digest})
    order = [F.asc_nulls_last("_id"), F.asc("_digest")]
    names = with_sequence(keyed.select("_id", "_digest").distinct(), order, "_row")
    names = written(names.select(F.col("_id").alias("_named"), F.col("_digest").alias("_named_digest"), "_row"), "row-numbers")
    same = F.col("_id").eqNullSafe(F.col("_named")) & (F.col("_digest") == F.col("_named_digest"))
    return keyed.join(names, same).select(*docs.columns, "_row")


def one_of_each(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group of near copies (the one of the smallest doc_id), all columns; texts without words
    stay.

    Where ids repeat or are missing, rows are told apart by doc_id and text: texts without a near copy stay whatever their id,
    and near copies without an id go like any other.
    """
    if (ids := docs.agg(F.count("*"), F.countDistinct("doc_id")).first())[0] == ids[1]:
        components = jaccard_components(docs.select("doc_id", "text"), k, percent)
        keep = written(components.where("doc_id = component_id").select("doc_id"), "kept")
        return docs.join(keep, docs["doc_id"].cast("bigint") == keep["doc_id"], "left_semi")
    numbered = written(_numbered(docs), "numbered")
    components = jaccard_components(numbered.select(F.col("_row").alias("doc_id"), "text"), k, percent)
    keep = components.where("doc_id = component_id").select(F.col("doc_id").alias("_row"), (F.col("n_shingles") > 0).alias("_words"))
    kept = written(numbered.join(written(keep.distinct(), "kept"), "_row"), "kept-rows")
    once = kept.where("_words").dropDuplicates(["_row"])
    return once.unionByName(kept.where("NOT _words")).select(*docs.columns)
