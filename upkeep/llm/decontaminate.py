"""Benchmark decontamination by winnowing.

Texts are lower-cased (A-Z) and cut into words. Of every ``SPAN`` consecutive words the smallest hash of ``GRAM``
consecutive words is kept as a fingerprint, on both sides by the same rule, so every shared span of ``SPAN`` words has
a shared fingerprint. Fingerprints of documents and benchmark are joined, and each hit is extended to both sides by
comparing words until the shared stretch ends (at most ``SPAN - GRAM`` words, as a longer stretch has a fingerprint
of its own there). Benchmark items of fewer than ``SPAN`` words are one window, fingerprinted as a whole.

A bitmap of the benchmark's fingerprints, of a fixed size, is broadcast to drop document fingerprints that cannot join;
it is a filter only and the join decides. Document texts are never shuffled, only the words around hits.

Null or empty texts have no words; null item ids are ignored; rows repeating doc_id and text are returned each; an empty
benchmark leaves all documents clean. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.common import LOWER, WORD_BYTE, Chunk, Hasher, chunks, mix, shingle_hashes, written

SPAN = 10
GRAM = 5
BITMAP_BITS = 24


def _bit(fp: np.ndarray) -> np.ndarray:
    return (fp >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def _short_hash(h: np.ndarray, n: int) -> np.ndarray:
    return mix(h + np.uint64(n))


class Winnower:
    """Fingerprints of a chunk of texts; ``bitmap`` (or None) drops fingerprints without a partner."""

    def __init__(self, bitmap: np.ndarray | None, short_lengths: list[int]) -> None:
        self.hasher = Hasher()
        self.bitmap = bitmap
        self.short_lengths = short_lengths

    def hits(self, chunk: Chunk, data: np.ndarray) -> tuple:
        """Words (starts, ends, first of each row) and fingerprints (word position, words before, words, hash)."""
        starts, ends, first = chunk.words(WORD_BYTE)
        words = self.hasher.ranges(data, starts, ends)
        row_end = np.repeat(first[1:], np.diff(first))  # for each word, where its row ends
        found = []
        grams = shingle_hashes(words, GRAM)
        spans = len(words) - SPAN + 1
        if spans > 0:
            width = SPAN - GRAM + 1
            inside = np.arange(spans) + SPAN <= row_end[:spans]
            least = grams[:spans].copy()
            for o in range(1, width):
                np.minimum(least, grams[o : o + spans], out=least)
            chosen = np.zeros(len(grams), dtype=bool)
            for o in range(width):
                chosen[o : o + spans] |= inside & (grams[o : o + spans] == least)
            at = np.flatnonzero(chosen)
            found.append((at, grams[at], 0))
        for n in self.short_lengths:
            h = _short_hash(shingle_hashes(words, n), n)
            at = np.flatnonzero(np.arange(len(h)) + n <= row_end[: len(h)])
            found.append((at, h[at], n))
        if self.bitmap is not None:
            found = [(at[keep], fp[keep], n) for at, fp, n in found for keep in [self.bitmap[_bit(fp)]]]
        return starts, ends, first, found


def _context(texts: list[bytes], first: int, end: int, at: int, n: int) -> list[str | None]:
    """The words compared for a hit: the short window itself, or the gram with ``SPAN - GRAM`` words to both sides."""
    if n:
        return [texts[i].decode() for i in range(at, at + n)]
    reach = SPAN - GRAM
    return [texts[i].decode() if first <= i < end else None for i in range(at - reach, at + GRAM + reach)]


HITS = "array<struct<fp:bigint,short:int,words:array<string>,positions:array<int>>>"
_HIT_TYPE = pa.struct([("fp", pa.int64()), ("short", pa.int32()), ("words", pa.list_(pa.string())), ("positions", pa.list_(pa.int32()))])


def _fingerprints(bitmap, short_lengths, only_whole=False):
    """mapInArrow function over (id, text): id, n_words and the row's hits, equal ones together with all positions.

    ``only_whole``: short windows only where they are the whole text (benchmark items).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if bitmap is None else np.unpackbits(np.frombuffer(bitmap.value, dtype=np.uint8), bitorder="little").astype(bool)
        winnower = Winnower(bits, short_lengths)
        for batch in batches:
            for chunk in chunks(batch.column(batch.num_columns - 1)):
                data = LOWER[chunk.data]
                starts, ends, first, found = winnower.hits(chunk, data)
                rows: list[dict] = [{} for _ in range(len(chunk))]
                text = data.tobytes()
                for at, fps, n in found:
                    owner = np.searchsorted(first, at, side="right") - 1
                    if n and only_whole:
                        whole = np.diff(first)[owner] == n
                        owner, at, fps = owner[whole], at[whole], fps[whole]
                    for row, p, fp in zip(owner.tolist(), at.tolist(), fps.view(np.int64).tolist()):
                        lo, hi = int(first[row]), int(first[row + 1])
                        reach = SPAN - GRAM
                        a, b = (p, p + n) if n else (max(lo, p - reach), min(hi, p + GRAM + reach))
                        texts = {i: text[starts[i] : ends[i]] for i in range(a, b)}
                        words = tuple(_context(texts, lo, hi, p, n))
                        rows[row].setdefault((fp, n, words), []).append(p - lo)
                hits = pa.array(
                    [[{"fp": fp, "short": n, "words": list(w), "positions": ps} for (fp, n, w), ps in r.items()] for r in rows],
                    pa.list_(_HIT_TYPE),
                )
                columns = [c.slice(chunk.first, len(chunk)) for c in batch.columns[:-1]]
                n_words = pa.array(np.diff(first).astype(np.int64))
                yield pa.RecordBatch.from_arrays([*columns, n_words, hits], [*batch.schema.names[:-1], "n_words", "hits"])

    return run


def _bitmap(fingerprints: DataFrame) -> bytes:
    """Bitmap of the leading ``BITMAP_BITS`` bits of the fingerprints: a fixed size however many there are."""
    bit = F.shiftrightunsigned("fp", 64 - BITMAP_BITS)
    words = (
        fingerprints.select(F.shiftright(bit, 5).cast("int").alias("w"), bit.bitwiseAND(F.lit(31)).cast("int").alias("b"))
        .groupBy("w")
        .agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("bits"))
    )
    out = np.zeros(1 << (BITMAP_BITS - 5), dtype="<u4")
    for w, bits in words.collect():  # at most 2**(BITMAP_BITS - 5) rows
        out[w] = bits
    return out.tobytes()


def benchmark_index(benchmark: DataFrame) -> DataFrame:
    """fp, short (0, or the length of a short item), words, item_ids (sorted strings): one row per distinct context."""
    items = benchmark.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("string").alias("item_id"), "text")
    hits = items.mapInArrow(
        _fingerprints(None, list(range(1, SPAN)), only_whole=True), f"item_id string, n_words bigint, hits {HITS}"
    )
    every = hits.select("item_id", F.explode("hits").alias("h")).select("item_id", "h.fp", "h.short", "h.words")
    return every.groupBy("fp", "short", "words").agg(F.collect_set("item_id").alias("item_ids"))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash, n_words, n_hit, n_items, items (sorted item ids), spans (hit word ranges)."""
    spark = docs.sparkSession
    index = written(benchmark_index(benchmark), "bench-index")
    short_lengths = [r[0] for r in index.where("short > 0").select("short").distinct().orderBy("short").collect()]
    bitmap = spark.sparkContext.broadcast(_bitmap(index))

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text"))
    scanned = written(
        rows.mapInArrow(_fingerprints(bitmap, short_lengths), f"doc_id bigint, text_hash bigint, n_words bigint, hits {HITS}"),
        "doc-hits",
    )
    # repeated rows have the same hits: one copy goes through the join
    hit = scanned.where(F.size("hits") > 0).dropDuplicates(["doc_id", "text_hash"])
    hit = hit.select("doc_id", "text_hash", F.explode("hits").alias("h")).select("doc_id", "text_hash", "h.*")
    joined = hit.join(index.withColumnRenamed("words", "item_words"), ["fp", "short"])

    reach = SPAN - GRAM
    left = F.expr(f"{reach - 1} - array_max(transform(sequence(0, {reach - 1}), i -> if(words[i] is not null and words[i] = item_words[i], -1, i)))")
    right = F.expr(f"coalesce(array_min(filter(sequence({reach + GRAM}, {2 * reach + GRAM - 1}), i -> words[i] is null or item_words[i] is null or words[i] != item_words[i])), {2 * reach + GRAM}) - {reach + GRAM}")
    same_gram = F.slice("words", reach + 1, GRAM) == F.slice("item_words", reach + 1, GRAM)
    extended = (
        joined.withColumn("l", F.when(F.col("short") > 0, 0).otherwise(left))
        .withColumn("r", F.when(F.col("short") > 0, F.col("short")).otherwise(right + F.lit(GRAM)))
        .where(
            F.when(F.col("short") > 0, F.col("words") == F.col("item_words")).otherwise(
                same_gram & (F.col("l") + F.col("r") >= F.lit(SPAN))
            )
        )
    )
    spans = F.transform("positions", lambda p: F.struct((p - F.col("l")).alias("s"), (p + F.col("r")).alias("e")))
    per_doc = (
        extended.select("doc_id", "text_hash", "item_ids", spans.alias("spans"))
        .groupBy("doc_id", "text_hash")
        .agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("item_ids")))).alias("items"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("spans")))).alias("spans"),
        )
        .withColumn(
            "n_hit",
            F.expr(
                "aggregate(spans, named_struct('n', 0L, 'e', 0), (a, x) -> named_struct("
                "'n', a.n + greatest(0, x.e - greatest(a.e, x.s)), 'e', greatest(a.e, x.e)), a -> a.n)"
            ),
        )
    )
    base = scanned.select("doc_id", "text_hash", "n_words")
    same = (base["doc_id"].eqNullSafe(per_doc["doc_id"])) & (base["text_hash"] == per_doc["text_hash"])
    return base.join(per_doc, same, "left").select(
        base["doc_id"],
        base["text_hash"],
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<s:int,e:int>>")).alias("spans"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text contains no window of ``benchmark``; all columns are kept."""
    found = contamination(docs.select("doc_id", "text"), benchmark).where("n_hit > 0")
    dirty = found.select(F.col("doc_id").alias("_dirty"), F.col("text_hash").alias("_dirty_hash")).distinct()
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("_dirty")) & (F.xxhash64("text") == F.col("_dirty_hash"))
    return docs.join(dirty, same, "left_anti")
