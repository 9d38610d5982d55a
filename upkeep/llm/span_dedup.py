"""Removal of repeated byte spans by a column-wise multi-document suffix order.

A byte is removed when it is covered by a ``SPAN``-byte string that also starts earlier (in a document of smaller id, or
earlier in the same document). Strings never cross documents and are judged on the input.

1. The least hash of ``GRAM`` consecutive bytes in a span is its anchor (the leftmost of equal ones); equal spans have
   equal anchors at the same place, so a repeat can only be found between segments (runs of span starts) with the same
   anchor. Segments whose anchor stands nowhere else are done.
2. Equal segments are found by two 64-bit hashes, of the anchor and of all bytes: all but the first are repeats as a whole.
3. Where one anchor has different segments, the first of each is fetched, and the segments, aligned at their anchors,
   are put in suffix order column by column from the right: each round inserts one symbol of every segment, moves the
   segments stably by it (the collection's Burrows-Wheeler step) and updates the common prefix lengths between
   neighbours. Neighbours with ``SPAN`` common symbols share the span that starts in this column; all but the earliest
   are repeats. Blocks of segments are independent, so the collection is never in one place.
4. A collection too large for a block goes through rounds of written files first: the spans are halved by their distance to
   the anchor, and each half is parted by the columns that all its spans have, so equal spans stay together. Smaller parts
   join the blocks; after the last halving a part is one string, whose earliest place is an aggregate over its bytes.

Null and empty texts have no bytes and nothing is removed. Documents without an id stand after all others; rows repeating
doc_id and text are one document and have the same result; rows that repeat a doc_id (or have none) with another text
stand in the order of a 64-bit text hash, which with the doc_id names them. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from upkeep.llm.common import Chunk, Hasher, chunks, release, written

SPAN = 100
GRAM = 20
STRINGS_PER_BLOCK = 16_384
# a segment in one long: 32 bits start, 7 bits span starts - 1, 7 bits anchor offset
_START, _COUNT = 14, 7


def segments(chunk: Chunk, hasher: Hasher, span: int, gram: int) -> tuple[np.ndarray, ...]:
    """Segments of a chunk: first span start, number of starts, offset of the anchor, its hash, hash of all bytes."""
    n = len(chunk.data)
    starts = n - span + 1
    none = np.empty(0, dtype=np.int64)
    if starts <= 0:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    sums = hasher.sums(chunk.data)
    h = hasher.windows(sums, gram)
    width = span - gram + 1
    least, reach = h, 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    least = np.minimum(least[:starts], least[width - reach : width - reach + starts])
    step = np.zeros(n + 2, dtype=np.int32)
    lengths = np.diff(chunk.bounds)
    rows = np.flatnonzero(lengths >= span)
    np.add.at(step, chunk.bounds[rows], 1)
    np.add.at(step, chunk.bounds[rows + 1] - span + 1, -1)
    valid = np.cumsum(step)[:starts] > 0
    new = np.ones(starts, dtype=bool)
    new[1:] = ~valid[:-1] | (least[1:] != least[:-1]) | (h[: starts - 1] == least[:-1])
    at = np.flatnonzero(valid & new)
    ends = np.append(np.flatnonzero(~valid | new), starts)
    count = ends[np.searchsorted(ends, at, side="right")] - at
    anchor = at.copy()
    for block in range(0, len(at), 4096):
        part = at[block : block + 4096]
        anchor[block : block + 4096] += h[part[:, None] + np.arange(width)].argmin(axis=1)
    return at, count, anchor - at, h[anchor], hasher.between(sums, at, at + count + span - 1)


def _anchors(span: int, gram: int):
    """(text) -> anchor hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                fp = segments(chunk, hasher, span, gram)[3]
                yield pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64))], ["fp"])

    return run


def _segments(span: int, gram: int):
    """(key, text hash, text) -> anchor hash, hash of the segment, key, text hash, segment as one long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            keys, text_hash = (batch.column(i).to_numpy() for i in (0, 1))
            for chunk in chunks(batch.column(2)):
                at, count, offset, fp, whole = segments(chunk, hasher, span, gram)
                row = np.searchsorted(chunk.bounds, at, side="right") - 1
                own = chunk.first + row
                packed = ((at - chunk.bounds[row]) << _START) | ((count - 1) << _COUNT) | offset
                columns = (fp.view(np.int64), whole.view(np.int64), keys[own], text_hash[own], packed)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["fp", "whole", "key", "text_hash", "packed"])

    return run


def unpack(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, number of span starts and anchor offset."""
    mask = (1 << _COUNT) - 1
    return packed >> _START, ((packed >> _COUNT) & mask) + 1, packed & mask


STRINGS = "fp bigint, key bigint, text_hash bigint, anchor bigint, lo int, hi int, bytes binary"


def _fetch(span: int):
    """(key, text hash, text, wanted segments of the text) -> the segments as ``STRINGS``: place of the anchor, distances
    to it of the last and (plus 1) the first span, and the bytes of the spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, text_hash, text, wanted = batch.columns
            for i in range(batch.num_rows):
                raw = text[i].as_buffer()
                items = wanted[i].values
                start, count, offset = unpack(items.field("packed").to_numpy())
                data = [raw.slice(s, c + span - 1).to_pybytes() for s, c in zip(start.tolist(), count.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        items.field("fp"),
                        pa.array([key[i].as_py()] * len(items), pa.int64()),
                        pa.array([text_hash[i].as_py()] * len(items), pa.int64()),
                        pa.array(start + offset),
                        pa.array((offset - count + 1).astype(np.int32)),
                        pa.array((offset + 1).astype(np.int32)),
                        pa.array(data, pa.binary()),
                    ],
                    ["fp", "key", "text_hash", "anchor", "lo", "hi", "bytes"],
                )

    return run


def column_wise(symbols: np.ndarray, rank: np.ndarray, span: int) -> np.ndarray:
    """Which spans are repeats: ``symbols`` is (strings x columns), -1 where a string has no symbol; ``rank`` orders equal
    spans. Returns (strings x columns): whether the span that starts there also stands in a string of smaller rank."""
    n, columns = symbols.shape
    repeat = np.zeros((n, columns), dtype=bool)
    order = np.arange(n)
    common = np.zeros(n, dtype=np.int32)  # symbols shared with the string before, from this column on
    for x in range(columns - 1, -1, -1):
        symbol = symbols[order, x]
        moved = np.argsort(symbol, kind="stable")
        ordered = symbol[moved]
        shared = np.zeros(n, dtype=np.int32)
        first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        for a, b in zip(first.tolist(), [*first[1:].tolist(), n]):
            if ordered[a] >= 0 and b - a > 1:
                at = moved[a:b]  # ascending places in the former order
                shared[a + 1 : b] = 1 + np.minimum.reduceat(common[: at[-1] + 1], at[:-1] + 1)
        order, common = order[moved], shared
        linked = common >= span
        if linked.any():
            run = np.flatnonzero(~linked)
            least = np.minimum.reduceat(rank[order], run)
            repeat[order, x] = rank[order] != np.repeat(least, np.diff(np.append(run, n)))
    return repeat


def _order_block(span: int):
    """Segments of one block -> (key, text hash, start, end) of the byte ranges they repeat."""

    def run(table: pa.Table) -> pa.Table:
        key, text_hash, anchor, hi = (table.column(c).to_numpy() for c in ("key", "text_hash", "anchor", "hi"))
        before = hi.astype(np.int64) - 1  # bytes before the anchor
        rank = np.empty(len(key), dtype=np.int64)
        by_place = np.lexsort((anchor, text_hash, key))
        place = np.column_stack([key, text_hash, anchor])[by_place]
        # a repeated row is the same place
        rank[by_place] = np.cumsum(np.append(0, (place[1:] != place[:-1]).any(axis=1)))
        data = table.column("bytes").to_pylist()
        left = int(before.max())
        width = max(left - o + len(d) for o, d in zip(before.tolist(), data))
        symbols = np.full((len(key), width), -1, dtype=np.int16)
        for i, (d, o) in enumerate(zip(data, before.tolist())):
            symbols[i, left - o : left - o + len(d)] = np.frombuffer(d, dtype=np.uint8)
        repeat = column_wise(symbols, rank, span)
        edge = np.diff(np.pad(repeat, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        i, a = np.nonzero(edge == 1)
        _, b = np.nonzero(edge == -1)
        begin = anchor[i] + a - left
        return pa.table({"key": key[i], "text_hash": text_hash[i], "s": begin, "e": begin + (b - a) + span - 1})

    return run


def _halves(rows: DataFrame, lo: int, hi: int, span: int) -> list[tuple[int, int, DataFrame]]:
    """Rows whose spans start ``lo`` to ``hi - 1`` bytes before their anchors, halved by that distance; each half is parted
    anew by the bytes that all its spans have."""
    middle = (lo + hi) // 2
    out = []
    for a, b, own in ((lo, middle, F.col("lo") < middle), (middle, hi, F.col("hi") > middle)):
        first, last = F.least("hi", F.lit(b)), F.greatest("lo", F.lit(a))
        part = rows.where(own).withColumns(
            {
                "lo": last.cast("int"),
                "hi": first.cast("int"),
                "bytes": F.substring("bytes", F.col("hi") - first + 1, first - last + F.lit(span - 1)),
            }
        )
        core = F.substring("bytes", F.col("hi") - F.lit(a), F.lit(span - (b - a) + 1))
        out.append((a, b, part.withColumn("part", F.xxhash64("part", F.lit(a), F.lit(b), core))))
    return out


def _repeats_of_mixed(strings: DataFrame, span: int, gram: int) -> DataFrame:
    """key, text_hash, s, e: what the different segments of the same anchors repeat of each other."""
    spark = strings.sparkSession
    ranges = "key bigint, text_hash bigint, s bigint, e bigint"
    waiting = [(0, span - gram + 1, strings.withColumnRenamed("fp", "part"))]
    ready, single = [], []
    while waiting:
        lo, hi, rows = waiting.pop()
        if hi - lo == 1:
            single.append(rows)
            continue
        large = rows.groupBy("part").agg(F.count("*").alias("n")).where(F.col("n") > F.lit(STRINGS_PER_BLOCK)).select("part")
        large = written(large, "large-parts")
        if not large.limit(1).count():
            ready.append(rows)
            continue
        ready.append(rows.join(large, "part", "left_anti"))
        for a, b, half in _halves(rows.join(large, "part", "left_semi"), lo, hi, span):
            waiting.append((a, b, written(half, "parted")))
        release(spark)
    blocked = ready[0]
    for rows in ready[1:]:
        blocked = blocked.unionByName(rows)
    blocks = max(1, -(-blocked.count() // STRINGS_PER_BLOCK))
    out = blocked.withColumn("block", F.pmod(F.xxhash64("part"), F.lit(blocks))).groupBy("block").applyInArrow(_order_block(span), ranges)
    place = F.struct("key", "text_hash", "anchor")
    for rows in single:
        earliest = written(rows.groupBy("bytes").agg(F.min(place).alias("first")), "earliest")
        start = F.col("anchor") - F.col("lo")
        later = rows.join(earliest, "bytes").where(place != F.col("first"))
        out = out.unionByName(later.select("key", "text_hash", start.alias("s"), (start + F.lit(span)).alias("e")))
    return out


_NO_ID = (1 << 63) - 1


def _keyed(docs: DataFrame) -> DataFrame:
    """A text's name: its doc_id (the largest number for none) and a 64-bit hash of it."""
    return docs.withColumn("_key", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NO_ID))).withColumn("_text_hash", F.xxhash64("text"))


def repeated_ranges(docs: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """key, text_hash (see ``_keyed``) and ranges (array of s, e): the repeated byte ranges of each document with any."""
    keyed = _keyed(docs.select("doc_id", "text")).where(F.octet_length("text") >= F.lit(span))
    anchors = keyed.select("text").mapInArrow(_anchors(span, gram), "fp bigint")
    # written, so that the join deals both sides itself and can split an anchor that stands in very many places
    again = written(anchors.groupBy("fp").agg(F.count("*").alias("c")).where("c > 1").select("fp"), "repeated-anchors")
    release(docs.sparkSession)
    found = keyed.select("_key", "_text_hash", "text").mapInArrow(
        _segments(span, gram), "fp bigint, whole bigint, key bigint, text_hash bigint, packed bigint"
    )
    found = written(found.join(again, "fp", "left_semi"), "segments")
    release(docs.sparkSession)

    place = F.struct("key", "text_hash", "packed")
    firsts = written(found.groupBy("fp", "whole").agg(F.min(place).alias("first"), F.count("*").alias("c")), "first-segments")
    start = F.shiftright("packed", _START)
    count = F.shiftright("packed", _COUNT).bitwiseAND(F.lit((1 << _COUNT) - 1)) + F.lit(1)
    later = (
        found.join(firsts.where("c > 1").drop("c"), ["fp", "whole"])
        .where(place != F.col("first"))
        .select("key", "text_hash", start.alias("s"), (start + count + F.lit(span - 1)).alias("e"))
    )

    # anchors with different segments
    mixed = firsts.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").select("fp")
    wanted = written(firsts.join(mixed, "fp").select("fp", "first.key", "first.text_hash", "first.packed"), "mixed-segments")
    per_text = wanted.groupBy("key", "text_hash").agg(F.collect_list(F.struct("fp", "packed")).alias("wanted")).hint("shuffle_hash")
    same = (F.col("_key") == per_text["key"]) & (F.col("_text_hash") == per_text["text_hash"])
    strings = keyed.join(per_text, same).select("_key", "_text_hash", "text", "wanted").mapInArrow(_fetch(span), STRINGS)
    strings = written(strings, "strings")
    release(docs.sparkSession)
    every = later.unionByName(_repeats_of_mixed(strings, span, gram))
    return every.groupBy("key", "text_hash").agg(F.collect_set(F.struct("s", "e")).alias("ranges"))


def merge(ranges: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of the union of byte ranges."""
    out: list[tuple[int, int]] = []
    for s, e in sorted((r["s"], r["e"]) for r in ranges):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def cut(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for s, e in spans:
        kept.append(raw[at:s])
        at = e
    kept.append(raw[at:])
    return b"".join(kept)


def _with_ranges(docs: DataFrame, span: int, gram: int) -> DataFrame:
    ranges = written(repeated_ranges(docs, span, gram), "ranges")
    release(docs.sparkSession)
    ranges = ranges.withColumnsRenamed({"key": "_key", "text_hash": "_text_hash", "ranges": "_ranges"}).hint("shuffle_hash")
    return _keyed(docs).join(ranges, ["_key", "_text_hash"], "left").drop("_key", "_text_hash")


def span_report(docs: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans."""
    spans = "array<struct<s:bigint,e:bigint>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, ranges in zip(batch.column(1), batch.column(2)):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                runs = merge(ranges.as_py() or [])
                kept = hashlib.sha256(cut(raw, runs)).hexdigest()
                out.append((len(raw), sum(e - s for s, e in runs), len(runs), kept, [{"s": s, "e": e} for s, e in runs]))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))]
            columns = [pa.array(c, t) for c, t in zip(zip(*out), types)] if out else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    rows = _with_ranges(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), span, gram)
    return rows.mapInArrow(run, f"doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans {spans}")


def remove_repeats(docs: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """``docs`` with repeated spans cut from text (and characters the cuts split); texts left with nothing are dropped.

    All columns stay; n_chars, where present, follows the new text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, ranges = batch.schema.get_field_index("text"), batch.column(batch.num_columns - 1)
            texts = [
                cut(t.as_buffer().to_pybytes(), merge(r.as_py())).decode("utf-8", "ignore") if r.is_valid and t.is_valid else t.as_py()
                for t, r in zip(batch.column(at), ranges)
            ]
            columns = batch.columns[:-1]
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([*columns, ranges.is_valid()], [*batch.schema.names[:-1], "_cut"])

    rows = _with_ranges(docs, span, gram)
    out = rows.mapInArrow(run, StructType([*docs.schema.fields, StructField("_cut", BooleanType())]))
    out = out.where(~F.col("_cut") | (F.length("text") > 0)).drop("_cut")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
