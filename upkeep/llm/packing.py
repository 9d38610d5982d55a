"""Packing documents into token windows by Karmarkar-Karp multiway differencing.

1. Every document is tokenized and closed with an end id. Whole windows of a long document are cut off at once; at
   most one remainder shorter than a window is left, so what is shuffled per document is bounded.
2. Remainders are dealt into buckets of about ``DOCS_PER_BUCKET`` documents by a hash of the row, of the task that reads it
   and of how many equal rows that task had before, so rows that repeat by the million spread like any others, and a task
   that runs again deals the same. Within a bucket Karmarkar-Karp merges
   partial partitions with opposing imbalances until one partition into ``k`` near-equal windows is left. ``k`` starts
   at the least possible count and rises while the fullest window exceeds the capacity.
3. As documents may be cut anywhere, the emptiest windows are then dissolved to top the others up, and the last one is
   split by the binary digits of its length: sequences are full or a power of two long, so nothing is padded.

Null texts count as empty (one end id). Rows that repeat a doc_id are packed as documents of their own. An empty table
gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.bpe import Merger, Remembered, runs_of_texts, split_pattern, whole_tokenizer
from upkeep.llm.common import mix, per_process

CAPACITY = 4096
DOCS_PER_BUCKET = 512

# the split pattern of the word-end BPE (fixed value), the commonest alternative first; see split_pattern
PRE_TOKEN = "[<L>]+|'(?:s|t|re|ve|m|ll|d)|[<N>]|[^<S><L><N>]+"
# characters that NFC keeps, that both libraries class alike and that lower-case one by one
AGREED = "\x00-ʯЀ-ҁҊ-ԯ‐-‧‰-⁞一-鿿"
OTHER = f"[^{AGREED}]"

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


class Encoder:
    """Token ids of texts; each distinct pre-token is merged once by the tokenizer library and remembered.

    Texts with characters outside ``AGREED`` or with an added special token are encoded by the library as a whole.
    """

    def __init__(self, tokenizer_path: str) -> None:
        import regex

        self.path = tokenizer_path
        self.merger = Merger(tokenizer_path)
        self.dtype = np.dtype("<u2" if self.merger.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.split = split_pattern(AGREED, PRE_TOKEN)
        self.other = regex.compile(OTHER)
        self.special = [t.content for t in self.merger.tokenizer.get_added_tokens_decoder().values()]
        self.known = Remembered(self._merged)

    @cached_property
    def tokenizer(self):
        return whole_tokenizer(self.path)

    def _whole(self, text: str) -> bool:
        return any(s in text for s in self.special) or self.other.search(text) is not None

    def _merged(self, pieces: list[str]) -> Iterator[bytes]:
        ids, counts = self.merger.encode(pieces)
        raw, ends = ids.astype(self.dtype).tobytes(), (np.cumsum(counts) * self.dtype.itemsize).tolist()
        return (raw[a:b] for a, b in zip([0, *ends], ends))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        pieces = [None if self._whole(t) else self.split.findall(t.lower()) for t in texts]
        known = self.known.of(p for p in pieces if p is not None).__getitem__
        return [
            np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, dtype=self.dtype)
            if p is None
            else np.frombuffer(b"".join(map(known, p)), dtype=self.dtype)
            for t, p in zip(texts, pieces)
        ]


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Karmarkar-Karp: items split into ``k`` groups of near-equal total size (item numbers per group)."""
    if not sizes:
        return [[] for _ in range(k)]
    heap = []
    for i, size in enumerate(sizes):
        sums = np.zeros(k, dtype=np.int64)
        sums[0] = size
        heap.append((-size, i, sums, [(i,)] + [None] * (k - 1)))
    heapq.heapify(heap)
    number = len(sizes)
    while len(heap) > 1:
        _, _, a, a_items = heapq.heappop(heap)
        _, _, b, b_items = heapq.heappop(heap)
        sums = a + b[::-1]  # the fullest of one with the emptiest of the other
        items = [x if y is None else y if x is None else (x, y) for x, y in zip(a_items, reversed(b_items))]
        order = np.argsort(-sums, kind="stable")
        sums = sums[order] - sums[order[-1]]
        heapq.heappush(heap, (-int(sums[0]), number, sums, [items[o] for o in order]))
        number += 1
    groups = []
    for tree in heap[0][3]:
        group, stack = [], [tree] if tree is not None else []
        while stack:
            node = stack.pop()
            if len(node) == 1:
                group.append(node[0])
            else:
                stack.extend(node)
        groups.append(group)
    return groups


def windows(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Near-equal windows within ``capacity``: the count rises whenever the fullest window exceeds it."""
    total = sum(sizes)
    k = max(1, -(-total // capacity))
    while True:
        groups = differencing(sizes, k)
        fullest = max((sum(sizes[i] for i in g) for g in groups), default=0)
        if fullest <= capacity:
            return groups
        excess = fullest - total // k
        k = max(k + 1, -(-total // (capacity - min(excess, capacity // 2))))


def top_up(groups: list[list[int]], sizes: list[int], capacity: int = CAPACITY) -> list[list[tuple[int, int, int]]]:
    """Cut the emptiest windows to fill the others; the last window is split into powers of two.

    Returns windows as lists of (item, start in the item, length).
    """
    filled = [[(i, 0, sizes[i]) for i in sorted(g)] for g in groups if g]
    filled.sort(key=lambda w: -sum(p[2] for p in w))
    left, right = 0, len(filled) - 1
    while left < right:
        gap = capacity - sum(p[2] for p in filled[left])
        while gap and left < right:
            if not filled[right]:
                right -= 1
                continue
            item, start, length = filled[right].pop()
            part = min(gap, length)
            filled[left].append((item, start + length - part, part))
            if part < length:
                filled[right].append((item, start, length - part))
            gap -= part
        if not gap:
            left += 1
    out = [w for w in filled if w and sum(p[2] for p in w) == capacity]
    for w in filled:
        rest = sum(p[2] for p in w)
        if not w or rest == capacity:
            continue
        for power in (1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1):
            part: list[tuple[int, int, int]] = []
            need = power
            while need:
                item, start, length = w.pop(0)
                take = min(need, length)
                part.append((item, start, take))
                if take < length:
                    w.insert(0, (item, start + take, length - take))
                need -= take
            out.append(part)
    return out


def dealt(rows: np.ndarray, seen: dict[int, int], task: int, buckets: int) -> np.ndarray:
    """Bucket of each row given by its hash: equal rows of a task (counted in ``seen``) and of other tasks go to others."""
    turns = np.empty(len(rows), dtype=np.uint64)
    for i, h in enumerate(rows.tolist()):
        turns[i] = seen[h] = seen.get(h, -1) + 1
    turns = mix(turns + mix(np.array([task + 1], dtype=np.uint64)))
    return (mix(rows.view(np.uint64) ^ turns) % np.uint64(buckets)).astype(np.int64)


def pack(
    docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = CAPACITY, docs_per_bucket: int = DOCS_PER_BUCKET
) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    buckets = max(1, -(-docs.count() // docs_per_bucket))

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = per_process(f"encoder {tokenizer_path}", lambda: Encoder(tokenizer_path))
        seen, task = {}, TaskContext.get().partitionId()
        schema = pa.schema([("bucket", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())])
        for batch in batches:
            rows = []
            texts = batch.column(2).fill_null("").to_pylist()
            encoded = (ids for part in runs_of_texts(texts) for ids in encoder.encode(texts[part]))
            end = np.array([end_id], dtype=encoder.dtype)
            for bucket, doc, ids in zip(dealt(batch.column(0).to_numpy(), seen, task, buckets).tolist(), batch.column(1).to_pylist(), encoded):
                ids = np.concatenate([ids, end])
                whole = len(ids) // capacity * capacity
                for s in range(0, whole, capacity):
                    rows.append((bucket, doc, s, capacity, crc32(ids[s : s + capacity]), len(ids), None))
                if whole < len(ids):
                    rows.append((bucket, doc, whole, len(ids) - whole, None, len(ids), ids[whole:].tobytes()))
            for at in range(0, len(rows), 4096):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[at : at + 4096]), schema)], schema=schema)

    def place(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        rows = table.select(["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]).to_pylist()
        # the same order whichever task wrote a row first, so a repeated task gives the same windows
        rows.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["start"], r["doc_tokens"], r["ids"] or b""))
        rest = [r for r in rows if r["ids"] is not None]
        sizes = [r["length"] for r in rest]
        out = []
        sequence = bucket << 32
        for r in rows:
            if r["ids"] is None:
                out.append((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"], sequence, 0))
                sequence += 1
        for window in top_up(windows(sizes, capacity), sizes, capacity) if rest else []:
            offset = 0
            for i, start, length in window:
                r = rest[i]
                ids = np.frombuffer(r["ids"], dtype="<u2" if len(r["ids"]) == 2 * r["length"] else "<u4")
                out.append((r["doc_id"], r["start"] + start, length, crc32(ids[start : start + length]), r["doc_tokens"], sequence, offset))
                offset += length
            sequence += 1
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        columns = list(zip(*out))
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})

    rows = docs.select(
        F.xxhash64(F.col("doc_id").cast("bigint"), F.col("text")).alias("row"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text"),
    )
    pieces = rows.mapInArrow(
        tokenize, "bucket bigint, doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, ids binary"
    )
    return pieces.groupBy("bucket").applyInArrow(place, PIECES)
