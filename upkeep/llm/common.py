"""Helpers shared by the operators: table access, intermediate tables, and vectorised views of text batches."""

from __future__ import annotations

import gc
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upkeep.session import ensure_checkpoint_dir

WHITE_SPACE = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
ASCII = np.arange(256)
# [^\x00-\x2F\x3A-\x60\x7B-\x7F] after A-Z became a-z, on UTF-8 bytes: digits, letters and every byte of a character
# beyond ASCII
WORD_BYTE = (
    ((ASCII >= 0x30) & (ASCII <= 0x39))
    | ((ASCII >= 0x41) & (ASCII <= 0x5A))
    | ((ASCII >= 0x61) & (ASCII <= 0x7A))
    | (ASCII >= 0x80)
)
NON_SPACE_BYTE = ~WHITE_SPACE
LOWER = np.where((ASCII >= 0x41) & (ASCII <= 0x5A), ASCII + 32, ASCII).astype(np.uint8)

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_U64 = np.uint64


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table below the session's shared checkpoint folder: computed once, survives lost executors.

    The folder is unique per call and is removed when the application ends.
    """
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    path = f"{base}/upkeep-llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return spark.read.schema(df.schema).parquet(path)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (every input bit reaches every output bit)."""
    h = h ^ (h >> _U64(33))
    h = h * _U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> _U64(33))
    h = h * _U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U64(33))


def byte_codes() -> np.ndarray:
    """One fixed 64-bit code per byte value."""
    return mix(np.arange(1, 257, dtype=np.uint64) * _U64(_MULTIPLIER))


def powers(n: int, base: int = _MULTIPLIER) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Hasher:
    """Hashes of byte ranges by prefix sums of ``code[byte] * P**i`` modulo 2**64 (P odd, so it has an inverse)."""

    def __init__(self) -> None:
        self.codes = byte_codes()
        self.inverse_base = pow(_MULTIPLIER, -1, 1 << 64)
        self.up = powers(0)
        self.down = powers(0)

    def _reserve(self, n: int) -> None:
        if len(self.up) < n:
            self.up = powers(n)
            self.down = powers(n, self.inverse_base)

    def sums(self, data: np.ndarray) -> np.ndarray:
        self._reserve(len(data) + 1)
        sums = np.empty(len(data) + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(self.codes[data] * self.up[: len(data)], out=sums[1:])
        return sums

    def between(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of ``data[s:e]`` for each range; equal bytes give equal hashes wherever they stand."""
        return mix((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))

    def ranges(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self.between(self.sums(data), starts, ends)

    def windows(self, sums: np.ndarray, size: int) -> np.ndarray:
        """Hash of every ``size`` consecutive bytes, the same as ``between`` gives for each."""
        n = len(sums) - size
        if n <= 0:
            return np.empty(0, dtype=np.uint64)
        return mix((sums[size:] - sums[:n]) * self.down[:n] + np.uint64(size))


class Chunk:
    """Some consecutive rows of a batch: their text bytes in one array, ``bounds[i]:bounds[i+1]`` of row ``i``."""

    def __init__(self, first: int, data: np.ndarray, bounds: np.ndarray) -> None:
        self.first = first
        self.data = data
        self.bounds = bounds

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def words(self, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the words, and the index of each row's first word (one more entry than rows)."""
        mask = is_word[self.data]
        edge = np.zeros(len(mask) + 1, dtype=bool)
        edge[self.bounds[(self.bounds > 0) & (self.bounds < len(mask))]] = True
        before = np.empty(len(mask) + 1, dtype=bool)
        before[0] = False
        before[1:] = mask
        inner = before & ~edge  # the byte before belongs to the same row and is a word byte
        starts = np.flatnonzero(mask & ~inner[:-1])
        after = np.zeros(len(mask) + 1, dtype=bool)
        after[: len(mask)] = mask
        after &= ~edge
        ends = np.flatnonzero(mask & ~after[1:]) + 1
        return starts, ends, np.searchsorted(starts, self.bounds)


def text_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row bounds of a string column without copying; null rows are empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, dtype=np.uint8)
    return raw, bounds.astype(np.int64)


def chunks(column: pa.Array, max_bytes: int = 1 << 20) -> Iterator[Chunk]:
    """The rows of a string column in runs of about ``max_bytes`` (one row at least, whole rows always)."""
    if not len(column):
        return
    raw, bounds = text_column(column)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(bounds, bounds[first] + max_bytes, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield Chunk(first, raw[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first])
        first = last


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of ``words[i:i+k]`` for every ``i`` (word order counts); across row ends too, callers mask those."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    h = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        h = h * _U64(0xD6E8FEB86659FD93) + words[j : j + n]
    return mix(h)


def list_array(values: pa.Array, sizes: np.ndarray) -> pa.Array:
    """A list column with ``sizes[i]`` of ``values`` in row ``i``."""
    offsets = np.zeros(len(sizes) + 1, dtype=np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


_PLACES = 1 << 40


def sample_of_classes(labelled: DataFrame, per_class: int) -> list[tuple[int, object]]:
    """(doc_id, class) of at most ``per_class`` documents of each class of ``labelled`` (doc_id, class), distinct by doc_id.

    The ids are those whose hash is below a bound that follows from the number of each class: rows are counted, then filtered
    where they are, so no task and no key sees more than its share, and what comes to the driver is bounded by the sample. The
    same rows give the same sample.
    """
    doc, kind = labelled.columns
    sizes = {r[0]: r[1] for r in labelled.groupBy(kind).agg(F.count("*")).collect()}
    if not sizes:
        return []
    place = F.pmod(F.xxhash64(doc), F.lit(_PLACES))
    bound = F.coalesce(*(F.when(F.col(kind) == F.lit(c), F.lit(int(min(1.0, per_class / n) * _PLACES))) for c, n in sizes.items()), F.lit(0))
    chosen = labelled.where(place < bound).select(doc, kind, place).collect()  # about per_class of each class
    out: dict[object, list] = {}
    for row in sorted(chosen, key=lambda r: (r[2], r[0])):
        out.setdefault(row[1], []).append((row[0], row[1]))
    return [pair for rows in out.values() for pair in rows[:per_class]]


def one_text_each(docs: DataFrame, ids: DataFrame, on: tuple[str, ...] = ()) -> DataFrame:
    """``ids`` (doc_id, label) with the text of their documents (that agree ``on`` further columns); of a repeated id the text with
    the least hash, taken map-side."""
    further = [F.col(c).cast("string").alias(c) for c in on]
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *further, "text").where(F.col("text").isNotNull())
    same = texts.join(F.broadcast(ids), ["doc_id", *on])  # as many ids as the sample has
    return same.groupBy(*ids.columns).agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of finished steps whose results are written tables."""
    gc.collect()
    spark._jvm.System.gc()


def per_process(key: str, make: Callable):
    """An object made once in a Python worker process and shared by the tasks that it runs one after the other."""
    store = sys.modules.setdefault("_upkeep_llm_worker", types.ModuleType("_upkeep_llm_worker")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]
