"""Periodic runs of words inside a text, found by seeds on diagonals.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are identical) and at least
``max(least, times * q)`` words that no neighbouring word extends keeping the period.

On the diagonal of lag ``q`` (word ``i`` against word ``i + q``) a run is an overlap of at least
``max(least - q, (times - 1) * q)`` words. The k-grams of that guaranteed overlap are the seeds: ``k`` is the least one of
all lags for the lags up to ``k``, and ``times - 1`` times more for each further class of lags, so ``k`` is never below
the lag. Then a k-gram inside a run stands next at the distance of the smallest period and nowhere between, so only
neighbouring occurrences of a k-gram in the same text are paired, never all of them.

Seeds are taken along their diagonals. The furthest place that a lag has covered suppresses later seeds there; the first
seed of each covered stretch is extended word by word to both sides. The words of every run are compared byte by byte
at the end (a text with a hash collision is done lag by lag).

Null and empty texts have no words and no runs. Rows are judged one by one, whatever their doc_id; repeated rows have the
same result; extra columns are ignored; an empty table gives no rows. Nothing is shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.common import NON_SPACE_BYTE, Hasher, chunks, mix, shingle_hashes

LEAST = 6
TIMES = 4
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_ROW = np.uint64(0x9FB21C651E98DF25)

# (doc_id or None, number of words) -> which word of the text stands at each place, or None to leave the text as it is
Order = Callable[[int | None, int], np.ndarray | None]


def echoing_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """For a tenth of the ids: the words from some place on repeat the first few of them."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([np.arange(a), a + np.arange(n - a) % p])


def seed_length(least: int, times: int) -> int:
    """The least overlap on a diagonal that a run of any period guarantees."""
    return min(max(least - q, (times - 1) * q) for q in range(1, max(least, 2)))


def _wider(grams: np.ndarray, k: int, factor: int) -> np.ndarray:
    """Hashes of ``factor * k`` words from those of ``k`` words."""
    n = len(grams) - (factor - 1) * k
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    h = np.zeros(n, dtype=np.uint64)
    for j in range(factor):
        h = mix(h + grams[j * k : j * k + n])
    return h


def _neighbours(key: np.ndarray, at: np.ndarray, nearest: int, furthest: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of the equal keys that follow each other at a lag of ``nearest`` to ``furthest``."""
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    again = np.zeros(len(key), dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    key, at = key[again], at[again]
    order = np.lexsort((at, key))
    key, at = key[order], at[order]
    lag = at[1:] - at[:-1]
    seed = (key[1:] == key[:-1]) & (lag >= nearest) & (lag <= furthest)
    return at[:-1][seed], lag[seed]


def _extended(words: np.ndarray, low: np.ndarray, high: np.ndarray, lag: np.ndarray, first: np.ndarray, end: np.ndarray) -> None:
    """Widen the overlaps ``low:high`` on their diagonals, in place, while the next word fits (``first:end`` is the text)."""
    going = np.arange(len(low))
    while len(going):
        going = going[low[going] > first[going]]
        going = going[words[low[going] - 1] == words[low[going] - 1 + lag[going]]]
        low[going] -= 1
    going = np.arange(len(high))
    while len(going):
        going = going[high[going] + lag[going] < end[going]]
        going = going[words[high[going]] == words[high[going] + lag[going]]]
        high[going] += 1


def find_runs(words: np.ndarray, bounds: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Runs in the word hashes of several texts (``bounds[i]:bounds[i+1]`` is text ``i``): rows of (text, place, length,
    period), ordered; places count from the first word of all texts."""
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    factor, k, nearest = times - 1, seed_length(least, times), 1
    longest = int(sizes.max()) if len(sizes) else 0
    grams = shingle_hashes(words, k)
    found = []
    while len(grams) and longest >= max(least, times * nearest):
        at = np.arange(len(grams))
        text = owner[: len(grams)]
        at = at[(sizes[text] >= max(least, times * nearest)) & (at + k <= bounds[text + 1])]
        seed, lag = _neighbours(mix(grams[at] ^ (owner[at].astype(np.uint64) * _ROW)), at, nearest, k)
        if len(seed):
            order = np.lexsort((seed, lag))
            seed, lag = seed[order], lag[order]
            covered = np.append(False, (lag[1:] == lag[:-1]) & (owner[seed[1:]] == owner[seed[:-1]]) & (seed[1:] <= seed[:-1] + k))
            start = np.flatnonzero(~covered)
            low, lag = seed[start].copy(), lag[start]
            high = seed[np.append(start[1:], len(seed)) - 1] + k
            text = owner[low]
            _extended(words, low, high, lag, bounds[text], bounds[text + 1])
            found.append(np.column_stack([text, low, high - low + lag, lag]))
        grams = _wider(grams, k, factor)
        nearest, k = k + 1, factor * k
    if not found:
        return np.empty((0, 4), dtype=np.int64)
    runs = np.concatenate(found)
    runs = runs[runs[:, 2] >= np.maximum(least, times * runs[:, 3])]
    return np.unique(runs, axis=0)


def runs_by_lag(words: list[bytes], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs by comparing the words of each lag; for texts with a hash collision."""
    code = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.array([code[w] for w in words], dtype=np.int64)
    best: dict[tuple[int, int], int] = {}
    for lag in range(1, len(ids) // times + 1):
        edge = np.diff(np.pad((ids[lag:] == ids[:-lag]).astype(np.int8), 1))
        for low, high in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            if high - low + lag >= max(least, times * lag):
                best.setdefault((low, high + lag), lag)  # of the periods of one stretch the smallest comes first
    return sorted((low, end - low, lag) for (low, end), lag in best.items())


def _identical(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Whether the words of each run are equal, byte by byte, one period apart."""
    n = runs[:, 2] - runs[:, 3]
    run = np.repeat(np.arange(len(runs)), n)
    left = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n) + runs[run, 1]
    right = left + runs[run, 3]
    size = ends[left] - starts[left]
    good = np.ones(len(runs), dtype=bool)
    unequal = size != ends[right] - starts[right]
    good[run[unequal]] = False
    size = np.where(unequal, 0, size)
    for part in range(0, len(run), 1 << 18):
        s = size[part : part + (1 << 18)]
        inner = np.arange(int(s.sum())) - np.repeat(np.cumsum(s) - s, s)
        a = np.repeat(starts[left[part : part + (1 << 18)]], s) + inner
        b = np.repeat(starts[right[part : part + (1 << 18)]], s) + inner
        good[np.repeat(run[part : part + (1 << 18)], s)[data[a] != data[b]]] = False
    return good


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length by period; ties: smallest start, then period."""
    best = None
    for start, length, period in sorted(runs, key=lambda r: (r[0], r[2])):
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    return best


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run contains after its first period."""
    drop = np.zeros(len(words), dtype=bool)
    for start, length, period in runs:
        drop[start + period : start + length] = True
    return [w for w, gone in zip(words, drop.tolist()) if not gone]


def _scan(least: int, times: int, order: Order | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                starts, ends, bounds = chunk.words(NON_SPACE_BYTE)
                words = hasher.ranges(chunk.data, starts, ends)
                ids = batch.column(0).slice(chunk.first, len(chunk)).to_pylist()
                orders = {}
                if order is not None:
                    for i, doc in enumerate(ids):
                        lo, hi = int(bounds[i]), int(bounds[i + 1])
                        if (moved := order(doc, hi - lo)) is not None:
                            orders[i] = moved
                            for a in (starts, ends, words):
                                a[lo:hi] = a[lo + moved]
                runs = find_runs(words, bounds, least, times)
                sound = _identical(chunk.data, starts, ends, runs)
                of_row = np.searchsorted(runs[:, 0], np.arange(len(chunk) + 1))
                text = chunk.data.tobytes()
                found, kept = [], []
                for i in range(len(chunk)):
                    own = text[chunk.bounds[i] : chunk.bounds[i + 1]].split()
                    if i in orders:
                        own = [own[j] for j in orders[i].tolist()]
                    a, b = of_row[i], of_row[i + 1]
                    row = [(int(s - bounds[i]), int(n), int(p)) for _, s, n, p in runs[a:b]]
                    if not sound[a:b].all():
                        row = runs_by_lag(own, least, times)
                    row.sort(key=lambda r: (r[0], r[2]))
                    found.append(row)
                    kept.append(b" ".join(collapsed(own, row) if row else own))
                best = [strongest(r) or (None, None, None) for r in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array([len(r) for r in found], pa.int64()),
                        *(pa.array([b[j] for b in best], pa.int64()) for j in range(3)),
                        pa.array([None if b[0] is None else 1000 * b[1] // b[2] for b in best], pa.int64()),
                        pa.array([[{"start": s, "length": n, "period": p} for s, n, p in r] for r in found], _RUNS),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs", "collapsed"],
                )

    return run


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES, order: Order | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_runs, start, length, period and exponent_milli of the strongest run,
    runs (by start, then period), collapsed (the text without the repeats of its runs). ``order`` rearranges words first."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    schema = f"doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs {RUNS}, collapsed string"
    return rows.mapInArrow(_scan(least, times, order), schema)
