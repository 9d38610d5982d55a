"""Periodic runs against a direct search of every stretch."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from upkeep.llm import periodic_runs, queries
from upkeep.llm.common import mix

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w):
    """(start, length, period) of all runs: every maximal stretch of every lag, kept where no smaller period holds."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                part = w[i : j + q]
                if not any(part[:-p] == part[p:] for p in range(1, q)):
                    out.append((i, j - i + q, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def result(doc, text, planted):
    w = SPACE.findall(text or "")
    if planted and doc is not None and w and zlib.crc32(str(doc).encode()) % 10 == 0:
        n, g = len(w), zlib.crc32(str(doc).encode()) // 10
        a, p = g % n, None
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else None
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc, len(runs), *head, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_query(spark, sf_dir, documents):
    rows = queries.op13_periodic_runs(spark, sf_dir).collect()
    want = [result(d, t, True) for d, t in documents]
    assert sum(r[1] > 0 for r in want) > 5
    assert sorted(tuple(r) for r in rows) == sorted(want)


def test_seed_length():
    assert periodic_runs.seed_length(6, 4) == 5
    assert periodic_runs.seed_length(2, 3) == 2


@pytest.mark.parametrize("seed", range(4))
def test_random(seed):
    """Few distinct words, planted repeats, many texts side by side."""
    random = np.random.default_rng(seed)
    for _ in range(60):
        texts = []
        for _ in range(int(random.integers(1, 6))):
            n = int(random.integers(0, 300))
            w = random.integers(0, int(random.integers(1, 5)), n).tolist()
            for _ in range(3 if n else 0):
                s, q = int(random.integers(0, n)), int(random.integers(1, 60))
                for i in range(s + q, min(n, s + q * int(random.integers(2, 9)))):
                    w[i] = w[i - q]
            texts.append(w)
        bounds = np.cumsum([0, *map(len, texts)])
        words = mix(np.array([x for w in texts for x in w], dtype=np.uint64) + np.uint64(9))
        found = periodic_runs.find_runs(words, bounds)
        for i, w in enumerate(texts):
            got = sorted(((int(s - bounds[i]), int(n), int(p)) for r, s, n, p in found if r == i), key=lambda r: (r[0], r[2]))
            assert got == brute(w)
            assert sorted(got) == periodic_runs.runs_by_lag([str(x).encode() for x in w])


def test_long_runs():
    """One word 200,000 times, and a period of 5,000 words: as many seeds as words, one run each."""
    one = np.full(200_000, 77, dtype=np.uint64)
    cycle = np.tile(mix(np.arange(1, 5001, dtype=np.uint64)), 9)[:-13]
    found = periodic_runs.find_runs(np.concatenate([one, cycle]), np.array([0, len(one), len(one) + len(cycle)]))
    assert found.tolist() == [[0, 0, 200_000, 1], [1, 200_000, 9 * 5000 - 13, 5000]]


def test_collisions_are_done_by_bytes():
    words = [b"a", b"b"] * 5 + [b"c"]
    data = np.frombuffer(b" ".join(words), np.uint8)
    starts = np.arange(0, 22, 2)
    sound = periodic_runs._identical(data, starts, starts + 1, np.array([[0, 0, 10, 2], [0, 0, 11, 1], [0, 0, 11, 2]]))
    assert sound.tolist() == [True, False, False]


def test_ties():
    assert periodic_runs.strongest([(20, 8, 2), (0, 4 * 3, 3), (0, 8, 2), (40, 24, 6)]) == (0, 8, 2)
    assert periodic_runs.strongest([]) is None


def test_odd(spark, odd_documents, no_documents):
    docs = [(r.doc_id, r.text) for r in odd_documents.collect()]
    found = periodic_runs.periodic_runs(odd_documents)
    key = lambda r: tuple((x is None, x or 0) for x in r[:2]) + r[2:]
    got = [(r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, hashlib.sha256(r.collapsed.encode()).hexdigest()) for r in found.collect()]
    want = [(*(w := result(d, t, False))[:6], w[7]) for d, t in docs]
    order = lambda r: (str(r[0]), r[1], r[-1])
    assert sorted(got, key=order) == sorted(want, key=order)
    assert key(got[0]) is not None and periodic_runs.periodic_runs(no_documents).collect() == []
