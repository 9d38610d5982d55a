"""Token counts and packing against the tokenizer library itself."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from upkeep.llm import packing, queries, token_counts
from upkeep.llm.bpe import split_pattern

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def blocks(agreed, size=500):
    found = regex.findall(f"[{agreed}]", "".join(map(chr, range(0xD800))))
    return ["".join(f"a{c}1 {c}. \n{c}  {c}B " for c in found[i : i + size]) for i in range(0, len(found), size)]


def test_agreed_characters_split_alike():
    library, split = Tokenizer.from_file(BYTES).pre_tokenizer, split_pattern(token_counts.AGREED, token_counts.PRE_TOKEN)
    for text in blocks(token_counts.AGREED):
        assert [o for _, o in library.pre_tokenize_str(text)] == [m.span() for m in split.finditer(text)]


def test_agreed_characters_normalise_alike():
    tokenizer, split = Tokenizer.from_file(WORDS), split_pattern(packing.AGREED, packing.PRE_TOKEN)
    for text in blocks(packing.AGREED):
        normal = tokenizer.normalizer.normalize_str(text)
        library = [normal[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(normal)]
        assert library == split.findall(text.lower())


def test_whole_tokens_encode_alone():
    tokenizer = Tokenizer.from_file(BYTES)
    whole = token_counts.whole_tokens(BYTES)
    assert len(whole) > 45_000
    assert all(len(e.ids) == 1 for e in tokenizer.encode_batch(sorted(whole), add_special_tokens=False))


alphabet = st.sampled_from(list("ab'sdtréñ中ж \n\t0123.,!$_​\x85 ͅİΣ") + ["<|endoftext|>", "<|startoftext|>", "'re", " the"])


@settings(max_examples=100, deadline=None)
@given(st.lists(alphabet, max_size=40).map("".join))
def test_random_texts(text):
    counter = _counter()
    assert counter.count([text])[0] == len(counter.tokenizer.encode(text, add_special_tokens=False).ids)
    encoder = _encoder()
    assert encoder.encode([text])[0].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


_made = {}


def _counter():
    return _made.setdefault("c", token_counts.Counter(BYTES, token_counts.whole_tokens(BYTES)))


def _encoder():
    return _made.setdefault("e", packing.Encoder(WORDS))


def test_count_query(spark, sf_dir, documents):
    tokenizer = Tokenizer.from_file(BYTES)
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in queries.op10_token_counts(spark, sf_dir).collect()}
    want = {}
    for d, t in documents:
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids)
        want[d] = (len((t or "").encode()), n, n > 1024)
    assert got == want


def test_count_odd(odd_documents, no_documents):
    out = token_counts.token_counts(odd_documents, BYTES).collect()
    assert len(out) == 10
    assert {(r.n_bytes, r.n_tokens) for r in out if r.doc_id in (2, 3)} == {(0, 0)}
    assert token_counts.token_counts(no_documents, BYTES).collect() == []


def test_long_text_is_split_lazily(monkeypatch):
    monkeypatch.setattr(token_counts, "LONG_TEXT", 10)
    monkeypatch.setattr(token_counts, "PIECES", 3)
    text = "Some words, and   more words!\n" * 5
    assert _counter().count([text])[0] == len(_counter().tokenizer.encode(text, add_special_tokens=False).ids)


def check_pieces(pieces, ids_of_doc):
    """``ids_of_doc``: doc_id -> list of id arrays (rows may repeat a doc_id)."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == set(ids_of_doc)
    for doc, parts in by_doc.items():
        rows = ids_of_doc[doc]
        assert sum(p.length for p in parts) == sum(len(r) for r in rows)
        if len(rows) == 1:
            at = 0
            for p in sorted(parts, key=lambda p: p.start):
                assert p.start == at and p.doc_tokens == len(rows[0]) and p.length > 0
                assert p.ids_crc32 == zlib.crc32(rows[0][at : at + p.length].astype("<u4").tobytes())
                at += p.length
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == 4096 or at & (at - 1) == 0


def test_pack_query(spark, sf_dir, documents):
    tokenizer = Tokenizer.from_file(WORDS)
    ids = {d: [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2])] for d, t in documents}
    check_pieces(queries.op2_packing(spark, sf_dir).collect(), ids)


def test_pack_odd(odd_documents, no_documents):
    tokenizer = Tokenizer.from_file(WORDS)
    ids = defaultdict(list)
    for r in odd_documents.collect():
        ids[r.doc_id].append(np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2]))
    check_pieces(packing.pack(odd_documents, WORDS, docs_per_bucket=3).collect(), ids)
    assert packing.pack(no_documents, WORDS).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_differencing_is_near_equal(seed):
    random = np.random.default_rng(seed)
    sizes = random.integers(1, 4096, 300).tolist()
    groups = packing.differencing(sizes, 40)
    assert sorted(i for g in groups for i in g) == list(range(300))
    totals = [sum(sizes[i] for i in g) for g in groups]
    assert max(totals) - min(totals) < 0.05 * np.mean(totals)
    within = packing.windows(sizes)
    assert max(sum(sizes[i] for i in g) for g in within) <= 4096
    assert len(within) < 1.1 * -(-sum(sizes) // 4096) + 2


def test_windows_of_full_items():
    assert sorted(map(len, packing.windows([4096] * 5))) == [1] * 5
    assert packing.windows([3000, 3000, 3000]) and len([g for g in packing.windows([3000, 3000, 3000]) if g]) == 3


def test_rows_that_repeat_spread_over_buckets():
    """A task deals the same again in whatever order its rows come, and equal rows go to all buckets."""
    rows = np.concatenate([np.full(20_000, 77), np.arange(5_000)]).astype(np.int64)
    first = packing.dealt(rows, {}, 3, 50)
    assert np.bincount(first, minlength=50).max() < 1.3 * len(rows) / 50
    order = np.random.default_rng(0).permutation(len(rows))
    again = packing.dealt(rows[order], {}, 3, 50)
    assert sorted(zip(rows.tolist(), first.tolist())) == sorted(zip(rows[order].tolist(), again.tolist()))
    halves, seen = [], {}
    for part in np.array_split(rows, 7):
        halves.append(packing.dealt(part, seen, 3, 50))
    assert np.array_equal(np.concatenate(halves), first)
    assert np.mean(packing.dealt(rows, {}, 4, 50) == first) < 0.1  # another task deals its equal rows elsewhere


def test_many_equal_rows(spark):
    docs = spark.createDataFrame([(None, "the same few words"), (5, "the same few words")] * 1000, "doc_id bigint, text string").repartition(3)
    pieces = packing.pack(docs, WORDS, docs_per_bucket=100).collect()
    buckets = {}
    for p in pieces:
        buckets.setdefault(p.sequence_id >> 32, []).append(p)
    assert len(buckets) == 20 and max(map(len, buckets.values())) < 250
    assert sum(p.length for p in pieces) == 2000 * pieces[0].doc_tokens
