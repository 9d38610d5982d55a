"""Token counts by the whole-token shortcut.

A byte-level BPE vocabulary holds many strings that, encoded alone, come back as exactly one token. Which ones is
proved once, on the driver, by encoding every vocabulary string (``whole_tokens``; the set is bounded by the
vocabulary). Counting then splits a text into pre-tokens, counts those found in the set as one token each, and gives
only the remaining distinct pre-tokens to the merging library.

The split pattern runs in Python, whose character tables agree with the tokenizer library's for the
characters of ``AGREED`` (``tests/llm`` compares them one by one). Texts with other characters, and texts that contain
an added special token, are encoded by the tokenizer library as a whole.

Null or empty texts have no bytes and no tokens; repeated rows are counted each; a long text is split lazily, never
cut. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.bpe import Merger, Remembered, runs_of_texts, split_pattern, whole_tokenizer
from upkeep.llm.common import per_process

# the split pattern of byte-level BPE (fixed value), the commonest alternative first; see split_pattern
PRE_TOKEN = " ?[<L>]+|'(?:s|t|re|ve|m|ll|d)| ?[<N>]+| ?[^<S><L><N>]+|[<S>]+(?![^<S>])|[<S>]+"
# characters whose classes are the same in both libraries
AGREED = "\x00-՗‐-‧‰-⁞ぁ-ゖァ-ヺ一-鿿가-힣"
OTHER = f"[^{AGREED}]"
LONG_TEXT = 1 << 20
PIECES = 1 << 17


def whole_tokens(tokenizer_path: str) -> frozenset[str]:
    """Vocabulary strings that encode alone as exactly one token, themselves one pre-token (proved by encoding)."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path)
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    texts = [tokenizer.decode([i]) for i in range(tokenizer.get_vocab_size())]
    texts = sorted({t for t in texts if t and "�" not in t and t not in special})
    split = split_pattern(AGREED, PRE_TOKEN)
    encoded = tokenizer.encode_batch(texts, add_special_tokens=False)
    return frozenset(t for t, e in zip(texts, encoded) if len(e.ids) == 1 and split.fullmatch(t))


class Counter:
    """Counts tokens of texts; pre-tokens outside the whole-token set are merged once and remembered."""

    def __init__(self, tokenizer_path: str, whole: frozenset[str]) -> None:
        import regex

        self.path = tokenizer_path
        self.merger = Merger(tokenizer_path)
        self.split = split_pattern(AGREED, PRE_TOKEN)
        self.other = regex.compile(OTHER)
        self.special = [t.content for t in self.merger.tokenizer.get_added_tokens_decoder().values()]
        self.known = Remembered(lambda pieces: self.merger.encode(pieces)[1].tolist(), dict.fromkeys(whole, 1))

    @cached_property
    def tokenizer(self):
        return whole_tokenizer(self.path)

    def count(self, texts: list[str]) -> list[int]:
        out = [0] * len(texts)
        split = {}
        for i, text in enumerate(texts):
            if any(s in text for s in self.special) or self.other.search(text):
                out[i] = len(self.tokenizer.encode(text, add_special_tokens=False).ids)
            elif len(text) > LONG_TEXT:
                found = (m.group() for m in self.split.finditer(text))
                while part := list(islice(found, PIECES)):
                    out[i] += sum(map(self.known.of([part]).__getitem__, part))
            else:
                split[i] = self.split.findall(text)
        known = self.known.of(split.values()).__getitem__
        for i, pieces in split.items():
            out[i] = sum(map(known, pieces))
        return out


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 1024) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit)."""
    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(tokenizer_path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        counter = per_process(f"counter {tokenizer_path}", lambda: Counter(tokenizer_path, whole.value))
        for batch in batches:
            texts = batch.column(1).fill_null("").to_pylist()
            n = [c for part in runs_of_texts(texts) for c in counter.count(texts[part])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
    )
    counted = rows.mapInArrow(count, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
