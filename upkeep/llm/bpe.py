"""Pre-tokens and their BPE merges, for operators that remember what each distinct pre-token encodes to."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np


def split_pattern(agreed: str, template: str) -> re.Pattern:
    """``template`` with ``<L>``, ``<N>`` and ``<S>`` replaced by the letters, numbers and white space among ``agreed`` (lower-cased or not).

    Python's own ``re`` runs such explicit classes faster than the property classes of ``regex``.
    """
    import regex

    members = regex.findall(f"[{agreed}]", "".join(map(chr, range(0xD800))))
    members = sorted({*members, *"".join(members).lower()})

    def ranges(kind: str) -> str:
        codes = np.array([ord(c) for c in members if regex.match(kind, c)])
        cut = np.flatnonzero(np.diff(codes) != 1)
        first, last = codes[np.append(0, cut + 1)], codes[np.append(cut, len(codes) - 1)]
        return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in zip(first, last))

    for name, kind in (("<L>", r"\p{L}"), ("<N>", r"\p{N}"), ("<S>", r"\s")):
        template = template.replace(name, ranges(kind))
    return re.compile(template)


def whole_tokenizer(tokenizer_path: str):
    """The tokenizer as its file has it, but that it neither cuts nor pads."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class Merger:
    """Encodes pre-tokens alone: the tokenizer's model and byte mapping without its normalizer and split pattern."""

    def __init__(self, tokenizer_path: str) -> None:
        from tokenizers import normalizers, pre_tokenizers

        self.tokenizer = whole_tokenizer(tokenizer_path)
        self.tokenizer.normalizer = normalizers.Sequence([])
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids and, for each piece, how many are its."""
        if not pieces:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        out = self.tokenizer.encode_batch([pieces], is_pretokenized=True, add_special_tokens=False)[0]
        return np.array(out.ids), np.bincount(np.array(out.word_ids, dtype=np.int64), minlength=len(pieces))


class Remembered:
    """What pre-tokens encode to: ``fixed`` ones and the most recently used others (two generations of ``limit``)."""

    def __init__(self, make: Callable[[list[str]], Iterable], fixed: dict | None = None, limit: int = 300_000) -> None:
        self.make, self.fixed, self.limit = make, fixed or {}, limit
        self.young, self.old = dict(self.fixed), {}

    def of(self, pieces: Iterable[list[str]]) -> dict:
        """A dictionary with (at least) all of these pre-tokens."""
        distinct = set().union(*pieces)
        if len(self.young) > self.limit + len(self.fixed):
            self.old, self.young = self.young, dict(self.fixed)
        missing = distinct.difference(self.young)
        kept = {p: self.old[p] for p in missing if p in self.old}
        rest = [p for p in missing if p not in kept]
        self.young.update(kept)
        self.young.update(zip(rest, self.make(rest)))
        return self.young


def runs_of_texts(texts: list[str], size: int = 1 << 20) -> Iterator[slice]:
    """Slices of about ``size`` characters, one text at least."""
    first = total = 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= size:
            yield slice(first, i + 1)
            first, total = i + 1, 0
    if first < len(texts):
        yield slice(first, len(texts))
