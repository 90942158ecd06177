"""Splitting texts into pre-tokens, coded by the distinct ones of a block of texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Bytes of text that are split at once.
BLOCK = 1 << 21


class Pieces(NamedTuple):
    """The pre-tokens of a block of texts: text i has names[c] for c in codes[ends[i] : ends[i + 1]]."""

    names: list[str]
    codes: np.ndarray
    ends: np.ndarray


@lru_cache
def splitter(pattern: str = public_tokenizers.PATTERN):
    """text -> list of its pre-tokens, which joined give the text."""
    return regex.compile(pattern).findall


def blocks(texts: pa.Array, size: int = BLOCK) -> Iterator[pa.Array]:
    """The texts in order (null: empty) in arrays of about ``size`` bytes, or one longer text."""
    texts = texts.fill_null("") if texts.null_count else texts
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + size, "right")))
        yield texts.slice(a, b - a)
        a = b


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices starts[0], starts[0] + 1, ... (lengths[0] of them), starts[1], ..."""
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - before, lengths)


def factorise(texts: pa.Array, pattern: str = public_tokenizers.PATTERN, whole: np.ndarray | None = None, cut: Callable[[str], list[str]] | None = None) -> Pieces:
    """Pre-tokens of the texts (none null); each distinct word of the block is split once.

    A space between two characters that are not white starts a pre-token in the pattern of
    public_tokenizers: no alternative holds a space after another kind of character, and
    none looks behind.  So words between such spaces are split on their own.  Texts with
    other spaces beside white characters, those marked in ``whole``, and all texts under
    other patterns are split as they are, by ``cut`` where it is given.
    """
    find, n = splitter(pattern), len(texts)
    cut = cut or find
    if pattern == public_tokenizers.PATTERN:
        lists = pc.split_pattern(texts, " ")
        starts, flat = lists.offsets.to_numpy()[:-1].astype(np.int64), lists.values
        words = flat.dictionary_encode()
        code, words = words.indices.to_numpy().astype(np.int64), words.dictionary.to_pylist()
        bare = np.fromiter((not w or w[0].isspace() or w[-1].isspace() for w in words), bool, len(words))
        odd = np.logical_or.reduceat(bare[code], starts) if n else np.zeros(0, bool)
        odd |= False if whole is None else whole
        sizes = np.diff(np.append(starts, len(code)))
    else:
        starts, code, words, bare, odd, sizes = np.arange(n), np.zeros(n, np.int64), [], np.zeros(0, bool), np.ones(n, bool), np.ones(n, np.int64)

    # Units: the words, each after a space, then one a text: its first word, or all of an odd text.
    keep = ~np.repeat(odd, sizes)
    keep[starts] = False
    good = np.flatnonzero(np.bincount(code[keep], minlength=len(words)))
    spaced = find("".join(f" {words[i]}" for i in good.tolist()))
    unit = np.zeros(len(words) + n, np.int64)
    first = np.flatnonzero(np.fromiter((p[0] == " " for p in spaced), bool, len(spaced)))
    unit[good] = np.diff(np.append(first, len(spaced)))
    heads = [cut(texts[i].as_py()) if odd[i] else find(words[code[starts[i]]]) for i in range(n)]
    unit[len(words) :] = np.fromiter(map(len, heads), np.int64, n)
    at = np.zeros(len(unit), np.int64)
    at[good] = first
    at[len(words) :] = len(spaced) + np.cumsum(unit[len(words) :]) - unit[len(words) :]
    for h in heads:
        spaced += h
    named = pa.array(spaced, pa.string()).dictionary_encode()

    code = code.copy()
    code[starts] = len(words) + np.arange(n)
    keep[starts] = True
    used, counts = code[keep], np.where(odd, 1, sizes)
    lengths = unit[used]
    total = np.concatenate(([0], np.cumsum(lengths)))
    ends = total[np.concatenate(([0], np.cumsum(counts)))]
    codes = named.indices.to_numpy()[ragged(at[used], lengths)]
    return Pieces(named.dictionary.to_pylist(), codes, ends)
