"""Byte-level BPE encoding and decoding over padded numpy matrices.

Texts are split into pre-tokens.  Distinct pre-tokens that are not in the vocabulary
are bucketed by length into padded matrices of token ids, one pre-token a column.  In
each round every pre-token merges its leftmost pair of minimum rank; one without
mergeable pairs leaves the matrix, and the matrix is compacted.  Ranks of pairs come from
an open-addressing hash table in numpy arrays, and only the two pairs beside a merge are
looked up again.  A pre-token of more than ``LONG`` bytes has a matrix of its own, where a
round merges the leftmost pair of minimum rank together with the later pairs of that rank,
up to one whose merge makes a pair of the same or a lower rank, which then comes next.

Defined results for unusual input: null text is encoded as an empty one, to an empty
list; texts of any length are encoded whole; repeated rows give repeated results; an
empty table gives an empty table; a result column takes the place of an input column
of the same name; decoding null ids gives empty bytes, and unknown or null ids in a
list raise.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.pretokens import blocks, factorise, ragged
from helixframe.runtime import bound_batches, fresh

#: Rank of a pair that does not merge.
NEVER = np.int32(2**31 - 1)
#: Cells of a matrix; pre-tokens beyond it wait for the next matrix.
CELLS = 1 << 18
#: Pre-tokens of more bytes are merged one at a time.
LONG = 2048
#: Pre-tokens of one generation that a worker remembers; it keeps two, and a use renews.
REMEMBERED = 100_000
#: Pre-tokens of more bytes are not remembered.
REMEMBERED_BYTES = 64
#: Ids that are decoded at once.
DECODED = 1 << 18


class PairTable:
    """Hash table from pairs of token ids to the rank of their merge."""

    def __init__(self, ranks: dict[bytes, int]):
        self.base = np.int64(max(ranks.values()) + 1)
        keys, values = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    keys.append(left * int(self.base) + right)
                    values.append(rank)
        keys, values = np.array(keys, np.int64), np.array(values, np.int32)
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, NEVER, np.int32)
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] == -1
            _, first = np.unique(slot, return_index=True)
            placed = np.zeros(len(keys), bool)
            placed[first] = True
            placed &= free
            self.keys[slot[placed]], self.values[slot[placed]] = keys[placed], values[placed]
            keys, values, slot = keys[~placed], values[~placed], (slot[~placed] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks for arrays of ids; NEVER where a pair does not merge or an id is negative (padding)."""
        keys = left.astype(np.int64) * self.base + right
        slot = self._slot(keys)
        at = self.keys[slot]
        out = np.where(at == keys, self.values[slot], NEVER)
        open_ = np.flatnonzero((at != keys) & (at != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            at = self.keys[slot[open_]]
            hit = at == keys[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (at != -1)]
        out[(left < 0) | (right < 0)] = NEVER
        return out


class Codec:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pattern = pattern
        self.pairs = PairTable(self.ranks)
        self.byte = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.byte_pairs = self.pairs.find(np.repeat(self.byte, 256), np.tile(self.byte, 256))
        by_id = sorted((v, k) for k, v in self.ranks.items())
        self.token_bytes = np.frombuffer(b"".join(k for _, k in by_id), np.uint8)
        size = np.fromiter((len(k) for _, k in by_id), np.int64, len(by_id))
        ids = np.fromiter((v for v, _ in by_id), np.int64, len(by_id))
        self.token_len, self.token_at = np.full(int(self.pairs.base), -1, np.int64), np.zeros(int(self.pairs.base), np.int64)
        self.token_len[ids], self.token_at[ids] = size, np.cumsum(size) - size
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces (none empty), each merged on its own, as little-endian int32."""
        out: list = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, x in enumerate(pieces):
            if (whole := self.ranks.get(x)) is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(x) > LONG:
                out[i] = self._merge_long(x)
            else:
                buckets.setdefault((len(x) + 1) // 2 * 2, []).append(i)
        for width, rows in sorted(buckets.items()):
            for k in range(0, len(rows), step := max(1, CELLS // width)):
                self._merge_matrix(pieces, rows[k : k + step], width, out)
        return out

    def _merge_matrix(self, pieces: list[bytes], rows: list[int], width: int, out: list) -> None:
        raw = np.frombuffer(b"".join(pieces[i].ljust(width, b"\0") for i in rows), np.uint8).reshape(len(rows), width).T.copy()
        lengths = np.fromiter((len(pieces[i]) for i in rows), np.int64, len(rows))
        place = np.arange(width)[:, None]
        ids = np.where(place < lengths, self.byte[raw], np.int32(-1))
        # A pair's cell holds rank * width + place, so that the smallest is the leftmost of minimum rank.
        never = np.int64(NEVER) * width
        pairs = np.where(place[1:] < lengths, self.byte_pairs[raw[:-1].astype(np.int32) * 256 + raw[1:]].astype(np.int64) * width + place[:-1], never)
        own = np.array(rows)
        while True:
            best = pairs.min(0) if len(pairs) else np.full(len(own), never)
            done = best >= never - width
            if done.any():
                left = ids[:, done].T
                full = left >= 0
                flat, ends = left[full].astype("<i4").tobytes(), np.cumsum(full.sum(1)).tolist()
                a = 0
                for i, b in zip(own[done].tolist(), ends, strict=True):
                    out[i] = flat[4 * a : 4 * b]
                    a = b
                if done.all():
                    return
                live = ~done
                own, ids, pairs, best = own[live], ids[:, live], pairs[:, live], best[live]
            rank, at = np.divmod(best, width)
            rank, all_ = rank.astype(np.int32), np.arange(len(own))
            # Each column loses one id and one pair.
            ids = np.where(place[: len(ids) - 1] <= at, ids[:-1], ids[1:])
            ids[at, all_] = rank
            pairs = np.where(place[: len(pairs) - 1] < at, pairs[:-1], pairs[1:] - 1)
            for hit, p in ((np.flatnonzero(at > 0), at - 1), (np.flatnonzero(at < len(pairs)), at)):
                p = p[hit]
                pairs[p, hit] = self.pairs.find(ids[p, hit], ids[p + 1, hit]).astype(np.int64) * width + p

    def _merge_long(self, piece: bytes) -> bytes:
        raw = np.frombuffer(piece, np.uint8).astype(np.int32)
        ids, pairs = self.byte[raw], self.byte_pairs[raw[:-1] * 256 + raw[1:]]
        while len(pairs) and (best := pairs.min()) != NEVER:
            at = np.flatnonzero(pairs == best)
            # Of pairs that share a token, every second one from the left.
            new = np.append(True, np.diff(at) > 1)
            at = at[(at - at[new][np.cumsum(new) - 1]) % 2 == 0]
            # Later ones wait where a merge makes a pair that comes before them.
            before = np.where(np.append(False, np.diff(at) == 2), best, ids[at - 1])
            before[at == 0] = -1
            after = np.append(ids, np.int32(-1))[at + 2]
            made = np.minimum(self.pairs.find(before, np.full(len(at), best)), self.pairs.find(np.full(len(at), best), after))
            at = at[: int(np.argmax(made <= best)) + 1] if (made <= best).any() else at
            ids[at] = best
            ids, pairs = np.delete(ids, at + 1), np.delete(pairs, at)
            at = at - np.arange(len(at))
            at = np.concatenate((at - 1, at))
            at = at[(at >= 0) & (at < len(pairs))]
            pairs[at] = self.pairs.find(ids[at], ids[at + 1])
        return ids.astype("<i4").tobytes()

    def ids_of(self, names: list[str]) -> list[bytes]:
        """Ids of pre-tokens as little-endian int32; recent ones are remembered."""
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        out = [known.get(x) for x in names]
        new = []
        for i, x in enumerate(out):
            if x is None:
                if (was := older.get(names[i])) is None:
                    new.append(i)
                else:
                    out[i] = known[names[i]] = was
        raw = [names[i].encode() for i in new]
        for i, b, ids in zip(new, raw, self.merge(raw), strict=True):
            out[i] = ids
            if len(b) <= REMEMBERED_BYTES:
                known[names[i]] = ids
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, how many each has); texts are not null."""
        names, codes, ends = factorise(texts, self.pattern)
        found = self.ids_of(names)
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), "<i4")
        lengths = size[codes]
        total = np.concatenate(([0], np.cumsum(lengths)))
        return flat[ragged((np.cumsum(size) - size)[codes], lengths)], np.diff(total[ends])

    def decode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """(bytes of all ids in order, where each id's bytes end)."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.token_len) or (self.token_len[ids] < 0).any()):
            raise ValueError("unknown token id")
        size = self.token_len[ids]
        parts = (self.token_bytes[ragged(self.token_at[ids[k : k + DECODED]], size[k : k + DECODED])].tobytes() for k in range(0, len(ids), DECODED))
        return b"".join(parts), np.cumsum(size)


@lru_cache(2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _encoded(texts: pa.Array, ranks: str, pattern: str) -> pa.ListArray:
    found = [codec(ranks, pattern).encode(part) for part in blocks(texts)]
    ends = np.cumsum(np.concatenate([[0], *(n for _, n in found)]))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int32), *(ids for ids, _ in found)])))


def _decoded(lists: pa.ListArray, ranks: str, pattern: str) -> pa.Array:
    flat, n = lists.flatten(), np.array([len(x) if x.is_valid else 0 for x in lists], np.int64)
    if flat.null_count:
        raise ValueError("null token id")
    data, ends = codec(ranks, pattern).decode(flat.to_numpy())
    ends = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(n)))]
    return pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])


# All are marked so that they are computed once, however many columns use the result.


def encode(df: DataFrame, ranks: str, text: str = "text", out: str = "ids", pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``df`` with the column ``out``: array<int> of the whole text's ids by the rank file at ``ranks``."""
    bound_batches(df.sparkSession)

    @F.arrow_udf("array<int>")
    def of(texts: pa.Array) -> pa.Array:
        return _encoded(texts, ranks, pattern)

    return df.withColumn(out, of.asNondeterministic()(F.col(f"`{text}`")))


def decode(df: DataFrame, ranks: str, ids: str = "ids", out: str = "decoded", pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``df`` with the column ``out``: the bytes that the ids in ``ids`` stand for."""
    bound_batches(df.sparkSession)

    @F.arrow_udf("binary")
    def of(lists: pa.Array) -> pa.Array:
        return _decoded(lists, ranks, pattern)

    return df.withColumn(out, of.asNondeterministic()(F.col(f"`{ids}`")))


def round_trip(df: DataFrame, ranks: str, text: str = "text", ids: str = "ids", decoded: str = "decoded", pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``df`` with the columns ``ids`` and ``decoded``, as ``decode(encode(df))`` gives them, by one worker a task."""
    bound_batches(df.sparkSession)

    @F.arrow_udf("struct<ids:array<int>,decoded:binary>")
    def of(texts: pa.Array) -> pa.Array:
        lists = _encoded(texts, ranks, pattern)
        return pa.StructArray.from_arrays([lists, _decoded(lists, ranks, pattern)], ["ids", "decoded"])

    both = fresh(df, "both")
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in (ids.lower(), decoded.lower())]
    made = df.withColumn(both, of.asNondeterministic()(F.col(f"`{text}`")))
    return made.select(*kept, F.col(f"{both}.ids").alias(ids), F.col(f"{both}.decoded").alias(decoded))
