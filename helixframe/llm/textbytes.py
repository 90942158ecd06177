"""Arrow string columns as numpy bytes, and hashed trigrams of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that numpy works on at once.
PIECE = 1 << 18


def pieces(texts: pa.Array, size: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, offsets) of consecutive rows, about ``size`` bytes or one longer row at a time; null: empty."""
    texts = pa.array(texts.fill_null("")) if texts.null_count else texts
    n = len(texts)
    if not n:
        return
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and len(data) else np.empty(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, "right")) - 1)
        yield raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def trigrams(data: np.ndarray, fold: np.ndarray, bits: int) -> np.ndarray:
    """Hash of the folded trigram that starts at each byte (two fewer than bytes)."""
    x = fold[data].astype(np.uint32)
    key = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
    return ((key * np.uint32(2654435761)) >> np.uint32(32 - bits)).astype(np.int32)


def row_sums(values: np.ndarray, offsets: np.ndarray, lost: int = 2) -> np.ndarray:
    """Sums of ``values`` (one a byte, ``lost`` missing at the end) inside each row, without trigrams that cross rows."""
    total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    start = np.minimum(offsets[:-1], len(values))
    end = np.minimum(np.maximum(offsets[1:] - lost, offsets[:-1]), len(values))
    return total[np.maximum(end, start)] - total[start]
