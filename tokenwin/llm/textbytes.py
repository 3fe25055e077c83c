"""Words of Arrow text columns as numpy arrays, without a Python object for each word.

A word is a maximal run of bytes other than U+0020 and U+0009 to U+000D. NULL texts count as empty.
Hashes are 64-bit and depend on the word's bytes only.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20
_SPACES = bytes([*range(0x09, 0x0E), 0x20])
_LOWER = bytes(range(256)).lower()
_IS_SPACE = bytes(1 if b in _SPACES else 0 for b in range(256))
_M1, _M2, _M3 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)


class Words(NamedTuple):
    """``data`` holds the bytes; word i is ``data[start[i]:end[i]]``; row r has words ``first[r]:first[r + 1]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def plain_text(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return pc.fill_null(column.cast(pa.large_string()), "")


def text_bytes(texts: pa.Array) -> tuple[bytes, np.ndarray]:
    """The texts' UTF-8 bytes end to end, and the bounds of each text in them."""
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if len(texts) == 0:
        return b"", np.zeros(1, np.int64)
    data = texts.buffers()[2]
    whole = b"" if data is None else data.slice(int(bounds[0]), int(bounds[-1] - bounds[0])).to_pybytes()
    return whole, bounds - bounds[0]


def slices(batches, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of one piece have about ``most`` bytes, or are a single text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        at, ends = 0, np.cumsum(sizes)
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(at, to - at)
            at = to


def words_of(texts: pa.Array, lower: bool = True) -> Words:
    whole, bounds = text_bytes(plain_text(texts))
    return split_words(whole.translate(_LOWER) if lower else whole, bounds)


def split_words(whole: bytes, bounds: np.ndarray) -> Words:
    data = np.frombuffer(whole, np.uint8)
    space = np.frombuffer(whole.translate(_IS_SPACE), np.bool_)
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    begins, ends = ~space, ~space
    begins[1:] &= space[:-1]
    begins[inner] = ~space[inner]
    ends[:-1] &= space[1:]
    ends[inner - 1] = ~space[inner - 1]
    start = np.flatnonzero(begins)
    first = np.searchsorted(start, bounds)
    return Words(data, start, np.flatnonzero(ends) + 1, first)


def mix(h: np.ndarray) -> np.ndarray:
    """Finish a hash: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h *= _M1
    h ^= h >> np.uint64(33)
    h *= _M2
    h ^= h >> np.uint64(33)
    return h


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span, eight bytes a step; long spans go on alone."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    chunk = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    left = end - start
    h = mix(left.astype(np.uint64) * _M3 + _M1)
    at, rest = start, None
    while True:
        part = chunk[at] & _KEEP[np.minimum(left, 8)]
        if rest is None:
            h = mix(h ^ (part * _M3))
        else:
            h[rest] = mix(h[rest] ^ (part * _M3))
        more = left > 8
        if not more.any():
            return h
        rest = np.flatnonzero(more) if rest is None else rest[more]
        at, left = at[more] + 8, left[more] - 8


def word_hashes(words: Words) -> np.ndarray:
    return span_hashes(words.data, words.start, words.end)


def ngram_hashes(hashes: np.ndarray, first: np.ndarray, n: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word runs of each row, and the rows' bounds in them.

    With ``short`` a row of one to n - 1 words has one run of all its words, else it has none.
    """
    count = np.diff(first)
    runs = np.maximum(count - n + 1, 0)
    total = max(len(hashes) - n + 1, 0)
    combined = np.zeros(total, np.uint64)
    for k in range(n):
        combined *= _M1
        combined += hashes[k : k + total]
    bounds = np.concatenate([[0], np.cumsum(runs)])
    at = np.arange(bounds[-1]) + np.repeat(first[:-1] - bounds[:-1], runs)
    out = mix(combined[at])
    if short and ((count > 0) & (count < n)).any():
        few = np.flatnonzero((count > 0) & (count < n))
        own = np.array([int(np.bitwise_xor.reduce(mix(hashes[first[r] : first[r + 1]] + np.arange(count[r], dtype=np.uint64)))) for r in few], np.uint64)
        out = np.insert(out, bounds[few], own)
        runs = runs.copy()
        runs[few] = 1
        bounds = np.concatenate([[0], np.cumsum(runs)])
    return out, bounds
