"""Spans of text that a tokenizer treats alone, and what is remembered of them.

A *chunk* starts where U+0020 follows a byte that is surely no white space: a printable ASCII
character or a letter of two bytes that starts with C3. No token of a byte-level tokenizer with the
usual splitting, and no piece that holds a space only at its start, reaches over such a place, and
neither looks back. So the tokens of a text are those of its chunks one after another.
"""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa

from tokenwin.llm.textbytes import span_hashes

_PRINTABLE = np.array([0x21 <= b <= 0x7E for b in range(256)])
# Chunks of these bytes alone are split by character classes; all others go to the tokenizer whole.
SPACE, LETTER, DIGIT, OTHER, ODD = range(5)
_CLASS = np.array(
    [
        SPACE if b in b"\t\n\x0b\x0c\r " else DIGIT if chr(b) in "0123456789" else LETTER if chr(b).isalpha() and b < 0x80
        else OTHER if 0x21 <= b <= 0x7E and b not in b"'<" else ODD
        for b in range(256)
    ],
    np.uint8,
)


def before(values: np.ndarray, first) -> np.ndarray:
    """Values moved one place on."""
    out = np.empty_like(values)
    if len(values):
        out[0], out[1:] = first, values[:-1]
    return out


def chunk_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether a chunk starts at each byte; every text starts one."""
    one = before(data, 0)
    begins = (data == 0x20) & (_PRINTABLE[one] | ((one >= 0x80) & (before(one, 0) == 0xC3)))
    begins[bounds[:-1][np.diff(bounds) > 0]] = True
    return begins


def unit_starts(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where pre-tokens start, and whether each is a whole chunk with other characters.

    A pre-token is a run of letters, of digits or of other characters, with the space before it; of
    white space before something else the last character stands alone or goes with what follows. Chunks
    with an apostrophe, ``<``, a control character or any character but Latin letters beyond ASCII are
    not split.
    """
    chunk = chunk_starts(data, bounds)
    kind = _CLASS[data]
    one = before(data, 0)
    pair = (data >= 0x80) & (data < 0xC0) & (one == 0xC3) & (data != 0x97) & (data != 0xB7)
    kind[pair] = LETTER
    kind[np.flatnonzero(pair) - 1] = LETTER
    text = np.zeros(len(data), np.bool_)
    text[bounds[:-1][np.diff(bounds) > 0]] = True
    space = kind == SPACE
    last = np.ones(len(data), np.bool_)  # of white space: nothing else follows in the text
    last[:-1] = space[1:] | text[1:]
    begins = np.where(space, ~before(space, False) | ~last, (kind != before(kind, ODD)) & (one != 0x20)) | text
    number = np.cumsum(chunk)
    at = np.flatnonzero(chunk)
    odd = np.zeros(len(at) + 1, np.bool_)
    odd[number[kind == ODD]] = True
    begins = np.where(odd[number], chunk, begins)
    starts = np.flatnonzero(begins)
    return starts, odd[number[starts]]


class Seen:
    """Numbers of the hashes seen so far, in sorted arrays: some 12 bytes each."""

    def __init__(self):
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    def __len__(self) -> int:
        return len(self.keys)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 for new ones."""
        if not len(self.keys):
            return np.full(len(hashes), -1, np.int32)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, self.slots[at], np.int32(-1))

    def add(self, hashes: np.ndarray) -> np.ndarray:
        """Number new hashes, in the order given."""
        slots = np.arange(len(self.keys), len(self.keys) + len(hashes), dtype=np.int32)
        keys, all_slots = np.concatenate([self.keys, hashes]), np.concatenate([self.slots, slots])
        order = np.argsort(keys, kind="stable")
        self.keys, self.slots = keys[order], all_slots[order]
        return slots


def distinct(data: np.ndarray, start: np.ndarray, end: np.ndarray, salt: np.ndarray | None = None):
    """``(codes, hashes, first)``: the different spans, and where each first occurs."""
    hashes = span_hashes(data, start, end)
    if salt is not None:
        hashes ^= salt
    codes, uniques = pd.factorize(hashes)
    first = np.empty(len(uniques), np.int64)
    first[codes[::-1]] = np.arange(len(codes))[::-1]
    return codes, uniques, first


def gather(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs ``flat[begin:begin + size]`` one after another."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(begin - (ends - size), size)]


def worker_memory(key: str, make: Callable[[], Any]) -> Any:
    """What this worker made for ``key``; the tasks after share it, and another key takes its place.

    The functions of a task are sent by value, so their own globals end with it.
    """
    kept = vars(sys).setdefault("_tokenwin_memory", {})
    if key not in kept:
        kept.clear()
        kept[key] = make()
        release_free_memory()
    return kept[key]


def forget_worker_memory() -> None:
    """Drop what this worker has made, for tasks that come after its use and need the room."""
    if vars(sys).pop("_tokenwin_memory", None):
        release_free_memory()


def release_free_memory() -> None:
    """Give back what this worker's stages before, and the making of something large, have left free."""
    gc.collect()
    _trim()


def _trim() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library alone
    if trim:
        trim(0)


def releasing(rows: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``rows`` for ``mapInArrow``, whose worker gives back free memory at the end of the task: while it idles, others need it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from rows(batches)
        _trim()

    return run


def releasing_group(group: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """``group`` for ``applyInArrow``, whose worker gives back free memory after each group."""

    def run(table: pa.Table) -> pa.Table:
        out = group(table)
        _trim()
        return out

    return run
