"""Canonical length-limited Huffman codes over numpy arrays.

A run of ids is coded on its own, starting at a byte. Every ``EVERY`` ids a checkpoint keeps the
bit offset, so that decoding goes on at all checkpoints at once: step i reads the i-th id after each
of them through one table over the next ``LIMIT`` bits.
"""

from __future__ import annotations

import numpy as np

LIMIT = 16
EVERY = 128


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Best lengths up to ``limit`` by package-merge; 0 for ids that do not occur.

    Equal counts are ordered by id, so that the lengths do not depend on anything else.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids need codes of more than {limit} bits")
    coins = used[np.argsort(counts[used], kind="stable")]
    weight = counts[coins].astype(np.int64)
    merged, levels = weight, []
    for _ in range(limit - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weight, pairs])
        order = np.argsort(both, kind="stable")
        levels.append(order < len(weight))
        merged = both[order]
    need = 2 * len(used) - 2
    for is_coin in reversed(levels):
        taken = int(is_coin[:need].sum())
        lengths[coins[:taken]] += 1
        need = 2 * (need - taken)
    lengths[coins[:need]] += 1
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in the order of length, then id; each is the one before it plus one, shifted to its length."""
    codes = np.zeros(len(lengths), np.uint32)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    step = 1 << (LIMIT - lengths[order].astype(np.int64))
    place = np.cumsum(step) - step
    codes[order] = place >> (LIMIT - lengths[order].astype(np.int64))
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Id and code length for each value of the next ``LIMIT`` bits."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    fill = 1 << (LIMIT - lengths[order].astype(np.int64))
    ids, sizes = np.zeros(1 << LIMIT, np.int32), np.zeros(1 << LIMIT, np.int32)
    ids[: fill.sum()] = np.repeat(order, fill)
    sizes[: fill.sum()] = np.repeat(lengths[order], fill)
    return ids, sizes


def encode(ids: np.ndarray, bounds: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Bytes of all runs, their bounds in them, and the bit offset of each id in its own run."""
    size = lengths[ids].astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(size)])
    bits = ends[bounds[1:]] - ends[bounds[:-1]]
    edges = np.concatenate([[0], np.cumsum((bits + 7) // 8)])
    run = np.repeat(np.arange(len(bits)), np.diff(bounds))
    offset = ends[:-1] - ends[bounds[:-1]][run]
    at = edges[:-1][run] * 8 + offset
    # A code of up to 16 bits that starts at bit r of a 32-bit word ends by bit r + 16: one more word at most.
    words = np.zeros(int(edges[-1]) // 4 + 2, np.uint64)
    word, shift = at >> 5, (64 - (at & 31) - size).astype(np.uint64)
    value = codes[ids].astype(np.uint64) << shift
    if len(word):
        # Codes that start in one word take up different bits, so their sum is their union.
        starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        both = np.add.reduceat(value, starts)
        words[word[starts]] += both >> np.uint64(32)
        words[word[starts] + 1] += both & np.uint64(0xFFFFFFFF)
    return words.astype(">u4").tobytes()[: int(edges[-1])], edges, offset


def decode(data: bytes, starts: np.ndarray, counts: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Ids of runs of at most ``EVERY`` ids: run i has ``counts[i]`` ids from bit ``starts[i]`` on."""
    ids, sizes = table
    raw = np.frombuffer(data + b"\0\0\0\0", np.uint8).astype(np.uint32)
    out = np.empty(int(counts.sum()), np.int32)
    place = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    at, place, left = starts[order].astype(np.int64), place[order], counts[order]
    for step in range(int(counts.max(initial=0))):
        live = int(np.searchsorted(-left, -step, "left"))
        at, place, left = at[:live], place[:live], left[:live]
        byte = at >> 3
        window = (raw[byte] << 16 | raw[byte + 1] << 8 | raw[byte + 2]) >> (24 - LIMIT - (at & 7)).astype(np.uint32)
        window &= (1 << LIMIT) - 1
        out[place + step] = ids[window]
        at = at + sizes[window]
    return out
