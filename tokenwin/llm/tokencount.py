"""Token counts of texts without merging what is surely one token.

The vocabulary is proved once: every entry that is text is encoded alone, and those that give one
token are kept as hashes. Texts are split as the tokenizer does; a pre-token that is proved counts one, and
only the different others are merged, by the library itself, and remembered within a bound.

Texts are counted whole. A NULL text counts as empty and has no bytes and no tokens; repeated rows
and ids count each on their own; other columns are passed on, unless a column added here has the same
name, which then replaces it. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from tokenwin.llm.spans import Seen, distinct, unit_starts, worker_memory
from tokenwin.llm.textbytes import plain_text, slices, span_hashes, text_bytes

# Different pre-tokens that a worker remembers, some 14 bytes each, before it starts anew.
REMEMBERED = 1 << 21
_AT_ONCE = 4096
_WHOLE = np.uint64(0x6A09E667F3BCC909)


def byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    hidden = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(hidden)}


def described(text: str) -> dict:
    """The tokenizer's description, if texts may be split at chunks; else an error."""
    found = json.loads(text)
    splitting = found["pre_tokenizer"] or {}
    usual = splitting.get("type") == "ByteLevel" and splitting.get("use_regex", True) and not splitting["add_prefix_space"]
    added = [t for t in found["added_tokens"] if t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"] or "<" not in t["content"]]
    if not usual or found["normalizer"] is not None or added:
        raise ValueError("a byte-level tokenizer with the usual splitting and no normalizer is needed")
    return found


def proved_tokens(text: str) -> np.ndarray:
    """Sorted hashes of the vocabulary strings that encode alone as one token."""
    tokenizer = Tokenizer.from_str(text)
    tokenizer.encode_special_tokens = True
    letters = byte_of_letter()
    strings = []
    for token in described(text)["model"]["vocab"]:
        try:
            strings.append(bytes(letters[c] for c in token).decode())
        except (KeyError, UnicodeDecodeError):
            continue  # a part of a character is never a whole pre-token
    alone = [s for s, e in zip(strings, tokenizer.encode_batch_fast(strings, add_special_tokens=False)) if len(e.ids) == 1]
    whole, bounds = text_bytes(plain_text(pa.array(alone, pa.large_string())))
    return np.sort(span_hashes(np.frombuffer(whole, np.uint8), bounds[:-1], bounds[1:]))


class TokenCounter:
    def __init__(self, text: str, proved: np.ndarray):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core already
        self.whole, self.proved = Tokenizer.from_str(text), proved
        self.whole.no_truncation()
        self.whole.no_padding()
        # A pre-token needs no splitting again.
        self.merged = Tokenizer.from_str(json.dumps(described(text) | {"added_tokens": [], "truncation": None, "padding": None}))
        self.merged.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=False)
        self._forget()

    def _forget(self) -> None:
        self.seen, self.size = Seen(), np.zeros(0, np.int32)

    def _learn(self, hashes: np.ndarray, texts: list[str], whole: np.ndarray) -> np.ndarray:
        if len(self.seen) + len(hashes) > REMEMBERED:
            self._forget()
        size = np.zeros(len(texts), np.int32)
        for encoder, chosen in ((self.merged, np.flatnonzero(~whole)), (self.whole, np.flatnonzero(whole))):
            for at in range(0, len(chosen), _AT_ONCE):
                some = chosen[at : at + _AT_ONCE]
                found = encoder.encode_batch_fast([texts[i] for i in some.tolist()], add_special_tokens=False)
                size[some] = [len(e) for e in found]
        self.seen.add(hashes)
        self.size = np.concatenate([self.size, size])
        return size

    def count(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and tokens of each text."""
        whole, bounds = text_bytes(plain_text(texts))
        data = np.frombuffer(whole, np.uint8)
        if not len(data):
            return np.diff(bounds), np.zeros(len(texts), np.int64)
        start, odd = unit_starts(data, bounds)
        end = np.append(start[1:], len(data))
        codes, hashes, first = distinct(data, start, end, np.where(odd, _WHOLE, np.uint64(0)))
        at = np.minimum(np.searchsorted(self.proved, hashes), len(self.proved) - 1)
        tokens = np.ones(len(hashes), np.int64)
        rest = np.flatnonzero((self.proved[at] != hashes) | odd[first])
        slots = self.seen.find(hashes[rest])
        known = slots >= 0
        tokens[rest[known]] = self.size[slots[known]]
        new = rest[~known]
        if len(new):
            where = first[new]
            strings = [whole[a:b].decode() for a, b in zip(start[where].tolist(), end[where].tolist())]
            tokens[new] = self._learn(hashes[new], strings, odd[where])
        sums = np.concatenate([[0], np.cumsum(tokens[codes])])
        return np.diff(bounds), np.diff(sums[np.searchsorted(start, bounds)])


def count_tokens(docs: DataFrame, path: str, limit: int = 512, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``n_bytes``, ``n_tokens`` and ``over_limit``.

    ``path`` names a tokenizer file with byte-level merges; it is read on the driver, and its text, whose size is
    fixed, goes to the workers. Nothing is shuffled.
    """
    with open(path, encoding="utf-8") as file:
        tokenizer = file.read()
    shared = docs.sparkSession.sparkContext.broadcast((tokenizer, proved_tokens(tokenizer)))
    key = f"count {hashlib.sha256(tokenizer.encode()).hexdigest()}"
    mine = {"n_bytes", "n_tokens", "over_limit", text}
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in mine])
    names = kept.columns
    schema = kept.schema.add("n_bytes", "long").add("n_tokens", "long")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_memory(key, lambda: TokenCounter(*shared.value))
        for batch in slices(batches, text):
            n_bytes, n_tokens = counter.count(batch.column(text))
            columns = [batch.column(c) for c in names] + [pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "n_bytes", "n_tokens"])

    rows = docs.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text}`")).mapInArrow(counted, schema)
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
